"""Registered queries: sources, sinks, prompts, samples and splits."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from distaff.constants import CAPTURE_ROLES, SPLIT_SEED, SYSTEM_TEMPLATE, TOOLS_SLOT
from distaff.operators import examples, filters, prompts, sampling
from distaff.operators.ordering import head_slice
from distaff.operators.prompts import turn
from distaff.plans import twins
from distaff.plans.registry import query
from distaff.plans.workload import chat_corpus, paired, predictions, table
from distaff.session import scratch_path
from distaff.sources import capture, completions, corpus


def _usable(spark, sf):
    return filters.with_tools(chat_corpus(spark, sf))


def _messages(df):
    """One row per message."""
    return df.select("example_id", F.posexplode("messages").alias("pos", "m")).select(
        "example_id", "pos", F.col("m.role").alias("role"), F.col("m.content").alias("content")
    )


# ---- sources and sinks


@query(
    "read_chat_corpus",
    """select sha256(text) || '-' || row_number() over (partition by text) as example_id,
  length(text) as n_chars from documents""",
)
def read_chat_corpus(spark, sf):
    rows = corpus.read_chat_corpus(
        spark, f"{sf}/documents.parquet", schema=corpus.TEXT_SCHEMA
    )
    return rows.select("example_id", F.length("text").alias("n_chars"))


@query(
    "turns_to_conversations",
    """select conv_id, row_number() over (partition by conv_id order by turn, role, text) - 1 as pos,
  role, text, min(turn) over (partition by conv_id) = 0
    and max(turn) over (partition by conv_id) = count(*) over (partition by conv_id) - 1 as complete
from conversations""",
)
def turns_to_conversations(spark, sf):
    """Every turn of every conversation, read back from the nested form."""
    nested = corpus.turns_to_conversations(table(spark, sf, "conversations"))
    return nested.select("conv_id", "complete", F.posexplode("conversations").alias("pos", "t")).select(
        "conv_id",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("t.from").alias("role"),
        F.col("t.value").alias("text"),
        "complete",
    )


def _real_chats(spark, sf):
    """Given conversations under the roles of the raw corpus, without tools."""
    turns = table(spark, sf, "conversations").replace({"user": "human", "assistant": "gpt"}, subset="role")
    nested = corpus.turns_to_conversations(turns)
    return nested.withColumnRenamed("conv_id", "example_id").withColumn("tools", F.lit(None).cast("string"))


@query(
    "map_roles_all_turns",
    """select conv_id as example_id,
  cast(row_number() over (partition by conv_id order by turn, role, text) - 1 as integer) as pos,
  role, text as content from conversations""",
)
def map_roles_all_turns(spark, sf):
    """Roles of every turn of the given conversations."""
    return _messages(prompts.map_roles(_real_chats(spark, sf)))


@query(
    "full_dialogue_all_turns",
    f"""with kept as (
  select *, row_number() over (partition by conv_id order by turn, role, text) as pos from conversations
  where conv_id not in (select conv_id from conversations where role = 'system'))
select conv_id as example_id, 0 as pos, 'system' as role,
  '{SYSTEM_TEMPLATE.replace(TOOLS_SLOT, '[]')}' as content from (select distinct conv_id from kept)
union all select conv_id, cast(pos as integer), role, text from kept""",
)
def full_dialogue_all_turns(spark, sf):
    """Whole conversations after a system message; those with a turn of their own for it are skipped."""
    return _messages(prompts.full_dialogue(_real_chats(spark, sf), on_unknown="skip"))


@query(
    "head_slice",
    "select event_id, user_id, event_type from events order by event_id limit 2000",
)
def first_rows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return head_slice(events, 2000, "event_id")


def _completion_rows(spark, sf):
    asked = chat_corpus(spark, sf).select(
        "example_id", "tools", turn(0, "value").alias("prompt_user_turn")
    )
    teacher = predictions(spark, sf).filter(F.col("model") == "teacher")
    return asked.join(teacher, "example_id").select(
        F.col("example_id").cast("string").alias("example_id"),
        "model",
        "tools",
        "prompt_user_turn",
        F.col("completion").alias("teacher_completion"),
    )


@query(
    "write_completions",
    twins.with_ctes(twins.EXAMPLES, twins.PREDICTIONS)
    + """select cast(e.example_id as varchar) as example_id, p.model, e.tools,
  e.user_turn as prompt_user_turn, p.completion as teacher_completion
from examples e join predictions p on e.example_id = p.example_id where p.model = 'teacher'""",
)
def write_completions(spark, sf):
    path = scratch_path(spark, "completions")
    completions.write_completions(_completion_rows(spark, sf), path)
    return completions.read_completions(spark, path).drop(completions.CORRUPT)


@query(
    "read_completions",
    """select count(*) as n_lines, count(*) filter (event_type = 'error') as n_corrupt,
  count(*) filter (event_type <> 'error') as n_read from events""",
)
def read_completions(spark, sf):
    """Lines of ``error`` events are cut short on disk, as by a lost writer."""
    path = scratch_path(spark, "completions")
    fields = F.struct(
        F.col("event_id").cast("string").alias("example_id"),
        F.lit("teacher").alias("model"),
        F.lit("[]").alias("tools"),
        F.lit("hello").alias("prompt_user_turn"),
        F.col("props").alias("teacher_completion"),
    )
    line = F.to_json(fields)
    cut = F.when(F.col("event_type") == "error", F.substring(line, 1, 30)).otherwise(line)
    table(spark, sf, "events").select(cut).write.text(path)
    return completions.corrupt_count(completions.read_completions(spark, path))


@query(
    "save_messages",
    twins.PROMPTS_SQL.rstrip()
    + """, kept as (
  select * from prompts
  where coalesce(tools, '') not in ('', '[]') and first_from = 'human'
    and second_from in ('gpt', 'function_call'))
select example_id, 0 as pos, 'system' as role, system_prompt as content from kept
union all select example_id, 1, 'user', user_turn from kept
union all select example_id, 2, 'assistant', second_value from kept""",
)
def save_messages(spark, sf):
    path = scratch_path(spark, "messages")
    triples = prompts.triple_messages(_usable(spark, sf))
    capture.save_messages(triples.select("example_id", "messages"), path)
    return _messages(capture.load_messages(spark, path))


@query("write_capped_parquet", "select count(*) as n_rows, 0 as n_over_cap from events")
def write_capped_parquet(spark, sf):
    path = scratch_path(spark, "capped")
    capture.write_capped_parquet(_completion_rows(spark, sf), path, max_rows=500)
    return capture.rows_per_file(spark, path).agg(
        F.sum("n_rows").alias("n_rows"),
        F.count_if(F.col("n_rows") > 500).cast("int").alias("n_over_cap"),
    )


@query(
    "fixed_schema",
    """select vec_id, cast(label as bigint) as label, len(embedding) as width,
  round(list_sum(embedding::double[]), 6) as total from embeddings""",
)
def fixed_schema(spark, sf):
    schema = T.StructType(
        [
            T.StructField("label", T.LongType()),
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.DoubleType())),
        ]
    )
    fixed = capture.fixed_schema(table(spark, sf, "embeddings"), schema)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x)
    return fixed.select(
        "vec_id",
        "label",
        F.size("embedding").cast("bigint").alias("width"),
        F.round(total, 6).alias("total"),
    )


@query(
    "check_manifest",
    """with sides as (
  select max(len(embedding)) as d, 64 as k, max(label) + 1 as n_labels from embeddings)
select 'd' as key, cast(d as varchar) as captured, cast(n_labels as varchar) as training
from sides where d <> n_labels
union all select 'exact_k', '64', null
union all select 'temperature', null, '1.0'""",
)
def check_manifest(spark, sf):
    """Width of the captured rows against the width a training run assumes."""
    vectors = table(spark, sf, "embeddings")
    path = scratch_path(spark, "manifest")
    captured = vectors.agg(F.max(F.size("embedding")).alias("d")).select(
        "d", F.lit(64).alias("k"), F.lit(64).alias("exact_k")
    )
    capture.write_manifest(capture.manifest_rows(captured), path)
    training = vectors.agg((F.max("label") + 1).alias("d")).select(
        "d", F.lit(64).alias("k"), F.lit("1.0").alias("temperature")
    )
    return capture.check_manifest(spark.read.parquet(path), capture.manifest_rows(training))


# ---- projections, filters, prompts


@query(
    "with_tools",
    twins.EXAMPLES_SQL
    + "select example_id, tools from examples where coalesce(tools, '') not in ('', '[]')",
)
def with_tools(spark, sf):
    return _usable(spark, sf).select("example_id", "tools")


_ROLE = "case {0} when 'human' then 'user' when 'gpt' then 'assistant' else {0} end"


@query(
    "map_roles",
    twins.EXAMPLES_SQL
    + f"""select example_id, 0 as pos, {_ROLE.format('first_from')} as role,
  user_turn as content from examples
union all
select example_id, 1, {_ROLE.format('second_from')}, second_value from examples""",
)
def map_roles(spark, sf):
    return _messages(prompts.map_roles(chat_corpus(spark, sf), on_unknown="keep"))


@query(
    "full_dialogue",
    twins.PROMPTS_SQL
    + """select example_id, 0 as pos, 'system' as role, system_prompt as content from prompts
union all
select example_id, 1, case first_from when 'human' then 'user' else 'assistant' end, user_turn
from prompts
union all
select example_id, 2, case second_from when 'observation' then 'user' else 'assistant' end,
  case second_from when 'observation' then 'FUNCTION RESPONSE: ' else '' end || second_value
from prompts""",
)
def full_dialogue(spark, sf):
    return _messages(prompts.full_dialogue(chat_corpus(spark, sf)))


@query("system_prompt", twins.PROMPTS_SQL + "select example_id, system_prompt from prompts")
def system_prompt(spark, sf):
    return prompts.with_system_prompt(chat_corpus(spark, sf)).select(
        "example_id", "system_prompt"
    )


@query(
    "prompt_messages",
    twins.PROMPTS_SQL.rstrip()
    + """, kept as (select * from prompts where first_from = 'human')
select example_id, 0 as pos, 'system' as role, system_prompt as content from kept
union all select example_id, 1, 'user', user_turn from kept""",
)
def prompt_messages(spark, sf):
    return _messages(prompts.prompt_messages(chat_corpus(spark, sf)))


@query(
    "triple_messages",
    twins.PROMPTS_SQL.rstrip()
    + """, kept as (
  select * from prompts where first_from = 'human' and second_from in ('gpt', 'function_call'))
select example_id, 0 as pos, 'system' as role, system_prompt as content from kept
union all select example_id, 1, 'user', user_turn from kept
union all select example_id, 2, 'assistant', second_value from kept""",
)
def triple_messages(spark, sf):
    return _messages(
        prompts.triple_messages(
            chat_corpus(spark, sf), CAPTURE_ROLES, target_roles=["gpt", "function_call"]
        )
    )


_CHAT = """'<|im_start|>system
' || system_prompt || '<|im_end|>
<|im_start|>user
' || user_turn || '<|im_end|>
'"""


@query(
    "render_chat",
    twins.PROMPTS_SQL
    + f"""select example_id, {_CHAT} || '<|im_start|>assistant
' || second_value || '<|im_end|>
' as text
from prompts where first_from = 'human' and second_from in ('gpt', 'function_call')""",
)
def render_chat(spark, sf):
    return prompts.render_chat(prompts.triple_messages(chat_corpus(spark, sf))).select(
        "example_id", "text"
    )


@query(
    "render_prompt",
    twins.PROMPTS_SQL
    + f"""select example_id, {_CHAT} || '<|im_start|>assistant
' as text from prompts where first_from = 'human'""",
)
def render_prompt(spark, sf):
    asked = prompts.prompt_messages(chat_corpus(spark, sf))
    return prompts.render_chat(asked, add_generation_prompt=True).select("example_id", "text")


_TARGET = """case when first_from = 'human' then case second_from
    when 'function_call'
      then '{"name": "' || event_type || '", "arguments": ' || props || '}'
    when 'gpt' then second_value end end"""


@query(
    "ground_truth_target",
    twins.EXAMPLES_SQL + f"select example_id, {_TARGET} as target from examples",
)
def ground_truth_target(spark, sf):
    return prompts.ground_truth_target(chat_corpus(spark, sf)).select("example_id", "target")


@query(
    "target_messages",
    twins.PROMPTS_SQL
    + f"""select example_id, {_CHAT} || '<|im_start|>assistant
' || {_TARGET} || '<|im_end|>
' as text from prompts
where {_TARGET} is not null""",
)
def target_messages(spark, sf):
    """Training text of every row that has a target."""
    return prompts.render_chat(prompts.target_messages(chat_corpus(spark, sf))).select(
        "example_id", "text"
    )


@query(
    "expects_call",
    twins.EXAMPLES_SQL
    + "select example_id, second_from = 'function_call' as expects_call from examples",
)
def expects_call(spark, sf):
    return chat_corpus(spark, sf).select(
        "example_id", filters.expects_call().alias("expects_call")
    )


@query(
    "eval_examples_args",
    twins.EXAMPLES_SQL
    + """select example_id, tools, user_turn, '"' || event_type || '"' as gt_name,
  cast(json(props) as varchar) as gt_args
from examples where first_from = 'human' and second_from = 'function_call'""",
)
def eval_examples_args(spark, sf):
    return examples.eval_examples(chat_corpus(spark, sf), "args")


@query(
    "eval_examples_decision",
    twins.EXAMPLES_SQL
    + """select example_id, tools, user_turn, second_from = 'function_call' as gt_is_call
from examples where first_from = 'human'""",
)
def eval_examples_decision(spark, sf):
    return examples.eval_examples(chat_corpus(spark, sf), "decision")


@query(
    "eval_examples_capped",
    twins.EXAMPLES_SQL
    + """select example_id, user_turn from examples
where first_from = 'human' and second_from = 'function_call' order by example_id limit 40""",
)
def eval_examples_capped(spark, sf):
    capped = examples.eval_examples(chat_corpus(spark, sf), "args", cap=40)
    return capped.select("example_id", "user_turn")


@query(
    "with_skip_counts",
    twins.EXAMPLES_SQL
    + """select case when first_from <> 'human' then 'first_not_human'
  when second_from not in ('gpt', 'function_call', 'human') then 'reply_role'
  else 'built' end as outcome, count(*) as n from examples group by 1""",
)
def with_skip_counts(spark, sf):
    return filters.with_skip_counts(chat_corpus(spark, sf), prompts.triple_skip_reason())


@query(
    "conversation_skip_counts",
    """with firsts as (
  select a.conv_id, a.role as r0, b.role as r1
  from conversations a left join conversations b on b.conv_id = a.conv_id and b.turn = 1
  where a.turn = 0)
select case when r0 <> 'user' then 'first_not_human' when r1 is null then 'no_reply'
  when r1 not in ('assistant', 'user') then 'reply_role' else 'built' end as outcome,
  count(*) as n
from firsts group by 1""",
)
def conversation_skip_counts(spark, sf):
    """Given conversations under the roles ``human`` and ``gpt``."""
    return filters.with_skip_counts(_real_chats(spark, sf), prompts.triple_skip_reason(tools=None))


@query(
    "preview",
    "select doc_id, substr(text, 1, 120) as text from documents order by doc_id limit 20",
)
def preview(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return filters.preview(docs, 20, 120, "doc_id")


# ---- samples and splits

_BY_HASH = """
usable as (select event_id as example_id from events),
ranked as (
  select example_id, row_number() over (
    order by md5('{seed}-' || example_id), example_id) as r, count(*) over () as n
  from usable)"""


def _events(spark, sf):
    return table(spark, sf, "events").select(F.col("event_id").alias("example_id"))


@query(
    "seeded_sample",
    twins.with_ctes(_BY_HASH.format(seed=3407))
    + "select example_id from ranked where r <= 3000",
)
def seeded_sample(spark, sf):
    return sampling.seeded_sample(_events(spark, sf), "example_id")


@query(
    "exact_split",
    twins.with_ctes(_BY_HASH.format(seed=3407))
    + """select example_id, case when r <= ceil(n * 0.08e0) then 'test' else 'train' end as split
from ranked""",
)
def exact_split(spark, sf):
    return sampling.exact_split(_events(spark, sf), "example_id")


_NESTED_SQL = twins.SPLIT_SQL.rstrip() + """,
inner_ranked as (
  select example_id, split, row_number() over (
      order by md5('3407-nested-' || example_id), example_id) as ri, count(*) over () as ni
  from split where split = 'train')
"""


@query(
    "nested_split",
    _NESTED_SQL
    + """select example_id, split,
  case when ri <= ceil(ni * 0.08e0) then 'test' else 'train' end as inner_split
from inner_ranked""",
)
def nested_split(spark, sf):
    split = sampling.exact_split(_usable(spark, sf).select("example_id"), "example_id")
    return sampling.nested_split(split, "example_id")


@query(
    "staged_subset",
    twins.SPLIT_SQL.rstrip()
    + """, medium as (
  select example_id, row_number() over (
    order by md5('3407-medium-' || example_id), example_id) as rm
  from split where split = 'train')
select 'medium' as stage, example_id from medium where rm <= 300
union all select 'full', example_id from medium""",
)
def staged_subset(spark, sf):
    split = sampling.exact_split(_usable(spark, sf).select("example_id"), "example_id")
    train = split.filter(F.col("split") == "train").select("example_id")
    stages = [
        sampling.staged_subset(train, "example_id", stage).select(
            F.lit(stage).alias("stage"), "example_id"
        )
        for stage in ("medium", "full")
    ]
    return stages[0].unionAll(stages[1])


@query(
    "split_audit",
    twins.SPLIT_SQL
    + """select count(*) filter (split = 'train') as n_train,
  count(*) filter (split = 'test') as n_test, cast(0 as bigint) as n_leaked_keys from split""",
)
def split_audit(spark, sf):
    split = sampling.exact_split(_usable(spark, sf).select("example_id"), "example_id")
    return sampling.split_audit(
        split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test"), "example_id"
    )


@query(
    "prompt_overlap",
    twins.SPLIT_SQL
    + """, sides as (
  select trim(regexp_replace(lower(user_turn), '\\s+', ' ', 'g')) as p,
    count(*) filter (split = 'train') as a, count(*) filter (split = 'test') as b
  from split group by 1)
select count(*) filter (a > 0) as n_train_prompts, count(*) filter (b > 0) as n_test_prompts,
  count(*) filter (a > 0 and b > 0) as n_shared_prompts,
  cast(coalesce(sum(b) filter (a > 0 and b > 0), 0) as bigint) as n_test_rows from sides""",
)
def prompt_overlap(spark, sf):
    """Prompts that stand on both sides of the split."""
    split = sampling.exact_split(
        _usable(spark, sf).select("example_id", turn(0, "value").alias("prompt")), "example_id"
    )
    return sampling.prompt_overlap(
        split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test"), "prompt"
    )


@query(
    "policy_mix",
    """select event_id, ('0x' || substr(md5('3407-' || event_id), 1, 8))::bigint
  / 4294967296e0 < 0.5e0 as on_policy from events""",
)
def policy_mix(spark, sf):
    steps = table(spark, sf, "events").select("event_id")
    return sampling.policy_mix(steps, "event_id", 0.5, SPLIT_SEED)


@query(
    "mode_select",
    twins.with_ctes(
        twins.EXAMPLES, twins.PREDICTIONS, twins.PARSED, twins.PAIRED, twins.USABLE, twins.SPLIT
    )
    + """, kept as (
  select example_id from classified where model = 'teacher' and expected_behavior is not null)
select 'held_out' as part, example_id from split where split = 'test'
union all select 'filtered', example_id from split
  where split = 'train' and example_id in (select example_id from kept)
union all select 'unfiltered', example_id from split where split = 'train'""",
)
def mode_select(spark, sf):
    """All three selections from one pass: the filter is a flag on the split rows."""
    split = sampling.exact_split(_usable(spark, sf).select("example_id"), "example_id")
    teacher = paired(spark, sf).filter(F.col("model") == "teacher")
    kept = filters.keep_completions(teacher)
    return sampling.mode_parts(split, kept, "example_id")


@query(
    "mode_select_one",
    twins.with_ctes(
        twins.EXAMPLES, twins.PREDICTIONS, twins.PARSED, twins.PAIRED, twins.USABLE, twins.SPLIT
    )
    + """select example_id from split where split = 'train' and example_id in (
  select example_id from classified where model = 'teacher' and expected_behavior is not null)""",
)
def mode_select_one(spark, sf):
    """The selection a filtered training run asks for."""
    split = sampling.exact_split(_usable(spark, sf).select("example_id"), "example_id")
    kept = filters.keep_completions(paired(spark, sf).filter(F.col("model") == "teacher"))
    return sampling.mode_select(split, kept, "example_id", filtered=True).select("example_id")


# ---- from completions to training text


def _classified(spark, sf):
    """Teacher completions with their records and labels."""
    records = _completion_rows(spark, sf)
    expected = paired(spark, sf).filter(F.col("model") == "teacher").select(
        F.col("example_id").cast("string").alias("example_id"), "expects_call"
    )
    return filters.classify_completions(records.join(expected, "example_id"), "teacher_completion")


_KEPT_SQL = (
    twins.with_ctes(twins.EXAMPLES, twins.PREDICTIONS, twins.PARSED, twins.PAIRED, twins.PROMPTS)
    + """, kept as (
  select cast(c.example_id as varchar) as example_id, c.model, p.tools, p.user_turn as prompt_user_turn,
    c.completion as teacher_completion, c.expected_behavior, p.system_prompt
  from classified c join prompts p on p.example_id = c.example_id
  where c.model = 'teacher' and c.expected_behavior is not null)
"""
)


@query(
    "write_filtered",
    _KEPT_SQL
    + """select example_id, model, tools, prompt_user_turn, teacher_completion, expected_behavior from kept""",
)
def write_filtered(spark, sf):
    """Kept completions with their label, written and read again."""
    path = scratch_path(spark, "filtered")
    completions.write_filtered(_classified(spark, sf), path)
    return completions.read_completions(spark, path, completions.FILTERED_SCHEMA).drop(completions.CORRUPT)


@query(
    "completion_text",
    _KEPT_SQL.rstrip()
    + """,
ranked as (
  select *, row_number() over (order by md5('3407-nested-' || example_id), example_id) as r,
    count(*) over () as n from kept)
select example_id, case when r <= ceil(n * 0.08e0) then 'test' else 'train' end as inner_split,
  '<|im_start|>system
' || system_prompt || '<|im_end|>
<|im_start|>user
' || prompt_user_turn || '<|im_end|>
<|im_start|>assistant
' || teacher_completion || '<|im_end|>
' as text from ranked""",
)
def completion_text(spark, sf):
    """Filter, write, read, render and split: the input of sequence-level distillation."""
    path = scratch_path(spark, "filtered")
    completions.write_filtered(_classified(spark, sf), path)
    records = completions.read_completions(spark, path, completions.FILTERED_SCHEMA)
    text = prompts.render_chat(prompts.completion_messages(records))
    split = sampling.nested_split(text.withColumn("split", F.lit("train")), "example_id")
    return split.select("example_id", "inner_split", "text")
