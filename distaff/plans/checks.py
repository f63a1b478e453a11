"""Registered queries: checks of corpora, vocabularies, outputs and logs."""

from pyspark.sql import functions as F

from distaff.operators import checks, examples, filters, losses, misses, tokens
from distaff.operators.prompts import turn
from distaff.plans import twins
from distaff.plans.registry import query
from distaff.plans.workload import chat_corpus, paired, positions, scored, table
from distaff.session import materialise, scratch_path
from distaff.sources import capture

_WORDS = "regexp_extract_all({0}, '[^ \t\n\r]+')"


@query(
    "dead_tokens",
    f"""with vocab as (
  select token, row_number() over (order by token) - 1 as id from (
    select distinct unnest({_WORDS.format('text')}) as token from benchmark))
select * from vocab where token not in (select unnest({_WORDS.format('text')}) from documents)""",
)
def dead_tokens(spark, sf):
    """Words of the benchmark that no document has."""
    vocab = tokens.build_vocab(table(spark, sf, "benchmark"))
    encoded = tokens.tokenize(table(spark, sf, "documents").select("doc_id", "text"), vocab)
    return checks.dead_tokens(vocab, encoded)


@query(
    "token_budget",
    f"""with sums as (
  select source, cast(sum(len({_WORDS.format('text')})) as bigint) as n_tokens from documents group by source)
select *, cast(20000 as bigint) as n_wanted, n_tokens / 20000e0 as share_of_wanted,
  sum(n_tokens) over () >= 20000 as enough from sums""",
)
def token_budget(spark, sf):
    docs = table(spark, sf, "documents")
    return checks.token_budget(docs, F.size(tokens.words(F.col("text"))), "source", 1000)


@query(
    "shard_tokens",
    f"""with sized as (select doc_id, cast(len({_WORDS.format('text')}) as bigint) as n_tokens from documents),
placed as (
  select *, cast(coalesce(sum(n_tokens) over (
    order by doc_id rows between unbounded preceding and 1 preceding), 0) as bigint) as start from sized)
select *, start // 10000 as shard_id from placed""",
)
def shard_tokens(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return checks.shard_tokens(docs, "doc_id", F.size(tokens.words(F.col("text"))), 10_000)


def _gram_sql(table, key, n):
    return f"""
  select distinct {key}, array_to_string(w[i : i + {n - 1}], ' ') as gram from (
    select {key}, w, unnest(range(1, len(w) - {n - 2})) as i from (
      select {key}, {_WORDS.format('text')} as w from {table}))"""


@query(
    "holdout_contamination",
    f"""with mine as ({_gram_sql('documents', 'doc_id', 13)}),
theirs as (select distinct gram from ({_gram_sql('benchmark', 'item_id', 13)}))
select doc_id, count(*) as n_shared from mine where gram in (select gram from theirs) group by doc_id""",
)
def holdout_contamination(spark, sf):
    """Documents that share 13 words in a row with the benchmark."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return checks.holdout_contamination(docs, table(spark, sf, "benchmark"), "doc_id", "text")


@query(
    "regurgitation",
    f"""with mine as ({_gram_sql('benchmark', 'item_id', 8)}),
theirs as (select distinct gram from ({_gram_sql('documents', 'doc_id', 8)}))
select b.item_id, count(m.gram) as n_grams, count(t.gram) as n_shared,
  coalesce(count(t.gram) / cast(nullif(count(m.gram), 0) as double), 0) as share_verbatim
from benchmark b left join mine m on m.item_id = b.item_id left join theirs t on t.gram = m.gram group by b.item_id""",
)
def regurgitation(spark, sf):
    """How much of each benchmark text stands word for word in the documents."""
    docs = table(spark, sf, "documents").select("text")
    return checks.regurgitation(table(spark, sf, "benchmark"), docs, "item_id", "text")


@query(
    "overfit_check",
    """with log as (
  select 'run-' || (event_id % 8) as run, event_id // 8 as step,
    case when event_id % 97 = 0 then 'nan'::double else value end as train_loss,
    case when (event_id // 8) % 3 = 0 then cast(json_extract(props, '$.k') as double) end as eval_loss
  from events),
slopes as (
  select run, step,
    count(*) filter (not isnan(train_loss)) over w as n_train, count(eval_loss) over w as n_eval,
    count(*) filter (isnan(train_loss)) over w as n_not_finite,
    regr_slope(train_loss, step) filter (not isnan(train_loss)) over w as train_slope,
    regr_slope(eval_loss, step) over w as eval_slope
  from log window w as (partition by run order by step range between 24 preceding and current row))
select run, step, n_train, n_eval, n_not_finite,
  case when n_train > 1 then round(train_slope, 6) + 0e0 end as train_slope,
  case when n_eval > 1 then round(eval_slope, 6) + 0e0 end as eval_slope,
  case when n_train >= 5 and n_eval >= 5 then round(train_slope, 9) < 0 and round(eval_slope, 9) > 0 end as overfits
from slopes""",
)
def overfit_check(spark, sf):
    """Train loss from one column, the eval loss of every third step from another, over the last 25 steps."""
    i = F.col("event_id")
    log = table(spark, sf, "events").select(
        F.concat(F.lit("run-"), (i % 8).cast("string")).alias("run"),
        F.floor(i / 8).alias("step"),
        F.when(i % 97 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("train_loss"),
        F.when(F.floor(i / 8) % 3 == 0, F.get_json_object("props", "$.k").cast("double")).alias("eval_loss"),
    )
    found = checks.overfit_check(log, 5, 25)
    return found.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("train_slope", "eval_slope")})


@query(
    "tvd",
    twins.with_ctes(twins.POSITIONS, twins.logprobs(1.0))
    + """select round(avg(d), 6) as tvd from (
  select sum(abs(exp(lt) - exp(ls))) / 2 as d from lp where label <> -100 group by vec_id)""",
)
def tvd(spark, sf):
    return checks.tvd(positions(spark, sf)).withColumn("tvd", F.round("tvd", 6))


@query(
    "hidden_cosine",
    twins.POSITIONS_SQL
    + """select round(avg(d), 6) as hidden_cosine, count(*) - count(d) as n_without_direction from (
  select 1 - sum(t * s) / nullif(sqrt(sum(t * t)) * sqrt(sum(s * s)), 0) as d
  from entries where label <> -100 group by vec_id)""",
)
def hidden_cosine(spark, sf):
    return checks.hidden_cosine(positions(spark, sf)).withColumn("hidden_cosine", F.round("hidden_cosine", 6))


@query(
    "uld",
    twins.with_ctes(twins.POSITIONS, twins.logprobs(1.0))
    + """, placed as (
  select vec_id, token_id, exp(lt) as p, exp(ls) as q,
    case when token_id >= 40 then row_number() over (partition by vec_id, token_id >= 40 order by lt desc) end as rp,
    case when token_id >= 40 then row_number() over (partition by vec_id, token_id >= 40 order by ls desc) end as rq
  from lp where label <> -100),
direct as (select vec_id, sum(abs(p - q)) as d from placed where token_id < 40 group by vec_id),
rest as (
  select a.vec_id, sum(abs(a.p - b.q)) as d from placed a join placed b on a.vec_id = b.vec_id and a.rp = b.rq
  group by a.vec_id)
select round(avg(direct.d + rest.d), 6) as uld from direct join rest on direct.vec_id = rest.vec_id""",
)
def uld(spark, sf):
    """The first 40 entries stand for those both vocabularies share."""
    return checks.uld(positions(spark, sf), 40).withColumn("uld", F.round("uld", 6))


@query(
    "format_compliance",
    twins.PAIRED_SQL
    + """, joined as (
  select c.*, e.second_value as target,
    case when c.expects_call then c.has_name and starts_with(trim(c.completion), '{')
      and ends_with(trim(c.completion), '}') else not c.any_json end as fits
  from paired c join examples e on e.example_id = c.example_id)
select model, count(*) as n, count(*) filter (fits) as n_compliant,
  count(*) filter (length(target) <= 40) as n_short,
  count(*) filter (length(target) <= 40 and trim(completion) = trim(target)) as n_exact,
  round(count(*) filter (fits) / cast(count(*) as double), 6) as compliant_rate,
  round(count(*) filter (length(target) <= 40 and trim(completion) = trim(target))
    / cast(greatest(1, count(*) filter (length(target) <= 40)) as double), 6) as exact_rate
from joined group by model""",
)
def format_compliance(spark, sf):
    targets = chat_corpus(spark, sf).select("example_id", turn(1, "value").alias("target"))
    shaped = filters.call_shape(paired(spark, sf)).join(targets, "example_id")
    found = checks.format_compliance(shaped, "completion")
    return found.withColumns({c: F.round(c, 6) for c in ("compliant_rate", "exact_rate")})


@query(
    "unique_false_positives",
    twins.SCORED_SQL
    + """, fp as (select * from scored where not gt_is_call and pred_is_call)
select example_id, user_turn, pred_name, pred_args from fp where model = 'distilled'
  and example_id not in (select example_id from fp where model = 'teacher')""",
)
def unique_false_positives(spark, sf):
    """Calls where none was due, made by the distilled model and not by its teacher."""
    return misses.unique_false_positives(scored(spark, sf), "distilled", "teacher")


@query(
    "truth_skip_counts",
    twins.EXAMPLES_SQL
    + """select case when first_from <> 'human' then 'first_not_human'
  when second_from <> 'function_call' then 'no_call_due'
  when event_id_mod = 1 then 'truth_not_json' when event_id_mod = 2 then 'truth_without_name'
  else 'built' end as outcome, count(*) as n
from (select *, example_id % 7 as event_id_mod from examples) group by 1""",
)
def truth_skip_counts(spark, sf):
    """Calls cut short or renamed in some rows, so that each reason occurs."""
    damage = F.when(F.col("example_id") % 7 == 1, F.lit("{")).when(F.col("example_id") % 7 == 2, F.lit('{"n":1}'))
    reply = F.when(turn(1, "from") == "function_call", F.coalesce(damage, turn(1, "value"))).otherwise(turn(1, "value"))
    damaged = chat_corpus(spark, sf).withColumn(
        "conversations",
        F.array(F.col("conversations")[0], F.struct(turn(1, "from").alias("from"), reply.alias("value"))),
    )
    return filters.with_skip_counts(examples.with_truth_reason(damaged), F.col("truth_reason"))


_POSITIONS = 128


@query(
    "capture_round_trip",
    f"""with vocab as (
  select token, row_number() over (order by token) - 1 as id from (
    select distinct unnest({_WORDS.format('text')}) as token from benchmark)),
sized as (
  select doc_id, {_WORDS.format('text')} as w, len({_WORDS.format("split_part(text, '.', 1)")}) as n_prompt from documents),
fit as (select * from sized where len(w) <= {_POSITIONS} and n_prompt < len(w)),
ids as (
  select f.doc_id, any_value(f.n_prompt) as n_prompt, list(coalesce(v.id, -1) order by f.pos) as ids
  from (select doc_id, n_prompt, unnest(w) as token, generate_subscripts(w, 1) as pos from fit) f
  left join vocab v on v.token = f.token group by f.doc_id),
lp as (
  select vec_id, token_id, x - ln(sum(exp(x)) over (partition by vec_id)) as lp from (
    select vec_id, unnest(embedding[1:48])::double as x, unnest(range(48)) as token_id from embeddings)),
best as (select *, row_number() over (partition by vec_id order by lp desc, token_id) as r from lp),
top as (
  select vec_id, string_agg(cast(token_id as varchar), ',' order by r) as t, sum(cast(cast(lp as float) as double)) as s
  from best where r <= 8 group by vec_id),
placed as (
  select doc_id, pos, (doc_id * 7 + pos) % (select count(*) from embeddings) as vec_id
  from (select doc_id, unnest(range({_POSITIONS})) as pos from fit)),
tops as (
  select doc_id, md5(string_agg(t, ';' order by pos)) as top_md5, round(sum(s), 3) as logprob_sum
  from placed join top using (vec_id) group by doc_id)
select cast(doc_id as varchar) as example_id,
  md5(array_to_string(list_concat(ids, [-2 for i in range({_POSITIONS} - len(ids))]), ',')) as ids_md5,
  md5(array_to_string(list_concat([-100 for i in range(n_prompt)], ids[n_prompt + 1:],
    [-100 for i in range({_POSITIONS} - len(ids))]), ',')) as labels_md5,
  top_md5, logprob_sum, cast(0 as bigint) as n_off, cast(0 as bigint) as n_changed
from ids join tops using (doc_id)""",
)
def capture_round_trip(spark, sf):
    """Prompt and reply to ids, labels and the top entries of every position, written, read and compared by value.

    Each document that fits is one sequence; the logits of a position are one
    of the given vectors. Ids are places in the vocabulary of the benchmark's
    words, one more for all others. Sequences and captured rows are worked out
    once and cut there, as both are read more than once.
    """
    vocab = tokens.build_vocab(table(spark, sf, "benchmark"))
    docs = table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("full_text"), F.substring_index("text", ".", 1).alias("prompt_text")
    )
    full = tokens.tokenize(docs, vocab, "full_text", "full_ids")
    both = tokens.tokenize(full, vocab, "prompt_text", "prompt_ids")
    masked = tokens.mask_and_pad(both, _POSITIONS, pad_id=-2).filter("skip_reason IS NULL")
    sequences = materialise(
        masked.select(F.col("doc_id").cast("string").alias("example_id"), "doc_id", "input_ids", "labels"), "sequences"
    )
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("teacher"))
    top = losses.topk_logprobs(losses.truncate_vocab(vectors, 48, "teacher"), "teacher", 8)
    entry = capture.KEYED_CAPTURE_SCHEMA["top_logprobs"].dataType.elementType  # cast once a vector, not once a position
    top = top.select("vec_id", F.col("top").cast(entry).alias("top"))
    asked = sequences.select("example_id", "doc_id", F.explode(F.sequence(F.lit(0), F.lit(_POSITIONS - 1))).alias("pos"))
    asked = asked.withColumn("vec_id", (F.col("doc_id") * 7 + F.col("pos")) % vectors.count())
    captured = capture.captured_sequences(sequences, asked.join(top, "vec_id").select("example_id", "pos", "top"))
    rows = materialise(captured, "captured")
    written = capture.fixed_schema(rows.filter("capture_reason IS NULL"), capture.KEYED_CAPTURE_SCHEMA)
    path = scratch_path(spark, "capture")
    capture.write_capped_parquet(written, path)
    read = capture.fixed_schema(spark.read.parquet(path), capture.KEYED_CAPTURE_SCHEMA)
    arrays = ["input_ids", "labels", "top_logprobs"]
    off = tokens.uniform_length_check(read, arrays, _POSITIONS).agg(F.sum("n_off")).scalar()
    changed = capture.capture_differences(written, read).agg(F.count("*")).scalar()
    listed = lambda c, sep=",": F.array_join(F.transform(c, lambda x: x.cast("string")), sep)
    entries = F.transform("top_logprobs", lambda p: listed(F.transform(p, lambda e: e["token_id"])))
    total = F.aggregate(F.flatten("top_logprobs"), F.lit(0.0), lambda acc, e: acc + e["logprob"].cast("double"))
    return read.select(
        "example_id",
        F.md5(listed("input_ids")).alias("ids_md5"),
        F.md5(listed("labels")).alias("labels_md5"),
        F.md5(F.array_join(entries, ";")).alias("top_md5"),
        F.round(total, 3).alias("logprob_sum"),
        off.alias("n_off"),
        changed.alias("n_changed"),
    )


_TOP_WORDS = """(
  select token, row_number() over (order by n desc, token) - 1 as id from (
    select token, count(*) as n from (select unnest(regexp_extract_all(text, '[^ \t\n\r]+')) as token from {0}) group by token)
  order by id limit {1})"""


@query(
    "uld_aligned",
    twins.with_ctes(twins.POSITIONS)
    + f""", tv as {_TOP_WORDS.format('benchmark', 64)}, sv as {_TOP_WORDS.format('documents', 60)},
pairs as (select tv.id as tid, sv.id as sid, tv.token from tv join sv on tv.token = sv.token),
tp as (
  select vec_id, token_id, exp(t) / sum(exp(t)) over (partition by vec_id) as p from entries
  where label <> -100 and token_id in (select id from tv)),
sp as (
  select vec_id, token_id, exp(s) / sum(exp(s)) over (partition by vec_id) as p from entries
  where label <> -100 and token_id in (select id from sv)),
direct as (
  select tp.vec_id, sum(abs(tp.p - sp.p)) as d from tp join pairs on tid = tp.token_id
  join sp on sp.token_id = sid and sp.vec_id = tp.vec_id group by tp.vec_id),
tr as (
  select vec_id, p, row_number() over (partition by vec_id order by p desc) as r from tp
  where token_id not in (select tid from pairs)),
sr as (
  select vec_id, p, row_number() over (partition by vec_id order by p desc) as r from sp
  where token_id not in (select sid from pairs)),
rest as (
  select coalesce(tr.vec_id, sr.vec_id) as vec_id, sum(abs(coalesce(tr.p, 0) - coalesce(sr.p, 0))) as d
  from tr full join sr on tr.vec_id = sr.vec_id and tr.r = sr.r group by 1)
select round(avg(direct.d + rest.d), 6) as uld, any_value((select count(*) from pairs)) as n_shared
from direct join rest on direct.vec_id = rest.vec_id""",
)
def uld_aligned(spark, sf):
    """Logits over the 64 most frequent words of the benchmark against those over the 60 of the documents."""
    teacher = tokens.frequent_vocab(table(spark, sf, "benchmark"), 64)
    student = tokens.frequent_vocab(table(spark, sf, "documents"), 60)
    alignment = checks.align_vocabularies(teacher, student)
    shared = checks.vocabulary_overlap(alignment).select("n_shared").scalar()
    return checks.uld_aligned(positions(spark, sf), alignment).select(F.round("uld", 6).alias("uld"), shared.alias("n_shared"))
