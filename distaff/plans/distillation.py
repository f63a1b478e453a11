"""Registered queries: tokens, captured distributions and losses."""

from pyspark.sql import functions as F

from distaff.functions.distributions import log_softmax
from distaff.operators import losses, ordering, quality, tokens
from distaff.plans import twins
from distaff.plans.registry import query
from distaff.plans.workload import chat_corpus, positions, table
from distaff.operators.prompts import turn

_WORDS = "regexp_extract_all({0}, '[^ \t\n\r]+')"


def _ids_md5(column):
    return F.md5(F.array_join(F.transform(column, lambda x: x.cast("string")), ","))


def _docs(spark, sf, *columns):
    return table(spark, sf, "documents").select("doc_id", "text", *columns)


def _stand_in_ids(text):
    """Stand-in tokenizer over whole texts: a number from every character of each word."""
    return F.transform(tokens.words(text), lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("bigint"))


#: The same number in SQL.
_STAND_IN_SQL = "('0x' || substr(md5(w), 1, 7))::bigint"


# ---- tokens


def _token_digests(encoded):
    ids = F.col("token_ids")
    return encoded.select(
        "doc_id",
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.size(F.filter(ids, lambda x: x == -1)).cast("bigint").alias("n_unknown"),
        _ids_md5(ids).alias("ids_md5"),
    )


_TOKENIZED_SQL = f"""with vocab as (
  select token, row_number() over (order by token) - 1 as id from (
    select distinct unnest({_WORDS.format('text')}) as token from benchmark)),
words as (
  select doc_id, unnest({_WORDS.format('text')}) as token,
    generate_subscripts({_WORDS.format('text')}, 1) as pos from documents),
ids as (
  select w.doc_id, w.pos, coalesce(v.id, -1) as id
  from words w left join vocab v on v.token = w.token)
select doc_id, count(*) as n_tokens, count(*) filter (id = -1) as n_unknown,
  md5(string_agg(cast(id as varchar), ',' order by pos)) as ids_md5
from ids group by doc_id"""


@query("tokenize", _TOKENIZED_SQL)
def tokenize(spark, sf):
    """Documents in the vocabulary of the benchmark texts."""
    vocab = tokens.build_vocab(table(spark, sf, "benchmark"))
    return _token_digests(tokens.tokenize(_docs(spark, sf), vocab))


@query("tokenize_joined", _TOKENIZED_SQL)
def tokenize_joined(spark, sf):
    """The same with a vocabulary above the limit of the look-up in the row."""
    vocab = tokens.build_vocab(table(spark, sf, "benchmark"))
    return _token_digests(tokens.tokenize(_docs(spark, sf), vocab, max_vocab=10, block_bytes=1 << 20))


@query(
    "tokenize_with",
    """select doc_id, md5(array_to_string(
  list_transform(string_split(text, ' '), lambda w: cast(length(w) as varchar)), ',')) as ids_md5
from documents""",
)
def tokenize_with(spark, sf):
    """Any tokenizer as a function of text batches."""
    encoded = tokens.tokenize_with(
        _docs(spark, sf), lambda texts: [[len(w) for w in t.split(" ")] for t in texts], "text", "ids"
    )
    return encoded.select("doc_id", _ids_md5(F.col("ids")).alias("ids_md5"))


@query(
    "vocab_size",
    f"""with vocab as (select distinct unnest({_WORDS.format('text')}) as token from benchmark)
select count(*) as vocab_size from vocab""",
)
def vocab_size(spark, sf):
    return tokens.vocab_size(tokens.build_vocab(table(spark, sf, "benchmark")))


def _masked(spark, sf):
    """The first sentence prompts for the document; French prompts are lowered."""
    sentence = F.substring_index("text", ".", 1)
    prompt = F.when(F.col("lang") == "fr", F.lower(sentence)).otherwise(sentence)
    rendered = _docs(spark, sf, "lang").select(
        "doc_id", F.col("text").alias("full_text"), prompt.alias("prompt_text")
    )
    encoded = rendered.select(
        "*",
        _stand_in_ids(F.col("full_text")).alias("full_ids"),
        _stand_in_ids(F.col("prompt_text")).alias("prompt_ids"),
    )
    return tokens.mask_and_pad(encoded)


def _masked_sql(number):
    """The masked rows in SQL, where ``number`` is the id of word ``w``."""
    return f"""with rendered as (
  select doc_id, text as full_text,
    case when lang = 'fr' then lower(split_part(text, '.', 1)) else split_part(text, '.', 1) end
      as prompt_text
  from documents),
encoded as (
  select *, list_transform({_WORDS.format('full_text')}, lambda w: {number}) as full_ids,
    list_transform({_WORDS.format('prompt_text')}, lambda w: {number}) as prompt_ids from rendered),
reasons as (
  select *, case when not starts_with(full_text, prompt_text) then 'prompt_not_prefix'
    when len(full_ids) > 768 then 'too_long'
    when len(prompt_ids) >= len(full_ids) then 'empty_reply' end as skip_reason
  from encoded),
masked as (
  select doc_id, skip_reason,
    case when skip_reason is null then full_ids ||
      list_transform(range(768 - len(full_ids)), lambda i: 0) end as input_ids,
    case when skip_reason is null then list_transform(prompt_ids, lambda i: -100)
      || full_ids[len(prompt_ids) + 1:]
      || list_transform(range(768 - len(full_ids)), lambda i: -100) end as labels
  from reasons)
"""


#: For queries that only look at lengths.
_MASKED_SQL = _masked_sql("unicode(w)::bigint * 4096 + length(w)")


@query(
    "mask_and_pad",
    _masked_sql(_STAND_IN_SQL)
    + """select doc_id, skip_reason, md5(array_to_string(input_ids, ',')) as input_md5,
  md5(array_to_string(labels, ',')) as labels_md5 from masked""",
)
def mask_and_pad(spark, sf):
    return _masked(spark, sf).select(
        "doc_id",
        "skip_reason",
        _ids_md5(F.col("input_ids")).alias("input_md5"),
        _ids_md5(F.col("labels")).alias("labels_md5"),
    )


@query(
    "mask_skip_counts",
    _MASKED_SQL
    + """select coalesce(skip_reason, 'built') as outcome, count(*) as n from masked group by 1""",
)
def mask_skip_counts(spark, sf):
    from distaff.operators.filters import with_skip_counts

    return with_skip_counts(_masked(spark, sf), F.col("skip_reason"))


@query(
    "uniform_length_check",
    _MASKED_SQL
    + """, built as (select * from masked where skip_reason is null)
select 'input_ids' as column_name, min(len(input_ids)) as shortest, max(len(input_ids)) as longest,
  count(*) filter (len(input_ids) <> 768) as n_off from built
union all select 'labels', min(len(labels)), max(len(labels)),
  count(*) filter (len(labels) <> 768) from built""",
)
def uniform_length_check(spark, sf):
    built = _masked(spark, sf).filter("skip_reason IS NULL")
    return tokens.uniform_length_check(built, ["input_ids", "labels"], 768)


@query(
    "length_filter",
    f"""select doc_id, len({_WORDS.format('text')}) as n_tokens from documents
where len({_WORDS.format('text')}) <= 768""",
)
def length_filter(spark, sf):
    encoded = _docs(spark, sf).select("doc_id", tokens.words(F.col("text")).alias("ids"))
    return tokens.length_filter(encoded, "ids").select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens")
    )


_BATCHES_SQL = f"""with numbered as (
  select doc_id, list_transform({_WORDS.format('text')}, lambda w: {_STAND_IN_SQL})[:512] as ids,
    row_number() over (order by doc_id) - 1 as position from documents),
batched as (select *, position // 8 as batch_id, position % 8 as slot from numbered),
sized as (select *, max(len(ids)) over (partition by batch_id) as width from batched)
"""


@query(
    "truncate_and_pad_batch",
    _BATCHES_SQL
    + """select doc_id, batch_id, slot, width,
  md5(array_to_string(ids || list_transform(range(width - len(ids)), lambda i: 0), ','))
    as input_md5,
  md5(array_to_string(ids || list_transform(range(width - len(ids)), lambda i: -100), ','))
    as labels_md5
from sized""",
)
def truncate_and_pad_batch(spark, sf):
    """Only keys and lengths are numbered and put into batches; texts meet their batch once."""
    docs = _docs(spark, sf)
    sizes = docs.select("doc_id", F.size(tokens.words(F.col("text"))).alias("n_tokens"))
    batches = tokens.batch_widths(ordering.micro_batches(sizes, 8, False, "doc_id"), "n_tokens")
    batched = docs.join(batches, "doc_id").withColumn("token_ids", _stand_in_ids(F.col("text")))
    padded = tokens.truncate_and_pad_batch(batched, mask="pad", width="width")
    return padded.select(
        "doc_id",
        "batch_id",
        "slot",
        F.col("width").cast("bigint").alias("width"),
        _ids_md5(F.col("input_ids")).alias("input_md5"),
        _ids_md5(F.col("labels")).alias("labels_md5"),
    )


@query(
    "micro_batches",
    """with numbered as (
  select event_id, row_number() over (order by event_id) - 1 as position,
    count(*) over () as n from events)
select event_id, position, position // 7 as batch_id, position % 7 as slot from numbered
where position // 7 < n // 7""",
)
def micro_batches(spark, sf):
    events = table(spark, sf, "events").select("event_id")
    return ordering.micro_batches(events, 7, True, "event_id")


@query(
    "stable_index",
    """select doc_id, row_number() over (order by md5(text), doc_id) - 1 as position
from documents""",
)
def stable_index(spark, sf):
    """Dense positions in an order unrelated to the file's."""
    keyed = _docs(spark, sf).select("doc_id", F.md5("text").alias("content"))
    return ordering.dense_index(keyed, "content", "doc_id").select("doc_id", "position")


# ---- lengths and budgets

_PCT = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
_PCT_SQL = ", ".join(
    f"list_sort(list(w))[cast(least(floor(count(*) * {p}e0), count(*) - 1) as bigint) + 1] as {n}"
    for n, p in _PCT.items()
)


@query(
    "length_stats",
    f"""with lengths as (select lang, len({_WORDS.format('text')}) as w from documents)
select lang, count(*) as n, min(w) as min, max(w) as max, round(avg(w), 6) as mean, {_PCT_SQL}
from lengths group by lang
union all
select 'all', count(*), min(w), max(w), round(avg(w), 6), {_PCT_SQL} from lengths""",
)
def length_stats(spark, sf):
    lengths = _docs(spark, sf, "lang").select(
        "lang", F.size(tokens.words(F.col("text"))).cast("bigint").alias("w")
    )
    stats = quality.length_stats_with_total(lengths, F.col("w"), "lang", "all")
    return stats.withColumn("mean", F.round("mean", 6))


@query(
    "generation_budget",
    """select max(length(second)) as longest,
  cast(ceil(max(length(second)) * 1.15e0 / 8) * 8 as bigint) as max_new_tokens
from (select case when event_id % 2 = 0
        then '{"name":"' || event_type || '","arguments":' || props || '}'
        else 'Which ' || event_type || ' do you mean?' end as second from events)""",
)
def generation_budget(spark, sf):
    replies = chat_corpus(spark, sf).select(
        F.length(turn(1, "value")).cast("bigint").alias("length")
    )
    return quality.generation_budget(replies, F.col("length"), 0.15, 8)


@query(
    "share_over_cap",
    f"""select count(*) as n, count(*) filter (len({_WORDS.format('text')}) > 768) as n_over,
  round(100e0 * count(*) filter (len({_WORDS.format('text')}) > 768) / count(*), 1) as over_pct
from documents""",
)
def share_over_cap(spark, sf):
    return quality.share_over_cap(_docs(spark, sf), F.size(tokens.words(F.col("text"))), 768)


@query(
    "steps_plan",
    """select count(*) as n_examples, count(*) // 8 as full_steps, count(*) % 8 as rows_left
from events""",
)
def steps_plan(spark, sf):
    return quality.steps_plan(table(spark, sf, "events"), 1, 8)


# ---- distributions and losses


@query(
    "log_softmax",
    twins.with_ctes(twins.POSITIONS, twins.logprobs(2.0))
    + "select vec_id, token_id, round(lt, 6) as logprob from lp",
)
def soft_logprobs(spark, sf):
    rows = positions(spark, sf).select("vec_id", log_softmax(F.col("teacher"), 2.0).alias("lp"))
    return rows.select("vec_id", F.posexplode("lp").alias("token_id", "logprob")).withColumn(
        "logprob", F.round("logprob", 6)
    )


_PER_POSITION = """, per_position as (
  select vec_id, any_value(label) as label, sum(exp(lt) * (lt - ls)) as kl
  from lp group by vec_id)
"""


@query(
    "kl_positions",
    (twins.with_ctes(twins.POSITIONS, twins.logprobs(2.0)) + _PER_POSITION)
    + "select vec_id, round(kl, 8) as kl from per_position",
)
def kl_positions(spark, sf):
    return positions(spark, sf).select("vec_id", F.round(losses.divergence(2.0), 8).alias("kl"))


@query(
    "kl_forward",
    (twins.with_ctes(twins.POSITIONS, twins.logprobs(2.0)) + _PER_POSITION)
    + "select round(4 * avg(kl), 6) as kl from per_position where label <> -100",
)
def kl_forward(spark, sf):
    return losses.kl_forward(positions(spark, sf), 2.0).withColumn("kl", F.round("kl", 6))


@query(
    "cross_entropy",
    twins.with_ctes(twins.POSITIONS, twins.logprobs(1.0))
    + "select round(avg(-ls), 6) as ce from lp where label = token_id",
)
def cross_entropy(spark, sf):
    return losses.cross_entropy(positions(spark, sf)).withColumn("ce", F.round("ce", 6))


@query(
    "causal_shift",
    """with steps as (
  select vec_id // 8 as seq, vec_id % 8 as pos,
    case when vec_id % 5 = 0 then -100 else cast(vec_id % 64 as integer) end as label
  from embeddings),
shifted as (
  select seq, pos, lead(label) over (partition by seq order by pos) as label from steps)
select * from shifted where label is not null""",
)
def causal_shift(spark, sf):
    """Sequences of eight neighbouring vectors."""
    label = F.when(F.col("vec_id") % 5 == 0, -100).otherwise((F.col("vec_id") % 64).cast("int"))
    steps = table(spark, sf, "embeddings").select(
        F.floor(F.col("vec_id") / 8).alias("seq"),
        (F.col("vec_id") % 8).alias("pos"),
        label.alias("label"),
    )
    return losses.causal_shift_long(steps)


@query(
    "truncate_vocab",
    """select vec_id, len(embedding[:48]) as width,
  round(list_sum(embedding[:48]::double[]), 6) as total from embeddings""",
)
def truncate_vocab(spark, sf):
    cut = losses.truncate_vocab(table(spark, sf, "embeddings"), 48, "embedding")
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return cut.select(
        "vec_id",
        F.size("embedding").cast("bigint").alias("width"),
        F.round(total, 6).alias("total"),
    )


def _loss_ctes(temperature, tag):
    return f"""
norms{tag} as (
  select vec_id, ln(sum(exp(t / {temperature}e0))) as zt, ln(sum(exp(s / {temperature}e0))) as zs
  from entries group by vec_id),
lp{tag} as (
  select e.vec_id, e.label, e.token_id, e.t / {temperature}e0 - n.zt as lt,
         e.s / {temperature}e0 - n.zs as ls
  from entries e join norms{tag} n on e.vec_id = n.vec_id),
kl{tag} as (
  select avg(kl) * {temperature}e0 * {temperature}e0 as kd from (
    select sum(exp(lt) * (lt - ls)) as kl from lp{tag} where label <> -100 group by vec_id))"""


_CE = """
hard as (select avg(-ls) as ce from lp1 where label = token_id)"""


@query(
    "kd_loss",
    twins.with_ctes(twins.POSITIONS, _loss_ctes(1.0, 1), _loss_ctes(2.0, 2), _CE)
    + """select round(kd, 6) as kd, round(ce, 6) as ce, round(0.7e0 * kd + 0.3e0 * ce, 6) as loss
from kl2, hard""",
)
def kd_loss(spark, sf):
    loss = losses.kd_loss(positions(spark, sf), 2.0, 0.7)
    return loss.select(*[F.round(c, 6).alias(c) for c in ("kd", "ce", "loss")])


@query(
    "sweep_grid",
    twins.with_ctes(
        twins.POSITIONS, _loss_ctes(1.0, 1), _loss_ctes(2.0, 2), _loss_ctes(4.0, 4), _CE,
        """
soft as (select 1e0 as temperature, kd from kl1 union all select 2e0, kd from kl2
  union all select 4e0, kd from kl4),
alphas as (select unnest([0e0, 0.5e0, 0.9e0]) as alpha_soft)""",
    )
    + """select temperature, alpha_soft, round(kd, 6) as kd, round(ce, 6) as ce,
  round(alpha_soft * kd + (1 - alpha_soft) * ce, 6) as loss from soft, alphas, hard""",
)
def sweep_grid(spark, sf):
    grid = losses.sweep_grid(positions(spark, sf))
    return grid.withColumns({c: F.round(c, 6) for c in ("kd", "ce", "loss")})


_JSD = """, mixed as (
  select b.beta, p.vec_id, p.lt, p.ls, ln(b.beta * exp(p.lt) + (1 - b.beta) * exp(p.ls)) as lm
  from lp p, (select unnest([0e0, 0.5e0, 1e0]) as beta) b where p.label <> -100),
per_position as (
  select beta, vec_id, case when beta = 0 then sum(exp(lt) * (lt - ls))
    when beta = 1 then sum(exp(ls) * (ls - lt))
    else sum(beta * exp(lt) * (lt - lm) + (1 - beta) * exp(ls) * (ls - lm)) end as d
  from mixed group by beta, vec_id)
select beta, round(avg(d), 6) as jsd from per_position group by beta"""


@query("generalized_jsd", twins.with_ctes(twins.POSITIONS, twins.logprobs(1.0)) + _JSD)
def generalized_jsd(spark, sf):
    rows = positions(spark, sf).filter(losses.counted())
    betas = (0.0, 0.5, 1.0)
    parts = rows.agg(
        *[F.avg(losses.divergence(1.0, b)).alias(f"jsd_{i}") for i, b in enumerate(betas)]
    )
    lines = F.array(
        *[
            F.struct(F.lit(b).alias("beta"), F.round(f"jsd_{i}", 6).alias("jsd"))
            for i, b in enumerate(betas)
        ]
    )
    return parts.select(F.inline(lines))


_TOP = """, ranked as (
  select vec_id, token_id, lt, row_number() over (
    partition by vec_id order by lt desc, token_id) as rank from lp)
"""
_TOP_SQL = (
    twins.with_ctes(twins.POSITIONS, twins.logprobs(1.0))
    + _TOP
    + """select vec_id, rank, token_id, round(lt, 6) as logprob from ranked where rank <= 8"""
)


def _top_rows(df):
    exploded = df.select("vec_id", F.posexplode("top").alias("i", "e"))
    return exploded.select(
        "vec_id",
        (F.col("i") + 1).alias("rank"),
        F.col("e.token_id").alias("token_id"),
        F.round("e.logprob", 6).alias("logprob"),
    )


@query("topk_logprobs", _TOP_SQL)
def topk_logprobs(spark, sf):
    return _top_rows(losses.topk_logprobs(positions(spark, sf), "teacher", 8))


@query("topk_logprobs_wide", _TOP_SQL)
def topk_logprobs_wide(spark, sf):
    return _top_rows(losses.topk_logprobs_wide(positions(spark, sf), "teacher", 8))


@query("topk_long", _TOP_SQL)
def topk_long(spark, sf):
    rows = positions(spark, sf).select("vec_id", log_softmax(F.col("teacher")).alias("lp"))
    long = rows.select("vec_id", F.posexplode("lp").alias("token_id", "logprob"))
    top = losses.topk_long(long, 8, "vec_id")
    return top.select("vec_id", "rank", "token_id", F.round("logprob", 6).alias("logprob"))


_SPARSE = """, ranked as (
  select vec_id, label, lt, ls, row_number() over (
    partition by vec_id order by lt desc, token_id) as rank from lp where label <> -100),
sparse as (
  select vec_id, sum(exp(lt) * (lt - ls)) as kl from ranked where rank <= 16 group by vec_id)
"""


def _captured(spark, sf):
    """Stored entries of the teacher beside the student's logits."""
    return losses.topk_logprobs(positions(spark, sf), "teacher", 16).select("vec_id", "label", "top", "student")


@query(
    "sparse_kl",
    twins.with_ctes(twins.POSITIONS, twins.logprobs(1.0))
    + _SPARSE
    + "select round(avg(kl), 6) as sparse_kl from sparse",
)
def sparse_kl(spark, sf):
    return losses.sparse_kl_mean(_captured(spark, sf)).withColumn("sparse_kl", F.round("sparse_kl", 6))


@query(
    "composite_loss",
    twins.with_ctes(twins.POSITIONS, twins.logprobs(1.0))
    + _SPARSE
    + """, hard as (select avg(-ls) as ce from lp where label = token_id)
select round(avg(kl), 6) as sparse_kl, round(any_value(ce), 6) as ce,
  round(0.5e0 * any_value(ce) + 0.5e0 * avg(kl), 6) as loss from sparse, hard""",
)
def composite_loss(spark, sf):
    """Cross entropy and sparse KL at equal weights, per position."""
    from distaff.functions.distributions import bind

    parts = _captured(spark, sf).filter(losses.counted()).withColumns(
        {
            "sparse_kl": bind(
                log_softmax(F.col("student")),
                lambda q: losses.sparse_kl_value(F.col("top"), q),
            ),
            "ce": losses.label_nll(),
        }
    )
    weighted = losses.composite_loss(parts, {"ce": 0.5, "sparse_kl": 0.5})
    return weighted.agg(*[F.round(F.avg(c), 6).alias(c) for c in ("sparse_kl", "ce", "loss")])
