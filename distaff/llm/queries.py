"""Registered queries over the training data tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distaff.llm import (
    chat_format,
    decontaminate,
    filter_interactions,
    html_extract,
    lattice_lm,
    mixing,
    pruned_graph,
    quality,
    simhash,
    source_divergence,
    substring_dedup,
    topk_search,
    toxicity,
)
from distaff.llm.common import read_table
from distaff.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(spark, sf_dir)`` and its SQL twin."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return build

    return register


BENCHMARK_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    """Toxicity of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels")))


@query(
    "op2_decontaminate",
    sql=f"""
    WITH item AS (
      SELECT DISTINCT item_id, w, least(10, len(w)) AS n
      FROM (SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{BENCHMARK_WORDS}') AS w FROM benchmark)
      WHERE len(w) > 0),
    win AS (
      SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS words
      FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM item)),
    doc AS (
      SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{BENCHMARK_WORDS}'), []) AS w
      FROM documents),
    lens AS (SELECT DISTINCT n FROM item),
    dwin AS (
      SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS words
      FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lens WHERE len(w) >= n)),
    hit AS (SELECT d.doc_id, d.i, d.n, w.item_id FROM dwin d JOIN win w ON d.n = w.n AND d.words = w.words),
    pos AS (
      SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
    ids AS (
      SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS list
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit,
           coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.list, '')) AS items_sha256,
           p.n_hit IS NOT NULL AS contaminated
    FROM doc d LEFT JOIN pos p USING (doc_id) LEFT JOIN ids i USING (doc_id)""",
)
def op2_decontaminate(spark, sf_dir):
    """Every document with what it holds of the benchmark."""
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


PROBE = "</s>[INST] ok [/INST]"


@query(
    "op3_chat_format",
    sql=f"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
    r AS (
      SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) <> role, true) AS opens,
             length(regexp_replace(text, '[\\[<\\\\]', 'xx', 'g')) AS t_len,
             length(regexp_replace(role, '[\\[<\\\\]', 'xx', 'g')) AS r_len
      FROM t)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(t_len + CASE WHEN opens THEN r_len + 13 ELSE 7 END) AS BIGINT) AS formatted_chars
    FROM r GROUP BY conv_id""",
)
def op3_chat_format(spark, sf_dir):
    """Formatted conversations, digested from what is read back from the output."""
    probe = spark.createDataFrame(
        [(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id bigint, turn bigint, role string, text string"
    )
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    out = (
        chat_format.format_conversations(turns)
        .withColumn("turns", chat_format.read_back(F.col("formatted")))
        .withColumn("loss", chat_format.under_mask(F.col("formatted"), F.col("loss_spans")))
    )
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query("op4_quality")
def op4_quality(spark, sf_dir):
    """Quality of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, read_table(spark, sf_dir, "labels")))


@query("op5_mixing")
def op5_mixing(spark, sf_dir):
    """What the mix takes of every document."""
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op6_substring_dedup",
    sql=r"""
    WITH doc AS (
      SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    win AS (
      SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS words
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM doc)),
    late AS (
      SELECT doc_id, i FROM (
        SELECT doc_id, i, min((doc_id, i)) OVER (PARTITION BY words) AS f FROM win) WHERE (doc_id, i) > f),
    gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM late) GROUP BY doc_id),
    kept AS (
      SELECT d.doc_id, count(*) AS n_kept, string_agg(d.x, ' ' ORDER BY d.p) AS words
      FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM doc) d
      ANTI JOIN (SELECT doc_id, unnest(ps) AS p FROM gone) g ON d.doc_id = g.doc_id AND d.p = g.p
      GROUP BY d.doc_id)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, len(d.w) - coalesce(k.n_kept, 0) AS n_removed,
           sha256(coalesce(k.words, '')) AS kept_sha256
    FROM doc d LEFT JOIN kept k USING (doc_id)""",
)
def op6_substring_dedup(spark, sf_dir):
    """Every document without the passages that start earlier elsewhere."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op7_html_extract")
def op7_html_extract(spark, sf_dir):
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages")
    found = html_extract.extract(pages, html_extract.fit_extractor(pages))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query("op8_simhash")
def op8_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op9_lattice_lm")
def op9_lattice_lm(spark, sf_dir):
    """Log probability of every text."""
    return lattice_lm.score_documents(read_table(spark, sf_dir, "documents"))


@query(
    "op10_topk",
    sql="""
    WITH v AS (
      SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
      WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (
      SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[]) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 20""",
)
def op10_topk(spark, sf_dir):
    """The 20 best inner products of every query vector."""
    vectors = topk_search.integer_vectors(read_table(spark, sf_dir, "embeddings"))
    return topk_search.top_k(vectors.filter(F.col("vec_id") % 20 == 0), vectors, k=20)


@query(
    "op11_divergence",
    sql=f"""
    WITH d AS (
      SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
      FROM documents),
    t AS (SELECT lang, source, r, unnest(w) AS term FROM d),
    k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
    g AS (SELECT DISTINCT lang, source FROM d),
    x AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
    c AS (
      SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(x.n, 0) AS n
      FROM g JOIN k USING (lang) LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
    s AS (
      SELECT lang, source, term, n,
             CAST(1 + (1000000000 * CAST(n + 1 AS HUGEINT)) // (sum(n) OVER w + count(*) OVER w) AS BIGINT) AS p,
             CAST(1 + (1000000000 * CAST(lang_n + 1 AS HUGEINT)) // (sum(lang_n) OVER w + count(*) OVER w) AS BIGINT) AS q
      FROM c WINDOW w AS (PARTITION BY lang, source)),
    sums AS (
      SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
      FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    rows AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM s WHERE n > 0 AND p > q),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM rows)
    SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
)
def op11_divergence(spark, sf_dir):
    """Distances between the sources of each language and the terms that mark them."""
    return source_divergence.source_divergence(read_table(spark, sf_dir, "documents"))


@query(
    "op12_filter_audit",
    sql=r"""
    WITH doc AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
             coalesce(regexp_extract_all(text, '[^ 	-
]+'), []) AS w,
             min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
      FROM documents),
    lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    f AS (
      SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
              100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
              regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fails
      FROM doc LEFT JOIN lab USING (doc_id)),
    m AS (
      SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f GROUP BY part, fails),
    one AS (SELECT unnest(range(1, 6)) AS i),
    perm AS (
      SELECT [a.i, b.i, c.i, d.i, e.i] AS p FROM one a, one b, one c, one d, one e
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
    steps AS (SELECT p, array_to_string([substr('ABCDE', x, 1) FOR x IN p], '') AS filter_order, unnest(range(1, 6)) AS step FROM perm),
    seen AS (
      SELECT m.part, s.filter_order, s.step, p[s.step] AS f, m.n, m.good, m.toxic, fails[p[s.step]] AS fail,
             len([x FOR x IN p[1 : s.step - 1] IF fails[x]]) > 0 AS gone, len([x FOR x IN fails IF x]) AS n_fails
      FROM m, steps s),
    audit AS (
      SELECT part, filter_order, step, f,
             CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fail), 0) AS BIGINT) AS kept,
             CAST(coalesce(sum(n) FILTER (NOT gone AND fail), 0) AS BIGINT) AS removed,
             CAST(coalesce(sum(n) FILTER (gone AND fail), 0) AS BIGINT) AS redundant,
             CAST(coalesce(sum(n) FILTER (fail AND n_fails = 1), 0) AS BIGINT) AS unique_fails,
             CAST(coalesce(sum(good) FILTER (NOT gone AND fail), 0) AS BIGINT) AS good_lost,
             CAST(coalesce(sum(toxic) FILTER (NOT gone AND fail), 0) AS BIGINT) AS toxic_lost
      FROM seen GROUP BY part, filter_order, step, f)
    SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
    FROM audit""",
)
def op12_filter_audit(spark, sf_dir):
    """Five filters in all 120 orders, for each source."""
    return filter_interactions.filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op13_ann")
def op13_ann(spark, sf_dir):
    """The five nearest found of every query vector."""
    vectors = pruned_graph.usable_vectors(read_table(spark, sf_dir, "embeddings"))
    index = pruned_graph.build_index(vectors, k=5)
    return pruned_graph.nearest(vectors.filter(F.col("vec_id") % 50 == 0), index, k=5)
