"""Chat formatting with Spark expressions only.

A conversation becomes one string of runs, a run being the adjacent turns of
one role::

    <s>role[INST]text[/INST]text</s>

``[/INST]`` stands between the merged texts of a run. In roles and texts every
``[``, ``<`` and backslash gets a backslash behind it, so no control string can
occur there, and taking those away again restores them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distaff.functions.distributions import bind

#: Neighbours that are summed or cut out together.
BLOCK = 256
RUN_OPEN, ROLE_END, TURN_END, RUN_CLOSE = "<s>", "[INST]", "[/INST]", "</s>"


def escape(text: Column) -> Column:
    """Break every control string; ``unescape`` restores the text."""
    return F.regexp_replace(text, r"([\[<\\])", r"$1\\")


def unescape(text: Column) -> Column:
    """Inverse of ``escape``."""
    return F.regexp_replace(text, r"([\[<\\])\\", "$1")


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per ``conv_id`` with ``formatted`` and its ``loss_spans``.

    ``turns`` has (conv_id, turn, role, text); other columns are ignored. Turns
    are ordered by (turn, role, text), nulls first, repeated rows staying
    repeated; null roles and texts count as empty, and rows whose ``conv_id``
    is null form one conversation. A conversation is one row, so its turns meet
    in one task. ``loss_spans`` holds (start, chars) in code points of each
    escaped text of ``loss_role``, in order. No turns, no rows.
    """
    empty = F.lit("")
    entry = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("turns"))
    starts = ordered.withColumn(
        "starts",
        F.expr(
            "filter(transform(turns, (x, i) -> "
            "IF(i = 0 OR x.role <> get(turns, i - 1).role, i, NULL)), i -> i IS NOT NULL)"
        ),
    )
    runs = starts.withColumn(
        "runs",
        F.expr(
            "transform(starts, (s, j) -> named_struct('role', turns[s].role, 'texts', transform("
            "slice(turns, s + 1, coalesce(get(starts, j + 1), size(turns)) - s), x -> x.text)))"
        ),
    )

    def pieces(run: Column) -> Column:
        """The run cut where the loss mask may change."""
        in_loss = run["role"] == loss_role
        texts = F.transform(
            run["texts"],
            lambda text, i: F.array(
                F.struct(F.when(i > 0, F.lit(TURN_END)).otherwise("").alias("piece"), F.lit(False).alias("loss")),
                F.struct(escape(text).alias("piece"), in_loss.alias("loss")),
            ),
        )
        head = F.struct(
            F.concat(F.lit(RUN_OPEN), escape(run["role"]), F.lit(ROLE_END)).alias("piece"), F.lit(False).alias("loss")
        )
        tail = F.struct(F.lit(RUN_CLOSE).alias("piece"), F.lit(False).alias("loss"))
        return F.concat(F.array(head), F.flatten(texts), F.array(tail))

    cut = runs.withColumn("pieces", F.flatten(F.transform("runs", pieces)))
    return cut.select(
        "conv_id", F.array_join(F.col("pieces.piece"), "").alias("formatted"), _loss_spans(F.col("pieces")).alias("loss_spans")
    )


def _blocks(items: Column) -> Column:
    """An array as arrays of up to ``BLOCK`` neighbours; the last of them may be empty."""

    def cut(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(x) / BLOCK).cast("int")), lambda b: F.slice(x, b * BLOCK + 1, F.lit(BLOCK)))

    return bind(items, cut)


def _starts(lengths: Column) -> Column:
    """Sums of the lengths before each."""
    nothing = F.expr("CAST(array() AS array<int>)")
    return F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), nothing.alias("starts")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.array_append(acc["starts"], acc["at"]).alias("starts")),
        lambda acc: acc["starts"],
    )


def _loss_spans(pieces: Column) -> Column:
    """(start, chars) of the pieces under the mask.

    An array that grows is copied with every entry, so starts are summed in
    blocks of neighbours and then over the blocks.
    """
    lengths = F.transform(pieces, lambda p: F.length(p["piece"]))
    total = lambda block: F.aggregate(block, F.lit(0), lambda acc, n: acc + n)

    def flat(blocks: Column) -> Column:
        starts = F.zip_with(
            _starts(F.transform(blocks, total)), blocks, lambda base, block: F.transform(_starts(block), lambda at: base + at)
        )
        return F.flatten(starts)

    starts = bind(_blocks(lengths), flat)
    spans = F.arrays_zip(starts.alias("start"), lengths.alias("chars"), F.transform(pieces, lambda p: p["loss"]).alias("loss"))
    kept = F.filter(spans, lambda x: x["loss"])
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["chars"].alias("chars")))


def read_back(formatted: Column) -> Column:
    """Turns, array of (role, text), of a formatted conversation."""
    runs = F.filter(F.split(formatted, RUN_CLOSE), lambda run: run != "")

    def turns(run: Column) -> Column:
        role = F.substring_index(run, ROLE_END, 1)
        body = F.substring(run, F.length(role) + F.lit(len(ROLE_END) + 1), F.length(run))
        return F.transform(
            F.split(body, r"\[/INST\]"),
            lambda text: F.struct(
                unescape(F.substring(role, F.lit(len(RUN_OPEN) + 1), F.length(role))).alias("role"),
                unescape(text).alias("text"),
            ),
        )

    return F.flatten(F.transform(runs, turns))


def under_mask(formatted: Column, spans: Column) -> Column:
    """All text below the loss mask, unescaped, nothing between.

    A substring is counted off from the beginning of its string, so a stretch
    that holds many neighbouring spans is cut out first.
    """

    def within(text: Column, block: Column) -> Column:
        first, last = F.get(block, F.lit(0)), F.try_element_at(block, F.lit(-1))
        stretch = F.substring(text, first["start"] + 1, last["start"] + last["chars"] - first["start"])
        return bind(
            stretch,
            lambda cut: F.array_join(F.transform(block, lambda s: unescape(F.substring(cut, s["start"] - first["start"] + 1, s["chars"]))), ""),
        )

    return bind(formatted, lambda text: F.array_join(F.transform(_blocks(spans), lambda block: within(text, block)), ""))
