"""Strict JSON reading of model output, as column expressions.

``try_parse_json`` ignores text after the first document. Appending a marker
element to an array around the text makes leftover text visible: the block is
one whole JSON document exactly when the marker is element 1.

The native reading differs from Python's ``json`` only for ``NaN``/``Infinity``
(null here), numbers beyond double range or 38 digits, exponent spellings
(``1e0`` is not ``1``) and lone surrogates. ``with_call_fields(exact=True)``
reads with Python's ``json`` in Arrow batches where those matter.
"""

import json
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Drawn anew by each driver, so that no text can hold it on purpose.
END_MARKER = f"<<end-of-document-{uuid.uuid4().hex}>>"

CALL_FIELDS = T.StructType(
    [
        T.StructField("any_json", T.BooleanType()),
        T.StructField("has_name", T.BooleanType()),
        T.StructField("name", T.StringType()),
        T.StructField("arguments", T.StringType()),
        T.StructField("arguments_is_object", T.BooleanType()),
    ]
)


def json_block(text: Column) -> Column:
    """From the first ``{`` to the last ``}``, across lines; not JSON if none.

    Text without a brace is null at once, which spares plain replies the
    parser's exception. Both ends are looked up once, so that many opening
    braces without a closing one cost no more than others.
    """
    first = F.locate("{", text)
    last = F.length(text) - F.locate("}", F.reverse(text)) + 1
    block = F.when(
        F.contains(text, F.lit("}")) & (last > first), F.substring(text, first, last - first + 1)
    ).otherwise("")
    return F.when(first > 0, block)


def _marked(text: Column) -> Column:
    """Variant of ``[text, marker]``, null if that is not JSON."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{END_MARKER}"]')))


def _closed(marked: Column) -> Column:
    """The marker is element 1: the text was exactly one document."""
    found = F.try_variant_get(marked, "$[1]", "string") == END_MARKER
    return F.coalesce(found, F.lit(False))


def parse_document(text: Column) -> Column:
    """Variant of ``text`` if all of it is one JSON document, else null."""
    marked = _marked(text)
    return F.when(_closed(marked), F.try_variant_get(marked, "$[0]", "variant"))


def extract_json(text: Column) -> Column:
    """Variant of the JSON block inside ``text``, or null."""
    return parse_document(json_block(text))


def fence(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once a row, whatever reads or filters them later.

    Spark puts an expression in place of its name when it merges projections
    or pushes a filter below them, once for every use. A generator of one row
    is not merged and no filter on its output passes it.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[v.alias(c) for c, v in columns.items()]))))


def _with_fields(df: DataFrame, block: Column, name: str) -> DataFrame:
    kept = [f"`{c}`" for c in df.columns if c != name]
    read = (
        df.withColumn("_marked", _marked(block))
        .selectExpr(
            *kept,
            f"coalesce(try_variant_get(_marked, '$[1]', 'string') = '{END_MARKER}', false)"
            " AS _closed",
            "try_variant_get(_marked, '$[0].name', 'variant') AS _name",
            "try_variant_get(_marked, '$[0].arguments', 'variant') AS _args",
        )
    )
    fields = F.expr(
        """named_struct(
             'any_json', _closed,
             'has_name', _closed AND _name IS NOT NULL,
             'name', CASE WHEN _closed THEN to_json(_name) END,
             'arguments', CASE WHEN _closed THEN to_json(_args) END,
             'arguments_is_object',
               _closed AND try_cast(_args AS map<string,variant>) IS NOT NULL)"""
    )
    return fence(read, **{name: fields}).selectExpr(*kept, f"`{name}`")


def with_call_fields(df: DataFrame, text: str, name: str = "call", exact: bool = False) -> DataFrame:
    """Add the call fields of free model output as one struct column.

    ``name`` and ``arguments`` inside it are canonical JSON: ``to_json`` of a
    variant sorts object keys and prints ``1.0`` as ``1``, so string equality
    is deep equality. Absent keys are null, JSON nulls are the text ``null``.
    ``exact`` reads with Python's ``json``.
    """
    if exact:
        return df.withColumn(name, _exact_fields(json_block(F.col(text))))
    block = json_block(F.col("_text"))
    return _with_fields(fence(df, _text=F.col(text)), block, name).drop("_text")


def with_document_fields(
    df: DataFrame, text: Column, name: str = "call", exact: bool = False
) -> DataFrame:
    """Call fields of text that should be one JSON document and nothing else.

    Texts that are compared must be read the same way: the two readers do not
    spell every value alike.
    """
    return df.withColumn(name, _exact_fields(text)) if exact else _with_fields(df, text, name)


def _python_number(value):
    # Python compares True == 1 and 1.0 == 1; one spelling per value.
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float) and value.is_integer():
        return int(value)
    if isinstance(value, list):
        return [_python_number(v) for v in value]
    if isinstance(value, dict):
        return {k: _python_number(v) for k, v in value.items()}
    return value


def _python_fields(block):
    empty = (False, False, None, None, False)
    if block is None:
        return empty
    try:
        parsed = json.loads(block)
    except ValueError:
        return empty
    if not isinstance(parsed, dict):
        return (True, False, None, None, False)

    def canonical(key):
        if key not in parsed:
            return None
        return json.dumps(_python_number(parsed[key]), sort_keys=True, separators=(",", ":"))

    arguments = canonical("arguments")
    return (
        True,
        "name" in parsed,
        canonical("name"),
        arguments,
        isinstance(parsed.get("arguments"), dict),
    )


@F.pandas_udf(CALL_FIELDS)
def _exact_fields(blocks: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(
        [_python_fields(b) for b in blocks],
        columns=CALL_FIELDS.fieldNames(),
    )
