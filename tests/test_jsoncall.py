"""Strict JSON reading against Python's reader on edge rows."""

import json
import re

import pytest
from pyspark.sql import functions as F

from distaff.functions.jsoncall import (
    END_MARKER,
    extract_json,
    json_block,
    parse_document,
    with_call_fields,
)

AGREEING = [
    '{"name":"f","arguments":{"a":1}}',
    'Sure! {"name":"f","arguments":{}} as asked.',
    '```json\n{\n  "name": "f",\n  "arguments": {"a": "b"}\n}\n```',
    '{"name":"a"} and {"name":"b"}',
    '{"a":1},{"b":2}',
    '{"a":1}] }',
    '{"a":1}}',
    '{"name":"f","arguments":',
    "no json at all",
    "",
    "{}",
    '{"a":1,}',
    "{'a': 1}",
    '{"a":1,"a":2}',
    '[{"name":"f"}]',
    '[{"name":"f"},{"name":"g"}]',
    '{"name":null}',
    '{"name":"a } b"}',
    '{"name":"a\tb"}',
    '{"a":01}',
    '{"a":1.0}',
    '{"a":true}',
    '{"a":[[1],[2,3]]}',
    '{"name":"f","arguments":[]}',
    '{"name":"f","arguments":"x"}',
    '{"name":"f","arguments":null}',
    '{"a":1} // note {"b"}',
    '{"a" 1}',
    "{",
    "} {",
    '{"a":"\\ud83d\\ude00"}',
    '{"a":"\\x"}',
    '  {"name" : "f"}  ',
    '{"a":-}',
    '{"a":.5}',
    '{"a":nul}',
]


def python_fields(text):
    found = re.search(r"\{.*\}", text, re.DOTALL)
    try:
        parsed = json.loads(found.group(0)) if found else None
    except ValueError:
        parsed = None
    if parsed is None:
        return (False, False, False)
    return (True, "name" in parsed, isinstance(parsed.get("arguments"), dict))


@pytest.mark.parametrize("exact", [False, True])
def test_edge_rows(spark, exact):
    df = spark.createDataFrame(list(enumerate(AGREEING)), "i int, completion string")
    rows = with_call_fields(df, "completion", exact=exact).collect()
    got = {
        r.i: (r.call.any_json, r.call.has_name, r.call.arguments_is_object) for r in rows
    }
    expected = {i: python_fields(t) for i, t in enumerate(AGREEING)}
    assert {AGREEING[i]: v for i, v in got.items()} == {AGREEING[i]: v for i, v in expected.items()}


def test_values_are_canonical(spark):
    df = spark.createDataFrame(
        [('{"arguments":{"b":[1.0,2.50],"a":{"z":1,"y":null}},"name":"f"}',)], "completion string"
    )
    native = with_call_fields(df, "completion").first().call
    exact = with_call_fields(df, "completion", exact=True).first().call
    assert native.arguments == exact.arguments == '{"a":{"y":null,"z":1},"b":[1,2.5]}'
    assert native.name == exact.name == '"f"'


def test_documented_differences(spark):
    """Where only the exact reading follows Python."""
    texts = ['{"name":"f","arguments":{"a":NaN}}', '{"name":"f","arguments":{"a":1e0}}']
    df = spark.createDataFrame([(t,) for t in texts], "completion string")
    native = [r.call for r in with_call_fields(df, "completion").collect()]
    exact = [r.call for r in with_call_fields(df, "completion", exact=True).collect()]
    assert [c.any_json for c in native] == [False, True]
    assert [c.any_json for c in exact] == [True, True]
    assert native[1].arguments == '{"a":1.0}' and exact[1].arguments == '{"a":1}'


def test_nulls_and_marker(spark):
    texts = [None, f'{{"a":1}},"{END_MARKER}"', '{"a":"}"}']
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    rows = df.select(
        F.to_json(extract_json(F.col("c"))).alias("v"), json_block(F.col("c")).alias("b")
    ).collect()
    assert [r.v for r in rows] == [None, '{"a":1}', '{"a":"}"}']
    assert rows[0].b is None


def test_whole_documents(spark):
    texts = ['{"a":1}', '{"a":1} x', '{"a":1},{"b":2}', "[1]", ' {"a":1} ', "", '"s"']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    got = {r.i: r.v for r in df.select("i", F.to_json(parse_document(F.col("c"))).alias("v")).collect()}

    def loads(t):
        try:
            return json.dumps(json.loads(t), separators=(",", ":"))
        except ValueError:
            return None

    assert got == {i: loads(t) for i, t in enumerate(texts)}
