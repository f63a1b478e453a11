"""Message building and rendering on hand-made conversations."""

import json

import pytest

from distaff.constants import CAPTURE_ROLES, SYSTEM_TEMPLATE, TOOLS_SLOT
from distaff.operators import filters, prompts
from distaff.sources import corpus

TOOLS = '[{"name": "f", "parameters": {"city": "Zürich", "n": [1, 2], "e": {}, "l": []}}]'


def messages(df):
    return {r.example_id: [(m.role, m.content) for m in r.messages] for r in df.collect()}


def test_system_prompt_is_python_layout(chats):
    rows = [
        ("a", TOOLS, []),
        ("b", None, []),
        ("c", "", []),
        ("d", "[]", []),
        ("e", "[not json", []),
        ("f", TOOLS, []),
    ]
    got = {r.example_id: r.system_prompt for r in prompts.with_system_prompt(chats(rows)).collect()}

    def shown(tools):
        return SYSTEM_TEMPLATE.replace(TOOLS_SLOT, json.dumps(json.loads(tools), indent=2))

    assert got["a"] == got["f"] == shown(TOOLS)
    assert got["b"] == got["c"] == got["d"] == shown("[]")
    assert got["e"] is None


def test_with_tools(chats):
    df = chats([("a", "[]", []), ("b", "", []), ("c", None, []), ("d", "[1]", [])])
    assert [r.example_id for r in filters.with_tools(df).collect()] == ["d"]


def test_role_policies(spark, chats):
    df = chats([("a", "", [("human", "x"), ("robot", "y")]), ("b", "", [("system", "s")])])
    assert messages(prompts.map_roles(df)) == {
        "a": [("user", "x"), ("robot", "y")],
        "b": [("system", "s")],
    }
    assert list(messages(prompts.map_roles(df, on_unknown="skip"))) == ["b"]
    with pytest.raises(Exception, match="unknown role: robot"):
        prompts.map_roles(df, on_unknown="error").collect()
    with pytest.raises(ValueError):
        prompts.map_roles(df, on_unknown="guess")


def test_full_dialogue(chats):
    turns = [
        ("human", "q"),
        ("function_call", "{}"),
        ("observation", "42"),
        ("gpt", "done"),
    ]
    got = messages(prompts.full_dialogue(chats([("a", "[]", turns)])))["a"]
    assert [r for r, _ in got] == ["system", "user", "assistant", "user", "assistant"]
    assert got[3] == ("user", "FUNCTION RESPONSE: 42")
    with pytest.raises(Exception, match="unknown role: tool"):
        prompts.full_dialogue(chats([("a", "[]", [("tool", "x")])])).collect()


ROWS = [
    ("ok", "[]", [("human", "q"), ("gpt", "r"), ("human", "more")]),
    ("call", "[]", [("human", "q"), ("function_call", "{}")]),
    ("obs", "[]", [("human", "q"), ("observation", "o")]),
    ("resp", "[]", [("human", "q"), ("function_response", "o")]),
    ("again", "[]", [("human", "q"), ("human", "q2")]),
    ("gpt", "[]", [("gpt", "q"), ("human", "q2")]),
    ("one", "[]", [("human", "q")]),
    ("none", "[]", []),
    ("null", "[]", None),
]


def test_triples(chats):
    got = messages(prompts.triple_messages(chats(ROWS)))
    assert set(got) == {"ok", "call", "again"}
    assert got["call"][1:] == [("user", "q"), ("assistant", "{}")]
    wide = messages(prompts.triple_messages(chats(ROWS), CAPTURE_ROLES))
    assert set(wide) == {"ok", "call", "again", "resp"} and wide["resp"][2] == ("tool", "o")
    narrow = messages(prompts.triple_messages(chats(ROWS), target_roles=["gpt", "function_call"]))
    assert set(narrow) == {"ok", "call"}


def test_skip_counts_add_up(chats):
    df = chats(ROWS)
    counts = filters.with_skip_counts(df, prompts.triple_skip_reason()).collect()
    assert {r.outcome: r.n for r in counts} == {
        "built": 3,
        "reply_role": 2,
        "first_not_human": 1,
        "no_reply": 1,
        "no_turns": 2,
    }


def test_targets(chats):
    rows = [
        ("call", "[]", [("human", "q"), ("function_call", '{"name":"f","arguments":{"b":1,"a":"é"}}')]),
        ("noname", "[]", [("human", "q"), ("function_call", '{"arguments":{}}')]),
        ("broken", "[]", [("human", "q"), ("function_call", '{"name":')]),
        ("plain", "[]", [("human", "q"), ("gpt", "which?")]),
        ("obs", "[]", [("human", "q"), ("observation", "x")]),
        ("gpt", "[]", [("gpt", "q"), ("gpt", "x")]),
        ("one", "[]", [("human", "q")]),
    ]
    got = {r.example_id: r.target for r in prompts.ground_truth_target(chats(rows)).collect()}
    assert got == {
        "call": json.dumps({"name": "f", "arguments": {"b": 1, "a": "é"}}),
        "noname": None,
        "broken": None,
        "plain": "which?",
        "obs": None,
        "gpt": None,
        "one": None,
    }


def test_rendering(chats):
    df = prompts.map_roles(chats([("a", "", [("human", "x"), ("gpt", "y")])]))
    template = prompts.ChatTemplate("<{role}>", "</s>", "<assistant>")
    assert prompts.render_chat(df, template).first().text == "<user>x</s><assistant>y</s>"
    asked = prompts.render_chat(df, template, add_generation_prompt=True)
    assert asked.first().text.endswith("y</s><assistant>")


def test_example_ids_number_copies(spark, tmp_path):
    texts = ["a"] * 7 + ["b"] * 3 + ["c"] + [None] * 4
    path = str(tmp_path / "texts")
    spark.createDataFrame([(t,) for t in texts], "text string").repartition(4).write.option(
        "ignoreNullFields", "false"
    ).json(path)
    read = corpus.read_chat_corpus(spark, path, "json", schema=corpus.TEXT_SCHEMA)
    rows = read.collect()
    assert len({r.example_id for r in rows}) == len(texts)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text, []).append(int(r.example_id.rsplit("-", 1)[1]))
    assert {t: sorted(v) for t, v in by_text.items()} == {
        "a": list(range(1, 8)),
        "b": [1, 2, 3],
        "c": [1],
        None: [1, 2, 3, 4],
    }
    other = str(tmp_path / "other")
    read.select("text").coalesce(1).write.option("ignoreNullFields", "false").json(other)
    again = corpus.read_chat_corpus(spark, other, "json", schema=corpus.TEXT_SCHEMA)
    assert {r.example_id for r in again.collect()} == {r.example_id for r in rows}


def test_source_key_is_used(spark, tmp_path):
    path = str(tmp_path / "chats")
    spark.createDataFrame([("k1", "[]"), ("k2", "[]")], "id string, tools string").write.json(path)
    read = corpus.read_chat_corpus(spark, path, "json", key="id")
    assert {r.example_id for r in read.collect()} == {"k1", "k2"}


def test_rows_without_tools_or_content_are_counted_not_shortened(spark, chats):
    df = chats(
        [
            ("ok", "[]", [("human", "a"), ("gpt", "b")]),
            ("bad tools", "{", [("human", "a"), ("gpt", "b")]),
            ("null reply", "[]", [("human", "a"), ("gpt", None)]),
            ("null prompt", None, [("human", None), ("gpt", "b")]),
        ]
    )
    reasons = {r.example_id: r.why for r in df.select("example_id", prompts.triple_skip_reason().alias("why")).collect()}
    assert reasons == {"ok": None, "bad tools": "tools_not_json", "null reply": "empty_content", "null prompt": "empty_content"}
    for built in (prompts.triple_messages(df), prompts.full_dialogue(df), prompts.target_messages(df)):
        assert [r.example_id for r in built.collect()] == ["ok"]
    assert {r.example_id for r in prompts.prompt_messages(df).collect()} == {"ok", "null reply"}


def test_a_null_message_fails_instead_of_shrinking_the_text(spark):
    df = spark.createDataFrame([([("user", "a"), ("assistant", None)],)], f"messages {prompts.MESSAGES}")
    with pytest.raises(Exception, match="without role or content"):
        prompts.render_chat(df).collect()


def test_completion_records_become_messages(spark):
    df = spark.createDataFrame(
        [("[]", "q", "a"), ("{", "q", "a"), (None, None, "a"), (None, "q", None)],
        "tools string, prompt_user_turn string, teacher_completion string",
    )
    built = prompts.completion_messages(df).collect()
    assert [[m.role for m in r.messages] for r in built] == [["system", "user", "assistant"]]
    reasons = [r.w for r in df.select(prompts.completion_skip_reason().alias("w")).collect()]
    assert reasons == [None, "tools_not_json", "empty_content", "empty_content"]
