"""Turning raw conversations into chat messages and prompt text."""

import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from distaff.constants import (
    DIALOGUE_ROLES,
    FUNCTION_RESPONSE_PREFIX,
    GENERAL_CHAT_ROLES,
    PREP_ROLES,
    SYSTEM_TEMPLATE,
    TOOLS_SLOT,
)

MESSAGES = "array<struct<role:string,content:string>>"


def turn(i: int, field: str) -> Column:
    """Field of the i-th turn, null where there is none."""
    return F.get(F.col("conversations"), i)[field]


def message(role, content) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def _role_map(roles: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in roles.items() for x in pair])


def map_roles(
    df: DataFrame, roles: dict = GENERAL_CHAT_ROLES, on_unknown: str = "keep"
) -> DataFrame:
    """Add ``messages`` with chat roles.

    Unknown roles stay as they are (``keep``), drop the row (``skip``) or
    fail the query (``error``).
    """
    mapping = _role_map(roles)
    known = list(roles)
    mapped = lambda t: mapping[t["from"]]
    if on_unknown == "keep":
        role = lambda t: F.coalesce(mapped(t), t["from"])
    elif on_unknown == "error":
        role = lambda t: F.coalesce(
            mapped(t), F.raise_error(F.concat(F.lit("unknown role: "), t["from"])).cast("string")
        )
    elif on_unknown == "skip":
        role = mapped
        df = df.filter(F.forall("conversations", lambda t: t["from"].isin(known)))
    else:
        raise ValueError(f"unknown policy: {on_unknown}")
    return df.withColumn(
        "messages", F.transform("conversations", lambda t: message(role(t), t["value"]))
    )


@F.pandas_udf(T.StringType())
def _indented(tools: pd.Series) -> pd.Series:
    # Tool lists repeat, so each distinct one in a batch is printed once.
    def show(text):
        try:
            return json.dumps(json.loads(text), indent=2) if text else "[]"
        except ValueError:
            return None

    shown = {text: show(text) for text in tools.dropna().unique()}
    return tools.map(lambda text: "[]" if text is None else shown[text])


def system_prompt(tools: Column, template: str = SYSTEM_TEMPLATE) -> Column:
    """Template with the tool list as indented JSON; null if it is not JSON.

    The layout must match Python's ``json.dumps(indent=2)`` byte for byte
    (ASCII escapes included), which Spark's printer does not produce.
    """
    head, tail = template.split(TOOLS_SLOT)
    return F.concat(F.lit(head), _indented(tools), F.lit(tail))


def with_system_prompt(df: DataFrame, template: str = SYSTEM_TEMPLATE) -> DataFrame:
    return df.withColumn("system_prompt", system_prompt(F.col("tools"), template))


def _with_usable_prompt(df: DataFrame) -> DataFrame:
    """System prompts, printed once; rows whose tools are not JSON are left out."""
    return with_system_prompt(df).filter("system_prompt IS NOT NULL")


def content_skip_reason(last: int | None = None, tools: str | None = "tools") -> Column:
    """Why messages of a row cannot be built from its texts; null where they can.

    ``last`` is the index of the last turn that is used, None for all turns;
    ``tools`` names the tool list, None where rows have none.
    """
    used = F.col("conversations") if last is None else F.slice("conversations", 1, last + 1)
    empty = F.exists(used, lambda t: t.isNull() | t["from"].isNull() | t["value"].isNull())
    reason = F.when(F.coalesce(empty, F.lit(False)), "empty_content")
    if tools is None:
        return reason
    return F.when(_indented(F.col(tools)).isNull(), "tools_not_json").otherwise(reason)


def full_dialogue(df: DataFrame, on_unknown: str = "error") -> DataFrame:
    """All turns after a system message.

    Calls are assistant turns, function results are user turns with a fixed
    prefix. A row with any other role fails the query (``error``) or is left
    out (``skip``), as are rows with a ``content_skip_reason``.
    """
    if on_unknown not in ("error", "skip"):
        raise ValueError(f"unknown policy: {on_unknown}")
    if on_unknown == "skip":
        known = [*DIALOGUE_ROLES, "function_call", "observation"]
        df = df.filter(F.forall("conversations", lambda t: t["from"].isin(known)))
    df = df.filter(content_skip_reason(tools=None).isNull())
    mapping = _role_map(DIALOGUE_ROLES)

    def as_message(t):
        speaker, value = t["from"], t["value"]
        unknown = F.raise_error(F.concat(F.lit("unknown role: "), speaker)).cast("string")
        role = (
            F.when(speaker == "function_call", "assistant")
            .when(speaker == "observation", "user")
            .otherwise(F.coalesce(mapping[speaker], unknown))
        )
        content = F.when(
            speaker == "observation", F.concat(F.lit(FUNCTION_RESPONSE_PREFIX), value)
        ).otherwise(value)
        return message(role, content)

    opening = F.array(message("system", F.col("system_prompt")))
    return _with_usable_prompt(df).withColumn(
        "messages", F.concat(opening, F.transform("conversations", as_message))
    )


def prompt_messages(df: DataFrame) -> DataFrame:
    """``[system, user]`` of each row whose first turn is a person's.

    Rows with a ``content_skip_reason(0)`` are left out.
    """
    fitting = df.filter((turn(0, "from") == "human") & content_skip_reason(0, None).isNull())
    return _with_usable_prompt(fitting).withColumn(
        "messages",
        F.array(message("system", F.col("system_prompt")), message("user", turn(0, "value"))),
    )


def triple_skip_reason(
    roles: dict = PREP_ROLES, target_roles: list | None = None, tools: str | None = "tools"
) -> Column:
    """Why a row gives no message triple; null where it does.

    ``tools`` names the tool list, None where rows have none.
    """
    allowed = list(roles) if target_roles is None else target_roles
    return (
        F.when(F.coalesce(F.size("conversations"), F.lit(0)) < 1, "no_turns")
        .when(F.coalesce(turn(0, "from"), F.lit("")) != "human", "first_not_human")
        .when(F.size("conversations") < 2, "no_reply")
        .when(~F.coalesce(turn(1, "from"), F.lit("")).isin(allowed), "reply_role")
        .otherwise(content_skip_reason(1, tools))
    )


def triple_messages(
    df: DataFrame, roles: dict = PREP_ROLES, target_roles: list | None = None
) -> DataFrame:
    """``[system, user, reply]`` from the first two turns.

    Rows that do not have that shape are left out; ``target_roles`` narrows
    the accepted reply roles (all mapped roles by default).
    """
    fitting = df.filter(triple_skip_reason(roles, target_roles, tools=None).isNull())
    mapping = _role_map(roles)
    return _with_usable_prompt(fitting).withColumn(
        "messages",
        F.array(
            message("system", F.col("system_prompt")),
            message(mapping[turn(0, "from")], turn(0, "value")),
            message(mapping[turn(1, "from")], turn(1, "value")),
        ),
    )


@dataclass(frozen=True)
class ChatTemplate:
    """Text around each message; ``{role}`` is replaced by the role."""

    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"
    reply: str = "<|im_start|>assistant\n"


def render_messages(
    messages: Column, template: ChatTemplate = ChatTemplate(), add_generation_prompt: bool = False
) -> Column:
    """Text of all messages; one without role or content fails the query."""
    before, after = template.opening.split("{role}")
    incomplete = F.raise_error(F.lit("message without role or content")).cast("string")
    body = F.array_join(
        F.transform(
            messages,
            lambda m: F.coalesce(
                F.concat(
                    F.lit(before), m["role"], F.lit(after), m["content"], F.lit(template.closing)
                ),
                incomplete,
            ),
        ),
        "",
    )
    return F.concat(body, F.lit(template.reply)) if add_generation_prompt else body


def render_chat(
    df: DataFrame, template: ChatTemplate = ChatTemplate(), add_generation_prompt: bool = False
) -> DataFrame:
    """Add ``text``, the messages in a chat template."""
    return df.withColumn(
        "text", render_messages(F.col("messages"), template, add_generation_prompt)
    )


@F.pandas_udf(T.StringType())
def _rewritten_call(replies: pd.Series) -> pd.Series:
    def rewrite(text):
        try:
            parsed = json.loads(text)
        except (TypeError, ValueError):
            return None
        named = isinstance(parsed, dict) and "name" in parsed
        return json.dumps(parsed) if named else None

    return replies.map(rewrite).astype(object)


def ground_truth_target(df: DataFrame) -> DataFrame:
    """Add ``target``: the reply a student should produce.

    A call is parsed and written again in Python's JSON layout (null if it is
    not JSON or has no name), a plain reply stays, everything else is null.
    """
    reply, speaker = turn(1, "value"), turn(1, "from")
    call = _rewritten_call(F.when(speaker == "function_call", reply))
    target = F.when(speaker == "function_call", call).when(speaker == "gpt", reply)
    return df.withColumn("target", F.when(turn(0, "from") == "human", target))


def target_messages(df: DataFrame) -> DataFrame:
    """Messages of the rows that have a target and no ``content_skip_reason(0)``."""
    fitting = ground_truth_target(df).filter(F.col("target").isNotNull() & content_skip_reason(0, None).isNull())
    return _with_usable_prompt(fitting).withColumn(
        "messages",
        F.array(
            message("system", F.col("system_prompt")),
            message("user", turn(0, "value")),
            message("assistant", F.col("target")),
        ),
    )


def completion_messages(df: DataFrame, completion: str = "teacher_completion") -> DataFrame:
    """``[system, user, completion]`` of completion records (tools, prompt_user_turn, completion).

    Records without prompt or completion, or whose tools are not JSON, are
    left out; ``completion_skip_reason`` counts them.
    """
    empty = F.col("prompt_user_turn").isNull() | F.col(completion).isNull()
    return _with_usable_prompt(df.filter(~empty)).withColumn(
        "messages",
        F.array(
            message("system", F.col("system_prompt")),
            message("user", F.col("prompt_user_turn")),
            message("assistant", F.col(completion)),
        ),
    )


def completion_skip_reason(completion: str = "teacher_completion") -> Column:
    """Why a completion record gives no training text; null where it does."""
    empty = F.col("prompt_user_turn").isNull() | F.col(completion).isNull()
    return F.when(_indented(F.col("tools")).isNull(), "tools_not_json").when(empty, "empty_content")
