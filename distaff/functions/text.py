"""Small text and number expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip removes that chat text can carry.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def strip(text: Column) -> Column:
    """Trim all whitespace, not only spaces."""
    return F.trim(text, F.lit(WHITESPACE))


def drop_prompt_echo(full: Column, prompt: Column) -> Column:
    """Generated part of an output that repeats its prompt, trimmed."""
    return strip(F.substring(full, F.length(prompt) + 1, F.length(full)))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal; null when there is no whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), 1)


def share(part: Column, whole: Column) -> Column:
    """Part of a whole, 0 when there is no whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def is_finite_loss(loss: Column) -> Column:
    """False for null and NaN (Spark takes NaN as equal to itself)."""
    return loss.isNotNull() & ~F.isnan(loss)


def salted_hash(key: Column, seed) -> Column:
    """Uniform, engine-independent hash of a key."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), key.cast("string")))


def hash_uniform(key: Column, seed) -> Column:
    """Number in [0, 1) fixed by key and seed."""
    head = F.conv(F.substring(salted_hash(key, seed), 1, 8), 16, 10).cast("bigint")
    return head / F.lit(4294967296.0)
