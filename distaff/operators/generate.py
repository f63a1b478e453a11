"""Batch inference with user-supplied functions."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from distaff.constants import GENERATION_BATCH
from distaff.sources.completions import write_completions

Predict = Callable[[list[str]], list[str]]


def generate(
    df: DataFrame,
    load: Callable[[], Predict],
    prompt: str = "text",
    batch_size: int = GENERATION_BATCH,
    name: str = "completion",
) -> DataFrame:
    """Add completions of a prompt column.

    ``load`` runs once per task and returns ``list[str] -> list[str]``,
    which is called with at most ``batch_size`` prompts.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for frame in frames:
            prompts = frame[prompt].tolist()
            outputs = []
            for start in range(0, len(prompts), batch_size):
                batch = prompts[start : start + batch_size]
                replies = predict(batch)
                if len(replies) != len(batch):
                    raise ValueError(f"{len(batch)} prompts gave {len(replies)} completions")
                outputs += [reply.strip() for reply in replies]
            yield frame.assign(**{name: outputs})

    return df.mapInPandas(run, schema)


def pending(df: DataFrame, done: DataFrame, key: str = "example_id") -> DataFrame:
    """Rows without a finished completion."""
    return df.join(done.select(key), key, "left_anti")


def generate_resumable(
    df: DataFrame,
    done: DataFrame,
    load: Callable[[], Predict],
    path: str,
    key: str = "example_id",
    **options,
) -> None:
    """Generate what is still missing and append it to the JSON lines.

    ``done`` holds the keys found at ``path`` before this run. A write that
    failed leaves no committed rows, so starting again neither repeats nor
    loses any.
    """
    write_completions(generate(pending(df, done, key), load, **options), path, mode="append")


def map_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """Set columns from expressions."""
    return df.withColumns(columns)


def map_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """Apply a function to Arrow batches of rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield fn(frame)

    return df.mapInPandas(run, schema)


def filter_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is true."""
    return df.filter(predicate)
