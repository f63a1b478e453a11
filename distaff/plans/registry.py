"""Queries over the given tables, each beside its SQL twin where one exists."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from distaff.session import configure


class Query(NamedTuple):
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(spark, sf_dir)`` under ``name``."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = Query(run, sql)
        return build

    return register
