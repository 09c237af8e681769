"""Driver queries for the operators, each with SQL that says the same.

The mapping of tables to media is only a stand-in for data: an image is an embedding, a track is a
user's events by hour, a page is a turn of a conversation, a block is one of its lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from tessera.plans import queries_media, queries_models, queries_pages, queries_text  # noqa: E402, F401  they add themselves
