"""Query registry: a name, a DataFrame builder, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder under its function name, with its SQL where SQL can say it."""

    def register(builder: Builder) -> Builder:
        key = name or builder.__name__
        QUERIES[key] = builder
        if sql is not None:
            ORACLES[key] = sql.strip()
        return builder

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
