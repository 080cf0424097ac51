"""Registered queries over the standard tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import doubles
from ..sources.files import parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    """Registers a query under the operator's handle with its SQL."""
    def add(f: Query) -> Query:
        QUERIES[name], SQL[name] = f, sql
        return f

    return add


def events(spark: SparkSession, d: str) -> DataFrame:
    """Events with their time in microseconds."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return parquet(spark, d, "events").withColumn("at", F.timestamp_diff("MICROSECOND", epoch, F.col("ts")))


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return parquet(spark, d, "embeddings").select("vec_id", "label", doubles(F.col("embedding")).alias("v"))


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from . import columns, joins, ranks, reports, scans, schedules, segments  # noqa: F401  they register their queries

    return QUERIES, SQL


E_SQL = "(select event_id, user_id, event_type, value, props, epoch_us(ts) as us from events)"
V_SQL = "(select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings)"
