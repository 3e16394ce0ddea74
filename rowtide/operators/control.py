"""Records that are not data changes, and tables nobody asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.contract import TableContract

# Fixed value: heartbeat records arrive on destinations with this prefix.
HEARTBEAT_PREFIX = "__debezium-heartbeat"


def drop_tombstones(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("value").isNotNull())


def drop_heartbeats(feed: DataFrame) -> DataFrame:
    """Heartbeats go; a record without a destination stays."""
    return feed.where(~F.coalesce(F.col("destination").startswith(HEARTBEAT_PREFIX), F.lit(False)))


def drop_control(feed: DataFrame) -> DataFrame:
    """Data changes only. Both tests read plain columns, so they run before any JSON is parsed."""
    return drop_heartbeats(drop_tombstones(feed))


def include_tables(parsed: DataFrame, contracts: Sequence[TableContract]) -> DataFrame:
    """Rows of the contracts' tables only (``table_schema``, ``table_name``)."""
    keys = sorted({(t.schema, t.name) for t in contracts})
    spark = parsed.sparkSession
    tables = spark.createDataFrame(keys, "table_schema string, table_name string")
    return parsed.join(_bounded(tables, len(keys)), ["table_schema", "table_name"], "left_semi")


# Contracts are objects in the driver, so their number is known when the plan is built.
BROADCAST_TABLES = 10_000


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a side whose row count is known to be small; else the planner decides."""
    return F.broadcast(df) if rows <= BROADCAST_TABLES else df
