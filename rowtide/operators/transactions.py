"""Transactions put together again from their changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Numbers of transactions are used again some day. Changes with one number are one transaction as long as no gap
#: between their positions in the log is wider than this.
GAP = 1 << 36
#: Width in the log of the stretches to which changes are folded before they are shuffled.
STRETCH = 1 << 20


def transactions(parsed: DataFrame, gap: int = GAP, stretch: int = STRETCH) -> DataFrame:
    """One row for each transaction of ``parsed`` records, with

    ``db, txid``; ``first_lsn, last_lsn``; ``first_ts_ms, last_ts_ms``; ``tables``, sorted; ``changes``, told apart by table,
    operation and position; ``replays``, deliveries beyond the first of a change; ``first_seq, last_seq`` of its
    deliveries, replays included.

    Transactions of one number are islands in the log, parted by gaps wider than ``gap``. Records without a number (reads of a
    snapshot, unreadable text) belong to none. Changes without a position are an island of their own, whose changes can't be
    told from replays and all count.

    Changes are folded in the tasks to a row for each transaction, table, operation and stretch of the log, which holds its
    positions and nothing else of them; a huge transaction is spread by stretch. These rows are ordered along the log once, to
    find the islands.
    """
    narrower = min(stretch, gap) if gap else 1
    table = F.concat_ws(".", "table_schema", "table_name")
    known = parsed.where(F.col("txid").isNotNull()).select(
        "db", "txid", table.alias("table"), "op", "lsn_num", "ts_ms", "seq", F.expr(f"lsn_num div {narrower}").alias("_stretch")
    )
    folded = known.groupBy("db", "txid", "_stretch", "table", "op").agg(
        F.collect_set("lsn_num").alias("_at"), F.count(F.lit(1)).alias("_n"), *_ends("lsn_num"), *_ends("ts_ms"), *_ends("seq")
    )
    distinct = F.when(F.size("_at") > 0, F.size("_at").cast("bigint")).otherwise(F.col("_n"))
    folded = folded.withColumn("changes", distinct).drop("_at")
    # rows without a position come first, and what follows them is another island
    own = Window.partitionBy("db", "txid").orderBy("_first_lsn_num")
    behind = F.max("_last_lsn_num").over(own.rowsBetween(Window.unboundedPreceding, -1))
    new = F.col("_first_lsn_num").isNotNull() & F.coalesce(F.col("_first_lsn_num") - behind > gap, F.lit(True))
    islands = folded.withColumn("_new", new.cast("int"))
    islands = islands.withColumn("_island", F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy("db", "txid", "_island").agg(
        F.sum("changes").alias("changes"), F.sum("_n").alias("_n"), F.array_sort(F.collect_set("table")).alias("tables"),
        *(c for name in ("lsn_num", "ts_ms", "seq") for c in _merged(name)),
    )
    return whole.select(
        "db", "txid", F.col("_first_lsn_num").alias("first_lsn"), F.col("_last_lsn_num").alias("last_lsn"),
        F.col("_first_ts_ms").alias("first_ts_ms"), F.col("_last_ts_ms").alias("last_ts_ms"), "tables", "changes",
        (F.col("_n") - F.col("changes")).alias("replays"), F.col("_first_seq").alias("first_seq"), F.col("_last_seq").alias("last_seq"),
    )


def _ends(name: str) -> list:
    return [F.min(name).alias(f"_first_{name}"), F.max(name).alias(f"_last_{name}")]


def _merged(name: str) -> list:
    return [F.min(f"_first_{name}").alias(f"_first_{name}"), F.max(f"_last_{name}").alias(f"_last_{name}")]
