"""A landing table of parsed changes.

JSON is the dear part of the work. Landing a feed once, with the cells of its row images as VARIANT
and partitioned by source table, lets a changed contract, a drift check or another report run over
columns, reading only the tables and fields it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.control import drop_control
from rowtide.operators.envelope import parsed_columns

# Records of one source table per file, so that a busy table becomes many files and not one.
RECORDS_PER_FILE = 5_000_000

_IMAGE = "map<string,variant>"
# Stated rather than inferred: a table named 007 must not be read as a number.
LANDED = (
    "seq bigint, destination string, key string, value string, unparseable boolean, op string, "
    f"before {_IMAGE}, after {_IMAGE}, db string, table_schema string, table_name string, lsn_num bigint, "
    "txid bigint, is_snapshot boolean, ts_ms bigint, "
    "columns array<struct<field:string,type:string,name:string,optional:boolean>>, "
    "source_schema string, source_table string"
)


def land(feed: DataFrame, path: str, mode: str = "append", rebalance: bool = True) -> None:
    """Parse the data changes of a feed and write them.

    Records are rebalanced by table first: small tables share a task, a busy one is split over as many
    as its size asks for, and neither ends in crumbs of files. Leave that out for a feed whose splits
    already hold one table each.

    The text of every record is kept: a later contract may reject it, and rejects carry their text. It is a
    column of its own that nothing else reads.
    """
    parsed = parsed_columns(drop_control(feed))
    keyed = parsed.withColumns({"source_schema": F.col("table_schema"), "source_table": F.col("table_name")})
    if rebalance:
        keyed = keyed.hint("rebalance", "source_schema", "source_table")
    (
        keyed.write.mode(mode)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .partitionBy("source_schema", "source_table")
        .parquet(path)
    )


def read_landed(spark: SparkSession, path: str, tables: list[tuple[str, str]] | None = None) -> DataFrame:
    """Landed changes, as ``parse`` gives them; ``tables`` reads only their partitions."""
    rows = spark.read.schema(LANDED).parquet(path)
    if tables is not None:
        wanted = F.lit(False)
        for schema, name in tables:
            wanted = wanted | ((F.col("source_schema") == schema) & (F.col("source_table") == name))
        rows = rows.where(wanted)
    return rows.drop("source_schema", "source_table")
