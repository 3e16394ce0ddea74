"""Change feeds: ``seq BIGINT, destination STRING, key STRING, value STRING``.

``seq`` is the delivery order within a table: a broker offset, or the order of a landing table.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.operators.envelope import fenced

FEED_COLUMNS = ("seq", "destination", "key", "value")
FEED_SCHEMA = "seq bigint, destination string, key string, value string"

# Snapshot modes.
SNAPSHOT_MODES = ("never", "initial", "initial_only", "when_needed")


def read_feed(
    spark: SparkSession,
    path: str | None = None,
    *,
    kafka: Mapping[str, str] | None = None,
    format: str = "parquet",
    streaming: bool = False,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """A feed from files with the feed's columns (parquet, json, orc, csv), or from Kafka.

    ``max_per_trigger`` bounds a micro-batch: files for a file source, offsets for Kafka. A slow sink
    then holds the source back, and nothing is dropped. A Kafka feed also has its ``partition``; offsets count
    inside it, so for tables that are spread over several partitions see ``commit_order``.
    """
    reader = spark.readStream if streaming else spark.read
    if kafka is not None:
        reader = reader.format("kafka").options(**kafka)
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load().select(
            F.col("offset").alias("seq"),
            F.col("topic").alias("destination"),
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "partition",
        )
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.format(format).schema(FEED_SCHEMA).load(path)


def commit_order(parsed: DataFrame) -> DataFrame:
    """Parsed changes with the commit position as ``seq``.

    Offsets of different partitions say nothing about each other and repeat; the log position of the database orders
    the changes of a table wherever they were delivered. Records without one come first, and records at the same
    position go by what the operators break ties with. Replays of a change keep its place.
    """
    return parsed.withColumn("seq", F.coalesce("lsn_num", F.lit(-1).cast("bigint")))


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Several feeds as one.

    What follows a plain union is copied into each of its branches by the optimizer, so every feed would
    get a parser of its own to plan and compile. The observed count keeps the union below one parser.
    """
    both = reduce(DataFrame.unionByName, [f.select(*FEED_COLUMNS) for f in feeds])
    return fenced(both, "feed", records=F.count(F.lit(1)))


def snapshot_feed(
    table: DataFrame,
    *,
    db: str,
    schema: str,
    name: str,
    primary_key: Sequence[str],
    lsn: int | Column | None = None,
    ts_ms: int | Column = 0,
    seq: Column | None = None,
    destination_prefix: str = "cdc",
    flag: str = "true",
    leave_out: Sequence[str] = (),
) -> DataFrame:
    """Existing rows of a table as read (``r``) envelopes.

    The schema block is taken from the DataFrame's types. Without ``seq`` a row's place is a hash of its key, below zero and
    so ahead of any change, the same on every run. Columns in ``leave_out`` serve the other arguments and are no part of the row.
    """
    fields = [f.name for f in table.schema if f.name not in leave_out]
    block = _schema_block(T.StructType([table.schema[c] for c in fields]), primary_key)
    row = F.to_json(F.struct(*[_wire(table.schema[c]).alias(c) for c in fields]), {"ignoreNullFields": "false"})
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    source = F.to_json(
        F.struct(
            F.lit("postgresql").alias("connector"),
            F.lit(db).alias("db"),
            F.lit(schema).alias("schema"),
            F.lit(name).alias("table"),
            as_column(lsn).cast("bigint").alias("lsn"),
            as_column(ts_ms).cast("bigint").alias("ts_ms"),
            F.lit(flag).alias("snapshot"),
        ),
        {"ignoreNullFields": "false"},
    )
    value = F.concat(
        F.lit('{"schema":' + block + ',"payload":{"before":null,"after":'), row,
        F.lit(',"source":'), source, F.lit(',"op":"r"}}'),
    )
    order = F.shiftright(F.xxhash64(*primary_key), 2) - F.lit(1 << 62) if seq is None else seq
    return table.select(
        order.cast("bigint").alias("seq"),
        F.lit(f"{destination_prefix}.{schema}.{name}").alias("destination"),
        F.to_json(F.struct(*primary_key)).alias("key"),
        value.alias("value"),
    )


def with_snapshot(feed: DataFrame, snapshot: DataFrame, mode: str = "never", has_offsets: bool = False) -> DataFrame:
    """The snapshot ahead of the feed, as the mode says.

    A snapshot is taken once: ``initial``, ``initial_only`` and ``when_needed`` leave it out when there are
    stored offsets to resume from. ``initial_only`` has no more records then.
    """
    if mode not in SNAPSHOT_MODES:
        raise ValueError(f"snapshot mode must be one of {SNAPSHOT_MODES}, got {mode!r}")
    if mode == "initial_only":
        return snapshot.where(F.lit(False)) if has_offsets else snapshot
    if mode in ("initial", "when_needed") and not has_offsets:
        return union_feeds(snapshot, feed)
    return feed


def _wire(f: T.StructField) -> Column:
    """A cell as the connector writes it: decimals as text, times as epoch numbers."""
    c = F.col(f.name)
    if isinstance(f.dataType, T.DecimalType):
        return c.cast("string")
    if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(f.dataType, T.DateType):
        return F.unix_date(c)
    return c


def _schema_block(schema: T.StructType, primary_key: Sequence[str]) -> str:
    # Wire type and logical name per column type.
    wire = {
        T.ByteType: ("int16", None),
        T.ShortType: ("int16", None),
        T.IntegerType: ("int32", None),
        T.LongType: ("int64", None),
        T.FloatType: ("float", None),
        T.DoubleType: ("double", None),
        T.BooleanType: ("boolean", None),
        T.StringType: ("string", None),
        T.DecimalType: ("string", None),
        T.DateType: ("int32", "io.debezium.time.Date"),
        T.TimestampNTZType: ("int64", "io.debezium.time.MicroTimestamp"),
        T.TimestampType: ("int64", "io.debezium.time.MicroTimestamp"),
        T.ArrayType: ("array", None),
    }
    columns = []
    for f in schema:
        kind, logical = wire.get(type(f.dataType), ("struct", None))
        column = {"field": f.name, "type": kind, "optional": f.name not in primary_key}
        if logical:
            column["name"] = logical
        columns.append(column)
    image = {"type": "struct", "optional": True, "fields": columns}
    return json.dumps(
        {"type": "struct", "fields": [{**image, "field": "before"}, {**image, "field": "after"}]},
        separators=(",", ":"),
    )
