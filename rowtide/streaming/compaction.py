"""Few and large files for a stream that runs for months.

Every micro-batch writes directories of its own. Now and then the closed ones are packed: their rows are written once more
into a segment, its files sized by table and day, and the list of segments is replaced. Segments of one size are packed
again when there are ``FAN`` of them, so a row is written a few times in all, and the number of files grows with the data
and not with the batches.

What counts is the list. A reader takes its segments and the batches behind the last of them, so each row is there once
at any time: before the list is replaced a new segment is not read, after that the directories that went into it are not.
A job that dies in between leaves a directory that nobody reads. What went into a segment is removed one packing later, for
readers that still go by the list before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Segments of one tier that are packed into one of the next.
FAN = 8


def _path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def read_list(spark: SparkSession, target: str, name: str) -> dict:
    """``segments``, each ``folder, first, last, tier``, in order and without gaps; ``gone``: folders to remove next time."""
    path, fs = _path(spark, f"{target}/segments/{name}.json")
    if not fs.exists(path):
        return {"segments": [], "gone": []}
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _replace_list(spark: SparkSession, target: str, name: str, content: dict) -> None:
    """The one step that makes a packing count: a rename over the list, whole or not at all."""
    jvm = spark._jvm
    new, fs = _path(spark, f"{target}/segments/.{name}-{uuid.uuid4().hex}.json")
    stream = fs.create(new, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    old, _ = _path(spark, f"{target}/segments/{name}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, old, options)


def batches(spark: SparkSession, target: str, name: str) -> list[int]:
    """Ids of the batch directories there are."""
    path, fs = _path(spark, f"{target}/{name}")
    if not fs.exists(path):
        return []
    found = (s.getPath().getName() for s in fs.listStatus(path))
    return sorted(int(n.removeprefix("batch_id=")) for n in found if n.startswith("batch_id="))


def read_packed(spark: SparkSession, target: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of ``{target}/{name}``: of the segments listed now, and of the batches behind them."""
    segments = read_list(spark, target, name)["segments"]
    last = segments[-1]["last"] if segments else -1
    folders = [s["folder"] for s in segments]
    folders += [f"{target}/{name}/batch_id={b}" for b in batches(spark, target, name) if b > last]
    if schema is None:
        if not folders:
            raise FileNotFoundError(f"{target}/{name}")
        schema = spark.read.parquet(folders[-1]).schema
    reader = spark.read.schema(schema)
    parts = [reader.parquet(f) for f in folders]
    out = spark.createDataFrame([], schema) if not parts else parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def pack(
    spark: SparkSession, target: str, name: str, before: int, by: Sequence[str] = (), day: Column | None = None, fan: int = FAN
) -> dict:
    """Pack what the batches below ``before`` left in ``{target}/{name}``; the new list.

    ``before`` is the first batch that may still be written again. Files are laid out by the columns ``by``, which are
    partition directories of the result, and rows of one ``day`` lie together; a busy table gets as many files as its size
    asks for, small ones share tasks.
    """
    known = read_list(spark, target, name)
    for folder in known["gone"]:
        path, fs = _path(spark, folder)
        fs.delete(path, True)
    segments = known["segments"]
    first = segments[-1]["last"] + 1 if segments else 0
    closed = [b for b in batches(spark, target, name) if first <= b < before]
    if not closed:
        if known["gone"]:
            _replace_list(spark, target, name, {"segments": segments, "gone": []})
        return {"segments": segments, "gone": []}
    folders, tier, start = [f"{target}/{name}/batch_id={b}" for b in closed], 0, first
    while len(same := [s for s in segments if s["tier"] == tier]) >= fan - 1:
        segments = segments[: -len(same)]
        folders, tier, start = [s["folder"] for s in same] + folders, tier + 1, same[0]["first"]
    schema = spark.read.parquet(folders[-1]).schema
    rows = spark.read.schema(schema).parquet(folders[0])
    for folder in folders[1:]:
        rows = rows.unionByName(spark.read.schema(schema).parquet(folder))
    keys = [*by, *(["_day"] if day is not None else [])]
    if day is not None:
        rows = rows.withColumn("_day", day)
    if keys:
        rows = rows.hint("rebalance", *keys).sortWithinPartitions(*keys).drop("_day")
    else:
        rows = rows.hint("rebalance")
    here = f"{target}/segments/{name}/{start}-{before - 1}-{uuid.uuid4().hex}"
    writer = rows.write
    (writer.partitionBy(*by) if by else writer).parquet(here)
    segments = [*segments, {"folder": here, "first": start, "last": before - 1, "tier": tier}]
    content = {"segments": segments, "gone": folders}
    _replace_list(spark, target, name, content)
    return content
