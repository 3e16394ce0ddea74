"""What the operators of this folder share: tables, the shared folder, code on executors, words, components."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.session import shelve

#: Characters between words; everything else is part of a word.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"
#: Rows of texts that a task gets at a time. Ten thousand of them, as Spark sends by itself, are tens of MB, which the executor and
#: the Python worker hold several times.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes of input for each reducer that packs rows in memory.
REDUCER_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors once, so that they need no installation there."""
    sc = spark.sparkContext
    if getattr(sc, "_rowtide_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    path = os.path.join(tempfile.mkdtemp(prefix="rowtide-"), "rowtide_code.zip")
    with open(path, "wb") as f:
        f.write(data.getvalue())
    sc.addPyFile(path)
    sc._rowtide_shipped = True


def batch_rows(spark: SparkSession) -> str:
    """Have no more than ``BATCH_ROWS`` sent at a time in this session; what was set before."""
    before = spark.conf.get(_BATCH)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    return before


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """``batch_rows`` for what is run inside."""
    before = batch_rows(spark)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def reducers(docs: DataFrame) -> int:
    """Enough that each gets a bounded part of the input, by the size that the plan knows."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    size = size if size < 2**60 else 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // REDUCER_BYTES))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 over uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """64-bit hashes of the words of a text, remembered up to a bound."""

    def __init__(self, lower: bool, bound: int = 500_000):
        self.lower, self.bound, self.known = lower, bound, {}

    def hashes(self, text: str | None) -> np.ndarray:
        data = (text or "").encode()
        words = (data.lower() if self.lower else data).split()  # bytes: only ASCII blanks split, only A-Z change
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > self.bound:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` consecutive word hashes, built from those of half the length."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    if n == 1:
        return h
    half = windows(h, n // 2)
    out = mix(half[: len(half) - n // 2] * np.uint64(0x9E3779B97F4A7C15) + half[n // 2 :] + np.uint64(n))
    return out if n % 2 == 0 else mix(out[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[n - 1 :])


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` as (node, component): the smallest node that links reach. Nodes without links are absent.

    Each round hooks every node to its smallest neighbour, follows hooks to their roots by doubling, and
    rewrites the links between roots. Neighbours are only ever folded by ``min``, so a node with any number
    of links is folded inside the map tasks; the other joins have one row per node on one side.
    """
    edges = shelve(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    )
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = shelve(both.groupBy(F.col("a").alias("root")).agg(F.least("root", F.min("b")).alias("up")))
        while True:
            over = up.select(F.col("root").alias("up"), F.col("up").alias("over"))
            up = shelve(
                up.join(over, "up").select("root", F.col("over").alias("up"), (F.col("over") < F.col("up")).alias("moved"))
            )
            if up.where("moved").isEmpty():
                break
            up = up.drop("moved")
        up = up.drop("moved")
        nodes = (
            nodes.withColumnRenamed("component", "root")
            .join(up, "root", "left")
            .select("node", F.coalesce("up", "root").alias("component"))
        )
        a, b = (up.select(F.col("root").alias(x), F.col("up").alias("up_" + x)) for x in "ab")
        moved = edges.join(a, "a").join(b, "b")
        edges = shelve(
            moved.select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).where("a < b").distinct()
        )
    return shelve(nodes)
