"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

On a bounded sample, rotations are learned that bring vectors near to the corners of the binary cube, so that the signs
of rotated vectors are balanced codes. The codes are cut into pieces, one hash table each. Vectors that share
a piece with each other are compared by cosine in double precision. How long a piece is follows the number of vectors, so
that buckets keep their size; how many tables there are follows from the length, so that two vectors at the threshold
meet with probability ``RECALL``, nearer ones more often.

Equal vectors are one row with a count. Buckets are compared block by block in the task that has them, large ones in tiles
by several tasks; pairs never become rows. A linked pair is counted in the first table where it meets only, so the
counts need no list of pairs.

Vectors that are null, zero or hold null or non-finite components link with nothing, nor do vectors of different length.
Null ids come first. Rows with one id are one node in components; each row has the count of its own vector. Columns
besides vec_id and embedding are left out. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import components, reducers, shelve, ship, table

THRESHOLD = 0.9
#: Vectors on which the rotations are learned, at most.
SAMPLE = 20_000
#: Bits that one rotation gives, at most; rounds of learning.
BITS = 64
ROUNDS = 25
SEED = 3
#: Vectors in a bucket if codes are balanced; chance that a pair at the threshold meets.
LOAD = 32
RECALL = 0.97
#: Vectors of a bucket that one task compares; more are compared in tiles.
BUCKET = 4096
NO_ID = -(2**63)


def rotations(sample: np.ndarray, count: int) -> list[np.ndarray]:
    """``count`` matrices (dimension, bits), learned on unit vectors: alternately take the signs as the target and solve
    for the rotation that comes nearest to them, each time from another random rotation."""
    rng, (_, dim) = np.random.default_rng(SEED), sample.shape
    bits = min(dim, BITS)
    _, basis = np.linalg.eigh(sample.T @ sample)
    out = []
    for i in range(count):
        if dim > bits and i:  # other directions than the strongest ones
            plane = np.linalg.qr(rng.standard_normal((dim, bits)))[0]
        else:
            plane = basis[:, ::-1][:, :bits]
        flat = sample @ plane
        turn = np.linalg.qr(rng.standard_normal((bits, bits)))[0]
        for _ in range(ROUNDS):
            u, _, v = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
            turn = (u @ v).T
        out.append(plane @ turn)
    return out


def shape(vectors: int, threshold: float) -> tuple[int, int]:
    """(bits of a piece, tables)."""
    piece = max(4, min(30, round(math.log2(max(1, vectors) / LOAD + 1))))
    meet = (1 - math.acos(threshold) / math.pi) ** piece
    return piece, max(4, math.ceil(math.log(1 - RECALL) / math.log(1 - meet)))


def pieces(unit: np.ndarray, turns: list[np.ndarray], piece: int, tables: int) -> np.ndarray:
    """(vectors, tables) of the codes' pieces."""
    bits = np.concatenate([(unit @ t) >= 0 for t in turns], axis=1)[:, : piece * tables]
    return (bits.reshape(len(unit), tables, piece) @ (1 << np.arange(piece))).astype(np.int32)


def _read(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a vector to compare, and the flat values of those."""
    vectors = rows.column(1)
    good = []
    for v in vectors.to_pylist():
        good.append(bool(v) and None not in v and all(map(math.isfinite, v)) and any(v))
    return np.array(good, bool), vectors


def _keyed(rows: DataFrame) -> DataFrame:
    """(vec_id, node, key, vector): the vector's bytes, null if it can link with nothing, and a hash of them."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, vectors = _read(batch)
            packed = [
                (np.array(v, np.float64) + 0.0).tobytes() if g else None for g, v in zip(good, vectors.to_pylist(), strict=True)
            ]
            keys = [None if p is None else xxhash.xxh3_128_hexdigest(p) for p in packed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(0).fill_null(NO_ID), pa.array(keys, pa.string()), pa.array(packed, pa.binary())],
                ["vec_id", "node", "key", "vector"],
            )

    return rows.mapInArrow(go, "vec_id long, node long, key string, vector binary")


def _units(packed: list[bytes]) -> np.ndarray:
    vectors = np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _coded(nodes: DataFrame, turns: list[np.ndarray], piece: int, tables: int) -> DataFrame:
    """(bucket, node, copies, vector, codes) for each table."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                codes = pieces(_units(part.column(2).to_pylist()), turns, piece, tables)
                n = part.num_rows
                buckets = (np.arange(tables, dtype=np.int64)[None, :] << 32) + codes
                take = pa.array(np.repeat(np.arange(n), tables))
                packed = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets.ravel()), *(c.take(take) for c in (part.column(0), part.column(1), part.column(2), packed))],
                    ["bucket", "node", "copies", "vector", "codes"],
                )

    return nodes.mapInArrow(go, "bucket long, node long, copies long, vector binary, codes binary")


def _compared(left: list[tuple], right: list[tuple], number: int, threshold: float) -> tuple[np.ndarray, ...]:
    """Counts for the rows of both sides of the linked pairs whose first common piece is this table's, and links that connect
    them; ``right`` may be ``left``. Rows are (node, copies, vector, codes)."""
    same = left is right
    sides = [left] if same else [left, right]
    units = [_units([r[2] for r in s]) for s in sides]
    codes = [np.frombuffer(b"".join(r[3] for r in s), np.int32).reshape(len(s), -1) for s in sides]
    copies = [np.array([r[1] for r in s], np.int64) for s in sides]
    counts = [np.zeros(len(s), np.int64) for s in sides]
    root, links, step = list(range(sum(map(len, sides)))), [], 512

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    shift = 0 if same else len(left)
    for i in range(0, len(left), step):
        for j in range(i if same else 0, len(right), step):
            a, b = slice(i, i + step), slice(j, j + step)
            close = units[0][a] @ units[-1][b].T >= threshold
            for t in range(number):
                close &= codes[0][a, t][:, None] != codes[-1][b, t][None, :]
            if same and i == j:
                close = np.triu(close, 1)
            counts[0][a] += close @ copies[-1][b]
            counts[-1][b] += copies[0][a] @ close
            for x, y in zip(*np.nonzero(close), strict=True):
                x, y = int(x) + i, int(y) + j + shift
                if (p := find(x)) != (q := find(y)):
                    root[p] = q
                    links.append((x, y))
    nodes = np.array([r[0] for s in sides for r in s], np.int64)
    links = np.array(links, np.int64).reshape(-1, 2)
    return nodes, np.concatenate(counts), nodes[links[:, 0]], nodes[links[:, 1]]


def _buckets(coded: DataFrame, parts: int, threshold: float) -> DataFrame:
    """(node, links) and (a, b) of all buckets; a large bucket's tiles are pairs of its slices."""
    sizes = coded.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / (BUCKET / 2)).cast("int").alias("slices"))
    sizes = sizes.where(F.col("slices") > 2)
    rows = coded.join(sizes, "bucket", "left")
    own = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda i: F.struct(F.least(i, own), F.greatest(i, own), own))
    whole = F.array(F.struct(F.lit(0), F.lit(0), F.lit(0)))
    rows = rows.select("bucket", F.inline(F.when(F.col("slices").isNull(), whole).otherwise(tiles)).alias("low", "high", "own"), "node", "copies", "vector", "codes")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: tuple | None, group: list[tuple]) -> Iterator[pa.RecordBatch]:
            if len(group) < 2:
                return
            bucket, low, high = key
            left = [r[1:] for r in group if r[0] == low]
            right = left if low == high else [r[1:] for r in group if r[0] == high]
            if not left or not right:
                return
            nodes, counts, a, b = _compared(left, right, bucket >> 32, threshold)
            some = counts > 0
            none = lambda n: pa.nulls(n, pa.int64())
            if some.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[some]), pa.array(counts[some]), none(int(some.sum())), none(int(some.sum()))], ["node", "links", "a", "b"]
                )
            if len(a):
                yield pa.RecordBatch.from_arrays([none(len(a)), none(len(a)), pa.array(a), pa.array(b)], ["node", "links", "a", "b"])

        key, group = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    yield from out(key, group)
                    key, group = row[:3], []
                group.append(row[3:])
        yield from out(key, group)

    rows = rows.repartition(parts, "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")
    return rows.mapInArrow(go, "node long, links long, a long, b long")


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``rows`` (vec_id, embedding)."""
    spark = rows.sparkSession
    ship(spark)
    rows = rows.selectExpr("cast(vec_id as long) vec_id", "cast(embedding as array<double>) embedding")
    keyed = shelve(_keyed(rows))
    of_key = keyed.where("key is not null").groupBy("key")
    nodes = of_key.agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    nodes = shelve(nodes)
    found = None
    lengths = nodes.groupBy(F.length("vector").alias("bytes")).agg(F.count(F.lit(1)).alias("n")).collect()  # usually one
    for size, n in sorted(map(tuple, lengths)):
        own = nodes.where(F.length("vector") == size)
        piece, tables = shape(n, threshold)
        sample = own.orderBy(F.xxhash64("key")).limit(SAMPLE).select("vector").collect()
        turns = rotations(_units([bytes(r[0]) for r in sample]), -(-piece * tables // min(BITS, size // 8)))
        coded = _coded(own.select("node", "copies", "vector"), turns, piece, tables)
        more = _buckets(coded, tables * reducers(own), threshold)
        found = more if found is None else found.unionByName(more)
    if found is None:
        found = spark.createDataFrame([], "node long, links long, a long, b long")
    found = shelve(found)
    joined = components(found.where("a is not null").select("a", "b"))
    counts = found.where("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    by_key = nodes.join(joined, "node", "left").join(counts, "node", "left").select(
        "key", F.coalesce("component", "node").alias("component"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
    )
    out = keyed.select("vec_id", "node", "key").join(by_key, "key", "left")
    component = F.coalesce("component", "node")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        F.when(component != NO_ID, component).alias("component_id"), (F.col("node") == component).alias("kept"),
    )


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH RECURSIVE unit AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, least(e.vec_id, l.b) AS component_id, e.vec_id = least(e.vec_id, l.b) AS kept
FROM embeddings e LEFT JOIN least l ON e.vec_id = l.a LEFT JOIN counts c ON e.vec_id = c.a
"""
