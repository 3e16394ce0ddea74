"""Document fingerprints: threshold-scaled sketches.

A sketch keeps every hash of a document's shingles (``SHINGLE`` consecutive code points; a shorter text is one
shingle) that lies below a fixed part ``1 / SCALE`` of the hash range, and always the ``LEAST`` smallest ones, so that
short texts have a sketch too. The sketch of a union is the union of sketches, cut the same way. Two sketches are
compared on the part of the hash range that both cover whole: the likeness is the share of the smaller one's hashes
that the other has, an estimate of containment that holds for documents of very unequal length.

A null text counts as empty: an empty sketch, as alike as can be to other empty ones and to nothing else. Rows are
ordered by doc_id, null ids first, rows with equal ids by text; repeated rows follow each other. Columns besides
doc_id and text are left out. An empty table gives no rows; of a single row, the next document is the row itself.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import mix, ship, table

SHINGLE = 8
SCALE = 16
LEAST = 8
LIMIT = np.uint32(2**32 // SCALE)
FACTORS = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def shingles(codes: np.ndarray) -> np.ndarray:
    """32-bit hashes of all shingles."""
    n = len(codes)
    if not n:
        return np.empty(0, np.uint32)
    size = min(n, SHINGLE)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out += (codes[i : n - size + 1 + i] + np.uint64(1)) * FACTORS[i]
    return (mix(out) >> np.uint64(32)).astype(np.uint32)


def kept(hashes: np.ndarray) -> np.ndarray:
    """The sketch of these hashes, sorted."""
    low = np.unique(hashes[hashes < LIMIT])
    return low if len(low) >= LEAST else np.unique(hashes)[:LEAST]


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return kept(np.concatenate([a, b]))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    # A sketch with fewer than LEAST hashes holds them all; else it is whole up to the limit or its last hash.
    cover = [2**32 if len(s) < LEAST else max(int(LIMIT) - 1, int(s[-1])) for s in (a, b)]
    a, b = (s[s <= min(cover)] for s in (a, b))
    least = min(len(a), len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / least if least else 0.0


def written(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u4").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


class _Document:
    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.codes = points(self.text)
        self.hashes = shingles(self.codes)
        self.sketch = kept(self.hashes)


def _compared(doc: _Document, after: _Document) -> tuple:
    n = len(doc.text)
    tail = n // 4
    edited = doc.text[: n - tail] + after.text[:tail] if tail else doc.text
    same = min(n - tail, len(edited)) - SHINGLE + 1  # shingles that lie before the edit
    if not tail:
        sketch = doc.sketch
    elif same > 0:
        rest = edited[same:]
        sketch = kept(np.concatenate([doc.hashes[:same], shingles(points(rest if len(rest) >= SHINGLE else ""))]))
    else:
        sketch = kept(shingles(points(edited)))
    return (
        doc.doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), written(doc.sketch), written(sketch),
        likeness(doc.sketch, sketch), likeness(doc.sketch, after.sketch),
    )


def _slice(splits: list[int], key: Column) -> Column:
    """The number of splits not above ``key``, by a binary tree of comparisons."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < splits[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(splits))


def with_next(docs: DataFrame) -> DataFrame:
    """(slice, tail, key, doc_id, text): ``docs`` cut into slices of the order of ids, a few for each shuffle partition.

    The first row of each slice is also at the end of the slice before it (of the first, at the end of the last),
    marked ``tail``. So each row's next row is in its own slice, and texts move once. Only the split points and the first id
    of each slice come to the driver, a number for each slice.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").withColumn("key", key)
    n = min(4096, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    at = F.percentile_approx("key", F.array(*(F.lit(i / n) for i in range(1, n))), F.lit(10 * n))
    splits = sorted(set(docs.select(at).first()[0] or []))
    docs = docs.withColumn("slice", _slice(splits, F.col("key")))
    firsts = {r[0]: r[1] for r in docs.groupBy("slice").agg(F.min("key")).collect()}
    used = sorted(firsts)
    before = {s: used[i - 1] for i, s in enumerate(used)}
    if not used:
        return docs.select("slice", F.lit(False).alias("tail"), "key", "doc_id", "text")
    first = F.array(*(F.lit(firsts.get(i)).cast("long") for i in range(len(splits) + 1)))
    previous = F.array(*(F.lit(before.get(i)).cast("int") for i in range(len(splits) + 1)))
    here = F.struct(F.col("slice"), F.lit(False).alias("tail"))
    there = F.struct(previous[F.col("slice")].alias("slice"), F.lit(True).alias("tail"))
    places = F.when(F.col("key") == first[F.col("slice")], F.array(here, there)).otherwise(F.array(here))
    placed = docs.select(F.inline(places).alias("slice", "tail"), "key", "doc_id", "text")
    return placed.repartition(len(used), "slice").sortWithinPartitions("slice", "tail", "key", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ])
        last, closed = None, False
        for batch in batches:
            out = []
            for tail, doc_id, text in zip(batch.column(1), batch.column(3), batch.column(4), strict=True):
                tail = tail.as_py()
                if tail and closed:  # more rows with the id that begins the next slice
                    continue
                doc = _Document(doc_id.as_py(), text.as_py())
                if last is not None:
                    out.append(_compared(last, doc))
                last, closed = (None, True) if tail else (doc, False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(schema), schema, strict=True)],
                schema=schema,
            )

    return with_next(docs).mapInArrow(rows, SCHEMA)


def op4_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
