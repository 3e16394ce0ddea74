"""Substring dedup: remove words that an earlier passage already has.

Level-wise doubling. A level tests windows of one length: those that occur more than once are extended to twice that
length and tested again, all others are dropped for good. The first level has half the window's length and tests
only one part of its windows: of the short windows inside a window, the one with the smallest hash. Equal windows have
it at the same place, so a window that occurs twice is never missed. At the window's own length, occurrences behind
the first one are removed; with ``longest``, doubling goes on until no candidate survives.

Windows travel as hashes (64 bits) with their places, packed by reducer. A task first looks among its own rows: of
equal windows only the first goes on, so a passage that a third of all documents share reaches a reducer once for
each chunk of words, and no reducer holds a hot window's occurrences.

Words are compared as they are. A null text has no words. Null ids come first. Rows that share an id but not the text
are ordered by a hash of the text; equal rows count as one document, get equal results, and remove nothing from each
other. Columns besides doc_id and text are left out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import Words, reducers, shelve, ship, table, windows

WINDOW = 20
#: Words that a task looks at together before it sends their windows on.
CHUNK = 1_000_000
PLACED = "part int, hashes binary, docs binary, twins binary, starts binary, flags binary"
FOUND = "doc long, twin long, starts binary, later binary"
NO_ID = -(2**63)


class _Text:
    """Packs and unpacks texts; one per task."""

    def __init__(self):
        self.pack, self.unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()

    def packed(self, text: str | None) -> bytes:
        return self.pack.compress((text or "").encode())

    def text(self, data: bytes) -> str:
        return self.unpack.decompress(data).decode()


def smallest_places(short: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` consecutive hashes the place of its smallest, the leftmost on ties."""
    n = len(short) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, place = short[:n].copy(), np.arange(n)
    for i in range(1, span):
        less = short[i : n + i] < best
        best[less] = short[i : n + i][less]
        place[less] = np.nonzero(less)[0] + i
    return place


def _candidates(words: np.ndarray, length: int, repeated: np.ndarray | None, first: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of ``length`` that a level has to test, given what repeated at half of it."""
    if length == first:
        short = windows(words, length)
        starts = np.unique(smallest_places(short, window - length + 1))
        return starts, short[starts]
    half = length // 2
    if half == first:
        place = smallest_places(windows(words, first), window - first + 1)
        starts = np.nonzero(np.isin(place, repeated))[0]
    else:
        starts = np.intersect1d(repeated, repeated - half, assume_unique=True)
    return (starts, windows(words, length)[starts]) if len(starts) else (starts, np.empty(0, np.uint64))


class _Chunk:
    """Windows of some documents, and how they are sent on."""

    def __init__(self, parts: int):
        self.parts, self.size, self.hashes, self.docs, self.twins, self.starts = parts, 0, [], [], [], []

    def add(self, doc: int, twin: int, starts: np.ndarray, hashes: np.ndarray, size: int) -> None:
        self.hashes.append(hashes)
        self.docs.append(np.full(len(starts), doc, np.int64))
        self.twins.append(np.full(len(starts), twin, np.int64))
        self.starts.append(starts.astype(np.uint32))
        self.size += size

    def rows(self) -> Iterator[tuple]:
        """To the reducer of each hash its first window here, flagged if it is not alone; the others are found already."""
        if not self.hashes:
            return
        hashes, docs, twins, starts = map(np.concatenate, (self.hashes, self.docs, self.twins, self.starts))
        order = np.lexsort((starts, twins, docs, hashes))
        h = hashes[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        first = order[new]
        same = np.zeros(len(h), bool)  # an equal row: the same place as the one before it
        same[1:] = ~new[1:] & (docs[order][1:] == docs[order][:-1]) & (twins[order][1:] == twins[order][:-1]) & (
            starts[order][1:] == starts[order][:-1]
        )
        group = np.cumsum(new) - 1
        distinct = np.bincount(group[~same], minlength=len(first)) if len(h) else np.empty(0, int)
        others = order[~new & ~same]
        for at in _cut((hashes[first] >> np.uint64(32)) % np.uint64(self.parts)):
            f = np.sort(first[at])
            flags = (distinct[group[np.searchsorted(h, hashes[f])]] > 1).astype(np.uint8)
            part = int((int(hashes[f[0]]) >> 32) % self.parts)
            yield part, hashes[f].tobytes(), docs[f].tobytes(), twins[f].tobytes(), starts[f].tobytes(), flags.tobytes()
        for at in _cut((docs[others].view(np.uint64)) % np.uint64(self.parts)):
            o = np.sort(others[at])
            part = int(int(docs[o[0]]) % 2**64 % self.parts)
            yield part, None, docs[o].tobytes(), twins[o].tobytes(), starts[o].tobytes(), None
        self.__init__(self.parts)


def _cut(part: np.ndarray) -> Iterator[np.ndarray]:
    """Places of equal parts."""
    if len(part):
        order = np.argsort(part, kind="stable")
        yield from np.split(order, np.nonzero(np.diff(part[order]))[0] + 1)


def _found(docs: np.ndarray, twins: np.ndarray, starts: np.ndarray, later: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row for each reducer that gathers what was found in some documents."""
    cuts = list(_cut(docs.view(np.uint64) % np.uint64(parts)))
    part = pa.array([int(int(docs[at[0]]) % 2**64 % parts) for at in cuts], pa.int32())
    packed = [pa.array([c[at].tobytes() for at in cuts], pa.binary()) for c in (docs, twins, starts, later)]
    return pa.RecordBatch.from_arrays([part, *packed], ["part", "docs", "twins", "starts", "later"])


def _gathered(found: DataFrame, parts: int) -> DataFrame:
    """(doc, twin, starts, later): a row for each document in which something was found."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[list[np.ndarray]] = [[], [], [], []]
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(1, 5)), strict=True):
                for to, kind, value in zip(got, (np.int64, np.int64, np.uint32, np.uint8), row, strict=True):
                    to.append(np.frombuffer(value.as_py(), kind))
        if got[0]:
            docs, twins, starts, later = map(np.concatenate, got)
            order = np.lexsort((starts, twins, docs))
            docs, twins, starts, later = docs[order], twins[order], starts[order], later[order]
            cuts = np.nonzero((docs[1:] != docs[:-1]) | (twins[1:] != twins[:-1]))[0] + 1
            at = np.concatenate([[0], cuts])
            packed = [pa.array([x.tobytes() for x in np.split(c, cuts)], pa.binary()) for c in (starts, later)]
            yield pa.RecordBatch.from_arrays([pa.array(docs[at]), pa.array(twins[at]), *packed], ["doc", "twin", "starts", "later"])

    return found.repartitionById(parts, F.col("part")).mapInArrow(rows, FOUND)


def _repeats(placed: DataFrame, parts: int, firsts: bool) -> DataFrame:
    """(doc, twin, starts, later) of windows that occur more than once; without ``firsts`` only those behind the first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[np.ndarray]] = [[], [], [], [], []]
        kinds = (np.uint64, np.int64, np.int64, np.uint32, np.uint8)
        for batch in batches:
            passed: list[list[np.ndarray]] = [[], [], []]
            for row in zip(*(batch.column(i) for i in range(1, 6)), strict=True):
                values = [x.as_py() for x in row]
                if values[0] is None:
                    for to, kind, value in zip(passed, kinds[1:4], values[1:4], strict=True):
                        to.append(np.frombuffer(value, kind))
                else:
                    for to, kind, value in zip(kept, kinds, values, strict=True):
                        to.append(np.frombuffer(value, kind))
            if passed[0]:
                d, t, s = map(np.concatenate, passed)
                yield _found(d, t, s, np.ones(len(d), np.uint8), parts)
        if not kept[0]:
            return
        hashes, docs, twins, starts, flags = map(np.concatenate, kept)
        order = np.lexsort((starts, twins, docs, hashes))
        hashes, docs, twins, starts, flags = (x[order] for x in (hashes, docs, twins, starts, flags))
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        same = np.zeros(len(hashes), bool)
        same[1:] = ~new[1:] & (docs[1:] == docs[:-1]) & (twins[1:] == twins[:-1]) & (starts[1:] == starts[:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        later = (docs != docs[head]) | (twins != twins[head]) | (starts != starts[head])
        group = np.cumsum(new) - 1
        many = np.bincount(group[later], minlength=group[-1] + 1) > 0
        np.logical_or.at(many, group, flags > 0)
        take = many[group] & ~same if firsts else later & ~same
        yield _found(docs[take], twins[take], starts[take], later[take].astype(np.uint8), parts)

    packed = "part int, docs binary, twins binary, starts binary, later binary"
    return _gathered(placed.repartitionById(parts, F.col("part")).mapInArrow(rows, packed), parts)


def _joined(texts: DataFrame, found: DataFrame) -> DataFrame:
    """``texts`` (doc_id, doc, twin, packed) with what was found in each."""
    return texts.join(found, ["doc", "twin"], "left")


def _flat(packed: bytes | None, kind: type) -> np.ndarray:
    return np.frombuffer(packed or b"", kind)


def _placed(rows: DataFrame, parts: int, length: int, first: int, window: int) -> DataFrame:
    """Windows to test at ``length``; ``rows`` has (doc_id, text) at the first level, else (doc, twin, packed, starts)."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, chunk, texts = Words(lower=False), _Chunk(parts), _Text()

        def out() -> Iterator[pa.RecordBatch]:
            if got := list(chunk.rows()):
                kinds = (pa.int32(), *[pa.binary()] * 5)
                names = ["part", "hashes", "docs", "twins", "starts", "flags"]
                columns = [pa.array(c, k) for c, k in zip(zip(*got, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                if length == first:
                    doc, text = row[0].as_py(), row[1].as_py() or ""
                    doc, twin, repeated = NO_ID if doc is None else doc, _twin(text), None
                else:
                    doc, twin, text = row[0].as_py(), row[1].as_py(), texts.text(row[2].as_py())
                    repeated = np.unique(_flat(row[3].as_py(), np.uint32)).astype(np.int64)
                h = words.hashes(text)
                starts, hashes = _candidates(h, length, repeated, first, window)
                if len(starts):
                    chunk.add(doc, twin, starts, hashes, len(h))
                if chunk.size >= CHUNK:
                    yield from out()
        yield from out()

    return rows.mapInArrow(go, PLACED)


def _twin(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - 2**63


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, twin, packed): each row's place in the order of documents, and its text, compressed to be moved."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _Text()
        for batch in batches:
            ids, values = batch.column(0), [t.as_py() or "" for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [ids, ids.fill_null(NO_ID), pa.array(map(_twin, values), pa.int64()), pa.array(map(texts.packed, values), pa.binary())],
                ["doc_id", "doc", "twin", "packed"],
            )

    return docs.mapInArrow(go, "doc_id long, doc long, twin long, packed binary")


def remove_repeats(docs: DataFrame, window: int = WINDOW, longest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept[, longest]) of each row of ``docs``.

    ``kept`` is the text left, its words joined by single spaces. ``window`` is even. ``longest``: go on doubling and
    report the greatest length window * 2^k at which the document has a repeated window, 0 if none.
    """
    if window < 2 or window % 2:
        raise ValueError("window must be an even number of words")
    ship(docs.sparkSession)
    parts, first = reducers(docs), window // 2
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")

    repeated = _repeats(_placed(docs, parts, first, first, window), parts, firsts=True).drop("later")
    texts = shelve(_joined(_packed(docs), repeated))
    level = texts.where("starts is not null").select("doc", "twin", "packed", "starts")
    found = _repeats(_placed(level, parts, window, first, window), parts, firsts=longest)
    rows = _joined(texts.drop("starts"), found)

    reach = None
    if longest:
        rows = shelve(rows)
        length, level = window, rows.where("starts is not null").select("doc", "twin", "packed", "starts")
        reach = level.select("doc", "twin", F.lit(length).alias("longest"))
        while not level.isEmpty():
            length *= 2
            further = _repeats(_placed(level, parts, length, first, window), parts, firsts=True)
            level = shelve(_joined(level.drop("starts"), further).where("starts is not null").drop("later"))
            reach = reach.unionByName(level.select("doc", "twin", F.lit(length).alias("longest")))
        reach = reach.groupBy("doc", "twin").agg(F.max("longest").alias("longest"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _Text()
        for batch in batches:
            out = []
            for packed, starts, later in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                words = texts.text(packed.as_py()).encode().split()
                at = _flat(starts.as_py(), np.uint32)[_flat(later.as_py(), np.uint8) > 0].astype(np.int64)
                covered = np.zeros(len(words) + 1, np.int64)
                np.add.at(covered, at, 1)
                np.add.at(covered, at + window, -1)
                left = np.cumsum(covered)[:-1] == 0
                text = b" ".join(words if not len(at) else [w for w, k in zip(words, left, strict=True) if k])
                out.append((len(words), int((~left).sum()), hashlib.sha256(text).hexdigest(), text.decode()))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 4, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, batch.column(4), batch.column(5)],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "doc", "twin"],
            )

    out = rows.select("doc_id", "packed", "starts", "later", "doc", "twin").mapInArrow(
        kept, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, doc long, twin long"
    )
    if reach is not None:
        out = out.join(reach, ["doc", "twin"], "left").withColumn("longest", F.coalesce("longest", F.lit(0)))
    return out.drop("doc", "twin")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


OP5_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), cut AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS passage
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM texts)
), later AS (
  SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) AS place FROM cut) WHERE place > 1
), covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
each AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM texts),
marked AS (SELECT e.*, c.i IS NOT NULL AS gone FROM each e LEFT JOIN covered c ON c.doc_id = e.doc_id AND c.i = e.i),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id
"""
