"""N-gram Jaccard join: documents whose sets of word n-grams are at least 85 % alike, and what such links connect.

One minus Jaccard similarity is a metric, and the join works by it: pivots cut a set of documents into Voronoi
regions; by the triangle inequality only documents near a border can have partners across it, and these are copied to
the regions they are near to; regions are cut again until one task can compare what is in them exactly.

Pivots cannot part documents that share nothing: each is at distance 1 from all others, and every border would run
through all of them. So an exact cut comes first. The range of hashes is cut into more parts than two linked sets
of a size can have differences; some part is then equal in both, and not empty. Documents with an equal part are put
in one block. Blocks are what connects, not pairs: a task sends one set on for each part's content and keeps
the others by a link to it, so content that any share of the documents has reaches a reducer once for each chunk. Two sets
with many equal parts are told to be linked where the first of these meet, not at each, however many reducers there are.

Everything works on distinct sets, numbered as they are written; ids of documents come in again at the end.

Words are lower-cased (A-Z) runs of anything but ASCII blanks. A text of fewer words than ``N`` is one n-gram; an empty
or null text has none, is linked with nothing and is its own component. Sets are of 64-bit hashes. Null ids come
first. Rows are linked by their texts only: rows with equal sets are, rows that share an id and nothing else are not. Other
columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtide.llm.common import Words, components, mix, reducers, shelve, ship, short_batches, table, windows

N = 4
#: A link: PERCENT of the union is common.
PERCENT = 85
#: Words of a chunk, see above.
CHUNK = 1_000_000
#: A region with at most so many documents and n-grams is compared in one task.
REGION = 16_384
REGION_GRAMS = 4_000_000
#: Pivots for each region that is cut.
PIVOTS = 16
#: Regions that keep more than this part of the region they come from are not cut again but compared in tiles.
PROGRESS = 0.7
#: Sizes of a class of signatures, each this times the last.
CLASS = 1.5
#: Ranges of the signatures; of each range a set's smallest one is where it meets others that have it as smallest, too.
RANGES = 2
#: Words whose hashes a task remembers.
KNOWN_WORDS = 100_000
#: Bits of a map of rows for each of these; of other rows one in so many is taken for one of them.
BITS = 16
#: Bits in a row that ``bitmap_construct_agg`` makes.
BUCKET = 32_768
NONE = np.uint64(2**64 - 1)
NO_ID = -(2**63)


def grams(words: np.ndarray, n: int = N) -> np.ndarray:
    """The sorted set of hashes of n-grams."""
    if not len(words):
        return np.empty(0, np.uint64)
    size = min(n, len(words))
    return np.unique(mix(windows(words, size) + np.uint64(size)))


@cache
def _classes(percent: int) -> list[tuple[int, int, int]]:
    """(largest size, most differences of two linked sets, parts) by class; a class with no difference needs no parts."""
    out, top = [], 4.0
    while top < 2**40:
        size = int(top)
        k = 2 * size * (100 - percent) // (100 + percent)
        out.append((size, k, k + 3 + k // 20))
        top *= CLASS
    return out


@cache
def _borders(parts: int) -> np.ndarray:
    return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)


def signatures(members: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Hashes of the contents of the parts, in the set's class and in those above it that a partner can be in.

    With ``parts - k`` equal parts at least, one of them is not empty unless a set has as many empty parts; sets
    that do share a signature of their own. Of many signatures the smallest are enough, one more than this set can have
    differences with its largest partner of the class: if all of these were in parts that differ, too many would.
    """
    n, out = len(members), []
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(members))])
    classes = _classes(percent)
    largest = n * 100 // percent
    at = next(i for i, c in enumerate(classes) if n <= c[0])
    last = next(i for i, c in enumerate(classes) if largest <= c[0])
    for i in range(at, last + 1):
        top, k, parts = classes[i]
        if not k:
            continue
        cuts = np.concatenate([[0], np.searchsorted(members, _borders(parts)), [n]])
        full = np.nonzero(np.diff(cuts))[0]
        salt = mix(np.uint64(i << 40) + full.astype(np.uint64) + np.uint64(1))
        own = mix((sums[cuts[full + 1]] - sums[cuts[full]]) ^ salt)
        few = (n + min(top, largest)) * (100 - percent) // (100 + percent)
        out.append(own if len(own) <= few else np.partition(own, few)[: few + 1])
        if parts - len(full) >= parts - k:
            out.append(mix(np.array([(i << 40) + (1 << 39)], np.uint64)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _stars(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows (key, doc): the keys with the smallest document that they connect, and each other document's link to it."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    head = docs[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    other = docs != head
    root: dict[int, int] = {}

    def find(i: int) -> int:
        while (up := root.get(i, i)) != i:
            root[i] = i = root.get(up, up)
        return i

    for a, b in np.unique(np.stack([docs[other], head[other]]), axis=1).T.tolist():
        a, b = find(a), find(b)
        root[max(a, b)] = root[min(a, b)] = min(a, b)
    tops = {a: find(a) for a in root}
    heads = np.array([tops.get(d, d) for d in docs[new].tolist()], np.int64)
    links = np.array([x for x in tops.items() if x[0] != x[1]], np.int64).reshape(-1, 2)
    return keys[new], heads, links[:, 0], links[:, 1]


def _firsts(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows (key, owner), sorted by key: the owners, and for each its smallest key in every range."""
    names = np.unique(owners)
    out = np.full((len(names), RANGES), NONE)
    for r in range(RANGES):
        here = np.nonzero(keys >> np.uint64(63) == r)[0]
        owner, first = np.unique(owners[here], return_index=True)
        out[np.searchsorted(names, owner), r] = keys[here[first]]
    return names, out


def _told(keys: np.ndarray, docs: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the sets with a key in common, of rows (key, set, the set's smallest keys).

    At a key, the sets that have it as smallest of its range are linked to one of them. Of all others with the key only those
    are linked that have no smallest key in common: these are connected where that key is.
    """
    order = np.lexsort((docs, keys))
    keys, docs, firsts = keys[order], docs[order], firsts[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    apart = ~((firsts == firsts[head]) & (firsts != NONE)).any(axis=1) & (docs != docs[head])
    pairs = [np.stack([docs[apart], docs[head[apart]]])]
    own = np.nonzero((firsts == keys[:, None]).any(axis=1))[0]
    if len(own):
        begin = np.ones(len(own), bool)
        begin[1:] = keys[own[1:]] != keys[own[:-1]]
        hub = own[np.maximum.accumulate(np.where(begin, np.arange(len(own)), 0))]
        other = docs[own] != docs[hub]
        pairs.append(np.stack([docs[own[other]], docs[hub[other]]]))
    root: dict[int, int] = {}

    def find(i: int) -> int:
        while (up := root.get(i, i)) != i:
            root[i] = i = root.get(up, up)
        return i

    out = []
    for a, b in np.unique(np.concatenate(pairs, axis=1), axis=1).T.tolist():
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    out = np.array(out, np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def _told_once(places: np.ndarray) -> tuple[np.ndarray, bytes | None]:
    """What to send of the sets at these places: each once, with an index of two or four bytes a place, or, where that is
    not less, one for each place without an index."""
    some, index = np.unique(places, return_inverse=True)
    kind, each = (np.uint16 if len(some) <= 1 << 16 else np.int32), 8 + 8 * RANGES
    if np.dtype(kind).itemsize * len(places) + each * len(some) < each * len(places):
        return some, index.astype(kind).tobytes()
    return places, None


def _set_hash(members: np.ndarray) -> np.int64:
    return np.uint64(xxhash.xxh3_64_intdigest(members.tobytes())).view(np.int64)


def _blocks(docs: DataFrame, percent: int, n: int) -> DataFrame:
    """(node, component): the hashes of sets that share a block with others, and the block's smallest hash. Sets of one hash
    are in one block, which costs a comparison and no result."""
    parts = reducers(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, kept, size = Words(lower=True, bound=KNOWN_WORDS), {}, 0

        def out() -> pa.RecordBatch:
            keys, heads, a, b = _stars(np.concatenate(list(kept.values())), np.concatenate([np.full(len(k), d) for d, k in kept.items()]))
            names, firsts = _firsts(keys, heads)
            place = np.searchsorted(names, heads)
            part = (keys >> np.uint64(32)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            borders = np.nonzero(np.diff(part[order]))[0] + 1
            rows = []
            for at in np.split(order, borders):
                some, index = _told_once(place[at])
                rows.append((int(part[at[0]]), keys[at].tobytes(), index, names[some].tobytes(), firsts[some].tobytes()))
            if len(a):
                rows.append((int(a[0]) % parts, None, None, np.concatenate([a, b]).tobytes(), None))
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "keys", "at", "docs", "firsts"]
            )

        for batch in batches:
            for text in batch.column(0):
                got = signatures(members, percent) if len(members := grams(words.hashes(text.as_py()), n)) else members
                if len(got) and (node := int(_set_hash(members))) not in kept:
                    kept[node] = got
                    size += len(members)
                if size >= CHUNK:
                    yield out()
                    kept, size = {}, 0
        if kept:
            yield out()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, firsts = [], [], []
        for batch in batches:
            for k, at, d, f in zip(*(batch.column(i) for i in range(1, 5)), strict=True):
                k, d = k.as_py(), np.frombuffer(d.as_py(), np.int64)
                if k is None:
                    yield pa.RecordBatch.from_arrays([pa.array(d[: len(d) // 2]), pa.array(d[len(d) // 2 :])], ["a", "b"])
                else:
                    at = at.as_py()
                    at = slice(None) if at is None else np.frombuffer(at, np.uint16 if 4 * len(at) == len(k) else np.int32)
                    keys.append(np.frombuffer(k, np.uint64))
                    docs.append(d[at])
                    firsts.append(np.frombuffer(f.as_py(), np.uint64).reshape(-1, RANGES)[at])
        if keys:
            keys, docs, firsts = (np.concatenate(c) for c in (keys, docs, firsts))  # the pieces are not held any longer
            a, b = _told(keys, docs, firsts)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    placed = docs.select("text").mapInArrow(cut, "part int, keys binary, at binary, docs binary, firsts binary")
    return components(placed.repartitionById(parts, F.col("part")).mapInArrow(join, "a long, b long"))


def _prints(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, doc, n_shingles, key, hash, digest): ``key`` stands for the set, null if it is empty, ``digest`` for the text."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True, bound=KNOWN_WORDS)
        for batch in batches:
            sets = [grams(words.hashes(t.as_py()), n) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(0).fill_null(NO_ID), pa.array(map(len, sets), pa.int64()),
                    pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets], pa.string()),
                    pa.array([int(_set_hash(s)) for s in sets], pa.int64()), batch.column(2),
                ],
                ["doc_id", "doc", "n_shingles", "key", "hash", "digest"],
            )

    return docs.mapInArrow(go, "doc_id long, doc long, n_shingles long, key string, hash long, digest string")


def _packed(docs: DataFrame) -> DataFrame:
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = pa.array([pack.compress((t.as_py() or "").encode()) for t in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).fill_null(NO_ID), batch.column(2), texts], ["id", "digest", "packed"])

    return docs.mapInArrow(go, "id long, digest string, packed binary")


class _Sets:
    """Sets of n-grams of packed texts."""

    def __init__(self, n: int):
        self.n, self.words, self.unpack = n, Words(lower=True, bound=KNOWN_WORDS), zstandard.ZstdDecompressor()

    def of(self, packed: bytes) -> np.ndarray:
        return grams(self.words.hashes(self.unpack.decompress(packed).decode()), self.n)


def _common(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of ``rows`` with each of ``columns``: products of 0/1 matrices over the
    n-grams that both sides have, some of these at a time."""
    out = np.zeros((len(rows), len(columns)), np.float32)
    if rows is columns:
        shared, times = np.unique(np.concatenate(rows), return_counts=True)
        shared = shared[times > 1]  # a n-gram of one set alone is common to no pair
    else:
        shared = np.intersect1d(np.concatenate(rows), np.concatenate(columns))
    width = max(256, 8_000_000 // (len(rows) + len(columns)))

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        gram = np.concatenate(sets)
        column = np.searchsorted(shared, gram)
        known = column < len(shared)
        known[known] = shared[column[known]] == gram[known]
        return row[known], column[known]

    (ra, ca), (rb, cb) = places(rows), places(columns)
    for start in range(0, len(shared), width):
        size = min(width, len(shared) - start)
        a, b = np.zeros((len(rows), size), np.float32), np.zeros((len(columns), size), np.float32)
        for matrix, r, c in ((a, ra, ca), (b, rb, cb)):
            here = (c >= start) & (c < start + size)
            matrix[r[here], c[here] - start] = 1
        out += a @ b.T
    return out


def _alone(owner: np.ndarray, grams: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which sets have more n-grams to themselves than a linked set can."""
    order = np.argsort(grams, kind="stable")
    sorted_grams = grams[order]
    differ = np.ones(len(grams) + 1, bool)
    differ[1:-1] = sorted_grams[1:] != sorted_grams[:-1]
    single = order[differ[1:] & differ[:-1]]
    return 100 * np.bincount(owner[single], minlength=len(sizes)) > (100 - percent) * sizes


def _promising(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The sets that can have a link, by the n-grams that no other one has: again and again, as sets fall away."""
    left, sizes = np.arange(len(sets)), np.array([len(s) for s in sets])
    owner, members = np.repeat(left, sizes), np.concatenate(sets)
    while len(left):
        gone = _alone(owner, members, sizes, percent) & (sizes > 0)
        if not gone.any():
            break
        sizes = np.where(gone, 0, sizes)
        stay = ~gone[owner]
        owner, members, left = owner[stay], members[stay], np.nonzero(sizes)[0]
    return left


def _links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what the linked pairs connect; a region is compared block by block, so memory is bounded."""
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    sizes = np.array([len(s) for s in sets])
    # in order of size, only sets of sizes that can be linked meet
    order, out, step = _promising(sets, percent), [], 512
    order = order[np.argsort(sizes[order], kind="stable")]
    for i in range(0, len(order), step):
        rows = order[i : i + step]
        most = sizes[rows[-1]] * 100 // percent
        for j in range(i, len(order), step):
            columns = order[j : j + step]
            columns = columns[sizes[columns] <= most]  # all of them if these are the rows
            if not len(columns):
                break
            left = [sets[x] for x in rows]
            common = _common(left, left if i == j else [sets[x] for x in columns]).astype(np.int64)
            union = sizes[rows][:, None] + sizes[columns][None, :] - common
            for a, b in zip(*np.nonzero((100 * common >= percent * union) & (common > 0)), strict=True):
                a, b = int(rows[a]), int(columns[b])
                if a != b and (x := find(a)) != (y := find(b)):
                    root[x] = y
                    out.append((a, b))
    return out


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches by their first ``keys`` columns; one group is held at a time."""
    key, group = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key:
                if group:
                    yield key, group
                key, group = row[:keys], []
            group.append(row[keys:])
    if group:
        yield key, group


LINKS = "a long, b long"


def _compared(regions: DataFrame, percent: int, n: int, parts: int) -> DataFrame:
    """(a, b) of regions (region, doc, packed) that fit a task each."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(n)
        for _, rows in _grouped(batches, 1):
            docs = [r[0] for r in rows]
            links = _links([sets.of(r[1]) for r in rows], percent)
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([docs[i] for i, _ in links], pa.int64()), pa.array([docs[j] for _, j in links], pa.int64())], ["a", "b"]
                )

    narrow = regions.select("region", "doc", "packed")
    return narrow.repartition(parts, "region").sortWithinPartitions("region", "doc").mapInArrow(go, LINKS)


def _apart(regions: DataFrame, percent: int, n: int, parts: int) -> DataFrame:
    """Large regions without the documents that have more n-grams to themselves there than a linked one can.

    A passage that very many documents share puts them in one block; this takes them out again before any are compared.
    N-grams are counted as signatures are: packed, and from each task once, with a mark if the task has it more often.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, kept, size = _Sets(n), [], 0

        def out() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate([k for k, _ in kept])
            ids = np.concatenate([np.full(len(k), d) for k, d in kept])
            order = np.argsort(keys, kind="stable")
            keys, ids = keys[order], ids[order]
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            many = np.zeros(len(keys), np.uint8)
            many[:-1] |= ~new[1:]
            keys, ids, many = keys[new], ids[new], many[new]
            part = (keys >> np.uint64(32)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            cuts = np.split(order, np.nonzero(np.diff(part[order]))[0] + 1)
            rows = [(int(part[at[0]]), keys[at].tobytes(), ids[at].tobytes(), many[at].tobytes()) for at in cuts if len(at)]
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "keys", "docs", "many"])

        for batch in batches:
            for region, doc, packed in zip(*(batch.column(i) for i in range(3)), strict=True):
                members = sets.of(packed.as_py())
                salt = np.uint64(xxhash.xxh3_64_intdigest(region.as_py()))
                kept.append((mix(members ^ salt), np.int64(doc.as_py())))
                size += len(members)
                if size >= CHUNK:
                    yield from out()
                    kept, size = [], 0
        if kept:
            yield from out()

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[list[np.ndarray]] = [[], [], []]
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(1, 4)), strict=True):
                for to, kind, value in zip(got, (np.uint64, np.int64, np.uint8), row, strict=True):
                    to.append(np.frombuffer(value.as_py(), kind))
        if got[0]:
            keys, docs, many = map(np.concatenate, got)
            order = np.argsort(keys, kind="stable")
            differ = np.ones(len(keys) + 1, bool)
            differ[1:-1] = keys[order][1:] != keys[order][:-1]
            own = order[differ[1:] & differ[:-1]]
            ids, count = np.unique(docs[own[many[own] == 0]], return_counts=True)
            part = ids.view(np.uint64) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            cuts = [at for at in np.split(order, np.nonzero(np.diff(part[order]))[0] + 1) if len(at)]
            packed = [pa.array([c[at].tobytes() for at in cuts], pa.binary()) for c in (ids, count.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array([int(part[at[0]]) for at in cuts], pa.int32()), *packed], ["part", "docs", "own"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[list[np.ndarray]] = [[], []]
        for batch in batches:
            for row in zip(batch.column(1), batch.column(2), strict=True):
                for to, value in zip(got, row, strict=True):
                    to.append(np.frombuffer(value.as_py(), np.int64))
        if got[0]:
            docs, own = map(np.concatenate, got)
            ids, at = np.unique(docs, return_inverse=True)
            total = np.zeros(len(ids), np.int64)
            np.add.at(total, at, own)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["doc", "own"])

    placed = regions.select("region", "doc", "packed").mapInArrow(cut, "part int, keys binary, docs binary, many binary")
    found = placed.repartitionById(parts, F.col("part")).mapInArrow(single, "part int, docs binary, own binary")
    own = found.repartitionById(parts, F.col("part")).mapInArrow(summed, "doc long, own long")
    gone = own.join(regions.select("doc", "n_shingles"), "doc").where(f"100 * own > {100 - percent} * n_shingles").select("doc")
    return regions.join(gone, "doc", "left_anti")


def _voronoi(regions: DataFrame, percent: int, n: int, parts: int, depth: int) -> DataFrame:
    """One cut of large regions (region, doc, n_shingles, packed): (region, doc, n_shingles, packed, a, b).

    Each document goes to the cell of its nearest pivot if that is within three times the link distance, else to the
    far cell. A partner of a document at distance d0 from its pivot is at most d0 + e from that pivot and has no
    nearer pivot than d0 - e, e being the link distance. So a document is copied to the cells of all pivots within
    2 e of its nearest, and to the far cell from one e before its border on. Links to pivots come out as rows with
    ``a`` and ``b``; a pivot has met everybody then and goes no further.
    """
    e, far = 1 - percent / 100, 3 * (1 - percent / 100)
    slot = F.pmod(F.xxhash64("doc", F.lit(depth)), F.lit(PIVOTS))
    pivots = regions.groupBy("region", slot.alias("slot")).agg(F.min_by("doc", F.xxhash64(F.lit(depth), "doc")).alias("doc"))
    pivots = pivots.select("region", "doc", F.lit(True).alias("pivot"))
    marked = regions.join(pivots, ["region", "doc"], "left")
    slices = regions.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / (REGION // 4 + 1)).cast("int").alias("slices"))
    marked = marked.join(slices, "region")
    own = F.array(F.pmod(F.xxhash64("doc"), F.col("slices")).cast("int"))
    every = F.sequence(F.lit(0), F.col("slices") - 1)
    sent = marked.select(
        "region", F.explode(F.when(F.col("pivot"), every).otherwise(own)).alias("slice"),
        F.coalesce("pivot", F.lit(False)).alias("pivot"), "doc", "n_shingles", "packed",
    )

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(n)
        for (region, part), rows in _grouped(batches, 2):
            chosen, rest = [r for r in rows if r[0]], [r for r in rows if not r[0]]
            heads, out = [sets.of(r[3]) for r in chosen], []
            items = [*rest, *chosen] if part == 0 else rest  # pivots meet each other in one slice
            for i in range(0, len(items), 512):
                some = items[i : i + 512]
                members = [sets.of(r[3]) for r in some]
                common = _common(members, heads).astype(np.int64)
                union = np.array([len(m) for m in members])[:, None] + np.array([len(h) for h in heads])[None, :] - common
                near = 100 * common >= percent * union
                distance = 1 - common / union
                for row, linked, d in zip(some, near, distance, strict=True):
                    out += [(None, row[1], None, None, row[1], chosen[p][1]) for p in np.nonzero(linked)[0] if chosen[p][1] != row[1]]
                    if row[0]:
                        continue
                    cells = [f"{region}.{p}" for p in np.nonzero(d <= d.min() + 2 * e + 1e-9)[0]] if d.min() <= far + 1e-9 else []
                    if d.min() > far - e - 1e-9:
                        cells.append(f"{region}.f")
                    out += [(c, *row[1:], None, None) for c in cells]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    ["region", "doc", "n_shingles", "packed", "a", "b"],
                )

    sent = sent.repartition(parts, "region", "slice").sortWithinPartitions("region", "slice", "pivot", "doc")
    return shelve(sent.select("region", "slice", "pivot", "doc", "n_shingles", "packed").mapInArrow(
        go, "region string, doc long, n_shingles long, packed binary, a long, b long"
    ))


def _tiles(regions: DataFrame) -> DataFrame:
    """Large regions that pivots don't part: each pair of slices of it is a region."""
    weight = F.greatest(F.col("docs") / (REGION / 2), F.col("grams") / (REGION_GRAMS / 2))
    slices = F.greatest(F.lit(2), F.ceil(weight).cast("int"))
    own = F.pmod(F.xxhash64("doc", F.lit(-1)), slices).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), slices - 1), lambda i: F.concat_ws(":", F.least(i, own), F.greatest(i, own)))
    return regions.select(F.explode(pairs).alias("tile"), "region", "doc", "packed").select(
        F.concat("region", F.lit("/"), "tile").alias("region"), "doc", "packed"
    )


def _sized(regions: DataFrame) -> DataFrame:
    sizes = regions.groupBy("region").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("grams"))
    return regions.join(sizes.where("docs > 1"), "region")


def _likely(docs: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``docs`` without most of the rows whose ``keys`` are not in ``rows``, and with all whose keys are.

    Before a join of texts with few rows: texts that find nothing there are not moved. The rows are told by a map of bits,
    made in the tasks and broadcast, two bytes for each.
    """
    buckets = -(-BITS * rows.count() // BUCKET) or 1
    bit = F.pmod(F.xxhash64(*keys), F.lit(buckets * BUCKET))
    told = rows.select((bit / BUCKET).cast("int").alias("_bucket"), (bit % BUCKET).alias("_bit"))
    told = told.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    byte = F.substring("_map", (bit % BUCKET / 8).cast("int") + 1, F.lit(1))
    there = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1
    return docs.join(F.broadcast(told), ((bit / BUCKET).cast("int") == F.col("_bucket")) & there, "left_semi")


def grouped(docs: DataFrame, percent: int = PERCENT, n: int = N) -> DataFrame:
    """(doc_id, n_shingles, digest, group, least, known) of each row of ``docs`` (doc_id, text): the number of its component,
    null for an empty set, and the component's smallest id, nulls first (``NO_ID``) and nulls left out."""
    ship(docs.sparkSession)
    with short_batches(docs.sparkSession):  # all that Python does is done in there
        return _grouped_rows(docs, percent, n)


def _grouped_rows(docs: DataFrame, percent: int, n: int) -> DataFrame:
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text", "md5(cast(text as string)) digest")
    parts = reducers(docs)
    prints = shelve(_prints(docs, n))
    one = F.min(F.struct("doc", "digest")).alias("one")  # a row that has the set
    sets = prints.where("key is not null").groupBy("key").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("hash").alias("hash"), one, F.min("doc").alias("least"), F.min("doc_id").alias("known")
    )
    sets = shelve(sets.withColumn("node", F.monotonically_increasing_id()))
    blocks = _blocks(docs, percent, n).select(F.col("node").alias("hash"), F.col("component").cast("string").alias("region"))
    members = blocks.join(sets, "hash").select("region", F.col("node").alias("doc"), "n_shingles", F.col("one.doc").alias("id"), "one.digest")
    members = shelve(_sized(members))
    likely = _likely(docs.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID).cast("long"))), members, ["id", "digest"])
    texts = members.join(_packed(likely.select(*docs.columns)), ["id", "digest"])
    # Id and digest stand for the set, as ``doc`` does, and texts lie by them after the join: they are not moved again.
    texts = texts.dropDuplicates(["id", "digest"])
    regions = shelve(texts.select("region", "doc", "n_shingles", "packed", "docs", "grams"))

    small = (F.col("docs") <= REGION) & (F.col("grams") <= REGION_GRAMS)
    found = [_compared(regions.where(small), percent, n, parts)]
    large, depth = regions.where(~small), 0
    if not large.isEmpty():
        kept = _apart(large.select("region", "doc", "n_shingles", "packed"), percent, n, parts)
        sized = shelve(_sized(kept))
        found.append(_compared(sized.where(small), percent, n, parts))
        large = sized.where(~small)
    while not large.isEmpty():
        cells = _voronoi(large.select("region", "doc", "n_shingles", "packed"), percent, n, parts, depth)
        before = large.select("region", "docs").distinct().withColumnsRenamed({"region": "from", "docs": "were"})
        found.append(cells.where("region is null").select("a", "b"))
        sized = _sized(cells.where("region is not null").drop("a", "b"))
        sized = sized.withColumn("from", F.regexp_replace("region", r"\.[^.]*$", "")).join(before, "from").drop("from")
        sized = shelve(sized)
        stuck = ~small & (F.col("docs") > PROGRESS * F.col("were"))
        found.append(_compared(sized.where(small), percent, n, parts))
        found.append(_compared(_tiles(sized.where(stuck)), percent, n, parts))
        large, depth = sized.where(~small & ~stuck).drop("were"), depth + 1
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    joined = components(links)

    own = sets.join(joined, "node", "left").select("key", F.coalesce("component", "node").alias("group"), "least", "known")
    least = own.groupBy("group").agg(F.min("least").alias("least"), F.min("known").alias("known"))
    by_key = own.select("key", "group").join(least, "group")
    return prints.join(by_key, "key", "left").select("doc_id", "doc", "n_shingles", "digest", "group", "least", "known")


def linked(docs: DataFrame, percent: int = PERCENT, n: int = N) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text)."""
    component = F.coalesce("least", "doc")
    component = F.when(component != NO_ID, component)
    return grouped(docs, percent, n).select("doc_id", "n_shingles", component.alias("component_id"))


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(1, len(words) - 3) + 1),
    lambda i: array_to_string(words[i:i + 3], ' '))) AS shingle FROM texts WHERE len(words) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y
  ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(t.doc_id, l.b) AS component_id
FROM texts t LEFT JOIN sizes s ON s.doc_id = t.doc_id LEFT JOIN least l ON l.a = t.doc_id
"""


def first_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents whose component has one with a smaller doc_id; all columns stay.

    Rows of the smallest id that share a component all stay. Rows without an id go if one of their component has an id; of a
    component without any id one row stays. Documents without words stay.
    """
    groups = grouped(docs, **options)
    rows = docs.select(F.struct("*").alias("row"))  # whatever its columns are called
    rows = rows.select("row", F.col("row.doc_id").cast("long").alias("id"), F.md5(F.col("row.text").cast("string")).alias("digest"))
    gone = groups.where("group is not null and doc_id != known").select(F.col("doc_id").alias("id"), "digest").distinct()
    named = rows.where("id is not null").join(gone, ["id", "digest"], "left_anti").select("row.*")
    of = groups.where("doc_id is null and group is not null").select("digest", "group", "known").distinct()
    nameless = rows.where("id is null").join(of, "digest", "left")
    first = F.row_number().over(Window.partitionBy("group").orderBy("digest"))
    wordless = nameless.where("group is null").select("row.*")  # these are no component
    alone = nameless.where("group is not null and known is null").withColumn("first", first).where("first = 1").select("row.*")
    return named.unionByName(wordless).unionByName(alone)
