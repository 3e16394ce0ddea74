"""Approximate nearest neighbours by learned partitions.

A sample's neighbour graph is cut into parts of equal size that separate as few neighbours as possible; a small classifier
learns from a vector which parts its neighbours are in. All vectors are put into the part that the classifier holds most
probable. A query visits the parts in order of probability, at least two, until they hold as much of it as was
needed on vectors kept back from the fit to find ``RECALL`` of their neighbours; what is in them is compared by cosine.

A part that is still large is cut again in the same way, so parts keep their size as the table grows, and each model stays
small; models are fitted in tasks, on about ``SAMPLE`` vectors of the part each. Every vector is indexed. Parts that can't be
cut, as all their vectors are too much alike, are searched in slices, whole.

Equal vectors are one entry with their smallest ids, one more than can be asked for, so copies are neither indexed nor
compared twice however many there are, and none that belongs to a result is lost. A query vector is searched once for all
rows that have it.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without an id. Vectors of
different length are not compared. Rows equal in id and vector count once; rows with a query's id are its own and no results of
it. Columns besides vec_id and embedding are left out. Without queries or vectors there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtide.llm.common import shelve, ship, table

NEAREST = 5
#: Rows whose id this divides are queries.
EVERY = 50
#: Vectors that a part is fitted on, about.
SAMPLE = 8_192
#: A part with more vectors than this is cut, into so many parts.
LOAD = 8_192
PARTS = 16
#: Parts with more than this share of what was cut are not cut again.
PROGRESS = 0.8
#: Share of the neighbours kept back from the fit that the visited parts must hold.
RECALL = 0.95
#: Neighbours of a vector in the graph, hidden units, rounds of training.
NEIGHBOURS = 10
HIDDEN = 96
ROUNDS = 30
#: Vectors of a slice, queries compared with it at a time.
SLICE = 8_192
BLOCK = 256
SEED = 12


def neighbour_graph(unit: np.ndarray, k: int) -> np.ndarray:
    """(vectors, k): the nearest others of each vector, by exact comparison in blocks."""
    k = min(k, len(unit) - 1)
    out = np.empty((len(unit), k), np.int64)
    for i in range(0, len(unit), 1024):
        near = unit[i : i + 1024] @ unit.T
        near[np.arange(len(near)), np.arange(i, i + len(near))] = -np.inf
        out[i : i + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def _halves(nodes: np.ndarray, edges: np.ndarray, first: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """``nodes`` in two sets, the first of ``first`` of them, with few edges between: the second eigenvector of the random
    walk tells the order, then pairs of nodes change sides as long as that saves edges."""
    n = len(nodes)
    a, b = edges
    degree = np.maximum(1, np.bincount(a, minlength=n)).astype(float)
    root = np.sqrt(degree)
    still = root / np.linalg.norm(root)
    v = rng.standard_normal(n)
    for _ in range(60):
        v -= still * (still @ v)
        v = v + np.bincount(a, (v / root)[b], n) / root
        v /= np.linalg.norm(v) or 1.0
    side = np.zeros(n, bool)
    side[np.argsort(v / root, kind="stable")[:first]] = True
    for _ in range(8):
        same = np.bincount(a, side[a] == side[b], n)
        gain = np.bincount(a, minlength=n) - 2 * same
        here, there = np.nonzero(side)[0], np.nonzero(~side)[0]
        here, there = here[np.argsort(-gain[here], kind="stable")], there[np.argsort(-gain[there], kind="stable")]
        pairs = min(len(here), len(there))
        swap = np.nonzero(gain[here[:pairs]] + gain[there[:pairs]] > 2)[0]
        swap = swap[: max(1, len(swap) // 2)] if len(swap) else swap  # all at once would undo each other
        if not len(swap):
            break
        side[here[swap]], side[there[swap]] = False, True
    return np.nonzero(side)[0], np.nonzero(~side)[0]


def balanced_parts(graph: np.ndarray, parts: int, seed: int = SEED) -> np.ndarray:
    """A part for each node, sizes equal up to one, by halving the graph again and again."""
    n, rng = len(graph), np.random.default_rng(seed)
    a, b = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    pairs = np.unique(np.concatenate([a * n + b, b * n + a]))
    out = np.zeros(n, np.int64)
    todo = [(np.arange(n), np.stack([pairs // n, pairs % n]), parts, 0)]
    while todo:
        nodes, edges, count, base = todo.pop()
        if count == 1:
            out[nodes] = base
            continue
        left = count // 2
        for half, share, start in zip(_halves(nodes, edges, len(nodes) * left // count, rng), (left, count - left), (base, base + left), strict=True):
            place = np.full(len(nodes), -1)
            place[half] = np.arange(len(half))
            moved = place[edges]
            todo.append((nodes[half], moved[:, (moved >= 0).all(axis=0)], share, start))
    return out


class Router:
    """Which parts a vector's neighbours are in: one hidden layer and a softmax. ``mass`` is how much of the probability a
    query's parts must hold."""

    def __init__(self, weights: list[np.ndarray], mass: float):
        self.weights, self.mass = weights, mass

    @classmethod
    def fit(cls, unit: np.ndarray, parts: int, recall: float = RECALL, seed: int = SEED) -> Router:
        rng = np.random.default_rng(seed)
        graph = neighbour_graph(unit, NEIGHBOURS)
        part = balanced_parts(graph, parts, seed)
        goal = np.zeros((len(unit), parts))
        np.add.at(goal, (np.repeat(np.arange(len(unit)), graph.shape[1]), part[graph].ravel()), 1.0)
        goal[np.arange(len(unit)), part] += graph.shape[1]
        goal /= goal.sum(axis=1, keepdims=True)
        back = rng.permutation(len(unit))
        back, train = back[: len(unit) // 5], back[len(unit) // 5 :]
        dim = unit.shape[1]
        weights = [
            rng.standard_normal((dim, HIDDEN)) * np.sqrt(2 / dim) * np.sqrt(dim), np.zeros(HIDDEN),
            rng.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts),
        ]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for at in range(ROUNDS):
            order = rng.permutation(train)
            rate = 0.01 * 0.5 * (1 + np.cos(np.pi * at / ROUNDS))
            for i in range(0, len(order), 256):
                some, step = order[i : i + 256], step + 1
                hidden = np.maximum(0, unit[some] @ weights[0] + weights[1])
                wrong = (_softmax(hidden @ weights[2] + weights[3]) - goal[some]) / len(some)
                down = (wrong @ weights[2].T) * (hidden > 0)
                slopes = [unit[some].T @ down, down.sum(axis=0), hidden.T @ wrong, wrong.sum(axis=0)]
                for w, s, m, v in zip(weights, slopes, first, second, strict=True):
                    m += 0.1 * (s - m)
                    v += 0.001 * (s * s - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        out = cls(weights, 0.0)
        # How much probability lies before the part of each neighbour of a vector that was kept back.
        likely, home = out.likely(unit[back]), out.likely(unit).argmax(axis=1)
        order = np.argsort(-likely, axis=1, kind="stable")
        ranked = np.take_along_axis(likely, order, axis=1)
        before = np.empty_like(ranked)
        np.put_along_axis(before, order, np.cumsum(ranked, axis=1) - ranked, axis=1)
        needed = np.take_along_axis(before, home[graph[back]], axis=1).ravel()
        out.mass = float(np.quantile(needed, recall, method="higher")) if len(needed) else 1.0
        return out

    def likely(self, unit: np.ndarray) -> np.ndarray:
        w = self.weights
        return _softmax(np.maximum(0, unit @ w[0] + w[1]) @ w[2] + w[3])

    def visited(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, parts): the parts that queries visit."""
        likely = self.likely(unit)
        order = np.argsort(-likely, axis=1, kind="stable")
        ranked = np.take_along_axis(likely, order, axis=1)
        take = np.cumsum(ranked, axis=1) - ranked <= self.mass
        take[:, :2] = True
        out = np.empty_like(take)
        np.put_along_axis(out, order, take, axis=1)
        return out

    def packed(self) -> bytes:
        w = self.weights
        return np.concatenate([[self.mass, *w[0].shape, w[2].shape[1]], *(x.ravel() for x in w)]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Router:
        flat = np.frombuffer(data)
        dim, hidden, parts = map(int, flat[1:4])
        sizes = [dim * hidden, hidden, hidden * parts]
        a, b, c, d = np.split(flat[4:], np.cumsum(sizes))
        return cls([a.reshape(dim, hidden), b, c.reshape(hidden, parts), d], float(flat[0]))


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _units(packed: list[bytes]) -> np.ndarray:
    vectors = np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that no square overflows
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _keyed(rows: DataFrame) -> DataFrame:
    """(vec_id, key, vector) of the rows that take part; the key is a hash of the vector's bytes."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            ends = np.asarray(vectors.offsets)
            flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            flat = np.where(vectors.values.is_null().to_numpy(zero_copy_only=False), np.nan, flat) if vectors.values.null_count else flat
            there = ~(ids.is_null().to_numpy(zero_copy_only=False) | vectors.is_null().to_numpy(zero_copy_only=False))
            out = []
            for i in np.nonzero(there)[0]:
                v = flat[ends[i] : ends[i + 1]]
                if len(v) and np.isfinite(v).all() and v.any():
                    data = v.tobytes()
                    out.append((ids[int(i)].as_py(), xxhash.xxh3_128_hexdigest(data), data))
            columns = zip(*out, strict=True) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.binary()), strict=True)], ["vec_id", "key", "vector"]
            )

    rows = rows.selectExpr("cast(vec_id as long) vec_id", "cast(embedding as array<double>) embedding")
    return rows.mapInArrow(go, "vec_id long, key string, vector binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Groups of sorted rows by their first ``keys`` columns, as iterators that are to be read to their end."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    held: list[tuple] = []

    def group(key: tuple) -> Iterator[tuple]:
        yield held.pop()[keys:]
        for row in rows:
            if row[:keys] != key:
                held.append(row)
                return
            yield row[keys:]

    for row in rows:
        held.append(row)
        while held:
            yield held[0][:keys], group(held[0][:keys])


def _blocks(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    block = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    """Rows (part, slice, ...) grouped into tasks, about ``SLICE`` vectors each."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // SLICE))
    return rows.repartition(parts, "part", "slice").sortWithinPartitions("part", "slice", *order)


def _routers(large: DataFrame, recall: float) -> DataFrame:
    """(part, router) of large parts (part, n, key, vector): fitted on a sample by the keys, which are hashes."""
    low = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    sample = large.where(low * F.col("n") < F.lit(SAMPLE) * F.lit(2**32)).select("part", "key", "vector")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part,), rows in _groups(batches, 1):
            unit = _units([r[1] for r in rows])
            if len(unit) < 4 * PARTS:
                continue
            router = Router.fit(unit, PARTS, recall)
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([router.packed()], pa.binary())], ["part", "router"])

    parts = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sample.repartition(parts, "part").sortWithinPartitions("part", "key").mapInArrow(go, "part string, router binary")


def _routed(rows: DataFrame, routers: DataFrame) -> DataFrame:
    """Rows (part, n, query, key, vector) of large parts, each in the parts below: a vector in one, a query in those it visits.
    Routers are read once for each slice of a part."""
    slices = F.ceil(F.col("n") / SLICE).cast("int")
    own = F.pmod(F.xxhash64("key"), slices).cast("int").alias("slice")
    heads = rows.select("part", "n").distinct().join(routers, "part")
    heads = heads.select("part", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), F.lit("").alias("key"), F.lit(None).cast("boolean").alias("query"), F.col("router").alias("vector"))
    both = heads.unionByName(rows.join(routers.select("part"), "part", "left_semi").select("part", own, "key", "query", "vector"))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, _), group in _groups(batches, 2):
            router = Router.unpacked(next(group)[2])
            for block in _blocks(group, 1024):
                unit, out = _units([r[2] for r in block]), []
                home, visited = router.likely(unit).argmax(axis=1), router.visited(unit)
                for (key, query, vector), at, seen in zip(block, home.tolist(), visited, strict=True):
                    to = np.nonzero(seen)[0].tolist() if query else [at]
                    out += [(f"{part}.{p}", query, key, vector) for p in to]
                kinds = (pa.string(), pa.bool_(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["part", "query", "key", "vector"]
                )

    return _dealt(both.select("part", "slice", "key", "query", "vector"), "key", "query").mapInArrow(
        go, "part string, query boolean, key string, vector binary"
    )


def indexed(entries: DataFrame, recall: float = RECALL) -> DataFrame:
    """(part, query, key, vector): each vector of ``entries`` (key, asked, vector) in its part, and a row with ``query`` for each
    part that a vector which is asked for visits."""
    first = F.concat(F.lit("d"), (F.length("vector") / 8).cast("int").cast("string"))
    rows = entries.select(first.alias("part"), F.explode(F.when(F.col("asked"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("query"), "key", "vector")
    rows, were, done = shelve(rows), None, []
    while True:
        sizes = rows.where(~F.col("query")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        cut = F.col("n") > LOAD
        if were is not None:  # a part that took nearly all of what was cut is left as it is
            up = sizes.withColumn("up", F.regexp_replace("part", r"\.[^.]*$", "")).join(were, "up", "left")
            sizes = up.select("part", "n", (cut & (F.col("n") <= PROGRESS * F.col("up_n"))).alias("cut"))
        else:
            sizes = sizes.withColumn("cut", cut)
        sizes = shelve(sizes)
        if sizes.where("cut").isEmpty():
            done.append(rows)
            break
        large = shelve(rows.join(sizes.where("cut").select("part", "n"), "part"))
        routers = shelve(_routers(large.where(~F.col("query")), recall))
        done.append(rows.join(routers.select("part"), "part", "left_anti"))
        were = sizes.select(F.col("part").alias("up"), F.col("n").alias("up_n"))
        rows = shelve(_routed(large, routers))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _compared(index: DataFrame, keep: int) -> DataFrame:
    """(key, score, found): for each query vector the ``keep`` nearest vectors of each slice that it visits.

    Scores of the nearest by block products are worked out again pair by pair, so that they do not depend on the block.
    """
    sizes = index.where(~F.col("query")).groupBy("part").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices"))
    rows = index.join(sizes, "part")  # a query that visits a part without vectors finds nothing there
    own = F.array(F.pmod(F.xxhash64("key"), F.col("slices")).cast("int"))
    every = F.sequence(F.lit(0), F.col("slices") - 1)
    sent = rows.select("part", F.explode(F.when(F.col("query"), every).otherwise(own)).alias("slice"), "query", "key", "vector")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _groups(batches, 2):
            keys, unit, vectors = [], None, []
            for block in _blocks(group, BLOCK):
                new = [r for r in block if not r[0]]
                keys += [r[1] for r in new]
                vectors += [r[2] for r in new]
                asked = [r for r in block if r[0]]
                if not asked:
                    continue
                unit = _units(vectors) if unit is None else unit
                wanted = _units([r[2] for r in asked])
                near, take = wanted @ unit.T, min(keep, len(keys))
                floor = np.partition(near, -take, axis=1)[:, -take] - 1e-9
                q, v = np.nonzero(near >= floor[:, None])
                scores = np.empty(len(q))
                for i in range(0, len(q), 65_536):
                    scores[i : i + 65_536] = np.einsum("ij,ij->i", wanted[q[i : i + 65_536]], unit[v[i : i + 65_536]])
                order = np.lexsort((-scores, q))
                q, v, scores = q[order], v[order], scores[order]
                # the smallest of the best scores stays with all that equal it
                starts = np.searchsorted(q, np.arange(len(asked)))
                least = scores[starts + take - 1]
                stay = scores >= least[q]
                q, v, scores = q[stay], v[stay], scores[stay]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([asked[i][1] for i in q.tolist()], pa.string()), pa.array(scores), pa.array([keys[i] for i in v.tolist()], pa.string())],
                    ["key", "score", "found"],
                )

    return _dealt(sent.select("part", "slice", "query", "key", "vector"), "query", "key").mapInArrow(
        go, "key string, score double, found string"
    )


def nearest(rows: DataFrame, k: int = NEAREST, every: int = EVERY, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for the rows whose vec_id ``every`` divides."""
    ship(rows.sparkSession)
    keyed = shelve(_keyed(rows).distinct())
    asked = F.col("vec_id") % every == 0
    least = Window.partitionBy("key").orderBy("vec_id")
    ids = keyed.select("key", "vec_id").withColumn("at", F.row_number().over(least)).where(F.col("at") <= k + 1).drop("at")
    entries = keyed.groupBy("key").agg(F.max(asked).alias("asked"), F.min("vector").alias("vector"))
    found = _compared(indexed(shelve(entries), recall), k + 1)
    # by equal vectors with their ids, the k + 1 nearest rows of each query vector: its own may be among them
    order = (F.col("score").desc(), F.col("vec_id"))
    named = found.join(ids.select(F.col("key").alias("found"), "vec_id"), "found").select("key", "score", "vec_id")
    best = named.withColumn("at", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where(F.col("at") <= k + 1)
    lists = shelve(best.groupBy("key").agg(F.collect_list(F.struct("score", "vec_id")).alias("best")))
    queries = keyed.where(asked).select(F.col("vec_id").alias("query_id"), "key").join(lists, "key")
    others = F.filter("best", lambda b: b["vec_id"] != F.col("query_id"))
    ranked = F.sort_array(F.transform(others, lambda b: F.struct((-b["score"]).alias("far"), b["vec_id"].alias("vec_id"))))
    out = queries.select("query_id", F.posexplode(F.slice(ranked, 1, k)).alias("at", "b"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.far")).alias("score"))


def op12_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
