"""A Merkle manifest of a dataset: a tree over the rows of each group, and one over the groups' roots.

A leaf is the digest of a row's columns. Leaves of a group stand in order; every ``FAN`` consecutive nodes have a parent
that is the digest of theirs, again and again until one node, the group's root, is left; the roots are leaves of the top tree.
A parent keeps a copy of its hash state from before each child slot. To fold a changed child up, the state before its slot
is resumed with the new digest and the siblings to its right only; nothing to its left is hashed again.

No tree is built in one task. Positions come from a range sort and the counts of its partitions. Each ``CHUNK`` consecutive
nodes of a tree are the subtree of one task, whose roots are the nodes of the next stage, so the table gets ``CHUNK`` times
smaller by each stage. On the way down a subtree gets one row with the path above it, and builds its own levels again from the
written digests; hash states are copied inside a task and live no longer.

Digests are lowercase hex text. A null column is ``-`` in a leaf. Rows of a group are ordered by id, null ids first, rows
with one id by digest; rows equal in all columns take places of their own, and which of them takes which is all one.
A null group comes first. Columns besides the named ones take no part, so names cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtide.llm.common import shelve, ship, table

FAN = 8
#: Levels of a task's subtree, and its leaves.
LEVELS = 4
CHUNK = FAN**LEVELS
#: Rows of a partition of the range sort, beyond the session's number of partitions.
SORTED = 2_000_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_ABOVE = "lefts array<string>, rights array<string>, subroot string"


def digest(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree with ``n`` of them."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def leaf(columns: Sequence[str | Column]) -> Column:
    """Digest of a row: of each column its UTF-8 byte count, a colon and its text, or a dash."""

    def part(c: str | Column) -> Column:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, columns)), 256)


class Subtree:
    """The levels over consecutive nodes; ``states[k][i]`` is the state of the parent of node i of level k before its slot."""

    def __init__(self, nodes: list[str], levels: int):
        self.levels, self.runs, self.states = [nodes], [], []
        for _ in range(levels):
            parents, runs, states = [], [], []
            for i in range(0, len(nodes), FAN):
                run = nodes[i : i + FAN]
                state = hashlib.sha256()
                for child in run:
                    states.append(state.copy())
                    state.update(child.encode())
                parents.append(state.hexdigest())
                runs.append("".join(run))
            self.runs.append(runs)
            self.states.append(states)
            self.levels.append(parents)
            nodes = parents

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """Digests to the left and to the right of node ``at`` and of its ancestors, each side as one text."""
        out = []
        for runs in self.runs:
            run, slot = runs[at // FAN], 64 * (at % FAN)
            out.append((run[:slot], run[slot + 64 :]))
            at //= FAN
        return out

    def fold(self, at: int, node: str) -> str:
        """The root if node ``at`` were ``node``."""
        for runs, states in zip(self.runs, self.states, strict=True):
            state = states[at].copy()
            state.update(node.encode())
            state.update(runs[at // FAN][64 * (at % FAN + 1) :].encode())
            node, at = state.hexdigest(), at // FAN
        return node


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (tree, ...) with ``pos``, the place in its tree by ``order``, and ``n``, the tree's rows.

    The range sort goes by tree and order, and last by a number of the row, so that a large tree, and equal rows too, are cut
    over many partitions. Counts of a partition and tree are all that is joined to the rows.
    """
    spark = rows.sparkSession
    rows = shelve(rows.withColumn("_row", F.monotonically_increasing_id()))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // SORTED))
    keys = ["tree", *order, "_row"]
    fields = [f for f in rows.schema if f.name != "_row"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for name in batch.column("tree").to_pylist():
                tree, at = (name, 0) if name != tree else (tree, at + 1)
                places.append(at)
            columns = [batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())],
                [*(f.name for f in fields), "part", "at"],
            )

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    sort = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    numbered = shelve(sort.mapInArrow(number, f"{kept}, part int, at long"))
    counts = numbered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("here"))
    whole = Window.partitionBy("tree")  # of a number for each partition
    ahead = F.sum("here").over(whole.orderBy("part")) - F.col("here")
    offsets = counts.select("tree", "part", ahead.alias("ahead"), F.sum("here").over(whole).alias("n"))
    placed = numbered.join(offsets, ["tree", "part"])
    return placed.select(*(f.name for f in fields), (F.col("ahead") + F.col("at")).alias("pos"), "n")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
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


def _by_chunk(rows: DataFrame, go: Callable, schema: str) -> DataFrame:
    """``go`` over the groups of ``rows`` (tree, chunk, pos, ...), each sorted by pos."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, -(-rows.count() // SORTED))
    dealt = rows.repartition(parts, "tree", "chunk").sortWithinPartitions("tree", "chunk", "pos")
    return dealt.mapInArrow(go, schema)


def _table(rows: list[tuple], names: Sequence[str], kinds: Sequence[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))


def _next_stage(nodes: DataFrame) -> DataFrame:
    """(tree, pos, n, node): the roots of the chunks of ``nodes`` (tree, pos, n, node)."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (tree, chunk), group in _groups(batches, 2):
            n = group[0][1]
            levels = min(LEVELS, height(n))
            out.append((tree, chunk, -(-n // FAN**levels), Subtree([g[2] for g in group], levels).root))
            if len(out) >= 10_000:
                yield _table(out, ("tree", "pos", "n", "node"), (pa.string(), pa.int64(), pa.int64(), pa.string()))
                out = []
        yield _table(out, ("tree", "pos", "n", "node"), (pa.string(), pa.int64(), pa.int64(), pa.string()))

    chunks = nodes.select("tree", F.expr(f"pos div {CHUNK}").alias("chunk"), "pos", "n", "node")
    return shelve(_by_chunk(chunks, go, "tree string, pos long, n long, node string"))


def _stages(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and the stages above them; in the last one each tree has its root alone."""
    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        out.append(_next_stage(out[-1]))
    return out


def _with_above(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Chunks of ``nodes`` with the path above each as its first row."""
    nothing = lambda kind: F.lit(None).cast(kind)
    kept = [c for c in nodes.columns if c not in ("tree", "pos")]
    kinds = dict(nodes.dtypes)
    below = nodes.select("tree", F.expr(f"pos div {CHUNK}").alias("chunk"), "pos", *kept,
                         nothing("array<string>").alias("lefts"), nothing("array<string>").alias("rights"), nothing("string").alias("subroot"))
    heads = above.select("tree", F.col("pos").alias("chunk"), F.lit(-1).cast("long").alias("pos"),
                         *(nothing(kinds[c]).alias(c) for c in kept), "lefts", "rights", "subroot")
    return below.unionByName(heads)


def _paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, pos, lefts, rights, subroot): the siblings above each node of a stage, its own level first."""
    names = ("tree", "pos", "lefts", "rights", "subroot")
    kinds = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string())

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, _), (head, *group) in _groups(batches, 2):
            lefts, rights, subroot = head[3:]
            tree_of = Subtree([g[2] for g in group], min(LEVELS, height(group[0][1])))
            out = []
            for i, row in enumerate(group):
                own = tree_of.siblings(i)
                out.append((tree, row[0], [a for a, _ in own] + lefts, [b for _, b in own] + rights, subroot))
                if len(out) >= 256:
                    yield _table(out, names, kinds)
                    out = []
            yield _table(out, names, kinds)

    rows = _with_above(nodes.select("tree", "pos", "n", "node"), above)
    return shelve(_by_chunk(rows, go, f"tree string, pos long, {_ABOVE}"))


def manifest(leaves: DataFrame) -> tuple[list[DataFrame], list[DataFrame], str | None]:
    """Stages of the groups' trees, stages of the top tree, and the root, of ``leaves`` (grp, id, leaf, ...).

    A stage is (tree, pos, n, node); further columns of ``leaves`` stay in the first. A group's tree is named by an equals
    sign and the group's name, the null group's by a dash, which is sorted before them.
    """
    ship(leaves.sparkSession)
    tree = F.coalesce(F.concat(F.lit("="), F.col("grp").cast("string")), F.lit("-"))
    rows = leaves.withColumn("tree", tree).drop("grp").withColumnRenamed("leaf", "node")
    groups = _stages(shelve(_ranked(rows, ("id", "node"))))
    roots = groups[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    top = _stages(shelve(_ranked(roots, ("name",))))
    last = top[-1].select("node").first()
    return groups, top, last[0] if last else None


_FOLDED = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def folded(leaves: DataFrame) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of each leaf (grp, id, leaf, changed).

    ``proof_sha256`` is the digest of its siblings from its own level up to the root; ``folded_root`` is the root that
    follows if the leaf is ``changed`` (null: as it is), by the states before its and its ancestors' slots.
    """
    groups, top, root = manifest(leaves)
    spark = leaves.sparkSession
    above = spark.createDataFrame([("", 0, [], [], None)], f"tree string, pos long, {_ABOVE}")
    for stage in reversed(top[:-1]):
        above = _paths(stage, above)
    # what stands above a root of the top tree's first stage stands above that group's whole tree
    paths = above.join(top[0].select("pos", "name", "node"), "pos")
    above = shelve(paths.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "lefts", "rights", F.col("node").alias("subroot")))
    for stage in reversed(groups[1:-1]):
        above = _paths(stage, above)
    names = [c.split()[0] for c in _FOLDED.split(", ")]
    kinds = (pa.int64(), *[pa.string()] * 5, pa.bool_())

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (head, *group) in _groups(batches, 2):
            lefts, rights, subroot = head[4:]
            over = "".join(a + b for a, b in zip(lefts, rights, strict=True)).encode()
            states = [(hashlib.sha256(a.encode()), b.encode()) for a, b in zip(lefts, rights, strict=True)]
            own, out = Subtree([g[2] for g in group], min(LEVELS, height(group[0][1]))), []
            for i, row in enumerate(group):
                node, packed = row[2:4]
                proof = hashlib.sha256("".join(a + b for a, b in own.siblings(i)).encode() + over)
                new = own.fold(i, packed["changed"] or node)
                for before, right in states:
                    state = before.copy()
                    state.update(new.encode())
                    state.update(right)
                    new = state.hexdigest()
                out.append((packed["id"], node, subroot, root, proof.hexdigest(), new, new == root))
            yield _table(out, names, kinds)

    packed = F.struct(F.col("id").cast("long").alias("id"), "changed").alias("packed")
    rows = _with_above(groups[0].select("tree", "pos", "n", "node", packed), above)
    return _by_chunk(rows, go, _FOLDED)


def document_leaves(docs: DataFrame) -> DataFrame:
    """(grp, id, leaf, changed) of documents: every third id's text is lower-cased (A-Z) in ``changed``."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lower = [F.translate("text", UPPER, LOWER) if c == "text" else c for c in COLUMNS]
    return docs.select(
        F.col("lang").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("id"), leaf(COLUMNS).alias("leaf"),
        F.when(tampered, leaf(lower)).alias("changed"),
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folded(document_leaves(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


OP13_SQL = """
WITH RECURSIVE texts AS (
  SELECT doc_id, lang, [doc_id::VARCHAR, source, lang, n_chars::VARCHAR] AS head, text,
    list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(list_aggregate(list_transform(list_append(head, text), lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '')) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(list_aggregate(list_transform(
      list_append(head, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')),
      lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '')) END AS changed FROM texts
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), tree(lvl, lang, pos, n, node) AS (
  SELECT 0, lang, pos, n, leaf FROM placed
  UNION ALL
  SELECT lvl + 1, lang, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY lvl, lang, pos // 8, n
), subroots AS (
  SELECT lang, lvl AS high, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), top(lvl, pos, n, node) AS (
  SELECT 0, pos, n, subroot FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 8, n
), siblings AS (
  SELECT lvl, lang, pos, coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind
  FROM tree WHERE n > 1 WINDOW w AS (PARTITION BY lvl, lang, pos // 8 ORDER BY pos)
), over AS (
  SELECT lvl, pos, coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind
  FROM top WHERE n > 1 WINDOW w AS (PARTITION BY lvl, pos // 8 ORDER BY pos)
), steps AS (
  SELECT p.lang, p.pos, s.lvl, s.before, s.behind FROM placed p JOIN siblings s ON s.lang IS NOT DISTINCT FROM p.lang AND s.pos = p.pos >> (3 * s.lvl)
  UNION ALL
  SELECT p.lang, p.pos, r.high + o.lvl, o.before, o.behind FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
    JOIN over o ON o.pos = r.pos >> (3 * o.lvl)
), proofs AS (
  SELECT lang, pos, sha256(string_agg(before || behind, '' ORDER BY lvl)) AS proof, max(lvl) + 1 AS high FROM steps GROUP BY lang, pos
), folds(lang, pos, lvl, node) AS (
  SELECT lang, pos, 0, coalesce(changed, leaf) FROM placed
  UNION ALL
  SELECT f.lang, f.pos, f.lvl + 1, sha256(s.before || f.node || s.behind) FROM folds f
    JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.pos = f.pos AND s.lvl = f.lvl
)
SELECT p.doc_id, p.leaf, r.subroot, t.node AS root, coalesce(q.proof, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = t.node AS verified
FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang CROSS JOIN (SELECT node FROM top WHERE n = 1) t
LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.pos = p.pos
JOIN folds f ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos AND f.lvl = coalesce(q.high, 0)
"""
