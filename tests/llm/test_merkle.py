import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rowtide.llm import merkle

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def text_of(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels_of(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        out.append(nodes)
    return out


def path(levels, at):
    for nodes in levels[:-1]:
        run = nodes[at - at % 8 : at - at % 8 + 8]
        yield run[: at % 8], run[at % 8 + 1 :]
        at //= 8


def brute(rows):
    """The contract over rows (doc_id, source, lang, n_chars, text), whole trees in memory."""
    lower = lambda t: None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    by_lang = {}
    for r in rows:
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        own = H(text_of(r))
        by_lang.setdefault(r[2], []).append((r[0], own, H(text_of((*r[:4], lower(r[4])))) if changed else own))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        by_lang[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[x] = levels_of([r[1] for r in by_lang[x]])
    top = levels_of([trees[x][-1][0] for x in langs])
    for at, x in enumerate(langs):
        for i, (doc_id, own, new) in enumerate(by_lang[x]):
            steps = [*path(trees[x], i), *path(top, at)]
            node = new
            for left, right in steps:
                node = H("".join(left) + node + "".join(right))
            root = top[-1][0]
            yield doc_id, own, trees[x][-1][0], root, H("".join("".join(a + b) for a, b in steps)), node, node == root


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 100, 513])
def test_subtree(n):
    nodes = [H(str(i)) for i in range(n)]
    levels = levels_of(nodes)
    tree = merkle.Subtree(nodes, merkle.height(n))
    assert tree.levels == levels and merkle.height(n) == len(levels) - 1
    for i in {0, n // 2, n - 1}:
        steps = list(path(levels, i))
        assert tree.siblings(i) == [("".join(a), "".join(b)) for a, b in steps]
        node = H("new")
        for a, b in steps:
            node = H("".join(a) + node + "".join(b))
        assert tree.fold(i, H("new")) == node and tree.fold(i, nodes[i]) == tree.root


def fixture():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcABC é😀") for _ in range(rng.choice([0, 1, 5, 40])))
    rows = [(i, rng.choice(["s1", "s2", None]), rng.choice(["en", "en", "en", "de", "fr", None]), rng.choice([None, i]), word())
            for i in rng.sample(range(-300, 5000), 700)]
    rows += [(i, "s", f"x{i}", 1, "Alone") for i in range(9000, 9030)]  # many trees of one leaf
    rows += [(None, None, None, None, None), (None, "s", "en", 3, "No id"), (None, "s", "en", 3, "No id"), (None, "t", "en", 3, "No id")]
    rows += [(77, "s", "en", 1, "A"), (77, "s", "en", 1, "A"), (77, "s", "en", 1, "B"), (78, "", "", 0, "")]
    return rows + [(9999, "s", "en", 300_000, "Long é" * 50_000)]


def told(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, merkle.LEVELS])
def test_rows(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)  # small chunks: several stages
    monkeypatch.setattr(merkle, "CHUNK", 8**levels)
    rows = fixture()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", pos long, tree string").repartition(7)
    got = told(merkle.folded(merkle.document_leaves(df)))
    assert got == sorted(brute(rows), key=repr)
    assert len({r[3] for r in got}) == 1 and {r[6] for r in got} == {True, False}


def test_equal_rows_and_small_tables(spark):
    one = [(1, "s", "en", 2, "Ab")]
    for rows in (one, one * 20, [(i, None, None, None, None) for i in range(9)], [(1, "s", "en", 2, "x"), (1, "s", "de", 2, "x")]):
        assert told(merkle.folded(merkle.document_leaves(spark.createDataFrame(rows, SCHEMA)))) == sorted(brute(rows), key=repr)
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.folded(merkle.document_leaves(empty)).count() == 0


def test_manifest_tells_whether_tables_are_equal(spark):
    rows = [r for r in fixture() if r[0] is not None]
    root = lambda rs: merkle.manifest(merkle.document_leaves(spark.createDataFrame(rs, SCHEMA)))[2]
    changed = [(*rows[0][:4], (rows[0][4] or "") + "!"), *rows[1:]]
    assert root(rows) == root(rows[::-1]) and len({root(rows), root(changed), root(rows[1:])}) == 3


def test_query_on_the_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = merkle.op13_merkle(spark, sf)
    assert told(got) == sorted(brute(list(map(tuple, rows))), key=repr)
    assert got.where(F.col("verified")).count() > 0
