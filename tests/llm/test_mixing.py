import re

import duckdb
import pytest
from pyspark.sql import functions as F

from rowtide.llm import mixing


def by_rounds(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets as told: shares by weight, cut at the cap, the excess shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        for s in open_:
            target[s] += left * w[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


def docs(spark):
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), f"s{i % 5}", "x") for i in range(200)]
    rows += [(1000 + i, "a b\tc\n d", None, "x") for i in range(9)] + [(2000, None, "s1", "y"), (2001, "", "empty", "y")]
    rows += [(3000, "p q", "é", "x"), (3000, "p q", "é", "x"), (None, "r", "z", None), (4000, "word " * 30_000, "long", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_sizes(spark):
    texts = [None, "", " ", "a", " a", "a ", "\ta\x0b b\r\nc ", "é x  y", "a\x1cb", "\n\na"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", mixing.size_of(F.col("text")).alias("n"))
    for t, n in df.collect():
        assert n == len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), repr(t)


def test_targets_and_takings(spark):
    got = mixing.assign(docs(spark)).collect()
    assert len(got) == docs(spark).count()
    sizes, taken, target = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == sum(p.words for p in r.parts)
        assert all(0 <= p.position <= 1 for p in r.parts)
    expected = by_rounds(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s]) and abs(taken[s] - target[s]) <= 1
    again = mixing.assign(docs(spark).repartition(7)).collect()
    key = lambda r: (str(r.doc_id), str(r.text)[:50], r.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_positions_follow_the_schedule(spark):
    df = spark.range(4000).selectExpr("id doc_id", "'w w w' text", "concat('s', id % 3) source", "5L n_chars")
    mixed = mixing.mix(df)
    assert mixed.columns == ["doc_id", "text", "source", "n_chars", "position"]
    got = mixed.collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    early = lambda s: sum(r.source == s and r.position < 0.5 for r in got) / sum(r.source == s for r in got)
    # the integral of a ramp of 0.5 to the middle is 0.375, of -0.5 it is 0.625
    assert early("s0") == pytest.approx(0.375, abs=0.01) and early("s1") == pytest.approx(0.5, abs=0.01)
    assert early("s2") == pytest.approx(0.625, abs=0.01)
    words = sum(len(r.text.split()) for r in got)
    assert words == sum(r.taken for r in mixing.assign(df).collect())
    assert all(r.n_chars == len(r.text) for r in got)


def test_empty(spark):
    assert mixing.assign(docs(spark).limit(0)).count() == 0
    none = mixing.assign(docs(spark).where("text is null or text = ''")).collect()
    assert [(r["size"], r.taken) for r in none] == [(0, 0)] * 2


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    expected = {r[0]: r[1:] for r in con.execute(mixing.OP10_SQL).fetchall()}
    got = {r.doc_id: tuple(r)[1:] for r in mixing.op10_mixing(spark, sf).collect()}
    assert got == expected
