import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from rowtide.llm import substrings


def brute(rows, window=20):
    """By the contract; rows with one id but different texts are ordered by the same hash as the operator's."""
    docs = sorted({(substrings.NO_ID if d is None else d, substrings._twin(t or ""), t or "") for d, t in rows})
    first = {}
    places = defaultdict(list)
    for at, (_, _, text) in enumerate(docs):
        words = text.encode().split()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first.setdefault(key, (at, i))
            if first[key] != (at, i):
                places[at].append(i)
    result = {}
    for at, (doc, _, text) in enumerate(docs):
        words = text.encode().split()
        covered = {j for i in places[at] for j in range(i, i + window)}
        kept = b" ".join(w for j, w in enumerate(words) if j not in covered)
        result[doc, text] = (len(words), len(covered), hashlib.sha256(kept).hexdigest())
    return [(d, *result[substrings.NO_ID if d is None else d, t or ""]) for d, t in rows]


def cases():
    rng = random.Random(6)
    word = lambda n=500: f"w{rng.randrange(n)}"
    passages = [[word() for _ in range(rng.randint(18, 70))] for _ in range(12)]
    rows = []
    for i in rng.sample(range(1000), 250):
        words = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            words += p[: rng.randint(10, len(p))] if rng.random() < 0.3 else p
            words += [word(10**6) for _ in range(rng.randint(0, 15))]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(2000 + i, rows[i % 3][1]) for i in range(40)]  # copies
    rows += [(3000, "a " * 200), (3001, "a b " * 60), (3002, "a " * 19), (3003, "a " * 20), (3004, None), (3005, ""), (3006, " é" * 50)]
    rows += [(None, rows[1][1]), (None, " ".join(passages[0] + passages[1]))]
    rows += [(7000, " ".join(passages[2])), (7000, " ".join(passages[2])), (7000, " ".join(passages[3] + passages[2]))]
    return rows


order = lambda r: (str(r[0]), *map(str, r[1:]))


@pytest.mark.parametrize("chunk", [300, 10**6])
def test_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    rows = cases()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, starts int").repartition(5)
    got = substrings.remove_repeats(df).drop("kept").collect()
    assert sorted(map(tuple, got), key=order) == sorted(brute(rows), key=order)
    assert sum(r.n_removed > 0 for r in got) > 100


def test_empty_and_short(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b")], "doc_id long, text string")
    assert substrings.remove_repeats(df.limit(0)).count() == 0
    assert {r.n_removed for r in substrings.remove_repeats(df).collect()} == {0}
    assert sorted(r.n_removed for r in substrings.remove_repeats(df, window=2).collect()) == [0, 2]


def test_doubling_until_none_survives(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in rng.integers(0, 10**6, 400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:95] + ["x"])), (3, "y " + " ".join(words[10:40])), (4, "z z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.longest for r in substrings.remove_repeats(df, longest=True).collect()}
    assert got == {1: 80, 2: 80, 3: 20, 4: 0}


def test_smallest_places():
    rng = np.random.default_rng(1)
    for n in (0, 3, 11, 60):
        h = rng.integers(0, 9, n).astype(np.uint64)
        assert list(substrings.smallest_places(h, 11)) == [i + int(np.argmin(h[i : i + 11])) for i in range(max(0, n - 10))]


def test_query_on_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, substrings.op5_substrings(spark, sf).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(brute(rows)) == sorted(con.execute(substrings.OP5_SQL).fetchall())
