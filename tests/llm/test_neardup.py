import duckdb
import numpy as np
import pytest

from rowtide.llm import neardup


def brute(rows, threshold=0.9):
    good = [v is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and any(v) for _, v in rows]
    n = len(rows)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                linked[i, j] = linked[j, i] = a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold
    component = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for i, j in zip(*np.nonzero(linked), strict=True):
            if component[j] < component[i]:
                component[i], changed = component[j], True
    return linked, [(rows[i][0], int(linked[i].sum()), component[i], component[i] == rows[i][0]) for i in range(n)]


def cases(dim=24):
    rng = np.random.default_rng(8)
    f = lambda x: [float(v) for v in np.float32(x)]
    rows = [f(rng.standard_normal(dim)) for _ in range(150)]
    for _ in range(12):
        base = rng.standard_normal(dim)
        for noise in rng.uniform(0.02, 0.4, rng.integers(2, 30)):
            rows.append(f(base + noise * rng.standard_normal(dim) * rng.integers(1, 3)))
    rows += [rows[160]] * 25 + [f(3 * np.array(rows[161]))]
    ids = rng.permutation(5000)[: len(rows)]
    rows = [(int(i), v) for i, v in zip(ids, rows, strict=True)]
    other = f(rng.standard_normal(7))
    rows += [(6000, None), (6001, [0.0] * dim), (6002, [float("nan")] * dim), (6003, [None] + [1.0] * (dim - 1)), (6004, [])]
    return rows + [(6005, other), (6006, other), (6007, [float("inf")] + [1.0] * (dim - 1)), (6008, [1e300] * dim), (6009, [1e-300] * dim)]


@pytest.mark.parametrize("bucket", [4096, 8])
def test_rows(spark, monkeypatch, bucket):
    monkeypatch.setattr(neardup, "BUCKET", bucket)
    monkeypatch.setattr(neardup, "RECALL", 0.999999)
    rows = cases()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, node int").repartition(3)
    got = sorted(map(tuple, neardup.near_duplicates(df).collect()))
    expected = sorted(r for r in brute([r for r in rows if r[0] < 6008])[1]) + [(6008, 1, 6008, True), (6009, 1, 6008, False)]
    assert got == expected
    assert neardup.near_duplicates(df.limit(0)).count() == 0
    bad = df.where("vec_id = 6000 or vec_id = 6001")
    assert sorted(map(tuple, neardup.near_duplicates(bad).collect())) == [(6000, 0, 6000, True), (6001, 0, 6001, True)]


def test_recall_near_the_threshold(spark):
    """Pairs just above the threshold among many vectors; the buckets are as full as the defaults make them."""
    rng = np.random.default_rng(9)
    dim, pairs = 64, 1500
    base = rng.standard_normal((pairs, dim))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = rng.standard_normal((pairs, dim))
    away -= (away * base).sum(1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = rng.uniform(0.9001, 0.92, (pairs, 1))
    near = cosine * base + np.sqrt(1 - cosine**2) * away
    rest = rng.standard_normal((5000, dim))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([base, near, rest]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neardup.near_duplicates(df).collect()
    assert sum(r.n_links for r in got) / (2 * pairs) >= 0.95
    assert all(r.component_id in (r.vec_id, r.vec_id - pairs) for r in got)


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert sorted(map(tuple, neardup.op3_neardup(spark, sf).collect())) == sorted(con.execute(neardup.OP3_SQL).fetchall())
