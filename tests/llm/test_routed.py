import math

import numpy as np
import pytest

from rowtide.llm import routed

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50):
    """Exact answers over rows (vec_id, vector), as (query_id, vector) to [(score, vec_id)] nearest first, parallel vectors as ties."""
    good = {(i, tuple(float(np.float32(x)) for x in v)) for i, v in rows
            if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)}
    out = {}
    for i, v in good:
        if i % every == 0:
            a = np.array(v) / np.linalg.norm(v)
            found = [(float(a @ (np.array(w) / np.linalg.norm(w))), j) for j, w in good if j != i and len(w) == len(v)]
            out[i, v] = sorted(found, key=lambda f: (-round(f[0], 12), f[1]))[:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def recall(got, exact):
    """Share of the true neighbours found; what is found has the right score and order."""
    hits = total = 0
    for (i, _), best in exact.items():
        mine = got.get(i, [])
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(best)
        assert all(a[2] > b[2] - 1e-12 for a, b in zip(mine, mine[1:], strict=False))
        hits += sum(any(j == found for _, found, _ in mine) or any(abs(s - score) < 1e-12 for _, _, score in mine) for s, j in best)
        total += len(best)
    return hits / total


def clusters(n, seed, dim=16, centres=60):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, dim))
    return middle[rng.integers(0, centres, n)] + 0.35 * rng.standard_normal((n, dim))


def test_parts_are_balanced_and_keep_neighbours():
    x = clusters(1500, 1)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    graph = routed.neighbour_graph(unit, 10)
    assert (graph != np.arange(len(unit))[:, None]).all()
    part = routed.balanced_parts(graph, 6)
    sizes = np.bincount(part, minlength=6)
    assert sizes.max() - sizes.min() <= 3
    assert (part[graph] == part[:, None]).mean() > 0.8  # at random 1 in 6


def test_router_finds_the_parts_of_neighbours_it_was_not_fitted_on():
    x = clusters(4000, 2)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    router = routed.Router.fit(unit[:2000], 8, recall=0.95)
    again = routed.Router.unpacked(router.packed())
    rest = unit[2000:]
    home, seen = router.likely(rest).argmax(axis=1), again.visited(rest)
    near = routed.neighbour_graph(rest, 5)
    assert np.take_along_axis(seen, home[near], axis=1).mean() > 0.92
    assert 2 <= seen.sum(axis=1).mean() < 5


@pytest.mark.parametrize("load", [300, 2500])
def test_recall_over_several_levels(spark, monkeypatch, load):
    for name, value in {"LOAD": load, "PARTS": 4, "SAMPLE": 500, "SLICE": 200, "BLOCK": 7}.items():
        monkeypatch.setattr(routed, name, value)
    rows = [(i, v.tolist()) for i, v in enumerate(clusters(3000, 3))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    exact = brute(rows)
    got = answers(routed.nearest(df))
    assert len(got) == 60 and recall(got, exact) >= 0.9
    assert got == answers(routed.nearest(df.repartition(3)))  # reruns agree, scores to the last bit


def test_copies_and_odd_rows_are_searched_whole(spark, monkeypatch):
    monkeypatch.setattr(routed, "SLICE", 64)
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.standard_normal(6).round(2).tolist()) for i in rng.permutation(400)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 0.0, 0.0, 1.0]) for i in range(300)]  # a third are copies, queries among them
    rows += [(2000, None), (2050, []), (2100, [0.0] * 6), (2150, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2200, [float("nan")] * 6)]
    rows += [(2250, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (2300, [3e38] * 6), (2350, [1e-38] * 6), (-50, [2.0] * 6)]
    rows += [(2400, [1.0, 2.0]), (2401, [2.0, 1.0]), (2450, [5.0]), (3001, [1.0] * 6), (3001, [1.0] * 6), (3002, [-1.0] * 6)]
    exact = brute(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", key string, part int").repartition(6)
    got = answers(routed.nearest(df))
    assert set(got) == {i for (i, _), best in exact.items() if best} and 2450 not in got
    for (i, _), best in exact.items():
        if best:
            mine = got[i]
            assert [j for _, j, _ in mine] == [j for _, j in best]
            assert np.allclose([s for _, _, s in mine], [s for s, _ in best], atol=1e-12)
    assert routed.nearest(df.limit(0)).count() == 0


def test_vectors_that_cannot_be_cut(spark, monkeypatch):
    for name, value in {"LOAD": 100, "PARTS": 4, "SAMPLE": 300, "SLICE": 64}.items():
        monkeypatch.setattr(routed, name, value)
    rng = np.random.default_rng(5)
    rows = [(i, (np.ones(4) + 1e-6 * rng.standard_normal(4)).astype(np.float32).tolist()) for i in range(900)]
    got = answers(routed.nearest(spark.createDataFrame(rows, SCHEMA)))
    assert len(got) == 18 and all(len(v) == 5 for v in got.values())


def test_query_on_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = routed.op12_routed(spark, sf)
    assert [f"{n} {t}" for n, t in got.dtypes] == ["query_id bigint", "rank int", "vec_id bigint", "score double"]
    assert recall(answers(got), brute(rows)) >= 0.9
