import zlib

import numpy as np

from rowtide.llm import quality


def test_isotonic():
    knots, values = quality.isotonic([0, 1, 2, 3], [0.0, 1.0, 0.0, 1.0], [1, 1, 3, 1])
    assert list(knots) == [0, 0, 1, 2, 3, 3] and list(values) == [0, 0, 0.25, 0.25, 1, 1]


def test_separates_held_out_rows(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    got = quality.op6_quality(spark, folder).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in held]) > 0.93
    # held-out labels must not matter: turn them round
    other = spark.read.parquet(f"{folder}/labels.parquet")
    turned = other.withColumn("quality", quality.F.when(quality.held_out(other.doc_id), 1 - other.quality).otherwise(other.quality))
    again = quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), turned).collect()
    score = {r.doc_id: r.score for r in got}
    assert all(abs(r.score - score[r.doc_id]) < 1e-6 for r in again)


def test_rows(spark):
    rng = np.random.default_rng(3)
    good = lambda: " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(rng.integers(5, 90)))
    rows = [(i, good() if i % 3 else "### $$$ %%% " * int(rng.integers(2, 30)), "k") for i in range(300)]
    rows += [(1000, None, "k"), (1001, "", None), (1001, "", None), (None, "a b", "k"), (1002, "w" * 300_000, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)] + [(4, None, 0), (4, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows)
    right = [r.predicted == (r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 300]
    assert np.mean(right) > 0.98
    kept = quality.accept(docs, labels)
    assert kept.columns == docs.columns
    assert kept.where("doc_id < 300").count() == sum(r.predicted for r in got if r.doc_id is not None and r.doc_id < 300)
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0
