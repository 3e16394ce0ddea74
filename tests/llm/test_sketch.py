import hashlib
import random

import numpy as np

from rowtide.llm import sketch


def of(text):
    return sketch.kept(sketch.shingles(sketch.points(text)))


def test_estimates_containment_of_unequal_texts():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    long = " ".join(word() for _ in range(5000))
    assert abs(sketch.likeness(of(long[3000:6000]), of(long)) - 1) < 0.02
    half = long[3000:6000] + " ".join(word() for _ in range(430))
    true = lambda a, b: len(a & b) / min(len(a), len(b))
    grams = lambda t: {t[i : i + 8] for i in range(len(t) - 7)}
    for a, b in [(half, long), (long[:9000], long[2000:12000]), (long[:5000], half)]:
        assert abs(sketch.likeness(of(a), of(b)) - true(grams(a), grams(b))) < 0.12
    assert sketch.likeness(of(long[:1000]), of(long[20000:])) < 0.05


def test_merging_and_forms():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 40, 400, 4000):
        a, b = (rng.integers(0, 2**32, n, np.uint32) for _ in range(2))
        whole = sketch.kept(np.concatenate([a, b]))
        assert np.array_equal(sketch.merged(sketch.kept(a), sketch.kept(b)), whole)
        assert np.array_equal(sketch.read(sketch.written(whole)), whole)
    assert sketch.likeness(of(""), of("")) == 1.0 and sketch.likeness(of(""), of("a")) == 0.0
    assert sketch.likeness(of("abc"), of("abc")) == 1.0 and sketch.likeness(of("abc"), of("abd")) == 0.0


def brute(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        n = len(text)
        edited = text[: n - n // 4] + after[: n // 4] if n // 4 else text
        a, b = of(text), of(edited)
        yield (
            doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), sketch.written(a), sketch.written(b),
            sketch.likeness(a, b), sketch.likeness(a, of(after)),
        )


def test_rows(spark):
    rng = random.Random(4)
    text = lambda: "".join(rng.choice("ab é😀\n") for _ in range(rng.choice([0, 1, 3, 4, 9, 33, 200])))
    rows = [(i, text()) for i in rng.sample(range(10_000), 300)]
    rows += [(20_000, None), (20_001, ""), (20_002, "x" * 150_000), (None, "null id"), (None, "another")]
    rows += [(7, "seven"), (7, "seven"), (8, "eight"), (8, "eight again")]
    order = lambda r: tuple((x is not None, x or 0) for x in r[:1]) + tuple(map(str, r[1:]))
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, slice string").repartition(5)
    assert sorted(map(tuple, sketch.fingerprints(df).collect()), key=order) == sorted(brute(rows), key=order)
    assert sketch.fingerprints(df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "only row here")], "doc_id long, text string")
    assert [r.near_next for r in sketch.fingerprints(one).collect()] == [1.0]


def test_query_on_the_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, sketch.op4_sketch(spark, sf).collect())) == sorted(brute(map(tuple, rows)))
