import hashlib
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from rowtide.llm import infill

SCHEMA = "doc_id long, text string, n long, form int, output string"


def plain_cut(doc_id, text, seed=1):
    """The contract, told with slices."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, "<S>" + text[b:] + "<P>" + text[:a] + "<M>" + text[a:b]
    return doc_id, n, "psm", a, b - a, "<P>" + text[:a] + "<S>" + text[b:] + "<M>" + text[a:b]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 129, 5000])
def test_skip_list_reaches_every_rank(n):
    widths = np.random.default_rng(n).integers(1, 9, n)
    ends = [0, *np.cumsum(widths).tolist()]
    units = infill.SkipList(widths)
    assert units.units == n and [units.seek(r) for r in range(n + 1)] == ends
    ones = infill.SkipList(n)
    assert [ones.seek(r) for r in range(n + 1)] == list(range(n + 1))
    for wrong in (-1, n + 1):
        with pytest.raises(IndexError):
            units.seek(wrong)


def test_lanes_carry_the_widths_of_what_they_skip():
    units = infill.SkipList(np.random.default_rng(1).integers(1, 9, 200_000))
    sizes = [len(lane[0]) for lane in units.lanes]
    assert sizes[-1] == 1 and all(a > b for a, b in zip(sizes, sizes[1:], strict=False)) and len(sizes) < 20
    for lower, upper in zip(units.lanes, units.lanes[1:], strict=False):
        for w in (0, 1):
            assert np.add.reduceat(lower[w], upper[2]).tolist() == upper[w].tolist()


def test_units_by_pattern():
    words = regex.compile(r"\S+")
    assert infill.widths_of("ab  cd\n", words).tolist() == [2, 4, 1]
    assert infill.widths_of("  ", words).tolist() == [2] and infill.widths_of("", words).tolist() == []
    assert infill.widths_of("abc", regex.compile("x*")).tolist() == [3]
    assert infill.widths_of("añ😀", None) == 3


def rows():
    rng = random.Random(3)
    text = lambda: "".join(rng.choice("ab é😀<>PSM\n") for _ in range(rng.choice([1, 2, 9, 63, 64, 400])))
    out = [(i, text()) for i in range(400)]
    out += [(900, None), (901, ""), (902, "x<M>y"), (903, "é😀" * 100_000), (None, "no id"), (None, "no id"), (None, None)]
    out += [(7, "again"), (7, "again"), (905, "<P"), (906, "S><S"), (907, "<" * 70), (-5, "below zero"), (2**62, "far")]
    return out


def test_rows_and_way_back(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in data], SCHEMA).repartition(3)
    got = infill.infill(df).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: repr(r)
    told = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got]
    assert sorted(told, key=key) == sorted((plain_cut(*r) for r in data), key=key)
    assert sorted(((r.doc_id, r.back) for r in got), key=key) == sorted(((d, t or "") for d, t in data), key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.infill(df.limit(0)).count() == 0


def test_cuts_between_words(spark):
    text = "one two three  four five six seven eight nine ten"
    df = spark.createDataFrame([(i, text) for i in range(200)], "doc_id long, text string")
    got = infill.infill(df, unit=r"\S+", seed=4, cut=100, suffix_first=0)
    got = got.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert {r.n for r in got} == {10} and {r.form for r in got} == {"psm"} and {r.back for r in got} == {text}
    ends = {0} | {m.end() for m in regex.finditer(r"\S+", text)}
    assert {r.prefix_chars for r in got} | {r.prefix_chars + r.middle_chars for r in got} == ends
    assert {r.middle_units for r in got} == set(range(11))


def test_query_on_the_table(spark, sf):
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = sorted((*cut[:5], sha(cut[5]), sha(t or "")) for (d, t) in data for cut in [plain_cut(d, t)])
    assert sorted(map(tuple, infill.op11_infill(spark, sf).collect())) == expected
