import random

import duckdb
import numpy as np
import pytest

from rowtide.llm import jaccard


def brute(rows, percent=85, n=4):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    key = lambda d: (d is not None, d)
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d, key=key)
    return [(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)]


def cases(seed, groups=14, most=25):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(60)]
    ids = rng.sample(range(10_000), 4000)
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([5, 8, 12, 20, 40, 80, 200, 500]))]
        if rng.random() < 0.4:
            base = passage + base
        for _ in range(rng.randint(1, most)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // rng.choice([8, 15, 30, 60])))):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [word()] * rng.randint(0, 2)
            rows.append((ids.pop(), " ".join(copy).upper() if rng.random() < 0.2 else "\n".join(copy)))
    rows += [(ids.pop(), rows[0][1]) for _ in range(30)]
    rows += [(ids.pop(), t) for t in (None, None, "", " ", "a b", "A  b", "a b c", "é É", "É é", "b a")]
    rows += [(ids.pop(), "x " * k) for k in (3, 50, 5000)]
    return rows


order = lambda r: tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("region,chunk", [(4096, 10**6), (12, 500)])
def test_rows(spark, monkeypatch, region, chunk):
    monkeypatch.setattr(jaccard, "REGION", region)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    monkeypatch.setattr(jaccard, "PIVOTS", 4)
    rows = cases(1)
    rows += [(None, "q r s t u v w x y z"), (None, rows[5][1])]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, node string").repartition(3)
    got = sorted(map(tuple, jaccard.linked(df).collect()), key=order)
    assert got == sorted(brute(rows), key=order)


def test_regions_of_one_passage_fall_apart(spark, monkeypatch):
    """Many documents with a passage in common and the rest to themselves, and a few linked ones among them."""
    monkeypatch.setattr(jaccard, "REGION", 20)
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = " ".join(word() for _ in range(80))
    rows = [(i, f"{passage} {' '.join(word() for _ in range(30))}") for i in range(150)]
    rows += [(500 + i, rows[i][1] + " more words") for i in range(5)] + [(600 + i, f"{passage} {word()}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, jaccard.linked(df).collect()), key=order) == sorted(brute(rows), key=order)


def test_signatures_meet_for_every_linked_pair():
    rng = np.random.default_rng(4)
    for _ in range(3000):
        n = int(rng.choice([4, 5, 6, 7, 9, 14, 30, 90, 300, 1500]))
        a = rng.integers(0, 2**64, n, np.uint64)
        most = int(n * 0.15)
        gone = int(rng.integers(0, most + 1))
        b = np.concatenate([a[gone:], rng.integers(0, 2**64, int(rng.integers(0, most - gone + 1)), np.uint64)])
        a, b = np.unique(a), np.unique(b)
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common) and len(a) != common:
            assert len(np.intersect1d(jaccard.signatures(a), jaccard.signatures(b)))


def test_empty_and_other_thresholds(spark):
    df = spark.createDataFrame(cases(3, groups=4), "doc_id long, text string")
    assert jaccard.linked(df.limit(0)).count() == 0
    rows = [tuple(r) for r in df.collect()]
    got = sorted(map(tuple, jaccard.linked(df, percent=60, n=2).collect()), key=order)
    assert got == sorted(brute(rows, 60, 2), key=order)


def test_first_of_each(spark):
    rows = [(3, "a b c d e"), (1, "A b c d e"), (2, "other"), (None, "a b c d e"), (5, None), (2, "other")]
    df = spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, component_id string")
    got = jaccard.first_of_each(df.where("doc_id is not null"))
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 2, 5] and got.columns == df.columns


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = sorted(map(tuple, jaccard.op1_jaccard(spark, sf).collect()))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got == sorted(brute(rows)) == sorted(con.execute(jaccard.OP1_SQL).fetchall())


@pytest.mark.parametrize("region", [12, 16_384])
def test_repeated_and_null_ids_lose_no_link_in_large_regions(spark, monkeypatch, region):
    """Several texts with one id, rows without id, and whole rows repeated, in regions that are cut."""
    monkeypatch.setattr(jaccard, "REGION", region)
    monkeypatch.setattr(jaccard, "PIVOTS", 4)
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = " ".join(word() for _ in range(70))
    rows = [(3, f"{passage} {' '.join(word() for _ in range(25 + 10 * i))}") for i in range(4)]
    rows += [(None, f"{passage} {' '.join(word() for _ in range(30))}") for _ in range(20)]
    rows += [(100 + i, f"{passage} {' '.join(word() for _ in range(30))}") for i in range(30)]
    rows += [(500 + i, rows[i][1] + " more words") for i in range(12)]
    rows += rng.sample(rows, 20) + [rows[6]] * 15
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, jaccard.linked(df).collect()), key=order) == sorted(brute(rows), key=order)


@pytest.mark.parametrize("percent", [40, 50, 60, 85])
def test_signatures_meet_at_every_legal_size(percent):
    rng = np.random.default_rng(percent)
    for _ in range(1200):
        n = int(rng.choice([4, 5, 7, 10, 20, 61, 200, 700]))
        b = np.unique(rng.integers(0, 2**64, int(rng.integers(n, n * 100 // percent + 1)), np.uint64))
        a = np.sort(rng.choice(b, min(n, len(b)), replace=False))  # a subset, as small as it may be
        if 100 * len(a) >= percent * len(b) and len(a) < len(b):
            assert len(np.intersect1d(jaccard.signatures(a, percent), jaccard.signatures(b, percent)))


def test_links_are_told_where_sets_first_meet():
    """Connectivity over all reducers is that of equal keys, and close sets are told a few times, whatever the reducers."""
    rng = np.random.default_rng(7)
    owners, keys = [], []
    for group in range(40):
        base = rng.integers(0, 2**64, 60, np.uint64)
        for i in range(8):
            own = np.concatenate([base[rng.random(60) < 0.9], rng.integers(0, 2**64, 6, np.uint64)])
            keys.append(own)
            owners.append(np.full(len(own), 100 * group + i))
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order_ = np.argsort(keys, kind="stable")
    keys, owners = keys[order_], owners[order_]
    names, firsts = jaccard._firsts(keys, owners)
    firsts, told = firsts[np.searchsorted(names, owners)], {}
    for reducers in (4, 256):
        part, links = (keys >> np.uint64(32)) % np.uint64(reducers), []
        for p in range(reducers):
            here = part == p
            links += list(zip(*jaccard._told(keys[here], owners[here], firsts[here]), strict=True))
        root = {int(d): int(d) for d in names}
        for a, b in links * 8:  # enough rounds for groups of eight
            root[int(a)] = root[int(b)] = min(root[int(a)], root[int(b)])
        assert all(root[d] == d // 100 * 100 for d in root)
        told[reducers] = len(links)
    assert told[256] <= 5 * len(names)


def test_first_of_each_with_null_and_repeated_ids(spark):
    a, b, c = "a b c d e", "one two three four five", "six seven eight nine ten"
    rows = [(None, a), (None, a), (7, a), (8, a), (7, a), (None, b), (None, b), (None, b), (3, c), (3, a), (4, c), (None, None), (None, ""), (9, None)]
    df = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, _group int")
    got = jaccard.first_of_each(df)
    assert got.columns == df.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    assert kept == sorted([(3, a), (None, b), (3, c), (None, None), (None, ""), (9, None)], key=repr)


def test_only_texts_of_regions_are_moved(spark, monkeypatch):
    """Texts without a partner in their block are left out before the join that sends texts to their regions."""
    alone = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(2000)]
    base = [f"b{j}" for j in range(100)]
    near = [(5000 + i, " ".join([*base[:50], f"n{i}", *base[50:]])) for i in range(20)]
    rows = [*alone, *near, (None, " ".join([*base, "z"])), (None, None), (6000, None)]
    moved, packed = [], jaccard._packed

    def seen(docs):
        moved.extend(r.doc_id for r in docs.collect())
        return packed(docs)

    monkeypatch.setattr(jaccard, "_packed", seen)
    got = jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    assert sorted(len(g) for g in groups.values() if len(g) > 1) == [21]
    assert len(moved) < 600 and {None, *range(5000, 5020)} <= set(moved)


def test_places_of_sets_take_two_bytes():
    places = np.repeat(np.arange(300), 3)[np.random.default_rng(0).permutation(900)]
    some, index = jaccard._told_once(places)
    assert len(index) == 2 * 900 and (some[np.frombuffer(index, np.uint16)] == places).all()
    places = np.array([3, 1, 2, 1, 5, 4])  # one in six is there again: still less than without
    some, index = jaccard._told_once(places)
    assert (some[np.frombuffer(index, np.uint16)] == places).all()
    places = np.arange(50)
    some, index = jaccard._told_once(places)
    assert index is None and (some == places).all()
    places = np.repeat(np.arange(70_000), 2)
    some, index = jaccard._told_once(places)
    assert (some[np.frombuffer(index, np.int32)] == places).all()


@pytest.mark.parametrize("percent", [80, 85])
def test_no_more_signatures_than_differences_of_the_largest_partner(percent):
    """A set has no signatures that no partner of its size can call for; how few are enough is held by the tests above."""
    rng = np.random.default_rng(2)
    sizes = range(300, 900, 7)
    sent = sum(len(jaccard.signatures(np.sort(rng.integers(0, 2**64, n, np.uint64)), percent)) for n in sizes)
    assert sent < 1.75 * sum(sizes) * 2 * (100 - percent) / (100 + percent)  # 1.9 and 2.0 with those of the class's largest


def test_batches_are_short_inside_only(spark):
    from rowtide.llm import common

    before = spark.conf.get(common._BATCH)
    seen, real = [], jaccard._prints
    try:
        jaccard._prints = lambda docs, n: seen.append(spark.conf.get(common._BATCH)) or real(docs, n)
        jaccard.linked(spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")).collect()
    finally:
        jaccard._prints = real
    assert [int(x) <= common.BATCH_ROWS for x in seen] == [True] and spark.conf.get(common._BATCH) == before
