import json
import random

import pytest
from envelopes import envelope
from pyspark.sql import functions as F

from rowtide.operators.envelope import cell, parse
from rowtide.sources.chunks import change_keys, chunk_of, chunk_width, chunked_snapshot, key_place
from rowtide.sources.feed import commit_order, union_feeds

FEED = "seq bigint, destination string, key string, value string"


def _last(spark, snapshot, feed, keys):
    both = commit_order(parse(union_feeds(snapshot, feed)))
    row = F.coalesce("after", "before")
    names = [F.try_variant_get(cell(row, c), "$", "string").alias(c) for c in (*keys, "v")]
    last = both.select("seq", "op", *names).groupBy(*keys).agg(F.max_by(F.struct("op", "v"), "seq").alias("x"))
    return {tuple(r[k] for k in keys): r.x.v for r in last.where("x.op <> 'd'").collect()}


@pytest.mark.parametrize("by_hash", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_interleaving_ends_in_the_last_state(spark, seed, by_hash):
    rng = random.Random(seed)
    width = 1 << 60 if by_hash else 7
    keys = ("tenant", "id") if by_hash else ("id",)
    state = {k: "old" for k in range(-20, 40)}
    as_row = lambda k: {"tenant": f"t{k % 3}", "id": k} if by_hash else {"id": k}
    number = {
        k: c for k, c in spark.createDataFrame([(f"t{k % 3}", k) for k in range(-30, 60)], "tenant string, id long")
        .select("id", chunk_of(key_place([F.col(c) for c in keys], by_hash), width)).collect()
    }
    lsn, log, read, chunks = 100, [], [], []

    def change():
        nonlocal lsn
        k, lsn = rng.randrange(-25, 45), lsn + rng.randrange(1, 4)
        old, new = state.get(k), None if rng.random() < 0.4 and k in state else f"v{lsn}"
        state.pop(k, None) if new is None else state.update({k: new})
        image = lambda v: None if v is None else {**as_row(k), "v": v}
        op = "d" if new is None else "c" if old is None else "u"
        key = rng.choice([json.dumps(as_row(k)), json.dumps({"schema": {}, "payload": as_row(k)}), None])
        log.append((lsn, "d", key, envelope(op, before=image(old) or ({**as_row(k), "v": "?"} if new is None else None), after=image(new), lsn=lsn)))

    for c in sorted(set(number.values()), key=lambda _: rng.random()):
        for _ in range(rng.randrange(4)):
            change()
        low = lsn
        for _ in range(rng.randrange(4)):
            change()
        read += [(*as_row(k).values(), v) for k, v in state.items() if number[k] == c]
        for _ in range(rng.randrange(4)):
            change()
        chunks.append((c, low, lsn))
    for _ in range(5):
        change()
    feed = spark.createDataFrame(log, FEED)
    columns = ("tenant string, " if by_hash else "") + "id bigint, v string"
    snapshot = chunked_snapshot(
        spark.createDataFrame(read, columns), parse(feed), spark.createDataFrame(chunks, "chunk bigint, low bigint, high bigint"),
        db="sales_db", schema="public", name="orders", primary_key=keys, width=width, by_hash=by_hash,
    )
    assert sorted(snapshot.collect()) == sorted(snapshot.collect())
    got = _last(spark, snapshot, feed, keys)
    assert got == {tuple(str(x) for x in as_row(k).values()): v for k, v in state.items()}


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (9, "b"), (None, "c")], "id bigint, v string")
    chunks = spark.createDataFrame([(0, 10, 20)], "chunk bigint, low bigint, high bigint")
    options = dict(db="d", schema="public", name="orders", primary_key=("id",), width=5)
    empty = spark.createDataFrame([], FEED)
    assert chunked_snapshot(rows, parse(empty), chunks, **options).count() == 2  # 9 is in a chunk that was not read
    assert chunked_snapshot(rows.limit(0), parse(empty), chunks, **options).count() == 0
    at = lambda lsn, table="orders": (1, "d", '{"id":1}', envelope("u", after={"id": 1, "v": "n"}, lsn=lsn, table=table))
    for lsn, left in ((10, 2), (11, 0), (20, 0), (21, 2), (None, 2)):
        parsed = parse(spark.createDataFrame([at(lsn), (2, "d", None, None), (3, "d", "x", "not json")], FEED))
        assert chunked_snapshot(rows, parsed, chunks, **options).count() == left
    other = parse(spark.createDataFrame([at(15, "widgets")], FEED))
    assert chunked_snapshot(rows, other, chunks, **options).count() == 2
    assert chunk_width(rows, ("id",), 2) == 6 and chunk_width(rows.limit(0), ("id",), 2) == 1
    assert [r.id for r in change_keys(parse(spark.createDataFrame([at(1)], FEED)), ("id",)).collect()] == ["1"]
