import random

import pytest
from envelopes import envelope, feed

from rowtide.operators.envelope import parse
from rowtide.operators.transactions import transactions

COLUMNS = "seq bigint, db string, table_schema string, table_name string, op string, lsn_num bigint, txid bigint, ts_ms bigint"


def _loop(rows, gap):
    """One record at a time, in the order of the log."""
    by_number, out = {}, []
    for r in rows:
        if r[6] is not None:
            by_number.setdefault((r[1], r[6]), []).append(r)
    for (db, txid), own in by_number.items():
        own.sort(key=lambda r: (r[5] is not None, r[5] or 0))
        islands = [[own[0]]]
        for before, r in zip(own, own[1:], strict=False):
            apart = (before[5] is None) != (r[5] is None) or (r[5] is not None and r[5] - before[5] > gap)
            islands.append([r]) if apart else islands[-1].append(r)
        for some in islands:
            at = [r[5] for r in some]
            changes = len(some) if at[0] is None else len({(r[2], r[3], r[4], r[5]) for r in some})
            tables = sorted({f"{r[2]}.{r[3]}" for r in some})
            ts, seq = [r[7] for r in some], [r[0] for r in some]
            out.append((db, txid, at[0], at[-1], min(ts), max(ts), tables, changes, len(some) - changes, min(seq), max(seq)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("gap, stretch", [(50, 10), (50, 1000), (0, 7), (10**6, 64), (10**12, 1 << 20)])
def test_any_stretch_gives_what_a_loop_gives(spark, gap, stretch):
    rng = random.Random(gap + stretch)
    rows = []
    for seq in range(900):
        txid = rng.choice([1, 1, 1, 2, 3, None])  # one has half of all changes
        lsn = rng.choice([rng.randrange(3000), rng.randrange(3000), 10**9 + rng.randrange(60), None])
        rows.append((seq, rng.choice(["a", "b"]), "s", rng.choice(["t", "u"]), rng.choice("cu"), lsn, txid, rng.randrange(100)))
    rows += rng.sample(rows, 200)  # delivered again
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert sorted((tuple(r) for r in transactions(df, gap, stretch).collect()), key=repr) == _loop(rows, gap)


def test_records(spark):
    values = [
        envelope("c", txId=5, lsn=10), envelope("u", txId=5, lsn=11, table="notes"), envelope("c", txId=5, lsn=10),
        envelope("r", txId=None, lsn=12), envelope("d", txId=6, lsn=12, ts_ms=7), "not json", envelope("c", txId=5, lsn=10**12),
    ]
    got = sorted(map(tuple, transactions(parse(feed(spark, values))).collect()))
    at = 1714400000000
    assert got == [
        ("sales_db", 5, 10, 11, at, at, ["public.notes", "public.orders"], 2, 1, 0, 2),
        ("sales_db", 5, 10**12, 10**12, at, at, ["public.orders"], 1, 0, 6, 6),
        ("sales_db", 6, 12, 12, 7, 7, ["public.orders"], 1, 0, 4, 4),
    ]
    assert transactions(parse(feed(spark, values[:0]))).count() == 0


def test_a_huge_transaction_is_folded_in_the_tasks(spark):
    rows = spark.range(0, 60_000, 1, 4).selectExpr(
        "id seq", "'d' db", "'s' table_schema", "'t' table_name", "'c' op", "id * 8 lsn_num", "9L txid", "id ts_ms"
    )
    df = transactions(rows, stretch=1 << 18)
    plan = df._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "partial_collect_set" in below and "_stretch" in below.splitlines()[0]
    (row,) = df.collect()
    assert (row.changes, row.replays, row.first_lsn, row.last_lsn) == (60_000, 0, 0, 8 * 59_999)


def test_stretches_are_moved_once_after_the_fold(spark):
    rows = spark.createDataFrame([(1, "d", "s", "t", "c", 5, 9, 1), (2, "d", "s", "u", "c", 6, 9, 1)], COLUMNS)
    plan = transactions(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
