import hashlib
import random

import pytest
from envelopes import COLUMNS, envelope, feed

from rowtide.operators.envelope import parse, schema_snapshots
from rowtide.operators.schema_change import fold, latest_snapshots, schema_changes

SNAPSHOT = "seq bigint, table_schema string, table_name string, column_fingerprint string, column_names array<string>"


def _snapshots(spark, rows):
    data = [(seq, "s", t, hashlib.sha256(v.encode()).hexdigest(), v.rstrip("!").split(",")) for seq, t, v in rows]
    return spark.createDataFrame(data, SNAPSHOT)


def _loop(rows):
    """The same, one record at a time."""
    last, out = {}, []
    for seq, t, v in sorted(rows):
        if t in last and last[t] != v:
            now, was = set(v.rstrip("!").split(",")), set(last[t].rstrip("!").split(","))
            out.append((seq, f"s.{t}", sorted(now - was), sorted(was - now)))
        last[t] = v
    return sorted(out)


def _found(df):
    return sorted((r.seq, r.table, r.added_columns, r.removed_columns) for r in df.collect())


@pytest.mark.parametrize(
    "versions, want",
    [
        (["id"], []),
        (["id", "id", "id"], []),
        (["id,total", "id,total,status,customer_id"], [(1, ["customer_id", "status"], [])]),
        (["id,total", "id"], [(1, [], ["total"])]),
        (["a,b", "a,c"], [(1, ["c"], ["b"])]),
        (["a", "a!"], [(1, [], [])]),
        (["a", "b", "a"], [(1, ["b"], ["a"]), (2, ["a"], ["b"])]),
    ],
)
def test_transitions(spark, versions, want):
    got = _found(schema_changes(_snapshots(spark, [(i, "t", v) for i, v in enumerate(versions)])))
    assert [(s, a, r) for s, _, a, r in got] == want


@pytest.mark.parametrize("stretches", [(), (1,), (3, 20), (7, 8), (1000,)])
def test_any_cut_gives_what_a_loop_gives(spark, stretches):
    rnd = random.Random(11)
    rows, seq = [], 0
    for _ in range(600):
        seq += rnd.choice([1, 1, 1, 2, 25])
        # One table has most of the records; some versions last, some flap.
        table = rnd.choice(["hot"] * 8 + ["a", "b"])
        version = rnd.choice(["id,x", "id,x!", "id,y"]) if rnd.random() < 0.3 else "id"
        rows.append((seq, table, version))
    assert _found(schema_changes(_snapshots(spark, rows), stretches)) == _loop(rows)


def test_ties_and_state_rows(spark):
    """Rows with one seq go by fingerprint; a state row stands before all others, whatever its seq."""
    h = lambda v: hashlib.sha256(v.encode()).hexdigest()
    rows = [(5, "t", "a", False), (5, "t", "b", False), (9, "t", "a", False), (9, "t", "c", True), (0, "u", "a", False), (7, "u", "a", True)]
    data = [(seq, "s", t, h(v), [v], state) for seq, t, v, state in rows]
    df = spark.createDataFrame(data, SNAPSHOT + ", is_state boolean")
    first, second = sorted("ab", key=h)
    moves = ["c", first, second, *(["a"] if second == "b" else [])]
    seqs = [None, 5, 5, 9]
    want = sorted((seqs[i], "s.t", [moves[i]], [moves[i - 1]]) for i in range(1, len(moves)))
    for stretches in ((), (3,), (1, 4), (1000, 5000)):
        assert _found(schema_changes(df, stretches)) == want
    got = {r.table_name: r.column_names for r in latest_snapshots(df).collect()}
    assert got == {"t": ["a"], "u": ["a"]}


def test_one_schema_per_stretch_is_folded_in_the_tasks(spark):
    """Of a feed whose stretches have one schema each, a task sends one row for each stretch."""
    rows = spark.range(0, 40_000, 1, 4).selectExpr(
        "id seq", "'s' table_schema", "'t' table_name", "if(id < 20000, 'f', 'g') column_fingerprint", "array('a') column_names"
    )
    folded = fold(rows, 10_000)
    assert folded.count() == 4
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "partial_min" in plan.split("Exchange")[1] and "Sort" not in plan
    assert schema_changes(rows, (10_000, 100_000)).count() == 1


def test_reads_and_rejected_records_advance_the_detector(spark):
    more = [*COLUMNS, ("country", "string", None, True)]
    values = [
        envelope("r", snapshot="true"),
        envelope("t", after=None, columns=more),
        envelope("c", columns=more),
        envelope("c", has_after_schema=False),
        "junk",
        envelope("c", table="unknown"),
        envelope("c", table="unknown", columns=more),
    ]
    got = _found(schema_changes(schema_snapshots(parse(feed(spark, values)))))
    assert got == [(1, "public.orders", ["country"], []), (6, "public.unknown", ["country"], [])]


def test_change_record(spark):
    df = schema_changes(_snapshots(spark, [(0, "t", "a"), (1, "t", "b")]))
    assert df.columns == [
        "seq", "event", "table", "previous_fingerprint", "current_fingerprint", "added_columns", "removed_columns",
    ]
    row = df.first()
    assert row.event == "source_schema_change"
    assert (row.previous_fingerprint, row.current_fingerprint) == tuple(
        hashlib.sha256(v).hexdigest() for v in (b"a", b"b")
    )


def test_latest(spark):
    rows = [(3, "t", "a"), (9, "t", "b"), (5, "u", "c"), (7, "t", "a")]
    got = {r.table_name: (r.seq, r.column_names) for r in latest_snapshots(_snapshots(spark, rows)).collect()}
    assert got == {"t": (9, ["b"]), "u": (5, ["c"])}


def test_hot_table_is_cut_before_it_is_sorted(spark):
    plan = schema_changes(_snapshots(spark, [(0, "t", "a")]))._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert first.count(",") >= 3, first
