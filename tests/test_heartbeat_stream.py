"""Heartbeats and schema changes of streams against the batch operators."""

import json
import random

import pytest
from envelopes import COLUMNS, envelope
from pyspark.sql import functions as F
from test_streaming import MORE, ORDERS, RETYPED, _files

from rowtide.operators.accounting import distinct_keys, flow_sketches, heartbeat_by_table, merged_sketches, read_sketches, reject_cube
from rowtide.operators.assemble import records
from rowtide.operators.envelope import parse, schema_snapshots
from rowtide.operators.schema_change import schema_changes
from rowtide.sources.feed import read_feed
from rowtide.streaming.heartbeat import heartbeat_stream, running_heartbeats
from rowtide.streaming.schema_change import change_stream

AT = 1714400000000


def _stream(spark, here):
    return read_feed(spark, str(here / "in"), format="json", streaming=True, max_per_trigger=1)


def _run(df, here, name):
    q = df.writeStream.format("parquet").option("path", str(here / name)).option("checkpointLocation", str(here / f"{name}-cp"))
    q.trigger(availableNow=True).start().awaitTermination()


def _dated():
    """Changes out of order, far behind, without a commit time, rejected, and one that closes all intervals."""
    rng = random.Random(6)
    row = {"id": 1, "customer_id": 1, "status": "s", "total": "1"}
    times = [AT + rng.randrange(0, 3600_000) + 600_000 * (i // 10) for i in range(60)]
    times += [AT - 86_400_000, AT + 5, None, AT + 1_000, None, AT - 86_400_000]
    out = [envelope(rng.choice("ccr"), after=row, ts_ms=t, lsn=i, table=rng.choice(["orders", "orders", "widgets"])) for i, t in enumerate(times)]
    return [*out, "not json", envelope("t", after=row, ts_ms=AT + 7_200_000), envelope("c", after=row, ts_ms=AT + 10 * 86_400_000)]


@pytest.mark.parametrize("per_file, delay", [(5, "5 minutes"), (23, "2 hours")])
def test_intervals_add_up_to_the_batch(spark, tmp_path, per_file, delay):
    values = _dated()
    _files(tmp_path / "in", values[:40], per_file)
    beats = lambda: heartbeat_stream(records(_stream(spark, tmp_path), [ORDERS]), "15 minutes", delay)
    _run(beats(), tmp_path, "beats")
    _files(tmp_path / "in", values[40:], per_file, first=40)  # a restart in between: open intervals are in the state
    _run(beats(), tmp_path, "beats")
    rows = spark.read.parquet(str(tmp_path / "beats"))

    recs = records(read_feed(spark, str(tmp_path / "in"), format="json"), [ORDERS])
    last = AT + 10 * 86_400_000  # the closing record's own interval is still open
    batch = heartbeat_by_table(recs, "15 minutes").where(F.unix_millis("window_end") < last)
    key = lambda r: (r.window_end, r.table, r.op, r.n)
    assert sorted(map(key, running_heartbeats(rows).collect())) == sorted(map(key, batch.collect()))
    assert rows.agg(F.sum("n"), F.sum("dropped")).first()[0] == recs.where("drop_reason is null").count() - 1
    assert rows.agg(F.sum("dropped")).first()[0] == recs.where("drop_reason is not null").count()
    on_time = rows.where("not late").groupBy("window_end", "table", "op").count()
    assert on_time.where("count > 1").isEmpty()
    if per_file == 5:
        late = rows.where("late").select(F.unix_millis("window_end").alias("ms"), "n").collect()
        assert late and {r.ms for r in late} >= {900_000}  # those without a commit time


def _layouts():
    rng = random.Random(2)
    out = []
    for i in range(120):
        columns = rng.choice([COLUMNS, COLUMNS, COLUMNS, MORE, RETYPED])
        row = {"id": i, "customer_id": 1, "status": "s", "total": "1"}
        table = rng.choice(["orders"] * 5 + ["widgets", "notes"])
        out.append(envelope("c", after=row, columns=columns, lsn=1000 + i, table=table))
    return [*out, "not json", envelope("c", has_after_schema=False)]


@pytest.mark.parametrize("per_file", [7, 50])
def test_schema_changes_from_the_state_store(spark, tmp_path, per_file):
    values = _layouts()
    cut = 70 // per_file * per_file
    for part, first in ((values[:cut], 0), (values[cut:], cut)):
        _files(tmp_path / "in", part, per_file, first=first)
        # rows of a micro-batch dealt over tasks without order
        dealt = schema_snapshots(parse(_stream(spark, tmp_path))).repartition(3)
        _run(change_stream(dealt), tmp_path, "changes")
    got = spark.read.parquet(str(tmp_path / "changes"))
    batch = schema_changes(schema_snapshots(parse(read_feed(spark, str(tmp_path / "in"), format="json"))))
    assert got.columns == batch.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect())) and got.count() > 20


def test_reject_cube(spark, tmp_path):
    _files(tmp_path / "in", _dated(), 100)
    recs = records(read_feed(spark, str(tmp_path / "in"), format="json"), [ORDERS])
    rows = {(r.level, r.drop_reason, r.table, r.op): r.n for r in reject_cube(recs).collect()}
    lost = recs.where("drop_reason is not null").selectExpr("drop_reason", "concat_ws('.', table_schema, table_name) t", "op").collect()
    want = {}
    for r in lost:
        for level in range(8):
            key = (level, r[0] if not level & 4 else None, r[1] if not level & 2 else None, r[2] if not level & 1 else None)
            want[key] = want.get(key, 0) + 1
    assert rows == want and rows[(7, None, None, None)] == len(lost)
    plan = reject_cube(recs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.rindex("partial_count")


def test_sketches_of_batches_are_those_of_the_whole(spark):
    rows = spark.range(0, 40_000).selectExpr(
        "'s' table_schema", "if(id % 3 = 0, 'a', 'b') table_name", "cast(null as string) drop_reason",
        "timestamp_millis(if(id % 50 = 7, 0, 1714400000000 + id * 60000)) true_tstamp", "id % 7000 k", "id % 4 batch",
    )
    arrived = F.timestamp_millis(F.unix_millis("true_tstamp") + F.col("k"))
    of = lambda df: flow_sketches(df, "k", "1 day", arrived)
    parts = of(rows.where("batch = 0"))
    for i in (1, 2, 3):
        parts = parts.unionByName(of(rows.where(f"batch = {i}")))
    merged = {r.table: r for r in read_sketches(merged_sketches(parts, "table")).collect()}
    whole = {r.table: r for r in read_sketches(merged_sketches(of(rows), "table")).collect()}
    exact = {r.table: r["keys"] for r in distinct_keys(rows, "k").collect()}
    for t, r in merged.items():
        # the estimate of a sketch depends a little on how it was merged
        assert r.n == whole[t].n and abs(r["keys"] - whole[t]["keys"]) <= 0.015 * exact[t]
        assert abs(r["keys"] - exact[t]) <= 0.03 * exact[t] and r["keys"] > 0
        assert abs(r.lag_50 - 3500) <= 0.06 * 7000 and abs(r.lag_99 - 6930) <= 0.06 * 7000
    none = read_sketches(flow_sketches(rows, "k")).first()
    assert none.lag_50 is None and json.dumps(none["n"])
