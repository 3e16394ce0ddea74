import glob
import json
import os
import time

import pytest
from envelopes import COLUMNS, envelope
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.operators.assemble import dedup, events, records, rejected
from rowtide.operators.envelope import parse, schema_snapshots
from rowtide.operators.schema_change import schema_changes
from rowtide.sources.feed import read_feed
from rowtide.streaming.run import (
    FlowCounters,
    dedup_stream,
    events_stream,
    live_totals,
    read_events,
    read_flow,
    read_rejected,
    read_schema_changes,
    read_totals,
    run_stream,
    write_events,
)

ORDERS = TableContract("public", "orders", "iglu:com.example/o/jsonschema/1-0-0", ("id",), ("id", "status"))
MORE = [*COLUMNS, ("country", "string", None, True)]
RETYPED = [*COLUMNS[:3], ("total", "double", None, True)]


def _values():
    layouts = [COLUMNS, COLUMNS, MORE, MORE, COLUMNS, COLUMNS, RETYPED, MORE, MORE, COLUMNS]
    out = []
    for i, columns in enumerate(layouts):
        row = {"id": i, "customer_id": 1, "status": "s", "total": "1"}
        out.append(envelope("c", after=row, columns=columns, lsn=1000 + i))
        out.append(envelope("c", after=row, columns=columns, lsn=1000 + i, table="widgets"))
    return [*out, "not json", None]


def _files(path, values, per_file, first=0):
    for n, i in enumerate(range(0, len(values), per_file)):
        rows = [
            {"seq": first + i + j, "destination": "d", "value": v} for j, v in enumerate(values[i : i + per_file])
        ]
        path.mkdir(parents=True, exist_ok=True)
        name = path / f"part-{first + n:05d}.json"
        name.write_text("\n".join(json.dumps(r) for r in rows))
        # The file source goes by modification time.
        os.utime(name, (1700000000 + first + n, 1700000000 + first + n))


def _ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


@pytest.mark.parametrize("per_file", [4, 9])
def test_stream_equals_batch_under_any_split(spark, tmp_path, per_file):
    values = _values()
    _files(tmp_path / "in", values, per_file)
    source = read_feed(spark, str(tmp_path / "in"), format="json", streaming=True, max_per_trigger=1)
    q = run_stream(source, [ORDERS], str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    q.awaitTermination()
    batches = len(glob.glob(str(tmp_path / "out" / "records" / "batch_id=*")))
    assert batches == -(-len(values) // per_file)

    feed = read_feed(spark, str(tmp_path / "in"), format="json")
    recs = records(feed, [ORDERS])
    out = str(tmp_path / "out")
    assert _ids(read_events(spark, out)) == _ids(events(recs))
    assert read_rejected(spark, out).count() == rejected(recs).count() == 11

    key = ["seq", "table", "previous_fingerprint", "current_fingerprint", "added_columns", "removed_columns"]
    mine = sorted(map(tuple, read_schema_changes(spark, out).select(*key).collect()))
    batch = sorted(map(tuple, schema_changes(schema_snapshots(parse(feed))).select(*key).collect()))
    assert mine == batch and len(mine) == 10

    flow = {(r.table, r.op or r.drop_reason): r.n for r in read_flow(spark, out).collect()}
    assert flow == {
        ("public.orders", "c"): 10, ("public.widgets", "unconfigured_table"): 10, (".", "unparseable"): 1,
    }


def test_resume_emits_only_new_records(spark, tmp_path):
    values = _values()
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    seen = []

    def run():
        source = read_feed(spark, str(tmp_path / "in"), format="json", streaming=True)
        q = run_stream(
            source, [ORDERS], out, cp, available_now=True, on_batch=lambda e, i: seen.append((i, e.count()))
        )
        q.awaitTermination()

    _files(tmp_path / "in", values[:8], 8)
    run()
    assert seen == [(0, 4)]
    _files(tmp_path / "in", values[8:], 50, first=8)
    run()
    assert seen == [(0, 4), (1, 6)]
    assert read_events(spark, out).count() == 10
    # The transition between the two runs is reported, from the state the first one left.
    changes = read_schema_changes(spark, out).where("table = 'public.orders' and seq = 8").collect()
    assert [(c.added_columns, c.removed_columns) for c in changes] == [([], ["country"])]


def test_failed_batch_is_run_again_without_doubles(spark, tmp_path):
    _files(tmp_path / "in", _values(), 100)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def fail(_e, _i):
        raise RuntimeError("sink is down")

    source = read_feed(spark, str(tmp_path / "in"), format="json", streaming=True)
    with pytest.raises(Exception, match="sink is down"):
        run_stream(source, [ORDERS], out, cp, available_now=True, on_batch=fail).awaitTermination()
    q = run_stream(source, [ORDERS], out, cp, available_now=True)
    q.awaitTermination()
    assert read_events(spark, out).count() == 10
    assert read_schema_changes(spark, out).count() == 10


def test_memory_sink(spark, tmp_path):
    _files(tmp_path / "in", _values(), 5)
    source = read_feed(spark, str(tmp_path / "in"), format="json", streaming=True)
    q = (
        events_stream(source, [ORDERS], app_id="shop")
        .writeStream.format("memory").queryName("recorded").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    q.awaitTermination()
    rows = spark.table("recorded").collect()
    assert len(rows) == 10 and {r.app_id for r in rows} == {"shop"}
    assert live_totals(q) == {"received": 21, "emitted": 10, "dropped": 11}


def test_stream_dedup(spark, tmp_path):
    values = _values()[:20]
    _files(tmp_path / "in", [*values, *values], 10)
    source = read_feed(spark, str(tmp_path / "in"), format="json", streaming=True, max_per_trigger=1)
    q = (
        dedup_stream(events_stream(source, [ORDERS]), "1 hour")
        .writeStream.format("memory").queryName("once").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    q.awaitTermination()
    feed = read_feed(spark, str(tmp_path / "in"), format="json")
    assert _ids(spark.table("once")) == _ids(dedup(events(records(feed, [ORDERS]))))


def test_stream_dedup_never_drops_a_first_delivery(spark, tmp_path):
    """Events far behind the others, without commit time, and replays that come late: the same as in a batch."""
    row = {"id": 1, "customer_id": 1, "status": "s", "total": "1"}
    times = [1714400000000, 1714407200000, 1714400000000 - 9 * 3600_000, None, 1714414400000, 1714403600000]
    values = [envelope("c", after={**row, "id": i}, lsn=i, ts_ms=t) for i, t in enumerate(times)]
    values += [values[2], values[3], values[0], values[5]]
    for horizon in (None, "1 hour"):
        name = "kept_" + (horizon or "ever").replace(" ", "_")
        here = tmp_path / name
        _files(here / "in", values, 2)
        source = read_feed(spark, str(here / "in"), format="json", streaming=True, max_per_trigger=1)
        q = (
            dedup_stream(events_stream(source, [ORDERS]), horizon)
            .writeStream.format("memory").queryName(name).trigger(availableNow=True)
            .option("checkpointLocation", str(here / "cp")).start()
        )
        q.awaitTermination()
        feed = read_feed(spark, str(here / "in"), format="json")
        assert _ids(spark.table(name)) == _ids(dedup(events(records(feed, [ORDERS]))))
        dropped = [s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"]]
        assert not any(dropped)


def test_totals_survive_restarts_and_forgotten_progress(spark, tmp_path):
    values = _values()
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    for part in (values[:8], values[8:]):
        _files(tmp_path / "in", part, 3, first=0 if len(part) == 8 else 8)
        source = read_feed(spark, str(tmp_path / "in"), format="json", streaming=True, max_per_trigger=1)
        run_stream(source, [ORDERS], out, cp, available_now=True).awaitTermination()
    assert read_totals(spark, out) == {"received": 21, "emitted": 10, "dropped": 11}
    assert len(glob.glob(f"{out}/schema_state/batch_id=*")) == 2

    counters = FlowCounters()
    spark.streams.addListener(counters)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        source = read_feed(spark, str(tmp_path / "in"), format="json", streaming=True, max_per_trigger=1)
        q = events_stream(source, [ORDERS]).writeStream.format("noop").trigger(availableNow=True)
        q = q.option("checkpointLocation", str(tmp_path / "cp2")).start()
        q.awaitTermination()
        with pytest.raises(ValueError, match="FlowCounters"):
            live_totals(q)
        for _ in range(50):
            if counters.total.get(str(q.id), {}).get("received") == 21:
                break
            time.sleep(0.2)
        assert counters.total[str(q.id)] == {"received": 21, "emitted": 10, "dropped": 11}
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
        spark.streams.removeListener(counters)


def test_events_of_a_batch_that_runs_again_are_replaced(spark, tmp_path):
    _files(tmp_path / "in", _values(), 100)
    evts = events(records(read_feed(spark, str(tmp_path / "in"), format="json"), [ORDERS]))
    for _ in range(2):
        write_events(evts, str(tmp_path / "events"), batch_id=7)
    assert _ids(spark.read.parquet(str(tmp_path / "events"))) == _ids(evts)


def test_write_events_as_files(spark, tmp_path):
    _files(tmp_path / "in", _values(), 100)
    evts = events(records(read_feed(spark, str(tmp_path / "in"), format="json"), [ORDERS]))
    write_events(evts, str(tmp_path / "events"))
    back = spark.read.parquet(str(tmp_path / "events"))
    assert _ids(back) == _ids(evts)
    assert back.where(F.col("table_name") == "orders").count() == 10
