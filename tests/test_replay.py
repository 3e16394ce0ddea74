import glob
import os
import shutil

import pytest
from test_streaming import ORDERS, _files, _values

from rowtide.operators.assemble import dedup
from rowtide.sources.feed import read_feed
from rowtide.streaming.replay import ReplayIndex
from rowtide.streaming.run import read_events, run_stream, write_events

COLUMNS = "event_id string, seq bigint, payload string"


def _events(spark, ids, start):
    return spark.createDataFrame([(f"e{i}", start + at, f"p{i}") for at, i in enumerate(ids)], COLUMNS)


BATCHES = [list(range(40)), [*range(30, 60), 45, 45, 3], [*range(100, 110), 59, 0, 100], [], [105, 200]]


def _want(spark):
    whole, start = None, 0
    for ids in BATCHES:
        one = _events(spark, ids, start)
        whole, start = one if whole is None else whole.unionByName(one), start + 1000
    return sorted(map(tuple, dedup(whole).collect()))


def _run(spark, index, after=lambda i: None):
    out = []
    for i, ids in enumerate(BATCHES):
        out += [tuple(r) for r in index.first_seen(_events(spark, ids, 1000 * i), i).collect()]
        after(i)
    return sorted(out)


@pytest.mark.parametrize("bits", [16, 1])  # with one bit for an id the filters are often wrong
def test_batches_equal_dedup_of_the_whole(spark, tmp_path, bits):
    assert _run(spark, ReplayIndex(spark, str(tmp_path / "a"), buckets=8, bits=bits)) == _want(spark)


def test_packed_and_missing_filters(spark, tmp_path):
    index = ReplayIndex(spark, str(tmp_path / "a"), buckets=4)

    def after(i):
        if i in (1, 2, 3):
            index.pack(i)  # the last batch stays open
            again = index.first_seen(_events(spark, BATCHES[i], 1000 * i), i)
            assert again.count() == sum(1000 * i <= s < 1000 * i + 1000 for _, s, _ in want)
        if i == 2:
            for name in os.listdir(tmp_path / "a" / "filters"):
                shutil.rmtree(tmp_path / "a" / "filters" / name)

    want = _want(spark)
    assert _run(spark, index, after) == want
    with pytest.raises(ValueError):
        index.first_seen(_events(spark, [1], 0), 0)
    assert set(os.listdir(tmp_path / "a" / "maybe")) <= {"batch_id=2", "batch_id=3", "batch_id=4"}


def test_only_buckets_that_may_hold_an_id_are_read(spark, tmp_path):
    index = ReplayIndex(spark, str(tmp_path / "a"), buckets=16, bits=32)
    index.first_seen(_events(spark, range(64), 0), 0)
    got = index.first_seen(_events(spark, [7, *range(1000, 1004)], 100), 1)
    assert sorted(r.event_id for r in got.collect()) == [f"e{i}" for i in range(1000, 1004)]
    files = index.replayed(1).inputFiles()
    read = {f.split("/ids/")[1].rsplit("/", 1)[0] for f in files if "/ids/" in f}
    assert 1 <= len(read) <= 3 and all(f.startswith("batch_id=0/") for f in read)
    none = index.first_seen(_events(spark, range(5000, 5003), 200), 2)
    assert none.count() == 3


def test_stream_with_replays_equals_batch(spark, tmp_path):
    values = _values()
    _files(tmp_path / "in", [*values[:12], *values[6:], *values], 12)
    index = ReplayIndex(spark, str(tmp_path / "index"), buckets=4)
    out, target = str(tmp_path / "out"), str(tmp_path / "target")
    feed = read_feed(spark, str(tmp_path / "in"), format="json", streaming=True, max_per_trigger=1)
    run_stream(
        feed, [ORDERS], target, str(tmp_path / "cp"), available_now=True,
        on_batch=lambda evts, i: write_events(index.first_seen(evts, i), out, batch_id=i),
    ).awaitTermination()
    everything = read_events(spark, target)
    want = sorted((r.event_id, r.seq) for r in dedup(everything).collect())
    parts = [spark.read.parquet(f"{out}/{n}").select("event_id", "seq").collect() for n in os.listdir(out)
             if glob.glob(f"{out}/{n}/**/*.parquet", recursive=True)]
    assert sorted(tuple(r) for rows in parts for r in rows) == want
    assert everything.count() > len(want) > 0
