import glob

import pytest
from test_streaming import ORDERS, _files, _ids, _values

from rowtide.operators.assemble import events, records
from rowtide.sources.feed import read_feed
from rowtide.streaming import compaction
from rowtide.streaming.compaction import pack, read_list, read_packed
from rowtide.streaming.run import read_events, read_flow, read_rejected, read_schema_changes, run_stream


def _batch(spark, target, number, rows=20):
    df = spark.range(number * rows, (number + 1) * rows, 1, 2).selectExpr("id", "concat('t', id % 3) as name")
    df.write.mode("overwrite").parquet(f"{target}/rows/batch_id={number}")


def _found(spark, target):
    return sorted(r.id for r in read_packed(spark, target, "rows").collect())


def test_each_row_once_whatever_fails(spark, tmp_path, monkeypatch):
    target = str(tmp_path)
    for i in range(6):
        _batch(spark, target, i)
    want = list(range(120))
    assert _found(spark, target) == want
    real = compaction._replace_list

    def dies(*_):
        raise RuntimeError("driver is gone")

    monkeypatch.setattr(compaction, "_replace_list", dies)
    with pytest.raises(RuntimeError):
        pack(spark, target, "rows", 5, by=("name",))
    assert _found(spark, target) == want and read_list(spark, target, "rows")["segments"] == []
    monkeypatch.setattr(compaction, "_replace_list", real)
    bound = read_packed(spark, target, "rows")  # by the list before
    pack(spark, target, "rows", 5, by=("name",))
    assert _found(spark, target) == want and sorted(r.id for r in bound.collect()) == want
    assert compaction.batches(spark, target, "rows") == [0, 1, 2, 3, 4, 5]
    _batch(spark, target, 5)  # an open batch is run again
    pack(spark, target, "rows", 5)
    assert compaction.batches(spark, target, "rows") == [5] and _found(spark, target) == want
    assert read_packed(spark, target, "rows").where("name = 't1'").count() == 40


def test_files_and_directories_stay_few_over_many_batches(spark, tmp_path):
    target = str(tmp_path)
    spark.range(8).selectExpr("id", "'a' name").coalesce(1).write.parquet(f"{target}/one")
    source, _ = compaction._path(spark, f"{target}/one")
    compaction._path(spark, target)[1].mkdirs(compaction._path(spark, f"{target}/rows")[0])
    for i in range(200):
        path, fs = compaction._path(spark, f"{target}/rows/batch_id={i}")  # the same file, without a job for each
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, fs, path, False, spark._jsc.hadoopConfiguration())
        if i and i % 10 == 0:
            pack(spark, target, "rows", i, by=("name",), fan=4)
    content = read_list(spark, target, "rows")
    assert len(content["segments"]) <= 3 * 3 and read_packed(spark, target, "rows").count() == 1600
    ends = [(s["first"], s["last"]) for s in content["segments"]]
    assert all(b[0] == a[1] + 1 for a, b in zip(ends, ends[1:], strict=False)) and ends[0][0] == 0
    live = [f for s in content["segments"] for f in glob.glob(f"{s['folder'].removeprefix('file:')}/**/*.parquet", recursive=True)]
    assert len(live) <= len(ends) * 4
    assert len(compaction.batches(spark, target, "rows")) <= 21


def test_a_packed_stream_reads_like_the_batch(spark, tmp_path):
    values = _values()
    _files(tmp_path / "in", values, 2)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    source = read_feed(spark, str(tmp_path / "in"), format="json", streaming=True, max_per_trigger=1)
    run_stream(source, [ORDERS], out, cp, available_now=True, pack_every=3).awaitTermination()
    assert read_list(spark, out, "records")["segments"] and len(compaction.batches(spark, out, "records")) < 8
    recs = records(read_feed(spark, str(tmp_path / "in"), format="json"), [ORDERS])
    assert _ids(read_events(spark, out)) == _ids(events(recs))
    assert read_rejected(spark, out).count() == 11 and read_schema_changes(spark, out).count() == 10
    assert sum(r.n for r in read_flow(spark, out).collect()) == 21
