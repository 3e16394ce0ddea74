"""Heartbeats of a running stream: counts per interval of commit time, as soon as the interval is over.

An interval is over when the watermark has passed its end. Records that come for it later are told too, in rows of
their own that are marked late, so the rows of an interval always add up to what was received; a watermark only decides
when an interval is first told. Records without a commit time belong to the interval of the epoch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_COUNTS = "window_end_ms long, table string, op string, n long, dropped long"
BEATS = f"{_COUNTS}, late boolean"


def heartbeat_stream(recs: DataFrame, interval: str = "60 seconds", delay: str = "10 minutes") -> DataFrame:
    """``window_end, table, op, n, dropped, late`` of streaming records as of ``records``, in append mode.

    ``n`` counts accepted and ``dropped`` rejected records; ``op`` is null where a record tells none. A row that is not
    late comes once for each interval, table and operation, when the watermark, ``delay`` behind the latest commit time
    seen, passes the interval's end. Late rows come with the micro-batch that brings the records.

    Records are counted in the tasks first, so the state gets a row for each task and count, whatever the table's share.
    """
    seen = recs.withWatermark("true_tstamp", delay).select(
        F.unix_millis(F.window("true_tstamp", interval)["end"]).alias("window_end_ms"),
        F.concat_ws(".", "table_schema", "table_name").alias("table"),
        F.coalesce("op", F.lit("")).alias("op"),
        F.col("drop_reason").isNull().alias("ok"),
    )
    # The time column ends here: Spark would drop late rows of it before the state sees them.
    counted = seen.mapInArrow(_counted(), _COUNTS)
    beats = counted.groupBy("window_end_ms", "table", "op").transformWithStateInPandas(_processor(), BEATS, "append", "eventTime")
    return beats.select(
        F.timestamp_millis("window_end_ms").alias("window_end"), "table", F.nullif("op", F.lit("")).alias("op"), "n", "dropped", "late"
    )


def _counted():
    """Counts of a task. Built inside a function, like the processor, so that executors need no installation."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, list[int]] = {}
        for batch in batches:
            groups = pa.Table.from_batches([batch]).group_by(["window_end_ms", "table", "op", "ok"]).aggregate([([], "count_all")])
            for row in groups.to_pylist():
                total = totals.setdefault((row["window_end_ms"], row["table"], row["op"]), [0, 0])
                total[0 if row["ok"] else 1] += row["count_all"]
        if totals:
            keys, counts = list(zip(*totals, strict=True)), list(zip(*totals.values(), strict=True))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip([*keys, *counts], kinds, strict=True)], ["window_end_ms", "table", "op", "n", "dropped"]
            )

    return go


def _processor():
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Counts(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.counts = handle.getValueState("counts", "n long, dropped long")

        @staticmethod
        def row(key, n, dropped, late):
            return pd.DataFrame({"window_end_ms": [int(key[0])], "table": [key[1]], "op": [key[2]], "n": [n], "dropped": [dropped], "late": [late]})

        def handleInputRows(self, key, rows, timerValues):
            n = dropped = 0
            for part in rows:
                n, dropped = n + int(part["n"].sum()), dropped + int(part["dropped"].sum())
            end = int(key[0])
            if end <= timerValues.getCurrentWatermarkInMs():
                yield self.row(key, n, dropped, True)
                return
            if self.counts.exists():
                before = self.counts.get()
                n, dropped = n + before[0], dropped + before[1]
            else:
                self.handle.registerTimer(end)
            self.counts.update((n, dropped))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            n, dropped = self.counts.get()
            self.counts.clear()
            yield self.row(key, int(n), int(dropped), False)

        def close(self):
            pass

    return Counts()


def running_heartbeats(beats: DataFrame) -> DataFrame:
    """``window_end, table, op, n``: accepted changes up to each interval that added any, from rows written by the stream.

    Late rows count in the interval they belong to, so this is what ``heartbeat_by_table`` gives for the same records.
    """
    per = beats.where("n > 0").groupBy("window_end", "table", "op").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("table", "op").orderBy("window_end")
    return per.withColumn("n", F.sum("n").over(before))
