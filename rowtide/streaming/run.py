"""The change feed as a stream: events, rejects, schema changes and flow counts, batch by batch.

Each micro-batch writes its records once, under its own batch id, and everything else of the batch is
derived from that written table. A batch that is run again after a failure overwrites its own
directories, so each record ends up in the output once even though delivery is at least once, and no
cached blocks have to survive the loss of an executor.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from rowtide.contract import TableContract, require_sound
from rowtide.operators import accounting
from rowtide.operators.assemble import EVENT_COLUMNS, REJECT_COLUMNS, events, records
from rowtide.operators.schema_change import TABLE
from rowtide.streaming.compaction import pack, read_packed
from rowtide.streaming.schema_change import carry_changes

RECORDS, CHANGES, FLOW, STATE = "records", "schema_changes", "flow", "schema_state"


def run_stream(
    feed: DataFrame,
    contracts: Sequence[TableContract],
    target: str,
    checkpoint: str,
    *,
    app_id: str = "cdc",
    connector: str = "postgres",
    available_now: bool = False,
    interval: str = "10 seconds",
    on_batch: Callable[[DataFrame, int], None] | None = None,
    pack_every: int | None = None,
) -> StreamingQuery:
    """Start the stream. ``target`` and ``checkpoint`` are directories every executor can reach.

    After a restart with the same checkpoint the stream goes on after the last finished batch.
    ``on_batch`` gets the events of each batch, to hand them to another sink; offsets are only
    committed when it returns. With ``pack_every`` the directories of closed batches are packed into few files every so
    many batches; the readers below then take what is packed and what is not.
    """

    require_sound(feed.sparkSession, contracts)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        here = f"{target}/{RECORDS}/batch_id={batch_id}"
        recs = records(batch, contracts, app_id=app_id, connector=connector)
        outcome = F.when(F.col("drop_reason").isNull(), "event").otherwise("reject").alias("outcome")
        recs.select("*", outcome).write.mode("overwrite").partitionBy("outcome").parquet(here)
        written = spark.read.schema(recs.schema.add("outcome", "string")).parquet(here)
        carry_changes(spark, written, target, batch_id)
        flow = accounting.flow_by_table_op(written).select("table", "op", F.lit(None).cast("string").alias("drop_reason"), "n")
        lost = accounting.rejects_by_reason(written).select("table", F.lit(None).cast("string").alias("op"), "drop_reason", "n")
        flow.unionByName(lost).write.mode("overwrite").parquet(f"{target}/{FLOW}/batch_id={batch_id}")
        if on_batch is not None:
            on_batch(events(written), batch_id)
        if pack_every and batch_id and batch_id % pack_every == 0:
            # batches below this one are closed: they will not be run again
            pack(spark, target, RECORDS, batch_id, by=("outcome",), day=F.struct(*TABLE, F.to_date("true_tstamp")))
            pack(spark, target, CHANGES, batch_id)
            pack(spark, target, FLOW, batch_id)

    writer = feed.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def read_events(spark: SparkSession, target: str) -> DataFrame:
    return _outcome(spark, target, "event").select(*EVENT_COLUMNS)


def read_rejected(spark: SparkSession, target: str) -> DataFrame:
    return _outcome(spark, target, "reject").select(*REJECT_COLUMNS)


def _outcome(spark: SparkSession, target: str, outcome: str) -> DataFrame:
    return read_packed(spark, target, RECORDS).where(F.col("outcome") == outcome)


def read_schema_changes(spark: SparkSession, target: str) -> DataFrame:
    return read_packed(spark, target, CHANGES)


def read_flow(spark: SparkSession, target: str) -> DataFrame:
    """Counts over all batches: accepted per table and operation, rejected per table and reason."""
    rows = read_packed(spark, target, FLOW)
    return rows.groupBy("table", "op", "drop_reason").agg(F.sum("n").alias("n"))


def events_stream(feed: DataFrame, contracts: Sequence[TableContract], **options) -> DataFrame:
    """Events as a streaming DataFrame, for sinks that take one (memory, Kafka, files)."""
    return events(records(feed, contracts, **options))


def dedup_stream(evts: DataFrame, horizon: str | None = None) -> DataFrame:
    """Streaming events without replays; an event that was not seen before always passes.

    Ids are kept in the state for ``horizon``, counted from their arrival, or for ever. Arrival is the time
    of the micro-batch, which only moves forward, so no event is ever too late, whatever its commit time
    says. A replay that arrives after the horizon passes again; the state rows given up are in the query's
    progress.
    """
    if horizon is None:
        return evts.dropDuplicates(["event_id"])
    arrived = evts.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", horizon)
    return arrived.dropDuplicatesWithinWatermark(["event_id"]).drop("_arrived")


def write_events(
    evts: DataFrame, target: str, format: str = "parquet", batch_id: int | None = None, **options: str
) -> None:
    """Write a batch of events: files, partitioned by table, or Kafka with the event id as key.

    With a ``batch_id``, as ``on_batch`` gets it, files go to a directory of the batch, and a batch that is
    run again replaces them. Without it files are appended, and Kafka always is: there, delivery is at least
    once and ``event_id`` tells replays apart.
    """
    if format == "kafka":
        as_json = F.to_json(F.struct(*evts.columns), {"ignoreNullFields": "false"})
        rows = evts.select(F.col("event_id").alias("key"), as_json.alias("value"))
        rows.write.format("kafka").options(topic=target, **options).save()
        return
    keys = ("table_schema", "table_name")
    rows = evts.hint("rebalance", *keys)
    mode, path = ("append", target) if batch_id is None else ("overwrite", f"{target}/batch_id={batch_id}")
    rows.write.mode(mode).partitionBy(*keys).format(format).options(**options).save(path)


def read_totals(spark: SparkSession, target: str) -> dict[str, int]:
    """Received, emitted and dropped records of all finished batches of ``run_stream``, restarts included."""
    row = read_flow(spark, target).agg(
        F.sum("n"), F.sum(F.when(F.col("drop_reason").isNull(), F.col("n"))), F.sum(F.when(F.col("drop_reason").isNotNull(), F.col("n")))
    )
    return dict(zip(("received", "emitted", "dropped"), (n or 0 for n in row.first()), strict=True))


class FlowCounters(StreamingQueryListener):
    """Totals of ``events_stream`` queries, added up as their batches end; register it with ``spark.streams``.

    ``total`` has them by query id, which stays over restarts. A batch that is reported again counts once.
    """

    def __init__(self):
        self.total: dict[str, dict[str, int]] = {}
        self._last: dict[str, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress, key = event.progress, str(event.progress.id)
        if progress.batchId <= self._last.get(key, -1):
            return
        metrics = [row for name, row in progress.observedMetrics.items() if name.startswith("flow-")]
        if metrics:
            self._last[key] = progress.batchId
        total = self.total.setdefault(key, {"received": 0, "emitted": 0, "dropped": 0})
        for row in metrics:
            for k in total:
                total[k] += row[k]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def live_totals(query: StreamingQuery) -> dict[str, int]:
    """Received, emitted and dropped records of a short run of ``events_stream``.

    Spark remembers the progress of the last batches only. Where some are forgotten this refuses to give a
    number; ``FlowCounters`` and ``read_totals`` count without an end.
    """
    total = {"received": 0, "emitted": 0, "dropped": 0}
    progress = query.recentProgress
    first = min((p.batchId for p in progress), default=0)
    if first > 0:
        raise ValueError("progress of older batches is gone; use FlowCounters or read_totals")
    for p in progress:
        for name, row in p.observedMetrics.items():
            if name.startswith("flow-"):
                for k in total:
                    total[k] += row[k]
    return total
