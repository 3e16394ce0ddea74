"""Flow accounting over classified records and events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flow_totals(recs: DataFrame) -> DataFrame:
    reason = F.col("drop_reason")
    return recs.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(reason.isNull()).alias("emitted"),
        F.count_if(reason.isNotNull()).alias("dropped"),
    )


def flow_by_table_op(recs: DataFrame) -> DataFrame:
    """Accepted changes per table and operation."""
    return (
        recs.where(F.col("drop_reason").isNull())
        .groupBy(F.concat_ws(".", "table_schema", "table_name").alias("table"), "op")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def nested_counts(by_table_op: DataFrame) -> DataFrame:
    """One row, ``per_table``: table to (operation to count). At most four operations per table.

    The row holds every table, so it is for as many as a report can show; ``flow_by_table_op`` has no such row.
    """
    per_table = by_table_op.groupBy("table").agg(F.array_sort(F.collect_list(F.struct("op", "n"))).alias("ops"))
    rows = F.array_sort(F.collect_list(F.struct("table", "ops")))
    as_map = lambda r: F.struct(r["table"], F.map_from_entries(r["ops"]))
    return per_table.agg(F.map_from_entries(F.transform(rows, as_map)).alias("per_table"))


def rejects_by_reason(recs: DataFrame) -> DataFrame:
    return (
        recs.where(F.col("drop_reason").isNotNull())
        .groupBy("drop_reason", F.concat_ws(".", "table_schema", "table_name").alias("table"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def reject_cube(recs: DataFrame) -> DataFrame:
    """Rejected records by reason, table and operation, and by every choice of these: ``drop_reason, table, op, level, n``.

    ``level`` tells which columns are summed over: 4 for the reason, 2 for the table and 1 for the operation, added up; 7 is
    the total. A null column at a level that does not sum over it is a value: records whose operation can't be told. The
    records are counted once, in the tasks; only counts are laid out over the levels.
    """
    counted = recs.where(F.col("drop_reason").isNotNull()).groupBy(
        "drop_reason", F.concat_ws(".", "table_schema", "table_name").alias("table"), "op"
    ).agg(F.count(F.lit(1)).alias("_n"))
    return counted.cube("drop_reason", "table", "op").agg(F.grouping_id().alias("level"), F.sum("_n").alias("n"))


# Size of the sketches: the standard error of a distinct count is 1.04 / 2 ** (LG_K / 2), under 1 %; the rank error of a
# quantile at K = 200 is 1.33 %.
LG_K = 14
K = 200


def flow_sketches(recs: DataFrame, key: str | Column, interval: str = "1 day", arrived: Column | None = None) -> DataFrame:
    """Mergeable sketches of accepted records: ``table, window_end, n, keys, lag``.

    ``keys`` is a sketch of the distinct values of ``key``; ``lag`` one of the milliseconds between commit and ``arrived``,
    of records that have a commit time, null without ``arrived``. Rows of different batches, intervals or tables are put
    together with ``merged_sketches``, and read with ``read_sketches``; a row has a bounded size whatever it has seen.
    """
    key = F.col(key) if isinstance(key, str) else key
    dated = F.when(F.col("true_tstamp") > F.timestamp_millis(F.lit(0)), F.unix_millis("true_tstamp"))
    behind = F.lit(None).cast("bigint") if arrived is None else F.unix_millis(arrived) - dated
    seen = recs.where(F.col("drop_reason").isNull()).select(
        F.concat_ws(".", "table_schema", "table_name").alias("table"),
        F.window("true_tstamp", interval)["end"].alias("window_end"),
        key.cast("string").alias("_key"),
        behind.alias("_behind"),
    )
    lag = F.kll_sketch_agg_bigint("_behind", K)
    return seen.groupBy("table", "window_end").agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("_key", LG_K).alias("keys"), F.when(F.count("_behind") > 0, lag).alias("lag")
    )


def merged_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Rows of ``flow_sketches`` put together by some of their columns.

    They hold what a sketch of all records would; estimates stay within the stated errors, but may differ a little with the
    order of merging.
    """
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.hll_union_agg("keys").alias("keys"),
        F.when(F.count("lag") > 0, F.kll_merge_agg_bigint("lag")).alias("lag"),
    )


def read_sketches(sketches: DataFrame, quantiles: Sequence[float] = (0.5, 0.99)) -> DataFrame:
    """Estimates in place of sketches: ``keys``, and ``lag_50``, ``lag_99`` ... in milliseconds."""
    rest = [c for c in sketches.columns if c not in ("keys", "lag")]
    lag = [
        F.when(F.col("lag").isNotNull(), F.kll_sketch_get_quantile_bigint("lag", F.lit(float(q)))).alias(f"lag_{q * 100:g}") for q in quantiles
    ]
    return sketches.select(*rest, F.hll_sketch_estimate("keys").alias("keys"), *lag)


def distinct_keys(recs: DataFrame, key: str | Column) -> DataFrame:
    """The exact count: ``table, keys``. Every distinct key is shuffled once."""
    key = F.col(key) if isinstance(key, str) else key
    seen = recs.where(F.col("drop_reason").isNull()).select(F.concat_ws(".", "table_schema", "table_name").alias("table"), key.alias("_key"))
    return seen.groupBy("table").agg(F.count_distinct("_key").alias("keys"))


def heartbeat(recs: DataFrame, interval: str = "60 seconds", tables: Sequence[str] | None = None) -> DataFrame:
    """Cumulative totals at the end of each interval of event time that saw a record.

    ``per_table`` is JSON with an entry per table and operation seen so far, of all tables, or of the ``tables``
    (``schema.name``) given. It makes each row as long as there are tables; ``heartbeat_by_table`` has a short
    row for each change instead.

    The records are read once: counts per interval, table and operation are folded in the tasks, and everything
    else is a chain over these few rows. Totals are carried as one more entry, which every interval has; an
    entry holds from its interval to the next one that changes it, and is laid out over the intervals between.
    """
    counted = _keyed(recs, interval).groupBy("window", "table", "op").agg(
        F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("bad")
    )
    listed = F.col("ok") > 0
    if tables is not None:
        listed = listed & F.col("table").isin(list(tables))
    ticks = counted.groupBy("window").agg(
        F.sum("ok").alias("emitted"),
        F.sum("bad").alias("dropped"),
        F.lit(1).alias("place"),
        F.collect_list(F.when(listed, F.struct("table", "op", F.col("ok").alias("n")))).alias("entries"),
    )
    total = _running(ticks, ["emitted", "dropped", "place"], carried=["entries"])
    head = F.struct(F.lit(None).cast("string").alias("table"), F.lit(None).cast("string").alias("op"), F.lit(0).cast("long").alias("n"))
    beat = F.struct("window", "_start", "emitted", "dropped").alias("beat")
    each = total.select(beat, "place", "_places", F.explode(F.concat(F.array(head), "entries")).alias("e"))
    own = Window.partitionBy("e.table", "e.op").orderBy("place")
    lasting = each.select(
        F.when(F.col("e.table").isNull(), F.col("beat")).alias("beat"),
        F.col("e.table").alias("table"),
        F.col("e.op").alias("op"),
        F.sum("e.n").over(own).alias("n"),
        F.sequence("place", F.coalesce(F.lead("place").over(own) - 1, "_places")).alias("places"),
    )
    by_table = lasting.withColumn("place", F.explode("places")).groupBy("place", "table").agg(
        F.max("beat").alias("beat"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("op").isNotNull(), F.struct("op", "n"))))).alias("ops"),
    )
    beats = by_table.groupBy("place").agg(
        F.max("beat").alias("beat"),
        F.array_sort(F.collect_list(F.when(F.col("table").isNotNull(), F.struct("table", F.to_json("ops").alias("ops"))))).alias("of"),
    )
    # Tables and counts are put together as text: a map of maps would have to be ordered by a struct of a map.
    entry = lambda r: F.concat(_json_name(r["table"]), F.lit(":"), r["ops"])
    per_table = F.concat(F.lit("{"), F.array_join(F.transform("of", entry), ","), F.lit("}"))
    return beats.select(
        F.lit("heartbeat").alias("event"),
        F.col("beat.window.end").alias("window_end"),
        (F.col("beat.emitted") + F.col("beat.dropped")).alias("received"),
        "beat.emitted",
        "beat.dropped",
        per_table.alias("per_table"),
        F.greatest(F.lit(0), F.unix_seconds("beat.window.end") - F.unix_seconds("beat._start")).alias("uptime_seconds"),
    )


def _json_name(c: Column) -> Column:
    return F.regexp_extract(F.to_json(F.struct(c.alias("s"))), r"(?s)^\{\"s\":(.*)\}$", 1)


def heartbeat_by_table(recs: DataFrame, interval: str = "60 seconds") -> DataFrame:
    """Cumulative accepted changes per table and operation, one row per interval that adds any."""
    ticks = (
        _keyed(recs, interval).where("ok").groupBy("window", "table", "op").agg(F.count(F.lit(1)).alias("n"))
    )
    return _running(ticks, ["n"], ["table", "op"]).select(F.col("window.end").alias("window_end"), "table", "op", "n")


def _keyed(recs: DataFrame, interval: str) -> DataFrame:
    return recs.select(
        F.window("true_tstamp", interval).alias("window"),
        F.col("drop_reason").isNull().alias("ok"),
        F.concat_ws(".", "table_schema", "table_name").alias("table"),
        "op",
    )


# Intervals summed by one task before offsets are added.
STRETCH = 4096


def _running(
    ticks: DataFrame, counts: Sequence[str], keys: Sequence[str] = (), carried: Sequence[str] = ()
) -> DataFrame:
    """Running sums over intervals, per key.

    The time line is cut into stretches. Each becomes one row with its intervals as an array; these rows, one
    for each ``STRETCH`` intervals, get the totals of those before them, and are opened again to be summed inside.
    It is one chain, so what is above it is computed once. Adds ``_start``, where the first interval
    begins; the epoch does not count, it holds the records without a commit time. Adds ``_places``, the sum of
    the last count over the whole time line.
    """
    start, end = F.unix_micros("window.start"), F.unix_micros("window.end")
    cut = ticks.withColumn("_part", F.floor(start / ((end - start) * STRETCH)))
    parts = cut.groupBy(*keys, "_part").agg(
        F.min(F.when(start > 0, F.col("window.start"))).alias("_first"),
        *[F.sum(c).alias(f"_sum_{c}") for c in counts],
        F.collect_list(F.struct("window", *counts, *carried)).alias("_ticks"),
    )
    line = Window.partitionBy(*keys)
    earlier = line.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # Two steps: a generator in the same step would come before the windows.
    shifted = parts.select(
        *keys,
        "_part",
        "_ticks",
        F.least(F.min("_first").over(earlier), "_first").alias("_start"),
        F.sum(f"_sum_{counts[-1]}").over(line).alias("_places"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_off_{c}") for c in counts],
    )
    opened = shifted.select("*", F.inline("_ticks")).drop("_ticks")
    inside = Window.partitionBy(*keys, "_part").orderBy("window.start").rowsBetween(Window.unboundedPreceding, 0)
    return opened.select(
        "window", *keys, "_start", "_places", *carried,
        *[(F.col(f"_off_{c}") + F.sum(c).over(inside)).alias(c) for c in counts],
    )


def event_summary(evts: DataFrame) -> DataFrame:
    """Id, operation, table, log position and the status cell of both images, to look at events."""
    return evts.select(
        F.col("event_id").alias("eid"),
        "op",
        F.col("cdc_source.table").alias("table"),
        F.col("cdc_source.lsn").alias("lsn"),
        F.get_json_object("payload", "$.before.status").alias("before_status"),
        F.get_json_object("payload", "$.after.status").alias("after_status"),
    )
