"""As-of join: for each row the version of its key that was in force at its position.

A version holds from its start up to the next start of its key, the last one without end. The stretch between the first
start of a key and its last is cut into bins, so the join is one of equal keys and bins, and each bin is one row with the
starts it touches. The width of a bin follows the versions of its key: there are a few bins for each, however long the line
is. A long interval lies over many bins; these are told a piece at a time, by all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins laid out for each version, on average and at most, and bytes of all of them that are broadcast.
BINS_PER_VERSION = 8
BROADCAST_BYTES = 8 << 20
#: Bins of a block, and of one interval that are told from one row.
PIECE = 4096


def as_of(rows: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, start: str) -> DataFrame:
    """``rows`` with ``start``, the largest ``start`` of the row's key in ``versions`` that is not above ``at``.

    A row at a start belongs to the version that begins there. A row before the first start, or of a key without
    versions, gets null. A row whose ``at`` is null has no place on the line and gets the last version of its key. Starts
    that are null are left out; equal ones are one. Rows are neither lost nor repeated.

    Versions are read twice: for their number, which tells whether they are broadcast, and for the join itself. No row of
    theirs comes to the driver.
    """
    keys = list(keys)
    starts = versions.where(F.col(start).isNotNull()).select(*keys, F.col(start).cast("bigint").alias("_from")).distinct()
    # as doubles: a line may be longer than 64 bits can tell
    line = F.max("_from").cast("double") - F.min("_from").cast("double")
    closed = F.count("_from") - 1
    width = (line / (F.greatest(closed, F.lit(1)) * BINS_PER_VERSION)).cast("bigint") + 1
    last = starts.groupBy(*keys).agg(F.max("_from").alias("_last"), width.alias("_width"), closed.alias("_closed"))
    text = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(0))
    closed, size, last_size = last.agg(
        F.sum("_closed"), F.sum((text + 64) * (F.col("_closed") + 1)), F.sum(text + 64)
    ).first()
    # one row a key: joined by shuffles, all rows of a busy key would meet in one task
    known = rows.join(_sized(last.drop("_closed"), last_size or 0), keys, "left")
    position = F.col(at).cast("bigint")
    newest = F.when(position.isNull() | (position >= F.col("_last")), F.col("_last"))
    if not closed:
        return known.withColumn(start, newest).drop("_last", "_width")
    bins = _bins(starts.join(last.where("_closed > 0"), keys), keys)
    # rows of a key without versions find no bin; they are dealt out by their position
    placed = known.withColumn("_bin", _bin_of(position, F.coalesce("_width", F.lit(1)))).join(
        _sized(bins, (BINS_PER_VERSION + 1) * (size or 0)), [*keys, "_bin"], "left"
    )
    inside = F.array_max(F.filter("_starts", lambda s: s <= position))
    return placed.withColumn(start, newest.otherwise(inside)).drop("_last", "_width", "_bin", "_starts")


def _bin_of(position: Column, width: Column) -> Column:
    # whole-number division; below zero it rounds towards zero, which makes one bin wider and misplaces nothing
    return F.call_function("div", position, width)


def _bins(starts: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each bin from the first start of a key to its last: the starts in it, and the one in force before them.

    Neighbours are found within blocks of bins, and only the edges of a block are compared along a key, so no task sorts a
    busy key. Bins without starts are not laid out where the interval is found, as it may lie over millions: it is cut into
    pieces, which are dealt out to all tasks and only there told bin by bin.
    """
    along = Window.partitionBy(*keys).orderBy("_block")
    within = Window.partitionBy(*keys, "_block").orderBy("_bin")
    tasks = int(starts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = starts.withColumn("_bin", _bin_of(F.col("_from"), F.col("_width")))
    placed = placed.select(*keys, "_from", "_bin", _bin_of(F.col("_bin"), F.lit(PIECE)).alias("_block"))
    # dealt out by block: else rows that come by key, from the join with the widths, would stay so
    held = placed.repartition(tasks, *keys, "_block").groupBy(*keys, "_block", "_bin").agg(
        F.array_sort(F.collect_list("_from")).alias("_starts")
    )
    edges = held.groupBy(*keys, "_block").agg(F.min("_bin").alias("_first"), F.max(F.array_max("_starts")).alias("_newest"))
    edges = edges.select(
        *keys, "_block", F.lag("_newest").over(along).alias("_before"), F.lead("_first").over(along).alias("_next")
    )
    near = held.select(
        "*", F.lag(F.array_max("_starts")).over(within).alias("_near"), F.lead("_bin").over(within).alias("_following")
    )
    held = near.join(edges, [*keys, "_block"]).select(
        *keys, "_bin", F.coalesce(F.coalesce("_following", "_next") - 1, F.col("_bin")).alias("_until"),
        F.array_compact(F.concat(F.array(F.coalesce("_near", "_before")), "_starts")).alias("_starts"),
    )
    newest = F.slice("_starts", -1, 1)
    pieces = held.select("*", F.explode(F.sequence("_bin", "_until", F.lit(PIECE).cast("bigint"))).alias("_piece")).select(
        *keys, "_piece", F.least("_until", F.col("_piece") + (PIECE - 1)).alias("_until"),
        F.when(F.col("_piece") == F.col("_bin"), F.col("_starts")).otherwise(newest).alias("_starts"),
    )
    told = pieces.repartition(tasks, *keys, "_piece").select("*", F.explode(F.sequence("_piece", "_until")).alias("_bin"))
    return told.select(*keys, "_bin", F.when(F.col("_bin") == F.col("_piece"), F.col("_starts")).otherwise(newest).alias("_starts"))


def _sized(df: DataFrame, size: int) -> DataFrame:
    """Broadcast if it is known to be small; else the planner joins by shuffles and splits what is skewed."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df
