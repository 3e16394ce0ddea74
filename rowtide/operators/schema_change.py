"""Source-schema changes: per table, in delivery order, each move to another column fingerprint."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.session import shelve

# Width in ``seq`` of the stretches that are folded before anything is ordered, and of the wider cuts in which the
# folded rows are compared. See ``schema_changes``.
STRETCHES = (1 << 16, 1 << 34)

CHANGE_COLUMNS = (
    "seq", "event", "table", "previous_fingerprint", "current_fingerprint", "added_columns", "removed_columns",
)


TABLE = ("table_schema", "table_name")


def schema_changes(snapshots: DataFrame, stretches: Sequence[int] = STRETCHES) -> DataFrame:
    """Transitions between consecutive snapshots of a table.

    Input: ``seq, table_schema, table_name, column_fingerprint, column_names``, and optionally ``is_state``, true
    for a row that stands before all others of its table. The first snapshot of a table is silent, and so is one
    equal to its predecessor. Rows with the same ``seq`` go by fingerprint.

    A table is cut into stretches of ``seq``, and each is folded to the range of every schema in it, inside the
    tasks first. Where the ranges of a stretch lie one behind the other, which is nearly everywhere, these few rows
    tell all transitions. Only stretches with ranges that overlap are read again, row by row. What is left is
    compared in ever wider cuts, in which only the first and last row of a cut go on to the next, so that no
    task orders a whole table.
    """
    return describe(transitions(snapshots, stretches))


def transitions(snapshots: DataFrame, stretches: Sequence[int] = STRETCHES, firsts: bool = False) -> DataFrame:
    """The rows of ``schema_changes`` with what was before: ``_prev``, ``_prev_names``; with ``firsts`` the first row of each
    table too, without them. ``column_names`` may be whatever else a schema is to be told by."""
    width = stretches[0] if stretches else None
    folded, keys = shelve(fold(snapshots, width)), _STRETCH
    w = Window.partitionBy(*keys).orderBy("seq", "column_fingerprint")
    reach = F.max("_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    mixed = folded.withColumn("_over", F.col("seq") <= reach).where("_over").select(*keys).distinct()
    runs = folded.drop("_end")
    if not mixed.isEmpty():
        same = [F.col(f"m.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
        m = mixed.alias("m")
        prev = F.lag("column_fingerprint").over(w)
        inside = _cut(snapshots, width).alias("r").join(m, same, "left_semi").withColumn("_prev", prev)
        starts = inside.where(F.col("_prev").isNull() | (F.col("_prev") != F.col("column_fingerprint"))).drop("_prev")
        runs = runs.alias("r").join(m, same, "left_anti").select(*runs.columns).unionByName(starts.select(*runs.columns))
    return _transitions(runs.drop("stretch").withColumn("_open", F.lit(True)), stretches[1:], firsts)


_STRETCH = [*TABLE, "is_state", "stretch"]


def _cut(snapshots: DataFrame, width: int | None) -> DataFrame:
    state = F.col("is_state") if "is_state" in snapshots.columns else F.lit(False)
    stretch = F.lit(0) if width is None else F.expr(f"seq div {width}")
    return snapshots.select(
        *TABLE, state.alias("is_state"), stretch.alias("stretch"), "seq", "column_fingerprint", "column_names"
    )


def fold(snapshots: DataFrame, width: int | None) -> DataFrame:
    """The first and last ``seq`` of each schema in each stretch of a table."""
    cut = _cut(snapshots, width).groupBy(*_STRETCH, "column_fingerprint", "column_names")
    return cut.agg(F.min("seq").alias("seq"), F.max("seq").alias("_end"))


def _transitions(rows: DataFrame, stretches: Sequence[int], firsts: bool = False) -> DataFrame:
    """Rows whose predecessor has another fingerprint, with that one's; ``_open`` rows are still without predecessor."""
    found = []
    for width in (*stretches, None):
        keys = [F.col(c) for c in TABLE]
        if width is not None:
            keys += [F.col("is_state"), F.expr(f"seq div {width}")]
        w = Window.partitionBy(*keys).orderBy(F.col("is_state").desc(), "seq", "column_fingerprint")
        seen = rows.select(
            "*",
            F.lag("column_fingerprint").over(w).alias("_prev"),
            F.lag("column_names").over(w).alias("_prev_names"),
            F.lead("column_fingerprint").over(w).isNull().alias("_last"),
        )
        found.append(
            seen.where(F.col("_open") & (F.col("_prev") != F.col("column_fingerprint"))).select(
                "seq", *TABLE, "_prev", "_prev_names", "column_fingerprint", "column_names"
            )
        )
        edges = seen.where(F.col("_prev").isNull() | F.col("_last"))
        rows = edges.select(
            "seq", *TABLE, "is_state", "column_fingerprint", "column_names",
            (F.col("_open") & F.col("_prev").isNull()).alias("_open"),
        )
    if firsts:
        none = [F.lit(None).cast(found[0].schema[c].dataType).alias(c) for c in ("_prev", "_prev_names")]
        found.append(rows.where("_open").select("seq", *TABLE, *none, "column_fingerprint", "column_names"))
    return reduce(DataFrame.unionByName, found)


def describe(transitions: DataFrame) -> DataFrame:
    """The change record of each transition, lists sorted."""
    now, before = F.col("column_names"), F.col("_prev_names")
    return transitions.select(
        "seq",
        F.lit("source_schema_change").alias("event"),
        F.concat_ws(".", "table_schema", "table_name").alias("table"),
        F.col("_prev").alias("previous_fingerprint"),
        F.col("column_fingerprint").alias("current_fingerprint"),
        column_diff(now, before).alias("added_columns"),
        column_diff(before, now).alias("removed_columns"),
    )


def column_diff(a: Column, b: Column) -> Column:
    """Names in ``a`` and not in ``b``, once each, sorted."""
    return F.array_sort(F.array_except(a, b))


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """The last snapshot of each table. Rows are folded per distinct schema before they are compared."""
    if "is_state" not in snapshots.columns:
        snapshots = snapshots.withColumn("is_state", F.lit(False))
    folded = snapshots.groupBy(*TABLE, "column_fingerprint", "column_names").agg(
        F.max(F.struct((~F.col("is_state")).alias("later"), "seq")).alias("at")
    )
    order = F.struct("at", "column_fingerprint")
    last = F.max_by(F.struct("at.seq", "column_fingerprint", "column_names"), order)
    return folded.groupBy(*TABLE).agg(last.alias("_s")).select("_s.seq", *TABLE, "_s.column_fingerprint", "_s.column_names")
