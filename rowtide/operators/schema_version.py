"""Versions of a table's schema: each change classified by what it does to rows written before, and numbered.

A schema is taken as its property map, column to JSON Schema type, format and nullability, as the schemas of
``scaffold`` have it. Of a change it says

- ``model``: a column is gone, or its type no longer admits what it held;
- ``revision``: rows written before may not fit, as a column came without nulls or lost them;
- ``addition``: all of them still fit: columns that may be null, columns that may be null now, whole numbers that became
  numbers, another order, or another database type of the same JSON type.

The heaviest one counts. Versions are ``model-revision-addition``, from 1-0-0 on; a number begins again when one
before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.operators.envelope import with_fingerprint
from rowtide.operators.scaffold import json_form
from rowtide.operators.schema_change import STRETCHES, TABLE, transitions
from rowtide.sources.catalog import udt_name

VERSION_COLUMNS = (
    "seq", *TABLE, "version", "change", "added", "dropped", "retyped", "widened", "tightened", "loosened", "column_fingerprint",
)


def properties(columns: Column) -> Column:
    """The property map of a schema block, as an array in the order of the columns."""

    def one(c: Column) -> Column:
        udt = udt_name(F.coalesce(c["type"], F.lit("")), F.coalesce(c["name"], F.lit("")))
        kind, form = json_form(udt)
        return F.struct(
            F.coalesce(c["field"], F.lit("")).alias("field"),
            F.coalesce(kind, udt).alias("kind"),
            F.coalesce(form, F.lit("")).alias("form"),
            F.coalesce(c["optional"], F.lit(True)).alias("nullable"),
        )

    return F.transform(columns, one)


def property_snapshots(parsed: DataFrame, known: Sequence[str] = ()) -> DataFrame:
    """One row per record that has a readable schema block."""
    seen = with_fingerprint(parsed, known).where(F.col("columns").isNotNull())
    return seen.select("seq", *TABLE, "column_fingerprint", properties(F.col("columns")).alias("properties"))


def block_snapshots(parsed: DataFrame, known: Sequence[str] = ()) -> DataFrame:
    """``property_snapshots`` with ``columns`` in place of ``properties``: ``schema_versions`` reads these of changes only."""
    seen = with_fingerprint(parsed, known).where(F.col("columns").isNotNull())
    return seen.select("seq", *TABLE, "column_fingerprint", "columns")


def schema_versions(snapshots: DataFrame, stretches: Sequence[int] = STRETCHES) -> DataFrame:
    """One row for the first schema of each table and for each change of it.

    Input: ``seq, table_schema, table_name, column_fingerprint, properties`` (or ``columns``), and optionally ``is_state`` as for
    ``schema_changes``, which finds the changes; equal fingerprints must come with equal properties. Lists of columns are
    sorted. A name that a schema has twice counts as changed if one of its columns is.

    Changes are numbered inside stretches of ``seq``, of which one row each is put together per table, so that a table
    that flaps is not ordered in one task.
    """
    if "columns" in snapshots.columns:
        found = transitions(snapshots.withColumnRenamed("columns", "column_names"), stretches, firsts=True)
        found = found.withColumns({c: properties(F.col(c)) for c in ("column_names", "_prev_names")})
    else:
        found = transitions(snapshots.withColumnRenamed("properties", "column_names"), stretches, firsts=True)
    return _numbered(_classified(found), stretches[0] if stretches else None)


def _classified(found: DataFrame) -> DataFrame:
    now, before = F.col("column_names"), F.col("_prev_names")
    moved = found.select("*", F.array_except(now, before).alias("_in"), F.array_except(before, now).alias("_out"))
    pairs = F.flatten(
        F.transform(
            "_in",
            lambda n: F.transform(
                F.filter("_out", lambda o: o["field"] == n["field"]), lambda o: F.struct(n.alias("n"), o.alias("o"))
            ),
        )
    )
    moved = moved.withColumn("_pairs", pairs)

    def alone(side: str, other: str) -> Column:
        return F.filter(side, lambda c: ~F.exists(other, lambda o: o["field"] == c["field"]))

    def names(c: Column) -> Column:
        return F.coalesce(F.array_sort(F.array_distinct(c)), F.array().cast("array<string>"))

    def fields(c: Column) -> Column:
        return names(F.transform(c, lambda x: x["field"]))

    def among(test) -> Column:
        return names(F.transform(F.filter("_pairs", lambda p: test(p["n"], p["o"])), lambda p: p["n"]["field"]))

    def other(n: Column, o: Column) -> Column:
        return (n["kind"] != o["kind"]) | (n["form"] != o["form"])

    def wider(n: Column, o: Column) -> Column:
        return (o["kind"] == "integer") & (n["kind"] == "number") & (o["form"] == n["form"])

    told = moved.select(
        "seq", *TABLE, "column_fingerprint", "_prev",
        fields(alone("_in", "_out")).alias("added"),
        fields(alone("_out", "_in")).alias("dropped"),
        among(lambda n, o: other(n, o) & ~wider(n, o)).alias("retyped"),
        among(wider).alias("widened"),
        among(lambda n, o: o["nullable"] & ~n["nullable"]).alias("tightened"),
        among(lambda n, o: ~o["nullable"] & n["nullable"]).alias("loosened"),
        F.coalesce(F.exists(alone("_in", "_out"), lambda c: ~c["nullable"]), F.lit(False)).alias("_must"),
    )
    change = (
        F.when(F.col("_prev").isNull(), "first")
        .when((F.size("dropped") > 0) | (F.size("retyped") > 0), "model")
        .when((F.size("tightened") > 0) | F.col("_must"), "revision")
        .otherwise("addition")
    )
    return told.withColumn("change", change)


def _numbered(changes: DataFrame, width: int | None) -> DataFrame:
    """Inside a stretch the numbers count from its start; what came before it is added where no heavier change did since."""
    stretch = F.lit(0) if width is None else F.expr(f"seq div {width}")
    cut = changes.select(
        "*", stretch.alias("_stretch"), *[F.col("change").isin(*names).cast("long").alias(c) for c, names in _LEVELS.items()]
    )
    keys = [*TABLE, "_stretch"]
    local = _since(cut, keys)
    ends = local.groupBy(*keys).agg(
        F.max("_m").alias("m"),
        F.max(F.struct("_m", "_r")).alias("_mr"),
        F.max(F.struct("_m", "_r", "_a")).alias("_mra"),
    )
    ends = ends.select(*keys, "m", F.col("_mr._r").alias("r"), F.col("_mra._a").alias("a"),
                       (F.col("m") > 0).cast("long").alias("_had_m"), ((F.col("m") > 0) | (F.col("_mr._r") > 0)).cast("long").alias("_had_r"))
    line = Window.partitionBy(*TABLE).orderBy("_stretch")
    ends = ends.select("*", F.sum("_had_m").over(line).alias("_gm"), F.sum("_had_r").over(line).alias("_gr"))
    ends = ends.select(
        *keys,
        F.sum("m").over(line).alias("m"),
        F.sum("r").over(Window.partitionBy(*TABLE, "_gm").orderBy("_stretch")).alias("r"),
        F.sum("a").over(Window.partitionBy(*TABLE, "_gr").orderBy("_stretch")).alias("a"),
    )
    before = ends.select(*keys, *[F.coalesce(F.lag(c).over(line), F.lit(0)).alias(f"_off{c}") for c in "mra"])
    joined = local.alias("l").join(before.alias("b"), [F.col(f"l.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    m, r, a = F.col("_m"), F.col("_r"), F.col("_a")
    # the first schema may be a state, whose seq says nothing
    version = F.when(F.col("change") == "first", "1-0-0").otherwise(F.concat_ws(
        "-",
        (F.lit(1) + F.col("_offm") + m).cast("string"),
        F.when(m > 0, r).otherwise(F.col("_offr") + r).cast("string"),
        F.when((m > 0) | (r > 0), a).otherwise(F.col("_offa") + a).cast("string"),
    ))
    return joined.select(*[version.alias(c) if c == "version" else F.col(f"l.{c}") for c in VERSION_COLUMNS])


_LEVELS = {"_model": ("model",), "_revision": ("revision",), "_addition": ("addition",)}


def _since(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Running counts of each level since the last change of a heavier one."""

    def count(level: str, *more: str) -> Column:
        return F.sum(level).over(Window.partitionBy(*keys, *more).orderBy("seq", "column_fingerprint"))

    rows = rows.withColumn("_m", count("_model"))
    rows = rows.withColumn("_r", count("_revision", "_m"))
    return rows.withColumn("_a", count("_addition", "_m", "_r"))
