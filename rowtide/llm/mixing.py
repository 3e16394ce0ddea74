"""Mix sources to target weights along a curriculum.

Each source has a weight schedule over training time 0..1. Its integral says how many of the source's target words
are due by any time. The words of a source form one sequence, its documents in a fixed pseudo-random order, then the
same order again for repeats; inverting the integral at the place where a document begins gives its training
position, by which the mix is range-sorted.

A source may hold any part of the rows: running sums are taken inside ``SLICES`` slices of a source's order, and the
slices are joined by their totals, so no task sorts a whole source.

Null texts have size 0 and take nothing; null sources form one source, which comes last; rows with one id are
ordered by size; equal rows are interchangeable. Columns of the input named like the results are replaced. A table
without words takes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtide.llm.common import BLANKS, table

#: Weights of the sources by rank, the total to share as a part of all words, and the most a source gives.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: How a source's weight changes over time, by rank: from (1 - x) times its mean at the start to (1 + x) at the end.
RAMPS = (0.5, 0.0, -0.5)
#: Hexadecimal digits of the order key that name a slice.
SLICE_DIGITS = 3
SLICES = 16**SLICE_DIGITS

RESULTS = ("size", "source_size", "target", "taken", "position")


def size_of(text: Column) -> Column:
    """Words of a text: those that start it, and those after blanks."""
    words = F.size(F.split(F.rtrim(F.concat(F.lit("x"), F.regexp_replace(text, f"[{BLANKS}]+", " "))), " "))
    first = F.when(text.rlike(rf"\A[^{BLANKS}]"), 0).otherwise(1)
    return F.coalesce((words - first).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: Sequence[int], ramps: Sequence[float], share: float, most: int) -> DataFrame:
    """(source, source_size, target, ramp) of (source, source_size).

    With the level at which capped sources have given their excess away, a target is the smaller of the cap and
    level times weight. Sources are ordered by cap over weight; the level is the largest that any cut of that order
    between capped and free sources gives. The table has a row per source, so its windows are not partitioned.
    """

    def cyclic(values: Sequence[float]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (F.col("rank") % len(values) + 1).cast("int"))

    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumns({"weight": cyclic(weights), "ramp": cyclic(ramps), "cap": most * F.col("source_size")})
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    free = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    levels = ranked.withColumn("level", free / F.sum("weight").over(rest))
    level = F.max("level").over(everything)
    target = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"), "ramp")


def assign(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    ramps: Sequence[float] = RAMPS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with size, source_size, target, taken and parts.

    ``taken`` counts the words that the mix takes of a row, repeats included; ``parts`` is an array of
    (pass, words, position), one for each pass that takes words of the row. The last document that a source needs may
    be cut, so that a source takes its target rounded to whole words.
    """
    docs = docs.drop(*RESULTS, "parts")
    key = F.md5(F.concat(F.lit("mix:"), F.col("doc_id").cast("string")))
    docs = docs.withColumns({"size": size_of(F.col("text")), "_key": F.coalesce(key, F.lit("0" * 32))})
    docs = docs.withColumn("_slice", F.substring("_key", 1, SLICE_DIGITS))

    slices = docs.groupBy("source", "_slice").agg(F.sum("size").alias("in_slice"))
    earlier = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("ahead", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)))
    by_source = slices.groupBy("source").agg(F.sum("in_slice").alias("source_size"))
    goals = targets(by_source, weights, ramps, share, most)
    goals = slices.join(goals.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    goals = goals.select("name", F.col("_slice").alias("slice"), "ahead", "source_size", "target", "ramp")

    same = F.col("source").eqNullSafe(F.col("name")) & (F.col("_slice") == F.col("slice"))
    within = Window.partitionBy("source", "_slice").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.join(goals, same).drop("name", "slice")
    placed = placed.withColumn("_start", F.col("ahead") + F.coalesce(F.sum("size").over(within), F.lit(0)))

    goal = F.round("target").cast("long")

    def part(n: int) -> Column:
        start = F.col("_start") + n * F.col("source_size")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), goal - start))
        # words due by time t: target * (ramp * t^2 + (1 - ramp) * t)
        due, slow = start / F.greatest(F.lit(1).cast("long"), goal), 1 - F.col("ramp")
        position = 2 * due / (slow + F.sqrt(slow * slow + 4 * F.col("ramp") * due))
        return F.struct(
            F.lit(n).alias("pass"), words.alias("words"), F.when(words > 0, F.coalesce(position, F.lit(0.0))).alias("position")
        )

    parts = F.filter(F.array(*(part(n) for n in range(most))), lambda p: p["words"] > 0)
    placed = placed.withColumn("parts", parts)
    taken = F.aggregate("parts", F.lit(0).cast("long"), lambda total, p: total + p["words"])
    return placed.withColumn("taken", taken).drop("_key", "_slice", "_start", "ahead", "ramp")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row of ``docs`` for each time it is taken, in training order, with its ``position``.

    Of a document that is cut, ``text`` keeps the words taken, joined by single spaces, and ``n_chars`` their length.
    """
    columns = [c for c in docs.columns if c != "position"]
    taken = assign(docs, **options).select(*columns, "size", F.explode("parts").alias("part"))
    cut = F.col("part.words") < F.col("size")
    words = F.filter(F.split("text", f"[{BLANKS}]+"), lambda w: w != "")
    text = F.when(cut, F.array_join(F.slice(words, F.lit(1), F.col("part.words").cast("int")), " ")).otherwise(F.col("text"))
    out = {"text": text}
    if "n_chars" in columns:
        out["n_chars"] = F.when(cut, F.char_length(text).cast("long")).otherwise(F.col("n_chars"))
    return taken.withColumns(out).select(*columns, F.col("part.position").alias("position")).orderBy("position", "doc_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    placed = assign(docs).withColumn("position", F.get("parts", F.lit(0))["position"])
    return placed.select("doc_id", "size", "source_size", "target", "taken", "position").orderBy("position", "doc_id")


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source
), ranked AS (
  SELECT source, source_size, rank, [3, 1, 2][rank % 3 + 1] AS weight, [0.5, 0.0, -0.5][rank % 3 + 1]::DOUBLE AS ramp,
    2 * source_size AS cap FROM sources
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked WINDOW o AS (ORDER BY cap / weight, rank)
), goals AS (
  SELECT source, source_size, ramp, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM levels
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.ramp, round(g.target)::BIGINT AS goal,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('mix:' || s.doc_id), s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), parts AS (
  SELECT *, greatest(0, least(size, goal - start)) AS first, greatest(0, least(size, goal - start - source_size)) AS second,
    start / greatest(1, goal)::DOUBLE AS due FROM placed
)
SELECT doc_id, size, source_size, target, (first + second)::BIGINT AS taken,
  CASE WHEN first > 0 THEN 2 * due / ((1 - ramp) + sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * due)) END AS position
FROM parts
"""
