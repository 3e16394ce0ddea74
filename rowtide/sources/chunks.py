"""A snapshot taken in chunks while changes go on.

A table is read by ranges of its key. For each range the log position is noted before and after the read. A row of the
range stands for the table as of the position after the read, unless the log has a change of its key between the two: then
nobody knows which came first, and the row gives way, as the change tells the state of that key by itself. So every
interleaving of reads and changes ends in the last state of each row, and no read has to hold a lock.

All is joins by key: chunks are told by arithmetic, and no range is brought to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.envelope import cell
from rowtide.sources.feed import snapshot_feed


def key_place(keys: Sequence[Column], by_hash: bool = False) -> Column:
    """The place of a key on a line of whole numbers: a single whole-number key itself, else a hash of the keys' texts."""
    texts = [k.cast("string") for k in keys]
    return F.shiftright(F.xxhash64(*texts), 1) if by_hash else texts[0].try_cast("bigint")


def chunk_of(place: Column, width: int) -> Column:
    """Number of the chunk [n * width, (n + 1) * width)."""
    return F.call_function("div", place - F.pmod(place, F.lit(width)), F.lit(width).cast("bigint"))


def chunk_width(table: DataFrame, primary_key: Sequence[str], rows: int, by_hash: bool = False) -> int:
    """A width that gives chunks of about so many rows, from the ends of the key and the number of rows."""
    place = key_place([F.col(k) for k in primary_key], by_hash)
    least, most, count = table.agg(F.min(place), F.max(place), F.count(place)).first()
    return max(1, -(-(most - least + 1) * rows // count)) if count else 1


def change_keys(parsed: DataFrame, primary_key: Sequence[str]) -> DataFrame:
    """(the key's columns as text, lsn_num) of parsed changes: from the message key, else from the row images."""
    message = F.try_parse_json("key")

    def text(name: str) -> Column:
        of_key = [F.try_variant_get(message, f"${p}['{name}']", "string") for p in (".payload", "")]
        of_row = [F.try_variant_get(cell(F.col(image), name), "$", "string") for image in ("after", "before")]
        return F.coalesce(*of_key, *of_row)

    return parsed.select(*[text(k).alias(k) for k in primary_key], "lsn_num")


def settled(
    rows: DataFrame, changes: DataFrame, chunks: DataFrame, primary_key: Sequence[str], width: int, by_hash: bool = False
) -> DataFrame:
    """``rows`` that no change makes way for, with ``_high``, the position they stand for.

    ``chunks`` is (chunk, low, high), one row for each range that was read; ``changes`` is what ``change_keys`` gives, of
    this table. Rows of a range that is not there were not read yet and are left out. Changes without a position
    are before the log and touch nothing. A row without a key is never changed, so it stays if its key has a place at all.
    A range that was read again has its last read in ``chunks``.
    """
    keys = list(primary_key)
    chunk = chunk_of(key_place([F.col(k) for k in keys], by_hash), width)
    read = rows.withColumn("_chunk", chunk).join(chunks.selectExpr("chunk _chunk", "low _low", "high _high"), "_chunk")
    moved = changes.where(F.col("lsn_num").isNotNull()).withColumn("_chunk", chunk)
    moved = moved.join(chunks.selectExpr("chunk _chunk", "low _low", "high _high"), "_chunk")
    moved = moved.where((F.col("lsn_num") > F.col("_low")) & (F.col("lsn_num") <= F.col("_high")))
    moved = moved.select(*[F.col(k).cast("string").alias(f"_key{i}") for i, k in enumerate(keys)]).distinct()
    same = [F.col(k).cast("string") == F.col(f"_key{i}") for i, k in enumerate(keys)]
    return read.join(moved, same, "left_anti").drop("_chunk", "_low")


def chunked_snapshot(
    rows: DataFrame,
    parsed: DataFrame,
    chunks: DataFrame,
    *,
    db: str,
    schema: str,
    name: str,
    primary_key: Sequence[str],
    width: int,
    by_hash: bool = False,
    **options,
) -> DataFrame:
    """The rows of a table that was read in chunks as records to stand beside its changes, ``parsed``, in a feed.

    Their log position and ``seq`` are those after the read of their chunk, the same on every run; the changes go by their
    log position as well, see ``commit_order``.
    """
    mine = parsed.where((F.col("table_schema") == schema) & (F.col("table_name") == name))
    kept = settled(rows, change_keys(mine, primary_key), chunks, primary_key, width, by_hash)
    high = F.col("_high")
    return snapshot_feed(
        kept, db=db, schema=schema, name=name, primary_key=primary_key, lsn=high, seq=high, leave_out=("_high",), **options
    )
