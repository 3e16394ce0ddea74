"""A catalog from the cells themselves, for envelopes that carry no schema blocks.

What a cell shows is a set of kinds, a bit for each, and sets are merged by or: in any order, over any cut, and over
batches, with the same result. Only the merged set is read as a database type: numbers widen to the widest among them,
scalars that have nothing in common to text, anything with an object or an array beside something else to jsonb. Where kinds
don't widen into each other the column names them as its conflict.

Cells are folded by one hash aggregate with a buffer of fixed size, inside the tasks first, so a table with any share of
the changes sends one row for each task and column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.schema_change import TABLE

# Kind, the variant's type it is told by, data_type and udt_name. The place is the bit.
KINDS = (
    ("bigint", "BIGINT", "bigint", "int8"),
    ("numeric", "DECIMAL", "numeric", "numeric"),
    ("double", "DOUBLE", "double precision", "float8"),
    ("boolean", "BOOLEAN", "boolean", "bool"),
    ("text", "STRING", "text", "text"),
    ("object", "OBJECT", "jsonb", "jsonb"),
    ("array", "ARRAY", "ARRAY", "_"),
    ("other", "", "text", "text"),
)
_BIT = {k[0]: 1 << i for i, k in enumerate(KINDS)}
_NUMBERS = _BIT["bigint"] | _BIT["numeric"] | _BIT["double"]


def cell_kinds(parsed: DataFrame, without_blocks: bool = False) -> DataFrame:
    """(table_schema, table_name, name, kinds, items, place, cells, rows): what the cells of each column showed.

    ``kinds`` has the bits of the values, ``items`` those of the elements of arrays, ``place`` the first position in a row,
    ``cells`` the values that are not null. A row of its own without ``name`` has the number of images as ``cells``. Rows
    of several calls can be merged by ``merge_kinds``. ``without_blocks`` takes the envelopes without schema block only.

    Row images are the ``after`` ones: those before a change may hold the key alone.
    """
    rows = parsed.where(F.col("after").isNotNull())
    if without_blocks:
        rows = rows.where(F.col("columns").isNull())
    image = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value")))
    cells = rows.select(*TABLE, F.posexplode(F.concat(image, F.map_entries("after"))).alias("place", "c"))
    cells = cells.select(*TABLE, "place", F.col("c.key").alias("name"), F.schema_of_variant("c.value").alias("type"))
    shown = F.when(F.col("type") == "VOID", 0).otherwise(_bits(F.col("type")))
    inner = F.regexp_extract("type", r"^ARRAY<(.*)>$", 1)
    items = F.when(~F.col("type").startswith("ARRAY<") | inner.isin("VOID", ""), 0).otherwise(_bits(inner))
    full = F.coalesce(F.col("type") != "VOID", F.col("name").isNull())
    return cells.groupBy(*TABLE, "name").agg(
        F.bit_or(shown).alias("kinds"), F.bit_or(items).alias("items"), F.min("place").alias("place"), F.count_if(full).alias("cells")
    )


def merge_kinds(kinds: DataFrame) -> DataFrame:
    """Rows of ``cell_kinds`` of several batches as those of all of them."""
    return kinds.groupBy(*TABLE, "name").agg(
        F.bit_or("kinds").alias("kinds"), F.bit_or("items").alias("items"), F.min("place").alias("place"), F.sum("cells").alias("cells")
    )


def landed_columns(kinds: DataFrame) -> DataFrame:
    """Catalog columns, as ``observed_columns`` gives them, and ``conflict``: kinds that don't widen into each other.

    A column is nullable if some image lacks it or has null there. Columns come in the order in which rows show them, by
    name where this is the same. A column that was never filled has the type ``unknown``. JSON tells no widths: all whole
    numbers are bigint, and text stays text whatever it holds.
    """
    one = F.struct("place", "name", "kinds", "items", "cells")
    tables = kinds.groupBy(*TABLE).agg(
        F.array_sort(F.collect_list(F.when(F.col("name").isNotNull(), one))).alias("found"),
        F.sum(F.when(F.col("name").isNull(), F.col("cells"))).alias("images"),
    )
    found = tables.select(*TABLE, "images", F.posexplode("found").alias("at", "c"))
    kinds, items = F.col("c.kinds"), F.col("c.items")
    return found.select(
        *TABLE,
        F.col("c.name").alias("name"),
        (F.col("at") + 1).alias("ordinal"),
        (F.col("c.cells") < F.col("images")).alias("is_nullable"),
        _type(kinds, 2).alias("data_type"),
        F.when(kinds == _BIT["array"], F.concat(F.lit("_"), _type(items, 3))).otherwise(_type(kinds, 3)).alias("udt_name"),
        F.lit(None).cast("int").alias("char_max_len"),
        F.when(_conflict(kinds), _names(kinds))
        .when((kinds == _BIT["array"]) & _conflict(items), F.concat(F.lit("array of "), _names(items)))
        .alias("conflict"),
    )


def _bits(kind: Column) -> Column:
    out = F
    for name, begin, *_ in KINDS:
        if begin:
            out = out.when(kind.startswith(begin) | (kind.startswith("FLOAT") if name == "double" else F.lit(False)), _BIT[name])
    return out.otherwise(_BIT["other"])


def _has(kinds: Column, bits: int) -> Column:
    return kinds.bitwiseAND(F.lit(bits)) != 0


def _only(kinds: Column, bits: int) -> Column:
    return kinds.bitwiseAND(F.lit(~bits)) == 0


def _conflict(kinds: Column) -> Column:
    return (F.bit_count(kinds) > 1) & ~_only(kinds, _NUMBERS)


def _type(kinds: Column, which: int) -> Column:
    row = {k[0]: k[which] for k in KINDS}
    out = F.when(kinds == 0, "unknown")
    for name in ("double", "numeric", "bigint"):
        out = out.when(_only(kinds, _NUMBERS) & _has(kinds, _BIT[name]), row[name])
    for name in ("boolean", "object", "array"):
        out = out.when(kinds == _BIT[name], row[name])
    return out.when(_has(kinds, _BIT["object"] | _BIT["array"]), row["object"]).otherwise(row["text"])


def _names(kinds: Column) -> Column:
    return F.concat_ws("|", *[F.when(_has(kinds, bit), name) for name, bit in _BIT.items()])
