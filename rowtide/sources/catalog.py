"""Catalog sources: a database over JDBC, extracts in files, or the feed itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.catalog import TABLE, Catalog
from rowtide.operators.control import _bounded

# Catalog queries for a PostgreSQL database. Index keys come as arrays and are unfolded in Spark.
_COLUMNS = """
select table_schema, table_name, column_name as name, ordinal_position as ordinal,
       is_nullable = 'YES' as is_nullable, data_type, udt_name, character_maximum_length as char_max_len
from information_schema.columns join information_schema.tables using (table_catalog, table_schema, table_name)
where table_type = 'BASE TABLE'"""
_IDENTITIES = """
select s.nspname as table_schema, t.relname as table_name, t.relreplident::text as relreplident
from pg_catalog.pg_class t join pg_catalog.pg_namespace s on s.oid = t.relnamespace where t.relkind in ('r', 'p')"""
_ENUMS = """
select typname as enum_type, enumlabel as label, enumsortorder as sort_order
from pg_catalog.pg_enum e join pg_catalog.pg_type y on y.oid = e.enumtypid"""
_ATTRIBUTES = """
select s.nspname as table_schema, t.relname as table_name, a.attname as column, a.attnum::int as attnum
from pg_catalog.pg_attribute a join pg_catalog.pg_class t on t.oid = a.attrelid
join pg_catalog.pg_namespace s on s.oid = t.relnamespace
where t.relkind in ('r', 'p') and a.attnum > 0"""
_INDEXES = """
select s.nspname as table_schema, t.relname as table_name, i.relname as index_name,
       x.indisprimary as is_primary, x.indisunique as is_unique, x.indkey::int2[]::int[] as indkey
from pg_catalog.pg_index x join pg_catalog.pg_class t on t.oid = x.indrelid
join pg_catalog.pg_class i on i.oid = x.indexrelid
join pg_catalog.pg_namespace s on s.oid = t.relnamespace where t.relkind in ('r', 'p')"""

# Tables named in one query; more are read by several, which run side by side.
TABLES_PER_QUERY = 500


def catalog_queries(name: str, tables: Sequence[tuple[str, str]] | None = None) -> list[str]:
    """The SQL that reads one catalog frame, for these tables only; ordinary and partitioned tables otherwise."""
    if tables is None or name == "enums":
        return [_QUERIES[name]]
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    columns = "table_schema, table_name" if name == "columns" else "s.nspname, t.relname"
    keys = [f"({quote(s)}, {quote(t)})" for s, t in sorted(set(tables))]
    chunks = [keys[i : i + TABLES_PER_QUERY] for i in range(0, len(keys), TABLES_PER_QUERY)]
    return [f"{_QUERIES[name]} and ({columns}) in ({', '.join(c)})" for c in chunks] or [f"{_QUERIES[name]} and false"]



def read_catalog(
    spark: SparkSession,
    *,
    jdbc: Mapping[str, str] | None = None,
    path: str | None = None,
    tables: Sequence[tuple[str, str]] | None = None,
) -> Catalog:
    """Catalog frames from JDBC options, or from a directory of parquet extracts.

    The database is asked for the ``tables`` only; extracts are narrowed to them here. A directory holds
    ``columns``, ``identities``, ``enums``, ``attributes`` and ``indexes``.
    """
    if jdbc is not None:
        one = lambda sql: spark.read.format("jdbc").options(**jdbc).option("query", sql).load()
        read = lambda name: reduce(DataFrame.unionByName, map(one, catalog_queries(name, tables)))
    else:
        read = lambda name: spark.read.parquet(f"{path}/{name}")
    frames = {name: read(name) for name in _QUERIES}
    wanted = None
    if tables is not None:
        keys = sorted(set(tables))
        rows = spark.createDataFrame(keys, "table_schema string, table_name string")
        wanted = _bounded(rows, len(keys))
    return catalog_of(
        frames["columns"], frames["identities"], frames["enums"], frames["attributes"], frames["indexes"], wanted
    )


_QUERIES = {
    "columns": _COLUMNS,
    "identities": _IDENTITIES,
    "enums": _ENUMS,
    "attributes": _ATTRIBUTES,
    "indexes": _INDEXES,
}


def catalog_of(
    columns: DataFrame,
    identities: DataFrame,
    enums: DataFrame,
    attributes: DataFrame,
    indexes: DataFrame,
    wanted: DataFrame | None = None,
) -> Catalog:
    """Catalog frames from raw extracts, narrowed to the ``wanted`` tables if given."""

    def narrow(df: DataFrame) -> DataFrame:
        return df if wanted is None else df.join(wanted, list(TABLE), "left_semi")

    columns, identities = narrow(columns), narrow(identities)
    attributes, indexes = narrow(attributes), narrow(indexes)
    custom = columns.where(F.col("data_type") == "USER-DEFINED").select(F.col("udt_name").alias("enum_type"))
    return Catalog(
        columns,
        identities,
        enums.join(custom.distinct(), "enum_type", "left_semi"),
        index_columns(indexes.where("is_primary"), attributes).drop("index_name"),
        index_columns(indexes.where("is_unique and not is_primary"), attributes),
    )


def index_columns(indexes: DataFrame, attributes: DataFrame) -> DataFrame:
    """Named columns of each index in key order; key parts that are expressions have no column.

    Attributes are unfolded rows of a scan: their size is guessed from the file, many times too small, and the planner
    would broadcast those of a whole fleet through the driver. Hence the hint.
    """
    parts = indexes.select(*TABLE, "index_name", F.posexplode("indkey").alias("pos", "attnum"))
    return parts.where("attnum <> 0").join(attributes.hint("merge"), [*TABLE, "attnum"]).select(
        *TABLE, "index_name", "column", (F.col("pos") + 1).alias("key_seq")
    )


def observed_columns(parsed: DataFrame) -> DataFrame:
    """Catalog columns as the feed shows them: those of the last schema block of each table.

    Lets drift run over a data lake with no database at hand. Records are first folded to one row per
    task, table and distinct block, so a busy table costs no more than a quiet one.
    """
    blocks = parsed.where(F.col("columns").isNotNull()).groupBy(*TABLE, "columns").agg(F.max("seq").alias("seq"))
    last = blocks.groupBy(*TABLE).agg(F.max_by("columns", "seq").alias("columns"))
    return last.select(*TABLE, F.posexplode("columns").alias("pos", "c")).select(
        *TABLE,
        F.coalesce("c.field", F.lit("")).alias("name"),
        (F.col("pos") + 1).alias("ordinal"),
        F.coalesce("c.optional", F.lit(True)).alias("is_nullable"),
        data_type(F.col("c.type"), F.col("c.name")).alias("data_type"),
        udt_name(F.col("c.type"), F.col("c.name")).alias("udt_name"),
        F.lit(None).cast("int").alias("char_max_len"),
    )


# Database types as (wire type, logical name prefix, data_type, udt_name), first match wins.
_WIRE_TYPES = (
    ("int32", "io.debezium.time.Date", "date", "date"),
    ("int64", "io.debezium.time.", "timestamp without time zone", "timestamp"),
    ("string", "io.debezium.time.Zoned", "timestamp with time zone", "timestamptz"),
    ("string", "io.debezium.data.Uuid", "uuid", "uuid"),
    ("string", "io.debezium.data.Json", "jsonb", "jsonb"),
    ("int16", "", "smallint", "int2"),
    ("int32", "", "integer", "int4"),
    ("int64", "", "bigint", "int8"),
    ("float", "", "real", "float4"),
    ("double", "", "double precision", "float8"),
    ("boolean", "", "boolean", "bool"),
    ("string", "", "text", "text"),
)


def _lookup(wire: Column, logical: Column, which: int) -> Column:
    out = F
    for row in _WIRE_TYPES:
        test = wire == row[0]
        if row[1]:
            test = test & F.coalesce(logical.startswith(row[1]), F.lit(False))
        out = out.when(test, row[which])
    return out.otherwise(wire)


def data_type(wire: Column, logical: Column) -> Column:
    return _lookup(wire, logical, 2)


def udt_name(wire: Column, logical: Column) -> Column:
    return _lookup(wire, logical, 3)
