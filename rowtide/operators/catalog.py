"""Assembly of catalog rows into one row per table.

Input frames (``rowtide.sources.catalog``): columns, identities, enum labels, primary-key columns
and unique-index columns. A table has at most 1,600 columns in the database itself, which bounds
every list collected here.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE = ("table_schema", "table_name")


class Catalog(NamedTuple):
    columns: DataFrame  # table_schema, table_name, name, ordinal, is_nullable, data_type, udt_name, char_max_len
    identities: DataFrame  # table_schema, table_name, relreplident
    enums: DataFrame  # enum_type, label, sort_order
    primary_keys: DataFrame  # table_schema, table_name, column, key_seq
    unique_indexes: DataFrame  # table_schema, table_name, index_name, column, key_seq


def in_order(value: Column, *order: Column) -> Column:
    """Aggregate: the values of a group as an array, sorted by ``order``."""
    keys = [o.alias(f"o{i}") for i, o in enumerate(order)]
    rows = F.array_sort(F.collect_list(F.struct(*keys, value.alias("v"))))
    return F.transform(rows, lambda r: r["v"])


def table_universe(cat: Catalog) -> DataFrame:
    """Every table that has a column or an identity row."""
    return cat.columns.select(*TABLE).union(cat.identities.select(*TABLE)).distinct()


def enum_labels(enums: DataFrame) -> DataFrame:
    labels = in_order(F.col("label"), F.col("sort_order"))
    return enums.groupBy(F.col("enum_type").alias("udt_name")).agg(labels.alias("enum_labels"))


def columns_with_enums(cat: Catalog) -> DataFrame:
    """Columns plus the ordered labels of their type, for user-defined types only.

    Only those columns are joined: the rest, gathered on a few built-in type names, would make hot keys.
    """
    custom = F.col("data_type") == "USER-DEFINED"
    kept = [*cat.columns.columns, "enum_labels"]
    stitched = cat.columns.where(custom).join(enum_labels(cat.enums), "udt_name", "left").select(*kept)
    none = F.lit(None).cast("array<string>").alias("enum_labels")
    return stitched.unionByName(cat.columns.where(~F.coalesce(custom, F.lit(False))).select("*", none))


def primary_key_columns(cat: Catalog) -> DataFrame:
    key = in_order(F.col("column"), F.col("key_seq"))
    return cat.primary_keys.groupBy(*TABLE).agg(key.alias("primary_key"))


def unique_index_columns(cat: Catalog) -> DataFrame:
    """Unique indexes of a table: lists of columns, by index name, each in key order."""
    per_index = cat.unique_indexes.groupBy(*TABLE, "index_name").agg(
        in_order(F.col("column"), F.col("key_seq")).alias("cols")
    )
    return per_index.groupBy(*TABLE).agg(in_order(F.col("cols"), F.col("index_name")).alias("unique_indexes"))


def replica_identity(code: Column) -> Column:
    # Identity codes of the database catalog.
    return (
        F.when(code == "f", "FULL")
        .when(code == "d", "DEFAULT")
        .when(code == "n", "NOTHING")
        .when(code == "i", "INDEX")
        .otherwise("UNKNOWN")
    )


def assemble_catalog(cat: Catalog) -> DataFrame:
    """One row per table: ``replica_identity, columns, primary_key, unique_indexes``."""
    fields = ("name", "ordinal", "is_nullable", "data_type", "udt_name", "char_max_len", "enum_labels")
    columns = (
        columns_with_enums(cat)
        .groupBy(*TABLE)
        .agg(in_order(F.struct(*fields), F.col("ordinal")).alias("columns"))
    )
    no_columns = F.array().cast(columns.schema["columns"].dataType)
    identities = cat.identities.groupBy(*TABLE).agg(F.max("relreplident").alias("code"))
    empty = F.array().cast("array<string>")
    return (
        columns.join(identities, list(TABLE), "full_outer")
        .join(primary_key_columns(cat), list(TABLE), "left")
        .join(unique_index_columns(cat), list(TABLE), "left")
        .select(
            *TABLE,
            replica_identity(F.col("code")).alias("replica_identity"),
            F.coalesce("columns", no_columns).alias("columns"),
            F.coalesce("primary_key", empty).alias("primary_key"),
            F.coalesce("unique_indexes", F.array().cast("array<array<string>>")).alias("unique_indexes"),
        )
    )


def missing_tables(requested: DataFrame, cat: Catalog) -> DataFrame:
    """Requested tables the catalog does not have."""
    return requested.select(*TABLE).distinct().join(table_universe(cat), list(TABLE), "left_anti")
