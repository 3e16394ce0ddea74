"""A fleet of database tables and their contracts, derived from the ``part`` table.

Every part is one database table, so catalogs and contracts grow with the data. Which columns a
table has, and where its contract departs from them, is arithmetic on the part key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.catalog import Catalog
from rowtide.plans.feeds import table
from rowtide.sources.catalog import catalog_of

K = "p_partkey"


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part")


def _schema_name(k: Column) -> Column:
    return F.when(k % 3 == 0, "public").when(k % 3 == 1, "sales").otherwise("ops")


def _table_name(k: Column) -> Column:
    return F.concat(F.lit("t_"), k.cast("string"))


def _in_catalog(k: Column) -> Column:
    return (k % 41 != 40) & (k % 29 != 28)


def fleet_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col(K)
    yes, no = F.lit(True), F.lit(False)
    none = F.lit(None).cast("int")
    enum_type = F.when(k % 2 == 0, "brand_enum").otherwise("type_enum")
    tags = F.when(k % 6 == 0, "_text").otherwise("_point")
    columns = [
        (yes, "id", no, "bigint", "int8", none),
        (yes, "name", k % 2 == 0, "text", "text", none),
        (k % 3 == 0, "status", k % 4 == 0, "USER-DEFINED", enum_type, none),
        (k % 4 == 1, "sku", yes, "character varying", "varchar", F.col("p_size") + 16),
        (k % 5 < 3, "amount", no, "numeric", "numeric", none),
        (k % 3 == 0, "tags", k % 2 == 0, "ARRAY", tags, none),
        (k % 7 == 2, "meta", yes, "jsonb", "jsonb", none),
        (yes, "created_at", no, "timestamp with time zone", "timestamptz", none),
        (k % 8 == 5, "location", yes, "point", "point", none),
        (k % 9 == 4, "ratio", yes, "double precision", "float8", none),
        (k % 10 == 1, "flag", no, "boolean", "bool", none),
        (k % 11 == 3, "birth", yes, "date", "date", none),
        (k % 12 == 2, "uid", no, "uuid", "uuid", none),
        (k % 13 == 1, "code", yes, "character", "bpchar", F.lit(3)),
    ]
    text = lambda v: v if isinstance(v, Column) else F.lit(v)
    rows = [
        F.when(
            there,
            F.struct(
                F.lit(name).alias("name"),
                F.lit(i).alias("ordinal"),
                nullable.alias("is_nullable"),
                F.lit(kind).alias("data_type"),
                text(udt).alias("udt_name"),
                longest.alias("char_max_len"),
            ),
        )
        for i, (there, name, nullable, kind, udt, longest) in enumerate(columns, 1)
    ]
    return (
        _part(spark, sf_dir)
        .where(_in_catalog(k))
        .select(
            _schema_name(k).alias("table_schema"),
            _table_name(k).alias("table_name"),
            F.inline(F.array_compact(F.array(*rows))),
        )
    )


def fleet_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col(K)
    code = (
        F.when(k % 53 == 52, "x").when(k % 5 < 2, "f").when(k % 5 == 2, "d").when(k % 5 == 3, "n").otherwise("i")
    )
    rows = _part(spark, sf_dir).where((k % 37 != 36) & (k % 29 != 28))
    return rows.select(
        _schema_name(k).alias("table_schema"), _table_name(k).alias("table_name"), code.alias("relreplident")
    )


def fleet_enums(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _part(spark, sf_dir)
    brands = p.groupBy(F.col("p_brand").alias("label")).agg(
        F.first(F.substring("p_brand", 7, 9).cast("float")).alias("sort_order")
    )
    types = p.groupBy(F.col("p_type").alias("label")).agg(F.min(K).cast("float").alias("sort_order"))
    return brands.select(F.lit("brand_enum").alias("enum_type"), "*").union(
        types.select(F.lit("type_enum").alias("enum_type"), "*")
    )


def fleet_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col(K)

    def index(there: Column, name: str, primary: bool, unique: bool, key: Column) -> Column:
        return F.when(
            there,
            F.struct(
                F.lit(name).alias("index_name"),
                F.lit(primary).alias("is_primary"),
                F.lit(unique).alias("is_unique"),
                key.alias("indkey"),
            ),
        )

    key = lambda *n: F.array(*[F.lit(i) for i in n])
    rows = [
        index(k % 4 != 3, "pkey", True, True, F.when(k % 10 == 7, key(8, 1)).otherwise(key(1))),
        index((k % 6).isin(0, 1, 3), "u_b", False, True, key(2)),
        index((k % 12).isin(0, 3), "u_a", False, True, key(8, 1)),
        index(k % 9 == 0, "u_expr", False, True, key(0, 2)),
        index(k % 5 == 0, "ix", False, False, key(2)),
    ]
    return (
        _part(spark, sf_dir)
        .where(_in_catalog(k))
        .select(
            _schema_name(k).alias("table_schema"),
            _table_name(k).alias("table_name"),
            F.inline(F.array_compact(F.array(*rows))),
        )
    )


def fleet_catalog(spark: SparkSession, sf_dir: str, wanted: DataFrame | None = None) -> Catalog:
    columns = fleet_columns(spark, sf_dir)
    attributes = columns.select("table_schema", "table_name", F.col("name").alias("column"), F.col("ordinal").alias("attnum"))
    return catalog_of(
        columns,
        fleet_identities(spark, sf_dir),
        fleet_enums(spark, sf_dir),
        attributes,
        fleet_indexes(spark, sf_dir),
        wanted,
    )


def fleet_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables somebody asks for: the even ones of the fleet, some of which do not exist."""
    k = F.col(K)
    return _part(spark, sf_dir).where(k % 2 == 0).select(
        _schema_name(k).alias("table_schema"), _table_name(k).alias("table_name")
    )


def fleet_contract(spark: SparkSession, sf_dir: str, defects: bool = False) -> DataFrame:
    """Contracts of ten tables each. With ``defects`` they break the lint rules here and there."""
    k = F.col(K)
    never = F.lit(False)
    bad = (lambda test: test) if defects else (lambda test: never)
    chain_type = "array<struct<name:string,pattern:string,grp:int,replacement:string>>"

    def chain(*names: str) -> Column:
        none = F.lit(None)
        steps = [
            F.struct(
                F.lit(n).alias("name"), none.cast("string").alias("pattern"),
                none.cast("int").alias("grp"), none.cast("string").alias("replacement"),
            )
            for n in names
        ]
        return F.array(*steps).cast(chain_type)

    bare = F.array().cast(chain_type)
    none = F.lit(None).cast("string")
    columns = [
        (F.lit(True), F.lit("id"), none, never, F.when(bad(k % 14 == 6), chain("trim")).otherwise(bare)),
        (
            F.lit(True), F.lit("name"), F.when(k % 4 == 2, "fullName"), bad(k % 15 == 4),
            F.when(k % 3 == 1, chain("trim", "lowercase")).otherwise(bare),
        ),
        (k % 3 == 0, F.when(k % 6 == 0, "statuss").otherwise("status"), none, never, bare),
        (k % 5 < 2, F.lit("amount"), none, never, F.when(k % 5 == 0, chain("lowercase")).otherwise(bare)),
        (
            k % 7 != 0, F.lit("created_at"), F.when(bad(k % 13 == 5), "id"), never,
            F.when(k % 35 == 1, chain("uppercase")).otherwise(bare),
        ),
        (k % 11 == 0, F.lit("missing_col"), none, k % 22 == 0, bare),
        (k % 17 == 0, F.lit("nmae"), none, never, bare),
        (k % 8 == 1, F.lit("sku"), none, never, chain("trim")),
    ]
    rows = [
        F.when(
            there & ~bad(k % 43 == 2),
            F.struct(
                F.lit(i).alias("col_pos"),
                name.alias("column"),
                rename.alias("rename"),
                F.coalesce(rename, name).alias("output_name"),
                (exclude | bad(k % 47 == 3)).alias("exclude"),
                transforms.alias("transforms"),
            ),
        )
        for i, (there, name, rename, exclude, transforms) in enumerate(columns)
    ]
    named = k - F.when(bad(k % 20 == 9), 1).otherwise(0)
    return _part(spark, sf_dir).select(
        F.concat(F.lit("svc_"), F.floor(k / 10).cast("string")).alias("contract_id"),
        (k % 10).cast("int").alias("table_pos"),
        F.when(bad(k % 37 == 1), "  ").otherwise(_schema_name(named)).alias("table_schema"),
        F.when(bad(k % 31 == 30), "").otherwise(_table_name(named)).alias("table_name"),
        F.when(bad(k % 23 == 1), "iglu:com.acme/t/jsonschema/1-0")
        .otherwise(F.concat(F.lit("iglu:com.acme/"), _table_name(named), F.lit("_change/jsonschema/1-0-0")))
        .alias("schema_uri"),
        F.when(bad(k % 19 == 18), F.array().cast("array<string>")).otherwise(F.array(F.lit("id"))).alias("primary_key"),
        none.alias("app_id"),
        F.inline_outer(F.array_compact(F.array(*rows))),
    )
