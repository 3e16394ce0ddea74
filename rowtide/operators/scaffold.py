"""Starter artefacts from a catalog: JSON Schemas and contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.catalog import TABLE, Catalog, assemble_catalog, columns_with_enums, in_order, table_universe

# Database types and their JSON Schema type and format.
JSON_TYPES = {
    "int2": ("integer", None),
    "int4": ("integer", None),
    "int8": ("integer", None),
    "numeric": ("string", None),
    "float4": ("number", None),
    "float8": ("number", None),
    "bool": ("boolean", None),
    "text": ("string", None),
    "varchar": ("string", None),
    "bpchar": ("string", None),
    "timestamp": ("string", "date-time"),
    "timestamptz": ("string", "date-time"),
    "date": ("string", "date"),
    "uuid": ("string", "uuid"),
}


def _mapped(udt: Column, which: int) -> Column:
    out = F
    for name, spec in JSON_TYPES.items():
        if spec[which] is not None:
            out = out.when(udt == name, F.lit(spec[which]))
    return out.otherwise(F.lit(None).cast("string"))


def json_form(udt: Column) -> tuple[Column, Column]:
    """JSON Schema type and format of a database type, null if there is none."""
    return _mapped(udt, 0), _mapped(udt, 1)


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _object(*members: tuple[str, Column]) -> Column:
    """JSON text of an object from JSON texts; a null member is left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in members]), F.lit("}"))


def json_type(columns: DataFrame) -> DataFrame:
    """Adds ``fragment``, the JSON Schema of the column, and ``unmapped``, its type if there is none."""
    udt, kind, nullable = F.col("udt_name"), F.col("data_type"), F.col("is_nullable")

    def widened(t: Column) -> Column:
        return F.when(nullable, F.concat(F.lit("["), _quoted(t), F.lit(',"null"]'))).otherwise(_quoted(t))

    base, form = _mapped(udt, 0), _quoted(_mapped(udt, 1))
    longest = F.when(base == "string", F.col("char_max_len").cast("string"))
    scalar = _object(("type", widened(base)), ("format", form), ("maxLength", longest))

    labels = F.when(nullable, F.array_append("enum_labels", F.lit(None))).otherwise(F.col("enum_labels"))
    enum = _object(("type", widened(F.lit("string"))), ("enum", F.to_json(labels)))

    element = F.regexp_replace(udt, "^_", "")
    items = _object(("type", _quoted(_mapped(element, 0))), ("format", _quoted(_mapped(element, 1))))
    array = _object(("type", widened(F.lit("array"))), ("items", items))

    is_json = udt.isin("json", "jsonb")
    is_enum = (kind == "USER-DEFINED") & F.col("enum_labels").isNotNull()
    fragment = (
        F.when(is_json, F.lit("{}")).when(is_enum, enum).when(kind == "ARRAY", array)
        .when(base.isNull(), F.lit("{}")).otherwise(scalar)
    )
    unmapped = F.when(~is_json & ~is_enum & (kind != "ARRAY") & base.isNull(), udt)
    return columns.select("*", fragment.alias("fragment"), unmapped.alias("unmapped"))


def schema_uri(vendor: str) -> Column:
    return F.concat(F.lit(f"iglu:{vendor}/"), F.col("table_name"), F.lit("_change/jsonschema/1-0-0"))


def json_schemas(
    cat: Catalog, vendor: str, meta_schema: str = "http://json-schema.org/draft-04/schema#"
) -> DataFrame:
    """One self-describing JSON Schema per table: ``path`` in a schema registry, and ``text``.

    ``meta_schema`` is the URI your registry expects in ``$schema``.
    """
    # Fixed value: the text of the description.
    note = F.concat(F.lit("unmapped Postgres type '"), F.col("unmapped"), F.lit("' — refine manually"))
    described = F.when(F.col("unmapped").isNotNull(), _object(("description", _json(note)))).otherwise(
        F.col("fragment")
    )
    typed = json_type(columns_with_enums(cat))
    per_column = typed.select(
        *TABLE, "ordinal", F.concat(_json(F.col("name")), F.lit(":"), described).alias("property"),
        F.when(~F.col("is_nullable"), _json(F.col("name"))).alias("needed"),
    )
    rows = per_column.groupBy(*TABLE).agg(
        in_order(F.col("property"), F.col("ordinal")).alias("properties"),
        in_order(F.col("needed"), F.col("ordinal")).alias("needed"),
    )
    rows = table_universe(cat).join(rows, list(TABLE), "left").select(
        *TABLE, *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("properties", "needed")]
    )
    listed = lambda c: F.concat(F.lit("["), c, F.lit("]"))
    needed = F.filter("needed", lambda n: n.isNotNull())
    row = _object(
        ("type", F.lit('["object","null"]')),
        ("properties", F.concat(F.lit("{"), F.array_join("properties", ","), F.lit("}"))),
        ("required", F.when(F.size(needed) > 0, listed(F.array_join(needed, ",")))),
    )
    about = F.concat(
        F.lit("Generated as a starting point for "), F.concat_ws(".", *TABLE),
        F.lit(". Review types and constraints before use. Arrays are described one level deep."),
    )
    identity = _object(
        ("vendor", F.lit(f'"{vendor}"')), ("name", _json(F.concat("table_name", F.lit("_change")))),
        ("format", F.lit('"jsonschema"')), ("version", F.lit('"1-0-0"')),
    )
    properties = _object(
        ("op", F.lit('{"type":"string","enum":["c","u","d","r"]}')), ("before", F.col("row")), ("after", F.col("row"))
    )
    document = _object(
        ("$schema", F.lit(f'"{meta_schema}"')), ("description", _json(about)), ("self", identity),
        ("type", F.lit('"object"')), ("properties", properties), ("required", F.lit('["op"]')),
        ("additionalProperties", F.lit("true")),
    )
    path = F.concat(F.lit(f"schemas/{vendor}/"), F.col("table_name"), F.lit("_change/jsonschema/1-0-0"))
    return rows.select(*TABLE, row.alias("row")).select(*TABLE, path.alias("path"), document.alias("text"))


def _json(c: Column) -> Column:
    """A string as a JSON string literal."""
    text = F.to_json(F.struct(c.alias("s")))
    return F.substring(text, F.lit(6), F.length(text) - 6)


def scaffold_contract(cat: Catalog, vendor: str, contract_id: str = "scaffold") -> DataFrame:
    """A starter contract: all columns bare, key from the primary index. Places of tables stay open."""
    tables = assemble_catalog(cat)
    outer = tables.select(*TABLE, "primary_key", F.posexplode_outer("columns").alias("col_pos", "c"))
    none = F.lit(None)
    chain = "array<struct<name:string,pattern:string,grp:int,replacement:string>>"
    return outer.select(
        F.lit(contract_id).alias("contract_id"),
        none.cast("int").alias("table_pos"),
        *TABLE,
        schema_uri(vendor).alias("schema_uri"),
        "primary_key",
        none.cast("string").alias("app_id"),
        "col_pos",
        F.col("c.name").alias("column"),
        none.cast("string").alias("rename"),
        F.col("c.name").alias("output_name"),
        F.when(F.col("c").isNotNull(), F.lit(False)).alias("exclude"),
        F.array().cast(chain).alias("transforms"),
    )


def pk_hints(cat: Catalog) -> DataFrame:
    """For tables without a primary key: the unique indexes that could serve, or what to do."""
    indexes = F.transform("unique_indexes", lambda i: F.concat(F.lit("("), F.array_join(i, ", "), F.lit(")")))
    # The texts of the hints.
    found = F.concat(F.lit("Candidate unique index(es): "), F.array_join(indexes, "; "), F.lit("."))
    hint = F.when(F.size("unique_indexes") > 0, found).otherwise(
        "No unique index found; add a surrogate key or exclude this table."
    )
    return assemble_catalog(cat).where(F.size("primary_key") == 0).select(*TABLE, hint.alias("hint"))
