"""Drift: what a contract says against what a catalog has.

Contracts are rows as in ``rowtide.contract.contract_df``; several contracts, told apart by
``contract_id``, are compared with the catalog in one job. Neither side is assumed small: the joins
carry no hint and are left to the adaptive planner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from rowtide.operators.catalog import TABLE, Catalog, in_order, replica_identity

# Column types a transform may apply to, and the distance of a suggestion.
STRING_TYPES = ("text", "character varying", "character")
SUGGEST_DISTANCE = 2

_NAMED = ["contract_id", *TABLE]


def assess(contract: DataFrame, cat: Catalog) -> DataFrame:
    """One row per configured table with everything that is to be found about it.

    Contract and catalog are each gathered to a row per table, at most as long as a table can have columns, and joined
    once; what is missing, extra or of another type is told inside the row. ``n_columns`` counts emitted columns;
    ``present`` is whether the catalog knows the table; ``missing``, ``mismatched`` and ``extra`` are arrays.
    """
    entry = F.struct("col_pos", "column", "exclude", F.col("transforms.name").alias("chain"))
    wanted = contract.groupBy(*_NAMED, "table_pos").agg(
        F.array_sort(F.collect_list(F.when(F.col("column").isNotNull(), entry))).alias("_want")
    )
    column = F.struct("ordinal", "name", "data_type")
    none = lambda kind: F.lit(None).cast(kind)
    kind = cat.columns.select(column.alias("c")).schema["c"].dataType
    rows = cat.columns.select(*TABLE, column.alias("c"), none("string").alias("code")).unionByName(
        cat.identities.select(*TABLE, F.lit(None).cast(kind).alias("c"), F.col("relreplident").cast("string").alias("code"))
    )
    known = rows.groupBy(*TABLE).agg(
        F.array_sort(F.collect_list("c")).alias("_have"), F.max("code").alias("code"), F.lit(True).alias("present")
    )
    joined = wanted.join(known, list(TABLE), "left").withColumns({
        "present": F.coalesce("present", F.lit(False)),
        "_have": F.coalesce("_have", F.array().cast(ArrayType(kind))),
    })
    names, want = F.col("_have.name"), F.col("_want.column")

    def mismatches(w: Column) -> Column:
        db_type = F.get(F.filter("_have", lambda c: c["name"] == w["column"]), F.lit(0))["data_type"]
        wrong = F.coalesce(~db_type.isin(*STRING_TYPES), F.lit(False))
        each = F.transform(w["chain"], lambda t: F.struct(w["column"].alias("column"), db_type.alias("db_type"), t.alias("transform_name")))
        return F.filter(each, lambda _: wrong)

    gone = F.filter(want, lambda n: ~F.array_contains(names, n))
    more = F.filter("_have", lambda c: ~F.array_contains(want, c["name"]))
    return joined.select(
        *_NAMED, "table_pos", "present",
        F.size(F.filter("_want", lambda w: ~w["exclude"])).cast("long").alias("n_columns"),
        F.when(F.col("present"), replica_identity(F.col("code"))).alias("replica_identity"),
        F.transform(
            gone, lambda n: F.struct(n.alias("column"), F.when(F.col("present"), closest(n, names)).alias("suggestion"))
        ).alias("missing"),
        F.flatten(F.transform("_want", mismatches)).alias("mismatched"),
        F.transform(more, lambda c: F.struct(c["name"].alias("column"), c["data_type"].alias("db_type"))).alias("extra"),
    )


def closest(column: Column, names: Column) -> Column:
    """The nearest of ``names`` within the distance, first in order on a tie."""

    def candidate(name: Column, pos: Column) -> Column:
        far = F.levenshtein(name, column, SUGGEST_DISTANCE)
        return F.struct(far.alias("distance"), pos.alias("pos"), name.alias("name"))

    return F.array_min(F.filter(F.transform(names, candidate), lambda c: c["distance"] >= 0))["name"]


def missing_columns(contract: DataFrame, cat: Catalog) -> DataFrame:
    """Configured columns, excluded ones too, that the catalog lacks; all of them if the table is gone."""
    each = assess(contract, cat).select("*", F.explode("missing.column").alias("column"))
    return each.select(*_NAMED, "table_pos", "column", (~F.col("present")).alias("table_missing"))


def suggest(missing: DataFrame, cat: Catalog) -> DataFrame:
    """Adds ``suggestion``, the closest catalog column, to rows as of ``missing_columns``."""
    names = cat.columns.groupBy(*TABLE).agg(in_order(F.col("name"), F.col("ordinal")).alias("_names"))
    kept = missing.columns
    return missing.join(names, list(TABLE), "left").select(
        *kept, F.when(~F.col("table_missing"), closest(F.col("column"), F.col("_names"))).alias("suggestion")
    )


def type_mismatches(contract: DataFrame, cat: Catalog) -> DataFrame:
    """One row per transform on a catalog column that does not hold strings."""
    return assess(contract, cat).select(*_NAMED, "table_pos", F.inline("mismatched"))


def unconfigured_columns(contract: DataFrame, cat: Catalog) -> DataFrame:
    """Catalog columns of configured tables that the contract does not name."""
    return assess(contract, cat).select(*_NAMED, "table_pos", F.inline("extra"))


def replica_findings(contract: DataFrame, cat: Catalog) -> DataFrame:
    """Configured tables whose updates and deletes do not carry the whole old row."""
    weak = assess(contract, cat).where(F.col("replica_identity") != "FULL")
    return weak.select(*_NAMED, "table_pos", F.lower("replica_identity").alias("identity"))


# Sections of a report in the order of its lines within a table.
_SECTIONS = ("table_missing", "missing_column", "transform_type", "replica_identity", "extra_column")


def _found() -> Column:
    """The findings of an assessed table as an array: ``kind, severity, column, detail, transform_name``."""
    none = F.lit(None).cast("string")

    def one(kind: str, column: Column = none, detail: Column = none, transform: Column = none) -> Column:
        severity = "warn" if kind in ("replica_identity", "extra_column") else "error"
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(severity).alias("severity"), column.alias("column"), detail.alias("detail"),
            transform.alias("transform_name"),
        )

    empty = F.filter(F.array(one("table_missing")), lambda _: F.lit(False))
    gone = F.when(~F.col("present") & (F.size("missing") > 0), F.array(one("table_missing"))).otherwise(empty)
    weak = F.array(one("replica_identity", detail=F.lower("replica_identity")))
    return F.concat(
        gone,
        F.when(F.col("present"), F.transform("missing", lambda c: one("missing_column", c["column"], c["suggestion"]))).otherwise(empty),
        F.transform("mismatched", lambda c: one("transform_type", c["column"], c["db_type"], c["transform_name"])),
        F.when(F.col("replica_identity") != "FULL", weak).otherwise(empty),
        F.transform("extra", lambda c: one("extra_column", c["column"], c["db_type"])),
    )


def findings(contract: DataFrame, cat: Catalog) -> DataFrame:
    """All findings as rows: ``kind, severity, column, detail``; a table that is gone is one finding."""
    return assess(contract, cat).select(*_NAMED, "table_pos", F.inline(_found()))


def ok_tables(contract: DataFrame, cat: Catalog) -> DataFrame:
    """Configured tables without any finding: count of emitted columns, and identity."""
    fine = assess(contract, cat).where(F.size(_found()) == 0)
    return fine.select(
        *_NAMED, "table_pos", "n_columns", F.coalesce("replica_identity", F.lit("UNKNOWN")).alias("replica_identity")
    )


def drift_summary(contract: DataFrame, cat: Catalog) -> DataFrame:
    """Errors, warnings, tables, footer and exit code per contract."""
    found = F.filter(_found(), lambda f: f["severity"] == "error")
    per_table = assess(contract, cat).select(
        "contract_id",
        # A column named twice is one error; each transform on a column of another type is one.
        F.size(F.array_distinct(F.transform(found, lambda f: F.when(f["kind"] != "transform_type", f["column"])))).alias("_apart"),
        F.size(F.filter(found, lambda f: f["kind"] == "transform_type")).alias("_typed"),
        F.size(found).alias("_all"),
        (F.size(_found()) - F.size(found)).alias("warnings"),
        *TABLE,
        "table_pos",
    )
    apart = F.col("_apart") - F.when(F.col("_typed") > 0, 1).otherwise(0)
    joined = per_table.groupBy("contract_id").agg(
        F.sum(apart + F.col("_typed")).alias("errors"), F.sum("warnings").alias("warnings"), F.count(F.lit(1)).alias("tables")
    )
    return joined.select(
        "contract_id",
        "errors",
        "warnings",
        "tables",
        F.format_string("validate: %d errors, %d warnings across %d tables", "errors", "warnings", "tables").alias(
            "footer"
        ),
        F.when(F.col("errors") > 0, 1).otherwise(0).alias("exit_code"),
    )


def drift_lines(contract: DataFrame, cat: Catalog) -> DataFrame:
    """Report lines, one for each finding or for a table without any. Order by ``REPORT_ORDER`` to read them."""
    each = F.inline_outer(_found())
    found = assess(contract, cat).select(*_NAMED, "n_columns", "replica_identity", each)
    key = F.concat_ws(".", *TABLE)
    at_column = F.concat_ws(".", *TABLE, "column")
    kind, detail = F.col("kind"), F.col("detail")
    # The texts of a report.
    text = (
        F.when(kind == "table_missing", F.concat(key, F.lit(" — table not found in database")))
        .when(
            kind == "missing_column",
            F.concat(
                at_column, F.lit(" — configured column not found in database"),
                F.coalesce(F.concat(F.lit(" (did you mean: "), detail, F.lit("?)")), F.lit("")),
            ),
        )
        .when(
            kind == "transform_type",
            F.concat(
                at_column, F.lit(" — transform '"), F.col("transform_name"),
                F.lit("' requires a string column; db type is \""), detail, F.lit('"'),
            ),
        )
        .when(
            kind == "replica_identity",
            F.concat(
                key, F.lit(" — REPLICA IDENTITY '"), detail,
                F.lit("' (not FULL); UPDATE/DELETE 'before' carries only the primary key. To fix: ALTER TABLE "),
                key, F.lit(" REPLICA IDENTITY FULL;"),
            ),
        )
        .otherwise(F.concat(at_column, F.lit(" — present in database, not in config")))
    )
    prefix = F.when(F.col("severity") == "error", "[ERROR] ").otherwise("[WARN]  ")
    fine = F.concat(
        F.lit("[OK]    "), key, F.lit(" — "), F.col("n_columns").cast("string"),
        F.lit(" columns, REPLICA IDENTITY "), F.coalesce("replica_identity", F.lit("UNKNOWN")),
    )
    section = F.array_position(F.array(*[F.lit(s) for s in _SECTIONS]), kind).cast("int")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return found.select(
        *_NAMED,
        F.coalesce(section, F.lit(0)).alias("section"),
        blank("column"),
        blank("transform_name"),
        F.when(kind.isNull(), fine).otherwise(F.concat(prefix, text)).alias("line"),
    )


REPORT_ORDER = (*_NAMED, "section", "column", "transform_name")
