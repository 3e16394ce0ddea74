"""Lint of contracts: rules over contract rows, each giving ``contract_id, path, message``.

A contract is one configuration, so the lists gathered here (columns of one output name, places of
one table) are bounded by what a configuration holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.cells import kotlin_trim

# The form of a schema URI, and the messages.
URI_PATTERN = r"^iglu:[^/]+/[^/]+/jsonschema/\d+-\d+-\d+\z"
BLANK = "must not be blank"
NO_KEY = "must contain at least one column name"
NO_COLUMNS = "must contain at least one column"
ALL_EXCLUDED = "must contain at least one non-excluded column"
BAD_URI = "must be a well-formed iglu URI (iglu:<vendor>/<name>/jsonschema/<MODEL-REVISION-ADDITION>)"

_HEAD = ("contract_id", "table_pos", "table_schema", "table_name", "schema_uri", "primary_key")


def _tables(contract: DataFrame) -> DataFrame:
    named = F.col("column").isNotNull()
    return contract.groupBy(*_HEAD).agg(
        F.count_if(named).alias("n_columns"), F.count_if(named & ~F.col("exclude")).alias("n_emitted")
    )


def _error(df: DataFrame, field: str, message: Column | str) -> DataFrame:
    """Rows of ``df`` as errors at a field of their table."""
    position = F.coalesce(F.col("table_pos").cast("string"), F.concat_ws(".", "table_schema", "table_name"))
    return df.select(
        "contract_id",
        F.concat(F.lit("tables["), position, F.lit("]." + field)).alias("path"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
    )


def blank_names(contract: DataFrame) -> DataFrame:
    t = _tables(contract)
    blank = lambda c: kotlin_trim(F.col(c)) == ""
    return _error(t.where(blank("table_name")), "name", BLANK).unionByName(
        _error(t.where(blank("table_schema")), "schema", BLANK)
    )


def empty_primary_key(contract: DataFrame) -> DataFrame:
    return _error(_tables(contract).where(F.size("primary_key") == 0), "primary_key", NO_KEY)


def nothing_emitted(contract: DataFrame) -> DataFrame:
    message = F.when(F.col("n_columns") == 0, NO_COLUMNS).otherwise(ALL_EXCLUDED)
    return _error(_tables(contract).where(F.col("n_emitted") == 0), "columns", message)


def output_collisions(contract: DataFrame) -> DataFrame:
    """Output names that several emitted columns of a table share."""
    sources = F.transform(F.array_sort(F.collect_list(F.struct("col_pos", "column"))), lambda c: c["column"])
    shared = (
        contract.where(F.col("column").isNotNull() & ~F.col("exclude"))
        .groupBy(*_HEAD, "output_name")
        .agg(sources.alias("sources"))
        .where(F.size("sources") > 1)
    )
    # Fixed value: the text of the finding.
    message = F.concat(
        F.lit('output property name "'), F.col("output_name"),
        F.lit('" is produced by multiple columns: ['), F.array_join("sources", ", "), F.lit("]"),
    )
    return _error(shared, "columns", message)


def malformed_uri(contract: DataFrame) -> DataFrame:
    return _error(_tables(contract).where(~F.col("schema_uri").rlike(URI_PATTERN)), "iglu_schema", BAD_URI)


def _with_transforms(contract: DataFrame) -> DataFrame:
    return contract.where(F.col("column").isNotNull() & (F.size("transforms") > 0))


def transform_on_key(contract: DataFrame) -> DataFrame:
    bad = _with_transforms(contract).where(F.array_contains("primary_key", F.col("column")))
    # Fixed value: the text of the finding.
    message = F.concat(
        F.lit('primary-key column "'), F.col("column"),
        F.lit('" cannot declare transforms — PK values feed the deterministic event_id'),
    )
    return _error(bad, "columns", message)


def transform_on_excluded(contract: DataFrame) -> DataFrame:
    bad = _with_transforms(contract).where("exclude")
    # Fixed value: the text of the finding.
    message = F.concat(F.lit('column "'), F.col("column"), F.lit('" is excluded; transforms would never run'))
    return _error(bad, "columns", message)


def duplicate_tables(contract: DataFrame) -> DataFrame:
    """Tables a contract names more than once."""
    places = _tables(contract).groupBy("contract_id", "table_schema", "table_name").agg(
        F.array_sort(F.collect_list("table_pos")).alias("places")
    )
    # Fixed value: the text of the finding.
    message = F.concat(
        F.lit("duplicate table "), F.concat_ws(".", "table_schema", "table_name"),
        F.lit(" at indices ["), F.array_join(F.col("places").cast("array<string>"), ", "), F.lit("]"),
    )
    return places.where(F.size("places") > 1).select(
        "contract_id", F.lit("tables").alias("path"), message.alias("message")
    )


RULES = (
    blank_names,
    empty_primary_key,
    nothing_emitted,
    output_collisions,
    malformed_uri,
    transform_on_key,
    transform_on_excluded,
    duplicate_tables,
)


def lint_contract(contract: DataFrame) -> DataFrame:
    """All errors of all contracts."""
    return reduce(DataFrame.unionByName, [rule(contract) for rule in RULES])
