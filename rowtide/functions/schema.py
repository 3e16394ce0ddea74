"""Fingerprint and column names of the schema block of an envelope.

Both take ``array<struct<field,type,name,optional>>`` in declaration order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint(columns: Column) -> Column:
    """Hex SHA-256 of one tab-separated line per column."""

    def line(c: Column) -> Column:
        text = [F.coalesce(c[k], F.lit("")) for k in ("field", "type", "name")]
        return F.concat_ws("\t", *text, F.coalesce(c["optional"], F.lit(True)).cast("string"))

    return F.sha2(F.array_join(F.transform(columns, line), "\n"), 256)


def column_names(columns: Column) -> Column:
    return F.transform(columns, lambda c: F.coalesce(c["field"], F.lit("")))
