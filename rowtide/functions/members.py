"""JSON objects put together as text.

``to_json`` sets up a writer for each row, which costs more than small objects do. Members whose values are numbers or short
texts are concatenated instead, with the same result; only a text that needs escapes is written by ``to_json``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that JSON text has escaped.
ESCAPED = r'[\x00-\x1f"\\]'
#: Name, kind and value: a whole "number", a "text", or one known to hold no escaped character, "plain".
Member = tuple[str, str, Column]


def members(each: Sequence[Member], nulls: bool = False) -> Column:
    """The members of an object with commas between. Nulls are left out, or written with ``nulls``."""

    def member(name: str, kind: str, value: Column) -> Column:
        if kind == "number":
            done = F.concat(F.lit(f'"{name}":'), value.cast("string"))
        elif kind == "plain":
            done = F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))
        else:
            text = F.to_json(F.struct(value.alias(name)))
            done = F.when(value.rlike(ESCAPED), F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(
                F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))
            )
        return F.coalesce(done, F.lit(f'"{name}":null')) if nulls else done

    return F.concat_ws(",", *[member(*m) for m in each])


def object_text(each: Sequence[Member], nulls: bool = False) -> Column:
    """What ``to_json`` writes of a struct of these."""
    return F.concat(F.lit("{"), members(each, nulls), F.lit("}"))
