"""String transforms on cells, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowtide.contract import CellTransform

# The characters Kotlin counts as white space.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def kotlin_trim(c: Column) -> Column:
    """Trim all white space; the built-in ``trim`` removes U+0020 only."""
    return F.btrim(c, F.lit(WHITESPACE))


def regex_extract(c: Column, pattern: Column | str, group: Column | int) -> Column:
    """Group of the first match; null when nothing matches or the group took no part.

    ``regexp_extract`` gives the empty string in both of those cases, so an empty result is looked
    at again: the pattern is pinned to the place of the first match, made atomic, and followed by a
    back-reference, which only matches if the group took part. The place is the length of the text that
    is left when everything from the first match on is cut off, in code points as ``.`` counts them.
    """
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    g = F.lit(group) if isinstance(group, int) else group
    found = F.call_function("regexp_extract", c, p, g)
    rest = F.concat(F.lit("(?:"), p, F.lit(")(?s:.*)\\z"))
    before = F.char_length(F.regexp_replace(c, rest, F.lit(""))).cast("string")
    pinned = F.concat(F.lit("\\A(?s:.{"), before, F.lit("})(?>"), p, F.lit(")\\"), g.cast("string"))
    return (
        F.when(found != "", found)
        .when(~F.rlike(c, p), F.lit(None).cast("string"))
        .when((g == 0) | F.when(g != 0, F.rlike(c, pinned)), F.lit(""))
    )


def apply_transform(c: Column, t: CellTransform) -> Column:
    if t.name == "lowercase":
        return F.lower(c)
    if t.name == "uppercase":
        return F.upper(c)
    if t.name == "trim":
        return kotlin_trim(c)
    if t.name == "regex_extract":
        return regex_extract(c, t.pattern, t.group)
    return F.regexp_replace(c, F.lit(t.pattern), F.lit(t.replacement))


def apply_chain(c: Column, transforms: Iterable[CellTransform]) -> Column:
    """The transforms in order; null passes through."""
    return reduce(apply_transform, transforms, c)


def apply_chain_rows(c: Column, transforms: Column) -> Column:
    """``apply_chain`` for a chain held in an array column, for contracts too many to inline."""

    def step(acc: Column, t: Column) -> Column:
        return (
            F.when(t["name"] == "lowercase", F.lower(acc))
            .when(t["name"] == "uppercase", F.upper(acc))
            .when(t["name"] == "trim", kotlin_trim(acc))
            .when(t["name"] == "regex_extract", regex_extract(acc, t["pattern"], t["grp"]))
            .when(t["name"] == "regex_replace", F.regexp_replace(acc, t["pattern"], t["replacement"]))
        )

    return F.aggregate(transforms, c, step)


def slugify(c: Column) -> Column:
    """Lower case, runs of anything but letters and digits to one hyphen, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^A-Za-z0-9]+", "-"), F.lit("-"))
