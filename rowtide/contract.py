"""Column contracts: which columns of a source table are emitted, under which names, and how."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The transform keywords and the parameters each accepts.
TRANSFORM_PARAMETERS = {
    "lowercase": (),
    "uppercase": (),
    "trim": (),
    "regex_extract": ("pattern", "group"),
    "regex_replace": ("pattern", "replacement"),
}

CONTRACT_SCHEMA = (
    "contract_id string, table_pos int, table_schema string, table_name string, "
    "schema_uri string, primary_key array<string>, app_id string, col_pos int, "
    "column string, rename string, output_name string, exclude boolean, "
    "transforms array<struct<name:string,pattern:string,grp:int,replacement:string>>"
)


class ContractError(ValueError):
    """A contract that cannot be built."""


@dataclass(frozen=True)
class CellTransform:
    name: str
    pattern: str | None = None
    group: int | None = None
    replacement: str | None = None

    @classmethod
    def of(cls, entry: str | Mapping, where: str = "?") -> CellTransform:
        """Build from ``"trim"`` or ``{"regex_extract": {"pattern": ..., "group": 1}}``."""
        if isinstance(entry, cls):
            return entry
        if isinstance(entry, str):
            name, params = entry, None
        elif isinstance(entry, Mapping) and len(entry) == 1:
            ((name, params),) = entry.items()
        else:
            raise ContractError(f"column '{where}': a transform is a name or a one-key mapping, got {entry!r}")
        return _check_transform(name, params, where)


def _check_transform(name: str, params: Mapping | None, where: str) -> CellTransform:
    def fail(problem: str):
        raise ContractError(f"column '{where}': transform '{name}': {problem}")

    if name not in TRANSFORM_PARAMETERS:
        raise ContractError(f"column '{where}': unknown transform '{name}', valid: {', '.join(TRANSFORM_PARAMETERS)}")
    known = TRANSFORM_PARAMETERS[name]
    if not known:
        if params:
            fail("takes no parameters")
        return CellTransform(name)
    if not isinstance(params, Mapping):
        fail("missing parameters")
    unknown = [p for p in params if p not in known]
    if unknown:
        fail(f"unknown parameter(s) {unknown}, valid: {', '.join(known)}")
    pattern = params.get("pattern")
    if not isinstance(pattern, str):
        fail("needs a string 'pattern'")
    if name == "regex_replace":
        if not isinstance(params.get("replacement"), str):
            fail("needs a string 'replacement'")
        return CellTransform(name, pattern, None, params["replacement"])
    group = params.get("group")
    group = 1 if group is None else group
    if not isinstance(group, int) or isinstance(group, bool) or group < 0:
        fail(f"group must be an integer >= 0, got {group!r}")
    return CellTransform(name, pattern, group)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    rename: str | None = None
    exclude: bool = False
    transforms: tuple[CellTransform, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "transforms", tuple(CellTransform.of(t, self.name) for t in self.transforms))

    @property
    def output_name(self) -> str:
        return self.rename if self.rename is not None else self.name


@dataclass(frozen=True)
class TableContract:
    schema: str
    name: str
    schema_uri: str
    primary_key: tuple[str, ...]
    columns: tuple[ColumnSpec, ...]
    app_id: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "primary_key", tuple(self.primary_key))
        object.__setattr__(
            self, "columns", tuple(c if isinstance(c, ColumnSpec) else ColumnSpec(c) for c in self.columns)
        )

    @property
    def emitted(self) -> list[ColumnSpec]:
        """Columns that reach the payload, in contract order.

        A name produced twice keeps its first place and its last column, as in an ordered map.
        """
        by_output: dict[str, ColumnSpec] = {}
        for c in self.columns:
            if not c.exclude:
                by_output[c.output_name] = c
        return list(by_output.values())


def contract_df(spark: SparkSession, contracts: Sequence[TableContract], contract_id: str = "default") -> DataFrame:
    """The contracts as rows, one per column; a table without columns gives one row with a null column."""
    rows = []
    for pos, t in enumerate(contracts):
        head = (contract_id, pos, t.schema, t.name, t.schema_uri, list(t.primary_key), t.app_id)
        for i, c in enumerate(t.columns):
            chain = [(x.name, x.pattern, x.group, x.replacement) for x in c.transforms]
            rows.append((*head, i, c.name, c.rename, c.output_name, c.exclude, chain))
        if not t.columns:
            rows.append((*head, None, None, None, None, None, []))
    return spark.createDataFrame(rows, CONTRACT_SCHEMA)


def contract_versions(
    spark: SparkSession, versions: Iterable[tuple[int, Sequence[TableContract]]], contract_id: str = "default"
) -> DataFrame:
    """Contracts with the commit position each is in force from, as rows with ``valid_from``.

    ``records`` takes them in place of plain contracts; a table need not be in every version.
    """
    out = spark.createDataFrame([], CONTRACT_SCHEMA + ", valid_from bigint")
    for start, contracts in versions:
        out = out.unionByName(contract_df(spark, contracts, contract_id).withColumn("valid_from", F.lit(start).cast("bigint")))
    return out


def groups_of(pattern: str) -> tuple[int, set[str]]:
    """The number of capturing groups of a Java pattern, and the names of those that have one.

    Escapes, quoted parts and character classes hold no groups.
    """
    count, names, i, depth = 0, set(), 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            if pattern.startswith("\\Q", i):
                end = pattern.find("\\E", i + 2)
                i = len(pattern) if end < 0 else end
            i += 2
            continue
        if c == "[":
            depth += 1
            if pattern.startswith("[^", i):
                i += 1
        elif c == "]" and depth:
            depth -= 1
        elif c == "(" and not depth:
            named = re.match(r"\(\?<([A-Za-z][A-Za-z0-9]*)>", pattern[i:])
            if named:
                names.add(named[1])
            if named or not pattern.startswith("(?", i):
                count += 1
        i += 1
    return count, names


def replacement_problem(replacement: str, count: int, names: set[str]) -> str | None:
    """What is wrong with a Java replacement text for a pattern with these groups."""
    i = 0
    while i < len(replacement):
        if replacement[i] == "\\":
            if i + 1 == len(replacement):
                return "ends in a lone backslash"
            i += 2
        elif replacement[i] == "$":
            named = re.match(r"\$\{([A-Za-z][A-Za-z0-9]*)\}", replacement[i:])
            if named:
                if named[1] not in names:
                    return f"names group {named[1]!r}, which the pattern does not have"
                i += len(named[0])
            elif i + 1 < len(replacement) and replacement[i + 1] in "0123456789":
                # further digits only count while such a group exists
                if int(replacement[i + 1]) > count:
                    return f"refers to group {replacement[i + 1]} of {count}"
                i += 2
            else:
                return "has a dollar sign without a group"
        else:
            i += 1
    return None


def check_patterns(spark: SparkSession, contracts: Iterable[TableContract]) -> list[str]:
    """Problems with the regular expressions, group numbers and replacements of the contracts.

    All patterns are compiled by the regex engine that Spark uses, in one job.
    """
    return _problems(
        spark,
        {
            (x.pattern, x.group, x.replacement): f"{t.schema}.{t.name}.{c.name}"
            for t in contracts
            for c in t.columns
            for x in c.transforms
            if x.pattern is not None
        },
    )


def check_pattern_rows(contract: DataFrame) -> list[str]:
    """``check_patterns`` for contracts as rows. Only the distinct transforms come to the driver."""
    each = contract.select(
        F.concat_ws(".", "table_schema", "table_name", "column").alias("at"), F.explode("transforms").alias("t")
    ).where("t.pattern is not null")
    distinct = each.groupBy("t.pattern", "t.grp", "t.replacement").agg(F.min("at").alias("at")).collect()
    return _problems(contract.sparkSession, {(r.pattern, r.grp, r.replacement): r["at"] for r in distinct})


def _problems(spark: SparkSession, wanted: Mapping[tuple, str]) -> list[str]:
    if not wanted:
        return []
    rows = spark.createDataFrame([(p,) for p in sorted({p for p, _, _ in wanted})], "pattern string")
    compiled = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), F.col("pattern"))
    broken = {r.pattern for r in rows.where(compiled.isNull()).collect()}
    problems = []
    for (pattern, group, replacement), where in wanted.items():
        count, names = groups_of(pattern)
        if pattern in broken:
            problem = "is not a regular expression"
        elif replacement is not None:
            problem = replacement_problem(replacement, count, names)
            problem = problem and f"replacement {replacement!r} {problem}"
        else:
            problem = f"has no group {group}" if (group or 0) > count else None
        if problem:
            problems.append(f"column '{where}': pattern '{pattern}': {problem}")
    return problems


#: Contracts whose patterns were checked in this process.
_SOUND: set[TableContract] = set()


def require_sound(spark: SparkSession, contracts: Iterable[TableContract] | DataFrame) -> None:
    """Refuse contracts whose transforms would fail on data. Objects that were found sound once are not looked at again."""
    if isinstance(contracts, DataFrame):
        if problems := check_pattern_rows(contracts):
            raise ContractError("; ".join(problems))
        return
    fresh = [t for t in contracts if any(x.pattern is not None for c in t.columns for x in c.transforms)]
    fresh = [t for t in fresh if t not in _SOUND]
    if fresh:
        problems = check_patterns(spark, fresh)
        if problems:
            raise ContractError("; ".join(problems))
        _SOUND.update(fresh)
