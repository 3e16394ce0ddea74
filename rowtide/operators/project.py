"""Per-table projection, payload shape and event name.

Two ways to route a record to its table's contract, with the same results. A few contracts are
written into the expression tree, one CASE branch per table, with patterns as constants. Many
contracts stay data: they are joined to the records and higher-order functions walk over their
column lists, so that the plan does not grow with the number of tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.contract import ColumnSpec, TableContract
from rowtide.functions.cells import apply_chain, apply_chain_rows
from rowtide.functions.members import ESCAPED, members
from rowtide.operators.asof import as_of
from rowtide.operators.envelope import cell

KEEP_NULLS = {"ignoreNullFields": "false"}
TABLE = ("table_schema", "table_name")

# Above this many emitted columns over all tables, contracts are joined instead of inlined. Both give the same
# records; it is about the size of the generated code only.
INLINE_COLUMNS = 200

# Contracts of up to so many bytes of text are broadcast. Larger ones are joined by table and a salt, so that the
# records of a busy table are spread over tasks: as many as the session's shuffle has, as long as the copies of the
# contracts stay within a bound.
BROADCAST_BYTES = 8 << 20
SALTED_BYTES = 4 << 30


def plain_number(v: Column) -> Column:
    """A fractional number in its double form, so that ``1.0`` keeps its fraction in JSON text.

    VARIANT stores such literals as decimals without trailing zeros. Integers too long for 64 bits
    are decimals too, with 19 digits or more, and stay.
    """
    kind = F.schema_of_variant(v)
    fractional = kind.startswith("DECIMAL") & ~kind.rlike(r"^DECIMAL\((19|[23][0-9]),0\)")
    return F.when(fractional, F.try_variant_get(v, "$", "double").cast("variant")).otherwise(v)


def project(image: Column, contract: TableContract) -> Column:
    """Contracted columns of one image as a struct: whitelist, order, rename, exclude, transforms."""
    return F.struct(*[_project_cell(image, c) for c in contract.emitted])


def _project_cell(image: Column, c: ColumnSpec) -> Column:
    value = cell(image, c.name)
    if c.transforms:
        return apply_chain(F.try_variant_get(value, "$", "string"), c.transforms).alias(c.output_name)
    return plain_number(value).alias(c.output_name)


def not_text(value: Column) -> Column:
    """True for a cell that is neither null nor a string."""
    return F.coalesce(~F.schema_of_variant(value).isin("STRING", "VOID"), F.lit(False))


def _any(tests: Sequence[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


class InlineRouter:
    """Contracts as CASE branches."""

    def __init__(self, contracts: Sequence[TableContract]):
        self.contracts = list({(t.schema, t.name): t for t in contracts}.values())

    def route(self, parsed: DataFrame) -> DataFrame:
        number = F.lit(None).cast("int")
        for i, t in enumerate(self.contracts):
            here = (F.col("table_schema") == t.schema) & (F.col("table_name") == t.name)
            number = F.when(here, F.lit(i)).otherwise(number)
        routed = parsed.withColumn("route", number)
        return routed.withColumn("schema_uri", self._pick(lambda t: F.lit(t.schema_uri), "string")).withColumn(
            "table_app_id", self._pick(lambda t: F.lit(t.app_id).cast("string"), "string")
        )

    def _pick(self, of: Callable[[TableContract], Column], kind: str) -> Column:
        out = F
        for i, t in enumerate(self.contracts):
            out = out.when(F.col("route") == i, of(t))
        return F.lit(None).cast(kind) if out is F else out

    def bad_cell(self) -> Column:
        def of(t: TableContract) -> Column:
            guarded = [c.name for c in t.emitted if c.transforms]
            return _any([not_text(cell(F.col(i), n)) for i in ("before", "after") for n in guarded])

        return F.coalesce(self._pick(of, "boolean"), F.lit(False))

    def image(self, side: str) -> Column:
        """JSON of the contracted columns of one image."""
        return self._pick(lambda t: F.to_json(project(F.col(side), t), KEEP_NULLS), "string")

    def primary_key(self, sort: bool = False) -> Column:
        """JSON of the key columns, in contract order or sorted by name."""

        def of(t: TableContract) -> Column:
            names = sorted(set(t.primary_key)) if sort else dict.fromkeys(t.primary_key)
            pk = [plain_number(cell(F.col("key_image"), n)).alias(n) for n in names]
            return F.to_json(F.struct(*pk), KEEP_NULLS) if pk else F.lit("{}")

        return self._pick(of, "string")


class JoinedRouter:
    """Contracts as rows joined to the records."""

    _HEADER = (
        "table_schema string, table_name string, route int, schema_uri string, table_app_id string, "
        "pk_names array<string>, pk_sorted array<string>, "
        "specs array<struct<name:string,out:string,"
        "transforms:array<struct<name:string,pattern:string,grp:int,replacement:string>>>>"
    )

    def __init__(self, contracts: Sequence[TableContract]):
        self.contracts = list({(t.schema, t.name): t for t in contracts}.values())

    def route(self, parsed: DataFrame) -> DataFrame:
        rows = []
        for i, t in enumerate(self.contracts):
            specs = [
                (c.name, c.output_name, [(x.name, x.pattern, x.group, x.replacement) for x in c.transforms])
                for c in t.emitted
            ]
            pk = list(dict.fromkeys(t.primary_key))
            rows.append((t.schema, t.name, i, t.schema_uri, t.app_id, pk, sorted(pk), specs))
        header = parsed.sparkSession.createDataFrame(rows, self._HEADER)
        return self._join(parsed, header, len(repr(rows)))

    @staticmethod
    def _join(parsed: DataFrame, header: DataFrame, size: int, keys: Sequence[str] = TABLE) -> DataFrame:
        if size <= BROADCAST_BYTES:
            return parsed.join(F.broadcast(header), list(keys), "left")
        tasks = int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = max(2, min(tasks, SALTED_BYTES // max(1, size)))
        salt = F.pmod(F.xxhash64("key", "seq"), F.lit(salts)).cast("int")
        copies = header.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return parsed.withColumn("_salt", salt).join(copies, [*keys, "_salt"], "left").drop("_salt")

    def bad_cell(self) -> Column:
        def bad(image: str) -> Column:
            return F.exists(
                "specs",
                lambda s: (F.size(s["transforms"]) > 0) & not_text(F.try_element_at(F.col(image), s["name"])),
            )

        return F.coalesce(bad("before"), F.lit(False)) | F.coalesce(bad("after"), F.lit(False))

    def image(self, side: str) -> Column:
        def entry(s: Column) -> Column:
            value = F.try_element_at(F.col(side), s["name"])
            text = apply_chain_rows(F.try_variant_get(value, "$", "string"), s["transforms"])
            done = F.when(F.size(s["transforms"]) > 0, text.cast("variant")).otherwise(plain_number(value))
            return F.struct(s["out"].alias("key"), done.alias("value"))

        return F.to_json(F.map_from_entries(F.transform("specs", entry)), KEEP_NULLS)

    def primary_key(self, sort: bool = False) -> Column:
        def entry(n: Column) -> Column:
            value = plain_number(F.try_element_at(F.col("key_image"), n))
            return F.struct(n.alias("key"), value.alias("value"))

        names = "pk_sorted" if sort else "pk_names"
        return F.to_json(F.map_from_entries(F.transform(names, entry)), KEEP_NULLS)


class RowsRouter(JoinedRouter):
    """Contracts that are a DataFrame (``rowtide.contract.contract_df``); none of them comes to the driver.

    Their size is measured where they are, before the join is chosen.
    """

    def __init__(self, contract: DataFrame):
        self.contract = contract

    def route(self, parsed: DataFrame) -> DataFrame:
        header = header_of(self.contract)
        return self._join(parsed, header, text_size(header))


class VersionedRouter(RowsRouter):
    """Contracts that are a DataFrame with ``valid_from``, the commit position from which a table's contract is this one.

    A record takes the version in force at its commit position; at a border that is the new one. Before a table's first
    version it has no contract. A record without a commit position takes the last version. The version found is a key like
    another, so a busy table with many versions is spread by them too.
    """

    def route(self, parsed: DataFrame) -> DataFrame:
        header = header_of(self.contract, (*TABLE, "valid_from"))
        size = text_size(header)
        placed = as_of(parsed, self.contract, TABLE, "lsn_num", "valid_from")
        keys = (*TABLE, "valid_from")
        if size <= BROADCAST_BYTES:
            return self._join(placed, header, size, keys)
        # Most records of a feed have the last version of their table, or none: those are told by a row for each table, and
        # dealt out evenly in the join that tells the others.
        told = [c for c in header.columns if c not in keys]
        latest = header.groupBy(*TABLE).agg(F.max_by(F.struct("valid_from", *told), "valid_from").alias("_l"))
        latest = latest.select(*TABLE, F.col("_l.valid_from").alias("valid_from"), F.col("_l").alias("_latest"))
        found = placed.join(_small(latest), list(keys), "left")
        done = F.col("valid_from").isNull() | F.col("_latest").isNotNull()
        found = found.withColumns({"_done": done, "_from": F.when(done, F.xxhash64("key", "seq")).otherwise(F.col("valid_from"))})
        rest = header.withColumnRenamed("valid_from", "_from").withColumn("_done", F.lit(False))
        both = self._join(found, rest, size, (*TABLE, "_from", "_done"))
        picked = [F.coalesce(F.col(f"_latest.{c}"), F.col(c)).alias(c) for c in told]
        return both.select(*placed.columns, *picked)


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if text_size(rows) <= BROADCAST_BYTES else rows


def text_size(header: DataFrame) -> int:
    """Bytes of these rows as JSON text."""
    return header.agg(F.sum(F.octet_length(F.to_json(F.struct(*header.columns))))).first()[0] or 0


def header_of(contract: DataFrame, keys: Sequence[str] = TABLE) -> DataFrame:
    """A row per table, or per table and version, of contracts as rows. A table told twice has its last contract; an output name produced twice
    keeps its first place and its last column."""
    keys = list(keys)
    last = contract.groupBy(*keys).agg(
        F.max("table_pos").alias("table_pos"),
        F.max_by(F.struct("schema_uri", "app_id", "primary_key"), "table_pos").alias("h"),
    )
    emitted = contract.where(F.col("column").isNotNull() & ~F.col("exclude")).groupBy(*keys, "table_pos", "output_name").agg(
        F.min("col_pos").alias("pos"), F.max_by(F.struct("column", "transforms"), "col_pos").alias("c")
    )
    spec = F.struct(F.col("c.column").alias("name"), F.col("output_name").alias("out"), F.col("c.transforms").alias("transforms"))
    specs = emitted.groupBy(*keys, "table_pos").agg(F.array_sort(F.collect_list(F.struct("pos", spec.alias("s")))).alias("specs"))
    joined = last.join(specs, [*keys, "table_pos"], "left")
    return joined.select(
        *keys,
        F.col("table_pos").alias("route"),
        "h.schema_uri",
        F.col("h.app_id").alias("table_app_id"),
        F.array_distinct("h.primary_key").alias("pk_names"),
        F.array_sort(F.array_distinct("h.primary_key")).alias("pk_sorted"),
        F.coalesce(F.transform("specs", lambda r: r["s"]), F.array()).alias("specs"),
    )


def router(contracts: Sequence[TableContract] | DataFrame, inline_columns: int = INLINE_COLUMNS):
    if isinstance(contracts, DataFrame):
        return VersionedRouter(contracts) if "valid_from" in contracts.columns else RowsRouter(contracts)
    emitted = sum(len(t.emitted) for t in contracts)
    return InlineRouter(contracts) if emitted <= inline_columns else JoinedRouter(contracts)


def key_image() -> Column:
    """The image that identifies the row: the old one for a delete."""
    return F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))


def payload(before: Column, after: Column) -> Column:
    """The payload of an operation from the JSON of its images: a side it does not have gets no key."""
    op = F.col("op")
    return F.concat(
        F.lit('{"op":"'), op, F.lit('"'),
        F.when(op.isin("u", "d"), F.concat(F.lit(',"before":'), before)).otherwise(""),
        F.when(op.isin("c", "r", "u"), F.concat(F.lit(',"after":'), after)).otherwise(""),
        F.lit("}"),
    )


def canonical_name(connector: str, lsn: Column, pk: Column) -> Column:
    """Coordinates of a change as JSON with sorted keys, nulls kept; ``pk`` is JSON with sorted keys."""
    schema = F.nullif(F.col("table_schema"), F.lit(""))
    head = [("connector", "text", F.lit(connector)), ("db", "plain", F.col("db")), ("lsn", "plain", lsn), ("op", "plain", F.col("op"))]
    tail = [("schema", "plain", schema), ("table", "plain", F.col("table_name")), ("txid", "number", F.col("txid"))]

    def name(head: Column, tail: Column) -> Column:
        return F.concat(F.lit("{"), head, F.lit(',"pk":'), pk, F.lit(","), tail, F.lit("}"))

    def written(each: list) -> Column:
        text = F.to_json(F.struct(*[v.alias(n) for n, _, v in each]), KEEP_NULLS)
        return F.substring(text, F.lit(2), F.length(text) - 2)

    odd = F.concat_ws("", "db", lsn, "op", "table_schema", "table_name").rlike(ESCAPED)
    sides = [F.when(odd, written(each)).otherwise(members(each, nulls=True)) for each in (head, tail)]
    return name(*sides)
