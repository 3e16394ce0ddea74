import json
import re

import pytest
from envelopes import COLUMNS, envelope, feed
from pyspark.sql import functions as F

from rowtide.contract import ColumnSpec, TableContract, contract_df
from rowtide.operators import drift, lint, scaffold
from rowtide.operators.catalog import (
    assemble_catalog,
    columns_with_enums,
    missing_tables,
    primary_key_columns,
    unique_index_columns,
)
from rowtide.operators.envelope import parse
from rowtide.sources.catalog import catalog_of, observed_columns, read_catalog

COLUMN = "table_schema string, table_name string, name string, ordinal int, is_nullable boolean, data_type string, udt_name string, char_max_len int"
INDEX = "table_schema string, table_name string, index_name string, is_primary boolean, is_unique boolean, indkey array<int>"


def _frames(spark, tables, identities, enums=(), indexes=()):
    rows = []
    for name, columns in tables.items():
        for i, c in enumerate(columns, 1):
            column, data_type, udt, *rest = c
            nullable = rest[0] if rest else False
            rows.append(("public", name, column, i, nullable, data_type, udt, rest[1] if len(rest) > 1 else None))
    columns = spark.createDataFrame(rows[::-1], COLUMN)
    return (
        columns,
        spark.createDataFrame(
            [("public", t, c) for t, c in identities.items()], "table_schema string, table_name string, relreplident string"
        ),
        spark.createDataFrame(list(enums), "enum_type string, label string, sort_order float"),
        columns.select("table_schema", "table_name", F.col("name").alias("column"), F.col("ordinal").alias("attnum")),
        spark.createDataFrame([("public", *i) for i in indexes], INDEX),
    )


def _catalog(spark, *args, **kw):
    return catalog_of(*_frames(spark, *args, **kw))


# A harbour: most tables are as configured, one has faults of every kind.
HARBOUR = {
    "vessels": [("imo", "integer", "int4"), ("call_sign", "character", "bpchar"), ("flag", "text", "text", True),
                ("gross_tons", "numeric", "numeric", True), ("built", "date", "date", True)],
    "berths": [("quay", "text", "text"), ("slot", "smallint", "int2"), ("depth_m", "real", "float4", True)],
    "pilots": [("badge", "uuid", "uuid"), ("surname", "character varying", "varchar", False, 80)],
    "tides": [("station", "text", "text"), ("read_at", "timestamp without time zone", "timestamp"), ("level_cm", "integer", "int4")],
    "cargo": [("ref", "text", "text"), ("lines", "jsonb", "jsonb"), ("hazard", "boolean", "bool"), ("owner", "text", "text"),
              ("weight_kg", "double precision", "float8"), ("sealed", "boolean", "bool")],
}
IDENTITIES = {"vessels": "f", "berths": "f", "pilots": "f", "tides": "n", "cargo": "i"}


def _contract(name, *columns, schema="public", pk=("id",), uri=None):
    return TableContract(schema, name, uri or f"iglu:com.example/{name}/jsonschema/1-0-0", pk, columns)


def _report(spark, contracts, cat):
    contract = contract_df(spark, contracts)
    lines = drift.drift_lines(contract, cat).orderBy(*drift.REPORT_ORDER).collect()
    return [r.line for r in lines], drift.drift_summary(contract, cat).first()


def test_drift_report(spark):
    contracts = [
        _contract("pilots", "badge", "surname", pk=("badge",)),
        _contract("cargo", ColumnSpec("hazard", transforms=("uppercase", "trim")), "ref", "linse", "shipper",
                  ColumnSpec("weight_kg", exclude=True), "owner", pk=("ref",)),
        _contract("vessels", "imo", ColumnSpec("call_sign", transforms=("trim",)), "flag", "gross_tons", "built", pk=("imo",)),
        _contract("tides", "station", "read_at", "level_cm", pk=("station", "read_at")),
        _contract("berths", "quay", "slot", ColumnSpec("depth_m", exclude=True), pk=("quay", "slot")),
    ]
    lines, summary = _report(spark, contracts, _catalog(spark, HARBOUR, IDENTITIES))
    weak = "(not FULL); UPDATE/DELETE 'before' carries only the primary key. To fix: ALTER TABLE"
    assert lines == [
        "[OK]    public.berths — 2 columns, REPLICA IDENTITY FULL",
        "[ERROR] public.cargo.linse — configured column not found in database (did you mean: lines?)",
        "[ERROR] public.cargo.shipper — configured column not found in database",
        "[ERROR] public.cargo.hazard — transform 'trim' requires a string column; db type is \"boolean\"",
        "[ERROR] public.cargo.hazard — transform 'uppercase' requires a string column; db type is \"boolean\"",
        f"[WARN]  public.cargo — REPLICA IDENTITY 'index' {weak} public.cargo REPLICA IDENTITY FULL;",
        "[WARN]  public.cargo.lines — present in database, not in config",
        "[WARN]  public.cargo.sealed — present in database, not in config",
        "[OK]    public.pilots — 2 columns, REPLICA IDENTITY FULL",
        f"[WARN]  public.tides — REPLICA IDENTITY 'nothing' {weak} public.tides REPLICA IDENTITY FULL;",
        "[OK]    public.vessels — 5 columns, REPLICA IDENTITY FULL",
    ]
    assert summary.footer == "validate: 4 errors, 4 warnings across 5 tables" and summary.exit_code == 1


def test_warnings_alone_are_no_error(spark):
    contracts = [_contract("tides", "station", "level_cm"), _contract("pilots", "badge", "surname")]
    lines, summary = _report(spark, contracts, _catalog(spark, HARBOUR, IDENTITIES))
    assert len(lines) == 3 and (summary.errors, summary.warnings, summary.exit_code) == (0, 2, 0)


def test_missing_table_is_one_error(spark):
    lines, summary = _report(spark, [_contract("lighthouses", "id", "a", "b")], _catalog(spark, HARBOUR, IDENTITIES))
    assert lines == ["[ERROR] public.lighthouses — table not found in database"]
    assert (summary.errors, summary.tables) == (1, 1)


def test_missing_sorted_and_transforms_after_them(spark):
    contract = _contract(
        "berths", "width", "area", ColumnSpec("slot", transforms=("uppercase", "lowercase")),
        ColumnSpec("crane", exclude=True), "quay", "depth_m",
    )
    lines, summary = _report(spark, [contract], _catalog(spark, HARBOUR, {"berths": "f"}))
    assert [x.split(" — ")[0].split(".")[-1] for x in lines] == ["area", "crane", "width", "slot", "slot"]
    assert "'lowercase'" in lines[3] and "'uppercase'" in lines[4]
    assert summary.errors == 5


@pytest.mark.parametrize(
    "wanted, have, want",
    [
        ("draugth", ["length", "draught", "beam"], "draught"),
        ("ab", ["abcd", "abc", "abd"], "abc"),
        ("xy", ["ax", "yx", "zy"], "zy"),
        ("xyz", ["id"], None),
        ("", ["ab", "a"], "a"),
    ],
)
def test_suggestions(spark, wanted, have, want):
    cat = _catalog(spark, {"t": [(c, "text", "text") for c in have]}, {"t": "f"})
    missing = drift.missing_columns(contract_df(spark, [_contract("t", wanted)]), cat)
    assert drift.suggest(missing, cat).first().suggestion == want


def test_many_contracts_in_one_job(spark):
    cat = _catalog(spark, HARBOUR, IDENTITIES)
    a = contract_df(spark, [_contract("pilots", "badge", "surname")], "a")
    b = contract_df(spark, [_contract("pilots", "badge"), _contract("lighthouses", "x")], "b")
    both = a.unionByName(b)
    got = {r.contract_id: (r.errors, r.warnings, r.tables) for r in drift.drift_summary(both, cat).collect()}
    assert got == {"a": (0, 0, 1), "b": (1, 1, 2)}


# A library: two enums, one of them unused; keys of one and three columns; indexes over plain columns and expressions.
LIBRARY = {
    "loans": [("branch", "smallint", "int2"), ("copy_no", "bigint", "int8"), ("out_on", "date", "date"),
              ("state", "USER-DEFINED", "loan_state", True), ("notes", "ARRAY", "_varchar"), ("fee", "real", "float4", True)],
    "books": [("isbn", "character", "bpchar", False, 13), ("title", "text", "text"), ("binding", "USER-DEFINED", "binding_kind"),
              ("extra", "json", "json"), ("shelf", "character varying", "varchar", True, 12)],
    "readers": [("card", "uuid", "uuid", True), ("phone", "text", "text", True), ("town", "text", "text"), ("street", "text", "text")],
    "visits": [("at", "timestamp without time zone", "timestamp", True)],
}
ENUMS = [("loan_state", "lost", 4.0), ("loan_state", "out", 1.5), ("loan_state", "late", 3.0), ("loan_state", "back", 2.0),
         ("binding_kind", "paper", 1.0), ("unused_kind", "cloth", 1.0)]
INDEXES = [
    ("loans", "loans_key", True, True, [3, 1, 2]),
    ("books", "books_key", True, True, [1]),
    ("books", "by_shelf", False, True, [5, 2]),
    ("books", "by_title", False, False, [2]),
    ("readers", "r3_street_first", False, True, [4, 3]),
    ("readers", "r1_card", False, True, [1]),
    ("readers", "r2_lower_phone", False, True, [0]),
    ("readers", "r4_phone_and_more", False, True, [0, 2]),
]


def _library(spark):
    identities = {"loans": "i", "books": "f", "readers": "x", "archived": "d"}
    return _frames(spark, LIBRARY, identities, ENUMS, INDEXES)


def test_catalog(spark, tmp_path):
    got = {r.table_name: r for r in assemble_catalog(catalog_of(*_library(spark))).collect()}
    assert sorted(got) == ["archived", "books", "loans", "readers", "visits"]
    assert [c.name for c in got["loans"].columns] == [c[0] for c in LIBRARY["loans"]]
    assert got["loans"].columns[3].enum_labels == ["out", "back", "late", "lost"]
    assert got["books"].columns[2].enum_labels == ["paper"] and got["books"].columns[1].enum_labels is None
    assert got["loans"].primary_key == ["out_on", "branch", "copy_no"] and got["loans"].unique_indexes == []
    assert got["books"].primary_key == ["isbn"] and got["books"].unique_indexes == [["shelf", "title"]]
    assert got["readers"].primary_key == [] and got["readers"].unique_indexes == [["card"], ["street", "town"], ["phone"]]
    assert {t: r.replica_identity for t, r in got.items()} == {
        "loans": "INDEX", "books": "FULL", "readers": "UNKNOWN", "visits": "UNKNOWN", "archived": "DEFAULT",
    }
    assert got["archived"].columns == [] and got["archived"].primary_key == []

    for name, df in zip(("columns", "identities", "enums", "attributes", "indexes"), _library(spark), strict=True):
        df.write.parquet(str(tmp_path / name))
    some = read_catalog(spark, path=str(tmp_path), tables=[("public", "visits"), ("public", "shops"), ("public", "readers")])
    assert sorted(r.table_name for r in assemble_catalog(some).collect()) == ["readers", "visits"]
    assert some.enums.count() == 0
    asked = spark.createDataFrame([("public", "visits"), ("public", "shops")], "table_schema string, table_name string")
    assert [r.table_name for r in missing_tables(asked, some).collect()] == ["shops"]


def _attribute_joins(df):
    """The joins of index keys with the attributes, as planned."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.search(r"\w+Join", line)[0] for line in plan.splitlines() if "Join [" in line and "attnum" in line]


def test_attributes_are_not_broadcast(spark, tmp_path):
    # The planner guesses the size of attributes from a file, and would broadcast these.
    for name, df in zip(("columns", "identities", "enums", "attributes", "indexes"), _library(spark), strict=True):
        df.write.parquet(str(tmp_path / name))
    cat = read_catalog(spark, path=str(tmp_path))
    keys = primary_key_columns(cat)
    assert _attribute_joins(keys) == ["SortMergeJoin"]
    assert {r.table_name: r.primary_key for r in keys.collect()} == {"loans": ["out_on", "branch", "copy_no"], "books": ["isbn"]}
    assert _attribute_joins(scaffold.scaffold_contract(cat, "org.shelf")) == ["SortMergeJoin"]
    assert _attribute_joins(scaffold.pk_hints(cat)) == ["SortMergeJoin"] * 2
    unique = unique_index_columns(cat)
    assert _attribute_joins(unique) == ["SortMergeJoin"]
    assert {r.table_name: r.unique_indexes for r in unique.collect()} == {
        "books": [["shelf", "title"]], "readers": [["card"], ["street", "town"], ["phone"]],
    }


def test_starter_artefacts(spark):
    cat = catalog_of(*_library(spark))
    docs = {r.path: json.loads(r.text) for r in scaffold.json_schemas(cat, "org.shelf").collect()}
    loans = docs["schemas/org.shelf/loans_change/jsonschema/1-0-0"]
    assert loans["self"] == {"vendor": "org.shelf", "name": "loans_change", "format": "jsonschema", "version": "1-0-0"}
    assert loans["properties"]["op"] == {"type": "string", "enum": ["c", "u", "d", "r"]}
    before = loans["properties"]["before"]
    assert before == loans["properties"]["after"] and before["type"] == ["object", "null"]
    assert before["required"] == ["branch", "copy_no", "out_on", "notes"]
    assert before["properties"] == {
        "branch": {"type": "integer"},
        "copy_no": {"type": "integer"},
        "out_on": {"type": "string", "format": "date"},
        "state": {"type": ["string", "null"], "enum": ["out", "back", "late", "lost", None]},
        "notes": {"type": "array", "items": {"type": "string"}},
        "fee": {"type": ["number", "null"]},
    }
    books = docs["schemas/org.shelf/books_change/jsonschema/1-0-0"]["properties"]["after"]
    assert books["properties"]["isbn"] == {"type": "string", "maxLength": 13} and books["properties"]["extra"] == {}
    for bare in ("archived", "visits"):
        assert "required" not in docs[f"schemas/org.shelf/{bare}_change/jsonschema/1-0-0"]["properties"]["after"]

    contract = scaffold.scaffold_contract(cat, "org.shelf")
    rows = contract.where("table_name = 'loans'").orderBy("col_pos").collect()
    assert [r.column for r in rows] == [c[0] for c in LIBRARY["loans"]]
    assert rows[0].primary_key == ["out_on", "branch", "copy_no"]
    assert rows[0].schema_uri == "iglu:org.shelf/loans_change/jsonschema/1-0-0"
    problems = {(r.path, r.message) for r in lint.lint_contract(contract).collect()}
    assert problems == {
        ("tables[public.readers].primary_key", lint.NO_KEY), ("tables[public.visits].primary_key", lint.NO_KEY),
        ("tables[public.archived].primary_key", lint.NO_KEY), ("tables[public.archived].columns", lint.NO_COLUMNS),
    }
    hints = {r.table_name: r.hint for r in scaffold.pk_hints(cat).collect()}
    assert hints["readers"] == "Candidate unique index(es): (card); (street, town); (phone)."
    assert hints["visits"].startswith("No unique index found") and sorted(hints) == ["archived", "readers", "visits"]


@pytest.mark.parametrize(
    "column, want",
    [
        (("c", "smallint", "int2"), {"type": "integer"}),
        (("c", "bigint", "int8", True), {"type": ["integer", "null"]}),
        (("c", "real", "float4"), {"type": "number"}),
        (("c", "boolean", "bool", True), {"type": ["boolean", "null"]}),
        (("c", "character varying", "varchar", True, 64), {"type": ["string", "null"], "maxLength": 64}),
        (("c", "date", "date", True), {"type": ["string", "null"], "format": "date"}),
        (("c", "uuid", "uuid"), {"type": "string", "format": "uuid"}),
        (("c", "json", "json", True), {}),
        (("c", "ARRAY", "_uuid"), {"type": "array", "items": {"type": "string", "format": "uuid"}}),
        (("c", "ARRAY", "_point", True), {"type": ["array", "null"], "items": {}}),
        (("c", "USER-DEFINED", "mood", True), {"type": ["string", "null"], "enum": ["ok", "so \"so\"", None]}),
        (("c", "USER-DEFINED", "unknown"), {}),
        (("c", "point", "point"), {}),
    ],
)
def test_types(spark, column, want):
    cat = _catalog(spark, {"t": [column]}, {}, [("mood", "so \"so\"", 2.0), ("mood", "ok", 1.0)])
    row = scaffold.json_type(columns_with_enums(cat)).first()
    assert json.loads(row.fragment) == want
    assert row.unmapped == (column[2] if column[2] in ("unknown", "point") else None)


def test_lint(spark):
    trim = ("trim",)
    contracts = [
        _contract(" ", "id", schema="\t"),
        _contract("a", "id", pk=()),
        _contract("b", pk=("id",)),
        _contract("c", ColumnSpec("id", exclude=True)),
        _contract("d", "id", ColumnSpec("x", "y"), "y", ColumnSpec("z", "y", exclude=True)),
        _contract("e", "id", uri="iglu:com.example/e/jsonschema/1-0"),
        _contract("f", ColumnSpec("id", transforms=trim), ColumnSpec("h", exclude=True, transforms=trim)),
        _contract("a", "id"),
        _contract("g", "id", uri="iglu:com.example/g/jsonschema/1-0-0\n"),
        _contract("fine", "id", ColumnSpec("x", transforms=trim)),
    ]
    got = sorted((r.path, r.message) for r in lint.lint_contract(contract_df(spark, contracts)).collect())
    assert got == sorted([
        ("tables[0].name", "must not be blank"),
        ("tables[0].schema", "must not be blank"),
        ("tables[1].primary_key", "must contain at least one column name"),
        ("tables[2].columns", "must contain at least one column"),
        ("tables[3].columns", "must contain at least one non-excluded column"),
        ("tables[4].columns", 'output property name "y" is produced by multiple columns: [x, y]'),
        ("tables[5].iglu_schema", lint.BAD_URI),
        ("tables[6].columns", 'primary-key column "id" cannot declare transforms — PK values feed the deterministic event_id'),
        ("tables[6].columns", 'column "h" is excluded; transforms would never run'),
        ("tables[8].iglu_schema", lint.BAD_URI),
        ("tables", "duplicate table public.a at indices [1, 7]"),
    ])


def test_observed_catalog_can_be_checked_for_drift(spark):
    columns = [*COLUMNS, ("at", "int64", "io.debezium.time.MicroTimestamp", True)]
    parsed = parse(feed(spark, [envelope("c"), envelope("c", columns=columns)]))
    seen = observed_columns(parsed)
    assert [(r.name, r.data_type) for r in seen.orderBy("ordinal").collect()] == [
        ("id", "integer"), ("customer_id", "integer"), ("status", "text"), ("total", "text"),
        ("at", "timestamp without time zone"),
    ]
    empty = _frames(spark, {"x": [("a", "text", "text")]}, {"orders": "f"})
    cat = catalog_of(seen, *empty[1:])
    contract = contract_df(spark, [_contract("orders", "id", "status", "totl", ColumnSpec("at", transforms=("trim",)))])
    kinds = sorted((r.kind, r.column, r.detail) for r in drift.findings(contract, cat).collect())
    assert kinds == [
        ("extra_column", "customer_id", "integer"), ("extra_column", "total", "text"), ("missing_column", "totl", "total"),
        ("transform_type", "at", "timestamp without time zone"),
    ]


def test_catalog_is_asked_for_the_tables_only():
    from rowtide.sources import catalog

    tables = [("public", "o'rders"), ("public", "a"), ("public", "a")]
    for name in ("columns", "identities", "attributes", "indexes"):
        (sql,) = catalog.catalog_queries(name, tables)
        assert sql.endswith("in (('public', 'a'), ('public', 'o''rders'))")
        assert ("'BASE TABLE'" if name == "columns" else "t.relkind in ('r', 'p')") in sql
        many = [("public", f"t{i}") for i in range(2 * catalog.TABLES_PER_QUERY + 1)]
        assert len(catalog.catalog_queries(name, many)) == 3
        assert catalog.catalog_queries(name, [])[0].endswith("and false")
        assert " in (('" not in catalog.catalog_queries(name)[0]
    assert catalog.catalog_queries("enums", tables) == catalog.catalog_queries("enums")


def test_drift_joins_contract_and_catalog_once(spark, sf):
    from rowtide.plans.queries import REGISTRY

    for name in ("drift_lines", "drift_summary", "drift_ok_tables"):
        plan = REGISTRY[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join") <= 4, name
