import pytest
from pyspark.sql import functions as F

from rowtide.contract import CellTransform, ColumnSpec, ContractError, TableContract, check_patterns
from rowtide.functions import kotlin_trim, lsn_text, name_uuid, regex_extract, slugify
from rowtide.functions.cells import apply_chain, apply_chain_rows


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def _apply(spark, text, *transforms):
    df = spark.createDataFrame([(text,)], "t string")
    chain = [CellTransform.of(t) for t in transforms]
    rows = [(c.name, c.pattern, c.group, c.replacement) for c in chain]
    kind = "array<struct<name:string,pattern:string,grp:int,replacement:string>>"
    df = df.withColumn("chain", F.lit(None).cast(kind)) if not rows else spark.createDataFrame(
        [(text, rows)], f"t string, chain {kind}"
    )
    inline = df.select(apply_chain(F.col("t"), chain).alias("x")).first().x
    if rows:
        assert df.select(apply_chain_rows(F.col("t"), F.col("chain")).alias("x")).first().x == inline
    return inline


EXTRACT = lambda p, g=1: {"regex_extract": {"pattern": p, "group": g}}
REPLACE = lambda p, r: {"regex_replace": {"pattern": p, "replacement": r}}


@pytest.mark.parametrize(
    "text, transforms, want",
    [
        ("  Alice@Example.COM  ", ["trim", "lowercase"], "alice@example.com"),
        ("AbA", [REPLACE("A", "X"), "lowercase"], "xbx"),
        ("AbA", ["lowercase", REPLACE("A", "X")], "aba"),
        ("alice@example.com", [REPLACE("^[^@]+@(.*)$", "***@$1")], "***@example.com"),
        ("alice@example.com", [EXTRACT("@(.+)$")], "example.com"),
        ("alice@example.com", [EXTRACT("@.+$", 0)], "@example.com"),
        ("alice", [EXTRACT("@(.+)$"), "uppercase"], None),
        (None, ["trim", "uppercase"], None),
        ("\t x 　\n", ["trim"], "x"),
        ("​", ["trim"], "​"),
        ("straße", ["uppercase"], "STRASSE"),
    ],
)
def test_chain(spark, text, transforms, want):
    assert _apply(spark, text, *transforms) == want


@pytest.mark.parametrize(
    "text, pattern, group, want",
    [
        ("b", "(a)?b", 1, None),
        ("ab", "(a)?b", 1, "a"),
        ("b", "(a*)b", 1, ""),
        ("b aba", "(a)?b", 1, None),
        ("xyz", "(a)|y", 1, None),
        ("xyz", "", 0, ""),
        ("xyz", "()y", 1, ""),
        ("ab", "(?:(x)|a)()b", 1, None),
        ("ab", "(?:(x)|a)()b", 2, ""),
        ("", "^$", 0, ""),
        ("aXb", "(?i)x(y)?", 1, None),
        ("😀user@", "@(.*)$", 1, ""),
        ("😀\n😀xaab", "(x?)b", 1, ""),
        ("é😀b", "(a)?b", 1, None),
    ],
)
def test_extract_tells_empty_from_absent(spark, text, pattern, group, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(regex_extract(F.col("t"), pattern, group).alias("x")).first().x == want


def test_trim_is_not_the_built_in(spark):
    df = spark.createDataFrame([("\t a \t",)], "t string")
    assert df.select(kotlin_trim(F.col("t")).alias("x")).first().x == "a"


@pytest.mark.parametrize(
    "text, want", [("OrderItems", "orderitems"), ("public_orders", "public-orders"), ("!!!", ""), ("-a--B c-", "a-b-c")]
)
def test_slug(spark, text, want):
    assert _one(spark, slugify(F.lit(text))) == want


@pytest.mark.parametrize("lsn, want", [(23000000, "0/15EF3C0"), (90000000000, "14/F46B0400"), (0, "0/0"), (-1, "FFFFFFFF/FFFFFFFF"), (None, None)])
def test_lsn(spark, lsn, want):
    assert _one(spark, lsn_text(F.lit(lsn).cast("bigint"))) == want


@pytest.mark.parametrize(
    "op, txid, want",
    [
        ("u", "123", "8172d518-4b02-5788-8da0-e5f65ecda71d"),
        ("r", "null", "c9fe6c8d-b3f5-52ad-a2e1-de5410177919"),
    ],
)
def test_pinned_ids(spark, op, txid, want):
    name = (
        f'{{"connector":"postgres","db":"orders_db","lsn":"0/16D5DC0","op":"{op}","pk":{{"id":42}},'
        f'"schema":"public","table":"orders","txid":{txid}}}'
    )
    assert _one(spark, name_uuid(F.lit(name))) == want


def test_every_variant_nibble(spark):
    import uuid

    namespace = uuid.UUID("8a1f4e5c-c0de-4cdc-a000-000000000001")
    rows = spark.range(200).select(F.concat(F.lit("näme"), F.col("id").cast("string")).alias("n"))
    for r in rows.select("n", name_uuid(F.col("n")).alias("u")).collect():
        assert r.u == str(uuid.uuid5(namespace, r.n))


@pytest.mark.parametrize(
    "entry",
    [
        "reverse",
        {"trim": {"x": 1}},
        "regex_extract",
        {"regex_extract": {"group": 1}},
        {"regex_extract": {"pattern": "a", "grup": 0}},
        {"regex_extract": {"pattern": "a", "group": -1}},
        {"regex_extract": {"pattern": "a", "group": "1"}},
        {"regex_extract": {"pattern": 1}},
        {"regex_replace": {"pattern": "a"}},
        {"regex_replace": {"pattern": "a", "replacement": 1}},
        {"trim": None, "lowercase": None},
        {},
        7,
    ],
)
def test_bad_transforms(entry):
    with pytest.raises(ContractError):
        ColumnSpec("email", transforms=(entry,))


def test_default_group_is_one():
    assert CellTransform.of({"regex_extract": {"pattern": "(a)"}}).group == 1
    assert CellTransform.of({"regex_extract": {"pattern": "(a)", "group": 0}}).group == 0
    assert CellTransform.of({"trim": {}}).name == "trim"


def test_patterns_are_checked_by_the_engine(spark):
    def contract(pattern, group):
        column = ColumnSpec("c", transforms=({"regex_extract": {"pattern": pattern, "group": group}},))
        return TableContract("s", "t", "iglu:a/b/jsonschema/1-0-0", ("id",), (column,))

    assert check_patterns(spark, [contract("(a)(b)", 2), contract("x", 0)]) == []
    assert len(check_patterns(spark, [contract("(a)", 2)])) == 1
    assert len(check_patterns(spark, [contract("(a", 1)])) == 1
