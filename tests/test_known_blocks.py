import json

from envelopes import COLUMNS, ROW, block, envelope, feed
from pyspark.sql import functions as F

from rowtide.contract import TableContract
from rowtide.operators.assemble import records
from rowtide.operators.envelope import parse, schema_snapshots, with_fingerprint
from rowtide.operators.schema_version import block_snapshots, property_snapshots, schema_versions

ORDERS = TableContract("public", "orders", "iglu:com.example/orders/jsonschema/1-0-0", ("id",), ("id", "status"))
WIDER = [*COLUMNS, ("größe", "int64", "io.debezium.time.Timestamp", None), ("", "string", None, True)]


def _compact(text):
    return json.dumps(json.loads(text), separators=(",", ":"), ensure_ascii=False)


def _block(*args):
    return json.dumps(block(*args), separators=(",", ":"), ensure_ascii=False)


VALUES = [_compact(v) for v in (
    envelope("c"), envelope("u", before=ROW, after={**ROW, "status": "ö€𝄞"}), envelope("c", columns=WIDER),
    envelope("c", columns=COLUMNS[:2]), envelope("c", has_after_schema=False), envelope("d", before=ROW, after=None),
    envelope("c", lsn="text"), envelope("c", after=[1]),
)]
KNOWN = [_block(COLUMNS), _block(WIDER), _block(COLUMNS, False)]
ODD = [
    VALUES[0][:-1] + ',"schema":' + _block(COLUMNS[:1]) + "}",  # a block told again holds
    VALUES[0][:-3], VALUES[0].replace('"payload":{', '"payload":[{'), '{"schema":' + KNOWN[0] + ',"payload":null}',
    '{"schema":' + KNOWN[0] + "}", "junk",
]


def _rows(df):
    return sorted(map(str, df.collect()))


def test_known_blocks_change_nothing(spark):
    f = feed(spark, VALUES + ODD)
    plain, told = parse(f), parse(f, known=KNOWN)
    assert told.where(F.col("known_block").isNotNull()).count() >= 6
    assert _rows(told.select(*plain.columns)) == _rows(plain)
    assert _rows(with_fingerprint(told, KNOWN)) == _rows(with_fingerprint(plain))
    assert _rows(schema_snapshots(told, KNOWN)) == _rows(schema_snapshots(plain))
    assert _rows(records(f, [ORDERS], known=KNOWN)) == _rows(records(f, [ORDERS]))


def test_records_without_blocks(spark):
    f = feed(spark, VALUES + ODD)
    block_says = ["cdc_source", "column_fingerprint", "column_names"]
    whole = records(f, [ORDERS])
    for known in ((), KNOWN):
        lean = records(f, [ORDERS], with_blocks=False, known=known)
        assert _rows(lean.drop(*block_says)) == _rows(whole.drop(*block_says))
        assert lean.where("column_fingerprint is not null or cdc_source.column_fingerprint is not null").isEmpty()
        assert "optional:boolean" not in lean._jdf.queryExecution().executedPlan().toString()


def test_blocks_that_spark_would_read_otherwise_are_not_known(spark):
    odd = KNOWN[0].replace('"optional":true', '"optional":"true"')
    twice = KNOWN[0].replace('"type":"struct"', '"type":"struct","type":"struct"', 1)
    f = feed(spark, [VALUES[0].replace(KNOWN[0], b) for b in (odd, twice)])
    assert "known_block" not in parse(f, known=[odd, twice, "no block"]).columns
    assert _rows(parse(f, known=[odd, twice, "no block"])) == _rows(parse(f))


def test_versions_of_blocks(spark):
    f = feed(spark, [VALUES[0], VALUES[2], VALUES[0], VALUES[4], VALUES[3]])
    told = schema_versions(block_snapshots(parse(f, known=KNOWN), KNOWN))
    assert _rows(told) == _rows(schema_versions(property_snapshots(parse(f))))


def test_without_images_the_rest_is_the_same(spark):
    values = [
        envelope("c", txId=5, lsn=10), envelope("d", txId="x", lsn=12), "not json", "[1]", '{"payload":{"op":"c","before":7,"after":[1]}}',
        '{"payload":{"op":"u","after":{"id":{"a":[1,{"b":"}"}]}},"source":{"table":"t","lsn":3}}}', '{"payload":{"op":"c","after":{"id":}}}',
    ]
    whole, lean = parse(feed(spark, values)), parse(feed(spark, values), images=False)
    assert lean.columns == [c for c in whole.columns if c not in ("before", "after")]
    key = lambda r: r.seq
    assert sorted(lean.collect(), key=key) == sorted(whole.drop("before", "after").collect(), key=key)
