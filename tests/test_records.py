import hashlib
import json

import pytest
from envelopes import COLUMNS, ROW, envelope, feed
from pyspark.sql import functions as F

from rowtide.contract import ColumnSpec, TableContract
from rowtide.operators import accounting
from rowtide.operators.assemble import dedup, events, records, rejected, to_wire
from rowtide.operators.control import drop_control, include_tables
from rowtide.operators.envelope import parse, with_fingerprint
from rowtide.sources.feed import snapshot_feed, with_snapshot

URI = "iglu:com.example/orders_change/jsonschema/1-0-0"
ORDERS = TableContract("public", "orders", URI, ("id",), ("id", "customer_id", "status", "total"))
CUSTOMERS = TableContract(
    "public", "customers", "iglu:com.example/c/jsonschema/1-0-0", ("id",),
    ("id", ColumnSpec("email", "emailAddress", transforms=("trim", "lowercase")), "full_name",
     ColumnSpec("password_hash", exclude=True)),
)
CONTRACTS = [ORDERS, CUSTOMERS]


@pytest.fixture(params=[10_000, 0], ids=["inline", "joined"])
def inline(request):
    return request.param


def _payloads(spark, values, contracts=CONTRACTS, inline=10_000):
    recs = records(feed(spark, values), contracts, inline_columns=inline)
    return {r.seq: (r.payload, r.drop_reason) for r in recs.collect()}


def test_payload_has_only_the_sides_of_its_operation(spark, inline):
    old = {**ROW, "status": "new"}
    got = _payloads(
        spark,
        [envelope("c"), envelope("u", before=old), envelope("d", before=old, after=None), envelope("r", snapshot="true")],
        inline=inline,
    )
    row = json.dumps(ROW, separators=(",", ":"))
    was = json.dumps(old, separators=(",", ":"))
    assert [got[i][0] for i in range(4)] == [
        f'{{"op":"c","after":{row}}}',
        f'{{"op":"u","before":{was},"after":{row}}}',
        f'{{"op":"d","before":{was}}}',
        f'{{"op":"r","after":{row}}}',
    ]


def test_reasons_in_order(spark, inline):
    number = {"id": 1, "email": 5, "full_name": "x", "password_hash": "y"}
    text = {**number, "email": "A"}
    c = {"table": "customers"}
    cases = [
        ("not json", "unparseable"),
        ('{"schema": {', "unparseable"),
        ("", "missing_after_schema"),
        ("   ", "missing_after_schema"),
        ("123", "missing_after_schema"),
        ("[1]", "missing_after_schema"),
        ('[{"schema":{"fields":[{"field":"after","fields":[]}]}}]', "missing_after_schema"),
        ("{}", "missing_after_schema"),
        (envelope("c", has_after_schema=False), "missing_after_schema"),
        (envelope("c", has_after_schema=False, table="nope"), "missing_after_schema"),
        (envelope("c", table="nope"), "unconfigured_table"),
        (envelope("t", after=None, table="nope"), "unconfigured_table"),
        (envelope("c", after=number, **c), "transform_type"),
        (envelope("t", before=number, after=None, **c), "transform_type"),
        (envelope("u", before=number, after=text, **c), "transform_type"),
        (envelope("c", after={**text, "email": {"a": 1}}, **c), "transform_type"),
        (envelope("t", after=None), "unsupported_op"),
        (envelope("m"), "unsupported_op"),
        (envelope(None), "unsupported_op"),
        (envelope("c", after=None), "missing_image"),
        (envelope("c", after=[1]), "missing_image"),
        (envelope("c", after="row"), "missing_image"),
        (envelope("u"), "missing_image"),
        (envelope("u", before=ROW, after=None), "missing_image"),
        (envelope("d", after=ROW), "missing_image"),
        (envelope("c", after={**text, "email": None}, **c), None),
        (envelope("c", after={"id": 1}, **c), None),
        (envelope("c") + " trailing", None),
    ]
    got = _payloads(spark, [v for v, _ in cases], inline=inline)
    assert [got[i][1] for i in range(len(cases))] == [want for _, want in cases]


def test_projection_and_chain(spark, inline):
    row = {"password_hash": "x", "full_name": None, "email": "  A@B.C ", "id": 7, "extra": 1}
    got = _payloads(spark, [envelope("u", before=row, after={"id": 7}, table="customers")], inline=inline)
    assert got[0][0] == (
        '{"op":"u","before":{"id":7,"emailAddress":"a@b.c","full_name":null},'
        '"after":{"id":7,"emailAddress":null,"full_name":null}}'
    )


def test_numbers_keep_their_form(spark, inline):
    names = ("id", "f", "g", "h", "big", "b", "n", "o")
    contract = TableContract("public", "orders", URI, ("id", "f"), names)
    value = envelope("c", after={"id": 1, "f": 1.0, "g": 1e10, "h": 0.5, "big": 12345678901234567890, "b": True, "o": {"y": 1, "x": "z"}})
    recs = records(feed(spark, [value]), [contract], inline_columns=inline, with_names=True).first()
    assert recs.payload == (
        '{"op":"c","after":{"id":1,"f":1.0,"g":1.0E10,"h":0.5,"big":12345678901234567890,"b":true,"n":null,'
        '"o":{"x":"z","y":1}}}'
    )
    assert '"pk":{"f":1.0,"id":1}' in recs.canonical_name
    assert recs.pk == '{"id":1,"f":1.0}'


def test_lineage(spark):
    got = records(
        feed(spark, [
            envelope("c", snapshot="incremental", txId="ABSENT", lsn=None),
            envelope("c", snapshot="ABSENT", lsn="12", txId="7", ts_ms="ABSENT", schema="", db="ABSENT"),
            envelope("c", snapshot=None, lsn=2.0),
        ]),
        [*CONTRACTS, TableContract("", "orders", URI, ("id",), ("id",))],
    ).orderBy("seq").collect()
    text = "\n".join(f"{n}\t{k}\t{lg or ''}\t{str(o).lower()}" for n, k, lg, o in COLUMNS)
    print_ = hashlib.sha256(text.encode()).hexdigest()
    a, b, c = (r.cdc_source for r in got)
    assert a.asDict() == {
        "connector": "postgres", "db": "sales_db", "schema": "public", "table": "orders", "lsn": None, "txid": None,
        "is_snapshot": True, "ts_ms": 1714400000000, "column_fingerprint": print_,
    }
    assert (b.schema, b.db, b.lsn, b.txid, b.is_snapshot, b.ts_ms) == (None, "", None, None, False, 0)
    assert (c.lsn, c.is_snapshot) == ("0/2", False)
    assert got[1].drop_reason is None


def test_fingerprint_reacts_to_every_part(spark):
    def change(i, part):
        c = list(COLUMNS[i])
        c[part[0]] = part[1]
        return [*COLUMNS[:i], tuple(c), *COLUMNS[i + 1 :]]

    layouts = [
        COLUMNS, COLUMNS[:-1], COLUMNS[::-1], change(0, (1, "int64")), change(0, (2, "io.debezium.time.Date")),
        change(0, (3, True)), change(0, (0, "key")), [],
    ]
    got = with_fingerprint(parse(feed(spark, [envelope("c", columns=x) for x in layouts]))).orderBy("seq").collect()
    prints = [r.column_fingerprint for r in got]
    assert len(set(prints)) == len(layouts)
    assert prints[-1] == hashlib.sha256(b"").hexdigest()
    assert got[0].column_names == ["id", "customer_id", "status", "total"]


def test_defaults_of_the_schema_block(spark):
    loose = {"schema": {"fields": [{"field": "after", "fields": [{"field": "a", "type": "t"}]}]}, "payload": {}}
    strict = {"schema": {"fields": [{"field": "after", "fields": [{"field": "a", "type": "t", "optional": True, "name": ""}]}]}, "payload": {}}
    bare = {"schema": {"fields": [{"field": "x"}, {"field": "after"}]}}
    odd = {"schema": {"fields": [7, {"field": "after", "fields": [{"field": "a", "type": "t", "optional": "true"}]}]}}
    rows = with_fingerprint(parse(feed(spark, [json.dumps(x) for x in (loose, strict, bare, odd)]))).orderBy("seq").collect()
    assert rows[0].column_fingerprint == rows[1].column_fingerprint == rows[3].column_fingerprint
    assert rows[2].column_names == [] and rows[2].column_fingerprint == hashlib.sha256(b"").hexdigest()


def test_repeated_key_keeps_the_last(spark):
    value = envelope("c").replace('"op": "c"', '"op": "x", "op": "c"')
    assert records(feed(spark, [value]), CONTRACTS).first().op == "c"


def test_ids_fold_replays_only(spark):
    values = [envelope("c"), envelope("c"), envelope("c", lsn=1), envelope("c", txId=1), envelope("u", before=ROW),
              envelope("c", after={**ROW, "id": 43}), envelope("c", after={**ROW, "total": "1"}),
              envelope("c", ts_ms=5)]
    evts = events(records(feed(spark, values), CONTRACTS))
    ids = [r.event_id for r in evts.orderBy("seq").collect()]
    assert ids[0] == ids[1] == ids[6] == ids[7] and len(set(ids)) == 5
    once = dedup(evts)
    assert sorted(r.seq for r in once.collect()) == [0, 2, 3, 4, 5]
    assert dedup(once).count() == 5
    assert once.columns == evts.columns


def test_delete_takes_its_key_from_before(spark):
    got = records(feed(spark, [envelope("d", before={**ROW, "id": 9}, after=None)]), CONTRACTS, with_names=True).first()
    assert got.pk == '{"id":9}'


def test_control_records_are_not_counted(spark):
    rows = [(0, "d", None, None), (1, "__debezium-heartbeat.x", None, "{}"), (2, None, None, envelope("c")),
            (3, "d", None, "junk"), (4, "x__debezium-heartbeat", None, envelope("t"))]
    f = spark.createDataFrame(rows, "seq bigint, destination string, key string, value string")
    assert [r.seq for r in drop_control(f).orderBy("seq").collect()] == [2, 3, 4]
    recs = records(f, CONTRACTS)
    assert accounting.flow_totals(recs).first().asDict() == {"received": 3, "emitted": 1, "dropped": 2}
    assert sorted((r.seq, r.drop_reason, r.value) for r in rejected(recs).collect())[0] == (3, "unparseable", "junk")


def test_include_tables(spark):
    parsed = parse(feed(spark, [envelope("c"), envelope("c", table="nope"), envelope("c", schema="x")]))
    assert [r.seq for r in include_tables(parsed, CONTRACTS).collect()] == [0]


def test_wire_form(spark):
    import base64

    row = to_wire(events(records(feed(spark, [envelope("c")]), CONTRACTS, app_id="shop")), context_uri="iglu:x/y/jsonschema/1-0-0").first()
    body = json.loads(base64.b64decode(row.ue_px, validate=True))
    assert body["data"]["schema"] == URI and body["data"]["data"] == {"op": "c", "after": ROW}
    context = json.loads(base64.b64decode(row.cx, validate=True))["data"]
    assert len(context) == 1 and context[0]["schema"] == "iglu:x/y/jsonschema/1-0-0"
    assert list(context[0]["data"]) == ["connector", "db", "schema", "table", "lsn", "txid", "is_snapshot", "ts_ms", "column_fingerprint"]
    assert (row.aid, row.ttm) == ("shop", "1714400000000")


def test_app_id_per_table_is_an_option(spark):
    own = TableContract("public", "orders", URI, ("id",), ("id",), app_id="own")
    f = feed(spark, [envelope("c")])
    assert records(f, [own], app_id="svc").first().app_id == "svc"
    for inline in (0, 100):
        assert records(f, [own], app_id="svc", per_table_app_id=True, inline_columns=inline).first().app_id == "own"


def test_routers_agree_on_many_tables(spark):
    contracts = [
        TableContract("s", f"t{i}", f"iglu:a/t{i}/jsonschema/1-0-0", ("id", "k"),
                      ("id", ColumnSpec("v", f"v{i}", transforms=("trim", {"regex_extract": {"pattern": f"([{i % 10}x]?)y", "group": 1}})), "k"))
        for i in range(40)
    ]
    values = [envelope("c", after={"id": i, "k": i * 0.5, "v": f" {i}y "}, schema="s", table=f"t{i}") for i in range(45)]
    f = feed(spark, values)
    a = records(f, contracts, inline_columns=10_000, with_names=True).drop("cdc_source")
    b = records(f, contracts, inline_columns=0, with_names=True).drop("cdc_source")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.where("drop_reason is null").count() == 40


def test_envelopes_are_parsed_once_and_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "feed")
    feed(spark, [envelope("c")]).write.parquet(path)
    plan = events(records(spark.read.parquet(path), CONTRACTS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    assert "Exchange" not in plan and "Join" not in plan
    assert "PushedFilters: [IsNotNull(value)]" in plan


def test_snapshot_rows_become_reads(spark):
    import datetime
    from decimal import Decimal

    rows = [(1, Decimal("9.50"), datetime.date(1970, 1, 3), None)]
    df = spark.createDataFrame(rows, "id int, total decimal(10,2), day date, note string")
    snap = snapshot_feed(df, db="d", schema="public", name="orders", primary_key=["id"], lsn=5, ts_ms=1000)
    contract = TableContract("public", "orders", URI, ("id",), ("id", "total", "day", "note"))
    got = records(snap, [contract]).first()
    assert got.payload == '{"op":"r","after":{"id":1,"total":"9.50","day":2,"note":null}}'
    assert got.cdc_source.is_snapshot and got.cdc_source.lsn == "0/5" and got.seq < 0
    live = feed(spark, [envelope("c")])
    sizes = {m: with_snapshot(live, snap, m).count() for m in ("never", "initial", "initial_only", "when_needed")}
    assert sizes == {"never": 1, "initial": 2, "initial_only": 1, "when_needed": 2}
    assert with_snapshot(live, snap, "when_needed", has_offsets=True).count() == 1
    with pytest.raises(ValueError):
        with_snapshot(live, snap, "always")


def test_heartbeat_against_a_loop(spark):
    import random

    rnd = random.Random(5)
    values = [
        envelope("c", ts_ms=1714400000000 + rnd.randrange(0, 40_000_000), table=rnd.choice(["orders", "nope"]), lsn=i)
        for i in range(300)
    ]
    recs = records(feed(spark, values), CONTRACTS)
    accounting_stretch = accounting.STRETCH
    try:
        accounting.STRETCH = 7
        beats = accounting.heartbeat(recs, "60 seconds").orderBy("window_end").collect()
        one = accounting.heartbeat(recs, "60 seconds", ["public.customers"]).orderBy("window_end").collect()
        by_table = accounting.heartbeat_by_table(recs, "60 seconds").orderBy("window_end").collect()
    finally:
        accounting.STRETCH = accounting_stretch
    rows = [(json.loads(v)["payload"]["source"]["ts_ms"] // 60000, "nope" not in v) for v in values]
    ticks = sorted({t for t, _ in rows})
    want = []
    for t in ticks:
        ok = sum(1 for u, good in rows if u <= t and good)
        total = sum(1 for u, _ in rows if u <= t)
        want.append((total, ok, total - ok, (t - ticks[0] + 1) * 60))
    assert [(b.received, b.emitted, b.dropped, b.uptime_seconds) for b in beats] == want
    assert beats[-1].per_table == json.dumps({"public.orders": {"c": want[-1][1]}}, separators=(",", ":"))
    assert by_table[-1].n == want[-1][1]
    assert [b.received for b in one] == [b.received for b in beats] and {b.per_table for b in one} == {"{}"}
    for b, t in zip(beats, ticks, strict=True):
        n = sum(1 for u, good in rows if u <= t and good)
        assert json.loads(b.per_table) == ({"public.orders": {"c": n}} if n else {})
    assert recs.where(F.col("drop_reason").isNull()).count() == want[-1][1]


def test_landed_feed_gives_the_same_records(spark, tmp_path):
    from rowtide.sources.landing import land, read_landed

    values = [
        envelope("c", after={**ROW, "total": 1.0}), envelope("u", before=ROW), envelope("d", before=ROW, after=None),
        envelope("c", table="nope"), envelope("c", has_after_schema=False), "junk", None, envelope("t", after=None),
    ]
    f = feed(spark, values)
    land(f, str(tmp_path / "landed"))
    landed = records(read_landed(spark, str(tmp_path / "landed")), CONTRACTS)
    direct = records(f, CONTRACTS)
    keep = direct.columns
    assert sorted(map(str, landed.select(*keep).collect())) == sorted(map(str, direct.select(*keep).collect()))
    assert landed.where("drop_reason is not null and value is null").isEmpty()
    assert landed.where("drop_reason = 'unparseable'").first().value == "junk"
    one = read_landed(spark, str(tmp_path / "landed"), [("public", "nope")])
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "source_table" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_heartbeats_of_many_tables_against_a_loop(spark):
    import random
    from collections import defaultdict

    rnd = random.Random(8)
    names = ["orders", 'qu"ote', "a b", "z"]
    contracts = [TableContract("public", n, "iglu:com.example/x/jsonschema/1-0-0", ("id",), ("id",)) for n in names[:3]]
    values = [
        envelope(rnd.choice("cr"), ts_ms=1714400000000 + rnd.randrange(0, 9_000_000), table=rnd.choice(names), lsn=i)
        for i in range(200)
    ]
    recs = records(feed(spark, values), contracts)
    before = accounting.STRETCH
    try:
        accounting.STRETCH = 5
        beats = accounting.heartbeat(recs, "60 seconds").orderBy("window_end").collect()
    finally:
        accounting.STRETCH = before
    rows = []
    for v in values:
        p = json.loads(v)["payload"]
        rows.append((p["source"]["ts_ms"] // 60000, p["source"]["table"], p["op"]))
    ticks = sorted({t for t, _, _ in rows})
    assert len(beats) == len(ticks)
    for b, t in zip(beats, ticks, strict=True):
        want = defaultdict(lambda: defaultdict(int))
        for u, table, op in rows:
            if u <= t and table != "z":
                want[f"public.{table}"][op] += 1
        assert json.loads(b.per_table) == want
        assert b.received == sum(u <= t for u, _, _ in rows)


def test_heartbeats_read_the_feed_once(spark, sf):
    from rowtide.plans.queries import REGISTRY

    for name in ("heartbeat_windows", "heartbeat_by_table"):
        plan = REGISTRY[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1 and plan.count("FileScan") == 1, name


def test_bad_transforms_are_refused_before_the_first_row(spark):
    from rowtide.contract import ColumnSpec, ContractError, check_patterns

    def contract(**t):
        ((name, params),) = t.items()
        columns = ("id", ColumnSpec("status", transforms=({name: params},)))
        return TableContract("public", "orders", "iglu:com.example/o/jsonschema/1-0-0", ("id",), columns)

    bad = [
        {"regex_replace": {"pattern": "(a)", "replacement": "$2"}}, {"regex_replace": {"pattern": "a", "replacement": "$"}},
        {"regex_replace": {"pattern": "a", "replacement": "x\\"}}, {"regex_replace": {"pattern": "(a", "replacement": ""}},
        {"regex_replace": {"pattern": "(?<n>a)", "replacement": "${m}"}}, {"regex_extract": {"pattern": "(?:a)", "group": 1}},
        {"regex_extract": {"pattern": r"[(]\Q(\E\(", "group": 1}},
    ]
    good = [
        {"regex_replace": {"pattern": "(a)", "replacement": "$1$0\\$"}}, {"regex_replace": {"pattern": "(?<n>a)", "replacement": "${n}"}},
        {"regex_replace": {"pattern": "((a)|b)", "replacement": "$21"}}, {"regex_extract": {"pattern": "(?<!x)(a)", "group": 1}},
    ]
    f = feed(spark, [envelope("c", after={**ROW, "status": "aab"})])
    for inline in (0, 1000):
        for t in bad:
            with pytest.raises(ContractError):
                records(f, [contract(**t)], inline_columns=inline)
        for t in good:
            assert records(f, [contract(**t)], inline_columns=inline).where("drop_reason is null").count() == 1
    assert len(check_patterns(spark, [contract(**t) for t in [*bad, *good]])) == len(bad)


def test_snapshot_is_taken_once(spark):
    snap, live = feed(spark, ["s"]), feed(spark, ["l"])
    sizes = {m: with_snapshot(live, snap, m, has_offsets=True).count() for m in ("never", "initial", "initial_only", "when_needed")}
    assert sizes == {"never": 1, "initial": 1, "initial_only": 0, "when_needed": 1}


def test_contracts_as_rows_give_the_same_records(spark, monkeypatch):
    from rowtide.contract import ColumnSpec, ContractError, contract_df
    from rowtide.operators import project

    twice = TableContract(
        "public", "twice", "iglu:com.example/t/jsonschema/1-0-0", ("b", "a", "b"),
        (ColumnSpec("a", rename="x"), "id", ColumnSpec("b", rename="x", transforms=("trim",)), ColumnSpec("c", exclude=True)), app_id="own",
    )
    bare = TableContract("public", "bare", "iglu:com.example/b/jsonschema/1-0-0", (), ())
    contracts = [*CONTRACTS, twice, bare]
    values = [
        envelope("c", after={**ROW, "total": 1.0}), envelope("u", before=ROW), envelope("d", before=ROW, after=None),
        envelope("c", table="nope"), envelope("c", has_after_schema=False), "junk", None, envelope("c", table="bare"),
        envelope("c", table="twice", after={"a": "1", "id": 3, "b": " q ", "c": "z"}), envelope("c", table="twice", after={"b": 4}),
    ]
    f = feed(spark, values)
    want = sorted(map(str, records(f, contracts, per_table_app_id=True, with_names=True).collect()))
    rows = contract_df(spark, contracts)
    assert sorted(map(str, records(f, rows, per_table_app_id=True, with_names=True).collect())) == want
    monkeypatch.setattr(project, "BROADCAST_BYTES", 0)
    salted = records(f, contracts, inline_columns=0, per_table_app_id=True, with_names=True)
    assert sorted(map(str, salted.collect())) == want
    columns = (ColumnSpec("id", transforms=({"regex_replace": {"pattern": "(a)", "replacement": "$2"}},)),)
    with pytest.raises(ContractError):
        records(f, contract_df(spark, [TableContract("s", "t", "u", ("id",), columns)]))
