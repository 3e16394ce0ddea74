import random

import pytest
from envelopes import envelope, feed
from pyspark.sql import functions as F

from rowtide.contract import ColumnSpec, TableContract, contract_versions
from rowtide.operators import asof, project
from rowtide.operators.assemble import events, records, rejected


def _contract(minor, *columns, name="orders"):
    return TableContract("public", name, f"iglu:com.example/{name}/jsonschema/1-{minor}-0", ("id",), columns)


def _loop(rows, versions):
    out = []
    for key, at in rows:
        starts = sorted(s for k, s in versions if k == key and s is not None)
        if not starts:
            found = None
        elif at is None:
            found = starts[-1]
        else:
            found = max((s for s in starts if s <= at), default=None)
        out.append((key, at, found))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [asof.BROADCAST_BYTES, -1])
def test_versions_like_a_loop(spark, monkeypatch, limit):
    monkeypatch.setattr(asof, "BROADCAST_BYTES", limit)
    rng = random.Random(8)
    versions = [("hot", rng.randrange(-500, 10**6)) for _ in range(60)]
    versions += [("hot", 700_000 + i) for i in range(30)]  # many starts close to each other
    versions += [("once", 50), ("once", 50), ("wide", -(2**62)), ("wide", 2**62), ("none", None)]
    rows = [("hot", rng.randrange(-1000, 10**6 + 10)) for _ in range(400)] + [("hot", s) for k, s in versions if k == "hot"]
    rows += [(k, at) for k in ("once", "wide", "none", "other", None) for at in (None, 49, 50, 51, -(2**62), 2**62, 2**62 - 1, -(2**63), 2**63 - 1)]
    rows += [("hot", None)] * 3
    left = spark.createDataFrame(rows, "k string, at bigint").repartition(4)
    right = spark.createDataFrame(versions, "k string, start bigint")
    got = asof.as_of(left, right, ["k"], "at", "start")
    assert got.columns == ["k", "at", "start"]
    assert sorted(map(tuple, got.collect()), key=repr) == _loop(rows, versions)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("piece", [3, 4096])
def test_a_long_interval_is_told_in_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(asof, "PIECE", piece, raising=False)
    # The first version of "long" holds over nearly all of the line, the others lie close to each other behind it.
    versions = [("long", -(10**9)), *(("long", 10**9 + 3 * i) for i in range(40)), ("brief", 7), ("brief", 9), ("brief", 30)]
    rows = [(k, at) for k, s in versions for at in (s - 1, s, s + 1)] + [("long", n * 10**7) for n in range(-100, 101)]
    rows += [("long", None), ("brief", -(10**12)), ("other", 5), (None, 5)]
    left, right = spark.createDataFrame(rows, "k string, at bigint"), spark.createDataFrame(versions, "k string, start bigint")
    got = asof.as_of(left, right, ["k"], "at", "start")
    assert sorted(map(tuple, got.collect()), key=repr) == _loop(rows, versions)


def test_no_array_holds_the_bins_of_a_long_interval(spark, monkeypatch):
    explode = F.explode

    def bounded(c):
        return explode(F.when(F.size(c) <= 200, c).otherwise(F.raise_error(F.lit("a long array"))))

    monkeypatch.setattr(asof, "PIECE", 64, raising=False)
    monkeypatch.setattr(asof.F, "explode", bounded)
    # The first version lies over 12,000 bins, eight for each version.
    versions = [("long", 0), *(("long", 10**12 + i) for i in range(1500))]
    rows = [("long", at) for at in (-1, 0, 10**11, 10**12 - 1, 10**12, 10**12 + 700)]
    left, right = spark.createDataFrame(rows, "k string, at bigint"), spark.createDataFrame(versions, "k string, start bigint")
    got = asof.as_of(left, right, ["k"], "at", "start")
    assert sorted(map(tuple, got.collect()), key=repr) == _loop(rows, versions)


def test_no_versions_and_one_version(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None)], "k string, at bigint")
    for starts, want in (([], {None}), ([("a", 2)], {None, 2}), ([("a", 0)], {0})):
        right = spark.createDataFrame(starts, "k string, start bigint")
        assert {r.start for r in asof.as_of(rows, right, ["k"], "at", "start").collect()} == want


VERSIONS = [
    (100, [_contract(0, "id", "status")]),
    (200, [_contract(1, "id", ColumnSpec("status", rename="state", transforms=("uppercase",)))]),
    (300, [_contract(2, "id"), _contract(0, "id", name="notes")]),
]


@pytest.mark.parametrize("limit", [project.BROADCAST_BYTES, 0])
def test_records_take_the_version_of_their_position(spark, monkeypatch, limit):
    monkeypatch.setattr(project, "BROADCAST_BYTES", limit)
    at = [99, 100, 199, 200, 250, 300, 10**15, None]
    values = [envelope("c", lsn=n) for n in at] + [envelope("c", lsn=299, table="notes"), envelope("c", lsn=300, table="notes")]
    values += ["not json", envelope("c", lsn=150, table="nobody")]
    recs = records(feed(spark, values), contract_versions(spark, VERSIONS))
    got = {r.seq: (r.schema_uri.split("/")[-1], r.payload) for r in events(recs).collect()}
    first, second, third = '{"id":7,"status":"open"}', '{"id":7,"state":"OPEN"}', '{"id":7}'
    wanted = {1: ("1-0-0", first), 2: ("1-0-0", first), 3: ("1-1-0", second), 4: ("1-1-0", second), 5: ("1-2-0", third),
              6: ("1-2-0", third), 7: ("1-2-0", third), 9: ("1-0-0", third)}
    assert got == {k: (v, '{"op":"c","after":' + row + "}") for k, (v, row) in wanted.items()}
    lost = {r.seq: r.drop_reason for r in rejected(recs).collect()}
    assert lost == {0: "unconfigured_table", 8: "unconfigured_table", 10: "unparseable", 11: "unconfigured_table"}
    plan = recs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and plan.count("from_json") <= 1


def test_one_version_is_the_same_as_plain_contracts(spark):
    values = [envelope("c", lsn=n) for n in (0, 5, None)] + [envelope("u", before={"id": 1, "status": 3}, lsn=7)]
    contract = _contract(0, "id", ColumnSpec("status", transforms=("trim",)))
    kept = ("seq", "event_id", "payload", "drop_reason", "schema_uri")
    plain = records(feed(spark, values), [contract]).select(*kept).collect()
    assert sorted(plain) == sorted(records(feed(spark, values), contract_versions(spark, [(0, [contract])])).select(*kept).collect())
    two = contract_versions(spark, [(0, [contract]), (0, [contract])])
    assert records(feed(spark, values), two).count() == len(values) and two.where(F.col("valid_from") == 0).count() == 4


def test_a_busy_last_version_is_not_gathered(spark, monkeypatch):
    from rowtide.operators.envelope import parse

    versions = contract_versions(spark, VERSIONS)
    names = ["orders", "orders", "notes"]
    f = feed(spark, [envelope("c", lsn=at, table=t) for at in (50, 100, 150, 200, 250, 300, 350, None) for t in names])
    want = sorted(map(str, records(f, versions).collect()))
    monkeypatch.setattr(project, "BROADCAST_BYTES", 1000)
    monkeypatch.setattr(asof, "BROADCAST_BYTES", 200)
    got = records(f, versions)
    assert sorted(map(str, got.collect())) == want
    # two rows with the last start of a table are broadcast, though the versions are not
    placed = asof.as_of(parse(f), versions, ["table_schema", "table_name"], "lsn_num", "valid_from")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1 and plan.count("Join LeftOuter") == 2
