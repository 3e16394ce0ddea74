import random

import pytest
from envelopes import envelope, feed

from rowtide.operators.envelope import parse
from rowtide.operators.schema_version import property_snapshots, schema_versions

ID, MAIL, TOTAL = ("id", "int64", None, False), ("mail", "string", None, True), ("total", "int32", None, True)


def _told(df):
    return [(r.seq, r.version, r.change) for r in df.orderBy("seq").collect()]


@pytest.mark.parametrize(
    "after, change, named",
    [
        ([ID, MAIL, TOTAL, ("note", "string", None, True)], "addition", {"added": ["note"]}),
        ([ID, MAIL, TOTAL, ("note", "string", None, False)], "revision", {"added": ["note"]}),
        ([ID, MAIL], "model", {"dropped": ["total"]}),
        ([ID, MAIL, ("total", "string", None, True)], "model", {"retyped": ["total"]}),
        ([ID, MAIL, ("total", "double", None, True)], "addition", {"widened": ["total"]}),
        ([ID, MAIL, ("total", "int64", None, True)], "addition", {}),
        ([ID, ("mail", "string", "io.debezium.data.Uuid", True), TOTAL], "model", {"retyped": ["mail"]}),
        ([ID, ("mail", "string", None, False), TOTAL], "revision", {"tightened": ["mail"]}),
        ([("id", "int64", None, True), MAIL, TOTAL], "addition", {"loosened": ["id"]}),
        ([TOTAL, MAIL, ID], "addition", {}),
        ([ID, ("post", "string", None, True), TOTAL], "model", {"added": ["post"], "dropped": ["mail"]}),
        ([], "model", {"dropped": ["id", "mail", "total"]}),
    ],
)
def test_kinds_of_change(spark, after, change, named):
    values = [envelope(columns=[ID, MAIL, TOTAL]), envelope(columns=[ID, MAIL, TOTAL]), envelope(columns=after)]
    rows = schema_versions(property_snapshots(parse(feed(spark, values)))).orderBy("seq").collect()
    assert [(r.seq, r.change) for r in rows] == [(0, "first"), (2, change)]
    assert rows[1].version == {"model": "2-0-0", "revision": "1-1-0", "addition": "1-0-1"}[change]
    lists = ("added", "dropped", "retyped", "widened", "tightened", "loosened")
    assert {k: rows[1][k] for k in lists} == {k: named.get(k, []) for k in lists}
    assert all(rows[0][k] == [] for k in lists)


def test_odd_blocks(spark):
    twice = [ID, MAIL, ("mail", "int32", None, True)]
    values = ["no json", envelope(columns=twice), envelope(has_after_schema=False), envelope(columns=[ID, MAIL]), None,
              envelope(columns=[(None, None, None, None)])]
    assert [t[1:] for t in _told(schema_versions(property_snapshots(parse(feed(spark, values)))))][0] == ("1-0-0", "first")
    assert schema_versions(property_snapshots(parse(feed(spark, values[:1])))).count() == 0


def _loop(rows):
    last, number, out = {}, {}, []
    for seq, table, cols in sorted(rows):
        if table not in last:
            out.append((table, seq, "1-0-0", "first"))
            number[table] = [1, 0, 0]
        elif last[table] != cols:
            was, now = dict(last[table]), dict(cols)
            if was.keys() - now.keys():
                level = 0
            elif any(was.get(c, True) and not now[c] for c in now):
                level = 1
            else:
                level = 2
            n = number[table]
            n[level] += 1
            n[level + 1 :] = [0] * (2 - level)
            out.append((table, seq, "-".join(map(str, n)), ("model", "revision", "addition")[level]))
        last[table] = cols
    return sorted(out)


@pytest.mark.parametrize("stretches", [(), (5,), (40, 300), (1 << 16, 1 << 34)])
def test_numbers_equal_a_loop_over_any_cut(spark, stretches):
    rnd, rows, seq = random.Random(3), [], 0
    for _ in range(500):
        seq += rnd.choice([1, 1, 2, 30])
        # One table has most of the records and flaps at times.
        table = rnd.choice(["hot"] * 6 + ["a", "b"])
        cols = tuple((c, rnd.random() < 0.7) for c in "xyz" if rnd.random() < 0.9)
        calm = [c for s, t, c in rows if t == table]
        rows.append((seq, table, calm[-1] if calm and rnd.random() < 0.5 else cols))
    data = [(s, "p", t, str(c), [(n, "string", "", null) for n, null in c]) for s, t, c in rows]
    schema = ("seq long, table_schema string, table_name string, column_fingerprint string, "
              "properties array<struct<field:string,kind:string,form:string,nullable:boolean>>")  # fmt: skip
    got = schema_versions(spark.createDataFrame(data, schema), stretches).collect()
    assert sorted((r.table_name, r.seq, r.version, r.change) for r in got) == _loop(rows)
