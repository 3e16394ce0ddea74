import json
import random

from envelopes import envelope, feed

from rowtide.operators.envelope import parse
from rowtide.operators.infer import cell_kinds, landed_columns, merge_kinds
from rowtide.plans.feeds import customers_feed, line_items_feed
from rowtide.sources.catalog import observed_columns

ROWS = [
    {"id": 1, "n": 1, "m": 1, "s": "a", "mix": 1, "list": [1, 2], "doc": {"a": 1}, "gone": None, "flag": True, "late": 1},
    {"id": 2, "n": 2.5, "m": 1e300, "s": None, "mix": "x", "list": [], "doc": {"b": [1]}, "gone": None, "flag": False},
    {"id": 3, "n": 7, "m": 0.5, "s": "", "mix": True, "list": ["q"], "doc": {}, "gone": None, "flag": None, "odd": [{"a": 1}]},
    {"id": 4, "n": 0, "m": 2, "s": "z", "mix": 2, "list": None, "doc": [1], "gone": None, "flag": True},
]
WANT = {
    "id": ("bigint", "int8", False, None),
    "n": ("numeric", "numeric", False, None),
    "m": ("double precision", "float8", False, None),
    "s": ("text", "text", True, None),
    "mix": ("text", "text", False, "bigint|boolean|text"),
    "list": ("ARRAY", "_text", True, "array of bigint|text"),
    "doc": ("jsonb", "jsonb", False, "object|array"),
    "gone": ("unknown", "unknown", True, None),
    "flag": ("boolean", "bool", True, None),
    "late": ("bigint", "int8", True, None),
    "odd": ("ARRAY", "_jsonb", True, None),
}


def _bare(row, op="c", **source):
    e = json.loads(envelope(op, after=row, **source))
    del e["schema"]
    return json.dumps(e)


def _rows(df):
    return {r.name: (r.data_type, r.udt_name, r.is_nullable, r.conflict) for r in df.collect()}


def test_kinds_and_conflicts(spark):
    got = landed_columns(cell_kinds(parse(feed(spark, [_bare(r) for r in ROWS]))))
    assert _rows(got) == WANT
    order = [r.name for r in got.orderBy("ordinal").collect()]
    assert sorted(order) == sorted(WANT) and order[:3] == ["id", "n", "m"]


def test_merged_in_any_cut_and_order_equals_the_whole(spark):
    rng = random.Random(5)
    for _ in range(3):
        rows = rng.sample(ROWS, len(ROWS))
        cut = rng.randrange(1, len(rows))
        a, b = (cell_kinds(parse(feed(spark, [_bare(r) for r in part]))) for part in (rows[:cut], rows[cut:]))
        assert _rows(landed_columns(merge_kinds(b.unionByName(a).unionByName(a.limit(0))))) == WANT


def test_no_images_odd_records_and_schema_blocks(spark):
    values = [None, "not json", "{}", _bare(None), _bare({}), envelope("d", before=ROWS[0], after=None), envelope("c", after=ROWS[0])]
    kinds = cell_kinds(parse(feed(spark, values)), without_blocks=True)
    assert [(r.name, r.cells) for r in kinds.collect()] == [(None, 1)]  # the empty row
    assert landed_columns(kinds).count() == 0
    assert landed_columns(cell_kinds(parse(feed(spark, [])))).count() == 0
    assert landed_columns(cell_kinds(parse(feed(spark, values)))).where("is_nullable").count() == len(ROWS[0])


def test_equals_the_declared_catalog_where_both_exist(spark, sf):
    wide = {"smallint": "bigint", "integer": "bigint"}  # JSON has one whole number
    for source in (customers_feed, line_items_feed):
        parsed = parse(source(spark, sf))
        declared = {(r.table_name, r.name): (r.ordinal, wide.get(r.data_type, r.data_type)) for r in observed_columns(parsed).collect()}
        landed = {(r.table_name, r.name): (r.ordinal, r.data_type) for r in landed_columns(cell_kinds(parsed)).collect()}
        assert landed == declared and landed


def test_one_hash_aggregate_before_the_lists(spark):
    kinds = cell_kinds(parse(feed(spark, [_bare(ROWS[0])])))
    plan = kinds._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan and plan.count("Exchange") == 1
