import json

from pyspark.sql import functions as F

from rowtide.functions.members import members, object_text
from rowtide.operators.project import canonical_name
from rowtide.plans import feeds

TEXTS = ["", "a", 'q"', "back\\slash", "tab\t", "\x00\x1f\x7f", "ö€𝄞 ", "/", None, "</script>", "line\nbreak\r"]


def test_members_are_what_to_json_writes(spark):
    rows = [(i - 5 if t else None, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "n bigint, t string")
    each = [("n", "number", F.col("n")), ("t", "text", F.col("t")), ("p", "plain", F.lit("x y"))]
    struct = F.struct("n", "t", F.lit("x y").alias("p"))
    for nulls in (False, True):
        written = F.to_json(struct, {"ignoreNullFields": str(not nulls).lower()})
        told = df.select(object_text(each, nulls).alias("told"), written.alias("written")).collect()
        assert [r.told for r in told] == [r.written for r in told]
    assert df.select(members([("t", "text", F.lit(None).cast("string"))]).alias("m")).first().m == ""


def test_names_are_json_with_sorted_keys(spark):
    rows = [(t or "", "c" if i % 2 else 'o"', t or "", TEXTS[-1 - i] or "", i if i % 3 else None, None if i == 1 else f"0/{i:X}") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "db string, op string, table_schema string, table_name string, txid bigint, lsn string")
    told = df.select("*", canonical_name("post\"gres", F.col("lsn"), F.lit('{"id":1}')).alias("name")).collect()
    for r in told:
        name = {"connector": 'post"gres', "db": r.db, "lsn": r.lsn, "op": r.op, "pk": {"id": 1}, "schema": r.table_schema or None,
                "table": r.table_name, "txid": r.txid}
        assert json.loads(r.name) == name and list(json.loads(r.name)) == sorted(name)
        assert " " not in r.name.replace(" ", "")


def test_feeds_and_names_need_no_writer_for_plain_rows(spark, sf):
    plan = feeds.line_items_feed(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan and "StructsToJson" not in plan and "toJson" not in plan.replace("tojson", "toJson")
