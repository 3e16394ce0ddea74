"""Change feeds and contracts over the sample tables, for the registered queries.

Each row of a table becomes a change; what kind of change is arithmetic on its key, so that the
expected results can be computed from the table alone.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.contract import ColumnSpec, TableContract, contract_versions
from rowtide.functions.members import object_text
from rowtide.session import configure, spread
from rowtide.sources.feed import FEED_COLUMNS, union_feeds

APP_ID = "shop-cdc"
DB = "orders_db"
HEARTBEAT_DESTINATION = "__debezium-heartbeat.shop"

ORDERS = TableContract(
    "public", "orders", "iglu:com.example/orders_change/jsonschema/1-0-0", ("id",),
    (ColumnSpec("id"), ColumnSpec("customer_id"), ColumnSpec("status", transforms=("trim",)), ColumnSpec("total")),
)
CUSTOMERS = TableContract(
    "public", "customers", "iglu:com.example/customers_change/jsonschema/1-0-0", ("id",),
    (
        ColumnSpec("id"),
        ColumnSpec("email", rename="emailAddress", transforms=("trim", "lowercase")),
        ColumnSpec("full_name"),
        ColumnSpec("password_hash", exclude=True),
    ),
)
LINE_ITEMS = TableContract(
    "public", "line_items", "iglu:com.example/line_items_change/jsonschema/1-0-0", ("orderkey", "linenumber"),
    (ColumnSpec("orderkey"), ColumnSpec("linenumber"), ColumnSpec("quantity")),
)
CONTRACTS = (ORDERS, CUSTOMERS, LINE_ITEMS)

NULLS = {"ignoreNullFields": "false"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def schema_block(columns: list[tuple[str, str, bool]], after: bool = True) -> str:
    image = {
        "type": "struct",
        "optional": True,
        "fields": [{"field": n, "type": t, "optional": o} for n, t, o in columns],
    }
    fields = [{**image, "field": "before"}] + ([{**image, "field": "after"}] if after else [])
    fields += [{"field": "op", "type": "string", "optional": False}]
    return json.dumps({"type": "struct", "fields": fields}, separators=(",", ":"))


_BASE = [("id", "int64", False), ("customer_id", "int64", True), ("status", "string", True)]
ORDERS_V1 = [*_BASE, ("total", "string", True)]
ORDERS_V2 = [*ORDERS_V1, ("country", "string", True)]
ORDERS_V3 = [*_BASE, ("total", "double", True), ("country", "string", True)]
CUSTOMER_COLUMNS = [
    ("id", "int64", False), ("email", "string", True), ("full_name", "string", True), ("password_hash", "string", True)
]
LINE_ITEM_COLUMNS = [("orderkey", "int64", False), ("linenumber", "int32", False), ("quantity", "string", True)]
#: The schema blocks that the tables' connectors are known to write, most frequent first; of the orders only the last version.
KNOWN_BLOCKS = tuple(map(schema_block, (LINE_ITEM_COLUMNS, ORDERS_V3, CUSTOMER_COLUMNS)))


def envelope(block: Column | str, before: Column, after: Column, source: Column, op: Column) -> Column:
    block = F.lit(block) if isinstance(block, str) else block
    side = lambda c: F.coalesce(c, F.lit("null"))
    return F.concat(
        F.lit('{"schema":'), block,
        F.lit(',"payload":{"before":'), side(before),
        F.lit(',"after":'), side(after),
        F.lit(',"source":'), source,
        F.lit(',"op":"'), op, F.lit('","transaction":null}}'),
    )


def source_json(table_name: Column, lsn: Column, txid: Column | None, ts_ms: Column, snapshot: Column) -> Column:
    fields = [
        ("connector", "plain", F.lit("postgresql")),
        ("db", "plain", F.lit(DB)),
        ("schema", "plain", F.lit("public")),
        ("table", "plain", table_name),
        ("lsn", "number", lsn),
        ("ts_ms", "number", ts_ms),
        ("snapshot", "plain", snapshot),
    ]
    if txid is not None:
        fields.append(("txId", "number", txid))
    return object_text(fields, nulls=True)


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kind = (
        F.when(k % 107 == 13, "garbage")
        .when(k % 103 == 11, "nonstring")
        .when(k % 101 == 9, "foreign")
        .when(k % 97 == 5, "noschema")
        .when(k % 89 == 3, "noimage")
        .when(k % 10 == 9, "truncate")
        .otherwise("ok")
    )
    op = (
        F.when(F.col("kind").isin("nonstring", "foreign", "noschema"), "c")
        .when(F.col("kind") == "noimage", "u")
        .when(F.col("kind") == "truncate", "t")
        .when(k % 10 <= 4, "c")
        .when(k % 10 <= 6, "u")
        .when(k % 10 == 7, "d")
        .otherwise("r")
    )
    o = o.select("*", kind.alias("kind")).select("*", op.alias("op"))

    ids = [("id", "number", k), ("customer_id", "number", F.col("o_custkey"))]
    total = ("total", "plain", F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    status = F.concat(F.lit("  "), "o_orderstatus", F.lit(" "))
    text_row = object_text([*ids, ("status", "text", status), total])
    number_row = object_text([*ids, ("status", "number", k % 7), total])
    after = F.when(F.col("kind") == "nonstring", number_row).when(F.col("op").isin("c", "u", "r"), text_row)
    old_row = object_text([*ids, ("status", "plain", F.lit(" N ")), ("total", "plain", F.lit("0.00"))])
    before = F.when(F.col("op").isin("u", "d") & (F.col("kind") != "noimage"), old_row)

    block = (
        F.when(F.col("kind") == "noschema", schema_block(ORDERS_V1, after=False))
        .when(k >= 1000, schema_block(ORDERS_V3))
        .when(k >= 400, schema_block(ORDERS_V2))
        .otherwise(schema_block(ORDERS_V1))
    )
    source = source_json(
        F.when(F.col("kind") == "foreign", "widgets").otherwise("orders"),
        k * 8 + 23000000,
        F.when(F.col("op") != "r", k),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")),
        F.when(F.col("op") == "r", "true").otherwise("false"),
    )
    text = envelope(block, before, after, source, F.col("op"))
    change = F.when(F.col("kind") == "garbage", "not json").otherwise(text)
    key = object_text([("id", "number", k)])
    o = o.select("o_orderkey", "kind", "op", key.alias("key"), change.alias("change"))

    dest, none = F.lit("cdc.public.orders"), F.lit(None).cast("string")

    def slot(n: int, destination: Column, key: Column, value: Column) -> Column:
        return F.struct(
            (k * 4 + n).alias("seq"), destination.alias("destination"), key.alias("key"), value.alias("value")
        )

    deleted = (F.col("kind") == "ok") & (F.col("op") == "d")
    slots = F.array(
        slot(0, dest, F.col("key"), F.col("change")),
        F.when(deleted, slot(1, dest, F.col("key"), none)),
        F.when(k % 100 == 3, slot(2, F.lit(HEARTBEAT_DESTINATION), none, F.lit('{"payload":{"ts_ms":1}}'))),
        F.when(k % 50 == 0, slot(3, dest, F.col("key"), F.col("change"))),
    )
    return o.select(F.inline(F.array_compact(slots))).select(*FEED_COLUMNS)


def customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    row = object_text([
        ("id", "number", k),
        ("email", "text", F.concat(F.lit("  "), F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@Example.COM "))),
        ("full_name", "text", F.col("c_name")),
        ("password_hash", "plain", F.concat(F.lit("pbkdf2:"), k.cast("string"))),
    ])
    op = F.when(k % 3 < 2, "c").otherwise("r")
    block = schema_block(CUSTOMER_COLUMNS)
    source = source_json(
        F.lit("customers"), k * 16 + 90000000000, None, F.lit(1714400000000) + k,
        F.when(k % 3 < 2, "false").otherwise("incremental"),
    )
    return c.select(
        (k + 1000000000).alias("seq"),
        F.lit("cdc.public.customers").alias("destination"),
        object_text([("id", "number", k)]).alias("key"),
        envelope(block, F.lit(None), row, source, op).alias("value"),
    )


def line_items_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    ids = [("orderkey", "number", k), ("linenumber", "number", n)]
    row = object_text([*ids, ("quantity", "plain", F.col("l_quantity").cast("decimal(15,2)").cast("string"))])
    block = schema_block(LINE_ITEM_COLUMNS)
    source = source_json(
        F.lit("line_items"), k * 64 + n * 8 + 200000000000, k, F.lit(1714400000000) + k, F.lit("false")
    )
    return li.select(
        (k * 8 + n + 2000000000).alias("seq"),
        F.lit("cdc.public.line_items").alias("destination"),
        object_text(ids).alias("key"),
        envelope(block, F.lit(None), row, source, F.lit("c")).alias("value"),
    )


def shop_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three feeds."""
    return union_feeds(orders_feed(spark, sf_dir), customers_feed(spark, sf_dir), line_items_feed(spark, sf_dir))


def shop_contract_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts of the shop as they were over time: two versions of orders and customers, and one of line items for each
    part, so that they grow with the tables. Orders have none before the order with key 40."""
    state = ColumnSpec("status", rename="state", transforms=("trim", "lowercase"))
    later_orders = TableContract(
        "public", "orders", "iglu:com.example/orders_change/jsonschema/1-1-0", ("id",), (ColumnSpec("id"), state)
    )
    later_customers = TableContract(
        "public", "customers", "iglu:com.example/customers_change/jsonschema/2-0-0", ("id",), (ColumnSpec("id"), ColumnSpec("full_name"))
    )
    by_hand = [(23000000 + 8 * 40, [ORDERS]), (0, [CUSTOMERS]), (23000000 + 8 * 1000, [later_orders]), (90000000000 + 16 * 500, [later_customers])]
    fixed = contract_versions(spark, by_hand)
    k = F.col("p_partkey")
    none = F.lit(None).cast("string")
    chain = F.array().cast(fixed.schema["transforms"].dataType)
    names = F.when(k % 2 == 0, F.array(F.lit("orderkey"))).otherwise(F.array(F.lit("linenumber"), F.lit("quantity")))
    line_items = table(spark, sf_dir, "part").select(
        F.lit("default").alias("contract_id"), F.lit(2).alias("table_pos"), F.lit("public").alias("table_schema"),
        F.lit("line_items").alias("table_name"),
        F.concat(F.lit("iglu:com.example/line_items_change/jsonschema/1-0-"), k.cast("string")).alias("schema_uri"),
        F.array(F.lit("orderkey"), F.lit("linenumber")).alias("primary_key"), none.alias("app_id"),
        F.posexplode(names).alias("col_pos", "column"), (k * 256 + 200000000000).alias("valid_from"),
    ).select("*", none.alias("rename"), F.col("column").alias("output_name"), F.lit(False).alias("exclude"), chain.alias("transforms"))
    return fixed.unionByName(line_items)


#: Keys of a chunk of the moving orders. The log has ``CHUNK * 8`` positions for each chunk, its read is in their middle.
CHUNK = 256


def _moving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders while they are read: every fifth is changed once, at ``at``, and every third of these is deleted by that."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    chunk = F.floor(k / CHUNK).cast("bigint")
    return o.select(
        k.alias("id"), F.col("o_orderstatus").alias("old"), chunk.alias("chunk"), (chunk * CHUNK * 8).alias("begin"),
        F.when(k % 5 == 0, chunk * CHUNK * 8 + k * 37 % (CHUNK * 8)).alias("at"), (k % 3 == 0).alias("gone"),
    )


def moving_orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the orders while they are read."""
    o = _moving(spark, sf_dir).where(F.col("at").isNotNull())
    block = schema_block([("id", "int64", False), ("status", "string", True)])
    image = lambda status: F.to_json(F.struct("id", status.alias("status")), NULLS)
    after = F.when(~F.col("gone"), image(F.lit("changed")))
    op = F.when(F.col("gone"), "d").otherwise("u")
    source = source_json(F.lit("orders"), F.col("at"), F.col("id"), F.lit(1714400000000), F.lit("false"))
    return o.select(
        F.col("at").alias("seq"), F.lit("cdc.public.orders").alias("destination"), F.to_json(F.struct("id")).alias("key"),
        envelope(block, image(F.col("old")), after, source, op).alias("value"),
    )


def moving_orders_read(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The orders as each chunk's read saw them, and the chunks with the positions noted around their reads."""
    o = _moving(spark, sf_dir)
    done = F.coalesce(F.col("at") <= F.col("begin") + CHUNK * 4, F.lit(False))
    rows = o.where(~(done & F.col("gone"))).select("id", F.when(done, "changed").otherwise(F.col("old")).alias("status"))
    chunks = o.select("chunk", (F.col("begin") + CHUNK * 2).alias("low"), (F.col("begin") + CHUNK * 6).alias("high")).distinct()
    return rows, chunks
