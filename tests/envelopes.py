"""Builders for change envelopes."""

import json

COLUMNS = [("id", "int32", None, False), ("customer_id", "int32", None, True), ("status", "string", None, True),
           ("total", "string", None, True)]
ROW = {"id": 7, "customer_id": 31, "status": "open", "total": "12.50"}


def block(columns=COLUMNS, after=True):
    fields = []
    for name, kind, logical, optional in columns:
        f = {"field": name, "type": kind, "optional": optional}
        if logical:
            f["name"] = logical
        fields.append(f)
    image = {"type": "struct", "optional": True, "fields": fields}
    out = [{**image, "field": "before"}]
    if after:
        out.append({**image, "field": "after"})
    return {"type": "struct", "fields": out}


def envelope(op="c", before=None, after=ROW, columns=COLUMNS, has_after_schema=True, **source):
    src = {"connector": "postgresql", "db": "sales_db", "schema": "public", "table": "orders", "ts_ms": 1714400000000,
           "lsn": 23000000, "txId": 99, "snapshot": "false", **source}
    src = {k: v for k, v in src.items() if v != "ABSENT"}
    payload = {"before": before, "after": after, "source": src, "op": op, "ts_ms": 1, "transaction": None}
    return json.dumps({"schema": block(columns, has_after_schema), "payload": payload})


def feed(spark, values, destination="cdc.public.orders"):
    rows = [(i, destination, None, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "seq bigint, destination string, key string, value string")
