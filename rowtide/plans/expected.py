"""What each registered query must return, as SQL over the sample tables.

The statements compute the answers from the base tables by the rules of the sample feeds; none of
them sees an envelope.
"""

from __future__ import annotations

from string import Template

# ---- orders, customers and line items as changes -------------------------------------------------

_V1 = [("id", "int64", "false"), ("customer_id", "int64", "true"), ("status", "string", "true"), ("total", "string", "true")]
_V2 = [*_V1, ("country", "string", "true")]
_V3 = [*_V1[:3], ("total", "double", "true"), ("country", "string", "true")]
_CUSTOMER = [("id", "int64", "false"), ("email", "string", "true"), ("full_name", "string", "true"), ("password_hash", "string", "true")]
_LINE = [("orderkey", "int64", "false"), ("linenumber", "int32", "false"), ("quantity", "string", "true")]


def _print(columns) -> str:
    lines = [" || chr(9) || ".join(f"'{p}'" for p in (n, t, "", o)) for n, t, o in columns]
    return f"sha256({' || chr(10) || '.join(lines)})"


_VERSION = f"CASE WHEN k >= 1000 THEN {_print(_V3)} WHEN k >= 400 THEN {_print(_V2)} ELSE {_print(_V1)} END"

CHANGES = f"""
o AS (
  SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS st,
    CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS total, CAST(epoch_ms(o_orderdate) AS BIGINT) AS ts,
    CASE WHEN o_orderkey % 107 = 13 THEN 'garbage' WHEN o_orderkey % 103 = 11 THEN 'nonstring'
      WHEN o_orderkey % 101 = 9 THEN 'foreign' WHEN o_orderkey % 97 = 5 THEN 'noschema'
      WHEN o_orderkey % 89 = 3 THEN 'noimage' WHEN o_orderkey % 10 = 9 THEN 'truncate' ELSE 'ok' END AS kind
  FROM orders),
o1 AS (
  SELECT *, CASE WHEN kind IN ('nonstring','foreign','noschema') THEN 'c' WHEN kind = 'noimage' THEN 'u'
      WHEN kind = 'truncate' THEN 't' WHEN k % 10 <= 4 THEN 'c' WHEN k % 10 <= 6 THEN 'u' WHEN k % 10 = 7 THEN 'd'
      ELSE 'r' END AS op0 FROM o),
o2 AS (
  SELECT k, cust, st, total, kind,
    CASE WHEN kind = 'garbage' THEN NULL ELSE op0 END AS op,
    CASE kind WHEN 'garbage' THEN '' WHEN 'foreign' THEN 'widgets' ELSE 'orders' END AS tbl,
    CASE WHEN kind = 'garbage' THEN 0 ELSE ts END AS ts,
    CASE WHEN kind = 'garbage' THEN NULL ELSE 23000000 + 8 * k END AS lsn,
    CASE WHEN kind = 'garbage' OR op0 = 'r' THEN NULL ELSE k END AS txid,
    kind <> 'garbage' AND op0 = 'r' AS snap,
    CASE WHEN kind IN ('garbage', 'noschema') THEN NULL ELSE {_VERSION} END AS fp,
    CASE kind WHEN 'garbage' THEN 'unparseable' WHEN 'nonstring' THEN 'transform_type'
      WHEN 'foreign' THEN 'unconfigured_table' WHEN 'noschema' THEN 'missing_after_schema'
      WHEN 'noimage' THEN 'missing_image' WHEN 'truncate' THEN 'unsupported_op' END AS reason,
    '{{"id":' || k || ',"customer_id":' || cust || ',"status":"' || st || '","total":"' || total || '"}}' AS after_row,
    '{{"id":' || k || ',"customer_id":' || cust || ',"status":"N","total":"0.00"}}' AS before_row
  FROM o1),
ch AS (SELECT *, 4 * k AS seq FROM o2 UNION ALL SELECT *, 4 * k + 3 FROM o2 WHERE k % 50 = 0),
oe AS (
  SELECT seq, tbl, op, ts, lsn, txid, snap, fp, 'iglu:com.example/orders_change/jsonschema/1-0-0' AS uri,
    CASE WHEN op IN ('c','r') THEN '{{"op":"' || op || '","after":' || after_row || '}}'
      WHEN op = 'u' THEN '{{"op":"u","before":' || before_row || ',"after":' || after_row || '}}'
      ELSE '{{"op":"d","before":' || before_row || '}}' END AS payload,
    '{{"id":' || k || '}}' AS pk, '{{"id":' || k || '}}' AS pk_sorted
  FROM ch WHERE reason IS NULL),
ce AS (
  SELECT 1000000000 + k AS seq, 'customers' AS tbl, op, 1714400000000 + k AS ts, 90000000000 + 16 * k AS lsn,
    CAST(NULL AS BIGINT) AS txid, op = 'r' AS snap, {_print(_CUSTOMER)} AS fp,
    'iglu:com.example/customers_change/jsonschema/1-0-0' AS uri,
    '{{"op":"' || op || '","after":{{"id":' || k || ',"emailAddress":"' || lower(replace(name, '#', '.'))
      || '@example.com","full_name":"' || name || '"}}}}' AS payload,
    '{{"id":' || k || '}}' AS pk, '{{"id":' || k || '}}' AS pk_sorted
  FROM (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 3 < 2 THEN 'c' ELSE 'r' END AS op FROM customer)),
le AS (
  SELECT 2000000000 + 8 * k + n AS seq, 'line_items' AS tbl, 'c' AS op, 1714400000000 + k AS ts,
    200000000000 + 64 * k + 8 * n AS lsn, k AS txid, false AS snap, {_print(_LINE)} AS fp,
    'iglu:com.example/line_items_change/jsonschema/1-0-0' AS uri,
    '{{"op":"c","after":{{"orderkey":' || k || ',"linenumber":' || n || ',"quantity":"' || q || '"}}}}' AS payload,
    '{{"orderkey":' || k || ',"linenumber":' || n || '}}' AS pk,
    '{{"linenumber":' || n || ',"orderkey":' || k || '}}' AS pk_sorted
  FROM (SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n,
    CAST(CAST(l_quantity AS DECIMAL(15,2)) AS VARCHAR) AS q FROM lineitem)),
e0 AS (SELECT * FROM oe UNION ALL SELECT * FROM ce UNION ALL SELECT * FROM le),
e1 AS (
  SELECT *, CASE WHEN lsn IS NULL THEN NULL ELSE printf('%X/%X', lsn >> 32, lsn & 4294967295) END AS lsn_text FROM e0),
e2 AS (
  SELECT *, '{{"connector":"postgres","db":"orders_db","lsn":"' || lsn_text || '","op":"' || op || '","pk":' || pk_sorted
    || ',"schema":"public","table":"' || tbl || '","txid":' || coalesce(CAST(txid AS VARCHAR), 'null') || '}}' AS name,
    '{{"connector":"postgres","db":"orders_db","schema":"public","table":"' || tbl || '","lsn":"' || lsn_text
    || '","txid":' || coalesce(CAST(txid AS VARCHAR), 'null') || ',"is_snapshot":' || CAST(snap AS VARCHAR)
    || ',"ts_ms":' || ts || ',"column_fingerprint":"' || fp || '"}}' AS context FROM e1),
e3 AS (SELECT *, sha1(from_hex('8a1f4e5cc0de4cdca000000000000001') || encode(name)) AS h FROM e2),
e AS (
  SELECT *, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
    || substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-'
    || substr(h, 21, 12) AS event_id FROM e3),
eo AS (SELECT * FROM e WHERE tbl = 'orders'),
flow AS (
  SELECT seq, reason, CASE WHEN reason = 'unparseable' THEN '' ELSE 'public' END AS sch, tbl, op, ts FROM ch
  UNION ALL SELECT seq, NULL, 'public', tbl, op, ts FROM ce
  UNION ALL SELECT seq, NULL, 'public', tbl, op, ts FROM le)
"""

_FEED = """
o AS (SELECT o_orderkey AS k, o_orderkey % 107 = 13 OR o_orderkey % 103 = 11 OR o_orderkey % 101 = 9
    OR o_orderkey % 97 = 5 OR o_orderkey % 89 = 3 AS bad FROM orders),
f AS (
  SELECT 4 * k AS seq, 'cdc.public.orders' AS destination, '{"id":' || k || '}' AS key, true AS has_value FROM o
  UNION ALL SELECT 4 * k + 1, 'cdc.public.orders', '{"id":' || k || '}', false FROM o WHERE k % 10 = 7 AND NOT bad
  UNION ALL SELECT 4 * k + 2, '__debezium-heartbeat.shop', NULL, true FROM o WHERE k % 100 = 3
  UNION ALL SELECT 4 * k + 3, 'cdc.public.orders', '{"id":' || k || '}', true FROM o WHERE k % 50 = 0)
"""

_SNAPSHOT = f"""
s0 AS (
  SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS st,
    CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS total FROM orders),
s1 AS (SELECT *, '{{"connector":"postgres","db":"orders_db","lsn":"0/14FB180","op":"r","pk":{{"id":' || k
    || '}},"schema":"public","table":"orders","txid":null}}' AS name FROM s0),
s2 AS (SELECT *, sha1(from_hex('8a1f4e5cc0de4cdca000000000000001') || encode(name)) AS h FROM s1)
"""

_UUID = """substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
    || substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-'
    || substr(h, 21, 12)"""

_VERSIONS = f"""
seen AS (
  SELECT seq, 'public' AS sch, tbl, fp,
    CASE WHEN k >= 400 THEN 'id,customer_id,status,total,country' ELSE 'id,customer_id,status,total' END AS names
    FROM ch WHERE fp IS NOT NULL
  UNION ALL SELECT seq, 'public', tbl, fp, 'id,email,full_name,password_hash' FROM ce
  UNION ALL SELECT seq, 'public', tbl, fp, 'orderkey,linenumber,quantity' FROM le)
"""


def _changes(select: str, *more: str) -> str:
    return "WITH " + ",".join([CHANGES, *more]) + select


def _customer_rows(cell: str, name: str = "row", where: str = "") -> str:
    return f"SELECT 1000000000 + c_custkey AS seq, {cell} AS {name} FROM customer {where}"


_MAIL = "'  ' || replace(c_name, '#', '.') || '@Example.COM '"

# ---- the fleet of tables and contracts -----------------------------------------------------------

FLEET = """
p AS (
  SELECT p_partkey AS k, p_brand, p_type, CAST(p_size AS BIGINT) AS size,
    CASE p_partkey % 3 WHEN 0 THEN 'public' WHEN 1 THEN 'sales' ELSE 'ops' END AS table_schema,
    't_' || p_partkey AS table_name, p_partkey % 41 <> 40 AND p_partkey % 29 <> 28 AS listed FROM part),
cc0 AS (
  SELECT k, size, table_schema, table_name, t.* FROM p, (VALUES
    (1, 'id', 'bigint', 'int8'), (2, 'name', 'text', 'text'), (3, 'status', 'USER-DEFINED', ''),
    (4, 'sku', 'character varying', 'varchar'), (5, 'amount', 'numeric', 'numeric'), (6, 'tags', 'ARRAY', ''),
    (7, 'meta', 'jsonb', 'jsonb'), (8, 'created_at', 'timestamp with time zone', 'timestamptz'),
    (9, 'location', 'point', 'point'), (10, 'ratio', 'double precision', 'float8'), (11, 'flag', 'boolean', 'bool'),
    (12, 'birth', 'date', 'date'), (13, 'uid', 'uuid', 'uuid'), (14, 'code', 'character', 'bpchar')
    ) t(i, name, data_type, udt) WHERE listed),
cc AS (
  SELECT k, table_schema, table_name, name, CAST(i AS BIGINT) AS ordinal,
    CASE WHEN i IN (1, 5, 8, 11, 13) THEN false WHEN i IN (2, 6) THEN k % 2 = 0 WHEN i = 3 THEN k % 4 = 0 ELSE true END
      AS is_nullable,
    data_type,
    CASE WHEN i = 3 THEN CASE WHEN k % 2 = 0 THEN 'brand_enum' ELSE 'type_enum' END
      WHEN i = 6 THEN CASE WHEN k % 6 = 0 THEN '_text' ELSE '_point' END ELSE udt END AS udt_name,
    CASE WHEN i = 4 THEN size + 16 WHEN i = 14 THEN 3 END AS char_max_len
  FROM cc0 WHERE CASE i WHEN 3 THEN k % 3 = 0 WHEN 4 THEN k % 4 = 1 WHEN 5 THEN k % 5 < 3 WHEN 6 THEN k % 3 = 0
    WHEN 7 THEN k % 7 = 2 WHEN 9 THEN k % 8 = 5 WHEN 10 THEN k % 9 = 4 WHEN 11 THEN k % 10 = 1 WHEN 12 THEN k % 11 = 3
    WHEN 13 THEN k % 12 = 2 WHEN 14 THEN k % 13 = 1 ELSE true END),
ident AS (
  SELECT k, table_schema, table_name, CASE WHEN k % 53 = 52 THEN 'UNKNOWN' WHEN k % 5 < 2 THEN 'FULL'
    WHEN k % 5 = 2 THEN 'DEFAULT' WHEN k % 5 = 3 THEN 'NOTHING' ELSE 'INDEX' END AS replica_identity
  FROM p WHERE k % 37 <> 36 AND k % 29 <> 28),
uni AS (
  SELECT p.k, p.table_schema, p.table_name, coalesce(replica_identity, 'UNKNOWN') AS replica_identity
  FROM p LEFT JOIN ident USING (k) WHERE listed OR replica_identity IS NOT NULL),
en AS (
  SELECT 'brand_enum' AS udt_name, string_agg(p_brand, '|' ORDER BY n) AS labels
  FROM (SELECT DISTINCT p_brand, CAST(substr(p_brand, 7) AS INT) AS n FROM part)
  UNION ALL SELECT 'type_enum', string_agg(p_type, '|' ORDER BY n)
  FROM (SELECT p_type, min(p_partkey) AS n FROM part GROUP BY p_type)),
pk AS (
  SELECT k, table_schema, table_name, CASE WHEN k % 10 = 7 THEN 'created_at,id' ELSE 'id' END AS primary_key
  FROM p WHERE listed AND k % 4 <> 3),
uq AS (
  SELECT k, table_schema, table_name, concat_ws(';', CASE WHEN k % 12 IN (0, 3) THEN 'created_at,id' END,
    CASE WHEN k % 6 IN (0, 1, 3) THEN 'name' END, CASE WHEN k % 9 = 0 THEN 'name' END) AS unique_indexes
  FROM p WHERE listed AND (k % 12 IN (0, 3) OR k % 6 IN (0, 1, 3) OR k % 9 = 0))
"""

# The contract; $bad is true where it may break the rules.
_CONTRACT = Template("""
k0 AS (
  SELECT p_partkey AS k, 'svc_' || CAST(floor(p_partkey / 10) AS BIGINT) AS contract_id, p_partkey % 10 AS pos,
    p_partkey - CASE WHEN $bad AND p_partkey % 20 = 9 THEN 1 ELSE 0 END AS m FROM part),
k1 AS (
  SELECT k, contract_id, pos,
    CASE WHEN $bad AND k % 37 = 1 THEN '  '
      ELSE CASE m % 3 WHEN 0 THEN 'public' WHEN 1 THEN 'sales' ELSE 'ops' END END AS table_schema,
    CASE WHEN $bad AND k % 31 = 30 THEN '' ELSE 't_' || m END AS table_name,
    NOT ($bad AND k % 23 = 1) AS good_uri, NOT ($bad AND k % 19 = 18) AS has_pk, $bad AND k % 43 = 2 AS bare,
    $bad AND k % 47 = 3 AS hidden FROM k0),
k2 AS (
  SELECT k1.*, t.i, CASE WHEN t.i = 2 AND k % 6 = 3 THEN 'status' ELSE t.name END AS col,
    CASE t.i WHEN 0 THEN CASE WHEN $bad AND k % 14 = 6 THEN ['trim'] ELSE [] END
      WHEN 1 THEN CASE WHEN k % 3 = 1 THEN ['trim', 'lowercase'] ELSE [] END
      WHEN 3 THEN CASE WHEN k % 5 = 0 THEN ['lowercase'] ELSE [] END
      WHEN 4 THEN CASE WHEN k % 35 = 1 THEN ['uppercase'] ELSE [] END
      WHEN 7 THEN ['trim'] ELSE [] END AS chain,
    CASE WHEN t.i = 1 AND k % 4 = 2 THEN 'fullName' WHEN t.i = 4 AND $bad AND k % 13 = 5 THEN 'id' END AS renamed,
    hidden OR (t.i = 5 AND k % 22 = 0) OR (t.i = 1 AND $bad AND k % 15 = 4) AS excluded
  FROM k1, (VALUES (0, 'id'), (1, 'name'), (2, 'statuss'), (3, 'amount'), (4, 'created_at'), (5, 'missing_col'),
    (6, 'nmae'), (7, 'sku')) t(i, name)
  WHERE NOT bare AND CASE t.i WHEN 2 THEN k % 3 = 0 WHEN 3 THEN k % 5 < 2 WHEN 4 THEN k % 7 <> 0 WHEN 5 THEN k % 11 = 0
    WHEN 6 THEN k % 17 = 0 WHEN 7 THEN k % 8 = 1 ELSE true END)
""")
CONTRACT = _CONTRACT.substitute(bad="false")
DEFECTIVE = _CONTRACT.substitute(bad="true")

DRIFT = """
miss AS (
  SELECT k2.k, contract_id, k2.table_schema, k2.table_name, col,
    NOT EXISTS (SELECT 1 FROM uni WHERE uni.k = k2.k) AS table_missing
  FROM k2 WHERE NOT EXISTS (SELECT 1 FROM cc WHERE cc.k = k2.k AND cc.name = k2.col)),
near AS (
  SELECT m.k, m.col, cc.name AS suggestion,
    row_number() OVER (PARTITION BY m.k, m.col ORDER BY levenshtein(m.col, cc.name), cc.ordinal) AS rn
  FROM miss m JOIN cc ON cc.k = m.k WHERE levenshtein(m.col, cc.name) <= 2),
sugg AS (
  SELECT m.*, near.suggestion FROM miss m LEFT JOIN near ON near.k = m.k AND near.col = m.col AND near.rn = 1),
tm AS (
  SELECT k2.k, contract_id, k2.table_schema, k2.table_name, col, data_type, unnest(chain) AS transform_name
  FROM k2 JOIN cc ON cc.k = k2.k AND cc.name = k2.col
  WHERE data_type NOT IN ('text', 'character varying', 'character')),
ex AS (
  SELECT cc.k, contract_id, cc.table_schema, cc.table_name, cc.name AS col, data_type FROM cc JOIN k1 ON k1.k = cc.k
  WHERE NOT EXISTS (SELECT 1 FROM k2 WHERE k2.k = cc.k AND k2.col = cc.name)),
rf AS (
  SELECT k1.k, contract_id, k1.table_schema, k1.table_name, lower(replica_identity) AS identity
  FROM k1 JOIN uni ON uni.k = k1.k WHERE replica_identity <> 'FULL'),
bad AS (
  SELECT k FROM miss UNION SELECT k FROM tm UNION SELECT k FROM ex UNION SELECT k FROM rf),
okt AS (
  SELECT k1.k, contract_id, k1.table_schema, k1.table_name,
    (SELECT count(*) FROM k2 WHERE k2.k = k1.k AND NOT excluded) AS n_columns, replica_identity
  FROM k1 JOIN uni ON uni.k = k1.k WHERE k1.k NOT IN (SELECT k FROM bad))
"""


def _fleet(select: str, *more: str) -> str:
    return "WITH " + ",".join([FLEET, *more]) + select


def _drift(select: str) -> str:
    return _fleet(select, CONTRACT, DRIFT)


def _lint(select: str) -> str:
    return "WITH " + DEFECTIVE + select


def _at(field: str) -> str:
    return f"'tables[' || pos || '].{field}' AS path"


_FRAGMENT = """
base AS (
  SELECT cc.*, en.labels,
    CASE udt_name WHEN 'int8' THEN 'integer' WHEN 'text' THEN 'string' WHEN 'varchar' THEN 'string'
      WHEN 'numeric' THEN 'string' WHEN 'timestamptz' THEN 'string' WHEN 'float8' THEN 'number' WHEN 'bool' THEN 'boolean'
      WHEN 'date' THEN 'string' WHEN 'uuid' THEN 'string' WHEN 'bpchar' THEN 'string' END AS jt,
    CASE udt_name WHEN 'timestamptz' THEN ',"format":"date-time"' WHEN 'date' THEN ',"format":"date"'
      WHEN 'uuid' THEN ',"format":"uuid"' ELSE '' END AS fmt
  FROM cc LEFT JOIN en USING (udt_name)),
frag AS (
  SELECT *,
    CASE WHEN udt_name = 'jsonb' THEN '{}'
      WHEN data_type = 'USER-DEFINED' THEN '{"type":' || CASE WHEN is_nullable THEN '["string","null"]' ELSE '"string"' END
        || ',"enum":["' || replace(labels, '|', '","') || '"' || CASE WHEN is_nullable THEN ',null' ELSE '' END || ']}'
      WHEN data_type = 'ARRAY' THEN '{"type":' || CASE WHEN is_nullable THEN '["array","null"]' ELSE '"array"' END
        || ',"items":' || CASE WHEN udt_name = '_text' THEN '{"type":"string"}' ELSE '{}' END || '}'
      WHEN jt IS NULL THEN '{}'
      ELSE '{"type":' || CASE WHEN is_nullable THEN '["' || jt || '","null"]' ELSE '"' || jt || '"' END || fmt
        || CASE WHEN jt = 'string' AND char_max_len IS NOT NULL THEN ',"maxLength":' || char_max_len ELSE '' END || '}'
      END AS fragment,
    CASE WHEN udt_name = 'point' THEN 'point' END AS unmapped
  FROM base)
"""

_BEAT = """
w AS (
  SELECT *, (CAST(floor(ts / $ms) AS BIGINT) + 1) * $ms AS window_end_ms FROM ch)
"""



EXPECTED: dict[str, str] = {
    # sources
    "feed_scan": f"WITH {_FEED} SELECT seq, destination, key, has_value FROM f",
    "include_tables": _changes(
        "SELECT seq, 'public' AS table_schema, tbl AS table_name, op FROM ch WHERE tbl = 'orders'"
    ),
    "snapshot_rows": f"""WITH {_SNAPSHOT} SELECT k - 1000000000 AS seq, {_UUID} AS event_id, 'r' AS op,
        '{{"op":"r","after":{{"id":' || k || ',"customer_id":' || cust || ',"status":"' || st || '","total":"' || total
        || '"}}}}' AS payload, true AS is_snapshot, {_print(_V1)} AS column_fingerprint FROM s2""",
    "snapshot_then_stream": _changes(
        """SELECT op, snap AS is_snapshot, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq FROM (
          SELECT op, snap, seq FROM oe UNION ALL SELECT 'r', true, o_orderkey - 1000000000 FROM orders) GROUP BY ALL"""
    ),
    "catalog_scan": _fleet(
        """SELECT table_schema, table_name, name, ordinal, is_nullable, data_type, udt_name, char_max_len FROM cc
        WHERE k % 2 = 0"""
    ),
    "observed_catalog": """
        WITH last AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 107 <> 13
            AND NOT (o_orderkey % 97 = 5 AND o_orderkey % 101 <> 9 AND o_orderkey % 103 <> 11)),
        v AS (
          SELECT 'orders' AS t, max(k) AS k FROM last WHERE NOT (k % 101 = 9 AND k % 103 <> 11)
          UNION ALL SELECT 'widgets', max(k) FROM last WHERE k % 101 = 9 AND k % 103 <> 11)
        SELECT 'public' AS table_schema, t AS table_name, c.name, CAST(c.i AS BIGINT) AS ordinal, c.i > 1 AS is_nullable,
          CASE WHEN c.name = 'total' AND k >= 1000 THEN 'double precision' ELSE c.dt END AS data_type,
          CASE WHEN c.name = 'total' AND k >= 1000 THEN 'float8' ELSE c.udt END AS udt_name
        FROM v, (VALUES (1, 'id', 'bigint', 'int8'), (2, 'customer_id', 'bigint', 'int8'), (3, 'status', 'text', 'text'),
          (4, 'total', 'text', 'text'), (5, 'country', 'text', 'text')) c(i, name, dt, udt)
        WHERE k IS NOT NULL AND (c.i < 5 OR k >= 400)
        UNION ALL SELECT 'public', 'customers', c.name, c.i, c.i > 1, c.dt, c.udt FROM (SELECT max(c_custkey) FROM customer
          HAVING count(*) > 0), (VALUES (1, 'id', 'bigint', 'int8'), (2, 'email', 'text', 'text'),
          (3, 'full_name', 'text', 'text'), (4, 'password_hash', 'text', 'text')) c(i, name, dt, udt)
        UNION ALL SELECT 'public', 'line_items', c.name, c.i, c.i = 3, c.dt, c.udt FROM (SELECT max(l_orderkey) FROM lineitem
          HAVING count(*) > 0), (VALUES (1, 'orderkey', 'bigint', 'int8'), (2, 'linenumber', 'integer', 'int4'),
          (3, 'quantity', 'text', 'text')) c(i, name, dt, udt)""",
    "landed_catalog": """
        WITH o AS (
          SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_totalprice, CASE WHEN o_orderkey % 107 = 13 THEN 'garbage'
            WHEN o_orderkey % 103 = 11 THEN 'nonstring' WHEN o_orderkey % 101 = 9 THEN 'foreign' WHEN o_orderkey % 97 = 5 THEN 'noschema'
            WHEN o_orderkey % 89 = 3 THEN 'noimage' WHEN o_orderkey % 10 = 9 THEN 'truncate' ELSE 'ok' END AS kind FROM orders),
        i AS (SELECT CASE WHEN kind = 'foreign' THEN 'widgets' ELSE 'orders' END AS t, * FROM o
          WHERE kind IN ('nonstring', 'foreign', 'noschema', 'noimage') OR kind = 'ok' AND k % 10 <> 7)
        SELECT 'public' AS table_schema, t AS table_name, name, ordinal, is_nullable, data_type, udt_name, conflict FROM (
          SELECT t, 'id' AS name, 1::BIGINT AS ordinal, bool_or(k IS NULL) AS is_nullable, 'bigint' AS data_type, 'int8' AS udt_name,
            '' AS conflict FROM i GROUP BY t
          UNION ALL SELECT t, 'customer_id', 2, bool_or(o_custkey IS NULL), 'bigint', 'int8', '' FROM i GROUP BY t
          UNION ALL SELECT t, 'status', 3, bool_or(o_orderstatus IS NULL),
            CASE WHEN bool_and(kind = 'nonstring') THEN 'bigint' ELSE 'text' END,
            CASE WHEN bool_and(kind = 'nonstring') THEN 'int8' ELSE 'text' END,
            CASE WHEN bool_or(kind = 'nonstring') AND bool_or(kind <> 'nonstring') THEN 'bigint|text' ELSE '' END FROM i GROUP BY t
          UNION ALL SELECT t, 'total', 4, bool_or(o_totalprice IS NULL), 'text', 'text', '' FROM i GROUP BY t
          UNION ALL SELECT 'customers', c.name, c.i, false, c.dt, c.udt, '' FROM (SELECT max(c_custkey) FROM customer
            HAVING count(*) > 0), (VALUES (1, 'id', 'bigint', 'int8'), (2, 'email', 'text', 'text'),
            (3, 'full_name', 'text', 'text'), (4, 'password_hash', 'text', 'text')) c(i, name, dt, udt)
          UNION ALL SELECT 'line_items', c.name, c.i, false, c.dt, c.udt, '' FROM (SELECT max(l_orderkey) FROM lineitem
            HAVING count(*) > 0), (VALUES (1, 'orderkey', 'bigint', 'int8'), (2, 'linenumber', 'bigint', 'int8'),
            (3, 'quantity', 'text', 'text')) c(i, name, dt, udt))""",
    "snapshot_in_chunks": """
        WITH o AS (
          SELECT o_orderkey AS id, o_orderstatus AS old, o_orderkey // 256 * 2048 AS base, o_orderkey % 5 = 0 AS changed,
            o_orderkey // 256 * 2048 + o_orderkey * 37 % 2048 AS pos FROM orders WHERE NOT (o_orderkey % 15 = 0))
        SELECT id, CASE WHEN changed THEN 'changed' ELSE old END AS status,
          NOT (changed AND pos > base + 512) AS is_snapshot,
          CASE WHEN changed AND pos > base + 512 THEN pos ELSE base + 1536 END AS seq FROM o""",
    # filters and rejection
    "drop_tombstones": f"WITH {_FEED} SELECT seq, destination FROM f WHERE has_value",
    "drop_heartbeats": f"WITH {_FEED} SELECT seq, has_value FROM f WHERE destination = 'cdc.public.orders'",
    "op_filter": _changes("SELECT seq, op FROM ch WHERE reason = 'unsupported_op'"),
    "unconfigured_tables": _changes(
        "SELECT 'public' AS table_schema, tbl AS table_name, count(*) AS n FROM ch WHERE reason = 'unconfigured_table' GROUP BY tbl"
    ),
    "reject_reasons": _changes("SELECT seq, coalesce(reason, 'accepted') AS outcome FROM ch"),
    # parsing
    "parse_envelope": _changes(
        """SELECT seq, kind = 'garbage' AS unparseable, op, CASE WHEN kind = 'garbage' THEN '' ELSE 'orders_db' END AS db,
        CASE WHEN kind = 'garbage' THEN '' ELSE 'public' END AS table_schema, tbl AS table_name, lsn AS lsn_num, txid,
        snap AS is_snapshot, ts AS ts_ms FROM ch"""
    ),
    "row_images": _changes(
        """SELECT seq, op IN ('u', 'd') AND kind <> 'noimage' AND op IS NOT NULL AS has_before,
        op IN ('c', 'u', 'r') AND op IS NOT NULL AS has_after,
        CASE WHEN op IN ('u', 'd') AND kind <> 'noimage' THEN '0.00' END AS before_total,
        CASE WHEN op IN ('c', 'u', 'r') THEN total END AS after_total FROM ch"""
    ),
    "lsn_format": _changes(
        """SELECT seq, CASE WHEN lsn IS NOT NULL THEN printf('%X/%X', lsn >> 32, lsn & 4294967295) END AS lsn
        FROM (SELECT seq, lsn FROM ch UNION ALL SELECT seq, lsn FROM ce)"""
    ),
    "txid": _changes("SELECT seq, txid FROM ch UNION ALL SELECT seq, txid FROM ce"),
    "snapshot_flag": _changes(
        """SELECT table_name, op, is_snapshot, count(*) AS n FROM (
        SELECT tbl AS table_name, op, snap AS is_snapshot FROM ch UNION ALL SELECT tbl, op, snap FROM ce) GROUP BY ALL"""
    ),
    "true_timestamp": _changes(
        "SELECT seq, ts AS ms, strftime(make_timestamp(ts * 1000), '%Y-%m-%d %H:%M:%S') AS at FROM ch"
    ),
    "cdc_source_context": _changes("SELECT seq, context FROM eo"),
    "column_fingerprint": _changes("SELECT seq, fp AS column_fingerprint FROM ch"),
    "schema_snapshots": _changes(
        """SELECT max(seq) AS seq, sch AS table_schema, tbl AS table_name, arg_max(fp, seq) AS column_fingerprint,
        arg_max(names, seq) AS column_names FROM seen GROUP BY sch, tbl""",
        _VERSIONS,
    ),
    # projection and transforms
    "project_whitelist": _customer_rows("""'{"full_name":"' || c_name || '","id":' || c_custkey || '}'"""),
    "project_rename": _customer_rows("""'{"customerId":' || c_custkey || ',"name":"' || c_name || '"}'"""),
    "project_exclude": _customer_rows("""'{"id":' || c_custkey || '}'"""),
    "project_null_fill": _customer_rows("""'{"id":' || c_custkey || ',"nickname":null,"phone":null}'"""),
    "tx_lowercase": _customer_rows(f"lower({_MAIL})", "cell"),
    "tx_uppercase": _customer_rows(f"upper({_MAIL})", "cell"),
    "tx_trim": _customer_rows(f"trim({_MAIL})", "cell"),
    "tx_regex_extract": _customer_rows(
        """CASE WHEN c_custkey % 10 <> 0 THEN NULL WHEN c_custkey = 0 THEN ''
        WHEN instr(CAST(CAST(c_custkey / 10 AS BIGINT) AS VARCHAR), '0') = 0 THEN CAST(CAST(c_custkey / 10 AS BIGINT) AS VARCHAR)
        END""",
        "cell",
    ),
    "tx_regex_replace": _customer_rows(f"replace(replace({_MAIL}, 'e', '<e>'), 'E', '<E>')", "cell"),
    "tx_regex_mask": _customer_rows("'***@Example.COM '", "cell"),
    "tx_chain": _customer_rows("CASE WHEN c_custkey % 5 = 0 THEN 'c.' || substr(c_name, 10) END", "cell"),
    "tx_type_guard": _changes("SELECT seq, op FROM ch WHERE reason = 'transform_type'"),
    "op_payload": _changes("SELECT seq, op, payload FROM oe"),
    "both_images": _changes("SELECT seq, 'N' AS before_status, st AS after_status FROM ch WHERE reason IS NULL AND op = 'u'"),
    "route_by_contract_rows": _changes(
        """SELECT tbl AS table_name, uri AS schema_uri, count(*) AS n, CAST(sum(length(payload)) AS BIGINT) AS payload_chars
        FROM e0 GROUP BY tbl, uri"""
    ),
    "feed_partitions": _changes(
        """, own AS (SELECT coalesce(lsn, -1) AS seq, tbl, fp,
          CASE WHEN k >= 400 THEN 'id,customer_id,status,total,country' ELSE 'id,customer_id,status,total' END AS names
          FROM ch WHERE fp IS NOT NULL),
        step AS (SELECT *, lag(fp) OVER w AS prev, lag(names) OVER w AS prev_names FROM own
          WINDOW w AS (PARTITION BY tbl ORDER BY seq, fp))
        SELECT seq, 'public.' || tbl AS "table", prev AS previous_fingerprint, fp AS current_fingerprint,
          array_to_string(list_sort(list_filter(string_split(names, ','), lambda x: NOT list_contains(string_split(prev_names, ','), x))), ',') AS added_columns,
          array_to_string(list_sort(list_filter(string_split(prev_names, ','), lambda x: NOT list_contains(string_split(names, ','), x))), ',') AS removed_columns
        FROM step WHERE prev <> fp"""
    ),
    "landed_rejects": _changes("SELECT seq, reason AS drop_reason, true AS has_text FROM ch WHERE reason IS NOT NULL"),
    "route_by_contract_version": _changes(
        """, v AS (
          SELECT 'orders' AS tbl, 23000320 AS valid_from, 'iglu:com.example/orders_change/jsonschema/1-0-0' AS uri
          UNION ALL SELECT 'orders', 23008000, 'iglu:com.example/orders_change/jsonschema/1-1-0'
          UNION ALL SELECT 'customers', 0, 'iglu:com.example/customers_change/jsonschema/1-0-0'
          UNION ALL SELECT 'customers', 90000008000, 'iglu:com.example/customers_change/jsonschema/2-0-0'
          UNION ALL SELECT 'line_items', 200000000000 + 256 * p_partkey, 'iglu:com.example/line_items_change/jsonschema/1-0-' || p_partkey FROM part),
        rec AS (
          SELECT ch.seq, ch.tbl, ch.lsn, ch.reason, oe.payload, CASE WHEN ch.op IN ('c', 'r') THEN '{"op":"' || ch.op || '","after":{"id":' || k || ',"state":"' || lower(st) || '"}}'
            WHEN ch.op = 'u' THEN '{"op":"u","before":{"id":' || k || ',"state":"n"},"after":{"id":' || k || ',"state":"' || lower(st) || '"}}'
            ELSE '{"op":"d","before":{"id":' || k || ',"state":"n"}}' END AS newer FROM ch LEFT JOIN oe ON oe.seq = ch.seq
          UNION ALL SELECT seq, tbl, lsn, NULL, payload, regexp_replace(payload, ',"emailAddress":"[^"]*"', '') FROM ce
          UNION ALL SELECT seq, tbl, lsn, NULL, payload, payload FROM le),
        routed AS (SELECT rec.*, v.uri, v.valid_from FROM rec ASOF LEFT JOIN v ON rec.tbl = v.tbl AND rec.lsn >= v.valid_from),
        told AS (
          SELECT seq, tbl, uri, CASE WHEN reason IN ('unparseable', 'missing_after_schema') THEN reason WHEN uri IS NULL THEN 'unconfigured_table'
              ELSE reason END AS reason,
            CASE WHEN tbl = 'line_items' AND valid_from // 256 % 2 = (200000000000 // 256) % 2
                THEN regexp_replace(payload, ',"linenumber":.*[}][}]$', '}}')
              WHEN tbl = 'line_items' THEN regexp_replace(payload, '"orderkey":[0-9]+,', '')
              WHEN uri LIKE '%/1-1-0' OR uri LIKE '%/2-0-0' THEN newer ELSE payload END AS payload FROM routed)
        SELECT tbl AS table_name, uri AS schema_uri, reason AS drop_reason, count(*) AS n,
          CAST(sum(CASE WHEN reason IS NULL THEN length(payload) END) AS BIGINT) AS payload_chars, min(seq) AS first_seq, max(seq) AS last_seq
        FROM told GROUP BY ALL"""
    ),
    "transactions": _changes(
        """, a AS (
          SELECT txid, lsn, 'public.' || tbl AS tbl, op, ts, seq FROM ch WHERE txid IS NOT NULL
          UNION ALL SELECT txid, lsn, 'public.line_items', op, ts, seq FROM le)
        SELECT 'orders_db' AS db, txid, min(lsn) AS first_lsn, max(lsn) AS last_lsn, min(ts) AS first_ts_ms, max(ts) AS last_ts_ms,
          string_agg(DISTINCT tbl, ',' ORDER BY tbl) AS tables, count(DISTINCT (tbl, op, lsn)) AS changes,
          count(*) - count(DISTINCT (tbl, op, lsn)) AS replays, min(seq) AS first_seq, max(seq) AS last_seq
        FROM a GROUP BY txid, lsn >= 200000000000"""
    ),
    "reject_cube": _changes(
        """SELECT reason AS drop_reason, sch || '.' || tbl AS "table", op, GROUPING(reason, sch || '.' || tbl, op) AS level, count(*) AS n
        FROM flow WHERE reason IS NOT NULL GROUP BY CUBE (reason, sch || '.' || tbl, op)"""
    ),
    "distinct_keys_by_table": _changes(
        """SELECT 'public.' || tbl AS "table", count(*) AS n, count(DISTINCT pk) AS keys, true AS near, true AS lag_near FROM e GROUP BY tbl"""
    ),
    "route_by_table": _changes(
        """SELECT tbl AS table_name, uri AS schema_uri, count(*) AS n, CAST(sum(length(payload)) AS BIGINT) AS payload_chars
        FROM e0 GROUP BY tbl, uri"""
    ),
    # identity
    "pk_values": _changes("SELECT seq, pk FROM oe UNION ALL SELECT seq, pk FROM le"),
    "canonical_name": _changes("SELECT seq, name AS canonical_name FROM e2 WHERE tbl <> 'customers'"),
    "event_id": _changes("SELECT seq, event_id FROM e"),
    "events_full": _changes(
        """SELECT seq, event_id, 'shop-cdc' AS app_id, ts AS true_ms, 'public' AS table_schema, tbl AS table_name, op,
        uri AS schema_uri, payload, context AS cdc_source, lsn AS lsn_num FROM e"""
    ),
    "wire_form": _changes(
        """SELECT seq, 'ue' AS e, event_id AS eid, 'shop-cdc' AS aid, CAST(ts AS VARCHAR) AS ttm,
        to_base64(encode('{"schema":"iglu:com.example/unstruct_event/jsonschema/1-0-0","data":{"schema":"' || uri
          || '","data":' || payload || '}}')) AS ue_px,
        to_base64(encode('{"schema":"iglu:com.example/contexts/jsonschema/1-0-0","data":[{"schema":"iglu:com.example/cdc_source/jsonschema/1-0-0","data":'
          || context || '}]}')) AS cx FROM eo"""
    ),
    "replay_dedup": _changes("SELECT event_id, any_value(tbl) AS table_name, any_value(op) AS op, min(seq) AS seq FROM e GROUP BY event_id"),
    # schema changes
    "schema_changes": _changes(
        """, step AS (SELECT *, lag(fp) OVER w AS prev, lag(names) OVER w AS prev_names FROM seen
          WINDOW w AS (PARTITION BY sch, tbl ORDER BY seq))
        SELECT 'source_schema_change' AS event, sch || '.' || tbl AS "table", prev AS previous_fingerprint,
          fp AS current_fingerprint,
          array_to_string(list_sort(list_filter(string_split(names, ','), lambda x: NOT list_contains(string_split(prev_names, ','), x))), ',') AS added_columns,
          array_to_string(list_sort(list_filter(string_split(prev_names, ','), lambda x: NOT list_contains(string_split(names, ','), x))), ',') AS removed_columns
        FROM step WHERE prev <> fp""",
        _VERSIONS,
    ),
    "schema_change_diff": """
        WITH s AS (SELECT p_partkey AS k, lower(p_type) AS t, p_partkey & 4095 AS bits,
          lag(p_partkey & 4095) OVER (PARTITION BY p_type ORDER BY p_partkey) AS old FROM part)
        SELECT k AS seq, 'public.' || t AS "table",
          coalesce((SELECT string_agg('col_' || i, ',' ORDER BY 'col_' || i) FROM range(12) r(i)
            WHERE (bits >> i) & 1 = 1 AND (old >> i) & 1 = 0), '') AS added_columns,
          coalesce((SELECT string_agg('col_' || i, ',' ORDER BY 'col_' || i) FROM range(12) r(i)
            WHERE (bits >> i) & 1 = 0 AND (old >> i) & 1 = 1), '') AS removed_columns
        FROM s WHERE old IS NOT NULL AND old <> bits""",
    "schema_versions": _changes(
        """, step AS (SELECT *, lag(fp) OVER w AS prev, lag(names) OVER w AS prev_names FROM seen
          WINDOW w AS (PARTITION BY sch, tbl ORDER BY seq)),
        moves AS (SELECT *, CASE WHEN prev IS NULL THEN 'first' WHEN names <> prev_names THEN 'addition' ELSE 'model' END AS change
          FROM step WHERE prev IS NULL OR prev <> fp),
        n AS (SELECT *, count(*) FILTER (change = 'model') OVER (PARTITION BY sch, tbl ORDER BY seq) AS m FROM moves)
        SELECT seq, sch AS table_schema, tbl AS table_name,
          (1 + m) || '-0-' || count(*) FILTER (change = 'addition') OVER (PARTITION BY sch, tbl, m ORDER BY seq) AS version, change,
          CASE change WHEN 'addition' THEN 'country' ELSE '' END AS added, '' AS dropped,
          CASE change WHEN 'model' THEN 'total' ELSE '' END AS retyped, '' AS widened, '' AS tightened, '' AS loosened FROM n""",
        _VERSIONS,
    ),
    "schema_version_history": """
        WITH p AS (SELECT p_partkey AS k, lower(p_type) AS t, lag(p_partkey) OVER (PARTITION BY p_type ORDER BY p_partkey) AS o FROM part),
        c AS (SELECT k, t, o, i, (k >> i) & 1 = 1 AS has, (o >> i) & 1 = 1 AS had, (k // 16 + i) % 3 AS kind, (o // 16 + i) % 3 AS was,
          (k + i) % 5 <> 0 AS nul, (o + i) % 5 <> 0 AS nulled, 'col_' || i AS name FROM p, range(8) r(i)),
        d AS (SELECT k, t, any_value(o) AS o,
          bool_or(has <> had OR has AND (kind <> was OR nul <> nulled)) AS moved,
          coalesce(string_agg(name, ',' ORDER BY name) FILTER (has AND NOT had), '') AS added,
          coalesce(string_agg(name, ',' ORDER BY name) FILTER (had AND NOT has), '') AS dropped,
          coalesce(string_agg(name, ',' ORDER BY name) FILTER (has AND had AND kind <> was AND NOT (was = 0 AND kind = 1)), '') AS retyped,
          coalesce(string_agg(name, ',' ORDER BY name) FILTER (has AND had AND was = 0 AND kind = 1), '') AS widened,
          coalesce(string_agg(name, ',' ORDER BY name) FILTER (has AND had AND nulled AND NOT nul), '') AS tightened,
          coalesce(string_agg(name, ',' ORDER BY name) FILTER (has AND had AND nul AND NOT nulled), '') AS loosened,
          coalesce(bool_or(has AND NOT had AND NOT nul), false) AS must FROM c GROUP BY k, t),
        e AS (SELECT *, CASE WHEN o IS NULL THEN 'first' WHEN dropped <> '' OR retyped <> '' THEN 'model'
          WHEN tightened <> '' OR must THEN 'revision' ELSE 'addition' END AS change FROM d WHERE o IS NULL OR moved),
        m AS (SELECT *, count(*) FILTER (change = 'model') OVER (PARTITION BY t ORDER BY k) AS m FROM e),
        r AS (SELECT *, count(*) FILTER (change = 'revision') OVER (PARTITION BY t, m ORDER BY k) AS r FROM m)
        SELECT k AS seq, 'public' AS table_schema, t AS table_name,
          (1 + m) || '-' || r || '-' || count(*) FILTER (change = 'addition') OVER (PARTITION BY t, m, r ORDER BY k) AS version,
          change, added, dropped, retyped, widened, tightened, loosened FROM r""",
    # accounting
    "flow_totals": _changes(
        """SELECT count(*) AS received, count(*) FILTER (reason IS NULL) AS emitted,
        count(*) FILTER (reason IS NOT NULL) AS dropped FROM flow"""
    ),
    "counts_by_table_op": _changes(
        """SELECT sch || '.' || tbl AS "table", op, count(*) AS n FROM flow WHERE reason IS NULL GROUP BY ALL"""
    ),
    "counts_nested": _changes(
        """, c AS (SELECT sch || '.' || tbl AS t, op, count(*) AS n FROM flow WHERE reason IS NULL GROUP BY ALL),
        j AS (SELECT t, '{' || string_agg('"' || op || '":' || n, ',' ORDER BY op) || '}' AS ops FROM c GROUP BY t)
        SELECT '{' || string_agg('"' || t || '":' || ops, ',' ORDER BY t) || '}' AS per_table FROM j"""
    ),
    "heartbeat_windows": _changes(
        """, b AS (SELECT window_end_ms, count(*) AS received, count(*) FILTER (reason IS NULL) AS emitted,
            count(*) FILTER (reason IS NOT NULL) AS dropped,
            count(*) FILTER (reason IS NULL AND op = 'c') AS c, count(*) FILTER (reason IS NULL AND op = 'd') AS d,
            count(*) FILTER (reason IS NULL AND op = 'r') AS r, count(*) FILTER (reason IS NULL AND op = 'u') AS u
          FROM w GROUP BY window_end_ms),
        s AS (SELECT window_end_ms, CAST(sum(received) OVER x AS BIGINT) AS received, CAST(sum(emitted) OVER x AS BIGINT) AS emitted,
            CAST(sum(dropped) OVER x AS BIGINT) AS dropped, sum(c) OVER x AS c, sum(d) OVER x AS d, sum(r) OVER x AS r,
            sum(u) OVER x AS u FROM b WINDOW x AS (ORDER BY window_end_ms))
        SELECT 'heartbeat' AS event, window_end_ms, received, emitted, dropped,
          CASE WHEN emitted = 0 THEN '{}' ELSE '{"public.orders":{' || concat_ws(',', CASE WHEN c > 0 THEN '"c":' || c END,
            CASE WHEN d > 0 THEN '"d":' || d END, CASE WHEN r > 0 THEN '"r":' || r END, CASE WHEN u > 0 THEN '"u":' || u END)
            || '}}' END AS per_table,
          greatest(0, CAST((window_end_ms - (SELECT min(window_end_ms) FILTER (window_end_ms > 86400000) - 86400000 FROM b))
            // 1000 AS BIGINT)) AS uptime_seconds FROM s""",
        Template(_BEAT).substitute(ms=86400000),
    ),
    "heartbeat_by_table": _changes(
        """, b AS (SELECT window_end_ms, sch || '.' || tbl AS "table", op, count(*) AS n FROM
            (SELECT *, 'public' AS sch FROM w WHERE reason IS NULL) GROUP BY ALL)
        SELECT window_end_ms, "table", op,
          CAST(sum(n) OVER (PARTITION BY "table", op ORDER BY window_end_ms) AS BIGINT) AS n FROM b""",
        Template(_BEAT).substitute(ms=7 * 86400000),
    ),
    "rejects_by_reason": _changes(
        """SELECT reason AS drop_reason, sch || '.' || tbl AS "table", count(*) AS n FROM flow WHERE reason IS NOT NULL GROUP BY ALL"""
    ),
    "event_summary": _changes(
        """SELECT event_id AS eid, eo.op, eo.tbl AS "table", lsn_text AS lsn,
        CASE WHEN eo.op IN ('u', 'd') THEN 'N' END AS before_status,
        CASE WHEN eo.op IN ('c', 'u', 'r') THEN st END AS after_status FROM eo JOIN ch ON ch.seq = eo.seq"""
    ),
    # catalog
    "catalog_columns": _fleet(
        """SELECT uni.table_schema, uni.table_name, coalesce(string_agg(name, ',' ORDER BY ordinal), '') AS columns
        FROM uni LEFT JOIN cc ON cc.k = uni.k GROUP BY uni.table_schema, uni.table_name"""
    ),
    "catalog_enums": _fleet(
        """SELECT table_schema, table_name, name, udt_name, labels AS enum_labels FROM cc JOIN en USING (udt_name)"""
    ),
    "catalog_pk": _fleet("SELECT table_schema, table_name, primary_key FROM pk"),
    "catalog_unique": _fleet("SELECT table_schema, table_name, unique_indexes FROM uq"),
    "replica_identity": _fleet("SELECT table_schema, table_name, replica_identity FROM uni"),
    "catalog_tables": _fleet("SELECT table_schema, table_name FROM uni"),
    # drift
    "missing_columns": _drift('SELECT contract_id, table_schema, table_name, col AS "column", table_missing FROM miss'),
    "column_suggestions": _drift('SELECT contract_id, table_schema, table_name, col AS "column", suggestion FROM sugg'),
    "transform_type_mismatch": _drift(
        'SELECT contract_id, table_schema, table_name, col AS "column", data_type AS db_type, transform_name FROM tm'
    ),
    "unconfigured_columns": _drift(
        'SELECT contract_id, table_schema, table_name, col AS "column", data_type AS db_type FROM ex'
    ),
    "replica_findings": _drift("SELECT contract_id, table_schema, table_name, identity FROM rf"),
    "drift_summary": _drift(
        """, t AS (SELECT contract_id, count(*) AS tables FROM k1 GROUP BY contract_id),
        er AS (SELECT contract_id, count(*) AS n FROM (
            SELECT DISTINCT contract_id, k, CASE WHEN table_missing THEN '' ELSE col END, '' FROM miss
            UNION ALL SELECT contract_id, k, col, transform_name FROM tm) GROUP BY contract_id),
        wr AS (SELECT contract_id, count(*) AS n FROM (SELECT contract_id FROM rf UNION ALL SELECT contract_id FROM ex)
            GROUP BY contract_id)
        SELECT contract_id, coalesce(er.n, 0) AS errors, coalesce(wr.n, 0) AS warnings, tables,
          'validate: ' || coalesce(er.n, 0) || ' errors, ' || coalesce(wr.n, 0) || ' warnings across ' || tables || ' tables' AS footer,
          CAST(CASE WHEN er.n > 0 THEN 1 ELSE 0 END AS BIGINT) AS exit_code
        FROM t LEFT JOIN er USING (contract_id) LEFT JOIN wr USING (contract_id)"""
    ),
    "drift_lines": _drift(
        """, l AS (
          SELECT contract_id, table_schema, table_name, 0 AS section, '[OK]    ' || table_schema || '.' || table_name || ' — '
            || n_columns || ' columns, REPLICA IDENTITY ' || replica_identity AS line FROM okt
          UNION ALL SELECT DISTINCT contract_id, table_schema, table_name, 1, '[ERROR] ' || table_schema || '.' || table_name
            || ' — table not found in database' FROM miss WHERE table_missing
          UNION ALL SELECT contract_id, table_schema, table_name, 2, '[ERROR] ' || table_schema || '.' || table_name || '.' || col
            || ' — configured column not found in database' || coalesce(' (did you mean: ' || suggestion || '?)', '')
            FROM sugg WHERE NOT table_missing
          UNION ALL SELECT contract_id, table_schema, table_name, 3, '[ERROR] ' || table_schema || '.' || table_name || '.' || col
            || ' — transform ''' || transform_name || ''' requires a string column; db type is "' || data_type || '"' FROM tm
          UNION ALL SELECT contract_id, table_schema, table_name, 4, '[WARN]  ' || table_schema || '.' || table_name
            || ' — REPLICA IDENTITY ''' || identity || ''' (not FULL); UPDATE/DELETE ''before'' carries only the primary key. To fix: ALTER TABLE '
            || table_schema || '.' || table_name || ' REPLICA IDENTITY FULL;' FROM rf
          UNION ALL SELECT contract_id, table_schema, table_name, 5, '[WARN]  ' || table_schema || '.' || table_name || '.' || col
            || ' — present in database, not in config' FROM ex)
        SELECT contract_id, table_schema, table_name, CAST(section AS BIGINT) AS section, line FROM l"""
    ),
    "drift_ok_tables": _drift("SELECT contract_id, table_schema, table_name, n_columns, replica_identity FROM okt"),
    "missing_tables": _fleet(
        "SELECT table_schema, table_name FROM p WHERE k % 2 = 0 AND k NOT IN (SELECT k FROM uni)"
    ),
    # lint
    "lint_blank": _lint(
        f"""SELECT contract_id, {_at('name')}, 'must not be blank' AS message FROM k1 WHERE trim(table_name) = ''
        UNION ALL SELECT contract_id, {_at('schema')}, 'must not be blank' FROM k1 WHERE trim(table_schema) = ''"""
    ),
    "lint_pk": _lint(
        f"SELECT contract_id, {_at('primary_key')}, 'must contain at least one column name' AS message FROM k1 WHERE NOT has_pk"
    ),
    "lint_no_columns": _lint(
        f"""SELECT contract_id, {_at('columns')}, CASE WHEN bare THEN 'must contain at least one column'
        ELSE 'must contain at least one non-excluded column' END AS message FROM k1
        WHERE NOT EXISTS (SELECT 1 FROM k2 WHERE k2.k = k1.k AND NOT excluded)"""
    ),
    "lint_collisions": _lint(
        f"""SELECT contract_id, {_at('columns')}, 'output property name "' || coalesce(renamed, col)
        || '" is produced by multiple columns: [' || string_agg(col, ', ' ORDER BY i) || ']' AS message
        FROM k2 WHERE NOT excluded GROUP BY contract_id, pos, k, coalesce(renamed, col) HAVING count(*) > 1"""
    ),
    "lint_uri": _lint(
        f"""SELECT contract_id, {_at('iglu_schema')},
        'must be a well-formed iglu URI (iglu:<vendor>/<name>/jsonschema/<MODEL-REVISION-ADDITION>)' AS message
        FROM k1 WHERE NOT good_uri"""
    ),
    "lint_pk_transform": _lint(
        f"""SELECT contract_id, {_at('columns')}, 'primary-key column "' || col
        || '" cannot declare transforms — PK values feed the deterministic event_id' AS message
        FROM k2 WHERE has_pk AND col = 'id' AND len(chain) > 0"""
    ),
    "lint_excluded_transform": _lint(
        f"""SELECT contract_id, {_at('columns')}, 'column "' || col || '" is excluded; transforms would never run' AS message
        FROM k2 WHERE excluded AND len(chain) > 0"""
    ),
    "lint_duplicate_tables": _lint(
        """SELECT contract_id, 'tables' AS path, 'duplicate table ' || table_schema || '.' || table_name || ' at indices ['
        || string_agg(pos, ', ' ORDER BY pos) || ']' AS message FROM k1
        GROUP BY contract_id, table_schema, table_name HAVING count(*) > 1"""
    ),
    # starter artefacts
    "json_type_map": _fleet("SELECT table_schema, table_name, name, fragment, unmapped FROM frag", _FRAGMENT),
    "json_schemas": _fleet(
        """, r AS (SELECT uni.table_schema, uni.table_name,
            '{"type":["object","null"],"properties":{' || coalesce(string_agg('"' || name || '":' || CASE WHEN unmapped IS NULL
              THEN fragment ELSE '{"description":"unmapped Postgres type ''' || unmapped || ''' — refine manually"}' END, ','
              ORDER BY ordinal), '') || '}' || coalesce(',"required":[' || string_agg('"' || name || '"', ',' ORDER BY ordinal)
              FILTER (NOT is_nullable) || ']', '') || '}' AS shape
          FROM uni LEFT JOIN frag ON frag.k = uni.k GROUP BY uni.table_schema, uni.table_name)
        SELECT table_schema, table_name, 'schemas/com.acme/' || table_name || '_change/jsonschema/1-0-0' AS path,
          '{"$schema":"http://json-schema.org/draft-04/schema#","description":"Generated as a starting point for ' || table_schema
          || '.' || table_name || '. Review types and constraints before use. Arrays are described one level deep.","self":{"vendor":"com.acme","name":"'
          || table_name || '_change","format":"jsonschema","version":"1-0-0"},"type":"object","properties":{"op":{"type":"string","enum":["c","u","d","r"]},"before":'
          || shape || ',"after":' || shape || '},"required":["op"],"additionalProperties":true}' AS text FROM r""",
        _FRAGMENT,
    ),
    "scaffold_contract": _fleet(
        """SELECT 'scaffold' AS contract_id, uni.table_schema, uni.table_name,
          'iglu:com.acme/' || uni.table_name || '_change/jsonschema/1-0-0' AS schema_uri, coalesce(primary_key, '') AS primary_key,
          CASE WHEN name IS NOT NULL THEN row_number() OVER (PARTITION BY uni.k ORDER BY ordinal) - 1 END AS col_pos,
          name AS "column", name AS output_name, CASE WHEN name IS NOT NULL THEN false END AS exclude
        FROM uni LEFT JOIN cc ON cc.k = uni.k LEFT JOIN pk ON pk.k = uni.k"""
    ),
    "pk_hints": _fleet(
        """SELECT uni.table_schema, uni.table_name, CASE WHEN unique_indexes IS NULL
          THEN 'No unique index found; add a surrogate key or exclude this table.'
          ELSE 'Candidate unique index(es): (' || replace(replace(unique_indexes, ';', '); ('), ',', ', ') || ').' END AS hint
        FROM uni LEFT JOIN uq ON uq.k = uni.k WHERE uni.k NOT IN (SELECT k FROM pk)"""
    ),
    "slugify": """SELECT p_partkey, regexp_replace(regexp_replace(lower('_' || p_name || '  /' || p_brand || '!'),
        '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM part""",
}
