"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.contract import CellTransform, ColumnSpec, TableContract, contract_df
from rowtide.functions import lsn_text, slugify
from rowtide.functions.cells import apply_chain
from rowtide.operators import accounting, assemble, catalog, control, drift, lint, scaffold
from rowtide.operators.infer import cell_kinds, landed_columns
from rowtide.operators.envelope import cell, parse, schema_snapshots, true_timestamp, with_fingerprint
from rowtide.operators.project import KEEP_NULLS, project
from rowtide.operators.schema_change import latest_snapshots, schema_changes
from rowtide.operators.schema_version import block_snapshots, schema_versions as number_versions
from rowtide.operators.transactions import transactions as find_transactions
from rowtide.plans import feeds, fleet
from rowtide.plans.feeds import APP_ID, CONTRACTS, CUSTOMERS, KNOWN_BLOCKS, ORDERS
from rowtide.sources.catalog import observed_columns
from rowtide.sources.chunks import chunked_snapshot
from rowtide.session import shared_folder, shelve
from rowtide.sources.feed import commit_order, snapshot_feed, union_feeds, with_snapshot
from rowtide.sources.landing import land, read_landed

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def _changes(spark: SparkSession, sf: str, block: str = "seen") -> DataFrame:
    """Parsed data changes of the orders feed."""
    return parse(control.drop_control(feeds.orders_feed(spark, sf)), block, KNOWN_BLOCKS)


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return parse(feeds.customers_feed(spark, sf), "seen", KNOWN_BLOCKS)


def _changes_of_both(spark: SparkSession, sf: str) -> DataFrame:
    both = union_feeds(feeds.orders_feed(spark, sf), feeds.customers_feed(spark, sf))
    return parse(control.drop_control(both), "seen", KNOWN_BLOCKS)


def _shop_changes(spark: SparkSession, sf: str, block: str = "columns", images: bool = False) -> DataFrame:
    return parse(control.drop_control(feeds.shop_feed(spark, sf)), block, KNOWN_BLOCKS, images)


def _shop_records(spark: SparkSession, sf: str, **named) -> DataFrame:
    return assemble.records(feeds.shop_feed(spark, sf), CONTRACTS, app_id=APP_ID, **{"known": KNOWN_BLOCKS, **named})


def _order_records(spark: SparkSession, sf: str, **named) -> DataFrame:
    return assemble.records(feeds.orders_feed(spark, sf), CONTRACTS, app_id=APP_ID, **{"known": KNOWN_BLOCKS, **named})


#: For queries that read nothing of a schema block.
LEAN = {"with_blocks": False, "known": KNOWN_BLOCKS}


def _joined(c: str, sep: str = ",") -> Column:
    return F.array_join(c, sep).alias(c)


def _long(c: str | Column, name: str | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("bigint").alias(name) if name else c.cast("bigint")


# Sources


@query
def feed_scan(spark, sf):
    f = feeds.orders_feed(spark, sf)
    return f.select("seq", "destination", "key", F.col("value").isNotNull().alias("has_value"))


@query
def feed_partitions(spark, sf):
    # The same offsets in four partitions: the order of changes is that of the log.
    dealt = feeds.orders_feed(spark, sf).select(
        F.expr("seq div 16").alias("seq"), "destination", "key", "value", F.expr("cast(seq div 4 % 4 as int)").alias("partition")
    )
    found = schema_changes(schema_snapshots(commit_order(parse(control.drop_control(dealt)))))
    return found.select("seq", "table", "previous_fingerprint", "current_fingerprint", _joined("added_columns"), _joined("removed_columns"))


@query
def landed_rejects(spark, sf):
    folder = shared_folder(spark)
    land(feeds.orders_feed(spark, sf), folder)
    lost = assemble.rejected(assemble.records(read_landed(spark, folder), CONTRACTS, app_id=APP_ID))
    return lost.select("seq", "drop_reason", F.col("value").isNotNull().alias("has_text"))


@query
def include_tables(spark, sf):
    kept = control.include_tables(_changes(spark, sf), [ORDERS])
    return kept.select("seq", "table_schema", "table_name", "op")


def _orders_snapshot(spark, sf, **named):
    o = feeds.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.concat(F.lit(" "), "o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("total"),
    )
    return snapshot_feed(
        o, db=feeds.DB, schema="public", name="orders", primary_key=["id"], lsn=22000000, ts_ms=1700000000000,
        seq=F.col("id") - 1000000000, **named,
    )


@query
def snapshot_rows(spark, sf):
    recs = assemble.records(_orders_snapshot(spark, sf), CONTRACTS, app_id=APP_ID)
    return assemble.events(recs).select(
        "seq", "event_id", "op", "payload", "cdc_source.is_snapshot", "cdc_source.column_fingerprint"
    )


@query
def snapshot_then_stream(spark, sf):
    both = with_snapshot(feeds.orders_feed(spark, sf), _orders_snapshot(spark, sf), "initial")
    recs = assemble.records(both, CONTRACTS, app_id=APP_ID)
    return (
        recs.where(F.col("drop_reason").isNull())
        .groupBy("op", "cdc_source.is_snapshot")
        .agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
    )


@query
def catalog_scan(spark, sf):
    cat = fleet.fleet_catalog(spark, sf, fleet.fleet_requests(spark, sf))
    return cat.columns.select(
        "table_schema", "table_name", "name", _long("ordinal"), "is_nullable", "data_type", "udt_name",
        _long("char_max_len"),
    )


@query
def observed_catalog(spark, sf):
    cols = observed_columns(_shop_changes(spark, sf))
    return cols.select("table_schema", "table_name", "name", _long("ordinal"), "is_nullable", "data_type", "udt_name")


@query
def landed_catalog(spark, sf):
    kinds = cell_kinds(_shop_changes(spark, sf, "seen", images=True))
    cols = landed_columns(kinds).withColumn("conflict", F.coalesce("conflict", F.lit("")))
    return cols.select("table_schema", "table_name", "name", _long("ordinal"), "is_nullable", "data_type", "udt_name", "conflict")


@query
def snapshot_in_chunks(spark, sf):
    """The last state of each order after a snapshot in chunks beside its changes."""
    parsed = parse(feeds.moving_orders_feed(spark, sf))
    rows, chunks = feeds.moving_orders_read(spark, sf)
    snapshot = chunked_snapshot(
        rows, parsed, chunks, db=feeds.DB, schema="public", name="orders", primary_key=("id",), width=feeds.CHUNK
    )
    both = commit_order(parse(union_feeds(snapshot, feeds.moving_orders_feed(spark, sf))))
    row = F.coalesce("after", "before")
    at = lambda name, kind: F.try_variant_get(cell(row, name), "$", kind).alias(name)
    both = both.select("seq", "op", "is_snapshot", at("id", "bigint"), at("status", "string"))
    last = both.groupBy("id").agg(F.max_by(F.struct("op", "status", "is_snapshot", "seq"), "seq").alias("last"))
    return last.where("last.op <> 'd'").select("id", "last.status", "last.is_snapshot", "last.seq")


# Filters and rejection


@query
def drop_tombstones(spark, sf):
    return control.drop_tombstones(feeds.orders_feed(spark, sf)).select("seq", "destination")


@query
def drop_heartbeats(spark, sf):
    kept = control.drop_heartbeats(feeds.orders_feed(spark, sf))
    return kept.select("seq", F.col("value").isNotNull().alias("has_value"))


def _judged(spark, sf):
    return assemble.classify(_changes(spark, sf), CONTRACTS)


@query
def op_filter(spark, sf):
    bad = _judged(spark, sf).select("seq", "op", "drop_reason")
    return bad.where(F.col("drop_reason") == "unsupported_op").select("seq", "op")


@query
def unconfigured_tables(spark, sf):
    bad = _judged(spark, sf).where(F.col("drop_reason") == "unconfigured_table")
    return bad.groupBy("table_schema", "table_name").agg(F.count(F.lit(1)).alias("n"))


@query
def reject_reasons(spark, sf):
    return _judged(spark, sf).select("seq", F.coalesce("drop_reason", F.lit("accepted")).alias("outcome"))


# Parsing and metadata


@query
def parse_envelope(spark, sf):
    return _changes(spark, sf).select(
        "seq", "unparseable", "op", "db", "table_schema", "table_name", "lsn_num", "txid", "is_snapshot", "ts_ms"
    )


@query
def row_images(spark, sf):
    text = lambda c: F.try_variant_get(cell(F.col(c), "total"), "$", "string")
    return _changes(spark, sf).select(
        "seq",
        F.col("before").isNotNull().alias("has_before"),
        F.col("after").isNotNull().alias("has_after"),
        text("before").alias("before_total"),
        text("after").alias("after_total"),
    )


@query
def lsn_format(spark, sf):
    both = _changes_of_both(spark, sf)
    return both.select("seq", lsn_text(F.col("lsn_num")).alias("lsn"))


@query
def txid(spark, sf):
    return _changes_of_both(spark, sf).select("seq", "txid")


@query
def snapshot_flag(spark, sf):
    both = _changes_of_both(spark, sf)
    return both.groupBy("table_name", "op", "is_snapshot").agg(F.count(F.lit(1)).alias("n"))


@query
def true_timestamp_ms(spark, sf):
    return _changes(spark, sf).select(
        "seq",
        F.unix_millis(true_timestamp(F.col("ts_ms"))).alias("ms"),
        F.date_format(true_timestamp(F.col("ts_ms")), "yyyy-MM-dd HH:mm:ss").alias("at"),
    )


REGISTRY["true_timestamp"] = REGISTRY.pop("true_timestamp_ms")


@query
def cdc_source_context(spark, sf):
    return assemble.events(_order_records(spark, sf)).select("seq", F.to_json("cdc_source", KEEP_NULLS).alias("context"))


@query
def column_fingerprint(spark, sf):
    return with_fingerprint(_changes(spark, sf, "columns"), KNOWN_BLOCKS).select("seq", "column_fingerprint")


@query
def schema_snapshot_rows(spark, sf):
    last = latest_snapshots(schema_snapshots(_shop_changes(spark, sf), KNOWN_BLOCKS))
    return last.select("seq", "table_schema", "table_name", "column_fingerprint", _joined("column_names"))


REGISTRY["schema_snapshots"] = REGISTRY.pop("schema_snapshot_rows")


# Projection and cell transforms


def _projected(spark, sf, contract: TableContract, feed=None) -> DataFrame:
    parsed = (feed or _customers)(spark, sf)
    image = F.coalesce(F.when(F.col("op") == "d", F.col("before")), F.col("after"))
    row = F.to_json(project(image, contract), KEEP_NULLS)
    return parsed.select("seq", F.when(image.isNotNull(), row).alias("row"))


def _customers_contract(*columns: ColumnSpec) -> TableContract:
    return TableContract("public", "customers", CUSTOMERS.schema_uri, ("id",), columns)


@query
def project_whitelist(spark, sf):
    return _projected(spark, sf, _customers_contract(ColumnSpec("full_name"), ColumnSpec("id")))


@query
def project_rename(spark, sf):
    return _projected(
        spark, sf, _customers_contract(ColumnSpec("id", rename="customerId"), ColumnSpec("full_name", rename="name"))
    )


@query
def project_exclude(spark, sf):
    return _projected(spark, sf, _customers_contract(ColumnSpec("id"), ColumnSpec("password_hash", exclude=True)))


@query
def project_null_fill(spark, sf):
    contract = _customers_contract(ColumnSpec("id"), ColumnSpec("nickname"), ColumnSpec("phone", transforms=("trim",)))
    return _projected(spark, sf, contract)


def _cells(spark, sf, column: str, *transforms) -> DataFrame:
    """A transformed column of the customers feed, value by value."""
    text = F.try_variant_get(cell(F.col("after"), column), "$", "string")
    chain = [CellTransform.of(t, column) for t in transforms]
    return _customers(spark, sf).select("seq", text.alias("text")).select(
        "seq", apply_chain(F.col("text"), chain).alias("cell")
    )


@query
def tx_lowercase(spark, sf):
    return _cells(spark, sf, "email", "lowercase")


@query
def tx_uppercase(spark, sf):
    return _cells(spark, sf, "email", "uppercase")


@query
def tx_trim(spark, sf):
    return _cells(spark, sf, "email", "trim")


@query
def tx_regex_extract(spark, sf):
    return _cells(spark, sf, "full_name", {"regex_extract": {"pattern": "#0*([1-9]*)0$", "group": 1}})


@query
def tx_regex_replace(spark, sf):
    return _cells(spark, sf, "email", {"regex_replace": {"pattern": "([eE])", "replacement": "<$1>"}})


@query
def tx_regex_mask(spark, sf):
    return _cells(spark, sf, "email", {"regex_replace": {"pattern": "^[^@]+@(.*)$", "replacement": "***@$1"}})


@query
def tx_chain(spark, sf):
    return _cells(
        spark, sf, "email", "trim", "lowercase", {"regex_replace": {"pattern": "customer", "replacement": "C"}},
        {"regex_extract": {"pattern": "^(C\\.[0-9]*[05])@", "group": 1}}, "lowercase",
    )


@query
def tx_type_guard(spark, sf):
    bad = _judged(spark, sf).select("seq", "op", "drop_reason")
    return bad.where(F.col("drop_reason") == "transform_type").select("seq", "op")


@query
def op_payload(spark, sf):
    return assemble.events(_order_records(spark, sf, **LEAN)).select("seq", "op", "payload")


@query
def both_images(spark, sf):
    updates = assemble.events(_order_records(spark, sf, **LEAN)).where(F.col("op") == "u")
    at = lambda side: F.get_json_object("payload", f"$.{side}.status").alias(f"{side}_status")
    return updates.select("seq", at("before"), at("after"))


@query
def route_by_contract_rows(spark, sf):
    recs = assemble.records(feeds.shop_feed(spark, sf), contract_df(spark, CONTRACTS), app_id=APP_ID, **LEAN)
    per = assemble.events(recs).groupBy("table_name", "schema_uri")
    return per.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("payload")).alias("payload_chars"))


@query
def route_by_table(spark, sf):
    per = assemble.events(_shop_records(spark, sf, **LEAN)).groupBy("table_name", "schema_uri")
    return per.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("payload")).alias("payload_chars"))


@query
def route_by_contract_version(spark, sf):
    recs = assemble.records(feeds.shop_feed(spark, sf), feeds.shop_contract_versions(spark, sf), app_id=APP_ID, **LEAN)
    return recs.groupBy("table_name", "schema_uri", "drop_reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("payload")).alias("payload_chars"), F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
    )


# Transactions


@query
def transactions(spark, sf):
    return find_transactions(_shop_changes(spark, sf, "seen"), gap=1 << 30).withColumn("tables", F.array_join("tables", ","))


# Identity


@query
def pk_values(spark, sf):
    recs = assemble.records(
        union_feeds(feeds.orders_feed(spark, sf), feeds.line_items_feed(spark, sf)), CONTRACTS, app_id=APP_ID,
        with_names=True, **LEAN,
    )
    return recs.where(F.col("drop_reason").isNull()).select("seq", "pk")


@query
def canonical_name(spark, sf):
    recs = assemble.records(
        union_feeds(feeds.orders_feed(spark, sf), feeds.line_items_feed(spark, sf)), CONTRACTS, app_id=APP_ID,
        with_names=True, **LEAN,
    )
    return recs.where(F.col("drop_reason").isNull()).select("seq", "canonical_name")


@query
def event_id(spark, sf):
    return assemble.events(_shop_records(spark, sf, **LEAN)).select("seq", "event_id")


def _flat(events: DataFrame) -> DataFrame:
    return events.select(
        "seq", "event_id", "app_id", F.unix_millis("true_tstamp").alias("true_ms"), "table_schema", "table_name",
        "op", "schema_uri", "payload", F.to_json("cdc_source", KEEP_NULLS).alias("cdc_source"), "lsn_num",
    )


@query
def events_full(spark, sf):
    return _flat(assemble.events(_shop_records(spark, sf)))


@query
def wire_form(spark, sf):
    return assemble.to_wire(assemble.events(_order_records(spark, sf)))


@query
def replay_dedup(spark, sf):
    once = assemble.dedup(assemble.events(_shop_records(spark, sf, **LEAN)).select("seq", "event_id", "table_name", "op"))
    return once.select("event_id", "table_name", "op", "seq")


# Schema changes


@query
def schema_changes_rows(spark, sf):
    found = schema_changes(schema_snapshots(_shop_changes(spark, sf), KNOWN_BLOCKS))
    return found.select("event", "table", "previous_fingerprint", "current_fingerprint",
                        _joined("added_columns"), _joined("removed_columns"))


REGISTRY["schema_changes"] = REGISTRY.pop("schema_changes_rows")


@query
def schema_change_diff(spark, sf):
    """Every part as a release of its type's schema: bit i of the key decides on column i."""
    k = F.col("p_partkey")
    names = F.array_compact(F.array(*[F.when(k.bitwiseAND(1 << i) > 0, F.lit(f"col_{i}")) for i in range(12)]))
    releases = feeds.table(spark, sf, "part").select(
        k.alias("seq"),
        F.lit("public").alias("table_schema"),
        F.lower("p_type").alias("table_name"),
        F.sha2(F.array_join(names, ","), 256).alias("column_fingerprint"),
        names.alias("column_names"),
    )
    found = schema_changes(releases, stretches=(64, 1024))
    return found.select("seq", "table", _joined("added_columns"), _joined("removed_columns"))


def _versions_of(found):
    lists = ("added", "dropped", "retyped", "widened", "tightened", "loosened")
    return found.select("seq", "table_schema", "table_name", "version", "change", *map(_joined, lists))


@query
def schema_versions(spark, sf):
    """Versions of the shop's tables, as its feed shows them."""
    return _versions_of(number_versions(block_snapshots(_shop_changes(spark, sf), KNOWN_BLOCKS)))


@query
def schema_version_history(spark, sf):
    """Every part as a release of its type's schema: which of eight columns it has, their types and nulls follow from the key."""
    k = F.col("p_partkey")

    def column(i):
        kind = F.element_at(F.array(*map(F.lit, ("integer", "number", "string"))), (F.expr("cast(p_partkey div 16 as int)") + i) % 3 + 1)
        c = F.struct(F.lit(f"col_{i}").alias("field"), kind.alias("kind"), F.lit("").alias("form"), ((k + i) % 5 != 0).alias("nullable"))
        return F.when(k.bitwiseAND(1 << i) > 0, c)

    props = F.array_compact(F.array(*[column(i) for i in range(8)]))
    releases = feeds.table(spark, sf, "part").select(
        k.alias("seq"), F.lit("public").alias("table_schema"), F.lower("p_type").alias("table_name"),
        F.sha2(F.to_json(props), 256).alias("column_fingerprint"), props.alias("properties"),
    )
    return _versions_of(number_versions(releases, stretches=(64, 1024)))


# Accounting


@query
def flow_totals(spark, sf):
    return accounting.flow_totals(_shop_records(spark, sf, **LEAN))


@query
def counts_by_table_op(spark, sf):
    return accounting.flow_by_table_op(_shop_records(spark, sf, **LEAN))


@query
def counts_nested(spark, sf):
    nested = accounting.nested_counts(accounting.flow_by_table_op(_shop_records(spark, sf, **LEAN)))
    return nested.select(F.to_json("per_table").alias("per_table"))


@query
def heartbeat_windows(spark, sf):
    beats = accounting.heartbeat(_order_records(spark, sf, **LEAN), "1 day")
    return beats.select(
        "event", F.unix_millis("window_end").alias("window_end_ms"), "received", "emitted", "dropped", "per_table",
        "uptime_seconds",
    )


@query
def heartbeat_by_table(spark, sf):
    beats = accounting.heartbeat_by_table(_order_records(spark, sf, **LEAN), "7 days")
    return beats.select(F.unix_millis("window_end").alias("window_end_ms"), "table", "op", "n")


@query
def rejects_by_reason(spark, sf):
    return accounting.rejects_by_reason(_shop_records(spark, sf, **LEAN))


@query
def reject_cube(spark, sf):
    cube = accounting.reject_cube(_shop_records(spark, sf, **LEAN))
    return cube.select("drop_reason", "table", "op", _long("level"), "n")


@query
def distinct_keys_by_table(spark, sf):
    # Sketches of a week each, put together again; each change arrives as many seconds late as its seq says.
    late = F.col("seq") % 1000 * 1000
    recs = _shop_records(spark, sf, with_names=True, **LEAN).where(F.col("drop_reason").isNull())
    # What the three passes below read, written once: parsing is the dear part.
    recs = shelve(recs.select("table_schema", "table_name", "drop_reason", "true_tstamp", "pk", late.alias("late")))
    arrived = F.timestamp_millis(F.unix_millis("true_tstamp") + F.col("late"))
    sketches = accounting.merged_sketches(accounting.flow_sketches(recs, "pk", "7 days", arrived), "table")
    told = accounting.read_sketches(sketches, (0.5,)).withColumnRenamed("keys", "estimate")
    at = F.concat_ws(".", "table_schema", "table_name").alias("table")
    # Lags are counted before they are compared, so that a busy table is a few rows by then.
    lags = recs.groupBy(at, "late").agg(F.count(F.lit(1)).alias("times"))
    share = lambda c: F.sum(F.when(c, F.col("times")).otherwise(0)) / F.sum("times")
    rank = lags.join(told.select("table", "lag_50"), "table").groupBy("table").agg(
        share(F.col("late") < F.col("lag_50")).alias("below"), share(F.col("late") <= F.col("lag_50")).alias("upto")
    )
    near = F.abs(F.col("estimate") - F.col("keys")) <= 4 * 0.0082 * F.col("keys")
    middle = (F.col("below") <= 0.5 + 4 * 0.0133) & (F.col("upto") >= 0.5 - 4 * 0.0133)
    both = accounting.distinct_keys(recs, "pk").join(told, "table").join(rank, "table")
    return both.select("table", "n", "keys", near.alias("near"), middle.alias("lag_near"))


@query
def event_summary(spark, sf):
    return accounting.event_summary(assemble.events(_order_records(spark, sf, **LEAN)))


# Catalog


@query
def catalog_columns(spark, sf):
    cat = catalog.assemble_catalog(fleet.fleet_catalog(spark, sf))
    return cat.select("table_schema", "table_name", F.array_join(F.col("columns.name"), ",").alias("columns"))


@query
def catalog_enums(spark, sf):
    cols = catalog.columns_with_enums(fleet.fleet_catalog(spark, sf))
    return cols.where(F.col("data_type") == "USER-DEFINED").select(
        "table_schema", "table_name", "name", "udt_name", _joined("enum_labels", "|")
    )


@query
def catalog_pk(spark, sf):
    return catalog.primary_key_columns(fleet.fleet_catalog(spark, sf)).select(
        "table_schema", "table_name", _joined("primary_key")
    )


@query
def catalog_unique(spark, sf):
    rows = catalog.unique_index_columns(fleet.fleet_catalog(spark, sf))
    lists = F.transform("unique_indexes", lambda i: F.array_join(i, ","))
    return rows.select("table_schema", "table_name", F.array_join(lists, ";").alias("unique_indexes"))


@query
def replica_identity(spark, sf):
    return catalog.assemble_catalog(fleet.fleet_catalog(spark, sf)).select(
        "table_schema", "table_name", "replica_identity"
    )


@query
def catalog_tables(spark, sf):
    return catalog.table_universe(fleet.fleet_catalog(spark, sf))


# Drift


def _fleet(spark, sf):
    return fleet.fleet_contract(spark, sf), fleet.fleet_catalog(spark, sf)


@query
def missing_columns(spark, sf):
    return drift.missing_columns(*_fleet(spark, sf)).drop("table_pos")


@query
def column_suggestions(spark, sf):
    contract, cat = _fleet(spark, sf)
    return drift.suggest(drift.missing_columns(contract, cat), cat).drop("table_pos", "table_missing")


@query
def transform_type_mismatch(spark, sf):
    return drift.type_mismatches(*_fleet(spark, sf)).drop("table_pos")


@query
def unconfigured_columns(spark, sf):
    return drift.unconfigured_columns(*_fleet(spark, sf)).drop("table_pos")


@query
def replica_findings(spark, sf):
    return drift.replica_findings(*_fleet(spark, sf)).drop("table_pos")


@query
def drift_summary(spark, sf):
    contract, cat = _fleet(spark, sf)
    out = drift.drift_summary(contract, cat)
    return out.select("contract_id", "errors", "warnings", "tables", "footer", _long("exit_code"))


@query
def drift_lines(spark, sf):
    contract, cat = _fleet(spark, sf)
    lines = drift.drift_lines(contract, cat)
    return lines.select("contract_id", "table_schema", "table_name", _long("section"), "line")


@query
def drift_ok_tables(spark, sf):
    contract, cat = _fleet(spark, sf)
    return drift.ok_tables(contract, cat).drop("table_pos")


@query
def missing_tables(spark, sf):
    return catalog.missing_tables(fleet.fleet_requests(spark, sf), fleet.fleet_catalog(spark, sf))


# Lint


def _lint(name: str, rule: Callable[[DataFrame], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, sf: rule(fleet.fleet_contract(spark, sf, defects=True))


_lint("lint_blank", lint.blank_names)
_lint("lint_pk", lint.empty_primary_key)
_lint("lint_no_columns", lint.nothing_emitted)
_lint("lint_collisions", lint.output_collisions)
_lint("lint_uri", lint.malformed_uri)
_lint("lint_pk_transform", lint.transform_on_key)
_lint("lint_excluded_transform", lint.transform_on_excluded)
_lint("lint_duplicate_tables", lint.duplicate_tables)


# Starter artefacts


@query
def json_type_map(spark, sf):
    typed = scaffold.json_type(catalog.columns_with_enums(fleet.fleet_catalog(spark, sf)))
    return typed.select("table_schema", "table_name", "name", "fragment", "unmapped")


@query
def json_schemas(spark, sf):
    return scaffold.json_schemas(fleet.fleet_catalog(spark, sf), "com.acme")


@query
def scaffold_contract(spark, sf):
    rows = scaffold.scaffold_contract(fleet.fleet_catalog(spark, sf), "com.acme")
    return rows.select(
        "contract_id", "table_schema", "table_name", "schema_uri", _joined("primary_key"), _long("col_pos"), "column",
        "output_name", "exclude",
    )


@query
def pk_hints(spark, sf):
    return scaffold.pk_hints(fleet.fleet_catalog(spark, sf))


@query
def slug(spark, sf):
    p = feeds.table(spark, sf, "part")
    text = F.concat(F.lit("_"), "p_name", F.lit("  /"), "p_brand", F.lit("!"))
    return p.select("p_partkey", slugify(text).alias("slug"))


REGISTRY["slugify"] = REGISTRY.pop("slug")
