"""Classification of records and assembly of events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.contract import TableContract, require_sound
from rowtide.functions.ids import EVENT_ID_NAMESPACE, digest_uuid, lsn_text, name_digest
from rowtide.operators.control import drop_control
from rowtide.operators.envelope import cdc_source, fenced, has_columns, parsed_columns, true_timestamp, with_fingerprint
from rowtide.operators.project import INLINE_COLUMNS, KEEP_NULLS, canonical_name, key_image, payload, router

OPERATIONS = ("c", "u", "d", "r")

EVENT_COLUMNS = (
    "seq", "event_id", "app_id", "true_tstamp", "table_schema", "table_name", "op", "schema_uri",
    "payload", "cdc_source", "lsn_num",
)
REJECT_COLUMNS = ("seq", "destination", "value", "table_schema", "table_name", "op", "drop_reason")


def drop_reason(bad_cell: Column, has_block: Column | None = None) -> Column:
    """Why a record is rejected, the first of these that holds; null when it is accepted."""
    has_block = F.col("columns").isNotNull() if has_block is None else has_block
    op = F.coalesce(F.col("op"), F.lit(""))
    no_before, no_after = F.col("before").isNull(), F.col("after").isNull()
    return (
        F.when(F.col("unparseable"), "unparseable")
        .when(~has_block, "missing_after_schema")
        .when(F.col("route").isNull(), "unconfigured_table")
        .when(bad_cell, "transform_type")
        .when(~op.isin(*OPERATIONS), "unsupported_op")
        .when(op.isin("c", "r", "u") & no_after, "missing_image")
        .when(op.isin("u", "d") & no_before, "missing_image")
    )


def classify(parsed: DataFrame, contracts: Sequence[TableContract], inline_columns: int = INLINE_COLUMNS) -> DataFrame:
    """Adds the route to a contract and ``drop_reason``; every record stays."""
    r = router(contracts, inline_columns)
    return r.route(parsed).withColumn("drop_reason", drop_reason(r.bad_cell(), has_columns(parsed)))


def records(
    feed: DataFrame,
    contracts: Sequence[TableContract] | DataFrame,
    *,
    app_id: str = "cdc",
    connector: str = "postgres",
    per_table_app_id: bool = False,
    namespace: str = EVENT_ID_NAMESPACE,
    inline_columns: int = INLINE_COLUMNS,
    with_names: bool = False,
    with_blocks: bool = True,
    known: Sequence[str] = (),
) -> DataFrame:
    """Every data change of the feed, accepted or rejected, in one pass and without a shuffle.

    This wide form is what to write once at scale; ``events``, ``rejected``, the accounting and the
    schema changes are then cheap column reads of it. The flow totals are also observed as the
    records pass, under a metric named ``flow-...``. ``with_names`` adds what the id is made of:
    ``canonical_name``, and the key as ``pk``. A feed landed by ``rowtide.sources.landing`` is taken
    as it is, without parsing. ``contracts`` are objects, or rows as of ``contract_df``, which may be a
    fleet's and do not pass through the driver; rows with ``valid_from``, as of ``contract_versions``, are in force
    from that commit position on. Counts, keys and ids need no more of a schema block than that it is there; without
    ``with_blocks`` its columns are not read, and ``column_fingerprint`` and ``column_names`` are null, also in ``cdc_source``. ``known`` are
    schema blocks that are expected, as for ``parse``.
    """
    require_sound(feed.sparkSession, contracts)
    r = router(contracts, inline_columns)
    landed = "columns" in feed.columns
    parsed = feed if landed else parsed_columns(drop_control(feed), "columns" if with_blocks else "seen", known)
    routed = r.route(with_fingerprint(parsed, known))
    judged = routed.select(
        "*",
        drop_reason(r.bad_cell(), has_columns(parsed)).alias("drop_reason"),
        lsn_text(F.col("lsn_num")).alias("lsn"),
        key_image().alias("key_image"),
    )
    accepted = F.col("drop_reason").isNull()
    own = F.coalesce(F.col("table_app_id"), F.lit(app_id)) if per_table_app_id else F.lit(app_id)
    kept = ["seq", "table_schema", "table_name", "op", "schema_uri", "lsn_num", "drop_reason", "destination",
            "column_fingerprint", "column_names", "ts_ms"]
    named = judged.select(
        *kept,
        F.when(accepted, payload(r.image("before"), r.image("after"))).alias("payload"),
        F.when(accepted, canonical_name(connector, F.col("lsn"), r.primary_key(sort=True))).alias("canonical_name"),
        *([F.when(accepted, r.primary_key()).alias("pk")] if with_names else []),
        F.when(accepted, own).alias("app_id"),
        cdc_source(connector, F.col("lsn")).alias("cdc_source"),
        F.when(~accepted, F.col("value")).alias("value"),
    )
    hashed = named.withColumn("_digest", name_digest(F.col("canonical_name"), namespace))
    done = hashed.select(
        "seq",
        digest_uuid(F.col("_digest")).alias("event_id"),
        "app_id",
        true_timestamp(F.col("ts_ms")).alias("true_tstamp"),
        "table_schema",
        "table_name",
        "op",
        "schema_uri",
        "payload",
        "cdc_source",
        "lsn_num",
        "drop_reason",
        "destination",
        "value",
        "column_fingerprint",
        "column_names",
        *(["canonical_name", "pk"] if with_names else []),
    )
    reason = F.col("drop_reason")
    return fenced(
        done,
        "flow",
        received=F.count(F.lit(1)),
        emitted=F.count_if(reason.isNull()),
        dropped=F.count_if(reason.isNotNull()),
    )


def events(recs: DataFrame) -> DataFrame:
    """The accepted records as events."""
    return recs.where(F.col("drop_reason").isNull()).select(*EVENT_COLUMNS)


def rejected(recs: DataFrame) -> DataFrame:
    """The rejected records with the reason."""
    return recs.where(F.col("drop_reason").isNotNull()).select(*REJECT_COLUMNS)


def dedup(evts: DataFrame) -> DataFrame:
    """One row per event id: the first delivered.

    A replayed id is folded inside each task before the shuffle, so an id that makes up a large
    share of the feed does not gather on one task.
    """
    rest = [c for c in evts.columns if c != "event_id"]
    order = F.struct("seq", *(["payload"] if "payload" in rest else []))
    first = F.min_by(F.struct(*rest), order)
    return evts.groupBy("event_id").agg(first.alias("_e")).select(*[
        "event_id" if c == "event_id" else f"_e.{c}" for c in evts.columns
    ])


def to_wire(
    evts: DataFrame,
    *,
    context_uri: str = "iglu:com.example/cdc_source/jsonschema/1-0-0",
    event_envelope_uri: str = "iglu:com.example/unstruct_event/jsonschema/1-0-0",
    contexts_envelope_uri: str = "iglu:com.example/contexts/jsonschema/1-0-0",
) -> DataFrame:
    """Events as collector parameters: id, application, time, and the two JSON bodies in base64.

    The URIs of the context and of the two envelopes belong to the receiver; pass those it expects.
    """

    def b64(c: Column) -> Column:
        # Line breaks are there only if the session asks for them; ``translate`` would look up each character.
        return F.replace(F.base64(F.encode(c, "UTF-8")), F.lit("\r\n"), F.lit(""))

    def described(uri: Column, data: Column) -> Column:
        return F.concat(F.lit('{"schema":'), _json_text(uri), F.lit(',"data":'), data, F.lit("}"))

    event = described(F.lit(event_envelope_uri), described(F.col("schema_uri"), F.col("payload")))
    source = described(F.lit(context_uri), F.to_json("cdc_source", KEEP_NULLS))
    context = described(F.lit(contexts_envelope_uri), F.concat(F.lit("["), source, F.lit("]")))
    return evts.select(
        "seq",
        F.lit("ue").alias("e"),
        F.col("event_id").alias("eid"),
        F.col("app_id").alias("aid"),
        F.unix_millis("true_tstamp").cast("string").alias("ttm"),
        b64(event).alias("ue_px"),
        b64(context).alias("cx"),
    )


def _json_text(c: Column) -> Column:
    """A string as a JSON string literal."""
    text = F.to_json(F.struct(c.alias("s")))
    return F.substring(text, F.lit(6), F.length(text) - 6)
