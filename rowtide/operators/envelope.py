"""Change envelopes: JSON text to typed columns."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions import column_names, fingerprint, lsn_text

_FIELD = "struct<field:string,type:string,name:string,optional:boolean>"
_IMAGE = "map<string,variant>"
_SOURCE = (
    "struct<db:string,`schema`:string,`table`:string,lsn:bigint,txId:bigint,ts_ms:bigint,snapshot:string>"
)
_FIELDS = f"array<{_FIELD}>"
# What is read of the schema block: its columns, or whether it has any.
_BLOCK = {
    "columns": f"struct<fields:array<struct<field:string,fields:{_FIELDS}>>>",
    "seen": "struct<fields:array<struct<field:string>>>",
}


def _envelope(block: str, images: bool) -> str:
    rows = f"before:{_IMAGE},after:{_IMAGE}," if images else ""
    payload = f"struct<op:string,{rows}source:{_SOURCE}>"
    return f"_malformed string, schema {_BLOCK[block]}, payload {payload}"


def parse(feed: DataFrame, block: str = "columns", known: Sequence[str] = (), images: bool = True) -> DataFrame:
    """Envelopes as columns, one JSON pass per record.

    ``from_json`` reads the fixed part into typed fields and leaves the cells of the row images as
    VARIANT. Records it cannot fit to that shape (not JSON, or a field of an unexpected type) are
    read again field by field as VARIANT; only they pay for it.

    ``before`` and ``after`` are null unless the envelope holds an object there; ``columns`` is null
    when the schema block has no ``after`` struct. The block is most of an envelope and the same on nearly all of them.
    Who only asks whether there are columns takes ``block="seen"``, which gives ``has_columns`` in place of ``columns``.

    ``known`` are schema blocks that are expected, as the connector writes them. An envelope that begins with one of them,
    letter by letter, has it as its block, which is not read again: only the text behind it is parsed, and ``known_block``
    is its number. All others are parsed as ever, so it is a matter of time only which blocks are known.

    Cells are most of what is left to parse. Who reads no row image takes ``images=False``: there are no ``before`` and ``after``
    then, and their text is read over; that it is JSON is still checked.
    """
    done = parsed_columns(feed, block, known, images)
    return fenced(done, "parsed", records=F.count(F.lit(1)), unparseable=F.count_if("unparseable"))


def parsed_columns(feed: DataFrame, block: str = "columns", known: Sequence[str] = (), images: bool = True) -> DataFrame:
    """``parse`` without the fence, for callers that put their own further up."""
    known = _sound_blocks(known)
    feed_columns = feed.columns
    text, number = F.col("value"), F.lit(None).cast("int")
    for i, b in reversed(list(enumerate(known))):
        number = F.when(F.col("value").startswith(_head(b)), i).otherwise(number)
    if known:
        feed = feed.withColumn("known_block", number)
        # The text behind a block is cut out by bytes: code points would have to be counted.
        begin = _by_block([F.lit(len(_head(b).encode()) - len(_PAYLOAD) + 1) for b in known], F.lit(1))
        rest = F.substring(F.col("value").cast("binary"), begin, F.lit(2**31 - 1)).cast("string")
        text = F.when(F.col("known_block").isNull(), F.col("value")).otherwise(F.concat(F.lit("{"), rest))
    first = F.from_json(text, _envelope(block, images), {"columnNameOfCorruptRecord": "_malformed"})
    fast, rows = F.col("_fast.payload"), ("before", "after") if images else ()
    fields = {
        "op": fast["op"], **{c: fast[c] for c in rows},
        **{c: fast["source"][c] for c in ("db", "schema", "table", "lsn", "txId", "ts_ms", "snapshot")},
        "_block": _fast_block(F.col("_fast.schema"), block, known),
    }
    told = bool(known) and block == "columns"
    if told:
        fields["_again"] = F.col("_fast.schema").isNotNull()
    # Single fields, not the parsed row, go through the step below, which copies what it is given.
    read = feed.select("*", first.alias("_fast")).select(
        *feed.columns, F.col("_fast._malformed").isNotNull().alias("_misfit"), *[c.alias(f"_f_{n}") for n, c in fields.items()]
    )
    # A lambda is interpreted, so this rare path adds nothing to the generated code of the usual one.
    again = F.get(F.transform(F.array(F.try_parse_json("value")), lambda v: _loose(v, block)), F.lit(0))
    read = read.withColumn("_slow", F.when(F.col("_misfit"), again))

    def pick(name: str, slow: str | None = None) -> Column:
        return F.when(F.col("_misfit"), F.col(f"_slow.{slow or name}")).otherwise(F.col(f"_f_{name}"))

    def source(name: str) -> Column:
        return pick(name, f"source.{name}")

    return read.select(
        *feed_columns,
        F.when(F.col("_misfit"), F.col("_slow.unparseable")).otherwise(F.lit(False)).alias("unparseable"),
        pick("op").alias("op"),
        *[pick(c).alias(c) for c in rows],
        F.coalesce(source("db"), F.lit("")).alias("db"),
        F.coalesce(source("schema"), F.lit("")).alias("table_schema"),
        F.coalesce(source("table"), F.lit("")).alias("table_name"),
        source("lsn").alias("lsn_num"),
        source("txId").alias("txid"),
        (F.coalesce(source("snapshot"), F.lit("false")) != "false").alias("is_snapshot"),
        F.coalesce(source("ts_ms"), F.lit(0)).alias("ts_ms"),
        pick("_block").alias({"columns": "columns", "seen": "has_columns"}[block]),
        # a block told again behind the payload holds, and a text that had to be read again is told by what was read
        *([F.when(~F.col("_misfit") & ~F.col("_f__again"), F.col("known_block")).alias("known_block")] if told else []),
    )


def has_columns(parsed: DataFrame) -> Column:
    """Whether a parsed record has a readable schema block, of ``parse`` with columns or without."""
    return F.col("has_columns") if "has_columns" in parsed.columns else F.col("columns").isNotNull()


_PAYLOAD = '"payload":'


def _head(block: str) -> str:
    """What an envelope with this block begins with."""
    return f'{{"schema":{block},{_PAYLOAD}'


def _image_columns(block: str) -> list[dict] | None:
    return next((f.get("fields", []) for f in json.loads(block)["fields"] if f["field"] == "after"), None)


def _sound_blocks(known: Sequence[str]) -> list[str]:
    """Those whose columns have the types they should, so that reading them here gives what reading them in Spark would."""

    def sound(block: str) -> bool:
        try:
            fields = json.loads(block, object_pairs_hook=_once)["fields"]
            if not all(isinstance(f["field"], str) for f in fields):
                return False
            images = [c for f in fields for c in f.get("fields", [])]
            kinds = {"field": str, "type": str, "name": str, "optional": bool}
            return all(c[k] is None or isinstance(c[k], kinds[k]) for c in images for k in c.keys() & kinds.keys())
        except (ValueError, KeyError, TypeError, AttributeError):
            return False

    return [b for b in dict.fromkeys(known) if sound(b)]


def _once(pairs: list[tuple]) -> dict:
    if len(dict(pairs)) < len(pairs):
        raise ValueError("a key is repeated")
    return dict(pairs)


def _by_block(values: Sequence[Column], other: Column) -> Column:
    out = other
    for i, v in reversed(list(enumerate(values))):
        out = F.when(F.col("known_block") == i, v).otherwise(out)
    return out


def _literal_columns(block: str) -> Column:
    columns = _image_columns(block)
    if columns is None:
        return F.lit(None).cast(_FIELDS)
    each = [F.struct(*[F.lit(c.get(k)).alias(k) for k in ("field", "type", "name", "optional")]) for c in columns]
    return F.array(*each).cast(_FIELDS)


def fenced(df: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """Observe metrics as rows pass; filters above stay above.

    A filter on a derived column would otherwise be rewritten in terms of the raw text and pushed
    down, and each envelope would be parsed twice: once to filter and once to project. Columns
    nobody reads are still pruned.
    """
    return df.observe(f"{name}-{uuid.uuid4().hex}", *[m.alias(n) for n, m in metrics.items()])


def _after_columns(fields: Column) -> Column:
    after = F.get(fields, F.array_position(fields["field"], "after").cast("int") - 1)
    return F.when(after.isNotNull(), F.coalesce(after["fields"], F.array().cast(_FIELDS)))


def _fast_block(schema: Column, block: str, known: Sequence[str]) -> Column:
    if block == "columns":
        told, read = [_literal_columns(b) for b in known], _after_columns(schema["fields"])
    else:
        told = [F.lit(_image_columns(b) is not None) for b in known]
        read = F.coalesce(F.array_contains(schema["fields"]["field"], "after"), F.lit(False))
    return F.when(schema.isNotNull(), read).otherwise(_by_block(told, F.lit(None) if block == "columns" else F.lit(False)))


def _loose(v: Column, block: str = "columns") -> Column:
    """The fields of an envelope that does not fit the typed shape."""

    def at(node: Column, path: str, kind: str) -> Column:
        return F.try_variant_get(node, path, kind)

    def number(path: str) -> Column:
        node = at(v, path, "variant")
        numeric = F.schema_of_variant(node).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
        return F.when(numeric, at(node, "$", "bigint"))

    def image(path: str) -> Column:
        node = at(v, path, "variant")
        return F.when(F.schema_of_variant(node).startswith("OBJECT"), at(node, "$", _IMAGE))

    source = F.struct(
        *[at(v, f"$.payload.source.{c}", "string").alias(c) for c in ("db", "schema", "table")],
        number("$.payload.source.lsn").alias("lsn"),
        number("$.payload.source.txId").alias("txId"),
        at(v, "$.payload.source.ts_ms", "bigint").alias("ts_ms"),
        at(v, "$.payload.source.snapshot", "string").alias("snapshot"),
    )
    columns = _after_columns(_loose_fields(v, "$.schema.fields"))
    told = columns if block == "columns" else columns.isNotNull()
    return F.struct(
        v.isNull().alias("unparseable"),
        at(v, "$.payload.op", "string").alias("op"),
        image("$.payload.before").alias("before"),
        image("$.payload.after").alias("after"),
        source.alias("source"),
        told.alias("_block"),
    )


def _loose_fields(v: Column, path: str) -> Column:
    """The ``after`` structs of a schema block at ``path``, as far as their fields can be read."""

    def at(node: Column, path: str, kind: str) -> Column:
        return F.try_variant_get(node, path, kind)

    return F.transform(
        F.filter(at(v, path, "array<variant>"), lambda f: F.coalesce(at(f, "$.field", "string") == "after", F.lit(False))),
        lambda f: F.struct(
            F.lit("after").alias("field"),
            F.transform(
                at(f, "$.fields", "array<variant>"),
                lambda c: F.struct(
                    *[at(c, f"$.{k}", "string").alias(k) for k in ("field", "type", "name")],
                    at(c, "$.optional", "boolean").alias("optional"),
                ),
            ).alias("fields"),
        ),
    )


def cell(image: Column, name: str) -> Column:
    """A cell of a row image as VARIANT; null when absent."""
    return F.try_element_at(image, F.lit(name))


def true_timestamp(ts_ms: Column) -> Column:
    """Commit time of the change."""
    return F.timestamp_millis(ts_ms)


def cdc_source(connector: str, lsn: Column | None = None) -> Column:
    """The lineage context of a parsed record; ``connector`` is the configured name."""
    return F.struct(
        F.lit(connector).alias("connector"),
        F.col("db"),
        F.nullif(F.col("table_schema"), F.lit("")).alias("schema"),
        F.col("table_name").alias("table"),
        (lsn_text(F.col("lsn_num")) if lsn is None else lsn).alias("lsn"),
        F.col("txid"),
        F.col("is_snapshot"),
        F.col("ts_ms"),
        F.col("column_fingerprint"),
    )


def with_fingerprint(parsed: DataFrame, known: Sequence[str] = ()) -> DataFrame:
    """Adds ``column_fingerprint`` and ``column_names``, both null without an ``after`` schema or where it was not read.

    ``known`` are the blocks ``parsed`` was made with.
    """
    if "columns" not in parsed.columns:
        told = [F.lit(None).cast("string"), F.lit(None).cast("array<string>")]
    else:
        told = [fingerprint(F.col("columns")), column_names(F.col("columns"))]
    if "known_block" in parsed.columns:
        blocks = [_image_columns(b) for b in _sound_blocks(known)]
        names = [F.lit(None).cast("array<string>") if b is None else F.array(*[F.lit(c.get("field") or "") for c in b]).cast("array<string>") for b in blocks]
        told = [_by_block([F.lit(_fingerprint(b)) for b in blocks], told[0]), _by_block(names, told[1])]
    kept = [c for c in parsed.columns if c != "known_block"]
    return parsed.select(*kept, told[0].alias("column_fingerprint"), told[1].alias("column_names"))


def _fingerprint(columns: list[dict] | None) -> str | None:
    """``fingerprint`` of a known block."""
    if columns is None:
        return None
    line = lambda c: "\t".join([*(c.get(k) or "" for k in ("field", "type", "name")), "false" if c.get("optional") is False else "true"])
    return hashlib.sha256("\n".join(map(line, columns)).encode()).hexdigest()


def schema_snapshots(parsed: DataFrame, known: Sequence[str] = ()) -> DataFrame:
    """One schema snapshot per record that has a readable schema block."""
    return (
        with_fingerprint(parsed, known)
        .where(F.col("columns").isNotNull())
        .select("seq", "table_schema", "table_name", "column_fingerprint", "column_names")
    )
