import base64

from pyspark.sql import functions as F

from rowtide.operators.assemble import to_wire


def test_wire_bodies_have_no_line_breaks(spark):
    """Also where the session cuts base64 into lines; characters are not looked up one by one for it."""
    context = F.struct(F.lit("x" * 300).alias("a"))
    events = spark.range(1).select(
        F.col("id").alias("seq"), F.lit("e").alias("event_id"), F.lit("a").alias("app_id"), F.timestamp_millis(F.lit(5)).alias("true_tstamp"),
        F.lit("iglu:x").alias("schema_uri"), F.lit('{"op":"c","after":"' + "y" * 300 + '"}').alias("payload"), context.alias("cdc_source"),
    )
    plain = to_wire(events).first()
    spark.conf.set("spark.sql.legacy.chunkBase64String.enabled", "true")
    try:
        assert to_wire(events).first() == plain
    finally:
        spark.conf.unset("spark.sql.legacy.chunkBase64String.enabled")
    assert b"y" * 300 in base64.b64decode(plain.ue_px) and not set("\r\n") & {*plain.ue_px, *plain.cx}
    wide = spark.createDataFrame([], events.schema)
    assert "translate" not in to_wire(wide)._jdf.queryExecution().analyzed().toString()
