import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from rowtide.session import PIECES, spread


def _sizes(df):
    return [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]


def _read(spark, path, splits):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(path.stat().st_size // splits))
    try:
        df = spark.read.parquet(str(path))
        assert df.rdd.getNumPartitions() >= splits
        return _sizes(spread(df))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_rows_of_a_row_group_go_to_all_slots(spark, tmp_path):
    """Of a scan's splits only one has the row group, whatever their number."""
    slots = spark.sparkContext.defaultParallelism
    pq.write_table(pa.table({"k": range(40_000)}), tmp_path / "one.parquet")
    sizes = _read(spark, tmp_path / "one.parquet", slots)
    assert sum(sizes) == 40_000 and len(sizes) == PIECES * slots and max(sizes) < 2 * min(sizes)


def test_many_splits_are_left_alone(spark, tmp_path):
    many = spark.range(0, 4_000, 1, PIECES * spark.sparkContext.defaultParallelism)
    assert spread(many) is many
