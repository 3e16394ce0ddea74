"""Replays told from new events by an index on disk, so that no state has to hold every id.

Each batch leaves its ids in hash buckets, and for each bucket a Bloom filter: words of 64 bits, an id in one word. A later
batch looks its ids up in the filters, as joins on bucket and word, and reads only those buckets of earlier batches
whose filter knows one of them. A filter never denies an id it holds; where it is wrong the ids themselves decide, so a false
positive costs a read and no event. A filter that is missing, as after a crash, counts as knowing everything.

A batch that is run again replaces what it left and looks only at batches before it, so it gives the same events.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.assemble import dedup
from rowtide.streaming.compaction import _path, batches, pack, read_list

IDS, FILTERS, MAYBE = "ids", "filters", "maybe"
_IDS = "event_id string, bucket int"
_FILTER = "bucket int, words bigint, word bigint, bits bigint"
#: Bits that an id sets in its word.
MARKS = 6


@dataclass(frozen=True)
class ReplayIndex:
    """``path`` is a directory every executor can reach; ``buckets`` and ``bits`` (of filter for each id) stay the same for it.

    Ids must not be null. ``buckets`` bounds the files of a batch; ``pack`` puts those of closed batches together.
    """

    spark: SparkSession
    path: str
    buckets: int = 64
    bits: int = 16

    def first_seen(self, evts: DataFrame, batch_id: int) -> DataFrame:
        """The events of a batch that no earlier batch had, one for each id: the first delivered. Their ids are recorded.

        ``evts`` is read twice; in ``on_batch`` of ``run_stream`` it comes from what the batch has written.
        """
        here = f"{self.path}/{IDS}/batch_id={batch_id}"
        ids = evts.select("event_id").distinct().withColumn("bucket", self._bucket())
        ids.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(here)
        self._write_filter(here)
        replayed = self.replayed(batch_id)
        first = dedup(evts)  # folds an id in the tasks, so the join sees each once
        return first if replayed is None else first.join(replayed, "event_id", "left_anti").select(*evts.columns)

    def replayed(self, batch_id: int) -> DataFrame | None:
        """(event_id) of those recorded for a batch that earlier ones have as well; None if there are no earlier ones."""
        older = self._units(batch_id)
        if not older:
            return None
        ids = self.spark.read.schema(_IDS).parquet(f"{self.path}/{IDS}/batch_id={batch_id}")
        blind = [u for u in older if not self._has_filter(u)]
        maybe, folders = ids.select("event_id"), []
        if known := [u for u in older if u not in blind]:
            filters = reduce(DataFrame.unionByName, [
                self.spark.read.schema(_FILTER).parquet(self._filter(u)).withColumn("unit", F.lit(u)) for u in known
            ])
            sizes = filters.select("unit", "bucket", "words").distinct()
            places = ids.join(sizes, "bucket").withColumns({"word": _word(F.col("words")), "mask": _mask()})
            hits = places.join(filters.drop("words"), ["unit", "bucket", "word"])
            hits = hits.where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
            found = f"{self.path}/{MAYBE}/batch_id={batch_id}"
            hits.select("unit", "bucket", "event_id").write.mode("overwrite").parquet(found)
            hits = self.spark.read.schema("unit string, bucket int, event_id string").parquet(found)
            maybe = hits.select("event_id")
            # at most buckets times segments and open batches, whatever the number of ids
            folders = [f"{r.unit}/bucket={r.bucket}" for r in hits.select("unit", "bucket").distinct().collect()]
        seen = [self.spark.read.schema("event_id string").parquet(*folders)] if folders else []
        seen += [self.spark.read.schema(_IDS).parquet(unit).select("event_id") for unit in blind]
        if not seen:
            return ids.select("event_id").limit(0)
        if blind:
            maybe = ids.select("event_id")
        return maybe.distinct().join(reduce(DataFrame.unionByName, seen), "event_id", "left_semi")

    def pack(self, before: int) -> None:
        """Pack the ids of the batches below ``before``, which will not be run again, and make the filters of the result."""
        pack(self.spark, self.path, IDS, before, by=("bucket",))
        content = read_list(self.spark, self.path, IDS)
        for segment in content["segments"]:
            if not self._has_filter(segment["folder"]):
                self._write_filter(segment["folder"])
        live = {s["folder"] for s in content["segments"]} | set(content["gone"])
        live |= {f"{self.path}/{IDS}/batch_id={b}" for b in batches(self.spark, self.path, IDS)}
        wanted = {self._filter(u).rsplit("/", 1)[1] for u in live}
        for name, keep in ((FILTERS, wanted), (MAYBE, {f"batch_id={b}" for b in batches(self.spark, self.path, IDS)})):
            folder, fs = _path(self.spark, f"{self.path}/{name}")
            for status in fs.listStatus(folder) if fs.exists(folder) else ():
                if status.getPath().getName() not in keep:
                    fs.delete(status.getPath(), True)

    def _units(self, batch_id: int) -> list[str]:
        """Folders that hold the ids of the batches before this one."""
        segments = read_list(self.spark, self.path, IDS)["segments"]
        last = segments[-1]["last"] if segments else -1
        if batch_id <= last:
            raise ValueError(f"batch {batch_id} is packed and can't be run again")
        ids = [b for b in batches(self.spark, self.path, IDS) if last < b < batch_id]
        return [s["folder"] for s in segments] + [f"{self.path}/{IDS}/batch_id={b}" for b in ids]

    def _filter(self, unit: str) -> str:
        return f"{self.path}/{FILTERS}/{unit.rsplit('/', 1)[1]}"

    def _has_filter(self, unit: str) -> bool:
        done, fs = _path(self.spark, f"{self._filter(unit)}/_SUCCESS")
        return fs.exists(done)

    def _write_filter(self, unit: str) -> None:
        ids = self.spark.read.schema(_IDS).parquet(unit)
        count = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) * self.bits / 64)).cast("long")
        sizes = ids.groupBy("bucket").agg(count.alias("words"))
        words = ids.join(sizes, "bucket").groupBy("bucket", "words", _word(F.col("words")).alias("word")).agg(F.bit_or(_mask()).alias("bits"))
        words.hint("rebalance", "bucket").write.mode("overwrite").parquet(self._filter(unit))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int")


def _word(words: Column) -> Column:
    return F.pmod(F.xxhash64("event_id", F.lit(1)), words)


def _mask() -> Column:
    """The bits of an id within its word."""
    h, one = F.xxhash64("event_id", F.lit(2)), F.lit(1).cast("long")
    out = None
    for i in range(MARKS):
        place = F.pmod(F.shiftright(h, 8 * i), F.lit(64)).cast("int")
        bit = F.call_function("shiftleft", one, place)
        out = bit if out is None else out.bitwiseOR(bit)
    return out
