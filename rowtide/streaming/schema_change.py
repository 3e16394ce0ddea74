"""Schema changes of a running stream.

What a task has of a table is folded to a row for each schema: the schema and, packed, the places in the delivery order
where it was seen. That is exact under any split of a table over tasks, and eight bytes a record at most before they are
compressed. Behind the shuffle a table's places are put in order and compared with the schema it had before.

``change_stream`` keeps that schema in the state store, by table. ``carry_changes`` does the same work for one batch of
``foreachBatch``, which has no state store: there it is a small table, a version for each batch id. Batch ids are
consecutive, also over restarts, so a batch finds its state under the id before its own; older versions are removed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.schema_change import TABLE, describe

_PACKED = "table_schema string, table_name string, fingerprint string, names array<string>, places binary"
_MOVES = (
    "is_state boolean, seq long, table_schema string, table_name string, _prev string, _prev_names array<string>, "
    "column_fingerprint string, column_names array<string>"
)


def packed(recs: DataFrame) -> DataFrame:
    """(table_schema, table_name, fingerprint, names, places): a row for each task, table and schema of it."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np

        found: dict[tuple, tuple[list, list]] = {}
        for batch in batches:
            part = pa.Table.from_batches([batch])
            keys = part.group_by(["table_schema", "table_name", "column_fingerprint"], use_threads=False).aggregate(
                [("seq", "list"), ("names", "first")]
            )
            for row in zip(*(keys.column(c) for c in ("table_schema", "table_name", "column_fingerprint", "names_first", "seq_list")), strict=True):
                *key, names, places = row
                known = found.setdefault(tuple(k.as_py() for k in key), (names.as_py(), []))
                known[1].append(places.values.to_numpy())
        rows = []
        for (schema, name, fingerprint), (names, places) in found.items():
            steps = np.diff(np.sort(np.concatenate(places)), prepend=0)
            rows.append((schema, name, fingerprint, names.split("\n") if names is not None else [], zlib.compress(steps.tobytes(), 1)))
        if rows:
            kinds = (pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["table_schema", "table_name", "fingerprint", "names", "places"],
            )

    # names as one text: a list can't be carried along by the grouping in the task
    text = F.when(F.size("column_names") > 0, F.array_join("column_names", "\n"))
    known = recs.where(F.col("column_fingerprint").isNotNull())
    return known.select("seq", *TABLE, "column_fingerprint", text.alias("names")).mapInArrow(go, _PACKED)


def _finder() -> Callable:
    """A function from (rows of ``packed`` of one table, (fingerprint, names) before them) to its moves and the schema after
    them. Built inside a function so that executors need no installation."""

    def moves(rows, before):
        import zlib

        import numpy as np

        names, places, prints = {}, [], []
        for fingerprint, listed, data in rows:
            names[fingerprint] = list(listed)
            some = np.cumsum(np.frombuffer(zlib.decompress(data), np.int64))
            places.append(some)
            prints.append((fingerprint, len(some)))
        order = sorted(names)  # rows at one place go by fingerprint
        number = np.concatenate([np.full(n, order.index(f)) for f, n in prints])
        at = np.concatenate(places)
        by_place = np.lexsort((number, at))
        number, at = number[by_place], at[by_place]
        new = np.concatenate([[True], number[1:] != number[:-1]])
        out, last = [], before
        for i in np.nonzero(new)[0]:
            fingerprint = order[number[i]]
            if last is not None and last[0] != fingerprint:
                out.append((int(at[i]), *last, fingerprint, names[fingerprint]))
            last = (fingerprint, names[fingerprint])
        return out, int(at[-1]), last

    return moves


def change_stream(recs: DataFrame) -> DataFrame:
    """Schema changes of streaming records or snapshots (``seq, table_schema, table_name, column_fingerprint,
    column_names``), as ``schema_changes`` tells them, in append mode.

    Each table's last schema is in the state store, so a change across micro-batches or a restart is told like one inside.
    What a micro-batch brings of a table stands behind everything brought before.
    """
    by_table = packed(recs).groupBy(*TABLE)
    found = by_table.transformWithStateInPandas(_processor(), _MOVES, "append", "none")
    return describe(found.drop("is_state"))


def _processor():
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    moves = _finder()
    columns = ["is_state", "seq", "table_schema", "table_name", "_prev", "_prev_names", "column_fingerprint", "column_names"]

    class Schemas(StatefulProcessor):
        def init(self, handle):
            self.last = handle.getValueState("schema", "fingerprint string, names array<string>")

        def handleInputRows(self, key, rows, timerValues):
            own = [r for part in rows for r in zip(part["fingerprint"], part["names"], part["places"], strict=True)]
            before = self.last.get() if self.last.exists() else None
            found, _, after = moves(own, None if before is None else (before[0], list(before[1])))
            self.last.update(after)
            if found:
                yield pd.DataFrame([(False, seq, key[0], key[1], *rest) for seq, *rest in found], columns=columns)

        def close(self):
            pass

    return Schemas()


def carry_changes(spark: SparkSession, recs: DataFrame, target: str, batch_id: int) -> None:
    """Write the changes of a batch and the state after it, both under the batch id."""
    former = _state(spark, target, batch_id)
    nothing = F.lit(None).cast("binary").alias("places")
    kept = former.select(*TABLE, F.col("column_fingerprint").alias("fingerprint"), F.col("column_names").alias("names"), nothing, "seq")
    rows = packed(recs).withColumn("seq", F.lit(None).cast("long")).unionByName(kept)
    moves = _finder()

    def go(key, part):
        import pandas as pd

        state = part[part["places"].isna()]
        own = part[part["places"].notna()]
        before = None if state.empty else (state["fingerprint"].iloc[0], list(state["names"].iloc[0]))
        if own.empty:
            found, at, after = [], int(state["seq"].iloc[0]), before
        else:
            found, at, after = moves(list(zip(own["fingerprint"], own["names"], own["places"], strict=True)), before)
        out = [(False, seq, *key, *rest) for seq, *rest in found]
        out.append((True, at, *key, None, None, *after))
        columns = ["is_state", "seq", "table_schema", "table_name", "_prev", "_prev_names", "column_fingerprint", "column_names"]
        return pd.DataFrame(out, columns=columns)

    here = f"{target}/schema_state/batch_id={batch_id}"
    rows.groupBy(*TABLE).applyInPandas(go, _MOVES).write.mode("overwrite").parquet(here)
    found = spark.read.schema(_MOVES).parquet(here).where("not is_state")
    describe(found).write.mode("overwrite").parquet(f"{target}/schema_changes/batch_id={batch_id}")
    # A batch that is run again needs the state before its own; anything older is done with.
    _remove(spark, f"{target}/schema_state/batch_id={batch_id - 2}")


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _state(spark: SparkSession, target: str, batch_id: int) -> DataFrame:
    """The state left by the batch before this one."""
    if batch_id == 0:
        return spark.createDataFrame([], _MOVES)
    return spark.read.schema(_MOVES).parquet(f"{target}/schema_state/batch_id={batch_id - 1}").where("is_state")
