"""Fill-in-the-middle: a document is cut at two units and its middle is moved to the end.

Units are code points, or whatever a pattern matches from left to right: a unit ends where its match ends and begins
where the one before it ends; what is left behind the last match is one more unit. The units of a text stand in an
indexable skip list. Its bottom lane has nodes of a few units, its express lanes skip over ever more nodes, and each link
carries how many units and how many code points it spans. To find the place before unit ``r`` one goes along a lane as long
as the units passed stay within ``r`` and then one lane down, adding up both widths; the code points passed are the cut.

A random part of the documents, and texts that are empty or contain a mark, stay plain. The choice and the cuts come from
the digest of seed and doc_id, so reruns agree; a null id counts as an empty one. A null text is empty. Rows with one id are
cut by the same numbers, repeated rows are all returned. Other columns, also those named like the results, are left
out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import mix, ship, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
#: Per cent of the documents that are cut, and of these, that have the suffix first.
CUT, SUFFIX_FIRST = 90, 20
#: Units of a bottom node.
RUN = 64
#: Two bits of a node's hash decide on each lane, so a lane has a quarter of the nodes of the one below.
LANE_BITS = 2

SCHEMA = "doc_id long, n long, form string, prefix_units long, middle_units long, prefix_chars long, middle_chars long, output string"


class SkipList:
    """Units of a text by their widths in code points; ``widths`` may be a number, the count of units of width one."""

    def __init__(self, widths: np.ndarray | int):
        self.widths = None if isinstance(widths, int) else np.asarray(widths, np.int64)
        self.units = widths if isinstance(widths, int) else len(widths)
        starts = np.arange(0, self.units, RUN)
        units = np.diff(starts, append=self.units)
        points = units if self.widths is None else np.add.reduceat(self.widths, starts) if len(starts) else units
        hashes = mix(np.arange(len(starts), dtype=np.uint64) + np.uint64(1))
        #: From the bottom: (units, points, index of the node below) of each lane's links.
        self.lanes = [(units, points, starts)]
        nodes = np.arange(len(starts))
        while len(nodes) > 1:
            bits = hashes[nodes] & np.uint64((1 << LANE_BITS) - 1)
            hashes = hashes >> np.uint64(LANE_BITS)
            towers = bits == 0
            towers[0] = True  # the head is in all lanes
            at = np.nonzero(towers)[0]
            if len(at) == len(nodes):
                continue
            units, points = np.add.reduceat(units, at), np.add.reduceat(points, at)
            nodes = nodes[at]
            self.lanes.append((units, points, at))

    def seek(self, rank: int) -> int:
        """Code points before unit ``rank``; ``rank`` may be the number of units."""
        if not 0 <= rank <= self.units:
            raise IndexError(rank)
        passed = reached = node = 0
        for units, points, below in reversed(self.lanes[1:]):
            while node < len(units) and passed + units[node] <= rank:
                passed, reached, node = passed + int(units[node]), reached + int(points[node]), node + 1
            if node == len(units):
                return reached
            node = int(below[node])
        units, points, starts = self.lanes[0]
        while node < len(units) and passed + units[node] <= rank:
            passed, reached, node = passed + int(units[node]), reached + int(points[node]), node + 1
        if passed == rank:
            return reached
        inside = rank - passed
        start = int(starts[node])
        return reached + (inside if self.widths is None else int(self.widths[start : start + inside].sum()))


def widths_of(text: str, unit: regex.Pattern | None) -> np.ndarray | int:
    if unit is None:
        return len(text)
    ends = np.fromiter((m.end() for m in unit.finditer(text) if m.end() > m.start()), np.int64)
    if len(text) and (not len(ends) or ends[-1] < len(text)):
        ends = np.append(ends, len(text))
    return np.diff(ends, prepend=0)


def numbers(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def arranged(form: str, prefix: str, middle: str, suffix: str) -> str:
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def _row(doc_id: int | None, text: str, unit: regex.Pattern | None, seed: int, cut: int, suffix_first: int) -> tuple:
    units = SkipList(widths_of(text, unit))
    n = units.units
    h1, h2, h3, h4 = numbers(doc_id, seed)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= cut:
        return doc_id, n, "plain", None, None, None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = units.seek(first), units.seek(last)
    form = "spm" if h4 % 100 < suffix_first else "psm"
    return doc_id, n, form, first, last - first, a, b - a, arranged(form, text[:a], text[a:b], text[b:])


def infill(
    docs: DataFrame, unit: str | None = None, seed: int = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """(doc_id, n, form, prefix_units, middle_units, prefix_chars, middle_chars, output) of each row's whole text.

    ``n`` counts units: code points, or matches of the pattern ``unit``. Spans are null for plain rows.
    """
    ship(docs.sparkSession)
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = None if unit is None else regex.compile(unit)
        for batch in batches:
            out, size = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                out.append(_row(doc_id.as_py(), text.as_py() or "", pattern, seed, cut, suffix_first))
                size += len(out[-1][-1])
                if size > 16 << 20:  # long texts go on in small batches
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(rows, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. A mark shares no end with another's beginning and a cut text contains none,
    so the first of each kind is the one that was put in."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.lit(len(first) + 1))
        a = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.char_length(a) + len(second) + 1)
        b = F.substring_index(rest, MIDDLE, 1)
        return a, b, F.substr(rest, F.char_length(b) + len(MIDDLE) + 1)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP11_SQL = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), cuts AS (
  SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || h[1:8])::UBIGINT::BIGINT AS h1, ('0x' || h[9:16])::UBIGINT::BIGINT AS h2,
    ('0x' || h[17:24])::UBIGINT::BIGINT AS h3, ('0x' || h[25:32])::UBIGINT::BIGINT AS h4 FROM hashed
), placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cuts
), parts AS (
  SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM placed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""
