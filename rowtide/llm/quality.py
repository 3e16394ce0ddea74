"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated.

Statistics of a text (lengths, shares of kinds of characters, repetition of words and lines) are standardised by the
labelled rows. Random cosines of them approximate a Gaussian kernel. Each task adds up its part of the normal
equations, a matrix of fixed size; the parts are added in a tree, and the solution gives raw scores. Isotonic
regression over bins of the raw score turns these into probabilities.

All labelled training rows are used, there is no sample. Nulls count as empty texts. Labels that are null are left
out; several rows of one id are several examples. Without any labelled row every score is 0.5. Columns besides
doc_id and text are no inputs; ``accept`` carries them along unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import shelve, ship, table

COSINES = 256
RIDGE = 1e-3
SEED = 20
#: Kernel width on standardised statistics, as the square root of their number times this.
WIDTH = 0.7
BINS = 2048
#: Parts of the normal equations that one task, or the driver, adds up.
FAN_IN = 32
THRESHOLD = 0.3
SYMBOLS = b"#$%&*@^~<>|\\/_+={}[]"
BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
UPPER = np.isin(np.arange(256), np.arange(65, 91))
LETTER = UPPER | np.isin(np.arange(256), np.arange(97, 123)) | (np.arange(256) >= 128)
DIGIT = np.isin(np.arange(256), np.arange(48, 58))
SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
N_STATISTICS = 21


def _repeated(ids: np.ndarray, n: int) -> float:
    """Share of the n-grams that repeat another one."""
    if len(ids) < n + 1:
        return 0.0
    grams = np.zeros(len(ids) - n + 1, np.uint64)
    for i in range(n):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(grams) + i]
    return 1 - len(np.unique(grams)) / len(grams)


def statistics(text: str | None) -> list[float]:
    data = (text or "").encode()
    n = max(1, len(data))
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    w = max(1, len(words))
    _, times = np.unique(ids, return_counts=True)
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters = count[LETTER].sum()
    return [
        np.log1p(len(data)), np.log1p(len(words)), min(40.0, len(data) / w), letters / n, count[DIGIT].sum() / n,
        count[UPPER].sum() / max(1, letters), count[BLANK].sum() / n, count[10] / n, count[SYMBOL].sum() / n,
        count[ord("|")] / n, count[ord("!")] / n, count[ord(".")] / n, count[ord(",")] / n,
        len(times) / w, len(times) / np.sqrt(w), (ids[1:] == ids[:-1]).sum() / w, times.max(initial=0) / w,
        _repeated(ids, 2), _repeated(ids, 4), 1 - len(set(lines)) / max(1, len(lines)), len(lines) / w,
    ]


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(t.as_py()) for t in texts], np.float64).reshape(-1, N_STATISTICS)


def _stacked(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, stats)."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = pa.array(list(_matrix(batch.column(1))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), stats], ["doc_id", "stats"])

    narrow = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return narrow.mapInArrow(rows, "doc_id long, stats array<double>")


class Model:
    """Centre and scale of the statistics, the random cosines, the ridge weights, and the calibration."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.centre, self.scale = centre, np.where(scale > 1e-9, scale, 1.0)
        self.slopes = rng.standard_normal((N_STATISTICS, COSINES)) / (WIDTH * np.sqrt(N_STATISTICS))
        self.phases = rng.uniform(0, 2 * np.pi, COSINES)
        self.weights = np.zeros(COSINES + 1)
        self.knots, self.values = np.array([0.0]), np.array([0.5])

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.centre) / self.scale, -8, 8)
        z = np.cos(x @ self.slopes + self.phases) * np.sqrt(2 / COSINES)
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """The calibrated score. A thousandth of it follows the raw score, so that it also orders rows of one step."""
        raw = self.raw(stats)
        steps = np.interp(raw, self.knots, self.values)
        return 0.999 * steps + 0.001 / (1 + np.exp(-np.clip(raw * 4 - 2, -30, 30))) if len(self.knots) > 1 else steps


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points sorted by ``x``: knots and rising values between which scores are interpolated."""
    blocks: list[list[float]] = []  # mean, weight, first x, last x
    for xi, yi, wi in zip(x, y, weight, strict=True):
        blocks.append([yi, wi, xi, xi])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks[-1]
            a[0], a[1], a[3] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], b[3]
    knots = np.array([p for b in blocks for p in b[2:]])
    return knots, np.array([b[0] for b in blocks for _ in range(2)])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _added(parts: DataFrame) -> np.ndarray | None:
    """The sum of matrices of one shape, one or more in each partition, added in a tree of shuffles."""
    schema = parts.schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in batch.column(0):
                part = np.frombuffer(part.as_py(), np.float64)
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    n = parts.rdd.getNumPartitions()
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        parts = parts.repartition(n).mapInArrow(add, schema)
    got = [np.frombuffer(r.part, np.float64) for r in parts.collect()]
    return np.sum(got, axis=0) if got else None


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit on the rows of ``stats`` (doc_id, stats) that ``labels`` (doc_id, quality) names and that are not held out.

    To the driver come the sums of the statistics, ``FAN_IN`` matrices of (``COSINES`` + 1) squared numbers, and
    ``BINS`` sums: fixed sizes.
    """
    known = labels.where("quality is not null").where(~held_out(F.col("doc_id")))
    known = known.selectExpr("cast(doc_id as long) doc_id", "cast(quality as double) label")
    rows = shelve(stats.join(known, "doc_id").select("stats", "label"))
    sums = [f(F.get("stats", F.lit(i))) for i in range(N_STATISTICS) for f in (F.avg, F.stddev_pop)]
    first = rows.agg(F.count(F.lit(1)), *sums).first()
    if not first[0]:
        return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS))
    model = Model(np.array(first[1::2]), np.array(first[2::2]))

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((COSINES + 1, COSINES + 2))
        for batch in batches:
            if batch.num_rows:
                z = model.cosines(_stacked(batch.column(0)))
                total += z.T @ np.hstack([z, batch.column(1).to_numpy(zero_copy_only=False)[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    total = _added(rows.mapInArrow(equations, "part binary")).reshape(COSINES + 1, COSINES + 2)
    penalty = RIDGE * first[0] / COSINES * np.eye(COSINES + 1)
    penalty[-1, -1] = 0
    model.weights = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = np.clip(np.floor(model.raw(_stacked(batch.column(0))) * BINS / 2), -BINS // 2, BINS - 1)
                yield pa.RecordBatch.from_arrays([pa.array(bins.astype(np.int64)), batch.column(1)], ["bin", "label"])

    bins = rows.mapInArrow(raw, "bin long, label double").groupBy("bin").agg(F.avg("label"), F.count(F.lit(1))).orderBy("bin")
    x, y, weight = np.array(bins.collect(), np.float64).T
    model.knots, model.values = isotonic((x + 0.5) * 2 / BINS, y, weight)
    return model


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of (doc_id, stats)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_stacked(batch.column(1))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    return stats.mapInArrow(rows, "doc_id long, score double")


def accept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    model = fit(described(docs), labels)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                good = model.score(_matrix(batch.column(batch.schema.get_field_index("text")))) >= THRESHOLD
                yield batch.filter(pa.array(good))

    return docs.mapInArrow(rows, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    stats = shelve(described(docs))
    out = scored(stats, fit(stats, labels))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
