"""Quality: a regularised quadratic discriminant over transformed statistics of a text.

Every text becomes a short vector of statistics, made once: the fit reads the vectors of labelled rows, scoring
reads all of them, so no text is shuffled. Each class has a mean and a covariance that is shrunk towards the
pooled one and towards its diagonal. A score compares the Mahalanobis log densities of both classes, by Cholesky
factors that are made once and kept with the model, and a logistic calibration turns it into a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import asin, log, log1p, sqrt
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import fold_of, in_steps, table, written
from tallylake.llm.registry import query

#: Rows of the pooled covariance that count beside a class's own rows, for each statistic.
POOLED_ROWS = 5.0
#: Share of the diagonal in a covariance.
DIAGONAL_SHARE = 0.05
#: Standardised statistics end here, so that one odd value can't outweigh all others.
FAR = 8.0
#: One labelled row of so many calibrates, the others give means and covariances.
CALIBRATION_PART = 4
#: Calibration counts margins in bins of this width, up to the end on both sides: a bounded table.
BIN, LAST = 0.25, 64.0
THRESHOLD = 0.7

STATISTICS = (
    "words word_length length_spread sentence_words letters capitals digits stops marks symbols bars repeats kinds peak same_lines".split()
)
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_UPPER, _ASCII_LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
_KINDS = (b"0123456789", b".,;:", b"!?", b"#$%&*@^~<>=+\\{}[]_", b"|")


def _share(part: int, whole: int) -> float:
    """The arcsine of a share's root: equal steps near 0 and 1 as in the middle."""
    return asin(sqrt(min(1.0, part / whole))) if whole else 0.0


def statistics(text: str) -> list[float]:
    """The transformed statistics of a text, in the order of STATISTICS; all zero for one without words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)

    def count(kind: bytes) -> int:
        return len(raw) - len(raw.translate(None, kind))

    sizes = np.fromiter(map(len, words), np.int64, n)
    size = int(sizes.sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    ends = raw.count(b".") + raw.count(b"!") + raw.count(b"?")
    kinds = Counter(words)
    return [
        log1p(n), log(size / n), log1p(float(sizes.std())), log1p(n / (1 + ends)), _share(count(_LETTERS), size),
        _share(count(_UPPER), count(_ASCII_LETTERS)), *(_share(count(kind), size) for kind in _KINDS),
        _share(sum(map(eq, words, words[1:])), n - 1), _share(len(kinds), n), _share(max(kinds.values()), n),
        _share(len(lines) - len(set(lines)), len(lines)),
    ]


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (a hash of the text) and ``statistics`` of every row, written; columns besides doc_id and text aren't read."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_steps(batches):
            made = pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), made], names=["doc_id", "text_key", "statistics"])

    key = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key")
    rows = docs.select(F.col("doc_id").cast("long"), key, "text")
    return written(rows.mapInArrow(run, "doc_id long, text_key long, statistics array<double>"), "text-statistics")


@dataclass(frozen=True)
class Density:
    """A normal density: mean, the Cholesky factor of its covariance, and the log of what it is scaled by."""

    mean: np.ndarray
    factor: np.ndarray
    log_scale: float

    @staticmethod
    def of(mean: np.ndarray, covariance: np.ndarray) -> Density:
        factor = np.linalg.cholesky(covariance)
        return Density(mean, factor, -float(np.log(np.diag(factor)).sum()))

    def log(self, x: np.ndarray) -> np.ndarray:
        """Log densities of the rows, but for the constant that all classes share."""
        away = np.linalg.solve(self.factor, (x - self.mean).T)
        return self.log_scale - 0.5 * (away * away).sum(axis=0)


@dataclass(frozen=True)
class QualityModel:
    """``good`` is None where the labels had one value or none; then every score is ``prior``."""

    prior: float
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    good: Density | None = None
    bad: Density | None = None
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The log density of label 1 less that of label 0, of each row of statistics."""
        x = np.clip((x - self.centre) / self.spread, -FAR, FAR)
        return self.good.log(x) - self.bad.log(x)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.good is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.offset, -500, 500)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def _moments(rows: DataFrame) -> dict[int, np.ndarray]:
    """By label the sum of (1, x)(1, x)': number, sums and products in one matrix. Tasks add up their own rows first."""
    width = len(STATISTICS) + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width, width))
        for batch in batches:
            x = np.hstack([np.ones((batch.num_rows, 1)), _matrix(batch.column("statistics"))])
            label = batch.column("label").to_numpy()
            for k in (0, 1):
                total[k] += x[label == k].T @ x[label == k]
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(total.reshape(2, -1).tolist())], names=["label", "m"])

    parts = rows.select("label", "statistics").mapInArrow(run, "label int, m array<double>")
    cells = parts.select("label", F.posexplode("m").alias("cell", "v")).groupBy("label", "cell").agg(F.sum("v").alias("v"))
    found = {0: np.zeros(width * width), 1: np.zeros(width * width)}
    for r in cells.collect():  # two small matrices
        found[r.label][r.cell] = r.v
    return {k: v.reshape(width, width) for k, v in found.items()}


def _covariance(m: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Number, mean and scatter (the covariance times the number)."""
    n = m[0, 0]
    mean = m[0, 1:] / n
    return n, mean, m[1:, 1:] - n * np.outer(mean, mean)


def _discriminant(moments: dict[int, np.ndarray], prior: float) -> QualityModel:
    _, centre, scatter = _covariance(moments[0] + moments[1])
    n = moments[0][0, 0] + moments[1][0, 0]
    spread = np.sqrt(np.maximum(np.diag(scatter), 0) / n)
    spread[spread < 1e-9] = 1.0
    own = {k: _covariance(m) for k, m in moments.items()}
    pooled = (own[0][2] + own[1][2]) / n / np.outer(spread, spread)
    made = {}
    for k, (rows, mean, s) in own.items():
        weight = POOLED_ROWS * len(STATISTICS)
        shrunk = (s / np.outer(spread, spread) + weight * pooled) / (rows + weight)
        diagonal = np.diag(np.diag(shrunk) + 1e-3)
        made[k] = Density.of((mean - centre) / spread, (1 - DIAGONAL_SHARE) * shrunk + DIAGONAL_SHARE * diagonal)
    return QualityModel(prior, centre, spread, made[1], made[0])


def _margins(rows: DataFrame, model: QualityModel) -> list[tuple[float, int, int]]:
    """(margin, rows with label 1, rows with label 0) by bins of the margin."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = np.clip(model.margin(_matrix(batch.column("statistics"))), -LAST, LAST)
            yield pa.RecordBatch.from_arrays([pa.array(np.rint(margin / BIN).astype(np.int32)), batch.column("label")], names=["bin", "label"])

    bins = rows.select("label", "statistics").mapInArrow(run, "bin int, label int").groupBy("bin").agg(
        F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")
    )
    return [(r.bin * BIN, r.good, r.bad) for r in bins.collect()]


def _calibrated(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the bins, by Newton's steps; targets keep off 0 and 1 by one row each."""
    x, good, bad = (np.array(c, float) for c in zip(*bins, strict=True))
    high, low = (good.sum() + 1) / (good.sum() + 2), 1 / (bad.sum() + 2)
    weight, hits = good + bad, good * high + bad * low
    design = np.stack([x, np.ones_like(x)], axis=1)
    at = np.array([0.1, 0.0])

    def loss(beta: np.ndarray) -> float:
        z = design @ beta
        return float((weight * np.logaddexp(0, z) - hits * z).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -500, 500)))
        gradient = design.T @ (weight * p - hits)
        hessian = design.T @ (design * (weight * p * (1 - p))[:, None]) + 1e-9 * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    # A higher margin never means a lower score.
    return max(1e-3, float(at[0])), float(at[1])


def fit_quality(made: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from all rows of ``made`` (as ``text_statistics`` gives it) whose ids ``labels`` has (doc_id, quality).

    Null ids and labels are left out; an id with several labels counts as 0 if any is. Only ids, labels and
    statistics are joined. Without labels scores are 0.5, with labels of one value a constant near it.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min(F.col("quality").cast("int")).alias("label"))
    rows = made.join(known, "doc_id").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(CALIBRATION_PART)))
    rows = written(rows.select("label", "statistics", "part"), "labelled-statistics")
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    prior = (good + 0.5) / (good + bad + 1)
    moments = _moments(rows.where("part > 0"))
    if not all(m[0, 0] for m in moments.values()):
        moments = _moments(rows)
    if not good or not bad:
        return QualityModel(prior)
    model = _discriminant(moments, prior)
    bins = _margins(rows.where("part = 0"), model)
    if not sum(b[1] for b in bins) or not sum(b[2] for b in bins):
        bins = _margins(rows, model)
    slope, offset = _calibrated(bins)
    return QualityModel(prior, model.centre, model.spread, model.good, model.bad, slope, offset)


def score_quality(made: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, text_key and score (0 to 1, higher is better) of every row of ``made``.

    Null and empty texts are scored by their statistics, all zero. Repeated rows get equal scores, no rows give none.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column("statistics")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(score)], names=["doc_id", "text_key", "score"])

    return made.mapInArrow(run, "doc_id long, text_key long, score double")


#: Labels of rows with this remainder of crc32(doc_id) by 4 are never learned from.
HELD_OUT, FOLDS = 2, 4


def held_out(doc_id: Column) -> Column:
    return fold_of(doc_id, FOLDS) == HELD_OUT


@query("op13_quality_discriminant")
def op13_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = text_statistics(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels")
    model = fit_quality(made, labels.where(~held_out(F.col("doc_id"))))
    return score_quality(made, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
