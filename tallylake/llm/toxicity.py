"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon, the trees and the calibration are learned from a bounded sample of labelled rows; every
text is scored whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log1p

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import SMALL_STEP, fold_of, in_steps, table, written
from tallylake.llm.registry import query

#: Labelled rows that models are fitted on, about: the bound of the sample, whatever the labels' number.
MAX_TRAINING_ROWS = 30_000
#: One labelled row of so many calibrates, the others fit trees.
CALIBRATION_PART = 4
#: Words, and stems, in the learned lexicon; texts with label 1 that an entry has to be in; what its log odds, and the
#: root of their likelihood ratio, have to exceed. The ratio stays sure with few labels, where standard errors don't.
LEXICON_ENTRIES, LEXICON_TEXTS, LEXICON_ODDS, LEXICON_Z = 200, 3, 1.5, 4.0
#: First bytes of a word that are tried as stems, for insults that are compounded or inflected.
STEM_BYTES = (4, 5, 6)
TREES, TREE_DEPTH, STEP = 20, 3, 0.3
#: Words between a lexicon word and a second-person word that count as near.
NEAR_WORDS = 6
#: Share of the trees' own probability in a score; it orders texts that calibration ties.
TIE_SHARE = 0.01
THRESHOLD = 0.3

# Second-person words (English, German, French, Spanish).
SECOND_PERSON = frozenset(
    b"you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos usted ti tus".split()
)

_TO_SPACE = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_LOOKALIKES = bytes.maketrans(b"013457@$!|", b"oieastasii")
# A word that look-alikes or marks begin or break, but not one that only ends in them; single letters with a gap after each.
_DISGUISED = re.compile(rb"(?<!\S)(?=[a-z]*[0-9@$!|*._-]+[a-z])[a-z0-9@$!|*._-]+")
_SPACED = re.compile(rb"(?<!\S)(?:[a-z][ .\-_*]){3,}[a-z](?![a-z0-9\x80-\xff])")
_TAIL = b"!|*._-"
_RUNS = re.compile(rb"([a-z])\1\1")
_UPPER, _LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
_CAPITAL_WORD = re.compile(rb"(?<![^\s])[A-Z]{3,}(?![a-z])")
FEATURES = (
    "words lexicon_density lexicon_hits lexicon_kinds lexicon_peak stem_density stem_hits stem_kinds disguised_hits second_person near_share near_best capitals "
    "capital_words exclamations questions punctuation disguised runs symbols".split()
)


def plain_words(text: str) -> list[bytes]:
    """Letters and digits between ASCII punctuation and spaces, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_TO_SPACE).split()


@dataclass(frozen=True)
class Lexicon:
    words: frozenset[bytes] = frozenset()
    stems: frozenset[bytes] = frozenset()


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of a text, in the order of FEATURES; all zero for an empty one."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    low = raw.lower()
    words = low.translate(_TO_SPACE).split()
    n = max(1, len(words))
    known, stems = lexicon.words, lexicon.stems
    hits = [i for i, w in enumerate(words) if w in known]
    four, five, six = STEM_BYTES
    stemmed = [w for w in words if w[:four] in stems or w[:five] in stems or w[:six] in stems] if stems else []
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    peak = max((bisect_left(hits, i + 50) - k for k, i in enumerate(hits)), default=0)
    gaps = []
    for i in hits:
        at = bisect_left(second, i)
        gaps.append(min((abs(i - j) for j in second[max(0, at - 1) : at + 1]), default=1000))
    disguised = _DISGUISED.findall(low)
    shown = [re.sub(rb"[^a-z\x80-\xff]", b"", w.rstrip(_TAIL).translate(_LOOKALIKES)) for w in disguised]
    shown += [re.sub(rb"[^a-z]", b"", w) for w in _SPACED.findall(low)]
    letters = max(1, len(raw) - len(raw.translate(None, _LETTERS)))
    exclamations, questions = raw.count(b"!"), raw.count(b"?")
    return [
        log1p(len(words)), 100 * len(hits) / n, log1p(len(hits)), float(len({words[i] for i in hits})), float(peak),
        100 * len(stemmed) / n, log1p(len(stemmed)), float(len(set(stemmed))), float(sum(w in known for w in shown)), 100 * len(second) / n, sum(g <= NEAR_WORDS for g in gaps) / max(1, len(hits)),
        1 / (1 + min(gaps, default=1000)), (len(raw) - len(raw.translate(None, _UPPER))) / letters,
        100 * len(_CAPITAL_WORD.findall(raw)) / n, 100 * exclamations / n, 100 * questions / n,
        100 * (raw.count(b",") + raw.count(b".")) / n, 100 * len(disguised) / n, 100 * len(_RUNS.findall(low)) / n,
        100 * sum(raw.count(c) for c in (b"#", b"$", b"%", b"&", b"*", b"@")) / n,
    ]


@dataclass(frozen=True)
class ToxicityModel:
    """``trees`` is None where the labels had one value or none; then every score is ``prior``."""

    lexicon: Lexicon
    prior: float
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None


#: Different words and stems that a counting task holds before it hands them on.
HELD_WORDS = 50_000


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def rows() -> pa.RecordBatch:
        every = [*counts[0], *(w for w in counts[1] if w not in counts[0])]
        made = pa.RecordBatch.from_arrays([
            pa.array(every, pa.binary()), pa.array([counts[1][w] for w in every], pa.int64()), pa.array([counts[0][w] for w in every], pa.int64()),
        ], names=["word", "with", "without"])
        for one in counts:
            one.clear()
        return made

    for batch, texts in in_steps(batches, chars=SMALL_STEP):
        for text, label in zip(texts, batch.column("label").to_pylist(), strict=True):
            words = set(plain_words(text))
            counts[int(label)].update(words)
            # A stem ends in an asterisk, which no word has.
            counts[int(label)].update({w[:n] + b"*" for w in words for n in STEM_BYTES if len(w) >= n})
        if len(counts[0]) + len(counts[1]) > HELD_WORDS:
            yield rows()
    yield rows()


def learn_lexicon(sample: DataFrame, bad: int, good: int) -> Lexicon:
    """The words and the stems whose odds rise most surely with label 1."""
    each = sample.select("text", "label").mapInArrow(_count_words, "word binary, with long, without long")
    each = each.groupBy("word").agg(F.sum("with").alias("p"), F.sum("without").alias("q")).where(F.col("p") >= LEXICON_TEXTS)
    cells = F.col("p") + 0.5, bad - F.col("p") + 0.5, F.col("q") + 0.5, good - F.col("q") + 0.5
    odds = F.log(cells[0] / cells[1]) - F.log(cells[2] / cells[3])
    seen, n = F.col("p") + F.col("q"), bad + good

    def part(found: Column, all_found: Column, share: float) -> Column:
        return F.when(found > 0, found * F.log(found / (all_found * share))).otherwise(0.0)

    ratio = part(F.col("p"), seen, bad / n) + part(F.col("q"), seen, good / n)
    ratio = ratio + part(bad - F.col("p"), n - seen, bad / n) + part(good - F.col("q"), n - seen, good / n)
    z = F.sqrt(2 * F.greatest(ratio, F.lit(0.0)))
    sure = each.select("word", odds.alias("odds"), z.alias("z"), F.expr("right(decode(word, 'ISO-8859-1'), 1) = '*'").alias("stem"))
    sure = written(sure.where((F.col("odds") >= LEXICON_ODDS) & (F.col("z") >= LEXICON_Z)), "lexicon")

    def best(stem: bool) -> frozenset[bytes]:
        rows = sure.where(F.col("stem") == stem).orderBy(F.desc("z"), "word").limit(LEXICON_ENTRIES).collect()
        return frozenset(bytes(r["word"]).removesuffix(b"*") for r in rows)

    return Lexicon(best(False), best(True))


def with_features(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The columns of ``docs`` but ``text``, and the features."""
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_steps(batches, chars=SMALL_STEP):
            columns = zip(*(features(t, lexicon) for t in texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(c, pa.float64()) for c in columns], names=kept + FEATURES
            )

    ddl = docs.select(*kept).schema.toDDL()
    return docs.mapInArrow(run, ", ".join([ddl, *(f"{c} double" for c in FEATURES)]))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from the texts of ``docs`` whose ids ``labels`` has (doc_id, toxic).

    Null ids and labels are left out; an id with several labels counts as 1 if any is. Beyond
    MAX_TRAINING_ROWS labels, a part of the ids is taken, chosen by a hash.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled"))
    known = known.agg(F.max(F.col("toxic").cast("int")).alias("label"))
    n = known.count()
    if n > MAX_TRAINING_ROWS:
        known = known.where(F.pmod(F.xxhash64("labelled"), F.lit(1 << 20)) < int((1 << 20) * MAX_TRAINING_ROWS / n))
    # About MAX_TRAINING_ROWS small rows, so that no text is shuffled.
    sample = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("labelled"))
    sample = written(sample.select("doc_id", "text", "label"), "toxicity-sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    prior = (bad + 0.5) / (bad + good + 1.0) if bad + good else 0.0
    if not bad or not good:
        return ToxicityModel(Lexicon(), prior, None, None)
    lexicon = learn_lexicon(sample, bad, good)
    rows = with_features(sample.withColumn("label", F.col("label").cast("double")), lexicon)
    rows = written(rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(CALIBRATION_PART))), "toxicity-features")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    fitting = assembler.transform(rows.where("part > 0")).select("label", "features").coalesce(4)
    if fitting.select("label").distinct().count() < 2:
        fitting = assembler.transform(rows).select("label", "features").coalesce(4)
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=STEP, seed=7, minInstancesPerNode=5, cacheNodeIds=False
    ).fit(fitting)
    rest = rows.where("part = 0")
    if not rest.limit(1).count():
        return ToxicityModel(lexicon, prior, trees, None)
    scored = trees.transform(assembler.transform(rest)).select("label", vector_to_array("probability")[1].alias("raw"))
    calibration = IsotonicRegression(featuresCol="raw").fit(scored)
    return ToxicityModel(lexicon, prior, trees, calibration)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """row (a struct of all columns of ``docs`` but ``text``, whatever their names) and score (0 to 1) of every row.

    The text goes to Python once and doesn't come back.

    A null text is scored as an empty one. Repeated rows get equal scores, no rows give no rows.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"), "text")
    if model.trees is None:
        return rows.select("row", F.lit(model.prior).alias("score"))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(rows, model.lexicon))
    rows = model.trees.transform(rows).select("row", vector_to_array("probability")[1].alias("raw"))
    if model.calibration is None:
        return rows.withColumnRenamed("raw", "score")
    rows = model.calibration.transform(rows)
    score = (1 - TIE_SHARE) * F.col("prediction") + TIE_SHARE * F.col("raw")
    return rows.select("row", F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias("score"))


#: Labels of rows with this remainder of crc32(doc_id) by 4 are never learned from.
HELD_OUT, FOLDS = 2, 4


def toxicity_model(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learned from all labels but the held-out ones; only doc_id and text are read from ``docs``."""
    own = docs.select(F.col("doc_id").cast("long"), "text")
    return fit_toxicity(own, labels.where(fold_of(F.col("doc_id"), FOLDS) != HELD_OUT))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    doc_id = F.col("doc_id")
    scored = score_toxicity(docs, model).select("row.doc_id", "score")
    return scored.select(
        doc_id, (fold_of(doc_id, FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
