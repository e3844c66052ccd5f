import random
import zlib

import numpy as np

from tallylake.llm.quality import (
    STATISTICS, THRESHOLD, Density, fit_quality, op13_quality_discriminant, score_quality, statistics, text_statistics,
)

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_folds(spark):
    rows = op13_quality_discriminant(spark, SF).collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= THRESHOLD) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    pairs = [(a > b) + (a == b) / 2 for a, _, x in held for b, _, y in held if x and not y]
    assert sum(pairs) / len(pairs) > 0.95
    assert sum(p == x for _, p, x in held) / len(held) > 0.93


def test_log_density_equals_the_formula():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(6, 6))
    covariance, mean, x = a @ a.T + np.eye(6), rng.normal(size=6), rng.normal(size=(20, 6))
    away = x - mean
    expected = -0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(covariance), away) - 0.5 * np.linalg.slogdet(covariance)[1]
    assert np.allclose(Density.of(mean, covariance).log(x), expected)


def test_means_and_covariances_equal_numpy(spark):
    """The whole fit, against moments of the same rows by numpy."""
    from tallylake.llm import quality as q

    random.seed(4)
    docs = [(i, " ".join(random.choice(["a", "bb", "Ccc", "d!", "x|y"]) for _ in range(random.randint(1, 60)))) for i in range(200)]
    made = text_statistics(spark.createDataFrame(docs, "doc_id long, text string")).withColumn("label", q.F.col("doc_id").cast("int") % 2)
    moments = q._moments(made)
    for label in (0, 1):
        x = np.array([statistics(t) for i, t in docs if i % 2 == label])
        n, mean, scatter = q._covariance(moments[label])
        assert n == len(x) and np.allclose(mean, x.mean(axis=0)) and np.allclose(scatter / n, np.cov(x.T, bias=True), atol=1e-9)


def test_statistics_see_junk():
    named = lambda t: dict(zip(STATISTICS, statistics(t), strict=True))
    plain, junk = named("The cat sat. A dog ran."), named("WIN WIN WIN!! a|b $$$\nsame\nsame")
    assert plain["repeats"] == plain["symbols"] == plain["bars"] == plain["same_lines"] == 0
    assert all(junk[k] > 0 for k in ("repeats", "symbols", "bars", "same_lines", "marks")) and junk["capitals"] > plain["capitals"]
    assert statistics("") == statistics(" \n") == [0.0] * len(STATISTICS)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None), (3, 0), (3, 1), (99, 1)], "doc_id long, quality int")
    made, nothing = text_statistics(odd_docs), text_statistics(no_docs)
    for known in (labels, labels.limit(0), labels.where("doc_id = 1")):
        model = fit_quality(made, known)
        rows = score_quality(made, model).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 1}) == 1
        assert score_quality(nothing, model).count() == 0
    assert {r.score for r in score_quality(made, fit_quality(made, labels.limit(0))).collect()} == {0.5}
    assert fit_quality(nothing, labels).good is None


def test_planted_junk_is_told_apart(spark):
    random.seed(1)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.randint(2, 8)))
    docs = []
    for i in range(400):
        words = [word() for _ in range(random.randint(20, 200))]
        docs.append((i, " ".join(words) + "." if i % 5 else " ".join(w.upper() + "!!" for w in words)))
    given = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(300)], "doc_id long, quality int")
    made = text_statistics(given)
    for r in score_quality(made, fit_quality(made, labels)).where("doc_id >= 300").collect():
        assert (r.score >= THRESHOLD) == (r.doc_id % 5 > 0)
