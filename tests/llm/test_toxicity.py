import random

from tallylake.llm.toxicity import FEATURES, Lexicon, features, fit_toxicity, op5_toxicity, score_toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_folds(spark):
    import zlib

    rows = op5_toxicity(spark, SF).collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    pairs = [(a > b) + (a == b) / 2 for a, x in held for b, y in held if x and not y]
    assert sum(pairs) / len(pairs) > 0.75


def test_features_see_disguises_and_nearness():
    lexicon = Lexicon(frozenset([b"idiot"]), frozenset([b"moro"]))
    named = dict(zip(FEATURES, features("You 1d10t! i d i o t. MORONIC, you idiot.", lexicon)))
    assert named["disguised_hits"] == 2 and named["lexicon_hits"] > 0 and named["stem_hits"] > 0
    assert named["near_best"] == 0.5 and named["capital_words"] > 0
    assert features("", lexicon) == [0.0] * len(FEATURES)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None), (3, 0), (3, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0), labels.where("doc_id = 1")):
        model = fit_toxicity(odd_docs, known)
        rows = score_toxicity(odd_docs, model).select("row.*", "score").collect()
        assert len(rows) == odd_docs.count()
        assert len({r[-1] for r in rows if r.doc_id == 1}) == 1 and all(0 <= r[-1] <= 1 for r in rows)
        assert score_toxicity(no_docs, model).count() == 0


def test_a_planted_word_is_learned(spark):
    random.seed(1)
    words = [f"w{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(400):
        text = random.choices(words, k=40)
        if i % 4 == 0:
            text[random.randrange(40)] = "zounds"
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    given = spark.createDataFrame(docs, "doc_id long, text string")
    model = fit_toxicity(given.where("doc_id < 300"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert b"zounds" in model.lexicon.words
    for r in score_toxicity(given, model).where("row.doc_id >= 300").collect():
        assert (r.score >= 0.3) == (r.row.doc_id % 4 == 0)
