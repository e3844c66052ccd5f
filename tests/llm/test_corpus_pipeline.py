import random

import corpus_pipeline
import pytest
from test_decontaminate import brute as contaminated
from test_jaccard import brute as linked

SF = "/root/testdata/sf0.001"


@pytest.fixture
def given(spark, tmp_path):
    """Documents with planted cases, odd rows, and columns that stages might use themselves."""
    random.seed(11)
    word = lambda: random.choice("bcdfghklm") + random.choice("aeiou") + random.choice("nrst")
    texts = [" ".join(word() for _ in range(80)) for _ in range(60)]
    items = [(i, " ".join(word() for _ in range(25))) for i in range(3)]
    texts += [texts[3], texts[3] + " fin", texts[5], "start " + items[0][1] + " end", " ".join(items[1][1].split()[2:14])]
    texts += [f"you vile zounds {t} zounds" for t in texts[:40:2]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (None, "no id"), (902, "copy of a row here"), (902, "copy of a row here")]
    docs = spark.createDataFrame([(i, t, "en", None, 1, "r", 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string, score int")
    labels = [(i, 1, int("zounds" in t)) for i, t in enumerate(texts)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs, items, str(tmp_path)


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_stages_decide_and_keep_the_columns(spark, given):
    docs, items, folder = given
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    toxicity, join, clean, packing = (stage for _, stage in corpus_pipeline.STAGES)
    kept = toxicity(spark, docs, folder)
    assert kept.columns == docs.columns
    assert rows_of(kept) == sorted(((r.doc_id, r.text) for r in docs.collect() if "zounds" not in (r.text or "")), key=repr)

    single = join(spark, kept, folder)
    expected = {(d, n) for (d, n, c) in linked(rows_of(kept)) if d == c or d is None}
    assert single.columns == docs.columns and {r[0] for r in rows_of(single)} == {d for d, _ in expected}
    assert len(rows_of(single)) == len(set(rows_of(single)))

    pure = clean(spark, single, folder)
    good = {d for (d, _, hit, _) in contaminated(rows_of(single), items) if not hit}
    assert pure.columns == docs.columns and {r[0] for r in rows_of(pure)} == good and 63 not in good and 64 not in good

    pieces = packing(spark, pure, folder).collect()
    assert {p.doc_id for p in pieces} == good and len(pieces) == len(rows_of(pure))


def test_no_documents(spark, given):
    docs, _, folder = given
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_the_run_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    other = docs.collect()
    assert {tuple(r)[:5] for r in rows} == {tuple(r)[:5] for r in other} and len(rows) == len(other) > 100


def test_near_duplicates_by_five_words_and_four_fifths(spark, tmp_path):
    """Against all pairs: copies with few and many edits, of which 3-word n-grams at 0.9 would keep some."""
    random.seed(80)
    word = lambda: random.choice("bcdfghklm") + random.choice("aeiou") + random.choice("nrst") + random.choice("aeiou")
    texts = []
    for edits in (0, 1, 2, 3, 4, 5, 8, 12):
        for _ in range(3):
            own = [word() for _ in range(200)]
            other = list(own)
            for at in random.sample(range(5, 195), edits):
                other[at] = "edited" + word()
            texts += [" ".join(own), " ".join(other)]
    texts += ["", "one two", "one two", "one two three four five six"]

    def grams(text, k):
        w = text.split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()

    def kept(k, percent):
        sets, label = [grams(t, k) for t in texts], list(range(len(texts)))
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    old, new = max(label[i], label[j]), min(label[i], label[j])
                    label = [new if x == old else x for x in label]
        return {i for i, x in enumerate(label) if i == x}

    assert kept(5, 80) < kept(3, 90)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()} == kept(5, 80)


def test_texts_reach_python_in_small_batches(spark, given, monkeypatch):
    """While a stage's tables are written; the session's own setting is put back."""
    docs, _, folder = given
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)
    for work in ("score_toxicity", "packed_documents"):
        real = getattr(corpus_pipeline, work)
        monkeypatch.setattr(corpus_pipeline, work, lambda *given, real=real: seen.append(spark.conf.get(name)) or real(*given))
    corpus_pipeline.toxicity(spark, docs, folder)
    corpus_pipeline.packing(spark, docs, folder)
    assert seen == ["1000", "1000"] and spark.conf.get(name) == before
