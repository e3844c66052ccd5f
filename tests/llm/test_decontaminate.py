import random
import re
from collections import Counter

from compare import difference

from tallylake.llm.decontaminate import contamination, op6_decontamination
from tallylake.llm.queries import ORACLES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = set()
    for item, text in items:
        w = words(text)
        k = min(10, len(w))
        windows |= {(tuple(w[i : i + k]), "" if item is None else str(item)) for i in range(len(w) - k + 1) if k}
    by: dict = {}
    for window, item in windows:
        by.setdefault(window, set()).add(item)
    out = Counter()
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in by}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in by:
                    hit |= set(range(i, i + k))
                    found |= by[tuple(w[i : i + k])]
        out[doc_id, len(w), len(hit), tuple(sorted(found))] += 1
    return out


def test_the_query_equals_its_sql_and_stays_in_the_jvm(spark):
    frames = []

    def run(session, sf_dir):
        frames.append(op6_decontamination(session, sf_dir))
        return frames[0]

    assert difference(spark, "/root/testdata/sf0.001", run, ORACLES["op6_decontamination"])[0] is None
    plan = frames[0]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_random_texts_with_few_words(spark):
    random.seed(4)
    for letters in ("ab", "abcdefgh"):
        items = [(i % 9 or None, " ".join(random.choices(letters, k=random.choice([0, 1, 3, 6, 9, 10, 11, 14, 30])))) for i in range(14)]
        docs = [(i, " ".join(random.choices(letters, k=random.choice([0, 2, 5, 9, 10, 13, 60])))) for i in range(40)]
        docs += [(100, "x , " + (items[-1][1] or "a")), (101, None), (102, ""), (3, docs[3][1]), (None, docs[5][1]), (5, "other Text")]
        got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()) == brute(docs, items)


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "WÖRTER über, größe wörter ÜBER größe wörter über größe wörter"), (2, None), (3, "")]
    bench = spark.createDataFrame([(i, t, "z", 1) for i, t in items], "item_id long, text string, window string, length int")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = contamination(odd_docs, bench).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == brute(docs, items)
    assert contamination(no_docs, bench).count() == 0
    assert {(r.n_hit, r.contaminated) for r in contamination(odd_docs, bench.limit(0)).collect()} == {(0, False)}
