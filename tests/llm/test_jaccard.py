import random
from collections import Counter

import pytest

from tallylake.llm.components import components
from tallylake.llm.jaccard import jaccard_components, op10_ngram_jaccard_join, prefix_length, representatives


def shingles(text, k=3):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(docs, percent=90):
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least: dict = {}
    for (d, _), x in zip(docs, label):
        if d is not None:
            least[x] = min(d, least.get(x, d))
    return Counter((d, len(s), least.get(x, d)) for (d, _), s, x in zip(docs, sets, label))


def found(spark, docs, **kw):
    rows = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), **kw).collect()
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def test_the_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in op10_ngram_jaccard_join(spark, sf).collect())
    assert got == brute(docs)


@pytest.mark.parametrize("percent", [60, 90])
def test_families_of_near_copies(spark, percent):
    """Chains of edits, exact copies, and a shared passage, so that hubs alone would miss links."""
    random.seed(percent)
    word = lambda: random.choice("abcdefghijklmnop") + random.choice("qrstuvwxyz")
    passage, docs = [word() for _ in range(30)], []
    for family in range(6):
        now = [word() for _ in range(random.choice([4, 20, 70]))] + (passage if family % 2 else [])
        for _ in range(12):
            docs.append((len(docs), " ".join(now)))
            now = list(now)
            for _ in range(random.choice([0, 1, 1, 2])):
                now[random.randrange(len(now))] = word()
    random.shuffle(docs)
    assert found(spark, docs, percent=percent) == brute(docs, percent)


def test_the_order_changes_nothing(spark):
    random.seed(9)
    docs = [(i, " ".join(random.choices("abcd", k=random.choice([1, 2, 5, 9, 40])))) for i in range(120)]
    expected = brute(docs)
    assert found(spark, docs) == expected
    assert found(spark, docs, slots=4) == expected


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows = jaccard_components(odd_docs)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows.collect()) == brute(docs)
    decided = {(r.doc_id, r.text_key): (r.keep, r.copies) for r in representatives(rows).collect()}
    assert len(decided) == len(docs) - 1 and all(k for k, _ in decided.values()) and sum(c == 2 for _, c in decided.values()) == 1
    assert jaccard_components(no_docs).count() == 0


def test_prefixes_are_long_enough():
    for percent in (50, 80, 90, 100):
        for n in range(1, 200):
            assert prefix_length(n, percent) >= n - int(percent * n / 100 + 0.999999) + 1 and prefix_length(n, percent) >= 1


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 500), (None, 3), (1, 0)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 500: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_sets_have_long_signatures(spark):
    """Texts of up to 9,000 words in pairs on both sides of the bound, with signatures of one length and of two."""
    random.seed(3)
    docs = []
    for n in (1000, 1100, 2040, 2100, 4000, 4200, 9000):
        words = [f"w{random.randrange(10**9)}" for _ in range(n)]
        for edits in (n // 80, n // 45, n // 20):
            edited = list(words)
            for at in random.sample(range(n), edits):
                edited[at] = "x"
            docs.append((len(docs), " ".join(edited + words[: n // 50])))
        docs.append((len(docs), " ".join(words)))
    expected = brute(docs)
    assert found(spark, docs) == expected and 7 < len({c for _, _, c in expected}) < len(docs)


def test_work_on_families_grows_in_proportion(spark):
    """Five times the families give about five times the pairs that are verified."""
    from tallylake.llm import jaccard

    random.seed(4)
    made = []

    def families(count):
        docs = []
        for f in range(count):
            words = [f"f{f}w{i}" for i in range(120)]
            for _ in range(15):
                edited = list(words)
                for at in random.sample(range(120), random.choice([0, 1, 1, 2])):
                    edited[at] = f"e{random.randrange(10**6)}"
                docs.append((len(docs), " ".join(edited)))
        return docs

    original = jaccard._verified

    def counted(pairs, *rest):
        made[-1] += pairs.distinct().count()
        return original(pairs, *rest)

    jaccard._verified = counted
    try:
        for count in (4, 20):
            docs = families(count)
            made.append(0)
            assert found(spark, docs) == brute(docs)
    finally:
        jaccard._verified = original
    assert made[1] <= 6 * made[0]


def test_only_what_is_read_later_stays_on_disk(spark):
    """Tables of the rounds go with them; the result still reads, and reads again."""
    from pathlib import Path

    from tallylake.session import workspace

    folder = Path(workspace(spark))
    before = set(folder.glob("*/*"))
    docs = [(i, f"a b c d e f g h i j k l m n o p q r s t u v w x y{i // 4 % 3}") for i in range(24)]
    result = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), percent=60)
    assert sorted(p.parent.name for p in set(folder.glob("*/*")) - before) == ["classes", "components", "sets"]
    for _ in range(2):
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in result.collect()) == brute(docs, 60)


def test_shared_ngrams_of_far_sizes_meet_nothing(spark):
    """An n-gram is a token of its own for each run of sizes that may link; a group alone in its run has none."""
    from tallylake.llm.jaccard import _shared_tokens

    rows = [(g, n, [7, 100 + g]) for g, n in enumerate([50, 95, 100, 105, 180, 300, 310])]
    groups = spark.createDataFrame(rows, "group long, n long, prefix array<long>")
    got = _shared_tokens(groups, 90).collect()
    by_token = {}
    for r in got:
        by_token.setdefault(r.token, set()).add((r.n, r.pos, r.hub.n))
    assert sorted(map(sorted, by_token.values())) == [[(95, 0, 95), (100, 0, 95), (105, 0, 95)], [(300, 0, 300), (310, 0, 300)]]


def test_ngrams_of_rare_words_come_first(spark):
    """With so few slots that all n-grams look alike, a prefix still holds those of the rarest words."""
    from tallylake.llm import jaccard

    docs = spark.createDataFrame([(i, " ".join(["the of and to"] * 9 + [f"odd{i}"] + ["a in is it"] * 9)) for i in range(40)], "doc_id long, text string")
    made = jaccard.document_sets(docs, 3, 1)
    rarity = jaccard.Rarity.learn(jaccard.slot_counts(made, 1), 1)
    prefixes = [set(r.prefix) for r in jaccard.document_prefixes(docs, rarity, 3, 90).collect()]
    assert len(prefixes) == 40 and all(p for p in prefixes) and len(set().union(*prefixes)) == sum(map(len, prefixes))


def test_links_inside_a_component_are_not_read_again(spark, monkeypatch):
    """Each round joins only links between nodes that still differ: half of them are gone after the first."""
    from tallylake.llm import components as module

    random.seed(6)
    links = [(g * 100 + random.randrange(40), g * 100 + random.randrange(40)) for g in range(5) for _ in range(200)]
    sizes, original = [], module._both_ways
    monkeypatch.setattr(module, "_both_ways", lambda df: sizes.append(df.count()) or original(df))
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for link in links for n in link}
    assert set(got) == nodes and all(got[a] == got[b] for a, b in links) and all(c <= n and c in nodes for n, c in got.items())
    assert sum(sizes) <= 2 * sizes[0]


def test_ngrams_that_the_same_groups_share_are_met_once(spark):
    """Two copies share a hundred n-grams, one of them a few with a third text: two tokens, at the first place of each."""
    from tallylake.llm.jaccard import _shared_tokens

    shared = list(range(100, 200))
    rows = [(1, 500, [7, *shared]), (2, 500, [8, 9, *shared]), (3, 500, [10, *shared[40:60]])]
    got = _shared_tokens(spark.createDataFrame(rows, "group long, n long, prefix array<long>"), 80).collect()
    assert Counter((r.group, r.pos, tuple(r.hub)) for r in got) == Counter(
        [(1, 1, (1, 500, 1)), (2, 2, (1, 500, 1)), (1, 41, (1, 500, 41)), (2, 42, (1, 500, 41)), (3, 1, (1, 500, 41))]
    )
