import random

from tallylake.llm.licenses import BAND, QUALIFIERS, TEMPLATES, Index, op3_license_scan, scan_licenses, words_of


def test_edited_templates_are_found_with_their_spans():
    random.seed(1)
    index = Index(TEMPLATES)
    for name, template in TEMPLATES.items():
        words = template.split()
        for _ in range(5):
            edited = list(words)
            for _ in range(len(words) // 12):
                # Words that make another license of it stay.
                at = random.choice([i for i in range(1, len(edited) - 1) if not (set(words_of(edited[i].lower().encode())) & QUALIFIERS or any(c.isdigit() for c in edited[i]))])
                edited[at : at + random.choice([0, 1])] = random.choice([[], ["other"]])
            before, after = "Ärger und so. " * random.randrange(30), " more words follow here" * random.randrange(30)
            text = before + " ".join(edited) + after
            best = max(index.matches(text), key=lambda m: m.matched)
            assert best.license == name and best.coverage >= 0.8
            assert len(before) <= best.start <= best.end <= len(before) + len(" ".join(edited))


def test_clean_texts_have_no_match():
    index = Index(TEMPLATES)
    for text in ("", "the rights of all are reserved by law", "a licence under water and the sun " * 500, "all all all " * 3000, "License"):
        assert index.matches(text) == []


def test_the_query_equals_a_search_for_the_notices(spark):
    sf = "/root/testdata/sf0.01"
    notices = {n: t for n, t in TEMPLATES.items() if len(t) < 80}
    rows = {r.doc_id: r for r in op3_license_scan(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    assert sum(r.n_matches > 0 for r in rows.values()) > 10
    for d in docs:
        exact = {n for n, t in notices.items() if t in d.text}
        assert exact <= set(rows[d.doc_id].licenses.split(",")) and (exact or not rows[d.doc_id].n_matches)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = scan_licenses(odd_docs).collect()
    assert len(rows) == 10 and all(r.matches == [] for r in rows)
    assert scan_licenses(no_docs).count() == 0


def test_relatives_of_a_license_do_not_bear_its_name():
    index = Index(TEMPLATES)
    lesser = TEMPLATES["GPL-header"].replace("GNU General", "GNU Lesser General")
    texts = {
        "Licensed under CC BY-ND 4.0": ["CC-BY-ND-4.0"], "Licensed under CC BY-NC-SA 4.0": ["CC-BY-NC-SA-4.0"], "Licensed under CC BY 3.0": [],
        lesser.replace("This program", "This library"): ["LGPL-header"], lesser.replace("Lesser", "Affero"): ["AGPL-header"], lesser: [],
        TEMPLATES["GPL-3.0"].replace("version 3", "version 4"): [], "Licensed under the Apache License, Version 1.1": [],
    }
    for text, names in texts.items():
        assert [m.license for m in index.matches("Some words before. " + text + " And behind.")] == names, text
    for name in ("CC-BY-4.0", "CC-BY-SA-4.0", "GPL-2.0", "GPL-3.0", "GPL-header", "Apache-2.0"):
        assert [m.license for m in index.matches(f"Before. {TEMPLATES[name]} And behind.")] == [name]


def test_lines_tags_and_sentences():
    index = Index(TEMPLATES)
    cc = "This work is licensed under a Creative Commons Attribution 4.0 International License."
    cases = {
        "Released under the BSD License": ["BSD-line"], "Not all rights are reserved here": [], "The MIT License (MIT)": ["MIT-title"],
        "SPDX-License-Identifier: Apache-2.0": ["Apache-2.0-SPDX"], cc: ["CC-BY-4.0-sentence"], cc.replace("Attribution", "Attribution-ShareAlike"): ["CC-BY-SA-4.0-sentence"],
        "// SPDX-License-Identifier: MIT.": ["MIT-SPDX"], "SPDX-License-Identifier: MIT-0": ["MIT-0-SPDX"], "SPDX-License-Identifier: MIT-Other": [],
        "SPDX-License-Identifier: GPL-2.0+": [], "SPDX-License-Identifier: GPL-2.0-or-later": ["GPL-2.0-or-later-SPDX"], "Released under the Foo License": [],
        "released under THE mit license": ["MIT"], "All rights reserved.": ["all-rights-reserved"],
    }
    for text, names in cases.items():
        for around in ("{}", "Words before. {} More words behind it."):
            assert [m.license for m in index.matches(around.format(text))] == names, text


class EveryPlace(Index):
    """The same without fingerprints: each template is tried at each place."""

    def _starts(self, hashes):
        return {name: range(-BAND, len(hashes)) for name in self.words}


def test_the_index_misses_nothing(spark):
    """Documents with the word license or rights, and lines, edited headers and relatives among other words."""
    random.seed(5)
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() if r.text and len(r.text) < 1500]
    texts = [t for t in docs if "icense" in t or "ights" in t][:15]
    for name in random.sample(sorted(TEMPLATES), 15):
        words = TEMPLATES[name].split()
        for at in random.sample(range(len(words)), len(words) // 14):
            words[at] = "other"
        texts.append(" ".join(docs[0].split()[:20] + words + docs[1].split()[:20]))
    fast, slow = Index(TEMPLATES), EveryPlace(TEMPLATES)
    for text in texts:
        one, two = fast.matches(text), slow.matches(text)
        assert [(m.license, m.matched) for m in one] == [(m.license, m.matched) for m in two], text
    assert sum(bool(fast.matches(t)) for t in texts) >= 12
