import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallylake.llm import alignment
from tallylake.llm.alignment import align_tokenizers, encode_both, op12_tokenizer_alignment, tokenizers
from tallylake.llm.common import tokenizer_path

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
COLUMNS = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def byte_of():
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in plain}
    for b in range(256):
        if b not in plain:
            letters[chr(256 + len(letters) - len(plain))] = b
    return letters


def brute(rows):
    """Token by token, all pairs of a text compared by their ranges."""
    a_lib, b_lib = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_lib.encode_special_tokens = True
    letters = byte_of()
    names = {i: bytes(letters.get(c, 0) for c in t) for t, i in a_lib.get_vocab().items()}

    def piece(i):
        t = b_lib.id_to_piece(i)
        return bytes([int(t[3:5], 16)]) if b_lib.is_byte(i) else t.replace("▁", " ").encode()

    def ranges(tokens):
        ends = np.cumsum([0, *map(len, tokens)]).tolist()
        return list(zip(ends, ends[1:], strict=False))

    made, counts = [], Counter()
    for doc_id, text in rows:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        a_bytes, b_bytes = [names[i] for i in a], [piece(i) for i in b]
        if not text or b"".join(a_bytes) != b" " + text.encode() or b"".join(b_bytes) != b" " + text.encode():
            a, b, a_bytes, b_bytes = [], [], [], []
        ra, rb = ranges(a_bytes), ranges(b_bytes)
        pairs, low = [], 0
        for i, (s, e) in enumerate(ra):
            while low < len(rb) and rb[low][1] <= s:
                low += 1
            j = low
            while j < len(rb) and rb[j][0] < e:
                pairs.append((a[i], b[j]))
                j += 1
        counts.update(pairs)
        shared = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, start = [], 0
        for end in shared:
            own = [",".join(str(i) for i, (s, e) in zip(ids, r, strict=True) if start <= s and e <= end) for ids, r in ((a, ra), (b, rb))]
            groups.append("|".join(own))
            start = end
        made.append((doc_id, a, b, groups, pairs))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for doc_id, a, b, groups, pairs in made:
        best = sum(counts[p] == highest[p[1]] for p in pairs)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, len(a), len(b), len(groups), len(pairs), best, sum(counts[p] for p in pairs), sha))
    return sorted(out, key=repr)


HARD = [
    (1, "Hello  world▁and <|endoftext|> more"), (2, None), (3, ""), (4, " \n\t "), (5, "<s>[INST] <0x41> </s><unk>"),
    (6, "naïve café 東京 🙂 ½ \x00 \r\n"), (7, "a" * 300 + " " + "!" * 99), (8, "<|endoftext|>"), (9, "one two"), (9, "one two"),
    (9, "other"), (None, "no id"), (10, "  leading and   inner    spaces  "), (11, "٣٤ ½ ﬁ Ǻ"),
]


def result(frame):
    cols = ["doc_id", *COLUMNS]
    return sorted((tuple(r[c] for c in cols) for r in frame.collect()), key=repr)


def digest(frame):
    return result(frame.withColumn("groups_sha256", alignment.F.expr("CASE WHEN groups = '' THEN '' ELSE sha2(groups, 256) END")))


def test_the_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(op12_tokenizer_alignment(spark, SF)) == brute(rows)


@pytest.mark.parametrize("looked_up", [True, False])
def test_hard_texts_by_lookup_and_by_join(spark, monkeypatch, looked_up):
    if not looked_up:
        monkeypatch.setattr(alignment, "TABLE_PAIRS", 0)
    frame = spark.createDataFrame([(i, t, 5, "x") for i, t in HARD], "doc_id long, text string, a int, groups string")
    assert digest(align_tokenizers(frame, *PATHS)) == brute(HARD)
    assert align_tokenizers(frame.limit(0), *PATHS).count() == 0


def test_groups_spell_the_text(spark):
    pair = tokenizers(*PATHS)
    text = "A naïve reading of 12,345 tokenizers."
    row = align_tokenizers(spark.createDataFrame([(1, text)], "doc_id long, text string"), *PATHS).first()
    for group in row.groups.split(";"):
        a, b = ([int(i) for i in side.split(",")] for side in group.split("|"))
        assert b"".join(pair.a.tokens[i] for i in a) == b"".join(pair.b.tokens[i] for i in b)
    assert b"".join(pair.a.tokens[int(i)] for g in row.groups.split(";") for i in g.split("|")[0].split(",")) == b" " + text.encode()


def test_known_pairs_are_counted_without_pair_rows(spark):
    """Words that both vocabularies have give one row for each A id and task, however often they occur."""
    frame = spark.createDataFrame([(i, "the of and " * 50) for i in range(40)], "doc_id long, text string").coalesce(1)
    counts = alignment.count_pairs(encode_both(frame, *PATHS), *PATHS)
    pair = tokenizers(*PATHS)
    rows = {(r.a, r.b): r.n for r in counts.collect()}
    exact = {k: n for k, n in rows.items() if pair.same[k[0]] == k[1]}
    assert sum(exact.values()) >= 40 * 149 and len(rows) < 8
    known = np.flatnonzero(pair.same >= 0)
    assert len(known) > 10_000 and all(pair.a.tokens[i] == pair.b.tokens[pair.same[i]] for i in known[:: 97].tolist())
