import zlib

import numpy as np
from tokenizers import Tokenizer

from tallylake.llm.common import encoder, tokenizer_path
from tallylake.llm.tokenfiles import op2_token_files, read_documents, read_manifest, write_token_files
from tallylake.session import new_run_folder

SF = "/root/testdata/sf0.001"
PATH = tokenizer_path()
SPACES = [c for c in map(chr, range(0x3100)) if c.isspace()]
TEXTS = [
    "", " ", "a  b", " a", "a ", "a\n b", "a \nb", "x<|endoftext|> y", "it's don't 'll 've", "1 2 33 4a", "… a", "  a", "\n", "ünï çödé", "日本 語", "a\u0300 b",
    *(f"a{c} b" for c in SPACES), *(f"a {c}b" for c in SPACES), *(f"{c}a b" for c in SPACES), *(f"a b{c}" for c in SPACES),
]


def test_ids_are_those_of_the_library():
    library = Tokenizer.from_file(PATH)
    expected = [e.ids for e in library.encode_batch(TEXTS, add_special_tokens=False)]
    for _ in range(2):  # the second time from the memo
        ids, sizes = encoder(PATH).encode(TEXTS)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == expected


def brute(rows, end_id):
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_the_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in op2_token_files(spark, SF).orderBy("start").collect()]
    assert got == brute(rows, 2)


def test_odd_rows(spark, odd_docs, no_docs):
    folder = new_run_folder(spark, "odd")
    write_token_files(odd_docs, folder, PATH, 2)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = [tuple(r) for r in read_documents(spark, folder).orderBy("start").collect()]
    assert got == brute(rows, 2)
    parts = read_manifest(folder)["parts"]
    assert [p["base"] for p in parts] == np.cumsum([0, *(p["ids"] for p in parts)])[:-1].tolist()
    write_token_files(no_docs, new_run_folder(spark, "none"), PATH, 2)
    empty = new_run_folder(spark, "none")
    write_token_files(no_docs, empty, PATH, None)
    assert read_manifest(empty) == {"ids": 0, "parts": []} and read_documents(spark, empty).count() == 0
