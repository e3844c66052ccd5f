"""Alignment of two tokenizers over a corpus: groups of tokens that cover the same bytes, and counts of linked ids.

Both encodings of a text are cut where a token of each ends. Nearly every other cut gives a group of one token
each; where these have the same bytes, an array from A ids to B ids knows the pair beforehand and a vector as long
as A's vocabulary counts it. Only what is left, groups of several tokens and the few pairs the array doesn't
name, is counted as pairs that are shuffled.

Texts are encoded once, into a written table of ids; counting and scoring read that.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import SMALL_STEP, Encoder, in_steps, table, tokenizer_path, written
from tallylake.llm.registry import query
from tallylake.session import new_run_folder

#: Tables of up to this many linked pairs are looked up inside tasks (some 70 MB); larger ones are joined.
TABLE_PAIRS = 1 << 22
#: Different pairs that a counting task holds before it hands them on.
HELD_PAIRS = 1 << 20
#: Bytes of ids that a task aligns at once; each takes some hundred bytes.
STEP_BYTES = 800_000


class Vocabulary:
    """The bytes of every id: one flat array with a place and a size for each."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.kind = np.dtype("<u2" if len(tokens) <= 1 << 16 else "<u4")

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[ids] - (ends - sizes), sizes)]


def _byte_letters() -> dict[str, int]:
    """How a byte-level vocabulary writes bytes: printable Latin-1 as itself, the others from U+0100 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Tokenizer A (byte-level BPE, given space and text), B (pieces, adds the space itself), and what both share."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a_encoder = Encoder(a_path)
        self.a_encoder.library.encode_special_tokens = True
        self.b_encoder = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters, size = _byte_letters(), self.a_encoder.size
        names = {i: t for t, i in self.a_encoder.library.get_vocab().items()}
        spelled = (names.get(i, "") for i in range(size))
        self.a = Vocabulary([bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in spelled])
        pieces = range(self.b_encoder.get_piece_size())
        self.b = Vocabulary([
            bytes([int(t[3:5], 16)]) if self.b_encoder.is_byte(i) else t.replace("▁", " ").encode()
            for i, t in ((i, self.b_encoder.id_to_piece(i)) for i in pieces)
        ])

    @cached_property
    def same(self) -> np.ndarray:
        """For each A id the B id of the same bytes, else -1; a piece goes before a byte."""
        of: dict[bytes, int] = {}
        for i in sorted(range(len(self.b.tokens)), key=lambda i: (self.b_encoder.is_byte(i), i)):
            if not (self.b_encoder.is_control(i) or self.b_encoder.is_unknown(i)):
                of.setdefault(self.b.tokens[i], i)
        return np.array([of.get(t, -1) if t else -1 for t in self.a.tokens], np.int64)

    @cached_property
    def digits(self) -> np.ndarray:
        """Decimal ids, right-aligned bytes with zeros before them."""
        n = max(len(self.a.tokens), len(self.b.tokens))
        width = len(str(n - 1))
        text = b"".join(str(i).encode().rjust(width, b"\0") for i in range(n))
        return np.frombuffer(text, np.uint8).reshape(n, width)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """The ids of each text by A and by B; none for an empty text and where joined tokens differ from space and text."""
        a, a_n = self.a_encoder.encode([" " + t for t in texts])
        b_lists = self.b_encoder.encode(texts, num_threads=1)
        b_n = np.fromiter(map(len, b_lists), np.int64, len(b_lists))
        b = np.fromiter(chain.from_iterable(b_lists), np.int64, int(b_n.sum()))
        given = [b" " + t.encode() if t else b"" for t in texts]
        size = np.fromiter(map(len, given), np.int64, len(given))
        good = size > 0
        for vocabulary, ids, n in ((self.a, a, a_n), (self.b, b, b_n)):
            good &= _sums(vocabulary.sizes[ids], n) == size
        for vocabulary, ids, n in ((self.a, a, a_n), (self.b, b, b_n)):
            own = vocabulary.bytes_of(ids[np.repeat(good, n)])
            text = np.frombuffer(b"".join(g for g, x in zip(given, good.tolist(), strict=True) if x), np.uint8)
            good[good] = _sums(own != text, size[good]) == 0
        return _cut(a.astype(self.a.kind), a_n, good), _cut(b.astype(self.b.kind), b_n, good)


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Pair:
    """One pair a worker, kept from task to task."""
    return Pair(a_path, b_path)


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``n`` values each."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(n)
    return total[ends] - total[ends - n]


def _cut(ids: np.ndarray, n: np.ndarray, good: np.ndarray) -> list[bytes]:
    ends = np.cumsum(n).tolist()
    return [ids[e - k : e].tobytes() if x else b"" for e, k, x in zip(ends, n.tolist(), good.tolist(), strict=True)]


@dataclass
class Links:
    """All links of a batch of texts in order. ``exact`` marks groups of one A and one B token that ``same`` knows."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_n: np.ndarray
    b_n: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    last: np.ndarray
    exact: np.ndarray
    n_links: np.ndarray
    n_groups: np.ndarray

    @property
    def a(self) -> np.ndarray:
        return self.a_ids[self.a_at]

    @property
    def b(self) -> np.ndarray:
        return self.b_ids[self.b_at]


def links(pair: Pair, a_texts: list[bytes], b_texts: list[bytes]) -> Links:
    """Each piece between two neighbouring ends, of whichever tokenizer, is one link: the A and the B token over it."""
    a, b = (np.frombuffer(b"".join(t), v.kind).astype(np.int64) for t, v in ((a_texts, pair.a), (b_texts, pair.b)))
    a_n, b_n = (np.fromiter(map(len, t), np.int64, len(t)) // v.kind.itemsize for t, v in ((a_texts, pair.a), (b_texts, pair.b)))
    a_end, b_end = np.cumsum(pair.a.sizes[a]), np.cumsum(pair.b.sizes[b])
    mark = np.zeros(int(a_end[-1]) + 1 if len(a_end) else 1, np.uint8)
    mark[a_end] = 1
    mark[b_end] |= 2
    cut = np.flatnonzero(mark)
    kind = mark[cut]
    ends_a, ends_b, last = kind & 1, kind >> 1, kind == 3
    a_at, b_at = np.cumsum(ends_a, dtype=np.int64) - ends_a, np.cumsum(ends_b, dtype=np.int64) - ends_b
    alone = last & np.concatenate([[True], last[:-1]]) if len(last) else last
    exact = alone & (pair.same[a[a_at]] == b[b_at])
    upto = np.searchsorted(cut, np.cumsum(_sums(pair.a.sizes[a], a_n)), "right")
    n_links = np.diff(upto, prepend=0)
    return Links(a, b, a_n, b_n, a_at, b_at, last, exact, n_links, _sums(last, n_links))


def group_texts(pair: Pair, found: Links) -> pa.Array:
    """The groups of each text: A ids, ``|``, B ids, joined by commas; groups joined by ``;``; empty without tokens."""
    group = np.cumsum(found.last) - found.last
    ends_a, ends_b = np.flatnonzero(np.diff(found.a_at, append=-1)), np.flatnonzero(np.diff(found.b_at, append=-1))
    a_group, b_group = group[ends_a], group[ends_b]  # of each token, by the link it ends with
    n_groups = int(group[-1]) + 1 if len(group) else 0
    a_upto, b_upto = np.cumsum(np.bincount(a_group, minlength=n_groups)), np.cumsum(np.bincount(b_group, minlength=n_groups))
    a_place = np.arange(len(a_group)) + (b_upto[a_group - 1] * (a_group > 0) if n_groups else 0)
    b_place = np.arange(len(b_group)) + (a_upto[b_group] if n_groups else 0)
    ids, mark = np.empty(len(a_place) + len(b_place), np.int64), np.full(len(a_place) + len(b_place), ord(","), np.uint8)
    ids[a_place], ids[b_place] = found.a_ids, found.b_ids
    mark[a_place[a_upto - 1]], mark[b_place[b_upto - 1]] = ord("|"), ord(";")
    n = found.a_n + found.b_n
    ends = np.cumsum(n)
    mark[ends[n > 0] - 1] = 0
    cells = np.hstack([pair.digits[ids], mark[:, None]])
    shown = cells != 0
    sizes = _sums(shown.sum(axis=1), n)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(cells[shown])])


_ENCODED = "doc_id long, row long, a binary, b binary"


def encode_both(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, row (a number of its own for each row), a, b (ids, little-endian unsigned), written; empty without tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(a_path, b_path)
        for batch, texts in in_steps(batches, chars=SMALL_STEP):
            a, b = pair.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["doc_id", "row", "a", "b"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), "text")
    return written(rows.mapInArrow(run, _ENCODED), "encoded")


def _aligned(pair: Pair, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Links]]:
    for batch in batches:
        sizes = pc.binary_length(batch.column("a")).to_pylist()
        start = size = 0
        for i, own in enumerate(sizes):
            size += own
            if size >= STEP_BYTES or i + 1 == len(sizes):
                part = batch.slice(start, i + 1 - start)
                yield part, links(pair, part.column("a").to_pylist(), part.column("b").to_pylist())
                start, size = i + 1, 0


def count_pairs(encoded: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """a, b, n: how many links of the whole corpus hold a pair of ids. Tasks hand on sums, one row for each pair."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(a_path, b_path)
        width = len(pair.b.tokens)
        exact = np.zeros(len(pair.a.tokens), np.int64)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            ids = pa.array((keys // width).astype(np.int32)), pa.array((keys % width).astype(np.int32))
            return pa.RecordBatch.from_arrays([*ids, pa.array(counts)], names=["a", "b", "n"])

        for _, found in _aligned(pair, batches):
            exact += np.bincount(found.a[found.exact], minlength=len(exact))
            odd = ~found.exact
            own, n = np.unique(found.a[odd] * width + found.b[odd], return_counts=True)
            merged, at = np.unique(np.concatenate([keys, own]), return_inverse=True)
            # Sums of whole numbers this small are exact in doubles.
            keys, counts = merged, np.bincount(at, np.concatenate([counts, n]), len(merged)).astype(np.int64)
            if len(keys) > HELD_PAIRS:
                yield rows(keys, counts)
                keys, counts = keys[:0], counts[:0]
        seen = np.flatnonzero(exact)
        yield rows(seen * width + pair.same[seen], exact[seen])
        yield rows(keys, counts)

    parts = encoded.select("a", "b").mapInArrow(run, "a int, b int, n long")
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"))


class PairTable:
    """Counts and best marks of all pairs: for those that ``same`` knows by A id, for others by sorted key."""

    def __init__(self, pair: Pair, folder: str):
        store, path = fs.FileSystem.from_uri(folder)
        rows = pq.read_table(path, filesystem=store)
        a, b, n, best = (rows[c].to_numpy() for c in ("a", "b", "n", "best"))
        self.width = len(pair.b.tokens)
        known = pair.same[a] == b
        self.exact_n, self.exact_best = np.zeros(len(pair.same), np.int64), np.zeros(len(pair.same), bool)
        self.exact_n[a[known]], self.exact_best[a[known]] = n[known], best[known]
        keys = a.astype(np.int64) * self.width + b
        order = np.argsort(keys)
        self.keys, self.n, self.best = keys[order], n[order], best[order]

    def of(self, found: Links) -> tuple[np.ndarray, np.ndarray]:
        """The count of each link's pair, and whether it's the highest of its B id."""
        a, odd = found.a, ~found.exact
        n, best = self.exact_n[a], self.exact_best[a]
        keys, back = np.unique(a[odd] * self.width + found.b[odd], return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        n[odd], best[odd] = self.n[at][back], self.best[at][back]
        return n, best


@lru_cache(maxsize=1)
def _pair_table(a_path: str, b_path: str, folder: str) -> PairTable:
    return PairTable(tokenizers(a_path, b_path), folder)


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _sums_by_join(encoded: DataFrame, counts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """row, n_best, count_sum by a join of each row's different pairs with the table of counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(a_path, b_path)
        width = len(pair.b.tokens)
        for batch, found in _aligned(pair, batches):
            place = np.repeat(np.arange(len(found.n_links)), found.n_links)
            keys = np.stack([place, found.a * width + found.b])
            (place, key), n = np.unique(keys, axis=1, return_counts=True)
            row = batch.column("row").to_numpy()[place]
            arrays = [row, (key // width).astype(np.int32), (key % width).astype(np.int32), n]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["row", "a", "b", "here"])

    own = encoded.select("row", "a", "b").mapInArrow(run, "row long, a int, b int, here long")
    joined = own.join(counts, ["a", "b"])
    return joined.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("here")).otherwise(0)).alias("n_best"), F.sum(F.col("here") * F.col("n")).alias("count_sum")
    )


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups`` (as ``group_texts`` writes them) of every row.

    A links a B token where their byte ranges overlap; a pair's count is the number of such links in the whole
    corpus; ``n_best`` counts links whose count is the highest of their B id, ties included. Null and empty texts,
    and texts that the tokens don't spell exactly, have no tokens: zeros and an empty ``groups``. Repeated rows are
    rows of their own, columns besides doc_id and text aren't read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    encoded = encode_both(docs, a_path, b_path)
    pairs = written(count_pairs(encoded, a_path, b_path), "pair-counts")
    highest = pairs.groupBy(F.col("b").alias("own_b")).agg(F.max("n").alias("highest"))  # a row for each B id
    folder = new_run_folder(spark, "pair-table")
    judged = pairs.join(highest, F.col("b") == F.col("own_b")).select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))
    judged.write.parquet(folder)
    table_rows = spark.read.schema(judged.schema).parquet(folder)
    looked_up = table_rows.count() <= TABLE_PAIRS
    given = encoded.select("doc_id", "a", "b")
    if not looked_up:
        sums = _sums_by_join(encoded, table_rows, a_path, b_path)
        given = encoded.join(sums, "row", "left").select("doc_id", "a", "b", "n_best", "count_sum")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(a_path, b_path)
        for batch, found in _aligned(pair, batches):
            if looked_up:
                n, best = _pair_table(a_path, b_path, folder).of(found)
                sums = [pa.array(_sums(best, found.n_links)), pa.array(_sums(n, found.n_links))]
            else:
                sums = [batch.column(c).fill_null(0) for c in ("n_best", "count_sum")]
            counts = [pa.array(x) for x in (found.a_n, found.b_n, found.n_groups, found.n_links)]
            groups = group_texts(pair, found).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, *sums, groups],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
            )

    return given.mapInArrow(run, _ALIGNED)


@query("op12_tokenizer_alignment")
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    rows = align_tokenizers(table(spark, sf_dir, "documents"), *paths)
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256")
    return rows.select(*[c for c in rows.columns if c != "groups"], sha)
