"""What the operators share: tables, written intermediate results, words, hashes, encoding."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache
from itertools import repeat
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tallylake.session import COMPACT, new_run_folder, released_shuffles

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Texts of one step inside a task hold about this many characters, however many rows Arrow delivers at once.
STEP_CHARS = 5_000_000
#: The same for work that makes many objects of each word.
SMALL_STEP = 1_000_000
#: Rows that a Python worker gets at once; texts of more rows would only wait in its memory.
ROWS_A_BATCH = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Folders of the tables written in the innermost ``scratch``; none outside of one.
_written_here: ContextVar[list[str] | None] = ContextVar("written_here", default=None)


def _write(df: DataFrame, name: str, folders: list[str] | None) -> DataFrame:
    spark = df.sparkSession
    path = new_run_folder(spark, name)
    if folders is not None:
        folders.append(path)
    with released_shuffles(spark):
        df.write.options(**COMPACT).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder: lineage ends here, and a lost executor loses no rows.

    Its shuffle files go once it is written, the table itself with the ``scratch`` around it.
    """
    return _write(df, name, _written_here.get())


#: Written tables of narrow rows are broadcast up to so many of them: at most some 20 MB.
FEW_ROWS = 200_000


def few(table: DataFrame, *columns: str) -> DataFrame:
    """Columns of a written table to join with: broadcast if it has few rows, which are counted, so that no join of small
    tables deals them to as many tasks as large ones have."""
    some = table.select(*columns)
    return F.broadcast(some) if some.count() <= FEW_ROWS else some


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables written inside are deleted at its end. Gives a ``written`` for those that stay; what is read later reads only them."""
    outer, own = _written_here.get(), []
    before = _written_here.set(own)
    try:
        yield lambda df, name: _write(df, name, outer)
    finally:
        _written_here.reset(before)
        for folder in own:
            _delete(spark, folder)


def dropped(table: DataFrame) -> None:
    """A written table that nothing reads any more goes before the ``scratch`` around it ends; other tables are left alone."""
    own, files = _written_here.get() or [], table.inputFiles()
    run = files[0].split("/")[-2] if files else None  # the name that no other folder has
    for folder in [f for f in own if f.rpartition("/")[2] == run]:
        own.remove(folder)
        _delete(table.sparkSession, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of ROWS_A_BATCH rows at most for what is written inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(ROWS_A_BATCH))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def fold_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def in_steps(
    batches: Iterable[pa.RecordBatch], column: str = "text", chars: int = STEP_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts (null: empty); a slice ends at ``chars`` or with its batch."""
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        start = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= chars or i + 1 == len(texts):
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, size = i + 1, 0


def per_batch(work: Callable[[pa.RecordBatch, list[str]], dict[str, Any]], schema: pa.Schema, column: str = "text"):
    """A function for mapInArrow that makes one output batch of each step."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_steps(batches, column):
            made = work(batch, texts)
            yield pa.RecordBatch.from_arrays(
                [a if isinstance(a, pa.Array) else pa.array(a, f.type) for f, a in ((f, made[f.name]) for f in schema)],
                schema=schema,
            )

    return run


# --- words and hashes ------------------------------------------------------------------

#: Entries a memo holds before it starts anew; it bounds a worker's memory and changes no result.
MEMO_ENTRIES = 600_000
#: The same for a memo of hashes, which are cheap to make again.
HASHED_WORDS = 150_000


class HashMemo(dict):
    """64-bit hashes of words (byte strings)."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > HASHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def space_words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case, as UTF-8."""
    # bytes.lower changes A-Z alone, bytes.split() parts at 0x20 and 0x09-0x0D alone.
    return text.encode("utf-8", "surrogatepass").lower().split()


def mixed(a: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    a = a ^ (a >> np.uint64(30))
    a = a * np.uint64(0xBF58476D1CE4E5B9)
    a = a ^ (a >> np.uint64(27))
    a = a * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


# --- encoding with a public byte-level BPE -----------------------------------------------

#: Short texts of words take the library less time a word than long ones.
_WORDS_A_TEXT, _TEXTS_A_CALL = 200, 200


class Encoder:
    """Token ids by the tokenizers library, with a memo of words.

    The pre-tokenizer of a byte-level BPE joins a single space to the word behind it and no merge
    crosses a word's start, so texts are cut at spaces and distinct words encoded, many in one text.
    Every id comes from the library. A text in which white space touches a space between words, or
    that may hold a special token, is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab()
        self.size = max(vocab.values()) + 1
        self.starts = np.zeros(self.size, bool)
        for token, i in vocab.items():
            self.starts[i] = token.startswith("Ġ")  # how the vocabulary writes a space
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.forget()

    def forget(self) -> None:
        """Entry 0 of the table has no ids; it stands for all that can't be encoded as a word."""
        self.memo: dict[str, int] = {}
        self.ids, self.sizes = np.zeros(0, self.kind), np.zeros(1, np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def _words(self, words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of all ``words``, each behind a space, and how many each has."""
        ids, sizes = [], [np.zeros(0, np.int64)]
        groups = [words[i : i + _WORDS_A_TEXT] for i in range(0, len(words), _WORDS_A_TEXT)]
        for i in range(0, len(groups), _TEXTS_A_CALL):
            some = groups[i : i + _TEXTS_A_CALL]
            for group, own in zip(some, self._whole([" " + " ".join(g) for g in some]), strict=True):
                begin = np.flatnonzero(self.starts[own])
                if len(begin) != len(group) or begin[0]:
                    raise ValueError("The vocabulary doesn't mark word starts by a leading space.")
                ids.append(own)
                sizes.append(np.diff(begin, append=len(own)))
        return ids, np.concatenate(sizes)

    def _entries(self, words: np.ndarray) -> np.ndarray:
        """The table's entry of each word, which is learned if it's new."""
        if len(self.memo) > MEMO_ENTRIES:
            self.forget()
        found = np.fromiter(map(self.memo.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(found < 0)
        names = pa.array(words[new], pa.large_string())
        alone = pc.and_(pc.equal(pc.utf8_trim_whitespace(names), names), pc.not_equal(names, ""))
        alone = pc.and_(alone, pc.invert(pc.match_substring(names, "<|")))
        ids, sizes = self._words(words[new][alone := alone.to_numpy(zero_copy_only=False)].tolist())
        entry = np.zeros(len(new), np.int64)
        entry[alone] = len(self.sizes) + np.arange(len(sizes))
        self.ids, self.sizes = np.concatenate([self.ids, *ids]), np.concatenate([self.sizes, sizes])
        self.memo.update(zip(words[new].tolist(), entry.tolist(), strict=True))
        found[new] = entry
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after the other, and the number of each text's ids."""
        if not texts:
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        at = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        unique = coded.dictionary.to_numpy(zero_copy_only=False)
        word = self._entries(unique)[coded.indices.to_numpy()]
        # A text's first word has no space before it; an empty one is the place before a leading space.
        inner = np.ones(len(word), bool)
        inner[at[:-1]] = False
        first = [t.partition(" ")[0] for t in texts]
        odd = np.add.reduceat(inner & (word == 0), at[:-1]) > 0
        odd |= np.fromiter((f[-1:].isspace() or "<|" in f for f in first), bool, len(first))
        word[np.repeat(odd, np.diff(at))] = 0
        word[at[:-1]] = len(self.sizes) + np.arange(len(texts))
        head = self._whole([t if o else f for t, f, o in zip(texts, first, odd.tolist(), strict=True)])
        ids = np.concatenate([self.ids, *head])
        size = np.concatenate([self.sizes, [len(h) for h in head]])
        begin = np.cumsum(size) - size
        length = size[word]
        total = np.cumsum(length)
        gather = np.arange(total[-1]) + np.repeat(begin[word] - (total - length), length)
        return ids[gather], np.add.reduceat(length, at[:-1])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker, kept from task to task."""
    # Tasks share the cores already; the library's own threads would only add to them.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


@contextmanager
def encoding(path: str) -> Iterator[Encoder]:
    """The worker's encoder; the words that a task taught it go with the task, as the worker's next one may be of another stage."""
    own = encoder(path)
    try:
        yield own
    finally:
        own.forget()
        pa.default_memory_pool().release_unused()


def crc_u32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
