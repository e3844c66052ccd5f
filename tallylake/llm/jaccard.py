"""Exact Jaccard join of word n-grams: the grouped prefix join.

A text's n-grams are put in one order for all texts, rare ones first. Two sets that are similar share
an n-gram among the first few of each: their prefixes. Sets with one size and one prefix form a group;
groups are joined on prefix n-grams and filtered by size and position, then expanded to their members,
which are verified.

Copies would give all pairs of a large group. So equal sets are one class from the start, and only
links that can still join two components are looked for: first each group is compared with one hub of
every prefix n-gram it has; then, round by round, what is not yet connected meets new hubs, while that
links a good part of it; what stays open is compared in full. No two sets that are similar end in
different components. Before texts are fetched, members are compared by a signature, the parity of
n-grams in each of some slots: two sets differ by at least as many n-grams as bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from tallylake.llm.common import SMALL_STEP, dropped, few, in_steps, mixed, scratch, small_batches, space_words, table, written
from tallylake.llm.components import components
from tallylake.llm.registry import query

NGRAM = 3
#: Two documents link when 100 * intersection >= PERCENT * union.
PERCENT = 90
#: n-grams are counted in so many slots, and words in so many, to find an order with rare n-grams first. The order changes no result.
SLOTS, WORD_SLOTS = 1 << 22, 1 << 22
#: Ranks go up by so many when a count doubles.
RANK_STEPS = 8
#: Slots that are summed together, and sums that tasks are first dealt to.
CHUNK_SLOTS, FIRST_SUMS = 1 << 16, 32
#: Bits of a set's parity signature, 64 to a number: half as many as n-grams, within these bounds, a power of two.
LEAST_BITS, MOST_BITS = 512, 4096
#: Texts of up to so many asked ids are found by a broadcast of the ids, which are counted first; more by a shuffle.
BROADCAST_IDS = 1_000_000
#: n-grams choose their hubs by so many different orders of groups, so that a set meets several hubs in a round.
HUB_ORDERS = 4
#: Rounds of hubs go on while one makes a link for each so many open groups. This changes no result.
OPEN_A_LINK = 20
#: All pairs are compared at once where they are at most so many for each open member.
PAIRS_A_MEMBER = 8


# --- sets -----------------------------------------------------------------------------------


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and how many each text has."""
    words = [space_words(t) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    # Hashing a word again takes no longer than a memo's look-up.
    return np.fromiter(map(xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, int(sizes.sum())), sizes


class Shingles:
    """Sorted distinct 64-bit hashes of the n-grams of texts."""

    def __init__(self, ngram: int):
        self.ngram = ngram

    def of_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The sets of all texts, one after the other, and the bounds of each one's own."""
        return self.of_words(*words_of(texts))[:2]

    def of_words(self, hashes: np.ndarray, sizes: np.ndarray, ranks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """The same from ``words_of``, and of the ``ranks`` of each n-gram's words the least and, in the lower 16 bits, the sum."""
        size = np.minimum(self.ngram, sizes)
        n = np.where(sizes > 0, sizes - size + 1, 0)
        ends = np.cumsum(n)
        text = np.repeat(np.arange(len(sizes)), n)
        at = np.arange(len(text)) + (np.cumsum(sizes) - sizes - (ends - n))[text]
        least, total = np.full(len(text), 255, np.int32), np.zeros(len(text), np.int32)
        # Another start for each length keeps a short text apart from an n-gram.
        own = size[text]
        out = own.astype(np.uint64)
        for i in range(self.ngram):
            longer = own > i
            out[longer] = mixed(out[longer] + hashes[at[longer] + i])
            if ranks is not None:
                rank = ranks[at[longer] + i]
                least[longer] = np.minimum(least[longer], rank)
                total[longer] += rank
        total += least << 16
        for begin, end in zip((ends - n).tolist(), ends.tolist(), strict=True):
            if ranks is None:
                out[begin:end].sort()
            else:
                order = out[begin:end].argsort()
                out[begin:end], total[begin:end] = out[begin:end][order], total[begin:end][order]
        new = np.ones(len(out), bool)
        new[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
        return out[new], np.append(0, np.cumsum(np.bincount(text[new], minlength=len(sizes)))), None if ranks is None else total[new]


def key_of(shingles: np.ndarray) -> bytes:
    return xxh3_128_digest(shingles.tobytes())


def slot_of(shingles: np.ndarray, slots: int) -> np.ndarray:
    return ((shingles >> np.uint64(20)) % np.uint64(slots)).astype(np.int64)


def keys_of(shingles: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """A key for each set; null for empty ones."""
    at = bounds.tolist()
    return [key_of(shingles[a:b]) if b > a else None for a, b in zip(at, at[1:])]


_SETS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("slots", pa.binary())])


def document_sets(docs: DataFrame, ngram: int, slots: int) -> DataFrame:
    """doc_id, text_key, n, key of every row (key null for empty sets), and rows per task with counts by slot, of n-grams and then of words: the chunk as -n - 1, and a number to deal the tasks by as text_key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts, seen = Shingles(ngram), np.zeros(slots + WORD_SLOTS, np.int32), False
        for batch, texts in in_steps(batches, chars=SMALL_STEP):
            seen = True
            hashes, sizes = words_of(texts)
            shingles, bounds, _ = own.of_words(hashes, sizes)
            np.add.at(counts, slot_of(shingles, slots), np.int32(1))
            np.add.at(counts, slots + slot_of(hashes, WORD_SLOTS), np.int32(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_key"), pa.array(np.diff(bounds), pa.int64()),
                    pa.array(keys_of(shingles, bounds), pa.binary()), pa.nulls(len(texts), _SETS.field("slots").type),
                ],
                schema=_SETS,
            )
        if seen:
            deal = TaskContext.get().partitionId() % FIRST_SUMS
            for i, at in enumerate(range(0, len(counts), CHUNK_SLOTS)):
                some = counts[at : at + CHUNK_SLOTS].astype("<i8").tobytes()
                yield pa.RecordBatch.from_pylist([{"n": -1 - i, "text_key": deal, "slots": pa.compress(some, "zstd", asbytes=True)}], _SETS)

    keyed = docs.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    return keyed.mapInArrow(run, "doc_id long, text_key long, n long, key binary, slots binary")


def slot_counts(sets: DataFrame, slots: int) -> np.ndarray:
    """n-grams, and then words, of all documents by slot: so many numbers, however large the table is. Summed in two steps."""
    slots += WORD_SLOTS
    schema = pa.schema([("n", pa.int64()), ("slots", pa.binary())])

    def numbers(n: int, raw: bytes) -> np.ndarray:
        return np.frombuffer(pa.decompress(raw, 8 * min(CHUNK_SLOTS, slots + (n + 1) * CHUNK_SLOTS), "zstd", asbytes=True), "<i8")

    def add(rows: pa.Table) -> pa.Table:
        n, total = rows["n"][0].as_py(), 0
        for raw in rows["slots"]:
            total = total + numbers(n, raw.as_py())
        return pa.Table.from_pylist([{"n": n, "slots": pa.compress(total.tobytes(), "zstd", asbytes=True)}], schema)

    each = sets.where("n < 0").select("n", "text_key", "slots").groupBy("n", "text_key").applyInArrow(add, "n long, slots binary")
    found = each.groupBy("n").applyInArrow(add, "n long, slots binary").toArrow()
    counts = np.zeros(slots, np.int64)
    for n, raw in zip(found["n"].to_pylist(), found["slots"].to_pylist(), strict=True):
        some = numbers(n, raw)
        counts[(-n - 1) * CHUNK_SLOTS :][: len(some)] = some
    return counts


@dataclass(frozen=True)
class Rarity:
    """Ranks by slot, of n-grams and of words: logarithms of their counts.

    An n-gram is as frequent as its slot or its rarest word at most, so the least of these ranks orders the n-grams. In
    a large table every slot holds many n-grams; there are far fewer words.
    """

    ngrams: np.ndarray
    words: np.ndarray

    @classmethod
    def learn(cls, counts: np.ndarray, slots: int) -> Rarity:
        ranks = np.minimum(np.rint(RANK_STEPS * np.log2(counts + 1.0)), 255).astype(np.uint8)
        return cls(ranks[:slots], ranks[slots:])

    def order(self, shingles: np.ndarray, of_words: np.ndarray) -> np.ndarray:
        """What to sort by: the least rank, then the sum of all."""
        own = self.ngrams[slot_of(shingles, len(self.ngrams))].astype(np.int32)
        return (np.minimum(of_words >> 16, own) << 16) + (of_words & 0xFFFF) + own


def prefix_length(n: int, percent: int) -> int:
    """Similar sets share one of this many first n-grams."""
    return n - -(-percent * n // 100) + 1


_PREFIXES = pa.schema([
    ("key", pa.binary()), ("n", pa.int64()), ("group", pa.int64()), ("prefix", pa.list_(pa.int64())), ("signature", pa.list_(pa.int64())),
])


def signatures_of(shingles: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """For each set, which slots hold an odd number of its n-grams. Halves of a signature, laid over each other, give the
    one with half as many slots."""
    sizes = np.diff(bounds)
    bits = np.clip(1 << np.ceil(np.log2(np.maximum(sizes / 2, 1))).astype(np.int64), LEAST_BITS, MOST_BITS)
    slots = ((shingles >> np.uint64(8)) % np.uint64(MOST_BITS)).astype(np.int64)
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sizes)
    for level in np.unique(bits).tolist():
        texts = np.flatnonzero(bits == level)
        place = np.full(len(sizes), -1)
        place[texts] = np.arange(len(texts))
        row = np.repeat(place, sizes)
        own = row[row >= 0] * level + slots[row >= 0] % level
        odd = np.packbits(np.bincount(own, minlength=len(texts) * level) & 1).view(np.int64).reshape(len(texts), -1)
        for i, signature in zip(texts.tolist(), odd, strict=True):
            out[i] = signature
    return out


def document_prefixes(docs: DataFrame, rarity: Rarity, ngram: int, percent: int) -> DataFrame:
    """key, n, group, prefix, signature of every document with words; a group is a size and a prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity)  # a fixed number of slots

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = Shingles(ngram), shared.value
        for _, texts in in_steps(batches, chars=SMALL_STEP):
            hashes, sizes = words_of(texts)
            shingles, bounds, total = own.of_words(hashes, sizes, known.words[slot_of(hashes, len(known.words))])
            signatures = signatures_of(shingles, bounds)
            common = known.order(shingles, total)
            groups, prefixes, filled = [], [], np.flatnonzero(np.diff(bounds))
            for a, b in zip(bounds[filled].tolist(), bounds[filled + 1].tolist(), strict=True):
                # Rare ones first, and by hash among equally frequent ones.
                order = np.argsort(common[a:b], kind="stable")
                prefix = shingles[a + order[: prefix_length(b - a, percent)]]
                groups.append(xxh3_64_intdigest(prefix.tobytes(), b - a) - (1 << 63))
                prefixes.append(prefix.view(np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k in keys_of(shingles, bounds) if k is not None], pa.binary()), pa.array(np.diff(bounds)[filled], pa.int64()),
                pa.array(groups, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())),
                pa.array([signatures[i] for i in filled.tolist()], pa.list_(pa.int64())),
            ], schema=_PREFIXES)

    return docs.mapInArrow(run, "key binary, n long, group long, prefix array<long>, signature array<long>")


# --- candidates -------------------------------------------------------------------------------


def _signatures_agree(percent: int) -> Column:
    """Sets that link differ by at most (n + m)(100 - percent) / (100 + percent) n-grams."""
    a, b = F.col("signature"), F.col("signature_b")
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))

    def folded(one: Column) -> Column:
        halves = F.zip_with(F.slice(one, 1, short), F.slice(one, short + 1, short), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(one) > short, halves).otherwise(one)

    least = LEAST_BITS // 64
    few = sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(least)), F.lit(0))
    many = F.aggregate(F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    # Signatures two steps apart aren't compared.
    differ = F.when(long == least, few).when(long <= 2 * short, many).otherwise(0)
    return differ * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)


def _places_allow(percent: int) -> Column:
    """Sizes, and the places of the shared n-gram (from 0), leave room for the overlap that a link needs."""
    n, m, i, j = (F.col(c) for c in ("n", "m", "pos", "pos_b"))
    sizes = (n * 100 >= m * percent) & (m * 100 >= n * percent)
    most = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return sizes & (most * (100 + percent) >= (n + m) * percent)


def _may_link(percent: int) -> Column:
    """The places, if the shared n-gram is the first one that both have, and the signatures of groups of one allow a link.

    Sets that link pass this for their first n-gram; what they share comes from there on.
    """
    n, m, i, j = (F.col(c) for c in ("n", "m", "pos", "pos_b"))
    first = F.least(n - i, m - j) * (100 + percent) >= (n + m) * percent
    alike = F.col("signature").isNull() | F.col("signature_b").isNull() | _signatures_agree(percent)
    return _places_allow(percent) & first & alike


def _renamed(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*(F.col(c).alias(names.get(c, c)) for c in df.columns))


def _with_components(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with ``comp``: their component so far, or their own key."""
    known = few(labels, "node", "component").withColumnRenamed("node", "key")
    return members.join(known, "key", "left").select(*members.columns, F.coalesce("component", "key").alias("comp"))


def _shared_tokens(groups: DataFrame, percent: int) -> DataFrame:
    """token, group, n, pos of n-grams in the prefixes of several groups, and hub: group, n, pos of the least of them.

    Sizes of sets that link are so near that an n-gram's groups, in the order of size, are cut wherever the next one is too
    large for a link: each run is a token of its own, and a group alone in its run has nothing to meet. Near copies share
    n-grams by the dozen, so of the tokens with the same groups only the first in the order of n-grams is kept: the first
    n-gram that two groups share is always among those.
    """
    by_size = Window.partitionBy("token").orderBy("n")
    tokens = groups.select("group", "n", F.posexplode("prefix").alias("pos", "token"))
    goes_on = tokens.select(
        "*", F.coalesce(F.col("n") * percent <= F.lag("n").over(by_size) * 100, F.lit(False)).alias("met"),
        F.coalesce(F.lead("n").over(by_size) * percent <= F.col("n") * 100, F.lit(False)).alias("meets"),
    )
    start = F.last(F.when(~F.col("met"), F.col("n")), ignorenulls=True).over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    runs = goes_on.withColumn("start", start).where("met OR meets")
    runs = written(runs.select(F.xxhash64("token", "start").alias("token"), "group", "n", "pos"), "runs")
    # A token's groups are told apart from others by 128 bits; their order of n-grams is one, so that of the hub tells it.
    met_in = [F.bit_xor(F.xxhash64(F.lit(i), "group")).alias(f"met_{i}") for i in range(2)]
    heads = runs.groupBy("token").agg(F.min(F.struct("group", "n", "pos")).alias("hub"), *met_in)
    first = F.min(F.struct(F.col("hub.pos").alias("pos"), "token", "hub")).alias("first")
    heads = written(heads.groupBy("met_0", "met_1").agg(first).select("first.token", "first.hub"), "first-tokens")
    return runs.join(few(heads, "token", "hub"), "token").select("token", "group", "n", "pos", "hub")


def _hub_pairs(members: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Key pairs: each member with one member of the least group of every prefix n-gram, and of its own group."""
    leader = F.min(F.struct("key", "n", "signature")).alias("hub_member")
    leaders = members.groupBy("group").agg(leader).select(
        F.col("group").alias("hub"), F.col("hub_member.key").alias("a"), F.col("hub_member.n").alias("m"), F.col("hub_member.signature").alias("signature_b")
    )
    near = tokens.select("group", F.col("hub.group").alias("hub"), "n", F.col("hub.n").alias("m"), "pos", F.col("hub.pos").alias("pos_b"))
    near = near.where((F.col("group") != F.col("hub")) & _places_allow(percent)).select("group", "hub")
    own = members.select("group", F.col("group").alias("hub"))
    pairs = near.unionByName(own).distinct().join(leaders, "hub").join(members, "group").where(_signatures_agree(percent))
    return pairs.select("a", F.col("key").alias("b")).where("a != b")


def _live(placed: DataFrame) -> DataFrame:
    """Of token, group, n, pos, comp, size: the rows of n-grams with several components, and ``top``, the largest one."""
    sizes = placed.groupBy("token", "comp").agg(F.sum("size").alias("size"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("size", "comp")).alias("top"), F.count("*").alias("comps"))
    largest = largest.where("comps > 1").select("token", F.col("top.comp").alias("top"))
    return written(placed.join(largest, "token").select("token", "group", "n", "pos", "comp", "size", "top"), "open-units")


def _first_live(members: DataFrame, tokens: DataFrame) -> DataFrame:
    """``members`` have ``comp``. Groups of several components are n-grams of their own here."""
    units = members.groupBy("group", "comp").agg(F.count("*").alias("size"))
    own = members.select("group", "n").distinct().select(F.col("group").alias("token"), "group", "n", F.lit(0).alias("pos"))
    return _live(tokens.select("token", "group", "n", "pos").unionByName(own).join(units, "group"))


def _next_live(live: DataFrame, labels: DataFrame) -> DataFrame:
    """The same after more links: a component's name is one of its keys, so it tells the new one."""
    known = few(labels, "node", "component").withColumnRenamed("node", "comp")
    moved = live.join(known, "comp", "left").withColumn("comp", F.coalesce("component", "comp"))
    return _live(moved.groupBy("token", "group", "n", "pos", "comp").agg(F.sum("size").alias("size")))


def _left_open(live: DataFrame) -> dict[str, int]:
    """members: those outside the largest component, once for each n-gram; few_pairs: whether comparing all of them takes
    at most PAIRS_A_MEMBER pairs for each member that is met."""
    size, outside = F.sum("size"), F.sum(F.when(F.col("comp") != F.col("top"), F.col("size")).otherwise(0))
    of_token = live.groupBy("token").agg(size.alias("size"), outside.alias("outside"))
    pairs = F.sum(F.col("size").cast("double") * F.col("outside"))
    row = of_token.agg(F.sum("size").alias("met"), F.sum("outside").alias("members"), pairs.alias("pairs")).first()
    return {"members": row["members"] or 0, "few_pairs": (row["pairs"] or 0) <= PAIRS_A_MEMBER * (row["met"] or 0)}


def _round_pairs(live: DataFrame, members: DataFrame, percent: int, turn: int) -> DataFrame:
    """Key pairs of different components: each open member with new hubs of its n-grams, one in the largest component
    and one outside. So there are at most two rows for each row of ``live``."""
    place = F.xxhash64("group", F.pmod("token", F.lit(HUB_ORDERS)), F.lit(turn)).alias("place")
    hub = F.min(F.struct(place, "group", "comp", "n", "pos")).alias("hub")
    hubs = live.groupBy("token", (F.col("comp") == F.col("top")).alias("in_top")).agg(hub).select(
        "token", F.col("hub.group").alias("group_b"), F.col("hub.comp").alias("comp_b"), F.col("hub.n").alias("m"), F.col("hub.pos").alias("pos_b")
    )
    near = live.join(hubs, "token").where((F.col("comp") != F.col("comp_b")) & _places_allow(percent))
    near = near.select("group", "comp", "group_b", "comp_b").distinct()
    leader = F.min(F.struct("key", "n", "signature")).alias("one")
    leaders = members.groupBy("group", "comp").agg(leader).select(
        F.col("group").alias("group_b"), F.col("comp").alias("comp_b"), F.col("one.key").alias("b"), F.col("one.n").alias("m"), F.col("one.signature").alias("signature_b")
    )
    pairs = near.join(leaders, ["group_b", "comp_b"]).join(_renamed(members, key="a"), ["group", "comp"]).where(_signatures_agree(percent))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _open_pairs(live: DataFrame, members: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Key pairs of different components that share a prefix n-gram or a group, and pass the filters.

    For each n-gram the largest component isn't paired with itself: its rows meet only those of others.
    """
    # A row that stands for a whole group meets rows of the same group, whose members differ: no signature.
    alone = groups.select(F.col("group"), F.col("signature").alias("of_group"))
    signed = live.join(alone, "group").withColumn("signature", F.when(F.col("token") != F.col("group"), F.col("of_group"))).drop("of_group", "size")
    small = signed.where("comp != top").drop("top")
    other = _renamed(signed.drop("top"), group="group_b", n="m", pos="pos_b", comp="comp_b", signature="signature_b")
    pairs = small.join(other, "token").where((F.col("comp") != F.col("comp_b")) & _may_link(percent))
    pairs = pairs.select("group", "comp", "group_b", "comp_b").distinct()
    one = members.select("group", "comp", F.col("key").alias("a"), "n", "signature")
    two = _renamed(members, group="group_b", comp="comp_b", key="b", n="m", signature="signature_b")
    expanded = pairs.join(one, ["group", "comp"]).join(two, ["group_b", "comp_b"]).where(_signatures_agree(percent))
    return expanded.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


# --- verification -----------------------------------------------------------------------------


def _texts_of(docs: DataFrame, pairs: DataFrame, classes: DataFrame, ngram: int) -> DataFrame:
    """key, text of every set in ``pairs``, read from the document with the smallest id that has it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingles(ngram)
        for _, texts in in_steps(batches, chars=SMALL_STEP):
            keys = pa.array(keys_of(*own.of_all(texts)), pa.binary())
            yield pa.RecordBatch.from_arrays([keys, pa.array(texts, pa.string())], names=["key", "text"])

    keys = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    needed = written(keys.join(classes, "key").select("key", F.col("first").alias("asked")), "asked-sets")
    ids = needed.select("asked").distinct()
    if needed.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    # An id may have several texts, so the key is made anew; sets without an id are looked for among rows without one.
    found = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("asked")), "left_semi").select("text")
    return found.mapInArrow(run, "key binary, text string")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, ngram: int, percent: int) -> DataFrame:
    """The pairs that link. Equal sets have one key, so a key with several texts may take any of them."""
    pairs = written(pairs.distinct(), "candidates")
    texts = written(_texts_of(docs, pairs, classes, ngram), "asked-texts")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingles(ngram)
        last, one = None, None
        for batch, texts in in_steps(batches, "text_b", SMALL_STEP):
            kept = []
            shingles, bounds = own.of_all(texts)
            for i, a in enumerate(batch.column("a").to_pylist()):
                if a != last:
                    last, one = a, own.of_all([batch.column("text_a")[i].as_py()])[0]
                two = shingles[bounds[i] : bounds[i + 1]]
                both = len(np.intersect1d(one, two, assume_unique=True))
                kept.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    left = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    right = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    found = pairs.join(left, "b").join(right, "a").select("a", "b", "text_a", "text_b")
    return found.mapInArrow(run, "a binary, b binary").distinct()


def _links_of_all(
    docs: DataFrame, classes: DataFrame, members: DataFrame, groups: DataFrame, tokens: DataFrame, ngram: int, percent: int
) -> DataFrame:
    """node, component of every set that has a link. Links are found in rounds, each of them linear, until few are left."""

    def verified(pairs: DataFrame) -> DataFrame:
        with scratch(docs.sparkSession) as kept:
            return kept(_verified(pairs, docs, classes, ngram, percent), "links")

    links = verified(_hub_pairs(members, tokens, percent))
    labels = components(links)
    live, turn = _first_live(_with_components(members, labels), tokens), 0
    while not (n_open := _left_open(live))["few_pairs"]:
        turn += 1
        found = verified(_round_pairs(live, _with_components(members, labels), percent, turn))
        n_found = found.count()
        if n_found:
            # A component's links are those of its nodes to its name from here on.
            stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
            labels, last = components(stars.unionByName(found)), live
            live = _next_live(last, labels)
            dropped(last)
        if n_found * OPEN_A_LINK < n_open["members"]:
            break
    if n_open["members"]:
        more = verified(_open_pairs(live, _with_components(members, labels), groups, percent))
        if more.limit(1).count():
            stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
            labels = components(stars.unionByName(more))
    return labels


def jaccard_components(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT, slots: int = SLOTS) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, component of every row of ``docs``.

    Input columns: doc_id, text; others are ignored. Texts without words, null too, have an empty set
    and are linked with nothing: their component is their own id. component_id is the smallest doc_id
    of the component; null ids count only where a component has no other. Repeated rows each have a
    row. Rows of one id with different texts are linked like any two rows; text_key, a 64-bit hash of the
    text, tells them apart, and component (null without words) tells apart components. An empty table gives no rows.
    """
    spark, given = docs.sparkSession, docs.select(F.col("doc_id").cast("long"), "text")
    with small_batches(spark), scratch(spark) as kept:
        with scratch(spark) as used:
            made = written(document_sets(given, ngram, slots), "sets-and-counts")
            sets = kept(made.where("n >= 0").select("doc_id", "text_key", "n", "key"), "sets")
            classes = kept(sets.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"), F.max("n").alias("n")), "classes")
            prefixes = written(document_prefixes(given, Rarity.learn(slot_counts(made, slots), slots), ngram, percent), "prefixes")
            members = prefixes.select("key", "n", "group", "signature").distinct()
            groups = prefixes.groupBy("group").agg(
                *(F.min(c).alias(c) for c in ("n", "prefix", "signature")), (F.min("key") != F.max("key")).alias("several")
            )
            groups = written(groups.withColumn("signature", F.when(~F.col("several"), F.col("signature"))), "groups")
            tokens = used(_shared_tokens(groups, percent), "tokens")
            active = tokens.select("group").unionByName(groups.where("several").select("group")).distinct()
            members = used(members.join(active, "group"), "members")
            groups = used(groups.select("group", "signature").join(active, "group", "left_semi"), "signatures")
        labels = kept(_links_of_all(given, classes, members, groups, tokens, ngram, percent), "components")
    least = labels.join(classes.select(F.col("key").alias("node"), "first"), "node").groupBy("component").agg(F.min("first").alias("least"))
    of_class = classes.join(labels.withColumnRenamed("node", "key"), "key", "left").join(least, "component", "left")
    of_class = of_class.select(F.col("key").alias("class"), F.coalesce("least", "first").alias("least"), F.coalesce("component", "key").alias("component"))
    out = sets.join(of_class, F.col("key") == F.col("class"), "left")
    return out.select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), "component"
    )


def representatives(found: DataFrame) -> DataFrame:
    """From ``jaccard_components``: doc_id, text_key, keep, copies of each different row. One row of each component is
    kept, that of the smallest doc_id, and every one without words; ``copies`` counts equal rows."""
    rows = found.groupBy("doc_id", "text_key", "component").agg(F.count("*").alias("copies"))
    place = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_key")
    best = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(place).alias("best"))
    joined = rows.join(best, "component", "left")
    return joined.select("doc_id", "text_key", (F.col("best").isNull() | (F.col("best") == place)).alias("keep"), F.when(F.col("component").isNull(), 1).otherwise(F.col("copies")).alias("copies"))


@query("op10_ngram_jaccard_join")
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
