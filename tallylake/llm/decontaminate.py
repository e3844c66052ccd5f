"""Benchmark decontamination by winnowing, in DataFrame operations alone.

Of every k consecutive words there is a hash; of every w consecutive hashes the least is kept. Two
texts that share w + k - 1 consecutive words keep the same hash inside them, so a join of kept hashes
finds every shared window of that length. Each joined place is then extended to the windows around
it, and these are compared as texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import lower_ascii, table, written
from tallylake.llm.registry import query

#: Words of a window; an item with fewer words is one window.
WINDOW_WORDS = 10
#: Words of a hash; window - gram + 1 hashes lie in a window.
GRAM_WORDS = 5
#: Benchmarks of at most so many windows are broadcast after they are counted; larger ones are shuffled.
BROADCAST_WINDOWS = 500_000
#: What lies between words: all of ASCII but digits and small letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of the text with A-Z in lower case; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _span(length: int) -> tuple[int, int]:
    """Words of a hash and hashes of a window, for windows of ``length`` words."""
    gram = min(GRAM_WORDS, length)
    return gram, length - gram + 1


def _hashes(words: str, length: int) -> Column:
    """The hash of every gram; column ``words`` has to be a column, not an expression, so that it's evaluated once."""
    gram, _ = _span(length)
    at = F.transform(words, lambda x, i: F.xxhash64(F.lit(length), x, *(F.get(words, i + j) for j in range(1, gram))))
    return F.slice(at, 1, F.greatest(F.size(words) - F.lit(gram - 1), F.lit(0)))


def _kept(hashes: str, length: int) -> Column:
    """The different least hashes of all windows."""
    _, width = _span(length)
    if width == 1:
        return F.array_distinct(hashes)
    least = F.transform(hashes, lambda x, i: F.least(x, *(F.get(hashes, i + j) for j in range(1, width))))
    return F.array_distinct(F.slice(least, 1, F.greatest(F.size(hashes) - F.lit(width - 1), F.lit(0))))


def _with_kept(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``kept``: the hashes kept for each window length, which is part of each hash."""
    for n in lengths:
        df = df.withColumn(f"hashes_{n}", _hashes("words", n))
    for n in lengths:
        df = df.withColumn(f"kept_{n}", _kept(f"hashes_{n}", n))
    return df.withColumn("kept", F.concat(*(F.col(f"kept_{n}") for n in lengths)))


def _starts_of(length: int) -> Column:
    gram, width = _span(length)
    places = F.filter(
        F.transform(f"hashes_{length}", lambda h, i: F.when(F.array_contains("seeds", h), i + 1)), lambda p: p.isNotNull()
    )
    last = F.size("words") - F.lit(length - 1)
    # A gram at p lies in the windows that start at p - width + 1 .. p.
    around = F.transform(places, lambda p: F.filter(
        F.sequence(F.greatest(p - F.lit(width - 1), F.lit(1)), p), lambda s: s <= last
    ))
    distinct = F.array_distinct(F.flatten(around))
    return F.transform(distinct, lambda s: F.struct(s.alias("start"), F.lit(length).alias("length")))


def _starts(lengths: list[int]) -> Column:
    """Structs of start (from 1) and length: the windows around each place whose hash is among ``seeds``."""
    return F.concat(*map(_starts_of, lengths))


def _text(start: Column, length: Column) -> Column:
    """The words of a window as a text; words hold no spaces, so equal texts are equal windows."""
    return F.array_join(F.slice("words", start, length), " ")


def _broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, n_items, items (ids as sorted strings), contaminated: a row per row of ``docs``.

    Input columns: doc_id and text, item_id and text; others are ignored. Null and wordless texts have
    no words and hit nothing. A null item_id is the id ''. Repeated items count once; repeated
    documents each have their row, and documents of one id with different texts are told apart by
    text_key, a 64-bit hash of the text. Empty tables give no rows or no hits.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words"))
    items = written(items.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window))), "benchmark-words")
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())  # at most ``window`` values
    given = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), words_of(F.col("text")).alias("words")
    )
    if not lengths:
        none = given.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
        return none.withColumns({
            "n_hit": F.lit(0).cast("long"), "n_items": F.lit(0).cast("long"), "items": F.array().cast("array<string>"),
            "contaminated": F.lit(False),
        })
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1))
    windows = items.select("item", "words", "length", starts.alias("start"))
    windows = written(windows.select("item", _text(F.col("start"), F.col("length")).alias("window")).distinct(), "benchmark-windows")
    small = windows.count() <= BROADCAST_WINDOWS
    texts = windows.groupBy("window").agg(F.min(F.lit(1)).alias("one")).select("window")
    prints = None
    for n in lengths:
        own = _with_kept(items.where(F.col("length") == n), [n]).select(F.explode("kept").alias("kept"))
        prints = own if prints is None else prints.unionByName(own)
    prints = written(prints.distinct(), "benchmark-prints")

    read = written(
        _with_kept(given, lengths).select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"), "kept"), "document-prints"
    )
    seeds = read.select("doc_id", "text_key", F.explode("kept").alias("kept")).join(_broadcast(prints, small), "kept")
    seeds = written(seeds.groupBy("doc_id", "text_key").agg(F.collect_set("kept").alias("seeds")), "document-seeds")
    seeded = given.join(
        seeds.withColumnsRenamed({"doc_id": "seed_doc", "text_key": "seed_key"}),
        F.col("doc_id").eqNullSafe(F.col("seed_doc")) & (F.col("text_key") == F.col("seed_key")),
    ).select("doc_id", "text_key", "words", "seeds")
    for n in lengths:
        seeded = seeded.withColumn(f"hashes_{n}", _hashes("words", n))
    around = seeded.select("doc_id", "text_key", "words", F.explode(_starts(lengths)).alias("at"))
    around = around.select("doc_id", "text_key", "at", _text(F.col("at.start"), F.col("at.length")).alias("window"))
    hits = written(around.join(_broadcast(texts, small), "window").distinct(), "document-hits")

    places = F.flatten(F.transform("at", lambda a: F.sequence(a["start"], a["start"] + a["length"] - 1)))
    hit = hits.groupBy("doc_id", "text_key").agg(F.collect_set("at").alias("at")).select(
        "doc_id", "text_key", F.size(F.array_distinct(places)).cast("long").alias("n_hit")
    )
    found = hits.select("doc_id", "text_key", "window").distinct().join(_broadcast(windows, small), "window")
    found = found.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    both = hit.join(found, hit.doc_id.eqNullSafe(found.doc_id) & (hit.text_key == found.text_key)).select(
        hit.doc_id.alias("hit_doc"), hit.text_key.alias("hit_key"), "n_hit", "items"
    )
    out = read.select("doc_id", "text_key", "n_words").join(
        both, F.col("doc_id").eqNullSafe(F.col("hit_doc")) & (F.col("text_key") == F.col("hit_key")), "left"
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(items_found).cast("long").alias("n_items"),
        items_found.alias("items"), (n_hit > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark),
n AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS t
       FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM n)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS t
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, ks)),
h AS (SELECT dw.doc_id, dw.s, dw.k, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.t = bw.t),
p AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS x FROM h) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN i USING (doc_id)
"""


@query("op6_decontamination", SQL)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")
