"""License scans: winnowed fingerprints of templates pick candidates, banded alignment confirms them."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import HashMemo, in_steps, mixed, table
from tallylake.llm.license_texts import TEMPLATES, license_of
from tallylake.llm.registry import query

#: Words of a hash and hashes of a window: any GRAM + WINDOW - 1 words in a row that a text shares with a template are seen.
GRAM, WINDOW = 2, 2
#: Words that an alignment may drift to either side.
BAND = 8
#: A match covers this share of its template's words, and its words are this share of the words between its ends.
MIN_COVERAGE, MIN_DENSITY = 0.8, 0.6
#: Share of a template's fingerprints that a place has to show before it's aligned.
MIN_VOTES = 0.2
#: Templates of up to so many words have to be there word for word.
SHORT_WORDS = 8
#: Templates of other licenses that have this share of a template's different words are near it.
NEAR = 0.5

#: Words that make a license another one: a match has those of its template and no others. So have versions in a template's name.
QUALIFIERS = frozenset([b"nd", b"nc", b"sa", b"noncommercial", b"noderivatives", b"sharealike", b"lesser", b"library", b"affero"])

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_TO_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(low: bytes) -> list[bytes]:
    """Words of digits, letters and all that isn't ASCII, of a text in lower case."""
    return low.translate(_TO_SPACE).split()


def fingerprints(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their places: the least of each window, the last one among equals."""
    n = len(hashes) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = np.zeros(n, np.uint64)
    for i in range(GRAM):
        grams = mixed(grams + hashes[i : i + n])
    if n < WINDOW:
        at = np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))])
    else:
        windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)[:, ::-1]
        at = np.unique(np.arange(len(windows)) + WINDOW - 1 - np.argmin(windows, axis=1))
    return grams[at], at


class Match(NamedTuple):
    """``start`` and ``end`` count characters of the text; ``matched`` counts words of the template."""

    license: str
    start: int
    end: int
    matched: int
    coverage: float


def align(template: np.ndarray, text: np.ndarray, start: int) -> tuple[int, int, int]:
    """Most words of ``template`` that ``text`` has in order, within BAND words of the diagonal through ``start``.

    Returns that number, the place of the first and one past the last of them in ``text``.
    """
    width = 2 * BAND + 1
    # Column b of row i stands for the text's word start + i + b - BAND.
    place = start - BAND + np.arange(len(template))[:, None] + np.arange(width)
    inside = (place >= 0) & (place < len(text))
    same = inside & (text[np.clip(place, 0, len(text) - 1)] == template[:, None])
    best = np.zeros((len(template) + 1, width + 1), np.int64)
    for i in range(len(template)):
        above = np.maximum(best[i, :-1] + same[i], best[i, 1:])
        best[i + 1, :-1] = np.maximum.accumulate(above)
    i, b = len(template), int(np.argmax(best[-1, :-1]))
    total, first, last = int(best[-1].max()), -1, -1
    while i and best[i, b]:
        if b and best[i, b - 1] == best[i, b]:
            b -= 1
        elif same[i - 1, b] and best[i - 1, b] + 1 == best[i, b]:
            first = int(place[i - 1, b])
            last = first if last < 0 else last
            i -= 1
        else:
            i, b = i - 1, b + 1
    return total, first, last + 1


def _ends_with(name: str, tail: bytes) -> bool:
    """Whether an identifier ends where its match does: one that goes on is another one, a full stop may end a sentence."""
    joined = tail[:1] == b"+" or (tail[:1] in (b"-", b".") and tail[1:].isalnum())
    return not (name.endswith("-SPDX") and joined)


class Index:
    """Templates by fingerprint. Its size follows the written list of templates alone."""

    def __init__(self, templates: Mapping[str, str]):
        self.memo = HashMemo()
        self.words = {name: self.memo.of(words_of(text.encode().lower())) for name, text in templates.items()}
        self.places: dict[int, list[tuple[str, int]]] = defaultdict(list)
        self.votes = {}
        for name, hashes in self.words.items():
            kept, at = fingerprints(hashes)
            for value, place in zip(kept.tolist(), at.tolist(), strict=True):
                self.places[value].append((name, place))
            self.votes[name] = max(1, int(MIN_VOTES * len(kept)))
        self.known = np.array(sorted(self.places), np.uint64)
        self.qualifiers = set(self.memo.of(list(QUALIFIERS)).tolist())
        self.versions = {
            name: set(self.memo.of([w for w in words_of(name.encode().lower()) if w.isdigit()]).tolist()) & set(own.tolist())
            for name, own in self.words.items()
        }
        self.different = {name: set(own.tolist()) for name, own in self.words.items()}
        self.identifying = {name: self._identifying(name) for name in self.words}

    def _identifying(self, name: str) -> set[int]:
        """Words of a template that no near template of another license has."""
        own = self.different[name]
        near = [w for n, w in self.different.items() if license_of(n) != license_of(name) and len(w & own) >= NEAR * len(own)]
        return own.difference(*near)

    def _is_own(self, name: str, span: np.ndarray) -> bool:
        """Whether words between a match's ends name this license and no relative of it."""
        words, identifying = set(span.tolist()), self.identifying[name]
        if words & self.qualifiers != self.different[name] & self.qualifiers or not self.versions[name] <= words:
            return False
        return len(words & identifying) >= MIN_COVERAGE * len(identifying)

    def _confirmed(self, name: str, hashes: np.ndarray, start: int) -> tuple | None:
        """Order of choice, name and place of a template's match near ``start``, if there is one."""
        own = self.words[name]
        matched, first, last = align(own, hashes, start)
        if len(own) <= SHORT_WORDS:
            fits = matched == len(own) == last - first
        else:
            fits = matched >= MIN_COVERAGE * len(own) and matched >= MIN_DENSITY * (last - first)
        return (-matched, -matched / len(own), name, first, last) if fits and self._is_own(name, hashes[first:last]) else None

    def _starts(self, hashes: np.ndarray) -> dict[str, list[int]]:
        """For each template the places in the text where it may start; near ones are joined."""
        kept, at = fingerprints(hashes)
        if not len(kept) or not len(self.known):
            return {}
        near = np.minimum(np.searchsorted(self.known, kept), len(self.known) - 1)
        hit = self.known[near] == kept
        starts: dict[str, list[int]] = defaultdict(list)
        for value, place in zip(kept[hit].tolist(), at[hit].tolist(), strict=True):
            for name, offset in self.places[value]:
                starts[name].append(place - offset)
        found = {}
        for name, diagonals in starts.items():
            diagonals.sort()
            groups: list[list[int]] = []
            for d in diagonals:
                if groups and d - groups[-1][0] <= BAND:
                    groups[-1].append(d)
                else:
                    groups.append([d])
            found[name] = [g[len(g) // 2] for g in groups if len(g) >= self.votes[name]]
        return found

    def matches(self, text: str) -> list[Match]:
        """The matches of a text; where several templates overlap, the one with most words, then the best covered one."""
        low = text.encode("utf-8", "surrogatepass").lower()
        hashes = self.memo.of(words_of(low))
        found = [self._confirmed(name, hashes, start) for name, starts in self._starts(hashes).items() for start in starts]
        found = [row for row in found if row]
        if not found:
            return []
        spans = [m.span() for m in _WORD.finditer(low)]
        found = [row for row in found if _ends_with(row[2], low[spans[row[4] - 1][1] :][:2])]
        chosen: list[tuple] = []
        for row in sorted(found):
            if all(row[3] >= other[4] or row[4] <= other[3] for other in chosen):
                chosen.append(row)
        chars = lambda n: len(low[:n].decode("utf-8", "surrogatepass"))
        return [
            Match(name, chars(spans[first][0]), chars(spans[last - 1][1]), -matched, -coverage)
            for matched, coverage, name, first, last in sorted(chosen, key=lambda r: r[3])
        ]


_MATCH = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("matched", pa.int64()), ("coverage", pa.float64())])


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, matches (license, start, end, matched, coverage) of every row of ``docs``.

    Input columns: doc_id, text; others are ignored. A null or empty text has no matches, repeated
    rows have equal ones, an empty table has no rows. Each text is looked at whole and alone, so
    nothing is shuffled.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for batch, texts in in_steps(batches):
            matches = pa.array([[m._asdict() for m in index.matches(t)] for t in texts], pa.list_(_MATCH))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), matches], names=["doc_id", "matches"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, matches array<struct<license:string,start:long,end:long,matched:long,coverage:double>>"
    )


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    span = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"], F.round(m["coverage"], 4)))
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(span, ";").alias("spans"),
        F.array_join(F.sort_array(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.coalesce(F.array_max("matches.coverage"), F.lit(0.0)).alias("best_coverage"),
        F.aggregate("matches.matched", F.lit(0).cast("long"), lambda a, x: a + x).alias("matched_words"),
    )
