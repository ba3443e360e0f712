"""Language identification by rank-order n-gram profiles and out-of-place distance.

Text is lower-cased, every run of other characters than letters becomes one space, and n-grams of one to three
characters are counted over the whole text. A language's profile is the ranks of its most frequent n-grams in all its
training documents; a document's profile is the ranks of its own. The distance sums, over the document's n-grams, how
far the ranks are apart, or the profile's length where the language lacks the n-gram. The nearest language wins, ties
go to the smaller name.

An n-gram is one 64-bit number (its characters, 21 bits each, first character highest), so order is by length, then
by code points, and counting is sorting in numpy. Training sums counts inside every task before they are shuffled, and
what reaches the driver is one profile for each language, whose length is a parameter.

Defined cases: a text that is null or has no letter is `und` with score 0; equal counts rank by n-gram; rows are
independent, so repeated rows and extra columns change nothing; documents without a language teach nothing; with
nothing learned every text is `und`; long texts are counted `PART_CHARS` characters at a time; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import doc_crc

PROFILE = 400
UNKNOWN = "und"
#: Characters of text that are counted at a time while learning, and of one text.
LEARN_CHARS, PART_CHARS = 2_000_000, 1 << 20
#: Between documents that are counted together; no letter. And the bits of one character of an n-gram.
BETWEEN, PART = 1, (1 << 21) - 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _points(text: str) -> Iterator[np.ndarray]:
    """Code points of the normalised text with a space at both ends, some at a time; none if it has no letter."""
    text, lead, letter = text.lower(), np.array([32], np.uint32), False
    for at in range(0, len(text), PART_CHARS):
        cps = np.frombuffer(text[at : at + PART_CHARS].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        cps = np.where(_letters()[cps], cps, np.uint32(32))
        end = [32] if at + PART_CHARS >= len(text) else []
        cps = np.concatenate((lead, cps, np.array(end, np.uint32)))
        cps = cps[np.concatenate(([True], (cps[1:] != 32) | (cps[:-1] != 32)))]
        if not letter and len(cps) < 2:
            continue  # spaces so far
        if letter:
            cps = cps[1:]  # the last one of the part before
        letter, lead = True, cps[-1:] if len(cps) else lead
        yield cps.astype(np.int64)


def grams(cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts; spaces alone are no unigram."""
    if not len(cps):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.unique(cps)  # few: n-grams of their places sort faster as small numbers
    k, at = len(points), np.searchsorted(points, cps)
    if k <= 1000:
        at = at.astype(np.int32)
    two = at[:-1] * k + at[1:]
    out, counts = [], []
    for codes, n in ((at[cps != 32], 1), (two, 2), (two[:-1] * k + at[2:], 3)):
        u, c = np.unique(codes, return_counts=True)
        u = u.astype(np.int64)
        wide = points[u % k]
        for j in range(1, n):
            u = u // k
            wide = wide | (points[u % k] << (21 * j))
        out.append(wide)
        counts.append(c)
    return np.concatenate(out), np.concatenate(counts).astype(np.int64)


def text_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and their counts."""
    codes, counts, tail = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in _points(text):
        whole = np.concatenate((tail, part))
        more, n = grams(whole)
        if len(tail):  # those that end in the part before are counted there
            again, m = grams(tail)
            more, n = _summed(np.concatenate((codes, more, again)), np.concatenate((counts, n, -m)))
        codes, counts, tail = more, n, whole[-2:]
    return codes, counts


def top(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, in order of rank."""
    if len(codes) > 4 * size:
        some = counts >= np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[some], counts[some]
    return codes[np.lexsort((codes, -counts))[:size]]


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(codes, return_inverse=True)
    return u, np.bincount(at, weights=counts, minlength=len(u)).astype(np.int64)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) summed over a task."""
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    parts: dict[str, list[np.ndarray]] = {}
    held: dict[str, int] = {}

    def settle(lang: str) -> None:
        codes, counts = grams(np.concatenate(parts.pop(lang)))
        inside = (codes & PART != BETWEEN) & (codes >> 21 & PART != BETWEEN) & (codes >> 42 != BETWEEN)
        held.pop(lang)
        add(lang, codes[inside], counts[inside])

    def add(lang: str, codes: np.ndarray, counts: np.ndarray) -> None:
        if lang in total:
            codes, counts = _summed(np.concatenate((total[lang][0], codes)), np.concatenate((total[lang][1], counts)))
        total[lang] = codes, counts

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            if len(text or "") > PART_CHARS:
                add(lang, *text_grams(text))
                continue
            for cps in _points(text or ""):
                parts.setdefault(lang, []).append(np.append(cps, BETWEEN))
                held[lang] = held.get(lang, 0) + len(cps)
                if held[lang] > LEARN_CHARS:
                    settle(lang)
    for lang in [*parts]:
        settle(lang)
    for lang, (codes, counts) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], names=["lang", "gram", "n"])


def learn(labelled: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """Profiles of all languages from all labelled rows (text, lang): n-grams in order of rank."""
    rows = labelled.filter("text is not null and lang is not null").select("text", "lang")
    counts = rows.mapInArrow(_learn, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("rank", rank).filter(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for r in sorted(best.collect(), key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


class Judge:
    """Nearest profile of a text."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names, self.size = sorted(profiles), size
        self.grams = np.unique(np.array([g for p in profiles.values() for g in p], dtype=np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, dtype=np.int64)
        for j, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.grams, profiles[name]), j] = np.arange(len(profiles[name]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        codes, counts = text_grams(text or "")
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        mine = top(codes, counts, self.size)
        at = np.searchsorted(self.grams, mine)
        at = np.where((at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == mine), at, len(self.grams))
        theirs = self.ranks[at]
        apart = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(len(mine))[:, None]))
        far = apart.sum(axis=0) / (len(mine) * self.size)
        best = int(np.argmin(far))
        return self.names[best], float(min(1.0, max(0.0, 1.0 - far[best])))


def _judged(batches: Iterator[pa.RecordBatch], profiles: dict[str, list[int]], size: int) -> Iterator[pa.RecordBatch]:
    judge = Judge(profiles, size)
    for b in batches:
        found = [judge(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])


def teaches(doc_id: Column, folds: int = 3, held: int = 1) -> Column:
    """True for the documents that may be learned from."""
    return doc_crc(doc_id) % folds != held


def identify(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from the documents that are not held out."""
    profiles = learn(docs.filter(teaches(F.col("doc_id"))), size)
    judged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(partial(_judged, profiles=profiles, size=size), "doc_id long, lang_pred string, score double")
    return judged.select("doc_id", (~teaches(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """docs (all columns, whatever their names) with __loom_lang and __loom_score, in one pass over the text."""
    profiles = learn(docs.filter(teaches(F.col("doc_id"))), size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(profiles, size)
        for b in batches:
            found = [judge(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=[*b.schema.names, "__loom_lang", "__loom_score"])

    schema = T.StructType([*docs.schema.fields]).add("__loom_lang", "string").add("__loom_score", "double")
    return docs.mapInArrow(add, schema)
