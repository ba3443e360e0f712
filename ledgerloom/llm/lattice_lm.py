"""Score documents by a unigram lattice over subword pieces and whole words.

Text is lower-cased (A-Z) and cut into words; every document ends with one end token. A word's lattice has two kinds of
paths: one arc for the whole word, if training has it, and behind an escape all segmentations of the marked word into
pieces of an existing subword vocabulary, closed by an end piece. The marginal of all paths,

    P(w) = max(c(w) - d, 0) / N  +  (d * V / N) * L(w),

comes from a forward recursion in log space, with the training counts c, N tokens, V distinct ones and the absolute
discount d = n1 / (n1 + 2 n2) as the weight of the escape. A document's score is the sum over its words.

The vocabulary stays as it is. Its scores order its pieces, and the r-th of them weighs 1 / (r + FLAT) at first; `ROUNDS`
rounds of expectation maximisation (expected counts by forward and backward recursion over all segmentations of all
training words, each distinct one once, as L is asked for words that were hardly seen) then fit the weights. A character
without a piece is spelled by its bytes.

Word counts are summed in every task before they are shuffled, then for all documents' words, so the lattice runs once
for each distinct word, for words of one length together. Words that are frequent in all documents (at most HEAD of them,
a bound) are broadcast with their values; a document's other words are joined with the count table, so a frequent word
is never a hot key, and what is gathered grows with the corpus. Words whose counts lie within a sixteenth of a power of
two go together; if already the most frequent ones are more than HEAD, none of them has more than about 1 / HEAD of all
tokens, and none is broadcast.

Defined cases: a null text is empty and has the end token only; rows are scored one by one, so repeated rows get equal
scores (and count twice in training); a null doc_id counts as the empty text for the split; without training rows all
probability is the lattice's; an empty table gives no rows; other columns are ignored; words longer than `LONG`
characters go through the lattice one by one.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import discard, release, stored

FOLDS, HELD = 7, 2
#: Most words that are broadcast; distinct words a task counts before it sends them on; the end token.
HEAD, FLUSH, END = 1 << 17, 250_000, b""
MARK = "▁"
#: Added to every piece's expected count, so that all are possible; rounds of fitting; what flattens the first weights.
SMOOTH, ROUNDS, FLAT = 0.1, 2, 20
#: Characters of words that are worked on together, and numbers of a batch of them.
LONG, TOGETHER = 64, 1 << 21
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()


def is_held_out(doc_id: int | None, folds: int, held: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == held


def _counts(batches: Iterator[pa.RecordBatch], folds: int, held: int) -> Iterator[pa.RecordBatch]:
    """(word, c, every): counts in training documents, and in all."""
    trained: Counter = Counter()
    other: Counter = Counter()

    def send() -> pa.RecordBatch:
        w = [*(trained | other)]
        c = [trained[x] for x in w]
        every = [n + other[x] for n, x in zip(c, w, strict=True)]
        trained.clear()
        other.clear()
        return pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array(c, pa.int64()), pa.array(every, pa.int64())], names=["word", "c", "every"])

    for b in batches:
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            into = other if is_held_out(doc_id, folds, held) else trained
            into.update(words(text))
            into[END] += 1
        if len(trained) + len(other) > FLUSH:
            yield send()
    yield send()


@lru_cache(maxsize=2)
def _processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def vocabulary(model: str) -> tuple[dict[str, float], dict[int, float], float]:
    """Pieces, bytes and the end piece with their first weights, as natural logarithms."""
    sp = _processor(model)
    usable = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    usable.sort(key=lambda i: (-sp.get_score(i), i))
    weight = 1 / (np.arange(len(usable)) + FLAT)
    logs = np.log(weight / (weight.sum() * 1.25)).tolist()  # a fifth is the end piece's
    byte = {int(sp.id_to_piece(i)[3:5], 16): x for i, x in zip(usable, logs, strict=True) if sp.is_byte(i)}
    return {sp.id_to_piece(i): x for i, x in zip(usable, logs, strict=True) if not sp.is_byte(i)}, byte, math.log(0.2)


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _rolled(h: np.ndarray, points: np.ndarray) -> np.ndarray:
    return h * _BASE + points + np.uint64(1)


class Lattice:
    """Marginal probability of a word over all its segmentations into pieces.

    The weights are natural logarithms; a piece's place is its place in `pieces`, then come the 256 bytes and the end piece.
    """

    def __init__(self, pieces: dict[str, float], byte: dict[int, float], end: float):
        self.places = {p: i for i, p in enumerate(pieces)}
        self.logs = np.array([*pieces.values(), *(byte.get(b, -math.inf) for b in range(256)), end])
        self.starts = {p[:i] for p in pieces for i in range(1, len(p) + 1)}
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by length: sorted hashes, places
        for n in sorted({len(p) for p in pieces}):
            some = [p for p in pieces if len(p) == n]
            h = np.zeros(len(some), np.uint64)
            for points in np.array(some, f"U{n}").view(np.uint32).reshape(len(some), n).T.astype(np.uint64):
                h = _rolled(h, points)
            at = np.argsort(h)
            self.tables[n] = h[at], np.array([self.places[p] for p in some])[at]

    def _bytes_of(self, char: str) -> list[int]:
        return [len(self.places) + b for b in char.encode("utf-8", "replace")]

    def _arcs(self, s: str) -> Iterator[tuple[int, int, list[int]]]:
        """(from, to, places) of all arcs of a marked word, by their beginnings."""
        for i in range(len(s)):
            if s[i] not in self.places:
                yield i, i + 1, self._bytes_of(s[i])
            j = i + 1
            while j <= len(s) and s[i:j] in self.starts:
                if s[i:j] in self.places:
                    yield i, j, [self.places[s[i:j]]]
                j += 1

    def _one(self, s: str, counts: np.ndarray | None) -> float:
        arcs = [(i, j, where, float(self.logs[where].sum())) for i, j, where in self._arcs(s)]
        forward, backward = ([-math.inf] * len(s) + [0.0] for _ in range(2))
        forward[0], forward[len(s)] = 0.0, -math.inf if s else 0.0
        plus = lambda a, b: a if b == -math.inf else b if a == -math.inf else max(a, b) + math.log1p(math.exp(-abs(a - b)))
        for i, j, _, p in arcs:
            forward[j] = plus(forward[j], forward[i] + p)
        if counts is not None:
            for i, j, _, p in reversed(arcs):
                backward[i] = plus(backward[i], p + backward[j])
            for i, j, where, p in arcs:
                np.add.at(counts, where, math.exp(forward[i] + p + backward[j] - forward[-1]))
        return forward[-1]

    def _many(self, marked: list[str], n: int, counts: np.ndarray | None) -> np.ndarray:
        """The recursions for words of n characters together."""
        points = np.array(marked, f"U{n}").view(np.uint32).reshape(len(marked), n).T
        wide = points.astype(np.uint64)
        forward = np.full((n + 1, len(marked)), -np.inf)
        forward[0] = 0.0
        arcs = []  # (from, to, which words, places, weights)
        for i in range(n):
            h = np.zeros(len(marked), np.uint64)
            for size in range(1, min(n - i, max(self.tables, default=0)) + 1):
                h = _rolled(h, wide[i + size - 1])
                if size not in self.tables:
                    if size > 1:
                        continue
                    hit, place = np.zeros(len(marked), bool), np.zeros(len(marked), np.int64)
                else:
                    known, places = self.tables[size]
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    hit, place = known[at] == h, places[at]
                who = np.flatnonzero(hit)
                if len(who):
                    arcs.append((i, i + size, who, place[who], self.logs[place[who]]))
                if size == 1 and not hit.all():
                    for char in np.unique(points[i][~hit]).tolist():
                        who = np.flatnonzero(~hit & (points[i] == char))
                        spelled = self._bytes_of(chr(char))
                        arcs.append((i, i + 1, who, spelled, np.full(len(who), self.logs[spelled].sum())))
            for i_, j, who, _, p in reversed(arcs):
                if i_ != i:
                    break
                forward[j, who] = np.logaddexp(forward[j, who], forward[i, who] + p)
        if counts is not None:
            backward = np.full((n + 1, len(marked)), -np.inf)
            backward[n] = 0.0
            for i, j, who, places, p in reversed(arcs):
                through = p + backward[j, who]
                backward[i, who] = np.logaddexp(backward[i, who], through)
                expected = np.exp(forward[i, who] + through - forward[n, who])
                if isinstance(places, list):
                    np.add.at(counts, places, expected.sum())
                else:
                    counts += np.bincount(places, expected, len(counts))
        return forward[n]

    def log_probabilities(self, some: list[str], counts: np.ndarray | None = None) -> np.ndarray:
        """Natural logarithms; the empty word is the end piece alone. counts: takes the expected uses of the pieces."""
        out = np.zeros(len(some))
        by_size: dict[int, list[int]] = {}
        for k, w in enumerate(some):
            by_size.setdefault(len(w), []).append(k)
        for size, which in by_size.items():
            if size > LONG:
                for k in which:
                    out[k] = self._one(MARK + some[k], counts)
            elif size:
                step = max(1, TOGETHER // (size * min(size, 16)))
                for lo in range(0, len(which), step):
                    part = which[lo : lo + step]
                    out[part] = self._many([MARK + some[k] for k in part], size + 1, counts)
        if counts is not None:
            counts[-1] += len(some)
        return out + self.logs[-1]

    def log_probability(self, word: str) -> float:
        return float(self.log_probabilities([word])[0])

    def fitted(self, counts: np.ndarray, smooth: float = SMOOTH) -> Lattice:
        """The same pieces with weights by expected counts."""
        usable = np.isfinite(self.logs)
        logs = np.log(np.where(usable, counts + smooth, 1.0) / (counts[usable] + smooth).sum()).tolist()
        n = len(self.places)
        return Lattice(dict(zip(self.places, logs[:n], strict=True)), {b: logs[n + b] for b in range(256) if usable[n + b]}, logs[-1])


def _text(words_: list[bytes]) -> list[str]:
    return [w.decode("utf-8", "replace") for w in words_]


def _expected(batches: Iterator[pa.RecordBatch], lattice: Lattice) -> Iterator[pa.RecordBatch]:
    """(place, n): expected uses of the pieces over the distinct words."""
    n = np.zeros(len(lattice.logs))
    for b in batches:
        lattice.log_probabilities(_text(b.column("word").to_pylist()), n)
    some = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["place", "n"])


def word_logs(lattice: Lattice, some: list[str], c: np.ndarray, n: int, new: float, discount: float) -> np.ndarray:
    """log10 of the marginals of words with training counts c among n tokens; new: the weight of the escape."""
    whole = np.maximum(c - discount, 0.0) / max(n, 1) * (c > 0)
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log(whole), math.log(new) + lattice.log_probabilities(some)) / math.log(10)


def _lattice_scores(batches: Iterator[pa.RecordBatch], lattice: Lattice, n: int, new: float, discount: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        p = word_logs(lattice, _text(b.column("word").to_pylist()), b.column("c").to_numpy(), n, new, discount)
        yield pa.RecordBatch.from_arrays([b.column("word"), b.column("c"), b.column("every"), pa.array(p, pa.float64())], names=["word", "c", "every", "model"])


def _scored(batches: Iterator[pa.RecordBatch], head, folds: int, held: int) -> Iterator[pa.RecordBatch]:
    """Documents -> a row (doc, doc_id, ...) of what frequent words give, and rows (doc, word, n) of the other words."""
    names = ["doc", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "word", "n"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64()]
    table, base, model, known = head.value
    place, at = {w: i for i, w in enumerate(table)}.get, TaskContext.get().partitionId() << 36
    for b in batches:
        rows = []
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            at += 1
            w = words(text)
            w.append(END)
            i = np.fromiter((place(x, -1) for x in w), np.int64, len(w))
            rest = Counter(w[k] for k in np.flatnonzero(i < 0).tolist())
            i = i[i >= 0]
            rows.append((at, doc_id, is_held_out(doc_id, folds, held), len(w), int(known[i].sum()), float(base[i].sum()), float(model[i].sum()), None, None))
            rows += [(at, None, None, None, None, None, None, x, n) for x, n in rest.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*zip(*rows, strict=True)] or [[]] * len(names), kinds, strict=True)], names=names)


def learned(counts: DataFrame, model: str, rounds: int = ROUNDS) -> Lattice:
    """The lattice of a vocabulary with weights fitted to the distinct training words of counts (word, c)."""
    lattice = Lattice(*vocabulary(model))
    taught = counts.filter("c > 0 and octet_length(word) > 0").select("word")
    for _ in range(rounds):
        found = taught.mapInArrow(partial(_expected, lattice=lattice), "place long, n double").groupBy("place").agg(F.sum(F.round("n", 6).cast("decimal(38,6)")).cast("double").alias("n"))
        n = np.zeros(len(lattice.logs))
        for r in found.collect():  # at most one row a piece
            n[r["place"]] = r["n"]
        lattice = lattice.fitted(n)
    return lattice


def score(docs: DataFrame, model: str | None = None, folds: int = FOLDS, held: int = HELD, head_size: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities) of every document."""
    import public_tokenizers

    spark = docs.sparkSession
    model = model or public_tokenizers.path("piece_bpe_32k.model")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = rows.mapInArrow(partial(_counts, folds=folds, held=held), "word binary, c long, every long")
    counts = stored(counts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("every").alias("every")))
    release(spark)
    facts = counts.filter("c > 0").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).first()
    n, v = facts["n"] or 0, facts["v"]
    discount = facts["n1"] / (facts["n1"] + 2 * facts["n2"]) if facts["n1"] else 0.5
    new = discount * v / n if n else 1.0

    scored = partial(_lattice_scores, lattice=learned(counts, model), n=n, new=new, discount=discount)
    known = stored(counts.mapInArrow(scored, "word binary, c long, every long, model double"))
    discard(counts)

    base = F.log10((F.col("c") + 1) / F.lit(float(n + v + 1)))
    values = known.select("word", base.alias("base"), "model", (F.col("c") > 0).cast("long").alias("known"), F.floor(F.log2("every") * 16).cast("int").alias("size"))

    sizes = values.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("size")).collect()
    least, held_words = None, 0
    for r in sizes:
        held_words += r["n"]
        if held_words > head_size:
            break
        least = r["size"]
    frequent = F.lit(False) if least is None else F.col("size") >= least
    top = values.filter(frequent).select("word", "base", "model", "known").collect()
    head = spark.sparkContext.broadcast(([bytes(r["word"]) for r in top], np.array([r["base"] for r in top], float), np.array([r["model"] for r in top], float), np.array([r["known"] for r in top], np.int64)))

    schema = "doc long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, word binary, n long"
    parts = stored(rows.mapInArrow(partial(_scored, head=head, folds=folds, held=held), schema))
    release(spark)
    rest = parts.filter("word is not null").select("doc", "word", "n").join(values.filter(~frequent), "word")
    n_ = F.col("n")
    rest = rest.groupBy("doc").agg(F.sum(n_ * F.col("known")).alias("more_known"), F.sum(n_ * F.col("base")).alias("more_base"), F.sum(n_ * F.col("model")).alias("more_model"))
    whole = parts.filter("word is null").drop("word", "n").join(rest, "doc", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return whole.select("doc_id", "held_out", "n_tokens", plus("n_known", "more_known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), plus("base", "more_base").alias("base_score"), plus("model", "more_model").alias("score"))
