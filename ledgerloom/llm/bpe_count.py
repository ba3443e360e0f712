"""Token counts by heap-and-linked-list byte-pair merging.

A chunk's symbols form a linked list, its adjacent pairs that are pieces a heap by (rank, place); the lowest pair is
popped and merged until none is left. The count is the initial symbols minus the merges; no identifier is made. A
character that is no piece counts its UTF-8 bytes, which never merge.

No piece holds the word mark after another character, or a line feed, so a text is cut into chunks before each run of
marks and at line feeds, and merges never cross the cuts. A worker remembers chunk counts, up to a bound.

Defined cases: a null or empty text has 0 bytes and 0 tokens; rows are independent, so ties, repeated rows and extra
columns change nothing; a chunk of any length costs n log n; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MARK = "▁"
#: Entries of a worker's memory of counted chunks, and the longest chunk it keeps; it starts anew when full.
REMEMBERED, LONGEST = 700_000, 64
_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class MergeCounter:
    """Counts tokens under a piece vocabulary: {piece: rank}, lower ranks merge first."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.alone = {p for p in ranks if len(p) == 1}
        self.known: dict[str, int] = {}  # of chunks after one mark, without it
        self.other: dict[str, int] = {}  # of chunks as they are

    @classmethod
    def of_model(cls, path: str) -> MergeCounter:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = (i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
        return cls({sp.id_to_piece(i): int(-sp.get_score(i)) for i in plain})

    def merged(self, chunk: str) -> int:
        """Tokens of one chunk."""
        rank, symbols, n = self.ranks.get, [*chunk], len(chunk)
        heap = []
        for i in range(n - 1):
            r = rank(chunk[i : i + 2])
            if r is not None:
                heap.append(r * n + i)
        heapify(heap)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        merges = 0
        while heap:
            r, i = divmod(heappop(heap), n)
            j = after[i]
            if j >= n or not symbols[i]:
                continue
            both = symbols[i] + symbols[j]
            if rank(both) != r:
                continue  # one of the two has merged since
            symbols[i], symbols[j] = both, ""
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank(both + symbols[k])
                if r is not None:
                    heappush(heap, r * n + i)
            h = before[i]
            if h >= 0:
                r = rank(symbols[h] + both)
                if r is not None:
                    heappush(heap, r * n + h)
        if self.alone.issuperset(chunk):
            return n - merges
        return n - merges + sum(len(s.encode()) - 1 for s in symbols if len(s) == 1 and s not in self.alone)

    def _one(self, chunk: str) -> int:
        n = self.other.get(chunk)
        if n is None:
            n = self.merged(chunk)
            if len(chunk) <= LONGEST:
                if len(self.other) > REMEMBERED // 4:
                    self.other.clear()
                self.other[chunk] = n
        return n

    def _lines(self, chunk: str) -> int:
        """Tokens of a chunk that may hold line feeds: each of them is one token, its byte."""
        parts = chunk.split("\n")
        return len(parts) - 1 + sum(self._one(p) for p in parts if p)

    def count(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")
        if "" in words:
            return sum(map(self._lines, _RUNS.findall(MARK + MARK.join(words))))
        counts = [*map(self.known.get, words)]
        if None in counts:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            for i, n in enumerate(counts):
                if n is None:
                    w = words[i]
                    counts[i] = n = self._lines(MARK + w)
                    if len(w) <= LONGEST:
                        self.known[w] = n
        return sum(counts)


@lru_cache(maxsize=2)
def counter(model: str) -> MergeCounter:
    return MergeCounter.of_model(model)


def _counted(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    count = counter(model).count
    for b in batches:
        texts = b.column("text").to_pylist()
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array([count(t or "") for t in texts], pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, model: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document. model: a piece model file with byte fallback."""
    import public_tokenizers

    model = model or public_tokenizers.path("piece_bpe_32k.model")
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(partial(_counted, model=model), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
