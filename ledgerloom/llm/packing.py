"""Pack documents into fixed-length token sequences along a Hilbert curve through document space.

Every document becomes a hashed vector of its byte 4-grams (256 buckets, square roots, unit length), a fixed random
projection takes it to four dimensions, and its Hilbert index on a 2^15 grid is the sort key. Documents are
range-partitioned by (key, doc_id) and cut into sequences in that order, so neighbours on the curve share sequences.
Copies of one text have one key; doc_id after the key lets the ranges split them, so a hot group is no hot task.

A range's tokens are cut every `length` tokens. What remains at a range's end is cut at powers of two (700 = 512 + 128
+ 32 + 16 + 8 + 4), so nothing is padded. One sequence, at most, is held in memory besides the batch.

Defined cases: a null or empty text is the end token alone; rows that repeat a doc_id are documents of their own; a
null doc_id is carried as null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import shuffle_partitions, stored

LENGTH = 1024
BUCKETS, DIMS, BITS = 256, 4, 15
#: Bytes of ids that are sent together.
SENT = 8 << 20
#: Entries of a worker's memory of encoded chunks; it starts anew when full.
REMEMBERED = 500_000
SPECIAL = "<|endoftext|>"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def hilbert(coords: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert indices of integer points (n, dims) on a grid of 2**bits a side; bits * dims below 64."""
    x = [c.astype(np.uint64) for c in coords.T]
    one, zero = np.uint64(1), np.uint64(0)
    for b in range(bits - 1, 0, -1):  # undo the curve's turns, from the coarsest cell down
        q = np.uint64(1 << b)
        low = np.uint64((1 << b) - 1)
        for d in range(len(x)):
            on = (x[d] & q) != zero
            swap = np.where(on, zero, (x[0] ^ x[d]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] = x[d] ^ swap
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> np.uint64(b)) & one != zero, flip ^ np.uint64((1 << b) - 1), flip)
    x = [c ^ flip for c in x]
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << one) | ((c >> np.uint64(b)) & one)
    return key.astype(np.int64)


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    r = np.random.RandomState(20240229).standard_normal((BUCKETS, DIMS))
    return r / np.linalg.norm(r, axis=0)


def curve_keys(texts: list[bytes]) -> np.ndarray:
    """Hilbert keys of documents; texts with the same bytes have the same key."""
    ends = np.cumsum([len(t) for t in texts])
    counts = np.zeros((len(texts), BUCKETS))
    whole = np.frombuffer(b"".join(texts), dtype=np.uint8)
    at = 0
    while at < len(texts):  # a few MB at a time
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (4 << 20))))
        lo, hi = (ends[at - 1] if at else 0), ends[stop - 1]
        a = whole[lo:hi].astype(np.uint32)
        if len(a) >= 4:
            gram = a[:-3] | (a[1:-2] << np.uint32(8)) | (a[2:-1] << np.uint32(16)) | (a[3:] << np.uint32(24))
            bucket = (gram * np.uint32(2654435761)) >> np.uint32(24)
            doc = np.repeat(np.arange(stop - at, dtype=np.uint32), np.diff(np.concatenate(([lo], ends[at:stop]))))
            inside = doc[:-3] == doc[3:]
            code = (doc[:-3][inside] << np.uint32(8)) | bucket[inside]
            counts[at:stop] = np.bincount(code, minlength=(stop - at) * BUCKETS).reshape(-1, BUCKETS)
        at = stop
    v = np.sqrt(counts)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    z = np.clip((np.round(v @ _projection(), 9) + 1) * (1 << (BITS - 1)), 0, (1 << BITS) - 1)
    return hilbert(z.astype(np.int64))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(curve_keys(texts), pa.int64())], names=["doc_id", "text", "curve_key"])


class ChunkEncoder:
    """Token ids of whole texts by a byte-level BPE vocabulary, as little-endian 32-bit integers.

    The vocabulary's splitting pattern never splits inside " word" at a single space before a non-space, so a text is
    cut there and the ids of the chunks are remembered. Texts with other runs of white space are encoded whole.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})
        self.known: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        """The special token's text is the special token, as the vocabulary's library has it by default."""
        if SPECIAL in text:
            return np.array(self.encoding.encode(text, allowed_special="all"), dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        ids = [*map(self.known.get, rest)]
        if None in ids:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            for i, x in enumerate(ids):
                if x is None:
                    part = rest[i]
                    if not part or part[0].isspace():
                        return self.plain(text)
                    ids[i] = self.known[part] = self.plain(" " + part)
        return (self.plain(first) if first else b"") + b"".join(ids)


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> ChunkEncoder:
    return ChunkEncoder(vocabulary)


class Packer:
    """Cuts a stream of documents into sequences; rows of finished sequences gather in `rows`."""

    def __init__(self, length: int, first_sequence: int):
        self.length, self.sequence, self.room, self.open, self.rows, self.size = length, first_sequence, length, [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while at < total:
            n = min(self.room, total - at)
            self.open.append((doc_id, at, ids[4 * at : 4 * (at + n)], total))
            at += n
            self.room -= n
            if not self.room:
                self.close(self.open)
                self.open, self.room = [], self.length

    def close(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, total, self.sequence, offset, ids))
            offset += n
        self.sequence += 1
        self.size += 4 * offset

    def finish(self) -> None:
        left, rest = self.length - self.room, self.open
        for b in range(left.bit_length() - 1, -1, -1):
            if left >> b & 1:
                part, need = [], 1 << b
                while need:
                    doc_id, start, ids, total = rest[0]
                    n = min(need, len(ids) // 4)
                    part.append((doc_id, start, ids[: 4 * n], total))
                    rest = [(doc_id, start + n, ids[4 * n :], total), *rest[1:]] if 4 * n < len(ids) else rest[1:]
                    need -= n
                self.close(part)

    def flush(self) -> pa.RecordBatch:
        columns = [*zip(*self.rows, strict=True)] or [[]] * 7
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.binary())], names=[x.split()[0] for x in PIECES.split(", ")])


def _packed(batches: Iterator[pa.RecordBatch], length: int, vocabulary: str, end_id: int) -> Iterator[pa.RecordBatch]:
    packer, encode, end = Packer(length, TaskContext.get().partitionId() << 40), encoder(vocabulary), int(end_id).to_bytes(4, "little")
    for b in batches:
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            packer.add(doc_id, encode(text or "") + end)
            if packer.rows and packer.size >= SENT:
                yield packer.flush()
        yield packer.flush()
    packer.finish()
    yield packer.flush()


def along_curve(docs: DataFrame) -> DataFrame:
    """doc_id, text and curve_key, range-partitioned and sorted along the curve."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_keyed, "doc_id long, text string, curve_key long")
    keyed = stored(keyed)  # finding the ranges reads the keys before the rows are dealt
    return keyed.repartitionByRange(shuffle_partitions(docs.sparkSession), "curve_key", "doc_id").sortWithinPartitions("curve_key", "doc_id", F.xxhash64("text"))


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    vocabulary: a byte-level BPE rank file; length: tokens of a sequence, a power of two.
    """
    import public_tokenizers

    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return along_curve(docs).select("doc_id", "text").mapInArrow(partial(_packed, length=length, vocabulary=vocabulary, end_id=end_id), PIECES)


def with_crc(pieces: DataFrame) -> DataFrame:
    """pack()'s rows with ids_crc32, the check sum of the ids' bytes."""
    return pieces.withColumn("ids_crc32", F.crc32("ids"))
