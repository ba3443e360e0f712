"""Remove byte strings of a fixed length that an earlier document has, by a logarithmic family of sparse suffix arrays.

A window is `WINDOW` bytes of a text. Each window has an anchor, the place of its least hashed 20-byte string; equal
windows have equal anchors. Consecutive windows with one anchor form a segment, and the segment's suffix from the
anchor on (at most WINDOW bytes, with what is before the anchor as the tie) is what suffix arrays order: one suffix for
about sixteen bytes of text instead of one a byte, and every window is in exactly one segment.

`SuffixFamily` keeps an index in the shared folder. Its levels are suffix arrays dealt to buckets by anchor, a Parquet
folder each. `add(docs)` takes a batch of documents:

1. A few MB of documents are a pack, written once with its segments. A pack sends four bytes of each distinct anchor's
   hash to the anchor's bucket, which answers which of them another segment of the new or the older packs has. Only
   segments with a shared anchor go on; those of older packs when their anchor is shared for the first time.
2. A bucket merges what the packs send into the new batch's suffix array and settles segments that are equal as a whole:
   those of later documents are removed and leave the index, so any number of copies is one entry.
3. The new array is merge-scanned against every level for matches of a window at least. Within a merged order, runs of
   a common prefix after the anchor and runs of a common ending before it tell equal windows, so none is compared twice.
4. The array becomes a level of rank 0; as long as two levels have one rank they are merged to one of the next rank. So
   a family of n batches has at most log2(n) + 1 levels, and an entry is rewritten as often at most.

`removed()` joins what all scans found and cuts the documents. No text is sent to the driver and no pairs are made. An
anchor that more than `HOT` packs have is dealt by 35 bytes, the anchor with 15 bytes after it or with 15 before, as
each of its windows has one of the two; so a frequent string in ever new surroundings is spread.

Defined cases: a null text is empty; texts shorter than a window keep everything; a string repeated within one document
stays; rows with one doc_id are no earlier than each other; a null doc_id is before all others; very long texts are
worked through `CHUNK` bytes at a time; an empty table or batch gives no rows; other columns are ignored. A family has
any number of batches; a task with more than 2^14 packs (64 GB of text), or 2^43 packs in all, are an OverflowError, and
a single document of 2 GB or more is beyond what a binary value of Spark holds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_batches, discard, release, shuffle_partitions, stored
from ledgerloom.sources.shared import shared_root

WINDOW, ANCHOR = 50, 20
#: Places of an anchor in a window, and the longest segment and what of it may stand before the anchor.
PLACES = WINDOW - ANCHOR + 1
LONGEST, BEFORE = WINDOW + PLACES - 1, PLACES - 1
#: Bytes of text in a pack, bits of a row's place in it, and buckets of a shuffle partition.
PACK, PLACE_BITS, BUCKETS = 4 << 20, 20, 8
#: Bits of a pack's place among those of its task.
TASK_BITS = 14
#: Packs that have an anchor above which it is dealt with its surroundings, and the bytes of these.
HOT, AROUND = 4096, BEFORE // 2
#: Places that are hashed at a time, and entries that are made at a time.
CHUNK, TOGETHER = 1 << 17, 1 << 18
#: Bytes of an Arrow batch; the compression of entries, which are most of what is shuffled.
BATCH, SQUEEZE = 8 << 20, 6
#: Batches that the query's whole table is added in.
PARTS = 2
FIRST_ID = -(1 << 63)

#: One row for each segment: the order (suffix, then what is before the anchor, reversed), lengths, and where it is.
ENTRY = np.dtype([("key", f"S{LONGEST}"), ("right", "u1"), ("left", "u1"), ("doc", "<i8"), ("row", "<i8"), ("start", "<i8")])
#: One row for each removed run of windows. A row number is the pack and the place in it.
RUN = np.dtype([("row", "<i8"), ("start", "<i8"), ("n", "<i8")])
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _hashed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Hash of 20-byte strings: their two first 8 bytes and the last 4 as numbers."""
    x = a * _MULTIPLIERS[0]
    x += b * _MULTIPLIERS[1]
    x += c.astype(np.uint64) * _MULTIPLIERS[2]
    return _mixed(x)


def _words(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts of the 20-byte strings at each place; raw is ANCHOR bytes longer than n."""
    return np.ndarray((n,), "<u8", raw, 0, (1,)), np.ndarray((n,), "<u8", raw, 8, (1,)), np.ndarray((n,), "<u4", raw, 16, (1,))


def segments(raw: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of joined documents, in order: their first window's place, windows, and bytes before the anchor."""
    n, ends = len(raw), np.cumsum(lengths)
    begins = ends - lengths
    out = []
    words = _words(raw + bytes(2 * LONGEST), n + LONGEST)
    fits = np.ones(n, bool)  # windows that stay inside their document
    for a, z in zip(np.maximum(begins, ends - WINDOW + 1).tolist(), ends.tolist(), strict=True):
        fits[a:z] = False
    for lo in range(0, n, CHUNK):
        inside = fits[lo : lo + CHUNK]
        m = len(inside)
        h = _hashed(*(w[lo : lo + m + PLACES - 1] for w in words))
        least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while 2 * span <= PLACES:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < PLACES:
            least = np.minimum(least[: len(least) - (PLACES - span)], least[PLACES - span :])
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        apart = np.ones(m + 1, bool)  # a segment ends before such a place
        apart[1:m] = (anchor[1:] != anchor[:-1]) | ~inside[:-1] | ~inside[1:]
        first = np.flatnonzero(inside & apart[:-1])
        last = np.flatnonzero(inside & apart[1:])
        out.append((first + lo, (last - first + 1).astype(np.uint8), (anchor[first] - first).astype(np.uint8)))
    kinds = (np.int64, np.uint8, np.uint8)
    return tuple(np.concatenate([o[k] for o in out]) if out else np.zeros(0, kinds[k]) for k in range(3))


def anchor_hashes(raw: bytes, at: np.ndarray) -> np.ndarray:
    """Hashes of the 20-byte strings at some places."""
    return _hashed(*(w[at] for w in _words(raw + bytes(2 * LONGEST), len(raw))))


def entries(raw: bytes, lengths: np.ndarray, docs: np.ndarray, rows: np.ndarray, first: np.ndarray, count: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Entries of some segments of joined documents (their lengths, doc_ids and row numbers), unsorted."""
    begins = np.cumsum(lengths) - lengths
    some = np.flatnonzero(lengths)
    of = some[np.searchsorted(begins[some], first, side="right") - 1] if len(some) else np.zeros(0, np.int64)
    out = np.zeros(len(first), ENTRY)
    right = count.astype(np.int64) - 1 + WINDOW - left
    around = np.lib.stride_tricks.sliding_window_view(np.frombuffer(bytes(BEFORE) + raw + bytes(LONGEST), np.uint8), LONGEST)[first + left]
    key = np.empty((len(first), LONGEST), np.uint8)
    key[:, :WINDOW] = np.where(np.arange(WINDOW) < right[:, None], around[:, BEFORE:], 0)
    key[:, WINDOW:] = np.where(np.arange(BEFORE) < left[:, None], around[:, :BEFORE][:, ::-1], 0)
    out["key"] = key.view(f"S{LONGEST}").ravel()
    out["right"], out["left"], out["start"] = right, left, first - begins[of]
    out["doc"], out["row"] = docs[of], rows[of]
    return out


def _bytes(key: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(key).view(np.uint8).reshape(len(key), width)


def settle(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted entries, which are equal as a whole to one of an earlier document, and the runs of these."""
    late = np.zeros(len(e), bool)
    if len(e) > 1:
        same = (e["key"][1:] == e["key"][:-1]) & (e["right"][1:] == e["right"][:-1]) & (e["left"][1:] == e["left"][:-1])
        starts = np.flatnonzero(np.concatenate(([True], ~same)))
        late = e["doc"] > np.repeat(np.minimum.reduceat(e["doc"], starts), np.diff(np.append(starts, len(e))))
    gone = e[late]
    runs = np.zeros(len(gone), RUN)
    runs["row"], runs["start"] = gone["row"], gone["start"]
    runs["n"] = gone["left"].astype(np.int64) + gone["right"] - WINDOW + 1
    return late, runs


def order(e: np.ndarray) -> np.ndarray:
    """The suffix order of entries; equal keys by their lengths. Sorted runs in the input are merged, not sorted anew."""
    at = np.argsort(e["key"], kind="stable")
    same = e["key"][at[1:]] == e["key"][at[:-1]]
    if same.any():  # within equal keys
        group = np.cumsum(np.concatenate(([0], ~same)))
        twin = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
        some = at[twin]
        at[twin] = some[np.lexsort((e["left"][some], e["right"][some], group[twin]))]
    return at


def merged(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One suffix array of several, without entries that are equal to an earlier document's, and these entries' runs."""
    e = np.concatenate(arrays) if arrays else np.zeros(0, ENTRY)
    e = e[order(e)]
    late, runs = settle(e)
    return e[~late], runs


def _common(x: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of bytes and the one before; 0 at the first."""
    out = np.zeros(len(x), np.int64)
    for i in range(1, len(x), 1 << 16):
        part = x[i - 1 : i + (1 << 16)]
        apart = part[1:] != part[:-1]
        out[i : i + len(apart)] = np.where(apart.any(axis=1), apart.argmax(axis=1), x.shape[1])
    return out


def scan(e: np.ndarray) -> np.ndarray:
    """Runs of removed windows of sorted entries that share a window with an earlier document's entry.

    A window with `a` bytes before the anchor equals another if both agree in 50 - a bytes from the anchor on, which in
    suffix order are runs of such a common prefix, and in a bytes before it, which are runs in the order of the anchor
    and what is before it. A window's class is its pair of runs.
    """
    if len(e) < 2:
        return np.zeros(0, RUN)
    key = _bytes(e["key"], LONGEST)
    after = _common(key[:, :WINDOW])
    back = np.ascontiguousarray(np.concatenate((key[:, :ANCHOR], key[:, WINDOW:]), axis=1))
    by_back = np.argsort(back.view(f"S{ANCHOR + BEFORE}").ravel(), kind="stable")
    before = _common(back[by_back]) - ANCHOR  # below 0: another anchor
    best = lambda c: np.maximum(c, np.append(c[1:], -ANCHOR))
    low = WINDOW - np.minimum(best(after), e["right"])
    high = np.empty(len(e), np.int64)
    high[by_back] = best(before)
    high = np.minimum(high, e["left"])
    out = []
    back_run = np.empty(len(e), np.int64)
    for a in range(PLACES):
        some = np.flatnonzero((low <= a) & (a <= high))
        if len(some) < 2:
            continue
        back_run[by_back] = np.cumsum(before < a)
        group = np.cumsum(after < WINDOW - a)[some] * (len(e) + 1) + back_run[some]
        at = np.argsort(group)
        group, doc = group[at], e["doc"][some[at]]
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        who = some[at[doc > np.repeat(np.minimum.reduceat(doc, starts), np.diff(np.append(starts, len(doc))))]]
        runs = np.zeros(len(who), RUN)
        runs["row"], runs["start"], runs["n"] = e["row"][who], e["start"][who] + e["left"][who] - a, 1
        out.append(runs)
    return joined(np.concatenate(out)) if out else np.zeros(0, RUN)


def scan_against(new: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a new suffix array and a level: which entries leave each, and the runs that both together remove."""
    gone_new, gone_level = np.zeros(len(new), bool), np.zeros(len(level), bool)
    start = lambda e: _bytes(e["key"], LONGEST)[:, :8].copy().view(">u8").ravel().astype(np.uint64)
    a, b = start(new), start(level)
    if not len(a) or not len(b):
        return gone_new, gone_level, np.zeros(0, RUN)
    meets = lambda x, y: y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
    mine, theirs = np.flatnonzero(meets(a, b)), np.flatnonzero(meets(b, a))
    both = np.concatenate((new[mine], level[theirs]))
    at = order(both)
    late, runs = settle(both[at])
    gone = at[late]
    gone_new[mine[gone[gone < len(mine)]]] = True
    gone_level[theirs[gone[gone >= len(mine)] - len(mine)]] = True
    return gone_new, gone_level, np.concatenate((runs, scan(both[at][~late])))


def joined(runs: np.ndarray) -> np.ndarray:
    """Runs of windows in order, those that touch made one."""
    if len(runs) < 2:
        return runs
    runs = runs[np.lexsort((runs["start"], runs["row"]))]
    end = runs["start"] + runs["n"]
    new_row = np.concatenate(([True], runs["row"][1:] != runs["row"][:-1]))
    # the furthest end so far within a row: ends are lifted by a step for each row, so one running maximum does for all
    lift = (np.cumsum(new_row) - 1) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    starts = np.flatnonzero(new_row | np.concatenate(([True], runs["start"][1:] > reach[:-1])))
    out = runs[starts]
    out["n"] = reach[np.append(starts[1:], len(runs)) - 1] - out["start"]
    return out


class NewArray:
    """The new batch's suffix array in one bucket; what the packs send is merged in geometrically growing runs."""

    def __init__(self) -> None:
        self.arrays: list[np.ndarray] = []
        self.runs: list[np.ndarray] = []

    def _merge(self) -> None:
        b, a = self.arrays.pop(), self.arrays.pop()
        e, runs = merged([a, b])
        self.arrays.append(e)
        self.runs.append(runs)

    def add(self, array: np.ndarray) -> None:
        self.arrays.append(array)
        while len(self.arrays) > 1 and len(self.arrays[-1]) >= len(self.arrays[-2]):
            self._merge()

    def finish(self) -> np.ndarray:
        while len(self.arrays) > 1:
            self._merge()
        return self.arrays[0] if self.arrays else np.zeros(0, ENTRY)


def extend(new: np.ndarray, levels: list[tuple[int, np.ndarray]], merge: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The new array scanned against levels (rank, array): what replaces it and the levels of rank below `merge`, and runs."""
    runs = [scan(new)]
    gone = np.zeros(len(new), bool)
    left = []
    for rank, level in levels:
        late, gone_level, found = scan_against(new, level)
        gone |= late
        runs.append(found)
        if rank < merge:
            left.append(level[~gone_level])
    e, more = merged([new[~gone], *left]) if left else (new[~gone], np.zeros(0, RUN))
    return e, [*runs, more]


def _columns(rows: np.ndarray) -> bytes:
    """Column by column; numbers by the place of their bytes, as the high ones hardly differ."""
    return b"".join(np.ascontiguousarray(rows[c]).tobytes() if rows.dtype[c].kind == "S" else _bytes(rows[c], rows.dtype[c].itemsize).T.tobytes() for c in rows.dtype.names)


def _by_pack(runs: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(pack, packed runs) of joined runs."""
    pack = runs["row"] >> PLACE_BITS
    z = zstandard.ZstdCompressor(level=1)
    for k, a, b in _parts(pack):
        yield k, z.compress(_columns(runs[a:b]))


def _unpacked(value: bytes, kind: np.dtype) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(value)
    n = len(raw) // kind.itemsize
    out, at = np.zeros(n, kind), 0
    for c in kind.names:
        width = kind[c].itemsize
        if kind[c].kind == "S":
            out[c] = np.frombuffer(raw, kind[c], n, at)
        else:
            out[c] = np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).view(kind[c]).ravel()
        at += n * width
    return out


def _sent(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*zip(*rows, strict=True)] or [[]] * len(schema), schema.types, strict=True)], schema=schema)


def _parts(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, from, to) of a sorted array."""
    if len(sorted_keys):
        starts = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
        yield from zip(sorted_keys[starts].tolist(), starts.tolist(), np.append(starts[1:], len(sorted_keys)).tolist(), strict=True)


class Pack:
    """Some documents and their segments as one compressed value."""

    def __init__(self, pack: int, value: bytes):
        raw = memoryview(zstandard.ZstdDecompressor().decompress(value))
        n, m, size = np.frombuffer(raw, "<i8", 3).tolist()
        at = 24
        self.known = np.frombuffer(raw, np.uint8, n, at).astype(bool)
        self.ids = np.frombuffer(raw, "<i8", n, at + n)
        self.lengths = np.frombuffer(raw, "<i8", n, at + 9 * n)
        at += 17 * n
        self.raw = bytes(raw[at : at + size])
        self.count, self.left = np.frombuffer(raw, np.uint8, m, at + size), np.frombuffer(raw, np.uint8, m, at + size + m)
        self.rows = (pack << PLACE_BITS) + np.arange(n)

    @staticmethod
    def value(held: list[tuple[int | None, bytes]], raw: bytes, lengths: np.ndarray, count: np.ndarray, left: np.ndarray) -> bytes:
        known = np.array([d is not None for d, _ in held], np.uint8)
        ids = np.array([FIRST_ID if d is None else d for d, _ in held], "<i8")
        head = np.array([len(held), len(count), len(raw)], "<i8")
        return zstandard.ZstdCompressor(level=3).compress(b"".join([head.tobytes(), known.tobytes(), ids.tobytes(), lengths.astype("<i8").tobytes(), raw, count.tobytes(), left.tobytes()]))

    def firsts(self) -> np.ndarray:
        """The places of the segments' first windows: a document's segments hold its windows without a gap."""
        windows = np.maximum(self.lengths - WINDOW + 1, 0)
        upto, begins = np.cumsum(windows), np.cumsum(self.lengths) - self.lengths
        number = np.cumsum(self.count.astype(np.int64)) - self.count
        of = np.searchsorted(upto, number, side="right")
        return begins[of] + number - (upto[of] - windows[of])

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        at = 0
        for known, d, row, n in zip(self.known.tolist(), self.ids.tolist(), self.rows.tolist(), self.lengths.tolist(), strict=True):
            yield d if known else None, row, self.raw[at : at + n]
            at += n


def _codes(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of an anchor, and four bytes of its hash: the high bits are small in every least hash."""
    return ((_mixed(anchor) % np.uint64(buckets)) << np.uint64(32)) | (anchor >> np.uint64(20) & np.uint64(0xFFFFFFFF))


def _packs(batches: Iterator[pa.RecordBatch], first_pack: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Documents (doc_id, raw) -> (pack, asks, value, hashes): a row with the pack's value, and one with what it asks.

    That is, for each bucket, the hashes of its anchors, and a bit for those that come again.
    """
    schema = pa.schema([("pack", pa.int64()), ("asks", pa.bool_()), ("value", pa.binary()), ("hashes", pa.list_(pa.struct([("bucket", pa.int64()), ("hashes", pa.binary())])))])
    base, made = first_pack + (TaskContext.get().partitionId() << TASK_BITS), 0
    held, size = [], 0

    def send() -> pa.RecordBatch:
        nonlocal held, size, made
        if made >> TASK_BITS or (base + made) >> (63 - PLACE_BITS):
            raise OverflowError(f"a task has more than {1 << TASK_BITS} packs of {PACK} bytes, or the family more than {1 << (63 - PLACE_BITS)}: add smaller batches")
        raw, lengths = b"".join([r for _, r in held]), np.array([len(r) for _, r in held], np.int64)
        first, count, left = segments(raw, lengths)
        code, n = np.unique(_codes(anchor_hashes(raw, first + left), buckets), return_counts=True)
        hashes = [{"bucket": k, "hashes": code[a:z].astype("<u4").tobytes() + np.packbits(n[a:z] > 1).tobytes()} for k, a, z in _parts(code >> np.uint64(32))]
        rows = [(base + made, False, Pack.value(held, raw, lengths, count, left), None), (base + made, True, None, hashes)]
        made, held, size = made + 1, [], 0
        return _sent(rows, schema)

    for b in batches:
        for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("raw").to_pylist(), strict=True):
            held.append((doc_id, raw))
            size += len(raw)
            if size >= PACK or len(held) == (1 << PLACE_BITS) - 1:
                yield send()
    if held:
        yield send()


def _answers(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """(bucket, pack, old, hashes) sorted by bucket -> (pack, bucket, flags): for each hash whether to send it, and whether it is hot.

    A hash of a new pack is sent if any other segment has it, that of an older pack if none had it before, and again
    when it becomes hot. Different anchors with equal hashes are sent needlessly, no more.
    """
    schema = pa.schema([("pack", pa.int64()), ("bucket", pa.int64()), ("flags", pa.binary())])
    now, held = None, []

    def done() -> list[tuple]:
        if not any(not old for _, old, _, _ in held):
            return []
        h, sizes = np.concatenate([x for _, _, x, _ in held]), [len(x) for _, _, x, _ in held]
        old, again = np.repeat([o for _, o, _, _ in held], sizes), np.concatenate([x for _, _, _, x in held])
        at = np.argsort(h, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], h[at[1:]] != h[at[:-1]])))
        total = lambda x: np.add.reduceat(x[at].astype(np.int64), starts)
        packs, packs_old = total(np.ones(len(h))), total(old)
        shared, shared_old = packs + total(again) > 1, packs_old + total(again & old) > 1
        is_hot, was_hot = packs > hot, packs_old > hot
        every = lambda x: np.repeat(x, np.diff(np.append(starts, len(h))))
        send, heat = np.empty(len(h), bool), np.empty(len(h), bool)
        send[at] = every(shared) & ~(old[at] & every(shared_old & ~(is_hot & ~was_hot)))
        heat[at] = every(is_hot)
        rows, a = [], 0
        for (pack, _, _, _), n in zip(held, sizes, strict=True):
            if send[a : a + n].any():
                rows.append((pack, now, np.packbits(send[a : a + n]).tobytes() + np.packbits(heat[a : a + n]).tobytes()))
            a += n
        return rows

    for b in batches:
        rows = []
        for bucket, pack, old, hashes in zip(*(b.column(c).to_pylist() for c in ("bucket", "pack", "old", "hashes")), strict=True):
            if bucket != now:
                rows += done()
                now, held = bucket, []
            n = 8 * len(hashes) // 33  # 4 bytes and a bit each
            held.append((pack, old, np.frombuffer(hashes, "<u4", n), np.unpackbits(np.frombuffer(hashes, np.uint8, -1, 4 * n), count=n).astype(bool)))
        yield _sent(rows, schema)
    yield _sent(done(), schema)


def _around(e: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places among hot entries and their buckets, by the anchor and what follows, and by the anchor and what precedes."""
    key = _bytes(e["key"], LONGEST)
    out = []
    for tail, enough in ((key[:, ANCHOR : ANCHOR + AROUND], e["right"] >= ANCHOR + AROUND), (key[:, WINDOW : WINDOW + AROUND], e["left"] >= AROUND)):
        words = np.concatenate((key[:, :ANCHOR], tail, np.zeros((len(e), 5), np.uint8)), axis=1).view("<u8")
        h = np.full(len(e), len(out), np.uint64)
        for k in range(words.shape[1]):
            h = _mixed(h * _MULTIPLIERS[0] + words[:, k])
        some = np.flatnonzero(enough)
        out.append((some, (h[some] % np.uint64(buckets)).astype(np.int64)))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _entries(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(pack, value, answers) -> (key, kind, value): sorted entries by bucket; settled runs by pack."""
    schema = pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("value", pa.binary())])
    z = zstandard.ZstdCompressor(level=SQUEEZE)
    for b in batches:
        for pack, value, answers in zip(*(b.column(c).to_pylist() for c in ("pack", "value", "answers")), strict=True):
            p = Pack(pack, value)
            first, docs = p.firsts(), p.ids
            anchor = anchor_hashes(p.raw, first + p.left)
            code, which = np.unique(_codes(anchor, buckets), return_inverse=True)
            flags = {a["bucket"]: a["flags"] for a in answers}
            send, heat = np.zeros(len(code), bool), np.zeros(len(code), bool)
            for k, a, e in _parts(code >> np.uint64(32)):
                if k in flags:
                    bits = np.frombuffer(flags[k], np.uint8)
                    send[a:e], heat[a:e] = (np.unpackbits(x, count=e - a).astype(bool) for x in np.split(bits, 2))
            bucket = (code >> np.uint64(32)).astype(np.int64)
            some = np.flatnonzero(send[which])
            for i in range(0, len(some), TOGETHER):
                at = some[i : i + TOGETHER]
                made = entries(p.raw, p.lengths, docs, p.rows, first[at], p.count[at], p.left[at])
                to, hot = bucket[which[at]], heat[which[at]]
                if hot.any():
                    place, into = _around(made[hot], buckets)
                    made, to = np.concatenate((made[~hot], made[hot][place])), np.concatenate((to[~hot], into))
                by = np.argsort(to, kind="stable")
                made, rows, gone = made[by], [], []
                for k, a, e in _parts(to[by]):
                    kept, runs = merged([made[a:e]])
                    rows.append((k, 2, z.compress(_columns(kept))))
                    gone.append(runs)
                rows += [(k, 0, v) for k, v in _by_pack(joined(np.concatenate(gone)))]
                yield _sent(rows, schema)


def _extended(batches: Iterator[pa.RecordBatch], merge: int, last: bool) -> Iterator[pa.RecordBatch]:
    """(key, kind, value, rank) sorted by kind of content and key -> (level, key, value): the bucket's new level, and runs by pack.

    Kinds: 0 settled runs, which pass, 1 a bucket's levels, 2 the arrays of the new packs.
    """
    schema = pa.schema([("level", pa.bool_()), ("key", pa.int64()), ("value", pa.binary())])
    z = zstandard.ZstdCompressor(level=3)
    now, levels, new = None, [], NewArray()

    def done() -> list[tuple]:
        e, runs = extend(new.finish(), levels, merge)
        rows = [(False, k, v) for k, v in _by_pack(joined(np.concatenate([*new.runs, *runs])))]
        return rows if last or now is None or not len(e) else [*rows, (True, now, z.compress(_columns(e)))]

    for b in batches:
        rows = []
        for key, kind, value, rank in zip(*(b.column(c).to_pylist() for c in ("key", "kind", "value", "rank")), strict=True):
            if kind == 0:
                rows.append((False, key, value))
                continue
            if key != now:
                rows += done()
                now, levels, new = key, [], NewArray()
            if kind == 1:
                levels.append((rank, _unpacked(value, ENTRY)))
            else:
                new.add(_unpacked(value, ENTRY))
        yield _sent(rows, schema)
    yield _sent(done(), schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pack, value, runs) -> the pack's documents with their removed spans."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), ("kept", pa.binary())])
    for b in batches:
        for pack, value, parts in zip(*(b.column(c).to_pylist() for c in ("pack", "value", "runs")), strict=True):
            runs = np.concatenate([_unpacked(x, RUN) for x in parts or []] or [np.zeros(0, RUN)])
            runs["n"] += WINDOW - 1  # bytes now
            found: dict[int, list[tuple[int, int]]] = {}
            for row, start, n in joined(runs).tolist():
                found.setdefault(row, []).append((start, n))
            rows = []
            for doc_id, row, raw in Pack(pack, value).documents():
                spans = found.get(row, [])
                kept, at = [], 0
                for s, n in spans:
                    kept.append(raw[at:s])
                    at = s + n
                kept.append(raw[at:])
                rows.append((doc_id, len(raw), [{"start": s, "length": n} for s, n in spans], b"".join(kept)))
            yield _sent(rows, schema)


ASKS, RUNS = "pack long, asks boolean, value binary, hashes array<struct<bucket: long, hashes: binary>>", "level boolean, key long, value binary"


class SuffixFamily:
    """An index of documents in the shared folder that grows by batches. Not for use by several writers at a time.

    Its manifest, a small file in its folder, names the tables that belong to it and is replaced as a whole after each batch, so a
    family can be opened again in another session, and a batch that failed leaves the family as it was.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, hot: int = HOT, folder: str | None = None):
        """buckets: into which anchors are dealt, fixed for the family's life; a bucket is worked on in memory. folder: of a new family."""
        self.spark, self.buckets, self.hot = spark, buckets or shuffle_partitions(spark) * BUCKETS, hot
        self.folder = folder or f"{shared_root(spark)}/ledgerloom/{uuid.uuid4().hex}"
        self.next_pack, self.closed = 0, False
        self.packs: list[DataFrame] = []
        self.runs: list[DataFrame] = []
        #: (rank, level) by falling rank
        self.levels: list[tuple[int, DataFrame]] = []
        #: What the manifest says of these: tables of packs and of runs, and rank and table of levels.
        self.tables: dict[str, list] = {"packs": [], "runs": [], "levels": []}

    @staticmethod
    def open(spark: SparkSession, folder: str) -> SuffixFamily:
        """A family that was made before."""
        said = json.loads(spark.read.text(f"{folder}/family.json", wholetext=True).first()[0])
        family = SuffixFamily(spark, said["buckets"], said["hot"], folder)
        family.next_pack, family.closed, family.tables = said["next_pack"], said["closed"], said["tables"]
        family._read()
        return family

    def _read(self) -> None:
        """The tables that the manifest names."""
        read = lambda name, schema: self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        self.packs = [read(t, ASKS) for t in self.tables["packs"]]
        self.runs = [read(t, RUNS).filter("not level").select(F.col("key").alias("pack"), "value") for t in self.tables["runs"]]
        self.levels = [(rank, read(t, RUNS).filter("level").select("key", "value")) for rank, t in self.tables["levels"]]

    def _write_manifest(self) -> None:
        told = {"buckets": self.buckets, "hot": self.hot, "next_pack": self.next_pack, "closed": self.closed, "tables": self.tables}
        path = lambda name: self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        new, at = path(f".family-{uuid.uuid4().hex}"), path("family.json")
        fs = at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        out = fs.create(new)
        out.write(bytearray(json.dumps(told).encode()))
        out.close()
        fs.delete(at, False)
        fs.rename(new, at)

    def _all(self, asks: bool, packs: list[DataFrame]) -> DataFrame:
        """(pack, old, value or hashes) of some batches' packs, the last batch's not old."""
        out = None
        for k, p in enumerate(packs):
            rows = p.filter("asks" if asks else "not asks").select("pack", F.lit(k < len(packs) - 1).alias("old"), "hashes" if asks else "value")
            out = rows if out is None else out.unionByName(rows)
        return out

    def add(self, docs: DataFrame, last: bool = False) -> SuffixFamily:
        """Take a batch of documents (doc_id, text). last: no batch follows, so what only a later one needs is neither made nor kept."""
        if self.closed:
            raise ValueError("the family's last batch was added")
        spark, n, name = self.spark, shuffle_partitions(self.spark), uuid.uuid4().hex
        raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("raw"))
        with arrow_batches(spark, 512, BATCH):
            new = stored(rows.mapInArrow(partial(_packs, first_pack=self.next_pack, buckets=self.buckets), ASKS), by="asks", path=f"{self.folder}/packs-{name}")
        packs = [*self.packs, new]
        asks = self._all(True, packs).select("pack", "old", F.explode("hashes").alias("a")).select("a.bucket", "pack", "old", "a.hashes")
        with arrow_batches(spark, 2048, BATCH):
            asked = asks.repartition(n, "bucket").sortWithinPartitions("bucket")
            answers = stored(asked.mapInArrow(partial(_answers, hot=self.hot), "pack long, bucket long, flags binary"))
        if last:  # from here on the family takes no batch, should this one fail too
            self.closed = True
            self._write_manifest()
            for p in packs:
                discard(p, "asks=true")
        release(spark)
        by_pack = answers.groupBy("pack").agg(F.collect_list(F.struct("bucket", "flags")).alias("answers"))
        ranks = [rank for rank, _ in self.levels]
        merge = 0 if last else next(r for r in range(len(ranks) + 1) if r not in ranks)
        with arrow_batches(spark, 2048, BATCH):  # rows are up to MB
            told = self._all(False, packs).join(by_pack, "pack").select("pack", "value", "answers")
            sent = told.mapInArrow(partial(_entries, buckets=self.buckets), "key long, kind int, value binary").withColumn("rank", F.lit(None).cast("int"))
            for rank, level in self.levels:
                sent = sent.unionByName(level.select("key", F.lit(1).alias("kind"), "value", F.lit(rank).alias("rank")))
            sent = sent.repartition(n, "key").sortWithinPartitions(F.col("kind") > 0, "key", "kind")
            stored(sent.select("key", "kind", "value", "rank").mapInArrow(partial(_extended, merge=merge, last=last), RUNS), by="level", path=f"{self.folder}/runs-{name}")
        discard(answers)
        newest = new.filter("not asks").agg(F.max("pack")).first()[0]
        self.next_pack = self.next_pack if newest is None else newest + 1
        left = [level for rank, level in self.levels if last or rank < merge]
        kept = [] if last else [*[x for x in self.tables["levels"] if x[0] > merge], [merge, f"runs-{name}"]]
        self.tables = {"packs": [*self.tables["packs"], f"packs-{name}"], "runs": [*self.tables["runs"], f"runs-{name}"], "levels": kept}
        self._write_manifest()
        for level in left:  # merged into the new one, or of no use any more
            discard(level, "level=true")
        self._read()
        release(spark)
        return self

    def removed(self) -> DataFrame:
        """doc_id, n_bytes, spans (removed, as array of start and length in bytes), kept (the bytes that stay) of all documents."""
        runs = self.runs[0]
        for r in self.runs[1:]:
            runs = runs.unionByName(r)
        runs = runs.groupBy("pack").agg(F.collect_list("value").alias("runs"))
        met = self._all(False, self.packs).join(runs, "pack", "left").select("pack", "value", "runs")
        return met.mapInArrow(_cut, "doc_id long, n_bytes long, spans array<struct<start: long, length: long>>, kept binary")


def remove_repeats(docs: DataFrame, parts: int = PARTS) -> DataFrame:
    """What SuffixFamily.removed() gives of docs, added in `parts` batches dealt by a hash of the text, so that copies meet early."""
    family = SuffixFamily(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    for k in range(parts):
        family.add(rows.filter(F.pmod(F.xxhash64("text", F.lit("part")), F.lit(parts)) == k) if parts > 1 else rows, last=k == parts - 1)
    return family.removed()
