"""SimHash near-duplicates, linked through a Gray-order hierarchical index.

A fingerprint bit is the majority of that bit among the hashes of a document's word shingles. Documents link at few
differing bits; a group is everything that links reach.

Linking works on distinct fingerprints, so copies of any number are one row. The 64 bits are cut into one block more than the bits that may differ: two linked fingerprints agree in a block, and meet where
rows are dealt by (block, its value). A block value that holds very many fingerprints is dealt again by the blocks of its
other bits, which is exact for the same reason. Within a block value, fingerprints are sorted by Gray rank and become
the leaves of a tree: a node keeps the bits that all below it share, and where they are shared first. A search goes
down with all queries at once and adds the differences in the bits that are new at each node; a node that passes the
limit drops with everything below it, and queries that find very much go down in smaller parts, so memory is bounded.
What is found is united at once. Only the links that connect a bucket's groups leave it: one for each member, to the
smallest member of its group, never all pairs.

Defined cases: a null or empty text has fingerprint zero, and links as any other; fewer words than a shingle make one
shingle; rows with one doc_id share their group; a fingerprint whose rows all have a null doc_id links as any other, and
its group is null only where no member has a doc_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import shuffle_partitions, stored
from ledgerloom.llm.components import components

BITS, DIFFER, SEED = 64, 3, 42
#: Fingerprints of a block value above which it is dealt again by its other bits.
HOT = 2048
#: Children of a node, queries that go down together, and pairs of query and node that do.
FAN, TOGETHER, MOST = 8, 4096, 1 << 21
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
#: Hashes whose bits are counted at a time.
CHUNK = 1 << 16


def hashes(text: str | None, shingle: int) -> np.ndarray:
    """Hashes of the word shingles of a text, in their order."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    k = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)], dtype="<u8")


def majority(h: np.ndarray) -> int:
    """Fingerprint of shingle hashes, unsigned; zero for none."""
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(h), CHUNK):
        bits = np.unpackbits(h[i : i + CHUNK].view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of the word shingles of a text, unsigned."""
    return majority(hashes(text, shingle))


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id and the fingerprint's bits as a long."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each value (uint64) in the binary reflected Gray code."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class GrayTree:
    """Fingerprints in Gray order under nodes of shared masked bits."""

    def __init__(self, fps: np.ndarray):
        self.order = np.argsort(gray_rank(fps), kind="stable")
        mask = np.full(len(fps), ~np.uint64(0))
        bits = fps[self.order]
        self.levels = [(bits, mask)]  # leaves first: bits and the mask of the bits that count
        while len(bits) > 1:
            at = np.arange(0, len(bits), FAN)
            spread = np.bitwise_or.reduceat(bits ^ np.repeat(bits[at], np.diff(np.append(at, len(bits)))), at)
            mask = np.bitwise_and.reduceat(mask, at) & ~spread
            bits = bits[at] & mask
            self.levels.append((bits, mask))

    def near(self, queries: np.ndarray, differ: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, member) places of all pairs with at most `differ` differing bits, some at a time."""
        waiting = [(lo, queries[lo : lo + TOGETHER]) for lo in range(0, len(queries), TOGETHER)][::-1]
        while waiting:
            lo, q = waiting.pop()
            bits, mask = self.levels[-1]
            who, node = np.divmod(np.arange(len(q) * len(bits)), len(bits))
            gone = np.bitwise_count((q[who] ^ bits[node]) & mask[node]).astype(np.int64)
            for level in range(len(self.levels) - 2, -1, -1):
                left = gone <= differ
                who, node, gone = who[left], node[left], gone[left]
                if len(who) * FAN > MOST and len(q) > 1:
                    waiting += [(lo + len(q) // 2, q[len(q) // 2 :]), (lo, q[: len(q) // 2])]
                    break
                above = self.levels[level + 1][1][node]
                bits, mask = self.levels[level]
                child = node[:, None] * FAN + np.arange(FAN)
                there = child < len(bits)
                who, above, gone = (np.repeat(x, FAN)[there.ravel()] for x in (who, above, gone))
                node = child[there]
                gone = gone + np.bitwise_count((q[who] ^ bits[node]) & mask[node] & ~above)
            else:
                left = gone <= differ
                yield who[left] + lo, self.order[node[left]]


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    while True:
        above = parent[at]
        if np.array_equal(above, at):
            return at
        at = above


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Make the groups of each pair one in a forest of parents; a root is its group's smallest place."""
    while len(a):
        a, b = _roots(parent, a), _roots(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def spanning(fps: np.ndarray, reps: np.ndarray, differ: int) -> tuple[np.ndarray, np.ndarray]:
    """(rep, smallest rep of its group) for the members of a bucket's groups, itself left out."""
    order = np.argsort(reps, kind="stable")
    fps, reps = fps[order], reps[order]
    parent = np.arange(len(fps))
    for a, b in GrayTree(fps).near(fps, differ):
        unite(parent, a, b)
    label = _roots(parent, parent)
    member = np.flatnonzero(label != np.arange(len(fps)))
    return reps[member], reps[label[member]]


def _links(batches: Iterator[pa.RecordBatch], differ: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, fp, rep) sorted by bucket -> edges (u, v). One bucket is held at a time, besides the batch."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    now = None

    def solved() -> tuple[np.ndarray, np.ndarray]:
        fps, reps = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        return spanning(fps.view(np.uint64), reps, differ) if len(fps) > 1 else (reps[:0], reps[:0])

    for b in batches:
        bucket, fp, rep = (b.column(c).to_numpy() for c in ("bucket", "fp", "rep"))
        cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)])) if len(bucket) else []
        out = []
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if bucket[a] != now:
                if held:
                    out.append(solved())
                held, now = [], bucket[a]
            held.append((fp[a:z], rep[a:z]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out]), pa.int64()) for k in (0, 1)], names=["u", "v"])
    if held:
        u, v = solved()
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _blocks(bits: list[int], parts: int) -> list[list[int]]:
    return [[int(x) for x in p] for p in np.array_split(bits, parts)]


def _value(fp: F.Column, bits: list[int]) -> F.Column:
    """The bits of one run of fp, as a long."""
    out = F.lit(0).cast("long")
    runs: list[list[int]] = []
    for b in bits:
        if runs and b == runs[-1][-1] + 1:
            runs[-1].append(b)
        else:
            runs.append([b])
    at = 0
    for r in runs:
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, r[0]).bitwiseAND((1 << len(r)) - 1), at))
        at += len(r)
    return out


def links(distinct: DataFrame, differ: int = DIFFER) -> DataFrame:
    """Edges (u, v) between representatives that connect all fingerprints (fp, rep) with at most `differ` differing bits."""
    fp, parts = F.col("fp"), differ + 1
    blocks = _blocks([*range(BITS)], parts)
    dealt = distinct.select("fp", "rep", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), _value(fp, b).alias("value")) for k, b in enumerate(blocks)])).alias("at")).select("fp", "rep", "at.k", "at.value")
    hot = stored(dealt.groupBy("k", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("k", "value", F.lit(True).alias("hot")))
    marked = dealt.join(hot, ["k", "value"], "left")
    again = F.lit(None)
    for k, b in enumerate(blocks):
        others = _blocks([x for x in range(BITS) if x not in b], parts)
        again = F.when(F.col("k") == k, F.array(*[F.xxhash64(F.lit(k), F.col("value"), F.lit(j), _value(fp, o)) for j, o in enumerate(others)])).otherwise(again)
    buckets = F.when(F.col("hot"), again).otherwise(F.array(F.xxhash64(F.col("k"), F.col("value"))))
    rows = marked.select("fp", "rep", F.explode(buckets).alias("bucket"))
    n = shuffle_partitions(distinct.sparkSession)
    return rows.repartition(n, "bucket").sortWithinPartitions("bucket").select("bucket", "fp", "rep").mapInArrow(partial(_links, differ=differ), "u long, v long")


def groups(prints: DataFrame, differ: int = DIFFER) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of prints (doc_id, fp)."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    edges = links(distinct.select("fp", F.col("fp").alias("rep")), differ)
    several = prints.filter("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a <> b")  # one doc_id, several texts
    same = prints.join(several.select("doc_id", "a"), "doc_id").select(F.col("fp").alias("u"), F.col("a").alias("v"))
    label = components(edges.union(same))
    named = distinct.join(label, distinct["fp"] == label["node"], "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    return named.join(named.groupBy("label").agg(F.min("least").alias("component_id")), "label").select("fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, differ: int = DIFFER) -> DataFrame:
    """doc_id, fingerprint (hexadecimal), component_id of every document."""
    prints = stored(fingerprints(docs, shingle))
    found = prints.join(groups(prints, differ), "fp")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
