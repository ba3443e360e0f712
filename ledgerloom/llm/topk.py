"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions are cut into `NODES` blocks; a block's partial products are one node's score list. Vectors are stored as
packed blocks, queries go through in waves of at most `WAVE` bytes, and only a wave's queries and cutoffs are broadcast.

Phase 1: every `FIRST`-th block of candidates of a task, its first one included, takes the best k of each node's list,
adds up what those candidates have on all nodes, and reports the best k sums; the k-th of all reports is a safe cutoff,
as k rows reach it. Phase 2: with the cutoff t broadcast, a candidate can reach t only if some node's partial score
reaches t / NODES; those entries are collected from all blocks. Phase 3: their remaining scores are resolved exactly,
those that reach t stay, and each task sends its best k.

Sums are exact: doubles while every sum is below 2**53, otherwise 64-bit or unbounded integers.

Defined cases: vectors that are null, empty, or hold null or non-finite components, and rows without vec_id, take no
part; components of any finite size do; ranks follow the exact scores, and a score outside the 64-bit range is given as
the nearest long; a shorter vector counts as padded with zeros; equal scores go to the smaller vec_id; rows that repeat
a vec_id are rows of their own, only the query's own row is left out; fewer candidates than k give them all; an empty
table or no queries give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

K, EVERY, SCALE, NODES = 20, 20, 64, 4
#: Vectors of a block, bytes of the queries of a wave, and queries that are scored together.
BLOCK, WAVE, TOGETHER = 2048, 64 << 20, 256
#: One of so many blocks takes part in phase 1.
FIRST = 8
#: Pairs that a task keeps before it trims them to the best k.
HELD = 1_000_000
LONG = (-(1 << 63), (1 << 63) - 1)
_BLOCK_ROW = "block long, query boolean, early boolean, dims int, vec_ids binary, rows binary, vectors binary"
_FOUND = "query_id long, query_row long, vec_id long, row long, score long, over int, rest binary"


def _blocks(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    """Rows -> packed blocks; queries also as blocks of their own. Row numbers are unique over all tasks."""
    names = [x.split()[0] for x in _BLOCK_ROW.split(", ")]
    kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    base, made, numbered = TaskContext.get().partitionId() << 36, {False: 0, True: 0}, 0
    held: dict[bool, list[tuple[int, int, np.ndarray]]] = {False: [], True: []}

    def pack(query: bool) -> tuple:
        rows, held[query] = held[query][:BLOCK], held[query][BLOCK:]
        dims = max(len(r[2]) for r in rows)
        m = np.zeros((len(rows), dims))
        for i, r in enumerate(rows):
            m[i, : len(r[2])] = r[2]
        made[query] += 1
        return base + sum(made.values()), query, made[query] % FIRST == 1 % FIRST, dims, np.array([r[0] for r in rows], "<i8").tobytes(), np.array([r[1] for r in rows], "<i8").tobytes(), m.tobytes()

    def send(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*zip(*rows, strict=True)] or [[]] * len(names), kinds, strict=True)], names=names)

    for b in batches:
        for vec_id, v in zip(b.column("vec_id").to_pylist(), b.column("v").to_pylist(), strict=True):
            x = np.array([np.nan if c is None else c for c in v or []], dtype=np.float64)
            if vec_id is None or not len(x) or not np.isfinite(x).all():
                continue
            numbered += 1
            held[False].append((vec_id, base + numbered, x))
            if vec_id % every == 0:
                held[True].append((vec_id, base + numbered, x))
        yield send([pack(q) for q in held for _ in range(len(held[q]) // BLOCK)])
    yield send([pack(q) for q in held if held[q]])


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): whole doubles, or unbounded integers where a double cannot hold them."""
    with np.errstate(over="ignore"):
        m = np.floor(SCALE * x)
    if np.isfinite(m).all():
        return m
    # a double that large is whole
    return np.array([int(c) * SCALE if abs(c) > 2.0**53 else math.floor(SCALE * c) for c in x.ravel().tolist()], dtype=object).reshape(x.shape)


class Vectors:
    """A block of vectors, padded to a number of dimensions."""

    def __init__(self, dims: int, vec_ids: bytes, rows: bytes, vectors: bytes):
        self.vec_ids, self.rows = np.frombuffer(vec_ids, "<i8"), np.frombuffer(rows, "<i8")
        self.m = scaled(np.frombuffer(vectors, np.float64).reshape(-1, dims))

    def wide(self, dims: int) -> np.ndarray:
        return self.m if self.m.shape[1] == dims else np.pad(self.m, ((0, 0), (0, dims - self.m.shape[1])))


def _partials(q: np.ndarray, x: np.ndarray, nodes: int) -> list[np.ndarray]:
    """Partial products (queries, candidates) by block of dimensions."""
    most = q.shape[1] * int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0))
    if most >= 2**53:
        kind = np.int64 if most < 2**62 else object
        q, x = (np.array([int(c) for c in m.ravel().tolist()], dtype=kind).reshape(m.shape) for m in (q, x))
    cuts = np.linspace(0, q.shape[1], nodes + 1).astype(int)
    return [q[:, a:b] @ x[:, a:b].T for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    return np.argpartition(-scores, k - 1, axis=1)[:, :k] if scores.shape[1] > k else np.tile(np.arange(scores.shape[1]), (len(scores), 1))


def _pairs(wave: list[Vectors], x: Vectors) -> Iterator[tuple[Vectors, slice, list[np.ndarray], np.ndarray]]:
    """(query block, its rows, partial products, own) of a candidate block, TOGETHER queries at a time."""
    for q in wave:
        dims = max(q.m.shape[1], x.m.shape[1])
        qm, xm = q.wide(dims), x.wide(dims)
        for a in range(0, len(qm), TOGETHER):
            part = slice(a, a + TOGETHER)
            yield q, part, _partials(qm[part], xm, NODES), q.rows[part, None] == x.rows[None, :]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[Vectors]:
    for b in batches:
        for r in zip(*(b.column(c).to_pylist() for c in ("dims", "vec_ids", "rows", "vectors")), strict=True):
            yield Vectors(*r)


def _reports(batches: Iterator[pa.RecordBatch], wave, k: int) -> Iterator[pa.RecordBatch]:
    """Phase 1: (query row, its best k partial sums in this task); above the 64-bit range its end, which is safe, below it none."""
    best: dict[int, list[int]] = {}
    blocks = [Vectors(*w) for w in wave.value]
    for x in _candidates(batches):
        for q, part, partial_scores, own in _pairs(blocks, x):
            total = sum(partial_scores)
            seen = np.concatenate([_best(s, k) for s in partial_scores], axis=1)
            for i, row in enumerate(q.rows[part].tolist()):
                c = np.unique(seen[i])
                c = c[~own[i, c]]
                sums = [min(s, LONG[1]) for s in map(int, total[i, c]) if s >= LONG[0]]
                best[row] = sorted([*best.get(row, []), *sums], reverse=True)[:k]
    yield pa.RecordBatch.from_arrays([pa.array([*best], pa.int64()), pa.array([*best.values()], pa.list_(pa.int64()))], names=["row", "sums"])


def _reaching(partial_scores: list[np.ndarray], cutoff: np.ndarray) -> np.ndarray:
    """Phase 2: where some node's partial score reaches its share of the cutoff. Rounding only lets more through."""
    if partial_scores[0].dtype == object:
        share = cutoff.astype(object)[:, None]
        return np.logical_or.reduce([np.array(s * len(partial_scores) >= share, dtype=bool) for s in partial_scores])
    share = np.nextafter(cutoff.astype(np.float64) / len(partial_scores), -np.inf)[:, None]
    return np.logical_or.reduce([np.nextafter(s.astype(np.float64), np.inf) >= share if s.dtype == np.int64 else s >= share for s in partial_scores])


def _resolved(batches: Iterator[pa.RecordBatch], wave, cutoffs, k: int) -> Iterator[pa.RecordBatch]:
    """Phases 2 and 3: the entries that reach the query's cutoff, the best k of a task.

    A score outside the 64-bit range comes as its nearest long with two columns that order it among its kind: its bits, negative
    below the range, and its bytes.
    """
    blocks, cutoff = [Vectors(*w) for w in wave.value], cutoffs.value
    names = [x.split()[0] for x in _FOUND.split(", ")]
    held: list[np.ndarray] = [np.zeros((4, 0), np.int64)]
    scores: list[np.ndarray] = [np.zeros(0, np.int64)]

    def trim() -> None:
        ids, score = np.concatenate(held, axis=1), np.concatenate(scores)
        if score.dtype == object:
            at = np.array(sorted(range(len(score)), key=lambda i: (ids[1, i], -score[i], ids[2, i], ids[3, i])), dtype=np.int64)
        else:
            at = np.lexsort((ids[3], ids[2], ~score, ids[1]))
        ids, score = ids[:, at], score[at]
        starts = np.flatnonzero(np.concatenate(([True], ids[1, 1:] != ids[1, :-1]))) if ids.shape[1] else np.zeros(0, int)
        place = np.arange(ids.shape[1]) - np.repeat(starts, np.diff(np.append(starts, ids.shape[1])))
        held[:], scores[:] = [ids[:, place < k]], [score[place < k]]

    size = 0
    for x in _candidates(batches):
        for q, part, partial_scores, own in _pairs(blocks, x):
            rows = q.rows[part].tolist()
            least = np.array([cutoff.get(r, LONG[0]) for r in rows], dtype=np.int64)
            none = np.array([r not in cutoff for r in rows], dtype=bool)
            i, c = np.nonzero((_reaching(partial_scores, least) | none[:, None]) & ~own)
            score = sum(s[i, c] for s in partial_scores)
            score = score if score.dtype == object else score.astype(np.int64)
            reach = np.array(score >= least[i], dtype=bool) | none[i]
            i, c = i[reach], c[reach]
            held.append(np.stack([q.vec_ids[part][i], q.rows[part][i], x.vec_ids[c], x.rows[c]]))
            scores.append(score[reach])
            size += len(i)
            if size > HELD:
                trim()
                size = 0
    trim()
    score = [int(s) for s in scores[0]]
    over = [0 if LONG[0] <= s <= LONG[1] else s.bit_length() * (1 if s > 0 else -1) for s in score]
    raw = lambda s: abs(s).to_bytes((s.bit_length() + 7) // 8, "big")
    rest = [b"" if not o else raw(s) if s > 0 else bytes(255 - b for b in raw(s)) for s, o in zip(score, over, strict=True)]
    columns = [*(pa.array(c, pa.int64()) for c in held[0]), pa.array([max(LONG[0], min(LONG[1], s)) for s in score], pa.int64()), pa.array(over, pa.int32()), pa.array(rest, pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, names=names)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: for each row with vec_id divisible by `every`, its k best other rows."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    blocks = stored(rows.mapInArrow(partial(_blocks, every=every), _BLOCK_ROW))
    columns = ["dims", "vec_ids", "rows", "vectors"]
    candidates = blocks.filter("not query")
    early, candidates = candidates.filter("early").select(*columns), candidates.select(*columns)
    waves: list[list[int]] = []
    left = 0
    for block, size in blocks.filter("query").select("block", F.octet_length("vectors")).orderBy("block").toLocalIterator():
        if not waves or size > left:
            waves.append([])
            left = WAVE
        waves[-1].append(block)
        left -= size
    parts: list[DataFrame] = []
    for ids in waves:
        wave = spark.sparkContext.broadcast([tuple(r) for r in blocks.filter(F.col("query") & F.col("block").isin(ids)).select(*columns).collect()])
        reports = early.mapInArrow(partial(_reports, wave=wave, k=k), "row long, sums array<long>")
        sums = reports.select("row", F.explode("sums").alias("s")).groupBy("row").agg(F.sort_array(F.collect_list("s"), asc=False).alias("s"))
        cutoffs = spark.sparkContext.broadcast({r["row"]: r["t"] for r in sums.filter(F.size("s") >= k).select("row", F.get("s", F.lit(k - 1)).alias("t")).collect()})
        found = candidates.mapInArrow(partial(_resolved, wave=wave, cutoffs=cutoffs, k=k), _FOUND)
        rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("over"), F.desc("rest"), F.desc("score"), "vec_id", "row"))
        best = found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        parts.append(stored(best) if len(waves) > 1 else best)
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
