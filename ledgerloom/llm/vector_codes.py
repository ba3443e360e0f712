"""Product codes of vectors by exact integer k-means, with partial-distance search for the nearest entries.

Components become integers, floor(scale * x). A vector is cut into equal parts, each with a codebook of its own. A round
assigns every part to its nearest entry (squared distance, ties to the lower index) and moves each entry to the floor of
its parts' mean; entries without parts stay. All arithmetic is of integers, so results do not depend on the order of rows
or on partitions.

The search goes through the entries in order. An entry's distance to all rows of a batch is summed dimension by dimension,
the dimension with the largest variance among the codebook's entries first; a mask drops a row as soon as its sum strictly
exceeds the row's best complete distance. Rows that are left after the last dimension with a smaller distance take the
entry. Equal distances survive the mask and lose to the lower index.

Each round is one pass over the stored integers. A task adds up counts and sums of its rows for each part and entry, and
their totals, entries * dimensions numbers, come to the driver: bounded by the codebook, whatever the rows.

Defined cases: rows whose vector is null, empty, or holds a null or non-finite component are dropped; the first codebook
has the vectors of the smallest ids, a null id last, rows of one id by their components; with fewer rows it has fewer
entries; vectors of several lengths, or of a length that the parts do not divide, are a ValueError; components whose
distances might not fit a long are computed with unbounded integers, and an error beyond a long is an ArithmeticError of Spark or Arrow; a
null label is a label; repeated rows count each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_batches, met, stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Rows and bytes of an Arrow batch.
ROWS, BATCH = 8192, 8 << 20

Books = list[list[list[int]]]


def kept(rows: DataFrame) -> DataFrame:
    """vec_id, label and vector of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)
    v = F.col("embedding").cast("array<double>")
    named = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v"))
    return named.filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))


def _limit(width: int) -> int:
    """Size of components up to which a squared distance over `width` of them is below 2^62."""
    return math.isqrt((1 << 62) // max(width, 1)) // 2


def _integers(column: pa.ListArray, scale: int, parts: int) -> list[np.ndarray]:
    """The parts of the rows of floor(scale * x): 64-bit integers, or Python's where their distances might not fit."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = len(flat) // len(column)
    if width % parts or not np.all(np.diff(column.offsets.to_numpy()) == width):
        raise ValueError(f"vectors of several lengths, or {width} components are not {parts} equal parts")
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * float(scale))
    if np.abs(scaled).max() > _limit(width // parts):
        ratios = (float(x).as_integer_ratio() for x in flat)
        whole = np.array([a * scale // b for a, b in ratios], dtype=object)
    else:
        whole = scaled.astype(np.int64)
    return np.split(whole.reshape(len(column), width), parts, axis=1)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to each row's nearest entry of the book, by partial-distance search."""
    wide = x.dtype == object or book.dtype == object
    kind, centre = (object, int) if wide else (np.int64, np.int64)
    k = len(book)
    # k^2 times the variance, an integer; the order changes the work, not the result
    spread = [k * sum(int(c) ** 2 for c in col) - sum(int(c) for c in col) ** 2 for col in book.T]
    order = sorted(range(book.shape[1]), key=lambda j: -spread[j])
    columns = [np.ascontiguousarray(x[:, j]).astype(kind) for j in range(x.shape[1])]
    best, index = np.zeros(len(x), dtype=kind), np.zeros(len(x), dtype=np.int64)
    for j in order:
        best = best + (columns[j] - centre(book[0, j])) ** 2
    for e in range(1, k):
        alive, sums = np.arange(len(x)), np.zeros(len(x), dtype=kind)
        for j in order:
            sums = sums + (columns[j][alive] - centre(book[e, j])) ** 2
            mask = sums <= best[alive]
            if not mask.all():
                alive, sums = alive[mask], sums[mask]
            if not len(alive):
                break
        better = sums < best[alive]
        best[alive[better]], index[alive[better]] = sums[better], e
    return index, best


def _arrays(books: Books) -> list[np.ndarray]:
    big = any(abs(c) > _limit(len(e)) for b in books for e in b for c in e)
    return [np.array(b, dtype=object if big else np.int64) for b in books]


def first_books(rows: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES) -> Books:
    """The parts of the vectors with the smallest ids."""
    few = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not few:
        return []
    return [[[int(c) for c in entry] for entry in part] for part in _integers(pa.array([r.v for r in few], pa.list_(pa.float64())), scale, parts)]


def totals(rows: DataFrame, books: Books, scale: int = SCALE) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) to the number of its parts and their sums by component, of one pass."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, held = _arrays(books), {}
        for b in batches:
            if not b.num_rows:
                continue
            for p, (x, book) in enumerate(zip(_integers(b.column("v"), scale, len(arrays)), arrays, strict=True)):
                index, _ = nearest(x, book)
                order = np.argsort(index, kind="stable")
                found, at = np.unique(index[order], return_index=True)
                sums = np.add.reduceat(x[order], at, axis=0)
                for e, n, s in zip(found.tolist(), np.diff(np.append(at, len(x))).tolist(), sums.tolist(), strict=True):
                    c, t = held.get((p, e), (0, [0] * len(s)))
                    held[p, e] = (c + n, [int(a) + int(b) for a, b in zip(t, s, strict=True)])
        if held:
            flat = [(p, e, j, n, Decimal(t)) for (p, e), (n, s) in held.items() for j, t in enumerate(s)]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*flat, strict=True), kinds, strict=True)], names=["p", "e", "j", "n", "t"])

    found = rows.select("v").mapInArrow(work, "p int, e int, j int, n long, t decimal(38,0)")
    out: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in found.groupBy("p", "e", "j").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).orderBy("p", "e", "j").collect():
        out.setdefault((r.p, r.e), (r.n, []))[1].append(int(r.t))
    return out


def fit(rows: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Books:
    """The codebooks after so many rounds over all of kept()'s rows."""
    books = first_books(rows, scale, parts, entries)
    for _ in range(rounds if books else 0):
        for (p, e), (n, sums) in totals(rows, books, scale).items():
            books[p][e] = [s // n for s in sums]
    return books


def encode(rows: DataFrame, books: Books, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code (an index a part as two hex digits) and error (squared distance) of kept()'s rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _arrays(books)
        for b in batches:
            if not b.num_rows:
                continue
            got = [nearest(x, book) for x, book in zip(_integers(b.column("v"), scale, len(arrays)), arrays, strict=True)]
            digits = np.stack([i for i, _ in got], axis=1).astype(np.uint8)
            error = [sum(map(int, d)) for d in zip(*(d for _, d in got), strict=True)]
            columns = [b.column("vec_id"), b.column("label"), pa.array([r.tobytes().hex() for r in digits], pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "v").mapInArrow(work, f"vec_id long, label {kind}, code string, error long")


def fingerprint(books: Books) -> str:
    """SHA-256 of the entries' components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(c) for part in books for entry in part for c in entry).encode()).hexdigest()


def compress(rows: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error (the label's sum) and codebooks_sha256 of every row that takes part."""
    spark = rows.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits")
    with arrow_batches(spark, ROWS, BATCH):
        base = stored(kept(rows))
        books = fit(base, scale, parts, entries, rounds)
        coded = stored(encode(base, books, scale))
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    out = met(coded, sums, "label", F.xxhash64("vec_id", "code"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))
