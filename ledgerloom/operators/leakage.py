"""Near-duplicates between training and evaluation text by Jaccard similarity of character shingles.

Texts with one set of shingles are one row until the end. Sets are compared in two ways, an exact and an approximate one, and
in both what may be similar is compared in full: only then are whole sets made again, from the texts of those that may be.

exact_pairs() compares all pairs of sets whose sizes allow the similarity, by bitmaps of parity: sets differ in as many shingles
at least as their bitmaps differ in bits, so none is lost. Sets are dealt to cells: one side to the class of its size, the other to the classes
of all sizes that may fit, and large classes are cut into blocks on both sides. A task holds a block of one side, and the other passes by it, so memory
does not grow with the table, and pairs that cannot be similar are never written. The work is quadratic in a class, at about a bit a shingle and pair.

lsh_pairs() deals sets to cells by bands of their MinHash signatures, and the bitmaps sift what meets there. No pairs are written of that: the texts of
sets that may be similar to one of their cell go to it once each, and the cell's pairs are compared there, so what is written grows with the sets. A pair
that meets in several cells counts in that of its first common band.

Defined cases: documents without shingles (null, or shorter than one) never pair; null and repeated ids are rows of their
own; an empty side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.grams import minima, parity, shingle_set
from ledgerloom.functions.text import mask_identity, strip
from ledgerloom.sources.shared import release, spread, stored

SOFT, HARD = 0.85, 0.95
#: Has no effect any more: what exact_pairs() compares does not depend on which shingles are frequent.
FREQUENT = 1 << 17
#: Bits of a set's parity, at least; about a bit for two shingles.
BITS = 256
#: Sets of a block of the side that a task holds, and of the one that passes by; rows and columns of a tile of pairs.
HELD, PASSING, TILE = 1 << 14, 1 << 16, (64, 1024)
#: Pairs of a cell up to which they are looked at one by one.
FEW = 64
#: Shingles of a block of texts that a task holds, and of those compared with it at a time.
SHINGLES, TOGETHER = 1 << 22, 1 << 20


def _spaced(text: Column) -> Column:
    return F.regexp_replace(strip(text), r"\s+", " ")


def _each(docs: DataFrame, ddl: str, of: Callable[[list[str | None]], list[pa.Array]], *keep: str, masked: bool = True) -> DataFrame:
    """The columns to keep, and those that `of` gives of the texts of an Arrow batch: spaces single, identities masked."""
    names = [*keep, *[x.split()[0] for x in ddl.split(", ")]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *of(b.column("text").to_pylist())], names=names)

    kept = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    text = _spaced(mask_identity(F.col("text")) if masked else F.col("text"))
    return spread(docs.select(*keep, "text")).select(*keep, text.alias("text")).mapInArrow(work, ", ".join(filter(None, (kept, ddl))))


def shingle_counts(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, shingles): how many different k-grams each text has, as it is but for spaces."""
    count = lambda texts: [pa.array([len(shingle_set(t, k)) for t in texts], pa.int64())]
    return _each(docs, "shingles long", count, "doc_id", masked=False)


def set_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def bits(n: int) -> int:
    """Bits of the parity of a set of n: a power of two, so that a wider parity folds to a narrower one."""
    return max(BITS, 1 << max(0, math.ceil(n / 2) - 1).bit_length())


def _sketch(docs: DataFrame, k: int, ddl: str = "", more: Callable[[np.ndarray], list] = lambda s: []) -> tuple[DataFrame, DataFrame]:
    """(doc_id, set_id) of documents with shingles, and of one document for each set: set_id, n, text_hash, parity and the columns of `more`."""
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    ddl = ", ".join(filter(None, ("set_id long, n long, parity array<long>", ddl)))
    types = [kinds[x.split()[1]] for x in ddl.split(", ")]

    def of(texts: list[str | None]) -> list[pa.Array]:
        rows = [(set_id(s), len(s), parity(s, bits(len(s))) if len(s) else [], *more(s)) for s in (shingle_set(t, k) for t in texts)]
        return [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]

    made = _each(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), ddl, of, "doc_id", "text_hash")
    rows = stored(made.filter("n > 0"))
    return rows.select("doc_id", "set_id"), stored(rows.drop("doc_id").dropDuplicates(["set_id"]))


def length_class(n: Column, soft: float) -> Column:
    """Sizes that may fit lie in one class or in neighbouring ones; the class does not fall where the size grows."""
    return F.floor(F.log(F.greatest(n.cast("double"), F.lit(1.0))) / F.lit(max(-math.log(soft), 1e-6))).cast("int")


def folded(m: np.ndarray, words: int) -> np.ndarray:
    """Parities (rows of 64-bit words) with fewer bits."""
    while m.shape[1] > words:
        m = m[:, : m.shape[1] // 2] ^ m[:, m.shape[1] // 2 :]
    return m


def _by_width(b: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(set_id, n, parities) of the rows with each number of words, by size."""
    lists = b.column("parity")
    ids, n, starts = b.column("set_id").to_numpy(), b.column("n").to_numpy(), lists.offsets.to_numpy()
    values, width, out = lists.values.to_numpy().view(np.uint64), np.diff(lists.offsets.to_numpy()), {}
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        at = at[np.argsort(n[at], kind="stable")]
        out[w] = ids[at], n[at], values[starts[at][:, None] + np.arange(w)]
    return out


def alike(t: tuple[np.ndarray, np.ndarray, np.ndarray], e: tuple[np.ndarray, np.ndarray, np.ndarray], soft: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of (set_id, n, parities), both by size, that sizes and parities allow, some at a time."""
    words = min(t[2].shape[1], e[2].shape[1])
    a, b = (np.ascontiguousarray(folded(x[2], words).T) for x in (t, e))
    for lo in range(0, len(t[0]), TILE[0]):
        n = t[1][lo : lo + TILE[0], None]
        first, last = np.searchsorted(e[1], math.floor(n[0, 0] * soft)), np.searchsorted(e[1], math.ceil(n[-1, 0] / soft), "right")
        for at in range(int(first), int(last), TILE[1]):
            m = e[1][None, at : min(at + TILE[1], int(last))]
            apart = np.zeros((n.shape[0], m.shape[1]), np.uint16 if words < 1024 else np.uint32)
            for w in range(words):
                apart += np.bitwise_count(a[w, lo : lo + n.shape[0], None] ^ b[w, None, at : at + m.shape[1]])
            may = (apart <= (n + m) * ((1 - soft) / (1 + soft)) + 1e-6) & (np.minimum(n, m) >= np.maximum(n, m) * soft - 1e-9)
            i, j = np.nonzero(may)
            if len(i):
                yield t[0][lo + i], e[0][at + j]


def _cuts(b: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Runs of rows of one cell and side."""
    cell, passing = b.column("cell").to_numpy(), b.column("passing").to_numpy()
    cuts = np.concatenate(([0], np.flatnonzero((cell[1:] != cell[:-1]) | (passing[1:] != passing[:-1])) + 1, [len(cell)])).tolist() if len(cell) else []
    return zip(cuts[:-1], cuts[1:], strict=True)


def _met(batches: Iterator[pa.RecordBatch], soft: float) -> Iterator[pa.RecordBatch]:
    """Rows (cell, passing, set_id, n, parity) sorted by cell, those that are held first -> pairs (t, e). What is held of one cell stays, besides the batch."""
    now, held = None, []
    for b in batches:
        cell, passing = b.column("cell").to_numpy(), b.column("passing").to_numpy()
        for x, y in _cuts(b):
            if cell[x] != now:
                now, held = cell[x], []
            part = _by_width(pa.RecordBatch.from_arrays([pa.concat_arrays([b.column(c).slice(x, y - x)]) for c in ("set_id", "n", "parity")], names=["set_id", "n", "parity"]))
            if not passing[x]:
                held.append(part)
                continue
            for mine in held:
                for t in mine.values():
                    for e in part.values():
                        for u, v in alike(t, e, soft):
                            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["t", "e"])


def exact_pairs(train: DataFrame, evaluation: DataFrame, soft: float = SOFT, hard: float = HARD, k: int = 5, most: int = FREQUENT) -> DataFrame:
    """(eval_doc_id, train_doc_id, jaccard, tier) of all pairs at or above soft; most: FREQUENT."""
    _checked(soft, hard)
    sides = {"t": _sketch(train, k), "e": _sketch(evaluation, k)}
    n = F.col("n")
    classes = {"t": F.array(length_class(n, soft)), "e": F.sequence(length_class(n * soft - 1e-9, soft), length_class(n / soft + 1e-9, soft))}
    dealt = {x: sets.select("set_id", "n", "parity", F.explode(classes[x]).alias("class")) for x, (_, sets) in sides.items()}
    # blocks of each class on both sides; a class that one side lacks has no cells
    size = {x: d.groupBy("class").agg(F.ceil(F.count(F.lit(1)) / F.lit({"t": HELD, "e": PASSING}[x])).cast("int").alias(f"{x}_blocks")) for x, d in dealt.items()}
    blocks = stored(size["t"].join(size["e"], "class"))
    rows = None
    for x, other in (("t", "e"), ("e", "t")):
        mine = F.pmod(F.xxhash64("set_id"), F.col(f"{x}_blocks")).cast("int")
        each = dealt[x].join(blocks, "class").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
        at = F.xxhash64("class", *(("mine", "other") if x == "t" else ("other", "mine")))
        part = each.select(at.alias("cell"), F.lit(int(x == "e")).alias("passing"), "set_id", "n", "parity")
        rows = part if rows is None else rows.unionByName(part)
    partitions = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = rows.repartition(partitions, "cell").sortWithinPartitions("cell", "passing").mapInArrow(partial(_met, soft=soft), "t long, e long")
    return _compared(stored(met.distinct()), sides, {"t": train, "e": evaluation}, soft, hard, k)


#: Of the MinHash signature: bands, and rows of each. A pair at SOFT misses all bands once in 290 times; of those at 0.3 one in 115 meets.
BANDS, ROWS = 12, 6


def lsh_pairs(train: DataFrame, evaluation: DataFrame, soft: float = SOFT, hard: float = HARD, bands: int = BANDS, rows: int = ROWS, k: int = 5) -> DataFrame:
    """(eval_doc_id, train_doc_id, jaccard, tier) of pairs that meet in a band of their MinHash signatures.

    The similarity of what meets is exact, so only recall depends on the bands.
    """
    _checked(soft, hard)
    seeds = np.random.RandomState(7).randint(1, 1 << 62, bands * rows, dtype=np.int64)

    def keys(s: np.ndarray) -> list:
        if not len(s):
            return [[]]
        least = minima(s, seeds).reshape(bands, rows)
        return [[int.from_bytes(hashlib.blake2b(bytes([b]) + least[b].tobytes(), digest_size=8).digest(), "little", signed=True) for b in range(bands)]]

    sides = {"t": _sketch(train, k, "keys array<long>", keys), "e": _sketch(evaluation, k, "keys array<long>", keys)}
    docs = {"t": train, "e": evaluation}
    of_key = {x: sets.select(F.explode("keys").alias("key"), "set_id") for x, (_, sets) in sides.items()}
    # a key that one side lacks has no cells, and only sets that have one of the others go on
    size = {x: d.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit({"t": HELD, "e": PASSING}[x])).cast("int").alias(f"{x}_blocks")) for x, d in of_key.items()}
    blocks = stored(size["t"].join(size["e"], "key"))
    rows = None
    for x, other in (("t", "e"), ("e", "t")):
        mine = F.pmod(F.xxhash64("set_id"), F.col(f"{x}_blocks")).cast("int")
        each = of_key[x].join(blocks, "key").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
        at = F.xxhash64("key", *(("mine", "other") if x == "t" else ("other", "mine")))
        part = each.select(at.alias("cell"), F.lit(int(x == "e")).alias("passing"), "key", "set_id").join(sides[x][1].select("set_id", "n", "parity", "keys"), "set_id")
        rows = part if rows is None else rows.unionByName(part)
    partitions = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = "cell long, passing int, key long, set_id long"
    met = rows.repartition(partitions, "cell").sortWithinPartitions("cell", "passing").mapInArrow(partial(_meeting, soft=soft), f"{kinds}, n long")
    wanted = stored(met.distinct())
    release(train.sparkSession)

    # cells again, of what may be similar to something in its cell, cut by the shingles that a task holds; each text once a cell
    blocks = stored(wanted.filter("passing = 0").groupBy("cell").agg(F.ceil(F.sum("n") / F.lit(SHINGLES)).cast("int").alias("blocks")))
    rows = None
    for passing, x in enumerate(sides):
        here = wanted.filter(F.col("passing") == passing).join(blocks, "cell")
        mine = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int") if x == "t" else F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        here = here.withColumn("block", mine).select(F.xxhash64("cell", "block").alias("cell"), "passing", "key", "set_id")
        texts = _texts(wanted.filter(F.col("passing") == passing).select("set_id"), sides[x][1], docs[x]).join(sides[x][1].select("set_id", "keys"), "set_id")
        part = here.join(texts, "set_id")
        rows = part if rows is None else rows.unionByName(part)
    release(train.sparkSession)
    near = rows.repartition(partitions, "cell").sortWithinPartitions("cell", "passing").mapInArrow(partial(_similar_in, soft=soft, k=k), "t long, e long, jaccard double")
    return _expanded(stored(near), sides, hard)


def _matrix(b: pa.RecordBatch, x: int, y: int) -> np.ndarray:
    """The keys of rows x to y, a row each."""
    return b.column("keys").slice(x, y - x).flatten().to_numpy().reshape(y - x, -1)


def _first_here(t: np.ndarray, e: np.ndarray, key: int) -> np.ndarray:
    """Whether key is the first that t and e, row by row, have in common: a pair counts in one of the cells in which it meets."""
    return t[np.arange(len(t)), np.argmax(t == e, axis=1)] == key


def _grouped(parities: list[np.ndarray], n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, n, parities) of the rows with each number of words, by size."""
    order = np.argsort(n, kind="stable")
    width = np.array([len(p) for p in parities])[order]
    return [(at := order[width == w], n[at], np.array([parities[i] for i in at])) for w in set(width.tolist())]


def _few(held: dict, passing: dict, key: int, soft: float) -> Iterator[tuple[int, int]]:
    """What alike() and _first_here() give, pair by pair."""
    for i, p in enumerate(held["parities"]):
        for j, q in enumerate(passing["parities"]):
            n, m = int(held["n"][i]), int(passing["n"][j])
            if min(n, m) >= max(n, m) * soft - 1e-9 and held["keys"][i][(held["keys"][i] == passing["keys"][j]).argmax()] == key:
                a, b = (p, q) if len(p) == len(q) else (folded(x[None], min(len(p), len(q)))[0] for x in (p, q))
                if np.bitwise_count(a ^ b).sum(dtype=np.int64) <= (n + m) * ((1 - soft) / (1 + soft)) + 1e-6:
                    yield i, j


def _meeting(batches: Iterator[pa.RecordBatch], soft: float) -> Iterator[pa.RecordBatch]:
    """Rows (cell, passing, key, set_id, n, parity, keys) sorted by cell, those that are held first -> those that sizes and parities allow with another of the cell."""
    now, held = None, []
    for b in batches:
        cells, key, ids, n = (b.column(c).to_numpy() for c in ("cell", "key", "set_id", "n"))
        keys, offsets, values, wanted = _matrix(b, 0, len(b)), b.column("parity").offsets.to_numpy(), b.column("parity").values.to_numpy().view(np.uint64), []
        for x, y in _cuts(b):
            if cells[x] != now:
                now, held = cells[x], []
            parities = [values[offsets[i] : offsets[i + 1]] for i in range(x, y)]
            mine = {"id": ids[x:y], "n": n[x:y], "keys": keys[x:y], "seen": np.zeros(y - x, bool), "parities": parities}
            if not b.column("passing")[x].as_py():
                held.append(mine)
                continue
            for other in held:
                met = np.zeros(len(other["id"]), bool)
                if len(met) * (y - x) <= FEW:  # as in most cells
                    for i, j in _few(other, mine, key[x], soft):
                        met[i] = mine["seen"][j] = True
                else:
                    for who in (other, mine):
                        who["groups"] = who.get("groups") or _grouped(who["parities"], who["n"])
                    for t in other["groups"]:
                        for e in mine["groups"]:
                            for i, j in alike(t, e, soft):
                                first = _first_here(other["keys"][i], mine["keys"][j], key[x])
                                met[i[first]] = mine["seen"][j[first]] = True
                new = met & ~other["seen"]
                other["seen"][new] = True
                wanted.append((cells[x], 0, key[x], other["id"][new], other["n"][new]))
            wanted.append((cells[x], 1, key[x], mine["id"][mine["seen"]], mine["n"][mine["seen"]]))
        wanted = [w for w in wanted if len(w[3])]
        if wanted:
            times = [len(w[3]) for w in wanted]
            flat = [pa.array(np.repeat(np.array([w[c] for w in wanted], kind), times)) for c, kind in enumerate((np.int64, np.int32, np.int64))]
            yield pa.RecordBatch.from_arrays([*flat, *[pa.array(np.concatenate([w[c] for w in wanted])) for c in (3, 4)]], names=["cell", "passing", "key", "set_id", "n"])


def _similar_in(batches: Iterator[pa.RecordBatch], soft: float, k: int) -> Iterator[pa.RecordBatch]:
    """Rows (cell, passing, key, set_id, text, keys) sorted by cell, those that are held first -> (t, e, jaccard) of the similar pairs whose first common key is the cell's."""
    now, held, known = None, [], None
    for b in batches:
        passing, ids, texts, found = b.column("passing").to_numpy(), b.column("set_id").to_numpy(), b.column("text"), []
        for x, y in _cuts(b):
            cell, key = b.column("cell")[x].as_py(), b.column("key")[x].as_py()
            if cell != now:
                now, held, known = cell, [], None
            keys = _matrix(b, x, y)
            if not passing[x]:
                held += [(ids[i], shingle_set(texts[i].as_py(), k), keys[i - x]) for i in range(x, y)]
                continue
            if known is None and held:
                known = np.unique(np.concatenate([s for _, s, _ in held]))
                held = [(t, np.searchsorted(known, s).astype(np.int32), own) for t, s, own in held]
            sets: list[np.ndarray] = []
            lo = x
            for i in range(x, y if held else x):
                sets.append(shingle_set(texts[i].as_py(), k))
                if i + 1 == y or sum(map(len, sets)) >= TOGETHER:
                    found += _common(held, known, ids[lo : i + 1], sets, keys[lo - x : i + 1 - x], key, soft)
                    lo, sets = i + 1, []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[c] for f in found])) for c in range(3)], names=["t", "e", "jaccard"])


def _common(held: list[tuple], known: np.ndarray, ids: np.ndarray, sets: list[np.ndarray], keys: np.ndarray, key: int, soft: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(t, e, jaccard) of what is held with these sets: of all sets that fit one in size, the shingles that it has are counted at once."""
    n = np.array([len(s) for s in sets])
    order = np.argsort(n, kind="stable")
    n, ids, keys, flat = n[order], ids[order], keys[order], np.concatenate([sets[i] for i in order])
    place = np.minimum(np.searchsorted(known, flat), len(known) - 1)
    place = np.where(known[place] == flat, place, len(known)).astype(np.int32)
    starts, has = np.concatenate(([0], np.cumsum(n))), np.zeros(len(known) + 1, np.int32)
    for t, mine, own in held:
        lo, hi = int(np.searchsorted(n, math.floor(len(mine) * soft))), int(np.searchsorted(n, math.ceil(len(mine) / soft), "right"))
        if lo >= hi:
            continue
        has[mine] = 1
        common = np.add.reduceat(has[place[starts[lo] : starts[hi]]], starts[lo:hi] - starts[lo])
        has[mine] = 0
        jaccard = common / (len(mine) + n[lo:hi] - common)
        at = np.flatnonzero(jaccard >= soft)
        at = at[_first_here(np.broadcast_to(own, (len(at), len(own))), keys[lo + at], key)]
        if len(at):
            yield np.full(len(at), t), ids[lo + at], jaccard[at]


def _folded(c: str, words: Column) -> Column:
    """folded() as an expression, for joins of sets: of each word and those that lie a multiple of `words` behind it, which of the bits are set an odd number of times."""
    p = F.col(c)
    fold = F.transform(F.sequence(F.lit(0), words - 1), lambda i: F.aggregate(F.sequence(i, F.size(p) - 1, words), F.lit(0).cast("long"), lambda x, j: x.bitwiseXOR(F.get(p, j))))
    return F.when(F.size(p) == words, p).otherwise(fold)


def _checked(soft: float, hard: float) -> None:
    if hard < soft:
        raise ValueError("the hard threshold is below the soft one")
    if not 0 < soft <= 1:
        raise ValueError("a similarity is above 0 and at most 1")


def _similar(batches: Iterator[pa.RecordBatch], soft: float, k: int) -> Iterator[pa.RecordBatch]:
    """Pairs with their texts, sorted by t -> those that are similar enough, with their similarity."""
    now, one = None, np.zeros(0, np.int64)
    for b in batches:
        keep, found = [], []
        for i, (t, e_text) in enumerate(zip(b.column("t").to_pylist(), b.column("e_text"), strict=True)):
            if t != now:
                now, one = t, shingle_set(b.column("t_text")[i].as_py(), k)
            other = shingle_set(e_text.as_py(), k)
            common = len(np.intersect1d(one, other, assume_unique=True))
            if (jaccard := common / (len(one) + len(other) - common)) >= soft:
                keep.append(i)
                found.append(jaccard)
        yield pa.RecordBatch.from_arrays([*b.select(["t", "e"]).take(pa.array(keep, pa.int64())).columns, pa.array(found, pa.float64())], names=["t", "e", "jaccard"])


def _texts(wanted: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(set_id, text) of the sets that are wanted: the texts are read again, one document for each; stored."""
    here = sets.join(wanted.distinct(), "set_id", "left_semi").select("set_id", "text_hash")
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").join(here.select("text_hash"), "text_hash", "left_semi")
    texts = texts.groupBy("text_hash").agg(F.first("text").alias("text")).join(here, "text_hash")
    release(docs.sparkSession)
    return stored(texts.select("set_id", _spaced(mask_identity(F.col("text"))).alias("text")))


def _compared(pairs: DataFrame, sides: dict[str, tuple[DataFrame, DataFrame]], docs: dict[str, DataFrame], soft: float, hard: float, k: int) -> DataFrame:
    """The pairs of documents whose sets (t, e; stored) are similar enough, by their shingles."""
    near = pairs
    for x, (_, sets) in sides.items():
        near = near.join(_texts(pairs.select(F.col(x).alias("set_id")), sets, docs[x]).withColumnsRenamed({"set_id": x, "text": f"{x}_text"}), x)
    release(pairs.sparkSession)
    near = near.select("t", "e", "t_text", "e_text").sortWithinPartitions("t").mapInArrow(partial(_similar, soft=soft, k=k), "t long, e long, jaccard double")
    return _expanded(stored(near), sides, hard)


def _expanded(near: DataFrame, sides: dict[str, tuple[DataFrame, DataFrame]], hard: float) -> DataFrame:
    """The pairs of documents of similar sets (t, e, jaccard; stored)."""
    release(near.sparkSession)
    for x, name in (("t", "train_doc_id"), ("e", "eval_doc_id")):
        near = near.join(sides[x][0].select(F.col("doc_id").alias(name), F.col("set_id").alias(x)), x)
    return near.select("eval_doc_id", "train_doc_id", "jaccard", F.when(F.col("jaccard") >= hard, "hard").otherwise("soft").alias("tier"))
