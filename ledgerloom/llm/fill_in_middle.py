"""Fill-in-the-middle texts on ropes.

A text is cut into units: a word with the white space before it, and white space at the end. A rope is a balanced tree over
pieces of a text; every node caches its units and its code points. The text's rope is split at two unit ranks, the three
subtrees are joined in another order with sentinels between them, and the output is read off the leaves. restored() goes
back: it finds the sentinels in the leaves of the output's rope, splits that at their code points, and joins the three
subtrees in the text's order.

Places and forms come from the SHA-256 of `seed:doc_id`: its first four 32-bit groups are the two cuts, the choice whether
a text is rearranged, and that of the form. spm is suffix, prefix, middle; psm is prefix, suffix, middle.

Defined cases: a null text is the empty text; texts that are empty or hold a sentinel stay plain, and so are their own
output; a null doc_id is the empty string where it is hashed; rows are independent, so repeated rows give equal rows;
other columns are ignored; an empty table gives no rows. A text is held once by its task, and its rope holds slices of it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_batches, stored

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Parts of the text in the order in which a form writes them, each behind its sentinel.
ORDERS = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
#: Units of a leaf, and the share in percent of texts that are rearranged, and of those that become spm.
LEAF, RATE, SPM_RATE, SEED = 256, 50, 80, 42
#: Bytes of an Arrow batch.
BATCH = 4 << 20

_WORDS = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++)"
_LEAF = re.compile(rf"{_WORDS}{{1,{LEAF}}}+|[\x20\x09-\x0D]+")
_UNIT = re.compile(rf"{_WORDS}|[\x20\x09-\x0D]+")

ROW = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True, slots=True)
class Rope:
    """A leaf (a text) or a node of two ropes, with its units, code points and height."""

    units: int
    chars: int
    height: int = 0
    text: str = ""
    left: Rope | None = None
    right: Rope | None = None


EMPTY = Rope(0, 0)


def _node(a: Rope, b: Rope) -> Rope:
    return Rope(a.units + b.units, a.chars + b.chars, 1 + max(a.height, b.height), "", a, b)


def join(a: Rope, b: Rope) -> Rope:
    """a followed by b; heights of siblings differ by two at most, so the tree stays logarithmic."""
    if not a.chars or not b.chars:
        return a if a.chars else b
    if a.height > b.height + 1:
        tail = join(a.right, b)
        if tail.height <= a.left.height + 1:
            return _node(a.left, tail)
        return _node(_node(a.left, tail.left), tail.right)
    if b.height > a.height + 1:
        head = join(a, b.left)
        if head.height <= b.right.height + 1:
            return _node(head, b.right)
        return _node(head.left, _node(head.right, b.right))
    return _node(a, b)


def rope(text: str) -> Rope:
    """A balanced rope; leaves end between units."""
    level = []
    for m in _LEAF.finditer(text):
        s = m.group()
        level.append(Rope(sum(1 for _ in _UNIT.finditer(s)) if m.end() == len(text) or s.isspace() else LEAF, len(s), 0, s))
    # only the last run of words can be shorter than a leaf; white space at the end may follow it
    if len(level) > 1 and level[-1].units == 1:
        level[-2] = Rope(sum(1 for _ in _UNIT.finditer(level[-2].text)), level[-2].chars, 0, level[-2].text)
    while len(level) > 1:
        level = [_node(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else EMPTY


def split(r: Rope, at: int, by_chars: bool = False) -> tuple[Rope, Rope]:
    """The first `at` units (or code points) and the rest."""
    size = r.chars if by_chars else r.units
    if at <= 0 or at >= size:
        return (EMPTY, r) if at <= 0 else (r, EMPTY)
    if r.left is None:
        end = at
        if not by_chars:
            ends = _UNIT.finditer(r.text)
            end = next(m.end() for k, m in enumerate(ends, 1) if k == at)
        units = sum(1 for _ in _UNIT.finditer(r.text[:end])) if by_chars else at
        return Rope(units, end, 0, r.text[:end]), Rope(r.units - units, r.chars - end, 0, r.text[end:])
    mine = r.left.chars if by_chars else r.left.units
    if at <= mine:
        a, b = split(r.left, at, by_chars)
        return a, join(b, r.right)
    a, b = split(r.right, at - mine, by_chars)
    return join(r.left, a), b


def leaves(r: Rope) -> Iterator[str]:
    todo = [r]
    while todo:
        x = todo.pop()
        if x.left is None:
            yield x.text
        else:
            todo += (x.right, x.left)


def _mark(s: str) -> Rope:
    return Rope(1, len(s), 0, s)


def arrange(text: str, doc_id: str, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[int, str, Rope, Rope | None, Rope]:
    """Units, form, prefix and middle (None if plain) and output of one text."""
    whole = rope(text)
    h = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or h3 % 100 >= rate or any(s in text for s in SENTINELS):
        return whole.units, PLAIN, EMPTY, None, whole
    form, (low, high) = SPM if h4 % 100 < spm_rate else PSM, sorted((h1 % (whole.units + 1), h2 % (whole.units + 1)))
    prefix, rest = split(whole, low)
    middle, suffix = split(rest, high - low)
    part = {PREFIX: prefix, SUFFIX: suffix, MIDDLE: middle}
    return whole.units, form, prefix, middle, reduce(join, (x for s in ORDERS[form] for x in (_mark(s), part[s])), EMPTY)


def restore(output: str, form: str) -> str:
    """The text that arrange() made the output of."""
    if form == PLAIN:
        return output
    whole, at, found = rope(output), 0, {}
    for leaf in leaves(whole):  # a sentinel has no white space, so it lies within a leaf
        found |= {s: at + k for s in SENTINELS if (k := leaf.find(s)) >= 0}
        at += len(leaf)
    part, end = {}, whole.chars
    for s in reversed(ORDERS[form]):
        whole, tail = split(whole, found[s], True)
        part[s] = split(tail, len(s), True)[1]
        if part[s].chars != end - found[s] - len(s):
            raise ValueError("the sentinels are not in the order of the form")
        end = found[s]
    return "".join(leaves(join(join(part[PREFIX], part[MIDDLE]), part[SUFFIX])))


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n (units), form, code points of prefix and middle (null if plain), and the output text of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                n, form, prefix, middle, out = arrange(text or "", "" if doc_id is None else str(doc_id), seed, rate, spm_rate)
                rows.append((doc_id, n, form, *((None, None) if middle is None else (prefix.chars, middle.chars)), text or "" if middle is None else "".join(leaves(out))))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=[x.split()[0] for x in ROW.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, ROW)


def restored(moved: DataFrame) -> DataFrame:
    """transform()'s rows with `restored`, the text made from output and form alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            back = [restore(o, f) for o, f in zip(b.column("output").to_pylist(), b.column("form").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(back, pa.string())], names=[*b.schema.names, "restored"])

    return moved.mapInArrow(work, ROW + ", restored string")


def digests(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """transform()'s rows with SHA-256 of the output and of the text restored from it in place of the texts; a stored table."""
    with arrow_batches(docs.sparkSession, 1024, BATCH):
        both = restored(transform(docs, seed, rate, spm_rate))
        sha = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
        return stored(both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output"), sha("restored")))
