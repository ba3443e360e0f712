"""Drop lines that repeat an earlier line up to one edit, by a deletion-neighbourhood join (DataFrame functions only).

Lines are compared without leading and trailing spaces, tabs and carriage returns. A line of at least `min_chars`
characters is dropped if an equal line, or one whose first occurrence is earlier and that is one edit away, came earlier
by (doc_id, line number); the earliest stays. An edit inserts, deletes or replaces one character, in lines of any length
and any number of words. With `min_words` lines of so many words or more are also linked by the insertion, deletion or
replacement of one word (what stands between single spaces), however long. Equal lines may go from fewer characters on
(`exact_chars`). Decisions look at the input, not at what is left, so they do not depend on an order of work.

Steps. Equal lines collapse to their first occurrence, as numbers only (two 64-bit hashes, length). Two lines one edit
apart agree in their first or in their last half, cut by the shorter one's length; lines that share no half with
another line leave here, by an aggregate that is summed before its shuffle. The rest read their text again and are cut
into 16 blocks; one edit lies in one block, so lines go on only where all but one block agrees. A block of more than `FINE`
units is cut into 16 again in the same way, and so on, so very long lines cost little more than their hashes. Lines emit
the deletion variants of the last block as hashed keys: the block without its i-th unit, keyed with i, meets its
substitutions; the block itself meets those that have one unit more. Within a variant all members are compared with the
earliest only, so no pairs are made within a group: all members of a substitution's variant are one edit apart, and of a
line and its extensions only a line and an extension are. Every such pair's edit distance is verified on the texts.

The bound is one edit, and no parameter: lines that share a variant of two deletions may be four edits apart, so the
earliest would not do for a group's members, and groups (numbered lines) have no bound on their pairs.

Defined cases: a null text stays null with 0 lines; an empty text has one line, which is kept; short lines are always
kept; rows with equal doc_id and equal text share their decisions, rows with equal doc_id and other texts are ordered
by the text's hash; a null doc_id comes first; other columns are kept by dedupe_lines() whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import release, stored

#: Parts of a line, and units of a part up to which its deletion variants are made.
BLOCKS, FINE = 16, 64
#: Characters from which lines are compared for an edit.
MIN_CHARS = 20
#: Words from which the query's lines are also compared for an edit of a word.
MIN_WORDS = 8
#: Kept apart from any column of the input.
P = "__loom_"


def _norm(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _hash2(x: Column) -> list[Column]:
    """128 bits of a string as two columns: hashes under two seeds."""
    return [F.xxhash64(x), F.xxhash64(F.lit("second"), x)]


def _words(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), with x evaluated once: as the variable of a lambda."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _first(line: Column, k: Column, by_word: bool) -> Column:
    return F.call_function("substring_index", line, F.lit(" "), k) if by_word else F.substring(line, F.lit(1), k)


def _last(line: Column, n: Column, k: Column, by_word: bool) -> Column:
    return F.call_function("substring_index", line, F.lit(" "), -k) if by_word else F.substring(line, n - k + 1, k)


def _half_keys(line: Column, n: Column, by_word: bool) -> Column:
    """Keys of the halves, for partners of at least this length (base n) and for shorter ones (base n - 1); n: words or characters. Keys of words are odd."""
    keys = []
    for base in (n, n - 1):
        h = F.shiftright(base, 1)
        keys.append(F.xxhash64(F.lit("head"), F.lit(by_word), base, _first(line, h, by_word)))
        keys.append(F.xxhash64(F.lit("tail"), F.lit(by_word), base, _last(line, n, base - h, by_word)))
    return F.array(*[F.shiftleft(k, 1).bitwiseOR(F.lit(int(by_word)).cast("long")) for k in keys])


def _cut(rows: DataFrame, text: str, seed: Column) -> DataFrame:
    """(h1, by_word, more, k, size, block): a row for each block of a text of base + more units: all but the block agrees where k does; size: its words or characters.

    more: 0 for a text at its own length, 1 for one as the longer partner of texts with one unit less. The blocks are rows before they are cut, so
    Spark compiles the work; lambdas over an array of them would be interpreted.
    """
    text, base, more, by_word, j = F.col(text), F.col("base"), F.col("more"), F.col("by_word"), F.col("j")
    first = lambda x, k: F.when(by_word, _first(x, k, True)).otherwise(_first(x, k, False))
    last = lambda x, total, k: F.when(by_word, _last(x, total, k, True)).otherwise(_last(x, total, k, False))
    start, end = (F.floor(base * x / BLOCKS).cast("int") for x in (j, j + 1))
    size = end - start + more
    k = F.xxhash64(seed, by_word, base, j, first(text, start), last(text, base + more, base - end))
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
    return rows.select("h1", "by_word", "more", k.alias("k"), size.alias("size"), last(first(text, start + size), start + size, size).alias("block"))


def _shared(rows: DataFrame) -> DataFrame:
    """The rows whose k another line has, too; a line has each k once."""
    return rows.join(rows.groupBy("k").agg(F.count(F.lit(1)).alias("lines")).filter("lines > 1").select("k"), "k", "left_semi")


def _units(text: Column, size: Column, by_word: Column) -> Column:
    """Words or characters as an array. The text of no word is that of one empty word, so their number is needed."""
    return F.when(size == 0, F.array().cast("array<string>")).when(by_word, F.split(text, " ")).otherwise(F.split(text, ""))


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of units are one insertion, deletion or replacement apart, or equal."""
    apart = F.abs(F.size(a) - F.size(b))
    short, long = F.when(F.size(a) <= F.size(b), a).otherwise(b), F.when(F.size(a) <= F.size(b), b).otherwise(a)
    differ = F.zip_with(short, F.slice(long, F.lit(1), F.size(short)), lambda x, y: x != y)
    first = F.array_position(differ, F.lit(True))  # from 1; 0 if none differs
    at = F.when(first == 0, F.size(short) + 1).otherwise(first).cast("int")
    rest = lambda x, k: F.slice(x, k, F.greatest(F.size(x) - k + 1, F.lit(0)))
    return F.when(apart == 0, rest(short, at + 1) == rest(long, at + 1)).when(apart == 1, rest(short, at) == rest(long, at + 1)).otherwise(False)


def occurrences(docs: DataFrame, min_chars: int, exact_chars: int, min_words: int | None) -> DataFrame:
    """One row for each line of at least exact_chars, without its text: where it is, its hashes and, from min_chars on, its half keys."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    lines = lines.withColumn("line", _norm(F.col("raw"))).withColumn("n", F.length("line")).filter(F.col("n") >= exact_chars)
    lines = lines.withColumn("words", _words(F.col("line")))  # used many times below, so it stays a column
    line, words = F.col("line"), F.col("words")
    h1, h2 = _hash2(line)
    halves = _half_keys(line, F.col("n"), False)
    if min_words is not None:
        halves = F.when(words >= min_words, F.concat(halves, _half_keys(line, words, True))).otherwise(halves)
    halves = F.when(F.col("n") >= min_chars, halves)
    return lines.select(F.struct("doc_id", "text_hash", "line_no").alias("at"), h1.alias("h1"), h2.alias("h2"), "n", halves.alias("halves"))


def near_earlier(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """h1, h2 of the distinct lines (firsts) of which a line one edit away occurs earlier."""
    keys = firsts.select(F.explode("halves").alias("k"), "h1")
    # a line goes on only in the ways in which it shares a half: one edit of a word seldom leaves a half of the characters, and the other way round
    odd = F.col("k").bitwiseAND(F.lit(1).cast("long")) == 1
    ways = _shared(keys).select("h1", odd.alias("by_word")).distinct().groupBy("h1").agg(F.sort_array(F.collect_list("by_word")).alias("ways"))
    close = stored(ways.join(firsts.select("h1", "h2", "at", "n"), "h1"))
    release(docs.sparkSession)

    # the text of those lines, read again where they occur first
    at = close.groupBy(F.col("at.doc_id").alias(f"{P}d"), F.col("at.text_hash").alias(f"{P}t")).agg(F.collect_list(F.struct(F.col("at.line_no").alias("line_no"), "h1", "h2", "n", "ways")).alias("want"))
    here = docs.select(F.col("doc_id").alias(f"{P}d"), F.xxhash64("text").alias(f"{P}t"), "text")
    # a merge join at every size: the wanted lines grow with the input, so broadcasting them would only suit small tables
    joined = here.join(at.hint("merge"), here[f"{P}d"].eqNullSafe(at[f"{P}d"]) & (here[f"{P}t"] == at[f"{P}t"]))
    found = joined.select(here[f"{P}d"].alias("doc_id"), here[f"{P}t"].alias("text_hash"), F.split("text", "\n").alias("lines"), F.explode("want").alias("w"))
    texts = found.select("w.h1", "w.h2", "w.n", "w.ways", F.struct("doc_id", "text_hash", F.col("w.line_no").alias("line_no")).alias("at"), _norm(F.get("lines", F.col("w.line_no"))).alias("line"))
    texts = stored(texts.dropDuplicates(["h1", "h2"]))
    release(docs.sparkSession)

    words = _words(F.col("line"))
    kinds = texts.withColumn("by_word", F.explode("ways")).withColumn("units", F.when(F.col("by_word"), words).otherwise(F.col("n")))
    roles = kinds.withColumn("more", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("base", F.col("units") - F.col("more"))
    # cut once: the keys are read alone to find those that lines share
    coarse = stored(_shared(stored(_cut(roles, "line", F.lit(0).cast("long")))))
    release(docs.sparkSession)
    fine = [coarse.filter(F.col("size") <= FINE)]
    while not (coarse := coarse.filter(F.col("size") > FINE)).isEmpty():
        coarse = stored(_shared(stored(_cut(coarse.withColumn("base", F.col("size") - F.col("more")), "block", F.col("k")))))
        release(docs.sparkSession)
        fine.append(coarse.filter(F.col("size") <= FINE))
    meets = fine[0]
    for rows in fine[1:]:
        meets = meets.unionByName(rows)
    meets = meets.join(texts.select("h1", "at"), "h1")
    meets = stored(meets.withColumn("block", F.explode(F.array(_units(F.col("block"), F.col("size"), F.col("by_word"))))))
    block, spots = F.col("block"), F.when(F.size("block") > 0, F.sequence(F.lit(1), F.size("block"))).otherwise(F.array().cast("array<int>"))
    deleted = lambda i: F.concat(F.slice(block, F.lit(1), i - 1), F.slice(block, i + 1, F.size(block)))
    itself = F.array(F.struct(F.xxhash64("k", F.lit("line"), block).alias("v"), F.lit(True).alias("whole")))
    swaps = F.transform(spots, lambda i: F.struct(F.xxhash64("k", F.lit("swap"), i, deleted(i)).alias("v"), F.lit(False).alias("whole")))
    drops = F.array_distinct(F.transform(spots, lambda i: F.struct(F.xxhash64("k", F.lit("line"), deleted(i)).alias("v"), F.lit(False).alias("whole"))))
    emitted = meets.select("h1", "at", F.explode(F.when(F.col("more") == 0, F.concat(itself, swaps)).otherwise(drops)).alias("e"), "by_word").select("h1", "at", "by_word", "e.v", "e.whole")
    # (member, earliest) of each variant; of a whole line and its extensions only pairs of one of each kind are an edit apart
    shared_v = emitted.groupBy("v").agg(
        F.min(F.struct("at", "h1")).alias("first"),
        F.min(F.when(F.col("whole"), F.struct("at", "h1"))).alias("line"),
        F.min(F.when(~F.col("whole"), F.struct("at", "h1"))).alias("longer"),
        F.count(F.lit(1)).alias("members"),
    ).filter("members > 1")
    shared_v = stored(shared_v.select("v", F.when(F.col("line").isNull(), F.col("first")).otherwise(F.struct(F.lit(None).cast(shared_v.schema["first"].dataType["at"].dataType).alias("at"), F.lit(None).cast("long").alias("h1"))).alias("swap"), "line", "longer"))
    member = emitted.join(shared_v, "v")
    pick = F.when(F.col("line").isNull(), F.col("swap")).when(F.col("whole"), F.col("longer")).otherwise(F.col("line"))
    pairs = member.withColumn("p", pick).filter(F.col("p.at") < F.col("at")).select("h1", F.col("p.h1").alias("p1"), "by_word").distinct()
    # texts go through the joins, arrays of units are made behind them
    one = kinds.select("h1", "h2", "by_word", "line", "units")
    other = one.select(F.col("h1").alias("p1"), "by_word", F.col("line").alias("p_line"), F.col("units").alias("p_units"))
    verified = pairs.join(one, ["h1", "by_word"]).join(other, ["p1", "by_word"])
    units = lambda t, n: _units(F.col(t), F.col(n), F.col("by_word"))
    apart = _let(F.struct(units("line", "units").alias("a"), units("p_line", "p_units").alias("b")), lambda x: _one_edit(x["a"], x["b"]))
    return verified.filter(apart).select("h1", "h2").distinct()


def dedupe_lines(docs: DataFrame, min_chars: int = MIN_CHARS, exact_chars: int | None = None, min_words: int | None = None) -> DataFrame:
    """docs with the lines that stay as text, and n_lines, n_dropped under the names __loom_n_lines, __loom_n_dropped.

    exact_chars: characters from which equal lines go, at most min_chars, which stands for None. min_words: words from which
    lines are also linked by an edit of a word; None: by edits of a character only.
    """
    exact_chars = min_chars if exact_chars is None else min(exact_chars, min_chars)
    found = occurrences(docs.select("doc_id", "text"), min_chars, exact_chars, min_words)
    firsts = stored(found.groupBy("h1", "h2").agg(F.min("at").alias("at"), F.any_value("n").alias("n"), F.any_value("halves").alias("halves")))
    release(docs.sparkSession)
    late = near_earlier(docs.select("doc_id", "text"), firsts.filter(F.col("n") >= min_chars))
    kept = firsts.select("h1", "h2", "at").join(late, ["h1", "h2"], "left_anti")
    kept = stored(kept.groupBy(F.col("at.doc_id").alias(f"{P}d"), F.col("at.text_hash").alias(f"{P}t")).agg(F.collect_list("at.line_no").alias(f"{P}kept")))
    release(docs.sparkSession)
    mine = docs.withColumn(f"{P}text_hash", F.xxhash64(docs["text"]))
    out = mine.join(kept, mine["doc_id"].eqNullSafe(kept[f"{P}d"]) & (mine[f"{P}text_hash"] == kept[f"{P}t"]), "left")
    # as variables of lambdas the lines and the kept places are evaluated once; the work is linear in the lines but for a sort
    named = lambda c, f: F.get(F.transform(F.array(c), f), F.lit(0))
    kept_here = F.coalesce(F.col(f"{P}kept"), F.array().cast("array<int>"))

    def those(lines: Column) -> Column:
        short = F.filter(F.transform(lines, lambda x, i: F.when(F.length(_norm(x)) < exact_chars, i)), lambda i: i.isNotNull())
        return F.transform(F.array_sort(F.concat(short, kept_here)), lambda i: F.get(lines, i))

    text = mine["text"]
    both = named(F.split(text, "\n"), lambda lines: F.struct(F.size(lines).alias("all"), those(lines).alias("left")))
    out = out.withColumn(f"{P}both", F.when(text.isNotNull(), both))
    n_lines, n_left = (F.coalesce(c, F.lit(0)).cast("long") for c in (F.col(f"{P}both.all"), F.size(f"{P}both.left")))
    n_left = F.when(F.col(f"{P}both").isNull(), F.lit(0).cast("long")).otherwise(n_left)
    names = [F.array_join(F.col(f"{P}both.left"), "\n").alias("text") if c == "text" else mine[c] for c in docs.columns]
    return out.select(*names, n_lines.alias(f"{P}n_lines"), (n_lines - n_left).alias(f"{P}n_dropped"))
