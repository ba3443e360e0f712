"""Mix sources to target weights by hash-threshold histograms (DataFrame functions only).

A source's target buys whole copies of the source first; what remains is bought with a hash threshold: every row
has a fixed 36-bit hash, and the rows below the source's threshold are taken once more. The hash is of doc_id, source and
text; rows equal in these are numbered, and the number is hashed too. They are numbered by the input's partitions, whose
counts of a repeated row are summed up, so a row that a third of the table repeats is not numbered by one task. Which of them has
which number depends on the partitions, but they are the same to the mix, and the numbers as a set do not. The threshold comes from
histograms of words by (source, hash bucket): 4096 buckets first, then 4096 inside the bucket in which the budget ends,
then 4096 inside that one. No level sorts documents, every level is summed before it is shuffled, and a hot source is
therefore no hot task. The thresholds of two budgets are nested: the smaller budget's documents are among the larger's.

Defined cases: a null text has size 0; null is a source of its own, ordered last; a source without words has target 0
and takes nothing; rows without a doc_id, or of one doc_id, are taken each by itself; an empty table gives no rows;
other columns are ignored by mix() and kept by mixed() whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import met, stored, word_count

#: Bits of each of the three histogram levels.
LEVEL_BITS = 12


#: Kept apart from any column of the input.
P = "__loom_"
KEY = ["no_source", "source"]
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0


def _keyed(docs: DataFrame, p: str = "") -> DataFrame:
    """docs with the source as a key without nulls, a name that equal rows share (u), and the input partition (pid); p: what their names begin with."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    source = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    u = F.md5(F.concat(told("doc_id"), F.lit(":"), F.md5(told("text").cast("binary")), F.lit(":"), source).cast("binary"))
    return docs.withColumns({p + "no_source": F.col("source").isNull(), p + "source": F.coalesce(F.col("source"), F.lit("")), p + "u": u, p + "pid": F.spark_partition_id()})


def _numbered(rows: DataFrame, counted: DataFrame, p: str = "") -> DataFrame:
    """_keyed() rows with their number (nth, from 1) among those of their name. counted: the names that repeat, a stored table."""
    if counted.isEmpty():
        return rows.withColumn(p + "nth", F.lit(1).cast("long"))
    u, pid, again = p + "u", p + "pid", p + "again"
    full = met(rows, counted.select(F.col("u").alias(u), F.lit(True).alias(again)), u, F.xxhash64(pid), "left")
    alone = full.filter(F.col(again).isNull()).drop(again).withColumn(p + "nth", F.lit(1).cast("long"))
    repeated = stored(full.filter(F.col(again)).drop(again))  # the partitions' numbers are fixed from here on
    upto = Window.partitionBy(u).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)  # a row for each name and partition
    before = repeated.groupBy(u, pid).agg(F.count(F.lit(1)).alias("n")).select(u, pid, F.coalesce(F.sum("n").over(upto), F.lit(0)).alias(p + "before"))
    mine = F.row_number().over(Window.partitionBy(u, pid).orderBy(F.lit(1)))
    rest = repeated.withColumn(p + "mine", mine).join(before, [u, pid]).withColumn(p + "nth", (F.col(p + "before") + F.col(p + "mine")).cast("long"))
    return alone.unionByName(rest.select(*alone.columns))


def _repeated(keyed: DataFrame) -> DataFrame:
    """The names (u) that several rows have."""
    return stored(keyed.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u"))


def _bits(p: str = "") -> dict[str, Column]:
    """The three 12-bit parts of the row's hash."""
    h = F.conv(F.substring(F.md5(F.concat(F.col(p + "u"), F.lit(":"), F.col(p + "nth").cast("string")).cast("binary")), 1, 9), 16, 10).cast("long")
    return {f"{p}b{k}": F.shiftright(h, LEVEL_BITS * (2 - k)).bitwiseAND((1 << LEVEL_BITS) - 1).cast("int") for k in range(3)}


def sized(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, source key, hash parts and words of every row, and the names that repeat; both stored."""
    keyed = _keyed(docs.select("doc_id", "text", "source"))
    base = stored(keyed.select("doc_id", *KEY, "u", "pid", word_count(F.col("text")).alias("size")))
    counted = _repeated(base)
    return stored(_numbered(base, counted).withColumns(_bits()).select("doc_id", *KEY, "b0", "b1", "b2", "size")), counted


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Targets of sources (no_source, source, source_size): share of all words, by weight, at most `most` times a source.

    Resharing the excess by weight ends at one level: an uncapped source gets level * weight. With the sources ordered
    by cap / weight the level is read off running sums. One row per source, so the global windows are small.
    """
    by_name = Window.orderBy("no_source", "source")
    by_ratio = Window.orderBy("ratio", "no_source", "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = (
        sources.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", w)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = (
        ranked.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
        .withColumn("level", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
        .withColumn("level", F.max("level").over(everything))
    )
    return levels.select("no_source", "source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def _boundary(hist: DataFrame, bucket: str, last: bool) -> DataFrame:
    """Where the budget `rest` ends in a histogram (no_source, source, rest, bucket, words): the bucket and what is left.

    On the last level the boundary bucket is taken or left whole, whichever ends nearer to the budget.
    """
    upto = Window.partitionBy("no_source", "source").orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    run = hist.withColumn("upto", F.sum("words").over(upto)).withColumn("before", F.col("upto") - F.col("words"))
    taken = (F.col("upto") - F.col("rest") < F.col("rest") - F.col("before")) if last else F.lit(False)
    over = run.filter(F.col("upto") > F.col("rest"))
    first = F.min_by(F.struct(F.col(bucket), F.col("before"), F.col("rest"), taken.alias("whole")), F.col(bucket))
    got = over.groupBy("no_source", "source").agg(first.alias("at"))
    cut = F.col(f"at.{bucket}") + F.col("at.whole").cast("int")
    return got.select("no_source", "source", cut.alias(f"cut_{bucket}"), (F.col("at.rest") - F.col("at.before")).alias("rest"))


def plan(base: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """For each source of sized() rows: its size, target, whole copies, and the hash below which one more is taken."""
    hist = stored(base.groupBy(*KEY, "b0").agg(F.sum("size").alias("words")))
    goals = stored(targets(hist.groupBy(*KEY).agg(F.sum("words").alias("source_size")), weights, share, most))
    goals = goals.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goals = goals.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    cut0 = stored(_boundary(hist.join(goals.select(*KEY, "rest"), KEY), "b0", False))
    level1 = base.join(cut0.withColumnRenamed("cut_b0", "b0"), [*KEY, "b0"]).groupBy(*KEY, "rest", "b1").agg(F.sum("size").alias("words"))
    cut1 = stored(cut0.select(*KEY, "cut_b0").join(_boundary(level1, "b1", False), KEY))
    level2 = base.join(cut1.select(*KEY, F.col("cut_b0").alias("b0"), F.col("cut_b1").alias("b1"), "rest"), [*KEY, "b0", "b1"])
    level2 = level2.groupBy(*KEY, "rest", "b2").agg(F.sum("size").alias("words"))
    cuts = cut1.drop("rest").join(_boundary(level2, "b2", True).drop("rest"), KEY)
    return stored(goals.join(cuts, KEY, "left"))


def _copies() -> Column:
    below = F.struct("b0", "b1", "b2") < F.struct("cut_b0", "cut_b1", "cut_b2")
    return F.col("copies") + F.when(F.col("cut_b0").isNotNull() & below, F.lit(1)).otherwise(F.lit(0))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken: copies are whole documents, at most ceil(most) of each."""
    base, _ = sized(docs)
    out = base.join(plan(base, weights, share, most), KEY)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix itself: the rows of docs with all their columns, each as often as it is taken."""
    base, counted = sized(docs)
    full = plan(base, weights, share, most)
    full = full.select(*[F.col(c).alias(P + c) for c in full.columns])
    keyed = _numbered(_keyed(docs, P), counted, P).withColumns(_bits(P))
    times = F.expr(f"{P}copies + if({P}cut_b0 is not null and struct({P}b0, {P}b1, {P}b2) < struct({P}cut_b0, {P}cut_b1, {P}cut_b2), 1, 0)")
    joined = keyed.join(full, [P + k for k in KEY]).withColumn(P + "times", times).filter(F.col(P + "times") > 0)
    return joined.withColumn(P + "one", F.explode(F.array_repeat(F.lit(0), F.col(P + "times").cast("int")))).select(*docs.columns)
