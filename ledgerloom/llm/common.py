"""Helpers that the corpus operators share: words, shared storage, Arrow batches, columns whose names clash.

Defined cases: a null text has no words; a null doc_id counts as the empty text where ids are hashed.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.shared import shared_root

#: A word is a longest run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Names that the operators give to columns of their own begin so.
OWN = "__loom_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, by: str | None = None, path: str | None = None) -> DataFrame:
    """df written as Parquet in the shared folder and read back: lineage is cut, a lost executor costs nothing.

    The files' size then also tells the planner whether a join may broadcast this side. by: a column whose values get folders
    of their own, so that a filter on it reads one of them. path: where to, a new folder below `ledgerloom` if not said.
    """
    spark = df.sparkSession
    path = path or f"{shared_root(spark)}/ledgerloom/{uuid.uuid4().hex}"
    schema = df.schema
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame, part: str = "") -> None:
    """Delete the files that a stored() table is read from, or only those in folders whose path ends with `part`."""
    spark = df.sparkSession
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        if "/ledgerloom/" in f and f.endswith(part):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished stages; useful after stored()."""
    spark.sparkContext._jvm.System.gc()


def size_setting(spark: SparkSession, key: str) -> int:
    """A setting in bytes, or a plain number, in any of the spellings that Spark takes: 64m, 64mb, 67108864b, -1."""
    text = spark.conf.get(key).strip()
    try:
        return int(text)
    except ValueError:
        return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Bound the rows and bytes of an Arrow batch while eager work runs, never above the user's bounds, which are back afterwards.

    Plans that run later have the user's bounds; Spark's own one on bytes is 64 MB.
    """
    bounds = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    users = {key: spark.conf.get(key) for key in bounds}
    for key, most in bounds.items():
        own = size_setting(spark, key)
        spark.conf.set(key, str(min(most, own) if own > 0 else most))
    try:
        yield
    finally:
        for key, own in users.items():
            spark.conf.set(key, own)


#: Rows of a table of sums or choices, one a key, up to which it is broadcast, and tasks that a key is dealt to beyond that.
BROADCAST_ROWS, SALT = 100_000, 32


def met(rows: DataFrame, groups: DataFrame, key: str, spread: Column, how: str = "inner") -> DataFrame:
    """rows with the other columns of a stored table that has one short row for each key; null is a key.

    Up to BROADCAST_ROWS rows of that table are counted and then broadcast. A longer one takes part SALT times in a merge join, to
    which the rows of a key are dealt by `spread`, so a key that holds many rows is no hot task.
    """
    g = groups.withColumnRenamed(key, OWN + "key")
    same = rows[key].eqNullSafe(g[OWN + "key"])
    if groups.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(g), same, how).drop(OWN + "key")
    dealt = rows.withColumn(OWN + "salt", F.pmod(spread, F.lit(SALT)).cast("int"))
    g = g.withColumn(OWN + "of", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))).hint("merge")
    return dealt.join(g, same & (dealt[OWN + "salt"] == g[OWN + "of"]), how).drop(OWN + "key", OWN + "salt", OWN + "of")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def word_count(text: Column) -> Column:
    """Words in text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def doc_crc(doc_id: Column) -> Column:
    """crc32 of doc_id as decimal text; null counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def shielded(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that works also where columns of its input are named like the operators' own: they have other names inside."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str, **parameters: object) -> DataFrame:
        inside = {c: f"__shield_{i}_{c}" for i, c in enumerate(docs.columns) if c.lower().startswith(OWN)}
        out = stage(spark, docs.withColumnsRenamed(inside) if inside else docs, sf_dir, **parameters)
        return out.withColumnsRenamed({v: k for k, v in inside.items()}) if inside else out

    return run
