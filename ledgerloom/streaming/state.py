"""The latest correction of each field, kept as a stream's state.

Deliveries may come late, out of order and more than once. Of a field's corrections that with the largest submitted_at
counts, of equal ones that with the smallest ordinal; so a repeat changes nothing, and nor does an older one. What a batch
changes is written under the batch's number, so a batch that runs again replaces what it wrote.

Without `keep` every key is kept, by an aggregate in the JVM. With it, a key whose latest correction lies `keep` behind the
watermark is forgotten by a timer, which bounds the state; rows behind the watermark are dropped by the engine, so no
older row of a forgotten key can come back as its latest.

Defined cases: a null submitted_at is before every other; null keys are keys; an empty stream writes nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ledgerloom.operators.corrections import KEY

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Latest(StatefulProcessor):
    """Holds a key's latest row, and a timer at which it is forgotten."""

    def __init__(self, value: StructType, at: str, keep_ms: int):
        self.value, self.at, self.keep_ms = value, at, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("latest", self.value)

    @staticmethod
    def _rank(row) -> tuple:
        return (row["submitted_at"] is not None, row["submitted_at"] or "", -row["ordinal"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = self.value.fieldNames()
        was = dict(zip(names, self.held.get(), strict=True)) if self.held.exists() else None
        best = was
        for r in rows:
            row = {n: r[n] for n in names}
            if best is None or self._rank(row) > self._rank(best):
                best = row
        if best is was:
            return
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if best[self.at] is not None:
            self.handle.registerTimer(int(best[self.at].timestamp() * 1000) + self.keep_ms)
        self.held.update(tuple(best[n] for n in names))
        yield Row(**dict(zip(KEY, key, strict=True)), **best)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


@contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state needs, for a query that starts inside; the session's setting is back afterwards."""
    key = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(key)
    spark.conf.set(key, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(key, was)


def changes(stream: DataFrame, at: str | None = None, keep_ms: int | None = None, delay: str = "0 seconds") -> DataFrame:
    """The rows of a batch that are now the latest of their key (extraction_id, field_id, submitted_at, ordinal and others).

    keep_ms and at: how long after its event time `at` (a timestamp column) a latest row is kept; delay: the watermark's.
    """
    rest = [c for c in stream.columns if c not in KEY]
    if keep_ms is None:
        best = F.max_by(F.struct(*rest), F.struct(F.col("submitted_at"), -F.col("ordinal")))
        return stream.groupBy(*KEY).agg(best.alias("best")).select(*KEY, "best.*").select(*stream.columns)
    if at is None:
        raise ValueError("keep_ms needs the event time column")
    # the state's columns are also asked for in a Python process of the driver that has none of the executors' packages
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    value = StructType([stream.schema[c] for c in rest])
    out = StructType([*(stream.schema[c] for c in KEY), *value.fields])
    grouped = stream.withWatermark(at, delay).groupBy(*KEY)
    # the output is a row as it came, so its time is no event time of what follows
    return grouped.transformWithState(Latest(value, at, keep_ms), out, "Update", "EventTime").select(*stream.columns)


def fold_stream(stream: DataFrame, out: str, checkpoint: str, at: str | None = None, keep_ms: int | None = None, delay: str = "0 seconds", once: bool = True) -> StreamingQuery:
    """Writes each batch's changes below out/batch=N; folded() reads them. once: takes what is there and ends."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    with _rocks(stream.sparkSession):
        writer = changes(stream, at, keep_ms, delay).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="60 seconds")).start()


def folded(spark: SparkSession, out: str) -> DataFrame:
    """The last row that was written for each key."""
    rows = spark.read.parquet(out)
    rest = [c for c in rows.columns if c not in (*KEY, "batch")]
    return rows.groupBy(*KEY).agg(F.max_by(F.struct(*rest), "batch").alias("last")).select(*KEY, "last.*")
