"""Pushing rows to a receiver outside, so that none is lost and repeats can be told.

An outbox is a folder of two tables, by batch. Intents say what is to be sent: id, payload, and a key that is the same
whenever the id is sent. Outcomes say what became of it: sent, or dead with the reason, and after how many attempts. A row
is open while it has an intent and no outcome. Intents are written before anything is sent and outcomes after, so a
failure anywhere leaves rows open, and they are sent again under the same key: at least once each, and exactly once for a
receiver that keeps keys.

Tasks send groups of rows. A group that fails is sent again after a wait that doubles, up to a longest one; the receiver can
refuse single rows, which are dead at once; a group that fails at every attempt is dead with the last error. The dead can
be offered again under their ids with revive().

Files are sorted by id, and offer() joins its rows with the intents in their range of ids only: what it reads of the
past are the row groups that the range meets, not the whole table.

Defined cases: rows that repeat an id are one intent, that with the smallest payload; a null id is never offered; an empty
batch has no intents and is complete.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

log = logging.getLogger(__name__)

SENT, DEAD = "sent", "dead"
#: Given rows (id, key, payload), gives a reason for each row that the receiver refuses and None for the others; raises where the call failed.
Send = Callable[[list[dict]], list[str | None]]


@dataclass(frozen=True)
class Retry:
    """Attempts of a group, and seconds before the second one, which double up to the longest wait."""

    attempts: int = 5
    first_wait: float = 1.0
    longest_wait: float = 60.0

    def wait(self, failed: int) -> float:
        return min(self.first_wait * 2 ** (failed - 1), self.longest_wait)


class Outbox:
    def __init__(self, spark: SparkSession, folder: str, id_type: str = "string"):
        self.spark, self.folder, self.id_type = spark, folder.rstrip("/"), id_type
        self.intent = f"id {id_type}, key string, payload string"
        self.outcome = f"id {id_type}, key string, status string, attempts int, reason string"

    # tables

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _done(self, table: str, batch: int) -> bool:
        return self._fs().exists(self._path(table, f"batch={batch}", "_SUCCESS"))

    def _batches(self, table: str) -> set[int]:
        fs, path = self._fs(), self._path(table)
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return {n for x in names if x.startswith("batch=") and self._done(table, n := int(x.removeprefix("batch=")))}

    def _read(self, table: str, schema: str, batches: set[int] | None = None) -> DataFrame:
        wanted = sorted(self._batches(table) if batches is None else batches & self._batches(table))
        if not wanted:
            return self.spark.createDataFrame([], f"{schema}, batch int")
        return self.spark.read.schema(f"{schema}, batch int").option("basePath", f"{self.folder}/{table}").parquet(*[f"{self.folder}/{table}/batch={b}" for b in wanted])

    def intents(self, *batches: int) -> DataFrame:
        """What is to be sent, of some batches or all."""
        return self._read("intents", self.intent, set(batches) or None)

    def outcomes(self, *batches: int) -> DataFrame:
        """What became of it: the last outcome of each id and batch."""
        found = [self._read(t, self.outcome, set(batches) or None) for t in self._rounds()]
        if not found:
            return self.spark.createDataFrame([], f"{self.outcome}, batch int")
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        return out

    def _rounds(self) -> list[str]:
        fs, path = self._fs(), self._path("outcomes")
        return sorted(f"outcomes/{f.getPath().getName()}" for f in fs.listStatus(path)) if fs.exists(path) else []

    # steps

    def offer(self, rows: DataFrame, batch: int) -> None:
        """Writes the intents of rows (id, payload) that have none yet. A batch that was offered is not offered again."""
        if self._done("intents", batch):
            return
        new = rows.select(F.col("id").cast(self.id_type).alias("id"), F.col("payload").cast("string").alias("payload")).filter("id is not null")
        new = new.groupBy("id").agg(F.min("payload").alias("payload"))
        ends = new.agg(F.min("id").alias("low"), F.max("id").alias("high")).first()
        if ends["low"] is not None:
            known = self.intents().filter(F.col("id").between(ends["low"], ends["high"])).select("id")
            new = new.join(known, "id", "left_anti")
        key = F.sha2(F.concat(F.lit("outbox:"), F.col("id").cast("string")), 256)
        ordered = new.select("id", key.alias("key"), "payload").repartitionByRange("id").sortWithinPartitions("id")
        ordered.write.mode("overwrite").parquet(f"{self.folder}/intents/batch={batch}")

    def open(self, batch: int) -> DataFrame:
        """The intents of a batch without an outcome."""
        return self.intents(batch).join(self.outcomes(batch).select("id"), "id", "left_anti").select("id", "key", "payload")

    def unfinished(self) -> list[int]:
        """Batches that may have open rows, oldest first."""
        return sorted(self._batches("intents") - self._batches("finished"))

    def deliver(self, batch: int, send: Send, retry: Retry = Retry(), size: int = 200) -> None:
        """Sends a batch's open rows from the executors and writes what became of them."""
        todo = self.open(batch)
        kind = todo.schema["id"].dataType

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = b.to_pylist()
                done = [x for at in range(0, len(rows), size) for x in sent(rows[at : at + size], send, retry)]
                columns = [b.column("id"), b.column("key"), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int32()), pa.array([d[2] for d in done], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "status", "attempts", "reason"])

        result = todo.mapInArrow(work, f"id {kind.simpleString()}, key string, status string, attempts int, reason string")
        number = len(self._rounds())
        result.write.mode("errorifexists").parquet(f"{self.folder}/outcomes/{number:06d}/batch={batch}")
        self.spark.range(0).write.mode("overwrite").parquet(f"{self.folder}/finished/batch={batch}")

    def drain(self, send: Send, retry: Retry = Retry(), size: int = 200) -> int:
        """Delivers all unfinished batches; gives how many."""
        todo = self.unfinished()
        for batch in todo:
            self.deliver(batch, send, retry, size)
        return len(todo)

    def dead(self) -> DataFrame:
        """The rows that were given up, with the reason, without those that were sent later."""
        out = self.outcomes()
        sent_later = out.filter(F.col("status") == SENT).select("id")
        return out.filter(F.col("status") == DEAD).join(sent_later, "id", "left_anti")

    def revive(self, batch: int) -> None:
        """Offers the dead again, as a batch of their own, under the keys they had."""
        if not self._done("intents", batch):
            again = self.dead().select("id").distinct().join(self.intents().groupBy("id").agg(F.first("key").alias("key"), F.first("payload").alias("payload")), "id")
            again.select("id", "key", "payload").write.mode("overwrite").parquet(f"{self.folder}/intents/batch={batch}")


def sent(rows: list[dict], send: Send, retry: Retry) -> list[tuple[str, int, str | None]]:
    """(status, attempts, reason) of each row of a group after as many attempts as it takes."""
    for attempt in range(1, retry.attempts + 1):
        try:
            refused = send(rows)
        except Exception as e:  # noqa: BLE001  whatever a receiver's client raises is a failed call
            reason = f"{type(e).__name__}: {e}"
            if attempt < retry.attempts:
                time.sleep(retry.wait(attempt))
            continue
        return [(SENT, attempt, None) if r is None else (DEAD, attempt, r) for r in refused]
    return [(DEAD, retry.attempts, reason)] * len(rows)


def push_stream(stream: DataFrame, outbox: Outbox, checkpoint: str, send: Send, retry: Retry = Retry(), size: int = 200, once: bool = True) -> StreamingQuery:
    """Pushes a stream's rows (id, payload): each batch is offered under its number, then all open batches are delivered."""

    def batch(df: DataFrame, number: int) -> None:
        outbox.offer(df, number)
        outbox.drain(send, retry, size)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="60 seconds")).start()


def watch(step: Callable[[], object], seconds: float = 60, rounds: int | None = None, sleep: Callable[[float], None] = time.sleep) -> int:
    """Runs a step every so many seconds, for ever or some rounds; a step that fails is logged and tried again. Gives the failures."""
    failed, k = 0, 0
    while rounds is None or k < rounds:
        try:
            step()
        except Exception:  # noqa: BLE001  the loop outlives its steps
            failed += 1
            log.exception("the step failed; it is tried again in %s s", seconds)
        k += 1
        if rounds is None or k < rounds:
            sleep(seconds)
    return failed
