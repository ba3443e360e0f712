"""Runs: declared stages in order of what they need, a row of metrics for each, and the extraction run from texts to scores.

run() makes every stage. rebuild() makes those whose code, parameters, inputs or needed tables have changed, as a lock file
tells, and what hangs on them; a stage that is made again and gives the rows it gave before does not touch the stages
behind it. Rows and contents are counted while a table is written (an observation of its plan), so nothing is read twice.
"""

from __future__ import annotations

import hashlib
import importlib
import inspect
import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from graphlib import TopologicalSorter
from types import CodeType

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ledgerloom.functions.fields import FIELDS
from ledgerloom.operators import extraction, gate, scoring, voting
from ledgerloom.sources.shared import stored

METRICS = "name string, rows long, seconds double, return_code int, error string"


@dataclass(frozen=True)
class Stage:
    """A stage makes one table from those of the stages it needs.

    For rebuild() also: parameters and the paths of files that `make` reads, and modules whose source counts as its code besides itself.
    """

    name: str
    make: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()
    parameters: dict[str, object] = field(default_factory=dict)
    inputs: tuple[str, ...] = ()
    modules: tuple[str, ...] = ()


def run(spark: SparkSession, stages: list[Stage], keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: stored(df)) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every stage's table, and (name, rows, seconds, return_code, error) of each.

    keep writes a stage's table, all of it, and reads it back. A stage that fails has return code 1 and its error; those that need it have 2 and
    are not run, the others are.
    """
    made: dict[str, DataFrame] = {}
    rows = []
    for stage in _in_order(stages):
        name, began, seen = stage.name, time.monotonic(), Observation()
        if any(n not in made for n in stage.needs):
            rows.append((name, None, 0.0, 2, "a stage before it failed"))
            continue
        try:
            made[name] = keep(name, stage.make(*[made[n] for n in stage.needs]).observe(seen, F.count(F.lit(1)).alias("rows")))
            rows.append((name, seen.get["rows"], time.monotonic() - began, 0, None))
        except Exception as e:  # a stage's failure is a row's result
            rows.append((name, None, time.monotonic() - began, 1, f"{type(e).__name__}: {e}"[:2000]))
    return made, spark.createDataFrame(rows, METRICS)


def _in_order(stages: list[Stage]) -> list[Stage]:
    by_name = {s.name: s for s in stages}
    if len(by_name) != len(stages):
        raise ValueError("two stages have one name")
    return [by_name[n] for n in TopologicalSorter({s.name: s.needs for s in stages}).static_order()]


# incremental runs

MADE, SKIPPED, FAILED, BLOCKED = "made", "skipped", "failed", "blocked"


def _code(code: CodeType) -> list:
    return [code.co_code.hex(), list(code.co_names), [_code(c) if isinstance(c, CodeType) else repr(c) for c in code.co_consts]]


def code_of(stage: Stage) -> list:
    """What a stage's code is known by: its function's instructions, names, constants, defaults and what it encloses, and the stated modules' sources."""
    f = inspect.unwrap(stage.make)
    enclosed = [repr(c.cell_contents) if not callable(c.cell_contents) else _code(c.cell_contents.__code__) if hasattr(c.cell_contents, "__code__") else repr(c.cell_contents) for c in f.__closure__ or ()]
    return [_code(f.__code__), repr(f.__defaults__), enclosed, [inspect.getsource(importlib.import_module(m)) for m in stage.modules]]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def files_of(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time of change) of the files at or below a path, in order; none if it is not there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out, todo = [], fs.listFiles(p, True)
    while todo.hasNext():
        f = todo.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def contents(columns: list[str]) -> list[Column]:
    """Aggregates that tell a table's rows, in whatever order and partitions: how many, and a sum and an exclusive or of their hashes."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), {"ignoreNullFields": "false"})
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(row).cast("decimal(38,0)")).cast("string").alias("sum"), F.bit_xor(F.xxhash64(F.lit(1), row)).alias("xor")]


def _lock(spark: SparkSession, folder: str) -> dict[str, dict]:
    rows = spark.read.text(f"{folder}/lock.json", wholetext=True).collect() if files_of(spark, f"{folder}/lock.json") else []
    return json.loads(rows[0][0]) if rows else {}


def _write_lock(spark: SparkSession, folder: str, lock: dict[str, dict]) -> None:
    """Written beside the old one and renamed onto its place, so a failure leaves one of both."""
    new = f"{folder}/.lock-{uuid.uuid4().hex}"
    fs, p = _fs(spark, new)
    out = fs.create(p)
    out.write(bytearray(json.dumps(lock, sort_keys=True).encode()))
    out.close()
    _, at = _fs(spark, f"{folder}/lock.json")
    fs.delete(at, False)
    fs.rename(p, at)


def rebuild(spark: SparkSession, stages: list[Stage], folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every stage's table, and (name, state, rows, seconds, error) of each; states: made, skipped, failed, blocked.

    Tables are kept below the folder by stage and key, and so are older ones. A stage is skipped if its key is that of the lock and
    its table is whole. The lock is written after every stage, so a run that is broken off goes on where it was.
    """
    lock, tables, known, rows = _lock(spark, folder), {}, {}, []
    for stage in _in_order(stages):
        began = time.monotonic()
        if any(n not in tables for n in stage.needs):
            rows.append((stage.name, BLOCKED, None, 0.0, "a stage before it failed"))
            continue
        try:
            facts = [code_of(stage), sorted((k, repr(v)) for k, v in stage.parameters.items()), [files_of(spark, p) for p in stage.inputs], [known[n] for n in stage.needs]]
            key = hashlib.sha256(json.dumps(facts).encode()).hexdigest()
            path, held = f"{folder}/{stage.name}/{key[:16]}", lock.get(stage.name, {})
            state = SKIPPED if held.get("key") == key and files_of(spark, f"{path}/_SUCCESS") else MADE
            if state == MADE:
                seen = Observation()
                df = stage.make(*[tables[n] for n in stage.needs])
                df.observe(seen, *contents(df.columns)).write.mode("overwrite").parquet(path)
                lock[stage.name] = held = {"key": key, "contents": [df.schema.json(), seen.get["rows"], seen.get["sum"], seen.get["xor"]]}
                _write_lock(spark, folder, lock)
            tables[stage.name], known[stage.name] = spark.read.parquet(path), held["contents"]
            rows.append((stage.name, state, held["contents"][1], time.monotonic() - began, None))
        except Exception as e:  # a stage's failure is a row's result
            rows.append((stage.name, FAILED, None, time.monotonic() - began, f"{type(e).__name__}: {e}"[:2000]))
    return tables, spark.createDataFrame(rows, "name string, state string, rows long, seconds double, error string")


class Progress(StreamingQueryListener):
    """Batches of streams as they end: (name, batch, rows, milliseconds, observed metrics)."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((p.name, p.batchId, p.numInputRows, p.batchDuration, {k: v.asDict() for k, v in p.observedMetrics.items()}))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


@contextmanager
def progress(spark: SparkSession) -> Iterator[Progress]:
    """Collects the batches of the streams that run meanwhile."""
    listener = Progress()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def summary(metrics: DataFrame, **more: object) -> str:
    """The run as JSON: totals, failures, and a row a stage."""
    rows = [r.asDict() for r in metrics.collect()]
    failed = [r["name"] for r in rows if r["return_code"]]
    return json.dumps({**more, "stages": len(rows), "rows": sum(r["rows"] or 0 for r in rows), "seconds": round(sum(r["seconds"] for r in rows), 3), "failed": failed, "per_stage": rows}, sort_keys=True, default=str)


#: The engine that typed answers stand for, behind all others in their order.
MODEL, BEHIND = "model", 1 << 30


def _with_answers(candidates: DataFrame, confidences: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed answers (doc_id, answer) as one more engine: its values are taken as they are, no text of it is read."""
    typed = extraction.model_candidates(answers)
    more = typed.select("doc_id", "field_id", F.lit(MODEL).alias("engine"), F.lit(BEHIND).alias("ordinal"), "raw_text", "value")
    sure = typed.groupBy("doc_id").agg(F.coalesce(F.avg(F.when(F.col("confidence") > 0, F.col("confidence"))), F.lit(0.0)).alias("confidence"))
    return candidates.unionByName(more), confidences.unionByName(sure.select("doc_id", F.lit(MODEL).alias("engine"), "confidence"))


def extract(texts: DataFrame, confidences: DataFrame, verdicts: DataFrame | None = None, answers: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Fields and documents of the engines' texts (doc_id, engine, ordinal, text), confidences (doc_id, engine, confidence), verdicts and a model's answers.

    fields: (doc_id, field_id, value, agreed, valid, reason, ocr, verifier, to_verify, bounces); documents: gate()'s rows. A verdict
    (doc_id, field_id, verifier) counts where a field needs one.
    """
    candidates = extraction.extracted(texts)
    if answers is not None:
        candidates, confidences = _with_answers(candidates, confidences, answers)
    voted = voting.vote(candidates, confidences)
    check = gate.field_valid(F.col("field_id"), F.col("value"))
    fields = voted.select("doc_id", "field_id", "value", F.col("agreement").alias("agreed"), check.alias("check"), F.col("ocr_confidence").alias("ocr"))
    fields = fields.select("*", F.col("check.ok").alias("valid"), F.col("check.reason").alias("reason"), gate.needs_verifier(F.col("agreed"), F.col("ocr")).alias("to_verify")).drop("check")
    if verdicts is None:
        fields = fields.withColumn("verifier", F.lit(None).cast("double"))
    else:
        fields = fields.join(verdicts, ["doc_id", "field_id"], "left").withColumn("verifier", F.when(F.col("to_verify"), F.col("verifier")))
    of = lambda f: F.max(F.when(F.col("field_id") == f, F.col("value")))
    wide = fields.groupBy("doc_id").agg(*[of(f).alias(f) for f in FIELDS])
    bounces = gate.bounces(F.col("vat").try_cast("double"), F.col("total").try_cast("double"), F.col("date"))
    fields = stored(fields.join(wide.select("doc_id", bounces.alias("bounces")), "doc_id"))
    return fields, gate.gate(fields)


def baseline(texts: DataFrame, confidences: DataFrame, truth: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The scorecard, the accuracy by field and the documents of a run over sets (doc_id, set_slug, elapsed_s) with truth (doc_id, field_id, expected)."""
    fields, documents = extract(texts, confidences)
    results = fields.join(sets.select("doc_id", "set_slug"), "doc_id").select("set_slug", "doc_id", "field_id", "value")
    compared = stored(scoring.compare_fields(results, truth))
    documents = stored(documents.join(sets, "doc_id"))
    return scoring.scorecard(documents, compared), scoring.field_accuracy(compared), documents
