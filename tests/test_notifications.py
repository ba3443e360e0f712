"""The ledger source, the folded state and the outbox, through failures and restarts."""

import datetime
import json
import os
import shutil
import sqlite3
import sys
import types
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ledgerloom.operators import corrections
from ledgerloom.streaming import notifications as notes
from ledgerloom.streaming import outbox as boxes
from ledgerloom.streaming import state
from ledgerloom.streaming.corrections import append_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not have this module
COLUMNS = "id long, extraction_id long, v string"


def add(spark, folder, ids, name):
    """A file of the ledger with these ids."""
    rows = [(i, i % 5 if i is not None else None, f"v{i}") for i in ids]
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(folder)


def drained(spark, options, out, checkpoint):
    stream = notes.read_ledger(spark, COLUMNS, **options)
    extractions = spark.createDataFrame([(k, f"doc{k}") for k in range(5)], "extraction_id long, doc_id string")
    append_stream(stream, extractions, out, checkpoint).awaitTermination()
    return sorted(r.id for r in spark.read.parquet(out).collect())


@pytest.fixture
def place(tmp_path):
    return types.SimpleNamespace(path=str(tmp_path / "ledger"), options={"path": str(tmp_path / "ledger"), "state": str(tmp_path / "state"), "limit": "7", "tasks": "3"}, out=str(tmp_path / "out"), checkpoint=str(tmp_path / "checkpoint"))


def until_quiet(spark, place):
    """Runs until one finds nothing."""
    extractions = spark.createDataFrame([(k, f"doc{k}") for k in range(5)], "extraction_id long, doc_id string")
    notes.drain(lambda: append_stream(notes.read_ledger(spark, COLUMNS, **place.options), extractions, place.out, place.checkpoint))
    return sorted(r.id for r in spark.read.parquet(place.out).collect())


def test_each_id_once_over_restarts(spark, place):
    """Each call is a new stream on the same checkpoint; ids come late, twice, or never, and the limit is kept."""
    add(spark, place.path, [1, 2, 3, 5, 6], "a")
    assert drained(spark, place.options, place.out, place.checkpoint) == [1, 2, 3, 5, 6]
    add(spark, place.path, [4, 6, 9, None, 9], "b")  # 4 is late, 6 comes again, 7 and 8 are passed over
    assert until_quiet(spark, place) == [1, 2, 3, 4, 5, 6, 9]
    add(spark, place.path, range(10, 40), "c")
    first = drained(spark, place.options, place.out, place.checkpoint)
    assert first == [1, 2, 3, 4, 5, 6, *range(9, 17)]  # seven ids a batch
    add(spark, place.path, [8], "d")
    assert until_quiet(spark, place) == [1, 2, 3, 4, 5, 6, *range(8, 40)]
    rows = spark.read.parquet(place.out).collect()
    assert len(rows) == len({r.id for r in rows}) and all(r.v == f"v{r.id}" and r.doc_id == f"doc{r.id % 5}" for r in rows)


def test_a_batch_that_was_not_committed_is_made_again(spark, place):
    """Killed after a batch was planned and written: its commit is lost, and a late id has come meanwhile."""
    add(spark, place.path, [1, 2, 4], "a")
    drained(spark, place.options, place.out, place.checkpoint)
    add(spark, place.path, [6, 7], "b")
    drained(spark, place.options, place.out, place.checkpoint)
    commits = Path(place.checkpoint, "commits")
    last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    add(spark, place.path, [3, 5], "c")  # below the offset of the batch that runs again
    assert until_quiet(spark, place) == [1, 2, 3, 4, 5, 6, 7]


def test_a_stream_whose_place_is_lost_stops(spark, place):
    """Beginning again would give ids twice, so it is an error."""
    add(spark, place.path, range(1, 20), "a")
    assert until_quiet(spark, place) == list(range(1, 20))
    shutil.rmtree(place.options["state"])
    with pytest.raises(Exception, match="the state of the stream is gone"):
        drained(spark, place.options, place.out, place.checkpoint)


def test_ledger_in_a_database(spark, place, tmp_path):
    """A table behind DB-API connections, with ids that are given up after a while."""
    base = str(tmp_path / "ledger.db")

    def put(*ids):
        with sqlite3.connect(base) as db:
            db.execute("create table if not exists notes (id integer, extraction_id integer, v text)")
            db.executemany("insert into notes values (?, ?, ?)", [(i, i % 5, f"v{i}") for i in ids])

    options = {"connect": lambda: sqlite3.connect(base), "table": "notes", "state": place.options["state"], "patience": "20", "limit": "100"}
    put(1, 2, 10)
    assert drained(spark, options, place.out, place.checkpoint) == [1, 2, 10]
    put(5, 29)
    assert drained(spark, options, place.out, place.checkpoint) == [1, 2, 5, 10, 29]
    put(6, 28)  # 6 lies more than 20 behind: it is waited for no longer
    assert drained(spark, options, place.out, place.checkpoint) == [1, 2, 5, 10, 28, 29]


def test_offsets_follow():
    o = notes.Offset(10, (3, 7), ())
    assert notes.following(o, [], [], 100, 10) == o
    assert notes.following(o, [12, 15], [3], 100, 10) == notes.Offset(15, (7, 11, 13, 14), (3,))
    assert notes.following(o, [12, 15], [], 100, 2) == notes.Offset(15, (13, 14), ())
    assert notes.following(o, [12, 1000], [], 5, 10) == notes.Offset(1000, (996, 997, 998, 999), ())
    assert notes.Offset.of(json.loads(json.dumps(o.told()))) == o


# state

EVENTS = "id long, extraction_id long, field_id string, corrected_value double, submitted_at string, ordinal long, at timestamp"


def events(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return e.select(F.col("event_id").alias("id"), F.col("user_id").alias("extraction_id"), F.col("event_type").alias("field_id"), F.col("value").alias("corrected_value"), stamp.alias("submitted_at"), F.col("event_id").alias("ordinal"), F.col("ts").alias("at"))


@pytest.mark.parametrize("keep_ms", [None, 10 * 365 * 86_400_000])
def test_state_is_the_latest_correction(spark, tmp_path, keep_ms):
    """Rows shuffled and a third of them delivered twice, in several batches."""
    rows = events(spark)
    again = rows.filter("id % 3 = 0").withColumn("corrected_value", F.col("corrected_value"))
    ties = rows.filter("id % 50 = 0").withColumns({"id": F.col("id") + 100_000, "ordinal": F.col("ordinal") + 100_000, "corrected_value": F.lit(-1.0)})
    rows.unionByName(again).unionByName(ties).repartition(5, F.hash("id", "corrected_value")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    query = state.fold_stream(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), at="at" if keep_ms else None, keep_ms=keep_ms, delay="3650 days")
    query.awaitTermination()
    got = state.folded(spark, str(tmp_path / "out"))
    want = corrections.latest(rows.unionByName(ties))
    columns = ["extraction_id", "field_id", "corrected_value", "submitted_at", "ordinal"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    # another round over the same checkpoint: repeats change nothing
    before = len(list((tmp_path / "out").glob("batch=*/*.parquet")))
    rows.filter("id % 7 = 0").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in"))
    state.fold_stream(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), at="at" if keep_ms else None, keep_ms=keep_ms, delay="3650 days").awaitTermination()
    assert sorted(map(tuple, state.folded(spark, str(tmp_path / "out")).select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert len(list((tmp_path / "out").glob("batch=*/*.parquet"))) >= before


def test_state_expires(spark, tmp_path):
    """A key that the watermark has left behind is forgotten, and rows behind the watermark change nothing."""
    row = lambda day, key, value: (1, key, "f", value, f"2026-01-{day:02d}", 1, datetime.datetime(2026, 1, day))

    def run(*rows):
        spark.createDataFrame(list(rows), EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in"))
        query = state.fold_stream(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), at="at", keep_ms=86_400_000, delay="1 day")
        query.awaitTermination()
        return query

    run(row(1, 1, 1.0), row(1, 2, 1.0))
    run(row(9, 2, 9.0))  # the watermark moves to the 8th: key 1 is forgotten
    query = run(row(10, 3, 3.0))
    kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    run(row(2, 2, 2.0))  # behind the watermark
    got = {r.extraction_id: r.corrected_value for r in state.folded(spark, str(tmp_path / "out")).collect()}
    assert got == {1: 1.0, 2: 9.0, 3: 3.0} and kept <= 6
    with pytest.raises(ValueError, match="event time"):
        state.changes(spark.createDataFrame([], EVENTS), keep_ms=1)


# outbox


class Receiver:
    """Writes a file for each call, and fails as a plan says: before it took the rows, or after."""

    def __init__(self, folder, plan):
        self.folder, self.plan = str(folder), plan
        Path(self.folder).mkdir(exist_ok=True)

    def __call__(self, rows):
        import time
        import uuid

        first = min(str(r["id"]) for r in rows)
        calls = len([f for f in os.listdir(self.folder) if f.startswith(f"call-{first}-")])
        open(f"{self.folder}/call-{first}-{uuid.uuid4().hex}", "w").close()
        what = self.plan(first, calls)
        if what == "before":
            raise ConnectionError("lost on the way")
        with open(f"{self.folder}/took-{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(f"{r['id']} {r['key']} {r['payload']}" for r in rows))
        if what == "after":
            raise TimeoutError("the answer was lost")
        time.sleep(0)
        return ["refused" if str(r["id"]).endswith("13") else None for r in rows]

    def took(self):
        out = {}
        for f in Path(self.folder).glob("took-*"):
            for line in f.read_text().splitlines():
                i, key, _ = line.split(" ", 2)
                out.setdefault(int(i), []).append(key)
        return out


QUICK = boxes.Retry(attempts=3, first_wait=0.0)


def ids(spark, low, high):
    return spark.range(low, high).select("id", F.concat(F.lit("p"), F.col("id")).alias("payload")).repartition(3)


def test_outbox_sends_each_once_under_one_key(spark, tmp_path):
    """Calls are lost before and after the receiver took them; whatever is repeated has the key it had."""
    receiver = Receiver(tmp_path / "calls", lambda first, n: ("before", "after", None)[n] if int(first) % 2 else None)
    box = boxes.Outbox(spark, f"file://{tmp_path}/box", "long")
    box.offer(ids(spark, 0, 30), 0)
    box.offer(ids(spark, 0, 30), 0)
    box.offer(ids(spark, 20, 40).unionByName(ids(spark, 25, 35)), 1)
    assert box.unfinished() == [0, 1] and box.intents().count() == 40
    assert box.drain(receiver, QUICK, size=4) == 2 and box.unfinished() == [] and box.drain(receiver, QUICK) == 0
    took = receiver.took()
    assert set(took) == set(range(40)) and all(len(set(keys)) == 1 for keys in took.values())
    assert len({keys[0] for keys in took.values()}) == 40
    out = {r.id: (r.status, r.reason) for r in box.outcomes().collect()}
    assert len(out) == 40 and out[13] == ("dead", "refused") and all(s == "sent" for i, (s, _) in out.items() if i != 13)


@pytest.mark.parametrize("broken", ["offer", "send", "outcome", "finish"])
def test_outbox_survives_a_crash_at_every_step(spark, tmp_path, monkeypatch, broken):
    receiver = Receiver(tmp_path / "calls", lambda first, n: None)
    box = boxes.Outbox(spark, f"file://{tmp_path}/box", "long")
    with monkeypatch.context() as m:
        def fail(*a, **b):
            raise RuntimeError("crash")

        if broken == "offer":  # the intents are half written
            box.offer(ids(spark, 0, 20), 0)
            (tmp_path / "box/intents/batch=0/_SUCCESS").unlink()
        elif broken == "send":
            box.offer(ids(spark, 0, 20), 0)
            m.setattr(boxes.Outbox, "deliver", fail)
            with pytest.raises(RuntimeError):
                box.drain(receiver, QUICK)
        else:
            box.offer(ids(spark, 0, 20), 0)
            box.deliver(0, receiver, QUICK)
            (tmp_path / "box/finished/batch=0/_SUCCESS").unlink()
            if broken == "outcome":  # all was sent, and what became of it was not written
                (tmp_path / "box/outcomes/000000/batch=0/_SUCCESS").unlink()
    again = boxes.Outbox(spark, f"file://{tmp_path}/box", "long")
    again.offer(ids(spark, 0, 20), 0)
    again.drain(receiver, QUICK)
    took = receiver.took()
    assert set(took) == set(range(20)) and all(len(set(keys)) == 1 for keys in took.values())
    assert sorted(r.id for r in again.outcomes().collect()) == list(range(20)) and again.unfinished() == []
    assert all(len(keys) == (2 if broken == "outcome" else 1) for keys in took.values())


def test_outbox_gives_up_and_revives(spark, tmp_path):
    down = Receiver(tmp_path / "down", lambda first, n: "before")
    box = boxes.Outbox(spark, f"file://{tmp_path}/box", "long")
    box.offer(ids(spark, 0, 6).unionByName(spark.createDataFrame([(None, "x")], "id long, payload string")), 0)
    box.drain(down, QUICK, size=3)
    assert {(r.status, r.attempts, r.reason) for r in box.outcomes().collect()} == {("dead", 3, "ConnectionError: lost on the way")}
    assert sorted(r.id for r in box.dead().collect()) == list(range(6))
    box.revive(100)
    box.drain(Receiver(tmp_path / "up", lambda first, n: None), QUICK)
    assert box.dead().collect() == [] and box.outcomes().filter("status = 'sent'").count() == 6
    keys = {r.id: r.key for r in box.intents(0).collect()}
    assert all(keys[r.id] == r.key for r in box.outcomes().collect())
    none = boxes.Outbox(spark, f"file://{tmp_path}/none")
    none.offer(ids(spark, 0, 0), 0)
    assert none.drain(down, QUICK) == 1 and none.outcomes().collect() == []


def test_outbox_reads_only_the_range_of_ids(spark, tmp_path):
    box = boxes.Outbox(spark, f"file://{tmp_path}/box", "long")
    box.offer(ids(spark, 0, 1000), 0)
    plan = box.intents().filter(F.col("id").between(10, 20))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,10)" in plan and "LessThanOrEqual(id,20)" in plan


def test_pushed_stream(spark, tmp_path):
    receiver = Receiver(tmp_path / "calls", lambda first, n: None)
    box = boxes.Outbox(spark, f"file://{tmp_path}/box", "long")
    for k in range(2):
        ids(spark, 10 * k, 10 * k + 15).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long, payload string").parquet(str(tmp_path / "in"))
        boxes.push_stream(stream, box, str(tmp_path / "checkpoint"), receiver, QUICK).awaitTermination()
    took = receiver.took()
    assert set(took) == set(range(25)) and all(len(k) == 1 for k in took.values())


def test_waits_grow_and_watch_goes_on():
    retry = boxes.Retry(6, 1.0, 5.0)
    assert [retry.wait(k) for k in range(1, 6)] == [1.0, 2.0, 4.0, 5.0, 5.0]
    calls, slept = [], []

    def step():
        calls.append(1)
        if len(calls) == 2:
            raise OSError("down")

    assert boxes.watch(step, 60, 3, slept.append) == 1 and len(calls) == 3 and slept == [60, 60]


def test_the_next_ids_of_a_long_backlog(tmp_path):
    """Ids in any order over files that overlap; a poll holds no more of them than it may give, whatever else waits."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    from ledgerloom.streaming.notifications import ParquetLedger

    ids = np.random.RandomState(1).permutation(400_000) * 3
    for k, part in enumerate((ids[:150_000], np.sort(ids[100_000:300_000]), ids[300_000:])):
        pq.write_table(pa.table({"id": part}), tmp_path / f"{k}.parquet", row_group_size=20_000)
    table = ParquetLedger(f"file://{tmp_path}", "id")
    tracemalloc.start()
    for since, limit in ((-1, 10), (-1, 5000), (2999, 5000), (600_000, 1), (1_199_990, 10)):
        assert table.ids_after(since, limit) == [x for x in range(0, 1_200_000, 3) if x > since][:limit]
    assert table.ids_after(-1, 10) == [*range(0, 30, 3)]
    tracemalloc.reset_peak()
    table.ids_after(-1, 100)
    assert tracemalloc.get_traced_memory()[1] < 8_000_000
