"""Incremental runs, counts in one pass, and databases read by many tasks."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import leakage, rescue
from ledgerloom.plans import job
from ledgerloom.sources import io

DATA = "/root/testdata/sf0.001"


# incremental runs


def stages(spark, source, factor=2, top=3, extra=False):
    read = lambda: spark.read.parquet(source)
    scaled = lambda rows: rows.withColumn("x", F.col("id") * factor)
    parity = lambda rows: rows.select((F.col("id") % 2).alias("p")).distinct()
    both = lambda a, b: a.join(b, F.col("x") % 2 == F.col("p")).limit(top)
    if extra:
        parity = lambda rows: rows.select((F.col("id") % 2).alias("p")).dropDuplicates()
    return [
        job.Stage("both", both, ("scaled", "parity"), {"top": top}), job.Stage("scaled", scaled, ("read",), {"factor": factor}), job.Stage("parity", parity, ("read",)),
        job.Stage("read", read, inputs=(source,)),
    ]


def states(result):
    return {r.name: r.state for r in result[1].collect()}


def test_only_what_changed_is_made_again(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "run")
    spark.range(10).write.parquet(source)
    every = {"read": "made", "scaled": "made", "parity": "made", "both": "made"}
    none = dict.fromkeys(every, "skipped")
    first = job.rebuild(spark, stages(spark, source), folder)
    assert states(first) == every and {r.name: r.rows for r in first[1].collect()} == {"read": 10, "scaled": 10, "parity": 2, "both": 3}
    again = job.rebuild(spark, stages(spark, source), folder)
    assert states(again) == none and again[0]["scaled"].collect() == first[0]["scaled"].collect()
    # a parameter
    assert states(job.rebuild(spark, stages(spark, source, factor=3), folder)) == none | {"scaled": "made", "both": "made"}
    # code that gives the same rows: what hangs on it stays
    assert states(job.rebuild(spark, stages(spark, source, factor=3, extra=True), folder)) == none | {"parity": "made"}
    # an input: the numbers' parities are the same rows, so nothing behind them has to be made for them
    spark.range(10, 12).write.mode("append").parquet(source)
    assert states(job.rebuild(spark, stages(spark, source, factor=3, extra=True), folder)) == every
    assert states(job.rebuild(spark, stages(spark, source, factor=3, extra=True), folder)) == none
    # a table that is gone
    key = json.loads((tmp_path / "run/lock.json").read_text())["parity"]["key"][:16]
    (tmp_path / f"run/parity/{key}/_SUCCESS").unlink()
    assert states(job.rebuild(spark, stages(spark, source, factor=3, extra=True), folder)) == none | {"parity": "made"}


def test_a_broken_run_goes_on(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "run")
    spark.range(10).write.parquet(source)
    bad = [job.Stage(s.name, (lambda rows: 1 / 0) if s.name == "scaled" else s.make, s.needs, s.parameters, s.inputs) for s in stages(spark, source)]
    assert states(job.rebuild(spark, bad, folder)) == {"read": "made", "scaled": "failed", "parity": "made", "both": "blocked"}
    assert states(job.rebuild(spark, stages(spark, source), folder)) == {"read": "skipped", "scaled": "made", "parity": "skipped", "both": "made"}


def test_contents_do_not_depend_on_order(spark):
    rows = spark.createDataFrame([(1, None), (2, "b"), (2, "b")], "a int, b string")
    facts = lambda df: tuple(df.agg(*job.contents(df.columns)).first())
    assert facts(rows) == facts(rows.repartition(3).select("b", "a"))
    assert facts(rows) != facts(rows.dropDuplicates()) and facts(rows) != facts(rows.withColumn("b", F.coalesce("b", F.lit(""))))


# counts


def test_runs_count_while_they_write(spark):
    reads = spark.sparkContext.accumulator(0)

    def slow(it):
        for b in it:
            reads.add(b.num_rows)
            yield b

    _, metrics = job.run(spark, [job.Stage("one", lambda: spark.range(50).mapInArrow(slow, "id long"))])
    assert [(r.name, r.rows, r.return_code) for r in metrics.collect()] == [("one", 50, 0)] and reads.value == 50


def test_malformed_lines_are_counted_in_one_pass(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"a": 1, "b": "x"}\n\nnot json\n{"a": "no number", "b": "y"}\n{"b": "z"}\n')
    rows, seen = io.counted_json_lines(spark, str(tmp_path / "in.jsonl"), "a int, b string")
    assert sorted(r.b for r in rows.select("b").collect()) == ["x", "z"]
    assert (seen.get["kept"], seen.get["malformed"]) == (2, 2)
    assert rows.schema == io.read_json_lines(spark, str(tmp_path / "in.jsonl"), "a int, b string").schema


def test_streams_tell_their_batches(spark, tmp_path):
    spark.range(7).write.parquet(str(tmp_path / "in"))
    with job.progress(spark) as seen:
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).observe("told", F.max("id").alias("most"))
        stream.writeStream.queryName("counted").format("noop").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        for _ in range(100):
            if seen.rows:
                break
            __import__("time").sleep(0.1)
    assert [(n, rows, told["told"]["most"]) for n, _, rows, _, told in seen.rows if rows] == [("counted", 7, 6)]


# databases

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@pytest.fixture(scope="module")
def derby(spark, tmp_path_factory):
    """The orders and their items' flags in a database."""
    url = f"jdbc:derby:{tmp_path_factory.mktemp('db')}/orders;create=true"
    orders = spark.read.parquet(f"{DATA}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_day"))
    more = spark.createDataFrame([(None, 1, "P", "2000-01-01"), (10**9, 2, "P", "2000-01-02")], orders.schema)
    short = {"createTableColumnTypes": "O_ORDERSTATUS VARCHAR(1), O_DAY VARCHAR(10)", "driver": DRIVER}
    orders.unionByName(more).toDF("O_ORDERKEY", "O_CUSTKEY", "O_ORDERSTATUS", "O_DAY").coalesce(1).write.jdbc(url, "orders", properties=short)
    return url


def test_a_table_is_read_by_many_tasks(spark, derby):
    whole = io.read_jdbc(spark, derby, "orders", driver=DRIVER)
    dealt = io.read_jdbc(spark, derby, "orders", key="O_ORDERKEY", rows_a_task=200, driver=DRIVER)
    assert whole.rdd.getNumPartitions() == 1 and dealt.rdd.getNumPartitions() >= 4
    assert sorted(map(str, dealt.collect())) == sorted(map(str, whole.collect()))
    sizes = dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == whole.count() and max(sizes) <= 201


def test_pending_rescues_through_the_database(spark, derby):
    table = io.read_jdbc(spark, derby, "orders", key="O_ORDERKEY", rows_a_task=300, driver=DRIVER)
    failed = table.filter("O_ORDERSTATUS = 'P'")
    plan = failed._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(O_ORDERSTATUS,P)" in plan
    rows = table.select(F.col("O_ORDERKEY").alias("id"), F.col("O_CUSTKEY").alias("tenant_id"), (F.col("O_ORDERSTATUS") != "P").alias("gate_passed"), F.col("O_DAY").alias("created_at"))
    pushed = spark.read.parquet(f"{DATA}/lineitem.parquet").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("target_id"))
    got = {r.id for r in rescue.pending(rows.filter("id < 1000000000"), pushed).collect()}
    from ledgerloom.plans import catalogue

    assert got == {r.id for r in catalogue.queries()["pending_rescues"](spark, DATA).collect()}


def test_key_ranges():
    assert io.key_ranges([], 5) == [(None, None)]
    assert io.key_ranges([(100, 3), (110, 3), (190, 1)], 5) == [(None, 110), (110, None)]
    assert io.key_ranges([(-5, 50), (15, 50)], 5) == [(None, 15), (15, None)]


def test_queries_over_named_tables_leave_no_views(spark):
    before = {t.name for t in spark.catalog.listTables()}
    tables = {"a": spark.range(3), "b": spark.range(1, 5)}
    assert io.read_sql(spark, tables, "SELECT a.id FROM {a} a JOIN {b} b ON a.id = b.id").count() == 2
    assert {t.name for t in spark.catalog.listTables()} == before


# similarity join


@pytest.mark.parametrize("soft", [0.5, 0.85, 1.0])
def test_positional_join_finds_what_all_pairs_have(spark, soft):
    """Texts with edits of all sizes, repeated ones and short ones, against every pair compared."""
    import random

    rnd = random.Random(11)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(3, 250))) for _ in range(25)]
    texts = []
    for b in base:
        texts += [b, b, b[: len(b) - rnd.randint(0, 20)], b[:10] + "#" + b[11:], b + b[: rnd.randint(0, 9)], " " + b + "\n"]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(-1, None), (-2, ""), (-3, "abcd")]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, prefix string, n int").repartition(3)
    train, evaluation = df.filter("length(text) % 2 = 0 or text is null"), df.filter("length(text) % 2 = 1 or text is null")
    grams = lambda t: {s[i : i + 5] for s in [" ".join((t or "").split())] for i in range(len(s) - 4)}
    want = []
    for e in evaluation.collect():
        for t in train.collect():
            a, b = grams(e.text), grams(t.text)
            if a and b and len(a & b) / len(a | b) >= soft:
                want.append((e.doc_id, t.doc_id, round(len(a & b) / len(a | b), 9)))
    for most in (0, 50, leakage.FREQUENT):
        got = [(r.eval_doc_id, r.train_doc_id, round(r.jaccard, 9)) for r in leakage.exact_pairs(train, evaluation, soft, 1.0, most=most).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert leakage.exact_pairs(train.limit(0), evaluation).collect() == [] and leakage.lsh_pairs(train, evaluation.limit(0)).collect() == []


# calls in flight


def test_calls_in_flight_keep_bound_limit_and_order():
    import threading
    import time

    from ledgerloom.operators import slots

    now, most, lock = [0], [0], threading.Lock()

    def call(x):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(3.0 if x == 7 else 0.05 + (x % 3) * 0.02)
        with lock:
            now[0] -= 1
        if x == 5:
            raise OSError("down")
        return x * 2

    began = time.monotonic()
    got = list(slots.in_flight(range(60), call, flight=6, seconds=0.6))
    took = time.monotonic() - began
    assert [type(g).__name__ if isinstance(g, Exception) else g for g in got] == [{5: "OSError", 7: "TimeoutError"}.get(x, 2 * x) for x in range(60)]
    assert 4 <= most[0] <= 7 and took < 2.5  # one by one it would be 60 times 0.07 and the slow call's 3 s; the call left behind is beside the six
    assert list(slots.in_flight([], call)) == [] and list(slots.in_flight([1], call, flight=1)) == [2]


def test_a_model_is_told_what_was_wrong(spark):
    from ledgerloom.operators import slots

    def model(text, wrong):
        import time

        if text == "hangs":
            time.sleep(5)
        if text == "never":
            return "no json"
        if wrong is None:
            return '{"total": "12", "vendor": 3}'
        return '{"total": 12.5, "vendor": "said: %s"}' % wrong.replace('"', "'")

    rows = [(str(i), t) for i, t in enumerate(["a", "hangs", "never", "b", "c"])]
    got = slots.ask(spark.createDataFrame(rows, "doc_id string, text string").coalesce(1), model, 1, slots.typed_fields, flight=3, seconds=0.5).collect()
    said = '{"total": 12.5, "vendor": "said: vendor is no text; total is no amount"}'
    assert [(r.doc_id, r.answer, r.tries) for r in got] == [("0", said, 2), ("1", None, 2), ("2", None, 2), ("3", said, 2), ("4", said, 2)]
    assert got[1].error == "TimeoutError: no answer in 0.5 s" and got[2].error.startswith("JSONDecodeError")
    assert slots.typed_fields('{"vat_confidence": 2, "vat": -1}') == "vat is no amount; vat_confidence is not from 0 to 1"
    assert slots.typed_fields('{"vendor": null, "total": 0, "total_confidence": 1}') is None and slots.typed_fields("[]") == "no object"


# the twister


def test_a_million_first_draws():
    import random

    import numpy as np

    from ledgerloom.operators import sampling

    rnd = np.random.RandomState(3)
    seeds = np.concatenate([rnd.randint(-(1 << 63), (1 << 63) - 1, 500_000, dtype=np.int64), rnd.randint(0, 1 << 32, 500_000, dtype=np.int64)])
    seeds[:6] = [0, 1, -1, (1 << 32) - 1, 1 << 32, -(1 << 63)]
    got = sampling.first_draws(seeds)
    some = [*range(6), *rnd.randint(0, len(seeds), 100_000).tolist()]
    assert all(got[i] == random.Random(int(seeds[i])).random() for i in some) and 0 <= got.min() and got.max() < 1


def test_buckets_of_null_seeds(spark):
    from ledgerloom.operators import sampling

    got = sampling.with_bucket(spark.createDataFrame([(43_000_000,), (None,)], "seed long")).collect()
    assert [r.bucket is None for r in got] == [False, True] and got[0].bucket == sampling.bucket_of(43_000_000)
