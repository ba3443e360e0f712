"""Sources, sinks, slots, runs and streams; rows that earlier rules got wrong."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import money
from ledgerloom.operators import export, extraction, gate, governance, leakage, rescue, scoring, slots, voting
from ledgerloom.plans import catalogue, generator, job
from ledgerloom.sources import io
from ledgerloom.streaming import corrections as stream

DATA = "/root/testdata/sf0.01"


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


# rules


def test_years_have_four_digits(spark):
    raw = ["1/2/2025", "1/2/25", "1-2-26", "2026-1-2", "12025-01-02", "3 Mar 2021", "4 April 2020", "4.5.2021", " 1/2/2025 "]
    got = one(spark, *[money.format_date(F.lit(x)) for x in raw])
    assert got == ("01/02/2025", "1/2/25", "1-2-26", "02/01/2026", "12025-01-02", "03/03/2021", "04/04/2020", "04/05/2021", "01/02/2025")
    assert one(spark, money.due_date(F.lit("1/2/25"), 30), money.due_date(F.lit("01/02/2025"), 30)) == ("", "03/03/2025")


def test_vat_number_weighs_seven_digits(spark):
    digits = lambda n: sum(int(d) * w for d, w in zip(f"{n:07d}", range(8, 1, -1), strict=True)) % 23 != 0
    numbers = [0, 1, 92, 1234567, 9999999, 23, 7654321, *range(100, 160)]
    got = one(spark, *[money.vat_number_plausible(F.lit(f"IE{n:07d}B")) for n in numbers])
    assert list(got) == [digits(n) for n in numbers]


def candidates(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, field_id string, engine string, ordinal int, raw_text string, value string")


def test_votes_of_null_values_and_fields_nobody_read(spark):
    rows = [("d", "vendor", "a", 1, "Acme Ltd", None), ("d", "vendor", "b", 2, "Something", None), ("d", "total", "a", 1, "1.00", "1.00"), ("d", "total", "b", 2, "1.005", "1.005")]
    sure = spark.createDataFrame([("d", "a", 1.0), ("d", "b", 1.0)], "doc_id string, engine string, confidence double")
    got = {r.field_id: r for r in voting.vote(candidates(spark, rows), sure).collect()}
    assert set(got) == {"vendor", "total", "vat", "date"}
    assert got["vendor"].agreement and got["total"].agreement  # both null agree, whatever their texts
    assert (got["vat"].candidates, got["vat"].agreement, got["vat"].ocr_confidence, got["vat"].value) == (0, False, 0.0, None)


def test_a_document_without_vat_cannot_pass(spark):
    rows = [("d", f, "x", True, True, 1.0, None, []) for f in ("vendor", "total", "date")]
    df = spark.createDataFrame(rows, "doc_id string, field_id string, value string, agreed boolean, valid boolean, ocr double, verifier double, bounces array<string>")
    assert [tuple(r) for r in gate.gate(df).collect()] == [("d", False, "below-threshold: vat=0.00")]


def test_last_truth_wins(spark):
    found = spark.createDataFrame([("d", "total", "2")], "doc_id string, field_id string, value string")
    truth = lambda rows: spark.createDataFrame(rows, "doc_id string, field_id string, expected string, ordinal int")
    assert [r.correct for r in scoring.compare_fields(found, truth([("d", "total", "1", 0), ("d", "total", "2", 1)])).collect()] == [True]
    assert scoring.compare_fields(found, truth([("d", "total", "1", 0), ("d", "total", None, 1)])).count() == 0


def test_bounces(spark):
    reasons = one(spark, gate.bounces(F.lit(30.0), F.lit(20.0), F.lit("32/01/2025")), gate.bounces(F.lit(2.3), F.lit(12.3), F.lit("01/01/2025")), gate.bounces(F.lit(None).cast("double"), F.lit(1.0), F.lit(None).cast("string")))
    assert reasons[1] == reasons[2] == []
    assert reasons[0][0] == "vat/total ratio 1.5000 not within ±0.005 of IE rates (0%, 4.8%, 9%, 13.5%, 23%)" and reasons[0][1] == "vat (30.0) exceeds total (20.0)" and reasons[0][2].startswith("date schema invalid: ")


def test_lsh_recall_and_empty_texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, ""), (-2, None), (-3, "abc"), (-4, "  ")], "doc_id long, text string")
    docs = docs.unionByName(odd)
    sides = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 <> 0")
    exact, near = ({(r.eval_doc_id, r.train_doc_id): (round(r.jaccard, 12), r.tier) for r in f(*sides).collect()} for f in (leakage.exact_pairs, leakage.lsh_pairs))
    assert len(exact) > 50 and all(exact.get(k) == v for k, v in near.items()) and len(near) >= 0.9 * len(exact)
    assert {(r.eval_doc_id, r.train_doc_id): (round(r.jaccard, 12), r.tier) for r in leakage.exact_pairs(*sides, most=0).collect()} == exact  # whatever is known as frequent
    assert leakage.lsh_pairs(odd, odd).count() == leakage.exact_pairs(odd, odd).count() == 0
    with pytest.raises(ValueError):
        leakage.lsh_pairs(*sides, soft=0.9, hard=0.8)
    with pytest.raises(ValueError):
        leakage.exact_pairs(*sides, soft=0.9, hard=0.8)


def _shuffled(spark):
    """Rows that all stages so far have written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}


def test_exact_leakage_shuffles_sets_and_not_shingles(spark, monkeypatch):
    """Texts of common shingles: what is written grows with the sets, and neither with their shingles nor with the pairs that share some."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdef") for _ in range(3)) for _ in range(40)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(3, 400))) for _ in range(151)]
    texts += [t[:-2] + "zz" for t in texts[:50]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    split = df.filter("doc_id % 2 = 0"), df.filter("doc_id % 2 = 1")
    before = _shuffled(spark)
    found = {(r.eval_doc_id, r.train_doc_id) for r in leakage.exact_pairs(*split).collect()}
    assert sum(n for k, n in _shuffled(spark).items() if k not in before) < 20 * len(texts)
    sets = [{t[i : i + 5] for i in range(len(t) - 4)} for t in texts]
    similar = lambda least: {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i % 2 and not j % 2 and len(a & b) >= least * len(a | b)}
    assert found == similar(0.85) and len(found) > 30
    monkeypatch.setattr(leakage, "HELD", 20)
    monkeypatch.setattr(leakage, "PASSING", 30)
    assert {(r.eval_doc_id, r.train_doc_id) for r in leakage.exact_pairs(*split, soft=0.4).collect()} == similar(0.4)


def _shuffled_bytes(spark):
    """Bytes that all stages so far have written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}


def test_lsh_leakage_writes_texts_once_a_cell(spark, monkeypatch):
    """Near copies that are all similar: what is written grows with the texts, and not with the pairs; small blocks give the same pairs."""
    rnd = random.Random(5)
    base = [rnd.choice("abcdefghij") * 2 + str(rnd.randint(0, 9999)) for _ in range(400)]
    texts = [" ".join([*base[: (at := rnd.randrange(400))], "x" * 5 + str(i), *base[at + 1 :]]) for i in range(240)]
    texts += [" ".join(str(rnd.randint(0, 99999)) for _ in range(rnd.randint(1, 300))) for _ in range(40)] + texts[:3] + ["", "abc", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    split = df.filter("doc_id % 2 = 0"), df.filter("doc_id % 2 = 1")
    pairs = lambda f: {(r.eval_doc_id, r.train_doc_id): (r.jaccard, r.tier) for r in f(*split).collect()}
    before, threshold = _shuffled_bytes(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    found = pairs(leakage.lsh_pairs)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert max(n for k, n in _shuffled_bytes(spark).items() if k not in before) < sum(len(t or "") for t in texts)
    assert found == pairs(leakage.exact_pairs) and len(found) > 14_000
    for name, value in {"HELD": 20, "PASSING": 30, "SHINGLES": 20_000, "TOGETHER": 10_000, "FEW": 0}.items():
        monkeypatch.setattr(leakage, name, value)
    assert pairs(leakage.lsh_pairs) == found


def test_narrower_parities_fold_alike(spark):
    """The fold of the join's expression is that of numpy."""
    import numpy as np

    p = np.random.RandomState(4).randint(-1 << 62, 1 << 62, 16)
    got = spark.createDataFrame([(p.tolist(),)], "p array<long>").select(*[leakage._folded("p", F.lit(w)).alias(str(w)) for w in (4, 8, 16)]).first()
    assert [*got] == [leakage.folded(p.view(np.uint64)[None], w)[0].view(np.int64).tolist() for w in (4, 8, 16)]


@pytest.mark.parametrize("name", ["lsh_leakage", "corrections_stream", "seeded_buckets"])
def test_queries_without_sql_run(spark, name):
    assert catalogue.queries()[name](spark, DATA).count() > 0


# sources and sinks


def test_documents_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "s", 1.5, ["x"]), ("b", "s", None, [])], "doc_id string, set_slug string, total double, names array<string>")
    io.write_documents(df, str(tmp_path / "out"))
    assert len([*(tmp_path / "out").glob("set_slug=s/doc_id=*/*.json")]) == 2
    back = spark.read.schema("total double, names array<string>").json(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.total, r.names) for r in back.collect()) == [("a", 1.5, ["x"]), ("b", None, [])]
    one_file = tmp_path / "one"
    one_file.mkdir()
    (one_file / "d.json").write_text(json.dumps({"doc_id": "d", "total": 2}, indent=1))
    assert [tuple(r) for r in io.read_documents(spark, str(one_file), "doc_id string, total double").collect()] == [("d", 2.0, "d.json")]


def test_json_lines_sinks(spark, tmp_path):
    p = str(tmp_path / "c")
    df = spark.sql("SELECT 1 AS a, DATE '2026-01-02' AS d, CAST(1.10 AS DECIMAL(5,2)) AS m")
    io.append_json_lines(df, p)
    io.append_json_lines(df, p)
    assert [tuple(r) for r in io.read_json_lines(spark, p, "a int, d string, m string").collect()] == [(1, "2026-01-02", "1.10")] * 2
    io.overwrite_json_lines(df.select("a"), p)
    assert io.read_json_lines(spark, p, "a int").count() == 1
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n\nnot json\n')
    assert [r.line for r in io.malformed_lines(spark, str(tmp_path / "bad.jsonl"), "a int").collect()] == ["not json"]


def test_ingest(spark, tmp_path):
    for name, content in (("a.pdf", b"pdf"), ("b.pdf", b"scan"), ("c.tif", b"img")):
        folder = tmp_path / "set-1" / "samples"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content)
    files = io.discover(spark, str(tmp_path))
    page = F.when(F.col("doc_id") == "a", "x" * 50).when(F.col("doc_id") == "b", " " * 80 + "y" * 49)
    got = {r.doc_id: (r.original_form, r.native_text, r.file_size_bytes) for r in io.ingested(files, page).collect()}
    assert got == {"a": ("digital_native", "x" * 50, 3), "b": ("image_only_pdf", None, 4), "c": ("paper_scan", None, 3)}
    native, others = extraction.by_origin(io.ingested(files, page))
    assert (native.count(), others.count()) == (1, 2)
    assert [tuple(r) for r in io.discover_sets(files, "set-").collect()] == [("set-1", 3)] and io.discover_sets(files, "other").count() == 0
    with pytest.raises(Exception, match="unsupported file"):
        io.ingested(spark.createDataFrame([("x.txt", b"")], "path string, content binary"), F.lit("")).collect()


def test_fetch_keeps_what_is_there_and_drops_what_fails(tmp_path):
    asked = []

    def get(url):
        asked.append(url)
        yield b"part"
        if url.endswith("bad"):
            raise OSError("gone")

    builders = {"wired": lambda n: [f"http://x/{k}" for k in ("1", "2", "bad")], "not yet": lambda n: []}
    assert io.build_sets(builders, tmp_path, get, 3, pause=0) == {"wired": 2, "not yet": 0}
    assert io.build_sets(builders, tmp_path, get, 1, pause=0) == {"wired": 1, "not yet": 0}
    assert len(asked) == 3 and sorted(f.name for f in tmp_path.rglob("samples/*")) == ["1", "2"]


def test_versions_are_named_by_content(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    first, new = io.push_version(df, str(tmp_path))
    assert new and io.push_version(df.orderBy(F.desc("k")).select("v", "k"), str(tmp_path)) == (first, False)
    other, new = io.push_version(df.union(df), str(tmp_path))
    assert new and other != first


def test_sql_and_http(spark):
    tables = {"corrections": spark.createDataFrame([(1, 7)], "id int, extraction_id int"), "extractions": spark.createDataFrame([(7, "d")], "id int, doc_id string")}
    assert [tuple(r) for r in io.read_sql(spark, tables, "SELECT c.id, e.doc_id FROM {corrections} c JOIN {extractions} e ON e.id = c.extraction_id").collect()] == [(1, "d")]
    assert io.auth_header("a.b" * 30) == "Bearer " + "a.b" * 30 and io.auth_header("f" * 40) == "Token " + "f" * 40 and io.auth_header("x", "Basic") == "Basic x"
    clock, asked = [0.0], []
    cache = io.TokenCache(lambda a: asked.append(a) or f"t{len(asked)}", now=lambda: clock[0])
    assert (cache("u"), cache("u")) == ("t1", "t1")
    clock[0] = 3000.0
    assert cache("u") == "t2"


def test_push_sends_every_row(spark, tmp_path):
    folder = str(tmp_path)

    def send(rows):
        import uuid

        Path(folder, uuid.uuid4().hex).write_text(json.dumps([r["id"] for r in rows]))

    io.push(spark.range(10).repartition(3), send, size=2)
    sent = [json.loads(p.read_text()) for p in tmp_path.iterdir()]
    assert sorted(x for s in sent for x in s) == [*range(10)] and max(map(len, sent)) <= 2


def test_jdbc_options_reach_the_reader(spark):
    with pytest.raises(Exception, match="(?i)driver|class"):
        io.read_jdbc(spark, "jdbc:none:x", "t", driver="no.such.Driver")


def test_a_poll_takes_what_comes(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = spark.createDataFrame([(1, 7)], "id long, extraction_id long")
    rows.write.parquet(src)
    ex = spark.createDataFrame([(7, "d")], "extraction_id long, doc_id string")
    q = stream.append_stream(stream.read_stream(spark, src, rows.schema), ex, str(tmp_path / "out"), str(tmp_path / "check"), once=False)
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("id", "doc_id").collect()] == [(1, "d")]


def test_stream_rows_equal_the_batch_join(spark):
    latest = catalogue.queries()["corrections_stream"](spark, DATA)
    batch = catalogue.queries()["training_pairs"](spark, DATA)
    assert sorted(map(tuple, latest.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))


# slots, runs


def test_engines_and_steps_report_their_errors(spark):
    docs = spark.createDataFrame([("a", b"text"), ("b", None)], "doc_id string, content binary")
    broken = lambda c: 1 / 0
    got = {(r.doc_id, r.engine): (r.raw_text, r.error) for r in slots.run(docs, {"text": slots.text_engine, "broken": broken}).collect()}
    assert got["a", "text"] == ("text", None) and got["b", "text"] == (None, None) and got["a", "broken"] == (None, "ZeroDivisionError: division by zero")
    assert slots.first_available([("x", lambda: False), ("y", lambda: True)]) == "y" and slots.first_available([]) is None
    steps = spark.createDataFrame([("a", b"page", "clean"), ("b", b"page", "light"), ("c", b"page", "other")], "doc_id string, content binary, parameter string")
    got = {r.doc_id: r for r in slots.run_step(steps, slots.corrupt).collect()}
    assert got["a"].content == b"page" and got["a"].error is None and "ValueError" in got["c"].error and got["b"].error
    assert all(r.error and r.content is None for r in slots.run_step(steps, slots.preprocess).collect())
    assert all(r.error for r in slots.run_step(steps, slots.render).collect())


def test_a_page_becomes_a_pdf():
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08\x00\x40\x00\x20\x01\x01\x11\x00\xff\xd9"
    pdf, note = slots.page_to_pdf(jpeg, "72")
    assert note == "32x64" and jpeg in pdf and b"/MediaBox[0 0 32.00 64.00]" in pdf and slots.page_count(pdf) == 1
    at = int(pdf.rsplit(b"startxref\n", 1)[1].split()[0])
    assert pdf[at:].startswith(b"xref") and all(pdf[int(x[:10]) :].startswith(f"{i} 0 obj".encode()) for i, x in enumerate(pdf[at:].split(b"\n")[3:8], 1))
    assert slots.page_count(b"/Type /Pages /Type /Page /Type/Page>") == 2
    with pytest.raises(ValueError):
        slots.page_to_pdf(b"no image", "")


def test_stages_run_in_order_and_report(spark):
    def fails(_):
        raise RuntimeError("no")

    stages = [
        job.Stage("pairs", lambda a, b: a.join(b, "id"), ("left", "right")), job.Stage("left", lambda: spark.range(5)), job.Stage("right", lambda: spark.range(3)),
        job.Stage("bad", fails, ("left",)), job.Stage("after", lambda x: x, ("bad",)),
    ]
    made, metrics = job.run(spark, stages)
    got = {r.name: (r.rows, r.return_code) for r in metrics.collect()}
    assert got == {"left": (5, 0), "right": (3, 0), "pairs": (3, 0), "bad": (None, 1), "after": (None, 2)} and set(made) == {"left", "right", "pairs"}
    said = json.loads(job.summary(metrics, run="r1"))
    assert said["failed"] == ["bad", "after"] and said["rows"] == 11 and said["run"] == "r1"
    with pytest.raises(ValueError):
        job.run(spark, [stages[1], stages[1]])


def test_verdicts_count_where_they_are_needed(spark):
    texts = spark.createDataFrame([("d", "e1", 1, "ACME LTD INVOICE\n01/02/2026\nVAT: EUR 2.30\nTotal: EUR 12.30"), ("d", "e2", 2, "ACME LTD INVOICE\n01/02/2026\nVAT: EUR 2.30\nTotal: EUR 99.30")], "doc_id string, engine string, ordinal int, text string")
    sure = spark.createDataFrame([("d", "e1", 1.0), ("d", "e2", 1.0)], "doc_id string, engine string, confidence double")
    verdicts = spark.createDataFrame([("d", "total", 1.0), ("d", "vendor", 0.1)], "doc_id string, field_id string, verifier double")
    fields, documents = job.extract(texts, sure, verdicts)
    assert {r.field_id: r.verifier for r in fields.collect()} == {"total": 1.0, "vendor": None, "vat": None, "date": None}
    assert [tuple(r) for r in documents.collect()] == [("d", True, None)]


def test_typed_answers_are_an_engine(spark):
    """A model's values are taken as they are, whatever its text says; its confidence is the mean of the fields it gave."""
    texts = spark.createDataFrame([("d", "e1", 1, "ACME LTD INVOICE\n01/02/2026\nVAT: EUR 2.30\nTotal: EUR 12.30")], "doc_id string, engine string, ordinal int, text string")
    sure = spark.createDataFrame([("d", "e1", 0.8)], "doc_id string, engine string, confidence double")
    answers = spark.createDataFrame([("d", '{"vendor": "Acme Ltd", "vendor_confidence": 1.0, "total": 12.3, "total_confidence": 0.6, "vat": 9.9, "vat_confidence": 0.8, "date": null}'), ("e", "no json")], "doc_id string, answer string")
    fields, _ = job.extract(texts, sure, answers=answers)
    got = {r.field_id: (r.value, r.agreed, round(r.ocr, 9)) for r in fields.filter("doc_id = 'd'").collect()}
    assert got["total"][1:] == (True, 0.8) and got["vendor"][1:] == (True, 0.8) and got["vat"][1:] == (False, 0.8) and got["date"] == ("01/02/2026", False, 0.8)
    assert fields.filter("doc_id = 'e'").count() == 0


def test_reports(spark):
    q = catalogue.queries()
    card, accuracy = q["extraction_scorecard"](spark, "/root/testdata/sf0.001"), q["extraction_accuracy"](spark, "/root/testdata/sf0.001")
    text = scoring.markdown(card, accuracy)
    assert text.count("\n| ") >= 2 * 16 + 2 and "97 %" in text and "| credit_note |" in text
    assert governance.manifest_report(q["licence_manifest"](spark, "/root/testdata/sf0.001")).startswith("| Source | Licence")
    rows = q["overdue_alert"](spark, "/root/testdata/sf0.001").withColumn("tenant_id", F.lit("t")).collect()
    said = rescue.alert_text(rows)
    assert rows and said.startswith(f"{rows[0].n_overdue} extraction(s) past 3") and rescue.alert_text([]) == ""


def test_labels_and_families(spark):
    labels = governance.broken_rules(3)
    from ledgerloom.plans.generated import _labels

    rows = _labels(spark, "/root/testdata/sf0.001")
    good, bad = rows.filter(F.size(labels) == 0), rows.filter(F.size(labels) > 0)
    assert governance.require_valid(good).count() == good.count()
    with pytest.raises(Exception, match="breaks"):
        governance.require_valid(bad).collect()
    generator.families_hold()
    with pytest.raises(ValueError):
        generator.families_hold(generator.RULES[:15] + generator.RULES[:1])


def test_ibans_check(spark):
    docs = generator.documents(spark.range(64).withColumnRenamed("id", "place")).collect()
    number = lambda s: int("".join(str(int(c, 36)) for c in s[4:] + s[:4]))
    assert all(len(r.vendor_iban) == 22 and number(r.vendor_iban) % 97 == 1 for r in docs)


def test_the_generator_does_not_depend_on_partitions(spark):
    ids = spark.range(200).withColumnRenamed("id", "place")
    one_, many = (sorted(map(str, generator.line_items(generator.documents(x)).collect())) for x in (ids.coalesce(1), ids.repartition(7)))
    assert one_ == many
    # a solicitor's document has a fee
    fees = generator.line_items(generator.documents(spark.range(4, 6000, 16).withColumnRenamed("id", "place"))).groupBy("doc_id").agg(F.max("rate").alias("r"), F.min("ordinal").alias("o"))
    assert fees.filter("r <> 23.0").count() == 0 and fees.filter("o = 0").count() > 0


# the export's eight kinds of bill


BILLS = [
    ({"vendor": " Acme ", "vendor_country": "IE", "date": "01/02/2026", "total": 123.0, "vat": 23.0, "vat_rate": "23"}, ("Acme", "01/02/2026", "03/03/2026", "123.00", "100.00", "VAT on Expenses")),
    ({"vendor": "Cafe", "invoice_date": "2026-02-01", "subtotal": 10.0, "total": 10.9, "vat": 0.9, "vat_rate": "9%"}, ("Cafe", "01/02/2026", "03/03/2026", "10.90", "10.00", "VAT 9% on Expenses")),
    ({"vendor": "Books", "date": "1/2/2026", "total": 5.0, "vat": 0.0, "vat_rate": "0"}, ("Books", "01/02/2026", "03/03/2026", "5.00", "5.00", "Zero Rated Expenses")),
    ({"vendor": "Brit", "vendor_country": "GB", "currency": "GBP", "date": "1/2/2026", "total": 5.0, "vat_rate": "20"}, ("Brit", "01/02/2026", "03/03/2026", "5.00", "5.00", "EC Acquisitions (Zero Rated)")),
    ({"vendor": "Power", "date": "1/2/2026", "total": 113.5, "vat": 13.5, "vat_rate": "13.5"}, ("Power", "01/02/2026", "03/03/2026", "113.50", "100.00", "VAT 13.5% on Expenses")),
    ({"vendor": "", "date": "soon", "total": None}, ("Unknown supplier", "soon", "", "", "", "Zero Rated Expenses")),
    ({"vendor": "Acme", "date": "1/2/2026", "total": -12.3, "vat": -2.3, "vat_rate": "23.0"}, ("Acme", "01/02/2026", "03/03/2026", "-12.30", "-10.00", "VAT on Expenses")),
    ({"vendor": "Mixed", "date": "1/2/26", "total": 10.0, "vat": 1.0, "vat_rate": "mixed"}, ("Mixed", "1/2/26", "", "10.00", "9.00", "VAT on Expenses")),
]


@pytest.mark.parametrize("bill,want", BILLS)
def test_bills(spark, bill, want):
    schema = "doc_id string, vendor string, vendor_country string, date string, invoice_date string, subtotal double, total double, vat double, vat_rate string, currency string"
    df = spark.createDataFrame([("d1", *[bill.get(c.split()[0]) for c in schema.split(", ")[1:]])], schema)
    r = export.bills(df).first()
    assert (r.ContactName, r.InvoiceDate, r.DueDate, r.Total, r.UnitAmount, r.TaxType) == want
    assert r.Currency == bill.get("currency", "EUR") and len(r) == 29


def test_models_are_asked_again_and_verifiers_may_fail(spark):
    docs = spark.createDataFrame([("a", "good"), ("b", "never"), ("c", "fails")], "doc_id string, text string")

    def model(text, wrong):
        if text == "fails":
            raise TimeoutError("180 s")
        return '{"total": 1.5, "total_confidence": 1.0}' if text == "good" else "[]"

    got = {r.doc_id: (r.answer, r.tries, r.error) for r in slots.ask(docs, model).collect()}
    assert got["a"][1:] == (1, None) and got["b"] == (None, 3, "no object") and got["c"] == (None, 3, "TimeoutError: 180 s")
    answers = slots.ask(docs, model).filter("answer is not null")
    assert [(r.doc_id, r.field_id, r.value) for r in extraction.model_candidates(answers).collect()] == [("a", "total", "1.5")]
    fields = spark.createDataFrame([("a", "total", "1", "t"), ("a", "vat", None, "t")], "doc_id string, field_id string, value string, text string")
    chain = [("away", lambda: False, lambda f, v, t: ("ok", 1.0, "")), ("here", lambda: True, lambda f, v, t: ("ok", 0.5 + 0 * len(v), "seen"))]
    got = {r.field_id: (r.verdict, r.verifier) for r in slots.verify(fields, chain).collect()}
    assert got == {"total": ("ok", 0.5), "vat": ("flag", 0.0)}
    assert {r.verdict for r in slots.verify(fields, chain[:1]).collect()} == {"flag"}


def test_tables_of_a_document_are_one(spark):
    df = spark.createDataFrame([("d", [[["a", None], ["1.00"]], [], [["b", "2.00"]]])], "doc_id string, tables array<array<array<string>>>")
    flat = extraction.flat_rows(df)
    assert flat.first().rows == [["a", ""], ["1.00"], ["b", "2.00"]]
    assert [(r.row_idx, r.description, r.amount) for r in extraction.native_items(flat).collect()] == [(1, None, 1.0), (2, "b", 2.0)]


def test_backfills_are_versions(spark, tmp_path):
    c = spark.createDataFrame([(2, 7, "2026-01-02"), (1, 7, "2026-01-01"), (3, 8, "2026-01-03")], "id int, extraction_id int, submitted_at string")
    ex = spark.createDataFrame([(7, "d")], "extraction_id int, doc_id string")
    first, second = (stream.backfill(c, ex, str(tmp_path), t) for t in (1.0, 2.0))
    assert first != second and [spark.read.parquet(p).count() for p in (first, second)] == [2, 2]
