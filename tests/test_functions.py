"""Golden rows for rounding, dates, candidates and the gate; properties against plain Python."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import fields, money, text
from ledgerloom.operators import corrections, gate, lineitems, sampling
from ledgerloom.sources import io


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_rounding_is_by_the_exact_value(spark):
    values = [2.675, 0.125, 1.005, 0.575, 0.345, -2.675, -0.125, 0.0, 1e7 + 0.005, 123456.785, *[random.Random(k).uniform(-1000, 1000) for k in range(200)], *[k / 1000 for k in range(5, 3000, 10)]]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", money.rounded(F.col("x")).alias("y"), money.two_decimals(F.col("x")).alias("t")).collect()
    assert [r.y for r in rows] == [round(r.x, 2) for r in rows]
    assert [r.t for r in rows if r.x > 0] == [f"{r.x:.2f}" for r in rows if r.x > 0]


def test_business_days(spark):
    got = one(spark, *[money.business_days(F.to_date(F.lit(a)), F.to_date(F.lit(b))) for a, b in (("2026-05-01", "2026-05-04"), ("2026-05-04", "2026-05-04"), ("2026-05-08", "2026-05-18"), ("2026-05-09", "2026-05-10"))])
    assert got == (1, 0, 6, 0)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t é", max_size=30), min_size=1, max_size=5))
def test_shingles(spark, texts):
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", text.shingles(F.col("t")).alias("s")).collect()
    for r in got:
        t = " ".join(texts[r.i].replace(" ", " ").split(" ")) if False else texts[r.i]
        spaced = re.sub(r"[ \t\n\x0b\f\r]+", " ", t).strip(" ")
        assert set(r.s) == {spaced[k : k + 5] for k in range(len(spaced) - 4)}


def test_identity_mask(spark):
    s = "IE1234567AB 12/03/2025 a@b.ie INV-20260306-764 €2092.01"
    assert one(spark, text.mask_identity(F.lit(s)))[0] == "<ID> <ID> <ID> <ID>-764 <ID>2.01"


def test_vendor_total_vat_date(spark):
    t = F.lit("ACME TOOLS LTD INVOICE\n12/03/2026\nSubtotal EUR 10.00\nVAT 23%: EUR 2.30\nTotal:\nEUR 1,012.30")
    assert one(spark, fields.vendor(t), fields.total(t), fields.vat(t), fields.date(t)) == ("ACME TOOLS LTD", 1012.30, 2.30, "12/03/2026")
    empty = F.lit("")
    assert one(spark, fields.vendor(empty), fields.total(empty), fields.vat(empty), fields.date(empty)) == (None,) * 4


def test_credit_notes_bounce(spark):
    checks = one(spark, gate.cross_field(F.lit(-2.3), F.lit(-12.3)))[0]
    assert checks["vat_exceeds_total"] and checks["plausible"] and checks["ratio"] == 0.0
    assert one(spark, money.plausible_ratio(F.lit(-2.3), F.lit(-12.3)))[0] is False


def test_latest_takes_the_first_of_equal_times(spark):
    rows = [(1, "a", "t", "2026-01-01", 0), (2, "a", "t", "2026-01-02", 1), (3, "a", "t", "2026-01-02", 2), (4, "b", "t", "2026-01-01", 3)]
    df = spark.createDataFrame(rows, "id int, extraction_id string, field_id string, submitted_at string, ordinal int")
    assert sorted(r.id for r in corrections.latest(df).collect()) == [2, 4]


def test_json_lines(spark, tmp_path):
    p = tmp_path / "c.jsonl"
    p.write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    assert sorted(r.a for r in io.read_json_lines(spark, str(p), "a int").collect()) == [1, 2]
    assert io.read_json_lines(spark, str(tmp_path / "none"), "a int").count() == 0


def test_csv_has_a_header_without_rows(spark, tmp_path):
    io.write_csv(spark.createDataFrame([], "a string, b string"), str(tmp_path / "x"))
    assert [f.read_text().strip() for f in (tmp_path / "x").glob("part-*")] == ["a,b"]


def test_discovery_and_rebuild(spark, tmp_path):
    folder = tmp_path / "fixtures" / "s1" / "samples"
    folder.mkdir(parents=True)
    for n in ("b.PDF", "a.png", "c.bmp", "d.txt"):
        (folder / n).write_bytes(b"x")
    assert [r.doc_id for r in io.discover(spark, str(tmp_path / "fixtures")).select("doc_id").collect()] == ["a", "b"]
    assert io.rebuild(spark.range(2), str(tmp_path / "v"), 1.0) != io.rebuild(spark.range(2), str(tmp_path / "v"), 2.0)


def test_buckets_and_seeds(spark):
    assert [sampling.bucket_of(s) for s in range(43_000_000, 43_000_512)].count("light") == 231
    seeds = sampling.with_seed(spark.range(100, 200).repartition(5).withColumnRenamed("id", "k"), 7, "k").orderBy("k").collect()
    assert [r.seed for r in seeds] == [7_000_000 + i for i in range(100)]
    assert one(spark, text.derived_id(F.lit("vet"), F.lit(42), F.lit(2)))[0] == "synth-78d54e7d2bd6"


@pytest.mark.parametrize("html,n", [("", 0), ("<table></table>", 0), ("<tr><td>a</td><td>1.00</td></tr>", 1), ("<tr><td>qty</td><td>item 1.00</td></tr><tr><td>a</td><td>1.00</td></tr>", 1)])
def test_tables(spark, html, n):
    assert lineitems.table_items(spark.createDataFrame([("d", html)], "doc_id string, html string")).count() == n
