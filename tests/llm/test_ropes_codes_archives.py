"""Fill-in-the-middle, product codes and archives against brute force, exact round trips and odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import fill_in_middle as fim
from ledgerloom.llm import vector_codes as codes
from ledgerloom.llm import warc
from ledgerloom.llm.common import arrow_batches, met, size_setting, stored

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


# fill in the middle


def brute_fim(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 80 else "psm"
    return doc_id, n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def by_all(rows):
    return sorted(rows, key=repr)


def test_fim_documents(docs):
    want = [brute_fim(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert by_all(map(tuple, fim.transform(docs).collect())) == by_all(want)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.restored == (texts[r.doc_id] or "") for r in fim.restored(fim.transform(docs)).collect())


def test_fim_odd(spark, odd, none):
    rows = [(i, t) for i, t in enumerate(["<P> in a text", "a <M>", "x" * 70000, " " * 70000 + "y", "word\n" * 3000 + "  ", "<<S <P <M> >", "　\x85\xa0 \x1c", "a<S", ">b c", "", None])] * 2 + [(None, "no id here")]
    some = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.lit(1).alias("form"), F.lit("x").alias("output"))
    for df in (odd, some):
        want = [brute_fim(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert by_all(map(tuple, fim.transform(df).collect())) == by_all(want)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        texts = [r.text or "" for r in df.select("text").collect()]
        got = fim.digests(df).collect()
        assert sorted(r.restored_sha256 for r in got) == sorted(map(sha, texts))
        assert sorted(r.output_sha256 for r in got) == sorted(sha(w[5]) for w in want)
    assert fim.digests(none).collect() == [] and fim.restored(fim.transform(none)).collect() == []


def test_fim_every_document_is_moved_at_rate_100(docs):
    got = fim.transform(docs.filter("text <> '' and not contains(text, '<')"), rate=100, spm_rate=50).groupBy("form").count().collect()
    assert {r.form for r in got} == {"psm", "spm"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab <>PSM\n\t　é", max_size=60), st.integers(0, 10**6))
def test_rope_splits_and_restores(text, k):
    text = text * (1 + k % 90)
    units, r = UNIT.findall(text), fim.rope(text)
    assert (r.units, r.chars, "".join(fim.leaves(r))) == (len(units), len(text), text)
    a, b = fim.split(r, k % (len(units) + 1))
    assert "".join(fim.leaves(a)) == "".join(units[: k % (len(units) + 1)]) and a.units + b.units == len(units) and a.chars + b.chars == len(text)
    c, d = fim.split(r, k % (len(text) + 1), by_chars=True)
    assert "".join(fim.leaves(c)) == text[: k % (len(text) + 1)] and "".join(fim.leaves(d)) == text[k % (len(text) + 1) :]
    _, form, _, _, out = fim.arrange(text, str(k), rate=100)
    assert fim.restore("".join(fim.leaves(out)), form) == text


def test_rope_stays_balanced():
    r, rnd = fim.rope("w " * 200_000), random.Random(7)
    for _ in range(200):  # rotate the text at random places
        a, b = fim.split(r, rnd.randrange(r.units))
        r = fim.join(b, a)
    depth = lambda x: 0 if x.left is None else 1 + max(depth(x.left), depth(x.right))
    assert r.units == 200_001 and depth(r) == r.height <= 30


# vector codes


def brute_codes(rows, scale=4096, parts=8, entries=16, rounds=6):
    """The contract in plain integers."""
    kept = [(i, lab, [int(np.floor(float(x) * scale)) for x in v]) for i, v, lab in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(kept[0][2]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, _, v in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda x, book: min((far(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(near(c[p], books[p])[1], []).append(c[p])
            for k, members in groups.items():
                books[p][k] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    got = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in g) for g in got]
    by_label = {}
    for (_, lab, _), e in zip(kept, errors, strict=True):
        by_label[lab] = by_label.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in g), e, by_label[lab], sha) for (i, lab, _), g, e in zip(kept, got, errors, strict=True)]


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").select("*", F.lit("x").alias("code"), F.lit(1).alias("v"), F.lit(2).alias("salt")).repartition(3)


def test_codes_of_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = brute_codes([(r.vec_id, list(r.embedding), r.label) for r in table.collect()])
    assert sorted(map(tuple, codes.compress(table).collect())) == sorted(want)


def test_codes_odd(spark):
    rnd = random.Random(3)
    vec = lambda: [rnd.choice([0.0, -0.5, 0.25, 1.0, rnd.uniform(-1, 1)]) for _ in range(16)]
    rows = [(i, vec(), rnd.choice([1, 2, None])) for i in range(60)]
    rows += [(5, rows[5][1], 1), (5, vec(), None), (None, vec(), 2), (None, rows[3][1], None)] + [(70, [0.5] * 16, 1)] * 9
    bad = [(100, None, 1), (101, [], 1), (102, [None] * 16, 1), (103, [float("nan")] * 16, 2), (104, [float("inf")] + [0.0] * 15, 2)]
    assert by_all(map(tuple, codes.compress(vectors(spark, rows + bad)).collect())) == by_all(brute_codes(rows))
    assert codes.compress(vectors(spark, bad)).collect() == []
    few = rows[:3]
    assert by_all(map(tuple, codes.compress(vectors(spark, few)).collect())) == by_all(brute_codes(few))
    with pytest.raises(Exception, match="several lengths"):
        codes.compress(vectors(spark, [*rows, (200, [1.0] * 8, 1)])).collect()


def test_codes_of_large_components(spark):
    """Beyond 64-bit squares the same integers come out, as long as an error fits its column."""
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([3e5, -3e5]) + rnd.random() for _ in range(8)], 1) for i in range(40)]
    assert by_all(map(tuple, codes.compress(vectors(spark, rows)).collect())) == by_all(brute_codes(rows))
    wide = np.array([[1 << 40, 3], [5, 1 << 41]], dtype=object)
    assert codes.nearest(wide, np.array([[0, 0], [1 << 40, 3], [5, 1 << 41]], dtype=object))[0].tolist() == [1, 2]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 20), st.integers(1, 9))
def test_nearest_is_exact_with_ties(seed, entries, width):
    rnd = np.random.default_rng(seed)
    x, book = rnd.integers(-3, 4, (200, width)), rnd.integers(-3, 4, (entries, width))
    d = ((x[:, None, :] - book[None]) ** 2).sum(2)
    index, best = codes.nearest(x, book)
    assert (index == d.argmin(1)).all() and (best == d.min(1)).all()


def test_met_is_the_same_both_ways(spark, monkeypatch):
    rows = spark.createDataFrame([(k % 3 or None, k) for k in range(50)], "k int, v int")
    small = stored(spark.createDataFrame([(1, "a"), (None, "n"), (7, "z")], "k int, w string"))
    for how in ("inner", "left"):
        wide = by_all(map(tuple, met(rows, small, "k", F.xxhash64("v"), how).collect()))
        monkeypatch.setattr("ledgerloom.llm.common.BROADCAST_ROWS", 0)
        assert by_all(map(tuple, met(rows, small, "k", F.xxhash64("v"), how).collect())) == wide
        monkeypatch.undo()
        assert len(wide) == (34 if how == "inner" else 50)


# archives


def brute_index(rows):
    largest = {}
    for i, _, html in rows:
        t = html or ""
        if i is not None:
            largest[t] = max(largest.get(t, i), i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        top = largest.get(html or "")
        again = len(raw) >= 1000 and top is not None and i != top
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None))
    return out


BIG = "".join(chr(97 + (i * i) % 26) for i in range(5000))
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, "http://a/9", BIG), (9, "http://b/9", BIG), (None, "http://a/none", BIG), (3, None, None), (4, "", ""), (5, "u\r\nX: y", "short"), (6, "http://a/6", "short"),
    (7, "é", "ü" * 500), (8, "é", "ü" * 500), (10, "http://a/10", "ü" * 499 + "x"), (11, "x", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (12, "x", "y" * 100_001), (None, "n", "z" * 1000), (None, "n", "z" * 1000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").select("*", F.lit(1).alias("n"), F.lit("x").alias("same"), F.lit("y").alias("payload")).repartition(3)


@pytest.mark.parametrize("size", [1, 7, 4096, 1 << 20])
def test_archives_round_trip(spark, pages, size):
    some = pages.filter("length(html) < 6000 or html is null") if size == 1 else pages
    segments = warc.write_archives(some, warc.archive_folder(spark), size=size, segment=300)
    rows = [(r.page_id, r.url, r.html) for r in some.collect()]
    chunks = warc.read_chunks(segments, size=size)
    assert by_all(map(tuple, warc.index(chunks).collect())) == by_all(brute_index(rows))
    assert by_all(map(tuple, warc.index(warc.read_chunks(segments, data=False)).collect())) == by_all(brute_index(rows))
    got = {}
    for r in chunks.collect():
        assert len(r.data) <= size
        if r.record_type == "response":
            got.setdefault((r.page_id, r.url, r.record_id), {}).setdefault(r.chunk_no, set()).add((bytes(r.data), r.payload_bytes, r.payload_sha1, r.last))
    for parts in got.values():  # running lengths and digests of every chunk
        whole = b""
        for number in range(len(parts)):
            ((data, n, sha, last),) = parts[number]
            whole += data
            assert n == len(whole) and sha == hashlib.sha1(whole).hexdigest() and last == (number == len(parts) - 1)
    assert segments.count() > 1


def test_archives_are_warc(spark, pages):
    """The files by themselves: gzip members, each a record whose heads and lengths are right."""
    from pyarrow import fs

    segments = warc.write_archives(pages, warc.archive_folder(spark), segment=1 << 30).collect()
    seen = 0
    for s in segments:
        place, path = fs.FileSystem.from_uri(s.archive)
        raw = place.open_input_file(path).read()
        while raw:
            member = zlib.decompressobj(31)
            record = member.decompress(raw)
            raw, seen = member.unused_data, seen + 1
            head, rest = record.split(b"\r\n\r\n", 1)
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n") and int(fields["Content-Length"]) == len(rest) - 4
            assert {"WARC-Record-ID", "WARC-Date", "WARC-Type", "WARC-Payload-Digest"} <= fields.keys()
    assert seen == len(PAGES)


def test_archives_empty_and_damaged(spark, pages):
    none = warc.write_archives(pages.limit(0), warc.archive_folder(spark))
    assert none.collect() == [] and warc.read_chunks(none).collect() == []
    segments = warc.write_archives(pages.coalesce(1), warc.archive_folder(spark))
    short = segments.withColumn("length", F.col("length") - 9)
    with pytest.raises(Exception, match="records where|within a record|incorrect"):
        warc.read_chunks(short).collect()
    head = warc._heads(1, "u", 3, hashlib.sha1(b"abc").hexdigest(), None)
    with pytest.raises(ValueError, match="not what its heads say"):
        list(warc.parsed(iter([(head + b"abd\r\n\r\n", True)])))


def test_archives_of_pages(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    table = table.unionByName(table.withColumn("page_id", F.col("page_id") + 10_000))
    rows = [(r.page_id, r.url, r.html) for r in table.collect()]
    got = warc.index(warc.read_chunks(warc.write_archives(table, warc.archive_folder(spark)), data=False))
    assert by_all(map(tuple, got.collect())) == by_all(brute_index(rows))


# settings


def test_size_settings(spark):
    key, was = "spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        for text, n in (("64m", 64 << 20), ("64mb", 64 << 20), ("5000b", 5000), ("1g", 1 << 30), ("4096", 4096)):
            spark.conf.set(key, text)
            assert size_setting(spark, key) == n
            with arrow_batches(spark, 10, 8192):
                assert size_setting(spark, key) == min(n, 8192)
            assert spark.conf.get(key) == text
    finally:
        spark.conf.set(key, was)
