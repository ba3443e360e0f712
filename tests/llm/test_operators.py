"""Each operator against brute force on whole small tables, and on odd rows and empty tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe_count, components, langid, lattice_lm, line_dedup, media, mixing, packing, simhash, suffix_dedup, topk


def rows(df):
    return [tuple(r) for r in df.collect()]


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# packing


def check_pieces(pieces, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for d, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want[(d, len(ids))] += len(ids)
    got, sequences, streams = Counter(), defaultdict(list), defaultdict(list)
    for d, start, n, crc, total, seq, offset in pieces:
        got[(d, total)] += n
        sequences[seq].append((offset, n))
        streams[d].append((start, n, crc, total))
    assert got == want
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0  # nothing is padded
    for d, t in docs:
        if sum(x == d for x, _ in docs) == 1:
            ids, at = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4"), 0
            for start, n, crc, _ in sorted(streams[d]):
                assert start == at and crc == zlib.crc32(ids[at : at + n].tobytes())
                at += n


def pieces(docs):
    found = packing.with_crc(packing.pack(docs)).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in found)
    return [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) for r in found]


def test_packing(docs):
    check_pieces(pieces(docs), texts(docs))


def test_packing_odd(odd, none):
    check_pieces(pieces(odd), texts(odd))
    assert rows(packing.pack(none)) == []


def test_hilbert_steps_are_neighbours():
    g = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    h = packing.hilbert(g, 3)
    assert sorted(h) == list(range(512))
    assert np.abs(np.diff(g[np.argsort(h)], axis=0)).sum(1).max() == 1


# suffix arrays


def brute_repeats(docs, w=50):
    first = {}
    order = lambda d: -(1 << 63) if d is None else d
    for d, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - w + 1):
            first[b[p : p + w]] = min(first.get(b[p : p + w], order(d)), order(d))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - w + 1):
            if first[b[p : p + w]] < order(d):
                gone[p : p + w] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return Counter(out)


def found_repeats(df):
    return Counter((d, n, sum(s["length"] for s in spans), len(spans), bytes(kept)) for d, n, spans, kept in rows(df))


def test_suffix_arrays(spark, docs, odd, none):
    assert found_repeats(suffix_dedup.remove_repeats(docs)) == brute_repeats(texts(docs))
    assert found_repeats(suffix_dedup.remove_repeats(odd)) == brute_repeats(texts(odd))
    assert rows(suffix_dedup.remove_repeats(none)) == []


def odd_texts(rng):
    base = [bytes(rng.randint(97, 97 + rng.choice([2, 3, 26]), rng.randint(0, 400)).astype(np.uint8)) for _ in range(6)] + [b"a" * 300, b"\0" * 120 + b"x\0" * 60]
    return [(int(rng.randint(12)), b"".join(base[rng.randint(len(base))][rng.randint(0, 50) : rng.randint(50, 400)] for _ in range(rng.randint(0, 5)))) for _ in range(20)]


@pytest.mark.parametrize("seed", range(12))
def test_arrays_and_levels(seed, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 97)
    docs = odd_texts(np.random.RandomState(seed))
    levels, runs = [], []
    for i in range(0, len(docs), 3):
        some = docs[i : i + 3]
        raw, lengths = b"".join(t for _, t in some), np.array([len(t) for _, t in some])
        first, count, left = suffix_dedup.segments(raw, lengths)
        e = suffix_dedup.entries(raw, lengths, np.array([d for d, _ in some]), np.arange(i, i + len(some)), first, count, left)
        new = suffix_dedup.NewArray()
        for half in (e[::2], e[1::2]):
            kept, gone = suffix_dedup.merged([half])
            runs.append(gone)
            new.add(kept)
        merge = next(r for r in range(9) if r not in [k for k, _ in levels])
        level, found = suffix_dedup.extend(new.finish(), levels, merge)
        levels = [x for x in levels if x[0] > merge] + [(merge, level)]
        runs += [*new.runs, *found]
    found = suffix_dedup.joined(np.concatenate(runs))
    got = Counter()
    for k, (d, t) in enumerate(docs):
        gone = np.zeros(len(t), bool)
        for _, s, n in found[found["row"] == k].tolist():
            gone[s : s + n + 49] = True
        runs_ = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        got[(d, len(t), int(gone.sum()), runs_, bytes(np.frombuffer(t, np.uint8)[~gone]))] += 1
    assert got == brute_repeats([(d, t.decode("latin-1")) for d, t in docs])


def test_batches_one_by_one_equal_one_run(spark, docs):
    rows_ = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 5000).withColumn("text", F.concat(F.lit("Once more: "), "text")).limit(40))
    want = brute_repeats(texts(rows_))
    for hot in (suffix_dedup.HOT, 1):
        family = suffix_dedup.SuffixFamily(spark, buckets=5, hot=hot)
        for k in (3, 0, 4, 1, 2):  # not in the order of doc_id
            family.add(rows_.filter(F.pmod("doc_id", F.lit(5)) == k).repartition(2))
            if k == 0:
                assert [r for r, _ in family.levels] == [1]
        assert [r for r, _ in family.levels] == [2, 0] and all(level.count() for _, level in family.levels)
        assert found_repeats(family.removed()) == want
    assert found_repeats(suffix_dedup.remove_repeats(rows_, parts=1)) == want


def test_a_family_is_opened_again(spark, docs, monkeypatch):
    """Each batch by another object, as in another session; a batch that fails leaves the family as it was; numbers beyond any count of batches."""
    folder = None
    for k in range(4):
        family = suffix_dedup.SuffixFamily.open(spark, folder) if folder else suffix_dedup.SuffixFamily(spark, buckets=5)
        folder, part = family.folder, docs.filter(F.pmod("doc_id", F.lit(4)) == k)
        if k == 2:
            with monkeypatch.context() as m, pytest.raises(RuntimeError):
                m.setattr(suffix_dedup, "release", lambda spark: (_ for _ in ()).throw(RuntimeError("crash")))
                family.add(part)
            family = suffix_dedup.SuffixFamily.open(spark, folder)
            assert [r for r, _ in family.levels] == [1]
            family.next_pack = (1 << 43) - (1 << 20)  # as after very many batches
        family.add(part, last=k == 3)
    again = suffix_dedup.SuffixFamily.open(spark, folder)
    assert found_repeats(again.removed()) == brute_repeats(texts(docs))
    assert again.levels == [] and again.next_pack > (1 << 43) - (1 << 20)
    with pytest.raises(ValueError, match="last batch"):
        again.add(docs)
    family = suffix_dedup.SuffixFamily(spark, buckets=5).add(docs.limit(0))
    assert rows(family.removed()) == []
    family.next_pack = 1 << 43
    with pytest.raises(Exception, match="add smaller batches"):
        family.add(docs)


def test_a_long_text_and_one_anchor(spark):
    long = "".join(f"{i * 7919 % 100003} " for i in range(400_000))
    same = "the very same phrase that stands in all of these texts"
    data = [(0, long), (1, "x" + long[1_000_000:2_000_000] + "y"), *[(i, f"{i * 31} {i} {same} {i * 17} {i}") for i in range(2, 400)]]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    assert found_repeats(suffix_dedup.remove_repeats(df)) == brute_repeats(data)


# language model


def test_language_model(docs, odd, none):
    for df in (docs, odd):
        all_ = texts(df)
        c = Counter()
        for d, t in all_:
            if not lattice_lm.is_held_out(d, 7, 2):
                c.update([*lattice_lm.words(t), b""])
        n, v = sum(c.values()), len(c)
        want = sorted((d is None, d or 0, len(lattice_lm.words(t)) + 1, sum(c[w] > 0 for w in [*lattice_lm.words(t), b""]), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*lattice_lm.words(t), b""]), 4)) for d, t in all_)
        got = lattice_lm.score(df, head_size=500).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
        assert all(r.train_tokens == n and math.isfinite(r.score) and r.score < 0 for r in got)
        assert all(r.held_out == lattice_lm.is_held_out(r.doc_id, 7, 2) for r in got)
    assert rows(lattice_lm.score(none)) == []


def ways(lattice, s):
    """All segmentations of s into pieces, or bytes of a character without a piece: (probability, uses)."""
    if not s:
        return [(1.0, Counter())]
    p = np.exp(lattice.logs)
    first = [([k], len(x)) for x, k in lattice.places.items() if s.startswith(x)]
    if s[0] not in lattice.places:
        first.append((lattice._bytes_of(s[0]), 1))
    return [(math.prod(p[at]) * q, Counter(at) + uses) for at, n in first for q, uses in ways(lattice, s[n:])]


@pytest.mark.parametrize("long", [0, 64])
def test_lattice_sums_all_segmentations(long, monkeypatch):
    monkeypatch.setattr(lattice_lm, "LONG", long)  # word by word, and together
    mark = lattice_lm.MARK
    p = {mark: 0.1, mark + "a": 0.2, "a": 0.15, "b": 0.1, "ab": 0.05, mark + "ab": 0.1, "é": 0.02}
    lattice = lattice_lm.Lattice({k: math.log(x) for k, x in p.items()}, {b: math.log(0.001) for b in range(256)}, math.log(0.3))
    some = ["a", "ab", "abab", "aabb", "ü", "aüb", "éa", "\0a", "日本", "ba", "ab"]
    n = np.zeros(len(lattice.logs))
    got = lattice.log_probabilities(some, n)
    want = np.zeros(len(n))
    for w, g in zip(some, got, strict=True):
        paths = ways(lattice, mark + w)
        z = sum(q for q, _ in paths)
        assert math.isclose(math.exp(g), z * 0.3)
        for q, uses in paths:
            for k, m in uses.items():
                want[k] += m * q / z
        want[-1] += 1
    assert np.allclose(n, want)
    again = lattice.fitted(n)
    assert math.isclose(np.exp(again.logs).sum(), 1) and again.log_probabilities(some).sum() > got.sum()


def test_scores_are_the_marginals_of_the_texts(spark):
    """The whole model once more, by listing segmentations."""
    data = [(i, t) for i, t in enumerate(["abba ab b", "ab ab é", "b a", None, "a b ab ba abx", "A\tB"] * 3)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    c, every = Counter(), Counter()
    for d, t in data:
        if not lattice_lm.is_held_out(d, 7, 2):
            c.update([*lattice_lm.words(t), b""])
    n, v = sum(c.values()), len(c)
    n1, n2 = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
    discount = n1 / (n1 + 2 * n2) if n1 else 0.5
    lattice = lattice_lm.Lattice(*lattice_lm.vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    for _ in range(lattice_lm.ROUNDS):
        uses = np.zeros(len(lattice.logs))
        for w in c:
            if w:
                paths = ways(lattice, lattice_lm.MARK + w.decode())
                for q, u in paths:
                    for k, m in u.items():
                        uses[k] += m * q / sum(x for x, _ in paths)
                uses[-1] += 1
        lattice = lattice.fitted(uses)

    def marginal(w):
        spelled = sum(q for q, _ in ways(lattice, lattice_lm.MARK + w.decode())) if w else 1.0
        return max(c[w] - discount, 0) / n + discount * v / n * spelled * math.exp(lattice.logs[-1])

    for head_size in (0, 2, 1000):
        for r in lattice_lm.score(df, head_size=head_size).collect():
            assert math.isclose(r.score, sum(math.log10(marginal(w)) for w in [*lattice_lm.words(data[r.doc_id][1]), b""]), rel_tol=1e-4), r


# exact top-k


def brute_top(vectors, k=20):
    good = [(i, v, r) for r, (i, v) in enumerate(vectors) if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(64 * x) if abs(x) < 2.0**53 else 64 * int(x) for x in v], r) for i, v, r in good]
    out = []
    for i, q, r in ints:
        if i % 20 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(q, x, strict=False)), j) for j, x, s in ints if s != r))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


def test_top_k(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert sorted(rows(topk.top_k(vectors))) == brute_top([(r.vec_id, list(r.embedding)) for r in vectors.collect()])


def test_top_k_odd(spark):
    data = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (20, [1.0, 2.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [-1.0, -2.0]), (40, [1e6, 1e9]), (8, [])]
    df = spark.createDataFrame([(*d, "x") for d in data], "vec_id long, embedding array<double>, score string")
    assert sorted(rows(topk.top_k(df))) == brute_top(data)
    assert rows(topk.top_k(df.limit(0))) == []


def test_top_k_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 3)
    rng = np.random.RandomState(4)
    data = [(i, [float(x) for x in rng.standard_normal(3) * 10.0 ** rng.randint(-3, 308 if i % 3 else 9, 3)]) for i in range(60)]
    data += [(100, [1.7e308, -1.7e308]), (120, [-1.7e308, 1e300]), (140, [1e6, 1e9]), (160, [1e6, 1e9])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(2)
    clamp = lambda s: max(topk.LONG[0], min(topk.LONG[1], s))
    assert sorted(rows(topk.top_k(df, k=7))) == [(q, n, j, clamp(s)) for q, n, j, s in brute_top(data, 7)]


def test_waves_and_trims_change_nothing(spark, monkeypatch):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = brute_top([(r.vec_id, list(r.embedding)) for r in vectors.collect()])
    monkeypatch.setattr(topk, "BLOCK", 64)
    for wave, held in ((1, 1_000_000), (64 << 20, 100)):
        monkeypatch.setattr(topk, "WAVE", wave)
        monkeypatch.setattr(topk, "HELD", held)
        assert sorted(rows(topk.top_k(vectors))) == want


def test_cutoff_loses_nothing_with_ties(spark):
    data = [(i, [float(i % 3), 1.0, 0.0, float(i % 2)]) for i in range(200)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(5)
    assert sorted(rows(topk.top_k(df))) == brute_top(data)


# token counts


def test_token_counts(docs, odd, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for df in (docs, odd):
        want = Counter((d, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for d, t in texts(df))
        assert Counter(rows(bpe_count.count_tokens(df))) == want
    assert rows(bpe_count.count_tokens(none)) == []


@pytest.mark.parametrize("t", ["", "  ", " a", "a  b ", "\n", "<s> x</s>", "a▁b", "\x00a", " " * 300, "a" * 2000, "x \n y\n\nz\n", "\U0001f44d\U0001f3fd" * 30, "日本語 中文", "　a"])
def test_token_counts_of_odd_texts(t):
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    assert bpe_count.counter(model).count(t) == len(sentencepiece.SentencePieceProcessor(model_file=model).encode(t))


# lines


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return len(b) - len(a) <= 1 and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :])


def brute_lines(docs, exact=20, least=20, min_words=None):
    norm = lambda x: x.strip(" \t\r")
    order = lambda d, k: (d is not None, d or 0, k)
    first = {}
    for d, t in docs:
        for k, x in enumerate((t or "").split("\n")):
            if len(norm(x)) >= exact:
                first[norm(x)] = min(first.get(norm(x), order(d, k)), order(d, k))
    compared = [x for x in first if len(x) >= least]
    words = {x: tuple(x.split(" ")) for x in compared}
    by_word = lambda a, b: min_words is not None and min(len(words[a]), len(words[b])) >= min_words and one_edit(words[a], words[b])
    late = {a for a in compared for b in compared if first[b] < first[a] and (one_edit(a, b) or by_word(a, b))}
    stays = lambda d, k, x: len(norm(x)) < exact or (first[norm(x)] == order(d, k) and norm(x) not in late)
    return [(d, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if stays(d, k, x))) for d, t in docs]


def test_lines(docs):
    for exact in (20, 1):
        got = line_dedup.dedupe_lines(docs, exact_chars=exact)
        assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(brute_lines(texts(docs), exact))
        assert got.columns[: len(docs.columns)] == docs.columns


def test_lines_near(spark):
    base = "abcdefghij klmnopqrst uvwxyz"
    near = [base, base[1:], base[:-1], base[:9] + "X" + base[10:], base[:14] + "Y" + base[14:], base[::-1], base[:5] + base[6] + base[5] + base[7:], base + "Z", "Z" + base]
    words = "one two three four five six seven eight nine".split(" ")
    near += [" ".join(w) for w in (words, words[1:], words[:-1], words[:4] + ["other"] + words[5:], words[:4] + ["more"] + words[4:], ["x", *words], [*words, "x"], words[:2] + ["a", "b"] + words[4:], words[:7], words[:7] + ["sevenths"], words[::-1], [*words[:4], "", *words[4:]])]
    for order in (near, near[::-1]):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(order)], "doc_id long, text string").repartition(2)
        for words_from in (None, 8, 1):
            assert sorted((r.doc_id, r.text) for r in line_dedup.dedupe_lines(df, min_words=words_from).collect()) == brute_lines(list(enumerate(order)), min_words=words_from)


def test_one_character_at_every_length(spark, monkeypatch):
    """Lines of 20 to 3000 characters, beside each an edited one; spaces, too, so the number of words changes across any bound."""
    monkeypatch.setattr(line_dedup, "FINE", 8)
    rng = np.random.RandomState(5)
    data = []
    for i, n in enumerate([*range(20, 60), 100, 257, 1000, 3000]):
        line = "".join(rng.choice(list("abcdefghijklmnop     "), n - 1)).replace("  ", "xy").strip() + "." * 3
        line = f"{i:04d}" + line
        at = rng.randint(0, len(line))
        edited = [line[:at] + line[at + 1 :], line[:at] + "#" + line[at + 1 :], line[:at] + " " + line[at:], line.replace(" ", "", 1), line.replace("x", " ", 1)][i % 5]
        data += [line, edited]
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string").repartition(3)
    want = brute_lines(list(enumerate(data)))
    assert sorted((r.doc_id, r.text) for r in line_dedup.dedupe_lines(df).collect()) == want
    assert [t for _, t in want][1::2].count("") >= 42


def test_very_long_lines(spark):
    """Lines of a million characters: a copy, one with another character in the middle, one with one more at the end."""
    line = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(1_000_000))
    data = [line, line, line[:500_000] + "#" + line[500_001:], line + "!", line[:-5], line[::-1]]
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: len(r.text) for r in line_dedup.dedupe_lines(df).collect()}
    assert got == {0: 1_000_000, 1: 0, 2: 0, 3: 0, 4: 999_995, 5: 1_000_000}


@pytest.mark.parametrize("seed", range(3))
def test_lines_of_few_words(spark, seed):
    rng = np.random.RandomState(seed)
    line = lambda: " ".join(rng.choice(["aa", "b", "ccc", "d", ""], rng.randint(6, 14)))
    data = [(i if i % 7 else None, "\n".join(line() for _ in range(rng.randint(0, 12)))) for i in range(30)]
    data = [*dict(data).items()]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    for words_from in (None, 8):
        got = line_dedup.dedupe_lines(df, min_chars=6, exact_chars=1, min_words=words_from).collect()
        assert Counter((r.doc_id, r.text) for r in got) == Counter(brute_lines(data, 1, 6, words_from))


def test_a_document_of_many_lines(spark):
    text = "\n".join(f"line {i % 15000} with a number of its own" for i in range(30000))
    r = line_dedup.dedupe_lines(spark.createDataFrame([(1, text)], "doc_id long, text string"), min_chars=10**6, exact_chars=1).first()
    assert r.text == "\n".join(text.split("\n")[:15000]) and r["__loom_n_dropped"] == 15000


def test_lines_odd(odd, none):
    got = line_dedup.dedupe_lines(odd)
    found = {(r.doc_id, r.text) for r in got.collect()}
    assert got.count() == odd.count() and (1, None) in found and (2, "") in found and (4, "one") in found
    assert (6, "") in found  # both lines are copies: one exact, one an edit away
    once = odd.filter("doc_id not in (6, 9)")
    assert Counter((r.doc_id, r.text) for r in line_dedup.dedupe_lines(once, exact_chars=1).collect()) == Counter(brute_lines(texts(once), 1))
    assert rows(line_dedup.dedupe_lines(none)) == []


# SimHash


def brute_groups(docs, shingle=3, differ=3):
    fps = [simhash.fingerprint(t, shingle) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= differ or (docs[i][0] == docs[j][0] and docs[i][0] is not None):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i in range(len(docs)):
        least[root(i)].append(docs[i][0])
    return Counter((docs[i][0], f"{fps[i]:016x}", min((d for d in least[root(i)] if d is not None), default=None)) for i in range(len(docs)))


def test_simhash(docs, odd, none):
    for df in (docs, odd):
        assert Counter(rows(simhash.near_duplicates(df))) == brute_groups(texts(df))
    assert rows(simhash.near_duplicates(none)) == []


def test_fingerprints_without_ids_link(spark, monkeypatch):
    for hot in (simhash.HOT, 1):
        monkeypatch.setattr(simhash, "HOT", hot)
        data = [(None, 0b100), (None, 0b100), (1, 0b101), (2, 0b1111110), (None, 1 << 40), (7, -1), (None, -2), (7, 0b11 << 50)]
        got = simhash.groups(spark.createDataFrame(data, "doc_id long, fp long"))
        assert {r.fp: r.component_id for r in got.collect()} == {0b100: 1, 0b101: 1, 0b1111110: 2, 1 << 40: 1, -1: 1, -2: 1, 0b11 << 50: 1}
        bridge = [(4, 0), (None, 0b111 << 10), (3, 0b111111 << 10)]
        assert {r.component_id for r in simhash.groups(spark.createDataFrame(bridge, "doc_id long, fp long")).collect()} == {3}
    assert {r.component_id for r in simhash.groups(spark.createDataFrame([(None, 5), (None, 4)], "doc_id long, fp long")).collect()} == {None}


def test_fingerprint_is_the_majority():
    import xxhash

    t = "A b C d e"
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in ("a b c", "b c d", "c d e")]
    assert simhash.fingerprint(t, 3) == sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) > 1.5)
    assert simhash.fingerprint("A b", 3) == xxhash.xxh64_intdigest(b"a b", 42) and simhash.fingerprint(None, 3) == 0


def test_gray_tree(monkeypatch):
    rng = np.random.RandomState(3)
    base = rng.randint(0, 1 << 62, 40).astype(np.uint64)
    fps = np.unique(np.concatenate([base ^ np.uint64((1 << int(rng.randint(62))) | (1 << int(rng.randint(62)))) for _ in range(20)]))
    want = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    for most in (simhash.MOST, 50):
        monkeypatch.setattr(simhash, "MOST", most)
        found = [(i, j) for a, b in simhash.GrayTree(fps).near(fps, 3) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        assert len(found) == len(want) and {*found} == {*map(tuple, want.tolist())}


def test_hot_buckets_are_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 5)
    rng = np.random.RandomState(5)
    fps = np.unique(np.concatenate([np.array([7 << 40], np.int64) ^ (np.int64(1) << rng.randint(0, 50, 300).astype(np.int64)) ^ (np.int64(1) << rng.randint(0, 50, 300).astype(np.int64))]))
    df = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps)], "fp long, rep long")
    label = {r.node: r.label for r in components.components(simhash.links(df)).collect()}
    near = np.bitwise_count((fps[:, None] ^ fps[None, :]).astype(np.uint64)) <= 3
    want = np.arange(len(fps))
    while True:
        step = np.array([want[near[i]].min() for i in range(len(fps))])
        if (step == want).all():
            break
        want = step
    assert [label.get(i, i) for i in range(len(fps))] == want.tolist()


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "u long, v long")
    assert {r.label for r in components.components(edges).filter("node < 70").collect()} == {0}


# language


def test_language(docs, odd, none):
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    held = [(got[r.doc_id].lang_pred, r.lang) for r in docs.collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values())
    odd_got = langid.identify(odd).collect()
    assert len(odd_got) == odd.count()
    assert all((r.lang_pred == "und") == (r.doc_id in (1, 2, 3)) for r in odd_got if r.doc_id not in (9,))
    assert rows(langid.identify(none)) == []
    assert langid.with_language(odd).columns[: len(odd.columns)] == odd.columns


def brute_grams(t):
    n = " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
    return Counter(n[i : i + k] for k in (1, 2, 3) for i in range(len(n) - k + 1) if n[i : i + k] != " ") if n.strip() else Counter()


def plain(code):
    return "".join(chr(x) for x in (code >> 42, code >> 21 & langid.PART, code & langid.PART) if x)


def test_parts_of_a_text_count_as_the_whole(monkeypatch):
    rng = np.random.RandomState(2)
    for size in (1, 2, 3, 7, 1 << 20):
        monkeypatch.setattr(langid, "PART_CHARS", size)
        for t in ["", "  ", "12", "a", " a", "ab  cd", "a1b2c3", "  1 ßX 日本  "] + ["".join(rng.choice([*"aab é1 "], 30)) for _ in range(20)]:
            codes, counts = langid.text_grams(t)
            assert {plain(c): n for c, n in zip(codes.tolist(), counts.tolist(), strict=True) if n} == brute_grams(t), (size, t)


def brute_languages(rows):
    """(language, score) of rows (doc_id, text, lang) by dictionaries; an n-gram's order is by length, then code points."""
    ranked = lambda c: sorted(c, key=lambda g: (-c[g], len(g), g))[:400]
    learned = defaultdict(Counter)
    for d, t, lang in rows:
        if lang is not None and t is not None and zlib.crc32(("" if d is None else str(d)).encode()) % 3 != 1:
            learned[lang] += brute_grams(t)
    profiles = {lang: {g: k for k, g in enumerate(ranked(c))} for lang, c in learned.items() if c}
    out = []
    for _, t, _ in rows:
        mine = ranked(brute_grams(t or ""))
        far = {lang: sum(abs(k - p[g]) if g in p else 400 for k, g in enumerate(mine)) for lang, p in sorted(profiles.items())}
        best = min(far, key=far.get, default=None)
        out.append((best, max(0.0, 1 - far[best] / (400 * len(mine)))) if mine and far else ("und", 0.0))
    return out


def test_prediction_is_the_nearest_profile(docs, odd):
    for df in (docs, odd):
        some = [(r.doc_id, r.text, r.lang) for r in df.collect()]
        want = Counter((d, lang, round(score, 9)) for (d, _, _), (lang, score) in zip(some, brute_languages(some), strict=True))
        assert Counter((r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.identify(df).collect()) == want


def test_ngrams():
    import pyarrow as pa

    some = ["Abc, déf abc!", "x", "a b", "Über 1234 ab", "日本 語abc"]

    b = next(langid._learn(iter([pa.RecordBatch.from_arrays([pa.array(["e"] * 5), pa.array(some)], names=["lang", "text"])])))
    assert {plain(c): n for c, n in zip(b.column("gram").to_pylist(), b.column("n").to_pylist(), strict=True)} == dict(sum(map(brute_grams, some), Counter()))


# mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > most * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target


def check_mix(df):
    size = lambda t: len((t or "").encode().split())
    sizes, taken, biggest = Counter(), Counter(), Counter()
    for r in df.collect():
        sizes[r.source] += size(r.text)
        biggest[r.source] = max(biggest[r.source], size(r.text))
    want = brute_targets(dict(sizes))
    got = mixing.mix(df).collect()
    assert len(got) == df.count()
    by_size = {n: s for s, n in sizes.items()}
    assert len(by_size) == len(sizes)  # the sources are told by their sizes, as ids may be null or repeat
    for r in got:
        s = by_size[r.source_size]
        taken[s] += r.taken
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], abs_tol=1e-6) and r.taken in (0, r["size"], 2 * r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s]
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df).collect()))


def test_mix(docs, odd, none):
    check_mix(docs)
    check_mix(odd.filter("coalesce(text, '') <> '' or source = 'a'"))
    assert mixing.mix(odd).count() == odd.count()
    assert rows(mixing.mix(none)) == []
    assert mixing.mixed(odd).columns == odd.columns


def test_mix_of_rows_without_ids_of_their_own(spark):
    """Null ids, one id for most of a source, and rows that repeat as a whole: each source still comes within a document of its target."""
    data = [(None if k % 3 == 0 else k, f"word {k} " * (1 + k % 5), "a") for k in range(600)]
    data += [(7 if k % 10 else 10_000 + k, f"text {k} here is one", "b") for k in range(500)]
    data += [(None, f"lone {k}", "c") for k in range(400)] + [(5, "the same row again", "d")] * 700 + [(None, "and this one too", None)] * 450
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5)
    check_mix(df)
    other = mixing.mix(df.repartition(3, "text"))
    assert sorted(map(str, mixing.mix(df).collect())) == sorted(map(str, other.collect()))
    whole = df.withColumns({"extra": F.lit("x"), "u": F.lit(1), "pid": F.lit(2), "nth": F.lit(3)})
    words = lambda rs: Counter((r.doc_id, len(r.text.split())) for r in rs)
    got, want = words(mixing.mixed(whole).collect()), Counter()
    for r in other.collect():
        want[(r.doc_id, r["size"])] += r.taken // r["size"]
    assert got == +want


def test_mixed_rows_follow_the_mix(docs):
    copies = {r.doc_id: r.taken // r["size"] for r in mixing.mix(docs).collect() if r["size"]}
    got = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert all(got[d] == n for d, n in copies.items())


# audio


def brute_feature(p):
    """The feature of a payload, sample by sample."""
    mu, a = media.mulaw_table().tolist(), media.alaw_table().tolist()
    ima = [x for i in range(0, len(p), 576) for x in sequential_adpcm(p[i : i + 576])]
    level = lambda x: f"{max(map(abs, x))}/{sum(v * v for v in x) // len(x)}"
    x = [mu[b] for b in p]
    pcm = [v for k, s in enumerate(x) for v in (s, (s + x[min(k + 1, len(x) - 1)]) // 2)]
    return f"mulaw={level(x)} alaw={level([a[b] for b in p])} adpcm={level(ima)} pcm16000={zlib.crc32(np.array(pcm, '<i2').tobytes()):08x}"


def test_audio(docs, odd, none, monkeypatch):
    monkeypatch.setattr(media, "TOGETHER", 576 * 5)  # in the driver; the workers keep theirs
    for df in (docs.limit(60), odd):
        stored_media = media.store_texts(df)
        audio = media.with_pcm(stored_media)
        got = media.digests(audio).collect()
        assert Counter(map(tuple, media.digests(stored_media).collect())) == Counter(map(tuple, got))
        assert len(got) == df.count() and stored_media.schema["media"].dataType.simpleString() == audio.schema["pcm"].dataType.simpleString() == "binary"
        want = Counter()
        for d, t in texts(df):
            b = (t or "").encode()
            p = b + b"\xff" * (-len(b) % 576 or (0 if b else 576))
            m = media.wav(p, media.MULAW, 8000)
            assert media.features([p], [media.read_wav(media.to_pcm(m))[2]]) == [brute_feature(p)]
            want[(d, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(m), hashlib.sha256(m).hexdigest(), brute_feature(p))] += 1
        assert Counter(map(tuple, got)) == want
    assert rows(media.digests(media.with_pcm(media.store_texts(none)))) == []


def test_wav_round_trip():
    data = bytes(range(256)) * 9
    for kind in (media.MULAW, media.ALAW):
        assert media.read_wav(media.wav(data, kind, 8000)) == (kind, 8000, data)
    rate, pcm = media.decode(media.to_pcm(media.wav(data, media.MULAW, 8000)))
    assert rate == 16000 and (pcm[::2] == media.mulaw_table()[np.frombuffer(data, np.uint8)]).all()


def test_g711_tables():
    mu, a = media.mulaw_table(), media.alaw_table()
    assert mu[0xFF] == 0 and mu[0x80] == 32124 and mu[0x00] == -32124 and a[0xD5] == 8 and a[0xAA] == 32256 and a[0x2A] == -32256
    assert (mu[128:] == -mu[:128]).all() and (a[128:] == -a[:128]).all()


def sequential_adpcm(block):
    steps = media._steps().tolist()
    value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            change = ((2 * (code & 7) + 1) * steps[index]) >> 3
            value = max(-32768, min(32767, value - change if code & 8 else value + change))
            index = max(0, min(88, index + media.INDEX_STEPS[code & 7]))
            out.append(value)
    return out


def test_adpcm_follows_the_sequential_decoder():
    blocks = np.random.RandomState(1).randint(0, 256, (7, 64)).astype(np.uint8)
    for block, got in zip(blocks, media.adpcm_blocks(blocks), strict=True):
        assert got.tolist() == sequential_adpcm(bytes(block))
