"""One query for each corpus operator over its whole table, with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe_count, fill_in_middle, langid, lattice_lm, line_dedup, media, mixing, packing, simhash, suffix_dedup, topk, vector_codes, warc
from ledgerloom.llm.common import table


def op1_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_crc(packing.pack(table(spark, sf_dir, "documents"))).drop("ids")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(table(spark, sf_dir, "documents"))


def op4_uniform_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_bpe_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.count_tokens(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), exact_chars=1, min_words=line_dedup.MIN_WORDS)
    return kept.select("doc_id", "text", F.col(f"{line_dedup.P}n_lines").alias("n_lines"), F.col(f"{line_dedup.P}n_dropped").alias("n_dropped"))


def op7_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_telephony_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(media.store_texts(table(spark, sf_dir, "documents")))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.index(warc.read_chunks(archives, data=False))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_hilbert_packing, op2_suffix_array_dedup, op3_lattice_likelihood, op4_uniform_threshold_topk, op5_bpe_token_counts, op6_line_dedup, op7_gray_simhash, op8_rank_order_language, op9_hash_threshold_mix, op10_telephony_audio, op11_fill_in_middle, op12_vector_codes, op13_warc_chunks, pipeline)
    return {f.__name__: f for f in ops}


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT"

#: The mix, with windows over all documents where the operator has histograms.
OP9_SQL = f"""
WITH u AS (SELECT doc_id, source, {_WORDS} AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) || ':' || CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END) AS u FROM documents),
d AS (SELECT doc_id, source, size, CAST('0x' || substr(md5(u || ':' || CAST(row_number() OVER (PARTITION BY u) AS VARCHAR)), 1, 9) AS BIGINT) AS h FROM u),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (SELECT *, 2.0::DOUBLE * source_size AS cap, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::DOUBLE AS weight FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
t AS (SELECT *, least(cap, coalesce(max(CASE WHEN level <= cap / weight THEN level END) OVER () * weight, cap)) AS target FROM l),
p AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM t),
b AS (SELECT source, h, sum(size) AS words FROM d GROUP BY 1, 2),
c AS (SELECT b.source, h, sum(words) OVER (PARTITION BY b.source ORDER BY h) AS upto, words, target - copies * source_size AS rest FROM b JOIN p ON b.source IS NOT DISTINCT FROM p.source),
k AS (SELECT source, min(h) AS h, arg_min(upto - rest < rest - (upto - words), h) AS whole FROM c WHERE upto > rest GROUP BY 1)
SELECT doc_id, size, source_size, target, (size * (copies + CASE WHEN d.h < k.h OR (d.h = k.h AND whole) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source
"""

#: Lines by their halves and a direct test for one edit, of a character in all and of a word besides in those of 8 words, where the operator joins deletion variants.
OP6_SQL = """
WITH occ AS (SELECT doc_id, i - 1 AS line_no, x, trim(x, chr(32) || chr(9) || chr(13)) AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
e AS (SELECT line, min(row(doc_id, line_no)) AS place FROM occ WHERE length(line) > 0 GROUP BY 1),
f AS (SELECT line, length(line) AS n, place FROM e WHERE length(line) >= 20),
k AS (SELECT line, n, place, base, unnest([('h', md5(substr(line, 1, base // 2))), ('t', md5(right(line, base - base // 2)))]) AS half FROM f, LATERAL (SELECT unnest([n, n - 1]) AS base)),
c AS (SELECT DISTINCT x.line AS a, y.line AS b FROM k x JOIN k y ON x.base = y.base AND x.half = y.half AND y.place < x.place),
s AS (SELECT a, b, coalesce(list_filter(range(1, length(a) + 1), lambda i: substr(a, i, 1) IS DISTINCT FROM substr(b, i, 1))[1], length(a) + 1) AS i FROM c WHERE abs(length(a) - length(b)) <= 1),
fw AS (SELECT line, string_split(line, ' ') AS u, place FROM f WHERE len(string_split(line, ' ')) >= 8),
kw AS (SELECT line, u, place, base, unnest([('h', md5(array_to_string(u[1:base // 2], chr(0)))), ('t', md5(array_to_string(u[len(u) - (base - base // 2) + 1:], chr(0))))]) AS half FROM fw, LATERAL (SELECT unnest([len(u), len(u) - 1]) AS base)),
cw AS (SELECT DISTINCT x.line AS line, x.u AS a, y.u AS b FROM kw x JOIN kw y ON x.base = y.base AND x.half = y.half AND y.place < x.place),
late AS (SELECT a AS line FROM s WHERE CASE length(a) - length(b) WHEN 0 THEN substr(a, i + 1) = substr(b, i + 1) WHEN 1 THEN substr(a, i + 1) = substr(b, i) ELSE substr(a, i) = substr(b, i + 1) END
  UNION SELECT line FROM cw WHERE CASE len(a) - len(b)
  WHEN 0 THEN len(list_filter(range(1, len(a) + 1), lambda i: a[i] <> b[i])) = 1
  WHEN 1 THEN len(list_filter(range(1, len(a) + 1), lambda i: list_concat(a[1:i - 1], a[i + 1:]) = b)) > 0
  WHEN -1 THEN len(list_filter(range(1, len(b) + 1), lambda i: list_concat(b[1:i - 1], b[i + 1:]) = a)) > 0 ELSE false END),
m AS (SELECT occ.*, length(occ.line) = 0 OR (e.place = row(occ.doc_id, occ.line_no) AND late.line IS NULL) AS stays FROM occ LEFT JOIN e USING (line) LEFT JOIN late USING (line))
SELECT doc_id, coalesce(string_agg(x, chr(10) ORDER BY line_no) FILTER (stays), '') AS text, count(*)::BIGINT AS n_lines, count(*) FILTER (NOT stays)::BIGINT AS n_dropped FROM m GROUP BY 1
UNION ALL SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL
"""


#: Units by one pattern, the parts by slices of their list; what is rebuilt must be the text.
OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, x, regexp_extract_all(x, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t, list_transform(range(4), lambda i: CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT)) AS g FROM d),
c AS (SELECT *, len(t)::BIGINT AS n, least(g[1] % (len(t) + 1), g[2] % (len(t) + 1)) AS low, greatest(g[1] % (len(t) + 1), g[2] % (len(t) + 1)) AS high,
  CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR g[3] % 100 >= 50 THEN 'plain' WHEN g[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(t[1:low], '') AS pre, array_to_string(t[low + 1:high], '') AS mid, array_to_string(t[high + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(x) AS restored_sha256
FROM p
"""


def _op12_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The rounds as one common table each: all distances of all parts, the nearest entry, and the floor of its parts' mean."""
    steps = [
        f"e AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"x AS MATERIALIZED (SELECT r, vec_id, label, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS v FROM e, range({parts}) t(p))",
        f"c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY x.vec_id NULLS LAST, e.v) - 1 AS k, x.v AS c FROM x JOIN e USING (r) QUALIFY k < {entries})",
    ]
    for i in range(rounds + 1):
        near = f"SELECT r, x.vec_id, x.label, p, x.v, min(row(list_sum(list_transform(list_zip(x.v, c), lambda y: (y[1] - y[2]) * (y[1] - y[2])))::BIGINT, k)) AS best FROM x JOIN c{i} USING (p) GROUP BY 1, 2, 3, 4, 5"
        steps.append(f"n{i} AS MATERIALIZED (SELECT r, vec_id, label, p, v, best[1] AS d, best[2] AS k FROM ({near}))")
        if i < rounds:
            down = "((s - ((s % n) + n) % n) // n)::BIGINT"  # floor, where // cuts towards zero
            mean = f"SELECT p, k, j, {down} AS m FROM (SELECT p, k, j, sum(y) AS s, count(*) AS n FROM (SELECT p, k, unnest(v) AS y, generate_subscripts(v, 1) AS j FROM n{i}) GROUP BY 1, 2, 3)"
            steps.append(f"m{i} AS (SELECT p, k, list(m ORDER BY j) AS m FROM ({mean}) GROUP BY 1, 2)")
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT p, k, coalesce(m, c) AS c FROM c{i} LEFT JOIN m{i} USING (p, k))")
    steps.append(f"s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS sha FROM c{rounds})")
    steps.append(f"o AS (SELECT r, vec_id, label, string_agg(printf('%02x', k), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM n{rounds} GROUP BY 1, 2, 3)")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256 FROM o, s"


OP13_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages),
d AS (SELECT page_id, octet_length(encode(x))::BIGINT AS n, sha1(x) AS digest, max(page_id) OVER (PARTITION BY x) AS largest FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM largest THEN largest END AS refers_to
FROM d
"""


#: All pairs of a query and another row.
OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda y: y[1] * y[2]))::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM p WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
"""


def oracle_sql() -> dict[str, str]:
    """The rest is not for SQL: tokens, suffix arrays, the lattice, SimHash, profiles, audio and components have brute-force tests."""
    return {"op4_uniform_threshold_topk": OP4_SQL, "op6_line_dedup": OP6_SQL, "op9_hash_threshold_mix": OP9_SQL, "op11_fill_in_middle": OP11_SQL, "op12_vector_codes": _op12_sql(), "op13_warc_chunks": OP13_SQL}
