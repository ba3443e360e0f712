"""The queries over the driver tables, and the SQL that gives the same rows.

The tables hold no invoices, so each operator reads a stand-in: a document's source is its set, a long text passed the
gate, a label is the truth; events are corrections of users' (extractions') event types (fields); orders are documents
with line items. Where no table has the text an operator is for, it is made of the tables' columns, and the SQL states what
must be read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import fields, money, schema, text
from ledgerloom.operators import corrections, export, extraction, gate, governance, leakage, lineitems, pages, rescue, sampling, scoring, voting
from ledgerloom.plans import generated  # noqa: F401 (registers its queries)
from ledgerloom.plans.registry import QUERIES, SQL, query
from ledgerloom.plans.registry import table as _t
from ledgerloom.sources.shared import shared_root, spread

PASS_CHARS = 500


def _stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


# --- scoring -------------------------------------------------------------------------------------------------------


def _compared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = _t(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", F.contains(F.col("text"), F.lit("@")).alias("at"))
    found = docs.select(F.col("source").alias("set_slug"), "doc_id", (F.col("n_chars") >= PASS_CHARS).cast("int").cast("string").alias("quality"), F.col("at").cast("int").cast("string").alias("toxic"))
    results = found.unpivot(["set_slug", "doc_id"], ["quality", "toxic"], "field_id", "value")
    labels = _t(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic"))
    truth = labels.unpivot(["doc_id"], ["quality", "toxic"], "field_id", "expected")
    sets = docs.select(F.col("source").alias("set_slug"), "doc_id", (F.col("n_chars") >= PASS_CHARS).alias("gate_passed"), (F.col("n_chars") / 1024).alias("elapsed_s"))
    wrong_first = truth.withColumn("expected", F.lit("none")).withColumn("ordinal", F.lit(0))
    return sets, scoring.compare_fields(results, wrong_first.unionByName(truth.withColumn("ordinal", F.lit(1))))


_WRONG = """
  SELECT d.doc_id, max(CASE WHEN r.value = r.expected THEN 0 ELSE 1 END) AS wrong
  FROM documents d JOIN labels l USING (doc_id),
  LATERAL (VALUES (CAST(CASE WHEN d.n_chars >= 500 THEN 1 ELSE 0 END AS VARCHAR), CAST(l.quality AS VARCHAR)),
                  (CAST(CASE WHEN contains(d.text, '@') THEN 1 ELSE 0 END AS VARCHAR), CAST(l.toxic AS VARCHAR))) r(value, expected)
  WHERE r.expected IS NOT NULL GROUP BY d.doc_id
"""


@query(f"""
WITH w AS ({_WRONG}), a AS (
  SELECT d.source AS set_slug, count(*)::BIGINT AS n_docs, count(*) FILTER (d.n_chars >= 500)::BIGINT AS passed,
    count(*) FILTER (d.n_chars < 500)::BIGINT AS bounced, count(*) FILTER (d.n_chars >= 500 AND w.wrong = 1)::BIGINT AS silent_failures,
    sum(d.n_chars)::DOUBLE / 1024 AS total_time_s
  FROM documents d LEFT JOIN w USING (doc_id) GROUP BY 1)
SELECT *, passed::DOUBLE / n_docs AS straight_through_rate, bounced::DOUBLE / n_docs AS bounce_rate,
  CASE WHEN passed = 0 THEN 0.0 ELSE silent_failures::DOUBLE / passed END AS silent_failure_rate, total_time_s / n_docs AS mean_s FROM a
""")
def set_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scorecard(*_compared(spark, sf_dir))


@query(f"""
WITH w AS ({_WRONG}), a AS (
  SELECT count(*)::BIGINT AS n_docs, count(*) FILTER (d.n_chars >= 500)::BIGINT AS passed, count(*) FILTER (d.n_chars < 500)::BIGINT AS bounced,
    count(*) FILTER (d.n_chars >= 500 AND w.wrong = 1)::BIGINT AS silent_failures FROM documents d LEFT JOIN w USING (doc_id))
SELECT *, passed::DOUBLE / n_docs AS straight_through_rate, silent_failures::DOUBLE / passed AS silent_failure_rate FROM a
""")
def grand_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.totals(set_scorecard(spark, sf_dir))


@query("""
WITH r AS (
  SELECT d.source AS set_slug, r.field_id, r.value = r.expected AS correct FROM documents d JOIN labels l USING (doc_id),
  LATERAL (VALUES ('quality', CAST(CASE WHEN d.n_chars >= 500 THEN 1 ELSE 0 END AS VARCHAR), CAST(l.quality AS VARCHAR)),
                  ('toxic', CAST(CASE WHEN contains(d.text, '@') THEN 1 ELSE 0 END AS VARCHAR), CAST(l.toxic AS VARCHAR))) r(field_id, value, expected)
  WHERE r.expected IS NOT NULL)
SELECT set_slug, field_id, count(*)::BIGINT AS seen, count(*) FILTER (correct)::BIGINT AS correct, count(*) FILTER (correct)::DOUBLE / count(*) AS accuracy
FROM r GROUP BY 1, 2
""")
def field_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.field_accuracy(_compared(spark, sf_dir)[1])


# --- corrections ---------------------------------------------------------------------------------------------------


def _corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), F.col("user_id").alias("extraction_id"), F.col("event_type").alias("field_id"), F.col("value").alias("corrected_value"), _stamp("ts").alias("submitted_at"), F.col("event_id").alias("ordinal"))


def _extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("extraction_id"), F.col("c_name").alias("doc_id"), F.col("c_nationkey").alias("tenant_id"), F.col("c_mktsegment").alias("original_form"))


_LATEST = f"""
  SELECT event_id AS id, user_id AS extraction_id, event_type AS field_id, value AS corrected_value, {STAMP.format("ts")} AS submitted_at
  FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY {STAMP.format("ts")} DESC, event_id) = 1
"""


@query(_LATEST)
def latest_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrections.latest(_corrections(spark, sf_dir)).drop("ordinal")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = _extractions(spark, sf_dir).withColumn("extraction_ordinal", F.col("extraction_id"))
    return corrections.training_pairs(_corrections(spark, sf_dir), ex).drop("ordinal")


@query(f"SELECT l.*, c_name AS doc_id, c_nationkey AS tenant_id, c_mktsegment AS original_form FROM ({_LATEST}) l JOIN customer ON c_custkey = l.extraction_id")
def training_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


@query(f"""
WITH l AS ({_LATEST}), p AS (SELECT l.*, c_nationkey AS tenant_id FROM l JOIN customer ON c_custkey = l.extraction_id)
SELECT 'raw_corrections' AS metric, 'all' AS key, count(*)::BIGINT AS n FROM events
UNION ALL SELECT 'deduped_corrections', 'all', count(*)::BIGINT FROM l
UNION ALL SELECT 'training_pairs', 'all', count(*)::BIGINT FROM p
UNION ALL SELECT 'extractions_total', 'all', count(*)::BIGINT FROM customer
UNION ALL SELECT 'per_field', field_id, count(*)::BIGINT FROM p GROUP BY 2
UNION ALL SELECT 'per_tenant', CAST(tenant_id AS VARCHAR), count(*)::BIGINT FROM p GROUP BY 2
""")
def shard_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrections.shard_metrics(_corrections(spark, sf_dir), _pairs(spark, sf_dir), _extractions(spark, sf_dir))


@query(f"""
SELECT event_id AS id, user_id AS extraction_id, event_type AS field_id, value AS corrected_value, {STAMP.format("ts")} AS submitted_at,
  c_name AS doc_id, c_nationkey AS tenant_id, c_mktsegment AS original_form
FROM events JOIN customer ON c_custkey = user_id ORDER BY submitted_at, id
""")
def corrections_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrections.replay(_corrections(spark, sf_dir).drop("ordinal"), _extractions(spark, sf_dir))


@query(f"SELECT l.*, c_name AS doc_id, c_nationkey AS tenant_id, c_mktsegment AS original_form FROM ({_LATEST}) l JOIN customer ON c_custkey = l.extraction_id")
def corrections_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream, shuffled and a third of them delivered twice; the state holds the latest of each field, with its extraction."""
    import uuid

    from ledgerloom.streaming import state
    from ledgerloom.streaming.corrections import read_stream

    root = shared_root(spark) + f"/corrections-{uuid.uuid4().hex}"
    rows = _corrections(spark, sf_dir)
    rows.unionByName(rows.filter("id % 3 = 0")).repartition(8, F.xxhash64("id")).write.parquet(f"{root}/in")
    stream = read_stream(spark, f"{root}/in", rows.schema, files_at_once=3)
    state.fold_stream(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return state.folded(spark, f"{root}/out").drop("ordinal").join(_extractions(spark, sf_dir), "extraction_id")


@query(f"""
SELECT event_id AS id, user_id AS extraction_id, event_type AS field_id, value AS corrected_value, {STAMP.format("ts")} AS submitted_at, c_name AS doc_id, c_nationkey AS tenant_id, c_mktsegment AS original_form
FROM events JOIN customer ON c_custkey = user_id
""")
def notified_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a ledger that grows while it is read: each announced id is fetched once, with its extraction."""
    import uuid

    from ledgerloom.streaming.corrections import append_stream
    from ledgerloom.streaming.notifications import drain, read_ledger

    root = shared_root(spark) + f"/ledger-{uuid.uuid4().hex}"
    rows = _corrections(spark, sf_dir).drop("ordinal")
    columns = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    newest = rows.agg(F.max("id")).first()[0] or 0
    late = (F.col("id") > newest - 5000) & (F.col("id") % 97 == 5)  # their transactions end after those of larger ids
    options = {"path": f"{root}/ledger", "since": "-1"}
    for part in (~late, late):
        rows.filter(part).repartitionByRange(4, "id").sortWithinPartitions("id").write.mode("append").parquet(f"{root}/ledger")
        drain(lambda: append_stream(read_ledger(spark, columns, f"{root}/state", **options), _extractions(spark, sf_dir), f"{root}/out", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/out")


_PENDING = """
  SELECT o_orderkey AS id, o_custkey AS tenant_id, o_orderdate FROM orders o
  WHERE o_orderstatus = 'P' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey = o.o_orderkey)
"""


class _Flaky:
    """A receiver that refuses ids that 11 divides, and is down for some groups' first calls."""

    def __init__(self) -> None:
        self.calls: dict[int, int] = {}

    def __call__(self, rows: list[dict]) -> list[str | None]:
        first = rows[0]["id"]
        self.calls[first] = self.calls.get(first, 0) + 1
        if first % 5 == 4 or self.calls[first] <= first % 5:
            raise ConnectionError("the receiver is down")
        return ["refused" if r["id"] % 11 == 0 else None for r in rows]


@query(f"""
SELECT id, CASE WHEN id % 5 = 4 OR id % 11 = 0 THEN 'dead' ELSE 'sent' END AS status, CASE WHEN id % 5 = 4 THEN 4 ELSE id % 5 + 1 END::INT AS attempts,
  CASE WHEN id % 5 = 4 THEN 'ConnectionError: the receiver is down' WHEN id % 11 = 0 THEN 'refused' END AS reason, sha256('outbox:' || CAST(id AS VARCHAR)) AS key FROM ({_PENDING})
""")
def outbox_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review queue pushed to a receiver that fails, one row a call: what became of each row."""
    import uuid

    from ledgerloom.streaming.outbox import Outbox, Retry

    box = Outbox(spark, shared_root(spark) + f"/outbox-{uuid.uuid4().hex}", "long")
    queue = _queue(spark, sf_dir).select("id", F.to_json(F.struct("tenant_id", "created_at")).alias("payload"))
    for batch in range(2):  # the second one offers the first one's rows again
        box.offer(queue.filter(F.col("id") % 2 == 0) if batch == 0 else queue, batch)
        box.drain(_Flaky(), Retry(attempts=4, first_wait=0.0), size=1)
    return box.outcomes().select("id", "status", "attempts", "reason", "key")


# --- review queue --------------------------------------------------------------------------------------------------


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("tenant_id"), (F.col("o_orderstatus") != "P").alias("gate_passed"), F.col("o_orderdate").alias("created_at"))
    pushed = _t(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("target_id"))
    return rescue.pending(o, pushed)


@query(f"SELECT id, tenant_id, strftime(o_orderdate, '%Y-%m-%d') AS created FROM ({_PENDING})")
def pending_rescues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queue(spark, sf_dir).select("id", "tenant_id", F.date_format("created_at", "yyyy-MM-dd").alias("created"))


@query("""
SELECT o_orderkey AS id FROM orders JOIN customer ON c_custkey = o_custkey
WHERE o_orderstatus = 'P' AND c_mktsegment = 'MACHINERY' AND c_nationkey <> 3
""")
def plan_filtered_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue of one plan's tenants, those suppressed left out: one join instead of a query for each tenant."""
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("tenant_id"), (F.col("o_orderstatus") != "P").alias("gate_passed"), F.col("o_orderdate").alias("created_at"))
    tenants = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("tenant_id"), F.col("c_mktsegment").alias("plan"), (F.col("c_nationkey") == 3).alias("suppressed"))
    return rescue.pending(o, o.select(F.col("id").alias("target_id")).limit(0), tenants, "MACHINERY").select("id")


@query(f"""
WITH a AS (SELECT id, len(list_filter(generate_series(o_orderdate::DATE + 1, DATE '2001-08-10', INTERVAL 1 DAY), lambda x: isodow(x) < 6))::BIGINT AS business_days FROM ({_PENDING}))
SELECT id, business_days, business_days > 3 AS overdue FROM a
""")
def sla_overdue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rescue.with_age(_queue(spark, sf_dir), F.to_date(F.lit("2001-08-10"))).select("id", "business_days", "overdue")


@query("""
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS created FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate, o_orderkey LIMIT 30
""")
def oldest_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert's list: the first thirty."""
    o = _t(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    return o.orderBy("o_orderdate", "o_orderkey").limit(30).select(F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("created"))


_LATE = "len(list_filter(generate_series(o_orderdate::DATE + 1, DATE '2001-08-10', INTERVAL 1 DAY), lambda x: isodow(x) < 6))"


@query(f"""
WITH a AS (SELECT o_orderkey AS id, o_orderdate, {_LATE}::BIGINT AS business_days FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'P' AND c_mktsegment = 'MACHINERY' AND c_nationkey <> 3),
b AS (SELECT *, count(*) OVER () AS n_overdue, row_number() OVER (ORDER BY o_orderdate, id) AS place FROM a WHERE business_days > 3)
SELECT id, business_days, place::INT AS place, place <= 10 AS carried, n_overdue::BIGINT AS n_overdue FROM b WHERE place <= 30
""")
def overdue_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the alert lists of one plan's overdue failures, and how many there are."""
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("tenant_id"), (F.col("o_orderstatus") != "P").alias("gate_passed"), F.col("o_orderdate").alias("created_at"))
    tenants = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("tenant_id"), F.col("c_mktsegment").alias("plan"), (F.col("c_nationkey") == 3).alias("suppressed"))
    return rescue.overdue_alert(o, tenants, F.to_date(F.lit("2001-08-10")), plan="MACHINERY").select("id", "business_days", "place", "carried", "n_overdue")


@query(f"""
WITH p AS (SELECT 'review-' || lower(n_name) AS name, min(n_nationkey) AS project_id FROM nation WHERE n_nationkey % 4 <> 1 GROUP BY 1)
SELECT q.id, project_id::BIGINT AS project_id FROM ({_PENDING}) q JOIN customer ON c_custkey = q.tenant_id JOIN nation n ON n.n_nationkey = c_nationkey JOIN p ON p.name = 'review-' || lower(n.n_name)
""")
def queue_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue with each tenant's review project; nations stand for projects, and a quarter of them is missing."""
    nation = _t(spark, sf_dir, "nation")
    projects = nation.filter("n_nationkey % 4 <> 1").select(F.col("n_nationkey").cast("long").alias("project_id"), F.concat(F.lit("review-"), F.lower("n_name")).alias("name"))
    tenants = _t(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("tenant_id"), F.lower("n_name").alias("slug"))
    return rescue.with_project(_queue(spark, sf_dir), tenants, projects, "review-").select("id", "project_id")


# --- governance ----------------------------------------------------------------------------------------------------


@query("""
SELECT l_suppkey AS tenant_id, sha256(CAST(l_partkey AS VARCHAR)) AS file_sha256, min(row(l_shipdate, l_orderkey)).l_orderkey AS id FROM (SELECT l_suppkey, l_partkey, l_shipdate, l_orderkey FROM lineitem) GROUP BY l_suppkey, l_partkey
""".replace("min(row(l_shipdate, l_orderkey)).l_orderkey", "arg_min(l_orderkey, row(l_shipdate, l_orderkey))"))
def first_ingests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ingest of each tenant's file; suppliers stand for tenants, parts for files."""
    li = _t(spark, sf_dir, "lineitem")
    entries = li.select(F.col("l_suppkey").alias("tenant_id"), F.sha2(F.col("l_partkey").cast("string"), 256).alias("file_sha256"), F.col("l_shipdate").alias("created_at"), F.col("l_orderkey").alias("id"))
    return governance.first_ingests(entries).select("tenant_id", "file_sha256", "id")


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents")
    role = F.get(F.array(*map(F.lit, ("TRAIN", "BACKFILL", "EVAL-ONLY-PRIVATE"))), (F.col("doc_id") % 3).cast("int"))
    return d.select("doc_id", "source", F.when(F.col("lang") == "fr", governance.NON_COMMERCIAL).otherwise("CC0").alias("license_tag"), role.alias("role"))


_ENTRIES = """
  SELECT doc_id, source, CASE WHEN lang = 'fr' THEN 'CC-BY-NC-SA-4.0' ELSE 'CC0' END AS license_tag,
    CASE doc_id % 3 WHEN 0 THEN 'TRAIN' WHEN 1 THEN 'BACKFILL' ELSE 'EVAL-ONLY-PRIVATE' END AS role FROM documents
"""


@query(f"SELECT source, license_tag, role, count(*)::BIGINT AS n, license_tag = 'CC-BY-NC-SA-4.0' AND role = 'TRAIN' AS violation FROM ({_ENTRIES}) GROUP BY 1, 2, 3")
def licence_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.licence_manifest(_entries(spark, sf_dir))


@query(f"SELECT * FROM ({_ENTRIES}) WHERE license_tag = 'CC-BY-NC-SA-4.0' AND role = 'TRAIN'")
def licence_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.licence_violations(_entries(spark, sf_dir))


_FAMILY_LIST = "tradesman_rct,cafe_receipt,gp_medical,vet,solicitor_loe,restaurant_thermal,supermarket_per_letter_vat,photographed_receipt,handwritten_override,mixed_rate_retailer,professional_services,utility_bill,bank_statement,construction_supplier,credit_note,foreign_currency_mixed_vat"


@query(f"""
WITH v AS (SELECT doc_id AS k, CASE WHEN doc_id % 6 = 1 THEN 'synth-X' || doc_id ELSE 'synth-' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 12) END AS doc_id, n_chars FROM documents)
SELECT doc_id, 'doc_id' AS rule FROM v WHERE k % 6 = 1
UNION ALL SELECT doc_id, 'template_family' FROM v WHERE NOT list_contains(string_split('{_FAMILY_LIST}', ','), string_split('{_FAMILY_LIST},zoo,ark', ',')[k % 18 + 1])
UNION ALL SELECT doc_id, 'corruption_bucket' FROM v WHERE k % 5 = 4
UNION ALL SELECT doc_id, 'vat_rate' FROM v WHERE k % 7 IN (5, 6)
UNION ALL SELECT doc_id, 'total' FROM v WHERE n_chars % 9 = 0
""")
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels made of the documents' ids, some of which break a rule."""
    k, of = F.col("doc_id"), lambda x, *values: F.get(F.array(*map(F.lit, values)), (x % len(values)).cast("int"))
    derived = F.when(k % 6 == 1, F.concat(F.lit("synth-X"), k)).otherwise(F.concat(F.lit("synth-"), F.substring(F.sha2(k.cast("string"), 256), 1, 12)))
    labels = _t(spark, sf_dir, "documents").select(
        derived.alias("doc_id"), of(k, *governance.FAMILIES, "zoo", "ark").alias("template_family"), of(k, "clean", "light", "heavy", "very-heavy", "dirty").alias("corruption_bucket"),
        of(k, 0.0, 4.8, 9.0, 13.5, 23.0, 7.0, 20.0).alias("vat_rate"), F.when(F.col("n_chars") % 9 != 0, F.col("n_chars").cast("double")).alias("total"),
    )
    return governance.contract_violations(labels)


_EVENT_SCHEMA = """
{"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 10, "exclusiveMaximum": 90, "not": {"multipleOf": 7}}}, "additionalProperties": false}
"""


@query("""
WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, list_filter([CASE WHEN k < 10 THEN '$.k: minimum' END, CASE WHEN k >= 90 THEN '$.k: exclusiveMaximum' END, CASE WHEN k % 7 = 0 THEN '$.k: not' END], lambda x: x IS NOT NULL) AS errors
FROM e WHERE k < 10 OR k >= 90 OR k % 7 = 0
""")
def event_schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the events' properties break of a schema."""
    errors = _t(spark, sf_dir, "events").select("event_id", schema.first_errors(F.col("props"), _EVENT_SCHEMA).alias("errors"))
    return errors.filter(F.size("errors") > 0)


_CONVERSATION_SCHEMA = {
    "type": "object", "required": ["conv_id", "turns", "title"],
    "properties": {"conv_id": {"type": "integer", "multipleOf": 2}, "turns": {"type": "array", "minItems": 3, "items": {"$ref": "#/definitions/turn"}}, "title": {"type": "string"}},
    "definitions": {"turn": {"type": "object", "additionalProperties": False, "properties": {"turn": {"type": "integer", "maximum": 4}, "role": {"enum": ["user", "assistant"]}, "text": {"type": "string", "maxLength": 400, "pattern": "[.]$"}}}},
}


@query("""
WITH t AS (SELECT conv_id, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n, turn, role, text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
e AS (
  SELECT conv_id, 0 AS place, 0 AS i, 0 AS part, '$: required title' AS said FROM t WHERE i = 0 AND conv_id % 5 = 0
  UNION ALL SELECT conv_id, 1, 0, 0, '$.conv_id: multipleOf' FROM t WHERE i = 0 AND conv_id % 2 = 1
  UNION ALL SELECT conv_id, 2, 0, 0, '$.turns: minItems' FROM t WHERE i = 0 AND n < 3
  UNION ALL SELECT conv_id, 3, i, 0, '$.turns[' || i || '].turn: maximum' FROM t WHERE turn > 4
  UNION ALL SELECT conv_id, 3, i, 1, '$.turns[' || i || '].role: enum' FROM t WHERE role NOT IN ('user', 'assistant')
  UNION ALL SELECT conv_id, 3, i, 2, '$.turns[' || i || '].text: maxLength' FROM t WHERE length(text) > 400
  UNION ALL SELECT conv_id, 3, i, 3, '$.turns[' || i || '].text: pattern' FROM t WHERE NOT regexp_matches(text, '[.]\n?$'))
SELECT conv_id, list(said ORDER BY place, i, part)[1:3] AS errors FROM e GROUP BY 1
""")
def conversation_schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as JSON documents, and the first three things that each breaks of a schema with a reference."""
    c = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    doc = F.to_json(F.struct("conv_id", "turns", F.when(F.col("conv_id") % 5 != 0, "a title").alias("title")))
    errors = c.select("conv_id", schema.first_errors(doc, _CONVERSATION_SCHEMA).alias("errors"))
    return errors.filter(F.size("errors") > 0)


# --- line items ----------------------------------------------------------------------------------------------------


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("doc_id"), F.col("l_tax").alias("rate"), F.col("l_extendedprice").alias("net"), F.col("l_extendedprice").alias("gross"), F.col("l_returnflag").alias("letter"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_tax").alias("ordinal"))


_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
# VAT of a line in hundredths of a cent, then half-even cents in whole numbers
_VAT4 = f"({_CENTS} * CAST(round(l_tax * 100) AS BIGINT))"
_VAT2 = f"({_VAT4} // 100 + CASE WHEN {_VAT4} % 100 > 50 OR ({_VAT4} % 100 = 50 AND ({_VAT4} // 100) % 2 = 1) THEN 1 ELSE 0 END)"


@query(f"SELECT l_orderkey AS doc_id, l_tax AS rate, sum({_CENTS})::DOUBLE / 100 AS net, sum({_VAT2})::DOUBLE / 100 AS vat FROM lineitem GROUP BY 1, 2")
def tax_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitems.vat_by_rate(_items(spark, sf_dir))


@query(f"""
SELECT l_orderkey AS doc_id, l_returnflag AS letter, sum({_CENTS})::DOUBLE / 100 AS gross, arg_min(l_tax, row(l_linenumber, l_partkey, l_suppkey, l_tax)) AS rate
FROM lineitem WHERE l_returnflag <> '' GROUP BY 1, 2
""")
def letter_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitems.by_letter(_items(spark, sf_dir))


@query(f"SELECT l_orderkey AS doc_id, sum({_CENTS})::DOUBLE / 100 AS subtotal, count(*)::BIGINT AS lines FROM lineitem GROUP BY 1")
def document_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitems.totals(_items(spark, sf_dir))


@query(f"""
WITH s AS (SELECT l_orderkey, sum({_CENTS}) AS c FROM lineitem GROUP BY 1)
SELECT o_orderkey AS doc_id, o_totalprice AS total, c::DOUBLE / 100 AS subtotal, (CAST(round(o_totalprice * 100) AS BIGINT) - c)::DOUBLE / 100 AS difference,
  coalesce(abs(CAST(round(o_totalprice * 100) AS BIGINT) - c) < 1, false) AS reconciled
FROM orders LEFT JOIN s ON l_orderkey = o_orderkey
""")
def reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_totalprice").alias("total"))
    return lineitems.reconcile(o, _items(spark, sf_dir))


@query("""
SELECT o_custkey AS account, o_orderkey AS id,
  sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)::DOUBLE / 100 AS balance FROM orders
""")
def running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("account"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    return lineitems.running_balance(o).select("account", "id", "balance")


@query(f"""
WITH r AS (SELECT l_tax, ({_CENTS} * l_tax) / ({_CENTS} * (1 + l_tax)) AS ratio FROM lineitem)
SELECT l_tax AS rate, count(*)::BIGINT AS n, count(*) FILTER (abs(ratio) < 0.005 OR abs(ratio - 4.8 / 104.8) < 0.005 OR abs(ratio - 9 / 109.0) < 0.005 OR abs(ratio - 13.5 / 113.5) < 0.005 OR abs(ratio - 23 / 123.0) < 0.005)::BIGINT AS plausible FROM r GROUP BY 1
""")
def ratio_plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.round(F.col("net") * 100).cast("bigint")
    ok = money.plausible_ratio(c * F.col("rate"), c * (1 + F.col("rate")))
    return _items(spark, sf_dir).groupBy("rate").agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("plausible"))


def _bills_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders' lines as tables as they are found: open cells, entities, a table inside a cell, a summary row."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("x"))
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("x")).alias("lines"))
    price = lambda v: F.format_string("%.2f", v)
    part = lambda x: F.concat(F.lit("Part &amp; <b>no"), F.lit(".</b> "), x["l_partkey"])
    shapes = lambda x: F.element_at(F.array(
        F.concat(F.lit("<tr><td>"), part(x), F.lit("</td><td>"), x["l_linenumber"].cast("string"), F.lit("</td><td>EUR "), price(x["l_extendedprice"]), F.lit("</td></tr>")),
        F.concat(F.lit("<TR class=a><td> "), part(x), F.lit("<td>"), price(x["l_extendedprice"])),
        F.concat(F.lit("<tr><td title='</td>'>"), part(x), F.lit("<td>was "), price(x["l_quantity"]), F.lit("<td>&euro;&nbsp;"), price(x["l_extendedprice"]), F.lit("<!-- <td>1.00 -->")),
        F.concat(F.lit("<tr><td>"), part(x), F.lit("<td><table><tr><td>packed<td>x</table><td>"), price(x["l_extendedprice"]), F.lit(" EUR</tr>")),
    ), (x["l_partkey"] % 4 + 1).cast("int"))
    body = F.array_join(F.transform("lines", shapes), "")
    head, foot = F.lit("<p>Bill<table><thead><tr><td>Vendor<td>9.99<tr><td>Item<td>Qty<td>Value<tbody>"), F.lit("<tfoot><tr><td colspan=2>Subtotal<td>5.00</table>")
    return lines.select(F.col("l_orderkey").alias("doc_id"), F.concat(head, body, foot).alias("html"))


_CHECKED = "SELECT l_orderkey AS doc_id, l_partkey, l_linenumber, l_extendedprice, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS i FROM lineitem"


@query(f"""
WITH l AS ({_CHECKED}), p AS (SELECT *, sum(CASE WHEN l_partkey % 4 = 3 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS inner_rows FROM l)
SELECT doc_id, (i + 1 + coalesce(inner_rows, 0))::BIGINT AS row_idx, 'Part & no. ' || l_partkey AS description, l_partkey::DOUBLE AS quantity, l_extendedprice AS amount FROM p
""")
def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitems.table_items(_bills_html(spark, sf_dir))


@query(f"""
WITH l AS ({_CHECKED}), c AS (
  SELECT doc_id, 0 AS r, unnest([(0, 'Vendor'), (1, '9.99')]) AS c, 1 AS span FROM l WHERE i = 1
  UNION ALL SELECT doc_id, 1, unnest([(0, 'Item'), (1, 'Qty'), (2, 'Value')]), 1 FROM l WHERE i = 1
  UNION ALL SELECT doc_id, i + 1, unnest(CASE l_partkey % 4
      WHEN 0 THEN [(0, 'Part & no. ' || l_partkey), (1, l_linenumber::VARCHAR), (2, 'EUR ' || printf('%.2f', l_extendedprice))]
      WHEN 1 THEN [(0, 'Part & no. ' || l_partkey), (1, printf('%.2f', l_extendedprice))]
      WHEN 2 THEN [(0, 'Part & no. ' || l_partkey), (1, 'was ' || printf('%.2f', l_quantity)), (2, '€' || chr(160) || printf('%.2f', l_extendedprice))]
      ELSE [(0, 'Part & no. ' || l_partkey), (1, ''), (2, printf('%.2f', l_extendedprice) || ' EUR')] END), 1 FROM l
  UNION ALL SELECT doc_id, max(i) + 2, (0, 'Subtotal'), 2 FROM l GROUP BY 1 UNION ALL SELECT doc_id, max(i) + 2, (2, '5.00'), 1 FROM l GROUP BY 1)
SELECT doc_id, r::INT AS row_idx, c[1]::INT AS column_idx, span::INT AS column_span, c[2] AS text FROM c
""")
def table_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of the outer tables' cells."""
    return pages.grids(_bills_html(spark, sf_dir), "doc_id").filter("depth = 0").select("doc_id", "row_idx", "column_idx", "column_span", "text")


_BLOCK_TAGS = "html|head|title|body|nav|ul|li|div|article|h1|p|footer"


@query(rf"""
WITH c AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g') AS h FROM pages),
m AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(h, '<br[^>]*>', ' ', 'g'), '<(/?(?:{_BLOCK_TAGS}))(?:\s[^>]*)?>', chr(1) || '\1' || chr(2), 'g'), '<[^>]*>', '', 'g') AS h FROM c),
b AS (SELECT page_id, unnest(string_split(h, chr(1))[2:]) AS x, generate_subscripts(string_split(h, chr(1))[2:], 1) AS i FROM m),
t AS (SELECT page_id, i, string_split(x, chr(2))[1] AS tag, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(string_split(x, chr(2))[2], '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[\s\x0B\x{{1c}}-\x{{1f}}\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g'), ' ') AS text FROM b)
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INT AS block_idx, tag, text FROM t WHERE text <> ''
""")
def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of all pages by the block element they stand in, open paragraphs and cut off pages included."""
    return pages.blocks(_t(spark, sf_dir, "pages")).select("page_id", "block_idx", "tag", "text")


@query("""
WITH p AS (SELECT page_id, regexp_replace(regexp_extract_all(html, '<title>(.*?)</title>', 1)[1], '<[^>]*>', '', 'g') AS title,
  list_transform(regexp_extract_all(html, '<li>(.*?)</li>', 1), lambda x: regexp_replace(x, '<[^>]*>', '', 'g')) AS items FROM pages)
SELECT page_id, title, unnest(items) AS item, (generate_subscripts(items, 1) - 1)::INT AS item_idx FROM p
""")
def list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitems.list_items(_t(spark, sf_dir, "pages"))


# --- samples -------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5")
def pilot_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.pilot(_t(spark, sf_dir, "documents").select("doc_id", "source"), 5, "source", "doc_id").select("doc_id", "source")


@query("""
SELECT CASE WHEN n_chars < 614.4 THEN 'clean' WHEN n_chars < 2048 THEN 'light' WHEN n_chars < 5120 THEN 'heavy' ELSE 'very-heavy' END AS bucket, count(*)::BIGINT AS n
FROM documents GROUP BY 1
""")
def size_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").groupBy(sampling.size_bucket(F.col("n_chars"), 0.01).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS idx, (43 * 1000000 + row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS seed FROM documents")
def document_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.with_seed(_t(spark, sf_dir, "documents").select("doc_id"), 43, "doc_id").select("doc_id", "idx", "seed")


@query()
def seeded_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets by the Mersenne twister, which SQL does not have."""
    return sampling.with_bucket(document_seeds(spark, sf_dir)).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


# --- fields of a text ----------------------------------------------------------------------------------------------

_KIND = fields.KIND.replace("'", "''")
_HEADS = f"list_transform(string_split(text, chr(10))[1:8], lambda x: trim(regexp_replace(trim(x), '{_KIND}', '')))"
_FITS = "length(x) BETWEEN 4 AND 80 AND NOT (" + " OR ".join(f"contains(lower(x), '{w}')" for w in fields.NEVER_VENDOR) + ")"


def _shape(p: str) -> str:
    return p.replace("'", "''")


@query("""
WITH o AS (SELECT o_orderkey AS k, o_custkey, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)
SELECT k AS doc_id, CASE WHEN k % 5 = 0 THEN 'The Corner Cafe ' || o_custkey ELSE 'TRADERS NO ' || o_custkey || ' & SONS LTD' END AS vendor,
  CASE WHEN k % 4 = 3 THEN greatest(c::DOUBLE / 100, 5.2) ELSE c::DOUBLE / 100 END AS total, CASE WHEN k % 3 = 0 THEN (k % 9000)::DOUBLE / 100 END AS vat,
  CASE WHEN k % 7 = 0 THEN strftime(o_orderdate, '%d-%m-%y') ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date FROM o
""")
def bill_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of bills made of the orders, in several layouts, and the fields that are read back."""
    k, two = F.col("o_orderkey"), lambda v: F.format_string("%.2f", v)
    vendor = F.when(k % 5 == 0, F.concat(F.lit("The Corner Cafe "), "o_custkey")).otherwise(F.concat(F.lit("TRADERS NO "), "o_custkey", F.lit(" & SONS LTD INVOICE")))
    day = F.when(k % 7 == 0, F.date_format("o_orderdate", "dd-MM-yy")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    total = (
        F.when(k % 4 == 0, F.concat(F.lit("Subtotal EUR 1.00\nTotal: EUR "), two(F.col("o_totalprice"))))
        .when(k % 4 == 1, F.concat(F.lit("Total:\n€"), F.format_number("o_totalprice", 2)))
        .when(k % 4 == 2, F.concat(F.lit("Amount due: "), two(F.col("o_totalprice"))))
        .otherwise(F.concat(F.lit("5.20 EUR\n"), two(F.col("o_totalprice")), F.lit(" EUR")))
    )
    vat = F.when(k % 3 == 0, F.concat(F.lit("VAT 23%: EUR "), two((k % 9000) / 100))).when(k % 3 == 1, "VAT No. IE1234567A").otherwise("vat IE9 exempt EUR 3.00")
    text_ = F.concat(F.lit("Page 1\n"), vendor, F.lit("\nInvoice No: "), k, F.lit("\n"), day, F.lit("\n"), vat, F.lit("\n"), total)
    t = F.col("text")
    bills = _t(spark, sf_dir, "orders").select(k.alias("doc_id"), text_.alias("text"))
    return bills.select("doc_id", fields.vendor(t).alias("vendor"), fields.total(t).alias("total"), fields.vat(t).alias("vat"), fields.date(t).alias("date"))


@query(f"""
SELECT doc_id, coalesce(list_filter({_HEADS}, lambda x: regexp_matches(x, '{_shape(fields.CAPITALS)}') AND {_FITS})[1], list_filter({_HEADS}, lambda x: regexp_matches(x, '{_shape(fields.MIXED)}') AND {_FITS})[1]) AS vendor,
  nullif(regexp_extract(text, '{fields.DATE}', 1), '') AS date FROM documents
""")
def header_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    heads = F.array_join(F.slice(text.lines(t), 1, fields.HEAD_LINES), "\n")
    docs = spread(_t(spark, sf_dir, "documents").select("doc_id", heads.alias("heads"), fields.date(t).alias("date")))
    return docs.select("doc_id", fields.vendor(F.col("heads")).alias("vendor"), "date")


# --- votes, gate ---------------------------------------------------------------------------------------------------


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three engines read a document's first line: whole, lower-cased without its last letter, and its first word."""
    first = F.get(F.split("text", "\n"), F.lit(0))
    reads = F.array(
        F.struct(F.lit("e1").alias("engine"), F.lit(1).alias("ordinal"), first.alias("raw_text")),
        F.struct(F.lit("e2").alias("engine"), F.lit(2).alias("ordinal"), F.concat(F.lit(" "), F.lower(first)).alias("raw_text")),
        F.struct(F.lit("e3").alias("engine"), F.lit(3).alias("ordinal"), F.get(F.split(first, " "), F.lit(0)).alias("raw_text")),
    )
    return _t(spark, sf_dir, "documents").select("doc_id", F.lit("vendor").alias("field_id"), F.explode(reads).alias("r")).select("doc_id", "field_id", "r.*", F.col("r.raw_text").alias("value"))


_NORMAL = r"regexp_replace(regexp_replace(lower({0}), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"


@query(f"""
WITH f AS (SELECT doc_id, string_split(text, chr(10))[1] AS x FROM documents),
c AS (SELECT doc_id, e.engine, e.ordinal, e.raw FROM f, LATERAL (VALUES ('e1', 1, x), ('e2', 2, ' ' || lower(x)), ('e3', 3, string_split(x, ' ')[1])) e(engine, ordinal, raw)),
r AS (SELECT doc_id, engine, ordinal, raw FROM c WHERE raw <> ''),
ref AS (SELECT doc_id, engine AS ref_engine, raw AS raw_text FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(raw) DESC, ordinal) = 1),
v AS (SELECT doc_id, ref_engine, raw_text, count(*)::BIGINT AS candidates, count(*) FILTER (engine = ref_engine OR {_NORMAL.format("raw")} = {_NORMAL.format("raw_text")})::BIGINT AS agreed,
  count(*) >= 2 AND count(*) = count(*) FILTER (engine = ref_engine OR {_NORMAL.format("raw")} = {_NORMAL.format("raw_text")}) AS agreement,
  sum(CASE engine WHEN 'e1' THEN 0.75 WHEN 'e2' THEN 0.5 ELSE 0.25 END)::DOUBLE / count(*) AS ocr_confidence
FROM r JOIN ref USING (doc_id) GROUP BY 1, 2, 3)
SELECT d.doc_id, a.field_id, ref_engine, raw_text, coalesce(candidates, 0) AS candidates, coalesce(agreed, 0) AS agreed, coalesce(agreement, false) AS agreement, coalesce(ocr_confidence, 0.0) AS ocr_confidence
FROM documents d CROSS JOIN (VALUES ('vendor'), ('total'), ('vat'), ('date')) a(field_id) LEFT JOIN v ON v.doc_id = d.doc_id AND a.field_id = 'vendor'
""")
def voter_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = _candidates(spark, sf_dir)
    sure = F.when(F.col("engine") == "e1", 0.75).when(F.col("engine") == "e2", 0.5).otherwise(0.25)
    out = voting.vote(candidates, candidates.select("doc_id", "engine", sure.alias("confidence")))
    return out.select("doc_id", "field_id", "ref_engine", "raw_text", "candidates", "agreed", "agreement", "ocr_confidence")


@query("""
WITH w AS (SELECT vec_id, label, unnest(embedding) AS x FROM embeddings), q AS (SELECT vec_id, label, CAST(floor(x * 4096) AS BIGINT) AS c FROM w)
SELECT vec_id AS doc_id, 'e' || CAST(label AS VARCHAR) AS engine, round(coalesce(sum(c) FILTER (c > 0 AND c % 7 <> 0)::DOUBLE / count(*) FILTER (c > 0 AND c % 7 <> 0), 0.0) / 100, 9) AS confidence FROM q GROUP BY 1, 2
""")
def word_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of a vector are words' confidences in per cent; every seventh whole number stands on a blank word."""
    e = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.concat(F.lit("e"), F.col("label")).alias("engine"), F.explode("embedding").alias("x"))
    words = e.withColumn("conf", F.floor(F.col("x") * 4096)).select("doc_id", "engine", F.when(F.col("conf") % 7 == 0, " ").otherwise("w").alias("text"), "conf")
    return voting.word_confidence(words).withColumn("confidence", F.round("confidence", 9))


def _gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    each = []
    for i, f in enumerate(fields.FIELDS):
        value = F.when((d + i) % 17 != 0, F.lit("x"))
        verifier = F.when((d + i) % 4 != 0, ((d * 3 + i) % 101) / 100)
        each.append(F.struct(F.lit(f).alias("field_id"), value.alias("value"), ((d + i) % 3 == 0).alias("agreed"), ((d + i) % 5 != 0).alias("valid"), (((d * 7 + i * 13) % 6 + 95) / 100).alias("ocr"), verifier.alias("verifier")))
    bounces = F.when(d % 11 == 0, F.array(F.lit("vat exceeds total"))).otherwise(F.array().cast("array<string>"))
    rows = _t(spark, sf_dir, "documents").select("doc_id", bounces.alias("bounces"), F.explode(F.array(*each)).alias("f")).select("doc_id", "bounces", "f.*")
    return rows.filter(~((F.col("field_id") == "vat") & (F.col("doc_id") % 7 == 0)))  # nobody read it


_GATE = """
  SELECT doc_id, i, f, CASE WHEN (doc_id + i) % 17 = 0 OR (f = 'vat' AND doc_id % 7 = 0) THEN 0.0
    WHEN (doc_id + i) % 3 = 0 AND (doc_id + i) % 5 <> 0 THEN least(1.0::DOUBLE, (((doc_id * 7 + i * 13) % 6 + 95)::DOUBLE / 100) * 1.05::DOUBLE)
    WHEN (doc_id + i) % 4 <> 0 THEN least(1.0::DOUBLE, (((doc_id * 7 + i * 13) % 6 + 95)::DOUBLE / 100) * 0.30::DOUBLE + (((doc_id * 3 + i) % 101)::DOUBLE / 100) * 0.55::DOUBLE + CASE WHEN (doc_id + i) % 5 <> 0 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END)
    ELSE (((doc_id * 7 + i * 13) % 6 + 95)::DOUBLE / 100) * 0.5::DOUBLE END AS final
  FROM documents, (VALUES (0, 'vendor'), (1, 'total'), (2, 'vat'), (3, 'date')) v(i, f)
"""


@query(f"""
WITH g AS ({_GATE}), a AS (
  SELECT doc_id, string_agg(f || '=' || printf('%.2f', final), ', ' ORDER BY i) FILTER (final < 0.98) AS low FROM g GROUP BY 1)
SELECT doc_id, low IS NULL AND doc_id % 11 <> 0 AS gate_passed,
  CASE WHEN low IS NOT NULL AND doc_id % 11 = 0 THEN 'below-threshold: ' || low || ' | cross-field: vat exceeds total' WHEN low IS NOT NULL THEN 'below-threshold: ' || low
    WHEN doc_id % 11 = 0 THEN 'cross-field: vat exceeds total' END AS bounce_reason FROM a
""")
def gate_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.gate(_gate_rows(spark, sf_dir))


@query(f"SELECT f AS field_id, count(*)::BIGINT AS n, count(*) FILTER (final >= 0.98)::BIGINT AS passed, count(*) FILTER ((doc_id + i) % 3 <> 0)::BIGINT AS verified FROM ({_GATE}) WHERE f <> 'vat' OR doc_id % 7 <> 0 GROUP BY 1")
def composite_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _gate_rows(spark, sf_dir)
    final = gate.composite(*[F.col(c) for c in ("value", "agreed", "valid", "ocr", "verifier")])
    return rows.groupBy("field_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(final >= gate.THRESHOLD).alias("passed"), F.count_if(gate.needs_verifier(F.col("agreed"), F.col("ocr"))).alias("verified"))


@query("""
WITH o AS (SELECT o_orderkey AS k, o_totalprice AS t FROM orders)
SELECT k AS id, 'vendor' AS field_id, k % 9 <> 0 AND 2 * (k % 45) BETWEEN 3 AND 80 AS ok FROM o
UNION ALL SELECT k, 'total', k % 11 <> 0 AND t * (k % 7 - 1) BETWEEN 0 AND 1000000 FROM o
UNION ALL SELECT k, 'vat', k % 13 <> 0 FROM o
UNION ALL SELECT k, 'date', k % 17 <> 0 AND k % 40 BETWEEN 1 AND 31 AND k % 14 BETWEEN 1 AND 12 AND CASE WHEN k % 3 = 0 THEN true ELSE 1890 + k % 230 BETWEEN 1900 AND 2100 END FROM o
UNION ALL SELECT k, 'other', true FROM o
""")
def schema_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields made of the orders, good ones and bad ones."""
    k = F.col("o_orderkey")
    year = F.when(k % 3 == 0, F.lpad((k % 100).cast("string"), 2, "0")).otherwise((1890 + k % 230).cast("string"))
    made = {
        "vendor": F.when(k % 9 == 0, F.lit("1234")).otherwise(F.expr("repeat('Ab', cast(o_orderkey % 45 as int))")),
        "total": F.when(k % 11 == 0, F.lit("12,30")).otherwise((F.col("o_totalprice") * (k % 7 - 1)).cast("string")),
        "vat": F.when(k % 13 == 0, F.lit("1000000.01")).otherwise(F.lit("1000000")),
        "date": F.when(k % 17 == 0, F.lit("soon")).otherwise(F.concat((k % 40).cast("string"), F.lit("/"), (k % 14).cast("string"), F.lit("/"), year)),
        "other": F.lit("x"),
    }
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("field_id"), v.alias("value")) for n, v in made.items()])).alias("f")
    rows = _t(spark, sf_dir, "orders").select(k.alias("id"), each).select("id", "f.*")
    return rows.select("id", "field_id", gate.field_valid(F.col("field_id"), F.col("value"))["ok"].alias("ok"))


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 10 <> 0 THEN round(l_extendedprice) * (CASE l_partkey % 6 WHEN 0 THEN 23 WHEN 1 THEN 9 WHEN 2 THEN 50 WHEN 3 THEN 250 WHEN 4 THEN 0 ELSE 13.5 END) END::DOUBLE AS vat,
  (CASE WHEN l_suppkey % 8 = 0 THEN -1 WHEN l_suppkey % 8 = 1 THEN 0 ELSE 1 END * round(l_extendedprice) * (CASE l_partkey % 6 WHEN 0 THEN 123 WHEN 1 THEN 109 WHEN 4 THEN 100 WHEN 5 THEN 113.5 ELSE 150 END))::DOUBLE AS total FROM lineitem),
r AS (SELECT *, CASE WHEN total > 0 THEN vat / total ELSE 0.0 END AS ratio FROM l),
n AS (SELECT *, abs(ratio) < 0.005 OR abs(ratio - 4.8 / 104.8) < 0.005 OR abs(ratio - 9 / 109.0) < 0.005 OR abs(ratio - 13.5 / 113.5) < 0.005 OR abs(ratio - 23 / 123.0) < 0.005 AS near FROM r)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN vat IS NOT NULL THEN CAST(printf('%.4f', ratio) AS DOUBLE) END AS ratio, CASE WHEN vat IS NOT NULL THEN near END AS plausible,
  coalesce(vat IS NOT NULL AND NOT near AND total > 0, false) AS implausible_ratio, coalesce(vat > total, false) AS vat_exceeds_total FROM n
""")
def cross_field_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAT and totals made of the line items' prices: statutory shares, others, too much, none."""
    p, of = F.round("l_extendedprice"), lambda *values: F.get(F.array(*map(F.lit, values)), (F.col("l_partkey") % 6).cast("int"))
    vat = F.when(F.col("l_partkey") % 10 != 0, p * of(23.0, 9.0, 50.0, 250.0, 0.0, 13.5))
    total = F.when(F.col("l_suppkey") % 8 == 0, -1.0).when(F.col("l_suppkey") % 8 == 1, 0.0).otherwise(1.0) * p * of(123.0, 109.0, 150.0, 150.0, 100.0, 113.5)
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return _t(spark, sf_dir, "lineitem").select(*names, gate.cross_field(vat, total).alias("c")).select(*names, "c.*")


@query("""
SELECT user_id AS doc_id, substr(string_agg(event_type, chr(10) ORDER BY event_id), 1, 4000) AS text FROM events GROUP BY 1
""")
def engine_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("ordinal"), F.col("event_type").alias("raw_text"))
    return extraction.engine_text(e)


@query("""
SELECT user_id AS doc_id, substr(string_agg(event_type, chr(10) ORDER BY event_id), 1, 6000) AS text FROM events WHERE user_id % 3 <> 0 GROUP BY 1
""")
def model_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model gets of the documents that are not native."""
    form = F.when(F.col("user_id") % 3 == 0, "digital_native").when(F.col("user_id") % 3 == 1, "paper_scan")
    e = _t(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("ordinal"), F.col("event_type").alias("raw_text"), form.alias("original_form"))
    return extraction.model_text(e)


@query("""
SELECT d.doc_id, f.field_id, l.quality AS verdict FROM documents d CROSS JOIN (VALUES ('vendor'), ('total')) f(field_id) LEFT JOIN labels l ON l.doc_id = d.doc_id AND f.field_id = 'vendor'
""")
def verdict_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = F.explode(F.array(F.lit("vendor"), F.lit("total"))).alias("field_id")
    verdicts = _t(spark, sf_dir, "labels").select("doc_id", F.lit("vendor").alias("field_id"), F.col("quality").alias("verdict"))
    return extraction.with_verdicts(_t(spark, sf_dir, "documents").select("doc_id", each), verdicts)


@query("""
SELECT user_id AS doc_id, event_id AS ordinal FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY length(event_type) DESC, event_id) = 1
""")
def longest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("ordinal"), F.col("event_type").alias("raw_text"))
    return extraction.first_engine_wins(e).select("doc_id", "ordinal")


@query("""
SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 4 < 2 THEN CASE WHEN c_custkey % 4 = 0 THEN 'IE' ELSE 'ie' END || lpad(CAST(c_custkey AS VARCHAR), 7, '0') || CASE WHEN c_custkey % 3 = 0 THEN 'AB' ELSE 'C' END END AS vat_number,
  CASE WHEN c_custkey % 5 <> 0 THEN 'IE29AIBK' || lpad(CAST(c_custkey AS VARCHAR), 14, '0') END AS iban FROM customer
""")
def document_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that carry numbers made of the customers' keys, or none, or such of another shape."""
    k = F.col("c_custkey")
    digits = F.concat(F.lpad(k.cast("string"), 7, "0"), F.when(k % 3 == 0, "AB").otherwise("C"))
    vat = F.when(k % 4 == 0, F.concat(F.lit("VAT No. IE"), digits)).when(k % 4 == 1, F.concat(F.lit("vat ie"), digits)).when(k % 4 == 2, F.lit("VAT No. IE12345A")).otherwise("no number")
    iban = F.when(k % 5 != 0, F.concat(F.lit(" pay IE29AIBK"), F.lpad(k.cast("string"), 14, "0"))).otherwise(" pay IE29AIB")
    rows = _t(spark, sf_dir, "customer").select(k.alias("doc_id"), F.concat(vat, iban).alias("text"))
    return rows.select("doc_id", extraction.numbers(F.col("text")).alias("n")).select("doc_id", "n.*")


@query("""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'clean' WHEN page_id % 3 = 1 THEN 'light' ELSE 'heavy' END AS corruption_bucket,
  'corrupted/' || CASE WHEN page_id % 3 = 0 THEN 'clean' WHEN page_id % 3 = 1 THEN 'light' ELSE 'heavy' END || '/' || list_extract(string_split(url, '/'), -1) AS source_path FROM pages
""")
def corrupted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = F.get(F.array(*map(F.lit, ("clean", "light", "heavy"))), (F.col("page_id") % 3).cast("int"))
    pages = _t(spark, sf_dir, "pages").select("page_id", F.lit("clean").alias("corruption_bucket"), F.col("url").alias("source_path"))
    return extraction.corrupted(pages, bucket)


# --- export --------------------------------------------------------------------------------------------------------


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (_t(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, o["o_custkey"] == c["c_custkey"], "left").join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    state = F.get(F.array(*map(F.lit, ("IE", "DE", "US", "gb"))), F.pmod("n_nationkey", F.lit(4)))
    rate = F.get(F.array(*map(F.lit, ("23.0", "13.5", "0", "20%", "4.8"))), F.pmod("o_orderkey", F.lit(5)).cast("int"))
    return joined.select(
        F.concat(F.lit("D"), F.col("o_orderkey")).alias("doc_id"), F.col("c_name").alias("vendor"), state.alias("vendor_country"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("total"), F.lit(10.0).alias("vat"), rate.alias("vat_rate"),
    )


_FIXED = {"POCountry": "coalesce(country, '')", "Quantity": "'1'", "AccountCode": "'404'", "Currency": "'EUR'"}
_TYPES = "CASE {0} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in money.TAX_TYPES.items()) + " ELSE 'VAT on Expenses' END"


@query(f"""
WITH p AS (SELECT 'D' || o_orderkey AS doc_id, c_name, CASE n_nationkey % 4 WHEN 0 THEN 'IE' WHEN 1 THEN 'DE' WHEN 2 THEN 'US' WHEN 3 THEN 'gb' END AS country, o_orderdate,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CASE o_orderkey % 5 WHEN 0 THEN '23.0' WHEN 1 THEN '13.5' WHEN 2 THEN '0' WHEN 3 THEN '20%' ELSE '4.8' END AS rate
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey)
SELECT coalesce(c_name, 'Unknown supplier') AS "ContactName", {", ".join(f"'' AS " + '"' + h + '"' for h in export.HEADER if h in ("EmailAddress", "POAddressLine1", "POAddressLine2", "POAddressLine3", "POAddressLine4", "POCity", "PORegion", "POPostalCode", "InventoryItemCode", "Discount", "TrackingName1", "TrackingOption1", "TrackingName2", "TrackingOption2", "BrandingTheme"))},
  {", ".join(f'{v} AS "{k}"' for k, v in _FIXED.items())}, doc_id AS "InvoiceNumber", 'DocOps:' || doc_id AS "Reference", strftime(o_orderdate, '%d/%m/%Y') AS "InvoiceDate",
  strftime(o_orderdate::DATE + 30, '%d/%m/%Y') AS "DueDate", (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS "Total", coalesce(c_name, 'Supplier invoice') AS "Description",
  ((cents - 1000) // 100) || '.' || lpad(CAST((cents - 1000) % 100 AS VARCHAR), 2, '0') AS "UnitAmount", '10.00' AS "TaxAmount",
  CASE WHEN country IN ('DE', 'gb') THEN 'EC Acquisitions (Zero Rated)' ELSE {_TYPES.format("rtrim(rtrim(rtrim(rate, '%'), '.0'), '.')")} END AS "TaxType" FROM p
""")
def accounting_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.bills(_payloads(spark, sf_dir))


@query("SELECT o_orderkey AS id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7) AND o_orderstatus <> 'P' AND o_orderkey % 3 = 0 AND o_orderkey < 6000")
def clean_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of one tenant's extractions may be exported, of a list of ids; a nation is the tenant."""
    o, c = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")
    rows = o.join(c, o["o_custkey"] == c["c_custkey"]).select(F.col("o_orderkey").alias("id"), F.col("c_nationkey").cast("string").alias("tenant_id"), (F.col("o_orderstatus") != "P").alias("gate_passed"), F.col("o_orderdate").alias("created_at"))
    return export.clean(rows, "7", [str(k) for k in range(0, 6000, 3)]).select("id")


@query("""
WITH o AS (SELECT o_orderkey AS id, o_orderdate::DATE AS d FROM orders),
r AS (SELECT id, d, CASE id % 11 WHEN 0 THEN strftime(d, '%-d/%-m/%Y') WHEN 1 THEN strftime(d, '%Y-%m-%d') WHEN 2 THEN strftime(d, '%d-%m-%Y') WHEN 3 THEN strftime(d, '%-d.%-m.%Y') WHEN 4 THEN strftime(d, '%Y/%m/%d')
  WHEN 5 THEN strftime(d, '%-d %b %Y') WHEN 6 THEN strftime(d, '%-d %B %Y') WHEN 7 THEN '31/02/' || strftime(d, '%Y') WHEN 8 THEN strftime(d, '%-d/%-m/%y') WHEN 9 THEN '' END AS raw FROM o)
SELECT id, raw, CASE WHEN id % 11 <= 6 THEN strftime(d, '%d/%m/%Y') ELSE coalesce(raw, '') END AS formatted, CASE WHEN id % 11 <= 6 THEN strftime(d + 30, '%d/%m/%Y') ELSE '' END AS due FROM r
""")
def due_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders' dates as people write them, some of which are none."""
    k, shown = F.col("o_orderkey"), lambda form: F.date_format("o_orderdate", form)
    raw = F.get(
        F.array(
            shown("d/M/yyyy"), shown("yyyy-MM-dd"), shown("dd-MM-yyyy"), shown("d.M.yyyy"), shown("yyyy/MM/dd"), shown("d MMM yyyy"), shown("d MMMM yyyy"),
            F.concat(F.lit("31/02/"), shown("yyyy")), shown("d/M/yy"), F.lit(""), F.lit(None).cast("string"),
        ),
        (k % 11).cast("int"),
    )
    f = money.format_date(F.col("raw"))
    return _t(spark, sf_dir, "orders").select(k.alias("id"), raw.alias("raw")).select("id", "raw", f.alias("formatted"), money.due_date(f, 30).alias("due"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("""
SELECT page_id, CASE WHEN ext = 'pdf' THEN 'pdf' WHEN ext IN ('jpg', 'jpeg', 'png', 'tif', 'tiff', 'bmp', 'webp') THEN 'image' ELSE 'unsupported' END AS branch
FROM (SELECT page_id, lower(regexp_extract(url || CASE page_id % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '.tiff' WHEN 2 THEN '.webp' ELSE '' END, '\\.([A-Za-z0-9]+)$', 1)) AS ext FROM pages)
""")
def suffix_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerloom.sources.io import ingest_branch

    ending = F.get(F.array(*map(F.lit, (".PDF", ".tiff", ".webp", ""))), (F.col("page_id") % 4).cast("int"))
    return _t(spark, sf_dir, "pages").select("page_id", ingest_branch(F.concat("url", ending)).alias("branch"))


# --- leakage -------------------------------------------------------------------------------------------------------

def _re2(pattern: str) -> str:
    return pattern.replace("'", "''")


_MASKED = "text"
for _p in text.IDENTITY:
    _MASKED = f"regexp_replace({_MASKED}, '{_re2(_p)}', '<ID>', 'g')"


@query(f"""
WITH d AS (SELECT doc_id, text, lpad(CAST(doc_id AS VARCHAR), 7, '0') AS n FROM documents),
m AS (SELECT doc_id, {_MASKED} || ' VAT <ID> due <ID> or <ID>, pay <ID> or <ID> to <ID>, <ID>, <ID>, <ID>, IE' || n || 'abc, X' || n AS masked FROM d)
SELECT doc_id, md5(masked) AS masked_md5, length(masked)::BIGINT AS masked_chars FROM m
""")
def identity_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, each with identities made of its id behind it, and two texts that are none."""
    n = F.lpad(F.col("doc_id").cast("string"), 7, "0")
    tail = F.concat(
        F.lit(" VAT IE"), n, F.lit("A due 12/03/2025 or 2025-03-12, pay INV-"), n, F.lit(" or IE29AIBK1234567"), n, F.lit(" to a.b"), n, F.lit("@c.ie, D02 X285, +353 81 "), n,
        F.lit(", €1,200.50, IE"), n, F.lit("abc, X"), n,
    )
    masked = text.mask_identity(F.concat("text", tail))
    return spread(_t(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.md5(masked.cast("binary")).alias("masked_md5"), F.length(masked).cast("bigint").alias("masked_chars"))


_SPACED = r"regexp_replace(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"


@query(f"SELECT doc_id, CASE WHEN length(t) < 5 THEN 0 ELSE len(list_distinct(list_transform(range(1, length(t) - 3), lambda i: substr(t, i, 5)))) END::BIGINT AS shingles FROM (SELECT doc_id, {_SPACED.format('text')} AS t FROM documents)")
def shingle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.shingle_counts(_t(spark, sf_dir, "documents").select("doc_id", "text"))


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = _t(spark, sf_dir, "documents").select("doc_id", "text")
    return d.filter("doc_id % 2 = 0"), d.filter("doc_id % 2 = 1")


@query(f"""
WITH s AS (SELECT doc_id, {_SPACED.format(_MASKED)} AS t FROM documents),
g AS (SELECT doc_id, list_distinct(list_transform(range(1, length(t) - 3), lambda i: hash(substr(t, i, 5)))) AS sh FROM s WHERE length(t) >= 5),
p AS (SELECT e.doc_id AS eval_doc_id, t.doc_id AS train_doc_id, len(list_intersect(e.sh, t.sh)) AS common, len(e.sh) AS a, len(t.sh) AS b
  FROM g e JOIN g t ON e.doc_id % 2 = 1 AND t.doc_id % 2 = 0 AND len(e.sh) >= 0.85 * len(t.sh) AND len(t.sh) >= 0.85 * len(e.sh))
SELECT eval_doc_id, train_doc_id, common::DOUBLE / (a + b - common) AS jaccard, CASE WHEN common::DOUBLE / (a + b - common) >= 0.95 THEN 'hard' ELSE 'soft' END AS tier
FROM p WHERE common::DOUBLE / (a + b - common) >= 0.85
""")
def exact_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.exact_pairs(*_split(spark, sf_dir))


@query()
def lsh_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approximate form; its random family is not SQL's."""
    return leakage.lsh_pairs(*_split(spark, sf_dir))


@query("SELECT sha256(text) AS sha256, count(*)::BIGINT AS n, min(doc_id) AS first_doc_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("sha256")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc_id"))
    return d.filter("n > 1")


@query("SELECT doc_id, 'synth-' || substr(sha256(source || '|42|' || CAST(doc_id AS VARCHAR)), 1, 12) AS derived FROM documents")
def doc_id_derivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", text.derived_id(F.col("source"), F.lit(42), F.col("doc_id")).alias("derived"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
