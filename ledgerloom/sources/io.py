"""Sources and sinks: documents in folders, JSON, tolerant JSON lines, CSV with a header, versioned rebuilds, reports."""

from __future__ import annotations

import hashlib
import logging
import time
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.functions.text import strip

log = logging.getLogger(__name__)

# File kinds that discovery lists, and those that ingestion takes besides.
LISTED = ("pdf", "jpg", "jpeg", "png", "tif", "tiff")
IMAGES = ("jpg", "jpeg", "png", "tif", "tiff", "bmp", "webp")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def ingest_branch(path: Column) -> Column:
    """pdf, image or unsupported, by suffix."""
    s = suffix(path)
    return F.when(s == "pdf", "pdf").when(s.isin(*IMAGES), "image").otherwise("unsupported")


def discover(spark: SparkSession, folder: str, doc: str | None = None) -> DataFrame:
    """Files of the listed kinds (path, set_slug, doc_id, content, length), by path. content is read only if used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    found = files.filter(suffix(F.col("path")).isin(*LISTED))
    name = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    out = found.select("path", F.regexp_extract("path", r"([^/]+)/samples/[^/]+$", 1).alias("set_slug"), name.alias("doc_id"), "content", "length")
    return (out.filter(F.col("doc_id") == doc) if doc else out).orderBy("path")


def is_native_text(page_text: Column, least: int = 50) -> Column:
    """A PDF page is taken as text, not as an image, from so many characters on."""
    return F.length(strip(page_text)) >= least


def read_documents(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """One JSON document a file, with the file's name."""
    return spark.read.schema(schema).option("multiLine", "true").json(folder).withColumn("file_name", F.col("_metadata.file_name"))


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines; blank and malformed lines are skipped, a missing path is empty."""
    try:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def counted_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, Observation]:
    """read_json_lines(), and what is counted while the rows are read: kept and malformed lines, once an action has run over them.

    One pass: lines are parsed permissively, and those that do not fit leave behind the count.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = spark.read.schema(StructType([*fields, StructField("_bad", StringType())])).option("columnNameOfCorruptRecord", "_bad").json(path)
    seen, bad = Observation(), F.col("_bad").isNotNull()
    # every column is looked at, or lines that only fail in unread columns would count as kept
    whole = F.max(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields.names])))).alias("longest")
    return rows.observe(seen, F.count_if(~bad).alias("kept"), F.count_if(bad).alias("malformed"), whole).filter(~bad).drop("_bad"), seen


def malformed_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The lines that read_json_lines() skips, but for blank ones, to be counted or reported."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    bad = F.from_json("value", f"{schema}, _bad string" if isinstance(schema, str) else schema.add("_bad", "string"), {"columnNameOfCorruptRecord": "_bad"})["_bad"]
    return lines.select(bad.alias("line")).filter("line is not null")


def append_json_lines(df: DataFrame, path: str) -> None:
    """Appends rows as JSON lines; what JSON has no type for (dates, times, decimals, bytes) is written as text."""
    plain = [F.col(c).cast("string").alias(c) if kind in ("date", "binary") or kind.startswith(("timestamp", "decimal", "interval")) else F.col(c) for c, kind in df.dtypes]
    df.select(*plain).write.mode("append").json(path)


def overwrite_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_documents(df: DataFrame, folder: str, by: tuple[str, ...] = ("set_slug", "doc_id")) -> None:
    """One JSON document for each row, in a folder of its own below folder/set_slug=.../doc_id=.../; read_documents() reads them."""
    df.write.mode("overwrite").partitionBy(*by).json(folder)


def ingested(files: DataFrame, page_text: Column) -> DataFrame:
    """Files (path, content) with how they were made, read by their suffix and a page's text, their hash and size.

    A PDF with enough text on its first page is native and its text is kept; other PDFs and images need a model. Files of
    other kinds are an error.
    """
    branch, native = ingest_branch(F.col("path")), is_native_text(F.coalesce(page_text, F.lit("")))
    form = F.when(branch == "image", "paper_scan").when(branch == "pdf", F.when(native, "digital_native").otherwise("image_only_pdf"))
    unknown = F.raise_error(F.concat(F.lit("unsupported file: "), F.col("path"))).cast("string")
    return files.select(
        "*", F.coalesce(form, unknown).alias("original_form"), F.when(form == "digital_native", page_text).alias("native_text"),
        F.sha2("content", 256).alias("file_sha256"), F.length("content").cast("long").alias("file_size_bytes"),
    )


def discover_sets(files: DataFrame, prefix: str) -> DataFrame:
    """The sets (set_slug, n) of discover()'s files that begin with a prefix; sets without samples have no files."""
    return files.filter(F.startswith("set_slug", F.lit(prefix)) & (F.col("set_slug") != "")).groupBy("set_slug").agg(F.count(F.lit(1)).alias("n")).orderBy("set_slug")


def fetch(url: str, path: Path, get: Callable[[str], Iterator[bytes]], pause: float = 0.5) -> bool:
    """Downloads to a file unless it is there and not empty; a failed download leaves nothing. On the driver, one at a time.

    get: gives the parts of what a URL holds, such as an HTTP client's chunks.
    """
    if path.exists() and path.stat().st_size:
        return True
    path.parent.mkdir(parents=True, exist_ok=True)
    try:
        with path.open("wb") as f:
            for part in get(url):
                f.write(part)
    except Exception as e:
        log.warning("%s: %s", url, e)
        path.unlink(missing_ok=True)
        return False
    time.sleep(pause)
    return True


#: Sets that are built from public sources: those whose source is wired give URLs, the others nothing.
SetBuilder = Callable[[int], list[str]]


def build_sets(builders: dict[str, SetBuilder], folder: Path, get: Callable[[str], Iterator[bytes]], limit: int, pause: float = 0.5) -> dict[str, int]:
    """Files there are of each set after fetching the first `limit` of what its builder names."""
    out = {}
    for name, urls in builders.items():
        samples = folder / name / "samples"
        out[name] = sum(fetch(url, samples / url.rstrip("/").rsplit("/", 1)[-1], get, pause) for url in urls(limit)[:limit])
    return out


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, also for no rows. For exports of a size that one file is wanted for."""
    spark = df.sparkSession
    df.coalesce(1).write.mode("overwrite").option("header", "true").option("quoteAll", "false").option("emptyValue", "").csv(path)
    if not spark.read.text(path).head(1):  # looks at the file, not at the plan again
        spark.createDataFrame([(",".join(df.columns),)], "line string").coalesce(1).write.mode("overwrite").text(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def rebuild(df: DataFrame, folder: str, now: float | None = None) -> str:
    """A new version next to the old ones, which stay as backups; gives its path."""
    path = f"{folder.rstrip('/')}/v{int((time.time() if now is None else now) * 1000)}"
    df.write.mode("errorifexists").parquet(path)
    return path


def push_version(df: DataFrame, folder: str) -> tuple[str, bool]:
    """Writes df as a version named by its content; gives its path, and whether it is new. Content that is there is not written again."""
    spark = df.sparkSession
    row = F.struct(*[F.col(c) for c in sorted(df.columns)])
    facts = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(F.to_json(row)).cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), F.to_json(row))).alias("x")).first()
    path = f"{folder.rstrip('/')}/" + hashlib.sha256(f"{sorted(df.columns)} {facts['n']} {facts['s']} {facts['x']}".encode()).hexdigest()[:16]
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return path, False
    df.write.mode("overwrite").parquet(path)
    return path, True


def read_sql(spark: SparkSession, tables: dict[str, DataFrame], query: str) -> DataFrame:
    """A query over tables that it names in braces, as {orders}; in production they are JDBC tables, and filters reach the database.

    The names are the query's own: views of the session stay as they are.
    """
    return spark.sql(query, **tables)


#: Ranges of the key that are counted before a table is read, and rows that a task reads.
COUNTED, ROWS_A_TASK = 1000, 1_000_000


def key_ranges(counts: list[tuple[int, int]], most: int) -> list[tuple[int | None, int | None]]:
    """Ends (from, below) of ranges of a key with about `most` rows each, of rows counted in ranges (where it begins, rows).

    The first range has no lower end and the last no upper one, so rows that come meanwhile are read.
    """
    cuts, held = [], 0
    for begin, n in sorted(counts):
        if held and held + n > most:
            cuts.append(begin)
            held = 0
        held += n
    return list(zip([None, *cuts], [*cuts, None], strict=True))


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, rows_a_task: int = ROWS_A_TASK, **options: str) -> DataFrame:
    """A table of a database. With a whole-number key many tasks read it, each a range of the key.

    The ranges come from small queries: the key's ends, the rows in COUNTED ranges of one width, and again inside of those that hold
    more than a task should read, so they hold about as many rows each though keys have gaps or outliers. Null keys are in the first range. Filters and columns reach the database in every task, and a
    task that is lost reads its range again. The tasks' queries are not one snapshot: a row that is updated meanwhile is read as it is then.
    """
    asked = lambda query: spark.read.format("jdbc").options(url=url, query=query, **options).load().collect()
    if key is None:
        return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    low, high = asked(f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}")[0]
    ranges: list[tuple[int | None, int | None]] = [(None, None)]

    def counted(low: int, high: int) -> list[tuple[int, int]]:
        width = -(-(high - low + 1) // COUNTED)
        where = f"{key} BETWEEN {low} AND {high}"
        rows = asked(f"SELECT k, COUNT(*) AS n FROM (SELECT FLOOR(({key} - {low}) / {width}) AS k FROM {table} WHERE {where}) r GROUP BY k")
        out = []
        for k, n in ((int(r[0]), int(r[1])) for r in rows):
            begin = low + k * width
            out += counted(begin, min(begin + width - 1, high)) if n > rows_a_task and width > 1 else [(begin, n)]
        return out

    if low is not None:
        ranges = key_ranges(counted(int(low), int(high)), rows_a_task)
    conditions = []
    for a, b in ranges:
        ends = " AND ".join([*([f"{key} >= {a}"] if a is not None else []), *([f"{key} < {b}"] if b is not None else [])])
        conditions.append((f"({ends}) OR {key} IS NULL" if ends and a is None else ends) or "1 = 1")
    return spark.read.jdbc(url, table, predicates=conditions, properties=options)


def merged_config(defaults: Column, given: Column) -> Column:
    """A map over another: given values win, key by key."""
    kept = F.map_filter(defaults, lambda k, v: ~F.map_contains_key(given, k))
    return F.map_concat(kept, given)


def auth_header(token: str, scheme: str | None = None) -> str:
    """The authorisation header of an HTTP sink: long tokens with dots are bearer tokens, others plain ones."""
    return f"{scheme or ('Bearer' if len(token) >= 80 and '.' in token else 'Token')} {token}"


class TokenCache:
    """Access tokens by address, renewed when they are older than `seconds`."""

    def __init__(self, renew: Callable[[str], str], seconds: float = 3000, now: Callable[[], float] = time.time):
        self.renew, self.seconds, self.now, self.held = renew, seconds, now, {}

    def __call__(self, address: str) -> str:
        token, since = self.held.get(address, (None, 0.0))
        if token is None or self.now() - since >= self.seconds:
            token = self.renew(address)
            self.held[address] = token, self.now()
        return token


def push(df: DataFrame, send: Callable[[list[dict]], None], size: int = 200) -> None:
    """Rows in small groups to a sender on the executors, such as an HTTP client."""

    def each(rows) -> None:
        group: list[dict] = []
        for r in rows:
            group.append(r.asDict(recursive=True))
            if len(group) >= size:
                send(group)
                group = []
        if group:
            send(group)

    df.foreachPartition(each)
