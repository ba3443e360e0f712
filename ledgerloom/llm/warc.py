"""WARC archives as a table of chunks: pages go out, and archives come in, a chunk of a record at a time.

write_archives() cuts every payload into chunks in the JVM and streams the rows (record, chunk number, bytes) of a task into
WARC/1.1 files of gzip members, a member a record, in a folder that all executors share. What it returns, and stores, is
the list of segments: file, offset, length and records of runs of whole records. Only files in that list count: a lost
task leaves a file that no list names. read_chunks() deals the segments out again, seeks, and yields one row for each chunk
of a record: its number, whether it is the last, its bytes, and the bytes and SHA-1 of the payload up to here. Neither side
of the Python work holds a record; what it holds is a chunk, a digest's state and a compressor's.

Of records with equal payloads of at least `least` bytes, that with the largest page_id is the response and the others
are revisits: they have the HTTP head, with the payload's length, its digest, and the response they refer to, but no
payload. The reader compares each response's bytes and digest with its heads, and raises where they differ.

Defined cases: a null page is an empty payload, a null url an empty one; a null page_id stays null and is the smallest: a
group without any other has only responses; rows that repeat the largest page_id of their group are each a response, with
equal record identifiers; an empty table gives no archives and no rows; other columns are ignored. Line ends in a url are
percent-encoded, as a head is made of lines.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_batches, met, size_setting, stored
from ledgerloom.sources.shared import shared_root

RESPONSE, REVISIT = "response", "revisit"
#: Bytes from which equal payloads are stored once; of a chunk; of an Arrow batch.
LEAST, CHUNK, BATCH = 1000, 1 << 20, 8 << 20
GZIP, LEVEL = 31, 1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The record's date, as pages have none.
DATE = "1970-01-01T00:00:00Z"

SEGMENTS = "archive string, start long, length long, records long"
CHUNKS = "record_id string, chunk_no long, last boolean, record_type string, page_id long, url string, refers_to string, payload_bytes long, payload_sha1 string, data binary"


def record_id(page_id: int | None, sha1: str) -> str:
    """The identifier of a page's record; the same for the same page and payload."""
    return f"<urn:page:{'' if page_id is None else page_id}:{sha1}>"


def page_of(identifier: str) -> int | None:
    """The page_id in a record_id()."""
    number = identifier.split(":")[2]
    return int(number) if number else None


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, its bytes and SHA-1, and `largest`, the page_id of the response where the page is a revisit."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"n": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload")})
    # payloads are equal if their SHA-256 is; those of few bytes are alone
    rows = rows.withColumn("same", F.when(F.col("n") >= least, F.unhex(F.sha2("payload", 256))))
    groups = rows.filter("same is not null").groupBy("same").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("members"))
    groups = stored(groups.filter("members > 1 and largest is not null").drop("members"))
    full = met(rows, groups, "same", F.xxhash64("page_id", "url"), "left")
    return full.select("page_id", "url", "payload", "n", "sha1", F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")).alias("largest"))


def chunked(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """records() as rows of at most `size` payload bytes each, in order within a partition; a revisit has one, without bytes."""
    many = F.when(F.col("largest").isNull(), F.greatest(F.ceil(F.col("n") / size), F.lit(1)).cast("int")).otherwise(F.lit(1))
    cut = F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.when(F.col("largest").isNull(), F.substring("payload", i * size + 1, F.lit(size))))
    return rows.select("page_id", "url", "n", "sha1", "largest", F.posexplode(cut).alias("chunk_no", "data"))


def _heads(page_id: int | None, url: str, n: int, sha1: str, largest: int | None) -> bytes:
    """The WARC head and the HTTP head of a record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    revisit = largest is not None
    lines = ["WARC/1.1", f"WARC-Type: {REVISIT if revisit else RESPONSE}", f"WARC-Record-ID: {record_id(page_id, sha1)}", f"WARC-Date: {DATE}"]
    if url:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(largest, sha1)}", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}", "Content-Type: application/http; msgtype=response"]
    lines.append(f"Content-Length: {len(http) + (0 if revisit else n)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, size: int = CHUNK, segment: int | None = None) -> DataFrame:
    """The stored list of the segments of the archives that it writes to the folder, a URI that pyarrow's file systems know.

    segment: bytes from which a segment is closed; None stands for what Spark lets a task read of a file.
    """
    segment = segment or size_setting(pages.sparkSession, "spark.sql.files.maxPartitionBytes")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, found, begun, records, member, sha, left = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz", None, [], 0, 0, None, None, 0
        for b in batches:
            for r in b.to_pylist():
                if out is None:
                    fs, path = pyarrow.fs.FileSystem.from_uri(name)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                if r["chunk_no"] == 0:
                    member, sha, left = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP), hashlib.sha1(), r["n"]
                    out.write(member.compress(_heads(r["page_id"], r["url"], r["n"], r["sha1"], r["largest"])))
                if r["data"]:
                    sha.update(r["data"])
                    out.write(member.compress(r["data"]))
                    left -= len(r["data"])
                if left == 0 or r["largest"] is not None:
                    if r["largest"] is None and sha.hexdigest() != r["sha1"]:
                        raise ValueError(f"the chunks of page {r['page_id']} are not its payload")
                    out.write(member.compress(b"\r\n\r\n") + member.flush())
                    records += 1
                    if out.tell() - begun >= segment:
                        found.append((name, begun, out.tell() - begun, records))
                        begun, records = out.tell(), 0
        if out is not None:
            if records:
                found.append((name, begun, out.tell() - begun, records))
            out.close()
        if found:
            columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["archive", "start", "length", "records"])

    with arrow_batches(pages.sparkSession, 1024, BATCH):
        return stored(chunked(records(pages, least), size).mapInArrow(work, SEGMENTS))


def _inflated(file, start: int, length: int, size: int) -> Iterator[tuple[bytes, bool]]:
    """The bytes of the gzip members in a part of a file, at most `size` at a time, with whether a member ends behind them."""
    file.seek(start)
    raw, held = zlib.decompressobj(GZIP), b""
    while length or held:
        if not held:
            held = file.read(min(length, 1 << 18))
            if not held:
                raise ValueError("an archive ends within a record")
            length -= len(held)
        out = raw.decompress(held, size)
        held = raw.unused_data if raw.eof else raw.unconsumed_tail
        if out or raw.eof:
            yield out, raw.eof
        if raw.eof:
            raw = zlib.decompressobj(GZIP)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode().split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def parsed(parts: Iterator[tuple[bytes, bool]], size: int = CHUNK) -> Iterator[dict]:
    """Rows of CHUNKS from the bytes of records, each ended by a True: heads first, then the payload as it comes."""
    head, fields, http, sha, total, number, left, held = b"", None, None, None, 0, 0, 0, b""
    for data, end in parts:
        if http is None:
            head += data
            if fields is None and b"\r\n\r\n" in head:
                first, head = head.split(b"\r\n\r\n", 1)
                fields = _fields(first)
            if fields is not None and b"\r\n\r\n" in head:
                first, data = head.split(b"\r\n\r\n", 1)
                http, sha, total, number = _fields(first), hashlib.sha1(), 0, 0
                left, held = int(fields["content-length"]) - len(first) - 4, b""
            elif end:
                raise ValueError("a record without its heads")
            else:
                continue
        held += data[:left]
        left -= len(data[:left])
        row = {"record_id": fields["warc-record-id"], "record_type": fields["warc-type"], "page_id": page_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri", ""), "refers_to": fields.get("warc-refers-to")}
        while len(held) >= size and (left or len(held) > size):
            now, held = held[:size], held[size:]
            sha.update(now)
            total += len(now)
            yield row | {"chunk_no": number, "last": False, "payload_bytes": total, "payload_sha1": sha.hexdigest(), "data": now}
            number += 1
        if end:
            sha.update(held)
            total += len(held)
            told = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
            n, found = int(http["content-length"]), sha.hexdigest()
            if left or row["record_type"] != REVISIT and (found != told or total != n):
                raise ValueError(f"the payload of {row['record_id']} is not what its heads say")
            whole = (n, told) if row["record_type"] == REVISIT else (total, found)
            yield row | {"chunk_no": number, "last": True, "payload_bytes": whole[0], "payload_sha1": whole[1], "data": held}
            head, fields, http = b"", None, None


def read_chunks(segments: DataFrame, data: bool = True, size: int = CHUNK) -> DataFrame:
    """The chunks of all records in the segments; payload_bytes and payload_sha1 are those of the payload up to here.

    A revisit is one row with the length and digest of the payload that it stands for. data: whether the bytes come too.
    """
    kind = CHUNKS if data else CHUNKS.removesuffix(", data binary")
    names = [x.split()[0] for x in kind.split(", ")]
    arrow = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    types = [arrow[x.split()[1]] for x in kind.split(", ")]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, types, strict=True)], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.to_pylist():
                fs, path = pyarrow.fs.FileSystem.from_uri(s["archive"])
                held, weight, ended = [], 0, 0
                with fs.open_input_file(path) as file:
                    for row in parsed(_inflated(file, s["start"], s["length"], size), size):
                        held.append(row)
                        weight += len(row["data"]) if data else 0
                        ended += row["last"]
                        if weight >= BATCH or len(held) >= 1024:
                            yield batch(held)
                            held, weight = [], 0
                if ended != s["records"]:
                    raise ValueError(f"{s['archive']} has {ended} records where {s['records']} were written")
                if held:
                    yield batch(held)

    return segments.repartition(max(1, segments.count())).mapInArrow(work, kind)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared one."""
    return f"{shared_root(spark)}/ledgerloom/{uuid.uuid4().hex}"


def index(chunks: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to (a page_id) of every record, from its last chunk."""
    refers = F.when(F.col("record_type") == REVISIT, F.split_part("refers_to", F.lit(":"), F.lit(3)).cast("long"))
    return chunks.filter("last").select("page_id", "payload_bytes", F.col("payload_sha1").alias("payload_digest"), "record_type", refers.alias("refers_to"))
