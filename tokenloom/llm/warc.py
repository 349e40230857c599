"""WARC archives as tables of chunks: large payloads are segments of a bounded size, with running digests."""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.joins import lookup
from tokenloom.session import materialize

CHUNK = 1 << 20
OUT_BYTES = 4 << 20
MAGIC = b"WARC/1.1"
CRLF = "\r\n"
# Records are told apart by the end of one and the first line of the next. No
# block holds this: chunks are cut inside every MAGIC that a payload holds.
BETWEEN = "\r\n\r\nWARC/1.1\r\n"
DATE = "2020-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"


def digest_of(sha1) -> str:
    return base64.b32encode(sha1.digest()).decode()


def cuts(payload: memoryview | bytes, size: int) -> Iterator[tuple[int, int]]:
    """Where chunks begin and end: every `size` bytes, and inside each MAGIC. An empty payload is one chunk."""
    whole, start, n = bytes(payload), 0, len(payload)
    at = whole.find(MAGIC)
    while True:
        end = min(start + size, n)
        if 0 <= at and at + 3 <= end:
            end = at + 3
            at = whole.find(MAGIC, end)
        yield start, end
        start = end
        if start >= n:
            return


def chunk_table(records: DataFrame, key: str, url: str, payload: str, chunk: int = CHUNK) -> DataFrame:
    """id, url, chunk_no, chunks, size, digest, running, data: the payload of each record, cut.

    `payload` is binary or text (as UTF-8); null is empty. `digest` and `size`
    are of the full payload, `running` is the digest of all up to and with this
    chunk. Chunks leave in batches of bounded size.
    """

    def run(batches):
        for batch in batches:
            ids, urls, payloads = batch.columns
            held, rows = 0, []
            for i in range(batch.num_rows):
                body = payloads[i].as_buffer() if payloads[i].is_valid else pa.py_buffer(b"")
                size = body.size
                whole = digest_of(hashlib.sha1(memoryview(body) if size else b""))
                places = list(cuts(body.to_pybytes() if size else b"", chunk))
                running = hashlib.sha1()
                for k, (start, end) in enumerate(places):
                    data = body.slice(start, end - start).to_pybytes() if size else b""
                    running.update(data)
                    rows.append((i, k, len(places), size, whole, digest_of(running), data))
                    held += end - start + 200
                    if held >= OUT_BYTES:
                        yield _chunk_batch(ids, urls, rows)
                        held, rows = 0, []
            if rows:
                yield _chunk_batch(ids, urls, rows)

    body = F.col(payload)
    if dict(records.dtypes)[payload] != "binary":
        body = F.encode(body.cast("string"), "UTF-8")
    rows = records.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, url string, chunk_no int, chunks int, size long, digest string, running string, data binary"
    return rows.mapInArrow(run, schema)


def _chunk_batch(ids: pa.Array, urls: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    at, no, count, size, digest, running, data = zip(*rows, strict=True)
    take = pa.array(at, pa.int64())
    columns = [ids.take(take), urls.take(take), pa.array(no, pa.int32()), pa.array(count, pa.int32()), pa.array(size, pa.int64())]
    columns += [pa.array(digest), pa.array(running), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["id", "url", "chunk_no", "chunks", "size", "digest", "running", "data"])


def with_roles(chunks: DataFrame, least: int = 0) -> DataFrame:
    """`chunks` with record_type and refers_to; of a revisit only the first chunk stays, without data.

    Among records with equal payloads of at least `least` bytes that with the
    smallest id is the response and the others revisit it; null ids come last.
    The table of first records has one row per payload and is broadcast if its
    measured size allows; beyond that a payload that very many records share is
    skewed on one side of the join only.
    """
    heads = chunks.filter("chunk_no = 0")
    firsts = heads.groupBy("digest", "size").agg(F.min("id").alias("first"))
    rows = lookup(chunks, materialize(firsts, "first_records"), ["digest", "size"], "inner")
    response = (F.col("size") < least) | F.col("id").eqNullSafe(F.col("first"))
    rows = rows.withColumn("record_type", F.when(response, "response").otherwise("revisit"))
    rows = rows.withColumn("refers_to", F.when(~response, F.col("first"))).drop("first")
    rows = rows.filter("record_type = 'response' or chunk_no = 0")
    return rows.withColumn("data", F.when(F.col("record_type") == "response", F.col("data")).otherwise(F.lit(b"")))


def _name(key: Column, chunk: Column) -> Column:
    return F.concat(F.lit("<urn:x-record:"), F.coalesce(F.url_encode(key.cast("string")), F.lit("")), F.lit(":"), chunk.cast("string"), F.lit(">"))


def record_texts(rows: DataFrame, date: str = DATE) -> DataFrame:
    """value: each chunk as one WARC record, without the line end that the writer adds."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))
    first, response = F.col("chunk_no") == 0, F.col("record_type") == "response"
    many = F.col("chunks") > 1
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.when(first & response, HTTP).otherwise("")
    kind = F.when(~first, "continuation").otherwise(F.col("record_type"))
    text = lambda c: F.col(c).cast("string")
    header = F.concat(
        F.lit(MAGIC.decode() + CRLF),
        line("WARC-Type", kind),
        line("WARC-Record-ID", _name(F.col("id"), F.col("chunk_no"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.when(first, uri)),
        line("Content-Type", F.when(first, F.lit("application/http; msgtype=response"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Refers-To", F.when(~response, _name(F.col("refers_to"), F.lit(0)))),
        line("WARC-Profile", F.when(~response, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("WARC-Segment-Number", F.when(many & response, (F.col("chunk_no") + 1).cast("string"))),
        line("WARC-Segment-Origin-ID", F.when(~first, _name(F.col("id"), F.lit(0)))),
        line("WARC-Segment-Total-Length", F.when(many & response & (F.col("chunk_no") == F.col("chunks") - 1), text("size"))),
        line("X-Record-Key", F.to_json(F.struct(F.col("id").cast("string").alias("id")))),
        line("X-Payload-Length", text("size")),
        line("X-Running-Digest", F.when(response, F.col("running"))),
        line("Content-Length", (F.length(F.encode(http, "UTF-8")) + F.length("data")).cast("string")),
        F.lit(CRLF),
    )
    whole = F.concat(F.encode(header, "UTF-8"), F.encode(http, "UTF-8"), F.col("data"), F.lit(CRLF.encode()))
    return rows.select(whole.cast("string").alias("value"))


def write_archives(chunks: DataFrame, path: str, least: int = 0, compression: str = "gzip") -> None:
    """Write chunks as WARC 1.1 files below `path`, through Spark's own writer, so to any file system."""
    rows = record_texts(with_roles(chunks, least))
    rows.write.text(path, compression=compression, lineSep=CRLF)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """key, chunk_no, segment, record_type, refers_to, size, digest, running, data: the records of archives written here."""

    def run(batches):
        for batch in batches:
            held, rows = 0, []
            for x in batch.column(0):
                row = _parse(x.as_py())
                if row is None:
                    continue
                rows.append(row)
                held += len(row["data"])
                if held >= OUT_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, PARSED)
                    held, rows = 0, []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, PARSED)

    lines = spark.read.text(path, lineSep=BETWEEN)
    schema = "key string, chunk_no int, total long, record_type string, refers_to string, size long, digest string, running string, data binary"
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, schema)


PARSED = pa.schema(
    [("key", pa.string()), ("chunk_no", pa.int32()), ("total", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.string())]
    + [("size", pa.int64()), ("digest", pa.string()), ("running", pa.string()), ("data", pa.binary())]
)


def _parse(record: bytes) -> dict | None:
    record = record.removeprefix(MAGIC + b"\r\n")
    head, _, block = record.partition(b"\r\n\r\n")
    names = dict(line.split(": ", 1) for line in head.decode().split(CRLF) if ": " in line)
    if "WARC-Type" not in names:
        return None
    block = block[: int(names["Content-Length"])]
    if names["WARC-Type"] == "response":
        block = block.partition(b"\r\n\r\n")[2]
    segment = int(names.get("WARC-Segment-Number", 1))
    refers = names.get("WARC-Refers-To")
    return {
        "key": json.loads(names["X-Record-Key"]).get("id"),
        "chunk_no": segment - 1,
        "total": int(names["X-Payload-Length"]),
        "record_type": "response" if names["WARC-Type"] == "continuation" else names["WARC-Type"],
        "refers_to": unquote_plus(refers.removeprefix("<urn:x-record:").rpartition(":")[0]) if refers else None,
        "size": len(block),
        "digest": names["WARC-Payload-Digest"].removeprefix("sha1:"),
        "running": names.get("X-Running-Digest"),
        "data": block,
    }


def verified(chunks: DataFrame) -> DataFrame:
    """key, payload_bytes, payload_digest, record_type, refers_to: each record, its payload read again.

    A payload in one chunk is digested where it is read. Only chunks of larger
    ones are moved: they come in order of (record, chunk) and go through one
    running digest, so no payload is whole in memory. A digest or length that
    does not fit the header raises.
    """

    def check(name: str, size: int, digest: str, row: dict) -> None:
        if size != row["total"] or digest != row["digest"]:
            raise ValueError(f"record {name}: {size} bytes with digest {digest}, not {row['total']} with {row['digest']}")

    def single(batches):
        for batch in batches:
            digests = [digest_of(hashlib.sha1(x.as_buffer())) for x in batch.column("data")]
            for row, d in zip(batch.drop_columns(["data"]).to_pylist(), digests, strict=True):
                if row["record_type"] == "response":
                    check(row["key"], row["size"], d, row)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("key", "total", "digest", "record_type", "refers_to")], names=NAMES)

    def joined(batches):
        now, held, copies, next_no, size, sha1, out = None, {}, 0, 0, 0, None, []

        def close() -> None:
            if copies:
                check(held["key"], size, digest_of(sha1), held)
                out.extend([held] * copies)

        for batch in batches:
            datas = batch.column("data")
            for i, row in enumerate(batch.drop_columns(["data"]).to_pylist()):
                name = (row["key"], row["digest"])
                if name != now:
                    close()
                    now, held, copies, next_no, size, sha1 = name, row, 0, 0, 0, hashlib.sha1()
                copies += row["chunk_no"] == 0  # a record may be there more than once
                if row["chunk_no"] == next_no:
                    sha1.update(datas[i].as_buffer())
                    size, next_no = size + row["size"], next_no + 1
        close()
        if out:
            columns = ("key", "total", "digest", "record_type", "refers_to")
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in zip(columns, TYPES, strict=True)], names=NAMES)

    schema = "key string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    whole = (F.col("record_type") == "revisit") | (F.col("size") == F.col("total"))
    one = chunks.filter(whole).mapInArrow(single, schema)
    cut = chunks.filter(~whole).repartition("key", "digest").sortWithinPartitions("key", "digest", "chunk_no")
    return one.union(cut.mapInArrow(joined, schema))


NAMES = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to"]
TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
