"""WARC archives through a chunked record table.

A payload becomes rows (record, chunk number, chunk), each at most ``chunk_bytes``
long and with the running SHA-1 of the payload so far; a row is one WARC 1.1 record,
chunks after the first being ``continuation`` records.  Neither writer nor reader
copies a payload whole, and Spark's text source writes and splits the archives,
so they can be in any store that Spark reaches.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
RECORDS_PER_FILE = 100_000
SALTS = 8
# Fixed values of the format.
VERSION = "WARC/1.1\r\n"
#: What begins a record, and where the reader splits: no chunk may hold it.  Unlike the blank line before it,
#: it does not overlap itself, so that a split is found wherever Spark's read buffers end.
BOUNDARY = VERSION


_CHUNKS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "record_id string, chunk_no int, is_last boolean, running_digest string, chunk string")
_FLUSH = 4 << 20


def _b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_ends(data: memoryview, size: int) -> Iterator[int]:
    """Where the chunks of a payload end: within a character nowhere, and after the second letter
    wherever the payload has the version line that begins a record."""
    n, at, mark = len(data), 0, BOUNDARY.encode()
    while at < n:
        stop = min(n, at + size)
        i = bytes(data[at:stop + len(mark)]).find(mark)
        if 0 <= i <= stop - at - 2:
            stop = at + i + 2
        else:
            while stop < n and data[stop] & 0xC0 == 0x80:
                stop -= 1
        yield stop
        at = stop


def chunk_table(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, min_revisit_bytes: int = 0,
                id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """The chunk rows of every page.

    Of pages with equal payloads of at least ``min_revisit_bytes`` bytes, that with the largest id
    is a response and carries the payload, the others are revisits that refer to it and have
    one empty chunk.  NULL payloads are empty; an empty payload has one empty chunk.  A page without an
    id refers like others but is referred to by none.  Repeated rows of the largest id are all
    responses.  Other columns are ignored."""
    if chunk_bytes < 16:
        raise ValueError("chunk_bytes must be 16 or more")
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1(F.col("payload").cast("binary")), "n": F.octet_length("payload").cast("long")})
    # Only digests that occur twice are joined against; a digest of very many pages is spread over salts.
    twice = (rows.where(F.col("n") >= min_revisit_bytes).groupBy("sha1").agg(F.count("*").alias("c"), F.max("page_id").alias("keeper"))
             .where("c > 1 and keeper is not null")
             .select(F.col("sha1").alias("k"), "keeper", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("t")))
    joined = (rows.withColumn("s", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
              .join(twice, (F.col("sha1") == F.col("k")) & (F.col("s") == F.col("t")), "left"))
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    typed = joined.select("page_id", "url", "sha1", "n", F.when(revisit, F.col("keeper")).alias("refers_to"),
                          F.when(~revisit, F.col("payload")).cast("binary").alias("payload"))
    fields = [(f.split(" ")[0], {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}.get(f.split(" ")[1], pa.string()))
              for f in _CHUNKS.split(", ")]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*found))
        chunks = pa.array([bytes(c) for c in cols[-1]], pa.binary()).view(pa.string())
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, (_, t) in zip(cols[:-1], fields)), chunks],
                                          names=[name for name, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for b in batches:
            ids, urls, shas, ns, refers = (b.column(i).to_pylist() for i in range(5))
            for i, value in enumerate(b.column(5)):
                digest, record = _b32(bytes.fromhex(shas[i])), str(uuid.uuid4())
                head = (ids[i], urls[i], "revisit" if refers[i] is not None else "response", refers[i], ns[i], digest, record)
                if not value.is_valid or ns[i] == 0:
                    found.append((*head, 1, True, None, b""))
                    continue
                data, running, at = memoryview(value.as_buffer()), hashlib.sha1(), 0
                for no, end in enumerate(chunk_ends(data, chunk_bytes), 1):
                    running.update(data[at:end])
                    found.append((*head, no, end == len(data), _b32(running.digest()), data[at:end]))
                    size += end - at
                    at = end
                    if size >= _FLUSH:
                        yield batch(found)
                        found, size = [], 0
            if found:
                yield batch(found)
                found, size = [], 0

    return typed.mapInArrow(run, _CHUNKS)


def _record_text(chunks: DataFrame) -> DataFrame:
    """One column ``value``: a record without the final line end, which the text writer adds."""
    first = F.col("chunk_no") == 1
    def field(name: str, value, when=None):
        line = F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n"))
        return F.coalesce(F.when(when, line) if when is not None else line, F.lit(""))
    # Control characters cannot stand in a field; an escaped full stop is the same URL, and no version line.
    safe_url = F.regexp_replace(F.regexp_replace(F.col("url"), r"[\x00-\x1F]", "_"), r"WARC/1\.1$", "WARC/1%2E1")
    whole = first & F.col("is_last")
    kind = F.when(first, F.col("record_type")).otherwise("continuation")
    http = F.when(first & (F.col("record_type") == "response"), F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))).otherwise("")
    body = F.concat(http, "chunk")
    own = F.when(first, F.col("record_id")).otherwise(F.concat("record_id", F.lit("-"), F.col("chunk_no").cast("string")))
    return chunks.select(F.concat(
        F.lit(VERSION), field("WARC-Type", kind),
        field("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), own, F.lit(">"))),
        field("WARC-Segment-Origin-ID", F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">")), ~first),
        field("WARC-Segment-Number", F.col("chunk_no"), ~whole),
        field("WARC-Segment-Total-Length", F.col("payload_bytes"), ~first & F.col("is_last")),
        field("WARC-Target-URI", safe_url, first),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest")), first),
        field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
              first & (F.col("record_type") == "revisit")),
        field("Page-ID", F.col("page_id"), first), field("Refers-To-Page-ID", F.col("refers_to"), first),
        field("Payload-Length", F.col("payload_bytes"), first), field("Running-Digest", F.col("running_digest")),
        field("Content-Type", F.lit("application/http;msgtype=response"), first & (F.col("record_type") == "response")),
        field("Content-Length", F.octet_length(body)), F.lit("\r\n"), body, F.lit("\r\n")).alias("value"))


def write_archives(chunks: DataFrame, path: str) -> None:
    """Write chunk rows as gzipped WARC files; the chunks of a record follow each other."""
    (_record_text(chunks).write.option("lineSep", "\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of one record as the reader splits them; raises on a truncated block."""
    head, _, rest = raw.removeprefix(VERSION.encode()).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
    n = int(fields["Content-Length"])
    if len(rest) < n or rest[n:].strip(b"\r\n"):
        raise ValueError(f"record {fields.get('WARC-Record-ID')} has {len(rest)} bytes, not {n}")
    return fields, rest[:n]


def _verify(record: str, n: int, sha, size: int, digest: str) -> None:
    if (n, _b32(sha.digest())) != (size, digest):
        raise ValueError(f"record {record}: payload does not have its length and digest")


_PARTS = ("record_id string, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, "
          "chunk_no int, is_last boolean, running_digest string, chunk binary")


def read_chunks(spark: SparkSession, path: str, digest_whole: bool = False) -> DataFrame:
    """Chunk rows of the archives' records, in no order; ``chunk`` is binary.

    With ``digest_whole``, a payload of one chunk is held against its length and digest
    right here, and its chunk is NULL in the result."""
    text = (spark.read.schema("value string").option("lineSep", BOUNDARY).text(path)
            .where("octet_length(value) > 0").select(F.col("value").cast("binary").alias("value")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for raw in b.column(0):
                f, block = parse_record(raw.as_py())
                kind = f["WARC-Type"]
                number = lambda k: int(f[k]) if k in f else None
                if kind == "response":
                    block = block.partition(b"\r\n\r\n")[2]
                no = int(f.get("WARC-Segment-Number", 1))
                if digest_whole and "WARC-Segment-Number" not in f:
                    if kind == "response":
                        _verify(f["WARC-Record-ID"], len(block), hashlib.sha1(block), number("Payload-Length"), f["WARC-Payload-Digest"][5:])
                    block = None
                rows.append((f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"])[10:-1], number("Page-ID"), kind,
                             number("Refers-To-Page-ID"), number("Payload-Length"),
                             f["WARC-Payload-Digest"].removeprefix("sha1:") if no == 1 else None, no,
                             "WARC-Segment-Number" not in f or "WARC-Segment-Total-Length" in f,
                             f.get("Running-Digest"), block))
            types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(),
                     pa.string(), pa.binary()]
            names = [x.split(" ")[0] for x in _PARTS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=names)

    return text.mapInArrow(run, _PARTS)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record.

    The chunks of a record are sorted by number and digested as they stream by; every running
    digest and the payload's digest must agree with the archive, or the job fails.  A
    revisit's length and digest are those its header states.  An archive without records
    gives an empty result."""
    chunks = read_chunks(spark, path, digest_whole=True)      # only payloads of several chunks are shuffled
    ordered = chunks.repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    out = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha, n, expect = None, None, 0, 1
        for b in batches:
            rows = []
            cols = [b.column(i).to_pylist() for i in range(9)]
            for row, chunk in zip(zip(*cols), b.column(9)):
                record, no, last, running = row[0], row[6], row[7], row[8]
                if no == 1:
                    if head is not None:
                        raise ValueError(f"record {head[0]} has no last chunk")
                    head, sha, n, expect = row, hashlib.sha1(), 0, 1
                if head is None or record != head[0] or no != expect:
                    raise ValueError(f"record {record}: chunk {no} is out of order")
                expect += 1
                if chunk.is_valid:
                    data = chunk.as_buffer()
                    sha.update(data)
                    n += data.size
                if chunk.is_valid and running is not None and running != _b32(sha.digest()):
                    raise ValueError(f"record {record}: chunk {no} does not have its digest")
                if last:
                    _, page, kind, refers, size, digest = head[:6]
                    if chunk.is_valid and kind == "response":
                        _verify(record, n, sha, size, digest)
                    rows.append((page, size, digest, kind, refers))
                    head = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if head is not None:
            raise ValueError(f"record {head[0]} has no last chunk")

    return ordered.mapInArrow(run, out)
