"""WARC archives: writer and sequential reader.

An archive is a sequence of gzip members, one for each record. Archives travel as rows
(archive, bytes): the writer packs a task's records into archives of bounded size, and
`read_files` takes existing .warc or .warc.gz files with Spark's binaryFile source. The
reader walks an archive front to back: it inflates one member at a time in small steps,
frames the record by its Content-Length and checks both digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import stash, table

ARCHIVE_BYTES = 8 << 20
STEP = 64 << 10
DEDUP_FROM = 1000
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, name: str, uri: str | None, payload: bytes, length: int, sha1: str, refers: str | None) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header alone as its block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:x-page:{name}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {' '.join(uri.split())}"] if uri else []),
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
        f"WARC-Block-Digest: {digest(block)}",
        *([f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:x-page:{refers}>"] if kind == "revisit" else []),
        f"Content-Length: {len(block)}",
    ]
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + gz.flush()


class Source:
    """Bytes of an archive, inflated in steps; one gzip member after the other."""

    def __init__(self, data: bytes):
        self.data, self.at, self.out = data, 0, b""
        self.zipped = data[:2] == b"\x1f\x8b"
        self.gz = None

    def _more(self) -> bool:
        """Adds to `out`; False at the end of the member (or of an archive that isn't compressed)."""
        if not self.zipped:
            self.out += self.data[self.at : self.at + STEP]
            self.at, more = min(self.at + STEP, len(self.data)), self.at < len(self.data)
            return more
        if self.gz is None or self.gz.eof:
            return False
        piece = self.gz.unconsumed_tail
        if not piece:
            piece = self.data[self.at : self.at + STEP]
            self.at += len(piece)
        # Without input left, the decompressor may still hold output back.
        got = self.gz.decompress(piece, STEP)
        if not piece and not got and not self.gz.eof:
            raise ValueError("archive ends within a member")
        self.out += got
        if self.gz.eof:
            self.at -= len(self.gz.unused_data)
        return True

    def next_record(self) -> bool:
        """Whether a record follows, in this member or the next; False at the end of the archive.

        A member is read to its end first, so that zlib has checked its trailer.
        """
        while not self.out:
            if self._more():
                continue
            if self.at >= len(self.data):
                return False
            self.gz = zlib.decompressobj(31)
        return True

    def line(self) -> bytes:
        while (end := self.out.find(b"\r\n")) < 0:
            if not self._more():
                raise ValueError("record ends within its header")
        line, self.out = self.out[:end], self.out[end + 2 :]
        return line

    def take(self, n: int) -> bytes:
        parts, have = [self.out], len(self.out)
        while have < n:
            self.out = b""
            if not self._more():
                raise ValueError("record is shorter than its Content-Length")
            parts.append(self.out)
            have += len(self.out)
        whole = b"".join(parts)
        self.out = whole[n:]
        return whole[:n]


def text(line: bytes) -> str:
    """A header line, in UTF-8 or else in Latin-1, which older archives have."""
    try:
        return line.decode()
    except UnicodeDecodeError:
        return line.decode("latin-1")


def stated(value: str | None) -> tuple[str, bytes] | None:
    """The algorithm and the bytes of a labelled digest in hex or base32, of either case; None if it can't be told."""
    label, _, body = (value or "").strip().partition(":")
    name, body = label.strip().lower().replace("-", ""), body.strip()
    size = _SIZES.get(name)
    if size is None:
        return None
    try:
        if len(body) == 2 * size:
            return name, bytes.fromhex(body)
        plain = body.upper().rstrip("=")
        got = base64.b32decode(plain + "=" * (-len(plain) % 8))
    except ValueError:
        return None
    return (name, got) if len(got) == size else None


# The digests that archives label, and their bytes.
_SIZES = {"md5": 16, "sha1": 20, "sha256": 32, "sha512": 64}


def agrees(value: str | None, data: bytes) -> bool:
    """Whether a digest is that of the data. One that can't be told is left unverified."""
    known = stated(value)
    return known is None or hashlib.new(known[0], data).digest() == known[1]


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header (names in lower case) and block of each record of an archive.

    Usually a member holds one record; further ones in it are read too.
    """
    src = Source(data)
    while src.next_record():
        version = src.line()
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:20]!r}")
        head: dict[str, str] = {}
        while line := src.line():
            name, _, value = text(line).partition(":")
            head[name.strip().lower()] = value.strip()
        block = src.take(int(head["content-length"]))
        if src.take(4) != b"\r\n\r\n":
            raise ValueError("record isn't followed by two line ends")
        if not agrees(head.get("warc-block-digest"), block):
            raise ValueError(f"block digest differs: {head.get('warc-record-id')}")
        yield head, block


def plan_records(pages: DataFrame, least: int = DEDUP_FROM) -> DataFrame:
    """page_id, url, payload, payload_bytes, sha1, record_type and refers_to of each page.

    Of pages with equal payloads of at least `least` bytes, that with the largest page_id
    (null is below all) is the response and the others revisit it. Rows repeated with that
    same page_id are responses too, since they can't refer to themselves. A null html is
    an empty payload. No pages give no rows; other columns of pages, whatever their names,
    are neither read nor returned.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("sha1")
    )
    copies = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy("sha1", "payload_bytes")
        .agg(F.max("page_id").alias("__first"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .drop("__n")
    )
    copies = stash(copies, "warc-copies")  # so that the join deals it anew and Spark can split a hot payload's pages
    revisit = F.col("__first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__first"))
    return rows.join(copies, ["sha1", "payload_bytes"], "left").select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "sha1",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("__first")).alias("refers_to"),
    )


def write_archives(plan: DataFrame, most: int = ARCHIVE_BYTES) -> DataFrame:
    """Rows (archive, bytes): each task packs its records into archives of about `most` bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[bytes] = []
        held = 0

        def out() -> pa.RecordBatch:
            return pa.record_batch({"archive": pa.array([uuid.uuid4().hex]), "bytes": pa.array([b"".join(members)], pa.binary())})

        for batch in batches:
            for x in batch.to_pylist():
                name = "null" if x["page_id"] is None else str(x["page_id"])
                refers = None if x["refers_to"] is None else str(x["refers_to"])
                member = record(x["record_type"], name, x["url"], x["payload"], x["payload_bytes"], x["sha1"], refers)
                if members and held + len(member) > most:
                    yield out()
                    members, held = [], 0
                members.append(member)
                held += len(member)
        if members:
            yield out()

    return plan.mapInArrow(pack, "archive string, bytes binary")


READ = "record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row for each record of the archives in column `bytes`.

    `payload_bytes` and `payload_digest` (hex SHA-1) describe the full payload; a revisit
    takes them from its header, and has nulls where that lacks them or has another digest. Digests in
    hex or base32 of the usual kinds are verified, others are not. Records other than HTTP ones
    are payload as a whole. A damaged archive raises. Without `payloads` the column
    payload is null.
    """

    def rows(data: bytes) -> Iterator[dict]:
        for head, block in records(data):
            kind = head.get("warc-type", "").lower()
            http, payload = b"", block
            if kind == "revisit" or head.get("content-type", "").replace(" ", "").startswith("application/http"):
                http, _, payload = block.partition(b"\r\n\r\n")
            fields = dict((n.strip().lower(), v.strip()) for n, _, v in (text(x).partition(":") for x in http.split(b"\r\n")[1:]))
            known, length = stated(head.get("warc-payload-digest")), len(payload)
            if kind == "revisit":
                # Its header is that of the full payload; without one, nothing tells the length.
                length = int(fields["content-length"]) if fields.get("content-length", "").isdigit() else None
                sha1 = known[1].hex() if known and known[0] == "sha1" else None
            else:
                # What a transfer encoding wraps has a digest of its own, which the stored bytes don't have.
                if "transfer-encoding" not in fields and not agrees(head.get("warc-payload-digest"), payload):
                    raise ValueError(f"payload digest differs: {head.get('warc-record-id')}")
                sha1 = hashlib.sha1(payload).hexdigest()
            yield {
                "record_id": head.get("warc-record-id"),
                "record_type": kind,
                "target_uri": head.get("warc-target-uri"),
                "refers_to": head.get("warc-refers-to"),
                "payload_bytes": length,
                "payload_digest": sha1,
                "payload": payload if payloads else None,
            }

    schema = pa.schema(
        [(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in READ.split(", "))]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("bytes"):
                held: list[dict] = []
                size = 0
                for row in rows(data.as_py() or b""):
                    held.append(row)
                    size += 200 + len(row["payload"] or b"")
                    if size > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return archives.select("bytes").mapInArrow(read, READ)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Records of .warc and .warc.gz files below a path.

    Spark holds a file as one value, hence files of 2 GB and more raise; archives are commonly
    cut at 1 GB.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").option("recursiveFileLookup", "true").load(path)
    return read_archives(files.select(F.col("content").alias("bytes")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives of all pages, reads them back and reports each record."""
    archives = stash(write_archives(plan_records(table(spark, sf_dir, "pages"))), "warc")
    page = lambda c: F.regexp_extract(c, r"<urn:x-page:(-?\d+)>", 1).try_cast("long")
    return read_archives(archives, payloads=False).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(strlen(html), 0)::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN top IS NULL OR top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND p.payload_bytes >= 1000
"""
