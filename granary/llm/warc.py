"""WARC: write page records, one gzip member each, and read them back in sequence.

Archives are built in memory-bounded chunks, each a complete ``.warc.gz`` file
of whole records, and kept as rows (archive, data) of a table in the shared
folder, so that neither side needs a local file.  ``export`` stores them as
files.  The reader inflates member by member and block by block, takes
``Content-Length`` bytes of each record, and checks the digests it has; a revisit
is held against the response that it refers to (:func:`verified`).

Defined results: a null html is an empty payload; pages with a null page_id are
written and read with a null page_id, and refer to the smallest id of their
payload like any other; of rows that share the smallest page_id of a payload,
all are responses; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import lean, scratch, written

#: Bytes of records after which an archive is closed.
ARCHIVE_BYTES = 4 << 20
#: Bytes inflated at a time.
BLOCK = 1 << 16
#: Payloads of fewer bytes are always stored whole.
LEAST_BYTES = 0
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
TYPE = ("Content-Type", "application/http; msgtype=response")
_PAGE = re.compile(r"<urn:page:(-?\d+)>")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(headers: list[tuple[str, str]], block: bytes, level: int = 3) -> bytes:
    """One record as one gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
    return gz.compress(head.encode()) + gz.compress(block) + gz.compress(b"\r\n\r\n") + gz.flush()


def _fields(kind: str, page_id: int | None, url: str | None, digest: bytes, n: int, block: bytes) -> list[tuple[str, str]]:
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    return [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest).decode()}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"), ("X-Payload-Bytes", str(n))]


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with the payload, or a revisit without it."""
    digest = hashlib.sha1(payload).digest()
    if refers_to is not None:
        return revisit(page_id, url, digest, len(payload), refers_to)
    block = HTTP + payload
    return member([*_fields("response", page_id, url, digest, len(payload), block), TYPE], block)


def revisit(page_id: int | None, url: str | None, digest: bytes, n: int, refers_to: int) -> bytes:
    """A record of a payload of ``n`` bytes that another record holds."""
    profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return member([*_fields("revisit", page_id, url, digest, n, HTTP), profile, ("WARC-Refers-To", f"<urn:page:{refers_to}>"), TYPE], HTTP)


#: Bytes of a record's headers at most.
HEADER_BYTES = 1 << 20
#: Digest algorithms that are checked, as the format names them.
_HASHES = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "sha512": hashlib.sha512, "md5": hashlib.md5}


class Headers(dict):
    """Named fields; a name's case does not matter."""

    def __getitem__(self, name: str) -> str:
        return super().__getitem__(name.lower())

    def __contains__(self, name: str) -> bool:
        return super().__contains__(name.lower())

    def get(self, name: str, default: str | None = None) -> str | None:
        return super().get(name.lower(), default)

    @classmethod
    def parsed(cls, raw: bytes) -> Headers:
        """Of a record's head: a version line, then fields, which may be folded."""
        lines = raw.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        out, last = cls(), None
        for line in lines[1:]:
            if line[:1] in (" ", "\t") and last is not None:
                out[last] = f"{out[last]} {line.strip()}"
                continue
            name, colon, value = line.partition(":")
            if not colon or not name.strip():
                raise ValueError(f"not a header field: {line[:80]!r}")
            last = name.strip().lower()
            out[last] = value.strip()
        return out


def digest_holds(said: str | None, data) -> bool:
    """Whether data has the labelled digest, in base 32 or hex.  One that is
    missing or of an unknown algorithm cannot be wrong."""
    label, _, value = (said or "").partition(":")
    if label.strip().lower() not in _HASHES:
        return True
    found = _HASHES[label.strip().lower()](data).digest()
    value = value.strip().rstrip("=")
    return value.upper() == base64.b32encode(found).decode().rstrip("=") or value.lower() == found.hex()


class Reader:
    """Records of a ``.warc.gz`` byte string or binary stream, in order, as
    (headers, payload); the payload of an HTTP message is its body.

    A member is inflated BLOCK bytes at a time: up to the end of the headers,
    then ``Content-Length`` bytes, then the record's end.  One record's block is
    held.  Digests are checked where the record has them.  Whatever is broken
    (framing, headers, compression, a truncated member, a digest) raises
    ValueError.
    """

    def __init__(self, source) -> None:
        self.read = source.read
        self.raw = b""

    def _member(self) -> Iterator[bytes]:
        """Inflated blocks of the next gzip member."""
        z = zlib.decompressobj(31)
        while not z.eof:
            feed = z.unconsumed_tail or self.raw or self.read(BLOCK)
            if not feed:
                raise ValueError("truncated gzip member")
            self.raw = b""
            try:
                out = z.decompress(feed, BLOCK)
            except zlib.error as e:
                raise ValueError(f"not a gzip member: {e}") from None
            if out:
                yield out
        self.raw = z.unused_data

    def __iter__(self) -> Iterator[tuple[Headers, bytes]]:
        while self.raw or (feed := self.read(BLOCK)):
            self.raw = self.raw or feed
            blocks = self._member()
            have, seen = bytearray(), 0
            while (cut := have.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
                seen = len(have)
                if seen > HEADER_BYTES or (more := next(blocks, None)) is None:
                    raise ValueError("no end of the record's headers")
                have += more
            headers = Headers.parsed(bytes(have[:cut]))
            del have[: cut + 4]
            said = headers.get("Content-Length") or ""
            if not (said.isascii() and said.isdigit()):
                raise ValueError("no Content-Length")
            length = int(said)
            while len(have) < length + 4 and (more := next(blocks, None)) is not None:
                have += more
            if have[length:] != b"\r\n\r\n" or next(blocks, None) is not None:
                raise ValueError("the block's length is not Content-Length")
            with memoryview(have) as view:
                block = view[:length]
                if not digest_holds(headers.get("WARC-Block-Digest"), block):
                    raise ValueError("wrong block digest")
                http = (headers.get("Content-Type") or "").lower().startswith("application/http")
                end = have.find(b"\r\n\r\n", 0, length) if http else -4
                payload = bytes(block[end + 4 :]) if end >= 0 or not http else b""
                block.release()
            # A revisit's digest is of the payload that it refers to.
            if headers.get("WARC-Type") != "revisit" and not digest_holds(headers.get("WARC-Payload-Digest"), payload):
                raise ValueError("wrong payload digest")
            yield headers, payload


ARCHIVES = "archive string, n_records long, data binary"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
MEMBERS = "page_id long, url string, digest binary, n long, member binary"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as response records, with what a revisit in their place would need."""
    for batch in batches:
        ids, urls, texts = (batch.column(i) for i in range(3))
        step = max(1, batch.num_rows * (1 << 20) // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):  # about a megabyte of pages at a time
            rows = []
            for i in range(at, min(at + step, batch.num_rows)):
                payload = texts[i].as_buffer().to_pybytes() if texts[i].is_valid else b""
                rows.append((hashlib.sha1(payload).digest(), len(payload), record(ids[i].as_py(), urls[i].as_py(), payload, None)))
            digest, n, member_ = zip(*rows)
            yield pa.RecordBatch.from_arrays([ids.slice(at, step), urls.slice(at, step), pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.array(member_, pa.binary())], ["page_id", "url", "digest", "n", "member"])


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records to archives; those that refer to another page as revisits."""
    from pyspark import TaskContext

    part, chunk, size, made = TaskContext.get().partitionId(), [], 0, 0

    def close() -> pa.RecordBatch:
        name = f"part-{part:05d}-{made:05d}.warc.gz"
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(chunk)], pa.int64()), pa.array([b"".join(chunk)], pa.binary())], ["archive", "n_records", "data"])

    for batch in batches:
        ids, urls, digests, sizes, members, refs = (batch.column(i) for i in range(6))
        for i in range(batch.num_rows):
            first = refs[i].as_py()
            chunk.append(members[i].as_py() if first is None else revisit(ids[i].as_py(), urls[i].as_py(), digests[i].as_py(), sizes[i].as_py(), first))
            size += len(chunk[-1])
            if size >= ARCHIVE_BYTES:
                yield close()
                chunk, size, made = [], 0, made + 1
    if chunk:
        yield close()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import io

    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string()}

    def number(urn: str | None) -> int | None:
        found = _PAGE.fullmatch(urn or "")
        return int(found[1]) if found else None

    def row(h: Headers, payload: bytes) -> tuple:
        said = (h.get("WARC-Payload-Digest") or "").partition(":")[2] or None
        if h.get("WARC-Type") == "revisit":
            n = int(h["X-Payload-Bytes"]) if (h.get("X-Payload-Bytes") or "").isdigit() else None
        else:
            n, said = len(payload), said or sha1_base32(payload)
        return number(h.get("WARC-Record-ID")), n, said, h.get("WARC-Type"), number(h.get("WARC-Refers-To")), h.get("WARC-Target-URI")

    for batch in batches:
        for data in batch.column(0):
            rows = [row(h, payload) for h, payload in Reader(io.BytesIO(memoryview(data.as_buffer())))]
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], list(types))


def write_archives(pages: DataFrame) -> DataFrame:
    """Archive rows for (page_id, url, html); equal payloads are stored once.

    Payloads are compressed where they are read, and move once, as records.
    A payload that a third of all pages share is summed before its digest moves,
    and its revisits spread over the page ids."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode("html", "UTF-8").alias("html"))
    payload = F.coalesce("html", F.lit(b""))
    d = p.select("page_id", F.unhex(F.sha1(payload)).alias("digest"), F.length(payload).alias("n")).where(F.col("n") >= LEAST_BYTES)
    first = d.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1 and first is not null")
    # A repeated page_id may carry several payloads: refer by id and payload.
    of = d.join(first, "digest").where("page_id is null or page_id > first").select(F.col("page_id").alias("copy_id"), F.col("digest").alias("copy_digest"), F.col("first").alias("refers_to")).distinct()
    records = p.mapInArrow(lean(_members), MEMBERS)
    hit = records["page_id"].eqNullSafe(of["copy_id"]) & (records["digest"] == of["copy_digest"])
    return records.join(of, hit, "left").select("page_id", "url", "digest", "n", "member", "refers_to").mapInArrow(lean(_write), ARCHIVES)


def read_archives(archives: DataFrame) -> DataFrame:
    """RECORDS of archive rows, whoever wrote them: page ids are null for records
    that are no ``<urn:page:N>``, a missing payload digest is computed."""
    return archives.select("data").mapInArrow(lean(_read), RECORDS)


def verified(records: DataFrame) -> DataFrame:
    """A written table of the records, whose revisits all refer to a response
    with the digest and the length that they state; ValueError otherwise."""
    records = written(records, "records")
    said = records.where("record_type = 'revisit'").select(F.col("refers_to").alias("page_id"), "payload_digest", "payload_bytes").distinct()
    kept = records.where("record_type = 'response'").select("page_id", "payload_digest", "payload_bytes")
    lost = said.join(kept, ["page_id", "payload_digest", "payload_bytes"], "left_anti").head()
    if lost is not None:
        raise ValueError(f"a revisit refers to page {lost.page_id}, which has no such payload")
    return records


def export(archives: DataFrame, folder: str) -> list[str]:
    """Store archives as files in a local folder, one at a time."""
    from pathlib import Path

    names = []
    for row in archives.toLocalIterator():
        (Path(folder) / row.archive).write_bytes(row.data)
        names.append(row.archive)
    return names


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    # gzip members do not shrink further; the table is stored as it is.
    with scratch() as keep:
        records = keep(verified(read_archives(written(write_archives(pages), "warc", "uncompressed"))))
    return records.drop("url")


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, unhex(h)::BIT::VARCHAR AS bits, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM b
"""
