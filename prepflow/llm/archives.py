"""Web archives packed in ZIP files: written from a table of pages, read record by record through byte ranges.

An archive holds two stored (uncompressed) members: ``archive/data.warc.gz``, where each
record is a gzip member of its own, and ``indexes/index.cdx`` with the key, offset and
length of each record. The reader finds the directory at the end of the file, follows
ZIP64 records where sizes or offsets need them, and reads only the ranges it wants.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import struct
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


# ---- one archive -------------------------------------------------------------------


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one uncompressed record; ``payload`` is None for revisits."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    number = lambda x: int(x[10:-1]) if x and x[10:-1] else None  # noqa: E731  <urn:page:N>
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": url and url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%"),
        "record_type": fields["WARC-Type"],
        "payload_bytes": length,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": number(fields.get("WARC-Refers-To")),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def pack(records: list[tuple[str, bytes]]) -> bytes:
    """A ZIP archive of (key, gzip member) records."""
    lines, at, out = [], 0, io.BytesIO()
    for key, data in records:
        lines.append(f"{key} {at} {len(data)}\n")
        at += len(data)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr(INDEX, "".join(lines))
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=at > zipfile.ZIP64_LIMIT) as f:
            for _, data in records:
                f.write(data)
    return out.getvalue()


def members(read: Callable[[int, int], bytes], size: int) -> dict[str, tuple[int, int]]:
    """Name to (offset of the data, length) for each stored member. ``read(offset, length)`` gives a byte range.

    A ValueError is raised for what isn't a ZIP file and for compressed members.
    """
    tail_at = max(0, size - 65_557)  # the longest comment
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, at = struct.unpack("<HII", tail[end + 10 : end + 20])
    if count == 0xFFFF or length == 0xFFFFFFFF or at == 0xFFFFFFFF:
        locator = read(tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        (far,) = struct.unpack("<Q", locator[8:16])
        count, length, at = struct.unpack("<QQQ", read(far, 56)[32:56])
    directory, found, i = read(at, length), {}, 0
    for _ in range(count):
        if directory[i : i + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, plain, n_name, n_extra, n_note, offset = struct.unpack("<10xH8xIIHHH8xI", directory[i : i + 46])
        name = directory[i + 46 : i + 46 + n_name].decode()
        extra = directory[i + 46 + n_name : i + 46 + n_name + n_extra]
        if 0xFFFFFFFF in (packed, plain, offset):
            packed, plain, offset = wide_fields(extra, packed, plain, offset)
        if method != 0:
            raise ValueError(f"{name} is compressed")
        local = read(offset, 30)
        found[name] = (offset + 30 + sum(struct.unpack("<HH", local[26:30])), packed)
        i += 46 + n_name + n_extra + n_note
    return found


def wide_fields(extra: bytes, packed: int, plain: int, offset: int) -> tuple[int, int, int]:
    """The 64-bit values of the ZIP64 extra field, in its order: plain size, packed size, offset; only those that need it."""
    i = 0
    while i + 4 <= len(extra):
        kind, n = struct.unpack("<HH", extra[i : i + 4])
        if kind == 1:
            values = iter(struct.unpack(f"<{n // 8}Q", extra[i + 4 : i + 4 + n // 8 * 8]))
            plain = next(values) if plain == 0xFFFFFFFF else plain
            packed = next(values) if packed == 0xFFFFFFFF else packed
            offset = next(values) if offset == 0xFFFFFFFF else offset
            break
        i += 4 + n
    return packed, plain, offset


def records(read: Callable[[int, int], bytes], size: int, wanted=None) -> Iterator[dict]:
    """The archive's records, each by one range read; ``wanted(key)`` chooses by the index."""
    found = members(read, size)
    index_at, index_length = found[INDEX]
    data_at, _ = found[DATA]
    for line in read(index_at, index_length).decode().splitlines():
        key, at, length = line.split(" ")
        if wanted is None or wanted(key):
            yield parse_record(gzip.decompress(read(data_at + int(at), int(length))))


# ---- tables ------------------------------------------------------------------------


def mark_revisits(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, html (null becomes empty) and refers_to: the largest page_id with the same payload, null for that page itself.

    Payloads under ``min_bytes`` are never revisits. The join goes by page and digest, so
    a payload that most pages share makes no hot key for the page texts.
    """
    p = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"),
    )
    keys = p.select("page_id", F.sha1("html").alias("sha"), F.octet_length("html").alias("n"))
    shared = keys.where(F.col("n") >= min_bytes).groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
    shared = shared.where("copies > 1 AND refers_to IS NOT NULL").select("sha", "refers_to")
    again = keys.join(shared, "sha").where("NOT page_id <=> refers_to").select("page_id", "sha", "refers_to").distinct()
    again = settle(again, "revisits")
    p = p.withColumn("sha", F.sha1("html")).alias("a")
    both = p.join(again.alias("b"), F.expr("a.page_id <=> b.page_id AND a.sha = b.sha"), "left")
    return both.select("a.page_id", "url", "html", "refers_to")


def write_archives(marked: DataFrame, target_bytes: int = 8 << 20) -> DataFrame:
    """Archives of about ``target_bytes`` as a stored table (archive_id, n_records, content): one row is one ZIP file."""

    def write(batches):
        held, size, made = [], 0, 0
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def close():
            content = pack(held)
            return pa.RecordBatch.from_pydict(
                {"archive_id": [f"{part:08d}-{made:08d}"], "n_records": [len(held)], "content": pa.array([content], pa.binary())}
            )

        for batch in batches:
            rows = zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to")), strict=True)
            for page_id, url, html, refers_to in rows:
                page = page_id.as_py()
                raw = record(page, url.as_py(), html.as_py().encode(), refers_to.as_py())
                held.append((str(page), gzip.compress(raw, 1, mtime=0)))
                size += len(held[-1][1])
                if size >= target_bytes:
                    yield close()
                    held, size, made = [], 0, made + 1
        if held:
            yield close()

    return settle(marked.mapInArrow(write, "archive_id string, n_records long, content binary"), "archives")


def read_archives(archives: DataFrame, content_col: str = "content") -> DataFrame:
    """Records of a table with one ZIP archive in each row, such as ``spark.read.format("binaryFile")`` gives."""

    def read(batches):
        for batch in batches:
            for cell in batch.column(0):
                view = memoryview(cell.as_buffer())
                held, size = [], 0
                for x in records(lambda at, n, v=view: bytes(v[at : at + n]), len(view)):
                    held.append(x)
                    size += len(x["payload"] or b"")
                    if size > 4 << 20:
                        yield rows(held)
                        held, size = [], 0
                yield rows(held)

    def rows(held):
        types = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in held], t) for k, t in types.items()], names=list(types))

    return archives.select(F.col(f"`{content_col}`").alias("content")).mapInArrow(read, RECORD_SCHEMA)


_B32 = " || ".join(
    f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || sha[{5 * g + 1}:{5 * g + 5}])::BIGINT >> {s}) & 31) + 1]" for g in range(8) for s in (15, 10, 5, 0)
)
ARCHIVE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
m AS (SELECT sha, max(page_id) AS last FROM p GROUP BY 1)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_B32} AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM p JOIN m USING (sha)
"""
