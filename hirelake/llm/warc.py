"""WARC archives: written and read with Spark's own file sources.

Written: each page is a record in a gzip member of its own.  Of pages with equal
payloads the one with the smallest id is a response, the others are revisits of it.
Records are joined to rows of many members, and the text sink writes these bytes as
they are; as it ends each row with a separator, that is the zero byte which ends the
row's last member anyway.  So any file system that Spark writes to will do.

Read: an archive is split into byte ranges like any text, with the gzip magic as the
line separator: a task scans its range for the magic, and owns what starts inside.
Three bytes of magic also turn up inside compressed data, so a candidate is a member
only if its headers, gzip's and WARC's, decode; a false one belongs to the member
before it.  If a range begins within a member that a false magic parted, the pieces on
both sides of the range's edge are returned as such and put together by file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import shared_folder, table

MAGIC = b"\x1f\x8b\x08"
#: Bytes of members that are joined to a row.
ROW_BYTES = 8 << 20
SALTS = 32
DATE = "2024-01-01T00:00:00Z"
_EMPTY_MEMBER = MAGIC + bytes(6) + b"\xff\x03\x00" + bytes(8)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url: str | None, payload: bytes, refers_to=None, date: str = DATE) -> bytes:
    """A gzip member with one record; a revisit where ``refers_to`` is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # A line break would end the header.
        head.append("WARC-Target-URI: " + re.sub("[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    return _member("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n")


def _rows(batches: Iterator[pa.RecordBatch]):
    """Rows of members; each lacks its last byte, a zero, which the sink puts back."""
    held, size = [], 0

    def row():
        data = b"".join(held if held[-1][-1] == 0 else [*held, _EMPTY_MEMBER])
        return pa.RecordBatch.from_arrays([pa.array([data[:-1]], pa.binary())], ["members"])

    for batch in batches:
        for start in range(0, batch.num_rows, 128):
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.slice(start, 128).columns), strict=True):
                held.append(record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers_to))
                size += len(held[-1])
                if size >= ROW_BYTES:
                    yield row()
                    held, size = [], 0
    if held:
        yield row()


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", salts: int = SALTS) -> None:
    """Write ``pages`` as WARC files in a new folder, any that Spark can write to.

    A null html is an empty payload.  Pages of equal payloads are found by digest; a
    payload that a third of the pages share is dealt over ``salts``.  Of rows that
    repeat the smallest id each is a response; rows without an id revisit one that has
    an id, and are responses where none has.  Extra columns are left out.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html")
    ).withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    first = (
        rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
        .select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    )
    marked = rows.withColumn("salt", F.pmod(F.hash("page_id"), F.lit(salts))).join(first, ["digest", "salt"], "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    members = marked.select("page_id", "url", "html", refers_to.alias("refers_to")).mapInArrow(_rows, "members binary")
    members.select(F.col("members").cast("string")).write.option("lineSep", "\0").option("compression", "none").text(folder)


def _page(urn: str | None) -> int | None:
    """The page id of a record that ``write_archives`` named."""
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m and -(1 << 63) <= int(m[1]) < 1 << 63 else None


def _agrees(given: str, payload: bytes) -> bool | None:
    """Whether a payload has the digest, in base32 or hex; None for algorithms not known here."""
    kind, _, value = given.partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in ("md5", "sha1", "sha256", "sha512"):
        return None
    own = hashlib.new(kind, payload)
    return value.lower() == own.hexdigest() or value.upper().rstrip("=") == base64.b32encode(own.digest()).decode().rstrip("=")


def parsed(data: bytes) -> dict:
    """A record's headers (names lower-case) and its block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    text = lambda name: v.encode("utf-8", "surrogateescape").decode("utf-8", "replace") if (v := fields.get(name)) is not None else None
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        raise ValueError(f"{text('warc-record-id')}: a record needs its type and length")
    size = int(fields["content-length"])
    if len(rest) < size:
        raise ValueError(f"{text('warc-record-id')}: the record is shorter than it says")
    kind, block, http = fields["warc-type"].lower(), rest[:size], b""
    payload = block
    if fields.get("content-type", "").lower().startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    given = text("warc-payload-digest")
    revisit = kind == "revisit"
    # What is transferred in pieces may have the digest of the whole that they make.
    if given and not revisit and not re.search(rb"(?im)^transfer-encoding:", http) and _agrees(given, payload) is False:
        raise ValueError(f"{text('warc-record-id')}: the payload doesn't have its digest")
    return {
        "page_id": _page(fields.get("warc-record-id")), "url": text("warc-target-uri"), "record_type": kind,
        "payload_bytes": (int(stated[1]) if stated else None) if revisit else len(payload),
        "payload_digest": given.removeprefix("sha1:") if given else None if revisit else payload_digest(payload),
        "refers_to": _page(fields.get("warc-refers-to")), "payload": None if revisit else payload,
        "record_id": text("warc-record-id"), "refers_to_id": text("warc-refers-to"),
    }


def _begins(piece: bytes) -> bool:
    """Whether a member with a WARC record begins here (or an empty member)."""
    d = zlib.decompressobj(31)
    try:
        start = d.decompress(piece[:4096], 64)
    except zlib.error:
        return False
    return start.startswith(b"WARC/") or (d.eof and not start)


def _whole(piece: bytes) -> bytes | None:
    """What a member holds, if it is complete."""
    d = zlib.decompressobj(31)
    try:
        data = d.decompress(piece)
    except zlib.error:
        return None
    return data if d.eof else None


_FIELDS = {
    "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(),
    "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(), "record_id": pa.string(),
    "refers_to_id": pa.string(),
}
_PIECES = {"file": pa.string(), "start": pa.int64(), "seq": pa.int64(), "piece": pa.binary()}


def _members(pieces: Iterator[bytes]) -> Iterator[tuple[str, bytes]]:
    """('data', a record) for whole members, and ('piece', bytes) for what is left over
    before the first member and of the last."""
    open_: bytes | None = None
    for piece in pieces:
        if open_ is None or _begins(piece):
            if open_:
                raise ValueError("a member ends before its time: the archive is damaged")
            if not _begins(piece):
                yield "piece", piece
                continue
            open_ = piece
        else:
            open_ += piece
        data = _whole(open_)
        if data is not None:
            if data:
                yield "data", data
            open_ = None
    if open_:
        yield "piece", open_


def _scan(batches: Iterator[pa.RecordBatch]):
    """Records of byte ranges; pieces of members that an edge parted have file and start."""
    schema = pa.schema([*_FIELDS.items(), *_PIECES.items()])
    none = dict.fromkeys(schema.names)

    def ranges():
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                yield from zip(*(c.to_pylist() for c in batch.slice(start, 64).columns), strict=True)

    def of_range(first, rows):
        """Rows of the range that ``first`` is in; then the next range's first row."""
        nonlocal ahead
        row = first
        while row is not None and row[:2] == first[:2]:
            # A file's first row is what comes before its first magic: nothing.
            if row[2]:
                yield MAGIC + row[2]
            row = next(rows, None)
        ahead = row

    rows = ranges()
    ahead = next(rows, None)
    out: list[dict] = []
    size = 0
    while ahead is not None:
        first = ahead
        for seq, (kind, data) in enumerate(_members(of_range(first, rows))):
            out.append(none | (parsed(data) if kind == "data" else {"file": first[0], "start": first[1], "seq": seq, "piece": data}))
            size += len(data)
            if size >= ROW_BYTES:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _together(pdf: pd.DataFrame) -> pd.DataFrame:
    """The members that range edges parted, of one file: a few pieces per range."""
    pieces = pdf.sort_values(["start", "seq"])["piece"]
    made = []
    for kind, data in _members(map(bytes, pieces)):
        if kind == "piece":
            raise ValueError("a member without its end: the archive is damaged")
        made.append(parsed(data))
    return pd.DataFrame(made, columns=list(_FIELDS)).astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})


_SCHEMA = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
    "payload binary, record_id string, refers_to_id string"
)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of WARC files, of one gzip member each, in a folder; written here or elsewhere.

    (page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload, record_id,
    refers_to_id); ids are given as they stand and, where ``write_archives`` made them, as page
    ids.  The payload is what follows the HTTP headers, or the whole block of records
    without such (warcinfo, metadata, DNS).  For a revisit, size and digest are those
    that it states of the payload it stands for, or null, and the payload itself is null.
    A digest that a record lacks is its payload's SHA-1; one that is given stays as it
    is, without a leading ``sha1:``.  A payload that doesn't have its digest (MD5 or SHA,
    base32 or hex; others, and those of chunked transfers, are not checked), or a record
    or member that is cut short, raises.  No files give no rows.

    Files are read in byte ranges, but those whose names end in ``.gz`` each by one task,
    as Spark splits no file of such a name; they are streamed all the same.
    """
    # This codec hands on bytes as they are, so that .gz files aren't inflated by their name;
    # the shaded Hadoop client that comes with Spark has its option under a name of its own.
    raw = (
        spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1"))
        .option("io.compression.codecs", "org.apache.hadoop.io.compress.PassthroughCodec")
        .option("io.compress.passthrough.extension", ".gz")
        .option("org.apache.hadoop.shaded.io.compress.passthrough.extension", ".gz").text(folder)
    )
    ranges = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    scanned = ranges.mapInArrow(_scan, f"{_SCHEMA}, file string, start long, seq long, piece binary")
    parted = scanned.where("piece is not null").select("file", "start", "seq", "piece").groupBy("file").applyInPandas(_together, _SCHEMA)
    return scanned.where("piece is null").select(*_FIELDS).unionByName(parted)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    from uuid import uuid4

    folder = f"{shared_folder(spark)}/warc-{uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
d AS (SELECT p.page_id, strlen(p.h) AS n, first, CAST(from_hex(sha1(p.h)) AS BIT) AS b FROM p JOIN g ON p.h = g.h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
         + 16 * get_bit(b, CAST(5 * i AS INT)) + 8 * get_bit(b, CAST(5 * i + 1 AS INT)) + 4 * get_bit(b, CAST(5 * i + 2 AS INT))
         + 2 * get_bit(b, CAST(5 * i + 3 AS INT)) + get_bit(b, CAST(5 * i + 4 AS INT)) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
