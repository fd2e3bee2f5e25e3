"""WARC archives that others wrote."""

import base64
import gzip
import hashlib
import os
import random
import uuid

import pytest

from hirelake.llm import warc
from hirelake.llm.common import shared_folder


def member(kind, block, **fields):
    head = [f"WARC-Type: {kind}", f"Content-Length: {len(block)}", *(f"{k.replace('_', '-')}: {v}" for k, v in fields.items())]
    return gzip.compress(("WARC/1.0\r\n" + "\r\n".join(head)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def archive(rng):
    noise = rng.randbytes(30_000)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n0\r\n\r\n"
    sha = base64.b32encode(hashlib.sha1(noise).digest()).decode()
    response = {"Content_Type": "application/http; msgtype=response"}
    return noise, [
        member("warcinfo", b"software: x\r\n", WARC_Record_ID="<urn:uuid:1>", Content_Type="application/warc-fields"),
        member("request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", WARC_Record_ID="<urn:uuid:2>", Content_Type="application/http; msgtype=request"),
        member("response", http + noise, WARC_Record_ID="<urn:uuid:3>", WARC_Target_URI="http://h/é", **response),
        member("response", http + noise, WARC_Record_ID="<urn:uuid:4>", WARC_Payload_Digest=f"sha1:{sha}", **response),
        member("response", http + noise, WARC_Record_ID="<urn:uuid:5>", WARC_Payload_Digest=f"sha256:{hashlib.sha256(noise).hexdigest()}", **response),
        member("response", http + b"x", WARC_Record_ID="<urn:uuid:6>", WARC_Payload_Digest="blake3:00", **response),
        member("response", chunked, WARC_Record_ID="<urn:uuid:7>", WARC_Payload_Digest=f"sha1:{warc.payload_digest(b'abc')}", **response),
        member("response", b"20240101 h A 1.2.3.4", WARC_Record_ID="<urn:uuid:8>", Content_Type="text/dns"),
        member("revisit", b"", WARC_Record_ID="<urn:uuid:9>", WARC_Refers_To="<urn:uuid:4>"),
        member("resource", b"", WARC_Record_ID="<urn:page:99999999999999999999>"),
    ]


@pytest.mark.parametrize("name", ["a.warc.gz", "a.warc", "a.txt"])
@pytest.mark.parametrize("size", ["5000", "100000000"])
def test_archives_of_others(spark, name, size):
    noise, members = archive(random.Random(61))
    folder = f"{shared_folder(spark)}/foreign-{uuid.uuid4().hex}"
    os.makedirs(folder.removeprefix("file:"))
    with open(f"{folder.removeprefix('file:')}/{name}", "wb") as f:
        f.write(b"".join(members))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = {r.record_id: r for r in warc.read_archives(spark, folder).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == len(members)
    assert {r.record_type for r in got.values()} == {"warcinfo", "request", "response", "revisit", "resource"}
    assert all(r.page_id is None and r.refers_to is None for r in got.values())
    of = lambda n: got[f"<urn:uuid:{n}>"]
    assert bytes(of(1).payload) == b"software: x\r\n" and bytes(of(8).payload) == b"20240101 h A 1.2.3.4"
    assert all(bytes(of(n).payload) == noise for n in (3, 4, 5)) and of(3).url == "http://h/é"
    assert of(3).payload_digest == of(4).payload_digest == warc.payload_digest(noise)
    assert of(5).payload_digest.startswith("sha256:") and of(6).payload_digest == "blake3:00"
    assert of(7).payload_digest == warc.payload_digest(b"abc")
    assert (of(9).payload, of(9).payload_bytes, of(9).payload_digest, of(9).refers_to_id) == (None, None, None, "<urn:uuid:4>")


def test_damage_raises():
    whole = lambda m: gzip.decompress(m)
    with pytest.raises(ValueError):
        warc.parsed(whole(member("response", b"x", WARC_Payload_Digest=f"sha1:{warc.payload_digest(b'y')}")))
    with pytest.raises(ValueError):
        warc.parsed(whole(member("response", b"x" * 50))[:-20])
    with pytest.raises(ValueError):
        warc.parsed(b"WARC/1.0\r\nWARC-Type: x\r\n\r\n")


def test_no_pages(spark):
    folder = f"{shared_folder(spark)}/none-{uuid.uuid4().hex}"
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read_archives(spark, folder).count() == 0
