"""Archives of other writers, damage, and op4's query against plain Python."""

import base64
import hashlib
import random

import pytest
import zstandard

from gearwatch.llm import warc
from tests.llm.small import folder, run


def entry(kind="response", block=b"HTTP/1.1 200 OK\r\n\r\nbody", version="1.1", name="urn:uuid:550e8400-e29b-41d4-a716-446655440000", **more):
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<{name}>", "WARC-Date": "2024-01-01T00:00:00Z",
              "Content-Type": "application/http; msgtype=response", **{k.replace("_", "-"): v for k, v in more.items()}}
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/{version}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def http(*lines, body=b"body"):
    return b"\r\n".join([b"HTTP/1.1 200 OK", *lines]) + b"\r\n\r\n" + body


SHA = "sha1:" + base64.b32encode(hashlib.sha1(b"body").digest()).decode()
FOREIGN = {  # record -> (record_type, payload, payload_bytes)
    entry(): ("response", b"body", 4),
    entry(version="1.0", WARC_Payload_Digest=SHA): ("response", b"body", 4),
    entry(WARC_Payload_Digest="sha256:" + hashlib.sha256(b"body").hexdigest()): ("response", b"body", 4),
    entry(WARC_Payload_Digest="crc99:1"): ("response", b"body", 4),
    entry(block=http(b"Set-Cookie: a=1", b"Set-Cookie: b=2", b"Content-Length: 4")): ("response", b"body", 4),
    entry(block=http(b"X-Name: caf\xe9", b"X-Long: a", b"\tb")): ("response", b"body", 4),
    entry(block=http(b"Transfer-Encoding: chunked", body=b"2;x=y\r\nbo\r\n2\r\ndy\r\n0\r\n\r\n"), WARC_Payload_Digest=SHA): ("response", b"body", 4),
    entry(block=http(b"Content-Length: 9"), WARC_Truncated="length"): ("response", b"body", 4),
    entry("resource", b"body", Content_Type="text/plain", WARC_Payload_Digest=SHA): ("resource", b"body", 4),
    entry("revisit", b"", WARC_Refers_To="<urn:uuid:1>", WARC_Payload_Digest=SHA): ("revisit", None, None),
    entry("revisit", http(b"Content-Length: 4", body=b""), name="urn:page:7", WARC_Refers_To="<urn:page:3>"): ("revisit", None, 4),
}
PASSED = [entry("warcinfo", b"software: x", Content_Type="application/warc-fields"), entry("request", b"GET / HTTP/1.1\r\n\r\n"),
          entry("metadata", b"a: b"), entry("conversion", b"text")]
DAMAGED = [entry(WARC_Payload_Digest=SHA[:-1] + "A"), entry(WARC_Block_Digest=SHA), entry(block=http(b"Content-Length: 5")), entry(block=b"no http"),
           entry(version="2.0"), entry(WARC_Date=None), entry()[:-1], entry("warcinfo", b"x")[:-2], entry().replace(b"Content-Length: 23", b"Content-Length: x"),
           entry().replace(b"WARC-Date:", b"WARC-Type: a\r\nWARC-Date:"), entry().replace(b"WARC-Date:", b"WARC Date")]


def test_records_of_other_writers():
    for raw, (kind, payload, size) in FOREIGN.items():
        got = warc.parse(raw)
        assert (got["record_type"], got["payload"], got["payload_bytes"]) == (kind, payload, size), raw
    assert [warc.parse(raw) for raw in PASSED] == [None] * len(PASSED)
    got = warc.parse(list(FOREIGN)[-1])
    assert (got["page_id"], got["refers_to"]) == (7, 3) and warc.parse(entry())["page_id"] is None


@pytest.mark.parametrize("raw", DAMAGED)
def test_damage_is_refused(raw):
    with pytest.raises(warc.CorruptArchive):
        warc.parse(raw)


def test_files_of_other_writers(spark, tmp_path):
    records = [*FOREIGN, *PASSED]
    (tmp_path / "with.warc.zst").write_bytes(warc.archive(records))
    plain = zstandard.ZstdCompressor()
    (tmp_path / "without.warc.zst").write_bytes(b"".join(plain.compress(r) for r in records))
    skip = b"\x50\x2a\x4d\x18\x03\x00\x00\x00abc"
    (tmp_path / "skip.warc.zst").write_bytes(warc.archive(records[:3]) + skip + b"".join(plain.compress(r) for r in records[:1]))
    got = warc.read_archives(warc.manifest_of(spark, f"{tmp_path}/*.warc.zst")).collect()
    want = sorted(map(repr, [*FOREIGN.values()] * 2 + [*FOREIGN.values()][:3] + [*FOREIGN.values()][:1]))
    assert sorted(repr((r["record_type"], r["payload"] if r["payload"] is None else bytes(r["payload"]), r["payload_bytes"])) for r in got) == want


def test_query_against_plain_python(spark, tmp_path):
    r = random.Random(4)
    bodies = [None, "", "a", "é\u0000\U0001f600" * 50, "x" * 3_000_000, *("".join(r.choice("abc <>/\n") for _ in range(r.randint(1, 300))) for _ in range(8))]
    rows = [(i, r.choice([None, "http://a/", "b\r\nc: d", ""]), r.choice(bodies)) for i in [*range(60), 2**53 + 1, 2**53 + 3, 2**63 - 1, -5]]
    rows += [(None, None, bodies[2]), (None, "u", "only here"), rows[0]]
    path = folder(spark, tmp_path, clash=True, pages=(rows, "page_id long, url string, html string"))
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = []
    for i, _, html in rows:
        raw, head = (html or "").encode(), first.get(html or "")
        again = head is not None and i != head
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", head if again else None))
    got = run(spark, "op4_warc", path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_archives_on_disk_begin_with_the_dictionary_frame(spark, tmp_path):
    pages = spark.createDataFrame([(k, "u", f"page {k} " * 50) for k in range(20)], "page_id long, url string, html string")
    for m in warc.write_archives(pages, f"file://{tmp_path}").collect():
        data = open(m["path"].removeprefix("file://"), "rb").read()
        assert len(data) == m["bytes"] and int.from_bytes(data[:4], "little") == warc.SKIPPABLE_MAGIC
