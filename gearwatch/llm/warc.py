"""WARC archives in Zstandard: one frame per record, dictionary in a leading skippable frame.

Writing: equal payloads are found by SHA-1 over the table; the record with the
smallest page_id holds the payload, the others are revisit records that refer
to it.  Each task writes archives of bounded size into the shared folder and
returns a manifest row for each; only archives in the manifest are read, so files of a
lost or repeated task attempt are ignored.

Reading: archives are dealt out by size and read frame by frame.  The
dictionary comes from the skippable frame, where there is one; every record's version, header
syntax, block length, digests and final separators are validated.  Archives of other writers are read too: WARC 1.0 and
1.1, any record id, fields that the format leaves optional (digests, HTTP lengths), SHA-1, SHA-256 and MD5 digests in Base32 or
hexadecimal, chunked and truncated payloads, folded, repeated and Latin-1 HTTP header lines.  Responses, revisits and resources
become rows; other kinds of record are validated and passed over.

Memory is bounded by one archive's buffer (``ARCHIVE_BYTES``) while
writing and one record while reading.

Defined cases: null html is an empty payload; a null url is written as
``urn:unknown``, and control characters of urls are percent-encoded; rows that repeat the smallest
page_id of a payload are all responses; a null page_id ranks last and is
written as an empty id; a foreign record's page_id is null and its ``record_id`` tells it; a revisit
that does not tell its payload's length has none; other columns may have any names; payloads of any length up to an
Arrow cell's 2 GB are read one at a time; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import text_batches, whole_numbers, written

ARCHIVE_BYTES = 32 << 20       # uncompressed record bytes after which a new archive begins
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 2 << 20         # first records of an archive, from which its dictionary is trained
LEVEL = 3
MAX_HEADER_BYTES = 64 << 10
READ_BYTES = 128 << 20         # compressed bytes a task reads where archives are many
# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
WARC_VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
KINDS = ("response", "revisit", "resource")  # records that become rows
REPEATABLE = "warc-concurrent-to"            # the only WARC field that may stand twice
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "1970-01-01T00:00:00Z"  # the pages carry no capture time
ID_PREFIX = "urn:page:"

MANIFEST = "path string, records long, bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, record_id string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a 40-digit hexadecimal column: every five digits are four characters."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = F.transform(F.sequence(F.lit(0), F.lit(7)),
                         lambda g: F.conv(F.substring(digest, g * 5 + 1, F.lit(5)), 16, 10).cast("int"))

    def characters(v: Column) -> Column:
        return F.concat(*[F.substring(F.lit(alphabet), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1))
                          for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(groups, characters), "")


def marked(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, first): ``first`` is the smallest page_id with the payload, null where there is one row.

    Only digests found more than once are joined back; Spark splits that
    join where one payload has many copies.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    copies = (p.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    return p.join(copies, "digest", "left")


def http_block(payload: bytes, with_body: bool) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + (payload if with_body else b"")


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """One WARC record; ``first`` differs from ``page_id`` for a revisit."""
    revisit = first is not None and first != page_id
    block = http_block(payload, not revisit)
    name = lambda i: f"<{ID_PREFIX}{'' if i is None else i}>"
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(page_id)),
              ("WARC-Date", WARC_DATE),
              ("WARC-Target-URI", "urn:unknown" if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")),
              ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
              ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", name(first))]
    fields.append(("Content-Length", str(len(block))))
    head = WARC_VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on the archive's first records, raw content where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICTIONARY_BYTES]


def archive(records: list[bytes]) -> bytes:
    """Skippable frame with the dictionary, then a frame for each record."""
    sample, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        sample.append(r)
        size += len(r)
    raw = dictionary(sample)
    out = [struct.pack("<II", SKIPPABLE_MAGIC, len(raw)), raw]
    zd = zstandard.ZstdCompressionDict(raw)
    compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=zd, write_content_size=True, write_checksum=True)
    out += [compress.compress(r) for r in records]
    return b"".join(out)


class CorruptArchive(ValueError):
    """An archive or record that fails validation."""


def frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The decoded frames after the dictionary frame, one at a time."""
    head = stream.read(8)
    if head[:4] == FRAME_MAGIC:  # written without a dictionary
        reader, rest = zstandard.ZstdDecompressor(), head + stream.read(chunk)
    elif len(head) == 8 and struct.unpack("<II", head)[0] == SKIPPABLE_MAGIC:
        size = struct.unpack("<II", head)[1]
        raw = stream.read(size)
        if len(raw) != size:
            raise CorruptArchive("dictionary is cut off")
        try:
            if raw[:4] == FRAME_MAGIC:  # a dictionary may itself be compressed
                raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        except zstandard.ZstdError as e:
            raise CorruptArchive(f"dictionary: {e}") from e
        rest = stream.read(chunk)
    else:
        raise CorruptArchive("no dictionary frame and no frame of data")
    while rest:
        one, parts = reader.decompressobj(), []
        while True:
            try:
                parts.append(one.decompress(rest))
            except zstandard.ZstdError as e:
                raise CorruptArchive(f"frame: {e}") from e
            if one.eof:
                rest = one.unused_data or stream.read(chunk)
                break
            rest = stream.read(chunk)
            if not rest:
                raise CorruptArchive("last frame is cut off")
        yield b"".join(parts)


def lines_of(head: bytes) -> Iterator[tuple[str, str]]:
    """(lower-cased name, value) of each header line, lines that go on with a blank joined; UTF-8, else Latin-1."""
    joined: list[bytes] = []
    for line in head.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and joined:
            joined[-1] += b" " + line.strip()
        else:
            joined.append(line)
    for line in joined:
        try:
            text = line.decode("utf-8")
        except UnicodeDecodeError:
            text = line.decode("latin-1")
        key, colon, value = text.partition(":")
        if not colon or not key or key != key.strip():
            raise CorruptArchive(f"header line {line[:80]!r}")
        yield key.lower(), value.strip()


def warc_fields(head: bytes) -> dict[str, str]:
    fields: dict[str, str] = {}
    for key, value in lines_of(head):
        if key in fields and key != REPEATABLE:
            raise CorruptArchive(f"field {key} stands twice")
        fields[key] = value
    return fields


def length_of(value: str) -> int:
    if not (value.isascii() and value.isdigit()):
        raise CorruptArchive(f"length {value[:80]!r}")
    return int(value)


def agrees(digest: str | None, *contents: bytes) -> bool:
    """Whether one of the contents has the digest, ``algorithm:value``; one by an unknown algorithm can't be checked."""
    if digest is None:
        return True
    name, _, value = digest.partition(":")
    name = name.lower().replace("-", "")
    if name not in ("sha1", "sha256", "md5"):
        return True
    for c in contents:
        found = hashlib.new(name, c).digest()
        if value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=") or value.lower() == found.hex():
            return True
    return False


def unchunked(body: bytes) -> bytes | None:
    """The content of a chunked body, None if it is not well formed."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:max(end, at)].partition(b";")[0].strip()
        if end < 0 or not size or size.strip(b"0123456789abcdefABCDEF"):
            return None
        n = int(size, 16)
        if not n:
            return b"".join(parts)
        part = body[end + 2:end + 2 + n]
        if len(part) != n or body[end + 2 + n:end + 4 + n] != b"\r\n":
            return None
        parts.append(part)
        at = end + 4 + n


def http_payload(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(header fields, the first of a name; body as sent; payload: the body without chunks) of an HTTP response."""
    http, blank, body = block.partition(b"\r\n\r\n")
    if not blank or not http.startswith(b"HTTP/"):
        raise CorruptArchive("no HTTP header")
    fields: dict[str, str] = {}
    for key, value in lines_of(http.split(b"\r\n", 1)[1]) if b"\r\n" in http else ():
        fields.setdefault(key, value)
    whole = unchunked(body) if "chunked" in fields.get("transfer-encoding", "").lower() else None
    return fields, body, body if whole is None else whole


def parse(raw: bytes) -> dict | None:
    """A validated record as a row of ``RECORDS``, None for a kind of record that is no row."""
    end = raw.find(b"\r\n\r\n", 0, MAX_HEADER_BYTES)
    version, _, head = raw[:max(end, 0)].partition(b"\r\n")
    if end < 0 or version not in VERSIONS:
        raise CorruptArchive("no WARC header")
    f = warc_fields(head)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - f.keys()
    if missing:
        raise CorruptArchive(f"header lacks {sorted(missing)}")
    size = length_of(f["content-length"])
    block, tail = raw[end + 4:end + 4 + size], raw[end + 4 + size:]
    if len(block) != size or tail != b"\r\n\r\n":
        raise CorruptArchive("block length differs from Content-Length")
    if not agrees(f.get("warc-block-digest"), block):
        raise CorruptArchive("block digest differs")
    kind, truncated = f["warc-type"].lower(), "warc-truncated" in f
    if kind not in KINDS:
        return None
    is_http = f.get("content-type", "").lower().startswith("application/http")
    fields, body, payload = http_payload(block) if is_http and block else ({}, block, block)
    told = length_of(fields["content-length"]) if "content-length" in fields and "transfer-encoding" not in fields else None
    digest = f.get("warc-payload-digest")
    if kind == "revisit":
        length, payload = told, None
    else:
        length = len(payload)
        if not truncated and (told not in (None, len(body)) or not agrees(digest, payload, body)):
            raise CorruptArchive("payload differs from its length or digest")
        digest = digest or f"sha1:{base32_sha1(payload)}"
    name = lambda key: f.get(key, "").strip("<>")

    def page(key: str) -> int | None:
        own = name(key).removeprefix(ID_PREFIX)
        return int(own) if own != name(key) and own.removeprefix("-").isdigit() else None

    return {"page_id": page("warc-record-id"), "url": f.get("warc-target-uri"), "payload_bytes": length,
            "payload_digest": digest and digest.removeprefix("sha1:"), "record_type": kind,
            "refers_to": page("warc-refers-to") if kind == "revisit" else None, "payload": payload, "record_id": name("warc-record-id")}


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under ``folder``; the manifest, as a written table."""
    text_batches(pages.sparkSession)

    def flush(records: list[bytes]) -> dict:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        data, name = archive(records), f"{uuid.uuid4().hex}.warc.zst"
        with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(data)
        return {"path": f"{folder}/{name}", "records": len(records), "bytes": len(data)}

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        records, size = [], 0
        for b in batches:
            for page_id, url, html, first in zip(b["page_id"], b["url"], b["html"], b["first"], strict=True):
                one = record(None if pd.isna(page_id) else int(page_id), url, html.encode("utf-8", "replace"),
                             None if pd.isna(first) else int(first))
                records.append(one)
                size += len(one)
                if size >= ARCHIVE_BYTES:
                    yield pd.DataFrame([flush(records)])
                    records, size = [], 0
        if records:
            yield pd.DataFrame([flush(records)])

    # nullable ids travel as strings: pandas would make them floats
    rows = marked(pages).select(F.col("page_id").cast("string"), "url", "html", F.col("first").cast("string"))
    return written(rows.mapInPandas(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Validated records of the archives listed in ``manifest`` (path, records, bytes); null ``records`` are not counted."""
    def rows(paths: Iterable[str]) -> Iterator[dict]:
        for path, n in paths:
            fs, file = pafs.FileSystem.from_uri(path)
            found = 0
            with fs.open_input_stream(file, compression=None) as stream:
                for raw in frames(stream):
                    if not raw:  # a skippable frame
                        continue
                    found += 1
                    if (row := parse(raw)) is not None:
                        yield row
            if n is not None and found != n:
                raise CorruptArchive(f"{path}: {found} records, the manifest has {n}")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            part, size = [], 0
            for r in rows((p, None if pd.isna(n) else int(n)) for p, n in zip(b["path"], b["records"], strict=True)):
                size += len(r["payload"] or b"")
                if not payloads:
                    r["payload"] = None
                part.append(r)
                if len(part) >= 1000 or size >= 16 << 20:
                    yield frame(part)
                    part, size = [], 0
            if part:
                yield frame(part)

    def frame(part: list[dict]) -> pd.DataFrame:
        ids = {c: whole_numbers(r[c] for r in part) for c in ("page_id", "refers_to", "payload_bytes")}
        return pd.DataFrame({c: ids.get(c, [r[c] for r in part]) for c in part[0]})

    # an archive each task, or several small ones up to READ_BYTES where there are many
    total = manifest.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    least = manifest.sparkSession.sparkContext.defaultParallelism
    n = max(1, min(total["n"], max(4 * least, total["bytes"] // READ_BYTES)))
    return manifest.repartition(int(n)).mapInPandas(read, RECORDS)


def manifest_of(spark: SparkSession, pattern: str) -> DataFrame:
    """Manifest of archives that others wrote: (path, records, bytes) of the files that ``pattern`` names, records not known."""
    files = spark.read.format("binaryFile").load(pattern).select("path", F.col("length").alias("bytes"))
    return files.select("path", F.lit(None).cast("long").alias("records"), "bytes")


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write archives under the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder if "://" in folder else f"file://{folder}"), payloads=False)
