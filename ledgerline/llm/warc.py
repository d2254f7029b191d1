"""Web archives (.warc.zst): one Zstandard frame a record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.arrays import arrow_schema, slices
from ledgerline.llm.store import stored, write_file

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, error string"
)


@dataclass(frozen=True)
class ArchiveOptions:
    """archive_bytes: payload in one file (a larger record is a file of its own). dictionary_bytes and sample_bytes: size of the
    dictionary and of the payloads that it is made from. least_bytes: smaller payloads are never revisits."""

    archive_bytes: int = 8 << 20
    dictionary_bytes: int = 64 << 10
    sample_bytes: int = 2 << 20
    least_bytes: int = 0
    level: int = 3
    date: str = "2024-01-01T00:00:00Z"


def dictionary(payloads: list[bytes], o: ArchiveOptions) -> zstd.ZstdCompressionDict:
    """Trained on the first payloads; from too few, the payloads themselves serve as a raw dictionary."""
    sample, size = [], 0
    for payload in payloads:
        if size >= o.sample_bytes:
            break
        sample.append(payload[: o.sample_bytes - size])
        size += len(sample[-1])
    try:
        return zstd.train_dictionary(o.dictionary_bytes, [s for s in sample if s])
    except zstd.ZstdError:
        raw = b"".join(sample)[: o.dictionary_bytes]
        return zstd.ZstdCompressionDict(raw if len(raw) >= 8 else b"WARC/1.1\r\n", dict_type=zstd.DICT_TYPE_RAWCONTENT)


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """A WARC record; a revisit has the HTTP head of the full payload, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def archive(records: list[bytes], words: zstd.ZstdCompressionDict, level: int) -> bytes:
    packed = zstd.ZstdCompressor(level=level).compress(words.as_bytes())
    frames = zstd.ZstdCompressor(level=level, dict_data=words, write_checksum=True, write_content_size=True)
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(packed)), packed, *(frames.compress(r) for r in records)])


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at `at` ends, from its block headers."""
    head = bytes(data[at : at + 18])
    place = at + zstd.frame_header_size(head)
    checksum = zstd.get_frame_parameters(head).has_checksum
    while True:
        if place + 3 > len(data):
            raise ValueError("a frame is cut")
        block = int.from_bytes(data[place : place + 3], "little")
        place += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            break
    place += 4 * checksum
    if place > len(data):
        raise ValueError("a frame is cut")
    return place


def frames(content: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive, one a record; the dictionary may itself be compressed, or be missing."""
    data, at, words = memoryview(content), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", data, 4)[0]
        raw = bytes(data[8 : 8 + size])
        if len(raw) != size:
            raise ValueError("the dictionary frame is cut")
        words = zstd.ZstdCompressionDict(zstd.ZstdDecompressor().decompress(raw) if raw[:4] == ZSTD_FRAME else raw)
        at = 8 + size
    reader = zstd.ZstdDecompressor(dict_data=words)
    while at < len(data):
        end = frame_end(data, at)
        yield reader.decompressobj().decompress(data[at:end])
        at = end


def _head(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = raw.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _number(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text.lstrip("-").isdigit() else None


def parse(raw: bytes) -> tuple[dict, bytes | None]:
    """The columns of RECORD_SCHEMA and the payload (None for a revisit); `error` names the first thing that is wrong."""
    row = dict.fromkeys(("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "error"))
    top, gap, block = raw.partition(b"\r\n\r\n")
    version, head = _head(top)
    missing = [k for k in ("warc-type", "warc-record-id", "warc-date", "content-length") if k not in head]
    if not gap or version not in ("WARC/1.0", "WARC/1.1") or missing:
        return row | {"error": f"bad header {version[:20]} {missing}"}, None
    row |= {
        "page_id": _number(head["warc-record-id"]),
        "url": head.get("warc-target-uri"),
        "record_type": head["warc-type"],
        "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
    }
    length = head["content-length"]
    if not length.isdigit() or len(block) != int(length) + 4 or block[-4:] != b"\r\n\r\n":
        return row | {"error": "content length differs from the block"}, None
    http, gap, payload = block[:-4].partition(b"\r\n\r\n")
    status, http_head = _head(http)
    size = http_head.get("content-length", "")
    if not gap or not status.startswith("HTTP/") or not size.isdigit():
        return row | {"error": "bad HTTP head"}, None
    row["payload_bytes"] = int(size)
    if row["record_type"] == "revisit":
        row["refers_to"] = _number(head.get("warc-refers-to", ""))
        bad = "revisit with a payload" if payload else None if row["refers_to"] is not None else "revisit of nothing"
        return row | {"error": bad}, None
    if len(payload) != int(size):
        return row | {"error": "payload length differs from its head"}, None
    if row["payload_digest"] != base64.b32encode(hashlib.sha1(payload).digest()).decode():
        return row | {"error": "payload digest differs"}, None
    return row, payload


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", o: ArchiveOptions = ArchiveOptions()) -> DataFrame:
    """Write a record per row into .warc.zst files; the manifest (name, n_records).

    A null html is empty. Of equal payloads of at least least_bytes the row with the smallest key is a response and others
    revisit it; rows that share that key are all responses, and so is any row whose key, or all of whose equals' keys, are
    null. A null url has no target header. Files of repeated tasks that are not in the manifest do not count. Other columns
    are ignored. An empty table has no files.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html")
    ).withColumn("digest", F.sha1("html"))
    first = stored(rows.select("key", "digest").groupBy("digest").agg(F.min("key").alias("first")), "payloads")
    again = F.expr(f"coalesce(key > first and octet_length(html) >= {o.least_bytes}, false)")
    linked = rows.join(first, "digest").select("key", "url", "html", "digest", "first", again.alias("again"))

    def write(batches):
        part = TaskContext.get().partitionId()
        for piece, rows in enumerate(slices(batches, "html", o.archive_bytes)):
            values = rows.to_pydict()
            payloads = [h.encode() for h in values["html"]]
            digests = [base64.b32encode(bytes.fromhex(d)).decode() for d in values["digest"]]
            records = [
                record(k, u, h, d, f, a, o.date)
                for k, u, h, d, f, a in zip(values["key"], values["url"], payloads, digests, values["first"], values["again"], strict=True)
            ]
            name = write_file(folder, f"{part:07d}-{piece:06d}-{uuid.uuid4().hex}.warc.zst", archive(records, dictionary(payloads, o), o.level))
            yield pa.RecordBatch.from_pydict({"name": [name], "n_records": [len(records)]})

    return stored(linked.mapInArrow(write, "name string, n_records long"), "manifest")


def read_archives(files: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of archives given as (path, content), as the binaryFile source gives them: path, RECORD_SCHEMA and, if asked for,
    the payload. A record that is not valid is a row with its `error`; a cut frame fails the task."""
    schema = f"path string, {RECORD_SCHEMA}" + ", payload binary" * payloads

    kinds = arrow_schema(schema)

    def read(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, size = [], 0
                for raw in frames(content.as_buffer()):
                    row, payload = parse(raw)
                    rows.append({"path": path.as_py()} | row | ({"payload": payload} if payloads else {}))
                    size += len(raw) if payloads else 1000
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kinds)

    return files.select("path", "content").mapInArrow(read, schema)


def archived(pages: DataFrame, folder: str, o: ArchiveOptions = ArchiveOptions()) -> DataFrame:
    """Write the pages, read the archives back: a row a page."""
    manifest = write_archives(pages, folder, o=o)
    if manifest.isEmpty():
        return pages.sparkSession.createDataFrame([], RECORD_SCHEMA)
    files = pages.sparkSession.read.format("binaryFile").load(folder)
    found = read_archives(files).withColumn("name", F.element_at(F.split("path", "/"), -1))
    return found.join(manifest.select("name"), "name", "left_semi").drop("name", "path")
