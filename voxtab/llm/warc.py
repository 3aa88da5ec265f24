"""WARC archives compressed with Zstandard: one frame for each record, one dictionary for each archive.

An archive starts with a skippable frame that holds the dictionary; each record follows as a
frame of its own. Archives travel as rows ``path, content``: what Spark's ``binaryFile`` reader
gives for files, and what :func:`write_archives` makes, so archives can lie in any store that
Spark reads. An archive is closed once it holds ``archive_bytes``, which bounds a row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Fixed values of the WARC and Zstandard formats.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
RAW_DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
VERSION, VERSIONS = b"WARC/1.1", (b"WARC/1.0", b"WARC/1.1")
#: Types of records that are read; others are checked as far as their headers, length and block digest, and passed over.
READ = ("response", "revisit")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An archive ends once it is this long; its dictionary is made from the first records, up to SAMPLE_BYTES.
ARCHIVE_BYTES = 4 << 20
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 16 << 10
#: Bytes of a record that the dictionary is learned from, and of a piece of them.
SAMPLED_BYTES, PIECE_BYTES = 8192, 1024
_URN = "urn:x-page:"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str | None) -> str:
    """The URL without characters that could end a header."""
    return re.sub(r"[\x00-\x20\x7f<>]", lambda m: f"%{ord(m[0]):02X}", url or "")


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or with ``refers_to`` a revisit, whose block keeps the HTTP header but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{_URN}{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", _uri(url)),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        head[4:4] = [("WARC-Refers-To", f"<{_URN}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, at: int, strict: bool = True) -> tuple[dict[str, str], int]:
    """Fields by lower-case name (lines that start with a blank continue the one before) and the place behind them.

    Malformed lines are an error of a WARC header; in the header of a web server's answer they are passed over.
    """
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise ValueError("header without an end")
    fields, last = {}, None
    for line in data[at:end].decode("utf-8" if strict else "iso-8859-1").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and last:
            fields[last] = f"{fields[last]} {line.strip()}".strip()
        elif colon and name and name == name.strip():
            last = name.lower()
            fields[last] = value.strip()
        elif strict:
            raise ValueError(f"malformed header line {line[:60]!r}")
    return fields, end + 4


def _length(text: str) -> int:
    if not re.fullmatch(r"[0-9]{1,18}", text):
        raise ValueError(f"{text[:40]!r} is no length")
    return int(text)


def _unchunked(body: bytes) -> bytes | None:
    """The body without the chunked transfer coding; None where it is not coded so."""
    out, at = [], 0
    while m := re.compile(rb"([0-9A-Fa-f]{1,15})[^\r\n]*\r\n").match(body, at):
        size, at = int(m[1], 16), m.end()
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2
    return None


def _holds(stated: str, data: bytes) -> bool:
    """Whether a labelled digest (base32 or hexadecimal) is that of ``data``; one of an unknown algorithm says nothing."""
    label, _, value = stated.partition(":")
    kind = label.strip().lower().replace("-", "")
    if kind not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return True
    digest, value = hashlib.new(kind, data).digest(), value.strip()
    return value.lower() == digest.hex() or value.upper().rstrip("=") == base64.b32encode(digest).decode().rstrip("=")


def _number(record_id: str | None) -> int | None:
    """The page of a record id that :func:`make_record` gave; None for any other."""
    m = re.fullmatch(rf"<?{_URN}(-?[0-9]{{1,19}})>?", record_id or "")
    return int(m[1]) if m and -(1 << 63) <= int(m[1]) < 1 << 63 else None


def parse_record(data: bytes) -> dict | None:
    """Fields and payload of one record; ``ValueError`` where a header, length or digest does not hold.

    Versions 1.0 and 1.1, any record id. None for types other than READ (``warcinfo``, ``request``,
    types of later standards, ...). The payload is what follows the HTTP header (the whole block where it is not HTTP), as it
    was sent: a chunked or compressed body stays so. Its length has to be the one that HTTP states, except for chunked and
    ``WARC-Truncated`` bodies. A stated payload digest is checked (of a chunked body, either form's; of a truncated one, none);
    where it is missing or no SHA-1, that of the payload is given, and null for a revisit.
    """
    if not data.startswith(tuple(v + b"\r\n" for v in VERSIONS)):
        raise ValueError("record does not start with its version")
    head, at = _headers(data, 0)
    for name in ("warc-type", "warc-record-id", "content-length", "warc-date"):
        if not head.get(name):
            raise ValueError(f"header {name} is missing")
    length = _length(head["content-length"])
    if len(data) != at + length + 4 or data[at + length :] != b"\r\n\r\n":
        raise ValueError(f"record of {len(data)} bytes does not fit its length {length}")
    block, kind, cut = data[at : at + length], head["warc-type"].lower(), "warc-truncated" in head
    if not _holds(head.get("warc-block-digest", ""), block):
        raise ValueError("block digest does not hold")
    if kind not in READ:
        return None
    http, start = {}, 0
    if head.get("content-type", "").lower().startswith("application/http") and block:
        http, start = _headers(block, 0, strict=False)
    payload, stated = block[start:], head.get("warc-payload-digest", "")
    declared = _length(http["content-length"]) if http.get("content-length") else None
    chunked = "chunked" in http.get("transfer-encoding", "").lower()
    if kind == "response" and not cut:
        if declared is not None and not chunked and declared != len(payload):
            raise ValueError(f"payload of {len(payload)} bytes does not fit its length {declared}")
        if not _holds(stated, payload) and not (chunked and (plain := _unchunked(payload)) is not None and _holds(stated, plain)):
            raise ValueError("payload digest does not hold")
    label, _, value = stated.partition(":")
    named = value.strip() if label.strip().lower() in ("sha1", "sha-1") else ""
    if re.fullmatch(r"[0-9A-Fa-f]{40}", named):
        named = base64.b32encode(bytes.fromhex(named)).decode()
    refers = head.get("warc-refers-to")
    return {
        "page_id": _number(head["warc-record-id"]), "url": head.get("warc-target-uri", "").strip("<>") or None, "payload": payload,
        "payload_bytes": len(payload) if kind == "response" else declared, "payload_digest": named.upper() or (digest_of(payload) if kind == "response" else None),
        "record_type": kind, "refers_to": _number(refers) if kind == "revisit" else None,
        "record_id": head["warc-record-id"].strip("<>"), "refers_to_record": refers.strip("<>") if refers and kind == "revisit" else None,
    }


def frame_end(data: bytes, at: int) -> int:
    """Where the frame that starts at ``at`` ends, from the sizes in its block headers."""
    if data[at : at + 4] != ZSTD_MAGIC:
        raise ValueError(f"no Zstandard frame at byte {at}")
    if at + 5 > len(data):
        raise ValueError("frame is cut off")
    checksum = data[at + 4] >> 2 & 1
    at += zstandard.frame_header_size(data[at : at + 18])
    while True:
        if at + 3 > len(data):
            raise ValueError("frame is cut off")
        word = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if word >> 1 & 3 == 1 else word >> 3)
        if word & 1:
            break
    at += 4 * checksum
    if at > len(data):
        raise ValueError("frame is cut off")
    return at


def read_dictionary(data: bytes) -> tuple[bytes, int]:
    """The dictionary in the leading skippable frame (empty where there is none) and the first record's place."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY_MAGIC:
        return b"", 0
    length = struct.unpack_from("<I", data, 4)[0]
    if len(data) < 8 + length:
        raise ValueError("dictionary frame is cut off")
    held = data[8 : 8 + length]
    if held[:4] == ZSTD_MAGIC:
        held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
    elif held[:4] != RAW_DICTIONARY_MAGIC:
        raise ValueError("dictionary frame holds no dictionary")
    return held, 8 + length


def read_archive(data: bytes) -> Iterator[dict]:
    """The responses and revisits of one archive, one frame each, checked. Every fault is a ``ValueError`` that names its byte."""
    at = 0
    try:
        held, at = read_dictionary(data)
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held) if held else None)
        while at < len(data):
            end = frame_end(data, at)
            record = parse_record(reader.decompressobj().decompress(data[at:end]))
            if record is not None:
                yield record
            at = end
    except (ValueError, zstandard.ZstdError) as e:
        raise ValueError(f"byte {at}: {e}") from e


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary learned from the starts of the records, in pieces; from the fixed parts of records where they are too few or too alike."""
    pieces = [r[at : at + PIECE_BYTES] for r in records for at in range(0, min(len(r), SAMPLED_BYTES), PIECE_BYTES)]
    usual = [make_record(i, f"http://example.org/{i}", b"<html><head><title></title></head><body></body></html>" * (i % 3), None if i % 4 else i) for i in range(128)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces if len(pieces) >= 64 else pieces + usual)
    except zstandard.ZstdError:
        return zstandard.train_dictionary(DICTIONARY_BYTES, usual)


def make_archive(records: list[bytes], more: Iterator[bytes], archive_bytes: int = ARCHIVE_BYTES) -> bytes:
    """An archive of ``records``, which also teach the dictionary, and of ``more`` until it is long enough."""
    out = bytearray()
    held = dictionary(records)
    packed = zstandard.ZstdCompressor(level=9).compress(held.as_bytes())
    out += struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed
    writer = zstandard.ZstdCompressor(level=6, dict_data=held, write_checksum=True, write_content_size=True)
    for record in records:
        out += writer.compress(record)
    while len(out) < archive_bytes and (record := next(more, None)) is not None:
        out += writer.compress(record)
    return bytes(out)


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``path, content`` archives of all ``pages`` (``page_id, url, html``), written to the shared folder.

    The payload is the HTML in UTF-8 (null: empty). Of equal payloads the one with the smallest
    ``page_id`` is a response and the others revisit it; null ids come last, and rows that repeat
    the smallest id are responses too. Only ids and digests are shuffled to find the equal ones.
    """
    p = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    ids = stored(p.select("page_id", "digest"))
    first = ids.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n")
    again = ids.join(stored(first), "digest").where("page_id is null or page_id > refers_to").distinct()
    again = again.select(F.col("page_id").alias("id"), F.col("digest").alias("d"), "refers_to")
    rows = p.join(again, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d")), "left").select("page_id", "url", "payload", "refers_to")

    def run(batches):
        def each():
            for batch in batches:
                for r in zip(*(batch.column(k) for k in range(4))):
                    yield make_record(*(x.as_py() for x in r))

        records = each()
        number = 0
        while True:
            sample, size = [], 0
            while size < min(SAMPLE_BYTES, archive_bytes) and (record := next(records, None)) is not None:
                sample.append(record)
                size += len(record)
            if not sample:
                return
            content = make_archive(sample, records, archive_bytes)
            number += 1
            name = f"{hashlib.sha1(content).hexdigest()}-{number:05d}.warc.zst"
            yield pa.record_batch([pa.array([name]), pa.array([content], pa.binary())], ["path", "content"])

    return stored(rows.mapInArrow(run, "path string, content binary"))


def save_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Write each archive as a file of ``folder`` (a URI that all tasks reach) and give the paths.

    Names come from the contents and files are renamed when complete, so a task that runs twice does
    no harm. ``spark.read.format("binaryFile")`` reads them again for :func:`read_archives`.
    """

    def run(batches):
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = f"{top}/_{path}-{uuid.uuid4().hex}"
                with store.open_output_stream(part, compression=None) as out:
                    out.write(content.as_buffer())
                store.move(part, f"{top}/{path}")
            yield pa.record_batch([pa.array([f"{folder.rstrip('/')}/{p}" for p in batch.column(0).to_pylist()], pa.string())], ["path"])

    return stored(archives.select("path", "content").mapInArrow(run, "path string"))


def read_archives(archives: DataFrame) -> DataFrame:
    """The responses and revisits of ``path, content`` rows. A record that does not hold fails the job with its path and byte.

    ``page_id`` and ``refers_to`` are the numbers in ids of :func:`write_archives`, null for ids of other writers, which
    ``record_id`` and ``refers_to_record`` give as they are.
    """
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("refers_to_record", pa.string())])

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                held, size = [], 0
                try:
                    for record in read_archive(content.as_py()):
                        held.append(record)
                        size += len(record["payload"])
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, kinds)
                            held, size = [], 0
                except ValueError as e:
                    raise ValueError(f"{path.as_py()}: {e}") from e
                yield pa.RecordBatch.from_pylist(held, kinds)

    return archives.select("path", "content").mapInArrow(run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, refers_to_record string")
