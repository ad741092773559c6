"""WARC archives in Zstandard: one frame for each record, the dictionary in a leading skippable frame.

Spark writes and reads the files, through whatever file system the path names: a
task's records are rows of bytes for the ``text`` sink, whose line separator is an
empty skippable frame, so that every file is a valid Zstandard file.  The reader
takes files whole (``binaryFile``), loads the dictionary from the first frame,
decodes frame by frame, and checks each record's headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_bytes

#: Frames that decoders skip: the dictionary's and the separator's (fixed values of the formats).
DICTIONARY_MAGIC, SEPARATOR = 0x184D2A5D, b"P*M\x18\x00\x00\x00\x00"
#: Pages and bytes of each that the dictionary is trained on, and its size.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 500, 16 << 10, 32 << 10
DATE = "1970-01-01T00:00:00Z"
LEAST = 0
#: How a Zstandard frame starts, labelled digests that are checked (fixed values of the formats); bytes read at once.
ZSTANDARD_MAGIC, DIGESTS = b"\x28\xb5\x2f\xfd", ("sha1", "sha256", "md5")
BLOCK = 256 << 10


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def record(page_id, url: str, payload: bytes, refers_to) -> bytes:
    """One WARC/1.1 record; with ``refers_to`` a revisit that holds the HTTP head only."""
    digest = payload_digest(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url))
    if refers_to is None:
        block += payload
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{payload_digest(block)}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of payloads (raw bytes of the fixed heads where there is too little)."""
    # Pages are picked by the hashes of their keys; only the picked pages' texts are sent.
    keyed = pages.where("html is not null").withColumn("__h", F.xxhash64("page_id", "url"))
    picked = keyed.select("__h").orderBy("__h").limit(SAMPLE_PAGES).distinct()
    rows = (keyed.join(F.broadcast(picked), "__h").select("__h", F.substring(F.col("html"), 1, SAMPLE_BYTES).alias("html"))
            .orderBy("__h", "html").limit(SAMPLE_PAGES).select("html").collect())
    samples = [record(i, "http://example.org/", r["html"].encode(), None) for i, r in enumerate(rows)]
    if len(samples) >= 100:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too little or too uniform a sample
            pass
    return record(0, "http://example.org/", b"", None)


def _frames(dictionary: bytes):
    """``(page_id, url, html, refers_to)`` batches -> frames of one archive, the dictionary's first."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True)
        first = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary
        for batch in batches:
            out = [first] if first and batch.num_rows else []
            for i, url, html, ref in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         text_bytes(batch.column(2)), batch.column(3).to_pylist()):
                out.append(pack.compress(record(i, url or "", html, ref)))
            if batch.num_rows:
                first = b""
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
    return run


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id, url, html, refers_to``: of equal payloads of ``least`` bytes or more, all but the largest page_id refer to it.

    Payloads are told apart by SHA-1 and length.  The largest id of a payload is found
    without its text; only then do the pages meet it, by page and digest.
    """
    page = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = page.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    narrow = keyed.select("page_id", "digest", F.octet_length("html").alias("n"))
    largest = narrow.where(F.col("n") >= least).groupBy("digest", "n").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    refer = (narrow.join(largest, ["digest", "n"]).where("not page_id <=> top")
             .select(F.col("page_id").alias("from_id"), F.col("digest").alias("from_digest"), "top").distinct())
    same = F.col("page_id").eqNullSafe(F.col("from_id")) & (F.col("digest") == F.col("from_digest"))
    return keyed.join(refer, same, "left").select("page_id", "url", "html", F.col("top").alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST) -> None:
    """Write a record for each page under ``path``, a file for each task of the join that finds revisits.

    Adaptive execution sizes those tasks (``advisoryPartitionSizeInBytes``), which
    bounds the files, and splits a key that holds very many rows.

    Columns ``page_id, url, html``; null html is an empty payload, a null url leaves the
    target out, a null page_id never is what others refer to unless all equal pages
    have none.  Equal payloads under the same largest page_id are all responses.
    Other columns are ignored; an empty table writes no records.
    """
    dictionary = train_dictionary(pages)
    frames = revisits(pages, least).mapInArrow(_frames(dictionary), "frame binary").select(F.col("frame").cast("string").alias("value"))
    frames.write.option("lineSep", SEPARATOR.decode()).option("compression", "none").text(path)


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    """A dictionary as the leading frame holds it: as it is, or as a Zstandard frame of its own."""
    if content[:4] == ZSTANDARD_MAGIC:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return zstandard.ZstdCompressionDict(content)


def split_frames(data):
    """Decoded frames of an archive (bytes or a binary file), one at a time; the leading skippable frame gives the dictionary.

    A file is read in blocks, so no more than a block and one frame is held.
    """
    source = io.BytesIO(data) if isinstance(data, (bytes, bytearray, memoryview)) else data
    unpack, held, first = zstandard.ZstdDecompressor(), b"", True

    def upto(n):
        nonlocal held
        while len(held) < n:
            more = source.read(max(BLOCK, n - len(held)))
            if not more:
                return False
            held += more
        return True

    while upto(1):
        if upto(8) and struct.unpack_from("<I", held)[0] >> 4 == 0x184D2A5:
            magic, size = struct.unpack_from("<II", held)
            if not upto(8 + size):
                raise ValueError("a skippable frame is cut off")
            if first and magic == DICTIONARY_MAGIC:
                unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(held[8:8 + size]))
            held, first = held[8 + size:], False
            continue
        first = False
        one, out = unpack.decompressobj(), []
        while not one.eof:
            if not upto(1):
                raise ValueError("a frame is cut off")
            out.append(one.decompress(held))
            held = one.unused_data if one.eof else b""
        yield b"".join(out)


def _page(urn: str) -> int | None:
    """The page_id in a record id that ``write_archives`` made; null for any other id."""
    found = re.fullmatch(r"<?urn:page:(-?[0-9]+):[A-Z2-7]*>?", urn)
    return int(found[1]) if found else None


def _fields(lines) -> dict[str, str]:
    """Named fields of a header by lower-case name; a line that starts with white space goes on with the one before."""
    out, last = {}, None
    for line in lines:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line {line!r}")
        last = name.strip().lower()
        out[last] = value.strip()
    return out


def _checked(digest: str, data: bytes, what: str) -> None:
    """Raise if a labelled digest isn't that of ``data``; labels that aren't known say nothing."""
    label, _, value = digest.partition(":")
    if label.lower() not in DIGESTS or not value:
        return
    raw = hashlib.new(label.lower(), data).digest()
    if value.upper().rstrip("=") not in (base64.b32encode(raw).decode().rstrip("="), raw.hex().upper()):
        raise ValueError(f"wrong {what} digest")


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one record of any type, checked; a ValueError says what is wrong.

    The payload of an HTTP message is what follows its head, that of any other block the
    block.  A revisit has the digest and the length that its head names.
    """
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a WARC record")
    fields = _fields(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isdecimal():
        raise ValueError("Content-Length isn't a number")
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the block's length differs from Content-Length")
    block, kind = rest[:size], fields["warc-type"]
    _checked(fields.get("warc-block-digest", ""), block, "block")
    payload, length = block, size
    if fields.get("content-type", "").replace(" ", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        message = _fields(line.decode("utf-8", "replace") for line in http.split(b"\r\n")[1:] if b":" in line)
        told = message.get("content-length", "")
        length = int(told) if told.isdecimal() and "transfer-encoding" not in message else len(payload)
    digest = fields.get("warc-payload-digest", "")
    if kind != "revisit":
        if len(payload) != length:
            raise ValueError("the payload's length differs from that of its message")
        _checked(digest, payload, "payload")
        digest = digest or "sha1:" + payload_digest(payload)
    return {"page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": length, "payload_digest": digest.removeprefix("sha1:"), "refers_to": _page(fields.get("warc-refers-to", "")),
            "record_id": fields["warc-record-id"].strip("<>"),
            "refers_to_record": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "payload": payload if kind != "revisit" else None}


RECORDS = ("page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, "
           "record_id string, refers_to_record string")
_KINDS = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(),
          "payload_digest": pa.string(), "refers_to": pa.int64(), "record_id": pa.string(), "refers_to_record": pa.string(), "payload": pa.binary()}


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row for each record of the archives under ``path`` (``payload`` too if asked for).

    Archives may be of any writer: ``page_id`` and ``refers_to`` are null for record ids that
    ``write_archives`` didn't make (``record_id, refers_to_record`` have the ids as they
    stand), and records that hold no page (``warcinfo`` and others) are rows too.  A file that
    is cut off, or a record with a wrong header, length or digest, raises.  A file is one
    value of Spark's ``binaryFile`` source, so it must be below 2 GB.
    """
    names = [x.split()[0] for x in RECORDS.split(", ")] + ["payload"] * payloads

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], _KINDS[n]) for n in names], names=names)

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows, held = [], 0
                for raw in split_frames(data):
                    rows.append(parse_record(raw))
                    held += len(raw)
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path)
    return files.select("content").mapInArrow(run, RECORDS + ", payload binary" * payloads)
