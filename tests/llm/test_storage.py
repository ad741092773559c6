"""WARC archives and sharding."""

import base64
import hashlib
import struct

import duckdb
import pytest
import zstandard

from llm.cases import ODD
from parley.llm import sharding as S
from parley.llm import warc as W
from parley.llm.common import shared_path

PAGES = "page_id bigint, url string, html string, refers_to string, digest int"


def brute(rows):
    top: dict = {}
    for i, _, h in rows:
        h = h or ""
        top[h] = max(top.get(h, -1), -1 if i is None else i)
    out = []
    for i, _, h in rows:
        h = h or ""
        t = None if top[h] < 0 else top[h]
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        out.append((i, len(h.encode()), digest, "response" if i == t else "revisit", None if i == t else t))
    return sorted(out, key=str)


ROWS = [(i, f"http://a/{i}", f"<p>{i % 7} ü</p>") for i in range(300)] + [
    (400, None, None), (401, "u\r\nrl", ""), (None, "n", "<p>1 ü</p>"), (None, "n", "alone without id"), (402, "x", "long " * 40_000),
    (403, "t", "tie"), (403, "t", "tie"), (403, "t", "other"), (1, "again", "<p>1 ü</p>"), (404, "ends", "a\r\n\r\nWARC/1.1\r\n\r\n\x00P*M\x18")]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*r, "clash", 1) for r in ROWS], PAGES)
    path = shared_path(spark, "warc-test")
    W.write_archives(pages, path)
    got = W.read_archives(spark, path, payloads=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(ROWS)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert next(r for r in got if r.page_id == 402).payload.decode() == "long " * 40_000
    # every file is plain Zstandard with one frame for each record, its dictionary first
    for f in spark.read.format("binaryFile").load(path).select("content").collect():
        magic, size = struct.unpack_from("<II", f.content)
        assert magic == W.DICTIONARY_MAGIC and size > 0
        assert all(raw.startswith(b"WARC/1.1\r\n") for raw in W.split_frames(bytes(f.content)))


def test_least_bytes_and_empty_table(spark):
    rows = [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "long enough"), (4, "d", "long enough")]
    pages = spark.createDataFrame([(*r, "", 0) for r in rows], PAGES)
    path = shared_path(spark, "warc-test")
    W.write_archives(pages, path, least=5)
    assert sorted((r.page_id, r.record_type) for r in W.read_archives(spark, path).collect()) == [
        (1, "response"), (2, "response"), (3, "revisit"), (4, "response")]
    path = shared_path(spark, "warc-test")
    W.write_archives(pages.where("false"), path)
    assert W.read_archives(spark, path).count() == 0


def test_faulty_archives_raise():
    raw = W.record(7, "http://a", b"payload", None)
    assert W.parse_record(raw)["payload"] == b"payload"
    for bad in (raw[:-1], raw + b"x", raw.replace(b"payload", b"paylord"), raw.replace(b"WARC/1.1", b"WARC/9.9"),
                raw.replace(b"WARC-Date: ", b"Other: "), raw.replace(b"WARC-Type: ", b"WARC-Type ")):
        with pytest.raises(ValueError):
            W.parse_record(bad)
    frame = zstandard.ZstdCompressor().compress(raw)
    assert list(W.split_frames(frame + W.SEPARATOR + frame)) == [raw, raw] and list(W.split_frames(b"")) == []
    for cut in (frame[:-3], frame + W.SEPARATOR[:-2], struct.pack("<II", W.DICTIONARY_MAGIC, 99) + b"short"):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(W.split_frames(cut))


def brute_shards(rows, limit):
    """Split one bucket after another on the next bit."""
    keyed = [(i, int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16), len((t or "").encode())) for i, t in rows]
    out, todo = [], [("", keyed)]
    while todo:
        prefix, part = todo.pop()
        if sum(n for _, _, n in part) <= limit or len({h for _, h, _ in part}) == 1:
            out += [(i, prefix, len(prefix), n) for i, _, n in part]
            continue
        for bit in "01":
            half = [r for r in part if format(r[1], "060b")[len(prefix)] == bit]
            if half:
                todo.append((prefix + bit, half))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [1, 40, 3000, 60_000, 10**9])
def test_shards_equal_brute_force(odd, frame, limit):
    rows = ODD + [(k, "z" * (k * 37 % 300)) for k in range(100, 400)]
    got = S.shards(frame(rows), limit=limit).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_shards(rows, limit)


def test_shards_of_one_hot_key(frame):
    rows = [(1, "y" * 100)] * 200 + [(k, "y" * 100) for k in range(2, 300)]
    sizes = {r.shard: r for r in S.shard_sizes(S.shards(frame(rows), limit=1000)).collect()}
    over = [r for r in sizes.values() if r.shard_bytes > 1000]
    assert len(over) == 1 and over[0].shard_bytes == 20_000 and sum(r.shard_rows for r in sizes.values()) == len(rows)


def test_shards_empty_and_written(spark, frame):
    df = frame([(k, f"text {k}") for k in range(50)] + [(None, "none")])
    assert S.shards(df.where("false")).count() == 0
    placed = S.shards(df, limit=60)
    path = shared_path(spark, "shards-test")
    S.write_shards(df, placed, path)
    back = spark.read.option("basePath", path).parquet(path)
    assert sorted(((r.doc_id, r.shard[1:]) for r in back.select("doc_id", "shard").collect()), key=str) == \
        sorted(((r.doc_id, r.shard) for r in placed.collect()), key=str)


def test_oracle_of_small_shards(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(sf + "/documents.parquet")
    placed = S.shards(docs, limit=5000)
    got = placed.join(S.shard_sizes(placed), "shard").select("doc_id", "shard", "depth", "bytes", "shard_rows", "shard_bytes").collect()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert sorted(map(tuple, got)) == sorted(con.execute(S.oracle(5000)).fetchall())


def foreign(kind, record_id, block, *more, content="application/http;msgtype=response"):
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", "WARC-Date: 2020-02-02T02:02:02Z", f"Content-Type: {content}",
            f"content-length:{len(block)}", *more]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def hand_made(compressed_dictionary):
    """An archive as other tools write it: ids of their own, other record types, other digests, folded lines."""
    page = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: 5\r\n\r\nhello"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Length: 99\r\n\r\n5\r\nhello\r\n0\r\n\r\n"
    sha1 = base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
    records = [foreign("warcinfo", "<urn:uuid:1>", b"software: x\r\n", content="application/warc-fields"),
               foreign("response", "<urn:uuid:2>", page, "WARC-Target-URI: http://a/", f"WARC-Payload-Digest: sha1:{sha1}"),
               foreign("response", "<urn:uuid:3>", page, "X-Folded: one", "  two", f"WARC-Payload-Digest: sha256:{hashlib.sha256(b'hello').hexdigest()}"),
               foreign("response", "<urn:uuid:4>", chunked, "WARC-Payload-Digest: blake9:zzz"),
               foreign("revisit", "<urn:uuid:5>", b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\n", "WARC-Refers-To: <urn:uuid:2>", f"WARC-Payload-Digest: sha1:{sha1}"),
               foreign("resource", "<urn:page:x>", b"\x00\xff" * 3, content="image/png"), foreign("metadata", "<urn:uuid:7>", b"")]
    words = b"".join(records) * 20
    dictionary = zstandard.train_dictionary(2048, [words[i:i + 200] for i in range(0, len(words) - 200, 50)]).as_bytes()
    content = zstandard.ZstdCompressor().compress(dictionary) if compressed_dictionary else dictionary
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    skip = struct.pack("<II", 0x184D2A53, 4) + b"skip"
    return struct.pack("<II", W.DICTIONARY_MAGIC, len(content)) + content + skip.join(pack.compress(r) for r in records) + skip


@pytest.mark.parametrize("compressed_dictionary", [False, True])
def test_archives_of_other_writers(spark, tmp_path, monkeypatch, compressed_dictionary):
    (tmp_path / "a.warc.zst").write_bytes(hand_made(compressed_dictionary))
    got = {r.record_id: r for r in W.read_archives(spark, str(tmp_path), payloads=True).collect()}
    assert [got[f"urn:uuid:{i}"].record_type for i in (1, 2, 3, 4, 5, 7)] == ["warcinfo", "response", "response", "response", "revisit", "metadata"]
    assert all(r.page_id is None and r.refers_to is None for r in got.values()) and len(got) == 7
    assert got["urn:uuid:2"].payload == got["urn:uuid:3"].payload == b"hello" and got["urn:uuid:4"].payload == b"5\r\nhello\r\n0\r\n\r\n"
    r = got["urn:uuid:5"]
    assert (r.payload, r.payload_bytes, r.refers_to_record, r.payload_digest) == (None, 5, "urn:uuid:2", got["urn:uuid:2"].payload_digest)
    assert got["urn:page:x"].payload == b"\x00\xff" * 3 and got["urn:uuid:7"].payload == b"" and got["urn:uuid:1"].payload_bytes == 13
    monkeypatch.setattr(W, "BLOCK", 7)                        # frames and heads that cross blocks
    with open(tmp_path / "a.warc.zst", "rb") as f:
        assert [W.parse_record(x)["record_id"] for x in W.split_frames(f)] == list(got)
    for cut in (5, 700, len(hand_made(False)) - 6):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(W.split_frames(hand_made(False)[:cut]))


def test_foreign_records_that_are_wrong():
    page = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhello"
    for record, what in ((foreign("response", "<a>", page[:-1]), "length"), (foreign("response", "<a>", page, "WARC-Payload-Digest: md5:00"), "payload digest"),
                         (foreign("response", "<a>", page, "WARC-Block-Digest: sha1:AAAA"), "block digest"), (foreign("x", "<a>", b"", "no colon"), "header"),
                         (foreign("x", "<a>", b"ab").replace(b"content-length:2", b"content-length:-2"), "number")):
        with pytest.raises(ValueError, match=what):
            W.parse_record(record)


@pytest.mark.parametrize("key", ["h", "cell", "prefix", "of", "key", "fits"])
def test_shards_by_a_key_of_any_name(frame, key):
    docs = frame([(i, "t" * (i % 9)) for i in range(60)] + [(None, None)])
    got = S.shards(docs.withColumnRenamed("doc_id", key), key=key, limit=40).collect()
    want = {r["doc_id"]: (r["shard"], r["bytes"]) for r in S.shards(docs, limit=40).collect()}
    assert {r[key]: (r["shard"], r["bytes"]) for r in got} == want and len({r["shard"] for r in got}) > 3
