"""Byte-pair encoding by a tokenisation automaton.

The automaton reads tokens; its accepted paths are exactly the tokenisations that
the merge list yields (Berglund, Martens, van der Merwe 2024).  It starts with one
state and an arc for each byte.  Merges are then applied in order, each by one
gadget: for merge ``k`` of ``u v`` into ``w``, the state that ``u`` arcs lead to is
copied without its ``v`` arc, ``u`` arcs lead to the copy, and wherever a ``u`` arc
starts, a ``w`` arc now leads where ``v`` led.  So the state is fixed by the last
token, and it is kept as what gadgets changed: the step at which arc ``v`` left the
state of ``u``, and for each ``w`` the arcs that it runs beside and its step.  An
arc is looked up in those tables once, then stands in the transition table.

A pre-split word is encoded along the arcs: longest token first, a shorter one
where the table has no arc, one step back where no token is left.  A prefix of a
word has just one path, so a position found dead stays dead.  Decoding emits the
labels (bytes) of the arcs.
"""

from __future__ import annotations

import hashlib
import json
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pre-split of byte-level vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-split words, and texts between two spaces, that a worker keeps encoded in each of two generations.
KEPT_WORDS, KEPT_CHUNKS = 120_000, 200_000
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Compiled from the JSON of a byte-level BPE tokenizer."""

    def __init__(self, spec: bytes):
        data = json.loads(spec)
        model, pre = data["model"], data.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        if model["type"] != "BPE" or odd or model.get("ignore_merges") or data.get("normalizer") \
                or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only plain byte-level BPE is supported")
        letters = byte_letters()
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        if any(t.get(k) for t in data.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only plain added tokens are supported")
        # Labels; None where an id is unused.
        self.labels: list = [None] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            if token not in self.special:
                self.labels[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.labels[i] = token.encode()
        # Gadgets: w runs beside u and v from its step on; v leaves the state of u at that step.
        n = len(self.labels)
        self.left, self.right, self.step = [-1] * n, [-1] * n, [-1] * n
        self.leaves: dict[tuple[int, int], int] = {}
        for k, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            self.leaves.setdefault((u, v), k)
            if self.step[w] < 0:
                self.left[w], self.right[w], self.step[w] = u, v, k
        # A trie over the labels that arcs carry (bytes and merged tokens).
        self.go: dict[int, int] = {}
        self.token_at = [-1]
        for token, i in vocab.items():
            if token in self.special or (len(self.labels[i]) > 1 and self.step[i] < 0):
                continue
            node = 0
            for byte in self.labels[i]:
                node = self.go.setdefault(node << 8 | byte, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[node] = i
        self.sizes = [len(x or b"") for x in self.labels]
        self.longest = max(self.sizes)
        self.arcs: dict[int, bool] = {}
        self.split = regex.compile(PATTERN)
        self.mark = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.blank = regex.compile(r" (?:\s|$)").search
        self.words = Kept(lambda w: array("I", self.word(w.encode())).tobytes(), KEPT_WORDS)
        self.chunks = Kept(lambda c: self.chunk(" " + c), KEPT_CHUNKS)

    def _arc(self, a: int, b: int) -> bool:
        """Whether the finished automaton has an arc ``b`` from the state of ``a``.

        Goes back through the gadgets: the younger of the two got its arcs from the
        right part of ``a`` or beside the left part of ``b``, as they were at its step.
        """
        before = NEVER
        while True:
            if self.leaves.get((a, b), NEVER) < before:
                return False
            if self.step[a] > self.step[b]:
                before, a = self.step[a], self.right[a]
            elif self.step[b] >= 0:
                # Of three equal tokens the first two merge, so the arc left at that very step.
                before, b = self.step[b] + 1, self.left[b]
            else:
                return True

    def word(self, word: bytes) -> list[int]:
        """The accepted path that spells ``word``: each position's tokens, longest first, along arcs of the table."""
        go, token_at, size, arcs = self.go, self.token_at, self.sizes, self.arcs
        if len(arcs) > 2_000_000:
            arcs.clear()
        at, end, last, path, choices, dead = 0, len(word), -1, [], [], set()
        while True:
            node, options = 0, []
            for byte in word[at:at + self.longest]:
                node = go.get(node << 8 | byte)
                if node is None:
                    break
                if token_at[node] >= 0:
                    options.append(token_at[node])
            while True:
                while options:
                    t = options.pop()
                    if last < 0:
                        ok = True
                    else:
                        ok = arcs.get(last << 20 | t)
                        if ok is None:
                            ok = arcs[last << 20 | t] = self._arc(last, t)
                    if ok and at + size[t] not in dead:
                        break
                else:
                    dead.add(at)
                    at -= size[path.pop()]
                    last = path[-1] if path else -1
                    options = choices.pop()
                    continue
                break
            path.append(t)
            at += size[t]
            if at == end:
                return path
            choices.append(options)
            last = t

    def _plain(self, text: str) -> bytes:
        """Ids of a text without added tokens, packed."""
        if not text:
            return b""
        if self.blank(text) is None:  # a space before a word always starts a word of the pre-split
            head, *rest = text.split(" ")
            return self.chunk(head) + b"".join(map(self.chunks.__getitem__, rest))
        return self.chunk(text)

    def chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split.findall(chunk)))

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text; added tokens are found first, as plain strings."""
        out, at = [], 0
        if self.special and any(t in text for t in self.special):
            for m in self.mark.finditer(text):
                out += [self._plain(text[at:m.start()]), np.uint32(self.special[m[0]]).tobytes()]
                at = m.end()
        out.append(self._plain(text[at:]))
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


class Kept(dict):
    """String -> its ids as little-endian bytes; the older generation goes when the younger is full."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) < 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


_COMPILED: dict[str, Automaton] = {}


def compiled(spec: bytes) -> Automaton:
    """The automaton of a tokenizer file, compiled once for each worker."""
    key = hashlib.sha256(spec).hexdigest()
    if key not in _COMPILED:
        _COMPILED[key] = Automaton(spec)
    return _COMPILED[key]


def load_spec(spark: SparkSession, path: str):
    """The tokenizer file (a few MB, fixed) as a broadcast; only the driver needs the path."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _ids_column(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate([np.zeros(0, "<u4"), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _parts(batches, text_limit: int = 32 << 20):
    """Batches cut to about ``text_limit`` bytes each."""
    for batch in batches:
        pieces = max(1, min(batch.num_rows, batch.nbytes // text_limit + 1))
        size = -(-batch.num_rows // pieces) or 1
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def encode_batches(spec):
    """``(doc_id, text)`` batches -> ``(doc_id, ids)``."""
    def run(batches):
        auto = compiled(spec.value)
        for batch in _parts(batches):
            ids = [auto.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _ids_column(ids)], names=["doc_id", "ids"])
    return run


def _lists(column: pa.ListArray) -> list[list[int]]:
    """The ids of each row (null: none)."""
    values, off = column.values.to_numpy(), column.offsets.to_numpy()
    return [[] if null else values[a:b].tolist()
            for a, b, null in zip(off, off[1:], column.is_null().to_pylist())]


def decode_batches(spec):
    """``(doc_id, ids)`` batches -> ``(doc_id, ids, text)``."""
    def run(batches):
        auto = compiled(spec.value)
        for batch in batches:
            text = [auto.decode(ids) for ids in _lists(batch.column(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(text, pa.string())],
                                             names=["doc_id", "ids", "text"])
    return run


def digest_batches(batches):
    """``(doc_id, ids, text)`` batches -> number of ids and digests of both."""
    names: dict[int, str] = {}
    for batch in batches:
        rows = []
        for ids, text in zip(_lists(batch.column(1)), batch.column(2).to_pylist()):
            names.update((i, str(i)) for i in set(ids).difference(names))
            rows.append((len(ids), hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string())))],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` of every whole text with the byte-level BPE file at ``path``.

    Equals the tokenizers library with ``add_special_tokens=False``, without
    truncation or padding: added tokens in a text give their own id.  A null text is
    empty and gives no ids; a null ``doc_id`` stays null; repeated rows repeat; other
    columns are ignored; an empty table gives an empty result.
    """
    spec = load_spec(docs.sparkSession, path)
    return _source(docs).mapInArrow(encode_batches(spec), "doc_id bigint, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: labels of the ids, special tokens included (null ids give the empty text)."""
    spec = load_spec(encoded.sparkSession, path)
    return encoded.select("doc_id", "ids").mapInArrow(decode_batches(spec), "doc_id bigint, ids array<int>, text string")


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """Encoding, decoding and digests of both in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    spec = load_spec(docs.sparkSession, path)
    encode, decode = encode_batches(spec), decode_batches(spec)
    return _source(docs).mapInArrow(lambda batches: digest_batches(decode(encode(batches))),
                                    "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
