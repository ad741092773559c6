"""BPE, packing and preference formatting."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.cases import ODD
from parley.llm import bpe as B
from parley.llm import packing as P
from parley.llm import preference as PF

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def automaton():
    return B.Automaton(open(PATH, "rb").read())


def test_automaton_equals_library(library, automaton):
    rnd = random.Random(1)
    parts = list("abc th e'  \n\t \x85\x1c\x1f éñß漢字😀1²½٣_-#|\x00​　") + ["<|endoftext|>", "'s", "'ll", "aaaa", "    ", " the", "of"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(rnd.choice("aeth") for _ in range(200)) for _ in range(50)] + [c * n for c in "ae =-_é" for n in (1, 2, 3, 17, 130, 700)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        got = automaton.encode(t).tolist()
        assert got == want, t
        assert automaton.decode(got) == library.decode(want, skip_special_tokens=False)


def test_every_character_splits_as_in_the_library(library, automaton):
    for c in [*range(0xD800), *range(0xE000, 0x30000, 3)]:
        t = f" a{chr(c)}b {chr(c)}"
        assert automaton.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids, hex(c)


def test_arcs_are_the_pairs_that_stay_apart(library, automaton):
    rnd = random.Random(2)
    ids = [i for i, x in enumerate(automaton.labels) if x is not None and x.isascii() and x.isalpha() and i not in automaton.special.values()]
    for _ in range(5000):
        a, b = rnd.choice(ids), rnd.choice(ids)
        want = library.encode((automaton.labels[a] + automaton.labels[b]).decode(), add_special_tokens=False).ids == [a, b]
        assert automaton._arc(a, b) == want


def test_unsupported_tokenizers_raise():
    with pytest.raises(ValueError):
        B.Automaton(b'{"model": {"type": "WordPiece", "vocab": {}, "merges": []}}')


def test_encode_decode_odd_rows(spark, odd, library):
    enc = B.bpe_encode(odd, PATH)
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in ODD), key=str)
    assert sorted(((r.doc_id, list(r.ids)) for r in enc.collect()), key=str) == want
    back = B.bpe_decode(enc, PATH)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(((i, t or "") for i, t in ODD), key=str)
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256) for r in B.bpe_digests(odd, PATH).collect()}
    assert digests == {(i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for i, x in want}
    assert B.bpe_digests(odd.where("false"), PATH).count() == 0


# ------------------------------------------------------------------ packing
def brute_best(lengths, capacity):
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums if s + x <= capacity}
    return max(sums)


def test_closest_fill_is_optimal():
    rnd = random.Random(3)
    for _ in range(300):
        lengths = [rnd.randint(1, 40) for _ in range(rnd.randint(0, 12))]
        capacity = rnd.randint(1, 100)
        fill = P.closest_fill(dict(Counter(lengths)), capacity)
        assert all(n <= lengths.count(x) for x, n in fill.items())
        assert sum(x * n for x, n in fill.items()) == brute_best(lengths, capacity)


def test_plan_places_every_remainder_once():
    rnd = random.Random(4)
    histogram = {x: rnd.randint(1, 50) for x in rnd.sample(range(1, 2048), 300)}
    slots = P.plan(histogram)
    used: dict = {}
    for length, first, window, offset in zip(slots.length, slots.first, slots.window, slots.offset):
        at = np.flatnonzero((slots.length == length) & (slots.first > first))
        n = (slots.first[at].min() if len(at) else histogram[length]) - first
        for k in range(n):
            used.setdefault(int(window + k), []).append((int(offset), int(length)))
    assert sum(map(len, used.values())) == sum(histogram.values()) and sorted(used) == list(range(slots.windows))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert slots.windows * 2048 - sum(x * n for x, n in histogram.items()) < 0.02 * slots.windows * 2048


def check_pack(rows, packed, library, window):
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), window):
            part = ids[at:at + window]
            want[(i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in packed) == want
    sequences: dict = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences)


@pytest.mark.parametrize("window", [2048, 64])
def test_pack_odd_rows(odd, library, window):
    packed = P.pack(odd, PATH, window).collect()
    check_pack(ODD, packed, library, window)
    assert P.pack(odd.where("false"), PATH, window).count() == 0


def test_pack_documents_with_little_padding(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    packed = P.pack(docs, PATH, with_ids=True).collect()
    n = check_pack(rows, packed, library, 2048)
    assert sum(r.length for r in packed) > 0.95 * 2048 * n
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in packed)


# --------------------------------------------------------------- preferences
TURNS = "pair_id bigint, turn bigint, role string, text string"


def test_preference_pairs(spark):
    c = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "good"),
         (2, 0, "user", "only chosen"), (4, 0, "user", "same"), (4, 1, "assistant", "same"), (None, 0, "user", "x"),
         (5, 0, None, None), (5, 0, "assistant", "tie"), (5, 0, "assistant", "tie")]
    r = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "bad one"),
         (3, 0, "assistant", "only rejected"), (4, 0, "user", "same"), (4, 1, "assistant", "same"), (5, 0, None, None)]
    out = PF.preference_format(spark.createDataFrame(c, TURNS).withColumn("n", F.lit("clash")), spark.createDataFrame(r, TURNS))
    got = {x.pair_id: x for x in out.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert got[1].prompt == "<|user|>\nq<|end|>\n<|assistant|>\na<|end|>\n<|user|>\nr<|end|>\n" and got[1].n_prompt_turns == 3
    for side, mask, text in ((got[1].chosen, got[1].chosen_mask, "good"), (got[1].rejected, got[1].rejected_mask, "bad one")):
        assert [side[m.start:m.end] for m in mask] == [text + "<|end|>\n"]
    assert got[2].rejected == "" and got[2].chosen_mask == [] and got[3].prompt == "" and got[3].chosen == ""
    assert got[4].chosen == got[4].rejected == "" and got[4].n_prompt_turns == 2
    assert got[5].prompt == "<||>\n<|end|>\n" and got[5].chosen.count("tie") == 2 and len(got[5].chosen_mask) == 2
    empty = spark.createDataFrame([], TURNS)
    assert PF.preference_format(empty, empty).count() == 0


def test_preference_query_is_native(spark):
    from parley.llm.queries import QUERIES
    plan = QUERIES["op4_preference_format"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))
