import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from zonemill.llm.packing import Example, Limits, Packer, TextIds, pack_texts

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
IDS = TextIds(PATH, 2)
SCHEMA = "doc_id long, text string, length string"


def plain(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aAbÉé'sS \t \x1ćİΣß12½,.!-_<|>漢😀ẞǅ")) | st.text())
def test_ids_are_those_of_the_whole_text(text):
    assert IDS.of(text) == plain(text)


def test_special_strings_and_long_words():
    for text in ["<|endoftext|> a", "<|ENDOFTEXT|>x", "don't I'LL", "x" * 3000, "ab " * 5000, ""]:
        assert IDS.of(text) == plain(text)


def packed(sizes, limits, loss_from=0, window=8):
    packer, examples, out = Packer(limits, 5, window), [], []
    for i, n in enumerate(sizes):
        examples.append(Example(i, bytes(4 * n), min(loss_from, n)))
        out += [(p[0].doc_id, *p[1:]) for p in packer.add(examples[-1])]
    return out + [(p[0].doc_id, *p[1:]) for p in packer.finish()]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.integers(1, 40), st.integers(1, 6), st.integers(1, 40), st.integers(0, 30))
def test_every_id_once_and_no_limit_passed(sizes, tokens, segments, loss, loss_from):
    out = packed(sizes, Limits(tokens, segments, loss), loss_from)
    for i, n in enumerate(sizes):
        at = 0
        for doc, start, length, *_ in sorted(p for p in out if p[0] == i):
            assert start == at and length > 0
            at += length
        assert at == n
    for sequence in {p[3] for p in out}:
        pieces = sorted((p for p in out if p[3] == sequence), key=lambda p: p[4])
        assert [p[4] for p in pieces] == [sum(p[2] for p in pieces[:k]) for k in range(len(pieces))]
        assert sum(p[2] for p in pieces) <= tokens and len(pieces) <= segments
        borne = [max(0, start + length - max(start, min(loss_from, sizes[doc]))) for doc, start, length, *_ in pieces]
        assert borne == [p[5] for p in pieces] and sum(borne) <= loss


def test_little_padding():
    sizes = np.random.default_rng(1).integers(1, 3000, 400).tolist()
    out = packed(sizes, Limits(), window=64)
    filled = {}
    for p in out:
        filled[p[3]] = filled.get(p[3], 0) + p[2]
    assert all(n == 4096 or n & (n - 1) == 0 for n in filled.values())
    assert sum(n != 4096 for n in filled.values()) <= 12


def test_pieces_of_texts(spark):
    texts = {1: None, 2: "", 3: "Some words, here.", 4: "word " * 9000, None: "no id"}
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(3, "Some words, here.", "again")], SCHEMA)
    rows = pack_texts(df, PATH).collect()
    for i, text in texts.items():
        ids, pieces = plain(text), sorted((r for r in rows if r["doc_id"] == i), key=lambda r: (r["start"], r["sequence_id"], r["offset"]))
        assert all(zlib.crc32(ids[4 * r["start"] : 4 * (r["start"] + r["length"])]) == r["ids_crc32"] for r in pieces)
        assert sum(r["length"] for r in pieces) == len(ids) // 4 * (2 if i == 3 else 1)
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert pack_texts(df.limit(0), PATH).count() == 0
