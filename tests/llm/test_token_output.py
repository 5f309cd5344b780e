"""Token ids: equal to the tokenizer's, exact round trips, checkpoints, damaged blocks."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitalflow.llm import token_output as t

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["The Cat's toy, isn't it?", "é É ÀÉ École.", "a,b..c  d!.", "x" * 300, "tab\there\x0b\x0cnl\n\r\x85nbsp\xa0end", "<|endoftext|> x",
         "ﬁ Å Å ǆ Σς", "日本語 текст 123 4.5", "", " ", "😀👍🏽 ok", "don't'll 's s'", "áè.", "ÿ ß ÷ ×", "İ İ", "​ zero​width"]


FRESH = Tokenizer.from_file(PATH)


def whole(text):
    return FRESH.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_words_give_the_tokenizers_ids(text):
    assert np.frombuffer(t.words(PATH).ids(text), "<u4").tolist() == whole(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F) | st.characters(exclude_categories=["Cs"]), max_size=60))
def test_random_texts(text):
    assert np.frombuffer(t.words(PATH).ids(text), "<u4").tolist() == whole(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50000), max_size=400), st.integers(1, 40), st.integers(1, 9))
def test_round_trip(ids, lanes, every):
    ids = np.array(ids, np.uint32)
    values, counts = np.unique(ids, return_counts=True)
    freq = t.Frequencies(values, counts)
    place, slots, _ = freq.tables()
    block = t.encode(ids, freq, place, lanes, every)
    assert (t.decode(block, freq, slots) == ids).all()
    n, lanes, _, marks = np.frombuffer(block, "<u4", 4, 4)
    for m in range(1, marks + 1):  # from any checkpoint on
        assert (t.decode(block, freq, slots, m) == ids[m * every * lanes:]).all()


def test_damage_is_noticed():
    ids = np.arange(3000, dtype=np.uint32) % 97
    freq = t.Frequencies(*np.unique(ids, return_counts=True))
    place, slots, _ = freq.tables()
    block = bytearray(t.encode(ids, freq, place, 16))
    for bad in (bytes(block[:-4]), b"XXXX" + bytes(block[4:]), bytes(block[:-40]) + bytes([block[-40] ^ 1]) + bytes(block[-39:])):
        with pytest.raises(ValueError):
            t.decode(bad, freq, slots)


def test_frequencies_fill_the_range():
    for counts in ([1], [10**9, 1, 1], [1] * 70000, [3, 5, 7]):
        f = t.Frequencies(np.arange(len(counts)), np.array(counts))
        assert int(f.f.sum()) == 1 << f.bits and (f.f > 0).all()


def test_files_read_back(spark, docs_of, monkeypatch):
    monkeypatch.setattr(t, "BLOCK_IDS", 50)
    rows = [(i * 5 % 211, f"Document {i}: " + " ".join(f"w{j * i % 50}" for j in range(i % 60))) for i in range(150)]
    rows += [(500 + i, x) for i, x in enumerate(TEXTS)] + [(900, None)]
    got = {r["doc_id"]: r for r in t.query(docs_of(rows), PATH).collect()}
    start = 0
    for i, text in sorted((i, x or "") for i, x in rows):
        ids = whole(text) + [2]
        assert (got[i]["start"], got[i]["n_tokens"]) == (start, len(ids))
        assert got[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_odd_rows(odd):
    docs = odd()
    got = t.query(docs, PATH).collect()
    assert len(got) == 11 and sum(r["n_tokens"] for r in got) == max(r["start"] + r["n_tokens"] for r in got)
    assert t.query(docs.limit(0), PATH).count() == 0


SPECIAL = ["one <|endoftext|> two", "one<|endoftext|>two", "<|ENDOFTEXT|> <|endoftext|>", "a<|startoftext|><|endoftext|>B c",
           "a <|endoftext|>\xa0b", "x<|endoftext|", "<|<|endoftext|>|>", "don<|endoftext|>'t", "e<|endoftext|>\u0301a", "<|endoftext|>"]


def fresh(text):
    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_special_strings_as_in_a_fresh_tokenizer():
    for text in [*SPECIAL, *TEXTS]:
        assert np.frombuffer(t.words(PATH).ids(text), "<u4").tolist() == fresh(text), text
    assert fresh(SPECIAL[0]) == [637, 49407, 1237]


def test_special_strings_in_files(spark, docs_of):
    got = {r["doc_id"]: r for r in t.query(docs_of(list(enumerate(SPECIAL))), PATH).collect()}
    start = 0
    for i, text in enumerate(SPECIAL):
        ids = fresh(text) + [2]
        assert (got[i]["start"], got[i]["n_tokens"]) == (start, len(ids))
        assert got[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|", "|>", "endoftext", "A", "b.", " ", "'s", "\u0301"]), max_size=12))
def test_random_texts_with_special_strings(parts):
    text = "".join(parts)
    assert np.frombuffer(t.words(PATH).ids(text), "<u4").tolist() == whole(text)


def test_full_block_has_checkpoints_that_are_used():
    rng = np.random.default_rng(2)
    ids = rng.zipf(1.3, t.BLOCK_IDS + 300).clip(0, 49000).astype(np.uint32)
    freq = t.Frequencies(*np.unique(ids, return_counts=True))
    place, slots, _ = freq.tables()
    block = bytearray(t.encode(ids, freq, place))
    n, lanes, words, marks = np.frombuffer(block, "<u4", 4, 4)
    assert marks == 16 and (t.decode(bytes(block), freq, slots) == ids).all()
    assert (t.decode(bytes(block), freq, slots, 9) == ids[9 * t.EVERY * t.LANES:]).all()
    at = 20 + 8 * lanes + 5 * (8 + 8 * lanes) + 8   # a state in the sixth checkpoint
    block[at] ^= 1
    with pytest.raises(ValueError):
        t.decode(bytes(block), freq, slots)


def test_files_alone_are_enough(spark, docs_of):
    """Another session reads them back from the folder; documents without an id are dealt over the tasks."""
    path = t.write_blocks(docs_of([(None, f"text {i}") for i in range(400)] + [(7, "seven")]), PATH)
    other = spark.newSession()
    got = t.read_blocks(other, path).collect()
    assert len(got) == 401 and sum(r["doc_id"] is None for r in got) == 400
    want = sorted(np.array(whole(x) + [2], "<u4").tobytes() for x in [f"text {i}" for i in range(400)] + ["seven"])
    assert sorted(bytes(r["ids"]) for r in got) == want
    blocks = other.read.parquet(f"{path}/blocks")
    assert blocks.groupBy("range").agg(F.count(F.lit(1))).count() > 2


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(t.Words, "MOST", 5)
    w = t.Words(PATH)
    for text in TEXTS * 2:
        assert np.frombuffer(w.ids(text), "<u4").tolist() == whole(text)
    assert len(w) <= 5


RUNS = ["good###", "good.,%%%", "Good&&&", "good", "l'été!!", "été!!", "été_-_", "x»", "x».", "x…!", "5!!", "good<|", "<|good|>", "s'", "'s'", "≠=", "good≠"]


def test_punctuation_after_a_word_takes_no_whole_tokenizer(monkeypatch):
    """A word with a run of any ASCII punctuation goes through the model; the run through the whole tokenizer, once."""
    w, seen, plain = t.Words(PATH), [], t.Words._whole
    monkeypatch.setattr(t.Words, "_whole", lambda self, word: seen.append(word) or plain(self, word))
    for text in ["good### bad### été### ou*** good***", "bad good été"]:
        assert np.frombuffer(w.ids(text), "<u4").tolist() == whole(text)
    assert seen == [b"###", b"***"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([*RUNS, "#", ".", "'", "é", "́", " "]), max_size=9), st.booleans())
def test_remembered_words_with_punctuation(parts, spaced):
    w, text = t.Words(PATH), (" " if spaced else "").join(parts)
    for _ in range(2):
        assert np.frombuffer(w.ids(text), "<u4").tolist() == whole(text)


def test_query_hands_no_ids_to_spark(spark, docs_of):
    """The query returns checksums of the ids, so the ids themselves stay in Python; the operator still gives them."""
    docs = docs_of([(1, "one two"), (2, None)])
    out = t.query(docs, PATH)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert "ids#" not in out._jdf.queryExecution().analyzed().toString()
    full = t.read_blocks(spark, t.write_blocks(docs, PATH))
    assert full.columns == [*out.columns, "ids"]
    assert sorted(map(tuple, full.drop("ids").collect())) == sorted(map(tuple, out.collect()))
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in full.collect())
