"""Token files: exact round trip against the tokenizer itself, the grammar on
its own, random access, and the awkward rows."""

import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.data import SCHEMA, awkward
from shelfwise.llm import repair
from shelfwise.llm.token_files import Shard, WordEncoder, pack_shard, read_token_files, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN, ENCODER = Tokenizer.from_file(PATH), WordEncoder(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=400), st.integers(2, 5), st.integers(1, 9))
def test_grammar_round_trip(ids, min_count, rounds):
    ids = np.array(ids, dtype=np.uint32)
    rules, symbols = repair.compress(ids, 7, min_count=min_count, slack=4, rounds=rounds, batch=3)
    assert repair.expand(symbols, rules, 7).tolist() == ids.tolist()
    assert all(max(pair) < 7 + k for k, pair in enumerate(rules.tolist()))  # rules only name earlier symbols
    lengths = repair.expansion_lengths(rules, 7)
    assert repair.expand(symbols, rules, 7, lengths).tolist() == ids.tolist()
    for k, n in enumerate(lengths.tolist()):
        assert len(repair.expand(np.array([7 + k]), rules, 7)) == n
    for lo, hi in ((0, len(ids)), (len(ids) // 3, len(ids) // 2), (len(ids), len(ids))):
        assert repair.expand_range(symbols, rules, lengths, 7, lo, hi).tolist() == ids[lo:hi].tolist()


def test_grammar_shrinks_repeats_and_runs():
    phrase = np.arange(40, dtype=np.uint32)
    ids = np.concatenate([np.tile(phrase, 200), np.zeros(3000, dtype=np.uint32)])
    rules, symbols = repair.compress(ids, 100)
    lengths = repair.expansion_lengths(rules, 100)
    assert (repair.expand(symbols, rules, 100, lengths) == ids).all()
    assert (repair.expand(symbols[:1], rules, 100, lengths * 0 + (1 << 20)) == repair.expand(symbols[:1], rules, 100)).all()
    assert len(symbols) < len(ids) / 10 and (repair.expand(symbols, rules, 100) == ids).all()


def test_ids_above_16_bits():
    ids = np.tile(np.array([70_000, 5, 69_999], dtype=np.uint32), 100)
    body = pack_shard(np.array([1, 2]), np.array([True, False]), np.array([250, 50]), ids, 70_001)
    shard = Shard(body)
    assert shard.ids().tolist() == ids.tolist()
    assert shard.document(1).tolist() == ids[250:].tolist()
    with pytest.raises(ValueError):
        Shard(b"x" * 80)


def test_word_encoder_equals_whole_texts(monkeypatch):
    plain = Tokenizer.from_file(PATH)
    texts = [r[1] or "" for r in awkward()] + [
        "It's  we'll DON'T x́ é ́a", "a<|endoftext|>b <|startoftext|> <|end oftext|>",
        "ΣΑΣ ας\x1c\x85y\x0b\x0cz", "½ ² 12345 ...!!!\n\n---", "a\x01 \x01 \x01b c\x01d \x02 e", "﻿​ zero‍width", "Ǆ İstanbul ﬁ"]
    for limit in (2_000_000, 50):
        monkeypatch.setattr("shelfwise.llm.token_files._KEPT_WORDS", limit)
        encoder = WordEncoder(PATH)
        for part in (texts[:30], texts[30:], []):
            ids, lengths = encoder(pa.array(part, pa.string()), 1)
            want = [plain.encode(t, add_special_tokens=False).ids + [1] for t in part]
            assert lengths.tolist() == [len(w) for w in want]
            assert ids.tolist() == [i for w in want for i in w]


def test_every_plain_character_encodes_as_in_the_whole_tokenizer():
    plain, encoder = Tokenizer.from_file(PATH), WordEncoder(PATH)
    assert encoder.pieces is not None
    chars = [chr(c) for c in range(0x21, 0x250) if c not in (0x7F, *range(0x80, 0xA1), 0xAD)]
    words = chars + [f"a{c}b" for c in chars] + [f"{c}'{c}1{c}" for c in chars] + ["<|endoftext|>", "x<|endoftext|>'s", "<|a"]
    ids, sizes = encoder._encode(words)
    want = [plain.encode(w, add_special_tokens=False).ids for w in words]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("'stmdrevlSTLL1.<|"), st.characters(
    min_codepoint=0x21, max_codepoint=0x24F, exclude_categories=["Zs", "Cc", "Cf"])), min_size=1, max_size=12), max_size=20))
def test_words_are_cut_as_in_the_whole_tokenizer(words):
    ids, sizes = ENCODER._encode(words)
    want = [PLAIN.encode(w, add_special_tokens=False).ids for w in words]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_words_cost_no_python_calls_of_their_own():
    words = [f"{a}{b}é{c}'s" for a in "bcdfghklmnpr" for b in ("a", "ou", "i", "x") for c in range(100, 300)]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    encoder = WordEncoder(PATH)
    sys.setprofile(count)
    try:
        ids, _ = encoder(pa.array([" ".join(words)]), 1)
    finally:
        sys.setprofile(None)
    assert ids.tolist() == PLAIN.encode(" ".join(words), add_special_tokens=False).ids + [1]
    assert calls < len(words) / 4


def test_pieces_stay_known_within_their_bound(monkeypatch):
    monkeypatch.setattr("shelfwise.llm.token_files._KEPT_PIECES", 40)
    encoder = WordEncoder(PATH)
    for lo in range(0, 200, 20):
        words = [f"{'abcdefghij'[i % 10] * (1 + i // 10)}-{'klmnop'[i % 6]}!" for i in range(lo, lo + 20)]
        ids, _ = encoder(pa.array(words), 1)
        assert ids.tolist() == [i for w in words for i in PLAIN.encode(w, add_special_tokens=False).ids + [1]]
        assert sum(len(k.hashes) for k in encoder.parts.known) <= 40


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=2, max_size=60), st.permutations([(a, b) for a in range(4) for b in range(4)]),
       st.integers(1, 16))
def test_pairs_are_replaced_as_by_a_plain_loop(ids, order, n):
    order, size = [p for p in order if p in zip(ids, ids[1:])][:n], len(ids)
    n = len(order)
    rank = [order.index(p) if p in order else n for p in zip(ids, ids[1:])]
    begin = list(range(size - 1))  # where the run of equal ranks at i begins
    for i in range(1, size - 1):
        if rank[i] == rank[i - 1]:
            begin[i] = begin[i - 1]
    hits = [i for i in range(size - 1) if rank[i] < n and (i - begin[i]) % 2 == 0
            and (i == 0 or rank[i] <= rank[i - 1]) and (i == size - 2 or rank[i] <= rank[i + 1])]
    used = sorted({rank[i] for i in hits})
    want = [4 + used.index(rank[i]) if i in hits else s for i, s in enumerate(ids) if i - 1 not in hits]
    got, live = repair._replaced(np.array(ids, dtype=np.uint32), *np.array(order).T, 4)
    assert got.tolist() == want and np.flatnonzero(live).tolist() == used


def test_files_round_trip(spark, tmp_dir):
    rows = awkward()
    write_token_files(spark.createDataFrame(rows, SCHEMA).repartition(5), f"{tmp_dir}/t", PATH, part_bytes=20_000,
                      shard_bytes=3000)
    assert spark.read.parquet(f"{tmp_dir}/t").groupBy("part").count().count() > 3
    got = read_token_files(spark, f"{tmp_dir}/t", with_ids=True).collect()
    assert len(got) == len(rows)
    got.sort(key=lambda r: r["start"])
    assert [r["id"] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    plain, at, by_id = Tokenizer.from_file(PATH), 0, {}
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        at += r["n_tokens"]
        by_id.setdefault(r["id"], []).append(r["ids"])
    for key, found in by_id.items():
        want = [plain.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows if r[0] == key]
        assert sorted(found) == sorted(want)


def test_no_documents(spark, tmp_dir):
    write_token_files(spark.createDataFrame([], SCHEMA), f"{tmp_dir}/e", PATH)
    assert read_token_files(spark, f"{tmp_dir}/e").collect() == []
