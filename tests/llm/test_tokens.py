"""Word splitting and hashing against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import tokens as tk

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b!9Z日", max_size=30)), max_size=6)


def split(texts, members, lower=False):
    data, offsets = tk.text_bytes(pa.array(texts, pa.string()))
    if lower:
        data = tk.LOWER[data]
    starts, ends, row = tk.words(data, offsets, members)
    body = data.tobytes()
    return [[body[a:b].decode() for a, b, r in zip(starts, ends, row) if r == i] for i in range(len(texts))], (
        data, offsets, starts, ends, row)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words(texts):
    plain, _ = split(texts, tk.NON_SPACE)
    assert plain == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    alnum, _ = split(texts, tk.ALNUM, lower=True)
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    assert alnum == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t) for t in low]


def test_sliced_column():
    column = pa.array(["xx", "a b", None, "c"]).slice(1)
    data, offsets = tk.text_bytes(column)
    assert data.tobytes() == b"a bc" and offsets.tolist() == [0, 3, 3, 4]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "ba", "aa", "é"]), min_size=1, max_size=40), st.integers(1, 4))
def test_equal_hashes_mean_equal_words(words, k):
    _, (data, _, starts, ends, _) = split([" ".join(words)], tk.NON_SPACE)
    h = tk.word_hashes(data, starts, ends)
    assert {(a, b) for a, b in zip(words, h.tolist())} == {
        (w, dict(zip(words, h.tolist()))[w]) for w in set(words)} and len(set(h.tolist())) == len(set(words))
    win = tk.window_hashes(h, k).tolist()
    runs = [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
    assert len(win) == len(runs) and len(set(win)) == len(set(runs)) == len(set(zip(win, runs)))


def test_hashes_do_not_depend_on_blocks():
    rng = np.random.default_rng(1)
    text = " ".join("w%d" % i for i in rng.integers(0, 50, 400_000)) + " " + "x" * (2 * tk.BLOCK) + " tail w1"
    _, (data, _, starts, ends, _) = split([text], tk.NON_SPACE)
    h = tk.word_hashes(data, starts, ends)
    _, (d2, _, s2, e2, _) = split(["w1 w2 tail " + "x" * (2 * tk.BLOCK)], tk.NON_SPACE)
    few = tk.word_hashes(d2, s2, e2)
    words = text.split()
    assert h[words.index("w1")] == few[0] == h[-1] and h[words.index("w2")] == few[1]
    assert h[-2] == few[2] and h[-3] == few[3]
    win = tk.window_hashes(h, 3)
    runs = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    assert len(set(zip(win.tolist(), runs))) == len(set(runs)) == len(set(win.tolist()))


def test_pieces_cover_all_rows():
    offsets = np.array([0, 5, 5, 30, 31, 40])
    parts = list(tk.pieces(offsets, 10))
    assert parts == [(0, 2), (2, 3), (3, 5)] and list(tk.pieces(np.array([0]), 10)) == []
