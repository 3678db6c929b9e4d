"""Phrase collocations: against plain counting, the transducers on their own,
and awkward texts."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm.data import SCHEMA, awkward
from shelfwise.llm.automata import Counts
from shelfwise.llm.collocations import collocations, phrase_counts, shard_parts


def plain_counts(rows, longest=5):
    """lang -> phrase (tuple) -> occurrences."""
    out = {}
    for text, lang in rows:
        f = out.setdefault("und" if lang is None else lang, Counter())
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words)):
                for m in range(1, min(longest, len(words) - i) + 1):
                    f[tuple(words[i:i + m])] += 1
    return out


def plain(rows, longest=5, least=100, share=100, top=2000):
    out = []
    for lang, f in plain_counts(rows, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in found.items()):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], n, score))
        kept.sort()
        out += [(lang, i + 1, r[2].decode(), *r[3:]) for i, r in enumerate(kept[:top])]
    return sorted(out)


def corpus(seed=9, n=120):
    rng = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "état", "日本", "x-1", "a"] + [f"w{i}" for i in range(12)]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 40)):
            text += rng.choice([rng.choice(words), "new York  city", "of the", "of the\tstate"]) + rng.choice([" "] * 9 + [", ", ".\n", "!", "\r", "\x0b"])
        rows.append((text, rng.choice(["en", "fr", None])))
    rows += [("the the the the the the the the", "en")] * 5 + [(None, "en"), ("", None), (" ., \t", "de"), ("New York city", "fr")]
    rows += [("one two", "en\t"), ("", "zz")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(t, l, "x", "y", "z") for t, l in rows], "text string, lang string, phrase string, f string, range string")


@pytest.mark.parametrize("least,share,top,longest,counting", [
    (5, 100, 2000, 5, {}), (3, 60, 7, 5, {"range_bytes": 400, "shard_bytes": 700}), (2, 100, None, 3, {"shard_bytes": 1}),
    (1, 100, 50, 2, {})])
def test_equals_plain_counting(spark, least, share, top, longest, counting):
    rows = corpus()
    got = collocations(frame(spark, rows).repartition(3), least=least, share=share, top=top, longest=longest, group_rows=50, **counting)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, longest, least, share, top or 10 ** 9)


def test_counts_of_every_prefix(spark):
    rows = corpus(4, 60)
    want = plain_counts(rows)
    for least in (1, 2, 9):
        got, totals = phrase_counts(frame(spark, rows), least=least, range_bytes=300, shard_bytes=500)
        assert {(r["lang"], r["phrase"]): r["f"] for r in got.collect()} == {
            (lang, " ".join(p)): c for lang, f in want.items() for p, c in f.items() if c >= least}
    assert {r["lang"]: r["n"] for r in totals.collect()} == {
        lang: sum(c for p, c in f.items() if len(p) == 1) for lang, f in want.items()}


def test_awkward_rows(spark):
    rows = awkward()
    got = collocations(spark.createDataFrame(rows, SCHEMA).repartition(4), least=4, range_bytes=9000, shard_bytes=5000)
    assert sorted(tuple(r) for r in got.collect()) == plain([(r[1], r[2]) for r in rows], least=4)
    assert collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations(spark.createDataFrame(rows, SCHEMA).where("text is null or trim(text) = ''")).collect() == []


def test_products_beyond_64_bits(spark, monkeypatch):
    """Scores stay exact where a * n * 1000 and l * r pass 64 bits."""
    import shelfwise.llm.collocations as c
    big = 3_000_000_007
    rows = [("en", 1, "u", 9 * big), ("en", 1, "v", 7 * big), ("en", 2, "u v", 5 * big + 1)]
    monkeypatch.setattr(c, "phrase_counts", lambda *a, **k: (
        spark.createDataFrame(rows, "lang string, m int, phrase string, f long"),
        spark.createDataFrame([("en", 40 * big)], "lang string, n long")))
    got = c.collocations(None).first()
    assert got["score"] == 1000 * (5 * big + 1) * (40 * big) // (9 * big * 7 * big)


def test_transducers():
    rng = np.random.default_rng(1)
    grams = [tuple(int(x) for x in rng.integers(1, 5, rng.integers(1, 5))) for _ in range(400)]
    weight = rng.integers(1, 9, len(grams))
    columns = [np.array([g[i] if i < len(g) else 0 for g in grams]) for i in range(4)]
    want = Counter()
    for g, w in zip(grams, weight.tolist()):
        for i in range(1, len(g) + 1):
            want[g[:i]] += w

    def prefixes(t, least=1):
        return {tuple(map(int, p)): int(f) for d in range(1, 5) for *p, f in zip(*t.states(d, least)[0], t.states(d, least)[1])}

    whole = Counts.build(columns, weight)
    assert prefixes(whole) == want
    again = Counts.unpack(whole.pack())
    assert prefixes(again) == want and all((a == b).all() for a, b in zip(again.weights, whole.weights))
    # three shards under alphabets of their own, summed
    parts, maps = [], []
    for i in range(3):
        mine = slice(i, None, 3)
        letters = rng.permutation(4) + 1  # joint label of each local one
        local = np.concatenate(([0], np.argsort(letters) + 1))
        parts.append(Counts.build([local[c[mine]] for c in columns], weight[mine]))
        maps.append(np.concatenate(([0], letters)))
    assert prefixes(Counts.union(parts, maps)) == want
    for least in (5, 40):
        assert prefixes(Counts.union(parts, maps, least), least) == {p: f for p, f in want.items() if f >= least}
    # composing with an acceptor: sequences known as whole ones, and others
    asked = sorted(want) + [(4, 4, 4, 4), (9,), (1, 9)]
    ends = Counter()
    for g, w in zip(grams, weight.tolist()):
        ends[g] += w
    got = whole.compose([np.array([g[i] if i < len(g) else 0 for g in asked]) for i in range(4)])
    assert got.tolist() == [ends[g] for g in asked]
    empty = Counts.build([np.zeros(0, dtype=np.int64)] * 2)
    assert empty.compose([np.array([1]), np.array([0])]).tolist() == [0]


def test_frequent_pair_spreads_over_ranges():
    """Sequences after one frequent word pair go to many ranges."""
    from shelfwise.llm import collocations as c
    text = " ".join(f"hot pair w{i % 97}" for i in range(6000))
    class Context:
        partitionId = staticmethod(lambda: 3)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("pyspark.TaskContext.get", lambda: Context)
        batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
        row = next(c._encode(5, 1 << 20)(iter([batch]))).to_pylist()[0]
    shard = c._Shard(row)
    everything = np.unique(np.concatenate([c._keys(h, 9) for h in shard.hashes(2)]))
    parts = list(shard_parts(shard, everything, 5, 9, 50))
    sizes = [len(t.labels[-1]) for _, _, found in parts for p, t in found if p == 3]
    assert row["shard"] == 3 << 32 and len(sizes) > 40 and max(sizes) < sum(sizes) / 5
