"""Mixing against the full list of quotients."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import data
import plain
from shelfwise.llm.mixing import mix_sources, sainte_lague

ROWS = data.as_dicts(data.awkward())


@pytest.mark.parametrize("shard_words,block", [(200_000, 64), (700, 16)])
def test_mix(spark, shard_words, block):
    docs = spark.createDataFrame(data.awkward(), data.SCHEMA).repartition(4)
    size, sizes, target, taken = plain.mix(ROWS, block=block, shard_words=shard_words)
    want = Counter((d["doc_id"], d["source"], n, sizes[d["source"]], round(target[d["source"]], 6), t)
                   for d, n, t in zip(ROWS, size, taken))
    got = mix_sources(docs, shard_words=shard_words, block_words=block, carry=["source", "size"])
    rows = got.select("doc_id", F.col("carried.source").alias("source"), "size", "source_size", "target", "taken",
                      F.col("carried.size").alias("extra")).collect()
    assert Counter((*r[:4], round(r["target"], 6), r["taken"]) for r in rows) == want
    per = Counter()
    for r in rows:
        assert r["taken"] <= 2 * r["size"] and r["extra"] == "s"
        per[r["source"]] += r["taken"]
    for s, t in target.items():
        shards = max(1, -(-sizes[s] // shard_words))
        assert abs(per[s] - t) <= block * (1 + shards)


def test_seats(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for g in range(40):
        parties = {(g, p): rng.choice([0, 1, 5, rng.randint(1, 5000)]) for p in range(rng.randint(1, 9))}
        seats = rng.randint(0, 60)
        rows += [(g, p, float(v), seats) for (_, p), v in parties.items()]
        want.update(plain.sainte_lague(parties, seats))
    got = sainte_lague(spark.createDataFrame(rows, "g long, p long, v double, s long"),
                       group=["g"], key=["g", "p"], votes="v", seats="s")
    assert {(r["g"], r["p"]): r["quota"] for r in got.collect()} == want


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in mix_sources(docs).collect()) == [
        (1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert mix_sources(docs.limit(0)).count() == 0


def test_tail_of_small_sources(spark):
    """One source of 20,000 words and 300 of 5 to 12: every source is near
    its target, the big one too, by the plain list of quotients as well."""
    rng = random.Random(8)
    rows = [(i, "w " * 100, "big") for i in range(200)]
    rows += [(1000 + i, "w " * rng.randint(5, 12), f"host{i:03d}") for i in range(300)]
    rows += [(2000, None, "none"), (2001, "one", "single")]
    docs = [dict(zip(("doc_id", "text", "source"), r)) for r in rows]
    size, sizes, target, taken = plain.mix(docs)
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["doc_id"]: r["taken"] for r in got} == dict(zip((d["doc_id"] for d in docs), taken))
    per = Counter()
    for d, n in zip(docs, taken):
        per[d["source"]] += n
    for s, t in target.items():
        assert abs(per[s] - t) <= max(1, t / 16), (s, t, per[s])
    assert sum(abs(per[s] - t) for s, t in target.items()) < 0.02 * sum(target.values())
