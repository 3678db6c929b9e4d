"""Substring, exact and near dedup and decontamination against brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import data
import plain
from shelfwise.llm.components import connected_components
from shelfwise.llm.decontam import decontaminate
from shelfwise.llm.exact_dedup import drop_copies, exact_dedup
from shelfwise.llm.simhash import drop_near_copies, near_duplicates
from shelfwise.llm.substring_dedup import substring_dedup


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(data.awkward(), data.SCHEMA).repartition(5).cache()


ROWS = data.as_dicts(data.awkward())


@pytest.mark.parametrize("group_bytes", [1 << 20, 2000])
def test_substring(docs, group_bytes):
    want = Counter((i, n, tuple(sorted(g)), k) for i, n, g, k in plain.substring(ROWS))
    got = Counter()
    for r in substring_dedup(docs, group_bytes=group_bytes).collect():
        gone = [w for s in r["spans"] for w in range(s["begin"], s["end"])]
        for a, b in zip(r["spans"], r["spans"][1:]):
            assert a["end"] < b["begin"]  # maximal: no two intervals touch
        got[(r["doc_id"], r["n_words"], tuple(gone), r["kept_text"])] += 1
    assert got == want and any(g for _, _, g, _ in want)


def test_exact(docs):
    groups = {}
    for d in ROWS:
        groups.setdefault(plain.normalised(d["text"]), []).append(d["doc_id"])
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = Counter((d["doc_id"], least[t], len(groups[t]), plain.sha(t))
                   for d in ROWS for t in [plain.normalised(d["text"])])
    rows = exact_dedup(docs, hash_all=True, prefix_chars=8).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == want
    kept = [r for r in rows if r["kept"]]
    assert sorted(r["text_sha256"] for r in kept) == sorted(map(plain.sha, groups))
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    for r in exact_dedup(docs).collect():  # the others were told apart by length or prefix
        assert r["text_sha256"] is not None or r["group_size"] == 1
    left = drop_copies(docs)
    assert left.columns == docs.columns and left.where("kept <> 'k'").count() == 0
    got = left.collect()
    assert sorted(plain.normalised(r["text"]) for r in got) == sorted(groups)
    assert all(r["doc_id"] == least[plain.normalised(r["text"])] for r in got)


def test_near(docs):
    prints = [plain.simhash(d["text"]) for d in ROWS]
    root = plain.components(prints)
    least = {}
    for d, r in zip(ROWS, root):
        if d["doc_id"] is not None:
            least[r] = min(least.get(r, d["doc_id"]), d["doc_id"])
    want = Counter((d["doc_id"], p, least.get(r)) for d, p, r in zip(ROWS, prints, root))
    rows = near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in rows) == want
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len(set(root)) and all(r["doc_id"] == r["component_id"] for r in kept)
    assert len(set(root)) < len(ROWS) - 10
    left = drop_near_copies(docs).collect()
    assert Counter(r["doc_id"] for r in left) == Counter(r["doc_id"] for r in kept) and {r["fp"] for r in left} == {"f"}


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_near_finds_every_distance(spark, distance):
    """Fingerprints that differ in chosen bits, given as they are."""
    import random

    from shelfwise.llm import simhash
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = list(base)
    for b in base:
        for _ in range(3):
            p = b
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                p ^= 1 << bit
            prints.append(p)
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    nodes = spark.createDataFrame([(p, i) for i, p in enumerate(prints)], "fp long, label long")
    keyed = nodes.select("fp", F.explode(simhash._variants()).alias("key"))
    links = (keyed.repartition(3, "key").sortWithinPartitions("key")
             .mapInArrow(simhash._links(distance), "a long, b long"))
    got = {r["node"]: r["component"] for r in
           connected_components(links, nodes.select(F.col("fp").alias("node"), "label")).collect()}
    root = plain.components([p % (1 << 64) for p in prints], distance)
    assert [got[p] for p in prints] == root


def test_components_of_long_chains(spark):
    n = 300
    links = [(i, i + 1) for i in range(0, n - 1) if i != 149] + [(5, 5)]
    nodes = spark.range(n).select(F.col("id").alias("node"), (F.lit(1000) - F.col("id")).alias("label"))
    got = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(links, "a long, b long"), nodes).collect()}
    assert got == {i: 1000 - (149 if i < 150 else n - 1) for i in range(n)}


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination(spark, docs, block_bytes):
    bench = spark.createDataFrame(data.BENCHMARK, data.BENCH_SCHEMA)
    want = Counter()
    for d in ROWS:
        n, hit, ids = plain.contamination(d["text"], data.BENCHMARK)
        want[(d["doc_id"], n, tuple(sorted(hit)), tuple(ids))] += 1
    got = Counter()
    for r in decontaminate(docs, bench, block_bytes=block_bytes, carry=docs.columns).collect():
        hit = tuple(w for s in r["spans"] for w in range(s["begin"], s["end"]))
        got[(r["doc_id"], r["n_words"], hit, tuple(r["items"]))] += 1
        assert r["carried"]["spans"] == "p" and r["carried"]["a.b"] == "dot"
    assert got == want and sum(bool(k[3]) for k in want) >= 4


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    bench = spark.createDataFrame([], data.BENCH_SCHEMA)
    assert substring_dedup(none).count() == exact_dedup(none).count() == near_duplicates(none).count() == 0
    assert decontaminate(none, bench).count() == 0
    assert decontaminate(docs, bench).where(F.size("items") > 0).count() == 0
