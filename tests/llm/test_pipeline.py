"""The pipeline against brute force, the oracles at the small scale, and
the subpackage's independence."""

import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

import data
import plain
from conftest import SF_SMALL
from shelfwise.llm import language_id
from shelfwise.llm.oracle import ORACLE_SQL
from shelfwise.llm.queries import QUERIES, fold

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, REPO)
import corpus_pipeline  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = QUERIES[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert Counter(map(tuple, got.select(cols).collect())) == Counter(want) and want


def brute(rows, model, bench):
    """(doc_id, taken) of what the stages keep."""
    labels = language_id.label_rows([d["text"] for d in rows], model)
    rows = [d for d, (lang, score, _) in zip(rows, labels)
            if lang != "und" and score >= corpus_pipeline.MIN_LANGUAGE_SHARE]
    first = {}
    for d in sorted(rows, key=lambda d: (d["doc_id"] is None, d["doc_id"] or 0)):
        first.setdefault(plain.normalised(d["text"]), d)
    rows = list(first.values())
    root = plain.components([plain.simhash(d["text"]) for d in rows])
    best = {}
    for d, r in zip(rows, root):
        if r not in best or (d["doc_id"] is None, d["doc_id"] or 0) < (best[r]["doc_id"] is None, best[r]["doc_id"] or 0):
            best[r] = d
    rows = [d for d in best.values() if not plain.contamination(d["text"], bench)[2]]
    return Counter((d["doc_id"], d["text"], t) for d, t in zip(rows, plain.mix(rows)[3]))


def test_stages_on_awkward_rows(spark):
    docs = spark.createDataFrame(data.awkward(), data.SCHEMA).repartition(3)
    folder = f"{SF_SMALL}"
    bench = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(data.as_dicts(data.awkward()), language_id.learn(docs.where(fold(5) != 0)), bench)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == data.SCHEMA.fieldNames()
            docs = docs.checkpoint()
    assert Counter((r["doc_id"], r["text"], r["taken"]) for r in docs.collect()) == want


def test_run(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(rows, language_id.learn(docs.where(fold(5) != 0)), bench)
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert Counter((r["doc_id"], r["text"], r["taken"]) for r in got.collect()) == want and 0 < len(want) < len(rows)


def test_stages_on_nothing(spark):
    docs = spark.createDataFrame([], data.SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == 0


def test_the_rest_imports_without_this_subpackage():
    code = ("import sys; sys.modules['shelfwise.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 45 and 'pipeline' not in q\n"
            "assert not any(k.startswith('op') and k[2].isdigit() for k in q); assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=REPO)


@pytest.mark.parametrize("name", ["op1_license_scan", "op4_url_filter", "op5_mix_sources"])
def test_native(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for marker in ("Python", "Pandas", "Arrow"):
        assert marker not in plan


def test_language_stage_keeps_mixed_documents(spark):
    words = {"en": "the house with water through", "de": "das haus mit wasser durch", "ru": "дом вода через этот земля"}
    rows = [(i, " ".join([words[k]] * 8), k) for i, k in enumerate(list(words) * 20)]
    mixed = " ".join([words["en"]] * 10 + [words["de"]] * 11 + [words["ru"]] * 10)
    rows += [(100, mixed, None), (101, "ἀγαθός λόγος " * 20, None), (102, "ἀγαθός " * 9 + words["en"], None),
             (103, "ἀγαθός " * 2 + words["en"], None), (104, "12 ?!", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs.where(fold(5) != 0))
    assert language_id.label_rows([mixed], model)[0][1] < corpus_pipeline.MIN_LANGUAGE_SHARE
    assert language_id.label_rows([rows[61][1]], model)[0][1] == 0.0
    kept = {r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, SF_SMALL).collect()}
    assert kept == {*range(60), 100, 103}
