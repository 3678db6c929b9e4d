"""The registered queries: each applies one operator, with production
parameters, to its whole table and derives the digest columns of the
contract from the operator's output."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import license_scan, quality, toxicity
from shelfwise.llm.centroids import cluster
from shelfwise.llm.collocations import collocations
from shelfwise.llm.decontam import decontaminate
from shelfwise.llm.exact_dedup import exact_dedup
from shelfwise.llm.language_id import identify, learn
from shelfwise.llm.mixing import mix_sources
from shelfwise.llm.simhash import near_duplicates
from shelfwise.llm.substring_dedup import substring_dedup
from shelfwise.llm.tables import documents, table
from shelfwise.llm.token_files import read_token_files, write_token_files
from shelfwise.llm.url_filter import filter_urls, host, path_segments
from shelfwise.session import checkpoint_root


def covered(spans: str):
    """Words inside [begin, end) intervals."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence family of every document."""
    docs = documents(spark, sf_dir)
    found = license_scan.scan(docs, license_scan.train(docs))
    return license_scan.by_document(docs, found)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing repeated 20-word windows."""
    return substring_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", covered("spans").alias("n_removed"),
        F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints (3-word shingles) and components at 3 bits."""
    return near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id")


def _digits(text, salt: str, n: int):
    """The first ``n`` hexadecimal digits of an MD5, as a number."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), text)), 1, n), 16, 10).cast("long")


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time within 2024, spread by their id."""
    seconds = F.lit(1704067200) + F.pmod(F.col("page_id") * 7919, F.lit(366 * 24)) * 3600
    return pages.select("page_id", "url", F.timestamp_seconds(seconds).alias("fetched_at"))


def list_events(pages: DataFrame) -> DataFrame:
    """Dated list entries over the pages' own hosts, domains and first path
    segments: a third of each is listed, in 1 to 6 alternating events on
    days within 2024 that their MD5 gives."""
    at = pages.select(host(F.col("url")).alias("h"), path_segments(F.col("url")).alias("p")).where("h <> ''")
    named = (at.select(F.lit("hosts").alias("list"), F.col("h").alias("pattern"))
             .union(at.select(F.lit("domains"), F.regexp_extract("h", r"([^.]+\.[^.]+)$", 1)).where("h <> ''"))
             .union(at.where(F.size("p") > 0).select(F.lit("paths"), F.lower(F.concat_ws("/", "h", F.col("p")[0]))))
             .where("pattern <> ''").distinct())
    key = F.concat("list", F.lit(":"), "pattern")
    events = named.where(_digits(key, "listed:", 4) % 3 == 0).select(
        "list", "pattern", F.explode(F.sequence(F.lit(1), (_digits(key, "events:", 4) % 6 + 1).cast("int"))).alias("i"))
    day = _digits(F.concat(key, F.lit(":"), F.col("i").cast("string")), "day:", 6) % 366
    return events.select("list", "pattern", F.when(F.col("i") % 2 == 1, "add").otherwise("remove").alias("action"),
                         F.timestamp_seconds(F.lit(1704067200) + day * 86400).alias("at"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List entries active at the fetch time of every page."""
    pages = table(spark, sf_dir, "pages")
    return filter_urls(captures(pages), list_events(pages))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from each document."""
    return mix_sources(documents(spark, sf_dir))


def fold(modulus: int):
    """The fold of a document: crc32 of its id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def held_out(modulus: int, rest: int):
    """True for the documents that labels are not learned from (those
    without an id too)."""
    return F.coalesce(fold(modulus) == rest, F.lit(True)).alias("held_out")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from folds 1 to 4 of 5."""
    docs = documents(spark, sf_dir)
    model = learn(docs.where(fold(5) != 0))
    return identify(docs, model).select(
        "doc_id", held_out(5, 0), "lang_pred", "score")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal normalised texts."""
    return exact_dedup(documents(spark, sf_dir), hash_all=True)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from folds 0 and 2 of 3."""
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold(3) != 1))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(3, 1), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from folds 1 to 4 of 5."""
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(fold(5) != 0))
    return quality.score(docs, model).select(
        "doc_id", held_out(5, 0), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words inside 10-word windows of benchmark items."""
    found = decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", covered("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as Re-Pair shards and read back."""
    import public_tokenizers
    path = f"{checkpoint_root(spark)}/llm/token-files-{uuid.uuid4().hex[:12]}"
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of every 64-component embedding: 16 centroids, 3 rounds."""
    return cluster(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256).alias("centroid_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return collocations(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_substring_dedup, op3_simhash, op4_url_filter, op5_mix_sources, op6_language_id,
    op7_exact_dedup, op8_toxicity, op9_quality, op10_decontaminate, op11_token_files, op12_centroids,
    op13_collocations)}
