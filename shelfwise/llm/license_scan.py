"""Licence scans: a trained paragraph classifier, confirmed by templates.

A paragraph (lines up to one without letters and digits) is judged as a
whole, its lines joined, and by each of its lines; what is very long is cut
into overlapping pieces. So a hard-wrapped notice is found as well as a line
among others. Each such part is a set of word n-grams of one to three words,
digits as one sign. A multinomial
logistic regression with L1 weights them for every licence family and for
the class of unknown text. It is trained on variants of the families'
notices and on a bounded sample of the corpus as unknown text. A second,
one-dimensional regression on the margin over the unknown class, fitted on
rows kept back, calibrates the chance that a paragraph is a licence at all.
A prediction is confirmed when the paragraph contains at least 0.8 of the
5-word shingles of one of the family's templates.

Only DataFrame functions and Spark ML run over the corpus. Frequent words
such as "the" and "under" can't make a paragraph a licence by themselves: as
long as all weights in favour of a family of the n-grams made of them alone
stay under the margin that the threshold asks for, a paragraph needs some
other word with a weight. Only paragraphs with such a telling word are taken
apart into n-grams; the others are unknown whatever else they hold.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.license_templates import TEMPLATES
from shelfwise.llm.tables import written

UNKNOWN = "unknown"
PIECE, STEP = 4000, 3500  # characters
BLANK = r"\n[^\p{L}\p{N}]*\n"  # lines without letters and digits


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, par, piece): the lines of each paragraph and, where it has
    several, all of them joined; parts of more than PIECE characters in
    overlapping pieces. What is between words is one space in joined lines,
    so that indents and comment signs don't fill a piece."""
    paras = docs.select(F.col(id_col).alias("id"), F.posexplode(
        F.split(F.coalesce(F.col(text_col), F.lit("")), BLANK)).alias("par", "para"))
    each = F.split("para", "\n")
    joined = F.regexp_replace("para", r"[^\p{L}\p{N}]+", " ")
    lines = paras.select("id", "par", F.explode(
        F.when(F.size(each) > 1, F.array_distinct(F.array_append(each, joined))).otherwise(each)).alias("line"))
    last = F.greatest(F.ceil((F.length("line") - PIECE) / STEP), F.lit(0)).cast("int")
    return (lines.withColumn("at", F.explode(F.sequence(F.lit(0), last)))
            .select("id", "par", F.when(last == 0, F.col("line"))
                    .otherwise(F.substring("line", F.col("at") * STEP + 1, F.lit(PIECE))).alias("piece")))


def word_list(text: Column) -> Column:
    """Lower-cased words; every run of digits is the word 0."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), r"\p{N}+", "0"), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def ngrams(words: Column, n: int) -> Column:
    """Runs of n words, joined by a space (an empty array if there are fewer)."""
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1))),
        lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def features(words: Column) -> Column:
    return F.array_distinct(F.concat(words, ngrams(words, 2), ngrams(words, 3)))


def shingles(words: Column) -> Column:
    """Distinct 5-word shingles; a shorter text is one shingle."""
    return F.array_distinct(F.when(F.size(words) >= 5, ngrams(words, 5))
                            .when(F.size(words) > 0, F.array(F.array_join(words, " ")))
                            .otherwise(F.array().cast("array<string>")))


def template_table(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    rows = [(family, i, text) for family, texts in templates.items() for i, text in enumerate(texts)]
    return (spark.createDataFrame(rows, "family string, i int, text string")
            .withColumn("words", word_list(F.col("text"))))


def _variants(templates: DataFrame) -> DataFrame:
    """Each notice whole, without each of its words in turn, and its halves
    of four words or more: (family, words)."""
    n = F.size("words")
    dropped = templates.select("family", F.explode(F.sequence(F.lit(0), n)).alias("d"), "words").select(
        "family", F.concat(F.slice("words", 1, F.greatest(F.col("d") - 1, F.lit(0))),
                           F.slice("words", F.col("d") + 1, F.size("words"))).alias("words"))
    half = templates.where(n >= 16).select("family", F.explode(F.array(
        F.slice("words", 1, (n / 2).cast("int")), F.slice("words", (n / 2).cast("int") + 1, n))).alias("words"))
    return dropped.unionByName(half)


class LicenceModel:
    """Weights (small table), intercepts, calibration and templates."""

    def __init__(self, weights: DataFrame, grams: list[tuple], intercepts: dict[str, float], frequent: list[str],
                 slope: float, offset: float, templates: DataFrame):
        self.weights, self.grams, self.intercepts = weights, grams, intercepts
        self.frequent = frequent  # words of the n-grams with weights, the most frequent in the sample first
        self.slope, self.offset, self.templates = slope, offset, templates

    def telling_words(self, threshold: float) -> list[str] | None:
        """Words one of which every paragraph of that probability holds;
        None if there is no such list."""
        if self.slope <= 0:
            return None
        needed = (math.log(threshold / (1 - threshold)) - self.offset) / self.slope
        names = sorted(k for k in self.intercepts if k != UNKNOWN)
        best = [self.intercepts[f] - self.intercepts[UNKNOWN] for f in names]
        if max(best) >= needed:
            return None
        plain: set[str] = set()
        for word in self.frequent:
            grown = plain | {word}
            more = [(g, w) for g, *w in self.grams if word in g.split(" ") and grown.issuperset(g.split(" "))]
            bound = [b + sum(max(w[i], 0.0) for _, w in more) for i, b in enumerate(best)]
            if max(bound) < needed - 1e-9:
                plain, best = grown, bound
        return sorted({x for g, *w in self.grams if max(w) > 0 for x in g.split(" ")} - plain)


def _logits(items: DataFrame, key: list[str], weights: DataFrame, intercepts: dict[str, float]) -> DataFrame:
    """``items``: key columns and ``words``. Returns key, family (best
    beside unknown) and margin over the unknown class. One hash aggregate
    over the n-grams that have weights; they are combined in the task that
    took the paragraph apart. Items with an equal key are one: each brings a
    gram "" without weights, which counts them, and the sums are shared out."""
    grams = items.select(*key, F.explode(F.array_append(features(F.col("words")), F.lit(""))).alias("gram"))
    names = sorted(k for k in intercepts if k != UNKNOWN)
    table = weights.unionByName(weights.sparkSession.range(1).select(
        F.lit("").alias("gram"), *[F.lit(0.0).alias(f"w{i}") for i in range(len(names))]))
    copies = F.count_if(F.col("gram") == "")
    sums = (grams.join(table, "gram").groupBy(*key)
            .agg(*[(F.sum(f"w{i}") / copies).alias(f"w{i}") for i in range(len(names))],
                 F.count_if(F.col("gram") != "").alias("n")).where("n > 0"))
    # weights are relative to the unknown class
    scores = F.array(*[F.struct((F.col(f"w{i}") + F.lit(intercepts[f] - intercepts[UNKNOWN])).alias("margin"),
                                F.lit(f).alias("family")) for i, f in enumerate(names)])
    return sums.select(*key, F.array_max(scores).alias("best")).select(*key, "best.family", "best.margin")


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          templates: dict[str, list[str]] | None = None, sample_docs: int = 400,
          sample_paragraphs: int = 4000, l1: float = 1e-3) -> LicenceModel:
    """Fits on the notices and on at most ``sample_paragraphs`` paragraphs
    of ``sample_docs`` documents (those with the smallest hash of the id),
    without the paragraphs that hold half of a template."""
    spark = docs.sparkSession
    templates = templates or TEMPLATES
    tt = written(template_table(spark, templates).withColumn("shingles", shingles(F.col("words"))), "licence-templates")
    chosen = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
              .orderBy(F.xxhash64("id"), "id").limit(sample_docs))
    text = (paragraphs(chosen, "id", "text").select(word_list(F.col("piece")).alias("words"))
            .where(F.size("words") > 0).orderBy(F.xxhash64("words")).limit(sample_paragraphs)
            .withColumn("row", F.monotonically_increasing_id()))
    text = written(text, "licence-sample")
    like = _similarity(text, ["row"], tt).where("similarity >= 0.5").select("row").distinct()
    unknown = text.join(like, "row", "left_anti").select(F.lit(UNKNOWN).alias("family"), "words")
    # A variant and a sampled paragraph are kept back for calibration by hash.
    rows = (_variants(tt.select("family", "words")).unionByName(unknown)
            .withColumn("grams", features(F.col("words")))
            .withColumn("kept_back", F.pmod(F.xxhash64("words"), F.lit(4)) == 0))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "licence-rows")

    names = sorted([*templates, UNKNOWN])
    vocabulary = sorted({r["g"] for r in tt.select(F.explode(features(F.col("words"))).alias("g")).distinct().collect()})
    index = F.element_at(F.create_map(*[x for i, f in enumerate(names) for x in (F.lit(f), F.lit(float(i)))]),
                         F.col("family"))
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features").setBinary(True)
    # Families have few variants: they weigh the same in the fit, and unknown
    # text as much as all of them.
    share = rows.groupBy("family").agg(F.count(F.lit(1)).alias("n"))
    fit = (vectors.transform(rows.where("not kept_back").join(F.broadcast(share), "family"))  # one row a family
           .select("features", index.alias("label"), (F.when(F.col("family") == UNKNOWN, 1000.0 * len(templates)).otherwise(1000.0) / F.col("n"))
                   .alias("weight")).coalesce(2))
    lr = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=l1, maxIter=60,
                            standardization=False, weightCol="weight")
    model = lr.fit(fit)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    u = names.index(UNKNOWN)
    rel = [[float(w[i, j] - w[u, j]) for i in range(len(names)) if i != u] for j in range(len(vocabulary))]
    used = [(g, *r) for g, r in zip(vocabulary, rel) if any(r)]
    fields = ", ".join(f"w{i} double" for i in range(len(names) - 1))
    weights = written(spark.createDataFrame(used, f"gram string, {fields}"), "licence-weights")
    intercepts = {f: float(b[i]) for i, f in enumerate(names)}
    words = sorted({x for g, *r in used for x in g.split(" ")})
    seen = dict(text.select(F.explode(F.array_distinct("words")).alias("w")).where(F.col("w").isin(words))
                .groupBy("w").count().collect())
    frequent = sorted(words, key=lambda x: (-seen.get(x, 0), x))

    back = _logits(rows.where("kept_back"), ["row", "family"],
                   weights, intercepts).toDF("row", "truth", "family", "margin")
    platt = (back.select(array_to_vector(F.array("margin")).alias("features"),
                         (F.col("truth") != UNKNOWN).cast("double").alias("label")).coalesce(1))
    cal = LogisticRegression(regParam=1e-3, maxIter=50, standardization=False).fit(platt)
    return LicenceModel(weights, used, intercepts, frequent, float(cal.coefficients[0]), float(cal.intercept), tt)


def _similarity(items: DataFrame, key: list[str], templates: DataFrame) -> DataFrame:
    """Share of each template's shingles that an item contains: key, family
    (of the template), similarity; only for items that share one. Templates
    are few and short, so their table is joined as a small side."""
    t = templates.select(F.col("family").alias("template"), "i", F.size("shingles").alias("of"),
                         F.explode("shingles").alias("s"))
    return (items.select(*key, F.explode(shingles(F.col("words"))).alias("s")).distinct().join(t, "s")
            .groupBy(*key, "template", "i", "of").agg(F.count(F.lit(1)).alias("n"))
            .groupBy(*key, "template").agg(F.max(F.col("n") / F.col("of")).alias("similarity")))


def scan(docs: DataFrame, model: LicenceModel, *, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = 0.9, similarity: float = 0.8) -> DataFrame:
    """The licence paragraphs: ``id_col``, ``par`` (paragraph number from 0),
    ``family``, ``probability`` (calibrated, at least ``threshold``),
    ``similarity`` to the family's nearest template, ``confirmed``
    (similarity at least ``similarity``) and ``families`` (of all its parts).

    Defined cases: null and empty texts have no licence paragraph; of a
    paragraph's lines, joined lines and pieces the likeliest confirmed one
    counts, else the likeliest; rows with the same id are
    one document, whose equal paragraph numbers merge and whose equal parts
    there count once; a null id is a document of
    its own kind and is returned; ties between families go to the later name
    in alphabetical order; an empty table gives an empty result; other
    columns are not looked at.
    """
    telling = model.telling_words(threshold)

    def parts(rows: DataFrame) -> DataFrame:
        items = paragraphs(rows, id_col, text_col)
        items = items.withColumn("words", word_list(F.col("piece"))).drop("piece")
        if telling is not None:
            items = items.where(F.arrays_overlap("words", F.array(*[F.lit(w) for w in telling]).cast("array<string>")))
        return items.withColumn("key", F.xxhash64("words"))

    key = ["id", "par", "key"]
    chance = 1.0 / (1.0 + F.exp(-(F.col("margin") * model.slope + model.offset)))
    found = _logits(parts(docs), key, model.weights, model.intercepts).withColumn("probability", chance)
    found = written(found.where(F.col("probability") >= threshold), "licence-found")
    # Only predicted paragraphs are compared with the templates, and only
    # documents that have one are taken apart again.
    some = found.select(F.col("id").alias("_found")).distinct()
    items = parts(docs.select(id_col, text_col).join(some, F.col(id_col).eqNullSafe(F.col("_found")), "left_semi"))
    predicted = found.select(*[F.col(k).alias(f"f_{k}") for k in key]).distinct()
    items = items.join(predicted, items["id"].eqNullSafe(predicted["f_id"]) & (items["par"] == predicted["f_par"])
                       & (items["key"] == predicted["f_key"]), "left_semi")
    near = _similarity(items, key, model.templates)
    same = [found[k].eqNullSafe(near[k]) for k in key]
    out = (found.join(near, same[0] & same[1] & same[2] & (found["family"] == near["template"]), "left")
           .select(found["id"], found["par"], "family", "probability",
                   F.coalesce("similarity", F.lit(0.0)).alias("similarity")))
    best = F.max(F.struct((F.col("similarity") >= similarity).alias("confirmed"),
                          "probability", "similarity", "family")).alias("b")
    return (out.groupBy("id", "par").agg(best, F.array_sort(F.collect_set("family")).alias("families"))
            .select(F.col("id").alias(id_col), "par", "b.family", "b.probability", "b.similarity", "b.confirmed",
                    "families"))


def by_document(docs: DataFrame, found: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """One row per document id: ``licence`` (the likeliest confirmed family,
    else the likeliest, else ``unknown``), ``probability``, ``confirmed``,
    ``n_licences`` (licence paragraphs) and ``families`` (sorted, joined)."""
    best = F.max(F.struct("confirmed", "probability", "family")).alias("b")
    per = found.groupBy(F.col(id_col).alias("_id")).agg(
        best, F.count(F.lit(1)).alias("n"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("families")))), ",").alias("f"))
    ids = docs.select(id_col).distinct()
    return (ids.join(per, ids[id_col].eqNullSafe(per["_id"]), "left")
            .select(id_col, F.coalesce("b.family", F.lit(UNKNOWN)).alias("licence"),
                    F.coalesce("b.probability", F.lit(0.0)).alias("probability"),
                    F.coalesce("b.confirmed", F.lit(False)).alias("confirmed"),
                    F.coalesce("n", F.lit(0)).alias("n_licences"), F.coalesce("f", F.lit("")).alias("families")))
