"""Awkward documents: nulls in every column, empty and very long texts,
ties, repeated rows, near copies, shared passages and extra columns whose
names clash with those of the operators."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("carried", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("spans", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("a.b", T.StringType()),
])
EXTRA = ("k", "s", "c", "i", "y", "p", "f", "dot")
BENCHMARK = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "Short item"), (3, ""), (4, None), (None, "Numbers 1 2 3 4 5 6 7 8 9 10"), (2, "Short ITEM"),
    (5, "beta gamma delta epsilon zeta eta theta iota kappa lambda"),
]
BENCH_SCHEMA = "item_id long, text string"


def awkward():
    rng = random.Random(5)
    vocab = ["the", "of", "wort", "und", "Éa", "mot", "x1", "y-2", "z!", "日本"] + [f"w{i}" for i in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    shared, base = prose(60), prose(200).split(" ")
    rows = [(i, prose(rng.randint(1, 90)), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "hot", "hot"])) for i in range(40)]
    rows += [(100 + i, prose(15) + "\n" + shared + "  " + prose(15), "en", "hot") for i in range(8)]
    rows += [(200 + i, "Same  text\tfor all of us", "en", "hot") for i in range(12)]
    rows += [(220, "Same text for all of us", "fr", "b"), (220, "Same text for all of us", "fr", "b")]
    near = list(base)
    for i in range(10):
        near[rng.randrange(len(near))] = "edit%d" % i
        rows.append((300 + i, " ".join(near), "en", "a"))
    rows += [(400, None, None, None), (401, "", "en", None), (402, " \n\t ", None, "b"), (None, prose(30), "en", "a"),
             (None, None, None, None), (None, shared, "fr", None), (403, "a " * 3000, "en", "a"),
             (404, prose(6000), "en", "hot"), (404, prose(6000), "en", "hot"), (405, "X" * 70_000, "en", "b"),
             (406, "...!?", "en", "b"), (407, "pre SHORT item, and 1 2 3 4", "en", "b"),
             (408, "see alpha, beta gamma Delta epsilon zeta eta theta iota kappa lambda mu end", "en", "b"),
             (409, "numbers 1 2 3 4 5 6 7 8 9 10 11", "en", "b"), (410, "日本 " * 25, "en", "a"),
             (411, "beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "c"), (412, "one", "fr", "c")]
    out = [(i, t, l, s, None if t is None else len(t), *EXTRA) for i, t, l, s in rows]
    rng.shuffle(out)
    return out


def as_dicts(rows):
    return [dict(zip(("doc_id", "text", "lang", "source"), r)) for r in rows]
