"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, per_class: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, label, text) of at most ``per_class`` labelled documents of each
    class 0 and 1, those with the smallest hash of the id.

    Rows without id or label are left out; an id with several labels counts
    as 1 if one of them is; of several texts with one id the smallest is
    taken. The chosen ids are at most 2 * ``per_class`` short rows, so the
    documents are not shuffled to find their texts.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
             .where("id is not null and label is not null")
             .groupBy("id").agg(F.max("label").alias("label")))
    chosen = None
    for c in (0, 1):
        part = known.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (texts.join(F.broadcast(chosen), "id")  # at most 2 * per_class rows
            .groupBy("id", "label").agg(F.min("text").alias("text")))
