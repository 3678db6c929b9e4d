"""Written tables that cut lineage, and small helpers on input frames."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import checkpoint_root


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the folder that the session names in
    ``spark.checkpoint.dir`` and return it read back with its own schema.

    Every executor can read the table again after a failure, and its file
    size tells Catalyst whether a join side is small enough to broadcast.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried(columns: list[str] | None) -> Column:
    """Input columns that travel along as one struct, so that their names
    cannot clash with a result column. Without any, a small placeholder."""
    if not columns:
        return F.lit(0).cast("tinyint")
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in columns])


def rows_with_keys(docs: DataFrame, key: list[Column], keys: DataFrame, how: str) -> DataFrame:
    """The whole rows of ``docs`` whose ``key`` is among the rows of ``keys``
    (``how`` left_semi) or is not (left_anti), null-safe; of rows with equal
    keys one stays. ``keys`` may be as long as the documents, so the join
    shuffles at every size; the texts move once and are not written."""
    # Plain equality on columns without nulls: the join's partitioning then
    # serves the de-duplication too.
    def plain(columns: list[Column]) -> list[Column]:
        return [x for i, c in enumerate(columns) for x in (
            F.coalesce(c.cast("string"), F.lit("")).alias(f"_k{i}"), c.isNull().alias(f"_n{i}"))]

    names = [f"_{x}{i}" for i in range(len(key)) for x in "kn"]
    left = docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("_row"), *plain(key))
    right = keys.select(*plain([F.col(f"`{c}`") for c in keys.columns])).hint("merge")
    return left.join(right, names, how).dropDuplicates(names).select("_row.*")
