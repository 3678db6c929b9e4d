"""File sources (CSV and Parquet) and file sinks."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a CSV input by their header. Only first lines are parsed, in
    tasks; the driver gets one row per file."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"), "value").where("at = 0")
    heads = lines.groupBy("file").agg(F.min_by("value", "n").alias("head")).collect()
    out: dict[tuple[str, ...], list[str]] = {}
    for row in heads:
        names = next(csv.reader([row["head"].lstrip("\ufeff")]), [])
        out.setdefault(tuple(names), []).append(row["file"])
    return out


#: Holds the text of a record that the declared schema does not fit.
CORRUPT = "_corrupt_record"


def _csv_by_header(spark: SparkSession, path: str, schema: T.StructType, optional: tuple[str, ...] = (),
                   by_file: bool = False, checked: bool = False, multi_line: bool = True) -> DataFrame:
    """Read a CSV with a header, binding declared types by column *name*.

    Spark applies a declared CSV schema by position, so a file whose columns
    are in another order would be read swapped. The declared schema is put in
    the order of the header of one file; a file with another header fails
    the read instead of being read swapped (``enforceSchema`` off). With
    ``by_file`` files are grouped by their own header, at the price of a
    pass over the text, and every group is bound to its own.

    A declared column that the header lacks is an error, unless ``optional``
    names it: then it is null. Quoted line breaks belong to their record; a
    file is then one task, so ``multi_line=False`` splits large files known to
    have none. ``checked`` adds ``CORRUPT``, see :func:`split_rejected`.
    """
    def reader():
        return spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')

    if by_file:
        groups = list(_headers(spark, path).items())
    else:
        groups = [(tuple(reader().csv(path).columns), [path])]
    out = None
    for header, files in groups:
        lacking = [f.name for f in schema.fields if f.name not in header and f.name not in optional]
        if lacking:
            raise ValueError(f"{files[0]}: no columns {lacking} in the header {list(header)}")
        by_name = {f.name: f for f in schema.fields}
        ordered = T.StructType([
            by_name.get(name, T.StructField(name, T.StringType(), True)) for name in header])
        if checked:
            ordered = ordered.add(CORRUPT, T.StringType())
        df = (reader().option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("columnPruning", not checked).option("enforceSchema", False).schema(ordered).csv(files))
        # Whether a record fits depends on the columns asked for; the generator
        # asks for all of them, whatever is selected later.
        fields = F.struct(*[F.col(f"`{name}`") for name in header])
        flag = F.inline(F.array(F.struct(F.col(CORRUPT), fields.alias("_beside"))))
        df = df.select(*[F.col(f"`{f.name}`") if f.name in header else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in schema.fields], *([flag] if checked else [])).drop("_beside")
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise ValueError(f"{path}: no CSV files")
    return out


def split_rejected(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A checked read as its good rows, and (``record``, ``reason``) of the
    rejected ones: records with too few or too many fields, and such with a
    value that its declared type does not take. Every record of the files is
    in exactly one of the two."""
    bad = F.col(CORRUPT).isNotNull()
    return (checked.where(~bad).drop(CORRUPT),
            checked.where(bad).select(F.col(CORRUPT).alias("record"), F.lit("malformed").alias("reason")))


def read_transactions(spark: SparkSession, path: str, by_file: bool = False, **how) -> DataFrame:
    """Prepared transactions CSV with the declared schema; a source
    without customers has null ``customer_id``. ``checked`` and
    ``multi_line`` as in :func:`_csv_by_header`."""
    return _csv_by_header(spark, path, schemas.TRANSACTIONS, ("customer_id",), by_file, **how)


def read_catalog(spark: SparkSession, path: str, by_file: bool = False, **how) -> DataFrame:
    """Catalog CSV; ids kept as text, no inference pass."""
    return _csv_by_header(spark, path, schemas.CATALOG_CSV, (), by_file, **how)


def read_inventory(spark: SparkSession, path: str, by_file: bool = False, **how) -> DataFrame:
    """S3: inventory CSV; measures read as double, cast later."""
    return _csv_by_header(spark, path, schemas.INVENTORY_CSV, (), by_file, **how)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; Hive-style partition folders become columns."""
    return spark.read.parquet(path)


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet scan that yields None when the input is absent or empty."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def read_ledger(spark: SparkSession, path: str, fmt: str = "csv", checked: bool = False,
                multi_line: bool = True) -> DataFrame:
    """Raw ledger as text columns (CSV with header) or Parquet. Line
    breaks inside quotes belong to the record, as in workbook exports."""
    if fmt != "csv":
        df = spark.read.format(fmt).load(path)
        return df.withColumn(CORRUPT, F.lit(None).cast("string")) if checked else df
    header = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return _csv_by_header(spark, path, schema, checked=checked, multi_line=multi_line)


def load_products(spark: SparkSession, path: str) -> DataFrame:
    """Catalog scan that fails on a missing or empty input."""
    df = read_optional(spark, path) if not path.endswith(".csv") else None
    if df is None:
        try:
            df = read_catalog(spark, path)
        except AnalysisException as exc:
            raise FileNotFoundError(f"no catalog under {path}") from exc
    if df.isEmpty():
        raise ValueError(f"the catalog under {path} has no rows")
    return df


# --------------------------------------------------------------------------
# Sinks
# --------------------------------------------------------------------------

def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: overwrite a snappy Parquet table."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_partitioned(df: DataFrame, path: str, cols=("year", "month"),
                      mode: str = "overwrite") -> None:
    """K2: partitioned Parquet write.

    ``rebalance`` (instead of ``repartition``) lets AQE split a hot month
    over several tasks and merge small ones, so one busy month does not
    land in a single task.
    """
    (df.hint("rebalance", *cols).write.mode(mode).partitionBy(*cols)
       .option("compression", "snappy").parquet(path))


def restate_partitions(df: DataFrame, path: str, cols=("year", "month")) -> None:
    """K2 for some partitions: those that ``df`` holds are replaced, others
    keep their files. The new files are staged and moved in when all are
    written, so a job that dies before leaves the table as it was."""
    (df.hint("rebalance", *cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*cols).option("compression", "snappy").parquet(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K6: CSV folder with a header line per part file; quotes are doubled, as
    the readers here expect."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def preview(df: DataFrame, n: int = 20) -> None:
    """K8: print a few rows and the schema (driver-side, bounded by n)."""
    df.show(n, truncate=False)
    df.printSchema()
