"""Catalog registration of the output tables (K4, K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# table name -> (zone path relative to the root, partition columns)
TABLES = {
    "master_sales": ("processed/master_sales", ["year", "month"]),
    "demand_analytics": ("processed/demand_analytics", []),
    "inventory_analytics": ("processed/inventory_analytics", []),
    "pricing_recommendations": ("analytics/pricing_recommendations", []),
    "inventory_recommendations": ("analytics/inventory_recommendations", []),
}


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register_tables(spark: SparkSession, root: str, database: str = "retail",
                    tables=None) -> list[str]:
    """Drop and re-create external Parquet tables over the written folders.

    The schema is read from the Parquet footers, so it always matches
    what was written. Partitioned tables get their partitions recovered
    right away (without it a fresh partitioned table lists no rows).
    Returns the qualified names registered.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(database)}")
    done = []
    for name, (rel, parts) in (tables or TABLES).items():
        full = f"{_q(database)}.{_q(name)}"
        location = f"{root.rstrip('/')}/{rel}"
        quoted = location.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        if parts:
            # A partitioned table needs its columns spelled out; they are
            # taken from the written files (footers + partition folders).
            schema = spark.read.parquet(location).schema
            cols = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
            part_clause = f"({cols}) USING PARQUET PARTITIONED BY ({', '.join(_q(p) for p in parts)})"
        else:
            part_clause = "USING PARQUET"
        spark.sql(f"CREATE TABLE {full} {part_clause} LOCATION '{quoted}'")
        if parts:
            spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
        done.append(f"{database}.{name}")
    return done


# Product-grain tables that the decision jobs join with one another.
BUCKETED = {
    "demand_by_product": "processed/demand_analytics",
    "inventory_by_product": "raw/inventory",
    "inventory_analytics_by_product": "processed/inventory_analytics",
}


def register_bucketed(spark: SparkSession, root: str, database: str = "retail", buckets: int = 64,
                      tables: dict[str, str] | None = None, key: str = "product_id") -> list[str]:
    """Copies of the product tables under ``root``, bucketed and sorted by
    product and registered in the catalog (K4). Joins and groupings by product
    between tables of the same number of buckets read co-located files and
    need no shuffle; the copy shuffles each table once, for all of them.

    One bucket should hold some hundred MB; a product's rows in these tables
    are one or few, so no bucket is hot. Returns the qualified names.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(database)}")
    done = []
    for name, rel in (tables or BUCKETED).items():
        location = f"{root.rstrip('/')}/bucketed/{name}"
        df = spark.read.parquet(f"{root.rstrip('/')}/{rel}")
        spark.sql(f"DROP TABLE IF EXISTS {_q(database)}.{_q(name)}")
        # One task per bucket, so that a bucket is one file.
        (df.repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", location)
         .bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{name}"))
        done.append(f"{database}.{name}")
    return done


def decisions_from_buckets(spark: SparkSession, database: str = "retail", clicks: str | None = None,
                           averages: str | None = None, **options) -> dict[str, DataFrame]:
    """M4, M5 and M6 over the bucketed tables (and bucketed signal tables,
    when named): every join is by product on co-located buckets. The
    inventory analytics are taken as registered for M5 and M6."""
    from shelfwise.operators import dynamic_pricing, inventory_analytics, optimize_inventory
    table = lambda name: spark.table(f"{database}.{name}")
    demand, analytics = table("demand_by_product"), table("inventory_analytics_by_product")
    counts, means = (table(x) if x else None for x in (clicks, averages))
    return {
        "inventory_analytics": inventory_analytics(demand, table("inventory_by_product")),
        "pricing_recommendations": dynamic_pricing(demand, analytics, click_count_table=counts, competitor_table=means, **options),
        "inventory_recommendations": optimize_inventory(analytics, click_count_table=counts),
    }
