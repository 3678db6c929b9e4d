"""Sources and sinks: CSV/Parquet readers and writers, test adapter views."""

from shelfwise.sources.files import (
    load_products,
    preview,
    read_catalog,
    read_inventory,
    read_ledger,
    read_optional,
    read_table,
    read_transactions,
    write_csv,
    write_partitioned,
    write_table,
)

__all__ = ["load_products", "preview", "read_catalog", "read_inventory", "read_ledger",
           "read_optional", "read_table", "read_transactions", "write_csv",
           "write_partitioned", "write_table"]
