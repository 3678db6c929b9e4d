"""Summarise the physical plan of every registered query into PLANS.md.

usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.1)

For each query: shuffles (Exchange), broadcasts, join strategies, aggregate
operators, Expand/Window/Generate nodes, and per scan the read schema and
the filters pushed into Parquet. The plan is the initial AQE plan
(broadcasts chosen from file sizes; AQE may still convert joins at runtime).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "Exchange RoundRobinPartitioning", "BroadcastExchange", "SortMergeJoin",
         "BroadcastHashJoin", "ShuffledHashJoin", "HashAggregate", "ObjectHashAggregate",
         "SortAggregate", "Expand", "Window", "Generate", "TakeOrderedAndProject"]
SHORT = {"Exchange hashpartitioning": "hash shuffle", "Exchange rangepartitioning": "range shuffle",
         "Exchange SinglePartition": "to 1 partition",
         "Exchange RoundRobinPartitioning": "round-robin", "BroadcastExchange": "broadcast",
         "SortMergeJoin": "SMJ", "BroadcastHashJoin": "BHJ", "ShuffledHashJoin": "SHJ",
         "HashAggregate": "HashAgg", "ObjectHashAggregate": "ObjHashAgg",
         "SortAggregate": "SortAgg", "TakeOrderedAndProject": "TopK"}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from shelfwise.plans.queries import QUERIES
    from shelfwise.session import local_session
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/plans.py` at `{sf}` on local[8] (initial AQE plans).", "",
           "| Query | Operators | Scans (table: columns read; pushed filters) |",
           "| --- | --- | --- |"]
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        text = buf.getvalue()
        physical = text.split("== Physical Plan ==")[-1]
        counts = []
        for node in NODES:
            n = len(re.findall(re.escape(node) + r"[ (]", physical))
            if n:
                counts.append(f"{SHORT.get(node, node)} x{n}")
        scans = []
        for line in physical.splitlines():
            if "FileScan parquet" not in line:
                continue
            loc = re.search(r"file:([^\],]+)", line)
            pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", line)
            schema = re.search(r"ReadSchema: struct<(.*)>", line)
            table = os.path.basename(loc.group(1)).replace(".parquet", "") if loc else "?"
            cols = ",".join(c.split(":")[0] for c in schema.group(1).split(",")) if schema else ""
            filt = pushed.group(1) if pushed else ""
            scans.append(f"{table}: {cols}" + (f"; {filt}" if filt else ""))
        scan_txt = "<br>".join(sorted(set(scans))).replace("|", "\\|")
        out.append(f"| `{name}` | {', '.join(counts)} | {scan_txt} |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")
    print("\n".join(out[:12]))


if __name__ == "__main__":
    main()
