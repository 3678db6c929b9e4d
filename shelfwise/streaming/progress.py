"""What the streams read, keep and drop (T9, T10), from Spark's own progress
events."""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

REPORT = ("name string, run_id string, batches long, input_rows long, late_rows long, state_rows long, "
          "state_bytes long, watermark string, offsets map<string,string>")


class StreamReport(StreamingQueryListener):
    """Adds up the progress of every query of a session::

        report = StreamReport()
        spark.streams.addListener(report)

    ``late_rows`` counts rows that came behind the watermark and were dropped
    by a stateful operator (for the real-time job: entries, of which an event
    has one in each of its two windows); ``state_rows`` and ``state_bytes``
    are those of the last batch, ``offsets`` the end offsets by source.
    """

    def __init__(self):
        self.runs: dict[str, dict] = defaultdict(lambda: {
            "name": None, "batches": 0, "input_rows": 0, "late_rows": 0, "state_rows": 0, "state_bytes": 0,
            "watermark": None, "offsets": {}})

    def onQueryStarted(self, event) -> None:
        self.runs[str(event.runId)]["name"] = event.name

    def onQueryProgress(self, event) -> None:
        self.add(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def add(self, p: dict) -> None:
        """One progress event as a dictionary."""
        run = self.runs[p["runId"]]
        states = p.get("stateOperators") or []
        run["name"] = p.get("name")
        run["batches"] += 1
        run["input_rows"] += p.get("numInputRows") or 0
        run["late_rows"] += sum(s.get("numRowsDroppedByWatermark") or 0 for s in states)
        run["state_rows"] = sum(s.get("numRowsTotal") or 0 for s in states)
        run["state_bytes"] = sum(s.get("memoryUsedBytes") or 0 for s in states)
        run["watermark"] = (p.get("eventTime") or {}).get("watermark", run["watermark"])
        run["offsets"] = {s["description"]: json.dumps(s.get("endOffset")) for s in p.get("sources", [])}

    def rows(self, spark: SparkSession) -> DataFrame:
        """One row per run seen so far."""
        return spark.createDataFrame([(r["name"], run, r["batches"], r["input_rows"], r["late_rows"], r["state_rows"],
                                       r["state_bytes"], r["watermark"], r["offsets"]) for run, r in self.runs.items()], REPORT)
