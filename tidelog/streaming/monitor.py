"""What a running delivery says of itself: counters, pending input and a heartbeat."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidelog.sinks.store import Ledger

#: What sources call the input that they know of and have not read: files, and offsets of a broker.
PENDING = ("numFilesOutstanding", "avgOffsetsBehindLatest", "maxOffsetsBehindLatest")


def pending(progress: dict) -> int | None:
    """Input that is waiting, by a query's progress; None if its sources don't say."""
    told = [float(s["metrics"][k]) for s in progress.get("sources", []) for k in PENDING if k in (s.get("metrics") or {})]
    return int(max(told)) if told else None


class Heartbeat(StreamingQueryListener):
    """Writes the state of queries to a ledger whenever one makes progress or ends, but for progress within ``seconds`` of the last
    time: sequence, uptime in seconds, status, batch, rows_read (in this run; of a batch that is read again, again), rate (rows a second),
    pending, and last, the status of the last commit, if ``committed`` tells it. The ledger is small and replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str, seconds: float = 60, committed: Callable[[], dict] | None = None, now: Callable[[], float] = time.time):
        self.ledger, self.seconds, self.committed, self.now = Ledger(spark, path), seconds, committed, now
        self.began, self.rows, self.last = now(), 0, None

    def read(self) -> dict:
        return self.ledger.read()[1]

    def _write(self, **values) -> None:
        number, before = self.ledger.read()
        status = self.committed().get("status", {}) if self.committed else {}
        self.ledger.commit(before | {"sequence": number + 1, "uptime": round(self.now() - self.began, 3), "rows_read": self.rows, "last": status} | values, number)
        self.last = self.now()

    def onQueryStarted(self, event) -> None:
        self._write(status="running", query=str(event.id))

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        self.rows += progress.get("numInputRows", 0)
        if self.last is None or self.now() - self.last >= self.seconds:
            self._write(batch=progress["batchId"], rate=progress.get("processedRowsPerSecond"), pending=pending(progress))

    def onQueryIdle(self, event) -> None:
        if self.now() - self.last >= self.seconds:
            self._write(pending=0)

    def onQueryTerminated(self, event) -> None:
        self._write(status="failed" if event.exception else "stopped", error=event.exception)
