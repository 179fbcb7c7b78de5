"""The live feed of a lake: start, pause, resume, stop, and how it is doing."""

from __future__ import annotations

import time
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import state as st
from ..streaming import events as ev
from ..streaming import threads as th
from .ingest import Lake

PIPELINE, MODE = "chat", "live"


class LiveFeed:
    """Event landing and event counters over one source folder, kept in a lake.

    ``threads`` adds the join of replies with their parents; it holds options of that stream, such
    as ``keep`` and ``wait``.

    Where the feed stands is in the streams' checkpoints, so pausing is stopping: a new
    object, also in another session, goes on where the last one ended.
    """

    def __init__(self, lake: Lake, source: str, threads: dict[str, Any] | None = None, **options):
        self.lake, self.source, self.threads, self.options = lake, source, threads, options
        self.queries: list[StreamingQuery] = []
        self.started: float | None = None

    @property
    def _counters(self) -> str:
        return f"{self.lake.live}_counters"

    @property
    def _threads(self) -> str:
        return f"{self.lake.live}_threads"

    def _start(self, **options) -> None:
        checkpoints = f"{self.lake.root}/_checkpoints"
        shared = {k: v for k, v in options.items() if k in ("interval", "max_files", "max_bytes")}
        self.queries = [
            ev.start_event_stream(self.lake.spark, self.source, self.lake.live, f"{checkpoints}/events", **options),
            ev.start_event_counters(self.lake.spark, self.source, self._counters, f"{checkpoints}/counters", **shared),
        ]
        if self.threads is not None:
            own = self.threads | shared
            self.queries.append(th.start_thread_stream(self.lake.spark, self.source, self._threads, f"{checkpoints}/threads", **own))

    @property
    def running(self) -> bool:
        return any(q.isActive for q in self.queries)

    def start(self) -> None:
        if not self.running:
            self._start(**self.options)
            self.started = time.time()
        self.lake.runs.set(PIPELINE, st.RUNNING, MODE)

    resume = start

    def _halt(self) -> None:
        for query in self.queries:
            query.stop()

    def pause(self) -> None:
        self._halt()
        self.lake.runs.set(PIPELINE, st.PAUSED, MODE)

    def drain(self) -> None:
        """Take in all there is, then end."""
        self._halt()
        self._start(**{**self.options, "interval": None})
        for query in self.queries:
            query.awaitTermination()

    def stop(self) -> None:
        """Take in all there is, then stop."""
        self.drain()
        self.lake.runs.set(PIPELINE, st.STOPPED, MODE)

    def marks(self) -> DataFrame:
        return ev.read_marks(self.lake.spark, self.lake.live)

    def replies(self) -> DataFrame:
        """Live replies with their parents; what the live feed did not hold is looked up in the history."""
        return th.settle_orphans(th.read_thread_replies(self.lake.spark, self._threads), self.lake.bronze("chat", "messages"))

    def status(self) -> dict[str, Any]:
        spark = self.lake.spark
        totals = {"total_events": 0, "total_messages": 0, "total_flushes": 0}
        try:
            totals |= ev.counter_totals(ev.read_counters(spark, self._counters)).first().asDict()
            totals["total_flushes"] = ev.count_flushes(spark, self.lake.live)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # nothing has come in yet
                raise
        return {
            "state": self.lake.runs.get(PIPELINE, MODE),
            "running": self.running,
            "uptime_seconds": round(time.time() - self.started, 1) if self.started and self.running else 0.0,
            **totals,
        }
