"""What a run did, from the jobs that did it: rows, failures and seconds by stage, for Prometheus too."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

T = TypeVar("T")

#: Upper bounds of the histogram of seconds for each document.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
PREFIX = "docloom:"


@dataclass
class Stage:
    """Rows that came through and failed, and flags counted among them; seconds of the jobs, and of the rows if measured."""

    rows: int = 0
    failed: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    seconds: float = 0.0
    row_seconds: float = 0.0
    buckets: list[int] = field(default_factory=lambda: [0] * len(BUCKETS))

    def add(self, found: dict) -> None:
        self.rows += found.get("rows") or 0
        self.failed += found.get("failed") or 0
        self.row_seconds += found.get("row_seconds") or 0.0
        for n in range(len(BUCKETS)):
            self.buckets[n] += found.get(f"le_{n}") or 0
        for name, value in found.items():
            if name.startswith("n_"):
                self.counts[name[2:]] = self.counts.get(name[2:], 0) + (value or 0)


class Monitor:
    """Counts of each stage, taken while its job runs: no frame is evaluated again to be counted."""

    def __init__(self):
        self.stages: dict[str, Stage] = {}
        self._open: list[tuple[str, Observation]] = []
        self._lock = threading.Lock()

    def stage(self, name: str) -> Stage:
        return self.stages.setdefault(name, Stage())

    def observe(self, name: str, rows: DataFrame, failed: Column | None = None, seconds: str | None = None, **flags: Column) -> DataFrame:
        """rows, of which the next action counts all, those that failed and each flag, and sums up the column seconds.

        A stream's counts come with the progress of its batches: see listen().
        """
        found = [F.count("*").alias("rows"), *[F.count_if(flag).alias(f"n_{flag_name}") for flag_name, flag in flags.items()]]
        if failed is not None:
            found.append(F.count_if(failed).alias("failed"))
        if seconds:
            found.append(F.coalesce(F.sum(seconds), F.lit(0.0)).alias("row_seconds"))
            found += [F.count_if(F.col(seconds) <= top).alias(f"le_{n}") for n, top in enumerate(BUCKETS)]
        if rows.isStreaming:
            return rows.observe(PREFIX + name, *found)
        seen = Observation()
        self._open.append((name, seen))
        return rows.observe(seen, *found)

    def run(self, name: str, action: Callable[[], T]) -> T:
        """The action's result; its seconds, and what the frames observed under that name counted, go to the stage.

        An action that fails adds its seconds and one failed job, and what it counted is forgotten.
        """
        began = time.perf_counter()
        mine = lambda: [x for x in self._open if x[0] == name]
        try:
            out = action()
        except Exception:
            stage = self.stage(name)
            stage.counts["failed_jobs"] = stage.counts.get("failed_jobs", 0) + 1
            raise
        else:
            for _, seen in mine():
                self.stage(name).add(seen.get)
            return out
        finally:
            self.stage(name).seconds += time.perf_counter() - began
            self._open = [x for x in self._open if x[0] != name]

    def listen(self, spark: SparkSession) -> StreamingQueryListener:
        """Take the counts of observed streams from every batch that ends; spark.streams.removeListener() ends it."""
        listener = Progress(self)
        spark.streams.addListener(listener)
        return listener

    def text(self) -> str:
        """All counts in Prometheus' text format."""
        lines = []

        def metric(name: str, kind: str, about: str, values: list[tuple[str, float]]) -> None:
            lines.extend([f"# HELP {name} {about}", f"# TYPE {name} {kind}", *[f"{n} {v:g}" for n, v in values]])

        with self._lock:
            stages = list(self.stages.items())
        metric("docs_processed_total", "counter", "Documents that came through a stage.", [(f'docs_processed_total{{stage="{n}"}}', s.rows - s.failed) for n, s in stages])
        metric("docs_failed_total", "counter", "Documents that failed in a stage.", [(f'docs_failed_total{{stage="{n}"}}', s.failed) for n, s in stages])
        metric("stage_seconds_total", "counter", "Seconds of a stage's jobs.", [(f'stage_seconds_total{{stage="{n}"}}', s.seconds) for n, s in stages])
        timed = [(n, s) for n, s in stages if s.row_seconds or any(s.buckets)]
        each = []
        for n, s in timed:
            each += [(f'doc_process_seconds_bucket{{stage="{n}",le="{top:g}"}}', c) for top, c in zip(BUCKETS, s.buckets)]
            each += [(f'doc_process_seconds_bucket{{stage="{n}",le="+Inf"}}', s.rows), (f'doc_process_seconds_sum{{stage="{n}"}}', s.row_seconds)]
            each += [(f'doc_process_seconds_count{{stage="{n}"}}', s.rows)]
        metric("doc_process_seconds", "histogram", "Seconds for each document.", each)
        return "\n".join(lines) + "\n"

    def serve(self, port: int = 8000, host: str = "127.0.0.1") -> ThreadingHTTPServer:
        """Answer /metrics with text() from a thread of the driver; shutdown() ends it."""
        monitor = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self) -> None:
                found = self.path.split("?")[0] == "/metrics"
                body = monitor.text().encode() if found else b""
                self.send_response(200 if found else 404)
                self.send_header("Content-Type", "text/plain; version=0.0.4")
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *args) -> None:
                pass

        server = ThreadingHTTPServer((host, port), Handler)
        threading.Thread(target=server.serve_forever, daemon=True).start()
        return server


class Progress(StreamingQueryListener):
    """Adds the observed metrics of every batch to a monitor."""

    def __init__(self, monitor: Monitor):
        self.monitor = monitor

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            if name.startswith(PREFIX) and row is not None:
                stage = self.monitor.stage(name[len(PREFIX) :])
                with self.monitor._lock:
                    stage.add(row.asDict())
                    stage.seconds += (event.progress.durationMs or {}).get("triggerExecution", 0) / 1000

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
