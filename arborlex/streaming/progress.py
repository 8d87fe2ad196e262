"""Rates of a running job: documents a second, time spent and left."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from arborlex.functions.text import seconds_text

LOGGER = logging.getLogger(__name__)


def counted(df: DataFrame, name: str = "documents") -> tuple[DataFrame, Observation]:
    """df and an observation of how many rows it gave, without another pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def report(done: int, total: int | None, began: float, devices: int = 1, now: float | None = None) -> str:
    """E.g. `10 of 20 documents, 5.00/s, 2s spent, 2s left, 0.00 device hours`."""
    spent = max(1e-9, (time.time() if now is None else now) - began)
    rate = done / spent
    left = f", {seconds_text((total - done) / rate)} left" if total is not None and rate else ""
    return f"{done}{'' if total is None else f' of {total}'} documents, {rate:.2f}/s, {seconds_text(spent)} spent{left}, {spent * devices / 3600:.2f} device hours"


class Ticker:
    """Logs progress every so many seconds from a thread of its own, and how many device
    hours are spent and left, of a budget if there is one. `progress` gives documents
    done and in all (None if unknown); what it raises is logged and nothing more. Use as
    a context."""

    def __init__(self, progress: Callable[[], tuple[int, int | None]], every: float = 300.0, devices: int = 1, budget: float | None = None) -> None:
        if every <= 0 or devices < 1:
            raise ValueError("an interval above 0 and a device at least are needed")
        self.progress, self.every, self.devices, self.budget = progress, every, devices, budget
        self._stop, self._thread = threading.Event(), threading.Thread(target=self._run, name="progress", daemon=True)

    def line(self, spent: float) -> str:
        done, total = self.progress()
        if done < 0 or total is not None and total < 0:
            raise ValueError(f"{done} of {total} documents can't be")
        text = report(done, total, 0.0, self.devices, max(spent, 1e-9))
        if total and done:
            text += f", {max(0, total - done) * spent / done * self.devices / 3600:.2f} to come"
        return text if self.budget is None else f"{text}, {self.budget - spent * self.devices / 3600:.2f} of {self.budget:.2f} left"

    def _run(self) -> None:
        began = time.monotonic()
        while not self._stop.wait(self.every):
            try:
                LOGGER.info("%s", self.line(time.monotonic() - began))
            except Exception:  # telling must not stop what is told about
                LOGGER.exception("no progress to tell")

    def __enter__(self) -> Ticker:
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._stop.set()
        self._thread.join()


class ProgressLog(StreamingQueryListener):
    """Logs rates of each micro-batch and since the start."""

    def __init__(self) -> None:
        self.began, self.done = time.time(), 0

    def onQueryStarted(self, event) -> None:
        self.began = time.time()

    def onQueryProgress(self, event) -> None:
        self.done += event.progress.numInputRows
        LOGGER.info("batch %d: %.2f/s; %s", event.progress.batchId, event.progress.processedRowsPerSecond or 0, report(self.done, None, self.began))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        LOGGER.info("ended: %s", report(self.done, None, self.began))
