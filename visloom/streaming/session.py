"""A capture session: named streaming queries with several receivers, start and stop."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)


class Status(Enum):
    INIT = "init"
    CAPTURING = "capturing"
    COMPLETE = "complete"


class Health(Enum):
    OK = "ok"
    DEGRADED = "degraded"
    FAIL = "fail"


class CaptureSession:
    """Runs products as streaming queries. Each closed batch goes to all receivers; a receiver that fails is
    logged and does not stop the others or the query. Receivers that have ``begin`` and ``end`` are told of the capture block before
    its first and after its last batch.

    ``grace``: seconds that a stop waits for what has arrived to be worked off."""

    def __init__(self, checkpoint: str, grace: float = 5.0) -> None:
        self.checkpoint, self.grace = checkpoint, grace
        self._lock = threading.Lock()
        self._stopping: threading.Event | None = None
        self.status = Status.INIT
        self.health = Health.OK
        self.block: str | None = None
        self._receivers: dict[str, Callable[[DataFrame, int], None]] = {}
        self._queries: dict[str, StreamingQuery] = {}

    def add_receiver(self, name: str, sink: Callable[[DataFrame, int], None]) -> None:
        if name in self._receivers:
            raise ValueError(f"receiver {name} is already there")
        self._receivers[name] = sink

    def drop_receiver(self, name: str) -> None:
        if name not in self._receivers:
            raise ValueError(f"no receiver {name}")
        del self._receivers[name]

    def _send(self, batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for name, sink in list(self._receivers.items()):
                try:
                    sink(batch, epoch)
                except Exception:
                    self.health = Health.DEGRADED
                    log.exception("receiver %s failed on batch %d", name, epoch)
        finally:
            batch.unpersist()

    def _mark(self, marker: str) -> None:
        for name, sink in list(self._receivers.items()):
            try:
                getattr(sink, marker, lambda block: None)(self.block)
            except Exception:
                self.health = Health.DEGRADED
                log.exception("receiver %s failed at the %s of %s", name, marker, self.block)

    def start(self, block: str, products: dict[str, DataFrame], available_now: bool = False, mode: str = "append") -> None:
        with self._lock:
            if self.status is Status.CAPTURING:
                raise RuntimeError("already capturing")
            self.block, self.status, self.health = block, Status.CAPTURING, Health.OK
        self._mark("begin")
        for name, product in products.items():
            writer = product.writeStream.foreachBatch(self._send).outputMode(mode).option("checkpointLocation", f"{self.checkpoint}/{block}/{name}")
            self._queries[name] = (writer.trigger(availableNow=True) if available_now else writer).start()

    def join(self) -> None:
        """Wait until all queries have ended by themselves, as bounded ones do."""
        for query in self._queries.values():
            query.awaitTermination()

    def _drain(self) -> None:
        """Let the queries work off what has arrived, for so long as the grace lasts."""

        def work(query: StreamingQuery) -> None:
            try:
                query.processAllAvailable()
            except Exception:
                log.warning("query %s ended while it was stopped", query.id, exc_info=True)

        waits = [threading.Thread(target=work, args=(q,), daemon=True) for q in self._queries.values() if q.isActive]
        until = time.monotonic() + self.grace
        for t in waits:
            t.start()
        for t in waits:
            t.join(max(0.0, until - time.monotonic()))

    def stop(self) -> bool:
        """End the capture; whether this call did it. Of several at once one does, and the others return when it has."""
        with self._lock:
            if self.status is not Status.CAPTURING:
                raise RuntimeError("not capturing")
            mine = self._stopping is None
            if mine:
                self._stopping = threading.Event()
            done = self._stopping
        if not mine:
            done.wait()
            return False
        try:
            self._drain()
            for query in self._queries.values():
                query.stop()
            self._mark("end")
        finally:
            with self._lock:
                self._queries.clear()
                self.status, self.block, self._stopping = Status.COMPLETE, None, None
            done.set()
        return True
