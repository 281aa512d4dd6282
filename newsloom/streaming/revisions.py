"""The revision state machine over a stream that starts from the stored mart.

transformWithState holds one small row a url: its initial state is what the mart has, and an
event-time timer drops a url that nothing has arrived for. It needs the RocksDB state store
(see ROCKSDB).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from newsloom.operators.state import classify

#: The session's setting for streams with timers; set it before the stream starts.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
_STATE = "content_hash string, revision int, source_id string, body_level int, due long"
DECIDED = "url string, seq long, decision string, revision int"


class Revisions(StatefulProcessor):
    """Decides on each arrival of a url, in order of (turn, seq) within a micro-batch."""

    def __init__(self, idle_ms: int | None) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", _STATE)

    def _store(self, last: tuple, seen_ms: int, had: int | None) -> None:
        """last and when it is due to be dropped; the timer before, which was due at had, is replaced."""
        due = max(seen_ms + self.idle_ms, had or 0) if self.idle_ms else 0
        if self.idle_ms and due != had:
            if had:
                self.handle.deleteTimer(had)
            self.handle.registerTimer(due)
        self.state.update((*last, due))

    def handleInitialState(self, key: Any, initialState: Row, timerValues: TimerValues) -> None:
        r = initialState
        self._store((r.content_hash, int(r.revision), r.source_id, int(r.body_level)), int(r.seen_ms), None)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        stored = self.state.get()
        last, had = (tuple(stored)[:4], stored[4]) if stored is not None else (None, None)
        arrived = sorted(rows, key=lambda r: (r.turn, r.seq))  # one url's arrivals of one micro-batch
        out = []
        for r in arrived:
            decision, last = classify(last, r.content_hash, r.source_id, int(r.body_level))
            out.append(Row(url=key[0], seq=int(r.seq), decision=decision, revision=int(last[1])))
        self._store(last, max(r.seen_ms for r in arrived), had)
        return iter(out)

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def revisions_from(items: DataFrame, seen: DataFrame | None = None, idle_days: float | None = None, late: str = "2 days", last_sources: list[str] = ()) -> DataFrame:
    """url, seq, decision and revision of each arrival, in append mode.

    items: url, seq, content_hash, source_id, body_level, fetched_at; a stream. seen: the stored
    state, a row a url: url, content_hash, revision, source_id, body_level, fetched_at. Arrivals of
    last_sources come after all others of a micro-batch, as in the batch fold. idle_days: a url
    that neither arrives nor is stored for so long, by the watermark, is forgotten; none is
    forgotten without it.
    """
    seen_ms = F.unix_millis(F.col("fetched_at").cast("timestamp")).alias("seen_ms")
    turn = F.when(F.col("source_id").isin(list(last_sources)), 2).otherwise(1).alias("turn")
    rows = items.where("url IS NOT NULL").withWatermark("fetched_at", late).select("url", F.col("seq").cast("long").alias("seq"), "content_hash", "source_id", "body_level", "fetched_at", seen_ms, turn)
    stored = None
    if seen is not None:
        stored = seen.select("url", "content_hash", F.col("revision").cast("int").alias("revision"), "source_id", "body_level", seen_ms).groupBy("url")
    idle_ms = round(idle_days * 86_400_000) if idle_days else None
    return rows.groupBy("url").transformWithState(Revisions(idle_ms), DECIDED, "append", "eventTime", initialState=stored)
