"""State that streams keep for each key."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_LAST = "timestamp double, id string"


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in the store that processors need; others keep theirs."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _place(time: float | None, ident: str | None) -> tuple:
    """Order by time, then id; what is missing or no number comes first."""
    dated = time is not None and time == time
    return dated, time if dated else 0.0, ident is not None, ident or ""


class _Previous(StatefulProcessor):
    """Keeps the last row of a customer by time and id. Rows come as they are: a frame for each customer would take
    longer than all else that is done for it."""

    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _LAST, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        own = sorted((_place(row.timestamp, row.id), i, row) for i, row in enumerate(rows))
        known = self.last.get()
        seen, before = known and _place(*known), None
        for place, _, row in own:
            # Ties in time and id come after what is known.
            late = seen is not None and place < seen
            if seen is not None and not late:
                before, seen = known[0], None
            yield Row(customer_id=key[0], id=row.id, interaction_type=row.interaction_type, timestamp=row.timestamp,
                      prev_timestamp=before, late=late)
            before = row.timestamp
        if not late:
            self.last.update((row.timestamp, row.id))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        known = self.last.get()
        if known is None or _place(*known) <= _place(initialState.timestamp, initialState.id):
            self.last.update((initialState.timestamp, initialState.id))

    def close(self) -> None:
        pass


def with_last_seen(rows: DataFrame, ttl_ms: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """``rows`` (a stream with ``customer_id, id, interaction_type, timestamp``) with ``prev_timestamp``, the time of
    the customer's row before, whichever batch it came in, and ``late``.

    Rows of a batch are ordered by time, then id. A row that comes before what an earlier batch has left
    is ``late``: it looks back to the late rows of its own batch only, and isn't remembered. A customer
    is forgotten ``ttl_ms`` after the last row, if given. ``initial`` (``customer_id, timestamp, id``) is what
    a new query knows at its start. The rows that a customer has in one batch are ordered in one task;
    ``maxFilesPerTrigger`` of the source bounds them.
    """
    schema = ("customer_id string, id string, interaction_type string, timestamp double, prev_timestamp double, "
              "late boolean")
    return rows.groupBy("customer_id").transformWithState(
        _Previous(ttl_ms), schema, "Append", "ProcessingTime" if ttl_ms else "None",
        initial.groupBy("customer_id") if initial is not None else None)
