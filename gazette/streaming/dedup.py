"""First-seen deduplication with a state that forgets an id after a while."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gazette.functions.text import min_words
from gazette.schemas import MIN_WORDS, SEEN_TTL_HOURS

# The process that sets up the state schema does not get the files a session
# ships to its workers, so the processor travels as code instead of by name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FirstSeen(StatefulProcessor):
    """Emits the first row of a key and remembers the key until the TTL ends.

    The TTL runs from the first sight in processing time; later copies do not
    prolong it. Of the rows that reach a key in one micro-batch the one with
    the smallest order values is the first, nulls before others; only the best one
    so far is held. Without a TTL keys are remembered for good. Keys of an initial state
    count as seen.
    """

    def __init__(self, order: list[str], ttl_hours: float | None):
        self._order = order
        self._ttl_ms = None if ttl_hours is None else int(ttl_hours * 3_600_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "seen boolean", self._ttl_ms)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self._seen.update((True,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if not self._seen.exists():
            self._seen.update((True,))
            yield min(rows, key=lambda row: [(row[c] is not None, row[c]) for c in self._order])

    def close(self) -> None:
        pass


def _first_per_batch(key: str, order: list[str]):
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = pc.sort_indices(
                batch.select(order),
                sort_keys=[(name, "ascending") for name in order],
                null_placement="at_start",
            )
            sorted_keys = pa.table({"key": batch.column(key).take(at), "at": at})
            first = sorted_keys.group_by("key", use_threads=False).aggregate([("at", "first")])
            if len(first) < len(batch):
                batch = batch.take(first["at_first"].combine_chunks())
            yield batch

    return combine


@contextmanager
def no_empty_batches(spark: SparkSession):
    """Start a query with a TTL in here: ``availableNow`` would otherwise never end.

    With a processing-time TTL Spark keeps scheduling empty batches to clean its
    state. A query keeps the settings it is started with; the session gets its own back.
    """
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def first_seen_ttl(
    stream: DataFrame,
    key: str = "article_id",
    order: str | Sequence[str] = "offset",
    ttl_hours: float = SEEN_TTL_HOURS,
    then: Column | None = None,
    combine: bool = True,
) -> DataFrame:
    """Streaming twin of ``operators.dedup.first_seen``.

    All columns pass through the state operator, so select what is needed
    beforehand, and start the query in ``no_empty_batches``. With ``combine``, copies are dropped within each Arrow batch before the
    shuffle, so a key that makes up much of the input sends one row per batch
    to its task instead of all of them.
    """
    names = [order] if isinstance(order, str) else list(order)
    rows = stream.where(stream[key].isNotNull())
    if combine:
        rows = rows.mapInArrow(_first_per_batch(key, names), rows.schema)
    first = rows.groupBy(key).transformWithState(
        statefulProcessor=FirstSeen(names, ttl_hours),
        outputStructType=rows.schema,
        outputMode="Append",
        timeMode="ProcessingTime",
    )
    return first if then is None else first.where(then)


def first_qualifying(
    stream: DataFrame,
    seen: DataFrame | None = None,
    key: str = "article_id",
    order: str | Sequence[str] = "offset",
    qualifies: Column | None = None,
    combine: bool = True,
) -> DataFrame:
    """Streaming twin of ``operators.dedup.label_qualifying``: the rows that it publishes.

    The first copy of a key that qualifies is published, unless the key is in ``seen``; copies
    that do not qualify claim nothing, so they are left out before the state. ``seen`` (the
    key column) is read once, as the initial state of a new query: a query that starts
    again from its checkpoint goes by its own state. Micro-batches must come in order, as those
    of a log do. All columns pass through the state, so select what is needed beforehand.
    """
    names = [order] if isinstance(order, str) else list(order)
    wanted = min_words("body", MIN_WORDS) if qualifies is None else qualifies
    rows = stream.where(stream[key].isNotNull() & F.coalesce(wanted, F.lit(False)))
    if combine:
        rows = rows.mapInArrow(_first_per_batch(key, names), rows.schema)
    known = None
    if seen is not None:
        known = seen.select(key).where(F.col(key).isNotNull()).distinct().groupBy(key)
    return rows.groupBy(key).transformWithState(
        statefulProcessor=FirstSeen(names, None),
        outputStructType=rows.schema,
        outputMode="Append",
        timeMode="None",
        initialState=known,
    )
