"""Window aggregates of a topic read in any order and in batches of any size.

A watermark needs rows in order of time: one batch that runs ahead closes windows that
the next still fills. Here no batch closes anything. Each batch adds one segment of
mergeable rows to a table of partials; after a run has drained the topic, ``close``
merges the partials of the windows whose grace period is over on the clock and sends
them. So every reading that was on time counts, the last windows come out without newer
data, and readings dated ahead wait in the table until their window is due.

A reading that was on time, but could be read only after its window was sent, is
``missed``: it is counted and kept as a correction, and never stops the stream or changes a window that was sent.

Segments are merged in tiers, and rows of windows that were sent leave the table in a
merge, so a closing opens few files however many flushes there were. ``manifest`` says
what the table consists of; one writer at a time.

Files below ``root``: ``partials`` (segments, by fate ``kept``, ``late``, ``missed``),
``manifest``, ``aggregates`` (the topic) and ``checkpoint``.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stationflow import schemas as S
from stationflow.functions.times import micros
from stationflow.operators.windows import is_late, merge_partials, partial_columns, window_start
from stationflow.sources import files
from stationflow.sources.topics import TOPIC_FILE, append_topic
from stationflow.streaming import manifest as M
from stationflow.streaming.aggregate import PARTITION_SKEW, aggregates_topic
from stationflow.streaming.batches import named_batches

_TOTALS = "scope string, window_start timestamp, total bigint, min_temp_c double, max_temp_c double, `count` bigint"
# With duplicates dropped a row is a reading: its first delivery so far.
_FIRSTS = (
    "window_start timestamp, sensor_id string, ts timestamp,"
    " first struct<`partition`: int, `offset`: bigint, scope: string, temp_c: double>, `count` bigint"
)
_FOLDERS = ", segment string, fate string"

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _us(moment: datetime) -> int:
    return micros(moment - _EPOCH)


def _moment(us: int) -> Column:
    return F.timestamp_micros(F.lit(us))


def _table(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A Parquet folder, empty as long as nothing was written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _segments(spark: SparkSession, root: str, state: M.Manifest, names: Sequence[str], fate: str) -> DataFrame:
    """Rows of one fate of the named segments."""
    schema = (_FIRSTS if state.first_only else _TOTALS) + _FOLDERS
    if not names:
        return spark.createDataFrame([], schema)
    base = f"{root}/partials"
    paths = [f"{base}/segment={name}/fate={fate}" for name in names]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def _shrunk(rows: DataFrame, scope: Column, size: timedelta, first_only: bool, *more: Column) -> DataFrame:
    """The mergeable rows of a batch of readings."""
    if not first_only:
        return rows.groupBy(scope.alias("scope"), window_start(size).alias("window_start"), *more).agg(*partial_columns())
    first = F.min(F.struct("partition", "offset", scope.alias("scope"), "temp_c")).alias("first")
    return rows.groupBy(window_start(size).alias("window_start"), "sensor_id", "ts", *more).agg(first, F.count(F.lit(1)).alias("count"))


def _merged(rows: DataFrame, first_only: bool, *more: str) -> DataFrame:
    """Fewer rows that say the same, in whatever order and parts they came."""
    total = F.sum("count").alias("count")
    if first_only:
        return rows.groupBy("window_start", "sensor_id", "ts", *more).agg(F.min("first").alias("first"), total)
    return rows.groupBy("scope", "window_start", *more).agg(
        F.sum("total").alias("total"), F.min("min_temp_c").alias("min_temp_c"), F.max("max_temp_c").alias("max_temp_c"), total
    )


def _windows(rows: DataFrame, first_only: bool, size: timedelta) -> DataFrame:
    """Aggregates of partials."""
    if first_only:
        firsts = _merged(rows, True).select("window_start", "first.scope", "first.temp_c")
        rows = firsts.groupBy("scope", "window_start").agg(*partial_columns())
    return merge_partials(rows, size)


def aggregates(spark: SparkSession, root: str) -> DataFrame:
    """The topic's rows; none before the first window is sent."""
    return _table(spark, f"{root}/aggregates", TOPIC_FILE).select(*S.TOPIC_ROW.names)


def _write_segment(spark: SparkSession, root: str, name: str, rows: DataFrame, tier: int) -> tuple[M.Segment | None, dict[str, int]]:
    """Write ``rows`` (with ``fate``) as a segment, over what is there; its entry and its counts by fate."""
    path = f"{root}/partials/segment={name}"
    # One file for each fate unless there are very many windows.
    rows.hint("rebalance").write.mode("overwrite").partitionBy("fate").parquet(path)
    start = F.unix_micros("window_start")
    # What was written is read back: exact, however often a task of the write ran.
    found = {
        row.fate: row
        for row in _table(spark, path, "window_start timestamp, `count` bigint, fate string")
        .groupBy("fate")
        .agg(F.sum("count").alias("n"), F.min(start).alias("first"), F.max(start).alias("last"))
        .collect()
    }
    counts = {fate: row.n for fate, row in found.items()}
    kept = found.get("kept")
    if not kept and "missed" not in found:
        return None, counts
    return M.Segment(name, tier, kept and kept.first, kept and kept.last, "missed" in found), counts


def _checked(state: M.Manifest, span: timedelta, first_only: bool) -> M.Manifest:
    if state.span_us is not None and (state.span_us, state.first_only) != (micros(span), first_only):
        raise ValueError("this table of partials was begun with another window size, grace period or drop_duplicates")
    return state


def start_partials(
    readings: DataFrame,
    root: str,
    checkpoint: str,
    size: timedelta = S.WINDOW_SIZE,
    grace: timedelta = S.GRACE,
    scope: Column | None = None,
    drop_duplicates: bool = False,
) -> StreamingQuery:
    """Read what the stream (``ts, temp_c, arrival_ts``) offers now and add its partials.

    Rows are late by their own arrival. With ``drop_duplicates`` (which needs ``sensor_id,
    partition, offset`` too) the first delivery of each ``(sensor_id, ts)`` counts, in
    whatever order and batches they come. A batch that runs again was added before: it is
    passed over.
    """
    spark = readings.sparkSession
    named = F.lit(S.NATIONAL) if scope is None else scope

    def body(batch: DataFrame, name: str) -> None:
        query, _, number = name.rpartition("-")
        state = _checked(M.read(spark, root), size + grace, drop_duplicates)
        if state.applied.get(query, -1) >= int(number):
            return
        fate = F.when(is_late(size, grace), F.lit("late"))
        # By the windows that were sent, not by a clock: a window not sent yet takes the row.
        if state.closed_start_us is not None:
            fate = fate.when(window_start(size) <= _moment(state.closed_start_us), F.lit("missed"))
        rows = _shrunk(batch, named, size, drop_duplicates, fate.otherwise(F.lit("kept")).alias("fate"))
        segment, counts = _write_segment(spark, root, name, rows, 0)
        M.commit(
            spark, root, state,
            span_us=micros(size + grace), first_only=drop_duplicates, applied={**state.applied, query: int(number)},
            segments=state.segments + ((segment,) if segment else ()), counts=state.counted(**counts),
        )

    writer = readings.writeStream.foreachBatch(named_batches(spark, checkpoint, body))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def due(
    spark: SparkSession, root: str, state: M.Manifest, upto_us: int, size: timedelta
) -> tuple[DataFrame, list[str]]:
    """Windows whose end plus grace is over at ``upto`` and that were not sent, and the segments that were opened for them."""
    after, last = state.closed_start_us, upto_us - state.span_us
    names = [s.name for s in state.segments if s.holds(after, last)]
    rows = _segments(spark, root, state, names, "kept").where(F.col("window_start") <= _moment(last))
    if after is not None:
        rows = rows.where(F.col("window_start") > _moment(after))
    return _windows(rows, state.first_only, size), names


def close(
    spark: SparkSession, root: str, upto: datetime, size: timedelta = S.WINDOW_SIZE, grace: timedelta = S.GRACE
) -> None:
    """Send every window that became due since the last closing, each once.

    The moment is written down before the windows are sent, and again after. A run that
    broke off in between is repeated first, with the same moment and batch name, so it
    replaces its own rows.
    """
    state = finish_closing(spark, root, size, grace)
    if state.span_us is None or (state.upto_us is not None and _us(upto) <= state.upto_us):
        return
    M.commit(spark, root, state, closing=(state.closings + 1, _us(upto)))
    finish_closing(spark, root, size, grace)


def finish_closing(spark: SparkSession, root: str, size: timedelta = S.WINDOW_SIZE, grace: timedelta = S.GRACE) -> M.Manifest:
    """Send the windows of a closing that was begun, if there is one."""
    state = M.read(spark, root)
    if state.closing is None:
        return state
    _checked(state, size + grace, state.first_only)
    number, moment = state.closing
    rows, opened = due(spark, root, state, moment, size)
    if opened:
        append_topic(aggregates_topic(rows, _moment(moment)), f"{root}/aggregates", f"closing-{number}")
    return M.commit(spark, root, state, closings=number, upto_us=moment, closing=None)


def compact(spark: SparkSession, root: str, fan: int = M.FAN) -> int:
    """Merge tiers that have ``fan`` segments, lowest first; how many merges there were.

    The merged segment is written, then the manifest names it in place of its parts; the
    parts are deleted by the merge after it, so a reader of the version before still finds
    them. A run that broke off anywhere is simply run again.
    """
    done = 0
    while True:
        state = M.read(spark, root)
        if state.closing is not None:
            raise ValueError("finish the closing first: its segments must stay as they are")
        members = M.to_merge(state.segments, fan)
        if not members:
            return done
        for name in state.garbage:
            files.delete(spark, f"{root}/partials/segment={name}")
        kept = _segments(spark, root, state, [s.name for s in members if s.first_us is not None], "kept")
        if state.closed_start_us is not None:
            # Windows that were sent leave the table.
            kept = kept.where(F.col("window_start") > _moment(state.closed_start_us))
        missed = _segments(spark, root, state, [s.name for s in members if s.missed], "missed")
        rows = _merged(kept.unionByName(missed), state.first_only, "fate")
        name = f"merged-{state.merges + 1}"
        merged, _ = _write_segment(spark, root, name, rows, members[0].tier + 1)
        gone = {s.name for s in members}
        M.commit(
            spark, root, state,
            segments=tuple(s for s in state.segments if s.name not in gone) + ((merged,) if merged else ()),
            garbage=tuple(sorted(gone)), merges=state.merges + 1,
        )
        done += 1


def drain(
    readings: DataFrame,
    root: str,
    size: timedelta = S.WINDOW_SIZE,
    grace: timedelta = S.GRACE,
    scope: Column | None = None,
    now: datetime | None = None,
    settle: timedelta = PARTITION_SKEW,
    drop_duplicates: bool = False,
    fan: int = M.FAN,
) -> None:
    """One flush: read all the topic offers, send the windows that are due, tidy up.

    The clock is read before the topic. ``settle`` is the longest time from a row's
    arrival stamp until readers of the topic can see it; a row that takes longer may be
    missed. ``start_flushes`` runs it on a timer.
    """
    spark = readings.sparkSession
    upto = (now or datetime.now(timezone.utc)) - settle
    # Rows read from here on are judged by all closings, also by one that broke off.
    finish_closing(spark, root, size, grace)
    start_partials(readings, root, f"{root}/checkpoint", size, grace, scope, drop_duplicates).awaitTermination()
    close(spark, root, upto, size, grace)
    compact(spark, root, fan)


class Flushes:
    """Flushes on a timer, in a thread of their own, until ``stop`` or an error."""

    def __init__(self, flush: Callable[[], None], period: timedelta):
        self._flush, self._period = flush, period.total_seconds()
        self._stopped = threading.Event()
        self._error: BaseException | None = None
        self.done = 0
        self._thread = threading.Thread(target=self._run, name="flushes", daemon=True)
        self._thread.start()

    def _run(self) -> None:
        try:
            while not self._stopped.is_set():
                begin = datetime.now(timezone.utc)
                self._flush()
                self.done += 1
                # A flush that took longer than the period is followed by the next at once.
                spent = (datetime.now(timezone.utc) - begin).total_seconds()
                self._stopped.wait(max(0.0, self._period - spent))
        except BaseException as error:  # noqa: BLE001  (raised again where it is waited for)
            self._error = error

    @property
    def is_active(self) -> bool:
        return self._thread.is_alive()

    def await_termination(self, timeout: float | None = None) -> bool:
        """Wait for the end; whether it came. The error of a flush is raised here."""
        self._thread.join(timeout)
        if self._error is not None:
            raise self._error
        return not self._thread.is_alive()

    def stop(self) -> None:
        """End after the flush that is running."""
        self._stopped.set()
        self.await_termination()


def start_flushes(readings: DataFrame, root: str, period: timedelta = S.FLUSH_PERIOD, **options) -> Flushes:
    """``drain`` every ``period``: windows come out on the clock, with or without new rows."""
    return Flushes(lambda: drain(readings, root, **options), period)


def corrections(spark: SparkSession, root: str, size: timedelta = S.WINDOW_SIZE) -> DataFrame:
    """Aggregates of the missed readings of each window: what it would have held besides."""
    state = M.read(spark, root)
    rows = _segments(spark, root, state, [s.name for s in state.segments if s.missed], "missed")
    return _windows(rows, state.first_only, size)


def balance(spark: SparkSession, root: str, sent: DataFrame) -> DataFrame:
    """What became of the readings: counted in the windows of ``sent``, waiting, late or missed.

    ``sent`` are the decoded windows of the topic. With the rows offered this is a check
    that nothing was lost: the four add up to them (with duplicates dropped, to no more
    than them).
    """
    state = M.read(spark, root)
    held = _segments(spark, root, state, [s.name for s in state.segments if s.first_us is not None], "kept")
    if state.closed_start_us is not None:
        held = held.where(F.col("window_start") > _moment(state.closed_start_us))
    counts = [rows.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).select(F.lit(fate).alias("fate"), "n") for rows, fate in ((sent, "sent"), (held, "waiting"))]
    known = spark.createDataFrame([(fate, state.counts.get(fate, 0)) for fate in ("late", "missed")], "fate string, n bigint")
    return counts[0].unionByName(counts[1]).unionByName(known)
