"""No-data alarms: state and timers for each device, on event time.

A device is silent once no reading came for `quiet` seconds: one row says so, and one when it is back. Both are out as soon as
the watermark leaves no doubt, so the rows are the same however readings are dealt to micro-batches, late ones within the
allowed delay included. The watermark moves with the readings of all devices and with ticks; a stream of ticks (`ticks`) makes
alarms due even if every device falls silent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorflow.functions.basic import micros
from sensorflow.session import share_package

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SECOND = 1_000_000


def ticks(spark: SparkSession, time: str = "event_time", per_second: int = 1) -> DataFrame:
    """The clock as a stream: time only."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load().select(F.col("timestamp").alias(time))


def keep_state_on_disk(spark: SparkSession) -> None:
    """Named state and timers need the store that is kept on disk. Holds for queries started later; one that goes on from a
    checkpoint keeps the store it began with."""
    spark.conf.set(STATE_STORE, ROCKSDB)


def no_data_alarms(readings: DataFrame, clock: DataFrame | None = None, window_seconds: int = 300, hold_seconds: int = 180,
                   lateness: str = "60 seconds", time: str = "event_time", key: str = "DeviceId") -> DataFrame:
    """Rows of `kind` 'silent' (at silent_from plus window plus hold) and 'resumed' (at the first reading after it).

    `clock` has `time` only; a reading without key is a tick too. Readings of a device that lie closer than the limit shrink
    to one spell in the task that reads them, before they travel to the state of the device, so a busy device sends a few rows
    a batch. Readings without time are left out.
    """
    keep_state_on_disk(readings.sparkSession)
    share_package(readings.sparkSession)
    quiet = (window_seconds + hold_seconds) * SECOND
    kind = readings.schema[key].dataType.simpleString()
    rows = readings.select(F.col(key).alias("key"), micros(time).alias("at"))
    if clock is not None:
        rows = rows.unionByName(clock.select(F.lit(None).cast(kind).alias("key"), micros(time).alias("at")))
    spells = rows.filter("at IS NOT NULL").mapInArrow(_shrink(quiet), f"key {kind}, started long, ended long")
    spells = spells.withColumn("time", F.timestamp_micros("ended")).withWatermark("time", lateness)
    found = spells.groupBy("key").transformWithState(
        _Silences(quiet), f"key {kind}, kind string, at long, silent_from long", "append", "EventTime")
    return found.select(F.col("key").alias(key), "kind", F.timestamp_micros("at").alias("at"), F.timestamp_micros("silent_from").alias("silent_from"))


def _shrink(quiet: int):
    """Spells of each key among the rows of an Arrow batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).dictionary_encode()
            number = keys.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            at = batch.column(1).to_numpy()
            order = np.lexsort((at, number))
            number, at = number[order], at[order]
            fresh = np.ones(len(at), bool)
            fresh[1:] = (np.diff(number) != 0) | ((np.diff(at) >= quiet) & (number[1:] >= 0))
            first = np.flatnonzero(fresh)
            last = np.append(first[1:], len(at)) - 1
            index = pa.array(number[first], mask=number[first] < 0)
            yield pa.record_batch([keys.dictionary.take(index), pa.array(at[first]), pa.array(at[last])], names=["key", "started", "ended"])

    return run


class _Silences(StatefulProcessor):
    """Open spells of a device in order, and since when it has been reported silent."""

    def __init__(self, quiet: int):
        self.quiet = quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spells = handle.getListState("spells", "started bigint, ended bigint")
        self.mark = handle.getValueState("mark", "silent_from bigint, timer bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        came = [(row.started, row.ended) for row in rows]
        if key[0] is not None:
            yield from self._settled(key, came, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._settled(key, [], timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass

    def _settled(self, key, came: list[tuple[int, int]], now: int) -> Iterator[Row]:
        spells = merged([tuple(s) for s in self.spells.get()] + came, self.quiet) if self.spells.exists() else merged(came, self.quiet)
        silent, timer = self.mark.get() if self.mark.exists() else (None, None)
        found, spells, silent = settle(spells, silent, self.quiet, now)
        due = (spells[0][0] if silent is not None else spells[0][1] + self.quiet) if spells else None
        due = None if due is None else -(-due // 1000)
        if due != timer:
            if timer is not None and timer * 1000 > now:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        if spells:
            self.spells.put(spells)
        else:
            self.spells.clear()
        self.mark.update((silent, due))
        for kind, at, since in found:
            yield Row(key=key[0], kind=kind, at=at, silent_from=since)


def merged(spells: list[tuple[int, int]], quiet: int) -> list[tuple[int, int]]:
    """Spells in order, those closer than the limit joined."""
    made: list[tuple[int, int]] = []
    for start, end in sorted(spells):
        if made and start - made[-1][1] < quiet:
            made[-1] = (made[-1][0], max(made[-1][1], end))
        else:
            made.append((start, end))
    return made


def settle(spells: list[tuple[int, int]], silent: int | None, quiet: int, now: int) -> tuple[list[tuple], list[tuple[int, int]], int | None]:
    """What is certain at `now`, the spells still open, and since when the device is silent."""
    found = []
    while spells:
        start, end = spells[0]
        if silent is not None and start - silent < quiet:  # late rows of a silence that was reported
            spells = spells[1:] if end - silent < quiet else [(silent + quiet, end), *spells[1:]]
        elif silent is not None and start <= now:
            found.append(("resumed", start, silent))
            silent = None
        elif silent is None and end + quiet <= now:
            found.append(("silent", end + quiet, end))
            spells, silent = spells[1:], end
        else:
            break
    return found, spells, silent
