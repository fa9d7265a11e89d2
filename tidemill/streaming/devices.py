"""Speed and odometer of devices as a stream: their states kept over micro-batches and restarts.

The batch answer is ``operators.ordered.speed_trace``. Here pulses wait in the state until the watermark
has passed them, so they are taken in order however they arrive within the lateness. Devices are dealt to
shards by a hash, and a shard's devices share one stored value: a call from Python to the state store costs
far more than a pulse. A timer at a shard's earliest waiting pulse wakes it. A device without pulses for over
``idle`` milliseconds begins anew, and a timer then frees its state.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Workers get the processor itself, so they need not have this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARDS = 256  # a stream keeps the number of its first run
VALUE = T.StructType([T.StructField("value", T.BinaryType())])


class SpeedTrace(StatefulProcessor):
    """Waiting pulses of a shard, and per device the speed, odometer, number of steps and time (microseconds) after the last one taken."""

    def __init__(self, device: str, idle: int | None):
        self.device, self.idle = device, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", VALUE)  # a list of device, microseconds, place, delta
        self.traces = handle.getValueState("traces", VALUE)  # speed, odometer, step and time by device

    def _held(self, state, default):
        held = state.get()
        return pickle.loads(bytes(held[0])) if held else default

    def _hold(self, state, value) -> None:
        if value:
            state.update((pickle.dumps(value, pickle.HIGHEST_PROTOCOL),))
        else:
            state.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        pulses = [(device, at, place, delta) for _, device, _, at, place, delta in rows]
        self._hold(self.waiting, self._held(self.waiting, []) + pulses)
        self.handle.registerTimer(_millis(min(p[1] for p in pulses)))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        waiting = self._held(self.waiting, [])
        passed = sorted((p for p in waiting if p[1] <= watermark * 1000), key=lambda p: p[1:3])
        if not passed and self.idle is None:
            return
        traces = self._held(self.traces, {})
        for device, moment, place, delta in passed:
            speed, odometer, step, at = traces.get(device, (0, 0, 0, moment))
            if self.idle is not None and moment - at > self.idle * 1000:
                speed = odometer = step = 0
            speed = max(speed + delta, 0)
            odometer, step = odometer + speed, step + 1
            traces[device] = (speed, odometer, step, moment)
            yield Row(**{self.device: device, "_at": moment, "_place": place, "speed": speed, "odometer": odometer, "step": step})
        if self.idle is not None:
            # A pulse that still waits is beyond the watermark, so that its device begins anew as well.
            traces = {d: t for d, t in traces.items() if _millis(t[3]) + self.idle > watermark}
            if traces:
                self.handle.registerTimer(min(_millis(t[3]) for t in traces.values()) + self.idle)
        self._hold(self.traces, traces)
        if passed:
            waiting = [p for p in waiting if p[1] > watermark * 1000]
            self._hold(self.waiting, waiting)
            if waiting:
                self.handle.registerTimer(_millis(min(p[1] for p in waiting)))

    def close(self) -> None:
        pass


def _millis(micros: int) -> int:
    """The first whole millisecond that is not before."""
    return -(-micros // 1000)


def speed_stream(
    stream: DataFrame, device: str, moment: str, place: str, delta: Column, idle: int | None = None, shards: int = SHARDS,
) -> DataFrame:
    """``device, moment, place, speed, odometer, step, average_speed`` after each pulse of a device.

    ``stream`` belongs to a session of ``session.stateful`` and has a watermark on ``moment``; ``place`` (a
    number) orders pulses of one moment. Pulses later than the watermark are dropped by Spark.
    A null ``delta`` counts as 0; pulses without a moment or place are left out. A task holds the waiting pulses of
    one of the ``shards`` at a time.
    """
    kind = stream.schema[device].dataType
    pulses = stream.filter(F.col(moment).isNotNull() & F.col(place).isNotNull()).select(
        F.pmod(F.xxhash64(device), F.lit(shards)).cast("int").alias("_shard"),
        device, moment, F.unix_micros(moment).alias("_at"), F.col(place).cast("long").alias("_place"),
        F.coalesce(delta, F.lit(0)).cast("long").alias("_delta"),
    )
    names = ("_at", "_place", "speed", "odometer", "step")
    schema = T.StructType([T.StructField(device, kind), *[T.StructField(n, T.LongType()) for n in names]])
    traced = pulses.groupBy("_shard").transformWithState(SpeedTrace(device, idle), schema, "append", "eventTime")
    return traced.select(
        device, F.timestamp_micros("_at").alias(moment), F.col("_place").alias(place), "speed", "odometer", "step",
        (F.col("odometer") / F.col("step")).alias("average_speed"),
    )
