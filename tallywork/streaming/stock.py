"""Running stock over a stream of tank changes.

The stock after a change depends on the order of changes in a tank, so a change is held
until the watermark has passed its stretch of time: no earlier one can then arrive. A
tank's state is its stock and, in a map from stretch to changes, what is still held. A timer
at the end of each stretch releases it. A step reads and writes one stretch at a time, so
what it has in memory does not grow with a tank's history or with the delay.

A change that comes when its stretch has been released can no longer be put in order. It
comes out at once, marked late and without a stock.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallywork.sources.sinks import write_batch

_ROW = "{tank} BIGINT, {log} BIGINT, micros BIGINT, change_cents BIGINT, stock_cents BIGINT, late BOOLEAN"
LATE = "late"


class RunningStock(StatefulProcessor):
    """Stock of one tank; ``stretch`` is the length in milliseconds of what is held together."""

    def __init__(self, tank: str, log_id: str, stretch: int):
        self.columns = [log_id, "micros", "change_cents"]
        self.names = [tank, *self.columns, "stock_cents", LATE]
        self.tank, self.log_id, self.stretch = tank, log_id, stretch

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Stock after the changes released so far, and the end (ms) of what was released.
        self.stock = handle.getValueState("stock", "cents BIGINT, released BIGINT")
        self.held = handle.getMapState(
            "held", "stretch BIGINT", "logs ARRAY<BIGINT>, micros ARRAY<BIGINT>, cents ARRAY<BIGINT>"
        )

    def _known(self) -> tuple[int, int | None]:
        return tuple(self.stock.get()) if self.stock.exists() else (0, None)

    def _row(self, key: tuple, rows: pd.DataFrame, stock: object, late: bool) -> pd.DataFrame:
        out = rows.assign(**{self.tank: key[0], "stock_cents": stock, LATE: late})[self.names]
        return out.astype({"stock_cents": "Int64"})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        _, released = self._known()
        timers = set(self.handle.listTimers())
        for frame in rows:
            number = frame["micros"] // (1000 * self.stretch)
            for stretch, part in frame.groupby(number):
                end = (int(stretch) + 1) * self.stretch
                if released is not None and end <= released:
                    yield self._row(key, part[self.columns], pd.NA, True)
                    continue
                before = self.held.getValue((int(stretch),)) if self.held.containsKey((int(stretch),)) else ([], [], [])
                both = (list(old) + part[c].astype(int).tolist() for old, c in zip(before, self.columns, strict=True))
                self.held.updateValue((int(stretch),), tuple(both))
                if end not in timers:
                    self.handle.registerTimer(end)
                    timers.add(end)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        expired = expiredTimerInfo.getExpiryTimeInMs()
        for stretch in sorted(k[0] for k in self.held.keys() if (k[0] + 1) * self.stretch <= expired):
            held = self.held.getValue((stretch,))
            rows = pd.DataFrame(dict(zip(self.columns, held, strict=True)), dtype="int64")
            rows = rows.sort_values(["micros", self.log_id], kind="stable")
            before, _ = self._known()
            totals = before + rows["change_cents"].cumsum()
            self.held.removeKey((stretch,))
            self.stock.update((int(totals.iloc[-1]), (stretch + 1) * self.stretch))
            yield self._row(key, rows, totals, False)

    def close(self) -> None:
        pass


def running_stock_stream(
    changes: DataFrame,
    *,
    tank: str,
    log_id: str,
    at: str,
    change: str,
    delay: str,
    out: str = "remaining_stock",
    stretch_seconds: int = 60,
) -> DataFrame:
    """Each change with the stock after it, in (``at``, ``log_id``) order per tank, and ``late``.

    A change comes out when the watermark, ``delay`` behind the newest change, has passed the
    end of its stretch of ``stretch_seconds``. One that comes after that is late: it comes out
    with a NULL ``out`` and does not enter the stock. ``tank`` and ``log_id`` are integers,
    ``change`` has two decimals. Needs the RocksDB state store (see
    :data:`tallywork.session.SETTINGS`).
    """
    times = F.col(at).cast("timestamp")
    # The operator sees the time as a plain number: of a column that carries the watermark
    # Spark would drop late rows before they are seen.
    keyed = (
        changes.withColumn("_at", times)
        .withWatermark("_at", delay)
        .select(
            F.col(tank).cast("bigint").alias(tank),
            F.col(log_id).cast("bigint").alias(log_id),
            F.unix_micros("_at").alias("micros"),
            (F.col(change) * 100).cast("bigint").alias("change_cents"),
        )
    )
    after = keyed.groupBy(tank).transformWithStateInPandas(
        RunningStock(tank, log_id, 1000 * stretch_seconds),
        outputStructType=_ROW.format(tank=tank, log=log_id),
        outputMode="Append",
        timeMode="EventTime",
    )
    cent = F.lit("0.01").cast("decimal(3,2)")
    return after.select(
        tank,
        log_id,
        F.timestamp_micros("micros").alias(at),
        (F.col("change_cents") * cent).cast("decimal(18,2)").alias(change),
        (F.col("stock_cents") * cent).cast("decimal(18,2)").alias(out),
        LATE,
    )


def write_stock(after: DataFrame, ledger: str, late: str, checkpoint: str):
    """A stream writer of :func:`running_stock_stream` with two outputs: changes with their stock
    go to ``ledger``, late ones to ``late``. A batch that is repeated after a failure replaces
    what its first try wrote (:func:`tallywork.sources.sinks.write_batch`)."""

    def both(batch: DataFrame, number: int) -> None:
        write_batch(batch.filter(~F.col(LATE)).drop(LATE), ledger, number)
        write_batch(batch.filter(LATE).drop(LATE), late, number)

    return after.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
