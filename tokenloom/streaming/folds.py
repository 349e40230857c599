"""Folds over unbounded series: rows wait in Spark's state until the watermark has passed them, then go in by time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tokenloom.functions.vectors import doubles
from tokenloom.operators.series import Cell

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which processors with several states need."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class OrderedFold(StatefulProcessor):
    """Per key: the folded state, and the rows that still wait, by time slot.

    A slot is folded when the watermark reaches its end. One timer tells so, that
    of the first slot that waits, and then all slots that are over go in at once.
    Their rows are put in order only then, slot by slot, so what a task holds is
    one slot of one key, whatever an arrival brings. A row whose slot is over is
    late.
    """

    def __init__(self, key: str, places: Sequence[str], cell: Cell, hidden: int, slot: int):
        self.key, self.places, self.cell, self.hidden, self.slot = key, list(places), cell, hidden, slot

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.folded = handle.getValueState(
            "folded", "h array<double>, n_steps bigint, n_late bigint, n_pending bigint, version bigint"
        )
        held = ", ".join(f"{name} array<bigint>" for name in self.places)
        self.waiting = handle.getMapState("waiting", "slot bigint", f"{held}, x array<array<double>>")

    def _now(self) -> list:
        state = self.folded.get()
        return list(state) if state is not None else [[0.0] * self.hidden, 0, 0, 0, 0]

    def _keep(self, key: tuple, now: list) -> pd.DataFrame:
        now[4] += 1
        self.folded.update((now[0], *map(int, now[1:])))
        out = pd.DataFrame({"h": [now[0]], "n_steps": [now[1]], "n_late": [now[2]], "n_pending": [now[3]], "version": [now[4]]})
        out.insert(0, self.key, pd.Series([key[0]], dtype=object))
        return out

    def _wake(self, number: int) -> None:
        self.handle.registerTimer((number + 1) * self.slot)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now, passed = self._now(), timerValues.getCurrentWatermarkInMs()
        known = {slot for (slot,) in self.waiting.keys()} if now[3] else set()
        first = min(known, default=None)
        for frame in rows:
            slots = frame["row_ms"].to_numpy() // self.slot
            late = ~frame["row_known"].to_numpy(dtype=bool) | ((slots + 1) * self.slot <= passed) & (passed > 0)
            now[2] += int(late.sum())
            kept = np.flatnonzero(~late)
            kept = kept[np.argsort(slots[kept], kind="stable")]
            slots, x = slots[kept], frame["row_x"].to_numpy()[kept]
            columns = [frame[name].to_numpy()[kept] for name in self.places]
            cuts = [0, *(np.flatnonzero(np.diff(slots)) + 1), len(kept)] if len(kept) else [0]
            for start, stop in zip(cuts, cuts[1:]):
                number = int(slots[start])
                held = self.waiting.getValue((number,)) if number in known else [[] for _ in range(len(columns) + 1)]
                new = [c[start:stop].tolist() for c in columns] + [[list(map(float, v)) for v in x[start:stop]]]
                self.waiting.updateValue((number,), tuple(list(old) + more for old, more in zip(held, new, strict=True)))
                known.add(number)
            now[3] += len(kept)
        if known and (first is None or min(known) < first):
            self._wake(min(known))
        yield self._keep(key, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over = timerValues.getCurrentWatermarkInMs() // self.slot
        numbers = sorted(slot for (slot,) in list(self.waiting.keys()))
        ended = [number for number in numbers if number < over]
        if not ended:
            return
        now = self._now()
        moved = np.array([now[0]], dtype=float)
        for number in ended:
            *places, x = self.waiting.getValue((number,))
            for at in np.lexsort([np.array(p, dtype=np.int64) for p in reversed(places)]):
                moved = self.cell(moved, np.array([x[at]], dtype=float))
            now[1], now[3] = now[1] + len(x), now[3] - len(x)
            self.waiting.removeKey((number,))
        now[0] = moved[0].tolist()
        if len(ended) < len(numbers):
            self._wake(numbers[len(ended)])
        yield self._keep(key, now)

    def close(self) -> None:
        pass


def fold_stream(
    stream: DataFrame,
    key: str,
    time: str,
    order: Sequence[str],
    features: Column,
    cell: Cell,
    hidden: int,
    path: str,
    delay: str,
    slot: timedelta = timedelta(minutes=1),
) -> None:
    """Recurrent fold over each key's rows in the order of `time` and `order`, whatever order they arrive in.

    Rows wait for `delay` of event time, in slots of a fixed length, and are
    folded once the watermark has reached the end of their slot. Rows whose
    slot was over before they came, and rows without a time, cannot be folded
    in any more and are counted in `n_late`. A restart below the same `path`
    goes on where the last run ended. `fold_states` reads the results.
    """
    width = slot // timedelta(milliseconds=1)
    if width < 1:
        raise ValueError("a slot lasts a millisecond or more")
    zero = F.lit(0).cast("bigint")
    kinds = {c: stream.schema[c].dataType.typeName() for c in order}
    names = ["place", *[f"place{i}" for i in range(len(order))]]  # none may begin with an underscore
    places = [F.unix_micros(time), *[F.unix_micros(c) if kinds[c] == "timestamp" else F.col(c).cast("bigint") for c in order]]
    # Only numbers made of the time go on: Spark drops late rows where the watermarked column itself does.
    rows = stream.withWatermark(time, delay).select(
        F.col(key).alias("row_key"),
        F.coalesce(F.unix_millis(time), zero).alias("row_ms"),
        F.col(time).isNotNull().alias("row_known"),
        *[F.coalesce(p, zero).alias(n) for p, n in zip(places, names)],
        doubles(features).alias("row_x"),
    )
    kind = stream.schema[key].dataType.simpleString()
    states = rows.groupBy("row_key").transformWithStateInPandas(
        OrderedFold(key, names, cell, hidden, width),
        f"`{key}` {kind}, h array<double>, n_steps bigint, n_late bigint, n_pending bigint, version bigint",
        "Update",
        "EventTime",
    )

    def one_chunk(chunk: DataFrame, number: int) -> None:
        chunk.write.mode("overwrite").parquet(f"{path}/chunk={number}")

    with _state_on_disk(stream.sparkSession):
        query = (
            states.writeStream.foreachBatch(one_chunk)
            .outputMode("update")
            .option("checkpointLocation", f"{path}-progress")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()


def fold_states(spark: SparkSession, key: str, path: str) -> DataFrame:
    """The latest state of every key: key, n_steps, n_late, n_pending (rows that still wait), h."""
    latest = F.max_by(F.struct("n_steps", "n_late", "n_pending", "h"), "version").alias("_s")
    return spark.read.parquet(path).groupBy(key).agg(latest).select(key, "_s.*")
