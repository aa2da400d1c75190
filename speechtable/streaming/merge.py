"""Greedy merging over a stream, with the open group as state.

The open group's audio is a list that each trigger appends its rows to, and that is read when the group closes; what every trigger reads and writes is one
small value (first key, length so far, rates). So the state written per trigger does not grow with the group. Lists with cheap appends are the
RocksDB store's, and its change log keeps checkpoints as small: the stream's session is set to both.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from speechtable.operators.merge import target_ticks, ticks

_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
IDLE = ("flush", "drop")


def use_list_state(spark: SparkSession) -> None:
    """Choose the state store that ``merge_to_length_stream`` needs, for streams this session starts."""
    for name, value in _STORE.items():
        spark.conf.set(name, value)


class _Merger(StatefulProcessor):
    """One group of ``by`` values: rows in, closed groups out."""

    def __init__(self, target: int, seconds: float, waves: int, rates: int, rate_at: list[int], columns: list[str], idle: float | None, flush: bool, ttl: float | None):
        self.target, self.seconds, self.waves, self.rates, self.rate_at, self.columns = target, seconds, waves, rates, rate_at, columns
        self.idle, self.flush, self.ttl = idle, flush, None if ttl is None else int(1000 * ttl)

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", ", ".join(["key string", "ticks bigint", "n int", "timer bigint", *[f"r{i} int" for i in range(self.rates)]]), self.ttl)
        self.audio = handle.getListState("audio", ", ".join(f"w{i} binary" for i in range(self.waves)), self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # A group's rows of one micro-batch, bounded by the files a trigger admits.
        rows = pd.concat(list(rows)).sort_values("place", kind="stable")
        keys, sizes = rows["key"].to_numpy(), rows["ticks"].to_numpy(dtype=np.int64)
        audio = [[np.asarray(x, dtype=float) for x in rows[f"w{i}"]] for i in range(self.waves)]
        own = [rows[f"r{i}"].to_numpy() for i in range(self.rates)]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        held = self.open.get() if self.open.exists() else None
        first, total, count, timer, *rates = held or (None, 0, 0, None)
        opened, at, done = held is not None, 0, []
        while True:
            # The row with which the running length reaches the target closes the group.
            close = at + 1 + int(np.searchsorted(upto[at + 1 :], upto[at] + self.target - total, "left"))
            if close > len(rows):
                break
            if not opened:
                first, rates = keys[at], [int(r[at]) for r in own]
            kept = self._kept() if opened and held is not None else [[] for _ in audio]
            whole = [np.concatenate([*k, *column[at:close]]) for k, column in zip(kept, audio)]
            done.append(self._row(key[0], first, whole, rates, count + sum(len(x) > 0 for x in audio[0][at:close])))
            if held is not None:
                self.audio.clear()
                held = None
            first, total, count, opened, at = None, 0, 0, False, close
        if at < len(rows):
            if not opened:
                first, rates, opened = keys[at], [int(r[at]) for r in own], True
            self.audio.appendValue(tuple(np.concatenate(column[at:]).tobytes() for column in audio))
            total += int(upto[-1] - upto[at])
            count += sum(len(x) > 0 for x in audio[0][at:])
        if self.idle is not None:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = timerValues.getCurrentProcessingTimeInMs() + int(1000 * self.idle) if opened else None
            if timer is not None:
                self.handle.registerTimer(timer)
        if opened:
            self.open.update((first, total, count, timer, *rates))
        else:
            self.open.clear()
        if done:
            yield pd.DataFrame(done, columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The group has been idle: what is there leaves as a shorter row, or is forgotten."""
        if self.open.exists():
            first, _, count, timer, *rates = self.open.get()
            if timer == expiredTimerInfo.getExpiryTimeInMs():
                if self.flush:
                    yield pd.DataFrame([self._row(key[0], first, [np.concatenate(k) for k in self._kept()], rates, count)], columns=self.columns)
                self.open.clear()
                self.audio.clear()

    def _kept(self) -> list[list[np.ndarray]]:
        """Parts of the open group, for each waveform."""
        return [list(parts) for parts in zip(*([np.frombuffer(w) for w in part] for part in self.audio.get()))]

    def _row(self, by, first, whole: list[np.ndarray], rates: list[int], count: int) -> tuple:
        cut = [w[: int(self.seconds * rates[r])] for w, r in zip(whole, self.rate_at)]
        return (by, first, *cut, *rates, count)

    def close(self) -> None:
        pass


def merge_to_length_stream(
    df: DataFrame, seconds: float, by: str, col: str | Sequence[str] = "samples", order: str = "ordinal", key: str = "key",
    rate: str = "sample_rate", rates: dict[str, str] | None = None, idle_seconds: float | None = None, on_idle: str = "flush",
    ttl_seconds: float | None = None,
) -> DataFrame:
    """Merged rows (by, key, waveforms, rates, n_members) per ``by``; an unfinished group stays open.

    Like the batch form: the first waveform decides the grouping, key and rates come from a group's first row, ``rates`` names
    the rate column per waveform (``rate`` by default), and n_members counts rows that are not empty. Rows must arrive in ``order`` from one
    micro-batch to the next. State is one open group per ``by``: less than ``seconds`` of audio plus a row. Split a hot stream
    by a finer ``by`` column (source file, lane): groups never span its values.

    A group without new rows for ``idle_seconds`` leaves as it is (``on_idle="flush"``) or is forgotten (``"drop"``) at the next trigger with data;
    state not written for ``ttl_seconds`` is deleted without a trace. Neither applies by default. Triggers without data are then switched off in the
    session, since timers on the clock would make a run over the available input go on for ever.
    """
    if on_idle not in IDLE:
        raise ValueError(f"on_idle must be one of {IDLE}")
    use_list_state(df.sparkSession)
    cols = [col] if isinstance(col, str) else list(col)
    rate_of = {c: (rates or {}).get(c, rate) for c in cols}
    rate_cols = sorted(set(rate_of.values()))
    rows = df.select(
        F.col(by), F.col(order).alias("place"), F.col(key).cast("string").alias("key"),
        *[F.coalesce(F.col(c).cast("array<double>"), F.array().cast("array<double>")).alias(f"w{i}") for i, c in enumerate(cols)],
        *[F.col(c).cast("int").alias(f"r{i}") for i, c in enumerate(rate_cols)],
        ticks(F.size(cols[0]), F.col(rate_of[cols[0]])).alias("ticks"),
    )
    kind = df.schema[by].dataType.simpleString()
    out = ", ".join([f"`{by}` {kind}", "key string", *[f"`{c}` array<double>" for c in cols], *[f"`{c}` int" for c in rate_cols], "n_members int"])
    merger = _Merger(
        target_ticks(seconds), seconds, len(cols), len(rate_cols), [rate_cols.index(rate_of[c]) for c in cols],
        [by, "key", *cols, *rate_cols, "n_members"], idle_seconds, on_idle == "flush", ttl_seconds)
    mode = "none" if idle_seconds is None and ttl_seconds is None else "processingTime"
    if mode == "processingTime":
        df.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return rows.groupBy(by).transformWithStateInPandas(merger, out, "append", mode)
