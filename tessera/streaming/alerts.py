"""State on running streams: sustained breaches behind a windowed aggregate, suppression of alerts and the history of sessions.

All are stateful processors. A key's rows come in chunks of bounded size and are never put together in memory; what is kept
between batches is a few numbers, and timers or a time to live remove it once it can't matter any more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of a chunk that a processor gets or keeps as one state value.
CHUNK = 8192


def stateful(df: DataFrame) -> DataFrame:
    """Processors keep their state in RocksDB, outside the JVM heap, and get their rows in bounded chunks."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return df


def plain(values: list) -> pd.Series:
    """A column of keys as they are; pandas' own string type does not go back to Spark from here."""
    return pd.Series(values, dtype=object)


# -- sustained breaches ---------------------------------------------------------------------------


class SustainedBreach(StatefulProcessor):
    """Alerts for the windows that end ``run`` consecutive windows above a limit.

    State is the length of the current run and the start of its last window. A timer removes it when the watermark has passed
    the window that would have continued the run.
    """

    def __init__(self, run: int, size_us: int, keys: Sequence[str]):
        self.run, self.size, self.keys = run, size_us, list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", "length bigint, last bigint, expires bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [(p["start_us"].to_numpy(np.int64), p["peak"].to_numpy(float)) for p in rows]  # one row a window
        start, peak = (np.concatenate(c) for c in zip(*parts))
        length, last, expires = self.state.get() if self.state.exists() else (0, None, None)
        fired = []
        for i in np.argsort(start, kind="stable").tolist():
            at = int(start[i])
            if last is not None and at <= last:
                continue
            length = length + 1 if last is not None and at == last + self.size else 1
            last = at
            if length >= self.run:
                fired.append(i)
        if expires is not None:
            self.handle.deleteTimer(expires)
        expires = (last + 2 * self.size) // 1000 + 1
        self.handle.registerTimer(expires)
        self.state.update((length, last, expires))
        if fired:
            yield self._rows(key, pd.to_datetime(start[fired], unit="us", utc=True).tz_localize(None), peak[fired])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists() and self.state.get()[2] <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        yield self._rows(key, pd.to_datetime([], unit="us"), np.zeros(0))

    def _rows(self, key, start, peak) -> pd.DataFrame:
        return pd.DataFrame({**{k: plain([v] * len(peak)) for k, v in zip(self.keys, key)}, "window_start": start, "peak": peak})

    def close(self) -> None:
        pass


def sustained(df: DataFrame, ts: str, value: str, limit: float, run: int, seconds: int, late: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, window_start, peak) of windows whose largest value, and that of the ``run - 1`` windows before, is above a limit.

    For a running stream: a window counts when the watermark, ``late`` behind the newest row, has passed its end. Rows that
    come later than that raise no alert any more. Null values and times don't count, a null key is a key.
    """
    keys = list(keys)
    peaks = df.withWatermark(ts, late).groupBy(F.window(ts, f"{seconds} seconds"), *keys).agg(F.max(F.col(value).cast("double")).alias("peak"))
    hot = peaks.where(F.col("peak") > limit).select(*keys, "window", "peak", F.unix_micros("window.start").alias("start_us"))
    grouped = stateful(hot).groupBy(*keys) if keys else stateful(hot.withColumn("one", F.lit(0))).groupBy("one")
    types = dict(df.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "window_start timestamp", "peak double"])
    return grouped.transformWithStateInPandas(SustainedBreach(run, seconds * 1_000_000, keys), schema, "Append", "EventTime")


# -- suppression ----------------------------------------------------------------------------------

HOUR = 3_600_000_000


class Suppression(StatefulProcessor):
    """Alerts of a key that pass a cooldown and an hourly cap, in the order of time and id within a batch.

    Between batches state is the time, id and count of what was sent last; it expires by its time to live. Within a batch, rows
    are put into slots of time as they come and each slot is searched for the first row that may be sent, chunk by chunk: no
    more than a chunk is in memory. The slots are removed before the batch ends.
    """

    def __init__(self, cooldown_us: int, per_hour: int, ttl_ms: int | None):
        self.cooldown, self.per_hour, self.ttl = cooldown_us, per_hour, ttl_ms
        self.width = min(max(cooldown_us, 60_000_000), HOUR)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sent = handle.getValueState("sent", "ts bigint, id bigint, count int", self.ttl)
        self.slots = handle.getMapState("slots", "slot bigint, part int", "ts array<bigint>, id array<bigint>")

    def _free(self, last: tuple | None) -> int:
        """The earliest time at which the next alert may be sent."""
        if last is None:
            return -(1 << 62)
        return last[0] + max(self.cooldown, HOUR if last[2] >= self.per_hour else 0)

    def _pass(self, last: tuple | None, chunks) -> tuple[tuple | None, list]:
        """Go through the chunks of one slot until no row of it may be sent; ``chunks`` can be read again and again."""
        out = []
        while True:
            free, best = self._free(last), None
            for ts, ids in chunks():
                ok = ts >= free
                if last is not None:
                    ok &= (ts > last[0]) | ((ts == last[0]) & (ids > last[1]))
                if ok.any():
                    ts, ids = ts[ok], ids[ok]
                    least = ts.min()
                    one = (int(least), int(ids[ts == least].min()))
                    best = one if best is None else min(best, one)
            if best is None:
                return last, out
            count = 1 if last is None or best[0] - last[0] > HOUR else last[2] + 1
            last = (*best, count)
            out.append(best)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.sent.get() if self.sent.exists() else None
        held, parts = None, {}
        for pdf in rows:
            for i in range(0, len(pdf), CHUNK):
                ts, ids = pdf["us"].to_numpy(np.int64)[i : i + CHUNK], pdf["alert_id"].to_numpy(np.int64)[i : i + CHUNK]
                early = ts >= self._free(last)  # what can't be sent now can't be sent later
                if not early.any():
                    continue
                if held is not None:
                    self._keep(*held, parts)
                held = ts[early], ids[early]
        if held is None:
            return
        if parts:
            self._keep(*held, parts)
        for last, some in self._searched(last, parts) if parts else [self._pass(last, lambda: [held])]:
            if some:
                self.sent.update(last)
                ts, ids = zip(*some)
                yield pd.DataFrame({"alert_key": plain([key[0]] * len(some)), "alert_id": ids, "ts": pd.to_datetime(ts, unit="us")})

    def _keep(self, ts: np.ndarray, ids: np.ndarray, parts: dict[int, int]) -> None:
        slot = ts // self.width
        for s in np.unique(slot).tolist():
            own = slot == s
            n = parts.get(s, 0)
            self.slots.updateValue((s, n), (ts[own].tolist(), ids[own].tolist()))
            parts[s] = n + 1

    def _searched(self, last, parts: dict[int, int]) -> Iterator[tuple]:
        for s in sorted(parts):

            def chunks(s=s):
                for n in range(parts[s]):
                    ts, ids = self.slots.getValue((s, n))
                    yield np.array(ts, np.int64), np.array(ids, np.int64)

            last, some = self._pass(last, chunks)
            for n in range(parts[s]):
                self.slots.removeKey((s, n))
            yield last, some

    def close(self) -> None:
        pass


def lifetime(hours: float | None) -> tuple[int | None, str]:
    """A time to live in milliseconds and the time mode it needs. A stream with a time to live looks for expired state in
    batches without data, so it is for triggers that go on; ``availableNow`` would never end."""
    return (None, "None") if hours is None else (int(hours * 3_600_000), "ProcessingTime")


def suppress(alerts: DataFrame, cooldown_minutes: float = 15, per_hour: int = 10, ttl_hours: float | None = None) -> DataFrame:
    """Alerts of a stream that get through a cooldown and an hourly cap per key. Input: alert_key, alert_id, ts (timestamp).

    A key's state is three numbers. With ``ttl_hours`` it is removed after that time of processing without an alert sent; from
    an hour on, or the cooldown if that is longer, it has no effect on a stream that keeps up with time (see ``lifetime``).
    Rows without a time or id are left out, null keys are one key.
    """
    cooldown = int(cooldown_minutes * 60_000_000)
    rows = alerts.select("alert_key", F.col("alert_id").cast("bigint").alias("alert_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    rows = stateful(rows.where("alert_id is not null and us is not null"))
    ttl, mode = lifetime(ttl_hours)
    return rows.groupBy("alert_key").transformWithStateInPandas(Suppression(cooldown, per_hour, ttl), "alert_key string, alert_id bigint, ts timestamp", "Append", mode)


# -- sessions -------------------------------------------------------------------------------------


class History(StatefulProcessor):
    """The last messages of a session, as list state that expires after a time without messages."""

    def __init__(self, most: int, ttl_ms: int | None):
        self.most, self.ttl = most, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.messages = handle.getListState("messages", "turn bigint, role string, text string", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = [tuple(m) for m in self.messages.get()] if self.messages.exists() else []
        for pdf in rows:
            turns = [None if pd.isna(t) else int(t) for t in pdf["turn"]]
            kept += zip(turns, pdf["role"], pdf["text"])
            kept = sorted(kept, key=lambda m: (m[0] is not None, m[0] or 0))[-self.most :]
        self.messages.put(kept)
        turns, roles, texts = (list(c) for c in zip(*kept))
        yield pd.DataFrame({"conv_id": [key[0]], "turns": [turns], "roles": [roles], "texts": [texts]})

    def close(self) -> None:
        pass


def session_history(turns: DataFrame, pairs: int, ttl_hours: float | None = None) -> DataFrame:
    """Last ``2 * pairs`` messages per session as one row, trimmed as they arrive so state stays small however long a session
    grows. With ``ttl_hours`` a session without messages for that time of processing is forgotten. Messages without a turn
    count as the oldest; a null session is one session."""
    rows = stateful(turns.select("conv_id", "turn", "role", "text"))
    ttl, mode = lifetime(ttl_hours)
    schema = "conv_id bigint, turns array<bigint>, roles array<string>, texts array<string>"
    return rows.groupBy("conv_id").transformWithStateInPandas(History(2 * pairs, ttl), schema, "Update", mode)
