"""Expiry of keys by event-time timers.

Every key has a list of lives in its state: when each began, when it was last refreshed, and how often, and one timer, for the life that
expires first. A refresh before a life's expiry moves the expiry, and with it the timer; one at the expiry or later begins another life, since a row is stale from
its expiry on. Rows that arrive out of order, but not later than the watermark allows, extend, begin or join lives. When the
watermark passes the timer, all lives that it has passed are reported and leave the state, and the timer is set for the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Timers need a state store with column families.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}

Life = tuple[int, int, int]


def joined_lives(lives: list[Life], moments: np.ndarray, ttl: int) -> list[Life]:
    """Lives after refreshes at some moments (microseconds, in any order)."""
    moments = np.sort(moments)
    edges = np.r_[0, np.flatnonzero(np.diff(moments) >= ttl) + 1, len(moments)]
    new = [(int(moments[a]), int(moments[b - 1]), int(b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a]
    out: list[Life] = []
    for began, last, n in sorted(lives + new):
        if out and began < out[-1][1] + ttl:
            first, before, m = out[-1]
            out[-1] = (first, max(before, last), m + n)
        else:
            out.append((began, last, n))
    return out


class KeyExpiry(StatefulProcessor):
    """``key, expires_micros, refreshes`` of each life that the watermark has passed."""

    def __init__(self, key: str, ttl_micros: int):
        self.key, self.ttl = key, ttl_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lives = handle.getListState("lives", "began long, refreshed long, refreshes long")

    def _timer(self, life: Life) -> int:
        """The first whole millisecond at which the life is over."""
        return -(-(life[1] + self.ttl) // 1000)

    def _held(self) -> list[Life]:
        return [tuple(row) for row in self.lives.get()]

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        before = self._held()
        after = before
        for batch in rows:
            after = joined_lives(after, batch["micros"].to_numpy(np.int64), self.ttl)
        old, new = (min(map(self._timer, lives), default=None) for lives in (before, after))
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(new)
        self.lives.put(after)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        moment, passed = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        over, left = [], []
        for life in self._held():
            timer = self._timer(life)
            (over if timer <= moment or timer < passed else left).append(life)
        if left:
            self.lives.put(left)
            self.handle.registerTimer(min(map(self._timer, left)))
        else:
            self.lives.clear()
        if over:
            yield pd.DataFrame(
                {
                    self.key: [key[0]] * len(over),
                    "expires_micros": [last + self.ttl for _, last, _ in over],
                    "refreshes": [n for _, _, n in over],
                }
            )

    def close(self) -> None:
        pass


def expired_keys(stream: DataFrame, key: str, ttl_seconds: int, delay: str, ts: str = "ts") -> DataFrame:
    """``key, expires_at, refreshes`` once a key was not refreshed for the ttl; start it with ``STATE_STORE`` set."""
    if ttl_seconds <= 0:
        raise ValueError("ttl_seconds must be positive.")
    rows = stream.withWatermark(ts, delay).select(key, ts, F.unix_micros(ts).alias("micros")).where(f"{key} IS NOT NULL")
    schema = T.StructType(
        [stream.schema[key], T.StructField("expires_micros", T.LongType()), T.StructField("refreshes", T.LongType())]
    )
    lived = rows.groupBy(key).transformWithStateInPandas(KeyExpiry(key, ttl_seconds * 1_000_000), schema, "append", "eventTime")
    return lived.select(key, F.timestamp_micros("expires_micros").alias("expires_at"), "refreshes")
