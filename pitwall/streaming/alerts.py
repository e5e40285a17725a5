"""Error alerts with a rate limit.

An alert policy watches the error events of some services and notifies at most
once per period: an error notifies if the last notification is at least one
period old. Times count in whole seconds, so equal seconds are merged before
the shuffle.

A finished log is judged by days at once: for every number of seconds that the
day before may still block, a day tells how many it blocks of the next. One row
per day is chained, and then each day marks its notifications.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pitwall.session import materialise

POLICY = "pipeline-errors"
PERIOD_SECONDS = 300
DAY_SECONDS = 86_400
# How late an error may be on a stream.
WATERMARK = "1 minute"
# Severities from ERROR up.
SEVERE = ("ERROR", "CRITICAL", "ALERT", "EMERGENCY")


def error_events(audit: DataFrame, services: Sequence[str]) -> DataFrame:
    """Error events of the watched services, at whole seconds."""
    errors = audit.filter(F.col("severity").isin(*SEVERE) & F.col("service").isin(list(services)))
    return errors.select(F.lit(POLICY).alias("policy"), F.unix_timestamp("logged_at").alias("second"))


def rate_limit(period: int) -> Callable[..., list[int]]:
    """The rule that at most one notification is sent per ``period`` seconds.

    A nested function: it travels to the tasks by value, so that the executors
    need not have this package.
    """

    def fire_times(seconds: Iterable[int], last: int | None = None) -> list[int]:
        fired = []
        for second in seconds:
            if last is None or second >= last + period:
                fired.append(second)
                last = second
        return fired

    return fire_times


def alerts(audit: DataFrame, services: Sequence[str], period_seconds: int = PERIOD_SECONDS) -> DataFrame:
    """Notifications that a finished log would have sent: policy, fired_at."""
    if not 0 < period_seconds <= DAY_SECONDS:
        raise ValueError("the period must be from one second to one day")
    day = F.floor(F.col("second") / DAY_SECONDS).alias("day")
    seconds = materialise(error_events(audit, services).distinct().select("policy", day, "second"), "errors")
    period, length, fire_times = period_seconds, DAY_SECONDS, rate_limit(period_seconds)

    def reach(rows: pd.DataFrame) -> pd.DataFrame:
        start = int(rows["day"].iloc[0]) * length
        ordered = np.sort(rows["second"].to_numpy()) - start
        # from the last error backwards: what a notification at each error leaves to the next day
        following, left = np.searchsorted(ordered, ordered + period), np.zeros(len(ordered) + 1, np.int64)
        for i in range(len(ordered) - 1, -1, -1):
            k = following[i]
            left[i] = left[k] if k < len(ordered) else max(0, ordered[i] + period - length)
        first = np.searchsorted(ordered, np.arange(period + 1))
        return pd.DataFrame({"policy": [rows["policy"].iloc[0]], "day": [start // length], "blocks": [left[first].tolist()]})

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("day")
        blocked, before, last = [], 0, None
        for day, blocks in zip(rows["day"], rows["blocks"], strict=True):
            blocked.append(before if last == day - 1 else 0)
            before, last = int(blocks[blocked[-1]]), day
        return pd.DataFrame({"policy": rows["policy"], "day": rows["day"], "blocked": blocked})

    def fire(rows: pd.DataFrame) -> pd.DataFrame:
        start = int(rows["day"].iloc[0]) * length + int(rows["blocked"].iloc[0])
        ordered = np.sort(rows["second"].to_numpy())
        fired = fire_times(ordered[ordered >= start].tolist())
        return pd.DataFrame({"policy": rows["policy"].iloc[0], "second": fired})

    days = seconds.groupBy("policy", "day").applyInPandas(reach, "policy string, day long, blocks array<long>")
    days = days.groupBy("policy").applyInPandas(chain, "policy string, day long, blocked long")
    fired = seconds.join(days, ["policy", "day"]).groupBy("policy", "day").applyInPandas(fire, "policy string, second long")
    return fired.select("policy", F.timestamp_seconds("second").alias("fired_at"))


def _notifier(period: int) -> StatefulProcessor:
    """The rate limit along event time. A nested class travels to the tasks by value."""
    fire_times = rate_limit(period)

    class Notifier(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", "second long")
            self.pending = handle.getMapState("pending", "second long", "seen boolean")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            for part in rows:
                for second in part["second"].unique().tolist():
                    self.pending.updateValue((second,), (True,))
                    self.handle.registerTimer(second * 1000)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            # no row of a second up to the watermark can arrive any more
            passed = timerValues.getCurrentWatermarkInMs() // 1000
            ready = sorted(k[0] for k in self.pending.keys() if k[0] <= passed)
            for second in ready:
                self.pending.removeKey((second,))
            last = self.last.get()[0] if self.last.exists() else None
            fired = fire_times(ready, last)
            if fired:
                self.last.update((fired[-1],))
                yield pd.DataFrame({"policy": [key[0]] * len(fired), "second": fired})

        def close(self) -> None:
            pass

    return Notifier()


def alert_stream(
    audit: DataFrame, services: Sequence[str], period_seconds: int = PERIOD_SECONDS, watermark: str = WATERMARK
) -> DataFrame:
    """The same on a stream of audit rows, whatever way it is cut into batches.

    An error is judged when the watermark has passed it, so rows that are late
    by less than ``watermark`` count in their place, and the notifications are
    those of ``alerts``. Errors later than that are dropped. Each second with
    an error passes the shuffle once for each policy; the state are the seconds
    that the watermark has not passed, and the last notification.
    """
    errors = error_events(audit, services).withColumn("at", F.timestamp_seconds("second"))
    seconds = errors.withWatermark("at", watermark).dropDuplicatesWithinWatermark(["policy", "second"])
    fired = seconds.groupBy("policy").transformWithStateInPandas(
        _notifier(period_seconds),
        outputStructType="policy string, second long",
        outputMode="Append",
        timeMode="EventTime",
    )
    return fired.select("policy", F.timestamp_seconds("second").alias("fired_at"))
