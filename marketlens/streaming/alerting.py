"""An alert rule as a keyed stateful stream.

Readings arrive in any order within the watermark's delay.  Per key the state
holds the readings that the watermark has not passed, the latest value of
either series and the alert itself: since when it is pending and whether it
fires.  Readings are taken in time order once the watermark has passed them,
so the transitions equal those of the batch operator (``alerts.rule_runs``).
A change that no reading announces (firing, a side gone stale) is emitted when
the watermark passes it, by an event-time timeout.

State per key is a few numbers and the readings of one delay.  A call of the
step costs milliseconds however few its rows, so keys are dealt by a hash into
slots: a call serves one slot, whose state row holds all its keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from marketlens.functions.columns import epoch_micros
from marketlens.operators.alerts import Rule

SLOTS = 1024
# per key, then per reading that waits (``of``: the number of its key)
_STATE = ("keys array<string>, part_at array<long>, part array<double>, whole_at array<long>, whole array<double>, "
          "since array<long>, fired array<boolean>, "
          "of array<int>, times array<long>, parts array<double>, wholes array<double>")
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class Alert:
    """The alert of one key; times in microseconds.  ``out`` collects (state,
    at, value) transitions."""

    def __init__(self, rule: Rule, part_at=None, part=None, whole_at=None, whole=None, since=None, fired=False):
        self.rule, self.out = rule, []
        self.part_at, self.part, self.whole_at, self.whole = part_at, part, whole_at, whole
        self.since, self.fired = since, fired

    @property
    def value(self):
        if self.part is None or not self.whole:
            return None
        return self.part / self.whole * 100.0

    @property
    def stale(self) -> int:
        return min(self.part_at, self.whole_at) + self.rule.lookback_seconds * 1_000_000

    @property
    def due(self) -> int:
        return self.since + self.rule.for_seconds * 1_000_000

    def pass_to(self, at: int) -> None:
        """What happens before ``at`` without another reading."""
        if self.since is None:
            return
        if not self.fired and self.due < min(at, self.stale):
            self.fired = True
            self.out.append(("firing", self.due, self.value))
        if self.stale < at:
            self._end(self.stale)

    def _end(self, at: int) -> None:
        self.out.append(("resolved", at, self.value))
        self.since, self.fired = None, False

    def take(self, at: int, part: float | None, whole: float | None) -> None:
        """The readings of one moment."""
        self.pass_to(at)
        if part is not None:
            self.part_at, self.part = at, part
        if whole is not None:
            self.whole_at, self.whole = at, whole
        value = self.value
        on = value is not None and at < self.stale and self.rule.breached(value)
        if on and self.since is None:
            self.since = at
            self.out.append(("pending", at, value))
        elif not on and self.since is not None:
            self._end(at)


def _known(x):
    return None if x is None or x != x else float(x)


def _moments(times, parts, wholes) -> dict[int, list]:
    """Greatest reading of each side per moment."""
    out: dict[int, list] = {}
    for at, part, whole in zip(times, parts, wholes):
        both = out.setdefault(int(at), [None, None])
        for k, v in enumerate((_known(part), _known(whole))):
            if v is not None and (both[k] is None or v > both[k]):
                both[k] = v
    return out


def rule_transitions(readings: DataFrame, rule: Rule, delay: str = "10 minutes", keys=("instance",),
                     slots: int = SLOTS) -> DataFrame:
    """(keys, state, at, value): one row per change to pending, firing or
    resolved, from a stream of readings (ts, series, instance, value).

    ``slots`` is the number of state rows, fixed for the life of a checkpoint:
    some hundred keys a slot keep the calls few and the rows small."""
    keys = list(keys)
    rows = readings.filter(F.col("series").isin(rule.part, rule.whole) & F.col("value").isNotNull())
    us = epoch_micros(rows, "ts")
    rows = rows.select(
        F.pmod(F.xxhash64(*keys), F.lit(slots)).alias("slot"), F.to_json(F.struct(*keys), _EXACT).alias("key"),
        us.alias("us"), F.timestamp_micros(us).alias("ts"),
        F.when(F.col("series") == rule.part, F.col("value")).alias("part"),
        F.when(F.col("series") == rule.whole, F.col("value")).alias("whole"))

    def step(slot: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ([],) * 11
        names = list(held[0])
        alerts = [Alert(rule, *x) for x in zip(*held[1:7])]
        number = {k: n for n, k in enumerate(names)}
        readings_of = [([], [], []) for _ in names]
        for n, *reading in zip(*held[7:]):
            for column, x in zip(readings_of[n], reading):
                column.append(x)
        for f in frames:
            for k, *reading in zip(*(f[c].tolist() for c in ("key", "us", "part", "whole"))):
                n = number.setdefault(k, len(names))
                if n == len(names):
                    names.append(k)
                    alerts.append(Alert(rule))
                    readings_of.append(([], [], []))
                for column, x in zip(readings_of[n], reading):
                    column.append(x)
        passed = state.getCurrentWatermarkMs() * 1000
        waiting, found, wake = ([], [], [], []), [], None
        for n, alert in enumerate(alerts):
            moments = _moments(*readings_of[n])
            for at in sorted(moments):
                if at < passed:
                    alert.take(at, *moments[at])
                else:
                    for column, x in zip(waiting, (n, at, *moments[at])):
                        column.append(x)
            alert.pass_to(passed)
            found += [(names[n], *change) for change in alert.out]
            if alert.since is not None:
                soon = alert.stale if alert.fired else min(alert.stale, alert.due)
                wake = soon if wake is None else min(wake, soon)
        of_keys = [[getattr(a, x) for a in alerts] for x in ("part_at", "part", "whole_at", "whole", "since", "fired")]
        state.update((names, *of_keys, *waiting))
        wake = min([*waiting[1], *([] if wake is None else [wake])], default=None)
        if wake is not None:  # calls come once the watermark has passed the millisecond
            state.setTimeoutTimestamp(max(wake // 1000, state.getCurrentWatermarkMs()))
        if found:
            yield pd.DataFrame(found, columns=["key", "state", "us", "value"])

    out = (rows.withWatermark("ts", delay).groupBy("slot")
           .applyInPandasWithState(step, "key string, state string, us long, value double", _STATE, "append",
                                   GroupStateTimeout.EventTimeTimeout))
    at = F.timestamp_micros("us")
    if isinstance(readings.schema["ts"].dataType, TimestampNTZType):  # wall-clock times come back as such
        at = F.expr("timestampadd(MICROSECOND, us, timestamp_ntz'1970-01-01 00:00:00')")
    kinds = StructType([StructField(k, readings.schema[k].dataType) for k in keys])
    named = out.withColumn("key", F.from_json("key", kinds, _EXACT))
    return named.select(*[F.col("key").getField(k).alias(k) for k in keys], "state", at.alias("at"), "value")
