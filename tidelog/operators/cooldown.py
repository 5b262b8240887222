"""Alert cooldown: which alerts are sent, if each one silences its like for a while.

What is sent depends on what was sent before. So the order is cut into spans of time, and of each span it is worked out, for
every alert that may be the first one sent in it, which is the last one sent then. Only these maps of a key's spans meet in
one place, where the last one sent is carried from span to span; then each span sends what follows its first. A span's
first is among the alerts of its first ``seconds``, or the next after these, as no silence from before it lasts longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SPAN = 86_400


def _chain(times: np.ndarray, seconds: int) -> np.ndarray:
    """For each time, in order, the place of the next one that may be sent after it; past the end if there is none."""
    return np.searchsorted(times, times + seconds)


def _ends(following: np.ndarray) -> np.ndarray:
    """The last place that is reached from each, in as many rounds as the logarithm of the longest way."""
    n = len(following)
    at = np.where(following < n, following, np.arange(n))
    while True:
        new = at[at]
        if (new == at).all():
            return at
        at = new


def _map(seconds: int, width: int):
    """A span's row of (first that may be sent, last that is sent then)."""

    def run(rows: pa.Table) -> pa.Table:
        times = np.sort(rows.column(rows.num_columns - 1).to_numpy())
        span = rows.column(rows.num_columns - 2)[0].as_py()
        last = _ends(_chain(times, seconds))
        n = min(len(times), int(np.searchsorted(times, span * width + seconds)) + 1)
        lists = [pa.array([x], pa.list_(pa.int64())) for x in (times[:n], times[last[:n]])]
        return pa.table([*rows.slice(0, 1).columns[:-1], *lists], [*rows.column_names[:-1], "firsts", "lasts"])

    return run


def _carry(seconds: int):
    """The first alert sent in each span of a key, in spans that send any."""

    def run(rows: pa.Table) -> pa.Table:
        k = rows.num_columns
        spans, firsts, lasts = (rows.column(c) for c in range(k - 3, k))
        kept, found, last = [], [], None
        for i in np.argsort(spans.to_numpy(), kind="stable").tolist():
            times = firsts[i].values.to_numpy()
            at = 0 if last is None else int(np.searchsorted(times, last + seconds))
            if at < len(times):
                kept.append(i)
                found.append(int(times[at]))
                last = int(lasts[i].values[at].as_py())
        return pa.table([*rows.take(pa.array(kept, pa.int64())).columns[: k - 2], pa.array(found, pa.int64())], [*rows.column_names[: k - 2], "first"])

    return run


def _send(seconds: int):
    """All alerts sent in a span, from its first on."""

    def run(rows: pa.Table, first: pa.Table) -> pa.Table:
        times = np.sort(rows.column(rows.num_columns - 1).to_numpy())
        following, sent = _chain(times, seconds), []
        at = int(np.searchsorted(times, first.column(first.num_columns - 1)[0].as_py())) if first.num_rows else len(times)
        while at < len(times):
            sent.append(int(times[at]))
            at = int(following[at])
        keys = [c.take(pa.array(np.zeros(len(sent), np.int64))) if len(sent) else c.slice(0, 0) for c in rows.slice(0, 1).columns[:-2]] if rows.num_rows else [c.slice(0, 0) for c in rows.columns[:-2]]
        return pa.table([*keys, pa.array(sent, pa.int64())], [*rows.column_names[:-2], rows.column_names[-1]])

    return run


def alert_cooldown(alerts: DataFrame, seconds: int = 300, keys: tuple[str, ...] = ("channel", "title"), at: str = "at", span: int = SPAN) -> DataFrame:
    """Alerts that are sent: keys and ``at``, in whole seconds. The first of its keys is sent, and each that comes ``seconds`` or more
    after the last one sent. Alerts of one second are one; those without a time are left out; null is a key like others.

    A task holds the distinct seconds of a span (a day, or the cooldown if that is longer) of one key, or the maps of a key's
    spans, with ``seconds`` entries each at most; neither grows with the number of alerts.
    """
    width = max(span, seconds, 1)
    times = alerts.select(*keys, F.col(at).cast("long").alias(at)).where(F.col(at).isNotNull()).distinct()
    if seconds <= 0:
        return times
    times = times.select(*keys, F.floor(F.col(at) / width).cast("long").alias("_span"), at)
    base = [times.schema[k] for k in keys]
    number, numbers = T.LongType(), T.ArrayType(T.LongType())
    spans = [*base, T.StructField("_span", number)]
    maps = times.groupBy(*keys, "_span").applyInArrow(_map(seconds, width), T.StructType([*spans, T.StructField("firsts", numbers), T.StructField("lasts", numbers)]))
    first = maps.groupBy(*keys).applyInArrow(_carry(seconds), T.StructType([*spans, T.StructField("first", number)]))
    both = times.groupBy(*keys, "_span").cogroup(first.groupBy(*keys, "_span"))
    return both.applyInArrow(_send(seconds), T.StructType([*base, T.StructField(at, number)]))


def alert_cooldown_stream(alerts: DataFrame, seconds: int = 300, keys: tuple[str, ...] = ("channel", "title"), at: str = "at") -> DataFrame:
    """The same of a stream: a key's state is the time of its last alert that was sent. An alert that comes in a later batch than a
    later one is not sent if it is within ``seconds`` of that or before it."""
    rows = alerts.select(*keys, F.col(at).cast("long").alias(at)).where(F.col(at).isNotNull())

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        sent = []
        for t in sorted({int(x) for frame in frames for x in frame[at]}):
            if last is None or t - last >= seconds:
                sent.append(t)
                last = t
        state.update((last,))
        yield pd.DataFrame([(*key, t) for t in sent], columns=[*keys, at])

    return rows.groupBy(*keys).applyInPandasWithState(run, rows.schema, "last long", "append", GroupStateTimeout.NoTimeout)
