"""Events that come again: each is logged once, however late its repeat comes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Milliseconds of a stretch of event time, and the stretches that a scan of the log is limited to by name.
STRETCH, STRETCHES = 3_600_000, 200


def once_each(events: DataFrame, order: list[str]) -> DataFrame:
    """The first event of each id. Rows without an id stay."""
    first = F.row_number().over(Window.partitionBy("id").orderBy(*order))
    return events.where("id is not null").withColumn("_n", first).where("_n = 1").drop("_n").unionByName(events.where("id is null"))


def unseen(events: DataFrame, log: DataFrame, newest: int | None) -> DataFrame:
    """Events whose id and time are not in a log (_event_id, _timestamp), exactly. ``newest`` is the latest time in the log; None, if it is
    empty.

    A repeat has the time of its original. So events later than ``newest`` need no look at the log, and of the log only those stretches of
    time are read that other events fall into: where a batch of the log holds events of about the time that it came in, as
    logs do, the minimum and maximum that Parquet keeps for its files leave out all but a few. The stretches are a row each on
    the driver, up to STRETCHES; where there are more, the whole time between the first and the last is read.
    """
    if newest is None:
        return events
    asked = events.where(F.col("timestamp") <= newest)
    found = [r[0] for r in asked.select(F.floor(F.col("timestamp") / STRETCH).alias("h")).distinct().limit(STRETCHES + 1).collect()]
    if not found:
        return events
    time = F.col("_timestamp")
    if len(found) <= STRETCHES:
        ends: list[list[int]] = []
        for h in sorted(found):
            if ends and ends[-1][1] == h:
                ends[-1][1] = h + 1
            else:
                ends.append([h, h + 1])
        near = reduce(lambda a, b: a | b, [(time >= a * STRETCH) & (time < b * STRETCH) for a, b in ends])
    else:
        low, high = asked.agg(F.min("timestamp"), F.max("timestamp")).first()
        near = (time >= low) & (time <= high)
    there = log.where(near).select(F.col("_event_id").alias("_seen"), time.alias("_at"))
    return events.join(there, (F.col("id") == F.col("_seen")) & (F.col("timestamp") == F.col("_at")), "left_anti")
