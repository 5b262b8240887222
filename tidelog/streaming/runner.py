"""Delivery of an event stream: each micro-batch is decoded, migrated, appended or folded, and committed once."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.events import key_text, row_key
from tidelog.model import Catalog, Schema
from tidelog.operators.filters import after_import, guarded
from tidelog.operators.mirror import apply_events, empty_mirror
from tidelog.operators.redelivery import once_each, unseen
from tidelog.operators.segments import version_starts
from tidelog.operators.views import current
from tidelog.sinks.files import append_log, write_dead_letters
from tidelog.sinks.registry import delays, retried
from tidelog.sinks.store import NEW, Buckets, Folder, Ledger, MirrorStore, shape_of
from tidelog.sources.events import decode, numbered, with_arrival


@dataclass
class Delivery:
    """Where and how events are delivered.

    ``mode`` is upsert (mirrors) or time_series (a log). A batch takes effect by one commit of the ledger, which has the state of all
    mirrors, the next sequence number and the batch's number: all its events or none, whatever fails and wherever a driver is
    lost. A batch that Spark repeats is tried anew if it wasn't committed, and else left alone. A batch that fails ``attempts`` times
    changes nothing; its events go to the dead-letter table, in that one commit, and the stream goes on.

    Where a table's events move on to a later version of its model, the batch is cut: the events before are applied in the shape
    that the table had, then it gets the new one, then the rest follows. Events of an earlier version set only the columns that it
    had; unknown versions count as the one in force. A mirror has ``buckets``, of which a batch rewrites those that it touches; a new version
    rewrites none. Mirrors follow the order of arrival (or ``order``, such as event time); views over a log follow event time. With
    ``once``, an event that is delivered again, however late, is not logged again.

    A commit also has the ``status`` so far: events, batches, time and table of the last event, and those that were given up.
    """

    root: str
    catalog: Catalog
    mode: str = "upsert"
    cutoffs: DataFrame | None = None
    diff_aware: bool = True
    attempts: int = 5
    buckets: int = 64
    sleep: Callable[[float], None] = time.sleep
    order: list[str] = field(default_factory=lambda: ["arrival"])
    once: bool = False

    def ledger(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, f"{self.root}/_ledger")

    def committed(self, spark: SparkSession) -> dict:
        """The last commit: batch, seq (the last number given), tables (their states), dead (batches that were given up), newest (the
        latest time in the log), status."""
        return {"batch": -1, "seq": 0, "tables": {}, "dead": [], "newest": None, "status": {}} | self.ledger(spark).read()[1]

    def mirror(self, spark: SparkSession, table: str) -> MirrorStore:
        """A mirror as of the last commit."""
        name = table.lower()
        keys = tuple(self.committed(spark)["tables"].get(name, NEW)["keys"]) or self.catalog[table].keys
        return MirrorStore(spark, self._place(table), keys, self.buckets, lambda: self.committed(spark)["tables"].get(name, NEW))

    def _place(self, table: str) -> str:
        return f"{self.root}/mirror/{self.catalog[table].table}"

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        commit, before = self.ledger(spark).read()[0], self.committed(spark)
        if number <= before["batch"]:
            return
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # else each use of it would read the source again
        try:
            self._deliver(spark, batch, number, commit, before)
        finally:
            batch.unpersist()

    def _deliver(self, spark: SparkSession, batch: DataFrame, number: int, commit: int, before: dict) -> None:
        events, broken = decode(with_arrival(batch))
        events, unsafe = guarded(events)
        if self.cutoffs is not None:
            events = after_import(events, self.cutoffs)
        self._leave(broken.withColumn("failed_at", F.current_timestamp()), "broken", number)
        dead = f"{self.root}/dead/batch={number}"
        write_dead_letters(unsafe, f"{dead}/of=unsafe", "unsafe table name", mode="overwrite")
        waits, after = delays("flush"), None
        for attempt in range(self.attempts):
            try:
                after = self._apply(spark, events, number, before)
                break
            except Exception as e:  # the batch is what is at fault; the stream goes on
                error = str(e)
                self._undo(spark, number, before)
                if attempt + 1 < self.attempts:
                    self.sleep(waits[min(attempt, len(waits) - 1)])
        if after is None:
            write_dead_letters(events, f"{dead}/of=failed", error, self.attempts, mode="overwrite")
            given_up = before["status"].get("given_up", 0) + events.count()
            after = before | {"dead": [*before["dead"], number], "status": before["status"] | {"given_up": given_up}}
        else:  # a try of this batch in another driver may have given it up without a commit
            Folder(spark, dead).remove("of=failed")
        self.ledger(spark).commit(after | {"batch": number}, commit)
        for name, state in after["tables"].items():
            old = before["tables"].get(name, NEW)
            if state != old:
                Buckets(spark, self._place(name)).clean(old, state)

    def _leave(self, rows: DataFrame, name: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={number}")

    def _undo(self, spark: SparkSession, number: int, before: dict) -> None:
        """Remove what a failed try of a batch has written."""
        Folder(spark, self.root).remove(f"log/batch={number}")
        Folder(spark, self.root).remove(f"parked/batch={number}")
        for name in self.catalog:
            Buckets(spark, self._place(name)).discard(before["tables"].get(name, NEW))

    def _apply(self, spark: SparkSession, events: DataFrame, number: int, before: dict) -> dict:
        """Write what a batch changes, and return the value to commit. Events are decoded once, numbered and written; tables read
        them from there."""
        base = before["seq"]
        if self.once and self.mode == "time_series":
            events = once_each(events, self.order)
            events = unseen(events, self.log(spark) if before["newest"] is not None else events, before["newest"])
        rows = numbered(events, self.order, f"{self.root}/staging", base)
        told = rows.agg(F.count("*").alias("n"), F.max("timestamp").alias("at"), F.max_by("table", "seq").alias("table"), F.max_by("timestamp", "seq").alias("last")).first()
        old = before["status"]
        status = {"events": old.get("events", 0) + told["n"], "batches": old.get("batches", 0) + 1, "given_up": old.get("given_up", 0)}
        status |= {"last_event_ms": told["last"], "last_table": told["table"]} if told["n"] else {k: old.get(k) for k in ("last_event_ms", "last_table")}
        before = before | {"status": status}
        if self.mode == "time_series":
            append_log(rows, f"{self.root}/log/batch={number}", mode="overwrite")
            return before | {"seq": base + told["n"], "newest": max((x for x in (before["newest"], told["at"]) if x is not None), default=None)}
        known = list(self.catalog)
        table = F.lower("table")
        names = sorted(r[0] for r in rows.select(table).where(table.isin(known)).distinct().collect()) if known else []
        starts: dict[str, list] = {}
        versions = self.catalog.ranks()
        for r in version_starts(self._with_version(rows), versions).collect():
            starts.setdefault(r["table"], []).append((r["start"], r["rank"], r["version"]))
        tables = dict(before["tables"])
        for name in names:
            tables[name] = self._fold(spark, name, rows.where(table == name), sorted(starts.get(name, [])), NEW | tables.get(name, {}), versions)
        self._leave(rows.where(~table.isin(names)) if names else rows, "parked", number)
        return before | {"tables": tables}

    def _with_version(self, rows: DataFrame) -> DataFrame:
        """Events with the version in force of their table where theirs is unknown."""
        version, known = F.lit(None).cast("string"), [F.lit(f"{t}\0{v}") for t, v in self.catalog.ranks()]
        for name, schema in self.catalog.items():
            version = F.when(F.lower("table") == name, F.lit(schema.version)).otherwise(version)
        own = F.concat(F.lower("table"), F.lit("\0"), F.col("modelVersion"))
        return rows.withColumn("modelVersion", F.when(own.isin(known), F.col("modelVersion")).otherwise(version)) if known else rows

    def _fold(self, spark: SparkSession, name: str, own: DataFrame, starts: list, state: dict, ranks: dict) -> dict:
        """The state of a table after its events, segment by segment."""
        first = state
        tracked = ranks.get((name, state.get("model")), -1)
        starts = [s for s in starts if s[1] > tracked]
        versions = [(None, state["model"])] if tracked >= 0 else []
        versions += [(at, version) for at, _, version in starts]
        if tracked < 0:  # a new table begins in the first version that its events have
            versions = [(None, versions[0][1]) if versions else (None, self.catalog[name].version), *versions[1:]]
        for k, (start, version) in enumerate(versions):
            part = own if start is None else own.where(F.col("seq") >= start)
            if k + 1 < len(versions):
                part = part.where(F.col("seq") < versions[k + 1][0])
            schema = self.catalog.find(name, version)
            store = Buckets(spark, self._place(name), schema.keys, self.buckets)
            shape = shape_of(schema)
            old = {f.name: f.dataType for f in (store.struct(state) or [])}
            # rows are dealt out by the text of their key, so another key, or one of another type, deals all of them out anew
            whole = state["version"] < 0 or list(schema.keys) != state["keys"] or any(old.get(f.name) != f.dataType for f in shape if f.name in schema.keys)
            base_state = store.reshaped(state, shape)
            touched = None if whole else self._touched(store, part, schema)
            if touched == []:  # no event in this segment
                state = base_state | {"model": version}
                continue
            base = store.rows(base_state, touched) if state["version"] >= 0 else empty_mirror(spark, schema)
            changed = apply_events(base, part, schema, diff_aware=self.diff_aware, older=self.catalog.others(name, version))
            changed = changed.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in shape])
            state = store.write(base_state, changed, touched) | {"model": version}
        return state | {"stale": Buckets.stale(first, state)}

    def _touched(self, store: Buckets, events: DataFrame, schema: Schema) -> list[int]:
        """The buckets that events may change: those of their keys, as they are and as the key's columns hold them."""
        key, parts = row_key(schema.keys), F.from_json(row_key(schema.keys), "array<string>")
        typed = [(key if len(schema.keys) == 1 else F.get(parts, F.lit(i))).try_cast(schema.properties[k].spark_type if k in schema.properties else "string") for i, k in enumerate(schema.keys)]
        pairs = events.select(store.bucket(key).alias("a"), store.bucket(key_text(typed)).alias("b")).distinct().collect()
        return sorted({b for pair in pairs for b in pair if b is not None})

    def log(self, spark: SparkSession, table: str | None = None) -> DataFrame:
        """The log of a table, or of all, as of the last commit."""
        now = self.committed(spark)
        rows = spark.read.parquet(f"{self.root}/log").where(F.col("batch") <= now["batch"])
        if now["dead"]:
            rows = rows.where(~F.col("batch").isin(now["dead"]))
        return (rows if table is None else rows.where(F.col("table") == table)).drop("table", "batch")

    def dead_letters(self, spark: SparkSession) -> DataFrame:
        """Dead letters as of the last commit, with the number of their batch."""
        return spark.read.parquet(f"{self.root}/dead").where(F.col("batch") <= self.committed(spark)["batch"]).drop("of")

    def current(self, spark: SparkSession, table: str) -> DataFrame:
        return current(self.log(spark, table))


def deliver(stream: DataFrame, delivery: Delivery, checkpoint: str, seconds: float | None = None):
    """Start delivery: a trigger every ``seconds``, or of what is there now. A start that fails for what may pass is tried again."""
    writer = stream.writeStream.foreachBatch(delivery).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")
    return retried(writer.start, "start")


def without_repeats(events: DataFrame, time: str = "event_time", delay: str = "5 minutes") -> DataFrame:
    """Events of a stream without redelivered ones, within the delay."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(["id"])
