import gzip
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from tidelog.model import Catalog, Property, Schema
from tidelog.operators import cooldown, evolve, filters, metrics, redelivery, segments
from tidelog.operators.mirror import empty_mirror
from tidelog.plans import queries
from tidelog.sinks import databases, dialects, files, objects, registry
from tidelog.sinks.store import Buckets, Folder, KeyValues, Ledger, MirrorStore
from tidelog.sources import events as se
from tidelog.sources import exports, schemas, snapshots
from tidelog.sources.folders import listing
from tidelog.streaming import monitor
from tidelog.streaming.runner import Delivery, deliver

ORDERS = Schema("orders", "1", {"id": Property(), "name": Property(nullable=True)}, ("id",), ("id",))
STAMP = "203105091716151823000000000000042"


AT = 1936113375182300  # of STAMP, in microseconds


def test_file_names(spark):
    names = [f"{STAMP}-w9-0-parcels-a.ndjson.gz", f"{STAMP}-w9-12-lost_parcels-0.ndjson", f"{STAMP}-w9-0-a-b-0.ndjson", f"{'9' * 33}-w9-0-parcels-0.ndjson", f"{STAMP}-w9-x-parcels-0.ndjson", f"{STAMP[:32]}-w9-0-parcels-0.ndjson", "notes.txt", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [tuple(r) for r in df.select(snapshots.file_table(F.col("n")), snapshots.file_time(F.col("n"))).collect()]
    assert got == [("parcels", AT), ("lost_parcels", AT), ("a-b", AT), ("parcels", None)] + [(None, None)] * 4
    assert [exports.parsed(n) for n in names] == [("parcels", AT), ("lost_parcels", AT), ("a-b", AT), ("parcels", None), None, None, None, None]


def put(folder, name, lines):
    text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines)
    path = os.path.join(folder, name)
    with gzip.open(path, "wt") if name.endswith("gz") else open(path, "w") as f:
        f.write(text)


def test_import(spark, tmp_path):
    d = str(tmp_path)
    put(d, f"{STAMP}-n1-0-orders-0.ndjson", [{"id": "1", "name": "a", "companyId": "c", "locationId": "l"}, "", "{bad", {"id": "2"}])
    put(d, f"{STAMP[:13]}5{STAMP[14:]}-n1-0-orders-1.ndjson.gz", [{"id": "1", "name": "newer"}, {"name": "no id"}])
    put(d, f"{STAMP}-n1-0-products-0.ndjson", [{"id": 9}])
    put(d, f"{STAMP}-n1-0-empty-0.ndjson", [])
    put(d, "README.txt", ["x"])
    every = snapshots.import_events(spark, d, ["ORDERS", "products", "empty"])
    assert every.count() == 5
    assert snapshots.import_events(spark, d, ["orders", "products"], only=["Orders"]).count() == 4
    assert snapshots.import_events(spark, d, []).count() == 0
    done = spark.createDataFrame([(f"/x/{STAMP}-N1-0-orders-0.ndjson",)], "f string")
    assert snapshots.import_events(spark, d, ["orders"], completed=done).count() == 2
    first = every.where("after like '%locationId%'").first()
    assert (first["operation"], first["key"], first["locationId"], first["timestamp"], first["mvccTimestamp"]) == ("INSERT", ["1"], "c", AT // 1000, f"{AT}000")
    listed = snapshots.list_files(spark, d)
    counts = {r["table"]: r["n_rows"] for r in snapshots.import_counts(listed, every).collect()}
    assert counts == {"orders": 4, "products": 1, "empty": 0}
    assert {r["table"]: r["cutoff_ms"] for r in snapshots.cutoffs(listed).collect()}["products"] == AT // 1000
    from tidelog.operators.mirror import empty_mirror

    mirror = snapshots.snapshot_mirror(every.where("table = 'orders'"), empty_mirror(spark, ORDERS), ORDERS)
    assert {r["id"]: r["name"] for r in mirror.where("length(id) < 5").collect()} == {"1": "newer", "2": None}
    copied = files.copy_files(spark, d, str(tmp_path / "copy"), "*.ndjson*").collect()
    assert len(copied) == 4 and len(os.listdir(tmp_path / "copy")) == 4
    assert metrics.transferred(spark.read.format("binaryFile").load(d + "/*.txt")).first()["bytes"] == 1


def members(lines, per_member, torn=False):
    """gzip of lines in members of so many bytes, so that lines run over their ends."""
    text = "\n".join(lines).encode()
    out = b"".join(gzip.compress(text[k : k + per_member]) for k in range(0, len(text), per_member))
    return out[:-5] if torn else out


def test_export_splits(spark, tmp_path):
    """Rows are those of the whole file, in order, however it is split."""
    import random

    r = random.Random(6)
    text = ["".join(r.choices("abcdef ü日", k=r.randrange(0, 90))) for _ in range(2000)] + ["x" * 5000, "", "last"]
    made = {
        "a-many": members(text, 700),
        "b-one": gzip.compress("\n".join(text).encode() + b"\n"),
        "c-lines": b"".join(gzip.compress((t + "\n").encode()) for t in text[:300]) + b"\0" * 100,
        "d-inside": members(["p" + gzip.compress(b"no member").decode("latin1").replace("\n", "") for _ in range(50)], 300),
        "e-crlf": gzip.compress(b"u\r\nv\r\n") + gzip.compress(b"w"),
    }
    for name, data in made.items():
        (tmp_path / f"{STAMP}-n-0-{name}-0.ndjson.gz").write_bytes(data)
    (tmp_path / "sub").mkdir()
    (tmp_path / f"sub/{STAMP}-n-0-plain-0.ndjson").write_bytes("\n".join(text).encode())
    (tmp_path / f"sub/{STAMP}-n-0-none-0.ndjson").write_bytes(b"")
    want = {f"{k[0]}": gzip.decompress(v).decode("utf-8", "replace") for k, v in made.items()} | {"p": "\n".join(text)}
    for split in (1 << 30, 40_000, 1000, 97):
        got = {}
        if split < 1000:  # small files only: a task for every few bytes
            rows = exports.read_export(spark, str(tmp_path), split, ["e-crlf", "d-inside"])
        else:
            rows = exports.read_export(spark, str(tmp_path), split)
        for x in rows.orderBy("table", "place").collect():
            got.setdefault(x["table"][0], []).append(x["value"])
        assert got == {k: [t.removesuffix("\r") for t in want[k].split("\n") if t.strip(" ") and t != "\r"] for k in got} and len(got) == (2 if split < 1000 else 6)
    assert listing(spark, str(tmp_path), "*.ndjson").count() == 2 and listing(spark, str(tmp_path)).count() == 7


class Counted(io.BytesIO):
    """Bytes as a file that counts what is read."""

    n = 0

    def read(self, size=-1):
        data = super().read(size)
        self.n += len(data)
        return data


def test_small_splits_share_tasks(tmp_path):
    """Tasks follow the bytes of files, not the number of splits or files; a range that tasks share has each line once."""
    text = [f"{k} {'x' * (k % 60)}" for k in range(250_000)]
    name = f"{STAMP}-n-0-big-0.ndjson"
    (tmp_path / name).write_text("\n".join(text))
    reader = exports.ExportReader(str(tmp_path), 2000)
    parts = reader.partitions()
    assert len(parts) == -(-(tmp_path / name).stat().st_size // 4_194_000) == 3  # whole splits of 4 MB
    got = [row for p in parts for b in reader.read(p) for row in zip(*(b.column(c).to_pylist() for c in ("block", "line", "value")), strict=True)]
    assert [v for _, _, v in got] == text and [g[:2] for g in got] == sorted({g[:2] for g in got}) and all(b % 2000 == 0 for b, _, _ in got)
    for k in range(40):
        put(str(tmp_path), f"{STAMP}-n-{k}-small-0.ndjson", [{"id": "1"}])
    reader.filters = [exports.EqualTo(("table",), "small")]
    parts = reader.partitions()
    assert len(parts) == 3 and sum(b.num_rows for p in parts for b in reader.read(p)) == 40
    for split, sizes in ((2000, [4, 4, 1]), (3 << 20, [3, 3, 3]), (64 << 20, [9])):  # the larger of a task's size and a split
        reader = exports.ExportReader(str(tmp_path), split)
        reader.filters = [exports.EqualTo(("table",), "big")]
        assert [round(sum(r.end - r.start for r in p.ranges) / 1e6) for p in reader.partitions()] == sizes


@pytest.mark.parametrize("name, data, times", [
    ("t.ndjson", b"".join(b"%d\n" % k for k in range(100_000)), 12),
    ("t.ndjson", b"x" * 600_000 + b"\n", 3),  # splits within a line
    ("t.ndjson.gz", b"".join(gzip.compress(b"%d\n" % k * 50) for k in range(5_000)), 60),
])
def test_small_splits_read_little_beyond_them(name, data, times):
    raw, found = Counted(data), []
    for at in range(0, len(data), 2000):
        split = exports.Split(name, name, "t", 0, at, min(at + 2000, len(data)), len(data))
        found += exports.lines(exports.pieces(raw, split), at == 0)
    assert found == (gzip.decompress(data) if name.endswith("gz") else data).split(b"\n")[:-1]
    assert raw.n < times * len(data)


def test_export_of_orders(spark, tmp_path):
    """Files have their rows in order, whole, whatever batches their writer gets them in."""
    spark.range(3001).selectExpr("id * 7919 % 3001 as o_orderkey", "id as o_custkey", "if(id % 3 = 0, 'F', 'O') as o_orderstatus").write.parquet(str(tmp_path / "orders.parquet"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 70)
    try:
        folder = queries._export(spark, str(tmp_path)).removeprefix("file://")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for key, cust in sorted((k * 7919 % 3001, k) for k in range(3001)):
        want.setdefault(f"orders_{'o' if cust % 3 else 'f'}-{key % 4}", []).append(json.dumps({"id": str(key), "cust": cust}, separators=(",", ":")))
    made = {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith((".ndjson", ".gz"))}
    for path in made:
        raw = open(path, "rb").read()
        key = "-".join(path.rpartition("/")[2].split(".")[0].split("-")[-2:])
        assert (gzip.decompress(raw) if path.endswith("gz") else raw).decode().split("\n") == [*want.pop(key), ""]
        assert path.endswith("gz") == (key[-1] in "02") and (f"/more/{key[-1]}/" in path) == (key[-1] in "23")
    assert not want


def test_torn_gzip_is_an_error(spark, tmp_path):
    (tmp_path / f"{STAMP}-n-0-t-0.ndjson.gz").write_bytes(members(["abc" * 50] * 90, 500, torn=True))
    for split in (1 << 20, 300):
        with pytest.raises(Exception, match="torn"):
            exports.read_export(spark, str(tmp_path), split).count()


def test_names_are_pruned_before_files_are_opened(spark, tmp_path):
    put(str(tmp_path), f"{STAMP}-n1-0-orders-0.ndjson", [{"id": "1"}])
    later = "2040" + STAMP[4:]
    put(str(tmp_path), f"{later}-n1-0-orders-1.ndjson", [{"id": "2"}])
    (tmp_path / f"{STAMP}-n1-0-broken-0.ndjson.gz").write_bytes(b"no gzip")
    rows = exports.read_export(spark, str(tmp_path))
    assert rows.where("table = 'orders'").count() == 2  # the broken one is not opened
    assert rows.where(f"table in ('orders', 'x') and file_us > {AT}").count() == 1
    assert rows.where(f"table = 'orders' and file_us <= {AT} and value like '%1%'").count() == 1
    assert rows.where("table = 'nothing'").count() == 0
    assert exports.read_export(spark, str(tmp_path), tables=["orders"]).count() == 2
    plan = rows.where("table = 'orders'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and "table" not in plan[plan.index("Filter") :].split("\n")[0]  # only the blank lines are left to Spark


def test_decode(spark):
    good = json.dumps({"operation": "insert", "id": "e", "table": "t", "key": ["1"], "after": {"id": "1", "n": {"k": [1]}}})
    df = spark.createDataFrame([(good.encode(),), (gzip.compress(good.encode()),), (b"{oops",), (b'{"id":"x"}',), (None,)], "value binary")
    events, broken = se.decode(df, compressed=True)
    rows = events.collect()
    assert len(rows) == 2 and json.loads(rows[0]["after"]) == {"id": "1", "n": {"k": [1]}} and rows[0]["timestamp"] == 0
    assert broken.count() == 3
    assert se.subjects(["a"]) == ["dbchange.*.*.a.*.PUBLIC.>"] and se.subjects(None) == ["dbchange.>"]


def test_filters(spark):
    e = spark.createDataFrame([("a", 5), ("a", 10), ("b", 1), ("A", 1)], "table string, timestamp long")
    cut = spark.createDataFrame([("a", 5)], "table string, cutoff_ms long")
    assert sorted(map(tuple, filters.after_import(e, cut).collect())) == [("A", 1), ("a", 10), ("b", 1)]
    ok, bad = filters.guarded(spark.createDataFrame([("good_1",), ("bad-1",), (None,)], "table string"))
    assert (ok.count(), bad.count()) == (1, 2)
    known = spark.createDataFrame([("B",)], "t string")
    assert filters.known_tables(e, known).count() == 1
    assert filters.small_notices(spark.createDataFrame([("x" * 5,), ("y",)], "value string"), most=2).count() == 1


def test_alert_cooldown(spark):
    times = [0, 10, 299, 300, 301, 599, 600, 5000]
    df = spark.createDataFrame([(c, t, x) for c in ("mail", "chat") for t in ("down", None) for x in times] + [("mail", "down", 0), ("mail", "down", None)], "channel string, title string, at long")
    sent = {}
    for r in cooldown.alert_cooldown(df, 300).collect():
        sent.setdefault((r["channel"], r["title"]), []).append(r["at"])
    assert all(sorted(v) == [0, 300, 600, 5000] for v in sent.values()) and len(sent) == 4
    assert cooldown.alert_cooldown(df, 0).count() == 32
    assert cooldown.alert_cooldown(df.limit(0), 300).count() == 0


def one_by_one(times, seconds):
    sent = []
    for t in sorted(set(times)):
        if not sent or t - sent[-1] >= seconds:
            sent.append(t)
    return sent


def test_alert_cooldown_over_spans(spark):
    """Dense and sparse keys, spans shorter than the cooldown, times before zero."""
    import random

    r = random.Random(1)
    rows = [(1, t) for t in range(-500, 3000) if r.random() < 0.7] + [(2, r.randrange(-10_000, 10_000)) for _ in range(300)] + [(None, 7), (3, -1)]
    df = spark.createDataFrame(rows + rows[:50], "k int, t long")
    for seconds, span in ((7, 20), (50, 10), (1, 5), (400, 1000), (100_000, 60)):
        got = {}
        for x in cooldown.alert_cooldown(df, seconds, ("k",), "t", span).collect():
            got.setdefault(x["k"], []).append(x["t"])
        assert {k: sorted(v) for k, v in got.items()} == {k: one_by_one([t for j, t in rows if j == k], seconds) for k in (1, 2, 3, None)}


def test_alert_cooldown_of_a_stream(spark, tmp_path):
    import random

    r = random.Random(2)
    times = sorted(r.sample(range(2000), 300))
    os.makedirs(tmp_path / "in")
    stream = spark.readStream.schema("channel string, title string, at long").option("maxFilesPerTrigger", 1).option("latestFirst", "false").json(str(tmp_path / "in"))
    for k in range(3):
        send(str(tmp_path / "in"), f"{k}.json", *[{"channel": c, "title": "t", "at": t} for c in "ab" for t in times[100 * k : 100 * k + 100]])
        os.utime(tmp_path / f"in/{k}.json", (1000 + k, 1000 + k))
    q = cooldown.alert_cooldown_stream(stream, 60).writeStream.format("memory").queryName("sent").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    for c in "ab":
        assert sorted(x["at"] for x in spark.table("sent").where(f"channel = '{c}'").collect()) == one_by_one(times, 60)


def test_progress_and_batches(spark):
    jobs = spark.createDataFrame([("a", "completed"), ("b", "running"), ("c", "Completed")], "table string, status string")
    assert metrics.progress(jobs).first()["line"] == "2/3 (66%)"
    assert metrics.progress(jobs.limit(0)).first()["line"] == "0/0 (0%)"
    e = spark.range(0, 40_000).select(F.col("id").alias("seq"), (F.col("id") % 2).alias("k"))
    got = metrics.flush_batches(e, 500, ["k"], "seq").where("seq in (0, 998, 1000, 39999)").orderBy("seq").select("batch").collect()
    assert [r[0] for r in got] == [0, 0, 1, 39]
    h = {r["le"]: r["n"] for r in metrics.histogram(spark.createDataFrame([(0.5,), (1.0,), (3.0,), (None,)], "v double"), "v", [1.0, 2.0]).collect()}
    assert h == {1.0: 2, 2.0: 2, None: 3}


def test_schema_evolution(spark):
    old = Schema("t", "1", {"id": Property(), "qty": Property("integer"), "name": Property()}, ("id",))
    new = Schema("t", "2", {"id": Property(), "qty": Property("number"), "note": Property()}, ("id",))
    assert evolve.diff(old, new) == {"added": ["note"], "changed": ["qty"], "removed": ["name"]}
    m = spark.createDataFrame([("1", 3, "x")], "id string, qty long, name string")
    assert evolve.reshape(m, new).first().asDict() == {"id": "1", "note": None, "qty": 3.0}
    assert evolve.add_missing(m, new).columns == ["id", "qty", "name", "note"]
    assert evolve.usable_columns(new, ["ID", "qty"]) == ["id", "qty"]
    assert evolve.needs_migration(None, "1") and evolve.needs_migration("1", "2") and not evolve.needs_migration("2", "1") and not evolve.needs_migration("2", "2") and evolve.needs_migration("a", "b")


def test_schema_sources(spark, tmp_path):
    (tmp_path / "orders.json").write_text(json.dumps({"modelVersion": 3, "properties": {"id": {"type": "string"}, "t": {"type": "array", "items": {"enum": ["a"]}}}, "primaryKeys": ["id"]}))
    (tmp_path / "bad.json").write_text("{")
    found = schemas.load_directory(str(tmp_path))
    assert list(found) == ["orders"] and found["ORDERS"].version == "3" and found["orders"].properties["t"].enum
    calls = []

    def fetch():
        calls.append(1)
        return [{"table": "t", "properties": {"id": {"type": "string"}}}]

    def down():
        raise OSError

    cache = str(tmp_path / "cache")
    for now, f in ((0, fetch), (10, down), (90_000, fetch), (200_000, down)):
        assert "T" in schemas.load_cached(cache, f, now=lambda now=now: now)
    assert len(calls) == 2
    assert schemas.reflect(spark.range(1), "r").properties["id"].type == "integer"
    columns = spark.createDataFrame([("a", "id", "BIGINT", "NO"), ("a", "at", "timestamp with time zone", "YES"), ("B", "x", "character varying", "YES"), ("B", "y", "NUMBER(10)", "no")], "t string, c string, k string, n string")
    found = schemas.of_columns(columns)
    assert sorted(found) == ["a", "b"] and found["a"].properties == {"id": Property("integer"), "at": Property(format="date-time", nullable=True)}
    assert found["b"].properties == {"x": Property(nullable=True), "y": Property("number")} and "o''brien" in schemas.columns_sql("o'brien")
    import duckdb

    db = duckdb.connect()
    db.execute('create table "Lots" (id bigint not null, note varchar, price double, is_open boolean, made timestamp)')
    rows = db.execute(schemas.columns_sql("main")).fetchall()
    lots = schemas.of_columns(spark.createDataFrame(rows, "t string, c string, k string, n string"))["lots"]
    assert {n: (p.type, p.format, p.nullable) for n, p in lots.properties.items()} == {"id": ("integer", None, False), "note": ("string", None, True), "price": ("number", None, True), "is_open": ("boolean", None, True), "made": ("string", "date-time", True)}


def test_store(spark, tmp_path):
    store = MirrorStore(spark, str(tmp_path / "m"))
    assert store.read() is None
    assert store.commit(spark.range(3), 0) and not store.commit(spark.range(9), 0)
    assert store.commit(store.read().union(spark.range(2)), 1) and store.read().count() == 5
    store.commit(spark.range(1), 2)
    assert sorted(n for n in os.listdir(tmp_path / "m") if n.startswith("v=")) == ["v=1", "v=2"]
    kv = KeyValues(spark, str(tmp_path / "kv"))
    kv.set({"a_b": "1", "axb": "2", "a_c": "ü"})
    kv.delete_prefix("a_")
    assert kv.all() == {"axb": "2"} and kv.get("no", "d") == "d"


def test_file_sinks(spark, tmp_path):
    rows = [("insert", "e1", "orders", 5), ("delete", "e2", "items", 6)]
    df = spark.createDataFrame(rows, "operation string, id string, table string, timestamp long")
    for _ in range(2):
        objects.write_objects(df, str(tmp_path / "o"), "pre/")
    assert json.loads((tmp_path / "o/pre/orders/5-e1.json").read_text())["operation"] == "insert"
    assert sorted(str(p.relative_to(tmp_path / "o")) for p in (tmp_path / "o").rglob("*") if p.is_file()) == ["pre/items/6-e2.json", "pre/orders/5-e1.json"]
    files.write_json(df, str(tmp_path / "j"))
    assert sorted(p for p in os.listdir(tmp_path / "j") if "=" in p) == ["folder=items", "folder=orders"]
    files.dry_run(df)


def test_a_task_that_fails_leaves_no_object(spark, tmp_path):
    fails = F.when(F.col("n") == 99, F.raise_error(F.lit("half way"))).otherwise(F.lit("orders"))
    df = spark.range(100).repartition(1).sortWithinPartitions("id").select(F.col("id").alias("n"), F.lit("insert").alias("operation"), F.col("id").cast("string").alias("id"), F.col("id").alias("timestamp"))
    with pytest.raises(Exception, match="half way"):
        objects.write_objects(df.withColumn("table", fails), str(tmp_path / "o"))
    assert not [p for p in (tmp_path / "o").rglob("*") if p.is_file()] if (tmp_path / "o").exists() else True
    objects.write_objects(df.withColumn("table", F.lit("orders")), str(tmp_path / "o"))
    assert len(list((tmp_path / "o/orders").iterdir())) == 100 and [p.name for p in (tmp_path / "o").iterdir()] == ["orders"]


def packed(x):
    """A small MessagePack writer, for tests."""
    import struct

    if x is None or isinstance(x, bool):
        return {None: b"\xc0", False: b"\xc2", True: b"\xc3"}[x]
    if isinstance(x, int):
        return struct.pack("b", x) if -32 <= x < 128 else b"\xd3" + struct.pack(">q", x) if x < 1 << 63 else b"\xcf" + struct.pack(">Q", x)
    if isinstance(x, float):
        return b"\xcb" + struct.pack(">d", x)
    if isinstance(x, bytes):
        return b"\xc5" + struct.pack(">H", len(x)) + x
    if isinstance(x, str):
        b = x.encode()
        return (bytes([0xA0 | len(b)]) if len(b) < 32 else b"\xd9" + bytes([len(b)]) if len(b) < 256 else b"\xda" + struct.pack(">H", len(b))) + b
    n = len(x)
    if isinstance(x, dict):
        return (bytes([0x80 | n]) if n < 16 else b"\xde" + struct.pack(">H", n)) + b"".join(packed(k) + packed(v) for k, v in x.items())
    return (bytes([0x90 | n]) if n < 16 else b"\xdd" + struct.pack(">I", n)) + b"".join(map(packed, x))


def test_messagepack(spark):
    """MessagePack and JSON of the same events are the same rows; what is broken is refused."""
    many = {f"c{k}": k for k in range(20)} | {"big": 1 << 62, "neg": -5, "low": -40_000, "f": 0.5, "t": "ü" * 40, "long": "x" * 300, "null": None, "yes": True, "list": list(range(17)), "nested": {"a": [{}, []]}}
    events = [change(1, "insert", "a", many), change(2, "delete", "b"), change(3, "update", "c", {"id": "c"}, diff=["id"], companyId="7", imported=False)]
    rows = [(json.dumps(e).encode(), "application/json") for e in events] + [(packed(e), "application/msgpack") for e in events]
    bad = [b"\xc1", packed(events[0])[:-1], packed(events[0]) + b"\x00", b"", b"\xcb\x7f\xf8\0\0\0\0\0\0", packed([1]), packed({"id": "x"}), b"\x91" * 5000, None, b"\xa2\xff\xff"]
    df = spark.createDataFrame(rows + [(b, "application/msgpack") for b in bad], "value binary, kind string")
    got, broken = se.decode(df, packed=F.col("kind") == "application/msgpack")
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r["id"], []).append(r.asDict())
    for a, b in by_id.values():
        assert {k: v for k, v in a.items() if k != "after"} == {k: v for k, v in b.items() if k != "after"}
        assert (a["after"] and json.loads(a["after"])) == (b["after"] and json.loads(b["after"]))
    assert sorted(by_id) == ["e1", "e2", "e3"] and json.loads(by_id["e1"][1]["after"]) == many and broken.count() == len(bad)
    zipped = df.where("kind like '%msgpack'").rdd.map(lambda r: (r[0] and gzip.compress(r[0]),)).toDF("value binary")
    assert se.decode(zipped, compressed=True, packed=True)[0].count() == 3
    from tidelog.sources.msgpack import to_json

    assert to_json(b"\xd6\xff\0\0\0\x3c") == '"1970-01-01T00:01:00+00:00"' and to_json(b"\xd7\xff" + ((5000 << 34) | 60).to_bytes(8, "big")) == '"1970-01-01T00:01:00.000005+00:00"'
    assert to_json(packed(b"ab")) == '"YWI="' and to_json(b"\xd4\x05z") == '"eg=="' and to_json(packed({1: 2})) == '{"1": 2}'


def test_registry_and_dialects():
    assert registry.parse("PostgreSQL://u:p%40@h/db").options == {"url": "jdbc:postgresql://h:5432/db", "user": "u", "password": "p@"}
    assert registry.parse("kafka://h:1/topic").max_batch == 1000 and registry.parse("s3://b/x").options["path"] == "s3a://b/x"
    assert registry.parse("azureblob://acct/box/a/b?key=k").options == {"path": "abfss://box@acct.dfs.core.windows.net/a/b", "key": "k"}
    for bad in ("nothing", "redis://x/y", "mysql://host", "kafka://h:1", "azureblob://acct"):
        with pytest.raises(ValueError):
            registry.parse(bad)
    assert registry.delays("import") == [30, 60, 120, 240, 480]
    odd = Schema("t", "1", {"id": Property(), 'c"n': Property("integer", nullable=True)}, ("id",), ("id",))
    assert dialects.create_table(odd, "postgres") == 'CREATE TABLE "t" ("id" TEXT NOT NULL, "c""n" BIGINT, PRIMARY KEY ("id"))'
    assert "PRIMARY KEY" not in dialects.create_table(Schema("t", "1", {"a": Property()}), "snowflake")
    assert dialects.DIALECTS["mysql"].string("a\\'b") == "'a\\\\''b'" and dialects.DIALECTS["sqlserver"].string("x") == "N'x'"
    assert dialects.recreate_table(odd, "mysql")[0] == "DROP TABLE IF EXISTS `t`" and dialects.recreate_table(odd, "mysql")[1].startswith("CREATE TABLE `t`")
    only_key = Schema("t", "1", {"id": Property()}, ("id",))
    assert dialects.merge(only_key, "s", "postgres")[1].endswith("DO NOTHING")
    for d in dialects.DIALECTS:
        for text in [*dialects.merge(odd, "stage", d), *dialects.add_columns(odd, ['c"n'], d), *dialects.change_columns(odd, ['c"n'], d), *dialects.drop_columns("t", ["x"], d)]:
            a, b = dialects.DIALECTS[d].quotes
            assert text.count(a) == text.count(b) and text.count(a) % (2 if a == b else 1) == 0


def send(folder, name, *events):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events))


def change(n, op, key, after=None, table="orders", **more):
    return {"operation": op, "id": f"e{n}", "table": table, "key": ["", key] if op == "delete" else [key], "timestamp": n, "after": after} | more


def test_delivery(spark, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "out")
    send(inbox, "1.json", change(1, "insert", "a", {"id": "a", "name": "x"}), change(2, "insert", "b", {"id": "b", "name": "y"}), "{broken", change(3, "insert", "q", {}, table="bad-name"), change(4, "insert", "z", {}, table="unknown"))
    d = Delivery(root, Catalog([ORDERS]))
    for _ in range(2):
        deliver(se.stream_events(spark, inbox), d, str(tmp_path / "ck")).awaitTermination()
        send(inbox, "2.json", change(5, "update", "a", {"id": "a", "name": "z"}, diff=["name"]), change(6, "delete", "b"))
    assert {r["id"]: r["name"] for r in d.mirror(spark, "orders").read().collect()} == {"a": "z"}
    assert spark.read.parquet(f"{root}/dead").count() == 1 and spark.read.parquet(f"{root}/broken").count() == 1
    assert spark.read.parquet(f"{root}/parked").count() == 1
    before = d.mirror(spark, "orders").state()
    d(spark.read.text(inbox), 0)  # a batch that is repeated
    assert d.mirror(spark, "orders").state() == before


def test_time_series_delivery_and_dead_letters(spark, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "out")
    send(inbox, "1.json", change(1, "insert", "a", {"id": "a"}), change(2, "update", "a", {"id": "a"}), change(3, "insert", "b", {"id": "b"}))
    cut = spark.createDataFrame([("orders", 1)], "table string, cutoff_ms long")
    d = Delivery(root, Catalog([ORDERS]), mode="time_series", cutoffs=cut)
    deliver(se.stream_events(spark, inbox), d, str(tmp_path / "ck")).awaitTermination()
    assert sorted(r["_seq"] for r in d.log(spark, "orders").collect()) == [1, 2] and d.current(spark, "orders").count() == 2
    d(spark.read.text(inbox), 0)  # again
    d(spark.read.text(inbox), 1)
    assert sorted(r["_seq"] for r in d.log(spark, "orders").collect()) == [1, 2, 3, 4]
    waits = []
    failing = Delivery(str(tmp_path / "f"), Catalog([ORDERS]), sleep=waits.append)
    failing._apply = lambda *a: (_ for _ in ()).throw(RuntimeError("connection refused"))
    failing(spark.read.text(inbox), 0)
    assert waits == [2, 4, 8, 16]
    assert {r["error"] for r in spark.read.parquet(f"{tmp_path}/f/dead").collect()} == {"connection refused"}


def test_late_event_wins_in_a_mirror(spark, tmp_path):
    """Mirrors follow arrival: what comes later counts, whatever its time."""
    inbox = str(tmp_path / "in")
    send(inbox, "1.json", change(200, "insert", "a", {"id": "a", "name": "first"}), change(100, "update", "a", {"id": "a", "name": "late"}))
    d = Delivery(str(tmp_path / "out"), Catalog([ORDERS]))
    deliver(se.stream_events(spark, inbox), d, str(tmp_path / "ck")).awaitTermination()
    assert d.mirror(spark, "orders").read().first()["name"] == "late"
    by_time = Delivery(str(tmp_path / "t"), Catalog([ORDERS]), order=["timestamp", "id"])
    by_time(spark.read.text(inbox), 0)
    assert by_time.mirror(spark, "orders").read().first()["name"] == "first"


class Lost(BaseException):
    """The driver is gone."""


def losing(monkeypatch, step, times=1):
    """From now on the driver is lost just before a step of Folder.create, so often."""
    left, real = [times], Folder.__init__

    def init(self, *args):
        real(self, *args)
        fs = self.fs

        class Fs:
            def __getattr__(self, name):
                if name == step and left[0]:
                    left[0] -= 1
                    raise Lost
                return getattr(fs, name)

        self.fs = Fs()

    monkeypatch.setattr(Folder, "__init__", init)


@pytest.mark.parametrize("step", ["create", "exists", "rename"])
def test_state_survives_lost_drivers(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "s")
    KeyValues(spark, path).set({"seq": "7"})
    for times in (1, 2):
        with monkeypatch.context() as m:
            losing(m, step, times)
            for _ in range(times):
                with pytest.raises(Lost):
                    KeyValues(spark, path).set({"seq": "8"})
        assert KeyValues(spark, path).all() == {"seq": "7"}
    (tmp_path / "s/.part-torn").write_text("")  # begun by one that was lost
    KeyValues(spark, path).set({"x": "1"})
    assert KeyValues(spark, path).all() == {"seq": "7", "x": "1"} and not (tmp_path / "s/.part-torn").exists()


def test_ledger(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"))
    assert ledger.read() == (-1, {})
    for k in range(5):
        assert ledger.commit({"k": k}) == k
    assert ledger.read() == (4, {"k": 4}) and len([n for n in os.listdir(tmp_path / "l") if n.endswith("json")]) == 3
    with pytest.raises(FileExistsError):  # two writers that both saw commit 3
        ledger.commit({"k": 9}, 3)
    for torn in ("", "[]", '{"k":'):
        (tmp_path / "l/00000000000000000005.json").write_text(torn)
        with pytest.raises(ValueError):
            ledger.read()


def test_only_touched_buckets_are_written(spark, tmp_path):
    numbers = Schema("orders", "1", {"id": Property("integer"), "name": Property(nullable=True)}, ("id",))
    d = Delivery(str(tmp_path / "out"), Catalog([numbers]), buckets=8)

    def batch(n, *events):
        d(spark.createDataFrame([(json.dumps(e),) for e in events], "value string"), n)

    batch(0, *[change(k, "insert", str(k), {"id": k, "name": "x"}) for k in range(40)])
    first = d.mirror(spark, "orders").state()["at"]
    assert len(first) == 8
    batch(1, change(50, "update", "3", {"id": 3, "name": "y"}), change(51, "insert", "0099", {"id": 99, "name": "z"}), change(52, "delete", "7"))
    store = d.mirror(spark, "orders")
    got = {r["id"]: r["name"] for r in store.read().collect()}
    assert got == {k: "x" for k in range(40) if k != 7} | {3: "y", 99: "z"}
    assert 0 < sum(v == 1 for v, _ in store.state()["at"].values()) <= 4
    batch(2, *[change(60 + k, "delete", str(k)) for k in [*range(40), 99]])
    batch(3, change(200, "insert", "5", {"id": 5}))
    assert [r["id"] for r in d.mirror(spark, "orders").read().collect()] == [5]
    assert sorted(n for n in os.listdir(tmp_path / "out/mirror/orders") if n.startswith("v=")) == ["v=3"]


def test_batch_stopped_half_way(spark, tmp_path):
    """What a batch leaves beside its tables is there once, however often it is tried."""
    inbox, root = str(tmp_path / "in"), str(tmp_path / "out")
    send(inbox, "1.json", "{broken", change(1, "insert", "a", {"id": "a"}), change(2, "insert", "z", {}, table="unknown"), change(3, "insert", "q", {}, table="bad-name"))
    d = Delivery(root, Catalog([ORDERS]))
    real, d._fold = d._fold, lambda *a: (_ for _ in ()).throw(SystemExit)
    with pytest.raises(SystemExit):
        d(spark.read.text(inbox), 0)
    d._fold = real
    for _ in range(2):
        d(spark.read.text(inbox), 0)
    assert [spark.read.parquet(f"{root}/{x}").count() for x in ("broken", "dead", "parked")] == [1, 1, 1]
    assert d.mirror(spark, "orders").read().count() == 1


def batch_of(spark, *events):
    return spark.createDataFrame([(e if isinstance(e, str) else json.dumps(e),) for e in events], "value string")


def rows_of(delivery, spark, table):
    df = delivery.mirror(spark, table).read()
    return None if df is None else {r["id"]: r.asDict() for r in df.collect()}


ITEMS = Schema("items", "1", {"id": Property(), "name": Property(nullable=True)}, ("id",), ("id",))


def failing(monkeypatch, table, error, times=1 << 30):
    """From now on writing a table's buckets fails, so often."""
    left, real = [times], Buckets.write

    def write(self, *args):
        if self.path.endswith(table) and left[0]:
            left[0] -= 1
            raise error
        return real(self, *args)

    monkeypatch.setattr(Buckets, "write", write)


def test_a_batch_is_all_or_nothing(spark, tmp_path, monkeypatch):
    """One table of two fails for good: neither has the batch, and the dead letters are those of both, once."""
    root = str(tmp_path / "out")
    d = Delivery(root, Catalog([ORDERS, ITEMS]), sleep=lambda s: None)
    d(batch_of(spark, change(1, "insert", "a", {"id": "a", "name": "x"}), change(2, "insert", "i", {"id": "i", "name": "x"}, table="items")), 0)
    more = batch_of(spark, change(3, "update", "a", {"id": "a", "name": "y"}), change(4, "insert", "j", {"id": "j"}, table="items"), change(5, "insert", "z", {}, table="unknown"))
    with monkeypatch.context() as m:
        failing(m, "orders", RuntimeError("disk full"))  # items come first and are written
        d(more, 1)
    assert rows_of(d, spark, "orders") == {"a": {"id": "a", "name": "x"}} and list(rows_of(d, spark, "items")) == ["i"]
    assert sorted((r["event_id"], r["error"], r["retry_count"]) for r in d.dead_letters(spark).collect()) == [(f"e{k}", "disk full", 5) for k in (3, 4, 5)]
    assert d.committed(spark)["dead"] == [1] and sorted(os.listdir(tmp_path / "out/mirror/items")) == ["v=0"]
    d(more, 1)  # repeated by Spark: it was given up
    assert rows_of(d, spark, "orders")["a"]["name"] == "x"
    with monkeypatch.context() as m:
        failing(m, "orders", RuntimeError("busy"), 2)  # the third try holds
        d(more, 2)
    assert rows_of(d, spark, "orders")["a"]["name"] == "y" and sorted(rows_of(d, spark, "items")) == ["i", "j"]
    assert d.dead_letters(spark).count() == 3 and spark.read.parquet(f"{root}/parked").where("batch = 2").count() == 1


@pytest.mark.parametrize("mode", ["upsert", "time_series"])
def test_lost_drivers_leave_a_batch_to_its_repeat(spark, tmp_path, monkeypatch, mode):
    d = Delivery(str(tmp_path / "out"), Catalog([ORDERS, ITEMS]), mode=mode, attempts=1)
    first = batch_of(spark, change(1, "insert", "a", {"id": "a", "name": "x"}), change(2, "insert", "i", {"id": "i"}, table="items"))
    again = batch_of(spark, change(3, "update", "a", {"id": "a", "name": "y"}), change(4, "insert", "j", {"id": "j"}, table="items"))

    def now():
        if mode == "upsert":
            return rows_of(d, spark, "orders"), rows_of(d, spark, "items")
        return [sorted((r["_seq"], r["_event_id"]) for r in d.log(spark, t).collect()) for t in ("orders", "items")]

    d(first, 0)
    before = now()
    for step in ("rename", "create", "rename"):
        with monkeypatch.context() as m:
            losing(m, step)
            with pytest.raises(Lost):
                d(again, 1)
        assert now() == before  # nothing of the batch shows
    d(again, 1)
    after = now()
    d(again, 1)
    assert now() == after != before
    if mode == "time_series":
        assert after == [[(1, "e1"), (3, "e3")], [(2, "e2"), (4, "e4")]]
    else:
        assert after[0]["a"]["name"] == "y" and sorted(after[1]) == ["i", "j"]


def test_redelivered_events_are_logged_once(spark, tmp_path):
    """Repeats within a batch, of the batch before, and of a day ago."""
    d = Delivery(str(tmp_path / "out"), Catalog([ORDERS]), mode="time_series", once=True)
    day = 86_400_000
    at = lambda n, t: change(n, "insert", f"k{n}", {"id": f"k{n}"}) | {"timestamp": t}
    d(batch_of(spark, at(1, 5), at(2, 6), at(1, 5)), 0)
    d(batch_of(spark, at(3, day), at(2, 6), at(4, 7)), 1)
    d(batch_of(spark, at(5, 2 * day), at(1, 5), at(3, day), at(4, 7)), 2)
    d(batch_of(spark, at(5, 2 * day)), 3)
    assert sorted((r["_seq"], r["_event_id"]) for r in d.log(spark, "orders").collect()) == [(1, "e1"), (2, "e2"), (3, "e3"), (4, "e4"), (5, "e5")]
    status = d.committed(spark)["status"]
    assert status == {"events": 5, "batches": 4, "given_up": 0, "last_event_ms": 2 * day, "last_table": "orders"}


def test_unseen_over_many_stretches(spark, monkeypatch):
    e = spark.range(2000).select(F.col("id").cast("string").alias("id"), (F.col("id") * 5_000_000).alias("timestamp"))
    log = e.where("id % 3 = 0").select(F.col("id").alias("_event_id"), F.col("timestamp").alias("_timestamp"))
    for most in (5, 200):
        monkeypatch.setattr(redelivery, "STRETCHES", most)
        for newest in (None, -1, 500_000_000, 3_000_000_000, 10**11):
            got = {int(r["id"]) for r in redelivery.unseen(e, log.where(f"_timestamp <= {newest or 0}") if newest else log.limit(0), newest).collect()}
            assert got == {k for k in range(2000) if not (newest and k % 3 == 0 and k * 5_000_000 <= newest)}


def test_heartbeat_of_a_running_delivery(spark, tmp_path):
    import time

    inbox = str(tmp_path / "in")
    for k in range(2):
        send(inbox, f"{k}.json", *[change(10 * k + j, "insert", f"k{j}", {"id": f"k{j}"}) for j in range(3)])
        os.utime(os.path.join(inbox, f"{k}.json"), (1000 + k, 1000 + k))
    d = Delivery(str(tmp_path / "out"), Catalog([ORDERS]))
    beat = monitor.Heartbeat(spark, str(tmp_path / "beat"), 0, lambda: d.committed(spark))
    spark.streams.addListener(beat)
    try:
        deliver(se.stream_events(spark, inbox, max_files=1), d, str(tmp_path / "ck")).awaitTermination()
        for _ in range(100):
            if beat.read().get("status") == "stopped":
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(beat)
    now = beat.read()
    assert now["status"] == "stopped" and now["rows_read"] >= 6 and now["batch"] == 1 and now["sequence"] >= 3 and now["error"] is None
    assert now["last"] == {"events": 6, "batches": 2, "given_up": 0, "last_event_ms": 12, "last_table": "orders"}
    assert monitor.pending({"sources": [{"metrics": {"numFilesOutstanding": "4"}}]}) == 4 and monitor.pending({"sources": [{"metrics": {}}]}) is None


def test_current_view_of_a_stream(spark, tmp_path):
    """Equals the view over the whole log, however the events are split into batches."""
    import random

    from tidelog.model import EVENTS_TABLE
    from tidelog.operators import views

    r = random.Random(8)
    rows = [{"_seq": k, "_event_id": f"e{k}", "_operation": r.choice(["insert", "update", "delete"]), "_entity_id": f"k{r.randrange(15)}", "_timestamp": r.choice([None, r.randrange(40)]), "_mvcc_ts": None, "_company_id": None, "_location_id": None, "_model_ver": "1", "_diff": None, "_before": None, "_after": "{}"} for k in range(200)]
    want = sorted(tuple(x)[:5] for x in views.current(spark.createDataFrame([tuple(x.values()) for x in rows], EVENTS_TABLE)).collect())
    for n in (1, 4):
        part = tmp_path / str(n)
        os.makedirs(part / "in")
        shuffled = r.sample(rows, len(rows))
        for k in range(n):
            send(str(part / "in"), f"{k}.json", *shuffled[k * 200 // n : (k + 1) * 200 // n])
        stream = spark.readStream.schema(EVENTS_TABLE).option("maxFilesPerTrigger", 1).json(str(part / "in"))
        views.current_stream(stream).writeStream.format("memory").queryName(f"now{n}").outputMode("append").option("checkpointLocation", str(part / "ck")).trigger(availableNow=True).start().awaitTermination()
        assert sorted(tuple(x)[:5] for x in views.current(spark.table(f"now{n}")).collect()) == want


def test_a_given_up_log_batch_shows_nothing(spark, tmp_path, monkeypatch):
    d = Delivery(str(tmp_path / "out"), Catalog([ORDERS]), mode="time_series", attempts=2, sleep=lambda s: None)
    d(batch_of(spark, change(1, "insert", "a", {"id": "a"})), 0)
    from tidelog.streaming import runner

    real = runner.append_log

    def half(*args, **more):
        real(*args, **more)
        raise RuntimeError("lost after the append")

    with monkeypatch.context() as m:
        m.setattr(runner, "append_log", half)
        d(batch_of(spark, change(2, "insert", "b", {"id": "b"})), 1)
    d(batch_of(spark, change(3, "insert", "c", {"id": "c"})), 2)
    assert sorted((r["_seq"], r["_entity_id"]) for r in d.log(spark, "orders").collect()) == [(1, "a"), (2, "c")]
    assert [r["event_id"] for r in d.dead_letters(spark).collect()] == ["e2"]


def test_batch_is_cut_where_the_version_changes(spark, tmp_path):
    """Versions 1, 2, 1, 3 in one batch; name is removed in 2 and comes back, as another column, in 3."""
    text, number = Property(nullable=True), Property("integer", nullable=True)
    one = Schema("orders", "1", {"id": Property(), "name": text, "qty": text}, ("id",), ("id",))
    two = Schema("orders", "2", {"id": Property(), "qty": number, "note": text}, ("id",), ("id",))
    three = Schema("orders", "3", {"id": Property(), "qty": number, "note": text, "name": text}, ("id",), ("id",))
    d = Delivery(str(tmp_path / "out"), Catalog([one, two, three]), order=["timestamp"], buckets=4)
    first = batch_of(spark, *[change(k, "insert", f"k{k}", {"id": f"k{k}", "name": "n", "qty": "7"}, modelVersion="1") for k in range(12)])
    d(first, 0)
    assert d.mirror(spark, "orders").read().columns == ["id", "name", "qty"]
    files_before = {p for p in (tmp_path / "out/mirror/orders").rglob("*.parquet")}
    rest = [
        change(20, "update", "k0", {"id": "k0", "name": "last", "qty": "8"}, modelVersion="1"),
        change(21, "update", "k0", {"id": "k0", "qty": 9, "note": "two"}, modelVersion="2"),
        change(22, "update", "k0", {"id": "k0", "name": "late", "qty": "10"}, modelVersion="1"),  # keeps note, has no name any more
        change(23, "insert", "new", {"id": "new", "qty": 1, "note": "x"}, modelVersion="2"),
        change(24, "update", "new", {"id": "new", "qty": 2, "note": "y", "name": "third"}, modelVersion="3"),
    ]
    d(batch_of(spark, *rest), 1)
    got = rows_of(d, spark, "orders")
    assert got["k0"] == {"id": "k0", "qty": 10, "note": "two", "name": None}
    assert got["new"] == {"id": "new", "qty": 2, "note": "y", "name": "third"}
    assert got["k5"] == {"id": "k5", "qty": 7, "note": None, "name": None}  # its old name does not come back
    state = d.committed(spark)["tables"]["orders"]
    assert state["model"] == "3" and len({s for _, s in state["at"].values()}) > 1  # some buckets lie as they were written
    assert files_before & {p for p in (tmp_path / "out/mirror/orders").rglob("*.parquet")}
    d(batch_of(spark, change(30, "delete", "k1"), change(31, "update", "k2", {"id": "k2", "qty": 3}, modelVersion="9")), 2)
    got = rows_of(d, spark, "orders")
    assert "k1" not in got and got["k2"] == {"id": "k2", "qty": 3, "note": None, "name": None} and len(got) == 12


def test_another_key_or_key_type_deals_all_rows_out_anew(spark, tmp_path):
    one = Schema("orders", "1", {"id": Property(), "k": Property("integer", nullable=True)}, ("id",))
    two = Schema("orders", "2", {"id": Property("number"), "k": Property("integer", nullable=True)}, ("id",))
    three = Schema("orders", "3", two.properties, ("id", "k"))
    d = Delivery(str(tmp_path / "out"), Catalog([one, two, three]), order=["timestamp"], buckets=4)
    d(batch_of(spark, *[change(k, "insert", str(k), {"id": str(k), "k": k}, modelVersion="1") for k in range(8)]), 0)
    d(batch_of(spark, change(10, "update", "3.0", {"id": 3.0, "k": 33}, modelVersion="2")), 1)
    assert rows_of(d, spark, "orders")[3.0]["k"] == 33 and len(rows_of(d, spark, "orders")) == 8
    d(batch_of(spark, change(20, "insert", "3.0", {"id": 3.0, "k": 34}, modelVersion="3")), 2)
    assert sorted((r["id"], r["k"]) for r in d.mirror(spark, "orders").read().where("id = 3").collect()) == [(3.0, 33), (3.0, 34)]


def test_segments(spark):
    import itertools
    import random

    r = random.Random(4)
    rows = [(k, r.choice(["a", "b", None]), r.choice(["x", "x", "x", None, "y"])) for k in range(-50, 3000)]
    df = spark.createDataFrame(rows, "n long, k string, v string")
    for span in (7, 1 << 14):
        got = {(x["k"], x["n"]): x["segment"] for x in segments.segmented(df, "v", "n", ("k",), span).collect()}
        for key in ("a", "b", None):
            own = [(n, v) for n, k, v in rows if k == key]
            want = [i for i, (_, run) in enumerate(itertools.groupby(v for _, v in own)) for _ in run]
            assert [got[(key, n)] for n, _ in own] == want
    assert segments.segmented(df.limit(0), "v", "n").count() == 0
    e = spark.createDataFrame([(k, "T", v) for k, v in enumerate(["9", None, "1", "3", "1", "2", "3", "4"])] + [(99, "u", "1")], "seq long, table string, modelVersion string")
    got = segments.version_segments(e, {("t", str(k)): k for k in range(1, 5)}).orderBy("seq")
    assert [r["segment"] for r in got.collect()] == [0, 0, 1, 2, 2, 2, 2, 3, 0]
    assert segments.version_segments(e, {}).where("segment = 0").count() == 9


def test_write_by_url(spark, tmp_path):
    rows = spark.createDataFrame([("insert", "e1", "orders", 5)], "operation string, id string, table string, timestamp long")
    registry.write(rows, f"file://{tmp_path}/lake")
    assert spark.read.json(f"{tmp_path}/lake/folder=orders").first()["id"] == "e1"
    for url in ("eventhub://h/x", "mysql://h/db"):
        with pytest.raises(ValueError):
            registry.write(rows, url)


def test_statements_on_an_engine():
    """The statements for PostgreSQL, run by an engine that understands them: create, merge twice, evolve, recreate."""
    import duckdb

    one = Schema("lots", "1", {"id": Property(), "n": Property("integer", nullable=True), "note": Property(nullable=True)}, ("id",), ("id",))
    two = Schema("lots", "2", {"id": Property(), "n": Property("number", nullable=True), "more": Property(nullable=True)}, ("id",), ("id",))
    db = duckdb.connect()
    for _ in range(2):
        for sql in dialects.recreate_table(one, "postgres"):
            db.execute(sql)
    db.execute("create table stage as select * from (values ('a', 1, 'x', false), ('b', 2, 'y', false)) v(id, n, note, _deleted)")
    for _ in range(2):
        for sql in dialects.merge(one, "stage", "postgres"):
            db.execute(sql)
    db.execute("create or replace table stage as select * from (values ('a', 9, null, false), ('b', null, null, true), ('c', 3, 'z', false)) v(id, n, note, _deleted)")
    for sql in dialects.merge(one, "stage", "postgres"):
        db.execute(sql)
    assert db.execute("select id, n, note from lots order by id").fetchall() == [("a", 9, None), ("c", 3, "z")]
    change = evolve.diff(one, two)
    for sql in [*dialects.add_columns(two, change["added"], "postgres"), *dialects.change_columns(two, change["changed"], "postgres"), *dialects.drop_columns("lots", change["removed"], "postgres")]:
        db.execute(sql)
    assert db.execute("select id, n, more from lots order by id").fetchall() == [("a", 9.0, None), ("c", 3.0, None)]


def test_upsert_into_a_database(spark):
    two = Schema("t", "1", {"a": Property(), "b": Property("integer"), "v": Property(nullable=True)}, ("a", "b"))
    e = [(1, "insert", ["1"], '{"a":"x","b":1,"v":"old"}'), (2, "update", ["1"], '{"a":"x","b":1,"v":"new"}'), (3, "insert", ["2"], '{"a":"x","b":2}'), (4, "delete", ["", "x", "2"], None), (5, "delete", ["", "y", "3"], None)]
    df = spark.createDataFrame([(n, op, f"e{n}", "t", k, None, p, None) for n, op, k, p in e], "seq long, operation string, id string, table string, key array<string>, before string, after string, diff array<string>")
    seen = {}
    databases.upsert(df, two, registry.parse("postgres://h/db"), run=lambda s, t, sql: seen.update(sql=sql, url=t.options["url"]), stage=lambda rows, name: seen.update(rows=rows.collect(), name=name))
    assert sorted((r["a"], r["b"], r["v"], r["_deleted"]) for r in seen["rows"]) == [("x", 1, "new", False), ("x", 2, None, True), ("y", 3, None, True)]
    assert seen["name"] == "t__staging" and seen["url"] == "jdbc:postgresql://h:5432/db"
    assert 'ON CONFLICT ("a", "b")' in seen["sql"][1] and '"t__staging"."a" = "t"."a" AND "t__staging"."b" = "t"."b"' in seen["sql"][0]


def test_transient_errors():
    wrapped = RuntimeError("flush failed")
    wrapped.__cause__ = OSError("Connection reset by peer")
    assert registry.is_transient(wrapped) and registry.is_transient(TimeoutError()) and not registry.is_transient(ValueError("bad column"))
    tries, waits = [], []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise ConnectionError
        return "done"

    assert registry.retried(work, "start", waits.append) == "done" and waits == [5, 15]
    with pytest.raises(ValueError):
        registry.retried(lambda: int("x"), "start", waits.append)
    assert waits == [5, 15]


def test_last_line_of_a_file_wins(spark, tmp_path):
    name = f"{STAMP}-n1-0-orders-0.ndjson"
    (tmp_path / name).write_text("\n".join(json.dumps({"id": "a", "name": f"n{k}", "v": k}) for k in range(50)))
    e = snapshots.import_events(spark, str(tmp_path), ["orders"])
    got = snapshots.snapshot_mirror(e, empty_mirror(spark, ORDERS), ORDERS).collect()
    assert [(r["id"], r["name"]) for r in got] == [("a", "n49")]
    assert snapshots.cutoffs(spark.createDataFrame([("t", None)], "table string, file_us long"), "1700000000123456789.0").first()["cutoff_ms"] == 1700000000123


def test_sequence_numbers(spark, tmp_path):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("timestamp"), F.col("id").cast("string").alias("id"))
    got = se.numbered(df, ["timestamp", "id"], str(tmp_path / "s"), 10).orderBy("timestamp").collect()
    assert [r["seq"] for r in got] == list(range(11, 111))
