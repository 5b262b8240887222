import json
import random

import pytest
from pyspark.sql import types as T

from tidelog.model import EVENT, Property, Schema
from tidelog.operators import views
from tidelog.operators.mirror import apply_events, empty_mirror
from tidelog.functions.events import log_row

ORDERS = Schema(
    "orders",
    "1",
    {
        "id": Property(),
        "name": Property(nullable=True),
        "amount": Property("number", nullable=True),
        "qty": Property("integer", nullable=True),
        "active": Property("boolean", nullable=True),
        "createdAt": Property(format="date-time", nullable=True),
        "meta": Property("object", nullable=True),
        "tags": Property("array", nullable=True),
    },
    ("id",),
    ("id",),
)
SEQUENCED = T.StructType([*EVENT.fields, T.StructField("seq", T.LongType())])


def events(spark, *rows):
    """Rows (operation, id, payload, diff), in order of arrival."""
    out = []
    for n, (op, key, after, *diff) in enumerate(rows):
        e = dict.fromkeys(EVENT.fieldNames())
        segments = ["", key] if op.lower() == "delete" else [key]
        e |= {"operation": op, "id": f"e{n}", "table": "orders", "key": segments, "timestamp": 0, "after": None if after is None else json.dumps({"id": key} | after), "diff": diff[0] if diff else None}
        out.append([e[f] for f in EVENT.fieldNames()] + [n])
    return spark.createDataFrame(out, SEQUENCED)


def state(spark, *rows, base=None, **more):
    df = apply_events(base if base is not None else empty_mirror(spark, ORDERS), events(spark, *rows), ORDERS, **more)
    return {r["id"]: r for r in df.collect()}


def test_column_order():
    assert ORDERS.columns == ["id", "active", "amount", "createdAt", "meta", "name", "qty", "tags"]


def test_sequences(spark):
    assert state(spark, ("insert", "1", {"name": "Original"}), ("update", "1", {"name": "Updated"}))["1"]["name"] == "Updated"
    r = state(spark, ("insert", "1", {"name": "Alice", "amount": 100.0}), ("update", "1", {"name": "Bob", "amount": 999.0}, ["name"]))["1"]
    assert (r["name"], r["amount"]) == ("Bob", 100.0)
    assert state(spark, ("insert", "1", {"name": "x"}), ("delete", "1", None)) == {}
    assert state(spark, ("INSERT", "1", {"name": "First"}), ("INSERT", "1", {"name": "Second"}))["1"]["name"] == "Second"
    assert len(state(spark, *[("insert", str(k), {}) for k in range(5)])) == 5


def test_hard_cases(spark):
    assert state(spark, ("update", "1", {"name": "n", "amount": 5}, ["name"]))["1"]["amount"] == 5.0  # no row yet: all of it
    base = apply_events(empty_mirror(spark, ORDERS), events(spark, ("insert", "1", {"name": "a", "qty": 7})), ORDERS)
    assert state(spark, ("update", "1", {"name": "b"}, ["unknown"]), base=base)["1"]["name"] == "a"
    assert state(spark, ("update", "1", {"name": None}, ["name"]), base=base)["1"]["name"] is None
    again = state(spark, ("DELETE", "1", None), ("insert", "1", {"name": "back"}), base=base)["1"]
    assert (again["name"], again["qty"]) == ("back", None)
    after_delete = state(spark, ("delete", "1", None), ("update", "1", {"name": "u", "qty": 3}, ["name"]), base=base)["1"]
    assert (after_delete["name"], after_delete["qty"]) == ("u", 3)
    assert state(spark, ("update", "1", {"name": "n"}, ["name"]), base=base, diff_aware=False)["1"]["qty"] is None


def test_values_survive(spark):
    texts = ["O'Brien's Shop", "'; DROP TABLE orders; --", "こんにちは 🎉 Ünïcödé", "line1\nline2\ttabbed", None]
    got = state(spark, *[("insert", str(k), {"name": t, "amount": 123.45, "qty": 7, "active": True, "createdAt": "2024-03-15T14:30:00Z", "meta": {"a": [1]}, "tags": ["x"]}) for k, t in enumerate(texts)])
    assert [got[str(k)]["name"] for k in range(5)] == texts
    r = got["0"]
    assert (r["amount"], r["qty"], r["active"], str(r["createdAt"]), r["meta"], r["tags"]) == (123.45, 7, True, "2024-03-15 14:30:00", '{"a":[1]}', '["x"]')
    assert state(spark, ("insert", "1", {"qty": "many", "amount": "x"}))["1"]["qty"] is None


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_sequential_fold(spark, seed):
    r = random.Random(seed)
    columns = ["name", "amount", "qty"]
    rows, mirror = [], {}
    base_rows = [("insert", str(k), {"name": f"b{k}", "amount": 1.0, "qty": k}) for k in range(0, 30, 3)]
    base = apply_events(empty_mirror(spark, ORDERS), events(spark, *base_rows), ORDERS)
    mirror = {key: p for _, key, p in base_rows}
    for _ in range(600):
        key, op = str(r.randrange(30)), r.choice(["insert", "update", "UPDATE", "delete"])
        after = {c: r.choice([None, v]) for c, v in (("name", f"n{r.random():.3f}"), ("amount", r.random()), ("qty", r.randrange(9))) if r.random() < 0.8}
        diff = r.choice([None, [], ["name"], ["qty", "bogus"], ["bogus"]]) if op.lower() == "update" else None
        rows.append((op, key, None if op == "delete" else after, diff))
        if op == "delete":
            mirror.pop(key, None)
        elif diff and key in mirror:
            mirror[key] = mirror[key] | {c: after.get(c) for c in diff if c in columns}
        else:
            mirror[key] = {c: after.get(c) for c in columns}
    got = state(spark, *rows, base=base)
    assert {k: tuple(v[c] for c in columns) for k, v in got.items()} == {k: tuple(v[c] for c in columns) for k, v in mirror.items()}


def log(spark, *rows):
    e = events(spark, *rows)
    return e.select(e.seq.alias("_seq"), *log_row())


def test_time_series(spark):
    assert views.current(log(spark, ("insert", "1", {"name": "a"}))).count() == 1
    two = log(spark, ("insert", "1", {"name": "v1"}), ("update", "1", {"name": "v2"}))
    assert two.count() == 2 and [r["_seq"] for r in views.current(two).collect()] == [1]
    assert views.current(log(spark, ("insert", "1", {}), ("DELETE", "1", None))).count() == 0
    h = views.history(log(spark, ("insert", "1", {"name": "HistTest"})), ORDERS)
    assert h.first()["name"] == "HistTest" and "_diff" not in h.columns and h.columns[9:] == ORDERS.columns


def test_nulls_in_history(spark):
    e = events(spark, ("update", "1", {"name": None})).withColumn("before", __import__("pyspark").sql.functions.lit('{"name":"old"}'))
    rows = e.select(e.seq.alias("_seq"), *log_row())
    assert views.history(rows, ORDERS).first()["name"] == "old"
    assert views.history(rows, ORDERS, strict_nulls=True).first()["name"] is None


def test_unified(spark):
    mirror = spark.createDataFrame([("1", "mirror"), ("2", "mirror"), ("3", "mirror")], "ID string, name string")
    rows = log(spark, ("insert", "2", {"name": "event", "qty": 4}), ("insert", "3", {"name": "x"}), ("delete", "3", None), ("insert", "4", {"name": "new"}))
    got = {r["id"]: (r["name"], r["qty"]) for r in views.unified(rows, mirror, ORDERS).collect()}
    assert got == {"1": ("mirror", None), "2": ("event", 4), "4": ("new", None)}
    assert views.unified(rows, mirror, Schema("empty")) is None
    names = views.register(spark, rows, ORDERS, mirror)
    assert names == ["current_orders", "orders_history", "orders_unified"]
    assert spark.sql("select count(*) from orders_unified").first()[0] == 3
