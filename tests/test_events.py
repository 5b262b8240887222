import json

import pytest
from pyspark.sql import functions as F

from tidelog.functions import events as fe
from tidelog.functions.hashing import broker_partition, xxhash32
from tidelog.model import EVENT, Property, Schema
from tidelog.sinks import brokers


def event(**more):
    base = {"operation": "insert", "id": "e1", "table": "orders", "key": ["1"], "timestamp": 0}
    return {f: (base | more).get(f) for f in EVENT.fieldNames()}


def one(spark, column, **more):
    return spark.createDataFrame([event(**more)], EVENT).select(column.alias("x")).first()["x"]


def test_column_order_and_not_null():
    s = Schema("orders", "1", {n: Property() for n in ("qty", "id", "Name", "active", "meta")}, ("id",))
    assert s.columns == ["id", "active", "meta", "Name", "qty"]
    rule = [Property("string"), Property("string", nullable=True), Property("array", nullable=True), Property("array")]
    assert [p.not_null for p in rule] == [True, False, True, True]


@pytest.mark.parametrize(
    "more, expected",
    [
        ({"companyId": "7", "locationId": "north", "key": ["a7"]}, "orders.7.north.a7"),
        ({"key": ["x"], "table": "bills"}, "bills.none.none.x"),
        ({"companyId": "", "key": ["x"]}, "orders..none.x"),
        ({"locationId": "", "companyId": "9", "key": []}, "orders.9.."),
    ],
)
def test_partition_key(spark, more, expected):
    assert one(spark, fe.partition_key(), **more) == expected


@pytest.mark.parametrize(
    "more, expected",
    [
        ({"key": [], "after": "not json"}, ""),
        ({"key": [], "after": '{"id":17}'}, ""),
        ({"key": None, "before": '{"note":null,"id":"b4"}'}, "b4"),
        ({"key": [], "after": '{"id":"ü 1"}', "before": '{"id":"other"}'}, "ü 1"),
        ({"key": ["", "k2"]}, "k2"),
        ({"key": None}, ""),
    ],
)
def test_entity_id(spark, more, expected):
    assert one(spark, fe.entity_id(), **more) == expected


def test_payload_and_omit(spark):
    assert one(spark, fe.payload(), before='{"id":"d"}') == '{"id":"d"}'
    kept = one(spark, fe.omit("after", ["a", "b"]), after='{"id":"1","a":1,"b":2,"c":{"d":[1,null]}}')
    assert json.loads(kept) == {"id": "1", "c": {"d": [1, None]}}
    assert one(spark, fe.omit("after", ["a"])) is None


def test_field_names_with_dots_and_quotes(spark):
    text = '{"a.b":"x","it\'s":"y","n":null,"o":{"k":1}}'
    assert one(spark, fe.json_field("after", "a.b"), after=text) == "x"
    assert one(spark, fe.json_field("after", "it's"), after=text) == "y"
    assert one(spark, fe.json_field("after", "n"), after=text) is None
    assert json.loads(one(spark, fe.json_field("after", "o"), after=text)) == {"k": 1}


def test_delete_key(spark):
    keys = [["", "7"], ["7"], [], ["", "7", "8"]]
    df = spark.createDataFrame([(k,) for k in keys], "key array<string>")
    assert [tuple(r) for r in df.select(fe.delete_key(0), fe.delete_key(1)).collect()] == [("7", ""), ("7", ""), ("", ""), ("7", "8")]


def test_numbers_and_identifiers(spark):
    good = ["7", "007", "-12", "8.", "-.25", "6.02e23", "9E+2", "-1.5e-07", "3e0"]
    bad = ["seven", "+7", "--7", ".", "e5", "1e", "1e1.5", "7_000", "1,5", "7\u0664", "\u00bd", "7 ", "\t7", "NaN", "-Infinity", "7;8"]
    df = spark.createDataFrame([(x,) for x in good + bad], "x string")
    assert [r[0] for r in df.select(fe.is_number("x")).collect()] == [True] * len(good) + [False] * len(bad)
    assert df.where(fe.number_or_null("x").isNotNull()).count() == len(good)
    names = spark.createDataFrame([("Lot_7",), ("_",), ("9" * 128,), ("lot 7",), ("l\u00f6t",), ("",), ("9" * 129,), ("lot;",)], "x string")
    assert [r[0] for r in names.select(fe.is_identifier("x")).collect()] == [True] * 3 + [False] * 5


def test_paths_keys_and_urls(spark):
    assert one(spark, fe.object_path("/p/q/"), timestamp=5) == "p/q/orders/5-e1.json"
    assert one(spark, fe.object_path(), timestamp=5) == "orders/5-e1.json"
    assert one(spark, fe.message_key(), companyId="c") == "dbchange.orders.insert.c.none.e1"
    urls = {"kafka://me:s3cr%40t@broker.test:9/topic/?acks=all": "kafka://broker.test:9/topic", "S3://bucket/a/b//": "S3://bucket/a/b", "file:///x@y/z#k": "file:///x@y/z", "mail me@home": "mail me@home", "1a://u:p@h": "1a://u:p@h"}
    assert [one(spark, fe.without_credentials(F.lit(u))) for u in urls] == list(urls.values())
    times = {"2019-12-31T23:59:59.5+02:00": "2019-12-31 21:59:59.500000", "2020-02-29": "2020-02-29 00:00:00.000000", "2019-02-29T00:00:00Z": "2019-02-29T00:00:00Z", "later": "later"}
    assert [one(spark, fe.utc_text(F.lit(t))) for t in times] == list(times.values())


def test_log_row_and_dead_letter(spark):
    row = spark.createDataFrame([event(mvccTimestamp="", diff=[], after="{}")], EVENT).select(*fe.log_row()).first()
    assert (row["_mvcc_ts"], row["_diff"], row["_model_ver"], row["_entity_id"]) == (None, None, "", "1")
    row = spark.createDataFrame([event(diff=["a", "b"])], EVENT).select(*fe.log_row(), *fe.dead_letter(F.lit("e" * 3000), F.lit(5))).first()
    assert row["_diff"] == '["a","b"]' and len(row["error"]) == 2000 and row["retry_count"] == 5 and row["payload"] is None


def test_hash_of_texts_of_all_lengths(spark):
    xxhash = pytest.importorskip("xxhash")
    texts = [None, "\0"] + ["".join(chr(97 + (n * k) % 26) for k in range(n)) + tail for n in range(0, 67) for tail in ("", "\u00fc", "\u65e5\u672c")]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, k string")
    rows = df.select("n", xxhash32("k").alias("h"), broker_partition("k", 7).alias("p")).orderBy("n").collect()
    want = [None if t is None else xxhash.xxh32_intdigest(t.encode()) for t in texts]
    assert [r["h"] for r in rows] == want and [r["p"] for r in rows] == [None if h is None else h % 7 for h in want]


def test_hash_and_envelopes(spark):
    df = spark.createDataFrame([("",), ("abc",), (None,)], "k string")
    assert [r[0] for r in df.select(xxhash32("k")).collect()] == [0x02CC5D05, 0x32D153FF, None]
    assert df.where("k = 'abc'").select(broker_partition("k")).first()[0] == 0x32D153FF % 64
    e = spark.createDataFrame([event(companyId="c", after='{"a":"ü"}')], EVENT)
    k = brokers.kafka_rows(e).first()
    assert k["key"] == "dbchange.orders.insert.c.none.e1" and bytes(k["headers"][0]["value"]) == b"orders.c.none.1"
    assert json.loads(k["value"])["userId"] is None and 0 <= k["partition"] < 64
    h = brokers.event_hub_rows(e).first()
    assert h["properties"] == {"table": "orders", "operation": "insert", "companyId": "c"} and h["message_id"] == "e1"
