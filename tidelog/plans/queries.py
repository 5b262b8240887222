"""Queries over every operator of the engine, each with the SQL of the same rows."""

from __future__ import annotations

import dataclasses
import gzip
from collections.abc import Callable, Iterator
from itertools import batched, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import events as fe
from tidelog.functions.hashing import broker_partition, xxhash32
from tidelog.model import Property, Schema
from tidelog.operators import cooldown, evolve, filters, metrics, mirror, redelivery, segments, views
from tidelog.plans import cdc
from tidelog.scratch import scratch_folder
from tidelog.sinks import brokers
from tidelog.sources import snapshots
from tidelog.sources.events import decode
from tidelog.sources.exports import opened, read_export

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, with_cdc: bool = True):
    """Register a query under its name, with the SQL that follows the derived tables."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (cdc.SQL if with_cdc else "") + sql
        return f

    return add


def _payloads(log: DataFrame) -> DataFrame:
    """Rows of a log with the payloads' fields in place of their JSON."""
    parts = [fe.typed(fe.json_field(f"_{side}", n), cdc.ACCOUNTS.properties[n].spark_type).alias(f"{side}_{n}") for side in ("after", "before") for n in ("kind", "k", "amount")]
    return log.select(*[c for c in log.columns if c not in ("_after", "_before")], F.col("_before").isNotNull().alias("has_before"), *parts)


# views


@query("""
select seq as _seq, id as _event_id, operation as _operation, entity as _entity_id, ms as _timestamp, cast(null as varchar) as _mvcc_ts, company as _company_id,
       location as _location_id, '1' as _model_ver, case when is_diff then '["amount","unknown"]' end as _diff,
       b_amount is not null as has_before, kind as after_kind, k as after_k, amount as after_amount, b_kind as before_kind, b_k as before_k, b_amount as before_amount, rn
from (select *, row_number() over (partition by entity order by ms desc nulls last, seq desc nulls last) rn from ev)
where rn = 1 and not deletes""")
def view_current(spark, sf_dir):
    return _payloads(views.current(cdc.log(spark, sf_dir)))


@query("""
select seq as _seq, id as _event_id, operation as _operation, entity as _entity_id, ms as _timestamp, cast(null as varchar) as _mvcc_ts,
       company as _company_id, location as _location_id, '1' as _model_ver,
       case when deletes then case when b_kind is not null then entity end else entity end as id,
       coalesce(case when not deletes then kind end, b_kind) as kind, cast(coalesce(case when not deletes then k end, b_k) as varchar) as k,
       coalesce(case when not deletes then amount end, b_amount) as amount
from ev""")
def view_history(spark, sf_dir):
    return views.history(cdc.log(spark, sf_dir), cdc.ACCOUNTS).withColumn("amount", F.col("amount").cast("double"))


@query("""
, cur as (select * from (select *, row_number() over (partition by entity order by ms desc nulls last, seq desc nulls last) rn from ev) where rn = 1 and not deletes)
select entity as id, amount, k, kind from cur
union all
select id, amount, cast(null as bigint) as k, kind from base where not exists (select 1 from ev where ev.entity = base.id)""")
def view_unified(spark, sf_dir):
    return views.unified(cdc.log(spark, sf_dir), cdc.mirror(spark, sf_dir), cdc.ACCOUNTS)


# mirror

_FOLD = """
, l as (select *, max(case when deletes then seq end) over (partition by entity) ld from ev),
kept as (select l.*, row_number() over (partition by entity order by seq) rn, b.id bid
         from l left join base b on b.id = l.entity where not deletes and (ld is null or seq > ld)),
f as (select *, (not {diff}) or (rn = 1 and (bid is null or ld is not null)) full_ from kept),
net as (select entity, arg_max({{'v': amount}}, seq) n1, arg_max({{'v': kind}}, seq) filter (where full_) n2, arg_max({{'v': k}}, seq) filter (where full_) n3 from f group by entity),
alive as (select * from base b where not exists (select 1 from ev where ev.entity = b.id and deletes))
select coalesce(alive.id, net.entity) id, case when n1 is not null then n1.v else alive.amount end amount,
       case when n2 is not null then n2.v else alive.kind end kind, case when n3 is not null then n3.v end k
from alive full join net on alive.id = net.entity"""


@query(_FOLD.format(diff="is_diff"))
def mirror_diff_update(spark, sf_dir):
    return mirror.apply_events(cdc.mirror(spark, sf_dir), cdc.events(spark, sf_dir), cdc.ACCOUNTS)


@query(_FOLD.format(diff="false"))
def mirror_full_upsert(spark, sf_dir):
    return mirror.apply_events(cdc.mirror(spark, sf_dir), cdc.events(spark, sf_dir), cdc.ACCOUNTS, diff_aware=False)


@query("select id, amount, kind, cast(null as bigint) as k from base where not exists (select 1 from ev where ev.entity = base.id and deletes)")
def mirror_delete(spark, sf_dir):
    return mirror.apply_events(cdc.mirror(spark, sf_dir), cdc.events(spark, sf_dir).where(fe.is_delete()), cdc.ACCOUNTS)


@query("""
, m as (select *, case when deletes then coalesce(cast(b_k as varchar), '') else cast(k as varchar) end key2 from ev),
l as (select *, max(case when deletes then seq end) over (partition by entity, key2) ld from m where key2 is not null),
net as (select entity, key2, arg_max({'v': amount}, seq).v amount, arg_max({'v': kind}, seq).v kind from l where not deletes and (ld is null or seq > ld) group by all),
alive as (
  select id, cast(cast(id as bigint) % 10 as varchar) key2, amount, kind from base b
  where not exists (select 1 from l where deletes and l.entity = b.id and l.key2 = cast(cast(b.id as bigint) % 10 as varchar)))
select coalesce(entity, id) id, cast(coalesce(net.key2, alive.key2) as bigint) k, case when entity is null then alive.amount else net.amount end amount,
       case when entity is null then alive.kind else net.kind end kind
from alive full join net on alive.id = net.entity and alive.key2 = net.key2""")
def mirror_composite_key(spark, sf_dir):
    schema = dataclasses.replace(cdc.ACCOUNTS, primary_keys=("k", "id"))
    base = cdc.mirror(spark, sf_dir).withColumn("k", F.col("id").cast("long") % 10)
    had = F.coalesce(fe.json_field("before", "k"), F.lit(""))
    e = cdc.events(spark, sf_dir).withColumn("key", F.when(fe.is_delete(), F.array(F.lit(""), had, F.element_at("key", -1))).otherwise(F.col("key")))
    return mirror.apply_events(base, e, schema, diff_aware=False)


@query("""
, last as (select entity, arg_max(deletes, came) gone, arg_max({'v': kind}, came) filter (where not deletes) kind from (select *, -ms * 100000 + seq came from ev) group by entity)
select coalesce(base.id, last.entity) id, case when entity is null then base.kind when last.kind is null then null else last.kind.v end kind
from base full join last on base.id = last.entity where entity is null or not gone""")
def mirror_arrival_order(spark, sf_dir):
    """Events that arrive in the opposite order of their time: the last to arrive wins."""
    e = cdc.events(spark, sf_dir).withColumn("seq", -F.col("timestamp") * 100000 + F.col("seq"))
    return mirror.apply_events(cdc.mirror(spark, sf_dir), e, cdc.ACCOUNTS, diff_aware=False).select("id", "kind")


@query("""
, last as (select entity, arg_max(deletes, seq) gone, max(seq) filter (where deletes) ld from ev group by entity),
live as (select ev.* from ev join last using (entity) where not gone and not deletes and (ld is null or seq > ld)),
net as (select entity, arg_max(amount, seq) amount, arg_max({'v': kind}, seq) filter (where seq % 4 <> 0) kind, arg_min({'v': kind}, seq) first from live group by entity),
alive as (select * from base where not exists (select 1 from ev where ev.entity = base.id and deletes))
select coalesce(alive.id, net.entity) id, case when net.entity is null then alive.amount else net.amount end amount,
       case when net.kind is not null then net.kind.v when alive.id is not null then alive.kind else net.first.v end kind
from alive full join net on alive.id = net.entity""")
def mirror_older_version(spark, sf_dir):
    """A fourth of the events are of a version without the column kind, which they leave as it is."""
    older = dataclasses.replace(cdc.ACCOUNTS, version="0", properties={n: p for n, p in cdc.ACCOUNTS.properties.items() if n != "kind"})
    e = cdc.events(spark, sf_dir).withColumn("modelVersion", F.when(F.col("seq") % 4 == 0, "0").otherwise("1"))
    return mirror.apply_events(cdc.mirror(spark, sf_dir), e, cdc.ACCOUNTS, diff_aware=False, older=[older]).select("id", "amount", "kind")


# projections


@query("""
select seq as _seq, id as _event_id, operation as _operation, entity as _entity_id, ms as _timestamp, cast(null as varchar) as _mvcc_ts, company as _company_id,
       location as _location_id, '1' as _model_ver, case when is_diff then '["amount","unknown"]' end as _diff, b_kind is not null as has_before,
       case when not deletes then kind end as after_kind, case when not deletes then k end as after_k, case when not deletes then amount end as after_amount,
       b_kind as before_kind, b_k as before_k, b_amount as before_amount
from ev""")
def events_append_rows(spark, sf_dir):
    return _payloads(cdc.log(spark, sf_dir))


@query("select id, coalesce(case when not deletes then kind end, b_kind) as kind from ev")
def payload_select(spark, sf_dir):
    return cdc.events(spark, sf_dir).select("id", fe.json_field(fe.payload(), "kind").alias("kind"))


@query("select id, case when seq % 3 = 0 then coalesce(case when not deletes or b_kind is not null then entity end, '') else entity end as pk from ev")
def primary_key(spark, sf_dir):
    no_key = F.when(F.col("seq") % 3 == 0, F.array().cast("array<string>")).otherwise(F.col("key"))
    return cdc.events(spark, sf_dir).withColumn("key", no_key).select("id", fe.entity_id().alias("pk"))


@query("select id, 'accounts.' || company || '.' || coalesce(location, 'none') || '.' || entity as partition_key from ev")
def partition_key(spark, sf_dir):
    return cdc.events(spark, sf_dir).select("id", fe.partition_key().alias("partition_key"))


@query("select id, 'dbchange.accounts.' || operation || '.' || company || '.' || coalesce(location, 'none') || '.' || id as message_key from ev")
def message_key(spark, sf_dir):
    return cdc.events(spark, sf_dir).select("id", fe.message_key().alias("message_key"))


@query("select id, 'exports/daily/accounts/' || ms || '-' || id || '.json' as path from ev")
def object_path(spark, sf_dir):
    return cdc.events(spark, sf_dir).select("id", fe.object_path("exports/daily/").alias("path"))


@query("""select id, case when deletes and b_kind is null then null else entity end as row_id, cast(null as varchar) as kind,
       cast(coalesce(case when not deletes then k end, b_k) as varchar) as k from ev""")
def omit_properties(spark, sf_dir):
    rows = cdc.events(spark, sf_dir).select("id", fe.omit(fe.payload(), ["kind", "amount"]).alias("p"))
    return rows.select("id", *[fe.json_field("p", n).alias(a) for n, a in (("id", "row_id"), ("kind", "kind"), ("k", "k"))])


@query("""select id as message_id, 'accounts.' || company || '.' || coalesce(location, 'none') || '.' || entity as partition_key, 'application/json' as content_type,
       'accounts' as table_name, operation, company as company_id, case when not deletes then kind end as body_kind from ev""")
def broker_envelope(spark, sf_dir):
    rows = brokers.event_hub_rows(cdc.events(spark, sf_dir))
    inner = F.get_json_object(F.get_json_object("body", "$.after"), "$.kind")
    return rows.select("message_id", "partition_key", "content_type", F.col("properties")["table"].alias("table_name"), F.col("properties")["operation"].alias("operation"), F.col("properties")["companyId"].alias("company_id"), inner.alias("body_kind"))


@query("""select id as event_id, operation, 'accounts' as table_name, company as company_id, location as location_id, repeat('x', 1990) || substr(kind || kind || ' and so on', 1, 10) as error,
       cast(5 as bigint) as retry_count, coalesce(case when not deletes then kind end, b_kind) as payload_kind from ev""")
def dlq_rows(spark, sf_dir):
    e = cdc.events(spark, sf_dir).withColumn("kind", F.when(fe.is_delete(), "error").otherwise(fe.json_field("after", "kind")))
    rows = e.select(*fe.dead_letter(F.concat(F.lit("x" * 1990), "kind", "kind", F.lit(" and so on")), F.lit(5)))
    return rows.select("event_id", "operation", "table_name", "company_id", "location_id", F.col("error"), F.col("retry_count").cast("long").alias("retry_count"), fe.json_field("payload", "kind").alias("payload_kind"))


# xxHash32 of h (bytes as hexadecimal text): u has the words of each whole stripe and what is left.
_XXH = """
, b as (select id, k, hex(encode(k)) h, octet_length(encode(k))::hugeint n from keys),
w as (select *, list_transform(range((n // 4)::bigint), lambda i: (('0x' || h[8 * i + 7:8 * i + 8] || h[8 * i + 5:8 * i + 6] || h[8 * i + 3:8 * i + 4] || h[8 * i + 1:8 * i + 2])::bigint)::hugeint) w,
  list_transform(range((n - n % 4)::bigint, n::bigint), lambda i: (('0x' || h[2 * i + 1:2 * i + 2])::bigint)::hugeint) rest from b),
lane as (select id, k, n, w, rest, list_transform([606290984, 2246822519, 0, 1640531535], lambda start, l: list_reduce(list_prepend(start::hugeint, list_transform(range((n // 16)::bigint), lambda s: w[4 * s + l])),
  lambda acc, x: (((((acc + x * 2246822519) % 4294967296) * 8192) % 4294967296 + ((acc + x * 2246822519) % 4294967296) // 524288) * 2654435761) % 4294967296)) v from w),
s0 as (select *, (n + case when n >= 16 then ((v[1] * 2) % 4294967296 + v[1] // 2147483648 + (v[2] * 128) % 4294967296 + v[2] // 33554432 + (v[3] * 4096) % 4294967296 + v[3] // 1048576
  + (v[4] * 262144) % 4294967296 + v[4] // 16384) else 374761393 end) % 4294967296 a from lane),
s1 as (select *, list_reduce(list_prepend(a, w[(4 * (n // 16))::bigint + 1:]), lambda acc, x: (((((acc + x * 3266489917) % 4294967296) * 131072) % 4294967296 + ((acc + x * 3266489917) % 4294967296) // 32768) * 668265263) % 4294967296) c from s0),
s2 as (select *, list_reduce(list_prepend(c, rest), lambda acc, x: (((((acc + x * 374761393) % 4294967296) * 2048) % 4294967296 + ((acc + x * 374761393) % 4294967296) // 2097152) * 2654435761) % 4294967296) d from s1),
s3 as (select *, (xor(d, d // 32768) * 2246822519) % 4294967296 e from s2),
s4 as (select *, (xor(e, e // 8192) * 3266489917) % 4294967296 g from s3),
hashed as (select id, k, cast(xor(g, g // 65536) as bigint) hash from s4)
"""


@query(", keys as (select id, 'accounts.' || company || '.' || coalesce(location, 'none') || '.' || entity k from ev)" + _XXH + "select id, hash % 64 as partition from hashed")
def partition_hash(spark, sf_dir):
    """xxHash32 of partition keys, modulo 64."""
    return cdc.events(spark, sf_dir).select("id", broker_partition(fe.partition_key()).alias("partition"))


@query(", keys as (select id, case when seq % 9 = 0 then '' else repeat(kind || 'ü' || id, cast(seq % 5 as bigint)) end k from ev)" + _XXH + "select id, k as text, hash from hashed")
def hash_known_answers(spark, sf_dir):
    """xxHash32 of texts from none to some 80 bytes."""
    e = cdc.load(spark, sf_dir, "events")
    text = F.when((F.col("event_id") + 1) % 9 == 0, "").otherwise(F.repeat(F.concat("event_type", F.lit("ü"), F.col("event_id").cast("string")), ((F.col("event_id") + 1) % 5).cast("int")))
    return e.select(F.col("event_id").cast("string").alias("id"), text.alias("text")).select("id", "text", xxhash32("text").alias("hash"))


@query("select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as utc, user_id as n, event_type as text from events", False)
def typed_values(spark, sf_dir):
    e = cdc.load(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return e.select("event_id", fe.utc_text(text).alias("utc"), fe.typed(F.concat(F.col("user_id").cast("string"), F.lit(".0")), T.LongType()).alias("n"), fe.utc_text("event_type").alias("text"))


# filters and joins


@query("""
, cut as (select cast(quantile_disc(ms, 0.5) as bigint) c from ev)
select id, ms from ev, cut where ms > c""")
def import_cutoff(spark, sf_dir):
    e = cdc.events(spark, sf_dir)
    cut = e.groupBy("table").agg(F.expr("percentile_disc(0.5) within group (order by timestamp)").cast("long").alias("cutoff_ms"))
    return filters.after_import(e, cut).select("id", F.col("timestamp").alias("ms"))


@query("select event_type, count(*) as n from events where event_type in ('view', 'click') group by event_type", False)
def table_filter(spark, sf_dir):
    rows = filters.only_tables(cdc.load(spark, sf_dir, "events"), ["VIEW", "Click"], "event_type")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"))


def _files(spark, sf_dir) -> DataFrame:
    """Export file names made from orders: a table per status, at the order's date."""
    o = cdc.load(spark, sf_dir, "orders")
    stamp = F.concat(F.date_format("o_orderdate", "yyyyMMddHHmmss"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.lit("0000000000"))
    name = F.concat(stamp, F.lit("-n"), (F.col("o_orderkey") % 5).cast("string"), F.lit("-0-orders_"), F.lower("o_orderstatus"), F.lit("-"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ".ndjson.gz").otherwise(".ndjson"))
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 3, F.lit("README.txt")).otherwise(name).alias("file_name"))


_FILES = """with files as (select o_orderkey, 'orders_' || lower(o_orderstatus) as tbl, epoch_us(date_trunc('second', o_orderdate)) + (o_orderkey // 1000) as us from orders where o_orderkey % 10 <> 3) """


@query(_FILES + "select o_orderkey, tbl as \"table\", us as file_us from files", False)
def file_name_parse(spark, sf_dir):
    f = _files(spark, sf_dir)
    return f.select("o_orderkey", snapshots.file_table(F.col("file_name")).alias("table"), snapshots.file_time(F.col("file_name")).alias("file_us")).where("table is not null")


@query(_FILES + "select tbl as \"table\", max(us) // 1000 as cutoff_ms from files group by tbl", False)
def export_latest_ts(spark, sf_dir):
    return snapshots.cutoffs(file_name_parse(spark, sf_dir))


@query(_FILES + "select o_orderkey from files where o_orderkey % 4 <> 0", False)
def completed_files_anti(spark, sf_dir):
    f = _files(spark, sf_dir).where("file_name != 'README.txt'")
    done = f.where("o_orderkey % 4 = 0").select(F.upper(F.concat(F.lit("/data/"), "file_name")).alias("file_name"))
    return filters.not_completed(f, done).select("o_orderkey")


@query("select n_name as \"table\", count(c_custkey) as n_rows from (select n_nationkey, n_name from nation union all select -1, 'NOWHERE') left join customer on c_nationkey = n_nationkey group by n_name", False)
def import_counts(spark, sf_dir):
    n = cdc.load(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), F.col("n_name").alias("table"))
    n = n.union(spark.createDataFrame([(-1, "NOWHERE")], "n_nationkey int, table string"))  # a table without rows
    c = cdc.load(spark, sf_dir, "customer")
    return snapshots.import_counts(n, c.join(n, c.c_nationkey == n.n_nationkey))


@query("""select o_orderkey, regexp_full_match(o_orderpriority, '[A-Za-z0-9_]{1,128}') as ok from orders""", False)
def identifier_guard(spark, sf_dir):
    return cdc.load(spark, sf_dir, "orders").select("o_orderkey", fe.is_identifier("o_orderpriority").alias("ok"))


@query(r"""select page_id, regexp_full_match(coalesce(regexp_extract(url, '[0-9][^/?#]*$'), ''), '-?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') as ok from pages""", False)
def numeric_guard(spark, sf_dir):
    return cdc.load(spark, sf_dir, "pages").select("page_id", fe.is_number(F.regexp_extract("url", r"[0-9][^/?#]*$", 0)).alias("ok"))


@query(r"""select page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') as url from pages""", False)
def url_sanitize(spark, sf_dir):
    withheld = F.regexp_replace("url", "://", "://user:p%40ss@")
    return cdc.load(spark, sf_dir, "pages").select("page_id", fe.without_credentials(withheld).alias("url"))


def _lines(spark, sf_dir) -> DataFrame:
    """Lines of an export made from customers: a file per nation, blank and broken lines between."""
    c = cdc.load(spark, sf_dir, "customer")
    row = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("companyId")))
    value = F.explode(F.array(row, F.lit("[1]"), F.lit("{broken")))
    return c.select(value.alias("value"), F.concat(F.lit("f"), F.col("c_nationkey").cast("string")).alias("file_name"), F.lit("customers").alias("table"), (F.col("c_nationkey").cast("long") * 1_000_000).alias("file_us"))


@query("""select 'INSERT' as operation, cast(c_custkey as varchar) as entity, cast(c_nationkey as varchar) as company, c_name as name, c_nationkey * 1000 as timestamp,
       cast(c_nationkey::bigint * 1000000000 as varchar) as mvcc, '7' as version from customer""", False)
def export_lines(spark, sf_dir):
    e = snapshots.line_events(_lines(spark, sf_dir), {"Customers": "7"})
    return e.select("operation", fe.entity_id().alias("entity"), F.col("locationId").alias("company"), fe.json_field("after", "name").alias("name"), "timestamp", F.col("mvccTimestamp").alias("mvcc"), F.col("modelVersion").alias("version"))


@query("""select c_custkey, c_custkey % 2 = 0 as own_id, case when c_custkey % 2 = 0 then cast(c_custkey as varchar) else sha256('{"id":' || c_custkey || '}') end as id,
       cast(5 as bigint) as timestamp from customer""", False)
def broker_import_rows(spark, sf_dir):
    """Rows as a broker's import sends them; half of them have ids that are no strings."""
    c = cdc.load(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    row = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('{"id":"'), key, F.lit('"}'))).otherwise(F.concat(F.lit('{"id":'), key, F.lit("}")))
    e = snapshots.broker_events(c.select(row.alias("value"), F.lit("f").alias("file_name"), F.lit("customers").alias("table"), F.lit(0).cast("long").alias("file_us")), F.lit(5).cast("long"))
    return e.select(fe.json_field("after", "id").cast("long").alias("c_custkey"), (F.length("id") < 64).alias("own_id"), "id", "timestamp")


@query("select id, ms from ev where seq % 4 = 0")
def redelivered_once(spark, sf_dir):
    """New events, some of them twice, among repeats of a third of what is in the log; each new one comes out once."""
    e = cdc.events(spark, sf_dir)
    old, new = e.where("seq % 4 <> 0"), e.where("seq % 4 = 0")
    log = old.select(F.col("id").alias("_event_id"), F.col("timestamp").alias("_timestamp"))
    batch = new.unionByName(new.where("seq % 8 = 0")).unionByName(old.where("seq % 3 = 0"))
    newest = log.agg(F.max("_timestamp")).first()[0]
    return redelivery.unseen(redelivery.once_each(batch, ["timestamp"]), log, newest).select("id", F.col("timestamp").alias("ms"))


@query("select o_orderkey from orders where o_orderstatus in ('F', 'P')", False)
def files_of_known_tables(spark, sf_dir):
    """Export files of tables that a catalog knows; those of the others are passed over."""
    names = cdc.load(spark, sf_dir, "orders").select(F.concat(F.lit("ORDERS_"), "o_orderstatus").alias("name")).where("name != 'ORDERS_O'")
    status = cdc.load(spark, sf_dir, "orders").select(F.col("o_orderkey"), F.concat(F.lit("orders_"), F.lower("o_orderstatus")).alias("table"))
    return filters.known_tables(_files(spark, sf_dir).join(status, "o_orderkey"), names).select("o_orderkey")


def _export(spark, sf_dir, gz: bool = True) -> str:
    """An export of the orders in a folder that is shared: a table per status, files named by their number, some below others, gzip files
    of many members. A file has one writer, which gets its rows in order and holds a batch of them."""
    folder = scratch_folder(spark, "export")
    o = cdc.load(spark, sf_dir, "orders").select(F.concat(F.lit("orders_"), F.lower("o_orderstatus")).alias("table"), (F.col("o_orderkey") % 4).alias("part"), "o_orderkey", F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").alias("cust"))).alias("line"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(folder)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for (table, part), own in groupby(rows, itemgetter(0, 1)):
            packed, n = gz and part % 2 == 0, 0
            name = f"2024020{1 + part}000000{'0' * 19}-n1-0-{table}-{part}.ndjson" + ".gz" * packed
            path = root + (f"/more/{part}" if part > 1 else "")
            fs.create_dir(path, recursive=True)
            with fs.open_output_stream(f"{path}/{name}", compression=None, buffer_size=1 << 20) as out:  # a name with .gz is compressed otherwise
                for lines in batched(own, 50 if packed else 5000):
                    data = b"".join(line.encode() + b"\n" for _, _, line in lines)
                    out.write(gzip.compress(data, 1) if packed else data)
                    n += len(lines)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    ordered = o.repartition("table", "part").sortWithinPartitions("table", "part", "o_orderkey", "line").select("table", "part", "line")
    ordered.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return folder


@query("select 'orders_' || lower(o_orderstatus) as \"table\", o_orderkey, o_custkey as cust from orders where o_orderstatus in ('F', 'P') and o_orderkey % 4 > 0", False)
def export_rows(spark, sf_dir):
    """Rows of an export by the data source, in small splits, of two tables and all but the first day: the other files aren't opened."""
    rows = read_export(spark, _export(spark, sf_dir), 2000, ["orders_f", "orders_p"]).where(F.col("file_us") >= 1706832000000000)
    return rows.select("table", fe.json_field("value", "id").cast("long").alias("o_orderkey"), fe.json_field("value", "cust").cast("long").alias("cust"))


@query("""with f as (select distinct 'orders_' || lower(o_orderstatus) as tbl, o_orderkey % 4 as part from orders)
select tbl as "table", (1706745600 + 86400 * part) * 1000000 as file_us, '2024020' || (1 + part) || '000000' || repeat('0', 19) || '-n1-0-' || tbl || '-' || part || '.ndjson' || case when part % 2 = 0 then '.gz' else '' end as file_name,
       row_number() over (order by tbl, part) as place from f""", False)
def export_files(spark, sf_dir):
    """Files of an export, by table and time."""
    files = snapshots.ordered_files(snapshots.list_files(spark, _export(spark, sf_dir)))
    return files.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("long")).select("table", "file_us", "file_name", "place")


@query("""select count(distinct (o_orderstatus, o_orderkey % 4)) as files, cast(sum(18 + strlen(cast(o_orderkey as varchar)) + strlen(cast(o_custkey as varchar))) as bigint) as bytes from orders""", False)
def transferred_bytes(spark, sf_dir):
    """Files and bytes of an export."""
    return metrics.transferred(snapshots.list_files(spark, _export(spark, sf_dir, gz=False)))


@query("select seq, 'accounts.' || company || '.' || coalesce(location, 'none') || '.' || entity as key, row_number() over (partition by company, location, entity order by seq) as place from ev")
def key_order(spark, sf_dir):
    """Events dealt out by key, with the place among those of their key that they come in."""
    rows = metrics.in_key_order(cdc.events(spark, sf_dir), "seq", 8).withColumn("_i", F.monotonically_increasing_id())
    rows = rows.select("seq", fe.partition_key().alias("key"), "_i")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("_i")).cast("long")).drop("_i")


@query(""", r as (select seq, company, kind, case when kind is distinct from lag(kind) over (partition by company order by seq) and row_number() over (partition by company order by seq) > 1 then 1 else 0 end turn from ev)
select seq, company, cast(sum(turn) over (partition by company order by seq) as bigint) as segment from r""")
def value_segments(spark, sf_dir):
    """Runs of one kind among the events of a company, in spans of 1,000 numbers."""
    e = cdc.events(spark, sf_dir).select("seq", F.col("companyId").alias("company"), "operation", "after", "before", "diff")
    e = e.withColumn("kind", F.coalesce(fe.json_field("after", "kind"), F.lit("error")))
    return segments.segmented(e, "kind", "seq", ("company",), 1000).select("seq", "company", "segment")


@query(""", r as (select seq, case when seq % 1000 < 7 then null else 1 + (seq * 7 // 3000) % 40 end v from ev),
t as (select seq, v, coalesce(max(v) over (order by seq rows between unbounded preceding and 1 preceding), -1) top from r)
select seq, cast(count(*) filter (where v > top) over (order by seq) as bigint) as segment from t""")
def version_segments(spark, sf_dir):
    """Where a table moves on to a later version of its model, among versions that also go back, and unknown ones."""
    seq = F.col("seq")
    version = F.when(seq % 1000 < 7, "other").otherwise((1 + F.floor(seq * 7 / 3000) % 40).cast("string"))
    e = cdc.events(spark, sf_dir).withColumn("modelVersion", version)
    return segments.version_segments(e, {("accounts", str(k)): k for k in range(1, 41)}).select("seq", "segment")


@query("select seq, entity from ev where not is_diff")
def valid_rows(spark, sf_dir):
    """Rows of all events but those whose payload lacks a required column."""
    schema = dataclasses.replace(cdc.ACCOUNTS, required=("id", "kind"), properties=cdc.ACCOUNTS.properties | {"kind": Property()})
    e = cdc.events(spark, sf_dir).withColumn("after", F.when(F.size("diff") > 0, fe.omit("after", ["kind"])).otherwise(F.col("after")))
    return filters.valid_rows(e, schema).select("seq", F.element_at("key", -1).alias("entity"))


# schema evolution

def _versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two versions of a model with a column for each order: some are new, some removed, some have another type or format."""
    o, key = cdc.load(spark, sf_dir, "orders"), F.col("o_orderkey")
    old = o.where(key % 5 != 0).select(key.cast("string").alias("name"), F.col("o_orderstatus").alias("type"), F.when(key % 11 != 0, F.col("o_orderpriority")).alias("format"))
    new = o.where(key % 3 != 0).select(key.cast("string").alias("name"), F.when(key % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("type"), F.when(key % 13 != 0, F.col("o_orderpriority")).alias("format"))
    return old, new


_VERSIONS = """with o as (select cast(o_orderkey as varchar) as name, o_orderstatus as type, case when o_orderkey % 11 <> 0 then o_orderpriority end as format from orders where o_orderkey % 5 <> 0),
n as (select cast(o_orderkey as varchar) as name, case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end as type, case when o_orderkey % 13 <> 0 then o_orderpriority end as format from orders where o_orderkey % 3 <> 0) """


@query(_VERSIONS + "select name, type, format from n where name not in (select name from o)", False)
def schema_new_columns(spark, sf_dir):
    return evolve.new_columns(*_versions(spark, sf_dir))


@query(_VERSIONS + "select name, format, type from o where name not in (select name from n)", False)
def schema_removed_columns(spark, sf_dir):
    return evolve.removed_columns(*_versions(spark, sf_dir))


@query(_VERSIONS + """select n.name, o.type as old_type, n.type as new_type, o.format as old_format, n.format as new_format from n join o on n.name = o.name
where o.type is distinct from n.type or o.format is distinct from n.format""", False)
def schema_changed_columns(spark, sf_dir):
    return evolve.changed_columns(*_versions(spark, sf_dir))


@query("select distinct c_mktsegment as \"table\" from customer where c_mktsegment not in ('BUILDING') and c_acctbal < 0", False)
def orphan_tables(spark, sf_dir):
    c = cdc.load(spark, sf_dir, "customer")
    there = c.select(F.col("c_mktsegment").alias("table")).distinct()
    known = spark.sql("select 'BUILDING' as table")
    return evolve.orphans(there, known, c.where("c_acctbal < 0").select(F.col("c_mktsegment").alias("table")))


@query("select c_custkey, cast(c_acctbal as varchar) is not null as kept, cast(c_custkey as double) as qty, cast(null as varchar) as note from customer", False)
def schema_reshape(spark, sf_dir):
    c = cdc.load(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("QTY"), "c_name", F.col("c_acctbal").isNotNull().alias("kept"))
    to = Schema("t", "2", {"c_custkey": Property("integer"), "qty": Property("number"), "note": Property(nullable=True), "kept": Property("boolean")}, ("c_custkey",))
    return evolve.reshape(c, to)


# aggregates


@query("""with b(le) as (select cast(pow(2, i) as double) from range(14) t(i) union all select null)
select event_type, le, count(*) filter (where le is null or value <= le) as n, count(*) as count, round(sum(value), 2) as sum from events, b group by event_type, le""", False)
def metrics_histogram(spark, sf_dir):
    h = metrics.histogram(cdc.load(spark, sf_dir, "events"), "value", metrics.FLUSH_COUNT, ["event_type"])
    return h.select("event_type", "le", "n", "count", F.round("sum", 2).alias("sum"))


@query("select count(*) as processed, max(ms) as last_event_ms, 'accounts' as last_table, count(*) filter (where ms > 1705000000000) as pending from ev")
def status_snapshot(spark, sf_dir):
    return metrics.status(cdc.events(spark, sf_dir), 1_705_000_000_000)


@query("""select count(*) filter (where o_orderstatus = 'F') as done, count(*) as total,
       printf('%d/%d (%d%%)', count(*) filter (where o_orderstatus = 'F'), count(*), 100 * count(*) filter (where o_orderstatus = 'F') // count(*)) as line from orders""", False)
def export_progress(spark, sf_dir):
    o = cdc.load(spark, sf_dir, "orders")
    return metrics.progress(o.select(F.when(F.col("o_orderstatus") == "F", "Completed").otherwise("running").alias("status")))


@query("select id, company, (row_number() over (partition by company order by seq) - 1) // 500 as batch from ev")
def flush_batches(spark, sf_dir):
    e = cdc.events(spark, sf_dir).select("id", F.col("companyId").alias("company"), "seq")
    return metrics.flush_batches(e, 500, ["company"], "seq").select("id", "company", "batch")


@query("""with recursive a as (select distinct case when user_id % 4 = 0 then 'chat' else 'mail' end as channel, event_type as title, epoch_us(ts) // 1000000 as sec from events),
nxt as materialized (select a.*, b.sec as following from a asof join a b on b.channel = a.channel and b.title = a.title and b.sec >= a.sec + 3600),
s(channel, title, sec) as (select channel, title, min(sec) from a group by channel, title
  union all select s.channel, s.title, nxt.following from s join nxt using (channel, title, sec))
select * from s""", False)
def alert_cooldown(spark, sf_dir):
    """Alerts of all kinds of events in two channels, an hour apart."""
    a = cdc.load(spark, sf_dir, "events")
    a = a.select(F.when(F.col("user_id") % 4 == 0, "chat").otherwise("mail").alias("channel"), F.col("event_type").alias("title"), F.floor(cdc.millis("ts") / 1000).alias("sec"))
    return cooldown.alert_cooldown(a, 3600, at="sec")


@query("""select seq, entity from ev where company in ('1', '3') and location is not null""")
def tenant_filter(spark, sf_dir):
    rows = fe.for_tenants(cdc.events(spark, sf_dir), ["1", "3"], ["ACCOUNTS"], ["0", "1", "2"])
    return rows.select("seq", fe.entity_id().alias("entity"))


@query("select seq, case when deletes then entity else '' end as gone from ev")
def delete_match(spark, sf_dir):
    return cdc.events(spark, sf_dir).select("seq", F.when(fe.is_delete(), fe.delete_key(0)).otherwise("").alias("gone"))


def _messages(spark, sf_dir) -> DataFrame:
    """Every event as a message, and a broken copy of each."""
    e = cdc.events(spark, sf_dir)
    text = e.select(fe.event_json([c for c in e.columns if c != "seq"]).alias("value"))
    return text.unionByName(text.select(F.concat(F.lit("#"), "value").alias("value")))


@query("select seq, entity, operation, case when not deletes then kind end as kind, ms as timestamp from ev")
def decoded_messages(spark, sf_dir):
    good, _ = decode(_messages(spark, sf_dir))
    return good.select((F.col("id").cast("long") + 1).alias("seq"), fe.entity_id().alias("entity"), "operation", fe.json_field("after", "kind").alias("kind"), "timestamp")


@query("select count(*) as n, 'not a change event' as error, bool_and(true) as marked from ev group by all")
def refused_messages(spark, sf_dir):
    _, bad = decode(_messages(spark, sf_dir))
    return bad.groupBy("error").agg(F.count("*").alias("n"), F.bool_and(F.col("payload").startswith("#")).alias("marked"))


@query("select o_orderkey, o_orderpriority as severity from orders where lower(o_orderpriority) in ('1-urgent', '3-medium')", False)
def severity_filter(spark, sf_dir):
    """Orders as alerts whose severity is their priority."""
    alerts = cdc.load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("severity"))
    return filters.by_severity(alerts, ["1-Urgent", "3-MEDIUM"])
