"""Queries that apply the engine's operators to whole tables, and SQL with the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ddl, decode, position
from ..functions.types import ColumnType
from ..operators import envelope, filters, ordering, routing, schema_history, transactions, transforms
from ..sources import metadata, snapshot, synth
from ..sources.scratch import cut, folder
from . import planner
from .config import Config

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return keep


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- transactions

#: The order log's transactions in SQL: inserts by key, then deletes by key.
_LOG = """WITH t AS (SELECT *, row_number() OVER (ORDER BY gone, o_orderkey) AS txn_no FROM (SELECT *, 0 AS gone FROM orders UNION ALL SELECT *, 1 AS gone FROM orders WHERE o_orderkey % 10 = 0))"""


def _log(spark: SparkSession, sf: str) -> DataFrame:
    """The order log as a stored table, as logs come."""
    return cut(synth.order_log(_t(spark, sf, "orders")), "log")


def _units(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.assemble(_log(spark, sf))


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    """Row changes of the order log with typed images."""
    events = _log(spark, sf)
    changes = transactions.row_changes(transactions.assemble(events))
    met = schema_history.with_schema(changes, schema_history.versions(events))
    fields = [{"name": n, "type": t, "column_type": c, "flags": f, "column_length": 0} for n, t, c, f in synth.FIELDS]
    return met.withColumn("before", envelope.typed_row(F.col("before"), fields)).withColumn("after", envelope.typed_row(F.col("after"), fields))


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 <> 0")
def materialize_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The table that the order log leaves behind, from packed bytes to typed rows."""
    c = _typed(spark, sf)
    flat = c.select("op", "txn_no", "seq", "change_no", F.coalesce("after.o_orderkey", "before.o_orderkey").alias("o_orderkey"), "after.o_custkey", "after.o_orderstatus", "after.o_totalprice")
    return envelope.latest_state(flat, ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"])


@query(_LOG + """ SELECT txn_no, CASE WHEN gone = 0 THEN 5 ELSE 4 END AS n_events, epoch(o_orderdate)::BIGINT AS commit_ts,
'[{"keyspace":"commerce","shard":"' || CASE WHEN o_orderkey % 2 = 0 THEN '-80' ELSE '80-' END || '","gtid":"MySQL56/h1:1-' || (o_orderkey + gone * 17179869184) || '","table_p_ks":[]}]' AS vgtid FROM t""")
def txn_assemble(spark: SparkSession, sf: str) -> DataFrame:
    u = _units(spark, sf)
    return u.groupBy("txn_no").agg(F.count(F.lit(1)).cast("int").alias("n_events"), F.max("commit_ts").alias("commit_ts"), F.max("txn_vgtid").alias("vgtid"))


@query(_LOG + """ SELECT txn_no, CASE WHEN gone = 0 THEN 5 ELSE 4 END AS n_events FROM t""")
def txn_assemble_strict(spark: SparkSession, sf: str) -> DataFrame:
    """The same transactions by the protocol's state machine."""
    u = transactions.assemble_strict(_log(spark, sf))
    return u.groupBy("txn_no").agg(F.count(F.lit(1)).cast("int").alias("n_events"))


@query("""SELECT o_orderkey, 'c' AS op, NULL AS status_before, o_orderstatus AS status_after FROM orders
UNION ALL SELECT o_orderkey, 'u', o_orderstatus, 'U' FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 'd', CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END, NULL FROM orders WHERE o_orderkey % 10 = 0""")
def row_changes(spark: SparkSession, sf: str) -> DataFrame:
    c = _typed(spark, sf)
    return c.select(F.coalesce("after.o_orderkey", "before.o_orderkey").alias("o_orderkey"), envelope.op_code(F.col("op")).alias("op"), F.col("before.o_orderstatus").alias("status_before"), F.col("after.o_orderstatus").alias("status_after"))


@query(_LOG + """ SELECT CASE WHEN k = 0 THEN 'BEGIN' ELSE 'END' END AS status, txn_no, CASE WHEN k = 1 THEN CASE WHEN gone = 0 AND o_orderkey % 3 = 0 THEN 2 ELSE 1 END END::BIGINT AS event_count, 'pre.transaction' AS topic FROM t, (SELECT unnest([0, 1]) AS k)""")
def transaction_topic(spark: SparkSession, sf: str) -> DataFrame:
    u = _units(spark, sf)
    ends = transactions.transaction_ends(transactions.row_changes(u))
    return routing.transaction_records(transactions.messages(u), ends, routing.TopicNaming("pre")).select("status", "txn_no", "event_count", "topic")


@query("""SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 2 ORDER BY total_order) AS data_collection_order
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS total_order FROM lineitem)""")
def txn_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Each order's lines as one transaction over two tables."""
    l = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    c = l.select("*", F.lit("s0").alias("stream"), F.col("l_orderkey").alias("txn_no"), F.lit("ks").alias("keyspace"), (F.col("l_suppkey") % 2).cast("string").alias("table"), F.col("l_linenumber").alias("seq"), F.struct("l_partkey", "l_suppkey").alias("change_no"))
    return transactions.counters(c).select(*l.columns, "total_order", "data_collection_order")


@query("""SELECT event_id, 'g' || event_id AS vgtid, lag('g' || event_id) OVER (PARTITION BY user_id % 4 ORDER BY n) AS restart_vgtid FROM (SELECT *, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS n FROM events)""")
def offset_lag(spark: SparkSession, sf: str) -> DataFrame:
    """Rows carry the position before their transaction. Streams are users modulo 4, transactions their events in order."""
    e = _t(spark, sf, "events").select((F.col("user_id") % 4).cast("string").alias("stream"), "event_id")
    n = transactions.running_sum(e, ["stream"], ["event_id"], F.floor(F.col("event_id") / 65536), txn_no=F.lit(1))
    o = transactions.offsets(n.withColumn("txn_vgtid", F.concat(F.lit("g"), "event_id")))
    return o.select(F.substring("vgtid", 2, 20).cast("bigint").alias("event_id"), "vgtid", "restart_vgtid")


@query("""SELECT event_id, ts_sec, vgtid FROM (SELECT event_id, epoch(date_trunc('second', ts))::BIGINT * 1000 AS ts_sec, 'g' || event_id AS vgtid FROM events WHERE event_type = 'view')""")
def heartbeat_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A heartbeat for every HEARTBEAT event (views stand for them)."""
    e = _t(spark, sf, "events").select(F.lit("s0").alias("stream"), (F.col("event_id") + 1).alias("txn_no"), F.when(F.col("event_type") == "view", "HEARTBEAT").otherwise("OTHER").alias("kind"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts_sec"), "event_id")
    o = e.select("stream", "txn_no", F.concat(F.lit("g"), "event_id").alias("vgtid"), F.lit(None).cast("string").alias("restart_vgtid"))
    h = routing.heartbeat_records(e, o, "srv", routing.TopicNaming("pre"), 1000)
    return h.select((F.col("txn_no") - 1).alias("event_id"), F.col("ts_ms").alias("ts_sec"), "vgtid")


# ---- positions and order

_GTID = "'MySQL56/h' || (event_id % 3) || ':1-' || event_id || ',h' || (event_id % 5 + 3) || ':2-' || (event_id * 7)"


def _gtids(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    return _t(spark, sf, "events").select("event_id", F.concat(F.lit("MySQL56/h"), i % 3, F.lit(":1-"), i, F.lit(",h"), i % 5 + 3, F.lit(":2-"), i * 7).alias("gtid"))


@query("""SELECT event_id, 'MySQL56' AS version, 'h' || (event_id % 3) || ',h' || (event_id % 5 + 3) AS hosts, event_id || ',' || (event_id * 7) AS sequences FROM events""")
def gtid_parse(spark: SparkSession, sf: str) -> DataFrame:
    g = F.col("gtid")
    return _gtids(spark, sf).select("event_id", position.gtid_version(g).alias("version"), F.array_join(position.gtid_hosts(g), ",").alias("hosts"), F.array_join(position.gtid_sequences(g), ",").alias("sequences"))


@query("SELECT event_id, (event_id * 8)::BIGINT AS rank FROM events")
def gtid_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _gtids(spark, sf).select("event_id", position.gtid_rank(F.col("gtid")).cast("bigint").alias("rank"))


@query("""WITH p AS (SELECT event_id + 1 AS txn_no, shard, CASE WHEN event_id < 5 THEN 'current' ELSE 'MySQL56/h' || ((event_id // 10) % 3) || ':1-' || event_id || ',k:1-' || event_id END AS gtid, (event_id // 10) % 3 AS host, event_id < 5 AS cur
  FROM events, (SELECT unnest(['-80', '80-']) AS shard) WHERE shard = '-80' OR event_id % 7 <> 3),
d AS (SELECT *, lag(txn_no) OVER w = txn_no - 1 AS known, CASE WHEN lag(txn_no) OVER w = txn_no - 1 AND ((lag(cur) OVER w AND NOT cur) OR (NOT cur AND NOT lag(cur) OVER w AND host <> lag(host) OVER w)) THEN 1 ELSE 0 END AS step FROM p WINDOW w AS (PARTITION BY shard ORDER BY txn_no)),
i AS (SELECT *, sum(CASE WHEN known THEN 0 ELSE 1 END) OVER (PARTITION BY shard ORDER BY txn_no) AS island FROM d)
SELECT txn_no, shard, gtid, (sum(step) OVER (PARTITION BY shard, island ORDER BY txn_no))::BIGINT AS epoch FROM i""")
def epoch_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Epochs of two shards over all events as transactions; one shard comes and goes, hosts fail over every ten."""
    return ordering.epochs(_positions(spark, sf)).select("txn_no", "shard", "gtid", "epoch")


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    gtid = F.when(i < 5, "current").otherwise(F.concat(F.lit("MySQL56/h"), F.floor(i / 10) % 3, F.lit(":1-"), i, F.lit(",k:1-"), i))
    shards = F.when(i % 7 == 3, F.array(F.lit("-80"))).otherwise(F.array(F.lit("-80"), F.lit("80-")))
    v = position.make_vgtid(F.lit("ks"), shards, F.transform(shards, lambda _: gtid))
    return _t(spark, sf, "events").select(F.lit("s0").alias("stream"), (i + 1).alias("txn_no"), position.vgtid_json(v).alias("vgtid"))


@query(ORACLE["epoch_fold"])
def epoch_fold_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the sequential fold."""
    return ordering.epochs_in_order(_positions(spark, sf), inherit=False).select("txn_no", "shard", "gtid", "epoch")


_PARENTS = {"-40": 1, "40-80": 4, "80-": 2}


@query("""WITH s AS (SELECT n_nationkey, printf('%02x', n_nationkey * 10) AS lo, printf('%02x', n_nationkey * 10 + 10) AS hi FROM nation), p AS (SELECT * FROM (VALUES ('', '40', 1), ('40', '80', 4), ('80', NULL, 2)) AS v(plo, phi, e))
SELECT lo || '-' || hi AS shard, (max(e) + 1)::BIGINT AS epoch FROM s JOIN p ON (phi IS NULL OR lo < phi) AND plo < hi GROUP BY 1""")
def epoch_inherit(spark: SparkSession, sf: str) -> DataFrame:
    """New shards' epochs from the overlapping old ones."""
    n = F.col("n_nationkey")
    shard = F.concat(F.format_string("%02x", n * 10), F.lit("-"), F.format_string("%02x", n * 10 + 10))
    epochs = F.create_map(*(F.lit(x) for kv in _PARENTS.items() for x in kv)).cast("map<string,bigint>")
    return _t(spark, sf, "nation").select(shard.alias("shard"), position.inherited_epoch(shard, epochs).alias("epoch"))


_TWO = """'[{"keyspace":"ks","shard":"-80","gtid":"' || CASE WHEN event_id % 4 = 0 THEN '' ELSE 'g' || event_id END || '","table_p_ks":[]},{"keyspace":"ks","shard":"80-","gtid":"h' || event_id || '","table_p_ks":[' || CASE WHEN event_id % 6 = 1 THEN '{"table_name":"t","lastpk":null}' ELSE '' END || ']}]'"""


def _two(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "events").select("event_id", F.expr(_TWO).alias("vgtid"))


@query(f"""SELECT event_id, {_TWO} AS whole, '[{{"keyspace":"ks","shard":"80-","gtid":"h' || event_id || '","table_p_ks":[' || CASE WHEN event_id % 6 = 1 THEN '{{"table_name":"t","lastpk":null}}' ELSE '' END || ']}}]' AS local, 'h' || event_id AS gtid FROM events""")
def vgtid_local(spark: SparkSession, sf: str) -> DataFrame:
    v, shard = position.parse_vgtid(F.col("vgtid")), F.lit("80-")
    return _two(spark, sf).select("event_id", position.vgtid_json(v).alias("whole"), position.vgtid_json(position.local_vgtid(v, shard)).alias("local"), position.shard_gtid(v, shard).alias("gtid"))


@query("SELECT event_id, event_id % 4 = 0 OR event_id % 6 = 1 AS copying, false AS single FROM events")
def vgtid_in_copy(spark: SparkSession, sf: str) -> DataFrame:
    v = position.parse_vgtid(F.col("vgtid"))
    return _two(spark, sf).select("event_id", position.in_copy(v).alias("copying"), position.is_single_shard(v).alias("single"))


# ---- values


def _value(c, kind: str, decode_options: decode.DecodeOptions | None = None, **more):
    return decode.value(c.cast("string").cast("binary"), ColumnType(kind, **more), decode_options)


@query("SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 1 THEN 'small' WHEN 2 THEN 'medium' WHEN 3 THEN 'large' ELSE '' END AS label FROM lineitem")
def enum_decode(spark: SparkSession, sf: str) -> DataFrame:
    i = (F.col("l_linenumber") % 5).cast("string")
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", decode.enum_value(i, ("small", "medium", "large")).alias("label"))


@query("""SELECT l_orderkey, l_linenumber, array_to_string(list_transform(list_filter(range(0, 63), lambda i: (m >> i) & 1 = 1), lambda i: coalesce(['a', 'b', 'c'][i + 1], '')), ',') AS labels
FROM (SELECT *, (l_partkey % 8)::BIGINT + (l_linenumber % 3) * 8 + CASE WHEN l_linenumber = 4 THEN 1099511627776 ELSE 0 END AS m FROM lineitem)""")
def set_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Masks with bits that have no label, too."""
    n = F.col("l_linenumber")
    mask = F.col("l_partkey") % 8 + n % 3 * 8 + F.when(n == 4, F.lit(2**40)).otherwise(F.lit(0))
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", decode.set_labels(mask.cast("bigint"), ("a", "b", "c")).alias("labels"))


@query("""SELECT event_id, n AS as_string, (CASE WHEN n::DECIMAL(38,0) < 0 THEN n::DECIMAL(38,0) + 18446744073709551616 ELSE n::DECIMAL(38,0) END)::VARCHAR AS as_precise,
(CASE WHEN n::DECIMAL(38,0) > 9223372036854775807 THEN n::DECIMAL(38,0) - 18446744073709551616 ELSE n::DECIMAL(38,0) END)::BIGINT AS as_long FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN (18446744073709551615 - event_id)::VARCHAR WHEN 1 THEN (-event_id)::VARCHAR ELSE event_id::VARCHAR END AS n FROM events)""")
def uint64_modes(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    top = (F.lit(str(2**64 - 1)).cast("decimal(20,0)") - i.cast("decimal(20,0)")).cast("decimal(20,0)").cast("string")
    n = F.when(i % 3 == 0, top).when(i % 3 == 1, (-i).cast("string")).otherwise(i.cast("string"))
    e = _t(spark, sf, "events").select("event_id", n.alias("n"))
    c = F.col("n")
    return e.select("event_id", decode.uint64(c, "string").alias("as_string"), decode.uint64(c, "precise").cast("string").alias("as_precise"), decode.uint64(c, "long").alias("as_long"))


@query("SELECT event_id, event_id % 3 = 1 AS bit, CASE event_id % 3 WHEN 0 THEN '00' WHEN 1 THEN '05' ELSE '' END AS bits FROM events")
def bit_decode(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 3 == 0, F.lit(b"\x00")).when(F.col("event_id") % 3 == 1, F.lit(b"\x05")).otherwise(F.lit(b""))
    return _t(spark, sf, "events").select("event_id", decode.bit_value(raw, 1).alias("bit"), F.hex(decode.bit_value(raw, 8)).alias("bits"))


@query("""SELECT event_id, (CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END * ((event_id % 800) * 3600000000 + (event_id % 60) * 60000000 + (event_id % 59) * 1000000 + (event_id % 1000) * 1000))::BIGINT AS micros FROM events""")
def time_duration(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    s = F.concat(F.when(i % 2 == 0, "").otherwise("-"), F.format_string("%02d:%02d:%02d.%03d", i % 800, i % 60, i % 59, i % 1000))
    return _t(spark, sf, "events").select("event_id", decode.time_micros(s).alias("micros"))


_DATE = "CASE event_id % 4 WHEN 0 THEN '0000-00-00' WHEN 1 THEN '2020-00-10' WHEN 2 THEN '2021-07-00' ELSE strftime(ts, '%Y-%m-%d') END"


@query(f"""SELECT event_id, CASE WHEN event_id % 4 = 3 THEN strftime(ts, '%Y-%m-%d') END AS nullable, CASE WHEN event_id % 4 = 3 THEN strftime(ts, '%Y-%m-%d') ELSE '1970-01-01' END AS required, {_DATE} AS iso FROM events""")
def zero_date(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    d = F.when(i % 4 == 0, "0000-00-00").when(i % 4 == 1, "2020-00-10").when(i % 4 == 2, "2021-07-00").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    iso = decode.DecodeOptions(time_precision="isostring")
    return _t(spark, sf, "events").select("event_id", _value(d, "date", optional=True).cast("string").alias("nullable"), _value(d, "date", optional=False).cast("string").alias("required"), _value(d, "date", decode_options=iso).alias("iso"))


@query("""SELECT event_id, epoch_us(ts) // 1000 AS millis, epoch_us(ts) AS micros, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(((epoch_us(ts) % 1000000) // 1000)::VARCHAR, 3, '0') || 'Z' AS stamp, epoch_us(ts) // 1000 AS connect FROM events""")
def iso_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    s = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    connect = decode.DecodeOptions(time_precision="connect")
    return _t(spark, sf, "events").select("event_id", _value(s, "datetime", length=2).alias("millis"), _value(s, "datetime", length=5).alias("micros"), _value(s, "timestamp", length=3).alias("stamp"), _value(s, "timestamp", length=6, decode_options=connect).alias("connect"))


@query("SELECT doc_id, lower(hex(encode(text))) AS as_hex, base64(encode(text)) AS as_base64 FROM documents")
def binary_modes(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.col("text").cast("binary")
    return _t(spark, sf, "documents").select("doc_id", decode.binary_value(raw, "hex").alias("as_hex"), decode.binary_value(raw, "base64").alias("as_base64"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_name END AS n_name, n_regionkey FROM nation")
def row_unpack(spark: SparkSession, sf: str) -> DataFrame:
    """Rows packed into bytes and unpacked again."""
    name = F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name"))
    p = _t(spark, sf, "nation").select(decode.pack([F.col("n_nationkey"), name, F.col("n_regionkey")]).alias("row"))
    c = p.select(decode.unpack(F.col("row")).alias("c"))
    at = lambda i: F.get("c", F.lit(i))
    return c.select(decode.value(at(0), ColumnType("int32")).alias("n_nationkey"), decode.value(at(1), ColumnType("string")).alias("n_name"), decode.value(at(2), ColumnType("int32")).alias("n_regionkey"))


# ---- schemas, filters, transforms


@query("""SELECT event_id, v AS version FROM (SELECT event_id, max(CASE WHEN event_id % 50 = 0 THEN event_id END) OVER (PARTITION BY event_id % 2 ORDER BY event_id) AS v FROM events) WHERE event_id % 50 <> 0 AND v IS NOT NULL""")
def schema_asof(spark: SparkSession, sf: str) -> DataFrame:
    """Every row meets the latest schema of its shard; each fiftieth event is a new schema."""
    i = F.col("event_id")
    f = F.array(F.struct(F.concat(F.lit("v"), i).alias("name"), F.lit("INT64").alias("type"), F.lit("bigint").alias("column_type"), F.lit(0).alias("flags"), F.lit(0).alias("decimals"), F.lit(0).alias("column_length")))
    e = _t(spark, sf, "events").select(F.lit("s0").alias("stream"), i.alias("response_no"), F.lit(0).alias("event_no"), F.when(i % 50 == 0, "FIELD").otherwise("ROW").alias("type"), (i % 2).cast("string").alias("shard"), F.lit("ks.t").alias("table"), F.when(i % 50 == 0, f).alias("fields"), i.alias("event_id"))
    changes = e.where(F.col("type") == "ROW").select("stream", "shard", F.lit("ks").alias("keyspace"), F.lit("t").alias("table"), transactions.place().alias("seq"), "event_id")
    return schema_history.with_schema(changes, schema_history.versions(e)).select("event_id", F.substring(F.get("fields", F.lit(0))["name"], 2, 20).cast("bigint").alias("version"))


@query("SELECT p_partkey, p_brand FROM part WHERE regexp_full_match('ks.' || p_brand, '(?:ks\\.Brand#1|ks\\.Brand#2.*)') AND NOT regexp_full_match('ks.' || p_brand, '(?:ks\\.Brand#22)')")
def table_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Brands as table names: a full match of ks.Brand#1 takes no Brand#11."""
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", F.lit("ks").alias("keyspace"), F.col("p_brand").alias("table"))
    return filters.filter_tables(p, r"ks\.Brand#1,ks\.Brand#2.*", r"ks\.Brand#22").select("p_partkey", "p_brand")


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def column_drop(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "customer")
    return c.select(*filters.columns_kept("ks", "customer", c.columns, None, r"ks\.customer\.c_acctbal,ks\.customer\.c_mkt.*"))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    e = _t(spark, sf, "events")
    return e.select("event_id", F.struct(F.struct("user_id", "event_type").alias("after"), F.struct(F.expr(_TWO).alias("vgtid"), F.lit("80-").alias("shard")).alias("source")).alias("record"))


@query("""SELECT event_id, '{"after":{"user_id":' || user_id || '},"source":{"shard":"80-"}}' AS record FROM events""")
def remove_field(spark: SparkSession, sf: str) -> DataFrame:
    d = transforms.remove_fields("record", "after.event_type,source.vgtid,source,nothing.here")(_records(spark, sf))
    return d.select("event_id", F.to_json("record").alias("record"))


@query("""SELECT event_id, user_id, '' AS event_type, 'x' AS vgtid FROM events""")
def replace_field(spark: SparkSession, sf: str) -> DataFrame:
    d = transforms.chain([("replace_values", {"column": "record", "paths": "after.event_type,missing.path"}), ("replace_values", {"column": "record", "paths": "source.vgtid", "new": "x"})])(_records(spark, sf))
    return d.select("event_id", "record.after.user_id", "record.after.event_type", "record.source.vgtid")


@query(ORACLE["vgtid_local"].replace(f"{_TWO} AS whole, ", "").replace(", 'h' || event_id AS gtid", ""))
def local_vgtid_records(spark: SparkSession, sf: str) -> DataFrame:
    d = transforms.use_local_vgtid()(_records(spark, sf))
    return d.select("event_id", F.col("record.source.vgtid").alias("local"))


@query("""SELECT o_orderkey, p AS part, CASE WHEN p < 2 THEN 'd' ELSE 'c' END AS op, p = 1 AS tombstone, CASE WHEN p < 2 THEN o_orderkey ELSE o_orderkey + 1000000 END AS record_key FROM orders, (SELECT unnest([0, 1, 2]) AS p) WHERE o_orderkey % 4 = 0
UNION ALL SELECT o_orderkey, 0, 'u', false, o_orderkey FROM orders WHERE o_orderkey % 4 <> 0""")
def pk_change_split(spark: SparkSession, sf: str) -> DataFrame:
    """Updates; each fourth changes the key."""
    k = F.col("o_orderkey")
    c = _t(spark, sf, "orders").select("o_orderkey", F.lit("UPDATE").alias("op"))
    s = envelope.split_key_updates(c, k, F.when(k % 4 == 0, k + 1000000).otherwise(k))
    return s.select("o_orderkey", F.col("part").cast("int").alias("part"), envelope.op_code(F.col("op")).alias("op"), "tombstone", "record_key")


@query("""SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' THEN 'pre.' ELSE 'over.' END || regexp_replace(p_brand, '[^A-Za-z0-9._-]', '_', 'g') AS topic, 'pre.ks.' || p_brand AS older FROM part""")
def topic_route(spark: SparkSession, sf: str) -> DataFrame:
    naming = routing.TopicNaming("pre", "over", r"ks\.Brand#1")
    p = _t(spark, sf, "part").select("p_partkey", F.lit("ks").alias("keyspace"), F.col("p_brand").alias("table"))
    return routing.route(p, naming).select("p_partkey", "topic", naming.with_keyspace(F.col("keyspace"), F.col("table")).alias("older"))


#: Statements with what they are, by nation key modulo their number.
_STATEMENTS = [
    ("ALTER TABLE t1 ADD COLUMN bar INT", "ALTER", "t1"),
    ("create /* a\ncomment */ table `ks`.`t2` (id int)", "CREATE", "t2"),
    ("rename table t3 to t3_old", "ALTER", "t3"),
    ("DROP   TABLE t4 -- trailing", "DROP", "t4"),
    ("# note\ntruncate table t5", "TRUNCATE", "t5"),
    ("something else", "ALTER", "<UNKNOWN>"),
]


@query("SELECT c_custkey, CASE c_custkey % 6 " + " ".join(f"WHEN {i} THEN '{v}'" for i, (_, v, _) in enumerate(_STATEMENTS)) + " END AS change_type, '\"0\".\"ks\".\"' || CASE c_custkey % 6 " + " ".join(f"WHEN {i} THEN '{t}'" for i, (_, _, t) in enumerate(_STATEMENTS)) + " END || '\"' AS table_id FROM customer")
def ddl_extract(spark: SparkSession, sf: str) -> DataFrame:
    s = F.get(F.array(*(F.lit(x) for x, _, _ in _STATEMENTS)), F.col("c_custkey") % len(_STATEMENTS))
    m = _t(spark, sf, "customer").select("c_custkey", s.alias("s"))
    return m.select("c_custkey", ddl.change_type(F.col("s")).alias("change_type"), ddl.quoted_id(F.lit("0"), F.lit("ks"), ddl.table_of(F.col("s"))).alias("table_id"))


@query("""SELECT o_orderkey, '{"id":"name:srv;vgtid:g' || o_orderkey || '","op":"c","after":"' || o_orderstatus || '"}' AS event FROM orders""")
def cloud_events(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.lit("INSERT").alias("op"), F.lit("ks").alias("keyspace"), F.lit("0").alias("shard"), F.lit("orders").alias("table"), F.lit(False).alias("in_copy"), F.lit(1).cast("bigint").alias("ts_sec"), F.concat(F.lit("g"), "o_orderkey").alias("txn_vgtid"))
    image = F.struct("o_orderkey", "o_orderstatus")
    r = envelope.envelope(c, "srv", image, image)
    e = r.select("o_orderkey", envelope.cloud_event(F.col("record"), "srv").alias("e"))
    get = lambda path: F.get_json_object("e", path)
    return e.select("o_orderkey", F.to_json(F.struct(get("$.id").alias("id"), get("$.shardlogop").alias("op"), get("$.data.after.o_orderstatus").alias("after"))).alias("event"))


@query("SELECT doc_id, left(text, 10) AS text, CASE WHEN length(text) + length(lang) > 100 THEN left(lang, (length(lang) * 100) // (length(text) + length(lang))) ELSE lang END AS lang FROM documents")
def column_truncate(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed truncation of one column, and another's share of a record's limit."""
    d = _t(spark, sf, "documents")
    return d.select("doc_id", envelope.truncate(F.col("text"), 10).alias("text"), envelope.fit_record({"text": F.col("text"), "lang": F.col("lang")}, 100)["lang"].alias("lang"))


# ---- planning, copies, metadata


@query("SELECT c_name AS shard, ((row_number() OVER (ORDER BY c_name) - 1) % 4)::INTEGER AS task FROM customer")
def task_assign(spark: SparkSession, sf: str) -> DataFrame:
    return planner.assign_table(_t(spark, sf, "customer").select(F.col("c_name").alias("shard")), 4)


@query("""SELECT c_name AS shard, CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'c' || c_custkey END WHEN c_custkey % 3 = 1 THEN 'p' || c_custkey ELSE 'current' END AS gtid,
CASE c_custkey % 3 WHEN 0 THEN 'current' WHEN 1 THEN 'previous' ELSE 'config' END AS origin FROM customer""")
def offset_precedence(spark: SparkSession, sf: str) -> DataFrame:
    """This generation's value (a stored null counts), the last one's, the configuration's."""
    n = _t(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("shard"))
    k = F.col("c_custkey")
    now = n.where(k % 3 == 0).select("shard", F.when(k % 2 != 0, F.concat(F.lit("c"), k)).alias("gtid"))
    old = n.where(k % 3 < 2).select("shard", F.concat(F.lit("p"), k).alias("gtid"))
    return planner.resolve_offsets(n.select("shard"), now, old, "current")


@query("SELECT c_name AS shard FROM customer WHERE c_nationkey = 0")
def lost_shards(spark: SparkSession, sf: str) -> DataFrame:
    n = _t(spark, sf, "customer").select("c_nationkey", F.col("c_name").alias("shard"))
    return planner.lost_shards(n, n.where("c_nationkey <> 0"))


@query("SELECT 'ks' AS keyspace, c_name AS shard, 'g' || c_custkey AS gtid FROM customer")
def offset_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Each task's stored offset holds its shards; merged they hold all."""
    n = _t(spark, sf, "customer").select(F.col("c_name").alias("shard"), "c_custkey")
    tasks = planner.assign_table(n.select("shard"), 4).join(n, "shard")
    one = F.struct(F.lit("ks").alias("keyspace"), "shard", F.concat(F.lit("g"), "c_custkey").alias("gtid"), F.array().cast(position.VGTID.elementType["table_p_ks"].dataType).alias("table_p_ks"))
    stored = tasks.groupBy("task").agg(position.vgtid_json(F.collect_list(one)).alias("vgtid")).select(F.lit("srv").alias("server"), F.format_string("task%d_4_1", "task").alias("task_key"), "vgtid")
    return planner.merge_offsets(stored, "srv", 4, 1).select(F.lit("ks").alias("keyspace"), "shard", "gtid")


@query("SELECT l_orderkey, l_linenumber, 'c' AS op, 0::BIGINT AS ts_ms FROM lineitem WHERE l_orderkey > 100 OR (l_orderkey = 100 AND l_linenumber > 2)")
def copy_resume(spark: SparkSession, sf: str) -> DataFrame:
    """A copy goes on after its cursor, by lexicographic order of a composite key."""
    c = snapshot.copy_rows(_t(spark, sf, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("bigint")), "ks", "lineitem", ["l_orderkey", "l_linenumber"], [100, 2])
    return c.select("key.l_orderkey", F.col("key.l_linenumber").cast("int").alias("l_linenumber"), envelope.op_code(F.col("op")).alias("op"), F.col("ts_sec").alias("ts_ms"))


@query("SELECT DISTINCT s_nationkey::VARCHAR AS shard FROM supplier")
def dedupe_shards(spark: SparkSession, sf: str) -> DataFrame:
    s = _t(spark, sf, "supplier")
    rows = s.select(F.array(F.lit("cell"), F.lit("ks"), F.col("s_nationkey").cast("string"), F.col("s_name")).alias("cells")).union(s.select(F.array(F.lit("cell"), F.lit("ks")).alias("cells")))
    return metadata.serving_shards(rows, "ks")


@query("SELECT c_name AS shard FROM customer WHERE c_custkey % 3 = 0")
def shard_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Shards of one keyspace among the names of several, one of which begins alike."""
    k = F.col("c_custkey") % 3
    names = _t(spark, sf, "customer").select(F.concat(F.when(k == 0, "ks").when(k == 1, "ks2").otherwise("other"), F.lit("/"), "c_name").alias("name"))
    return metadata.shards(names, "ks")


@query("""SELECT DISTINCT p_brand AS "table" FROM part WHERE p_partkey % 4 = 1 AND p_partkey % 3 = 0""")
def table_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Tables of a keyspace as one shard has them."""
    k = F.col("p_partkey")
    listing = _t(spark, sf, "part").select(F.when(k % 3 == 0, "ks").otherwise("other").alias("keyspace"), (k % 4).cast("string").alias("shard"), F.col("p_brand").alias("table"))
    return metadata.tables(listing, "ks", "1")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 6 IN (4, 5)")
def system_keyspaces(spark: SparkSession, sf: str) -> DataFrame:
    """Tables of the system's own keyspaces never pass, in whatever case."""
    k = F.col("c_custkey") % 6
    keyspace = F.when(k == 0, "mysql").when(k == 1, "PERFORMANCE_SCHEMA").when(k == 2, "sys").when(k == 3, "information_schema").when(k == 4, "sys2").otherwise("ks")
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", keyspace.alias("keyspace"), F.col("c_name").alias("table"))
    return filters.filter_tables(c).select("c_custkey", "c_name")


@query("SELECT p_partkey FROM part WHERE regexp_full_match('ks.' || p_brand, 'ks\\.Brand#1.*')")
def snapshot_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Tables to copy; an empty list adds none."""
    p = _t(spark, sf, "part").withColumn("keyspace", F.lit("ks"))
    some = p.where(filters.snapshot_included(F.col("keyspace"), F.col("p_brand"), r"ks\.Brand#1.*"))
    return some.union(p.where(filters.snapshot_included(F.col("keyspace"), F.col("p_brand"), ""))).select("p_partkey")


@query("SELECT event_id, event_type FROM events WHERE event_type <> 'error'")
def drop_transaction_records(spark: SparkSession, sf: str) -> DataFrame:
    e = _t(spark, sf, "events").withColumn("record_kind", F.when(F.col("event_type") == "error", "transaction").when(F.col("event_type") == "view", F.lit(None)).otherwise("data"))
    return transforms.filter_transactions()(e).select("event_id", "event_type")


@query("SELECT event_id FROM events WHERE event_id % 3 <> 1 AND event_type <> 'click'")
def well_named_events(spark: SparkSession, sf: str) -> DataFrame:
    """Known events with keyspace.table names; clicks stand for VERSION events."""
    i = F.col("event_id")
    e = _t(spark, sf, "events").withColumn("type", F.when(F.col("event_type") == "click", "VERSION").when(i % 3 == 2, "BEGIN").otherwise("ROW")).withColumn("table", F.when(i % 3 == 0, "ks.t").when(i % 3 == 1, "t"))
    return filters.meaningful(filters.well_named(e)).select("event_id")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0")
def after_images(spark: SparkSession, sf: str) -> DataFrame:
    """New images alone; deletes have none."""
    c = _typed(spark, sf).select("op", F.struct(F.col("after").alias("after")).alias("record"))
    return envelope.after_only(c).select("o_orderkey", "o_orderstatus")


@query("""SELECT n_nationkey + 1 AS txn_no, 'changes' AS topic, 'CREATE' AS change_type, '"0"."ks"."t' || n_nationkey || '"' AS table_id, 'g' || n_nationkey AS vgtid FROM nation WHERE n_nationkey % 2 = 0""")
def schema_change_topic(spark: SparkSession, sf: str) -> DataFrame:
    """DDL events on their topic, from a log of one DDL or OTHER event per response."""
    k = F.col("n_nationkey")
    n = _t(spark, sf, "nation")
    base = n.select(F.lit("s0").alias("stream"), k.cast("bigint").alias("response_no"), F.lit(1000).cast("bigint").alias("ts_sec"), F.lit("ks").alias("keyspace"), F.lit("0").alias("shard"), k)
    ddls = base.select("*", F.lit(0).alias("event_no"), F.when(k % 2 == 0, "DDL").otherwise("OTHER").alias("type"), F.concat(F.lit("create table t"), k, F.lit(" (id int)")).alias("statement"), F.lit(None).cast("string").alias("vgtid"))
    places = base.select("*", F.lit(1).alias("event_no"), F.lit("VGTID").alias("type"), F.lit(None).cast("string").alias("statement"), F.concat(F.lit("g"), k).alias("vgtid"))
    m = transactions.messages(transactions.assemble(ddls.unionByName(places)))
    return routing.schema_change_records(m, routing.TopicNaming("pre", schema_topic="changes"), True).select("txn_no", "topic", "change_type", "table_id", "vgtid")


@query("""SELECT o_orderkey, 'pre.orders' AS topic, '{"key":{"o_orderkey":' || o_orderkey || '}}' AS key, CASE WHEN o_orderkey % 7 <> 0 THEN '{"status":"' || o_orderstatus || '","note":null}' END AS value FROM orders""")
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    """Keys and values as JSON; tombstones have no value."""
    o = _t(spark, sf, "orders").select("o_orderkey", F.lit("ks").alias("keyspace"), F.lit("orders").alias("table"), F.struct("o_orderkey").alias("key"), F.struct(F.col("o_orderstatus").alias("status"), F.lit(None).cast("string").alias("note")).alias("record"), (F.col("o_orderkey") % 7 == 0).alias("tombstone"))
    j = routing.to_json(routing.route(o, routing.TopicNaming("pre")))
    return j.select(F.get_json_object("key", "$.key.o_orderkey").cast("bigint").alias("o_orderkey"), "topic", "key", "value")


@query("SELECT o_orderkey, count(*) AS n, 1 AS columns FROM (SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0) GROUP BY 1")
def record_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys by each row's own schema (the primary key's columns)."""
    events = _log(spark, sf)
    raw = envelope.raw_images(schema_history.with_schema(transactions.row_changes(transactions.assemble(events)), schema_history.versions(events)))
    key = raw.select(F.element_at("key", F.lit("o_orderkey")).cast("string").cast("bigint").alias("o_orderkey"), F.size("key").alias("columns"))
    return key.groupBy("o_orderkey", "columns").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id FROM events WHERE event_id > 1000 OR (SELECT max(event_id) FROM events) < 1000")
def resume_after(spark: SparkSession, sf: str) -> DataFrame:
    """Units after the stored position."""
    i = F.col("event_id")
    u = _t(spark, sf, "events").select("event_id", F.lit("s0").alias("stream"), (i + 1).alias("txn_no"), F.concat(F.lit("g"), i).alias("txn_vgtid"))
    return transactions.resume(u, spark.range(1).select(F.lit("s0").alias("stream"), F.lit("g1000").alias("vgtid"))).select("event_id")


@query("""SELECT c_custkey, '{"-80":' || (c_custkey + 1) || ',"80-":1}' AS bumped FROM customer""")
def epoch_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch maps a generation later, with sorted keys."""
    m = position.parse_epoch_map(F.concat(F.lit('{"80-":0,"-80":'), F.col("c_custkey"), F.lit("}")))
    return _t(spark, sf, "customer").select("c_custkey", position.epoch_map_json(position.bump_epochs(m)).alias("bumped"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '[{"keyspace":"ks","shard":"s' || c_custkey || '","gtid":"current","table_p_ks":[]}]' ELSE '[{"keyspace":"ks","shard":"","gtid":"current","table_p_ks":[]}]' END AS vgtid FROM customer""")
def default_positions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    shards = F.when(k % 2 == 0, F.array(F.concat(F.lit("s"), k))).otherwise(F.array().cast("array<string>"))
    return _t(spark, sf, "customer").select("c_custkey", position.vgtid_json(position.make_vgtid(F.lit("ks"), shards, F.transform(shards, lambda _: F.lit("current")))).alias("vgtid"))


@query("SELECT r_regionkey::VARCHAR || '|' || r_name AS cells FROM region")
def result_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Packed result rows of a metadata query, as text."""
    r = _t(spark, sf, "region").select(decode.pack([F.col("r_regionkey"), F.lit(None).cast("string"), F.col("r_name")]).alias("row"))
    return metadata.decode_result(r).select(F.array_join("cells", "|").alias("cells"))


@query("SELECT 'task' || t || '_4_2' AS task_key FROM (SELECT unnest([1, 3]) AS t)")
def missing_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Tasks of a generation without a stored offset; regions 0 and 2 stand for tasks that have one."""
    have = _t(spark, sf, "region").where("r_regionkey in (0, 2)").select(F.lit("srv").alias("server"), F.format_string("task%d_4_2", "r_regionkey").alias("task_key"))
    return planner.missing_offsets(have, "srv", 4, 2)


@query("SELECT event_id, event_id < 500 AND (SELECT max(event_id) FROM events) >= 0 AS in_copy FROM events")
def copy_phase(spark: SparkSession, sf: str) -> DataFrame:
    """Rows before COPY_COMPLETED are copied; event 500 completes the copy. One event per transaction."""
    i = F.col("event_id")
    mark = lambda n, kind, **more: F.struct(F.lit(n).alias("event_no"), F.lit(kind).alias("type"), more.get("vgtid", F.lit(None).cast("string")).alias("vgtid"))
    done = F.when(i == 500, F.array(mark(0, "COPY_COMPLETED"))).otherwise(F.array().cast("array<struct<event_no:int,type:string,vgtid:string>>"))
    parts = F.concat(done, F.array(mark(1, "BEGIN"), mark(2, "ROW"), mark(3, "VGTID", vgtid=F.concat(F.lit("g"), i)), mark(4, "COMMIT")))
    e = _t(spark, sf, "events").select("event_id", F.lit("s0").alias("stream"), i.alias("response_no"), F.lit(True).alias("copying"), F.lit(1).cast("bigint").alias("ts_sec"), F.inline(parts))
    return transactions.assemble(e).where(F.col("type") == "ROW").select("event_id", "in_copy")


# ---- end to end, and streaming


@query("""WITH x AS (SELECT o_orderkey, o_orderkey AS seq, 1 AS total_order, 'c' AS op, false AS tombstone, NULL AS status_before, o_orderstatus AS status_after, o_orderdate FROM orders
UNION ALL SELECT o_orderkey, o_orderkey, 2, 'u', false, o_orderstatus, 'U', o_orderdate FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, o_orderkey + 17179869184, 1, 'd', t, CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END, NULL, o_orderdate FROM orders, (SELECT unnest([false, true]) AS t) WHERE o_orderkey % 10 = 0)
SELECT 'pre.orders' AS topic, op, o_orderkey, tombstone, status_before, status_after, total_order::BIGINT AS total_order, 0::BIGINT AS epoch, seq::BIGINT AS rank, epoch(o_orderdate)::BIGINT * 1000 AS ts_ms, CASE WHEN o_orderkey % 2 = 0 THEN '-80' ELSE '80-' END AS shard,
'[{"keyspace":"commerce","shard":"' || CASE WHEN o_orderkey % 2 = 0 THEN '-80' ELSE '80-' END || '","gtid":"MySQL56/h1:1-' || seq || '","table_p_ks":[]}]' AS vgtid FROM x""")
def end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """All of it: from the log to routed, ordered records with tombstones, by value."""
    from . import pipeline

    config = Config(server="srv", keyspace=synth.KEYSPACE, topic_prefix="pre", ordered_transactions=True, snapshot_mode="never")
    d = pipeline.build(_log(spark, sf), config).data
    key = F.get("key", F.lit(0))["value"].cast("bigint")
    status = lambda image: F.element_at(F.col(f"record.{image}"), F.lit("o_orderstatus"))
    own = F.col("record.transaction")
    return d.select("topic", "record.op", key.alias("o_orderkey"), "tombstone", status("before").alias("status_before"), status("after").alias("status_after"), own["total_order"].alias("total_order"), own["transaction_epoch"].alias("epoch"), own["transaction_rank"].cast("bigint").alias("rank"), "record.source.ts_ms", "record.source.shard", "record.source.vgtid")


# ---- a log with restarts, lone heartbeats, split responses and a violation

#: Its units in SQL: i is the event, v its position, pos_now the one as of it, pos_before the one before it. Stream 3 breaks off at event 1003.
_UNSTEADY = """WITH u AS (SELECT event_id AS i, (event_id % 4)::VARCHAR AS stream, row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) AS txn_no, (event_id // 50) % 3 AS host,
CASE WHEN event_id % 5 IN (0, 2, 3) THEN '[{"keyspace":"ks","shard":"0","gtid":"MySQL56/h' || ((event_id // 50) % 3) || ':1-' || event_id || '","table_p_ks":[]}]' END AS v FROM events WHERE event_id % 4 <> 3 OR event_id < 1003),
p AS (SELECT *, last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pos_now, last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pos_before FROM u WINDOW w AS (PARTITION BY stream ORDER BY i)) """


def _unsteady(spark: SparkSession, sf: str) -> DataFrame:
    return cut(synth.unsteady_log(_t(spark, sf, "events"), 1003), "log")


_UNITS_SQL = _UNSTEADY + """SELECT stream, txn_no, [5, 1, 5, 2, 1][1 + i % 5]::INTEGER AS n_events, v AS vgtid, CASE i % 5 WHEN 0 THEN i WHEN 2 THEN i END AS commit_ts, NULL AS error FROM p
UNION ALL SELECT '3', (SELECT count(*) + 1 FROM p WHERE stream = '3'), 1, NULL, NULL, 'COMMIT before BEGIN' FROM events WHERE event_id = 1003"""


def _unit_rows(units: DataFrame) -> DataFrame:
    return units.groupBy("stream", "txn_no").agg(F.count(F.lit(1)).cast("int").alias("n_events"), F.max("txn_vgtid").alias("vgtid"), F.max("commit_ts").alias("commit_ts"), F.max(F.when(F.col("type") == "ERROR", F.col("statement"))).alias("error"))


@query(_UNITS_SQL)
def unsteady_units(spark: SparkSession, sf: str) -> DataFrame:
    return _unit_rows(transactions.assemble(_unsteady(spark, sf)))


@query(_UNITS_SQL)
def unsteady_units_strict(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the state machine."""
    return _unit_rows(transactions.assemble_strict(_unsteady(spark, sf)))


@query(_UNSTEADY + "SELECT stream, txn_no, pos_now AS vgtid, pos_before AS restart_vgtid FROM p")
def unsteady_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Positions are kept over heartbeats, which have none."""
    return transactions.offsets(transactions.assemble(_unsteady(spark, sf)))


@query(_UNSTEADY + "SELECT stream, txn_no, 'srv' AS server, pos_now AS vgtid, i * 1000 AS ts_ms FROM p WHERE i % 5 <> 3 AND pos_now IS NOT NULL")
def unsteady_heartbeats(spark: SparkSession, sf: str) -> DataFrame:
    """A record for every heartbeat and commit, heartbeats in a row too."""
    from . import pipeline

    config = Config(server="srv", keyspace="ks", topic_prefix="pre", snapshot_mode="never", heartbeat_interval_ms=1)
    return pipeline.build(_unsteady(spark, sf), config).heartbeats.select("stream", "txn_no", "server", "vgtid", "ts_ms")


@query(_UNSTEADY + """SELECT '0.1.0' AS version, 'shardlog' AS connector, 'srv' AS name, i * 1000 AS ts_ms, 'false' AS snapshot, '' AS db, NULL AS sequence, i * 1000000 AS ts_us, i * 1000000000 AS ts_ns,
'ks' AS keyspace, 't' AS "table", '0' AS shard, v AS vgtid FROM p WHERE i % 5 IN (0, 2)""")
def source_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Every field of the source block of each record."""
    from . import pipeline

    config = Config(server="srv", keyspace="ks", topic_prefix="pre", snapshot_mode="never")
    return pipeline.build(_unsteady(spark, sf), config).data.select("record.source.*")


_ORDERED_SQL = _UNSTEADY + """, o AS (SELECT *, sum(moved) OVER (PARTITION BY stream ORDER BY i) AS epoch FROM (SELECT *, CASE WHEN host <> lag(host) OVER (PARTITION BY stream ORDER BY i) THEN 1 ELSE 0 END AS moved FROM p WHERE v IS NOT NULL))
SELECT stream, txn_no, 'c' AS op, i::BIGINT AS id, 's' || (i % 7) AS s, 1::BIGINT AS total_order, epoch::BIGINT AS epoch, i::BIGINT AS rank, i * 1000 AS ts_ms, v AS id_of_txn FROM o WHERE i % 5 IN (0, 2)"""


def _ordered(spark: SparkSession, sf: str, inherit: bool) -> DataFrame:
    from . import pipeline

    config = Config(server="srv", keyspace="ks", topic_prefix="pre", snapshot_mode="never", ordered_transactions=True, inherit_epoch=inherit)
    d = pipeline.typed(pipeline.build(_unsteady(spark, sf), config), config, "ks", "t")
    own = F.col("record.transaction")
    return d.select("stream", "txn_no", "record.op", "record.after.id", "record.after.s", own["total_order"].alias("total_order"), own["transaction_epoch"].alias("epoch"), own["transaction_rank"].cast("bigint").alias("rank"), "record.source.ts_ms", own["id"].alias("id_of_txn"))


@query(_ORDERED_SQL)
def unsteady_order(spark: SparkSession, sf: str) -> DataFrame:
    """Epochs go on over heartbeats."""
    return _ordered(spark, sf, False)


@query(_ORDERED_SQL)
def unsteady_order_inheriting(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered(spark, sf, True)


# ---- how values are written, through the pipeline

_WIDE = "FROM (SELECT event_id AS i, event_id < 500 AS copied, epoch_ms(date_trunc('second', ts)) AS ms, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, ((event_id % 800) * 3600 + event_id % 60)::BIGINT AS sec FROM events)"
_WIDE_REST = "['x', 'y', 'z'][1 + i % 3] AS e, CASE WHEN i % 2 = 0 THEN 'a' ELSE 'a,c' END AS m, CASE WHEN copied THEN 0 ELSE i * 1000 END AS ts_ms, CASE WHEN copied THEN 'true' ELSE 'false' END AS snapshot"


def _wide(spark: SparkSession, sf: str, **settings) -> DataFrame:
    from . import pipeline

    config = Config(server="srv", keyspace="ks", topic_prefix="pre", column_exclude="ks\\.w\\.hidden", **settings)
    out = pipeline.build(cut(synth.wide_log(_t(spark, sf, "events"), 500), "log"), config)
    d = pipeline.typed(out, config, "ks", "w")
    return d.select(F.col("key.id").alias("i"), "record.after.*", "record.source.ts_ms", "record.source.snapshot").drop("id")


@query(f"SELECT i, (18446744073709551615 - i)::VARCHAR AS u, hex(encode('b' || i)) AS b, sec * 1000000 AS t, ms AS d, CASE WHEN i % 2 = 0 THEN '1970-01-01' ELSE '2024-02-03' END AS z, {_WIDE_REST} {_WIDE}")
def values_by_default(spark: SparkSession, sf: str) -> DataFrame:
    """Typed images with default settings; the first 500 rows are copied, with labels in their cells."""
    d = _wide(spark, sf)
    return d.withColumn("b", F.hex("b")).withColumn("z", F.col("z").cast("string"))


@query(f"SELECT i, (18446744073709551615 - i)::VARCHAR AS u, base64(encode('b' || i)) AS b, sec * 1000 AS t, ms AS d, CASE WHEN i % 2 <> 0 THEN '2024-02-03' END AS z, {_WIDE_REST} {_WIDE}")
def values_precise_base64_connect(spark: SparkSession, sf: str) -> DataFrame:
    d = _wide(spark, sf, bigint_unsigned="precise", binary_handling="base64", time_precision="connect", override_datetime_to_nullable=True)
    return d.withColumn("u", F.col("u").cast("string")).withColumn("z", F.col("z").cast("string"))


@query(f"SELECT i, (-1 - i)::BIGINT AS u, lower(hex(encode('b' || i))) AS b, printf('%02d:00:%02d', i % 800, i % 60) AS t, stamp AS d, CASE WHEN i % 2 = 0 THEN '0000-00-00' ELSE '2024-02-03' END AS z, {_WIDE_REST} {_WIDE}")
def values_long_hex_isostring(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(spark, sf, bigint_unsigned="long", binary_handling="hex", time_precision="isostring")


@query("""WITH s AS (SELECT c_custkey AS k, 's' || c_custkey AS shard, ((row_number() OVER (ORDER BY 's' || c_custkey) - 1) % 8)::INTEGER AS task FROM customer)
SELECT 'task' || task || '_8_1' AS task_key, shard, CASE WHEN task = 0 THEN 'c' || k WHEN k % 3 <> 0 THEN 'p' || k ELSE 'current' END AS gtid FROM s""")
def plan_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as shards: this generation has task 0's offset alone, the one before has two thirds of the shards; all live ones are planned."""
    live = {f"s{r.c_custkey}": r.c_custkey for r in _t(spark, sf, "customer").select("c_custkey").collect()}  # a list of shards
    write = lambda names, of: {"vgtid": planner.GTID.write({s: f"{of}{live[s]}" for s in names}, "ks")}
    store: planner.Store = {("server", planner.task_key(i, 4, 0)): write(mine, "p") for i, mine in planner.assign([s for s, k in live.items() if k % 3], 4).items()}
    store["server", planner.task_key(0, 8, 1)] = write(planner.assign(live, 8)[0], "c")
    config = Config(keyspace="ks", snapshot_mode="never", tasks=8, offset_storage_per_task=True, offset_storage_task_key_gen=1, prev_num_tasks=4).check()
    rows = [(t.key, s, g) for t in planner.plan(config, list(live), store) for s, g in t.gtids.items()]
    return spark.createDataFrame(rows, "task_key string, shard string, gtid string")


def _drain(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A stream run to its present end, as a table."""
    out, check = folder(spark, name), folder(spark, f"{name}-checkpoint")
    q = df.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


@query("""SELECT row_number() OVER (ORDER BY gone, n_nationkey) AS txn_no, CASE WHEN gone = 0 THEN 5 ELSE 4 END AS n_events FROM (SELECT n_nationkey, 0 AS gone FROM nation UNION ALL SELECT n_nationkey, 1 FROM nation WHERE n_nationkey % 10 = 0)""")
def stream_assemble(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions by the stateful operator, from a file stream of the nations' log."""
    from ..sources.replay import stream_log
    from ..streaming.processors import STATE_STORE, assemble_stream

    spark.conf.set(*STATE_STORE)
    n = _t(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("o_orderkey"), F.col("n_regionkey").cast("bigint").alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"), F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate"))
    log = folder(spark, "log")
    synth.order_log(n).coalesce(1).write.mode("overwrite").parquet(log)
    done = _drain(spark, assemble_stream(stream_log(spark, log)), "assembled")
    return done.groupBy("txn_no").agg(F.count(F.lit(1)).cast("int").alias("n_events"))


@query("""WITH p AS (SELECT n_nationkey + 1 AS txn_no, unnest(CASE WHEN n_nationkey < 10 THEN ['-80', '80-'] ELSE ['-40', '40-80', '80-'] END) AS shard, CASE WHEN n_nationkey < 10 THEN n_nationkey // 5 ELSE 2 END AS step FROM nation)
SELECT txn_no, shard, (CASE WHEN txn_no <= 10 THEN (txn_no - 1) // 5 WHEN shard = '80-' THEN (txn_no - 1) // 5 ELSE 2 + (txn_no - 1) // 5 - 2 END)::BIGINT AS epoch FROM p""")
def stream_epochs(spark: SparkSession, sf: str) -> DataFrame:
    """Epochs by the stateful operator with inheritance: a shard is split at the tenth transaction, hosts change every five."""
    from ..streaming.processors import STATE_STORE, epoch_stream

    spark.conf.set(*STATE_STORE)
    k = F.col("n_nationkey")
    shards = F.when(k < 10, F.array(F.lit("-80"), F.lit("80-"))).otherwise(F.array(F.lit("-40"), F.lit("40-80"), F.lit("80-")))
    gtid = F.concat(F.lit("MySQL56/h"), F.floor(k / 5), F.lit(":1-"), k)
    v = position.vgtid_json(position.make_vgtid(F.lit("ks"), shards, F.transform(shards, lambda _: gtid)))
    log = folder(spark, "positions")
    t = _t(spark, sf, "nation").select(F.lit("s0").alias("stream"), (k + 1).cast("bigint").alias("txn_no"), v.alias("vgtid"))
    t.coalesce(1).write.mode("overwrite").parquet(log)
    return _drain(spark, epoch_stream(spark.readStream.schema(t.schema).parquet(log), inherit=True), "epochs").select("txn_no", "shard", "epoch")
