"""A change log made from an orders table, by integer rules that SQL can repeat.

One transaction per order: BEGIN, VGTID, one FIELD at response 0 per shard, a ROW with the insert and, for keys divisible by 3, the
update of its status to 'U'; keys divisible by 10 get a delete in a transaction of their own, after all others. Even keys are in
shard -80, odd ones in 80-.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.decode import pack

STREAM, KEYSPACE = "s0", "commerce"
FIELDS = [("o_orderkey", "INT64", "bigint", 3), ("o_custkey", "INT64", "bigint", 0), ("o_orderstatus", "VARCHAR", "varchar(1)", 0), ("o_totalprice", "FLOAT64", "double", 0)]


def _event(kind: str, response, number, **more):
    base = {"type": F.lit(kind), "response_no": response, "event_no": F.lit(number)}
    nothing = {"ts_sec": "bigint", "keyspace": "string", "shard": "string", "table": "string", "statement": "string", "vgtid": "string", "fields": "array<struct<name:string,type:string,column_type:string,flags:int,decimals:int,column_length:int>>", "row_changes": "array<struct<before:struct<lengths:array<bigint>,values:binary>,after:struct<lengths:array<bigint>,values:binary>>>"}
    cols = {n: F.lit(None).cast(t) for n, t in nothing.items()}
    cols.update(more)
    return F.struct(*(c.alias(n) for n, c in {**base, **cols}.items()))


def order_log(orders: DataFrame) -> DataFrame:
    """Events of the log. Responses are numbered from the key, so nothing is sorted."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("ts"))
    k = F.col("o_orderkey")
    shard = F.when(k % 2 == 0, "-80").otherwise("80-")
    table = F.lit(f"{KEYSPACE}.orders")
    gtid = lambda n: F.concat(F.lit(f'[{{"keyspace":"{KEYSPACE}","shard":"'), shard, F.lit('","gtid":"MySQL56/h1:1-'), n.cast("string"), F.lit('","table_p_ks":[]}]'))
    image = lambda status: pack([k, F.col("o_custkey"), status, F.col("o_totalprice")])
    none = F.lit(None).cast("struct<lengths:array<bigint>,values:binary>")
    change = lambda a, b: F.struct(a.alias("before"), b.alias("after"))
    first, second = image(F.col("o_orderstatus")), image(F.lit("U"))
    rows = F.when(k % 3 == 0, F.array(change(none, first), change(first, second))).otherwise(F.array(change(none, first)))
    last = F.when(k % 3 == 0, second).otherwise(first)
    fields = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(c).alias("column_type"), F.lit(f).alias("flags"), F.lit(0).alias("decimals"), F.lit(0).alias("column_length")) for n, t, c, f in FIELDS))
    r, far = (k + 1).cast("bigint"), (k + 1 + 2**34).cast("bigint")
    common = {"ts_sec": F.col("ts"), "keyspace": F.lit(KEYSPACE), "shard": shard}
    events = [_event("BEGIN", r, 0, **common), _event("FIELD", r, 1, **common, table=table, fields=fields), _event("ROW", r, 2, **common, table=table, row_changes=rows), _event("VGTID", r, 3, **common, vgtid=gtid(k)), _event("COMMIT", r, 4, **common)]
    gone = [_event("BEGIN", far, 0, **common), _event("ROW", far, 1, **common, table=table, row_changes=F.array(change(last, none))), _event("VGTID", far, 2, **common, vgtid=gtid(k + 2**34)), _event("COMMIT", far, 3, **common)]
    both = F.when(k % 10 == 0, F.array(*events, *gone)).otherwise(F.array(*events))
    return o.select(F.explode(both).alias("e")).select(F.lit(STREAM).alias("stream"), "e.*", F.lit(None).cast("boolean").alias("enum_set_string"))


#: Columns of the log made from events, and of the log with one column of each kind.
EVENT_FIELDS = [("id", "INT64", "bigint", 3), ("s", "VARCHAR", "varchar(9)", 0)]
WIDE_FIELDS = [("id", "INT64", "bigint", 3), ("u", "UINT64", "bigint unsigned", 0), ("b", "BLOB", "blob", 0), ("t", "TIME", "time(3)", 0), ("d", "DATETIME", "datetime(3)", 1), ("z", "DATE", "date", 1), ("e", "ENUM", "enum('x','y','z')", 0), ("m", "SET", "set('a','b','c')", 0), ("hidden", "VARCHAR", "varchar(9)", 0)]


def _fields(columns):
    return F.array(*(F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(c).alias("column_type"), F.lit(f).alias("flags"), F.lit(0).alias("decimals"), F.lit(0).alias("column_length")) for n, t, c, f in columns))


def _insert(*cells):
    return F.array(F.struct(F.lit(None).cast("struct<lengths:array<bigint>,values:binary>").alias("before"), pack(list(cells)).alias("after")))


def unsteady_log(events: DataFrame, broken_at: int) -> DataFrame:
    """A log of four streams from an events table, by event_id modulo 5: a transaction that starts over, a lone heartbeat, a transaction
    split over three responses, a DDL statement, another heartbeat. Where event_id is broken_at there is a COMMIT without a BEGIN."""
    i = F.col("event_id").cast("bigint")
    gtid = F.concat(F.lit('[{"keyspace":"ks","shard":"0","gtid":"MySQL56/h'), F.floor(i / 50) % 3, F.lit(":1-"), i, F.lit('","table_p_ks":[]}]'))
    common = {"ts_sec": i, "keyspace": F.lit("ks"), "shard": F.lit("0")}
    e = lambda kind, response, number, **more: _event(kind, 4 * i + response, number, **common, **more)
    begin, commit = (lambda r, n: e("BEGIN", r, n)), (lambda r, n: e("COMMIT", r, n))
    field = lambda r, n: e("FIELD", r, n, table=F.lit("ks.t"), fields=_fields(EVENT_FIELDS))
    row = lambda r, n: e("ROW", r, n, table=F.lit("ks.t"), row_changes=_insert(i, F.concat(F.lit("s"), i % 7)))
    at = lambda r, n: e("VGTID", r, n, vgtid=gtid)
    again = F.array(begin(0, 0), field(0, 1), begin(1, 0), field(1, 1), row(1, 2), at(1, 3), commit(1, 4))
    split = F.array(begin(0, 0), field(0, 1), row(0, 2), at(1, 0), commit(2, 0))
    ddl = F.array(e("DDL", 0, 0, statement=F.concat(F.lit("alter table t add c"), i, F.lit(" int"))), at(0, 1))
    made = F.when(i == broken_at, F.array(commit(0, 0))).when(i % 5 == 0, again).when(i % 5 == 2, split).when(i % 5 == 3, ddl).otherwise(F.array(e("HEARTBEAT", 0, 0)))
    return events.select(F.col("event_id"), F.explode(made).alias("e")).select((F.col("event_id") % 4).cast("string").alias("stream"), "e.*", F.lit(None).cast("boolean").alias("enum_set_string"))


def wide_log(events: DataFrame, copied_to: int) -> DataFrame:
    """One transaction per event, with a row of one column of each kind. Events under copied_to are a copy, with labels in place of numbers."""
    i = F.col("event_id").cast("bigint")
    copied = i < copied_to
    cells = [
        i, (F.lit(str(2**64 - 1)).cast("decimal(20,0)") - i.cast("decimal(20,0)")).cast("decimal(20,0)"), F.concat(F.lit("b"), i), F.format_string("%02d:00:%02d", i % 800, i % 60), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.when(i % 2 == 0, "0000-00-00").otherwise("2024-02-03"), F.when(copied, F.get(F.array(F.lit("x"), F.lit("y"), F.lit("z")), i % 3)).otherwise((i % 3 + 1).cast("string")),
        F.when(copied, F.when(i % 2 == 0, "a").otherwise("a,c")).otherwise(F.when(i % 2 == 0, "1").otherwise("5")), F.lit("secret"),
    ]
    common = {"ts_sec": i, "keyspace": F.lit("ks"), "shard": F.lit("0")}
    gtid = F.concat(F.lit('[{"keyspace":"ks","shard":"0","gtid":"MySQL56/h:1-'), i, F.lit('","table_p_ks":[]}]'))
    e = lambda kind, number, **more: _event(kind, i, number, **common, **more)
    parts = [e("BEGIN", 1), e("ROW", 3, table=F.lit("ks.w"), row_changes=_insert(*cells)), e("VGTID", 4, vgtid=gtid), e("COMMIT", 5)]
    made = F.when(i == 0, F.array(e("FIELD", 2, table=F.lit("ks.w"), fields=_fields(WIDE_FIELDS)), *parts)).when(i == copied_to, F.array(e("COPY_COMPLETED", 0), *parts)).otherwise(F.array(*parts))
    return events.select("event_id", "ts").select(F.explode(made).alias("e")).select(F.lit("s0").alias("stream"), "e.*", F.lit(None).cast("boolean").alias("enum_set_string"))
