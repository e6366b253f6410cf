"""Change records: envelopes, keys, tombstones, and what is derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import DecodeOptions, cells, unpack, value
from ..functions.types import check_names, kind_of
from .schema_history import cells_by_name, key_names

#: Operation of a change -> op of its record.
OPS = {"INSERT": "c", "UPDATE": "u", "DELETE": "d", "READ": "r"}


def op_code(op: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, code in OPS.items():
        out = F.when(op == name, code).otherwise(out)
    return out


def source_struct(server: str, connector: str = "shardlog", version: str = "0.1.0") -> Column:
    """The source block; rows that are copied have time 0."""
    copying = F.coalesce(F.col("in_copy"), F.lit(False))
    ms = F.when(copying, F.lit(0)).otherwise(F.coalesce(F.col("ts_sec"), F.lit(0)) * 1000).cast("bigint")
    return F.struct(
        F.lit(version).alias("version"), F.lit(connector).alias("connector"), F.lit(server).alias("name"), ms.alias("ts_ms"), F.when(copying, "true").otherwise("false").alias("snapshot"), F.lit("").alias("db"), F.lit(None).cast("string").alias("sequence"),
        (ms * 1000).alias("ts_us"), (ms * 1_000_000).alias("ts_ns"), F.col("keyspace").alias("keyspace"), F.col("table").alias("table"), F.col("shard").alias("shard"), F.col("txn_vgtid").alias("vgtid"),
    )


def transaction_struct(ordered: bool = False) -> Column:
    """id and orders; with ordering, the shard's epoch and rank too."""
    base = [F.col("txn_vgtid").alias("id"), F.col("total_order").alias("total_order"), F.col("data_collection_order").alias("data_collection_order")]
    more = [F.col("transaction_epoch").cast("bigint").alias("transaction_epoch"), F.col("transaction_rank").cast("decimal(38,0)").alias("transaction_rank")]
    return F.struct(*base, *(more if ordered else []))


def envelope(changes: DataFrame, server: str, before: Column, after: Column, transaction: Column | None = None, source: Callable[[str], Column] = source_struct) -> DataFrame:
    """changes with op, before (not of inserts), after (not of deletes), source and transaction as a record column.

    source: makes the source block from the server's name; another one may be given."""
    op = op_code(F.col("op"))
    parts = [F.when(F.col("op") != "INSERT", before).alias("before"), F.when(F.col("op") != "DELETE", after).alias("after"), source(server).alias("source"), op.alias("op")]
    if transaction is not None:
        parts.append(transaction.alias("transaction"))
    return changes.withColumn("record", F.struct(*parts))


def raw_images(changes: DataFrame, kept: Callable[[Column], Column] | None = None) -> DataFrame:
    """before and after as maps of raw cells, key (map of the key's cells, from the image that is there) per row's own schema.

    kept: whether a column of a name is kept; all are, if it is not given."""
    some = lambda m: F.map_filter(m, lambda k, _: kept(k)) if kept else m
    d = changes.withColumn("before", some(cells_by_name(unpack(F.col("before")), F.col("fields")))).withColumn("after", some(cells_by_name(unpack(F.col("after")), F.col("fields"))))
    names = key_names(F.col("fields"))
    pick = lambda m: F.when(m.isNotNull() & (F.size(names) > 0), F.map_filter(m, lambda k, _: F.array_contains(names, k)))
    return d.withColumn("key_before", pick(F.col("before"))).withColumn("key", F.coalesce(pick(F.col("after")), pick(F.col("before"))))


def typed_cells(cell: Callable[[int, str], Column], fields: list, options: DecodeOptions | None = None, labels_as_text: bool = False) -> dict[str, Column]:
    """name -> typed value, from a function that gives the raw cell of a place and name. Unknown kinds are left out unless asked for."""
    check_names([f["name"] for f in fields])
    out = {}
    for i, f in enumerate(fields):
        kind = kind_of(f["type"], f["column_type"], f["flags"] or 0, f["column_length"], labels_as_text)
        if (v := value(cell(i, f["name"]), kind, options, f["type"])) is not None:
            out[f["name"]] = v
    return out


def _struct(values: dict[str, Column], there: Column) -> Column:
    return F.when(there, F.struct(*(v.alias(n) for n, v in values.items())))


def typed(image: Column, fields: list, options: DecodeOptions | None = None, labels_as_text: bool = False) -> Column:
    """A typed struct of a raw image (map) for one schema version, columns by name."""
    return _struct(typed_cells(lambda _, name: F.element_at(image, F.lit(name)), fields, options, labels_as_text), image.isNotNull())


def typed_row(row: Column, fields: list, options: DecodeOptions | None = None, labels_as_text: bool = False) -> Column:
    """The same straight from a packed row, columns by position: all of it compiles, and columns that nobody reads are not decoded."""
    found = cells(row, len(fields))
    return _struct(typed_cells(lambda i, _: found[i], fields, options, labels_as_text), row.isNotNull())


def split_key_updates(changes: DataFrame, key_before: Column, key_after: Column, tombstones: bool = True) -> DataFrame:
    """An update that changes the key becomes a delete of the old key, a tombstone, and a create of the new one. Adds part (0, 1, 2), tombstone."""
    moved = (F.col("op") == "UPDATE") & ~key_before.eqNullSafe(key_after)
    part = lambda op, dead: F.struct(F.lit(op).alias("op"), F.lit(dead).alias("tombstone"))
    same = F.array(F.struct(F.col("op").alias("op"), F.lit(False).alias("tombstone")))
    apart = [part("DELETE", False), *([part("DELETE", True)] if tombstones else []), part("INSERT", False)]
    gone = [part("DELETE", False), *([part("DELETE", True)] if tombstones else [])]
    parts = F.when(moved, F.array(*apart)).when(F.col("op") == "DELETE", F.array(*gone)).otherwise(same)
    x = changes.withColumn("_kb", key_before).withColumn("_ka", key_after).withColumn("_moved", moved).select("*", F.posexplode(parts).alias("part", "_p"))
    key = F.when(F.col("_p.op") == "DELETE", F.coalesce(F.col("_kb"), F.col("_ka"))).otherwise(F.col("_ka"))
    return x.withColumn("op", F.col("_p.op")).withColumn("tombstone", F.col("_p.tombstone")).withColumn("record_key", key).drop("_kb", "_ka", "_moved", "_p")


def latest_state(changes: DataFrame, keys: list[str], after: list[str]) -> DataFrame:
    """The last image of each key, deleted ones left out: one partial aggregate, no sort."""
    order = F.struct("txn_no", "seq", "change_no")
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(F.col("op").alias("_op"), *after), order).alias("x"))
    return last.where(F.col("x._op") != "DELETE").select(*keys, *(F.col(f"x.{c}").alias(c) for c in after))


def after_only(records: DataFrame) -> DataFrame:
    """The new image's columns alone; deletes are left out."""
    return records.where(F.col("record.after").isNotNull()).select("record.after.*")


def cloud_event(record: Column, server: str) -> Column:
    """JSON of a CloudEvents envelope; its id names the server and the position."""
    src = record["source"]
    return F.to_json(F.struct(F.concat(F.lit(f"name:{server};vgtid:"), src["vgtid"]).alias("id"), F.lit(f"/shardlog/{server}").alias("source"), F.lit("1.0").alias("specversion"), F.lit("shardlog.datachangeevent").alias("type"), F.timestamp_millis(src["ts_ms"]).alias("time"), F.lit("application/json").alias("datacontenttype"), record["op"].alias("shardlogop"), src["vgtid"].alias("shardlogvgtid"), src["keyspace"].alias("shardlogkeyspace"), F.struct(record["before"].alias("before"), record["after"].alias("after")).alias("data")))


def truncate(c: Column, most: int) -> Column:
    """At most so many characters of a string or bytes of a binary."""
    return F.substring(c, 1, most)


def fit_record(values: dict[str, Column], most: int) -> dict[str, Column]:
    """Text columns cut in proportion to their length where together they are over ``most`` characters; others as they are.

    Each column keeps floor(its length * most / total), so the sum is within the limit.
    """
    total = F.lit(0)
    for c in values.values():
        total = total + F.coalesce(F.length(c), F.lit(0))
    share = lambda c: F.floor(F.length(c) * F.lit(most) / total).cast("int")
    return {n: F.when(total > most, F.substring(c, F.lit(1), share(c))).otherwise(c) for n, c in values.items()}


def safe_name(name: str) -> str:
    """Field name with every character but letters, digits and _ replaced by _."""
    import re

    return re.sub(r"[^A-Za-z0-9_]", "_", name)
