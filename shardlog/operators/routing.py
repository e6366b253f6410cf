"""Where records go: topics, and writing them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import _any


def safe_topic(name: Column) -> Column:
    """Every character but letters, digits, dot, dash and _ becomes _."""
    return F.regexp_replace(name, r"[^A-Za-z0-9._\-]", "_")


@dataclass(frozen=True)
class TopicNaming:
    """prefix.table; with an override prefix for all tables but those that match the exclusion list."""

    prefix: str
    override_prefix: str | None = None
    override_exclude: str | None = None
    schema_topic: str | None = None
    delimiter: str = "."

    def data(self, keyspace: Column, table: Column) -> Column:
        first = F.lit(self.prefix)
        if self.override_prefix and self.override_prefix.strip():
            name = F.concat_ws(".", keyspace, table)
            over = ~name.rlike(_any(self.override_exclude)) if self.override_exclude else F.lit(True)
            first = F.when(over, F.lit(self.override_prefix)).otherwise(first)
        return safe_topic(F.concat_ws(self.delimiter, first, table))

    def schema_changes(self) -> str:
        return self.schema_topic or self.prefix

    def transactions(self) -> str:
        return f"{self.prefix}{self.delimiter}transaction"

    def heartbeats(self) -> str:
        return f"__shardlog-heartbeat{self.delimiter}{self.prefix}"

    def with_keyspace(self, keyspace: Column, table: Column) -> Column:
        """The older prefix.keyspace.table."""
        return F.concat_ws(self.delimiter, F.lit(self.prefix), keyspace, table)


def route(records: DataFrame, naming: TopicNaming | Callable[[], Column]) -> DataFrame:
    return records.withColumn("topic", naming.data(F.col("keyspace"), F.col("table")) if isinstance(naming, TopicNaming) else naming())


def schema_change_records(messages: DataFrame, naming: TopicNaming, include: bool = False) -> DataFrame:
    """topic, change_type, table_id, statement of DDL messages; none unless they are asked for."""
    from ..functions import ddl

    m = messages.where((F.col("kind") == "DDL") & F.lit(include))
    table = ddl.table_of(F.col("statement"))
    return m.select("stream", "txn_no", F.lit(naming.schema_changes()).alias("topic"), ddl.change_type(F.col("statement")).alias("change_type"), ddl.quoted_id(F.col("shard"), F.col("keyspace"), table).alias("table_id"), "statement", "ts_sec", F.col("txn_id").alias("vgtid"))


def transaction_records(messages: DataFrame, ends: DataFrame, naming: TopicNaming) -> DataFrame:
    """BEGIN and END records of every transaction that has both its marks; ENDs carry the counts."""
    topic = F.lit(naming.transactions()).alias("topic")
    begin = messages.where(F.col("kind") == "BEGIN").select(topic, F.lit("BEGIN").alias("status"), F.col("txn_id").alias("id"), "stream", "txn_no", F.lit(None).cast("bigint").alias("event_count"), "ts_sec")
    n = ends.select(F.col("stream").alias("_s"), F.col("txn_no").alias("_t"), "event_count")
    c = messages.where(F.col("kind") == "COMMIT")
    end = c.join(n, (c["stream"] == n["_s"]) & (c["txn_no"] == n["_t"]), "left").select(topic, F.lit("END").alias("status"), F.col("txn_id").alias("id"), "stream", "txn_no", F.coalesce("event_count", F.lit(0)).alias("event_count"), "ts_sec")
    return begin.unionByName(end)


def heartbeat_records(messages: DataFrame, offsets: DataFrame, server: str, naming: TopicNaming, interval_ms: int) -> DataFrame:
    """topic, server, vgtid, ts_ms for every HEARTBEAT and COMMIT whose stream has a position by then; none at interval 0."""
    m = messages.where(F.col("kind").isin("HEARTBEAT", "COMMIT") & F.lit(interval_ms > 0))
    o = offsets.select(F.col("stream").alias("_s"), F.col("txn_no").alias("_t"), F.coalesce("vgtid", "restart_vgtid").alias("vgtid"))
    j = m.join(o, (m["stream"] == o["_s"]) & (m["txn_no"] == o["_t"])).where(F.coalesce("vgtid", F.lit("")) != "")
    return j.select(F.lit(naming.heartbeats()).alias("topic"), F.lit(server).alias("server"), "stream", "txn_no", "vgtid", (F.col("ts_sec") * 1000).alias("ts_ms"))


def to_json(records: DataFrame, key: str = "key", value: str = "record") -> DataFrame:
    """topic, key and value as JSON text; tombstones have no value."""
    dead = F.col("tombstone") if "tombstone" in records.columns else F.lit(False)
    return records.select("topic", F.to_json(F.struct(F.col(key).alias("key"))).alias("key"), F.when(~dead, F.to_json(F.col(value), {"ignoreNullFields": "false"})).alias("value"))


def write_topics(records: DataFrame, path: str, kind: str = "parquet") -> None:
    """One folder per topic."""
    records.write.mode("append").partitionBy("topic").format(kind).save(path)


def stream_topics(records: DataFrame, path: str, checkpoint: str, kind: str = "parquet"):
    """A running query that appends each micro-batch under its topics; the source's own options bound a batch's size."""
    return records.writeStream.outputMode("append").format(kind).partitionBy("topic").option("path", path).option("checkpointLocation", checkpoint)
