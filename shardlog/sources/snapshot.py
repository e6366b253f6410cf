"""Copy scans: base tables read as inserts at time 0, from a cursor on, before the stream's own changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.position import cursor_after
from ..operators.filters import snapshot_included


def copy_rows(table: DataFrame, keyspace: str, name: str, keys: list[str], cursor: list | None = None, patterns: str | None = ".*", shard: str = "0") -> DataFrame:
    """Rows after the cursor as changes: op INSERT (a copied row is a row without an image before), in_copy, the row as ``after``. The key comparison reaches the scan as a filter."""
    d = table.where(snapshot_included(F.lit(keyspace), F.lit(name), patterns))
    if cursor is not None:
        d = d.where(cursor_after([F.col(k) for k in keys], cursor))
    return d.select(F.lit("INSERT").alias("op"), F.lit(keyspace).alias("keyspace"), F.lit(shard).alias("shard"), F.lit(name).alias("table"), F.lit(True).alias("in_copy"), F.lit(0).cast("bigint").alias("ts_sec"), F.struct(*(F.col(k) for k in keys)).alias("key"), F.struct(*table.columns).alias("after"))


def with_stream(copied: DataFrame, streamed: DataFrame) -> DataFrame:
    """Copied rows and the stream's changes in one table; a change keeps its own op."""
    return copied.unionByName(streamed, allowMissingColumns=True)
