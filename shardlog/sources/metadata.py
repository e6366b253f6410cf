"""What the database consists of: keyspaces, shards and tables, from metadata tables and results; and SQL text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decode import unpack


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("show databases").select(F.col("namespace").alias("keyspace"))


def shards(names: DataFrame, keyspace: str) -> DataFrame:
    """shard of the ``keyspace/shard`` names of a shard listing."""
    n = F.col(names.columns[0])
    return names.where(F.startswith(n, F.lit(f"{keyspace}/"))).select(F.split_part(n, F.lit("/"), F.lit(2)).alias("shard"))


def serving_shards(tablets: DataFrame, keyspace: str) -> DataFrame:
    """Distinct sorted shards that have a tablet. tablets: cells (array<string>) of (cell, keyspace, shard, ...); short rows are skipped."""
    cells = F.col("cells")
    return tablets.where((F.size(cells) >= 3) & (F.get(cells, F.lit(1)) == keyspace)).select(F.get(cells, F.lit(2)).alias("shard")).distinct().orderBy("shard")


def tables(listing: DataFrame, keyspace: str, shard: str | None = None) -> DataFrame:
    """Distinct table names of a keyspace; where shards may be empty, of its first (or the given) shard that serves."""
    t = listing.where(F.col("keyspace") == keyspace)
    if shard is not None:
        t = t.where(F.col("shard") == shard)
    return t.select("table").distinct().orderBy("table")


def decode_result(rows: DataFrame) -> DataFrame:
    """cells: array<string> of packed result rows."""
    return rows.select(F.transform(unpack(F.col("row")), lambda c: c.cast("string")).alias("cells"))


def run_sql(spark: SparkSession, sql: str, keyspace: str | None = None, shard: str | None = None) -> DataFrame:
    """SQL over registered tables; with a target, over the views of that keyspace and shard (``target_name``)."""
    if keyspace and shard:
        return spark.sql(sql.replace("{target}", target_name(keyspace, shard)))
    return spark.sql(sql)


def target_name(keyspace: str, shard: str) -> str:
    import re

    return re.sub(r"[^A-Za-z0-9_]", "_", f"{keyspace}_{shard}")


def quote_identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quote_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def escape_like(text: str) -> str:
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def table_rule(table: str) -> tuple[str, str]:
    """(match, filter) of a table in a stream request."""
    return table, f"select * from {quote_identifier(table)}"


def commented(sql: str, workload: str) -> str:
    """A statement with its workload named in a comment."""
    return f"/*workload:{workload.replace('*/', '')}*/ {sql}"


def nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")
