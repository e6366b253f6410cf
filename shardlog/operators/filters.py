"""Which tables, columns and events take part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values.
SYSTEM_KEYSPACES = ("mysql", "performance_schema", "sys", "information_schema")
IGNORED_EVENTS = ("VGTID", "VERSION")
KNOWN_EVENTS = ("BEGIN", "FIELD", "ROW", "VGTID", "COMMIT", "DDL", "OTHER", "HEARTBEAT", "VERSION", "COPY_COMPLETED")


def _any(patterns: str) -> str:
    """One anchored, case-blind expression of a comma-separated list of expressions."""
    return "(?i)^(?:" + "|".join(p.strip() for p in patterns.split(",") if p.strip()) + ")$"


def table_included(keyspace: Column, table: Column, include: str | None = None, exclude: str | None = None) -> Column:
    """Full matches on keyspace.table; the shard takes no part, so all shards are filtered alike. System keyspaces never pass."""
    name = F.concat_ws(".", keyspace, table)
    ok = ~F.lower(keyspace).isin(*SYSTEM_KEYSPACES)
    if include:
        ok = ok & name.rlike(_any(include))
    if exclude:
        ok = ok & ~name.rlike(_any(exclude))
    return ok


def snapshot_included(keyspace: Column, table: Column, patterns: str | None) -> Column:
    """Tables to copy; an empty list selects none."""
    return F.concat_ws(".", keyspace, table).rlike(_any(patterns)) if patterns and patterns.strip() else F.lit(False)


def columns_kept(keyspace: str, table: str, columns: list[str], include: str | None = None, exclude: str | None = None) -> list[str]:
    """Columns whose keyspace.table.column passes the lists."""
    import re

    full = lambda c: f"{keyspace}.{table}.{c}"
    return [c for c in columns if (not include or re.match(_any(include), full(c))) and (not exclude or not re.match(_any(exclude), full(c)))]


def column_included(table: Column, name: Column, include: str | None = None, exclude: str | None = None) -> Column:
    """The same for a column of names."""
    full = F.concat_ws(".", table, name)
    ok = full.rlike(_any(include)) if include else F.lit(True)
    return ok & ~full.rlike(_any(exclude)) if exclude else ok


def filter_tables(df: DataFrame, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Rows of tables that pass, before schemas are tracked or rows decoded."""
    return df.where(table_included(F.col("keyspace"), F.col("table"), include, exclude))


def without_transaction_records(records: DataFrame) -> DataFrame:
    """Data, schema and heartbeat records; records without a key or value pass."""
    return records.where(~F.col("record_kind").eqNullSafe("transaction"))


def meaningful(events: DataFrame) -> DataFrame:
    """Events of known types, without those that only carry a position or version."""
    return events.where(F.col("type").isin(*KNOWN_EVENTS) & ~F.col("type").isin(*IGNORED_EVENTS))


def well_named(events: DataFrame, exclude_keyspace: bool = False) -> DataFrame:
    """Row and field events whose table is keyspace.table (or bare, where keyspaces are left out)."""
    n = F.size(F.split(F.col("table"), r"\."))
    ok = n <= 2 if exclude_keyspace else n == 2
    return events.where(~F.col("type").isin("ROW", "FIELD") | ok)
