"""Positions: VGTIDs (a list of shard positions as JSON), GTIDs, ranks, epochs and shard ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .types import VGTID

CURRENT = "current"


def parse_vgtid(s: Column) -> Column:
    return F.from_json(s, VGTID)


def vgtid_json(v: Column) -> Column:
    """Fields in order, nulls of a cursor kept; an absent cursor list stays absent."""
    kept = F.to_json(v, {"ignoreNullFields": "false"})
    return F.regexp_replace(kept, r',"table_p_ks":null\}', "}")


def shard_gtid(v: Column, shard: Column) -> Column:
    """The shard's GTID, null where the position has no such shard."""
    return F.get(F.filter(v, lambda x: x["shard"] == shard), F.lit(0))["gtid"]


def local_vgtid(v: Column, shard: Column) -> Column:
    return F.filter(v, lambda x: x["shard"] == shard)


def is_single_shard(v: Column) -> Column:
    return F.size(v) == 1


def in_copy(v: Column) -> Column:
    """Whether a position asks for a copy: an empty GTID, or a cursor."""
    return F.exists(v, lambda x: (x["gtid"] == "") | (F.coalesce(F.size(x["table_p_ks"]), F.lit(0)) > 0))


def make_vgtid(keyspace: Column, shards: Column, gtids: Column) -> Column:
    """Positions of shards at gtids; without shards, one entry for the keyspace at the current position."""
    empty = F.array().cast(VGTID.elementType["table_p_ks"].dataType)
    entry = lambda shard, gtid: F.struct(keyspace.alias("keyspace"), shard.alias("shard"), gtid.alias("gtid"), empty.alias("table_p_ks"))
    named = F.zip_with(shards, gtids, entry)
    return F.when(F.coalesce(F.size(shards), F.lit(0)) > 0, named).otherwise(F.array(entry(F.lit(""), F.lit(CURRENT))))


def gtid_version(g: Column) -> Column:
    return F.split_part(g, F.lit("/"), F.lit(1))


def _members(g: Column) -> Column:
    """host:ranges strings; an error where a member has no colon."""
    ok = g.rlike(r"^[^/]*/[^:,]+:[^,]*(,[^:,]+:[^,]*)*$")
    return F.when(g.isNull(), None).when(ok, F.split(F.regexp_replace(g, r"^[^/]*/", ""), ",")).otherwise(F.raise_error(F.concat(F.lit("not a GTID with hosts: "), g)).cast("array<string>"))


def gtid_hosts(g: Column) -> Column:
    return F.array_distinct(F.transform(_members(g), lambda m: F.split_part(m, F.lit(":"), F.lit(1))))


def gtid_sequences(g: Column) -> Column:
    """Last number of each host's first interval."""
    return F.transform(_members(g), lambda m: F.split_part(F.split_part(m, F.lit(":"), F.lit(2)), F.lit("-"), F.lit(-1)))


def gtid_rank(g: Column) -> Column:
    """Sum of the hosts' last sequence numbers, exact."""
    return F.aggregate(gtid_sequences(g), F.lit(0).cast("decimal(38,0)"), lambda a, s: (a + s.cast("decimal(38,0)")).cast("decimal(38,0)"))


def hosts_superset(new: Column, old: Column) -> Column:
    return F.size(F.array_except(gtid_hosts(old), gtid_hosts(new))) == 0


def is_override(g: Column) -> Column:
    return g.isin(CURRENT, "")


def epoch_step(old: Column, new: Column) -> Column:
    """0 or 1 to add to a shard's epoch when its GTID goes from old to new; a real GTID never goes back to an override."""
    o, n = is_override(old), is_override(new)
    return F.when(o & n, 0).when(o, 1).when(n, F.raise_error(F.lit("a GTID can not be followed by an override")).cast("int")).when(hosts_superset(new, old), 0).otherwise(1)


def shard_lower(s: Column) -> Column:
    """Lower bound of a key range, lower-cased; empty is the least."""
    return F.lower(F.split_part(s, F.lit("-"), F.lit(1)))


def shard_upper(s: Column) -> Column:
    """Upper bound; null where the range is open (a name without a dash, too)."""
    return F.nullif(F.lower(F.when(F.contains(s, F.lit("-")), F.split_part(s, F.lit("-"), F.lit(2))).otherwise(F.lit(""))), F.lit(""))


def valid_range(s: Column) -> Column:
    return F.when(shard_upper(s).isNull() | (shard_lower(s) < shard_upper(s)), True).otherwise(F.raise_error(F.concat(F.lit("bounds of shard out of order: "), s)).cast("boolean"))


def ranges_overlap(a: Column, b: Column) -> Column:
    """Strict overlap of two key ranges."""
    below = lambda lo, hi: hi.isNull() | (lo < hi)
    return valid_range(a) & valid_range(b) & below(shard_lower(a), shard_upper(b)) & below(shard_lower(b), shard_upper(a))


def inherited_epoch(shard: Column, epochs: Column) -> Column:
    """One more than the greatest epoch among the shards of a map that overlap; 0 where none does."""
    parents = F.filter(F.map_entries(epochs), lambda e: ranges_overlap(shard, e["key"]))
    return F.coalesce(F.array_max(F.transform(parents, lambda e: e["value"])) + 1, F.lit(0)).cast("bigint")


def epoch_map(shards: Column, start: int = 0) -> Column:
    return F.map_from_entries(F.transform(shards, lambda s: F.struct(s, F.lit(start).cast("bigint"))))


def epoch_map_json(m: Column) -> Column:
    """JSON object with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def parse_epoch_map(s: Column) -> Column:
    return F.from_json(s, "map<string,bigint>")


def bump_epochs(m: Column) -> Column:
    """After a change of generation every shard is one epoch on."""
    return F.transform_values(m, lambda _, v: v + 1)


def cursor_after(columns: list[Column], last: list) -> Column:
    """Rows after a copy cursor: lexicographic order of the key columns."""
    if len(columns) == 1:
        return columns[0] > F.lit(last[0])
    here, there = (F.struct(*(c.alias(f"k{i}") for i, c in enumerate(x))) for x in (columns, [F.lit(v).cast("bigint") if isinstance(v, int) else F.lit(v) for v in last]))
    return here > there


def cursor_cells(v: Column, shard: Column, table: Column) -> Column:
    """Text cells of a table's last copied key in a shard's position; null where there is no cursor."""
    pk = F.get(F.filter(F.get(F.filter(v, lambda x: x["shard"] == shard), F.lit(0))["table_p_ks"], lambda t: t["table_name"] == table), F.lit(0))["lastpk"]
    row = F.get(pk["rows"], F.lit(0))
    lengths = F.transform(row["lengths"], lambda n: n.cast("int"))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("cells"))
    cell = lambda acc, n: F.when(n >= 0, F.substring(F.unbase64(row["values"]), acc["at"], n).cast("string"))
    return F.aggregate(lengths, start, lambda acc, n: F.struct((acc["at"] + F.greatest(n, F.lit(0))).alias("at"), F.concat(acc["cells"], F.array(cell(acc, n))).alias("cells")), lambda acc: acc["cells"])


def start_epochs(stored: dict[str, int], stored_generation: int | None, generation: int) -> dict[str, int]:
    """Epochs that a task goes on from: one more each where the connector's generation changed since they were stored."""
    moved = stored_generation is not None and stored_generation != generation
    return {s: e + moved for s, e in stored.items()}
