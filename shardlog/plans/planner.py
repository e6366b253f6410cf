"""Spreading shards over tasks, and carrying stored offsets from one generation of tasks to the next.

Shards and tasks number in the thousands at most, and so do stored offsets; the decisions are plain Python on the driver. The same
rules as DataFrame operators, for offset stores kept as tables, follow below.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .config import Config


class PlanError(RuntimeError):
    """Stored offsets and the database's shards do not fit together."""


def task_key(index: int, tasks: int, generation: int) -> str:
    return f"task{index}_{tasks}_{generation}"


def assign(shards: Iterable[str], most_tasks: int) -> dict[int, list[str]]:
    """Round-robin over sorted shards; no more tasks than shards."""
    names = sorted(shards)
    return {i: names[i::most_tasks] for i in range(min(most_tasks, len(names)))}


def same_shards(a: list[str] | None, b: list[str] | None) -> bool:
    if a is None or b is None:
        return a is b
    return len(a) == len(b) and set(a) == set(b)


@dataclass(frozen=True)
class ValueType:
    """One kind of value that is stored per shard."""

    name: str
    key: str
    read: Callable[[str], dict]
    write: Callable[[dict, str], str]
    fallback: Callable[[Config, str], object]


def _read_gtids(text: str) -> dict[str, str]:
    return {p["shard"]: p["gtid"] for p in json.loads(text)}


def _write_gtids(values: dict, keyspace: str) -> str:
    return json.dumps([{"keyspace": keyspace, "shard": s, "gtid": values[s], "table_p_ks": []} for s in sorted(values)], separators=(",", ":"))


def _config_gtid(c: Config, shard: str) -> str:
    if c.snapshot_mode != "initial" and c.vgtid not in (None, "", "current"):
        return _read_gtids(c.vgtid).get(shard, c.start_gtid())
    return c.start_gtid()


def _config_epoch(c: Config, shard: str) -> int:
    return json.loads(c.shard_epoch_map).get(shard, 0) if c.shard_epoch_map else 0


GTID = ValueType("gtid", "vgtid", _read_gtids, _write_gtids, _config_gtid)
EPOCH = ValueType("epoch", "transaction_epoch", json.loads, lambda v, _: json.dumps(v, sort_keys=True, separators=(",", ":")), _config_epoch)

#: (server, task key or None) -> stored offset
Store = dict[tuple[str, str | None], dict]


def read_generation(store: Store, config: Config, kind: ValueType, tasks: int, generation: int, required: bool) -> dict | None:
    """shard -> value over all tasks of a generation; None if nothing is stored. In generation 0 a task-less offset may stand in."""
    found: dict | None = None
    for i in range(max(tasks, 0)):
        got = store.get((config.server, task_key(i, tasks, generation)))
        if got is None or got.get(kind.key) is None:
            if generation == 0 and found is None and (single := store.get((config.server, None))) and single.get(kind.key) is not None:
                return kind.read(single[kind.key])
            if required:
                raise PlanError(f"no {kind.name} stored for {task_key(i, tasks, generation)}")
            continue
        found = {**(found or {}), **kind.read(got[kind.key])}
    return found


@dataclass(frozen=True)
class TaskPlan:
    index: int
    key: str | None
    shards: tuple[str, ...]
    gtids: dict
    epochs: dict

    def vgtid(self, keyspace: str) -> str:
        return GTID.write(self.gtids, keyspace)

    def config(self, base: Config) -> Config:
        return replace(base, shards=self.shards, vgtid=self.vgtid(base.keyspace), shard_epoch_map=EPOCH.write(self.epochs, ""))


def choose_shards(live: list[str], current: Iterable[str] | None, previous: Iterable[str] | None) -> list[str]:
    """The shards that tasks work on: the live ones, if they include what is stored for this generation or, where nothing is, for the
    one before; this generation may be stored in part only. Else the stored ones: a reshard while offline is replayed.
    """
    stored = set(current or previous or ())
    return sorted(live) if set(live) >= stored else sorted(stored)


def plan(config: Config, live_shards: list[str], store: Store | None = None) -> list[TaskPlan]:
    """One plan per task, with the position and epoch at which each of its shards starts."""
    store = store or {}
    live = list(config.shards or live_shards)
    if not config.offset_storage_per_task:
        value = {k.name: {s: k.fallback(config, s) for s in live} for k in (GTID, EPOCH)}
        return [TaskPlan(0, None, tuple(sorted(live)), value["gtid"], value["epoch"])]
    tasks, gen = min(config.tasks, len(live)), config.offset_storage_task_key_gen
    kinds = (GTID, EPOCH) if config.ordered_transactions else (GTID,)
    previous = {k.name: read_generation(store, config, k, config.prev_num_tasks, gen - 1, True) if gen > 0 else None for k in kinds}
    current = {k.name: read_generation(store, config, k, tasks, gen, False) for k in kinds}
    if gen > 0 and config.prev_num_tasks == tasks and same_shards(_shards(previous["gtid"]), sorted(live)):
        raise PlanError("a new key generation needs another number of tasks or other shards")
    chosen = {}
    for k in kinds:
        had, have = previous[k.name], current[k.name]
        if had is not None and not same_shards(_shards(had), sorted(live)) and set(had) >= set(live):
            raise PlanError(f"shards are gone, and with them a {k.name}: {sorted(set(had) - set(live))}")
        if have and not set(live) >= set(have):
            have = current[k.name] = read_generation(store, config, k, tasks, gen, True)  # only stored shards can be gone on with, so all must be there
        chosen[k.name] = choose_shards(live, have, had)
    if len({tuple(x) for x in chosen.values()}) > 1:
        raise PlanError("positions and epochs are stored for different shards")
    out = []
    for i, mine in assign(chosen["gtid"], tasks).items():
        value = {}
        for k in (GTID, EPOCH):
            have, had = current.get(k.name) or {}, previous.get(k.name) or {}
            value[k.name] = {s: have[s] if s in have else had[s] if s in had else k.fallback(config, s) for s in mine}
        out.append(TaskPlan(i, task_key(i, tasks, gen), tuple(mine), value["gtid"], value["epoch"]))
    return out


def _shards(stored: dict | None) -> list[str] | None:
    return sorted(stored) if stored is not None else None


# ---- the same rules on tables


def assign_table(shards: DataFrame, tasks: int) -> DataFrame:
    """shard, task: round-robin over sorted shards (a shard list is small; it is numbered in one task)."""
    n = F.least(F.lit(tasks), F.count(F.lit(1)).over(Window.partitionBy()))
    return shards.select("shard").distinct().withColumn("task", F.pmod(F.row_number().over(Window.orderBy("shard")) - 1, n).cast("int"))


def resolve_offsets(shards: DataFrame, current: DataFrame, previous: DataFrame, fallback: str) -> DataFrame:
    """shard, gtid, origin: this generation's value where the shard is stored (even as null), else the last one's, else the fallback."""
    c = current.select("shard", F.col("gtid").alias("_c"), F.lit(True).alias("_in_c"))
    p = previous.select("shard", F.col("gtid").alias("_p"), F.lit(True).alias("_in_p"))
    j = shards.join(c, "shard", "left").join(p, "shard", "left")
    return j.select("shard", F.when(F.col("_in_c"), F.col("_c")).when(F.col("_in_p"), F.col("_p")).otherwise(F.lit(fallback)).alias("gtid"), F.when(F.col("_in_c"), "current").when(F.col("_in_p"), "previous").otherwise("config").alias("origin"))


def merge_offsets(offsets: DataFrame, server: str, tasks: int, generation: int) -> DataFrame:
    """shard, gtid of all stored task offsets of a generation."""
    from ..functions.position import parse_vgtid

    keys = [task_key(i, tasks, generation) for i in range(tasks)]
    mine = offsets.where((F.col("server") == server) & F.col("task_key").isin(keys))
    return mine.select(F.explode(parse_vgtid(F.col("vgtid"))).alias("p")).select("p.shard", "p.gtid").dropDuplicates(["shard"])


def missing_offsets(offsets: DataFrame, server: str, tasks: int, generation: int) -> DataFrame:
    """task_key of the tasks of a generation that have nothing stored."""
    keys = offsets.sparkSession.createDataFrame([(task_key(i, tasks, generation),) for i in range(tasks)], "task_key string")
    return keys.join(offsets.where(F.col("server") == server), "task_key", "left_anti")


def lost_shards(previous: DataFrame, live: DataFrame) -> DataFrame:
    """Shards that were stored and are no longer live."""
    return previous.select("shard").distinct().join(live.select("shard").distinct(), "shard", "left_anti")
