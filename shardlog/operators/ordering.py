"""Total order of transactions across failovers and resharding: epoch and rank per shard."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.position import epoch_step, gtid_rank, parse_vgtid
from ..sources.scratch import cut
from .running import running_sum

BLOCK = 65_536


def shard_positions(transactions: DataFrame) -> DataFrame:
    """stream, txn_no, shard, gtid: one row per transaction and shard of its VGTID."""
    return transactions.select("stream", "txn_no", F.explode(parse_vgtid(F.col("vgtid"))).alias("p")).select("stream", "txn_no", "p.shard", "p.gtid")


def epochs(transactions: DataFrame, start: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """stream, txn_no, shard, gtid, epoch for transactions (stream, txn_no from 1 without gaps, vgtid).

    start: shard -> (GTID, epoch) before the first transaction. A shard that was in the previous position goes on from its epoch, by
    the step between the two GTIDs; one that was not starts at 0. Neighbours meet by an equi-join on txn_no, and epochs are running
    sums over blocks, so one long stream is spread over tasks.
    """
    p = cut(shard_positions(transactions), "positions")
    begin = [F.struct(F.lit(s).alias("shard"), F.lit(g).alias("gtid"), F.lit(e).cast("bigint").alias("base")) for s, (g, e) in (start or {}).items()]
    known_before = F.array(*begin) if begin else F.array().cast("array<struct<shard:string,gtid:string,base:bigint>>")
    first = p.select("stream").distinct().select("stream", F.lit(0).cast("bigint").alias("txn_no"), F.inline(known_before))
    all_ = p.withColumn("base", F.lit(0).cast("bigint")).unionByName(first.select("stream", "txn_no", "shard", "gtid", "base"))
    prev = all_.select("stream", (F.col("txn_no") + 1).alias("txn_no"), "shard", F.col("gtid").alias("before"))
    d = all_.join(prev, ["stream", "txn_no", "shard"], "left")
    known = F.col("before").isNotNull()
    d = d.withColumn("step", F.when(known, epoch_step(F.col("before"), F.col("gtid"))).otherwise(F.col("base").cast("int"))).withColumn("fresh", (~known).cast("int"))
    block = F.floor(F.col("txn_no") / BLOCK)
    d = cut(d.drop("before"), "steps")
    d = running_sum(d, ["stream", "shard"], ["txn_no"], block, _sum=F.col("step"), _island=F.col("fresh"))
    d = cut(d, "sums")
    at_start = d.groupBy("stream", "shard", "_island").agg(F.min(F.col("_sum")).alias("_low"), F.max(F.when(F.col("fresh") == 1, F.col("base"))).alias("_base"))
    return d.join(at_start, ["stream", "shard", "_island"]).where("txn_no > 0").select("stream", "txn_no", "shard", "gtid", (F.col("_sum") - F.col("_low") + F.col("_base")).cast("bigint").alias("epoch"))


def with_rank(positions: DataFrame) -> DataFrame:
    """Adds the rank of each real GTID; overrides have none."""
    return positions.withColumn("rank", F.when(F.col("gtid").isin("current", ""), None).otherwise(gtid_rank(F.col("gtid"))))


class EpochFold:
    """The sequential fold of one stream: epoch maps with inheritance from overlapping parent shards."""

    def __init__(self, previous: dict[str, str] | None = None, epochs: dict[str, int] | None = None, inherit: bool = False):
        self.previous, self.epochs, self.inherit = dict(previous or {}), dict(epochs or {}), inherit

    @staticmethod
    def hosts(gtid: str) -> set[str]:
        members = gtid.split("/", 1)[1] if "/" in gtid else ""
        if not members or any(":" not in m for m in members.split(",")):
            raise ValueError(f"not a GTID with hosts: {gtid!r}")
        return {m.split(":")[0] for m in members.split(",")}

    @classmethod
    def step(cls, old: str, new: str) -> int:
        override = ("current", "")
        if new in override:
            if old not in override:
                raise ValueError("a GTID can not be followed by an override")
            return 0
        return 1 if old in override else int(not cls.hosts(new) >= cls.hosts(old))

    @staticmethod
    def bounds(shard: str) -> tuple[str, str | None]:
        lo, _, hi = shard.lower().partition("-")
        hi = hi.split("-")[0]
        if hi and lo >= hi:
            raise ValueError(f"bounds of shard out of order: {shard}")
        return lo, hi or None

    @classmethod
    def overlap(cls, a: str, b: str) -> bool:
        (al, ah), (bl, bh) = cls.bounds(a), cls.bounds(b)
        return (bh is None or al < bh) and (ah is None or bl < ah)

    @classmethod
    def inherited(cls, shard: str, epochs: dict[str, int]) -> int:
        return max((e + 1 for s, e in epochs.items() if cls.overlap(shard, s)), default=0)

    def next(self, vgtid: str) -> dict[str, int]:
        """Epochs of all shards of the next position; it replaces the previous one, so shards that are gone are forgotten."""
        now = {p["shard"]: p["gtid"] for p in json.loads(vgtid)}
        out = {}
        for shard, gtid in now.items():
            if shard in self.previous:
                if shard not in self.epochs:
                    raise ValueError(f"no epoch for shard {shard}")
                out[shard] = self.epochs[shard] + self.step(self.previous[shard], gtid)
            else:
                out[shard] = self.inherited(shard, self.epochs) if self.inherit else 0
        self.previous, self.epochs = now, out
        return out


def epochs_in_order(transactions: DataFrame, start: dict[str, tuple[str, int]] | None = None, inherit: bool = True) -> DataFrame:
    """Like ``epochs``, with inheritance, which needs the whole map at every step: one task per stream, holding one map."""
    begin = start or {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fold, stream = None, None
        for pdf in batches:
            rows = []
            for s, n, vgtid in pdf.itertuples(index=False, name=None):
                if fold is None or s != stream:
                    fold, stream = EpochFold({k: g for k, (g, _) in begin.items()}, {k: e for k, (_, e) in begin.items()}, inherit), s
                made = fold.next(vgtid)
                rows += [(s, n, k, fold.previous[k], e) for k, e in made.items()]
            yield pd.DataFrame(rows, columns=["stream", "txn_no", "shard", "gtid", "epoch"])

    ordered = transactions.select("stream", "txn_no", "vgtid").repartition("stream").sortWithinPartitions("stream", "txn_no")
    return ordered.mapInPandas(run, "stream string, txn_no long, shard string, gtid string, epoch long")
