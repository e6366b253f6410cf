"""Transactions: assembly from the event log, row changes, positions and counters.

The log of a stream is totally ordered by (response_no, event_no). ``assemble`` numbers transactions by running totals over blocks of
responses, and takes only units with odd marks through the protocol; ``assemble_strict`` runs the protocol's state machine over each
stream. Both report violations as rows and give the same units.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut
from .running import running_sum

#: Responses per block of the running totals.
BLOCK = 65_536

ROW, BEGIN, COMMIT, FIELD, VGTID = "ROW", "BEGIN", "COMMIT", "FIELD", "VGTID"
DDL, OTHER, HEARTBEAT, COPY_COMPLETED = "DDL", "OTHER", "HEARTBEAT", "COPY_COMPLETED"
FLUSHING = (DDL, OTHER, HEARTBEAT)


def place() -> Column:
    """A number that orders a stream's events."""
    return F.col("response_no") * F.lit(2**24) + F.col("event_no")


def assemble(events: DataFrame) -> DataFrame:
    """events with seq, txn_no, txn_vgtid (the last VGTID of the unit), commit_ts, in_copy.

    A unit ends with the response that holds a COMMIT, or a DDL, OTHER or HEARTBEAT event; what is open at the log's end is left out.
    Units without a VGTID are dropped, unless they hold a heartbeat. All of this is decided on one row per response, then per unit, in
    small tables that are written as they come; events themselves are joined once.

    Units whose marks are not one BEGIN and then one COMMIT at most are odd. Only their events go through the protocol, unit by unit:
    a repeated BEGIN that it tolerates starts the unit over, what it does not allow ends the stream with a row of type ERROR.
    """
    kind = F.col("type")
    flag = lambda c: F.max(c.cast("int"))
    r = events.groupBy("stream", "response_no").agg(
        F.sum((kind == BEGIN).cast("int")).alias("_begins"),
        F.sum((kind == COMMIT).cast("int")).alias("_commits"),
        F.coalesce(F.max(F.when(kind == BEGIN, F.col("event_no"))) > F.min(F.when(kind == COMMIT, F.col("event_no"))), F.lit(False)).alias("_late"),
        flag(kind.isin(*FLUSHING)).alias("_flush"),
        flag(kind == HEARTBEAT).alias("_beat"),
        F.sum((kind == COPY_COMPLETED).cast("int")).alias("_copies"),
        F.max(F.when(kind == COMMIT, F.col("ts_sec"))).alias("_ts"),
        F.max_by(F.when(kind == VGTID, F.col("vgtid")), F.when(kind == VGTID, F.col("event_no"))).alias("_vgtid"),
    )
    r = cut(r.withColumn("_end", ((F.col("_flush") == 1) | (F.col("_commits") > 0)).cast("int")), "responses")
    r = running_sum(r, ["stream"], ["response_no"], F.floor(F.col("response_no") / BLOCK), _ended=F.col("_end"), _copied=F.col("_copies"))
    r = cut(r.withColumn("_unit", F.col("_ended") - F.col("_end") + 1), "units")
    begins, commits = F.sum("_begins"), F.sum("_commits")
    odd = (begins > 1) | (commits > 1) | (commits > begins) | F.max("_late")
    units = r.groupBy("stream", "_unit").agg(F.max("_end").alias("_end"), F.max("_beat").alias("_beat"), F.max("_copied").alias("_copied"), F.max("_ts").alias("commit_ts"), F.max_by("_vgtid", F.when(F.col("_vgtid").isNotNull(), F.col("response_no"))).alias("txn_vgtid"), odd.alias("_odd"))
    errors = None
    if units.where("_odd").isEmpty():
        units = units.withColumn("_from", F.lit(None).cast("bigint"))
    else:
        strange = r.select("stream", "response_no", "_unit").join(units.where("_odd").select("stream", "_unit"), ["stream", "_unit"])
        judged = cut(_judged(events.select("stream", "response_no", "event_no", "type", "vgtid").join(strange, ["stream", "response_no"])), "judged")
        errors = judged.where("error is not null").groupBy("stream").agg(F.min_by(F.struct(F.col("_unit").alias("_last"), "response_no", "event_no", "error"), "_unit").alias("e")).select("stream", "e.*")
        again = judged.where("error is null").select("stream", "_unit", place().alias("_from"), F.col("vgtid").alias("_own"))
        units = units.join(errors.select("stream", "_last"), "stream", "left").where("_last is null or _unit < _last").join(again, ["stream", "_unit"], "left")
        units = units.withColumn("txn_vgtid", F.when(F.col("_from").isNull(), F.col("txn_vgtid")).otherwise(F.col("_own")))
    kept = units.where((F.col("_end") == 1) & (F.col("txn_vgtid").isNotNull() | (F.col("_beat") == 1))).select("stream", "_unit", "_copied", "commit_ts", "txn_vgtid", "_from")
    numbered = running_sum(kept, ["stream"], ["_unit"], F.floor(F.col("_unit") / BLOCK), txn_no=F.lit(1))
    if errors is not None:
        numbered = cut(numbered, "numbered")
    named = r.select("stream", "response_no", "_unit").join(numbered, ["stream", "_unit"]).select("stream", "response_no", "txn_no", "txn_vgtid", "commit_ts", "_copied", "_from")
    copying = F.coalesce(F.col("copying"), F.lit(False)) if "copying" in events.columns else F.lit(False)
    out = events.join(named, ["stream", "response_no"]).where(F.col("_from").isNull() | (place() >= F.col("_from"))).select(*events.columns, place().alias("seq"), "txn_no", "txn_vgtid", "commit_ts", (copying & (F.col("_copied") == 0)).alias("in_copy"))
    if errors is None:
        return out
    last = numbered.groupBy("stream").agg(F.max("txn_no").alias("_n"))
    made = errors.join(last, "stream", "left").select(*_error_columns(events), place().alias("seq"), (F.coalesce("_n", F.lit(0)) + 1).alias("txn_no"), F.lit(None).cast("string").alias("txn_vgtid"), F.lit(None).cast("bigint").alias("commit_ts"), F.lit(False).alias("in_copy"))
    return out.unionByName(made)


def _error_columns(events: DataFrame) -> list[Column]:
    """The columns of events for a violation (stream, response_no, event_no, error)."""
    own = {"stream", "response_no", "event_no"}
    given = {"type": F.lit("ERROR"), "statement": F.col("error")}
    return [F.col(f.name) if f.name in own else given[f.name].alias(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields]


def _judged(light: DataFrame) -> DataFrame:
    """For each odd unit (stream, _unit): the place from which it counts and its VGTID, or the response that breaks the protocol."""
    names = ["stream", "_unit", "response_no", "event_no", "type", "vgtid"]
    made = [pa.field("stream", pa.string()), pa.field("_unit", pa.int64()), pa.field("response_no", pa.int64()), pa.field("event_no", pa.int32()), pa.field("error", pa.string()), pa.field("vgtid", pa.string())]

    def verdict(unit: Iterator[tuple]) -> tuple:
        seen: list[str] = []  # of the buffer, no more than any tolerated one and one more
        begun = committed = False
        vgtid, response, start, at = None, None, 0, (0, 0)
        for _, _, response_no, event_no, kind, position in unit:
            if response_no != response:
                response, start = response_no, event_no
            error = None
            if kind == VGTID:
                vgtid = position
            elif kind == BEGIN:
                if committed:
                    error = "BEGIN after COMMIT"
                elif begun:
                    if tuple(seen) not in _RESTARTS:
                        error = "BEGIN inside a transaction"
                    seen, vgtid, at = [], None, (response_no, event_no)
                begun = True
            elif kind == COMMIT:
                error = "COMMIT before BEGIN" if not begun else "second COMMIT" if committed else None
                committed = True
            if error:
                return response, start, error, None
            if len(seen) < 5:
                seen.append(kind)
        return *at, None, vgtid

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for key, unit in groupby(rows, key=lambda r: r[:2]):
            found = (*key, *verdict(unit))
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(found, made, strict=True)], [f.name for f in made])

    return light.select(*names).repartition("stream", "_unit").sortWithinPartitions("stream", "_unit", "response_no", "event_no").mapInArrow(run, "stream string, _unit long, response_no long, event_no int, error string, vgtid string")


class ProtocolError(ValueError):
    """An event sequence that the protocol does not allow; it ends its stream."""


#: Buffers after which a second BEGIN starts over instead of being an error.
_RESTARTS = {(BEGIN, FIELD), (BEGIN, FIELD, VGTID), (COPY_COMPLETED, BEGIN, FIELD), (COPY_COMPLETED, BEGIN, FIELD, VGTID)}


@dataclass
class Assembler:
    """The protocol's state machine for one stream. ``feed`` takes one response, and returns the unit it completes, if any."""

    copying: bool = False
    buffer: list[dict] = field(default_factory=list)
    vgtid: str | None = None
    begun: bool = False
    committed: bool = False
    txn_no: int = 0
    last_commit: int | None = None

    def feed(self, response: list[dict]) -> list[dict]:
        flush = beat = False
        for e in response:
            kind = e["type"]
            if kind == VGTID:
                self.vgtid = e["vgtid"]
            elif kind == BEGIN:
                if self.committed:
                    raise ProtocolError("BEGIN after COMMIT")
                if self.begun:
                    if tuple(x["type"] for x in self.buffer) not in _RESTARTS:
                        raise ProtocolError("BEGIN inside a transaction")
                    self._reset()
                self.begun = True
            elif kind == COMMIT:
                if not self.begun:
                    raise ProtocolError("COMMIT before BEGIN")
                if self.committed:
                    raise ProtocolError("second COMMIT")
                self.committed, self.last_commit = True, e["ts_sec"]
            elif kind in FLUSHING:
                flush, beat = True, beat or kind == HEARTBEAT
            elif kind == COPY_COMPLETED:
                self.copying = False
            self.buffer.append(e)
        if not (self.begun and self.committed or flush):
            return []
        out = []
        if self.vgtid is not None or beat:
            self.txn_no += 1
            out = [{**e, "txn_no": self.txn_no, "txn_vgtid": self.vgtid, "commit_ts": self.last_commit if self.committed else None, "in_copy": self.copying} for e in self.buffer]
        self._reset()
        return out

    def _reset(self) -> None:
        self.buffer, self.vgtid, self.begun, self.committed = [], None, False, False

    def responses(self, events: Iterator[dict]) -> Iterator[list[dict]]:
        """Feeds ordered events response by response; a violation yields one ERROR row and ends the stream."""
        held: list[dict] = []
        try:
            for e in events:
                if held and held[-1]["response_no"] != e["response_no"]:
                    yield self.feed(held)
                    held = []
                held.append(e)
            if held:
                yield self.feed(held)
        except ProtocolError as error:
            at = held[0] if held else {}
            yield [{**dict.fromkeys(at), "stream": at.get("stream"), "response_no": at.get("response_no"), "event_no": at.get("event_no"), "type": "ERROR", "statement": str(error), "txn_no": self.txn_no + 1, "txn_vgtid": None, "commit_ts": None, "in_copy": self.copying}]


ASSEMBLED = "txn_no long, txn_vgtid string, commit_ts long, in_copy boolean"


def assemble_strict(events: DataFrame, copying: bool = False) -> DataFrame:
    """Like ``assemble``, by the state machine; a violation of the protocol is a row of type ERROR that ends its stream.

    A stream's events are read in order by one task, which holds no more than the open unit; the load is spread over streams. Only
    places, types, times and positions go through Python; verdicts are written, and joined to the events by their place.
    """
    light = ["stream", "response_no", "event_no", "type", "ts_sec", "vgtid"]
    schema = f"stream string, response_no long, event_no int, error string, {ASSEMBLED}"
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
    names = ["stream", "response_no", "event_no", "error", "txn_no", "txn_vgtid", "commit_ts", "in_copy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (dict(zip(light, r, strict=True)) for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        held: list[tuple] = []
        made = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)
        for _, stream in groupby(rows, key=lambda e: e["stream"]):
            for unit in Assembler(copying).responses(stream):
                held += [(u["stream"], u["response_no"], u["event_no"], u["statement"] if u["type"] == "ERROR" else None, u["txn_no"], u["txn_vgtid"], u["commit_ts"], u["in_copy"]) for u in unit]
                if len(held) >= 10_000:
                    yield made()
                    held = []
        if held:
            yield made()

    found = cut(events.select(*light).repartition("stream").sortWithinPartitions("stream", "response_no", "event_no").mapInArrow(run, schema), "strict")
    units = events.join(found.where("error is null").drop("error"), ["stream", "response_no", "event_no"]).select(*events.columns, "txn_no", "txn_vgtid", "commit_ts", "in_copy")
    return units.unionByName(found.where("error is not null").select(*_error_columns(events), "txn_no", "txn_vgtid", "commit_ts", "in_copy"))


def table_name(exclude_keyspace: bool = False) -> tuple[Column, Column]:
    """keyspace and table of an event's table field: ``ks.table``, or a bare name where keyspaces are left out; else an error."""
    parts = F.split(F.col("table"), r"\.")
    if exclude_keyspace:
        return F.col("keyspace"), F.element_at(parts, -1)
    ok = F.when(F.col("table").isNull() | (F.size(parts) == 2), parts).otherwise(F.raise_error(F.concat(F.lit("not keyspace.table: "), F.col("table"))).cast("array<string>"))
    return F.get(ok, F.lit(0)), F.get(ok, F.lit(1))


def row_changes(units: DataFrame, exclude_keyspace: bool = False) -> DataFrame:
    """One row per row change: op (INSERT, UPDATE, DELETE by which images are there), event_order in the transaction."""
    keyspace, table = table_name(exclude_keyspace)
    r = units.where(F.col("type") == ROW).select("stream", "txn_no", F.col("seq") if "seq" in units.columns else place().alias("seq"), keyspace.alias("keyspace"), "shard", table.alias("table"), F.col("commit_ts").alias("ts_sec"), "txn_vgtid", "in_copy", F.posexplode("row_changes").alias("change_no", "change"))
    op = F.when(F.col("change.before").isNull(), "INSERT").when(F.col("change.after").isNull(), "DELETE").otherwise("UPDATE")
    return r.select("*", op.alias("op"), "change.before", "change.after").drop("change")


def messages(units: DataFrame) -> DataFrame:
    """kind, ts_sec, txn_id of what is no row change: BEGIN and COMMIT (their unit's position as id), DDL, OTHER, HEARTBEAT.

    A BEGIN or COMMIT of a unit without a position is left out. Every kind keeps its event's own time.
    """
    m = units.where(F.col("type").isin(BEGIN, COMMIT, *FLUSHING)).where(~F.col("type").isin(BEGIN, COMMIT) | F.col("txn_vgtid").isNotNull())
    return m.select("stream", "txn_no", "response_no", "event_no", F.col("type").alias("kind"), "ts_sec", "keyspace", "shard", "statement", F.col("txn_vgtid").alias("txn_id"))


def positions(units: DataFrame) -> DataFrame:
    """stream, txn_no, vgtid (null for units without one), position_no: how many units of the stream had a position by then."""
    if "type" in units.columns:
        units = units.where(F.col("type") != "ERROR")
    t = units.groupBy("stream", "txn_no").agg(F.max("txn_vgtid").alias("vgtid"))
    return running_sum(t, ["stream"], ["txn_no"], F.floor(F.col("txn_no") / BLOCK), position_no=F.col("vgtid").isNotNull().cast("int"))


def offsets(units: DataFrame) -> DataFrame:
    """stream, txn_no, vgtid, restart_vgtid: the position as of each transaction, and the one before it, which its rows carry, so a
    restart repeats it whole. A unit without a position (a heartbeat) keeps the last one."""
    p = cut(positions(units), "positions")
    own = p.where("vgtid is not null").select("stream", F.col("position_no").alias("_at"), F.col("vgtid").alias("_v"))
    before = F.col("position_no") - F.col("vgtid").isNotNull().cast("int")
    as_of = lambda at, name: p.select("stream", "txn_no", at.alias("_at")).join(own, ["stream", "_at"], "left").select("stream", "txn_no", F.col("_v").alias(name))
    return as_of(F.col("position_no"), "vgtid").join(as_of(before, "restart_vgtid"), ["stream", "txn_no"])


def resume(units: DataFrame, positions: DataFrame) -> DataFrame:
    """Units after each stream's stored position (stream, vgtid): a restart repeats the unit after it as a whole. A stream without a
    stored position, or whose position the log does not hold, starts at its beginning."""
    p = positions.select(F.col("stream").alias("_s"), F.col("vgtid").alias("_v"))
    last = units.join(p, (units["stream"] == p["_s"]) & (units["txn_vgtid"] == p["_v"])).groupBy(F.col("stream").alias("_s")).agg(F.max("txn_no").alias("_last"))
    return units.join(last, units["stream"] == last["_s"], "left").where(F.col("txn_no") > F.coalesce("_last", F.lit(0))).drop("_s", "_last")


def counters(changes: DataFrame) -> DataFrame:
    """changes with total_order (in the transaction) and data_collection_order (in the transaction and table), from 1."""
    total = Window.partitionBy("stream", "txn_no").orderBy("seq", "change_no")
    each = Window.partitionBy("stream", "txn_no", "keyspace", "table").orderBy("total_order")
    return changes.withColumn("total_order", F.row_number().over(total).cast("bigint")).withColumn("data_collection_order", F.row_number().over(each).cast("bigint"))


def transaction_ends(changes: DataFrame) -> DataFrame:
    """END records: number of events of each transaction, and per table."""
    per = changes.groupBy("stream", "txn_no", "txn_vgtid", "keyspace", "table").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("stream", "txn_no", "txn_vgtid").agg(F.sum("n").alias("event_count"), F.sort_array(F.collect_list(F.struct(F.concat_ws(".", "keyspace", "table").alias("data_collection"), F.col("n").alias("event_count")))).alias("data_collections")).withColumn("status", F.lit("END"))
