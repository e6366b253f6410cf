"""Transaction assembly and epochs as stateful streaming operators, one state per stream.

Both hold the same state machines as the batch operators, so a log gives the same rows either way. State is the open unit and a few
scalars; it lives in the RocksDB store and spills there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.ordering import EpochFold
from ..operators.transactions import ASSEMBLED, Assembler

#: The state store that these operators need.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

_EVENT = "stream string, response_no long, event_no int, type string, ts_sec long, keyspace string, shard string, `table` string, statement string, vgtid string, body string"
_NAMES = ["stream", "response_no", "event_no", "type", "ts_sec", "keyspace", "shard", "table", "statement", "vgtid", "body"]


class AssemblyProcessor(StatefulProcessor):
    """Completed units of a stream. A unit ends with a response; responses are taken to be whole within a micro-batch."""

    def __init__(self, copying: bool = False):
        self.copying = copying

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("assembly", "state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = json.loads(self.state.get()[0]) if self.state.exists() else {"copying": self.copying}
        if kept.get("failed"):
            return
        a = Assembler(**{k: v for k, v in kept.items() if k != "failed"})
        events = [dict(zip(p.columns, r, strict=True)) for p in rows for r in p.astype(object).where(p.notna(), None).itertuples(index=False, name=None)]
        out, failed = [], False
        for unit in a.responses(iter(sorted(events, key=lambda e: (e["response_no"], e["event_no"])))):
            failed = failed or bool(unit) and unit[0]["type"] == "ERROR"
            out += unit
        clean = lambda v: v.item() if hasattr(v, "item") else v
        buffer = [{k: clean(v) for k, v in e.items()} for e in a.buffer]
        self.state.update((json.dumps({"copying": a.copying, "buffer": buffer, "vgtid": a.vgtid, "begun": a.begun, "committed": a.committed, "txn_no": a.txn_no, "last_commit": clean(a.last_commit), "failed": failed}),))
        if out:
            names = [*_NAMES, "txn_no", "txn_vgtid", "commit_ts", "in_copy"]
            yield pd.DataFrame([[e.get(n) for n in names] for e in out], columns=names, dtype=object)

    def close(self) -> None:
        pass


class EpochProcessor(StatefulProcessor):
    """stream, txn_no, shard, gtid, epoch of each transaction's position, with inheritance where asked for."""

    def __init__(self, inherit: bool = False, start: dict[str, tuple[str, int]] | None = None):
        self.inherit, self.start = inherit, start or {}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("epochs", "state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            previous, epochs = json.loads(self.state.get()[0])
        else:
            previous, epochs = {s: g for s, (g, _) in self.start.items()}, {s: e for s, (_, e) in self.start.items()}
        fold, out = EpochFold(previous, epochs, self.inherit), []
        for r in pd.concat(list(rows)).sort_values("txn_no").itertuples():
            made = fold.next(r.vgtid)
            out += [(r.stream, r.txn_no, s, fold.previous[s], e) for s, e in made.items()]
        self.state.update((json.dumps([fold.previous, fold.epochs]),))
        yield pd.DataFrame(out, columns=["stream", "txn_no", "shard", "gtid", "epoch"])

    def close(self) -> None:
        pass


def assemble_stream(events: DataFrame, copying: bool = False) -> DataFrame:
    """A streaming log's completed units; fields and row_changes travel as JSON in body."""
    from pyspark.sql import functions as F

    body = F.when(F.col("fields").isNotNull() | F.col("row_changes").isNotNull(), F.to_json(F.struct("fields", "row_changes", "enum_set_string")))
    flat = events.select(*(F.col(n) for n in _NAMES if n != "body"), body.alias("body"))
    return flat.groupBy("stream").transformWithStateInPandas(AssemblyProcessor(copying), f"{_EVENT}, {ASSEMBLED}", "append", "None")


def unfold(units: DataFrame) -> DataFrame:
    """Units of ``assemble_stream`` with fields and row_changes as columns again."""
    from pyspark.sql import functions as F

    from ..functions.types import EVENTS

    kinds = {f.name: f.dataType.simpleString() for f in EVENTS.fields}
    body = F.from_json("body", f"struct<fields:{kinds['fields']},row_changes:{kinds['row_changes']},enum_set_string:boolean>")
    return units.withColumn("_b", body).select(*(c for c in units.columns if c != "body"), "_b.fields", "_b.row_changes", "_b.enum_set_string")


def epoch_stream(transactions: DataFrame, inherit: bool = False, start: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    return transactions.select("stream", "txn_no", "vgtid").groupBy("stream").transformWithStateInPandas(EpochProcessor(inherit, start), "stream string, txn_no long, shard string, gtid string, epoch long", "append", "None")
