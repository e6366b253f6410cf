"""Progress figures of running queries, one line of names per task as a monitoring system would list them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


def metric_name(server: str, task: str, context: str = "streaming") -> str:
    return f"shardlog:type=connector-metrics,context={context},server={server},task={task}"


def observed(df: DataFrame, name: str) -> DataFrame:
    """df with its number of events, per kind of operation, and its last time reported on each batch."""
    count = lambda op: F.count_if(F.col("op") == op).alias(op.lower())
    return df.observe(name, F.count(F.lit(1)).alias("events"), count("INSERT"), count("UPDATE"), count("DELETE"), F.max("ts_sec").alias("last_ts_sec"))


class Progress(StreamingQueryListener):
    """Keeps the last progress of every query, and the first failure."""

    def __init__(self):
        self.last: dict[str, dict] = {}
        self.failures: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.last.setdefault(str(event.id), {})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.last[str(p.id)] = {"batch": p.batchId, "rows": p.numInputRows, "observed": {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures.setdefault(str(event.id), event.exception)


def retriable(error: Exception) -> bool:
    """Whether a failure of the change stream's connection may pass: every status of the remote call may."""
    return any(k.__name__ in ("RpcError", "StatusRuntimeException", "StatusException", "ConnectionError") for k in type(error).__mro__)
