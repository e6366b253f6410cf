"""Replay of stored change logs: as a table, as a file stream, and as a data source that starts at a position.

The data source reads one folder of JSON lines per stream, a response per line group, and its offset is the number of the next
response of each stream, so a restart begins at a response's edge. Filters on tables are applied by the reader.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions.types import EVENTS
from ..operators.filters import _any


def read_log(spark: SparkSession, path: str, tables: str | None = None, streams: list[str] | None = None, kind: str = "parquet") -> DataFrame:
    """A stored log. Filters on stream and table are pushed into the scan; events without a table always pass."""
    df = spark.read.schema(EVENTS).format(kind).load(path)
    if streams is not None:
        df = df.where(F.col("stream").isin(streams))
    if tables:
        df = df.where(F.col("table").isNull() | F.col("table").rlike(_any(tables)))
    return df


def stream_log(spark: SparkSession, path: str, files_per_batch: int = 16, kind: str = "parquet") -> DataFrame:
    """The same as a file stream; files_per_batch bounds a micro-batch."""
    return spark.readStream.schema(EVENTS).format(kind).option("maxFilesPerTrigger", files_per_batch).load(path)


class _Slice(InputPartition):
    def __init__(self, stream: str, start: int, end: int):
        self.stream, self.start, self.end = stream, start, end


class ReplayReader(DataSourceStreamReader):
    """Responses of each stream's log file, so many per batch."""

    def __init__(self, options: dict):
        self.path = options["path"].removeprefix("file://")
        self.per_batch = int(options.get("responsesPerBatch", "1000"))
        self.tables = options.get("tables") or None
        self.first = json.loads(options.get("startingResponses", "{}"))
        self.at: dict[str, int] | None = None

    def _logs(self) -> dict[str, str]:
        import glob
        import os

        return {os.path.basename(f).removesuffix(".jsonl"): f for f in sorted(glob.glob(f"{self.path}/*.jsonl"))}

    def _last(self, file: str) -> int:
        with open(file, encoding="utf-8") as f:
            return max((json.loads(line)["response_no"] for line in f), default=-1) + 1

    def initialOffset(self) -> dict:
        return {s: self.first.get(s, 0) for s in self._logs()}

    def latestOffset(self) -> dict:
        at = self.at if self.at is not None else self.initialOffset()
        self.at = {s: min(at.get(s, 0) + self.per_batch, max(at.get(s, 0), self._last(f))) for s, f in self._logs().items()}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Slice(s, start.get(s, 0), n) for s, n in end.items() if n > start.get(s, 0)]

    def read(self, partition: _Slice) -> Iterator[tuple]:
        import base64
        import re

        keep = re.compile(_any(self.tables)) if self.tables else None
        image = lambda r: r and (r["lengths"], base64.b64decode(r["values"]))
        with open(self._logs()[partition.stream], encoding="utf-8") as f:
            for line in f:
                e = json.loads(line)
                if not partition.start <= e["response_no"] < partition.end or keep and e.get("table") and not keep.match(e["table"]):
                    continue
                fields = e.get("fields")
                names = ("name", "type", "column_type", "flags", "decimals", "column_length")
                yield (partition.stream, e["response_no"], e["event_no"], e["type"], e.get("ts_sec"), e.get("keyspace"), e.get("shard"), e.get("table"), e.get("statement"), e.get("vgtid"), fields and [tuple(x.get(n) for n in names) for x in fields], e.get("enum_set_string"), e.get("row_changes") and [(image(c.get("before")), image(c.get("after"))) for c in e["row_changes"]])


class ReplaySource(DataSource):
    """``spark.readStream.format("shardlog_replay").option("path", folder)``."""

    @classmethod
    def name(cls) -> str:
        return "shardlog_replay"

    def schema(self):
        return EVENTS

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ReplayReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ReplaySource)


def write_replay(events: list[dict], folder: str) -> None:
    """Events as the data source reads them: a JSON-lines file per stream, bytes in base64."""
    import base64
    import os

    os.makedirs(folder, exist_ok=True)
    by: dict[str, list[dict]] = {}
    for e in events:
        by.setdefault(e["stream"], []).append(e)
    plain = lambda v: base64.b64encode(v).decode() if isinstance(v, bytes | bytearray) else v.asDict(True) if hasattr(v, "asDict") else v
    for stream, rows in by.items():
        with open(f"{folder}/{stream}.jsonl", "w", encoding="utf-8") as f:
            for e in sorted(rows, key=lambda e: (e["response_no"], e["event_no"])):
                f.write(json.dumps({k: v for k, v in e.items() if v is not None}, default=plain) + "\n")
