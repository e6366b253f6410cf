"""The engine's settings, with their checks."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from ..functions.decode import DecodeOptions

CURRENT = "current"


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Config:
    """Field names are the setting's words; defaults as they are without a setting."""

    server: str = "server"
    host: str | None = None
    port: int = 15991
    user: str | None = None
    password: str | None = None
    keyspace: str = ""
    shards: tuple[str, ...] = ()
    vgtid: str | None = None
    shard_epoch_map: str | None = None
    exclude_empty_shards: bool = False
    exclude_keyspace_from_table_name: bool = False
    stream_keyspace_heartbeats: bool = False
    tablet_type: str = "MASTER"
    stop_on_reshard: bool = False
    inherit_epoch: bool = False
    provide_transaction_metadata: bool = False
    ordered_transactions: bool = False
    keepalive_interval_ms: int | None = None
    grpc_headers: str = ""
    grpc_max_inbound_message_size: int = 4_194_304
    grpc_load_balancing: str = "pick_first"
    include_unknown_datatypes: bool = False
    include_schema_changes: bool = False
    offset_storage_per_task: bool = False
    offset_storage_task_key_gen: int = -1
    prev_num_tasks: int = -1
    connector_generation: int = 0
    snapshot_mode: str = "initial"
    snapshot_tables: str | None = None
    table_include: str | None = None
    table_exclude: str | None = None
    column_include: str | None = None
    column_exclude: str | None = None
    bigint_unsigned: str = "string"
    binary_handling: str = "bytes"
    override_datetime_to_nullable: bool = False
    time_precision: str = "adaptive_time_microseconds"
    topic_prefix: str = "server"
    override_topic_prefix: str | None = None
    override_topic_exclude: str | None = None
    schema_change_topic: str | None = None
    heartbeat_interval_ms: int = 0
    tombstones_on_delete: bool = True
    tasks: int = 1
    transforms: tuple[tuple[str, dict], ...] = field(default=())
    #: Wire type -> function of (raw cell, column type) that gives the value, or None to leave it to the built-in decoding.
    converters: dict = field(default_factory=dict)
    #: Makes the source block from the server's name; the topic from (keyspace, table). None: the built-in ones.
    source_maker: Callable | None = None
    topic_naming: Callable | None = None

    def check(self) -> Config:
        one_of = {"tablet_type": ("MASTER", "REPLICA", "RDONLY"), "snapshot_mode": ("initial", "never"), "bigint_unsigned": ("string", "precise", "long"), "binary_handling": ("bytes", "base64", "hex"), "time_precision": ("adaptive_time_microseconds", "connect", "isostring")}
        for name, allowed in one_of.items():
            if getattr(self, name) not in allowed:
                raise ConfigError(f"{name} must be one of {', '.join(allowed)}")
        if self.shards and self.vgtid not in (None, "", CURRENT):
            named = {p["shard"] for p in self._positions()}
            if named != set(self.shards):
                raise ConfigError("vgtid and shards name different shards")
        if self.vgtid not in (None, "", CURRENT):
            for p in self._positions():
                if p.get("keyspace") != self.keyspace:
                    raise ConfigError("vgtid names another keyspace")
        if self.shard_epoch_map:
            try:
                epochs = json.loads(self.shard_epoch_map)
            except ValueError as e:
                raise ConfigError("shard_epoch_map is not JSON") from e
            if self.shards and set(epochs) != set(self.shards):
                raise ConfigError("shard_epoch_map and shards name different shards")
        if self.inherit_epoch and not self.ordered_transactions:
            raise ConfigError("inherit_epoch needs ordered transactions")
        if self.tasks > 1 and not self.offset_storage_per_task:
            raise ConfigError("several tasks need offsets per task")
        if self.offset_storage_per_task and (self.offset_storage_task_key_gen < 0 or self.prev_num_tasks < 1 and self.offset_storage_task_key_gen > 0):
            raise ConfigError("offsets per task need a key generation, and the previous number of tasks after the first")
        self.headers()
        return self

    def _positions(self) -> list[dict]:
        try:
            return json.loads(self.vgtid or "")
        except ValueError as e:
            raise ConfigError("vgtid is neither current nor JSON") from e

    def headers(self) -> dict[str, str]:
        out = {}
        for part in filter(None, (p.strip() for p in self.grpc_headers.split(","))):
            key, colon, value = part.partition(":")
            if not colon or not key.strip():
                raise ConfigError(f"not a header: {part!r}")
            out[key.strip()] = value.strip()
        return out

    def start_gtid(self) -> str:
        """Where shards without a position begin: a copy (empty GTID) in snapshot mode initial, else the current position."""
        return "" if self.snapshot_mode == "initial" else CURRENT

    def decode_options(self) -> DecodeOptions:
        return DecodeOptions(self.bigint_unsigned, self.binary_handling, self.time_precision, self.override_datetime_to_nullable, self.include_unknown_datatypes, converters=dict(self.converters))

    def source_options(self) -> dict[str, str]:
        """Options of the change stream's reader."""
        return {"keyspace": self.keyspace, "shards": ",".join(self.shards), "tabletType": self.tablet_type, "stopOnReshard": str(self.stop_on_reshard).lower(), "excludeKeyspace": str(self.exclude_keyspace_from_table_name).lower(), "keyspaceHeartbeats": str(self.stream_keyspace_heartbeats).lower(), "heartbeatMs": str(self.heartbeat_interval_ms), "tables": self.table_include or ""}
