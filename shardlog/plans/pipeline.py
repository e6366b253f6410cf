"""From a log to routed records, in one plan built from the configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import cells
from ..functions.types import key_columns
from ..operators import envelope, filters, ordering, routing, schema_history, transactions, transforms
from ..sources.scratch import cut
from .config import Config


@dataclass(frozen=True)
class Outputs:
    data: DataFrame
    transactions: DataFrame
    schema_changes: DataFrame
    heartbeats: DataFrame
    offsets: DataFrame
    #: Row changes with packed images, their place in the transaction and their schema; and the schemas. ``typed`` reads them.
    changes: DataFrame
    history: DataFrame


def naming(config: Config) -> routing.TopicNaming:
    return routing.TopicNaming(config.topic_prefix, config.override_topic_prefix, config.override_topic_exclude, config.schema_change_topic)


def _order(units: DataFrame, config: Config) -> DataFrame:
    """stream, txn_no, shard, transaction_epoch, transaction_rank of all units that have a position."""
    p = cut(transactions.positions(units).where("vgtid is not null"), "ordered")
    t = p.select("stream", F.col("position_no").alias("txn_no"), "vgtid")
    start = None
    if config.vgtid not in (None, "", "current"):
        from .planner import EPOCH, GTID

        gtids = GTID.read(config.vgtid)
        start = {s: (g, EPOCH.fallback(config, s)) for s, g in gtids.items()}
    made = ordering.epochs_in_order(t, start, inherit=True) if config.inherit_epoch else ordering.epochs(t, start)
    ranked = ordering.with_rank(made).select("stream", F.col("txn_no").alias("position_no"), "shard", F.col("epoch").alias("transaction_epoch"), F.col("rank").alias("transaction_rank"))
    return ranked.join(p.select("stream", "position_no", "txn_no"), ["stream", "position_no"]).drop("position_no")


def _kept(config: Config):
    """Whether the column lists keep a column ``name`` of a row's table."""
    if not (config.column_include or config.column_exclude):
        return None
    return lambda name: filters.column_included(F.concat_ws(".", "keyspace", "table"), name, config.column_include, config.column_exclude)


def _records(d: DataFrame, key_before: Column, key: Column, config: Config) -> DataFrame:
    """Routed records of changes with before and after images; a change of the key is split."""
    split = envelope.split_key_updates(d, key_before, key, config.tombstones_on_delete)
    block = envelope.transaction_struct(config.ordered_transactions) if config.provide_transaction_metadata or config.ordered_transactions else None
    made = envelope.envelope(split.drop("key").withColumnRenamed("record_key", "key"), config.server, F.col("before"), F.col("after"), block, config.source_maker or envelope.source_struct).withColumn("record_kind", F.lit("data"))
    custom = (lambda: config.topic_naming(F.col("keyspace"), F.col("table"))) if config.topic_naming else naming(config)
    return routing.route(transforms.chain(list(config.transforms))(made), custom)


def build(events: DataFrame, config: Config, strict: bool = False) -> Outputs:
    """All outputs of a log. Assembled events are written once, and each output reads the columns that it needs.

    Images in ``data`` are maps of raw text cells, for all tables together; ``typed`` gives one table's records with typed images.
    Row changes of tables that are filtered out are dropped before schemas are matched or rows unpacked. While a stream copies (snapshot
    mode initial, or a column ``copying`` of the events), its rows are marked until COPY_COMPLETED.
    """
    copying = config.start_gtid() == "" and config.vgtid in (None, "")
    if "copying" not in events.columns and copying:
        events = events.withColumn("copying", F.lit(True))
    units = cut(transactions.assemble_strict(events, copying) if strict else transactions.assemble(events), "events")
    names = naming(config)
    changes = filters.filter_tables(transactions.row_changes(units, config.exclude_keyspace_from_table_name), config.table_include, config.table_exclude)
    if config.snapshot_tables is not None:  # rows of tables that are not to be copied come by the stream alone
        changes = changes.where(~F.col("in_copy") | filters.snapshot_included(F.col("keyspace"), F.col("table"), config.snapshot_tables))
    history = filters.filter_tables(schema_history.versions(units, config.exclude_keyspace_from_table_name), config.table_include, config.table_exclude)
    history = cut(history, "history")
    numbered = transactions.counters(changes)
    offsets = transactions.offsets(units)
    if config.ordered_transactions:
        numbered = numbered.join(_order(units, config), ["stream", "txn_no", "shard"], "left")
    met = schema_history.with_schema(numbered, history)
    imaged = envelope.raw_images(met, _kept(config))
    text = lambda m: F.transform_values(m, lambda _, v: v.cast("string"))
    imaged = imaged.withColumns({c: text(F.col(c)) for c in ("before", "after", "key_before", "key")})
    data = _records(imaged.withColumn("_kb", F.map_entries("key_before")).withColumn("_ka", F.map_entries("key")), F.col("_kb"), F.col("_ka"), config)
    m = transactions.messages(units)
    ends = transactions.transaction_ends(changes)
    return Outputs(data, routing.transaction_records(m, ends, names), routing.schema_change_records(m, names, config.include_schema_changes), routing.heartbeat_records(m, offsets, config.server, names, config.heartbeat_interval_ms), offsets, met, history)


def typed(out: Outputs, config: Config, keyspace: str, table: str) -> DataFrame:
    """Records of one table with typed images, by all settings of how values are written.

    The table's distinct schemas come to the driver (they are as many as its real changes). Images have the columns of all of them;
    a column whose type changed is text. Copied rows, and streams that say so, have ENUM and SET labels in their cells.
    """
    mine = (F.col("keyspace") == keyspace) & (F.col("table") == table)
    found = out.history.where(mine).groupBy("fields").agg(F.min("from_seq").alias("at")).orderBy("at", F.to_json("fields")).collect()
    d = out.changes.where(mine)
    if not found:
        return d.limit(0)
    options, plain = config.decode_options(), [[f.asDict() for f in r["fields"]] for r in found]
    kinds: dict[str, set[str]] = {}

    as_text = F.col("in_copy") | F.col("labels_as_text")

    def values(image: str, fields: list[dict]) -> dict[str, Column]:
        """The columns kept of one schema, from the array of raw cells."""
        cell = lambda i, _: F.get(F.col(f"_{image}"), F.lit(i))
        out, labels = envelope.typed_cells(cell, fields, options, False), envelope.typed_cells(cell, fields, options, True)
        coded = {f["name"] for f in fields if f["type"] in ("ENUM", "SET")}
        keep = filters.columns_kept(keyspace, table, list(out), config.column_include, config.column_exclude)
        return {n: F.when(as_text, labels[n]).otherwise(out[n]) if n in coded else out[n] for n in keep}

    empty = d.sparkSession.createDataFrame([], "_after array<binary>, in_copy boolean, labels_as_text boolean")
    for fields in plain:
        for f in empty.select(*(c.alias(n) for n, c in values("after", fields).items())).schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    kind = {n: next(iter(k)) if len(k) == 1 else "string" for n, k in kinds.items()}

    def per_version(make) -> Column:
        out = F.lit(None)
        for i, fields in enumerate(plain):
            out = F.when(F.col("_version") == i, make(fields)).otherwise(out)
        return out

    def struct(image: str, fields: list[dict]) -> Column:
        have = values(image, fields)
        return F.struct(*((have[n].cast(k) if n in have else F.lit(None).cast(k)).alias(n) for n, k in kind.items()))

    versions = d.sparkSession.createDataFrame([(i, r["fields"]) for i, r in enumerate(found)], f"_version int, _fields {out.history.schema['fields'].dataType.simpleString()}")
    d = d.join(F.broadcast(versions), F.col("fields") == F.col("_fields")).drop("_fields")
    keys = [n for n in dict.fromkeys(n for fields in plain for n in key_columns(fields)) if n in kind]
    # Cells are taken out once, as a column of their own, and so are images: what reads them many times does not repeat the work.
    images = ("before", "after")
    d = d.withColumns({f"_{c}": F.when(F.col(c).isNotNull(), per_version(lambda fields, c=c: F.array(*cells(F.col(c), len(fields))))) for c in images})
    typed_ = d.withColumns({c: F.when(F.col(c).isNotNull(), per_version(lambda fields, c=c: struct(c, fields))) for c in images}).drop("_before", "_after")
    pick = lambda c: F.when(F.col(c).isNotNull(), F.struct(*(F.col(c)[n].alias(n) for n in keys))) if keys else F.lit(None).cast("string")
    typed_ = typed_.withColumn("_kb", pick("before")).withColumn("_ka", F.coalesce(pick("after"), pick("before")))
    return _records(typed_, F.col("_kb"), F.col("_ka"), config)
