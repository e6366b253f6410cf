"""Table schemas that arrive in the log, per shard: versions, and the version each row was written under."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.types import UNIQUE
from ..sources.scratch import cut
from .transactions import BLOCK, FIELD, place, table_name

_TABLE = ["stream", "shard", "keyspace", "table"]
#: Entries of a group in the search for a row's version: 16.
FANOUT_BITS = 4


def versions(events: DataFrame, exclude_keyspace: bool = False) -> DataFrame:
    """stream, shard, keyspace, table, from_seq, to_seq (the next version's place; null: still valid), fields, labels_as_text (the stream
    writes ENUM and SET as labels)."""
    keyspace, table = table_name(exclude_keyspace)
    named = F.when(F.exists("fields", lambda f: (F.coalesce(f["name"], F.lit("")) == "") | f["name"].startswith("@")), F.raise_error(F.lit("illegal column name")).cast("string"))
    v = events.where(F.col("type") == FIELD).select("stream", "shard", keyspace.alias("keyspace"), table.alias("table"), place().alias("from_seq"), F.when(named.isNull(), F.col("fields")).alias("fields"), (F.coalesce(F.col("enum_set_string"), F.lit(False)) if "enum_set_string" in events.columns else F.lit(False)).alias("labels_as_text"))
    # A schema that is sent again changes nothing, so a history is as long as the table's real changes. Repeats go within blocks of
    # responses first, so a table whose schema is sent with every transaction is no single task.
    v = v.where("fields is not null").withColumn("_block", F.floor(F.col("from_seq") / F.lit(2**24 * BLOCK)))
    for keys in ([*_TABLE, "_block"], _TABLE):
        order = Window.partitionBy(*keys).orderBy("from_seq")
        v = v.withColumn("_is", F.struct("fields", "labels_as_text")).withColumn("_before", F.lag("_is").over(order)).where(~F.col("_is").eqNullSafe(F.col("_before"))).drop("_before", "_is")
    v = v.drop("_block")
    return v.withColumn("to_seq", F.lead("from_seq").over(order))


def with_schema(changes: DataFrame, history: DataFrame, most: int = 200_000) -> DataFrame:
    """changes with the fields and labels_as_text of the latest version at or before each row; rows without one are left out.

    A row finds its version as in a tree: a table's versions, in order, form groups of 16, these form groups of 16 again, until every
    table has 16 entries at most. One join a level finds the entry whose range holds the row, so a row meets 16 entries a
    level, however long its table's history is. Levels of up to ``most`` entries are broadcast, so rows are not shuffled; longer ones are
    joined by shuffle, below the top by group, where a hot table is spread.
    """
    names = {k: f"_v_{k}" for k in _TABLE}
    v = history.select(*(F.col(k).alias(n) for k, n in names.items()), F.col("from_seq").alias("_v_from"), F.col("to_seq").alias("_v_to"), "fields", "labels_as_text", F.monotonically_increasing_id().alias("_v_id"))
    order = Window.partitionBy(*names.values()).orderBy("_v_from", F.col("_v_to").asc_nulls_last(), "_v_id")
    v = cut(v.withColumns({"_v_n": F.row_number().over(order).cast("bigint") - 1, "_v_t": F.first("_v_id").over(order)}).drop("_v_id"), "schemas")
    group = lambda up: F.shiftright(F.col("_v_n"), FANOUT_BITS * up)
    ends = v.groupBy("_v_t").agg(F.max("_v_n").alias("_v_n")).agg(F.max("_v_n").alias("last"), *(F.sum(group(up) + 1).alias(f"n{up}") for up in range(64 // FANOUT_BITS))).first()
    top = max((ends["last"] or 0).bit_length() - 1, 0) // FANOUT_BITS
    found = changes
    for up in range(top, -1, -1):
        keys = list(names.values()) if up == top else ["_v_p"]
        level = v.withColumns({"_v_g": group(up), "_v_p": group(up + 1)})
        if up:
            level = level.groupBy("_v_t", "_v_g", *keys).agg(F.min("_v_from").alias("_v_from"), F.when(F.count("_v_to") == F.count(F.lit(1)), F.max("_v_to")).alias("_v_to"))
        level = level.select(*keys, "_v_from", "_v_to", *(["_v_t", "_v_g"] if up else ["fields", "labels_as_text"]), *([F.col("_v_t").alias("_v_in")] if up < top else []))
        on = (F.col("seq") >= F.col("_v_from")) & (F.col("_v_to").isNull() | (F.col("seq") < F.col("_v_to")))
        if up == top:
            for k, n in names.items():
                on = on & F.col(k).eqNullSafe(F.col(n))
        else:
            found = found.withColumnsRenamed({"_v_t": "_v_of", "_v_g": "_v_at"})
            on = on & (F.col("_v_of") == F.col("_v_in")) & (F.col("_v_at") == F.col("_v_p"))
        found = found.join(F.broadcast(level) if (ends[f"n{up}"] or 0) <= most else level, on).drop(*keys, "_v_from", "_v_to", "_v_of", "_v_at", "_v_in")
    return found


def cells_by_name(cells: Column, fields: Column) -> Column:
    """map name -> raw cell; a row with another number of cells than its schema is an error."""
    ok = F.when(F.size(cells) == F.size(fields), cells).otherwise(F.raise_error(F.lit("row and schema differ in their number of columns")).cast("array<binary>"))
    return F.when(cells.isNotNull(), F.map_from_arrays(F.transform(fields, lambda f: f["name"]), ok))


def key_names(fields: Column) -> Column:
    """Names of the record key, as a column: primary key, else the first unique column, else empty."""
    flagged = lambda bit: F.transform(F.filter(fields, lambda f: F.coalesce(f["flags"], F.lit(0)).bitwiseAND(F.lit(bit)) != 0), lambda f: f["name"])
    return F.when(F.size(flagged(2)) > 0, flagged(2)).otherwise(F.slice(flagged(UNIQUE), 1, 1))
