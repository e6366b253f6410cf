"""Canonical schemas of the change log, and what field metadata says about a column's type and key."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import types as T

FIELD = T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType()), T.StructField("column_type", T.StringType()), T.StructField("flags", T.IntegerType()), T.StructField("decimals", T.IntegerType()), T.StructField("column_length", T.IntegerType())])
ROW = T.StructType([T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("values", T.BinaryType())])
ROW_CHANGE = T.StructType([T.StructField("before", ROW), T.StructField("after", ROW)])

#: One row per event of the log; (stream, response_no, event_no) is its place.
EVENTS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("response_no", T.LongType()),
        T.StructField("event_no", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("ts_sec", T.LongType()),
        T.StructField("keyspace", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("statement", T.StringType()),
        T.StructField("vgtid", T.StringType()),
        T.StructField("fields", T.ArrayType(FIELD)),
        T.StructField("enum_set_string", T.BooleanType()),
        T.StructField("row_changes", T.ArrayType(ROW_CHANGE)),
    ]
)

_PK_FIELD = T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType()), T.StructField("charset", T.IntegerType()), T.StructField("flags", T.IntegerType())])
_PK_ROW = T.StructType([T.StructField("lengths", T.ArrayType(T.StringType())), T.StructField("values", T.StringType())])
TABLE_PK = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("lastpk", T.StructType([T.StructField("fields", T.ArrayType(_PK_FIELD)), T.StructField("rows", T.ArrayType(_PK_ROW))]))])
SHARD_POSITION = T.StructType([T.StructField("keyspace", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("gtid", T.StringType()), T.StructField("table_p_ks", T.ArrayType(TABLE_PK))])
VGTID = T.ArrayType(SHARD_POSITION)

NOT_NULL, PRIMARY, UNIQUE = 1, 2, 4  # bits of a field's flags


class SchemaError(ValueError):
    """Field metadata that no table can be built from."""


#: Wire type -> the kind that decoding works with. VARBINARY, BINARY and BLOB depend on the declared type, ENUM and SET
#: on how the stream writes them; see ``kind_of``.
KINDS = {
    "INT8": "int16", "UINT8": "int16", "INT16": "int16",
    "UINT16": "int32", "INT24": "int32", "UINT24": "int32", "INT32": "int32", "YEAR": "int32",
    "UINT32": "int64", "INT64": "int64",
    "FLOAT32": "float", "FLOAT64": "double",
    "UINT64": "uint64", "DECIMAL": "string", "JSON": "string", "CHAR": "string", "VARCHAR": "string", "TEXT": "string",
    "TIME": "time", "DATE": "date", "DATETIME": "datetime", "TIMESTAMP": "timestamp", "BIT": "bit",
}


@dataclass(frozen=True)
class ColumnType:
    """kind: how raw bytes are read; scale: fraction digits or bit length; options: ENUM or SET labels."""

    kind: str
    optional: bool = True
    length: int | None = None
    options: tuple[str, ...] = ()


def declared_as(column_type: str | None, name: str) -> bool:
    """Whether a declared type is ``name``, alone or with arguments."""
    c = (column_type or "").upper()
    return c == name or c.startswith(f"{name}(")


def options_of(column_type: str) -> tuple[str, ...]:
    """Labels of an ENUM or SET declaration; a doubled quote stands for one."""
    inner = column_type[column_type.find("(") + 1 : column_type.rfind(")")]
    return tuple(x.replace("''", "'") for x in re.findall(r"'((?:[^']|'')*)'", inner))


def kind_of(wire: str, column_type: str | None = None, flags: int = 0, column_length: int | None = None, labels_as_text: bool = False) -> ColumnType:
    """The column type of a field. labels_as_text: ENUM and SET arrive as labels (copy phase, or the stream says so)."""
    declared = (column_type or "").lower()
    base = ColumnType("unknown", not flags & NOT_NULL)
    if wire in ("ENUM", "SET") or wire in ("BINARY", "VARBINARY") and (declared.startswith("enum") or declared.startswith("set")):
        what = wire.lower() if wire in ("ENUM", "SET") else declared[: 4 if declared.startswith("enum") else 3]
        return replace(base, kind="string" if labels_as_text or wire not in ("ENUM", "SET") else what, options=options_of(column_type or ""))
    if wire in ("BINARY", "VARBINARY"):
        return replace(base, kind="string" if declared_as(column_type, "VARCHAR") or declared_as(column_type, "CHAR") else "binary")
    if wire == "BLOB":
        return replace(base, kind="string" if declared.split("(")[0].endswith("text") else "binary")
    kind = KINDS.get(wire, "unknown")
    length = None
    if kind in ("time", "datetime", "timestamp"):
        m = re.search(r"\((\d+)\)", declared)
        length = int(m[1]) if m else 0
    elif kind == "bit":
        m = re.search(r"\((\d+)\)", declared)
        length = int(m[1]) if m else (column_length or 1)
    return replace(base, kind=kind, length=length)


def check_names(names: list[str]) -> None:
    """A column without a name, or one that starts with @, is an error."""
    for n in names:
        if not n or n.startswith("@"):
            raise SchemaError(f"illegal column name {n!r}")


def key_columns(fields: list) -> list[str]:
    """Names of the record key: all primary-key columns, else the first column that is unique by itself, else none.

    Only unique columns outside a composite key carry the unique bit, so the first such field is the first single-column unique key.
    """
    flagged = lambda bit: [f["name"] for f in fields if (f["flags"] or 0) & bit]
    return flagged(PRIMARY) or flagged(UNIQUE)[:1]
