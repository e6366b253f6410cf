"""Record transforms, and chains of them. All pass null values through."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.position import local_vgtid, parse_vgtid, vgtid_json

Transform = Callable[[DataFrame], DataFrame]


def check_paths(paths: str) -> list[str]:
    """Comma-separated dotted paths; empty ones and leading or trailing dots are errors."""
    out = [p.strip() for p in paths.split(",")]
    for p in out:
        if not p or p.startswith(".") or p.endswith("."):
            raise ValueError(f"not a field path: {p!r}")
    return out


def _type_at(schema: T.DataType, path: list[str]) -> T.DataType | None:
    for name in path:
        if not isinstance(schema, T.StructType) or name not in schema.fieldNames():
            return None
        schema = schema[name].dataType
    return schema


def remove_fields(column: str, paths: str) -> Transform:
    """Drops leaf fields of a struct column; a path to a struct, or to nothing, changes nothing."""
    wanted = check_paths(paths)

    def run(df: DataFrame) -> DataFrame:
        schema = df.schema[column].dataType
        for p in wanted:
            kind = _type_at(schema, p.split("."))
            if kind is not None and not isinstance(kind, T.StructType):
                df = df.withColumn(column, F.col(column).dropFields(".".join(f"`{x}`" for x in p.split("."))))
        return df

    return run


def replace_values(column: str, paths: str, new: str = "") -> Transform:
    """Sets fields of a struct column to a constant text; missing ones are left alone, null structs stay null."""
    wanted = check_paths(paths)

    def rebuild(c: Column, schema: T.StructType, path: list[str]) -> Column:
        inner = F.lit(new) if len(path) == 1 else rebuild(c[path[0]], schema[path[0]].dataType, path[1:])
        fields = [(inner if f.name == path[0] else c[f.name]).alias(f.name) for f in schema.fields]
        return F.when(c.isNotNull(), F.struct(*fields))

    def run(df: DataFrame) -> DataFrame:
        for p in wanted:
            schema = df.schema[column].dataType
            if _type_at(schema, p.split(".")) is not None:
                df = df.withColumn(column, rebuild(F.col(column), schema, p.split(".")))
        return df

    return run


def use_local_vgtid(column: str = "record") -> Transform:
    """source.vgtid becomes the position of the record's own shard alone; a column named vgtid elsewhere is untouched."""

    def run(df: DataFrame) -> DataFrame:
        schema = df.schema[column].dataType
        if _type_at(schema, ["source", "vgtid"]) is None or _type_at(schema, ["source", "shard"]) is None:
            return df
        src = F.col(column)["source"]
        local = vgtid_json(local_vgtid(parse_vgtid(src["vgtid"]), src["shard"]))
        return df.withColumn(column, F.when(F.col(column).isNotNull() & src.isNotNull(), F.col(column).withField("source", src.withField("vgtid", local))).otherwise(F.col(column)))

    return run


def filter_transactions() -> Transform:
    from .filters import without_transaction_records

    return without_transaction_records


#: Names under which transforms can be put into a chain.
REGISTRY: dict[str, Callable[..., Transform]] = {"remove_fields": remove_fields, "replace_values": replace_values, "use_local_vgtid": use_local_vgtid, "filter_transactions": filter_transactions}


def chain(steps: list[tuple[str, dict]]) -> Transform:
    """The named transforms, in order."""
    made = [REGISTRY[name](**options) for name, options in steps]
    return lambda df: reduce(lambda d, f: d.transform(f), made, df)
