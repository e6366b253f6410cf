"""What a DDL statement does, and to which table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "<UNKNOWN>"
_VERB_TABLE = r"(?i)\b(create|alter|truncate|drop|rename)\s+table\s+([\w`.]+)"


def without_comments(statement: Column) -> Column:
    """Block comments go first, then what follows -- or # in a line; white space becomes single spaces."""
    s = F.regexp_replace(statement, r"(?s)/\*.*?\*/", "")
    s = F.regexp_replace(s, r"(?:--|#)[^\n]*(?:\n|$)", "")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def change_type(statement: Column) -> Column:
    """CREATE, ALTER, TRUNCATE or DROP; renaming alters, and so does what can't be read."""
    verb = F.upper(F.regexp_extract(without_comments(statement), _VERB_TABLE, 1))
    return F.when(verb.isin("", "RENAME"), F.lit("ALTER")).otherwise(verb)


def table_of(statement: Column) -> Column:
    """The first table named: of a qualified name the part after the first dot; no backquotes."""
    name = F.regexp_extract(without_comments(statement), _VERB_TABLE, 2)
    bare = F.replace(F.when(F.contains(name, F.lit(".")), F.split_part(name, F.lit("."), F.lit(2))).otherwise(name), F.lit("`"), F.lit(""))
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit(UNKNOWN))


def quoted_id(shard: Column, keyspace: Column, table: Column) -> Column:
    part = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.concat_ws(".", part(shard), part(keyspace), part(table))
