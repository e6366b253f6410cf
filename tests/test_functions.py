"""Golden values of the scalar functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from shardlog.functions import ddl, decode, position
from shardlog.functions.types import ColumnType, SchemaError, check_names, declared_as, key_columns, kind_of, options_of


def one(spark, *columns):
    return spark.range(1).select(*columns).collect()[0]


def val(spark, text, kind, options=None, raw=None, **more):
    cell = F.lit(raw) if raw is not None else F.lit(text).cast("string").cast("binary")
    return one(spark, decode.value(cell, ColumnType(kind, **more), options).alias("v")).v


@pytest.mark.parametrize(
    ("wire", "declared", "kind"),
    [("INT8", "tinyint", "int16"), ("UINT8", "tinyint unsigned", "int16"), ("UINT16", None, "int32"), ("INT24", None, "int32"), ("UINT32", None, "int64"), ("UINT64", None, "uint64"), ("DECIMAL", "decimal(10,4)", "string"), ("VARBINARY", "varchar(32)", "string"), ("VARBINARY", "varbinary(32)", "binary"), ("BINARY", "char(2)", "string"), ("BINARY", "binary(2)", "binary"), ("BLOB", "mediumtext", "string"), ("BLOB", "blob", "binary"), ("ENUM", "enum('a')", "enum"), ("SET", "set('a')", "set"), ("BINARY", "enum('a')", "string"), ("GEOMETRY", "point", "unknown"), ("YEAR", "year", "int32"), ("JSON", "json", "string")],
)
def test_kinds(wire, declared, kind):
    assert kind_of(wire, declared).kind == kind


def test_field_metadata():
    assert kind_of("ENUM", "enum('a')", labels_as_text=True).kind == "string"
    assert kind_of("TIME", "time(4)").length == 4 and kind_of("BIT", "bit(8)").length == 8 and kind_of("BIT", "bit(1)").length == 1
    assert not kind_of("INT8", "tinyint", 1).optional
    assert options_of("enum('a','it''s','c,d')") == ("a", "it's", "c,d")
    assert declared_as("VARCHAR(3)", "VARCHAR") and not declared_as("VARCHARX", "VARCHAR")
    f = lambda name, flags: {"name": name, "flags": flags}
    assert key_columns([f("a", 3), f("b", 2), f("c", 4)]) == ["a", "b"]
    assert key_columns([f("a", 0), f("b", 4), f("c", 4)]) == ["b"] and key_columns([f("a", 0)]) == []
    for bad in ("", "@x"):
        with pytest.raises(SchemaError):
            check_names([bad])


def test_numbers(spark):
    assert val(spark, "12", "int16") == 12 and val(spark, "1.5", "float") == 1.5 and val(spark, "12.3400", "string") == "12.3400"
    assert val(spark, None, "int32") is None
    top = "18446744073709551615"
    assert val(spark, top, "uint64") == top
    assert int(val(spark, top, "uint64", decode.DecodeOptions(uint64="precise"))) == int(top)
    assert val(spark, top, "uint64", decode.DecodeOptions(uint64="long")) == -1
    assert int(val(spark, "-1", "uint64", decode.DecodeOptions(uint64="precise"))) == int(top)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        val(spark, "x", "int32")


def test_enum_and_set(spark):
    options = ("2", "0", "1")
    assert [one(spark, decode.enum_value(F.lit(x), options).alias("v")).v for x in ("1", "3", "0", "4", "small")] == ["2", "1", "", "", "small"]
    assert [one(spark, decode.set_labels(F.lit(m).cast("bigint"), ("a", "b")).alias("v")).v for m in (0, 1, 3, 5)] == ["", "a", "a,b", "a,"]
    assert one(spark, decode.set_labels(F.lit(None).cast("bigint"), ("a",)).alias("v")).v is None


@pytest.mark.parametrize(("text", "micros"), [("01:02:03", 3723000000), ("01:02:03.1", 3723100000), ("01:02:03.123456", 3723123456), ("-00:30:00", -1800000000), ("100:00", 360000000000), ("-838:59:59", -3020399000000)])
def test_time(spark, text, micros):
    assert val(spark, text, "time") == micros


def test_dates(spark):
    assert val(spark, "2020-02-13", "date") == datetime.date(2020, 2, 13)
    assert val(spark, "0000-00-00", "date") is None and val(spark, "2020-00-10", "date") is None
    assert val(spark, "0000-00-00", "date", optional=False) == datetime.date(1970, 1, 1)
    assert val(spark, "0000-00-00", "date", decode.DecodeOptions(override_datetime_to_nullable=True), optional=False) is None
    assert val(spark, "2020-02-13 01:02:03.123456", "datetime", length=6) == 1581555723123456
    assert val(spark, "2020-02-13 01:02:03.12", "datetime", length=2) == 1581555723120
    assert val(spark, "0000-00-00 00:00:00", "datetime", length=0, optional=False) == 0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        val(spark, "2020-00-10 00:00:00", "datetime", length=0)
    assert val(spark, "2020-02-13 01:02:03", "datetime", decode.DecodeOptions(time_precision="isostring"), length=0) == "2020-02-13 01:02:03"


def test_timestamps(spark):
    assert val(spark, "2020-02-13 01:02:03", "timestamp", length=0) == "2020-02-13T01:02:03Z"
    assert val(spark, "2020-02-13 01:02:03.123", "timestamp", length=3) == "2020-02-13T01:02:03.123Z"
    assert val(spark, "1970-01-01 00:00:01", "timestamp", length=6) == "1970-01-01T00:00:01.000000Z"
    assert val(spark, "0000-00-00 00:00:00", "timestamp", length=6, optional=False) == "1970-01-01T00:00:00Z"
    assert val(spark, "2020-00-10 00:00:00", "timestamp", length=0) is None
    assert val(spark, "2020-02-13 01:02:03.123456", "timestamp", decode.DecodeOptions(time_precision="connect"), length=6) == 1581555723123


def test_bytes(spark):
    assert val(spark, None, "bit", raw=bytearray(b"\x01"), length=1) is True and val(spark, None, "bit", raw=bytearray(b""), length=1) is False
    assert val(spark, None, "bit", raw=bytearray(b"\x05"), length=8) == b"\x05"
    assert val(spark, "d\0", "binary", decode.DecodeOptions(binary="hex")) == "6400" and val(spark, "ef", "binary", decode.DecodeOptions(binary="base64")) == "ZWY="
    assert "\n" not in val(spark, "x" * 300, "binary", decode.DecodeOptions(binary="base64"))
    assert decode.value(F.lit(b"x"), ColumnType("unknown")) is None
    assert val(spark, "x", "unknown", decode.DecodeOptions(include_unknown=True)) == b"x"


def test_unpack(spark):
    row = F.struct(F.array(*(F.lit(n).cast("bigint") for n in (1, -1, 3, 0))).alias("lengths"), F.lit(b"abcd").alias("values"))
    assert one(spark, decode.unpack(row).alias("v")).v == [b"a", None, b"bcd", b""]
    assert list(one(spark, *(c.alias(f"c{i}") for i, c in enumerate(decode.cells(row, 4))))) == [b"a", None, b"bcd", b""]
    with pytest.raises(Exception, match="number of columns"):
        one(spark, decode.cells(row, 3)[0].alias("v"))
    bad = F.struct(F.array(F.lit(9).cast("bigint")).alias("lengths"), F.lit(b"abcd").alias("values"))
    with pytest.raises(Exception, match="lengths of a row"):
        one(spark, decode.cells(bad, 1)[0].alias("v"))
    with pytest.raises(Exception, match="lengths of a row"):
        one(spark, decode.unpack(bad).alias("v"))


def test_gtid(spark):
    g = F.lit("MySQL56/host1:1-4,host2:2-10")
    r = one(spark, position.gtid_version(g).alias("v"), position.gtid_hosts(g).alias("h"), position.gtid_sequences(g).alias("s"), position.gtid_rank(g).alias("r"))
    assert (r.v, r.h, r.s, int(r.r)) == ("MySQL56", ["host1", "host2"], ["4", "10"], 14)
    assert one(spark, position.gtid_sequences(F.lit("MySQL56/h:1-5:7-9")).alias("s")).s == ["5"]
    for bad in ("MySQL56/", "MySQL56", "", "MariaDB/0-54610504-45"):
        with pytest.raises(Exception, match="not a GTID"):
            one(spark, position.gtid_hosts(F.lit(bad)).alias("h"))


@pytest.mark.parametrize(("old", "new", "step"), [("v/a:1,b:1", "v/a:2,b:2", 0), ("v/a:1,b:1", "v/a:2", 1), ("v/a:1", "v/b:1", 1), ("v/a:1", "w/a:1,b:1", 0), ("", "v/a:1", 1), ("current", "", 0)])
def test_epoch_step(spark, old, new, step):
    from shardlog.operators.ordering import EpochFold

    assert one(spark, position.epoch_step(F.lit(old), F.lit(new)).alias("v")).v == step == EpochFold.step(old, new)


def test_epoch_never_back(spark):
    for new in ("current", ""):
        with pytest.raises(Exception, match="override"):
            one(spark, position.epoch_step(F.lit("v/a:1"), F.lit(new)).alias("v"))


@pytest.mark.parametrize(("shard", "epochs", "want"), [("-80", {"0": 3}, 4), ("80-", {"-80": 3}, 0), ("-80", {"-40": 1, "40-80": 5, "80-": 9}, 6), ("-", {"-80": 2, "80-": 1}, 3), ("40-C0", {"-80": 1, "80-": 2}, 3)])
def test_inherited_epoch(spark, shard, epochs, want):
    from shardlog.operators.ordering import EpochFold

    m = F.create_map(*(F.lit(x) for kv in epochs.items() for x in kv)).cast("map<string,bigint>")
    assert one(spark, position.inherited_epoch(F.lit(shard), m).alias("v")).v == want == EpochFold.inherited(shard, epochs)


def test_shard_bounds_out_of_order(spark):
    with pytest.raises(Exception, match="out of order"):
        one(spark, position.ranges_overlap(F.lit("80-30"), F.lit("-")).alias("v"))


def test_vgtid(spark):
    text = '[{"keyspace":"ks","shard":"-80","gtid":"g1","table_p_ks":[]},{"keyspace":"ks","shard":"80-","gtid":"g2","table_p_ks":[{"table_name":"t","lastpk":null}]}]'
    v = position.parse_vgtid(F.lit(text))
    r = one(spark, position.vgtid_json(v).alias("same"), position.vgtid_json(position.local_vgtid(v, F.lit("-80"))).alias("local"), position.shard_gtid(v, F.lit("x")).alias("none"), position.in_copy(v).alias("copy"))
    assert r.same == text and r.local == '[{"keyspace":"ks","shard":"-80","gtid":"g1","table_p_ks":[]}]' and r.none is None and r.copy
    bare = '[{"keyspace":"ks","shard":"0","gtid":"g"}]'
    r = one(spark, position.vgtid_json(position.parse_vgtid(F.lit(bare))).alias("v"), position.in_copy(position.parse_vgtid(F.lit(bare))).alias("c"), position.is_single_shard(position.parse_vgtid(F.lit(bare))).alias("s"))
    assert (r.v, r.c, r.s) == (bare, False, True)
    empty = one(spark, position.vgtid_json(position.make_vgtid(F.lit("ks"), F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("v")).v
    assert empty == '[{"keyspace":"ks","shard":"","gtid":"current","table_p_ks":[]}]'
    assert one(spark, position.epoch_map_json(position.bump_epochs(position.parse_epoch_map(F.lit('{"80-":3,"-80":2}')))).alias("v")).v == '{"-80":3,"80-":4}'


@pytest.mark.parametrize(
    ("statement", "kind", "table"),
    [("ALTER TABLE t ADD COLUMN bar", "ALTER", "t"), ("CREATE    TABLE t", "CREATE", "t"), ("rename /* x */ table `ks`.`t` to `ks`.`_t_del`, `ks`.`_g` to `ks`.`t`", "ALTER", "t"), ("create \n # x \n table `ks`.`t`;", "CREATE", "t"), ("drop table t -- y", "DROP", "t"), ("TRUNCATE TABLE t", "TRUNCATE", "t"), ("UNPARSEABLE command to a table", "ALTER", "<UNKNOWN>")],
)
def test_ddl(spark, statement, kind, table):
    r = one(spark, ddl.change_type(F.lit(statement)).alias("k"), ddl.quoted_id(F.lit("0"), F.lit("ks"), ddl.table_of(F.lit(statement))).alias("t"))
    assert (r.k, r.t) == (kind, f'"0"."ks"."{table}"')


def test_cursor(spark):
    import base64

    cursor = [{"keyspace": "ks", "shard": "0", "gtid": "g", "table_p_ks": [{"table_name": "t", "lastpk": {"fields": [{"name": "id", "type": "INT64", "charset": 63, "flags": 1}], "rows": [{"lengths": ["2", "-1", "1"], "values": base64.b64encode(b"15x").decode()}]}}]}]
    import json

    v = position.parse_vgtid(F.lit(json.dumps(cursor, separators=(",", ":"))))
    r = one(spark, position.cursor_cells(v, F.lit("0"), F.lit("t")).alias("c"), position.cursor_cells(v, F.lit("0"), F.lit("u")).alias("n"), position.vgtid_json(v).alias("same"))
    assert r.c == ["15", None, "x"] and r.n is None and json.loads(r.same) == cursor


def test_start_epochs():
    assert position.start_epochs({"0": 2}, 1, 2) == {"0": 3} and position.start_epochs({"0": 2}, 2, 2) == {"0": 2} and position.start_epochs({"0": 2}, None, 2) == {"0": 2}
