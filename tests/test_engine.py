"""Operators, planning and streaming."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlog.functions.types import EVENTS
from shardlog.operators import envelope, filters, ordering, routing, schema_history, transactions, transforms
from shardlog.operators.transactions import Assembler
from shardlog.plans import pipeline, planner
from shardlog.plans.config import Config, ConfigError
from shardlog.sources import metadata, replay, snapshot
from shardlog.streaming import processors


def vgtid(n, shards=("0",)):
    return json.dumps([{"keyspace": "ks", "shard": s, "gtid": f"v/h:1-{n}", "table_p_ks": []} for s in shards], separators=(",", ":"))


def pack(*cells):
    raw = [None if c is None else str(c).encode() for c in cells]
    return {"lengths": [-1 if r is None else len(r) for r in raw], "values": b"".join(r or b"" for r in raw)}


FIELDS = [{"name": "id", "type": "INT64", "column_type": "bigint", "flags": 3, "decimals": 0, "column_length": 20}, {"name": "s", "type": "VARCHAR", "column_type": "varchar(9)", "flags": 0, "decimals": 0, "column_length": 9}]


def events(*responses, stream="s0"):
    """Each response is a list of (type, more)."""
    rows = []
    for r, response in enumerate(responses):
        for i, (kind, more) in enumerate(response):
            rows.append({"stream": stream, "response_no": r, "event_no": i, "type": kind, "ts_sec": 1000 + r, "keyspace": "ks", "shard": "0", "table": "ks.t" if kind in ("ROW", "FIELD") else None, "statement": None, "vgtid": None, "fields": None, "enum_set_string": None, "row_changes": None} | more)
    return rows


B, C, H = ("BEGIN", {}), ("COMMIT", {}), ("HEARTBEAT", {})
V = lambda n: ("VGTID", {"vgtid": vgtid(n)})
FLD = ("FIELD", {"fields": FIELDS})
ROW = lambda before, after: ("ROW", {"row_changes": [{"before": before, "after": after}]})


def feed(rows, **more):
    return list(Assembler(**more).responses(iter(rows)))


def test_assembler_units():
    out = feed(events([B, FLD, ROW(None, pack(1, "a")), V(1), V(2), C]))
    assert len(out[0]) == 6 and {e["txn_vgtid"] for e in out[0]} == {vgtid(2)} and {e["commit_ts"] for e in out[0]} == {1000}
    several = feed(events([B, ROW(None, pack(1, "a"))], [V(1)], [C]))
    assert [len(u) for u in several] == [0, 0, 4]
    assert [len(u) for u in feed(events([B, C], [H], [("DDL", {"statement": "x"}), V(3)], [("OTHER", {}), V(4)]))] == [0, 1, 2, 2]
    assert feed(events([B, V(1), C], [("COPY_COMPLETED", {}), B, V(2), C]), copying=True)[1][0]["in_copy"] is False


@pytest.mark.parametrize("before", [[B, FLD], [B, FLD, V(1)], [("COPY_COMPLETED", {}), B, FLD], [("COPY_COMPLETED", {}), B, FLD, V(1)]])
def test_assembler_restarts(before):
    out = feed(events(before, [B, V(2), C]))
    assert [e["type"] for e in out[-1]] == ["BEGIN", "VGTID", "COMMIT"]


@pytest.mark.parametrize("bad", [[[C]], [[B, ROW(None, pack(1, "a")), B]], [[B, C, B]], [[B, C, C]], [[B, ROW(None, pack(1, "a")), V(1)], [H], [C]]])
def test_assembler_errors(bad):
    out = feed(events(*bad, [B, V(9), C]))
    assert out[-1][0]["type"] == "ERROR" and sum(bool(u) and u[0]["type"] == "ERROR" for u in out) == 1


def random_log(seed, n=60, streams=3):
    rng, rows = random.Random(seed), []
    for s in range(streams):
        responses, held = [], []
        for t in range(n):
            unit = [B, *([FLD] if t == 0 or rng.random() < 0.1 else []), *(ROW(None, pack(t, "x")) for _ in range(rng.randrange(4))), V(t), C]
            if rng.random() < 0.2:
                unit = [H] if rng.random() < 0.5 else [("DDL", {"statement": "alter table t add c int"}), V(t)]
                if held:
                    responses.append(held)
                    held = []
            for e in unit:
                held.append(e)
                if unit[0][0] != "DDL" and rng.random() < 0.3 or e[0] in ("COMMIT", "HEARTBEAT") or unit[0][0] == "DDL" and e[0] == "VGTID":
                    responses.append(held)
                    held = []
        rows += events(*responses, stream=f"s{s}")
    return rows


def plain(df):
    return sorted((r.stream, r.response_no, r.event_no, r.txn_vgtid, r.commit_ts) for r in df.collect())


def test_batch_strict_and_stream_agree(spark, tmp_path):
    rows = random_log(7)
    log = spark.createDataFrame([tuple(r[f.name] for f in EVENTS.fields) for r in rows], EVENTS)
    strict = transactions.assemble_strict(log)
    group = lambda df: sorted(map(sorted, _units(df).values()))

    def _units(df):
        out = {}
        for r in df.where("type not in ('VGTID')").collect():
            out.setdefault((r.stream, r.txn_no), []).append((r.stream, r.response_no, r.event_no))
        return out

    assert plain(transactions.assemble(log)) == plain(strict) and group(transactions.assemble(log)) == group(strict)
    spark.conf.set(*processors.STATE_STORE)
    replay.write_replay(rows, str(tmp_path / "log"))
    replay.register(spark)
    source = spark.readStream.format("shardlog_replay").option("path", str(tmp_path / "log")).option("responsesPerBatch", 25).load()
    q = processors.assemble_stream(source).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).start()
    try:
        for _ in range(60):
            q.processAllAvailable()
            got = spark.read.parquet(str(tmp_path / "out")) if (tmp_path / "out").exists() else None
            if got is not None and got.count() == strict.count():
                break
        assert plain(got) == plain(strict)
        unfolded = processors.unfold(got)
        assert unfolded.where("row_changes is not null").count() == strict.where("type = 'ROW'").count()
    finally:
        q.stop()


def unsteady_stream(rng, stream):
    """Responses with what the protocol tolerates, and now and then what it does not."""
    responses, n = [], 0
    for _ in range(rng.randrange(3, 25)):
        n += 1
        kind = rng.random()
        if kind < 0.15:
            responses += [[H]] * rng.randrange(1, 3)
        elif kind < 0.25:
            responses.append([("DDL", {"statement": "x"}), *([V(n)] if rng.random() < 0.8 else [])])
        else:
            start = [[("COPY_COMPLETED", {})], []][rng.random() < 0.9]
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):  # tolerated restarts
                start = [*start, B, FLD, *([V(n)] if rng.random() < 0.5 else [])]
                if rng.random() < 0.7:
                    responses.append(start)
                    start = []
            unit = [*start, B, *(ROW(None, pack(n, "x")) for _ in range(rng.randrange(3))), *([V(n)] if rng.random() < 0.9 else []), C]
            if rng.random() < 0.03:
                unit.insert(rng.randrange(len(unit) + 1), rng.choice([B, C, H, FLD]))
            while unit:
                k = rng.randrange(1, len(unit) + 1)
                responses.append(unit[:k])
                unit = unit[k:]
    return events(*responses, stream=stream)


def test_assembly_of_unsteady_logs(spark):
    """assemble, assemble_strict and the plain state machine, stream by stream, on 200 random streams."""
    rng, rows, expected, restarts, errors = random.Random(11), [], set(), 0, 0
    for s in range(200):
        mine = unsteady_stream(rng, f"s{s}")
        rows += mine
        for unit in Assembler().responses(iter([dict(e) for e in mine])):
            expected |= {(e["stream"], e["response_no"], e["event_no"], e["type"], e["txn_no"], e["txn_vgtid"], e["commit_ts"]) for e in unit}
            errors += bool(unit) and unit[0]["type"] == "ERROR"
            restarts += bool(unit) and unit[-1]["type"] == "COMMIT" and unit[0]["type"] == "BEGIN"
    assert errors > 20 and restarts > 100
    log = spark.createDataFrame([tuple(r[f.name] for f in EVENTS.fields) for r in rows], EVENTS).repartition(5)
    for made in (transactions.assemble(log), transactions.assemble_strict(log)):
        got = [(r.stream, r.response_no, r.event_no, r.type, r.txn_no, r.txn_vgtid, r.commit_ts) for r in made.collect()]
        assert len(got) == len(set(got)) and set(got) == expected
    last, want = {}, []
    for s, n, v in sorted({(e[0], e[4], e[5]) for e in expected if e[3] != "ERROR"}):
        want.append((s, n, v or last.get(s), last.get(s)))
        last[s] = v or last.get(s)
    assert sorted(map(repr, map(tuple, transactions.offsets(transactions.assemble(log)).collect()))) == sorted(map(repr, want))


def test_typed_records(spark):
    wide = [*FIELDS, {"name": "e", "type": "ENUM", "column_type": "enum('x','y')", "flags": 0, "decimals": 0, "column_length": 0}, {"name": "o", "type": "POINT", "column_type": "point", "flags": 0, "decimals": 0, "column_length": 0}]
    rows = events([B, FLD, ROW(None, pack(1, "a")), V(1), C], [B, ("FIELD", {"fields": wide}), ROW(pack(1, "a", "1", "p"), pack(2, None, "2", "q")), V(2), C], [B, ROW(pack(2, None, "2", "q"), None), V(3), C])
    log = spark.createDataFrame([tuple(r[f.name] for f in EVENTS.fields) for r in rows], EVENTS)
    base = {"server": "srv", "keyspace": "ks", "snapshot_mode": "never", "topic_prefix": "p"}
    config = Config(**base)
    got = pipeline.typed(pipeline.build(log, config), config, "ks", "t").orderBy("seq", "part").collect()
    images = [(r.record.op, r.record.before and r.record.before.asDict(), r.record.after and r.record.after.asDict(), r.key.id) for r in got]
    assert images == [("c", None, {"id": 1, "s": "a", "e": None}, 1), ("d", {"id": 1, "s": "a", "e": "x"}, None, 1), ("d", {"id": 1, "s": "a", "e": "x"}, None, 1), ("c", None, {"id": 2, "s": None, "e": "y"}, 2), ("d", {"id": 2, "s": None, "e": "y"}, None, 2), ("d", {"id": 2, "s": None, "e": "y"}, None, 2)]
    config = Config(**base, include_unknown_datatypes=True, column_include="ks.t.(id|o|e)", tombstones_on_delete=False, converters={"ENUM": lambda cell, kind: F.lower(F.hex(cell))}, source_maker=lambda server: F.struct(F.lit(server).alias("who")), topic_naming=lambda keyspace, table: F.concat(F.lit("to-"), table))
    out = pipeline.build(log, config)
    got = pipeline.typed(out, config, "ks", "t").where("record.after is not null").orderBy("seq").collect()
    assert [r.record.after.asDict() for r in got] == [{"id": 1, "e": None, "o": None}, {"id": 2, "e": "32", "o": bytearray(b"q")}] and got[0].record.source.who == "srv" and got[0].topic == "to-t"
    assert {tuple(sorted(r.record.after)) for r in out.data.where("record.after is not null").collect()} == {("id",), ("e", "id", "o")}
    assert pipeline.typed(out, config, "ks", "none").count() == 0
    copied = events([B, ("FIELD", {"fields": wide[:3]}), ROW(None, pack(1, "a", "1")), V(1), C], [("COPY_COMPLETED", {}), B, ROW(None, pack(2, "a", "1")), V(2), C])
    config = Config(**base | {"snapshot_mode": "initial"})
    for strict in (False, True):
        out = pipeline.build(spark.createDataFrame([tuple(r[f.name] for f in EVENTS.fields) for r in copied], EVENTS), config, strict)
        got = [(r.record.after.e, r.record.source.snapshot, r.record.source.ts_ms) for r in pipeline.typed(out, config, "ks", "t").orderBy("seq").collect()]
        assert got == [("1", "true", 0), ("x", "false", 1001000)]
    none = Config(**base | {"snapshot_mode": "initial", "snapshot_tables": "ks.other"})
    assert pipeline.build(spark.createDataFrame([tuple(r[f.name] for f in EVENTS.fields) for r in copied], EVENTS), none).data.count() == 1


def test_changes_schemas_and_typing(spark):
    wide = [*FIELDS, {"name": "e", "type": "ENUM", "column_type": "enum('x','y')", "flags": 0, "decimals": 0, "column_length": 0}]
    rows = events([B, FLD, ROW(None, pack(1, "a")), V(1), C], [B, ("FIELD", {"fields": wide}), ROW(pack(1, "a", "1"), pack(2, None, "2")), V(2), C], [B, ROW(pack(2, None, "2"), None), V(3), C])
    log = spark.createDataFrame([tuple(r[f.name] for f in EVENTS.fields) for r in rows], EVENTS)
    changes = transactions.row_changes(transactions.assemble(log))
    history = schema_history.versions(log)
    for most in (0, 100):
        met = schema_history.with_schema(changes, history, most)
        assert sorted((r.txn_no, len(r.fields)) for r in met.collect()) == [(1, 2), (2, 3), (3, 3)]
    raw = envelope.raw_images(met)
    typed = raw.where("size(fields) = 3").select("op", "key", envelope.typed(F.col("after"), wide).alias("after"), envelope.typed(F.col("before"), wide).alias("before"))
    got = {r.op: r for r in typed.collect()}
    assert got["UPDATE"].after.asDict() == {"id": 2, "s": None, "e": "y"} and got["UPDATE"].key == {"id": bytearray(b"2")} and got["DELETE"].after is None
    bad = spark.createDataFrame([tuple(r[f.name] for f in EVENTS.fields) for r in events([B, FLD, ROW(None, pack(1)), V(1), C])], EVENTS)
    with pytest.raises(Exception, match="number of columns"):
        envelope.raw_images(schema_history.with_schema(transactions.row_changes(transactions.assemble(bad)), schema_history.versions(bad))).collect()


def test_long_schema_histories_are_searched(spark):
    """Rows meet a bounded number of versions, and the right one, however many their table has."""
    rng = random.Random(4)
    tables = {("s", "0", "k", "a"): 1, ("s", "0", "k", "b"): 16, ("s", None, "k", "b"): 17, (None, "1", "k", "b"): 257, ("s", "1", "k", "b"): 5000}
    history, changes, expected = [], [], []
    for key, n in tables.items():
        at = sorted(rng.sample(range(10, 20 * n + 10), n))
        history += [(*key, f, t, [{"name": f"v{f}"}], f % 2 == 0) for f, t in zip(at, [*at[1:], None], strict=True)]
        for seq in [0, at[0], at[-1], 10**12, *(rng.randrange(20 * n + 30) for _ in range(500))]:
            changes.append((*key, seq, len(changes)))
            if before := [f for f in at if f <= seq]:
                expected.append((changes[-1][-1], f"v{before[-1]}", before[-1] % 2 == 0))
    changes.append(("s", "2", "k", "b", 50, len(changes)))
    keys = "stream string, shard string, keyspace string, table string"
    h = spark.createDataFrame(history, f"{keys}, from_seq long, to_seq long, fields array<struct<name:string>>, labels_as_text boolean").repartition(5)
    c = spark.createDataFrame(changes, f"{keys}, seq long, id int")
    for most, kind in ((200_000, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        if not most:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        met = schema_history.with_schema(c, h, most)
        assert met.columns == [*c.columns, "fields", "labels_as_text"]
        assert len(re.findall(rf"\b{kind}\b", met._jdf.queryExecution().executedPlan().toString())) == 4  # of 16 entries each
        assert sorted((r.id, r.fields[0].name, r.labels_as_text) for r in met.collect()) == sorted(expected)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    short = schema_history.with_schema(c, h.where("table = 'a'"))
    assert short.count() == sum(1 for r in expected if r[0] < 504) and schema_history.with_schema(c, h.limit(0)).count() == 0


def test_pipeline(spark):
    rows = events([B, FLD, ROW(None, pack(1, "a")), V(1), C], [B, ROW(pack(1, "a"), pack(2, "a")), V(2), C], [B, ROW(pack(2, "a"), None), V(3), C], [("DDL", {"statement": "alter table t add x int"}), V(4)], [H])
    log = spark.createDataFrame([tuple(r[f.name] for f in EVENTS.fields) for r in rows], EVENTS)
    for strict in (False, True):
        config = Config(server="srv", keyspace="ks", snapshot_mode="never", topic_prefix="p", include_schema_changes=True, heartbeat_interval_ms=1, ordered_transactions=True)
        out = pipeline.build(log, config, strict)
        data = [(r.topic, r.op, r.tombstone, r.key[0].value) for r in out.data.orderBy("seq", "part").collect()]
        assert data == [("p.t", "INSERT", False, "1"), ("p.t", "DELETE", False, "1"), ("p.t", "DELETE", True, "1"), ("p.t", "INSERT", False, "2"), ("p.t", "DELETE", False, "2"), ("p.t", "DELETE", True, "2")]
        assert [(r.change_type, r.table_id) for r in out.schema_changes.collect()] == [("ALTER", '"0"."ks"."t"')]
        assert sorted((r.status, r.event_count or 0) for r in out.transactions.collect()) == [("BEGIN", 0)] * 3 + [("END", 1)] * 3
        assert out.heartbeats.count() == 4 and {r.restart_vgtid for r in out.offsets.collect()} == {None, vgtid(1), vgtid(2), vgtid(3), vgtid(4)}
    units = transactions.assemble(log)
    after = transactions.resume(units, spark.createDataFrame([("s0", vgtid(2))], "stream string, vgtid string"))
    assert {r.txn_no for r in after.collect()} == {3, 4, 5} and transactions.resume(units, spark.createDataFrame([], "stream string, vgtid string")).count() == units.count()
    none = pipeline.build(log, Config(server="srv", keyspace="ks", table_exclude="ks\\.t"))
    assert none.data.count() == 0 and none.schema_changes.count() == 0
    as_json = routing.to_json(out.data).collect()
    assert sum(r.value is None for r in as_json) == 2 and json.loads(as_json[0].key)


def test_filters(spark):
    names = spark.createDataFrame([("ks", t) for t in ("t1", "t22", "t2", "t3")] + [("mysql", "t1")], "keyspace string, table string")
    tables = lambda **k: sorted(r.table for r in filters.filter_tables(names, **k).collect())
    assert tables(include="ks.t1,ks.t2.*") == ["t1", "t2", "t22"] and tables(include="ks.t1,ks.t2") == ["t1", "t2"] and tables(exclude="ks.t3") == ["t1", "t2", "t22"]
    assert names.where(filters.snapshot_included(F.col("keyspace"), F.col("table"), "")).count() == 0
    e = spark.createDataFrame([("ROW", "t"), ("ROW", "ks.t"), ("BEGIN", None), ("VGTID", None), ("NEW", None)], "type string, table string")
    assert filters.well_named(e).count() == 4 and filters.well_named(e, True).count() == 5 and filters.meaningful(e).count() == 3


def test_transforms(spark):
    schema = "record struct<before:struct<id:string>,op:string,source:struct<db:string,shard:string,vgtid:string>,transaction:struct<id:string,total_order:bigint>>, record_kind string"
    df = spark.createDataFrame([((("foo",), "c", ("bar", "0", vgtid(1, ("0", "1"))), ("t", 2)), "data"), (None, "data"), (None, "transaction")], schema)
    gone = transforms.remove_fields("record", "transaction.id,before,op.x")(df)
    assert gone.schema["record"].dataType["transaction"].dataType.fieldNames() == ["total_order"] and "before" in gone.schema["record"].dataType.fieldNames()
    for bad in ("", ".a", "a.", "a,,b"):
        with pytest.raises(ValueError, match="not a field path"):
            transforms.remove_fields("record", bad)
    new = transforms.replace_values("record", "source.db,transaction.total_order,none.x")(df).collect()
    assert new[0].record.source.db == "" and new[0].record.transaction.total_order == "" and new[1].record is None
    local = transforms.use_local_vgtid()(df).collect()
    assert local[0].record.source.vgtid == vgtid(1, ("0",)) and local[1].record is None
    assert transforms.filter_transactions()(df).count() == 2
    assert transforms.use_local_vgtid("record")(df.select(F.struct(F.lit(1).alias("vgtid")).alias("record"))).collect()[0].record.vgtid == 1


def test_topics(spark):
    df = spark.createDataFrame([("ks", "t1"), ("ks", "t-é")], "keyspace string, table string")
    topics = lambda n: [r.topic for r in routing.route(df, n).collect()]
    assert topics(routing.TopicNaming("p")) == ["p.t1", "p.t-_"]
    assert topics(routing.TopicNaming("p", "o", "ks.t1")) == ["p.t1", "o.t-_"]
    assert routing.TopicNaming("p").schema_changes() == "p" and routing.TopicNaming("p", schema_topic="x").schema_changes() == "x"
    assert envelope.safe_name("-foo-") == "_foo_"


def positions(*vs):
    return [("s0", i, json.dumps([{"keyspace": "ks", "shard": s, "gtid": g} for s, g in v.items()])) for i, v in enumerate(vs, 1)]


def test_epochs(spark):
    t = spark.createDataFrame(positions({"-80": "", "80-": ""}, {"-80": "v/a:1", "80-": "v/a:1"}, {"-80": "v/a:2", "80-": "v/b:1"}, {"-80": "v/a:3"}, {"-80": "v/a:4", "80-": "v/b:1"}), "stream string, txn_no long, vgtid string")
    want = [(1, "-80", 0), (1, "80-", 0), (2, "-80", 1), (2, "80-", 1), (3, "-80", 1), (3, "80-", 2), (4, "-80", 1), (5, "-80", 1), (5, "80-", 0)]
    rows = lambda df: sorted((r.txn_no, r.shard, r.epoch) for r in df.collect())
    assert rows(ordering.epochs(t)) == want == rows(ordering.epochs_in_order(t, inherit=False))
    start = {"-80": ("v/z:1", 7), "80-": ("current", 4)}
    later = spark.createDataFrame(positions({"-80": "v/a:1", "80-": "v/a:1"}), "stream string, txn_no long, vgtid string")
    assert rows(ordering.epochs(later, start)) == [(1, "-80", 8), (1, "80-", 5)] == rows(ordering.epochs_in_order(later, start))
    split = spark.createDataFrame(positions({"0": "v/a:1"}, {"-80": "v/a:2", "80-": "v/a:2"}, {"-80": "v/a:3", "80-": "v/c:3"}), "stream string, txn_no long, vgtid string")
    assert rows(ordering.epochs_in_order(split, {"0": ("v/a:0", 3)})) == [(1, "0", 3), (2, "-80", 4), (2, "80-", 4), (3, "-80", 4), (3, "80-", 5)]
    ranked = ordering.with_rank(ordering.epochs(t)).where("txn_no < 3").collect()
    assert {(r.txn_no, r["rank"] and int(r["rank"])) for r in ranked} == {(1, None), (2, 1)}


def stored(tasks, gen, shards, epochs=False, server="server"):
    out = {}
    for i, mine in planner.assign(shards, tasks).items():
        value = {"vgtid": planner.GTID.write({s: f"g-{s}" for s in mine}, "ks")}
        if epochs:
            value["transaction_epoch"] = json.dumps(dict.fromkeys(mine, 2))
        out[(server, planner.task_key(i, tasks, gen))] = value
    return out


def config(tasks, gen, prev, **more):
    return Config(keyspace="ks", snapshot_mode="never", tasks=tasks, offset_storage_per_task=True, offset_storage_task_key_gen=gen, prev_num_tasks=prev, **more)


FOUR = ["s0", "s1", "s2", "s3"]


def test_plans():
    p = planner.plan(config(2, 0, 0), FOUR)
    assert [t.shards for t in p] == [("s0", "s2"), ("s1", "s3")] and all(g == "current" for t in p for g in t.gtids.values()) and p[0].key == "task0_2_0"
    p = planner.plan(config(4, 1, 2), FOUR, stored(2, 0, FOUR))
    assert len(p) == 4 and all(t.gtids == {s: f"g-{s}" for s in t.shards} for t in p)
    p = planner.plan(config(2, 1, 1), FOUR, stored(1, 0, ["s0", "s1"]))
    assert {s: g for t in p for s, g in t.gtids.items()} == {"s0": "g-s0", "s1": "g-s1", "s2": "current", "s3": "current"}
    p = planner.plan(config(2, 1, 4), ["s0", "s1", "s2", "s30", "s31"], stored(4, 0, FOUR))
    assert sorted(s for t in p for s in t.shards) == FOUR
    p = planner.plan(config(2, 0, 0), FOUR, {("server", None): {"vgtid": planner.GTID.write({s: "x" for s in FOUR}, "ks")}})
    assert {g for t in p for g in t.gtids.values()} == {"x"}
    both = stored(2, 1, FOUR) | {k: {"vgtid": v["vgtid"].replace("g-", "old-")} for k, v in stored(4, 0, FOUR).items()}
    assert {g for t in planner.plan(config(2, 1, 4), FOUR, both) for g in t.gtids.values()} == {f"g-{s}" for s in FOUR}
    part = {k: v for k, v in stored(2, 0, FOUR).items() if "task0" in k[1]}
    p = planner.plan(config(2, 0, 0), FOUR, part)
    assert [t.gtids for t in p] == [{"s0": "g-s0", "s2": "g-s2"}, {"s1": "current", "s3": "current"}]
    p = planner.plan(config(2, 1, 1), FOUR, stored(1, 0, ["s0", "s1"]) | {k: v for k, v in stored(2, 1, FOUR).items() if "task1" in k[1]})
    assert {s: g for t in p for s, g in t.gtids.items()} == {"s0": "g-s0", "s1": "g-s1", "s2": "current", "s3": "g-s3"}
    p = planner.plan(config(2, 0, 0), ["s0", "s1", "s2", "s30", "s31"], stored(2, 0, FOUR))
    assert sorted(s for t in p for s in t.shards) == FOUR
    p = planner.plan(config(4, 1, 2, ordered_transactions=True), FOUR, stored(2, 0, FOUR, True))
    assert all(set(t.epochs.values()) == {2} for t in p)


@pytest.mark.parametrize(
    ("cfg", "live", "store"),
    [
        (config(2, 1, 4), ["s0", "s1"], stored(4, 0, FOUR)),  # shards are gone
        (config(2, 1, 4), ["s0", "s1"], stored(4, 0, FOUR) | stored(2, 1, ["s0", "s1"])),  # gone, though this generation is stored
        (config(2, 1, 4, shards=("s0", "s1")), FOUR, stored(4, 0, FOUR)),  # gone from the list
        (config(2, 1, 2), FOUR, stored(2, 0, FOUR)),  # nothing changed
        (config(2, 0, 0), ["s0", "s2", "s1", "s30"], {k: v for k, v in stored(2, 0, FOUR).items() if "task1" in k[1]}),  # a stored shard was replaced, and a task's offset is missing
        (config(2, 0, 0, ordered_transactions=True), ["s0", "s1", "s4"], {k: v if i else {**v, "transaction_epoch": '{"s0":1,"s9":1}'} for i, (k, v) in enumerate(stored(2, 0, ["s0", "s1"], True).items())}),  # epochs of other shards
        (config(4, 1, 2), FOUR, {k: v for k, v in stored(2, 0, FOUR).items() if "task0" in k[1]}),  # an offset is missing
        (config(4, 1, 2, ordered_transactions=True), FOUR, stored(2, 0, FOUR)),  # no epochs
    ],
)
def test_plans_that_fail(cfg, live, store):
    with pytest.raises(planner.PlanError):
        planner.plan(cfg, live, store)


def test_same_shards():
    assert planner.same_shards(["a", "b"], ["b", "a"]) and not planner.same_shards(["a", "a"], ["a"]) and planner.same_shards(None, None) and not planner.same_shards(None, [])


@pytest.mark.parametrize("bad", [{"tablet_type": "X"}, {"time_precision": "adaptive"}, {"tasks": 2}, {"vgtid": "x"}, {"vgtid": '[{"keyspace":"other","shard":"0","gtid":"g"}]'}, {"shards": ("a",), "vgtid": '[{"keyspace":"","shard":"0","gtid":"g"}]'}, {"shard_epoch_map": "x"}, {"shards": ("a",), "shard_epoch_map": '{"b":1}'}, {"inherit_epoch": True}, {"grpc_headers": "nocolon"}, {"offset_storage_per_task": True}])
def test_config_errors(bad):
    with pytest.raises(ConfigError):
        Config(**bad).check()


def test_config():
    c = Config(grpc_headers="a:b, c : d", shards=("0",), vgtid='[{"keyspace":"ks","shard":"0","gtid":"g"}]', keyspace="ks").check()
    assert c.headers() == {"a": "b", "c": "d"} and Config().start_gtid() == "" and Config(snapshot_mode="never").start_gtid() == "current"
    assert c.source_options()["tabletType"] == "MASTER" and c.decode_options().uint64 == "string"


def test_sources(spark):
    names = spark.createDataFrame([("ks/-80",), ("ks/80-",), ("ks2/0",)], "name string")
    assert [r.shard for r in metadata.shards(names, "ks").collect()] == ["-80", "80-"]
    t = spark.createDataFrame([(i, f"r{i}") for i in range(10)], "id long, s string")
    got = snapshot.copy_rows(t, "ks", "t", ["id"], [5])
    assert sorted(r.after.id for r in got.collect()) == [6, 7, 8, 9] and snapshot.copy_rows(t, "ks", "t", ["id"], None, "").count() == 0
    assert metadata.quote_identifier("a`b") == "`a``b`" and metadata.escape_like("a_b%") == "a\\_b\\%" and metadata.table_rule("t")[1] == "select * from `t`"
    row = spark.createDataFrame([(([1, -1], bytearray(b"x")),)], T.StructType([T.StructField("row", T.StructType([T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("values", T.BinaryType())]))]))
    assert metadata.decode_result(row).collect()[0].cells == ["x", None]


def test_filter_reaches_the_scan(spark, tmp_path):
    log = spark.createDataFrame([tuple(r[f.name] for f in EVENTS.fields) for r in random_log(1, 5)], EVENTS)
    log.write.parquet(str(tmp_path / "log"))
    plan = replay.read_log(spark, str(tmp_path / "log"), "ks.t", ["s0"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(stream, [s0])" in plan or "EqualTo(stream,s0)" in plan
