"""CDC: random changelogs folded by Spark equal a plain sequential model."""

import hashlib
import json
import random

from tidemark.operators import cdc

FLOW_SCHEMA = ("flowId int, mode int, databaseName string, tableName string, hbaseTable string, "
               "family string, uppercaseQualifier boolean, commitBatch int, rowKey string, status int")
KEY_COLS = ["id", "No"]
FIELDS = ["id", "No", "a", "b", "nob"]


def rk(d, key_cols=KEY_COLS):
    j = "|".join("" if d.get(k) is None else d[k] for k in key_cols)
    return hashlib.md5(j.encode()).hexdigest()[:8] + "_" + j


def model(msgs, upper):
    """Sequential puts and deletes, one message and one row at a time."""
    state = {}
    q = (lambda k: k.upper()) if upper else (lambda k: k)
    keys_l = {k.lower() for k in KEY_COLS}
    for m in msgs:
        t = (m.get("type") or "").upper()
        data, old = m.get("data") or [], m.get("old") or []
        for i, d in enumerate(data):
            if d is None:
                continue
            o = old[i] if i < len(old) else None
            if t == "INSERT":
                state.setdefault(rk(d), {}).update({q(k): v for k, v in d.items() if v is not None})
            elif t == "DELETE":
                state.pop(rk(d), None)
            elif t == "UPDATE" and o:
                changed = list(o)
                if any(c.lower() in keys_l for c in changed):
                    old_d = dict(d)
                    for c in changed:
                        for k in KEY_COLS:
                            if k.lower() == c.lower():
                                old_d[k] = o[c]
                    state.pop(rk(old_d), None)
                    state.setdefault(rk(d), {}).update({q(k): v for k, v in d.items() if v is not None})
                else:
                    row = state.setdefault(rk(d), {})
                    for c in changed:
                        row[q(c)] = "" if d.get(c) is None else d[c]
    return {k: v for k, v in state.items() if v}


def random_log(rng, n):
    current = {}
    msgs = []
    for _ in range(n):
        kind = rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE", "update", "ALTER"])
        rows, olds = [], []
        for _ in range(rng.choice([1, 1, 2, 3])):
            ident = str(rng.randrange(4))
            base = current.get(ident) or {"id": ident, "No": rng.choice(["x", "y", None]),
                                          "a": str(rng.randrange(9)), "b": None, "nob": "n"}
            d = dict(base)
            o = {}
            if kind.upper() == "UPDATE":
                for c in rng.sample(FIELDS, rng.choice([1, 2])):
                    o[c] = d.get(c)
                    d[c] = rng.choice([None, str(rng.randrange(9)), "z"]) if c not in ("id",) else str(rng.randrange(4))
            rows.append(d)
            olds.append(o)
            current[d["id"]] = d
        m = {"database": "db", "table": "t", "type": kind, "data": rows}
        if kind.upper() == "UPDATE":
            m["old"] = olds
        msgs.append(m)
    return msgs


def run_spark(spark, logs, upper):
    recs = []
    flows = []
    for i, msgs in enumerate(logs):
        for off, m in enumerate(msgs):
            m = dict(m, table=f"t{i}")
            recs.append((0, i * 1000 + off, json.dumps(m)))
        flows.append((i, 1, "db", f"t{i}", f"h{i}", "cf", upper, 10, ",".join(KEY_COLS), 2))
    raw = spark.createDataFrame(recs, "partition int, offset bigint, value string")
    m, _ = cdc.parse_changelog(raw)
    cells = cdc.live_cells(cdc.fold(cdc.to_ops(cdc.route(m, spark.createDataFrame(flows, FLOW_SCHEMA)))))
    out = {}
    for r in cells.collect():
        out.setdefault(r.hbaseTable, {}).setdefault(r.rowkey, {})[r.qualifier] = r.value
    return out


def test_random_changelogs_match_sequential_model(spark):
    rng = random.Random(7)
    for upper in (False, True):
        logs = [random_log(rng, rng.randrange(3, 15)) for _ in range(40)]
        got = run_spark(spark, logs, upper)
        assert sum(1 for i, msgs in enumerate(logs) if model(msgs, upper)) >= 20
        for i, msgs in enumerate(logs):
            assert got.get(f"h{i}", {}) == model(msgs, upper), (i, msgs)


def test_fold_is_incremental(spark):
    """Folding a folded state with later ops equals folding everything at once."""
    rng = random.Random(11)
    logs = [random_log(rng, 12) for _ in range(10)]
    recs, flows = [], []
    for i, msgs in enumerate(logs):
        for off, m in enumerate(msgs):
            recs.append((0, i * 1000 + off, json.dumps(dict(m, table=f"t{i}"))))
        flows.append((i, 1, "db", f"t{i}", f"h{i}", "cf", False, 10, "id,No", 2))
    flow = spark.createDataFrame(flows, FLOW_SCHEMA)

    def ops_of(rows):
        raw = spark.createDataFrame(rows, "partition int, offset bigint, value string")
        m, _ = cdc.parse_changelog(raw)
        return cdc.to_ops(cdc.route(m, flow))

    first = [r for r in recs if r[1] % 1000 < 6]
    rest = [r for r in recs if r[1] % 1000 >= 6]
    state1 = cdc.fold(ops_of(first))
    state2 = cdc.fold(cdc.state_as_ops(state1).unionByName(ops_of(rest)))
    # Replaying the second part again (at-least-once delivery) changes nothing.
    state3 = cdc.fold(cdc.state_as_ops(state2).unionByName(ops_of(rest)))
    whole = cdc.fold(ops_of(recs))

    def cells(st):
        return sorted(tuple(r) for r in cdc.live_cells(st)
                      .select("hbaseTable", "rowkey", "qualifier", "value").collect())
    assert cells(state2) == cells(whole) == cells(state3)


def test_routing_requires_running_config_and_both_names(spark):
    flows = [(1, 1, "ab", "c", "h1", "cf", False, 10, "id", 2),
             (2, 1, "x", "y", "h2", "cf", False, 10, "id", 1),
             (3, 1, "x", "y2", "h3", "cf", False, 10, "id", 1),
             (4, 1, "x", "y2", "h3", "cf", False, 10, "id", 2)]
    msgs = [("a", "bc"), ("ab", "c"), ("x", "y"), ("x", "y2"), ("q", "r")]
    raw = spark.createDataFrame(
        [(0, i, json.dumps({"database": d, "table": t, "type": "INSERT", "data": [{"id": "1"}]}))
         for i, (d, t) in enumerate(msgs)], "partition int, offset bigint, value string")
    m, _ = cdc.parse_changelog(raw)
    routed = cdc.route(m, spark.createDataFrame(flows, FLOW_SCHEMA))
    got = sorted((r.database, r.table, r.flowId) for r in routed.collect())
    # ab+c must not match a+bc; a later config row (flowId 4) overrides flowId 3.
    assert got == [("ab", "c", 1), ("x", "y2", 4)]


def test_malformed_json_goes_to_rejects(spark):
    raw = spark.createDataFrame([(0, 0, "{not json"), (0, 1, '{"database":"a","table":"b","type":"INSERT"}'),
                                 (0, 2, '{"foo": 1}')], "partition int, offset bigint, value string")
    m, rejects = cdc.parse_changelog(raw)
    assert m.count() == 1
    assert sorted(r.offset for r in rejects.collect()) == [0, 2]


def test_ddl_and_empty_messages_do_nothing(spark):
    flow = spark.createDataFrame([(1, 1, "d", "t", "h", "cf", False, 10, "id", 2)], FLOW_SCHEMA)
    recs = [json.dumps({"database": "d", "table": "t", "type": "ALTER", "data": [{"id": "1"}]}),
            json.dumps({"database": "d", "table": "t", "type": "UPDATE", "data": [{"id": "1"}], "old": []}),
            json.dumps({"database": "d", "table": "t", "type": "UPDATE", "data": [], "old": [{"id": "2"}]}),
            json.dumps({"database": "d", "table": "t", "type": "INSERT", "data": None}),
            json.dumps({"database": "d", "table": "t", "type": "DELETE", "data": None})]
    raw = spark.createDataFrame([(0, i, v) for i, v in enumerate(recs)], "partition int, offset bigint, value string")
    m, _ = cdc.parse_changelog(raw)
    assert cdc.to_ops(cdc.route(m, flow)).count() == 0


def test_key_names_are_trimmed_and_matched_without_case(spark):
    """A config written as `` ID , no`` gives the keys of ``id,No``."""
    rng = random.Random(5)
    logs = [random_log(rng, 12) for _ in range(12)]
    recs, flows, same = [], [], []
    for i, msgs in enumerate(logs):
        recs += [(0, i * 1000 + off, json.dumps(dict(m, table=f"t{i}"))) for off, m in enumerate(msgs)]
        flows.append((i, 1, "db", f"t{i}", f"h{i}", "cf", False, 10, " ID , no", 2))
        same.append((*flows[-1][:8], "id,No", 2))
    raw = spark.createDataFrame(recs, "partition int, offset bigint, value string")
    m, _ = cdc.parse_changelog(raw)

    def cells(config):
        usable, keyless = cdc.split_routed(cdc.route(m, spark.createDataFrame(config, FLOW_SCHEMA)))
        assert keyless.count() == 0
        return sorted(tuple(r) for r in cdc.live_cells(cdc.fold(cdc.to_ops(usable)))
                      .select("hbaseTable", "rowkey", "qualifier", "value").collect())
    assert cells(flows) == cells(same)


def test_rows_without_a_key_column_are_rejected(spark):
    flow = spark.createDataFrame([(1, 1, "d", "t", "h", "cf", False, 10, "id,No", 2)], FLOW_SCHEMA)
    recs = [{"database": "d", "table": "t", "type": "INSERT", "data": [{"id": "1", "no": None}]},
            {"database": "d", "table": "t", "type": "INSERT", "data": [{"id": "1", "x": "2"}]}]
    raw = spark.createDataFrame([(0, i, json.dumps(v)) for i, v in enumerate(recs)],
                                "partition int, offset bigint, value string")
    m, _ = cdc.parse_changelog(raw)
    usable, keyless = cdc.split_routed(cdc.route(m, flow))
    assert [r.offset for r in usable.collect()] == [0] and [r.offset for r in keyless.collect()] == [1]


def test_a_table_on_two_partitions_stops_the_sync(spark, scratch):
    import pytest
    from tidemark.sinks.keyed_state import KeyedStateTable
    from tidemark.streaming.cdc_apply import check_partitions
    table = KeyedStateTable(spark, f"{scratch}/t")
    message = json.dumps({"database": "d", "table": "t", "type": "INSERT", "data": [{"id": "1"}]})

    def messages(*partitions):
        raw = spark.createDataFrame([(p, i, message) for i, p in enumerate(partitions)],
                                    "partition int, offset bigint, value string")
        return cdc.parse_changelog(raw)[0]
    check_partitions(table, messages(1, 1))
    check_partitions(table, messages(1))
    for wrong in (messages(2), messages(1, 2)):
        with pytest.raises(ValueError, match="more than one topic partition"):
            check_partitions(table, wrong)


def test_key_column_match_is_exact_not_substring(spark):
    """With key ``orderId,orderNo`` an updated column ``No`` is a plain cell."""
    flow = spark.createDataFrame([(1, 1, "d", "t", "h", "cf", False, 10, "orderId,orderNo", 2)], FLOW_SCHEMA)
    ins = {"database": "d", "table": "t", "type": "INSERT", "data": [{"orderId": "1", "orderNo": "a", "No": "x"}]}
    upd = {"database": "d", "table": "t", "type": "UPDATE",
           "data": [{"orderId": "1", "orderNo": "a", "No": "y"}], "old": [{"No": "x"}]}
    raw = spark.createDataFrame([(0, 0, json.dumps(ins)), (0, 1, json.dumps(upd))],
                                "partition int, offset bigint, value string")
    m, _ = cdc.parse_changelog(raw)
    cells = {(r.qualifier, r.value) for r in cdc.live_cells(cdc.fold(cdc.to_ops(cdc.route(m, flow)))).collect()}
    assert cells == {("orderId", "1"), ("orderNo", "a"), ("No", "y")}


def _cells(state):
    return sorted(tuple(str(v) for v in r) for r in state.select(
        "hbaseTable", "rowkey", "kind", "family", "qualifier", "value", "seq").collect())


def test_wide_fold_equals_the_fold_of_cells(spark):
    """Random wide ops, with repeated qualifiers and ops of one place in the log: cell by cell the same state,
    also when a folded state is folded again with later ops."""
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        names = tuple(rng.choice("abcd") for _ in range(rng.choice([1, 1, 2, 3])))
        at = (rng.choice("hi"), rng.choice("rstuvw"), rng.randrange(12), rng.randrange(2))
        if rng.random() < 0.1:
            rows.append((*at, 0, None, None, None))
        else:  # one place in the log gives one value list for each list of qualifiers
            own = random.Random(str((at, names)))
            rows.append((*at, 1, rng.choice(["f", "g"]) if rng.random() < 0.2 else None, list(names),
                         [str(own.randrange(9)) for _ in names]))
    ops = spark.createDataFrame(rows, "hbaseTable string, rowkey string, offset bigint, pos int, kind int, "
                                      "family string, qualifiers array<string>, values array<string>")
    want = _cells(cdc.fold(cdc.to_cells(ops)))
    assert _cells(cdc.to_cells(cdc.fold(ops))) == want
    old, new = cdc.fold(ops.where("offset < 6")), ops.where("offset >= 6")
    assert _cells(cdc.to_cells(cdc.fold(cdc.state_as_ops(old).unionByName(new)))) == want


def test_wide_ops_are_one_record_a_row_change(spark):
    """A row image is shuffled as one record; its cells are those of the plain form."""
    rng = random.Random(13)
    logs = [random_log(rng, 12) for _ in range(6)]
    recs = [(0, i * 1000 + off, json.dumps(dict(m, table=f"t{i}"))) for i, msgs in enumerate(logs) for off, m in enumerate(msgs)]
    flows = [(i, 1, "db", f"t{i}", f"h{i}", "cf", bool(i % 2), 10, "id,No", 2) for i in range(len(logs))]
    m, _ = cdc.parse_changelog(spark.createDataFrame(recs, "partition int, offset bigint, value string"))
    routed = cdc.route(m, spark.createDataFrame(flows, FLOW_SCHEMA))
    wide, plain = cdc.to_ops(routed, wide=True), cdc.to_ops(routed)
    assert sorted(map(str, cdc.to_cells(wide).collect())) == sorted(map(str, plain.collect()))
    places = wide.groupBy("hbaseTable", "offset", "pos", "kind").count()
    assert places.where("count > 1").count() == 0 and wide.count() < plain.count()
    keyed = [cdc.state_to_keyed(cdc.live_cells(cdc.fold(o)), "cf", FIELDS, "h1").collect() for o in (wide, plain)]
    assert keyed[0] and sorted(map(str, keyed[0])) == sorted(map(str, keyed[1]))


def test_a_table_begun_with_cells_goes_on(spark, scratch):
    """A table whose schema has one cell a row takes wide ops as cells."""
    from tidemark.sinks.keyed_state import CELL_COLUMNS, KeyedStateTable
    cells = spark.createDataFrame([("h", "r", 0, 0, 1, "f", "a", "1"), ("h", "r", 0, 0, 1, "f", "b", "2")],
                                  "hbaseTable string, rowkey string, offset bigint, pos int, kind int, family string, "
                                  "qualifier string, value string")
    KeyedStateTable(spark, f"{scratch}/t").apply(cells.select(*CELL_COLUMNS), 0)
    table = KeyedStateTable(spark, f"{scratch}/t")
    later = cells.where("qualifier = 'a'").withColumn("offset", cells["offset"] + 1)
    table.apply_batch(cdc.to_wide(later), 1)
    assert table.schema.names == list(CELL_COLUMNS)
    assert sorted((r.qualifier, r.offset) for r in table.cells().collect()) == [("a", 1), ("b", 0)]


def test_the_sync_keeps_no_batch_in_memory(spark, scratch, monkeypatch):
    """A batch is read twice and never persisted, so no task holds or reads a cached part of it."""
    from pyspark.sql.classic.dataframe import DataFrame
    from tidemark.sinks.keyed_state import KeyedStateTable
    from tidemark.streaming.cdc_apply import RoutingState, cdc_progress, changelog_batch_writer
    kept = []
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(self) or self)

    class Flow:
        def get(self):
            return spark.createDataFrame([(1, 1, "d", "t", "h", "cf", False, 10, "id", 2)], FLOW_SCHEMA)
    table = KeyedStateTable(spark, f"{scratch}/t")
    recs = [(0, 0, json.dumps({"database": "d", "table": "t", "type": "INSERT", "data": [{"id": "1"}]})),
            (0, 1, json.dumps({"database": "d", "table": "t", "type": "INSERT", "data": [{"no": "1"}]})),
            (0, 2, "no json"), (1, 3, json.dumps({"database": "d", "table": "u", "type": "INSERT", "data": []}))]
    changelog_batch_writer(table, RoutingState(spark, f"{scratch}/r", Flow()))(
        spark.createDataFrame(recs, "partition int, offset bigint, value string"), 0)
    assert not kept
    assert [tuple(r) for r in cdc_progress(spark, table.path).collect()] == [(0, 4, 1, 1, 2)]
    assert sorted(r.offset for r in spark.read.parquet(f"{table.path}/rejects").collect()) == [1, 2]


def test_a_first_batch_is_dealt_to_many_tasks(spark, scratch):
    """One bucket's rows are dealt to more tasks than the slices of a full bucket, whatever the batch's size."""
    from pyspark.sql import functions as F
    from tidemark.sinks import bucketed
    from tidemark.sinks.upsert import UpsertTable
    table, old = UpsertTable(spark, f"{scratch}/t", ["id"]), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        rows = table._spread(spark.range(20_000).withColumn("batch", F.lit(0).cast("long")), 1)
        tasks = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert tasks > bucketed.SLICES


def test_row_images_of_one_message_with_other_names(spark):
    """Rows of a message that name their columns otherwise than its first row, or not at all, are seen one by one."""
    names = [{"ID": "1", "a": None, "b": "x"}, None, {"b": "y", "id": "2", "Id": "3"}, {"iD": None, "a": "z"}]
    logs = [names, [None, *names], [{"id": "4"}, {"a": "5"}], [{"a": "5"}, {"id": "4"}], [], [{"id": "6", "a": None}]]
    recs = [(0, i, json.dumps({"database": "d", "table": "t", "type": "INSERT", "data": rows})) for i, rows in enumerate(logs)]
    raw = spark.createDataFrame(recs, "partition int, offset bigint, value string")
    flow = spark.createDataFrame([(1, 1, "d", "t", "h", "cf", True, 10, "id", 2)], FLOW_SCHEMA)
    flagged = cdc.route_flagged(cdc.parse_flagged(raw), flow)
    state = {r.offset: r._state for r in flagged.collect()}
    assert state == {0: "kept", 1: "kept", 2: "rejected", 3: "rejected", 4: "kept", 5: "kept"}
    kept = flagged.where("_state = 'kept'")
    assert "_keys" in kept.columns  # made once a flow
    want = [("1", ["ID", "B"], ["1", "x"]), ("2", ["B", "ID", "ID"], ["y", "2", "3"]), ("", ["A"], ["z"])]
    got = [(r.offset, r.rowkey.split("_")[1], r.qualifiers, r["values"])
           for r in cdc.to_ops(kept, wide=True).orderBy("offset", "pos").collect()]
    assert got == [(i, *w) for i in (0, 1) for w in want] + [(5, "6", ["ID"], ["6"])]
