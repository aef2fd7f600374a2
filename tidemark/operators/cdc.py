"""Change-data-capture: binlog messages to keyed-table state.

Pipeline: ``parse_changelog -> route -> to_ops -> fold``.

* A message is ``database, table, type, data: array<map>, old: array<map>``
  (``old`` holds the previous values of the changed columns of an UPDATE).
* ``to_ops`` turns each data row into cell puts and row tombstones with a
  total order ``seq = (offset, pos, kind)``: topic offset, row position in
  ``data``, 0 for a delete and 1 for a put.  All events of one table must
  come from one topic partition for the offsets to order them.
* ``fold`` replays the ops: per cell the put with the greatest ``seq`` wins,
  and survives only if it is newer than the row's latest tombstone.  It is
  one partial aggregate per cell and a window per row key over the reduced
  rows, so no row's history is ever gathered in one place.

Semantics kept from the source system:
INSERT writes every non-null column; UPDATE writes only the columns named in
``old`` (a NULL new value is stored as ''); DELETE drops the row; an UPDATE
that changes a key column deletes the old key and puts the full new image.
Types other than INSERT/UPDATE/DELETE (case-insensitive) are ignored.
Decisions are made per row, key columns are matched exactly (ignoring case),
and a NULL key part is '' everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.keys import joined_key, lower_names, map_value, salted, value_at

CHANGELOG_SCHEMA = (
    "database string, table string, type string, es bigint, ts bigint, "
    "isDdl boolean, data array<map<string,string>>, old array<map<string,string>>"
)
KIND_DELETE = 0
KIND_PUT = 1
FLOW_RUNNING = 2


def parse_flagged(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text to message columns plus ``_ok`` (parsed to a database,
    table and type).  The JSON is parsed once per record: through a
    generator, since a projection of ``from_json(..).field`` would be split
    by the optimizer into one parse per referenced field."""
    keep = [c for c in raw.columns if c != value_col]
    parsed = raw.select(*keep, F.col(value_col),
                        F.inline_outer(F.array(F.from_json(F.col(value_col), CHANGELOG_SCHEMA))))
    ok = F.col("database").isNotNull() & F.col("table").isNotNull() & F.col("type").isNotNull()
    return parsed.withColumn("_ok", F.coalesce(ok, F.lit(False)))


def split_parsed(parsed: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    keep = [c for c in parsed.columns if c not in (value_col, "_ok", "database", "table", "type",
                                                     "es", "ts", "isDdl", "data", "old")]
    messages = parsed.where("_ok").select(*keep, "database", "table", "type", "data", "old")
    rejects = parsed.where(~F.col("_ok")).select(*keep, F.col(value_col))
    return messages, rejects


def parse_changelog(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON text to message columns; returns ``(messages, rejects)``.

    A record that does not parse (or parses to no database/table/type) goes
    to ``rejects`` instead of failing the job.
    """
    return split_parsed(parse_flagged(raw, value_col), value_col)


def latest_flow(flow: DataFrame) -> DataFrame:
    """One config row per (database, table): the greatest flowId wins."""
    cols = [c for c in flow.columns]
    best = F.max(F.struct("flowId", *[c for c in cols if c != "flowId"])).alias("f")
    return flow.groupBy("databaseName", "tableName").agg(best).select("f.*").select(*cols)


def route(messages: DataFrame, flow: DataFrame) -> DataFrame:
    """Keep messages whose (database, table) has a running config; attach it.

    Joined on both columns (no concatenated key, so ``ab``+``c`` never
    matches ``a``+``bc``).  Spark broadcasts the config if its measured size
    is under the session's threshold, and shuffles it otherwise.
    """
    f = latest_flow(flow).where(F.col("status") == FLOW_RUNNING)
    f = f.select("databaseName", "tableName", "flowId", "hbaseTable",
                 "family", "uppercaseQualifier", "rowKey")
    j = messages.join(f, (messages["database"] == f["databaseName"])
                      & (messages["table"] == f["tableName"]), "inner")
    return j.drop("databaseName", "tableName")


def _key_columns(row_key: Column) -> Column:
    return F.transform(F.split(row_key, ","), lambda k: F.trim(k))


def _lower_keys() -> Column:
    return lower_names(_key_columns(F.col("rowKey")))


def _has_keys(low_keys: Column, data: Column) -> Column:
    """Whether every row image of a message names every key column (``low_keys``: in lower case).

    Names are lowered once a list, and a list that equals the message's first is not looked at again."""
    def named(names: Column) -> Column:
        return F.forall(F.array(lower_names(names)), lambda low: F.forall(low_keys, lambda k: F.array_contains(low, k)))

    return F.forall(F.array(F.map_keys(F.get(data, F.lit(0)))), lambda first: (first.isNull() | named(first)) & F.forall(
        data, lambda d: d.isNull() | F.coalesce(F.map_keys(d) == first, F.lit(False)) | named(F.map_keys(d))))


def split_routed(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(usable, rejects)``: messages with a row image that lacks a configured
    key column have no row key and go to the rejects."""
    good = F.coalesce(_has_keys(_lower_keys(), F.col("data")), F.lit(True))
    return routed.where(good), routed.where(~good)


def route_flagged(parsed: DataFrame, flow: DataFrame) -> DataFrame:
    """``parse_flagged`` records with their running config, where there is one, and ``_state``: ``kept`` (a usable
    change), ``rejected`` (no change, or a row image without its key) or ``dropped`` (no running flow).

    Every record stays one row, so the parts need no second join to be told apart."""
    f = latest_flow(flow).where(F.col("status") == FLOW_RUNNING).select(
        "databaseName", "tableName", "flowId", "hbaseTable", "family", "uppercaseQualifier", "rowKey",
        _lower_keys().alias("_keys"))  # once a flow, not a record
    j = parsed.join(f, F.col("_ok") & (parsed["database"] == f["databaseName"]) & (parsed["table"] == f["tableName"]), "left")
    good = F.coalesce(_has_keys(F.col("_keys"), F.col("data")), F.lit(True))
    state = F.when(~F.col("_ok"), "rejected").when(F.col("databaseName").isNull(), "dropped") \
        .when(good, "kept").otherwise("rejected")
    return j.withColumn("_state", state).drop("databaseName", "tableName")


def table_partitions(messages: DataFrame) -> DataFrame:
    """``database, table, low, high``: the topic partitions each source table came on.

    Offsets order the changes of a table only within one partition."""
    return messages.groupBy("database", "table").agg(
        F.min("partition").alias("low"), F.max("partition").alias("high"))


def to_ops(routed: DataFrame, wide: bool = False) -> DataFrame:
    """Routed messages to ops: ``hbaseTable, rowkey, offset, pos, kind, family, qualifier, value``.

    Tombstones have ``kind = 0`` and NULL family/qualifier/value.  A data row yields its
    tombstone, if any, then its put: a single pass over the messages.  ``wide`` ops hold all cells
    of a put in ``qualifiers`` and ``values`` (NULL in a tombstone), so what is
    shuffled is one record a row change, not one a cell.

    The names of a row image are lowered once, and its arrays of names and values are
    taken as they are; cells are only gone through one by one where a value is NULL.
    """
    kind = F.upper(F.col("type"))
    keys = F.col("_keys") if "_keys" in routed.columns else _lower_keys()
    rows = routed.where(kind.isin("INSERT", "UPDATE", "DELETE")).select(
        "hbaseTable", "offset", "family", "uppercaseQualifier", kind.alias("op"), keys.alias("keys"), "old",
        F.posexplode("data").alias("pos", "d"))
    o, d, keys, low = F.try_element_at("old", F.col("pos") + 1), F.col("d"), F.col("keys"), F.col("low")
    rows = rows.where(d.isNotNull()).select(
        "hbaseTable", "offset", "pos", "family", "uppercaseQualifier", "op", "keys", "d", o.alias("o"),
        lower_names(F.map_keys(d)).alias("low"))
    o = F.col("o")
    changed = F.coalesce(F.map_keys(o), F.array().cast("array<string>"))
    key_change = (F.col("op") == "UPDATE") & F.exists(changed, lambda c: F.array_contains(keys, F.lower(c)))
    old_key = salted(joined_key(F.transform(keys, lambda k: F.when(
        F.array_contains(lower_names(changed), k), map_value(o, k)).otherwise(value_at(d, low, k)))))
    rows = rows.select(
        "hbaseTable", "offset", "pos", "family", "uppercaseQualifier", "op", "d",
        changed.alias("changed"), key_change.alias("key_change"),
        salted(joined_key(F.transform(keys, lambda k: value_at(d, low, k)))).alias("new_key"),
        F.when(key_change, old_key).alias("old_key"))  # only key changes need it

    is_tomb = (F.col("op") == "DELETE") | F.col("key_change")
    is_full = (F.col("op") == "INSERT") | F.col("key_change")
    names, values = F.map_keys(d), F.map_values(d)
    some_null = F.exists(values, lambda v: v.isNull())
    given = F.transform(F.filter(F.map_entries(d), lambda e: e["value"].isNotNull()), lambda e: e["key"])
    upd = F.transform("changed", lambda c: F.coalesce(F.try_element_at(d, c), F.lit("")))
    rows = rows.select(
        "hbaseTable", "offset", "pos", "family", "uppercaseQualifier", "new_key",
        F.when(is_tomb, F.when(F.col("key_change"), F.col("old_key")).otherwise(F.col("new_key"))).alias("tomb_key"),
        F.coalesce(is_tomb, F.lit(False)).alias("tomb"),
        F.when(is_full, F.when(some_null, given).otherwise(names)).when(F.col("op") == "UPDATE", F.col("changed")).alias("names"),
        F.when(is_full, F.when(some_null, F.filter(values, lambda v: v.isNotNull())).otherwise(values))
         .when(F.col("op") == "UPDATE", upd).alias("values"))
    has_put = F.coalesce(F.size("names") > 0, F.lit(False))
    kinds = F.when(F.col("tomb") & has_put, F.array(F.lit(KIND_DELETE), F.lit(KIND_PUT))) \
        .when(F.col("tomb"), F.array(F.lit(KIND_DELETE))).when(has_put, F.array(F.lit(KIND_PUT)))
    qualifiers = F.when(F.col("uppercaseQualifier"), F.transform("names", lambda n: F.upper(n))).otherwise(F.col("names"))
    is_put = F.col("kind") == KIND_PUT
    ops = rows.select("*", F.explode(kinds).alias("kind")).select(
        "hbaseTable", F.when(is_put, F.col("new_key")).otherwise(F.col("tomb_key")).alias("rowkey"), "offset", "pos", "kind",
        F.when(is_put, F.col("family").cast("string")).alias("family"),
        F.when(is_put, qualifiers).alias("qualifiers"), F.when(is_put, F.col("values")).alias("values"))
    return ops if wide else to_cells(ops)


def is_wide(ops: DataFrame) -> bool:
    """Whether ops (or the rows of a state) are wide."""
    return "qualifiers" in ops.columns


def to_cells(ops: DataFrame) -> DataFrame:
    """Wide ops one cell a row; a tombstone stays one row."""
    keep = [c for c in ops.columns if c not in ("qualifiers", "values")]
    cells = F.arrays_zip(F.col("qualifiers").alias("qualifier"), F.col("values").alias("value"))
    return ops.select(*keep, F.inline_outer(cells))


def to_wide(ops: DataFrame) -> DataFrame:
    """Ops of one cell each as wide ops; nothing is moved or gathered."""
    put = F.col("kind") == KIND_PUT
    return ops.select(*[c for c in ops.columns if c not in ("qualifier", "value")],
                      F.when(put, F.array("qualifier")).alias("qualifiers"), F.when(put, F.array("value")).alias("values"))


def seq_col() -> Column:
    return F.struct("offset", "pos", "kind")


def fold(ops: DataFrame) -> DataFrame:
    """Replay ops into the keyed-table state.

    Output rows: ``hbaseTable, rowkey, kind, family, qualifier, value, seq``.
    ``kind = 1`` rows are live cells; ``kind = 0`` rows are the latest
    tombstone of a row key, kept so that folding this state again with more
    ops (a later micro-batch, or a replayed one) gives the same answer.

    One partial aggregate per cell (a hot row's updates collapse on the map
    side before the shuffle), then a window per row key over the reduced
    rows, which hold at most one row per qualifier plus one tombstone.

    Wide ops give a wide state (``qualifiers, values`` for ``qualifier, value``): the
    aggregate is per row key and list of qualifiers, the window takes from each of
    the row's reduced ops the cells that a newer one has too.
    """
    # One aggregate buffer per group: the greatest (seq, value); seq decides,
    # the value only breaks a tie between duplicate qualifiers of one row.
    what, of = ("qualifiers", "values") if is_wide(ops) else ("qualifier", "value")
    best = F.max(F.struct(seq_col().alias("seq"), F.col(of))).alias("_best")
    # The row key comes first: its hash prefix decides nearly all comparisons of the sorts.
    cells = (ops.groupBy("rowkey", "hbaseTable", "kind", "family", what).agg(best)
             .select("hbaseTable", "rowkey", "kind", "family", what, f"_best.{of}", "_best.seq"))
    by_row = Window.partitionBy("rowkey", "hbaseTable")
    del_seq = F.max(F.when(F.col("kind") == KIND_DELETE, F.col("seq"))).over(by_row)
    alive = ((F.col("kind") == KIND_DELETE) | F.col("del_seq").isNull() | (F.col("seq") > F.col("del_seq")))
    if not is_wide(ops):
        return cells.withColumn("del_seq", del_seq).where(alive).drop("del_seq")
    put = F.when(F.col("kind") == KIND_PUT, F.struct("seq", "family", "qualifiers", "values"))
    state = cells.withColumns({"del_seq": del_seq, "puts": F.collect_list(put).over(by_row)}).where(alive)
    # A tombstone, and the one put of a row, stand as they are; the cells of others are compared.
    whole = F.coalesce((F.col("kind") == KIND_DELETE) | (
        (F.size("puts") == 1) & (F.size(F.array_distinct("qualifiers")) == F.size("qualifiers"))), F.lit(False))
    compared = F.transform(F.filter(_standing(), lambda c: F.size(c) > 0), lambda c: F.struct(
        c["qualifiers"].alias("qualifiers"), c["values"].alias("values")))
    state = state.select("*", whole.alias("whole")).select(
        "hbaseTable", "rowkey", "kind", "family", "seq", "qualifiers", "values", "whole",
        F.when(~F.col("whole"), compared).alias("compared"))  # its own step: what explodes is then plain compiled code
    kept = F.when(F.col("whole"), F.array(F.struct("qualifiers", "values"))).otherwise(F.col("compared"))
    return (state.select("hbaseTable", "rowkey", "kind", "family", "seq", F.explode(kept).alias("kept"))
            .select("hbaseTable", "rowkey", "kind", "family", F.col("kept.qualifiers").alias("qualifiers"),
                    F.col("kept.values").alias("values"), "seq"))


def _standing() -> Column:
    """One array: the cells of a reduced wide put that no other of the row's reduced ``puts`` replaces.

    ``puts`` has one op for each list of qualifiers that the row was written with."""
    cells, names = F.arrays_zip("qualifiers", "values"), F.col("qualifiers")
    newer = F.filter("puts", lambda p: (p["seq"] > F.col("seq")) & p["family"].eqNullSafe(F.col("family")))
    taken = F.flatten(F.transform(newer, lambda p: p["qualifiers"]))
    kept = F.transform(F.array(taken), lambda t: F.when(F.size(t) == 0, cells).otherwise(  # taken is made once
        F.filter(cells, lambda c: ~F.array_contains(t, c["qualifiers"]))))
    # Equal qualifiers in one op, or ops of one place in the log: the greater value stands, as in the fold of cells.
    ties = (F.size(F.array_distinct(names)) < F.size(names)) | (
        (F.size("puts") > 1) & F.exists("puts", lambda p: (p["seq"] == F.col("seq")) & (p["qualifiers"] != names)))
    return F.when(ties, F.array(_greatest())).when(F.size("puts") == 1, F.array(cells)).otherwise(kept)


def _greatest() -> Column:
    """``_standing`` where (seq, value) decides between equal qualifiers."""
    seq, names, values = F.col("seq"), F.col("qualifiers"), F.col("values")

    def pairs(q: Column, v: Column) -> Column:
        return F.arrays_zip(q.alias("q"), v.alias("v"))

    def beaten(name: Column, value: Column, at: Column) -> Column:
        def by(p: Column) -> Column:
            newer = (p["seq"] > seq) & F.array_contains(p["qualifiers"], name)
            tie = (p["seq"] == seq) & F.exists(pairs(p["qualifiers"], p["values"]),
                                               lambda c: (c["q"] == name) & (c["v"] > value))
            # of equal cells of two ops that of the lesser list of qualifiers stands
            same = (p["seq"] == seq) & (p["qualifiers"] < names) & F.exists(
                pairs(p["qualifiers"], p["values"]), lambda c: (c["q"] == name) & (c["v"] == value))
            return p["family"].eqNullSafe(F.col("family")) & (newer | tie | same)
        again = F.exists(pairs(F.slice(names, 1, at), F.slice(values, 1, at)),
                         lambda c: (c["q"] == name) & (c["v"] == value))
        return F.exists("puts", by) | again

    return F.filter(F.arrays_zip("qualifiers", "values"), lambda c, i: ~beaten(c["qualifiers"], c["values"], i))


def live_cells(state: DataFrame) -> DataFrame:
    return state.where(F.col("kind") == KIND_PUT)


def state_as_ops(state: DataFrame) -> DataFrame:
    """A folded state back in ops form, to fold it again with newer ops."""
    what = ("qualifiers", "values") if is_wide(state) else ("qualifier", "value")
    return state.select("hbaseTable", "rowkey", "seq.offset", "seq.pos", "kind", "family", *what)


def _field(name: str) -> Column:
    """The greatest value of a wide op's cells whose qualifier is ``name``, ignoring case."""
    low, values = F.col("_low"), F.col("values")
    many = F.array_max(F.transform(F.filter(F.arrays_zip(low.alias("q"), values.alias("v")),
                                            lambda c: c["q"] == name.lower()), lambda c: c["v"]))
    one = F.get(values, F.array_position(low, name.lower()).cast("int") - 1)
    return F.when(F.size(F.array_distinct(low)) < F.size(low), many).otherwise(one)


def state_to_keyed(cells: DataFrame, family: str, fields: list[str],
                   table: str | None = None) -> DataFrame:
    """Pivot live cells (plain or wide) of one keyed table into ``rowkey, family STRUCT<fields>``
    (names matched ignoring case; ``table`` selects the keyed table when the
    state holds several).

    A conditional ``max`` per field: partial aggregation, no list collected.
    Of one table, the rows are grouped where the fold left them.
    """
    if table is not None:
        cells = cells.where(F.col("hbaseTable") == table)
    if is_wide(cells):
        cells = cells.withColumn("_low", lower_names(F.col("qualifiers")))
        aggs = [F.max(_field(name)).alias(name) for name in fields]
    else:
        q = F.lower(F.col("qualifier"))
        aggs = [F.max(F.when(q == name.lower(), F.col("value"))).alias(name) for name in fields]
    wide = cells.groupBy("rowkey", *["hbaseTable"] * (table is not None)).agg(*aggs)
    return wide.select("rowkey", F.struct(*fields).alias(family))
