"""Mixing sources to target weights by entropy balancing.

Each document gets a rate of copies.  Among all rates in ``[0, cap]`` that give
every source its target of tokens, entropy balancing takes those closest to
one copy of each (least relative entropy).  The convex dual has one unknown a
source, and its optimum has the form ``rate = min(cap, exp(lambda * size))``:
an exponentially tilted rate.  The unknowns are found by Newton iterations, one
Spark aggregation each for all sources together.

Rates depend on the source and the size alone, so the sums run over the table
of (source, size, documents), which is as exact as the documents themselves and
does not grow with copies of a document or with the hot source's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, fresh, numbered

#: Steps in which every source is solved; a bracket that is halved so often is as narrow as numbers can be.
STEPS = 200
#: Relative error of a source's token constraint at which its dual is solved.
CLOSE = 1e-6
#: Leading bits of a document's hash: a class's documents are counted in 256 hash ranges.
RANGE_BITS = 8


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``key, source_size, target`` from ``key, source, source_size``, one row a source.

    Sources in code point order, null last, take ``weights`` in turn, repeating.
    ``share`` of all sizes is dealt by weight; a target stops at ``cap`` times
    its source's size and the excess goes to the others by weight until none is
    above.  That ends at one level ``L`` with ``target = min(cap * size, weight
    * L)``; each pass finds the sources that are full at the present level.
    """
    ranked = numbered(sizes.withColumn("last", F.col("source").isNull()), "last", "source", to="rank")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    weighed = ranked.select("key", "source_size", turn.alias("weight"),
                            (F.lit(float(cap)) * F.col("source_size")).alias("most"))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        is_full = F.col("most") <= F.col("weight") * F.lit(level)
        filled, room, n = weighed.agg(F.sum(F.when(is_full, F.col("most"))),
                                      F.sum(F.when(~is_full, F.col("weight"))),
                                      F.count_if(is_full)).first()
        if n == full or not room:
            break
        full, level = n, (share * total - (filled or 0.0)) / room
    target = F.least(F.col("most"), F.col("weight") * F.lit(level)) if room else F.col("most")
    return weighed.select("key", "source_size", target.alias("target"))


def _rate(cap: float) -> Column:
    tilt = F.exp(F.least(F.col("dual") * F.col("size") / F.col("scale"), F.lit(50.0)))
    return F.when(F.col("size") == 0, 1.0).otherwise(F.least(F.lit(float(cap)), tilt))


def tilted_rates(classes: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """``key, target, source_size, dual, scale``: the solved dual of each source's token constraint.

    ``classes`` is ``key, size, docs``, dealt by key, so a step needs no
    shuffle.  A Newton step that leaves the bracket known so far is replaced by
    its middle, or by a doubling while one side is open, so every source
    converges.  A target of ``cap`` times the source's size has all documents
    at the cap (dual of plus infinity).
    """
    docs, size, rate = F.col("docs"), F.col("size"), _rate(cap)
    full = F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)
    state = cut(classes.groupBy("key").agg((F.sum(size * docs) / F.sum(docs)).alias("scale"))
                .join(targets, "key").select(
        "key", "target", "source_size", F.when(F.col("scale") > 0, F.col("scale")).otherwise(1.0).alias("scale"),
        F.when(full, float("inf")).otherwise(0.0).alias("dual"),
        F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), full.alias("done")))
    kept = ("target", "source_size", "scale", "dual", "low", "high", "done")
    gap, low, high, dual = F.col("tokens") - F.col("target"), F.col("low"), F.col("high"), F.col("dual")
    newton = dual - gap / F.col("slope")
    middle = (F.when((low > float("-inf")) & (high < float("inf")), (low + high) / 2)
              .when(low > float("-inf"), low + F.abs(low) + 0.5).otherwise(high - F.abs(high) - 0.5))
    for _ in range(STEPS):
        if state.filter("not done").isEmpty():
            break
        state = cut(classes.join(state, "key").groupBy("key").agg(
            *[F.first(c).alias(c) for c in kept],
            F.sum(docs * size * rate).alias("tokens"),
            F.sum(F.when(rate < cap, docs * size * size / F.col("scale") * rate)).alias("slope"))
            .withColumn("done", F.col("done") | (F.abs(gap) <= CLOSE * F.col("target")))
            .withColumn("low", F.when(gap < 0, dual).otherwise(low))
            .withColumn("high", F.when(gap > 0, dual).otherwise(high))
            .withColumn("dual", F.when(F.col("done"), dual)
                        .when((F.col("slope") > 0) & (newton > low) & (newton < high), newton)
                        .otherwise(middle))
            .select("key", *kept))
    else:
        raise ArithmeticError(f"token constraints not solved in {STEPS} steps")
    return state


def _corrected(copies: DataFrame, cap: int) -> DataFrame:
    """One class of each source gets or loses the copies that bring its tokens nearest the target."""
    whole = Window.partitionBy("key")
    size, gap = F.col("size"), F.col("gap")
    room = F.when(gap > 0, cap * F.col("docs") - F.col("copies")).otherwise(F.col("copies"))
    steps = F.when(size > 0, F.least(room, F.round(F.abs(gap) / size).cast("long"))).otherwise(0)
    better = (F.struct("left", "size") == F.col("best")) & (F.col("left") < F.abs(gap))
    moved = F.when(better, F.signum(gap).cast("long") * F.col("steps")).otherwise(0)
    return (copies.withColumn("gap", F.col("target") - F.sum(size * F.col("copies")).over(whole))
            .withColumn("steps", steps).withColumn("left", F.abs(F.abs(gap) - F.col("steps") * size))
            .withColumn("best", F.min(F.struct("left", "size")).over(whole))
            .withColumn("copies", F.col("copies") + moved)
            .drop("gap", "steps", "left", "best"))


def mix(docs: DataFrame, source: Column, size: Column, identity: Column,
        weights: Sequence[float], share: float, cap: int) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken``.

    ``size`` (long, not null) and ``source`` are expressions over ``docs``;
    ``identity`` is a 64-bit hash that tells documents apart.  ``copies`` is in
    ``0 .. cap`` and ``taken = copies * size``.

    Rounding: each (source, size) class gets a whole number of copies, with
    the rounding carried from class to class from the largest size down, so a
    source ends within half of its largest document of the target; two
    correction passes then move the copies of one class each.  Inside a class
    the documents of the smallest hashes take the extra copies, found from the
    counts of hash ranges, so no class is ever sorted as a whole.

    The classes of a source stand in one task: they are as many as it has
    different sizes, whatever the number of its documents.

    A null source is a source of its own.  Documents of size 0 keep one copy
    (none of a constraint is at stake).  Rows with the same ``identity`` get
    the same copies.  An empty input gives an empty output.  Columns of
    ``docs`` named like an output column are replaced; all others stay.
    """
    named = ["size", "source_size", "target", "copies", "taken"]
    mine, per, gains = fresh([*docs.columns, *named], "mine", "per", "gains")
    key = F.coalesce(F.concat(F.lit("="), source), F.lit(""))  # never null: joins need no null-safe test
    slim = cut(docs.select(key.alias("key"), source.alias("source"), size.alias("size"),
                           identity.alias("mark"), F.shiftrightunsigned(identity, 64 - RANGE_BITS).alias("range")))
    ranges = cut(slim.groupBy("key", "size", "range").agg(F.count(F.lit(1)).alias("docs"),
                                                          F.first("source").alias("source")))
    classes = cut(ranges.groupBy("key", "size").agg(F.sum("docs").alias("docs"), F.first("source").alias("source"))
                  .repartition("key"))
    totals = classes.groupBy("key").agg(F.first("source").alias("source"),
                                        F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    classes = classes.drop("source")
    solved = tilted_rates(classes, source_targets(totals, weights, share, cap), cap)

    rate = F.when((F.col("dual") == float("inf")) & (F.col("size") > 0), float(cap)).otherwise(_rate(cap))
    down = Window.partitionBy("key").orderBy(F.desc("size"))  # one row a size
    part = F.col("docs") * (F.col("rate") - F.floor("rate"))
    here = F.floor(F.sum(part).over(down.rowsBetween(Window.unboundedPreceding, 0)) + 0.5)
    before = F.floor(F.coalesce(F.sum(part).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) + 0.5)
    copies = (classes.join(solved, "key").withColumn("rate", rate)
              .select("key", "size", "docs", "source_size", "target", F.least(
                  cap * F.col("docs"), F.col("docs") * F.floor("rate") + here - before).cast("long").alias("copies")))
    copies = _corrected(_corrected(copies, cap), cap)
    copies = cut(copies.select("key", "size", "source_size", "target", F.expr("copies div docs").cast("int").alias("base"),
                               F.expr("copies % docs").alias("extra")))

    # The hash up to which a class's documents get one copy more than the rest.
    some = copies.filter("extra > 0").select("key", "size", "extra")
    upto = Window.partitionBy("key", "size").orderBy("range")  # 256 rows at most
    picked = (ranges.select("key", "size", "range", "docs").join(some, ["key", "size"])
              .withColumn("below", F.sum("docs").over(upto) - F.col("docs"))
              .filter("below < extra and below + docs >= extra")
              .select("key", "size", "range", (F.col("extra") - F.col("below")).alias("nth")))
    by_hash = Window.partitionBy("key", "size", "range").orderBy("mark")  # 1/256 of a class
    bound = (slim.join(picked, ["key", "size", "range"]).withColumn("at", F.row_number().over(by_hash))
             .filter("at = nth").select("key", "size", F.col("mark").alias("most")))
    bounds = copies.drop("extra").join(bound, ["key", "size"], "left")

    got = bounds.select(F.struct("key", "size").alias(per),
                        F.struct("base", "most", "source_size", "target").alias(gains))
    rows = docs.withColumns({mine: F.struct(key.alias("key"), size.alias("size"), identity.alias("id"))})
    joined = rows.join(got, (rows[f"{mine}.key"] == got[f"{per}.key"]) & (rows[f"{mine}.size"] == got[f"{per}.size"]))
    sign = F.lit(-1 << 63)  # unsigned comparison of the hashes
    found = F.col(f"{gains}.base") + F.when(
        F.col(f"{mine}.id").bitwiseXOR(sign) <= F.col(f"{gains}.most").bitwiseXOR(sign), 1).otherwise(0)
    return joined.withColumns({
        "size": F.col(f"{mine}.size"), "source_size": F.col(f"{gains}.source_size"),
        "target": F.col(f"{gains}.target"), "copies": found, "taken": found * F.col(f"{mine}.size"),
    }).drop(mine, per, gains)
