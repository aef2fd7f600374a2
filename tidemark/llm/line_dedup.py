"""Line dedup by overlapping three-line windows.

Every three consecutive lines of a document form a window; windows overlap.  A
window that stands in the corpus more than once is kept at its first occurrence
(by document id, then line); at every later one its three lines are covered.
The covered lines of all windows of a document are merged, and removed.  On
request, a document of fewer lines forms one window of all its lines, which
meets only windows of as many lines.

Windows are compared by 128 bits of hash, found by one aggregation over all
windows of the corpus, which combines in each task before its shuffle.  Texts
move once, to meet their covered lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, cut, fresh, join_counted

WIDTH = 3


def _windows(docs: DataFrame, key: Column, text: Column, width: int, short: bool) -> DataFrame:
    """``high, low, doc, line, last``: hash and place of each window, lines from 1."""
    word = f"[^{SPACE}]"
    lines = F.transform(F.split(text, "\n", -1), lambda x, i: F.when(x.rlike(word), F.struct(
        (i + 1).alias("at"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))))
    hashed = docs.select(key.alias("doc"), F.array_compact(lines).alias("lines"))
    n = F.size("lines")
    starts = F.when(n >= width, F.sequence(F.lit(1), n - (width - 1)))
    if short:
        starts = F.when(n.between(1, width - 1), F.array(F.lit(1))).otherwise(starts)
    fewer = F.when(n < width, n)  # hashes skip nulls

    def window(i: Column) -> Column:
        part = [F.get("lines", i + (k - 1)) for k in range(width)]
        return F.struct(
            F.xxhash64(*[p["a"] for p in part], fewer).alias("high"),
            F.xxhash64(F.lit(2), *[p["b"] for p in part], fewer).alias("low"), part[0]["at"].alias("line"),
            F.get("lines", F.least(i + (width - 1), n) - 1)["at"].alias("last"))

    # An array of windows, not one of lines beside each window: linear in the document's lines.
    return hashed.select("doc", F.inline(F.transform(starts, window))).select("high", "low", "doc", "line", "last")


def dedup_lines(docs: DataFrame, order: Sequence[str] = ("doc_id",), text: str = "text",
                width: int = WIDTH, short: bool = False) -> DataFrame:
    r"""``docs`` with ``text`` less the removed lines, and ``lines``, ``removed_lines`` (int).

    Lines are the \n-separated parts of the text, compared as they are.  Lines
    of white space alone are skipped by windows; they go only where they stand
    between the lines of a removed window.  Documents of fewer than ``width``
    other lines have no window and stay whole; with ``short`` they have one, of all
    their other lines, and lose them if an earlier such document has the same ones.

    The first occurrence is the one of the smallest ``order`` columns (nulls
    first), then the smallest hash of the text, then the first line; a repeat inside one
    document counts too.  Rows equal in ``order`` and text are one document:
    they get the same result.  A null text stays null, with no lines.  A
    document whose lines all go stays as a row, with an empty text if nothing
    is left.  Columns named like an output column are replaced; others stay.
    """
    key = F.struct(*order, F.xxhash64(text).alias("body"))
    windows = cut(_windows(docs, key, F.col(text), width, short))
    total = windows.count()
    found = windows.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"),
                                               F.min(F.struct("doc", "line")).alias("first"))
    repeated = cut(found.filter("n > 1"))
    later = join_counted(windows, repeated, ["high", "low"], "n", total) \
        .filter(F.struct("doc", "line") != F.col("first"))
    # Distinct first: equal rows have the same windows, so a document's list is as long as its lines.
    covered = later.select("doc", "line", "last").distinct().groupBy("doc").agg(F.array_distinct(F.flatten(
        F.collect_list(F.sequence("line", "last")))).alias("covered"))

    doc, lines, gone = fresh([*docs.columns, "lines", "removed_lines"], "doc", "lines_in", "gone")
    covered = covered.select(F.col("doc").alias(doc), F.col("covered").alias(gone))
    keyed = docs.withColumn(doc, key)
    same = keyed[f"{doc}.body"] == covered[f"{doc}.body"]
    for c in order:
        same = same & keyed[f"{doc}.{c}"].eqNullSafe(covered[f"{doc}.{c}"])
    joined = keyed.join(covered, same, "left").drop(doc).withColumn(lines, F.split(text, "\n", -1))
    left = F.when(F.col(gone).isNull(), F.col(lines)).otherwise(F.transform(
        F.array_except(F.sequence(F.lit(1), F.size(lines)), gone), lambda i: F.element_at(F.col(lines), i)))
    names = [c for c in docs.columns if c.lower() not in ("lines", "removed_lines")]
    return joined.withColumns({
        text: F.array_join(left, "\n"),
        "lines": F.when(F.col(lines).isNull(), 0).otherwise(F.size(lines)),
        "removed_lines": F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)),
    }).select(*names, "lines", "removed_lines")
