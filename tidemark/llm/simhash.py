"""SimHash near-duplicates with pigeonring filtering.

A document's fingerprint has bit i set if more than half of its shingles' 64-bit
hashes have.  Two fingerprints link if they differ in at most ``distance`` (2)
of 64 bits; components of links are groups of near-duplicates.

Candidates.  The fingerprint is a ring of four segments of 16 bits.  If two
fingerprints differ in 2 bits at most, then from some segment on every chain of
l consecutive segments differs in no more than its share, l * 2 / 4 bits: 0 in
the first segment, 1 in the first two, 1 in the first three.  So the first
segment is equal, and so is the second or the third: fingerprints are indexed
by pairs of equal segments, and a pair found there must pass the chain test
from some segment on before its Hamming distance is computed.

An index entry with more than ``PAIRED`` fingerprints (a large group of near
copies) is not expanded into pairs.  Two fingerprints differ in at most 2 bits
exactly when they have a common neighbour within one bit of both, so there each
fingerprint meets the others at its 65 neighbours: 65 rows each, whatever the
size of the group, and exactly the same components.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial
from itertools import islice, repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import cut, fresh, from_texts, join_counted
from tidemark.llm.components import components

SEED = 42
DISTANCE = 2
SEGMENTS, SEGMENT_BITS = 4, 16
#: Bits that a chain of 1, 2 and 3 segments may differ in: floor(l * DISTANCE / SEGMENTS).
CHAIN = tuple(l * DISTANCE // SEGMENTS for l in range(1, SEGMENTS))
#: The largest index entry that is expanded into pairs.
PAIRED = 32
_BLOCK = 1 << 16


def fingerprint(text: str, width: int) -> int:
    """SimHash of the text's word shingles, as a signed 64-bit number.

    A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``; shingles are
    ``width`` words joined by one space, repeats included; a text of fewer words is
    one shingle; a text without words has fingerprint 0.
    """
    words = text.encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    if len(words) <= width:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(width)], strict=False))
    hashes = map(xxh64_intdigest, shingles, repeat(SEED))
    total, n = np.zeros(64, dtype=np.int64), 0
    while True:
        h = np.fromiter(islice(hashes, _BLOCK), dtype="<u8")
        if not h.size:
            break
        n += h.size
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0])


def _fingerprints(width: int) -> Callable[[list[str]], list[list[int]]]:
    return lambda texts: [[fingerprint(t, width) for t in texts]]


def hex16(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def _segment(bits: Column, i: int) -> Column:
    return F.shiftrightunsigned(bits, SEGMENT_BITS * (i % SEGMENTS)).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def _chained(differ: Column) -> Column:
    """Whether from some segment on every chain keeps to its share of differing bits."""
    passes = F.lit(False)
    for start in range(SEGMENTS):
        here, so_far = F.lit(True), F.lit(0)
        for step, most in enumerate(CHAIN):
            so_far = so_far + F.bit_count(_segment(differ, start + step))
            here = here & (so_far <= most)
        passes = passes | here
    return passes


def links(nodes: DataFrame) -> DataFrame:
    """``a, b``: edges whose components are those of all links between the distinct ``bits``."""
    pairs = [(i, j) for i in range(SEGMENTS) for j in range(i + 1, SEGMENTS)]
    keys = F.array(*[
        F.lit(k << 32).bitwiseOR(F.shiftleft(_segment(F.col("bits"), i), SEGMENT_BITS))
        .bitwiseOR(_segment(F.col("bits"), j)) for k, (i, j) in enumerate(pairs)])
    index = cut(nodes.select("bits", F.explode(keys).alias("key")))
    sizes = cut(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    shared = cut(join_counted(index, sizes, ["key"], "n", index.count()))

    small = shared.filter(F.col("n") <= PAIRED).select("key", "bits")
    other = small.withColumnRenamed("bits", "bits2")
    differ = F.col("bits").bitwiseXOR(F.col("bits2"))
    near = (small.join(other, "key").filter(F.col("bits") < F.col("bits2")).filter(_chained(differ))
            .filter(F.bit_count(differ) <= DISTANCE).select(F.col("bits").alias("a"), F.col("bits2").alias("b")))

    large = shared.filter(F.col("n") > PAIRED).select("bits").distinct()
    around = F.array(F.col("bits"), *[F.col("bits").bitwiseXOR(F.lit((1 << i) - ((1 << 64) if i == 63 else 0)))
                                      for i in range(64)])
    met = cut(large.select("bits", F.explode(around).alias("middle")))
    first = met.groupBy("middle").agg(F.min("bits").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    close = met.join(first, "middle").filter(F.col("bits") != F.col("b")).select(F.col("bits").alias("a"), "b")
    return near.unionByName(close)


def near_duplicates(docs: DataFrame, width: int, keep: Sequence[str] = (), doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``doc_id``, the columns ``keep``, ``bits`` (long), ``group`` (long) and ``component_id``, one row a row.

    ``group`` is the smallest fingerprint of the component, ``component_id`` its
    smallest doc_id (null only where all are null).  Null and empty texts have
    fingerprint 0 and link like any other.  Equal fingerprints are one node, so
    copies, however many, cost one row each.  An empty table gives an empty
    result.
    """
    if DISTANCE != 2:
        raise ValueError("the index and the common neighbours are made for a distance of 2")
    marked = cut(from_texts(docs, text, [doc_id, *keep], {"bits": "bigint"}, partial(_fingerprints, width)))
    nodes = cut(marked.groupBy("bits").agg(F.min(doc_id).alias("first"), F.count(F.lit(1)).alias("n")))
    linked = cut(components(links(nodes.select("bits"))))
    roots = cut(linked.join(nodes, linked["node"] == nodes["bits"]).groupBy("root")
                .agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("members")))
    named = join_counted(linked, roots, ["root"], "members", linked.count()).select(
        F.col("node").alias("bits"), F.col("root").alias("group"), "least")
    labels = cut(nodes.join(named, "bits", "left").select(
        "bits", "n", F.coalesce("group", "bits").alias("group"),
        F.when(F.col("group").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id")))
    return join_counted(marked, labels, ["bits"], "n", marked.count()).drop("n")


def one_of_each(docs: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, that of the smallest doc_id.

    Among rows with that doc_id (repeated rows) one of the smallest hash of
    doc_id and text stays.  All columns are returned, none is added.
    """
    high, low = fresh([*docs.columns, "bits", "group", "component_id"], "high", "low")
    two = [F.xxhash64(doc_id, text).alias(high), F.xxhash64(F.lit(1), doc_id, text).alias(low)]
    body = docs.select(doc_id, text, *two)
    found = near_duplicates(body, width, [high, low], doc_id, text)
    best = (found.filter(F.col(doc_id).eqNullSafe(F.col("component_id"))).groupBy("group")
            .agg(F.min(F.struct(high, low)).alias("best")).select(f"best.{high}", f"best.{low}"))
    marked = docs.select("*", *two).join(best, [high, low])
    return marked.dropDuplicates([high, low]).select(*docs.columns)
