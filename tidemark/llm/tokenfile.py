"""Token ids as Parquet files, with reads of single documents, of spans of tokens, and of lengths alone.

Documents are dealt into ranges of their order and sorted, one file a range.
A row holds a document's columns, its number of ids, the number of ids before
it in the file, and the ids as a list column.  Ids are dictionary encoded (a few
bits each, as a file uses few distinct ids); the ascending columns are delta
encoded.  Row groups have a fixed size, and pages a fixed number of rows with
an index of their least and greatest values, so a read of few documents or of a span skips
the pages of all others, and a read of lengths never touches the ids.  A small
table beside the files has one row a file: how many documents and ids it
has, and how many ids stand before it, which places each document in the
one long sequence of ids.

Texts are encoded by the tokenizers library's own model.  No token of a byte-level
tokenizer reaches over white space, but for one space at its start, so a text is cut there
and each part is encoded once as long as a worker keeps it.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

#: Bytes of a row group, rows of a page, and bytes after which a dictionary would give way to plain values.
ROW_GROUP_BYTES, PAGE_ROWS, DICTIONARY_BYTES = 32 << 20, 512, 4 << 20
#: Parts whose ids a worker keeps, twice: when full, those not used since the last time go; longer parts are not kept.
KEPT_PARTS, KEPT_CHARS = 3 << 17, 48


class PartEncoder:
    """Ids of whole texts as little-endian 32-bit integers, equal to the library's ``encode`` without special tokens."""

    def __init__(self, file: str):
        self.library = Tokenizer.from_file(file)
        self.model, self.split = self.library.model, self.library.pre_tokenizer.pre_tokenize_str
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # Special tokens in a text, and controls of which the two sides differ whether they are white space, need the library.
        self.odd = (*special, "\x1c", "\x1d", "\x1e", "\x1f")
        self.apart = re.compile(r" ?\S+|\s+(?!\S)|\s")
        self.space = re.compile(r"\s")
        self.plain = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")  # a word and a run of marks
        if [m for m, _ in self.split(" À")] != ["ĠÃĢ"]:
            raise ValueError("not a byte-level tokenizer")
        self.letter = {b: chr(b) for b in range(128)}  # the character that stands for a byte of a Latin letter
        for c in map(chr, range(0xC0, 0x100)):
            self.letter.update(zip(c.encode(), self.split(c)[0][0], strict=True))
        self.kept: dict[str, bytes] = {}  # of a space and the part
        self.older: dict[str, bytes] = {}
        self.starts: dict[str, bytes] = {}  # of the part alone, at the start of a line
        self.line = self.whole("\n")
        for text in ("ab cd", "a  b", "a \n b", "a\n\nb\n", " a\t b", "a's 's É, 1b  .\nx", "x" + " " * 9 + "y", "\n"):
            if self.encode(text) != self.whole(text):
                raise ValueError("not a byte-level tokenizer whose tokens end at white space")

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<i4").tobytes()

    def _ids(self, mapped: str) -> bytes:
        """Ids of one pre-token, in the characters that stand for its bytes."""
        return array("i", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _made(self, part: str, led: str) -> bytes:
        """Ids of ``part`` behind a space, if ``led``, or alone."""
        if part.isascii() and part.isalpha():
            return self._ids(led + part)
        plain = self.plain.fullmatch(part)
        if not plain:
            return b"".join([self._ids(piece) for piece, _ in self.split(" " + part if led else part)])
        if part[-1].isalpha():
            return self._ids(led + "".join([self.letter[b] for b in part.encode()]))
        word, marks = plain.groups()
        return (self._spaced(word) if led else self._start(word)) + self._start(marks)

    def _spaced(self, part: str) -> bytes:
        """Ids of a space and the part, kept."""
        found = self.kept.get(part)
        if found is None:
            found = self.older.get(part) or self._made(part, "Ġ")
            if len(part) <= KEPT_CHARS:
                if len(self.kept) >= KEPT_PARTS:
                    self.kept, self.older = {}, self.kept
                self.kept[part] = found
        return found

    def _start(self, part: str) -> bytes:
        """Ids of a part that no space leads, kept."""
        found = self.starts.get(part)
        if found is None:
            found = self._made(part, "")
            if len(part) <= KEPT_CHARS:
                if len(self.starts) >= KEPT_PARTS // 4:
                    self.starts.clear()
                self.starts[part] = found
        return found

    def _line(self, line: str) -> bytes | None:
        """Ids of a line whose white space is single spaces between parts, else none."""
        first, *parts = line.split(" ")
        found = list(map(self.kept.get, parts))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    part = parts[i]
                    if not part.isalpha() and (not part or self.space.search(part)):
                        return None
                    found[i] = self._spaced(part)
        if first not in self.starts and (not first or self.space.search(first)):
            return None
        return self._start(first) + b"".join(found)

    def encode(self, text: str) -> bytes:
        if any(o in text for o in self.odd):
            return self.whole(text)
        lines = list(map(self._line, text.split("\n")))
        if None not in lines:  # then each line end is a token
            return self.line.join(lines)
        return b"".join([self._made(p, "") if p.isspace() else self._spaced(p[1:]) if p[0] == " " else self._start(p)
                         for p in self.apart.findall(text)])


_ENCODERS: dict[str, PartEncoder] = {}


def encoder(file: str) -> PartEncoder:
    """The worker's encoder for a tokenizer file."""
    if file not in _ENCODERS:
        _ENCODERS[file] = PartEncoder(file)
    return _ENCODERS[file]


#: Columns of the token files besides those that documents keep.
OWN = ("part", "before", "n_tokens", "ids")


def _encoded(tokenizer: str, end_id: int, rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of one file with ``part, before, n_tokens, ids`` for their last column, the text."""
    part, before = TaskContext.get().partitionId(), 0
    encode, end = encoder(tokenizer).encode, np.array([end_id], dtype="<i4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            some = batch.slice(at, rows)
            ids = [encode(t or "") + end for t in some.column(some.num_columns - 1).to_pylist()]
            n = np.fromiter((len(i) // 4 for i in ids), dtype=np.int64, count=len(ids))
            stops = np.concatenate([[0], np.cumsum(n)])
            lists = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.Array.from_buffers(
                pa.int32(), int(stops[-1]), [None, pa.py_buffer(b"".join(ids))]))
            yield pa.RecordBatch.from_arrays(
                [*some.columns[:-1], pa.array(np.full(n.size, part), pa.int32()), pa.array(before + stops[:-1]),
                 pa.array(n), lists], names=[*some.schema.names[:-1], *OWN])
            before += int(stops[-1])


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, path: str, order: Sequence[str] = ("doc_id",),
                 keep: Sequence[str] = ("doc_id",), text: str = "text", files: int | None = None) -> None:
    """Encode every whole text, with ``end_id`` behind it, and write the ids and the columns ``keep`` under ``path``.

    Documents ascend by the ``order`` columns (nulls first), then by a hash of the text, over the files and in each; documents equal
    in all of these follow each other in any order.  A null text counts as empty: the
    end id alone.  An empty table gives a folder without documents.  ``files`` is
    the number of ranges (the session's shuffle partitions), each of which one
    task writes.  Names of kept columns must differ from those in :data:`OWN`.

    ``path`` must not exist.  It gets ``tokens`` (the files) and ``parts`` (a row for
    each file, written last).
    """
    spark = docs.sparkSession
    if {c.lower() for c in keep} & set(OWN):
        raise ValueError(f"columns named like {OWN}")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [f"_order{i}" for i in range(len(order))]
    kept = [f"_keep{i}" for i in range(len(keep))]
    slim = docs.select(*[F.col(c).alias(s) for c, s in zip(order, sort, strict=True)],
                       *[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], F.col(text).alias("_text"),
                       F.xxhash64(text).alias("_hash"), F.monotonically_increasing_id().alias("_same"))
    keys = [*sort, "_hash", "_same"]  # the last spreads equal rows over ranges
    rows = slim.repartitionByRange(files, *keys).sortWithinPartitions(*keys).select(*kept, "_text")
    fields = [docs.select(c).schema[0].dataType for c in keep]
    schema = T.StructType([*[T.StructField(c, t) for c, t in zip(keep, fields, strict=True)],
                           T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    named = rows.toDF(*keep, "_text")
    writer = named.mapInArrow(partial(_encoded, tokenizer, end_id, 256), schema).write
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in ("before", "n_tokens", *order) if c in schema.names}
    writer.options(**{
        "compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": str(ROW_GROUP_BYTES),
        "parquet.page.row.count.limit": str(PAGE_ROWS), "parquet.dictionary.page.size": str(DICTIONARY_BYTES),
        **plain}).parquet(f"{path}/tokens")
    per = spark.read.parquet(f"{path}/tokens").groupBy("part").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens")).collect()  # a row for each file
    start, parts = 0, []
    for r in sorted(per):
        parts.append((r["part"], r["documents"], r["tokens"], start))
        start += r["tokens"]
    spark.createDataFrame(parts, "part int, documents long, tokens long, start long") \
        .coalesce(1).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """All documents with the kept columns, ``start`` (ids of all documents before), ``n_tokens`` and ``ids``.

    Without ``ids`` nothing of the id columns is read.  Filters on the columns
    in whose order the files are skip files, row groups and pages.
    """
    rows, parts = spark.read.parquet(f"{path}/tokens"), spark.read.parquet(f"{path}/parts")
    kept = [c for c in rows.columns if c not in OWN]
    placed = rows.join(parts.select("part", F.col("start").alias("_start")), "part")
    return placed.select(*kept, (F.col("_start") + F.col("before")).alias("start"), "n_tokens", *(["ids"] if ids else []))


def read_span(spark: SparkSession, path: str, first: int, stop: int) -> DataFrame:
    """``start, ids`` of the documents' parts that lie in ``[first, stop)`` of the one sequence of ids.

    Only the files and pages that hold such ids are read.
    """
    at = spark.read.parquet(f"{path}/parts").filter((F.col("start") < stop) & (F.col("start") + F.col("tokens") > first))
    found = at.agg(F.min("part"), F.max("part"), F.max("start")).first()
    rows = spark.read.parquet(f"{path}/tokens")
    if found[0] is None or first >= stop:
        return rows.select(F.col("before").alias("start"), "ids").limit(0)
    rows = rows.filter(F.col("part").between(found[0], found[1]) & (F.col("before") < stop))
    if found[0] == found[1]:  # inside one file the pages' index can tell
        rows = rows.filter((F.col("before") < stop - found[2]) & (F.col("before") + F.col("n_tokens") > first - found[2]))
    start = F.col("_start") + F.col("before")
    skip = F.greatest(F.lit(first) - start, F.lit(0)).cast("int")
    take = (F.least(F.lit(stop) - start, F.col("n_tokens")) - skip).cast("int")
    return (rows.join(at.select("part", F.col("start").alias("_start")), "part")
            .filter((start < stop) & (start + F.col("n_tokens") > first))
            .select((start + skip).alias("start"), F.slice("ids", skip + 1, take).alias("ids")))


def with_crc32(tokens: DataFrame, keep: Sequence[str], ids: str = "ids", to: str = "ids_crc32") -> DataFrame:
    """The columns ``keep`` and the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    slim = tokens.select(*keep, ids)
    schema = T.StructType([*[slim.schema[c] for c in keep], T.StructField(to, T.LongType())])
    return slim.mapInArrow(partial(_checked, [*keep, to]), schema)


def _checked(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), dtype="<i4")).cast("B")
        stops = lists.offsets.to_numpy()
        sums = [crc32(raw[4 * a:4 * b]) for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], names=names)
