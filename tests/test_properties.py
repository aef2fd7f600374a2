"""Property tests of the scalar helpers against plain-Python references."""

import datetime as dt
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions.keys import row_key
from tidemark.functions.labels import HOUR_LABEL, TEN_MINUTE_LABEL, window_label
from tidemark.operators.compact import top1_desc

from pyspark.sql import functions as F

text = st.one_of(st.none(), st.text(alphabet="ab|_x1é", max_size=6))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(text, text), min_size=1, max_size=30))
def test_row_key_matches_reference(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r.k for r in df.select(row_key(["a", "b"]).alias("k")).collect()]
    want = []
    for a, b in pairs:
        j = ("" if a is None else a) + "|" + ("" if b is None else b)
        want.append(hashlib.md5(j.encode("utf-8")).hexdigest()[:8] + "_" + j)
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.one_of(st.none(), st.integers(0, 2)),
                          st.text(alphabet="xyz", max_size=2)), min_size=1, max_size=40))
def test_top1_matches_sorted_reference(spark, rows):
    df = spark.createDataFrame(rows, "k int, a int, b int, c string")
    got = sorted(tuple(r) for r in top1_desc(df, ["k"], ["a", "b"]).collect())

    def key(r):  # descending, nulls last: a null sorts below every value
        return (r[1], (r[2] is not None, r[2] or 0), r[3])
    best = {}
    for r in rows:
        if r[0] not in best or key(r) > key(best[r[0]]):
            best[r[0]] = r
    assert got == sorted(best.values())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 1, 1)),
                min_size=1, max_size=30))
def test_window_labels_match_source_rule(spark, times):
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    hours = df.select(window_label(F.window("t", "1 hour"), HOUR_LABEL).alias("h")).collect()
    tens = df.select(window_label(F.window("t", "10 minutes"), TEN_MINUTE_LABEL).alias("m")).collect()
    for t, h, m in zip(times, hours, tens):
        s = t.strftime("%Y-%m-%d %H:%M:%S")
        assert h.h == s[:13]            # max(substring(date_format(t), 1, 13))
        assert m.m == s[:15] + "0"      # max(substring(.., 1, 15)) || '0'
