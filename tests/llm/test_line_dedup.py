import random

from pyspark.sql import functions as F

from tidemark.llm.line_dedup import dedup_lines

SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    """(doc_id, text) -> text without later occurrences; rows in any order, ids distinct."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        if text is None:
            out[doc_id] = (None, 0, 0)
            continue
        lines = text.split("\n")
        word = [i for i, x in enumerate(lines) if x.strip(SPACE)]
        gone = set()
        for a, b, c in zip(word, word[1:], word[2:]):
            window = (lines[a], lines[b], lines[c])
            if window in seen:
                gone.update(range(a, c + 1))
            seen.add(window)
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def run(docs):
    return {r["doc_id"]: (r["text"], r["lines"], r["removed_lines"]) for r in dedup_lines(docs).collect()}


def test_random_lines(docs_of):
    pick = random.Random(2)
    rows = [(i, "\n".join(pick.choice(["a", "b", "c", "", " ", "d e"]) for _ in range(pick.randint(0, 9))))
            for i in range(150)]
    assert run(docs_of(rows)) == brute(rows)


def test_hot_passage(docs_of):
    """A passage in most documents, and copies: only the first one keeps it."""
    rows = [(i, f"own {i}\nx one\ny two\nz three\nown too {i}") for i in range(300)] + [(1000 + i, "p\nq\nr\ns") for i in range(200)]
    got = run(docs_of(rows))
    assert got == brute(rows)
    assert got[0][2] == 0 and got[7][0] == "own 7\nown too 7" and got[1001][0] == ""


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert run(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_awkward_rows(docs_of, awkward):
    out = dedup_lines(docs_of(awkward, {"lines": F.lit("x"), "doc": F.lit(1), "gone": F.lit(2), "covered": F.lit(3)})).collect()
    assert len(out) == len(awkward)
    assert all((r["doc"], r["gone"], r["covered"]) == (1, 2, 3) for r in out)
    by_text = {r["doc_id"]: r["text"] for r in out if r["doc_id"] in (2, 3, 4, 9)}
    assert by_text == {2: None, 3: "", 4: " \n\t ", 9: "\n\n\n\n"}
    assert [r["text"] for r in out if r["doc_id"] == 1] == ["one two three four"] * 2
    assert {r["text"] for r in out if r["doc_id"] == 7} == {"x\ny\nz", "another text of the same id"}
    assert dedup_lines(docs_of([])).collect() == []


def test_same_id_other_text(docs_of):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc\nd"), (None, "a\nb\nc\ne"), (1, "a\nb\nc")]
    out = sorted((r["text"], r["removed_lines"]) for r in dedup_lines(docs_of(rows)).collect())
    assert out.count(("", 3)) in (0, 2) and len(out) == 4
    assert sum(n for _, n in out) in (6, 9)  # the null id is first; both rows of one document agree


def brute_short(rows):
    """As ``brute``, where a document of one or two worded lines is one window; rows by id."""
    seen, out = set(), brute(rows)
    for doc_id, text in sorted(rows):
        lines = (text or "").split("\n")
        word = [i for i, x in enumerate(lines) if x.strip(SPACE)]
        if len(word) in (1, 2):
            window = tuple(lines[i] for i in word)
            if window in seen:
                gone = range(word[0], word[-1] + 1)
                out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
            seen.add(window)
    return out


def run_short(docs):
    return {r["doc_id"]: (r["text"], r["lines"], r["removed_lines"]) for r in dedup_lines(docs, short=True).collect()}


def test_short_documents(docs_of):
    """Copies of documents of one and two worded lines; one line twice is not that line."""
    rows = [(1, "p q"), (2, "p q\n \nr"), (3, "\np q\n"), (4, "p q\n\nr\n"), (5, "p q\np q"), (6, "p q\nr\ns"), (7, None), (8, "")]
    got = run_short(docs_of(rows))
    assert got == brute_short(rows)
    assert got[3] == ("\n", 3, 1) and got[4] == ("", 4, 3) and [got[i][2] for i in (1, 2, 5, 6, 7, 8)] == [0] * 6


def test_short_random(docs_of):
    pick = random.Random(3)
    rows = [(i, "\n".join(pick.choice(["a", "b", "c", "", " ", "d e"]) for _ in range(pick.randint(0, 6))))
            for i in range(200)]
    assert run_short(docs_of(rows)) == brute_short(rows)


def test_pipeline_short_copies(spark, docs_of):
    """The pipeline's stage finds whole copies of short documents."""
    import corpus_pipeline
    docs = docs_of([(1, "one long line"), (2, "one long line"), (3, "other")]).select(
        "doc_id", "text", F.lit("s").alias("source"), F.length("text").alias("n_chars"))
    out = corpus_pipeline.drop_repeated_lines(spark, docs, "")
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()} == {
        1: ("one long line", 13), 2: ("", 0), 3: ("other", 5)}


def test_many_equal_rows(spark):
    """50,000 equal rows: one short list of lines, and the same result for each."""
    from tidemark.llm.line_dedup import dedup_lines
    text = "a b\nc d\ne f\na b\nc d\ne f\nlast"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string").crossJoin(spark.range(50_000).drop("id"))
    other = spark.createDataFrame([(2, "a b\nc d\ne f\nown")], docs.schema)
    rows = dedup_lines(docs.unionByName(other)).groupBy("doc_id", "text", "removed_lines").count().collect()
    assert {tuple(r) for r in rows} == {(1, "a b\nc d\ne f\nlast", 3, 50_000), (2, "own", 3, 1)}


def test_many_lines(spark):
    """A document of 20,000 lines: work and memory grow with its lines, not with their square."""
    from tidemark.llm.line_dedup import dedup_lines
    text = "\n".join(f"line {i % 19_990}" for i in range(20_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert dedup_lines(docs).select("lines", "removed_lines").first() == (20_000, 10)
