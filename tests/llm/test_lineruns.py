"""Line dedup of the pipeline against brute force over repeated line runs."""

import random

import corpus_pipeline
import pytest
from virotide.llm import linededup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(texts):
    """Texts in order without the lines of each pair of lines that stands at an earlier place."""
    first, out = {}, []
    for d, t in enumerate(texts):
        lines, gone = t.split("\n"), set()
        for n in range(len(lines) - 1):
            at = first.setdefault((lines[n], lines[n + 1]), (d, n))
            if at != (d, n):
                gone |= {n, n + 1} - ({at[1], at[1] + 1} if at[0] == d else set())
        out.append("\n".join(x for n, x in enumerate(lines) if n not in gone))
    return out


@pytest.mark.parametrize("n", [2, 3, 4, 9])
def test_shared_passage_goes_whole(spark, n):
    texts = []
    for k in range(12):  # the same length, twelve different passages, each in two documents
        passage = [f"passage {k} line {i}" for i in range(n)]
        texts += ["\n".join([f"own {k} {side}", *passage, f"end {k} {side}"]) for side in "ab"]
    got = [r.text for r in corpus_pipeline.line_dedup(spark, spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], DOCS), "").orderBy("doc_id").collect()]
    assert got[0::2] == texts[0::2]
    assert got[1::2] == [f"own {k} b\nend {k} b" for k in range(12)]


def test_equal_lines_are_a_run(spark):
    run = "\n".join(["same"] * 58)
    texts = [run, "start\n" + run + "\nend", "a\n" + "\n".join(["twice"] * 3)]
    got = [r.text for r in linededup.remove_runs(spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], DOCS)).orderBy("doc_id").collect()]
    assert got == ["same\nsame", "start\nend", "a\ntwice\ntwice"]


def test_random_lines_against_brute_force(spark):
    rng = random.Random(5)
    texts = ["\n".join(f"l{rng.choice([0, 0, 1, 2, rng.randrange(200)])}" for _ in range(rng.randrange(1, 40))) for _ in range(80)]
    got = [r.text for r in linededup.remove_runs(spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], DOCS)).orderBy("doc_id").collect()]
    assert got == brute(texts)


def test_cases(spark):
    texts = [(3, None), (4, ""), (5, "x\n\nx"), (2, "p\nq\nz"), (None, "p\nq"), (2, "p\nq\nz"), (1, "p\nq")]
    frame = spark.createDataFrame([(i, t, "en", "s", None) for i, t in texts], DOCS).selectExpr("*", "doc_id AS hash", "doc_id AS n")
    out = linededup.remove_runs(frame)
    assert out.columns == frame.columns
    assert sorted((str(r.doc_id), r.text) for r in out.where("doc_id is null or doc_id <> 3").collect()) == [("1", "p\nq"), ("2", "z"), ("2", "z"), ("4", ""), ("5", "x\n\nx"), ("None", "")]
    assert [r.text for r in out.where("doc_id = 3").collect()] == [None]
    assert linededup.remove_runs(frame.limit(0)).count() == 0
    assert not any(x in out._jdf.queryExecution().toString() for x in ("Python", "Pandas", "Arrow"))
