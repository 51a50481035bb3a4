"""Mates and amplicons on cases worked out by hand."""

import random

import pytest
from virotide.operators import amplicons, mates

PAIRS = "read_id string, seq1 string, qual1 string, seq2 string, qual2 string"
INSERT = "ACGTTGCAACGGTCATGCCATAGACCTTGAGTACGATCCGTAGGCTTAAC"  # 50 letters
TURN = str.maketrans("ACGTN", "TGCAN")


def turned(text):
    return text.translate(TURN)[::-1]


def merged(spark, *pairs):
    rows = [(str(n), a, q or (a and "I" * len(a)), b, r or (b and "I" * len(b))) for n, (a, q, b, r) in enumerate(pairs)]
    return [r.asDict() for r in mates.merge_mates(spark.createDataFrame(rows, PAIRS)).orderBy("read_id").collect()]


def test_places(spark):
    over, apart, back, none, empty = merged(
        spark, (INSERT[:40], None, turned(INSERT[8:]), None), (INSERT[:35], None, turned(INSERT[10:36]), None),
        (INSERT + "GATTACA", None, turned(INSERT) + "TTTT", None), (None, None, INSERT, None), ("", None, "", None),
    )
    assert (over["offset"], over["overlap"], over["errors"], over["merged"]) == (8, 32, 0, INSERT)
    assert apart["offset"] is None and apart["merged"] is None and apart["seq1"] == INSERT[:35]
    assert (back["offset"], back["overlap"], back["merged"]) == (-4, 50, INSERT)
    assert (back["seq1"], back["seq2"], len(back["qual1"]), len(back["qual2"])) == (INSERT, turned(INSERT), 50, 50)
    assert none["offset"] is None and none["seq2"] == INSERT and empty["merged"] is None


def test_correction(spark):
    wrong = INSERT[:20] + "G" + INSERT[21:]
    low = "I" * 20 + "#" + "I" * 29
    first, second, kept = merged(
        spark, (wrong, low, turned(INSERT), None), (INSERT, None, turned(wrong), low[::-1]), (wrong, None, turned(INSERT), None)
    )
    assert INSERT[20] == "T"
    assert [first["merged"], first["seq1"], first["qual1"], first["corrected"]] == [INSERT, INSERT, "I" * 50, 1]
    assert [second["merged"], second["seq2"], second["qual2"], second["corrected"]] == [INSERT, turned(INSERT), "I" * 50, 1]
    assert [kept["merged"], kept["corrected"], kept["errors"]] == [wrong, 0, 1]


def test_errors_allowed(spark):
    def edited(places):
        return "".join("N" if i in places else c for i, c in enumerate(INSERT))

    five, six = merged(spark, *[(INSERT, None, turned(edited(p)), None) for p in ({0, 7, 13, 22, 28}, {0, 7, 13, 22, 28, 40})])
    assert (five["errors"], six["offset"]) == (5, None)
    with pytest.raises(ValueError, match="errors"):
        mates.mate_overlap(spark.createDataFrame([], PAIRS), min_overlap=5)
    assert merged(spark) == []


def test_long_mates_against_every_place(spark):
    """Repetitive and random mates against all places; nothing is cut into a row or an array per letter."""
    rng, rows = random.Random(3), []
    for n in range(120):
        letters = "ACGT" if n % 3 else "AC"
        body = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 300)))
        other = "".join(c if rng.random() > 0.02 else rng.choice("ACGTNé") for c in body[rng.randrange(0, 40) :] + body[: rng.randrange(0, 30)])
        rows.append((str(n), body, "".join(rng.choice("I#5") for _ in body), turned(other), "".join(rng.choice("I#5") for _ in other)))
    frame = spark.createDataFrame(rows, PAIRS)
    got = {r.read_id: r for r in mates.merge_mates(frame).collect()}
    for name, one, _, two, _ in rows:
        back, want = turned(two), None
        for d in [*range(len(one)), *range(-1, -len(back), -1)]:
            a, b = one[max(d, 0) :], back[max(-d, 0) :]
            size = min(len(a), len(b))
            wrong = sum(x != y for x, y in zip(a, b))
            if size >= 30 and wrong <= min(5, size // 5):
                want = (d, size, wrong)
                break
        assert (got[name].offset, got[name].overlap, got[name].errors) == (want or (None, None, None))
        assert len(got[name].seq1) == len(got[name].qual1) and len(got[name].seq2) == len(got[name].qual2)
    plan = mates.merge_mates(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan and "split(" not in plan


SAM = "sample string, qname string, flag int, contig string, pos bigint, cigar string, seq string, qual string, name string"


def test_depth_is_even_and_repeats(spark):
    spans = spark.createDataFrame([("c", 0, 40, "long"), ("c", 5, 30, "short"), ("d", 0, 40, "long")], "contig string, start int, end int, name string")
    rows = [("a", f"r{n}", 16 * (n % 2), "c", 10, "10M", "A" * 10, "I" * 10, None) for n in range(500)]
    rows += [("a", "s", 0, "c", 3, "10M", "A" * 10, "I" * 10, "x"), ("a", "t", 0, "c", 35, "10M", "A" * 10, "I" * 10, None), ("a", "u", 4, None, None, None, "A", "I", None)]
    reads = spark.createDataFrame(rows, SAM)
    placed = {r.qname: r.amplicon for r in amplicons.assign_amplicons(reads, spans).collect()}
    assert placed["r1"] == "short" and placed["s"] == "long" and placed["t"] is None and "u" not in placed
    kept = amplicons.normalise_depth(reads, spans, depth=20)
    assert {(r.amplicon, r.flag): r["count"] for r in kept.groupBy("amplicon", "flag").count().collect()} == {("short", 0): 20, ("short", 16): 20, ("long", 0): 1}
    names = lambda df: sorted(r.qname for r in df.collect())
    assert names(kept) == names(amplicons.normalise_depth(reads.repartition(7), spans, depth=20, slots=3))
    assert names(kept) != names(amplicons.normalise_depth(reads, spans, depth=20, seed="1"))


def test_depth_takes_one_window(spark):
    """A group is cut down in each task before it moves; parts of groups are needed only where Spark does not do that."""
    spans = spark.createDataFrame([("c", 0, 40, "long")], "contig string, start int, end int, name string")
    reads = spark.createDataFrame([("a", f"r{n}", 0, "c", 10, "10M", "A" * 10, "I" * 10, None) for n in range(3000)], SAM)
    windows = lambda depth: amplicons.normalise_depth(reads, spans, depth=depth)._jdf.queryExecution().optimizedPlan().toString().count("Window [")
    assert (windows(20), windows(2000)) == (1, 2)
    few = sorted(r.qname for r in amplicons.normalise_depth(reads, spans, depth=900).collect())
    limit = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        assert len(few) == 900 and few == sorted(r.qname for r in amplicons.normalise_depth(reads, spans, depth=900).collect())
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)
