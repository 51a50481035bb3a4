"""Steps that must not move one row per base or per pair, and what they must still give."""

import random

from conftest import rows_of
from pyspark.sql import functions as F
from virotide.operators import alignments, channels, coding, consensus, intervals, primers

READS = "sample string, qname string, flag int, contig string, pos bigint, cigar string, seq string, qual string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def some_reads(spark, count=60, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        cigar, size = rng.choice([("20M", 20), ("3S17M", 20), ("8M2D12M", 20), ("10M3I7M", 20), ("9M40N11M", 20)])
        text = "".join(rng.choice("ACGT") for _ in range(size))
        codes = "".join(rng.choice("#5?I") for _ in range(size))
        rows.append((rng.choice("st"), f"r{i}", rng.choice([0, 16]), "c", rng.randint(970, 1040), cigar, text, codes))
    return spark.createDataFrame(rows, READS)


def test_bases_are_counted_where_reads_came_to(spark):
    reads = some_reads(spark)
    counts = alignments.pileup_counts(reads, tiles=True)
    # One exchange, of stretches; sites and chunks need no other.
    assert plan_of(counts).count("Exchange hashpartitioning") == 1
    bases = consensus.pileup_consensus(counts, min_depth=2)
    assert plan_of(consensus.chunk_text(bases, ["sample", "contig"], "base")).count("Exchange hashpartitioning") == 1
    seen = {}
    for r in reads.collect():
        at, place = r["pos"], 0
        for n, op in [(int(x[:-1]), x[-1]) for x in __import__("re").findall(r"\d+[MIDNS]", r["cigar"])]:
            if op == "M":
                for i in range(n):
                    seen.setdefault((r["sample"], at + i, r["seq"][place + i]), []).append(ord(r["qual"][place + i]) - 33)
            if op == "I":
                seen.setdefault((r["sample"], at - 1, "+" + r["seq"][place : place + n]), []).append(ord(r["qual"][place]) - 33)
            if op == "D":
                for i in range(n):
                    seen.setdefault((r["sample"], at + i, "*"), []).append(ord(r["qual"][place]) - 33)
            at, place = at + (n if op in "MDN" else 0), place + (n if op in "MIS" else 0)
    got = {(r["sample"], r["pos"], r["base"]): (r["n"], r["quality_sum"]) for r in counts.collect()}
    assert got == {k: (len(v), sum(v)) for k, v in seen.items()}


def test_segments_do_not_depend_on_tiles(spark):
    reads = some_reads(spark, 40)
    whole = rows_of(alignments.depth_segments(reads, width=1 << 20))
    assert rows_of(alignments.depth_segments(reads, width=16)) == whole
    cut = alignments.depth_segments(reads, width=16, merged=False)
    assert plan_of(cut).count("Exchange hashpartitioning") == 2
    assert rows_of(alignments.depth_positions(cut)) == rows_of(alignments.depth_positions(alignments.depth_segments(reads)))


def test_product_with_values(spark):
    left = spark.createDataFrame([(str(i),) for i in range(5)] + [(None,)], "sample string")
    right = spark.createDataFrame([("c", i // 3, i) for i in range(9)] + [(None, 0, 0)], "contig string, block int, at int")
    values = spark.createDataFrame([("1", "c", 0, 2, 7), ("4", "c", 2, 8, 9), (None, "c", 1, 4, 3)], "sample string, contig string, block int, at int, v int")
    got = rows_of(channels.product_with(left, right, values, ["contig", "block"], ["at"]).select("sample", "contig", "at", "v"))
    held = {(r["sample"], r["contig"], r["at"]): r["v"] for r in values.collect()}
    keys = [(a["sample"], b["contig"], b["at"]) for a in left.collect() for b in right.collect()]
    assert got == sorted([(*k, held.get(k)) for k in keys], key=str)


def test_low_segments_near_indels(spark):
    segments = spark.createDataFrame([("s", "c", 0, 40, 2), ("s", "c", 40, 50, 20), ("s", "c", 50, 90, 0)], "sample string, contig string, start bigint, end bigint, depth bigint")
    calls = spark.createDataFrame([("s", "c", 12, "ACG", "A", 1), ("s", "c", 60, "A", "ACC", 2)], "sample string, contig string, pos bigint, ref string, alt string, src int")
    by_base = alignments.depth_positions(segments.select("sample", "contig", "start", "end", "depth"))
    clean = lambda low: rows_of(intervals.merge_intervals(intervals.mask_without_indels(low, calls), ("sample", "contig")))
    assert clean(intervals.low_segments(segments, calls, 10, width=8)) == clean(intervals.low_coverage(by_base, 10))
    assert intervals.low_segments(segments, calls, 10, width=8).count() < 80


def test_clipping_is_worked_out_once(spark):
    """The length test must not be moved below the steps that it repeats."""
    bed = spark.createDataFrame([("c", 975, 990, "+")], "contig string, start bigint, end bigint, strand string")
    clipped = primers.clip_alignments(some_reads(spark).withColumn("qual", F.repeat(F.lit("I"), F.lit(20))), bed, min_length=10)
    text = clipped._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_extract_all") <= 8
    assert clipped.filter(F.col("has_primer")).count() > 0


def test_windows_of_a_null_sample(spark):
    """A null name meets no segment, as in the table's SQL."""
    segments = spark.createDataFrame([("s", "c", 0, 40, 2), (None, "c", 10, 20, 5)], "sample string, contig string, start bigint, end bigint, depth bigint")
    contigs = spark.createDataFrame([("c", 60)], "contig string, length bigint")
    got = rows_of(alignments.window_depth(segments, contigs, step=30).select("sample", "start", "coverage"))
    assert got == sorted([("s", 0, 2.0), ("s", 30, 20 / 30), (None, 0, 0.0), (None, 30, 0.0)], key=str)


def test_zero_depth_is_counted_without_gap_rows(spark):
    """Disjoint segments, an uncovered contig, a null sample: the sums that segments with filled gaps would give."""
    rows = [("a", "c", 3, 9, 2), ("a", "c", 9, 20, 5), ("a", "d", 0, 50000, 1), ("b", "d", 10, 11, 3), (None, "c", 5, 40, 7)]
    segments = spark.createDataFrame(rows, "sample string, contig string, start bigint, end bigint, depth bigint")
    contigs = spark.createDataFrame([("c", 40), ("d", 70000), ("e", 5)], "contig string, length bigint")
    got = alignments.filled_depth(segments, contigs)
    assert got.columns == ["sample", "contig", "positions", "below_3", "bases"]
    depths = {}
    for sample, contig, start, end, depth in rows:
        depths.setdefault((sample, contig), []).append((end - start, depth))
    want = []
    for sample in ("a", "b", None):
        for contig, length in (("c", 40), ("d", 70000), ("e", 5)):
            own = depths.get((sample, contig), [])
            want.append((sample, contig, length, length - sum(n for n, d in own if d >= 3), sum(n * d for n, d in own)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    # Gaps are made for null keys alone: without them the plan holds no break to match.
    named = segments.where("sample is not null").localCheckpoint()
    assert {tuple(r) for r in alignments.filled_depth(named, contigs).collect()} == {w for w in want if w[0]}


def test_regions_move_once(spark):
    """Medians and thresholds against every base; rows of a region follow each other, and its copies do not go through the driver."""
    rng = random.Random(4)
    cut = sorted(rng.sample(range(200), 24))
    rows = [(s, "c", a, b, rng.randint(1, 6)) for s in ("s", "t") for a, b in zip(cut[::2], cut[1::2])]
    spans = [("c", i * 9, i * 9 + 7 + i % 5, f"r{i}") for i in range(22)] + [("d", 3, 8, "far"), ("c", 5, 5, "none")]
    segments = spark.createDataFrame(rows, "sample string, contig string, start bigint, end bigint, depth bigint")
    regions = spark.createDataFrame(spans, "contig string, start bigint, end bigint, region string")
    names = spark.createDataFrame([("s",), ("t",), ("u",), (None,)], "sample string")
    got = alignments.region_depth(segments, regions, (0, 1, 3), samples=names)
    plan = plan_of(got)
    want = []
    for sample in ("s", "t", "u", None):
        at = {p: d for s, c, a, b, d in rows if s == sample for p in range(a, b)}
        for contig, a, b, region in spans:
            depths = sorted(at.get(p, 0) if contig == "c" else 0 for p in range(a, b))
            if depths:
                middle = (depths[(len(depths) - 1) // 2] + depths[len(depths) // 2]) / 2
                want.append((sample, contig, a, b, region, middle, *[sum(d >= t for d in depths) for t in (0, 1, 3)]))
    assert rows_of(got) == sorted(want, key=str)
    assert "SortMergeJoin [_slot" in plan
    # Only the frame's samples and the pairs; values move in no other step by sample.
    assert plan.count("Exchange hashpartitioning(sample") == 2


def test_edits_and_spans_move_once_to_their_block(spark):
    """Variants over a chunk border and a tile border, masks that overlap or come twice, null names: against a walk over bases."""
    text = "".join("ACGT"[i * 7 % 4] for i in range(17000))
    ref = spark.createDataFrame([("c", text)], "contig string, seq string")
    calls = [("s", "c", 9, text[8:12], "A"), ("s", "c", 11, text[10], "TT"), ("s", "c", 16383, text[16382:16386], "G"), ("s", "c", 16385, text[16384], "C"), ("t", "c", 5, text[4], "GA")]
    odd = [(None, "c", 3, "A", "T"), ("s", None, 3, "A", "T"), ("s", "c", None, "A", "T")]
    variants = spark.createDataFrame(calls + odd, "sample string, contig string, pos bigint, ref string, alt string")
    spans = [("s", "c", 6, 14), ("s", "c", 12, 25), ("s", "c", 6, 14), ("u", "c", 0, 3), (None, "c", 0, 9)]
    mask = spark.createDataFrame(spans, "sample string, contig string, start bigint, end bigint")
    got = consensus.apply_variants(variants, ref, width=10, mask=mask)
    texts = {}
    for r in got.orderBy("chunk").collect():
        texts[r["sample"]] = texts.get(r["sample"], "") + r["seq"]
    want = {}
    for sample in ("s", "t", "u", None):
        letters = list(text)
        for s, _, a, b in spans:
            if s == sample and s:
                letters[a:b] = "N" * (b - a)
        reach = 0
        for _, _, pos, old, new in sorted(c for c in calls if c[0] == sample):
            if pos > reach:
                letters[pos - 1 : pos - 1 + len(old)] = [new] + [""] * (len(old) - 1)
                reach = pos + len(old) - 1
        want[sample] = "".join(letters)
    assert texts == want
    plan = plan_of(got)
    assert "SortMergeJoin [_slot" in plan
    assert plan.count("Exchange hashpartitioning(sample") <= 7


def test_rows_of_a_right_row_follow_each_other(spark):
    left = spark.createDataFrame([(str(i),) for i in range(4)], "sample string")
    right = spark.createDataFrame([("c", 0, i) for i in range(6)], "contig string, block int, at int")
    values = spark.createDataFrame([("1", "c", 0, 2, 7)], "sample string, contig string, block int, at int, v int")
    seen = [r["at"] for r in channels.product_with(left, right, values, ["contig", "block"], ["at"], slots=1, runs=True).collect()]
    assert len(seen) == 24 and sum(a != b for a, b in zip(seen, seen[1:])) == 5


def test_calls_meet_the_reference_as_text(spark):
    """Positions that lack, repeat, are null or have more letters give what a join by position gives; no letter has a row of its own."""
    rows = [("s", "c", p, b, 6, 2, 180) for p in (1, 2, 999, 1000, 1001, 1500, 2003) for b in ("A", "G", "+TT")] + [("s", None, 1, "A", 9, 1, 300), ("s", "c", None, "A", 9, 1, 300)]
    counts = spark.createDataFrame(rows, "sample string, contig string, pos bigint, base string, n bigint, n_reverse bigint, quality_sum bigint")
    refs = [("c", 1, "A"), ("c", 2, "G"), ("c", 2, "T"), ("c", 999, "AC"), ("c", 1000, "C"), ("c", 1001, None), ("c", 2003, "T"), ("c", 2003, "T"), (None, 1, "C"), ("c", None, "C")]
    reference = spark.createDataFrame(refs, "contig string, pos bigint, ref string")
    got = alignments.call_variants(counts, reference, min_depth=3)
    want = []
    for contig, pos, ref in refs:
        here = [r for r in rows if contig and pos and ref and r[1] == contig and r[2] == pos]
        own = next((r for r in here if r[3] == ref), None)
        for r in here:
            if r[3] != ref:
                want.append(("s", contig, pos, ref, r[3], 6, 2, 30, 12, own[4] if own else 0, own[5] if own else 0, 30 if own else 0, 0.5))
    assert rows_of(got) == sorted(want, key=str)
    assert plan_of(got).count("_text") and "pos#" not in plan_of(got).split("Join", 1)[1].split("]", 1)[0]


def test_codons_do_not_send_the_reference_to_the_driver(spark):
    """Exploded rows are as many as positions, but count as few in the planner's guess."""
    parts = spark.createDataFrame([("c", 2, 10, "+", "t", "g", 0)], "contig string, start bigint, end bigint, strand string, transcript string, gene string, offset bigint")
    ends = spark.createDataFrame([("c", 12)], "contig string, last bigint")
    reference = ends.select("contig", F.explode(F.sequence(F.lit(1).cast("bigint"), "last")).alias("pos"), F.lit("A").alias("ref"))
    codons = coding.coding_codons(parts, reference)
    calls = spark.createDataFrame([("s", "c", 3, "A", "T")], "sample string, contig string, pos bigint, ref string, alt string")
    found = coding.codon_columns(calls, parts, codons)
    for plan in (plan_of(codons), plan_of(found)):
        assert "SortMergeJoin" in plan
    assert "BroadcastExchange" not in plan_of(codons)
    assert [tuple(r) for r in found.select("ref_codon", "alt_codon", "aa_pos").collect()] == [("AAA", "ATA", 1)]
