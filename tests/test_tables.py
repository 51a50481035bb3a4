"""Fixtures and brute-force checks of intervals, long table, gates, reports, sequences and reads."""

import random
from collections import Counter

import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from virotide.operators import alignments, channels, composition, consensus, gates, intervals, longtable, reads, report, tiles


def bed(spark, rows):
    return spark.createDataFrame(rows, "contig string, start bigint, end bigint")


# --- intervals -------------------------------------------------------------------------------------


def test_interval_merge_fixture(spark):
    df = bed(spark, [("c", 0, 5), ("c", 5, 9), ("c", 12, 14), ("c", 13, 20)])
    assert rows_of(intervals.merge_intervals(df)) == [("c", 0, 9), ("c", 12, 20)]


spans = st.lists(st.tuples(st.sampled_from(["c", "d"]), st.integers(0, 90), st.integers(1, 30)), min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spans)
def test_interval_merge_equals_coverage(spark, items):
    rows = [(c, s, s + n) for c, s, n in items]
    got = rows_of(intervals.merge_intervals(bed(spark, rows), width=8))
    covered = {(c, p) for c, s, e in rows for p in range(s, e)}
    assert {(c, p) for c, s, e in got for p in range(s, e)} == covered
    for (c1, _, e1), (c2, s2, _) in zip(sorted(got), sorted(got)[1:]):
        assert c1 != c2 or s2 > e1


def test_primer_collapse_fixture(spark):
    rows = [
        ("c", 30, 54, "amp_1_LEFT", "1", "+", 0), ("c", 385, 410, "amp_1_RIGHT", "1", "-", 1), ("c", 320, 342, "amp_2_LEFT", "2", "+", 2),
        ("c", 704, 726, "amp_2_RIGHT", "2", "-", 3), ("c", 25, 50, "amp_1_LEFT_alt", "1", "+", 4),
    ]
    df = spark.createDataFrame(rows, "contig string, start bigint, end bigint, name string, score string, strand string, src bigint")
    out = intervals.collapse_primers(df).select("contig", "start", "end", "name", "score", "strand")
    assert rows_of(out) == [("c", 25, 410, "amp_1", "1", "+"), ("c", 320, 726, "amp_2", "2", "+")]


def test_mask_fixture(spark):
    mask = spark.createDataFrame([("s", "c", p, p + 1) for p in (*range(99, 105), 199)], "sample string, contig string, start bigint, end bigint")
    calls = spark.createDataFrame(
        [("s", "c", 101, "ATGC", "A", 0), ("s", "c", 200, "A", "ATT", 1)], "sample string, contig string, pos bigint, ref string, alt string, src bigint"
    )
    kept = intervals.mask_without_indels(mask, calls)
    assert sorted(r["start"] for r in kept.collect()) == [99, 104, 199]


def test_overlaps_are_found_once(spark):
    rng = random.Random(3)
    left = [("c", s, s + rng.randint(1, 90)) for s in (rng.randint(0, 300) for _ in range(40))]
    right = [("c", s, s + rng.randint(1, 90)) for s in (rng.randint(0, 300) for _ in range(40))]
    got = intervals.overlapping(bed(spark, left), bed(spark, right), ["contig"], width=16)
    wanted = sorted((a[1], a[2], b[1], b[2]) for a in left for b in right if a[1] < b[2] and b[1] < a[2])
    assert sorted(tuple(r) for r in got.select("start", "end", "r_start", "r_end").collect()) == wanted
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()


def test_running_sum_across_tiles(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randint(0, 200), rng.randint(1, 9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, x bigint, v bigint")
    for descending in (False, True):
        got = tiles.running_sum(df, ["k"], "x", {"s": "v"}, width=16, descending=descending)
        for r in got.collect():
            side = (lambda x: x >= r["x"]) if descending else (lambda x: x <= r["x"])
            assert r["s"] == sum(v for k, x, v in rows if k == r["k"] and side(x))


def test_numbering_of_a_hot_key(spark):
    df = spark.createDataFrame([("hot" if i % 3 else "cold", f"f{i:05d}") for i in range(3000)], "k string, path string")
    got = channels.number_within(df, ["k"], ["path"]).collect()
    for key in ("hot", "cold"):
        ordered = sorted((r["path"], r["idx"]) for r in got if r["k"] == key)
        assert [i for _, i in ordered] == list(range(len(ordered)))


def test_salted_match_equals_plain(spark):
    left = spark.createDataFrame([(1 if i < 700 else i, i) for i in range(1000)], "k bigint, v bigint")
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 900)], "k bigint, w bigint")
    for how in ("inner", "left"):
        assert rows_of(channels.salted_match(left, right, ["k"], how, 8)) == rows_of(left.join(right, ["k"], how))
    assert [r["k"] for r in channels.hot_keys(left, ["k"], 8).collect()] == [1]


def test_match_all_keeps_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k bigint, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y"), (4, "z")], "k bigint, r string")
    assert rows_of(channels.match_all(left, right, ["k"])) == sorted(
        [(1, "a", "x"), (None, "b", "y"), (3, "c", None), (4, None, "z")], key=str
    )


def test_default_row(spark):
    empty = spark.createDataFrame([], "a string")
    assert rows_of(channels.or_default(empty, a="none")) == [("none",)]
    assert rows_of(channels.or_default(spark.createDataFrame([("x",)], "a string"), a="none")) == [("x",)]


# --- long table ------------------------------------------------------------------------------------

EFFECT_SCHEMA = "sample string, contig string, pos bigint, ref string, alt string, gene string, effect string, hgvs_c string, hgvs_p string"


def test_effect_rows(spark):
    df = spark.createDataFrame(
        [
            ("s", "c", 1, "A", "C", "g1,g2", "upstream_gene_variant,downstream_gene_variant", "c1,c2", "p1,p2"),
            ("s", "c", 2, "A", "C", "g1,g2", "missense_variant,upstream_gene_variant", "c1,c2", "p.Ala5Val,."),
        ],
        EFFECT_SCHEMA,
    )
    got = [(r["pos"], r["gene"], r["hgvs_p_1letter"]) for r in longtable.effect_rows(df).orderBy("pos").collect()]
    assert got == [(1, "g1", "p1"), (1, "g1", "p1"), (2, "g1", "p.A5V")]
    assert longtable.effect_rows(df, repeat_neighbours=False).count() == 2


def test_long_table_join(spark):
    query = spark.createDataFrame(
        [("s", "c", 10, "A", "C", "PASS", 489, 6, 483), ("s", "c", 11, "A", "G", "PASS", 92, 63, 29)],
        "sample string, contig string, pos bigint, ref string, alt string, filter string, dp int, ref_dp int, alt_dp int",
    )
    effects = spark.createDataFrame(
        [("s", "c", 10, "A", "C", "g", "missense_variant", "c.1", "p.1"), ("s", "c", 99, "A", "C", "g", "stop_gained", "c.2", "p.2")], EFFECT_SCHEMA
    )
    lineages = spark.createDataFrame([("s", "B.1", 0), ("s", "B.2", 1)], "sample string, lineage string, src bigint")
    out = longtable.long_table(query, effects, "ivar", lineages)
    got = rows_of(out.select("sample", "pos", "af", "gene", "caller", "lineage"))
    assert got == sorted(
        [("s", 10, 0.99, "g", "ivar", "B.1"), ("s", 11, 0.32, None, "ivar", "B.1"), (None, 99, None, "g", "ivar", "B.1")], key=str
    )
    with pytest.raises(ValueError):
        longtable.long_table(query, effects, "other")


def test_more_than_two_allele_depths_fail(spark):
    df = spark.createDataFrame([("8,16,3", 27)], "ad string, dp int")
    with pytest.raises(Exception, match="more than two"):
        longtable.allele_depth_rows(df).collect()


# --- gates -----------------------------------------------------------------------------------------


def test_equal_count_is_in_neither_branch(spark):
    df = spark.createDataFrame([("a", 99), ("b", 100), ("c", 101)], "sample string, n int")
    assert rows_of(gates.count_gate(df, "n", 100).select("sample", "gate")) == [("a", "fail"), ("c", "pass")]


def test_reconciliation_fixture(spark):
    sheet = spark.createDataFrame([("01", "a"), ("02", "b")], "barcode string, sample string")
    folders = spark.createDataFrame([("02", 150), ("03", 100), ("04", 99)], "barcode string, count bigint")
    out = gates.reconcile_barcodes(sheet, folders).select("barcode", "sample", "outcome")
    assert rows_of(out) == sorted([("01", "a", "no_barcode"), ("02", "b", "both"), ("03", None, "no_sample")], key=str)


def test_mapped_reads_takes_the_last_matching_line(spark):
    lines = ["1000 + 0 in total", "900 + 0 mapped (90%)", "800 + 0 primary mapped (80%)", "5 + 0 paired"]
    df = spark.createDataFrame([("s", i, line) for i, line in enumerate(lines)], "sample string, src int, line string")
    assert rows_of(gates.mapped_reads(df)) == [("s", 800)]


# --- reports ---------------------------------------------------------------------------------------


def test_hit_filter_fixture(spark):
    rows = [("v", 250, 300, 999), ("v", 180, 200, 999), ("v", 210, 300, 999), ("a phage", 250, 300, 999), ("a Phage", 250, 300, 999)]
    df = spark.createDataFrame(rows, "stitle string, length int, qlen int, slen int")
    assert sorted(r["stitle"] for r in report.filter_hits(df).collect()) == ["a Phage", "v"]


def test_metrics_rules(spark):
    leaf = "document string, sample string, keys array<string>, places array<int>, value string"
    rows = [
        ("multiqc_fastp", "s1", ["summary", "before_filtering", "total_reads"], [1, 1, 1], "100"),
        ("multiqc_fastp", "s1", ["summary", "after_filtering", "total_reads"], [1, 2, 1], "90"),
        ("multiqc_fastp", "s2", ["summary", "before_filtering", "total_reads"], [1, 1, 1], "7"),
        ("multiqc_bcftools_stats", "s1", ["number_of_SNPs"], [1], "0.0"),
        ("multiqc_bcftools_stats", "other", ["number_of_SNPs"], [1], "5"),
        ("multiqc_pangolin", "s1", ["lineage"], [1], "a,b"),
    ]
    leaves = spark.createDataFrame(rows, leaf)
    valid = leaves.filter("document = 'multiqc_fastp'").select("sample")
    out = {r["sample"]: r for r in report.metrics_table(leaves, report.SHORT_READ_VARIANTS, valid).collect()}
    assert set(out) == {"s1", "s2"}
    assert (out["s1"]["# Input reads"], out["s1"]["# Trimmed reads (fastp)"]) == ("100", "90")
    assert (out["s1"]["# SNPs"], out["s1"]["Pangolin lineage"], out["s1"]["# INDELs"]) == ("NA", "a;b", "NA")
    free = report.metrics_table(leaves, report.SHORT_READ_VARIANTS)
    assert {r["sample"] for r in free.collect()} == {"s1", "s2", "other"}


def test_trim_document_names_and_pairs(spark):
    leaf = "document string, sample string, keys array<string>, places array<int>, value string"
    rows = [("multiqc_fastp", "s1", ["before_filtering", "total_reads"], [1, 1], "9"), ("multiqc_cutadapt", "s1_1", ["pairs_written"], [1], "21")]
    leaves = spark.createDataFrame(rows, leaf)
    out = report.metrics_table(leaves, report.SHORT_READ_ASSEMBLY, leaves.filter("sample = 's1'").select("sample"))
    assert [(r["sample"], r["# Trimmed reads (Cutadapt)"]) for r in out.collect()] == [("s1", "42")]


def test_nearer_key_wins_depth_first(spark):
    leaf = "document string, sample string, keys array<string>, places array<int>, value string"
    rows = [("d", "s", ["deep", "lineage"], [1, 1], "inner"), ("d", "s", ["lineage"], [9], "outer"), ("d", "t", ["a", "lineage"], [2, 1], "second"), ("d", "t", ["b", "lineage"], [1, 5], "first")]
    out = report.find_leaves(spark.createDataFrame(rows, leaf), [report.Metric("L", "d", ("lineage",))])
    assert rows_of(out.select("sample", "value")) == [("s", "outer"), ("t", "first")]


# --- sequences -------------------------------------------------------------------------------------


def test_composition_fixture(spark):
    df = spark.createDataFrame([("s", "ACNNNGTNN"), ("t", "AAXC")], "sample string, seq string")
    counts = {(r["sample"], r["place"]): (r["base"], r["freq"]) for r in composition.base_counts(df).collect()}
    assert [counts["s", i] for i in range(1, 6)] == [("A", 1), ("C", 1), ("T", 1), ("G", 1), ("N", 5)]
    assert counts["t", 3] == ("T", 0) and counts["t", 5] == (None, None) and counts["t", 6] == ("X", 1)
    runs = composition.letter_runs(df.filter("sample = 's'"))
    assert rows_of(runs) == [("s", 5, 3, 3), ("s", 9, 2, 8)]


def test_density_brute_force(spark):
    rng = random.Random(1)
    seq = "".join(rng.choice("ACGTN") for _ in range(300))
    df = spark.createDataFrame([("s", seq), ("short", "ACG")], "sample string, seq string")
    got = composition.base_density(df, k=11, width=32).filter("sample = 's'").orderBy("position").collect()
    for r in got:
        centre = min(max(r["position"], 6), len(seq) - 5)
        assert r["a_mean"] == seq[centre - 6 : centre + 5].count("A") / 11
    assert len(got) == 300


def test_density_counts_where_sequences_lie(spark):
    rng = random.Random(2)
    rows = [(name, "".join(rng.choice("ACGTN") for _ in range(n))) for name, n in (("a", 95), (None, 64), ("k", 11), ("b", 10), ("empty", 0))]
    rows += [("twice", "ACGT" * 9)] * 2 + [("gone", None)]
    df = spark.createDataFrame(rows, "sample string, seq string")
    got = composition.base_density(df, k=11, width=16)
    assert Counter(r.sample for r in got.collect()) == {"a": 95, None: 64, "k": 11, "b": 10, "twice": 72}
    for name, seq in rows[:3]:
        for r in got.filter(F.col("sample").eqNullSafe(name)).collect():
            first = min(max(r.position - 6, 0), len(seq) - 11)
            assert [r.a_mean, r.g_mean] == [seq[first : first + 11].count(b) / 11 for b in "AG"]
    assert {r.a_mean for r in got.filter("sample = 'b'").collect()} == {None}
    # Only rows of keys that occur twice go through a window.
    assert len(got.filter("sample = 'twice'").select("position").distinct().collect()) == 36
    single = composition._density_in_place(df.filter("sample = 'a'"), ["sample"], "ACTG", 11, 16)
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString()


def test_n50(spark):
    df = spark.createDataFrame([("s", "A" * n) for n in (2, 3, 4, 5, 6, 10)], "sample string, seq string")
    row = composition.assembly_stats(df, width=4).first()
    assert (row["contigs"], row["largest_contig"], row["total_length"], row["n50"]) == (6, 10, 30, 6)


def brute_apply(reference, changes):
    out, skip = "", 0
    for i, base in enumerate(reference, 1):
        if skip:
            skip -= 1
        elif i in changes:
            ref, alt = changes[i]
            out += alt
            skip = len(ref) - 1
        else:
            out += base
    return out


def test_apply_variants_over_chunk_borders(spark):
    reference = "ACGTACGTACGTACGTACGT"
    changes = {3: ("G", "T"), 4: ("TACG", "T"), 6: ("C", "A"), 12: ("T", "TGG"), 20: ("T", "C")}
    rows = [("s", "c", p, r, a) for p, (r, a) in changes.items()]
    calls = spark.createDataFrame(rows, "sample string, contig string, pos bigint, ref string, alt string")
    ref = spark.createDataFrame([("c", reference)], "contig string, seq string")
    parts = consensus.apply_variants(calls, ref, width=5).orderBy("chunk").collect()
    del changes[6]  # inside the deletion
    assert "".join(r["seq"] for r in parts) == brute_apply(reference, changes)


def test_skipped_deletion_replaces_nothing(spark):
    """The second deletion starts inside the first and is skipped; what it would have covered is applied."""
    rows = [("s", "c", 2, "ABC", "A"), ("s", "c", 4, "CDE", "C"), ("s", "c", 6, "E", "x"), ("s", "c", 9, "H", "y")]
    out = consensus.applicable(spark.createDataFrame(rows, "sample string, contig string, pos bigint, ref string, alt string"))
    assert sorted(r["pos"] for r in out.collect()) == [2, 6, 9]


def test_interval_sequences(spark):
    ref = spark.createDataFrame([("c", "ACGT" * 600)], "contig string, seq string")
    rows = [("c", 0, 5, "a", "+"), ("c", 998, 1003, "b", "-")]
    spans_ = spark.createDataFrame(rows, "contig string, start bigint, end bigint, name string, strand string")
    got = {r["name"]: r["seq"] for r in consensus.interval_sequences(spans_, ref).collect()}
    text = "ACGT" * 600
    assert got == {"a": text[0:5], "b": text[998:1003][::-1].translate(str.maketrans("ACGT", "TGCA"))}


# --- alignments and reads --------------------------------------------------------------------------


def aligned(spark, rows):
    schema = "sample string, qname string, flag int, contig string, pos bigint, mapq int, cigar string, seq string, qual string, mate_pos bigint, tlen int"
    return spark.createDataFrame([("s", q, f, "c", p, 60, cg, sq, "I" * len(sq), 0, 0) for q, f, p, cg, sq in rows], schema)


def test_depth_and_gaps(spark):
    df = aligned(spark, [("a", 0, 3, "4M", "ACGT"), ("b", 0, 5, "2M3D2M", "ACGT"), ("c", 4, 1, "4M", "ACGT")])
    segments = alignments.depth_segments(df, width=2)
    assert rows_of(alignments.depth_positions(segments).select("pos", "depth")) == [
        (10, 1), (11, 1), (3, 1), (4, 1), (5, 2), (6, 2), (7, 1), (8, 1), (9, 1),
    ]
    contigs = spark.createDataFrame([("c", 13), ("empty", 4)], "contig string, length bigint")
    full = alignments.fill_gaps(segments, contigs)
    width = F.col("end") - F.col("start")
    assert rows_of(full.groupBy("contig").agg(F.sum(width), F.sum(width * F.col("depth")))) == [("c", 13, 11), ("empty", 4, 0)]


def test_pileup_with_indels(spark):
    df = aligned(spark, [("a", 0, 1, "1S2M1I2M", "GACTGG"), ("b", 16, 1, "2M2D1M", "ACG")])
    got = {(r["pos"], r["base"]): (r["n"], r["n_reverse"]) for r in alignments.pileup_counts(df).collect()}
    assert got == {
        (1, "A"): (2, 1), (2, "C"): (2, 1), (2, "+T"): (1, 0), (3, "G"): (1, 0), (4, "G"): (1, 0), (3, "*"): (1, 1), (4, "*"): (1, 1), (5, "G"): (1, 1),
    }


def test_duplicates(spark):
    rows = [("a", 0, 5, "4M", "ACGT"), ("b", 0, 7, "2S2M", "ACGT"), ("c", 16, 5, "4M", "ACGT"), ("d", 0, 6, "4M", "ACGT")]
    got = alignments.mark_duplicates(aligned(spark, rows)).filter(F.col("flag").bitwiseAND(1024) > 0)
    assert [r["qname"] for r in got.collect()] == ["b"]
    assert alignments.mark_duplicates(aligned(spark, rows), remove=True).count() == 3


def test_adapter_trim(spark):
    df = spark.createDataFrame([("a", "AATTACCCC", "IIIIIIIII"), ("b", "TTACCCC", "IIIIIII"), ("c", "GAATTACC", "IIIIIIII")], "read_id string, seq string, qual string")
    got = {r["read_id"]: (r["seq"], len(r["qual"])) for r in reads.trim_adapters(df, ["XAATTA"], overlap=3, min_length=1).collect()}
    assert got == {"a": ("CCCC", 4), "b": ("CCCC", 4), "c": ("GAATTACC", 8)}
    tail = reads.trim_adapters(df, ["TACC"], three_prime=True, overlap=3, min_length=1)
    assert {r["read_id"]: r["seq"] for r in tail.collect()} == {"a": "AAT", "b": "T", "c": "GAAT"}


def test_quality_trim(spark):
    qual = "!!" + "I" * 8 + "!!!"
    df = spark.createDataFrame([("s", "a", "ACGTACGTACGTA", qual)], "sample string, read_id string, seq string, qual string")
    row = reads.trim_reads(df, mean_quality=30, min_length=5, low_percent=20, poly=None).first()
    # Windows of four reach mean 30 with one "!" among three "I" at either end.
    assert (row["seq"], row["qual"]) == ("CGTACGTACG", "!IIIIIIII!")


def test_kmers(spark):
    df = spark.createDataFrame([("s", "ACGTACGT"), ("s", "NNNN")], "sample string, seq string")
    got = {r["kmer"]: r["abundance"] for r in reads.solid_kmers(df, 4, 1).collect()}
    # CGTA and TACG are reverse complements of each other.
    assert got == {"ACGT": 2, "CGTA": 2, "GTAC": 1}
