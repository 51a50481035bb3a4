"""Hand-computed fixtures of decoding and codon merging."""

import pytest
from conftest import rows_of

from virotide.operators import codons, variants

SCHEMA = (
    "sample string, contig string, pos bigint, ref string, alt string, ref_dp int, ref_rv int, ref_qual int, alt_dp int, "
    "alt_rv int, alt_qual int, alt_freq double, dp int, pass boolean, ref_codon string, alt_codon string, src bigint"
)


def calls(spark, rows):
    """(pos, ref, alt, alt_dp, alt_freq, ref_codon, alt_codon[, changes]) -> caller rows."""
    out = []
    for i, (pos, ref, alt, alt_dp, freq, ref_codon, alt_codon, *more) in enumerate(rows):
        row = {
            "sample": "s", "contig": "c", "pos": pos, "ref": ref, "alt": alt, "ref_dp": 100 - alt_dp, "ref_rv": 0,
            "ref_qual": 30, "alt_dp": alt_dp, "alt_rv": 0, "alt_qual": 30, "alt_freq": freq, "dp": 100, "pass": True,
            "ref_codon": ref_codon, "alt_codon": alt_codon, "src": i,
        }
        row |= more[0] if more else {}
        out.append(tuple(row.values()))
    return spark.createDataFrame(out, SCHEMA)


def merged(spark, rows, mode="consensus", **options):
    table = variants.decode_calls(calls(spark, rows), strand_test=False)
    run = codons.merge_consensus if mode == "consensus" else codons.merge_all_haplotypes
    return rows_of(run(table, **options).select("pos", "ref", "alt", "alt_freq", "merged_af", "merged_dp"))


ALL_HIGH = [(100, "A", "C", 90, 0.9, "ATG", "CTG"), (101, "T", "A", 92, 0.92, "ATG", "AAG")]
MIXED = [(100, "A", "C", 95, 0.95, "ATG", "CTG"), (101, "T", "A", 40, 0.4, "ATG", "AAG")]


@pytest.mark.parametrize("mode", ["consensus", "all"])
def test_all_high_members_merge(spark, mode):
    assert merged(spark, ALL_HIGH, mode) == [(100, "AT", "CA", 0.9, "0.9,0.92", "90,92")]


def test_mixed_frequencies(spark):
    assert merged(spark, MIXED) == [(101, "T", "A", 0.4, None, None)]
    assert merged(spark, MIXED, "all") == [(100, "AT", "CA", 0.4, "0.95,0.4", "95,40")]
    kept = merged(spark, MIXED, keep_high=True)
    assert [r[0] for r in kept] == [100, 101]


def test_neighbours_of_different_codons_stay(spark):
    same_text = [(102, "A", "C", 90, 0.9, "AAA", "AAC"), (103, "A", "C", 90, 0.9, "AAA", "CAA")]
    other_text = [(102, "A", "C", 90, 0.9, "AAA", "AAC"), (103, "G", "C", 90, 0.9, "GAA", "CAA")]
    for rows in (same_text, other_text):
        assert [r[:3] for r in merged(spark, rows, "all")] == [r[:3] for r in rows]


def test_gap_in_codon_stays(spark):
    rows = [(100, "A", "C", 90, 0.9, "ATG", "CTG"), (102, "G", "T", 90, 0.9, "ATG", "ATT")]
    assert [r[:3] for r in merged(spark, rows, "all")] == [r[:3] for r in rows]


def test_three_in_a_row(spark):
    rows = [
        (100, "A", "C", 90, 0.9, "ATG", "CTG"), (101, "T", "A", 90, 0.9, "ATG", "AAG"), (102, "G", "T", 90, 0.9, "ATG", "ATT"),
    ]
    assert merged(spark, rows) == [(100, "ATG", "CAT", 0.9, "0.9,0.9,0.9", "90,90,90")]


def test_two_alleles_at_one_position_give_two_paths(spark):
    rows = [
        (100, "A", "C", 90, 0.9, "ATG", "CTG"), (101, "T", "A", 90, 0.9, "ATG", "AAG"), (101, "T", "G", 80, 0.8, "ATG", "AGG"),
    ]
    assert [r[:3] for r in merged(spark, rows, "all")] == [(100, "AT", "CA"), (100, "AT", "CG")]


def test_conflicting_codon_is_skipped_and_the_rest_is_lost(spark):
    """The middle row changes two bases; what is left has no neighbours any more."""
    rows = [
        (100, "A", "C", 90, 0.9, "ATG", "CTG"), (101, "T", "A", 90, 0.9, "ATG", "AAC"), (102, "G", "T", 90, 0.9, "ATG", "ATT"),
    ]
    assert [r[:3] for r in merged(spark, rows, "all")] == [(101, "T", "A")]


def test_first_of_equal_rows_is_kept(spark):
    rows = [(100, "A", "C", 90, 0.9, None, None), (100, "A", "C", 70, 0.7, None, None)]
    assert [r[3] for r in merged(spark, rows)] == [0.9]


def test_equal_ref_and_alt_leaves_only_with_a_run(spark):
    odd = (500, "A", "A", 90, 0.9, None, None)
    assert len(merged(spark, [odd])) == 1
    assert [r[0] for r in merged(spark, [*ALL_HIGH, odd])] == [100]


def test_runs_across_tile_borders(spark):
    rows = [(p, "A", "C", 90, 0.9, "AAA", "CAA") for p in (6, 7, 8, 9, 12, 15, 16)]
    table = codons.candidates(variants.decode_calls(calls(spark, rows), strand_test=False))
    runs = {r["pos"]: r["run"] for r in codons.adjacent_runs(table, width=4).collect()}
    assert runs == {6: 6, 7: 6, 8: 6, 9: 6, 12: 12, 15: 15, 16: 15}


def test_allele_decoding(spark):
    rows = [(1, "A", "-TG", 90, 0.9, None, None), (2, "A", "+TG", 90, 0.9, None, None), (3, "A", "C", 90, 0.9, None, None)]
    out = variants.decode_calls(calls(spark, rows), strand_test=False).select("pos", "ref", "alt", "kind")
    assert rows_of(out) == [(1, "ATG", "A", "DEL"), (2, "A", "ATG", "INS"), (3, "A", "C", "SNP")]


def test_filter_labels(spark):
    rows = [
        (1, "A", "C", 90, 0.9, None, None, {"pass": False, "alt_qual": 19}),
        (2, "A", "C", 90, 0.9, None, None, {"alt_qual": 20}),
        (3, "A", "C", 12, 0.5, None, None, {"ref_dp": 12, "ref_rv": 2, "alt_dp": 12, "alt_rv": 9}),
    ]
    out = variants.decode_calls(calls(spark, rows)).select("pos", "filter")
    assert rows_of(out) == [(1, "ft;bq"), (2, "PASS"), (3, "sb")]
    kept = variants.decode_calls(calls(spark, rows), pass_only=True, strand_test=False)
    assert [r["pos"] for r in kept.orderBy("pos").collect()] == [2, 3]


def test_vcf_text_of_a_merged_row(spark):
    table = variants.decode_calls(calls(spark, ALL_HIGH), strand_test=False)
    line = variants.vcf_lines(codons.merge_consensus(table), merged=True).first()["line"]
    assert line.split("\t") == [
        "c", "100", ".", "AT", "CA", ".", "PASS", "TYPE=SNP",
        "GT:DP:REF_DP:REF_RV:REF_QUAL:ALT_DP:ALT_RV:ALT_QUAL:ALT_FREQ:MERGED_AF:MERGED_DP",
        "1:100:10:0:30:90:0:30:0.9:0.9,0.92:90,92",
    ]
    assert sum("MERGED" in h for h in variants.vcf_header([("c", 9)])) == 2


def test_candidates_move_once_to_their_runs(spark):
    """Joined to their tiles' summary, rows stay where the window put them; runs across tile borders hold together."""
    rows = [(s, "c", p) for s in "ab" for p in (1, 2, 3, 4, 5, 9, 12, 13, 16, 17)] + [("a", "d", 4)]
    frame = spark.createDataFrame(rows, "sample string, contig string, pos int")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = codons.adjacent_runs(frame, width=4)
        starts = {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 9: 9, 12: 12, 13: 12, 16: 16, 17: 16}
        assert {tuple(r) for r in runs.collect()} == {(s, c, p, starts[p] if c == "c" else 4) for s, c, p in rows}
        plan = runs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # Rows once, the summary's window and its way back.
    final = plan.split("== Initial Plan ==")[-1]
    assert final.count("Exchange hashpartitioning") == 4
