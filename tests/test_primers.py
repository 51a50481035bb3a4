"""Primer trimming, alignment clipping and genotype calls on cases worked out by hand."""

import pytest
from virotide.operators import genotypes, primers

READS = "read_id string, seq string, qual string"
BODY = "TTTTTGGGGGTTTTTGGGGGTTTTTGGGGG"


def trimmed(spark, adapters, texts, **options):
    frame = spark.createDataFrame([(str(n), t, t) for n, t in enumerate(texts)], READS)
    out = {r.read_id: r for r in primers.trim_tolerant(frame, adapters, min_length=1, **options).collect()}
    assert all(r.seq == r.qual for r in out.values())
    return [out[str(n)].seq if str(n) in out else None for n in range(len(texts))]


def test_errors_up_to_a_tenth(spark):
    primer = "ACGTACCATCAGACTACGAC"  # 20 letters: two errors
    wrong = [primer, primer[:5] + "N" + primer[6:], primer[:5] + primer[6:], primer[:9] + "G" + primer[9:], primer[:3] + "N" + primer[4:15] + primer[16:]]
    assert trimmed(spark, [f"X{primer}"], [w + BODY for w in wrong]) == [BODY] * 5
    three = "N" + primer[1:8] + "N" + primer[9:14] + "N" + primer[15:]
    assert trimmed(spark, [f"X{primer}"], [three[:-1] + "N" + BODY]) != [BODY]


def test_places_of_an_adapter(spark):
    texts = ["CATCAGACG" + BODY, "GG" + "ACGRCATCAGACG".replace("R", "A") + BODY, BODY, None, "", "AGACG" + BODY]
    assert trimmed(spark, ["XACGACATCAGACG"], texts) == [BODY, texts[1], BODY, None, None, BODY]
    assert trimmed(spark, ["ACGRCATCAGACG"], texts) == [BODY, BODY, BODY, None, None, BODY]
    turned = [t[::-1] if t else t for t in texts]
    assert trimmed(spark, ["ACGRCATCAGACG"[::-1]], turned, three_prime=True)[1] == BODY[::-1]
    assert trimmed(spark, [], [BODY]) == [BODY]


def test_too_many_spellings():
    assert primers.spellings("AR") == ["AA", "AG"]
    with pytest.raises(ValueError, match="spellings"):
        primers.spellings("N" * 7)


SAM = "sample string, qname string, flag int, contig string, pos bigint, cigar string, seq string, qual string"
BED = "contig string, start bigint, `end` bigint, strand string"


def clipped(spark, rows, bed, **options):
    frame = spark.createDataFrame([("s", str(n), f, "c", p, c, "A" * len(q), q) for n, (f, p, c, q) in enumerate(rows)], SAM)
    out = primers.clip_alignments(frame, spark.createDataFrame(bed, BED), **({"min_length": 1} | options)).collect()
    return {int(r.qname): (r.pos, r.cigar, r.has_primer) for r in out}


def test_clip_alignments(spark):
    good = "I" * 20
    rows = [
        (0, 10, "20M", good), (16, 10, "20M", good), (0, 10, "3M2D17M", good), (0, 10, "5M3I12M", good), (0, 10, "2H2S18M1H", good),
        (0, 100, "20M", "I" * 10 + "!" * 10), (16, 100, "20M", "!" * 10 + "I" * 10), (0, 100, "20M", "!" * 20), (4, 10, "20M", good), (0, 10, "4M20N16M", good),
    ]
    bed = [("c", 9, 14, "+"), ("c", 24, 30, "-")]  # bases 10 to 14, 25 to 30
    got = clipped(spark, rows, bed)
    assert got == {
        0: (15, "5S15M", True), 1: (10, "15M5S", True), 2: (15, "3S17M", True), 3: (15, "8S12M", True), 4: (15, "2H7S13M1H", True),
        5: (100, "9M11S", False), 6: (111, "11S9M", False), 9: (34, "4S16M", True),
    }
    assert set(clipped(spark, rows, bed, keep_without_primer=False)) == {0, 1, 2, 3, 4, 9}
    assert set(clipped(spark, rows, bed, min_length=13)) == {0, 1, 2, 4, 9}


def test_genotypes(spark):
    rows = [("s", "r", f, "c", 1, "2M", seq, "II") for f, seq in [(0, "AC"), (16, "AC"), (0, "AG"), (0, "TC")]]
    alleles = genotypes.allele_likelihoods(spark.createDataFrame(rows, SAM))
    hit, miss = genotypes.log_terms(40)
    got = {(r.pos, r.base): (r.n, r.n_reverse, r.dp, r.score) for r in alleles.collect()}
    assert got[1, "A"] == (3, 1, 4, 3 * hit + miss) and got[1, "T"] == (1, 0, 4, hit + 3 * miss)
    reference = spark.createDataFrame([("c", 1, "A"), ("c", 2, "T")], "contig string, pos bigint, ref string")
    (row,) = genotypes.call_haploid(alleles, reference, min_depth=4).collect()
    assert (row.pos, row.ref, row.alt, row.ref_dp, row.alt_dp) == (2, "T", "C", 0, 3)
    assert row.pl_ref == (3 * hit + miss - 4 * miss + 50000) // 100000
    assert genotypes.call_haploid(alleles, reference, min_depth=5).count() == 0


def test_reads_are_trimmed_where_they_lie(spark):
    """A long read with many seeds: no row per place, no shuffle, equal reads and nulls included."""
    adapter = "GATTACAGATTACCA"
    rows = [("a", "C" * 3000 + adapter + "T" * 40), ("a", "C" * 3000 + adapter + "T" * 40), ("b", adapter[:7] + "G" + adapter[8:] + "C" * 35),
            ("c", ("GATTA" + "C" * 5) * 200), ("d", None), ("e", "é" * 50)]
    reads = spark.createDataFrame([(i, s, s) for i, s in rows], "read_id string, seq string, qual string")
    out = primers.trim_tolerant(reads, [adapter])
    assert sorted((r.read_id, r.seq) for r in out.collect()) == [("a", "T" * 40), ("a", "T" * 40), ("b", "C" * 35), ("c", rows[3][1]), ("e", "é" * 50)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
