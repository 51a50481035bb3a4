"""Readers, sinks, manifests, run parameters, streaming and composite plans."""

import gzip

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from virotide.config import RunParams, genome_attribute
from virotide.operators import longtable, report
from virotide.plans import derived, workflows
from virotide.sources import manifest, readers, sinks
from virotide.streaming.gates import run_per_batch, sample_stream

CALL_HEADER = "REGION\tPOS\tREF\tALT\tREF_DP\tREF_RV\tREF_QUAL\tALT_DP\tALT_RV\tALT_QUAL\tALT_FREQ\tTOTAL_DP\tPVAL\tPASS\tGFF_FEATURE\tREF_CODON\tREF_AA\tALT_CODON\tALT_AA\tPOS_AA"


def test_read_calls(spark, tmp_path):
    for name in ("s1", "s2"):
        row = "c\t100\tA\tC\t10\t5\t30\t90\t40\t35\t0.9\t100\t0\tTRUE\tNA\tATG\tM\tCTG\tL\t1"
        (tmp_path / f"{name}.tsv").write_text(f"{CALL_HEADER}\n{row}\n{row}\n")
    df = readers.read_calls(spark, str(tmp_path / "*.tsv"))
    assert df.count() == 4 and df.select("sample").distinct().count() == 2
    row = df.first()
    assert (row["pos"], row["alt_freq"], row["pass"], row["ref_codon"]) == (100, 0.9, True, "ATG")
    order = [tuple(r) for r in df.filter("sample = 's1'").select("src", "src2").collect()]
    assert order == sorted(order) and len(set(order)) == 2


def test_long_table_from_files(spark, tmp_path):
    (tmp_path / "S1.bcftools_query.txt").write_text("[1]CHROM\t[2]POS\t[3]REF\t[4]ALT\t[5]FILTER\t[6]S1:DP\t[7]S1:REF_DP\t[8]S1:ALT_DP\t\nc\t241\tC\tT\tPASS\t642\t375\t266\t\n")
    (tmp_path / "S1.snpsift.txt").write_text("CHROM\tPOS\tREF\tALT\tANN[*].GENE\tANN[*].EFFECT\tANN[*].HGVS_C\tANN[*].HGVS_P\nc\t241\tC\tT\torf\tmissense_variant\tc.1\tp.Ala5Val\n")
    (tmp_path / "S1.pangolin.csv").write_text("taxon,lineage\nS1,B.1.1.7\n")
    query = readers.read_query(spark, str(tmp_path / "*.bcftools_query.txt"))
    table = longtable.long_table(
        query, readers.read_effects(spark, str(tmp_path / "*.snpsift.txt")), "ivar",
        readers.read_lineages(spark, str(tmp_path / "*.pangolin.csv")), order=readers.ORDER,
    ).select(*longtable.LONG_COLUMNS)
    assert [tuple(r)[9:] for r in table.collect()] == [(0.41, "orf", "missense_variant", "c.1", "p.Ala5Val", "p.A5V", "ivar", "B.1.1.7")]
    assert sinks.write_long_table(table, str(tmp_path / "out"))
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text.startswith(b"\xef\xbb\xbfSAMPLE,CHROM,POS,REF,ALT,FILTER")
    assert text.decode("utf-8-sig").splitlines()[1].startswith("S1,c,241,C,T,PASS,642,375,266,0.41,orf")


def test_vcf_and_bed(spark, tmp_path):
    with gzip.open(tmp_path / "s.vcf.gz", "wt") as out:
        out.write("##fileformat\n#CHROM\tPOS\nc\t5\t.\tAT\tA\t.\tPASS\tTYPE=DEL\tGT:DP\t1:30\nc\t6\t.\tA\tC\t.\tPASS\tX=#1\tGT\t1\n")
    row = readers.read_vcf(spark, str(tmp_path / "*.vcf.gz")).collect()
    assert [(r["sample"], r["pos"], r["ref"]) for r in row] == [("s", 5, "AT")]
    (tmp_path / "p.bed").write_text("c\t1\t9\tn_LEFT\t1\t+\n")
    (tmp_path / "bad.bed").write_text("c\t1\t9\n")
    assert readers.read_bed(spark, str(tmp_path / "p.bed")).first()["end"] == 9
    assert readers.read_bed(spark, str(tmp_path / "bad.bed"), fields=3).first()["start"] == 1
    with pytest.raises(Exception, match="six BED fields"):
        readers.read_bed(spark, str(tmp_path / "bad.bed")).collect()


def test_fasta_and_fastq(spark, tmp_path):
    (tmp_path / "r.fa").write_text(">c1 first\nACGT\nAC\n>c2\nNN\n")
    got = readers.read_fasta(spark, str(tmp_path / "r.fa"))
    assert rows_of(got.select("contig", "description", "seq")) == [("c1", "c1 first", "ACGTAC"), ("c2", "c2", "NN")]
    assert readers.is_multi_fasta(got)
    with gzip.open(tmp_path / "s.fastq.gz", "wt") as out:
        out.write("@r1 x\nACGT\n+\n@III\n@r2\nGG\n+\n!!\n")
    fastq = readers.read_fastq(spark, str(tmp_path / "*.fastq.gz")).select("sample", "read_id", "seq", "qual")
    assert rows_of(fastq) == [("s", "r1", "ACGT", "@III"), ("s", "r2", "GG", "!!")]


def test_sam_hits_and_coverage(spark, tmp_path):
    (tmp_path / "s.sam").write_text("@SQ\tSN:c\tLN:9\nr1\t0\tc\t1\t60\t4M\t=\t9\t12\tACGT\tIIII\n")
    assert readers.read_sam(spark, str(tmp_path / "s.sam")).first()["mate_pos"] == 9
    (tmp_path / "h.txt").write_text("virus\t1\tq\ts\t99.1\t250\t1\t0\t1\t250\t1\t250\t0.0\t400\t900\t300\t83\n")
    assert report.filter_hits(readers.read_hits(spark, str(tmp_path / "h.txt"))).count() == 1
    (tmp_path / "a.regions.bed").write_text("c\t0\t9\tamp1\t4.0\t7\n")
    (tmp_path / "b.regions.bed").write_text("c\t0\t200\t3.5\n")
    got = readers.read_coverage(spark, str(tmp_path / "*.regions.bed"), ".regions.bed").select("sample", "region", "coverage")
    assert rows_of(got) == sorted([("a", "amp1", 4.0), ("b", None, 3.5)], key=str)


def test_yaml_documents(spark, tmp_path):
    (tmp_path / "multiqc_fastp.yaml").write_text("s1:\n  summary:\n    before_filtering:\n      total_reads: 12\n    after_filtering:\n      total_reads: 0\ns2:\n  summary:\n    before_filtering:\n      total_reads: 5\n")
    lines = readers.read_lines(spark, str(tmp_path / "*.yaml"), ".yaml").withColumnRenamed("sample", "document")
    leaves = readers.document_leaves(lines)
    out = report.metrics_table(leaves, report.SHORT_READ_VARIANTS, leaves.select("sample"))
    got = {r["sample"]: (r["# Input reads"], r["# Trimmed reads (fastp)"]) for r in out.collect()}
    assert got == {"s1": ("12", "NA"), "s2": ("5", "NA")}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", None)], "Sample string, n int")
    assert sinks.write_tsv(df, str(tmp_path / "t"), ["Sample"])
    assert "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))) == "Sample\tn\na\tNA\nb\t2\n"
    assert not sinks.write_tsv(df.limit(0), str(tmp_path / "none"), ["Sample"]) and not (tmp_path / "none").exists()
    lines = spark.createDataFrame([("s", "c", 9, "A", "C", "x"), ("s", "c", 2, "A", "C", "y")], "sample string, contig string, pos bigint, ref string, alt string, line string")
    sinks.write_vcf(lines, ["##a"], str(tmp_path / "v"), compression="none")
    text = "".join(p.read_text() for p in sorted((tmp_path / "v" / "sample=s").glob("part-*"))).splitlines()
    assert text[0] == "##a" and text[1].startswith("#CHROM") and text[2:] == ["y", "x"]
    parts = spark.createDataFrame([("s", "c", 1, "GG"), ("s", "c", 0, "AC")], "sample string, contig string, chunk bigint, seq string")
    sinks.write_fasta(parts, str(tmp_path / "f"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "f" / "sample=s").glob("part-*"))) == ">s c\nAC\nGG\n"


def test_manifest(spark, tmp_path):
    for barcode, reads in (("barcode01", 3), ("barcode2", 1), ("other", 4)):
        (tmp_path / barcode).mkdir()
        (tmp_path / barcode / "x.fastq").write_text("@r\nA\n+\nI\n" * reads)
    got = manifest.scan_folders(spark, str(tmp_path)).select("barcode", "count")
    assert rows_of(got) == [("barcode01", 3), ("barcode2", 1)]
    names = ["/d/S1_L2_R1_001.fastq.gz", "/d/S1_L1_R1_001.fastq.gz", "/d/S1_L1_R2_001.fastq.gz"]
    files = spark.createDataFrame([(n,) for n in names], "path string")
    assert rows_of(manifest.pair_fastq(files, sanitise=True)) == [("S1", names[1], names[2]), ("S1", names[0], "")]
    sheet = spark.createDataFrame([("a b", "x.fastq.gz")], "sample string, fastq_1 string")
    with pytest.raises(ValueError, match="sample"):
        manifest.checked_sheet(sheet)
    assert manifest.single_folder(spark, "/d").first()["barcode"] == "SAMPLE_1"


def test_run_parameters():
    assert RunParams.of({"platform": "illumina", "protocol": "amplicon"}).caller() == "ivar"
    assert RunParams.of({"platform": "illumina", "protocol": "metagenomic"}).caller() == "bcftools"
    for wrong in ({"platform": "x"}, {"platform": "illumina"}, {"platform": "nanopore"}, {"nonsense": 1}):
        with pytest.raises(ValueError):
            RunParams.of(wrong)
    genomes = {"g": {"fasta": "f", "primer_sets": {"artic": {"3": {"bed": "b"}}}}}
    assert genome_attribute(genomes, "g", "bed", "artic", 3) == "b"
    assert genome_attribute(genomes, "g", "fasta", "artic", 3) == "f"
    with pytest.raises(ValueError):
        genome_attribute(genomes, "h", "fasta")


def test_stream_upserts_samples(spark, tmp_path):
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "sample string, n bigint"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = sample_stream(spark, landing, schema)
        run_per_batch(stream, lambda b: b.groupBy("sample").agg(F.sum("n").alias("n")), target, str(tmp_path / "cp")).awaitTermination()

    arrive([("a", 1), ("a", 2), ("b", 5)])
    arrive([("a", 9)])
    assert rows_of(spark.read.parquet(target).select("sample", "n")) == [("a", 12), ("b", 5)]


def test_stream_does_not_depend_on_batches(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "out")
    for k in range(3):
        spark.createDataFrame([("a", 10**k), ("b", k)], "sample string, n bigint").coalesce(1).write.mode("append").parquet(str(landing))
    stream = sample_stream(spark, str(landing), "sample string, n bigint", files_per_trigger=1)
    run_per_batch(stream, lambda b: b.groupBy("sample").agg(F.sum("n").alias("n")), target, str(tmp_path / "cp")).awaitTermination()
    assert rows_of(spark.read.parquet(target).select("sample", "n")) == [("a", 111), ("b", 3)]


def test_stream_file_that_comes_again_replaces_its_rows(spark, tmp_path):
    import shutil

    schema, target = "sample string, n bigint", str(tmp_path / "out")
    for folder, rows in (("one", [("a", 1), ("a", 2)]), ("two", [("a", 5)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / folder))
        part = next((tmp_path / folder).glob("part-*.parquet"))
        (tmp_path / "in" / folder).mkdir(parents=True)
        shutil.copy(part, tmp_path / "in" / folder / "run.parquet")
        stream = sample_stream(spark, str(tmp_path / "in" / "*"), schema)
        run_per_batch(stream, lambda b: b.groupBy("sample").agg(F.sum("n").alias("n")), target, str(tmp_path / "cp")).awaitTermination()
    assert rows_of(spark.read.parquet(target).select("sample", "n")) == [("a", 5)]


def test_short_read_plan(spark):
    sf = "/root/testdata/sf0.001"
    aligned = derived.frame(spark, sf, "reads_aligned")
    calls = derived.frame(spark, sf, "calls").withColumnRenamed("total_dp", "dp")
    tables = {
        "aligned": aligned, "calls": calls, "contigs": aligned.groupBy("contig").agg((F.max("pos") + 30).alias("length")),
        "primers": derived.frame(spark, sf, "primers").withColumn("src2", F.lit(0)), "hits": derived.frame(spark, sf, "hits"),
    }
    params = RunParams.of({"platform": "illumina", "protocol": "amplicon", "min_mapped_reads": 500})
    out = workflows.short_read_plan(tables, params, min_read_length=10)
    passed = {r["sample"] for r in out["mapped_gate"].filter("gate = 'pass'").collect()}
    assert {r["sample"] for r in out["variant_counts"].collect()} == passed
    assert {"amplicons", "primer_trimmed", "coverage_windows", "assembly_hits"} <= set(out)
    # What was clipped no longer counts as depth.
    untrimmed = workflows.short_read_plan(tables, params.with_options(skip_ivar_trim=True, skip_variants=True))
    depth = [o["coverage_windows"].agg(F.sum("coverage")).first()[0] for o in (out, untrimmed)]
    assert 0 < depth[0] < depth[1]
    without = workflows.short_read_plan(tables, params.with_options(skip_variants=True, skip_mosdepth=True))
    assert "variants" not in without and "coverage_windows" not in without


def test_consensus_by_caller(spark):
    columns = "sample string, contig string, pos bigint, flag int, cigar string, seq string, qual string"
    rows = [("a", "c", 1, 0, "6M", "ACGTAC", "IIIIII")] * 3 + [("a", "c", 1, 0, "6M", "ACTTAC", "IIIIII")] * 27
    aligned, reference = spark.createDataFrame(rows, columns), spark.createDataFrame([("c", "ACGTACGT")], "contig string, seq string")
    params = RunParams.of({"platform": "illumina", "protocol": "metagenomic", "variant_caller": "bcftools"})
    called = workflows.likelihood_calls(aligned, reference)
    assert rows_of(called.select("pos", "ref", "alt", "ad", "dp")) == [(3, "G", "T", "3,27", 30)]
    out = workflows.consensus_by_caller(aligned, called, reference, params)
    assert [r["seq"] for r in out["consensus"].collect()] == ["ACTTACNN"]
    bases = workflows.consensus_by_caller(aligned, None, None, params.with_options(consensus_caller="ivar"))["consensus_bases"]
    assert "".join(r["base"] for r in bases.orderBy("pos").collect()) == "ACTTAC"
    for option in ("skip_consensus", "skip_variants"):
        assert workflows.consensus_by_caller(aligned, called, reference, params.with_options(**{option: True})) == {}


def test_long_read_plan(spark):
    folders = spark.createDataFrame([("b1", "/d/b1", 150), ("b2", "/d/b2", 50), ("b3", "/d/b3", 300)], "barcode string, dir string, count bigint")
    sheet = spark.createDataFrame([("b1", "one"), ("b2", "two"), ("b9", "nine")], "barcode string, sample string")
    rows = [("b1", f"r{i}", "A" * n, "I" * n) for i, n in enumerate([450] * 12 + [100])]
    reads = spark.createDataFrame(rows, "sample string, read_id string, seq string, qual string")
    out = workflows.long_read_plan({"folders": folders, "sheet": sheet, "reads": reads}, RunParams.of({"platform": "nanopore", "fastq_dir": "/d"}))
    assert rows_of(out["fail_barcode_reads"]) == [("two", 50)]
    assert [r["barcode"] for r in out["no_sample"].collect()] == ["b3"] and [r["sample"] for r in out["no_barcode"].collect()] == ["nine"]
    assert rows_of(out["pooled_gate"].select("sample", "count", "gate")) == [("one", 12, "pass")]


def test_consensus_plan(spark):
    schema = "sample string, contig string, pos bigint, ref string, alt string, alt_freq double, src bigint"
    called = spark.createDataFrame([("s", "c", 3, "G", "T", 0.9, 0), ("s", "c", 5, "A", "C", 0.5, 1)], schema)
    depth = spark.createDataFrame([("s", "c", p, 3 if p > 6 else 40) for p in range(1, 9)], "sample string, contig string, pos bigint, depth bigint")
    reference = spark.createDataFrame([("c", "ACGTACGT")], "contig string, seq string")
    out = workflows.consensus_plan(called, depth, reference, "ivar", order=("src",))
    assert rows_of(out["mask"].select("start", "end")) == [(6, 8)]
    assert [r["seq"] for r in out["consensus"].collect()] == ["ACTTACNN"]
