"""Plan shapes: no nested loops over rows, no window without a key, filters and columns at the scan."""

import re

import pytest

from virotide.operators import alignments, channels, intervals, longtable, report, variants
from virotide.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "long_table_ivar", "codon_merge_consensus", "mask_merged", "depth_regions", "region_variant_counts", "trim_primers",
        "interval_merge_contig", "channel_match_all", "reconcile_barcodes", "consensus_masked", "assembly_stats",
    ],
)
def test_joins_are_equi_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for window in re.findall(r"Window \[.*", plan):
        assert "windowspecdefinition(specifiedwindowframe" not in window


def parquet(spark, tmp_path, schema):
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_filters_reach_the_scan(spark, tmp_path):
    table = parquet(spark, tmp_path, "sample string, contig string, pos bigint, alt_freq double, note string")
    plan = plan_of(variants.consensus_variants(table, "ivar").select("sample", "pos"))
    assert "GreaterThanOrEqual(alt_freq,0.75)" in plan
    assert "note" not in re.search(r"ReadSchema: .*", plan).group(0)


def test_hit_filter_is_pushed(spark, tmp_path):
    table = parquet(spark, tmp_path, "stitle string, length int, qlen int, slen int, evalue double")
    plan = plan_of(report.filter_hits(table).select("stitle"))
    assert "GreaterThan(qlen,200)" in plan and "evalue" not in re.search(r"ReadSchema: .*", plan).group(0)


def test_narrow_operators_do_not_shuffle(spark, tmp_path):
    table = parquet(spark, tmp_path, "sample string, contig string, pos bigint, depth bigint, flag int")
    for df in (intervals.low_coverage(table), alignments.drop_unmapped(table)):
        assert "Exchange" not in plan_of(df)


def test_interval_merge_combines_before_its_shuffle(spark, tmp_path):
    table = parquet(spark, tmp_path, "contig string, start bigint, end bigint")
    assert "partial_max(end" in plan_of(intervals.merge_intervals(table))


def test_only_the_hot_key_list_is_broadcast_by_hint(spark):
    left = spark.range(10).withColumnRenamed("id", "k")
    logical = channels.salted_match(left, left.selectExpr("k", "k AS v"), ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in logical.lower()


def test_joined_long_table_stays_where_it_is(spark):
    """The table of samples is sent to all even if adaptive plans may not choose to: calls and effects move for their join alone."""
    calls = spark.createDataFrame([("s", "c", 1, "A", "T", "PASS", "9", "3", "6")], "sample string, contig string, pos int, ref string, alt string, filter string, dp string, ref_dp string, alt_dp string")
    effects = spark.createDataFrame([("s", "c", 1, "A", "T", "S", "stop", "c.1", "p.1")], "sample string, contig string, pos int, ref string, alt string, gene string, effect string, hgvs_c string, hgvs_p string")
    lineages = spark.createDataFrame([("s", "B.1", 1)], "sample string, lineage string, src int")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = longtable.long_table(calls, effects, "ivar", lineages)
        assert "BroadcastHashJoin [file_sample" in table._jdf.queryExecution().executedPlan().toString()
        assert [r.lineage for r in table.collect()] == ["B.1"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
