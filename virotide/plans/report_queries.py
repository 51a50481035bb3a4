"""Queries over long tables, report metrics, gates and manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from virotide.functions.text import AMINO_ACIDS
from virotide.operators import channels, gates, longtable, reads, report
from virotide.plans.derived import frame
from virotide.plans.registry import query, table
from virotide.plans.variant_queries import decoded, decoded_sql
from virotide.sources import manifest

# Effect lists as a function of the position; the same text serves both engines.
EFFECT_LISTS = [
    "case pos % 6 when 0 then 'orf1,orf2' when 1 then 'orf1,orf2' when 2 then 'S' when 3 then 'S' "
    "when 4 then 'N,ORF8' else 'E,M,N' end as gene",
    "case pos % 6 when 0 then 'missense_variant,upstream_gene_variant' "
    "when 1 then 'upstream_gene_variant,downstream_gene_variant' when 2 then 'synonymous_variant' "
    "when 3 then 'downstream_gene_variant' when 4 then 'missense_variant,synonymous_variant' "
    "else 'upstream_gene_variant,stop_gained,missense_variant' end as effect",
    "concat('c.', cast(pos as string), ref, '>', alt, case pos % 6 when 2 then '' when 3 then '' when 5 then ',c.2,.' "
    "else ',c.1' end) as hgvs_c",
    "concat('p.', case pos % 4 when 0 then 'Ala' when 1 then 'Ter' when 2 then 'Xaa' else 'Val' end, "
    "cast(pos as string), 'Gly', case pos % 6 when 2 then '' when 3 then '' when 5 then ',p.Lys9Ter,.' "
    "else ',p.Met1?' end) as hgvs_p",
]
EFFECTS = (
    "effects AS (SELECT sample, contig, pos, ref, alt, "
    + ", ".join(EFFECT_LISTS)
    + " FROM (SELECT DISTINCT sample, contig, CASE WHEN src % 8 = 1 THEN pos + 1000000 ELSE pos END AS pos, ref, alt FROM decoded))"
)
AMINO = "hgvs_p"
for _three, _one in AMINO_ACIDS:
    AMINO = f"replace({AMINO}, '{_three}', '{_one}')"
ONE_EFFECT = f"""
marked AS (SELECT *, list_filter(range(1, len(string_split(effect, ',')) + 1), lambda i:
    NOT contains(string_split(effect, ',')[i], 'upstream') AND NOT contains(string_split(effect, ',')[i], 'downstream')) AS own
  FROM effects),
spread AS (SELECT *, unnest(CASE WHEN len(own) > 0 THEN own
    ELSE list_transform(range(len(string_split(effect, ','))), lambda i: CAST(1 AS BIGINT)) END) AS i FROM marked),
single AS (SELECT sample, contig, pos, ref, alt, string_split(gene, ',')[i] AS gene, string_split(effect, ',')[i] AS effect,
    string_split(hgvs_c, ',')[i] AS hgvs_c, string_split(hgvs_p, ',')[i] AS hgvs_p FROM spread),
lettered AS (SELECT *, {AMINO} AS hgvs_p_1letter FROM single)
"""
LINEAGES = """
lineages AS (SELECT sample, arg_min(lineage, src) AS lineage FROM (
  SELECT 'S' || CAST(CAST(floor(c_custkey / 15) AS BIGINT) AS VARCHAR) AS sample, 'B.1.' || c_nationkey AS lineage, c_custkey AS src
  FROM customer) GROUP BY sample)
"""


def effects(spark, sf_dir):
    pos = F.when(F.col("src") % 8 == 1, F.col("pos") + 1000000).otherwise(F.col("pos")).alias("pos")
    keys = decoded(spark, sf_dir).select("sample", "contig", pos, "ref", "alt").distinct()
    return keys.selectExpr("sample", "contig", "pos", "ref", "alt", *EFFECT_LISTS)


def lineages(spark, sf_dir):
    number = F.floor(F.col("c_custkey") / 15).cast("string")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("S"), number).alias("sample"),
        F.concat(F.lit("B.1."), F.col("c_nationkey").cast("string")).alias("lineage"),
        F.when(F.col("c_nationkey") % 5 == 0, "").otherwise(F.col("c_mktsegment")).alias("clade"),
        F.col("c_custkey").alias("src"),
    )


def call_rows(spark, sf_dir):
    return decoded(spark, sf_dir).select("sample", "contig", "pos", "ref", "alt", "filter", "dp", "ref_dp", "alt_dp")


LONG_SQL = """
SELECT c.sample, coalesce(c.contig, e.contig) AS contig, coalesce(c.pos, e.pos) AS pos, coalesce(c.ref, e.ref) AS ref,
  coalesce(c.alt, e.alt) AS alt, c."filter", CAST(c.dp AS BIGINT) AS dp, {ref_dp} AS ref_dp, CAST(c.alt_dp AS BIGINT) AS alt_dp,
  round_even(c.alt_dp / c.dp, 2) AS af, e.gene, e.effect, e.hgvs_c, e.hgvs_p, e.hgvs_p_1letter,
  '{caller}' AS caller, l.lineage
FROM decoded c FULL OUTER JOIN lettered e ON c.sample = e.sample AND c.contig = e.contig AND c.pos = e.pos
  AND c.ref = e.ref AND c.alt = e.alt
LEFT JOIN lineages l ON l.sample = coalesce(c.sample, e.sample)
"""


def _long_sql(caller: str, ref_dp: str) -> str:
    body = LONG_SQL.format(caller=caller, ref_dp=ref_dp)
    return "WITH " + ",".join((decoded_sql(False), EFFECTS, ONE_EFFECT, LINEAGES)) + body


@query("long_table_ivar", _long_sql("ivar", "c.ref_dp"), inputs=("calls",))
def long_table_ivar(spark, sf_dir):
    """Flagship: calls x effects x lineages of all samples."""
    out = longtable.long_table(call_rows(spark, sf_dir), effects(spark, sf_dir), "ivar", lineages(spark, sf_dir))
    return out.select(*longtable.LONG_COLUMNS)


@query("long_table_allele_depth", _long_sql("bcftools", "CAST(c.ref_dp AS VARCHAR)"), inputs=("calls",))
def long_table_allele_depth(spark, sf_dir):
    rows = call_rows(spark, sf_dir).withColumn("ad", F.concat_ws(",", "ref_dp", "alt_dp")).drop("ref_dp", "alt_dp")
    out = longtable.long_table(rows, effects(spark, sf_dir), "bcftools", lineages(spark, sf_dir))
    return out.select(*longtable.LONG_COLUMNS)


@query(
    "strand_support_depths",
    """SELECT sample, contig, pos, src, src2, CAST(total_dp AS BIGINT) AS dp, CAST(ref_dp AS BIGINT) AS ref_dp,
         CAST(alt_dp AS BIGINT) AS alt_dp, round_even(alt_dp / total_dp, 2) AS af FROM calls""",
    inputs=("calls",),
)
def strand_support_depths(spark, sf_dir):
    calls = frame(spark, sf_dir, "calls")
    support = F.concat_ws(
        ",", F.col("ref_dp") - F.col("ref_rv"), F.col("ref_rv"), F.col("alt_dp") - F.col("alt_rv"), F.col("alt_rv")
    )
    keyed = calls.select("sample", "contig", "pos", "src", "src2", support.alias("strand_support"))
    return longtable.strand_support_rows(keyed)


@query(
    "allele_count_depths",
    """SELECT sample, contig, pos, src, src2, CAST(total_dp AS BIGINT) AS dp, CAST(ref_dp AS VARCHAR) AS ref_dp,
         CAST(alt_dp AS BIGINT) AS alt_dp, round_even(alt_dp / total_dp, 2) AS af FROM calls""",
    inputs=("calls",),
)
def allele_count_depths(spark, sf_dir):
    calls = frame(spark, sf_dir, "calls")
    keyed = calls.select(
        "sample", "contig", "pos", "src", "src2", F.col("total_dp").alias("dp"), F.concat_ws(",", "ref_dp", "alt_dp").alias("ac")
    )
    return longtable.allele_depth_rows(keyed, "ac")


@query(
    "effects_one_per_row",
    "WITH " + ",".join((decoded_sql(False), EFFECTS, ONE_EFFECT)) + "SELECT * FROM lettered",
    inputs=("calls",),
)
def effects_one_per_row(spark, sf_dir):
    return longtable.effect_rows(effects(spark, sf_dir))


@query("lineage_first_row", "WITH " + LINEAGES + "SELECT sample, lineage FROM lineages")
def lineage_first_row(spark, sf_dir):
    return longtable.lineage_of(lineages(spark, sf_dir))


@query(
    "clade_last_row",
    """SELECT sample, CASE WHEN clade = '' THEN 'NA' ELSE clade END AS clade FROM (
         SELECT 'S' || CAST(CAST(floor(c_custkey / 15) AS BIGINT) AS VARCHAR) AS sample,
           arg_max(CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE c_mktsegment END, c_custkey) AS clade
         FROM customer GROUP BY 1)""",
)
def clade_last_row(spark, sf_dir):
    return longtable.clade_of(lineages(spark, sf_dir))


@query(
    "sample_set_mismatch",
    """WITH a AS (SELECT DISTINCT l_suppkey AS s FROM lineitem), b AS (SELECT s_suppkey + 3 AS s FROM supplier)
       SELECT 'S' || coalesce(a.s, b.s) AS sample, CAST(1 AS BIGINT) AS inputs FROM a FULL OUTER JOIN b ON a.s = b.s
       WHERE a.s IS NULL OR b.s IS NULL""",
)
def sample_set_mismatch(spark, sf_dir):
    shifted = (F.col("s_suppkey") + 3).cast("string")
    effect_samples = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), shifted).alias("sample"))
    return longtable.sample_set_mismatch(frame(spark, sf_dir, "calls"), effect_samples)


# --- report metrics --------------------------------------------------------------------------------

LEAVES = """
leaves AS (SELECT 'u' || user_id AS sample, event_id, event_type AS t,
  CASE event_type WHEN 'signup' THEN 'B,' || CAST(json_extract_string(props, '$.k') AS VARCHAR)
    WHEN 'purchase' THEN CAST(CAST(floor(CAST(json_extract_string(props, '$.k') AS INT) / 40) AS BIGINT) AS VARCHAR)
    ELSE json_extract_string(props, '$.k') END AS v FROM events),
first AS (SELECT sample, t, arg_min(v, event_id) AS v FROM leaves GROUP BY sample, t),
wide AS (SELECT sample, max(v) FILTER (t = 'click') AS i, max(v) FILTER (t = 'view') AS a,
  max(v) FILTER (t = 'purchase') AS s, max(v) FILTER (t = 'error') AS n, max(v) FILTER (t = 'signup') AS p
  FROM first GROUP BY sample),
printed AS (SELECT sample, CASE WHEN i IS NULL OR i = '0' THEN 'NA' ELSE i END AS i, CASE WHEN a IS NULL OR a = '0' THEN 'NA' ELSE a END AS a,
  CASE WHEN s IS NULL OR s = '0' THEN 'NA' ELSE s END AS s, CASE WHEN n IS NULL OR n = '0' THEN 'NA' ELSE n END AS n,
  CASE WHEN p IS NULL THEN 'NA' ELSE replace(p, ',', ';') END AS p FROM wide)
"""


def leaves(spark, sf_dir):
    """Flattened report documents: one leaf per event."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    document = (
        F.when(kind.isin("click", "view"), "multiqc_fastp").when(kind == "purchase", "multiqc_bcftools_stats")
        .when(kind == "error", "multiqc_quast_quast_variants").otherwise("multiqc_pangolin")
    )

    def keys(*names):
        return F.array(*[F.lit(n) for n in names])

    path = (
        F.when(kind == "click", keys("summary", "before_filtering", "total_reads"))
        .when(kind == "view", keys("summary", "after_filtering", "total_reads"))
        .when(kind == "purchase", keys("number_of_SNPs"))
        .when(kind == "error", keys("# N's per 100 kbp"))
        .otherwise(keys("lineage"))
    )
    value = (
        F.when(kind == "signup", F.concat(F.lit("B,"), k))
        .when(kind == "purchase", (k.cast("int") / 40).cast("string"))
        .otherwise(k)
    )
    places = F.transform(path, lambda _, i: F.when(i == 0, F.col("event_id")).otherwise(F.lit(0).cast("bigint")))
    return events.select(
        document.alias("document"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("sample"),
        path.alias("keys"), places.alias("places"), value.alias("value"),
    )


_NA = {
    "i": "# Input reads", "a": "# Trimmed reads (fastp)", "s": "# SNPs", "n": "# Ns per 100kb consensus", "p": "Pangolin lineage",
}
_CELLS = ", ".join(
    {v: k for k, v in _NA.items()}.get(m.column, "'NA'") + f' AS "{m.column}"' for m in report.SHORT_READ_VARIANTS
)


@query("metrics_short_read_variants", "WITH " + LEAVES + f"SELECT sample, {_CELLS} FROM printed WHERE sample IN (SELECT sample FROM first WHERE t IN ('click', 'view'))")
def metrics_short_read_variants(spark, sf_dir):
    rows = leaves(spark, sf_dir)
    valid = rows.filter(F.col("document") == "multiqc_fastp").select("sample").distinct()
    return report.metrics_table(rows, report.SHORT_READ_VARIANTS, valid)


_LONG_CELLS = ", ".join(
    {"# SNPs": "s", "Pangolin lineage": "p"}.get(m.column, "'NA'") + f' AS "{m.column}"' for m in report.LONG_READ_VARIANTS
)


@query(
    "metrics_long_read_variants",
    "WITH " + LEAVES + f"SELECT sample, {_LONG_CELLS} FROM printed WHERE sample IN (SELECT sample FROM first WHERE t IN ('purchase', 'signup'))",
)
def metrics_long_read_variants(spark, sf_dir):
    """No valid-sample list: every key of the listed documents comes through."""
    return report.metrics_table(leaves(spark, sf_dir), report.LONG_READ_VARIANTS)


@query(
    "hit_filter",
    """SELECT * FROM (SELECT sample, stitle, qaccver, saccver, length, qlen, slen, CAST(format('{:.6g}', length / qlen) AS DOUBLE) AS contig_aligned,
         CAST(format('{:.6g}', length / slen) AS DOUBLE) AS reference_covered FROM hits)
       WHERE qlen > 200 AND contig_aligned > 0.7 AND stitle NOT LIKE '%phage%'""",
    inputs=("hits",),
)
def hit_filter(spark, sf_dir):
    return report.filter_hits(frame(spark, sf_dir, "hits"))


# --- coverage --------------------------------------------------------------------------------------


def coverage_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    region = F.concat(F.lit("pre_"), F.col("l_returnflag"), F.col("l_linestatus"))
    return rows.groupBy(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("sample"), region.alias("region")).agg(
        F.min("l_partkey").alias("start"), F.max("l_partkey").alias("end"), F.max("l_quantity").alias("coverage")
    )


COVERAGE = """
cov AS (SELECT 'S' || l_suppkey AS sample, l_returnflag || l_linestatus AS region, min(l_partkey) AS "start",
  max(l_partkey) AS "end", max(l_quantity) AS coverage FROM lineitem GROUP BY ALL)
"""


@query("coverage_merge", "WITH " + COVERAGE + "SELECT * FROM cov")
def coverage_merge(spark, sf_dir):
    return report.merge_coverage(coverage_rows(spark, sf_dir), "^pre_")


@query(
    "coverage_heatmap",
    "WITH "
    + COVERAGE
    + "SELECT sample, "
    + ", ".join(f"round(max(log10(coverage + 1)) FILTER (region = '{r}'), 6) AS \"{r}\"" for r in ("AF", "AO", "NF", "NO", "RF", "RO"))
    + " FROM cov GROUP BY sample",
)
def coverage_heatmap(spark, sf_dir):
    wide = report.heatmap(report.merge_coverage(coverage_rows(spark, sf_dir), "^pre_"), ("AF", "AO", "NF", "NO", "RF", "RO"))
    return wide.select("sample", *[F.round(F.col(c), 6).alias(c) for c in wide.columns if c != "sample"])


@query("coverage_heatmap_cells", "WITH " + COVERAGE + "SELECT sample, region, round(log10(coverage + 1), 6) AS value FROM cov")
def coverage_heatmap_cells(spark, sf_dir):
    cells = report.heatmap_cells(report.merge_coverage(coverage_rows(spark, sf_dir), "^pre_"))
    return cells.withColumn("value", F.round("value", 6))


# --- gates -----------------------------------------------------------------------------------------


@query(
    "gate_trimmed_reads",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS reads,
         CASE WHEN event_type <> 'error' AND CAST(json_extract_string(props, '$.k') AS BIGINT) > 0 THEN 'pass' ELSE 'fail' END AS gate
       FROM events""",
)
def gate_trimmed_reads(spark, sf_dir):
    """Read counts from trimming reports in JSON; a report without the count reads 0."""
    k = F.get_json_object("props", "$.k")
    stage = F.when(F.col("event_type") == "error", "other").otherwise("after_filtering")
    doc = F.format_string('{"summary":{"%s":{"total_reads":%s}}}', stage, k)
    rows = table(spark, sf_dir, "events").select("event_id", gates.trimmed_reads(doc).alias("reads"))
    return gates.strict_gate(rows, "reads", 0)


def flagstat_lines(spark, sf_dir):
    """Text lines as the flag counter prints them, one per order."""
    status = F.col("o_orderstatus")
    n = F.floor(F.col("o_totalprice") / 200).cast("string")
    text = F.when(status == "F", " + 0 mapped (98.21% : N/A)").when(status == "O", " + 0 primary mapped (97.00% : N/A)").otherwise(
        " + 0 in total (QC-passed reads + QC-failed reads)"
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("sample"), F.col("o_orderkey").alias("src"),
        F.concat(n, text).alias("line"),
    )


def customers(spark, sf_dir):
    """The sample list: all customers, also those without an order."""
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("sample"))


@query(
    "gate_mapped_reads",
    """SELECT sample, mapped, CASE WHEN mapped > 1000 THEN 'pass' ELSE 'fail' END AS gate FROM (
         SELECT 'S' || c_custkey AS sample, coalesce(arg_max(CAST(floor(o_totalprice / 200) AS BIGINT), o_orderkey), 0) AS mapped
         FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus IN ('F', 'O') GROUP BY 1)""",
)
def gate_mapped_reads(spark, sf_dir):
    """Every customer is a sample; those without orders, or without a hit in their text, count 0 and fail."""
    counts = gates.mapped_reads(flagstat_lines(spark, sf_dir), samples=customers(spark, sf_dir))
    return gates.strict_gate(counts, "mapped", gates.MIN_MAPPED_READS)


@query(
    "gate_mapped_fail_table",
    """SELECT sample AS "Sample", mapped AS "Mapped reads" FROM (
         SELECT 'S' || c_custkey AS sample, coalesce(arg_max(CAST(floor(o_totalprice / 200) AS BIGINT), o_orderkey), 0) AS mapped
         FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus IN ('F', 'O') GROUP BY 1) WHERE mapped <= 1000""",
)
def gate_mapped_fail_table(spark, sf_dir):
    counts = gates.mapped_reads(flagstat_lines(spark, sf_dir), samples=customers(spark, sf_dir))
    gated = gates.strict_gate(counts, "mapped", gates.MIN_MAPPED_READS)
    return gates.fail_table(gated, {"sample": "Sample", "mapped": "Mapped reads"})


@query(
    "gate_variant_records",
    """SELECT sample, records, CASE WHEN records > 0 THEN 'pass' ELSE 'fail' END AS gate FROM (
         SELECT 'S' || c_custkey AS sample, coalesce(arg_max(CAST(floor(o_totalprice / 200000) AS BIGINT), o_orderkey), 0) AS records
         FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus <> 'P' GROUP BY 1)""",
)
def gate_variant_records(spark, sf_dir):
    """The last count of each text; texts of other numbers only, and samples without a text, have 0."""
    n = F.floor(F.col("o_totalprice") / 200000).cast("string")
    kind = F.when(F.col("o_orderstatus") == "P", "number of samples:").otherwise("number of records:")
    lines = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("sample"), F.col("o_orderkey").alias("src"),
        F.concat(F.lit("SN\t0\t"), kind, F.lit("\t"), n).alias("line"),
    )
    return gates.strict_gate(gates.record_count(lines, samples=customers(spark, sf_dir)), "records", 0)


@query(
    "gate_barcode_reads",
    """SELECT * FROM (SELECT o_custkey AS barcode, count(*) AS "count", CASE WHEN count(*) > 10 THEN 'pass' WHEN count(*) < 10 THEN 'fail' END AS gate
       FROM orders GROUP BY 1) WHERE gate IS NOT NULL""",
)
def gate_barcode_reads(spark, sf_dir):
    """A count equal to the threshold is in neither branch."""
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("barcode")).agg(F.count(F.lit(1)).alias("count"))
    return gates.count_gate(counts, "count", 10)


@query(
    "gate_pooled_reads",
    """SELECT sample, "count", CASE WHEN "count" > 5 THEN 'pass' ELSE 'fail' END AS gate FROM (
         SELECT 'c' || conv_id AS sample, count(*) FILTER (length(text) BETWEEN 100 AND 700) AS "count" FROM conversations
         GROUP BY 1) WHERE "count" <> 5""",
)
def gate_pooled_reads(spark, sf_dir):
    """Samples none of whose reads has the length count 0 and fail."""
    pool = frame(spark, sf_dir, "reads")
    pooled = reads.pooled_reads(reads.length_filter(pool, 100, 700), samples=pool)
    return gates.count_gate(pooled, "count", 5)


@query(
    "gate_nonempty_contigs",
    """SELECT source AS sample, CAST(sum(length(regexp_replace(text, '[^ACGTacgt]', '', 'g'))) AS BIGINT) AS bases, 'pass' AS gate
       FROM documents GROUP BY 1""",
)
def gate_nonempty_contigs(spark, sf_dir):
    return gates.nonempty_contigs(frame(spark, sf_dir, "contigs"))


@query(
    "reconcile_barcodes",
    """WITH s AS (SELECT c_custkey * 2 AS barcode, c_name AS sample FROM customer),
         f AS (SELECT o_custkey AS barcode, count(*) AS n FROM orders GROUP BY 1)
       SELECT coalesce(s.barcode, f.barcode) AS barcode, sample, n AS "count",
         CASE WHEN s.barcode IS NULL THEN 'no_sample' WHEN f.barcode IS NULL THEN 'no_barcode' ELSE 'both' END AS outcome
       FROM s FULL OUTER JOIN f ON s.barcode = f.barcode WHERE s.barcode IS NOT NULL OR n >= 4""",
)
def reconcile_barcodes(spark, sf_dir):
    sheet = table(spark, sf_dir, "customer")
    sheet = sheet.select((F.col("c_custkey") * 2).alias("barcode"), F.col("c_name").alias("sample"))
    folders = table(spark, sf_dir, "orders")
    counts = folders.groupBy(F.col("o_custkey").alias("barcode")).agg(F.count(F.lit(1)).alias("count"))
    return gates.reconcile_barcodes(sheet, counts, 4)


@query(
    "manifest_endedness",
    """SELECT 'S' || o_custkey AS sample, count(*) AS runs, count(DISTINCT o_orderstatus = 'F') = 1 AS consistent,
         min(o_orderstatus = 'F') AS single_end FROM orders GROUP BY 1""",
)
def manifest_endedness(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("sample"), (F.col("o_orderstatus") == "F").alias("single_end")
    )
    return gates.endedness(runs)


@query(
    "manifest_sheet_errors",
    """SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_nationkey < 3 THEN 'sample' END, CASE WHEN c_nationkey BETWEEN 2 AND 6 THEN 'fastq_1' END,
         CASE WHEN c_nationkey BETWEEN 6 AND 8 THEN 'barcode' END], lambda x: x IS NOT NULL), ';') AS errors
       FROM customer WHERE c_nationkey <= 8""",
)
def manifest_sheet_errors(spark, sf_dir):
    nation = F.col("c_nationkey")
    sheet = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(nation < 3, F.concat(F.lit("my "), F.col("c_name"))).otherwise(F.col("c_name")).alias("sample"),
        F.when(nation.between(2, 6), F.concat(F.col("c_name"), F.lit("_R1.fastq"))).otherwise("/d/a_R1.fq.gz").alias("fastq_1"),
        F.when(nation.between(6, 8), "x1").otherwise("7").alias("barcode"),
    )
    return manifest.sheet_errors(sheet).select("c_custkey", F.array_join("errors", ";").alias("errors"))


def fastq_paths(spark, sf_dir):
    side = F.when(F.col("o_orderstatus") == "P", "_R2_001.fastq.gz").otherwise("_R1_001.fastq.gz")
    run = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    name = F.concat(F.lit("/runs/S"), F.col("o_custkey").cast("string"), F.lit("_"), run, side)
    return table(spark, sf_dir, "orders").select(name.alias("path"), "o_custkey", "o_orderkey")


@query(
    "manifest_pair_fastq",
    """WITH f AS (SELECT 'S' || o_custkey AS sample, o_orderstatus = 'P' AS two, '/runs/S' || o_custkey || '_' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')
           || CASE WHEN o_orderstatus = 'P' THEN '_R2_001.fastq.gz' ELSE '_R1_001.fastq.gz' END AS path FROM orders),
         n AS (SELECT *, row_number() OVER (PARTITION BY sample, two ORDER BY path) AS rn FROM f)
       SELECT a.sample, a.path AS fastq_1, coalesce(b.path, '') AS fastq_2 FROM n a
       LEFT JOIN n b ON b.two AND a.sample = b.sample AND a.rn = b.rn WHERE NOT a.two""",
)
def manifest_pair_fastq(spark, sf_dir):
    return manifest.pair_fastq(fastq_paths(spark, sf_dir).select("path"), sanitise=True)


@query(
    "manifest_group_tuple",
    """SELECT o_custkey AS sample, o_orderkey AS run, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS idx,
         count(*) OVER (PARTITION BY o_custkey) AS group_size,
         CAST((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) % 2 + 1 AS INT) AS mate FROM orders""",
)
def manifest_group_tuple(spark, sf_dir):
    """Runs grouped per sample in long form, and the mate each file of a paired list belongs to."""
    runs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("sample"), F.col("o_orderkey").alias("run"))
    return reads.mate_files(channels.group_tuple(runs, "sample", ["run"]))


@query(
    "manifest_folder_counts",
    """SELECT 'barcode' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS barcode, '/pass/barcode' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS dir,
         CAST(floor(sum(c_custkey) / 4) AS BIGINT) AS "count" FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY ALL""",
)
def manifest_folder_counts(spark, sf_dir):
    nation = manifest.barcode_name(F.col("c_nationkey"))
    kind = F.when(F.col("c_mktsegment") == "MACHINERY", ".txt").otherwise(".fastq.gz")
    files = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("/pass/"), nation, F.lit("/f"), F.col("c_custkey").cast("string"), kind).alias("path"), F.col("c_custkey").alias("lines")
    )
    return manifest.folder_counts(files)


# --- dataflow --------------------------------------------------------------------------------------


@query(
    "channel_match",
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey""",
)
def channel_match(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    runs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return channels.match(people, runs, ["c_custkey"])


@query(
    "channel_salted_match",
    """SELECT l_linenumber, l_returnflag, count(*) AS n, count(c.k) AS hits FROM lineitem
       LEFT JOIN (SELECT DISTINCT o_orderstatus AS k FROM orders) c ON l_linestatus = c.k GROUP BY ALL""",
)
def channel_salted_match(spark, sf_dir):
    """A join whose key has two values, each with half of all rows."""
    rows = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_returnflag", F.col("l_linestatus").alias("k"), "l_orderkey")
    kinds = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("k"), F.lit(1).alias("hit")).distinct()
    joined = channels.salted_match(rows, kinds, ["k"], "left", slots=16)
    return joined.groupBy("l_linenumber", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits"))


@query(
    "channel_match_all",
    """SELECT coalesce(c_custkey, k) AS c_custkey, c_name, n FROM (SELECT c_custkey * 3 AS c_custkey, c_name FROM customer)
       FULL OUTER JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = k""",
)
def channel_match_all(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 3).alias("c_custkey"), "c_name")
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return channels.match_all(people, counts, ["c_custkey"])


@query(
    "channel_with_value",
    """SELECT o_orderkey, o_totalprice, (SELECT max(o_totalprice) FROM orders) AS top FROM orders""",
)
def channel_with_value(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return channels.with_value(orders.select("o_orderkey", "o_totalprice"), orders.agg(F.max("o_totalprice").alias("top")), "top")


@query(
    "channel_mix_concat",
    """SELECT 0 AS part, o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION ALL
       SELECT 1, o_orderkey FROM orders WHERE o_totalprice > 200000 UNION ALL SELECT 2, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def channel_mix_concat(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    parts = [orders.filter("o_orderstatus = 'F'"), orders.filter("o_totalprice > 200000"), orders.filter("o_orderpriority = '1-URGENT'")]
    return channels.concat(*[p.select("o_orderkey") for p in parts]).select("part", "o_orderkey")


@query(
    "channel_branch",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice < 100000 THEN 'low' END AS branch
       FROM orders WHERE o_totalprice > 300000 OR o_totalprice < 100000""",
)
def channel_branch(spark, sf_dir):
    price = F.col("o_totalprice")
    return channels.branch(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), {"high": price > 300000, "low": price < 100000}).drop("o_totalprice")


@query(
    "channel_or_default",
    """WITH c AS (SELECT o_custkey AS k, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL), large AS (SELECT * FROM c WHERE n > 1000000)
       SELECT 'full' AS part, o_orderstatus, n FROM c UNION ALL SELECT 'empty', o_orderstatus, n FROM large
       UNION ALL SELECT 'empty', 'none', -1 WHERE NOT EXISTS (SELECT 1 FROM large)""",
)
def channel_or_default(spark, sf_dir):
    """Counts over all orders stay as they are; a selection of them that is empty gives the default row."""
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    parts = {"full": counts, "empty": counts.filter("n > 1000000")}
    filled = [channels.or_default(df, o_orderstatus="none", n=-1).select(F.lit(part).alias("part"), "o_orderstatus", F.col("n").cast("bigint").alias("n")) for part, df in parts.items()]
    return channels.mix(*filled)


@query(
    "channel_first",
    """SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1""",
)
def channel_first(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return channels.first_row(rows, ["o_orderkey"], ["o_custkey"])


@query("channel_unique", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def channel_unique(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey").distinct()


@query(
    "contig_difference",
    """SELECT DISTINCT o_custkey AS contig, o_custkey IN (SELECT c_custkey * 2 FROM customer) AS known FROM orders""",
)
def contig_difference(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("contig"))
    known = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("contig"))
    return channels.contig_difference(wanted, known)
