"""Report tables: per-sample metrics, hit filter, coverage tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virotide.functions.numbers import ratio, six_digits
from virotide.operators.channels import mix

# Fields that are cut to whole numbers.
INTEGER_FIELDS = (
    "mapped_passed",
    "number_of_SNPs",
    "number_of_indels",
    "MISSENSE",
    "# contigs (>= 0 bp)",
    "# contigs (>= 5000 bp)",
    "Largest contig",
)


@dataclass(frozen=True)
class Metric:
    """One report column: the document it comes from and the key path inside it."""

    column: str
    document: str
    path: tuple[str, ...]


def _metrics(*rows: tuple) -> tuple[Metric, ...]:
    return tuple(Metric(column, document, tuple(path)) for document, column, *path in rows)


# Report columns in their order, each with its document and keys.
SHORT_READ_VARIANTS = _metrics(
    ("multiqc_fastp", "# Input reads", "before_filtering", "total_reads"),
    ("multiqc_fastp", "# Trimmed reads (fastp)", "after_filtering", "total_reads"),
    ("multiqc_general_stats", "% Non-host reads (Kraken 2)", "preprocess_kraken_2-pct_unclassified"),
    ("multiqc_bowtie2", "% Mapped reads", "overall_alignment_rate"),
    ("multiqc_samtools_flagstat_samtools_bowtie2", "# Mapped reads", "mapped_passed"),
    ("multiqc_samtools_flagstat_samtools_ivar", "# Trimmed reads (iVar)", "flagstat_total"),
    ("multiqc_general_stats", "Coverage median", "variants_mosdepth-median_coverage"),
    ("multiqc_general_stats", "% Coverage > 1x", "variants_mosdepth-1_x_pc"),
    ("multiqc_general_stats", "% Coverage > 10x", "variants_mosdepth-10_x_pc"),
    ("multiqc_bcftools_stats", "# SNPs", "number_of_SNPs"),
    ("multiqc_bcftools_stats", "# INDELs", "number_of_indels"),
    ("multiqc_snpeff", "# Missense variants", "MISSENSE"),
    ("multiqc_quast_quast_variants", "# Ns per 100kb consensus", "# N's per 100 kbp"),
    ("multiqc_pangolin", "Pangolin lineage", "lineage"),
    ("multiqc_nextclade_clade", "Nextclade clade", "clade"),
)
ASSEMBLERS = (("SPAdes", "spades"), ("Unicycler", "unicycler"), ("minia", "minia"))
SHORT_READ_ASSEMBLY = _metrics(
    ("multiqc_fastp", "# Input reads", "before_filtering", "total_reads"),
    ("multiqc_cutadapt", "# Trimmed reads (Cutadapt)", "r_written"),
    ("multiqc_general_stats", "% Non-host reads (Kraken 2)", "preprocess_kraken_2-pct_unclassified"),
    *[
        (f"multiqc_quast_quast_{file}", column.format(name), key)
        for name, file in ASSEMBLERS
        for column, key in (
            ("# Contigs ({})", "# contigs (>= 0 bp)"),
            ("Largest contig ({})", "Largest contig"),
            ("% Genome fraction ({})", "Genome fraction (%)"),
            ("N50 ({})", "N50"),
        )
    ],
)
LONG_READ_VARIANTS = _metrics(
    ("multiqc_samtools_flagstat", "# Mapped reads", "mapped_passed"),
    ("multiqc_general_stats", "% Non-host reads (Kraken 2)", "kraken-pct_unclassified"),
    ("multiqc_general_stats", "Coverage median", "mosdepth-median_coverage"),
    ("multiqc_general_stats", "% Coverage > 1x", "mosdepth-1_x_pc"),
    ("multiqc_general_stats", "% Coverage > 10x", "mosdepth-10_x_pc"),
    ("multiqc_bcftools_stats", "# SNPs", "number_of_SNPs"),
    ("multiqc_bcftools_stats", "# INDELs", "number_of_indels"),
    ("multiqc_snpeff", "# Missense variants", "MISSENSE"),
    ("multiqc_quast", "# Ns per 100kb consensus", "# N's per 100 kbp"),
    ("multiqc_pangolin", "Pangolin lineage", "lineage"),
    ("multiqc_nextclade_clade", "Nextclade clade", "clade"),
)


def clean_sample(document: Column, key: Column, valid: Sequence[Column] | None = None) -> Column:
    """Insert-size documents name samples ``<sample>_FR``."""
    return F.when(document.startswith("multiqc_picard_insertSize"), F.regexp_replace(key, "_FR$", "")).otherwise(key)


def clean_trim_samples(leaves: DataFrame, valid: DataFrame) -> DataFrame:
    """Trimming documents name samples ``<sample>`` or ``<sample>`` plus two characters.

    The shorter name wins if it is a valid sample, so the two lookups are left joins on the (unique)
    sample list.
    """
    names = valid.select("sample").distinct()
    trim = leaves.filter(F.col("document").startswith("multiqc_cutadapt"))
    short = F.expr("substring(sample, 1, greatest(length(sample) - 2, 0))")
    known = names.select(F.col("sample").alias("_short"), F.lit(True).alias("_known"))
    renamed = trim.withColumn("_short", short).join(known, "_short", "left")
    renamed = renamed.withColumn("sample", F.when(F.col("_known"), F.col("_short")).otherwise(F.col("sample")))
    rest = leaves.filter(~F.col("document").startswith("multiqc_cutadapt"))
    return mix(rest, renamed.drop("_short", "_known"))


def find_leaves(leaves: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """Values of each metric: the first place, key by key and depth first, where its path occurs.

    ``leaves`` is the flattened form of the documents, one row per leaf:
    ``(document, sample, keys ARRAY<STRING>, places ARRAY<INT>, value)``. ``places`` are the positions
    of the keys in their maps. A key of the searched map itself comes before keys of nested maps.
    """
    spec = F.array(
        *[
            F.struct(
                F.lit(i).alias("metric"), F.lit(m.document).alias("doc"),
                F.lit(m.path[0]).alias("key"), F.lit(m.path[1] if len(m.path) == 2 else None).alias("key2"),
            )
            for i, m in enumerate(metrics)
        ]
    )
    wanted = leaves.withColumn("_m", F.explode(F.filter(spec, lambda s: s["doc"] == F.col("document"))))
    at = F.array_position("keys", F.col("_m.key"))
    inner = F.expr("array_position(slice(keys, cast(_at AS int) + 1, size(keys)), _m.key2)")
    one, two = F.col("_m.key2").isNull(), F.col("_m.key2").isNotNull()
    found = wanted.withColumn("_at", at).filter(F.col("_at") > 0)
    # Level k of the key path holds the key; at the holder's own level it comes first.
    ends = (one & (F.col("_at") == F.size("keys"))) | (two & (inner == F.size("keys") - F.col("_at")))
    rank = F.expr(
        "transform(places, (p, i) -> CASE WHEN i + 1 = _at OR i + 1 = size(places) THEN -1 ELSE p END)"
    )
    hits = found.filter(ends).withColumn("_rank", rank)
    return hits.groupBy("sample", F.col("_m.metric").alias("metric"), "document").agg(
        F.min_by("value", F.struct("_rank", "places")).alias("value")
    )


def metric_values(leaves: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """Long metric table with whole-number fields cut and pairs counted as two reads."""
    values = find_leaves(leaves, metrics)
    whole = [i for i, m in enumerate(metrics) if m.path[0] in INTEGER_FIELDS]
    if whole:
        cut = F.col("value").cast("double").cast("bigint").cast("string")
        values = values.withColumn("value", F.when(F.col("metric").isin(whole), cut).otherwise(F.col("value")))
    reads = [i for i, m in enumerate(metrics) if m.path[0] == "r_written"]
    if reads:
        pairs = [Metric("pairs", metrics[i].document, ("pairs_written",)) for i in reads]
        doubled = find_leaves(leaves, pairs).withColumn(
            "value", (F.col("value").cast("bigint") * 2).cast("string")
        )
        doubled = doubled.withColumn("metric", F.lit(reads[0])).withColumn("_second", F.lit(1))
        both = mix(values.withColumn("_second", F.lit(0)), doubled)
        values = both.groupBy("sample", "metric", "document").agg(F.min_by("value", "_second").alias("value"))
    return values


def printed(value: Column) -> Column:
    """Cell text: nothing, zero and false read ``NA``; commas become semicolons."""
    zero = (value.try_cast("double") == 0) | value.isin("", "False", "false", "None", "null")
    return F.when(value.isNull() | zero, "NA").otherwise(F.replace(value, F.lit(","), F.lit(";")))


def metrics_table(
    leaves: DataFrame, metrics: Sequence[Metric], valid: DataFrame | None = None
) -> DataFrame:
    """Samples x metrics, as printed. ``valid=None`` (or no valid sample at all) lets every key through.

    The pivot has a fixed column list, hence one aggregation and no extra pass for the values.
    """
    if valid is not None:
        leaves = clean_trim_samples(leaves, valid)
    leaves = leaves.withColumn("sample", clean_sample(F.col("document"), F.col("sample")))
    documents = {m.document for m in metrics}
    samples = leaves.filter(F.col("document").isin(*documents)).select("sample").distinct()
    if valid is not None:
        names = valid.select("sample").distinct()
        none = names.agg(F.count(F.lit(1)).alias("n")).scalar() == 0
        allowed = samples.join(names, "sample", "left_semi")
        # A valid sample that no document mentions still gets a row if some document is absent.
        samples = mix(allowed, names, samples.filter(none)).distinct()
    values = metric_values(leaves, metrics)
    cells = [
        printed(F.max(F.when(F.col("metric") == i, F.col("value")))).alias(m.column)
        for i, m in enumerate(metrics)
    ]
    table = values.groupBy("sample").agg(*cells)
    return samples.join(table, "sample", "left").fillna("NA", [m.column for m in metrics])


# --- alignment hits --------------------------------------------------------------------------------


def filter_hits(hits: DataFrame, min_length: int = 200, min_aligned: float = 0.7) -> DataFrame:
    """Keep hits of long, well-aligned contigs whose title does not name a phage (case-sensitive).

    Shares are printed with six significant digits before they are compared, as in the behaviour to match.
    """

    def share(whole: str) -> Column:
        return six_digits(ratio(F.col("length"), F.col(whole)))

    shares = hits.withColumn("contig_aligned", share("qlen")).withColumn("reference_covered", share("slen"))
    return shares.filter(
        (F.col("qlen") > min_length) & (F.col("contig_aligned") > min_aligned) & ~F.col("stitle").rlike("phage")
    )


# --- coverage --------------------------------------------------------------------------------------


def merge_coverage(coverage: DataFrame, region_prefix: str | None = None) -> DataFrame:
    """Coverage rows of all samples, region names without their prefix (a regular expression)."""
    if region_prefix and "region" in coverage.columns:
        return coverage.withColumn("region", F.regexp_replace("region", region_prefix, ""))
    return coverage


def heatmap_cells(coverage: DataFrame) -> DataFrame:
    """The heatmap in long form, (sample, region, log10(coverage + 1)): it holds any number of regions."""
    return coverage.groupBy("sample", "region").agg(F.max(F.log10(F.col("coverage") + 1)).alias("value"))


def heatmap(coverage: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Samples x regions matrix of log10(coverage + 1) for a given scheme's regions, in the order given."""
    return heatmap_cells(coverage).groupBy("sample").pivot("region", list(regions)).agg(F.first("value"))
