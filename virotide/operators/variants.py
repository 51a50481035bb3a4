"""Variant tables: decode caller rows, label filters, split, filter, count and write as VCF text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virotide.functions.numbers import fisher_greater, float_text, ratio
from virotide.functions.text import join_labels, pad_centre, pad_left
from virotide.operators.channels import number_within

SITE = ("sample", "contig", "pos", "ref", "alt")

# Field orders and header lines of the VCF that is written.
FORMAT_FIELDS = ("GT", "DP", "REF_DP", "REF_RV", "REF_QUAL", "ALT_DP", "ALT_RV", "ALT_QUAL", "ALT_FREQ")
MERGED_FIELDS = ("MERGED_AF", "MERGED_DP")
HEADER_TOP = ("##fileformat=VCFv4.2", "##source=iVar")
HEADER_INFO = (
    '##INFO=<ID=TYPE,Number=1,Type=String,Description="Either SNP (Single Nucleotide Polymorphism), '
    'DEL (deletion) or INS (Insertion)">',
)
HEADER_FILTER = (
    '##FILTER=<ID=PASS,Description="All filters passed">',
    '##FILTER=<ID=ft,Description="Fisher\'s exact test of variant frequency compared to mean error rate, '
    'p-value > 0.05">',
    '##FILTER=<ID=bq,Description="Bad quality variant: ALT_QUAL lower than 20">',
)
HEADER_FILTER_STRAND = '##FILTER=<ID=sb,Description="Strand bias filter not passed">'
HEADER_FORMAT = (
    ("GT", "1", "String", "Genotype"),
    ("DP", "1", "Integer", "Total Depth"),
    ("REF_DP", "1", "Integer", "Depth of reference base"),
    ("REF_RV", "1", "Integer", "Depth of reference base on reverse reads"),
    ("REF_QUAL", "1", "Integer", "Mean quality of reference base"),
    ("ALT_DP", "1", "Integer", "Depth of alternate base"),
    ("ALT_RV", "1", "Integer", "Depth of alternate base on reverse reads"),
    ("ALT_QUAL", "1", "Integer", "Mean quality of alternate base"),
    ("ALT_FREQ", "1", "Float", "Frequency of alternate base"),
)
HEADER_MERGED = (
    ("MERGED_AF", "A", "Float", "Frequency of each merged variant comma separated"),
    ("MERGED_DP", "A", "Float", "Total Depth of each merged variant comma separated"),
)
STRAND_P = 0.05


def strand_p_value() -> Column:
    return fisher_greater(
        F.col("ref_dp") - F.col("ref_rv"),
        F.col("ref_rv"),
        F.col("alt_dp") - F.col("alt_rv"),
        F.col("alt_rv"),
    )


def filter_label(min_qual: float = 20, strand_test: bool = True) -> Column:
    """``ft`` (caller did not pass), ``sb`` (strand bias), ``bq`` (low quality), else ``PASS``."""
    labels = [F.when(~F.coalesce(F.col("pass"), F.lit(False)), "ft")]
    if strand_test:
        labels.append(F.when(strand_p_value() < STRAND_P, "sb"))
    labels.append(F.when(~F.coalesce(F.col("alt_qual") >= min_qual, F.lit(False)), "bq"))
    return join_labels(*labels, empty="PASS")


def decode_calls(
    calls: DataFrame,
    pass_only: bool = False,
    min_freq: float = 0.0,
    min_qual: float = 20,
    strand_test: bool = True,
) -> DataFrame:
    """Caller rows -> variant rows with decoded alleles, filter label and kind. Narrow, no shuffle.

    ``-XYZ`` deletes XYZ after REF, ``+XYZ`` inserts it. ``pass_only`` keeps rows the caller passed.
    """
    kept = calls.dropna(thresh=2).filter(F.col("alt_freq") >= min_freq)
    if pass_only:
        kept = kept.filter(F.col("pass"))
    sign, tail = F.substring("alt", 1, 1), F.expr("substring(alt, 2)")
    kind = F.when(sign == "+", "INS").when(sign == "-", "DEL").otherwise("SNP")
    ref = F.when(sign == "-", F.concat("ref", tail)).otherwise(F.col("ref"))
    alt = F.when(sign == "+", F.concat("ref", tail)).when(sign == "-", F.col("ref")).otherwise(F.col("alt"))
    return kept.withColumns(
        {"filter": filter_label(min_qual, strand_test), "kind": kind, "_ref": ref, "_alt": alt}
    ).drop("ref", "alt").withColumnsRenamed({"_ref": "ref", "_alt": "alt"})


def first_per_site(
    variants: DataFrame, keys: Sequence[str] = SITE, order: Sequence[str] = ("src",)
) -> DataFrame:
    """First row per site in file order: an aggregate, so copies of a hot site combine map side.

    The order's columns are moved once; rows of equal order are told apart by their other columns.
    """
    rest = [c for c in variants.columns if c not in (*keys, *order)]
    first = [c for c in order if c not in keys]
    picked = variants.groupBy(*keys).agg(F.min(F.struct(*first, *rest)).alias("_v"))
    return picked.select(*keys, *[F.col(f"_v.`{c}`").alias(c) for c in variants.columns if c not in keys])


def unique_adjacent(variants: DataFrame, order: Sequence[str] = ("src",)) -> DataFrame:
    """Drop records equal to the record on the line before, in the readers' ``order`` (gaps do not matter).

    Lines are numbered per sample by many tasks; "the line before" is then an equi-join on unique keys.
    """
    src = "_number"
    variants = number_within(variants, ["sample"], list(order), src)
    same = [F.col(f"v.{c}").eqNullSafe(F.col(f"b.{c}")) for c in SITE]
    before = variants.select(*SITE, (F.col(src) + 1).alias("_line"))
    condition = (F.col("v.sample") == F.col("b.sample")) & (F.col(f"v.{src}") == F.col("b._line"))
    for test in same[1:]:
        condition = condition & test
    return variants.alias("v").join(before.alias("b"), condition, "left_anti").drop(src)


def split_alleles(
    vcf: DataFrame, per_alt: Sequence[str] = (), per_allele: Sequence[str] = ()
) -> DataFrame:
    """Multi-allelic rows -> one row per ALT, without left alignment.

    ``per_alt`` columns hold one comma-separated value per ALT, ``per_allele`` one for REF and each ALT.
    """
    exploded = vcf.select("*", F.posexplode(F.split("alt", ",")).alias("alt_index", "_alt"))
    out = exploded.withColumn("alt", F.col("_alt")).drop("_alt")
    for name in per_alt:
        out = out.withColumn(name, F.get(F.split(name, ","), F.col("alt_index")))
    for name in per_allele:
        values = F.split(name, ",")
        out = out.withColumn(
            name, F.concat_ws(",", F.get(values, F.lit(0)), F.get(values, F.col("alt_index") + 1))
        )
    return out


def consensus_variants(variants: DataFrame, caller: str, min_af: float = 0.75) -> DataFrame:
    """Variants that go into the consensus: by ALT_FREQ (ivar) or AD[1]/DP (bcftools)."""
    if caller == "ivar":
        return variants.filter(F.col("alt_freq") >= min_af)
    alt_depth = F.get(F.split("ad", ","), F.lit(1)).try_cast("double")
    return variants.filter(ratio(alt_depth, F.col("dp")) >= min_af)


def format_field(name: str, sample: str = "payload", layout: str = "format") -> Column:
    """One named value out of a FORMAT / sample column pair; NULL if the field is absent."""
    place = F.array_position(F.split(layout, ":"), F.lit(name)).cast("int")
    return F.when(place > 0, F.get(F.split(sample, ":"), place - 1))


def info_field(name: str, info: str = "info") -> Column:
    found = F.regexp_extract(F.col(info), rf"(?:^|;){name}=([^;]*)", 1)
    return F.when(F.col(info).rlike(rf"(?:^|;){name}="), found)


def variant_stats(variants: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Counts per sample: records, SNPs, MNPs, indels, multi-allelic sites, transitions."""
    ref, alts = F.length("ref"), F.split("alt", ",")
    is_indel = F.exists(alts, lambda a: F.length(a) != ref)
    is_snp = (ref == 1) & F.exists(alts, lambda a: F.length(a) == 1)
    is_mnp = (ref > 1) & F.exists(alts, lambda a: F.length(a) == ref)
    pair = F.concat("ref", "alt")
    # The four transitions.
    is_ts = pair.isin("AG", "GA", "CT", "TC")

    def count(test):
        return F.count(F.when(test, 1))

    return variants.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("number_of_records"),
        count(is_snp).alias("number_of_snps"),
        count(is_mnp).alias("number_of_mnps"),
        count(is_indel).alias("number_of_indels"),
        count(F.size(alts) > 1).alias("number_of_multiallelic_sites"),
        count(is_ts).alias("ts"),
        count(is_snp & ~is_ts).alias("tv"),
    )


def kind_counts(variants: DataFrame) -> DataFrame:
    """SNP, INS and DEL counts per sample."""
    kinds = {k: F.count(F.when(F.col("kind") == k, 1)).alias(k.lower()) for k in ("DEL", "INS", "SNP")}
    return variants.groupBy("sample").agg(*kinds.values())


def kind_count_lines(counts: DataFrame) -> DataFrame:
    """The counts as fixed-width text: sample in 30, numbers centred in 10."""
    cells = [pad_left(F.concat(F.lit(""), F.col("sample")), 30)]
    cells += [pad_centre(F.col(k).cast("string"), 10) for k in ("del", "ins", "snp")]
    return counts.select("sample", F.concat(*cells).alias("line"))


# --- VCF text --------------------------------------------------------------------------------------


def payload(merged: bool = False) -> Column:
    """``GT:DP:...:ALT_FREQ`` text; a merged variant carries its AF text and the two merged lists."""
    names = ("dp", "ref_dp", "ref_rv", "ref_qual", "alt_dp", "alt_rv", "alt_qual")
    values = [F.coalesce(F.col(n).cast("string"), F.lit("nan")) for n in names]
    freq = F.coalesce(float_text(F.col("alt_freq")), F.lit("nan"))
    if not merged:
        return F.concat_ws(":", F.lit("1"), *values, freq)
    # concat_ws skips the two lists where they are NULL (rows that were not merged).
    return F.concat_ws(
        ":", F.lit("1"), *values, F.coalesce("merged_min_af", freq), F.col("merged_af"), F.col("merged_dp")
    )


def vcf_lines(variants: DataFrame, merged: bool = False) -> DataFrame:
    """Body lines of one VCF per sample, with the columns a sink sorts by."""
    layout = F.lit(":".join(FORMAT_FIELDS))
    if merged:
        tail = F.lit(":" + ":".join(MERGED_FIELDS))
        layout = F.when(F.col("merged_af").isNotNull(), F.concat(layout, tail)).otherwise(layout)
    cells = [
        F.col("contig"), F.col("pos").cast("string"), F.lit("."), F.col("ref"), F.col("alt"), F.lit("."),
        F.col("filter"), F.concat(F.lit("TYPE="), F.col("kind")), layout, payload(merged),
    ]
    return variants.select("sample", "contig", "pos", "ref", "alt", F.concat_ws("\t", *cells).alias("line"))


def vcf_header(
    contigs: Sequence[tuple[str, int]] = (), strand_test: bool = True, merge: bool = True
) -> list[str]:
    """Header lines. They depend on the run options and the reference, never on the variants."""
    lines = list(HEADER_TOP)
    lines += [f"##contig=<ID={name},length={length}>" for name, length in contigs]
    lines += HEADER_INFO + HEADER_FILTER
    if strand_test:
        lines.append(HEADER_FILTER_STRAND)
    for name, number, kind, text in HEADER_FORMAT + (HEADER_MERGED if merge else ()):
        lines.append(f'##FORMAT=<ID={name},Number={number},Type={kind},Description="{text}">')
    return lines
