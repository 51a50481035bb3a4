"""Effect annotation: extract fields of annotated VCF rows, and predict simple coding effects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virotide.functions.sequence import reverse_complement, translate_codon
from virotide.operators.intervals import point_in_interval
from virotide.operators.reads import settled
from virotide.operators.variants import info_field

# Order of the sub-fields of one annotation entry.
ANN_FIELDS = (
    "allele", "effect", "impact", "gene", "geneid", "feature", "featureid", "biotype", "rank",
    "hgvs_c", "hgvs_p", "cdna", "cds", "aa", "distance", "errors",
)
EXTRACTED = (
    "gene", "geneid", "impact", "effect", "feature", "featureid", "biotype", "rank", "hgvs_c", "hgvs_p",
    "cdna_pos", "cdna_len", "cds_pos", "cds_len", "aa_pos", "aa_len", "distance",
)
SPLIT_FIELDS = {"cdna": ("cdna_pos", "cdna_len"), "cds": ("cds_pos", "cds_len"), "aa": ("aa_pos", "aa_len")}


def _sub_field(parts: Column, name: str) -> Column:
    for whole, (pos, length) in SPLIT_FIELDS.items():
        if name in (pos, length):
            return F.get(F.split(_sub_field(parts, whole), "/"), F.lit(0 if name == pos else 1))
    return F.get(parts, F.lit(ANN_FIELDS.index(name)))


def extract_fields(vcf: DataFrame, fields: tuple[str, ...] = EXTRACTED, empty: str = ".") -> DataFrame:
    """Annotation entries of the ANN info field as parallel comma lists, ``.`` where empty. Narrow.

    The info field is searched and its entries are split once per row, whatever the number of fields.
    """
    keys = ("sample", "contig", "pos", "ref", "alt")
    entries = F.transform(F.split(info_field("ANN"), ","), lambda e: F.split(e, r"\|"))
    split = settled(vcf.select(*keys, "info"), _entries=entries)

    def listed(name):
        def value(parts):
            return F.coalesce(F.nullif(_sub_field(parts, name), F.lit("")), F.lit(empty))

        return F.coalesce(F.array_join(F.transform("_entries", value), ","), F.lit(empty)).alias(name)

    return split.select(*keys, *[listed(f) for f in fields])


def coding_effects(variants: DataFrame, cds: DataFrame, codons: DataFrame) -> DataFrame:
    """Effect of single-base changes inside coding intervals.

    ``cds`` is (contig, start, end, gene, strand) with 1-based closed bounds and phase 0, ``codons``
    holds the reference triplet at each codon start: (contig, codon_start, triplet) in genome
    direction. Other variants need the external annotator.
    """
    simple = variants.filter((F.length("ref") == 1) & (F.length("alt") == 1))
    inside = point_in_interval(simple, cds, ["contig"], "pos", "start", "end", "inner", width=256)
    minus = F.col("strand") == "-"
    number = F.floor(F.when(minus, F.col("end") - F.col("pos")).otherwise(F.col("pos") - F.col("start")) / 3)
    first = F.when(minus, F.col("end") - number * 3 - 2).otherwise(F.col("start") + number * 3)
    placed = inside.withColumn("codon_start", first).withColumn("_i", (F.col("pos") - first).cast("int"))
    named = placed.join(codons, ["contig", "codon_start"])
    changed = F.concat(
        F.substr("triplet", F.lit(1), F.col("_i")), F.col("alt"), F.substr("triplet", F.col("_i") + 2, F.lit(3))
    )
    ref_codon = F.when(minus, reverse_complement(F.col("triplet"))).otherwise(F.col("triplet"))
    alt_codon = F.when(minus, reverse_complement(changed)).otherwise(changed)
    aa = named.withColumns(
        {"aa_ref": translate_codon(ref_codon), "aa_alt": translate_codon(alt_codon), "aa_pos": (number + 1).cast("bigint")}
    )
    effect = (
        F.when((F.col("aa_ref") == "X") | (F.col("aa_alt") == "X"), "coding_sequence_variant")
        .when((F.col("aa_pos") == 1) & (F.col("aa_ref") == "M") & (F.col("aa_alt") != "M"), "start_lost")
        .when(F.col("aa_ref") == F.col("aa_alt"), "synonymous_variant")
        .when(F.col("aa_alt") == "*", "stop_gained")
        .when(F.col("aa_ref") == "*", "stop_lost")
        .otherwise("missense_variant")
    )
    return aa.select(*variants.columns, "gene", "aa_pos", "aa_ref", "aa_alt", effect.alias("effect"))
