"""Codon-aware merging of neighbouring SNPs.

The steps, each a DataFrame function with its own fixture:

    candidates      passing SNPs with both codons known
    adjacent_runs   runs of candidates whose steps are at most 1 (skew-safe, tile by tile)
    codon_groups    rows of one run and one reference codon, cut where the codon index falls back
    allele_paths    every choice of alleles where a position has several
    merge_*         paths to variants, under the consensus rule or the keep-all rule

Only ``adjacent_runs`` works along the genome. From there on the unit is one run, that is one stretch
of directly neighbouring changed positions of one sample, after copies were folded.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from virotide.functions.numbers import float_text
from virotide.operators.channels import mix
from virotide.operators.tiles import DEFAULT_WIDTH, islands
from virotide.operators.variants import SITE, first_per_site

CONSENSUS_AF = 0.75
PLACE = ("sample", "contig")
CODON = ("sample", "contig", "run", "ref_codon")


def is_candidate(variants: DataFrame) -> Column:
    """A SNP that passes every filter and has a value in every column."""
    whole = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in variants.columns])
    return whole & (F.col("kind") == "SNP") & (F.col("filter") == "PASS")


def candidates(variants: DataFrame) -> DataFrame:
    return variants.filter(is_candidate(variants))


def adjacent_runs(rows: DataFrame, width: int = DEFAULT_WIDTH) -> DataFrame:
    """Candidates (no column is NULL) labelled with the start of their run (steps of 0 or 1); lone rows are runs of one."""
    return islands(rows, PLACE, "pos", "pos", slack=1, width=width, out="run", nulls=False)


def run_sizes(runs: DataFrame) -> DataFrame:
    """Runs of two or more rows."""
    sizes = runs.groupBy(*PLACE, "run").agg(F.count(F.lit(1)).alias("run_size"))
    return sizes.filter(F.col("run_size") > 1)


def changed_index() -> Column:
    """Index (0-2) of the one changed base; NULL if none or more than one base differs."""
    hits = F.array_compact(
        F.array(
            *[
                F.when(F.substring("ref_codon", i + 1, 1) != F.substring("alt_codon", i + 1, 1), F.lit(i))
                for i in range(3)
            ]
        )
    )
    return F.when(F.size(hits) == 1, F.get(hits, F.lit(0)))


def label_groups(runs: DataFrame, order: Sequence[str] = ("src",)) -> DataFrame:
    """``grouped`` and ``part`` for every row of every run: the codon group it belongs to, if any.

    Adjacency is tested again among rows of equal codon text; a set on one position only is no
    group. Rows with conflicting codons leave before the index step is looked at. All of it is one
    exchange by run and one sort: what leaves is flagged, not filtered, so nothing is joined back.
    """
    # One exchange serves the windows and the aggregate behind them.
    dealt = runs.repartition(*PLACE, "run").withColumn("idx", changed_index())
    line = Window.partitionBy(*CODON).orderBy("pos", *order)
    to_last = F.coalesce(F.col("pos") - F.lag("pos").over(line) <= 1, F.lit(False))
    to_next = F.coalesce(F.lead("pos").over(line) - F.col("pos") <= 1, F.lit(False))
    near = dealt.withColumn("_near", F.when(to_last | to_next, F.col("pos")))
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wide = F.coalesce(F.min("_near").over(whole) < F.max("_near").over(whole), F.lit(False))
    spread = near.withColumn("grouped", wide & F.col("_near").isNotNull() & F.col("idx").isNotNull())
    before = F.last(F.when(F.col("grouped"), F.col("idx")), ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    falls = F.when(F.col("grouped") & (F.col("idx") < before), 1).otherwise(0)
    return spread.withColumn("_fall", falls).withColumn(
        "part", F.sum("_fall").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).drop("_near", "_fall")


def codon_groups(runs: DataFrame, order: Sequence[str] = ("src",)) -> DataFrame:
    """The rows of codon groups, with the number of their group in the run and its codon text."""
    return label_groups(runs, order).filter("grouped").drop("grouped")


def allele_paths(rows: Column) -> Column:
    """Every choice of one row per position, as an array of arrays of rows (one where no position repeats)."""
    places = F.array_distinct(F.transform(rows, lambda r: r["pos"]))
    none = F.array(F.filter(rows, lambda r: F.lit(False)))

    def extend(paths, pos):
        here = F.filter(rows, lambda r: r["pos"] == pos)
        return F.flatten(F.transform(paths, lambda p: F.transform(here, lambda r: F.concat(p, F.array(r)))))

    return F.aggregate(places, none, extend)


def _single(row: Column, own: Sequence[str]) -> Column:
    nothing = F.lit(None).cast("string")
    return F.struct(
        *[row[c].alias(c) for c in own],
        nothing.alias("merged_min_af"), nothing.alias("merged_af"), nothing.alias("merged_dp"),
    )


def _outcome(path: Column, settle, own: Sequence[str]) -> Column:
    """The variants one path turns into, as an array of rows of one type."""
    freqs = F.transform(path, lambda r: float_text(r["alt_freq"]))
    depths = F.transform(path, lambda r: r["alt_dp"].cast("string"))
    size = F.size(path)
    first = F.get(path, F.lit(0))

    def joined(field):
        return F.array_join(F.transform(path, lambda r: r[field]), "")

    merged_values = {"ref": joined("ref"), "alt": joined("alt"), "alt_freq": F.array_min(freqs).cast("double")}
    merged = F.struct(
        *[merged_values.get(c, first[c]).alias(c) for c in own],
        F.array_min(freqs).alias("merged_min_af"),
        F.array_join(freqs, ",").alias("merged_af"),
        F.array_join(depths, ",").alias("merged_dp"),
    )
    # A path in which no two neighbours are adjacent any more (rows between them were skipped) is lost.
    steps = F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1)))
    adjacent = F.exists(steps, lambda i: F.get(path, i)["pos"] - F.get(path, i - 1)["pos"] <= 1)
    merges, keep = settle(path)
    return (
        F.when(size == 1, F.transform(path, lambda r: _single(r, own)))
        .when(merges, F.filter(F.array(merged), lambda _: adjacent))
        .otherwise(F.transform(F.filter(path, keep), lambda r: _single(r, own)))
    )


def _apply(variants: DataFrame, order: Sequence[str], width: int, settle) -> DataFrame:
    """Three disjoint parts: rows that are no candidates, rows of runs, and rows whose REF equals their ALT.

    A run's rows come out of one aggregate per (run, codon, group): rows in no group as they are, groups
    as what their paths turn into, each result once.
    """
    unique = first_per_site(variants, order=order)
    own = [c for c in unique.columns if c not in (*PLACE, "ref_codon")]
    real = F.col("ref") != F.col("alt")
    runs = adjacent_runs(candidates(unique), width)
    labelled = label_groups(runs, order)
    member = F.struct("pos", *order, *[c for c in own if c not in ("pos", *order)])
    grouped = labelled.groupBy(*CODON, "grouped", "part").agg(F.array_sort(F.collect_list(member)).alias("rows"))
    results = F.array_distinct(F.flatten(F.transform(allele_paths(F.col("rows")), lambda p: _outcome(p, settle, own))))
    as_they_are = F.transform("rows", lambda r: _single(r, own))
    settled = grouped.select(*PLACE, "ref_codon", F.inline(F.when(F.col("grouped"), results).otherwise(as_they_are))).filter(real)
    rest = unique.filter(F.coalesce(real, F.lit(True)) & ~is_candidate(unique))
    # REF = ALT rows stay only in samples without any run.
    equal = unique.filter(~F.coalesce(real, F.lit(True))).join(run_sizes(runs).select("sample").distinct(), "sample", "left_anti")
    return mix(settled, rest.union(equal))


def merge_all_haplotypes(
    variants: DataFrame, order: Sequence[str] = ("src",), width: int = DEFAULT_WIDTH
) -> DataFrame:
    """Every path of two or more positions becomes one variant; single rows stay as they are.

    Other haplotypes (mixes of reference and alternative bases) never survive the merge rule in the
    behaviour to match, whatever ``merge_af_threshold`` says, so they are not built.
    """
    return _apply(variants, order, width, lambda _: (F.lit(True), lambda r: F.lit(False)))


def merge_consensus(
    variants: DataFrame,
    consensus_af: float = CONSENSUS_AF,
    order: Sequence[str] = ("src",),
    width: int = DEFAULT_WIDTH,
    keep_high: bool = False,
) -> DataFrame:
    """Merge a path only if every AF is above ``consensus_af``; else emit its low members singly.

    As in the behaviour to match, the high members of such a mixed path are dropped.
    ``keep_high=True`` keeps them.
    """

    def settle(path):
        high = F.forall(path, lambda r: r["alt_freq"] > consensus_af)
        return high, lambda r: (r["alt_freq"] <= consensus_af) | F.lit(keep_high)

    return _apply(variants, order, width, settle)
