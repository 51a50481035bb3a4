"""Interval operators on half-open, zero-based BED intervals ``(contig, start, end)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virotide.operators.tiles import DEFAULT_WIDTH, islands

BIN = "_bin"


def merge_intervals(
    df: DataFrame, keys: Sequence[str] = ("contig",), slack: int = 0, width: int = DEFAULT_WIDTH
) -> DataFrame:
    """Union of overlapping and book-ended intervals.

    Intervals of equal start are folded first (map side), so copies of one interval cost one row.
    """
    folded = df.groupBy(*keys, "start").agg(F.max("end").alias("end"))
    runs = islands(folded, keys, "start", "end", slack, width)
    merged = runs.groupBy(*keys, "island").agg(F.max("end").alias("end"))
    return merged.select(*keys, F.col("island").alias("start"), "end")


def bins_of(start: Column, last: Column, width: int) -> Column:
    """All bins that the closed span [start, last] touches."""
    first = F.floor(start / width).cast("bigint")
    return F.sequence(first, F.floor(F.greatest(last, start) / width).cast("bigint"))


def point_in_interval(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    pos: str,
    start: str,
    last: str,
    how: str = "inner",
    width: int = 1024,
) -> DataFrame:
    """Join points to the intervals with ``start <= pos <= last``.

    Intervals are copied to each bin they touch and points stay single, so this is an equi-join on
    (keys, bin) plus a residual test. It never becomes a nested loop, and as ``how`` keeps the point
    side (inner, left, left_semi, left_anti) AQE can split a hot bin on the point side.
    """
    binned = intervals.filter(F.col(start) <= F.col(last)).withColumn(
        BIN, F.explode(bins_of(F.col(start), F.col(last), width))
    )
    left = points.withColumn(BIN, F.floor(F.col(pos) / width).cast("bigint"))
    condition = F.col(f"p.{BIN}") == F.col(f"i.{BIN}")
    for key in keys:
        condition = condition & (F.col(f"p.{key}") == F.col(f"i.{key}"))
    inside = (F.col(f"p.{pos}") >= F.col(f"i.{start}")) & (F.col(f"p.{pos}") <= F.col(f"i.{last}"))
    joined = left.alias("p").join(binned.alias("i"), condition & inside, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop(BIN)
    extra = [c for c in intervals.columns if c not in keys]
    return joined.select(
        *[F.col(f"p.{c}") for c in points.columns], *[F.col(f"i.{c}").alias(c) for c in extra]
    )


def overlapping(
    left: DataFrame, right: DataFrame, keys: Sequence[str], width: int = 1024
) -> DataFrame:
    """Pairs of half-open intervals that share a base; right columns get the prefix ``r_``.

    Both sides are copied to their bins; a pair is kept only in the bin that holds the later start,
    so it comes out once.
    """
    renamed = right.select(
        *[F.col(c).alias(c if c in keys else f"r_{c}") for c in right.columns]
    ).withColumn(BIN, F.explode(bins_of(F.col("r_start"), F.col("r_end") - 1, width)))
    binned = left.withColumn(BIN, F.explode(bins_of(F.col("start"), F.col("end") - 1, width)))
    joined = binned.join(renamed, [*keys, BIN])
    later = F.greatest(F.col("start"), F.col("r_start"))
    shares = (F.col("start") < F.col("r_end")) & (F.col("r_start") < F.col("end"))
    return joined.filter(shares & (F.floor(later / width) == F.col(BIN))).drop(BIN)


def split_at(df: DataFrame, step: int) -> DataFrame:
    """Cut intervals at multiples of ``step``; adds ``window`` (index of the step)."""
    cut = df.withColumn("window", F.explode(bins_of(F.col("start"), F.col("end") - 1, step)))
    return cut.withColumn("start", F.greatest("start", F.col("window") * step)).withColumn(
        "end", F.least("end", (F.col("window") + 1) * step)
    )


# --- primers ---------------------------------------------------------------------------------------


def collapse_primers(
    bed: DataFrame, left: str = "_LEFT", right: str = "_RIGHT", order: Sequence[str] = ("src",)
) -> DataFrame:
    """Primer BED -> one interval per amplicon.

    The amplicon is the name up to the left or right suffix (both are regular expressions); it is
    grouped by name alone, takes contig and score from its first line, and is always on ``+``.
    Output order, where a sink needs one, is ``first_start`` then ``name``.
    """
    named = bed.withColumn("name", F.regexp_replace("name", f"(?s)(?:{left}|{right}).*", ""))
    line = F.struct(*order)
    return named.groupBy("name").agg(
        F.min_by("contig", line).alias("contig"),
        F.least(F.min("start"), F.min("end")).alias("start"),
        F.greatest(F.max("start"), F.max("end")).alias("end"),
        F.min_by("score", line).alias("score"),
        F.lit("+").alias("strand"),
        F.min("start").alias("first_start"),
    )


def primers_without_suffix(bed: DataFrame, left: str = "_LEFT", right: str = "_RIGHT") -> DataFrame:
    """Primer names that contain neither suffix (a warning, not an error)."""
    return bed.filter(~F.col("name").contains(left) & ~F.col("name").contains(right)).select("name").distinct()


def primer_fasta_adapters(lines: DataFrame, column: str = "line") -> DataFrame:
    """Prefix ``X`` to pure A/C/G/T lines, so that a 5' primer matches only at the read start."""
    line = F.col(column)
    return lines.withColumn(column, F.when(line.rlike("^[ACTGactg]+$"), F.concat(F.lit("X"), line)).otherwise(line))


# --- low coverage mask -----------------------------------------------------------------------------


def low_coverage(depth: DataFrame, minimum: int = 10) -> DataFrame:
    """Positions (1-based) below ``minimum`` as one-base intervals."""
    extra = [c for c in depth.columns if c not in ("contig", "pos", "depth")]
    return depth.filter(F.col("depth") < minimum).select(
        *extra, "contig", (F.col("pos") - 1).alias("start"), F.col("pos").alias("end"), "depth"
    )


def low_segments(
    segments: DataFrame, variants: DataFrame, minimum: int = 10, keys: Sequence[str] = ("sample",), order: Sequence[str] = ("src",), width: int = 1024
) -> DataFrame:
    """`low_coverage` of segments ``(keys, contig, start, end, depth)``: one-base intervals only within ``width`` of an indel.

    Elsewhere a segment stays whole (cut at multiples of ``width``): `mask_without_indels` keeps all of it.
    """
    pieces = split_at(segments.filter(F.col("depth") < minimum), width)
    spans = indel_spans(variants, keys, order)
    last = F.col("pos") + F.col("ref_len") - 2
    touched = spans.select(*keys, F.explode(bins_of(F.col("pos") - 1, last, width)).alias("window")).distinct()
    by = [*keys, "window"]
    near = pieces.join(touched, by, "left_semi").withColumn("start", F.explode(F.sequence(F.col("start"), F.col("end") - 1)))
    bases = near.withColumn("end", F.col("start") + 1)
    return pieces.join(touched, by, "left_anti").unionByName(bases).drop("window")


def indel_spans(
    variants: DataFrame, keys: Sequence[str] = ("sample",), order: Sequence[str] = ("src",)
) -> DataFrame:
    """One span per position with an indel: the last such record gives the REF length."""
    indels = variants.filter(F.length("ref") != F.length("alt"))
    return indels.groupBy(*keys, "pos").agg(F.max_by(F.length("ref"), F.struct(*order)).alias("ref_len"))


def mask_without_indels(
    mask: DataFrame,
    variants: DataFrame,
    keys: Sequence[str] = ("sample",),
    order: Sequence[str] = ("src",),
    width: int = 1024,
) -> DataFrame:
    """Drop mask rows whose start or end lies in ``[pos, pos + len(REF) - 1)`` of an indel.

    Contig is ignored, as positions of the supported genomes come from one contig. An insertion has
    REF length 1, hence an empty range, and masks nothing. Two binned anti-joins replace the theta
    join, so that neither side has to be small.
    """
    spans = indel_spans(variants, keys, order).select(
        *keys, F.col("pos").alias("first"), (F.col("pos") + F.col("ref_len") - 2).alias("last")
    )
    for edge in ("start", "end"):
        mask = point_in_interval(mask, spans, keys, edge, "first", "last", "left_anti", width)
    return mask


def contigs_missing(bed: DataFrame, reference: DataFrame) -> DataFrame:
    """Contigs of a BED that the reference lacks."""
    return bed.select("contig").distinct().join(reference.select("contig"), "contig", "left_anti")
