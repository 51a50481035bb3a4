"""Amplicons of alignments, and depth evened out over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from virotide.operators.alignments import drop_unmapped, has, reference_end
from virotide.operators.intervals import point_in_interval


def assign_amplicons(reads: DataFrame, amplicons: DataFrame) -> DataFrame:
    """Mapped reads with the name of the ``amplicon`` that holds them from end to end (null if none does).

    ``amplicons``: ``(contig, start, end, name)``, half-open. Of several the shortest counts, then the first by start and
    by name. Reads of equal span are looked up once.
    """
    mapped = drop_unmapped(reads).withColumn("_last", reference_end())
    spans = mapped.select("contig", "pos", "_last").distinct()
    sides = amplicons.select(
        "contig", (F.col("start") + 1).alias("a_first"), F.col("end").alias("a_last"), F.col("name").alias("a_name")
    ).distinct()
    hits = point_in_interval(spans, sides, ["contig"], "pos", "a_first", "a_last").filter("_last <= a_last")
    order = F.struct((F.col("a_last") - F.col("a_first")).alias("size"), "a_first", "a_name")
    held = hits.groupBy("contig", "pos", "_last").agg(F.min(order).getField("a_name").alias("amplicon"))
    # Spans are distinct and few against reads, which need not be sorted to meet them.
    return mapped.join(held.hint("shuffle_hash"), ["contig", "pos", "_last"], "left").select(*reads.columns, "amplicon")


def normalise_depth(reads: DataFrame, amplicons: DataFrame, depth: int = 500, slots: int = 64, seed: str = "0") -> DataFrame:
    """At most ``depth`` reads of each sample, amplicon and strand; reads that no amplicon holds go.

    Which reads stay is told by a hash of ``seed``, name, flag, place and CIGAR, so neither partitions nor the order of
    rows matter. Each task sends at most ``depth`` rows of a group on (Spark's limit of window groups). For a ``depth`` too
    large for that, a group is first cut down in ``slots`` parts, so that no task sees more than ``slots * depth`` rows of it.
    """
    placed = assign_amplicons(reads, amplicons).filter(F.col("amplicon").isNotNull())
    mark = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in ("qname", "flag", "pos", "cigar")]))
    # As bytes: their order is that of the digits, in half the room.
    marked = placed.withColumns({"_reverse": has(16), "_mark": F.unhex(mark)})
    group, order = ["sample", "amplicon", "_reverse"], ["_mark", "seq", "qual"]

    def first(df: DataFrame, keys: list[str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn("_place", place).filter(F.col("_place") <= depth)

    if depth > int(reads.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        slotted = marked.withColumn("_slot", F.pmod(F.xxhash64("_mark"), F.lit(slots)))
        marked = first(slotted, [*group, "_slot"]).drop("_slot", "_place")
    return first(marked, group).select(*reads.columns, "amplicon")
