"""Operators over alignment rows ``(sample, qname, flag, contig, pos, mapq, cigar, seq, qual)``.

``pos`` is the 1-based leftmost position. Flags follow the public SAM layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from virotide.functions.numbers import ratio
from virotide.functions.sequence import cigar_ops, cigar_span
from virotide.operators.channels import product, product_with
from virotide.operators.intervals import bins_of, overlapping, point_in_interval, split_at
from virotide.operators.tiles import DEFAULT_WIDTH, TILE, attach, next_value

# Flag bits.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE = 1, 2, 4, 8, 16, 32
READ1, READ2, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 64, 128, 256, 512, 1024, 2048
REFERENCE_OPS, QUERY_OPS, CLIP_OPS = "MDN=X", "MIS=X", "SH"
# Positions per tile of a pileup: one task counts a tile's bases, as they come.
SITES = 1000
# Windows of one block of a samples x windows table.
BLOCK = 256


def has(*bits: int) -> Column:
    mask = sum(bits)
    return F.col("flag").bitwiseAND(mask) == mask


def lacks(*bits: int) -> Column:
    return F.col("flag").bitwiseAND(sum(bits)) == 0


def drop_unmapped(reads: DataFrame) -> DataFrame:
    return reads.filter(lacks(UNMAPPED))


def coordinate_sort(reads: DataFrame) -> DataFrame:
    """Global sort by contig, position and strand: a range exchange, then sorts per partition."""
    return reads.orderBy("contig", "pos", F.col("flag").bitwiseAND(REVERSE), "qname")


def reference_end() -> Column:
    """Last reference position a read covers."""
    return F.col("pos") + cigar_span(F.col("cigar"), REFERENCE_OPS) - 1


def flag_counts(reads: DataFrame) -> DataFrame:
    """Counts by flag per sample, one pass of conditional counts."""
    primary = lacks(SECONDARY, SUPPLEMENTARY)
    both = has(PAIRED) & primary & lacks(UNMAPPED, MATE_UNMAPPED)
    tests = {
        "total": F.lit(True),
        "primary": primary,
        "secondary": has(SECONDARY),
        "supplementary": has(SUPPLEMENTARY) & lacks(SECONDARY),
        "duplicates": has(DUPLICATE),
        "primary_duplicates": primary & has(DUPLICATE),
        "mapped": lacks(UNMAPPED),
        "primary_mapped": primary & lacks(UNMAPPED),
        "paired": has(PAIRED) & primary,
        "read1": has(PAIRED, READ1) & primary,
        "read2": has(PAIRED, READ2) & primary,
        "properly_paired": has(PAIRED, PROPER) & primary & lacks(UNMAPPED),
        "both_mapped": both,
        "singletons": has(PAIRED, MATE_UNMAPPED) & primary & lacks(UNMAPPED),
    }
    return reads.groupBy("sample").agg(*[F.count(F.when(t, 1)).alias(n) for n, t in tests.items()])


def contig_counts(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Mapped and unmapped reads per sample and contig, contigs without reads included.

    Reads without a contig count in the last line of each sample, ``*`` with length 0.
    """
    placed = reads.withColumn("contig", F.coalesce("contig", F.lit("*")))
    counts = placed.groupBy("sample", "contig").agg(
        F.count(F.when(lacks(UNMAPPED), 1)).alias("mapped"), F.count(F.when(has(UNMAPPED), 1)).alias("unmapped")
    )
    # Samples x contigs of the reference: the frame of the report, not of the reads.
    nowhere = contigs.sparkSession.range(1).select(F.lit("*").alias("contig"), F.lit(0).cast("bigint").alias("length"))
    listed = contigs.select("contig", F.col("length").cast("bigint").alias("length")).distinct().union(nowhere)
    frame = product(reads.select("sample").distinct(), listed)
    return frame.join(counts, ["sample", "contig"], "left").fillna(0, ["mapped", "unmapped"])


def alignment_stats(reads: DataFrame) -> DataFrame:
    """Summary numbers per sample: reads, bases, mapped bases, mean length, insertions and deletions."""
    primary = reads.filter(lacks(SECONDARY, SUPPLEMENTARY))
    mapped = lacks(UNMAPPED)

    def cigar_sum(kinds):
        return F.coalesce(F.sum(F.when(mapped, cigar_span(F.col("cigar"), kinds))), F.lit(0))

    return primary.groupBy("sample").agg(
        F.count(F.lit(1)).alias("raw_total_sequences"),
        F.count(F.when(mapped, 1)).alias("reads_mapped"),
        F.count(F.when(has(UNMAPPED), 1)).alias("reads_unmapped"),
        F.count(F.when(has(DUPLICATE), 1)).alias("reads_duplicated"),
        F.count(F.when(mapped & (F.col("mapq") == 0), 1)).alias("reads_mq0"),
        F.sum(F.length("seq")).alias("total_length"),
        F.max(F.length("seq")).alias("maximum_length"),
        cigar_sum("MI=X").alias("bases_mapped_cigar"),
        cigar_sum("I").alias("inserted_bases"),
        cigar_sum("D").alias("deleted_bases"),
    )


# --- depth -----------------------------------------------------------------------------------------


def depth_segments(
    reads: DataFrame, keys: Sequence[str] = ("sample", "contig"), width: int = DEFAULT_WIDTH, merged: bool = True
) -> DataFrame:
    """Depth as half-open, zero-based segments of equal depth.

    Each read gives +1 at its start and -1 behind its end, cut at tile borders, so that a tile's running sum starts at
    zero; the deltas are summed per position (map side first). The work grows with reads, not with bases. Without
    ``merged`` segments stay cut at the borders, which sums and histograms of depth do not see.
    """
    mapped = reads.filter(lacks(UNMAPPED, SECONDARY, QC_FAIL, DUPLICATE))
    spans = mapped.select(*keys, (F.col("pos") - 1).alias("_first"), reference_end().alias("_stop")).filter("_first < _stop")
    cut = spans.withColumn(TILE, F.explode(bins_of(F.col("_first"), F.col("_stop") - 1, width)))
    ends = F.array(
        F.struct(F.greatest(F.col("_first"), F.col(TILE) * width).alias("start"), F.lit(1).alias("delta")),
        F.struct(F.least(F.col("_stop"), (F.col(TILE) + 1) * width).alias("start"), F.lit(-1).alias("delta")),
    )
    deltas = cut.select(*keys, TILE, F.inline(ends))
    summed = deltas.groupBy(*keys, TILE, "start").agg(F.sum("delta").alias("delta")).filter(F.col("delta") != 0)
    along = Window.partitionBy(*keys, TILE).orderBy("start")
    depths = summed.select(
        *keys, "start", F.lead("start").over(along).alias("end"),
        F.sum("delta").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("depth"),
    )
    pieces = depths.filter((F.col("depth") > 0) & F.col("end").isNotNull())
    if not merged:
        return pieces
    # At most two pieces of a tile touch its borders; runs of them with equal depth are one segment.
    touches = (F.col("start") % width == 0) | (F.col("end") % width == 0)
    order = Window.partitionBy(*keys).orderBy("start")
    goes_on = (F.lag("end").over(order) == F.col("start")) & (F.lag("depth").over(order) == F.col("depth"))
    opened = pieces.filter(touches).withColumn("_open", F.when(goes_on, 0).otherwise(1))
    runs = opened.withColumn("_run", F.sum("_open").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = runs.groupBy(*keys, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("depth").alias("depth"))
    return pieces.filter(~touches).unionByName(whole.drop("_run"))


def depth_positions(
    segments: DataFrame, contigs: DataFrame | None = None, keys: Sequence[str] = ("sample",)
) -> DataFrame:
    """One row per covered position (1-based); with contig lengths, zero-depth positions too.

    Zero depths come from the gaps, as one segment each, before anything is exploded.
    """
    if contigs is not None:
        segments = fill_gaps(segments, contigs, keys)
    positions = F.sequence(F.col("start") + 1, F.col("end"))
    return segments.select(*keys, "contig", F.explode(positions).alias("pos"), "depth")


def fill_gaps(
    segments: DataFrame, contigs: DataFrame, keys: Sequence[str] = ("sample",), width: int = DEFAULT_WIDTH
) -> DataFrame:
    """Add segments of depth 0, up to the contig length.

    ``contigs`` (contig, length) is the reference index, tiny against the reads; each sample that
    occurs gets every contig's two edges as empty segments and the gaps open between neighbours.
    """
    frame = product(segments.select(*keys).distinct(), contigs.select("contig", "length"))
    edges = F.array(F.lit(0).cast("bigint"), F.col("length").cast("bigint"))
    marks = frame.select(*keys, "contig", F.explode(edges).alias("start")).withColumn("end", F.col("start"))
    group = [*keys, "contig"]
    # Breaks: every start and every end; a gap begins where a segment ends and none starts.
    ends = segments.select(*group, F.col("end").alias("start")).unionByName(marks.select(*group, "start"))
    opens = segments.groupBy(*group, "start").agg(F.max("end").alias("stop"), F.max("depth").alias("depth"))
    breaks = ends.distinct().join(opens, [*group, "start"], "full_outer")
    following = next_value(breaks, group, "start", width, out="end").filter(F.col("end").isNotNull())
    filled = following.withColumn("depth", F.coalesce("depth", F.lit(0).cast("bigint")))
    return filled.select(*group, "start", "end", "depth")


def filled_depth(
    segments: DataFrame, contigs: DataFrame, keys: Sequence[str] = ("sample",), low: int = 3
) -> DataFrame:
    """Per sample and contig: ``positions``, those of depth below ``low``, and the sum of depths (``bases``).

    Positions without reads count too: what disjoint segments (inside their contig) leave of its length has depth zero, so
    no gap is made as a row. Segments are summed where they lie before anything is moved. Those of a null sample or contig,
    which `fill_gaps` does not match with their breaks, go through it.
    """
    width = F.col("end") - F.col("start")
    known = F.lit(True)
    for key in (*keys, "contig"):
        known = known & F.col(key).isNotNull()
    odd = fill_gaps(segments.filter(~known), contigs, keys).filter(~known)
    held = segments.filter(known).select(*keys, "contig", "start", "end", "depth").unionByName(odd)
    sums = held.groupBy(*keys, "contig").agg(
        F.sum(F.when(F.col("depth") >= low, width).otherwise(0)).alias("_deep"), F.sum(F.col("depth") * width).alias("bases")
    )
    frame = product(sums.select(*keys).distinct(), contigs.select("contig", "length"))
    length, none = F.col("length").cast("bigint"), F.lit(0).cast("bigint")
    return attach(frame, sums, [*keys, "contig"]).select(
        *keys, "contig", length.alias("positions"), (length - F.coalesce("_deep", none)).alias(f"below_{low}"), F.coalesce("bases", none).alias("bases")
    )


def window_depth(
    segments: DataFrame, contigs: DataFrame, step: int = 200, samples: DataFrame | None = None
) -> DataFrame:
    """Mean depth per fixed window of every contig, uncovered bases and windows count as zero.

    The last window may be short. Samples are those of ``samples``, else those with any segment.
    """
    pieces = split_at(segments, step)
    covered = pieces.groupBy("sample", "contig", "window").agg(
        F.sum(F.col("depth") * (F.col("end") - F.col("start"))).alias("bases")
    )
    last = F.floor((F.col("length") - 1) / step).cast("bigint")
    windows = contigs.filter(F.col("length") > 0).select(
        "contig", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("window")
    )
    # Samples x windows is the table itself; a null name is like no other.
    covered = covered.filter(F.col("sample").isNotNull() & F.col("contig").isNotNull())
    block = F.floor(F.col("window") / BLOCK).alias("_block")
    names = (segments if samples is None else samples).select("sample").distinct()
    frame = product_with(names, windows.select("*", block), covered.select("*", block), ["contig", "_block"], ["window"])
    sized = frame.fillna(0, ["bases"])
    first = F.col("window") * step
    return sized.select(
        "sample",
        "contig",
        first.alias("start"),
        F.least(first + step, F.col("length")).alias("end"),
        ratio(F.col("bases"), F.least(first + step, F.col("length")) - first).alias("coverage"),
    )


def region_depth(
    segments: DataFrame,
    regions: DataFrame,
    thresholds: Sequence[int] = (0, 1, 10, 50, 100, 500),
    samples: DataFrame | None = None,
) -> DataFrame:
    """Median depth per region and the bases at or above each threshold, for every sample and region.

    A region without a read (an amplicon that dropped out) has depth 0. Samples are those of
    ``samples``, else those with any segment.

    Segments meet regions by an overlap join on bins; the median is weighted by overlap length over
    a (region, depth) histogram, so the single bases are never built.
    """
    keys = ["sample", "contig", "r_start", "r_end", "r_region"]
    block = F.floor(F.col("r_start") / DEFAULT_WIDTH).alias("_block")
    size = F.col("r_end") - F.col("r_start")
    shared = F.least("end", "r_end") - F.greatest("start", "r_start")
    # Pairs move once, to their sample's block of regions: histograms, medians and the blocks' maps are made there.
    pairs = overlapping(segments, regions, ["contig"]).select(*keys, block, F.col("depth").cast("bigint").alias("depth"), shared.cast("bigint").alias("bases"))
    dealt = pairs.repartition("sample", "contig", "_block")
    histogram = dealt.groupBy(*keys, "_block", "depth").agg(F.sum("bases").alias("bases"))
    listed = histogram.groupBy(*keys, "_block").agg(F.collect_list(F.struct("depth", "bases")).alias("_depths"))
    # Bases of the region without any segment have depth 0; a null name is like no other.
    none = F.lit(0).cast("bigint")
    total = lambda value: F.aggregate("_depths", none, lambda sum_, d: sum_ + value(d))
    missing = size.cast("bigint") - F.when(F.col("sample").isNotNull(), total(lambda d: d["bases"])).otherwise(0)
    zero = F.array(F.struct(none.alias("depth"), F.col("_missing").alias("bases")))
    full = listed.withColumn("_missing", missing).withColumn("_depths", F.array_sort(F.when(F.col("_missing") > 0, F.concat("_depths", zero)).otherwise(F.col("_depths"))))
    levels = {f"at_{t}x": t for t in thresholds}
    above = [total(lambda d, t=t: F.when(d["depth"] >= t, d["bases"]).otherwise(none)).alias(n) for n, t in levels.items()]
    met = full.withColumn("_n", total(lambda d: d["bases"])).select(*keys, "_block", _middle("_depths", F.col("_n")).alias("coverage"), *above)
    named = regions.select(
        "contig", F.col("start").alias("r_start"), F.col("end").alias("r_end"), F.col("region").alias("r_region")
    ).distinct()
    # Samples x regions is the table itself: those that no segment meets are all depth 0.
    names = (segments if samples is None else samples).select("sample").distinct()
    frame = product_with(names, named.select("*", block), met, ["contig", "_block"], keys[2:], runs=True)
    zeros = {n: F.coalesce(F.col(n), size if t <= 0 else F.lit(0)).cast("bigint") for n, t in levels.items()}
    out = frame.withColumns({"coverage": F.coalesce("coverage", F.lit(0.0)), **zeros}).filter(size > 0)
    return out.select(*keys, "coverage", *levels).withColumnsRenamed({"r_start": "start", "r_end": "end", "r_region": "region"})


def _middle(depths: str, count: Column) -> Column:
    """Median of ``count`` bases whose depths are listed as (depth, bases), in order: the mean of the two in the middle."""
    state = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("low"), F.lit(None).cast("bigint").alias("high"))

    def step(s: Column, d: Column) -> Column:
        seen = s["seen"] + d["bases"]
        reached = lambda rank, value: F.when(value.isNull() & (seen > rank), d["depth"]).otherwise(value)
        return F.struct(seen.alias("seen"), reached(F.floor((count - 1) / 2), s["low"]).alias("low"), reached(F.floor(count / 2), s["high"]).alias("high"))

    return F.aggregate(depths, state, step, lambda s: (s["low"] + s["high"]) / F.lit(2.0))


# --- pileup ----------------------------------------------------------------------------------------


def placed_ops() -> Column:
    """CIGAR operations as an array of (op, at, read, len): first reference position and first read place (1-based)."""
    ops = cigar_ops(F.col("cigar"))
    refs = "MDN=X"
    return F.aggregate(
        ops,
        F.struct(
            F.col("pos").cast("bigint").alias("at"),
            F.lit(1).alias("read"),
            F.expr("cast(array() as array<struct<op:string,at:bigint,read:int,len:int>>)").alias("done"),
        ),
        lambda acc, p: F.struct(
            (acc["at"] + F.when(F.instr(F.lit(refs), p["op"]) > 0, p["len"]).otherwise(0)).alias("at"),
            (acc["read"] + F.when(F.instr(F.lit(QUERY_OPS), p["op"]) > 0, p["len"]).otherwise(0)).alias("read"),
            F.concat(
                acc["done"],
                F.array(
                    F.struct(
                        p["op"].alias("op"), acc["at"].alias("at"), acc["read"].alias("read"), p["len"].alias("len")
                    )
                ),
            ).alias("done"),
        ),
        lambda acc: acc["done"],
    )


def aligned_pieces(reads: DataFrame, width: int = SITES) -> DataFrame:
    """Aligned stretches of one letter a place, deletions and insertions, cut at every ``width`` positions.

    ``text`` holds the letters (``_each``) or one text for all ``_n`` places from ``_at`` on, ``codes`` the qualities alike. All
    rows of a tile come to one task, as stretches and not as bases: later steps per site move nothing.
    """
    pieces = reads.filter(lacks(UNMAPPED, SECONDARY, QC_FAIL, DUPLICATE)).select(
        "sample", "contig", "seq", "qual", has(REVERSE).alias("reverse"), F.inline(placed_ops())
    )
    each, inserted = F.col("op").isin("M", "=", "X"), F.col("op") == "I"
    shown = pieces.filter(F.col("op").isin("M", "=", "X", "D", "I")).withColumns({
        "_from": F.col("at") - F.when(inserted, 1).otherwise(0),
        "_size": F.when(inserted, 1).otherwise(F.col("len")),
        "_each": each,
    })
    # A row without a position keeps its bases, in a tile of their own.
    tiles = bins_of(F.col("_from") - 1, F.col("_from") + F.col("_size") - 2, width)
    cut = shown.select("*", F.explode_outer(tiles).alias(TILE)).withColumn("_at", F.greatest(F.col("_from"), F.col(TILE) * width + 1))
    skip = F.coalesce(F.col("_at") - F.col("_from"), F.lit(0)).cast("int")
    left = F.least(F.col("_size") - skip, ((F.col(TILE) + 1) * width - F.col("_at") + 1).cast("int"))
    first = F.col("read") + skip
    text = (
        F.when(F.col("op") == "D", "*")
        .when(inserted, F.concat(F.lit("+"), F.substr("seq", F.col("read"), F.col("len"))))
        .otherwise(F.substr(F.col("seq"), first, left))
    )
    codes = F.when(F.col("_each"), F.substr(F.col("qual"), first, left)).otherwise(
        F.substr(F.col("qual"), F.greatest(F.col("read"), F.lit(1)), F.lit(1))
    )
    rows = cut.select(
        "sample", "contig", TILE, "_at", left.alias("_n"), "_each", text.alias("text"), codes.alias("codes"), "reverse"
    )
    return rows.repartition("sample", "contig", TILE)


def aligned_bases(reads: DataFrame, tiles: bool = False) -> DataFrame:
    """One row per aligned base or deletion: (pos, base, quality, reverse). Narrow.

    Insertions hang on the base before them as ``+XYZ``, deletions as ``-`` plus the number of bases
    on the base before and ``*`` on each deleted position. ``tiles`` keeps the tile that the rows lie together by.
    """
    steps = aligned_pieces(reads).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    place = F.when(F.col("_each"), F.col("_i") + 1)
    base = F.when(F.col("_each"), F.substr(F.col("text"), place, F.lit(1))).otherwise(F.col("text"))
    quality = F.ascii(F.substr(F.col("codes"), F.coalesce(place, F.lit(1)), F.lit(1))) - 33
    kept = ["sample", "contig", TILE] if tiles else ["sample", "contig"]
    return steps.select(*kept, (F.col("_at") + F.col("_i")).alias("pos"), base.alias("base"), quality.alias("quality"), "reverse")


def sites(df: DataFrame) -> list[str]:
    """Key of one site; with the tile, if ``df`` has it, rows are already where a step per site needs them."""
    return ["sample", "contig", *([TILE] if TILE in df.columns else []), "pos"]


def pileup_counts(reads: DataFrame, min_quality: int = 0, tiles: bool = False) -> DataFrame:
    """Base counts per position with strand split and summed quality; reads move once, before they become bases."""
    bases = aligned_bases(reads, tiles=True).filter(F.col("quality") >= min_quality)
    counts = bases.groupBy(*sites(bases), "base").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("reverse"), 1)).alias("n_reverse"),
        F.sum("quality").cast("bigint").alias("quality_sum"),
    )
    return counts if tiles else counts.drop(TILE)


def reference_blocks(reference: DataFrame, width: int = SITES) -> DataFrame:
    """Rows ``(contig, pos, ref)`` as ``(contig, _tile, _text, _odd)``: a letter per position, one row for ``width`` of them.

    ``_text`` has a blank where a position lacks, repeats or is not one letter; the latter two are listed in ``_odd``.
    """
    refs = reference.filter(F.col("pos").isNotNull()).groupBy("contig", "pos").agg(F.collect_list("ref").alias("_refs"))
    first = F.get("_refs", F.lit(0))
    single = (F.size("_refs") == 1) & (F.length(first) == 1) & (first != " ")
    tile = F.floor((F.col("pos") - 1) / width).cast("bigint")
    placed = refs.withColumn(TILE, tile).withColumn("_place", (F.col("pos") - 1 - F.col(TILE) * width).cast("int"))
    letters = F.collect_list(F.struct("_place", F.when(single, first).otherwise(" ").alias("letter")))
    blocks = placed.groupBy("contig", TILE).agg(
        F.array_sort(letters).alias("_letters"), F.map_from_entries(F.collect_list(F.when(~single, F.struct("pos", "_refs")))).alias("_odd")
    )
    text = F.aggregate("_letters", F.lit(""), lambda t, p: F.concat(F.rpad(t, p["_place"], F.lit(" ")), p["letter"]))
    # Moved once more as texts, so that the planner sees their size and not that of their letters.
    return blocks.select("contig", TILE, text.alias("_text"), "_odd").repartition("contig", TILE)


def call_variants(
    counts: DataFrame,
    reference: DataFrame,
    min_freq: float = 0.25,
    min_quality: float = 20,
    min_depth: int = 10,
) -> DataFrame:
    """Caller rows from base counts: every base that differs from the reference and is frequent enough.

    ``reference`` is (contig, pos, ref). Depth counts bases, not insertions; a variant needs mean
    quality, frequency and depth. A site's alleles become one row before they meet the reference, and only sites that
    are deep enough do; the reference comes to them as text.
    """
    site = Window.partitionBy(*sites(counts))
    alleles = F.collect_list(F.struct("base", "n", "n_reverse", "quality_sum"))
    deep = counts.select(
        "sample", "contig", "pos",
        F.sum(F.when(~F.col("base").startswith("+"), F.col("n"))).over(site).alias("total_dp"),
        alleles.over(site).alias("_alleles"), F.row_number().over(site.orderBy("base")).alias("_row"),
    ).filter((F.col("_row") == 1) & (F.col("total_dp") >= min_depth)).drop("_row")
    tile = F.floor((F.col("pos") - 1) / SITES).cast("bigint")
    blocks = deep.withColumn(TILE, tile).join(reference_blocks(reference), ["contig", TILE])
    letter = F.substr("_text", (F.col("pos") - F.col(TILE) * SITES).cast("int"), F.lit(1))
    refs = F.when(letter.isin("", " "), F.try_element_at("_odd", F.col("pos"))).otherwise(F.array(letter))
    placed = blocks.withColumn("ref", F.explode(refs)).drop(TILE, "_text", "_odd")
    mean_quality = lambda a: F.floor(a["quality_sum"] / a["n"]).cast("int")
    shown = F.get(F.filter("_alleles", lambda a: a["base"] == F.col("ref")), F.lit(0))
    rows = placed.withColumn("_ref", shown).select(
        "sample", "contig", "pos", "ref", "total_dp",
        F.coalesce("_ref.n", F.lit(0)).alias("ref_dp"), F.coalesce("_ref.n_reverse", F.lit(0)).alias("ref_rv"),
        F.coalesce(mean_quality(F.col("_ref")), F.lit(0)).alias("ref_qual"), F.explode("_alleles").alias("_a"),
    ).select(
        "sample", "contig", "pos", "ref", F.col("_a.base").alias("alt"), F.col("_a.n").alias("alt_dp"),
        F.col("_a.n_reverse").alias("alt_rv"), mean_quality(F.col("_a")).alias("alt_qual"),
        "total_dp", "ref_dp", "ref_rv", "ref_qual",
    )
    alts = rows.filter((F.col("alt") != F.col("ref")) & (F.col("alt") != "*"))
    called = alts.withColumn("alt_freq", ratio(F.col("alt_dp"), F.col("total_dp")))
    return called.filter(
        (F.col("alt_freq") >= min_freq) & (F.col("alt_qual") >= min_quality)
    )


# --- duplicates, metrics, primers ------------------------------------------------------------------


def unclipped_start() -> Column:
    """5' reference position with clipped bases added back; the end for reverse reads."""
    ops = cigar_ops(F.col("cigar"))
    head, tail = F.get(ops, F.lit(0)), F.get(ops, F.size(ops) - 1)
    clip = F.array(F.lit("S"), F.lit("H"))
    before = F.when(F.array_contains(clip, head["op"]), head["len"]).otherwise(0)
    after = F.when(F.array_contains(clip, tail["op"]), tail["len"]).otherwise(0)
    return F.when(has(REVERSE), reference_end() + after).otherwise(F.col("pos") - before)


def base_quality_score(minimum: int = 15) -> Column:
    """Sum of base qualities of at least ``minimum``."""
    codes = F.transform(F.split(F.col("qual"), ""), lambda c: F.ascii(c) - 33)
    return F.aggregate(codes, F.lit(0), lambda acc, q: acc + F.when(q >= minimum, q).otherwise(0))


def mark_duplicates(
    reads: DataFrame, mate: str = "mate_pos", order: Sequence[str] = ("qname", "flag"), remove: bool = False
) -> DataFrame:
    """Set the duplicate bit on all but the best read of each (contig, 5' end, strand, mate) group.

    The best read comes from ``max_by`` (partial per map task), joined back; a group of copies that
    holds a third of the reads never has to be sorted in one task.
    """
    keyed = reads.withColumn("_five", F.when(lacks(UNMAPPED, SECONDARY, SUPPLEMENTARY), unclipped_start()))
    keyed = keyed.withColumn("_strand", has(REVERSE))
    group = ["sample", "contig", "_five", "_strand", mate]
    names = [f"_best_{c}" for c in order]
    # Best = highest quality, ties to the first read name.
    score = (-base_quality_score()).alias("_score")
    best = keyed.filter(F.col("_five").isNotNull()).groupBy(*group).agg(
        F.min(F.struct(score, *order)).alias("_best")
    )
    best = best.select(*group, *[F.col(f"_best.{c}").alias(n) for c, n in zip(order, names)])
    joined = attach(keyed, best, group)
    is_best = F.lit(True)
    for column, name in zip(order, names):
        is_best = is_best & F.col(column).eqNullSafe(F.col(name))
    copy = F.col("_five").isNotNull() & ~is_best
    if remove:
        joined = joined.filter(~copy)
    flag = F.when(copy, F.col("flag").bitwiseOR(DUPLICATE)).otherwise(F.col("flag").bitwiseAND(~DUPLICATE))
    return joined.withColumn("flag", flag).drop("_five", "_strand", *names)


def insert_size_histogram(reads: DataFrame, size: str = "tlen") -> DataFrame:
    """Histogram of insert sizes of first reads in mapped pairs."""
    pairs = reads.filter(has(PAIRED, READ1) & lacks(UNMAPPED, MATE_UNMAPPED, SECONDARY, SUPPLEMENTARY, DUPLICATE))
    return pairs.filter(F.col(size) != 0).groupBy("sample", F.abs(size).alias("insert_size")).agg(
        F.count(F.lit(1)).alias("pairs")
    )


def base_by_cycle(reads: DataFrame, strand_aware: bool = True) -> DataFrame:
    """Base counts and summed quality per sequencing cycle (read direction)."""
    length = F.length("seq")
    cycles = reads.withColumn("_i", F.explode(F.sequence(F.lit(1), length)))
    cycle = F.when(has(REVERSE), length - F.col("_i") + 1).otherwise(F.col("_i")) if strand_aware else F.col("_i")
    base = F.substr(F.col("seq"), F.col("_i"), F.lit(1))
    quality = F.ascii(F.substr(F.col("qual"), F.col("_i"), F.lit(1))) - 33
    counts = [F.count(F.when(base == b, 1)).alias(b.lower()) for b in "ACGTN"]
    return cycles.filter(length > 0).groupBy("sample", cycle.alias("cycle")).agg(
        *counts, F.sum(quality).cast("bigint").alias("quality_sum"), F.count(F.lit(1)).alias("total")
    )


def trim_primers(
    reads: DataFrame,
    primers: DataFrame,
    min_length: int = 30,
    keep_without_primer: bool = True,
    offset: int = 0,
    key: Sequence[str] = ("sample", "qname", "flag"),
) -> DataFrame:
    """Reference span that is left after the primer that holds a read's 5' end, as a report.

    A forward read is clipped up to the primer's end, a reverse read from the primer's start; of
    several primers the one that clips most counts. ``trim_start``/``trim_end`` are the 1-based span
    left; reads shorter than ``min_length`` go. `primers.clip_alignments` rewrites the alignments and trims by quality.
    """
    ends = drop_unmapped(reads).withColumns(
        {"ref_end": reference_end(), "reverse": has(REVERSE)}
    ).withColumn("five", F.when(F.col("reverse"), F.col("ref_end")).otherwise(F.col("pos")))
    sides = primers.select(
        "contig",
        (F.col("start") + 1 - F.when(F.col("strand") == "-", offset).otherwise(0)).alias("p_first"),
        (F.col("end") + F.when(F.col("strand") == "+", offset).otherwise(0)).alias("p_last"),
        (F.col("strand") == "-").alias("p_reverse"),
    ).distinct()
    hits = point_in_interval(
        ends.select(*key, "contig", "five", "reverse"), sides, ["contig"], "five", "p_first", "p_last", width=64
    ).filter(F.col("reverse") == F.col("p_reverse"))
    clips = hits.groupBy(*key).agg(F.max("p_last").alias("p_last"), F.min("p_first").alias("p_first"))
    clipped = ends.join(clips, list(key), "inner" if not keep_without_primer else "left")
    begin = F.when(~F.col("reverse") & F.col("p_last").isNotNull(), F.col("p_last") + 1).otherwise(F.col("pos"))
    end = F.when(F.col("reverse") & F.col("p_first").isNotNull(), F.col("p_first") - 1).otherwise(F.col("ref_end"))
    spans = clipped.withColumns({"trim_start": begin, "trim_end": end, "has_primer": F.col("p_last").isNotNull()})
    long = F.col("trim_end") - F.col("trim_start") + 1 >= min_length
    return spans.filter(long).drop("five", "p_last", "p_first")
