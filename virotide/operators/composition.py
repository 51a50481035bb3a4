"""Sequence composition: base counts, runs of N, density along a sequence, contig statistics."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from virotide.functions.numbers import ratio
from virotide.operators.channels import first_row
from virotide.operators.tiles import TILE, attach, halo, running_sum

# Executors get the functions below with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bases that always have a row, in output order.
STANDARD_BASES = ("A", "C", "T", "G")
DENSITY_WINDOW = 1001


def first_record(records: DataFrame, order: Sequence[str] = ("src", "src2"), keys: Sequence[str] = ("sample",)) -> DataFrame:
    """The first record of each sample's file: the one that the tables of composition describe."""
    return first_row(records, order, keys)


def base_counts(records: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Count and percent of every base, A, C, T, G at 0 where absent; an absent N gives a NULL row.

    Each sequence counts its own letters (no row per base); counts are then summed per key.
    """
    letters = F.array_distinct(F.split("seq", ""))
    listed = F.array_union(letters, F.array(*[F.lit(b) for b in (*STANDARD_BASES, "N")]))
    rows = records.filter(F.length("seq") > 0).select(*keys, "seq", F.explode(listed).alias("base"))
    hits = F.length("seq") - F.length(F.replace(F.col("seq"), F.col("base"), F.lit("")))
    counted = rows.filter(F.col("base") != "").groupBy(*keys, "base").agg(F.sum(hits).cast("bigint").alias("freq"))
    totals = counted.groupBy(*keys).agg(F.sum("freq").alias("_total"))
    shares = counted.join(totals, list(keys))
    absent = (F.col("base") == "N") & (F.col("freq") == 0)
    # Place of each base in the table, then all others in letter order.
    place = F.coalesce(
        F.nullif(F.array_position(F.array(*[F.lit(b) for b in (*STANDARD_BASES, "N")]), F.col("base")), F.lit(0)),
        F.lit(6),
    )
    return shares.select(
        *keys,
        F.when(~absent, F.col("base")).alias("base"),
        F.when(~absent, F.col("freq")).alias("freq"),
        F.when(~absent, ratio(F.lit(100) * F.col("freq"), F.col("_total"))).alias("perc"),
        place.cast("int").alias("place"),
    )


def pieces(seq: Column, letter: str = "N") -> Column:
    """A sequence as its alternating stretches of ``letter`` and of anything else."""
    return F.regexp_extract_all(seq, F.lit(f"(?s)({letter}+|[^{letter}]+)"), 1)


def letter_runs(records: DataFrame, keys: Sequence[str] = ("sample",), letter: str = "N") -> DataFrame:
    """Runs of a letter, with the two readings of "start".

    ``start`` is the run's last position, as in the table to match; ``first`` is its true first one.
    The unit is one sequence cell; ends are running sums of stretch lengths inside that cell.
    """
    lengths = F.transform(pieces(F.col("seq"), letter), lambda p: F.struct(
        F.length(p).alias("width"), p.startswith(letter).alias("is_run"))
    )
    rows = records.select(*keys, F.posexplode(lengths).alias("_i", "_p")).select(
        *keys, "_i", F.col("_p.width").alias("width"), F.col("_p.is_run").alias("is_run")
    )
    order = Window.partitionBy(*keys).orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = rows.withColumn("start", F.sum("width").over(order)).filter("is_run")
    return ended.select(*keys, "start", F.col("width"), (F.col("start") - F.col("width") + 1).alias("first"))


def positions(
    records: DataFrame,
    keys: Sequence[str] = ("sample",),
    bases: Sequence[str] = STANDARD_BASES,
    extra: Sequence[str] = (),
) -> DataFrame:
    """One row per base with a 0/1 column per letter."""
    rows = records.filter(F.length("seq") > 0).select(
        *keys, *extra, F.posexplode(F.split("seq", "")).alias("_i", "base")
    )
    flags = [F.when(F.col("base") == b, 1).otherwise(0).alias(b.lower()) for b in bases]
    return rows.select(*keys, *extra, (F.col("_i") + 1).cast("bigint").alias("position"), *flags)


def base_density(
    records: DataFrame,
    keys: Sequence[str] = ("sample",),
    bases: Sequence[str] = STANDARD_BASES,
    k: int = DENSITY_WINDOW,
    width: int = 1 << 15,
) -> DataFrame:
    """Running mean of each letter over ``k`` positions; the first and last k//2 rows are constant.

    The record of a key that occurs once is counted where it lies, ``width`` positions at a time, so no base is moved.
    A sequence shorter than ``k`` has no full window and gives NULL.
    """
    records = records.filter(F.length("seq") > 0)
    repeated = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    marked = attach(records.select(*keys, "seq"), repeated, keys)
    single = _density_in_place(marked.filter(F.col("_n").isNull()).drop("_n"), keys, bases, k, width)
    return single.unionByName(_density_of_repeated(marked.filter(F.col("_n").isNotNull()).drop("_n"), keys, bases, k, width))


def _density_in_place(records: DataFrame, keys: Sequence[str], bases: Sequence[str], k: int, width: int) -> DataFrame:
    """The means of whole sequences: sums of a window are differences of one running count per letter."""
    half, codes = (k - 1) // 2, [ord(b) for b in bases]
    names = [*keys, "position", *[f"{b.lower()}_mean" for b in bases]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                letters = np.frombuffer(batch.column(len(keys))[row].as_py().encode("utf-32-le"), np.uint32)
                size, own = len(letters), [batch.column(i).slice(row, 1) for i in range(len(keys))]
                for start in range(0, size, width):
                    count = min(width, size - start)
                    means = [pa.nulls(count, pa.float64())] * len(bases)
                    if size >= k:
                        # First letter of each position's window, and the stretch that holds them all.
                        first = np.clip(np.arange(start, start + count) - half, 0, size - k)
                        part = letters[first[0] : first[-1] + k]
                        at = first - first[0]
                        running = [np.concatenate(([0], np.cumsum(part == c))) for c in codes]
                        means = [pa.array((r[at + k] - r[at]) / k) for r in running]
                    spread = [pa.concat_arrays([c]).take(pa.array(np.zeros(count, np.int64))) for c in own]
                    yield pa.RecordBatch.from_arrays([*spread, pa.array(np.arange(start + 1, start + count + 1)), *means], names)

    schema = ", ".join([*[f"`{c}` {records.schema[c].dataType.simpleString()}" for c in keys], "position bigint", *[f"{n} double" for n in names[len(keys) + 1 :]]])
    return records.select(*keys, F.col("seq").cast("string")).mapInArrow(run, schema)


def _density_of_repeated(records: DataFrame, keys: Sequence[str], bases: Sequence[str], k: int, width: int) -> DataFrame:
    """The means of keys with several records, whose rows run as one by position.

    The rows run per tile with a margin of k//2 rows copied from the neighbours, so one key is spread over
    tasks. The two constant ends are counted on the sequence text before it is split.
    """
    half = (k - 1) // 2

    def count_in(text, base):
        return F.length(text) - F.length(F.replace(text, F.lit(base), F.lit("")))

    ends = {"length": F.length("seq")}
    for base in bases:
        ends[f"_head_{base}"] = count_in(F.substring("seq", 1, k), base)
        ends[f"_tail_{base}"] = count_in(F.substring("seq", -k, k), base)
    rows = positions(records.withColumns(ends), keys, bases, extra=list(ends))
    spread = halo(rows, "position", half, width)
    order = Window.partitionBy(*keys, TILE).orderBy("position")
    # Window sums as differences of one running count: a sliding frame would add k rows per row.
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = spread.withColumns({f"_run_{b}": F.sum(b.lower()).over(running) for b in bases})
    means = []
    for base in bases:
        run = f"_run_{base}"
        inside = F.lead(run, half).over(order) - F.coalesce(F.lag(run, half + 1).over(order), F.lit(0))
        total = (
            F.when(F.col("position") <= half, F.col(f"_head_{base}"))
            .when(F.col("position") > F.col("length") - half, F.col(f"_tail_{base}"))
            .otherwise(inside)
        )
        mean = F.when(F.col("length") >= k, ratio(total, F.lit(k)))
        means.append(mean.alias(f"{base.lower()}_mean"))
    return counted.select(*keys, "position", "_own", *means).filter("_own").drop("_own")


# --- contigs ---------------------------------------------------------------------------------------


def contig_sizes(records: DataFrame) -> DataFrame:
    return records.select("contig", F.length("seq").cast("bigint").alias("length"))


def assembly_stats(contigs: DataFrame, keys: Sequence[str] = ("sample",), width: int = 1 << 10) -> DataFrame:
    """Contig counts, largest contig, N50, L50, GC percent and Ns per 100 kb.

    N50 needs a running sum by falling length: lengths are counted first, then summed tile by tile.
    """
    size = F.length("seq").cast("bigint")

    def letters(pattern):
        return size - F.length(F.regexp_replace("seq", pattern, ""))

    basics = contigs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("contigs"),
        F.count(F.when(size >= 1000, 1)).alias("contigs_1000"),
        F.count(F.when(size >= 5000, 1)).alias("contigs_5000"),
        F.max(size).alias("largest_contig"),
        F.sum(size).alias("total_length"),
        F.sum(letters("[Nn]")).alias("_n"),
        F.sum(letters("[GCgc]")).alias("_gc"),
        F.sum(letters("[ACGTacgt]")).alias("_acgt"),
    )
    lengths = contigs.groupBy(*keys, size.alias("length")).agg(F.count(F.lit(1)).alias("n"))
    weighted = lengths.withColumn("bases", F.col("n") * F.col("length"))
    sums = running_sum(weighted, keys, "length", {"sum_bases": "bases", "sum_n": "n"}, width, descending=True)
    half = sums.join(basics.select(*keys, "total_length"), list(keys))
    reached = half.filter(F.col("sum_bases") * 2 >= F.col("total_length"))
    top = reached.groupBy(*keys).agg(F.max(F.struct("length", "sum_bases", "sum_n", "total_length")).alias("_top"))
    # Of the contigs of that length, those beyond half of all bases are not needed.
    spare = F.floor((2 * F.col("_top.sum_bases") - F.col("_top.total_length")) / (2 * F.col("_top.length")))
    n50 = top.select(*keys, F.col("_top.length").alias("n50"), (F.col("_top.sum_n") - spare).cast("bigint").alias("l50"))
    return basics.join(n50, list(keys)).select(
        *keys, "contigs", "contigs_1000", "contigs_5000", "largest_contig", "total_length", "n50", "l50",
        ratio(F.lit(100) * F.col("_gc"), F.col("_acgt")).alias("gc_percent"),
        ratio(F.lit(100000) * F.col("_n"), F.col("total_length")).alias("ns_per_100kb"),
    )
