"""Operators over reads ``(sample, read_id, seq, qual)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virotide.functions.numbers import ratio
from virotide.operators.channels import product
from virotide.operators.gates import with_all


def qualities(qual: Column) -> Column:
    """Phred values of a quality text as an array."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (a lambda variable, so it is never inlined)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` added or replaced, each evaluated once per row: nothing is moved or copied through a generator."""
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))))


def _window_mean_cut(values: Column, window: int, mean: int) -> Column:
    """Number of leading values to drop: start of the first window whose sum reaches the mean."""
    size = F.size(values)
    starts = F.sequence(F.lit(0), F.greatest(size - window, F.lit(0)))

    def good(i):
        total = F.get(values, i)
        for step in range(1, window):
            total = total + F.get(values, i + step)
        return F.coalesce(total >= mean * window, F.lit(False))

    place = F.array_position(F.transform(starts, good), True)
    return F.when(place > 0, place - 1).otherwise(size).cast("int")


def trim_reads(
    reads: DataFrame,
    mean_quality: int = 30,
    window: int = 4,
    base_quality: int = 30,
    low_percent: float = 10,
    min_length: int = 50,
    poly: str | None = "ACGT",
    poly_length: int = 10,
) -> DataFrame:
    """Quality trimming by sliding windows from both ends, poly-X tail trim, then the read filters.

    Kept are reads with at most ``low_percent`` of bases below ``base_quality`` and at least
    ``min_length`` bases. All of it is one generator over the row: no shuffle, no Python.
    """
    pattern = "|".join(f"{b}{{{poly_length},}}" for b in poly or "")

    def cut(q):
        return let(
            F.struct(_window_mean_cut(q, window, mean_quality).alias("head"), F.reverse(q).alias("back")),
            lambda h: F.struct(
                h["head"].alias("head"),
                F.greatest(
                    F.size(q) - h["head"] - let(h["back"], lambda r: _window_mean_cut(r, window, mean_quality)), F.lit(0)
                ).alias("keep"),
            ),
        )

    def trimmed(c):
        seq = F.substr(F.col("seq"), c["head"] + 1, c["keep"])
        seq = F.regexp_replace(seq, f"(?:{pattern})$", "") if poly else seq
        return let(
            seq,
            lambda s: let(
                F.substr(F.col("qual"), c["head"] + 1, F.length(s)),
                lambda q: F.struct(
                    s.alias("seq"),
                    q.alias("qual"),
                    ratio(F.size(F.filter(qualities(q), lambda v: v < base_quality)) * 100, F.length(q)).alias("_low"),
                ),
            ),
        )

    def passes(r):
        return (F.length(r["seq"]) >= min_length) & (F.coalesce(r["_low"], F.lit(100.0)) <= low_percent)

    rest = [c for c in reads.columns if c not in ("seq", "qual")]
    result = let(let(qualities(F.col("qual")), cut), trimmed)
    return reads.select(*rest, F.inline(F.filter(F.array(result), passes))).drop("_low")


def trim_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Read counts before and after trimming per sample, samples without any read left included."""
    total = before.groupBy("sample").agg(F.count(F.lit(1)).alias("before_filtering"))
    left = after.groupBy("sample").agg(F.count(F.lit(1)).alias("after_filtering"))
    return total.join(left, "sample", "left").fillna(0, ["after_filtering"])


def trim_adapters(
    reads: DataFrame, adapters: Sequence[str], three_prime: bool = False, overlap: int = 5, min_length: int = 30
) -> DataFrame:
    """Exact-match primer trim at the read start (``X`` adapters: anchored) or the read end.

    A 5' adapter counts anywhere unless it starts with ``X``, a 3' one drops all behind it; parts of
    at least ``overlap`` bases count at the open end. Error-tolerant matching stays with the external
    tool.
    """
    anchored = sorted({a[1:].upper() for a in adapters if a.upper().startswith("X")}, key=lambda a: (-len(a), a))
    free = sorted({a.upper() for a in adapters if not a.upper().startswith("X")}, key=lambda a: (-len(a), a))
    options = []
    if three_prime:
        options += [f"(?:{a}.*|{'|'.join(a[:n] for n in range(len(a) - 1, overlap - 1, -1))})$" if len(a) > overlap else f"{a}.*$" for a in free + anchored]
        pattern = "|".join(options)
    else:
        for a in anchored + free:
            tails = [a[n:] for n in range(0, max(len(a) - overlap, 0) + 1)]
            options += tails
        inside = "|".join(free)
        pattern = f"^(?:{'.*?(?:' + inside + ')|' if inside else ''}{'|'.join(sorted(set(options), key=lambda t: (-len(t), t)))})"
    trimmed = F.regexp_replace("seq", pattern, "") if adapters else F.col("seq")
    cut = reads.withColumn("_new", trimmed)
    gone = F.length("seq") - F.length("_new")
    qual = F.substr("qual", F.lit(1), F.length("_new")) if three_prime else F.substr("qual", gone + 1, F.length("_new"))
    out = cut.withColumn("qual", qual).withColumn("seq", F.col("_new")).drop("_new")
    return out.filter(F.length("seq") >= min_length)


def length_filter(reads: DataFrame, low: int = 400, high: int = 700) -> DataFrame:
    """Pooled long reads within the expected amplicon length."""
    return reads.filter(F.length("seq").between(low, high))


def amplicon_lengths(primer_set_version: object) -> tuple[int, int]:
    """Length limits of the 1200-base scheme and of all others."""
    return (250, 1500) if str(primer_set_version) == "1200" else (400, 700)


def pooled_reads(reads: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Reads per sample; a listed sample without any has 0, so that it can fail its gate."""
    return with_all(reads.groupBy("sample").agg(F.count(F.lit(1)).alias("count")), samples, ["sample"], "count")


def mate_files(files: DataFrame, single_end: bool = False, index: str = "idx") -> DataFrame:
    """Replicate files of a sample: paired lists hold R1 at even and R2 at odd places."""
    if single_end:
        return files.withColumn("mate", F.lit(1))
    return files.withColumn("mate", (F.col(index) % 2 + 1).cast("int"))


def quality_by_cycle(reads: DataFrame) -> DataFrame:
    """Mean quality and base mix per cycle; counts combine map side, one row per (sample, cycle)."""
    length = F.length("seq")
    rows = reads.filter(length > 0).withColumn("cycle", F.explode(F.sequence(F.lit(1), length)))
    base = F.substr(F.col("seq"), F.col("cycle"), F.lit(1))
    quality = F.ascii(F.substr(F.col("qual"), F.col("cycle"), F.lit(1))) - 33
    return rows.groupBy("sample", "cycle").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(quality).cast("bigint").alias("quality_sum"),
        F.count(F.when(base.isin("G", "C"), 1)).alias("gc"),
    )


def length_histogram(reads: DataFrame, step: int = 100) -> DataFrame:
    """Read counts and bases per length class."""
    bucket = (F.floor(F.length("seq") / step) * step).cast("bigint")
    return reads.groupBy("sample", bucket.alias("length_from")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("seq")).cast("bigint").alias("bases")
    )


def unclassified(reads: DataFrame, assignments: DataFrame) -> DataFrame:
    """Reads that the host classifier did not assign. Assigned ids are made distinct first."""
    hits = assignments.filter(F.col("status") == "C").select("sample", "read_id").distinct()
    return reads.join(hits, ["sample", "read_id"], "left_anti")


def classification_report(assignments: DataFrame, taxa: DataFrame) -> DataFrame:
    """Reads per taxon and their percentage per sample, taxa without reads included as zero rows.

    Counted before the join, so a taxon that holds most reads is one row there.
    """
    counts = assignments.groupBy("sample", "taxid").agg(F.count(F.lit(1)).alias("reads"))
    totals = counts.groupBy("sample").agg(F.sum("reads").alias("total"))
    frame = product(totals, taxa.select("taxid").distinct())
    full = frame.join(counts, ["sample", "taxid"], "left").fillna(0, ["reads"])
    return full.select("sample", "taxid", "reads", ratio(F.lit(100) * F.col("reads"), F.col("total")).alias("percent"))


def kmers(reads: DataFrame, k: int = 31) -> DataFrame:
    """All k-letter words of each read."""
    starts = F.sequence(F.lit(1), F.length("seq") - k + 1)
    rows = reads.filter(F.length("seq") >= k).select("*", F.explode(starts).alias("_at"))
    return rows.withColumn("kmer", F.substr("seq", F.col("_at"), F.lit(k))).drop("_at")


def canonical(kmer: Column) -> Column:
    """The lesser of a word and its reverse complement."""
    other = F.reverse(F.translate(kmer, "ACGT", "TGCA"))
    return F.least(kmer, other)


def solid_kmers(reads: DataFrame, k: int = 31, min_abundance: int = 20) -> DataFrame:
    """Words of A, C, G, T that occur at least ``min_abundance`` times in a sample, strand-neutral."""
    words = kmers(reads.select("sample", "seq"), k).filter(F.col("kmer").rlike("^[ACGT]+$"))
    counts = words.groupBy("sample", canonical(F.col("kmer")).alias("kmer")).agg(F.count(F.lit(1)).alias("abundance"))
    return counts.filter(F.col("abundance") >= min_abundance)
