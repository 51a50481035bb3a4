"""Primer removal: error-tolerant from read ends, and from alignments by rewriting their CIGAR.

Adapters are looked for read by read, at the places of short exact pieces; edit distances are the built-in ``levenshtein``. Alignments are rewritten row by row from their CIGAR operations.
"""

from __future__ import annotations

import itertools
import re
import sys
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virotide.operators.alignments import drop_unmapped, has, placed_ops, reference_end
from virotide.operators.intervals import point_in_interval
from virotide.operators.reads import let, settled

# Executors get the functions below with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Letters that each ambiguity code stands for.
AMBIGUITY = {
    "A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}
#: Plain spellings that one adapter with ambiguity codes may stand for.
MOST_SPELLINGS = 4096


def spellings(adapter: str) -> list[str]:
    """The plain texts that an adapter with ambiguity codes stands for."""
    letters = [AMBIGUITY[c] for c in adapter.upper()]
    count = 1
    for choice in letters:
        count *= len(choice)
    if count > MOST_SPELLINGS:
        raise ValueError(f"{adapter} has {count} spellings, more than {MOST_SPELLINGS}")
    return ["".join(p) for p in itertools.product(*letters)]


def _errors(length: int, per_mille: int) -> int:
    return length * per_mille // 1000


def seed_length(longest: int, overlap: int, per_mille: int) -> int:
    """Letters of the shortest piece if each part of up to ``longest`` letters is cut once more than errors allow."""
    return min(m // (_errors(m, per_mille) + 1) for m in range(overlap, max(longest, overlap) + 1))


def _seeds(adapters: Sequence[str], three_prime: bool, overlap: int, per_mille: int) -> list[tuple]:
    """``(part, internal, errors, at, seed)``: a part of an adapter occurs within its errors only if one of its seeds
    occurs exactly, at most ``errors`` places from ``at`` (within the part, from 0)."""
    whole = [(a[1:] if a.upper().startswith("X") else a, not a.upper().startswith("X")) for a in adapters]
    size = seed_length(max(len(a) for a, _ in whole), overlap, per_mille)
    out = set()
    for adapter, internal in whole:
        for text in spellings(adapter):
            text = text[::-1] if three_prime else text
            for m in range(overlap, len(text) + 1):
                part, k = text[len(text) - m :], _errors(m, per_mille)
                inside = internal and m == len(text)
                out.update((part, inside, k, m * i // (k + 1), part[m * i // (k + 1) :][:size]) for i in range(k + 1))
    return sorted(out)


def _seed_hits(rows: list[tuple]) -> Callable[[str], list[tuple]]:
    """A function that lists ``(part, internal, errors, start)`` of the parts whose seeds occur in a text where they may."""
    reach = max(len(r[0]) + r[2] for r in rows) + len(rows[0][4])
    parts: dict[str, list[tuple]] = {}
    for part, internal, errors, at, seed in rows:
        parts.setdefault(seed, []).append((part, internal, errors, at))
    listed = lambda seeds: re.compile(f"(?=({'|'.join(sorted(seeds))}))") if seeds else None
    near, far = listed({r[4] for r in rows}), listed({r[4] for r in rows if r[1]})

    def hits(text: str) -> list[tuple]:
        # Parts that must stand at the start may be off by their errors, so the rest of a text is searched for the others alone.
        found = set()
        for pattern, stretch in ((near, text[:reach]), (far, text)):
            for place in pattern.finditer(stretch) if pattern else ():
                for part, internal, errors, at in parts[place.group(1)]:
                    start = place.start() - at
                    if start >= -errors if internal else abs(start) <= errors:
                        found.add((part, internal, errors, max(start, 0) if internal else 0))
        return sorted(found)

    return hits


def with_cut(
    reads: DataFrame, text: str, adapters: Sequence[str], three_prime: bool = False, overlap: int = 5, error_rate: float = 0.1
) -> DataFrame:
    """``reads`` with ``cut``: how many letters of the column ``text`` go from its start (null if no adapter was found).

    Of all parts found the one with the most letters less twice its errors counts, then the fewest errors, then the
    longest cut. ``text`` is reversed for 3' adapters. Seeds say where to look; nothing is moved or copied per place.
    """
    rows = _seeds(adapters, three_prime, overlap, round(error_rate * 1000))
    names = ("part", "internal", "errors", "start")
    kind = pa.list_(pa.struct([("part", pa.string()), ("internal", pa.bool_()), ("errors", pa.int32()), ("start", pa.int32())]))

    def run(texts: pa.Array) -> pa.Array:
        hits = _seed_hits(rows)
        return pa.array([t if t is None else [dict(zip(names, h, strict=True)) for h in hits(t)] for t in texts.to_pylist()], kind)

    found = F.arrow_udf(run, "array<struct<part: string, internal: boolean, errors: int, start: int>>")

    def judged(hit: Column, s: Column, n: Column) -> Column:
        wrong = F.call_function("levenshtein", hit["part"], F.substr(F.col(text), s + 1, n), hit["errors"])
        fits = (wrong >= 0) & (s + n <= F.length(text))
        return F.when(fits, F.struct((F.length(hit["part"]) - 2 * wrong).alias("score"), (-wrong).alias("right"), (s + n).alias("cut")))

    def best(hit: Column) -> Column:
        size, errors, start = F.length(hit["part"]), hit["errors"], hit["start"]
        lengths = F.sequence(F.greatest(size - errors, F.lit(1)), size + errors)
        starts = F.when(hit["internal"], F.sequence(F.greatest(start - errors, F.lit(0)), start + errors)).otherwise(F.array(F.lit(0)))
        return F.array_max(F.flatten(F.transform(starts, lambda s: F.transform(lengths, lambda n: judged(hit, s, n)))))

    searched = reads.withColumn("_hits", found(text))
    return settled(searched, cut=F.array_max(F.transform("_hits", best))["cut"]).drop("_hits")


def trim_tolerant(
    reads: DataFrame,
    adapters: Iterable[str],
    three_prime: bool = False,
    overlap: int = 5,
    error_rate: float = 0.1,
    min_length: int = 30,
) -> DataFrame:
    """Adapter trimming that allows ``error_rate`` edits per adapter letter, rounded down; ambiguity codes count as any of theirs.

    An adapter that starts with ``X`` must begin at the read's end or hang over it; any part of at least ``overlap``
    letters counts. Others may also stand inside; all before (3': behind) goes with them. Letters of a read stand for
    themselves only. ``adapters`` is one primer scheme. Reads shorter than ``min_length`` go; a null read goes.
    """
    adapters = sorted(set(adapters))
    turned = F.reverse("seq") if three_prime else F.col("seq")
    if not adapters:
        return reads.filter(F.length("seq") >= min_length)
    longest = max(len(a) for a in adapters)
    # Where no adapter can stand inside, the start of a read is all that is searched.
    ended = all(a.upper().startswith("X") for a in adapters)
    key = F.substr(F.upper(turned), F.lit(1), F.lit(longest + _errors(longest, round(error_rate * 1000)))) if ended else F.upper(turned)
    found = with_cut(settled(reads, _text=key), "_text", adapters, three_prime, overlap, error_rate).drop("_text")
    cut = F.coalesce("cut", F.lit(0))
    first, left = (F.lit(1), F.length("seq") - cut) if three_prime else (cut + 1, F.length("seq") - cut)
    kept = found.withColumns({"seq": F.substr("seq", first, left), "qual": F.substr("qual", first, left)}).drop("cut")
    return kept.filter(F.length("seq") >= min_length).select(*reads.columns)


# --- alignments -------------------------------------------------------------------------------------


def _first_low(a: Column, b: Column, backwards: Column, window: int, mean: int) -> Column:
    """Read place at which the first window of mean quality below ``mean`` begins, seen from the 5' end."""
    quality = lambda i: F.ascii(F.substr(F.col("qual"), i, F.lit(1))) - 33
    oriented = let(
        F.transform(F.sequence(a, b), quality), lambda q: F.when(backwards, F.reverse(q)).otherwise(q)
    )

    def low(values: Column) -> Column:
        def sums(i: Column) -> Column:
            count = F.least(F.lit(window), F.size(values) - i)
            total = F.get(values, i)
            for step in range(1, window):
                total = total + F.coalesce(F.get(values, i + step), F.lit(0))
            return total < mean * count

        return F.array_position(F.transform(F.sequence(F.lit(0), F.size(values) - 1), sums), True)

    return F.when(a <= b, let(oriented, low)).otherwise(0)


def clip_alignments(
    reads: DataFrame,
    primers: DataFrame,
    min_length: int = 30,
    min_quality: int = 20,
    window: int = 4,
    offset: int = 0,
    keep_without_primer: bool = True,
) -> DataFrame:
    """Alignments with primers and low-quality ends turned into soft clips: ``pos`` and ``cigar`` are rewritten.

    A forward read loses what lies before the end of the primer that holds its 5' end, a reverse read what lies behind
    its primer's start; of several primers the one that clips most counts. Then a window of ``window`` bases (fewer at the
    very end) slides from the 5' end, and the read is cut where its mean quality first falls below ``min_quality``. A cut
    in or beside an insertion takes the insertion along, deletions at a cut vanish. Rows with fewer than ``min_length``
    bases left go. Columns stay as they are; ``has_primer`` is added.
    """
    mapped = drop_unmapped(reads).withColumns({"_reverse": has(16), "_end": reference_end()})
    five = mapped.withColumn("_five", F.when(F.col("_reverse"), F.col("_end")).otherwise(F.col("pos")))
    sides = primers.select(
        "contig",
        (F.col("start") + 1 - F.when(F.col("strand") == "-", offset).otherwise(0)).alias("p_first"),
        (F.col("end") + F.when(F.col("strand") == "+", offset).otherwise(0)).alias("p_last"),
        (F.col("strand") == "-").alias("p_reverse"),
    ).distinct()
    # Reads that start at one place have one primer: it is looked up once for all of them.
    spots = five.select("contig", "_five", "_reverse").distinct()
    hits = point_in_interval(spots, sides, ["contig"], "_five", "p_first", "p_last", width=64).filter("_reverse = p_reverse")
    clips = hits.groupBy("contig", "_five", "_reverse").agg(F.max("p_last").alias("_from"), F.min("p_first").alias("_to"))
    clipped = five.join(clips, ["contig", "_five", "_reverse"], "left" if keep_without_primer else "inner")

    ops = placed_ops()
    matched = lambda p: p["op"].isin("M", "=", "X")
    size = F.length("seq")
    aligned = F.filter("_ops", lambda p: ~p["op"].isin("S", "H", "P"))
    # Kept read places a to b, first without the clips that are there already.
    whole_a = F.array_min(F.transform(aligned, lambda p: p["read"]))
    whole_b = F.array_max(F.transform(aligned, lambda p: p["read"] + F.when(p["op"].isin("D", "N"), 0).otherwise(p["len"]) - 1))
    gone = F.array_max(
        F.transform("_ops", lambda p: F.when(matched(p) & (p["at"] < F.col("_from") + 1), p["read"] + F.least(p["len"], F.col("_from") + 1 - p["at"])))
    )
    back = F.array_min(
        F.transform("_ops", lambda p: F.when(matched(p) & (p["at"] + p["len"] > F.col("_to")), p["read"] + F.greatest(F.col("_to") - p["at"], F.lit(0)) - 1))
    )
    a = F.when(~F.col("_reverse") & F.col("_from").isNotNull(), F.greatest(F.coalesce(gone, whole_a), whole_a)).otherwise(whole_a)
    b = F.when(F.col("_reverse") & F.col("_to").isNotNull(), F.least(F.coalesce(back, whole_b), whole_b)).otherwise(whole_b)
    # An insertion that a cut touches goes as a whole.
    past = lambda at: F.coalesce(F.array_max(F.transform("_ops", lambda p: F.when((p["op"] == "I") & (p["read"] <= at) & (at < p["read"] + p["len"]), p["read"] + p["len"]))), at)
    before = lambda at: F.coalesce(F.array_min(F.transform("_ops", lambda p: F.when((p["op"] == "I") & (p["read"] <= at) & (at < p["read"] + p["len"]), p["read"] - 1))), at)
    # Each step is a generator: otherwise the filters below would repeat all earlier steps many times over.
    spans = settled(settled(clipped, _ops=ops), _a=a.cast("int"), _b=b.cast("int"))
    spans = settled(spans, _a=past(F.col("_a")), _b=before(F.col("_b")))
    spans = settled(spans, _low=_first_low(F.col("_a"), F.col("_b"), F.col("_reverse"), window, min_quality).cast("int"))
    cut = F.col("_low") > 0
    spans = settled(
        spans,
        _a=F.when(cut & F.col("_reverse"), F.col("_b") - F.col("_low") + 2).otherwise(F.col("_a")),
        _b=F.when(cut & ~F.col("_reverse"), F.col("_a") + F.col("_low") - 2).otherwise(F.col("_b")),
    )
    spans = settled(spans, _a=past(F.col("_a")), _b=before(F.col("_b"))).filter(F.col("_b") - F.col("_a") + 1 >= min_length)

    low, high = lambda p: F.greatest(p["read"], F.col("_a")), lambda p: F.least(p["read"] + p["len"] - 1, F.col("_b"))
    inside = lambda p: (p["read"] > F.col("_a")) & (p["read"] <= F.col("_b"))
    kept = F.transform(
        aligned,
        lambda p: F.struct(
            p["op"].alias("op"),
            F.when(p["op"].isin("D", "N"), F.when(inside(p), p["len"]).otherwise(0)).otherwise(high(p) - low(p) + 1).alias("len"),
            (p["at"] + low(p) - p["read"]).alias("at"),
        ),
    )
    kept = F.filter(kept, lambda p: p["len"] > 0)
    piece = lambda n, op: F.when(n > 0, F.concat(n.cast("string"), F.lit(op))).otherwise("")
    hard = lambda p: F.when(p["op"] == "H", F.concat(p["len"].cast("string"), F.lit("H"))).otherwise("")
    ends = F.get("_ops", F.lit(0)), F.when(F.size("_ops") > 1, F.get("_ops", F.size("_ops") - 1))
    text = F.concat(
        hard(ends[0]), piece(F.col("_a") - 1, "S"),
        F.array_join(F.transform("_kept", lambda p: F.concat(p["len"].cast("string"), p["op"])), ""),
        piece(size - F.col("_b"), "S"), F.coalesce(hard(ends[1]), F.lit("")),
    )
    begun = F.array_min(F.transform(F.filter("_kept", matched), lambda p: p["at"]))
    out = settled(settled(spans, _kept=kept), pos=begun.cast("bigint"), cigar=text, has_primer=F.col("_from").isNotNull())
    return out.select(*reads.columns, "has_primer")
