"""Overlap of a read with its mate: where the two meet, correction, adapter cut and merging.

All work is on one row per pair, so nothing is shuffled. Places are proposed by short exact seeds; whole overlaps are
compared letter by letter only there.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virotide.functions.sequence import reverse_complement
from virotide.operators.reads import settled

# Executors get the functions below with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A base of at most LOW quality is overruled by a mate's of at least HIGH.
LOW, HIGH = 14, 30
FOUND = ("offset", "overlap", "errors")
MET = pa.struct([*[(c, pa.int32()) for c in FOUND], ("places", pa.list_(pa.int32()))])


def _places(text: str, seeds: Sequence[str], last: int) -> list[int]:
    """Places from 0 to ``last`` of ``text`` where one of the seeds stands at its distance."""
    found, size = set(), len(seeds[0])
    for i, seed in enumerate(seeds):
        at = text.find(seed, size * i)
        while 0 <= at <= last + size * i:
            found.add(at - size * i)
            at = text.find(seed, at + 1)
    return sorted(found)


def _meeting(one: str | None, two: str | None, min_overlap: int, most_errors: int, most_percent: int) -> tuple | None:
    """``(offset, overlap, errors, places)`` of two texts of one direction; ``places`` are those in the overlap that differ."""
    if one is None or two is None or min(len(one), len(two)) < min_overlap:
        return None
    size = min_overlap // (most_errors + 1)
    kind, code = (np.uint8, "ascii") if one.isascii() and two.isascii() else (np.uint32, "utf-32-le")
    a, b = (np.frombuffer(t.encode(code), kind) for t in (one, two))
    for text, other, sign in ((one, two, 1), (two, one, -1)):
        seeds = [other[size * i : size * (i + 1)] for i in range(most_errors + 1)]
        for place in _places(text, seeds, len(text) - min_overlap):
            if sign < 0 and not place:
                continue
            first, second = (place, 0) if sign > 0 else (0, place)
            count = min(len(a) - first, len(b) - second)
            wrong = np.flatnonzero(a[first : first + count] != b[second : second + count])
            if len(wrong) <= min(most_errors, count * most_percent // 100):
                return sign * place, count, len(wrong), wrong.tolist()
    return None


def _met(pairs: DataFrame, min_overlap: int, most_errors: int, most_percent: int) -> DataFrame:
    """``pairs`` with ``_best``: the overlap, and the places in it that differ (null where the two do not meet)."""
    if min_overlap // (most_errors + 1) < 1:
        raise ValueError(f"an overlap of {min_overlap} letters cannot hold {most_errors} errors")

    def run(one: pa.Array, two: pa.Array) -> pa.Array:
        both = zip(one.to_pylist(), two.to_pylist(), strict=True)
        met = [_meeting(a, b, min_overlap, most_errors, most_percent) for a, b in both]
        return pa.array([m and dict(zip((*FOUND, "places"), m, strict=True)) for m in met], MET)

    found = F.arrow_udf(run, "offset int, overlap int, errors int, places array<int>")
    return pairs.withColumn("_best", found(F.upper("seq1"), reverse_complement(F.upper("seq2"))))


def mate_overlap(pairs: DataFrame, min_overlap: int = 30, most_errors: int = 5, most_percent: int = 20) -> DataFrame:
    """``offset``, ``overlap`` and ``errors`` of each pair (null where the two do not meet).

    ``offset`` is where the reverse complement of ``seq2`` starts in ``seq1``, below zero if it hangs over the start. An
    overlap has at least ``min_overlap`` letters, and at most ``most_errors`` or ``most_percent`` of them differ. The
    smallest offset from zero up counts, else the one nearest below zero. Of so few errors one of ``most_errors + 1``
    pieces of the first ``min_overlap`` letters is free, so exact pieces miss no overlap. Letters compare as they are
    (upper case); a null or short mate meets nothing.
    """
    found = _met(pairs, min_overlap, most_errors, most_percent)
    return found.select(*pairs.columns, *[F.col(f"_best.{c}").alias(c) for c in FOUND])


def merge_mates(pairs: DataFrame, min_overlap: int = 30, most_errors: int = 5, most_percent: int = 20) -> DataFrame:
    """Pairs corrected, cut and merged by their overlap; columns of ``mate_overlap`` and ``corrected``, ``merged``.

    Where the two differ, a base of quality ``LOW`` or less takes the mate's letter and quality if that has ``HIGH`` or
    more. If the mate hangs over the start (``offset`` below zero), what lies beyond the overlap is adapter, and both end
    there. ``merged`` is the insert, null without an overlap; pairs without one stay as they are.
    """
    # Equal letters stay as they are, so only the few places that differ are looked at.
    turned = settled(
        _met(pairs, min_overlap, most_errors, most_percent),
        _one=F.upper("seq1"), _r=reverse_complement(F.upper("seq2")), _q=F.reverse("qual2"),
        **{c: F.col(f"_best.{c}") for c in FOUND}, _places=F.col("_best.places"),
        _first=F.greatest(F.col("_best.offset"), F.lit(0)), _other=F.greatest(-F.col("_best.offset"), F.lit(0)),
    )
    quality = lambda c: F.ascii(c) - 33
    letter = lambda text, at: F.nullif(F.substr(F.col(text), at, F.lit(1)), F.lit(""))

    def judged(j: Column) -> Column:
        at, back = F.col("_first") + j + 1, F.col("_other") + j + 1
        x, y, qx, qy = letter("_one", at), letter("_r", back), letter("qual1", at), letter("_q", back)
        return F.struct(at.alias("at"), back.alias("back"), x.alias("x"), y.alias("y"), qx.alias("qx"), qy.alias("qy"))

    def overruled(p: Column, low: str, high: str) -> Column:
        return (quality(p[low]) <= LOW) & (quality(p[high]) >= HIGH)

    known = settled(turned, _places=F.transform("_places", judged))
    fixed = settled(
        known,
        _to_y=F.filter("_places", lambda p: overruled(p, "qx", "qy")), _to_x=F.filter("_places", lambda p: overruled(p, "qy", "qx")),
    )

    def rebuilt(text: str, places: str, at: str, field: str) -> Column:
        return F.aggregate(places, F.col(text), lambda out, p: F.overlay(out, p[field], p[at], F.lit(1)))

    met = F.col("offset").isNotNull()
    whole = settled(
        fixed,
        _s1=rebuilt("_one", "_to_y", "at", "y"), _q1=rebuilt("qual1", "_to_y", "at", "qy"),
        _s2=rebuilt("_r", "_to_x", "back", "x"), _q2=rebuilt("_q", "_to_x", "back", "qx"),
    )
    over = F.col("offset") < 0
    ended = lambda c: F.when(over, F.substr(c, F.lit(1), F.col("overlap"))).otherwise(c)
    behind = F.when(over, "").otherwise(F.substr("_s2", F.col("overlap") + 1))
    columns = {
        "seq1": ended(F.col("_s1")), "qual1": ended(F.col("_q1")),
        "seq2": ended(reverse_complement(F.col("_s2"))), "qual2": ended(F.reverse("_q2")),
    }
    out = whole.withColumns({
        "corrected": F.when(met, F.size("_to_y") + F.size("_to_x")),
        "merged": F.when(met, F.concat(F.substr("_s1", F.lit(1), F.col("_first") + F.col("overlap")), behind)),
    })
    kept = [F.when(met, columns[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in pairs.columns]
    return out.select(*kept, *FOUND, "corrected", "merged")
