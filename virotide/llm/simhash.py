"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into two 32-bit segments. Fingerprints with at most three differing bits
differ by at most one bit in one of the segments, so each one enumerates the Hamming ball of radius one
around its segments, fetches the table rows of those segment values, and compares whole fingerprints.
A ball is probed upward only (the value itself, and each zero bit set): of two segments one bit apart
exactly one reaches the other that way.

Defined cases: null or wordless texts have fingerprint zero and are linked like any other; rows without
an id come after all others, and their component is null if it holds no id; repeated rows each get a row;
other columns of the input are ignored by ``near_duplicates`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virotide.llm.common import NO_ID, components, keep

SEED = 42
SEGMENTS, SEGMENT_BITS = 2, 32
SLICE = 1 << 16


def simhash(data: bytes, width: int = 3) -> int:
    """Signed 64-bit fingerprint of UTF-8 text: a bit is one if set in over half the shingles' XXH64."""
    words = data.lower().split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(width)), strict=False) if len(words) >= width else (words,)
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), SLICE):
        part = hashes[at : at + SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``(doc_id, text_hash, fp)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            fps = pa.array([simhash(t.as_py() or b"", width) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], ["doc_id", "text_hash", "fp"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        run, "doc_id long, text_hash long, fp long"
    )


def _segment(fp: Column, k: Column | int) -> Column:
    return F.when(F.lit(k) == 0, fp.bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned(fp, 32))


def links(fps: DataFrame, most: int = 3) -> DataFrame:
    """Pairs ``(u, v)`` of distinct fingerprints that differ in 1 to ``most`` (at most 3) bits."""
    if not 0 < most < 2 * SEGMENTS:
        raise ValueError("two segments with balls of radius one find at most 3 differing bits")
    parts = fps.select("fp", F.explode(F.array(*map(F.lit, range(SEGMENTS)))).alias("k")).withColumn("part", _segment(F.col("fp"), F.col("k")))
    bits = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(SEGMENT_BITS)])
    ball = parts.select(F.col("fp").alias("other"), "k", "part", F.explode(bits).alias("bit"))
    ball = ball.where(F.col("part").bitwiseAND(F.col("bit")) == 0).select(
        "other", "k", F.col("part").bitwiseOR(F.col("bit")).alias("part"), (F.col("bit") == 0).alias("same")
    )
    found = parts.join(
        ball.hint("shuffle_merge"),
        (parts.k == ball.k)
        & (parts.part == ball.part)
        & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= most)
        & (~F.col("same") | (F.col("fp") < F.col("other"))),
    )
    return found.select(F.col("fp").alias("u"), F.col("other").alias("v"))


def _grouped(docs: DataFrame, most: int, width: int) -> DataFrame:
    """Rows with their fingerprint's component: its smallest fingerprint ``root``, and its smallest id.

    Equal fingerprints are one node from the start, so copies cost one row each, whatever their number.
    """
    rows = keep(fingerprints(docs, width).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(nodes.select("fp"), most))
    known = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = keep(known.join(smallest, "root").select("fp", "root", "component_id"), "components")
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame, most: int = 3, width: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row; the component is named by its smallest ``doc_id``."""
    return _grouped(docs, most, width).select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "fp", F.nullif("component_id", F.lit(NO_ID)).alias("component_id")
    )


def one_of_each(docs: DataFrame, most: int = 3, width: int = 3) -> DataFrame:
    """One row of each component, that with the smallest id (then the smallest hash of the text); all columns stay."""
    first = _grouped(docs, most, width).groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("f"))
    first = first.select(F.col("f.doc_id").alias("_id"), F.col("f.text_hash").alias("_text"))
    keyed = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("_text", F.xxhash64(F.col("text").cast("string")))
    kept = keyed.join(first, ["_id", "_text"], "left_semi").dropDuplicates(["_id", "_text"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
