"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes ends a chunk wherever it hits a multiple of the block size (three times a
power of two); each chunk gives one letter, so a local edit changes a few letters. A fingerprint holds the
letters for one block size and for its double; two are compared by edit distance (insertions and deletions)
where their block sizes are equal or one is the other's double.

Defined cases: null counts as the empty text, whose letters are empty; two fingerprints of equal letters
have likeness 1, an empty and a non-empty one 0; rows without an id come last, rows of one id are ordered by
text; a table of one row has itself as next document; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from virotide.llm.common import keep

WINDOW = 7
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
MOST_LETTERS = 64
SLICE = 1 << 20
BASE = 0x100000001B3
INVERSE = pow(BASE, -1, 1 << 64)
WORD = (1 << 64) - 1


def _powers() -> np.ndarray:
    out = np.full(SLICE, BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Fingerprinter:
    def __init__(self) -> None:
        self.powers = _powers()

    @staticmethod
    def _levels(data: np.ndarray, start: int, stop: int) -> np.ndarray:
        """For each byte: -1, or k if its rolling hash ends chunks up to block size 3 * 2**k."""
        lead = min(WINDOW - 1, start)
        window = np.concatenate([np.zeros(WINDOW - 1 - lead, dtype=np.uint32), data[start - lead : stop].astype(np.uint32)])
        rolled = np.zeros(stop - start, dtype=np.uint32)
        for i in range(WINDOW):
            rolled = rolled * np.uint32(0x01000193) + window[i : i + stop - start]
        rolled ^= rolled >> np.uint32(15)
        rolled *= np.uint32(0x2C1B3C6D)
        rolled ^= rolled >> np.uint32(13)
        value = rolled.astype(np.int64) + 1
        low = np.bitwise_count((value & -value) - 1).astype(np.int8)
        low[value % 3 != 0] = -1
        return low

    def _letters(self, data: np.ndarray, ends: np.ndarray) -> str:
        """One letter for each chunk; chunks beyond the last letter join it."""
        ends = ends[: MOST_LETTERS - 1]
        if not len(ends) or ends[-1] < len(data):
            ends = np.append(ends, len(data))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        sums = np.zeros(len(ends), dtype=np.uint64)
        for at in range(0, len(data), SLICE):
            part = (data[at : at + SLICE].astype(np.uint64) + np.uint64(1)) * self.powers[: min(SLICE, len(data) - at)]
            first, last = np.searchsorted(ends, [at, at + len(part) - 1], side="right")
            inside = np.maximum(starts[first : last + 1] - at, 0)
            sums[first : last + 1] += np.add.reduceat(part, inside) * np.uint64(pow(BASE, at, 1 << 64))
        out = []
        for start, total in zip(starts.tolist(), sums.tolist(), strict=True):
            chunk = total * pow(INVERSE, start, 1 << 64) & WORD
            chunk = (chunk ^ chunk >> 31) * 0x9E3779B97F4A7C15 & WORD
            out.append(LETTERS[chunk >> 58])
        return "".join(out)

    def __call__(self, data: bytes) -> str:
        """``block size:letters:letters at the double block size`` of the whole text."""
        if not data:
            return "3::"
        array = np.frombuffer(data, dtype=np.uint8)
        floor = max(0, (len(array) // (3 * 4096)).bit_length() - 1)
        ends, levels = [], []
        for at in range(0, len(array), SLICE):
            found = self._levels(array, at, min(len(array), at + SLICE))
            hit = np.flatnonzero(found >= floor)
            ends.append(hit + at + 1)
            levels.append(found[hit])
        end, level = np.concatenate(ends), np.concatenate(levels)
        reached = np.cumsum(np.bincount(level, minlength=1)[::-1])[::-1]  # chunk ends at block size 2**k and above
        enough = np.flatnonzero(reached >= MOST_LETTERS // 2)
        k = int(enough[-1]) if len(enough) else floor
        return f"{3 << k}:{self._letters(array, end[level >= k])}:{self._letters(array, end[level > k])}"


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, 64 columns at a time in one integer."""
    where: dict[str, int] = {}
    for i, letter in enumerate(a):
        where[letter] = where.get(letter, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for letter in b:
        match = where.get(letter, 0) & row
        row = (row + match | row - match) & full
    return len(a) - row.bit_count()


def _likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    run = min(WINDOW, max(2, min(len(a), len(b)) // 4))
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not any(b[i : i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0  # no chunks in a row in common: what is left is chance
    return 2 * common_length(a, b) / (len(a) + len(b))


def likeness(one: str, other: str) -> float:
    """0 to 1: one minus the edit distance per letter, at the best compatible block size."""
    if one == other:
        return 1.0
    (size, a, a2), (size_b, b, b2) = one.split(":"), other.split(":")
    near = int(size) / int(size_b)
    if near == 1:
        return max(_likeness(a, b), _likeness(a2, b2)) if len(a2) > WINDOW and len(b2) > WINDOW else _likeness(a, b)
    if near == 2:
        return _likeness(a, b2)
    return _likeness(a2, b) if near == 0.5 else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many first code points of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _compared(make: Fingerprinter, doc_id, text: str, own: str, following: str, theirs: str) -> tuple:
    changed = _bytes(edited(text, following))
    print_ = make(changed)
    return doc_id, len(text), hashlib.sha256(changed).hexdigest(), own, print_, likeness(own, print_), likeness(own, theirs)


def _with_following(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one sorted partition, each with its next one; its first and last row go out with their texts."""
    make, part, last = Fingerprinter(), TaskContext.get().partitionId(), None
    kind = [*NAMES, "part", "border", "text"]
    for batch in batches:
        out = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            here = (None if pd.isna(doc_id) else int(doc_id), text, make(_bytes(text)))
            if last is None:
                out.append((here[0], *[None] * 6, part, "first", text))
            else:
                out.append((*_compared(make, last[0], last[1], last[2], here[1], here[2]), part, None, None))
            last = here
        yield pd.DataFrame(out, columns=kind, dtype=object)
    if last is not None:
        yield pd.DataFrame([(last[0], *[None] * 6, part, "last", last[1])], columns=kind, dtype=object)


def _across_borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    make = Fingerprinter()
    for batch in batches:
        out = [
            _compared(make, None if pd.isna(i) else int(i), a, make(_bytes(a)), b, make(_bytes(b)))
            for i, a, b in zip(batch["doc_id"], batch["text"], batch["following"], strict=True)
        ]
        yield pd.DataFrame(out, columns=NAMES, dtype=object)


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited form, by descending ``doc_id``; the last row's next is the first.

    One range-partitioned sort moves the texts once. A partition's last row meets the first row of the next
    partition in a second, small step: two rows for each partition.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    done = keep(
        rows.repartitionByRange(F.col("doc_id").desc_nulls_last()).sortWithinPartitions(*order).mapInPandas(_with_following, f"{COLUMNS}, part int, border string, text string"),
        "fingerprints",
    )
    firsts = done.where("border = 'first'")
    everything = Window.orderBy("part")  # one narrow row for each partition of the sort
    turn = firsts.select("part").withColumn("before", F.lag("part").over(everything)).withColumn("top", F.max("part").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    turn = turn.select("part", F.coalesce("before", "top").alias("before"))
    following = firsts.join(turn, "part").select(F.col("before").alias("part"), F.col("text").alias("following"))
    borders = done.where("border = 'last'").select("part", "doc_id", "text").join(following, "part").drop("part")
    return done.where("border is null").select(*NAMES).union(borders.mapInPandas(_across_borders, COLUMNS))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` of every row."""

    @F.pandas_udf("string")
    def prints(texts: pd.Series) -> pd.Series:
        make = Fingerprinter()
        return pd.Series([make(_bytes(t or "")) for t in texts], dtype=object)

    return docs.select("doc_id", prints(F.col("text").cast("string")).alias("fingerprint"))
