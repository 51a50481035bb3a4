"""Removal of repeated byte strings by longest-previous-factor arrays.

A string of ``least`` bytes that starts at two places is a repeat. Its places are brought together by
content: the smallest hash among the k-grams of a window of ``least`` bytes names the window's anchor, and
equal windows have equal anchors. Windows that share an anchor form one context of neighbouring windows.

1. Anchors whose k-gram occurs once in the corpus hold no repeats: hashes are counted, the rest is dropped.
2. Contexts that occur twice as a whole are repeats as a whole: only their first occurrence goes on.
3. The other contexts of an anchor with different contexts are cut out of the texts, brought together by
   anchor, and their windows put in suffix order. The previous and next smaller positions in that order give
   each window's longest previous factor (over negated positions: longest next factor), and factors of
   ``least`` bytes are repeats. A window hash sorts out windows without a partner before the sort.

Anchors with more than ``most_contexts`` contexts take step 3 window by window, as rows that Spark groups
by two hashes of the window, with partial sums; no group of any size is held in one task.

Defined cases: a null text is empty; texts under ``least`` bytes are kept whole; matches never cross
documents; rows equal in id and text each count as a place, and are cut alike; rows without an id come
last in the order; an empty table stays empty; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virotide.llm.common import NO_ID, keep

LEAST = 200
GRAM = 32
SLICE = 1 << 21
WINDOWS_AT_ONCE = 1 << 18
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
#: A fixed 64-bit number for each byte value.
BYTES = np.random.Generator(np.random.PCG64(20240607)).integers(0, 1 << 64, 256, dtype=U64)
KEY = ["_id", "_text"]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Hashes:
    """Hashes of substrings of one buffer, from running sums modulo 2**64."""

    powers = np.ones(1, dtype=U64)
    inverses = np.ones(1, dtype=U64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Hashes.powers) <= n:
            size = max(n + 1, SLICE)
            for name, base in (("powers", BASE), ("inverses", pow(BASE, -1, 1 << 64))):
                row = np.full(size, base, dtype=U64)
                row[0] = 1
                setattr(Hashes, name, np.cumprod(row, dtype=U64))
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(BYTES[data] * Hashes.powers[:n], out=self.sums[1:])

    def of(self, start, stop) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * Hashes.inverses[start])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each window: running minima from both ends of blocks of ``width``."""
    n = len(x)
    blocks = np.full(-(-n // width) * width, np.iinfo(U64).max, dtype=U64)
    blocks[:n] = x
    blocks = blocks.reshape(-1, width)
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[: n - width + 1], right[width - 1 : n])


def anchors(data: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``(anchor hash, context hash, first window, number of windows)`` of a text's contexts.

    The anchor of a window is its k-gram of the smallest hash, the leftmost of equals. Long texts go by
    slices; a context that a slice cuts is two contexts, which are compared in step 3 like any others.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(data) - least + 1, SLICE - least):
        part = data[at : at + SLICE - 1]
        if len(part) < least:
            break
        hashes = Hashes(part)
        places = np.arange(len(part) - gram + 1, dtype=np.int64)
        grams = hashes.of(places, places + gram)
        low = sliding_min((grams & U64(0xFFFFFFFF00000000)) | places.astype(U64), least - gram + 1)
        anchor = (low & U64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        count = np.diff(first, append=len(anchor))
        where = anchor[first]
        context = mix(hashes.of(first, first + count + least - 1) ^ ((where - first).astype(U64) << U64(32)) ^ count.astype(U64))
        parts.append((grams[where].view(np.int64), context.view(np.int64), first + at, count))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else tuple(np.zeros(0, np.int64) for _ in range(4))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_text"), text.cast("binary").alias("data"))


def contexts(docs: DataFrame, least: int) -> DataFrame:
    """``(_id, _text, anchor, context, start, count)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (np.asarray(batch.column(i)) for i in (0, 1))
            found, sizes = [], []
            for cell in batch.column(2):
                found.append(anchors(np.frombuffer(cell.as_buffer() or b"", dtype=np.uint8), least))
                sizes.append(len(found[-1][0]))
            if found:
                columns = [np.repeat(ids, sizes), np.repeat(texts, sizes), *(np.concatenate(x) for x in zip(*found, strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_id", "_text", "anchor", "context", "start", "count"])

    return _keyed(docs).mapInArrow(run, "_id long, _text long, anchor long, context long, start long, count long")


def _packed(docs: DataFrame) -> DataFrame:
    """The texts, compressed: they are moved as they are, and opened where they are used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data = pa.array([small.compress(cell.as_py()) for cell in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), data], ["_id", "_text", "data"])

    return _keyed(docs).mapInArrow(run, "_id long, _text long, data binary")


def factors(position: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Longest previous factors, in suffix order.

    ``position[i]`` is the place of the i-th suffix, ``lcp[i]`` its common prefix with the one before it.
    For each suffix the previous and the next one at a smaller place are found by following, from each
    larger one, its own candidate; the common prefix with it is the least value passed on the way.
    """
    n = len(position)
    best = np.zeros(n, dtype=np.int64)
    for flip in (False, True):
        place = position[::-1] if flip else position
        to = np.empty(n + 1, dtype=np.int64)
        to[1:] = np.arange(n)  # shifted by one: 0 stands for none
        to[0] = 0
        passed = np.zeros(n + 1, dtype=np.int64)
        passed[1:] = np.concatenate([[0], lcp[:0:-1]]) if flip else lcp
        place = np.concatenate([[-np.inf], place])
        open_ = np.arange(1, n + 1)
        while True:
            open_ = open_[place[to[open_]] > place[open_]]
            if not len(open_):
                break
            step = to[open_]
            passed[open_] = np.minimum(passed[open_], passed[step])
            to[open_] = to[step]
        found = np.where(to[1:] > 0, passed[1:], 0)
        best = np.maximum(best, found[::-1] if flip else found)
    return best


def _windows(pieces: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer, and for each window its place in it, its context, and its number in the context."""
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(p) for p in pieces])[:-1]]).astype(np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return data, begin[owner] + number, owner, number


def repeats(frame: pd.DataFrame, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the windows of whole groups of contexts: context, number, and whether an earlier, a later one equals it."""
    data, place, owner, number = _windows(list(frame["data"]), frame["count"].to_numpy(np.int64))
    hashed = Hashes(data).of(place, place + least)
    order = np.argsort(hashed)
    same = hashed[order][1:] == hashed[order][:-1]
    paired = np.zeros(len(hashed), dtype=bool)
    paired[order[1:][same]] = paired[order[:-1][same]] = True
    rows = np.flatnonzero(paired)
    earlier, later = np.zeros(len(place), dtype=bool), np.zeros(len(place), dtype=bool)
    if len(rows):
        text = np.lib.stride_tricks.sliding_window_view(data, least)[place[rows]]
        suffix = np.argsort(np.ascontiguousarray(text).view(f"S{least}").ravel(), kind="stable")
        text = text[suffix]
        differs = text[1:] != text[:-1]
        lcp = np.zeros(len(rows), dtype=np.int64)
        lcp[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), least)
        mine = owner[rows][suffix]
        keys = [frame[c].to_numpy(np.int64)[mine] for c in ("_id", "_text", "start")]
        rank = np.empty(len(rows), dtype=np.int64)
        rank[np.lexsort((keys[2] + number[rows][suffix], keys[1], keys[0]))] = np.arange(len(rows))
        earlier[rows[suffix]] = factors(rank, lcp) >= least
        later[rows[suffix]] = factors(-rank, lcp) >= least
    return owner, number, earlier, later


def _runs(owner: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, first and last number of the stretches of neighbouring windows."""
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (number[1:] != number[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner)) - 1 if len(owner) else first
    return owner[first], number[first], number[last]


SPAN = "_id long, _text long, start long, stop long"


def _compare(least: int, keep_first: bool):
    """Spans of repeated windows; takes contexts sorted by anchor, works on whole anchors at a time."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        owner, number, earlier, later = repeats(frame, least)
        flagged = np.flatnonzero(earlier if keep_first else earlier | later)
        who, first, last = _runs(owner[flagged], number[flagged])
        start = frame["start"].to_numpy(np.int64)[who]
        return pd.DataFrame({"_id": frame["_id"].to_numpy()[who], "_text": frame["_text"].to_numpy()[who], "start": start + first, "stop": start + last + least})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            while len(rest):
                # Whole anchors, up to the bound on windows; the last anchor may go on in the next batch.
                total = np.cumsum(rest["count"].to_numpy(np.int64))
                ends = np.flatnonzero(np.diff(rest["anchor"].to_numpy()))
                if not len(ends) or total[-1] < WINDOWS_AT_ONCE:
                    break
                cut = ends[max(0, np.searchsorted(total[ends], WINDOWS_AT_ONCE, side="right") - 1)] + 1
                yield solve(rest.iloc[:cut].reset_index(drop=True))
                rest = rest.iloc[cut:].reset_index(drop=True)
        while rest is not None and len(rest):
            total = np.cumsum(rest["count"].to_numpy(np.int64))
            ends = np.append(np.flatnonzero(np.diff(rest["anchor"].to_numpy())), len(rest) - 1)
            cut = ends[max(0, np.searchsorted(total[ends], WINDOWS_AT_ONCE, side="right") - 1)] + 1
            yield solve(rest.iloc[:cut].reset_index(drop=True))
            rest = rest.iloc[cut:].reset_index(drop=True)

    return run


def _cut_out(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        large = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for i, t, data, wanted in zip(batch["_id"], batch["_text"], batch["data"], batch["wanted"], strict=True):
                text = large.decompress(data)
                for w in wanted:
                    rows.append((i, t, w["anchor"], w["start"], w["count"], w["contexts"], text[w["start"] : w["start"] + w["count"] + least - 1]))
                if len(rows) > 1 << 15:
                    yield pd.DataFrame(rows, columns=["_id", "_text", "anchor", "start", "count", "contexts", "data"])
                    rows = []
            yield pd.DataFrame(rows, columns=["_id", "_text", "anchor", "start", "count", "contexts", "data"])

    return run


def _each_window(least: int):
    """One row per window, with two hashes of its bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at : at + 1024]
                data, place, owner, number = _windows(list(part["data"]), part["count"].to_numpy(np.int64))
                half = Hashes(data).of(place, place + least // 2)
                yield pd.DataFrame({
                    "one": Hashes(data).of(place, place + least).view(np.int64), "two": half.view(np.int64),
                    "_id": part["_id"].to_numpy()[owner], "_text": part["_text"].to_numpy()[owner], "start": part["start"].to_numpy()[owner] + number,
                })

    return run


def repeated_spans(docs: DataFrame, least: int = LEAST, keep_first: bool = True, most_contexts: int = 4096) -> DataFrame:
    """``(_id, _text, start, stop)``: byte spans made of repeated strings; spans of a text may overlap."""
    if least <= GRAM:
        raise ValueError(f"repeats must be longer than {GRAM} bytes")
    found = contexts(docs, least)
    often = keep(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    found = keep(found.join(often, "anchor"), "contexts")
    place = F.struct(*KEY, "start")
    groups = keep(found.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min("count").alias("count"), F.min(place).alias("first")), "groups")
    whole = found.join(groups.where("n > 1").select("anchor", "context", "first"), ["anchor", "context"])
    if keep_first:
        whole = whole.where(place != F.col("first"))
    whole = whole.select(*KEY, "start", (F.col("start") + F.col("count") + (least - 1)).alias("stop"))
    several = keep(groups.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1"), "several")
    # Where all occurrences go, a context found twice has its answer, and is only a partner to others.
    wanted = groups.join(several, "anchor").select("first.*", F.struct("anchor", F.col("first.start").alias("start"), "count", "contexts").alias("w"))
    wanted = wanted.groupBy(*KEY).agg(F.collect_list("w").alias("wanted"))
    pieces = _packed(docs).join(wanted, KEY).select(*KEY, "data", "wanted")
    cut = pieces.dropDuplicates(KEY).mapInPandas(_cut_out(least), "_id long, _text long, anchor long, start long, count long, contexts long, data binary")
    pieces = keep(cut, "pieces")
    few = pieces.where(F.col("contexts") <= most_contexts).repartition("anchor").sortWithinPartitions("anchor").mapInPandas(_compare(least, keep_first), SPAN)
    many = keep(pieces.where(F.col("contexts") > most_contexts).mapInPandas(_each_window(least), "one long, two long, _id long, _text long, start long"), "windows")
    twice = keep(many.groupBy("one", "two").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n"), "twice")
    again = many.join(twice, ["one", "two"])
    if keep_first:
        again = again.where(place != F.col("first"))
    again = again.select(*KEY, "start", (F.col("start") + least).alias("stop"))
    return whole.union(few).union(again)


def cut_repeats(docs: DataFrame, least: int = LEAST, keep_first: bool = True, most_contexts: int = 4096) -> DataFrame:
    """``(doc_id, n_bytes, removed, kept)`` of every row.

    ``removed`` are the maximal removed runs (start and stop in bytes), ``kept`` the other bytes. With
    ``keep_first`` the first occurrence of a string (by id, then place) stays, else every one goes.
    """
    spans = repeated_spans(docs, least, keep_first, most_contexts)
    spans = keep(spans.distinct().groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans")), "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        large = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for i, data, spans in zip(batch["_id"], batch["data"], batch["spans"], strict=True):
                text, merged, kept, at = large.decompress(data), [], [], 0
                for span in () if spans is None else spans:
                    if merged and span["start"] <= merged[-1]["stop"]:
                        merged[-1]["stop"] = max(merged[-1]["stop"], span["stop"])
                    else:
                        merged.append({"start": span["start"], "stop": span["stop"]})
                for span in merged:
                    kept.append(text[at : span["start"]])
                    at = span["stop"]
                rows.append((None if i == NO_ID else i, len(text), merged, b"".join([*kept, text[at:]])))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "removed", "kept"]).astype({"doc_id": "Int64"})

    joined = _packed(docs).join(spans, KEY, "left").select("_id", "data", "spans")
    return joined.mapInPandas(run, "doc_id long, n_bytes long, removed array<struct<start: long, stop: long>>, kept binary")
