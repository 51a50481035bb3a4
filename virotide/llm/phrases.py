"""Phrase collocations: frequent word sequences per language, scored by their weakest cut.

Rabin-Karp over bytes: a prefix polynomial of a slice of texts gives the fingerprint of every word n-gram as a
difference of two prefix values. Three passes, each exact about what it keeps:

1. Each slice sends its distinct fingerprints (48 bits, sorted, by range) with their counts; ranges are summed,
   and fingerprints that reach the least count go into a bit table of fixed size. Counts of one slice stop at 255,
   which is above any threshold that matters only if ``least`` is at most 255; larger thresholds use wider counts.
2. The texts are read again. Of occurrences whose fingerprint is in the table each slice compares the bytes with
   the first occurrence, so that phrases of equal fingerprint part. The slices of a task are summed by text, and it
   sends each phrase once, with its count and a pointer to its first occurrence (more often only if the phrases at
   hand outgrow ``HELD``). Phrases are dealt to parts by fingerprint and travel as lists, one row for the phrases of a
   part, language and task; each part is summed by text. These counts are exact; only frequent phrases get this far.
3. Phrases are cut after each word, the parts' counts are joined, and the lowest score of a phrase counts.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated rows count each; a text of any
length is worked through in windows; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from virotide.llm.common import keep

#: Bytes of text that are hashed together; a task holds some 50 times as much.
SLICE = 1 << 22
#: Bytes of packed fingerprints that one range should hold.
RANGE_BYTES = 3 << 20
#: Size of the table of frequent fingerprints, in bits: the only thing broadcast, 16 MB whatever the input.
TABLE_BITS = 1 << 27
#: Phrases that a task sums before it sends them; some 100 bytes each.
HELD = 1 << 20
#: Leading bits of a fingerprint that name the part in which a phrase is summed.
PART_BITS = 9
#: Phrases in one row at most: Spark hands rows to Python by number, 10,000 at a time.
LISTED = 128
BASE = 0x9E3779B97F4A7C15
UNKNOWN = "und"
BLANK, BREAK = b" \t", b".,;:!?\n\x0b\x0c\r"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
KIND = np.array([1 if c in BLANK else 2 if c in BREAK else 0 for c in range(256)], dtype=np.uint8)
GAP = re.compile(rb"[ \t.,;:!?\n-\r]")


def _windows(data: bytes, ahead: int, size: int) -> Iterator[tuple[bytes, int]]:
    """Parts of a text with the number of bytes in which their own n-grams start; ``ahead`` words follow these."""
    following = re.compile(rb"(?:[ \t.,;:!?\n-\r]+[^ \t.,;:!?\n-\r]+){0,%d}" % ahead)
    at = 0
    while at < len(data):
        gap = GAP.search(data, at + size) if at + size < len(data) else None
        stop = gap.start() if gap else len(data)
        yield data[at : following.match(data, stop).end()], stop - at
        at = stop


class Slice:
    """Words of some texts of one language, ready for hashing."""

    def __init__(self, lang: str, texts: list[bytes], ids: list, own: int | None = None, words_before: int = 0):
        raw = np.frombuffer((b"\n".join(texts) + b"\n").translate(LOWER), dtype=np.uint8)
        kind = KIND[raw]
        inside = kind == 0
        after = np.zeros(len(raw), dtype=bool)  # the first byte after each word
        after[1:] = inside[:-1] & ~inside[1:]
        raw_stops = np.flatnonzero(after)
        raw_starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[raw_starts]
        kept = inside | after
        self.bytes = np.where(after, np.uint8(32), raw)[kept]
        self.stops = np.cumsum(kept, dtype=np.int64)[raw_stops] - 1
        self.starts = np.concatenate(([0], self.stops[:-1] + 1)) if len(self.stops) else self.stops
        self.own = len(raw_starts) if own is None else int(np.searchsorted(raw_starts, own))
        self.lang, self.ids, self.words_before = lang, ids, words_before
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.first_word = np.searchsorted(raw_starts, np.cumsum(sizes) - sizes)
        self.seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        powers = _powers(BASE, len(self.bytes) + 1)
        # Multiplied with these, a difference of prefix values does not depend on where the words stand.
        self.back = _powers(pow(BASE, -1, 1 << 64), len(self.bytes) + 1)
        self.prefix = np.zeros(len(self.bytes) + 1, dtype=np.uint64)
        np.cumsum(self.bytes * powers[: len(self.bytes)], out=self.prefix[1:])

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and mixed 64-bit fingerprints of the n-grams within pieces."""
        count = max(0, min(self.own, len(self.starts) - n + 1))
        first = np.flatnonzero(self.piece[:count] == self.piece[n - 1 : n - 1 + count])
        start, stop = self.starts[first], self.stops[first + n - 1]
        fp = (self.prefix[stop] - self.prefix[start]) * self.back[start]
        fp ^= self.seed
        for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
            fp ^= fp >> np.uint64(shift)
            fp *= np.uint64(factor)
        return first, fp ^ (fp >> np.uint64(32))

    def pointer(self, words: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """Document and place (in words) of words given by number."""
        doc = np.searchsorted(self.first_word, words, side="right") - 1
        return pa.array(self.ids, pa.int64()).take(pa.array(doc)), pa.array(words - self.first_word[doc] + self.words_before)


_power_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """Powers of a base modulo 2 ** 64; a view with as many entries as asked for."""
    if len(_power_tables.get(base, ())) < n:
        out = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        out[0] = 1
        _power_tables[base] = np.multiply.accumulate(out)
    return _power_tables[base][:n]


def _slices(batches: Iterator[pa.RecordBatch], ahead: int, size: int) -> Iterator[Slice]:
    """Slices of some ``size`` bytes of the rows ``(lang, doc_id, text)`` of one task, by language."""
    waiting: dict[str, tuple[list[bytes], list]] = defaultdict(lambda: ([], []))
    held = 0
    for batch in batches:
        langs, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, doc_id, text in zip(langs, ids, batch.column(2).cast(pa.large_binary()), strict=True):
            data = text.as_py()
            if not data:
                continue
            if len(data) > size:
                words = 0
                for part, own in _windows(data, ahead, size):
                    out = Slice(lang, [part], [doc_id], own, words)
                    words += out.own
                    yield out
                continue
            if held + len(data) > size:
                for k, (texts, names) in waiting.items():
                    yield Slice(k, texts, names)
                waiting.clear()
                held = 0
            waiting[lang][0].append(data)
            waiting[lang][1].append(doc_id)
            held += len(data) + 1
    for k, (texts, names) in waiting.items():
        yield Slice(k, texts, names)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )


def _range_bits(docs: DataFrame, most_words: int) -> int:
    """Leading bits that name a range: about 4 bytes for each of ``most_words`` n-grams of each 6 bytes of text."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return max(6, min(16, int(size * most_words * 2 // 3 // RANGE_BYTES).bit_length()))


def frequent_fingerprints(docs: DataFrame, least: int, most_words: int) -> DataFrame:
    """``(fp)``: 48-bit fingerprints of n-grams that may occur ``least`` times; none that do is missing."""
    bits, wide = _range_bits(docs, most_words), np.dtype("u1" if least <= 255 else "<u4")
    limit, size = np.iinfo(wide).max, SLICE

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, most_words - 1, size):
            fps, counts = np.unique(np.concatenate([part.grams(n)[1] for n in range(1, most_words + 1)]) >> np.uint64(16), return_counts=True)
            counts = np.minimum(counts, limit).astype(wide)
            ranges = fps >> np.uint64(48 - bits)
            ends = np.searchsorted(ranges, np.arange(1 << bits, dtype=np.uint64), side="right")
            rest = fps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            low = np.ascontiguousarray(rest[:, :4]).view("<u4")[:, 0]
            high = np.ascontiguousarray(rest[:, 4:6]).view("<u2")[:, 0]
            names, lows, highs, numbers, at = [], [], [], [], 0
            for k, end in enumerate(ends.tolist()):
                if end > at:
                    names.append(k)
                    # Within a range the upper 16 bits hardly change: they compress to nothing.
                    lows.append(low[at:end].tobytes())
                    highs.append(high[at:end].tobytes())
                    numbers.append(counts[at:end].tobytes())
                at = end
            columns = [pa.array(names, pa.int32()), *(pa.array(x, pa.binary()) for x in (lows, highs, numbers))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "low", "high", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        sizes: dict[int, int] = defaultdict(int)

        def fold(part: int) -> tuple[np.ndarray, np.ndarray]:
            fps = np.concatenate([f for f, _ in sums[part]])
            counts = np.concatenate([c for _, c in sums[part]])
            order = np.argsort(fps)
            fps, counts = fps[order], counts[order]
            first = np.flatnonzero(np.concatenate(([True], fps[1:] != fps[:-1])))
            return fps[first], np.add.reduceat(counts, first)

        for batch in batches:
            for part, low, high, counts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                fps = np.frombuffer(low, "<u4").astype(np.uint64) | (np.frombuffer(high, "<u2").astype(np.uint64) << np.uint64(32))
                sums[part].append((fps, np.frombuffer(counts, wide).astype(np.int64)))
                sizes[part] += len(fps)
                if sizes[part] > 1 << 22:
                    sums[part] = [fold(part)]
                    sizes[part] = -len(sums[part][0][0])  # grows by as much again before the next fold
        for part in sums:
            fps, counts = fold(part)
            yield pa.RecordBatch.from_arrays([pa.array(fps[counts >= least].astype(np.int64))], ["fp"])

    packed = _rows(docs).mapInArrow(pack, "part int, low binary, high binary, counts binary")
    return packed.repartition("part").mapInArrow(total, "fp long")


def _table(fps: DataFrame) -> np.ndarray:
    """Bit table of the fingerprints, folded by Spark; at most ``TABLE_BITS / 64`` rows come to the driver."""
    bit = F.pmod("fp", F.lit(TABLE_BITS))
    words = fps.groupBy((bit / 64).cast("int").alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(fp, {TABLE_BITS}) % 64 as int))")).alias("word"))
    found = words.toArrow()
    out = np.zeros(TABLE_BITS // 64, dtype=np.uint64)
    out[found.column("at").to_numpy()] = found.column("word").to_numpy().view(np.uint64)
    return out.view(np.uint8)


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ``length`` bytes from ``a`` equal those from ``b``; ``data`` has 8 bytes to spare."""
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    same = np.ones(len(a), dtype=bool)
    left = np.arange(len(a))
    at = 0
    while len(left):
        rest = length[left] - at
        mask = np.where(rest >= 8, np.uint64(2**64 - 1), (np.uint64(1) << (np.minimum(rest, 7).astype(np.uint64) * np.uint64(8))) - np.uint64(1))
        good = ((eight[a[left] + at] ^ eight[b[left] + at]) & mask) == 0
        same[left[~good]] = False
        left = left[good & (rest > 8)]
        at += 8
    return same


def _told_apart(part: Slice, first: np.ndarray, fps: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(first word of a phrase's first occurrence, count)``; occurrences are compared byte for byte."""
    data = np.concatenate([part.bytes, np.zeros(8, dtype=np.uint8)])
    while len(first):
        order = np.argsort(fps, kind="stable")
        new = np.concatenate(([True], fps[order][1:] != fps[order][:-1]))
        head = first[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        at = first[order]
        length, of_head = part.stops[at + n - 1] - part.starts[at], part.stops[head + n - 1] - part.starts[head]
        same = length == of_head
        same[same] = _same(data, part.starts[at[same]], part.starts[head[same]], length[same])
        heads, counts = np.unique(head[same], return_counts=True)
        yield heads, counts
        first, fps = at[~same], fps[order][~same]


TOLD = ["part", "lang", "phrase", "a", "doc_id", "word"]


def _columns(part: Slice, heads: np.ndarray, counts: np.ndarray, n: int, fps: np.ndarray) -> pa.Table:
    """Phrases of ``n`` words by their first words, as columns; for ``n`` 0 the row with the number of all words."""
    if n:
        start = part.starts[heads]
        size = part.stops[heads + n - 1] - start
        ends = np.cumsum(size)
        # The bytes of all phrases in a row, gathered by place.
        place = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat((start - ends + size).astype(np.int32), size)
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        said = pa.StringArray.from_buffers(len(heads), pa.py_buffer(offsets), pa.py_buffer(part.bytes[place]))
        doc, word = part.pointer(heads)
    else:
        said, counts, fps = pa.array([""]), np.array([part.own]), part.seed.reshape(1)
        doc, word = pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())
    dealt = pa.array((fps >> np.uint64(64 - PART_BITS)).astype(np.int32))
    return pa.Table.from_arrays([dealt, pa.repeat(part.lang, len(said)), said, pa.array(counts, pa.int64()), doc, word], TOLD)


def _summed(told: pa.Table) -> pa.Table:
    """One row per phrase: the sum of ``a``, and the pointer that comes first (no document before all others)."""
    order = pc.sort_indices(told, sort_keys=[("doc_id", "ascending"), ("word", "ascending")], null_placement="at_start")
    first = pc.ScalarAggregateOptions(skip_nulls=False)
    groups = told.take(order).group_by(["part", "lang", "phrase"], use_threads=False)
    out = groups.aggregate([("a", "sum"), ("doc_id", "first", first), ("word", "first", first)])
    return out.select(["part", "lang", "phrase", "a_sum", "doc_id_first", "word_first"]).rename_columns(TOLD).combine_chunks()


def _listed(told: pa.Table, most: int) -> Iterator[pa.RecordBatch]:
    """One row for up to ``most`` phrases of a part and language; ``_spread`` takes the lists apart again."""
    told = told.take(pc.sort_indices(told, sort_keys=[("part", "ascending"), ("lang", "ascending")]))
    (rows,) = told.combine_chunks().to_batches()
    part, lang = rows.column("part").to_numpy(), rows.column("lang").dictionary_encode().indices.to_numpy()
    new = np.concatenate(([True], (part[1:] != part[:-1]) | (lang[1:] != lang[:-1])))
    place = np.arange(len(part)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    starts = np.flatnonzero(place % most == 0)
    ends = pa.array(np.append(starts, len(part)), pa.int32())
    names = [rows.column(c).take(pa.array(starts)) for c in TOLD[:2]]
    out = pa.RecordBatch.from_arrays([*names, *(pa.ListArray.from_arrays(ends, rows.column(c)) for c in TOLD[2:])], TOLD)
    for at in range(0, out.num_rows, 256):
        yield out.slice(at, 256)


def _spread(rows: pa.RecordBatch) -> pa.Table:
    """One row per phrase of the rows of ``_listed``."""
    of = pc.list_parent_indices(rows.column("phrase"))
    return pa.Table.from_arrays([*(rows.column(c).take(of) for c in TOLD[:2]), *(rows.column(c).flatten() for c in TOLD[2:])], TOLD)


def phrase_counts(docs: DataFrame, least: int = 100, most_words: int = 5) -> DataFrame:
    """``(lang, phrase, words, a, first)`` of all phrases of 1 to ``most_words`` words with ``a >= least``.

    ``first`` points at the occurrence with the smallest document and place. ``words`` 0 and an empty phrase: the
    number of all words of the language.
    """
    table = docs.sparkSession.sparkContext.broadcast(_table(frequent_fingerprints(docs, least, most_words)))

    size, held_most, listed = SLICE, HELD, LISTED

    def materialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        held = None
        for part in _slices(batches, most_words - 1, size):
            none = np.zeros(0, dtype=np.int64)
            told = [_columns(part, none, none, 0, none)]
            for n in range(1, most_words + 1):
                first, fps = part.grams(n)
                bit = (fps >> np.uint64(16)) & np.uint64(TABLE_BITS - 1)
                hit = (bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                first, fps = first[hit], fps[hit]
                told += [_columns(part, heads, number, n, fps[np.searchsorted(first, heads)]) for heads, number in _told_apart(part, first, fps, n)]
                del first, fps, bit, hit
            del part
            told = pa.concat_tables(told)
            held = told if held is None else _summed(pa.concat_tables([held, told]))
            del told
            pa.default_memory_pool().release_unused()
            if held.num_rows > held_most:
                yield from _listed(held, listed)
                held = None
        if held is not None:
            yield from _listed(held, listed)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            waiting.append(_spread(batch))
            rows += waiting[-1].num_rows
            if rows > held_most:
                waiting = [_summed(pa.concat_tables(waiting))]
                rows = -waiting[0].num_rows  # grows by as much again before the next sum
        if waiting:
            whole = _summed(pa.concat_tables(waiting))
            every = pc.equal(whole.column("phrase"), "")
            words = pc.if_else(every, 0, pc.add(pc.count_substring(whole.column("phrase"), " "), 1))
            whole = whole.drop_columns(["part"]).add_column(2, "words", words.cast(pa.int32()))
            yield from whole.filter(pc.or_(every, pc.greater_equal(whole.column("a"), least))).to_batches(1 << 14)

    lists = "part int, lang string, phrase array<string>, a array<long>, doc_id array<long>, word array<long>"
    told = _rows(docs).mapInArrow(materialise, lists).repartition("part")
    whole = told.mapInArrow(total, "lang string, phrase string, words int, a long, doc_id long, word long")
    return whole.select("lang", "phrase", "words", "a", F.struct("doc_id", "word").alias("first"))


def collocations(docs: DataFrame, least: int = 100, most_words: int = 5, top: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score, first)``: the ``top`` phrases of each language, best score first.

    ``score`` is ``floor(1000 * a * n / (l * r))`` at the phrase's lowest-scoring cut (the first of equals). A phrase
    that stands in a longer one as often as alone is left out. Products are decimals of 38 digits.
    """
    known = keep(phrase_counts(docs, least, most_words), "phrases")
    candidates = known.where("words > 1")
    parts = candidates.select("lang", "phrase", "words", "a", "first", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    spaced = F.split("phrase", " ", -1)
    parts = parts.withColumn("left", F.concat_ws(" ", F.slice(spaced, F.lit(1), F.col("k")))).withColumn(
        "right", F.concat_ws(" ", F.slice(spaced, F.col("k") + 1, F.col("words")))
    )
    named = lambda side, count: known.where("words > 0").select("lang", F.col("phrase").alias(side), F.col("a").alias(count))
    totals = known.where("words = 0").select("lang", F.col("a").alias("n"))
    cuts = parts.join(named("left", "l"), ["lang", "left"]).join(named("right", "r"), ["lang", "right"]).join(totals, "lang")
    big = lambda c: f"cast({c} as decimal(18,0))"
    cuts = cuts.withColumn("score", F.expr(f"(1000BD * {big('a')} * {big('n')}) div ({big('l')} * {big('r')})"))
    scored = cuts.groupBy("lang", "phrase", "words", "a", "n", "first").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # A longer phrase that is as frequent holds one of one word more that is, at either end.
    spaced = F.split("phrase", " ", -1)
    longer = candidates.where("words > 2").select(
        "lang", F.explode(F.array(F.concat_ws(" ", F.slice(spaced, F.lit(1), F.col("words") - 1)), F.concat_ws(" ", F.slice(spaced, F.lit(2), F.col("words"))))).alias("phrase"), "a"
    )
    scored = scored.join(longer.groupBy("lang", "phrase").agg(F.max("a").alias("within")), ["lang", "phrase"], "left")
    scored = scored.where("within is null or within < a").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "first")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of shares of a language, then the best of these: no language meets in one task whole.
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*best)
    few = scored.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "first")


ORACLE = r"""
WITH pieces AS (
    SELECT row_number() OVER () AS piece, lang, regexp_extract_all(said, '[^ \t]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS said
          FROM documents)
),
words AS (SELECT piece, lang, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM pieces),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
grams AS (
    SELECT lang, word AS p1, lead(word, 1) OVER s AS w2, lead(word, 2) OVER s AS w3, lead(word, 3) OVER s AS w4, lead(word, 4) OVER s AS w5
    FROM words WINDOW s AS (PARTITION BY piece ORDER BY place)
),
said AS (
    SELECT lang, 1 AS words, p1 AS phrase FROM grams
    UNION ALL SELECT lang, 2, p1 || ' ' || w2 FROM grams WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, 3, p1 || ' ' || w2 || ' ' || w3 FROM grams WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, 4, p1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM grams WHERE w4 IS NOT NULL
    UNION ALL SELECT lang, 5, p1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM grams WHERE w5 IS NOT NULL
),
known AS (SELECT lang, phrase, words, count(*) AS a FROM said GROUP BY lang, phrase, words HAVING count(*) >= 100),
split AS (
    SELECT lang, phrase, words, a, string_split(phrase, ' ') AS w, unnest(range(1, words)) AS k FROM known WHERE words > 1
),
cuts AS (
    SELECT s.lang, s.phrase, s.words, s.a, s.k, l.a AS l, r.a AS r, t.n,
           (1000::HUGEINT * s.a * t.n) // (l.a::HUGEINT * r.a) AS score
    FROM split s
    JOIN known l ON l.lang = s.lang AND l.phrase = array_to_string(s.w[1:s.k], ' ')
    JOIN known r ON r.lang = s.lang AND r.phrase = array_to_string(s.w[s.k + 1:], ' ')
    JOIN totals t ON t.lang = s.lang
),
scored AS (
    SELECT lang, phrase, words, a, l, r, n, score FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
free AS (
    SELECT * FROM scored s WHERE NOT EXISTS (
        SELECT 1 FROM known o WHERE o.lang = s.lang AND o.words > s.words AND o.a >= s.a
        AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free
) WHERE rank <= 2000
"""
