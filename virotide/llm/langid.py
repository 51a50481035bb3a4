"""Language identification with language-bitmask n-gram filters.

One Bloom filter per language, all bit-sliced into one table: a slot holds one bit for each language, so
the AND of an n-gram's slots is the mask of all languages whose filter contains it. A text is decided by
the number of its n-grams with each language's bit set, less the hits expected by chance from the share of
that language's bits that are set.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; texts are read whole; a row
without an id or language is never learned from; without any labelled row everything is ``und``; equal
counts go to the language that sorts first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")
SLICE = 1 << 20
MOST_LANGUAGES = 1024


def grams(text: str, n: int) -> np.ndarray:
    """64-bit hashes of the character n-grams of the letters in ``text``; words are set apart by one blank."""
    letters = NOT_LETTERS.sub(" ", text.lower()).strip()
    if not letters:
        return np.zeros(0, dtype=np.uint64)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if len(codes) < n:
        codes = np.concatenate([codes, np.full(n - len(codes), 32, dtype=np.uint64)])
    mixed = np.zeros(len(codes) - n + 1, dtype=np.uint64)
    for i in range(n):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - n + 1 + i]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


@dataclass
class LanguageFilters:
    """``table[slot, plane]``: bit ``l % 64`` of plane ``l // 64`` belongs to language ``l``."""

    languages: list[str]
    table: np.ndarray
    n: int
    probes: int

    def __post_init__(self) -> None:
        slots = max(1, len(self.table))
        self.chance = np.array(
            [(np.count_nonzero(self.table[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)) / slots) ** self.probes for k in range(len(self.languages))]
        )

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram the languages that contain it, as bits."""
        out = None
        for i in range(self.probes):
            rows = self.table[positions(hashes, i, len(self.table))]
            out = rows if out is None else out & rows
        return out

    def decide(self, text: str | None) -> tuple[str, float]:
        hashes = grams(text, self.n) if text and self.languages else ()
        if not len(hashes):
            return UNKNOWN, 0.0
        hits = np.zeros(len(self.languages))
        for at in range(0, len(hashes), SLICE):
            found = self.masks(hashes[at : at + SLICE])
            for k in range(len(self.languages)):
                hits[k] += np.count_nonzero(found[:, k // 64] & np.uint64(1 << (k % 64)))
        share = np.clip((hits / len(hashes) - self.chance) / np.maximum(1 - self.chance, 1e-9), 0.0, 1.0)
        best = int(np.argmax(share))
        return self.languages[best], float(share[best])


def positions(hashes: np.ndarray, probe: int, slots: int) -> np.ndarray:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return ((hashes + np.uint64(probe) * step) % np.uint64(slots)).astype(np.int64)


def held_out(doc_id: Column) -> Column:
    """One in four documents, by a checksum of the id; rows without an id count as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def learn(
    docs: DataFrame, *, n: int = 4, sample: int = 4000, least_share: float = 0.003, slots: int = 1 << 18, probes: int = 3
) -> LanguageFilters:
    """Filters from a bounded sample: about ``sample`` labelled documents of each language, chosen by a hash of the id.

    An n-gram enters a language's filter if ``least_share`` of that language's sample (two documents at least)
    has it. The table has ``slots`` rows, whatever the input: that bounds what goes to the driver and back.
    At most 1024 languages.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(counts)
    planes = max(1, -(-len(languages) // 64))
    table = np.zeros((slots, planes), dtype=np.uint64)
    if not languages:
        return LanguageFilters(languages, table, n, probes)
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
    cut = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample / counts[lang]))])
    place = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 20)) / float(1 << 20)
    chosen = labelled.where(place < cut[F.col("lang")]).select(number[F.col("lang")].alias("k"), "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, texts in batch.groupby("k")["text"]:
                each = [np.unique(grams(t, n)) for t in texts]
                found, df = np.unique(np.concatenate(each), return_counts=True)
                yield pd.DataFrame({"k": np.full(len(found), k, dtype=np.int32), "gram": found.view(np.int64), "df": df})

    least = F.create_map(*[F.lit(x) for k, lang in enumerate(languages) for x in (k, max(2.0, least_share * min(sample, counts[lang])))])
    frequent = (
        chosen.mapInPandas(count, "k int, gram long, df long").groupBy("k", "gram").agg(F.sum("df").alias("df")).where(F.col("df") >= least[F.col("k")])
    )

    def slot(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes = batch["gram"].to_numpy().view(np.uint64)
            for i in range(probes):
                yield pd.DataFrame({"slot": positions(hashes, i, slots), "plane": batch["k"] // 64, "bits": np.left_shift(np.int64(1), (batch["k"] % 64).to_numpy(np.int64))})

    rows = frequent.select("gram", "k").mapInPandas(slot, "slot long, plane int, bits long").groupBy("slot", "plane").agg(F.bit_or("bits").alias("bits")).toArrow()
    table[rows["slot"].to_numpy(), rows["plane"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return LanguageFilters(languages, table, n, probes)


def predict(docs: DataFrame, filters: LanguageFilters, name: str = "language") -> DataFrame:
    """``docs`` with a struct column ``name`` of ``lang_pred`` and ``score``; a column of that name is replaced.

    The score is the share of the text's n-grams that the language's filter knows, corrected for chance.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("lang_pred string, score double")
    def decide(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.decide(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn(name, decide(F.col("text").cast("string")))


def known_language(docs: DataFrame, filters: LanguageFilters, least: float = 0.25) -> DataFrame:
    """The rows of ``docs`` in some learned language: predicted with a score of ``least`` or more."""
    name = "_language"
    while name in docs.columns:
        name += "_"
    kept = predict(docs, filters, name).where((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= least))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
