"""Quality rules with an n-gram perplexity verdict.

Spark counts character 5-grams of all texts by language, and derives from them an interpolated modified
Kneser-Ney model: raw counts at the highest order, numbers of distinct left neighbours below. The model is
two kinds of numbers, the discounted share of each n-gram and the back-off weight of each context, kept as a
table sorted by a 64-bit hash, in range-partitioned files: sorted hash arrays. A scoring task looks up the
distinct n-grams of its texts in those files, one file at a time, with a bounded number of files in memory;
it finds the files by ``pyarrow.fs``. A text fails if its mean log probability leaves its language's band.

Defined cases: a null text has no words and fails the base rules; a null language is a language of its own;
texts are read whole; repeated rows each get a row; an empty table stays empty; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virotide.llm.common import keep, new_folder, once
from virotide.llm.warc import _open

ORDER = 5
START = 2
SLICE = 1 << 21
UNSEEN = 1.0 / (1 << 12)
MIX = np.uint64(0x9E3779B97F4A7C15)
SYMBOLS = b"#*$%&|<>"
FILES_IN_MEMORY = 64
SALTS = 16


def _language_seed(lang: str) -> int:
    out = 0xCBF29CE484222325
    for byte in lang.encode("utf-8", "surrogatepass"):
        out = (out ^ byte) * 0x100000001B3 % (1 << 64)
    return out


def keys(codes: list[np.ndarray], seed: int, context: bool) -> np.ndarray:
    """Hashes of n-grams (or contexts), given as one array of code points per place."""
    kind = (2 * len(codes) + int(context) + 1) * 0xD6E8FEB86659FD93 % (1 << 64)  # kinds far apart, so that a code cannot bridge them
    out = np.full(len(codes[0]) if codes else 1, np.uint64(kind), dtype=np.uint64) + np.uint64(seed)
    for column in codes:
        out = (out ^ column.astype(np.uint64)) * MIX
        out ^= out >> np.uint64(29)
    return (out * np.uint64(0xBF58476D1CE4E5B9) ^ (out >> np.uint64(31))).view(np.int64)


def _codes(text: str) -> np.ndarray:
    flat = " ".join(text.lower().split())
    return np.frombuffer((chr(START) * (ORDER - 1) + flat).encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _slices(texts) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Texts in groups of about ``SLICE`` code points; a longer text comes in overlapping parts."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        codes = _codes(text or "")
        for at in range(0, max(1, len(codes) - ORDER + 1), SLICE):
            part = codes[at : at + SLICE + ORDER - 1]
            if len(part) >= ORDER:
                rows.append(row)
                parts.append(part)
                size += len(part)
        if size >= SLICE:
            yield rows, parts
            rows, parts, size = [], [], 0
    if parts:
        yield rows, parts


def _distinct(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams as rows of codes, the number of each, which one stands at each place, first places of parts."""
    joined = np.concatenate(parts)
    sizes = np.array([len(p) for p in parts])
    inside = np.ones(len(joined), dtype=bool)
    for back in range(1, ORDER):
        inside[np.cumsum(sizes) - back] = False
    at = np.flatnonzero(inside)
    hashed = keys([joined[at + i] for i in range(ORDER)], 0, False)
    _, first, which, count = np.unique(hashed, return_index=True, return_inverse=True, return_counts=True)
    begins = np.cumsum(sizes - ORDER + 1) - (sizes - ORDER + 1)
    return joined[at[first][:, None] + np.arange(ORDER)], count, which, begins


def _strings(codes: np.ndarray) -> list[str]:
    width = codes.shape[1]
    flat = np.ascontiguousarray(codes, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [flat[i : i + width] for i in range(0, len(flat), width)]


def count_grams(docs: DataFrame) -> DataFrame:
    """``(lang, gram, c)``: how often each 5-gram occurs in the texts of a language; all texts, whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for _, parts in _slices(texts):
                    codes, count, _, _ = _distinct(parts)
                    yield pd.DataFrame({"lang": lang, "gram": _strings(codes), "c": count})

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null")
    return rows.mapInPandas(run, "lang string, gram string, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def _discount(c: Column) -> Column:
    return F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))


def train(docs: DataFrame) -> str:
    """Folder of the model's files: ``(key, value)`` sorted by key, range-partitioned."""
    top = keep(count_grams(docs), "grams").withColumn("n", F.lit(ORDER))
    orders, level = [top], top
    for n in range(ORDER - 1, 0, -1):
        level = level.groupBy("lang", F.substring("gram", 2, n).alias("gram")).agg(F.count("*").alias("c")).withColumn("n", F.lit(n))
        orders.append(level)
    counts = orders[0]
    for level in orders[1:]:
        counts = counts.unionByName(level)
    counts = keep(counts.withColumn("context", F.expr("substring(gram, 1, n - 1)")), "counts")
    often = counts.groupBy("lang", "n").agg(*[F.count(F.when(F.col("c") == k, 1)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.col("n1") / F.nullif(F.col("n1") + 2 * F.col("n2"), F.lit(0.0))

    def bounded(k: int) -> Column:
        estimate = k - (k + 1) * y * F.col(f"n{k + 1}") / F.nullif(F.col(f"n{k}"), F.lit(0.0))
        return F.least(F.greatest(F.coalesce(estimate, F.lit(0.5 * k)), F.lit(0.05)), F.lit(k - 0.05)).alias(f"d{k}")

    discounts = often.select("lang", "n", bounded(1), bounded(2), bounded(3))
    tails = counts.groupBy("lang", "n", "context").agg(
        F.sum("c").alias("total"), F.count(F.when(F.col("c") == 1, 1)).alias("t1"), F.count(F.when(F.col("c") == 2, 1)).alias("t2"), F.count(F.when(F.col("c") > 2, 1)).alias("t3")
    )
    tails = keep(tails.join(discounts, ["lang", "n"]), "tails")
    shares = counts.join(tails, ["lang", "n", "context"]).select("lang", "gram", F.lit(False).alias("of_context"), ((F.col("c") - _discount(F.col("c"))) / F.col("total")).alias("value"))
    weight = (F.col("d1") * F.col("t1") + F.col("d2") * F.col("t2") + F.col("d3") * F.col("t3")) / F.col("total")
    entries = shares.union(tails.select("lang", F.col("context").alias("gram"), F.lit(True), weight))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch["gram"].str.len()
            for (lang, of_context, n), own in batch.groupby(["lang", "of_context", size]):
                codes = np.frombuffer("".join(own["gram"]).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(own), n)
                key = keys([codes[:, i] for i in range(n)], _language_seed(lang), of_context)
                yield pd.DataFrame({"key": np.broadcast_to(key, len(own)), "value": own["value"].to_numpy(np.float32)})

    folder = new_folder(docs.sparkSession, "model")
    table = entries.mapInPandas(hashed, "key long, value float")
    table.repartitionByRange("key").sortWithinPartitions("key").write.option("compression", "zstd").parquet(folder)
    return folder


class Model:
    """Looks numbers up in the sorted files of a model."""

    def __init__(self, files: list[tuple[int, int, str]]):
        self.files = sorted(files)
        self.loaded: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def _load(self, path: str) -> tuple[np.ndarray, np.ndarray]:
        if path not in self.loaded:
            import pyarrow.parquet as pq

            if len(self.loaded) >= FILES_IN_MEMORY:
                self.loaded.pop(next(iter(self.loaded)))
            system, own = _open(path)
            with system.open_input_file(own) as file:
                rows = pq.read_table(file, use_threads=False)
            self.loaded[path] = rows["key"].to_numpy(), rows["value"].to_numpy()
        return self.loaded[path]

    def find(self, wanted: np.ndarray, absent: float) -> np.ndarray:
        out = np.full(len(wanted), absent, dtype=np.float64)
        order = np.argsort(wanted)
        asked = wanted[order]
        for low, high, path in self.files:
            a, b = np.searchsorted(asked, low, "left"), np.searchsorted(asked, high, "right")
            if a < b:
                key, value = self._load(path)
                at = np.searchsorted(key, asked[a:b])
                at[at == len(key)] = 0
                hit = key[at] == asked[a:b]
                out[order[a:b][hit]] = value[at[hit]]
        return out

    def log_probability(self, codes: np.ndarray, lang: str) -> np.ndarray:
        """Of the last character of each row of codes, given the others."""
        seed, p = _language_seed(lang), np.full(len(codes), UNSEEN)
        for n in range(1, ORDER + 1):
            gram = [codes[:, i] for i in range(ORDER - n, ORDER)]
            context = np.broadcast_to(keys(gram[:-1], seed, True), len(codes))
            p = self.find(keys(gram, seed, False), 0.0) + self.find(context, 1.0) * p
        return np.log(p)


def scores(docs: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, lang, base columns, log_ppl)``: counts of the base rules, and mean negative log probability."""
    spark = docs.sparkSession
    table = spark.read.parquet(folder)
    ranges = table.groupBy(F.input_file_name().alias("path")).agg(F.min("key").alias("low"), F.max("key").alias("high"))
    files = [(r["low"], r["high"], r["path"]) for r in ranges.collect()]  # one row for each file of the model
    names = ["doc_id", "lang", *BASE, "log_ppl"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = once(f"model {folder}", lambda: Model(files))
        for batch in batches:
            for lang, own in batch.groupby("lang"):
                total, size = np.zeros(len(own)), np.zeros(len(own))
                for rows, parts in _slices(own["text"]):
                    codes, _, which, begins = _distinct(parts)
                    each = model.log_probability(codes, lang)[which]
                    np.add.at(total, rows, np.add.reduceat(each, begins))
                    np.add.at(size, rows, np.diff(begins, append=len(each)))
                base = [base_counts(t or "") for t in own["text"]]
                out = pd.DataFrame(base, columns=list(BASE))
                out.insert(0, "doc_id", own["doc_id"].to_numpy())
                out.insert(1, "lang", lang)
                out["log_ppl"] = np.where(size > 0, -total / np.maximum(size, 1), 0.0)
                yield out[names]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_ppl double")


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated 3-word windows. Blanks are ASCII."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.split(None, 1)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen: dict[tuple, int] = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
        end = 0
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def judge(docs: DataFrame, width: float = 4.0) -> DataFrame:
    """``(doc_id, lang, base columns, log_ppl, low, high, base_failed, kept)`` of every row.

    A language's band reaches ``width`` times the distance between its quartiles beyond them (0.05 at least);
    quartiles are over the documents that pass the base rules, each counted as often as it occurs.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = keep(scores(docs, train(docs)).withColumn("base_failed", failed), "scores")
    # Equal rounded scores are one row with a count before the quartiles are taken.
    steps = scored.where("not base_failed").groupBy("lang", F.round("log_ppl", 3).alias("step")).agg(F.count("*").alias("n"))
    quartiles = steps.groupBy("lang").agg(F.percentile("step", F.array(F.lit(0.25), F.lit(0.75)), F.col("n")).alias("q"))
    reach = F.greatest(width * (F.col("q")[1] - F.col("q")[0]), F.lit(0.05))
    bands = quartiles.select("lang", (F.col("q")[0] - reach).alias("low"), (F.col("q")[1] + reach).alias("high"))
    bands = bands.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = scored.withColumn("_salt", F.pmod(F.hash("doc_id"), F.lit(SALTS))).join(bands, ["lang", "_salt"], "left").drop("_salt")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("log_ppl").between(F.col("low"), F.col("high")))
