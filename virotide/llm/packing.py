"""Best-fit packing of tokenised documents into sequences of fixed length.

Bounded-space online best-fit: a task holds a fixed number of open bins, and a bitset keyed by free space
tells which amounts of space are open. A piece goes to the bin with the least space that takes it; where
none does, a new bin opens, and if that is one too many the fullest bin closes.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each on their own;
an empty table gives no rows; columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_TOKEN = 0
#: Entries of each of a task's two tables (words, stems) before it starts anew; bounds memory, not results.
TABLE_ENTRIES = 1 << 18
#: Letters that stand for themselves in any neighbourhood, then ASCII marks without the apostrophe (it joins).
STEM_AND_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class WordTokens:
    """Token ids of texts, by way of tables of the words seen.

    The tokenizer drops white space and never joins across it, nor across the border between letters and
    marks, so a text's ids are those of its words, and a word's are those of its stem and its marks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        split = self.model.pre_tokenizer.pre_tokenize_str
        self.spelled = {c: "".join(part for part, _ in split(chr(c))) for c in range(0xDF, 0x100) if chr(c).isalpha()}
        self.words: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return array("I", self.model.encode(text, add_special_tokens=False).ids).tobytes()

    def _stem(self, text: str) -> bytes:
        """Ids of lower-case letters (the model alone does, given their bytes' spelling) or of marks."""
        out = self.stems.get(text)
        if out is None:
            if len(self.stems) >= TABLE_ENTRIES:
                self.stems.clear()
            if text.isalpha():
                out = array("I", [t.id for t in self.model.model.tokenize(text.translate(self.spelled))]).tobytes()
            else:
                out = self._encode(text)
            self.stems[text] = out
        return out

    def _word(self, word: str) -> bytes:
        cut = STEM_AND_MARKS.fullmatch(word)
        out = self._stem(cut[1].lower()) + (self._stem(cut[2]) if cut[2] else b"") if cut else self._encode(word)
        if len(self.words) >= TABLE_ENTRIES:
            self.words.clear()
        self.words[word] = out
        return out

    def ids(self, text: str) -> np.ndarray:
        """Ids of the text and the end token."""
        get = self.words.get
        found = [get(w) or self._word(w) for w in text.replace("\n", " ").split(" ") if w]
        found.append(END_TOKEN.to_bytes(4, "little"))
        return np.frombuffer(b"".join(found), dtype="<u4")


def tokenize(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: the ids of each text and an end token, cut only beyond ``capacity``.

    ``ids`` are little-endian unsigned 32-bit integers. ``tokenizer`` is the path of a tokenizer file that
    every executor can open.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = None
        for batch in batches:
            words = words or WordTokens(tokenizer)  # goes with the task: an idle worker holds no tables
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = words.ids(text or "")
                for n, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, n, start, len(part), part.tobytes()))
                if len(rows) > 4096:
                    yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"], dtype=object)
                    rows = []
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"], dtype=object)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(
        run, "doc_id long, piece int, start long, length long, ids binary"
    )


class OpenBins:
    """At most ``most`` open bins of ``capacity``, found by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.spaces = 0  # bit f: some open bin has f free
        self.by_space: dict[int, list[int]] = {}
        self.count = self.made = 0

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        out = bins.pop()
        if not bins:
            del self.by_space[space]
            self.spaces &= ~(1 << space)
        self.count -= 1
        return out

    def place(self, length: int) -> tuple[int, int]:
        """Bin number and offset for a piece."""
        fitting = self.spaces >> length << length
        if fitting:
            space = (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            number, space = self.made, self.capacity
            self.made += 1
        left = space - length
        if left:
            if self.count == self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest closes
            self.by_space.setdefault(left, []).append(number)
            self.spaces |= 1 << left
            self.count += 1
        return number, self.capacity - space


def pack(pieces: DataFrame, capacity: int = 2048, open_bins: int = 512) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs columns ``doc_id``, ``piece``, ``length`` (1 to ``capacity``).

    Pieces are dealt by a hash of document and piece (a long document spreads), and each task sorts its
    share first, so that a task that runs again gives the same places. Only as many bins as ``open_bins``
    stay unfilled for each task.
    """
    extra = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*[f"`{c}`" for c in extra]).schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, task = OpenBins(capacity, open_bins), TaskContext.get().partitionId()
        for batch in batches:
            placed = [bins.place(int(n)) for n in batch["length"]]
            batch["sequence_id"] = [(task << 40) | number for number, _ in placed]
            batch["offset"] = [offset for _, offset in placed]
            yield batch.drop(columns="_place")

    dealt = pieces.select(*[f"`{c}`" for c in extra]).withColumn("_place", F.xxhash64("doc_id", "piece"))
    return dealt.repartition("_place").sortWithinPartitions("_place", "doc_id", "piece", "length").mapInPandas(
        run, f"{schema}, sequence_id long, offset long"
    )
