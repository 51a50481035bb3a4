"""Alignment of two tokenizers' tokens over the bytes they stand for.

Cutting a text where tokens of both sides end gives groups. A text is cut into byte ranges; each range gives a
fragment: an open prefix (tokens up to its first common end), closed groups, and an open suffix. Fragments compose
associatively, so those of a very long document are folded as a tree by Spark tasks; a text of one range is closed at
once. Links are pairs of tokens whose bytes overlap: between two neighbouring ends, of either side, lies one link.

Links are counted by id pair over all documents. The documents of one block (some megabytes of text) then meet the
counts of the pairs that the block holds, so neither all counts nor all links are ever in one place.

Words are encoded once for each task and remembered. Between two characters that are not white space a single space
always starts a new token: on the byte-level side by its pattern, on the other as no piece has a space behind a letter
(this is checked when they are loaded).

Defined cases: a null or empty text, and one whose tokens do not spell the text, has no tokens, zero counts and an
empty digest; repeated rows each get a row and count each; a null ``doc_id`` stays null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virotide.llm.common import keep, once

#: Bytes of a range of a long text, of texts that are worked on together, and of the texts of one block.
RANGE, TOGETHER, BLOCK = 1 << 16, 1 << 21, 1 << 22
#: Fragments that one step of the tree puts together.
FAN = 8
#: Words that a task remembers before it starts anew; bounds memory, not results.
WORDS = 1 << 18
CUT = re.compile(r"(?<=\S) (?=\S)")
UNSAFE = re.compile(r" \s|\s |^ | $")
#: Longest word without white space that goes to the fast encoder; longer ones go to the tokenizer file itself.
LONG_WORD = 1 << 12


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Sides:
    """Both tokenizers: the ids of a space and a word, and the bytes of each id."""

    def __init__(self, byte_level: str, pieces: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        letters = _byte_letters()
        with open(byte_level, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["id"] for t in model["added_tokens"]}
        entries = {i: bytes(letters[c] for c in t) for t, i in model["model"]["vocab"].items() if i not in special}
        # Ids of such a vocabulary are in the order of its merges: what the fast encoder needs.
        self.fast = tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in entries.items()}, special_tokens={})
        self.slow = Tokenizer.from_file(byte_level)
        self.slow.encode_special_tokens = True
        self.piece = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [self.piece.id_to_piece(i) for i in range(self.piece.get_piece_size())]
        self.bytes_b = [bytes([int(t[3:5], 16)]) if self.piece.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(names)]
        if any(re.search(r"[^\s▁]▁", t) for t in names):
            raise ValueError("pieces with a space behind a letter cannot be applied word by word")
        self.length_a = np.zeros(max(entries) + 1, dtype=np.int64)
        self.length_a[list(entries)] = [len(t) for t in entries.values()]
        self.length_b = np.array([len(t) for t in self.bytes_b], dtype=np.int64)
        # What the digest says of an id within its side of a group, and at its end.
        self.said = [f"{i},".encode() for i in range(len(self.length_a))] + [f"{i}|".encode() for i in range(len(self.length_a))]
        self.said += [f"{i},".encode() for i in range(len(names))] + [f"{i};".encode() for i in range(len(names))]
        self.words: dict[str, tuple[bytes, bytes] | None] = {}

    def _learn(self, words: list[str]) -> None:
        """Ids of both sides as 32-bit integers; None if the pieces do not spell the word."""
        spell, fast = self.bytes_b.__getitem__, self.fast.encode_ordinary
        for word, b in zip(words, self.piece.encode(words, num_threads=1), strict=True):
            spaced = " " + word
            if b"".join(map(spell, b)) != spaced.encode():
                self.words[word] = None
                continue
            a = fast(spaced) if len(word) <= LONG_WORD else self.slow.encode(spaced, add_special_tokens=False).ids
            self.words[word] = array("I", a).tobytes(), array("I", b).tobytes()

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        if not text:
            return None
        words = CUT.split(text) if UNSAFE.search(text) else text.split(" ")
        missing = set(words).difference(self.words)
        if missing:
            if len(self.words) + len(missing) > WORDS:
                self.words.clear()
                missing = set(words)
            self._learn(list(missing))
        found = list(map(self.words.__getitem__, words))
        if None in found:
            return None
        return np.frombuffer(b"".join([a for a, _ in found]), "<u4"), np.frombuffer(b"".join([b for _, b in found]), "<u4")


@dataclass
class Span:
    """Tokens of both sides with the bytes at which they end."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def __add__(self, other: Span) -> Span:
        return Span(*(np.concatenate([x, y]) for x, y in zip(self.parts(), other.parts(), strict=True)))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_end, self.b, self.b_end

    def between(self, low: int | None, high: int | None) -> Span:
        """Tokens that end beyond ``low``, up to ``high``."""
        i, j = (slice(None if low is None else np.searchsorted(e, low, "right"), None if high is None else np.searchsorted(e, high, "right")) for e in (self.a_end, self.b_end))
        return Span(self.a[i], self.a_end[i], self.b[j], self.b_end[j])


NOTHING = Span(*(np.empty(0, dtype=t) for t in ("<u4", "<i8", "<u4", "<i8")))


def spell(sides: Sides, span: Span, groups: tuple[np.ndarray, np.ndarray], upto: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """The digest's words, in order, of closed groups.

    ``groups`` number the group of each token, ``upto`` tell how many tokens of a side end within a group or before.
    """
    (group_a, group_b), (upto_a, upto_b) = groups, upto
    last_a, last_b = (np.concatenate([g[1:] != g[:-1], [True]]) for g in groups)
    ids = np.empty(len(span.a) + len(span.b), dtype=np.int64)
    # A token of a stands behind those of b in earlier groups, one of b behind those of a up to its own.
    ids[np.arange(len(span.a)) + np.concatenate([[0], upto_b])[group_a]] = span.a + last_a * len(sides.length_a)
    ids[np.arange(len(span.b)) + upto_a[group_b]] = span.b + last_b * len(sides.length_b) + 2 * len(sides.length_a)
    said = sides.said
    return [said[i] for i in ids.tolist()]


def pairs(span: Span) -> tuple[np.ndarray, np.ndarray]:
    """Links of a closed span as ``a << 32 | b``, and the bytes at which they end."""
    ends = np.union1d(span.a_end, span.b_end)
    a, b = span.a[np.searchsorted(span.a_end, ends)], span.b[np.searchsorted(span.b_end, ends)]
    return (a.astype(np.int64) << 32) | b.astype(np.int64), ends


@dataclass
class Fragment:
    """Tokens of a byte range; without a common end all are in the prefix."""

    prefix: Span = field(default_factory=lambda: NOTHING)
    suffix: Span = field(default_factory=lambda: NOTHING)
    cut: bool = False
    groups: int = 0
    said: list[bytes] = field(default_factory=list)
    links: list[np.ndarray] = field(default_factory=list)

    def close(self, sides: Sides, span: Span) -> None:
        common = np.intersect1d(span.a_end, span.b_end, assume_unique=True)
        self.groups += len(common)
        groups = np.searchsorted(common, span.a_end), np.searchsorted(common, span.b_end)
        upto = np.searchsorted(span.a_end, common, "right"), np.searchsorted(span.b_end, common, "right")
        self.said.append(b"".join(spell(sides, span, groups, upto)))
        self.links.append(pairs(span)[0])


def fragment(sides: Sides, span: Span) -> Fragment:
    common = np.intersect1d(span.a_end, span.b_end, assume_unique=True)
    if not len(common):
        return Fragment(prefix=span)
    out = Fragment(span.between(None, common[0]), span.between(common[-1], None), True)
    if len(common) > 1:
        out.close(sides, span.between(common[0], common[-1]))
    return out


def compose(sides: Sides, x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    if not x.cut:
        return Fragment(x.prefix + y.prefix, y.suffix, y.cut, y.groups, y.said, y.links)
    if not y.cut:
        return Fragment(x.prefix, x.suffix + y.prefix, True, x.groups, x.said, x.links)
    out = Fragment(x.prefix, y.suffix, True, x.groups, list(x.said), list(x.links))
    out.close(sides, x.suffix + y.prefix)
    out.groups += y.groups
    out.said += y.said
    out.links += y.links
    return out


DOC = "block long, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
PART = "part int, parts int, cut boolean, said binary, prefix array<binary>, suffix array<binary>"
COLUMNS = [c.split()[0] for c in f"{DOC}, {PART}".split(", ")]


def _spans(span: Span) -> list[bytes]:
    return [p.tobytes() for p in span.parts()]


def _span(parts) -> Span:
    return Span(*(np.frombuffer(p, t) for p, t in zip(parts, ("<u4", "<i8", "<u4", "<i8"), strict=True)))


def _whole(f: Fragment, sides: Sides) -> Fragment:
    """The fragment of a whole text, its prefix closed as well (its last end is common to both sides)."""
    out = Fragment(cut=True)
    out.close(sides, f.prefix)
    out.groups, out.said, out.links = out.groups + f.groups, out.said + f.said, out.links + f.links
    return out


def _closed(f: Fragment) -> tuple[int, str, bytes]:
    said = b"".join(f.said)[:-1]
    return f.groups, hashlib.sha256(said).hexdigest(), np.concatenate(f.links).tobytes()


def _together(sides: Sides, docs: list) -> Iterator[tuple[int, str, np.ndarray]]:
    """Groups, digest and links of some whole texts, found in one go: the end of a text is a common end."""
    offset, a_ends, b_ends, ends = 0, [], [], []
    for a, b in docs:
        a_ends.append(np.cumsum(sides.length_a[a]) + offset)
        b_ends.append(np.cumsum(sides.length_b[b]) + offset)
        offset = int(a_ends[-1][-1])
        ends.append(offset)
    span = Span(np.concatenate([a for a, _ in docs]), np.concatenate(a_ends), np.concatenate([b for _, b in docs]), np.concatenate(b_ends))
    # Marks by byte instead of searches: all ends lie in one range of bytes.
    of_a, of_b = np.zeros(offset + 1, dtype=bool), np.zeros(offset + 1, dtype=bool)
    of_a[span.a_end], of_b[span.b_end] = True, True
    common, every = np.flatnonzero(of_a & of_b), np.flatnonzero(of_a | of_b)
    upto_a, upto_b = np.cumsum(of_a, dtype=np.int32), np.cumsum(of_b, dtype=np.int32)
    links = (span.a[upto_a[every] - of_a[every]].astype(np.int64) << 32) | span.b[upto_b[every] - of_b[every]]
    upto_common = np.cumsum(of_a & of_b, dtype=np.int32)
    groups = tuple(upto_common[e] - (of_a & of_b)[e] for e in (span.a_end, span.b_end))
    said = spell(sides, span, groups, (upto_a[common], upto_b[common]))
    link_stops, group_stops = np.searchsorted(every, ends, "right"), upto_common[ends]
    tokens = np.cumsum([len(a) + len(b) for a, b in docs])
    link_at = group_at = token_at = 0
    for link_stop, group_stop, token_stop in zip(link_stops.tolist(), group_stops.tolist(), tokens.tolist(), strict=True):
        yield group_stop - group_at, hashlib.sha256(b"".join(said[token_at:token_stop])[:-1]).hexdigest(), links[link_at:link_stop]
        link_at, group_at, token_at = link_stop, group_stop, token_stop


def fragments(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """One closed row for each text of one range, one row for each range of longer ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sides = once(f"sides {byte_level} {pieces}", lambda: Sides(byte_level, pieces))
        first = TaskContext.get().partitionId() << 33
        row, block, in_block, rows = first, first, 0, []
        waiting: list[tuple[int, int, object, tuple]] = []
        held = 0
        empty = [b""] * 4

        def settle() -> None:
            if waiting:
                for (name, at, doc_id, (a, b)), (groups, digest, links) in zip(waiting, _together(sides, [w[3] for w in waiting]), strict=True):
                    rows.append((at, name, doc_id, len(a), len(b), groups, len(links), digest, links.tobytes(), 0, 1, True, b"", empty, empty))
                waiting.clear()

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype("object").where(batch["doc_id"].notna(), None), batch["text"], strict=True):
                row += 1
                got = sides.encode(text)
                if got is None:
                    rows.append((block, row, doc_id, 0, 0, 0, 0, "", b"", 0, 1, True, b"", empty, empty))
                    continue
                a, b = got
                size = int(sides.length_a[a].sum())
                if in_block + size > BLOCK:
                    block, in_block = row, 0
                in_block += size
                if size <= RANGE:
                    waiting.append((row, block, doc_id, got))
                    held += size
                    if held > TOGETHER:
                        settle()
                        held = 0
                else:
                    span = Span(a, np.cumsum(sides.length_a[a]), b, np.cumsum(sides.length_b[b]))
                    parts = -(-size // RANGE)
                    for k in range(parts):
                        part = span.between(k * RANGE, (k + 1) * RANGE)
                        f = fragment(sides, part)
                        links = np.concatenate([*f.links, np.empty(0, dtype=np.int64)]).tobytes()
                        rows.append((row, row, doc_id, len(part.a), len(part.b), f.groups, 0, "", links, k, parts, f.cut, b"".join(f.said), _spans(f.prefix), _spans(f.suffix)))
                if len(rows) > 512:
                    yield pd.DataFrame(rows, columns=COLUMNS)
                    rows.clear()
        settle()
        yield pd.DataFrame(rows, columns=COLUMNS)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, f"{DOC}, {PART}")


def folded(parts: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """The texts of ``parts``, whole: each round composes up to ``FAN`` neighbouring ranges of every text still in parts."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        sides = once(f"sides {byte_level} {pieces}", lambda: Sides(byte_level, pieces))
        group = group.sort_values("part")
        out = None
        for r in group.itertuples():
            f = Fragment(_span(r.prefix), _span(r.suffix), r.cut, r.n_groups, [r.said], [np.frombuffer(r.links, "<i8")])
            out = f if out is None else compose(sides, out, f)
        r, parts = group.iloc[0], -(-int(group["parts"].iloc[0]) // FAN)
        counts = [int(group[c].sum()) for c in ("n_a", "n_b")]
        if parts == 1:
            groups, digest, links = _closed(_whole(out, sides))
            row = (r["block"], r["row"], r["doc_id"], *counts, groups, len(links) // 8, digest, links, 0, 1, True, b"", [b""] * 4, [b""] * 4)
        else:
            links = np.concatenate(out.links).tobytes() if out.links else b""
            row = (r["block"], r["row"], r["doc_id"], *counts, out.groups, 0, "", links, r["part"] // FAN, parts, out.cut, b"".join(out.said), _spans(out.prefix), _spans(out.suffix))
        one = pd.DataFrame([row], columns=COLUMNS)
        one["doc_id"] = one["doc_id"].astype("Int64")
        return one

    most = parts.agg(F.max("parts")).first()[0] or 1
    closed = parts.where("parts = 1")
    while most > 1:
        nodes = parts.where("parts > 1").groupBy("row", F.floor(F.col("part") / FAN).alias("node"))
        parts = keep(nodes.applyInPandas(run, f"{DOC}, {PART}"), "fragments")
        closed = closed.union(parts.where("parts = 1"))
        most = -(-most // FAN)
    return closed


def align(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row.

    ``byte_level`` and ``pieces`` are paths of a byte-level and a piece vocabulary that every executor can open.
    """
    found = keep(fragments(docs, byte_level, pieces), "fragments")
    columns = [c.split()[0] for c in DOC.split(", ")]
    texts = folded(found, byte_level, pieces).select(*columns)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            links = [np.frombuffer(x.as_buffer(), "<i8") for x in batch.column(1)]
            for block in np.unique(blocks):
                ids, n = np.unique(np.concatenate([links[i] for i in np.flatnonzero(blocks == block)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block)), pa.array(ids), pa.array(n)], ["block", "pair", "n"])

    counts = texts.select("block", "links").where("length(links) > 0").mapInArrow(counted, "block long, pair long, n long")
    counts = keep(counts, "pairs")
    totals = keep(counts.groupBy("pair").agg(F.sum("n").alias("n")), "totals")
    b = F.col("pair").bitwiseAND(F.lit(2**32 - 1)).alias("b")
    best = totals.groupBy(b).agg(F.max("n").alias("most"))
    judged = totals.withColumn("b", b).join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    held = counts.select("block", "pair").distinct().join(judged.hint("shuffle_merge"), "pair")

    def look_up(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("pair")
        ids, n, best = (known[c].to_numpy() for c in ("pair", "n", "best"))
        sums, bests = [], []
        for links in docs["links"]:
            at = np.searchsorted(ids, np.frombuffer(links, "<i8"))
            sums.append(int(n[at].sum()) if len(at) else 0)
            bests.append(int(best[at].sum()) if len(at) else 0)
        out = docs[["doc_id", "n_a", "n_b", "n_groups", "n_links"]].assign(n_best=bests, count_sum=sums, groups_sha256=docs["groups_sha256"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return texts.groupBy("block").cogroup(held.groupBy("block")).applyInPandas(
        look_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
