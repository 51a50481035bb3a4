"""Chat formatting of reply trees.

Messages name their parent. Self-joins that double their reach each round give every message its depth and
the score of the path above it, and then, from the chosen leaves back to the root, every path's messages;
the rounds are logarithmic in the depth. Branches are ranked by mean score (ties: the smaller leaf), and
each chosen path becomes one conversation with a loss mask over the assistant's texts.

Template, per turn: ``<turn>role``, newline, text, ``</turn>``, newline. Inside roles and texts a backslash
goes before every backslash and before ``<turn>`` and ``</turn>``; a line break in a role is ``\\n``.

Defined cases: null roles and texts are empty; messages whose parent is missing are roots; repeated ids in a
tree are folded into the smallest (role, text); an empty table gives no conversations; columns other than the
six named ones are ignored. A message on a cycle has no root and is left out. A message without a ``msg_id`` cannot be
placed in its tree and is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from virotide.llm.common import keep

OPEN, CLOSE = "<turn>", "</turn>"
CONTROL = re.compile(r"\\|</?turn>")
MASKED_ROLE = "assistant"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the spans (code points) of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{OPEN}{escape(role).replace(chr(10), chr(92) + 'n')}\n"
        body = escape(text)
        parts += [head, body, f"{CLOSE}\n"]
        if role == MASKED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(parts), spans


_TURN = re.compile(r"<turn>((?:\\.|[^\\\n])*)\n((?:\\.|[^\\<]|<(?!/turn>))*)</turn>\n", re.DOTALL)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], found[1], flags=re.DOTALL)
        turns.append((role, unescape(found[2])))
        at = found.end()
    return turns


def chain(rows: DataFrame) -> DataFrame:
    """Rows by turn ``(conv_id, turn, role, text)`` as one-branch trees; equal turns are ordered by role and text."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    numbered = rows.select("conv_id", "turn", "role", "text").withColumn("n", F.row_number().over(order).cast("long"))
    return numbered.select(
        F.col("conv_id").alias("tree_id"), F.col("n").alias("msg_id"), F.when(F.col("n") > 1, F.col("n") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score")
    )


def paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """``(tree_id, leaf_id, rank, depth, role, text)``: the messages of the best ``branches`` paths of each tree (None: all).

    ``depth`` counts from 1 at the root.
    """
    tree = F.col("tree_id")
    fields = F.struct(F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # A null tree is a tree of its own; the flag keeps it joinable.
    nodes = messages.where("msg_id is not null").groupBy(
        F.coalesce(tree.cast("long"), F.lit(0)).alias("tree"), tree.isNull().alias("no_tree"), F.col("msg_id").cast("long").alias("id")
    ).agg(
        F.min(F.struct(fields.alias("said"), F.col("parent_id").cast("long").alias("parent"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("m")
    )
    nodes = keep(nodes.select("tree", "no_tree", "id", "m.said.role", "m.said.text", "m.parent", "m.score"), "messages")
    key = ["tree", "no_tree"]
    narrow = nodes.select(*key, "id", "parent", "score")
    known = narrow.select(*key, F.col("id").alias("parent"), F.lit(True).alias("known"))
    up = narrow.join(known, [*key, "parent"], "left").select(
        *key, "id", F.when(F.col("known"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("steps"), "score"
    )
    # A node that has reached its root is done; only the others take part in the next round.
    up = keep(up, "jumps")
    opened, done, jumps, reach, most = up.where("up is not null"), [up.where("up is null")], [], 1, narrow.count()
    while reach <= most and opened.limit(1).count():
        jumps.append(opened.select(*key, "id", "up"))
        state = reduce(DataFrame.union, done, opened)
        above = state.select(*key, F.col("id").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"), F.col("score").alias("score2"))
        moved = opened.join(above, [*key, "up"]).select(
            *key, "id", F.col("up2").alias("up"), (F.col("steps") + F.col("steps2")).alias("steps"), (F.col("score") + F.col("score2")).alias("score")
        )
        moved = keep(moved, "jumps")
        opened = moved.where("up is not null")
        done.append(moved.where("up is null"))
        reach *= 2
    up = reduce(DataFrame.union, done)
    parents = narrow.where("parent is not null").select(*key, F.col("parent").alias("id")).distinct()
    leaves = up.join(parents, [*key, "id"], "left_anti")
    best = Window.partitionBy(*key).orderBy((F.col("score") / F.col("steps")).desc(), "id")
    leaves = leaves.withColumn("rank", F.row_number().over(best)) if branches is not None else leaves.withColumn("rank", F.lit(None).cast("int"))
    if branches is not None:
        leaves = leaves.where(F.col("rank") <= branches)
    on_path = leaves.select(*key, F.col("id").alias("leaf_id"), "rank", "id", F.col("steps").alias("depth"))
    for k in reversed(range(len(jumps))):
        higher = on_path.join(jumps[k], [*key, "id"]).select(*key, "leaf_id", "rank", F.col("up").alias("id"), (F.col("depth") - (1 << k)).alias("depth"))
        on_path = keep(on_path.union(higher), "paths")
    out = on_path.join(nodes.select(*key, "id", "role", "text"), [*key, "id"])
    return out.select(F.when(~F.col("no_tree"), F.col("tree")).alias("tree_id"), "leaf_id", "rank", "depth", "role", "text")


def conversations(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """``(tree_id, leaf_id, rank, formatted, loss_spans)``: one formatted conversation per chosen path.

    ``loss_spans`` are start and end, in code points of ``formatted``, of each text under the loss mask.
    """
    turns = F.array_sort(F.collect_list(F.struct("depth", "role", "text"))).alias("turns")
    grouped = paths(messages, branches).groupBy("tree_id", "leaf_id", "rank").agg(turns)

    @F.pandas_udf("formatted string, loss_spans array<struct<start: long, end: long>>")
    def formatted(column: pd.Series) -> pd.DataFrame:
        rows = [render([(t["role"], t["text"]) for t in turns]) for turns in column]
        return pd.DataFrame({"formatted": [r[0] for r in rows], "loss_spans": [[{"start": a, "end": b} for a, b in r[1]] for r in rows]})

    return grouped.select("tree_id", "leaf_id", "rank", formatted("turns").alias("f")).select("tree_id", "leaf_id", "rank", "f.formatted", "f.loss_spans")


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the output finds: turns, and the text under the loss mask, unescaped."""
    import hashlib

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv_id, text, spans in zip(batch["tree_id"], batch["formatted"], batch["loss_spans"], strict=True):
                turns = read_back(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                masked = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                sha = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (said, masked)]
                rows.append((None if pd.isna(conv_id) else int(conv_id), len(turns), sha[0], len(masked), sha[1], len(text)))
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return formatted.select("tree_id", "formatted", "loss_spans").mapInPandas(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
