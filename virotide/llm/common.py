"""Shared small parts: materialised intermediate tables and connected components."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from virotide.session import ensure_checkpoint_dir

#: Internal place of rows without an id: after all others.
NO_ID = 2**63 - 1


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh path in the folder that all executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def keep(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and no executor holds the only copy."""
    path = new_folder(df.sparkSession, kind)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(name: str, make: Callable[[], Any]) -> Any:
    """``make()``, kept for the later tasks of this Python worker. For tables that only save time."""
    kept = sys.__dict__.setdefault("_virotide_kept", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def _fold(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of the edge list ``(u, v)``; the root is the component's smallest node.

    Alternating large-star and small-star steps: each node hangs its larger (smaller) neighbours below its
    smallest one, until all components are stars. Every step is an aggregate and an equi-join; each round
    is written to the shared folder, so a lost executor costs one round at most.
    """
    edges = keep(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before = _fold(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = keep(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = keep(hung.union(low).distinct(), "edges")
        after = _fold(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
