"""Session settings, and the checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "virotide", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators were planned for.

    AQE handles post-shuffle coalescing and splits skewed join partitions; ``forceOptimizeSkewedJoin``
    lets it do so even where the split costs one more exchange.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for ``checkpoint()``: the one the cluster names, else (tests) a fresh scratch folder."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="virotide-checkpoint-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so that later stages do not recompute it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
