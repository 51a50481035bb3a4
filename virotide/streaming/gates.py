"""File-source streams of samples that arrive file by file.

Batch is the contract; a stream runs the same operators on whole samples. The rows of each file are
stored first, by sample and source file; then the samples that a micro-batch touched are computed from
all their stored rows. How files fall into micro-batches does not change the result, and a file that
comes again replaces its own rows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

FILE = "_file"


def sample_stream(spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files of a landing folder as a stream; ``_file`` names the source file of each row."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return rows.withColumn(FILE, F.md5(F.col("_metadata.file_name").cast("binary")))


def run_per_batch(
    stream: DataFrame, operator: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, store: str | None = None
) -> StreamingQuery:
    """Apply a batch operator to the whole samples that each micro-batch adds to.

    ``store`` (by default beside the target) keeps the rows by sample and file. Both writes overwrite
    only the partitions they hold, so a batch that runs again after a failure gives the same result.
    """
    rows_path = store or f"{target.rstrip('/')}_rows"

    def write(batch: DataFrame, _epoch: int) -> None:
        def overwrite(rows: DataFrame, path: str, *keys: str) -> None:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)

        spark = batch.sparkSession
        overwrite(batch, rows_path, "sample", FILE)
        stored = spark.read.schema(batch.schema).parquet(rows_path)
        touched = stored.join(batch.select("sample").distinct(), "sample", "left_semi")
        overwrite(operator(touched.drop(FILE)), target, "sample")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
