"""Sample sheets, barcode folders and FASTQ file pairing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from virotide.operators.channels import number_within

# The rules of the sample sheet.
SAMPLE_PATTERN = r"^\S+$"
FASTQ_PATTERN = r"^([\S\s]*\/)?[^\s\/]+\.f(ast)?q\.gz$"
BARCODE_FOLDER = r".*barcode[0-9]{1,4}$"
READ1_EXTENSION, READ2_EXTENSION = "_R1_001.fastq.gz", "_R2_001.fastq.gz"
SINGLE_FOLDER_COUNT = 10_000_000


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("mode", "FAILFAST").csv(path)


def sheet_errors(sheet: DataFrame) -> DataFrame:
    """Rows that break a rule, with the reasons. Rules on absent columns do not apply."""

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    rules = [F.when(~F.coalesce(text("sample").rlike(SAMPLE_PATTERN), F.lit(False)), "sample")]
    for name in ("fastq_1", "fastq_2"):
        if name in sheet.columns:
            rules.append(F.when(text(name).isNotNull() & ~text(name).rlike(FASTQ_PATTERN), name))
    if "barcode" in sheet.columns:
        rules.append(F.when(text("barcode").isNotNull() & text("barcode").try_cast("int").isNull(), "barcode"))
    reasons = F.array_compact(F.array(*rules))
    return sheet.withColumn("errors", reasons).filter(F.size("errors") > 0)


def checked_sheet(sheet: DataFrame, error_table: str | None = None) -> DataFrame:
    """The sheet itself; fails if rows break a rule, naming their number and some of them.

    The whole table of errors goes to ``error_table`` (Parquet) if given; `sheet_errors` has it too.
    """
    wrong = sheet_errors(sheet)
    if error_table:
        wrong.write.mode("overwrite").parquet(error_table)
        wrong = sheet.sparkSession.read.parquet(error_table)
    count = wrong.count()
    if count:
        shown = "; ".join(f"{r['sample']} ({', '.join(r['errors'])})" for r in wrong.take(20))
        raise ValueError(f"{count} invalid sample sheet rows, among them: {shown}")
    return sheet


def with_endedness(sheet: DataFrame) -> DataFrame:
    return sheet.withColumn("single_end", F.col("fastq_2").isNull() | (F.col("fastq_2") == ""))


def barcode_name(barcode: Column) -> Column:
    """``barcode%02d``."""
    text = barcode.cast("string")
    return F.concat(F.lit("barcode"), F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text))


def folder_counts(files: DataFrame) -> DataFrame:
    """Reads per barcode folder from per-file line counts ``(path, lines)``."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    named = files.withColumn("dir", folder).filter(F.col("path").contains(".fastq"))
    kept = named.filter(F.col("dir").rlike(BARCODE_FOLDER))
    return kept.groupBy(F.substring_index("dir", "/", -1).alias("barcode"), "dir").agg(
        F.floor(F.sum("lines") / 4).cast("bigint").alias("count")
    )


def scan_folders(spark: SparkSession, root: str) -> DataFrame:
    """Barcode folders under ``root`` with their read counts.

    Lines are counted where they are read; only one row per file leaves a task.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.fastq*").text(root)
    counts = lines.groupBy(F.input_file_name().alias("path")).agg(F.count(F.lit(1)).alias("lines"))
    return folder_counts(counts)


def single_folder(spark: SparkSession, root: str) -> DataFrame:
    """Reads that lie in the root itself: one sample with a count that passes every gate.

    The two names stand in the swapped order of the behaviour to match: barcode holds the sample name.
    """
    return spark.range(1).select(
        F.lit("SAMPLE_1").alias("barcode"), F.lit("single_barcode").alias("sample"), F.lit(root).alias("dir"),
        F.lit(SINGLE_FOLDER_COUNT).cast("bigint").alias("count"),
    )


def sample_of_file(path: Column, extension: str, sanitise: bool = False, delimiter: str = "_", tokens: int = 1) -> Column:
    """Sample name in a file name: without its extension, or its first tokens."""
    name = F.substring_index(path, "/", -1)
    return F.substring_index(name, delimiter, tokens) if sanitise else F.replace(name, F.lit(extension), F.lit(""))


def pair_fastq(
    files: DataFrame,
    read1: str = READ1_EXTENSION,
    read2: str = READ2_EXTENSION,
    single_end: bool = False,
    sanitise: bool = False,
    delimiter: str = "_",
    tokens: int = 1,
) -> DataFrame:
    """Pair R1 and R2 files of a sample by their places in the sorted lists; R2 may be missing."""
    path = F.col("path")

    def side(extension):
        named = files.filter(path.endswith(extension))
        return named.withColumn("sample", sample_of_file(path, extension, sanitise, delimiter, tokens))

    one = side(read1).withColumn("mate", F.lit(1))
    if single_end:
        return one.select("sample", F.col("path").alias("fastq_1"), F.lit("").alias("fastq_2"))
    placed = number_within(one.unionByName(side(read2).withColumn("mate", F.lit(2))), ["sample", "mate"], ["path"])
    first = placed.filter("mate = 1").select("sample", "idx", F.col("path").alias("fastq_1"))
    second = placed.filter("mate = 2").select("sample", "idx", F.col("path").alias("fastq_2"))
    return first.join(second, ["sample", "idx"], "left").fillna("", ["fastq_2"]).drop("idx")
