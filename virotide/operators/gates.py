"""Sample gates and barcode reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virotide.operators.channels import branch, match_all

MIN_MAPPED_READS = 1000
MIN_BARCODE_READS = 100
MIN_POOLED_READS = 10


def count_gate(df: DataFrame, count: str, minimum: int, equal_passes: bool | None = None) -> DataFrame:
    """``pass`` above and ``fail`` below the threshold. A count equal to it is in neither branch."""
    value = F.col(count)
    rules = {"pass": value > minimum, "fail": value < minimum}
    if equal_passes is not None:
        rules["pass" if equal_passes else "fail"] = (value >= minimum) if equal_passes else (value <= minimum)
    return branch(df, rules, "gate")


def strict_gate(df: DataFrame, count: str, minimum: int) -> DataFrame:
    """``pass`` above the threshold and ``fail`` otherwise (mapped reads, trimmed reads, variants)."""
    return df.withColumn("gate", F.when(F.col(count) > minimum, "pass").otherwise("fail"))


def fail_table(gated: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Fail rows under the report's column names."""
    failed = gated.filter(F.col("gate") == "fail")
    return failed.select(*[F.col(source).alias(name) for source, name in columns.items()])


def trimmed_reads(json_text: Column, stage: str = "after_filtering") -> Column:
    """Read count in a trimming report; 0 if the report lacks it."""
    found = F.get_json_object(json_text, f"$.summary.{stage}.total_reads")
    return F.coalesce(found.try_cast("bigint"), F.lit(0).cast("bigint"))


def with_all(counts: DataFrame, samples: DataFrame | None, keys: Sequence[str], count: str) -> DataFrame:
    """``counts`` with a zero for each listed key that has none."""
    if samples is None:
        return counts
    return samples.select(*keys).distinct().join(counts, list(keys), "left").fillna(0, [count])


def _last_hit(lines: DataFrame, keys: Sequence[str], hit: Column, value: Column, order: str, out: str) -> DataFrame:
    """Value of each text's last line that is a hit; 0 without one, so that the sample can fail its gate."""
    last = F.max_by(value, F.when(hit, F.col(order)))
    return lines.groupBy(*keys).agg(F.coalesce(last, F.lit(0)).cast("bigint").alias(out))


def mapped_reads(
    lines: DataFrame, keys: Sequence[str] = ("sample",), order: str = "src", samples: DataFrame | None = None
) -> DataFrame:
    """Mapped reads of each flagstat text: first token of the *last* line with `` mapped (``, else 0.

    ``samples`` lists samples that count as 0 even without a text.
    """
    hit = F.col("line").contains(" mapped (")
    token = F.get(F.split(F.ltrim("line"), r"\s+"), F.lit(0)).try_cast("bigint")
    return with_all(_last_hit(lines, keys, hit, token, order, "mapped"), samples, keys, "mapped")


def record_count(
    lines: DataFrame, keys: Sequence[str] = ("sample",), order: str = "src", samples: DataFrame | None = None
) -> DataFrame:
    """Number of records in each variant statistics text, from its last such line, else 0."""
    found = F.regexp_extract("line", r"SN\s*0\s*number of records:\s*(\d+)", 1)
    return with_all(_last_hit(lines, keys, found != "", found.try_cast("bigint"), order, "records"), samples, keys, "records")


def reconcile_barcodes(
    sheet: DataFrame, folders: DataFrame, min_reads: int = MIN_BARCODE_READS
) -> DataFrame:
    """Sheet (barcode, sample) against folders (barcode, count), with the outcome per barcode.

    ``no_sample``: folder only, with at least ``min_reads``. ``no_barcode``: sheet only. ``both``.
    Folders below the threshold without a sample are dropped.
    """
    joined = match_all(
        sheet.withColumn("_sheet", F.lit(True)), folders.withColumn("_folder", F.lit(True)), ["barcode"]
    )
    in_sheet, in_folder = F.col("_sheet").isNotNull(), F.col("_folder").isNotNull()
    rules = {
        "both": in_sheet & in_folder,
        "no_barcode": in_sheet & ~in_folder,
        "no_sample": ~in_sheet & (F.col("count") >= min_reads),
    }
    return branch(joined, rules, "outcome").drop("_sheet", "_folder")


def endedness(manifest: DataFrame) -> DataFrame:
    """Runs per sample and whether all of them have the same endedness (min = max, no lists)."""
    ends = F.col("single_end").cast("int")
    return manifest.groupBy("sample").agg(
        F.count(F.lit(1)).alias("runs"),
        (F.min(ends) == F.max(ends)).alias("consistent"),
        F.min("single_end").alias("single_end"),
    )


def nonempty_contigs(contigs: DataFrame, min_length: int = 1, samples: DataFrame | None = None) -> DataFrame:
    """Assemblies with any contig, by summed length; listed samples without one have 0 bases."""
    totals = contigs.groupBy("sample").agg(F.sum(F.length("seq")).alias("bases"))
    totals = with_all(totals, samples, ["sample"], "bases")
    return strict_gate(totals, "bases", min_length - 1)
