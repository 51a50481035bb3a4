"""Sinks. Files are written by range partitions in order, never through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOM = "\ufeff"


def _text(column: str, null: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(null))


def quoted(value: Column, sep: str) -> Column:
    """Cell text, quoted where it holds the separator, a quote or a line break."""
    return F.when(
        value.rlike(f'[{sep}"\n\r]'), F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    ).otherwise(value)


def write_delimited(
    df: DataFrame, path: str, order: Sequence[str], sep: str = ",", bom: bool = False, quote: bool = True, null: str = ""
) -> bool:
    """Delimited text with one header line, at the start of the first part file; nothing if empty.

    Rows are range-partitioned by ``order``; part files in name order form the table.
    """
    if df.isEmpty():
        return False
    cells = [quoted(_text(c, null), sep) if quote else _text(c, null) for c in df.columns]
    keys = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(order)]
    body = df.select(F.lit(1).alias("_part"), *keys, F.concat_ws(sep, *cells).alias("value"))
    head = (BOM if bom else "") + sep.join(df.columns)
    blank = [F.lit(None).cast(body.schema[f"_k{i}"].dataType).alias(f"_k{i}") for i in range(len(order))]
    header = df.sparkSession.range(1).select(F.lit(0).alias("_part"), *blank, F.lit(head).alias("value"))
    sort = ["_part", *[f"_k{i}" for i in range(len(order))]]
    rows = header.unionByName(body).repartitionByRange(*sort).sortWithinPartitions(*sort)
    rows.select("value").write.mode("overwrite").text(path)
    return True


def write_tsv(df: DataFrame, path: str, order: Sequence[str]) -> bool:
    return write_delimited(df, path, order, sep="\t", quote=False, null="NA")


def write_long_table(df: DataFrame, path: str) -> bool:
    """The long table as CSV with a byte order mark and upper-case column names."""
    renamed = df.select(*[F.col(c).alias({"contig": "CHROM"}.get(c, c.upper())) for c in df.columns])
    return write_delimited(renamed, path, ["SAMPLE", "CHROM", "POS", "REF", "ALT"], bom=True)


def write_metrics(df: DataFrame, path: str) -> bool:
    """Metrics CSV: cells are already printed text, nothing is quoted."""
    named = df.withColumnRenamed("sample", "Sample")
    return write_delimited(named, path, ["Sample"], quote=False, null="NA")


def write_vcf(lines: DataFrame, header: Sequence[str], path: str, compression: str = "gzip") -> None:
    """One folder per sample: header lines, the column line, then the sorted body."""
    titles = F.concat(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"), F.col("sample"))
    head = F.concat(F.array(*[F.lit(h) for h in header]), F.array(titles))
    samples = lines.select("sample").distinct().select("sample", F.posexplode(head).alias("_n", "line"))
    top = samples.select(
        "sample", F.lit("").alias("contig"), F.col("_n").cast("bigint").alias("pos"), F.lit("").alias("ref"), F.lit("").alias("alt"), "line"
    )
    sort = ["sample", "contig", "pos", "ref", "alt"]
    rows = top.unionByName(lines.select(*sort, "line")).repartitionByRange(*sort).sortWithinPartitions(*sort)
    rows.select("sample", F.col("line").alias("value")).write.mode("overwrite").partitionBy("sample").option(
        "compression", compression
    ).text(path)


def write_fasta(chunks: DataFrame, path: str, compression: str = "none") -> None:
    """Chunked sequences as FASTA, one folder per sample, one line per chunk."""
    sort = ["sample", "contig", "chunk"]
    names = chunks.select("sample", "contig").distinct().select(
        "sample", "contig", F.lit(-1).cast("bigint").alias("chunk"), F.concat(F.lit(">"), F.col("sample"), F.lit(" "), F.col("contig")).alias("value")
    )
    body = chunks.filter(F.col("seq") != "").select(*sort, F.col("seq").alias("value"))
    rows = names.unionByName(body).repartitionByRange(*sort).sortWithinPartitions(*sort)
    rows.select("sample", "value").write.mode("overwrite").partitionBy("sample").option("compression", compression).text(path)


def versions(rows: DataFrame) -> DataFrame:
    """Unique, sorted software versions."""
    return rows.distinct().orderBy(*rows.columns)
