"""The variants long table: calls, effects and lineages of all samples in one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virotide.functions.numbers import ratio, round_half_even
from virotide.functions.text import one_letter_protein
from virotide.operators.channels import first_row, last_row, match_all, mix

CALLERS = ("ivar", "bcftools", "artic_minion")
SITE = ("sample", "contig", "pos", "ref", "alt")
EFFECT_LISTS = ("gene", "effect", "hgvs_c", "hgvs_p")
LONG_COLUMNS = (
    "sample", "contig", "pos", "ref", "alt", "filter", "dp", "ref_dp", "alt_dp", "af",
    "gene", "effect", "hgvs_c", "hgvs_p", "hgvs_p_1letter", "caller", "lineage",
)


def with_af(rows: DataFrame) -> DataFrame:
    """``af`` = alt_dp / dp with two digits, half to even."""
    return rows.withColumn("af", round_half_even(ratio(F.col("alt_dp"), F.col("dp")), 2))


def ivar_rows(query: DataFrame) -> DataFrame:
    return with_af(query.withColumns({c: F.col(c).cast("bigint") for c in ("alt_dp", "dp")}))


def allele_depth_rows(query: DataFrame, column: str = "ad") -> DataFrame:
    """Split ``ref,alt`` depths; more than two parts are an error. REF depth stays text."""
    parts = F.split(column, ",")
    checked = F.when(F.size(parts) <= 2, parts).otherwise(
        F.raise_error(F.concat(F.lit("more than two allele depths: "), F.col(column)))
    )
    out = query.withColumns(
        {
            "ref_dp": F.get(checked, F.lit(0)),
            "alt_dp": F.get(checked, F.lit(1)).cast("bigint"),
            "dp": F.col("dp").cast("bigint"),
        }
    )
    return with_af(out).drop(column)


def strand_support_rows(query: DataFrame, column: str = "strand_support") -> DataFrame:
    """Depths from ``forward ref, reverse ref, forward alt, reverse alt`` counts."""
    parts = F.transform(F.split(column, ","), lambda v: v.cast("bigint"))
    ref = F.get(parts, F.lit(0)) + F.get(parts, F.lit(1))
    alt = F.get(parts, F.lit(2)) + F.get(parts, F.lit(3))
    return with_af(query.withColumns({"dp": ref + alt, "ref_dp": ref, "alt_dp": alt})).drop(column)


def caller_rows(query: DataFrame, caller: str) -> DataFrame:
    if caller not in CALLERS:
        raise ValueError(f"unknown caller {caller!r}, expected one of {', '.join(CALLERS)}")
    return ivar_rows(query) if caller == "ivar" else allele_depth_rows(query)


def _neighbouring(effect: Column) -> Column:
    return effect.contains("upstream") | effect.contains("downstream")


def one_effect_per_row(effects: DataFrame, repeat_neighbours: bool = True) -> DataFrame:
    """Parallel comma lists -> one row per effect. Narrow: one generator, no shuffle.

    If all effects are up- or downstream, the first one is emitted, once per list element
    (``repeat_neighbours=False`` emits it once); else those that are neither.
    """
    zipped = F.arrays_zip(*[F.split(c, ",").alias(c) for c in EFFECT_LISTS])
    lists = effects.withColumn("_z", zipped)
    all_near = F.forall("_z", lambda z: _neighbouring(z["effect"]))
    copies = F.size("_z") if repeat_neighbours else F.lit(1)
    kept = F.when(all_near, F.array_repeat(F.get("_z", F.lit(0)), copies)).otherwise(
        F.filter("_z", lambda z: ~_neighbouring(z["effect"]))
    )
    keys = [c for c in effects.columns if c not in EFFECT_LISTS]
    return lists.select(*keys, F.explode(kept).alias("_e")).select(
        *keys, *[F.col(f"_e.{c}").alias(c) for c in EFFECT_LISTS]
    )


def effect_rows(effects: DataFrame, repeat_neighbours: bool = True) -> DataFrame:
    rows = one_effect_per_row(effects, repeat_neighbours)
    return rows.withColumn("hgvs_p_1letter", one_letter_protein(F.col("hgvs_p")))


def lineage_of(table: DataFrame, order: Sequence[str] = ("src",)) -> DataFrame:
    """Lineage in the first row of each sample's file."""
    return first_row(table.select("sample", "lineage", *order), order, ["sample"]).select("sample", "lineage")


def clade_of(table: DataFrame, order: Sequence[str] = ("src",)) -> DataFrame:
    """Clade in the last row of each sample's file; empty reads ``NA``."""
    last = last_row(table.select("sample", "clade", *order), order, ["sample"])
    clade = F.when(F.coalesce("clade", F.lit("")) == "", "NA").otherwise(F.col("clade"))
    return last.select("sample", clade.alias("clade"))


def sample_set_mismatch(variants: DataFrame, effects: DataFrame, lineages: DataFrame | None = None) -> DataFrame:
    """Samples that do not occur in every input; the long table needs this to be empty."""
    inputs = {"variants": variants, "effects": effects}
    if lineages is not None:
        inputs["lineages"] = lineages
    tagged = mix(*[t.select("sample").distinct().withColumn("input", F.lit(n)) for n, t in inputs.items()])
    seen = tagged.groupBy("sample").agg(F.count(F.lit(1)).alias("inputs"))
    return seen.filter(F.col("inputs") < len(inputs))


def long_table(
    query: DataFrame,
    effects: DataFrame,
    caller: str,
    lineages: DataFrame | None = None,
    repeat_neighbours: bool = True,
    order: Sequence[str] = ("src",),
) -> DataFrame:
    """Natural full outer join of calls and effects per sample, plus caller and lineage.

    Effect rows without a call survive with no call columns and, as in the behaviour to match, a NULL
    ``sample`` (``file_sample`` says which sample's file they came from). Samples without any call
    are skipped with all their effects.
    """
    calls = caller_rows(query.drop(*order), caller).withColumn("file_sample", F.col("sample"))
    rows = effect_rows(effects.select(*SITE, *EFFECT_LISTS), repeat_neighbours).withColumnRenamed("sample", "file_sample")
    joined = match_all(calls, rows, ["file_sample", "contig", "pos", "ref", "alt"])
    # One small table of samples says which have calls, and their lineages: sent to all, so that the joined rows stay where
    # they are.
    known = query.select(F.col("sample").alias("file_sample")).distinct()
    if lineages is not None:
        known = known.join(lineage_of(lineages, order).withColumnRenamed("sample", "file_sample"), "file_sample", "left")
    return joined.join(F.broadcast(known), "file_sample").withColumn("caller", F.lit(caller))
