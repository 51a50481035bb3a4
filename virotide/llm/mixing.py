"""Mixing sources to target weights by Poisson replication, in DataFrame functions alone.

A document of a source with target repetition rate r appears as often as a Poisson variable of mean r says,
drawn by inverting its distribution at uniform numbers hashed from a seed and the document's id. The copies
are exploded and the whole is ordered by a hash: a global shuffle.

Defined cases: a null source is a source of its own; a null text counts zero characters; rows that repeat an
id draw the same number; sources with a target of zero vanish, sources without a target too if targets are
given; sources without a character draw zero copies; an empty table stays empty; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from virotide.llm.common import keep

#: A larger mean is split into equal parts, each drawn on its own: sums of Poisson variables are Poisson.
LARGEST_MEAN = 8.0
#: Terms of the distribution of a mean of 8 or less; the rest has a probability below 1e-30.
TERMS = 64
SALTS = 16


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, hashed from the seed and the parts."""
    text = F.concat_ws(":", F.lit(f"mix{seed}"), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(docs: DataFrame, targets: dict[str, float] | None = None, epochs: float = 1.0, exponent: float = 0.7) -> DataFrame:
    """``(source, rate)``: how often each document of a source should appear on average.

    The result holds about ``epochs`` times the input's characters, shared out by ``targets`` or, without
    them, by the sources' sizes raised to ``exponent``.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("size"))
    everything = Window.partitionBy(F.lit(1))  # one row for each source
    if targets is None:
        weighted = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(exponent)))
    else:
        pairs = docs.sparkSession.createDataFrame(list(targets.items()), "target string, weight double")
        weighted = sizes.join(pairs, sizes.source.eqNullSafe(pairs.target), "left").select("source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    share = F.col("weight") / F.nullif(F.sum("weight").over(everything), F.lit(0.0))
    rate = share * F.sum("size").over(everything) * F.lit(float(epochs)) / F.nullif(F.col("size"), F.lit(0))
    return weighted.select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def _with_distribution(table: DataFrame) -> DataFrame:
    """Adds the number of draws for a source and the distribution function of one draw at 0, 1, 2, ..."""
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_MEAN)).cast("int")
    rows = table.withColumn("draws", draws).withColumn("mean", F.col("rate") / F.col("draws"))
    first = F.struct(F.exp(-F.col("mean")).alias("term"), F.array(F.exp(-F.col("mean"))).alias("sums"))
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS - 1)),
        first,
        lambda s, k: F.struct(
            (s["term"] * F.col("mean") / k).alias("term"),
            F.concat(s["sums"], F.array(F.element_at(s["sums"], -1) + s["term"] * F.col("mean") / k)).alias("sums"),
        ),
        lambda s: s["sums"],
    )
    return rows.withColumn("sums", steps).drop("mean")


def replicate(docs: DataFrame, targets: dict[str, float] | None = None, epochs: float = 1.0, exponent: float = 0.7, seed: int = 7) -> DataFrame:
    """``docs`` with ``n_copies``, ``copy`` (1 to ``n_copies``) and ``place``, ordered by ``place``.

    Columns of these names are replaced.
    """
    own = [c for c in docs.columns if c not in ("n_copies", "copy", "place")]
    table = _with_distribution(rates(docs, targets, epochs, exponent)).select(F.struct("source").alias("_of"), F.struct("draws", "sums").alias("_p"))
    # The rates of a source are copied to a few salts, so that a source with a third of all rows is spread.
    # Written first, their size is known when the join is planned: few sources are broadcast (Spark checks the
    # size), and the texts move only once, for the shuffle; many are joined by source and salt.
    table = keep(table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "rates")
    rows = docs.select(*[F.col(f"`{c}`") for c in own]).withColumn("_of", F.struct("source")).withColumn("_salt", F.pmod(F.hash("doc_id"), F.lit(SALTS)))
    rows = rows.join(table, ["_of", "_salt"])

    def drawn(j: Column) -> Column:
        u = uniform(seed, F.col("doc_id"), j)
        return F.size(F.filter(F.col("_p.sums"), lambda c: c <= u))

    copies = F.aggregate(F.transform(F.sequence(F.lit(1), F.col("_p.draws")), drawn), F.lit(0), lambda a, b: a + b)
    rows = rows.withColumn("n_copies", copies).where("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"place{seed}"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("copy"))), 1, 15), 16, 10).cast("long")
    return rows.withColumn("place", place).drop("_of", "_salt", "_p").orderBy("place")


ORACLE = f"""
WITH sizes AS (SELECT source, sum(coalesce(length(text), 0)) AS size FROM documents GROUP BY source),
weighted AS (SELECT source, size, pow(CAST(size AS DOUBLE), 0.7) AS weight FROM sizes),
rated AS (SELECT source, coalesce(weight / nullif((SELECT sum(weight) FROM weighted), 0)
  * (SELECT sum(size) FROM weighted) / nullif(size, 0), 0) AS rate FROM weighted),
split AS (SELECT source, greatest(1, CAST(ceil(rate / {LARGEST_MEAN}) AS INT)) AS draws,
  rate / greatest(1, CAST(ceil(rate / {LARGEST_MEAN}) AS INT)) AS mean FROM rated),
dist AS (SELECT source, draws, k, sum(exp(-mean) * pow(mean, k) / factorial(CAST(k AS INT))) OVER (PARTITION BY source ORDER BY k) AS c
  FROM split, (SELECT unnest(range(0, 30)) AS k)),
sums AS (SELECT source, draws, list(c ORDER BY k) AS sums FROM dist GROUP BY source, draws),
drawn AS (SELECT d.*, CAST(list_sum(list_transform(range(1, s.draws + 1), lambda j: len(list_filter(s.sums, lambda c:
    c <= CAST(CAST('0x' || substr(md5('mix7:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || CAST(j AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496)))) AS INT) AS n_copies
  FROM documents d JOIN sums s ON d.source IS NOT DISTINCT FROM s.source)
SELECT t.*, CAST('0x' || substr(md5('place7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(copy AS VARCHAR)), 1, 15) AS BIGINT) AS place
FROM (SELECT *, CAST(unnest(range(1, n_copies + 1)) AS INT) AS copy FROM drawn) t
"""
