"""Queries over variant calls: decoding, filters, codon merging, counts, VCF text."""

from __future__ import annotations

from pyspark.sql import functions as F

from virotide.functions.numbers import float_text, round_half_even
from virotide.operators import codons, variants
from virotide.plans.derived import frame
from virotide.plans.registry import query

ORDER = ("src", "src2")

FISHER = """
list_sum(list_transform(range(ref_dp - ref_rv, least(ref_dp, ref_dp - ref_rv + alt_dp - alt_rv) + 1), lambda x:
  exp(lgamma(ref_dp + 1) + lgamma(alt_dp + 1) + lgamma(ref_dp - ref_rv + alt_dp - alt_rv + 1)
    + lgamma(ref_rv + alt_rv + 1) - lgamma(ref_dp + alt_dp + 1) - lgamma(x + 1) - lgamma(ref_dp - x + 1)
    - lgamma(ref_dp - ref_rv + alt_dp - alt_rv - x + 1)
    - lgamma(alt_dp - (ref_dp - ref_rv + alt_dp - alt_rv - x) + 1))))
""".strip()

DECODED = f"""
decoded AS (
  SELECT sample, contig, pos, src, src2,
    CASE WHEN alt LIKE '-%' THEN ref || substr(alt, 2) ELSE ref END AS ref,
    CASE WHEN alt LIKE '+%' THEN ref || substr(alt, 2) WHEN alt LIKE '-%' THEN ref ELSE alt END AS alt,
    CASE WHEN alt LIKE '+%' THEN 'INS' WHEN alt LIKE '-%' THEN 'DEL' ELSE 'SNP' END AS kind,
    ref_dp, ref_rv, ref_qual, alt_dp, alt_rv, alt_qual, alt_freq, total_dp AS dp, ref_codon, alt_codon,
    CASE WHEN "pass" AND alt_qual >= 20 {{strand_and}} THEN 'PASS'
      ELSE concat_ws(';', CASE WHEN NOT "pass" THEN 'ft' END, {{strand_label}}
        CASE WHEN alt_qual < 20 THEN 'bq' END) END AS "filter"
  FROM calls)
"""


def decoded_sql(strand: bool) -> str:
    return DECODED.format(
        strand_and=f"AND NOT ({FISHER} < 0.05)" if strand else "",
        strand_label=f"CASE WHEN {FISHER} < 0.05 THEN 'sb' END," if strand else "",
    )


UNIQUE = """
uniq AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sample, contig, pos, ref, alt ORDER BY src, src2) AS rn FROM decoded)
  WHERE rn = 1)
"""

RUNS = """
steps AS (
  SELECT *, pos - lag(pos) OVER w AS d1, lead(pos) OVER w - pos AS d2 FROM uniq
  WHERE kind = 'SNP' AND "filter" = 'PASS' AND ref_codon IS NOT NULL AND alt_codon IS NOT NULL
  WINDOW w AS (PARTITION BY sample, contig ORDER BY pos, src, src2)),
runs AS (
  SELECT *, sum(CASE WHEN d1 <= 1 THEN 0 ELSE 1 END) OVER (
    PARTITION BY sample, contig ORDER BY pos, src, src2) AS run_no
  FROM steps WHERE d1 <= 1 OR d2 <= 1)
"""

GROUPS = """
near AS (
  SELECT *, pos - lag(pos) OVER w AS e1, lead(pos) OVER w - pos AS e2 FROM runs
  WINDOW w AS (PARTITION BY sample, contig, run_no, ref_codon ORDER BY pos, src, src2)),
wide AS (
  SELECT *, min(pos) OVER g AS lo, max(pos) OVER g AS hi FROM near WHERE e1 <= 1 OR e2 <= 1
  WINDOW g AS (PARTITION BY sample, contig, run_no, ref_codon)),
indexed AS (
  SELECT *, CASE WHEN substr(ref_codon, 1, 1) <> substr(alt_codon, 1, 1) THEN 0
                 WHEN substr(ref_codon, 2, 1) <> substr(alt_codon, 2, 1) THEN 1 ELSE 2 END AS idx
  FROM wide WHERE lo < hi AND
    CAST(substr(ref_codon, 1, 1) <> substr(alt_codon, 1, 1) AS INT)
    + CAST(substr(ref_codon, 2, 1) <> substr(alt_codon, 2, 1) AS INT)
    + CAST(substr(ref_codon, 3, 1) <> substr(alt_codon, 3, 1) AS INT) = 1),
falls AS (
  SELECT *, CASE WHEN idx < lag(idx) OVER w THEN 1 ELSE 0 END AS fall FROM indexed
  WINDOW w AS (PARTITION BY sample, contig, run_no, ref_codon ORDER BY pos, src, src2)),
parts AS (
  SELECT *, sum(fall) OVER (PARTITION BY sample, contig, run_no, ref_codon ORDER BY pos, src, src2
    ROWS UNBOUNDED PRECEDING) AS part FROM falls),
grp AS (
  SELECT *, dense_rank() OVER (PARTITION BY sample, contig, run_no, ref_codon, part ORDER BY pos) AS lvl,
    min(pos) OVER q AS g_lo, max(pos) OVER q AS g_hi
  FROM parts WINDOW q AS (PARTITION BY sample, contig, run_no, ref_codon, part))
"""

PATHS = """
walk AS (
  SELECT sample, contig, run_no, ref_codon, part, lvl, pos AS at, pos, ref, alt, "filter", kind, dp, ref_dp,
    [CAST(alt_freq AS VARCHAR)] AS afs, [CAST(alt_dp AS VARCHAR)] AS dps, alt_freq > 0.75 AS high, false AS adj
  FROM grp WHERE lvl = 1
  UNION ALL
  SELECT w.sample, w.contig, w.run_no, w.ref_codon, w.part, g.lvl, g.pos, w.pos, w.ref || g.ref, w.alt || g.alt,
    w."filter", w.kind, w.dp, w.ref_dp,
    list_append(w.afs, CAST(g.alt_freq AS VARCHAR)), list_append(w.dps, CAST(g.alt_dp AS VARCHAR)),
    w.high AND g.alt_freq > 0.75, w.adj OR g.pos - w.at <= 1
  FROM walk w JOIN grp g ON g.sample = w.sample AND g.contig = w.contig AND g.run_no = w.run_no
    AND g.ref_codon = w.ref_codon AND g.part = w.part AND g.lvl = w.lvl + 1),
done AS (
  SELECT w.* FROM walk w JOIN (SELECT DISTINCT sample, contig, run_no, ref_codon, part, g_hi FROM grp WHERE g_lo < g_hi) h
    USING (sample, contig, run_no, ref_codon, part) WHERE w.at = h.g_hi),
rest AS (
  SELECT u.* FROM uniq u WHERE NOT EXISTS (
    SELECT 1 FROM grp g WHERE g.sample = u.sample AND g.contig = u.contig AND g.pos = u.pos
      AND g.ref = u.ref AND g.alt = u.alt AND g.lvl IS NOT NULL))
"""

OUT = ("sample", "contig", "pos", "ref", "alt", "filter", "kind", "dp", "ref_dp", "alt_freq", "merged_af", "merged_dp")
PLAIN = 'sample, contig, pos, ref, alt, "filter", kind, dp, ref_dp, alt_freq, NULL AS merged_af, NULL AS merged_dp'
MERGED = (
    'sample, contig, pos, ref, alt, "filter", kind, dp, ref_dp, CAST(list_min(afs) AS DOUBLE) AS alt_freq, '
    "array_to_string(afs, ',') AS merged_af, array_to_string(dps, ',') AS merged_dp"
)


def decoded(spark, sf_dir, strand_test=False):
    calls = frame(spark, sf_dir, "calls")
    return variants.decode_calls(calls, strand_test=strand_test).withColumnRenamed("total_dp", "dp").drop("pass")


@query(
    "variant_decode",
    "WITH " + decoded_sql(False) + 'SELECT sample, contig, pos, ref, alt, kind, "filter", dp, alt_freq FROM decoded',
    inputs=("calls",),
)
def variant_decode(spark, sf_dir):
    """Allele decoding and filter labels without the strand test."""
    rows = decoded(spark, sf_dir)
    return rows.select("sample", "contig", "pos", "ref", "alt", "kind", "filter", "dp", "alt_freq")


@query(
    "variant_strand_filter",
    "WITH "
    + decoded_sql(True)
    + 'SELECT sample, "filter", count(*) AS n, sum(dp) :: BIGINT AS dp FROM decoded GROUP BY ALL',
    inputs=("calls",),
)
def variant_strand_filter(spark, sf_dir):
    """Labels with the one-sided Fisher test, counted per sample."""
    rows = decoded(spark, sf_dir, strand_test=True)
    return rows.groupBy("sample", "filter").agg(F.count(F.lit(1)).alias("n"), F.sum("dp").alias("dp"))


@query(
    "strand_bias_p",
    f"""SELECT sample, contig, pos, src, src2, round(least({FISHER}, 1.0), 6) + 0.0 AS p FROM calls""",
    inputs=("calls",),
)
def strand_bias_p(spark, sf_dir):
    calls = frame(spark, sf_dir, "calls")
    p = F.round(variants.strand_p_value(), 6) + F.lit(0.0)
    return calls.select("sample", "contig", "pos", "src", "src2", p.alias("p"))


@query(
    "variant_first_per_site",
    "WITH " + decoded_sql(False) + "," + UNIQUE + "SELECT sample, contig, pos, ref, alt, src, src2, alt_dp FROM uniq",
    inputs=("calls",),
)
def variant_first_per_site(spark, sf_dir):
    rows = variants.first_per_site(decoded(spark, sf_dir), order=ORDER)
    return rows.select("sample", "contig", "pos", "ref", "alt", "src", "src2", "alt_dp")


@query(
    "codon_adjacent_runs",
    "WITH "
    + decoded_sql(False)
    + ","
    + UNIQUE
    + ","
    + RUNS
    + """SELECT sample, contig, pos, ref, alt,
      min(pos) OVER (PARTITION BY sample, contig, run_no) AS run,
      count(*) OVER (PARTITION BY sample, contig, run_no) AS run_size FROM runs""",
    inputs=("calls",),
)
def codon_adjacent_runs(spark, sf_dir):
    unique = variants.first_per_site(decoded(spark, sf_dir), order=ORDER)
    runs = codons.adjacent_runs(codons.candidates(unique))
    sized = runs.join(codons.run_sizes(runs), ["sample", "contig", "run"])
    return sized.select("sample", "contig", "pos", "ref", "alt", "run", "run_size")


@query(
    "codon_groups",
    "WITH "
    + decoded_sql(False)
    + ","
    + UNIQUE
    + ","
    + RUNS
    + ","
    + GROUPS
    + """SELECT sample, contig, ref_codon, pos, ref, alt, idx, CAST(part AS BIGINT) AS part FROM grp""",
    inputs=("calls",),
)
def codon_groups(spark, sf_dir):
    unique = variants.first_per_site(decoded(spark, sf_dir), order=ORDER)
    groups = codons.codon_groups(codons.adjacent_runs(codons.candidates(unique)), ORDER)
    return groups.select("sample", "contig", "ref_codon", "pos", "ref", "alt", "idx", "part")


@query(
    "codon_merge_all_haplotypes",
    "WITH RECURSIVE "
    + ",".join((decoded_sql(False), UNIQUE, RUNS, GROUPS, PATHS))
    + f"""SELECT DISTINCT {MERGED} FROM done WHERE adj
      UNION SELECT {PLAIN} FROM grp WHERE g_lo = g_hi
      UNION ALL SELECT {PLAIN} FROM rest""",
    inputs=("calls",),
)
def codon_merge_all_haplotypes(spark, sf_dir):
    return codons.merge_all_haplotypes(decoded(spark, sf_dir), ORDER).select(*OUT)


@query(
    "codon_merge_consensus",
    "WITH RECURSIVE "
    + ",".join((decoded_sql(False), UNIQUE, RUNS, GROUPS, PATHS))
    + f"""SELECT DISTINCT {MERGED} FROM done WHERE adj AND high
      UNION SELECT {PLAIN} FROM grp WHERE g_lo = g_hi OR alt_freq <= 0.75
      UNION ALL SELECT {PLAIN} FROM rest""",
    inputs=("calls",),
)
def codon_merge_consensus(spark, sf_dir):
    return codons.merge_consensus(decoded(spark, sf_dir), order=ORDER).select(*OUT)


@query(
    "variant_kind_counts",
    "WITH "
    + decoded_sql(False)
    + """, counts AS (SELECT sample, count(*) FILTER (kind = 'DEL') AS del, count(*) FILTER (kind = 'INS') AS ins,
        count(*) FILTER (kind = 'SNP') AS snp FROM decoded GROUP BY sample),
      cells AS (SELECT sample, unnest(['del', 'ins', 'snp']) AS k,
        unnest([CAST(del AS VARCHAR), CAST(ins AS VARCHAR), CAST(snp AS VARCHAR)]) AS v FROM counts)
      SELECT c.sample, c.del, c.ins, c.snp, any_value(rpad(c.sample, 30, ' ')) || string_agg(
        repeat(' ', CAST(floor((10 - length(v)) / 2) AS INT)) || v
        || repeat(' ', 10 - length(v) - CAST(floor((10 - length(v)) / 2) AS INT)), '' ORDER BY k) AS line
      FROM counts c JOIN cells USING (sample) GROUP BY c.sample, c.del, c.ins, c.snp""",
    inputs=("calls",),
)
def variant_kind_counts(spark, sf_dir):
    counts = variants.kind_counts(decoded(spark, sf_dir))
    return counts.join(variants.kind_count_lines(counts), "sample")


@query(
    "vcf_lines",
    "WITH "
    + decoded_sql(False)
    + """SELECT sample, contig, pos, ref, alt, concat_ws(chr(9), contig, CAST(pos AS VARCHAR), '.', ref, alt, '.', "filter",
        'TYPE=' || kind, 'GT:DP:REF_DP:REF_RV:REF_QUAL:ALT_DP:ALT_RV:ALT_QUAL:ALT_FREQ',
        concat_ws(':', '1', dp, ref_dp, ref_rv, ref_qual, alt_dp, alt_rv, alt_qual, alt_freq)) AS line FROM decoded""",
    inputs=("calls",),
)
def vcf_lines(spark, sf_dir):
    return variants.vcf_lines(decoded(spark, sf_dir))


@query(
    "consensus_variants_ivar",
    "SELECT sample, contig, pos, src, src2, alt_freq FROM calls WHERE alt_freq >= 0.75",
    inputs=("calls",),
)
def consensus_variants_ivar(spark, sf_dir):
    rows = variants.consensus_variants(frame(spark, sf_dir, "calls"), "ivar")
    return rows.select("sample", "contig", "pos", "src", "src2", "alt_freq")


@query(
    "consensus_variants_allele_depth",
    """SELECT sample, contig, pos, src, src2, ref_dp || ',' || alt_dp AS ad, total_dp AS dp FROM calls
       WHERE alt_dp / total_dp >= 0.75""",
    inputs=("calls",),
)
def consensus_variants_allele_depth(spark, sf_dir):
    rows = frame(spark, sf_dir, "calls").withColumn("ad", F.concat_ws(",", "ref_dp", "alt_dp"))
    kept = variants.consensus_variants(rows.withColumnRenamed("total_dp", "dp"), "bcftools")
    return kept.select("sample", "contig", "pos", "src", "src2", "ad", "dp")


@query(
    "variant_split_alleles",
    """WITH multi AS (SELECT sample, contig, pos, ref, string_agg(alt, ',' ORDER BY alt) AS alts,
         string_agg(CAST(adp AS VARCHAR), ',' ORDER BY alt) AS dps, max(rdp) AS rdp
         FROM (SELECT sample, contig, pos, ref, alt, max(alt_dp) AS adp, max(ref_dp) AS rdp FROM calls
               GROUP BY ALL) GROUP BY sample, contig, pos, ref),
       ex AS (SELECT *, unnest(range(len(string_split(alts, ',')))) AS i FROM multi)
       SELECT sample, contig, pos, ref, string_split(alts, ',')[i + 1] AS alt, CAST(i AS INT) AS alt_index,
         string_split(dps, ',')[i + 1] AS ac, rdp || ',' || string_split(dps, ',')[i + 1] AS ad FROM ex""",
    inputs=("calls",),
)
def variant_split_alleles(spark, sf_dir):
    calls = frame(spark, sf_dir, "calls").groupBy("sample", "contig", "pos", "ref", "alt").agg(
        F.max("alt_dp").alias("adp"), F.max("ref_dp").alias("rdp")
    )
    # Alleles of one site: at most the alphabet of changes of one position.
    pairs = F.array_sort(F.collect_list(F.struct("alt", "adp")))
    multi = calls.groupBy("sample", "contig", "pos", "ref").agg(pairs.alias("p"), F.max("rdp").alias("rdp"))
    rows = multi.select(
        "sample", "contig", "pos", "ref",
        F.array_join(F.transform("p", lambda x: x["alt"]), ",").alias("alt"),
        F.array_join(F.transform("p", lambda x: x["adp"].cast("string")), ",").alias("ac"),
        F.concat_ws(",", F.col("rdp").cast("string"), F.array_join(F.transform("p", lambda x: x["adp"].cast("string")), ",")).alias("ad"),
    )
    return variants.split_alleles(rows, per_alt=("ac",), per_allele=("ad",))


@query(
    "variant_query_fields",
    """SELECT sample, contig, pos, src, src2, CAST(total_dp AS VARCHAR) AS dp, CAST(alt_dp AS VARCHAR) AS alt_dp,
         CAST(alt_freq AS VARCHAR) AS alt_freq, CAST(NULL AS VARCHAR) AS merged_dp,
         CASE WHEN alt LIKE '+%' THEN 'INS' WHEN alt LIKE '-%' THEN 'DEL' ELSE 'SNP' END AS kind FROM calls""",
    inputs=("calls",),
)
def variant_query_fields(spark, sf_dir):
    """Named values out of FORMAT / sample text and INFO text."""
    calls = variants.decode_calls(frame(spark, sf_dir, "calls"), strand_test=False).withColumnRenamed("total_dp", "dp")
    text = calls.select(
        "sample", "contig", "pos", "src", "src2",
        F.lit(":".join(variants.FORMAT_FIELDS)).alias("format"), variants.payload().alias("payload"),
        F.concat(F.lit("NS=1;TYPE="), F.col("kind")).alias("info"),
    )
    names = ("DP", "ALT_DP", "ALT_FREQ", "MERGED_DP")
    return text.select(
        "sample", "contig", "pos", "src", "src2",
        *[variants.format_field(n).alias(n.lower()) for n in names], variants.info_field("TYPE").alias("kind"),
    )


@query(
    "variant_stats",
    "WITH "
    + decoded_sql(False)
    + """SELECT sample, count(*) AS number_of_records,
        count(*) FILTER (length(ref) = 1 AND length(alt) = 1) AS number_of_snps,
        count(*) FILTER (length(ref) > 1 AND length(alt) = length(ref)) AS number_of_mnps,
        count(*) FILTER (length(ref) <> length(alt)) AS number_of_indels,
        CAST(0 AS BIGINT) AS number_of_multiallelic_sites,
        count(*) FILTER (ref || alt IN ('AG', 'GA', 'CT', 'TC')) AS ts,
        count(*) FILTER (length(ref) = 1 AND length(alt) = 1 AND ref || alt NOT IN ('AG', 'GA', 'CT', 'TC')) AS tv
      FROM decoded GROUP BY sample""",
    inputs=("calls",),
)
def variant_stats(spark, sf_dir):
    return variants.variant_stats(decoded(spark, sf_dir))


@query(
    "variant_unique_adjacent",
    """WITH v AS (SELECT user_id AS sample, event_type AS contig, cast(floor(value / 4) as bigint) AS pos, event_id * 3 AS src
                  FROM events)
       SELECT 'all' AS sample, contig, pos, src FROM (
         SELECT *, lag(contig) OVER w AS c, lag(pos) OVER w AS p FROM v WINDOW w AS (ORDER BY src))
       WHERE c IS NULL OR NOT (c = contig AND p = pos)""",
)
def variant_unique_adjacent(spark, sf_dir):
    """Records equal to the record on the line before leave; line numbers have gaps, as the readers' have."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.select(
        F.lit("all").alias("sample"), F.col("event_type").alias("contig"),
        F.floor(F.col("value") / 4).alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"),
        (F.col("event_id") * 3).alias("src"),
    )
    return variants.unique_adjacent(rows).select("sample", "contig", "pos", "src")


@query(
    "variant_sort_rank",
    """SELECT contig, pos, count(*) AS n, min(src) AS first_src FROM calls GROUP BY contig, pos ORDER BY contig, pos""",
    inputs=("calls",),
)
def variant_sort_rank(spark, sf_dir):
    """Coordinate-sorted site list."""
    sites = frame(spark, sf_dir, "calls").groupBy("contig", "pos").agg(
        F.count(F.lit(1)).alias("n"), F.min("src").alias("first_src")
    )
    return sites.orderBy("contig", "pos")


@query(
    "allele_frequency_rounding",
    """SELECT sample, contig, pos, src, src2, round_even(alt_dp / total_dp, 2) AS af,
         CAST(round_even(alt_dp / total_dp, 3) AS VARCHAR) AS af_text FROM calls""",
    inputs=("calls",),
)
def allele_frequency_rounding(spark, sf_dir):
    calls = frame(spark, sf_dir, "calls")
    share = F.col("alt_dp") / F.col("total_dp")
    return calls.select(
        "sample", "contig", "pos", "src", "src2", round_half_even(share, 2).alias("af"),
        float_text(round_half_even(share, 3)).alias("af_text"),
    )
