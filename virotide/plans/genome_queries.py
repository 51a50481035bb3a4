"""Queries over intervals, primers, masks, depth, alignments, sequences and reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from virotide.functions.sequence import translate_codon
from virotide.operators import alignments, annotation, composition, consensus, intervals, reads, variants
from virotide.plans.derived import GENOME, frame
from virotide.plans.registry import query, table
from virotide.plans.variant_queries import decoded, decoded_sql

# --- intervals -------------------------------------------------------------------------------------

MERGE = """
seen AS (SELECT *, max("end") OVER (PARTITION BY {keys} ORDER BY "start", "end" DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
  FROM {source}),
lab AS (SELECT *, sum(CASE WHEN m IS NULL OR "start" > m THEN 1 ELSE 0 END) OVER (
  PARTITION BY {keys} ORDER BY "start", "end" DESC ROWS UNBOUNDED PRECEDING) AS g FROM seen),
merged AS (SELECT {keys}, min("start") AS "start", max("end") AS "end" FROM lab GROUP BY {keys}, g)
"""


@query("interval_merge", "WITH " + MERGE.format(keys="sample, contig", source="intervals") + "SELECT * FROM merged", inputs=("intervals",))
def interval_merge(spark, sf_dir):
    return intervals.merge_intervals(frame(spark, sf_dir, "intervals"), ("sample", "contig"))


@query("interval_merge_contig", "WITH " + MERGE.format(keys="contig", source="intervals") + "SELECT * FROM merged", inputs=("intervals",))
def interval_merge_contig(spark, sf_dir):
    """Few, large keys: the tiles carry the work."""
    return intervals.merge_intervals(frame(spark, sf_dir, "intervals"), ("contig",), width=256)


@query(
    "primer_collapse",
    """WITH p AS (SELECT *, regexp_replace(name, '(?:_LEFT|_RIGHT).*', '') AS amp FROM primers)
       SELECT amp AS name, arg_min(contig, src) AS contig, least(min("start"), min("end")) AS "start",
         greatest(max("start"), max("end")) AS "end", arg_min(score, src) AS score, '+' AS strand, min("start") AS first_start
       FROM p GROUP BY amp""",
    inputs=("primers",),
)
def primer_collapse(spark, sf_dir):
    return intervals.collapse_primers(frame(spark, sf_dir, "primers"))


@query(
    "primer_suffix_check",
    "SELECT DISTINCT name FROM primers WHERE name NOT LIKE '%\\_LEFT%' ESCAPE '\\' AND name NOT LIKE '%\\_alt%' ESCAPE '\\'",
    inputs=("primers",),
)
def primer_suffix_check(spark, sf_dir):
    return intervals.primers_without_suffix(frame(spark, sf_dir, "primers"), "_LEFT", "_alt")


@query(
    "primer_fasta_adapters",
    """SELECT contig, CASE WHEN regexp_matches(seq, '^[ACTGactg]+$') THEN 'X' || seq ELSE seq END AS line FROM contigs""",
    inputs=("contigs",),
)
def primer_fasta_adapters(spark, sf_dir):
    rows = frame(spark, sf_dir, "contigs").select("contig", F.col("seq").alias("line"))
    return intervals.primer_fasta_adapters(rows)


LOW = """
low AS (SELECT sample, contig, pos - 1 AS "start", pos AS "end", depth FROM depth WHERE depth < 10)
"""
CLEAN = """
spans AS (SELECT sample, pos, arg_max(length(ref), (src, src2)) AS n FROM decoded WHERE length(ref) <> length(alt) GROUP BY sample, pos),
clean AS (SELECT l.* FROM low l WHERE NOT EXISTS (SELECT 1 FROM spans s WHERE s.sample = l.sample
  AND ((l."start" >= s.pos AND l."start" < s.pos + s.n - 1) OR (l."end" >= s.pos AND l."end" < s.pos + s.n - 1))))
"""


@query("mask_low_coverage", "WITH " + LOW + "SELECT * FROM low", inputs=("depth",))
def mask_low_coverage(spark, sf_dir):
    return intervals.low_coverage(frame(spark, sf_dir, "depth"))


@query("mask_without_indels", "WITH " + ",".join((decoded_sql(False), LOW, CLEAN)) + "SELECT * FROM clean", inputs=("calls", "depth"))
def mask_without_indels(spark, sf_dir):
    mask = intervals.low_coverage(frame(spark, sf_dir, "depth"))
    return intervals.mask_without_indels(mask, decoded(spark, sf_dir), order=("src", "src2"))


@query(
    "mask_merged",
    "WITH " + ",".join((decoded_sql(False), LOW, CLEAN, MERGE.format(keys="sample, contig", source="clean"))) + "SELECT * FROM merged",
    inputs=("calls", "depth"),
)
def mask_merged(spark, sf_dir):
    mask = intervals.low_coverage(frame(spark, sf_dir, "depth"))
    clean = intervals.mask_without_indels(mask, decoded(spark, sf_dir), order=("src", "src2"))
    return intervals.merge_intervals(clean, ("sample", "contig"))


@query(
    "contigs_missing",
    "SELECT DISTINCT contig FROM intervals WHERE contig NOT IN (SELECT CASE WHEN n_name < 'M' THEN 'click' ELSE 'view' END FROM nation)",
    inputs=("intervals",),
)
def contigs_missing(spark, sf_dir):
    known = table(spark, sf_dir, "nation").select(F.when(F.col("n_name") < "M", "click").otherwise("view").alias("contig"))
    return intervals.contigs_missing(frame(spark, sf_dir, "intervals"), known)


REGIONS = """
amp AS (SELECT CAST(floor(p_partkey / 40) AS BIGINT) AS a, max(p_size) AS size FROM part GROUP BY 1),
regions AS (SELECT 'ctg' || substr('ANR', CAST(1 + a % 3 AS INT), 1) AS contig, a * 5 AS "start",
  a * 5 + 1 + CAST(floor(size / 3) AS BIGINT) AS "end", 'reg' || a AS region FROM amp)
"""


def regions(spark, sf_dir):
    """Overlapping amplicons: forty parts each."""
    amplicon = F.floor(F.col("p_partkey") / 40)
    sized = table(spark, sf_dir, "part").groupBy(amplicon.alias("a")).agg(F.max("p_size").alias("size"))
    a = F.col("a")
    return sized.select(
        F.concat(F.lit("ctg"), F.substr(F.lit("ANR"), (a % 3 + 1).cast("int"), F.lit(1))).alias("contig"),
        (a * 5).alias("start"), (a * 5 + 1 + F.floor(F.col("size") / 3)).alias("end"),
        F.concat(F.lit("reg"), a.cast("string")).alias("region"),
    )


@query(
    "region_variant_counts",
    "WITH " + REGIONS + """SELECT r.contig, r.region, count(*) AS n, CAST(sum(alt_dp) AS BIGINT) AS alt_dp FROM calls c
       JOIN regions r ON c.contig = r.contig AND c.pos > r."start" AND c.pos <= r."end" GROUP BY ALL""",
    inputs=("calls",),
)
def region_variant_counts(spark, sf_dir):
    """Points in intervals: calls are counted per position before they meet the regions."""
    calls = frame(spark, sf_dir, "calls").groupBy("contig", "pos").agg(F.count(F.lit(1)).alias("n"), F.sum("alt_dp").alias("alt_dp"))
    spans = regions(spark, sf_dir).withColumn("start", F.col("start") + 1)
    hits = intervals.point_in_interval(calls, spans, ["contig"], "pos", "start", "end")
    return hits.groupBy("contig", "region").agg(F.sum("n").alias("n"), F.sum("alt_dp").alias("alt_dp"))


# --- alignments ------------------------------------------------------------------------------------

SPAN = "CASE WHEN cigar = '3S17M' THEN 17 WHEN cigar = '8M2D12M' THEN 22 WHEN cigar = '10M3I7M' THEN 17 WHEN cigar = '16M4S' THEN 16 ELSE 20 END"


@query(
    "flag_counts",
    """SELECT sample, count(*) AS total, count(*) FILTER (p) AS "primary", count(*) FILTER (flag & 256 = 256) AS secondary,
         count(*) FILTER (flag & 2048 = 2048 AND flag & 256 = 0) AS supplementary, count(*) FILTER (flag & 1024 = 1024) AS duplicates,
         count(*) FILTER (p AND flag & 1024 = 1024) AS primary_duplicates,
         count(*) FILTER (m) AS mapped, count(*) FILTER (p AND m) AS primary_mapped, count(*) FILTER (p AND flag & 1 = 1) AS paired,
         count(*) FILTER (p AND flag & 65 = 65) AS read1, count(*) FILTER (p AND flag & 129 = 129) AS read2,
         count(*) FILTER (p AND m AND flag & 3 = 3) AS properly_paired, count(*) FILTER (p AND m AND flag & 1 = 1 AND flag & 8 = 0) AS both_mapped,
         count(*) FILTER (p AND m AND flag & 9 = 9) AS singletons
       FROM (SELECT *, flag & 2304 = 0 AS p, flag & 4 = 0 AS m FROM reads_aligned) GROUP BY sample""",
    inputs=("reads_aligned",),
)
def flag_counts(spark, sf_dir):
    return alignments.flag_counts(frame(spark, sf_dir, "reads_aligned", "sample", "flag"))


@query(
    "contig_counts",
    """WITH c AS (SELECT DISTINCT contig, CAST(1000 AS BIGINT) AS length FROM reads_aligned UNION SELECT 'ctgX', 1000 UNION SELECT '*', 0),
         r AS (SELECT sample, CASE WHEN flag & 12 = 12 OR mapq = 0 THEN '*' ELSE contig END AS contig, flag FROM reads_aligned),
         s AS (SELECT DISTINCT sample FROM reads_aligned)
       SELECT s.sample, c.contig, c.length, count(*) FILTER (flag & 4 = 0) AS mapped, count(*) FILTER (flag & 4 = 4) AS unmapped
       FROM s CROSS JOIN c LEFT JOIN r ON r.sample = s.sample AND r.contig = c.contig GROUP BY ALL""",
    inputs=("reads_aligned",),
)
def contig_counts(spark, sf_dir):
    """Reads of mapping quality 0 stand for those without a contig."""
    rows = frame(spark, sf_dir, "reads_aligned", "sample", "contig", "flag", "mapq")
    nowhere = alignments.has(alignments.UNMAPPED, alignments.MATE_UNMAPPED) | (F.col("mapq") == 0)
    listed = rows.select("contig").distinct()
    rows = rows.withColumn("contig", F.when(~nowhere, F.col("contig")))
    names = listed.unionByName(spark.range(1).select(F.lit("ctgX").alias("contig")))
    return alignments.contig_counts(rows, names.withColumn("length", F.lit(1000).cast("bigint")))


@query(
    "alignment_stats",
    f"""SELECT sample, count(*) AS raw_total_sequences, count(*) FILTER (flag & 4 = 0) AS reads_mapped, count(*) FILTER (flag & 4 = 4) AS reads_unmapped,
         count(*) FILTER (flag & 1024 = 1024) AS reads_duplicated, count(*) FILTER (flag & 4 = 0 AND mapq = 0) AS reads_mq0,
         CAST(sum(length(seq)) AS BIGINT) AS total_length, CAST(max(length(seq)) AS INT) AS maximum_length,
         CAST(coalesce(sum(CASE WHEN cigar = '3S17M' THEN 17 WHEN cigar = '16M4S' THEN 16 ELSE 20 END) FILTER (flag & 4 = 0), 0) AS BIGINT) AS bases_mapped_cigar,
         CAST(coalesce(sum(CASE WHEN cigar = '10M3I7M' THEN 3 ELSE 0 END) FILTER (flag & 4 = 0), 0) AS BIGINT) AS inserted_bases,
         CAST(coalesce(sum(CASE WHEN cigar = '8M2D12M' THEN 2 ELSE 0 END) FILTER (flag & 4 = 0), 0) AS BIGINT) AS deleted_bases
       FROM reads_aligned WHERE flag & 2304 = 0 GROUP BY sample""",
    inputs=("reads_aligned",),
)
def alignment_stats(spark, sf_dir):
    return alignments.alignment_stats(frame(spark, sf_dir, "reads_aligned"))


@query("reads_mapped_sorted", "SELECT sample, qname, flag, contig, pos FROM reads_aligned WHERE flag & 4 = 0 ORDER BY contig, pos", inputs=("reads_aligned",))
def reads_mapped_sorted(spark, sf_dir):
    kept = alignments.coordinate_sort(alignments.drop_unmapped(frame(spark, sf_dir, "reads_aligned", "sample", "qname", "flag", "contig", "pos")))
    return kept.select("sample", "qname", "flag", "contig", "pos")


USED = f"used AS (SELECT *, {SPAN} AS span FROM reads_aligned WHERE flag & 1796 = 0)"
DEPTHS = USED + """, pd AS (SELECT sample, contig, pos + i AS pos, count(*) AS depth FROM (
  SELECT sample, contig, pos, unnest(range(span)) AS i FROM used) GROUP BY ALL)"""


@query("depth_positions", "WITH " + DEPTHS + "SELECT * FROM pd", inputs=("reads_aligned",))
def depth_positions(spark, sf_dir):
    return alignments.depth_positions(alignments.depth_segments(frame(spark, sf_dir, "reads_aligned", "sample", "contig", "pos", "flag", "cigar"), merged=False))


CONTIG_LENGTH = "SELECT contig, max(pos) + 30 AS length FROM reads_aligned GROUP BY contig"


def contig_lengths(rows):
    return rows.groupBy("contig").agg((F.max("pos") + 30).alias("length"))


@query(
    "depth_zero_filled",
    "WITH " + DEPTHS + f""", c AS ({CONTIG_LENGTH}), s AS (SELECT DISTINCT sample FROM pd),
      f AS (SELECT s.sample, c.contig, unnest(range(1, c.length + 1)) AS pos FROM s CROSS JOIN c)
      SELECT f.sample, f.contig, count(*) AS positions, count(*) FILTER (coalesce(depth, 0) < 3) AS below_3, CAST(sum(coalesce(depth, 0)) AS BIGINT) AS bases
      FROM f LEFT JOIN pd USING (sample, contig, pos) GROUP BY ALL""",
    inputs=("reads_aligned",),
)
def depth_zero_filled(spark, sf_dir):
    """Positions without reads count too."""
    rows = frame(spark, sf_dir, "reads_aligned", "sample", "contig", "pos", "flag", "cigar")
    return alignments.filled_depth(alignments.depth_segments(rows, merged=False), contig_lengths(rows))


@query(
    "depth_windows",
    "WITH " + DEPTHS + f""", c AS ({CONTIG_LENGTH}), s AS (SELECT DISTINCT sample FROM reads_aligned),
      f AS (SELECT s.sample, c.contig, length, unnest(range(CAST(floor((length - 1) / 200) AS BIGINT) + 1)) AS w FROM s CROSS JOIN c),
      g AS (SELECT sample, contig, CAST(floor((pos - 1) / 200) AS BIGINT) AS w, sum(depth) AS bases FROM pd GROUP BY ALL)
      SELECT sample, contig, w * 200 AS "start", least(w * 200 + 200, length) AS "end", coalesce(bases, 0) / (least(w * 200 + 200, length) - w * 200) AS coverage
      FROM f LEFT JOIN g USING (sample, contig, w)""",
    inputs=("reads_aligned",),
)
def depth_windows(spark, sf_dir):
    rows = frame(spark, sf_dir, "reads_aligned", "sample", "contig", "pos", "flag", "cigar")
    return alignments.window_depth(alignments.depth_segments(rows, merged=False), contig_lengths(rows), samples=rows)


@query(
    "depth_regions",
    "WITH " + DEPTHS + "," + REGIONS + """, hit AS (SELECT s.sample, r.* FROM (SELECT DISTINCT sample FROM reads_aligned) s CROSS JOIN regions r),
      f AS (SELECT *, unnest(range("start" + 1, "end" + 1)) AS pos FROM hit)
      SELECT sample, contig, "start", "end", region, median(coalesce(depth, 0)) AS coverage, count(*) AS at_0x,
        count(*) FILTER (depth >= 1) AS at_1x, count(*) FILTER (depth >= 2) AS at_2x FROM f LEFT JOIN pd USING (sample, contig, pos) GROUP BY ALL""",
    inputs=("reads_aligned",),
)
def depth_regions(spark, sf_dir):
    rows = frame(spark, sf_dir, "reads_aligned", "sample", "contig", "pos", "flag", "cigar")
    return alignments.region_depth(alignments.depth_segments(rows, merged=False), regions(spark, sf_dir), (0, 1, 2), samples=rows)


# Aligned bases of the four CIGAR shapes, stated position by position.
BASES = USED + """, b AS (
  SELECT *, unnest(range(20)) AS i FROM used WHERE flag & 4 = 0),
m AS (SELECT sample, contig, flag & 16 = 16 AS rev,
    CASE cigar WHEN '3S17M' THEN CASE WHEN i >= 3 THEN pos + i - 3 END WHEN '16M4S' THEN CASE WHEN i < 16 THEN pos + i END
      WHEN '8M2D12M' THEN CASE WHEN i < 8 THEN pos + i ELSE pos + i + 2 END
      WHEN '10M3I7M' THEN CASE WHEN i < 10 THEN pos + i WHEN i >= 13 THEN pos + i - 3 END ELSE pos + i END AS p,
    substr(seq, CAST(i + 1 AS INT), 1) AS base, ascii(substr(qual, CAST(i + 1 AS INT), 1)) - 33 AS q FROM b
  UNION ALL SELECT sample, contig, flag & 16 = 16, pos + 9, '+' || substr(seq, 11, 3), ascii(substr(qual, 11, 1)) - 33 FROM used WHERE cigar = '10M3I7M'
  UNION ALL SELECT sample, contig, flag & 16 = 16, pos + 8 + d, '*', ascii(substr(qual, 9, 1)) - 33 FROM used, (VALUES (0), (1)) v(d) WHERE cigar = '8M2D12M'),
counts AS (SELECT sample, contig, p AS pos, base, count(*) AS n, count(*) FILTER (rev) AS n_reverse, CAST(sum(q) AS BIGINT) AS quality_sum
  FROM m WHERE p IS NOT NULL GROUP BY ALL)
"""


@query("pileup_counts", "WITH " + BASES + "SELECT * FROM counts", inputs=("reads_aligned",))
def pileup_counts(spark, sf_dir):
    return alignments.pileup_counts(frame(spark, sf_dir, "reads_aligned", "sample", "contig", "pos", "flag", "cigar", "seq", "qual"))


REFERENCE = f"substr('{GENOME}', CAST(1 + pos % {len(GENOME)} AS INT), 1)"


def site_reference(rows):
    """The made-up reference over the span the reads cover."""
    ends = rows.groupBy("contig").agg((F.max("pos") + 30).alias("last"))
    sites = ends.select("contig", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("last"))).alias("pos"))
    base = F.substr(F.lit(GENOME), (F.col("pos") % len(GENOME) + 1).cast("int"), F.lit(1))
    return sites.withColumn("ref", base)


@query(
    "call_variants",
    "WITH " + BASES + f""", dp AS (SELECT sample, contig, pos, CAST(sum(n) AS BIGINT) AS total_dp FROM counts WHERE base NOT LIKE '+%' GROUP BY ALL),
      r AS (SELECT *, {REFERENCE} AS ref FROM counts),
      refs AS (SELECT sample, contig, pos, n AS ref_dp, n_reverse AS ref_rv FROM r WHERE base = ref)
      SELECT r.sample, r.contig, r.pos, r.ref, r.base AS alt, n AS alt_dp, n_reverse AS alt_rv, CAST(floor(quality_sum / n) AS INT) AS alt_qual,
        total_dp, coalesce(ref_dp, 0) AS ref_dp, coalesce(ref_rv, 0) AS ref_rv, n / total_dp AS alt_freq
      FROM r JOIN dp USING (sample, contig, pos) LEFT JOIN refs USING (sample, contig, pos)
      WHERE base <> ref AND base <> '*' AND n / total_dp >= 0.25 AND floor(quality_sum / n) >= 20 AND total_dp >= 3""",
    inputs=("reads_aligned",),
)
def call_variants(spark, sf_dir):
    rows = frame(spark, sf_dir, "reads_aligned", "sample", "contig", "pos", "flag", "cigar", "seq", "qual")
    counts = alignments.pileup_counts(rows, tiles=True)
    return alignments.call_variants(counts, site_reference(rows), min_depth=3).drop("ref_qual")


@query(
    "consensus_from_pileup",
    "WITH " + BASES + """, s AS (SELECT sample, contig, pos, sum(n) FILTER (base NOT LIKE '+%') AS depth,
        arg_max(base, (n, base)) FILTER (base NOT LIKE '+%') AS top, max(n) FILTER (base NOT LIKE '+%') AS top_n,
        arg_max(base, (n, base)) FILTER (base LIKE '+%') AS ins, max(n) FILTER (base LIKE '+%') AS ins_n FROM counts GROUP BY ALL),
      c AS (SELECT sample, contig, pos, CASE WHEN coalesce(depth, 0) < 3 THEN 'N' WHEN top_n / depth >= 0.75 THEN replace(top, '*', '') ELSE 'N' END
          || CASE WHEN depth >= 3 AND ins_n / depth >= 0.75 THEN substr(ins, 2) ELSE '' END AS base FROM s)
      SELECT sample, contig, CAST(floor((pos - 1) / 1000) AS BIGINT) AS chunk, string_agg(base, '' ORDER BY pos) AS seq FROM c GROUP BY ALL""",
    inputs=("reads_aligned",),
)
def consensus_from_pileup(spark, sf_dir):
    counts = alignments.pileup_counts(frame(spark, sf_dir, "reads_aligned", "sample", "contig", "pos", "flag", "cigar", "seq", "qual"), tiles=True)
    bases = consensus.pileup_consensus(counts, min_depth=3)
    return consensus.chunk_text(bases, ["sample", "contig"], "base")


@query(
    "mark_duplicates",
    """WITH s AS (SELECT *, CASE WHEN flag & 2308 = 0 THEN CASE WHEN flag & 16 = 16 THEN pos + CASE cigar WHEN '3S17M' THEN 16 WHEN '16M4S' THEN 19
              WHEN '8M2D12M' THEN 21 WHEN '10M3I7M' THEN 16 ELSE 19 END ELSE pos - CASE WHEN cigar = '3S17M' THEN 3 ELSE 0 END END END AS five,
           CAST(list_sum(list_transform(string_split(qual, ''), lambda c: CASE WHEN ascii(c) - 33 >= 15 THEN ascii(c) - 33 ELSE 0 END)) AS INT) AS score
         FROM reads_aligned),
       k AS (SELECT *, row_number() OVER (PARTITION BY sample, contig, five, flag & 16, mate_pos ORDER BY score DESC, qname, flag) AS rn FROM s)
       SELECT sample, CAST(sum(CASE WHEN five IS NOT NULL AND rn > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicates, count(*) AS n FROM k GROUP BY sample""",
    inputs=("reads_aligned",),
)
def mark_duplicates(spark, sf_dir):
    marked = alignments.mark_duplicates(frame(spark, sf_dir, "reads_aligned"))
    return marked.groupBy("sample").agg(
        F.count(F.when(alignments.has(alignments.DUPLICATE), 1)).alias("duplicates"), F.count(F.lit(1)).alias("n")
    )


@query(
    "insert_size_histogram",
    "SELECT sample, CAST(abs(tlen) AS INT) AS insert_size, count(*) AS pairs FROM reads_aligned WHERE flag & 65 = 65 AND flag & 3340 = 0 AND tlen <> 0 GROUP BY ALL",
    inputs=("reads_aligned",),
)
def insert_size_histogram(spark, sf_dir):
    return alignments.insert_size_histogram(frame(spark, sf_dir, "reads_aligned", "sample", "flag", "tlen"))


@query(
    "base_by_cycle",
    """WITH e AS (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM reads_aligned),
         d AS (SELECT sample, CAST(CASE WHEN flag & 16 = 16 THEN length(seq) - i + 1 ELSE i END AS INT) AS cycle, substr(seq, CAST(i AS INT), 1) AS b,
           ascii(substr(qual, CAST(i AS INT), 1)) - 33 AS q FROM e)
       SELECT sample, cycle, count(*) FILTER (b = 'A') AS a, count(*) FILTER (b = 'C') AS c, count(*) FILTER (b = 'G') AS g, count(*) FILTER (b = 'T') AS t,
         count(*) FILTER (b = 'N') AS n, CAST(sum(q) AS BIGINT) AS quality_sum, count(*) AS total FROM d GROUP BY ALL""",
    inputs=("reads_aligned",),
)
def base_by_cycle(spark, sf_dir):
    return alignments.base_by_cycle(frame(spark, sf_dir, "reads_aligned"))


@query(
    "trim_primers",
    f"""WITH e AS (SELECT *, pos + {SPAN} - 1 AS ref_end, flag & 16 = 16 AS reverse FROM reads_aligned WHERE flag & 4 = 0),
         f AS (SELECT *, CASE WHEN reverse THEN ref_end ELSE pos END AS five FROM e),
         p AS (SELECT DISTINCT 'ctg' || substr('ANR', CAST(1 + p_partkey % 3 AS INT), 1) AS contig, CAST(floor(p_partkey / 8) AS BIGINT) AS "start",
           CAST(floor(p_partkey / 8) AS BIGINT) + 1 + CAST(floor(p_size / 5) AS BIGINT) AS "end", p_size > 25 AS rev FROM part),
         h AS (SELECT f.sample, f.qname, f.flag, max(p."end") AS last, min(p."start" + 1) AS first FROM f
           JOIN p ON f.contig = p.contig AND f.reverse = p.rev AND five > p."start" AND five <= p."end" GROUP BY ALL),
         t AS (SELECT f.*, CASE WHEN NOT reverse AND last IS NOT NULL THEN last + 1 ELSE pos END AS trim_start,
           CASE WHEN reverse AND first IS NOT NULL THEN first - 1 ELSE ref_end END AS trim_end, last IS NOT NULL AS has_primer
           FROM f LEFT JOIN h USING (sample, qname, flag))
       SELECT sample, qname, flag, contig, trim_start, trim_end, has_primer FROM t WHERE trim_end - trim_start + 1 >= 10""",
    inputs=("reads_aligned",),
)
def trim_primers(spark, sf_dir):
    start = F.floor(F.col("p_partkey") / 8).cast("bigint")
    bed = table(spark, sf_dir, "part").select(
        F.concat(F.lit("ctg"), F.substr(F.lit("ANR"), (F.col("p_partkey") % 3 + 1).cast("int"), F.lit(1))).alias("contig"),
        start.alias("start"), (start + 1 + F.floor(F.col("p_size") / 5)).alias("end"),
        F.when(F.col("p_size") > 25, "-").otherwise("+").alias("strand"),
    )
    out = alignments.trim_primers(frame(spark, sf_dir, "reads_aligned", "sample", "qname", "flag", "contig", "pos", "cigar"), bed, min_length=10)
    return out.select("sample", "qname", "flag", "contig", "trim_start", "trim_end", "has_primer")


# --- sequences -------------------------------------------------------------------------------------


@query(
    "base_composition",
    """WITH l AS (SELECT sample, unnest(string_split(seq, '')) AS base FROM sequences WHERE length(seq) > 0),
         k AS (SELECT s.sample, b.base FROM (SELECT DISTINCT sample FROM l) s CROSS JOIN (VALUES ('A'), ('C'), ('T'), ('G'), ('N')) b(base)),
         c AS (SELECT k.sample, k.base, count(l.base) AS freq FROM k LEFT JOIN l ON k.sample = l.sample AND k.base = l.base GROUP BY ALL)
       SELECT sample, CASE WHEN base <> 'N' OR freq > 0 THEN base END AS base, CASE WHEN base <> 'N' OR freq > 0 THEN freq END AS freq,
         CASE WHEN base <> 'N' OR freq > 0 THEN 100 * freq / sum(freq) OVER (PARTITION BY sample) END AS perc,
         CAST(instr('ACTGN', base) AS INT) AS place FROM c""",
    inputs=("sequences",),
)
def base_composition(spark, sf_dir):
    return composition.base_counts(frame(spark, sf_dir, "sequences"))


@query(
    "base_composition_first_record",
    """WITH one AS (SELECT sample, arg_min(seq, length(contig) * 1000000000 + CAST(substr(contig, 2) AS BIGINT)) AS seq FROM sequences GROUP BY sample),
         l AS (SELECT sample, unnest(string_split(seq, '')) AS base FROM one WHERE length(seq) > 0),
         k AS (SELECT s.sample, b.base FROM (SELECT DISTINCT sample FROM l) s CROSS JOIN (VALUES ('A'), ('C'), ('T'), ('G'), ('N')) b(base))
       SELECT k.sample, k.base, count(l.base) AS freq FROM k LEFT JOIN l ON k.sample = l.sample AND k.base = l.base
       GROUP BY ALL HAVING k.base <> 'N' OR count(l.base) > 0""",
    inputs=("sequences",),
)
def base_composition_first_record(spark, sf_dir):
    """Of several records of a sample the first one counts."""
    rows = frame(spark, sf_dir, "sequences").withColumns({"src": F.length("contig"), "src2": F.expr("cast(substring(contig, 2) as bigint)")})
    counts = composition.base_counts(composition.first_record(rows))
    return counts.filter(F.col("base").isNotNull()).select("sample", "base", "freq")


@query(
    "letter_runs",
    """WITH l AS (SELECT contig, unnest(string_split(seq, '')) AS base, unnest(range(1, length(seq) + 1)) AS i FROM sequences),
         n AS (SELECT contig, i, i - row_number() OVER (PARTITION BY contig ORDER BY i) AS g FROM l WHERE base = 'N')
       SELECT contig, CAST(max(i) AS BIGINT) AS "start", CAST(count(*) AS INT) AS width, CAST(min(i) AS BIGINT) AS "first" FROM n GROUP BY contig, g""",
    inputs=("sequences",),
)
def letter_runs(spark, sf_dir):
    return composition.letter_runs(frame(spark, sf_dir, "sequences"), ("contig",))


@query(
    "base_density",
    """WITH l AS (SELECT contig, length(seq) AS len, unnest(string_split(seq, '')) AS b, unnest(range(1, length(seq) + 1)) AS i FROM sequences WHERE length(seq) > 0),
         p AS (SELECT contig, len, i, CASE WHEN i <= 500 THEN 501 WHEN i > len - 500 THEN len - 500 ELSE i END AS c,
           sum(CASE WHEN b = 'A' THEN 1 ELSE 0 END) OVER w AS a, sum(CASE WHEN b = 'C' THEN 1 ELSE 0 END) OVER w AS cc,
           sum(CASE WHEN b = 'T' THEN 1 ELSE 0 END) OVER w AS t, sum(CASE WHEN b = 'G' THEN 1 ELSE 0 END) OVER w AS g
           FROM l WINDOW w AS (PARTITION BY contig ORDER BY i ROWS BETWEEN 500 PRECEDING AND 500 FOLLOWING))
       SELECT p.contig, count(*) AS positions, count(*) FILTER (p.len >= 1001) AS with_mean, max(CASE WHEN p.len >= 1001 THEN q.a / 1001 END) AS a_max,
         min(CASE WHEN p.len >= 1001 THEN q.cc / 1001 END) AS c_min, CAST(sum(CASE WHEN p.len >= 1001 THEN q.t * p.i END) AS BIGINT) AS t_moment,
         CAST(sum(CASE WHEN p.len >= 1001 THEN q.g * p.i END) AS BIGINT) AS g_moment
       FROM p LEFT JOIN p q ON q.contig = p.contig AND q.i = p.c GROUP BY p.contig""",
    inputs=("sequences",),
)
def base_density(spark, sf_dir):
    """Running means of every position, summed up per sequence (extremes and moments)."""
    means = composition.base_density(frame(spark, sf_dir, "sequences"), ("contig",), width=4096)

    def moment(base):
        return F.sum(F.rint(F.col(f"{base}_mean") * 1001).cast("bigint") * F.col("position")).alias(f"{base}_moment")

    return means.groupBy("contig").agg(
        F.count(F.lit(1)).alias("positions"), F.count("a_mean").alias("with_mean"), F.max("a_mean").alias("a_max"),
        F.min("c_mean").alias("c_min"), moment("t"), moment("g"),
    )


@query("contig_sizes", "SELECT contig, length(seq) AS length FROM sequences", inputs=("sequences",))
def contig_sizes(spark, sf_dir):
    return composition.contig_sizes(frame(spark, sf_dir, "sequences"))


@query(
    "assembly_stats",
    """WITH l AS (SELECT *, length(seq) AS len FROM sequences), o AS (SELECT sample, len, sum(len) OVER (PARTITION BY sample ORDER BY len DESC) AS run,
           sum(len) OVER (PARTITION BY sample) AS total FROM l),
         h AS (SELECT sample, max(len) FILTER (run * 2 >= total) AS n50 FROM o GROUP BY sample),
         i AS (SELECT sample, min(rn) AS l50 FROM (SELECT sample, sum(len) OVER w AS run, sum(len) OVER (PARTITION BY sample) AS total,
           row_number() OVER w AS rn FROM l WINDOW w AS (PARTITION BY sample ORDER BY len DESC ROWS UNBOUNDED PRECEDING)) WHERE run * 2 >= total GROUP BY sample)
       SELECT l.sample, count(*) AS contigs, count(*) FILTER (len >= 1000) AS contigs_1000, count(*) FILTER (len >= 5000) AS contigs_5000,
         max(len) AS largest_contig, CAST(sum(len) AS BIGINT) AS total_length, any_value(n50) AS n50, any_value(l50) AS l50,
         100 * sum(len - length(regexp_replace(seq, '[GC]', '', 'g'))) / sum(len - length(regexp_replace(seq, '[ACGT]', '', 'g'))) AS gc_percent,
         100000 * sum(len - length(replace(seq, 'N', ''))) / sum(len) AS ns_per_100kb
       FROM l JOIN h USING (sample) JOIN i USING (sample) GROUP BY l.sample""",
    inputs=("sequences",),
)
def assembly_stats(spark, sf_dir):
    return composition.assembly_stats(frame(spark, sf_dir, "sequences"))


CHUNKS = "chunks AS (SELECT contig, sample, c AS chunk, substr(seq, CAST(c * 1000 + 1 AS INT), 1000) AS seq FROM (SELECT *, unnest(range(CAST(ceil(length(seq) / 1000) AS BIGINT))) AS c FROM sequences))"


def mask_bed(spark, sf_dir):
    """Intervals on the documents' sequences, one per event."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("contig"),
        F.floor(F.col("value") * 40).alias("start"), (F.floor(F.col("value") * 40) + 1 + F.col("event_id") % 60).alias("end"),
    )


@query(
    "mask_fasta",
    """WITH b AS (SELECT DISTINCT 'd' || user_id AS contig, unnest(range(CAST(floor(value * 40) AS BIGINT) + 1, CAST(floor(value * 40) AS BIGINT) + 2 + event_id % 60)) AS i FROM events),
         l AS (SELECT contig, unnest(string_split(seq, '')) AS base, unnest(range(1, length(seq) + 1)) AS i FROM contigs WHERE length(seq) > 0)
       SELECT l.contig, CAST(floor((l.i - 1) / 1000) AS BIGINT) AS chunk, string_agg(CASE WHEN b.i IS NULL THEN base ELSE 'N' END, '' ORDER BY l.i) AS seq
       FROM l LEFT JOIN b ON l.contig = b.contig AND l.i = b.i GROUP BY ALL""",
    inputs=("contigs",),
)
def mask_fasta(spark, sf_dir):
    pieces = consensus.chunks(frame(spark, sf_dir, "contigs")).drop("first")
    return consensus.mask_chunks(pieces, mask_bed(spark, sf_dir))


@query(
    "interval_sequences",
    """WITH b AS (SELECT 'd' || user_id AS contig, CAST(floor(value * 40) AS BIGINT) AS s, 1 + event_id % 60 AS n, 'e' || event_id AS name,
           CASE WHEN event_type = 'view' THEN '-' ELSE '+' END AS strand FROM events),
         x AS (SELECT b.name, b.strand, substr(seq, CAST(s + 1 AS INT), CAST(n AS INT)) AS sub, length(seq) AS len, s FROM b JOIN contigs USING (contig))
       SELECT name, CASE WHEN strand = '-' THEN reverse(translate(sub, 'ACGT', 'TGCA')) ELSE sub END AS seq FROM x
       WHERE floor(s / 1000) * 1000 < len""",
    inputs=("contigs",),
)
def interval_sequences(spark, sf_dir):
    bed = table(spark, sf_dir, "events").select(
        F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("contig"), F.floor(F.col("value") * 40).alias("start"),
        (F.floor(F.col("value") * 40) + 1 + F.col("event_id") % 60).alias("end"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("name"),
        F.when(F.col("event_type") == "view", "-").otherwise("+").alias("strand"),
    )
    return consensus.interval_sequences(bed, frame(spark, sf_dir, "contigs")).select("name", "seq")


# Variants in order of position; one that starts inside what the last applied one replaces is skipped.
APPLIED = """, hi AS (SELECT *, row_number() OVER (PARTITION BY sample, contig ORDER BY pos) AS n FROM (
          SELECT sample, contig, pos, arg_min(ref, alt) AS ref, min(alt) AS alt FROM decoded WHERE alt_freq >= 0.75 GROUP BY ALL)),
        walk AS (SELECT *, true AS used, pos + length(ref) - 1 AS reach FROM hi WHERE n = 1
          UNION ALL SELECT h.*, h.pos > w.reach, CASE WHEN h.pos > w.reach THEN h.pos + length(h.ref) - 1 ELSE w.reach END
          FROM walk w JOIN hi h ON h.sample = w.sample AND h.contig = w.contig AND h.n = w.n + 1),
        ok AS (SELECT sample, contig, pos, ref, alt FROM walk WHERE used),"""


@query(
    "consensus_apply_variants",
    "WITH RECURSIVE " + decoded_sql(False) + APPLIED + """
        del AS (SELECT sample, contig, pos + unnest(range(1, length(ref))) AS pos FROM ok WHERE length(ref) > 1),
        len AS (SELECT contig, max(pos) + 5 AS n FROM decoded GROUP BY contig),
        f AS (SELECT s.sample, len.contig, unnest(range(1, n + 1)) AS pos FROM (SELECT DISTINCT sample FROM hi) s CROSS JOIN len)
      SELECT f.sample, f.contig, CAST(floor((f.pos - 1) / 100) AS BIGINT) AS chunk,
        string_agg(CASE WHEN ok.pos IS NOT NULL THEN ok.alt WHEN del.pos IS NOT NULL THEN '' ELSE """
    + REFERENCE.replace("pos", "f.pos")
    + """ END, '' ORDER BY f.pos) AS seq
      FROM f LEFT JOIN ok ON ok.sample = f.sample AND ok.contig = f.contig AND ok.pos = f.pos
        LEFT JOIN del ON del.sample = f.sample AND del.contig = f.contig AND del.pos = f.pos GROUP BY ALL""",
    inputs=("calls",),
)
def consensus_apply_variants(spark, sf_dir):
    rows = decoded(spark, sf_dir)
    high = variants.consensus_variants(rows, "ivar").select("sample", "contig", "pos", "ref", "alt")
    return consensus.apply_variants(high, made_up_reference(rows), width=100)


def made_up_reference(rows):
    """Reference text of each contig, as long as the calls reach."""
    length = rows.groupBy("contig").agg((F.max("pos") + 5).cast("int").alias("n"))
    size = len(GENOME)
    rotated = GENOME[1:] + GENOME[:1]
    repeats = (F.floor(F.col("n") / size) + 1).cast("int")
    return length.select("contig", F.substr(F.repeat(F.lit(rotated), repeats), F.lit(1), F.col("n")).alias("seq"))


@query(
    "rename_headers",
    """SELECT doc_id, replace(text, '>', '>' || source || ' ') AS line FROM (SELECT doc_id, source, '>' || text AS text FROM documents)""",
)
def rename_headers(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.concat(F.lit(">"), F.col("text")).alias("line"))
    return consensus.rename_headers(rows, "source").drop("source")


# --- reads -----------------------------------------------------------------------------------------


@query("reads_length_filter", "SELECT sample, read_id, length(seq) AS n FROM reads WHERE length(seq) BETWEEN 250 AND 1500", inputs=("reads",))
def reads_length_filter(spark, sf_dir):
    kept = reads.length_filter(frame(spark, sf_dir, "reads"), *reads.amplicon_lengths(1200))
    return kept.select("sample", "read_id", F.length("seq").cast("bigint").alias("n"))


TRIM = """
t AS (SELECT sample, read_id, seq, qual, length(qual) AS n,
  coalesce(list_min(list_filter(range(0, length(qual) - 3), lambda i: {sum_at_i} >= 80)), length(qual)) AS head,
  coalesce(list_min(list_filter(range(0, length(qual) - 3), lambda i: {rsum_at_i} >= 80)), length(qual)) AS tail FROM (SELECT *, reverse(qual) AS rq FROM reads)),
k AS (SELECT sample, read_id, substr(seq, head + 1, greatest(n - head - tail, 0)) AS seq, substr(qual, head + 1, greatest(n - head - tail, 0)) AS qual FROM t),
p AS (SELECT sample, read_id, regexp_replace(seq, '(?:A{10,}|C{10,}|G{10,}|T{10,})$', '') AS seq, qual FROM k),
q AS (SELECT sample, read_id, seq, substr(qual, 1, length(seq)) AS qual FROM p),
kept AS (SELECT *, 100 * (length(qual) - length(replace(qual, '!', ''))) / length(qual) AS low FROM q)
"""
_Q = "CASE substr({s}, CAST(i + {k} AS INT), 1) WHEN '!' THEN 0 WHEN '?' THEN 30 ELSE 40 END"
TRIM = TRIM.replace("{sum_at_i}", " + ".join(_Q.format(s="qual", k=k) for k in (1, 2, 3, 4))).replace(
    "{rsum_at_i}", " + ".join(_Q.format(s="rq", k=k) for k in (1, 2, 3, 4))
)


@query(
    "reads_quality_trim",
    "WITH " + TRIM + "SELECT sample, read_id, seq, qual FROM kept WHERE length(seq) >= 30 AND low <= 30",
    inputs=("reads",),
)
def reads_quality_trim(spark, sf_dir):
    out = reads.trim_reads(frame(spark, sf_dir, "reads"), mean_quality=20, low_percent=30, min_length=30)
    return out.select("sample", "read_id", "seq", "qual")


@query(
    "reads_trim_summary",
    "WITH " + TRIM + """SELECT sample, count(*) AS before_filtering, count(*) FILTER (length(seq) >= 30 AND low <= 30) AS after_filtering FROM kept GROUP BY 1""",
    inputs=("reads",),
)
def reads_trim_summary(spark, sf_dir):
    rows = frame(spark, sf_dir, "reads")
    return reads.trim_summary(rows, reads.trim_reads(rows, mean_quality=20, low_percent=30, min_length=30))


@query(
    "reads_adapter_trim",
    """SELECT contig, regexp_replace(seq, '^(?:AATTA|ATTA|TTA)', '') AS seq FROM contigs WHERE length(regexp_replace(seq, '^(?:AATTA|ATTA|TTA)', '')) >= 30""",
    inputs=("contigs",),
)
def reads_adapter_trim(spark, sf_dir):
    rows = frame(spark, sf_dir, "contigs").withColumn("qual", F.col("seq"))
    return reads.trim_adapters(rows, ["XAATTA"], overlap=3).select("contig", "seq")


@query(
    "reads_quality_by_cycle",
    """WITH e AS (SELECT sample, seq, qual, unnest(range(1, length(seq) + 1)) AS i FROM reads)
       SELECT sample, CAST(i AS INT) AS cycle, count(*) AS n, CAST(sum(ascii(substr(qual, CAST(i AS INT), 1)) - 33) AS BIGINT) AS quality_sum,
         count(*) FILTER (substr(seq, CAST(i AS INT), 1) IN ('G', 'C')) AS gc FROM e GROUP BY ALL""",
    inputs=("reads",),
)
def reads_quality_by_cycle(spark, sf_dir):
    return reads.quality_by_cycle(frame(spark, sf_dir, "reads"))


@query(
    "reads_length_histogram",
    "SELECT sample, CAST(floor(length(seq) / 100) * 100 AS BIGINT) AS length_from, count(*) AS n, CAST(sum(length(seq)) AS BIGINT) AS bases FROM reads GROUP BY ALL",
    inputs=("reads",),
)
def reads_length_histogram(spark, sf_dir):
    return reads.length_histogram(frame(spark, sf_dir, "reads"))


def assignments(spark, sf_dir):
    """Classifier output: long turns are assigned, with the taxon by role."""
    rows = frame(spark, sf_dir, "reads")
    taxid = F.when(F.col("role") == "user", 9606).when(F.col("role") == "assistant", 2697049).otherwise(0)
    return rows.select("sample", "read_id", F.when(F.length("seq") > 200, "C").otherwise("U").alias("status"), taxid.alias("taxid"))


@query("reads_unclassified", "SELECT sample, read_id FROM reads WHERE length(seq) <= 200", inputs=("reads",))
def reads_unclassified(spark, sf_dir):
    rows = frame(spark, sf_dir, "reads").select("sample", "read_id")
    return reads.unclassified(rows, assignments(spark, sf_dir))


@query(
    "reads_taxon_report",
    """WITH a AS (SELECT sample, CASE role WHEN 'user' THEN 9606 WHEN 'assistant' THEN 2697049 ELSE 0 END AS taxid FROM reads),
         s AS (SELECT sample, count(*) AS total FROM a GROUP BY 1), t AS (SELECT DISTINCT taxid FROM a)
       SELECT s.sample, t.taxid, count(a.taxid) AS reads, 100 * count(a.taxid) / s.total AS percent
       FROM s CROSS JOIN t LEFT JOIN a ON a.sample = s.sample AND a.taxid = t.taxid GROUP BY s.sample, t.taxid, s.total""",
    inputs=("reads",),
)
def reads_taxon_report(spark, sf_dir):
    rows = assignments(spark, sf_dir)
    return reads.classification_report(rows, rows.select("taxid").distinct())


@query(
    "kmer_counts",
    """WITH w AS (SELECT sample, substr(seq, CAST(i AS INT), 15) AS k FROM (SELECT sample, seq, unnest(range(1, length(seq) - 13)) AS i FROM contigs WHERE length(seq) >= 15)),
         c AS (SELECT sample, least(k, reverse(translate(k, 'ACGT', 'TGCA'))) AS kmer FROM w)
       SELECT sample, kmer, count(*) AS abundance FROM c GROUP BY ALL HAVING count(*) >= 3""",
    inputs=("contigs",),
)
def kmer_counts(spark, sf_dir):
    return reads.solid_kmers(frame(spark, sf_dir, "contigs"), k=15, min_abundance=3)


# --- annotation ------------------------------------------------------------------------------------

ANN = (
    "concat('DP=', cast(alt_dp as string), ';ANN=', alt_s, '|missense_variant|MODERATE|S|gene1|transcript|T', cast(pos as string), "
    "'|protein_coding|1/1|c.', cast(pos as string), ref, '>', alt_s, '|p.Ala', cast(pos as string), 'Val|10/90|', cast(pos as string), '/900|7/30||,', "
    "alt_s, '|upstream_gene_variant|MODIFIER|N|gene2|transcript|T2|protein_coding|||||||', cast(pos as string), '|')"
)
ANN_TEMPLATE = ANN.replace("alt_s", "replace(replace(alt, '+', ''), '-', '')")


@query(
    "annotation_fields",
    """SELECT sample, contig, pos, ref, alt, src, src2, 'S,N' AS gene, 'gene1,gene2' AS geneid, 'MODERATE,MODIFIER' AS impact,
         'missense_variant,upstream_gene_variant' AS effect, 'transcript,transcript' AS feature, 'T' || pos || ',T2' AS featureid,
         'protein_coding,protein_coding' AS biotype, '1/1,.' AS rank,
         'c.' || pos || ref || '>' || replace(replace(alt, '+', ''), '-', '') || ',.' AS hgvs_c, 'p.Ala' || pos || 'Val,.' AS hgvs_p,
         '10,.' AS cdna_pos, '90,.' AS cdna_len, pos || ',.' AS cds_pos, '900,.' AS cds_len, '7,.' AS aa_pos, '30,.' AS aa_len, '.,' || pos AS distance
       FROM calls""",
    inputs=("calls",),
)
def annotation_fields(spark, sf_dir):
    calls = frame(spark, sf_dir, "calls").selectExpr("sample", "contig", "pos", "ref", "concat(alt, '#', src, '#', src2) as alt", f"{ANN_TEMPLATE} as info")
    out = annotation.extract_fields(calls)
    parts = F.split("alt", "#")
    return out.withColumns(
        {"src": F.get(parts, F.lit(1)).cast("bigint"), "src2": F.get(parts, F.lit(2)).cast("bigint"), "alt": F.get(parts, F.lit(0))}
    )


CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def _amino(codon: str) -> str:
    place = " + ".join(f"(instr('TCAG', substr({codon}, {i}, 1)) - 1) * {m}" for i, m in ((1, 16), (2, 4), (3, 1)))
    return f"substr('{CODE}', CAST(1 + {place} AS INT), 1)"


@query(
    "coding_effects",
    "WITH " + decoded_sql(False) + f""", g AS (SELECT *, CAST(floor(pos / 99) AS BIGINT) * 99 AS lo, CAST(floor(pos / 99) AS BIGINT) * 99 + 89 AS hi,
          CAST(floor(pos / 99) AS BIGINT) % 2 = 1 AS minus FROM decoded WHERE length(ref) = 1 AND length(alt) = 1),
        i AS (SELECT *, CASE WHEN minus THEN CAST(floor((hi - pos) / 3) AS BIGINT) ELSE CAST(floor((pos - lo) / 3) AS BIGINT) END AS num FROM g WHERE pos <= hi),
        c AS (SELECT *, CASE WHEN minus THEN hi - num * 3 - 2 ELSE lo + num * 3 END AS cs FROM i),
        t AS (SELECT *, substr('{GENOME}', CAST(1 + cs % 192 AS INT), 3) AS tri FROM c),
        x AS (SELECT *, substr(tri, 1, CAST(pos - cs AS INT)) || alt || substr(tri, CAST(pos - cs + 2 AS INT), 3) AS ch FROM t),
        y AS (SELECT *, CASE WHEN minus THEN reverse(translate(tri, 'ACGT', 'TGCA')) ELSE tri END AS rc, CASE WHEN minus THEN reverse(translate(ch, 'ACGT', 'TGCA')) ELSE ch END AS ac FROM x),
        z AS (SELECT *, {_amino('rc')} AS aa_ref, {_amino('ac')} AS aa_alt FROM y)
      SELECT sample, contig, pos, ref, alt, src, src2, 'gene' || CAST(CAST(lo / 99 AS BIGINT) AS VARCHAR) AS gene, num + 1 AS aa_pos, aa_ref, aa_alt,
        CASE WHEN num = 0 AND aa_ref = 'M' AND aa_alt <> 'M' THEN 'start_lost' WHEN aa_ref = aa_alt THEN 'synonymous_variant'
          WHEN aa_alt = '*' THEN 'stop_gained' WHEN aa_ref = '*' THEN 'stop_lost' ELSE 'missense_variant' END AS effect FROM z""",
    inputs=("calls",),
)
def coding_effects(spark, sf_dir):
    """Genes of 90 bases every 99 bases over the called range, on alternating strands."""
    rows = decoded(spark, sf_dir).select("sample", "contig", "pos", "ref", "alt", "src", "src2")
    number = F.floor(F.col("pos") / 99)
    cds = rows.select("contig", number.alias("n")).distinct().select(
        "contig", (F.col("n") * 99).alias("start"), (F.col("n") * 99 + 89).alias("end"),
        F.concat(F.lit("gene"), F.col("n").cast("string")).alias("gene"), F.when(F.col("n") % 2 == 1, "-").otherwise("+").alias("strand"),
    )
    starts = cds.withColumn("codon_start", F.explode(F.sequence(F.col("start"), F.col("end") - 2, F.lit(3).cast("bigint"))))
    triplet = F.substr(F.lit(GENOME), (F.col("codon_start") % len(GENOME) + 1).cast("int"), F.lit(3))
    codons = starts.select("contig", "codon_start", triplet.alias("triplet"))
    return annotation.coding_effects(rows, cds, codons)


@query(
    "codon_translation",
    f"SELECT sample, contig, pos, src, src2, {_amino('ref_codon')} AS aa FROM calls WHERE ref_codon IS NOT NULL",
    inputs=("calls",),
)
def codon_translation(spark, sf_dir):
    rows = frame(spark, sf_dir, "calls").filter(F.col("ref_codon").isNotNull())
    return rows.select("sample", "contig", "pos", "src", "src2", translate_codon(F.col("ref_codon")).alias("aa"))


@query(
    "consensus_masked",
    "WITH RECURSIVE " + decoded_sql(False) + APPLIED + """
        del AS (SELECT sample, contig, pos + unnest(range(1, length(ref))) AS pos FROM ok WHERE length(ref) > 1),
        mask AS (SELECT DISTINCT sample, contig, pos FROM calls WHERE total_dp < 30),
        len AS (SELECT contig, max(pos) + 5 AS n FROM decoded GROUP BY contig),
        f AS (SELECT s.sample, len.contig, unnest(range(1, n + 1)) AS pos FROM (SELECT DISTINCT sample FROM hi UNION SELECT DISTINCT sample FROM mask) s CROSS JOIN len)
      SELECT f.sample, f.contig, CAST(floor((f.pos - 1) / 100) AS BIGINT) AS chunk,
        string_agg(CASE WHEN ok.pos IS NOT NULL THEN ok.alt WHEN del.pos IS NOT NULL THEN '' WHEN mask.pos IS NOT NULL THEN 'N' ELSE """
    + REFERENCE.replace("pos", "f.pos")
    + """ END, '' ORDER BY f.pos) AS seq
      FROM f LEFT JOIN ok ON ok.sample = f.sample AND ok.contig = f.contig AND ok.pos = f.pos
        LEFT JOIN del ON del.sample = f.sample AND del.contig = f.contig AND del.pos = f.pos
        LEFT JOIN mask ON mask.sample = f.sample AND mask.contig = f.contig AND mask.pos = f.pos GROUP BY ALL""",
    inputs=("calls",),
)
def consensus_masked(spark, sf_dir):
    """Variants applied to a reference that is masked per sample where the depth is low."""
    rows = decoded(spark, sf_dir)
    low = rows.filter(F.col("dp") < 30).select("sample", "contig", (F.col("pos") - 1).alias("start"), F.col("pos").alias("end"))
    high = variants.consensus_variants(rows, "ivar").select("sample", "contig", "pos", "ref", "alt")
    mask = intervals.merge_intervals(low, ("sample", "contig"))
    return consensus.apply_variants(high, made_up_reference(rows), width=100, mask=mask)
