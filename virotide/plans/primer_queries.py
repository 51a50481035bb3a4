"""Queries for primer removal and genotype likelihoods."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from virotide.operators import alignments, genotypes, primers
from virotide.plans.derived import DERIVED, GENOME, frame
from virotide.plans.genome_queries import REFERENCE, SPAN, site_reference
from virotide.plans.registry import query, table

# Two plain primers, which the scheme marks with X, and one with ambiguity codes, which may stand inside a read.
FORWARD, OTHER, MIXED = GENOME[5:29], GENOME[70:92], "GGTRCCAGTYACC"
ADAPTERS = (f"X{FORWARD}", f"X{OTHER}", MIXED)

# Reads that start with a primer, whole, edited, cut off or not at all; behind it the letters of a document.
DERIVED["primed_reads"] = (
    "documents",
    [
        ["concat('d', cast(doc_id as string)) as read_id", "doc_id % 9 as kind", "upper(regexp_replace(text, '[^ACGTacgt]', ''{g})) as body"],
        [
            "read_id",
            f"""concat(case kind when 0 then '{FORWARD}' when 1 then '{FORWARD[:10]}N{FORWARD[11:]}' when 2 then '{OTHER[:7] + OTHER[8:]}'
                when 3 then '{OTHER[:12]}A{OTHER[12:]}' when 4 then '{FORWARD[10:]}' when 5 then '{FORWARD[:4]}N{FORWARD[5:18]}{FORWARD[19:]}'
                when 6 then 'CATGGTACCAGTTACC' when 7 then '{OTHER[:6]}NN{OTHER[8:15]}N{OTHER[16:]}' else '' end, body) as seq""",
        ],
        ["read_id", "seq", "seq as qual"],
    ],
)


def _parts(turned: bool) -> str:
    """All parts of all spellings of the adapters, as rows (part, inside, errors)."""
    rows = set()
    for adapter in ADAPTERS:
        inside, plain = not adapter.startswith("X"), adapter.removeprefix("X")
        for r in "AG" if "R" in plain else "-":
            for y in "CT" if "Y" in plain else "-":
                text = plain.replace("R", r).replace("Y", y)
                text = text[::-1] if turned else text
                rows.update((text[i:], inside and i == 0, math.floor(0.1 * len(text[i:]))) for i in range(len(text) - 4))
    return ", ".join(f"('{p}', {i}, {e})" for p, i, e in sorted(rows))


def _trim_sql(turned: bool) -> str:
    """Every part against every start and length: no seeds, no candidates."""
    text = "reverse(seq)" if turned else "seq"
    kept = "left(seq, length(seq) - cut)" if turned else "substr(seq, cut + 1)"
    return f"""WITH part(part, inside, errors) AS (VALUES {_parts(turned)}), r AS (SELECT *, {text} AS t FROM primed_reads),
      places AS (
        SELECT read_id, t, part, errors, 0 AS s FROM r, part
        UNION ALL SELECT read_id, t, part, errors, unnest(range(1, length(t))) FROM r, part WHERE inside),
      tried AS (SELECT read_id, part, errors, s, n, levenshtein(part, substr(t, CAST(s + 1 AS INT), CAST(n AS INT))) AS wrong
        FROM (SELECT *, unnest(range(length(part) - errors, length(part) + errors + 1)) AS n FROM places) WHERE s + n <= length(t)),
      best AS (SELECT read_id, s + n AS cut FROM tried WHERE wrong <= errors
        QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY length(part) - 2 * wrong DESC, wrong, s + n DESC) = 1),
      c AS (SELECT read_id, seq, coalesce(cut, 0) AS cut FROM primed_reads LEFT JOIN best USING (read_id))
    SELECT read_id, {kept} AS seq FROM c WHERE length(seq) - cut >= 30"""


@query("reads_tolerant_trim", _trim_sql(False), inputs=("primed_reads",))
def reads_tolerant_trim(spark, sf_dir):
    return primers.trim_tolerant(frame(spark, sf_dir, "primed_reads"), ADAPTERS).select("read_id", "seq")


@query("reads_tolerant_trim_3p", _trim_sql(True), inputs=("primed_reads",))
def reads_tolerant_trim_3p(spark, sf_dir):
    return primers.trim_tolerant(frame(spark, sf_dir, "primed_reads"), ADAPTERS, three_prime=True).select("read_id", "seq")


# --- alignments: each base with its place, then kept places, then texts --------------------------------

PRIMERS = """p AS (SELECT DISTINCT 'ctg' || substr('ANR', CAST(1 + p_partkey % 3 AS INT), 1) AS contig, CAST(floor(p_partkey / 8) AS BIGINT) AS "start",
    CAST(floor(p_partkey / 8) AS BIGINT) + 1 + CAST(floor(p_size / 5) AS BIGINT) AS "end", p_size > 25 AS rev FROM part)"""
CLIPPED = f"""e AS (SELECT *, row_number() OVER () AS rid, flag & 16 = 16 AS rev, pos + {SPAN} - 1 AS ref_end FROM reads_aligned WHERE flag & 4 = 0),
{PRIMERS},
h AS (SELECT rid, max(p."end") AS last, min(p."start" + 1) AS first FROM e JOIN p ON e.contig = p.contig AND e.rev = p.rev
  AND CASE WHEN e.rev THEN ref_end ELSE pos END BETWEEN p."start" + 1 AND p."end" GROUP BY rid),
b AS (SELECT rid, rev, i + 1 AS place, ascii(substr(qual, CAST(i + 1 AS INT), 1)) - 33 AS q,
    CASE cigar WHEN '3S17M' THEN CASE WHEN i >= 3 THEN pos + i - 3 END WHEN '16M4S' THEN CASE WHEN i < 16 THEN pos + i END
      WHEN '8M2D12M' THEN CASE WHEN i < 8 THEN pos + i ELSE pos + i + 2 END
      WHEN '10M3I7M' THEN CASE WHEN i < 10 THEN pos + i WHEN i >= 13 THEN pos + i - 3 END ELSE pos + i END AS p
  FROM (SELECT *, unnest(range(20)) AS i FROM e)),
k AS (SELECT rid, min(place) AS a, max(place) AS b FROM b LEFT JOIN h USING (rid)
  WHERE p IS NOT NULL AND (rev OR last IS NULL OR p > last) AND (NOT rev OR first IS NULL OR p < first) GROUP BY rid),
w AS (SELECT b.rid, b.rev, b.place, k.a, k.b, avg(o.q) AS mean FROM b JOIN k USING (rid) JOIN b o ON o.rid = b.rid AND o.place BETWEEN k.a AND k.b
    AND CASE WHEN b.rev THEN o.place BETWEEN b.place - 3 AND b.place ELSE o.place BETWEEN b.place AND b.place + 3 END
  WHERE b.place BETWEEN k.a AND k.b GROUP BY ALL),
low AS (SELECT rid, min(place) FILTER (NOT rev) AS f, max(place) FILTER (rev) AS r FROM w WHERE mean < 20 GROUP BY rid),
z AS (SELECT rid, min(place) AS a, max(place) AS b, min(p) AS p FROM b JOIN k USING (rid) LEFT JOIN low USING (rid)
  WHERE p IS NOT NULL AND place BETWEEN k.a AND k.b AND (f IS NULL OR place < f) AND (r IS NULL OR place > r) GROUP BY rid),
y AS (SELECT e.*, z.a, z.b, z.p, h.rid IS NOT NULL AS has_primer,
    greatest(0, least(CASE cigar WHEN '8M2D12M' THEN 8 ELSE 10 END, z.b) - z.a + 1) AS m1,
    greatest(0, z.b - greatest(CASE cigar WHEN '8M2D12M' THEN 9 ELSE 14 END, z.a) + 1) AS m2
  FROM e JOIN z USING (rid) LEFT JOIN h USING (rid) WHERE z.b - z.a + 1 >= 10),
clipped AS (SELECT *, m1 > 0 AND m2 > 0 AND cigar IN ('8M2D12M', '10M3I7M') AS broken FROM y)"""


def _bed(spark, sf_dir):
    start = F.floor(F.col("p_partkey") / 8).cast("bigint")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("ctg"), F.substr(F.lit("ANR"), (F.col("p_partkey") % 3 + 1).cast("int"), F.lit(1))).alias("contig"),
        start.alias("start"), (start + 1 + F.floor(F.col("p_size") / 5)).alias("end"),
        F.when(F.col("p_size") > 25, "-").otherwise("+").alias("strand"),
    )


def _clipped(spark, sf_dir):
    rows = frame(spark, sf_dir, "reads_aligned", "sample", "qname", "flag", "contig", "pos", "cigar", "seq", "qual")
    return primers.clip_alignments(rows, _bed(spark, sf_dir), min_length=10)


@query(
    "clip_primers",
    f"""WITH {CLIPPED} SELECT sample, qname, flag, contig, CAST(p AS BIGINT) AS pos,
      CASE WHEN a > 1 THEN (a - 1) || 'S' ELSE '' END
      || CASE WHEN broken THEN m1 || 'M' || CASE cigar WHEN '8M2D12M' THEN '2D' ELSE '3I' END || m2 || 'M' ELSE (b - a + 1) || 'M' END
      || CASE WHEN b < 20 THEN (20 - b) || 'S' ELSE '' END AS cigar, has_primer FROM clipped""",
    inputs=("reads_aligned",),
)
def clip_primers(spark, sf_dir):
    return _clipped(spark, sf_dir).select("sample", "qname", "flag", "contig", "pos", "cigar", "has_primer")


@query(
    "clip_primers_pileup",
    f"""WITH {CLIPPED}, good AS (SELECT * FROM clipped WHERE flag & 1796 = 0),
      m AS (SELECT g.sample, g.contig, b.p AS pos, substr(g.seq, CAST(b.place AS INT), 1) AS base FROM good g JOIN b USING (rid)
          WHERE b.p IS NOT NULL AND b.place BETWEEN g.a AND g.b
        UNION ALL SELECT sample, contig, pos + 9, '+' || substr(seq, 11, 3) FROM good WHERE broken AND cigar = '10M3I7M'
        UNION ALL SELECT sample, contig, pos + 8 + d, '*' FROM good, (VALUES (0), (1)) v(d) WHERE broken AND cigar = '8M2D12M')
      SELECT sample, contig, CAST(pos AS BIGINT) AS pos, base, count(*) AS n FROM m GROUP BY ALL""",
    inputs=("reads_aligned",),
)
def clip_primers_pileup(spark, sf_dir):
    """Reads over primer and quality clipping to base counts: clipped bases no longer count."""
    return alignments.pileup_counts(_clipped(spark, sf_dir)).select("sample", "contig", "pos", "base", "n")


# --- genotypes ----------------------------------------------------------------------------------------


@query(
    "genotype_likelihoods",
    f"""WITH b AS (SELECT sample, contig, flag & 16 = 16 AS rev, substr(seq, CAST(i + 1 AS INT), 1) AS base, greatest(ascii(substr(qual, CAST(i + 1 AS INT), 1)) - 33, 1) AS q,
        CASE cigar WHEN '3S17M' THEN CASE WHEN i >= 3 THEN pos + i - 3 END WHEN '16M4S' THEN CASE WHEN i < 16 THEN pos + i END
          WHEN '8M2D12M' THEN CASE WHEN i < 8 THEN pos + i ELSE pos + i + 2 END
          WHEN '10M3I7M' THEN CASE WHEN i < 10 THEN pos + i WHEN i >= 13 THEN pos + i - 3 END ELSE pos + i END AS pos
      FROM (SELECT *, unnest(range(20)) AS i FROM reads_aligned WHERE flag & 1796 = 0)),
    g AS (SELECT *, CAST(round(1000000 * log10(1 - pow(10, -q / 10.0))) AS BIGINT) AS hit, CAST(round(1000000 * log10(pow(10, -q / 10.0) / 3)) AS BIGINT) AS miss
      FROM b WHERE pos IS NOT NULL AND q >= 20 AND base IN ('A', 'C', 'G', 'T')),
    -- Each of four letters against each read of the site.
    l AS (SELECT sample, contig, pos, a.letter, {REFERENCE} AS ref, sum(CASE WHEN base = letter THEN hit ELSE miss END) AS score,
        count(*) AS dp, count(*) FILTER (base = letter) AS n, count(*) FILTER (base = letter AND rev) AS n_reverse
      FROM g, (VALUES ('A'), ('C'), ('G'), ('T')) a(letter) GROUP BY ALL),
    t AS (SELECT * FROM l WHERE n > 0
      QUALIFY row_number() OVER (PARTITION BY sample, contig, pos ORDER BY score - CASE WHEN letter = ref THEN 0 ELSE 3000000 END DESC, letter = ref DESC, letter) = 1)
    SELECT t.sample, t.contig, CAST(t.pos AS BIGINT) AS pos, t.ref, t.letter AS alt, t.dp, r.n AS ref_dp, r.n_reverse AS ref_rv, t.n AS alt_dp, t.n_reverse AS alt_rv,
      CAST(floor((t.score - r.score + 50000) / 100000) AS BIGINT) AS pl_ref, CAST(floor((t.score - r.score - 2950000) / 100000) AS BIGINT) AS qual
    FROM t JOIN l r ON r.sample = t.sample AND r.contig = t.contig AND r.pos = t.pos AND r.letter = t.ref WHERE t.letter <> t.ref AND t.dp >= 3""",
    inputs=("reads_aligned",),
)
def genotype_likelihoods(spark, sf_dir):
    rows = frame(spark, sf_dir, "reads_aligned", "sample", "contig", "pos", "flag", "cigar", "seq", "qual")
    return genotypes.call_haploid(genotypes.allele_likelihoods(rows), site_reference(rows), min_depth=3)
