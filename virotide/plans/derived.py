"""Genome-shaped inputs derived from the given tables.

Each entry is a chain of select lists over one table, in SQL that both Spark and an ANSI engine read
the same way, so an operator and its oracle start from the same rows. Nothing is sampled: every row
of the table becomes a row (or several), and the inputs grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A repeating made-up genome: all 64 triplets in letter order, so that every codon occurs.
GENOME = "".join(a + b + c for a in "ACGT" for b in "ACGT" for c in "ACGT")


def base_at(position: str) -> str:
    """The made-up reference base at a position."""
    return f"substr('{GENOME}', cast(1 + {position} % {len(GENOME)} as int), 1)"


CODON = f"substr('{GENOME}', cast(1 + pos % {len(GENOME)} - pos % 3 as int), 3)"

# name -> (table, select lists). "*" is spelled out where columns are carried on.
DERIVED: dict[str, tuple[str, list[list[str]]]] = {
    # Variant caller rows: sample = supplier, contig = return flag, pos from the part.
    "calls": (
        "lineitem",
        [
            [
                "concat('S', cast(l_suppkey as string)) as sample",
                "concat('ctg', l_returnflag) as contig",
                "cast(floor(l_partkey / 4) as bigint) + 1 as pos",
                "l_orderkey * 8 + l_linenumber as src",
                "cast(floor(l_extendedprice * 100 + 0.5) as bigint) as src2",
                "l_orderkey as k", "l_linenumber as ln", "l_linestatus as ls",
                "cast(floor(l_tax * 100 + 0.5) as int) as tax",
                "cast(floor(l_discount * 100 + 0.5) as int) as disc",
                "20 + cast(l_quantity as int) as total_dp",
            ],
            [
                "sample", "contig", "pos", "src", "src2", "k", "ln", "ls", "tax", "disc", "total_dp",
                f"{base_at('pos')} as ref", f"{CODON} as codon", "cast(pos % 3 as int) as ci",
                "cast(floor(total_dp * (30 + (k % 8) * 10) / 100.0) as int) as alt_dp",
                "cast(15 + k % 25 as int) as alt_qual",
            ],
            [
                "sample", "contig", "pos", "src", "src2", "k", "ln", "ls", "tax", "disc", "total_dp",
                "ref", "codon", "ci", "alt_dp", "alt_qual",
                "substr('ACGT', cast(1 + (instr('ACGT', ref) + k % 3) % 4 as int), 1) as alt_base",
                "total_dp - alt_dp as ref_dp",
            ],
            [
                "sample", "contig", "pos", "src", "src2", "ref",
                "case when tax = 0 then concat('+', alt_base, 'T') when tax = 1 then concat('-', alt_base, 'CA') "
                "else alt_base end as alt",
                "ref_dp", "cast(floor(ref_dp * ln / 8.0) as int) as ref_rv", "cast(30 + ln as int) as ref_qual",
                "alt_dp", "cast(floor(alt_dp * (k % 9) / 10.0) as int) as alt_rv", "alt_qual",
                "floor(alt_dp * 1e6 / total_dp) / 1e6 as alt_freq", "total_dp",
                "(alt_dp * 100 >= total_dp * 35 or ls = 'O') as pass",
                "case when disc = 0 then null else codon end as ref_codon",
                "case when disc = 0 then null when disc = 10 and ln = 7 then reverse(codon) "
                "else concat(substr(codon, 1, ci), alt_base, substr(codon, ci + 2, 3)) end as alt_codon",
            ],
        ],
    ),
    # Alignment rows: 20-base reads with four CIGAR shapes.
    "reads_aligned": (
        "lineitem",
        [
            [
                "concat('S', cast(l_suppkey as string)) as sample",
                "concat('r', cast(l_orderkey as string), '_', cast(l_linenumber as string), '_', "
                "cast(cast(floor(l_extendedprice * 100 + 0.5) as bigint) as string)) as qname",
                "concat('ctg', l_returnflag) as contig",
                "cast(floor(l_partkey / 8) as bigint) + 1 as pos",
                "cast(floor(l_tax * 1000 + 0.5) as int) as mapq",
                "l_orderkey as k", "l_linenumber as ln", "l_linestatus as ls",
                "cast(l_quantity as int) as q", "cast(floor(l_discount * 100 + 0.5) as int) as disc",
            ],
            [
                "sample", "qname", "contig", "pos", "mapq",
                "cast(1 + case when ln = 1 then 0 else 2 end + case when disc = 10 then 4 else 0 end "
                "+ case when disc = 9 then 8 else 0 end + case when ls = 'O' then 16 else 32 end "
                "+ case when k % 2 = 0 then 64 else 128 end + case when disc = 8 then 256 else 0 end "
                "+ case when disc = 7 and ln = 7 then 2048 else 0 end as int) as flag",
                "case when ln = 1 then '3S17M' when ln = 2 then '8M2D12M' when ln = 3 then '10M3I7M' "
                "when ln = 4 then '16M4S' else '20M' end as cigar",
                "substr('ACGTTGCAACGGTCATGCCATAGACCTTGAGTACGATCCGTA', cast(1 + k % 20 as int), 20) as seq",
                "substr('IIIIIIIIII5555555555IIIII5555!!!!!????IIII', cast(1 + q % 20 as int), 20) as qual",
                "pos + 50 + k % 13 as mate_pos",
                "cast(case when ls = 'O' then -1 else 1 end * (70 + k % 13) as int) as tlen",
            ],
        ],
    ),
    # Sequences: document text with every other letter read as N; sample = source.
    "sequences": (
        "documents",
        [
            [
                "concat('d', cast(doc_id as string)) as contig", "source as sample",
                "upper(regexp_replace(text, '[^ACGTacgt]', 'N'{g})) as seq",
            ]
        ],
    ),
    # Base-only sequences, as contigs of an assembly.
    "contigs": (
        "documents",
        [
            [
                "concat('d', cast(doc_id as string)) as contig", "source as sample",
                "upper(regexp_replace(text, '[^ACGTacgt]', ''{g})) as seq",
            ]
        ],
    ),
    # Reads: conversation turns, with qualities from the kind of letter.
    "reads": (
        "conversations",
        [
            [
                "concat('c', cast(conv_id as string)) as sample",
                "concat(cast(conv_id as string), '_', cast(turn as string), '_', role) as read_id",
                "turn", "role", "text",
            ],
            [
                "sample", "read_id", "turn", "role",
                "upper(regexp_replace(text, '[^ACGTacgt]', 'N'{g})) as seq",
                "regexp_replace(regexp_replace(regexp_replace(text, '[^a-zA-Z]', '!'{g}), '[aeiouAEIOU]', '?'{g}), "
                "'[a-zA-Z]', 'I'{g}) as qual",
            ],
        ],
    ),
    # Primers: name = amplicon and side, spans of up to 50 bases.
    "primers": (
        "part",
        [
            [
                "concat('ctg', p_type) as contig",
                "cast(p_partkey as bigint) * 13 % 30000 as start",
                "cast(p_partkey as bigint) * 13 % 30000 + p_size as {end}",
                "concat('amp_', cast(cast(floor(p_partkey / 4) as bigint) as string), "
                "case when p_partkey % 2 = 0 then '_LEFT' else '_RIGHT' end, "
                "case when p_size > 40 then '_alt' else '' end) as name",
                "cast(p_size as string) as score",
                "case when p_partkey % 2 = 0 then '+' else '-' end as strand",
                "p_partkey as src",
            ]
        ],
    ),
    # Intervals per sample: events of a user, 1-60 bases from a start by value.
    "intervals": (
        "events",
        [
            [
                "concat('u', cast(user_id as string)) as sample", "event_type as contig",
                "cast(floor(value * 40) as bigint) as start",
                "cast(floor(value * 40) as bigint) + 1 + event_id % 60 as {end}",
                "event_id as src",
            ]
        ],
    ),
    # Depth rows: one position per order line, depth by quantity.
    "depth": (
        "lineitem",
        [
            [
                "concat('S', cast(l_suppkey as string)) as sample", "'ctg' as contig",
                "l_partkey + 1 as pos", "cast(l_quantity as bigint) as depth",
            ]
        ],
    ),
    # Alignment hits of contigs.
    "hits": (
        "lineitem",
        [
            [
                "concat('S', cast(l_suppkey as string)) as sample",
                "case when l_linenumber = 7 then 'Escherichia phage T4' when l_linenumber = 6 then 'Phage lambda' "
                "else concat('virus ', l_returnflag) end as stitle",
                "concat('contig_', cast(l_orderkey as string)) as qaccver",
                "concat('acc', cast(l_partkey as string)) as saccver",
                "cast(100 + l_quantity * 4 as int) as length",
                "cast(150 + l_orderkey % 150 as int) as qlen",
                "cast(l_partkey as int) + 300 as slen",
            ]
        ],
    ),
}


def _render(expr: str, spark: bool) -> str:
    out = expr.replace("{g}", "" if spark else ", 'g'")
    return out.replace("{end}", "end" if spark else '"end"')


def frame(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A derived input as a DataFrame: all of its columns, or the named ones."""
    source, stages = DERIVED[name]
    df = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    for stage in stages:
        df = df.selectExpr(*[_render(e, True) for e in stage])
    wanted = columns or df.columns
    if len(stages) == 1:
        return df.select(*wanted)
    # A generator keeps these made-up expressions out of later filters: the optimizer would otherwise
    # inline them into every pushed predicate and inferred constraint. Real inputs are plain scans.
    fields = ", ".join(f"'{c}', `{c}`" for c in wanted)
    return df.selectExpr(f"inline(array(named_struct({fields})))")


def cte(name: str) -> str:
    """The same input as the text of a common table expression called ``name``."""
    source, stages = DERIVED[name]
    sql = source
    for i, stage in enumerate(stages):
        listed = ", ".join(_render(e, False) for e in stage)
        sql = f"(SELECT {listed} FROM {sql} AS t{i})"
    return f"{name} AS {sql[1:-1].join(['(', ')'])}"
