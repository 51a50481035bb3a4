"""Sequence expressions: complement, translation, CIGAR pieces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amino acids of the standard genetic code, codons in T, C, A, G order.
CODE_BASES = "TCAG"
CODE_AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTUNacgtun", "TGCAANtgcaan"))


def translate_codon(codon: Column) -> Column:
    """Amino acid of one codon by its place in the code table; ``X`` for any other text."""
    code = [F.instr(F.lit(CODE_BASES), F.substring(codon, i, 1)) - 1 for i in (1, 2, 3)]
    place = code[0] * 16 + code[1] * 4 + code[2] + 1
    known = codon.rlike("^[TCAG]{3}$")
    return F.when(known, F.substr(F.lit(CODE_AMINO), place, F.lit(1))).otherwise("X")


def cigar_ops(cigar: Column) -> Column:
    """CIGAR text as an array of (len, op)."""
    pieces = F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            F.regexp_extract(p, r"^(\d+)", 1).cast("int").alias("len"),
            F.substring(p, -1, 1).alias("op"),
        ),
    )


def cigar_span(cigar: Column, kinds: str) -> Column:
    """Summed length of the given operation kinds (``MDN=X`` consumes the reference)."""
    lengths = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{kinds}]"), 1)
    return F.aggregate(lengths, F.lit(0), lambda total, n: total + n.cast("int"))
