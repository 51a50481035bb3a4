"""Small text expressions shared by readers and writers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that the tabular reader takes as missing.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Three-letter amino acid codes and their one-letter forms.
AMINO_ACIDS = (
    ("Ala", "A"), ("Arg", "R"), ("Asn", "N"), ("Asp", "D"), ("Cys", "C"), ("Gln", "Q"), ("Glu", "E"),
    ("Gly", "G"), ("His", "H"), ("Ile", "I"), ("Leu", "L"), ("Lys", "K"), ("Met", "M"), ("Phe", "F"),
    ("Pro", "P"), ("Pyl", "O"), ("Ser", "S"), ("Sec", "U"), ("Thr", "T"), ("Trp", "W"), ("Tyr", "Y"),
    ("Val", "V"), ("Asx", "B"), ("Glx", "Z"), ("Xaa", "X"), ("Xle", "J"), ("Ter", "*"),
)


def missing_to_null(value: Column) -> Column:
    return F.when(~value.isin(*MISSING_TEXT), value)


def one_letter_protein(hgvs: Column) -> Column:
    """``p.Ala537Val`` -> ``p.A537V``; a missing value reads ``nan``, as its text form does."""
    out = F.coalesce(hgvs, F.lit("nan"))
    for three, one in AMINO_ACIDS:
        out = F.replace(out, F.lit(three), F.lit(one))
    return out


def query_column(header: str) -> str:
    """Field name inside a query header such as ``[6]S1:DP``."""
    return header.split("]")[-1].split(":")[-1]


def join_labels(*labels: Column, empty: str) -> Column:
    """``;``-join of the labels that are not NULL, or ``empty`` if there is none."""
    # A pattern, not a CASE: the joined text (and a test inside it) is then evaluated once.
    return F.regexp_replace(F.concat_ws(";", *labels), "^$", empty)


def pad_left(value: Column, width: int) -> Column:
    """Left-aligned text in a field that widens for long values."""
    return F.when(F.length(value) >= width, value).otherwise(F.rpad(value, width, " "))


def pad_centre(value: Column, width: int) -> Column:
    """Centred text; the odd blank goes to the right."""
    left = F.floor((F.lit(width) - F.length(value)) / 2).cast("int")
    padded = F.rpad(F.concat(F.repeat(F.lit(" "), F.greatest(left, F.lit(0))), value), width, " ")
    return F.when(F.length(value) >= width, value).otherwise(padded)
