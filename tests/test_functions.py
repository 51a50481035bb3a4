import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from virotide.functions import numbers, sequence, text


def exact_tail(a, b, c, d):
    total = math.comb(a + b + c + d, a + c)
    return Fraction(sum(math.comb(a + b, x) * math.comb(c + d, a + c - x) for x in range(a, min(a + b, a + c) + 1)), total)


count = st.integers(0, 60)


@settings(max_examples=200, deadline=None)
@given(count, count, count, count)
def test_fisher_is_exact(a, b, c, d):
    got = numbers._fisher_greater(*[np.array([float(v)]) for v in (a, b, c, d)])[0]
    assert got == pytest.approx(float(exact_tail(a, b, c, d)), abs=1e-10)


def test_fisher_known_and_deep(spark):
    rows = spark.createDataFrame([(10, 2, 3, 9), (40000, 60000, 60000, 40000), (0, 0, 5, 5), (None, 1, 1, 1)], "a int, b int, c int, d int")
    got = [r[0] for r in rows.select(numbers.fisher_greater("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(0.006139068899871161, abs=1e-12)
    assert got[1] == pytest.approx(1.0) and got[2] == 1.0 and got[3] is None


def test_float_text_follows_python(spark):
    values = [0.25, 1.0, 0.0005, 0.0001, 0.00001, 1.5e-7, 12345678.9, 1e15, 1e16, 0.1 + 0.2, 100.0]
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    assert [r[0] for r in df.select(numbers.float_text(F.col("v"))).collect()] == [str(v) for v in values]


def test_rounding_is_half_even_on_the_binary_value(spark):
    values = [a / b for a in range(0, 120) for b in range(1, 120, 7)]
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    got = [r[0] for r in df.select(numbers.round_half_even(F.col("v"), 2)).collect()]
    assert got == list(pd.Series(values).round(2))


def test_amino_acids(spark):
    df = spark.createDataFrame([("p.Ala537Val",), ("p.Ter30Gly",), (None,)], "h string")
    assert [r[0] for r in df.select(text.one_letter_protein(F.col("h"))).collect()] == ["p.A537V", "p.*30G", "nan"]


def test_query_header():
    assert [text.query_column(h) for h in ("[1]CHROM", "[6]S1:DP", "POS")] == ["CHROM", "DP", "POS"]


def test_codons_and_strands(spark):
    df = spark.createDataFrame([("ATG",), ("TAA",), ("NNN",)], "c string")
    got = df.select(sequence.translate_codon(F.col("c")), sequence.reverse_complement(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("M", "CAT"), ("*", "TTA"), ("X", "NNN")]


def test_cigar(spark):
    df = spark.createDataFrame([("5S10M2D3I7M4H",)], "c string")
    row = df.select(sequence.cigar_span(F.col("c"), "MDN=X"), sequence.cigar_span(F.col("c"), "MIS=X")).first()
    assert tuple(row) == (19, 25)


def test_labels_and_padding(spark):
    df = spark.range(1)
    none = F.lit(None).cast("string")
    row = df.select(
        text.join_labels(none, none, empty="PASS"), text.join_labels(F.lit("ft"), F.lit("bq"), empty="PASS"),
        text.pad_left(F.lit("ab"), 4), text.pad_centre(F.lit("123"), 10), text.pad_centre(F.lit("12"), 5),
    ).first()
    assert tuple(row) == ("PASS", "ft;bq", "ab  ", "{: ^10}".format("123"), "{: ^5}".format("12"))
