"""Rounding, guarded ratios and number text."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


# Executors get the functions below with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def round_half_even(value: Column, digits: int) -> Column:
    """Round half to even on the binary value (``rint``), not on its decimal text."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL, not an error, for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def float_text(value: Column) -> Column:
    """Shortest decimal text with Python's rules: ``0.25``, ``1.0``, ``0.0005``, ``1e-05``.

    Spark switches to ``E`` notation below 1e-3 and from 1e7 on; Python below 1e-4 and from 1e16 on.
    """
    text = value.cast("string")
    magnitude = F.abs(value)
    plain = F.regexp_replace(text.cast("decimal(38,20)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    science = F.concat(
        mantissa,
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"),
    )
    return (
        F.when(~text.contains("E"), text)
        .when((magnitude >= 1e-4) & (magnitude < 1e16), plain)
        .otherwise(science)
    )


def six_digits(x: Column) -> Column:
    """``x`` as text tools print it: six significant digits, halves to even."""
    scale = F.pow(F.lit(10.0), 5 - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, x).otherwise(F.rint(x * scale) / scale)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    """``ln(n!)``: exact products below 10, Stirling's series above (error < 1e-12)."""
    x = np.maximum(n, 10.0)
    series = (x + 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi)
    series += 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    small = np.log(np.cumprod(np.array([1.0, *range(1, 10)])))
    return np.where(n < 10, small[np.minimum(n, 9).astype(int)], series)


def _tail(first: np.ndarray, steps: np.ndarray, ratio_at) -> np.ndarray:
    """Sum of a falling series whose next term is the last one times ``ratio_at(k)``."""
    total, term = first.copy(), first.copy()
    for k in range(int(steps.max(initial=0))):
        term = np.where(k < steps, term * ratio_at(k), 0.0)
        total += term
        if not (term > total * 1e-17).any():
            break
    return total


def _fisher_greater(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """P(X >= a) with fixed margins, for whole batches.

    The sum runs away from the mode, where terms fall: upward from ``a`` above the mean, else one
    minus the sum downward from ``a - 1``. Nothing can underflow before it is negligible.
    """
    row1, row2, col1, col2 = a + b, c + d, a + c, b + d
    margins = sum(_log_factorial(m) for m in (row1, row2, col1, col2)) - _log_factorial(row1 + row2)
    above = a * (row1 + row2) > row1 * col1

    def first(w, x, y, z):
        possible = (w >= 0) & (z >= 0)
        cells = sum(_log_factorial(np.maximum(m, 0)) for m in (w, x, y, z))
        return np.where(possible, np.exp(np.where(possible, margins - cells, 0.0)), 0.0)

    upper = _tail(
        np.where(above, first(a, b, c, d), 0.0),
        np.where(above, np.minimum(b, c), 0),
        lambda k: (b - k) * (c - k) / ((a + k + 1) * (d + k + 1)),
    )
    lower = _tail(
        np.where(above, 0.0, first(a - 1, b + 1, c + 1, d - 1)),
        np.where(above, 0, np.maximum(np.minimum(a, d) - 1, 0)),
        lambda k: (a - 1 - k) * (d - 1 - k) / ((b + 2 + k) * (c + 2 + k)),
    )
    return np.clip(np.where(above, upper, 1.0 - lower), 0.0, 1.0)


@F.pandas_udf(DoubleType())
def fisher_greater(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """One-sided Fisher exact p-value of [[a, b], [c, d]]; NULL if a count is missing."""
    cells = [v.to_numpy(dtype="float64", na_value=np.nan) for v in (a, b, c, d)]
    known = ~np.isnan(np.sum(cells, axis=0))
    out = np.full(len(a), np.nan)
    out[known] = _fisher_greater(*[v[known] for v in cells])
    return pd.Series(out).where(known, None)
