"""E-values as mantissa and exponent, and the scores made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.config import Cutoff


def round_tenth(x: Column) -> Column:
    return F.floor(x * 10 + 0.5) / 10


def split_evalue(value: Column) -> tuple[Column, Column]:
    """(mantissa, exponent) of a non-negative double: mantissa to three decimals, then rounded
    half up to two, without carrying 10.00 over; zero is (0, 0). Ties are those of the shortest
    decimal that reads as the double."""
    parts = F.split(F.format_string("%.3e", value), "e")
    mant, exp = F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("int")
    return F.floor(mant * 100 + 0.5) / 100, exp


def ordered_evalue(mant: Column, exp: Column) -> tuple[Column, Column]:
    """(exponent, mantissa) such that smaller is better and zero is best of all."""
    zero = mant == 0
    return F.when(zero, F.lit(-(2**31))).otherwise(exp).cast("int"), F.when(zero, F.lit(0.0)).otherwise(mant)


def repair_zero_exponents(df: DataFrame, mant: str = "evalue_mant", exp: str = "evalue_exp") -> DataFrame:
    """Zero e-values get the exponent below the smallest of the others (0 - 1 if all are zero)."""
    least = df.agg(F.coalesce(F.min(F.when(F.col(mant) != 0, F.col(exp))), F.lit(0)).alias("_least"))
    repaired = F.when(F.col(mant) == 0, F.col("_least") - 1).otherwise(F.col(exp)).cast("int")
    return df.join(F.broadcast(least)).withColumn(exp, repaired).drop("_least")  # one row


def passes(mant: Column, exp: Column, cutoff: Cutoff) -> Column:
    return (mant == 0) | (exp < cutoff.exp) | ((exp == cutoff.exp) & (mant <= cutoff.mant))


def pair_score(m1: Column, e1: Column, m2: Column, e2: Column, zero: float) -> Column:
    """Mean negative logarithm of two e-values; by exponents alone if a mantissa is below ``zero``."""
    by_exponent = (e1 + e2) / F.lit(-2.0)
    return F.when((m1 < zero) | (m2 < zero), by_exponent).otherwise((F.log10(m1 * m2) + e1 + e2) / F.lit(-2.0))


def edge_score(x: Column) -> Column:
    """Three decimals of the single-precision score, cut toward zero after adding a half."""
    single = x.cast("float").cast("double")
    return (single * 1000 + 0.5).cast("bigint") / F.lit(1000.0)


def score_text(x: Column) -> Column:
    """``edge_score`` as text without trailing zeros."""
    return F.regexp_replace(F.format_string("%.3f", edge_score(x)), r"\.?0+$", "")
