"""Scalar rules for targets, feature values and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*$"


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    trimmed = F.btrim(text, F.lit(" \t"))
    return F.when(text.rlike(NUMBER), trimmed.try_cast("double"))


def to_class(text: Column) -> Column:
    """Numeric text to an integer class, truncated toward zero."""
    return to_number(text).try_cast("int")


def finite_or_null(x: Column) -> Column:
    x = x.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def float32_or_zero(x: Column) -> Column:
    """Value as stored in 32 bits; missing, NaN and overflow become 0."""
    return F.coalesce(finite_or_null(x.cast("float")), F.lit(0.0))


def clean_array(values: Column, policy: str = "zero") -> Column:
    """Non-finite entries of an array become 0 (`zero`) or null (`null`)."""
    if policy == "zero":
        return F.transform(values, lambda v: F.coalesce(finite_or_null(v), F.lit(0.0)))
    if policy == "null":
        return F.transform(values, finite_or_null)
    raise ValueError(f"unknown policy: {policy}")


def safe_score(score: Column) -> Column:
    """NaN or missing to 0.5, +inf to 1, -inf to 0."""
    s = score.cast("double")
    inf = float("inf")
    return (
        F.when(s.isNull() | F.isnan(s), F.lit(0.5))
        .when(s == F.lit(inf), F.lit(1.0))
        .when(s == F.lit(-inf), F.lit(0.0))
        .otherwise(s)
    )


def threshold(score: Column, cut: float = 0.5) -> Column:
    """1 where score >= cut, ties positive."""
    return (score >= F.lit(cut)).cast("int")


def gain_percent(current: Column, previous: Column) -> Column:
    """100 * (current - previous) / |previous|, null when previous is about 0."""
    return F.when(F.abs(previous) > 1e-12, F.lit(100.0) * (current - previous) / F.abs(previous))
