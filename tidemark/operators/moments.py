"""Mergeable moments of a metric, from which any window's baseline is a plain sum.

A group keeps its rows, its values' count, sum and sum of squares in decimals: sums of such
rows are the moments of the union, in any order and without rounding, and one row's own value
can be taken out again. Values are kept to four decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

COLUMNS = ["n_rows", "n", "total", "squares"]
VALUE = "decimal(18,4)"


def moments(df: DataFrame, metric: str, by: list[str]) -> DataFrame:
    x = F.col(metric).cast(VALUE)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(x).alias("n"), F.sum(x).alias("total"), F.sum(x * x).alias("squares")
    )


def merged(parts: DataFrame, by: list[str]) -> DataFrame:
    """Moments of coarser groups."""
    return parts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in COLUMNS])


def mean() -> Column:
    return F.col("total").cast("double") / F.col("n")


def _spread(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation; exactly 0 where all values are equal, null under two values."""
    whole = (n * squares - total * total).cast("double")
    return F.when(n > 1, F.sqrt(whole / (n * (n - 1)).cast("double")))


def spread() -> Column:
    return _spread(F.col("n"), F.col("total"), F.col("squares"))


def zscore(metric: str, least: int, leave_one_out: bool = False) -> Column:
    """Distance of a row's value from its group's mean, in standard deviations.

    0 for groups with under ``least`` rows or no spread. With ``leave_one_out`` the row's own
    value is no part of mean and spread (nor of the count).
    """
    x = F.col(metric).cast(VALUE)
    n, total, squares, rows = F.col("n"), F.col("total"), F.col("squares"), F.col("n_rows")
    if leave_one_out:
        own = x.isNotNull()
        n, total, squares = n - own.cast("int"), total - x, squares - x * x
        rows = rows - 1
    sd = _spread(n, total, squares)
    usable = F.coalesce((sd > 0) & (rows >= least), F.lit(False))
    return F.when(usable, F.abs((x.cast("double") - total.cast("double") / n) / sd)).otherwise(F.lit(0.0))
