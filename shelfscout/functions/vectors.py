"""Arithmetic on array<double> columns.

Scores compare sums of products, so the order of summing could decide a rank. Vectors are therefore put on
a grid of 2^-20 before they are multiplied: every product and sum is then exact in a double, and a score
has one value however the work is split.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfscout.functions.scalars import col

GRID = float(2**20)


def doubles(c: Column | str) -> Column:
    return col(c).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(col(a), F.lit(0.0), lambda acc, x: acc + x * x))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    squares = F.zip_with(col(a), col(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)


def unit(a: Column | str) -> Column:
    """Vector of length one; the zero vector stays zero."""
    length = norm(a)
    return F.when(length > 0, F.transform(col(a), lambda x: x / length)).otherwise(col(a))


def cosine(a: Column | str, b: Column | str) -> Column:
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths).otherwise(F.lit(0.0))


def snap(x: Column) -> Column:
    """One number on the grid."""
    return F.floor(x * GRID + 0.5).cast("double") / GRID


def on_grid(a: Column | str) -> Column:
    return F.transform(doubles(a), snap)


def min_max(x: Column, low: Column | float, high: Column | float) -> Column:
    """Scale to 0..1 by given extremes; the small term keeps a constant set finite."""
    return (x - F.lit(low)) / (F.lit(high) - F.lit(low) + F.lit(1e-9))
