"""Arithmetic on points (arrays of numbers) and lists of points, in array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def scaled(a: Column, k: Column) -> Column:
    return F.transform(a, lambda x: x * k)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    """Length of a vector of any dimension."""
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def unit(a: Column) -> Column:
    """The vector over its length; a zero vector stays zero."""
    n = norm(a)
    return F.transform(a, lambda x: x / F.when(n == 0, F.lit(1.0)).otherwise(n))


def cross(a: Column, b: Column) -> Column:
    x, y = lambda i: F.element_at(a, i), lambda i: F.element_at(b, i)
    return F.array(x(2) * y(3) - x(3) * y(2), x(3) * y(1) - x(1) * y(3), x(1) * y(2) - x(2) * y(1))


def doubles(a: Column) -> Column:
    """An array of numbers as an array of doubles."""
    return F.transform(a, lambda x: x.cast("double"))


def points(flat: Column, n: int, dims: int = 3) -> Column:
    """The first ``n * dims`` numbers as ``n`` points."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.transform(F.slice(flat, i * dims + 1, F.lit(dims)), lambda x: x.cast("double")))


def all_nan(points_: Column) -> Column:
    """Whether every coordinate of every point is NaN."""
    return F.forall(points_, lambda p: F.forall(p, F.isnan))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)
