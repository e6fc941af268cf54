"""Arithmetic on arrays of numbers, as folds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def plus_product(c: Column, a: Column, b: Column) -> Column:
    """c + a * b, rounded once; a has at most 26 significant bits, such as a count or a half of one.

    b is cut in two, so that both products are exact, and what the first sum loses is added with the second.
    """

    def cut(x: Column) -> Column:
        return let(x * 134217729.0 - (x * 134217729.0 - x), lambda high: let(F.struct((a * high).alias("p"), (a * (x - high)).alias("q")), added))

    def added(e: Column) -> Column:
        return let(c + e["p"], lambda s: s + ((c - (s - (s - c))) + (e["p"] - (s - c)) + e["q"]))

    return let(b, cut)


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def upto(n: Column) -> Column:
    """0, 1, ..., n - 1 for n >= 1."""
    return F.sequence(F.lit(0), n - 1)


def middle(values: Column) -> Column:
    """The median of an array without nulls, the mean of the two middle values; null for none."""
    n = F.size(values)
    return let(F.array_sort(values), lambda s: (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2)
