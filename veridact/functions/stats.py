"""Exact tests and small ratios as column expressions."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0: Stirling's series ten places further on, less what lies between."""
    between = F.lit(1.0)
    for i in range(10):
        between = between * (x + i)
    y = x + 10.0
    inverse = 1 / (y * y)
    series = (1 / 12.0 - inverse * (1 / 360.0 - inverse * (1 / 1260.0 - inverse / 1680.0))) / y
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(between)


def log_choose(n: Column, k: Column) -> Column:
    """ln C(n, k) for 0 <= k <= n, in closed form."""
    one = lambda x: log_gamma(x.cast("double") + 1.0)
    return one(n) - one(k) - one(n - k)


def _steps(low: Column, high: Column) -> Column:
    """The integers from low to high; none if low is greater."""
    return F.when(low <= high, F.sequence(low.cast("long"), high.cast("long"))).otherwise(F.array().cast("array<bigint>"))


def binom_sf(k: Column, n: Column, p: float) -> Column:
    """P(X >= k) for X ~ Binomial(n, p): terms by their ratio, over the places around the mean.

    Beyond twelve deviations and sixty places from the mean nothing is left that a double can show
    beside the rest, so the work grows with the square root of n.
    """
    if not 0 < p < 1:
        raise ValueError("p must be inside (0, 1)")
    odds = p / (1 - p)
    mean, reach = n * p, 12 * F.sqrt(n * (p * (1 - p))) + 60
    low = F.greatest(k.cast("long"), F.floor(mean - reach), F.lit(0).cast("long"))
    high = F.least(n.cast("long"), F.greatest(low + 60, F.ceil(mean + reach)))
    first = F.exp(log_choose(n, low) + low * math.log(p) + (n - low) * math.log(1 - p))
    start = F.struct(first.alias("term"), F.lit(0.0).alias("total"))
    add = lambda a, i: F.struct((a["term"] * (n - i) / (i + 1) * odds).alias("term"), (a["total"] + a["term"]).alias("total"))
    tail = F.aggregate(_steps(low, high), start, add, lambda a: F.least(a["total"], F.lit(1.0)))
    return F.when(k <= 0, 1.0).when(k > n, 0.0).otherwise(tail)


def fisher_two_sided(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two-sided exact test of [[a, b], [c, d]]: the tables no likelier than the one seen; empty margins give 1.

    Tables are weighed against the one seen, whose probability is in closed form, by the ratio of
    each to the one before: one pass up and one down. Beyond twelve deviations and sixty places from the mean all tables
    together have less than 1e-30, so passes end there and the work grows with the square root of the counts; a table
    seen beyond that is weighed with the sixty next to it, away from the mean.
    """
    row1, row2, col1 = a + b, c + d, a + c
    rest = row2 - col1
    seen = F.exp(log_choose(row1, a) + log_choose(row2, c) - log_choose(row1 + row2, col1))
    up = lambda x: (row1 - x + 1) * (col1 - x + 1) / (x * (rest + x))  # noqa: E731  from x - 1 to x
    down = lambda x: (x + 1) * (rest + x + 1) / ((row1 - x) * (col1 - x))  # noqa: E731  from x + 1 to x

    def side(steps: Column, ratio: Callable[[Column], Column]) -> Column:
        def add(acc: Column, x: Column) -> Column:
            weight = acc["weight"] * ratio(x.cast("double"))
            return F.struct(weight.alias("weight"), (acc["total"] + F.when(weight <= 1 + 1e-9, weight).otherwise(0.0)).alias("total"))

        return F.aggregate(steps, F.struct(F.lit(1.0).alias("weight"), F.lit(0.0).alias("total")), add, lambda acc: acc["total"])

    n, x = (row1 + row2).cast("double"), a.cast("long")
    mean = row1.cast("double") * col1 / n
    reach = 12 * F.sqrt(mean * (row2 / n) * ((b + d) / F.greatest(n - 1, F.lit(1.0)))) + 60
    top = F.when(x < F.floor(mean - reach), x).otherwise(F.greatest(F.ceil(mean + reach), x + 60))
    bottom = F.when(x > F.ceil(mean + reach), x).otherwise(F.least(F.floor(mean - reach), x - 60))
    above = side(_steps(a + 1, F.least(row1, col1, top)), up)
    below = side(F.reverse(_steps(F.greatest(F.lit(0), -rest, bottom), a - 1)), down)
    empty = (row1 == 0) | (row2 == 0) | (col1 == 0) | (b + d == 0)
    return F.when(empty, 1.0).otherwise(F.least(seen * (1 + above + below), F.lit(1.0)))


def direction(pos: Column, neg: Column) -> Column:
    return F.when((pos > 0) & (neg > 0), "mixed").when(pos > 0, "positive").when(neg > 0, "negative").otherwise("neutral")


def verdict(pos: Column, neg: Column, neu: Column) -> Column:
    d = direction(pos, neg)
    return F.when(d != "neutral", d).when(neu > 0, "neutral_only").otherwise("silent")


def negative_ratio(pos: Column, neg: Column) -> Column:
    return F.round(neg / F.nullif(pos + neg, F.lit(0)), 4)


def minority(pos: Column, neg: Column) -> Column:
    return F.when((pos > 0) & (neg > 0), F.least(pos, neg))
