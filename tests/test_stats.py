from math import comb

import pytest
from pyspark.sql import functions as F

from veridact.functions import stats


def test_noise_thresholds(spark):
    rows = spark.range(1, 401).select(F.col("id").alias("k")).crossJoin(spark.createDataFrame([(n,) for n in (8, 20, 50, 100, 200, 400)], "n int"))
    low = rows.where("k <= n").where(stats.binom_sf(F.col("k"), F.col("n"), 0.033) < 0.05).groupBy("n").agg(F.min("k").alias("k"))
    assert {r.n: r.k for r in low.collect()} == {8: 2, 20: 3, 50: 5, 100: 7, 200: 12, 400: 20}


def test_binomial_tail_is_the_direct_sum(spark):
    cases = [(0, 5), (1, 5), (5, 5), (6, 5), (3, 40), (40, 40), (1, 1)]
    df = spark.createDataFrame(cases, "k int, n int").select("k", "n", stats.binom_sf(F.col("k"), F.col("n"), 0.2).alias("p"))
    for r in df.collect():
        want = sum(comb(r.n, i) * 0.2**i * 0.8 ** (r.n - i) for i in range(max(r.k, 0), r.n + 1))
        assert r.p == pytest.approx(min(want, 1.0), rel=1e-9, abs=1e-12)
    with pytest.raises(ValueError):
        stats.binom_sf(F.col("k"), F.col("n"), 0.0)


def test_fisher_two_sided(spark):
    def exact(a, b, c, d):
        if 0 in (a + b, c + d, a + c, b + d):
            return 1.0
        prob = lambda x: comb(a + b, x) * comb(c + d, a + c - x) / comb(a + b + c + d, a + c)
        return min(1.0, sum(prob(x) for x in range(max(0, a - d), min(a + b, a + c) + 1) if prob(x) <= prob(a) * (1 + 1e-9)))

    cases = [(8, 2, 1, 5), (3, 1, 1, 3), (0, 5, 0, 7), (10, 10, 10, 10), (1, 9, 11, 3), (0, 0, 3, 4), (30, 2, 12, 25)]
    df = spark.createDataFrame(cases, "a int, b int, c int, d int")
    for r in df.select("*", stats.fisher_two_sided(*map(F.col, "abcd")).alias("p")).collect():
        assert r.p == pytest.approx(exact(r.a, r.b, r.c, r.d), rel=1e-8)


def test_directions(spark):
    df = spark.createDataFrame([(1, 0, 0), (0, 1, 0), (2, 3, 1), (0, 0, 2), (0, 0, 0)], "p int, n int, u int")
    p, n, u = map(F.col, "pnu")
    rows = df.select(stats.direction(p, n), stats.verdict(p, n, u), stats.minority(p, n), stats.negative_ratio(p, n)).collect()
    assert [tuple(r) for r in rows] == [
        ("positive", "positive", None, 0.0), ("negative", "negative", None, 1.0), ("mixed", "mixed", 2, 0.6), ("neutral", "neutral_only", None, None), ("neutral", "silent", None, None)]


def test_noise_thresholds_are_the_published_ones(spark):
    from veridact.operators import polarity

    sizes = spark.createDataFrame([(n,) for n in (8, 20, 50, 100, 200, 400, 400, None, 0, 1, 1_000_000)], "n long")
    got = {r.n: r.min_minority for r in polarity.noise_thresholds(sizes).collect()}
    big = got.pop(1_000_000)
    assert got == {1: 1, 8: 2, 20: 3, 50: 5, 100: 7, 200: 12, 400: 20} and 33_000 < big < 33_400
