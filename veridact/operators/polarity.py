"""Directions of aspects, tagger noise, ratings that conflict, and splits between segments."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import binom_sf, direction, fisher_two_sided, log_choose, minority, negative_ratio, verdict
from ..functions.text import sentiment_prior
from ..schemas import SPLIT_ALPHA, UNSTATED, NoisePolicy, SufficiencyPolicy
from .gates import sufficiency_gate
from .shared import cut_lineage


def aspect_support(reviews: DataFrame, tags: DataFrame, keys: list[str], policy: NoisePolicy = NoisePolicy()) -> DataFrame:
    """Counts by stance of every group and aspect that someone spoke of, silence beside them, and
    whether the smaller side may be the tagger's noise. reviews are the duplicate gate's survivors."""
    return support(reviews, reviews.join(tags, "review_id"), keys, policy)


def support(reviews: DataFrame, said: DataFrame, keys: list[str], policy: NoisePolicy = NoisePolicy()) -> DataFrame:
    """aspect_support() of reviews and what they said (keys, aspect, polarity), as claims.spoken() has them."""
    sizes = reviews.groupBy(*keys).agg(F.count("*").alias("reviews"))
    n = lambda p: F.count(F.when(F.col("polarity") == p, 1))
    said = said.groupBy(*keys, "aspect").agg(n("positive").alias("pos"), n("negative").alias("neg"), n("neutral").alias("neu"))
    rows = said.join(sizes, keys).withColumn("silent", F.col("reviews") - F.col("pos") - F.col("neg") - F.col("neu"))
    pos, neg, neu = F.col("pos"), F.col("neg"), F.col("neu")
    low = minority(pos, neg)
    p = F.coalesce(binom_sf(low, pos + neg, policy.flip_rate), F.lit(1.0))
    noise = low.isNotNull() & (p >= policy.alpha)
    limits = F.filter(F.array(F.when(noise, "minority_within_tagger_noise"), F.when(pos + neg > 0, "tagger_direction_error")), F.isnotnull)
    return rows.select(
        *keys, "aspect", "pos", "neg", "neu", "silent", direction(pos, neg).alias("direction"), verdict(pos, neg, neu).alias("verdict"),
        negative_ratio(pos, neg).alias("negative_ratio"), F.round(p, 6).alias("minority_p"), F.array_join(limits, ",").alias("limitations"),
    )


def rating_conflicts(reviews: DataFrame, tags: DataFrame) -> DataFrame:
    """Directional tags that oppose the rating, and whether they stand alone, all together or in part."""
    told = reviews.select("review_id", "rating", sentiment_prior(F.col("rating")).alias("sentiment")).where("sentiment <> 'neutral'")
    rows = told.join(tags.where(F.col("polarity").isin("positive", "negative")), "review_id")
    mine = Window.partitionBy("review_id")  # a review's aspects: few
    rows = rows.withColumn("n", F.count("*").over(mine)).withColumn("against", F.count(F.when(F.col("polarity") != F.col("sentiment"), 1)).over(mine))
    kind = F.when(F.col("n") == 1, "sole_aspect").when(F.col("against") == F.col("n"), "all_aspects").otherwise("minority_aspect")
    return rows.where("polarity <> sentiment").select("review_id", "aspect", F.col("polarity").alias("tag_polarity"), "rating", F.col("sentiment").alias("rating_sentiment"), kind.alias("kind"))


def _pairs(segments: DataFrame, alpha: float) -> DataFrame:
    """Pairs of segments (product_id, axis, segment, aspect, pos, neg) of one product, axis and aspect, left before right."""
    side = lambda s: segments.select("product_id", "axis", "aspect", F.col("segment").alias(s), F.col("pos").alias(f"{s}_pos"), F.col("neg").alias(f"{s}_neg"))
    pairs = side("left").join(side("right"), ["product_id", "axis", "aspect"]).where("left < right")
    share = lambda s: F.col(f"{s}_neg") / (F.col(f"{s}_pos") + F.col(f"{s}_neg"))
    major = lambda s: F.when(share(s) > 0.5, "negative").when(share(s) < 0.5, "positive")
    p = fisher_two_sided(F.col("left_pos"), F.col("left_neg"), F.col("right_pos"), F.col("right_neg"))
    return (
        pairs.withColumn("p", p).withColumn("split", F.col("p") < alpha).withColumn("gap", F.abs(share("left") - share("right")))
        .withColumn("left_major", major("left")).withColumn("right_major", major("right"))
        .withColumn("flips", F.coalesce(F.col("left_major") != F.col("right_major"), F.lit(False)))
    )


def _spoken(support: DataFrame) -> DataFrame:
    return support.where((F.col("segment") != UNSTATED) & (F.col("axis") != "product") & (F.col("pos") + F.col("neg") > 0))


def segment_splits(support: DataFrame, alpha: float = SPLIT_ALPHA) -> DataFrame:
    """Pairs of stated segments of one product, axis and aspect whose negative shares differ, whatever their size.

    support: product_id, axis, segment, aspect, pos, neg. Segments are a small vocabulary, so pairs
    are few for each aspect. Null segments take no part.
    """
    return _pairs(_spoken(support), alpha).select(
        "product_id", "axis", "aspect", "left", "right", F.round("p", 6).alias("p_value"), F.round("gap", 4).alias("gap"), "flips", "split", (F.col("left_neg") + F.col("right_neg")).alias("contradicting"))


def unconditional(support: DataFrame, policy: SufficiencyPolicy = SufficiencyPolicy(), alpha: float = SPLIT_ALPHA) -> DataFrame:
    """Whether one answer holds for everybody, for each product and aspect that some condition's segment speaks of.

    support: claims.candidates() (pos, neg, spoke, cell_authors). Only stated segments that pass the sufficiency gate and
    have a direction are compared; the others are counted (skipped_unstated, skipped_insufficient). contradicting_authors:
    of the pairs that split, the smaller side's authors of its own majority, where the other side's majority is
    another or none; a segment counts once, with its largest. holds: no pair splits, also where there is nothing to
    compare; else failure is missing_condition. A null or product-wide segment takes no part.
    """
    rows = sufficiency_gate(support.where((F.col("axis") != "product") & F.col("segment").isNotNull()), policy)
    stated = F.col("segment") != UNSTATED
    usable = F.col("reason").isNull() & (F.col("pos") + F.col("neg") > 0)
    n = lambda c: F.count(F.when(c, 1))
    seen = rows.groupBy("product_id", "aspect").agg(n(~stated).alias("skipped_unstated"), n(stated & ~usable).alias("skipped_insufficient"))
    pairs = cut_lineage(_pairs(rows.where(stated & usable), alpha))
    counted = pairs.groupBy("product_id", "aspect").agg(F.count("*").alias("compared"), n(F.col("split")).alias("splits"), n(F.col("split") & F.col("flips")).alias("flips"))
    sides = pairs.where("split").select("product_id", "aspect", "axis", F.explode(F.array(*[
        F.struct(F.col(a).alias("segment"), F.col(f"{a}_pos").alias("pos"), F.col(f"{a}_neg").alias("neg"), F.col(f"{a}_major").alias("major"), F.col(f"{b}_major").alias("other"), (F.col(f"{b}_pos") + F.col(f"{b}_neg")).alias("size"))
        for a, b in (("left", "right"), ("right", "left"))])).alias("s")).select("product_id", "aspect", "axis", "s.*")
    covered = sides.where(F.col("major").isNotNull() & ~F.col("major").eqNullSafe(F.col("other")) & (F.col("pos") + F.col("neg") < F.col("size")))
    worst = covered.groupBy("product_id", "aspect", "axis", "segment").agg(F.max(F.when(F.col("major") == "negative", F.col("neg")).otherwise(F.col("pos"))).alias("c"))
    lost = worst.groupBy("product_id", "aspect").agg(F.sum("c").alias("contradicting_authors"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    found = seen.join(counted, ["product_id", "aspect"], "left").join(lost, ["product_id", "aspect"], "left")
    found = found.select("product_id", "aspect", *map(zero, ("compared", "splits", "flips", "contradicting_authors")), "skipped_unstated", "skipped_insufficient")
    return found.withColumn("holds", F.col("splits") == 0).withColumn("failure", F.when(~F.col("holds"), "missing_condition"))


def _first_below(low: Column, high: Column, n: Column, policy: NoisePolicy) -> Column:
    """About the smallest k from low to high with P(X >= k) < alpha; high + 1 if there is none. One pass down, each term by the ratio to the one above."""
    odds = policy.flip_rate / (1 - policy.flip_rate)
    top = F.exp(log_choose(n, high) + high * math.log(policy.flip_rate) + (n - high) * math.log(1 - policy.flip_rate))

    def add(acc: Column, i: Column) -> Column:
        total = acc["total"] + acc["term"]
        return F.struct((acc["term"] * i / ((n - i + 1) * odds)).alias("term"), total.alias("total"), F.when(total < policy.alpha, i).otherwise(acc["k"]).alias("k"))

    start = F.struct(top.alias("term"), F.lit(0.0).alias("total"), (high + 1).alias("k"))
    return F.aggregate(F.reverse(F.sequence(low, high)), start, add, lambda acc: acc["k"])


def noise_thresholds(sizes: DataFrame, policy: NoisePolicy = NoisePolicy()) -> DataFrame:
    """(n, min_minority) for every different n of sizes: the smallest minority of n directional tags that isn't the tagger's noise.

    Numbers around the expected flips, twelve deviations up, are passed over once; what that finds and its neighbours are
    tried exactly, so the work grows with the root of n. Null or zero n, and n too small for any minority to tell, give no row.
    """
    n = F.col("n")
    mean = n * policy.flip_rate
    up = F.ceil(mean + 12 * F.sqrt(mean * (1 - policy.flip_rate)) + 10)
    parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, long work: not to be put into one task
    rows = sizes.where("n > 0").select("n").distinct().select("n", F.greatest(F.lit(1), F.floor(mean)).alias("low"), F.least(n.cast("long"), up).alias("high"))
    about = rows.repartition(parts, "n", "low").withColumn("about", _first_below(F.col("low"), F.col("high"), n, policy))
    near = about.select("n", F.explode(F.sequence(F.greatest(F.col("low"), F.col("about") - 1), F.least(F.col("high"), F.col("about") + 1))).alias("k"))
    return near.where(binom_sf(F.col("k"), n, policy.flip_rate) < policy.alpha).groupBy("n").agg(F.min("k").alias("min_minority"))
