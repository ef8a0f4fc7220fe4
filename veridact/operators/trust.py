"""Trust score of reviews and the total order that follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_hash, date_rank, strip
from ..schemas import ContractError, TrustPolicy
from .shared import cut_lineage, numbered, percent_below


def ramp(length: Column, policy: TrustPolicy) -> Column:
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (length - policy.floor_chars) / (policy.cap_chars - policy.floor_chars)))
    if policy.shape == "sqrt":
        t = F.sqrt(t)
    elif policy.shape == "log":
        t = F.log1p(t * (F.exp(F.lit(1.0)) - 1))
    return F.round(t, 6)


def hashed(reviews: DataFrame) -> DataFrame:
    """reviews with content_hash and content_length."""
    return reviews.withColumn("content_hash", content_hash(F.col("content"))).withColumn("content_length", F.coalesce(F.char_length(strip(F.col("content"))), F.lit(0)))


def signals(reviews: DataFrame, policy: TrustPolicy = TrustPolicy(), tagged: DataFrame | None = None) -> DataFrame:
    """reviews with content_hash, content_length, six signals and trust_score.

    Copies are counted by a pre-aggregated join, so that one content behind a third of the reviews
    costs no window over it. on_topic is known only if tagged (review_id) is given, photo and usage
    only if reviews have the columns has_photo and month_over. Signals that aren't known take no
    part in the score; if the rest weighs nothing, the policy is refused. A null content has length 0 and is no copy of any
    other; null likes are the lowest; repeated rows count as copies; an empty table gives an empty result.
    """
    return weighed(hashed(reviews), policy, tagged)


def weighed(rows: DataFrame, policy: TrustPolicy = TrustPolicy(), tagged: DataFrame | str | None = None) -> DataFrame:
    """signals() of hashed(), which may be a table without the contents. tagged may name a column that is null where a review has no tag."""
    given = rows.columns
    copies = cut_lineage(rows.where("content_hash is not null").groupBy("content_hash").agg(F.count("*").alias("copies")))  # a table: AQE splits a hot content
    rows = rows.join(copies, "content_hash", "left").withColumn("copies", F.coalesce("copies", F.lit(1).cast("long")))
    rows = rows.withColumn("s_length", ramp(F.col("content_length"), policy)).withColumn("s_unique", F.round(1 / F.col("copies"), 6))
    rows = percent_below(rows, "product_id", "likes", "s_likes").withColumn("s_likes", F.round("s_likes", 6))
    weights = [("s_length", policy.content_length), ("s_unique", policy.unique_content), ("s_likes", policy.likes)]
    if isinstance(tagged, str):
        rows = rows.withColumn("s_topic", F.col(tagged).isNotNull().cast("double"))
        weights.append(("s_topic", policy.on_topic))
    elif tagged is not None:
        mark = tagged.select("review_id").distinct().withColumn("s_topic", F.lit(1.0))
        rows = rows.join(mark, "review_id", "left").withColumn("s_topic", F.coalesce("s_topic", F.lit(0.0)))
        weights.append(("s_topic", policy.on_topic))
    for c, mark, weight in (("has_photo", "s_photo", policy.has_photo), ("month_over", "s_usage", policy.usage_period)):
        if c in given:
            rows = rows.withColumn(mark, F.when(F.col(c), 1.0).otherwise(0.0))
            weights.append((mark, weight))
    total = sum(w for _, w in weights)
    if total <= 0:
        raise ContractError("the signals at hand weigh nothing together")
    score = sum((F.col(c) * w for c, w in weights), F.lit(0.0)) / total
    known = {c for c, _ in weights}
    missing = [name for mark, name in (("s_photo", "hasPhoto"), ("s_usage", "usagePeriod"), ("s_topic", "onTopic")) if mark not in known]
    return rows.withColumn("trust_score", F.round(score, 4)).withColumn("unavailable", F.array_sort(F.array(*map(F.lit, missing)).cast("array<string>")))


def rank_order() -> list[Column]:
    """Score, then date, both descending, then id."""
    return [F.desc("trust_score"), date_rank(F.col("review_date")).asc(), F.asc("review_id")]


def ranked(scored: DataFrame) -> DataFrame:
    return numbered(cut_lineage(scored), ["product_id"], rank_order(), "rank")
