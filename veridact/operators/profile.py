"""Profiles of a corpus, confidence of claims, and the bookkeeping of crawls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_hash
from ..schemas import UNSTATED


def confidence(judged: DataFrame) -> DataFrame:
    """claims with their type, failure, whether they may be shown, hedges in order, and band."""
    hedges = F.filter(F.array(
        F.when(F.col("direction") == "mixed", "mixed_direction"), F.when(F.col("silent") / F.nullif(F.col("silent") + F.col("spoke"), F.lit(0)) >= 0.5, "mostly_silent"),
        F.when(F.col("support") < 8, "few_authors"), F.when(F.col("limitation").isNotNull(), "limited"),
    ), F.isnotnull)
    return (
        judged.withColumn("claim_type", F.when(F.col("axis") == "product", "unconditional").otherwise("conditional")).withColumn("failure_reason", F.col("reason"))
        .withColumn("exposable", F.col("reason").isNull()).withColumn("hedges", F.array_join(hedges, ",")).withColumn("band", F.when(F.size(hedges) > 0, "hedged").otherwise("assertive"))
    )


def _upper_index(sorted_values: F.Column, share: float) -> F.Column:
    n = F.size(sorted_values)
    return F.element_at(sorted_values, (F.least(n - 1, F.floor(n * share)) + 1).cast("int"))


def ingest_profile(reviews: DataFrame) -> DataFrame:
    """One row of counts. Sorted lists are of products, a small dimension; the rest is aggregated."""
    per = reviews.groupBy("product_id").agg(F.count("*").alias("n")).agg(
        F.count("*").alias("products"), F.min("n").alias("reviews_min"), F.max("n").alias("reviews_max"), _upper_index(F.sort_array(F.collect_list("n")), 0.5).alias("reviews_median"))
    all_ = reviews.agg(
        F.count("*").alias("reviews"), F.round(100 * F.avg(F.col("skin_type").isNotNull().cast("int")), 1).alias("skin_stated"),
        F.round(100 * F.avg((F.size("troubles") > 0).cast("int")), 1).alias("trouble_stated"), F.round(100 * F.avg(F.col("option").isNotNull().cast("int")), 1).alias("option_stated"))
    pairs = reviews.select("author", "product_id").distinct().agg(F.count("*").alias("author_products"))
    copies = reviews.groupBy(content_hash(F.col("content")).alias("h")).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("copy_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("copied_reviews"))
    cells = reviews.groupBy("product_id", F.coalesce("skin_type", F.lit(UNSTATED)).alias("s")).agg(F.count("*").alias("n"), F.count_distinct("author").alias("a"))
    cells = cells.agg(F.count("*").alias("skin_cells"), F.count(F.when(F.col("n") >= 8, 1)).alias("skin_cells_8_reviews"), F.count(F.when(F.col("a") >= 8, 1)).alias("skin_cells_8_authors"))
    troubles = reviews.select(F.explode("troubles").alias("t")).agg(F.count_distinct("t").alias("trouble_segments"))
    out = all_
    for one in (per, pairs, copies, cells, troubles):  # one-row tables
        out = out.join(one, F.lit(True))
    return out.withColumn("excess_votes", F.col("reviews") - F.col("author_products"))


def trust_profile(scored: DataFrame) -> DataFrame:
    """Exact order statistics by cumulated counts of the distinct scores, which are 10,001 at most."""
    counts = scored.groupBy("trust_score").agg(F.count("*").alias("n"))
    packed = counts.agg(F.sort_array(F.collect_list(F.struct("trust_score", "n"))).alias("s"), F.sum("n").alias("total"), F.count("*").alias("scores"))

    def at(share: float) -> F.Column:
        place = F.least(F.col("total") - 1, F.floor(F.col("total") * share))
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("double").alias("v"))
        step = lambda a, x: F.struct((a["seen"] + x["n"]).alias("seen"), F.when(a["v"].isNull() & (a["seen"] + x["n"] > place), x["trust_score"]).otherwise(a["v"]).alias("v"))
        return F.aggregate("s", start, step, lambda a: a["v"])

    return packed.select(F.element_at("s", 1)["trust_score"].alias("min"), *[at(q / 100).alias(f"p{q}") for q in (25, 50, 75, 95)], F.element_at("s", -1)["trust_score"].alias("max"), "scores")


def first_of_passes(passes: list[DataFrame], key: str) -> DataFrame:
    """The union of the passes with each key's first pass; one aggregation, no sort."""
    rows = None
    for i, p in enumerate(passes):
        p = p.withColumn("pass", F.lit(i))
        rows = p if rows is None else rows.unionByName(p)
    names = [c for c in rows.columns if c != key and c != "pass"]
    return rows.groupBy(key).agg(F.min(F.struct("pass", *names)).alias("r")).select(key, "r.*")


def complete(reviews: DataFrame, product: str, target: int) -> DataFrame:
    """Products that a resumed crawl need not fetch again, with their rows' number."""
    return reviews.groupBy(product).agg(F.count("*").alias("reviews")).where(F.col("reviews") >= target)
