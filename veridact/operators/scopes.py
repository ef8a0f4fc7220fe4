"""Labels traced inside option scopes: the gates as they would run over one product's reviews of one shade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import direction
from ..schemas import NoisePolicy, SufficiencyPolicy
from . import claims, gates, ledger, options, polarity
from .shared import cut_lineage


def scope_id(product: Column, shade: Column) -> Column:
    """A product under a shade (null: under none) as one text; the separator is in neither."""
    return F.concat(product, F.lit("\u001f"), F.coalesce(shade, F.lit("")))


def resolved(targets: DataFrame, indexed: DataFrame) -> DataFrame:
    """targets (key, product_id, option, ...) with shade_key, scope_violation and scope.

    A null option asks for the whole product. An option that the product's reviews never show, or that names no shade, is a violation.
    """
    asked = targets.where("option is not null").select("product_id", "option").distinct()
    found = options.resolve_scopes(asked, indexed).withColumnRenamed("violation", "scope_violation")
    shade = F.when(F.col("scope_violation").isNull(), F.col("shade_key"))
    return targets.join(found, ["product_id", "option"], "left").withColumn("shade_key", shade).withColumn("scope", F.when(F.col("scope_violation").isNull(), scope_id(F.col("product_id"), F.col("shade_key"))))


def fan_out(passed: DataFrame, asked: DataFrame) -> DataFrame:
    """Rows that passed the identity gate, once for each scope that labels ask for and that they are in, with scope.

    A review has one shade, so it is in two scopes at most: its product's and its shade's. asked: distinct (product_id, shade_key).
    """
    whole = passed.join(asked.where("shade_key is null").select("product_id"), "product_id", "left_semi").withColumn("scope", scope_id(F.col("product_id"), F.lit(None)))
    shaded = passed.join(asked.where("shade_key is not null"), ["product_id", "shade_key"], "left_semi").withColumn("scope", scope_id(F.col("product_id"), F.col("shade_key")))
    return whole.unionByName(shaded)


def replay(rows: DataFrame, tags: DataFrame, policy: SufficiencyPolicy = SufficiencyPolicy(), noise: NoisePolicy = NoisePolicy()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(duplicate gate's rows, judged claims with limitations, cell sizes), all scopes at once, keyed by scope in product_id.

    rows: fan_out() with rank, a total order within each product. Scopes overlap, and a review may be kept in one and fall
    to another review in the other; one peel decides them all, as keys of different scopes never meet.
    """
    rows = rows.withColumn("product_id", F.col("scope"))
    second = cut_lineage(gates.duplicate_gate(rows).join(rows, ["product_id", "rank"]))
    member = cut_lineage(claims.cells(second.where("reason is null").drop("reason", "kept_rank")))
    cell = ["product_id", "axis", "segment"]
    judged = gates.sufficiency_gate(claims.candidates(member, tags), policy).withColumn("direction", direction(F.col("pos"), F.col("neg")))
    said = polarity.aspect_support(member, tags, cell, noise).select(*cell, "aspect", F.col("limitations").alias("_said"))
    return second, cut_lineage(judged.join(said, [*cell, "aspect"], "left")), cut_lineage(claims.cell_sizes(member))


def trace(targets: DataFrame, evidence: DataFrame, first: DataFrame, tags: DataFrame, indexed: DataFrame, aspects: list[str], policy: SufficiencyPolicy = SufficiencyPolicy()) -> tuple[DataFrame, DataFrame]:
    """What the gates make of labels, each in its own scope, and what became of the reviews that they cite.

    targets: key, product_id, axis, segment, aspect, want, option (null: the whole product). evidence: key, review_id.
    first: the identity gate's rows without an option, with rank where they passed, shade_key and kind (null: no option
    stated). indexed: options.index(). Returns (key, outcome, gate, reason, direction, direction_match, limitations) and (key,
    review_id, fate); labels whose scope can't be resolved have no fates, as the gates never ran for them.
    Defined cases: labels with equal scopes share one run; repeated evidence stays repeated; a review that isn't the product's or isn't
    known is identity/out_of_scope; empty tables give empty results.
    """
    asked = cut_lineage(resolved(targets, indexed))
    scopes = asked.where("scope is not null").select("product_id", "shade_key").distinct()
    rows = cut_lineage(fan_out(first.where("reason is null").drop("reason", "detail"), scopes))
    second, judged, sizes = replay(rows.drop("limitation"), tags, policy)
    own = asked.select("key", F.col("scope").alias("product_id"), "axis", "segment", "aspect", "want", "scope_violation")
    traced = ledger.trace(own, judged, sizes, aspects)
    cell = ["product_id", "axis", "segment"]
    limits = rows.groupBy("scope").agg(F.array_sort(F.collect_set("limitation")).alias("_identity"))  # a few fixed names
    none = F.array().cast("array<string>")
    found = own.join(limits, own["product_id"] == limits["scope"], "left").join(judged.select(*cell, "aspect", F.col("direction"), F.col("_said"), F.col("limitation").alias("_last")), [*cell, "aspect"], "left")
    every = F.concat(F.coalesce("_identity", none), F.coalesce(F.split("_said", ","), none), F.array("_last"))
    named = F.array_sort(F.array_distinct(F.filter(every, lambda x: x.isNotNull() & (x != ""))))
    rest = found.select("key", "direction", named.alias("_limits"))
    silent = F.col("outcome").isin("untraceable") | (F.col("reason") == "empty_cell")
    result = traced.join(rest, "key").select(
        "key", "outcome", "gate", "reason", F.when(F.col("outcome") != "untraceable", F.col("direction")).alias("direction"), "direction_match", F.when(F.coalesce(silent, F.lit(False)), none).otherwise(F.col("_limits")).alias("limitations"))
    return result, fates(evidence, asked, first, second)


def fates(evidence: DataFrame, asked: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """evidence (key, review_id) with fate: kept, or the gate and the reason that stopped the review in its label's scope."""
    wanted = asked.where("scope is not null").select("key", "product_id", "scope", F.col("shade_key").alias("_want"))
    one = first.select("review_id", F.col("product_id").alias("_product"), F.col("reason").alias("_first"), "kind", F.col("shade_key").alias("_shade"))
    two = second.select("review_id", F.col("product_id").alias("scope"), F.col("reason").alias("_second"))
    rows = evidence.join(wanted, "key").join(one, "review_id", "left").join(two, ["review_id", "scope"], "left")
    scoped = F.col("_want").isNotNull()
    fate = (
        F.when(~F.col("_product").eqNullSafe(F.col("product_id")), "identity/out_of_scope").when(F.col("_first").isNotNull(), F.concat(F.lit("identity/"), "_first"))
        .when(scoped & F.col("kind").isNull(), "identity/option_unstated").when(scoped & ~F.col("_shade").eqNullSafe(F.col("_want")), "identity/option_mismatch")
        .when(F.col("_second").isNotNull(), F.concat(F.lit("duplicate/"), "_second")).otherwise("kept")
    )
    return rows.select("key", "review_id", fate.alias("fate"))
