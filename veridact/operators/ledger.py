"""The ledger of rejections, its rollups, and tracing golden labels back to the gate that stopped them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import GATE_ORDER


def review_rows(rejected: DataFrame, gate: str) -> DataFrame:
    return rejected.where("reason is not null").select(
        F.lit(gate).alias("gate"), F.lit(GATE_ORDER[gate]).alias("gate_order"), "reason", F.lit("review").alias("unit"), F.col("review_id").cast("string").alias("subject"))


def claim_rows(judged: DataFrame) -> DataFrame:
    return judged.where("reason is not null").select(
        F.lit("sufficiency").alias("gate"), F.lit(GATE_ORDER["sufficiency"]).alias("gate_order"), "reason", F.lit("claim").alias("unit"), F.col("claim_id").alias("subject"))


def rollup(ledger: DataFrame) -> DataFrame:
    """Rows by gate and reason, by gate, and in all."""
    return ledger.rollup("gate", "reason").agg(F.count("*").alias("n"))


def stopped_twice(ledger: DataFrame) -> DataFrame:
    """Subjects with more than one row of a unit; callers assert that there are none."""
    return ledger.groupBy("unit", "subject").agg(F.count("*").alias("n")).where("n > 1")


def trace(targets: DataFrame, judged: DataFrame, sizes: DataFrame, aspects: list[str] | None = None) -> DataFrame:
    """targets (key, product_id, axis, segment, aspect, want) with outcome, gate, reason and direction_match.

    judged: the sufficiency gate's claims with direction; sizes: cells with their authors. The
    outcomes are untraceable (an aspect outside `aspects`, or null; or an option scope that can't be
    resolved, marked in a column scope_violation), no_candidate (empty_cell, no_tagged_mention),
    rejected (the gate's reason), produced.
    """
    cell = ["product_id", "axis", "segment"]
    rows = targets.join(sizes, cell, "left").join(judged.select(*cell, "aspect", "reason", "direction", F.lit(True).alias("found")), [*cell, "aspect"], "left")
    scope = F.col("scope_violation") if "scope_violation" in targets.columns else F.lit(None).cast("string")
    outside = F.lit(False) if aspects is None else ~F.coalesce(F.col("aspect").isin(aspects), F.lit(False))
    lost = F.when(scope.isNotNull(), "unknown_option").when(outside, "aspect_outside_taxonomy")
    outcome = F.when(lost.isNotNull(), "untraceable").when(F.col("found").isNull(), "no_candidate").when(F.col("reason").isNotNull(), "rejected").otherwise("produced")
    reason = F.when(lost.isNotNull(), lost).when(F.col("cell_authors").isNull(), "empty_cell").when(F.col("found").isNull(), "no_tagged_mention").otherwise(F.col("reason"))
    gate = F.when(reason.isin("empty_cell", "unknown_option"), "identity").when(reason == "no_tagged_mention", "polarity").when(outcome == "rejected", "sufficiency")
    return rows.select("key", outcome.alias("outcome"), gate.alias("gate"), reason.alias("reason"), F.when(outcome == "produced", F.col("direction") == F.col("want")).alias("direction_match"))


def fates(evidence: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """evidence (key, review_id) with fate: kept, the gate and reason that stopped the review, or unknown.

    first, second: the identity and duplicate gates' rows with review_id and reason.
    """
    one = first.select("review_id", F.col("reason").alias("_first"), F.lit(True).alias("_known"))
    two = second.select("review_id", F.col("reason").alias("_second"))
    rows = evidence.join(one, "review_id", "left").join(two, "review_id", "left")
    fate = (
        F.when(F.col("_known").isNull(), "unknown").when(F.col("_first").isNotNull(), F.concat(F.lit("identity/"), "_first"))
        .when(F.col("_second").isNotNull(), F.concat(F.lit("duplicate/"), "_second")).otherwise("kept")
    )
    return rows.select("key", "review_id", fate.alias("fate"))


def recall(traced: DataFrame) -> DataFrame:
    """One row: targets, those that can be traced, produced, their share of the traceable, and direction mismatches."""
    produced = F.count(F.when(F.col("outcome") == "produced", 1))
    traceable = F.count(F.when(F.col("outcome") != "untraceable", 1))
    return traced.agg(
        F.count("*").alias("targets"), traceable.alias("traceable"), produced.alias("produced"), F.round(produced / F.nullif(traceable, F.lit(0)), 4).alias("recall"),
        F.count(F.when(F.col("direction_match") == F.lit(False), 1)).alias("direction_mismatches"),
    )


def misses(traced: DataFrame) -> DataFrame:
    """(gate, reason, n) of targets that can be traced and weren't produced, and of the untraceable (gate may be null)."""
    return traced.where("outcome <> 'produced'").groupBy("outcome", "gate", "reason").agg(F.count("*").alias("n"))
