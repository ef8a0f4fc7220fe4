"""The registry of rejection reasons, and the taxonomy of failures with its order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FAILURES, GATE_ORDER, REJECT_LABELS, REJECT_REASONS, RESERVED_REASONS, SEVERITIES, ContractError


def reasons(spark) -> DataFrame:
    """(gate, reason, label, active) of every registered reason: a dimension."""
    rows = [(g, r, REJECT_LABELS[r], r not in RESERVED_REASONS) for g, own in REJECT_REASONS.items() for r in own]
    return spark.createDataFrame(rows, "gate string, reason string, label string, active boolean")


def registry_violations(ledger: DataFrame) -> DataFrame:
    """ledger (gate, reason, subject) rows that may not be written, with violation.

    unknown_gate, unknown_reason, gate_rejects_nothing (polarity has no reasons), wrong_gate, and
    reserved_reason for one that is registered but not applied yet. Null counts as unknown.
    """
    book = reasons(ledger.sparkSession).select("reason", F.col("gate").alias("_own"), "active")
    empty = [g for g in GATE_ORDER if not REJECT_REASONS[g]]
    rows = ledger.join(F.broadcast(book), "reason", "left")  # a dozen rows, fixed in schemas.py
    bad = (
        F.when(~F.coalesce(F.col("gate").isin(*GATE_ORDER), F.lit(False)), "unknown_gate").when(F.col("gate").isin(*empty), "gate_rejects_nothing")
        .when(F.col("_own").isNull(), "unknown_reason").when(F.col("_own") != F.col("gate"), "wrong_gate").when(~F.col("active"), "reserved_reason")
    )
    return rows.withColumn("violation", bad).where("violation is not null").select("gate", "reason", "subject", "violation")


@dataclass(frozen=True)
class Taxonomy:
    """Failure types as (key, severity, order), and the severities from worst to least."""

    version: str = "failure-taxonomy-v1"
    severities: tuple[str, ...] = SEVERITIES
    types: tuple[tuple[str, str, int], ...] = FAILURES

    def __post_init__(self):
        keys = [k for k, _, _ in self.types]
        if not self.version.strip() or not self.severities or not keys:
            raise ContractError("a taxonomy needs a version, severities and types")
        if len(set(keys)) != len(keys):
            raise ContractError("a failure type is there twice")
        if any(s not in self.severities for _, s, _ in self.types):
            raise ContractError("a failure type has an unknown severity")

    @property
    def ordered(self) -> list[str]:
        return [k for k, _, _ in sorted(self.types, key=lambda t: (self.severities.index(t[1]), t[2]))]


def sort_failures(keys: Column, taxonomy: Taxonomy = Taxonomy()) -> Column:
    """An array of failure keys by severity, then order; repeats stay, unknown keys go to the end by name."""
    place = F.create_map(*[x for i, k in enumerate(taxonomy.ordered) for x in (F.lit(k), F.lit(i))])
    last = len(taxonomy.types)
    ranked = F.transform(keys, lambda k: F.struct(F.coalesce(place[k], F.lit(last)).alias("p"), k.alias("k")))
    return F.transform(F.array_sort(ranked), lambda x: x["k"])
