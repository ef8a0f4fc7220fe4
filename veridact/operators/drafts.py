"""From passed claims to claim rows: targets with their reviews, drafts of a model, gated payloads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CLAIM_SCHEMA, DRAFT_EVIDENCE_FIELDS, DRAFT_FIELDS, UNSTATED, ContractError
from .registry import Taxonomy, sort_failures

#: Wording that asserts a skin condition (fixed values).
CONDITION_WORDS = "건성|지성|복합성|민감성|약건성|중성|트러블성|트러블 피부|여드름성|잡티|모공|주름|각질|블랙헤드|미백"
ASSERTING = "인데|이라|이라서|라서|인 사람|이신 분"


def targets(passed: DataFrame, member: DataFrame) -> DataFrame:
    """(claim_id, product_id, axis, segment, aspect, review_id) of every review in a passed claim's cell.

    member: claims.cells() of the duplicate gate's survivors. Cells meet by an equi-join.
    """
    cell = ["product_id", "axis", "segment"]
    return passed.select("claim_id", *cell, "aspect").join(member.select(*cell, "review_id"), cell).select("claim_id", *cell, "aspect", "review_id")


def chosen(passed: DataFrame, products: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Targets of the products asked for, the first `limit` by claim id. An unknown product raises."""
    if products is not None:
        known = {r.product_id for r in passed.where(F.col("product_id").isin(products)).select("product_id").distinct().collect()}  # as many as were asked for, at most
        if set(products) - known:
            raise ContractError(f"no passed claim of {sorted(set(products) - known)}")
        passed = passed.where(F.col("product_id").isin(products))
    passed = passed.orderBy("claim_id")
    return passed if limit is None else passed.limit(limit)


def asserts_condition(question: Column) -> Column:
    """Whether a question asserts a skin condition."""
    return F.coalesce(question.rlike(rf"({CONDITION_WORDS})\s*({ASSERTING})"), F.lit(False))


def draft_violations(drafts: DataFrame, json_col: str = "draft") -> DataFrame:
    """drafts (claim_id, axis, segment, draft as JSON) with violation and field; several are several rows.

    A model writes DRAFT_FIELDS and nothing else: numbers and directions come from the gates. A cell
    of those who stated nothing may not be asked about as a condition (missing_condition).
    """
    keys = F.json_object_keys(F.col(json_col))
    items = F.from_json(F.get_json_object(json_col, "$.evidence"), "array<string>")
    extra = F.array_distinct(F.flatten(F.transform(items, lambda e: F.array_except(F.coalesce(F.json_object_keys(e), F.array().cast("array<string>")), F.array(*map(F.lit, DRAFT_EVIDENCE_FIELDS))))))
    side = lambda kind, fields: F.transform(fields, lambda f: F.struct(F.lit(kind).alias("violation"), f.alias("field")))
    one = lambda kind, test: F.when(test, F.array(F.struct(F.lit(kind).alias("violation"), F.lit(None).cast("string").alias("field")))).otherwise(F.array().cast("array<struct<violation:string,field:string>>"))
    names = F.array(*map(F.lit, DRAFT_FIELDS))
    open_cell = (F.col("axis") == "product") | (F.col("segment") == UNSTATED)
    found = F.when(keys.isNull(), one("not_an_object", F.lit(True))).otherwise(F.concat(
        side("code_field", F.array_except(keys, names)), side("missing_field", F.array_except(names, keys)),
        one("no_evidence", F.array_contains(keys, "evidence") & (F.coalesce(F.size(items), F.lit(0)) <= 0)), side("unknown_evidence_field", F.coalesce(extra, F.array().cast("array<string>"))),
        one("missing_condition", open_cell & asserts_condition(F.get_json_object(json_col, "$.question")))))
    return drafts.select("claim_id", F.explode(found).alias("_v")).select("claim_id", "_v.violation", "_v.field")


def claim_rows(judged: DataFrame, drafts: DataFrame) -> DataFrame:
    """Claim rows: what the model wrote, beside numbers, direction and condition from the gates alone.

    judged: the sufficiency gate's passed claims with direction and limitation; drafts: claim_id,
    decision_axis, question, verdict, answer, evidence.
    """
    on = lambda axis: F.when(F.col("axis") == axis, F.array("segment"))
    condition = F.struct(on("skinType").alias("skinType"), on("skinTrouble").alias("skinTrouble"), F.lit(None).cast("string").alias("option"), F.lit(None).cast("string").alias("usagePeriod"))
    support = F.struct(F.col("pos").alias("positiveAuthors"), F.col("neg").alias("negativeAuthors"), F.col("neu").alias("neutralAuthors"), F.col("spoke").alias("spokeAuthors"),
                       F.col("silent").alias("silentAuthors"), F.col("support").alias("supportAuthors"), F.col("cell_authors").alias("cellAuthors"))
    none = F.array().cast("array<string>")
    return judged.join(drafts, "claim_id").select(
        F.lit(CLAIM_SCHEMA).alias("schema_version"), "claim_id", "product_id", "aspect", "decision_axis", "question", "verdict", "answer", condition.alias("condition"),
        F.when(F.col("axis") == "product", "unconditional").otherwise("conditional").alias("claim_type"), "direction", "evidence", support.alias("counts"), none.alias("rejected"),
        none.alias("failure_reasons"), F.lit(None).cast("string").alias("failure_reason"), F.filter(F.array("limitation"), F.isnotnull).alias("limitations"))


def round_trip_violations(claims: DataFrame, taxonomy: Taxonomy = Taxonomy()) -> DataFrame:
    """(claim_id, violation) of claim rows read back: version, failure keys and their order, type by condition.

    claims: claim_id, schema_version, failure_reasons array, failure_reason, claim_type, condition
    struct of arrays (null: the claim doesn't depend on the axis).
    """
    keys = F.coalesce("failure_reasons", F.array().cast("array<string>"))
    known = F.array(*map(F.lit, taxonomy.ordered))
    axes = [F.col(f"condition.{a}") for a in ("skinType", "skinTrouble")]
    derived = F.when(reduce(lambda a, b: a | b, [a.isNotNull() for a in axes]), "conditional").otherwise("unconditional")
    checks = {
        "schema_version": F.coalesce(F.col("schema_version") != CLAIM_SCHEMA, F.lit(True)), "unknown_failure": F.size(F.array_except(keys, known)) > 0,
        "failures_unsorted": sort_failures(keys, taxonomy) != keys, "failure_not_first": ~F.col("failure_reason").eqNullSafe(F.get(keys, F.lit(0))),
        "type_not_derived": ~F.col("claim_type").eqNullSafe(derived),
        "unstated_with_codes": reduce(lambda a, b: a | b, [F.coalesce(F.array_contains(a, UNSTATED) & (F.size(a) > 1), F.lit(False)) for a in axes]),
    }
    return claims.select("claim_id", F.explode(F.filter(F.array(*[F.when(c, n) for n, c in checks.items()]), F.isnotnull)).alias("violation"))


def payloads(claims: DataFrame, walked: DataFrame, outcomes: DataFrame) -> DataFrame:
    """claims (claim_id, answer) with outcome and payload: null where the quote gate discarded the claim, else the answer
    and the quotes that stay, as (review_id, quote_id), the claim's own first and then the spares taken, in order.

    walked, outcomes: quotes.walk() and quotes.outcomes(). Claims without any quote have no outcome and no payload.
    """
    kept = walked.where("kept_order is not null").groupBy("claim_id").agg(F.sort_array(F.collect_list(F.struct("kept_order", "review_id", "quote_id"))).alias("kept"))  # a claim's quotes: few
    rows = claims.join(outcomes.select("claim_id", "outcome"), "claim_id", "left").join(kept, "claim_id", "left")
    payload = F.struct(F.col("answer").alias("answer"), F.transform("kept", lambda k: F.struct(k["review_id"].alias("review_id"), k["quote_id"].alias("quote_id"))).alias("evidence"))
    return rows.select("claim_id", "outcome", F.when(F.col("outcome") != "discarded", payload).alias("payload"))


def generation_meta(results: DataFrame) -> DataFrame:
    """(axis, targets, produced, skipped, produced_percent) of results (claim_id, axis, skipped reason or null); null axis: all."""
    out = results.rollup("axis").agg(F.count("*").alias("targets"), F.count(F.when(F.col("skipped").isNull(), 1)).alias("produced"), F.count("skipped").alias("skipped"))
    return out.withColumn("produced_percent", F.round(100 * F.col("produced") / F.col("targets"), 2))


def skip_reasons(results: DataFrame) -> DataFrame:
    """(reason, n): what stands before the colon of a skipped target's reason."""
    return results.where("skipped is not null").groupBy(F.split("skipped", ":")[0].alias("reason")).agg(F.count("*").alias("n"))
