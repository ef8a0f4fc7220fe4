"""Conditions of claims: which reviews fit them, and how they read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import UNSTATED, ContractError

#: Wording of each axis (fixed values): suffix of a label, and the phrase for those who stated nothing.
SUFFIX = {"skinType": " 피부", "skinTrouble": " 고민", "option": " 옵션"}
UNSTATED_PHRASE = {"skinType": "피부타입을 안 밝힌 리뷰", "skinTrouble": "피부고민을 안 밝힌 리뷰", "option": "옵션을 안 밝힌 리뷰"}
UNCONDITIONAL = "조건 없음 (이 제품 리뷰 전체)"
CODE_JOIN, AXIS_JOIN, ARROW = "·", " · ", "→"


def fits(condition: dict[str, str | list[str] | None]) -> Column:
    """Whether a review (skin_type, troubles, option) lies in the cell of a condition.

    None leaves an axis open; the unstated segment is a segment of its own. Several codes are asked
    for together, which only skinTrouble can satisfy; lists on other axes raise.
    """
    single = {"skinType": F.col("skin_type"), "option": F.col("option")}
    test = F.lit(True)
    for axis, want in condition.items():
        if want is None:
            continue
        if axis == "skinTrouble":
            have = F.when(F.size("troubles") > 0, F.col("troubles")).otherwise(F.array(F.lit(UNSTATED)))
            wants = [want] if isinstance(want, str) else want
            test = test & (F.size(F.array_except(F.array(*map(F.lit, wants)), have)) == 0)
        elif axis not in single:
            raise ContractError(f"unknown condition axis {axis!r}")
        elif not isinstance(want, str):
            raise ContractError(f"{axis} has one value a review; split the cell instead")
        else:
            test = test & (F.coalesce(single[axis], F.lit(UNSTATED)) == want)
    return test


def axis_text(axis: str, codes: Column, labels: Column) -> Column:
    """Wording of one axis; codes and labels are arrays of the same order. Empty codes: null."""
    return F.when(F.array_contains(codes, UNSTATED), F.lit(UNSTATED_PHRASE[axis])).when(
        F.size(codes) > 0, F.concat(F.array_join(labels, CODE_JOIN), F.lit(SUFFIX[axis])))


def subject(parts: list[Column]) -> Column:
    """The condition as one phrase; never empty."""
    text = F.concat_ws(AXIS_JOIN, *parts)
    return F.when(text == "", F.lit(UNCONDITIONAL)).otherwise(text)


def sentence(condition: Column, answer: Column) -> Column:
    return F.concat_ws(f" {ARROW} ", condition, F.trim(answer))


def cell_subjects(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """cells (axis, segment, ...) with subject. labels (axis, code, label) is a codebook: a dimension
    of a few dozen rows. Codes that it lacks keep their own name."""
    book = labels.select("axis", F.col("code").alias("segment"), "label")
    rows = cells.join(book, ["axis", "segment"], "left").withColumn("_label", F.array(F.coalesce("label", "segment")))
    code = F.array("segment")
    text = F.lit(None).cast("string")
    for axis in SUFFIX:
        text = F.when(F.col("axis") == axis, axis_text(axis, code, F.col("_label"))).otherwise(text)
    return rows.withColumn("subject", subject([text])).drop("_label", "label")
