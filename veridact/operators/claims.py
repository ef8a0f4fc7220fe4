"""Condition cells, their distinct authors, and candidate claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import POLARITIES, UNSTATED
from .shared import cut_lineage, spread, tasks


def cell_list() -> Column:
    """The cells of a review, an array of (axis, segment): the product's, its skin type's, each trouble's."""
    named = lambda axis, c: F.struct(F.lit(axis).alias("axis"), c.alias("segment"))
    troubles = F.when(F.size("troubles") > 0, F.col("troubles")).otherwise(F.array(F.lit(UNSTATED)))
    own = F.array(named("product", F.lit("None")), named("skinType", F.coalesce("skin_type", F.lit(UNSTATED))))
    return F.concat(own, F.transform(F.array_distinct(troubles), lambda t: named("skinTrouble", t)))


def cells(reviews: DataFrame) -> DataFrame:
    """One row for each review and cell it belongs to."""
    return reviews.withColumn("cell", F.explode(cell_list())).withColumn("axis", F.col("cell.axis")).withColumn("segment", F.col("cell.segment")).drop("cell")


def told(reviews: DataFrame, tags: DataFrame) -> DataFrame:
    """reviews with said, an array of (aspect, polarity), null where a review has no tag.

    A review's cells and aspects make many rows of one (14 on the standard tables). Kept as arrays, they are
    shuffled and written once a review, and taken apart in the task that counts or ranks them (apart()).
    """
    return reviews.join(tags.groupBy("review_id").agg(F.collect_list(F.struct("aspect", "polarity")).alias("said")), "review_id", "left")


def apart(told: DataFrame, keep: list[str], cells: Column | None = None) -> DataFrame:
    """(keep, fields of cells, aspect, polarity): a row for each cell and aspect of a review."""
    rows = told.select(*keep, "said", F.inline(cell_list() if cells is None else cells))
    return rows.select(*[c for c in rows.columns if c != "said"], F.inline("said"))


def told_rows(told: DataFrame, cells: Column | None = None) -> int:
    """How many rows apart() makes."""
    return told.agg(F.sum(F.array_size(cell_list() if cells is None else cells).cast("long") * F.array_size("said"))).first()[0] or 0


def cell_sizes(member: DataFrame) -> DataFrame:
    return member.groupBy("product_id", "axis", "segment").agg(F.count_distinct("author").alias("cell_authors"))


def spoken(member: DataFrame, tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members, and what they said of each aspect, as tables in the shared folder: gates that count both read no review twice."""
    place = ["product_id", "axis", "segment"]
    member = cut_lineage(member.select(*place, "author", "review_id"))
    return member, cut_lineage(member.join(tags, "review_id").select(*place, "aspect", "author", "polarity"))


def candidates(member: DataFrame, tags: DataFrame) -> DataFrame:
    """Distinct authors of each stance for every cell and aspect someone spoke of, with the cell's size."""
    return counted(*spoken(member, tags))


def counted(member: DataFrame, said: DataFrame) -> DataFrame:
    """candidates() of spoken(). Both are tables and are counted first, so that tasks grow in number, not in size."""
    place = ["product_id", "axis", "segment"]
    said = spread(said, said.count(), *place, "aspect", "author")
    return _claims(said, spread(member.drop("review_id"), member.count(), *place, "author").distinct())


def _claims(said: DataFrame, member: DataFrame) -> DataFrame:
    """Both are dealt; members are distinct."""
    place = ["product_id", "axis", "segment"]
    cell = [*place, "aspect"]
    bit = {p: 1 << i for i, p in enumerate(POLARITIES)}
    stance = F.lit(0)
    for p in POLARITIES:
        stance = F.when(F.col("polarity") == p, bit[p]).otherwise(stance)
    each = said.groupBy(*cell, "author").agg(F.bit_or(stance).alias("_on"))  # one row an author: no row is expanded
    spoke = F.count("author").alias("spoke")
    n = lambda p, name: F.count(F.when((F.col("_on").bitwiseAND(bit[p]) > 0) & F.col("author").isNotNull(), 1)).alias(name)
    found = each.groupBy(*cell).agg(n("positive", "pos"), n("negative", "neg"), n("neutral", "neu"), spoke)
    return found.join(member.groupBy(*place).agg(F.count("author").alias("cell_authors")), place)


def told_candidates(told: DataFrame) -> DataFrame:
    """candidates() of told(), a table. Reviews are dealt by product and author, so an author's rows are made and counted in one task."""
    place = ["product_id", "axis", "segment"]
    dealt = lambda n, *more: told.select("product_id", "author", "skin_type", "troubles", *more).repartition(tasks(told.sparkSession, n), "product_id", "author")
    said = apart(dealt(told_rows(told), "said"), ["product_id", "author"])
    member = dealt(told.count()).select("product_id", "author", F.inline(cell_list()))
    return _claims(said, member.distinct())


def claim_id(product: str = "product_id", axis: str = "axis", segment: str = "segment", aspect: str = "aspect"):
    return F.concat(F.col(product), F.lit("|"), F.col(axis), F.lit("="), F.col(segment), F.lit("|"), F.col(aspect))
