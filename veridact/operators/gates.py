"""The identity, duplicate and sufficiency gates. Rejections are rows with a reason."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import minority
from ..functions.text import month_of
from ..schemas import ContractError, SufficiencyPolicy
from .shared import cut_lineage, linked, scratch_path, spread


def identity_gate(reviews: DataFrame, products: DataFrame, cutoff: Column | str, option: Column | None = None) -> DataFrame:
    """reviews with month, reason (null: passed), detail and limitation.

    One reason at most, in this order: product, renewal range, recency, option. Products are a
    dimension. option is the shade key that the scope asks for; then reviews carry shade_key and kind
    (null kind: no option stated): a stated one that differs, packs included, is a mismatch.
    """
    cutoff = F.lit(cutoff) if isinstance(cutoff, str) else cutoff
    month = F.col("month")
    joined = reviews.withColumn("month", month_of(F.col("review_date"))).join(products, "product_id", "left")
    known = F.col("renewal_policy").isNotNull()
    inside = (F.col("from_month").isNull() | (month >= F.col("from_month"))) & (F.col("to_month").isNull() | (month <= F.col("to_month")))
    reason = (
        F.when(~known, "product_mismatch").when((F.col("renewal_policy") == "separate") & ~inside, "renewal_cut").when(month < cutoff, "recency_cut")
    )
    if option is not None:
        reason = reason.when(F.col("kind").isNull(), "option_unstated").when(F.coalesce(F.col("shade_key") != option, F.lit(True)), "option_mismatch")
    limit = F.when(reason.isNull() & (F.col("renewal_policy") == "unobserved"), "renewal_unobserved")
    detail = F.when(reason == "renewal_cut", F.format_string("%s outside %s..%s", month, F.coalesce("from_month", F.lit("")), F.coalesce("to_month", F.lit("")))).when(
        reason == "recency_cut", F.format_string("%s before %s", month, cutoff))
    return joined.withColumn("reason", reason).withColumn("detail", detail).withColumn("limitation", limit).drop("renewal_policy", "from_month", "to_month")


#: Rounds of peeling before what is still open is looked at by connected component, and the rows of a component
#: that one task walks; larger ones go on peeling.
ROUNDS, FOLD = 6, 100_000


def _walked(rows: DataFrame) -> DataFrame:
    """rows (g, rank, c, a, root) that the walk by rank keeps, for components of at most FOLD rows, each in one task."""

    def keep(table: pa.Table) -> pa.Table:
        t = table.sort_by("rank")
        contents, authors, stays = set(), set(), []
        for c, a in zip(t["c"].to_pylist(), t["a"].to_pylist()):
            stays.append(c not in contents and a not in authors)
            if stays[-1]:
                contents.add(c)
                authors.add(a)
        return t.select(["g", "rank", "c", "a"]).filter(pa.array(stays, pa.bool_()))

    columns = ["g", "rank", "c", "a"]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    return rows.select(*columns, "root").groupBy("root").applyInArrow(keep, kinds)


def _peeled(rows: DataFrame, keep: Callable[[DataFrame], None]) -> DataFrame:
    """One round: rows (g, rank, c, a) that are first for both keys are kept, rows that share a key with them are decided; the rest."""
    first_c = cut_lineage(rows.groupBy("g", "c").agg(F.min("rank").alias("rc")))
    first_a = cut_lineage(rows.groupBy("g", "a").agg(F.min("rank").alias("ra")))
    won = cut_lineage(rows.join(first_c, ["g", "c"]).join(first_a, ["g", "a"]).where("rank = rc and rank = ra").select("g", "rank", "c", "a"))
    keep(won)
    return cut_lineage(rows.join(won.select("g", "c"), ["g", "c"], "left_anti").join(won.select("g", "a"), ["g", "a"], "left_anti"))


def duplicate_gate(ranked: DataFrame, group: str = "product_id", content: str = "content_hash", author: str = "author") -> DataFrame:
    """(group, rank, reason, kept_rank): the walk by rank that keeps a row if neither its content nor
    its author is among those kept before; null reason: kept. kept_rank is the keeper.

    Done by peeling: rows that rank first for their content and their author are kept, rows that
    share a key with a kept row are decided, and the rest goes round again. Each round costs pre-aggregated minima and
    joins on tables in the shared folder. Long chains would need many rounds, so after ROUNDS of them the open rows'
    connected components (by their keys) are walked, a component a task; only components beyond FOLD rows go on peeling.
    Keys are compared whole. Null groups, ranks, contents or authors raise ContractError (dedup_key_violations() names
    the rows); an empty table gives an empty result.
    """
    open_rows = cut_lineage(ranked.select(F.col(group).alias("g"), "rank", F.col(content).alias("c"), F.col(author).alias("a")))
    if not open_rows.where("g is null or rank is null or c is null or a is null").isEmpty():
        raise ContractError("rows without product, rank, content hash or author can't be told apart")
    spark = ranked.sparkSession
    kept_at, schema = scratch_path(spark), open_rows.schema
    keep = lambda won: won.select("g", "rank", "c", "a").write.mode("append").parquet(kept_at)
    keep(open_rows.where("false"))  # one table whatever the rounds, so that the plan doesn't grow
    for _ in range(ROUNDS):
        open_rows = _peeled(open_rows, keep)
        if open_rows.isEmpty():
            break
    while not open_rows.isEmpty():
        node = F.struct("g", "rank")
        hub = lambda k: open_rows.join(cut_lineage(open_rows.groupBy("g", k).agg(F.min("rank").alias("h"))), ["g", k]).select(node.alias("u"), F.struct("g", F.col("h").alias("rank")).alias("v"))
        named = linked(hub("c").union(hub("a")))
        placed = open_rows.join(named.select(F.col("node.g").alias("g"), F.col("node.rank").alias("rank"), "root"), ["g", "rank"], "left")
        placed = cut_lineage(placed.withColumn("root", F.coalesce("root", node)))
        sizes = cut_lineage(placed.groupBy("root").agg(F.count("*").alias("n")))
        small = placed.join(sizes, "root")
        keep(_walked(small.where(F.col("n") <= FOLD)))
        open_rows = cut_lineage(small.where(F.col("n") > FOLD).select("g", "rank", "c", "a"))
        for _ in range(ROUNDS):
            if open_rows.isEmpty():
                break
            open_rows = _peeled(open_rows, keep)
    kept = spark.read.schema(schema).parquet(kept_at)
    by_c, by_a = kept.select("g", "c", F.col("rank").alias("kc")), kept.select("g", "a", F.col("rank").alias("ka"))
    rows = ranked.select(F.col(group).alias("g"), "rank", F.col(content).alias("c"), F.col(author).alias("a"))
    judged = rows.join(by_c, ["g", "c"], "left").join(by_a, ["g", "a"], "left")
    reason = F.when(F.col("kc") < F.col("rank"), "duplicate_content").when(F.col("ka") < F.col("rank"), "same_author")
    keeper = F.when(reason == "duplicate_content", F.col("kc")).when(reason == "same_author", F.col("ka"))
    return judged.select(F.col("g").alias(group), "rank", reason.alias("reason"), keeper.alias("kept_rank"))


def sufficiency_gate(claims: DataFrame, policy: SufficiencyPolicy = SufficiencyPolicy()) -> DataFrame:
    """claims (pos, neg, neu, spoke, cell_authors) with support, share, silent, reason and limitation.

    Rows with support > spoke or spoke > cell_authors break the invariant and carry the reason
    invariant_broken; callers assert that there are none.
    """
    u, d, s = F.col("pos") + F.col("neg"), F.col("spoke"), F.col("cell_authors")
    low = minority(F.col("pos"), F.col("neg"))
    reason = (
        F.when((u > d) | (d > s), "invariant_broken").when(s < policy.s_min, "segment_too_small")
        .when(u < policy.n_min, "insufficient_support").when(u / d < policy.r_min, "minority_share")
    )
    return (
        claims.withColumn("support", u).withColumn("share", F.round(F.coalesce(u / F.nullif(d, F.lit(0)), F.lit(0.0)), 4))
        .withColumn("silent", s - d).withColumn("reason", reason)
        .withColumn("limitation", F.when(reason.isNull() & (low > 0) & (low < policy.minority_min), "single_dissent"))
    )


def dedup_key_violations(rows: DataFrame) -> DataFrame:
    """(review_id, violation): rows that the duplicate gate can't judge for want of author, content hash or score."""
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    checks = {"no_author": blank("author"), "no_content_hash": blank("content_hash"), "no_trust_score": F.col("trust_score").isNull() | F.isnan("trust_score")}
    return rows.select("review_id", F.explode(F.filter(F.array(*[F.when(c, n) for n, c in checks.items()]), F.isnotnull)).alias("violation"))


def stance_overlaps(said: DataFrame) -> DataFrame:
    """(product_id, axis, segment, aspect, author, stances): authors on several sides of one cell and aspect.

    said: cells joined with tags. The duplicate gate's survivors have none.
    """
    keys = ["product_id", "axis", "segment", "aspect", "author"]
    said = cut_lineage(said.select(*keys, "polarity"))
    return spread(said, said.count(), *keys).distinct().groupBy(*keys).agg(F.count("*").cast("int").alias("stances")).where("stances > 1")


def authors_outside(said: DataFrame, member: DataFrame) -> DataFrame:
    """Authors who spoke for a cell (said) without being in it (member); there must be none."""
    keys = ["product_id", "axis", "segment", "author"]
    return said.select(*keys).distinct().join(member.select(*keys).distinct(), keys, "left_anti")


def silent_cells(sizes: DataFrame, policy: SufficiencyPolicy = SufficiencyPolicy()) -> DataFrame:
    """Cells with too few authors to speak for, of which no claim is made."""
    return sizes.where(F.col("cell_authors") < policy.s_min)


def parity_violations(support: DataFrame, claims: DataFrame) -> DataFrame:
    """Cells and aspects whose counts by review (polarity gate) and by author (sufficiency gate) differ.

    Both have pos, neg, neu, silent. On the duplicate gate's survivors a review is an author.
    """
    keys = ["product_id", "axis", "segment", "aspect"]
    counts = ["pos", "neg", "neu", "silent"]
    rows = support.select(*keys, *[F.col(c).alias(f"_{c}") for c in counts]).join(claims.select(*keys, *counts), keys, "full_outer")
    differ = [F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), c) for c in counts]
    return rows.select(*keys, F.explode(F.filter(F.array(*differ), F.isnotnull)).alias("count"))
