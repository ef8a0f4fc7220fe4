"""Lineages of products: generations in order, the current one, and catalogs that don't hold together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ContractError
from .contracts import overlapping_ranges


def generations(products: DataFrame) -> DataFrame:
    """products (product_id, lineage_id, from_month, requested_goods_no) with generation (1 is the
    oldest), current and previous. The generation with a requested goods number is the one on sale."""
    line = Window.partitionBy("lineage_id")  # a lineage has a handful of generations
    age = line.orderBy(F.coalesce("from_month", F.lit("")), "product_id")
    current = F.col("requested_goods_no").isNotNull()
    return (
        products.withColumn("generation", F.row_number().over(age)).withColumn("current", current)
        .withColumn("on_sale", F.count(F.when(current, 1)).over(line)).withColumn("previous", ~current & (F.col("on_sale") == 1))
    )


def catalog_violations(products: DataFrame, bridge: DataFrame) -> DataFrame:
    """(subject, violation) of a catalog.

    products: product_id, lineage_id, renewal_policy, requested_goods_no; bridge: goods_no,
    product_id, from_month, to_month. Lineages of several generations must be 'separate' and have one
    on sale; goods numbers are shared inside a lineage only, between ranges that are not both open
    and don't overlap.
    """
    lines = products.groupBy("lineage_id").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("renewal_policy") != "separate", 1)).alias("joint"), F.count("requested_goods_no").alias("on_sale"))
    joint = lines.where("n > 1 and joint > 0").select(F.col("lineage_id").alias("subject"), F.lit("generations_not_separate").alias("violation"))
    sale = lines.where("on_sale <> 1").select("lineage_id", F.lit("not_one_on_sale"))
    owners = bridge.join(products.select("product_id", "lineage_id"), "product_id")
    shared = owners.groupBy("goods_no").agg(F.count("*").alias("n"), F.count_distinct("lineage_id").alias("lines"), F.count(F.when(F.col("from_month").isNull() & F.col("to_month").isNull(), 1)).alias("open"))
    across = shared.where("lines > 1").select("goods_no", F.lit("shared_across_lineages"))
    wide = shared.where("n > 1 and open > 0").select("goods_no", F.lit("shared_with_open_range"))
    meet = overlapping_ranges(bridge).select("goods_no", F.lit("overlapping_ranges")).distinct()
    return joint.union(sale).union(across).union(wide).union(meet)


def product_list(rows: DataFrame) -> DataFrame:
    """Products to crawl (goods_no, ...) as given; an empty list or a row without a goods number raises."""
    n = rows.agg(F.count("*").alias("n"), F.count(F.when(F.coalesce(F.trim("goods_no"), F.lit("")) == "", 1)).alias("bad")).first()
    if not n.n or n.bad:
        raise ContractError("a product list is not empty and has a goods number in every row")
    return rows


def canonical_run(manifests: DataFrame, input_sha256: str) -> DataFrame:
    """The one complete run (not a pilot) over the input with this digest; none or several raise.

    manifests: run_id, complete boolean, pilot boolean, input_sha256; a small table, of which two rows are looked at.
    """
    fit = manifests.where("complete and not pilot").where(F.col("input_sha256") == input_sha256)
    if len(fit.select("run_id").limit(2).collect()) != 1:
        raise ContractError("exactly one complete run over this input is needed")
    return fit


def run_catalog(crawled: DataFrame, product_id: str = "p001") -> DataFrame:
    """(product_id, goods_no, rows, renewal_policy): every goods number of a crawl as one product whose renewals nobody observed."""
    goods = crawled.where(F.coalesce(F.trim("goods_no"), F.lit("")) != "").groupBy("goods_no").agg(F.count("*").alias("rows"))
    return goods.select(F.lit(product_id).alias("product_id"), "goods_no", "rows", F.lit("unobserved").alias("renewal_policy"))
