"""Option strings to shade keys, with what a product's whole corpus of options says about wrappers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nfc, strip
from ..schemas import PROMO_TOKENS, UNIT_TOKENS
from .shared import cut_lineage

# Patterns of bracket groups, volumes, numbers and non-word characters (fixed values).
_GROUP = r"[\[(]([^\])]*)[\])]?"
_VOLUME = rf"(?U)\d+\s*(?:{'|'.join(UNIT_TOKENS)})\b|\d+\s*[*x×]\s*\d+"
_PROMO = "(?i)" + "|".join(PROMO_TOKENS)
_NON_WORD = "[^0-9A-Za-z가-힣]+"
_NUMBER = r"(?s)^(\d{1,3})\s*호?\s*(\D.*)$"


def _clean(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, _VOLUME, " "), _NON_WORD, " "))


def is_promo(group: Column) -> Column:
    return F.trim(group).startswith("+") | group.rlike(_PROMO) | (_clean(group) == "")


def core(rows: DataFrame, text: Column) -> DataFrame:
    """rows with number and name of a text; null name: nothing but promotion and volume.

    Each pattern is searched once: the stages are columns of their own, which go at the end.
    """
    rows = rows.withColumn("_bare", F.regexp_replace(F.split(text, r"\+")[0], _PROMO, " ")).withColumn("_bare", _clean(F.col("_bare")))
    rows = rows.withColumn("_n", F.regexp_extract("_bare", _NUMBER, 1)).withColumn("_name", F.when(F.col("_n") != "", F.regexp_extract("_bare", _NUMBER, 2)).otherwise(F.col("_bare")))
    number = F.regexp_replace(F.nullif("_n", F.lit("")), "^0+(?=.)", "")
    return rows.withColumn("number", number).withColumn("name", F.nullif(F.regexp_replace("_name", r"\s+", ""), F.lit(""))).drop("_bare", "_n", "_name")


def parse(forms: DataFrame) -> DataFrame:
    """forms (product_id, option, reviews) with option stripped, kept groups, rest and the core of the rest."""
    text = strip(nfc(F.col("option")))
    rows = forms.groupBy("product_id", text.alias("option")).agg(F.sum("reviews").alias("reviews")).where(F.coalesce(F.col("option"), F.lit("")) != "")
    groups = F.regexp_extract_all("option", F.lit(_GROUP), 1)
    rows = rows.withColumn("kept", F.filter(groups, lambda g: ~is_promo(g))).withColumn("rest", F.regexp_replace("option", _GROUP, ""))
    return core(rows, F.col("rest")).withColumnRenamed("name", "bare").drop("number")


def wrappers(parsed: DataFrame) -> DataFrame:
    """(product_id, word) of groups that wrap: met with two bare names or more (none counts as one),
    or such that without them a bare name already known remains."""
    each = parsed.select("product_id", "option", "bare", F.explode(F.transform("kept", lambda g: F.trim(g))).alias("word"))
    names = F.count_distinct(F.coalesce("bare", F.lit("\u0000")))
    first = each.groupBy("product_id", "word").agg(names.alias("n")).where("n >= 2").select("product_id", "word")
    extra = each.join(first, ["product_id", "word"], "left_anti")
    plain = parsed.join(extra.select("product_id", "option").distinct(), ["product_id", "option"], "left_anti")
    known = plain.where("bare is not null").select("product_id", "bare").distinct()
    second = extra.join(known, ["product_id", "bare"], "left_semi").select("product_id", "word")
    return first.union(second).distinct()


def index(reviews: DataFrame) -> DataFrame:
    """(product_id, option, reviews, kind, shade_key) of every option string in use."""
    forms = cut_lineage(parse(reviews.groupBy("product_id", "option").agg(F.count("*").alias("reviews"))))
    drop = wrappers(forms).groupBy("product_id").agg(F.collect_set("word").alias("drop"))  # a product's vocabulary
    kept = F.filter("kept", lambda g: ~F.array_contains(F.coalesce("drop", F.array().cast("array<string>")), F.trim(g)))
    keyed = forms.join(drop, "product_id", "left").withColumn("whole", F.concat_ws(" ", F.concat(kept, F.array("rest"))))
    keyed = cut_lineage(core(keyed, F.col("whole")).select("product_id", "option", "reviews", "number", "name"))
    single = (
        keyed.where("number is not null").groupBy("product_id", "name").agg(F.count_distinct("number").alias("n"), F.min("number").alias("only"))
        .where("n = 1").select("product_id", "name", "only")
    )
    found = keyed.join(single, ["product_id", "name"], "left")
    number = F.coalesce("number", "only")
    key = F.when(F.col("name").isNotNull(), F.when(number.isNotNull(), F.concat_ws("|", number, "name")).otherwise(F.col("name")))
    return found.select("product_id", "option", "reviews", F.when(key.isNull(), "pack").otherwise("shade").alias("kind"), key.alias("shade_key"))


def shade_counts(indexed: DataFrame) -> DataFrame:
    return indexed.where("shade_key is not null").groupBy("product_id", "shade_key").agg(F.sum("reviews").alias("reviews"), F.count("*").alias("forms"))


def shade_axes(shades: DataFrame) -> DataFrame:
    """Products with a choice of shades: two keys or more."""
    return shades.groupBy("product_id").agg(F.count("*").alias("shades")).where("shades >= 2")


def resolve_scopes(scopes: DataFrame, indexed: DataFrame) -> DataFrame:
    """scopes (product_id, option) with shade_key and violation: unknown_option where the product's reviews
    never show it, pack_option where it names no shade. indexed: index()."""
    rows = scopes.withColumn("_o", strip(nfc(F.col("option")))).join(indexed.select("product_id", F.col("option").alias("_o"), "kind", "shade_key"), ["product_id", "_o"], "left")
    bad = F.when(F.col("kind").isNull(), "unknown_option").when(F.col("kind") != "shade", "pack_option")
    return rows.select("product_id", "option", "shade_key", bad.alias("violation"))
