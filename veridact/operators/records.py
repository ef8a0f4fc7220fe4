"""Closed-world ingest: fields of raw rows, condition codes, and the record in three layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_hash, month_of, nfc, sentiment_prior, strip
from ..schemas import CODE_PREFIX, DROPPED_FIELDS, RAW_FIELDS, UNSTATED

KNOWN_FIELDS = ("reviewId", *RAW_FIELDS, *DROPPED_FIELDS)


def fields_found(json: Column, known: tuple[str, ...] = KNOWN_FIELDS) -> Column:
    """array<struct<violation,field>> of one JSON object as text, as in field_violations."""
    names = F.array(*map(F.lit, known))
    keys = F.json_object_keys(json)
    side = lambda kind, fields: F.transform(fields, lambda f: F.struct(F.lit(kind).alias("violation"), f.alias("field")))
    none = F.array(F.struct(F.lit("not_an_object").alias("violation"), F.lit(None).cast("string").alias("field")))
    return F.when(keys.isNull(), none).otherwise(F.concat(side("unknown_field", F.array_except(keys, names)), side("missing_field", F.array_except(names, keys))))


def field_violations(rows: DataFrame, json_col: str = "json", known: tuple[str, ...] = KNOWN_FIELDS) -> DataFrame:
    """rows' other columns with (violation, field): fields beyond the contract, and fields that a row lacks.

    A row is one JSON object as text; null, or a text that is none, is not_an_object. A field that
    nobody placed is an error and never dropped in silence.
    """
    rest = [c for c in rows.columns if c != json_col]
    return rows.select(*rest, F.explode(fields_found(F.col(json_col), known)).alias("_v")).select(*rest, "_v.violation", "_v.field")


def drop_fields(raw: DataFrame) -> DataFrame:
    """raw without the fields that ingest drops for a stated reason (schemas.DROPPED_FIELDS)."""
    return raw.drop(*DROPPED_FIELDS)


def single_condition(value: Column) -> Column:
    """struct(code, stated, segment) of a condition with one value; blank is unstated, a segment of its own."""
    code = F.nullif(strip(value), F.lit(""))
    return F.struct(code.alias("code"), code.isNotNull().alias("stated"), F.coalesce(code, F.lit(UNSTATED)).alias("segment"))


def multi_condition(values: Column) -> Column:
    """struct(codes, stated, segments): trimmed, without blanks, distinct and sorted; a review lies in all of them."""
    trimmed = F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), strip), lambda x: F.coalesce(x, F.lit("")) != "")
    codes = F.array_sort(F.array_distinct(trimmed))
    return F.struct(codes.alias("codes"), (F.size(codes) > 0).alias("stated"), F.when(F.size(codes) > 0, codes).otherwise(F.array(F.lit(UNSTATED))).alias("segments"))


def build(raw: DataFrame, product: Column | str = "product_id") -> DataFrame:
    """(review_id, product_id, raw, condition, derived) of raw rows, the only form that later stages read.

    raw carries RAW_FIELDS as they are; condition skinType, option and skinTrouble; derived what is
    computed from them. Values out of contract come through: contracts.review_violations names them.
    """
    product = F.col(product) if isinstance(product, str) else product
    have = [c for c in RAW_FIELDS if c in raw.columns]
    condition = F.struct(single_condition(F.col("skinType")).alias("skinType"), multi_condition(F.col("skinTrouble")).alias("skinTrouble"), single_condition(F.col("option")).alias("option"))
    derived = F.struct(
        nfc(strip(F.col("userName"))).alias("authorKey"), content_hash(F.col("content")).alias("contentHash"), F.char_length(strip(F.col("content"))).alias("contentLength"),
        sentiment_prior(F.col("rating")).alias("sentimentPrior"), month_of(F.col("reviewDate")).alias("reviewYearMonth"))
    return raw.select(F.col("reviewId").alias("review_id"), product.alias("product_id"), F.struct(*have).alias("raw"), condition.alias("condition"), derived.alias("derived"))


def code_violations(found: DataFrame, book: DataFrame) -> DataFrame:
    """(axis, code, uses, hint) of codes that the book lacks: not_a_code, another axis' code, or out of its domain.

    found: axis, code, one row a use; book: axis, code, a dimension of a few dozen rows.
    """
    uses = found.groupBy("axis", "code").agg(F.count("*").alias("uses"))
    lost = uses.join(book.select("axis", "code").distinct(), ["axis", "code"], "left_anti")
    prefix = F.lit(None).cast("string")
    for axis, letter in CODE_PREFIX.items():
        prefix = F.when(F.col("axis") == axis, letter).otherwise(prefix)
    hint = F.when(~F.coalesce(F.col("code").rlike(r"^[A-Z]\d{2}$"), F.lit(False)), "not_a_code").when(~F.col("code").startswith(prefix), "other_axis").otherwise("out_of_domain")
    return lost.select("axis", "code", "uses", hint.alias("hint"))


def write(records: DataFrame, path: str, profile: DataFrame | None = None, profile_path: str | None = None) -> None:
    """Records as JSON lines; the profile's one row beside them, unless profile_path is None."""
    records.write.mode("overwrite").json(path)
    if profile is not None and profile_path is not None:
        profile.write.mode("overwrite").json(profile_path)
