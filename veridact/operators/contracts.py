"""Contract checks as tables of violations; assert_none raises where there are any."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import direction
from ..functions.text import fold_invisible, month_of
from ..schemas import MAX_ASPECTS, POLARITIES, STAGES, UNSTATED, ContractError
from .shared import cut_lineage


def assert_none(violations: DataFrame, what: str) -> None:
    rows = violations.take(5)
    if rows:
        raise ContractError(f"{what}: {[r.asDict() for r in rows]}")


def unknown_fields(found: list[str], known: list[str]) -> tuple[list[str], list[str]]:
    """(fields beyond the contract, fields missing from it)."""
    return sorted(set(found) - set(known)), sorted(set(known) - set(found))


def review_violations(reviews: DataFrame) -> DataFrame:
    """(review_id, violation) of fields out of contract, and of ids that come twice."""
    checks: dict[str, Column] = {
        "blank_content": F.coalesce(F.trim("content"), F.lit("")) == "", "rating_range": ~F.coalesce(F.col("rating").between(1, 5), F.lit(False)),
        "bad_date": month_of(F.col("review_date")).isNull(), "no_author": F.col("author").isNull(), "bad_id": ~F.coalesce(F.col("review_id") >= 0, F.lit(False)),
    }
    each = F.filter(F.array(*[F.when(c, n) for n, c in checks.items()]), F.isnotnull)
    broken = reviews.select("review_id", F.explode(each).alias("violation"))
    twice = reviews.groupBy("review_id").agg(F.count("*").alias("n")).where("n > 1").select("review_id", F.lit("duplicate_id").alias("violation"))
    return broken.union(twice)


def tag_partition(tags: DataFrame, reviews: DataFrame, aspects: list[str]) -> DataFrame:
    """tags (ord, review_id, aspect, polarity, snippet) with violation (null: valid), by input order.

    Predicates come before the counters: of the tags that pass them, a later one of the same aspect
    and those beyond MAX_ASPECTS fall.
    """
    rows = tags.join(reviews.select("review_id", "content"), "review_id", "left")
    base = (
        F.when(F.col("content").isNull(), "unknown_review").when(~F.col("aspect").isin(aspects), "unknown_aspect")
        .when(~F.col("polarity").isin(*POLARITIES), "unknown_polarity").when(~F.contains(fold_invisible(F.col("content")), fold_invisible(F.col("snippet"))), "not_verbatim")
    )
    rows = rows.withColumn("base", base)
    valid = F.col("base").isNull()
    again = F.row_number().over(Window.partitionBy("review_id", "aspect", valid).orderBy("ord"))
    rows = rows.withColumn("again", F.when(valid, again > 1))
    place = F.count(F.when(valid & ~F.col("again"), 1)).over(Window.partitionBy("review_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("place", place)
    last = F.when(F.col("again"), "duplicate_aspect").when(F.col("place") > MAX_ASPECTS, "too_many_aspects")
    return rows.select("ord", "review_id", "aspect", F.coalesce("base", last).alias("violation"))


def unknown_codes(found: DataFrame, book: DataFrame) -> DataFrame:
    """(code, uses, state): codes in use that the book lacks, and book codes that nobody uses."""
    uses = found.groupBy("code").agg(F.count("*").alias("uses"))
    rows = uses.join(book.select("code", F.lit(True).alias("known")), "code", "full_outer")
    state = F.when(F.col("known").isNull(), "unknown").when(F.col("uses").isNull(), "unused").otherwise("known")
    return rows.select("code", F.coalesce("uses", F.lit(0)).alias("uses"), state.alias("state"))


def overlapping_ranges(bridge: DataFrame) -> DataFrame:
    """Pairs of products that share a goods number while their month ranges overlap; null ends are open."""
    side = lambda s: bridge.select("goods_no", *[F.col(c).alias(f"{s}_{c}") for c in ("product_id", "from_month", "to_month")])
    pairs = side("a").join(side("b"), "goods_no").where("a_product_id < b_product_id")
    meet = (F.coalesce("a_from_month", F.lit("0000")) <= F.coalesce("b_to_month", F.lit("9999"))) & (F.coalesce("b_from_month", F.lit("0000")) <= F.coalesce("a_to_month", F.lit("9999")))
    return pairs.where(meet).select("goods_no", "a_product_id", "b_product_id")


def resolve_goods(reviews: DataFrame, bridge: DataFrame) -> DataFrame:
    """reviews (goods_no, month) with product_id by the bridge: a single owner ignores its range, of
    several the one whose range holds the month. matches says how many fit (1 is right)."""
    owners = bridge.withColumn("owners", F.count("*").over(Window.partitionBy("goods_no")))
    fits = (F.col("owners") == 1) | ((F.col("from_month").isNull() | (F.col("month") >= F.col("from_month"))) & (F.col("to_month").isNull() | (F.col("month") <= F.col("to_month"))))
    hits = reviews.join(owners, "goods_no").where(fits).groupBy("review_id").agg(F.count("*").alias("matches"), F.min("product_id").alias("product_id"))
    return reviews.join(hits, "review_id", "left").withColumn("matches", F.coalesce("matches", F.lit(0)))


def dependent_reviews(reviews: DataFrame) -> DataFrame:
    """Authors and contents that occur more than once within a product."""
    twice = lambda kind, c: reviews.groupBy("product_id", c).agg(F.count("*").alias("n")).where("n > 1").select("product_id", F.lit(kind).alias("kind"), "n")
    return twice("author", "author").union(twice("content", "content_hash"))


def different_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side that the other lacks, repeats counted, with the side's name."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).union(right.exceptAll(left).withColumn("side", F.lit("right")))


#: Buckets of keys whose digests two bases are compared by.
BUCKETS = 4096


def _leaves(schema: T.StructType, at: str = "") -> list[tuple[str, str]]:
    """(dotted path, column expression) of every field that isn't a struct."""
    out = []
    for f in schema.fields:
        path, column = f"{at}{f.name}", ".".join(f"`{x}`" for x in f"{at}{f.name}".split("."))
        out += _leaves(f.dataType, f"{path}.") if isinstance(f.dataType, T.StructType) else [(path, column)]
    return out


def bucket_digests(rows: DataFrame, key: str, fields: list[tuple[str, str]], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, x, y, z): rows of each bucket of keys and digests of them that don't depend on their order."""
    all_ = F.to_json(F.struct(F.col(key).alias("k"), *[F.col(c).alias(f"f{i}") for i, (_, c) in enumerate(fields)]), {"ignoreNullFields": "false"})
    h, g = F.xxhash64(all_), F.xxhash64(F.lit("second"), all_)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket")
    return rows.select(bucket, h.alias("h"), g.alias("g")).groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.bit_xor("g").alias("y"), F.sum(F.shiftright("h", 32)).alias("z"))


def field_differences(left: DataFrame, right: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """(key, field, kind, left_value, right_value): where two bases of one kind differ, field by field.

    Digests of buckets of keys are compared first; only rows of buckets that differ are joined, so equal bases move digests
    alone. kind: differs (values as JSON), only_left and only_right (a row, field is null; or a field that the other
    base lacks), repeated_key (the key stands on several rows of a side, which aren't compared). Fields of structs have
    dotted names; arrays are compared whole. Nulls equal nulls, also as keys; an empty base lacks every row.
    """
    ours, theirs = (dict(_leaves(b.schema)) for b in (left, right))
    shared = [(p, c) for p, c in sorted(ours.items()) if p in theirs and p != key]
    schema = f"{key} {left.schema[key].dataType.simpleString()}, field string, kind string, left_value string, right_value string"
    lacking = [(None, p, "only_left", None, None) for p in sorted(set(ours) - set(theirs))] + [(None, p, "only_right", None, None) for p in sorted(set(theirs) - set(ours))]
    fields = left.sparkSession.createDataFrame(lacking, schema)
    a, b = (bucket_digests(x, key, shared, buckets).select("bucket", *[F.col(c).alias(f"{c}{i}") for c in "nxyz"]) for i, x in enumerate((left, right)))
    same = reduce(lambda p, q: p & q, [F.col(f"{c}0").eqNullSafe(F.col(f"{c}1")) for c in "nxyz"])
    moved = cut_lineage(a.join(b, "bucket", "full_outer").where(~same).select("bucket"))  # as many rows as there are buckets, at most
    pick = lambda x, i: x.join(F.broadcast(moved), F.pmod(F.xxhash64(key), F.lit(buckets)) == F.col("bucket"), "left_semi").select(
        F.col(key).alias(f"_k{i}"), F.lit(True).alias(f"_in{i}"), F.array(*[F.to_json(F.struct(F.col(c).alias("v"))) for _, c in shared]).cast("array<string>").alias(f"_v{i}"))
    mine, other = cut_lineage(pick(left, 0)), cut_lineage(pick(right, 1))
    often = lambda x, i: x.groupBy(f"_k{i}").agg(F.count("*").alias("c")).where("c > 1").select(F.col(f"_k{i}").alias("_rk"))
    repeated = cut_lineage(often(mine, 0).union(often(other, 1)).distinct())
    once = lambda x, i: x.join(repeated, F.col(f"_k{i}").eqNullSafe(F.col("_rk")), "left_anti")
    both = once(mine, 0).join(once(other, 1), F.col("_k0").eqNullSafe(F.col("_k1")), "full_outer")
    item = lambda field, kind, x=None, y=None: F.struct(
        F.lit(field).cast("string").alias("field"), F.lit(kind).alias("kind"), (F.lit(None).cast("string") if x is None else x).alias("left_value"), (F.lit(None).cast("string") if y is None else y).alias("right_value"))
    value = lambda side, i: F.get_json_object(F.get(side, F.lit(i)), "$.v")
    each = [F.when(F.get("_v0", F.lit(i)) != F.get("_v1", F.lit(i)), item(p, "differs", value("_v0", i), value("_v1", i))) for i, (p, _) in enumerate(shared)]
    found = F.when(F.col("_in1").isNull(), F.array(item(None, "only_left"))).when(F.col("_in0").isNull(), F.array(item(None, "only_right"))).otherwise(F.filter(F.array(*each), F.isnotnull) if each else F.array().cast("array<struct<field:string,kind:string,left_value:string,right_value:string>>"))
    rows = both.select(F.when(F.col("_in0").isNull(), F.col("_k1")).otherwise(F.col("_k0")).alias(key), F.explode(found).alias("d")).select(key, "d.*")
    none = F.lit(None).cast("string")
    return rows.union(repeated.select(F.col("_rk").alias(key), none.alias("field"), F.lit("repeated_key").alias("kind"), none.alias("left_value"), none.alias("right_value"))).union(fields)


def vector_violations(vectors: DataFrame, dim: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    v = F.col(vec_col)
    bad = F.when(v.isNull(), "missing").when(F.size(v) != dim, "wrong_dimension").when(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), "not_finite")
    return vectors.select(id_col, bad.alias("violation")).where("violation is not null")


def claim_violations(claims: DataFrame, id_col: str = "claim_id") -> DataFrame:
    """(claim_id, violation) of claims whose counts or fields don't hold together.

    claims: claim_id, aspect, direction, claim_type, pos, neg, neu, spoke, silent, support, evidence
    array of review ids. Several violations of one claim are several rows.
    """
    counts = ["pos", "neg", "neu", "spoke", "silent", "support"]
    negative = F.lit(False)
    for c in counts:
        negative = negative | F.coalesce(F.col(c) < 0, F.lit(True))
    told = F.when((F.col("pos") > 0) & (F.col("neg") > 0), "mixed").when(F.col("pos") > 0, "positive").when(F.col("neg") > 0, "negative").otherwise("neutral")
    checks: dict[str, Column] = {
        "blank_aspect": F.coalesce(F.trim("aspect"), F.lit("")) == "", "negative_count": negative,
        "spoke_is_not_the_sum": F.col("pos") + F.col("neg") + F.col("neu") != F.col("spoke"), "support_beyond_spoke": F.col("support") > F.col("spoke"),
        "no_evidence": F.coalesce(F.size("evidence"), F.lit(0)) <= 0, "evidence_twice": F.size(F.array_distinct("evidence")) < F.size("evidence"),
        "direction_not_derived": F.coalesce(F.col("direction") != told, F.lit(True)), "unknown_type": ~F.coalesce(F.col("claim_type").isin("conditional", "unconditional"), F.lit(False)),
    }
    each = F.filter(F.array(*[F.when(c, n) for n, c in checks.items()]), F.isnotnull)
    return claims.select(id_col, F.explode(each).alias("violation"))


def label_support(evidence: DataFrame, reviews: DataFrame) -> DataFrame:
    """Distinct authors of each stance behind a hand-made label, and the direction that follows.

    evidence: label_id, review_id, stance; reviews: review_id, author. The direction is never chosen
    by hand.
    """
    rows = evidence.join(reviews.select("review_id", "author"), "review_id")
    n = lambda p: F.count_distinct(F.when(F.col("stance") == p, F.col("author")))
    found = rows.groupBy("label_id").agg(n("positive").alias("pos"), n("negative").alias("neg"), n("neutral").alias("neu"), F.count_distinct("author").alias("spoke"), F.count("*").alias("evidence"))
    return found.withColumn("direction", direction(F.col("pos"), F.col("neg")))


def label_violations(labels: DataFrame, evidence: DataFrame, reviews: DataFrame, aspects: list[str]) -> DataFrame:
    """(label_id, violation) of labels against their evidence.

    labels: label_id, product_id, aspect (null: outside the taxonomy), direction, minutes; evidence:
    label_id, review_id, stance, quote; reviews: review_id, product_id, author, content.
    """
    rows = evidence.join(reviews.select("review_id", F.col("product_id").alias("_product"), "content"), "review_id", "left").join(
        labels.select("label_id", "product_id"), "label_id")
    checks: dict[str, Column] = {
        "review_outside_bundle": F.coalesce(F.col("_product") != F.col("product_id"), F.lit(True)), "unknown_stance": ~F.coalesce(F.col("stance").isin(*POLARITIES), F.lit(False)),
        "blank_quote": F.coalesce(F.trim("quote"), F.lit("")) == "", "not_verbatim": ~F.contains(fold_invisible(F.col("content")), fold_invisible(F.col("quote"))),
    }
    broken = rows.select("label_id", F.explode(F.filter(F.array(*[F.when(c, n) for n, c in checks.items()]), F.isnotnull)).alias("violation")).distinct()
    twice = evidence.groupBy("label_id", "review_id").agg(F.count("*").alias("n")).where("n > 1").select("label_id", F.lit("evidence_twice").alias("violation")).distinct()
    derived = label_support(evidence, reviews).select("label_id", F.col("direction").alias("derived"))
    own = labels.join(derived, "label_id", "left")
    plain: dict[str, Column] = {
        "unknown_aspect": F.col("aspect").isNotNull() & ~F.col("aspect").isin(aspects), "no_evidence": F.col("derived").isNull(),
        "direction_not_derived": F.col("derived") != F.col("direction"), "minutes_not_positive": F.coalesce(F.col("minutes") <= 0, F.lit(True)),
    }
    fields = own.select("label_id", F.explode(F.filter(F.array(*[F.when(c, n) for n, c in plain.items()]), F.isnotnull)).alias("violation"))
    return broken.union(twice).union(fields)


def snapshot_state(reviews: DataFrame, policy_month: str) -> DataFrame:
    """(latest_month, current): one row; a policy is stale once a review is later than its month."""
    latest = reviews.agg(F.max(month_of(F.col("review_date"))).alias("latest_month"))
    return latest.withColumn("current", F.coalesce(F.col("latest_month") <= policy_month, F.lit(True)))


def evidence_conditions(evidence: DataFrame, labels: DataFrame, reviews: DataFrame) -> DataFrame:
    """(label_id, review_id, axis, segment): evidence reviews outside a segment that their label's condition wants.

    labels: label_id, skin_types and troubles (arrays of wanted segments; null: the axis is open);
    reviews: review_id, skin_type, troubles. Reviews that stated nothing are a segment of their own.
    """
    have = {
        "skinType": F.array(F.coalesce("skin_type", F.lit(UNSTATED))),
        "skinTrouble": F.when(F.size("_troubles") > 0, F.col("_troubles")).otherwise(F.array(F.lit(UNSTATED))),
    }
    rows = evidence.select("label_id", "review_id").join(labels.select("label_id", "skin_types", "troubles"), "label_id").join(
        reviews.select("review_id", "skin_type", F.coalesce("troubles", F.array().cast("array<string>")).alias("_troubles")), "review_id")

    def lost(axis: str, want: Column) -> Column:
        outside = F.array_except(F.coalesce(want, F.array().cast("array<string>")), have[axis])
        return F.transform(outside, lambda s: F.struct(F.lit(axis).alias("axis"), s.alias("segment")))

    found = F.concat(lost("skinType", F.col("skin_types")), lost("skinTrouble", F.col("troubles")))
    return rows.select("label_id", "review_id", F.explode(found).alias("_l")).select("label_id", "review_id", "_l.axis", "_l.segment").distinct()


def stage_order_violations(layouts: DataFrame, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """(id, violation) of layouts whose stages (array of struct stage int, key string) aren't the agreed ones in order."""
    keys = F.transform("stages", lambda s: s["key"])
    wrong = F.exists(F.transform("stages", lambda s, i: ~s["stage"].eqNullSafe(i + 1)), lambda x: x)
    bad = F.when(F.col("stages").isNull(), "no_stages").when(keys != F.array(*map(F.lit, stages)), "stage_order").when(wrong, "stage_number")
    return layouts.select("id", bad.alias("violation")).where("violation is not null")


def input_digests(rows: DataFrame, by: str, id_col: str, *columns: str, part: int = 1000) -> DataFrame:
    """(by, digest): SHA-256 over each group's rows in order of id, in parts of `part` ids that are digested in turn.

    A row is its id and columns as text, joined by U+241F, nulls left out. Parts are ranges of ids, so a task holds as many hashes as a
    part has rows, and a group as many as it has parts. Repeated rows count; an empty table gives an empty result.
    """
    joined = lambda c: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(c, "h"))), lambda x: x["h"]), "\n"), 256)
    r = rows.select(by, id_col, F.floor(F.col(id_col) / part).alias("part"), F.sha2(F.concat_ws("␟", id_col, *columns), 256).alias("h"))
    return r.groupBy(by, "part").agg(joined(id_col).alias("h")).groupBy(by).agg(joined("part").alias("digest"))
