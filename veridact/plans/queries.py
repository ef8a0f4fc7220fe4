"""The engine's queries over the standard tables, each with the SQL it is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats, text
from ..operators import catalog, claims, conditions, contracts, gates, layout, ledger, options, polarity, profile, quotes, trust
from ..schemas import WINDOW_MONTHS
from ..sources import adapters
from ..sources.adapters import table
from . import oracles as sql

CELL = ["product_id", "axis", "segment"]


def cutoff_month(reviews: DataFrame):
    """The first month of the window that ends with the latest review, as a one-row column."""
    latest = reviews.agg(F.max(text.month_of(F.col("review_date"))).alias("m"))
    return latest.select(text.shift_month(F.col("m"), WINDOW_MONTHS - 1)).first()[0] or "0000-00"


def scored(spark: SparkSession, d: str) -> DataFrame:
    """The review view with signals and rank; texts stay behind once they are measured."""
    return trust.ranked(trust.signals(adapters.reviews(spark, d), tagged=adapters.tags(spark, d)).drop("content"))


def told(spark: SparkSession, d: str) -> DataFrame:
    """A review a row with its score and what it says (claims.told()), as a table. Lines are read once, contents hashed once."""
    rows = gates.cut_lineage(trust.hashed(adapters.told(spark, d)).drop("content", "rating"))
    return gates.cut_lineage(trust.weighed(rows, tagged="said").select("review_id", "product_id", "author", "skin_type", "troubles", "trust_score", "review_date", "said"))


def gated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(identity gate's rows, duplicate gate's rows, survivors) of the review view."""
    rows = adapters.reviews(spark, d)
    first = gates.identity_gate(rows, adapters.products(spark, d), cutoff_month(rows))
    ranked = gates.cut_lineage(trust.ranked(trust.signals(first.where("reason is null").drop("reason", "detail", "limitation"), tagged=adapters.tags(spark, d)).drop("content")))
    second = gates.cut_lineage(gates.duplicate_gate(ranked).join(ranked, ["product_id", "rank"]))
    return first, second, second.where("reason is null")


def judged(spark: SparkSession, d: str, kept: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sufficiency gate's claims, cell sizes, survivors with their cells)."""
    kept = gated(spark, d)[2] if kept is None else kept
    member = claims.cells(kept)
    found = gates.sufficiency_gate(claims.candidates(member, adapters.tags(spark, d)))
    found = found.withColumn("claim_id", claims.claim_id()).withColumn("direction", stats.direction(F.col("pos"), F.col("neg")))
    return found, claims.cell_sizes(member), member


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """What each product's condition cells say of each aspect, and whether they may."""
    found, _, _ = judged(spark, d)
    return found.select(*CELL, "aspect", "pos", "neg", "neu", "spoke", "cell_authors", "silent", "direction", "support", "share", "reason", "limitation")


def ingest_records(spark: SparkSession, d: str) -> DataFrame:
    r = adapters.reviews(spark, d)
    raw = F.concat(F.lit(" "), "content", F.lit("　\n"))
    return r.select(
        "review_id", "product_id", text.nfc(F.col("author").cast("string")).alias("author_key"), text.content_hash(raw).alias("content_hash"),
        F.char_length(text.strip(raw)).alias("content_length"), text.sentiment_prior(F.col("rating")).alias("sentiment_prior"), text.month_of(F.col("review_date")).alias("review_month"),
        F.coalesce("skin_type", F.lit("미기재")).alias("skin_segment"), F.col("skin_type").isNotNull().alias("skin_stated"),
        F.when(F.size("troubles") > 0, F.array_join("troubles", ",")).otherwise("미기재").alias("trouble_segments"),
    )


def trust_scores(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).select("review_id", "product_id", "content_length", "copies", "s_length", "s_unique", "s_topic", "s_likes", "trust_score", F.array_join("unavailable", ",").alias("unavailable"))


def trust_rank(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).select("product_id", "review_id", "rank")


def identity_gate(spark: SparkSession, d: str) -> DataFrame:
    return gated_first(spark, d).select("review_id", "product_id", "month", "reason", "detail", "limitation")


def gated_first(spark: SparkSession, d: str) -> DataFrame:
    rows = adapters.reviews(spark, d)
    return gates.identity_gate(rows, adapters.products(spark, d), cutoff_month(rows))


def duplicate_gate(spark: SparkSession, d: str) -> DataFrame:
    _, second, _ = gated(spark, d)
    return second.select("product_id", "review_id", "rank", "reason", "kept_rank")


def cell_sizes(spark: SparkSession, d: str) -> DataFrame:
    return claims.cell_sizes(claims.cells(adapters.reviews(spark, d)))


def candidate_claims(spark: SparkSession, d: str) -> DataFrame:
    found = claims.candidates(claims.cells(adapters.reviews(spark, d)), adapters.tags(spark, d))
    return found.select(claims.claim_id().alias("claim_id"), *CELL, "aspect", "pos", "neg", "neu", "spoke", "cell_authors")


def ledger_rows(spark: SparkSession, d: str) -> DataFrame:
    first, second, kept = gated(spark, d)
    found, _, _ = judged(spark, d, kept)
    return ledger.review_rows(first, "identity").union(ledger.review_rows(second, "duplicate")).union(ledger.claim_rows(found))


def ledger_rollup(spark: SparkSession, d: str) -> DataFrame:
    return ledger.rollup(ledger_rows(spark, d)).select("gate", "reason", "n")


def gate_summary(spark: SparkSession, d: str) -> DataFrame:
    first, second, kept = gated(spark, d)
    found, _, _ = judged(spark, d, kept)
    one = lambda df, name: df.agg(F.count("*").alias("reviews"), F.count(F.when(F.col("reason").isNull(), 1)).alias("passed"), F.count("limitation").alias("limited")).select(F.lit(name).alias("gate"), "*")
    return one(first, "identity").union(one(second.withColumn("limitation", F.lit(None).cast("string")), "duplicate")).union(one(found, "sufficiency"))


def aspect_support(spark: SparkSession, d: str) -> DataFrame:
    return polarity.aspect_support(adapters.reviews(spark, d), adapters.tags(spark, d), ["product_id"])


def noise_threshold(spark: SparkSession, d: str) -> DataFrame:
    """The smallest minority that isn't tagger noise, for the numbers of directional tags that products' cells have."""
    found = claims.candidates(claims.cells(adapters.reviews(spark, d)), adapters.tags(spark, d))
    return polarity.noise_thresholds(found.select((F.col("pos") + F.col("neg")).alias("n")))


def rating_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return polarity.rating_conflicts(adapters.reviews(spark, d), adapters.tags(spark, d))


def conflicts_by_kind(spark: SparkSession, d: str) -> DataFrame:
    return rating_conflicts(spark, d).groupBy("kind").agg(F.count("*").alias("n"))


def segment_splits(spark: SparkSession, d: str) -> DataFrame:
    member = claims.cells(adapters.reviews(spark, d))
    return polarity.segment_splits(claims.candidates(member, adapters.tags(spark, d)))


def unconditional_check(spark: SparkSession, d: str) -> DataFrame:
    """Whether an answer without a condition holds: sufficient segments compared, the rest counted."""
    member = claims.cells(adapters.reviews(spark, d))
    return polarity.unconditional(gates.cut_lineage(claims.candidates(member, adapters.tags(spark, d))))


def option_index(spark: SparkSession, d: str) -> DataFrame:
    return options.index(adapters.reviews(spark, d).where("option is not null"))


def shade_counts(spark: SparkSession, d: str) -> DataFrame:
    return options.shade_counts(option_index(spark, d))


def ranked_quotes(spark: SparkSession, d: str) -> DataFrame:
    found = layout.ranked_told(told(spark, d), CELL, claims.cell_list())
    return found.select(*CELL, "aspect", "review_id", "polarity", "quote_rank", "polarity_rank")


def kept_quotes(spark: SparkSession, d: str) -> DataFrame:
    found = layout.first_told(told(spark, d), CELL, claims.cell_list())
    return layout.truncate(found, CELL).select(*CELL, "aspect", "review_id", "polarity", "quote_rank", "reserved")


def evidence_months(spark: SparkSession, d: str) -> DataFrame:
    rows = claims.cells(adapters.reviews(spark, d)).join(adapters.tags(spark, d), "review_id").withColumn("m", text.month_of(F.col("review_date")))
    return layout.totals(rows.withColumnRenamed("m", "month"), CELL).select(*CELL, "aspect", "first_month", "last_month", "quotes")


def evidence(spark: SparkSession, d: str) -> DataFrame:
    """Quotes of every kind: each document quotes itself as written, with its breaks as spaces, without
    spaces, and a review that isn't there; benchmark passages cite the document of their own number."""
    docs = table(spark, d, "documents").select("doc_id", F.col("text").alias("t"), (F.col("doc_id") % 4).alias("k"))
    quote = F.when(F.col("k") == 1, F.replace("t", F.lit("\n"), F.lit(" "))).when(F.col("k") == 2, F.replace("t", F.lit(" "), F.lit(""))).otherwise(F.col("t"))
    own = docs.select(F.col("doc_id").alias("quote_id"), F.when(F.col("k") == 3, F.col("doc_id") + 1_000_000_000).otherwise(F.col("doc_id")).alias("review_id"), quote.alias("quote"))
    bench = table(spark, d, "benchmark").select((F.col("item_id") + 2_000_000_000).alias("quote_id"), F.col("item_id").alias("review_id"), F.col("text").alias("quote"))
    return own.union(bench)


def quote_verdicts(spark: SparkSession, d: str) -> DataFrame:
    source = table(spark, d, "documents").select(F.col("doc_id").alias("review_id"), F.col("text").alias("content"))
    return quotes.classify(evidence(spark, d), source)


def quote_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = quote_verdicts(spark, d)
    by = rows.groupBy("status").agg(F.count("*").alias("n"))
    return by.join(rows.agg(F.count("*").alias("all")), F.lit(True)).select("status", "n", F.round(100 * F.col("n") / F.col("all"), 1).alias("percent"))


def walked_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Five quotes a claim, the last two of them spares, through the gate; every fifteenth spare cites the review of the claim's first quote."""
    rows = quote_verdicts(spark, d).withColumn("claim_id", F.floor(F.col("quote_id") / 5)).withColumn("position", (F.col("quote_id") % 5).cast("int"))
    spare = F.col("position") >= 3
    cites = F.when(spare & (F.col("claim_id") % 3 == 0), F.col("claim_id") * 5).otherwise(F.col("review_id"))
    return gates.cut_lineage(quotes.walk(rows.select("claim_id", "position", "quote_id", cites.alias("review_id"), "status", "matched_review_id", spare.alias("spare"))))


def quote_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return quotes.outcomes(walked_quotes(spark, d))


def quote_walk(spark: SparkSession, d: str) -> DataFrame:
    """What became of every quote and spare, and the order of what stays."""
    return walked_quotes(spark, d).select("claim_id", "position", "review_id", "status", "fate", "kept_order")


def quote_ledger(spark: SparkSession, d: str) -> DataFrame:
    rows = walked_quotes(spark, d)
    return quotes.gate_ledger(rows, quotes.outcomes(rows))


def quote_gate_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = walked_quotes(spark, d)
    return quotes.gate_summary(rows, quotes.outcomes(rows))


def folded_texts(spark: SparkSession, d: str) -> DataFrame:
    odd = F.concat(F.lit("﻿"), F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit("​ 　é"))
    rows = table(spark, d, "documents").select("doc_id", odd.alias("t"))
    f = text.fold_invisible(F.col("t"))
    return rows.select("doc_id", F.char_length(f).alias("folded_length"), F.md5(f).alias("folded_md5"), F.char_length(text.squeeze(f)).alias("squeezed_length"), F.char_length(text.fold_linebreaks(f)).alias("one_line_length"))


def tag_partition(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as raw tags, in the order of part and line; some of them break the contract."""
    line = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    order = F.concat_ws("-", F.lpad(F.col("l_partkey").cast("string"), 9, "0"), F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"), F.lpad(F.format_string("%.2f", "l_extendedprice"), 15, "0"))
    flag = F.when(F.col("l_returnflag") == "A", "positive").when(F.col("l_returnflag") == "R", "negative").otherwise("neutral")
    raw = line.select(
        F.col("l_orderkey").alias("review_id"), order.alias("ord"), F.when(F.col("l_linenumber") == 7, "other").otherwise(F.col("p_type")).alias("aspect"),
        F.when((F.col("l_linenumber") == 6) & (F.col("l_linestatus") == "F"), "unsure").otherwise(flag).alias("polarity"),
        F.when(F.col("l_linestatus") == "O", F.lit("-")).otherwise("zzz").alias("snippet"),
    ).groupBy("review_id", "ord").agg(F.min(F.struct("aspect", "polarity", "snippet")).alias("x")).select("review_id", "ord", "x.*")
    aspects = ["ECONOMY", "STANDARD", "PROMO", "MEDIUM", "SMALL", "LARGE"]
    return contracts.tag_partition(raw, adapters.reviews(spark, d), aspects)


def review_contract(spark: SparkSession, d: str) -> DataFrame:
    """Reviews with every tenth rating out of range and every seventh date broken, and one id twice."""
    r = adapters.reviews(spark, d).withColumn("rating", F.when(F.col("review_id") % 10 == 3, 9).otherwise(F.col("rating"))).withColumn("review_date", F.when(F.col("review_id") % 7 == 1, "1999/13").otherwise(F.col("review_date")))
    return contracts.review_violations(r.union(r.where("review_id = 5")))


def code_coverage(spark: SparkSession, d: str) -> DataFrame:
    found = adapters.reviews(spark, d).select(F.explode("troubles").alias("code"))
    return contracts.unknown_codes(found, spark.range(1, 9).select(F.concat(F.lit("C0"), (F.col("id") + 1).cast("string")).alias("code")))


def goods_bridge(spark: SparkSession, d: str) -> DataFrame:
    """Products share goods numbers by supplier; ranges of the first owner end where the next begins."""
    s = table(spark, d, "supplier").select("s_suppkey")
    n = F.col("s_suppkey") % 3
    own = s.select(F.concat(F.lit("A"), F.lpad(F.floor(F.col("s_suppkey") / 3).cast("string"), 12, "0")).alias("goods_no"), F.concat(F.lit("p"), F.col("s_suppkey").cast("string")).alias("product_id"),
                   F.when(n == 1, "1998-01").when(n == 2, "2000-01").alias("from_month"), F.when(n == 0, "1997-12").when(n == 1, "1999-12").alias("to_month"))
    return own


def resolved_goods(spark: SparkSession, d: str) -> DataFrame:
    """Every order's first line is bought under its supplier's goods number, at the order's month."""
    first = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("s"))
    goods = F.concat(F.lit("A"), F.lpad(F.floor(F.col("s") / 3).cast("string"), 12, "0"))
    rows = adapters.reviews(spark, d).join(first, F.col("review_id") == F.col("l_orderkey")).select("review_id", goods.alias("goods_no"), text.month_of(F.col("review_date")).alias("month"))
    return contracts.resolve_goods(rows, goods_bridge(spark, d)).select("review_id", "goods_no", "month", "product_id", "matches")


def overlapping_ranges(spark: SparkSession, d: str) -> DataFrame:
    late = goods_bridge(spark, d).withColumn("to_month", F.when(F.col("to_month") == "1999-12", "2000-06").otherwise(F.col("to_month")))
    return contracts.overlapping_ranges(late)


def dependent_reviews(spark: SparkSession, d: str) -> DataFrame:
    return contracts.dependent_reviews(adapters.reviews(spark, d).withColumn("content_hash", text.content_hash(F.col("content"))))


def base_parity(spark: SparkSession, d: str) -> DataFrame:
    a = adapters.reviews(spark, d).select("review_id", "author", "rating")
    b = a.withColumn("rating", F.when(F.col("review_id") % 100 == 0, F.col("rating") + 1).otherwise(F.col("rating"))).where("review_id % 101 <> 1")
    return contracts.different_rows(a, b)


def vector_contract(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    return contracts.vector_violations(v.withColumn("embedding", F.when(F.col("vec_id") % 50 == 7, F.slice("embedding", 1, 63)).when(F.col("vec_id") % 50 == 9, None).otherwise(F.col("embedding"))), 64)


def golden_trace(spark: SparkSession, d: str) -> DataFrame:
    found, sizes, _ = judged(spark, d)
    return ledger.trace(golden_targets(spark, d), gates.cut_lineage(found), gates.cut_lineage(sizes), ["ECONOMY", "STANDARD", "PROMO", "MEDIUM", "SMALL", "LARGE"])


def golden_targets(spark: SparkSession, d: str) -> DataFrame:
    """Every order asks whether its customer's kind of skin finds its product's first aspect good."""
    first = adapters.tags(spark, d).groupBy("review_id").agg(F.min("aspect").alias("aspect"))
    rows = adapters.reviews(spark, d).join(first, "review_id", "left")
    return rows.select(F.col("review_id").alias("key"), "product_id", F.lit("skinType").alias("axis"), F.coalesce("skin_type", F.lit("none")).alias("segment"), F.coalesce("aspect", F.lit("nothing")).alias("aspect"), text.sentiment_prior(F.col("rating")).alias("want"))


def golden_recall(spark: SparkSession, d: str) -> DataFrame:
    return ledger.recall(golden_trace(spark, d))


def claim_confidence(spark: SparkSession, d: str) -> DataFrame:
    found, _, _ = judged(spark, d)
    return profile.confidence(found).select("claim_id", "claim_type", "failure_reason", "exposable", "hedges", "band")


def claim_summary(spark: SparkSession, d: str) -> DataFrame:
    return claim_confidence(spark, d).groupBy("claim_type", "band").agg(F.count("*").alias("claims"), F.count(F.when(F.col("exposable"), 1)).alias("exposable"))


def run_report(spark: SparkSession, d: str) -> DataFrame:
    found, _, _ = judged(spark, d)
    return found.where("reason is null").groupBy("direction", "axis").agg(F.count("*").alias("claims"), F.sum("support").alias("authors"))


def ingest_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.ingest_profile(adapters.reviews(spark, d))


def trust_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.trust_profile(scored(spark, d))


def pass_union(spark: SparkSession, d: str) -> DataFrame:
    """Three sorted passes over the orders, as a crawler's; a review counts in the first that has it."""
    o = adapters.reviews(spark, d).select("review_id", "rating", "likes", "product_id")
    passes = [o.where("rating >= 4"), o.where("rating <= 2"), o]
    return profile.first_of_passes(passes, "review_id").select("review_id", "pass")


def resume_products(spark: SparkSession, d: str) -> DataFrame:
    return profile.complete(adapters.reviews(spark, d), "product_id", 1450)


def sku_stats(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem")
    return line.groupBy(F.col("l_suppkey").alias("requested_goods")).agg(F.count_distinct("l_partkey").alias("goods"), F.count("*").alias("rows"))


def crawl_outcomes(spark: SparkSession, d: str) -> DataFrame:
    counts = adapters.reviews(spark, d).groupBy("product_id").agg(F.count("*").alias("n"))
    outcome = F.when(F.col("n") >= 1450, "full").when(F.col("n") > 0, "partial").otherwise("failed")
    return counts.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("products"), F.sum("n").alias("reviews"))


def run_catalog(spark: SparkSession, d: str) -> DataFrame:
    """All observed goods of a crawl under one product."""
    goods = F.concat(F.lit("A"), F.lpad(F.col("l_suppkey").cast("string"), 12, "0"))
    return catalog.run_catalog(table(spark, d, "lineitem").select(goods.alias("goods_no")))


def goods_in_urls(spark: SparkSession, d: str) -> DataFrame:
    """Goods numbers in page urls that carry one as a parameter; more or fewer than one is an error row."""
    url = F.concat("url", F.when(F.col("page_id") % 3 > 0, F.concat(F.lit("&goodsNo=A"), F.lpad(F.col("page_id").cast("string"), 12, "0"))).otherwise(""), F.when(F.col("page_id") % 3 == 2, "/A000000000001").otherwise(""))
    ids = text.goods_numbers(url)
    return table(spark, d, "pages").select("page_id", F.size(ids).alias("found"), F.when(F.size(ids) == 1, ids[0]).alias("goods_no"))


def model_json(spark: SparkSession, d: str) -> DataFrame:
    """The answer inside what a model wrote around it: reasoning blocks and fences go, the outer braces stay."""
    wrote = F.concat(F.lit("<reasoning>{not this}</reasoning>\n```json\n{\"id\": "), F.col("conv_id").cast("string"), F.lit(", \"turn\": "), F.col("turn").cast("string"), F.lit("}\n```"))
    got = F.from_json(text.outer_json(wrote), "id long, turn int")
    return table(spark, d, "conversations").select("conv_id", "turn", got["id"].alias("parsed_id"), got["turn"].alias("parsed_turn"))


def condition_questions(spark: SparkSession, d: str) -> DataFrame:
    """Labels of condition segments in words, from the dimension of codes."""
    names = spark.createDataFrame([("FURNITURE", "건성 피부"), ("AUTOMOBILE", "지성 피부"), ("MACHINERY", "복합성 피부"), ("HOUSEHOLD", "민감성 피부")], "code string, label string")
    size = cell_sizes(spark, d).where("axis = 'skinType'").join(names, F.col("segment") == F.col("code"), "left")
    return size.select("product_id", "segment", F.coalesce("label", F.lit("조건을 밝히지 않은 사용자")).alias("label"), "cell_authors")


def tag_batches(spark: SparkSession, d: str) -> DataFrame:
    """Reviews in tagging requests of twenty: consecutive ids of a range, so that no task sorts them all."""
    return adapters.reviews(spark, d).groupBy(F.floor(F.col("review_id") / 20).alias("batch")).agg(F.count("*").alias("reviews"), F.min("review_id").alias("first_id"))


def untagged_reviews(spark: SparkSession, d: str) -> DataFrame:
    return adapters.reviews(spark, d).join(adapters.tags(spark, d), "review_id", "left_anti").select("review_id", "product_id")


def table_digest(spark: SparkSession, d: str) -> DataFrame:
    """Digest of each product's tagging input, in parts of a thousand ids that are digested in turn."""
    return contracts.input_digests(adapters.reviews(spark, d), "product_id", "review_id", "content", "rating")


def product_lines(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as products, three of a lineage; the last of each is the one on sale."""
    n = F.col("s_suppkey")
    policy = F.when(n % 5 == 0, "single").otherwise("separate")
    return goods_bridge(spark, d).join(table(spark, d, "supplier").select(F.concat(F.lit("p"), n.cast("string")).alias("product_id"), F.concat(F.lit("L"), F.floor(n / 3).cast("string")).alias("lineage_id"),
        policy.alias("renewal_policy"), F.when(n % 3 == 2, F.concat(F.lit("A"), n.cast("string"))).alias("requested_goods_no")), "product_id")


def lineages(spark: SparkSession, d: str) -> DataFrame:
    return catalog.generations(product_lines(spark, d)).select("lineage_id", "product_id", "generation", "current", "previous")


def catalog_contract(spark: SparkSession, d: str) -> DataFrame:
    return catalog.catalog_violations(product_lines(spark, d), goods_bridge(spark, d))


def code_book(spark: SparkSession) -> DataFrame:
    """The labels of some codes; others keep their own name."""
    names = [("skinType", "FURNITURE", "건성"), ("skinType", "AUTOMOBILE", "지성"), ("skinType", "MACHINERY", "복합성"), ("skinTrouble", "C01", "잡티"), ("skinTrouble", "C02", "주름")]
    return spark.createDataFrame(names, "axis string, code string, label string")


def condition_subjects(spark: SparkSession, d: str) -> DataFrame:
    """Every cell in words."""
    return conditions.cell_subjects(cell_sizes(spark, d), code_book(spark)).select(*CELL, "subject", "cell_authors")


def cell_matches(spark: SparkSession, d: str) -> DataFrame:
    """Reviews of those who stated no skin type and have both of two troubles."""
    want = {"skinType": "미기재", "skinTrouble": ["C01", "C02"], "option": None}
    return adapters.reviews(spark, d).where(conditions.fits(want)).select("review_id", "product_id", F.array_join("troubles", ",").alias("troubles"))


def option_scope(spark: SparkSession, d: str) -> DataFrame:
    """The identity gate under each product's most reviewed shade."""
    rows = adapters.reviews(spark, d)
    found = gates.cut_lineage(option_index(spark, d))
    counts = options.shade_counts(found)
    top = counts.groupBy("product_id").agg(F.max(F.struct("reviews", "shade_key")).alias("t")).select("product_id", F.col("t.shade_key").alias("want"))
    known = found.select("product_id", F.col("option").alias("stripped"), "kind", "shade_key")
    keyed = rows.withColumn("stripped", text.strip(text.nfc(F.col("option")))).join(known, ["product_id", "stripped"], "left").join(top, "product_id", "left")
    gate = gates.identity_gate(keyed, adapters.products(spark, d), cutoff_month(rows), F.col("want"))
    return gate.select("review_id", "product_id", "kind", F.coalesce("reason", F.lit("passed")).alias("reason"))


def evidence_fates(spark: SparkSession, d: str) -> DataFrame:
    """What became of the reviews that labels cite: each label cites its order and the one of twice its number."""
    first, second, _ = gated(spark, d)
    key = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"))
    cited = key.select("key", F.explode(F.array(F.col("key"), F.col("key") * 2)).alias("review_id"))
    return ledger.fates(cited, first, second)


def claim_contract(spark: SparkSession, d: str) -> DataFrame:
    """Candidate claims of the plain view, some of them broken on purpose."""
    member = claims.cells(adapters.reviews(spark, d))
    found = claims.candidates(member, adapters.tags(spark, d))
    k = F.col("pos") + F.col("neu")
    rows = found.select(
        claims.claim_id().alias("claim_id"), F.when(k % 13 == 0, F.lit(" ")).otherwise(F.col("aspect")).alias("aspect"), F.when(k % 7 == 0, "positive").otherwise(stats.direction(F.col("pos"), F.col("neg"))).alias("direction"),
        F.when(F.col("axis") == "product", "unconditional").when(k % 11 == 0, "both").otherwise("conditional").alias("claim_type"), "pos", "neg", "neu", "spoke",
        (F.col("cell_authors") - F.col("spoke")).alias("silent"), (F.col("pos") + F.col("neg") + F.when(k % 5 == 0, 100000).otherwise(0)).alias("support"),
        F.when(k % 3 == 0, F.array(F.lit(1), F.lit(1))).when(k % 17 == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(1), F.lit(2))).alias("evidence"),
    )
    return contracts.claim_violations(rows)


def label_evidence(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(labels, evidence): a label a customer, citing its orders; some cite wrongly."""
    rows = adapters.reviews(spark, d)
    stance = F.when(F.col("review_id") % 19 == 0, "unsure").otherwise(text.sentiment_prior(F.col("rating")))
    quote = F.when(F.col("review_id") % 23 == 0, "not said").when(F.col("review_id") % 29 == 0, " ").otherwise(F.substring("content", 1, 5))
    cited = rows.select(F.col("author").alias("label_id"), "review_id", stance.alias("stance"), quote.alias("quote"))
    cited = cited.union(cited.where("review_id % 31 = 0"))
    n = F.col("label_id")
    labels = rows.groupBy(F.col("author").alias("label_id")).agg(F.min("product_id").alias("product_id")).select(
        "label_id", "product_id", F.when(n % 4 == 0, "unheard of").when(n % 4 == 1, "보습감").alias("aspect"), F.when(n % 2 == 0, "mixed").otherwise("positive").alias("direction"), (n % 5).alias("minutes"))
    return labels, cited


def golden_support(spark: SparkSession, d: str) -> DataFrame:
    return contracts.label_support(label_evidence(spark, d)[1], adapters.reviews(spark, d))


def golden_contract(spark: SparkSession, d: str) -> DataFrame:
    return contracts.label_violations(*label_evidence(spark, d), adapters.reviews(spark, d), ["보습감", "흡수력"])


def snapshot_guard(spark: SparkSession, d: str) -> DataFrame:
    return contracts.snapshot_state(adapters.reviews(spark, d), "2000-12")


def layout_text(spark: SparkSession, d: str) -> DataFrame:
    """The five stages of every candidate claim as text, without gates."""
    rows = told(spark, d)
    found = gates.sufficiency_gate(claims.told_candidates(rows)).withColumn("direction", stats.direction(F.col("pos"), F.col("neg")))
    found = gates.cut_lineage(conditions.cell_subjects(found, code_book(spark)))
    shown = layout.truncate(gates.cut_lineage(layout.first_told(rows, CELL, claims.cell_list())), CELL)
    return layout.render(found, shown, CELL).select(*CELL, "aspect", "layout")


def api_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews as the API writes them, parsed back; texts, flags and skin types are missing by turns."""
    r = adapters.reviews(spark, d)
    k = F.col("review_id") % 7
    skip = lambda n, c: F.when(k != n, c)
    made = F.to_json(F.struct(
        F.col("review_id").alias("reviewId"), skip(1, F.col("content")).alias("content"), F.col("rating").alias("reviewScore"), (F.col("likes") / 4).alias("usefulPoint"), F.col("likes").alias("recommendCount"),
        F.col("review_date").alias("createdDateTime"), skip(2, k == 3).alias("hasPhoto"), F.struct(F.lit("A000000000001").alias("goodsNumber"), F.concat(F.lit(" "), "option", F.lit(" ")).alias("optionName")).alias("goodsDto"),
        skip(4, F.struct(F.col("author").cast("string").alias("memberNickname"), F.col("skin_type").alias("skinType"), skip(5, F.col("troubles")).alias("skinTrouble"))).alias("profileDto")))
    found = adapters.parse_api(r.select(made.alias("json"), F.lit("A000000000001").alias("requested_goods_no")))
    return found.select("reviewId", "content", "rating", "usefulPoint", "recommendCount", "reviewDate", "hasPhoto", "isRepurchase", "goodsNo", "option", "userName", "skinType", F.array_join("skinTrouble", ",").alias("skinTrouble"))


QUERIES = {f.__name__: f for f in (
    ingest_records, trust_scores, trust_rank, identity_gate, duplicate_gate, cell_sizes, candidate_claims, ledger_rows, ledger_rollup, gate_summary,
    aspect_support, noise_threshold, rating_conflicts, conflicts_by_kind, segment_splits, unconditional_check, option_index, shade_counts, ranked_quotes,
    kept_quotes, evidence_months, quote_verdicts, quote_summary, quote_outcomes, quote_walk, quote_ledger, quote_gate_summary, folded_texts, tag_partition, review_contract, code_coverage, resolved_goods,
    overlapping_ranges, dependent_reviews, base_parity, vector_contract, golden_trace, golden_recall, claim_confidence, claim_summary, run_report, ingest_profile,
    trust_profile, pass_union, resume_products, sku_stats, crawl_outcomes, run_catalog, goods_in_urls, model_json, condition_questions, tag_batches,
    untagged_reviews, table_digest, lineages, catalog_contract, condition_subjects, cell_matches, option_scope, evidence_fates, claim_contract, golden_support,
    golden_contract, snapshot_guard, layout_text, api_reviews, flagship,
)}

ORACLES = {name: sql.QUERIES[name] for name in QUERIES if name in sql.QUERIES}
