"""Queries of contracts, claim rows and orders over the standard tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats, text
from ..operators import catalog, claims, contracts, drafts, gates, layout, ledger, options, polarity, records, registry, scopes, trust, vectors
from ..operators.shared import cut_lineage, numbered, scratch_path, spread
from ..schemas import ASPECTS, DRAFT_FIELDS, STAGES, QuotePolicy, TrustPolicy
from ..sources import adapters, json_arrays, vocabularies
from ..sources.adapters import table
from . import contract_oracles as sql
from .queries import CELL, cutoff_month, gated, golden_targets, golden_trace, judged, option_index
from .queries import told as told_reviews

KEY = [*CELL, "aspect"]


def raw_reviews(spark: SparkSession, d: str) -> DataFrame:
    """The review view under the raw rows' field names; conditions with blanks and repeats by turns."""
    r = adapters.reviews(spark, d)
    k = F.col("review_id") % 5
    odd = F.concat(F.transform("troubles", lambda t: F.concat(F.lit(" "), t)), F.array(F.lit(" "), F.lit("C03"), F.lit("C03")))
    return r.select(
        F.col("review_id").alias("reviewId"), "content", "rating", F.col("review_date").alias("reviewDate"), F.concat(F.lit(" "), F.col("author").cast("string")).alias("userName"), "option",
        F.when(k == 0, F.lit("  ")).otherwise(F.concat("skin_type", F.lit(" "))).alias("skinType"), F.when(k == 1, odd).otherwise(F.col("troubles")).alias("skinTrouble"), (k == 2).alias("hasPhoto"),
        (k == 3).alias("isMonthOverReview"), F.lit("x").alias("category"), F.lit(True).alias("isTopReviewer"), "product_id")


def closed_fields(spark: SparkSession, d: str) -> DataFrame:
    """Raw rows as JSON against the closed schema: some have a field too many, some lack one, some are no objects."""
    r = table(spark, d, "orders").select(F.col("o_orderkey").alias("review_id"))
    k = F.col("review_id") % 11
    names = [n for n in records.KNOWN_FIELDS if n != "hasPhoto"]
    pairs = F.concat(F.array(*[F.lit(f'"{n}": 1') for n in names]), F.when(k != 3, F.array(F.lit('"hasPhoto": true'))).otherwise(F.array().cast("array<string>")),
                     F.when(k == 5, F.array(F.lit('"rank": {"a": 1}'), F.lit('"shade": null'))).otherwise(F.array().cast("array<string>")))
    json = F.when(k == 7, F.lit("[1]")).otherwise(F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}")))
    return records.field_violations(r.select("review_id", json.alias("json")))


def review_records(spark: SparkSession, d: str) -> DataFrame:
    """The three layers of every record, laid flat."""
    found = records.build(records.drop_fields(raw_reviews(spark, d)))
    one = lambda a: [F.col(f"condition.{a}.{f}").alias(f"{a}_{f}") for f in ("code", "stated", "segment")]
    many = [F.array_join(f"condition.skinTrouble.{f}", ",").alias(f"skinTrouble_{f}") for f in ("codes", "segments")]
    return found.select("review_id", "product_id", "raw.content", "raw.rating", "raw.hasPhoto", *one("skinType"), *one("option"), *many, F.col("condition.skinTrouble.stated").alias("skinTrouble_stated"), "derived.*")


def condition_codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes in use that the book of codes lacks, with what is wrong with them."""
    r = adapters.reviews(spark, d)
    used = r.select(F.lit("skinTrouble").alias("axis"), F.explode("troubles").alias("code")).union(r.where("skin_type is not null").select(F.lit("skinType"), "skin_type"))
    used = used.union(r.select(F.lit("skinTrouble"), F.concat(F.lit("A0"), (F.col("review_id") % 4).cast("string"))))
    book = spark.createDataFrame([("skinTrouble", "C01"), ("skinTrouble", "C02"), ("skinType", "A01")], "axis string, code string")
    return records.code_violations(used, book)


def photo_trust(spark: SparkSession, d: str) -> DataFrame:
    """Trust scores where photos and long use count too, under a linear ramp."""
    r = adapters.reviews(spark, d).withColumn("has_photo", F.col("review_id") % 3 == 0).withColumn("month_over", F.when(F.col("review_id") % 4 != 0, F.col("review_id") % 4 == 1))
    policy = TrustPolicy(has_photo=0.2, usage_period=0.3, likes=0.1, shape="linear")
    found = trust.signals(r, policy)
    return found.select("review_id", "s_photo", "s_usage", "trust_score", F.array_join("unavailable", ",").alias("unavailable"))


def dedup_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = trust.signals(adapters.reviews(spark, d))
    k = F.col("review_id") % 13
    rows = rows.withColumn("author", F.when(k == 1, None).when(k == 2, F.lit(" ")).otherwise(F.col("author").cast("string")))
    rows = rows.withColumn("content_hash", F.when(k == 2, "").otherwise(F.col("content_hash"))).withColumn("trust_score", F.when(k == 3, None).when(k == 4, F.lit(float("nan"))).otherwise(F.col("trust_score")))
    return gates.dedup_key_violations(rows)


def reject_registry(spark: SparkSession, d: str) -> DataFrame:
    """A ledger with rows that may not be there."""
    k = F.col("o_orderkey") % 8
    gate = F.when(k == 0, "identity").when(k == 1, "polarity").when(k == 2, "taste").when(k.isin(3, 4, 5), "duplicate").when(k == 6, "sufficiency")
    reason = F.when(k == 3, "recency_cut").when(k == 4, "duplicate_semantic").when(k == 5, "same_author").when(k == 6, "typo").otherwise("recency_cut")
    return registry.registry_violations(table(spark, d, "orders").select(gate.alias("gate"), reason.alias("reason"), F.col("o_orderkey").cast("string").alias("subject")))


def said(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    member = claims.cells(adapters.reviews(spark, d))
    return member.join(adapters.tags(spark, d), "review_id"), member


def stance_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Before the duplicate gate, authors do stand on several sides."""
    return gates.stance_overlaps(said(spark, d)[0])


def outside_authors(spark: SparkSession, d: str) -> DataFrame:
    """Against cells that lack every seventh review, some speakers stand outside."""
    spoke, member = said(spark, d)
    return gates.authors_outside(spoke, member.where("review_id % 7 <> 0"))


def silent_cells(spark: SparkSession, d: str) -> DataFrame:
    return gates.silent_cells(judged(spark, d)[1])


def shade_axes(spark: SparkSession, d: str) -> DataFrame:
    return options.shade_axes(options.shade_counts(option_index(spark, d)))


def option_scopes(spark: SparkSession, d: str) -> DataFrame:
    """Every order's option, asked for on its own product or on the next one."""
    found = cut_lineage(option_index(spark, d))
    r = adapters.reviews(spark, d).where("option is not null")
    other = F.concat(F.lit("p"), F.lpad(((F.col("review_id") + 1) % 10).cast("string"), 3, "0"))
    asked = r.select(F.when(F.col("review_id") % 3 == 0, other).otherwise(F.col("product_id")).alias("product_id"), "option").distinct()
    return options.resolve_scopes(asked, found)


def passed_claims(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    found, _, member = judged(spark, d)
    return found.where("reason is null"), member


def claim_targets(spark: SparkSession, d: str) -> DataFrame:
    """The reviews behind each passed claim."""
    return drafts.targets(*passed_claims(spark, d))


def target_slice(spark: SparkSession, d: str) -> DataFrame:
    """The first hundred targets by claim id, which is what the operator is asked for."""
    return drafts.chosen(cut_lineage(passed_claims(spark, d)[0]), None, 100).select("claim_id", "product_id", "aspect")


def gate_parity(spark: SparkSession, d: str) -> DataFrame:
    """Before the duplicate gate, counts by review and by author differ."""
    member, said = claims.spoken(claims.cells(adapters.reviews(spark, d)), adapters.tags(spark, d))
    found = claims.counted(member, said).withColumn("silent", F.col("cell_authors") - F.col("spoke"))
    return gates.parity_violations(polarity.support(member, said, CELL), found)


def label_conditions(spark: SparkSession, d: str) -> DataFrame:
    """Labels of customers want a skin type, a trouble, both or none; their orders are the evidence."""
    r = adapters.reviews(spark, d)
    n = F.col("author") % 4
    labels = r.select("author").distinct().select(
        F.col("author").alias("label_id"), F.when(n == 0, F.array(F.lit("FURNITURE"))).when(n == 1, F.array(F.lit("미기재"))).alias("skin_types"), F.when(n >= 1, F.array(F.lit("C01"), F.lit("C02"))).alias("troubles"))
    return contracts.evidence_conditions(r.select(F.col("author").alias("label_id"), "review_id"), labels, r)


def draft_texts(spark: SparkSession, d: str) -> DataFrame:
    """Drafts of a model for the candidate claims, some of which say what isn't theirs to say."""
    found = claims.candidates(claims.cells(adapters.reviews(spark, d)), adapters.tags(spark, d))
    k = (F.col("pos") + F.col("neg") + F.col("neu")) % 7
    evidence = F.when(k == 1, "[]").when(k == 2, '[{"reviewId": 1, "quote": "q", "stance": "positive", "page": 3}]').otherwise('[{"reviewId": 1, "quote": "q", "stance": "positive"}]')
    question = F.when(k == 3, "건성 피부인데 괜찮나요").when(k == 4, "지성 이라서 걱정").otherwise("어떤가요")
    body = F.concat(F.lit('{"aspect": "a", "decisionAxis": "b", "verdict": "c", "answer": "d", "evidence": '), evidence, F.lit(', "question": "'), question, F.lit('"'),
                    F.when(k == 5, F.lit(', "support": {"positiveAuthors": 3}')).otherwise(""), F.lit("}"))
    return found.select(claims.claim_id().alias("claim_id"), "axis", "segment", F.when(k == 6, F.replace(body, F.lit('"verdict": "c", '), F.lit(""))).otherwise(body).alias("draft"))


def draft_contract(spark: SparkSession, d: str) -> DataFrame:
    return drafts.draft_violations(draft_texts(spark, d))


def claim_rows(spark: SparkSession, d: str) -> DataFrame:
    """Claim rows of the passed claims; the drafts are made up, the numbers the gates'."""
    passed = cut_lineage(passed_claims(spark, d)[0])
    made = passed.select("claim_id", F.lit("fit").alias("decision_axis"), F.concat("aspect", F.lit("?")).alias("question"), F.lit("yes").alias("verdict"), F.lit("so").alias("answer"), F.array(F.lit(1)).alias("evidence"))
    found = drafts.claim_rows(passed, made)
    on = lambda a: F.array_join(f"condition.{a}", ",").alias(a)
    return found.select("schema_version", "claim_id", "product_id", "question", on("skinType"), on("skinTrouble"), "claim_type", "direction", "counts.*", F.array_join("limitations", ",").alias("limitations"), "failure_reason")


def claim_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Claim rows read back after some of them were broken."""
    r = table(spark, d, "orders").select(F.col("o_orderkey").alias("n"))
    k = F.col("n") % 9
    keys = F.when(k == 0, F.array(F.lit("duplicate_claim"), F.lit("misattribution"))).when(k == 1, F.array(F.lit("misattribution"), F.lit("duplicate_claim"))).when(k == 2, F.array(F.lit("bad_taste"))).when(k < 8, F.array().cast("array<string>"))
    one = F.array(F.lit("A01"))
    skin = F.when(k == 3, one).when(k == 4, F.array(F.lit("미기재"), F.lit("A01"))).when(k == 8, F.array(F.lit("미기재")))
    rows = r.select(
        F.col("n").cast("string").alias("claim_id"), F.when(k == 5, "claim-v0").otherwise("claim-v1").alias("schema_version"), keys.alias("failure_reasons"), F.when(k.isin(0, 1), "misattribution").when(k == 6, "duplicate_claim").alias("failure_reason"),
        F.when(k.isin(4, 7, 8), "conditional").otherwise("unconditional").alias("claim_type"), F.struct(skin.alias("skinType"), F.lit(None).cast("array<string>").alias("skinTrouble")).alias("condition"))
    return drafts.round_trip_violations(rows)


def failure_order(spark: SparkSession, d: str) -> DataFrame:
    """Failures of conversation turns, worst first."""
    k = F.col("turn") + F.col("conv_id")
    some = F.filter(F.array(*[F.when(k % (i + 2) == 0, F.lit(key)) for i, (key, _, _) in enumerate(registry.FAILURES)]), F.isnotnull)
    found = registry.sort_failures(F.reverse(some))
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(found, ",").alias("failures"), F.get(found, F.lit(0)).alias("failure"))


def condition_assertions(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("conv_id") % 4
    ask = F.concat("text", F.when(k == 0, " 건성 인데").when(k == 1, " 모공이라").when(k == 2, " 트러블 피부라서").otherwise(" 주름"))
    return table(spark, d, "conversations").select("conv_id", "turn", drafts.asserts_condition(ask).alias("asserts"))


def gated_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Six documents a claim, three of them spares, citing themselves well or badly, under a policy of at most two spares;
    some spares cite the review of the claim's second quote, and claims without a quote left have no payload."""
    from ..operators import quotes

    k, n = F.col("doc_id") % 6, F.floor(F.col("doc_id") / 6)
    bad = (F.col("doc_id") * 7 + n) % 5 < 2
    cites = F.when((k >= 3) & ((F.col("doc_id") + n) % 4 == 0), n * 6 + 1).otherwise(F.col("doc_id"))
    rows = table(spark, d, "documents").select(n.alias("claim_id"), k.cast("int").alias("position"), F.col("doc_id").alias("quote_id"), cites.alias("review_id"), F.when(bad | (n % 17 == 0), "fabricated").otherwise("verbatim").alias("status"), (k >= 3).alias("spare"))
    policy = QuotePolicy(min_evidence=1, max_substitutions=2)
    walked = cut_lineage(quotes.walk(rows, policy))
    made = rows.select("claim_id").distinct().withColumn("answer", F.concat(F.lit("answer "), "claim_id"))
    found = drafts.payloads(made, walked, quotes.outcomes(walked, policy))
    return found.select("claim_id", "outcome", "payload.answer", F.array_join(F.transform("payload.evidence", lambda e: F.concat_ws(":", e["quote_id"], e["review_id"])), ",").alias("evidence"))


def scoped_labels(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Labels traced under the whole product or one of three shades; some name an option that nobody bought, or a pack. Each cites its
    own order, the next of its product and one of another product."""
    n = F.col("review_id")
    shade = lambda k: F.concat(F.lit("0"), (k % 3 + 1).cast("string"), F.lit("호 로즈"), (k % 3 + 1).cast("string"))
    option = F.when(n % 7 == 0, None).when(n % 11 == 0, "50ml").otherwise(F.concat(F.when(n % 4 == 0, "[기획] ").otherwise(""), shade(F.floor(n / 10))))
    rows = cut_lineage(adapters.reviews(spark, d).withColumn("option", option))
    indexed = cut_lineage(options.index(rows.where("option is not null")))
    tags = cut_lineage(adapters.tags(spark, d))
    known = indexed.select("product_id", F.col("option").alias("stripped"), "kind", "shade_key")
    keyed = rows.withColumn("stripped", text.strip(F.col("option"))).join(known, ["product_id", "stripped"], "left").drop("stripped")
    first = cut_lineage(gates.identity_gate(keyed, adapters.products(spark, d), cutoff_month(rows)))
    scored = trust.ranked(trust.signals(first.where("reason is null").select("review_id", "product_id", "content", "likes", "review_date"), tagged=tags))
    first = cut_lineage(first.drop("content").join(scored.select("review_id", "rank", "content_hash"), "review_id", "left"))
    key = F.col("key")
    asks = F.when(key % 5 == 0, None).when(key % 23 == 0, "never sold").when(key % 29 == 0, "50ml").otherwise(shade(key))
    labels = golden_targets(spark, d).withColumn("option", asks)
    cited = labels.select("key", F.explode(F.array(key, key + 10, key + 1)).alias("review_id"))
    traced, fates = scopes.trace(labels, cited, first, tags, indexed, ["ECONOMY", "STANDARD", "PROMO", "MEDIUM", "SMALL", "LARGE"])
    return traced, fates


def scoped_trace(spark: SparkSession, d: str) -> DataFrame:
    return scoped_labels(spark, d)[0].withColumn("limitations", F.array_join("limitations", ","))


def scoped_fates(spark: SparkSession, d: str) -> DataFrame:
    return scoped_labels(spark, d)[1]


def parity_fields(spark: SparkSession, d: str) -> DataFrame:
    """Orders against a copy with other ratings, other dates, rows that lack and one row twice, field by field."""
    r = adapters.reviews(spark, d)
    a = r.select("review_id", F.struct("rating", F.struct("review_date", "likes").alias("more")).alias("raw"), "troubles", "skin_type")
    n = F.col("review_id")
    date = F.when(n % 350 == 0, "1970.01.01").otherwise(F.col("review_date"))
    b = r.select("review_id", F.struct(F.when(n % 100 == 0, F.col("rating") + 1).otherwise(F.col("rating")).alias("rating"), F.struct(date.alias("review_date"), "likes").alias("more")).alias("raw"),
                 F.when(n % 600 == 5, F.array().cast("array<string>")).otherwise(F.col("troubles")).alias("troubles"), F.when(n % 500 == 3, None).otherwise(F.col("skin_type")).alias("skin_type"), F.lit(1).alias("extra"))
    b = b.where(n % 1001 != 1)
    return contracts.field_differences(a.where(n % 1000 != 7), b.union(b.where(n == 8)), "review_id")


def told(spark: SparkSession, d: str) -> DataFrame:
    """Tags as a table, dealt by review: two scratch tables would meet in a fixed number of tasks."""
    tags = cut_lineage(adapters.tags(spark, d))
    return spread(tags, tags.count(), "review_id")


def layout_rows(spark: SparkSession, d: str) -> DataFrame:
    """The layouts of all candidate claims as stages, without gates."""
    rows = told_reviews(spark, d)
    found = gates.sufficiency_gate(claims.told_candidates(rows)).withColumn("direction", stats.direction(F.col("pos"), F.col("neg"))).withColumn("subject", F.concat_ws("=", "axis", "segment"))
    all_ = layout.totals(claims.apart(rows.withColumn("month", text.month_of(F.col("review_date"))), ["product_id", "month"]), CELL)
    made = layout.arranged(cut_lineage(found), cut_lineage(layout.truncate(cut_lineage(layout.first_told(rows, CELL, claims.cell_list())), CELL)), all_, CELL)
    e, s, g = F.col("evidence_stage"), F.col("sufficiency_stage"), F.col("direction_stage")
    quotes = F.array_join(F.transform(e["quotes"], lambda q: F.concat_ws(":", q["quote_rank"], q["polarity"], q["review_id"])), ";")
    return made.select(
        *KEY, F.col("condition_stage.text").alias("subject"), e["total"].alias("total"), e["shown"].alias("shown"), e["omitted"].alias("omitted"), e["first_month"].alias("first_month"), e["last_month"].alias("last_month"),
        F.array_join(e["reserved"], ",").alias("reserved"), quotes.alias("quotes"), g["direction"].alias("direction"), g["spoke"].alias("spoke"), s["passed"].alias("passed"), s["silent"].alias("silent"))


def layout_contract(spark: SparkSession, d: str) -> DataFrame:
    """Candidate claims of the plain view whose counts by author and by review aren't of one cell: authors who speak twice."""
    member = cut_lineage(claims.cells(adapters.reviews(spark, d)))
    tags = told(spark, d)
    found = cut_lineage(gates.sufficiency_gate(claims.candidates(member, tags)))
    all_ = layout.totals(member.withColumn("month", text.month_of(F.col("review_date"))).join(tags, "review_id"), CELL)
    return layout.arrangement_violations(found, polarity.aspect_support(member, tags, CELL), all_, CELL)


def swap_specs() -> tuple[vectors.EmbeddingSpec, vectors.EmbeddingSpec]:
    digest = vectors.vocabulary_digest(ASPECTS)
    return tuple(vectors.EmbeddingSpec(f"emb-v{i}", f"some/model-{i}", 64, 512, f"aspect-v{i}", f"gold-v{i}", digest, ((f"emb-v{i}", f"aspect-v{i}", f"gold-v{i}"),)) for i in (1, 2))


def swap_backfill(spark: SparkSession, d: str) -> DataFrame:
    """A swap half done: which vectors of the table have to be made again, and why."""
    k = F.col("vec_id") % 10
    v = table(spark, d, "embeddings").withColumn("model", F.when(k < 4, "some/model-2").when(k < 8, "some/model-1").when(k == 8, "a/third")).withColumn("embedding_version", F.when(k < 4, "emb-v2").when(k < 9, "emb-v1"))
    v = v.withColumn("embedding", F.when(k == 1, F.slice("embedding", 1, 63)).when(k == 2, None).otherwise(F.col("embedding")))
    return vectors.backfill(v, *swap_specs())


def swap_state(spark: SparkSession, d: str) -> DataFrame:
    row = vectors.swap_barrier(swap_backfill(spark, d), vocabulary=True)
    return row.withColumn("pending", F.array_join("pending", ","))


def generation_results(spark: SparkSession, d: str) -> DataFrame:
    found, _, _ = judged(spark, d)
    skipped = F.when(F.col("spoke") % 3 == 0, F.concat(F.lit("model: "), "aspect")).when(F.col("spoke") % 3 == 1, "quote gate: nothing left")
    return found.where("reason is null").select("claim_id", "axis", skipped.alias("skipped"))


def generation_meta(spark: SparkSession, d: str) -> DataFrame:
    return drafts.generation_meta(generation_results(spark, d))


def skip_reasons(spark: SparkSession, d: str) -> DataFrame:
    return drafts.skip_reasons(generation_results(spark, d))


def vector_stamps(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of a release; some were stamped by another, some not at all, some are broken."""
    spec = vectors.EmbeddingSpec("emb-v1", "some/model", 64, 512, "aspect-v1", "gold-v2", vectors.vocabulary_digest(ASPECTS), (("emb-v1", "aspect-v1", "gold-v2"),))
    v = vectors.stamp(table(spark, d, "embeddings"), spec)
    k = F.col("vec_id") % 20
    v = v.withColumn("model", F.when(k == 1, None).when(k == 2, "another/model").otherwise(F.col("model"))).withColumn("embedding_version", F.when(k == 2, "emb-v0").otherwise(F.col("embedding_version")))
    e = F.col("embedding")
    v = v.withColumn("embedding", F.when(k == 3, F.slice(e, 1, 10)).when(k == 4, F.concat(F.slice(e, 1, 63), F.array(F.lit(float("inf")).cast("float")))).otherwise(e))
    return vectors.stamp_violations(v, spec)


def golden_misses(spark: SparkSession, d: str) -> DataFrame:
    """How many labels weren't produced, by the gate and the reason, the untraceable among them."""
    return ledger.misses(golden_trace(spark, d))


def claim_order(spark: SparkSession, d: str) -> DataFrame:
    """Candidate claims in the order of emission: product, axis, segment, aspect."""
    found = cut_lineage(claims.candidates(claims.cells(adapters.reviews(spark, d)), adapters.tags(spark, d)).select(*KEY))
    axis = F.when(F.col("axis") == "product", 0).when(F.col("axis") == "skinType", 1).otherwise(2)
    return numbered(found, [], [F.asc("product_id"), axis.asc(), F.asc("segment"), F.asc("aspect")], "position")


def conflict_order(spark: SparkSession, d: str) -> DataFrame:
    found = cut_lineage(polarity.rating_conflicts(adapters.reviews(spark, d), adapters.tags(spark, d)).select("review_id", "aspect", "kind"))
    return numbered(found, [], [F.asc("review_id"), F.asc("aspect")], "position")


def split_order(spark: SparkSession, d: str) -> DataFrame:
    found = polarity.segment_splits(claims.candidates(claims.cells(adapters.reviews(spark, d)), adapters.tags(spark, d)))
    found = cut_lineage(found.where("split").select("product_id", "axis", "aspect", "left", "right"))
    return numbered(found, [], [F.asc(c) for c in ("product_id", "axis", "left", "right", "aspect")], "position")


def count_order(spark: SparkSession, d: str) -> DataFrame:
    """Tags by aspect and polarity, most first."""
    found = cut_lineage(adapters.tags(spark, d).groupBy("aspect", "polarity").agg(F.count("*").alias("n")))
    return numbered(found, [], [F.desc("n"), F.asc("aspect"), F.asc("polarity")], "position")


def stage_order(spark: SparkSession, d: str) -> DataFrame:
    """Layouts with their stages, some out of order, one short, or numbered wrongly."""
    k = F.col("o_orderkey") % 6
    right = F.array(*[F.struct(F.lit(i + 1).alias("stage"), F.lit(s).alias("key")) for i, s in enumerate(STAGES)])
    stages = F.when(k == 0, F.reverse(right)).when(k == 1, F.slice(right, 1, 4)).when(k == 2, F.transform(right, lambda s: F.struct((s["stage"] - 1).alias("stage"), s["key"].alias("key")))).when(k != 3, right)
    return contracts.stage_order_violations(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), stages.alias("stages")))


def crawl_contract(spark: SparkSession, d: str) -> DataFrame:
    """Fields of a crawl that nobody placed, with the rows that have them."""
    k = F.col("l_linenumber")
    json = F.concat(F.lit('{"reviewId": 1, "content": "x"'), F.when(k > 3, F.concat(F.lit(', "new'), k.cast("string"), F.lit('": 1'))).otherwise(""), F.lit("}"))
    found = records.field_violations(table(spark, d, "lineitem").select(json.alias("json")))
    return found.where("violation = 'unknown_field'").groupBy("field").agg(F.count("*").alias("rows"))


def array_reviews(spark: SparkSession, d: str) -> DataFrame:
    """The review view written as JSON arrays, with texts full of marks, and read back under the closed schema."""
    r = adapters.reviews(spark, d)
    made = {"reviewId": F.col("review_id"), "content": F.concat("content", F.lit(' }{"a": [\\"]}')), "rating": F.col("rating"), "reviewDate": F.col("review_date"),
            "userName": F.col("author").cast("string"), "option": F.col("option"), "skinType": F.col("skin_type"), "skinTrouble": F.col("troubles"), "recommendCount": F.col("likes").cast("int")}
    path = scratch_path(spark)
    json_arrays.write(r.select(*[made.get(f, F.lit(None).cast("string")).alias(f) for f in records.KNOWN_FIELDS]), path)
    back = adapters.read_reviews(spark, path)
    return back.select("reviewId", "content", "rating", "reviewDate", "userName", "option", "skinType", F.array_join("skinTrouble", ",").alias("troubles"), "recommendCount")


def file_codebook(spark: SparkSession, d: str) -> DataFrame:
    """A codebook of the tables' dimensions, written as a file, loaded under its contract, and how often its codes are used."""
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    code = lambda letter, n: F.concat(F.lit(letter), F.lpad(n.cast("string"), 2, "0")).alias("code")
    trouble = F.substring("p_brand", 7, 1)
    entries = (
        nation.select(F.lit("skinType").alias("axis"), code("A", F.col("n_nationkey")), F.col("n_name").alias("label"))
        .union(region.select(F.lit("skinTone"), code("B", F.col("r_regionkey")), "r_name"))
        .union(table(spark, d, "part").select(F.lit("skinTrouble"), code("C", trouble), F.concat(F.lit("brand "), trouble)).distinct())
    )
    path = scratch_path(spark)
    axes = entries.groupBy("axis").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "label")))).alias("m"))
    axes.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("axis", F.map_entries("m").alias("m"))))).alias("m")).select(
        F.to_json(F.transform_values("m", lambda k, v: F.map_from_entries(v))).alias("value")).coalesce(1).write.text(path)
    found = (
        table(spark, d, "customer").select(F.lit("skinType").alias("axis"), code("A", F.col("c_nationkey")))
        .union(nation.select(F.lit("skinTone"), code("B", F.col("n_regionkey"))))
        .union(adapters.reviews(spark, d).select(F.lit("skinTrouble"), F.explode("troubles")))
    )
    return vocabularies.labelled_uses(found, vocabularies.codebook(spark, path).value)


QUERIES = {f.__name__: f for f in (
    array_reviews, file_codebook, closed_fields, review_records, condition_codes, photo_trust, dedup_keys, reject_registry, stance_overlaps, outside_authors, silent_cells, shade_axes, option_scopes,
    claim_targets, target_slice, gate_parity, label_conditions, draft_contract, claim_rows, claim_round_trip, failure_order, condition_assertions, gated_payloads,
    scoped_trace, scoped_fates, parity_fields, layout_rows, layout_contract, swap_backfill, swap_state, generation_meta, skip_reasons, vector_stamps, golden_misses, claim_order, conflict_order, split_order, count_order, stage_order, crawl_contract,
)}
ORACLES = {name: sql.QUERIES[name] for name in QUERIES}
