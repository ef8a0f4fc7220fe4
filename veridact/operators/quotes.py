"""The quote gate: is a quote in the review it cites, nearly, elsewhere, or nowhere?"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold_invisible, fold_linebreaks, squeeze
from ..schemas import QUOTE_OUTCOMES, QUOTE_REASONS, QuotePolicy
from .shared import cut_lineage

#: Characters of a gram, and grams of a window of which the smallest hash is kept: a text and every
#: part of it of GRAM + WINDOW - 1 characters or more have one in common.
GRAM, WINDOW = 12, 16
#: Shorter quotes that one automaton holds; every text is scanned once for each automaton.
BLOCK = 50_000
#: Texts that a worker holds as Python objects at a time.
SLICE = 128


def minimizers(text: str) -> np.ndarray:
    """Distinct hashes of the grams that are the smallest of a window; none for shorter texts."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(codes) - GRAM + 1
    if n < WINDOW:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for i in range(GRAM):
            h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n] + np.uint64(1)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    width = 1
    while width < WINDOW:  # smallest of 2, 4, 8, 16 neighbours
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.unique(h).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of SLICE rows: a batch of 10,000 long texts isn't held as Python objects at once."""
    return (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE))


def _grams(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, gram) of every distinct minimizer of a row's text."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            found = [minimizers(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], [key, "grams"])

    return rows.select(key, text).mapInArrow(run, f"`{key}` {kind}, grams array<long>").select(key, F.explode("grams").alias("gram"))


def two_smallest(rows: DataFrame, by: str, value: str) -> DataFrame:
    """(by, a, b): the smallest value of each group and the next one (null: there is none)."""
    low = cut_lineage(rows.groupBy(by).agg(F.min(value).alias("a")))
    rest = rows.join(low, by).groupBy(by, "a").agg(F.min(F.when(F.col(value) > F.col("a"), F.col(value))).alias("b"))
    return rest.select(by, "a", "b")


def _scanned(texts: DataFrame, sought: dict[str, str]) -> DataFrame:
    """(qk, a, b) of the quotes (text to qk) that texts (folded, a, b) hold: for each batch of texts the two smallest ids.

    An Aho-Corasick automaton finds all quotes in one pass over a text, so the work is texts plus hits, not texts × quotes.
    """
    kind = texts.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for q, qk in sought.items():
            automaton.add_word(q, qk)
        automaton.make_automaton()
        for batch in _slices(batches):
            low: dict[str, list] = {}
            for text, *ids in zip(*(c.to_pylist() for c in batch.columns)):
                for qk in {k for _, k in automaton.iter(text)}:
                    low[qk] = sorted({*low.get(qk, ()), *(x for x in ids if x is not None)})[:2]
            a, b = [x[0] for x in low.values()], [x[1] if len(x) > 1 else None for x in low.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(low), pa.string()), pa.array(a, batch.column(1).type), pa.array(b, batch.column(1).type)], ["qk", "a", "b"])

    return texts.select("folded", "a", "b").mapInArrow(run, f"qk string, a {kind}, b {kind}")


def holders(quotes: DataFrame, texts: DataFrame) -> DataFrame:
    """(qk, a, b): for every sought quote (qk, q) the two smallest ids of texts (tk, folded, a, b) that hold it.

    A quote and a text that holds it share minimizers; the quote's rarest one is looked up, and what
    meets is compared. Both sides are distinct, so copies of either cost nothing. Quotes too short
    for a minimizer are the stated query set that goes in blocks against all rows.
    """
    index = cut_lineage(_grams(texts, "tk", "folded"))
    asked = cut_lineage(_grams(quotes, "qk", "q"))
    wanted = asked.select("gram").distinct()
    often = cut_lineage(index.join(wanted, "gram").groupBy("gram").agg(F.count("*").alias("n")))
    rarest = asked.join(often, "gram", "left").groupBy("qk").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("m"))
    picks = cut_lineage(rarest.where("m.n > 0").select("qk", F.col("m.gram").alias("gram")))
    met = cut_lineage(picks.join(index, "gram").select("qk", "tk"))
    long = met.join(quotes, "qk").join(texts, "tk").where(F.contains("folded", "q")).select("qk", "a", "b")
    short = quotes.where(F.char_length("q") < GRAM + WINDOW - 1)
    blocks = -(-short.count() // BLOCK)
    for i in range(blocks):
        some = short.where(F.pmod(F.xxhash64("qk"), F.lit(blocks)) == i).select("qk", "q").collect()  # about BLOCK quotes, each under 27 characters
        long = long.union(cut_lineage(_scanned(texts, {r.q: r.qk for r in some})))
    ids = long.select("qk", F.explode(F.array("a", "b")).alias("id")).where("id is not null")
    return two_smallest(cut_lineage(ids), "qk", "id")


def classify(evidence: DataFrame, reviews: DataFrame) -> DataFrame:
    """evidence (quote_id, review_id, quote) with status and matched_review_id.

    reviews: review_id, content. Blank and null quotes are blank_quote, whatever they cite. Only
    quotes that the cited review doesn't hold are looked for in the corpus; the smallest other id
    that holds the quote is named.
    """
    folded = reviews.select("review_id", F.col("content").alias("source"), fold_invisible(F.col("content")).alias("folded"))
    quotes = evidence.select("quote_id", "review_id", "quote", fold_invisible(F.col("quote")).alias("q"))
    own = quotes.join(folded, "review_id", "left")
    status = (
        F.when(F.coalesce(squeeze(F.col("q")), F.lit("")) == "", "blank_quote")
        .when(F.col("source").isNull(), "unknown_review").when(F.contains("folded", "q"), "verbatim")
        .when(F.contains(fold_linebreaks(F.col("source")), fold_linebreaks(F.col("quote"))), "linebreak_only")
        .when(F.contains(squeeze(F.col("source")), squeeze(F.col("quote"))), "spacing_edited")
    )
    first = cut_lineage(own.select("quote_id", "review_id", "q", status.alias("status")))
    failed = cut_lineage(first.where("status is null").select("quote_id", F.col("review_id").alias("cited"), F.md5("q").alias("qk"), "q"))
    texts = cut_lineage(folded.where("source is not null").select(F.md5("folded").alias("tk"), "folded", "review_id"))
    ids = two_smallest(texts.select("tk", "review_id"), "tk", "review_id")
    texts = cut_lineage(texts.dropDuplicates(["tk"]).select("tk", "folded").join(ids, "tk"))
    found = holders(failed.select("qk", "q").dropDuplicates(["qk"]), texts)
    named = F.when(F.col("a") != F.col("cited"), F.col("a")).otherwise(F.col("b"))
    hits = failed.join(found, "qk").select("quote_id", "cited", named.alias("matched_review_id")).distinct()
    rows = first.join(hits, (first["quote_id"] == hits["quote_id"]) & first["review_id"].eqNullSafe(hits["cited"]), "left").drop(hits["quote_id"])
    late = F.when(F.col("matched_review_id").isNotNull(), "misattributed").otherwise("fabricated")
    return rows.select("quote_id", "review_id", F.coalesce("status", late).alias("status"), F.when(F.col("status").isNull(), F.col("matched_review_id")).alias("matched_review_id"))


def walk(verdicts: DataFrame, policy: QuotePolicy = QuotePolicy()) -> DataFrame:
    """The gate's walk over each claim's quotes: verdicts with fate and kept_order.

    verdicts: claim_id, position (order within the claim's quotes, and within its spares), spare, review_id, status and any
    other columns. A claim's own quotes are all judged: kept or dropped. Its spares are then taken in order until as many are
    taken as were dropped, or policy.max_substitutions: a spare whose review is in use already is passed over
    (used_review), a verbatim one is taken (substituted), another is dropped too, and those behind
    the last that was needed are never judged (not_reached). kept_order counts what stays, the claim's own first. Defined
    cases: null status is dropped; null reviews are never in use; an empty table gives an empty result. A claim's quotes and
    spares are what one model answer holds: few.
    """
    mine = Window.partitionBy("claim_id")
    spare, good = F.coalesce("spare", F.lit(False)), F.coalesce(F.col("status") == "verbatim", F.lit(False))
    rows = verdicts.withColumn("_spare", spare).withColumn("_good", good)
    dropped = F.sum((~F.col("_spare") & ~F.col("_good")).cast("int")).over(mine)
    budget = dropped if policy.max_substitutions is None else F.least(dropped, F.lit(policy.max_substitutions))
    by_review = Window.partitionBy("claim_id", "review_id")
    known = F.col("review_id").isNotNull()
    # a spare can be the first to use its review if no quote of the claim stands on it and no verbatim spare before it has it
    before = by_review.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_budget", budget).withColumn("_own", known & (F.sum((~F.col("_spare") & F.col("_good")).cast("int")).over(by_review) > 0))
    rows = rows.withColumn("_again", known & (F.coalesce(F.sum((F.col("_spare") & F.col("_good")).cast("int")).over(before), F.lit(0)) > 0))
    fits = F.col("_spare") & F.col("_good") & ~F.col("_own") & ~F.col("_again")
    earlier = mine.orderBy(F.col("_spare").asc(), F.col("position").asc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_fits", fits).withColumn("_taken", F.coalesce(F.sum(F.col("_fits").cast("int")).over(earlier), F.lit(0)))
    fate = (
        F.when(~F.col("_spare"), F.when(F.col("_good"), "kept").otherwise("dropped")).when(F.col("_taken") >= F.col("_budget"), "not_reached")
        .when(F.col("_own") | F.col("_again"), "used_review").when(F.col("_good"), "substituted").otherwise("dropped")
    )
    rows = rows.withColumn("fate", fate).withColumn("_stays", F.col("fate").isin("kept", "substituted").cast("int"))
    kept = F.sum("_stays").over(mine.orderBy(F.col("_spare").asc(), F.col("position").asc()))
    return rows.withColumn("kept_order", F.when(F.col("_stays") == 1, kept.cast("int"))).select(*verdicts.columns, "fate", "kept_order")


def outcomes(walked: DataFrame, policy: QuotePolicy = QuotePolicy()) -> DataFrame:
    """(claim_id, evidence, kept, dropped, substituted, outcome) of walk()'s rows.

    evidence: quotes that the claim came with; kept: those that stay, spares among them; dropped: all that were, spares too.
    """
    n = lambda c: F.count(F.when(c, 1)).cast("int")
    fate, spare = F.col("fate"), F.coalesce("spare", F.lit(False))
    rows = walked.groupBy("claim_id").agg(
        n(~spare).alias("evidence"), n(fate.isin("kept", "substituted")).alias("kept"), n(fate == "dropped").alias("dropped"), n(fate == "substituted").alias("substituted"))
    outcome = (
        F.when(F.col("kept") < policy.min_evidence, "discarded").when(F.col("dropped") == 0, "clean").when(F.col("substituted") > 0, "substituted").otherwise("reduced")
    )
    return rows.withColumn("outcome", outcome)


def gate_ledger(walked: DataFrame, found: DataFrame, policy: QuotePolicy = QuotePolicy()) -> DataFrame:
    """Ledger rows of the quote gate: one for every dropped quote or spare, and one for every discarded claim.

    found: outcomes(). unit, claim_id, reason, label, status, review_id, quote_id and matched_review_id (null for
    claims), kept and needed (null for quotes).
    """
    reason = F.when(F.col("status") == "misattributed", "quote_misattributed").otherwise("quote_not_verbatim")
    label = lambda c: F.element_at(F.create_map(*[F.lit(x) for kv in QUOTE_REASONS.items() for x in kv]), c)
    quotes = walked.where("fate = 'dropped'").select(
        F.lit("evidence").alias("unit"), "claim_id", reason.alias("reason"), label(reason).alias("label"), "status", "review_id", "quote_id", "matched_review_id",
        F.lit(None).cast("int").alias("kept"), F.lit(None).cast("int").alias("needed"))
    none = F.lit("no_verbatim_evidence")
    claims = found.where("outcome = 'discarded'").select(
        F.lit("claim").alias("unit"), "claim_id", none.alias("reason"), label(none).alias("label"), F.lit(None).cast("string").alias("status"), *[F.lit(None).cast(walked.schema[c].dataType).alias(c) for c in ("review_id", "quote_id", "matched_review_id")],
        "kept", F.lit(policy.min_evidence).alias("needed"))
    return quotes.union(claims)


def evidence_violations(verdicts: DataFrame) -> DataFrame:
    """(claim_id, violation): claims without a quote of their own (no_evidence), and blank quotes (blank_quote); the gate isn't for them."""
    by = verdicts.groupBy("claim_id").agg(F.count(F.when(~F.coalesce("spare", F.lit(False)), 1)).alias("n"), F.count(F.when(F.col("status") == "blank_quote", 1)).alias("b"))
    found = F.filter(F.array(F.when(F.col("n") == 0, "no_evidence"), F.when(F.col("b") > 0, "blank_quote")), F.isnotnull)
    return by.select("claim_id", F.explode(found).alias("violation"))


def enforce(verdicts: DataFrame, policy: QuotePolicy = QuotePolicy()) -> DataFrame:
    """outcomes() of verdicts (claim_id, quote_id, review_id, status, spare), in the order of quote_id."""
    return outcomes(walk(verdicts.withColumn("position", F.col("quote_id")), policy), policy)


def gate_summary(walked: DataFrame, found: DataFrame) -> DataFrame:
    """One row: claims, quotes judged, verbatim ones and their percentage, ledger rows, claims by outcome."""
    judged = F.col("fate").isin("kept", "dropped", "substituted")
    checked = walked.where(judged).agg(
        F.count("*").alias("quotes_checked"), F.count(F.when(F.col("status") == "verbatim", 1)).alias("quotes_verbatim"), F.count(F.when(F.col("fate") == "dropped", 1)).alias("dropped"))
    by = found.agg(F.count("*").alias("claims"), *[F.count(F.when(F.col("outcome") == o, 1)).alias(o) for o in QUOTE_OUTCOMES])
    percent = F.coalesce(F.round(100 * F.col("quotes_verbatim") / F.nullif("quotes_checked", F.lit(0)), 1), F.lit(0.0))
    return by.crossJoin(checked).select("claims", "quotes_checked", "quotes_verbatim", percent.alias("verbatim_percent"), *QUOTE_OUTCOMES, (F.col("dropped") + F.col("discarded")).alias("ledger_rows"))  # one row each
