"""The quote gate and the unconditional check against plain walks."""

import random

import pytest
from pyspark.sql import functions as F

from veridact.operators import drafts, polarity, quotes
from veridact.schemas import ContractError, QuotePolicy

SCHEMA = "claim_id string, position int, spare boolean, quote_id int, review_id int, status string, matched_review_id int"


def plain_walk(rows, policy):
    """{(claim, quote): (fate, order)}, {claim: (evidence, kept, dropped, substituted, outcome)} by the list walk."""
    fates, outs = {}, {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c and not r[2]), key=lambda r: r[1])
        spares = sorted((r for r in rows if r[0] == c and r[2]), key=lambda r: r[1])
        kept, used, dropped, taken = [], set(), 0, 0
        for r in own:
            ok = r[5] == "verbatim"
            fates[c, r[3]] = "kept" if ok else "dropped"
            if ok:
                kept.append(r[3])
                used.add(r[4])
            dropped += not ok
        budget = dropped if policy.max_substitutions is None else min(dropped, policy.max_substitutions)
        for r in spares:
            if taken >= budget:
                fates[c, r[3]] = "not_reached"
            elif r[4] is not None and r[4] in used:
                fates[c, r[3]] = "used_review"
            elif r[5] == "verbatim":
                fates[c, r[3]] = "substituted"
                kept.append(r[3])
                used.add(r[4])
                taken += 1
            else:
                fates[c, r[3]] = "dropped"
                dropped += 1
        for q in [k for k in fates if k[0] == c]:
            fates[q] = (fates[q], kept.index(q[1]) + 1 if q[1] in kept else None)
        outcome = "discarded" if len(kept) < policy.min_evidence else "clean" if not dropped else "substituted" if taken else "reduced"
        outs[c] = (len(own), len(kept), dropped, taken, outcome)
    return fates, outs


@pytest.mark.parametrize("policy", [QuotePolicy(), QuotePolicy(2, 1), QuotePolicy(1, 0), QuotePolicy(3, None)])
def test_walk_is_the_list_walk(spark, policy):
    rnd = random.Random(repr(policy))
    rows, q = [], 0
    for c in range(150):
        for spare, n in ((False, rnd.randint(0, 4)), (True, rnd.randint(0, 6))):
            for i in range(n):
                q += 1
                rows.append((f"c{c}", i, spare, q, rnd.choice([None, 1, 2, 3, 4, 5]), rnd.choice(["verbatim", "verbatim", "fabricated", "misattributed", None]), None))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    walked = quotes.walk(df, policy)
    fates, outs = plain_walk(rows, policy)
    assert {(r.claim_id, r.quote_id): (r.fate, r.kept_order) for r in walked.collect()} == fates
    found = quotes.outcomes(walked, policy)
    assert {r.claim_id: tuple(r)[1:] for r in found.collect()} == outs
    ledger = quotes.gate_ledger(walked, found, policy).collect()
    assert sorted((r.claim_id, r.quote_id) for r in ledger if r.unit == "evidence") == sorted(k for k, f in fates.items() if f[0] == "dropped")
    assert {r.claim_id: (r.kept, r.needed, r.label) for r in ledger if r.unit == "claim"} == {c: (o[1], policy.min_evidence, "근거소진") for c, o in outs.items() if o[4] == "discarded"}
    paid = drafts.payloads(df.select("claim_id").distinct().withColumn("answer", F.lit("x")), walked, found).collect()
    for r in paid:
        want = [k[1] for k, f in sorted(fates.items(), key=lambda kv: kv[1][1] or 0) if k[0] == r.claim_id and f[1]]
        assert (r.payload is None) == (outs[r.claim_id][4] == "discarded")
        assert r.payload is None or [e.quote_id for e in r.payload.evidence] == want
    s = quotes.gate_summary(walked, found).first()
    assert (s.claims, s.quotes_checked, s.ledger_rows) == (len(outs), sum(f[0] in ("kept", "dropped", "substituted") for f in fates.values()), len(ledger))


def test_a_good_spare_reaches_the_payload(spark):
    rows = [("a", 0, False, 1, 1, "fabricated", None), ("a", 0, True, 2, 1, "misattributed", 9), ("a", 1, True, 3, 2, "verbatim", None), ("a", 2, True, 4, 3, "verbatim", None), ("only spares", 0, True, 5, 1, "verbatim", None), ("blank", 0, False, 6, 1, "blank_quote", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    walked = quotes.walk(df)
    assert {r.quote_id: r.fate for r in walked.collect()} == {1: "dropped", 2: "dropped", 3: "substituted", 4: "not_reached", 5: "not_reached", 6: "dropped"}
    found = quotes.outcomes(walked)
    claims = spark.createDataFrame([("a", "yes"), ("none", "no")], "claim_id string, answer string")
    got = {r.claim_id: (r.outcome, r.payload) for r in drafts.payloads(claims, walked, found).collect()}
    assert got["a"][0] == "substituted" and [tuple(e) for e in got["a"][1].evidence] == [(2, 3)] and got["none"] == (None, None)
    assert {tuple(r) for r in quotes.evidence_violations(df).collect()} == {("only spares", "no_evidence"), ("blank", "blank_quote")}
    assert {(r.quote_id, r.reason, r.label, r.matched_review_id) for r in quotes.gate_ledger(walked, found).where("claim_id = 'a'").collect()} == {(1, "quote_not_verbatim", "인용불일치", None), (2, "quote_misattributed", "출처불일치", 9)}
    empty = quotes.walk(df.where("false"))
    assert empty.collect() == [] and quotes.outcomes(empty).collect() == [] and quotes.gate_summary(empty, quotes.outcomes(empty)).first().verbatim_percent == 0.0
    for broken in ({"min_evidence": 0}, {"max_substitutions": -1}):
        with pytest.raises(ContractError):
            QuotePolicy(**broken)


SUPPORT = "product_id string, axis string, segment string, aspect string, pos int, neg int, neu int, spoke int, cell_authors int"


def support(spark, rows):
    return spark.createDataFrame([("p", axis, seg, asp, pos, neg, 0, pos + neg, cell) for axis, seg, asp, pos, neg, cell in rows], SUPPORT)


def test_small_segments_are_counted_not_compared(spark):
    rows = [("skinType", "A1", "x", 1, 0, 1), ("skinType", "A2", "x", 0, 1, 1), ("skinType", "A3", "x", 300, 0, 300), ("skinType", "A4", "x", 299, 1, 300), ("skinType", "미기재", "x", 5, 50, 60)]
    r = polarity.unconditional(support(spark, rows)).first()
    assert (r.compared, r.splits, r.contradicting_authors, r.skipped_unstated, r.skipped_insufficient, r.holds, r.failure) == (1, 0, 0, 1, 2, True, None)


def test_the_smaller_flipped_side_counts_once(spark):
    rows = [
        ("skinType", "A1", "x", 2, 30, 40), ("skinType", "A2", "x", 90, 5, 100), ("skinType", "A3", "x", 60, 2, 70), ("skinTrouble", "C1", "x", 20, 20, 50), ("skinTrouble", "C2", "x", 60, 0, 60),
        ("skinType", "A1", "alone", 9, 0, 9), ("product", "None", "x", 170, 40, 300), ("skinType", "A1", "quiet", 0, 0, 40)]
    got = {r.aspect: r for r in polarity.unconditional(support(spark, rows)).collect()}
    # A1 (30 negative) stands against both A2 and A3: once. C1 has no majority of its own, and C2 is the larger.
    x = got["x"]
    assert (x.compared, x.splits, x.flips, x.contradicting_authors, x.holds, x.failure) == (4, 3, 2, 30, False, "missing_condition")
    assert (got["alone"].compared, got["alone"].holds, got["quiet"].skipped_insufficient, got["quiet"].holds) == (0, True, 1, True)
    assert polarity.unconditional(support(spark, rows).where("false")).collect() == []
    equal = [("skinType", "A1", "x", 0, 40, 40), ("skinType", "A2", "x", 40, 0, 40)]
    assert polarity.unconditional(support(spark, equal)).first().contradicting_authors == 0  # neither is the smaller
    tied = [("skinType", "A1", "x", 0, 40, 40), ("skinType", "A2", "x", 60, 60, 120)]
    assert polarity.unconditional(support(spark, tied)).first().contradicting_authors == 40  # the other has no majority


def test_short_quotes_are_found_by_automata(spark, monkeypatch):
    """Overlapping, nested and repeated short quotes, in one automaton and in several, as by looking everywhere."""
    rnd = random.Random(4)
    texts = {i: "".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 30))) for i in range(1, 60)}
    texts |= {60: texts[1], 61: "", 62: None}
    asked = [(i, 1, "".join(rnd.choice("ab c") for _ in range(rnd.randint(1, 6)))) for i in range(200)]
    reviews = spark.createDataFrame(list(texts.items()), "review_id int, content string").repartition(4)
    evidence = spark.createDataFrame(asked, "quote_id int, review_id int, quote string")
    found = lambda q: sorted(i for i, t in texts.items() if t and q in t)
    for block in (50_000, 30):
        monkeypatch.setattr(quotes, "BLOCK", block)
        got = {r.quote_id: (r.status, r.matched_review_id) for r in quotes.classify(evidence, reviews).collect()}
        for i, _, q in asked:
            if not q.strip():
                assert got[i][0] == "blank_quote"
            elif got[i][0] in ("misattributed", "fabricated"):
                others = [x for x in found(q) if x != 1]
                assert got[i] == (("misattributed", others[0]) if others else ("fabricated", None)), q
    assert "NestedLoop" not in quotes.classify(evidence, reviews)._jdf.queryExecution().toString()
