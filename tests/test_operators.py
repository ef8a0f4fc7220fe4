import json

import pytest
from pyspark.sql import functions as F

from veridact.operators import catalog, claims, conditions, contracts, ledger, options, polarity, profile, quotes, records, trust
from veridact.schemas import ContractError, SufficiencyPolicy, TrustPolicy
from veridact.sources import adapters


def test_trust_scores(spark):
    rows = [(1, "p", "x" * 22, 5, "2024.01.01"), (2, "p", "y" * 478, 1, "2024.01.02"), (3, "p", "z" * 250, 5, "2024.01.03"), (4, "q", "z" * 250, 0, "2024.01.04")]
    df = spark.createDataFrame(rows, "review_id int, product_id string, content string, likes int, review_date string")
    tags = spark.createDataFrame([(2,), (3,)], "review_id int")
    got = {r.review_id: r for r in trust.ranked(trust.signals(df, tagged=tags)).collect()}
    assert (got[1].s_length, got[2].s_length, got[3].s_length) == (0.0, 1.0, round(0.5**0.5, 6))
    assert (got[1].s_unique, got[3].s_unique, got[4].s_unique) == (1.0, 0.5, 0.5)
    assert (got[1].s_likes, got[2].s_likes, got[4].s_likes) == (0.5, 0.0, 0.0)
    assert got[2].trust_score == 1.0 and got[2].rank == 1 and got[4].rank == 1
    assert got[1].trust_score == round(0.4 / 1.5, 4)
    with pytest.raises(ContractError):
        TrustPolicy(content_length=0, unique_content=0, on_topic=0)
    with pytest.raises(ContractError):
        SufficiencyPolicy(s_min=3, n_min=8)


def test_cells_and_claims_count_authors_not_reviews(spark):
    rows = [(1, "p", 7, None, ["C1", "C2", "C1"]), (2, "p", 7, "A1", []), (3, "p", 8, "A1", ["C1"])]
    reviews = spark.createDataFrame(rows, "review_id int, product_id string, author int, skin_type string, troubles array<string>")
    tags = spark.createDataFrame([(1, "x", "positive"), (2, "x", "positive"), (3, "x", "negative")], "review_id int, aspect string, polarity string")
    member = claims.cells(reviews)
    sizes = {(r.axis, r.segment): r.cell_authors for r in claims.cell_sizes(member).collect()}
    assert sizes == {("product", "None"): 2, ("skinType", "미기재"): 1, ("skinType", "A1"): 2, ("skinTrouble", "C1"): 2, ("skinTrouble", "C2"): 1, ("skinTrouble", "미기재"): 1}
    found = {(r.axis, r.segment): (r.pos, r.neg, r.spoke) for r in claims.candidates(member, tags).collect()}
    assert found["product", "None"] == (1, 1, 2) and found["skinTrouble", "C1"] == (1, 1, 2)


def test_conditions(spark):
    rows = [(1, None, ["C1", "C2"], None), (2, "A1", ["C1"], "o"), (3, None, [], None)]
    df = spark.createDataFrame(rows, "id int, skin_type string, troubles array<string>, option string")
    ids = lambda c: [r.id for r in df.where(conditions.fits(c)).orderBy("id").collect()]
    assert ids({"skinType": None}) == [1, 2, 3] and ids({"skinType": "미기재"}) == [1, 3]
    assert ids({"skinTrouble": ["C1", "C2"]}) == [1] and ids({"skinTrouble": "미기재"}) == [3] and ids({"option": "o"}) == [2]
    for broken in ({"skinType": ["A1"]}, {"usagePeriod": "x"}):
        with pytest.raises(ContractError):
            conditions.fits(broken)
    codes = spark.createDataFrame([(["C1", "C2"], ["잡티", "주름"]), (["미기재"], ["x"]), ([], [])], "c array<string>, l array<string>")
    text = conditions.axis_text("skinTrouble", F.col("c"), F.col("l"))
    assert [r[0] for r in codes.select(conditions.subject([text])).collect()] == ["잡티·주름 고민", "피부고민을 안 밝힌 리뷰", "조건 없음 (이 제품 리뷰 전체)"]


def test_catalog(spark):
    products = spark.createDataFrame(
        [("p1", "L1", None, "separate", None), ("p2", "L1", "2020-01", "separate", "A2"), ("p3", "L2", None, "single", "A3"), ("p4", "L3", None, "single", None), ("p5", "L3", "2021-01", "separate", None)],
        "product_id string, lineage_id string, from_month string, renewal_policy string, requested_goods_no string")
    got = {r.product_id: (r.generation, r.current, r.previous) for r in catalog.generations(products).collect()}
    assert got == {"p1": (1, False, True), "p2": (2, True, False), "p3": (1, True, False), "p4": (1, False, False), "p5": (2, False, False)}
    bridge = spark.createDataFrame([("g1", "p1", None, "2020-06"), ("g1", "p2", "2020-01", None), ("g2", "p3", None, None), ("g2", "p4", None, "2000-01")], "goods_no string, product_id string, from_month string, to_month string")
    found = {(r.subject, r.violation) for r in catalog.catalog_violations(products, bridge).collect()}
    assert found == {("L3", "generations_not_separate"), ("L3", "not_one_on_sale"), ("g1", "overlapping_ranges"), ("g2", "overlapping_ranges"), ("g2", "shared_across_lineages"), ("g2", "shared_with_open_range")}


def test_goods_are_resolved_by_month(spark):
    bridge = spark.createDataFrame([("g", "old", None, "2020-01"), ("g", "new", "2020-02", None), ("h", "one", "2020-05", None)], "goods_no string, product_id string, from_month string, to_month string")
    reviews = spark.createDataFrame([(1, "g", "2020-01"), (2, "g", "2021-01"), (3, "h", "1999-01"), (4, "x", "2020-01")], "review_id int, goods_no string, month string")
    got = {r.review_id: (r.product_id, r.matches) for r in contracts.resolve_goods(reviews, bridge).collect()}
    assert got == {1: ("old", 1), 2: ("new", 1), 3: ("one", 1), 4: (None, 0)}


def test_tags_fall_for_the_later_one(spark):
    reviews = spark.createDataFrame([(1, "ab cd")], "review_id int, content string")
    tags = [(1, "a1", "positive", "ab"), (2, "a1", "negative", "cd"), (3, "zz", "positive", "ab"), (4, "a2", "odd", "ab"), (5, "a2", "positive", "ac"), (6, "a2", "positive", "cd")]
    tags += [(6 + i, f"a{i}", "neutral", "ab") for i in range(3, 7)]
    df = spark.createDataFrame([(i, 1, *t) for i, *t in tags] + [(99, 2, "a1", "positive", "ab")], "ord int, review_id int, aspect string, polarity string, snippet string")
    got = {r.ord: r.violation for r in contracts.tag_partition(df, reviews, [f"a{i}" for i in range(1, 9)]).collect()}
    assert got == {1: None, 2: "duplicate_aspect", 3: "unknown_aspect", 4: "unknown_polarity", 5: "not_verbatim", 6: None, 9: None, 10: None, 11: None, 12: "too_many_aspects", 99: "unknown_review"}
    with pytest.raises(ContractError):
        contracts.assert_none(reviews, "rows")
    contracts.assert_none(reviews.where("false"), "rows")


def test_conflicts(spark):
    reviews = spark.createDataFrame([(1, 5), (2, 1), (3, 3), (4, 5)], "review_id int, rating int")
    tags = spark.createDataFrame([(1, "a", "negative"), (2, "a", "positive"), (2, "b", "positive"), (3, "a", "negative"), (4, "a", "negative"), (4, "b", "positive"), (4, "c", "neutral")], "review_id int, aspect string, polarity string")
    got = {(r.review_id, r.aspect): r.kind for r in polarity.rating_conflicts(reviews, tags).collect()}
    assert got == {(1, "a"): "sole_aspect", (2, "a"): "all_aspects", (2, "b"): "all_aspects", (4, "a"): "minority_aspect"}


def test_quotes(spark):
    reviews = spark.createDataFrame([(1, "one two\nthree"), (2, "four five")], "review_id int, content string")
    asked = [(1, 1, "two\nthree"), (2, 1, "two three"), (3, 1, "onetwo"), (4, 1, "four"), (5, 1, "never"), (6, 9, "one")]
    got = {r.quote_id: (r.status, r.matched_review_id) for r in quotes.classify(spark.createDataFrame(asked, "quote_id int, review_id int, quote string"), reviews).collect()}
    assert got == {1: ("verbatim", None), 2: ("linebreak_only", None), 3: ("spacing_edited", None), 4: ("misattributed", 2), 5: ("fabricated", None), 6: ("unknown_review", None)}
    verdicts = [("a", 1, 1, "verbatim", False), ("a", 2, 2, "fabricated", False), ("a", 3, 1, "verbatim", True), ("a", 4, 3, "verbatim", True), ("b", 5, 1, "fabricated", False), ("c", 6, 1, "verbatim", False)]
    df = spark.createDataFrame(verdicts, "claim_id string, quote_id int, review_id int, status string, spare boolean")
    assert {r.claim_id: (r.kept, r.dropped, r.substituted, r.outcome) for r in quotes.enforce(df).collect()} == {"a": (2, 1, 1, "substituted"), "b": (0, 1, 0, "discarded"), "c": (1, 0, 0, "clean")}


def test_options(spark):
    forms = ["[기획] 01호 로즈", "01 로즈", "로즈", "[세트] 로즈", "02호 피치 3g", "[N] 02호 피치", "[N] 로즈", "50ml", "+증정", " ", None]
    df = spark.createDataFrame([("p", f) for f in forms], "product_id string, option string")
    got = {r.option: (r.kind, r.shade_key) for r in options.index(df.where("option is not null")).collect()}
    assert got["[기획] 01호 로즈"] == got["01 로즈"] == got["로즈"] == got["[N] 로즈"] == ("shade", "1|로즈")
    assert got["02호 피치 3g"] == got["[N] 02호 피치"] == ("shade", "2|피치")
    assert got["50ml"] == ("pack", None)


def test_claim_and_label_contracts(spark):
    schema = "claim_id string, aspect string, direction string, claim_type string, pos int, neg int, neu int, spoke int, silent int, support int, evidence array<int>"
    rows = [("good", "a", "mixed", "conditional", 1, 1, 0, 2, 0, 2, [1, 2]), ("bad", " ", "positive", "x", 0, 1, 0, 3, -1, 4, [1, 1]), ("bare", "a", "neutral", "unconditional", 0, 0, 1, 1, 0, 0, None)]
    got = sorted((r.claim_id, r.violation) for r in contracts.claim_violations(spark.createDataFrame(rows, schema)).collect())
    assert got == sorted([("bad", v) for v in ("blank_aspect", "negative_count", "spoke_is_not_the_sum", "support_beyond_spoke", "evidence_twice", "direction_not_derived", "unknown_type")] + [("bare", "no_evidence")])
    reviews = spark.createDataFrame([(1, "p", 7, "abc"), (2, "p", 7, "xyz"), (3, "q", 8, "mno")], "review_id int, product_id string, author int, content string")
    evidence = spark.createDataFrame([(1, 1, "positive", "ab"), (1, 2, "negative", "xyz"), (2, 3, "positive", "zz"), (2, 3, "positive", "zz")], "label_id int, review_id int, stance string, quote string")
    labels = spark.createDataFrame([(1, "p", None, "mixed", 3), (2, "p", "nope", "negative", 0), (3, "p", "a", "positive", 1)], "label_id int, product_id string, aspect string, direction string, minutes int")
    found = sorted((r.label_id, r.violation) for r in contracts.label_violations(labels, evidence, reviews, ["a"]).collect())
    assert found == sorted([(2, v) for v in ("direction_not_derived", "evidence_twice", "minutes_not_positive", "not_verbatim", "review_outside_bundle", "unknown_aspect")] + [(3, "no_evidence")])
    support = contracts.label_support(evidence, reviews).where("label_id = 1").first()
    assert (support.pos, support.neg, support.spoke, support.direction) == (1, 1, 1, "mixed")


def test_ledger_fates_and_rollup(spark):
    first = spark.createDataFrame([(1, None), (2, "recency_cut"), (3, None)], "review_id int, reason string")
    second = spark.createDataFrame([(1, None), (3, "same_author")], "review_id int, reason string")
    cited = spark.createDataFrame([("k", i) for i in (1, 2, 3, 4)], "key string, review_id int")
    assert {r.review_id: r.fate for r in ledger.fates(cited, first, second).collect()} == {1: "kept", 2: "identity/recency_cut", 3: "duplicate/same_author", 4: "unknown"}
    rows = ledger.review_rows(first, "identity").union(ledger.review_rows(second, "duplicate"))
    assert {(r.gate, r.reason, r.n) for r in ledger.rollup(rows).collect()} == {
        ("identity", "recency_cut", 1), ("identity", None, 1), ("duplicate", "same_author", 1), ("duplicate", None, 1), (None, None, 2)}
    assert ledger.stopped_twice(rows).isEmpty()


def test_passes_keep_the_first(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    assert {(r.k, r["pass"], r.v) for r in profile.first_of_passes([a, b], "k").collect()} == {(1, 0, "x"), (2, 0, "y"), (3, 1, "w")}


def test_api_rows_and_files(spark, tmp_path):
    full = {"reviewId": 5, "content": "c", "reviewScore": 4, "usefulPoint": 0.5, "hasPhoto": True, "goodsDto": {"goodsNumber": "A1", "optionName": " o "}, "profileDto": {"skinTrouble": ["C1"], "memberNickname": "n"}}
    df = spark.createDataFrame([(json.dumps(full), "A2"), ("{}", "A2"), ("not json", "A2")], "json string, requested_goods_no string")
    one, two, three = adapters.parse_api(df).collect()
    assert (one.reviewId, one.rating, one.usefulPoint, one.hasPhoto, one.option, one.skinTrouble, one.requestedGoodsNo) == (5, 4, 0.5, True, "o", ["C1"], "A2")
    assert (two.reviewId, two.content, two.hasPhoto, two.skinTrouble) == (None, "", False, [])
    assert (three.reviewId, three.content) == (None, "")
    path = tmp_path / "reviews.json"
    whole = dict.fromkeys(records.KNOWN_FIELDS) | {"reviewId": 1, "content": "a", "rating": 5}
    path.write_text(json.dumps([whole]))
    assert adapters.read_reviews(spark, str(path)).first().reviewId == 1
    path.write_text(json.dumps([{"reviewId": 1, "content": "a", "rating": 5}]))  # the schema is closed: a missing field stops
    with pytest.raises(ContractError):
        adapters.read_reviews(spark, str(path))
    rows = spark.createDataFrame([("duplicate", 2, "same_author", "review", "10"), ("identity", 1, "recency_cut", "review", "9")], "gate string, gate_order int, reason string, unit string, subject string")
    adapters.write_ledger(rows, str(tmp_path / "ledger"))
    assert spark.read.json(str(tmp_path / "ledger")).count() == 2
