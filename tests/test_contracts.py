"""Contracts, records, drafts and the registry beyond what the queries show."""

import pytest
from pyspark.sql import functions as F

from veridact.operators import catalog, drafts, gates, ledger, quotes, records, registry, trust, vectors
from veridact.schemas import ASPECTS, ContractError, QuotePolicy, TrustPolicy


def test_policies_that_switch_a_gate_off_are_refused():
    for bad in ({"min_evidence": 0}, {"min_evidence": True}, {"max_substitutions": -1}):
        with pytest.raises(ContractError):
            QuotePolicy(**bad)
    for bad in ({"version": " "}, {"types": ()}, {"types": (("a", "high", 1), ("a", "low", 2))}, {"types": (("a", "worst", 1),)}):
        with pytest.raises(ContractError):
            registry.Taxonomy(**bad)


def test_embedding_release(spark):
    good = dict(embedding_version="e1", model="m", dimension=2, max_length=8, vocabulary_version="v", golden_version="g", vocabulary_sha256=vectors.vocabulary_digest(ASPECTS), releases=(("e1", "v", "g"),))
    spec = vectors.EmbeddingSpec(**good)
    for bad in ({"dimension": 0}, {"vocabulary_sha256": "x"}, {"releases": (("e1", "v", "other"),)}, {"releases": (("e1", "v", "g"), ("e1", "w", "g"))}, {"model": ""}):
        with pytest.raises(ContractError):
            vectors.EmbeddingSpec(**good | bad)
    rows = spark.createDataFrame([(1, [1.0, 2.0], None), (2, [1.0, 2.0], "m")], "vec_id int, embedding array<float>, model string")
    assert [(r.model, r.embedding_version) for r in vectors.stamp(rows, spec).collect()] == [("m", "e1")] * 2
    with pytest.raises(Exception, match="overwritten"):
        vectors.stamp(rows.withColumn("model", F.lit("other")), spec).collect()


def test_records_of_odd_rows(spark):
    rows = [(1, " text ", 5, "2024.01.02", "A", None, "  ", ["C02", " C01", "", "C01"], "p1"), (2, "", None, None, None, None, "A01", None, "p1")]
    df = spark.createDataFrame(rows, "reviewId long, content string, rating int, reviewDate string, userName string, option string, skinType string, skinTrouble array<string>, product_id string")
    one, two = records.build(df).orderBy("review_id").collect()
    assert one.condition.skinType.asDict() == {"code": None, "stated": False, "segment": "미기재"} and one.condition.skinTrouble.asDict() == {"codes": ["C01", "C02"], "stated": True, "segments": ["C01", "C02"]}
    assert one.derived.contentLength == 4 and one.derived.reviewYearMonth == "2024-01" and one.raw.content == " text "
    assert two.condition.skinTrouble.asDict() == {"codes": [], "stated": False, "segments": ["미기재"]} and two.condition.skinType.code == "A01"
    assert records.build(df.where("false")).collect() == []


def test_written_records_and_profile(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "id int, t string")
    records.write(rows, str(tmp_path / "r"), rows, None)
    assert not (tmp_path / "p").exists() and spark.read.json(str(tmp_path / "r")).count() == 1
    records.write(rows, str(tmp_path / "r"), rows, str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).count() == 1


def test_missing_input_and_unknown_fields_stop(spark, tmp_path):
    from veridact.sources import adapters

    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        adapters.read_reviews(spark, str(tmp_path / "none.json"))
    good = "{" + ", ".join(f'"{n}": {"[]" if n in ("skinTrouble", "reviewImages") else "null"}' for n in records.KNOWN_FIELDS) + "}"
    (tmp_path / "good.json").write_text(f"[{good}]")
    assert adapters.read_reviews(spark, str(tmp_path / "good.json")).count() == 1
    (tmp_path / "bad.json").write_text('[{"reviewId": 1, "shade": 2}]')
    with pytest.raises(ContractError, match="shade"):
        adapters.read_reviews(spark, str(tmp_path / "bad.json"))


def test_targets_by_product_and_limit(spark):
    passed = spark.createDataFrame([(f"c{i}", f"p{i % 3}") for i in range(9)], "claim_id string, product_id string")
    assert [r.claim_id for r in drafts.chosen(passed, ["p1", "p2"], 3).collect()] == ["c1", "c2", "c4"]
    with pytest.raises(ContractError, match="p9"):
        drafts.chosen(passed, ["p1", "p9"])


def test_product_lists_and_runs(spark):
    with pytest.raises(ContractError):
        catalog.product_list(spark.createDataFrame([], "goods_no string"))
    with pytest.raises(ContractError):
        catalog.product_list(spark.createDataFrame([("A1",), (" ",)], "goods_no string"))
    runs = spark.createDataFrame([("a", True, False, "x"), ("b", True, True, "x"), ("c", False, False, "x"), ("d", True, False, "y"), ("e", True, False, "y")], "run_id string, complete boolean, pilot boolean, input_sha256 string")
    assert [r.run_id for r in catalog.canonical_run(runs, "x").collect()] == ["a"]
    for digest in ("y", "z"):
        with pytest.raises(ContractError):
            catalog.canonical_run(runs, digest)


def test_trust_of_unknown_signals(spark):
    rows = spark.createDataFrame([(1, "p", "some text", 3, True)], "review_id int, product_id string, content string, likes long, has_photo boolean")
    got = trust.signals(rows, TrustPolicy(content_length=0.0, unique_content=0.0, on_topic=0.0, has_photo=1.0)).first()
    assert got.trust_score == 1.0 and got.unavailable == ["onTopic", "usagePeriod"]
    with pytest.raises(ContractError):
        trust.signals(rows, TrustPolicy(content_length=0.0, unique_content=0.0, on_topic=0.0, usage_period=1.0))


def test_traces_of_scopes_that_cannot_be_read(spark):
    cell = "product_id string, axis string, segment string"
    targets = spark.createDataFrame([(1, "p", "product", "None", "a", "positive", None), (2, "p", "product", "None", "a", "positive", "pack_option")], f"key int, {cell}, aspect string, want string, scope_violation string")
    judged = spark.createDataFrame([("p", "product", "None", "a", None, "positive")], f"{cell}, aspect string, reason string, direction string")
    sizes = spark.createDataFrame([("p", "product", "None", 9)], f"{cell}, cell_authors long")
    traced = ledger.trace(targets, judged, sizes, ["a"])
    assert sorted((r.key, r.outcome, r.gate, r.reason) for r in traced.collect()) == [(1, "produced", None, None), (2, "untraceable", "identity", "unknown_option")]
    assert ledger.recall(traced).first().recall == 1.0


def test_quotes_found_elsewhere(spark):
    """Long and short quotes, copies of quotes and texts, the cited review itself, and blanks."""
    long = "the quick brown fox jumps over the lazy dog and runs away"
    reviews = spark.createDataFrame([(1, "aaa " + long + " zzz"), (2, "bbb " + long), (3, "tiny words"), (4, "aaa " + long + " zzz"), (5, None)], "review_id long, content string")
    asked = [(10, 3, long), (11, 3, long), (12, 1, "tiny"), (13, 2, "aaa " + long), (14, 1, "not there at all, and long enough to be looked up"), (15, 1, " \n"), (16, 1, None), (17, 9, long), (18, 5, long)]
    got = {r.quote_id: (r.status, r.matched_review_id) for r in quotes.classify(spark.createDataFrame(asked, "quote_id long, review_id long, quote string"), reviews).collect()}
    assert got == {10: ("misattributed", 1), 11: ("misattributed", 1), 12: ("misattributed", 3), 13: ("misattributed", 1), 14: ("fabricated", None), 15: ("blank_quote", None), 16: ("blank_quote", None), 17: ("unknown_review", None), 18: ("unknown_review", None)}


def test_minimizers_of_a_part_are_among_the_whole_s():
    import random

    rnd = random.Random(4)
    for _ in range(200):
        text = "".join(rnd.choice("ab c漢🙂") for _ in range(200))
        n = rnd.randint(quotes.GRAM + quotes.WINDOW - 1, 120)
        at = rnd.randrange(len(text) - n)
        assert 0 < len(quotes.minimizers(text[at : at + n])) and set(quotes.minimizers(text[at : at + n]).tolist()) <= set(quotes.minimizers(text).tolist())


def test_gates_without_rows(spark):
    said = spark.createDataFrame([], "product_id string, axis string, segment string, aspect string, author long, polarity string")
    assert gates.stance_overlaps(said).collect() == [] and gates.authors_outside(said, said).collect() == []
