"""Labels traced in overlapping option scopes: together as each alone, and a case worked out by hand."""

import random

import pytest
from pyspark.sql import functions as F

from veridact.operators import options, scopes
from veridact.schemas import SufficiencyPolicy

FIRST = "review_id long, product_id string, author long, content_hash string, rank long, skin_type string, troubles array<string>, reason string, detail string, limitation string, option string, kind string, shade_key string"
POLICY = SufficiencyPolicy(s_min=2, n_min=2)
EMPTY = "key long, product_id string, axis string, segment string, aspect string, want string, option string"


def world(spark, rows):
    """(first, indexed) of (id, product, author, hash, rank, skin, reason, shade); shade None: not stated, 'pack': no shade."""
    first = spark.createDataFrame([
        (i, p, a, h, r, s, [], why, None, "renewal_unobserved" if p == "q" and why is None else None, o, None if o is None else "pack" if o == "pack" else "shade", None if o in (None, "pack") else o)
        for i, p, a, h, r, s, why, o in rows], FIRST)
    indexed = first.where("option is not null").groupBy("product_id", "option").agg(F.count("*").alias("reviews"), F.first("kind").alias("kind"), F.first("shade_key").alias("shade_key"))
    return first, indexed


def told(pair):
    return sorted(((r.key, r.outcome, r.gate, r.reason, r.direction, r.direction_match, tuple(r.limitations)) for r in pair[0].collect()), key=str), sorted((tuple(r) for r in pair[1].collect()), key=str)


def test_a_review_kept_in_one_scope_falls_in_another(spark):
    rows = [
        (1, "p", 7, "a", 1, "A1", None, "red"), (2, "p", 7, "b", 2, "A1", None, "blue"), (3, "p", 8, "c", 3, "A1", None, "blue"), (4, "p", 9, "d", 4, "A1", None, None), (5, "p", 9, "e", None, "A1", "recency_cut", "blue"),
        (6, "p", 5, "f", 5, "A1", None, "pack"), (7, "q", 1, "g", 1, None, None, "red"), (8, "q", 2, "h", 2, None, None, "red")]
    first, indexed = world(spark, rows)
    tags = spark.createDataFrame([(i, "x", "positive") for i in range(1, 8)] + [(8, "x", "negative")], "review_id long, aspect string, polarity string")
    asks = [(1, "p", "skinType", "A1", "x", "positive", None), (2, "p", "skinType", "A1", "x", "negative", "blue"), (3, "p", "skinType", "A1", "x", "positive", "gold"), (4, "p", "skinType", "A1", "x", "positive", "pack"),
            (5, "p", "skinType", "A2", "x", "positive", "blue"), (6, "q", "product", "None", "x", "mixed", "red"), (7, "p", "skinType", "A1", "odd", "positive", "blue"), (8, "p", "skinType", "A1", "y", None, "red")]
    targets = spark.createDataFrame(asks, EMPTY)
    cited = spark.createDataFrame([(1, i) for i in range(1, 9)] + [(2, i) for i in range(1, 9)] + [(2, 99), (3, 1)], "key long, review_id long")
    traced, fates = scopes.trace(targets, cited, first, tags, indexed, ["x", "y"], POLICY)
    got = {r.key: (r.outcome, r.gate, r.reason, r.direction, r.direction_match, r.limitations) for r in traced.collect()}
    assert got[1] == ("produced", None, None, "positive", True, ["tagger_direction_error"])
    assert got[2] == ("produced", None, None, "positive", False, ["tagger_direction_error"])
    assert got[3] == got[4] == ("untraceable", "identity", "unknown_option", None, None, [])
    assert got[5] == ("no_candidate", "identity", "empty_cell", None, None, [])
    assert got[6] == ("produced", None, None, "mixed", True, ["minority_within_tagger_noise", "renewal_unobserved", "single_dissent", "tagger_direction_error"])
    assert got[7][:3] == ("untraceable", None, "aspect_outside_taxonomy") and got[8][:3] == ("no_candidate", "polarity", "no_tagged_mention")
    fate = {(r.key, r.review_id): r.fate for r in fates.collect()}
    assert fate[1, 2] == "duplicate/same_author" and fate[2, 2] == "kept"  # its author's better review is of another shade
    assert fate[2, 1] == "identity/option_mismatch" and fate[2, 4] == "identity/option_unstated" and fate[2, 6] == "identity/option_mismatch"
    assert fate[1, 5] == fate[2, 5] == "identity/recency_cut" and fate[2, 7] == fate[2, 99] == "identity/out_of_scope" and fate[1, 4] == "kept" and (3, 1) not in fate


@pytest.mark.parametrize("seed", [1])
def test_all_scopes_at_once_equal_each_alone(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice("pq"), rnd.randint(1, 30), f"h{rnd.randint(1, 60)}", i, rnd.choice([None, "A1"]), rnd.choice([None, None, None, "recency_cut"]), rnd.choice([None, "red", "blue"])) for i in range(1, 121)]
    first, indexed = world(spark, rows)
    tags = spark.createDataFrame([(i, rnd.choice("xy"), rnd.choice(["positive", "negative", "neutral"])) for i in range(1, 121)], "review_id long, aspect string, polarity string")
    asks = [(k, p, "skinType", "A1", "x", "mixed", o) for k, (p, o) in enumerate([("p", None), ("p", "red"), ("q", "red"), ("q", "blue")])]
    cited = [(k, i) for k in range(len(asks)) for i in rnd.sample(range(1, 125), 12)]
    run = lambda some: told(scopes.trace(
        spark.createDataFrame([a for a in asks if a[0] in some], EMPTY), spark.createDataFrame([c for c in cited if c[0] in some], "key long, review_id long"), first, tags, indexed, ["x", "y"], POLICY))
    together = run({0, 1, 2, 3})
    alone = [run({k}) for k in (1, 3)]
    for (traced, fates), k in zip(alone, (1, 3)):
        assert traced == [t for t in together[0] if t[0] == k] and fates == [f for f in together[1] if f[0] == k]


def test_no_rows(spark):
    first, indexed = world(spark, [(1, "p", 7, "a", 1, "A1", None, "red")])
    tags = spark.createDataFrame([(1, "x", "positive")], "review_id long, aspect string, polarity string")
    none = spark.createDataFrame([], EMPTY)
    traced, fates = scopes.trace(none, spark.createDataFrame([], "key long, review_id long"), first, tags, indexed, ["x"])
    assert traced.collect() == [] and fates.collect() == [] and options.resolve_scopes(none.select("product_id", "option"), indexed).collect() == []
