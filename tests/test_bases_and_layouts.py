"""Field-level parity, layouts as stages, and a model's swap."""

import pytest
from pyspark.sql import functions as F

from veridact.operators import contracts, layout, vectors
from veridact.plans.contract_queries import swap_specs
from veridact.schemas import ContractError

SCHEMA = "id long, raw struct<a: int, in: struct<`b.c`: string, d: array<int>>>, e double"


def test_differences_are_named_field_by_field(spark):
    left = [(1, (1, ("x", [1])), 0.5), (2, (2, ("y", None)), None), (3, (3, ("z", [])), 1.0), (4, None, 1.0), (5, (1, ("q", [1])), 1.0), (5, (1, ("q", [1])), 1.0), (None, (9, ("n", [1])), 1.0), (7, (1, ("x", [1, 2])), 1.0)]
    right = [(1, (1, ("x", [1])), 0.5), (2, (2, ("y", [])), None), (8, (3, ("z", [])), 1.0), (4, (None, (None, None)), 1.0), (5, (1, ("q", [1])), 1.0), (None, (8, ("n", [1])), 1.0), (7, (1, ("x", [2, 1])), None)]
    schema = SCHEMA.replace("`b.c`", "b")
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    for buckets in (1, 64):
        got = {(r.id, r.field, r.kind): (r.left_value, r.right_value) for r in contracts.field_differences(a, b, "id", buckets).collect()}
        assert got == {
            (2, "raw.in.d", "differs"): (None, "[]"), (3, None, "only_left"): (None, None), (8, None, "only_right"): (None, None), (5, None, "repeated_key"): (None, None),
            (None, "raw.a", "differs"): ("9", "8"), (7, "raw.in.d", "differs"): ("[1,2]", "[2,1]"), (7, "e", "differs"): ("1.0", None)}
    assert contracts.field_differences(a, a.orderBy(F.desc("e")), "id").collect() == []
    wider = contracts.field_differences(a, a.withColumn("more", F.lit(1)), "id").collect()
    assert [(r.id, r.field, r.kind) for r in wider] == [(None, "more", "only_right")]
    assert contracts.field_differences(a.where("false"), b.where("false"), "id").collect() == []
    assert {r.kind for r in contracts.field_differences(a.where("id = 1"), b.where("false"), "id").collect()} == {"only_left"}


def test_equal_bases_move_digests_alone(spark):
    a = spark.range(2000).withColumn("v", F.col("id") * 3)
    shuffled = a.repartition(7).orderBy(F.rand(1))
    fields = [("v", "`v`")]
    x, y = (sorted(map(tuple, contracts.bucket_digests(r, "id", fields, 50).collect())) for r in (a, shuffled))
    assert x == y and len(x) == 50
    other = sorted(map(tuple, contracts.bucket_digests(a.withColumn("v", F.when(F.col("id") == 5, 0).otherwise(F.col("v"))), "id", fields, 50).collect()))
    assert sum(p != q for p, q in zip(x, other)) == 1


def test_layout_has_its_stages_and_what_it_omits(spark):
    claims = spark.createDataFrame([("p", "skinType", "A1", "x", "dry", 9, 1, 0, 10, 12, 2, 10, "mixed", None), ("p", "skinType", "A1", "y", "dry", 0, 0, 0, 0, 12, 12, 0, "neutral", "segment_too_small")],
        "product_id string, axis string, segment string, aspect string, subject string, pos int, neg int, neu int, spoke int, cell_authors int, silent int, support int, direction string, reason string")
    cell = ["product_id", "axis", "segment"]
    quotes = spark.createDataFrame([("p", "skinType", "A1", "x", i, "positive", i) for i in range(1, 10)] + [("p", "skinType", "A1", "x", 10, "negative", 1)], "product_id string, axis string, segment string, aspect string, quote_rank long, polarity string, polarity_rank long")
    shown = layout.truncate(quotes.withColumn("review_id", F.col("quote_rank") * 7), cell)
    said = quotes.select(*cell, "aspect", F.concat(F.lit("2024-"), F.lpad(F.col("quote_rank").cast("string"), 2, "0")).alias("month"))
    found = layout.totals(said, cell)
    r = layout.arranged(claims, shown, found, cell).collect()
    assert len(r) == 1 and [r[0][f"{s}_stage"].stage for s in ("subject", "condition", "evidence", "direction", "sufficiency")] == [1, 2, 3, 4, 5]
    e = r[0].evidence_stage
    assert (e.total, e.shown, e.omitted, e.first_month, e.last_month, e.reserved) == (10, 8, 2, "2024-01", "2024-10", [70])
    assert [q.quote_rank for q in e.quotes] == [1, 2, 3, 4, 5, 6, 7, 10] and r[0].sufficiency_stage.passed
    support = claims.select(*cell, "aspect", "pos", (F.col("neg") + 1).alias("neg"), "neu", "silent")
    bad = {(v.aspect, v.violation) for v in layout.arrangement_violations(claims, support, found, cell).collect()}
    assert bad == {("x", "neg_differs"), ("y", "neg_differs"), ("y", "no_evidence")}
    fewer = layout.totals(said.where("month > '2024-01'"), cell)
    assert ("x", "quotes_are_not_spoke") in {(v.aspect, v.violation) for v in layout.arrangement_violations(claims, support, fewer, cell).collect()}


def test_a_swap_is_whole_or_open(spark):
    old, new = swap_specs()
    ok = [0.0] * 64
    rows = [(1, new.model, new.embedding_version, ok), (2, old.model, old.embedding_version, ok), (3, None, None, ok), (4, "x", "y", ok), (5, new.model, new.embedding_version, None), (6, new.model, new.embedding_version, [1.0]), (7, new.model, old.embedding_version, ok)]
    v = spark.createDataFrame(rows, "vec_id int, model string, embedding_version string, embedding array<double>")
    states = vectors.backfill(v, old, new)
    assert {r.vec_id: r.state for r in states.collect()} == {1: "done", 2: "old_release", 3: "no_stamp", 4: "other_release", 5: "broken", 6: "broken", 7: "other_release"}
    row = vectors.swap_barrier(states, vocabulary=True, golden=True).first()
    assert (row.vectors, row.remaining, row.pending, row.complete) == (7, 6, ["vectors"], False)
    done = vectors.swap_barrier(vectors.backfill(v.where("vec_id = 1"), old, new), True, True).first()
    assert done.complete and done.pending == [] and vectors.swap_barrier(states.where("false")).first().pending == ["vocabulary", "golden"]
    half = vectors.EmbeddingSpec("emb-v3", "m", 64, 512, old.vocabulary_version, "g", old.vocabulary_sha256, (("emb-v3", old.vocabulary_version, "g"),))
    for a, b in ((old, old), (old, half)):
        with pytest.raises(ContractError):
            vectors.backfill(v, a, b)
    meta = spark.createDataFrame([(1, new.model, new.embedding_version, new.vocabulary_version), (2, None, new.embedding_version, new.vocabulary_version), (3, new.model, new.embedding_version, old.vocabulary_version)], "id int, model string, embedding_version string, vocabulary_version string")
    assert {(r.id, r.violation) for r in vectors.meta_violations(meta, new).collect()} == {(2, "no_model"), (3, "other_pair")}
