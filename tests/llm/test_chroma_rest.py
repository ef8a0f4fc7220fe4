import numpy as np
from pyspark.sql import functions as F

from veridact.llm import chroma as C

from .test_chroma import by_all_pairs, tune, wav


def test_buckets_that_splitting_leaves_apart_are_compared(spark, monkeypatch):
    """All buckets are large, hubs and parts join nobody: groups still equal those of all pairs."""
    monkeypatch.setattr(C, "HOT", 0)
    monkeypatch.setattr(C, "_split", lambda rows: rows.select(F.col("key").cast("long").alias("key"), "ck").limit(0))
    monkeypatch.setattr(C._Links, "by_hubs", lambda self, rows, rounds=(): rows)
    rng = np.random.default_rng(5)
    rows = []
    for g in range(4):
        x = tune(400 + g, 40)
        rows += [(g * 10 + j, wav(0.5 * x + 0.02 * j * rng.normal(size=len(x)))) for j in range(2)]
    prints = C.fingerprints(spark.createDataFrame(rows, "rec long, audio binary"), "rec", "audio")
    want = by_all_pairs(prints)
    assert sorted((r.id, r.group_id) for r in C.groups(prints).collect()) == want and len({g for _, g in want}) < len(want)


def test_only_what_lies_outside_the_largest_component_is_split(spark, monkeypatch):
    """A bucket of 40 classes, 30 of them in one component: rows are made for the other ten, and for none where they are few."""
    monkeypatch.setattr(C, "HOT", 4)
    split = []
    monkeypatch.setattr(C, "_split", lambda rows: split.append(sorted(r.ck for r in rows.collect())) or rows.select(F.col("key").cast("long").alias("key"), "ck"))
    rows = spark.createDataFrame([(k, i, 0 if i < edge else i, 40, 0) for k, edge in ((7, 30), (8, 37)) for i in range(40)], "key int, ck long, comp long, size long, major long")
    runs = rows.select("ck", "key", F.lit(1).cast("long").alias("before"), F.lit(2).cast("long").alias("after"))
    with C.Scratch(spark) as save:
        links = C._Links(spark.createDataFrame([], "ck long, low long, codes array<int>"), save)
        assert links.outside(rows, runs).count() == 10
        assert links.outside(rows.where("key = 8"), runs) is None
    assert split == [list(range(30, 40))]
