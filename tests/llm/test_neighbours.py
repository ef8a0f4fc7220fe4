import numpy as np
from pyspark.sql import functions as F

from veridact.llm import neighbours as N
from veridact.llm.queries import op4_nearest_neighbours


def brute(rows, asks, k=5):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = {}
    for q, x in good:
        if asks(q):
            near = sorted((-N.cosine(np.array(x, float), np.array(y, float)), i) for i, y in good if i != q and len(x) == len(y))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_unusual_rows_match_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    rows += [(50, None), (100, [0.0] * 4), (150, [1.0, None, 0.0, 0.0]), (200, [float("nan"), 1.0, 1.0, 1.0]), (250, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (300, []), (400, [1.0, 2.0]), (401, [2.0, 1.0])]
    rows += [(500 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(20)] + [(600, [2.0, 4.0, 6.0, 8.0]), (600, [2.0, 4.0, 6.0, 8.0]), (650, [1e-200, 0.0, 0.0, 0.0]), (700, [1e200, 1e200, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], "vec_id long, embedding array<double>, score double, rank int")
    want = brute(rows, lambda q: q % 50 == 0)
    for segment, block in ((10_000, 10_000), (16, 4)):
        got = found(N.nearest(df, F.col("vec_id") % 50 == 0, segment=segment, block=block))
        assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items() if v}
        assert all(abs(a - b) < 1e-12 for q in got for (_, a), (_, b) in zip(got[q], want[q]))


def test_empty_table(spark):
    assert N.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") == 0).collect() == []


def test_structured_vectors_stop_below_the_roots():
    """Tight clusters are answered from deep prefixes, with their true neighbours."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(400, 32))
    rows = np.repeat(centres, 20, 0) + 0.03 * rng.normal(size=(8000, 32))
    forest = N.Forest(rows)
    got = forest.search(rows[:200], 6)
    looked = forest.looked
    want = np.argsort(-(N.unit(rows[:200]) @ forest.vectors.T), 1)[:, :6]
    hits = np.mean([len(set(w) & set(g.tolist())) / 6 for w, (g, _) in zip(want, got)])
    assert hits > 0.9 and np.mean(looked) < 800


def test_vectors_without_structure_go_through_the_forest():
    """On the given vectors: recall of 0.9 from part of the rows, and no query that ends at the roots."""
    import duckdb

    rows = np.array([v for (v,) in duckdb.execute("SELECT embedding FROM '/root/testdata/sf0.1/embeddings.parquet' ORDER BY vec_id").fetchall()], float)
    forest = N.Forest(rows)
    asked = N.unit(rows[::50])
    got = forest.search(asked, 6)
    want = np.argsort(-(asked @ forest.vectors.T), 1)[:, :6]
    hits = np.mean([len(set(w.tolist()) & set(g.tolist())) / 6 for w, (g, _) in zip(want, got)])
    print(forest.target, hits, np.mean(forest.looked) / len(rows), max(forest.looked) / len(rows))
    assert hits >= 0.9 and np.mean(forest.looked) < 0.6 * len(rows) and max(forest.looked) < len(rows)


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = found(op4_nearest_neighbours(spark, sf))
    ids = np.array([i for i, _ in rows])
    u = N.unit(np.array([v for _, v in rows]))
    hits = []
    for q, v in got.items():
        s = u @ u[ids == q][0]
        near = [i for i in ids[np.lexsort((ids, -s))] if i != q][:5]
        hits.append(len(set(near) & {i for i, _ in v}) / 5)
        assert len(v) == 5
    assert len(got) == sum(i % 50 == 0 for i in ids) and np.mean(hits) >= 0.9
