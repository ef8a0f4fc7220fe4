import itertools
import zlib

import numpy as np
import pytest

from veridact.llm import toxicity as T
from veridact.llm.queries import op6_toxicity

MODEL = T.Model({"=bad": 2.0, "evil": 1.5, "=mild": 0.7}, -2.0, np.array([[0.5, -1.0], [-0.3, 0.4]]), np.array([-2.0, 2.0, 1.0, 0.1]))


def brute_marginals(words):
    """Sums over all paths of states."""
    potentials = [T.Potentials(MODEL)[w] for w in words]
    potentials = [MODEL.bias if e is None else e for e in potentials]
    total, on = 0.0, np.zeros(len(words))
    for path in itertools.product((0, 1), repeat=len(words)):
        z, last = 0.0, 0
        for s, e in zip(path, potentials):
            z += MODEL.trans[last, s] + s * e
            last = s
        total += np.exp(z)
        on += np.exp(z) * np.array(path)
    return on / total


@pytest.mark.parametrize("text", ["bad", "so bad evildoer x", "a b c d bad e f mild g evils", "x y bad bad z", "mild a b c d e f"])
def test_marginals_match_all_paths(text):
    n, at, p = T.Tagger(MODEL).marginals(text)
    want = brute_marginals(T.TOKEN.findall(text))
    assert n == len(want)
    assert np.allclose(p, want[at])


def test_offsets_are_code_points_of_offending_words():
    score, spans = T.Tagger(T.Model({"=bad": 9.0}, -3.0, np.zeros((2, 2)), MODEL.doc)).score("é İx bad. Bad")
    assert [(s, e) for s, e, _ in spans] == [(5, 8), (10, 13)]
    assert 0 <= score <= 1


def test_unusual_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "so bad", "x"), (3, "w " * 50_000 + "bad", "x"), (3, "w", "x"), (3, "w", "x")], "doc_id long, text string, score string")
    got = T.score(docs, MODEL, keep=("doc_id",)).collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got if r.doc_id in (1, 2)}
    assert by[1].score == by[2].score
    assert all(0 <= r.score <= 1 for r in got)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert T.score(empty, MODEL, keep=("doc_id",)).collect() == []
    model = T.train(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert 0 <= T.Tagger(model).score("anything")[0] < 0.5


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in op6_toxicity(spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [(got[d].predicted, y) for d, y in labels.items() if got[d].held_out]
    assert len(held) > 500
    assert sum(a == b for a, b in held) / len(held) > 0.98
    toxic = [a for a, y in held if y == 1]
    assert sum(toxic) / len(toxic) > 0.9
