"""The pipeline's stages, each on what its predecessor kept, against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from tests.llm.test_substrings import brute as brute_substrings
from veridact.llm import packing, pii, simhash, toxicity
from veridact.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, input rows, output rows) of each stage over all documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in C.STAGES:
        before = docs.collect()
        docs = C.materialize(stage(spark, docs, SF))
        out[name] = (before, docs.collect(), docs.columns)
    return out


def test_order_and_columns(stages, spark):
    assert [n for n, _ in C.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "pii", "best_fit_packing"]
    own = spark.read.parquet(f"{SF}/documents.parquet").columns
    for name in list(stages)[:-1]:
        assert stages[name][2] == own


def test_toxic_documents_go_and_only_they(stages, spark):
    before, after, _ = stages["toxicity"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tagger = toxicity.Tagger(toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if tagger.score(r.text)[0] < 0.5)


def test_one_of_each_group_stays(stages):
    before, after, _ = stages["simhash_near_dedup"]
    rows = sorted(before, key=lambda r: r.doc_id)
    sets = [np.unique(simhash.shingle_hashes(r.text, 5)) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if len(sets[i]) and both / max(1, len(sets[i]) + len(sets[j]) - both) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert sorted(r.doc_id for r in after) == [rows[i].doc_id for i in range(len(rows)) if find(i) == i]


def test_repeated_spans_go(stages):
    before, after, _ = stages["substring_dedup"]
    want = brute_substrings(sorted((r.doc_id, r.text) for r in before))
    assert sorted((r.doc_id, r.text) for r in after) == [(i, t) for i, t, _ in want]
    old = {r.doc_id: r for r in before}
    assert all(r.n_chars == (old[r.doc_id].n_chars if r.text == old[r.doc_id].text else len(r.text)) for r in after)


def test_personal_data_goes(stages):
    before, after, _ = stages["pii"]
    new = {r.doc_id: r.text for r in after}
    assert len(new) == len(before)
    for r in before:
        spans = pii.base_spans(r.text or "")
        if not spans and not pii._CUE.search(r.text or ""):
            assert new[r.doc_id] == r.text
        for _, s, e in spans:
            assert new[r.doc_id].count(r.text[s:e]) < r.text.count(r.text[s:e])


def test_every_token_is_packed_once(stages):
    before, after, columns = stages["best_fit_packing"]
    library = Tokenizer.from_file(tokenizer_path())
    tokens = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in before}
    assert {d: sum(r.n_tokens for r in after if r.doc_id == d) for d in tokens} == tokens
    bins = {}
    for r in after:
        if r.bin is not None:
            bins.setdefault((r.bin, r.capacity), []).append((r.start, r.start + r.n_tokens))
    for (_, capacity), parts in bins.items():
        parts.sort()
        assert parts[0][0] == 0 and parts[-1][1] <= capacity and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        assert capacity == min(c for c in packing.CAPACITIES if c >= parts[-1][1])


def test_unusual_rows_pass_through(spark):
    """Null ids and texts, repeated rows, extra columns with clashing names, and an empty table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, "en", "s", None), (None, "clean words only here", None, None, 1), (7, "", "en", "s", 0), (7, "", "en", "s", 0)], docs.schema)
    rows = odd.select("*", F.lit(1).alias("row"), F.lit("x").alias("score"), F.lit(2).alias("bin"))
    for table, n in ((rows, 4), (rows.where("false"), 0)):
        for name, stage in C.STAGES[:-1]:
            table = C.materialize(stage(spark, table, SF))
            assert table.columns == rows.columns and table.count() == n, name
        assert C.STAGES[-1][1](spark, table, SF).count() == n
