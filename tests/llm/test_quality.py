import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from veridact.llm import quality
from veridact.llm.queries import op13_quality_rules

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base(text):
    """The contract's measures, said plainly."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def failed(b):
    return b[0] < 50 or 100 * b[4] > 50 * b[0]


@pytest.mark.parametrize("seed", range(5))
def test_measures_are_the_plain_ones(seed):
    rnd = random.Random(seed)
    for _ in range(200):
        pieces = ["a", "b", "the", "é", "日本", "|", "#x", "<b>", " ", "  ", "\n", "\n\n", "\t", "\x0b", "\r", "\x85", " ", "\x1c", "end."]
        text = "".join(rnd.choice(pieces) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 120)))
        assert quality.measure(text)[:5] == base(text)
    assert quality.repeated(np.arange(10**6)) == 0 and quality.repeated(np.tile(np.arange(500_000), 2)) == 10**6


def plant(rnd, n, rates):
    """Votes of n texts, three quarters of them good; rates: (vote, share of good texts with it, share of bad)."""
    rows, truth = [], []
    for _ in range(n):
        good = rnd.random() < 0.75
        truth.append(good)
        rows.append([v if rnd.random() < (g if good else b) else 0 for v, g, b in rates])
    return np.array(rows), np.array(truth)


def test_rates_come_back_without_labels():
    rnd = random.Random(1)
    rates = [(1, 0.9, 0.2), (-1, 0.01, 0.5), (-1, 0.02, 0.6), (-1, 0.05, 0.4), (1, 0.7, 0.3), (-1, 0.3, 0.35)]
    votes, truth = plant(rnd, 20_000, rates)
    patterns = Counter(map(tuple, votes.tolist()))
    keys = np.array(sorted(patterns))
    m = quality.fit(keys, np.array([patterns[tuple(k)] for k in keys.tolist()], float))
    assert abs(m.good - 0.75) < 0.05
    for j, (v, g, b) in enumerate(rates[:4]):
        got = (m.good_of_good[j], m.good_of_bad[j]) if v > 0 else (m.bad_of_good[j], m.bad_of_bad[j])
        assert abs(got[0] - g) < 0.06 and abs(got[1] - b) < 0.12
    before, good, bad = m.odds()
    odds = before + (votes > 0) @ good + (votes < 0) @ bad
    assert ((odds > 0) == truth).mean() > 0.9
    assert abs(bad[1]) > abs(bad[5])  # a rule that is right more often weighs more


def test_no_rows_keep_the_priors():
    m = quality.fit(np.zeros((0, 3), np.int64), np.zeros(0))
    assert m.good == pytest.approx(0.8) and m.bad_of_bad == pytest.approx((0.25,) * 3) and m.bad_of_good == pytest.approx((0.02,) * 3)


def test_unusual_rows(spark):
    words = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \n\t", "x", words, words, words.replace("w", "long") * 200, "spam spam spam " * 40, "### " * 60, "| a " * 60]
    docs = spark.createDataFrame([(None if i == 3 else i % 8, t, "k", 2.0) for i, t in enumerate(texts)], "doc_id long, text string, kept string, quality double").repartition(3)
    got = quality.judge(docs)
    assert got.columns == ["doc_id", *quality.MEASURES, "base_failed", "quality", "kept"]
    rows = got.collect()
    want = sorted((i % 8 if i != 3 else -1, *base(t), failed(base(t))) for i, t in enumerate(texts))
    assert sorted((-1 if r.doc_id is None else r.doc_id, *[r[c] for c in BASE], r.base_failed) for r in rows) == want
    assert all(not (r.base_failed and r.kept) and 0 <= r.quality <= 1 for r in rows)
    assert quality.judge(spark.createDataFrame([], docs.schema)).collect() == []


def test_posterior_is_the_models(spark):
    d = "/root/testdata/sf0.001"
    measured = quality.measures(spark.read.parquet(f"{d}/documents.parquet"))
    m = quality.train(measured)
    before, good, bad = m.odds()
    rows = measured.select(quality.probability(m).alias("p"), *[r.vote().alias(r.name) for r in quality.RULES]).collect()
    for r in rows:
        x = before + sum(g if v > 0 else b if v < 0 else 0 for v, g, b in zip(r[1:], good, bad))
        assert r.p == pytest.approx(1 / (1 + math.exp(-x)))
    told = quality.accuracies(measured, m).collect()
    assert [t.rule for t in told] == [r.name for r in quality.RULES]
    assert all(t.right is None or 0 <= t.right <= 1 for t in told)


def test_verdicts_agree_with_labels_it_never_saw(spark):
    d = "/root/testdata/sf0.01"
    got = op13_quality_rules(spark, d)
    assert got.columns == ["doc_id", *BASE, "base_failed", "kept", "quality"]
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = got.collect()
    assert sorted((r.doc_id, *[r[c] for c in BASE], r.base_failed) for r in rows) == sorted((i, *base(t), failed(base(t))) for i, t in docs.items())
    judged = [(r.kept, r.label) for r in got.join(labels, "doc_id").collect() if not r.base_failed]
    clean = [k for k, y in judged if y == 1]
    junk = [k for k, y in judged if y == 0]
    assert len(clean) > 200 and sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.1 * len(junk)
