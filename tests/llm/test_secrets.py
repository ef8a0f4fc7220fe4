import random
import re

import numpy as np
import pytest

from tests.llm.brute import digest_row
from veridact.llm import secrets
from veridact.llm.queries import op1_secret_scan


def brute_base(text):
    key = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password") + "|" + "|".join(
        "".join(f"[{c.upper()}{c}]" for c in w) for w in ("passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    rules = [
        ("assign", rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    ]
    found = [(m.start(), o, k, m.end()) for o, (k, rule, fits) in enumerate(rules) for m in re.finditer(rule, text) if fits(m)]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def test_base_matches_the_patterns():
    rnd = random.Random(1)
    pieces = ["password", "ToKen", "api_key", "APIKEY", "secret", '"', "'", " ", "=", ":", "AKIA", "AKIAZZ99", "0123456789abcdef", "deadbeef", "é", "ſecret", "toKen", "/x+_", "abcdefgh", "\n", "g", "A1B2C3D4E5"]
    for _ in range(5000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 9)))
        assert secrets.base_spans(text) == brute_base(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 500_000, "token " * 80_000, "token=" + " " * 300_000, "0" * 500_000, "a-" * 200_000, "AKIA" * 100_000):
        secrets.base_spans(text)
        secrets.candidates(text)


def test_network_gradient_free_pieces():
    x = secrets.encode(np.stack([secrets.window("abc 123456789 é", 4, 13)]))
    assert x.shape == (1, secrets.WIDTH, secrets.CHANNELS) and (x[..., :-1].sum(2) == 1).all()
    long = "x" * 10 + "1" * 500
    assert (secrets.window(long, 0, 510) >= 0).sum() == secrets.HEAD + secrets.TAIL


HELD_OUT = "pmod(crc32(cast(doc_id as string)), 2) = 0"


@pytest.fixture(scope="module")
def model(spark):
    return secrets.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(f"not ({HELD_OUT})"))


def test_held_out_findings(model, spark):
    """Findings of texts that weren't sampled, with their key names cut away."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(HELD_OUT).where("rlike(text, '[0-9]{2}')").collect()
    found = secrets.labelled([r.text for r in rows], seed=99)
    p = model.scores(np.stack([secrets.window(*f[:3]) for f in found]))
    hit = np.array([q >= model.thresholds[secrets.look(t[s:e])] for (t, s, e, _), q in zip(found, p)])
    y = np.array([f[3] for f in found]) == 1
    assert y.sum() > 100 and hit[y].mean() > 0.95 and hit[~y].mean() < 0.01
    # calibrated: the scores' mean is near the rate
    assert abs(p.mean() - y.mean()) < 0.1


def test_network_adds_keys_without_a_pattern(model):
    def added(text):
        return [text[s:e] for s, e in secrets.candidates(text) if model.scores(np.stack([secrets.window(text, s, e)]))[0] >= model.thresholds[secrets.look(text[s:e])]]

    assert added("use ghp_16C7e42F292c6912E7710c838347Ae178B4a here") == ["ghp_16C7e42F292c6912E7710c838347Ae178B4a"]
    assert added("see 2020-10-12-report.html or 4041894974608795 at bosbt.42@mail8.example.com") == []


def test_keys_of_letters_alone(spark, model):
    docs = spark.createDataFrame([(1, "use rZkQwPvXmTgBnHyLcDsJfKtW here"), (2, "a wellKnownThing and internationalisations of tionthereandingtion")], "doc_id long, text string")
    got = {r.doc_id: [(x.start, x.end) for x in r.spans] for r in secrets.find(docs, model, keep=("doc_id",)).collect()}
    assert got == {1: [(4, 28)], 2: []}


def test_long_candidates_are_read_whole(spark, model):
    """Keys in the middle of a long path or url tail, which is one candidate."""
    keys = ["16C7e42F292c6912E7710c838347Ae178B4aQw3x", "9fK2mZ7qLx8VbT4sYw6NcR1pHd5J", "Zx81kQm2LrT94vBn7Wc3YpE6sHd0"]
    around = [("//cdn.host/api/v1/", "/more/of/the/long/list.json"), ("a/path/that/is/quite/long/and/plain/", "/another/one/behind/it/index.html")]
    docs = [(i, f"see {a}{k}{b} here", a, b) for i, (k, (a, b)) in enumerate((k, x) for k in keys for x in around)]
    plain = [(100 + i, f"see {a}list2/page{b} here", a, b) for i, (a, b) in enumerate(around)]
    df = spark.createDataFrame(docs + plain, "doc_id long, text string, a string, b string")
    got = {r.doc_id: [(x.start, x.end) for x in r.spans] for r in secrets.find(df, model, keep=("doc_id",)).collect()}
    assert got == {d: secrets.candidates(t) if d < 100 else [] for d, t, _, _ in docs + plain}
    text = "x1" + "y" * 300
    assert (np.stack([w for _, w in secrets.windows(text, 0, 302)])[:, secrets.LEFT : secrets.LEFT + 40] >= 0).all()


def test_unusual_rows(spark, model):
    key = "password=b7db7aa4a5fcc78305"
    docs = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, key, "s"), (4, "w " * 50_000 + key, "s"), (5, key, "s"), (5, key, "s")], "doc_id long, text string, spans string")
    got = secrets.find(docs, model, keep=("doc_id",)).collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got}
    assert by[1].base == by[2].base == [] and [(x.kind, x.start) for x in by[4].base] == [("assign", 100_000)]
    empty = spark.createDataFrame([], docs.schema)
    assert secrets.find(empty, secrets.train(empty)).collect() == []


def test_query_on_the_small_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in op1_secret_scan(spark, "/root/testdata/sf0.001").collect():
        base = brute_base(docs[r.doc_id] or "")
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == digest_row(base, secrets.KINDS)
        assert set(f"{k}:{s}:{e}" for k, s, e in base) <= set(r.spans.split(",")) | {""}
