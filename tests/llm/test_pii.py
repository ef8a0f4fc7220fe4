import random
import re

import numpy as np
import pytest

from tests.llm.brute import digest_row
from veridact.llm import pii
from veridact.llm.queries import op7_pii

RULES = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and brute_luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def brute_luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_base(text):
    found = []
    for order, (kind, (rule, fits)) in enumerate(RULES.items()):
        found += [(m.start(), order, kind, m.end()) for m in re.finditer(rule, text) if fits(m.group())]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def test_base_matches_the_patterns():
    rnd = random.Random(1)
    pieces = ["a@b.c", "@", "x.y@", "1.2.3.4", "255.", "256", "0.0.0.0", "+1 (988) 555-2485", "4111 1111 1111 1111", "-", " ", ".", "é", "+", "(", "79927398713", "\n", "00", "b-c.d"]
    for _ in range(4000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 9)))
        assert pii.base_spans(text) == brute_base(text), text


def test_long_runs_take_linear_time():
    for text in ("9" * 300_000, "a" * 300_000 + "@", "@" * 300_000, "+1 " * 100_000, "1." * 100_000):
        pii.base_spans(text)


def test_dynamic_program_matches_all_segmentations():
    rnd = np.random.default_rng(3)
    n = 6
    cands = [(i, j) for i in range(n) for j in range(i + 1, min(n, i + 3) + 1)]
    scores = rnd.normal(size=(len(cands), 4))

    def all_from(i):
        if i == n:
            yield []
            return
        yield from all_from(i + 1)
        for k, (a, b) in enumerate(cands):
            if a == i:
                for kind in range(4):
                    for rest in all_from(b):
                        yield [(k, kind), *rest]

    total, share, top = 0.0, np.zeros_like(scores), (-1.0, [])
    for seg in all_from(0):
        z = sum(scores[k, y] for k, y in seg)
        total += np.exp(z)
        for k, y in seg:
            share[k, y] += np.exp(z)
        top = max(top, (z, seg))
    assert np.allclose(pii.marginals(n, cands, scores), share / total)
    assert pii.best(n, cands, scores) == top[1]


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_field_finds_what_a_greedy_pattern_loses(model):
    text = "reach me on +1 (608) 555-2280 37.92.178.12 or so"
    base = pii.base_spans(text)
    assert ("phone", 12, 29) not in base
    assert ("phone", 12, 29) in pii.added_spans(model, text, base)


def test_long_chunks_are_regions_too(model):
    """Much text before the first digit or @ sign, as in urls, markup or text without spaces, hides no entity."""
    tails = ["37[.]92[.]178[.]12 or", "37.92.178.12:8080 or", "4111.1111.1111.1111 or", "+1 (608) 555-2280 or"]
    hidden = 0
    for tail in tails:
        for near, far in (("/q?", "/path" * 60 + "/q?"), ("<p>", "<div>" * 500 + "<p>"), ("文", "文" * 300)):
            a, b = "see " + near + tail, "see " + far + tail
            more = len(far) - len(near)
            want = [(k, s + more, e + more) for k, s, e in pii.added_spans(model, a, [])]
            assert pii.added_spans(model, b, []) == want, b
            hidden += len(want)
    assert hidden >= 5
    for text in ("x" * 500 + "@example", "y/" * 500 + "x" * 70 + "123456"):
        ((start, atoms),) = pii.regions(text)
        assert atoms[0][0] == start and atoms[-1][1] == len(text) and text[start - 1 : start] in ("", "/")
        assert "".join(text[s:e] for s, e in atoms) == text[start:]


def test_regions_of_short_chunks_are_as_they_were():
    rule = re.compile(r"(?<![^\s])[^\s0-9@]{0,64}[0-9@][^\s]*(?:\x20[^\s0-9@]{0,8}[0-9@][^\s]*)*")
    rnd = random.Random(4)
    for _ in range(2000):
        text = "".join(rnd.choice(["word", " ", "1234", "@", "\n", "56-78", ".", "longer-words-here", "é"]) for _ in range(rnd.randint(1, 12)))
        want = [m.span() for m in rule.finditer(text) if "@" in m[0] or len(pii.only_digits(m[0])) >= 6 if len(re.match("[^0-9@]*", m[0])[0]) <= 64]
        if max(map(len, re.split("[\\s0-9@]", text))) <= 64:
            assert [(s, a[-1][1]) for s, a in pii.regions(text)] == want, text


def test_short_addresses_and_numbers_behind_unspaced_text_are_regions():
    """Every address has four numbers, however short; what stands before a number shortens no region."""
    def shown(text):
        return [text[atoms[0][0] : atoms[-1][1]] for _, atoms in pii.regions(text)]

    assert shown("see 1[.]2[.]3[.]4 now") == ["1[.]2[.]3[.]4"]
    assert [r[-16:] for r in shown("漢" * 80 + "0044-1234-567890")] == ["0044-1234-567890"]
    assert shown("page 12 of 30") == []
    long = "[" + "/1-2" * 30 + "]"
    assert len(pii.span_features(long, 0, len(long))[0]) > 60


def test_clean_documents_get_no_spans(model, spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("not rlike(text, '[0-9]{3}|@')").collect()
    assert len(rows) > 500
    assert not any(pii.added_spans(model, r.text, []) for r in rows)


def test_unusual_rows(spark, model):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "a@b.cd", 1), (4, "a@b.cd +1 (608) 555-2280", 1), (4, "a@b.cd +1 (608) 555-2280", 1)], "doc_id long, text string, base int")
    got = pii.digest(pii.find(docs, model, keep=("doc_id",))).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 5 and by[1].base_sha256 == by[2].base_sha256 and by[1].spans == ""
    assert by[4].n_email == 1 and by[4].n_phone == 1
    clean = {r.doc_id: r for r in pii.redact(docs, model).collect()}
    assert clean[4].text == "[EMAIL] [PHONE]" and clean[1].text is None and clean[4].base == 1
    empty = spark.createDataFrame([], docs.schema)
    assert pii.find(empty, pii.train(empty)).collect() == []


def test_query_on_the_small_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in op7_pii(spark, "/root/testdata/sf0.001").collect():
        base = brute_base(docs[r.doc_id] or "")
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == digest_row(base, pii.KINDS)
        assert set(f"{k}:{s}:{e}" for k, s, e in base) <= set(r.spans.split(",")) | {""}
