import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from veridact.llm import bpe
from veridact.llm.queries import op5_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


PIECES = ["a", "the", "ing", "'s", "'", "'re", "!", "!!", "...", " ", "  ", "\n", "\t", "1", "2024", "é", "ñ", "日本", "語", "🙂", "👩‍👩‍👧", " ", " ", "\x1c", "\x85", "_", "<|endoftext|>", "<|endof", "text|>", "Ωmega", "ß", "http://x", "--", "x" * 40, "́", "٣", "Ⅷ"]


@pytest.mark.parametrize("seed", range(6))
def test_texts_match_the_library(seed):
    rnd = random.Random(seed)
    c = bpe.codec(PATH)
    for _ in range(300):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 60)))
        want = expected(text)
        assert c.encode(text) == want
        assert c.decode(want) == LIBRARY.decode(want, skip_special_tokens=False) == text


@pytest.mark.parametrize("seed", range(8))
def test_parts_join_exactly(seed):
    rnd = random.Random(100 + seed)
    c = bpe.codec(PATH)
    dense = [p for p in PIECES if not p.isspace()]
    kinds = [PIECES, dense, ["ab", "c", "'s", "'"], ["日", "本", "語🙂"], ["e", "r", "th", "in"], ["!", "'", "s", "re", "ll"]]
    for pieces in kinds:
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(200, 1500)))
        for size in (16, 37, 200):
            found = [(o, c.encode(p)) for p, o in bpe.parts(c, text, size)]
            assert bpe.merge(c, found) == expected(text)


def test_one_long_word_has_open_parts():
    c = bpe.codec(PATH)
    text = "".join(random.Random(1).choice("etaoin") for _ in range(5000))
    found = list(bpe.parts(c, text, 500))
    assert "".join(p for p, _ in found) == text and sum(o for _, o in found) >= 8
    assert bpe.merge(c, [(o, c.encode(p)) for p, o in found]) == expected(text)


def test_long_texts_with_spaces_go_through_the_tree():
    """Every part but the first of a stretch is open, white space or none."""
    rnd = random.Random(3)
    c = bpe.codec(PATH)
    for text in ("".join(rnd.choice([p for p in PIECES if "|" not in p]) for _ in range(20_000)), "word and " * 8000, " " * 40_000, "\n \t" * 9000 + "x", "a" * 50_000):
        found = list(bpe.parts(c, text))
        joined = [(o, c.encode(p)) for p, o in found]
        assert "".join(p for p, _ in found) == text and any(o for o, _ in joined)
        assert bpe.merge(c, joined) == expected(text)


def test_unusual_rows(spark):
    word = "abcdefghij" * 400
    rows = [(1, None), (2, ""), (None, "x y"), (None, word), (4, word + " " + word), (4, word + " " + word), (4, "other " * 300), (5, "a<|endoftext|>" * 100)]
    docs = spark.createDataFrame([(d, t, [7]) for d, t in rows], "doc_id long, text string, ids array<int>")
    got = bpe.encode(docs, PATH, long=1000, size=256)
    want = sorted(((d or -1, expected(t or "")) for d, t in rows))
    assert sorted((r.id or -1, r.ids) for r in got.collect()) == want
    texts = bpe.decode(got, PATH).collect()
    assert sorted(r.text for r in texts) == sorted(t or "" for _, t in rows)
    assert bpe.encode(spark.createDataFrame([], docs.schema), PATH).collect() == []


def test_query_on_the_small_table(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = op5_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        ids = expected(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
