import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from veridact.llm import alignment
from veridact.llm.queries import op11_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LEFT = Tokenizer.from_file(A)
LEFT.encode_special_tokens = True
RIGHT = sentencepiece.SentencePieceProcessor(model_file=B)


def letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


BYTES = letters()


def left(text):
    e = LEFT.encode(" " + text, add_special_tokens=False)
    return e.ids, [bytes(BYTES[c] for c in t) for t in e.tokens]


def right(text):
    ids = RIGHT.encode(text)
    return ids, [bytes([int(RIGHT.id_to_piece(i)[3:-1], 16)]) if RIGHT.is_byte(i) else RIGHT.id_to_piece(i).replace("▁", " ").encode() for i in ids]


def ends(parts):
    out, at = [], 0
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def groups_of(text):
    """[(a ids, b ids)] of a text, by walking over bytes."""
    if not text:
        return []
    (a, pa_), (b, pb) = left(text), right(text)
    want = (" " + text).encode()
    if b"".join(pa_) != want or b"".join(pb) != want:
        return []
    ea, eb = ends(pa_), ends(pb)
    cuts = sorted(set(ea) & set(eb))
    found = [([], []) for _ in cuts]
    for side, (ids, at) in enumerate(((a, ea), (b, eb))):
        for i, e in zip(ids, at):
            found[bisect_left(cuts, e)][side].append(i)
    return found


def brute(texts):
    found = [groups_of(t or "") for t in texts]
    links = [Counter((x, y) for g in f for x in g[0] for y in g[1]) for f in found]
    count = Counter(p for m in links for p in m)
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    rows = []
    for f, m in zip(found, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f)
        rows.append((
            sum(len(x) for x, _ in f), sum(len(y) for _, y in f), len(f), sum(m.values()), sum(n for p, n in m.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in m.items()),
            hashlib.sha256(text.encode()).hexdigest() if f else ""))
    return rows


PIECES = ["a", "the", "ing", "'s", "!", "...", " ", "  ", "\n", "\n\n", "\t", "2024", "é", "日本", "🙂", " ", " ", "\x1c", "\x85", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "ß", "http://x", "x" * 40, "▁", "ﬁ", "́", "\x00"]


@pytest.mark.parametrize("seed", range(4))
def test_tokens_are_the_libraries_own(seed, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 7)
    rnd = random.Random(seed)
    p = alignment.pair(A, B)
    assert p.sides[1].by_word
    texts = []
    for _ in range(400):
        pieces = PIECES if rnd.random() < 0.5 else ["word", "Is", "of,", "don't", "x.", "été", "12a", "«ÿ»", "a\xa0b", "\xad"]
        sep = rnd.choice(["", " ", "\n"])
        texts.append(sep.join(rnd.choice(pieces) for _ in range(rnd.randint(1, 30))))
    words = [p.words(t) for t in texts]
    assert sum(len(w) > 1 for w in words) > 20 and all("".join(w) == " " + t for w, t in zip(words, texts))
    flat = [w for x in words for w in x]
    place, sides = p.encode(flat)
    found = [[x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] for ids, n in sides]
    at = 0
    for t, w in zip(texts, words):
        (la, pa_), (lb, pb) = left(t), right(t)
        same = b"".join(pa_) == b"".join(pb) == (" " + t).encode()
        own = place[at : at + len(w)]
        assert tuple([i for k in own for i in side[k]] for side in found) == ((la, lb) if same else ([], [])), t
        at += len(w)


def test_unusual_rows(spark):
    texts = [None, "", "word", "word", " ", "  two  spaces", "tail ", "a▁b", "<|endoftext|> <s>", "日本語 テキスト", "aaaa" * 900, "\n", "x" * 3000 + " " + "é" * 50, "Is of the. And\nthe of"]
    rows = [(None if i % 5 == 4 else i // 2, t, "z", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slice string, n_a int").repartition(3)
    want = sorted(((d if d is not None else -1), *b) for (d, *_), b in zip(rows, brute(texts)))
    for size in (1, 100, alignment.SLICE):
        got = alignment.score(docs, A, B, size=size)
        assert got.columns == alignment.RESULT
        assert sorted((r.id if r.id is not None else -1, *r[1:]) for r in got.collect()) == want
    empty = spark.createDataFrame([], docs.schema)
    assert alignment.score(empty, A, B).collect() == [] and alignment.vocabulary_map(empty, A, B).collect() == []


def test_a_run_of_one_token_costs_one_pair(spark):
    """Thousands of tokens in one group: the links are counted, not made."""
    text = "ก" * 8_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = alignment.score(docs, A, B).first()
    assert tuple(r)[1:] == brute([text])[0]


def test_query_on_the_small_table(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, *b) for r, b in zip(docs, brute([r.text for r in docs])))
    got = op11_token_alignment(spark, d)
    assert got.columns == ["doc_id", *alignment.RESULT[1:]]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_vocabulary_map_counts_documents(spark):
    texts = ["the cat", "the cat sat", "cat the", "the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    count = Counter(p for t in texts for p in {(x, y) for g in groups_of(t) for x in g[0] for y in g[1]})
    got = alignment.vocabulary_map(docs, A, B).collect()
    assert {(r.a, r.b): r.n for r in got} == dict(count)
    assert all(r.best == (r.n == max(n for (x, _), n in count.items() if x == r.a)) for r in got)
