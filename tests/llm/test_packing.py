import itertools
import random
import re

import pytest
from tokenizers import Tokenizer

from veridact.llm import packing as P
from veridact.llm.queries import op2_best_fit_packing, tokenizer_path


def brute_best_fit(lengths, capacities, overhead, attention):
    bins, left = [], sum(lengths)
    for n in lengths:
        fit = [b for b in bins if b[0] - sum(b[1]) >= n]
        if fit:
            min(fit, key=lambda b: b[0] - sum(b[1]))[1].append(n)
        else:
            c = min((c for c in capacities if c >= n), key=lambda c: ((c + c * c / attention + overhead) / max(min(c, left), 1), c))
            bins.append((c, [n]))
        left -= n
    return bins


def cost(bins, capacities, overhead, attention):
    return sum(c + c * c / attention + overhead for c in (min(c for c in capacities if c >= sum(b)) for _, b in bins))


@pytest.mark.parametrize("attention", (30, 65_536))
@pytest.mark.parametrize("seed", range(20))
def test_matches_a_plain_best_fit(seed, attention):
    rnd = random.Random(seed)
    caps = (8, 16, 40)
    lengths = sorted((rnd.randint(1, 40) for _ in range(rnd.randint(1, 120))), reverse=True)
    got = P.pack(lengths, caps, 2, attention)
    assert sorted(i for _, b in got for i in b) == list(range(len(lengths)))
    for c, b in got:
        held = sum(lengths[i] for i in b)
        assert held <= c and not any(held <= x < c for x in caps)
    sets = [x for k in (1, 2, 3) for x in itertools.combinations(caps, k) if x[-1] >= lengths[0]]
    tries = [cost(brute_best_fit(lengths, x, 2, attention), caps, 2, attention) for x in sets]
    assert sum(c + c * c / attention + 2 for c, _ in got) == pytest.approx(min(tries))


def test_long_bins_are_for_long_pieces():
    """Lengths of all sizes open bins of several sizes, and cost less than any one size."""
    rnd = random.Random(5)
    lengths = sorted((min(8192, int(rnd.lognormvariate(6, 1.3)) + 1) for _ in range(4000)), reverse=True)
    whole = lambda bins: sum(P.bin_cost(c) for c, _ in bins)
    got = P.pack(lengths)
    used = {c: sum(x == c for x, _ in got) for c in P.CAPACITIES}
    assert sum(n > 20 for n in used.values()) >= 3
    assert whole(got) < 0.97 * whole(P.pack(lengths, (8192,)))
    assert sum(c for c, _ in got) < 1.05 * sum(lengths)


def test_variable_sizes_beat_one_size():
    lengths = [700] * 50 + [300] * 90
    assert sum(c for c, _ in P.pack(lengths)) < sum(c for c, _ in P.pack(lengths, (8192,)))


def test_unusual_rows(spark):
    docs = spark.createDataFrame([(1, None, "b"), (2, "", "b"), (None, "a b", "b"), (None, "a c", "b"), (4, "w " * 20_000, "b"), (5, "x", "b"), (5, "x", "b")], "doc_id long, text string, bin string")
    got = P.packed(P.pieces(docs), shard=2).collect()
    assert sorted((r.id or 0, r.piece, r.n_tokens) for r in got) == [(0, 0, 2), (0, 0, 2), (1, 0, 0), (2, 0, 0), (4, 0, 8192), (4, 1, 8192), (4, 2, 3616), (5, 0, 1), (5, 0, 1)]
    assert all((r.bin is None) == (r.n_tokens == 0) for r in got)
    empty = spark.createDataFrame([], docs.schema)
    assert P.packed(P.pieces(empty)).collect() == []


def test_query_places_every_token_once_and_sequences_hold_the_text(spark):
    sf = "/root/testdata/sf0.001"
    rows = op2_best_fit_packing(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    library = Tokenizer.from_file(tokenizer_path())
    words = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids for r in docs.collect()}
    bins, ids = {}, {}
    for r in rows:
        ids[r.doc_id] = ids.get(r.doc_id, 0) + r.n_tokens
        if r.bin is not None:
            bins.setdefault((r.bin, r.capacity), []).append((r.start, r.n_tokens))
    assert ids == {d: len(w) for d, w in words.items()}
    for (_, capacity), held in bins.items():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:]))
        assert sum(held[-1]) <= capacity
    assert sum(n for held in bins.values() for _, n in held) / sum(c for _, c in bins) > 0.95
    placed = P.packed(P.pieces(docs, tokenizer=tokenizer_path()))
    full = P.sequences(docs, placed, tokenizer=tokenizer_path()).collect()
    assert all(len(r.ids) == r.n_tokens <= r.capacity for r in full) and sum(r.n_tokens for r in full) == sum(map(len, words.values()))
    by_words = P.packed(P.pieces(docs))
    texts = P.sequences(docs, by_words).collect()
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in texts) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect())


def test_unspaced_text_is_cut_by_tokens(spark):
    """A text without white space is one word but many tokens; no bin overflows."""
    docs = spark.createDataFrame([(1, "漢字仮名" * 6000)], "doc_id long, text string")
    n = len(Tokenizer.from_file(tokenizer_path()).encode("漢字仮名" * 6000, add_special_tokens=False).ids)
    got = P.packed(P.pieces(docs, tokenizer=tokenizer_path())).collect()
    assert n > 8192 and sum(r.n_tokens for r in got) == n and all(r.start + r.n_tokens <= r.capacity for r in got)
