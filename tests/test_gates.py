import random

import pytest
from pyspark.sql import functions as F

from veridact.operators import gates, layout, trust
from veridact.schemas import ContractError


def walk(rows):
    """Greedy walk in rank order: (rank, reason, keeper)."""
    contents, authors, out = {}, {}, []
    for rank, c, a in sorted(rows):
        if c in contents:
            out.append((rank, "duplicate_content", contents[c]))
        elif a in authors:
            out.append((rank, "same_author", authors[a]))
        else:
            contents[c] = authors[a] = rank
            out.append((rank, None, None))
    return out


def test_duplicate_gate_is_the_greedy_walk(spark):
    rnd = random.Random(4)
    rows, want = [], []
    for g in range(60):
        n = rnd.randint(1, 14)
        own = [(i + 1, f"c{rnd.randrange(6)}", f"a{rnd.randrange(6)}") for i in range(n)]
        rows += [(f"p{g}", *r) for r in own]
        want += [(f"p{g}", *r) for r in walk(own)]
    df = spark.createDataFrame(rows, "product_id string, rank int, content_hash string, author string")
    assert sorted(map(tuple, gates.duplicate_gate(df).collect()), key=str) == sorted(want, key=str)


def test_identity_gate_gives_one_reason_in_order(spark):
    rows = [(1, "p1", "2020.01.01"), (2, "p1", "2024.05.01"), (3, "p2", "2019-12-31"), (4, "p9", "2024.05.01"), (5, "p3", "2024.05.01"), (6, "p1", "2023.01.05")]
    reviews = spark.createDataFrame(rows, "review_id int, product_id string, review_date string")
    products = spark.createDataFrame([("p1", "separate", "2021-01", None), ("p2", "single", None, None), ("p3", "unobserved", None, None)], "product_id string, renewal_policy string, from_month string, to_month string")
    got = {r.review_id: (r.reason, r.limitation) for r in gates.identity_gate(reviews, products, "2023-06").collect()}
    assert got == {1: ("renewal_cut", None), 2: (None, None), 3: ("recency_cut", None), 4: ("product_mismatch", None), 5: (None, "renewal_unobserved"), 6: ("recency_cut", None)}
    keyed = reviews.where("review_id in (2, 5)").crossJoin(spark.createDataFrame([("shade", "1|a"), ("shade", "b"), ("pack", None), (None, None)], "kind string, shade_key string"))
    scoped = gates.identity_gate(keyed, products, "2023-06", F.lit("1|a"))
    assert sorted({(str(r.kind), str(r.shade_key), str(r.reason)) for r in scoped.collect()}) == [
        ("None", "None", "option_unstated"), ("pack", "None", "option_mismatch"), ("shade", "1|a", "None"), ("shade", "b", "option_mismatch")]


def test_sufficiency_gate_order(spark):
    rows = [(3, 0, 0, 3, 7), (3, 2, 0, 5, 30), (8, 0, 92, 100, 200), (8, 0, 72, 80, 200), (9, 1, 0, 10, 12), (9, 2, 0, 11, 12), (5, 5, 0, 9, 9)]
    df = spark.createDataFrame(rows, "pos int, neg int, neu int, spoke int, cell_authors int")
    got = [(r.reason, r.limitation) for r in gates.sufficiency_gate(df).collect()]
    assert got == [("segment_too_small", None), ("insufficient_support", None), ("minority_share", None), (None, None), (None, "single_dissent"), (None, None), ("invariant_broken", None)]


def turns(quotes, k):
    """One promotion after the other: each missing polarity, in text order, takes the last of the most frequent."""
    kept, reserved = quotes[:k], []
    for p in sorted({q[1] for q in quotes}):
        if any(q[1] == p for q in kept):
            continue
        counts = {x: sum(q[1] == x for q in kept) for x in sorted({q[1] for q in kept})}
        most = max(counts, key=lambda x: (counts[x], [-ord(c) for c in x]))
        kept.remove([q for q in kept if q[1] == most][-1])
        best = next(q for q in quotes if q[1] == p)
        kept.append(best)
        reserved.append(best[0])
    return sorted((i, p, i in reserved) for i, p in kept)


def test_truncation_keeps_every_direction(spark):
    rnd = random.Random(9)
    rows, want = [], []
    for g in range(80):
        weights = [rnd.random() ** 3 for _ in range(3)]
        own = [(i + 1, rnd.choices(["negative", "neutral", "positive"], weights)[0]) for i in range(rnd.randint(1, 25))]
        seen = {}
        for rank, p in own:
            seen[p] = seen.get(p, 0) + 1
            rows.append((f"p{g}", "a", rank, p, seen[p]))
        want += [(f"p{g}", *x) for x in turns(own, 8)]
    df = spark.createDataFrame(rows, "product_id string, aspect string, quote_rank int, polarity string, polarity_rank int")
    got = layout.truncate(df, ["product_id"]).select("product_id", "quote_rank", "polarity", "reserved").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_a_long_chain_needs_few_rounds(spark, monkeypatch):
    """Row i shares its content with the one before and its author with the one behind: peeling alone takes a round for every second row."""
    n = 10_000
    rows = [("p", i + 1, f"c{(i + 1) // 2}", f"a{i // 2}") for i in range(n)]
    df = spark.createDataFrame(rows, "product_id string, rank int, content_hash string, author string").repartition(4)
    peeled = gates._peeled
    rounds = []
    monkeypatch.setattr(gates, "_peeled", lambda *x: rounds.append(1) or peeled(*x))
    got = sorted((r.rank, r.reason, r.kept_rank) for r in gates.duplicate_gate(df).collect())
    assert got == sorted(walk([r[1:] for r in rows])) and len(rounds) == gates.ROUNDS


def test_components_beyond_a_task_go_on_peeling(spark, monkeypatch):
    monkeypatch.setattr(gates, "ROUNDS", 1)
    monkeypatch.setattr(gates, "FOLD", 5)
    rnd = random.Random(6)
    rows = [(g, i + 1, f"c{rnd.randrange(12)}", f"a{rnd.randrange(12)}") for g, n in (("p", 30), ("q", 8), ("r", 3)) for i in range(n)]
    want = [(g, *x) for g in "pqr" for x in walk([r[1:] for r in rows if r[0] == g])]
    df = spark.createDataFrame(rows, "product_id string, rank int, content_hash string, author string")
    assert sorted(map(tuple, gates.duplicate_gate(df).collect()), key=str) == sorted(want, key=str)
    assert gates.duplicate_gate(df.where("false")).collect() == []


def test_rows_without_a_key_are_refused(spark):
    rows = [("p", 1, "c", None), ("p", 2, "c", "a")]
    df = spark.createDataFrame(rows, "product_id string, rank int, content_hash string, author string")
    with pytest.raises(ContractError):
        gates.duplicate_gate(df)


def test_first_quotes_are_those_of_the_whole_ranking(spark):
    rnd = random.Random(2)
    rows, tags = [], []
    for i in range(1, 900):
        rows.append((f"p{rnd.randrange(6)}", i, rnd.choice([None, 0.5, 0.5, round(rnd.random(), 1)]), rnd.choice(["2024.01.01", "2024.02.01"])))
        for a in rnd.sample("xyz", rnd.randint(0, 2)):
            tags.append((i, a, rnd.choices(["positive", "negative", "neutral"], [20, 1, 0.5])[0]))
    member = spark.createDataFrame(rows, "product_id string, review_id long, trust_score double, review_date string").repartition(5)
    said = spark.createDataFrame(tags, "review_id long, aspect string, polarity string")
    cell = ["product_id"]
    whole = layout.ranked_quotes(member, said, cell).where("quote_rank <= 8 or polarity_rank = 1")
    near = layout.first_quotes(member, said, cell)
    columns = ["product_id", "aspect", "review_id", "polarity", "quote_rank", "polarity_rank"]
    want = sorted(map(tuple, whole.select(*columns).collect()))
    assert sorted(map(tuple, near.select(*columns).collect())) == want and any(r[4] > 8 for r in want)
    assert layout.first_quotes(member.where("false"), said, cell).collect() == []


def test_null_contents_are_scored(spark):
    df = spark.createDataFrame([(1, "p", None, 1, "2024.01.01"), (2, "p", None, 2, "2024.01.01"), (3, "p", "x" * 50, 1, "2024.01.01")], "review_id int, product_id string, content string, likes int, review_date string")
    got = {r.review_id: (r.content_length, r.copies, r.s_length, r.s_unique) for r in trust.signals(df).collect()}
    assert got[1] == got[2] == (0, 1, 0.0, 1.0) and got[3][:2] == (50, 1)
