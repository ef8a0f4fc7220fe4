import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm import brute
from veridact.llm import simhash
from veridact.llm.queries import op10_simhash_near_dedup

SCHEMA = "doc_id long, text string, component long, fp string"


def rows(df):
    return sorted(((r.id, r.fp & (1 << 64) - 1, r.component) for r in df.collect()), key=str)


def expected(docs):
    fps = [brute.simhash(t) for _, t in docs]
    return sorted(zip([d for d, _ in docs], fps, brute.component_ids([d for d, _ in docs], fps)), key=str)


def test_matches_all_pairs_on_hard_rows(spark):
    rnd = random.Random(1)
    base = [" ".join(rnd.choice("abcdefghij") * rnd.randint(1, 4) for _ in range(60)) for _ in range(12)]
    docs = [(None, "x y z"), (5, None), (6, ""), (7, " \t\n"), (8, "One"), (8, "one"), (9, "a b"), (10, "Straße É x")]
    for i, t in enumerate(base):
        for j in range(8):
            w = t.split()
            for _ in range(rnd.randint(0, 2)):
                w[rnd.randrange(len(w))] = "q" * rnd.randint(1, 3)
            docs.append((100 + i * 10 + j, " ".join(w)))
    docs += docs[:20]
    df = spark.createDataFrame([(d, t, 1, "clash") for d, t in docs], SCHEMA)
    assert rows(simhash.near_duplicates(df)) == expected(docs)


def test_dense_buckets_and_chains_link_exactly(spark):
    """Fingerprints within few bits of one another, where hubs don't link everything."""
    rnd = random.Random(2)
    fps = set()
    for centre in (0x0123456789ABCDEF, 0x0123456789AB0000, 0):
        at = centre
        for _ in range(120):
            for _ in range(rnd.randint(1, 3)):
                at ^= 1 << rnd.choice([*range(12), *range(32, 38)])
            fps.add(at)
            fps.add(centre ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    fps = sorted(fps)
    df = spark.createDataFrame([(signed(x), 1) for x in fps], "fp long, n long")
    got = {r.fp & (1 << 64) - 1: r.root for r in simhash.link(df).collect()}
    low = brute.component_ids(list(range(len(fps))), fps)
    want, have = {}, {}
    for i, x in enumerate(fps):
        want.setdefault(low[i], set()).add(x)
        have.setdefault(got.get(x, signed(x)), set()).add(x)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_on_the_small_table(spark):
    got = op10_simhash_near_dedup(spark, "/root/testdata/sf0.001")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = [(d, f"{x:016x}", c) for d, x, c in expected(docs)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert got.schema["component_id"].dataType.simpleString() == "bigint"
    assert got.where(F.col("fingerprint").rlike("[^0-9a-f]")).isEmpty()


def test_keep_one_drops_near_copies_and_nothing_else(spark):
    rnd = random.Random(6)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 8))) for _ in range(4000)]
    docs, group = [], {}
    passage = " ".join(rnd.choice(vocabulary) for _ in range(40))
    for g in range(25):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([30, 120, 400]))] + (passage.split() if g % 3 == 0 else [])
        for j in range(rnd.choice([1, 2, 6])):
            words = list(base)
            if j > 1:
                words[rnd.randrange(len(words))] = "changed"
            docs.append((1000 - len(docs), " ".join(words).upper() if j == 1 else " ".join(words)))
            group[docs[-1][0]] = g
    kept = {}
    for d, t in docs:
        same = simhash.jaccard(t, next(x for y, x in docs if group[y] == group[d]))
        if same >= 0.8:
            kept[group[d]] = min(d, kept.get(group[d], d))
        else:
            kept[d, "own"] = d
    extra = [(None, docs[0][1]), (2000, ""), (2001, None), (2002, " \n"), (2003, ""), docs[5], docs[5]]
    df = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(docs + extra)], "doc_id long, text string, _row int")
    got = simhash.keep_one(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted([*kept.values(), 2000, 2001, 2002, 2003])
    assert simhash.keep_one(df.where("false")).count() == 0


def test_copies_whose_lines_repeat_another_number_of_times_are_found(spark):
    """Pairs alike by distinct shingles, with a line, a cell or a word repeated otherwise: all are found."""
    rnd = random.Random(9)
    some = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    docs = []
    for n in [1, 5, 9, 20, 40, 60, 100, 100, 200] * 8:
        base, line = some(n), some(rnd.choice([1, 6, 12]))
        for times in (2, rnd.randint(20, 120)):
            docs.append((len(docs), base + f" {line}" * times))
    pairs = [i for i in range(0, len(docs), 2) if simhash.jaccard(docs[i][1], docs[i + 1][1]) >= 0.8]
    assert len(pairs) > 45
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept == {d for d, _ in docs} - {i + 1 for i in pairs}


def test_recall_of_similar_pairs(spark):
    """Of all pairs of sf0.01 at 0.8 or more, those whose texts end in one group (all pairs are looked at)."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, np.unique(simhash.shingle_hashes(r.text, 5))) for r in docs.collect()]
    rows = [r for r in rows if len(r[1])]
    every = np.unique(np.concatenate([s for _, s in rows]))
    held = [np.searchsorted(every, s) for _, s in rows]
    lengths = np.array([len(s) for _, s in rows])
    pairs = []
    for i in range(len(rows)):
        mark = np.zeros(len(every), bool)
        mark[held[i]] = True
        for j in np.flatnonzero((lengths[:i] >= 0.8 * lengths[i]) & (lengths[:i] <= lengths[i] / 0.8)):
            both = int(mark[held[j]].sum())
            if both >= 0.8 * (lengths[i] + lengths[j] - both) - 1e-9:
                pairs.append((rows[i][0], rows[j][0]))
    found = docs.select("doc_id", simhash._row("doc_id", "text").alias("row")).join(simhash.copy_groups(docs), "row")
    group = {r.doc_id: r.keeper for r in found.collect()}
    near = [group[a] == group[b] for a, b in pairs]
    assert len(near) > 100 and sum(near) >= 0.99 * len(near)


def test_large_group_of_unlike_relatives_makes_few_pairs(spark):
    """Copies of one text with edits from few to many: links as by all pairs, candidates in proportion."""
    rnd = random.Random(11)
    base = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(150)]
    docs = [(i, " ".join(w if rnd.random() > share else f"edit{rnd.randrange(10**6)}" for w in base)) for i, share in enumerate([0.0] + [k / 2500 for k in range(250)])]
    sets = [np.unique(simhash.shingle_hashes(t, 5)) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    pairs = []
    late = simhash._late_pairs

    def counted(*args):
        out = late(*args)
        pairs.append(out.count())
        return out

    simhash._late_pairs = counted
    try:
        kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    finally:
        simhash._late_pairs = late
    assert kept == {i for i in range(len(docs)) if find(i) == i}
    assert 20 < len(kept) < 200 and pairs[0] < 4 * len(docs)


def test_components_of_chains_stars_and_loops(spark):
    from veridact.llm.common import components

    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (7, 7), (300, 299), (300, 298), (298, 299)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(21)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200, 202: 200, 298: 298, 299: 298, 300: 298}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
