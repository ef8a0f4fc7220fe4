import io
import wave

import numpy as np

from veridact.llm import chroma as C
from veridact.llm import queries as Q


def wav(samples, rate=C.RATE, width=2, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        x = np.repeat(np.clip(samples, -1, 1), channels)
        w.writeframes((x * 32767).astype("<i2").tobytes() if width == 2 else (x * 127 + 128).astype(np.uint8).tobytes())
    return out.getvalue()


def tune(seed, notes=60):
    return C.score_samples(np.random.default_rng(seed).normal(size=notes).tolist())


def test_integral_image_filters_match_plain_sums():
    image = np.random.default_rng(1).random((40, 12))
    got = C.codes(image)
    assert len(got) == 40 - C.SPAN + 1
    for t in (0, 7, len(got) - 1):
        want = 0
        for i, (kind, y, h, w) in enumerate(C.FILTERS):
            box = image[t : t + w, y : y + h]
            one = {0: box[: w // 2].sum(), 1: box[:, : (h + 1) // 2].sum(), 2: box[: w // 2, : h // 2].sum() + box[w // 2 :, h // 2 :].sum(), 3: box[w // 3 : 2 * w // 3].sum()}[kind]
            r = np.log((1 + one) / (1 + box.sum() - one))
            level = int(r > -C.THRESHOLD) + int(r > 0) + int(r > C.THRESHOLD)
            want |= (level ^ level >> 1) << 2 * i
        assert got[t] == want


def test_noise_loudness_format_and_shift_keep_the_alignment():
    x = tune(3)
    own = C.codes(C.chroma(x))
    rng = np.random.default_rng(0)
    for data in (wav(0.4 * x + 0.02 * rng.normal(size=len(x))), wav(0.5 * x, width=1), wav(0.5 * x, channels=2), wav(np.interp(np.arange(0, len(x), 0.5), np.arange(len(x)), 0.5 * x), rate=2 * C.RATE)):
        other = C.codes(C.chroma(C.wav_samples(data)))
        assert C.vote(own, other) == 0 and C.align(own, other, 0)[0] < 0.15
    late = C.codes(C.chroma(C.wav_samples(wav(0.5 * np.concatenate((tune(4, 10), x))))))
    assert C.vote(own, late) == 20 and C.align(own, late, 20)[0] < 0.1
    error, _ = C.align(own, C.codes(C.chroma(tune(5))), 0)
    assert error > C.MAX_ERROR


def test_every_pair_of_places_votes():
    def plain(a, b):
        votes = {}
        for t, c in enumerate(a):
            for u, d in enumerate(b):
                if c == d:
                    votes[u - t] = votes.get(u - t, 0) + 1
        return min(votes, key=lambda o: (-votes[o], abs(o), o)) if votes else None

    rng = np.random.default_rng(1)
    some = lambda: np.repeat(x := rng.integers(0, 5, rng.integers(0, 8)), rng.integers(1, 9, len(x))).astype(np.uint32)
    for _ in range(300):
        a, b = some(), some()
        assert C.vote(a, b) == plain(a.tolist(), b.tolist())
        far = np.arange(9, 1 << 17, dtype=np.uint32)  # too long for place by place, nothing of it in b
        assert C.vote(np.concatenate((a, far)), b) == plain(a.tolist(), b.tolist())
    # a tone held for 300 places, cut inside: its end, not its first places, tells the offset
    a = np.array([*range(10, 40), *[7] * 300, *range(50, 80)], np.uint32)
    assert C.vote(a, a[200:]) == -200 and C.align(a, a[200:], -200)[0] == 0
    assert C.vote(np.full(100_000, 7, np.uint32), np.full(100_000, 7, np.uint32)) == 0


def by_all_pairs(prints):
    """Sorted (id or -1, group) by voting and aligning every pair."""
    marks = [(r.id, np.array(r.codes, np.int32).view(np.uint32)) for r in prints.collect()]
    root = list(range(len(marks)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(marks):
        for j, (_, b) in enumerate(marks[:i]):
            o = C.vote(a, b) if len(a) and len(b) else None
            if o is not None and C.align(a, b, o)[1] >= C.MIN_OVERLAP and C.align(a, b, o)[0] <= C.MAX_ERROR:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(marks):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted((d if d is not None else -1, low.get(find(i))) for i, (d, _) in enumerate(marks))


def test_query_groups_match_all_pairs(spark):
    """The query on the given table: every link that voting over all pairs finds, though all lie near the limit."""
    where = "/root/testdata/sf0.001"
    got = Q.op3_chroma_fingerprints(spark, where).collect()
    want = by_all_pairs(C.fingerprints(Q.table(spark, where, "embeddings"), "vec_id", "embedding", C.score_samples))
    assert sorted((r.vec_id, r.group_id) for r in got) == want
    assert len({g for _, g in want}) < len(want)


def test_large_buckets_are_split_and_keep_copies(spark, monkeypatch):
    """A note that all recordings hold: its bucket is beyond HOT, noisy copies of a tune still meet, others stay apart."""
    monkeypatch.setattr(C, "HOT", 3)
    rng = np.random.default_rng(7)
    hold = np.sin(2 * np.pi * 220 * np.arange(40 * C.HOP) / C.RATE)
    rows = []
    for g in range(6):
        x = np.concatenate((tune(200 + g, 40), hold, tune(300 + g, 40)))
        for j in range(2):
            rows.append((g * 10 + j, wav(0.5 * x + 0.02 * j * rng.normal(size=len(x)))))
    prints = C.fingerprints(spark.createDataFrame(rows, "rec long, audio binary"), "rec", "audio")
    got = sorted((r.id, r.group_id) for r in C.groups(prints).collect())
    assert got == by_all_pairs(prints)
    assert all(g <= i // 10 * 10 for i, g in got)
    beside = rng.integers(-(2**63), 2**63, size=(4, 2))
    same = spark.createDataFrame([(i, 7, 1000, int(beside[i // 8, 0]), int(beside[i // 8, 1])) for i in range(32)], "ck long, key int, size long, before long, after long")
    parts = C._split(same).groupBy("key").count().collect()
    assert sum(r["count"] for r in parts) == 32 * C.TABLES and max(r["count"] for r in parts) < 32 and min(r["count"] for r in parts) >= 8


def test_groups_match_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = []
    for g in range(5):
        x = tune(10 + g, 50)
        for j in range(4):
            y = np.concatenate((tune(90 + j, 2 * j), x)) + 0.02 * j * rng.normal(size=len(x) + 4 * j * C.HOP)
            rows.append((g * 10 + j, wav(0.5 * y)))
    rows += [(2, rows[2][1]), (70, b""), (71, None), (72, b"no audio"), (None, rows[0][1]), (80, wav(np.zeros(30_000))), (81, wav(np.zeros(40_000)))]
    df = spark.createDataFrame([(i, a, 1) for i, a in rows], "rec long, audio binary, offset int")
    prints = C.fingerprints(df, "rec", "audio")
    got = C.groups(prints).collect()
    want = by_all_pairs(prints)
    assert sorted((r.id if r.id is not None else -1, r.group_id) for r in got) == want
    assert len({g for _, g in want}) < 14
    assert all(r.bit_error is None or r.bit_error <= C.MAX_ERROR for r in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "rec long, audio binary")
    assert C.groups(C.fingerprints(df, "rec", "audio")).collect() == []
