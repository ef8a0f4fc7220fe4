"""Chroma audio fingerprints over media columns, and groups of recordings that align.

A recording becomes frames of twelve pitch classes. Sixteen filters compare two halves of a
rectangle in that image by means of its integral image; each gives two bits in Gray code, so every
place holds one packed 32-bit integer. Two recordings that share integers vote for an offset; at the
histogram's peak the bit errors of the whole overlap decide. Recordings with one and the same
fingerprint are one class. Without a shared integer there is no vote, so every single integer is a key. Members of a
key's bucket are aligned with hubs first, and only what lies in several components goes on: small buckets as they
are, larger ones after more hubs and after what lies outside their largest component was split by the bits beside the integer.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, materialize, slices

RATE, FRAME, HOP = 4000, 512, 256
LOW_HZ, HIGH_HZ = 100.0, 1900.0
SPAN = 16  # frames that a filter may cover
HUBS = (1, 8)  # hubs that a bucket's open members meet, a round each, before they meet one another
MORE_HUBS = (32,)  # the same for what small buckets left open in larger ones
HOT = 256  # classes of a bucket that may meet one another without a look at the places beside the integer
TABLES = 12  # ways to split what lies outside a larger bucket's largest component
THRESHOLD = 0.12
MIN_OVERLAP, MAX_ERROR = 24, 0.25


def _filters() -> list[tuple[int, int, int, int]]:
    """(kind, first pitch class, height, width) by rule: kinds 0-3 split halves across time, across
    pitch, in quarters and against the middle third in time; sizes shrink as places go round."""
    out = []
    for i in range(16):
        kind = i % 4
        height = (12, 6, 4, 3)[i // 4]
        out.append((kind, (5 * i) % (13 - height), height, (16, 12, 8, 6)[(i + i // 4) % 4]))
    return out


FILTERS = _filters()


def wav_samples(data: bytes | None) -> np.ndarray:
    """Mono samples at RATE of a PCM WAV of 8 or 16 bits; unreadable or null data: none."""
    try:
        with wave.open(io.BytesIO(data or b"")) as w:
            width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
            raw = w.readframes(w.getnframes())
    except (wave.Error, EOFError):
        return np.empty(0)
    if width not in (1, 2):
        return np.empty(0)
    x = (np.frombuffer(raw, np.uint8) - 128.0) / 128 if width == 1 else np.frombuffer(raw, "<i2") / 32768.0
    x = x[: len(x) // channels * channels].reshape(-1, channels).mean(1)
    if rate != RATE and len(x):
        x = np.interp(np.arange(0, len(x), rate / RATE), np.arange(len(x)), x)
    return x


def score_samples(vector: list[float] | None) -> np.ndarray:
    """A vector played as notes of two octaves from 220 Hz, one note of HOP * 2 samples a component."""
    v = np.array([x for x in vector or () if x is not None and np.isfinite(x)], float)
    if not len(v):
        return np.empty(0)
    v = v / (np.sqrt((v * v).mean()) or 1.0)
    pitch = np.clip(np.round(6 * v + 12), 0, 24)
    hz = 220.0 * 2 ** (pitch / 12)
    phase = np.concatenate(([0.0], np.cumsum(np.repeat(hz, 2 * HOP))[:-1])) * 2 * np.pi / RATE
    return np.sin(phase)


def chroma(samples: np.ndarray) -> np.ndarray:
    """(frames, 12) energies of the pitch classes, each frame of length one (silent frames: zero)."""
    if len(samples) < FRAME:
        return np.zeros((0, 12))
    hz = np.fft.rfftfreq(FRAME, 1 / RATE)
    use = (hz >= LOW_HZ) & (hz <= HIGH_HZ)
    classes = np.round(12 * np.log2(hz[use] / 440.0)).astype(int) % 12
    fold = np.zeros((int(use.sum()), 12))
    fold[np.arange(len(classes)), classes] = 1
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    out = np.empty((len(frames), 12))
    for at in range(0, len(frames), 4096):  # long recordings in blocks
        part = np.abs(np.fft.rfft(frames[at : at + 4096] * np.hanning(FRAME), axis=1))[:, use] ** 2
        out[at : at + 4096] = part @ fold
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return np.where(norm > 1e-9, out / np.maximum(norm, 1e-9), 0.0)


def codes(image: np.ndarray) -> np.ndarray:
    """One unsigned 32-bit integer for every place where all filters fit."""
    n = len(image) - SPAN + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    total = np.zeros((len(image) + 1, 13))
    total[1:, 1:] = image.cumsum(0).cumsum(1)

    def area(t0: int, t1: int, y0: int, y1: int) -> np.ndarray:
        a, b = total[t0 : t0 + n], total[t1 : t1 + n]
        return b[:, y1] - a[:, y1] - b[:, y0] + a[:, y0]

    out = np.zeros(n, np.uint32)
    for i, (kind, y, h, w) in enumerate(FILTERS):
        all_ = area(0, w, y, y + h)
        if kind == 0:
            one = area(0, w // 2, y, y + h)
        elif kind == 1:
            one = area(0, w, y, y + (h + 1) // 2)
        elif kind == 2:
            one = area(0, w // 2, y, y + h // 2) + area(w // 2, w, y + h // 2, y + h)
        else:
            one = area(w // 3, 2 * w // 3, y, y + h)
        ratio = np.log((1 + one) / (1 + all_ - one))
        level = (ratio > -THRESHOLD).astype(np.uint32) + (ratio > 0) + (ratio > THRESHOLD)
        gray = (level ^ (level >> 1)).astype(np.uint32)
        out |= gray << np.uint32(2 * i)
    return out


def align(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[float, int]:
    """(share of differing bits, overlap) with b's place t + offset against a's place t."""
    start, end = max(0, -offset), min(len(a), len(b) - offset)
    if end <= start:
        return 1.0, 0
    diff = a[start:end] ^ b[start + offset : end + offset]
    return float(np.bitwise_count(diff).sum()) / (32 * (end - start)), end - start


def _held(a: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """First places and lengths of the runs of every integer."""
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(a), 1), bool), a[1:] != a[:-1])))
    sizes = np.diff(np.append(starts, len(a)))
    order = np.argsort(a[starts], kind="stable")
    names, at = np.unique(a[starts][order], return_index=True)
    return dict(zip(names.tolist(), zip(np.split(starts[order], at[1:]), np.split(sizes[order], at[1:]))))


def _peak(votes: np.ndarray, shift: int) -> int:
    offsets = np.flatnonzero(votes == votes.max()) - shift
    return int(offsets[np.lexsort((offsets, np.abs(offsets)))[0]])


def vote(a: np.ndarray, b: np.ndarray) -> int | None:
    """The offset that most equal integers vote for; ties to the smallest distance, then the smaller.

    Every pair of places votes. Short recordings are compared place by place. In long ones two runs of one
    integer give a trapezoid of votes over the offsets, which is added by its four corners, so that a note held for
    long costs no more than a short one. Both ways give the same offset.
    """
    if len(a) * len(b) <= 1 << 16:
        k, u = np.nonzero(a[:, None] == b[None, :])
        return _peak(np.bincount(u - k + len(a)), len(a)) if len(k) else None
    corners = np.zeros(len(a) + len(b) + 2, np.int64)
    other = _held(b)
    met = False
    for c, (s, n) in _held(a).items():
        if c in other:
            met = True
            u, m = other[c]
            for k, size in zip(s.tolist(), n.tolist()):  # offset o is kept at len(a) + o
                low = u - k + len(a)
                for at, sign in ((low - size + 1, 1), (low + 1, -1), (low + m - size + 1, -1), (low + m + 1, 1)):
                    np.add.at(corners, at, sign)
    return _peak(corners.cumsum().cumsum(), len(a)) if met else None


def fingerprints(media: DataFrame, id_col: str, media_col: str, decode: Callable = wav_samples) -> DataFrame:
    """(id, codes array<int>) of every recording, in one pass; `decode` turns a value into samples."""
    kind = media.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = [codes(chroma(decode(x))).view(np.int32) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int32()))], ["id", "codes"])

    return media.select(F.col(id_col).alias("id"), F.col(media_col).alias("m")).mapInArrow(run, f"id {kind}, codes array<int>")


def _aligned(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(u, v, offset, error) of the pairs that align; classes: (ck, codes)."""
    full = pairs.join(classes.select(F.col("ck").alias("u"), F.col("codes").alias("a")), "u").join(
        classes.select(F.col("ck").alias("v"), F.col("codes").alias("b")), "v").select("u", "v", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in slices(batches, 1024):
            u, v = t.column(0).to_pylist(), t.column(1).to_pylist()
            rows = []
            for i, (x, y) in enumerate(zip(_arrays(t.column(2)), _arrays(t.column(3)))):
                offset = vote(x, y)
                if offset is not None:
                    error, overlap = align(x, y, offset)
                    if overlap >= MIN_OVERLAP and error <= MAX_ERROR:
                        rows.append((u[i], v[i], offset, error))
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["u", "v", "offset", "error"])

    return full.mapInArrow(run, "u long, v long, offset int, error double")


def _arrays(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The unsigned codes of each row, as views."""
    flat = column.flatten().to_numpy().view(np.uint32)
    ends = np.cumsum(column.value_lengths().to_numpy())
    return (flat[e - n : e] for n, e in zip(column.value_lengths().to_numpy(), ends))


def _runs(classes: DataFrame) -> DataFrame:
    """(ck, key, before, after) of every run of one integer: the two places before it and behind it, zero beyond the ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in slices(batches, 256):
            for ck, c in zip(t.column(0).to_pylist(), _arrays(t.column(1))):
                starts = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
                ends = np.append(starts[1:], len(c))
                pad = np.concatenate(([0, 0], c, [0, 0])).astype(np.uint64)
                before = (pad[starts + 1] | pad[starts] << np.uint64(32)).view(np.int64)
                after = (pad[ends + 2] | pad[ends + 3] << np.uint64(32)).view(np.int64)
                columns = [np.full(len(starts), ck, np.int64), c[starts].view(np.int32), before, after]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["ck", "key", "before", "after"])

    return classes.select("ck", "codes").mapInArrow(run, "ck long, key int, before long, after long")


def _split(rows: DataFrame) -> DataFrame:
    """rows (key, ck, size, before, after), size beyond HOT a key, as (key long, ck) of smaller buckets, equal rows once.

    This only saves pairs: groups() compares what the parts leave apart. A bucket is split TABLES times, each time by as many sampled bits beside the integer as halve it to HOT. Bits next to a shared integer agree with probability 0.87 between the noisiest recordings that
    align, so of such pairs a bucket of 64 * HOT keeps 0.999, one of 4096 * HOT still 0.92, and copies with less noise more.
    """
    order = [np.random.default_rng(j).permutation(128) for j in range(TABLES)]
    wide = [[sum(1 << int(i) for i in o[:d]) for d in range(1, 41)] for o in order]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    low = [F.array(*[F.lit(signed(m % 2**64)) for m in w]) for w in wide]
    high = [F.array(*[F.lit(signed(m >> 64)) for m in w]) for w in wide]
    depth = F.least(F.lit(40), F.ceil(F.log2(F.col("size") / HOT))).cast("int")
    parts = [F.xxhash64("key", F.lit(j), F.col("before").bitwiseAND(F.element_at(low[j], depth)), F.col("after").bitwiseAND(F.element_at(high[j], depth))) for j in range(TABLES)]
    return rows.select("ck", F.explode(F.array(*parts)).alias("key")).distinct()


class _Links:
    """Pairs that were compared and the links among them, growing round by round."""

    def __init__(self, classes: DataFrame, save: Scratch):
        self.classes, self.save = classes, save
        empty = classes.select(F.col("ck").alias("u"), F.col("ck").alias("v")).limit(0)
        self.tested, self.found = empty, save(_aligned(empty, classes))
        self.named: DataFrame | None = None
        self.new: list[DataFrame] = []

    def compare(self, pairs: DataFrame) -> None:
        """pairs (a, b), in any order and repeated; those compared before are passed over."""
        fresh = pairs.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        fresh = self.save(fresh.join(self.tested, ["u", "v"], "left_anti"))
        links = self.save(_aligned(fresh, self.classes))
        if not links.isEmpty():
            self.found, self.new = self.found.union(links), [*self.new, links]
        self.tested = self.tested.union(fresh)

    def roots(self) -> DataFrame:
        """(ck, root) of every linked class. Links found since the last call are followed between the roots known by then."""
        if self.named is not None and not self.new:
            return self.named
        edges = reduce(DataFrame.union, self.new or [self.found]).select("u", "v")
        if self.named is None:
            named = components(edges, self.save).select(F.col("node").alias("ck"), "root")
        else:
            for end in ("u", "v"):
                old = self.named.select(F.col("ck").alias(end), F.col("root").alias("r"))
                edges = edges.join(old, end, "left").withColumn(end, F.coalesce("r", end)).drop("r")
            up = self.save(components(edges, self.save).select(F.col("node").alias("root"), F.col("root").alias("top")))
            moved = self.named.join(up, "root", "left").select("ck", F.coalesce("top", "root").alias("root"))
            added = up.join(self.named.select(F.col("ck").alias("root")), "root", "left_anti")
            named = moved.union(added.select(F.col("root").alias("ck"), F.col("top").alias("root")))
        self.named, self.new = self.save(named), []
        return self.named

    def open(self, members: DataFrame, first: bool = False) -> DataFrame:
        """members (key, ck) of the buckets that still meet several components, with comp and the bucket's largest, major.

        At first nothing is linked and every class is a component of its own.
        """
        placed = members.withColumn("comp", F.col("ck")) if first else self.save(
            members.join(self.roots(), "ck", "left").select("key", "ck", F.coalesce("root", "ck").alias("comp")))
        mixed = placed.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key").agg(
            F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("comps"), F.sum("c").alias("size"))
        mixed = self.save(mixed.where("comps > 1").select("key", "size", F.col("m.comp").alias("major")))
        return self.save(placed.join(mixed, "key"))

    def by_hubs(self, rows: DataFrame, rounds: tuple[int, ...] = HUBS) -> DataFrame:
        """Aligns what lies outside a bucket's major component with hubs of it; gives what stays open.

        Hubs are the members of the largest hashes, so that buckets choose the same few classes and pairs repeat.
        """
        for n in rounds:
            top = F.array_distinct(F.array(*[F.max_by("ck", F.xxhash64("ck", F.lit(i))) for i in range(n)]))
            hubs = self.save(rows.where("comp = major").groupBy("key").agg(top.alias("hubs")))
            pairs = rows.where("comp <> major").join(hubs, "key").select(F.col("ck").alias("a"), F.explode("hubs").alias("b"))
            self.compare(pairs)
            rows = self.open(rows.select("key", "ck"))
        return rows

    def outside(self, rows: DataFrame, runs: DataFrame) -> DataFrame | None:
        """What lies outside the major component, split, of buckets where that is more than HOT classes; None if there are none."""
        apart = rows.where("comp <> major").select("key", "ck")
        many = self.save(apart.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > HOT))
        return None if many.isEmpty() else self.save(_split(apart.join(many, "key").join(runs, ["key", "ck"])))

    def all(self, rows: DataFrame) -> None:
        """Aligns what lies outside a bucket's major component with all of its other components."""
        other = rows.select("key", F.col("ck").alias("b"), F.col("comp").alias("comp2"))
        self.compare(rows.where("comp <> major").join(other, "key").where("comp <> comp2").select(F.col("ck").alias("a"), "b"))


def groups(prints: DataFrame) -> DataFrame:
    """prints (id, codes) with class long, group_id (smallest id of all that align, over any number
    of steps), and the best alignment found with another fingerprint: with_id, offset int, bit_error.

    Candidates share an integer, as all that align do, and no link between components is lost: what is still outside a
    bucket's largest component at the end meets all of its other components. In buckets beyond HOT that comes last, after
    more hubs; where more than HOT classes lie outside, those alone are split first, so that copies among them are one component.
    Members of the largest component are never split, so a bucket that everybody holds makes rows only for those outside.
    The last pairs are dealt over tasks, but where much stays apart they grow with the square of the bucket.
    Defined cases: recordings too short for a fingerprint are groups of their own; equal fingerprints are one
    class whatever their number; null ids are kept and name a group only if it has no other; repeated rows stay
    repeated; null codes have no class; an empty table gives an empty result.
    """
    text = F.array_join("codes", ",")
    marked = materialize(prints.select("id", "codes", F.when(F.size("codes") > 0, F.xxhash64(text)).alias("ck")))
    with Scratch(prints.sparkSession) as save:
        classes = save(marked.where("ck is not null").groupBy("ck").agg(F.min("id").alias("low"), F.first("codes").alias("codes")))
        runs = save(_runs(classes))
        index = save(runs.select("key", "ck").distinct())
        held = save(index.groupBy("key").agg(F.count("*").alias("held")).where("held > 1").select("key"))
        links = _Links(classes, save)
        rows = links.by_hubs(links.open(save(index.join(held, "key")), first=True))
        links.all(rows.where(F.col("size") <= HOT))
        large = rows.where(F.col("size") > HOT)
        if not large.isEmpty():
            rest = links.by_hubs(links.open(large.select("key", "ck")), MORE_HUBS)
            parts = links.outside(rest, runs)
            if parts is not None:
                links.all(links.by_hubs(links.open(parts), HUBS[:1]))
                rest = links.open(rest.select("key", "ck"))
            links.all(rest)  # whole buckets
        rooted = save(classes.select("ck", "low").join(links.roots(), "ck", "left").select("ck", "low", F.coalesce("root", "ck").alias("root")))
        lows = save(rooted.groupBy("root").agg(F.min("low").alias("group_id")))
        found = links.found
        each = found.select(F.col("u").alias("ck"), F.col("v").alias("peer"), "offset", "error").union(
            found.select(F.col("v").alias("ck"), F.col("u").alias("peer"), (-F.col("offset")).alias("offset"), "error"))
        best = each.groupBy("ck").agg(F.min(F.struct("error", "peer", "offset")).alias("b")).select("ck", "b.*")
        best = save(best.join(classes.select(F.col("ck").alias("peer"), F.col("low").alias("with_id")), "peer").select("ck", "with_id", "offset", F.col("error").alias("bit_error")))
        info = materialize(rooted.join(lows, "root").join(best, "ck", "left").select("ck", "group_id", "with_id", "offset", "bit_error"))
    return marked.join(info, "ck", "left").select("id", "codes", F.coalesce("group_id", "id").alias("group_id"), "with_id", "offset", "bit_error")
