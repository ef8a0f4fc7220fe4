"""Secret scans: exact patterns, and a character convolutional network over every candidate.

Patterns give the base spans. Every other long token with the look of a key is a candidate: a numpy
network reads its characters and those around it. It is trained on labelled findings (by default
the base findings of a sample against that sample's other candidates, with and without their key
names in sight), its scores are calibrated on findings held out by row (a token found more than once
may be in both parts), and each look of token (hex, upper case and digits, mixed) gets the highest
threshold that still recalls MIN_RECALL of those findings.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, slices

KINDS = ("assign", "access", "hex")
LEARNED = "learned"
MIN_RECALL = 0.99
#: Bounds of the training sample: documents with a digit, characters of one, findings of each label.
SAMPLE, SAMPLE_CHARS, FINDINGS, MADE = 3000, 60_000, 3000, 600

_ASSIGN = re.compile(r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{8,}")
#: What a plain word lacks: a digit, a capital behind a small letter; long tokens need neither.
_ODD, PLAIN = re.compile(r"[0-9]|[a-z][A-Z]"), 20

LEFT, HEAD, TAIL, RIGHT = 20, 24, 16, 12
WIDTH = LEFT + HEAD + TAIL + RIGHT
_PART, STEP = re.compile(r"[^/.=]{8,}"), 8


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern matches by start, then kind as listed; assign spans hold the key name and the value."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    """Tokens of 8 characters or more that hold a digit or a capital behind a small letter, or are of PLAIN or more.

    Shorter ones are words by their look, and nothing in a character tells them from a passphrase.
    """
    return [m.span() for m in _TOKEN.finditer(text) if m.end() - m.start() >= PLAIN or _ODD.search(m.group())]


def look(token: str) -> int:
    """0 hex, 1 upper case and digits, 2 anything else."""
    if re.fullmatch(r"[0-9a-f]+", token):
        return 0
    return 1 if re.fullmatch(r"[A-Z0-9]+", token) else 2


def _classes() -> np.ndarray:
    """Class of each code point below 128: control, single marks, digits, hex letters, vowels, others."""
    table = np.zeros(129, np.int64)
    marks = "+/_.=-:\"'@()[]{}<>,;&?#%$!"
    for i in range(33, 127):
        c = chr(i)
        if c.isdigit():
            table[i] = 1
        elif c.islower():
            table[i] = 2 if c in "aeiou" else 3 if c in "bcdf" else 4
        elif c.isupper():
            table[i] = 5 if c in "AEIOU" else 6
        else:
            table[i] = 7 + marks.index(c) if c in marks else 7 + len(marks)
    table[32] = 8 + len(marks)
    table[128] = 9 + len(marks)  # beyond ASCII
    return table


_CLASS = _classes()
CHANNELS = int(_CLASS.max()) + 3  # padding, and whether a place is inside the candidate


def window(text: str, start: int, end: int) -> np.ndarray:
    """Class ids: LEFT places before, HEAD and TAIL of the candidate (padded between), RIGHT after."""
    out = np.full(WIDTH, -1, np.int64)
    before, token, after = text[max(0, start - LEFT) : start], text[start:end], text[end : end + RIGHT]

    def put(at: int, part: str) -> None:
        codes = np.fromiter(map(ord, part), np.int64, len(part))
        out[at : at + len(part)] = _CLASS[np.minimum(codes, 128)]

    put(LEFT - len(before), before)
    put(LEFT, token[:HEAD])
    rest = token[HEAD:][-TAIL:]
    put(LEFT + HEAD + TAIL - len(rest), rest)
    put(LEFT + HEAD + TAIL, after)
    return out


def windows(text: str, start: int, end: int) -> Iterator[tuple[int, np.ndarray]]:
    """(look, window) of a candidate, and where it is too long for one, of its pieces.

    Pieces are the parts between / . and = signs, and stretches that overlap by all but STEP places,
    so that every place of a candidate of any length is read.
    """
    yield look(text[start:end]), window(text, start, end)
    size = HEAD + TAIL
    if end - start > size:
        parts = [m.span() for m in _PART.finditer(text, start, end)]
        for a, b in [*parts, *((a, a + size) for a in range(start, end - size, STEP)), (end - size, end)]:
            if b - a <= size:
                yield look(text[a:b]), window(text, a, b)


def encode(windows: np.ndarray) -> np.ndarray:
    """(n, WIDTH, CHANNELS) one-hot input."""
    x = np.zeros((*windows.shape, CHANNELS), np.float32)
    np.put_along_axis(x, np.where(windows < 0, CHANNELS - 2, windows)[:, :, None], 1, 2)
    x[:, LEFT : LEFT + HEAD + TAIL, CHANNELS - 1] = 1
    return x


KERNEL, FILTERS, HIDDEN = 5, 24, 16


@dataclass
class Model:
    conv: np.ndarray  # (KERNEL * CHANNELS, FILTERS)
    conv_bias: np.ndarray
    dense: np.ndarray  # (3 * FILTERS + 4, HIDDEN)
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float]  # Platt calibration
    thresholds: tuple[float, float, float]

    def hidden(self, windows: np.ndarray):
        x = encode(windows)
        cols = np.lib.stride_tricks.sliding_window_view(x, KERNEL, axis=1).transpose(0, 1, 3, 2).reshape(len(x), WIDTH - KERNEL + 1, -1)
        act = np.maximum(cols @ self.conv + self.conv_bias, 0)
        inner = act[:, LEFT : LEFT + HEAD + TAIL - KERNEL + 1]
        outer = np.concatenate((act[:, :LEFT], act[:, LEFT + HEAD + TAIL :]), 1)
        # most and mean activation in the candidate, most around it, and the candidate's make-up
        token = windows[:, LEFT : LEFT + HEAD + TAIL]
        n = np.maximum((token >= 0).sum(1), 1)
        share = np.stack([(token == 1).sum(1) / n, ((token >= 2) & (token <= 4)).sum(1) / n, ((token == 5) | (token == 6)).sum(1) / n, n / (HEAD + TAIL)], 1)
        pooled = np.concatenate((inner.max(1), inner.mean(1), outer.max(1), share), 1)
        return cols, act, inner, outer, pooled

    def raw(self, windows: np.ndarray) -> np.ndarray:
        if not len(windows):
            return np.zeros(0)
        z = np.maximum(self.hidden(windows)[4] @ self.dense + self.dense_bias, 0)
        return z @ self.out + self.out_bias

    def scores(self, windows: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.raw(windows) + b, -40, 40)))


def _blank(rng: np.random.Generator) -> Model:
    return Model(
        rng.normal(0, 0.15, (KERNEL * CHANNELS, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.15, (3 * FILTERS + 4, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), 0.0, (1.0, 0.0), (2.0, 2.0, 2.0),
    )


def fit(findings: list[tuple[str, int, int, int]], steps: int = 600, seed: int = 3) -> Model:
    """Train on (text, start, end, label) findings; a fifth is held for calibration and thresholds.

    Without findings of both labels the thresholds are out of reach and nothing is added.
    """
    rng = np.random.default_rng(seed)
    model = _blank(rng)
    y = np.array([f[3] for f in findings], float)
    if len(y) < 20 or not 0 < y.sum() < len(y):
        return model
    x = np.stack([window(*f[:3]) for f in findings])
    looks = np.array([look(t[s:e]) for t, s, e, _ in findings])
    order = rng.permutation(len(y))
    cal, own = order[: len(y) // 5], order[len(y) // 5 :]
    weight = np.where(y == 1, 0.5 / max(y[own].sum(), 1), 0.5 / max((1 - y[own]).sum(), 1)) * len(own)
    names = ("conv", "conv_bias", "dense", "dense_bias", "out", "out_bias")
    state = {n: [0.0, 0.0] for n in names}
    step = 0
    while step < steps:
        own = rng.permutation(own)
        for at in range(0, len(own), 128):
            idx = own[at : at + 128]
            step += 1
            rate = 0.012 * max(0.05, 1 - step / steps)
            cols, act, inner, outer, pooled = model.hidden(x[idx])
            z = pooled @ model.dense + model.dense_bias
            h = np.maximum(z, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ model.out + model.out_bias, -40, 40)))
            d = weight[idx] * (p - y[idx]) / len(idx)
            dz = np.outer(d, model.out) * (z > 0)
            dp = dz @ model.dense.T
            da = np.zeros_like(act)
            rows, filters = np.arange(len(idx))[:, None], np.arange(FILTERS)[None, :]
            da[rows, LEFT + inner.argmax(1), filters] += dp[:, :FILTERS]
            da[:, LEFT : LEFT + inner.shape[1]] += dp[:, None, FILTERS : 2 * FILTERS] / inner.shape[1]
            place = outer.argmax(1)
            da[rows, np.where(place < LEFT, place, place + HEAD + TAIL), filters] += dp[:, 2 * FILTERS : 3 * FILTERS]
            da *= act > 0
            grads = {
                "conv": cols.reshape(-1, cols.shape[2]).T @ da.reshape(-1, FILTERS), "conv_bias": da.sum((0, 1)),
                "dense": pooled.T @ dz, "dense_bias": dz.sum(0), "out": h.T @ d, "out_bias": d.sum(),
            }
            for n, g in grads.items():
                m, v = state[n]
                value = getattr(model, n)
                m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
                state[n] = [m, v]
                new = value - rate * ((m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) + 1e-3 * value)
                setattr(model, n, new.astype(np.float32) if n in ("conv", "conv_bias") else new)
    model.scale = _platt(model.raw(x[cal]), y[cal])
    p = model.scores(x[cal])

    def threshold(mask: np.ndarray) -> float:
        """The highest score that MIN_RECALL of the positives reach."""
        good = np.sort(p[mask & (y[cal] == 1)])
        return float(good[int((1 - MIN_RECALL) * len(good))]) if len(good) >= 20 else 2.0

    every = threshold(np.ones(len(cal), bool))
    own_looks = [threshold(looks[cal] == k) for k in range(3)]
    model.thresholds = tuple(t if t <= 1 else every for t in own_looks)  # few of a look: the threshold of all
    return model


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic calibration of the raw scores with smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        w = p * (1 - p) + 1e-6
        g = np.array([((p - t) * z).sum() + 1e-3 * (a - 1), (p - t).sum()])
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        da, db = np.linalg.solve(h, g)
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    return float(a), float(b)


def labelled(texts: list[str], seed: int = 5) -> list[tuple[str, int, int, int]]:
    """Findings of a sample by the patterns: values of base spans are secrets, other candidates aren't.

    Each secret comes twice: in place, and moved behind words that name no key, so that the network
    learns the token and not only its key name. MADE made keys of every pattern's form are added, so
    that no kind lacks examples, and benign tokens that resemble keys.
    """
    rnd = random.Random(seed)
    good, bad = [], []
    for text in texts:
        base = base_spans(text)
        for s, e in candidates(text):
            if any(b <= s and e <= f or s <= b and f <= e for _, b, f in base):
                good.append((text[max(0, s - 40) : e + 40], min(s, 40), min(s, 40) + e - s, 1))
                at = rnd.randrange(len(text))
                left = re.sub(r"\S*[=:\"]\S*", "", text[max(0, at - 30) : at]) + " "
                good.append((left + text[s:e] + " " + text[at : at + 20], len(left), len(left) + e - s, 1))
            elif not any(s < f and b < e for _, b, f in base):
                bad.append((text[max(0, s - 40) : e + 40], min(s, 40), min(s, 40) + e - s, 0))
    rnd.shuffle(good)
    rnd.shuffle(bad)
    word = lambda: "".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(3, 9)))
    made = [
        lambda: f"{word()}-{word()}-{rnd.randint(1, 99)}", lambda: f"{word()}_{rnd.randint(1, 9999)}.{rnd.choice(['html', 'jpg', 'txt'])}",
        lambda: f"{rnd.randint(1900, 2030)}-{rnd.randint(1, 12):02}-{rnd.randint(1, 28):02}", lambda: f"/{word()}/{word()}/{rnd.randint(1, 999)}",
        lambda: str(rnd.randint(10**8, 10**16)), lambda: f"{word()}{rnd.randint(1, 99)}.{word()}.com", lambda: f"v{rnd.randint(1, 9)}.{rnd.randint(0, 20)}.{rnd.randint(0, 20)}-{word()}",
        lambda: f"{word().upper()}-{rnd.randint(100, 9999)}", lambda: f"{word()}={rnd.randint(1, 10**6)}", lambda: f"{word().title()}{word().title()}{rnd.randint(1, 99)}",
        lambda: f"{word()}{word().title()}{word().title()}", lambda: "/".join(word() for _ in range(rnd.randint(3, 6))), lambda: rnd.choice("-_.").join(word() for _ in range(rnd.randint(3, 5))),
        lambda: word() + word() + word() + word(),
    ]
    draw = lambda chars, n: "".join(rnd.choice(chars) for _ in range(n))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    mixed = letters + "0123456789"
    keys = [
        lambda: "AKIA" + draw("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16), lambda: draw("0123456789abcdef", rnd.choice([16, 18, 32, 40, 64])),
        lambda: draw(mixed, rnd.randint(18, 44)), lambda: draw(letters, rnd.randint(20, 40)), lambda: draw(mixed + "+/", rnd.randint(28, 60)) + "=",
        lambda: f"{draw('abcdefghijklmnop', 3)}_{draw(mixed, rnd.randint(20, 40))}",
        lambda: f"{rnd.choice(['password', 'passwd', 'secret', 'token', 'apikey'])}={draw(mixed, rnd.randint(10, 30))}",
    ]
    good = good[: FINDINGS - MADE]
    for _ in range(MADE if texts else 0):
        t, left = rnd.choice(keys)(), " ".join(word() for _ in range(4)) + " "
        if candidates(t) == [(0, len(t))]:
            good.append((f"{left}{t} {word()}", len(left), len(left) + len(t), 1))
    for _ in range(min(FINDINGS // 2, len(good))):
        t, left = rnd.choice(made)(), " ".join(word() for _ in range(4)) + " "
        bad.append((f"{left}{t} {word()}", len(left), len(left) + len(t), 0))
    return good[:FINDINGS] + bad[-FINDINGS:]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the first SAMPLE documents, by hash, that hold digits in a row, a digit before a hex letter, or a capital behind a small letter."""
    some = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where(F.length("t") <= SAMPLE_CHARS)
    some = hash_sample(some.where(F.col("t").rlike(r"[0-9]{2}|[0-9][a-f]|[a-z][A-Z]")), SAMPLE, "i", "t")
    return fit(labelled(list(dict.fromkeys(r.t for r in some.collect()))))


def _span_type() -> pa.DataType:
    return pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def find(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep`, base and spans array<struct<kind,start,end,score>> in code points, in one pass.

    Added spans have the kind "learned" and their calibrated score; base spans score 1. Defined cases:
    null text is empty; every text is read whole; repeated rows stay repeated; null ids are kept;
    empty tables give empty results; other columns aren't looked at.
    """
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    span = "array<struct<kind:string,start:int,end:int,score:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = (*KINDS, LEARNED)
        for b in slices(batches):
            base, every = [], []
            waiting: list[tuple[int, int, int, int, np.ndarray]] = []
            top: dict[tuple[int, int, int], float] = {}

            def judge() -> None:
                """Score what waits, a bounded number of windows at a time; a candidate's best one counts."""
                p = model.scores(np.stack([w[4] for w in waiting]))
                for (row, s, e, kind, _), score in zip(waiting, p):
                    if score >= model.thresholds[kind]:
                        top[row, s, e] = max(float(score), top.get((row, s, e), 0.0))
                waiting.clear()

            for row, text in enumerate(b.column(0).to_pylist()):
                text = text or ""
                found = base_spans(text)
                base.append([{"kind": k, "start": s, "end": e, "score": 1.0} for k, s, e in found])
                every.append(list(base[-1]))
                at = 0
                for s, e in candidates(text):
                    while at < len(found) and found[at][2] <= s:
                        at += 1
                    if not any(b < e and s < f for _, b, f in found[max(0, at - 3) : at + 4]):
                        for kind, w in windows(text, s, e):
                            waiting.append((row, s, e, kind, w))
                            if len(waiting) >= 512:
                                judge()
            if waiting:
                judge()
            for (row, s, e), score in top.items():
                every[row].append({"kind": LEARNED, "start": s, "end": e, "score": score})
            for spans in every:
                spans.sort(key=lambda x: (x["start"], order.index(x["kind"])))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(base, _span_type()), pa.array(every, _span_type())], [*keep, "base", "spans"])

    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(run, f"{kinds}base {span}, spans {span}")
