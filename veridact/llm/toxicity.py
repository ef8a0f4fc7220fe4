"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Two states (clean, toxic) over the words of a text; features are the word and its prefixes. The
tokens' labels are drawn from labelled documents: in a toxic document a word counts as toxic if it
or one of its prefixes is strongly associated with the toxic label. Forward-backward marginals of
the cue words (words with a learnt feature) aggregate to a document score, calibrated by logistic
regression on documents the field was not fitted on and weighted to the labels' true rates.

All other words have one and the same potential, so a run of them is a power of one 2 x 2 matrix:
forward and backward passes cover the whole text exactly but step only over cue words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, slices

#: Bounds of the sample that the field is fitted on: documents of each label, characters of one.
SAMPLE, SAMPLE_CHARS = 3000, 60_000
WINDOW = 32
#: A feature is learnt if it stands in so many different toxic texts.
MIN_TEXTS = 4
PREFIXES = (4, 5, 6)
CACHE = 200_000
TOKEN = re.compile(r"[^\W\d_]+")


def held_out(doc_id) -> F.Column:
    """The fold that labels are never learnt from; null ids aren't in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def keys(word: str) -> list[str]:
    """Features of a word: itself (marked by =) and its prefixes."""
    w = word.lower()
    return ["=" + w, *(w[:n] for n in PREFIXES if len(w) >= n)]


class Potentials(dict):
    """Words' log potentials, None for the background's; a cache of bounded size."""

    def __init__(self, model: Model):
        self.weights, self.bias = model.weights, model.bias

    def __missing__(self, word: str) -> float | None:
        if len(self) >= CACHE:
            self.clear()
        found = [self.weights[k] for k in keys(word) if k in self.weights]
        self[word] = e = self.bias + sum(found) if found else None
        return e


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    trans: np.ndarray  # log potentials, clean and toxic
    doc: np.ndarray  # calibrated weights of the document features


def features(p: np.ndarray, n_words: int) -> np.ndarray:
    """Document features of the cue words' marginals."""
    if not len(p):
        return np.array([1.0, 0.0, 0.0, 0.0])
    return np.array([1.0, p.max(), np.log1p(p.sum()), 100 * min(0.05, p.sum() / max(n_words, 1))])


class Tagger:
    """Applies a model to texts; holds a bounded cache of words' potentials."""

    def __init__(self, model: Model):
        self.model, self.cache = model, Potentials(model)
        a = np.exp(model.trans)
        step = a @ np.diag([1.0, np.exp(model.bias)])
        values, right = np.linalg.eig(step)
        order = np.argsort(-values.real)
        values, right = values.real[order], right.real[:, order]
        left = np.linalg.inv(right)
        self.p1, self.p2 = np.outer(right[:, 0], left[0]), np.outer(right[:, 1], left[1])
        self.rho, self.a = values[1] / values[0], a

    def gap(self, n: int) -> np.ndarray:
        """The n-th power of the background step, up to scale."""
        return self.p1 + self.rho**n * self.p2

    def marginals(self, text: str) -> tuple[int, list[int], np.ndarray]:
        """Number of words, indexes of the cue words and their marginals of the toxic state."""
        words = TOKEN.findall(text)
        es = list(map(self.cache.__getitem__, words))
        at = [i for i, e in enumerate(es) if e is not None]
        if not at:
            return len(words), at, np.empty(0)
        n, k = len(words), len(at)
        emit = [np.array([1.0, np.exp(min(es[i], 50.0))]) for i in at]
        forward, state, last = [], np.array([1.0, 0.0]), -1
        for i, e in zip(at, emit):
            if i - last > 1:
                state = state @ self.gap(i - last - 1)
            state = (state @ self.a) * e
            state = state / state.sum()
            forward.append(state)
            last = i
        back = self.gap(n - 1 - at[-1]) @ np.ones(2) if n - 1 > at[-1] else np.ones(2)
        out = np.empty(k)
        for j in range(k - 1, -1, -1):
            both = forward[j] * back
            out[j] = both[1] / both.sum()
            if j:
                back = self.a @ (emit[j] * back)
                g = at[j] - at[j - 1] - 1
                if g:
                    back = self.gap(g) @ back
                back = back / back.sum()
        return n, at, np.clip(out, 0.0, 1.0)

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Score and offending offsets (code points, end exclusive) with their marginals."""
        text = text or ""
        n, at, p = self.marginals(text)
        z = float(features(p, n) @ self.model.doc)
        spans = []
        if len(p) and p.max() >= 0.5:
            bad = {i: float(x) for i, x in zip(at, p) if x >= 0.5}
            spans = [(m.start(), m.end(), bad[i]) for i, m in enumerate(TOKEN.finditer(text)) if i in bad]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), spans


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[list[tuple[str, int]], float]:
    """The bounded sample (text, label) outside the held-out fold, and the toxic rate of all its labels.

    A document labelled twice is toxic if any row says so; rows without a 0/1 label don't count.
    The sample is the first SAMPLE ids of each label by hash, so it is the same on every run.
    """
    marks = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    rate = marks.agg(F.avg("toxic")).first()[0]
    picks = None
    for y in (0, 1):
        some = hash_sample(marks.where(F.col("toxic") == y), SAMPLE, "doc_id")
        picks = some if picks is None else picks.union(some)
    picks = picks.select(F.col("doc_id").alias("_pick"), F.col("toxic").alias("_toxic"))
    found = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .where(F.col("_text").isNotNull() & (F.length("_text") <= SAMPLE_CHARS))
        .join(F.broadcast(picks), F.col("_id") == F.col("_pick"))  # at most 2 * SAMPLE rows
        .select("_id", "_text", "_toxic")
        .orderBy(F.xxhash64("_id"), "_id", "_text").limit(3 * SAMPLE)
    )
    rows = [(r._text, r._toxic) for r in found.collect()]
    return rows, float(rate) if rate is not None else 0.0


def fit(rows: list[tuple[str, int]], rate: float, iterations: int = 60) -> Model:
    """Fit the field on two thirds of the rows and the document score on the rest.

    Without rows of both labels the model has no cues and scores every text with the labels' rate.
    """
    prior = float(np.log(max(rate, 1e-3) / max(1 - rate, 1e-3)))
    blank = Model({}, -4.0, np.zeros((2, 2)), np.array([prior, 0.0, 0.0, 0.0]))
    rows = list(dict.fromkeys(rows))  # copies of a text are one example
    first = [r for i, r in enumerate(rows) if i % 3]
    second = [r for i, r in enumerate(rows) if not i % 3]
    if not all(any(y == k for _, y in part) for part in (first, second) for k in (0, 1)):
        return blank
    df = [Counter(), Counter()]
    n = [0, 0]
    for text, y in first:
        n[y] += 1
        df[y].update({k for w in set(TOKEN.findall(text)) for k in keys(w)})
    odds = {
        k: np.log((c + 0.5) / (n[1] + 1)) - np.log((df[0][k] + 0.5) / (n[0] + 1))
        for k, c in df[1].items() if c >= MIN_TEXTS
    }
    cues = {k: i + 1 for i, k in enumerate(sorted(k for k, v in odds.items() if v >= 2.0))}
    if not cues:
        return blank
    strong = {k for k in cues if odds[k] >= 2.5}
    x, y, mask = _windows(first, cues, strong)
    w, bias, trans = _train(x, y, mask, len(cues) + 1, iterations)
    model = Model({k: float(w[i]) for k, i in cues.items() if abs(w[i]) > 1e-3}, bias, trans, blank.doc)
    tagger = Tagger(model)
    d, t = [], []
    for text, label in second:
        count, _, p = tagger.marginals(text)
        d.append(features(p, count))
        t.append(label)
    model.doc = _logistic(np.array(d), np.array(t, float), rate)
    return model


def _windows(rows, cues, strong):
    """Windows of WINDOW words: those with a cue, and each text's first; x: feature ids, y: states."""
    wide = 1 + len(PREFIXES)
    xs, ys, lens = [], [], []
    for text, label in rows:
        words = TOKEN.findall(text)
        for at in range(0, max(len(words), 1), WINDOW):
            part = [keys(w) for w in words[at : at + WINDOW]]
            ids = [[cues.get(k, 0) for k in ks] for ks in part]
            if part and (at == 0 or any(map(any, ids))):
                x = np.zeros((WINDOW, wide), np.int32)
                yy = np.zeros(WINDOW, np.int8)
                for i, (f, ks) in enumerate(zip(ids, part)):
                    x[i, : len(f)] = f
                    yy[i] = label and any(k in strong for k in ks)
                xs.append(x)
                ys.append(yy)
                lens.append(len(part))
    mask = np.arange(WINDOW)[None, :] < np.array(lens)[:, None]
    return np.array(xs), np.array(ys), mask


def _train(x, y, mask, n_features, iterations):
    """Adam on the regularised conditional log-likelihood; exact forward-backward over all windows."""
    params = np.zeros(n_features + 5)
    params[n_features] = -2.0
    m1, m2 = np.zeros_like(params), np.zeros_like(params)
    rows = len(x)
    y1 = y.astype(float)
    for it in range(1, iterations + 1):
        w, b, a = params[:n_features].copy(), params[n_features], params[n_features + 1 :].reshape(2, 2)
        w[0] = 0
        e = np.clip(w[x].sum(2) + b, -30, 30)
        pot = np.stack([np.ones_like(e), np.exp(e)], 2)
        ea = np.exp(a)
        alpha = np.empty((rows, WINDOW, 2))
        state = pot[:, 0] * ea[0]
        alpha[:, 0] = state / state.sum(1, keepdims=True)
        for t in range(1, WINDOW):
            state = (alpha[:, t - 1] @ ea) * pot[:, t]
            state /= state.sum(1, keepdims=True)
            alpha[:, t] = np.where(mask[:, t, None], state, alpha[:, t - 1])
        beta = np.ones((rows, 2))
        p = np.zeros((rows, WINDOW))
        pair = np.zeros((2, 2))
        seen = np.zeros((2, 2))
        for t in range(WINDOW - 1, -1, -1):
            both = alpha[:, t] * beta
            p[:, t] = both[:, 1] / both.sum(1)
            if t:
                on = mask[:, t]
                nxt = pot[:, t] * beta
                joint = alpha[:, t - 1, :, None] * ea[None] * nxt[:, None, :]
                joint /= joint.sum((1, 2), keepdims=True)
                pair += joint[on].sum(0)
                np.add.at(seen, (y[on, t - 1], y[on, t]), 1)
                nb = nxt @ ea.T
                beta = np.where(on[:, None], nb / nb.sum(1, keepdims=True), beta)
            else:
                pair[0] += np.stack([1 - p[:, 0], p[:, 0]], 1).sum(0)
                np.add.at(seen, (np.zeros(rows, int), y[:, 0]), 1)
        miss = np.where(mask, y1 - p, 0.0)
        g = np.zeros_like(params)
        g[:n_features] = np.bincount(x.ravel(), np.repeat(miss.ravel(), x.shape[2]), n_features)
        g[0] = 0
        g[n_features] = miss.sum()
        g[n_features + 1 :] = (seen - pair).ravel()
        g = g / rows - 1e-4 * params
        m1 = 0.9 * m1 + 0.1 * g
        m2 = 0.99 * m2 + 0.01 * g * g
        params += 0.2 * (m1 / (1 - 0.9**it)) / (np.sqrt(m2 / (1 - 0.99**it)) + 1e-8)
    params[0] = 0
    return params[:n_features], float(params[n_features]), params[n_features + 1 :].reshape(2, 2)


def _logistic(d, t, rate):
    """Newton steps; rows are weighted so that the labels have their true rate."""
    share = t.mean()
    weight = np.where(t == 1, rate / share, (1 - rate) / (1 - share))
    w = np.zeros(d.shape[1])
    ridge = np.full(d.shape[1], 0.5)
    ridge[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        h = (d * (weight * p * (1 - p))[:, None]).T @ d + np.diag(ridge)
        w += np.clip(np.linalg.solve(h, d.T @ (weight * (t - p)) - ridge * w), -3, 3)
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    rows, rate = labelled(docs, labels, id_col, text_col)
    return fit(rows, rate)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep`, score double and spans array<struct<start,end,p>>, in one pass without a shuffle.

    Defined cases: null text scores as the empty one; empty and very long texts are scored whole;
    repeated rows stay repeated; null ids are kept; an empty table gives an empty result; other
    columns, whatever their names, aren't looked at.
    """
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"{kinds}{', ' if keep else ''}score double, spans array<struct<start:int,end:int,p:double>>"
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for b in slices(batches):
            found = [tagger.score(t) for t in b.column(0).to_pylist()]
            spans = [[{"start": s, "end": e, "p": p} for s, e, p in x] for _, x in found]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array([float(s) for s, _ in found], pa.float64()), pa.array(spans, spans_type)],
                [*keep, "score", "spans"],
            )

    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(run, schema)
