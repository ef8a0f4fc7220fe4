"""Personal data by a semi-Markov conditional random field on top of exact patterns.

Patterns give the base spans. Around digits and @ signs a text is cut into atoms (alphanumeric runs
and single marks); a segmentation of such a region consists of one-atom outside segments and of
entities of at most MAX_ATOMS atoms. Features look at the whole candidate span; dynamic programming
over the bounded entities chooses boundaries and types jointly. Entities of the best segmentation
with a high enough marginal, and clear of the base spans, are added to these.
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

KINDS = ("email", "ip", "card", "phone")
#: Bounds of the training sample: documents with a digit or @ sign, characters of one, regions.
SAMPLE, SAMPLE_CHARS, REGIONS = 1500, 60_000, 1500
MAX_ATOMS = 18
MIN_MARGINAL = 0.9

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# no match can start inside a run of digits that failed from its first digit
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CUE = re.compile(r"[0-9@]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        # a run of local characters before @ is looked at once: @ isn't one of them
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern matches by start, then kind as listed; linear in the text."""
    found = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if _CUE.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = only_digits(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(only_digits(m.group())) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


# a region from its first digit or @ sign on: chunks that hold one, single spaces between them
_REGION = re.compile(r"[0-9@][^\s]*(?:\x20[^\s0-9@]{0,8}[0-9@][^\s]*)*")
#: What comes before, in the same chunk; a longer run of letters at its start stays whole.
_AHEAD, _LETTERS = re.compile(r"[^\s0-9@]{0,64}\Z"), re.compile(r"[A-Za-z]{2}")
_NUMBERS = re.compile(r"[0-9]+")
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|\x20|[^A-Za-z0-9\x20]")


def regions(text: str) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(start, atom spans) of every region with 6 digits, 4 groups of digits or an @ sign; others hold no entity.

    Regions of any length are walked whole; the work is linear as entities are bounded. A chunk with
    much text before its first digit or @ sign is a region from 64 characters before that on.
    """
    for m in _REGION.finditer(text):
        part = m.group()
        if "@" in part or len(only_digits(part)) >= 6 or len(_NUMBERS.findall(part)) >= 4:
            start = m.start() - len(_AHEAD.search(text[max(0, m.start() - 64) : m.start()]).group())
            while start and _LETTERS.fullmatch(text, start - 1, start + 1):
                start -= 1
            yield start, [a.span() for a in _ATOM.finditer(text, start, m.end())]


def span_features(text: str, start: int, end: int) -> list[str]:
    """Features of a whole candidate span."""
    span = text[start:end]
    digits = only_digits(span)
    groups = re.findall(r"[0-9]+", span)
    letters = sum(c.isalpha() for c in span)
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[A-Za-z]+", "a", span))
    before, after = text[start - 1 : start], text[end : end + 1]
    word = re.search(r"([^\W\d_]+)[\W_]*\Z", text[max(0, start - 24) : start])
    return [
        "shape=" + shape,
        f"digits={min(len(digits), 20)}",
        f"groups={min(len(groups), 8)}/{letters > 0}",
        f"sizes={'.'.join(str(min(len(g), 9)) for g in groups[:6])}",
        f"luhn={12 <= len(digits) <= 19 and luhn(digits)}/{letters > 0}",
        f"quad={len(groups) == 4 and letters == 0 and all(len(g) <= 3 and int(g) <= 255 for g in groups)}/{span.count('.')}",
        f"plus={span[:1] == '+'}/{9 <= len(digits) <= 15}",
        f"at={span.count('@')}/{span[-1:].isalnum()}/{'.' in span.partition('@')[2]}",
        f"edges={span[:1].isalnum()}/{span[-1:].isalnum()}",
        f"cut={(before.isalnum() and span[:1].isalnum())}/{(after.isalnum() and span[-1:].isalnum())}",
        f"mark={'d' if before.isdigit() else before if before in '.+-@(#' else 'o'}",
        f"next={'d' if after.isdigit() else after if after in '-@)' else 'o'}",
        "word=" + (word[1].lower() if word else ""),
        "bias",
    ]


@dataclass
class Model:
    ids: dict[str, int]
    weights: np.ndarray  # (features + 1, kinds); the last row is zero, for unknown features


def segments(text: str, atoms: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Atom ranges (i, j) that may be entities: no spaces at the ends, MAX_ATOMS atoms at most."""
    out = []
    for i in range(len(atoms)):
        if text[atoms[i][0]] == " ":
            continue
        cued = False
        for j in range(i, min(len(atoms), i + MAX_ATOMS)):
            cued |= bool(_CUE.search(text, *atoms[j]))
            if cued and text[atoms[j][0]] != " " and j > i - 1:
                out.append((i, j + 1))
    return out


def potentials(model: Model, text: str, atoms: list, cands: list) -> np.ndarray:
    unknown = len(model.weights) - 1
    get = model.ids.get
    out = np.empty((len(cands), len(KINDS)))
    for k, (i, j) in enumerate(cands):
        out[k] = model.weights[[get(f, unknown) for f in span_features(text, atoms[i][0], atoms[j - 1][1])]].sum(0)
    return out


def _forward(n: int, cands: list, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log sums over the segmentations of the first i atoms, and of the atoms from i on."""
    total = np.logaddexp.reduce(scores, axis=1)
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    starting: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (i, j) in enumerate(cands):
        ending[j].append(k)
        starting[i].append(k)
    ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[cands[k][0]] + total[k] for k in ending[j])])
    for i in range(n - 1, -1, -1):
        behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[cands[k][1]] + total[k] for k in starting[i])])
    return ahead, behind


def marginals(n: int, cands: list, scores: np.ndarray) -> np.ndarray:
    ahead, behind = _forward(n, cands, scores)
    i, j = np.array(cands, dtype=int).reshape(-1, 2).T
    return np.exp(np.clip(ahead[i][:, None] + scores + behind[j][:, None] - ahead[n], -700, 0))


def best(n: int, cands: list, scores: np.ndarray) -> list[tuple[int, int]]:
    """(candidate, kind) of the best segmentation's entities."""
    top, kind = scores.max(1), scores.argmax(1)
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (_, j) in enumerate(cands):
        by_end[j].append(k)
    value, back = np.zeros(n + 1), [-1] * (n + 1)
    for j in range(1, n + 1):
        value[j] = value[j - 1]
        for k in by_end[j]:
            if value[cands[k][0]] + top[k] > value[j]:
                value[j], back[j] = value[cands[k][0]] + top[k], k
    out, j = [], n
    while j > 0:
        if back[j] < 0:
            j -= 1
        else:
            out.append((back[j], int(kind[back[j]])))
            j = cands[back[j]][0]
    return out[::-1]


def _variant(kind: str, span: str, rnd: random.Random) -> str:
    """Another way to write the same entity, for training beyond the patterns."""
    if kind == "phone":
        return rnd.choice([span.lstrip("+"), "00" + span[1:], re.sub(r"[()]", "", span), span.replace(" ", ".")])
    if kind == "card":
        d = only_digits(span)
        return rnd.choice([".".join(d[i : i + 4] for i in range(0, len(d), 4)), "/".join(d[i : i + 4] for i in range(0, len(d), 4)), span])
    if kind == "ip":
        return rnd.choice([span + ":" + str(rnd.randint(80, 9999)), span.replace(".", "[.]"), span])
    return rnd.choice([span.replace("@", "[@]"), span.replace("@", "(@)"), span])


def examples(texts: list[str], limit: int = REGIONS, seed: int = 7) -> list[tuple[str, list, list]]:
    """(text, atoms, gold [(i, j, kind)]) of regions; half of those with entities get a rewritten twin."""
    rnd = random.Random(seed)
    found = []

    def add(text: str, gold: list[tuple[str, int, int]]) -> None:
        for _, atoms in regions(text):
            starts, ends = {s: i for i, (s, _) in enumerate(atoms)}, {e: i + 1 for i, (_, e) in enumerate(atoms)}
            marks, last = [], 0
            for kind, s, e in gold:
                i, j = starts.get(s), ends.get(e)
                if i is not None and j is not None and last <= i < j <= i + MAX_ATOMS:
                    marks.append((i, j, KINDS.index(kind)))
                    last = j
            found.append((text, atoms, marks))

    for text in texts:
        gold = base_spans(text)
        add(text, gold)
        for kind, s, e in gold:
            if rnd.random() < 0.5:
                new = _variant(kind, text[s:e], rnd)
                left, right = text[max(0, s - 40) : s].lstrip("+"), text[e : e + 20]
                if kind == "phone" and left.endswith("+"):
                    continue
                at = len(left)
                add(left + new + right, [(kind, at, at + len(new))])
        if len(found) >= limit:
            break
    # plain numbers that are nobody's: years, prices, versions, counts
    for _ in range(limit // 5):
        noise = rnd.choice([f"{rnd.randint(10**6, 10**8)}", f"{rnd.randint(1900, 2030)}-{rnd.randint(1, 12):02}-{rnd.randint(1, 28):02}", f"v{rnd.randint(1, 30)}.{rnd.randint(0, 99)}.{rnd.randint(1000, 9999)}", f"{rnd.randint(1, 999)},{rnd.randint(0, 999):03},{rnd.randint(0, 999):03}", "%040x" % rnd.getrandbits(160), f"{rnd.randint(10**15, 10**16)}", f"user@{rnd.randint(1, 99)}", f"id={rnd.randint(10**9, 10**10)}"])
        if not base_spans(noise):
            add(f"the {noise} of", [])
    return found[: limit * 2]


def fit(texts: list[str], epochs: int = 12) -> Model:
    """Adagrad on the regularised conditional likelihood of the gold segmentations.

    Without examples every kind is ruled out and no span is added.
    """
    data = []
    ids: dict[str, int] = {}
    for text, atoms, gold in examples(texts):
        cands = segments(text, atoms)
        if not cands or len(atoms) > 80:  # a bound on training examples only
            continue
        rows = [[ids.setdefault(f, len(ids)) for f in span_features(text, atoms[i][0], atoms[j - 1][1])] for i, j in cands]
        truth = np.zeros((len(cands), len(KINDS)))
        where = {c: k for k, c in enumerate(cands)}
        for i, j, kind in gold:
            if (i, j) in where:
                truth[where[i, j], kind] = 1
        data.append((len(atoms), cands, np.array(rows), truth))
    weights = np.zeros((len(ids) + 1, len(KINDS)))
    if not data:
        return Model({"bias": 0}, np.array([[-20.0] * len(KINDS), [0.0] * len(KINDS)]))
    weights[ids["bias"]] = -3.0
    squares = np.full_like(weights, 1e-2)
    rnd = random.Random(5)
    for _ in range(epochs):
        rnd.shuffle(data)
        for n, cands, rows, truth in data:
            scores = weights[rows].sum(1)
            diff = truth - marginals(n, cands, scores)
            keep = np.abs(diff).max(1) > 1e-4
            if keep.any():
                g = np.zeros_like(weights)
                np.add.at(g, rows[keep].ravel(), np.repeat(diff[keep], rows.shape[1], axis=0))
                used = np.unique(rows[keep])
                g = g[used] - 1e-3 * weights[used]
                squares[used] += g * g
                weights[used] += 0.3 * g / np.sqrt(squares[used])
    weights[-1] = 0
    return Model(ids, weights)


def added_spans(model: Model, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Entities that the field finds clear of the base spans."""
    out = []
    taken = [(s, e) for _, s, e in base]
    for _, atoms in regions(text):
        cands = segments(text, atoms)
        if not cands:
            continue
        scores = potentials(model, text, atoms, cands)
        chosen = best(len(atoms), cands, scores)
        if not chosen:
            continue
        p = marginals(len(atoms), cands, scores)
        for k, kind in chosen:
            s, e = atoms[cands[k][0]][0], atoms[cands[k][1] - 1][1]
            if p[k, kind] >= MIN_MARGINAL and not any(s < b and a < e for a, b in taken):
                out.append((KINDS[kind], s, e))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the first SAMPLE documents, by hash, that hold three digits in a row or an @ sign."""
    some = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where(F.length("t") <= SAMPLE_CHARS)
    some = hash_sample(some.where(F.col("t").rlike(r"[0-9]{3}|@")), SAMPLE, "i", "t")
    return fit(list(dict.fromkeys(r.t for r in some.collect())))


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep`, base and spans array<struct<kind,start,end>> in code points, in one pass.

    Defined cases: null text is empty; every text is read whole, at linear cost; repeated rows stay
    repeated; null ids are kept; empty tables give empty results; other columns aren't looked at.
    """
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    span = "array<struct<kind:string,start:int,end:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cell(spans):
            return [{"kind": k, "start": s, "end": e} for k, s, e in spans]

        for b in slices(batches):
            base, every = [], []
            for text in b.column(0).to_pylist():
                found = base_spans(text or "")
                more = added_spans(model, text, found) if text and _CUE.search(text) else []
                base.append(cell(found))
                every.append(cell(sorted(found + more, key=lambda x: (x[1], KINDS.index(x[0])))))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(base, _SPAN), pa.array(every, _SPAN)], [*keep, "base", "spans"])

    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(run, f"{kinds}base {span}, spans {span}")


def digest(found: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """n_<kind> counts and base_sha256 of the base spans, and all spans as text."""

    def text(c: str) -> F.Column:
        return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> F.Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in kinds]
    rest = [c for c in found.columns if c not in ("base", "spans")]
    return found.select(*rest, *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with every span in text_col replaced by its kind in square brackets; the columns stay.

    Overlapping spans are replaced together, under the kind of the first. Null texts stay null.
    """
    order = docs.columns
    rest = [c for c in order if c != text_col]
    packed = docs.select(F.col(text_col).alias("_text"), F.struct(*rest).alias("_rest"))
    kind = packed.schema["_rest"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = []
            for text in b.column(0).to_pylist():
                if text and _CUE.search(text):
                    found = base_spans(text)
                    out, done = [], 0
                    for k, s, e in sorted(found + added_spans(model, text, found), key=lambda x: (x[1], KINDS.index(x[0]))):
                        if s >= done:
                            out += [text[done:s], f"[{k.upper()}]"]
                        done = max(done, e)
                    text = "".join([*out, text[done:]])
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), b.column(1)], ["_new", "_rest"])

    out = packed.mapInArrow(run, f"_new string, _rest {kind}")
    return out.select(*(F.col("_new").alias(c) if c == text_col else F.col(f"_rest.`{c}`") for c in order))
