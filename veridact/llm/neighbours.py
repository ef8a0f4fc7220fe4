"""Approximate nearest neighbours by cosine: a hash-prefix forest in every segment of the index.

Different vectors are dealt by hash into segments of about SEGMENT rows. A segment holds TREES
sorted arrays of 64-bit strings, each bit the side of a random hyperplane. A query descends every
array to its longest matching prefixes and ascends all of them level by level, so that more
candidates come in, and stops once a neighbour as near as the k-th found would, with a certain probability,
share a prefix of that length in some tree: sharp neighbourhoods stop deep, vectors without structure higher up.
That probability is set for each segment by the recall of PROBES of its own rows, which are also looked up by brute force.
Candidates are scored exactly, in double precision. Equal vectors are one entry with its smallest ids, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

TREES, BITS = 96, 64
SEGMENT, BLOCK = 16_384, 32_768
#: Prefix lengths that an ascent stops at, longest first; the roots hold all rows.
LEVELS = (64, 48, 40, 32, 28, *range(24, -1, -1))
#: Rows of a segment by which its stopping probability is set (a bounded sample), the recall that they must reach, and the probabilities tried.
PROBES, RECALL = 128, 0.95
TARGETS = (0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995, 0.999)
#: Queries whose prefix ranges are held at a time.
ASKED = 256


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows over their norms, in double precision, without overflow."""
    big = np.abs(rows).max(1, keepdims=True)
    rows = np.where((big > 1e150) | (big < 1e-150), rows / big, rows)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


class Forest:
    def __init__(self, vectors: np.ndarray, trees: int = TREES, seed: int = 1):
        self.vectors = unit(vectors)
        rng = np.random.default_rng(seed)
        self.planes = [rng.normal(size=(vectors.shape[1], BITS)) for _ in range(trees)]
        self.order, self.codes = [], []
        for p in self.planes:
            code = self.code(self.vectors, p)
            order = np.argsort(code, kind="stable")
            self.order.append(order)
            self.codes.append(code[order])
        self.target: float | None = None
        self.looked: list[int] = []  # candidates of each query

    @staticmethod
    def code(rows: np.ndarray, planes: np.ndarray) -> np.ndarray:
        return np.packbits(rows @ planes > 0, axis=1).view(">u8").ravel().astype(np.uint64)

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last places (levels, trees, queries) of the strings that share each length of prefix with the query's."""
        low = np.empty((len(LEVELS), len(self.planes), len(queries)), np.int32)
        high = np.empty_like(low)
        for t, (p, own) in enumerate(zip(self.planes, self.codes)):
            code = self.code(queries, p)
            for i, level in enumerate(LEVELS):
                rest = np.uint64((1 << (BITS - level)) - 1)
                first = code & ~rest
                low[i, t], high[i, t] = np.searchsorted(own, first), np.searchsorted(own, first | rest, side="right")
        return low, high

    def ascents(self, queries: np.ndarray, k: int) -> Iterator[Iterator[tuple[float, np.ndarray, np.ndarray]]]:
        """For each query its ascent: (probability that a row as near as the k-th shares the prefix in some tree, rows, cosines), until all rows are in."""
        for at in range(0, len(queries), ASKED):
            part = queries[at : at + ASKED]
            low, high = self.ranges(part)
            many = (high - low).sum(1)
            for j, q in enumerate(part):
                yield self.ascent(q, low[:, :, j], high[:, :, j], many[:, j], k)

    def ascent(self, q: np.ndarray, low: np.ndarray, high: np.ndarray, many: np.ndarray, k: int) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        n, had = len(self.vectors), 0
        for i, level in enumerate(LEVELS):
            if level and many[i] < max(k, 1.3 * had):
                continue
            had = int(many[i])
            inside = np.zeros(n, bool)
            for order, x, y in zip(self.order, low[i].tolist(), high[i].tolist()):
                inside[order[x:y]] = True
            rows = np.flatnonzero(inside)
            if len(rows) < min(k, n):
                continue
            scores = self.vectors[rows] @ q
            if level == 0 or len(rows) == n:
                yield 1.0, rows, scores
                return
            worst = np.partition(scores, len(rows) - k)[len(rows) - k]
            same = 1 - np.arccos(np.clip(worst, -1, 1)) / np.pi
            yield 1 - (1 - same**level) ** len(self.planes), rows, scores

    def calibrate(self, k: int) -> float:
        """The least of TARGETS at which PROBES of the rows find RECALL of their k nearest, themselves among them."""
        rng = np.random.default_rng(7)
        n = len(self.vectors)
        probes = self.vectors[np.sort(rng.choice(n, min(PROBES, n), replace=False))]
        hits, wanted = np.zeros(len(TARGETS)), 0
        for q, steps in zip(probes, self.ascents(probes, k)):
            near = set(self.top(np.arange(n), self.vectors @ q, k)[0].tolist())
            wanted += len(near)
            done = 0
            for chance, rows, _ in steps:
                own = len(near.intersection(rows.tolist()))
                while done < len(TARGETS) and chance >= TARGETS[done]:
                    hits[done] += own
                    done += 1
                if done == len(TARGETS):
                    break
        good = np.flatnonzero(hits >= RECALL * wanted)
        return TARGETS[good[0]] if len(good) else 1.0

    def search(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(row indexes, cosines) of the k best found for each query, and all ties with the last."""
        if self.target is None:
            self.target = self.calibrate(k)
        queries = unit(queries)
        found = []
        for steps in self.ascents(queries, k):
            for chance, rows, scores in steps:
                if chance >= self.target:
                    break
            found.append(self.top(rows, scores, k))
            self.looked.append(len(rows))
        return found

    @staticmethod
    def top(rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(rows) > k:
            # matrix products of different shapes differ in the last bits
            keep = scores >= np.partition(scores, len(rows) - k)[len(rows) - k] - 1e-12
            rows, scores = rows[keep], scores[keep]
        return rows, scores


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """The measure itself, on original vectors, the same for a pair wherever it is met."""
    x, y = unit(a[None]), unit(b[None])
    return float(np.clip((x * y).sum(), -1.0, 1.0))


def usable(vec: F.Column) -> F.Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def nearest(rows: DataFrame, queries: F.Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """(query_id, rank int, vec_id, score double): up to k nearest found of each row that fits `queries`.

    Candidates are all rows but the query's own; ties go to the smaller id. Defined cases: vectors
    that are null, empty, zero or hold null or non-finite components, and null ids, take no part;
    vectors of different lengths aren't compared; rows equal in id and vector are one; fewer
    candidates than k give fewer rows; an empty table gives an empty result.
    """
    plain = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks"))
    plain = plain.where(F.col("id").isNotNull() & usable(F.col("vec"))).dropDuplicates(["id", "vec"])
    # a class of equal vectors keeps its k + 1 smallest ids: one of them may be the query's own
    first = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = plain.withColumn("_r", first).where(F.col("_r") <= k + 1)
    classes = materialize(few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.element_at("ids", 1).alias("class"), "vec", "ids"))
    asked = materialize(plain.where("asks").join(classes.select("vec", "class"), "vec").select(F.col("id").alias("query_id"), "class", "vec"))
    questions = materialize(asked.select("class", "vec").dropDuplicates(["class", "vec"]))
    segments = max(1, -(-classes.count() // segment))
    blocks = max(1, -(-questions.count() // block))

    def spread(n: int, name: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    def hashed(n: int, seed: str) -> F.Column:
        return F.pmod(F.xxhash64("vec", F.lit(seed)), F.lit(n)).cast("int")

    left = classes.select(hashed(segments, "s").alias("s"), F.size("vec").alias("d"), "class", "vec", "ids", spread(blocks, "b"))
    right = questions.select(hashed(blocks, "b").alias("b"), F.size("vec").alias("d"), "class", "vec", spread(segments, "s"))

    def search(index: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"class": [], "vec_id": [], "score": []}
        if len(index) and len(ask):
            vectors, wanted = np.stack(index["vec"].to_list()), np.stack(ask["vec"].to_list())
            for c, q, (at, _) in zip(ask["class"], wanted, Forest(vectors).search(wanted, k + 1)):
                best = sorted((-cosine(q, vectors[i]), v) for i in at.tolist() for v in index["ids"].iat[i].tolist())[: k + 1]
                out["class"] += [c] * len(best)
                out["vec_id"] += [v for _, v in best]
                out["score"] += [-s for s, _ in best]
        return pd.DataFrame(out)

    key = ["s", "b", "d"]
    parts = left.groupBy(key).cogroup(right.groupBy(key)).applyInPandas(search, "class long, vec_id long, score double")
    order = [F.desc("score"), F.asc("vec_id")]
    best = parts.withColumn("_r", F.row_number().over(Window.partitionBy("class").orderBy(*order))).where(F.col("_r") <= k + 1)
    answers = materialize(best.groupBy("class").agg(F.collect_list(F.struct("vec_id", "score")).alias("found")))
    rows = asked.select("query_id", "class").join(answers, "class").select("query_id", F.explode("found").alias("f")).select("query_id", "f.vec_id", "f.score").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return rows.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
