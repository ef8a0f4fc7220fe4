"""Quality rules under weak supervision: rules vote or abstain, and their accuracies are estimated without labels.

Each rule looks at one measure of a text and says good, bad or nothing; most say bad or nothing, as a text
without, say, symbols isn't good for that. Expectation-maximisation over all documents estimates how
often each rule votes of good and of bad texts, and the posterior probability of good replaces the filter
that all rules must pass. EM sees documents only through how many cast which votes: at most 3 to
the number of rules, whatever the input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialize, slices

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended", "n_upper", "n_marks", "n_distinct", "n_stutter", "n_plain", "n_stops")
SYMBOLS = "#*$%&|<>"
ENDS = (".", "!", "?", "…", '"', "'", ":", "。", "！", "？")

_WORD = re.compile(WORD)


def repeated(ids: np.ndarray) -> int:
    """Words in windows of three that occur twice or more."""
    if len(ids) < 4:
        return 0
    # pairs are numbered before they are joined with the third word, so that no key overflows
    v = np.int64(ids.max()) + 1
    two = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1].astype(np.int64)
    key, many = np.unique(two[:-1] * v + ids[2:], return_inverse=True, return_counts=True)[1:]
    often = many[key] > 1
    if not often.any():
        return 0
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : len(ids) - 2 + k] |= often
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    """MEASURES of one text."""
    words = _WORD.findall(text)
    if not words:
        return (0, 0, sum(map(text.count, SYMBOLS)), *[0] * 10)
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated(ids), len(lines),
        sum(x.rstrip().endswith(ENDS) for x in lines), sum(map(str.isupper, words)), text.count("!") + text.count("?"), len(number), int((ids[1:] == ids[:-1]).sum()),
        sum([w.isalnum() or w[:-1].isalpha() for w in words]), sum([w[-1] in ".!?" and w[-2:-1].isalnum() for w in words]),
    )


def measures(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and MEASURES (long) of every row; null texts have none of anything."""
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [measure(t or "") for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *[pa.array(x, pa.int64()) for x in zip(*found)]], [*keep, *MEASURES])

    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(run, kinds + ", ".join(f"{m} long" for m in MEASURES))


@dataclass(frozen=True)
class Rule:
    """Votes by the ratio of two measures: bad and good are bounds (least, most) of it; says nothing elsewhere,
    and where the text has fewer than `least` of what it divides by."""

    name: str
    part: str
    whole: str | None = None
    good: tuple[float, float] | None = None
    bad: tuple[tuple[float, float], ...] = ()
    least: int = 1

    def vote(self) -> Column:
        """1 good, -1 bad, 0 nothing."""
        x = F.col(self.part) / F.nullif(self.whole, F.lit(0)) if self.whole else F.col(self.part).cast("double")
        inside = lambda b: (x >= b[0]) & (x <= b[1])
        vote = F.when(F.col(self.whole or "n_words") < self.least, 0).when(reduce(lambda a, b: a | b, map(inside, self.bad)), -1)
        return (vote.when(inside(self.good), 1) if self.good else vote).otherwise(0)


MOST = float("inf")
RULES = (
    Rule("prose", "n_plain", "n_words", (0.85, 1), ((0, 0.6),), 10),
    Rule("sentences", "n_stops", "n_words", (0.02, 0.34), ((0, 0.005),), 20),
    Rule("length", "n_words", None, None, ((1, 4), (200_000, MOST))),
    Rule("word_length", "word_chars", "n_words", None, ((0, 2.2), (16, MOST))),
    Rule("symbols", "n_symbols", "n_words", None, ((0.2, MOST),)),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, ((0.4, MOST),), 5),
    Rule("repeats", "n_repeat_words", "n_words", None, ((0.5, MOST),), 20),
    Rule("capitals", "n_upper", "n_words", None, ((0.5, MOST),), 10),
    Rule("endings", "n_ended", "n_lines", None, ((0, 0.15),), 3),
    Rule("marks", "n_marks", "n_words", None, ((0.3, MOST),), 10),
    Rule("variety", "n_distinct", "n_words", None, ((0, 0.12),), 100),
    Rule("stutter", "n_stutter", "n_words", None, ((0.2, MOST),), 10),
)


@dataclass(frozen=True)
class Model:
    """The share of good texts, and of each rule how often it says good of good and of bad texts, and bad of them."""

    good: float
    good_of_good: tuple[float, ...]
    good_of_bad: tuple[float, ...]
    bad_of_good: tuple[float, ...]
    bad_of_bad: tuple[float, ...]
    rounds: int = field(default=0, compare=False)

    def odds(self) -> tuple[float, list[float], list[float]]:
        """Log odds of good: of a text of which no rule says anything, and what each rule's good and bad vote adds."""
        logs = lambda a, b: np.log(np.divide(a, b))
        silent = logs(1 - np.add(self.good_of_good, self.bad_of_good), 1 - np.add(self.good_of_bad, self.bad_of_bad))
        good, bad = logs(self.good_of_good, self.good_of_bad) - silent, logs(self.bad_of_good, self.bad_of_bad) - silent
        return float(np.log(self.good / (1 - self.good)) + silent.sum()), good.tolist(), bad.tolist()


#: What weighs on the estimates as texts seen before: good and bad ones; those with a vote and without, of the
#: class that the vote is for and of the other.
TEXTS_BEFORE, FOR_BEFORE, AGAINST_BEFORE = (8.0, 2.0), (3.0, 9.0), (1.0, 49.0)
#: A vote is taken to be so many times likelier of the class that it is for, at least.
BETTER = 1.5


def fit(votes: np.ndarray, weight: np.ndarray, rounds: int = 500, close: float = 1e-7) -> Model:
    """EM over distinct vote patterns (rows of votes: 1, 0, -1) with their numbers of documents.

    Estimates are maximum-a-posteriori under priors as of texts seen before, so that an empty table keeps them.
    """
    said = np.concatenate([votes > 0, votes < 0], 1).astype(float)  # good votes of all rules, then bad votes
    n = votes.shape[1]
    for_good = np.arange(2 * n) < n

    def rates(texts: np.ndarray, cast: np.ndarray, own: np.ndarray) -> np.ndarray:
        with_vote, without = (np.where(own, a, b) for a, b in zip(FOR_BEFORE, AGAINST_BEFORE))
        return (cast + with_vote) / (texts + with_vote + without)

    def model(good: float, of_good: np.ndarray, of_bad: np.ndarray, k: int) -> Model:
        return Model(float(good), *(tuple(x.tolist()) for x in (of_good[:n], of_bad[:n], of_good[n:], of_bad[n:])), k)

    good, of_good, of_bad = TEXTS_BEFORE[0] / sum(TEXTS_BEFORE), rates(0, np.zeros(2 * n), for_good), rates(0, np.zeros(2 * n), ~for_good)
    for k in range(1, rounds + 1):
        before, by_good, by_bad = model(good, of_good, of_bad, k).odds()
        p = 1 / (1 + np.exp(-before - said @ np.array(by_good + by_bad)))
        is_good, is_bad = weight * p, weight * (1 - p)
        new_good = (is_good.sum() + TEXTS_BEFORE[0]) / (weight.sum() + sum(TEXTS_BEFORE))
        new_of_good, new_of_bad = rates(is_good.sum(), is_good @ said, for_good), rates(is_bad.sum(), is_bad @ said, ~for_good)
        # votes that look no better than chance keep the least that rules are trusted with
        new_of_bad = np.where(for_good, np.minimum(new_of_bad, new_of_good / BETTER), new_of_bad)
        new_of_good = np.where(for_good, new_of_good, np.minimum(new_of_good, new_of_bad / BETTER))
        moved = max(abs(new_good - good), np.abs(new_of_good - of_good).max(), np.abs(new_of_bad - of_bad).max())
        good, of_good, of_bad = new_good, new_of_good, new_of_bad
        if moved < close:
            break
    return model(good, of_good, of_bad, k)


def patterns(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(a column of votes for each rule, n): how many rows cast which votes; at most 3 to the number of rules."""
    return measured.groupBy(*[r.vote().cast("int").alias(r.name) for r in rules]).agg(F.count("*").alias("n"))


def train(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> Model:
    """The model of all rows with words."""
    found = patterns(measured.where("n_words > 0"), rules).toPandas().sort_values([r.name for r in rules])
    return fit(found[[r.name for r in rules]].to_numpy(np.int64).reshape(-1, len(rules)), found["n"].to_numpy(np.float64))


def probability(m: Model, rules: tuple[Rule, ...] = RULES) -> Column:
    """The posterior probability that a row of measures is good."""
    before, good, bad = m.odds()
    terms = [F.when(r.vote() > 0, g).when(r.vote() < 0, b).otherwise(0.0) for r, g, b in zip(rules, good, bad)]
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(before))))


def accuracies(measured: DataFrame, m: Model, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(rule, good_votes, bad_votes, right): a row a rule, with the votes it cast and the share of them that is right by the posterior."""
    p = probability(m, rules)
    count = lambda r, v: F.count(F.when(r.vote() == v, 1))
    right = lambda r: F.coalesce(F.sum(F.when(r.vote() > 0, p).when(r.vote() < 0, 1 - p)), F.lit(0.0)) / F.nullif(count(r, 1) + count(r, -1), F.lit(0))
    sums = measured.where("n_words > 0").agg(*[F.struct(F.lit(r.name).alias("rule"), count(r, 1).alias("good_votes"), count(r, -1).alias("bad_votes"), right(r).alias("right")).alias(r.name) for r in rules])
    return sums.select(F.explode(F.array(*[F.col(r.name) for r in rules])).alias("e")).select("e.*")


def judge(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES, bound: float = 0.5) -> DataFrame:
    """The columns `keep`, MEASURES, base_failed, quality and kept of every row.

    base_failed: fewer than 50 words, or more than half of them in repeated windows. quality is the
    posterior; kept rows aren't base_failed and have at least `bound` of it. Defined cases: null and empty texts have no words and
    fail; texts of any length are whole; repeated rows count and are judged each; an empty table gives an empty result;
    other columns aren't looked at, but names of `keep` may not be MEASURES.
    """
    measured = materialize(measures(docs, text_col, keep))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = measured.select(*keep, *MEASURES, failed.alias("base_failed"), probability(train(measured, rules), rules).alias("quality"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= bound))
