"""Alignment of the tokens of two tokenizers over one text, and how often token ids meet in a corpus.

Every Arrow partition goes through DuckDB in slices of bounded size. No token reaches over a word's
end, so a slice's texts become rows of its distinct words (a text where that can't be told is a word of its own), and
the tokens of those become tables of byte intervals: an as-of join (a range join for the nearest)
finds the token of the other side that covers each token's last byte, a window sum over shared ends
numbers the groups, and a join inside groups gives the linked id pairs. A slice's documents keep their links as indices
into the slice's own list of distinct pairs; that list carries partial document counts, which Spark
merges over the corpus. The merged counts come back to each slice once, whatever the number of its documents.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import materialize

#: UTF-8 bytes of the texts of a slice; a longer text is a slice of its own.
SLICE = 3 << 20
#: Words that are encoded in one go.
CHUNK = 2000
#: Memory of DuckDB in a worker; beyond it, it spills to the worker's temporary folder.
DUCKDB_MEMORY = "256MB"

# Words with the space or line break before them, and texts that consist of nothing else.
_WORD = re.compile(r"[ \n][^ \n]+")
_SPACED = re.compile(r"(?:[ \n][^\s\x1c-\x1f\x85]+)*")


class Left:
    """Ids and bytes of a byte-level BPE; strings of special tokens are plain text."""

    def __init__(self, path: str):
        self.codec = bpe.codec(path)
        self.bytes_of = self.codec.bytes_of

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.codec.path)
        found.no_truncation()
        found.no_padding()
        found.encode_special_tokens = True
        return found

    def encode(self, spaced: str) -> list[int]:
        if bpe.COMMON.search(spaced):
            return self.library.encode(spaced, add_special_tokens=False).ids
        return self.codec.fast.encode_ordinary(spaced)


class Right:
    """Ids and bytes of a sentencepiece model that puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(pieces)]
        # whether no piece reaches over a word's end and common characters come back as they are
        self.by_word = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.by_word = self.by_word and all(self.back(t) == t.encode("utf-8") for t in (f" x{c}x\n{c}" for c in map(chr, range(33, 592)) if not bpe.COMMON.search(c)))

    def back(self, spaced: str) -> bytes:
        return b"".join([self.bytes_of[i] for i in self.encode(spaced)])

    def encode(self, spaced: str) -> list[int]:
        """Ids of a text that is given with the space that the model adds."""
        return self.model.encode(spaced[1:])


class Pair:
    """Both tokenizers."""

    def __init__(self, left: str, right: str):
        self.sides = (Left(left), Right(right))
        self.sizes = [np.array([len(x) for x in s.bytes_of], np.int32) for s in self.sides]
        # ids as text, followed by what stands before the next: another id, the other side, the next group
        self.names = [f"{i}{c}" for i in range(max(map(len, self.sizes))) for c in ",|;"]

    def words(self, text: str) -> list[str]:
        """Words of space+text with the space or line break before each, or all of it where words can't be told.

        The byte-level pre-tokenizer starts anew at a lone space or line break between characters that aren't white space.
        """
        spaced = " " + text
        if self.sides[1].by_word and not bpe.COMMON.search(spaced) and _SPACED.fullmatch(spaced):
            return _WORD.findall(spaced)
        return [spaced]

    def encode(self, words: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """The place of each word, and for each side the ids of all words by place and each one's number of ids.

        A word that a side doesn't give back has none. Words that can be told come first and are encoded in chunks.
        """
        told = [self.sides[1].by_word and not bpe.COMMON.search(w) and _WORD.fullmatch(w) is not None for w in words]
        order = [i for i, t in enumerate(told) if t]
        many = len(order)
        order += [i for i, t in enumerate(told) if not t]
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        ids: list[list[np.ndarray]] = [[np.empty(0, np.int32)], [np.empty(0, np.int32)]]
        n: list[list[np.ndarray]] = [[np.empty(0, np.int32)], [np.empty(0, np.int32)]]
        for at in range(0, many, CHUNK):
            chunk = [" a", *[words[i] for i in order[at : min(many, at + CHUNK)]]]  # a word with a space stands first
            stops = np.cumsum([len(w.encode("utf-8")) for w in chunk])
            for k, (s, size) in enumerate(zip(self.sides, self.sizes)):
                found = np.array(s.encode("".join(chunk)), np.int32)
                cuts = np.searchsorted(np.cumsum(size[found]), stops, "right")
                ids[k].append(found[cuts[0] :])
                n[k].append(np.diff(cuts).astype(np.int32))
        for i in order[many:]:
            for k, found in enumerate(self.tokens(words[i])):
                ids[k].append(np.array(found, np.int32))
                n[k].append(np.array([len(found)], np.int32))
        return place, [(np.concatenate(ids[k]), np.concatenate(n[k])) for k in (0, 1)]

    def tokens(self, spaced: str) -> tuple[list[int], list[int]]:
        """Both id sequences of a text given with its space; none if a side's bytes aren't those of it."""
        want = spaced.encode("utf-8")
        both = [s.encode(spaced) for s in self.sides]
        return ([], []) if any(b"".join([s.bytes_of[i] for i in x]) != want for s, x in zip(self.sides, both)) else (both[0], both[1])


@lru_cache(maxsize=1)
def pair(left: str, right: str) -> Pair:
    return Pair(left, right)


#: The groups, links and pairs of a slice: tables a and b are its words' tokens (w word, i place, id, s and e first
#: byte and the byte behind the last, counted through the slice), has its documents' words (d, w). A word ends tokens of both sides.
STEPS = (
    # the token of b under the last byte of each token of a, and whether both end there
    "CREATE OR REPLACE TEMP TABLE covered AS SELECT a.w, a.i, a.id, a.e, (b.e = a.e)::INT AS shared FROM a ASOF JOIN b ON a.e > b.s",
    "CREATE OR REPLACE TEMP TABLE ga AS SELECT w, i, id, e, shared, (sum(shared) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) - shared)::INT AS g FROM covered",
    # tokens of b belong to the first shared end at or behind their own
    "CREATE OR REPLACE TEMP TABLE gb AS SELECT b.i, b.id, x.g FROM b ASOF JOIN (SELECT e, g FROM ga WHERE shared = 1) x ON b.e <= x.e",
    # ids of a group are counted before they meet, so that a run of one token costs one pair
    """CREATE OR REPLACE TEMP TABLE word_links AS SELECT x.w, x.id AS a, y.id AS b, sum(x.n * y.n)::BIGINT AS m
       FROM (SELECT w, g, id, count(*) AS n FROM ga GROUP BY ALL) x JOIN (SELECT g, id, count(*) AS n FROM gb GROUP BY ALL) y USING (g) GROUP BY ALL""",
    "CREATE OR REPLACE TEMP TABLE pairs AS SELECT a, b, (row_number() OVER (ORDER BY a, b) - 1)::INT AS k FROM (SELECT DISTINCT a, b FROM word_links)",
    """CREATE OR REPLACE TEMP TABLE links AS SELECT d, k, sum(c * m)::BIGINT AS m FROM (SELECT d, w, count(*) AS c FROM has GROUP BY ALL)
       JOIN (SELECT w, k, m FROM word_links JOIN pairs USING (a, b)) USING (w) GROUP BY ALL""",
)
PER_DOCUMENT = "SELECT d, sum(m)::BIGINT AS n_links, list(k ORDER BY k) AS k, list(m ORDER BY k) AS m FROM links GROUP BY d ORDER BY d"
PAIRS = "SELECT a, b, n FROM pairs JOIN (SELECT k, count(*) AS n FROM links GROUP BY k) USING (k) ORDER BY k"

COLUMNS = "slice long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, n array<long>"
NAMES = ["slice", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "n"]
RESULT = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def duckdb_session():
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads = 1")
    con.execute(f"SET memory_limit = '{DUCKDB_MEMORY}'")
    con.execute(f"SET temp_directory = '{tempfile.gettempdir()}'")
    return con


def portions(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have at most size bytes; a longer text comes alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def intervals(ids: np.ndarray, n: np.ndarray, sizes: np.ndarray) -> pa.Table:
    e = np.cumsum(sizes[ids], dtype=np.int64)
    return pa.table({"w": np.repeat(np.arange(len(n), dtype=np.int32), n), "i": np.arange(len(ids), dtype=np.int32), "id": ids, "s": e - sizes[ids], "e": e})


def group_texts(p: Pair, a: dict, b: dict, n: int) -> tuple[np.ndarray, list[str]]:
    """Of each of n words the number of groups, and `a1,a2|b1;a3|b2,b3` of its groups; a, b in order, with id and g, a with w."""
    if not len(a["g"]):
        return np.zeros(n, np.int64), [""] * n
    many_a, many_b = np.bincount(a["g"]), np.bincount(b["g"])
    upto_a, upto_b = np.cumsum(many_a), np.cumsum(many_b)
    # a group's tokens of a come first, then those of b
    at_a, at_b = np.arange(len(a["g"])) + (upto_b - many_b)[a["g"]], np.arange(len(b["g"])) + upto_a[b["g"]]
    ids = np.empty(len(at_a) + len(at_b), np.int64)
    ids[at_a], ids[at_b] = a["id"] * np.int64(3), b["id"] * np.int64(3)
    ids[at_a[upto_a - 1]] += 1
    ids[at_b[upto_b - 1]] += 2
    owner = a["w"][upto_a - 1]  # of each group
    tokens = np.cumsum(np.bincount(owner, many_a + many_b, minlength=n)).astype(np.int64)
    texts, before = [], 0
    for stop in tokens.tolist():
        texts.append("".join([p.names[i] for i in ids[before:stop].tolist()])[:-1])
        before = stop
    return np.bincount(owner, minlength=n), texts


def aligned(p: Pair, con, texts: list[str | None]) -> dict[str, list]:
    """Of each text n_a, n_b, n_groups, n_links, groups_sha256, k and m; and pairs (a, b, n) of all."""
    number: dict[str, int] = {}
    own = [np.array([number.setdefault(w, len(number)) for w in p.words(t)], np.int32) if t else np.empty(0, np.int32) for t in texts]
    place, tokens = p.encode(list(number))
    own = [place[w] for w in own]
    for name, (ids, n), sizes in zip("ab", tokens, p.sizes):
        con.register(name, intervals(ids, n, sizes))
    con.register("has", pa.table({"d": np.repeat(np.arange(len(own), dtype=np.int32), list(map(len, own))), "w": np.concatenate(own) if own else np.empty(0, np.int32)}))
    for step in STEPS:
        con.execute(step)
    a = con.execute("SELECT w, id, g FROM ga ORDER BY i").fetchnumpy()
    b = con.execute("SELECT id, g FROM gb ORDER BY i").fetchnumpy()
    n_groups, groups = group_texts(p, a, b, len(number))
    links = con.sql(PER_DOCUMENT).to_arrow_table()
    pairs = con.execute(PAIRS).fetchnumpy()
    for name in ("a", "b", "has"):
        con.unregister(name)
    n_links, k, m = [0] * len(texts), [[] for _ in texts], [[] for _ in texts]
    for d, x, ks, ms in zip(links["d"].to_pylist(), links["n_links"].to_pylist(), links["k"], links["m"]):
        n_links[d], k[d], m[d] = x, ks.values.to_numpy(), ms.values.to_numpy()
    of = lambda x: [int(x[w].sum()) for w in own]
    joined = [";".join([groups[i] for i in w.tolist()]) for w in own]
    return {
        "n_a": of(tokens[0][1]), "n_b": of(tokens[1][1]), "n_groups": of(n_groups), "n_links": n_links,
        "groups_sha256": [hashlib.sha256(g.encode("ascii")).hexdigest() if g else "" for g in joined], "k": k, "m": m, "pairs": pairs,
    }


def sliced(docs: DataFrame, left: str, right: str, id_col: str = "doc_id", text_col: str = "text", size: int = SLICE) -> DataFrame:
    """The documents' rows of a slice, and one row more for its distinct pairs, written once (COLUMNS).

    A document's row has k in a and m in n: which of the slice's pairs it links, and how often. The slice's
    own row has null counts, the pairs in a and b, and in n how many of its documents link them.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    columns = COLUMNS.format(kind=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, con = pair(left, right), duckdb_session()
        number = TaskContext.get().partitionId() << 40
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        for whole in batches:
            for part in portions(whole, 1, size):
                x = aligned(p, con, part.column(1).to_pylist())
                n = part.num_rows
                counted = [pa.array(x[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                own = [pa.array([number] * n, pa.int64()), part.column(0), *counted, pa.array(x["groups_sha256"], pa.string()), pa.array(x["k"], ints), pa.nulls(n, ints), pa.array(x["m"], longs)]
                yield pa.RecordBatch.from_arrays(own, NAMES)
                pairs = [pa.array([x["pairs"][c]], t) for c, t in (("a", ints), ("b", ints), ("n", longs))]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.nulls(1, part.column(0).type), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), *pairs], NAMES)
                number += 1

    return materialize(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, columns))


def partial_counts(rows: DataFrame) -> DataFrame:
    """(slice, k, a, b, n) of sliced()'s pairs."""
    return rows.where("n_a is null").select("slice", F.posexplode(F.arrays_zip("a", "b", "n")).alias("k", "p")).select("slice", "k", "p.a", "p.b", "p.n")


def merged_counts(rows: DataFrame) -> DataFrame:
    """(a, b, n, best) over the corpus: documents that link the ids, and whether no other b has more for this a."""
    total = materialize(partial_counts(rows).groupBy("a", "b").agg(F.sum("n").alias("n")))
    top = total.groupBy("a").agg(F.max("n").alias("top"))
    return total.join(top, "a").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def vocabulary_map(docs: DataFrame, left: str, right: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, n, best) of every pair of ids that some document links; defined cases as in score()."""
    return merged_counts(sliced(docs, left, right, id_col, text_col))


#: A slice's documents against its pairs' corpus-wide counts.
SCORES = """
WITH own AS (SELECT row, unnest(k) AS k, unnest(m) AS m FROM docs),
     sums AS (SELECT row, sum(m) FILTER (WHERE best)::BIGINT AS n_best, sum(m * n)::BIGINT AS count_sum FROM own JOIN counts USING (k) GROUP BY row)
SELECT coalesce(n_best, 0) AS n_best, coalesce(count_sum, 0) AS count_sum FROM docs LEFT JOIN sums USING (row) ORDER BY row
"""


def score(docs: DataFrame, left: str, right: str, id_col: str = "doc_id", text_col: str = "text", size: int = SLICE) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    left: a byte-level BPE file, right: a sentencepiece model, at the same places on every worker. Defined cases: null
    and empty texts, and texts that a tokenizer doesn't give back byte for byte, have no tokens, zeros
    and an empty groups_sha256; repeated rows and ids are documents of their own; null ids are kept; texts of any
    length are whole; an empty table gives an empty result; other columns aren't looked at.
    """
    rows = sliced(docs, left, right, id_col, text_col, size)
    totals = materialize(merged_counts(rows))
    counts = partial_counts(rows).select("slice", "k", "a", "b").join(totals, ["a", "b"]).select(F.col("slice").alias("of"), "k", "n", "best")
    own = rows.where("n_a is not null").select("slice", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", F.col("a").alias("k"), F.col("n").alias("m"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(mine: pa.Table, found: pa.Table) -> pa.Table:
        con = duckdb_session()
        # the slice's rows as they are; the query gives its sums in their order
        con.register("docs", pa.table({"row": pa.array(np.arange(mine.num_rows), pa.int64()), "k": mine["k"], "m": mine["m"]}))
        con.register("counts", found.select(["k", "n", "best"]))
        sums = con.sql(SCORES).to_arrow_table() if mine.num_rows else pa.table({"n_best": pa.array([], pa.int64()), "count_sum": pa.array([], pa.int64())})
        kept = mine.select(["id", "n_a", "n_b", "n_groups", "n_links"])
        return pa.table([*kept.columns, sums["n_best"], sums["count_sum"], mine["groups_sha256"]], names=RESULT)

    return own.groupBy("slice").cogroup(counts.groupBy("of")).applyInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")

