"""Byte-level BPE encoding and decoding, with tree concatenation for long texts.

Short texts are encoded whole. A text beyond LONG characters is cut, at its special tokens and
otherwise at any character, into parts of PART, which are encoded in parallel tasks and joined as a
tree by halves: a window of tokens around each join is encoded anew and grown until its outer
tokens agree with both sides. From an agreed token on, every neighbouring pair of tokens is one
that the encoder itself makes, so the joined sequence is the encoding of the whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Texts beyond LONG characters are cut into parts of at most PART.
LONG, PART = 16_384, 8_192
#: Tokens on each side that must agree, and the window's first size.
AGREE, WINDOW = 2, 8

#: Pre-tokenizer pattern of byte-level BPE (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes no Unicode version moved; other texts go through the tokenizers library.
COMMON = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")


def _alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encodes and decodes as the tokenizer file says, without post-processing."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("a byte-level BPE without normalizer or prefix space is needed")
        letters = _alphabet()
        vocab = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.path = path
        # ids follow the merges' order, so they are ranks
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for t, i in vocab.items():
            self.bytes_of[i] = t
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode("utf-8")
        self.names = [str(i) for i in range(len(self.bytes_of))]
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.cut = re.compile("|".join(names)) if names else None

    @cached_property
    def library(self):
        """The tokenizers library's own reading of the file, loaded when a text needs it."""
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.no_truncation()
        found.no_padding()
        return found

    def plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens."""
        if not COMMON.search(text):
            return self.fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        if self.cut is None or not self.cut.search(text):
            return self.plain(text)
        return [i for kind, part in self.segments(text) for i in ([self.special[part]] if kind else self.plain(part))]

    def segments(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is special, part) of the text in order; empty parts are left out."""
        at = 0
        for m in self.cut.finditer(text) if self.cut else ():
            if m.start() > at:
                yield False, text[at : m.start()]
            yield True, m.group()
            at = m.end()
        if at < len(text):
            yield False, text[at:]

    def decode(self, ids: list[int]) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the text of `left` followed by that of `right`; neither holds special tokens."""
        if not left or not right:
            return left + right
        size = WINDOW
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            # window ends must be character boundaries
            while a > 0 and self.bytes_of[left[a]][0] & 0xC0 == 0x80:
                a -= 1
            while b < len(right) and self.bytes_of[right[b]][0] & 0xC0 == 0x80:
                b += 1
            window = b"".join(self.bytes_of[i] for i in left[a:] + right[:b])
            own = self.plain(window.decode("utf-8"))
            first = a == 0 or own[:AGREE] == left[a : a + AGREE] and len(left) - a > AGREE
            last = b == len(right) or own[-AGREE:] == right[b - AGREE : b] and b > AGREE
            if first and last and (len(own) >= 2 * AGREE or a == 0 and b == len(right)):
                return left[:a] + own + right[b:]
            size *= 2

    def concatenate(self, parts: list[list[int]]) -> list[int]:
        """Joins encoded parts by halves, as a tree."""
        if len(parts) <= 1:
            return parts[0] if parts else []
        half = len(parts) // 2
        return self.join(self.concatenate(parts[:half]), self.concatenate(parts[half:]))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def parts(c: Codec, text: str, size: int = PART) -> Iterator[tuple[str, bool]]:
    """(part, open) of a long text; open: the part has to be joined to the one before it."""
    for kind, segment in c.segments(text):
        if kind:
            yield segment, False
        else:
            for at in range(0, len(segment), size):
                yield segment[at : at + size], at > 0


def merge(c: Codec, encoded: list[tuple[bool, list[int]]]) -> list[int]:
    """Ids of a text from its parts' (open, ids) in order."""
    out: list[int] = []
    run: list[list[int]] = []
    for is_open, ids in encoded:
        if not is_open:
            out += c.concatenate(run)
            run = []
        run.append(ids)
    return out + c.concatenate(run)


def ids_only(c: Codec, found: list[list[int]]) -> list[pa.Array]:
    return [pa.array(found, pa.list_(pa.int32()))]


def digests(c: Codec, found: list[list[int]]) -> list[pa.Array]:
    """Number of ids, digest of the ids, digest of the text decoded from them."""
    names = c.names
    ids = [hashlib.sha256(",".join([names[i] for i in x]).encode("ascii")).hexdigest() for x in found]
    texts = [hashlib.sha256(c.decode(x).encode("utf-8")).hexdigest() for x in found]
    return [pa.array([len(x) for x in found], pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]


def counts(c: Codec, found: list[list[int]]) -> list[pa.Array]:
    return [pa.array([len(x) for x in found], pa.int64())]


RESULTS: dict[str, tuple[Callable, str]] = {
    "ids": (ids_only, "ids array<int>"),
    "counts": (counts, "n_tokens long"),
    "digests": (digests, "n_tokens long, ids_sha256 string, decoded_sha256 string"),
}


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", result: str = "ids", long: int = LONG, size: int = PART) -> DataFrame:
    """(id, ids array<int>), or their number, or the digests of ids and decoded text, for every row.

    path: the tokenizer file, at the same place on every worker. Defined cases: null text is empty
    and has no ids; texts of any length are encoded whole and exactly; repeated rows stay repeated;
    null ids are kept; an empty table gives an empty result; other columns aren't looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    make, columns = RESULTS[result]
    names = [c.split()[0] for c in columns.split(", ")]
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), *make(c, [c.encode(t) for t in b.column(1).to_pylist()])], ["id", *names])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in slices(batches):
            own, at, is_open, texts = [], [], [], []
            for k, text in enumerate(b.column(2).to_pylist()):
                for i, (part, o) in enumerate(parts(c, text, size)):
                    own.append(k)
                    at.append(i)
                    is_open.append(o)
                    texts.append(part)
            take = pa.array(own, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(at, pa.int32()), pa.array(is_open, pa.bool_()), pa.array(texts, pa.string())], ["id", "row", "at", "open", "text"])

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *ids_only(c, [c.encode(t) for t in b.column(4).to_pylist()])], ["id", "row", "at", "open", "ids"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in slices(batches):
            found = [merge(c, [(p["open"], p["ids"]) for p in x]) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *make(c, found)], ["id", *names])

    few = source.where(F.length("text") <= long).mapInArrow(short, f"id {kind}, {columns}")
    split = source.where(F.length("text") > long).select("id", F.xxhash64("text").alias("row"), "text").mapInArrow(cut, f"id {kind}, row long, at int, open boolean, text string")
    leaves = split.repartition(F.xxhash64("id", "row", "at")).mapInArrow(leaf, f"id {kind}, row long, at int, open boolean, ids array<int>")
    # equal rows have equal parts: one of each is joined, and their number kept
    single = leaves.groupBy("id", "row", "at").agg(F.first("open").alias("open"), F.first("ids").alias("ids"), F.count("*").alias("c"))
    texts = single.groupBy("id", "row").agg(F.sort_array(F.collect_list(F.struct("at", "open", "ids"))).alias("parts"), F.max("c").cast("int").alias("c"))
    joined = texts.select("id", "parts", F.explode(F.sequence(F.lit(1), "c")).alias("_")).select("id", "parts")
    return few.unionByName(joined.mapInArrow(whole, f"id {kind}, {columns}"))


def decode(rows: DataFrame, path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """The columns `keep` and text string; null ids give a null text."""
    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in slices(batches):
            texts = [None if x is None else c.decode(x) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string())], [*keep, "text"])

    return rows.select(F.col(ids_col).alias("_ids"), *keep).mapInArrow(run, f"{kinds}text string")
