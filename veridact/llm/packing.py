"""Variable-capacity best-fit packing of token sequences.

Several sequence lengths are permitted; a bin of capacity c costs what training on it does: c
tokens, attention of c * c / ATTENTION, and OVERHEAD. Texts longer than the largest capacity are cut
into pieces of it, so nothing is truncated. Pieces are packed in decreasing length, each into the
open bin it leaves the least room in; if none has room, the bin size of the least cost for each
token it can still get is opened: long bins for long pieces, middle ones for the rest. At last
every bin is downsized to the smallest permitted length that holds its contents. All sets of
permitted lengths that can hold the largest piece are tried, and the cheapest outcome is kept.

Pieces are dealt by hash into shards of about SHARD pieces that are packed on their own: what a
shard loses is under one bin of each size, and no task holds more than a shard.
"""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import WORD, materialize

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 16
#: Capacity at which attention costs a token as much again as all else.
ATTENTION = 65_536
SHARD = 20_000


def bin_cost(capacity: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    return capacity + capacity * capacity / attention + overhead


def best_fit(lengths: list[int], capacities: tuple[int, ...], overhead: int = OVERHEAD, attention: int = ATTENTION) -> list[list[int]]:
    """Bins as lists of indexes into lengths, which are in decreasing order and fit the largest capacity."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set while a bin with room r is open
    left = sum(lengths)
    costs = [(c, bin_cost(c, overhead, attention)) for c in capacities]
    for i, n in enumerate(lengths):
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room = min((cost / max(min(c, left), 1), c) for c, cost in costs if c >= n)[1]
            at = len(bins)
            bins.append([])
        bins[at].append(i)
        room -= n
        left -= n
        if room:
            by_room.setdefault(room, []).append(at)
            rooms |= 1 << room
    return bins


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION) -> list[tuple[int, list[int]]]:
    """(capacity, indexes) of the cheapest packing; lengths in decreasing order. Of equal costs the first of the smaller sets."""
    top = None
    for some in (x for k in range(1, len(capacities) + 1) for x in combinations(capacities, k)):
        if not lengths or some[-1] < lengths[0]:
            continue
        sized = []
        for b in best_fit(lengths, some, overhead, attention):
            held = sum(lengths[i] for i in b)
            sized.append((next(c for c in capacities if c >= held), b))
        cost = sum(bin_cost(c, overhead, attention) for c, _ in sized)
        if top is None or cost < top[0]:
            top = (cost, sized)
    return top[1] if top else []


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: int = CAPACITIES[-1], tokenizer: str | None = None) -> DataFrame:
    """(id, piece int, first_token long, n_tokens int): texts cut into at most `largest` tokens.

    Tokens are those of the byte-level BPE file `tokenizer`; without one they are words, which suits
    texts with white space only. A null text is empty; an empty text has one piece of no tokens.
    """
    if tokenizer:
        sized = bpe.encode(docs, tokenizer, id_col, text_col, result="counts", long=4 * bpe.LONG).withColumnRenamed("n_tokens", "n")
    else:
        n = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
        sized = docs.select(F.col(id_col).alias("id"), n.alias("n"))
    sized = materialize(sized) if tokenizer else sized
    last = F.greatest(F.ceil(F.col("n") / largest) - 1, F.lit(0)).cast("int")
    cut = sized.select("id", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    first = F.col("piece").cast("long") * largest
    return cut.select("id", "piece", first.alias("first_token"), F.least(F.col("n") - first, F.lit(largest)).cast("int").alias("n_tokens"))


def packed(parts: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, shard: int = SHARD, attention: int = ATTENTION) -> DataFrame:
    """parts (as pieces() gives them) with bin string, capacity int and start int, the place in the bin.

    Defined cases: pieces of no tokens get no bin (null bin, capacity and start 0); equal lengths go
    by id, nulls first, then piece; repeated rows are pieces of their own; an empty table gives an
    empty result. Every piece comes out once; capacities must be increasing.
    """
    kind = parts.schema["id"].dataType.simpleString()
    full = parts.where("n_tokens > 0")
    shards = max(1, -(-full.count() // shard))
    # first_token and n_tokens deal out the pieces of one id; the hash is the same on a retry
    dealt = full.withColumn("shard", F.pmod(F.xxhash64("id", "piece", "n_tokens"), F.lit(shards)).cast("int"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "id", "piece"], ascending=[False, True, True], na_position="first").reset_index(drop=True)
        place = [None] * len(rows)
        lengths = rows["n_tokens"].tolist()
        for b, (capacity, held) in enumerate(pack(lengths, capacities, overhead, attention)):
            at = 0
            for i in held:
                place[i] = (f"{key[0]}-{b}", capacity, at)
                at += lengths[i]
        rows["bin"], rows["capacity"], rows["start"] = zip(*place)
        return rows.drop(columns="shard")

    done = dealt.groupBy("shard").applyInPandas(run, f"id {kind}, piece int, first_token long, n_tokens int, bin string, capacity int, start int")
    empty = parts.where("n_tokens = 0").select("*", F.lit(None).cast("string").alias("bin"), F.lit(0).alias("capacity"), F.lit(0).alias("start"))
    return done.unionByName(empty)


def sequences(docs: DataFrame, placed: DataFrame, id_col: str = "doc_id", text_col: str = "text", joiner: str = "\n\n", tokenizer: str | None = None) -> DataFrame:
    """The packed training sequences, one row per bin: (bin, capacity, n_tokens, text), or with the
    pieces' tokenizer (bin, capacity, n_tokens, ids array<int>)."""
    if tokenizer:
        texts = bpe.encode(docs, tokenizer, id_col, text_col).withColumnRenamed("ids", "tokens")
    else:
        texts = docs.select(F.col(id_col).alias("id"), F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})")).alias("tokens"))
    part = F.slice("tokens", (F.col("first_token") + 1).cast("int"), F.col("n_tokens"))
    rows = placed.where("bin is not null").join(texts, "id").select("bin", "capacity", "start", "n_tokens", (part if tokenizer else F.array_join(part, " ")).alias("part"))
    grouped = rows.groupBy("bin", "capacity").agg(F.sum("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("start", "part"))).alias("parts"))
    held = F.transform("parts", lambda p: p["part"])
    return grouped.select("bin", "capacity", "n_tokens", F.flatten(held).alias("ids") if tokenizer else F.array_join(held, joiner).alias("text"))
