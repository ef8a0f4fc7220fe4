"""SimHash near-duplicates by pigeonring filtering.

A 64-bit fingerprint is cut into four 16-bit segments on a ring. If two fingerprints differ in at
most t = 3 bits, some segment i starts a chain whose cumulative differences stay within l * t / 4
for every length l: segment i is equal, i and i + 1 together differ in at most one bit, the first
three in at most two. The first two links of the chain are an equi-join on 32 bits (one exact
entry a position, 1 + 16 probes), the later links prune in the join condition before the full
Hamming check.

Groups of copies are never expanded into pairs. Equal fingerprints are one class. Each bucket
first links its members to one hub (the fingerprint of most documents); what shares a component by
then needs no further links, and only buckets that still hold several components are searched pair
by pair, and there only the members outside the bucket's largest component.

What is joined grows with the input, so all joins are merges by hint: a broadcast would pass a table through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, hamming, materialize, slices

SEGMENTS, WIDTH = 4, 16
MAX_BITS = 3


def shingle_hashes(text: str | None, k: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every k-word shingle of the A-Z lower-cased text, repeats included."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - k + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes, as a signed 64-bit integer; no hashes: zero."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp long) of every row; null texts count as empty. One pass, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = [fingerprint(shingle_hashes(t, words)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, (i % SEGMENTS) * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _key(fp: Column, i: int, flip: int = 0) -> Column:
    second = _segment(fp, i + 1).bitwiseXOR(F.lit(flip))
    return F.lit(i << 32).bitwiseOR(F.shiftleft(_segment(fp, i), WIDTH)).bitwiseOR(second)


def _viable(a: Column, b: Column, position: Column) -> Column:
    """The chain from the key's position stays within budget at length three."""
    diff = a.bitwiseXOR(b)
    third = F.lit(None)
    for i in range(SEGMENTS):
        three = sum((F.bit_count(_segment(diff, i + l)) for l in (1, 2)), F.bit_count(_segment(diff, i)))
        third = F.when(position == i, three) if i == 0 else third.when(position == i, three)
    return third <= 3 * MAX_BITS // SEGMENTS


def link(fps: DataFrame) -> DataFrame:
    """Components of distinct fingerprints under Hamming distance <= 3.

    fps: (fp long unique, n long documents). Returns (fp, root) for fingerprints with a link;
    those without one are absent.
    """
    fp = F.col("fp")
    index = fps.select(F.explode(F.array(*[_key(fp, i) for i in range(SEGMENTS)])).alias("key"), "fp", "n")
    hubs = materialize(
        index.groupBy("key").agg(F.max(F.struct("n", "fp")).alias("top"), F.count("*").alias("size"))
        .select("key", F.col("top.fp").alias("hub"), "size")
    )
    flips = [0, *(1 << j for j in range(WIDTH))]
    probes = fps.select(F.explode(F.array(*[_key(fp, i, x) for i in range(SEGMENTS) for x in flips])).alias("key"), "fp")
    # every probe that meets a bucket, apart from a lone member meeting itself
    met = materialize(probes.join(hubs.hint("merge"), "key").where("not (size = 1 and fp = hub)"))
    position = F.shiftright("key", 32)

    def near(rows: DataFrame, a: str, b: str) -> DataFrame:
        x, y = F.col(a), F.col(b)
        return rows.where((x != y) & _viable(x, y, position) & (hamming(x, y) <= MAX_BITS)).select(x.alias("u"), y.alias("v"))

    first = materialize(components(near(met, "fp", "hub")))
    # buckets of several members that still meet more than one component
    named = first.select(F.col("node").alias("fp"), "root")
    shared = met.where("size > 1").select("key", "fp", F.lit(False).alias("inside"))
    members = index.join(hubs.where("size > 1").select("key").hint("merge"), "key").select("key", "fp", F.lit(True).alias("inside"))
    placed = shared.unionByName(members).join(named.hint("merge"), "fp", "left").select("key", "fp", "inside", F.coalesce("root", "fp").alias("comp"))
    placed = materialize(placed)
    mixed = materialize(
        placed.groupBy("key", "comp").agg(F.count("*").alias("c"))
        .groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.count("*").alias("comps"))
        .where("comps > 1").select("key", F.col("top.comp").alias("major"))
    )
    left = materialize(placed.join(mixed.hint("merge"), "key"))
    member = left.where("inside").select("key", F.col("fp").alias("other"), F.col("comp").alias("other_comp"), F.col("major").alias("other_major"))
    probe = left.where("not inside").select("key", "fp", "comp", "major")
    pairs = probe.where("comp <> major").drop("major").join(member.drop("other_major").hint("merge"), "key").where("comp <> other_comp").unionByName(
        probe.drop("major").join(member.where("other_comp <> other_major").drop("other_major").hint("merge"), "key").where("comp <> other_comp"))
    x, y = F.col("fp"), F.col("other")
    late = pairs.where(_viable(x, y, position) & (hamming(x, y) <= MAX_BITS)).select(F.col("comp").alias("u"), F.col("other_comp").alias("v"))
    late = materialize(late.distinct())
    if late.isEmpty():
        return named
    merged = components(late).select(F.col("node").alias("root"), F.col("root").alias("final"))
    # a comp that linked late may be a fingerprint without earlier links
    alone = late.select(F.col("u").alias("fp")).union(late.select(F.col("v").alias("fp"))).distinct().join(named.hint("merge"), "fp", "left_anti").select("fp", F.col("fp").alias("root"))
    return named.union(alone).join(merged.hint("merge"), "root", "left").select("fp", F.coalesce("final", "root").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp, component): the component is the smallest id reachable over links of <= 3 bits.

    Defined cases: null text is empty; texts of no words have fingerprint zero and link like any
    other; texts of fewer words than a shingle hash whole; repeated rows stay repeated; null ids
    take part and never are the smallest unless a component has no other; an empty table gives an
    empty result; other columns of docs are not looked at.
    """
    marks = materialize(fingerprints(docs, id_col, text_col, words))
    classes = materialize(marks.groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("low")))
    roots = link(classes.select("fp", "n"))
    rooted = materialize(classes.join(roots.hint("merge"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")))
    lows = materialize(rooted.groupBy("root").agg(F.min("low").alias("component")))
    named = materialize(rooted.select("fp", "root").join(lows.hint("merge"), "root").select("fp", "component"))
    return marks.join(named.hint("merge"), "fp").select("id", "fp", "component")


# --- near copies by similarity of five-word shingles -------------------------------------------

#: Of each level's strata, those that are looked up.
STRATA = 16
#: Shingles of a stratum: from PER to twice as many on average.
PER = 2.5
#: Bits of 64 that fingerprints of distinct shingles at a similarity of 0.8 may differ in (mean 10, deviation 3).
SIMILAR_BITS = 24
#: Texts of fewer distinct shingles aren't held against SIMILAR_BITS: a single one moves too many bits.
FEW = 8
#: Lengths of a band differ by at most this factor.
BAND = 1.05


def sketch(text: str | None, words: int = 5, similarity: float = 0.8) -> tuple[bytes, int, int, list[int]] | None:
    """(class of equal word sequences, fingerprint of the distinct shingles, their number, keys of strata); None: no words.

    The distinct shingle hashes are dealt by their leading bits into 2^level strata, each with a
    SimHash fingerprint of its own; the level follows the number of shingles so that a stratum has
    a few, and texts that may have a partner of the next level are keyed by that one too. At a
    similarity of 0.8 a stratum of three stays whole with probability 0.5, and one whole stratum of
    the 16 makes a candidate.
    """
    parts = (text or "").encode("utf-8").lower().split()
    if not parts:
        return None
    own = np.unique(shingle_hashes(text, words))
    n = len(own)
    level = max(0, int(np.floor(np.log2(n / PER))))
    keys = []
    for lv in (level, level + 1) if n / similarity >= PER * 2 ** (level + 1) else (level,):
        index = own >> np.uint64(64 - lv) if lv else np.zeros(n, np.uint64)
        index = index[: np.searchsorted(index, STRATA)]
        if len(index):
            starts = np.flatnonzero(np.concatenate(([True], index[1:] != index[:-1])))
            bits = np.unpackbits(own[: len(index)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sizes = np.diff(np.append(starts, len(index)))
            marks = np.packbits(np.add.reduceat(bits, starts, axis=0, dtype=np.int32) * 2 > sizes[:, None], axis=1, bitorder="little")
            keys += [xxhash.xxh3_64_intdigest(b"%d/%d/" % (lv, i) + m.tobytes()) - (1 << 63) for i, m in zip(index[starts].tolist(), marks)]
    return xxhash.xxh3_128_digest(b" ".join(parts)), fingerprint(own), n, keys


def _ring(a: Column, b: Column) -> Column:
    """Some chain of three 8-bit segments stays within the proportional budget, and so does the whole."""
    diff = a.bitwiseXOR(b)
    cut = [F.bit_count(F.shiftrightunsigned(diff, 8 * i).bitwiseAND(F.lit(255))) for i in range(8)]
    one = SIMILAR_BITS // 8
    chain = F.lit(False)
    for i in range(8):
        two = cut[i] + cut[(i + 1) % 8]
        chain = chain | ((cut[i] <= one) & (two <= 2 * one) & (two + cut[(i + 2) % 8] <= 3 * one))
    return chain & (F.bit_count(diff) <= SIMILAR_BITS)


def jaccard(a: str, b: str, words: int = 5) -> float:
    x, y = np.unique(shingle_hashes(a, words)), np.unique(shingle_hashes(b, words))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(len(x) + len(y) - both, 1)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose whole shingle sets are similar enough; sets: (ck, own)."""
    full = pairs.join(sets.select(F.col("ck").alias("u"), F.col("own").alias("a")), "u").join(
        sets.select(F.col("ck").alias("v"), F.col("own").alias("b")), "v")
    both = F.size(F.array_intersect("a", "b"))
    return full.where(both * (1 + similarity) >= similarity * (F.size("a") + F.size("b")) - 1e-9).select("u", "v")


def _row(id_col: str, text_col: str) -> Column:
    """128 bits that stand for a row's id and text."""
    return F.struct(F.xxhash64(id_col, text_col).alias("one"), F.xxhash64(F.lit(1), id_col, text_col).alias("two"))


def _groups(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float, save: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(row, ck) of every row with words, (ck, root) of every class, (root, keeper) of every group."""
    kind = docs.schema[id_col].dataType.simpleString()
    row_kind = "struct<one:bigint,two:bigint>"
    source = docs.select(F.col(id_col).alias("id"), _row(id_col, text_col).alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [sketch(t, words, similarity) for t in b.column(2).to_pylist()]
            on = pa.array([i for i, x in enumerate(found) if x], pa.int32())
            found = [x for x in found if x]
            columns = [pa.array([x[0] for x in found], pa.binary()), *(pa.array([x[k] for x in found], pa.int64()) for k in (1, 2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(on), b.column(1).take(on), *columns, pa.array([x[3] for x in found], pa.list_(pa.int64()))],
                ["id", "row", "ck", "fp", "n", "keys"],
            )

    marks = save(source.mapInArrow(run, f"id {kind}, row {row_kind}, ck binary, fp long, n long, keys array<long>"))
    low = F.min(F.struct(F.col("id").isNull().alias("z"), "id", "row")).alias("low")
    classes = save(marks.groupBy("ck").agg(low, F.count("*").alias("docs"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("keys").alias("keys")))
    index = classes.select(F.explode("keys").alias("key"), "ck", "fp", "n", "docs")
    several = save(index.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key"))
    members = save(index.join(several, "key"))
    hubs = save(members.groupBy("key").agg(F.max(F.struct("docs", "ck", "fp", "n")).alias("top")))
    met = members.join(hubs, "key").select("ck", "fp", "n", F.col("top.ck").alias("hub"), F.col("top.fp").alias("hub_fp"), F.col("top.n").alias("hub_n"))

    def alike(fp: str, n: str) -> Column:
        """Whether the row's text and the one of the columns fp and n may be similar enough."""
        x, y = F.col("n"), F.col(n)
        return (F.least(x, y) >= similarity * F.greatest(x, y) - 1e-9) & ((F.least(x, y) < FEW) | _ring(F.col("fp"), F.col(fp)))

    first_pairs = save(met.where((F.col("ck") != F.col("hub")) & alike("hub_fp", "hub_n")).select(F.least("ck", "hub").alias("u"), F.greatest("ck", "hub").alias("v")).distinct())

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            own = [np.unique(shingle_hashes(t, words)).view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.list_(pa.int64()))], ["ck", "own"])

    # whole shingle sets of the classes that may take part: those in a bucket of several
    wanted = members.select("ck").distinct().join(classes.select("ck", F.col("low.row").alias("row")), "ck")
    sets = save(source.select("row", "text").join(wanted, "row").select("ck", "text").dropDuplicates(["ck"]).mapInArrow(shingles, "ck binary, own array<long>"))
    first = save(components(_verified(first_pairs, sets, similarity), save))
    named = first.select(F.col("node").alias("ck"), "root")
    late = _late_pairs(members.join(named, "ck", "left").select("key", "ck", "fp", "n", F.coalesce("root", "ck").alias("comp")), sets, alike, similarity, save)
    more = _verified(late, sets, similarity)
    # the first components and the late links make one small graph
    roots = components(first.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more), save)
    roots = roots.select(F.col("node").alias("ck"), "root")
    named = save(classes.select("ck", "low").join(roots, "ck", "left").select("ck", "low", F.coalesce("root", "ck").alias("root")))
    keepers = named.groupBy("root").agg(F.min("low").alias("low")).select("root", F.col("low.row").alias("keeper"))
    return marks.select("row", "ck"), named.select("ck", "root"), keepers


def _late_pairs(placed: DataFrame, sets: DataFrame, alike: Callable[[str, str], Column], similarity: float, save: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pairs (u, v) of different components that may still be similar enough.

    placed: (key, ck, fp, n, comp). The classes of buckets that still hold several components are
    joined among one another by exact bounds, without regard to the buckets. Only shingles that more
    than one component holds can count for a pair; a class with too few of these has no partner, so
    the lone relatives of a large group go before any pair is made. Of the others, two similar sets
    share one of their rarest shingles (prefix filter over the count of classes, rarest first), at a
    place that leaves room for the overlap that both lengths ask for; they meet by that shingle and
    by a band of lengths. The fingerprints' pigeonring chain prunes what meets.
    """
    placed = save(placed)
    mixed = save(
        placed.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("key")
    )
    classes = save(placed.join(mixed, "key").select("ck", "fp", "n", "comp").distinct())
    held = save(classes.select("ck", F.xxhash64("comp").alias("c")).join(sets, "ck").select("ck", "c", F.explode("own").alias("h")))
    spread = save(held.groupBy("h").agg(F.min("c").alias("a"), F.max("c").alias("b"), F.count("*").alias("df")).where("a <> b").select("h", "df"))
    rare = held.select("ck", "h").join(spread, "h").groupBy("ck").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("rare"))
    share = similarity / (1 + similarity)  # of both lengths together, what two similar sets have in common
    n, lone = F.col("n"), F.col("n") - F.size("rare")  # shingles that nobody shares stand first in the order
    prefix = F.floor(n - similarity * n + 1 + 1e-6) - lone
    able = save(classes.join(rare, "ck").where(prefix > 0).select("ck", "fp", "n", "comp", F.slice("rare", F.lit(1), prefix.cast("int")).alias("rare"), lone.alias("lone")))
    band = lambda x: F.floor(F.log(x.cast("double")) / np.log(BAND)).cast("int")
    # of a pair, the longer set asks (of two as long, the smaller class)
    reach = F.sequence(band(F.greatest(similarity * n - 1e-6, F.lit(1.0))), band(n))
    # the fewest shingles of a partner in the band, and the prefix that its overlap leaves
    least = F.greatest(F.pow(F.lit(BAND), F.col("band").cast("double")) - 1e-6, similarity * n - 1e-6)
    first = F.floor(n - share * (n + least) + 1 + 1e-6) - F.col("lone")
    asks = able.select("*", F.explode(reach).alias("band")).where(first > 0).select(
        "ck", "fp", "n", "comp", "lone", "band", F.posexplode(F.slice("rare", F.lit(1), first.cast("int"))).alias("at", "r"))
    asks = asks.select("ck", "fp", "n", "comp", "band", F.col("r.h").alias("h"), (F.col("lone") + F.col("at")).alias("at"))
    other = able.select("ck", "fp", "n", "comp", "lone", band(n).alias("band"), F.posexplode("rare").alias("at", "r"))
    other = other.select(F.col("ck").alias("ck2"), F.col("fp").alias("fp2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"), "band", F.col("r.h").alias("h"), (F.col("lone") + F.col("at")).alias("at2"))
    room = F.least(n - F.col("at"), F.col("n2") - F.col("at2")) >= share * (n + F.col("n2")) - 1e-6
    turn = (n > F.col("n2")) | ((n == F.col("n2")) & (F.col("ck") < F.col("ck2")))
    fits = (F.col("comp") != F.col("comp2")) & turn & room & alike("fp2", "n2")
    # members of a shingle's largest component meet only those outside it
    major = save(other.groupBy("h", "comp2").agg(F.count("*").alias("c")).groupBy("h").agg(F.max(F.struct("c", "comp2")).alias("m"), F.count("*").alias("comps"))
                 .where("comps > 1").select("h", F.col("m.comp2").alias("major")))
    asks, other = save(asks.join(major, "h")), save(other.join(major.withColumnRenamed("major", "major2"), "h"))
    out = asks.where("comp <> major").join(other, ["h", "band"]).where(fits).select("ck", "ck2")
    out = out.union(asks.where("comp = major").join(other.where("comp2 <> major2"), ["h", "band"]).where(fits).select("ck", "ck2"))
    return save(out.select(F.least("ck", "ck2").alias("u"), F.greatest("ck", "ck2").alias("v")).distinct())


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(row, keeper): for every row with words its key, and the row key of its group's smallest id.

    row is two 64-bit hashes of id and text. Groups are the components of word-shingle similarity >= `similarity`
    between different texts, verified on whole texts; equal word sequences are one class from the start.
    """
    with Scratch(docs.sparkSession) as save:
        marks, named, keepers = _groups(docs, id_col, text_col, words, similarity, save)
        return materialize(marks.join(save(named.join(save(keepers), "root").select("ck", "keeper")), "ck").select("row", "keeper"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without near copies: of each group the row of the smallest id stays, with all its columns.

    Defined cases: rows equal in id and text are one; null ids come last in a group; texts without
    words (and null texts) are nobody's copies and all stay; an empty table stays empty. Rows and
    equal texts are told apart by 128 bits.
    """
    with Scratch(docs.sparkSession) as save:
        stay = materialize(_groups(docs, id_col, text_col, words, similarity, save)[2].select(F.col("keeper").alias("_row")))
    worded = F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    marked = docs.select(F.struct("*").alias("_doc"), _row(id_col, text_col).alias("_row"), worded.alias("_worded"))
    kept = marked.where("_worded").join(stay, "_row").dropDuplicates(["_row"])
    return kept.select("_doc").unionByName(marked.where("not _worded").select("_doc")).select("_doc.*")
