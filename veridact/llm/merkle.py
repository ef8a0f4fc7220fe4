"""Merkle manifest of a dataset: a leaf a row, a tree a group of rows, and one root over the groups.

Levels are windows: rows partitioned by group and parent index, whose ordered full-frame
collect_list gives the parent's preimage and each row's siblings at once; one row of each parent
goes on to the next level. Every level is a third of the one below. Paths to the root then come
down again, level by level, from a parent to its few children. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.shared import numbered
from .common import Scratch, materialize

#: Children of a node.
FANOUT = 3

PATH = "array<struct<before:string,behind:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """A value as its length in UTF-8 bytes, a colon and itself; null as a dash."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def levels(nodes: DataFrame, save: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """The tree over nodes (g, pos, n, h): n nodes of group g at pos 0, 1, ... with their hashes.

    Returns for each level its nodes with before and behind (hashes of the siblings, joined), and the tops (g, h).
    Groups that have come down to one node take no part in further levels.
    """
    run = Window.partitionBy("g", "parent")
    whole = run.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found, tops = [], nodes.where("n = 1").select("g", "h")
    while not nodes.where("n > 1").isEmpty():
        rows = nodes.where("n > 1").withColumn("parent", F.floor(F.col("pos") / FANOUT))
        rows = rows.withColumn("run", F.collect_list("h").over(whole)).withColumn("own", (F.col("pos") % FANOUT).cast("int"))
        joined = lambda start, many: F.array_join(F.slice("run", start, many), "")
        level = save(rows.select(
            "g", "pos", "parent", "n", digest(F.array_join("run", "")).alias("up"),
            joined(F.lit(1), F.col("own")).alias("before"), joined(F.col("own") + 2, F.lit(FANOUT)).alias("behind")))
        found.append(level)
        # the first of each run stands for the parent
        nodes = level.where(F.col("pos") % FANOUT == 0).select("g", F.col("parent").alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"), F.col("up").alias("h"))
        tops = tops.union(nodes.where("n = 1").select("g", "h"))
    return found, save(tops)


def paths(found: list[DataFrame], above: DataFrame, save: Scratch) -> DataFrame:
    """(g, pos, path, subroot, root) of the lowest level's nodes: (before, behind) from the node up to the root.

    above: (g, path, subroot, root) of the groups' tops. Groups of one node are theirs at pos 0.
    """
    down = above.select("g", F.lit(0).cast("long").alias("pos"), "path", "subroot", "root")
    single = down
    for k, level in enumerate(reversed(found)):
        children = level.select("g", "pos", F.col("parent").alias("_p"), F.struct("before", "behind").alias("_s"))
        up = down.withColumnsRenamed({"g": "_g", "pos": "_q"})
        own = children.join(up, (F.col("g") == F.col("_g")) & (F.col("_p") == F.col("_q"))).select("g", "pos", F.concat(F.array("_s"), "path").alias("path"), "subroot", "root")
        # groups whose tree ends below this level join it as they are
        rest = single.join(level.select("g").distinct(), "g", "left_anti")
        down = own if k == len(found) - 1 else save(own.union(rest))
    return down.union(single.join(found[0].select("g").distinct(), "g", "left_anti")) if found else down


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, start, lambda h, s: digest(s["before"], h, s["behind"]))


def manifest(rows: DataFrame, leaf: Column, order: str, group: str, keep: tuple[str, ...] = (), check: Column | None = None) -> DataFrame:
    """The columns `keep`, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Each group's leaves ascend by `order`, groups by name (bytewise, null first). check: a leaf to be proved in place of
    the row's own (null or absent: its own): folded_root is what it leads to with the row's siblings. Defined
    cases: rows that tie in `order` ascend by leaf (null order first); repeated rows are leaves of their own; a null group is a group;
    an empty table gives an empty result; clashing names don't matter, as only named columns are read.
    """
    spark = rows.sparkSession
    with Scratch(spark) as save:
        own = rows.select(
            F.struct(*[F.col(c) for c in keep]).alias("kept") if keep else F.lit(None).cast("struct<_:int>").alias("kept"), F.col(order).alias("o"),
            # null sorts before any name
            F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("g"), leaf.alias("h"), F.coalesce(check if check is not None else leaf, leaf).alias("c"))
        placed = numbered(save(own), ["g"], [F.col("o"), F.col("h"), F.col("c")], "at")
        placed = save(placed.withColumn("pos", F.col("at") - 1).drop("at", "o"))
        sizes = save(placed.groupBy("g").agg(F.count("*").alias("n")))
        inner, subroots = levels(placed.select("g", "pos", "h").join(sizes, "g"), save)
        count = subroots.count()
        upper = numbered(subroots, [], [F.col("g")], "at").select(F.col("g").alias("name"), F.lit("").alias("g"), (F.col("at") - 1).alias("pos"), F.lit(count).cast("long").alias("n"), "h")
        upper = save(upper)
        outer, top = levels(upper.drop("name"), save)
        root = top.select("g", F.array().cast(PATH).alias("path"), F.col("h").alias("subroot"), F.col("h").alias("root"))
        tops = save(paths(outer, root, save).select("pos", "path", "root").join(upper.select("name", "pos", F.col("h").alias("subroot")), "pos").select(F.col("name").alias("g"), "path", "subroot", "root"))
        proved = placed.join(paths(inner, tops, save), ["g", "pos"])
        proof = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["behind"])), "")
        back = folded(F.col("c"), F.col("path"))
        # what is returned outlives the scratch tables, so it is written without the paths
        return materialize(proved.select("kept", F.col("h").alias("leaf"), "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), back.alias("folded_root"))).select(
            *([F.col(f"kept.`{c}`").alias(c) for c in keep]), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def document_leaf(text: Column) -> Column:
    """The leaf of a row of documents whose text is the one given."""
    return digest(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text))


def documents(docs: DataFrame) -> DataFrame:
    """The manifest of documents by source; rows whose checksum of doc_id is even are checked as if their line breaks were lost."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit("")))
    return manifest(docs, document_leaf(F.col("text")), "doc_id", "source", keep=("doc_id",), check=F.when(even, document_leaf(tampered)))


_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda x, y: list_reduce(list_prepend(xor(x, y), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda u, v: xor(u >> 1, 3988292384 * (u & 1)) + v))"""

#: DuckDB's rows of documents(): levels by recursion, siblings by each node's run, roots by folding.
ORACLE = f"""
WITH RECURSIVE field AS (
  SELECT doc_id, source, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, xor({_CRC}, 4294967295) % 2 = 0 AS even FROM documents),
leaves AS (
  SELECT doc_id, coalesce('=' || source, '-') AS g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
    CASE WHEN even THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS c FROM field),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h, c) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
tree AS (
  SELECT 0 AS k, g, pos, n, h FROM placed
  UNION ALL
  SELECT k + 1, g, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY k, g, pos // 3, n),
subs AS (SELECT g AS name, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
upper_tree AS (
  SELECT 0 AS k, pos, n, h FROM subs
  UNION ALL
  SELECT k + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM upper_tree WHERE n > 1 GROUP BY k, pos // 3, n),
runs AS (
  SELECT k, g, pos // 3 AS parent, list(h ORDER BY pos) AS hs FROM tree WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT k + 1000, name, pos // 3, hs FROM (SELECT k, pos // 3 AS parent, list(h ORDER BY pos) AS hs FROM upper_tree WHERE n > 1 GROUP BY ALL) u JOIN (SELECT name, pos, k AS level FROM subs, (SELECT DISTINCT k FROM upper_tree WHERE n > 1)) s ON u.k = s.level AND u.parent = (s.pos // (3 ** (s.level + 1))::BIGINT)),
steps AS (
  SELECT p.g, p.pos, r.k, r.hs, (p.pos // (3 ** r.k)::BIGINT) % 3 AS i FROM placed p JOIN runs r ON r.k < 1000 AND p.g = r.g AND r.parent = p.pos // (3 ** (r.k + 1))::BIGINT
  UNION ALL
  SELECT p.g, p.pos, r.k, r.hs, (s.pos // (3 ** (r.k - 1000))::BIGINT) % 3 FROM placed p JOIN subs s ON s.name = p.g JOIN runs r ON r.k >= 1000 AND r.g = p.g),
way AS (SELECT g, pos, list(array_to_string(hs[:i], '') || '|' || array_to_string(hs[i + 2:], '') ORDER BY k) AS path FROM steps GROUP BY g, pos)
SELECT doc_id, p.h AS leaf, s.h AS subroot, r.h AS root, sha256(coalesce(replace(array_to_string(path, ''), '|', ''), '')) AS proof_sha256,
  list_reduce(list_prepend(p.c, coalesce(path, []::VARCHAR[])), lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root, folded_root = r.h AS verified
FROM placed p JOIN subs s ON s.name = p.g JOIN upper_tree r ON r.n = 1 LEFT JOIN way w ON w.g = p.g AND w.pos = p.pos
"""
