import glob
import hashlib
import os
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from veridact.llm import merkle
from veridact.llm.queries import ORACLES, op12_merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)])


def climb(hashes):
    """(top, the siblings of each as (before, behind) level by level)."""
    ways = [[] for _ in hashes]
    level, owners = list(hashes), [[i] for i in range(len(hashes))]
    while len(level) > 1:
        up, own = [], []
        for at in range(0, len(level), 3):
            run = level[at : at + 3]
            for i in range(len(run)):
                for d in owners[at + i]:
                    ways[d].append(("".join(run[:i]), "".join(run[i + 1 :])))
            up.append(h(*run))
            own.append([d for o in owners[at : at + 3] for d in o])
        level, owners = up, own
    return level[0], ways


def brute(rows):
    by = {}
    for r in rows:
        own = leaf(r, r[1])
        even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        by.setdefault(r[3], []).append((r[0], own, leaf(r, r[1].replace("\n", "")) if even and r[1] is not None else own))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops, ways = {}, {}
    for s in names:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        tops[s], ways[s] = climb([x[1] for x in by[s]])
    root, upper = climb([tops[s] for s in names]) if names else (None, [])
    out = []
    for s, more in zip(names, upper):
        for (d, own, tampered), way in zip(by[s], ways[s]):
            at = tampered
            for before, behind in way + more:
                at = h(before, at, behind)
            out.append((d, own, tops[s], root, h(*[a + b for a, b in way + more]), at, at == root))
    return out


def plain(rows):
    return sorted(tuple(r) for r in rows) if all(r[0] is not None for r in rows) else sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, *(str(x) for x in r)))


@pytest.mark.parametrize("seed, n, sources", [(0, 1, 1), (1, 2, 1), (2, 40, 1), (3, 100, 4), (4, 60, 11), (5, 30, 30)])
def test_trees_of_any_shape(spark, seed, n, sources):
    rnd = random.Random(seed)
    names = [None, "", "é", "Z", "a", *map(str, range(sources))][:sources]
    rows = [(i, rnd.choice(["a\nb", "ab", "", None, "é\n\n"]), rnd.choice(["en", None]), rnd.choice(names), rnd.choice([3, None])) for i in range(n)]
    got = merkle.documents(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert plain(got.collect()) == plain(brute(rows))


def test_unusual_rows(spark):
    rows = [(None, "x\ny", "en", "s", 3), (None, "x\ny", "en", "s", 3), (5, None, None, None, None), (5, "b", "en", "s", 1), (5, "a", "en", "s", 1), (5, "a", "en", "s", 1), (-7, "a" * 100_000 + "\n", "de", "s", 9), (12, "-", "-", "-", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    wide = docs.select("*", F.lit(1).alias("pos"), F.lit(2).alias("g"), F.lit("z").alias("leaf"), F.lit("r").alias("root"), F.lit(3).alias("n"), F.lit(4).alias("kept"))
    want = plain(brute(rows))
    assert plain(merkle.documents(docs).collect()) == want and plain(merkle.documents(wide).collect()) == want
    assert merkle.documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_other_tables_and_proofs(spark):
    """A manifest of any columns; a forged leaf doesn't lead to the root."""
    rows = spark.range(50).select(F.col("id"), (F.col("id") % 3).alias("part"))
    leaf_of = merkle.digest(merkle.field(F.col("id")))
    got = merkle.manifest(rows, leaf_of, "id", "part", keep=("id", "part")).collect()
    assert len(got) == 50 and all(r.verified for r in got) and len({r.root for r in got}) == 1 and len({r.subroot for r in got}) == 3
    forged = merkle.manifest(rows, leaf_of, "id", "part", keep=("id",), check=F.when(F.col("id") == 7, F.lit("0" * 64))).collect()
    assert {r.id for r in forged if not r.verified} == {7} and {r.root for r in forged} == {got[0].root}


def test_query_against_brute_force_and_sql(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = plain(op12_merkle_manifest(spark, d).collect())
    assert got == plain(brute(rows)) and 0 < sum(r[-1] for r in got) < len(got)
    con = duckdb.connect()
    for p in glob.glob(f"{d}/documents.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    assert sorted(con.execute(ORACLES["op12_merkle_manifest"]).fetchall()) == got
