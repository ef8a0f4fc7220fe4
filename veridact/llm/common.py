"""Shared helpers of the training-data operators: scratch tables, graph components, spans."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space as the word contracts have it: space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a session on this machine alone gets a temporary folder; a cluster is refused.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is unset; a cluster needs a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="veridact-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read, not a recomputation, and so that
    joins on the result start from plain exchanges, which AQE can split when a key is hot.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/veridact-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Writes tables as materialize() does and deletes them when its block ends.

    What a result reads after the block goes through materialize() instead.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{scratch_dir(spark)}/veridact-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_: object) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that a worker holds few texts as Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def hash_sample(df: DataFrame, n: int, *by: str) -> DataFrame:
    """About n rows of df, at most 2n, the same on every run: those with the smallest hashes of `by`.

    The rows are counted first and filtered by a hash bound, so that the tasks together send the
    driver about n rows, however many tasks there are.
    """
    total = df.count()
    share = min(1.0, 1.25 * n / max(total, 1))
    h = F.xxhash64(*by)
    if share < 1.0:
        df = df.where(h < F.lit(int(share * 2**64) - 2**63))
    return df.orderBy(h, *by).limit(n)


def _stars(e: DataFrame) -> bool:
    """Whether every node of e (u > v) either points to one other node or is pointed to, not both."""
    ends = e.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        e.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    odd = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or (out = 1 and into = 1)")
    return odd.agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame, save: Callable[[DataFrame], DataFrame] = materialize) -> DataFrame:
    """Connected components of an undirected graph as (node, root), root the smallest node.

    edges: columns u, v of one sortable type. Large-star and small-star steps alternate until the graph is a forest
    of stars; rounds grow with the logarithm of the diameter. Every minimum is pre-aggregated and
    written by save before it is joined back, so a hub with a third of the edges is split by AQE. The minima grow
    with the graph, so they are merged, never broadcast: the driver holds no part of the graph.
    Nodes without edges aren't in the result; empty edges give an empty result.
    """
    e = save(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while not _stars(e):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = save(both.join(low.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = save(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = save(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def spans_text(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
