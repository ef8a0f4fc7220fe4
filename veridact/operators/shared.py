"""Tables in the shared folder, and ranks inside groups of any size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder of spark.checkpoint.dir.

    Where it is unset, a session on this machine alone gets a temporary folder; a cluster is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is unset; a cluster needs a folder that all executors share")
        root = tempfile.mkdtemp(prefix="veridact-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root}/veridact-{uuid.uuid4().hex}"


#: Rows that one task aggregates or sorts, about, and rows of a scratch table's file.
TASK_ROWS, FILE_ROWS = 250_000, 50_000

#: Tasks of a shuffle (spark.shuffle.sort.bypassMergeThreshold) beyond which those that write it keep all rows they read to sort them.
UNSORTED = 200


def cut_lineage(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder.

    Readers deal files by bytes, and narrow columns take next to none, so a task would hold more rows the larger the table.
    Each file counts for spark.sql.files.openCostInBytes at least, so a task reads 32 of them at most: 1.6 million rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df dealt by keys over tasks of about TASK_ROWS of its `rows`; small ones stay as they are.

    Shuffles have a fixed number of partitions, so what a task holds would grow with the input.
    """
    n = -(-rows // TASK_ROWS)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def tasks(spark: SparkSession, rows: int) -> int:
    """Tasks of about TASK_ROWS rows, as many as a shuffle has at least."""
    return max(-(-rows // TASK_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread_table(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """spread() of columns of a given table.

    A task reads as much of a given file as fits its bytes, millions of narrow rows. Where a shuffle would have it keep them all, they
    are written to a scratch table first.
    """
    n = tasks(df.sparkSession, rows)
    many = n > UNSORTED and rows > 32 * FILE_ROWS * df.rdd.getNumPartitions()
    return spread(cut_lineage(df) if many else df, rows, *keys)


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Null-safe equality of the columns `names` with the right side's, there called _r0, _r1, ..."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_r{i}"]) for i, c in enumerate(names)])


def numbered(df: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """df with name long: 1, 2, ... in order within each group of `by`; the order must be total.

    Rows are dealt by ranges of (group, order), numbered inside their range, and raised by the rows of
    the group's earlier ranges, so a group with a third of all rows is shared by many tasks.
    """
    return dealt(df, by, order, {name: []})


def dealt(df: DataFrame, by: list[str], order: list[Column], names: dict[str, list[str]]) -> DataFrame:
    """numbered() under several names at once: each counts within the groups of `by` and its own further columns.

    df is read twice (its ranges are drawn by sampling), so it should be a table. Ranges hold about TASK_ROWS rows.
    """
    n = tasks(df.sparkSession, df.count())
    ranges = df.repartitionByRange(n, *map(F.col, by), *order).withColumn("_part", F.spark_partition_id())
    rows = ranges = cut_lineage(ranges)  # they must not be drawn twice
    if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        rows = rows.repartition(n, *by, "_part")
    for i, (name, more) in enumerate(names.items()):
        rows = rows.withColumn(name, F.row_number().over(Window.partitionBy(*by, *more, "_part").orderBy(*order)))
    for name, more in names.items():
        counts = ranges.groupBy(*by, *more, "_part").agg(F.count("*").alias("_n"))
        earlier = Window.partitionBy(*by, *more).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        keys = [*by, *more, "_part"]
        before = cut_lineage(counts.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(keys)], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
        rows = rows.join(before, same(rows, before, keys)).withColumn(name, F.col("_before") + F.col(name)).drop(*[c for c in before.columns])
    return rows.select(*df.columns, *names)


def percent_below(df: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """df with name double: the share of the group's other rows that are strictly lower; null is lowest.

    Rows are counted by value first, so the running sums go over distinct values only.
    """
    counts = df.groupBy(by, value).agg(F.count("*").alias("_n"))
    group = Window.partitionBy(by)
    lower = F.coalesce(F.sum("_n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    others = F.sum("_n").over(group) - 1
    share = F.when(others > 0, lower / others).otherwise(0.0)
    shares = cut_lineage(counts.select(F.col(by).alias("_r0"), F.col(value).alias("_r1"), share.alias(name)))
    return df.join(shares, same(df, shares, [by, value])).drop("_r0", "_r1")


def _stars(e: DataFrame) -> bool:
    """Whether every node of e (u > v) either points to one other node or is pointed to, not both."""
    ends = e.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(e.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or (out = 1 and into = 1)").isEmpty()


def linked(edges: DataFrame, save: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """Connected components of edges (u, v) as (node, root), root the smallest node; nodes without edges aren't in it.

    Large-star and small-star steps alternate until the graph is a forest of stars: rounds grow with the logarithm of the
    longest path. Minima are pre-aggregated and saved before they are joined back.
    """
    e = save(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _stars(e):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = save(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = save(large.groupBy("u").agg(F.min("v").alias("m")))
        e = save(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
