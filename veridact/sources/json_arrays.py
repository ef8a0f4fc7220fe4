"""JSON arrays in files of any size: Spark's text reader splits a file at every closing brace, and many
tasks put the elements together. Quotes and depth at a split's start are settled from the splits before it."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.contracts import assert_none
from ..operators.records import KNOWN_FIELDS, fields_found
from ..operators.shared import cut_lineage
from ..schemas import ContractError

_MARK = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
_GAP = re.compile(r"[\s,\ufeff]*")
_ESCAPE = re.compile(r"\\.", re.DOTALL)
#: What lies outside the strings of one whole element without objects in it, from its separator to its brace.
_PLAIN = re.compile(r"[\s,\ufeff]*\{[^{}\[\]]*(?:\[[^{}\[\]]*\][^{}\[\]]*)*\}")


def present(spark: SparkSession, **paths: str) -> None:
    """ContractError that names every input, by its keyword, whose path does not exist."""
    lost = []
    for name, path in paths.items():
        try:
            spark.read.text(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            lost.append(f"{name} ({path} does not exist)")
    if lost:
        raise ContractError(f"missing input: {', '.join(lost)}")


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, start): texts between closing braces, in order within their split, which starts at byte `start`."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, quotes, outer, inner): quotes of a split, and what its brackets add to the depth, if it starts outside or inside a string."""
    seen: dict[tuple[str, int], list[int]] = {}
    for b in batches:
        for value, file, start in zip(*(c.to_pylist() for c in b.columns)):
            t = seen.setdefault((file, start), [0, 0, 0])
            parts = _ESCAPE.sub("", value + "}").split('"')
            for i in (0, 1):
                some = "".join(parts[i::2])
                t[1 + (t[0] + i) % 2] += some.count("{") + some.count("[") - some.count("}") - some.count("]")
            t[0] += len(parts) - 1
    rows = [(*k, *t) for k, t in seen.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if i == 0 else pa.int64()) for i in range(5)], ["file", "start", "quotes", "outer", "inner"])


def _states(fragments: DataFrame) -> DataFrame:
    """(file, start, inside, depth) at each split's start, a row a split; a file that isn't one closed array stops.

    The text behind the last brace is counted with a brace that isn't there, so a closed array ends at -1.
    """
    splits = cut_lineage(fragments.mapInArrow(_tally, "file string, start long, quotes long, outer long, inner long"))
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    splits = cut_lineage(splits.withColumn("change", F.when(F.col("inside"), F.col("inner")).otherwise(F.col("outer"))))
    whole = splits.groupBy("file").agg(F.sum("change").alias("depth"), (F.sum("quotes") % 2).alias("open_string"))
    assert_none(whole.where("depth <> -1 or open_string = 1"), "not one closed JSON array")
    return splits.select("file", "start", "inside", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, begins, ends, json): elements, and the parts of those that go over a split's ends."""
    at = None
    inside, depth, begins, parts = False, 0, True, []
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
        made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["file", "start", "begins", "ends", "json"])
        out.clear()
        return made

    def stray(text: str) -> None:
        if not _GAP.fullmatch(text):
            out.append((*at, True, True, text))

    for b in batches:
        for value, file, start, was_inside, was_deep in zip(*(c.to_pylist() for c in b.columns)):
            if (file, start) != at:
                if parts:
                    out.append((*at, begins, False, "".join(parts)))
                if was_deep is None:
                    raise ValueError(f"{file} was split otherwise when it was read again")
                at, inside, depth, begins, parts = (file, start), was_inside, was_deep, was_deep < 2, []
            text, pos = value + "}", 0
            if depth == 1 and not inside and not parts:
                pieces = _ESCAPE.sub("", text).split('"')
                if len(pieces) % 2 and _PLAIN.fullmatch("".join(pieces[0::2])) and _GAP.fullmatch(text[: text.index("{")]):  # one whole element, as most are
                    out.append((*at, True, True, text[text.index("{") :]))
                    begins = True
                    continue
            for m in _MARK.finditer(text):
                c = m.group()
                if c == '"':
                    inside = not inside
                elif inside or c[0] == "\\":
                    continue
                elif c in "{[":
                    if depth < 2:
                        stray(text[pos : m.start()])
                        pos = m.start() if depth else m.end()
                    depth += 1
                else:
                    depth -= 1
                    if depth == 1:
                        out.append((*at, begins, True, "".join([*parts, text[pos : m.end()]])))
                        begins, parts, pos = True, [], m.end()
                    elif depth < 1:
                        stray(text[pos : m.start()])
                        pos = m.end()
            if depth > 1:
                parts.append(text[pos:])
            else:
                stray(text[pos:])
        yield batch()
    if parts:
        out.append((*at, begins, False, "".join(parts)))
    yield batch()


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, json) of every element of the arrays in path (a file, a folder or a pattern), in no order.

    Tasks take splits of spark.sql.files.maxPartitionBytes; only elements that go over a split's end are shuffled. What
    isn't an object comes out as it stands, as one or more texts that are no object. Files without a byte hold no element.
    The splits' states are broadcast: about 100 bytes a split. A path that lacks, and a file that isn't one closed array, stop.
    """
    present(spark, input=path)
    fragments = _fragments(spark, path)
    states = cut_lineage(_states(fragments))
    known = fragments.join(F.broadcast(states), ["file", "start"], "left").select("value", "file", "start", "inside", "depth")
    found = cut_lineage(known.mapInArrow(_walk, "file string, start long, begins boolean, ends boolean, json string"))
    whole = found.where("begins and ends").select("file", "json")
    # a part without its beginning ends an earlier split's element; in a split it comes before the part that begins one
    order = Window.partitionBy("file").orderBy("start", F.col("begins").asc())
    parts = found.where("not (begins and ends)").withColumn("_n", F.sum(F.col("begins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = parts.groupBy("file", "_n").agg(F.array_sort(F.collect_list(F.struct("start", "json"))).alias("_p"))
    return whole.unionByName(joined.select("file", F.array_join(F.transform("_p", lambda p: p["json"]), "").alias("json")))


def read(spark: SparkSession, path: str, schema: str, known: tuple[str, ...] = KNOWN_FIELDS) -> DataFrame:
    """The elements of path's arrays under a closed schema, as a table in the shared folder.

    Fields are checked in the pass that parses: a field beyond `known`, one that a row lacks, an element that is no object
    and a value of another type stop.
    """
    check = Observation()
    violations = fields_found(F.col("json"), known)
    rows = elements(spark, path).withColumn("_v", violations)
    rows = rows.observe(check, F.count(F.when(F.size("_v") > 0, 1)).alias("bad"), F.min(F.when(F.size("_v") > 0, F.to_json("_v"))).alias("first"))
    parsed = cut_lineage(rows.select(F.from_json(F.when(F.size("_v") == 0, F.col("json")), schema, {"mode": "FAILFAST"}).alias("r")).select("r.*"))
    if check.get["bad"]:
        raise ContractError(f"fields out of contract: {check.get['bad']} rows, such as {check.get['first']}")
    return parsed


def write(df: DataFrame, path: str) -> None:
    """df as files of one array each, a file a partition; fields that are null are written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "["
        for b in batches:
            lines = b.column(0).to_pylist()
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array([f"{mark if i == 0 else ','}{x}" for i, x in enumerate(lines)], pa.string())], ["value"])
                mark = ","
        yield pa.RecordBatch.from_arrays([pa.array(["]" if mark == "," else "[]"])], ["value"])

    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).mapInArrow(run, "value string").write.mode("overwrite").text(path)
