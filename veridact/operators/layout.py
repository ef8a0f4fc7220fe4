"""Ranked verbatim evidence of each cell and aspect, cut to a few quotes without losing a direction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import date_rank
from ..schemas import MAX_QUOTES
from . import claims
from .shared import cut_lineage, same, tasks


def ranked_quotes(member: DataFrame, tags: DataFrame, cell: list[str]) -> DataFrame:
    """Every quote of a cell and aspect with its rank, and its place among those of its polarity.

    Only what ranks and names a quote is carried; texts are joined to the few that are shown.
    """
    return ranked_told(cut_lineage(_packed(member, tags, cell)), cell, F.col("cells"))


def ranked_told(told: DataFrame, cell: list[str], cells: Column) -> DataFrame:
    """ranked_quotes() of claims.told(), a table; cells are a review's, as arrays of the fields of cell[1:].

    A review has one place in the order, whatever its cells: reviews are dealt by ranges of (cell[0], order), ranges of about
    TASK_ROWS quotes, and a range's quotes are made and numbered in its task, by the review's place in it. Each number is
    raised by the quotes of earlier ranges, so a group of any size is shared by many tasks. Polarities are few.
    """
    by = [*cell, "aspect"]
    told = told.where("said is not null").withColumn("_date", date_rank(F.col("review_date")))
    order = [F.desc("trust_score"), F.asc("_date"), F.asc("review_id")]
    n = tasks(told.sparkSession, claims.told_rows(told, cells))
    ranges = cut_lineage(told.repartitionByRange(n, F.col(cell[0]), *order).withColumn("_part", F.spark_partition_id()))  # they must not be drawn twice
    keys = ["_part", *by, "polarity"]
    counts = cut_lineage(claims.apart(ranges, ["_part", cell[0]], cells).groupBy(*keys).agg(F.count("*").alias("_n")))
    earlier = lambda *own: F.coalesce(F.sum("_n").over(Window.partitionBy(*own).orderBy("_part").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = cut_lineage(counts.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(keys)], earlier(*by).alias("_all"), earlier(*by, "polarity").alias("_own")))
    placed = ranges.repartitionById(n, "_part").withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    rows = claims.apart(placed, ["_part", cell[0], "review_id", "trust_score", "review_date", "_place"], cells)
    here = Window.partitionBy("_part", *by).orderBy("_place")
    known = [F.col("polarity").eqNullSafe(F.lit(p)) for (p,) in counts.select("polarity").distinct().collect()]
    count = lambda p: F.count(F.when(p, 1)).over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_n", F.row_number().over(here)).withColumn("_p", F.coalesce(*[F.when(p, count(p)) for p in known], F.lit(0)))
    rows = rows.join(before, same(rows, before, keys))
    return rows.select("review_id", *cell, "trust_score", "review_date", "aspect", "polarity", (F.col("_all") + F.col("_n")).alias("quote_rank"), (F.col("_own") + F.col("_p")).alias("polarity_rank"))


#: Reviews of a product's first step, about; each further one has as many as all before it.
STEP_ROWS = 1024


def _steps(told: DataFrame, lead: str) -> DataFrame:
    """told with _step, higher for what comes first, in the order of rank_order(): NaN first, null last.

    Steps are drawn from counts of the scores' ten-thousandths, by month where all of one share a score, so the first ones
    are small though most reviews may have one score, and they are few.
    """
    score = F.col("trust_score")
    fine = told.withColumn("_fine", F.when(score.isNull(), -(1 << 62)).when(F.isnan(score), 1 << 62).otherwise(F.round(score * 10_000).cast("long"))).withColumn("_month", F.substring("_date", 1, 7))
    counts = fine.groupBy(lead, "_fine", "_month").agg(F.count("*").alias("_n"), F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    of = Window.partitionBy(lead, "_fine")
    counts = counts.withColumn("_by", F.when(F.min("_lo").over(of).eqNullSafe(F.max("_hi").over(of)), F.col("_month")))
    upto = F.sum("_n").over(Window.partitionBy(lead).orderBy(F.desc("_fine"), F.asc("_by")))  # peers count together
    before = upto - F.sum("_n").over(Window.partitionBy(lead, "_fine", "_by"))
    keys = [lead, "_fine", "_month"]
    steps = cut_lineage(counts.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(keys)], (-F.floor(F.log2(before / STEP_ROWS + 1))).alias("_step")))
    return fine.join(steps, same(fine, steps, keys)).select(*told.columns, "_step")


def first_quotes(member: DataFrame, tags: DataFrame, cell: list[str], k: int = MAX_QUOTES) -> DataFrame:
    """Of ranked_quotes() the rows that truncate() can keep: the k first of each cell and aspect, and each polarity's first."""
    return first_told(cut_lineage(_packed(member, tags, cell)), cell, F.col("cells"), k)


def _packed(member: DataFrame, tags: DataFrame, cell: list[str]) -> DataFrame:
    """claims.told() of members: a row for each review and cell[0], with cells, an array of the rest of cell. Reviews without a tag are left out."""
    rest = F.struct(*cell[1:]) if cell[1:] else F.struct(F.lit(True).alias("_cell"))
    rows = member.groupBy(cell[0], "review_id", "trust_score", "review_date").agg(F.collect_list(rest).alias("cells"))
    return claims.told(rows, tags).where("said is not null")


def first_told(told: DataFrame, cell: list[str], cells: Column, k: int = MAX_QUOTES) -> DataFrame:
    """first_quotes() of claims.told(), a table; cells are a review's, as arrays of the fields of cell[1:].

    Rows are counted by steps of score and date first; only those of the steps that hold a group's k first, or a polarity's
    first, are sorted, so no task sorts all rows. A polarity's first beyond the k is numbered by the counts of the steps
    before it and by what stands before it in its own. Rows that tie in score and date go by review_id; null
    scores are last.
    """
    by = [*cell, "aspect"]
    keep = [cell[0], "review_id", "trust_score", "review_date", "_date", "_step"]
    told = _steps(told.where("said is not null").withColumn("_date", date_rank(F.col("review_date"))), cell[0])  # the date's rank is computed once, not at each comparison
    taken = lambda some: claims.apart(some, keep, cells).select("review_id", *cell, "trust_score", "review_date", "aspect", "polarity", "_date", "_step")
    counts = cut_lineage(taken(told).groupBy(*by, "polarity", "_step").agg(F.count("*").alias("_n")))
    above = Window.partitionBy(*by).orderBy(F.desc("_step"))  # peers count together
    reached = counts.withColumn("_sum", F.sum("_n").over(above)).withColumn("_all", F.sum("_n").over(Window.partitionBy(*by)))
    last = F.max(F.when(F.col("_sum") >= F.least(F.lit(k), F.col("_all")), F.col("_step"))).over(Window.partitionBy(*by))
    limits = reached.withColumn("_last", last).groupBy(*by, "polarity").agg(F.least(F.max("_step"), F.max("_last")).alias("_low"))
    keys = [*by, "polarity"]
    limits = cut_lineage(limits.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(keys)], "_low"))
    lowest = limits.groupBy("_r0").agg(F.min("_low").alias("_least"))  # most reviews are below all of their product's, and aren't taken apart
    some = taken(told.join(lowest, same(told, lowest, cell[:1])).where("_step >= _least").select(*told.columns))
    order = [F.desc("trust_score"), F.asc("_date"), F.asc("review_id")]
    rows = cut_lineage(some.join(limits, same(some, limits, keys)).where("_step >= _low").select(*some.columns))
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    top = rows.withColumn("quote_rank", place(*by)).where(F.col("quote_rank") <= k)  # cast behind the limit, or Spark doesn't see it
    top = cut_lineage(top.withColumn("quote_rank", F.col("quote_rank").cast("long")))
    firsts = rows.withColumn("_f", place(*by, "polarity")).where("_f = 1").drop("_f")
    late = cut_lineage(firsts.join(top.select(*by, "polarity").distinct(), [*by, "polarity"], "left_anti").select(*rows.columns))
    score = F.col("trust_score")
    at = F.struct(F.when(score.isNull(), 2).when(F.isnan(score), 0).otherwise(1), -score, F.col("_date"), F.col("review_id"))
    marks = cut_lineage(late.select(*by, F.col("polarity").alias("_p"), at.alias("_at"), F.col("_step").alias("_s")))
    near = taken(told.join(marks.select(cell[0], F.col("_s").alias("_step")).distinct(), [cell[0], "_step"], "left_semi"))
    inside = near.join(marks.withColumn("_step", F.col("_s")), [*by, "_step"]).where(at < F.col("_at")).groupBy(*by, "_p").agg(F.count("*").alias("_n"))
    higher = counts.join(marks, by).where(F.col("_step") > F.col("_s")).select(*by, "_p", "_n")
    before = inside.union(higher).groupBy(*by, F.col("_p").alias("polarity")).agg((F.sum("_n") + 1).alias("quote_rank"))
    found = top.unionByName(late.join(before, [*by, "polarity"]).select(*top.columns)).drop("_date", "_step")
    return found.withColumn("polarity_rank", F.row_number().over(Window.partitionBy(*by, "polarity").orderBy("quote_rank")).cast("long"))


def truncate(quotes: DataFrame, cell: list[str], k: int = MAX_QUOTES) -> DataFrame:
    """The k first quotes, where each polarity without one gets its first in, for the lowest of the
    most frequent. Only rows that can stay take part: the k first and each polarity's first.

    For at most three polarities and k >= 3 the turns have a closed form: every promoted polarity
    takes the last place of the then largest; ties go to the first in text order.
    """
    if k < 3:
        raise ValueError("k must be at least the number of polarities")
    by = [*cell, "aspect"]
    near = quotes.where((F.col("quote_rank") <= k) | (F.col("polarity_rank") == 1))
    whole = Window.partitionBy(*by)
    inside = F.col("quote_rank") <= k
    names = ("negative", "neutral", "positive")
    have = F.array(*[F.count(F.when(inside & (F.col("polarity") == p), 1)).over(whole) for p in names])
    there = F.array(*[F.max(F.col("polarity") == p).over(whole) for p in names])
    near = near.select("*", have.alias("_have"), there.alias("_there"))

    def turn(state: Column, p: Column) -> Column:
        """Polarity number p takes a place of the most frequent one if it has none."""
        gets = F.get("_there", p) & (F.get(state["have"], p) == 0)
        most = F.array_position(state["have"], F.array_max(state["have"])) - 1
        moved = F.transform(state["have"], lambda n, i: n - F.when(gets & (i == most), 1).otherwise(0) + F.when(gets & (i == p), 1).otherwise(0))
        return F.struct(moved.alias("have"), F.concat(state["got"], F.array(gets)).alias("got"))

    start = F.struct(F.col("_have").alias("have"), F.array().cast("array<boolean>").alias("got"))
    near = near.withColumn("_end", F.aggregate(F.array(*map(F.lit, range(len(names)))), start, turn))
    own = (F.array_position(F.array(*map(F.lit, names)), F.col("polarity")) - 1).cast("int")
    near = near.withColumn("reserved", F.get("_end.got", own)).withColumn("_places", F.get("_end.have", own))
    keep = F.when(F.col("reserved"), F.col("polarity_rank") == 1).otherwise(inside & (F.col("polarity_rank") <= F.col("_places")))
    return near.where(keep).drop("_have", "_there", "_end", "_places")


def render(claims: DataFrame, quotes: DataFrame, cell: list[str]) -> DataFrame:
    """claims with layout, the five stages as text: subject, condition, evidence, direction, sufficiency.

    claims: cell, aspect, subject, pos, neg, direction, spoke, cell_authors, silent, support, reason;
    quotes: what truncate() keeps, with polarity, review_id, quote_rank, reserved. A claim has
    MAX_QUOTES quotes at most. Claims without quotes have no layout and are left out.
    """
    by = [*cell, "aspect"]
    mark = F.when(F.col("reserved"), F.lit(" *")).otherwise("")
    line = F.format_string("  %d. [%s] %d%s", F.col("quote_rank"), F.col("polarity"), F.col("review_id"), mark)
    packed = quotes.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("quote_rank", line.alias("line")))).alias("q"))
    text = F.concat_ws(
        "\n", F.concat_ws(" ", F.lit("[1]"), F.col(cell[0]), F.col("aspect")), F.concat_ws(" ", F.lit("[2]"), F.col("subject")),
        F.format_string("[3] %d", F.size("q")), F.array_join(F.transform("q", lambda x: x["line"]), "\n"),
        F.format_string("[4] %s +%d -%d / %d", F.col("direction"), F.col("pos"), F.col("neg"), F.col("spoke")),
        F.format_string("[5] U=%d D=%d S=%d (%d) %s", F.col("support"), F.col("spoke"), F.col("cell_authors"), F.col("silent"), F.coalesce("reason", F.lit("passed"))),
    )
    return claims.join(packed, by).withColumn("layout", text).drop("q")


def totals(rows: DataFrame, cell: list[str]) -> DataFrame:
    """(cell, aspect, quotes, first_month, last_month) of all quotes, those that aren't shown too. rows: cells joined with tags, with month.

    Months are counted first: the least and the last of texts are found by sorting, and there are few months.
    """
    months = rows.groupBy(*cell, "aspect", "month").agg(F.count("*").alias("_n"))
    return months.groupBy(*cell, "aspect").agg(F.sum("_n").alias("quotes"), F.min("month").alias("first_month"), F.max("month").alias("last_month"))


def arranged(claims: DataFrame, shown: DataFrame, found: DataFrame, cell: list[str]) -> DataFrame:
    """(cell, aspect, subject, condition, evidence, direction, sufficiency): the five stages as structs, numbered in their order.

    claims: as for render(); shown: truncate()'s rows; found: totals(). evidence holds how many quotes there are, are
    shown and were omitted, the months of all of them, the reviews that stand in for a direction, and the quotes in order
    of rank. A claim shows MAX_QUOTES at most. Claims without a quote have no layout (arrangement_violations() names them).
    """
    by = [*cell, "aspect"]
    quote = F.struct("quote_rank", "polarity", "review_id", "reserved")
    packed = shown.groupBy(*by).agg(F.array_sort(F.collect_list(quote)).alias("_q"))
    rows = claims.join(packed, by).join(found, by)
    stage = lambda n: F.lit(n).alias("stage")
    held = F.array_sort(F.transform(F.filter("_q", lambda q: q["reserved"]), lambda q: q["review_id"]))
    return rows.select(
        *by, F.struct(stage(1), F.col(cell[0]).alias("product_id"), F.col("aspect").alias("aspect")).alias("subject_stage"),
        F.struct(stage(2), F.col("axis").alias("axis"), F.col("segment").alias("segment"), F.col("subject").alias("text")).alias("condition_stage"),
        F.struct(stage(3), F.col("quotes").alias("total"), F.size("_q").alias("shown"), (F.col("quotes") - F.size("_q")).alias("omitted"), F.col("first_month"), F.col("last_month"), held.alias("reserved"), F.col("_q").alias("quotes")).alias("evidence_stage"),
        F.struct(stage(4), "direction", "pos", "neg", "neu", "spoke").alias("direction_stage"),
        F.struct(stage(5), F.col("reason").isNull().alias("passed"), "reason", "support", "spoke", "cell_authors", "silent").alias("sufficiency_stage"))


def arrangement_violations(claims: DataFrame, support: DataFrame, found: DataFrame, cell: list[str]) -> DataFrame:
    """(cell, aspect, violation) where the gates' results side by side aren't of one cell, or a layout would stand on nothing.

    claims: the sufficiency gate's (pos, neg, neu, spoke, silent); support: the polarity gate's counts by review; found: totals(). no_evidence;
    quotes_are_not_spoke (every author who spoke is quoted once); pos, neg, neu, silent that differ between the gates.
    """
    by = [*cell, "aspect"]
    counts = ["pos", "neg", "neu", "silent"]
    rows = claims.join(support.select(*by, *[F.col(c).alias(f"_{c}") for c in counts]), by, "left").join(found.select(*by, "quotes"), by, "left")
    checks = [F.when(F.col("quotes").isNull(), "no_evidence"), F.when(F.col("quotes") != F.col("spoke"), "quotes_are_not_spoke"), *[F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), f"{c}_differs") for c in counts]]
    return rows.select(*by, F.explode(F.filter(F.array(*checks), F.isnotnull)).alias("violation"))
