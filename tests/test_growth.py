import time

import pytest
from pyspark.sql import functions as F

from veridact.functions import stats
from veridact.operators import claims, layout, polarity, shared
from veridact.schemas import NoisePolicy


def test_fisher_takes_steps_by_the_root_of_the_counts(spark):
    """Half a million a side: the normal approximation holds, and the pass doesn't walk over every table."""
    rows = [(500_000, 500_000, 500_000 + s, 500_000 - s) for s in (0, 300, 700, 1000, 5000, 400_000)] * 20
    df = spark.createDataFrame(rows, "a long, b long, c long, d long").coalesce(1)
    began = time.time()
    got = [r.p for r in df.select(stats.fisher_two_sided(*map(F.col, "abcd")).alias("p")).collect()]
    assert time.time() - began < 20
    assert got[0] == pytest.approx(1.0) and got[1] == pytest.approx(0.6720, abs=2e-3) and got[2] == pytest.approx(0.3225, abs=2e-3) and got[3] == pytest.approx(0.1576, abs=2e-3)
    assert got[4] < 1e-9 and got[5] == 0.0


def test_tasks_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(shared, "TASK_ROWS", 100)
    df = spark.range(1000).withColumn("k", F.col("id") % 50)
    assert shared.spread(df, 1000, "k").rdd.getNumPartitions() == 10
    assert shared.spread(df, 300, "k").rdd.getNumPartitions() == df.rdd.getNumPartitions()
    n = shared.numbered(df, ["k"], [F.desc("id")], "n")
    assert {(r.id, r.n) for r in n.collect()} == {(i, 20 - i // 50) for i in range(1000)}
    member = df.select(F.lit("p").alias("product_id"), F.lit("product").alias("axis"), F.lit("None").alias("segment"), F.col("id").alias("review_id"), F.col("k").alias("author"))
    tags = df.select(F.col("id").alias("review_id"), F.lit("a").alias("aspect"), F.when(F.col("id") % 4 == 0, "positive").otherwise("negative").alias("polarity"))
    found = claims.candidates(member, tags)
    assert [(r.pos, r.neg, r.neu, r.spoke, r.cell_authors) for r in found.collect()] == [(25, 50, 0, 50, 50)]


def test_first_quotes_sort_few_rows_and_equal_the_full_ranking(spark):
    """Null, NaN and tied scores, a polarity whose first is far behind, and null cells."""
    n = F.col("id")
    score = F.when(n % 97 == 0, None).when(n % 89 == 0, F.lit(float("nan"))).otherwise(F.round(F.pmod(n * 7919, F.lit(1000)) / 1000, 2))
    member = spark.range(3000).select(F.when(n % 3 > 0, F.concat(F.lit("p"), n % 3)).alias("product_id"), F.lit("x").alias("axis"), F.lit("y").alias("segment"), n.alias("review_id"), score.alias("trust_score"), F.lit("2020.01.02").alias("review_date"))
    tags = spark.range(3000).select(n.alias("review_id"), F.lit("a").alias("aspect"), F.when(F.pmod(n * 7919, F.lit(1000)) < 40, "negative").otherwise("positive").alias("polarity"))
    cell = ["product_id", "axis", "segment"]
    k = 5
    want = layout.ranked_quotes(member, tags, cell).where((F.col("quote_rank") <= k) | (F.col("polarity_rank") == 1))
    got = layout.first_quotes(member, tags, cell, k)
    keep = lambda df: {(r.product_id, r.review_id, r.polarity, r.quote_rank) for r in df.collect() if r.product_id is not None}
    assert keep(got) == keep(want) and any(r[3] > k for r in keep(want))
    assert got.where("product_id is null").count() >= k


def test_a_task_that_reads_a_scratch_table_holds_few_rows(spark, monkeypatch):
    """The rows of one column of one value take no bytes, so only the number of files parts them."""
    monkeypatch.setattr(shared, "FILE_ROWS", 100, raising=False)
    table = shared.cut_lineage(spark.range(10_000).select("id", F.lit("x").alias("s")).coalesce(1))
    held = table.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert held[0] <= 32 * 100 and held[1] == 10_000


def test_lines_and_orders_are_dealt_before_joins_too(spark, monkeypatch):
    """Where parts and customers are too many to broadcast, the join's tasks grow in number."""
    import re

    from veridact.sources import adapters

    where = "/root/testdata/sf0.001"
    want = sorted(map(str, adapters.reviews(spark, where).collect()))
    monkeypatch.setattr(shared, "TASK_ROWS", 100)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = adapters.reviews(spark, where)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, found.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    dealt = {k: max(int(n) for c, n in re.findall(r"hashpartitioning\((\w+)#\d+L?, (\d+)\)", plan) if c == k) for k in ("l_partkey", "p_partkey", "o_custkey", "c_custkey")}
    assert min(dealt.values()) > 4


def test_given_tables_are_dealt_to_many_tasks_from_a_scratch_table(spark, monkeypatch):
    """A shuffle to more tasks than UNSORTED keeps all that its task read; what a task reads of a given file has no bound in rows."""
    from veridact.sources import adapters

    where = "/root/testdata/sf0.001"
    want = sorted(map(str, adapters.reviews(spark, where).collect()))
    monkeypatch.setattr(shared, "TASK_ROWS", 100)
    monkeypatch.setattr(shared, "FILE_ROWS", 10)
    monkeypatch.setattr(shared, "UNSORTED", 5, raising=False)
    found = adapters.reviews(spark, where)
    assert sorted(map(str, found.collect())) == want
    files = found.inputFiles()
    assert len(files) > 100 and not any(f.endswith(("lineitem.parquet", "orders.parquet")) for f in files)


def test_both_gates_of_parity_count_the_same_tables(spark, monkeypatch):
    """Reviews and tags are derived once; before, the polarity gate's side joined order lines anew, all in the tasks of one stage."""
    import duckdb

    from veridact.plans import contract_queries

    where = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("orders", "lineitem", "part", "customer"):
        con.execute(f"create view {name} as select * from '{where}/{name}.parquet'")
    monkeypatch.setattr(shared, "TASK_ROWS", 100)
    found = contract_queries.gate_parity(spark, where)
    assert not any(where in f for f in found.inputFiles())
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(contract_queries.ORACLES["gate_parity"]).fetchall())


def test_members_and_tags_of_layouts_meet_in_more_tasks(spark, monkeypatch):
    """Both are scratch tables; before, they were joined by review in a fixed number of tasks."""
    import re

    from veridact.plans import contract_queries

    where = "/root/testdata/sf0.001"
    want = sorted(map(str, contract_queries.layout_contract(spark, where).collect()))
    monkeypatch.setattr(shared, "TASK_ROWS", 100)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = contract_queries.layout_contract(spark, where)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, found.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    dealt = [int(n) for n in re.findall(r"hashpartitioning\(review_id#\d+L?, (\d+)\)", plan) if n]
    assert dealt and min(dealt) > 4


@pytest.mark.parametrize("name", ["layout_text", "ranked_quotes", "layout_rows"])
def test_quotes_of_a_review_stay_together_until_they_are_counted(spark, monkeypatch, tmp_path, name):
    """A review makes 14 quotes of cells and aspects; before, each was written to scratch tables and shuffled."""
    import duckdb

    import __spark_entry__

    where = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("orders", "lineitem", "part", "customer"):
        con.execute(f"create view {table} as select * from '{where}/{table}.parquet'")
    folders = iter(range(1000))
    path = lambda _: str(tmp_path / f"table-{next(folders)}")
    monkeypatch.setattr(shared, "scratch_path", path)
    monkeypatch.setattr(layout, "STEP_ROWS", 4, raising=False)
    found = sorted(map(tuple, __spark_entry__.queries()[name](spark, where).collect()))
    assert found == sorted(con.execute(__spark_entry__.oracle_sql()[name]).fetchall())
    quotes = con.execute(f"select count(*) from ({__spark_entry__.oracle_sql()['ranked_quotes']})").fetchone()[0]
    most = max(spark.read.parquet(str(p)).count() for p in tmp_path.iterdir())
    assert quotes > 10_000 and most < quotes / 2


def test_reviews_that_hold_what_they_say_equal_reviews_and_tags(spark):
    from veridact.sources import adapters

    where = "/root/testdata/sf0.001"
    rows = adapters.told(spark, where)
    plain = adapters.reviews(spark, where)
    assert sorted(map(str, rows.drop("said").collect())) == sorted(map(str, plain.drop("option").select(*rows.drop("said").columns).collect()))
    said = sorted(map(tuple, rows.select("review_id", F.inline("said")).collect()))
    assert said == sorted(map(tuple, adapters.tags(spark, where).join(plain.select("review_id"), "review_id").collect())) and said
    member = claims.cells(plain)
    key = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert key(claims.told_candidates(shared.cut_lineage(rows))) == key(claims.candidates(member, adapters.tags(spark, where)))


@pytest.mark.parametrize("places", [2, 7])
def test_few_quotes_are_sorted_where_scores_tie(spark, monkeypatch, places):
    """Of one score nearly throughout, steps are of months; where scores differ beyond four places, they aren't. Before, all quotes of the score were sorted."""
    monkeypatch.setattr(layout, "STEP_ROWS", 8, raising=False)
    n = F.col("id")
    score = F.when(n % 97 == 0, None).when(n % 89 == 0, F.lit(float("nan"))).when(n % 50 == 0, 0.9).otherwise(F.round(0.5 + F.pmod(n * 7919, F.lit(40)) / 4e6, places))
    date = F.when(n % 31 > 0, F.format_string("20%02d.%02d.%02d", (n % 20).cast("int"), (n % 12 + 1).cast("int"), (n % 28 + 1).cast("int")))
    member = spark.range(4000).select(F.when(n % 5 > 0, F.concat(F.lit("p"), n % 2)).alias("product_id"), F.lit("x").alias("segment"), n.alias("review_id"), score.alias("trust_score"), date.alias("review_date"))
    tags = spark.range(4000).select(n.alias("review_id"), F.lit("a").alias("aspect"), F.when((n % 3 == 1) & (n % 20 == 1), "negative").when(n == 777, "neutral").otherwise("positive").alias("polarity"))
    cell = ["product_id", "segment"]
    want = layout.ranked_quotes(member, tags, cell).where("quote_rank <= 8 or polarity_rank = 1")
    sizes, save = [], layout.cut_lineage
    monkeypatch.setattr(layout, "cut_lineage", lambda df: sizes.append((df.columns, (made := save(df)).count())) or made)
    got = layout.first_quotes(member, tags, cell)
    keep = lambda df: sorted(str((r.product_id, r.review_id, r.polarity, r.quote_rank)) for r in df.collect() if r.product_id is not None)
    assert keep(got) == keep(want) and any(r.quote_rank > 8 for r in want.collect())
    if places == 2:
        assert max(n for c, n in sizes if "polarity" in c and "review_id" in c) < 2000


def test_ranks_over_many_ranges_equal_a_window(spark, monkeypatch):
    """Null and NaN scores, ties, null cells, aspects and polarities, and groups that go over many ranges."""
    from pyspark.sql import Window

    from veridact.operators.trust import rank_order

    monkeypatch.setattr(shared, "TASK_ROWS", 50)
    n = F.col("id")
    score = F.when(n % 97 == 0, None).when(n % 89 == 0, F.lit(float("nan"))).otherwise(F.round(F.pmod(n * 7919, F.lit(50)) / 50, 2))
    date = F.when(n % 31 > 0, F.concat(F.lit("2020.01.0"), n % 7 + 1))
    base = spark.range(800).select(F.when(n % 5 > 0, F.concat(F.lit("p"), n % 2)).alias("product_id"), F.explode(F.array(F.lit("x"), F.concat(F.lit("y"), n % 3), F.lit(None).cast("string"))).alias("segment"), n.alias("review_id"), score.alias("trust_score"), date.alias("review_date"))
    polarity = F.when(n % 11 == 0, None).when(n % 13 == 0, "odd").when(n % 3 == 0, "negative").otherwise("positive")
    tags = spark.range(800).where(n % 7 > 0).select(n.alias("review_id"), F.explode(F.array(F.lit("a"), F.when(n % 4 > 0, "b"))).alias("aspect"), polarity.alias("polarity"))
    cell = ["product_id", "segment"]
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*rank_order()))
    want = base.join(tags, "review_id").withColumn("quote_rank", place(*cell, "aspect")).withColumn("polarity_rank", place(*cell, "aspect", "polarity"))
    got = layout.ranked_quotes(base, tags, cell)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 3000
    assert layout.ranked_quotes(base.where("false"), tags, cell).collect() == []


def test_noise_thresholds_pass_over_the_numbers_once(spark):
    """Numbers of a million tags; before, each number tried was summed anew."""
    sizes = spark.range(1_000_000, 1_000_040).select(F.col("id").alias("n"))
    began = time.time()
    got = [r.min_minority for r in polarity.noise_thresholds(sizes).collect()]
    assert time.time() - began < 20
    assert len(got) == 40 and 33_000 < min(got) <= max(got) < 33_400


@pytest.mark.parametrize("rate,alpha", [(0.033, 0.05), (0.2, 1e-9), (0.5, 0.3), (0.7, 0.9), (0.001, 1e-14)])
def test_noise_thresholds_equal_the_full_search(spark, rate, alpha):
    n, k = F.col("n"), F.col("k")
    tries = spark.range(1, 150).select(F.col("id").alias("n")).withColumn("k", F.explode(F.sequence(F.lit(1), n))).where(k >= F.floor(n * rate))
    want = tries.where(stats.binom_sf(k, n, rate) < alpha).groupBy("n").agg(F.min("k").alias("k"))
    got = polarity.noise_thresholds(spark.range(150).select(F.col("id").alias("n")), NoisePolicy(rate, alpha))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
