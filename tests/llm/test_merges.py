from veridact.llm import simhash
from veridact.llm.common import components, materialize


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_components_and_near_duplicates_broadcast_nothing(spark):
    """What grows with the input doesn't pass through the driver, however small it looks to the planner."""
    plans = []

    def save(df):
        plans.append(plan(df))
        return materialize(df)

    edges = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, 21)], "u long, v long")
    found = components(edges, save).collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(10)} | {(20, 20), (21, 20)}
    docs = spark.createDataFrame([(i, f"one two three four {i % 3}") for i in range(9)], "doc_id long, text string")
    df = simhash.near_duplicates(docs)
    assert [r.component for r in df.orderBy("id").collect()] == [0, 1, 2] * 3
    assert len(plans) > 3 and not any("BroadcastHashJoin" in p for p in [*plans, plan(df)])
