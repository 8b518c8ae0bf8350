"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from tidemark import catalog, model
from tidemark.operators import rank, visitors
from tidemark.operators.patterns import Pattern, match
from tidemark.plans.ordered import HotKeys, Ordered

# These run when they are called, as streams or through a written file.
EAGER = {"ddl_csv_table", "tumble_count_wm"}
BATCH = sorted(n for n in catalog.QUERIES if n not in EAGER and not n.startswith("stream_"))


def plan(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", BATCH)
def test_no_single_task_and_no_cross_join(spark, sf, capsys, name):
    text = plan(catalog.QUERIES[name](spark, sf), capsys)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "PythonUDF", "BatchEvalPython"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(spark, sf, capsys):
    behavior = model.user_behavior(model.table(spark, sf, "events"))
    for df in (rank.top_items(behavior, view="view"), visitors.exact(behavior, view="view")):
        text = plan(df, capsys)
        assert "EqualTo(event_type,view)" in text
        assert "value" not in text.split("ReadSchema: ")[1].split("\n")[0]


def test_ranking_prunes_before_the_shuffle(spark, sf, capsys):
    behavior = model.user_behavior(model.table(spark, sf, "events"))
    text = plan(rank.top_items(behavior, view="view"), capsys)
    assert text.count("WindowGroupLimit") >= 2


def test_patterns_do_not_grow_the_plan_with_their_steps(spark, capsys):
    df = spark.range(60).selectExpr("id % 2 AS k", "id AS ts", "id AS seq")
    step = Pattern.begin("a", F.col("seq") >= 0)
    found = [plan(match(df, step.times(n), "k", ["ts", "seq"]), capsys).count(") Range") for n in (2, 5, 10)]
    assert found[0] > 0 and found == [found[0]] * 3


def test_rows_ahead_are_the_same_however_keys_are_cut(spark):
    df = spark.range(60).selectExpr("CASE WHEN id < 50 THEN NULL ELSE id % 3 END AS k", "id * id AS ts", "id AS seq")
    found = []
    for hot in (HotKeys(), HotKeys(1, 3), HotKeys(20, 7)):
        rows = Ordered(df, ["k"], ["ts", "seq"], hot).ahead(F.col("seq"), 7).rows().orderBy("seq").collect()
        found.append([tuple(r) for r in rows])
    assert found[0] == found[1] == found[2]
    assert found[0][45][2:] == (45, 46, 47, 48, 49, None, None, None)
