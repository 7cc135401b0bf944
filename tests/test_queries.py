"""Every registered query runs and equals its SQL."""

import pytest

from compare import compare, connect
from memberlytics.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, info = compare(spark, con, name, SF)
    assert ok, info


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


def test_every_level_of_the_ladder_occurs(spark):
    scores = {r[0] for r in QUERIES["award_from_flags"](spark, SF).select("monthly_score").distinct().collect()}
    assert scores - {None} == {400 - 5 * i for i in range(1, 20)}


@pytest.mark.parametrize("limit", ["10485760", "102400"])
@pytest.mark.parametrize("name", ["index_vs_average", "roll_share_of_dim"])
def test_small_lookups_do_not_shuffle_the_panel(spark, name, limit):
    """The panel is never dealt by the few keys of an average or income table."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        df = QUERIES[name](spark, SF)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
        assert "BroadcastHashJoin" in plan
        assert not any(f"hashpartitioning({c}#" in plan for c in ("month", "province", "rank", "year"))
    finally:
        spark.conf.set(key, before)
