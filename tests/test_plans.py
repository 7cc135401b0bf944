"""What the wide queries write, and how wide their rows are on the way."""

import pytest
from pyspark.sql import functions as F

from memberlytics import session
from memberlytics.operators import labels as lb, shape
from memberlytics.plans import QUERIES, feature_queries as fq, model_queries as mq
from memberlytics.session import stage, staging_run

SF = "/root/testdata/sf0.001"


@pytest.fixture
def staged(spark, monkeypatch):
    """Name and number of columns of every table that is staged, in a run of its own."""
    found, write = [], session.write_staged

    def seen(df, path, by=None):
        found.append((path.rpartition("/")[2], len(df.columns)))
        return write(df, path, by)

    monkeypatch.setattr(session, "write_staged", seen)
    with staging_run(spark):
        yield found


def nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def test_the_panel_is_one_field_through_the_joins_and_wide_rows_are_copied_once_above_the_windows(spark, staged):
    plan = fq.feature_table(spark, SF)._jdf.queryExecution().optimizedPlan()
    above, joined = [], []
    for node in nodes(plan):
        if node.nodeName() == "Window":
            break
        above.append(node.output().size())
    for node in nodes(plan):
        if node.nodeName() == "Join":
            joined.append(node.output().size())
    assert len(above) == 2 and max(joined) <= 40, (above, max(joined))


def test_migration_rows_are_not_written_before_they_are_split(spark, staged):
    QUERIES["migration_train"](spark, SF)
    mq.migration_data(spark, SF)
    assert staged and max(width for _, width in staged) < 900, staged


def test_both_parts_by_sign_in_one_pass(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (3, -1), (4, None), (5, 0)], "id int, x int")
    zero, positive = lb.split_by_sign(df, "x")
    want = {r["id"]: name for name, part in (("zero", zero), ("positive", positive)) for r in part.collect()}
    got = df.withColumn("part", lb.part_by_sign("x")).filter("part IS NOT NULL").collect()
    assert {r["id"]: r["part"] for r in got} == want == {1: "zero", 2: "positive", 5: "zero"}


def test_the_star_of_the_slices_has_no_columns_of_fixed_frames(spark, staged):
    star = fq.early_rows(spark, SF, 2)
    assert not shape.framed_columns(star.columns) and "n_los_sil_q_mth" in star.columns
    whole = fq.star(spark, SF, fq.base_panel(spark, SF), "tenure <= 2")
    assert set(star.columns) == set(whole.columns) - set(shape.framed_columns(whole.columns))


def test_staged_tables_are_compressed_with_zstd(spark, staged):
    table = stage(spark.range(10).withColumn("x", F.lit("x")), "small")
    assert table.count() == 10 and all(f.endswith(".zstd.parquet") for f in table.inputFiles())
