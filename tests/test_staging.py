"""Staged tables belong to a run and go with it."""

import os

import pytest
from pyspark.sql import functions as F

from memberlytics.plans import QUERIES, feature_queries as fq
from memberlytics.session import current_staging, stage, stage_all, stage_by, staging_root, staging_run
from memberlytics.sources.readers import files_print

SF = "/root/testdata/sf0.001"


def held(spark):
    root = staging_root(spark)
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_a_run_removes_its_tables(spark):
    before = held(spark)
    with staging_run(spark) as run:
        parts = stage_all({f"t{i}": spark.range(i) for i in range(1, 6)})
        assert sum(t.count() for t in parts.values()) == 15 and QUERIES["percentile_rank"](spark, SF).collect()
        assert len(held(spark) - before) == 1 and len(os.listdir(run.folder)) > 5
    assert held(spark) == before and not os.path.exists(run.folder)


def test_a_run_that_fails_removes_its_tables(spark):
    before = held(spark)
    with pytest.raises(ZeroDivisionError), staging_run(spark):
        stage(spark.range(3), "left")
        1 / 0
    with pytest.raises(Exception, match="broken"), staging_run(spark):
        stage(spark.range(3).select(F.raise_error(F.lit("broken"))), "half")
    assert held(spark) == before


def test_an_inner_run_leaves_the_outer_one(spark):
    with staging_run(spark) as outer:
        kept = stage(spark.range(7), "outer")
        with staging_run(spark) as inner:
            assert current_staging(spark) is inner and stage(spark.range(2), "inner").count() == 2
        assert current_staging(spark) is outer and kept.count() == 7
    with staging_run(spark):
        pass  # a run without any table
    assert current_staging(spark) not in (outer, inner)


def test_shared_tables_follow_their_inputs(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(len(built))

    source = str(tmp_path / "in.parquet")
    spark.range(3).write.parquet(source)
    with staging_run(spark) as run:
        get = lambda: run.once((SF, "shared"), files_print(spark, [source]), build).count()
        assert (get(), get()) == (1, 1)
        spark.range(2).write.mode("append").parquet(source)
        assert (get(), get()) == (2, 2)
        run.close()
        assert get() == 3  # its files were removed meanwhile
    with staging_run(spark) as run:
        assert run.once((SF, "shared"), "", build).count() == 4  # nothing is taken over from another run


def test_training_queries_share_one_table(spark):
    with staging_run(spark) as run:
        first, again = (fq.early_rows(spark, SF, 2) for _ in range(2))
        assert first is again and len(run.shared) == 1
        path = run.shared[SF, "star2"][2]
        spark._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark._jsc.hadoopConfiguration()).delete(
            spark._jvm.org.apache.hadoop.fs.Path(path), True
        )
        assert fq.early_rows(spark, SF, 2).count() == again.sparkSession.read.parquet(run.shared[SF, "star2"][2]).count() > 0


def test_only_the_slices_asked_for_are_written(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(fq, "stage", lambda df, name: written.setdefault(name, stage(df, name)))
    with staging_run(spark):
        out = fq.tenure_slices(spark, SF, (2,), keep=fq.SELLING)
        found = out.select("n_tenure", "i_status", "i_member_type").collect()
        assert found and {tuple(r) for r in found} == {(2, "ACTIVE", "I")}
        assert written["slices"].count() == len(found)


def test_slices_join_only_the_rows_they_look_back_on(spark):
    """The slice of tenure 2 needs the rows up to there, unless the run has the longer table already; both give the same rows."""
    with staging_run(spark) as run:
        short = fq.tenure_slices(spark, SF, (2,)).select("member_id", "month", "n_pv_sum_month_agg", "n_pv_previous").collect()
        assert set(run.shared) == {(SF, "star2")}
    with staging_run(spark) as run:
        fq.early_rows(spark, SF, max(fq.TENURES))
        long = fq.tenure_slices(spark, SF, (2,)).select("member_id", "month", "n_pv_sum_month_agg", "n_pv_previous").collect()
        assert set(run.shared) == {(SF, "star15")}
    assert sorted(short) == sorted(long) and short


def test_model_rows_are_written_once(spark):
    from memberlytics.plans import model_queries as mq

    with staging_run(spark) as run:
        assert mq.renewal_data(spark, SF).count() > 0
        names = [n.rpartition("-")[0] for n in os.listdir(run.folder)]
        assert names.count("renewal") == 1 and "slices" not in names


def test_bucketed_tables_are_not_shuffled_by_their_key(spark):
    from pyspark.sql import Window

    before = {t.name for t in spark.catalog.listTables()}
    with staging_run(spark) as run:
        rows = spark.range(50).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))
        t = stage_by(rows, "dealt", "k")
        assert t.schema == rows.schema or t.columns == rows.columns
        assert sorted(t.collect(), key=str) == sorted(rows.collect(), key=str) and os.listdir(run.folder)
        w = t.withColumn("n", F.count("v").over(Window.partitionBy("k").orderBy("v")))
        plan = w._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and w.agg(F.max("n")).first()[0] == 6
        assert {x.name for x in spark.catalog.listTables()} == before
