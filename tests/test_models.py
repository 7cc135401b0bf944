"""Training, scoring and explanations on a small table."""

import datetime
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from memberlytics.functions import portable_bucket
from memberlytics.models import explain, training as ml
from memberlytics.sources import readers as rd, writers as wr
from memberlytics.session import stage_seen, staging_path, staging_root

KEYS = ["id"]


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(600):
        a, b, c = rnd.random(), rnd.random(), rnd.choice("uvwxyz")
        rows.append((i, a, b, c, int(a + (0.5 if c in "uv" else 0) + 0.2 * rnd.random() > 0.9)))
    return spark.createDataFrame(rows, "id long, n_a double, n_b double, i_c string, y int").repartition(4).cache()


@pytest.fixture(scope="module")
def model(data):
    return ml.fit_model(data, "y", KEYS, "gbt", {"maxDepth": 3, "maxIter": 4})


def test_contributions_add_up_to_the_margin(data, model):
    encoded = model.transform(data)
    out = explain.contributions(model.stages[-1], encoded, KEYS)
    margin = encoded.select("id", F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("raw"))
    worst = out.join(margin, "id").select(F.max(F.abs(F.col("margin") - F.col("raw")))).first()[0]
    assert worst < 1e-9
    names = [c for c in out.columns if c.startswith("c_")]
    assert names == ["c_n_a", "c_n_b", "c_i_c_indexed"]


def leaves_of(tree, path=()):
    """(value, [(feature, share of rows, tests)]) of each leaf; a test is (threshold or None, left categories or None, must go left)."""
    if not tree.children:
        merged = {}
        for feature, share, test in path:
            entry = merged.setdefault(feature, [1.0, []])
            entry[0] *= share
            entry[1].append(test)
        return [(tree.value, [(f, z, tests) for f, (z, tests) in merged.items()])]
    sides = zip(tree.children, tree.shares, (True, False))
    return [leaf for c, z, left in sides for leaf in leaves_of(c, (*path, (tree.feature, z, (tree.threshold, tree.left_set, left))))]


def test_deep_trees_with_repeated_features_add_up():
    rng = np.random.default_rng(3)

    def grow(depth):
        if depth == 0 or rng.random() < 0.1:
            return explain.Node(float(rng.normal()))
        share = float(rng.uniform(0.05, 0.95))
        return explain.Node(0.0, int(rng.integers(4)), float(rng.random()), None, (grow(depth - 1), grow(depth - 1)), (share, 1 - share))

    trees = [grow(9) for _ in range(5)]
    x = rng.random((50, 4))
    phi, bias = explain.shapley(x, trees, 4)

    def value(node, row):
        while node.children:
            node = node.children[0 if row[node.feature] <= node.threshold else 1]
        return node.value

    assert np.allclose(phi.sum(axis=1) + bias, [sum(value(t, r) for t in trees) for r in x], atol=1e-9)


def test_contributions_equal_the_definition(spark, data, model):
    """Shapley values by enumerating all coalitions."""
    gbt = model.stages[-1]
    trees = explain.forest(gbt, spark)
    leaves = [leaf for tree in trees for leaf in leaves_of(tree)]
    x = np.array(model.transform(data).limit(20).select(vector_to_array("features")).toPandas().iloc[:, 0].tolist())
    got, bias = explain.shapley(x, trees, 3)
    assert bias == pytest.approx(sum(v * math.prod(z for _, z, _ in path) for v, path in leaves), abs=1e-12)

    def passes(row, feature, tests):
        ok = True
        for threshold, left_set, left in tests:
            goes_left = row[feature] <= threshold if left_set is None else row[feature] in left_set
            ok &= goes_left == left
        return ok

    def worth(row, coalition):
        return sum(v * math.prod((passes(row, f, t) if f in coalition else z) for f, z, t in path) for v, path in leaves)

    for row, phi in zip(x, got):
        for f in range(3):
            rest = [j for j in range(3) if j != f]
            want = 0.0
            for r in range(3):
                for s in itertools.combinations(rest, r):
                    w = math.factorial(r) * math.factorial(2 - r) / 6
                    want += w * (worth(row, {*s, f}) - worth(row, set(s)))
            assert phi[f] == pytest.approx(want, abs=1e-10)


def test_forest_contributions_add_up_to_the_probability(data):
    forest = ml.fit_model(data, "y", KEYS, "forest", {"maxDepth": 3, "numTrees": 3}, one_hot=True)
    encoded = forest.transform(data)
    out = explain.contributions(forest.stages[-1], encoded, KEYS)
    p = encoded.select("id", F.get(vector_to_array("probability"), F.lit(1)).alias("p"))
    assert out.join(p, "id").select(F.max(F.abs(F.col("margin") - F.col("p")))).first()[0] < 1e-9


def test_a_forest_is_applied_after_an_observed_write(data):
    assert stage_seen(data, "seen", rows=F.count(F.lit(1)))[1] == {"rows": 600}
    forest = ml.fit_model(data, "y", KEYS, "forest", {"maxDepth": 2, "numTrees": 2})
    assert forest.transform(data).filter(F.get(vector_to_array("probability"), F.lit(1)).between(0, 1)).count() == 600


def test_score_threshold_metrics_and_unseen_category(spark, data, model):
    new = spark.createDataFrame([(1, 0.99, 0.5, "unseen"), (2, 0.01, 0.5, "z")], "id long, n_a double, n_b double, i_c string")
    got = {r["id"]: r for r in ml.score(model, new).collect()}
    assert got[1]["scored_label"] == int(got[1]["score"] >= 0.38) and got[2]["scored_label"] == 0
    metrics = {r["metric"]: r["value"] for r in ml.evaluate(model.transform(data), "y").collect()}
    assert set(metrics) == {"auc", "accuracy", "f1", "weightedPrecision", "weightedRecall"} and metrics["auc"] > 0.9
    imp = ml.importances(model.stages[-1], model.transform(data))
    assert imp.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_grid_search_by_rounds_and_in_full(spark, data):
    folded = ml.member_folds(ml.fit_encoder(data, "y", KEYS).transform(data), "id", 3)
    assert folded.groupBy("fold").count().count() == 3
    grid, fixed = {"maxDepth": [1, 2, 3], "maxIter": [1, 2]}, {"maxBins": 8}
    rounds = ml.grid_search(folded, "y", "fold", grid, 3, fixed).orderBy("point").collect()
    full = ml.grid_search(folded, "y", "fold", grid, 3, fixed, halving=False).orderBy("point").collect()
    assert [r["params"] for r in rounds] == [f"maxDepth={d}, maxIter={i}" for d in (1, 2, 3) for i in (1, 2)]
    assert sorted(r["folds"] for r in rounds) == [1, 1, 1, 2, 3, 3] and {r["folds"] for r in full} == {3}
    assert all(r["auc"] == f["auc"] for r, f in zip(rounds, full) if r["folds"] == 3)
    assert max(r["auc"] for r in full) > 0.8


def test_points_that_differ_in_iterations_share_a_fit(spark, data, monkeypatch):
    """The first trees of the longer model are the shorter model, and the grid fits only the longer one."""
    from pyspark.ml.functions import vector_to_array

    folded = ml.member_folds(ml.fit_encoder(data, "y", KEYS).transform(data), "id", 3)
    fit = lambda k: ml.classifier("y", "gbt", {"maxBins": 8, "maxDepth": 2, "maxIter": k}).fit(folded)
    short = fit(2).transform(ml.margins(fit(4), folded, [2, 4]))
    apart = F.abs(F.get(vector_to_array("rawPrediction"), F.lit(1)) - F.col("margin_2"))
    assert short.agg(F.max(apart)).first()[0] < 1e-9 and short.filter("margin_2 <> margin_4").count()
    made, classifier = [], ml.classifier
    monkeypatch.setattr(ml, "classifier", lambda target, algo, params: made.append(params) or classifier(target, algo, params))
    found = ml.grid_search(folded, "y", "fold", {"maxDepth": [1, 2], "maxIter": [1, 3]}, 3, {"maxBins": 8}, halving=False)
    assert found.count() == 4 and sorted((m["maxDepth"], m["maxIter"]) for m in made) == [(1, 3)] * 3 + [(2, 3)] * 3


def test_thousands_of_categories(spark):
    """Trees take 48 bins; the rarer of 5,000 categories share one, and unseen ones go with them."""
    rows = [(i, f"c{i % 5000:04d}", 0) for i in range(6000)] + [(10_000 + i, f"it's {i % 40}", 1) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, i_c string, y int").withColumn("n_a", F.lit(1.0))
    model = ml.fit_model(df, "y", KEYS, "gbt", {"maxIter": 2})
    path = staging_path(spark, "cut")
    model.write().save(path)
    new = spark.createDataFrame([(1, "it's 7", 1.0), (2, "c0000", 1.0), (3, "never seen", 1.0), (4, None, 1.0)], "id long, i_c string, n_a double")
    got = {r["id"]: r["scored_label"] for r in ml.score(type(model).load(path), new).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 0}
    kept = ml.frequent_values(df, ["i_c"], 48)["i_c"]
    assert len(kept) == 46 and kept[:40] == sorted(f"it's {i}" for i in range(40)) and kept[40:] == [f"c{i:04d}" for i in range(6)]
    assert ml.frequent_values(df.filter("id < 46"), ["i_c"], 48) == {}


def test_areas_of_three_classes(spark):
    rnd = random.Random(4)
    rows = [(float(k), rnd.random() + k, rnd.random(), "u") for k in (0, 1, 2) for _ in range(60)]
    three = spark.createDataFrame(rows, "y double, n_a double, n_b double, i_c string")
    model = ml.fit_model(three, "y", [], "forest", {"maxDepth": 2, "numTrees": 3})
    got = {r["metric"]: r["value"] for r in ml.evaluate(model.transform(three), "y").collect()}
    assert {"auc_0", "auc_1", "auc_2", "accuracy"} <= set(got) and "auc" not in got
    assert all(0.8 < got[f"auc_{k}"] <= 1 for k in range(3))


def test_manifest_mismatch_is_an_error(spark, data):
    path = staging_path(spark, "manifest")
    wr.write_manifest(data, ["n_a", "n_b"], path)
    wr.check_manifest(spark, ["n_a", "n_b"], path)
    with pytest.raises(ValueError):
        wr.check_manifest(spark, ["n_b", "n_a"], path)


def test_backfill_converts_missing_years_only(spark):
    path = staging_path(spark, "raw")
    for year in (2019, 2020):
        spark.createDataFrame([(str(year), "a")], "k string, v string").write.option("sep", "|").option("header", True).csv(f"{path}/{year}")
    read = []

    def reader(s, p):
        read.append(p)
        return rd.read_text_table(s, p, "|")

    target = staging_path(spark, "table")
    assert rd.backfill(spark, path + "/{year}", target, [2019], reader).count() == 1
    assert rd.backfill(spark, path + "/{year}", target, [2019, 2020], reader).count() == 2
    assert [p[-4:] for p in read] == ["2019", "2020"]


def test_backfill_replaces_changed_years_only(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "table")

    def deliver(year, rows):
        spark.createDataFrame(rows, "k string").write.mode("overwrite").option("header", True).csv(f"{raw}/{year}")

    def folders():
        return {p.name: sorted(f.name for f in p.glob("part-*")) for p in (tmp_path / "table").glob("year=*")}

    for year in (2018, 2019, 2020):
        deliver(year, [(f"{year}",)])
    years = [2017, 2018, 2019, 2020]
    assert rd.backfill(spark, raw + "/{year}", target, years, at_once=2).count() == 3
    before = folders()
    assert rd.backfill(spark, raw + "/{year}", target, years).count() == 3 and folders() == before
    deliver(2019, [("new",), ("newer",)])
    got = rd.backfill(spark, raw + "/{year}", target, years)
    assert sorted((r["year"], r["k"]) for r in got.collect()) == [(2018, "2018"), (2019, "new"), (2019, "newer"), (2020, "2020")]
    after = folders()
    assert {y for y in before if before[y] != after[y]} == {"year=2019"}
    deliver(2018, [])
    assert sorted(r["year"] for r in rd.backfill(spark, raw + "/{year}", target, years).collect()) == [2019, 2019, 2020]
    assert rd.backfill(spark, raw + "/{year}", target, [2020]).count() == 1
    with pytest.raises(ValueError):
        rd.backfill(spark, raw + "/{year}", target, [2017])


def test_write_table_observes_its_rows(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 4 > 0, F.col("id")).alias("x"))
    path = staging_path(spark, "observed")
    got = wr.write_table(df, path, max_records=100, profile=["id", "x"])
    assert got == {"row_count": 1000, "min_id": 0, "max_id": 999, "nulls_id": 0, "min_x": 1, "max_x": 999, "nulls_x": 250}
    assert spark.read.parquet(path).count() == 1000
    assert wr.write_table(df.limit(0), path, profile=["id"]) == {"row_count": 0, "min_id": None, "max_id": None, "nulls_id": 0}


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            assert key == "spark.checkpoint.dir"
            return self.value

    class Fake:
        class sparkContext:
            master = "yarn"
            applicationId = "x"

        def __init__(self, value):
            self.conf = Conf(value)

    assert staging_root(Fake("hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(ValueError):
        staging_root(Fake(None))


@pytest.fixture
def small_queries(spark, monkeypatch):
    """The model queries on a small table, with small models; gives the module and the rows of every fit."""
    from memberlytics.plans import model_queries as mq

    rnd, rows = random.Random(6), []
    for i in range(300):
        a = rnd.random()
        month = datetime.date(2000, 1 + i % 12, 1)
        rows.append((i // 2, month, month, a, rnd.choice("uvw"), int(a > 0.5), rnd.choice(["UP", "SAME", "DOWN"])))
    table = spark.createDataFrame(rows, "member_id long, month date, signup_month date, n_a double, i_c string, renewal_flag int, outcome string")
    fitted, fit = [], ml.fit_model

    def small_fit(df, target, keys, algo="gbt", params=None, one_hot=False):
        fitted.append(df.count())
        return fit(df, target, keys, algo, {"maxDepth": 2, "maxIter" if algo == "gbt" else "numTrees": 2}, one_hot)

    monkeypatch.setattr(mq, "renewal_data", lambda spark, sf: table.drop("outcome").localCheckpoint())
    monkeypatch.setattr(mq, "migration_data", lambda spark, sf, k=3: table.drop("signup_month", "renewal_flag"))
    monkeypatch.setattr(mq, "FIT_ROWS", 50, raising=False)  # a bound that there was
    monkeypatch.setattr(ml, "fit_model", small_fit)
    return mq, table, fitted


def test_models_are_fitted_on_all_training_rows(spark, small_queries):
    mq, table, fitted = small_queries
    part = portable_bucket(["member_id"], 10_000, 1000) < 8000
    train, early = table.filter(part).count(), table.filter(f"month < '{mq.CUTOFF}'").count()
    assert 50 < train < 300 and 50 < early < 300
    for name in ("ml_gbt_scores", "ml_importances", "ml_metrics", "ml_score", "ml_score_input", "ml_contributions"):
        fitted.clear()
        assert getattr(mq, name)(spark, "").count() and fitted == [train], name
    for name, rows in (("ml_rf_scores", train), ("auc_migration_6m", train), ("ml_score_cutoff", early)):
        fitted.clear()
        assert getattr(mq, name)(spark, "").count() and fitted == [rows], name


def test_cross_validation_tries_every_point_on_every_fold(spark, small_queries, monkeypatch):
    mq, _, _ = small_queries
    fitted, found, search, best = [], [], ml.grid_search, ml.fit_best
    grid, fixed = {"maxDepth": [1, 2], "maxIter": [1, 2]}, {"maxBins": 8}

    def small_search(encoded, target, fold, **kw):
        found.append(search(encoded, target, fold, grid, params=fixed, **kw))
        return found[-1]

    monkeypatch.setattr(ml, "grid_search", small_search)
    monkeypatch.setattr(ml, "fit_best", lambda df, encoded, target: fitted.append(encoded.count()) or best(df, encoded, target, grid, fixed))
    got = mq.ml_cv(spark, "").collect()
    assert {r["point"]: r["folds"] for r in found[0].collect()} == dict.fromkeys(range(4), 5)
    assert len(got) == 4 and all(r["in_range"] for r in got) and fitted == [244]


def test_the_best_point_is_fitted_again(spark, data):
    encoded = ml.fit_encoder(data, "y", KEYS).transform(data)
    found = spark.createDataFrame([(0, "", 5, 0.6), (1, "", 5, 0.8), (2, "", 5, 0.8)], "point int, params string, folds int, auc double")
    model = ml.fit_best(found, encoded, "y", {"maxDepth": [1, 2, 3]}, {"maxIter": 2, "maxBins": 8})
    assert model.getMaxDepth() == 2 and model.getNumTrees == 2 and ml.area(model.transform(encoded), "y") > 0.8
