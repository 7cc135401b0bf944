"""Preprocessing, training, evaluation and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from memberlytics.functions import portable_bucket
from memberlytics.operators import shape
from memberlytics.operators.ranking import rank_sum_auc

FEATURES = "features"
# Defaults of the models.
PARAMS = {
    "maxDepth": 5,
    "maxBins": 48,
    "maxMemoryInMB": 256,
    "cacheNodeIds": True,
    "subsamplingRate": 1.0,
    "featureSubsetStrategy": "all",
    "seed": 1000,
}
GBT_PARAMS = {"maxIter": 20, "stepSize": 0.1}
FOREST_PARAMS = {"numTrees": 10}
GRID = {"maxDepth": [2, 4, 6], "maxBins": [40, 50], "maxIter": [10, 15]}


def prepare(df: DataFrame, target: str, keys: Sequence[str], where: str | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Filter, drop, cast by role and fill missing values."""
    if where:
        df = df.filter(where)
    df = df.drop(*exclude)
    numeric, categorical = shape.roles(df, target, keys)
    return shape.impute(shape.cast_roles(df, numeric, categorical), numeric, categorical)


REST = "rest_of_values"


def frequent_values(df: DataFrame, categorical: Sequence[str], bins: int) -> dict[str, list[str]]:
    """For each category with more than ``bins`` - 2 values its most frequent ones, ties by value; two bins are for the rest and the unseen.

    One pass estimates the numbers of values; only columns near the limit or above it are counted exactly.
    """
    limit = bins - 2
    if not categorical:
        return {}
    about = df.agg(*[F.approx_count_distinct(c).alias(c) for c in categorical]).first()
    found = {}
    for c in categorical:
        if about[c] > 0.7 * limit:
            top = df.groupBy(c).count().orderBy(F.desc("count"), c).limit(limit + 1).collect()
            if len(top) > limit:
                found[c] = [r[0] for r in top[:limit] if r[0] is not None]
    return found


def cut_stage(kept: Mapping[str, Sequence[str]]) -> SQLTransformer:
    """A stage that adds ``{name}_kept``: the value if it is among the kept ones, else the rest."""
    text = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    cases = [f"CASE WHEN `{c}` IN ({', '.join(map(text, values))}) THEN `{c}` ELSE '{REST}' END AS `{c}_kept`" for c, values in kept.items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(cases)} FROM __THIS__")


def encoder_stages(
    numeric: Sequence[str], categorical: Sequence[str], one_hot: bool = False, kept: Mapping[str, Sequence[str]] | None = None
) -> list:
    """One indexer for all categories (a single pass), optional one-hot vectors, one vector.

    Unseen categories get an index of their own, so scoring never fails on them.  ``kept`` (``frequent_values``) joins the other
    values of its categories to one first.
    """
    stages, inputs = [], list(numeric)
    if kept:
        stages.append(cut_stage(kept))
    if categorical:
        indexed = [f"{c}_indexed" for c in categorical]
        source = [f"{c}_kept" if kept and c in kept else c for c in categorical]
        stages.append(StringIndexer(inputCols=source, outputCols=indexed, handleInvalid="keep", stringOrderType="frequencyDesc"))
        if one_hot:
            vectors = [f"{c}_vec" for c in indexed]
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=vectors, dropLast=False))
            indexed = vectors
        inputs += indexed
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=FEATURES)]


def classifier(target: str, algo: str = "gbt", params: Mapping | None = None):
    kind, extra = (GBTClassifier, GBT_PARAMS) if algo == "gbt" else (RandomForestClassifier, FOREST_PARAMS)
    settings = {**PARAMS, **extra, **(params or {})}
    return kind(labelCol=target, featuresCol=FEATURES, **settings)


def fit_encoder(df: DataFrame, target: str, keys: Sequence[str], one_hot: bool = False) -> PipelineModel:
    numeric, categorical = shape.roles(df, target, keys)
    kept = frequent_values(df, categorical, PARAMS["maxBins"])
    return Pipeline(stages=encoder_stages(numeric, categorical, one_hot, kept)).fit(df)


def fit_model(
    df: DataFrame, target: str, keys: Sequence[str], algo: str = "gbt", params: Mapping | None = None, one_hot: bool = False
) -> PipelineModel:
    """Encoder and classifier as one model, saved and loaded as one."""
    numeric, categorical = shape.roles(df, target, keys)
    kept = frequent_values(df, categorical, (params or {}).get("maxBins", PARAMS["maxBins"]))
    stages = [*encoder_stages(numeric, categorical, one_hot, kept), classifier(target, algo, params)]
    fitted = Pipeline(stages=stages).fit(df)
    # A forest keeps the summary of its training and with it the session, which cannot be sent to tasks once the session has
    # observed a write.  A copy comes without the summary.
    return PipelineModel([*fitted.stages[:-1], fitted.stages[-1].copy()])


def grid_points(grid: Mapping[str, Sequence] = GRID) -> list[dict]:
    """All combinations, the last parameter changing fastest."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def grid_search(
    encoded: DataFrame, target: str, fold: str, grid: Mapping[str, Sequence] = GRID, folds: int = 5, params: Mapping | None = None,
    parallelism: int = 4, halving: bool = True,
) -> DataFrame:
    """One row per grid point: ``point``, ``params``, ``folds`` it was fitted on and its mean area under the curve.

    ``encoded`` holds the features, the target and in ``fold`` a number from 0 to ``folds`` - 1 that keeps what belongs together,
    such as the rows of a member, on one side of every split (``member_folds``).  It should be a written table, because
    every fit reads it.  With ``halving`` each fold is a round after which the better half of the points goes on, at least one; without,
    every point is tried on every fold.  Points that differ in ``maxIter`` only share a fit: boosting adds a tree an iteration and changes
    none, so the model of fewer iterations is the first trees of the longest one.
    """
    points, found = grid_points(grid), {}
    metric = BinaryClassificationEvaluator(labelCol=target, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    alive = list(range(len(points)))
    iterations = lambda i: {**GBT_PARAMS, **(params or {}), **points[i]}["maxIter"]
    with ThreadPoolExecutor(parallelism) as pool:
        for f in range(folds):
            train, test = encoded.filter(F.col(fold) != f), encoded.filter(F.col(fold) == f)

            def fit(group: list[int]) -> list[float]:
                most = max(group, key=iterations)
                model = classifier(target, "gbt", {**(params or {}), **points[most]}).fit(train)  # noqa: B023
                scored = margins(model, test, [iterations(i) for i in group])  # noqa: B023
                return [metric.evaluate(scored, {metric.rawPredictionCol: f"margin_{iterations(i)}"}) for i in group]

            groups: dict[str, list[int]] = {}
            for i in alive:
                groups.setdefault(str({k: v for k, v in points[i].items() if k != "maxIter"}), []).append(i)
            for group, aucs in zip(groups.values(), pool.map(fit, groups.values())):
                for i, auc in zip(group, aucs):
                    found.setdefault(i, []).append(float(auc))
            if halving:
                alive = sorted(alive, key=lambda i: (-sum(found[i]) / len(found[i]), i))[: -(-len(alive) // 2)]
    names = [", ".join(f"{k}={v}" for k, v in sorted(p.items())) for p in points]
    rows = [(i, names[i], len(m), sum(m) / len(m)) for i, m in sorted(found.items())]
    return encoded.sparkSession.createDataFrame(rows, "point int, params string, folds int, auc double")


def fit_best(found: DataFrame, encoded: DataFrame, target: str, grid: Mapping[str, Sequence] = GRID, params: Mapping | None = None):
    """The model of the point with the largest area that ``grid_search`` found, the first one of equals, fitted on all rows."""
    best = found.orderBy(F.desc("auc"), "point").first()
    return classifier(target, "gbt", {**(params or {}), **grid_points(grid)[best["point"]]}).fit(encoded)


def area(predicted: DataFrame, target: str) -> float:
    """Area under the curve of a model of two classes."""
    metric = BinaryClassificationEvaluator(labelCol=target, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    return float(metric.evaluate(predicted))


def margins(model, df: DataFrame, iterations: Sequence[int]) -> DataFrame:
    """Adds ``margin_{k}`` for each k: the weighted sum of the first k trees of a boosted model, what its raw prediction is made of."""
    most = max(iterations)
    for i, tree in enumerate(model.trees[:most]):
        df = tree.setFeaturesCol(FEATURES).setPredictionCol(f"_tree{i}").transform(df)
    terms = [F.col(f"_tree{i}") * F.lit(w) for i, w in enumerate(model.treeWeights[:most])]
    out = {f"margin_{k}": reduce(lambda a, b: a + b, terms[:k]) for k in iterations}
    return df.withColumns(out).drop(*[f"_tree{i}" for i in range(most)])


def member_folds(df: DataFrame, key: str, folds: int = 5, seed: int = 0, name: str = "fold") -> DataFrame:
    """Adds a fold number that is the same for all rows of a key on every run."""
    return df.withColumn(name, portable_bucket([key], folds, seed))


def evaluate(predicted: DataFrame, target: str) -> DataFrame:
    """Rows (metric, value).  With more than two classes there is an area under the curve for each, against all others."""
    spark = predicted.sparkSession
    values, classes = [], _classes(predicted)
    if classes == 2:
        values.append(("auc", area(predicted, target)))
    elif classes > 2:
        p = predicted.select(F.col(target).cast("double").alias("y"), vector_to_array("probability").alias("p"))
        each = rank_sum_auc(p, "y", {float(k): F.get("p", F.lit(k)) for k in range(classes)})
        values += [(f"auc_{int(r['class'])}", r["auc"]) for r in each.orderBy("class").collect()]  # a row a class
    # One pass: everything else follows from the counts of (label, prediction).
    counts = predicted.groupBy(F.col(target).cast("double").alias("y"), F.col("prediction").alias("p")).count().collect()
    total = sum(r["count"] for r in counts)
    sums = {"f1": 0.0, "weightedPrecision": 0.0, "weightedRecall": 0.0}
    for label in {r["y"] for r in counts}:
        actual = sum(r["count"] for r in counts if r["y"] == label)
        given = sum(r["count"] for r in counts if r["p"] == label)
        hit = sum(r["count"] for r in counts if r["y"] == label == r["p"])
        precision, recall = hit / given if given else 0.0, hit / actual
        both = 2 * precision * recall / (precision + recall) if hit else 0.0
        for name, x in (("f1", both), ("weightedPrecision", precision), ("weightedRecall", recall)):
            sums[name] += x * actual / total
    values.append(("accuracy", sum(r["count"] for r in counts if r["y"] == r["p"]) / total if total else 0.0))
    values += list(sums.items())
    return spark.createDataFrame(values, "metric string, value double")


def _classes(predicted: DataFrame) -> int:
    row = predicted.select(F.size(vector_to_array("probability")).alias("n")).first()
    return row["n"] if row else 0


def score(model, df: DataFrame, threshold: float = 0.38, label: str = "scored_label") -> DataFrame:
    """Probability of class 1 and the label it gives at the threshold.  No Python runs per row."""
    p = vector_to_array("probability")
    out = model.transform(df).withColumn("score", F.get(p, F.lit(1)))
    return out.withColumn(label, F.when(F.col("score") >= threshold, 1).otherwise(0))


def feature_names(encoded: DataFrame, column: str = FEATURES) -> list[str]:
    """Names of the vector's positions, from the column metadata."""
    attrs = encoded.schema[column].metadata["ml_attr"]["attrs"]
    found = {a["idx"]: a.get("name", str(a["idx"])) for group in attrs.values() for a in group}
    return [found[i] for i in sorted(found)]


def importances(model, encoded: DataFrame) -> DataFrame:
    """Rows (feature, importance), one per position of the feature vector."""
    weights = model.featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(feature_names(encoded), weights)]
    return encoded.sparkSession.createDataFrame(rows, "feature string, importance double")
