"""Model training and scoring on the renewal and migration tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from memberlytics import functions as fn
from memberlytics.models import explain, training as ml
from memberlytics.operators import labels as lb, shape
from memberlytics.operators.ranking import rank_sum_auc
from memberlytics.plans import bindings as b, label_queries as lq
from memberlytics.plans.catalog import query
from memberlytics.plans.oracle import DENSE_ONLY, PANEL, cte
from memberlytics.plans.panel_queries import _md5_bucket
from memberlytics.plans.window_queries import KEY
from memberlytics.session import stage, staging_path
from memberlytics.sources import writers as wr

KEYS = ["member_id", "month", "signup_month"]
TARGET = "renewal_flag"


def renewal_data(spark, sf):
    """Prepared training rows, written once because training reads them many times."""
    return stage(ml.prepare(lq.renewal_rows(spark, sf, write=False), TARGET, KEYS, exclude=["n_signup_year"]), "renewal")


def renewal_split(spark, sf):
    return shape.group_split(renewal_data(spark, sf), "member_id", [0.8, 0.2], seed=1000)


def renewal_model(train):
    """The model fitted on all rows of the training part."""
    return ml.fit_model(train, TARGET, KEYS, "gbt")


@query(
    "ml_string_index",
    cte(PANEL, body="""SELECT member_id, month, CAST(rk AS DOUBLE) AS region_index FROM panel JOIN (
      SELECT region, row_number() OVER (ORDER BY count(*) DESC, region) - 1 AS rk FROM panel GROUP BY 1) USING (region)"""),
)
def ml_string_index(spark, sf):
    p = b.panel(spark, sf).select(*KEY, F.col("region").alias("i_region"))
    encoder = ml.encoder_stages([], ["i_region"])[0]
    return encoder.fit(p).transform(p).select(*KEY, F.col("i_region_indexed").alias("region_index"))


@query(
    "ml_one_hot",
    cte(PANEL, body="""SELECT member_id, month, 2::BIGINT AS ones, r AS region_at, regions + 1 + k AS rank_at, CAST(regions + ranks + 2 AS INTEGER) AS size
      FROM panel JOIN (SELECT region, row_number() OVER (ORDER BY count(*) DESC, region) - 1 AS r, count(*) OVER () AS regions FROM panel GROUP BY 1)
        USING (region)
      JOIN (SELECT rank, row_number() OVER (ORDER BY n DESC, text) - 1 AS k, count(*) OVER () AS ranks FROM (
        SELECT rank, coalesce(rank::VARCHAR, 'unknown_filled') AS text, count(*) AS n FROM panel GROUP BY 1)) z ON z.rank IS NOT DISTINCT FROM panel.rank"""),
)
def ml_one_hot(spark, sf):
    """The places of the ones in the vector of two encoded categories, each with a place for unseen values."""
    p = b.panel(spark, sf).select(*KEY, F.col("region").alias("i_region"), F.col("rank").cast("string").alias("i_rank"))
    p = shape.impute(p, [], ["i_region", "i_rank"])
    model = ml.fit_encoder(p, "none", list(KEY), one_hot=True)
    v = model.transform(p).select(*KEY, vector_to_array(ml.FEATURES).alias("v"))
    places = F.filter(F.transform("v", lambda x, i: F.when(x == 1, i.cast("long"))), lambda i: i.isNotNull())
    v = v.select(*KEY, F.size("v").alias("size"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x).cast("long").alias("ones"), places.alias("at"))
    return v.select(*KEY, "ones", F.get("at", F.lit(0)).alias("region_at"), F.get("at", F.lit(1)).alias("rank_at"), "size")


@query(
    "ml_frequent_categories",
    """SELECT category, count(*) AS n FROM (SELECT CASE WHEN r <= 46 THEN l_partkey::VARCHAR ELSE 'rest_of_values' END AS category FROM lineitem
       JOIN (SELECT l_partkey AS k, row_number() OVER (ORDER BY count(*) DESC, l_partkey::VARCHAR) AS r FROM lineitem GROUP BY 1) ON l_partkey = k)
       GROUP BY 1""",
)
def ml_frequent_categories(spark, sf):
    """A category with as many values as there are parts: what the fitted cut keeps, and the rest."""
    items = b.table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("i_part"))
    out = ml.cut_stage(ml.frequent_values(items, ["i_part"], 48)).transform(items)
    return out.groupBy(F.col("i_part_kept").alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("ml_assemble", cte(PANEL, body="SELECT member_id, month, CAST(pv + rev + orders AS DOUBLE) AS total FROM panel"))
def ml_assemble(spark, sf):
    p = b.monthly(spark, sf).select(*KEY, "pv", "rev", F.col("orders").cast("double").alias("orders"))
    out = ml.encoder_stages(["pv", "rev", "orders"], [])[0].transform(p)
    total = F.aggregate(vector_to_array(ml.FEATURES), F.lit(0.0), lambda acc, x: acc + x)
    return out.select(*KEY, total.alias("total"))


# What SQL can state of a model's result: whose rows it has, their labels and parts, and that the values keep their rules.

_ROWS = lq.RENEWAL_SQL + """,
rows_ AS (SELECT member_id, month, renewal_flag FROM panel JOIN renewal USING (member_id)
  WHERE tenure BETWEEN 1 AND 15 AND status = 'ACTIVE' AND panel.member_type = 'I'),
parts AS (SELECT *, CASE WHEN """ + _md5_bucket("member_id", 10_000, 1000) + """ < 8000 THEN 'train' ELSE 'test' END AS part FROM rows_)"""


def renewal_sql(body: str) -> str:
    return cte(PANEL, DENSE_ONLY, _ROWS, body=body)


def migration_sql(body: str) -> str:
    rows = """
mrows AS (SELECT p.member_id, p.month, CAST(CASE label_3m WHEN 'UP' THEN 2 WHEN 'SAME' THEN 1 ELSE 0 END AS DOUBLE) AS label
  FROM panel p JOIN outcome o ON o.member_id = p.member_id AND o.month = p.month
  WHERE status = 'ACTIVE' AND p.member_type = 'I' AND max_3m > 0),
mparts AS (SELECT *, CASE WHEN """ + _md5_bucket("member_id", 10_000, 1000) + """ < 8000 THEN 'train' ELSE 'test' END AS part FROM mrows)"""
    return cte(PANEL, DENSE_ONLY, lq._migration_sql(3), rows, body=body)


def _finite(c):
    return F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


@query("ml_preprocess", renewal_sql("SELECT member_id, month, part, renewal_flag, 1::BIGINT AS sizes, true AS finite FROM parts"))
def ml_preprocess(spark, sf):
    """Every row of both parts as a vector; all vectors have one length and no gaps."""
    train, test = renewal_split(spark, sf)
    encoder = ml.fit_encoder(train, TARGET, KEYS)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    rows = encoder.transform(both).select("member_id", "month", "part", TARGET, vector_to_array(ml.FEATURES).alias("v"))
    rows = stage(rows.select("member_id", "month", "part", TARGET, F.size("v").alias("size"), _finite("v").alias("finite")), "vectors")
    sizes = rows.agg(F.count_distinct("size")).scalar()
    return rows.select("member_id", "month", "part", TARGET, sizes.alias("sizes"), "finite")


def renewal_scores(spark, sf):
    """The scored test part: key, label, prediction and probability of class 1."""
    train, test = renewal_split(spark, sf)
    out = renewal_model(train).transform(test)
    return out.select("member_id", "month", TARGET, "prediction", F.get(vector_to_array("probability"), F.lit(1)).alias("p"))


@query("ml_gbt_scores", renewal_sql("SELECT member_id, month, renewal_flag, true AS in_range, true AS follows FROM parts WHERE part = 'test'"))
def ml_gbt_scores(spark, sf):
    """The probability is one, and the prediction is the likelier class."""
    follows = (F.col("prediction") == 1) == (F.col("p") > 0.5)
    return renewal_scores(spark, sf).select("member_id", "month", TARGET, F.col("p").between(0, 1).alias("in_range"), follows.alias("follows"))


def migration_data(spark, sf, k: int = 3):
    """Migration rows over k months of positive members on the wide table; only theirs are made, and the caller writes them."""
    _, positive = lb.split_by_sign(lq.migration_rows(spark, sf, k, f"_plain.max_{k}m > 0"), f"max_{k}m")
    return positive.drop(f"future_max_{k}m").withColumnRenamed(f"max_{k}m", f"n_max_{k}m").withColumnRenamed(f"label_{k}m", "outcome")


MIGRATION_KEYS = [*KEY]


def migration_scores(spark, sf, k: int):
    """The scored test part of the three classes of migration over k months."""
    rows = migration_data(spark, sf, k).withColumn("label", fn.encode_label("outcome", "multi").cast("double"))
    rows = stage(ml.prepare(rows.drop("outcome"), "label", MIGRATION_KEYS), "migration")
    train, test = shape.group_split(rows, "member_id", [0.8, 0.2], seed=1000)
    return ml.fit_model(train, "label", MIGRATION_KEYS, "forest", one_hot=True).transform(test)


@query("ml_rf_scores", migration_sql("SELECT member_id, month, label, true AS sums_to_one, true AS follows FROM mparts WHERE part = 'test'"))
def ml_rf_scores(spark, sf):
    """The class probabilities add up to one, and the prediction is the likeliest class."""
    out = migration_scores(spark, sf, 3).select(*KEY, "label", "prediction", vector_to_array("probability").alias("p"))
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    top = F.get("p", F.col("prediction").cast("int")) == F.array_max("p")
    return out.select(*KEY, "label", (F.abs(total - 1) < 1e-9).alias("sums_to_one"), top.alias("follows"))


@query("ml_importances", renewal_sql("SELECT count(*) AS n_train, 1.0::DOUBLE AS total, 0::BIGINT AS negative, true AS some_used FROM parts WHERE part = 'train'"))
def ml_importances(spark, sf):
    """Importances are shares: none is negative and they add up to one."""
    train, _ = renewal_split(spark, sf)
    model = renewal_model(train)
    found = ml.importances(model.stages[-1], model.transform(train))
    n = train.agg(F.count(F.lit(1))).scalar()
    return found.agg(F.round(F.sum("importance"), 9).alias("total"), F.count(F.when(F.col("importance") < 0, 1)).alias("negative"),
                     (F.count(F.when(F.col("importance") > 0, 1)) > 0).alias("some_used")).select(n.alias("n_train"), "total", "negative", "some_used")


_METRICS = ("auc", "accuracy", "f1", "weightedPrecision", "weightedRecall")


@query("ml_metrics", renewal_sql("SELECT metric, n_test, true AS in_range FROM (SELECT count(*) AS n_test FROM parts WHERE part = 'test'), (VALUES "
                                 + ", ".join(f"('{m}')" for m in _METRICS) + ") AS v(metric)"))
def ml_metrics(spark, sf):
    train, test = renewal_split(spark, sf)
    predicted = stage(renewal_model(train).transform(test).select(TARGET, "prediction", "rawPrediction", "probability"), "predicted")
    n = predicted.agg(F.count(F.lit(1))).scalar()
    return ml.evaluate(predicted, TARGET).select("metric", n.alias("n_test"), F.col("value").between(0, 1).alias("in_range"))


CLASSES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")  # fixed values: the regions


@query(
    "auc_rank_sum",
    cte(PANEL, body="SELECT class, sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives, "
        "sum(pos * (2 * below + neg))::DOUBLE / (2 * sum(pos)::DOUBLE * sum(neg)) AS auc FROM (SELECT *, coalesce(sum(neg) OVER "
        "(PARTITION BY class ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (SELECT class, x, "
        "count(*) FILTER (y = class) AS pos, count(*) FILTER (y <> class) AS neg FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS class, region AS y, (age * {i + 3} + orders) % 29 AS x FROM panel" for i, c in enumerate(CLASSES)
        ) + ") GROUP BY 1, 2)) GROUP BY class"),
)
def auc_rank_sum(spark, sf):
    """Areas under the curve of five classes, each with a score of its own that has many ties."""
    p = b.panel(spark, sf).select("region", "age", "orders")
    return rank_sum_auc(p, "region", {c: (F.col("age") * (i + 3) + F.col("orders")) % 29 for i, c in enumerate(CLASSES)})


@query(
    "auc_migration_6m",
    cte(PANEL, DENSE_ONLY, lq._migration_sql(6), body=f"""SELECT class, count(*) FILTER (label = class) AS positives,
      count(*) FILTER (label <> class) AS negatives, true AS in_range FROM (
        SELECT CASE label_6m WHEN 'UP' THEN 2.0::DOUBLE WHEN 'SAME' THEN 1 ELSE 0 END AS label FROM panel p
        JOIN outcome o ON o.member_id = p.member_id AND o.month = p.month WHERE status = 'ACTIVE' AND p.member_type = 'I' AND max_6m > 0
        AND {_md5_bucket("p.member_id", 10_000, 1000)} >= 8000), (VALUES (0.0::DOUBLE), (1.0), (2.0)) AS c(class) GROUP BY class"""),
)
def auc_migration_6m(spark, sf):
    """The six-month migration model: areas under the curve of its three classes on the test part."""
    p = stage(migration_scores(spark, sf, 6).select("label", vector_to_array("probability").alias("p")), "scored")
    out = rank_sum_auc(p, "label", {float(k): F.coalesce(F.get("p", F.lit(k)), F.lit(0.0)) for k in range(3)})
    return out.select("class", "positives", "negatives", F.coalesce(F.col("auc").between(0, 1), F.lit(True)).alias("in_range"))


FOLDS = 5


@query(
    "ml_cv",
    renewal_sql("""SELECT CAST(point AS INTEGER) AS point, params, true AS in_range, members, 1::BIGINT AS most_folds, folds FROM (
      SELECT count(DISTINCT member_id) AS members, count(DISTINCT """ + _md5_bucket("member_id", FOLDS, 3) + """) AS folds FROM parts WHERE part = 'train'),
      (VALUES """ + ", ".join(f"({i}, '{', '.join(f'{k}={v}' for k, v in sorted(p.items()))}')" for i, p in enumerate(ml.grid_points())) + ") AS g(point, params)"),
)
def ml_cv(spark, sf):
    """Every grid point on each of five folds of members; a member is in one fold.

    The best point is fitted again on all of the training part, and its area on the test part has to be one as well.
    """
    train, test = renewal_split(spark, sf)
    encoder = ml.fit_encoder(train, TARGET, KEYS)
    encoded = ml.member_folds(encoder.transform(train), "member_id", FOLDS, seed=3)
    encoded = stage(encoded.select("member_id", "fold", ml.FEATURES, TARGET), "encoded")
    per = encoded.groupBy("member_id").agg(F.count_distinct("fold").alias("n"), F.min("fold").alias("fold"))
    per = per.agg(F.struct(F.count(F.lit(1)).alias("members"), F.max("n").alias("most"), F.count_distinct("fold").alias("folds"))).scalar()
    found = ml.grid_search(encoded, TARGET, "fold", folds=FOLDS, halving=False)
    best = ml.fit_best(found, encoded, TARGET)
    final = ml.area(best.transform(encoder.transform(test).select(ml.FEATURES, TARGET)), TARGET)
    in_range = F.col("auc").between(0, 1) & F.lit(0 <= final <= 1) & (F.col("folds") == FOLDS)
    return found.select("point", "params", in_range.alias("in_range"), per["members"].alias("members"),
                        per["most"].alias("most_folds"), per["folds"].alias("folds"))


@query(
    "ml_feature_manifest",
    cte(*lq._RENEWAL_PARTS, body="SELECT feature, n_scored FROM (UNPIVOT (SELECT count(coalesce(COLUMNS(* EXCLUDE (member_id, month, signup_month, "
        "signup_year, renewal_flag, sponsor_id, global_rank_no, global_rank_desc, n_signup_year))::VARCHAR, '')) FROM rows_ WHERE "
        + _md5_bucket("member_id", 10_000, 1000) + " >= 8000) ON COLUMNS(*) INTO NAME feature VALUE n_scored) WHERE feature[1:2] IN ('n_', 'i_')"),
)
def ml_feature_manifest(spark, sf):
    """The saved feature list, after checking it against the scoring table."""
    train, test = renewal_split(spark, sf)
    numeric, categorical = shape.roles(train, TARGET, KEYS)
    path = staging_path(spark, "manifest")
    wr.write_manifest(train, numeric + categorical, path)
    wr.check_manifest(spark, numeric + categorical, path)
    names = spark.read.parquet(path).schema.names
    counts = test.agg(*[F.count(n).alias(n) for n in names])
    return counts.select(F.expr(f"stack({len(names)}, " + ", ".join(f"'{n}', {n}" for n in names) + ") AS (feature, n_scored)"))


def saved_model(spark, train):
    """The model after a round trip through storage, as a scoring job sees it."""
    from pyspark.ml import PipelineModel

    path = staging_path(spark, "renewal-model")
    renewal_model(train).write().save(path)
    return PipelineModel.load(path)


@query("ml_score_input", renewal_sql("SELECT member_id, month, true AS finite FROM parts WHERE part = 'test'"))
def ml_score_input(spark, sf):
    """Vectors of rows without a label, made by the saved encoder."""
    train, test = renewal_split(spark, sf)
    model = saved_model(spark, train)
    encoded = test.drop(TARGET)
    for step in model.stages[:-1]:
        encoded = step.transform(encoded)
    v = encoded.select("member_id", "month", vector_to_array(ml.FEATURES).alias("v"))
    return v.select("member_id", "month", _finite("v").alias("finite"))


THRESHOLD = 0.38  # fixed value: the default threshold


def _kept(scored):
    follows = F.col("scored_label") == fn.flag(F.col("score") >= THRESHOLD)
    return scored.select("member_id", "month", F.col("score").between(0, 1).alias("in_range"), follows.alias("follows"))


@query("ml_score", renewal_sql("SELECT member_id, month, true AS in_range, true AS follows FROM parts WHERE part = 'test'"))
def ml_score(spark, sf):
    train, test = renewal_split(spark, sf)
    return _kept(ml.score(saved_model(spark, train), test.drop(TARGET), THRESHOLD))


CUTOFF = "2000-06-01"


@query("ml_score_cutoff", migration_sql(f"SELECT member_id, month, true AS in_range, true AS follows FROM mrows WHERE month >= DATE '{CUTOFF}'"))
def ml_score_cutoff(spark, sf):
    """Train on the periods before the date, score the later ones after the manifest check."""
    rows = migration_data(spark, sf).withColumn("label", fn.encode_label("outcome").cast("double"))
    rows = stage(ml.prepare(rows.drop("outcome"), "label", MIGRATION_KEYS), "migration")
    train, later = lb.split_by_cutoff(rows, "month", CUTOFF)
    numeric, categorical = shape.roles(train, "label", MIGRATION_KEYS)
    path = staging_path(spark, "manifest")
    wr.write_manifest(train, numeric + categorical, path)
    model = ml.fit_model(train, "label", MIGRATION_KEYS, "gbt", one_hot=True)
    found = shape.roles(later, "label", MIGRATION_KEYS)
    wr.check_manifest(spark, found[0] + found[1], path)
    return _kept(ml.score(model, later.drop("label"), THRESHOLD))


@query("ml_contributions", renewal_sql("SELECT member_id, month, true AS adds_up, true AS is_margin FROM parts WHERE part = 'test'"))
def ml_contributions(spark, sf):
    """Contributions and bias add up to the margin, and the margin is the model's own."""
    train, test = renewal_split(spark, sf)
    model = renewal_model(train)
    raw = F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("raw")
    encoded = model.transform(test).select("member_id", "month", ml.FEATURES, raw)
    out = explain.contributions(model.stages[-1], encoded, ["member_id", "month", "raw"])
    total = F.aggregate(F.array(*[F.col(f"`{c}`") for c in out.columns if c.startswith("c_")]), F.lit(0.0), lambda a, x: a + x)
    return out.select("member_id", "month", (F.abs(total + F.col("bias") - F.col("margin")) < 1e-9).alias("adds_up"),
                      (F.abs(F.col("margin") - F.col("raw")) < 1e-9).alias("is_margin"))
