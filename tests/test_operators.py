"""Operators on small hand-made tables, against plain Python."""

import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from memberlytics import functions as fn
from memberlytics.operators import engage, features, intervals, labels as lb, panel as pn, ranking, rolling as ro, rollup, shape
from memberlytics.operators.rolling import Rolling


def d(y, m, day=1):
    return dt.date(y, m, day)


def months(start, n):
    return [d(start.year + (start.month - 1 + i) // 12, (start.month - 1 + i) % 12 + 1) for i in range(n)]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# --- ranking ---------------------------------------------------------------------------------


def brute_percent_rank(values):
    key = [(-1, 0) if v is None else (0, v) for v in values]
    n = len(values)
    return [0.0 if n == 1 else sum(k2 < k for k2 in key) / (n - 1) for k in key]


@pytest.mark.parametrize("hot", [0.0, 7.25, None])
def test_percent_ranks_equal_brute_force(spark, hot):
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        x = hot if rnd.random() < 0.4 else rnd.choice([rnd.uniform(-5, 5), round(rnd.lognormvariate(3, 4), 2), 1.0, None])
        data.append((i, rnd.choice(["a", "a", "a", "b", None]), rnd.choice([1, 2]), x))
    df = spark.createDataFrame(data, "id long, g string, h int, x double")
    scopes = {"all": [], "g": ["g"], "gh": ["g", "h"]}
    got = {r["id"]: r for r in ranking.percent_ranks(df, ["id"], {"x": "x"}, scopes).collect()}
    assert len(got) == len(data)
    for scope, key in (("all", lambda r: 0), ("g", lambda r: r[1]), ("gh", lambda r: (r[1], r[2]))):
        groups = defaultdict(list)
        for r in data:
            groups[key(r)].append(r)
        for members in groups.values():
            for r, want in zip(members, brute_percent_rank([m[3] for m in members])):
                assert got[r[0]][f"{scope}_x"] == pytest.approx(want, abs=1e-12)


def narrow_range(spark, n=20_000):
    """Two groups; the values of the first lie within 0.1 % of each other."""
    rnd = random.Random(2)
    data = [(i, "near", 1000 + rnd.random()) for i in range(n)] + [(n + i, "few", float(i % 7)) for i in range(50)]
    return spark.createDataFrame([*data, (n + 50, "near", None), (n + 51, "near", float("nan"))], "id long, g string, x double"), data


def test_cut_bucket_keeps_the_order(spark):
    rnd = random.Random(1)
    for size in (0, 1, 15, 16, 17, 255):
        cuts = sorted(rnd.sample(range(-1000, 1000), size))
        xs = [float(rnd.randrange(-1100, 1100)) for _ in range(200)] + [float(c) for c in cuts[:40]]
        df = spark.createDataFrame([([float(c) for c in cuts], x) for x in xs] + [([float(c) for c in cuts], None)], "c array<double>, x double")
        for r in df.select("x", ranking.cut_bucket(F.col("c"), F.col("x")).alias("b")).collect():
            assert r["b"] == (-1 if r["x"] is None else sum(c < r["x"] for c in cuts))


def test_no_window_task_sorts_a_narrow_group(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BUCKET", 500)
    df, _ = narrow_range(spark)
    cells = df.select("g", F.col("x").alias("_x"), F.lit(1).alias("_n"))
    _, large = ranking._totals(cells, ["g"])
    assert [r["g"] for r in large.collect()] == ["near"]
    out, _ = ranking.bucketed(cells, ["g"], large)
    sizes = {(r["g"], r["_b"]): r["count"] for r in out.groupBy("g", "_b").count().collect()}
    near = [n for (g, _), n in sizes.items() if g == "near"]
    assert len(near) >= 35 and max(near) < 1000 and sizes["few", 0] == 50


def test_ranks_and_quantiles_of_cut_groups_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BUCKET", 500)
    df, data = narrow_range(spark, 5000)
    got = {r["id"]: r["g_x"] for r in ranking.percent_ranks(df, ["id"], {"x": "x"}, {"g": ["g"]}).collect()}
    for g in ("near", "few"):
        values = [(i, x) for i, gg, x in data if gg == g] + ([(5050, None), (5051, math.inf)] if g == "near" else [])
        for (i, _), want in zip(values, brute_percent_rank([x for _, x in values])):
            assert got[i] == pytest.approx(want, abs=1e-12)
    xs = sorted(x for _, _, x in data)
    few = df.filter("x IS NOT NULL AND NOT isnan(x)")
    for q in (0.001, 0.5, 0.95, 1.0):
        assert ranking.exact_quantiles(few, ["x"], q).first()["q"] == xs[math.ceil(q * len(xs)) - 1]
        near = ranking.approx_quantiles(few, ["x"], q).first()["q"]
        assert abs(sum(x <= near for x in xs) / len(xs) - q) < 0.0165
    assert ranking.exact_quantiles(few.limit(0), ["x"], 0.5).count() == 0


@pytest.mark.parametrize("bucket", [50, 50_000])
def test_rank_sum_auc(spark, monkeypatch, bucket):
    monkeypatch.setattr(ranking, "BUCKET", bucket)
    rnd = random.Random(6)
    data = [(rnd.choice([0, 1, 1, 2, None]), rnd.choice([rnd.random(), 0.5, 0.0, -0.0, None])) for _ in range(800)]
    df = spark.createDataFrame(data, "y int, s double")
    scores = {0: -F.col("s"), 1: F.col("s"), 2: F.col("s") * F.col("s"), 3: F.col("s")}
    got = {r["class"]: r for r in ranking.rank_sum_auc(df, "y", scores).collect()}
    for k, f in ((0, lambda s: -s), (1, lambda s: s), (2, lambda s: s * s), (3, lambda s: s)):
        pos = [f(s) for y, s in data if y == k and s is not None]
        neg = [f(s) for y, s in data if y not in (k, None) and s is not None]
        assert (got[k]["positives"], got[k]["negatives"]) == (len(pos), len(neg))
        if pos:
            want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
            assert got[k]["auc"] == pytest.approx(want, abs=1e-12)
    assert got[3]["auc"] is None


def test_rank_sum_auc_equals_the_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(2000).select(F.hash("id").alias("h")).select((F.pmod("h", F.lit(97)) / 97.0).alias("s"), (F.pmod(F.hash("h"), F.lit(3)) == 0).cast("double").alias("y"))
    auc = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s").setNumBins(0).evaluate(df)
    assert ranking.rank_sum_auc(df, "y", {1.0: F.col("s")}).first()["auc"] == pytest.approx(auc, abs=1e-12)


def test_exact_quantiles(spark):
    rnd = random.Random(5)
    xs = [round(rnd.expovariate(0.01), 1) for _ in range(1001)]
    df = spark.createDataFrame([(x, -x) for x in xs], "a double, b double")
    got = {r["m"]: r["q"] for r in ranking.exact_quantiles(df, ["a", "b"], 0.95).collect()}
    for name, vals in (("a", sorted(xs)), ("b", sorted(-x for x in xs))):
        assert got[name] == vals[math.ceil(0.95 * len(vals)) - 1]
    capped = ranking.winsorize(df, ["a", "b"], 0.95).agg(F.max("a"), F.count("b")).first()
    assert tuple(capped) == (got["a"], 1001)


# --- rolling ---------------------------------------------------------------------------------


@pytest.fixture
def small(spark):
    data = [(1, m, float(i + 1)) for i, m in enumerate(months(d(2020, 1), 14))]
    data += [(2, d(2020, 1), 5.0), (2, d(2020, 6), None), (2, d(2021, 1), 7.0), (3, d(2020, 2), 0.0)]
    return spark.createDataFrame(data, "e long, p date, x double")


def test_rolling_counts_rows_and_sums_lags(small):
    out = ro.rolling(small, "e", "p", [Rolling("s", "x"), Rolling("r", "x", over="x * 2")], (3, 6))
    lags = ro.lagged(small, "e", "p", {"l1": "x"}).join(ro.lagged(small, "e", "p", {"l2": "x"}, 2), ["e", "p"]).filter("e = 1")
    summed = {r["p"]: sum(v or 0 for v in (r["l1"], r["l2"])) for r in lags.collect()}
    for r in out.filter("e = 1").collect():
        assert r["s_3m"] == r["x"] + summed[r["p"]]
    assert [r["s_3m"] for r in out.filter("e = 2").orderBy("p").collect()] == [5.0, 5.0, 12.0]
    assert out.filter("e = 3").first()["r_3m"] == 0.0
    assert out.filter("e = 1").first()["r_6m"] == 0.5


@pytest.mark.parametrize("ks", [(3, 6, 9, 12), (1, 2, 3, 4, 5), (2, 3, 5), (4,)])
def test_frames_equal_plain_windows(spark, ks):
    rnd = random.Random(9)
    data = [(e, m, rnd.choice([None, 0.0, float(rnd.randrange(100)), -3.0]), rnd.randrange(9)) for e in range(20) for m in months(d(2019, 1), rnd.randrange(1, 30))]
    df = spark.createDataFrame(data, "e long, p date, x double, n int")
    specs = [Rolling(f"{a}_{c}", c, a) for a in ro.AGGREGATES for c in ("x", "n")]
    specs += [Rolling("over", "x", over="n"), Rolling("over_avg", "n", "avg", over="x"), Rolling("per", "x", per="n")]
    got = ro.rolling(df, "e", "p", specs, ks)
    assert got.columns == df.columns + [f"{s.stem}_{k}m" for s in specs for k in ks]
    w = ro.by_entity("e", "p")
    for s in specs:
        for k in ks:
            frame = w.rowsBetween(1 - k, 0)
            plain = ro.AGGREGATES[s.agg](F.expr(s.expr)).over(frame)
            if s.over:
                plain = fn.safe_ratio(plain, ro.AGGREGATES[s.agg](F.expr(s.over)).over(frame))
            elif s.per:
                plain = fn.safe_ratio(plain, F.expr(s.per))
            got = got.withColumn(f"want_{s.stem}_{k}m", plain)
    for r in got.collect():
        for s in specs:
            for k in ks:
                a, b = r[f"{s.stem}_{k}m"], r[f"want_{s.stem}_{k}m"]
                assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-12)), (s.stem, k)


def test_large_values_leave_no_rounding_behind(spark):
    df = spark.createDataFrame([(1, m, x) for m, x in zip(months(d(2020, 1), 9), [1e17, 0.1, 0.2, 0.3, 0.1, 0.2, 0.3, 0.1, 0.2])], "e long, p date, x double")
    out = rows(ro.rolling(df, "e", "p", [Rolling("s", "x")], (3, 6)).select("p", "s_6m"), "p")
    assert out[-1][1] == pytest.approx(1.2, abs=1e-12)


def test_min_history(small):
    out = ro.rolling(small, "e", "p", [Rolling("s", "x")], (3,), min_history=True)
    assert [r["s_3m"] for r in out.filter("e = 1").orderBy("p").limit(4).collect()] == [None, None, 6.0, 9.0]


def test_momentum_and_yoy_guard_zero(spark, small):
    w = ro.rolling(small, "e", "p", [Rolling("s", "x")], (3, 6))
    m = ro.momentum(w, ["s"]).filter("e = 1").orderBy("p").collect()
    assert m[0]["s_3m_mom"] is None and m[5]["s_3m_mom"] == 15 / 6
    y = ro.yoy(small, "e", "p", ["x"]).filter("e = 1").orderBy("p").collect()
    assert y[12]["x_lyr"] == 1.0 and y[12]["x_12m_mom"] == 13.0 and y[11]["x_lyr"] is None


def test_same_period_last_year_follows_the_calendar(spark, small):
    out = small.withColumn("mi", fn.month_index("p"))
    out = out.select("e", "p", ro.same_period_last_year("e", "mi", "x").alias("ly"))
    assert [r["ly"] for r in out.filter("e = 2").orderBy("p").collect()] == [0.0, 0.0, 5.0]


# --- panel -----------------------------------------------------------------------------------


def test_densify_fills_each_entity_between_its_bounds(small):
    out = pn.densify(small, "e", "p", "month", {"x": 0.0})
    assert out.groupBy("e").count().orderBy("e").collect() == [(1, 14), (2, 13), (3, 1)]
    assert out.filter("e = 2").agg(F.sum("x")).first()[0] == 12.0


def test_dense_rows_are_not_merged_into_few_tasks(spark):
    """The bounds of an entity are a few bytes, its rows are many."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.createDataFrame([(k, m, 1) for k in range(100) for m in (d(1990, 1), d(1999, 12))], "id int, m date, v int")
    out = pn.densify(df, "id", "m", fill={"v": 0})
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p"), "id").count().groupBy("p").count().collect()]
    assert len(sizes) > n / 2 and sum(sizes) == 100  # an entity is in one partition
    assert out.count() == 100 * 120 and out.agg(F.sum("v")).first()[0] == 200


def test_at_offset_equals_shift_join(spark, small):
    dense = pn.densify(small, "e", "p", "month", {"x": 0.0})
    joined = pn.shift_join(dense, dense, "e", "p", 3, {"x": "later"}).select("e", "p", "later")
    framed = dense.withColumn("mi", fn.month_index("p")).select("e", "p", pn.at_offset("e", "mi", 3, F.col("x")).alias("later"))
    assert rows(joined, "e", "p") == rows(framed, "e", "p")


def test_union_and_regex_projection(spark, small):
    w = ro.rolling(small, "e", "p", [Rolling("s_sum", "x"), Rolling("s_avg", "x", "avg")], (3, 6))
    w = ro.yoy(ro.momentum(w, ["s_sum"]), "e", "p", ["s_sum_6m"])
    sliced = shape.slice_to_frame(w, 6)
    assert sliced.columns == ["e", "p", "x", "s_sum_month_agg", "s_avg_month_agg"]
    assert shape.summed_columns(sliced.columns) == ["s_sum_month_agg"]
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    both = shape.union_aligned([a, spark.createDataFrame([(3, "z")], "a int, c string")])
    assert rows(both, "a") == [(1, 2, None), (3, None, "z")]


# --- rollups ---------------------------------------------------------------------------------


def test_first_indicators_one_row_per_period_and_no_null_keys(spark):
    data = [(1, d(2020, 1), 0, 5), (1, d(2020, 2), 1, 9), (1, d(2020, 3), 1, 20), (2, d(2020, 1), 0, 0)]
    df = spark.createDataFrame(data, "e long, p date, o int, g int")
    preds = {"ordered": F.col("o") > 0, "g9": F.col("g").between(9, 10), "never": F.col("g") > 99, "g5": F.col("g") >= 5}
    got = rows(rollup.first_indicators(df, "e", "p", preds), "e", "p")
    assert got == [(1, d(2020, 1), 0, 0, 0, 1), (1, d(2020, 2), 1, 1, 0, 0)]
    flags = df.select("e", "p", *rollup.first_flag_columns("e", "p", preds))
    assert flags.filter("ordered + g9 + never + g5 > 0").count() == 2


def test_head_rollup_with_one_hot_head(spark):
    rnd = random.Random(2)
    data = []
    for i in range(400):
        head = -1 if rnd.random() < 0.5 else (i // 20) * 20
        data.append((i, d(2020, 1), None if i % 7 == 0 else (i // 20) * 20, head, rnd.choice("IC"), float(i % 5)))
    df = spark.createDataFrame(data, "id long, p date, sp long, head long, t string, pv double")
    measures = {"sellers": fn.flag(F.col("t") == "I"), "customers": fn.flag(F.col("t") == "C")}
    out = rollup.head_rollup(df, {"a": "head", "b": "head"}, "id", "p", "sp", measures, ["customers"],
                             keep=F.col("pv") < 4, ratio=("per", F.col("pv"), F.lit(1)))
    heads = {r[0] for r in data if r[0] == r[3]}
    want = defaultdict(lambda: [0, 0, 0.0, 0, 0])
    for i, _, sp, head, t, pv in data:
        if pv < 4:
            w = want[head]
            w[0] += t == "I"
            w[1] += t == "C"
            w[2] += pv
            w[3] += 1
            w[4] += t == "C" and sp == head and head in heads
    for level in "ab":
        got = {r["head"]: r for r in out.filter(F.col("level") == level).collect()}
        assert set(got) == set(want)
        for h, w in want.items():
            r = got[h]
            assert [r["sellers"], r["customers"], r["per"], r["front_customers"]] == [w[0], w[1], w[2] / w[3], w[4]]
    assert any(w[4] for w in want.values())
    trend = rollup.head_trend(out, "p", ["customers"], (3,))
    assert trend.filter("head = -1 and head_exists = 1").count() == 0


def test_promo_uses_the_revenue_of_its_own_line(spark):
    p = spark.createDataFrame([(1, d(2020, 3), 100.0, 5.0), (1, d(2020, 4), 100.0, 100.0)], "e long, m date, a double, b double")
    c = spark.createDataFrame([(d(2020, 3), "a", 50.0), (d(2020, 3), "b", 50.0), (d(2020, 3), "a", 200.0)], "m date, line string, unit_price double")
    got = rows(rollup.promo_response(p, ["e", "m"], "m", c, {"a": "a", "b": "b"}), "m")
    assert got == [(1, d(2020, 3), 1, 2.0 / 3, 0, 0.0), (1, d(2020, 4), 0, 0.0, 0, 0.0)]


def test_range_lookup_later_band_wins_and_unmatched_stays(spark):
    bands = spark.createDataFrame([(1, 0, 10, 1), (2, 5, 20, 2)], "pos int, lo int, hi int, rank int")
    df = spark.createDataFrame([(3,), (7,), (30,), (None,)], "v int")
    got = {r["v"]: r["band"] for r in rollup.range_lookup(df, "v", bands, "band").collect()}
    assert got == {3: 1, 7: 2, 30: 30, None: None}


@pytest.mark.parametrize("by_list", [1000, 0])
def test_range_lookup_both_ways(spark, by_list):
    rnd = random.Random(12)
    bands = [(i, lo := rnd.randrange(-500, 500), lo + rnd.choice([0, 1, 5, 300, -2]), i * 10) for i in range(60)] + [(61, None, 5, 1), (62, 5, None, 1)]
    values = [rnd.randrange(-600, 900) for _ in range(500)] + [7] * 400 + [None]
    df = spark.createDataFrame([(v, "x") for v in values], "v int, rank_ string")
    got = rollup.range_lookup(df, "v", spark.createDataFrame(bands, "pos int, lo int, hi int, rank int"), "band", by_list)
    want = sorted(((v, next((r for p, lo, hi, r in reversed(bands) if v is not None and None not in (lo, hi) and lo <= v <= hi), v)) for v in values), key=str)
    assert sorted(((r["v"], r["band"]) for r in got.collect()), key=str) == want


def test_lookup_in_a_million_bands(spark):
    """Bands of 1 to 3,000 numbers, each number in many of them; the result is checked against the rule that made them."""
    n = 1_000_000
    bands = spark.range(n).select(F.col("id").alias("pos"), (F.col("id") * 10).alias("lo"), (F.col("id") * 10 + F.col("id") % 3000).alias("hi"), (-F.col("id")).alias("r"))
    df = spark.range(0, 10 * n, 997).withColumnRenamed("id", "v")
    got = {r["v"]: r["r"] for r in intervals.interval_lookup(df, "v", bands, ["r"]).collect()}
    assert len(got) == len(range(0, 10 * n, 997))
    for v in range(0, 10 * n, 997):
        i = v // 10  # the last band that starts at or before v
        while i >= 0 and 10 * i + i % 3000 < v:
            i -= 1
        assert got[v] == (-i if i >= 0 else None)


def test_interval_lookup_by_keys_and_odd_tables(spark):
    bands = spark.createDataFrame([("a", 1, 0, 10, "x"), ("a", 2, 5, 6, "y"), ("b", 3, -(2**40), 2**40, "z"), (None, 4, 0, 9, "n")], "g string, pos int, lo long, hi long, o string")
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 7), ("a", 11), ("b", 5), ("b", -(2**40)), ("c", 5), (None, 5), ("a", None)], "g string, v long")
    got = intervals.interval_lookup(df, "v", bands, ["o"], by=["g"])
    want = [("a", 5, "y"), ("a", 5, "y"), ("a", 7, "x"), ("a", 11, None), ("b", 5, "z"), ("b", -(2**40), "z"), ("c", 5, None), (None, 5, None), ("a", None, None)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert intervals.interval_lookup(df, "v", bands.limit(0), ["o"], by=["g"]).filter("o IS NULL").count() == 9
    assert intervals.interval_lookup(df.limit(0), "v", bands, ["o"], by=["g"]).count() == 0


def test_awards_from_flags(spark):
    levels = spark.createDataFrame([(2, "b", 20, "B"), (1, "a", 30, "A"), (3, "c", 10, "C"), (4, "absent", 5, "D")], "pos int, flag string, score int, name string")
    data = [(1, d(2020, 8), 0, 1, 1), (1, d(2020, 9), 0, 0, 1), (1, d(2020, 10), 1, 0, None), (1, d(2021, 9), 0, 0, 0), (2, d(2020, 9), None, 0, 0)]
    df = spark.createDataFrame(data, "e int, p date, a int, b int, c int")
    got = rows(rollup.awards_from_flags(df, "e", "p", fn.fiscal_year("p"), levels))
    assert got == [
        (1, d(2020, 8), 2020, 20, "B", 20, "B"), (1, d(2020, 9), 2021, 10, "C", 30, "A"), (1, d(2020, 10), 2021, 30, "A", 30, "A"),
        (1, d(2021, 9), 2022, None, None, None, None), (2, d(2020, 9), 2021, None, None, None, None),
    ]


def test_latest_rows_keeps_ties_and_dedup_is_deterministic(spark):
    df = spark.createDataFrame([(1, d(2020, 1), 3), (1, d(2020, 2), 9), (1, d(2020, 2), 4), (2, d(2020, 1), 1)], "e int, p date, v int")
    assert rows(rollup.latest_rows(df, "e", "p"), "e", "v") == [(1, d(2020, 2), 4), (1, d(2020, 2), 9), (2, d(2020, 1), 1)]
    assert rows(rollup.dedup(df, ["e"], ["p", "v"]), "e") == [(1, d(2020, 1), 3), (2, d(2020, 1), 1)]


def test_repeat_flag(spark):
    data = [(1, m, o) for m, o in zip(months(d(2020, 1), 5), [1, 0, 1, 0, 0])]
    df = spark.createDataFrame(data, "e int, p date, o int")
    count, flag = rollup.repeat_flag("e", "p", F.col("o") > 0)
    assert [tuple(r) for r in df.select(count, flag, "p").orderBy("p").collect()] == [
        (1, 0, d(2020, 1)), (1, 0, d(2020, 2)), (2, 1, d(2020, 3)), (1, 0, d(2020, 4)), (1, 0, d(2020, 5))
    ]


def test_star_join_packs_and_unpacks(spark):
    left = spark.createDataFrame([(1, 10, "x"), (2, 20, "y")], "k int, v int, s string")
    a = spark.createDataFrame([(1, 5, 6)], "k int, a1 int, a2 int")
    out = features.unpack(features.star_join(features.packed(left, ["k"], "base"), [("a", a, ["k"])]), ["base", "a"])
    assert out.columns == ["k", "v", "s", "a1", "a2"]
    assert rows(out, "k") == [(1, 10, "x", 5, 6), (2, 20, "y", None, None)]


# --- labels ----------------------------------------------------------------------------------


def test_retention_label_one_row_per_member_even_with_duplicates(spark):
    hist = months(d(2020, 1), 16)
    data = [(1, m, t, "I", "ACTIVE") for t, m in enumerate(hist)] + [(1, hist[2], 2, "I", "ACTIVE")]
    data += [(2, m, t, "I", "ACTIVE" if t != 14 else "INACTIVE") for t, m in enumerate(hist)]
    data += [(3, m, t, "C", "ACTIVE") for t, m in enumerate(hist)]
    df = spark.createDataFrame(data, "e int, p date, t int, k string, s string")
    out = lb.retention_label(df, "e", "p", "t", "k", F.col("s") == "ACTIVE")
    assert [(r["e"], r["renewal_flag"], r["signup_month"]) for r in out.orderBy("e").collect()] == [
        (1, 1, d(2020, 1)), (2, 0, d(2020, 1))
    ]


def test_migration_label_needs_complete_windows(spark):
    vals = [0, 3, 0, 6, 6, 6, 3, 0, 0]
    data = [(1, m, t, v) for t, (m, v) in enumerate(zip(months(d(2020, 1), 9), vals))]
    data += [(2, m, t, 1) for t, m in enumerate(months(d(2020, 1), 9)) if t != 4]
    df = spark.createDataFrame(data, "e int, p date, t int, b int")
    out = lb.migration_label(df, "e", "p", "t", "b", 3).orderBy("e", "p").collect()
    assert [(r["e"], r["t"], r["max_3m"], r["future_max_3m"], r["label_3m"]) for r in out] == [
        (1, 2, 3, 6, "UP"), (1, 3, 6, 6, "SAME"), (1, 4, 6, 6, "SAME"), (1, 5, 6, 3, "DOWN")
    ]


def test_yearly_label_rules(spark):
    # Aug year = year(p + 4 months): 2019-09..2020-08 is 2020.
    data = [
        (1, d(2020, 8), 1), (1, d(2021, 8), 2),                     # UP, then no next year
        (2, d(2020, 8), 2), (2, d(2022, 8), 2),                     # gap of a year -> DOWN
        (3, d(2020, 8), 2), (3, d(2021, 8), 2),                     # SAME
        (4, d(2019, 11), 2), (4, d(2020, 8), 1), (4, d(2021, 8), 2),  # Aug UP, Nov SAME -> Nov INVALID
        (5, d(2020, 8), 0),                                         # no rank at all
    ]
    df = spark.createDataFrame(data, "e int, p date, r int")
    out = {(r["e"], r["f_yr"]): r for r in lb.yearly_label(df, "e", "p", "r").collect()}
    assert out[1, 2020]["label_aug"] == "UP" and out[1, 2021]["label_aug"] == "INVALID"
    assert out[2, 2020]["label_aug"] == "DOWN"
    assert out[3, 2020]["label_aug"] == "SAME"
    # Months up to November 2019 count for the Nov year 2019, which the Aug side does not have.
    assert out[4, 2020]["label_aug"] == "UP" and (4, 2019) not in out
    assert all(k[0] != 5 for k in out)


def test_yearly_label_corrects_nov_same_when_aug_is_up(spark):
    data = [(1, d(2019, 12), 2), (1, d(2020, 8), 1), (1, d(2020, 12), 2), (1, d(2021, 8), 2)]
    df = spark.createDataFrame(data, "e int, p date, r int")
    out = {r["f_yr"]: r for r in lb.yearly_label(df, "e", "p", "r").collect()}
    # Nov year 2020 holds 2019-12..2020-11, latest row 2020-08 with rank 1; Aug year 2021 has rank 2.
    assert (out[2020]["label_aug"], out[2020]["rank_nov"], out[2020]["label_nov"]) == ("UP", 1, "UP")
    data = [(1, d(2020, 8), 1), (1, d(2020, 11), 2), (1, d(2021, 8), 2)]
    out = {r["f_yr"]: r for r in lb.yearly_label(spark.createDataFrame(data, "e int, p date, r int"), "e", "p", "r").collect()}
    assert (out[2020]["label_aug"], out[2020]["rank_nov"], out[2020]["label_nov"]) == ("UP", 2, "INVALID")


def test_migration_train_fills_unlabelled_rows(spark):
    f = spark.createDataFrame([(1, d(2020, 1)), (1, d(2020, 2))], "e int, p date")
    y = spark.createDataFrame([(1, d(2020, 1), 6, 9, "UP")], "e int, p date, max_3m int, future_max_3m int, label_3m string")
    out = lb.migration_train(f, y, ["e", "p"], 3)
    zero, positive = lb.split_by_sign(out, "max_3m")
    assert rows(zero) == [(1, d(2020, 2), 0, None, "SAME")] and positive.count() == 1


def test_cohort_summary_pads_months(spark):
    df = spark.createDataFrame([(1, d(2017, 1), 1), (2, d(2017, 1), 0), (2, d(2017, 1), 0), (3, d(2017, 11), 1)], "e int, s date, y int")
    assert [tuple(r) for r in lb.cohort_summary(df, "e", "s", "y").collect()] == [
        ("201701", "201804", 2, 1, 0.5), ("201711", "201902", 1, 1, 1.0)
    ]


# --- events ----------------------------------------------------------------------------------


def test_engagement_and_funnel(spark):
    ev = [(1, d(2020, 1, 1), "view"), (1, d(2020, 1, 1), "view"), (1, d(2020, 1, 4), "buy"), (1, d(2020, 1, 4), "cart"),
          (1, d(2020, 1, 4), "cart"), (2, d(2020, 1, 2), "cart")]
    df = spark.createDataFrame(ev, "u int, p date, t string")
    e = engage.engagement(df, "u", "p", "t", ["view", "buy"], "day", (3,)).filter("u = 1").orderBy("p").collect()
    assert [(r["n_view"], r["n_view_sum_3m"]) for r in e] == [(2, 2), (0, 2), (0, 2), (0, 0)]
    t = F.col("t")
    f = engage.funnel(df, "u", "p", ["p"], {"n_buy": t == "buy"}, t == "cart", t == "buy", "day", (2,))
    got = f.filter("u = 1").orderBy("p").collect()
    assert [(r["n_buy"], r["cart_size"], r["n_buy_sum_2m"]) for r in got] == [(0, 0.0, None), (0, 0.0, 0), (0, 0.0, 0), (1, 2.0, 1)]
    assert engage.cart_size(df, "u", "p", ["p"], t == "cart", t == "buy").collect() == [(1, d(2020, 1, 4), 2.0)]
    assert engage.semi_sessions(df, ["u", "p"], t == "buy").count() == 3


# --- shape and scalars -----------------------------------------------------------------------


def test_group_split_is_disjoint_and_covers(spark):
    df = spark.range(5000).selectExpr("id", "id % 700 as k")
    train, test = shape.group_split(df, "k", [0.8, 0.2], seed=4)
    assert train.count() + test.count() == 5000
    assert train.select("k").distinct().join(test.select("k").distinct(), "k").count() == 0
    assert 0.7 < train.count() / 5000 < 0.9


def test_low_variance_cast_and_impute(spark):
    df = spark.createDataFrame([("1", 1.0, 5, None), ("x", 1.0, 6, "a"), (None, 1.0, 9, "b")], "n_a string, n_c double, i_k int, i_s string")
    kept, low = shape.low_variance(df.select("n_c", F.col("i_k").alias("n_k")), ["n_c", "n_k"], 0.1)
    assert low == ["n_c"] and kept.columns == ["n_k"]
    numeric, categorical = shape.roles(df, "y", ["k"])
    out = shape.impute(shape.cast_roles(df, numeric, categorical), numeric, categorical)
    assert rows(out, "i_k") == [(1.0, 1.0, "5", "unknown_filled"), (0.0, 1.0, "6", "a"), (0.0, 1.0, "9", "b")]


def test_scalars(spark):
    df = spark.createDataFrame([(1, 0, 1, "36000012399", d(2020, 9)), (2, 0, 0, "0004599", d(2020, 8)), (3, 1, 1, "7", None)],
                               "k int, a int, b int, raw string, p date")
    out = df.select(
        fn.rank_ladder({"a": 9, "b": 5}).alias("rank"), fn.clean_prefixed_id("raw", "360").alias("id"),
        fn.fiscal_year("p").alias("fy"), fn.tenure_year(F.when(F.col("k") > 1, F.col("k") * 12)).alias("ty"), "k",
    )
    assert rows(out, "k") == [(5, "123", 2021, 4, 1), (None, "4599", 2020, 3, 2), (9, "7", None, 4, 3)]
    number, name = fn.split_rank("t")
    split = spark.createDataFrame([("4 - Gold",), ("7",), (None,)], "t string").select(number.alias("n"), name.alias("d"))
    assert [tuple(r) for r in split.collect()] == [("4", "Gold"), ("7", None), (None, None)]
    lab = spark.createDataFrame([("UP",), ("SAME",), ("DOWN",), (None,)], "l string")
    assert [tuple(r) for r in lab.select(fn.encode_label("l"), fn.encode_label("l", "multi")).collect()] == [(1, 2), (1, 1), (0, 0), (0, 0)]


def test_a_lookup_by_another_key_is_joined_by_the_rows_own(spark):
    """The sponsor's values reach the rows by their own key; null and unknown sponsors find nothing, rows that repeat stay as many."""
    rows = spark.createDataFrame([(1, 10, 7), (2, 10, 7), (3, 10, None), (4, 10, 8), (4, 10, 8), (5, None, 7)], "id int, t int, s int")
    side = spark.createDataFrame([(7, 10, "a"), (None, 10, "b")], "s int, t int, v string")
    lookup = features.by_key(rows, "a", side, ["s", "t"], ["id", "t"])
    out = features.unpack(features.star_join(features.packed(rows, ["id", "t"], "base"), [lookup]), ["base", "a"])
    assert sorted((r.id, r.v) for r in out.select("id", "v").collect()) == [(1, "a"), (2, "a"), (3, None), (4, None), (4, None), (5, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan  # the side's size was not measured


def test_rows_left_out_of_the_wide_table_still_count_in_its_windows(spark):
    from memberlytics.operators.rolling import Rolling

    rows = spark.createDataFrame([(1, m, float(m), m % 2) for m in range(1, 7)], "id int, month int, x double, odd int")
    out = features.wide_features(rows, "id", "month", ["id", "month", "odd"], [], [Rolling("n_sum", "x")], keep="_plain.odd = 0")
    assert sorted((r.month, r.n_sum_3m, r.n_sum_6m) for r in out.collect()) == [(2, 3.0, 3.0), (4, 9.0, 10.0), (6, 15.0, 21.0)]


def test_large_sides_are_not_broadcast_by_their_estimate(spark):
    """What looks small by its files is joined by a shuffle."""
    from memberlytics.plans import bindings as b
    from memberlytics.session import broadcast_if_small

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    rows_ = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, None)], "id int, x double")
    cells = spark.createDataFrame([(1.0, 2, 0.5), (None, 1, 0.0)], "x double, _n long, _pr0 double")
    out = ranking.attach(rows_, cells, cells, ["x"], ["id"], ["_pr0"], {"total": 3, "most": 0})
    assert rows(out, "id") == [(1, 1.0, 0.5), (2, 1.0, 0.5), (3, None, 0.0)]
    assert "BroadcastHashJoin" not in plan(out)
    panel = spark.createDataFrame([(10, None, d(2000, 1), 1.0, 2.0, "I"), (11, 10, d(2000, 1), 3.0, 4.0, "C")],
                                  "member_id long, sponsor_id long, month date, pv double, bv double, member_type string")
    grouped = b.with_group(panel)
    assert sorted((r.member_id, r.group_pv, r.front_customers) for r in grouped.collect()) == [(10, 4.0, 1), (11, 3.0, 0)]
    assert "BroadcastHashJoin" not in plan(grouped)
    few, many = broadcast_if_small(cells, "few"), broadcast_if_small(cells, "many", max_rows=1)
    assert "BroadcastHashJoin" in plan(rows_.join(few, "x")) and "BroadcastHashJoin" not in plan(rows_.join(many, "x"))


def test_rows_dealt_by_one_key_stay_for_lookups_by_two(spark):
    """Null keys find nothing, rows that repeat stay as many, and neither the join nor a window after it moves the rows again."""
    from pyspark.sql import Window

    from memberlytics import session

    rows_ = spark.createDataFrame(
        [(1, d(2000, 1), 1), (1, d(2000, 2), 2), (1, d(2000, 2), 2), (2, None, 3), (None, d(2000, 1), 4), (3, d(2000, 1), 5)], "e int, p date, x int"
    )
    side = spark.createDataFrame([(1, d(2000, 1), "a"), (1, d(2000, 2), "b"), (2, None, "c"), (None, d(2000, 1), "d")], "e int, p date, v string")
    lookup = ("a", session.unmeasured(side), ["e", "p"])
    out = features.star_join(features.packed(rows_.repartition("e"), ["e", "p"], "base"), [lookup], "e")
    out = features.unpack(out, ["base", "a"])
    assert sorted((r.x, r.v) for r in out.collect()) == [(1, "a"), (2, "b"), (2, "b"), (3, None), (4, None), (5, None)]
    plan = out.withColumn("n", F.sum("x").over(Window.partitionBy("e").orderBy("p")))._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(moved) == 2 and not any("p#" in line.partition("hashpartitioning")[2] for line in moved)  # the rows once, the side once
