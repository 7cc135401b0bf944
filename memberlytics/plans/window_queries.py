"""Rolling, lagged, ranked and year-over-year columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from memberlytics import functions as fn
from memberlytics.operators import rolling as ro, rollup
from memberlytics.operators.ranking import percent_ranks
from memberlytics.operators.rolling import FRAMES, Rolling
from memberlytics.plans import bindings as b
from memberlytics.plans.catalog import query
from memberlytics.plans.oracle import DENSE, EVENTS, GROUPED, INCOME, PANEL, cte
from memberlytics.session import broadcast_if_small

KEY = ("member_id", "month")


def over(expr: str, k: int, agg: str = "sum") -> str:
    return f"{agg}({expr}) OVER (PARTITION BY member_id ORDER BY month ROWS {k - 1} PRECEDING)"


def frames(expr: str, stem: str, agg: str = "sum", cast: str | None = None, digits: int | None = None) -> str:
    out = []
    for k in FRAMES:
        e = over(expr, k, agg)
        e = f"CAST({e} AS {cast})" if cast else e
        e = f"round({e}, {digits})" if digits is not None else e
        out.append(f"{e} AS {stem}_{k}m")
    return ", ".join(out)


def rounded(df, cols, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@query(
    "roll_sum",
    cte(PANEL, body=f"""SELECT member_id, month, {frames('pv', 'pv_sum')}, {frames('rev', 'rev_sum')},
      {frames('orders', 'orders_sum', cast='BIGINT')} FROM panel"""),
)
def roll_sum(spark, sf):
    p = b.monthly(spark, sf).select(*KEY, "pv", "rev", "orders")
    specs = [Rolling("pv_sum", "pv"), Rolling("rev_sum", "rev"), Rolling("orders_sum", "orders")]
    return ro.rolling(p, "member_id", "month", specs).drop("pv", "rev", "orders")


@query(
    "roll_avg",
    cte(PANEL, body=f"""SELECT member_id, month, {frames('pv', 'pv_avg', 'avg')},
      {frames('coalesce(last3_pv / nullif(pv, 0), 0)', 'last3_avg', 'avg', digits=6)} FROM panel"""),
)
def roll_avg(spark, sf):
    p = b.monthly(spark, sf).select(*KEY, "pv", fn.safe_ratio("last3_pv", "pv").alias("last3"))
    specs = [Rolling("pv_avg", "pv", "avg"), Rolling("last3_avg", "last3", "avg")]
    out = ro.rolling(p, "member_id", "month", specs).drop("pv", "last3")
    return rounded(out, [f"last3_avg_{k}m" for k in FRAMES])


@query(
    "roll_max",
    cte(PANEL, body=f"""SELECT member_id, month, {frames('bonus_pct', 'bonus_max', 'max')},
      {frames('rank', 'rank_max', 'max')} FROM panel"""),
)
def roll_max(spark, sf):
    p = b.panel(spark, sf).select(*KEY, "bonus_pct", "rank")
    specs = [Rolling("bonus_max", "bonus_pct", "max"), Rolling("rank_max", "rank", "max")]
    return ro.rolling(p, "member_id", "month", specs).drop("bonus_pct", "rank")


@query(
    "roll_nonzero",
    cte(PANEL, body=f"""SELECT member_id, month,
      {frames('CASE WHEN last3_pv > 0 THEN 1 ELSE 0 END', 'late_mths', cast='BIGINT')},
      {frames("CASE WHEN bonus_flag = 'Y' AND bonus_pct >= 9 THEN 1 ELSE 0 END", 'bonus9', cast='BIGINT')} FROM panel"""),
)
def roll_nonzero(spark, sf):
    p = b.panel(spark, sf).select(
        *KEY,
        fn.flag(F.col("last3_pv") > 0).alias("late"),
        fn.flag((F.col("bonus_flag") == "Y") & (F.col("bonus_pct") >= 9)).alias("b9"),
    )
    specs = [Rolling("late_mths", "late"), Rolling("bonus9", "b9")]
    return ro.rolling(p, "member_id", "month", specs).drop("late", "b9")


@query(
    "lag_previous",
    cte(PANEL, body="""SELECT member_id, month, lag(pv) OVER w AS pv_previous,
      lag(coalesce(last3_pv / nullif(pv, 0), 0)) OVER w AS last3_previous, lag(status) OVER w AS status_previous,
      lag(CASE WHEN q_flag = 'Y' THEN 1 ELSE 0 END) OVER w AS q_previous, lag(rank) OVER w AS rank_previous
      FROM panel WINDOW w AS (PARTITION BY member_id ORDER BY month)"""),
)
def lag_previous(spark, sf):
    p = b.panel(spark, sf)
    exprs = {
        "pv_previous": "pv",
        "last3_previous": fn.safe_ratio("last3_pv", "pv"),
        "status_previous": "status",
        "q_previous": fn.yes("q_flag"),
        "rank_previous": "rank",
    }
    return ro.lagged(p, "member_id", "month", exprs).select(*KEY, *exprs)


@query(
    "delta_k",
    cte(GROUPED, body="SELECT member_id, month, "
        + ", ".join(f"front_sellers - lag(front_sellers, {k}) OVER w AS added_{n}" for n, k in
                    (("1m", 1), ("3m", 2), ("6m", 5), ("9m", 8), ("12m", 11)))
        + " FROM grouped WINDOW w AS (PARTITION BY member_id ORDER BY month)"),
)
def delta_k(spark, sf):
    p = b.with_group(b.panel(spark, sf)).select(*KEY, "front_sellers")
    outs = {"added_1m": 1, "added_3m": 2, "added_6m": 5, "added_9m": 8, "added_12m": 11}
    return ro.delta(p, "member_id", "month", "front_sellers", outs).drop("front_sellers")


@query(
    "roll_ratio",
    cte(GROUPED, body="SELECT member_id, month, "
        + ", ".join(f"coalesce({over('pv', k)} / nullif({over('group_pv', k)}, 0), 0) AS pv_ratio_{k}m" for k in FRAMES)
        + " FROM grouped"),
)
def roll_ratio(spark, sf):
    p = b.with_group(b.panel(spark, sf)).select(*KEY, "pv", "group_pv")
    return ro.rolling(p, "member_id", "month", [Rolling("pv_ratio", "pv", over="group_pv")]).drop("pv", "group_pv")


@query(
    "roll_share_of_dim",
    cte(PANEL, INCOME, body="SELECT p.member_id, p.month, income, "
        + ", ".join(f"coalesce({over('bonus_gross', k)} / nullif(income, 0), 0) AS share_{k}m" for k in FRAMES)
        + " FROM panel p LEFT JOIN income i ON i.province = p.province AND i.year = year(p.month)"),
)
def roll_share_of_dim(spark, sf):
    p = b.panel(spark, sf).select(*KEY, "province", "bonus_gross", F.year("month").alias("year"))
    p = p.join(broadcast_if_small(b.province_income(spark, sf), "income"), ["province", "year"], "left")
    out = ro.rolling(p, "member_id", "month", [Rolling("share", "bonus_gross", per="income")])
    return out.drop("province", "year", "bonus_gross")


@query(
    "join_year_region",
    cte(PANEL, INCOME, body="""SELECT p.member_id, p.month, p.province, income,
      coalesce(bonus_gross / income, 0) AS share FROM panel p
      LEFT JOIN income i ON i.province = p.province AND i.year = extract(year FROM p.month)"""),
)
def join_year_region(spark, sf):
    p = b.panel(spark, sf).select(*KEY, "province", "bonus_gross", F.year("month").alias("year"))
    p = p.join(broadcast_if_small(b.province_income(spark, sf), "income"), ["province", "year"], "left")
    return p.select(*KEY, "province", "income", fn.safe_ratio("bonus_gross", "income").alias("share"))


MEASURES = {"grs_bns": "bonus_gross", "prsnl_pv": "pv", "prsnl_bv": "bv", "group_pv": "group_pv", "group_bv": "group_bv"}
SCOPES = {"overall": ["month"], "region": ["month", "province"], "rank": ["month", "rank"]}


def _pr_sql() -> str:
    out = []
    for scope, cols in SCOPES.items():
        for name, col in MEASURES.items():
            out.append(
                f"percent_rank() OVER (PARTITION BY {', '.join(cols)} ORDER BY {col} NULLS FIRST) AS pct_{scope}_{name}"
            )
    return ", ".join(out)


def active_sellers(spark, sf):
    p = b.with_group(b.panel(spark, sf))
    return p.filter((F.col("status") == "ACTIVE") & (F.col("member_type") == "I"))


@query(
    "percentile_rank",
    cte(GROUPED, body=f"SELECT member_id, month, {_pr_sql()} FROM grouped WHERE status = 'ACTIVE' AND member_type = 'I'"),
)
def percentile_rank(spark, sf):
    return percent_ranks(
        active_sellers(spark, sf), list(KEY), MEASURES, SCOPES, name=lambda s, m: f"pct_{s}_{m}"
    )


@query(
    "latest_per_group",
    cte(PANEL, body="""SELECT member_id, month, pv, rank FROM panel
      QUALIFY month = max(month) OVER (PARTITION BY member_id)"""),
)
def latest_per_group(spark, sf):
    return rollup.latest_rows(b.panel(spark, sf).select(*KEY, "pv", "rank"), "member_id", "month")


@query(
    "lead_next_year",
    cte(PANEL, body="""SELECT member_id, fy, best, lead(best) OVER w AS next_best, lead(fy) OVER w AS next_fy,
      lead(last_month) OVER w AS next_month FROM (
        SELECT member_id, CAST(year(month + INTERVAL 4 MONTH) AS INTEGER) AS fy, max(rank) AS best, max(month) AS last_month
        FROM panel GROUP BY 1, 2) WINDOW w AS (PARTITION BY member_id ORDER BY fy)"""),
)
def lead_next_year(spark, sf):
    p = b.panel(spark, sf).select(*KEY, "rank", fn.fiscal_year("month").alias("fy"))
    yearly = p.groupBy("member_id", "fy").agg(F.max("rank").alias("best"), F.max("month").alias("last_month"))
    w = ro.by_entity("member_id", "fy")
    lead = lambda c, n: F.lead(c).over(w).alias(n)
    return yearly.select(
        "member_id", "fy", "best", lead("best", "next_best"), lead("fy", "next_fy"), lead("last_month", "next_month")
    )


@query(
    "yoy",
    cte(DENSE, body="""SELECT member_id, month, pv, lag(pv, 12) OVER w AS pv_lyr,
      pv / nullif(lag(pv, 12) OVER w, 0) AS pv_12m_mom FROM dense WINDOW w AS (PARTITION BY member_id ORDER BY month)"""),
)
def yoy(spark, sf):
    return ro.yoy(b.dense_panel(spark, sf).select(*KEY, "pv"), "member_id", "month", ["pv"])


@query(
    "momentum_3m",
    cte(PANEL, body="SELECT member_id, month, "
        + f"{over('pv', 3)} / nullif({over('pv', 6)} - {over('pv', 3)}, 0) AS pv_sum_3m_mom, "
        + f"{over('rev', 3)} / nullif({over('rev', 6)} - {over('rev', 3)}, 0) AS rev_sum_3m_mom FROM panel"),
)
def momentum_3m(spark, sf):
    p = b.monthly(spark, sf).select(*KEY, "pv", "rev")
    r = ro.rolling(p, "member_id", "month", [Rolling("pv_sum", "pv"), Rolling("rev_sum", "rev")], (3, 6))
    return ro.momentum(r, ["pv_sum", "rev_sum", "absent"]).select(*KEY, "pv_sum_3m_mom", "rev_sum_3m_mom")


ALL_K = tuple(range(1, 16))


@query(
    "roll_tenure_k",
    cte(DENSE, body="SELECT member_id, month, tenure, "
        + ", ".join(f"{over('pv', k)} AS pv_sum_{k}m, {over('bonus_pct', k, 'max')} AS bonus_max_{k}m" for k in ALL_K)
        + " FROM dense QUALIFY tenure BETWEEN 1 AND 15"),
)
def roll_tenure_k(spark, sf):
    p = b.dense_panel(spark, sf).select(*KEY, "tenure", "pv", "bonus_pct")
    specs = [Rolling("pv_sum", "pv"), Rolling("bonus_max", "bonus_pct", "max")]
    # Frames only look back: later rows can go before the window, earlier ones cannot.
    out = ro.rolling(p.filter("tenure <= 15"), "member_id", "month", specs, ALL_K)
    return out.filter(F.col("tenure") >= 1).drop("pv", "bonus_pct")


@query(
    "repeat_customers",
    cte(PANEL, body="""SELECT member_id, month, CAST(n AS BIGINT) AS past3_count, CASE WHEN n >= 2 THEN 1 ELSE 0 END AS is_repeat
      FROM (SELECT member_id, month, sum(CASE WHEN orders > 0 AND status = 'ACTIVE' THEN 1 ELSE 0 END)
        OVER (PARTITION BY member_id ORDER BY month ROWS 2 PRECEDING) AS n FROM panel WHERE member_type = 'C')"""),
)
def repeat_customers(spark, sf):
    p = b.panel(spark, sf).filter(F.col("member_type") == "C")
    count, is_repeat = rollup.repeat_flag("member_id", "month", (F.col("orders") > 0) & (F.col("status") == "ACTIVE"))
    return p.select(*KEY, count.alias("past3_count"), is_repeat.alias("is_repeat"))


@query(
    "chunked_rolling",
    cte(PANEL, body=f"SELECT member_id, month, {frames('pv', 'pv_sum')} FROM panel"),
)
def chunked_rolling(spark, sf):
    """One hash shuffle by member replaces a loop over member groups.

    The chunk number may partition the output; it never changes the result.
    """
    p = b.monthly(spark, sf).select(*KEY, "pv").withColumn("chunk", fn.key_bucket(["member_id"], 10))
    out = ro.rolling(p, ["chunk", "member_id"], "month", [Rolling("pv_sum", "pv")])
    return out.drop("chunk", "pv")


@query(
    "tenure_normalize",
    cte(DENSE, body=f"""SELECT member_id, month, {over('pv', 12)} / nullif(tenure, 0) AS pv_sum_month_agg,
      {over('bonus_pct', 12, 'max')} AS bonus_max_month_agg FROM dense QUALIFY true"""),
)
def tenure_normalize(spark, sf):
    from memberlytics.operators import shape

    p = b.dense_panel(spark, sf).select(*KEY, "tenure", "pv", "bonus_pct")
    specs = [Rolling("pv_sum", "pv"), Rolling("bonus_max", "bonus_pct", "max")]
    sliced = shape.slice_to_frame(ro.rolling(p, "member_id", "month", specs), 12)
    out = shape.normalize_by(sliced, shape.summed_columns(sliced.columns), "tenure")
    return out.drop("tenure", "pv", "bonus_pct")


@query(
    "feat_regex_projection",
    cte(PANEL, body=f"""SELECT member_id, month, pv, {over('pv', 6)} AS pv_sum_month_agg,
      {over('pv', 6, 'avg')} AS pv_avg_month_agg FROM panel"""),
)
def feat_regex_projection(spark, sf):
    from memberlytics.operators import shape

    p = b.monthly(spark, sf).select(*KEY, "pv")
    r = ro.rolling(p, "member_id", "month", [Rolling("pv_sum", "pv"), Rolling("pv_avg", "pv", "avg")])
    r = ro.yoy(ro.momentum(r, ["pv_sum"]), "member_id", "month", ["pv_sum_12m"])
    return shape.slice_to_frame(r, 6)
