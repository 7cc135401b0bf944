"""The wide feature table and the parts of its star join."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from memberlytics import functions as fn
from memberlytics.operators import engage, features as ft, rolling as ro, rollup, shape
from memberlytics.operators.ranking import percent_ranks
from memberlytics.operators.rolling import FRAMES
from memberlytics.plans import bindings as b
from memberlytics.plans import families as fam
from memberlytics.plans import join_queries as jq
from memberlytics.plans.catalog import query
from memberlytics.plans.oracle import CAMPAIGNS, INCOME, MONTH_EVENTS, REPEAT, cte
from memberlytics.plans.window_queries import KEY, MEASURES, SCOPES, active_sellers
from memberlytics.session import broadcast_if_small, current_staging, stage, stage_all, stage_by
from memberlytics.sources.readers import files_print

LOS_COLS = [
    "head_exists", "leaves", "pv_per_member", "sellers", "sellers_engaged", "customers", "customers_repeat",
    "q_mth", "qv_mth", "q1_mth", "q2_mth", "front_sellers", "front_customers", "front_q_mth", "front_qv_mth",
    "front_q1_mth", "front_q2_mth",
] + [f"{c}_avg_{k}m" for c in jq.LOS_TREND for k in FRAMES]

NEAR_HEADS = ("sil", "gld")  # fixed values: levels with a head for every ten and hundred members
FUNNEL_STEPS = {"n_funnel_browse": "view", "n_funnel_search": "click", "n_funnel_order": "purchase"}
FUNNEL_COLS = [*FUNNEL_STEPS, "n_funnel_cart"]
PROMO_LINES = {**{ln: f"{ln}_rev" for ln in b.LINES}, "all": "rev"}
ADDED = {"n_sellers_added": 1, "n_sellers_added_past_3m": 2, "n_sellers_added_past_6m": 5,
         "n_sellers_added_past_9m": 8, "n_sellers_added_past_12m": 11}
UP_ADDED = {"n_upline_added": 1, "n_upline_added_3m": 2, "n_upline_added_6m": 5, "n_upline_added_9m": 8,
            "n_upline_added_12m": 11}
DL_VALUES = ["dl_all", "dl_pv", "dl_customer_pv", "dl_seller_pv", "dl_group_pv", "dl_orders", "dl_orders_nonzero",
             "dl_sponsor", "dl_rank_achieved", "dl_rank_310", "dl_rank_320", "dl_rank_max", "dl_front_sellers",
             "dl_front_customers", "dl_bonus_9plus", "dl_q", "dl_qv", "dl_q1", "dl_q2"]
DL_SHARES = {"n_pct_dl_pv_sellers": ("dl_seller_pv", "dl_pv"), "n_pct_dl_310": ("dl_rank_310", "dl_sellers"),
             "n_pct_dl_320": ("dl_rank_320", "dl_sellers")}


def base_panel(spark, sf):
    """The full panel, written once: the support tables below all read it.

    It is written before the group measures too, because those aggregate the panel and join it.
    """
    p = b.panel(spark, sf, by_line=True).withColumn("seller", F.max(F.col("member_type") == "I").over(Window.partitionBy("member_id")))
    # In buckets by member, so that the joins and windows by member and something more move none of its rows.
    p = stage_by(p, "panel", "member_id")
    p = b.with_far_heads(jq.with_repeat(b.with_group(p)), spark, sf)
    p = p.withColumns({"year": F.year("month"), "fy": fn.fiscal_year("month")})
    return stage_by(p.withColumn("yearly_rank", rollup.yearly_rank("member_id", "fy", "rank")), "panel_full", "member_id")


def los_table(p):
    """Group measures and trends of every head on every level."""
    return rollup.head_trend(jq.los_rollup(p), "month", jq.LOS_TREND)


def los_lookup(table, head):
    own = table.filter(F.col("level") == head)
    return own.select(F.col("head").alias(f"{head}_head"), "month", *[F.col(c).alias(f"n_los_{head}_{c}") for c in LOS_COLS])


def far_lookups(table):
    """The lookups of the three widest levels: a row per place or segment and month, so they are measured."""
    return {f"los_{h}": broadcast_if_small(los_lookup(table, h), f"los_{h}") for h in b.HEADS if h not in NEAR_HEADS}


def los_lookups(rows, table, far):
    """The lookups of all five levels for rows with the head columns; the near heads follow from the member's key."""
    near = [ft.by_key(rows, f"los_{h}", los_lookup(table, h), [f"{h}_head", "month"], KEY) for h in NEAR_HEADS]
    return [*[(f"los_{h}", far[f"los_{h}"], [f"{h}_head", "month"]) for h in b.HEADS if h not in NEAR_HEADS], *near]


def monthly_engagement(spark, sf):
    """Activity counts per member and month with sums over the last k months."""
    e = b.monthly_events(spark, sf)
    kinds = list(fam.ENGAGED)
    out = engage.engagement(e, "member_id", "month", "event_type", kinds, "month")
    return out.select(*KEY, *[F.col(f"n_{t}_sum_{k}m").alias(f"n_lag_{t}_sum_{k}m") for t in kinds for k in FRAMES])


def monthly_funnel(spark, sf):
    e = b.monthly_events(spark, sf)
    kind = F.col("event_type")
    steps = {n: kind == t for n, t in FUNNEL_STEPS.items()}
    out = engage.funnel(e, "member_id", "month", ["month"], steps, kind == "signup", kind == "purchase", "month", FRAMES)
    names = {"cart_size": "n_funnel_cart", **{f"cart_size_sum_{k}m": f"n_funnel_cart_sum_{k}m" for k in FRAMES}}
    return out.withColumnsRenamed(names)


def promo_sku(spark, sf):
    return jq.promo_sku_count(spark, sf)


def global_rank(p):
    """Rank text per member and fiscal year, split into number and name."""
    yearly = p.groupBy("member_id", fn.fiscal_year("month").alias("fy")).agg(F.max("rank").alias("best"))
    text = F.concat(F.col("best").cast("string"), F.lit(" - Level "), (F.col("best") / 10).cast("int").cast("string"))
    number, name = fn.split_rank(text)
    high = yearly.filter("best >= 350")
    return high.select("member_id", "fy", number.alias("global_rank_no"), name.alias("global_rank_desc"))


def id_map(spark, sf):
    return b.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("member_id"), F.col("s_nationkey").alias("i_dist_num"))


def active_only(p):
    return p.filter((F.col("status") == "ACTIVE") & (F.col("member_type") == "I"))


def support_tables(spark, sf, p):
    """The tables the star join looks up, each written once.

    As files their sizes are known when the star join is planned, a lost executor costs a
    re-read, and each can be reused by other jobs.
    """
    monthly = b.monthly_events(spark, sf)
    tables = {
        "downline": jq.downline(p),
        "ranks": percent_ranks(active_only(p), list(KEY), MEASURES, SCOPES, name=lambda s, m: f"pct_{s}_{m}"),
        "heads": los_table(p),
        "promo_sku": promo_sku(spark, sf),
        "logins": monthly.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_logins")),
        "engagement": monthly_engagement(spark, sf),
        "funnel": monthly_funnel(spark, sf),
        "global_rank": global_rank(p),
    }
    few = {
        **{f"avg_{prefix}": jq.scope_averages(active_only(p), prefix) for prefix in jq.AVG_SCOPES},
        "inc": b.province_income(spark, sf),
        "camp": rollup.campaigns_by_period(b.campaigns(spark, sf), "month"),
    }
    small = {name: broadcast_if_small(table, name) for name, table in few.items()}
    large = stage_all(tables)
    return large | small | far_lookups(large["heads"])


# Panel columns that only the support tables read.  A struct stays one field through the joins only if all of its fields are read later.
SUPPORT_ONLY = ("seller", "engage_flag", "front_customers", "is_repeat", "month_idx")
STAR_KEYS = [*KEY, "sponsor_id", "province", "year", "fy", "rank", "yearly_rank", *[f"{h}_head" for h in b.HEADS]]


def star(spark, sf, p, where: str | None = None, attach=None, framed: bool = True):
    """Panel rows, or those ``where`` holds, with every lookup attached; still one row per (member, month).

    Measured lookups come first.  Those by other large keys are turned to the panel's own, and the panel lies in buckets by member,
    so no lookup moves the wide rows, nor do the windows to come.  ``attach`` is applied to the packed rows.  Without ``framed`` the
    lookups come without their columns tied to a fixed frame, for a caller that leaves those out.
    """
    t = support_tables(spark, sf, p)
    down = t["downline"]
    own = down.filter(F.col("sponsor_id").isNotNull()).withColumnRenamed("sponsor_id", "member_id")
    names = F.broadcast(jq.rank_names(spark))  # a fixed list
    rows = p if where is None else p.filter(where)  # next to the written panel: only its rows are joined
    los = los_lookups(rows, t["heads"], t)
    lookups = [
        *[(f"avg_{prefix}", t[f"avg_{prefix}"], by) for prefix, by in jq.AVG_SCOPES.items()],
        ("inc", t["inc"], ["province", "year"]),
        ("camp", t["camp"], ["month"]),
        ("mname", names.withColumnRenamed("rank_name", "monthly_name"), ["rank"]),
        ("yname", names.toDF("yearly_rank", "yearly_name"), ["yearly_rank"]),
        *los,
        ft.by_key(rows, "up", jq.upline_table(p, down), ["sponsor_id", "month"], KEY),
        ("own", ft.unmeasured(own.select(*KEY, *[c for c in own.columns if c.startswith("dl_")])), KEY),
        *[(name, ft.unmeasured(t[name]), KEY) for name in ("ranks", "promo_sku", "logins", "engagement", "funnel")],
        ft.by_key(rows, "gar", t["global_rank"], ["member_id", "fy"], KEY),
    ]
    if not framed:
        lookups = [(name, side.drop(*shape.framed_columns(side.columns)), on) for name, side, on in lookups]
    rows = ft.star_join(ft.packed(rows.drop(*SUPPORT_ONLY), STAR_KEYS, "panel"), lookups, "member_id")
    ids = ("ids", ft.unmeasured(id_map(spark, sf)), ["member_id"])
    rows = ft.star_join(rows if attach is None else attach(rows), [ids])
    return ft.unpack(rows, ["panel", *[name for name, _, _ in (*lookups, ids)]])


def feature_columns():
    """Passing and extra columns of the wide table."""
    c = F.col
    pcts = [f"pct_{s}_{m}" for s in SCOPES for m in MEASURES]
    passing = [
        "member_id", "month", "sponsor_id",
        c("tenure").alias("n_tenure"),
        F.year(fn.signup_month("month", "tenure")).alias("signup_year"),
        fn.flag(F.year(fn.signup_month("month", "tenure")) > 1995).alias("n_signup_after_1995"),
        c("member_type").alias("i_member_type"), c("status").alias("i_status"), c("local_type").alias("i_local_type"),
        c("age").alias("n_age"), fn.flag(c("age") <= 34).alias("n_under_35"), c("gender").alias("i_gender"),
        c("segment").alias("i_segment"), fn.yes("renew_flag").alias("n_renew_flag"),
        fn.yes("recur_flag").alias("n_recur_flag"), c("recur_pv").alias("n_recur_pv"),
        fn.safe_ratio("recur_pv", "pv").alias("n_pct_pv_recur"),
        (c("pv") - c("stly_pv")).alias("n_change_stly_pv"), (c("rev") - c("stly_rev")).alias("n_change_stly_rev"),
        *ft.filled({p: f"n_{p}" for p in pcts}, 0.0),
        *jq.index_columns(),
        c("region").alias("i_region"), c("income").alias("n_region_income"),
        fn.safe_ratio("bonus_gross", "income").alias("n_pct_income"),
        c("fy").alias("i_fiscal_year"),
        *rollup.promo_columns(PROMO_LINES, count="n_promo_{}", multiple="n_promo_{}_multiple"),
        *ft.filled({d: f"n_{d}" for d in DL_VALUES if d != "dl_rank_max"}),
        F.coalesce("dl_rank_max", F.lit(0)).alias("i_dl_rank_max"),
        *[fn.safe_ratio(a, d).alias(n) for n, (a, d) in DL_SHARES.items()],
        c("upline_rank").alias("i_upline_rank"), c("upline_tenure").alias("n_upline_tenure"),
        *[c(f"up_{u}").alias(f"n_upline_{u[3:]}") for u in jq.UPLINE],
        *[f"n_los_{h}_{col}" for h in b.HEADS for col in LOS_COLS],
        fn.top_share({k: f"{k}_pv" for k in b.CHANNELS}, "pv").alias("n_top_channel_share"),
        fn.top_name({k: f"{k}_pv" for k in b.CHANNELS}).alias("i_top_channel"),
        "n_logins",
        c("monthly_name").alias("i_monthly_award"), c("yearly_name").alias("i_yearly_award"),
        c("yearly_rank").alias("i_yearly_rank"),
        *[f"n_lag_{t}_sum_{k}m" for t in fam.ENGAGED for k in FRAMES],
        *FUNNEL_COLS, *[f"{f}_sum_{k}m" for f in FUNNEL_COLS for k in FRAMES],
        "i_dist_num", "global_rank_no", "global_rank_desc",
        fn.signup_month("month", "tenure").alias("signup_month"),
    ]
    w = ro.by_entity("member_id", "month")
    others = [
        *ro.delta_columns("member_id", "month", "front_sellers", ADDED),
        *ro.delta_columns("member_id", "month", "up_dl_sellers", UP_ADDED),
        *rollup.first_flag_columns("member_id", "month", {f"n_{n}": F.expr(e) for n, e in jq.PREDS.items()}),
        fn.safe_ratio(F.lag("bonus_gross").over(w), F.col("income")).alias("n_pct_income_previous"),
    ]
    return passing, others


def feature_table(spark, sf):
    """One row per (member, month) with every feature, momentum and year-over-year column."""
    rows = star(spark, sf, base_panel(spark, sf))
    passing, others = feature_columns()
    return ft.wide_features(rows, "member_id", "month", passing, fam.CURRENT, fam.FAMILIES, others, tracked=fam.TRACKED)


TENURES = tuple(range(1, 16))
INPUTS = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region", "events")


def early_rows(spark, sf, last: int):
    """The star's rows of tenure 0 to ``last`` at least, without columns tied to a fixed frame.  Frames only look back, so they need no later rows.

    They are a staged table that the queries of a run (or, without one, of the session) share, built anew when a file of the inputs has
    changed.  The longest table, if it is there, serves for fewer tenures too.
    """
    stamp = files_print(spark, [f"{sf}/{t}.parquet" for t in INPUTS])
    staged, longest = current_staging(spark), f"star{max(TENURES)}"
    table = staged.find((sf, longest), stamp)
    if table is not None and last <= max(TENURES):
        return table
    return staged.once((sf, f"star{last}"), stamp, lambda: star(spark, sf, base_panel(spark, sf), f"tenure <= {last}", framed=False), "member_id")


SELLING = "_plain.i_status = 'ACTIVE' AND _plain.i_member_type = 'I'"


def selling_features(spark, sf, keep: str = "true", attach=None, labels=()):
    """The feature table of active sellers' months that ``keep`` holds for, with the columns ``labels`` that ``attach`` adds.

    Only the members who ever sold are joined and computed, with all their rows, as the windows look back.  A training query writes
    the rows it trains on, never the whole table.
    """
    rows = star(spark, sf, base_panel(spark, sf), "seller", attach)
    passing, others = feature_columns()
    wide = ft.wide_features(rows, "member_id", "month", passing, fam.CURRENT, fam.FAMILIES, [*others, *labels], tracked=fam.TRACKED,
                            keep=f"{SELLING} AND ({keep})")
    return wide.select(*[c for c in wide.columns if c not in labels], *labels)


def tenure_slices(spark, sf, tenures, label=None, keep: str = "true", write: bool = True):
    """Rows of the star whose tenure is among ``tenures``, each family over as many rows as the tenure says.

    All tenures come from one window, and columns tied to a fixed frame are left out.  ``label`` (member_id and further
    columns) is joined before the window, so only its members are computed.  Only rows of these tenures that ``keep`` (a condition on the
    struct ``_plain``) holds for are written, or left to the caller to write.
    """
    passing, others = feature_columns()
    passing = [c for c in passing if not (isinstance(c, str) and shape.framed_columns([c]))]
    early = early_rows(spark, sf, max(tenures))
    if label is not None:
        early = early.join(label, "member_id")
        others = [*others, *[c for c in label.columns if c != "member_id"]]
    early, families = ro.rolling_over_tenure(early, "member_id", "month", "tenure", fam.FAMILIES)
    wide = ft.wide_features(early, "member_id", "month", passing, fam.CURRENT, [], [*others, *families])
    framed = set(shape.framed_columns(wide.columns))
    wide = wide.select(*[c for c in wide.columns if c not in framed])
    rows = ft.kept_rows(wide, f"_plain.n_tenure IN ({', '.join(map(str, tenures))}) AND ({keep})")
    return stage(rows, "slices") if write else rows


def _is_ratio(name: str) -> bool:
    stem = name.removesuffix("_month_agg") if name.endswith("_month_agg") else name.rsplit("_", 1)[0]
    return fam.KIND.get(stem) == "ratio" or name.startswith("n_funnel_cart") or name.endswith("_multiple")


def comparable(df):
    """Means of ratios and sums of means depend on the order of addition in their last bits."""
    return df.select(*[F.round(c, 9).alias(c) if _is_ratio(c) else F.col(c) for c in df.columns])


# --- the same table as SQL -------------------------------------------------------------------

_W = "(PARTITION BY member_id ORDER BY month"


def _los_ctes() -> str:
    parts = []
    for h in b.HEADS:
        sql = jq._los_sql(h).replace("heads AS", f"heads_{h} AS").replace("LEFT JOIN heads c", f"LEFT JOIN heads_{h} c")
        parts.append(sql.replace("los AS", f"los_{h} AS"))
        trend = ", ".join(
            f"avg({c}) OVER (PARTITION BY head ORDER BY month ROWS {k - 1} PRECEDING) AS {c}_avg_{k}m"
            for c in jq.LOS_TREND for k in FRAMES
        )
        parts.append(
            f"lost_{h} AS (SELECT *, CASE WHEN head = -1 THEN 0 ELSE 1 END AS head_exists, {trend} FROM los_{h})"
        )
    return ",".join(parts)


_PCT = """
pct AS (SELECT member_id, month, """ + ", ".join(
    f"percent_rank() OVER (PARTITION BY {', '.join(cols)} ORDER BY {col} NULLS FIRST) AS pct_{scope}_{name}"
    for scope, cols in SCOPES.items() for name, col in MEASURES.items()
) + " FROM grouped WHERE status = 'ACTIVE' AND member_type = 'I')"

_PROMO = f"""
promo AS (SELECT p.member_id, p.month, {jq._promo_sql(9)} FROM panel p LEFT JOIN campaigns c ON c.month = p.month GROUP BY 1, 2),
sku AS (SELECT o_custkey AS member_id, date_trunc('month', o_orderdate)::DATE AS month, count(CASE WHEN l_discount >= 0.09
  THEN l_partkey END) AS n_promo_sku FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)"""

_ENGAGE = """
mspan AS (SELECT member_id, unnest(generate_series(min(month)::TIMESTAMP, max(month)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month
  FROM mev GROUP BY 1),
mcount AS (SELECT member_id, month, count(*) AS n_logins, """ + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in fam.ENGAGED
) + """ FROM mev GROUP BY 1, 2),
mdense AS (SELECT member_id, month, """ + ", ".join(f"coalesce(n_{t}, 0) AS n_{t}" for t in fam.ENGAGED) + """,
  CASE WHEN n_purchase > 0 AND n_signup > 0 THEN n_signup ELSE 0 END AS cart, row_number() OVER """ + _W + """) AS rn
  FROM mspan LEFT JOIN mcount USING (member_id, month)),
engaged AS (SELECT member_id, month, """ + ", ".join(
    f"CAST(sum(n_{t}) OVER {_W} ROWS {k - 1} PRECEDING) AS BIGINT) AS n_lag_{t}_sum_{k}m" for t in fam.ENGAGED for k in FRAMES
) + ", " + ", ".join(f"n_{t} AS {n}" for n, t in FUNNEL_STEPS.items()) + ", CAST(cart AS DOUBLE) AS n_funnel_cart, " + ", ".join(
    f"CASE WHEN rn >= {k} THEN CAST(sum(n_{t}) OVER {_W} ROWS {k - 1} PRECEDING) AS BIGINT) END AS {n}_sum_{k}m"
    for n, t in FUNNEL_STEPS.items() for k in FRAMES
) + ", " + ", ".join(
    f"CASE WHEN rn >= {k} THEN CAST(sum(cart) OVER {_W} ROWS {k - 1} PRECEDING) AS DOUBLE) END AS n_funnel_cart_sum_{k}m" for k in FRAMES
) + " FROM mdense)"

_AWARD = f"""
award AS (SELECT member_id, month, yearly_rank, a.rank_name AS monthly_name, y.rank_name AS yearly_name FROM (
    SELECT member_id, month, rank, max(rank) OVER (PARTITION BY member_id, year(month + INTERVAL 4 MONTH)) AS yearly_rank FROM panel)
  LEFT JOIN {jq._NAMES_SQL.replace('n(k, rank_name)', 'a(k, rank_name)')} ON rank = a.k
  LEFT JOIN {jq._NAMES_SQL.replace('n(k, rank_name)', 'y(k, rank_name)')} ON yearly_rank = y.k),
global_rank AS (SELECT member_id, year(month + INTERVAL 4 MONTH) AS fy, CAST(max(rank) AS VARCHAR) AS global_rank_no,
  'Level' || CAST(max(rank) // 10 AS VARCHAR) AS global_rank_desc FROM panel GROUP BY 1, 2 HAVING max(rank) >= 350)"""


def _star_sql() -> str:
    los = "\n".join(f"LEFT JOIN lost_{h} ON lost_{h}.head = g.{h}_head AND lost_{h}.month = g.month" for h in b.HEADS)
    los_cols = ", ".join(f"lost_{h}.{c} AS n_los_{h}_{c}" for h in b.HEADS for c in LOS_COLS)
    eng = ", ".join(
        [f"e.n_lag_{t}_sum_{k}m" for t in fam.ENGAGED for k in FRAMES]
        + [f"e.{f}" for f in FUNNEL_COLS] + [f"e.{f}_sum_{k}m" for f in FUNNEL_COLS for k in FRAMES]
    )
    return f"""
star AS (
  SELECT g.*, d.* EXCLUDE (sponsor_id, month), pct.* EXCLUDE (member_id, month), promo.* EXCLUDE (member_id, month),
    sku.n_promo_sku, mcount.n_logins, {eng}, {los_cols}, income, {jq._index_sql()},
    up.rank AS upline_rank, up.tenure AS upline_tenure, {", ".join(f"ug.{u} AS up_{u}" for u in jq.UPLINE)},
    monthly_name, yearly_name, yearly_rank, global_rank_no, global_rank_desc, s_nationkey AS dist,
    CAST(year(g.month + INTERVAL 4 MONTH) AS INTEGER) AS fy, (g.month - to_months(g.tenure))::DATE AS signup
  FROM grouped g
  LEFT JOIN ao ON ao.month = g.month LEFT JOIN ar ON ar.month = g.month AND ar.province = g.province
  LEFT JOIN ak ON ak.month = g.month AND ak.rank = g.rank
  LEFT JOIN income i ON i.province = g.province AND i.year = year(g.month)
  {los}
  LEFT JOIN grouped up ON up.member_id = g.sponsor_id AND up.month = g.month
  LEFT JOIN downline ug ON ug.sponsor_id = g.sponsor_id AND ug.month = g.month
  LEFT JOIN downline d ON d.sponsor_id = g.member_id AND d.month = g.month
  LEFT JOIN pct ON pct.member_id = g.member_id AND pct.month = g.month
  LEFT JOIN promo ON promo.member_id = g.member_id AND promo.month = g.month
  LEFT JOIN sku ON sku.member_id = g.member_id AND sku.month = g.month
  LEFT JOIN mcount ON mcount.member_id = g.member_id AND mcount.month = g.month
  LEFT JOIN engaged e ON e.member_id = g.member_id AND e.month = g.month
  LEFT JOIN award ON award.member_id = g.member_id AND award.month = g.month
  LEFT JOIN global_rank gr ON gr.member_id = g.member_id AND gr.fy = year(g.month + INTERVAL 4 MONTH)
  LEFT JOIN supplier ON s_suppkey = g.member_id)"""


def _family_sql(spec, before: int | str) -> str:
    def roll(e):
        return f"{spec.agg}({e}) OVER {_W} ROWS {before} PRECEDING)"

    value = roll(spec.expr)
    if spec.over:
        return f"coalesce({value} / nullif({roll(spec.over)}, 0), 0)"
    if spec.per:
        return f"coalesce({value} / nullif({spec.per}, 0), 0)"
    kind = fam.KIND[spec.stem]
    if kind == "int" and spec.agg == "sum":
        return f"CAST({value} AS BIGINT)"
    return f"round({value}, 9)" if kind == "ratio" else value


def _plain_columns(framed: bool) -> list[str]:
    """Columns of the wide table without the families; ``framed`` ones are tied to a fixed frame."""
    cols = ["member_id", "month", "sponsor_id", "tenure AS n_tenure", "CAST(year(signup) AS INTEGER) AS signup_year",
            "CASE WHEN year(signup) > 1995 THEN 1 ELSE 0 END AS n_signup_after_1995", "member_type AS i_member_type",
            "status AS i_status", "local_type AS i_local_type", "age AS n_age",
            "CASE WHEN age <= 34 THEN 1 ELSE 0 END AS n_under_35", "gender AS i_gender", "segment AS i_segment",
            "CASE WHEN renew_flag = 'Y' THEN 1 ELSE 0 END AS n_renew_flag",
            "CASE WHEN recur_flag = 'Y' THEN 1 ELSE 0 END AS n_recur_flag", "recur_pv AS n_recur_pv",
            "coalesce(recur_pv / nullif(pv, 0), 0) AS n_pct_pv_recur", "pv - stly_pv AS n_change_stly_pv",
            "rev - stly_rev AS n_change_stly_rev", "region AS i_region", "income AS n_region_income",
            "coalesce(bonus_gross / nullif(income, 0), 0) AS n_pct_income", "fy AS i_fiscal_year",
            "coalesce(dl_rank_max, 0) AS i_dl_rank_max", "upline_rank AS i_upline_rank", "upline_tenure AS n_upline_tenure",
            "CASE WHEN pv <= 0 THEN 0 ELSE greatest(web_pv, walk_pv, tel_pv, mob_pv, othr_pv) / pv END AS n_top_channel_share",
            """CASE greatest(web_pv, walk_pv, tel_pv, mob_pv, othr_pv) WHEN 0 THEN 'NONE' WHEN web_pv THEN 'web'
               WHEN walk_pv THEN 'walk' WHEN tel_pv THEN 'tel' WHEN mob_pv THEN 'mob' ELSE 'othr' END AS i_top_channel""",
            "n_logins", "monthly_name AS i_monthly_award", "yearly_name AS i_yearly_award", "yearly_rank AS i_yearly_rank",
            "dist AS i_dist_num", "global_rank_no", "global_rank_desc", "signup AS signup_month",
            f"coalesce(lag(bonus_gross) OVER {_W}) / nullif(income, 0), 0) AS n_pct_income_previous"]
    cols += [f"coalesce(pct_{s}_{m}, 0) AS n_pct_{s}_{m}" for s in SCOPES for m in MEASURES]
    cols += [f"n_index_{p}_{n}" for p in ("overall", "region", "rank") for n in jq.AVG]
    cols += [f"round({ln}_multiple, 9) AS n_promo_{ln}_multiple" for ln in PROMO_LINES]
    cols += [f"n_{ln}_promo AS n_promo_{ln}" for ln in PROMO_LINES]
    cols += [f"coalesce({d}, 0) AS n_{d}" for d in DL_VALUES if d != "dl_rank_max"]
    cols += [f"coalesce({a} / nullif({d}, 0), 0) AS {n}" for n, (a, d) in DL_SHARES.items()]
    cols += [f"up_{u} AS n_upline_{u[3:]}" for u in jq.UPLINE]
    los = [f"n_los_{h}_{c}" for h in b.HEADS for c in LOS_COLS]
    cols += los if framed else [c for c in los if not c.endswith("m") or "_avg_" not in c]
    cols += FUNNEL_COLS
    if framed:
        cols += [f"n_lag_{t}_sum_{k}m" for t in fam.ENGAGED for k in FRAMES]
        cols += [f"{f}_sum_{k}m" for f in FUNNEL_COLS for k in FRAMES]
    for c in fam.CURRENT:
        cols.append(f"{c.expr} AS {c.name}")
        if c.previous:
            prev = f"lag({c.expr}) OVER {_W})"
            cols.append(f"{'coalesce(' + prev + ', 0)' if c.previous == 'zero' else prev} AS {c.name}_previous")
    added = [f"front_sellers - lag(front_sellers, {k}) OVER {_W}) AS {n}" for n, k in ADDED.items()]
    added += [f"up_dl_sellers - lag(up_dl_sellers, {k}) OVER {_W}) AS {n}" for n, k in UP_ADDED.items()]
    cols += added if framed else [c for c in added if not shape.framed_columns([c.rsplit(" ", 1)[1]])]
    return cols + [
        f"CASE WHEN month = min(CASE WHEN {e} THEN month END) OVER (PARTITION BY member_id) THEN 1 ELSE 0 END AS n_{n}"
        for n, e in jq.PREDS.items()
    ]


def _wide_sql() -> str:
    cols = _plain_columns(True) + [f"{_family_sql(s, k - 1)} AS {s.stem}_{k}m" for s in fam.FAMILIES for k in FRAMES]
    return "wide AS (SELECT " + ",\n  ".join(cols) + " FROM star)"


def slices_sql(tenures) -> str:
    """The wide table with each family over the last n_tenure rows."""
    families = [f"{_family_sql(s, 'greatest(tenure - 1, 0)')} AS {s.stem}_month_agg" for s in fam.FAMILIES]
    return f"""
slices AS (SELECT {", ".join(_plain_columns(False) + families)} FROM star QUALIFY tenure IN ({", ".join(map(str, tenures))}))"""


def _derived_sql() -> str:
    mom = [f"{s}_3m / nullif({s}_6m - {s}_3m, 0) AS {s}_3m_mom" for s in fam.TRACKED]
    lyr = [f"lag({s}_12m, 12) OVER {_W}) AS {s}_12m_lyr" for s in fam.TRACKED]
    rel = [f"{s}_12m / nullif(lag({s}_12m, 12) OVER {_W}), 0) AS {s}_12m_12m_mom" for s in fam.TRACKED]
    return "SELECT *, " + ",\n ".join(mom + lyr + rel) + " FROM wide"


STAR_PARTS = (REPEAT, jq.DOWNLINE_SQL, INCOME, CAMPAIGNS, MONTH_EVENTS, jq.AVG_SQL, _los_ctes(), _PCT, _PROMO, _ENGAGE, _AWARD, _star_sql())
WIDE_PARTS = (*STAR_PARTS, _wide_sql())
FEATURE_PARTS = (*WIDE_PARTS, f"features AS MATERIALIZED ({_derived_sql()})")


@query("feature_table", cte(*WIDE_PARTS, body=_derived_sql()))
def feature_table_query(spark, sf):
    return comparable(feature_table(spark, sf))


STAR_OUT = ["member_id", "month", "pv", "group_pv", "upline_rank", "up_dl_sellers", "dl_sellers", "dl_customers_repeat", "income",
            "n_promo_sku", "n_logins", "n_funnel_order", "n_lag_view_sum_6m", "pct_region_prsnl_pv", "n_index_rank_group_pv",
            "n_los_sil_q_mth", "n_los_dia_customers", "yearly_rank", "yearly_name", "global_rank_no"]


@query("feature_star_join", cte(*STAR_PARTS, body=f"SELECT {', '.join(STAR_OUT)} FROM star"))
def feature_star_join(spark, sf):
    rows = star(spark, sf, base_panel(spark, sf))
    return rows.select("*", *jq.index_columns()).select(*STAR_OUT)


@query(
    "los_features_on_member",
    cte(REPEAT, _los_ctes(), body="SELECT g.member_id, g.month, "
        + ", ".join(f"lost_{h}.{c} AS n_los_{h}_{c}" for h in b.HEADS for c in LOS_COLS) + " FROM grouped g "
        + " ".join(f"LEFT JOIN lost_{h} ON lost_{h}.head = g.{h}_head AND lost_{h}.month = g.month" for h in b.HEADS)),
)
def los_features_on_member(spark, sf):
    p = stage(jq.los_panel(spark, sf, b.HEADS), "panel")
    rows = p.select(*KEY, *[f"{h}_head" for h in b.HEADS])
    table = stage(los_table(p), "heads")
    joined = ft.star_join(rows, los_lookups(rows, table, far_lookups(table)))
    return ft.unpack(joined, [f"los_{h}" for h in b.HEADS]).select(*KEY, *[f"n_los_{h}_{c}" for h in b.HEADS for c in LOS_COLS])
