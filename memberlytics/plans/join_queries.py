"""Joins and aggregates: enrichment, lookups, rollups by head and sponsor, campaigns, events."""

from __future__ import annotations

from pyspark.sql import functions as F

from memberlytics import functions as fn
from memberlytics.operators import engage, panel as pn, rolling as ro, rollup
from memberlytics.operators.rolling import FRAMES
from memberlytics.plans import bindings as b
from memberlytics.plans.catalog import query
from memberlytics.plans.oracle import CAMPAIGNS, EVENTS, GROUPED, MEMBERS, MONTH_EVENTS, PANEL, REPEAT, cte
from memberlytics.session import broadcast_if_small, stage, unmeasured
from memberlytics.plans.window_queries import KEY, active_sellers

# --- joins ---------------------------------------------------------------------------------


@query(
    "join_inner_enrich",
    """SELECT o_orderkey, o_custkey, o_totalprice, qty FROM orders JOIN
         (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
       WHERE o_orderdate < TIMESTAMP '2001-06-01'
       UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, -1.0 FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01'""",
)
def join_inner_enrich(spark, sf):
    o = b.table(spark, sf, "orders")
    late = F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz")
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    extra = b.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("qty"))
    newer = o.filter(late).select(*cols, F.lit(-1.0).alias("qty"))
    return pn.merge_parts(o.filter(~late).select(*cols), extra, ["o_orderkey"], [newer])


@query(
    "join_left_replace",
    cte(PANEL, body="""SELECT p.member_id, p.month, pv, n AS orders FROM panel p LEFT JOIN
      (SELECT user_id AS member_id, count(*) AS n FROM events GROUP BY 1) USING (member_id)"""),
)
def join_left_replace(spark, sf):
    p = b.monthly(spark, sf).select(*KEY, "pv", "orders")
    counts = b.table(spark, sf, "events").groupBy(F.col("user_id").alias("member_id")).agg(F.count(F.lit(1)).alias("orders"))
    return pn.replace_by_join(p, counts, ["member_id"], "orders")


RANK_NAMES = [(310, "Rank310"), (320, "Rank320"), (330, "Rank330"), (350, "Rank350"), (370, "Rank370"), (380, "Rank380")]
_NAMES_SQL = "(VALUES " + ", ".join(f"({k}, '{v}')" for k, v in RANK_NAMES) + ") AS n(k, rank_name)"


def rank_names(spark):
    return spark.createDataFrame(RANK_NAMES, "rank int, rank_name string")


@query(
    "join_lookup",
    cte(PANEL, body=f"SELECT member_id, month, rank, rank_name FROM panel LEFT JOIN {_NAMES_SQL} ON rank = k"),
)
def join_lookup(spark, sf):
    names = rank_names(spark).select(F.col("rank").alias("k"), "rank_name")
    p = b.panel(spark, sf).select(*KEY, "rank")
    return p.join(names, F.col("rank") == F.col("k"), "left").drop("k")


PREDS = {
    "first_order": "orders > 0",
    "first_310": "rank = 310",
    "first_320": "rank = 320",
    "first_330": "rank = 330",
    "first_b3": "group_pv BETWEEN 1 AND 49",
    "first_b6": "group_pv BETWEEN 50 AND 99",
    "first_b9": "group_pv BETWEEN 100 AND 149",
    "first_b12": "group_pv BETWEEN 150 AND 199",
    "first_b15": "group_pv BETWEEN 200 AND 299",
    "first_b18": "group_pv BETWEEN 300 AND 399",
    "first_b21": "group_pv BETWEEN 400 AND 499",
    "first_b23": "group_pv BETWEEN 500 AND 749",
    "first_rep": "local_type = 'REP'",
    "first_agent": "local_type = 'AGENT'",
}


def _first_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT member_id, min(month) AS month, '{n}' AS what FROM grouped WHERE {p} GROUP BY 1" for n, p in PREDS.items()
    )
    flags = ", ".join(f"CAST(max(CASE WHEN what = '{n}' THEN 1 ELSE 0 END) AS INTEGER) AS {n}" for n in PREDS)
    return f"SELECT member_id, month, {flags} FROM ({parts}) GROUP BY 1, 2"


@query("first_indicators", cte(GROUPED, body=_first_sql()))
def first_indicators(spark, sf):
    p = b.with_group(b.panel(spark, sf))
    return rollup.first_indicators(p, "member_id", "month", {n: F.expr(e) for n, e in PREDS.items()})


@query(
    "join_full_outer_chain",
    cte(PANEL, body="""SELECT member_id, month, coalesce(n1, 0) AS first_order, coalesce(n2, 0) AS first_late,
      coalesce(n3, 0) AS first_big FROM
      (SELECT member_id, min(month) AS month, 1 AS n1 FROM panel GROUP BY 1)
      FULL JOIN (SELECT member_id, min(month) AS month, 1 AS n2 FROM panel WHERE last3_pv > 0 GROUP BY 1) USING (member_id, month)
      FULL JOIN (SELECT member_id, min(month) AS month, 1 AS n3 FROM panel WHERE pv >= 150 GROUP BY 1) USING (member_id, month)"""),
)
def join_full_outer_chain(spark, sf):
    p = b.monthly(spark, sf).select(*KEY, "pv", "last3_pv")
    conds = {"first_order": F.lit(True), "first_late": F.col("last3_pv") > 0, "first_big": F.col("pv") >= 150}
    parts = [
        p.filter(c).groupBy("member_id").agg(F.min("month").alias("month")).withColumn(n, F.lit(1))
        for n, c in conds.items()
    ]
    return rollup.full_outer_chain(parts, list(KEY)).na.fill(0, list(conds))


@query(
    "join_self_shift",
    cte(PANEL, body="""SELECT a.member_id, a.month, a.pv, b.pv AS pv_later, b.rank AS rank_later FROM panel a
      LEFT JOIN panel b ON a.member_id = b.member_id AND b.month = (a.month + INTERVAL 3 MONTH)::DATE"""),
)
def join_self_shift(spark, sf):
    p = b.panel(spark, sf).select(*KEY, "pv", "rank")
    out = pn.shift_join(p, p, "member_id", "month", 3, {"pv": "pv_later", "rank": "rank_later"})
    return out.drop("rank")


@query(
    "join_semi_sessions",
    cte(EVENTS, body="""SELECT event_id, user_id, day, event_type FROM ev WHERE EXISTS (
      SELECT 1 FROM ev x WHERE x.user_id = ev.user_id AND x.day = ev.day AND x.event_type = 'purchase')"""),
)
def join_semi_sessions(spark, sf):
    e = b.daily_events(spark, sf).select("event_id", "user_id", "day", "event_type")
    return engage.semi_sessions(e, ["user_id", "day"], F.col("event_type") == "purchase")


@query(
    "join_broadcast_label",
    cte(PANEL, body="""SELECT p.member_id, p.month, p.pv, renewed FROM panel p JOIN (
      SELECT member_id, max(CASE WHEN tenure >= 12 THEN 1 ELSE 0 END) AS renewed FROM panel GROUP BY 1) USING (member_id)"""),
)
def join_broadcast_label(spark, sf):
    """The label side is written, counted and broadcast if it is small; beyond that the join is an ordinary one."""
    p = b.panel(spark, sf).select(*KEY, "pv", "tenure")
    label = p.groupBy("member_id").agg(F.max(fn.flag(F.col("tenure") >= 12)).alias("renewed"))
    return p.join(broadcast_if_small(label, "label"), "member_id").drop("tenure")


@query(
    "promo_fanout",
    cte(PANEL, CAMPAIGNS, body="""SELECT p.member_id, p.month, rev, line, unit_price FROM panel p
      LEFT JOIN campaigns c ON c.month = p.month"""),
)
def promo_fanout(spark, sf):
    return b.monthly(spark, sf).select(*KEY, "rev").join(b.campaigns(spark, sf), "month", "left")


def _promo_sql(digits: int = 6) -> str:
    out = []
    for line in [*b.LINES, "all"]:
        rev = "rev" if line == "all" else f"{line}_rev"
        hit = f"line = '{line}' AND {rev} >= unit_price"
        out.append(f"CAST(sum(CASE WHEN {hit} THEN 1 ELSE 0 END) AS BIGINT) AS n_{line}_promo")
        out.append(f"round(avg(CASE WHEN {hit} THEN {rev} / unit_price ELSE 0 END), {digits}) AS {line}_multiple")
    return ", ".join(out)


@query(
    "promo_response",
    cte(PANEL, CAMPAIGNS, body=f"""SELECT p.member_id, p.month, {_promo_sql()} FROM panel p
      LEFT JOIN campaigns c ON c.month = p.month GROUP BY 1, 2"""),
)
def promo_response(spark, sf):
    lines = {**{ln: f"{ln}_rev" for ln in b.LINES}, "all": "rev"}
    out = rollup.promo_response(b.monthly(spark, sf, by_line=True), KEY, "month", b.campaigns(spark, sf), lines)
    return out.select(*[F.round(c, 6).alias(c) if c.endswith("_multiple") else F.col(c) for c in out.columns])


@query(
    "promo_sku_count",
    """SELECT o_custkey AS member_id, date_trunc('month', o_orderdate)::DATE AS month, count(sku) AS n_promo_sku
       FROM orders JOIN (SELECT l_orderkey, CASE WHEN l_discount >= 0.09 THEN l_partkey END AS sku FROM lineitem)
       ON o_orderkey = l_orderkey GROUP BY 1, 2""",
)
def promo_sku_count(spark, sf):
    """Promotion items per member and month; lines are counted per order before the join."""
    sku = F.count(F.when(F.col("l_discount") >= 0.09, F.col("l_partkey"))).alias("n")
    per_order = b.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(sku)
    o = b.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("member_id"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")
    )
    joined = o.join(unmeasured(per_order), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy(*KEY).agg(F.sum("n").alias("n_promo_sku"))


# --- awards ----------------------------------------------------------------------------------


@query(
    "award_monthly_yearly",
    cte(PANEL, body=f"""SELECT member_id, month, fy, rank AS monthly_rank, yearly_rank, a.rank_name AS monthly_name,
      y.rank_name AS yearly_name FROM (
        SELECT *, max(rank) OVER (PARTITION BY member_id, fy) AS yearly_rank FROM (
          SELECT member_id, month, rank, CAST(year(month + INTERVAL 4 MONTH) AS INTEGER) AS fy FROM panel))
      LEFT JOIN {_NAMES_SQL.replace('n(k, rank_name)', 'a(k, rank_name)')} ON rank = a.k
      LEFT JOIN {_NAMES_SQL.replace('n(k, rank_name)', 'y(k, rank_name)')} ON yearly_rank = y.k"""),
)
def award_monthly_yearly(spark, sf):
    p = b.panel(spark, sf).select(*KEY, "rank", fn.fiscal_year("month").alias("fy"))
    return rollup.monthly_yearly_rank(p, "member_id", "fy", "rank", rank_names(spark)).withColumnRenamed("rank", "monthly_rank")


# A ladder of 19 levels, highest first: flag, score and name follow from the place.
AWARD_LEVELS = [(i, f"level_{i}_flag", 400 - 5 * i, f"Award {i}") for i in range(1, 20)]


def _level_sql(i: int) -> str:
    more = {10: " OR status <> 'ACTIVE'", 19: " OR orders > 1"}.get(i, "")
    return f"(member_id + {i} * (year(month) * 12 + month(month))) % 19 = 0{more}"


def _award_case(value) -> str:
    return "CASE " + " ".join(f"WHEN {_level_sql(i)} THEN {value(i)}" for i, *_ in AWARD_LEVELS) + " END"


_AWARD_NAMES = "CASE {0} " + " ".join(f"WHEN {score} THEN '{name}'" for _, _, score, name in AWARD_LEVELS) + " END"


@query(
    "award_from_flags",
    cte(PANEL, body=f"""SELECT *, {_AWARD_NAMES.format("monthly_score")} AS monthly_name, {_AWARD_NAMES.format("yearly_score")} AS yearly_name
      FROM (SELECT *, max(monthly_score) OVER (PARTITION BY member_id, fy) AS yearly_score FROM (
        SELECT member_id, month, CAST(year(month + INTERVAL 4 MONTH) AS INTEGER) AS fy, {_award_case(lambda i: 400 - 5 * i)} AS monthly_score
        FROM panel))"""),
)
def award_from_flags(spark, sf):
    """Flags of 19 levels to monthly and yearly awards; every level occurs."""
    p = b.panel(spark, sf).select(*KEY, "status", "orders")
    p = p.select(*KEY, *[fn.flag(F.expr(_level_sql(i))).alias(f) for i, f, *_ in AWARD_LEVELS])
    levels = spark.createDataFrame(AWARD_LEVELS, "pos int, flag string, score int, name string")
    return rollup.awards_from_flags(p, "member_id", "month", fn.fiscal_year("month"), levels)


# --- rollups by head and sponsor -------------------------------------------------------------


def _is(kind: str):
    return F.col("member_type") == kind


def los_measures() -> dict:
    seller = _is("I")
    flags = {q: fn.flag(seller & (F.col(f"{q}_flag") == "Y")) for q in ("q", "qv", "q1", "q2")}
    return {
        "sellers": fn.flag(seller),
        "sellers_agent": fn.flag(F.col("local_type") == "AGENT"),
        "sellers_rep": fn.flag(F.col("local_type") == "REP"),
        "sellers_engaged": fn.yes("engage_flag"),
        "customers": fn.flag(_is("C")),
        "customers_repeat": F.col("is_repeat"),
        **{f"{q}_mth": c for q, c in flags.items()},
        "leaves": fn.flag(F.col("front_sellers") == 0),
    }


LOS_FRONT = ["sellers", "customers", "q_mth", "qv_mth", "q1_mth", "q2_mth"]
LOS_TREND = ["customers", "customers_repeat", "q_mth", "front_q_mth"]


def with_repeat(p):
    """Repeat-customer flag as a column: the window by member replaces a join on (member, month).

    NULL for members that are not customers.
    """
    customer = _is("C")
    good = customer & (F.col("orders") > 0) & (F.col("status") == "ACTIVE")
    _, is_repeat = rollup.repeat_flag(["member_id", "member_type"], "month", good)
    return p.withColumn("is_repeat", F.when(customer, is_repeat))


def los_rollup(p, heads=b.HEADS):
    """Group rollup on the given head levels, of a panel with repeat flag and head columns."""
    return rollup.head_rollup(
        p,
        {h: f"{h}_head" for h in heads},
        "member_id",
        "month",
        "sponsor_id",
        los_measures(),
        LOS_FRONT,
        keep=F.col("status") == "ACTIVE",
        ratio=("pv_per_member", F.col("pv"), F.lit(1)),
    )


def los_panel(spark, sf, heads):
    p = with_repeat(b.with_group(b.panel(spark, sf)))
    return b.with_far_heads(p, spark, sf) if set(heads) & {"plat", "emd", "dia"} else p


def _los_sql(head: str) -> str:
    h = f"{head}_head"
    seller = "member_type = 'I'"
    conds = {
        "sellers": seller,
        "sellers_agent": "local_type = 'AGENT'",
        "sellers_rep": "local_type = 'REP'",
        "sellers_engaged": "engage_flag = 'Y'",
        "customers": "member_type = 'C'",
        "q_mth": f"{seller} AND q_flag = 'Y'",
        "qv_mth": f"{seller} AND qv_flag = 'Y'",
        "q1_mth": f"{seller} AND q1_flag = 'Y'",
        "q2_mth": f"{seller} AND q2_flag = 'Y'",
        "leaves": "front_sellers = 0",
    }
    total = ", ".join(f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, c in conds.items())
    front = ", ".join(
        f"CAST(sum(CASE WHEN sponsor_id = c.head_key AND {conds[n]} THEN 1 ELSE 0 END) AS BIGINT) AS front_{n}"
        for n in LOS_FRONT
    )
    return f"""
heads AS (SELECT DISTINCT member_id AS head_key, {h} AS h FROM grouped WHERE member_id = {h}),
los AS (
  SELECT g.{h} AS head, g.month, {total}, CAST(sum(is_repeat) AS BIGINT) AS customers_repeat,
    coalesce(sum(pv) / count(*), 0) AS pv_per_member, {front}
  FROM grouped g LEFT JOIN repeats USING (member_id, month) LEFT JOIN heads c ON c.h = g.{h}
  WHERE status = 'ACTIVE' GROUP BY 1, 2)"""


def _trend_sql() -> str:
    return ", ".join(
        f"avg({c}) OVER (PARTITION BY head ORDER BY month ROWS {k - 1} PRECEDING) AS {c}_avg_{k}m" for c in LOS_TREND for k in FRAMES
    )


def _register_los(head: str) -> None:
    @query(f"los_rollup_{head}", cte(REPEAT, _los_sql(head), body="SELECT * FROM los"))
    def rolled(spark, sf):
        return los_rollup(los_panel(spark, sf, [head]), [head]).drop("level")

    @query(
        f"los_trend_{head}",
        cte(REPEAT, _los_sql(head), body=f"""SELECT head, month, CASE WHEN head = -1 THEN 0 ELSE 1 END AS head_exists,
          {_trend_sql()} FROM los"""),
    )
    def trend(spark, sf):
        out = rollup.head_trend(los_rollup(los_panel(spark, sf, [head]), [head]), "month", LOS_TREND)
        return out.select("head", "month", "head_exists", *[f"{c}_avg_{k}m" for c in LOS_TREND for k in FRAMES])


for _head in b.HEADS:
    _register_los(_head)


def downline_measures() -> dict:
    seller, customer = _is("I"), _is("C")
    n = lambda c: F.count(F.when(c, 1))
    zero_else = lambda c, v: F.sum(F.when(c, F.col(v)).otherwise(0.0))
    return {
        "dl_all": F.count("member_id"),
        "dl_sellers": n(seller),
        "dl_customers": n(customer),
        "dl_customers_repeat": F.sum("is_repeat").cast("long"),
        "dl_pv": F.sum("pv"),
        "dl_customer_pv": zero_else(customer, "pv"),
        "dl_seller_pv": zero_else(seller, "pv"),
        "dl_group_pv": F.sum("group_pv"),
        "dl_orders": F.sum("orders"),
        "dl_orders_nonzero": n(F.col("orders") > 0),
        "dl_sponsor": n(seller & (F.col("sponsor_flag") == "Y")),
        "dl_rank_achieved": n(F.col("rank") > 0),
        "dl_rank_310": n(F.col("rank") == 310),
        "dl_rank_320": n(F.col("rank") == 320),
        "dl_rank_max": F.max("rank"),
        "dl_front_sellers": F.sum("front_sellers"),
        "dl_front_customers": F.sum("front_customers"),
        "dl_bonus_9plus": n(F.col("bonus_pct") >= 9),
        "dl_q": n(seller & (F.col("q_flag") == "Y")),
        "dl_qv": n(seller & (F.col("qv_flag") == "Y")),
        "dl_q1": n(seller & (F.col("q1_flag") == "Y")),
        "dl_q2": n(seller & (F.col("q2_flag") == "Y")),
    }


def downline(p):
    active = p.filter(F.col("status") == "ACTIVE")
    return rollup.downline_rollup(active, "sponsor_id", "month", downline_measures())


DOWNLINE_SQL = """
downline AS (
  SELECT sponsor_id, month, count(*) AS dl_all, count(*) FILTER (WHERE member_type = 'I') AS dl_sellers,
    count(*) FILTER (WHERE member_type = 'C') AS dl_customers, CAST(sum(is_repeat) AS BIGINT) AS dl_customers_repeat,
    sum(pv) AS dl_pv, coalesce(sum(pv) FILTER (WHERE member_type = 'C'), 0) AS dl_customer_pv,
    coalesce(sum(pv) FILTER (WHERE member_type = 'I'), 0) AS dl_seller_pv, sum(group_pv) AS dl_group_pv,
    CAST(sum(orders) AS BIGINT) AS dl_orders, count(*) FILTER (WHERE orders > 0) AS dl_orders_nonzero,
    count(*) FILTER (WHERE member_type = 'I' AND sponsor_flag = 'Y') AS dl_sponsor,
    count(*) FILTER (WHERE rank > 0) AS dl_rank_achieved, count(*) FILTER (WHERE rank = 310) AS dl_rank_310,
    count(*) FILTER (WHERE rank = 320) AS dl_rank_320, max(rank) AS dl_rank_max,
    CAST(sum(front_sellers) AS BIGINT) AS dl_front_sellers, CAST(sum(front_customers) AS BIGINT) AS dl_front_customers,
    count(*) FILTER (WHERE bonus_pct >= 9) AS dl_bonus_9plus,
    count(*) FILTER (WHERE member_type = 'I' AND q_flag = 'Y') AS dl_q,
    count(*) FILTER (WHERE member_type = 'I' AND qv_flag = 'Y') AS dl_qv,
    count(*) FILTER (WHERE member_type = 'I' AND q1_flag = 'Y') AS dl_q1,
    count(*) FILTER (WHERE member_type = 'I' AND q2_flag = 'Y') AS dl_q2
  FROM grouped LEFT JOIN repeats USING (member_id, month) WHERE status = 'ACTIVE' GROUP BY 1, 2)"""


@query("downline_rollup", cte(REPEAT, DOWNLINE_SQL, body="SELECT * FROM downline"))
def downline_rollup(spark, sf):
    return downline(with_repeat(b.with_group(b.panel(spark, sf))))


UPLINE = ("dl_sellers", "dl_customers", "dl_pv", "dl_group_pv", "dl_orders", "dl_orders_nonzero", "dl_sponsor",
          "dl_rank_achieved", "dl_q", "dl_qv", "dl_q1", "dl_q2")
ADDED = {"upline_added_1m": 1, "upline_added_3m": 2, "upline_added_6m": 5, "upline_added_9m": 8, "upline_added_12m": 11}


@query(
    "upline_features",
    cte(REPEAT, DOWNLINE_SQL, body="SELECT b.member_id, b.month, up.rank AS upline_rank, up.tenure AS upline_tenure, "
        + ", ".join(f"g.{c} AS up_{c}" for c in UPLINE) + ", "
        + ", ".join(f"g.dl_sellers - lag(g.dl_sellers, {k}) OVER w AS {n}" for n, k in ADDED.items())
        + """ FROM grouped b LEFT JOIN grouped up ON up.member_id = b.sponsor_id AND up.month = b.month
          LEFT JOIN downline g ON g.sponsor_id = b.sponsor_id AND g.month = b.month
          WINDOW w AS (PARTITION BY b.member_id ORDER BY b.month)"""),
)
def upline_features(spark, sf):
    p = with_repeat(b.with_group(b.panel(spark, sf)))
    out = attach_upline(p.select(*KEY, "sponsor_id"), p, downline(p))
    return ro.delta(out, "member_id", "month", "up_dl_sellers", ADDED).drop("sponsor_id")


def upline_table(p, down):
    """Sponsor's own row and sponsor's group measures, unique on (sponsor, month)."""
    own = p.select(
        F.col("member_id").alias("sponsor_id"), "month", F.col("rank").alias("upline_rank"), F.col("tenure").alias("upline_tenure")
    )
    group = down.filter(F.col("sponsor_id").isNotNull()).select(
        "sponsor_id", "month", *[F.col(c).alias(f"up_{c}") for c in UPLINE]
    )
    return own.join(group, ["sponsor_id", "month"], "full")


def attach_upline(rows, p, down):
    """Both right sides are joined to each other first, so the panel is shuffled by sponsor once.

    A sponsor of very many members is a large partition of the panel side only, which run-time
    skew handling may split.
    """
    return rows.join(upline_table(p, down), ["sponsor_id", "month"], "left")


# --- averages --------------------------------------------------------------------------------

AVG = {"grs_bns": "bonus_gross", "prsnl_pv": "pv", "group_pv": "group_pv", "prsnl_bv": "bv", "group_bv": "group_bv"}
_ACTIVE = "FROM grouped WHERE status = 'ACTIVE' AND member_type = 'I'"


def _avg_sql(prefix: str) -> str:
    return ", ".join(f"avg({c}) AS {prefix}_{n}" for n, c in AVG.items())


@query("avg_overall", cte(GROUPED, body=f"SELECT month, {_avg_sql('overall')} {_ACTIVE} GROUP BY 1"))
def avg_overall(spark, sf):
    return rollup.averages(active_sellers(spark, sf), ["month"], AVG, lambda m: f"overall_{m}")


@query("avg_by_region", cte(GROUPED, body=f"SELECT month, province, {_avg_sql('region')} {_ACTIVE} GROUP BY 1, 2"))
def avg_by_region(spark, sf):
    return rollup.averages(active_sellers(spark, sf), ["month", "province"], AVG, lambda m: f"region_{m}")


@query("avg_by_rank", cte(GROUPED, body=f"SELECT month, rank, {_avg_sql('rank')} {_ACTIVE} GROUP BY 1, 2"))
def avg_by_rank(spark, sf):
    return rollup.averages(active_sellers(spark, sf), ["month", "rank"], AVG, lambda m: f"rank_{m}")


AVG_SCOPES = {"overall": ["month"], "region": ["month", "province"], "rank": ["month", "rank"]}


def scope_averages(act, prefix):
    """Averages of one scope in columns ``_{scope}_{name}``."""
    return rollup.averages(act, AVG_SCOPES[prefix], AVG, lambda m: f"_{prefix}_{m}")


def attach_averages(p, act):
    """Averages of the month, the region and the rank on every row."""
    for prefix, by in AVG_SCOPES.items():
        p = p.join(broadcast_if_small(scope_averages(act, prefix), f"avg_{prefix}"), by, "left")
    return p


def index_columns():
    """Each measure against the attached averages."""
    return [
        fn.safe_ratio(c, f"_{prefix}_{n}").alias(f"n_index_{prefix}_{n}")
        for prefix in ("overall", "region", "rank")
        for n, c in AVG.items()
    ]


def _index_sql() -> str:
    return ", ".join(
        f"coalesce(g.{c} / nullif({a}.{prefix}_{n}, 0), 0) AS n_index_{prefix}_{n}"
        for prefix, a in (("overall", "ao"), ("region", "ar"), ("rank", "ak"))
        for n, c in AVG.items()
    )


AVG_SQL = f"""
ao AS (SELECT month, {_avg_sql('overall')} {_ACTIVE} GROUP BY 1),
ar AS (SELECT month, province, {_avg_sql('region')} {_ACTIVE} GROUP BY 1, 2),
ak AS (SELECT month, rank, {_avg_sql('rank')} {_ACTIVE} GROUP BY 1, 2)"""


@query(
    "index_vs_average",
    cte(GROUPED, AVG_SQL, body=f"""SELECT g.member_id, g.month, {_index_sql()} FROM grouped g LEFT JOIN ao USING (month)
      LEFT JOIN ar USING (month, province) LEFT JOIN ak ON ak.month = g.month AND ak.rank = g.rank"""),
)
def index_vs_average(spark, sf):
    p = stage(b.with_group(b.panel(spark, sf)), "grouped")
    act = p.filter((F.col("status") == "ACTIVE") & _is("I"))
    return attach_averages(p, act).select(*KEY, *index_columns())


# --- event logs ------------------------------------------------------------------------------


@query(
    "event_counts",
    cte(EVENTS, body="SELECT user_id, day, "
        + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in b.EVENT_TYPES)
        + " FROM ev GROUP BY 1, 2"),
)
def event_counts(spark, sf):
    return engage.event_counts(b.daily_events(spark, sf), "user_id", "day", "event_type", b.EVENT_TYPES)


@query("login_counts", cte(EVENTS, body="SELECT user_id, day, count(*) AS n_logins FROM ev GROUP BY 1, 2"))
def login_counts(spark, sf):
    return engage.login_counts(b.daily_events(spark, sf), "user_id", "day")


@query(
    "cart_size_avg",
    cte(EVENTS, body="""SELECT user_id, week, avg(n) AS cart_size FROM (
      SELECT user_id, week, day, count(*) AS n FROM ev WHERE event_type = 'signup' AND EXISTS (
        SELECT 1 FROM ev x WHERE x.user_id = ev.user_id AND x.day = ev.day AND x.event_type = 'purchase')
      GROUP BY 1, 2, 3) GROUP BY 1, 2"""),
)
def cart_size_avg(spark, sf):
    kind = F.col("event_type")
    return engage.cart_size(b.daily_events(spark, sf), "user_id", "week", ["day"], kind == "signup", kind == "purchase")


_DAYS = """
days AS (SELECT user_id, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM ev GROUP BY 1),
dcounts AS (SELECT user_id, day, """ + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in b.EVENT_TYPES
) + " FROM ev GROUP BY 1, 2)"


def _engage_sql(types, with_counts: bool) -> str:
    out = []
    for t in types:
        if with_counts:
            out.append(f"coalesce(n_{t}, 0) AS n_{t}")
        out += [
            f"CAST(sum(coalesce(n_{t}, 0)) OVER (PARTITION BY user_id ORDER BY day ROWS {k - 1} PRECEDING) AS BIGINT) AS n_{t}_sum_{k}m"
            for k in FRAMES
        ]
    return "SELECT user_id, day, " + ", ".join(out) + " FROM days LEFT JOIN dcounts USING (user_id, day)"


@query("engagement_features", cte(EVENTS, _DAYS, body=_engage_sql(b.EVENT_TYPES, True)))
def engagement_features(spark, sf):
    return engage.engagement(b.daily_events(spark, sf), "user_id", "day", "event_type", b.EVENT_TYPES)


@query("engagement_lags", cte(EVENTS, _DAYS, body=_engage_sql(("view", "click"), False)))
def engagement_lags(spark, sf):
    out = engage.engagement(b.daily_events(spark, sf), "user_id", "day", "event_type", ("view", "click"))
    return out.drop("n_view", "n_click")


WEEKS = (2, 3, 4)
_FUNNEL = """
weeks AS (SELECT user_id, unnest(generate_series(min(week)::TIMESTAMP, max(week)::TIMESTAMP, INTERVAL 7 DAY))::DATE AS week FROM ev GROUP BY 1),
carts AS (
  SELECT user_id, week, avg(n) AS cart_size FROM (
    SELECT user_id, week, day, count(*) AS n FROM ev WHERE event_type = 'signup' AND EXISTS (
      SELECT 1 FROM ev x WHERE x.user_id = ev.user_id AND x.day = ev.day AND x.event_type = 'purchase')
    GROUP BY 1, 2, 3) GROUP BY 1, 2),
wcounts AS (
  SELECT user_id, week, count(*) FILTER (WHERE event_type = 'view') AS n_browse,
    count(*) FILTER (WHERE event_type = 'click') AS n_search, count(*) FILTER (WHERE event_type = 'purchase') AS n_order
  FROM ev GROUP BY 1, 2),
funnel AS (
  SELECT user_id, week, coalesce(n_browse, 0) AS n_browse, coalesce(n_search, 0) AS n_search,
    coalesce(n_order, 0) AS n_order, coalesce(cart_size, 0) AS cart_size,
    row_number() OVER (PARTITION BY user_id ORDER BY week) AS rn
  FROM weeks LEFT JOIN wcounts USING (user_id, week) LEFT JOIN carts USING (user_id, week))"""


def _funnel_sums(cols) -> str:
    out = []
    for c in cols:
        for k in WEEKS:
            s = f"sum({c}) OVER (PARTITION BY user_id ORDER BY week ROWS {k - 1} PRECEDING)"
            s = f"round({s}, 6)" if c == "cart_size" else f"CAST({s} AS BIGINT)"
            out.append(f"CASE WHEN rn >= {k} THEN {s} END AS {c}_sum_{k}m")
    return ", ".join(out)


def funnel(spark, sf):
    kind = F.col("event_type")
    steps = {"n_browse": kind == "view", "n_search": kind == "click", "n_order": kind == "purchase"}
    out = engage.funnel(
        b.daily_events(spark, sf), "user_id", "week", ["day"], steps, kind == "signup", kind == "purchase", "week", WEEKS
    )
    cart = [f"cart_size_sum_{k}m" for k in WEEKS]
    return out.select(*[F.round(c, 6).alias(c) if c in cart else F.col(c) for c in out.columns])


@query(
    "commerce_funnel",
    cte(EVENTS, _FUNNEL, body="SELECT user_id, week, n_browse, n_search, n_order, cart_size, "
        + _funnel_sums(["n_browse", "n_search", "n_order", "cart_size"]) + " FROM funnel"),
)
def commerce_funnel(spark, sf):
    return funnel(spark, sf)


@query("commerce_lags", cte(EVENTS, _FUNNEL, body=f"SELECT user_id, week, {_funnel_sums(['n_order'])} FROM funnel"))
def commerce_lags(spark, sf):
    return funnel(spark, sf).select("user_id", "week", *[f"n_order_sum_{k}m" for k in WEEKS])
