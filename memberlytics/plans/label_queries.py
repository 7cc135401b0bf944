"""Labels, training tables and the cohort report."""

from __future__ import annotations

from pyspark.sql import functions as F

from memberlytics import functions as fn
from memberlytics.operators import labels as lb, rollup, shape
from memberlytics.plans import bindings as b, families as fam, feature_queries as fq
from memberlytics.plans.catalog import query
from memberlytics.plans.oracle import DENSE, DENSE_ONLY, PANEL, cte
from memberlytics.plans.panel_queries import BANDS
from memberlytics.plans.window_queries import KEY
from memberlytics.session import broadcast_if_small, stage


def _active():
    return F.col("status") == "ACTIVE"


@query(
    "retention_flags",
    cte(DENSE, body="""SELECT d.member_id, d.month, CASE WHEN a.member_id IS NULL THEN 0 ELSE 1 END AS year1_renewed,
      CASE WHEN c.member_id IS NULL THEN 0 ELSE 1 END AS year2_renewed FROM dense d
      LEFT JOIN (SELECT DISTINCT member_id FROM dense WHERE status = 'ACTIVE' AND tenure = 14) a ON a.member_id = d.member_id
      LEFT JOIN (SELECT DISTINCT member_id FROM dense WHERE status = 'ACTIVE' AND tenure = 26) c ON c.member_id = d.member_id"""),
)
def retention_flags(spark, sf):
    d = b.dense_panel(spark, sf).select(*KEY, "tenure", "status")
    out = lb.retention_flags(d, "member_id", "tenure", _active(), {"year1_renewed": 14, "year2_renewed": 26})
    return out.drop("tenure", "status")


RENEWAL_SQL = """
renewal AS (
  SELECT s.member_id, s.month AS signup_month, CAST(year(s.month) AS INTEGER) AS signup_year, s.member_type AS signup_type,
    f.member_type AS focus_type, l.member_type AS year1_type, CASE WHEN s.month <= DATE '1998-02-01' THEN 1 ELSE 0 END AS full_history,
    CASE WHEN EXISTS (SELECT 1 FROM dense r WHERE r.member_id = s.member_id AND r.tenure = 14 AND r.status = 'ACTIVE')
      THEN 1 ELSE 0 END AS renewal_flag
  FROM dense s JOIN dense f ON f.member_id = s.member_id AND f.tenure = 2 AND f.member_type = 'I'
  LEFT JOIN dense l ON l.member_id = s.member_id AND l.tenure = 11 WHERE s.tenure = 0)"""


def renewal(d):
    return lb.retention_label(d, "member_id", "month", "tenure", "member_type", _active(), history_until="1998-02-01")


@query("renewal_label", cte(DENSE, RENEWAL_SQL, body="SELECT * FROM renewal"))
def renewal_label(spark, sf):
    return renewal(b.dense_panel(spark, sf))


def _migration_sql(k: int) -> str:
    later = f"OVER (PARTITION BY member_id ORDER BY mi RANGE BETWEEN {k} FOLLOWING AND {k} FOLLOWING)"
    return f"""
win AS MATERIALIZED (SELECT member_id, month, tenure, year(month) * 12 + month(month) AS mi,
  tenure - lag(tenure, {k - 1}) OVER (PARTITION BY member_id ORDER BY month) AS span,
  max(bonus_pct) OVER (PARTITION BY member_id ORDER BY month ROWS {k - 1} PRECEDING) AS mx FROM dense WHERE member_type = 'I'),
both_ AS (SELECT *, max(mx) {later} AS future, max(span) {later} AS future_span FROM win),
outcome AS MATERIALIZED (
  SELECT member_id, month, tenure, coalesce(mx, 0) AS max_{k}m, coalesce(future, 0) AS future_max_{k}m,
    CASE WHEN coalesce(future, 0) > coalesce(mx, 0) THEN 'UP' WHEN coalesce(future, 0) = coalesce(mx, 0) THEN 'SAME' ELSE 'DOWN' END
      AS label_{k}m, (month - INTERVAL {k} MONTH)::DATE AS back_{k}m
  FROM both_ WHERE span = {k - 1} AND future_span = {k - 1})"""


def migration(d, k):
    return lb.migration_label(d.filter(F.col("member_type") == "I"), "member_id", "month", "tenure", "bonus_pct", k)


def _register_migration(k: int) -> None:
    @query(f"migration_label_{k}m", cte(DENSE, _migration_sql(k), body="SELECT * FROM outcome"))
    def run(spark, sf):
        return migration(b.dense_panel(spark, sf), k)


for _k in (3, 6):
    _register_migration(_k)


def migration_rows(spark, sf, k: int, keep: str = "true"):
    """The wide table of active sellers with the label over k months, which is joined while the rows are packed."""
    labels = migration(b.dense_panel(spark, sf), k).hint("merge")
    attach = lambda rows: lb.migration_train(rows, labels, list(KEY), k)
    return fq.selling_features(spark, sf, keep, attach, [f"max_{k}m", f"future_max_{k}m", f"label_{k}m"])


def _register_migration_train(name: str, k: int) -> None:
    @query(
        name,
        cte(*fq.FEATURE_PARTS, DENSE_ONLY, _migration_sql(k), body=f"""SELECT f.*, coalesce(max_{k}m, 0) AS max_{k}m, future_max_{k}m,
          coalesce(label_{k}m, 'SAME') AS label_{k}m, CASE WHEN coalesce(max_{k}m, 0) = 0 THEN 'zero' ELSE 'positive' END AS part
          FROM features f LEFT JOIN outcome o ON o.member_id = f.member_id AND o.month = f.month
          WHERE f.i_status = 'ACTIVE' AND f.i_member_type = 'I'"""),
    )
    def run(spark, sf):
        # Both parts in one pass: as two filters they would need the wide rows written, and read again twice.
        both = migration_rows(spark, sf, k, f"_plain.max_{k}m >= 0")
        return fq.comparable(both.withColumn("part", lb.part_by_sign(f"max_{k}m")))


for _n, _k in (("migration_train", 3), ("migration_train_6m", 6)):
    _register_migration_train(_n, _k)


_PREFERRED = """CASE WHEN best BETWEEN 370 AND 399 THEN 4 WHEN best BETWEEN 335 AND 359 THEN 3 WHEN best BETWEEN 320 AND 339 THEN 2
  WHEN best BETWEEN 310 AND 319 THEN 1 ELSE best END"""


def ranked_months(spark, sf):
    """Months with the band of the preferred rank: the global rank of the fiscal year, else the year's own best one."""
    p = b.panel(spark, sf).select(*KEY, "rank", fn.fiscal_year("month").alias("fy"))
    p = p.withColumn("yearly", rollup.yearly_rank("member_id", "fy", "rank"))
    p = p.join(fq.global_rank(p).select("member_id", "fy", F.col("global_rank_no").cast("int").alias("global_no")), ["member_id", "fy"], "left")
    bands = spark.createDataFrame(BANDS, "pos int, lo int, hi int, rank int")
    preferred = p.select(*KEY, F.coalesce("global_no", "yearly").alias("preferred"))
    return rollup.range_lookup(preferred, "preferred", bands, "band")


def _anchor_sql(a: str, shift: str) -> str:
    return f"""
{a} AS (SELECT member_id, f_yr, month AS latest_{a}, band AS rank_{a} FROM (
  SELECT member_id, month, band, CAST(year(month + INTERVAL ({shift}) MONTH) AS INTEGER) AS f_yr FROM ranked)
  QUALIFY month = max(month) OVER (PARTITION BY member_id, f_yr))"""


def _label_case(a: str) -> str:
    return f"""CASE WHEN next_yr IS NULL OR next_date_{a} = latest_{a} THEN 'INVALID' WHEN next_yr - f_yr > 1 THEN 'DOWN'
      ELSE ['DOWN', 'SAME', 'UP'][2 + sign(next_rank - rank_{a})] END"""


YEARLY_SQL = (
    f"""
ranked AS (SELECT * FROM (SELECT member_id, month, {_PREFERRED} AS band FROM (SELECT member_id, month,
  max(rank) OVER (PARTITION BY member_id, year(month + INTERVAL 4 MONTH)) AS best FROM panel)) WHERE band > 0),"""
    + ",".join(_anchor_sql(a, s) for a, s in (("aug", "4"), ("nov", "1"), ("feb", "-2")))
    + f""",
sides AS (
  SELECT member_id, f_yr, latest_aug, coalesce(latest_nov, latest_aug) AS latest_nov, coalesce(latest_feb, latest_aug) AS latest_feb,
    rank_aug, coalesce(rank_nov, rank_aug) AS rank_nov, coalesce(rank_feb, rank_aug) AS rank_feb
  FROM aug LEFT JOIN nov USING (member_id, f_yr) LEFT JOIN feb USING (member_id, f_yr)),
ahead AS (
  SELECT *, lead(rank_aug) OVER w AS next_rank, lead(f_yr) OVER w AS next_yr,
    lead(latest_aug) OVER w AS next_date_aug, lead(latest_nov) OVER w AS next_date_nov, lead(latest_feb) OVER w AS next_date_feb
  FROM sides WINDOW w AS (PARTITION BY member_id ORDER BY f_yr)),
labelled AS (SELECT *, {_label_case('aug')} AS label_aug, {_label_case('nov')} AS raw_nov, {_label_case('feb')} AS raw_feb FROM ahead),
yearly AS (
  SELECT * EXCLUDE (raw_nov, raw_feb), CASE WHEN raw_nov = 'SAME' AND label_aug = 'UP' THEN 'INVALID' ELSE raw_nov END AS label_nov,
    CASE WHEN raw_feb = 'SAME' AND label_aug = 'UP' THEN 'INVALID' ELSE raw_feb END AS label_feb FROM labelled)"""
)


@query("yearly_label", cte(PANEL, YEARLY_SQL, body="SELECT * FROM yearly"))
def yearly_label(spark, sf):
    return lb.yearly_label(ranked_months(spark, sf), "member_id", "month", "band")


def _register_yearly_train(anchor: str, month: int, shift: str) -> None:
    @query(
        f"yearly_train_{anchor}",
        cte(*fq.FEATURE_PARTS, YEARLY_SQL, body=f"""SELECT f.*, y.f_yr AS rank_year, latest_{anchor}, rank_{anchor},
          label_{anchor} AS migration FROM features f JOIN yearly y ON y.member_id = f.member_id
          AND y.f_yr = year(f.month + INTERVAL ({shift}) MONTH)
          WHERE month(f.month) = {month} AND i_status = 'ACTIVE' AND i_member_type = 'I' AND label_{anchor} <> 'INVALID'"""),
    )
    def run(spark, sf):
        label = lb.yearly_label(ranked_months(spark, sf), "member_id", "month", "band")
        kept = stage(fq.selling_features(spark, sf, f"month(_plain.month) = {lb.ANCHOR_MONTH[anchor]}"), "anchor_rows")
        return fq.comparable(lb.yearly_train(kept, label, "member_id", "month", anchor))


for _a, _m, _s in (("aug", 8, "4"), ("nov", 11, "1"), ("feb", 2, "-2")):
    _register_yearly_train(_a, _m, _s)


# --- renewal training data -------------------------------------------------------------------

TENURES = fq.TENURES


@query("renewal_train_slice", cte(*fq.STAR_PARTS, fq.slices_sql((2,)), body="SELECT * FROM slices"))
def renewal_train_slice(spark, sf):
    return fq.comparable(fq.tenure_slices(spark, sf, (2,)))


@query("renewal_train_union", cte(*fq.STAR_PARTS, fq.slices_sql(TENURES), body="SELECT * FROM slices"))
def renewal_train_union(spark, sf):
    return fq.comparable(fq.tenure_slices(spark, sf, TENURES))


def renewal_rows(spark, sf, part=lambda labels: labels, write: bool = True):
    """Slices of the wide table with their label, sums divided by the tenure, active sellers only; ``part`` chooses among the labels.

    Without ``write`` the slices are not written, for a caller that writes what it makes of them.
    """
    label = part(renewal(b.dense_panel(spark, sf)))
    label = label.select("member_id", F.col("signup_month").alias("first_month"), F.col("signup_year").alias("n_signup_year"), "renewal_flag")
    rows = fq.tenure_slices(spark, sf, TENURES, broadcast_if_small(label, "renewal_label"), fq.SELLING, write).drop("signup_month")
    rows = rows.withColumnRenamed("first_month", "signup_month")
    rows = shape.normalize_by(rows, shape.summed_columns(rows.columns), "n_tenure")
    return rows.withColumn("n_signup_month", F.month("signup_month")).drop("i_status", "i_member_type")


_SUMS = ", ".join(f"{c} / nullif(n_tenure, 0) AS {c}" for c in shape.summed_columns([f"{s.stem}_month_agg" for s in fam.FAMILIES]))
_ROWS_SQL = f"""
rows_ AS (
  SELECT s.* EXCLUDE (signup_month, i_status, i_member_type) REPLACE ({_SUMS}), renewal.signup_month,
    renewal.signup_year AS n_signup_year, renewal_flag, CAST(month(renewal.signup_month) AS INTEGER) AS n_signup_month
  FROM slices s JOIN renewal ON renewal.member_id = s.member_id WHERE i_status = 'ACTIVE' AND i_member_type = 'I')"""
_RENEWAL_PARTS = (*fq.STAR_PARTS, DENSE_ONLY, RENEWAL_SQL, fq.slices_sql(TENURES), _ROWS_SQL)
CUTOFF = "1995-06-01"


@query(
    "renewal_train",
    cte(*_RENEWAL_PARTS,
        body=f"SELECT * EXCLUDE (signup_month) FROM rows_ WHERE signup_month < DATE '{CUTOFF}'"),
)
def renewal_train(spark, sf):
    train = renewal_rows(spark, sf, lambda labels: lb.split_by_cutoff(labels, "signup_month", CUTOFF)[0])
    return fq.comparable(train.drop("signup_month"))


@query(
    "renewal_score_input",
    cte(*_RENEWAL_PARTS,
        body=f"""SELECT * EXCLUDE (signup_month) FROM rows_ WHERE signup_month >= DATE '{CUTOFF}'
          QUALIFY month = max(month) OVER (PARTITION BY member_id)"""),
)
def renewal_score_input(spark, sf):
    score = renewal_rows(spark, sf, lambda labels: lb.split_by_cutoff(labels, "signup_month", CUTOFF)[1])
    return fq.comparable(rollup.latest_rows(score, "member_id", "month").drop("signup_month"))


@query(
    "cohort_summary",
    cte(DENSE, RENEWAL_SQL, body="""SELECT strftime(signup_month, '%Y%m') AS signup_month,
      strftime(signup_month + INTERVAL 15 MONTH, '%Y%m') AS month, count(*) AS num_population,
      CAST(sum(renewal_flag) AS BIGINT) AS num_renew, coalesce(sum(renewal_flag) / count(*), 0) AS renewal_pct
      FROM renewal GROUP BY 1, 2"""),
)
def cohort_summary(spark, sf):
    scored = renewal(b.dense_panel(spark, sf))
    return lb.cohort_summary(scored, "member_id", "signup_month", "renewal_flag")
