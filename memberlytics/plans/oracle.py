"""The binding once more as DuckDB SQL: common table expressions for the oracle queries."""

from __future__ import annotations

from memberlytics.plans.bindings import CHANNELS, LINES

_AMOUNTS = ("pv", "bv", "rev")

MEMBERS = """
members AS (
  SELECT c_custkey AS member_id,
    NULLIF(c_custkey - c_custkey % CAST(pow(10, 1 + length(CAST(c_custkey AS VARCHAR)) - length(rtrim(CAST(c_custkey AS VARCHAR), '0'))) AS BIGINT), 0)
      AS sponsor_id,
    CASE WHEN c_mktsegment IN ('BUILDING','AUTOMOBILE','MACHINERY') THEN 'I' ELSE 'C' END AS member_type,
    CASE c_custkey % 7 WHEN 0 THEN 'AGENT' WHEN 1 THEN 'REP' ELSE 'STANDARD' END AS local_type,
    c_mktsegment AS segment, n_name AS province, r_name AS region,
    CAST(18 + c_custkey % 60 AS INTEGER) AS age,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN c_custkey < 10 THEN -1 ELSE c_custkey - c_custkey % 10 END AS sil_head,
    CASE WHEN c_custkey < 100 THEN -1 ELSE c_custkey - c_custkey % 100 END AS gld_head,
    (SELECT CASE WHEN min(x.c_custkey) = 0 THEN -1 ELSE min(x.c_custkey) END FROM customer x
      WHERE x.c_nationkey = c.c_nationkey) AS plat_head,
    CASE WHEN min(c_custkey) OVER (PARTITION BY n_regionkey) = 0 THEN -1
         ELSE min(c_custkey) OVER (PARTITION BY n_regionkey) END AS emd_head,
    CASE WHEN min(c_custkey) OVER (PARTITION BY c_mktsegment) = 0 THEN -1
         ELSE min(c_custkey) OVER (PARTITION BY c_mktsegment) END AS dia_head
  FROM customer c JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _when_sum(cond: str, value: str, name: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN {value} ELSE 0 END) AS DOUBLE) AS {name}"


def _monthly() -> str:
    lines = ",\n".join(_when_sum(f"p_type = '{t}'", m, f"{ln}_{m}") for ln, t in LINES.items() for m in _AMOUNTS)
    channels = ",\n".join(
        _when_sum(f"o_orderpriority = '{p}'", m, f"{ch}_{m}") for ch, p in CHANNELS.items() for m in _AMOUNTS
    )
    line_sums = ",\n".join(f"sum({ln}_{m}) AS {ln}_{m}" for ln in LINES for m in _AMOUNTS)
    return f"""
items AS (
  SELECT l_orderkey, l_quantity AS pv, floor(l_extendedprice * 100 + 0.5) AS bv,
         floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) AS rev, l_discount, l_returnflag, p_type
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
per_order AS (
  SELECT l_orderkey, sum(pv) AS pv, sum(bv) AS bv, sum(rev) AS rev,
    sum(CASE WHEN l_discount >= 0.05 THEN rev ELSE 0 END) AS diff_rev,
    sum(CASE WHEN l_returnflag = 'R' THEN pv ELSE 0 END) AS recur_pv,
    {lines}
  FROM items GROUP BY l_orderkey),
monthly AS (
  SELECT o_custkey AS member_id, date_trunc('month', o_orderdate)::DATE AS month,
    count(*) AS orders, sum(pv) AS pv, sum(bv) AS bv, sum(rev) AS rev, sum(diff_rev) AS diff_rev,
    sum(recur_pv) AS recur_pv,
    CAST(count(*) FILTER (WHERE day(o_orderdate) > day(last_day(o_orderdate)) - 3) AS BIGINT) AS last3_orders,
    coalesce(sum(pv) FILTER (WHERE day(o_orderdate) > day(last_day(o_orderdate)) - 3), 0) AS last3_pv,
    coalesce(sum(rev) FILTER (WHERE day(o_orderdate) > day(last_day(o_orderdate)) - 3), 0) AS last3_rev,
    bool_or(o_orderstatus <> 'P') AS open,
    {channels},
    {line_sums}
  FROM orders JOIN per_order ON o_orderkey = l_orderkey GROUP BY 1, 2)"""


MONTHLY = _monthly()

_BONUS = """CASE WHEN rev >= 40000000 THEN 21 WHEN rev >= 30000000 THEN 18 WHEN rev >= 20000000 THEN 15
     WHEN rev >= 15000000 THEN 12 WHEN rev >= 10000000 THEN 9 WHEN rev >= 5000000 THEN 6
     WHEN rev > 0 THEN 3 ELSE 0 END"""

PANEL = f"""{MEMBERS},{MONTHLY},
dated AS (
  SELECT *, CAST(year(month) * 12 + month(month) AS INTEGER) AS month_idx, {_BONUS} AS bonus_pct FROM monthly),
timed AS (
  SELECT *,
    CAST(date_diff('month', min(month) OVER (PARTITION BY member_id), month) AS INTEGER) AS tenure,
    coalesce(sum(pv) OVER ly, 0) AS stly_pv, coalesce(sum(rev) OVER ly, 0) AS stly_rev
  FROM dated
  WINDOW ly AS (PARTITION BY member_id ORDER BY month_idx RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING)),
panel AS (
  SELECT t.*, m.* EXCLUDE (member_id),
    CASE WHEN open THEN 'ACTIVE' ELSE 'INACTIVE' END AS status,
    CASE WHEN rev >= 5000000 THEN 'Y' ELSE 'N' END AS bonus_flag,
    floor(rev * bonus_pct / 100) AS bonus_gross,
    floor(diff_rev * bonus_pct / 100) AS bonus_diff,
    floor(rev * bonus_pct / 100) - floor(diff_rev * bonus_pct / 100) AS bonus_pers,
    CASE WHEN member_type = 'I' THEN CASE bonus_pct WHEN 3 THEN 310 WHEN 6 THEN 320 WHEN 9 THEN 330
      WHEN 12 THEN 340 WHEN 15 THEN 350 WHEN 18 THEN 370 WHEN 21 THEN 380 END END AS rank,
    CASE WHEN pv >= 60 THEN 'Y' ELSE 'N' END AS q_flag,
    CASE WHEN pv BETWEEN 60 AND 99 THEN 'Y' ELSE 'N' END AS q1_flag,
    CASE WHEN pv >= 100 THEN 'Y' ELSE 'N' END AS q2_flag,
    CASE WHEN pv >= 150 THEN 'Y' ELSE 'N' END AS qv_flag,
    CASE WHEN orders >= 2 THEN 'Y' ELSE 'N' END AS engage_flag,
    CASE WHEN recur_pv > 0 THEN 'Y' ELSE 'N' END AS recur_flag,
    CASE WHEN tenure % 12 = 11 THEN 'Y' ELSE 'N' END AS renew_flag
  FROM timed t JOIN members m USING (member_id))"""

GROUPED = f"""{PANEL},
below AS (
  SELECT sponsor_id AS member_id, month, sum(pv) AS dl_pv, sum(bv) AS dl_bv,
    count(*) FILTER (WHERE member_type = 'I') AS fs, count(*) FILTER (WHERE member_type = 'C') AS fc,
    count(*) FILTER (WHERE pv >= 60) AS ql
  FROM panel WHERE sponsor_id IS NOT NULL GROUP BY 1, 2),
grouped AS (
  SELECT p.*, pv + coalesce(dl_pv, 0) AS group_pv, bv + coalesce(dl_bv, 0) AS group_bv,
    coalesce(dl_pv, 0) AS downline_pv, coalesce(fs, 0) AS front_sellers, coalesce(fc, 0) AS front_customers,
    coalesce(ql, 0) AS qual_legs, CASE WHEN coalesce(fs, 0) > 0 THEN 'Y' ELSE 'N' END AS sponsor_flag
  FROM panel p LEFT JOIN below USING (member_id, month))"""

REPEAT = f"""{GROUPED},
repeats AS (
  SELECT member_id, month,
    CASE WHEN sum(CASE WHEN orders > 0 AND status = 'ACTIVE' THEN 1 ELSE 0 END)
      OVER (PARTITION BY member_id ORDER BY month ROWS 2 PRECEDING) >= 2 THEN 1 ELSE 0 END AS is_repeat
  FROM grouped WHERE member_type = 'C')"""

DENSE_ONLY = f"""
bounds AS (SELECT member_id, min(month) AS lo, max(month) AS hi FROM monthly GROUP BY 1),
cal AS (SELECT member_id, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month FROM bounds),
dense AS (
  SELECT c.member_id, c.month, coalesce(orders, 0) AS orders, coalesce(pv, 0) AS pv, coalesce(rev, 0) AS rev,
    CASE WHEN coalesce(rev, 0) >= 5000000 THEN {_BONUS} ELSE 0 END AS bonus_pct,
    CAST(date_diff('month', min(c.month) OVER (PARTITION BY c.member_id), c.month) AS INTEGER) AS tenure,
    CASE WHEN open THEN 'ACTIVE' ELSE 'INACTIVE' END AS status, member_type, province, segment
  FROM cal c LEFT JOIN monthly m ON m.member_id = c.member_id AND m.month = c.month
  JOIN members x ON x.member_id = c.member_id)"""

DENSE = f"{MEMBERS},{MONTHLY},{DENSE_ONLY}"

INCOME = """
income AS (
  SELECT province, y AS year, floor(s * (y - 1895) / n) AS income FROM (
    SELECT n_name AS province, sum(floor(c_acctbal * 100 + 0.5)) AS s, count(*) AS n
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), (SELECT unnest(range(lo, hi + 1)) AS y FROM (SELECT year(min(o_orderdate)) AS lo, year(max(o_orderdate)) AS hi FROM orders)))"""

CAMPAIGNS = """
prices AS (
  SELECT CASE p_type WHEN 'SMALL' THEN 'beauty' WHEN 'MEDIUM' THEN 'durables' WHEN 'ECONOMY' THEN 'homecare'
    WHEN 'PROMO' THEN 'nutrition' WHEN 'LARGE' THEN 'perscare' WHEN 'STANDARD' THEN 'other' END AS line,
    floor(avg(p_retailprice) * 5000) AS unit_price FROM part GROUP BY 1
  UNION ALL SELECT 'all', floor(avg(p_retailprice) * 5000) FROM part),
campaigns AS (
  SELECT make_date(CAST(y AS INTEGER), m, 1) AS month, line, unit_price
  FROM prices, (SELECT unnest(range(lo, hi + 1)) AS y FROM (SELECT year(min(o_orderdate)) AS lo, year(max(o_orderdate)) AS hi FROM orders)), (VALUES (3), (6), (11)) AS v(m))"""

EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type, value, ts::DATE AS day, date_trunc('week', ts)::DATE AS week FROM events)"""

MONTH_EVENTS = """
mev AS (
  SELECT event_id, user_id AS member_id, event_type,
    (DATE '1995-01-01' + to_months(CAST(event_id % 80 AS INTEGER)))::DATE AS month FROM events)"""


def cte(*parts: str, body: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body
