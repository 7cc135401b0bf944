"""Panel build, projections, predicates, sampling, scalar functions, calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from memberlytics import functions as fn
from memberlytics.operators import panel as pn, rollup, shape
from memberlytics.operators.intervals import interval_lookup
from memberlytics.plans import bindings as b
from memberlytics.plans.catalog import query
from memberlytics.plans.oracle import DENSE, EVENTS, GROUPED, MEMBERS, MONTHLY, PANEL, cte

PANEL_COLS = ("member_id", "month", "orders", "pv", "bv", "rev", "status", "member_type", "tenure", "bonus_pct", "rank")


@query("ds_panel", cte(PANEL, body=f"SELECT {', '.join(PANEL_COLS)} FROM panel"))
def ds_panel(spark, sf):
    return b.panel(spark, sf).select(*PANEL_COLS)


@query(
    "panel_slim",
    cte(PANEL, body="SELECT member_id, month, pv, beauty_pv, web_rev, region, age FROM panel"),
)
def panel_slim(spark, sf):
    return b.panel(spark, sf, by_line=True).select(
        "member_id", "month", "pv", "beauty_pv", "web_rev", "region", "age"
    )


@query(
    "panel_processed",
    cte(PANEL, body="""SELECT p.member_id, p.month, p.pv, a.rank AS award_rank,
      CASE WHEN tenure < 0 THEN 0 WHEN tenure BETWEEN 0 AND 11 THEN 1 WHEN tenure BETWEEN 12 AND 23 THEN 2
           WHEN tenure BETWEEN 24 AND 35 THEN 3 ELSE 4 END AS tenure_year
      FROM panel p LEFT JOIN (SELECT member_id, month, max(rank) AS rank FROM panel WHERE rank >= 330 GROUP BY 1, 2) a
      USING (member_id, month) WHERE region IN ('ASIA', 'EUROPE')"""),
)
def panel_processed(spark, sf):
    p = b.panel(spark, sf)
    awards = p.filter("rank >= 330").groupBy("member_id", "month").agg(F.max("rank").alias("rank"))
    kept = p.filter(F.col("region").isin("ASIA", "EUROPE"))
    joined = pn.replace_by_join(kept, awards, ["member_id", "month"], "rank")
    return joined.select(
        "member_id", "month", "pv", F.col("rank").alias("award_rank"), fn.tenure_year("tenure").alias("tenure_year")
    )


@query(
    "prj_rename_lower",
    "SELECT c_custkey AS member_no, c_name AS member_name, c_acctbal AS balance, c_mktsegment AS location FROM customer",
)
def prj_rename_lower(spark, sf):
    raw = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("MEMBER_NO"), F.col("c_name").alias("Member Name"),
        F.col("c_acctbal").alias("BALANCE"), F.col("c_mktsegment").alias("Location"),
    )
    return shape.rename(shape.lower_names(raw), {"member name": "member_name", "no_such_column": "x"})


@query(
    "prj_drop_by_pattern",
    cte(PANEL, body="SELECT member_id, month, pv, rev FROM panel"),
)
def prj_drop_by_pattern(spark, sf):
    p = b.panel(spark, sf).select(
        "member_id", "month", "pv", "rev", "orders", F.col("stly_pv").alias("pv_lyr"), F.col("stly_rev").alias("rev_lyr")
    )
    return shape.drop_where(p, suffix="_lyr", names=["orders", "absent"])


@query(
    "rank_ladder",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 380 WHEN o_orderpriority = '1-URGENT' THEN 350
         WHEN o_orderstatus = 'F' THEN 330 WHEN o_totalprice >= 100000 THEN 310 END AS score FROM orders""",
)
def rank_ladder(spark, sf):
    o = b.table(spark, sf, "orders").select(
        "o_orderkey",
        fn.flag(F.col("o_totalprice") >= 400000).alias("top_flg"),
        fn.flag(F.col("o_orderpriority") == "1-URGENT").alias("urgent_flg"),
        fn.flag(F.col("o_orderstatus") == "F").alias("filled_flg"),
        fn.flag(F.col("o_totalprice") >= 100000).alias("base_flg"),
    )
    scores = {"top_flg": 380, "urgent_flg": 350, "filled_flg": 330, "base_flg": 310}
    return o.select("o_orderkey", fn.rank_ladder(scores).alias("score"))


@query(
    "tenure_bucket",
    cte(PANEL, body="""SELECT member_id, month, tenure, CASE WHEN tenure BETWEEN 0 AND 11 THEN 1
      WHEN tenure BETWEEN 12 AND 23 THEN 2 WHEN tenure BETWEEN 24 AND 35 THEN 3 ELSE 4 END AS tenure_year FROM panel"""),
)
def tenure_bucket(spark, sf):
    return b.panel(spark, sf).select("member_id", "month", "tenure", fn.tenure_year("tenure").alias("tenure_year"))


BANDS = [(1, 310, 319, 1), (2, 320, 339, 2), (3, 335, 359, 3), (4, 370, 399, 4)]


@query(
    "rank_band_lookup",
    cte(PANEL, body="""SELECT member_id, month, rank, CASE WHEN rank BETWEEN 370 AND 399 THEN 4
      WHEN rank BETWEEN 335 AND 359 THEN 3 WHEN rank BETWEEN 320 AND 339 THEN 2
      WHEN rank BETWEEN 310 AND 319 THEN 1 ELSE rank END AS band FROM panel"""),
)
def rank_band_lookup(spark, sf):
    bands = spark.createDataFrame(BANDS, "pos int, lo int, hi int, rank int")
    p = b.panel(spark, sf).select("member_id", "month", "rank")
    return rollup.range_lookup(p, "rank", bands, "band")


@query(
    "band_join_lookup",
    """SELECT o_orderkey, max_by(p_partkey, pos) AS part FROM (SELECT o_orderkey, (o_totalprice / 10)::BIGINT AS v FROM orders)
       LEFT JOIN (SELECT p_partkey, p_partkey AS pos, (p_partkey * 7919) % 50000 AS lo FROM part) ON v BETWEEN lo AND lo + p_partkey % 97
       GROUP BY o_orderkey, v""",
)
def band_join_lookup(spark, sf):
    """A band per part, many of them overlapping: the last one that holds the order's amount."""
    k = F.col("p_partkey")
    bands = b.table(spark, sf, "part").select(k.alias("part"), k.alias("pos"), (k * 7919 % 50000).alias("lo"))
    bands = bands.withColumn("hi", F.col("lo") + F.col("pos") % 97)
    o = b.table(spark, sf, "orders").select("o_orderkey", F.bround(F.col("o_totalprice") / 10).cast("long").alias("v"))
    return interval_lookup(o, "v", bands, ["part"]).select("o_orderkey", "part")


@query(
    "rank_coalesce",
    cte(PANEL, body="""SELECT member_id, month, CASE WHEN age % 3 = 0 AND rank IS NOT NULL THEN rank + 5
      ELSE coalesce(rank, -1) END AS combined FROM panel"""),
)
def rank_coalesce(spark, sf):
    p = b.panel(spark, sf).select(
        "member_id", "month", F.when(F.col("age") % 3 == 0, F.col("rank") + 5).alias("new_rank"), "rank"
    )
    p = p.na.fill({"new_rank": -1, "rank": -1})
    return p.select("member_id", "month", fn.prefer("new_rank", "rank").alias("combined"))


@query(
    "label_encode",
    cte(PANEL, body="""SELECT member_id, month, CASE WHEN pv >= stly_pv THEN 1 ELSE 0 END AS y_binary,
      CASE WHEN pv > stly_pv THEN 2 WHEN pv = stly_pv THEN 1 ELSE 0 END AS y_multi FROM panel"""),
)
def label_encode(spark, sf):
    from memberlytics.operators.labels import direction

    label = direction(F.col("stly_pv"), F.col("pv"))
    return b.panel(spark, sf).select(
        "member_id", "month", fn.encode_label(label).alias("y_binary"), fn.encode_label(label, "multi").alias("y_multi")
    )


@query(
    "flt_predicates",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderdate >= DATE '1996-01-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
         AND (o_orderstatus = 'F' OR o_totalprice BETWEEN 1000 AND 200000)""",
)
def flt_predicates(spark, sf):
    o = b.table(spark, sf, "orders")
    keep = (
        (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & ((F.col("o_orderstatus") == "F") | F.col("o_totalprice").between(1000, 200000))
    )
    return o.filter(keep).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "flt_config_expr",
    cte(PANEL, body="""SELECT member_id, month, pv FROM panel
      WHERE year(month) = 1996 OR (year(month) = 1997 AND month(month) < 8)"""),
)
def flt_config_expr(spark, sf):
    p = b.panel(spark, sf).select("member_id", "month", "pv", F.year("month").alias("y"), F.month("month").alias("m"))
    return p.filter("y = 1996 or (y = 1997 and m < 8)").select("member_id", "month", "pv")


@query(
    "sample_bernoulli",
    """SELECT 0::BIGINT AS outside, 0::BIGINT AS repeated, true AS share_in_band, count(*) AS n_all FROM orders""",
)
def sample_bernoulli(spark, sf):
    """What holds for any sample of a tenth: rows of the table, none twice, and a share within five standard deviations."""
    o = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    picked = shape.sample_rows(o, 0.1, seed=12345).groupBy("o_orderkey", "o_custkey").agg(F.count(F.lit(1)).alias("times"))
    both = o.withColumn("known", F.lit(1)).join(picked, ["o_orderkey", "o_custkey"], "full")
    sums = both.agg(
        F.sum(fn.flag(F.col("known").isNull())).cast("long").alias("outside"), F.sum(fn.flag(F.col("times") > 1)).cast("long").alias("repeated"),
        F.count("times").alias("n"), F.count("known").alias("n_all"),
    )
    off = F.abs(F.col("n") - 0.1 * F.col("n_all"))
    return sums.select("outside", "repeated", (off <= 5 * F.sqrt(0.09 * F.col("n_all"))).alias("share_in_band"), "n_all")


def _md5_bucket(key: str, n: int, seed: int = 0) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % {n}"


@query("sample_hash", f"SELECT o_orderkey, o_custkey FROM orders WHERE {_md5_bucket('o_custkey', 10)} = 0")
def sample_hash(spark, sf):
    o = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return shape.sample_keys(o, ["o_custkey"], parts=10)


@query(
    "split_group",
    f"""SELECT o_orderkey, o_custkey,
      CASE WHEN {_md5_bucket('o_custkey', 10_000, 1000)} < 8000 THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def split_group(spark, sf):
    o = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    train, test = shape.group_split(o, "o_custkey", [0.8, 0.2], seed=1000)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "split_group_modulo",
    """SELECT CASE WHEN o_custkey % 10 < 8 THEN 'train' ELSE 'test' END AS part, count(*) AS n,
         count(DISTINCT o_custkey) AS members FROM orders GROUP BY 1""",
)
def split_group_modulo(spark, sf):
    per = b.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    part = F.when(F.col("o_custkey") % 10 < 8, "train").otherwise("test").alias("part")
    return per.groupBy(part).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("members"))


@query(
    "str_id_cleanup",
    """SELECT c_custkey, regexp_replace(substr(raw, 4, length(raw) - 5), '^0*', '') AS with_head,
         regexp_replace(substr(raw, 1, length(raw) - 2), '^0*', '') AS without_head,
         CASE WHEN raw LIKE '360%' THEN
           substr(regexp_replace(substr(raw, 4), '^0*', ''), 1, length(regexp_replace(substr(raw, 4), '^0*', '')) - 2)
         ELSE regexp_replace(raw, '^0*', '') END AS prefixed,
         left(raw, 3) AS head, right(raw, 2) AS tail
       FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '360' ELSE '000' END || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0')
             || '01' AS raw FROM customer)""",
)
def str_id_cleanup(spark, sf):
    c = b.table(spark, sf, "customer")
    k = F.col("c_custkey")
    raw = F.concat(
        F.when(k % 2 == 0, "360").otherwise("000"), F.lpad((k + 1).cast("string"), 9, "0"), F.lit("01")
    )
    c = c.select("c_custkey", raw.alias("raw"))
    return c.select(
        "c_custkey",
        fn.clean_id("raw", head=3).alias("with_head"),
        fn.clean_id("raw").alias("without_head"),
        fn.clean_prefixed_id("raw", "360").alias("prefixed"),
        F.left("raw", F.lit(3)).alias("head"),
        F.right("raw", F.lit(2)).alias("tail"),
    )


@query(
    "rank_split",
    cte(PANEL, body="""SELECT member_id, month, CAST(rank AS VARCHAR) AS rank_no,
      CASE WHEN rank >= 340 THEN 'Upper' || CAST(bonus_pct AS VARCHAR) WHEN rank IS NOT NULL THEN 'Lower' END AS rank_desc
      FROM panel"""),
)
def rank_split(spark, sf):
    p = b.panel(spark, sf)
    text = F.concat(
        F.col("rank").cast("string"), F.lit(" - "),
        F.when(F.col("rank") >= 340, F.concat(F.lit("Upper "), F.col("bonus_pct"))).otherwise("Lower"),
    )
    number, name = fn.split_rank(text)
    return p.select("member_id", "month", number.alias("rank_no"), name.alias("rank_desc"))


@query(
    "null_safe_ratio",
    cte(PANEL, body="""SELECT member_id, month, coalesce(last3_pv / nullif(stly_pv, 0), 0) AS r1,
      coalesce(rank / nullif(bonus_pct, 0), 0) AS r2, coalesce(nullif(rank, 310), -1) AS r3 FROM panel"""),
)
def null_safe_ratio(spark, sf):
    return b.panel(spark, sf).select(
        "member_id", "month",
        fn.safe_ratio("last3_pv", "stly_pv").alias("r1"),
        fn.safe_ratio("rank", "bonus_pct").alias("r2"),
        F.coalesce(F.nullif(F.col("rank"), F.lit(310)), F.lit(-1)).alias("r3"),
    )


_CH = {"WEB": "web_pv", "WALK": "walk_pv", "TEL": "tel_pv", "MOB": "mob_pv", "OTHER": "othr_pv"}


@query(
    "top_channel",
    cte(PANEL, body="""SELECT member_id, month,
      CASE WHEN pv <= 0 THEN 0.0::DOUBLE ELSE greatest(web_pv, walk_pv, tel_pv, mob_pv, othr_pv) / pv END AS top_share,
      CASE greatest(web_pv, walk_pv, tel_pv, mob_pv, othr_pv) WHEN 0 THEN 'NONE' WHEN web_pv THEN 'WEB'
        WHEN walk_pv THEN 'WALK' WHEN tel_pv THEN 'TEL' WHEN mob_pv THEN 'MOB' ELSE 'OTHER' END AS top_name FROM panel"""),
)
def top_channel(spark, sf):
    return b.panel(spark, sf).select(
        "member_id", "month", fn.top_share(_CH, "pv").alias("top_share"), fn.top_name(_CH).alias("top_name")
    )


@query(
    "breadth_count",
    cte(PANEL, body="SELECT member_id, month, CAST("
        + " + ".join(f"({ln}_pv > 0)::INTEGER" for ln in b.LINES) + " AS INTEGER) AS n_lines, CAST("
        + " + ".join(f"({ch}_pv > 0)::INTEGER" for ch in b.CHANNELS) + " AS INTEGER) AS n_channels FROM panel"),
)
def breadth_count(spark, sf):
    return b.panel(spark, sf, by_line=True).select(
        "member_id", "month",
        fn.breadth([F.col(f"{ln}_pv") > 0 for ln in b.LINES]).alias("n_lines"),
        fn.breadth([F.col(f"{ch}_pv") > 0 for ch in b.CHANNELS]).alias("n_channels"),
    )


@query(
    "date_features",
    """SELECT o_orderkey, CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m,
         strftime(d, '%Y%m') AS yyyymm, date_trunc('month', d)::DATE AS month_start,
         (date_trunc('month', d) + INTERVAL 15 MONTH)::DATE AS plus15,
         CAST(date_diff('month', DATE '1995-01-01', date_trunc('month', d)::DATE) AS INTEGER) AS months_since,
         CAST(epoch(d::TIMESTAMP) AS BIGINT) AS secs, strptime(strftime(d, '%Y%m') || '01', '%Y%m%d')::DATE AS reparsed
       FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""",
)
def date_features(spark, sf):
    d = F.col("o_orderdate").cast("date")
    yyyymm = F.date_format(d, "yyyyMM")
    start = F.trunc(d, "month")
    return b.table(spark, sf, "orders").select(
        "o_orderkey",
        F.year(d).alias("y"),
        F.month(d).alias("m"),
        yyyymm.alias("yyyymm"),
        start.alias("month_start"),
        F.add_months(start, 15).alias("plus15"),
        F.months_between(start, F.lit("1995-01-01")).cast("int").alias("months_since"),
        (F.unix_date(d).cast("long") * 86400).alias("secs"),
        F.to_date(yyyymm, "yyyyMM").alias("reparsed"),
    )


_FY = "year(month + INTERVAL 4 MONTH)"


@query(
    "performance_year",
    cte(PANEL, body=f"""SELECT DISTINCT month,
      CAST(CASE WHEN {_FY} BETWEEN (SELECT min({_FY}) + 1 FROM panel) AND (SELECT max({_FY}) - 1 FROM panel) THEN {_FY}
        ELSE (SELECT min({_FY}) FROM panel) END AS INTEGER) AS table_year,
      CAST(CASE WHEN month(month) >= 9 THEN year(month) + 1 ELSE year(month) END AS INTEGER) AS fiscal_year FROM panel"""),
)
def performance_year(spark, sf):
    """The table of known years leaves out the first and the last one of the data, so both branches occur."""
    months = b.monthly(spark, sf).select("month").distinct()
    fy = fn.fiscal_year("month")
    span = months.agg(F.struct(F.min(fy).alias("lo"), F.max(fy).alias("hi"))).scalar()
    return months.select(
        "month", fn.fiscal_year_clipped("month", span["lo"] + 1, span["hi"] - 1, span["lo"]).alias("table_year"),
        fy.alias("fiscal_year"),
    )


@query(
    "signup_cohort",
    cte(PANEL, body="""SELECT member_id, month, (month - to_months(tenure))::DATE AS signup_month,
      CAST(year(month - to_months(tenure)) AS INTEGER) AS signup_year,
      CASE WHEN year(month - to_months(tenure)) > 1995 THEN 1 ELSE 0 END AS after_1995,
      CASE WHEN age <= 34 THEN 1 ELSE 0 END AS under_35 FROM panel"""),
)
def signup_cohort(spark, sf):
    p = b.panel(spark, sf).select("member_id", "month", "age", fn.signup_month("month", "tenure").alias("signup_month"))
    return p.select(
        "member_id", "month", "signup_month", F.year("signup_month").alias("signup_year"),
        fn.flag(F.year("signup_month") > 1995).alias("after_1995"), fn.flag(F.col("age") <= 34).alias("under_35"),
    )


@query(
    "calendar_months",
    """SELECT unnest(generate_series(TIMESTAMP '1995-01-01', (SELECT date_trunc('month', max(o_orderdate)) FROM orders),
         INTERVAL 1 MONTH))::DATE AS month""",
)
def calendar_months(spark, sf):
    o = b.table(spark, sf, "orders").select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"))
    return pn.calendar(o, "month", "month", start="1995-01-01")


@query(
    "panel_densify",
    cte(DENSE, body="SELECT member_id, month, orders, pv, rev, tenure, status FROM dense"),
)
def panel_densify(spark, sf):
    return b.dense_panel(spark, sf).select("member_id", "month", "orders", "pv", "rev", "tenure", "status")


@query(
    "dedup_keys",
    """SELECT user_id, day, event_type, event_id, value FROM (
         SELECT user_id, ts::DATE AS day, event_type, event_id, value,
           row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY event_id) AS rn FROM events) WHERE rn = 1""",
)
def dedup_keys(spark, sf):
    e = b.daily_events(spark, sf).select("user_id", "day", "event_id", "event_type", "value")
    return rollup.dedup(e, ["user_id", "day"], ["event_id"])


@query(
    "dq_profile",
    cte(PANEL, body="""SELECT min(month) AS min_month, max(month) AS max_month, min(pv) AS min_pv, max(pv) AS max_pv,
      count(*) AS row_count FROM panel"""),
)
def dq_profile(spark, sf):
    return rollup.profile(b.monthly(spark, sf), ["month", "pv"])


@query(
    "set_union_all",
    """SELECT user_id, day FROM (SELECT user_id, ts::DATE AS day FROM events WHERE event_type = 'view'
       UNION ALL SELECT user_id, ts::DATE FROM events WHERE event_type = 'click'
       UNION ALL SELECT user_id, ts::DATE FROM events WHERE event_type = 'purchase')""",
)
def set_union_all(spark, sf):
    e = b.daily_events(spark, sf)
    parts = [e.filter(F.col("event_type") == t).select("user_id", "day") for t in ("view", "click", "purchase")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "set_union_distinct",
    "SELECT o_custkey AS id FROM orders UNION SELECT user_id FROM events UNION SELECT c_custkey FROM customer",
)
def set_union_distinct(spark, sf):
    ids = [("orders", "o_custkey"), ("events", "user_id"), ("customer", "c_custkey")]
    # Each side is reduced before the union, so the final distinct sees keys, not rows.
    parts = [b.table(spark, sf, t).select(F.col(c).alias("id")).distinct() for t, c in ids]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


@query(
    "set_union_missing_cols",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def set_union_missing_cols(spark, sf):
    c = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    s = b.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return shape.union_aligned([c, s])


@query(
    "topk_by_measure",
    cte(PANEL, body="SELECT member_id, month, rev FROM panel ORDER BY rev DESC, member_id, month LIMIT 100"),
)
def topk_by_measure(spark, sf):
    return b.monthly(spark, sf).select("member_id", "month", "rev").orderBy(F.desc("rev"), "member_id", "month").limit(100)


@query(
    "split_by_cutoff",
    cte(PANEL, body="""SELECT member_id, month, pv, CASE WHEN month < DATE '2000-06-01' THEN 'train' ELSE 'score' END AS part
      FROM panel"""),
)
def split_by_cutoff(spark, sf):
    from memberlytics.operators.labels import split_by_cutoff as split

    train, score = split(b.monthly(spark, sf).select("member_id", "month", "pv"), "month", "2000-06-01")
    return train.withColumn("part", F.lit("train")).unionByName(score.withColumn("part", F.lit("score")))


@query(
    "split_zero_positive",
    cte(PANEL, body="""SELECT member_id, month, recur_pv, CASE WHEN recur_pv = 0 THEN 'zero' ELSE 'positive' END AS part
      FROM panel WHERE recur_pv >= 0"""),
)
def split_zero_positive(spark, sf):
    from memberlytics.operators.labels import split_by_sign

    zero, positive = split_by_sign(b.monthly(spark, sf).select("member_id", "month", "recur_pv"), "recur_pv")
    return zero.withColumn("part", F.lit("zero")).unionByName(positive.withColumn("part", F.lit("positive")))


@query(
    "prep_cast_by_role",
    cte(PANEL, body="""SELECT member_id, CASE WHEN rank IS NULL THEN NULL ELSE CAST(rank AS DOUBLE) END AS n_rank, pv AS n_pv,
      CAST(age AS VARCHAR) AS i_age, region AS i_region FROM panel"""),
)
def prep_cast_by_role(spark, sf):
    p = b.panel(spark, sf).select(
        "member_id",
        F.coalesce(F.col("rank").cast("string"), F.lit("*NA")).alias("n_rank"),
        F.col("pv").alias("n_pv"),
        F.col("age").alias("i_age"),
        F.col("region").alias("i_region"),
    )
    numeric, categorical = shape.roles(p, target="label", keys=["member_id"])
    return shape.cast_roles(p, numeric, categorical)


@query(
    "prep_impute",
    cte(PANEL, body="""SELECT member_id, month, coalesce(rank, 0) AS n_rank, pv AS n_pv,
      coalesce(CASE WHEN rank >= 340 THEN region END, 'unknown_filled') AS i_region FROM panel"""),
)
def prep_impute(spark, sf):
    p = b.panel(spark, sf).select(
        "member_id", "month", F.col("rank").alias("n_rank"), F.col("pv").alias("n_pv"),
        F.when(F.col("rank") >= 340, F.col("region")).alias("i_region"),
    )
    return shape.impute(p, ["n_rank", "n_pv"], ["i_region"])


@query(
    "prep_winsorize",
    cte(PANEL, body="""SELECT member_id, month, least(pv, (SELECT quantile_disc(pv, 0.95) FROM panel)) AS pv,
      least(rev, (SELECT quantile_disc(rev, 0.95) FROM panel)) AS rev,
      least(last3_pv, (SELECT quantile_disc(last3_pv, 0.95) FROM panel)) AS last3_pv FROM panel"""),
)
def prep_winsorize(spark, sf):
    from memberlytics.operators.ranking import winsorize

    p = b.monthly(spark, sf).select("member_id", "month", "pv", "rev", "last3_pv")
    return winsorize(p, ["pv", "rev", "last3_pv"], 0.95)


_CAPPED = ["pv", "rev", "last3_pv"]


@query(
    "approx_quantile_caps",
    cte(PANEL, body=" UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS n, true AS in_band FROM panel" for c in _CAPPED)),
)
def approx_quantile_caps(spark, sf):
    """Caps from sketches of size 200: the share of values up to a cap is within the sketch's rank error of 95 %."""
    from memberlytics.operators.ranking import approx_quantiles

    p = b.monthly(spark, sf).select(*_CAPPED)
    caps = approx_quantiles(p, _CAPPED, 0.95).agg(F.map_from_entries(F.collect_list(F.struct("m", "q")))).scalar()
    per = [F.struct(F.lit(c).alias("name"), F.count(c).alias("n"), F.avg(fn.flag(F.col(c) < F.col("_caps")[c])).alias("below"),
                    F.avg(fn.flag(F.col(c) <= F.col("_caps")[c])).alias("upto")) for c in _CAPPED]
    rows = p.withColumn("_caps", caps).agg(F.array(*per).alias("a")).select(F.explode("a").alias("a")).select("a.*")
    return rows.select("name", "n", ((F.col("below") < 0.95 + 0.0165) & (F.col("upto") > 0.95 - 0.0165)).alias("in_band"))


@query(
    "prep_low_variance",
    """SELECT name, round(v, 4) AS variance, CASE WHEN v <= 0.1 THEN 1 ELSE 0 END AS dropped FROM (
         SELECT 'l_quantity' AS name, var_samp(l_quantity) AS v FROM lineitem
         UNION ALL SELECT 'l_discount', var_samp(l_discount) FROM lineitem
         UNION ALL SELECT 'l_tax', var_samp(l_tax) FROM lineitem
         UNION ALL SELECT 'l_linenumber', var_samp(l_linenumber) FROM lineitem)""",
)
def prep_low_variance(spark, sf):
    cols = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    row = shape.variances(b.table(spark, sf, "lineitem"), cols)
    out = row.select(F.expr(f"stack({len(cols)}, " + ", ".join(f"'{c}', {c}" for c in cols) + ") AS (name, v)"))
    return out.select("name", F.round("v", 4).alias("variance"), fn.flag(F.col("v") <= 0.1).alias("dropped"))
