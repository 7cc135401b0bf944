"""Binding of the test tables to the member panel.

Amounts are kept as whole numbers (units for ``pv``, hundredths for ``bv`` and ``rev``) in double
columns, so sums do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from memberlytics.functions import flag, month_index
from memberlytics.operators.panel import join_dealt
from memberlytics.operators.rolling import same_period_last_year
from memberlytics.session import broadcast_if_small, unmeasured

# Fixed values of the binding: business line per part type, sales channel per order priority.
LINES = {
    "beauty": "SMALL",
    "durables": "MEDIUM",
    "homecare": "ECONOMY",
    "nutrition": "PROMO",
    "perscare": "LARGE",
    "other": "STANDARD",
}
CHANNELS = {
    "web": "1-URGENT",
    "walk": "2-HIGH",
    "tel": "3-MEDIUM",
    "mob": "4-NOT SPECIFIED",
    "othr": "5-LOW",
}
HEADS = ("sil", "gld", "plat", "emd", "dia")
SELLER_SEGMENTS = ("BUILDING", "AUTOMOBILE", "MACHINERY")
# Lower revenue bound (in hundredths) of each bonus percentage, and the rank score of each.
BONUS_FROM = {21: 40_000_000, 18: 30_000_000, 15: 20_000_000, 12: 15_000_000, 9: 10_000_000, 6: 5_000_000}
RANK_OF_BONUS = {3: 310, 6: 320, 9: 330, 12: 340, 15: 350, 18: 370, 21: 380}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def whole(x: Column) -> Column:
    """Nearest whole number."""
    return F.floor(x * 100 + 0.5)


def sponsor_of(key: str) -> Column:
    """Parent in a ten-ary tree of member keys: the last non-zero digit becomes 0; the members below 10 have none."""
    digits = F.col(key).cast("string")
    zeros = F.length(digits) - F.length(F.rtrim(digits, F.lit("0")))
    # Ten to the power of the digits that are cut, as a whole number: exact for any length of key.
    power = F.rpad(F.lit("1"), zeros + 2, "0").cast("long")
    return F.nullif(F.col(key) - F.col(key) % power, F.lit(0))


def years(spark: SparkSession, sf: str) -> Column:
    """All years of the orders, from the first to the last, as one array."""
    first_last = table(spark, sf, "orders").agg(F.sequence(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).alias("y"))
    return first_last.scalar()


def members(spark: SparkSession, sf: str) -> DataFrame:
    """One row per member: type, place, demographics, sponsor."""
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = table(spark, sf, "customer")
    k = F.col("c_custkey")
    # A row a country: left to the planner, the customers may be the side it broadcasts.
    joined = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        k.alias("member_id"),
        sponsor_of("c_custkey").alias("sponsor_id"),
        F.when(F.col("c_mktsegment").isin(*SELLER_SEGMENTS), "I").otherwise("C").alias("member_type"),
        F.when(k % 7 == 0, "AGENT").when(k % 7 == 1, "REP").otherwise("STANDARD").alias("local_type"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("province"),
        F.col("r_name").alias("region"),
        (18 + k % 60).cast("int").alias("age"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
        F.coalesce(F.nullif(k - k % 10, F.lit(0)), F.lit(-1)).alias("sil_head"),
        F.coalesce(F.nullif(k - k % 100, F.lit(0)), F.lit(-1)).alias("gld_head"),
    )


def with_far_heads(df: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Heads of the three widest groups: first member key of the province, region and segment.

    The smallest key per (province, segment) is aggregated once; the three minima are windows
    over that short list, which is measured: by its estimate the panel would be dealt by its few keys.
    """
    firsts = members(spark, sf).groupBy("province", "region", "segment").agg(F.min("member_id").alias("first"))
    head = lambda place: F.coalesce(
        F.nullif(F.min("first").over(Window.partitionBy(place)), F.lit(0)), F.lit(-1)
    ).alias(f"{place}_first")
    firsts = firsts.select("province", "segment", head("province"), head("region"), head("segment"))
    names = {"province_first": "plat_head", "region_first": "emd_head", "segment_first": "dia_head"}
    return df.join(broadcast_if_small(firsts.withColumnsRenamed(names), "far_heads"), ["province", "segment"])


def line_items(spark: SparkSession, sf: str, by_line: bool) -> DataFrame:
    """Amounts per order; ``by_line`` adds them per business line (needs the part table)."""
    li = table(spark, sf, "lineitem")
    rev = whole(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    rows = li.select(
        "l_orderkey",
        "l_partkey",
        F.col("l_quantity").alias("pv"),
        whole(F.col("l_extendedprice")).alias("bv"),
        rev.alias("rev"),
        F.when(F.col("l_discount") >= 0.05, rev).otherwise(0).alias("diff_rev"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0).alias("recur_pv"),
    )
    aggs = [F.sum(c).alias(c) for c in ("pv", "bv", "rev", "diff_rev", "recur_pv")]
    if by_line:
        part = broadcast_if_small(table(spark, sf, "part").select("p_partkey", "p_type"), "part")
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        aggs += [
            F.sum(F.when(F.col("p_type") == t, F.col(m)).otherwise(0)).alias(f"{line}_{m}")
            for line, t in LINES.items()
            for m in ("pv", "bv", "rev")
        ]
    return rows.groupBy("l_orderkey").agg(*aggs)


def monthly(spark: SparkSession, sf: str, by_line: bool = False) -> DataFrame:
    """Base rows per (member, month): orders that have line items."""
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("member_id"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
        (F.dayofmonth("o_orderdate") > F.dayofmonth(F.last_day("o_orderdate")) - 3).alias("late"),
        (F.col("o_orderstatus") != "P").alias("open"),
        F.col("o_orderpriority").alias("priority"),
    )
    items = line_items(spark, sf, by_line)
    rows = o.join(unmeasured(items), F.col("o_orderkey") == F.col("l_orderkey"))
    late = lambda c: F.sum(F.when(F.col("late"), c).otherwise(0)).cast("double")
    total = lambda c: F.sum(c).cast("double")
    aggs = [
        F.count(F.lit(1)).alias("orders"),
        total("pv").alias("pv"),
        total("bv").alias("bv"),
        total("rev").alias("rev"),
        total("diff_rev").alias("diff_rev"),
        total("recur_pv").alias("recur_pv"),
        F.sum(flag(F.col("late"))).alias("last3_orders"),
        late(F.col("pv")).alias("last3_pv"),
        late(F.col("rev")).alias("last3_rev"),
        F.max(F.col("open")).alias("open"),
    ]
    aggs += [
        F.sum(F.when(F.col("priority") == p, F.col(m)).otherwise(0)).cast("double").alias(f"{ch}_{m}")
        for ch, p in CHANNELS.items()
        for m in ("pv", "bv", "rev")
    ]
    if by_line:
        aggs += [total(f"{line}_{m}").alias(f"{line}_{m}") for line in LINES for m in ("pv", "bv", "rev")]
    # An order is seldom one of several of its month: dealt by member, the rows need no second shuffle for the windows by member.
    return rows.repartition("member_id").groupBy("member_id", "month").agg(*aggs)


def bonus_pct(rev: str) -> Column:
    out = None
    for pct, lower in BONUS_FROM.items():
        out = F.when(F.col(rev) >= lower, pct) if out is None else out.when(F.col(rev) >= lower, pct)
    return out.when(F.col(rev) > 0, 3).otherwise(0)


def rank_of(pct: str, kind: str) -> Column:
    """Rank score of a seller's bonus percentage; NULL for customers and for 0."""
    out = None
    for p, score in RANK_OF_BONUS.items():
        cond = (F.col(kind) == "I") & (F.col(pct) == p)
        out = F.when(cond, score) if out is None else out.when(cond, score)
    return out


def panel(spark: SparkSession, sf: str, by_line: bool = False) -> DataFrame:
    """The sparse member-month panel with measures, status, rank and member attributes."""
    m = monthly(spark, sf, by_line)
    first = F.min("month").over(Window.partitionBy("member_id"))
    m = m.withColumn("month_idx", month_index("month"))
    m = m.select(
        "*",
        F.months_between("month", first).cast("int").alias("tenure"),
        same_period_last_year("member_id", "month_idx", "pv").alias("stly_pv"),
        same_period_last_year("member_id", "month_idx", "rev").alias("stly_rev"),
        bonus_pct("rev").alias("bonus_pct"),
    )
    p = m.join(unmeasured(members(spark, sf)), "member_id")
    gross = F.floor(F.col("rev") * F.col("bonus_pct") / 100).cast("double")
    diff = F.floor(F.col("diff_rev") * F.col("bonus_pct") / 100).cast("double")
    yn = lambda c: F.when(c, "Y").otherwise("N")
    return p.select(
        "*",
        F.when(F.col("open"), "ACTIVE").otherwise("INACTIVE").alias("status"),
        yn(F.col("rev") >= BONUS_FROM[6]).alias("bonus_flag"),
        gross.alias("bonus_gross"),
        diff.alias("bonus_diff"),
        (gross - diff).alias("bonus_pers"),
        rank_of("bonus_pct", "member_type").alias("rank"),
        yn(F.col("pv") >= 60).alias("q_flag"),
        yn(F.col("pv").between(60, 99)).alias("q1_flag"),
        yn(F.col("pv") >= 100).alias("q2_flag"),
        yn(F.col("pv") >= 150).alias("qv_flag"),
        yn(F.col("orders") >= 2).alias("engage_flag"),
        yn(F.col("recur_pv") > 0).alias("recur_flag"),
        yn(F.col("tenure") % 12 == 11).alias("renew_flag"),
    ).drop("open", "diff_rev")


def with_group(p: DataFrame) -> DataFrame:
    """Add the measures of a member's direct recruits in the same month."""
    below = p.filter(F.col("sponsor_id").isNotNull()).groupBy("sponsor_id", "month").agg(
        F.sum("pv").alias("dl_pv"),
        F.sum("bv").alias("dl_bv"),
        F.count(F.when(F.col("member_type") == "I", 1)).alias("front_sellers"),
        F.count(F.when(F.col("member_type") == "C", 1)).alias("front_customers"),
        F.count(F.when(F.col("pv") >= 60, 1)).alias("qual_legs"),
    )
    joined = join_dealt(p, unmeasured(below.withColumnRenamed("sponsor_id", "member_id")), "member_id", ["member_id", "month"])
    zero = lambda c: F.coalesce(c, F.lit(0))
    return joined.select(
        *p.columns,
        (F.col("pv") + zero("dl_pv")).alias("group_pv"),
        (F.col("bv") + zero("dl_bv")).alias("group_bv"),
        zero("dl_pv").alias("downline_pv"),
        zero("front_sellers").alias("front_sellers"),
        zero("front_customers").alias("front_customers"),
        zero("qual_legs").alias("qual_legs"),
        F.when(F.coalesce("front_sellers", F.lit(0)) > 0, "Y").otherwise("N").alias("sponsor_flag"),
    )


def dense_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly history without gaps; filled months are INACTIVE with zero measures."""
    from memberlytics.operators.panel import densify

    m = monthly(spark, sf).select("member_id", "month", "orders", "pv", "rev", "open")
    m = m.withColumn("bonus_pct", F.when(F.col("rev") >= BONUS_FROM[6], bonus_pct("rev")).otherwise(0))
    d = densify(m, "member_id", "month", "month", {"orders": 0, "pv": 0.0, "rev": 0.0, "open": False, "bonus_pct": 0})
    first = F.min("month").over(Window.partitionBy("member_id"))
    d = d.select(
        "*",
        F.months_between("month", first).cast("int").alias("tenure"),
        F.when(F.col("open"), "ACTIVE").otherwise("INACTIVE").alias("status"),
    ).drop("open")
    return d.join(unmeasured(members(spark, sf).select("member_id", "member_type", "province", "segment")), "member_id")


def province_income(spark: SparkSession, sf: str) -> DataFrame:
    """Income per province and year: mean account balance in hundredths, 1 % more every year."""
    people = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    base = people.groupBy(F.col("n_name").alias("province")).agg(
        F.sum(whole(F.col("c_acctbal"))).alias("s"), F.count(F.lit(1)).alias("n")
    )
    return base.select(
        "province",
        F.explode(years(spark, sf)).alias("year"),
        F.col("s"),
        F.col("n"),
    ).select("province", "year", F.floor(F.col("s") * (F.col("year") - 1895) / F.col("n")).cast("double").alias("income"))


def campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """Campaigns (month, line, unit price): every line and ALL in three months of each year of the orders.

    The price is 50 times the mean retail price of the line's parts.
    """
    price = F.floor(F.avg("p_retailprice") * 5000).cast("double").alias("unit_price")
    part = table(spark, sf, "part")
    names = F.create_map(*[F.lit(x) for line, t in LINES.items() for x in (t, line)])
    lines = part.groupBy(names[F.col("p_type")].alias("line")).agg(price)
    rows = lines.unionByName(part.agg(price).select(F.lit("all").alias("line"), "unit_price"))
    rows = rows.select("line", "unit_price", F.explode(years(spark, sf)).alias("year"))
    months = F.array(*[F.make_date("year", F.lit(m), F.lit(1)) for m in (3, 6, 11)])
    return rows.select(F.explode(months).alias("month"), "line", "unit_price")


def daily_events(spark: SparkSession, sf: str) -> DataFrame:
    """Event log with day and week (Monday) as dates."""
    e = table(spark, sf, "events")
    day = F.col("ts").cast("date")
    return e.select(
        "event_id", "user_id", "event_type", "value", day.alias("day"), F.trunc(day, "week").alias("week")
    )


EVENT_TYPES = ("view", "click", "purchase", "signup", "error")


def monthly_events(spark: SparkSession, sf: str) -> DataFrame:
    """The event log laid over the months of the panel, for joins with it."""
    e = table(spark, sf, "events")
    month = F.add_months(F.lit("1995-01-01").cast("date"), (F.col("event_id") % 80).cast("int"))
    return e.select("event_id", F.col("user_id").alias("member_id"), "event_type", month.alias("month"))
