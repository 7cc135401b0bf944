"""Aggregates over the panel: group heads, sponsors, averages, first events, campaigns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from memberlytics.functions import flag, ladder_position, safe_ratio
from memberlytics.operators.intervals import interval_lookup
from memberlytics.operators.rolling import FRAMES
from memberlytics.session import stage


def head_rollup(
    df: DataFrame,
    levels: Mapping[str, str],
    member: str,
    period: str,
    sponsor: str,
    measures: Mapping[str, Column],
    front: Sequence[str],
    keep: Column,
    ratio: tuple[str, Column, Column] | None = None,
) -> DataFrame:
    """Sums per (level, head, period) over a head's group, and ``front`` over its own recruits.

    ``levels`` maps a level name to the column that holds the member's head on that level.  A row
    is repeated once per level, so all levels come from one scan and one pair of aggregates.
    ``keep`` selects the rows that count.  Members who are their own head define the heads.

    Measures are summed per (level, head, period, sponsor) first.  The join that marks the front
    line then sees one row per such combination and matches on the pair (head, sponsor): a head
    that owns a third of the panel is neither a hot join key nor a hot aggregation key.
    """
    def repeated(rows: DataFrame, *cols) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(n).alias("level"), F.col(c).alias("head")) for n, c in levels.items()])
        return rows.select(*cols, F.explode(pairs).alias("_p")).select("*", "_p.level", "_p.head").drop("_p")

    values = {**measures, **({"_num": ratio[1], "_den": ratio[2]} if ratio else {})}
    rows = repeated(
        df.filter(keep), period, F.col(sponsor).alias("head_key"), *[c.alias(n) for n, c in values.items()]
    )
    per_sponsor = rows.groupBy("level", "head", period, "head_key").agg(*[F.sum(n).alias(n) for n in values])
    heads = repeated(df, F.col(member).alias("head_key")).filter(F.col("head_key") == F.col("head")).distinct()
    heads = heads.withColumn("is_front", F.lit(1))
    marked = per_sponsor.join(heads, ["level", "head", "head_key"], "left")
    out = [F.sum(name).alias(name) for name in measures]
    if ratio:
        out.append(safe_ratio(F.sum("_num"), F.sum("_den")).alias(ratio[0]))
    own = F.col("is_front") == 1
    out += [F.coalesce(F.sum(F.when(own, F.col(name))), F.lit(0)).alias(f"front_{name}") for name in front]
    return marked.groupBy("level", "head", period).agg(*out)


def head_trend(
    rollup: DataFrame, period: str, cols: Sequence[str], ks: Sequence[int] = FRAMES, absent: Sequence[int] = (-1,)
) -> DataFrame:
    """Rolling averages per head, and whether the head exists.  A head has one row per period."""
    w = Window.partitionBy("level", "head").orderBy(period)
    return rollup.select(
        "*",
        flag(~F.col("head").isin(*absent)).alias("head_exists"),
        *[F.avg(c).over(w.rowsBetween(-(k - 1), 0)).alias(f"{c}_avg_{k}m") for c in cols for k in ks],
    )


def downline_rollup(df: DataFrame, sponsor: str, period: str, measures: Mapping[str, Column]) -> DataFrame:
    """Aggregates of the direct recruits per (sponsor, period); measures are aggregate columns."""
    return df.groupBy(sponsor, period).agg(*[c.alias(name) for name, c in measures.items()])


def averages(
    df: DataFrame, by: Sequence[str], measures: Mapping[str, str], name=lambda measure: f"avg_{measure}"
) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(c).alias(name(m)) for m, c in measures.items()])


def first_periods(df: DataFrame, entity: str, period: str, preds: Mapping[str, Column]) -> DataFrame:
    """First period per entity in which each predicate holds: one aggregate for all of them."""
    return df.groupBy(entity).agg(*[F.min(F.when(p, F.col(period))).alias(n) for n, p in preds.items()])


def first_indicators(df: DataFrame, entity: str, period: str, preds: Mapping[str, Column]) -> DataFrame:
    """One row per (entity, period) in which some predicate holds for the first time, 0/1 flags.

    The input is aggregated once (partial aggregation before the shuffle).  What follows works on
    one row per entity, whose few first dates become rows again without a further shuffle.
    """
    names = list(preds)
    firsts = first_periods(df, entity, period, preds)
    dates = F.array_compact(F.array_distinct(F.array(*[F.col(n) for n in names])))
    rows = firsts.select("*", F.explode(dates).alias(period))
    return rows.select(entity, period, *[flag(F.col(n) == F.col(period)).alias(n) for n in names])


def first_flag_columns(entity: str, period: str, preds: Mapping[str, Column]) -> list[Column]:
    """The same flags as columns of the panel, inside the window by entity."""
    w = Window.partitionBy(entity)
    return [
        flag(F.min(F.when(p, F.col(period))).over(w) == F.col(period)).alias(name) for name, p in preds.items()
    ]


def full_outer_chain(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of several relations on the same keys, keys coalesced after each step."""
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, list(keys), "full")
    return out


def repeat_flag(entity: str, period: str, cond: Column, window: int = 3, at_least: int = 2) -> tuple[Column, Column]:
    """Count of qualifying rows among the last ``window`` ones, and whether it reaches the limit."""
    w = Window.partitionBy(entity).orderBy(period).rowsBetween(-(window - 1), 0)
    count = F.sum(flag(cond)).over(w)
    return count, flag(count >= at_least)


def campaigns_by_period(campaigns: DataFrame, period: str) -> DataFrame:
    """One row per period with its campaigns as an array of (line, unit price)."""
    return campaigns.groupBy(period).agg(F.sort_array(F.collect_list(F.struct("line", "unit_price"))).alias("offers"))


def promo_columns(lines: Mapping[str, str], count: str = "n_{}_promo", multiple: str = "{}_multiple") -> list[Column]:
    """Per line, from the ``offers`` of the row's period: campaigns reached and the mean multiple.

    A multiple is revenue / unit price where the price was reached and 0 for every other offer.
    """
    out = []
    for line, revenue in lines.items():
        rev = F.col(revenue)
        hits = F.filter("offers", lambda o: (o["line"] == line) & (rev >= o["unit_price"]))  # noqa: B023
        total = F.aggregate(hits, F.lit(0.0), lambda acc, o: acc + rev / o["unit_price"])  # noqa: B023
        offered = F.size("offers")
        out += [
            F.when(F.col("offers").isNull(), 0).otherwise(F.size(hits)).cast("long").alias(count.format(line)),
            F.when(offered > 0, total / offered).otherwise(0.0).alias(multiple.format(line)),
        ]
    return out


def promo_response(df: DataFrame, keys: Sequence[str], period: str, campaigns: DataFrame, lines: Mapping[str, str]) -> DataFrame:
    """Campaign response per row of the panel.

    The campaign calendar has one short list per period, so each panel row is compared with its
    own list in place: no fan-out of the panel and no aggregation back to the member.
    """
    joined = df.join(campaigns_by_period(campaigns, period), period, "left")
    return joined.select(*keys, *promo_columns(lines))


def yearly_rank(entity: str, fiscal: str, rank: str) -> Column:
    """Best rank of the fiscal year: a window over the rows of one entity and year (at most 12)."""
    return F.max(rank).over(Window.partitionBy(entity, fiscal))


def monthly_yearly_rank(
    df: DataFrame, entity: str, fiscal: str, rank: str, names: DataFrame, key: str = "rank", text: str = "rank_name"
) -> DataFrame:
    """Monthly rank, best rank of the fiscal year, and the names of both.

    Nothing is aggregated and joined back.  ``names`` maps rank scores to text.
    """
    out = df.select("*", yearly_rank(entity, fiscal, rank).alias("yearly_rank"))
    for source, target in ((rank, "monthly_name"), ("yearly_rank", "yearly_name")):
        lookup = names.select(F.col(key).alias("_k"), F.col(text).alias(target))
        out = out.join(lookup, F.col(source) == F.col("_k"), "left").drop("_k")
    return out


def awards_from_flags(
    df: DataFrame, entity: str, period: str, fiscal: Column, levels: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """``entity``, ``period``, ``fy``, ``keep`` and the monthly and yearly award: score and name of each.

    ``levels`` (pos, flag, score, name) is the ladder, highest first, with a row for each flag column of ``df``.  The first flag set
    gives the month's place on the ladder, a lookup in one array; the best place of the entity's fiscal year is a minimum
    over its rows.  No flag gives no award.  Everything is one pass and one shuffle by entity.
    """
    ladder = [r for r in levels.orderBy("pos").collect() if r["flag"] in df.columns]  # at most a row a column
    place = F.nullif(ladder_position([r["flag"] for r in ladder]), F.lit(0))
    rows = df.select(entity, period, fiscal.alias("fy"), *keep, place.alias("_m"))
    rows = rows.withColumn("_y", F.min("_m").over(Window.partitionBy(entity, "fy")))

    def at(c: str, place: str) -> Column:
        return F.get(F.array(*[F.lit(r[c]) for r in ladder]), F.col(place) - 1)

    named = [at(c, p).alias(f"{n}_{c}") for n, p in (("monthly", "_m"), ("yearly", "_y")) for c in ("score", "name")]
    return rows.select(entity, period, "fy", *keep, *named)


def range_lookup(df: DataFrame, col: str, bands: DataFrame, out: str, by_list: int = 1000) -> DataFrame:
    """Rank of the band [lo, hi] holding ``col``; the later band wins, no band keeps the value.

    Up to ``by_list`` ``bands`` (lo, hi, rank, in order of ``pos``) become one list that is compared in place; more of them
    are joined by ``intervals.interval_lookup``, for whole numbers.
    """
    v = F.col(col)
    bands = stage(bands, "bands")
    if bands.limit(by_list + 1).count() > by_list:
        found = interval_lookup(df, col, bands, ["rank"])
        return found.withColumn(out, F.coalesce("rank", v)).drop("rank")
    ordered = F.sort_array(F.collect_list(F.struct("pos", "lo", "hi", "rank")), False)
    # The list is one value of the whole query, read before the panel is scanned.
    rows = df.withColumn("_bands", bands.agg(ordered).scalar())
    inside = F.filter("_bands", lambda b: v.between(b["lo"], b["hi"]))
    return rows.withColumn(out, F.coalesce(F.get(inside, F.lit(0))["rank"], v)).drop("_bands")


def latest_rows(df: DataFrame, entity, period: str) -> DataFrame:
    """Rows of each entity's last period; ties are kept."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    last = F.max(period).over(Window.partitionBy(*keys))
    return df.select("*", last.alias("_last")).filter(F.col(period) == F.col("_last")).drop("_last")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order``.

    A minimum over structs instead of row_number, so copies of a hot key are reduced before the
    shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minimum, maximum and row count for data-quality checks: one pass, one row."""
    return df.agg(
        *[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))],
        F.count(F.lit(1)).alias("row_count"),
    )
