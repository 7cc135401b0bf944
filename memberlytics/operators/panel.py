"""Calendars, dense panels and panel-shaped joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from memberlytics.session import unmeasured

STEP = {"month": "INTERVAL 1 MONTH", "week": "INTERVAL 7 DAY", "day": "INTERVAL 1 DAY"}


def calendar(df: DataFrame, period: str, freq: str = "month", start: str | None = None) -> DataFrame:
    """Every period from ``start`` (or the first in the data) to the last in the data."""
    first = F.lit(start).cast("date") if start else F.min(period)
    bounds = df.agg(first.alias("lo"), F.max(period).alias("hi"))
    return bounds.select(F.explode(F.expr(f"sequence(lo, hi, {STEP[freq]})")).alias(period))


def spans(df: DataFrame, entity: str, period: str, freq: str = "month") -> DataFrame:
    """One row per entity and period from the entity's first to its last period.

    Each entity's calendar is generated from its own two bounds: no cross product with a
    common calendar, and the only shuffle is the partially aggregated min/max.
    """
    bounds = df.groupBy(entity).agg(F.min(period).alias("lo"), F.max(period).alias("hi"))
    return bounds.select(entity, F.explode(F.expr(f"sequence(lo, hi, {STEP[freq]})")).alias(period))


def densify(
    df: DataFrame, entity: str, period: str, freq: str = "month", fill: dict | None = None
) -> DataFrame:
    """Panel with a row for every period between an entity's first and last one.

    A few bytes of an entity's bounds become many rows, and rows that are mostly filled compress to a few bytes.  Partitions merged by
    their bytes would hold far more rows than a sort should, so the dense rows are dealt to the session's full number of partitions,
    by entity last, for the windows to come.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    calendar_rows = spans(df, entity, period, freq).repartition(n, entity, period)
    dense = calendar_rows.join(unmeasured(df), [entity, period], "left")
    return (dense.na.fill(fill) if fill else dense).repartition(n, entity)


def join_dealt(df: DataFrame, side: DataFrame, by: str, keys: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` of rows that are dealt by ``by``, one of them.

    Only ``by`` is an equality that the planner sees; the others are a range of one value, compared where the rows are.  So the wide
    rows are not dealt by all keys and dealt back for the windows by ``by``.  Null keys find nothing, as in any join.
    """
    renamed = side.withColumnsRenamed({c: f"_side_{c}" for c in keys})
    match = F.col(by) == F.col(f"_side_{by}")
    for c in keys:
        if c != by:
            match &= F.col(c).between(F.col(f"_side_{c}"), F.col(f"_side_{c}"))
    return df.join(renamed, match, "left").drop(*[f"_side_{c}" for c in keys])


def shift_join(
    left: DataFrame, right: DataFrame, entity: str, period: str, months: int, outputs: dict[str, str]
) -> DataFrame:
    """Left join of each row with the row of the same entity ``months`` later."""
    future = right.select(
        entity,
        F.add_months(period, -months).alias(period),
        *[F.col(c).alias(name) for c, name in outputs.items()],
    )
    return left.join(future, [entity, period], "left")


def at_offset(entity: str, month_index: str, months: int, value: Column | str) -> Column:
    """Value of the same entity ``months`` later (earlier if negative) by the calendar.

    A RANGE frame of one single month: the same answer as a shifted self join of a panel with
    unique (entity, month), but inside the window that is already sorted by entity.
    """
    w = Window.partitionBy(entity).orderBy(month_index).rangeBetween(months, months)
    return F.max(value).over(w)


def replace_by_join(df: DataFrame, other: DataFrame, on: Sequence[str], column: str) -> DataFrame:
    """``df`` with ``column`` taken from ``other`` (NULL where it has no row)."""
    return df.drop(column).join(other.select(*on, column), list(on), "left")


def merge_parts(
    base: DataFrame, additions: DataFrame, keys: Sequence[str], late: Sequence[DataFrame] = ()
) -> DataFrame:
    """Base rows enriched by an inner join with the additions, then later rows appended by name."""
    out = base.join(additions, list(keys), "inner")
    for part in late:
        out = out.unionByName(part)
    return out
