"""Features from event logs: counts per member and period, dense history, rolling sums, funnel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from memberlytics.operators.panel import densify
from memberlytics.operators.rolling import FRAMES, Rolling, rolling


def event_counts(events: DataFrame, user: str, period: str, kind: str, kinds: Sequence[str], prefix: str = "n_") -> DataFrame:
    """One count column per event type; the list of types is given, so there is no extra job."""
    counts = [F.count(F.when(F.col(kind) == k, 1)).alias(f"{prefix}{k}") for k in kinds]
    return events.groupBy(user, period).agg(*counts)


def engagement(
    events: DataFrame, user: str, period: str, kind: str, kinds: Sequence[str], freq: str = "day", ks: Sequence[int] = FRAMES
) -> DataFrame:
    """Counts per type on one dense panel (0 where nothing happened) and sums over the last k periods.

    Missing history counts as 0, so a plain row frame over the dense panel is enough.
    """
    counts = event_counts(events, user, period, kind, kinds)
    names = [f"n_{k}" for k in kinds]
    dense = densify(counts, user, period, freq, {n: 0 for n in names})
    return rolling(dense, user, period, [Rolling(f"{n}_sum", n) for n in names], ks)


def semi_sessions(events: DataFrame, session: Sequence[str], qualifying: Column) -> DataFrame:
    """Events of the sessions that contain a qualifying event."""
    wanted = events.filter(qualifying).select(*session).distinct()
    return events.join(wanted, list(session), "left_semi")


def cart_size(
    events: DataFrame, user: str, period: str, session: Sequence[str], in_cart: Column, bought: Column, out: str = "cart_size"
) -> DataFrame:
    """Mean number of cart events per (user, period) over the sessions that ended in a purchase.

    Both facts about a session come from one partial aggregate; nothing is joined back, so a
    session with very many events is reduced before the shuffle.
    """
    keys = list(dict.fromkeys([user, period, *session]))
    per_session = events.groupBy(*keys).agg(
        F.count(F.when(in_cart, 1)).alias("items"), F.count(F.when(bought, 1)).alias("bought")
    )
    carts = per_session.filter((F.col("bought") > 0) & (F.col("items") > 0))
    return carts.groupBy(user, period).agg(F.avg("items").alias(out))


def funnel(
    events: DataFrame,
    user: str,
    period: str,
    session: Sequence[str],
    steps: Mapping[str, Column],
    in_cart: Column,
    bought: Column,
    freq: str,
    ks: Sequence[int] = FRAMES,
) -> DataFrame:
    """Counts of the funnel steps and mean cart size on a dense panel, with sums over k periods.

    A sum is NULL until the member has k periods of history.  The session is the finest key: one
    aggregate per session feeds both the counts and the cart size.
    """
    keys = list(dict.fromkeys([user, period, *session]))
    per_session = events.groupBy(*keys).agg(
        *[F.count(F.when(c, 1)).alias(n) for n, c in steps.items()],
        F.count(F.when(in_cart, 1)).alias("_items"),
        F.count(F.when(bought, 1)).alias("_bought"),
    )
    cart = F.when((F.col("_bought") > 0) & (F.col("_items") > 0), F.col("_items"))
    counts = per_session.groupBy(user, period).agg(
        *[F.sum(n).alias(n) for n in steps], F.avg(cart).alias("cart_size")
    )
    names = [*steps, "cart_size"]
    dense = densify(counts, user, period, freq, {**{n: 0 for n in steps}, "cart_size": 0.0})
    return rolling(dense, user, period, [Rolling(f"{n}_sum", n) for n in names], ks, min_history=True)


def login_counts(events: DataFrame, user: str, day: str) -> DataFrame:
    return events.groupBy(user, day).agg(F.count(F.lit(1)).alias("n_logins"))


def session_position(user: str, period: str) -> Column:
    """Number of the row within its member, by period."""
    return F.row_number().over(Window.partitionBy(user).orderBy(period))
