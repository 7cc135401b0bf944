"""The wide feature table: star join of the panel with its support tables, then one window.

Order of work, chosen for the width of what is shuffled: lookups by month, place, sponsor and
head are joined while the panel is narrow; tables on (entity, period) follow; the rolling,
lagged and delta columns come last, in windows that add columns without moving rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from memberlytics.operators.panel import join_dealt
from memberlytics.operators.rolling import FRAMES, Frames, Rolling, over_entity
from memberlytics.session import unmeasured


@dataclass(frozen=True)
class Current:
    """A current value and, unless ``previous`` is None, the value of the row before.

    ``previous`` is "null" to leave the first row NULL or "zero" to give it 0.
    """

    name: str
    expr: str
    previous: str | None = "null"


def packed(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``keys`` and one struct of all other columns.

    A chain of joins rebuilds its rows at every step.  With the payload of each side in one
    struct a step handles a few fields instead of hundreds, the operators stay inside generated
    code, and shuffles copy the payload as it is.
    """
    return df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(name))


def star_join(df: DataFrame, lookups: Sequence[tuple[str, DataFrame, Sequence[str]]], dealt_by: str | None = None) -> DataFrame:
    """Left joins in the given order, each side packed under its name and unique on its keys.

    A side may carry a mark: broadcast, if its size was measured (``session.broadcast_if_small``), or ``unmeasured``; the planner
    decides on the others.  Rows dealt by one column, ``dealt_by``, stay where they are for lookups by it and others (``join_dealt``).
    """
    for name, side, keys in lookups:
        side = packed(side, list(keys), name)
        df = join_dealt(df, side, dealt_by, keys) if dealt_by in keys else df.join(side, list(keys), "left")
    return df


def by_key(df: DataFrame, name: str, side: DataFrame, on: Sequence[str], key: Sequence[str]) -> tuple[str, DataFrame, Sequence[str]]:
    """The lookup (``name``, ``side``, ``on``) as one by ``key``, whose value decides the columns ``on``.

    Only the keys of ``df`` travel to the side.  All lookups turned this way and those on ``key`` itself are then joined after one
    shuffle of the wide rows, instead of one for each column that something is looked up by.
    """
    keys = df.select(*dict.fromkeys([*key, *on])).distinct()
    found = keys.join(unmeasured(packed(side, on, "_found")), list(on)).select(*key, "_found.*")
    return name, unmeasured(found), key


def unpack(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Structs back to columns."""
    plain = [c for c in df.columns if c not in names]
    return df.select(*plain, *[f"{n}.*" for n in names])


def current_columns(entity, period: str, currents: Sequence[Current]) -> list[Column]:
    w, out = over_entity(entity, period), []
    for c in currents:
        out.append(f"{c.expr} AS {c.name}")
        if c.previous:
            prev = f"lag({c.expr}) {w}"
            out.append(f"{f'coalesce({prev}, 0)' if c.previous == 'zero' else prev} AS {c.name}_previous")
    return [F.expr(e) for e in out]


def wide_features(
    df: DataFrame,
    entity: str,
    period: str,
    passing: Sequence[Column | str],
    currents: Sequence[Current],
    rolls: Sequence[Rolling],
    others: Sequence[Column] = (),
    ks: Sequence[int] = FRAMES,
    tracked: Sequence[str] = (),
    keep: str | None = None,
) -> DataFrame:
    """All feature columns in two selects over one window specification.

    ``keep`` (only with ``rolls``) is a condition on ``_plain``, the struct of ``passing``, ``currents`` and ``others``: all rows count in
    the windows, and those without it are left out before the last columns are made.
    ``tracked`` stems with 3, 6 and 12 row columns get their momentum and the 12-row value of 12 rows before, also for columns
    that are not among ``rolls``.  ``entity`` and ``period`` have to be among ``passing``.
    """
    named = [*passing, *current_columns(entity, period, currents), *others]
    if not rolls:
        return df.select(*named)
    frames = Frames(df, entity, period, rolls, ks)
    families = [f"{frames.value(spec, k)} AS {spec.stem}_{k}m" for spec in rolls for k in ks]
    by_stem = {spec.stem: spec for spec in rolls}
    # The finished columns travel through the second window as one field.
    wide = df.select(entity, period, F.struct(*named).alias("_plain"), *[F.expr(e) for e in frames.first()])
    plain = wide.schema["_plain"].dataType.names
    known = [s for s in tracked if f"{s}_12m" in set(plain)]
    years = [f"{f'_{s}_lyr' if s in known else frames.value(by_stem[s], 12, 12)} AS {s}_12m_lyr" for s in tracked]
    before = [f"lag(_plain.{s}_12m, 12) {over_entity(entity, period)} AS _{s}_lyr" for s in known]
    wide = wide.selectExpr("*", *frames.lags(), *before)
    wide = (wide if keep is None else wide.filter(keep)).selectExpr("_plain.*", *families, *years)
    have = set(plain) | {f"{spec.stem}_{k}m" for spec in rolls for k in ks}
    momenta = [f"try_divide({s}_3m, {s}_6m - {s}_3m) AS {s}_3m_mom" for s in tracked if {f"{s}_3m", f"{s}_6m"} <= have]
    return wide.selectExpr("*", *momenta, *[f"try_divide({s}_12m, {s}_12m_lyr) AS {s}_12m_12m_mom" for s in tracked])


def kept_rows(df: DataFrame, keep: str) -> DataFrame:
    """The rows that ``keep`` holds for, a condition on ``_plain``, the struct of all columns.

    As a struct a thousand columns are one name for the planner, which would else try to infer conditions for each of them.
    """
    return df.select(F.struct("*").alias("_plain")).filter(keep).select("_plain.*")


def filled(names: Mapping[str, str], value=0) -> list[Column]:
    """``source`` -> ``name`` with NULL replaced."""
    return [F.coalesce(F.col(c), F.lit(value)).alias(n) for c, n in names.items()]
