"""Rolling, lagged and year-over-year columns of a panel.

All functions share one window specification (entity, ordered by period), so Spark runs them
after one shuffle and one sort, whatever the number of columns.  Frames count rows.  Densify the panel first where they should count calendar periods.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from memberlytics.functions import safe_ratio

FRAMES = (3, 6, 9, 12)  # fixed values
AGGREGATES = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "count": F.count}


@dataclass(frozen=True)
class Rolling:
    """One rolling family: ``{stem}_{k}m`` = agg of ``expr`` over the last k rows.

    ``over`` turns the family into a null-safe ratio: the rolling value of ``expr`` divided by the
    rolling value of ``over``.  ``per`` divides by a column of the current row instead.
    """

    stem: str
    expr: str
    agg: str = "sum"
    over: str | None = None
    per: str | None = None


def by_entity(entity: str | Sequence[str], period: str):
    keys = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*keys).orderBy(period)


def over_entity(entity: str | Sequence[str], period: str, frame: str = "") -> str:
    """The window of ``by_entity`` as SQL text."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    return f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {period} {frame})"


def safe_ratio_sql(a: str, b: str) -> str:
    """``safe_ratio`` for expressions above a window.

    ``nullif`` names its argument twice, so the planner computes that in a projection of its own first: one more copy of every wide row.
    """
    return f"coalesce(try_divide({a}, {b}), 0D)"


class Frames:
    """Rolling values that are not added up again for every row and frame.

    The shortest frame is a block, computed once; a longer one that is a multiple of it joins the block of its newest rows with
    earlier blocks, read by lag.  Works for sums, counts, averages, maxima and minima, and needs no subtraction, so large
    values that have left a frame leave no rounding behind.  ``first`` gives the columns of a first select, ``lags`` those of a
    second one on top of it, and ``column`` expressions over both; all share one window specification, so rows are moved and
    sorted once.  Everything is SQL text: hundreds of families make thousands of expressions, which text names in one call each.
    """

    def __init__(self, df: DataFrame, entity, period: str, specs: Sequence[Rolling], ks: Sequence[int] = FRAMES) -> None:
        self.entity, self.period, self.block = entity, period, min(ks)
        self.direct = [k for k in ks if k % self.block]
        exprs = list(dict.fromkeys(e for spec in specs for e in (spec.expr, spec.over) if e))
        fields = df.selectExpr(*[f"{e} AS c{i}" for i, e in enumerate(exprs)]).schema.fields
        self.some = {e for e, f in zip(exprs, fields) if f.nullable}
        self.names: dict[tuple[str, str], str] = {}
        for spec in specs:
            for expr in filter(None, (spec.expr, spec.over)):
                for part in self._needs(spec.agg, expr):
                    self.names.setdefault(part, f"_roll{len(self.names)}")
            if spec.per:
                self.names.setdefault(("", spec.per), f"_roll{len(self.names)}")
        self.read: dict[str, tuple[str, int]] = {}

    def _needs(self, agg: str, expr: str) -> list[tuple[str, str]]:
        """What a family is made of; all that are never null share one count of rows."""
        count = ("count", expr if expr in self.some else "1")
        return [("sum", expr), count] if agg == "avg" else [count] if agg == "count" else [(agg, expr)]

    def first(self) -> list[str]:
        over = {k: over_entity(self.entity, self.period, f"ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW") for k in (self.block, *self.direct)}
        out = [f"{expr} AS {name}" for (agg, expr), name in self.names.items() if not agg]
        return out + [f"{agg}({expr}) {w} AS {name}_{k}" for (agg, expr), name in self.names.items() if agg for k, w in over.items()]

    def _before(self, name: str, earlier: int) -> str:
        if not earlier:
            return name
        self.read[f"{name}_before{earlier}"] = (name, earlier)
        return f"{name}_before{earlier}"

    def _part(self, agg: str, expr: str, k: int, earlier: int) -> str:
        """The value of the frame of k rows that ends ``earlier`` rows before this one; null before the first row."""
        if agg == "avg":
            return f"try_divide({self._part('sum', expr, k, earlier)}, {self._part('count', expr, k, earlier)})"
        name = self.names[self._needs(agg, expr)[0]]
        if k in self.direct:
            return self._before(f"{name}_{k}", earlier)
        newest, *older = [self._before(f"{name}_{self.block}", earlier + i) for i in range(0, k, self.block)]
        if not older:
            return newest
        if agg in ("max", "min"):
            return f"{'greatest' if agg == 'max' else 'least'}({', '.join([newest, *older])})"
        if agg == "sum" and expr in self.some:
            return reduce(lambda a, b: f"coalesce({a} + {b}, {a}, {b})", older, newest)
        # A block is null only where it has no rows, and then so are those before it.
        return " + ".join([newest, *[f"coalesce({b}, 0)" for b in older]])

    def value(self, spec: Rolling, k: int, earlier: int = 0) -> str:
        """The family's value over k rows, as it was ``earlier`` rows before (only without ``per``)."""
        value = self._part(spec.agg, spec.expr, k, earlier)
        if spec.over is not None:
            return safe_ratio_sql(value, self._part(spec.agg, spec.over, k, earlier))
        return safe_ratio_sql(value, self.names["", spec.per]) if spec.per is not None else value

    def lags(self) -> list[str]:
        """The earlier blocks that the values made so far read."""
        w = over_entity(self.entity, self.period)
        return [f"lag({name}, {k}) {w} AS {alias}" for alias, (name, k) in self.read.items()]


def rolling_over_tenure(df: DataFrame, entity, period: str, tenure: str, specs: Sequence[Rolling]) -> tuple[DataFrame, list[Column]]:
    """Every family over as many rows as the row's own tenure says: the table with running values, and the columns made of them.

    With one row per period and a tenure counted from the first one, those are all rows so far, less the first one if no period is
    missing.  Both are running values, which cost the same however long the history is.  At tenure 0 the columns mean nothing.
    """
    w = by_entity(entity, period)
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    parts = {}
    for spec in specs:
        for expr in filter(None, (spec.expr, spec.over)):
            parts.setdefault((spec.agg, expr), f"_run{len(parts)}")
    running = [F.row_number().over(w).alias("_row")]
    for (agg, expr), name in parts.items():
        running.append(AGGREGATES[agg](F.expr(expr)).over(frame).alias(name))
        running.append(AGGREGATES[agg](F.expr(f"CASE WHEN {tenure} > 0 THEN {expr} END")).over(frame).alias(f"{name}_later"))

    def value(agg: str, expr: str) -> Column:
        name = parts[agg, expr]
        return F.when(F.col("_row") == F.col(tenure) + 1, F.col(f"{name}_later")).otherwise(F.col(name))

    out = []
    for spec in specs:
        v = value(spec.agg, spec.expr)
        if spec.over is not None:
            v = safe_ratio(v, value(spec.agg, spec.over))
        elif spec.per is not None:
            v = safe_ratio(v, F.expr(spec.per))
        out.append(v.alias(f"{spec.stem}_month_agg"))
    return df.select("*", *running), out


def rolling(
    df: DataFrame,
    entity,
    period: str,
    specs: Sequence[Rolling],
    ks: Sequence[int] = FRAMES,
    min_history: bool = False,
) -> DataFrame:
    """Add every family for every frame length.

    With ``min_history`` a value is NULL until the entity has k rows.
    """
    frames = Frames(df, entity, period, specs, ks)
    out = {f"{spec.stem}_{k}m": (k, frames.value(spec, k)) for spec in specs for k in ks}
    if min_history:
        out = {name: (k, f"CASE WHEN _seen >= {k} THEN {v} END") for name, (k, v) in out.items()}
    seen = [f"row_number() {over_entity(entity, period)} AS _seen"] if min_history else []
    blocks = df.selectExpr("*", *frames.first(), *seen).selectExpr("*", *frames.lags())
    return blocks.select(*df.columns, *[F.expr(v).alias(name) for name, (_, v) in out.items()])


def lagged_columns(entity, period: str, exprs: Mapping[str, str | Column], k: int = 1) -> list[Column]:
    w = by_entity(entity, period)
    return [
        F.lag(F.expr(e) if isinstance(e, str) else e, k).over(w).alias(name) for name, e in exprs.items()
    ]


def lagged(df: DataFrame, entity, period: str, exprs: Mapping[str, str | Column], k: int = 1) -> DataFrame:
    """Value k rows earlier, per output name."""
    return df.select("*", *lagged_columns(entity, period, exprs, k))


def delta_columns(entity, period: str, col: str, outputs: Mapping[str, int]) -> list[Column]:
    w = by_entity(entity, period)
    return [(F.col(col) - F.lag(col, k).over(w)).alias(name) for name, k in outputs.items()]


def delta(df: DataFrame, entity, period: str, col: str, outputs: Mapping[str, int]) -> DataFrame:
    """Change of ``col`` against k rows earlier, per output name."""
    return df.select("*", *delta_columns(entity, period, col, outputs))


def momentum_columns(pairs: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Last 3 periods against the 3 before them: s3 / (s6 - s3), NULL where that is 0."""
    return [
        (F.col(s3) / F.nullif(F.col(s6) - F.col(s3), F.lit(0))).alias(name)
        for name, (s3, s6) in pairs.items()
    ]


def momentum(df: DataFrame, stems: Sequence[str]) -> DataFrame:
    """``{stem}_3m_mom`` for stems that have both a 3 and a 6 period column."""
    have = set(df.columns)
    pairs = {
        f"{s}_3m_mom": (f"{s}_3m", f"{s}_6m") for s in stems if f"{s}_3m" in have and f"{s}_6m" in have
    }
    return df.select("*", *momentum_columns(pairs))


def yoy(df: DataFrame, entity, period: str, cols: Sequence[str], k: int = 12) -> DataFrame:
    """``{col}_lyr``: value k rows earlier; ``{col}_12m_mom``: ratio to it (NULL for 0)."""
    w = by_entity(entity, period)
    earlier = {c: F.lag(c, k).over(w) for c in cols}
    return df.select(
        "*",
        *[v.alias(f"{c}_lyr") for c, v in earlier.items()],
        *[(F.col(c) / F.nullif(v, F.lit(0))).alias(f"{c}_12m_mom") for c, v in earlier.items()],
    )


def same_period_last_year(entity, month_index: str, col: str) -> Column:
    """Value of the same entity exactly 12 months earlier by the calendar, 0 if it has no row."""
    w = Window.partitionBy(entity).orderBy(month_index).rangeBetween(-12, -12)
    return F.coalesce(F.sum(col).over(w), F.lit(0.0))
