"""Exact percent ranks and quantiles, and approximate quantiles, that never put one group into one task.

``percent_rank() OVER (PARTITION BY month ...)`` sorts all rows of a month in a single task.  Here equal values are counted
first, before the shuffle.  A group with more than ``BUCKET`` distinct values is cut into buckets of neighbouring values at
the quantiles of a mergeable KLL sketch of its values, so the buckets hold about as many values each, however the values
are spread.  Ranks inside a bucket come from a small window, and the rows of the lower buckets are added from bucket
totals.  The sketch decides on the balance, never on the result, which is exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from memberlytics.session import broadcast_if_small, stage, stage_seen, unmeasured

BUCKET = 1_000_000  # distinct values of a group that one window may sort
PARTS = 256  # at most so many buckets a group
SKETCH = 1024  # size of the sketch: its rank error is about 0.3 %, below the share of a bucket
_FAN = 16


def sketch_cuts(values: DataFrame, group: Sequence[str], value: str, parts: Column, k: int = SKETCH) -> DataFrame:
    """``group`` and ``_cuts``: ascending values that cut each group into about ``parts`` (an aggregate column) equal parts.

    Sketches are built per task and merged, so only sketches are shuffled.  Null and NaN do not count.
    """
    made = values.groupBy(*group).agg(F.kll_sketch_agg_double(value, k).alias("_sketch"), F.least(parts, F.lit(PARTS)).cast("int").alias("_parts"))
    made = made.filter(F.kll_sketch_get_n_double("_sketch") > 0)
    fine = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)])).alias("_fine")
    made = made.filter("_parts > 1").select(*group, "_parts", fine)
    place = lambda i: F.floor(i * PARTS / F.col("_parts")).cast("int") - 1
    cuts = F.transform(F.sequence(F.lit(1), F.col("_parts") - 1), lambda i: F.get("_fine", place(i)))
    return made.select(*group, F.array_sort(F.array_distinct(cuts)).alias("_cuts"))


def cut_bucket(cuts: Column, value: Column) -> Column:
    """How many of the ascending ``cuts`` are below ``value``: 0 without cuts, -1 for null; NaN is above all.

    Equal values share a bucket.  Every 16th cut is compared first, then the 16 cuts behind the last one below.
    """
    count = F.size(cuts)
    tops = F.transform(F.sequence(F.lit(1), F.greatest(F.ceil(count / _FAN), F.lit(1)).cast("int")), lambda i: F.get(cuts, (i - 1) * _FAN))
    top = F.greatest(F.size(F.filter(tops, lambda t: t < value)), F.lit(1))
    below = (top - 1) * _FAN + F.size(F.filter(F.slice(cuts, (top - 1) * _FAN + 1, F.lit(_FAN)), lambda t: t < value))
    return F.when(value.isNull(), -1).when(cuts.isNull(), 0).otherwise(below).cast("int")


def _same(a: str, b: str, cols: Sequence[str]) -> list[Column]:
    return [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in cols]


def _join(rows: DataFrame, side: DataFrame, on: Sequence[str], outputs: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe join that adds ``outputs`` of a side unique on ``on``."""
    joined = rows.alias("_r").join(side.alias("_s"), _same("_r", "_s", on), how)
    return joined.select("_r.*", *[F.col(f"_s.{o}") for o in outputs])


def bucketed(cells: DataFrame, group: Sequence[str], large: DataFrame | None, value: str = "_x") -> tuple[DataFrame, DataFrame | None]:
    """``cells`` with the bucket ``_b`` of their value, and the cuts used.

    ``large`` holds (``group``, ``_cells``) of the groups to be cut; None cuts nothing.
    """
    if large is None:
        return cells.withColumn("_b", F.lit(0)), None
    # Groups that are cut have more than BUCKET cells each, so their list is short; its size is checked all the same.
    large = broadcast_if_small(large.select(*group, "_cells"), "large_groups")
    some = _join(cells, large, group, ["_cells"])
    cuts = broadcast_if_small(sketch_cuts(some, group, value, F.ceil(F.max("_cells") / BUCKET)), "cuts")
    out = _join(cells, cuts, group, ["_cuts"], "left")
    return out.withColumn("_b", cut_bucket(F.col("_cuts"), F.col(value))).drop("_cuts"), cuts


def bucket_offsets(cells: DataFrame, group: Sequence[str], counts: Sequence[str] = ("_n",)) -> DataFrame:
    """Per (``group``, ``_b``) the sums ``_low{count}`` over the lower buckets of the group: a row a bucket."""
    grid = cells.groupBy(*group, "_b").agg(*[F.sum(c).alias(c) for c in counts])
    lower = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return grid.select(*group, "_b", *[F.coalesce(F.sum(c).over(lower), F.lit(0)).alias(f"_low{c}") for c in counts])


def _melt(df: DataFrame, keep: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per input row and measure: ``keep``, number of the measure ``_m`` and value ``_x``."""
    items = F.array(*[F.col(c).cast("double") for c in measures])
    return df.select(*keep, F.posexplode(items).alias("_m", "_x"))


def _totals(cells: DataFrame, group: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """(``group``, ``_total``, ``_cells``) and those of its rows that need cutting, if there are any."""
    totals = cells.groupBy(*group).agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_cells"))
    totals, seen = stage_seen(totals, "totals", most=F.max("_cells"))
    return totals, totals.filter(F.col("_cells") > BUCKET) if (seen["most"] or 0) > BUCKET else None


def percent_ranks(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    scopes: Mapping[str, Sequence[str]],
    name=lambda scope, measure: f"{scope}_{measure}",
) -> DataFrame:
    """``keys`` and one exact percent rank per scope and measure.

    ``scopes`` maps a name to the grouping columns; NULL group values form a group, NULL values rank lowest.  Measures become
    rows, so that any number of them takes the same few shuffles; the scopes are windows one after the other over the counts
    of equal values.
    """
    groups = list(dict.fromkeys(c for cols in scopes.values() for c in cols))
    gs = {c: f"_g{i}" for i, c in enumerate(groups)}
    values = [F.col(c).alias(f"_v{i}") for i, c in enumerate(measures.values())]
    rows = stage(df.select(*keys, *[F.col(c).alias(r) for c, r in gs.items()], *values), "rank_rows")
    long = _melt(rows, [*keys, *gs.values()], [f"_v{i}" for i in range(len(measures))])
    on = ["_m", *gs.values(), "_x"]
    cells = long.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    base, seen = stage_seen(cells, "rank_cells", total=F.sum("_n"), most=F.max("_n"))
    # The sizes of the groups of all scopes in one pass; grouping columns that a scope does not use are NULL.
    used = [{gs[c] for c in cols} for cols in scopes.values()]
    of = F.array(*[F.struct(F.lit(s).alias("_s"), *[(F.col(g) if g in u else F.lit(None)).alias(g) for g in gs.values()]) for s, u in enumerate(used)])
    totals, large = _totals(base.select("_m", "_n", F.explode(of).alias("_o")).select("_m", "_n", "_o.*"), ["_s", "_m", *gs.values()])
    totals = broadcast_if_small(totals, "totals")
    ranked = base
    for s, cols in enumerate(scopes.values()):
        group = ["_m", *[gs[c] for c in cols]]
        ranked = _join(ranked, totals.filter(F.col("_s") == s), group, ["_total"])
        ranked, cuts = bucketed(ranked, group, None if large is None else large.filter(F.col("_s") == s))
        low = F.lit(0)
        if cuts is not None:
            cut = _join(base, cuts, group, ["_cuts"]).withColumn("_b", cut_bucket(F.col("_cuts"), F.col("_x")))
            offsets = broadcast_if_small(bucket_offsets(cut, group), "offsets")
            ranked = _join(ranked, offsets, [*group, "_b"], ["_low_n"], "left")
            low = F.coalesce("_low_n", F.lit(0))
        inside = Window.partitionBy(*group, "_b").orderBy("_x")
        # The running count up to the value, less the count of the value itself, which stands in several cells.
        upto = F.sum("_n").over(inside.rangeBetween(Window.unboundedPreceding, 0))
        equal = F.sum("_n").over(Window.partitionBy(*group, "_b", "_x"))
        below = low + upto - equal
        pr = F.when(F.col("_total") > 1, below / (F.col("_total") - 1)).otherwise(0.0)
        ranked = ranked.select(*on, "_n", *[f"_pr{i}" for i in range(s)], pr.alias(f"_pr{s}"))
    outputs = [f"_pr{s}" for s in range(len(scopes))]
    attached = attach(long, ranked, base, on, keys, outputs, seen)
    picks = [
        F.max(F.when(F.col("_m") == m, F.col(f"_pr{s}"))).alias(name(scope, measure))
        for s, scope in enumerate(scopes)
        for m, measure in enumerate(measures)
    ]
    return attached.groupBy(*keys).agg(*picks)


def attach(
    rows: DataFrame,
    cells: DataFrame,
    base: DataFrame,
    on: Sequence[str],
    keys: Sequence[str],
    outputs: Sequence[str],
    seen: Mapping[str, int],
    share: int = 512,
) -> DataFrame:
    """Join rows to the one cell they belong to, splitting cells that hold many of the rows.

    ``base`` holds ``on`` and the rows ``_n`` of each cell, ``seen`` their total and the most of them.  The rows come from an explode, which
    the planner takes for as small as its input, so neither side is left to it.

    A cell with more than 1/share of all rows is hot.  There are fewer than ``share`` of them, so
    the broadcast list has a fixed bound.  Rows of a hot cell get one of ``share`` salts and its
    single count row is repeated once per salt.
    """
    total = seen["total"] or 0
    if (seen["most"] or 0) * share <= total:
        return _join(rows, unmeasured(cells), on, outputs)
    hot = base.filter(F.col("_n") * share > total).select(*on)
    marked = _join(rows, F.broadcast(hot.withColumn("_hot", F.lit(1))), on, ["_hot"], "left")
    salt = F.when(F.col("_hot") == 1, F.pmod(F.xxhash64(*keys), F.lit(share))).otherwise(0).cast("int")
    copies = F.when(F.col("_n") * share > total, F.sequence(F.lit(0), F.lit(share - 1))).otherwise(F.array(F.lit(0)))
    spread = cells.select(*on, *outputs, F.explode(copies).alias("_salt"))
    return _join(marked.withColumn("_salt", salt), unmeasured(spread), [*on, "_salt"], outputs).select(*rows.columns, *outputs)


def exact_quantiles(df: DataFrame, cols: Sequence[str], q: float) -> DataFrame:
    """One row ``m, q``: for each column the smallest value whose cumulative share reaches ``q``; no row without values.

    Only the bucket in which the share is reached is sorted.
    """
    long = _melt(df, [], cols).filter(F.col("_x").isNotNull())
    cells = stage(long.groupBy("_m", "_x").agg(F.count(F.lit(1)).alias("_n")), "quantile_cells")
    totals, large = _totals(cells, ["_m"])
    rows = _join(cells, F.broadcast(totals), ["_m"], ["_total"]).withColumn("_low_n", F.lit(0))  # a row a column
    if large is not None:
        cut, _ = bucketed(rows.drop("_low_n"), ["_m"], large)
        offsets = _join(bucket_offsets(cut, ["_m"]), totals, ["_m"], ["_total"])
        # The last bucket below which the share is not reached.
        first = offsets.filter(F.col("_low_n") < F.lit(q) * F.col("_total")).groupBy("_m").agg(F.max(F.struct("_b", "_low_n")).alias("_at"))
        rows = cut.join(F.broadcast(first.select("_m", "_at.*")), ["_m", "_b"])
    upto = F.col("_low_n") + F.sum("_n").over(Window.partitionBy("_m").orderBy("_x"))
    found = rows.select("_m", "_x", "_total", upto.alias("_upto")).filter(F.col("_upto") >= F.lit(q) * F.col("_total"))
    return _named(found.groupBy("_m").agg(F.min("_x").alias("q")), cols)


def approx_quantiles(df: DataFrame, cols: Sequence[str], q: float, k: int = 200) -> DataFrame:
    """One row ``m, q`` from one KLL sketch a column: a single pass that shuffles sketches only.

    The share of values up to the result is within about 2.3 / k ** 0.9 of ``q`` (1.65 % at 200), with high probability.
    """
    long = _melt(df, [], cols).filter(F.col("_x").isNotNull())
    found = long.groupBy("_m").agg(F.kll_sketch_agg_double("_x", k).alias("_s"))
    return _named(found.select("_m", F.kll_sketch_get_quantile_double("_s", F.lit(q)).alias("q")), cols)


def _named(found: DataFrame, cols: Sequence[str]) -> DataFrame:
    return found.select(F.get(F.array(*[F.lit(c) for c in cols]), F.col("_m")).alias("m"), "q")


def winsorize(df: DataFrame, cols: Sequence[str], q: float, sketch: int | None = None) -> DataFrame:
    """Cap every column at its quantile ``q``, found for all columns in one pass; ``sketch`` is the size for approximate caps."""
    caps = exact_quantiles(df, cols, q) if sketch is None else approx_quantiles(df, cols, q, sketch)
    # One value: a map with as many entries as there are columns.
    limit = caps.agg(F.map_from_entries(F.collect_list(F.struct("m", "q")))).scalar()
    capped = {c: F.when(F.col(c).isNotNull(), F.least(F.col(c), limit[c])).alias(c) for c in cols}
    return df.select(*[capped.get(c, F.col(c)) for c in df.columns])


def rank_sum_auc(scored: DataFrame, label: str, scores: Mapping[str, Column]) -> DataFrame:
    """(class, positives, negatives, auc): for each class the area under its curve against all others.

    ``scores`` maps a value of ``label`` to the score of that class.  The area is the share of (positive, negative) pairs in
    which the positive scores higher, ties counted half: a sum over distinct scores of their positives times the negatives
    below.  Null labels and scores do not count; a class without positives or without negatives has no area.
    """
    of = F.array(*[F.struct(F.lit(c).alias("class"), s.cast("double").alias("_x")) for c, s in scores.items()])
    # Both zeros are one score.
    long = scored.select(F.col(label).alias("_y"), F.explode(of).alias("_s")).select("_y", "_s.class", (F.col("_s._x") + 0.0).alias("_x"))
    long = long.filter(F.col("_y").isNotNull() & F.col("_x").isNotNull())
    hit = F.col("_y") == F.col("class")
    cells = long.groupBy("class", "_x").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.when(hit, 1).otherwise(0)).alias("_pos"))
    cells = stage(cells.withColumn("_neg", F.col("_n") - F.col("_pos")), "score_cells")
    _, large = _totals(cells, ["class"])
    cut, _ = bucketed(cells, ["class"], large)
    offsets = broadcast_if_small(bucket_offsets(cut, ["class"], ["_neg"]), "offsets")
    cut = _join(cut, offsets, ["class", "_b"], ["_low_neg"])
    inside = Window.partitionBy("class", "_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    lower = F.col("_low_neg") + F.sum("_neg").over(inside) - F.col("_neg")
    # Twice the pairs, so that the sum is one of whole numbers.
    pairs = cut.select("class", "_pos", "_neg", (F.col("_pos") * (2 * lower + F.col("_neg"))).cast("decimal(38,0)").alias("_pairs"))
    out = pairs.groupBy("class").agg(F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"), F.sum("_pairs").alias("_pairs"))
    all_ = F.nullif(F.col("positives").cast("double") * F.col("negatives"), F.lit(0.0))
    return out.select("class", "positives", "negatives", (F.col("_pairs").cast("double") / (2 * all_)).alias("auc"))
