"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a minimum per node (combined before the shuffle) and a join of the links with those minima.
Between steps the links are written to the shared staging folder, so lost executors cost one step at most and
the plan does not grow.  Both join sides are plain scans, so run-time re-planning can split a hub's links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlytics.session import stage


def _minima(links: DataFrame, node: str, other: str) -> DataFrame:
    m = links.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("low"))
    return m.select("node", F.least("node", "low").alias("low"))


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame, max_steps: int = 60) -> DataFrame:
    """(a, b) links -> (node, component): the smallest node reachable; only nodes that have a link appear.

    Direction, repeats and self links do not matter; links with a null end are ignored; no links give no rows.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stage(links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "links")
    before = _mark(links)
    for _ in range(max_steps):
        if not before[0]:
            break
        both = links.union(links.select("b", "a")).toDF("a", "b")
        low = stage(_minima(both, "a", "b"), "minima")
        # Every node larger than its neighbour u is linked to the smallest neighbour of u instead.
        large = links.join(low, links.b == low.node).select(links.a, "low").toDF("a", "b").distinct()
        large = stage(large, "links")
        # The neighbours that are smaller than u, and u itself, are linked to the smallest of them.
        low = stage(_minima(large, "a", "b"), "minima")
        small = large.join(low, large.a == low.node).filter("b <> low").select("b", "low")
        links = stage(small.union(low).toDF("a", "b").filter("a <> b").distinct(), "links")
        after = _mark(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_steps} steps")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
