"""Lookup of whole numbers in tables of closed intervals of any size, without comparing each with each.

An interval is cut into dyadic blocks: at most two of each size 1, 2, 4, ..., which together are the interval.  A number lies
in one block of each size, so number and block meet by an equality of (size, block number).  Both sides are reduced to
distinct rows before they meet: of several intervals with a block the last one wins, and a number is looked up once
however many rows have it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from memberlytics.operators.ranking import attach
from memberlytics.session import stage, stage_seen


def dyadic_blocks(lo: Column, hi: Column) -> Column:
    """The array of (size as a power of two, number) of the blocks that make up lo..hi; none if hi < lo."""
    state = "struct<l: bigint, r: bigint, found: array<struct<size: int, block: bigint>>>"
    start = F.struct(lo.cast("long").alias("l"), (hi.cast("long") + 1).alias("r"), F.array().alias("found")).cast(state)

    def step(s: Column, size: Column) -> Column:
        odd_l, odd_r = (s["l"] < s["r"]) & (s["l"] % 2 == 1), (s["l"] < s["r"]) & (s["r"] % 2 == 1)
        left = F.when(odd_l, F.array(F.struct(size.alias("size"), s["l"].alias("block")))).otherwise(F.array())
        right = F.when(odd_r, F.array(F.struct(size.alias("size"), (s["r"] - 1).alias("block")))).otherwise(F.array())
        l, r = F.when(odd_l, s["l"] + 1).otherwise(s["l"]), F.when(odd_r, s["r"] - 1).otherwise(s["r"])
        found = F.concat(s["found"], left, right)
        return F.struct(F.floor(l / 2).cast("long").alias("l"), F.floor(r / 2).cast("long").alias("r"), found.alias("found")).cast(state)

    return F.aggregate(F.sequence(F.lit(0), F.lit(51)), start, step)["found"]


def interval_lookup(df: DataFrame, col: str, bands: DataFrame, outputs: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``df`` with the ``outputs`` of the band [lo, hi] holding ``col`` in its row; of several the one with the largest ``pos``.

    ``bands`` holds ``by``, pos, lo, hi and ``outputs``.  ``col``, lo and hi are whole numbers that span less than 2 ** 51; ``by``
    are columns that have to be equal (null equals nothing).  No band, or a null ``col``, gives nulls; bands with a null end or
    hi < lo hold nothing; bands with the same ``pos`` are taken by their outputs.
    """
    ends = bands.agg(F.min("lo"), F.max("hi")).first()
    if ends[0] is None or ends[1] is None:
        return df.select("*", *[F.lit(None).cast(bands.schema[o].dataType).alias(o) for o in outputs])
    base = ends[0]
    blocks = bands.select(*by, "pos", *outputs, F.explode(dyadic_blocks(F.col("lo") - base, F.col("hi") - base)).alias("_d"))
    last = F.max(F.struct("pos", *outputs)).alias("_hit")
    blocks = stage(blocks.groupBy(*by, "_d.size", "_d.block").agg(last), "blocks")
    sizes = [r[0] for r in blocks.select("size").distinct().collect()]  # at most 52
    on = [*by, col]
    cells, seen = stage_seen(df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), "numbers", total=F.sum("_n"), most=F.max("_n"))
    asks = cells.filter(F.col(col).between(*ends))
    number = F.col(col).cast("long") - base
    of = F.array(*[F.struct(F.lit(s).alias("size"), F.shiftright(number, s).alias("block")) for s in sizes])
    asks = asks.select(*on, F.explode(of).alias("_d")).select(*on, "_d.*")
    found = asks.join(blocks, [*by, "size", "block"]).groupBy(*on).agg(F.max("_hit").alias("_hit"))
    table = cells.join(found, on, "left").select(*on, "_n", *[F.col(f"_hit.{o}").alias(o) for o in outputs])
    return attach(df, table, cells, on, df.columns, outputs, seen)
