"""Column expressions shared by the operators.  All are built-in expressions (no UDF)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(cond, 1).otherwise(0)


def yes(c: Column | str) -> Column:
    """1 for a 'Y' flag, else 0."""
    return flag(_col(c) == "Y")


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, and 0 where b is 0 or either side is NULL."""
    return F.coalesce(_col(a) / F.nullif(_col(b), F.lit(0)), F.lit(0.0))


def fiscal_year(date: Column | str, first_month: int = 9) -> Column:
    """Year in which the fiscal year ends; the year starts with ``first_month``."""
    shift = (13 - first_month) % 12
    return F.year(F.add_months(_col(date), shift))


def fiscal_year_clipped(date: Column | str, first: Column | int, last: Column | int, outside: Column | int) -> Column:
    """Fiscal year inside a table of known years, one fixed value outside it; the years may come from the data."""
    fy = fiscal_year(date)
    return F.when((fy >= first) & (fy <= last), fy).otherwise(outside)


def month_index(date: Column | str) -> Column:
    """Consecutive integer per month, for RANGE frames that follow the calendar."""
    d = _col(date)
    return F.year(d) * 12 + F.month(d)


def signup_month(period: Column | str, tenure: Column | str) -> Column:
    return F.add_months(_col(period), -_col(tenure).cast("int"))


def rank_ladder(scores: Mapping[str, int]) -> Column:
    """Score of the first flag that equals 1, in the order given; NULL if none is set."""
    return F.coalesce(*[F.when(F.col(name) == 1, F.lit(score)) for name, score in scores.items()])


def ladder_position(flags: Sequence[str]) -> Column:
    """Number of the first flag that equals 1, from 1; 0 if none is set.  Null flags are not set."""
    return F.coalesce(F.array_position(F.array(*[F.col(f).cast("int") for f in flags]), 1), F.lit(0)).cast("int")


def bucket(value: Column | str, bounds: Sequence[tuple[int, int]], below: int, otherwise: int) -> Column:
    """Number of the closed interval holding the value: ``below`` under the first, else 1, 2, ..."""
    v = _col(value)
    out = F.when(v < bounds[0][0], below)
    for number, (lo, hi) in enumerate(bounds, start=1):
        out = out.when(v.between(lo, hi), number)
    return out.otherwise(otherwise)


def tenure_year(tenure: Column | str) -> Column:
    """0 before signup, 1-3 for the first three years, 4 later or unknown."""
    return bucket(tenure, [(0, 11), (12, 23), (24, 35)], below=0, otherwise=4)


def prefer(new: Column | str, old: Column | str, missing: int = -1) -> Column:
    """The new system's value unless it holds the missing mark."""
    return F.when(_col(new) != missing, _col(new)).otherwise(_col(old))


def encode_label(label: Column | str, kind: str = "binary") -> Column:
    """Class index of UP / SAME / DOWN; ``binary`` joins UP and SAME."""
    c = _col(label)
    if kind == "binary":
        return F.when(c.isin("UP", "SAME"), 1).otherwise(0)
    return F.when(c == "UP", 2).when(c == "SAME", 1).otherwise(0)


def strip_zeros(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "^0*", "")


def clean_id(c: Column | str, head: int = 0, tail: int = 2) -> Column:
    """Drop ``tail`` characters at the end, then ``head`` at the start, then leading zeros."""
    v = _col(c)
    v = F.substring(v, F.lit(1), F.length(v) - tail)
    if head:
        v = F.substring(v, F.lit(head + 1), F.length(v))
    return strip_zeros(v)


def clean_prefixed_id(c: Column | str, prefix: str, tail: int = 2) -> Column:
    """Ids with the prefix lose it, their zeros and ``tail`` characters; others only the zeros."""
    v = _col(c)
    marked = v.startswith(prefix)
    body = strip_zeros(F.when(marked, F.substring(v, F.lit(len(prefix) + 1), F.length(v))).otherwise(v))
    return F.when(marked, F.substring(body, F.lit(1), F.length(body) - tail)).otherwise(body)


def split_rank(c: Column | str, sep: str = "-") -> tuple[Column, Column]:
    """Number and name of a text such as ``"4 - Gold"``; NULL where a part is absent."""
    parts = F.split(F.replace(_col(c), F.lit(" "), F.lit("")), sep)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def top_share(cols: Mapping[str, str], total: Column | str) -> Column:
    """Share of the largest of several amounts; 0 where the total is not positive."""
    t = _col(total)
    return F.when(t <= 0, 0.0).otherwise(F.greatest(*[F.col(c) for c in cols.values()]) / t)


def top_name(cols: Mapping[str, str], none: str = "NONE") -> Column:
    """Name of the largest amount, first listed wins a tie; ``none`` where all are 0."""
    top = F.greatest(*[F.col(c) for c in cols.values()])
    out = F.when(top == 0, none)
    for name, c in cols.items():
        out = out.when(top == F.col(c), name)
    return out


def breadth(conds: Sequence[Column]) -> Column:
    """How many of the conditions hold."""
    return reduce(lambda a, b: a + b, [flag(c) for c in conds])


def key_bucket(keys: Sequence[str], n: int, seed: int = 0) -> Column:
    """Stable bucket 0..n-1 of a key: the same for every row and every run."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(n)).cast("int")


def portable_bucket(keys: Sequence[str], n: int, seed: int = 0) -> Column:
    """Like ``key_bucket``, from the first 32 bits of an MD5: other engines can repeat it."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % n).cast("int")
