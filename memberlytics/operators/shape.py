"""Column selection by name, alignment of schemas, imputation, sampling and splitting."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from memberlytics.functions import portable_bucket

_FRAME = re.compile(r"_(\d+)m$", re.IGNORECASE)
_DERIVED = re.compile(r"(_\d+m|\d+m_mom|\d+m_lyr)$", re.IGNORECASE)
_SUMMED = re.compile(r"_(sum|count|nonzero_mths)_(\d+m|month_agg)$", re.IGNORECASE)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def drop_where(df: DataFrame, suffix: str | None = None, names: Sequence[str] = ()) -> DataFrame:
    """Drop columns by suffix and by list; unknown names are ignored."""
    out = [c for c in df.columns if c in names or (suffix and c.endswith(suffix))]
    return df.drop(*out)


def frame_columns(names: Sequence[str], k: int) -> dict[str, str]:
    """``{stem}_{k}m`` -> ``{stem}_month_agg`` for the one frame length k."""
    found = {}
    for name in names:
        hit = _FRAME.search(name)
        if hit and int(hit.group(1)) == k:
            found[name] = name[: hit.start()] + "_month_agg"
    return found


def summed_columns(names: Sequence[str]) -> list[str]:
    """Columns that grow with the frame: sums, counts, numbers of months."""
    return [n for n in names if _SUMMED.search(n)]


def framed_columns(names: Sequence[str]) -> list[str]:
    """Columns tied to a frame length: rolling values, momentum and last-year values."""
    return [n for n in names if _DERIVED.search(n)]


def slice_to_frame(df: DataFrame, k: int) -> DataFrame:
    """Rename the columns of frame k to ``_month_agg`` and drop every other framed column."""
    keep = frame_columns(df.columns, k)
    framed = set(framed_columns(df.columns))
    return df.select(*[F.col(c).alias(keep[c]) if c in keep else F.col(c) for c in df.columns if c in keep or c not in framed])


def normalize_by(df: DataFrame, cols: Sequence[str], n: str) -> DataFrame:
    """Divide the columns by ``n``; NULL where n is 0."""
    by = F.nullif(F.col(n), F.lit(0))
    return df.select(*[(F.col(c) / by).alias(c) if c in cols else F.col(c) for c in df.columns])


def union_aligned(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns absent in a part are NULL there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def roles(df: DataFrame, target: str, keys: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric (``n_``) and categorical (``i_``) columns by name, without keys and target."""
    free = [c for c in df.columns if c != target and c not in keys]
    return [c for c in free if c.startswith("n_")], [c for c in free if c.startswith("i_")]


def cast_roles(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Numeric columns stored as text to double (NULL where it is not a number); categories to text."""
    kinds = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c in numeric and kinds[c] == "string":
            out.append(F.col(c).try_cast("double").alias(c))
        elif c in categorical and kinds[c] != "string":
            out.append(F.col(c).cast("string").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], number=0, text="unknown_filled") -> DataFrame:
    out = df.na.fill(number, list(numeric)) if numeric else df
    return out.na.fill(text, list(categorical)) if categorical else out


def sample_rows(df: DataFrame, fraction: float, seed: int = 1) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(False, fraction, seed)


def sample_keys(df: DataFrame, keys: Sequence[str], parts: int, part: int = 0, seed: int = 0) -> DataFrame:
    """Sample of whole keys: those in one of ``parts`` stable buckets."""
    return df.filter(portable_bucket(keys, parts, seed) == part)


def split_rows(df: DataFrame, ratios: Sequence[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(list(ratios), seed)


def group_split(df: DataFrame, key: str, ratios: Sequence[float], seed: int = 0, buckets: int = 10_000) -> list[DataFrame]:
    """Disjoint parts that cover the input and hold every key in exactly one part.

    A stable hash of the key decides, so the split is a filter: no list of distinct keys, no
    join back, and the same members fall in the same part on every run.
    """
    total = float(sum(ratios))
    b = portable_bucket([key], buckets, seed)
    parts, lo, acc = [], 0, 0.0
    for r in ratios:
        acc += r
        hi = round(buckets * acc / total)
        parts.append(df.filter((b >= lo) & (b < hi)))
        lo = hi
    return parts


def low_variance(df: DataFrame, cols: Sequence[str], threshold: float) -> tuple[DataFrame, list[str]]:
    """Drop numeric columns with sample variance at or below the threshold: one aggregate."""
    row = variances(df, cols).first()
    low = [c for c in cols if row[c] is not None and row[c] <= threshold]
    return df.drop(*low), low


def variances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the sample variance of every column."""
    return df.agg(*[F.var_samp(c).alias(c) for c in cols])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
