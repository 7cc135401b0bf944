"""Readers for delimited text, and the incremental yearly backfill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from memberlytics.operators.shape import union_aligned


def read_text_table(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    header: bool = True,
    schema: StructType | str | None = None,
    infer: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Delimited text; ``path`` may be a glob and the files may be compressed.

    Without a schema every column is a string.  ``infer`` costs one more pass over the files, so
    it is meant for small reference files.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("encoding", encoding)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_positional(spark: SparkSession, path: str, names: Sequence[str], sep: str = "|", infer: bool = True) -> DataFrame:
    """Text without a header; columns are named by position."""
    return read_text_table(spark, path, sep, header=False, infer=infer).toDF(*names)


def read_renamed(spark: SparkSession, path: str, names: Mapping[str, str], sep: str = "\t") -> DataFrame:
    """Tab separated UTF-8 text whose header (any script) is mapped to other names."""
    return read_text_table(spark, path, sep).withColumnsRenamed(dict(names))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or a glob matches anything on its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def source_prints(spark: SparkSession, raw: str, years: Sequence[int]) -> dict[int, str]:
    """Per year that has files a print of their names, sizes and times; contents are not read."""
    parts = []
    for year in years:
        if path_exists(spark, raw.format(year=year)):
            files = spark.read.format("binaryFile").load(raw.format(year=year))
            parts.append(files.select(F.lit(year).alias("year"), "path", "length", "modificationTime"))
    if not parts:
        return {}
    each = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    made = reduce(DataFrame.union, parts).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"), F.sum(each).alias("hash"))
    return {r["year"]: f"{r['n']} {r['size']} {r['hash']}" for r in made.collect()}  # a row a year


def files_print(spark: SparkSession, paths: Sequence[str]) -> str:
    """A print of the names, sizes and times of all files at some paths; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    each = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    r = files.select("length", each.alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"), F.sum("h").alias("hash")).first()
    return f"{r['n']} {r['size']} {r['hash']}"


def backfill(
    spark: SparkSession,
    raw: str,
    target: str,
    years: Sequence[int],
    read=lambda spark, path: read_text_table(spark, path, "|"),
    at_once: int = 8,
) -> DataFrame:
    """Convert the years whose source files are new or changed, then read all of ``years`` as one table.

    ``raw`` contains ``{year}``.  The prints of the converted files are kept in ``target/_sources``; only folders of changed
    years are replaced, ``at_once`` years in a job.  The prints are written after the rows, so an interrupted run converts
    its years again.  A year whose files are gone keeps its rows; one whose files have no rows any more has none.
    """
    known = f"{target}/_sources"
    held = {r["year"]: tuple(r) for r in spark.read.parquet(known).collect()} if path_exists(spark, f"{known}/_SUCCESS") else {}
    prints = source_prints(spark, raw, years)
    changed = [y for y in years if y in prints and (y not in held or held[y][1] != prints[y])]
    for k in range(0, len(changed), at_once):
        part = changed[k : k + at_once]
        rows = union_aligned([read(spark, raw.format(year=y)).withColumn("year", F.lit(y)) for y in part])
        counts = Observation()
        rows = rows.observe(counts, *[F.count(F.when(F.col("year") == y, 1)).alias(str(y)) for y in part])
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(target)
        held |= {y: (y, prints[y], counts.get[str(y)]) for y in part}
        spark.createDataFrame(list(held.values()), "year int, print string, rows long").coalesce(1).write.mode("overwrite").parquet(known)
    present = [y for y in years if y in held and held[y][2] > 0]
    if not present:
        raise ValueError(f"{raw} has no rows for any of the years")
    return spark.read.option("basePath", target).parquet(target).filter(F.col("year").isin(present))
