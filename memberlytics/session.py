"""Session settings and staging of intermediate tables.

The library never changes the configuration of a session it is given.  The settings
below are what a cluster operator should start the session with; ``build_session`` applies
them to a new session (tests, benchmark).
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

RECOMMENDED = {
    # Runtime re-planning: coalesces small partitions, splits skewed join partitions, and turns
    # a join into a broadcast only after the size of the side is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A table hashed by member serves joins and windows on (member, month) without a new shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}

_local_roots: dict[str, str] = {}
_sessions: dict[str, Staging] = {}
_run: ContextVar[Staging | None] = ContextVar("staging run", default=None)


def build_session(app: str = "memberlytics", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back to a fresh temporary folder; on a cluster the
    executors would not share it, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="memberlytics-stage-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


class Staging:
    """Owner of staged tables: the folder they are written to, and the tables that several queries share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.shared: dict[tuple, tuple[object, DataFrame, str]] = {}

    def path(self, name: str) -> str:
        """A path in the folder that no other table uses."""
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    def _files(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def find(self, key: tuple, stamp: object) -> DataFrame | None:
        """The table of ``key`` if it was written with that ``stamp`` and its files are there."""
        if key in self.shared:
            known, table, path = self.shared[key]
            fs, p = self._files(f"{path}/_SUCCESS")
            if known == stamp and fs.exists(p):
                return table
        return None

    def once(self, key: tuple, stamp: object, build: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
        """The table of ``key``, written at the first call; anew if its ``stamp`` differs or its files are gone."""
        found = self.find(key, stamp)
        if found is not None:
            return found
        path = self.path(str(key[-1]))
        self.shared[key] = (stamp, write_staged(build(), path, by), path)
        return self.shared[key][1]

    def close(self) -> None:
        """Removes the folder with all tables in it."""
        self.shared.clear()
        fs, p = self._files(self.folder)
        fs.delete(p, True)


def current_staging(spark: SparkSession) -> Staging:
    """The owner of what is staged now: the run that is open, else one that lasts as long as the session and keeps its tables."""
    run = _run.get()
    if run is not None and run.spark.sparkContext.applicationId == spark.sparkContext.applicationId:
        return run
    app, root = spark.sparkContext.applicationId, staging_root(spark)
    if app not in _sessions or _sessions[app].folder != root:
        _sessions.clear()  # sessions before this one have ended
        _sessions[app] = Staging(spark, root)
    return _sessions[app]


@contextmanager
def staging_run(spark: SparkSession) -> Iterator[Staging]:
    """A run whose staged tables lie in a folder of their own, which is removed at the end, after an error too.

    What the run returns reads these tables: collect or write it before the block ends.  Runs may be nested; an inner one neither
    sees nor removes what the outer one shares.
    """
    run = Staging(spark, f"{staging_root(spark)}/run-{uuid.uuid4().hex}")
    token = _run.set(run)
    try:
        yield run
    finally:
        _run.reset(token)
        run.close()


def staging_path(spark: SparkSession, name: str) -> str:
    """A path under the staging root, in the folder of the open run if there is one, that nothing else uses."""
    return current_staging(spark).path(name)


def write_staged(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Writes ``df`` and reads it back; with ``by`` in buckets of that column, as many as the session has shuffle partitions."""
    spark = df.sparkSession
    if by is None:
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    name = f"staged_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, by).option("path", path).option("compression", "zstd").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay; the table read from them knows its buckets
    return table


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    For a table that one plan uses several times.  Compared with caching, the copy survives the
    loss of executors, later scans prune its columns, and its true size is known to the planner.
    """
    return write_staged(df, staging_path(df.sparkSession, name))


def stage_by(df: DataFrame, name: str, by: str) -> DataFrame:
    """Like ``stage``, in buckets: joins and windows by the column ``by`` read the copy without a shuffle."""
    return write_staged(df, staging_path(df.sparkSession, name), by)


def stage_seen(df: DataFrame, name: str, **aggregates: Column) -> tuple[DataFrame, dict]:
    """Like ``stage``; also gives aggregates of the rows, observed by the writing tasks, so the table is not read for them."""
    seen = Observation()
    table = stage(df.observe(seen, *[c.alias(n) for n, c in aggregates.items()]), name)
    return table, seen.get


def row_bytes(df: DataFrame) -> Column:
    """About the size of a row in memory."""
    fixed, parts = 0, []
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.octet_length(f.name))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            parts.append(F.octet_length(F.to_json(F.struct(f.name))))
        fixed += 8
    return reduce(lambda a, c: a + F.coalesce(c, F.lit(0)), parts, F.lit(fixed)).cast("long")


def unmeasured(side: DataFrame) -> DataFrame:
    """A side that may be large: it is joined by a shuffle.

    The planner judges a table by its files.  Counts and flags take a few bits there and eight bytes in memory, so a side that looks
    small enough to broadcast can be too large for the driver.
    """
    return side.hint("merge")


def broadcast_if_small(df: DataFrame, name: str, max_rows: int = 50_000, max_bytes: int = 16 << 20) -> DataFrame:
    """A lookup, written once; marked for broadcast if it is within ``max_rows`` and ``max_bytes``, else for a join by a shuffle.

    For narrow tables that are computed from a large one: their estimate is the large one's, so the planner would shuffle
    the other side of the join by the lookup's few keys.  Rows and bytes are observed by the writing tasks.
    """
    table, seen = stage_seen(df, name, rows=F.count(F.lit(1)), bytes=F.sum(row_bytes(df)))
    return F.broadcast(table) if seen["rows"] <= max_rows and (seen["bytes"] or 0) <= max_bytes else unmeasured(table)


def stage_all(tables: dict[str, DataFrame], at_once: int = 4) -> dict[str, DataFrame]:
    """Stage independent tables, a few at a time, so that small jobs share the executors."""
    staging_root(next(iter(tables.values())).sparkSession)
    with ThreadPoolExecutor(at_once) as pool:
        done = [pool.submit(copy_context().run, stage, df, name) for name, df in tables.items()]  # threads know the open run
        return {name: d.result() for name, d in zip(tables, done)}
