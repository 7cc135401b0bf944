"""Round trips through the readers and writers.  The SQL side is the table itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from memberlytics.operators import rollup
from memberlytics.plans import bindings as b
from memberlytics.plans.catalog import query
from memberlytics.plans.oracle import EVENTS, MONTHLY, PANEL, cte
from memberlytics.session import staging_path
from memberlytics.sources import readers as rd, writers as wr

_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _write_text(df, path, sep, header=True, **options):
    df.write.options(sep=sep, header=header, **options).csv(path)


@query("src_csv_roundtrip", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""")
def src_csv_roundtrip(spark, sf):
    path = staging_path(spark, "pipe")
    _write_text(b.table(spark, sf, "customer").drop("c_acctbal"), path, "|")
    return rd.read_text_table(spark, path, "|")


@query("src_csv_schema", "SELECT * FROM customer")
def src_csv_schema(spark, sf):
    path = staging_path(spark, "schema")
    _write_text(b.table(spark, sf, "customer"), path, "|", header=False)
    return rd.read_text_table(spark, path, "|", header=False, schema=_CUSTOMER)


@query("src_csv_infer", """SELECT event_id::INTEGER AS event_id, user_id::INTEGER AS user_id, event_type, value, ts::DATE AS day
  FROM events""")
def src_csv_infer(spark, sf):
    path = staging_path(spark, "infer")
    e = b.daily_events(spark, sf).select("event_id", "user_id", "event_type", "value", "day")
    _write_text(e, path, ",")
    return rd.read_text_table(spark, path, infer=True)


# Header names in another script, and the names they are mapped to.
HEADERS = {"事件id": "event_id", "用户": "user_id", "事件类型": "event_type"}


@query("src_tsv_unicode", """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type
  FROM events""")
def src_tsv_unicode(spark, sf):
    path = staging_path(spark, "tsv")
    e = b.table(spark, sf, "events").select(*[F.col(c).alias(n) for n, c in HEADERS.items()])
    _write_text(e, path, "\t", encoding="UTF-8")
    return rd.read_renamed(spark, path, HEADERS)


@query("src_positional_names", """SELECT s_suppkey::INTEGER AS key, s_name AS name, s_nationkey AS nation, s_acctbal AS balance
  FROM supplier""")
def src_positional_names(spark, sf):
    path = staging_path(spark, "positional")
    _write_text(b.table(spark, sf, "supplier"), path, "|", header=False)
    return rd.read_positional(spark, path, ["key", "name", "nation", "balance"])


@query("src_glob_gzip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_glob_gzip(spark, sf):
    path = staging_path(spark, "gzip")
    c = b.table(spark, sf, "customer")
    _write_text(c.filter("c_nationkey < 12"), f"{path}/a", ",", compression="gzip")
    _write_text(c.filter("c_nationkey >= 12"), f"{path}/b", ",", compression="gzip")
    return rd.read_text_table(spark, f"{path}/*/part-*.csv.gz", schema=_CUSTOMER)


@query("src_incremental_backfill", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def src_incremental_backfill(spark, sf):
    """Half of the years first, one of them with a part of its rows; then that year's files are replaced and all years are loaded."""
    path = staging_path(spark, "backfill")
    o = b.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year")
    )
    span = o.agg(F.min("year").alias("lo"), F.max("year").alias("hi")).first()
    years = list(range(span["lo"], span["hi"] + 1))

    def deliver(rows):
        to = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year")
        to.options(sep="|", header=True).csv(f"{path}/raw")

    deliver(o.filter((F.col("year") > years[0]) | (F.col("o_orderkey") % 2 == 0)))
    raw = path + "/raw/year={year}"
    rd.backfill(spark, raw, f"{path}/table", years[: len(years) // 2])
    deliver(o.filter(F.col("year") == years[0]))
    return rd.backfill(spark, raw, f"{path}/table", years)


@query("snk_parquet_roundtrip", cte(PANEL, body="SELECT member_id, month, pv, rank, status FROM panel"))
def snk_parquet_roundtrip(spark, sf):
    path = staging_path(spark, "parquet")
    wr.write_table(b.panel(spark, sf).select("member_id", "month", "pv", "rank", "status"), path)
    return spark.read.parquet(path)


@query("snk_bounded_files", "SELECT count(*) AS n_rows, 0::BIGINT AS files_above, true AS enough_files FROM lineitem")
def snk_bounded_files(spark, sf):
    """All rows are written, no file is above the bound, and there are as many files as that takes."""
    path = staging_path(spark, "bounded")
    wr.write_table(b.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), path, max_records=10_000)
    files = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"))
    per = files.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.sum("n").alias("n_rows"), F.count(F.when(F.col("n") > 10_000, 1)).alias("files_above"),
        (F.count(F.lit(1)) * 10_000 >= F.sum("n")).alias("enough_files"),
    )


@query("snk_single_csv", cte(PANEL, body="""SELECT CAST(year(month) AS VARCHAR) AS y, CAST(count(*) AS VARCHAR) AS n,
  CAST(count(DISTINCT member_id) AS VARCHAR) AS members FROM panel GROUP BY 1"""))
def snk_single_csv(spark, sf):
    path = staging_path(spark, "report")
    m = b.monthly(spark, sf)
    per = m.groupBy("member_id", F.year("month").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    wr.write_report(per.groupBy("y").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("members")), path)
    return rd.read_text_table(spark, path)


@query("snk_observed_write", cte(PANEL, body="""SELECT count(*) AS row_count, min(month) AS min_month, max(month) AS max_month,
  count(*) - count(month) AS nulls_month, min(pv) AS min_pv, max(pv) AS max_pv, count(*) - count(pv) AS nulls_pv, min(rank) AS min_rank,
  max(rank) AS max_rank, count(*) - count(rank) AS nulls_rank FROM panel"""))
def snk_observed_write(spark, sf):
    """What the writing job saw of its rows: no second pass over the table."""
    cols = ["month", "pv", "rank"]
    p = b.panel(spark, sf).select("member_id", *cols)
    seen = wr.write_table(p, staging_path(spark, "observed"), profile=cols)
    kinds = {f"{n}_{c}": p.schema[c].dataType.simpleString() for c in cols for n in ("min", "max")}
    return spark.createDataFrame([tuple(seen.values())], ", ".join(f"{k} {kinds.get(k, 'long')}" for k in seen))
