"""Benchmark decontamination: windows of test words are looked up in every window of the training texts.

The windows of the test items (10 words; a shorter item is one window) form a hash table that is broadcast in slices
of at most ``SLICE`` (window, item) pairs, so the broadcast has a fixed bound and a larger benchmark takes more passes.
A document is scanned once per slice: its window positions are exploded, hashed and looked up inside one generated
loop; a hit counts only if the words themselves agree.  All of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.registry import query, table
from memberlytics.llm.text import words
from memberlytics.session import stage

WIDTH = 10
SLICE = 500_000


def windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item_id, size, gram): distinct word windows of the items; items without words have none."""
    w = benchmark.select("item_id", words(F.col("text")).alias("w"), F.size(words(F.col("text"))).alias("n"))
    w = w.filter("n > 0").withColumn("size", F.least("n", F.lit(width)))
    w = w.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("size") + 1)))
    return w.select("item_id", "size", F.slice("w", F.col("at"), F.col("size")).alias("gram")).distinct()


def _starts(n: Column, size: int, width: int) -> Column:
    """Codes start * (width + 1) + size of all windows of that many words."""
    last = (n - size).cast("long") * (width + 1) + size
    codes = F.sequence(F.lit(size).cast("long"), last, F.lit(width + 1).cast("long"))
    return F.when(n >= size, codes).otherwise(F.array().cast("array<long>"))


def hits(docs: DataFrame, grams: DataFrame, keys: list[str], text: str = "text", width: int = WIDTH) -> DataFrame:
    """One row for each distinct (keys, text): keys, n_words, copies, spans array<struct<start,size>>, items array<long>.

    ``grams`` is the staged output of ``windows``.  ``spans`` are the hit windows (0-based word), ``items`` the ids of
    the items with a window there, each once.
    """
    sizes = [r[0] for r in grams.select("size").distinct().orderBy("size").collect()]  # at most ``width`` values
    slices = -(-grams.count() // SLICE)
    w = docs.select(*keys, F.xxhash64(text).alias("text_key"), words(F.col(text)).alias("w"))
    w = w.withColumn("n", F.size("w"))
    found = []
    for k in range(max(1, slices)):
        marker = F.array(F.lit(-1).cast("long")) if k == 0 else F.array().cast("array<long>")
        codes = F.concat(marker, *[_starts(F.col("n"), s, width) for s in sizes])
        at = w.select("*", F.explode(codes).alias("code"))
        size = F.when(F.col("code") < 0, 0).otherwise(F.col("code") % (width + 1)).cast("int")
        at = at.withColumn("size", size).withColumn("start", F.floor(F.col("code") / (width + 1)).cast("int"))
        gram = F.when(F.col("code") >= 0, F.slice("w", F.col("start") + 1, F.col("size")))
        part = grams if slices <= 1 else grams.filter(F.pmod(F.xxhash64("gram", "item_id"), F.lit(slices)) == k)
        test = part.groupBy("gram").agg(F.collect_list("item_id").alias("items")).select(
            F.xxhash64("gram").alias("test_key"), F.col("gram").alias("test_gram"), "items"
        )
        # The hash alone is the join key (a table of longs); the words decide, as a condition on what it finds.
        match = (F.xxhash64(gram) == F.col("test_key")) & F.when(gram == F.col("test_gram"), True).otherwise(False)
        got = at.join(F.broadcast(test), match, "left").filter("code < 0 OR items IS NOT NULL")
        found.append(got.select(*keys, "text_key", "n", "code", "start", "size", "items"))
    rows = found[0]
    for f in found[1:]:
        rows = rows.union(f)
    real = F.col("code") >= 0
    g = rows.groupBy(*keys, "text_key").agg(
        F.max("n").alias("n_words"),
        F.sum((~real).cast("long")).alias("copies"),
        F.collect_set(F.when(real, F.struct("start", "size"))).alias("spans"),
        F.collect_set("items").alias("items"),
    )
    return g.withColumn("items", F.array_distinct(F.flatten("items")))


def hit_words(spans: Column) -> Column:
    """Positions of the words inside any of the spans, ascending."""
    each = F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1))
    return F.array_sort(F.array_distinct(F.flatten(each)))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, hit_words, items, contaminated): one row per row of ``docs``.

    Null or blank texts have no words; null items and null item ids are left out of ``items`` but their words still hit;
    an empty benchmark hits nothing.  Repeated rows give repeated rows.
    """
    grams = stage(windows(benchmark, width), "grams")
    d = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    g = hits(d, grams, ["doc_id"], width=width)
    g = g.withColumn("hit_words", hit_words(F.col("spans")))
    g = g.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "hit_words", "items",
        (F.size("hit_words") > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    )
    return g.drop("copy")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` without any benchmark window, all columns kept; rows without a doc_id are judged by their text."""
    grams = stage(windows(benchmark), "grams")
    d = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    bad = hits(d, grams, ["doc_id"]).filter(F.size("spans") > 0)
    bad = stage(bad.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")), "contaminated")
    same = docs["doc_id"].eqNullSafe(bad["__id"]) & (F.xxhash64(docs["text"]) == bad["__key"])
    return docs.join(bad, same, "left_anti")


WORDS_SQL = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

ORACLE = rf"""WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, list_slice(w, i, i + least(len(w), 10) - 1) AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT len(gram) AS size FROM g),
p AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM d, s WHERE len(w) >= size),
h AS (SELECT doc_id, i, size, item_id FROM p JOIN g ON list_slice(w, i, i + size - 1) = g.gram),
n AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN t ON d.doc_id = t.doc_id"""


@query("op2_decontaminate", ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return c.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated",
    )
