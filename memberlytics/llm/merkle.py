"""Merkle manifest of a table: one hash tree per group of rows, and a tree over the roots of the groups.

A level is built by a self-join: every node asks for the nodes at the indices of its siblings (the XOR of its index for
binary trees, slot offsets inside the run for wider ones) and keeps what stands left and right of it; the node in slot
zero, which then knows its whole run, emits the parent.  Keys are (tree, index), so a tree with most of the rows spreads
over all tasks.  Rows get their index from a range-partitioned, staged order, never from one sorted group.  Proof paths
are joined downwards, a level a join, at most ``width`` children a path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from memberlytics.llm.registry import query, table
from memberlytics.llm.text import lower_ascii
from memberlytics.session import stage

WIDTH = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def nothing() -> Column:
    return F.lit("").cast("binary")


def digest(parts: Column) -> Column:
    """Binary sha256 of the hex text of binary digests."""
    return F.unhex(F.sha2(F.lower(F.hex(parts)), 256))


def leaf_digest(values: list[Column]) -> Column:
    """Binary sha256 of the values: ``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``idx`` (from 0, by ``order`` within ``tree``, nulls first) and ``n`` (rows of the tree); ``order`` should be total.

    The order is a range partitioning; only counts by (tree, partition) are summed up, one row a partition and tree.
    """
    keys = ["tree", *order]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    sorted_ = stage(sorted_.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at")), "ordered")
    spans = sorted_.groupBy("tree", "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("__rows").over(tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select("tree", "__part", "__first", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__rows").over(tree).alias("n"))
    idx = F.col("__at") - F.col("__first") + F.col("__before")
    return sorted_.join(stage(spans, "spans"), ["tree", "__part"]).withColumn("idx", idx).drop("__part", "__at", "__first", "__before")


def sibling_indices(idx: Column, width: int) -> Column:
    """The indices of a run, the node's own first."""
    if width == 2:
        return F.array(idx, idx.bitwiseXOR(F.lit(1).cast("long")))
    run = idx - F.pmod(idx, F.lit(width))
    return F.array(*[run + F.pmod(idx + s, F.lit(width)) for s in range(width)])


def _level(nodes: DataFrame, keep: list[str], width: int) -> DataFrame:
    """Nodes of trees with more than one node, each with the digests left and right of it in its run."""
    nodes = nodes.filter("n > 1")
    asks = nodes.select("tree", "n", F.col("idx").alias("asker"), F.explode(sibling_indices(F.col("idx"), width)).alias("idx")).filter("idx < n")
    own = F.col("idx") == F.col("asker")
    found = asks.join(nodes.drop("n"), ["tree", "idx"])
    item = F.struct("idx", "digest", *[F.when(own, F.col(c)).alias(c) for c in keep])
    runs = found.groupBy("tree", "n", "asker").agg(F.array_sort(F.collect_list(item)).alias("run"))
    slot = F.pmod("asker", F.lit(width)).cast("int")

    def joined(part: Column) -> Column:
        return F.aggregate(part, nothing(), lambda a, x: F.concat(a, x["digest"]))

    return runs.select(
        "tree", "n", F.col("asker").alias("idx"), F.col("run")[slot]["digest"].alias("digest"),
        joined(F.slice("run", F.lit(1), slot)).alias("left"), joined(F.slice("run", slot + 2, F.lit(width))).alias("right"),
        *[F.col("run")[slot][c].alias(c) for c in keep],
    )


def _parents(level: DataFrame, width: int) -> DataFrame:
    first = level.filter(F.pmod("idx", F.lit(width)) == 0)
    return first.select(
        "tree", F.floor(F.col("idx") / width).alias("idx"), F.ceil(F.col("n") / width).alias("n"), digest(F.concat("digest", "right")).alias("digest")
    )


def grow(nodes: DataFrame, keep: list[str], width: int = WIDTH) -> tuple[list[DataFrame], DataFrame]:
    """(tree, idx, n, digest, ``keep``) -> the staged levels, leaves first, and (tree, digest) of the roots."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots = [], nodes.filter("n = 1").select("tree", "digest")
    while largest > 1:
        levels.append(stage(_level(nodes, keep, width), f"level{len(levels)}"))
        nodes, keep, largest = _parents(levels[-1], width), [], -(-largest // width)
        roots = roots.union(nodes.filter("n = 1").select("tree", "digest"))
    return levels, stage(roots, "roots")


def paths(levels: list[DataFrame], ends: DataFrame, keep: list[str], width: int = WIDTH) -> DataFrame:
    """(tree, idx, digest, ``keep``, path, ...) of all leaves that have siblings.

    ``ends`` holds one row a tree: ``tree``, ``path`` above its root, and further columns for all its leaves.  A path is the
    array of (left, right) from the leaf's run upwards.
    """
    more = [c for c in ends.columns if c not in ("tree", "path")]
    above = None
    for k in reversed(range(len(levels))):
        own = ["tree", "idx", *(["digest", *keep] if k == 0 else [])]
        level = levels[k].select("*", F.floor(F.col("idx") / width).alias("__up"))
        step = F.concat(F.array(F.struct("left", "right")), "path").alias("path")
        at = level.filter(F.col("n") <= width).join(ends, "tree").select(*own, step, *more)
        if above is not None:
            upper = above.withColumnRenamed("idx", "__up")
            at = at.union(level.filter(F.col("n") > width).join(upper, ["tree", "__up"]).select(*own, step, *more))
        above = at
    return above


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda a, s: digest(F.concat(s["left"], a, s["right"])))


def siblings(path: Column) -> Column:
    """All siblings of a path, left to right, level by level."""
    return F.aggregate(path, nothing(), lambda a, s: F.concat(a, s["left"], s["right"]))


def proofs(leaves: DataFrame, keep: list[str], order: list[str], width: int = WIDTH) -> DataFrame:
    """(tree, digest, ``keep``) -> (tree, digest, ``keep``, path, subroot, root), one row per row.

    Within a tree rows stand by ``order`` (columns of ``keep``), then by digest; rows with equal digests may swap.  The
    roots of the trees, by ``tree``, are the leaves of the last tree.  No rows give no rows.
    """
    rows = stage(leaves.withColumn("__row", F.monotonically_increasing_id()), "leaves")
    nodes = stage(numbered(rows, [*order, "digest", "__row"]).drop("__row"), "nodes")
    levels, subroots = grow(nodes, keep, width)
    tops = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"])
    tops = stage(tops, "tops")
    upper, root = grow(tops, ["name"], width)
    end = root.select("tree", F.array().cast("array<struct<left:binary,right:binary>>").alias("path"), F.col("digest").alias("root"))
    alone = tops.filter("n = 1").join(end, "tree").select("name", "digest", "path", "root")
    ends = alone if not upper else alone.union(paths(upper, end, ["name"], width).select("name", "digest", "path", "root"))
    ends = stage(ends.toDF("tree", "subroot", "path", "root"), "ends")
    out = nodes.filter("n = 1").join(ends, "tree").select("tree", "digest", *keep, "path", "subroot", "root")
    return out if not levels else out.union(paths(levels, ends, keep, width).select(*out.columns))


def manifest(docs: DataFrame, changed: Column | None = None, columns: tuple[str, ...] = COLUMNS, tree: str = "lang", order: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: ``order``, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``columns`` are hashed, other columns do not matter.  Rows of one ``tree`` value (null is a value, and the first) stand
    by ``order`` (nulls first), then by leaf; repeated rows are leaves of their own.  ``changed`` is the leaf digest to verify
    instead of the row's own, null where it is the same.  ``proof_sha256`` hashes the siblings (none: the empty text).
    """
    leaf = leaf_digest([F.col(c) for c in columns])
    # Sorts null first, then by bytes.
    key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    other = F.lit(None).cast("binary") if changed is None else changed
    rows = docs.select(key.alias("tree"), leaf.alias("digest"), F.col(order).alias("id"), other.alias("changed"))
    p = proofs(rows, ["id", "changed"], ["id"], width)
    p = p.withColumn("folded", fold(F.col("path"), F.coalesce("changed", "digest")))

    def text(c: str) -> Column:
        return F.lower(F.hex(c))

    return p.select(
        F.col("id").alias(order), text("digest").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        F.sha2(F.lower(F.hex(siblings(F.col("path")))), 256).alias("proof_sha256"), text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


ENC = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
LEAF = "sha256(" + " || ".join(ENC.format(c) for c in COLUMNS) + ")"
CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, (c & 1) * 3988292384))), 4294967295)"""

ORACLE = f"""WITH RECURSIVE d AS (SELECT *, {LEAF} AS leaf, coalesce({CRC} % 3 = 0, false) AS hit FROM documents),
e AS (SELECT doc_id, lang, leaf, hit, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS r,
  CASE WHEN hit THEN {LEAF.replace("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE leaf END AS seen FROM d),
a AS (SELECT lang, 0 AS k, idx, n, leaf AS h FROM e
  UNION ALL SELECT lang, k + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM a WHERE n > 1 GROUP BY lang, k, idx // 8, n),
s AS (SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM a WHERE n = 1),
b AS (SELECT 0 AS k, idx, n, h FROM s
  UNION ALL SELECT k + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM b WHERE n > 1 GROUP BY k, idx // 8, n),
q AS (SELECT x.lang, x.k, x.idx, coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx < x.idx), '') AS l,
    coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx > x.idx), '') AS g
  FROM a x JOIN a y ON x.lang IS NOT DISTINCT FROM y.lang AND x.k = y.k AND x.idx // 8 = y.idx // 8 WHERE x.n > 1 GROUP BY x.lang, x.k, x.idx),
t AS (SELECT x.k, x.idx, coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx < x.idx), '') AS l,
    coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx > x.idx), '') AS g
  FROM b x JOIN b y ON x.k = y.k AND x.idx // 8 = y.idx // 8 WHERE x.n > 1 GROUP BY x.k, x.idx),
p AS (SELECT e.r, q.k, l, g FROM e JOIN q ON e.lang IS NOT DISTINCT FROM q.lang AND e.idx // (8 ** q.k)::BIGINT = q.idx
  UNION ALL SELECT e.r, 1000 + t.k, l, g FROM e JOIN s ON e.lang IS NOT DISTINCT FROM s.lang JOIN t ON s.idx // (8 ** t.k)::BIGINT = t.idx),
o AS (SELECT r, k, l, g, row_number() OVER (PARTITION BY r ORDER BY k) AS j FROM p),
f AS (SELECT r, 0::BIGINT AS j, seen AS h FROM e UNION ALL SELECT f.r, f.j + 1, sha256(l || f.h || g) FROM f JOIN o ON f.r = o.r AND o.j = f.j + 1),
z AS (SELECT r, max_by(h, j) AS folded_root FROM f GROUP BY r),
w AS (SELECT r, string_agg(l || g, '' ORDER BY j) AS proof FROM o GROUP BY r),
top AS (SELECT h AS root FROM b WHERE n = 1)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM e JOIN s ON e.lang IS NOT DISTINCT FROM s.lang JOIN z ON e.r = z.r LEFT JOIN w ON e.r = w.r, top"""


@query("op11_merkle", ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document (by a checksum of its id) is verified with its text in lower case."""
    docs = table(spark, sf_dir, "documents")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    lowered = leaf_digest([lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS])
    return manifest(docs, F.when(hit, lowered))
