"""Near-duplicate embeddings by an inverted multi-index.

Two codebooks, one for each half of the unit vectors, form a grid of cells.  A vector lies in the cell of its nearest
centroids.  From a vector, the penalty of a cell is the sum over the halves of the squared distance to the border with
the cell's centroid; the traversal visits cells by rising penalty until the bound that holds for the target share of pairs
at the threshold, and all found pairs are verified by their cosine in double precision.

Equal vectors are one entry with a weight.  A cell with many residents or visitors is cut into units of bounded size.
Units give link counts per vector and a forest of the links; pairs never leave a task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from memberlytics.llm.components import connected_components
from memberlytics.llm.registry import query, table
from memberlytics.session import stage

THRESHOLD, TARGET_RECALL = 0.95, 0.9999
#: The codebooks are fitted on about so many vectors; every vector is indexed.
SAMPLE = 20_000
PER_CELL, MIN_CODES, MAX_CODES = 200, 8, 64
RESIDENTS, VISITORS = 1024, 8192


def unit_vectors(x: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that squares stay finite."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    if x.shape[1] == 0:  # the half of a vector of one component
        return x[:1].copy()
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        for j in range(k):
            own = x[near == j]
            if len(own):
                c[j] = own.mean(axis=0)
    return np.unique(c, axis=0)


def penalties(half: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(rows, codes): squared distance of each row to the border between its own centroid's region and another's."""
    d = (half * half).sum(axis=1)[:, None] + (codes * codes).sum(axis=1) - 2 * half @ codes.T
    own = d.argmin(axis=1)
    apart = np.sqrt(np.maximum((codes * codes).sum(axis=1)[:, None] + (codes * codes).sum(axis=1) - 2 * codes @ codes.T, 1e-18))
    gap = (d - d[np.arange(len(d)), own][:, None]) / (2 * apart[own])
    gap[np.arange(len(d)), own] = 0.0
    return gap * gap


class Index:
    """Codebooks and the penalty up to which cells are visited."""

    def __init__(self, sample: np.ndarray, k: int, threshold: float, recall: float) -> None:
        self.cut = sample.shape[1] // 2
        self.codes = [kmeans(sample[:, : self.cut], k), kmeans(sample[:, self.cut :], k)]
        rng = np.random.default_rng(11)
        x = sample[rng.integers(0, len(sample), 20_000)]
        # Vectors at exactly the threshold from the sample, in random directions.
        e = rng.standard_normal(x.shape)
        e -= (e * x).sum(axis=1, keepdims=True) * x
        norm = np.sqrt((e * e).sum(axis=1, keepdims=True))
        y = threshold * x + np.sqrt(1 - threshold**2) * e / np.where(norm > 0, norm, 1)
        p, q = self.grid(x)
        rows, (i, j) = np.arange(len(x)), self.cells(y)
        self.bound = float(np.quantile(p[rows, i] + q[rows, j], recall)) + 1e-9

    def grid(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return penalties(x[:, : self.cut], self.codes[0]), penalties(x[:, self.cut :], self.codes[1])

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p, q = self.grid(x)
        return (p == 0).argmax(axis=1), (q == 0).argmax(axis=1)

    def traverse(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Own cell of each row, and its visited cells by rising penalty, its own first."""
        p, q = self.grid(x)
        wide = len(self.codes[1])
        own = (p == 0).argmax(axis=1) * wide + (q == 0).argmax(axis=1)
        lists = []
        for a, b, c in zip(p, q, own):
            i, j = np.flatnonzero(a <= self.bound), np.flatnonzero(b <= self.bound)
            total = a[i][:, None] + b[j]
            r, s = np.nonzero(total <= self.bound)
            cells = (i[r] * wide + j[s])[np.argsort(total[r, s], kind="stable")]
            lists.append(np.concatenate([[c], cells[cells != c]]))
        return own, lists


def _vectors(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _traverse_batches(index: Index, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                own, lists = index.traverse(unit_vectors(_vectors(b, size)))
                added = [pa.array(own, pa.int32()), pa.array(lists, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*b.columns, *added], [*b.schema.names, "own", "visits"])

    return run


def _forest(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id of the component of each row and column of a link matrix."""
    top = np.iinfo(np.int64).max
    a, b = left.copy(), right.copy()
    while True:
        c = np.minimum(b, np.where(mask, a[:, None], top).min(axis=0))
        d = np.minimum(a, np.where(mask, c, top).min(axis=1))
        if (c == b).all() and (d == a).all():
            return a, b
        a, b = d, c


def _verify_batches(size: int, cells: int, threshold: float):
    """Rows of a unit come together, residents first; visitors pass in blocks."""

    def links(c: int, res: dict, vis: dict) -> Iterator[tuple]:
        mask = vis["x"] @ res["x"].T >= threshold
        back = res["back"][:, vis["own"]].T  # the resident visits the visitor's cell as well: the pair shows up twice
        same = vis["own"] == c
        once = np.where(same[:, None], vis["id"][:, None] > res["id"], ~back | (vis["own"] < c)[:, None])
        mask &= once
        if not mask.any():
            return
        r, s = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
        mask = mask[np.ix_(r, s)]
        a, b = _forest(mask, vis["id"][r], res["id"][s])
        yield vis["id"][r], mask @ res["m"][s], a
        yield res["id"][s], vis["m"][r] @ mask, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, parts, res = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy() for n in ("cell", "s", "t", "asks")], axis=1) if len(batch) else np.zeros((0, 4))
            x = unit_vectors(_vectors(batch, size)) if len(batch) else None
            data = {n: batch.column(n).to_numpy() for n in ("id", "m", "own")}
            edges = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1 if len(batch) else np.array([], int)
            out = []
            for i, j in itertools.pairwise([0, *edges.tolist(), len(batch)]):
                if i == j:
                    continue
                key, asks = tuple(keys[i, :3].tolist()), bool(keys[i, 3])
                if key != unit:
                    unit, parts, res = key, [], None
                part = {n: v[i:j] for n, v in data.items()} | {"x": x[i:j]}
                if not asks:
                    part["back"] = np.zeros((j - i, cells), bool)
                    for k, v in enumerate(batch.column("visits")[i:j].to_pylist()):
                        part["back"][k, v] = True
                    parts.append(part)
                    continue
                if res is None and parts:
                    res = {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}
                if res is not None:
                    for k in range(0, j - i, 1024):
                        out += links(key[0], res, {n: v[k : k + 1024] for n, v in part.items()})
            columns = [np.concatenate(c) if out else np.array([], np.int64) for c in zip(*out)] or [np.array([], np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "n", "root"])

    return run


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, sample: int = SAMPLE
) -> DataFrame:
    """(vec_id, n_links, component_id): one row per row of ``vectors`` (vec_id, embedding).

    Links are the pairs of rows with a cosine of at least ``threshold`` that the traversal finds; equal vectors always link.
    Vectors of different lengths do not link; each length has an index of its own.  A vector that is null, zero or empty, or
    holds null or non-finite components, links with nothing, and so does a row without vec_id (its component is null).
    """
    kind = "float" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "double"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(~bad & F.exists("v", lambda x: x != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    v = v.withColumn("size", F.when(usable, F.size("v")))
    v = v.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(1), "v"))
    out = v.filter("size IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for row in v.filter("size IS NOT NULL").select("size").distinct().orderBy("size").collect():  # the lengths of a model's vectors: few
        out = out.union(_near_of_size(v.filter(F.col("size") == row["size"]), row["size"], kind, threshold, recall, sample))
    return out


def _near_of_size(v: DataFrame, size: int, kind: str, threshold: float, recall: float, sample: int) -> DataFrame:
    """(vec_id, n_links, component_id) of usable vectors of one length."""
    entries = v.groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("m"), F.first("v").alias("v"))
    entries = stage(entries, "entries")
    n = entries.count()
    share = min(1.0, sample / n)
    picked = entries.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20)).select("id", "v").collect() or entries.limit(1).collect()
    picked.sort(key=lambda r: r["id"])
    k = int(min(MAX_CODES, max(MIN_CODES, (n / PER_CELL) ** 0.5)))
    index = Index(unit_vectors(np.array([r["v"] for r in picked], np.float64)), min(k, len(picked)), threshold, recall)
    cells = len(index.codes[0]) * len(index.codes[1])
    placed = entries.select("id", "m", "v").mapInArrow(
        _traverse_batches(index, size), f"id long, m long, v array<{kind}>, own int, visits array<int>"
    )
    placed = stage(placed, "placed")
    visits = placed.select("own", F.explode("visits").alias("cell"))
    parts = visits.groupBy("cell").agg(
        F.ceil(F.sum((F.col("own") == F.col("cell")).cast("long")) / RESIDENTS).cast("int").alias("shards"),
        F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("blocks"),
    )
    parts = F.broadcast(stage(parts.filter("shards > 0"), "parts"))  # at most MAX_CODES squared rows
    row = ["id", "m", "own", "v"]
    ask = placed.select(*row, F.explode("visits").alias("cell")).join(parts, "cell")
    ask = ask.select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("s"), F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("t"),
        F.lit(1).alias("asks"), *row, F.lit(None).cast("array<int>").alias("visits"),
    )
    res = placed.withColumn("cell", F.col("own")).join(parts, "cell")
    res = res.select(
        "cell", F.pmod(F.xxhash64("id", F.lit(1)), "shards").cast("int").alias("s"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("t"), F.lit(0).alias("asks"), *row, "visits",
    )
    dealt = res.union(ask).repartition("cell", "s", "t").sortWithinPartitions("cell", "s", "t", "asks")
    found = stage(dealt.mapInArrow(_verify_batches(size, cells, threshold), "id long, n long, root long"), "found")
    groups = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    count = found.groupBy("id").agg(F.sum("n").alias("n"))
    named = entries.select("k1", "k2", "id", "m").join(count, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left")
    named = stage(named.select(
        "k1", "k2", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    ), "named")
    keys = stage(v.select("vec_id", "k1", "k2"), "keys")
    return keys.join(named, ["k1", "k2"]).select("vec_id", "n_links", "component_id")


ORACLE = """WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
r(vec_id, node) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, p.b FROM r JOIN p ON p.a = r.node),
c AS (SELECT vec_id, min(node) AS component_id FROM r GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY 1)
SELECT c.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, c.vec_id = component_id AS kept
FROM c LEFT JOIN n ON c.vec_id = n.vec_id"""


@query("op1_multi_index", ORACLE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumn("kept", F.col("vec_id") == F.col("component_id"))
