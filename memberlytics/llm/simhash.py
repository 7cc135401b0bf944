"""SimHash near-duplicate groups: 64-bit fingerprints of word shingles, linked through BK-trees.

Fingerprints with at most ``radius`` differing bits agree entirely in some of ``blocks`` bit blocks, so equal block
values route them to the same bucket.  A bucket is searched with a BK-tree (children keyed by the Hamming distance to
their parent; only edges within the radius of the query's distance are followed).  A bucket larger than ``shard`` is cut
into shards; each pair of shards is a unit of its own, so no task holds more than two shards.  Equal fingerprints are
one node.  Each unit reduces its links to a forest before it emits them; nothing is lost by that.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.components import connected_components
from memberlytics.llm.registry import query, table
from memberlytics.session import stage

WORDS_PER_SHINGLE = 3
SEED = 42
RADIUS = 3
SHARD = 1024
# (blocks, blocks that must agree): all lose nothing at radius 3; finer ones make smaller buckets and more copies.
LAYOUTS = ((4, 1), (5, 2), (6, 3))
MEAN_BUCKET = 16


def fingerprint(text: bytes | None, width: int = WORDS_PER_SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the hashes of the shingles, repeats included; no words give 0."""
    parts = (text or b"").lower().split()  # on bytes: A-Z only, and the ASCII blanks only
    if not parts:
        return 0
    joined = b" ".join(parts)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(size + 1) - 1
    start = end - size
    if len(parts) > width:
        start, end = start[: len(parts) - width + 1], end[width - 1 :]
    else:
        start, end = start[:1], end[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(start.tolist(), end.tolist())], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        block = hashes[k : k + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        codes = pa.array([fingerprint(t) for t in texts.to_pylist()], pa.int64())
        kept = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], codes], [*kept, "code"])


def fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, ``keep``, code): the fingerprint as a signed long, one row per row of ``docs``; ``keep`` are longs."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_fingerprint_batches, ", ".join(f"{n} long" for n in ("doc_id", *keep, "code")))


class _Tree:
    """A BK-tree over 64-bit codes, with the position of each code."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, code: int, radius: int) -> list[int]:
        found, open_ = [], [0] if self.codes else []
        while open_:
            at = open_.pop()
            d = (self.codes[at] ^ code).bit_count()
            if d <= radius:
                found.append(at)
            below = self.children[at]
            if below:
                open_ += [below[e] for e in range(d - radius, d + radius + 1) if e in below]
        return found

    def add(self, code: int) -> None:
        if self.codes:
            at = 0
            while True:
                d = (self.codes[at] ^ code).bit_count()
                if d not in self.children[at]:
                    self.children[at][d] = len(self.codes)
                    break
                at = self.children[at][d]
        self.codes.append(code)
        self.children.append({})


def _links(codes: list[int], nodes: list[int], query: list[bool], radius: int) -> list[tuple[int, int]]:
    """Forest of the links of a unit.  With no queries each code is looked up among those before it."""
    tree, members = _Tree(), []
    root = list(range(len(codes)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    within = not any(query)
    for i in sorted(range(len(codes)), key=lambda i: query[i]):
        if within or query[i]:
            for k in tree.near(codes[i], radius):
                x, y = top(i), top(members[k])
                if nodes[x] < nodes[y]:
                    x, y = y, x
                root[x] = y
        if not query[i]:
            tree.add(codes[i])
            members.append(i)
    return [(nodes[i], nodes[top(i)]) for i in range(len(codes)) if top(i) != i]


def _unit_batches(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                c = [b.column(n).to_pylist() for n in ("unit", "s", "t", "code", "node", "asks")]
                yield from zip(*c)

        out: list[tuple[int, int]] = []
        for _, group in itertools.groupby(rows(), key=lambda r: r[:3]):
            group = list(group)
            if len(group) > 1:
                mask = (1 << 64) - 1
                out += _links([r[3] & mask for r in group], [r[4] for r in group], [r[5] for r in group], radius)
            if len(out) > 50_000:
                yield _edges(out)
                out = []
        yield _edges(out)

    return run


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"]
    )


def _routes(blocks: int, agree: int):
    """Columns: one bucket number per choice of agreeing blocks."""
    cut = [round(i * 64 / blocks) for i in range(blocks + 1)]
    for k, chosen in enumerate(itertools.combinations(range(blocks), agree)):
        value = F.lit(k).cast("long")
        for i in chosen:
            width = cut[i + 1] - cut[i]
            part = F.shiftrightunsigned("code", cut[i]).bitwiseAND(F.lit((1 << width) - 1))
            value = F.shiftleft(value, width).bitwiseOR(part)
        yield value


def near_links(codes: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(node, code), each code once -> (a, b): links whose components are those of all pairs within the radius."""
    n = codes.count()
    layout = next((x for x in LAYOUTS if n * 2.0 ** -(64 * x[1] / x[0]) <= MEAN_BUCKET), LAYOUTS[-1])
    blocks, agree = layout[0] + radius - RADIUS, layout[1]
    routed = codes.select("node", "code", F.explode(F.array(*_routes(blocks, agree))).alias("unit"))
    size = routed.groupBy("unit").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > shard)
    parts = stage(size.select("unit", F.ceil(F.col("size") / shard).cast("int").alias("parts")), "buckets")
    routed = routed.join(parts, "unit", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("code"), F.col("parts")).cast("int")
    # One copy for each unit (s, t), s <= t, of the own shard; the larger shard asks, the smaller one is the tree.
    dealt = routed.withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"))
    dealt = dealt.select(
        "unit", F.least("own", "with").alias("s"), F.greatest("own", "with").alias("t"), "code", "node",
        (F.col("own") > F.col("with")).alias("asks"),
    )
    ordered = dealt.repartition("unit", "s", "t").sortWithinPartitions("unit", "s", "t")
    return ordered.mapInArrow(_unit_batches(radius), "a long, b long")


def simhash_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, code, component_id), one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable by links between fingerprints with at most ``radius`` differing
    bits.  A null or blank text has fingerprint 0 and links like any other.  A row without doc_id keeps its fingerprint and
    passes links on; it never names a group, and its component is null only if no row of the group has an id.
    """
    seen = stage(fingerprints(docs), "fingerprints")
    nodes = seen.groupBy("code").agg(F.min("doc_id").alias("least_id"))
    # A code is its own node: documents without an id still connect others.
    nodes = stage(nodes.select("code", "least_id", F.col("code").alias("node")), "codes")
    found = connected_components(near_links(nodes.select("node", "code"), radius))
    linked = stage(nodes.join(found, "node", "left").select("code", "least_id", F.coalesce("component", "node").alias("root")), "roots")
    names = stage(linked.groupBy("root").agg(F.min("least_id").alias("component_id")), "names")
    named = stage(linked.join(names, "root").select("code", "component_id"), "named")
    return seen.join(named, "code").select("doc_id", "code", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """Documents with one row left of each near-duplicate group; all columns stay.

    The row with the smallest doc_id stays; of several rows with that id, or if no row of the group has an id, any one.
    """
    rows = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")  # written, so that the numbers are fixed
    seen = stage(fingerprints(rows, "__row"), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")).alias("first")
    nodes = stage(seen.groupBy("code").agg(first).select("code", F.col("code").alias("node"), "first"), "codes")
    found = connected_components(near_links(nodes.select("node", "code")))
    named = nodes.join(found, "node", "left").select(F.coalesce("component", "node").alias("root"), "first")
    stays = named.groupBy("root").agg(F.min("first").alias("first")).select("first.__row")
    drop = stage(seen.select("__row").join(stays, "__row", "left_anti").withColumnRenamed("__row", "__drop"), "repeats")
    return rows.join(drop, rows["__row"] == drop["__drop"], "left_anti").select(*docs.columns)


@query("op9_simhash_bk")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash_groups(table(spark, sf_dir, "documents"))
    return g.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
