"""Ranked lexical search by the Best Position Algorithm over shards of impact lists.

One scan of the documents keeps the terms that the queries hold (a forward index, written once); the corpus statistics are
sums over it.  Tasks read the index and cut it into shards of bounded size, so no list grows with the corpus and
nothing is shuffled but the best rows.  In a shard every query term has its list of (impact, document), highest first.  The
lists of a query are read in step; each document seen is scored at once by direct access to all lists, which also tells
its positions there.  The best position of a list is the end of its unbroken run of seen positions, however they were
seen; what stands behind it bounds every unseen document.  Reading stops when the sum of these bounds is strictly below the
k-th best score, so that ties are settled by document.  The k-th score of earlier shards of the task counts as well.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from memberlytics.llm.registry import query, table
from memberlytics.session import stage

TOP = 20
BLOCK = 16  # positions of each list in the first reading; the next ones double
SHARD_POSTINGS = 1_000_000
SLICE_CHARS = 4_000_000  # characters of query texts a pass
# Fixed values of the score.
SCALE, TF_SCALE, LENGTH_SCALE, LENGTH_PERCENT, WEIGHT_SCALE = 1_000_000_000, 1000, 12, 25, 1000
_BYTES = bytes(range(256))
# A-Z to lower case, ASCII signs to blanks; every other byte belongs to a term.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in _BYTES.lower())


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8: runs of digits, letters and characters beyond ASCII; A-Z in lower case."""
    return (text or b"").translate(_FOLD).split()


class Request(NamedTuple):
    """A query: the numbers of its terms, ascending, and what an impact of each is multiplied with."""

    unit: int
    terms: np.ndarray
    factor: np.ndarray


def _index_batches(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            for k in range(0, len(batch), 1024):
                b = batch.slice(k, 1024)
                n, held, counts = [], [], []
                for text in b.column("text").cast(pa.binary()):
                    found = terms(text.as_py())
                    count = Counter(map(number, found))
                    count.pop(None, None)
                    n.append(len(found))
                    held.append(list(count))
                    counts.append(list(count.values()))
                lists = [pa.array(x, pa.list_(pa.int32())) for x in (held, counts)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    return run


class Shard:
    """Impact lists of some documents, and for each document its place in them."""

    def __init__(self, doc_id: np.ndarray, no_id: np.ndarray, n: np.ndarray, size: np.ndarray, term: np.ndarray, tf: np.ndarray, stats: tuple[int, int], words: int) -> None:
        docs, tokens = stats
        self.doc_id, self.no_id, self.size = doc_id, no_id, size
        self.first = np.cumsum(size) - size  # of each document's postings
        length = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * docs) // tokens
        tf = tf.astype(np.int64)
        self.term, doc = term, np.repeat(np.arange(len(n)), size)
        self.impact = (SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * length[doc])
        order = np.lexsort((-self.impact, term))
        self.list_doc, self.list_impact = doc[order], self.impact[order]
        self.begin = np.searchsorted(term[order], np.arange(words + 1))
        self.position = np.empty(len(term), np.int64)
        self.position[order] = np.arange(len(term)) - self.begin[term[order]]
        self.slot = np.full(words, -1)
        self.known = np.zeros(len(n), bool)
        self.read = self.fetched = 0  # sorted and direct accesses, for measurements

    def search(self, request: Request, best: Best) -> None:
        """Adds the documents of the shard that belong to the best ones of the request."""
        here = self.begin[request.terms + 1] > self.begin[request.terms]
        t, factor = request.terms[here], request.factor[here]
        begin, length = self.begin[t], self.begin[t + 1] - self.begin[t]
        base = np.cumsum(length) - length
        seen = np.zeros(int(length.sum()) + 1, bool)
        self.slot[t] = np.arange(len(t))
        upto, depth, block, touched = np.zeros(len(t), np.int64), 0, BLOCK, []
        while len(t):
            stop = np.minimum(depth + block, length)
            parts = [self.list_doc[b + depth : b + e] for b, e in zip(begin.tolist(), stop.tolist()) if e > depth]
            self.read += sum(map(len, parts))
            new = np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int64)
            new = new[~self.known[new]]
            if len(new):
                self.known[new] = True
                touched.append(new)
                best.offer(self._fetch(new, factor, base, seen), self.doc_id[new], self.no_id[new])
            bound = 0
            for i in range(len(t)):  # the lists of one query
                if upto[i] < length[i]:
                    rest = seen[base[i] + upto[i] : base[i] + length[i]]
                    gap = int(rest.argmin())
                    upto[i] = length[i] if rest[gap] else upto[i] + gap
                    if upto[i] < length[i]:
                        bound += int(factor[i]) * int(self.list_impact[begin[i] + upto[i]])
            if bound == 0 or bound < best.least:
                break
            depth, block = depth + block, block * 2
        self.slot[t] = -1
        for new in touched:
            self.known[new] = False

    def _fetch(self, docs: np.ndarray, factor: np.ndarray, base: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Scores of documents by direct access; marks their positions as seen."""
        size = self.size[docs]
        start = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.first[docs] - start, size)
        slot = self.slot[self.term[at]]
        held = slot >= 0
        seen[base[slot[held]] + self.position[at[held]]] = True
        self.fetched += int(held.sum())
        return np.add.reduceat(np.where(held, factor[slot] * self.impact[at], 0), start)


class Best:
    """The k best documents of one request so far; ``least`` is a score that one of them needs at least."""

    def __init__(self, k: int) -> None:
        self.k, self.least = k, 0
        self.score, self.doc_id, self.no_id = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def offer(self, score: np.ndarray, doc_id: np.ndarray, no_id: np.ndarray) -> None:
        held = score >= max(self.least, 1)
        if not held.any():
            return
        score, doc_id, no_id = (np.concatenate([a, b[held]]) for a, b in ((self.score, score), (self.doc_id, doc_id), (self.no_id, no_id)))
        order = np.lexsort((doc_id, no_id, -score))[: self.k]
        self.score, self.doc_id, self.no_id = score[order], doc_id[order], no_id[order]
        if len(order) == self.k:
            self.least = int(self.score[-1])


def _shards(batches: Iterator[pa.RecordBatch], stats: tuple[int, int], words: int) -> Iterator[Shard]:
    """Shards of SHARD_POSTINGS postings or of one document with more."""
    held, size = [], 0

    def make() -> Shard:
        t = pa.Table.from_batches(held)
        ids, lists, tf = (t.column(c).combine_chunks() for c in ("doc_id", "terms", "tf"))
        none = ids.is_null().to_numpy(zero_copy_only=False)
        return Shard(
            ids.fill_null(0).to_numpy(), none, t.column("n").to_numpy().astype(np.int64), lists.value_lengths().to_numpy().astype(np.int64),
            lists.flatten().to_numpy(), tf.flatten().to_numpy(), stats, words,
        )

    for batch in batches:
        at = 0
        while at < len(batch):
            sizes = np.cumsum(batch.column("terms")[at:].value_lengths().to_numpy())
            take = min(len(sizes), 1 + int(np.searchsorted(sizes, max(SHARD_POSTINGS - size, 0), side="right")))
            held.append(batch.slice(at, take))
            size, at = size + int(sizes[take - 1]), at + take
            if size >= SHARD_POSTINGS:
                yield make()
                held, size = [], 0
    if held:
        yield make()


def _search_batches(requests, stats: tuple[int, int], words: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in requests.value]
        for shard in _shards(batches, stats, words):
            for request, b in zip(requests.value, best):
                shard.search(request, b)
        for part in range(0, len(best), 1000):
            found = list(zip(requests.value[part : part + 1000], best[part : part + 1000]))
            join = lambda xs, kind: np.concatenate([np.empty(0, kind), *xs])
            ids = pa.array(join([b.doc_id for _, b in found], np.int64), mask=join([b.no_id for _, b in found], bool))
            units = join([np.full(len(b.score), r.unit) for r, b in found], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(units), ids, pa.array(join([b.score for _, b in found], np.int64))], ["unit", "doc_id", "score"])

    return run


def _pass(docs: DataFrame, units: list, k: int) -> DataFrame | None:
    """(unit, doc_id, score) of the best documents of each task, for a bounded list of (unit, text)."""
    context = docs.sparkSession.sparkContext
    asked = {r["unit"]: Counter(terms(r["text"].encode())) for r in units}
    words = {w: i for i, w in enumerate(sorted(set().union(*asked.values())))}
    schema = "doc_id long, n long, terms array<int>, tf array<int>"
    index = stage(docs.mapInArrow(_index_batches(context.broadcast(words)), schema), "postings")
    count, tokens = index.agg(F.sum(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    if not count:
        return None
    df = np.zeros(len(words), np.int64)
    for term, held in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row a query term
        df[term] = held
    weight = np.floor(WEIGHT_SCALE * np.log((2 * count + 2) / (2 * df + 1))).astype(np.int64)
    requests = []
    for unit, count_of in asked.items():
        pairs = sorted((words[w], c) for w, c in count_of.items())
        t, c = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.empty(0, np.int64),) * 2
        useful = (df[t] > 0) & (weight[t] > 0)
        requests.append(Request(unit, t[useful], (c * weight[t])[useful]))
    run = _search_batches(context.broadcast(requests), (int(count), int(tokens)), len(words), k)
    return index.filter(F.size("terms") > 0).mapInArrow(run, "unit long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best rows of ``docs`` (doc_id, text) for each row of ``queries`` (item_id, text).

    Scores are above 0; equal ones rank by ascending doc_id, rows without an id last.  Repeated documents rank each, and
    repeated queries, or ones without an id, get rows of their own.  Null and blank texts have no terms: such documents do not
    count, and such queries get no rows, as do all if either table is empty.  Queries beyond SLICE_CHARS take more passes.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    queries = queries.select(F.col("item_id").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    units = stage(queries.select("text").distinct().select("text", F.monotonically_increasing_id().alias("unit")), "units")
    members = stage(queries.join(units, "text").select("unit", "item_id"), "members")
    chars = units.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = -(-chars // SLICE_CHARS)
    found = None
    for s in range(slices):
        part = units.filter(F.pmod(F.xxhash64("unit"), F.lit(slices)) == s).select("unit", "text").collect()  # bounded by SLICE_CHARS
        rows = _pass(docs, part, k) if part else None
        if rows is not None:
            found = rows if found is None else found.union(rows)
    if found is None:
        found = spark.createDataFrame([], "unit long, doc_id long, score long")
    order = Window.partitionBy("unit").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(members, "unit").select("item_id", "rank", "doc_id", "score")


TERMS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE = rf"""WITH d AS (SELECT doc_id, {TERMS_SQL} AS w FROM documents),
s AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS tokens FROM d WHERE len(w) > 0),
p AS (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
i AS (SELECT t.doc_id, t.term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // tokens))) AS part FROM t JOIN f ON t.term = f.term, s),
q AS (SELECT item_id, unnest({TERMS_SQL}) AS term FROM benchmark),
r AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM q JOIN i ON q.term = i.term GROUP BY ALL HAVING sum(part) > 0)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM r) WHERE rank <= 20"""


@query("op13_best_position", ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
