"""Ranked search against plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from helpers import ODD, ascii_lower, documents
from memberlytics.llm import ranked_search as rs


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text))


def brute(rows, items, k=20):
    """Sorted (item_id, rank, doc_id, score)."""
    docs = [(i, Counter(w), len(w)) for i, w in ((r[0], plain_terms(r[1])) for r in rows) if w]
    count, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in docs:
            m, score = 75 + 25 * n * count // total, 0
            for t in plain_terms(text):
                if c[t]:
                    score += math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def tables(spark):
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "ümlaut", "naïve", "x1"]
    odds = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(rnd.choices(words, odds, k=rnd.randrange(1, 80))), "en") for i in range(1500)]
    rows += [(2000 + i, "w1, W2; w3!", "en") for i in range(40)] + ODD + [rows[0]] * 3 + [(3000, "w50 " * 60_000, "en"), (None, rows[1][1], None)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randrange(1, 30)))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "?!"), (33, "unheard of"), (34, "w1 W2 w3"), (34, "w1 W2 w3"), (None, "w40 w41"), (35, rows[7][1]), (36, "w50 " * 3000)]
    return rows, items


@pytest.mark.parametrize("shard,block,chars", [(1_000_000, 16, 4_000_000), (300, 1, 4_000_000), (5000, 4, 6000)])
def test_search(spark, monkeypatch, shard, block, chars):
    monkeypatch.setattr(rs, "SLICE_CHARS", chars)
    rows, items = tables(spark)
    search_batches = rs._search_batches

    def small(*args):  # the sizes must hold in the worker as well
        run = search_batches(*args)

        def inner(batches):
            rs.SHARD_POSTINGS, rs.BLOCK = shard, block
            return run(batches)

        return inner

    monkeypatch.setattr(rs, "_search_batches", small)
    got = rs.search(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert got.schema["rank"].dataType.simpleString() == "int"
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, items)


def test_empty_tables(spark):
    rows, items = tables(spark)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert rs.search(documents(spark, []), q).count() == 0
    assert rs.search(documents(spark, ODD[1:4]), q).count() == 0
    assert rs.search(documents(spark, rows[:5]), q.limit(0)).count() == 0
    assert rs.search(documents(spark, rows[:5]), q.filter("item_id IN (30, 31, 32)")).count() == 0


def shard_of(lists):
    """One document per entry: {term: tf}, each of 100 words."""
    size = np.array([len(x) for x in lists])
    term = np.array([t for x in lists for t in x])
    tf = np.array([c for x in lists for c in x.values()])
    n = np.full(len(lists), 100)
    return rs.Shard(np.arange(len(lists)), np.zeros(len(lists), bool), n, size, term, tf, (len(lists), 100 * len(lists)), 3)


def test_best_positions_stop_before_last_read_ones():
    """What list 0 has first, list 1 has next, and the other way round: one reading of both shows twice as many positions."""
    n = rs.BLOCK
    lists = [{0: 100, 1: 50}] * n + [{0: 50, 1: 100}] * n + [{0: 1, 1: 1, 2: 1}] * 400
    shard, best = shard_of(lists), rs.Best(5)
    shard.search(rs.Request(0, np.array([0, 1]), np.array([1, 1])), best)
    imp = lambda c: 10**9 * c // (1000 * c + 1200)
    assert best.score.tolist() == [imp(100) + imp(50)] * 5 and best.doc_id.tolist() == [0, 1, 2, 3, 4]
    assert shard.read == 2 * n and shard.fetched == 4 * n and not shard.known.any() and (shard.slot == -1).all()
    assert 2 * imp(100) >= best.least > 2 * imp(1)  # the bounds by last-read and by best positions


def test_search_of_a_shard_is_exact_and_partial():
    rnd = random.Random(5)
    lists = [{t: rnd.choice([1, 1, 1, 2, 3, 9]) for t in rnd.sample(range(3), rnd.randrange(1, 4))} for _ in range(5000)]
    shard, best = shard_of(lists), rs.Best(5)
    shard.search(rs.Request(0, np.array([0, 1, 2]), np.array([3, 2, 1])), best)
    imp = lambda c: 10**9 * c // (1000 * c + 1200) if c else 0
    scores = sorted((-sum(f * imp(x.get(t, 0)) for t, f in enumerate((3, 2, 1))), i) for i, x in enumerate(lists))
    assert list(zip((-best.score).tolist(), best.doc_id.tolist())) == scores[:5]
    assert shard.read < sum(map(len, lists)) / 2


def test_ties_at_the_stop_are_settled_by_document():
    shard, best = shard_of([{0: 1} for _ in range(1000)]), rs.Best(3)
    shard.doc_id = shard.doc_id[::-1].copy()
    shard.search(rs.Request(0, np.array([0]), np.array([1])), best)
    assert best.doc_id.tolist() == [0, 1, 2]
