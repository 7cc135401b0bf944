"""Components, SimHash groups and near-duplicate embeddings against brute force."""

import random

import numpy as np
import pytest

from helpers import ODD, components, documents, simhash
from memberlytics.llm import multi_index, simhash as sh
from memberlytics.llm.components import connected_components


def found(df):
    return {r["node"]: r["component"] for r in df.collect()}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rnd = random.Random(4)
    links = {
        "chain": [(i + 1, i) for i in range(150)],
        "star": [(500, i) for i in range(300)] + [(7, 7), (None, 3), (500, 2)],
        "random": [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)],
        "none": [],
    }[shape]
    real = [(a, b) for a, b in links if a is not None and a != b]
    got = found(connected_components(spark.createDataFrame(links, "a long, b long")))
    assert got == components({n for p in real for n in p}, real)


def near_texts(seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 200))] for _ in range(60)]
    rows, k = [], 100
    for words in base:
        for _ in range(rnd.randrange(1, 5)):
            copy = list(words)
            if rnd.random() < 0.7:
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary).upper()
            rows.append((k, rnd.choice([" ", "\n", "\t "]).join(copy), "en"))
            k += 1
    return rows


def groups_by_force(rows):
    codes = {(i, t): simhash(t) for i, t, _ in rows}
    distinct = sorted(set(codes.values()))
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= 3]
    root = components(distinct, links)
    least = {}
    for (i, _), c in codes.items():
        if i is not None:
            least[root[c]] = min(i, least.get(root[c], i))
    return sorted((str(i), codes[i, t], least.get(root[codes[i, t]])) for i, t, _ in rows)


def test_simhash_groups(spark):
    rows = near_texts() + ODD + [(100, None, "en"), (90, None, None), (94, "Ünï " * 30000, "de")]
    got = sh.simhash_groups(documents(spark, rows)).collect()
    got = sorted((str(r["doc_id"]), r["code"] & (1 << 64) - 1, r["component_id"]) for r in got)
    assert got == groups_by_force(rows)


def test_simhash_shards_lose_nothing(spark):
    rnd = random.Random(2)
    center = rnd.getrandbits(63)
    codes = {center} | {center ^ (1 << rnd.randrange(63)) ^ (1 << rnd.randrange(63)) ^ (1 << rnd.randrange(63)) for _ in range(150)}
    codes |= {rnd.getrandbits(63) for _ in range(100)}
    rows = list(enumerate(sorted(codes)))
    df = spark.createDataFrame(rows, "node long, code long")
    want = [(i, j) for i, a in rows for j, b in rows[:i] if (a ^ b).bit_count() <= 3]
    want = components({n for p in want for n in p}, want)
    for shard in (8, 1024):
        assert found(connected_components(sh.near_links(df, shard=shard))) == want


def test_keep_first(spark):
    rows = near_texts(3) + ODD
    d = documents(spark, rows)
    kept = sh.keep_first(d)
    assert kept.columns == d.columns
    groups = {i: c for i, _, c in groups_by_force(rows)}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(i for i, c in groups.items() if i == "None" or i == str(c))


def test_keep_first_by_row(spark):
    """Rows without an id and repeats of an id are judged one by one."""
    one, two, three, four = (" ".join(f"{w}{i}" for i in range(60)) for w in ("red", "blue", "green", "grey"))
    rows = [(None, one, "en")] * 3 + [(5, one, "en")] + [(7, two, "en")] * 3 + [(None, three, "en")] * 2
    rows += [(9, one, "en"), (9, four, "en")]  # the second one is alone in its group
    kept = sh.keep_first(documents(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted([("5", one), ("7", two), ("None", three), ("9", four)])
    assert sh.keep_first(documents(spark, [])).count() == 0


def test_simhash_empty(spark):
    assert sh.simhash_groups(documents(spark, [])).count() == 0


def vectors(seed=5):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((120, 16))
    rows = [x[i % 120] * rng.uniform(0.5, 4) + 0.12 * rng.standard_normal(16) * (i >= 120) for i in range(400)]
    rows += [rows[0]] * 5 + [x[3] + 0.05 * rng.standard_normal(16) for _ in range(80)]
    rows = [(1000 + i, [float(c) for c in np.float32(v)]) for i, v in enumerate(rows)]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 5, [1e38] * 16, [1e-38] * 16]
    rows += [(i, v) for i, v in enumerate(odd)] + [(None, rows[0][1]), rows[7]]
    return rows


def near_by_force(rows):
    good = [(i, v) for i, v in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    x = multi_index.unit_vectors(np.array([v for _, v in good], np.float32))
    near = x @ x.T >= 0.95
    links = [(good[a][0], good[b][0]) for a, b in zip(*np.nonzero(near))]
    root = components({i for i, _ in good}, links)
    usable = dict(zip(map(id, good), near.sum(axis=1) - 1))
    out = [(i, int(usable[id(g)]), root[i]) for g in good for i in [g[0]]]
    kept = {id(v) for _, v in good}
    out += [(i, 0, i) for i, v in rows if id(v) not in kept or i is None]
    return sorted(map(str, out))


@pytest.mark.parametrize("residents", [1024, 16])
def test_near_vectors(spark, monkeypatch, residents):
    monkeypatch.setattr(multi_index, "RESIDENTS", residents)
    monkeypatch.setattr(multi_index, "VISITORS", 4 * residents)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = multi_index.near_vectors(df).collect()
    assert sorted(str((r["vec_id"], r["n_links"], r["component_id"])) for r in got) == near_by_force(rows)


def test_near_vectors_of_several_lengths_in_double_precision(spark):
    big = [1e300, 2e300, -1e300]
    close = [1.0, 0.0, 0.0], [0.95, (1 - 0.95**2) ** 0.5 * (1 - 1e-12), 0.0], [0.95, (1 - 0.95**2) ** 0.5 * (1 + 1e-9), 0.0]
    rows = [(1, [1.0, 2.0, 3.0, 4.0]), (2, [2.0, 4.0, 6.0, 8.0]), (3, [1.0, 0.0, 0.0, 0.0]), (4, [5.0, 6.0]), (5, [5.0, 6.0]), (6, big), (7, big),
            (8, [7.0]), (9, [1.0]), (10, [-1.0]), *[(11 + i, list(v)) for i, v in enumerate(close)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in multi_index.near_vectors(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 6), 8: (1, 8), 9: (1, 8), 10: (0, 10),
                   11: (1, 11), 12: (2, 11), 13: (1, 11)}


def test_near_vectors_empty(spark):
    for rows in ([], [(1, None), (2, [0.0])]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        assert sorted(map(tuple, multi_index.near_vectors(df).collect())) == [(i, 0, i) for i, _ in rows]


def test_traversal_order():
    x = multi_index.unit_vectors(np.random.default_rng(1).standard_normal((500, 16)))
    index = multi_index.Index(x, 8, 0.95, 0.999)
    own, lists = index.traverse(x[:20])
    for row, (c, cells) in enumerate(zip(own, lists)):
        p, q = index.grid(x[row : row + 1])
        cost = (p[0][:, None] + q[0]).ravel()
        assert cells[0] == c and len(set(cells)) == len(cells)
        assert (np.diff(cost[cells]) >= 0).all() and set(cells) == set(np.flatnonzero(cost <= index.bound))
