"""Conditional random fields and language prediction."""

import itertools
import zlib

import numpy as np

from helpers import ODD, documents
from memberlytics.llm import crf, language


def random_model(seed=0, n=3, offsets=(0, -1, 1)):
    rng = np.random.default_rng(seed)
    shape = (1 << crf.HASH_BITS, n * len(offsets))
    return crf.Model([str(i) for i in range(n)], offsets, rng.normal(size=shape).astype(np.float32) * 0.2, {}, rng.normal(size=n), rng.normal(size=(n, n)))


def test_decoding_against_all_paths():
    model = random_model()
    texts = [["ab", "cde", "x", "ab"], ["q"], ["cde", "zz", "1"]]
    rows = np.concatenate(model.positions(texts))
    sizes = np.array([len(t) for t in texts])
    begin, length = crf.cut(sizes)
    first, last = np.zeros(8, bool), np.zeros(8, bool)
    first[begin], last[begin + length - 1] = True, True
    emit = model.emissions(rows, first, last)
    gamma, best = crf.marginals(model, emit, begin, length), crf.viterbi(model, emit, begin, length)
    for b, m in zip(begin, length):
        e = emit[b : b + m].astype(float)
        total, weight, top = 0.0, np.zeros((m, 3)), (-np.inf, None)
        for path in itertools.product(range(3), repeat=int(m)):
            s = model.start[path[0]] + sum(e[i, k] for i, k in enumerate(path)) + sum(model.move[a, c] for a, c in zip(path, path[1:]))
            total += np.exp(s)
            for i, k in enumerate(path):
                weight[i, k] += np.exp(s)
            top = max(top, (s, path))
        assert np.allclose(gamma[b : b + m], weight / total, atol=1e-5)
        assert tuple(best[b : b + m]) == top[1]


def test_cut_covers_whole_texts():
    sizes = np.array([1, 64, 65, 200, 3])
    begin, length = crf.cut(sizes)
    assert sorted(x for b, m in zip(begin, length) for x in range(b, b + m)) == list(range(sizes.sum()))
    assert (np.diff(length) <= 0).all() and length.max() <= crf.LENGTH


def test_features_do_not_depend_on_company():
    a, _ = crf.features(["word"])
    b, at = crf.features(["other", "word", "x", "\U0001f600é"])
    assert (b[at[1] : at[2]] == a).all() and len(at) == 4


def test_language(spark):
    sf = "/root/testdata/sf0.01"
    from memberlytics.llm.queries import QUERIES

    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op7_language_crf"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held]) > 0.98


def test_language_of_odd_texts(spark):
    rows = [(i, t, k) for i, (t, k) in enumerate([("the house and the dog", "en"), ("das haus und der hund", "de")] * 30)]
    docs = documents(spark, rows + ODD + [(96, "²½ ١٢", "en"), (97, "the das " * 40000, None), (98, "ΑΒΓ", None)])
    model = language.fit(language.labelled_sample(docs))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model, ["doc_id"]).collect()}
    assert all(got[i] == ("und", 0.0) for i in (90, 91, 92, 93, 96))
    assert got[0][0] == "en" and got[1][0] == "de" and got[98][0] in ("de", "en") and 0.3 < got[97][1] < 0.8
    kept = language.keep_known(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {0, 1}
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({90, 91, 92, 93, 96})
    nothing = documents(spark, [])
    assert language.fit(language.labelled_sample(nothing)) is None and language.predict(nothing, model).count() == 0
    assert {r["lang_pred"] for r in language.predict(docs, None).collect()} == {"und"}


def test_documents_without_labels_stay_and_the_sample_is_bounded(spark):
    plain = documents(spark, [(i, f"some words {i}", None) for i in range(5)])
    assert sorted(map(tuple, language.keep_known(plain).collect())) == sorted(map(tuple, plain.collect()))
    rows = [(None, f"text of row {i}", "en") for i in range(3000)] + [(None, "the same text", "de")] * 3000
    got = language.labelled_sample(documents(spark, rows), 100).collect()
    assert len(got) <= 800 and 50 <= sum(r["lang"] == "en" for r in got) <= 200
