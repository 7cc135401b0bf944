"""Language of a text by a linear-chain conditional random field over its words.

Each word gets label probabilities by forward-backward with learned transitions, so that a word of either language in a
code-switched text follows its neighbours.  A text's language is the label with the largest expected number of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm import crf
from memberlytics.llm.registry import query, table
from memberlytics.llm.worker import kept

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: The fit reads about so many labelled documents of each language, of at most so many characters.
SAMPLE, SAMPLE_CHARS = 200, 8000
BATCH_WORDS = 200_000


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, lang): a hash sample of the labelled documents that are not held out, about ``sample`` per language.

    Documents are chosen by id and text, copies count once, and there are never more than four times as many.
    """
    d = docs.select("doc_id", "text", F.col("lang").alias("lang"))
    d = d.filter(F.col("lang").isNotNull() & (F.length("text") > 0) & (F.length("text") <= SAMPLE_CHARS) & ~held_out(F.col("doc_id")))
    per = {r["lang"]: r["n"] for r in d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # few languages
    if not per:
        return d.select("text", "lang").limit(0)
    share = F.create_map(*[F.lit(x) for k, n in per.items() for x in (k, min(1.0, sample / n))])
    picked = d.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    return picked.select("text", "lang").distinct().limit(4 * sample * len(per))


def fit(sample: DataFrame, rounds: int = 25) -> crf.Model | None:
    """A model from (text, lang) rows, a bounded sample; None if there is no labelled word.

    The sequences are spliced from halves of texts of two languages, so that the transitions learn a rate of change.
    """
    rows = sorted(((r["lang"], r["text"]) for r in sample.collect()))
    words: dict[str, list[str]] = {}
    for lang, text in rows:
        words.setdefault(lang, []).extend(WORD.findall(text.lower()))
    words = {k: v for k, v in words.items() if v}
    labels = sorted(words)
    if not labels:
        return None
    half = crf.LENGTH // 2
    parts = [(i, words[k][j : j + half]) for i, k in enumerate(labels) for j in range(0, len(words[k]), half)]
    order = np.random.default_rng(7).permutation(len(parts))
    texts, tags = [], []
    for k in range(0, len(order), 2):
        pair = [parts[i] for i in order[k : k + 2]]
        texts.append([w for _, p in pair for w in p])
        tags.append([i for i, p in pair for _ in p])
    return crf.train(texts, tags, labels, rounds=rounds)


def _predict(model: crf.Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    kept: list[int] = []
    words: list[list[str]] = []
    many = 0

    def flush() -> None:
        nonlocal kept, words, many
        if kept:
            rows = model.positions(words)
            sizes = np.array([len(w) for w in words], np.int64)
            flat = np.concatenate(rows)
            items, begin, length, own = crf.overlap(sizes)
            none = np.zeros(0, bool)
            gamma = crf.marginals(model, model.emissions(flat, none, none)[items], begin, length)[own]
            share = np.add.reduceat(gamma, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
            best = share.argmax(axis=1)
            for i, b, s in zip(kept, best.tolist(), share.max(axis=1).tolist()):
                lang[i], score[i] = model.labels[b], min(1.0, max(0.0, s))
        kept, words, many = [], [], 0

    for i, text in enumerate(texts):
        found = WORD.findall(text.lower()) if text else []
        if any(map(str.isalpha, found)):
            kept.append(i)
            words.append(found)
            many += len(found)
            if many >= BATCH_WORDS:
                flush()
    flush()
    return lang, score


def predict(
    docs: DataFrame, model: crf.Model | None, keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs``, which has a ``text``, plus the prediction and its score.

    Columns of these two names in ``docs`` give way.
    A null text, or one without a letter, is ``und`` with score 0, and so is everything without a model.
    """
    keep = [c for c in (keep or docs.columns) if c not in names]
    base = docs.select(*keep)
    if model is None:
        return base.withColumn(names[0], F.lit(UNKNOWN)).withColumn(names[1], F.lit(0.0))
    key = hash((model.weights.tobytes(), model.move.tobytes(), *model.labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept(("language", key), lambda: model)  # a worker keeps the scores of the words that it has seen
        for b in batches:
            lang, score = _predict(own, b.column("__text").to_pylist())
            columns = [b.column(c) for c in keep] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, f"{schema}, {names[0]} string, {names[1]} double")


def keep_known(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """Rows whose language is recognised with at least that share of their words; all columns stay.

    Without a labelled word nothing can be recognised, and all rows stay.
    """
    model = fit(labelled_sample(docs))
    if model is None:
        return docs
    p = predict(docs, model, names=("__lang", "__score"))
    return p.filter((F.col("__lang") != UNKNOWN) & (F.col("__score") >= least)).select(*docs.columns)


@query("op7_language_crf")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(labelled_sample(docs))
    p = predict(docs, model, ["doc_id"])
    return p.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
