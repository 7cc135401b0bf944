"""Personal data: checked patterns, and a linear-chain conditional random field over word shapes that adds to them.

The field labels blank-separated words by their own shape and their neighbours' (``+1 (736) 555-2678`` is ``+d (ddd)
ddd-dddd``).  It is trained on a small labelled table and decoded by Viterbi in numpy batches over whole texts.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm import crf
from memberlytics.llm.registry import query, table
from memberlytics.llm.worker import kept

KINDS = ("email", "ip", "card", "phone")
LABELS = ["none", *KINDS]
#: The fit reads about so many documents with personal data and as many without, of at most so many characters.
SAMPLE, SAMPLE_CHARS = 400, 6000
BATCH_WORDS = 200_000
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits: if its first digit fails, so do the others.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECE = re.compile(r"[^\x20\x09-\x0D,;|]+")  # values of a list or a table row never share one

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Found from their @ signs, which takes one pass however long the words are."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            found.append((start, free))
        at = text.find("@", free)
    return found


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[0::2]) + sum(2 * x - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def rule_spans(text: str) -> list[list[Span]]:
    """Spans of each kind in KINDS."""
    cards = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    phones = []
    if "+" in text:
        phones = [m.span() for m in PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m.group()) <= 15]
    ips = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    return [emails(text), ips, cards, phones]


class _Shapes(dict):
    """Translation of characters: letters to x or X, digits to d, other ASCII as it is."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        shape = "d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() or code > 127 else c
        self[code] = shape
        return shape


_SHAPES = _Shapes()
_RUN = re.compile(r"([xX])\1+|(.)\2{4,}", re.S)


def shape(word: str) -> str:
    """Letters in runs count once, other characters up to four times."""
    return _RUN.sub(lambda m: m.group(1) or m.group(2) * 4, word.translate(_SHAPES))


class _ShapeModel:
    """A model with the shapes of the words that a worker has seen."""

    def __init__(self, model: crf.Model) -> None:
        self.model = model
        self.known: dict[str, str] = {}

    def shapes(self, words: list[list[str]]) -> list[list[str]]:
        new = set().union(*words).difference(self.known)
        if len(self.known) + len(new) > crf.KNOWN:
            self.known, new = {}, set().union(*words)
        self.known.update((w, shape(w)) for w in new)
        return [list(map(self.known.__getitem__, w)) for w in words]

    def tags(self, words: list[list[str]]) -> np.ndarray:
        rows = self.model.positions(self.shapes(words))
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        first, last = np.zeros(int(sizes.sum()), bool), np.zeros(int(sizes.sum()), bool)
        first[ends - sizes], last[ends - 1] = True, True
        items, begin, length, own = crf.overlap(sizes)
        emit = self.model.emissions(np.concatenate(rows), first, last)
        return crf.viterbi(self.model, emit[items], begin, length)[own]


def fit(sample: DataFrame) -> crf.Model | None:
    """A model from a small table with a ``text``: words inside rule spans carry their kind, the others none."""
    texts, tags = [], []
    for r in sorted(r["text"] for r in sample.select("text").collect()):
        words = list(WORD.finditer(r))
        if not words:
            continue
        starts = np.array([m.start() for m in words])
        tag = np.zeros(len(words), np.int64)
        for k, spans in reversed(list(enumerate(rule_spans(r), 1))):
            for a, b in spans:
                tag[max(0, np.searchsorted(starts, a, side="right") - 1) : np.searchsorted(starts, b)] = k
        texts.append([shape(m.group()) for m in words])
        tags.append(tag.tolist())
    if not texts:
        return None
    return crf.train(texts, tags, LABELS, offsets=(0, -1, 1), rounds=40)


def labelled_sample(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text): a hash sample of short documents, about half of them with something that looks like personal data."""
    d = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    d = d.filter((F.length("text") > 0) & (F.length("text") <= SAMPLE_CHARS))
    d = d.withColumn("hit", F.col("text").rlike(r"@[A-Za-z0-9-]+\.|\+[0-9]|[0-9]{4}[ -]?[0-9]{4}|[0-9]\.[0-9]+\.[0-9]"))
    per = {r["hit"]: r["n"] for r in d.groupBy("hit").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("hit"), min(1.0, sample / max(1, per.get(True, 0)))).otherwise(min(1.0, sample / max(1, per.get(False, 0))))
    return d.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)).select("text")


def plausible(kind: int, value: str) -> bool:
    """What the field adds has to pass the value checks of its kind; only the form is free."""
    digits = "".join(c for c in value if c in "0123456789")
    if KINDS[kind] == "email":
        return "@" in value[1:-1]
    if KINDS[kind] == "phone":
        return 8 <= len(digits) <= 15 and not any(map(str.isalpha, value))
    if KINDS[kind] == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and not any(map(str.isalpha, value))
    parts = value.split(".")
    return len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)


def _find(model: _ShapeModel | None, texts: list[str]) -> list[tuple[list[list[Span]], list[list[Span]]]]:
    """Rule spans and added spans of each kind for each text."""
    rules = [rule_spans(t) for t in texts]
    added: list[list[list[Span]]] = [[[] for _ in KINDS] for _ in texts]
    kept: list[int] = []
    words: list[list[str]] = []

    def flush() -> None:
        tags = model.tags(words)
        ends = np.cumsum([len(w) for w in words])
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(tags), side="right")).tolist():
            own = tags[ends[i] - len(words[i]) : ends[i]].tolist()
            _add(texts[kept[i]], own, rules[kept[i]], added[kept[i]])

    if model is not None:
        many = 0
        for i, t in enumerate(texts):
            w = WORD.findall(t)
            if w:
                kept.append(i)
                words.append(w)
                many += len(w)
            if many >= BATCH_WORDS:
                flush()
                kept, words, many = [], [], 0
        if words:
            flush()
    return list(zip(rules, added))


def _trim(text: str, a: int, b: int) -> Span:
    """Without the punctuation around it."""
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return a, b


def _values(text: str, kind: int, pieces: list[Span]) -> list[Span]:
    """Plausible spans in neighbouring pieces of a run: those that hold most, cross fewest list marks and line breaks and are fewest."""
    if KINDS[kind] == "email":  # each has one @ sign
        at = [k for k, (a, b) in enumerate(pieces) if "@" in text[a:b]]
        begin = [0, *[min(k, j + 1 + text[slice(*pieces[j])].endswith("@")) for j, k in zip(at, at[1:])], len(pieces)]
        spans = [_trim(text, pieces[i][0], pieces[j - 1][1]) for i, j in zip(begin, begin[1:]) if i < j]
        return [(a, b) for a, b in spans if plausible(kind, text[a:b])]
    some = [(a, b, n) for a, b in pieces if (n := sum(c in "0123456789" for c in text[a:b]))]
    most = {"phone": 15, "card": 19, "ip": 12}[KINDS[kind]]
    breaks = [0]
    for (_, b, _), (a, _, _) in zip(some, some[1:]):
        breaks.append(breaks[-1] + any(c in ",;|\n\r" for c in text[b:a]))
    # The best of the first pieces: digits left out, breaks crossed, spans, sum of squares (for parts of equal size); last span.
    best: list[tuple] = [(0, 0, 0, 0)]
    last: list[tuple[int, Span] | None] = [None]
    for j, (_, b, own) in enumerate(some):
        score, span = (best[j][0] + own, *best[j][1:]), None
        digits = 0
        for i in range(j, -1, -1):
            digits += some[i][2]
            if digits > most:
                break
            a, z = _trim(text, some[i][0], b)
            if a < z and plausible(kind, text[a:z]):
                x = best[i]
                new = (x[0], x[1] + breaks[j] - breaks[i], x[2] + 1, x[3] + digits * digits)
                if new < score:
                    score, span = new, (i, (a, z))
        best.append(score)
        last.append(span)
    found, j = [], len(some)
    while j:
        if last[j]:
            found.append(last[j][1])
            j = last[j][0]
        else:
            j -= 1
    return found[::-1]


def _add(text: str, tags: list[int], rules: list[list[Span]], added: list[list[Span]]) -> None:
    """The plausible values in runs of one label become spans; what meets a rule span is left out and parts the run."""
    starts, ends = [], []
    for a, b in sorted(s for spans in rules for s in spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    places = [m.span() for m in WORD.finditer(text)]
    k = 0
    while k < len(tags):
        j = k + 1
        while j < len(tags) and tags[j] == tags[k]:
            j += 1
        if tags[k]:
            a, stop = places[k][0], places[j - 1][1]
            near = bisect.bisect_right(ends, a)
            while a < stop:
                b = min(stop, starts[near]) if near < len(starts) else stop
                if a < b:
                    pieces = [m.span() for m in PIECE.finditer(text, a, b)]
                    added[tags[k] - 1] += _values(text, tags[k] - 1, pieces)
                a = max(a, ends[near]) if b < stop else stop
                near += 1
        k = j


def find_personal_data(docs: DataFrame, model: crf.Model | None) -> DataFrame:
    """One row per row of ``docs``: doc_id, and for each kind ``<kind>`` (rule spans) and ``<kind>_crf`` (added spans), arrays of
    struct<start,end> in code points, end exclusive.  A null or blank text has none; without a model nothing is added.
    """
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    names = [*KINDS, *[f"{k}_crf" for k in KINDS]]
    key = 0 if model is None else hash((model.weights.tobytes(), model.move.tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if model is None else kept(("pii", key), lambda: _ShapeModel(model))
        for b in batches:
            found = _find(own, [t or "" for t in b.column("text").to_pylist()])
            columns = [b.column("doc_id")]
            for k in range(2 * len(KINDS)):
                spans = [f[k // len(KINDS)][k % len(KINDS)] for f in found]
                columns.append(pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], pa.list_(span)))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names])

    schema = "doc_id long, " + ", ".join(f"{n} array<struct<start:int,end:int>>" for n in names)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, schema)


def _listing(names: list[str]) -> F.Column:
    def name(n: str):
        return lambda s: F.concat_ws(":", F.lit(n), s["start"], s["end"])

    return F.array_join(F.concat(*[F.transform(F.array_sort(n), name(n)) for n in names]), ",")


@query("op10_pii_crf")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_personal_data(docs, fit(labelled_sample(docs)))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listing(list(KINDS)), 256).alias("base_sha256"), _listing([*KINDS, *[f"{k}_crf" for k in KINDS]]).alias("spans"),
    )
