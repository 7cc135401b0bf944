"""Secret scans: fixed rules plus Markov models of characters, all in DataFrame code.

Rules give base spans.  Tokens of 16 and more characters outside them are scored by two first-order character models, one of
random strings and one of ordinary identifiers; the sum of the log-likelihood ratios over the token's character pairs decides.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.registry import query, table
from memberlytics.session import stage

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # runs are maximal, so the runs of 16 and more are the matches that pass
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
N = len(ALPHABET) + 1  # position 0: any other character
#: Log-likelihood ratio from which a token counts as a secret, and the weights of the uniform prior of a character and of
#: the character's own share in the prior of a pair.
THRESHOLD, PRIOR, BACK_OFF = 12.0, 0.5, 4.0
SPAN = "array<struct<start:int,end:int,value:string>>"
BLOCK = 256


def let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def running_total(sizes: Column) -> Column:
    """Sum of the entries before each one.  Two levels of blocks keep the work far below the square of the size."""

    def add(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def of(a: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int"))
        sums = F.transform(blocks, lambda k: add(F.slice(a, k * BLOCK + 1, BLOCK)))
        before = let(sums, lambda s: F.transform(blocks, lambda k: add(F.slice(s, 1, k))))
        part = lambda b, i: F.get(b, F.floor(i / BLOCK).cast("int")) + add(F.slice(a, i - i % BLOCK + 1, i % BLOCK))
        return let(before, lambda b: F.transform(F.sequence(F.lit(0), F.size(a) - 1), lambda i: part(b, i)))

    return F.when(F.size(sizes) > 0, let(sizes, of)).otherwise(F.array().cast("array<int>"))


def find_spans(text: Column, pattern: str, present: Column | None = None) -> Column:
    """Leftmost matches that do not overlap, as structs of start, end (code points) and value.

    The pieces between the matches give the positions: a match starts after all earlier pieces and matches.
    """

    def place(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), F.length)
        own = F.transform(found, F.length)
        starts = let(running_total(F.zip_with(gaps, own, lambda g, m: g + m)), lambda t: F.zip_with(t, gaps, lambda a, g: a + g))
        return F.zip_with(
            starts, found, lambda s, v: F.struct(s.alias("start"), (s + F.length(v)).alias("end"), v.alias("value"))
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    seen = text.rlike(pattern) if present is None else present & text.rlike(pattern)
    return F.when(seen, let(found, place)).otherwise(F.array().cast(SPAN))


def scan_rules(docs: DataFrame) -> DataFrame:
    """Adds assign, access and hex spans and the tokens outside them (all arrays of structs); a null text is empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.withColumn("assign", find_spans(text, ASSIGN)).withColumn("access", find_spans(text, ACCESS, F.contains(text, F.lit("AKIA"))))
    d = d.withColumn("hex", find_spans(text, HEX)).withColumn("tokens", find_spans(text, TOKEN))
    d = d.withColumn("assign", F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 12))
    d = d.withColumn("access", F.filter("access", lambda s: F.length(s["value"]) >= 18))
    rules = F.concat("assign", "access", "hex")
    free = F.filter("tokens", lambda t: ~F.exists(rules, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return d.withColumn("tokens", F.when(F.size("tokens") > 0, free).otherwise(F.array().cast(SPAN)))


def ordinary_forms() -> list[str]:
    """Fixed tokens with digits and signs that are no secrets: numbers of books and cards, dates, times, paths, names."""
    rnd = random.Random(11)
    words = "data user file name index page test model batch image report chapter section config output version backup layer".split()

    def number(n: int) -> str:
        return "".join(rnd.choice("0123456789") for _ in range(n))

    def name(n: int, sign: str) -> str:
        some = [rnd.choice(words) + rnd.choice(["", "", "", number(1), number(2)]) for _ in range(n)]
        return sign.join(w if rnd.random() < 0.8 else number(rnd.choice([1, 2, 4])) for w in some)

    out = []
    for _ in range(200):
        day = f"20{number(2)}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}"
        time = [f"{rnd.randint(0, 23):02d}", f"{rnd.randint(0, 59):02d}", f"{rnd.randint(0, 59):02d}"]
        sign = rnd.choice("-_")
        out += [
            f"97{rnd.choice('89')}-{number(1)}-{number(2)}-{number(6)}-{number(1)}", f"{day}{rnd.choice('_-T')}{sign.join(time)}",
            f"{day.replace('-', '')}{rnd.choice(['', 'T', '_', '-'])}{''.join(time)}{rnd.choice(['', 'Z'])}", f"{day}/{day}",
            "-".join(number(4) for _ in range(4)), number(rnd.randint(16, 20)), "+" + sign.join(number(k) for k in (2, 3, 4, 4)),
            name(4, "_"), name(4, "-"), "/" + name(4, "/"), name(2, "_").upper() + "_" + name(1, "_").upper(),
            "".join(w.title() for w in name(4, " ").split()), "/".join([name(2, "/"), day.replace("-", "/"), name(2, "_")]),
            f"{rnd.choice(['IMG', 'DSC', 'scan'])}_{day.replace('-', '')}_{''.join(time)}", rnd.choice("-=_/+") * rnd.randint(16, 40),
        ]
    return out


def samples(scanned: DataFrame) -> DataFrame:
    """(value, random): values of rule spans with a digit and a letter, against ordinary tokens.

    Ordinary are the fixed forms and the tokens in which no letter meets a digit, whatever digits and signs they hold.  Tokens
    that mix both are what is to be judged: they would speak for themselves.
    """
    value = F.transform("assign", lambda s: F.regexp_extract(s["value"], ASSIGN, 2))
    others = F.transform(F.concat("access", "hex"), lambda s: s["value"])
    bad = scanned.select(F.explode(F.concat(value, others)).alias("value"), F.lit(True).alias("random"))
    good = scanned.select(F.explode(F.transform("tokens", lambda s: s["value"])).alias("value"), F.lit(False).alias("random"))
    forms = scanned.sparkSession.createDataFrame([(v, False) for v in ordinary_forms()], "value string, random boolean")
    return bad.filter("value rlike '[0-9]' AND value rlike '[A-Za-z]'").union(good.filter("NOT value rlike '[A-Za-z][0-9]|[0-9][A-Za-z]'")).union(forms)


def codes(value: Column) -> Column:
    """Numbers of the characters."""
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.instr(F.lit(ALPHABET), F.substr(value, i, F.lit(1))))


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratios of all character pairs from (value, random) rows; zeros unless both kinds occur."""
    c = labelled.filter(F.length("value") > 1).select("random", codes(F.col("value")).alias("c"))
    last = F.size("c") - 2
    pair = F.transform(F.sequence(F.lit(0), last), lambda i: F.get("c", i) * N + F.get("c", i + 1))
    n = c.select("random", F.explode(pair).alias("pair")).groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n"))
    count = np.zeros((2, N, N))
    for r in n.collect():  # at most 2 * N * N rows
        count[int(r["random"]), r["pair"] // N, r["pair"] % N] = r["n"]
    if not count.sum(axis=(1, 2)).all():
        return [0.0] * (N * N)
    single = count.sum(axis=1) + PRIOR
    single /= single.sum(axis=1, keepdims=True)
    # A character that follows one never seen before is judged by its own share.
    log = np.log((count + BACK_OFF * single[:, None, :]) / (count.sum(axis=2, keepdims=True) + BACK_OFF))
    return [float(x) for x in np.round(log[1] - log[0], 9).ravel()]


def score(value: Column, ratios: list[float]) -> Column:
    """Sum of the log-likelihood ratios of the character pairs."""
    table_ = F.lit(ratios)
    total = lambda c: F.aggregate(
        F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda s, i: s + F.get(table_, F.get(c, i - 1) * N + F.get(c, i))
    )
    return F.when(F.length(value) > 1, let(codes(value), total)).otherwise(0.0)


def find_secrets(docs: DataFrame, keep: list[str], labelled: DataFrame | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` plus assign, access, hex and markov span arrays; one row per row.

    ``labelled`` holds (value, random) samples; by default they come from the scan itself, over all documents.
    """
    rules = ["assign", "access", "hex"]
    scanned = stage(scan_rules(docs.select(*keep, "text")).select(*keep, *rules, "tokens"), "scanned")
    ratios = train(labelled if labelled is not None else samples(scanned))
    secret = F.filter("tokens", lambda t: score(t["value"], ratios) >= THRESHOLD)
    found = F.when(F.size("tokens") > 0, secret).otherwise(F.array().cast(SPAN))
    return scanned.withColumn("markov", found).drop("tokens")


def listing(kinds: tuple[str, ...]) -> Column:
    """kind:start:end by start, then kind in the given order, comma-joined."""

    def tag(i: int):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end"))

    tagged = [F.transform(k, tag(i)) for i, k in enumerate(kinds)]
    names = F.array(*[F.lit(k) for k in kinds])
    ordered = F.array_sort(F.concat(*tagged))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def keep_unsecret(docs: DataFrame) -> DataFrame:
    """Rows without any span; all columns stay.  Rows are matched by id and text, so rows without an id are judged too."""
    d = docs.select(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").alias("text"))
    found = find_secrets(d, ["doc_id", "text_key"])
    bad = found.filter(F.size("assign") + F.size("access") + F.size("hex") + F.size("markov") > 0)
    bad = stage(bad.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "secret")
    same = docs["doc_id"].eqNullSafe(bad["__id"]) & (F.xxhash64(docs["text"]) == bad["__key"])
    return docs.join(bad, same, "left_anti")


@query("op8_secrets_markov")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listing(KINDS[:3]), 256).alias("base_sha256"), listing(KINDS).alias("spans"),
    )
