"""Small tables and plain-Python counterparts for the tests of the text operators."""

import hashlib
import re

import xxhash
from pyspark.sql import functions as F

# Names that the operators use inside: a caller's columns of the same name must not matter.
CLASH = "code node row n w size unit s t own visits start text_key tokens assign hex score k1 m v usable __id __key".split()


def documents(spark, rows):
    """(doc_id, text, lang) rows with extra columns of clashing names."""
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return d.select("*", *[F.lit("x").alias(c) for c in CLASH])


ODD = [(None, "a row without an id", "en"), (90, None, None), (91, "", "en"), (92, " \n\t ", "en"), (93, "... !!! 12", None)]


def components(nodes, links):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


def contaminated(text, items):
    """n_words, n_hit, sorted item ids."""
    w, hit, ids = bench_words(text), set(), set()
    for item_id, item in items:
        b = bench_words(item)
        size = min(10, len(b))
        grams = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)} if size else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in grams:
                hit.update(range(i, i + size))
                ids.add(item_id)
    return len(w), len(hit), sorted(map(str, ids))


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secret_spans(text):
    """(start, kind number, end) of the rules, sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text or "") if len(m.group(2)) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if m.end() - m.start() >= 16]
    return sorted(found)


def personal_spans(text):
    """(kind number, start, end) of the rules, sorted."""
    t, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        found.append((0, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m.group())
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0:
            found.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((3, m.start(), m.end()))
    return sorted(found)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
