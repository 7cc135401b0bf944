"""Token counts that follow edits without encoding whole documents again.

A document is a row of leaves that end at borders between pre-tokens, so the count of a text is the sum over its leaves; a
binary tree holds the sums of characters and tokens.  All edits of a document are taken together: each finds its leaves by
descent, edits that share leaves form one region, and a region is read from a border that its edits cannot move to the next
old border that still is one (boundary context).  A region is encoded once, cut into leaves anew, and the sums above it follow.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.registry import query, table
from memberlytics.llm.secrets import find_spans

LEAF_CHARS = 512
NEAR = 256  # characters in which a blank is looked for before the pattern is run
LOOK = 3  # characters that a contraction or the end of white space may look ahead
_ENCODINGS: dict[str, object] = {}


def encoding(path: str):
    """The byte-level encoding in a file of ranks."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def _pre_tokens():
    """The encoding's pattern; its white space is Unicode's, which leaves out four control characters that Python counts."""
    if "pattern" not in _ENCODINGS:
        import public_tokenizers
        import regex

        pattern = public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        _ENCODINGS["pattern"] = regex.compile(pattern)
    return _ENCODINGS["pattern"]


def _seen(text: str, at: int) -> int:
    """End of what a pre-token that ends at ``at`` depends on: the white space that follows and ``LOOK`` more characters."""
    while at < len(text) and text[at].isspace():
        at += 1
    return at + LOOK


def _splits_space(before: str, after: str) -> bool:
    """White space at the end of a text is one pre-token, before another character it is two: no cut after it."""
    return before.isspace() and after != "" and (not after.isspace() or "\x1c" <= after <= "\x1f")


def _border(text: str, start: int, at: int) -> int:
    """First border found from ``at`` on; ``start`` is one.  The end of the text if there is no other."""
    blank = text.find(" ", at, at + NEAR)
    if blank > start and not text[blank - 1].isspace():
        return blank  # no pre-token holds a blank after another character
    window = at + NEAR
    while True:
        for m in _pre_tokens().finditer(text, start, window):
            end = m.end()
            if end >= at and (window >= len(text) or _seen(text, end) <= window) and not _splits_space(text[end - 1], text[end : end + 1]):
                return end
        if window >= len(text):
            return len(text)
        window = start + 2 * (window - start)


def _ends_pre_token(text: str, after: str) -> bool:
    """Whether ``text``, which starts at a border, can be cut from ``after``: a pre-token ends there, and does so without ``after`` too."""
    if not text or not after or (after[0] == " " and not text[-1].isspace()):
        return True
    if _splits_space(text[-1], after[0]):
        return False
    ends = (m.end() for m in _pre_tokens().finditer(text + after))
    return next((e for e in ends if e >= len(text)), len(text)) == len(text)


def leaves(text: str, size: int = LEAF_CHARS, after: str = "") -> list[str]:
    """Pieces of about ``size`` characters, cut at borders between pre-tokens; only a longer pre-token makes a much longer piece.

    ``after`` is what follows the text, as far as it matters for its last border.
    """
    whole, out, start = text + after, [], 0
    while len(text) - start > size:
        at = _border(whole, start, start + size)
        if at >= len(text):
            break
        out.append(text[start:at])
        start = at
    return [*out, text[start:]]


class CountTree:
    """Sums of characters and tokens over the leaves of one document."""

    def __init__(self, text: str, encode, tokens: list[int] | None = None, sizes: list[int] | None = None) -> None:
        self.encode = encode
        self.encoded = 0
        if sizes is None:
            parts = leaves(text)
        else:
            ends = [0]
            for n in sizes:
                ends.append(ends[-1] + n)
            parts = [text[a:b] for a, b in zip(ends, ends[1:])]
        self._build(parts, tokens if tokens is not None else [len(encode(p)) for p in parts])

    def _build(self, parts: list[str], counts: list[int]) -> None:
        self.parts = parts
        self.width = 1 << max(0, len(parts) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (p, n) in enumerate(zip(parts, counts)):
            self.chars[self.width + i], self.tokens[self.width + i] = len(p), n
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _find(self, at: int) -> tuple[int, int]:
        """Leaf that holds the character, and the position of the leaf's first one."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if at >= start + self.chars[i] and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return i - self.width, start

    def _put(self, leaf: int, text: str, count: int) -> None:
        self.parts[leaf] = text
        i = self.width + leaf
        self.chars[i], self.tokens[i] = len(text), count
        while i > 1:
            i //= 2
            self._sum(i)

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.parts)

    def leaf_sums(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the leaves that are not empty; one empty leaf if all are."""
        held = [i for i, p in enumerate(self.parts, self.width) if p] or [self.width]
        return [self.chars[i] for i in held], [self.tokens[i] for i in held]

    def _after(self, leaf: int) -> str:
        """What follows a leaf, as far as a pre-token that ends with the leaf depends on it."""
        out, i = "", leaf + 1
        while i < len(self.parts) and _seen(out, 0) > len(out):
            out += self.parts[i]
            i += 1
        return out

    def _context(self, at: int) -> tuple[int, int]:
        """Last leaf, and its position, whose first border no edit from ``at`` on can move."""
        leaf, begin = self._find(max(at - 1, 0))
        while leaf > 0 and begin + _seen(self.parts[leaf] + self._after(leaf), 0) > at:
            leaf -= 1
            begin -= len(self.parts[leaf])
        return leaf, begin

    def _regions(self, edits: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, str, str]]:
        """(first leaf, last leaf, their text after the edits, what follows it)."""
        spans = [(*self._context(s), self._find(max(e - 1, 0))[0]) for s, e, _ in edits]
        k = 0
        while k < len(edits):
            j, (first, begin, last) = k, spans[k]
            last = max(first, last)
            while True:
                while k < len(edits) and spans[k][0] <= last:
                    last = max(last, spans[k][2])
                    k += 1
                old, new, at = "".join(self.parts[first : last + 1]), [], begin
                for s, e, text in edits[j:k]:
                    new += [old[at - begin : s - begin], text]
                    at = e
                now, after = "".join([*new, old[at - begin :]]), self._after(last)
                if _ends_pre_token(now, after):
                    break
                last += 1
            yield first, last, now, after

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces the characters from start to end by the text of each (start, end, text), in positions of the text as it is.

        Positions outside the text mean its ends; an edit that begins within an earlier one begins where that ends.
        Of edits at one place the order given is kept.
        """
        size, free, plain = self.chars[1], 0, []
        for start, end, new in sorted(edits, key=lambda e: e[:2]):
            start = min(max(start, free), size)
            free = min(max(end, start), size)
            plain.append((start, free, new))
        grown = []
        for first, last, text, after in list(self._regions(plain)):
            pieces, room = leaves(text, after=after), last + 1 - first
            if len(pieces) > max(room, 1) and len(pieces[-1]) < LEAF_CHARS // 2:
                pieces[-2:] = ["".join(pieces[-2:])]
            counts = [len(self.encode(p)) for p in pieces]
            self.encoded += len(text)
            if len(pieces) > room:
                grown.append((first, last, pieces, counts))
                continue
            for i in range(room):
                self._put(first + i, *((pieces[i], counts[i]) if i < len(pieces) else ("", 0)))
        if grown:
            parts, sums = self.parts, self.tokens[self.width : self.width + len(self.parts)]
            for first, last, pieces, counts in reversed(grown):
                parts[first : last + 1], sums[first : last + 1] = pieces, counts
            held = [(p, n) for p, n in zip(parts, sums) if p]
            self._build([p for p, _ in held], [n for _, n in held])

    def edit(self, start: int, end: int, new: str) -> None:
        self.apply([(start, end, new)])


def _batches(path: str, keep: list[str], edits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        ints = pa.list_(pa.int32())
        for b in batches:
            texts = b.column("__text").to_pylist()
            if not edits:
                parts = [leaves(t or "") for t in texts]
                tokens = [[len(encode(p)) for p in x] for x in parts]
                added = [pa.array([[len(p) for p in x] for x in parts], ints), pa.array(tokens, ints)]
                names = ["leaf_chars", "leaf_tokens"]
            else:
                rows = []
                for t, sizes, tokens, changes in zip(texts, *(b.column(c).to_pylist() for c in ("__sizes", "__tokens", "__edits"))):
                    before = sum(tokens or [])
                    known = [e for e in changes or [] if e and e["start"] is not None and e["end"] is not None]
                    if not known:
                        rows.append((before, before, 0, t, sizes, tokens))
                        continue
                    tree = CountTree(t or "", encode, tokens, sizes)
                    tree.apply([(e["start"], e["end"], e["text"] or "") for e in known])
                    rows.append((before, tree.total, tree.encoded, tree.text(), *tree.leaf_sums()))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), ints, ints]
                added = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
                names = ["n_tokens", "n_tokens_edited", "n_encoded_chars", "edited_text", "edited_leaf_chars", "edited_leaf_tokens"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *added], [*keep, *names])

    return run


def _fields(df: DataFrame, keep: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)


def with_trees(docs: DataFrame, ranks: str) -> DataFrame:
    """All columns plus leaf_chars and leaf_tokens, the leaves of each row's tree; a null text has one empty leaf.

    Columns of these two names are replaced.
    """
    keep = [c for c in docs.columns if c not in ("leaf_chars", "leaf_tokens")]
    d = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    return d.mapInArrow(_batches(ranks, keep, False), f"{_fields(docs, keep)}, leaf_chars array<int>, leaf_tokens array<int>")


def count_edits(trees: DataFrame, edits: Column, ranks: str, keep: list[str]) -> DataFrame:
    """Counts before and after the edits of each row of ``with_trees``.

    ``edits`` is an array of struct<start,end,text> in positions (code points) of the text as it was.  Null or an empty array changes
    nothing, nor does an edit that is null or lacks a position; a null text of an edit is empty; edits that overlap and positions outside
    the text are read as in ``CountTree.apply``.  A null text without edits stays null.  Repeated rows are edited each on their own.

    Gives ``keep``, n_tokens, n_tokens_edited, n_encoded_chars (never more than the edited text has), edited_text, and
    edited_leaf_chars and edited_leaf_tokens, the tree of the edited text, with which further edits can follow.
    """
    d = trees.select(
        *keep, F.col("text").cast("string").alias("__text"), F.col("leaf_chars").alias("__sizes"),
        F.col("leaf_tokens").alias("__tokens"), edits.alias("__edits"),
    )
    added = "n_tokens long, n_tokens_edited long, n_encoded_chars long, edited_text string, edited_leaf_chars array<int>, edited_leaf_tokens array<int>"
    return d.mapInArrow(_batches(ranks, keep, True), f"{_fields(trees, keep)}, {added}")


def number_edits(text: Column) -> Column:
    """Edits that replace runs of four and more digits by one sign."""
    spans = find_spans(F.coalesce(text, F.lit("")), "[0-9]{4,}")
    return F.transform(spans, lambda s: F.struct(s["start"], s["end"], F.lit("#").alias("text")))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after its long numbers are masked."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_edits(with_trees(docs, path), number_edits(F.col("text")), path, ["doc_id"])
    return counted.select("doc_id", "n_tokens", "n_tokens_edited", "n_encoded_chars", F.crc32("edited_text").alias("edited_crc32"))
