"""Packing of tokenised documents into training sequences of several lengths.

A document is cut into whole windows of the longest tier; what remains is routed to the shortest tier that holds it.
In every tier a remainder takes a window and its gap is filled from the stream of the shortest tier's documents, so
that windows are full; a document of that stream is cut where a gap ends.  What is left is run together in the longest
windows, and only the last one of a shard has padding.  Shards have a bounded number of documents of one task and are independent.
Full windows are dealt to step groups of equal token counts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.registry import query, table
from memberlytics.llm.worker import Known, kept

TIERS = (512, 1024, 2048, 4096)
STEP_TOKENS = 16 * TIERS[-1]
SHARD, SHARD_BYTES = 8192, 16_000_000  # documents of a shard, and bytes of their ids, before it is closed
SHARD_BITS = 14
END_ID = 2
KNOWN, KNOWN_PIECES = 500_000, 250_000  # words, and pre-tokens, of a generation whose ids a worker keeps; it keeps two
# Characters for which lower-casing is the same everywhere and composition changes nothing.
LATIN = regex.compile(r"[\x20-\x7E\u00A1-\u012F\u0131-\u0148\u014A-\u017E]*")
BATCH_BYTES = 2_000_000
SEPARATOR = "\x01"


class _Encoder:
    """Token ids of texts, each distinct blank-separated word encoded once.

    Exact for tokenizers that split at blanks and drop them (normalisation and merges never cross a blank).  New Latin
    words are looked up by their pre-tokens, if the tokenizer lower-cases, splits by a pattern and marks word ends; new
    pre-tokens, and other words, are encoded in long runs.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings of special tokens cross words: a text that holds one, in any case of its letters, is encoded whole.
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.mark = self._ids(SEPARATOR)
        self.known: Known[bytes, bytes] = Known(KNOWN)
        self.pieces: Known[str, bytes] = Known(KNOWN_PIECES)
        self.split, self.final = self._rules()

    def _rules(self):
        """The pattern of pre-tokens, and which ids end one; None if the tokenizer works in another way."""
        rules = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (rules["normalizer"] or {}).get("normalizers", [])]
        parts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        end = rules["model"].get("end_of_word_suffix")
        if steps != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in parts] != ["Split", "ByteLevel"] or not end:
            return None, None
        vocabulary = self.tokenizer.get_vocab()
        final = np.zeros(max(vocabulary.values()) + 1, bool)
        final[[i for token, i in vocabulary.items() if token.endswith(end)]] = True
        return regex.compile(parts[0]["pattern"]["Regex"]), final

    def _learn_latin(self, words: list[bytes], line: str) -> None:
        width = np.dtype(self.dtype).itemsize
        # A word of letters alone, with or without one sign at its end, needs no pattern.
        find = self.split.findall
        split = [
            [w] if w.isalpha() else [w[:-1], w[-1]] if w[:-1].isalpha() and w[-1] in ".,;:!?" else find(w)
            for w in line.lower().split(" ")
        ]
        new = self.pieces.missing(set(chain.from_iterable(split)))
        for k in range(0, len(new), 2000):
            part = new[k : k + 2000]
            ids = np.array(self._ids(" ".join(part)), self.dtype)
            ends = ((np.flatnonzero(self.final[ids]) + 1) * width).tolist()
            if len(ends) != len(part):
                raise ValueError("a pre-token has not one end")
            data, start = ids.tobytes(), 0
            for w, end in zip(part, ends):
                self.pieces.now[w] = data[start:end]
                start = end
        get, known = self.pieces.now.__getitem__, self.known.now
        for w, p in zip(words, split):
            known[w] = get(p[0]) if len(p) == 1 else b"".join(map(get, p))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, words: list[bytes]) -> None:
        if self.split is not None:
            line = b" ".join(words).decode()
            if not LATIN.fullmatch(line):
                latin = [w for w in words if LATIN.fullmatch(w.decode())]
                line = b" ".join(latin).decode()
            else:
                latin = words
            if latin:
                self._learn_latin(latin, line)
            words = [w for w in words if w not in self.known.now]
        plain = [w for w in words if SEPARATOR.encode() not in w] if len(self.mark) == 1 else []
        width = np.dtype(self.dtype).itemsize
        for k in range(0, len(plain), 512):
            part = plain[k : k + 512]
            ids = np.array(self._ids(f" {SEPARATOR} ".join(w.decode() for w in part) + f" {SEPARATOR}"), self.dtype)
            ends = (np.flatnonzero(ids == self.mark[0]) * width).tolist()
            if len(ends) == len(part):
                data, start = ids.tobytes(), 0
                for w, end in zip(part, ends):
                    self.known.now[w] = data[start:end]
                    start = end + width
        for w in words:
            if w not in self.known.now:
                self.known.now[w] = np.array(self._ids(w.decode()), self.dtype).tobytes()

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text and the end id, as little-endian bytes."""
        whole = {i for i, t in enumerate(texts) if t and self._has_special(t)}
        words = [[] if i in whole else (t or b"").split() for i, t in enumerate(texts)]
        self._learn(self.known.missing(set(chain.from_iterable(words))))
        end = np.array([END_ID], self.dtype).tobytes()
        get = self.known.now.__getitem__
        ids = [b"".join(map(get, w)) + end for w in words]
        if whole:
            self.tokenizer.encode_special_tokens = False
            for i in whole:
                found = self.tokenizer.encode(texts[i].decode(), add_special_tokens=False).ids
                ids[i] = np.array(found, self.dtype).tobytes() + end
            self.tokenizer.encode_special_tokens = True
        return ids

    def _has_special(self, text: bytes) -> bool:
        if not any(s[:1] in text for s in self.special):
            return False
        low = text.lower()
        return any(s in low for s in self.special)


def _id_batches(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes], int]]:
    """doc_id, ids as bytes and bytes per id, for batches of bounded size."""
    encoder = kept(("packing", path), lambda: _Encoder(path))
    for b in batches:
        texts = b.column("text").cast(pa.binary())
        step = max(1, int(len(b) * BATCH_BYTES / max(1, b.nbytes)))
        for k in range(0, len(b), step):
            yield b.column("doc_id")[k : k + step], encoder.encode(texts[k : k + step].to_pylist()), np.dtype(encoder.dtype).itemsize


def _meet(stream: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lay documents of these lengths, end to end, into rooms of these lengths, end to end.

    Gives for each piece: document, room, start in the document, offset in the room, length.
    """
    doc_end, room_end = np.cumsum(stream), np.cumsum(room)
    total = min(doc_end[-1] if len(doc_end) else 0, room_end[-1] if len(room_end) else 0)
    cuts = np.unique(np.concatenate([[0, total], doc_end, room_end]))
    cuts = cuts[cuts <= total].astype(np.int64)
    at, length = cuts[:-1], np.diff(cuts)
    d, r = np.searchsorted(doc_end, at, side="right"), np.searchsorted(room_end, at, side="right")
    return d, r, at - (doc_end - stream)[d], at - (room_end - room)[r], length


def plan_shard(n: np.ndarray, tiers: tuple[int, ...] = TIERS) -> dict[str, np.ndarray]:
    """Pieces of documents with these token counts: doc (position), start, length, sequence, offset, window, step."""
    top = tiers[-1]
    whole = n // top
    doc = np.repeat(np.arange(len(n)), whole)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
    parts = [(doc, k * top, np.full(len(doc), top), np.arange(len(doc)), np.zeros(len(doc), np.int64))]
    window = [np.full(len(doc), top)]
    made = len(doc)
    rest = n % top
    short = np.flatnonzero((rest > 0) & (rest <= tiers[0]))
    long = np.flatnonzero(rest > tiers[0])
    tier = np.array(tiers)[np.searchsorted(tiers, rest[long])]
    order = np.argsort(tier - rest[long], kind="stable")  # small gaps first: more windows are filled
    long, tier = long[order], tier[order]
    gap = tier - rest[long]
    filled = int(np.searchsorted(np.cumsum(gap), rest[short].sum(), side="right"))
    own = long[:filled]
    parts.append((own, whole[own] * top, rest[own], made + np.arange(filled), np.zeros(filled, np.int64)))
    d, r, start, offset, length = _meet(rest[short], gap[:filled])
    parts.append((short[d], whole[short[d]] * top + start, length, made + r, rest[own][r] + offset))
    window.append(tier[:filled])
    made += filled
    # The others, from where the stream stopped, fill windows of the longest tier one after the other.
    used = np.bincount(d, weights=length, minlength=len(short)).astype(np.int64)
    left = np.concatenate([short, long[filled:]])
    gone = np.concatenate([used, np.zeros(len(long) - filled, np.int64)])
    left, gone = left[rest[left] > gone], gone[rest[left] > gone]
    size = rest[left] - gone
    count = -(-int(size.sum()) // top)
    d, r, start, offset, length = _meet(size, np.full(count, top))
    parts.append((left[d], whole[left[d]] * top + gone[d] + start, length, made + r, offset))
    window.append(np.full(count, top))
    windows = np.concatenate(window)
    rank = np.argsort(-windows, kind="stable")
    step = np.empty(len(windows), np.int64)
    step[rank] = (np.cumsum(windows[rank]) - windows[rank]) // STEP_TOKENS
    doc, start, length, sequence, offset = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
    return {"doc": doc, "start": start, "length": length, "sequence": sequence, "offset": offset,
            "window": windows[sequence], "step": step[sequence]}


def _pieces(doc_id: pa.Array, ids: list[bytes], width: int, shard: int) -> Iterator[pa.RecordBatch]:
    """The pieces of a shard's documents, in the order of the documents: end to end they are the documents' ids."""
    n = np.array([len(x) // width for x in ids], np.int64)
    p = plan_shard(n)
    order = np.lexsort((p["start"], p["doc"]))
    p = {name: column[order] for name, column in p.items()}
    base = shard << 32
    codes, ends = np.frombuffer(b"".join(ids), f"<u{width}"), np.concatenate([[0], np.cumsum(p["length"])])
    step = max(1, int(len(order) * BATCH_BYTES / max(1, 4 * len(codes) + 72 * len(order))))
    for k in range(0, len(order), step):
        q = {name: column[k : k + step] for name, column in p.items()}
        at = ends[k : k + step + 1]
        wide = pa.py_buffer(codes[at[0] : at[-1]].astype("<u4"))  # four bytes an id, for these pieces only
        cut = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(((at - at[0]) * 4).astype(np.int32)), wide])
        longs = [q["start"], q["length"], n[q["doc"]], base + q["sequence"], q["offset"], q["window"], base + q["step"]]
        columns = [doc_id.take(pa.array(q["doc"])), *map(pa.array, longs)]
        columns.insert(3, cut)
        yield pa.RecordBatch.from_arrays(columns, NAMES)


NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "window", "step"]


def _pack_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        docs, ids, size, made = [], [], 0, 0
        for doc_id, found, width in _id_batches(path, batches):
            docs.append(doc_id)
            ids += found
            size += sum(map(len, found))
            if len(ids) >= SHARD or size >= SHARD_BYTES:
                yield from _pieces(pa.concat_arrays(docs), ids, width, _shard(task, made))
                docs, ids, size, made = [], [], 0, made + 1
        if ids:
            yield from _pieces(pa.concat_arrays(docs), ids, width, _shard(task, made))

    return run


def _shard(task: int, k: int) -> int:
    """A number of 31 bits for the k-th shard of a task."""
    if task >> 31 - SHARD_BITS or k >> SHARD_BITS:
        raise ValueError("too many shards to number")
    return task << SHARD_BITS | k


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Pieces of all rows of ``docs`` with their ids (unsigned little-endian 32-bit) and their place in a sequence.

    Encoding, planning and cutting take place in the task that reads the documents: nothing is shuffled.  A null text is empty:
    its only token is the end id.  A repeated row is packed as often as it occurs, and a row without doc_id like any other.
    Sequences hold ``window`` tokens (a power of two) but for the last of each shard.  Sequences are numbered by task: write the
    result once if it is read several times.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"{c} {'binary' if c == 'ids' else 'long'}" for c in NAMES)
    return d.mapInArrow(_pack_batches(tokenizer), schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pack(table(spark, sf_dir, "documents"), default_tokenizer())
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "step")
