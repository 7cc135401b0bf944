"""Packing, token counts, preference pairs and the pipeline."""

import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import ODD, contaminated, documents, secret_spans, simhash
from memberlytics.llm import packing, preferences, token_counts, worker


def check_places(pieces):
    """Offsets are gapless; a sequence ends at a power of two, but for one per shard.  Gives the pieces by sequence."""
    by = defaultdict(list)
    for sequence, offset, length in pieces:
        by[sequence].append((offset, length))
    uneven = defaultdict(int)
    for sequence, parts in by.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= packing.TIERS[-1]
        uneven[sequence >> 32] += end & (end - 1) != 0
    assert all(n <= 1 for n in uneven.values())
    return by


@pytest.mark.parametrize("seed", range(40))
def test_plan_shard(seed):
    rng = np.random.default_rng(seed)
    k = int(rng.integers(0, 80))
    n = rng.choice([1, 2, 511, 512, 513, 1024, 2100, 4095, 4096, 4097, 9000], k) if seed % 2 else rng.integers(1, 6000, k)
    p = packing.plan_shard(n.astype(np.int64))
    by = check_places(zip(p["sequence"].tolist(), p["offset"].tolist(), p["length"].tolist()))
    assert set(by) == set(range(len(by)))
    ends = defaultdict(int)
    for d, s, m in sorted(zip(p["doc"].tolist(), p["start"].tolist(), p["length"].tolist())):
        assert s == ends[d]
        ends[d] += m
    assert [ends[i] for i in range(k)] == n.tolist()
    full = defaultdict(set)
    for s, w, q in zip(p["step"].tolist(), p["window"].tolist(), p["sequence"].tolist()):
        full[s].add((q, w))
    sizes = [sum(w for _, w in x) for _, x in sorted(full.items())]
    assert all(x == packing.STEP_TOKENS for x in sizes[:-1])


def test_encoder_is_exact():
    encoder = packing._Encoder(packing.default_tokenizer())
    plain = Tokenizer.from_file(packing.default_tokenizer())
    rnd = random.Random(3)
    alphabet = "abcXYZ éÉçñÑßİıŉſ'’\"-.,;:0123456789²½ \n\t ­́̇ΣσςЖ中😀\x01\x1cK'sS've<|>"
    texts = ["".join(rnd.choices(alphabet, k=rnd.randrange(60))) for _ in range(3000)] + ["<|endoftext|> it's I'LL", "", "'sa ''s 's's"]
    texts += ["a<|endoftext|>b <|startoftext|><|ENDOFTEXT|>", "<|endof text|> <|endoftext|", "x<|StartOfText|>" * 50, "é<|endoftext|≯"]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        want = plain.encode(text, add_special_tokens=False).ids + [packing.END_ID]
        assert np.frombuffer(ids, encoder.dtype).tolist() == want


def test_pack_round_trip(spark):
    rows = [(i, f"Some words, number {i}. " * (i * 7 % 50), "en") for i in range(80)] + ODD + [(3, "repeated", "en"), (99, "long text " * 30000, "en")]
    got = packing.pack(documents(spark, rows), packing.default_tokenizer()).collect()
    check_places([(r["sequence_id"], r["offset"], r["length"]) for r in got])
    plain = Tokenizer.from_file(packing.default_tokenizer())
    want = defaultdict(list)
    for i, t, _ in rows:
        want[i].append(plain.encode(t or "", add_special_tokens=False).ids + [packing.END_ID])
    for i, texts in want.items():
        pieces = [r for r in got if r["doc_id"] == i]
        assert sum(r["length"] for r in pieces) == sum(map(len, texts))
        if len(texts) == 1:
            ids = [x for r in sorted(pieces, key=lambda r: r["start"]) for x in np.frombuffer(r["ids"], "<u4").tolist()]
            assert ids == texts[0] and {r["doc_tokens"] for r in pieces} == {len(ids)}
    assert packing.pack(documents(spark, []), packing.default_tokenizer()).count() == 0


def test_pack_moves_no_rows(spark):
    """Documents are encoded, planned and cut by the task that reads them, and tasks share no sequence number."""
    rows = [(i, "word " * (i % 9 * 300), "en") for i in range(60)]
    packed = packing.pack(documents(spark, rows), packing.default_tokenizer())
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    places = packed.select("sequence_id", "offset", "length", F.spark_partition_id().alias("task")).collect()
    check_places([(r["sequence_id"], r["offset"], r["length"]) for r in places])
    tasks = defaultdict(set)
    for r in places:
        tasks[r["sequence_id"]].add(r["task"])
    assert all(len(t) == 1 for t in tasks.values()) and len(set.union(*tasks.values())) > 1


@pytest.mark.parametrize("limit", [("SHARD", 7), ("SHARD_BYTES", 3000)])
def test_shards_of_a_task(monkeypatch, limit):
    monkeypatch.setattr(packing, *limit)
    monkeypatch.setattr(packing.TaskContext, "get", staticmethod(lambda: type("task", (), {"partitionId": lambda self: 5})()))
    texts = [None, "", *[" ".join(f"w{j}" for j in range(i * 37 % 700)) for i in range(50)], "long " * 9000]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [None if i == 3 else i for i in range(k, k + 9)], "text": texts[k : k + 9]},
                                          pa.schema([("doc_id", pa.int64()), ("text", pa.string())])) for k in range(0, 45, 9)]
    batches.append(pa.RecordBatch.from_pydict({"doc_id": list(range(45, len(texts))), "text": texts[45:]}))
    got = [r for b in packing._pack_batches(packing.default_tokenizer())(iter(batches)) for r in b.to_pylist()]
    check_places([(r["sequence_id"], r["offset"], r["length"]) for r in got])
    assert len({r["sequence_id"] >> 32 for r in got}) > 3
    plain = Tokenizer.from_file(packing.default_tokenizer())
    for i, text in enumerate(texts):
        mine = sorted((r for r in got if r["doc_id"] == (None if i == 3 else i)), key=lambda r: r["start"])
        ids = [x for r in mine for x in np.frombuffer(r["ids"], "<u4").tolist()]
        assert ids == plain.encode(text or "", add_special_tokens=False).ids + [2] and {r["doc_tokens"] for r in mine} == {len(ids)}


def test_a_shard_is_cut_part_by_part():
    """The ids of a shard are joined once; only the pieces of a part are widened to four bytes an id."""
    one = np.arange(40_000, dtype="<u2").tobytes()
    ids, docs = [one] * 200, pa.array(range(200), pa.int64())
    tracemalloc.start()
    parts = rows = 0
    for b in packing._pieces(docs, ids, 2, 1):
        parts, rows = parts + 1, rows + sum(b.column("length").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 200 * 40_000 and parts > 5 and peak < 2 * 200 * len(one)


def test_a_worker_keeps_the_tables_of_one_operator(monkeypatch):
    monkeypatch.setattr(worker, "_kept", {})
    first = worker.kept("language", list)
    assert worker.kept("language", list) is first
    path = packing.default_tokenizer()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["some words"]})
    assert [x for _, x, _ in packing._id_batches(path, iter([batch]))] and list(worker._kept) == [("packing", path)]
    assert worker.kept("language", list) is not first and list(worker._kept) == ["language"]


def test_known_words_are_bounded_and_frequent_ones_stay(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 40)
    monkeypatch.setattr(packing, "KNOWN_PIECES", 30)
    encoder, plain = packing._Encoder(packing.default_tokenizer()), Tokenizer.from_file(packing.default_tokenizer())
    learned = []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: (learned.extend(words), learn(words)))
    for k in range(60):
        text = "often " + " ".join(f"w{k}x{j}," for j in range(15)) + " élan Ж"
        want = plain.encode(text, add_special_tokens=False).ids + [packing.END_ID]
        assert np.frombuffer(encoder.encode([text.encode()])[0], encoder.dtype).tolist() == want
        assert len(encoder.known.now) + len(encoder.known.old) <= 2 * 40
    assert learned.count(b"often") == 1 and learned.count(b"w3x3,") == 1


def test_pack_query(spark):
    from memberlytics.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    plain = Tokenizer.from_file(packing.default_tokenizer())
    ids = {r["doc_id"]: plain.encode(r["text"], add_special_tokens=False).ids + [2] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op3_packing"](spark, sf).collect()
    for r in got:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert sum(r["length"] for r in got) == sum(map(len, ids.values()))


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("seed", range(30))
def test_edits_count_like_a_recount(seed):
    rnd = random.Random(seed)
    encode = token_counts.encoding(RANKS).encode_ordinary
    piece = lambda k: "".join(rnd.choices(["ab", " ", "  ", "\n", "'s", "9", "é", " ", "\x1c", ".", " The"], k=k))
    text = piece(rnd.choice([0, 5, 900]))
    tree = token_counts.CountTree(text, encode)
    for _ in range(25):
        a = rnd.randrange(len(text) + 1)
        b = min(len(text), a + rnd.choice([0, 1, 3, 40, 700]))
        new = piece(rnd.choice([0, 1, 6]))
        text = text[:a] + new + text[b:]
        tree.edit(a, b, new)
        assert tree.text() == text and tree.total == len(encode(text))


def test_edits_touch_little():
    encode = token_counts.encoding(RANKS).encode_ordinary
    tree = token_counts.CountTree("some words here " * 20000, encode)
    tree.edit(100_000, 100_005, "other")
    assert 0 < tree.encoded < 4 * token_counts.LEAF_CHARS


@pytest.mark.parametrize("seed", range(40))
def test_edits_taken_together(seed):
    """Many edits at once, texts with and without blanks: counts of a recount, and each character is encoded once at most."""
    rnd = random.Random(seed)
    encode = token_counts.encoding(RANKS).encode_ordinary
    signs = ["ab", "1", "。", "é", "'", "re", "中", "\x1c"] if seed % 2 else ["ab", " ", "  ", "\n", "'s", "9", "é", "'", "ra", "\x1c", ".", "\u3000"]
    piece = lambda k: "".join(rnd.choices(signs, k=k))
    text = piece(rnd.choice([0, 20, 3000, 9000]))
    if seed % 5 == 4:
        text = text[:2000] + " " * 1500 + text[2000:4000] + "z" * 3000 + "\n" * 700 + text[4000:]
    tree = token_counts.CountTree(text, encode)
    for _ in range(4):
        places = sorted(rnd.randrange(len(text) + 1) for _ in range(2 * rnd.choice([1, 4, 60])))
        edits = [(a, rnd.choice([a, min(a + 2, b), b]) if b - a < 900 else a, piece(rnd.choice([0, 1, 5, 1200]) if a % 7 == 0 else 1))
                 for a, b in zip(places[::2], places[1::2])]
        for a, b, new in reversed(sorted(edits, key=lambda e: e[:2])):
            text = text[:a] + new + text[b:]
        before = tree.encoded
        tree.apply(edits)
        assert tree.text() == text and tree.total == len(encode(text)) and tree.encoded - before <= len(text)
        sizes, tokens = tree.leaf_sums()
        assert sum(sizes) == len(text) and sum(tokens) == tree.total
        tree = token_counts.CountTree(text, encode, tokens, sizes) if rnd.random() < 0.5 else tree


def test_edits_without_blanks_and_close_together():
    encode = token_counts.encoding(RANKS).encode_ordinary
    text = "中文字。ab1," * 20000
    tree = token_counts.CountTree(text, encode)
    tree.edit(100_000, 100_001, "x")
    assert 0 < tree.encoded < 4 * token_counts.LEAF_CHARS and tree.total == len(encode(tree.text()))
    dense = "1234," * 400
    tree = token_counts.CountTree(dense, encode)
    tree.apply([(5 * i, 5 * i + 4, "#") for i in range(400)])
    assert tree.text() == "#," * 400 and tree.encoded == 800 and tree.total == len(encode("#," * 400))
    tree.apply([(3, 2, "late"), (0, 9, "a"), (4, 6, "b"), (10**9, -5, "end")])
    assert tree.text() == "alateb" + ("#," * 400)[9:] + "end" and tree.total == len(encode(tree.text()))


def test_growing_leaves_split():
    encode = token_counts.encoding(RANKS).encode_ordinary
    tree = token_counts.CountTree("one two", encode)
    for i in range(200):
        tree.edit(3, 3, f" and {i} words more" * 3)
    assert max(map(len, tree.parts)) < 4 * token_counts.LEAF_CHARS and tree.total == len(encode(tree.text()))


def test_token_counts_query(spark):
    """The registered query against a plain recount of every document."""
    import re
    import zlib

    sf = "/root/testdata/sf0.001"
    encode = token_counts.encoding(RANKS).encode_ordinary
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        edited = None if r["text"] is None else re.sub("[0-9]{4,}", "#", r["text"])
        crc = None if edited is None else zlib.crc32(edited.encode())
        want.append((r["doc_id"], len(encode(r["text"] or "")), len(encode(edited or "")), crc, len(edited or "")))
    got = {r["doc_id"]: r for r in token_counts.op4(spark, sf).collect()}
    assert len(got) == len(want) and any(r["n_encoded_chars"] for r in got.values())
    for i, n, m, crc, size in want:
        assert (got[i]["n_tokens"], got[i]["n_tokens_edited"], got[i]["edited_crc32"]) == (n, m, crc)
        assert got[i]["n_encoded_chars"] <= size


def test_count_edits(spark):
    rows = [(i, f"text 12345 and {i} and 987654321 " * i, "en") for i in range(1, 30)] + ODD + [(2, "again 5555", "en")]
    docs = documents(spark, rows)
    trees = token_counts.with_trees(docs, RANKS)
    got = token_counts.count_edits(trees, token_counts.number_edits(F.col("text")), RANKS, ["doc_id", "text"]).collect()
    encode = token_counts.encoding(RANKS).encode_ordinary
    assert len(got) == len(rows)
    for r in got:
        assert r["n_tokens"] == len(encode(r["text"] or "")) and r["n_tokens_edited"] == len(encode(r["edited_text"] or ""))
        assert (r["edited_text"] is None) == (r["text"] is None)
    assert any(r["n_encoded_chars"] for r in got) and token_counts.with_trees(docs.limit(0), RANKS).count() == 0
    odd = "array(null, struct(null AS start, 2 AS end, 'x' AS text), struct(0 AS start, 4 AS end, cast(null AS string) AS text))"
    for r in token_counts.count_edits(trees, F.expr(odd), RANKS, ["text"]).collect():
        assert (r["edited_text"] or "") == (r["text"] or "")[4:] and sum(r["edited_leaf_tokens"]) == r["n_tokens_edited"]
        assert sum(r["edited_leaf_chars"]) == len(r["edited_text"] or "") and r["n_tokens_edited"] == len(encode(r["edited_text"] or ""))


def pairs_by_force(chosen, rejected):
    out = []
    for pair in sorted({p for p, *_ in chosen} & {p for p, *_ in rejected}):
        a, b = ({t: (r or "", x or "") for p, t, r, x in side if p == pair} for side in (chosen, rejected))
        split = min((t for t in a.keys() | b.keys() if a.get(t) != b.get(t)), default=None)
        if split is None:
            continue
        for part, side in (("prompt", a), ("chosen", a), ("rejected", b)):
            for t, (role, text) in side.items():
                if (t < split) == (part == "prompt"):
                    line = f"<|{role}|>\n{text}<|end|>\n"
                    on = part != "prompt" and role == "assistant"
                    out.append((pair, part, t, role, line, len(role) + 5 if on else 0, len(role) + 5 + len(text) if on else 0))
    return sorted(out)


def test_preferences(spark):
    rnd = random.Random(6)
    chosen, rejected = [], []
    for p in range(40):
        talk = [(p, t, ["user", "assistant"][t % 2], rnd.choice(["a", "é b", None, ""])) for t in range(rnd.randrange(1, 9))]
        chosen += talk
        cut = rnd.randrange(len(talk) + 1)
        rejected += talk[:cut] + [(p, t, "assistant", "other") for t in range(cut, rnd.randrange(cut, cut + 3))]
    chosen += [(None, 1, "user", "x"), (77, 0, "user", "only here"), (88, 0, None, None), (89, 1, "user", "late")]
    rejected += [(88, 0, "assistant", "y"), (89, 0, "user", "early"), (90, None, "user", "x")]
    schema = "pair_id long, turn long, role string, text string"
    a, b = (spark.createDataFrame(x, schema).withColumn("split", F.lit(1)).withColumn("part", F.lit("x")) for x in (chosen, rejected))
    got = preferences.format_pairs(a, b).collect()
    known = [[x for x in side if x[0] is not None and x[1] is not None] for side in (chosen, rejected)]
    assert sorted(map(tuple, got)) == pairs_by_force(*known)
    assert preferences.format_pairs(a.limit(0), b).count() == 0


@pytest.mark.parametrize("name", ["op1_multi_index", "op2_decontaminate", "op5_preferences", "op6_licences"])
def test_queries_with_sql(spark, name):
    from compare import connect, rows_of
    from memberlytics.llm.queries import ORACLES, QUERIES

    sf = "/root/testdata/sf0.001"
    df = QUERIES[name](spark, sf)
    want = connect(sf).execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, want.fetchall())


def test_pipeline_stages(spark):
    """Each stage against a brute-force version of its decision, on what the stage before it kept."""
    import corpus_pipeline
    from memberlytics.llm import language
    from test_near_duplicates import groups_by_force

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    kept = stages["language"](spark, docs, sf)
    predicted = language.predict(docs, language.fit(language.labelled_sample(docs))).collect()
    assert set(ids(kept)) == {r["doc_id"] for r in predicted if r["lang_pred"] != "und" and r["score"] >= 0.4}
    assert kept.columns == docs.columns
    before = ids(kept)
    kept = stages["near_duplicates"](spark, kept, sf)
    groups = groups_by_force([(i, t, None) for i, t in before.items()])
    assert {str(i) for i in ids(kept)} == {i for i, _, c in groups if i == str(c)}
    before = ids(kept)
    kept = stages["decontamination"](spark, kept, sf)
    assert set(ids(kept)) == {i for i, t in before.items() if not contaminated(t, items)[1]}
    before = ids(kept)
    kept = stages["secrets"](spark, kept, sf)
    clean = {i for i, t in before.items() if not secret_spans(t)}
    assert set(ids(kept)) <= clean and len(ids(kept)) >= 0.98 * len(clean)
    before = ids(kept)
    packed = stages["packing"](spark, kept, sf).collect()
    plain = Tokenizer.from_file(packing.default_tokenizer())
    check_places([(r["sequence_id"], r["offset"], r["length"]) for r in packed])
    assert sum(r["length"] for r in packed) == sum(len(plain.encode(t, add_special_tokens=False).ids) + 1 for t in before.values())
    assert {r["doc_id"] for r in packed} == set(before) and simhash("") == 0


def test_registered(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
