"""ZIP packages, web archives and Merkle manifests against the standard library and plain Python."""

import gzip
import hashlib
import io
import json
import random
import zipfile
import zlib

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from helpers import CLASH, ODD, documents
from memberlytics.llm import merkle, warc
from memberlytics.llm.zipped import Reader, Writer

LOCAL = fs.LocalFileSystem()


@pytest.mark.parametrize("wide", [True, False])
def test_writer_against_the_standard_library(tmp_path, wide):
    path, files = str(tmp_path / "a.zip"), {"archive/ä.warc": b"x" * 70_000, "empty": b"", "b": bytes(range(256))}
    w = Writer(LOCAL.open_output_stream(path), wide)
    for name, data in files.items():
        w.add(name, data)
    assert w.close() == len(open(path, "rb").read())
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and {n: z.read(n) for n in z.namelist()} == files


@pytest.mark.parametrize("front", [b"", b"bytes before the package PK\x05\x06"])
@pytest.mark.parametrize("note", [b"", b"a comment with PK\x05\x06 in it and more text behind"])
@pytest.mark.parametrize("count", [3, 66_000])
def test_reader_against_the_standard_library(tmp_path, count, note, front):
    path = tmp_path / "a.zip"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:  # 66,000 members need the ZIP64 directory
        for i in range(count):
            z.writestr(f"é{i}" if i % 2 else str(i), str(i) * (i % 7))
        z.comment = note
    path.write_bytes(front + data.getvalue())
    r = Reader(LOCAL, str(path))
    assert len(r.members) == count
    for i in {0, 1, 2, count - 1}:
        m = r.members[i]
        assert (m.name, m.size) == (f"é{i}" if i % 2 else str(i), len(str(i) * (i % 7)))
        assert r.read(r.start(m), m.size).decode() == str(i) * (i % 7)


def test_broken_packages_name_themselves(tmp_path):
    path = tmp_path / "a.zip"
    path.write_bytes(b"no package")
    with pytest.raises(ValueError, match="a.zip"):
        Reader(LOCAL, str(path))
    path.write_bytes(b"")
    with pytest.raises(ValueError, match="a.zip"):
        Reader(LOCAL, str(path))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a.warc", "x" * 1000)
    r = Reader(LOCAL, str(path))
    with pytest.raises(ValueError, match="archive/a.warc"):
        r.start(r.members[0])


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit("x").alias(c) for c in CLASH if c != "row"], F.lit("x").alias("digest"))


LONG = "<p>ü" + "long " * 200_000
PAGES = [
    (5, "http://a/?q=ä b\r\nWARC-Type: x", LONG), (2, None, LONG), (9, "", "y" * 100), (8, "u", "y" * 100), (7, "u", "y" * 99), (6, "u", "y" * 99),
    (None, "u", None), (4, "u", ""), (3, "u", "\r\n\r\n" * 50), (3, "u", "\r\n\r\n" * 50), (None, "n", "z" * 200), (None, "m", "z" * 200), (10, "u", "é" * 50),
    (11, "u", "é" * 49),
] + [(100 + i, "u", "copy " * 60) for i in range(300)]


def expected(rows):
    first = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 100:
            first.setdefault(html, []).append(page)
    out, used = [], set()
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        base = (page, len(data), hashlib.sha256(data).hexdigest())
        if html in used:
            out.append((*base, "revisit", min((p for p in first[html] if p is not None), default=None)))
        else:
            out.append((*base, "response", None))
            if html in first:
                used.add(html)
    return sorted(out, key=str)


def test_pages_come_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 2000)
    d = pages(spark, PAGES)
    packages = warc.write_packages(d, str(tmp_path / "out"))
    assert sorted(map(tuple, warc.read_pages(packages).collect()), key=str) == expected(PAGES)
    records = {r["record_id"]: r for r in warc.read_packages(packages).collect()}
    assert len(records) == len(PAGES)
    for r in records.values():
        body = r if r["type"] == "response" else records[r["refers_to"]]
        assert hashlib.sha256(body["payload"]).hexdigest() == r["digest"] and len(body["payload"]) == r["payload_bytes"]
        assert (r["payload"] is None) == (r["type"] == "revisit")
    assert {r["uri"] for r in records.values() if r["record_id"].startswith("urn:page:5:")} == {"http://a/?q=%C3%A4%20b%0D%0AWARC-Type:%20x"}


def test_no_pages(spark, tmp_path):
    packages = warc.write_packages(pages(spark, PAGES[:1]).limit(0), f"file:{tmp_path}/none")
    assert packages.count() == 0 and warc.read_pages(packages).count() == 0


@pytest.mark.parametrize("indexed", [True, False])
@pytest.mark.parametrize("packed", [True, False])
def test_packages_of_others(spark, tmp_path, monkeypatch, packed, indexed):
    """Members written by the standard library, plain or packed, with and without an index."""
    monkeypatch.setattr(warc, "READ_BYTES", 300)
    rnd, body, index, bodies = random.Random(4), b"", [], []
    for i in range(60):
        bodies.append(bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 5, 50, 1500]))))
        head = f"WARC/1.0\r\nwarc-type: resource\r\nWARC-Record-ID: <urn:x:{i}>\r\nContent-Length: {len(bodies[-1])}\r\n\r\n"
        data = head.encode() + bodies[-1] + b"\r\n\r\n"
        data = gzip.compress(data) if packed else data
        name = "d.warc.gz" if packed else "d.warc"
        index.append(f"com,x)/ 2020 {json.dumps({'offset': str(len(body)), 'length': str(len(data)), 'filename': name})}")
        body += data
    path = tmp_path / "b.wacz"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(f"archive/{name}", body)
        z.writestr("pages/pages.jsonl", "{}", zipfile.ZIP_DEFLATED)
        if indexed:
            z.writestr("indexes/index.cdx.gz", gzip.compress("\n".join(index[:30]).encode() + b"\n") + gzip.compress("\n".join(index[30:]).encode()))
    got = warc.read_packages(spark.createDataFrame([(f"file://{path}",)], "path string")).collect()
    assert sorted((r["record_id"], bytes(r["payload"])) for r in got) == sorted((f"urn:x:{i}", b) for i, b in enumerate(bodies))


def test_a_changed_payload_is_an_error(spark, tmp_path):
    row = {"type": "response", "record_id": "urn:page:1:0", "url": "u", "digest": "0" * 64, "payload_bytes": 3, "refers_to": None, "payload": b"abc"}
    with pytest.raises(ValueError, match="urn:page:1:0"):
        warc._parse(gzip.decompress(warc._record(row, warc.DATE)))


# ---- Merkle manifests


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves, width):
    """Root, and for each leaf the (left, right) hex text of each level."""
    steps, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for s, i in zip(steps, at):
            run = i - i % width
            s.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + width])))
        at = [i // width for i in at]
        nodes = [h(*nodes[i : i + width]) for i in range(0, len(nodes), width)]
    return nodes[0], steps


def brute(rows, width, tamper):
    """(doc_id, text, lang) rows -> sorted result rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    subs, out = [], []
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs.append(tree([leaf(r) for r in groups[name]], width))
    root, tops = tree([s[0] for s in subs], width)
    for name, (sub, steps), top in zip(names, subs, tops):
        for r, own in zip(groups[name], steps):
            path = own + top
            seen = leaf(tamper(r))
            for left, right in path:
                seen = h(left, seen, right)
            out.append((r[0], leaf(r), sub, root, h("".join(a + b for a, b in path)), seen, seen == root))
    return sorted(out, key=str)


def lowered(r):
    return (r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if r[1] is not None else None, r[2]) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else r


@pytest.mark.parametrize("width", [2, 3, 8])
def test_manifest(spark, width):
    rnd = random.Random(width)
    rows = [(i, f"Text {i} Ä" * rnd.randrange(3), rnd.choice(["en", "de", "é", None, "en"])) for i in range(150)]
    rows += ODD + [(7, "Tie", "en"), (7, "tie", "en"), (200, "Alone", "zz"), (201, "Long " * 50_000, "𝒳"), (202, "x", ""), (rows[3])]
    rows += [rows[5]] * 20  # repeated rows are leaves of their own
    rnd.shuffle(rows)
    d = documents(spark, rows)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    changed = F.when(hit, merkle.leaf_digest([F.col("doc_id"), merkle.lower_ascii(F.col("text")), F.col("lang")]))
    got = merkle.manifest(d, changed, columns=("doc_id", "text", "lang"), width=width)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, width, lowered)


def test_small_manifests(spark):
    for rows in ([], [(1, "One", "en")], [(None, None, None)], [(1, "One", "en"), (2, "Two", "de")]):
        got = merkle.manifest(documents(spark, rows), columns=("doc_id", "text", "lang"))
        assert sorted(map(tuple, got.collect()), key=str) == (brute(rows, 8, lambda r: r) if rows else [])


def test_any_change_is_seen(spark):
    rows = [(i, f"text {i}", "en") for i in range(100)]
    d = documents(spark, rows)
    wrong = F.when(F.col("doc_id") == 41, merkle.leaf_digest([F.lit("other")]))
    got = merkle.manifest(d, wrong, columns=("doc_id", "text", "lang")).collect()
    assert {r["doc_id"] for r in got if not r["verified"]} == {41}
