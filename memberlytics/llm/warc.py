"""Web archives in ZIP packages: WARC records, one compressed member each, stored with an index and read back by range.

Writing: a payload of ``least`` bytes or more is kept once, by the record with the smallest page_id; the others are
revisits without it.  The payload itself meets its record by digest after copies were combined in each task; revisits
travel as narrow rows.  Each task writes packages under names of their own, and the returned table, written by Spark's
committer, names those that count, so a task that runs twice leaves nothing but an unnamed file.

Reading: the directories of the packages give the stored archives and indexes; index entries become byte ranges of
neighbouring records, dealt to the tasks; each range is read, unpacked record by record and checked.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha256
from io import BytesIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.registry import query, table
from memberlytics.llm.zipped import Member, Reader, Writer
from memberlytics.session import stage, staging_path

LEAST = 100  # bytes of a payload that may be revisited
HOT_SHARE = 512  # digests with more than 1/512 of the rows: fewer than 512 of them
MEMBER_BYTES, PACKAGE_BYTES, READ_BYTES = 8 << 20, 256 << 20, 4 << 20
DATE = "1970-01-01T00:00:00Z"  # the table has no times
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PACKAGES = "path string, records long, bytes long"
RANGES = "path string, at long, starts array<long>, sizes array<long>"
RECORDS = "record_id string, type string, uri string, date string, refers_to string, digest string, payload_bytes long, payload binary"


def _record(row: dict, date: str) -> bytes:
    """A WARC record, as one gzip member."""
    payload = (row["payload"] or b"") if row["type"] == "response" else b""
    block = HTTP.format(row["payload_bytes"]).encode() + payload
    head = {
        "WARC-Type": row["type"], "WARC-Record-ID": f"<{row['record_id']}>", "WARC-Date": date,
        "WARC-Target-URI": None if row["url"] is None else quote(row["url"], safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": f"sha256:{row['digest']}",
        "WARC-Refers-To": row["refers_to"] and f"<{row['refers_to']}>", "WARC-Profile": PROFILE if row["refers_to"] else None,
        "Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + pack.flush()


class _Package:
    """An open package: records gather in a member, members and their indexes in the package."""

    def __init__(self, system: fs.FileSystem, path: str, uri: str) -> None:
        self.uri, self.zip = uri, Writer(system.open_output_stream(path))
        self.members = self.records = 0
        self._next()

    def _next(self) -> None:
        self.data, self.index = BytesIO(), []

    def add(self, record_id: str, date: str, digest: str, data: bytes) -> None:
        entry = {"offset": self.data.tell(), "length": len(data), "digest": f"sha256:{digest}", "filename": f"part-{self.members:05d}.warc.gz"}
        self.index.append(f"{record_id} {''.join(c for c in date if c.isdigit())} {json.dumps(entry)}\n")
        self.data.write(data)
        self.records += 1
        if self.data.tell() >= MEMBER_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.index:
            self.zip.add(f"archive/part-{self.members:05d}.warc.gz", self.data.getvalue())
            self.zip.add(f"indexes/part-{self.members:05d}.cdxj", "".join(self.index).encode())
            self.members += 1
            self._next()

    def close(self) -> tuple[str, int, int]:
        self._flush()
        self.zip.add("datapackage.json", json.dumps({"profile": "data-package", "records": self.records}).encode())
        return self.uri, self.records, self.zip.close()


def _write_batches(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        open_, done = None, []
        for row in (r for b in batches for k in range(0, len(b), 64) for r in b.slice(k, 64).to_pylist()):
            if open_ is None:
                name = f"{uuid.uuid4().hex}.wacz"
                open_ = _Package(system, f"{base}/{name}", f"{folder}/{name}")
            open_.add(row["record_id"], date, row["digest"], _record(row, date))
            if open_.zip.at >= PACKAGE_BYTES:
                done.append(open_.close())
                open_ = None
        if open_ is not None:
            done.append(open_.close())
        columns = list(zip(*done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    return run


def _uri(spark: SparkSession, path: str) -> str:
    """The path with its scheme, that of the cluster's default file system if it names none."""
    if "://" in path:
        return path
    if path.startswith("file:"):
        return "file://" + path[5:]
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return "file://" + path if default.startswith("file:") else default.rstrip("/") + path


def _make_folder(folder: str) -> None:
    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)


def record_id(page_id: Column, row: Column) -> Column:
    """A name of the page and its row: unique, and the page is read from it."""
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), row.cast("string"))


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(record_id, type, url, digest, payload_bytes, refers_to, payload): the records of all rows of ``pages``."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    size = F.octet_length(html).cast("long")
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.sha2(html, 256).alias("digest"),
        size.alias("payload_bytes"), F.when(size < least, html.cast("binary")).alias("payload"),
    )
    narrow = stage(narrow.withColumn("row", F.monotonically_increasing_id()), "pages")  # written, so that the numbers are fixed
    large = narrow.filter(F.col("payload_bytes") >= least)
    total = large.count()
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row", "url", "payload_bytes")).alias("first")
    groups = stage(large.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), first), "payloads")
    # Copies look their response up; digests with a large share of the rows, fewer than HOT_SHARE, are broadcast.
    hot = F.broadcast(groups.filter(F.col("rows") * HOT_SHARE > total).filter("rows > 1").select("digest", "first"))
    cold = groups.filter(F.col("rows") * HOT_SHARE <= total).filter("rows > 1").select("digest", "first")
    others = large.join(hot.select("digest"), "digest", "left_anti").join(cold, "digest")
    copies = large.join(hot, "digest").unionByName(others).filter("row <> first.row")
    none, kind = F.lit(None), {k: F.lit(k).alias("type") for k in ("response", "revisit")}
    revisits = copies.select(
        record_id(F.col("page_id"), F.col("row")).alias("record_id"), kind["revisit"], "url", "digest", "payload_bytes",
        record_id(F.col("first.page_id"), F.col("first.row")).alias("refers_to"), none.cast("binary").alias("payload"),
    )
    small = narrow.filter(F.col("payload_bytes") < least).select(
        record_id(F.col("page_id"), F.col("row")).alias("record_id"), kind["response"], "url", "digest", "payload_bytes",
        none.cast("string").alias("refers_to"), "payload",
    )
    # Any page with the digest has the payload: copies are combined before the shuffle.
    bodies = pages.select(F.sha2(html, 256).alias("digest"), html.alias("html")).filter(F.octet_length("html") >= least)
    bodies = bodies.groupBy("digest").agg(F.first("html").alias("html"))
    responses = bodies.join(groups, "digest").select(
        record_id(F.col("first.page_id"), F.col("first.row")).alias("record_id"), kind["response"], F.col("first.url").alias("url"), "digest",
        F.col("first.payload_bytes").alias("payload_bytes"), none.cast("string").alias("refers_to"), F.col("html").cast("binary").alias("payload"),
    )
    return responses.union(small).union(revisits)


def write_packages(pages: DataFrame, folder: str, least: int = LEAST, date: str = DATE) -> DataFrame:
    """Writes the rows of ``pages`` (page_id, url, html) as packages into ``folder``; the staged (path, records, bytes).

    A null html is an empty payload; payloads below ``least`` bytes are always responses.  Of equal payloads the smallest
    page_id is the response, any one of several rows with that id, and a row without an id only if no row has one.  A
    null url leaves the header out; blanks and characters beyond ASCII in urls are percent-encoded.  No pages write nothing.
    """
    folder = _uri(pages.sparkSession, folder)
    _make_folder(folder)
    return stage(records(pages, least).mapInArrow(_write_batches(folder, date), PACKAGES), "packages")


def _gunzip(data: bytes) -> tuple[bytes, int]:
    """The first gzip member of ``data`` unpacked, and how many bytes it took; (b"", 0) if it is not whole."""
    d = zlib.decompressobj(31)
    out = d.decompress(data)
    return (out, len(data) - len(d.unused_data)) if d.eof else (b"", 0)


def _walk(reader: Reader, member: Member, start: int) -> Iterator[tuple[int, int]]:
    """Places and sizes of the records of an archive that has no index, read in blocks."""
    at, end, data = start, start + member.stored, b""
    while at < end:
        want = max(READ_BYTES, 2 * len(data))
        data, used = reader.read(at, min(want, end - at)), 0
        while used < len(data):
            size = _gunzip(data[used:])[1] if member.name.endswith(".gz") else _plain_size(data[used:])
            if not size or used + size > len(data):
                break
            yield at + used, size
            used += size
        if not used and at + len(data) >= end:
            raise ValueError(f"{member.name} in {reader.path} ends within a record")
        at, data = at + used, b"" if used else data


def _plain_size(data: bytes) -> int:
    head = data.find(b"\r\n\r\n")
    if head < 0:
        return 0
    size = [int(x.split(b":")[1]) for x in data[:head].split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not size:
        raise ValueError("a record has no Content-Length")
    return head + 4 + size[0] + 4


def _entries(reader: Reader) -> Iterator[tuple[int, int]]:
    """Places and sizes of all records of a package, by its indexes where an archive has one."""
    archives = {m.name: m for m in reader.members if m.name.startswith("archive/") and m.name.endswith((".warc", ".warc.gz"))}
    start = {name: reader.start(m) for name, m in archives.items()}
    known: dict[str, list[tuple[int, int]]] = {name: [] for name in archives}
    for m in reader.members:
        if m.name.startswith("indexes/") and m.name.endswith((".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz")):
            data, lines = reader.read(reader.start(m), m.stored), b""
            while m.name.endswith(".gz") and data:
                out, used = _gunzip(data)
                lines, data = lines + out, data[used:] if used else b""
            for line in (lines or data).decode().splitlines():
                if line.startswith("!") or "{" not in line:
                    continue
                entry = json.loads(line[line.index("{") :])
                name = f"archive/{entry['filename']}"
                if name not in known:
                    raise ValueError(f"{reader.path} has an index of {name}, which it does not hold")
                known[name].append((start[name] + int(entry["offset"]), int(entry["length"])))
    for name, found in known.items():
        yield from sorted(found) if found else _walk(reader, archives[name], start[name])


def _range_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte ranges of neighbouring records, of at most READ_BYTES or one record."""
    types = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    for b in batches:
        for path in b.column("path").to_pylist():
            system, name = fs.FileSystem.from_uri(path)
            reader, out = Reader(system, name), []
            for at, size in _entries(reader):
                if out and at == out[-1][1] + sum(out[-1][3]) and sum(out[-1][3]) + size <= READ_BYTES and len(out[-1][3]) < 1000:
                    out[-1][2].append(at - out[-1][1])
                    out[-1][3].append(size)
                else:
                    out.append((path, at, [0], [size]))
            reader.close()
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["path", "at", "starts", "sizes"])


def _parse(data: bytes) -> tuple:
    """A whole record -> the fields of RECORDS; a digest that does not fit its payload is an error."""
    head, _, block = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = block[: int(fields["content-length"])]
    kind, payload = fields["warc-type"], block
    size = len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        stated = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        size = stated[0] if kind == "revisit" and stated else len(payload)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    if kind == "response":
        seen = sha256(payload).hexdigest()
        if digest and digest != seen:
            raise ValueError(f"{fields.get('warc-record-id')} does not have the payload of its digest")
        digest = seen
    names = [fields.get(k) for k in ("warc-record-id", "warc-refers-to")]
    own, other = [n and n.strip("<>") for n in names]
    return own, kind, fields.get("warc-target-uri"), fields.get("warc-date"), other, digest, size, None if kind == "revisit" else payload


def _read_batches(with_payload: bool):
    types = [pa.string()] * 6 + [pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                system, name = fs.FileSystem.from_uri(r["path"])
                with system.open_input_file(name) as file:
                    data = file.read_at(r["starts"][-1] + r["sizes"][-1], r["at"])
                rows = []
                for start, size in zip(r["starts"], r["sizes"]):
                    part = data[start : start + size]
                    row = _parse(_gunzip(part)[0] if part[:2] == b"\x1f\x8b" else part)
                    rows.append(row if with_payload else (*row[:-1], None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def read_packages(packages: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the packages named in ``path``: RECORDS, one row per record.

    Archives are ``archive/*.warc`` and ``archive/*.warc.gz`` (a gzip member a record), stored; an archive without an
    index is walked.  Payloads of responses are checked against their digest.  A broken package is an error that names it.
    """
    deal = packages.select("path").repartition("path")
    ranges = stage(deal.mapInArrow(_range_batches, RANGES), "ranges")
    return ranges.repartition("path", "at").mapInArrow(_read_batches(with_payload), RECORDS)


def read_pages(packages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records of ``write_packages``."""

    def page(c: str) -> Column:
        return F.regexp_extract(c, r"^urn:page:(-?[0-9]*):[0-9]+$", 1)

    r = read_packages(packages, with_payload=False)
    return r.select(
        page("record_id").try_cast("long").alias("page_id"), "payload_bytes",
        F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), page("refers_to").try_cast("long").alias("refers_to"),
    )


ORACLE = """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes < 100 OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM f"""


@query("op12_warc", ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packages are written to the shared folder and read back."""
    return read_pages(write_packages(table(spark, sf_dir, "pages"), staging_path(spark, "warc")))
