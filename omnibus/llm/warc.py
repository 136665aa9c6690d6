"""Web archives in ZIP packages: written by Spark tasks, read back by byte range.

A package holds ``archive/data.warc.gz``, stored, one gzip member per record,
and ``indexes/index.cdxj``, stored, one line per record: the url as a sort key,
a 14-digit time, and an object that names the archive, the offset and the length.
A task writes packages of bounded size under names of its own attempt into the
shared folder and returns their paths; packages of lost or repeated attempts are
in no manifest and so are never read.

Reading takes any package of that layout.  One row per package lists its
directory, finds all members under ``archive/`` and ``indexes/`` (indexes plain
or gzipped), follows the lines to their archives, and cuts the records into
runs; runs are dealt out evenly, and each is one range read.  Records of plain
and of gzipped archives are told apart by their first bytes.

Payloads that are equal and have ``REVISIT_BYTES`` at least are kept once: the
one with the smallest page_id is the response, the others are revisits that
carry its id and the payload's length and digest.

Defined cases: NULL html is an empty payload.  Rows that repeat the smallest
page_id of a payload are responses, too, with record ids of their own.  A NULL
page_id is never the smallest one, unless all of a payload's are NULL; then all
are responses.  Control and non-ASCII characters of a url are percent-encoded in
headers.  Of foreign packages, records other than responses and revisits are
passed over, and page_id and refers_to are NULL; a record that two lines name is
read once.  A line that names a missing archive, a member that is compressed
inside the package, and a payload unlike its SHA-256 digest are errors.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import posixpath
import uuid
import zipfile
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnibus.llm import zip_reader
from omnibus.llm.common import stored
from omnibus.sources.shared import fresh_folder

REVISIT_BYTES = 100
PACKAGE_BYTES = 64 << 20
#: Bytes of records that one range read takes, or one record if that is longer.
RUN_BYTES = 4 << 20
#: Runs for one task.
RUNS_PER_TASK = 8
ARCHIVES, INDEXES = "archive/", "indexes/"
ARCHIVE, INDEX = "data.warc.gz", "index.cdxj"
INDEX_NAMES = (".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz")
# Fixed values of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE, _TIME = "1970-01-01T00:00:00Z", "19700101000000"  # pages carry no time
_GZIP = b"\x1f\x8b"

MANIFEST = "path string, bytes bigint, records bigint"
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def decided(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, digest, bytes, refers_to, payload): refers_to set and payload NULL for revisits."""
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).alias("url"),
        body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
        F.octet_length(body).cast("bigint").alias("bytes"),
    )
    repeated = (
        rows.where(F.col("bytes") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.min_by("url", "page_id").alias("first_url"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .drop("n")
    )
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(stored(repeated, "repeated-payloads"), "digest", "left").select(
        "page_id",
        "url",
        "digest",
        "bytes",
        F.when(again, F.col("first_id")).alias("refers_to"),
        F.when(again, F.col("first_url")).alias("first_url"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def _uri(url: str | None) -> str:
    return quote(url or "urn:none", safe="!#$%&'()*+,/:;=?@[]~")


def sort_key(url: str | None) -> str:
    """The url with its host's labels turned round and without its scheme, as indexes sort by."""
    uri = _uri(url)
    scheme, mark, rest = uri.partition("://")
    if not mark or not scheme.isalnum():
        return uri.replace(" ", "%20")
    ends = [i for i in map(rest.find, "/?#") if i >= 0]
    host, path = (rest[: min(ends)], rest[min(ends) :]) if ends else (rest, "")
    name, _, port = host.rpartition("@")[2].lower().partition(":")
    turned = ",".join(reversed(name.split("."))) + (f":{port}" if port else "")
    return f"{turned}){path.partition('#')[0] or '/'}"


def _record(row: dict) -> bytes:
    revisit = row["refers_to"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    block = http if revisit else http + row["payload"].encode()
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": _uri(row["url"]),
        "WARC-Payload-Digest": f"sha256:{row['digest']}",
        "Content-Type": "application/http; msgtype=response",
    }
    if row["page_id"] is not None:
        head["X-Page-ID"] = row["page_id"]
    if revisit:
        head |= {
            "WARC-Profile": _PROFILE, "WARC-Refers-To-Target-URI": _uri(row["first_url"]), "WARC-Refers-To-Date": _DATE,
            "X-Refers-To-Page-ID": row["refers_to"],
        }
    head["Content-Length"] = len(block)
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


class _Package:
    """One ZIP file on an append-only stream."""

    def __init__(self, folder: str):
        self.path = posixpath.join(folder, f"{uuid.uuid4().hex}.wacz")
        store, place = fs.FileSystem.from_uri(self.path)
        self._stream = store.open_output_stream(place)
        self._zip = zipfile.ZipFile(self._stream, "w", zipfile.ZIP_STORED)
        self._member = self._zip.open(ARCHIVES + ARCHIVE, "w", force_zip64=True)
        self.bytes, self.lines = 0, []

    def add(self, row: dict) -> None:
        data = gzip.compress(_record(row), compresslevel=1, mtime=0)
        entry = {
            "url": _uri(row["url"]), "mime": "text/html" if row["refers_to"] is None else "warc/revisit", "status": "200",
            "digest": f"sha256:{row['digest']}", "length": str(len(data)), "offset": str(self.bytes), "filename": ARCHIVE,
        }
        self.lines.append(f"{sort_key(row['url'])} {_TIME} {json.dumps(entry)}\n")
        self._member.write(data)
        self.bytes += len(data)

    def close(self) -> tuple[str, int, int]:
        self._member.close()
        self._zip.writestr(INDEXES + INDEX, "".join(sorted(self.lines)))
        self._zip.writestr("datapackage.json", json.dumps({"profile": "data-package", "wacz_version": "1.1.1"}))
        self._zip.close()
        self._stream.close()
        return self.path, self.bytes, len(self.lines)


def write(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write packages into ``folder``; the manifest (path, bytes, records), stored."""
    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place, recursive=True)

    def run(batches):
        package, done = None, []
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    package = package or _Package(folder)
                    package.add(row)
                    if package.bytes >= package_bytes:
                        done.append(package.close())
                        package = None
        if package:
            done.append(package.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "bytes", "records"])

    return stored(decided(pages).mapInArrow(run, MANIFEST), "manifest")


def _reader(path: str):
    store, place = fs.FileSystem.from_uri(path)
    file = store.open_input_file(place)

    def read(start: int, length: int) -> bytes:
        file.seek(start)
        return file.read(length)

    return file, read


def _entries(index: bytes):
    """(archive name, offset, length) of each line of an index that names a record."""
    text = gzip.decompress(index) if index.startswith(_GZIP) else index
    for line in text.decode().splitlines():
        key, _, rest = line.partition(" ")
        time, _, fields = rest.partition(" ")
        if not key.startswith("!") and time.isdigit() and fields.startswith("{"):
            entry = json.loads(fields)
            yield entry["filename"], int(entry["offset"]), int(entry["length"])


def locate(path: str) -> list[tuple[str, int, list[int]]]:
    """(path, start, lengths) of each run of records that follow each other in the file."""
    file, read = _reader(path)
    with file:
        members = {m.name: m for m in zip_reader.directory(read, file.size())}
        starts = {
            name.removeprefix(ARCHIVES): zip_reader.data_start(read, m)
            for name, m in members.items() if name.startswith(ARCHIVES) and not name.endswith("/")
        }
        places = set()
        for name, m in members.items():
            if name.startswith(INDEXES) and name.endswith(INDEX_NAMES):
                for archive, offset, length in _entries(read(zip_reader.data_start(read, m), m.size)):
                    if archive not in starts or offset + length > members[ARCHIVES + archive].size:
                        raise zip_reader.BadArchive(f"{name} names a record beyond the archives: {archive}")
                    places.add((starts[archive] + offset, length))
    runs: list[tuple[str, int, list[int]]] = []
    end = full = None
    for at, length in sorted(places):
        if at != end or full + length > RUN_BYTES:
            runs.append((path, at, []))
            full = 0
        runs[-1][2].append(length)
        full, end = full + length, at + length
    return runs


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}, rest


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def parse(member: bytes) -> tuple | None:
    """One row of ``RECORDS`` from a record, checked against its SHA-256 digest; None for other kinds of record."""
    head, rest = _headers(gzip.decompress(member) if member.startswith(_GZIP) else member)
    kind = head.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(head["content-length"])]
    http, payload = _headers(block) if block.startswith(b"HTTP/") else ({}, block)
    algorithm, _, digest = head.get("warc-payload-digest", "").partition(":")
    if kind == "response":
        actual = hashlib.sha256(payload).hexdigest()
        if algorithm in ("sha256", "sha-256") and digest.lower() != actual:
            raise zip_reader.BadArchive(f"the payload of {head['warc-record-id']} is damaged")
        length, digest = len(payload), actual
    else:
        length = int(http.get("content-length", 0))
    return _number(head.get("x-page-id")), length, digest.lower(), kind, _number(head.get("x-refers-to-page-id"))


def read(manifest: DataFrame) -> DataFrame:
    """The records of all packages of a manifest."""

    def find(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                runs = locate(path)
                if runs:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*runs)], names=["path", "start", "lengths"])

    def fetch(batches):
        for batch in batches:
            for run in batch.to_pylist():
                file, take = _reader(run["path"])
                with file:
                    data = take(run["start"], sum(run["lengths"]))
                at, rows = 0, []
                for length in run["lengths"]:
                    if row := parse(data[at : at + length]):
                        rows.append(row)
                    at += length
                if not rows:
                    continue
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    runs = manifest.select("path").mapInArrow(find, "path string, start bigint, lengths array<bigint>")
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    return runs.repartition(1 + total // (RUN_BYTES * RUNS_PER_TASK)).mapInArrow(fetch, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write one record per page, and the rows that reading the packages gives."""
    return read(write(pages, fresh_folder(pages.sparkSession, "warc")))
