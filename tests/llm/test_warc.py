import gzip
import hashlib
import io
import json
import zipfile

import pytest

from omnibus.llm import warc, zip_reader

PAGE = "page_id bigint, url string, html string, digest string, payload string, first_id string"


def expected(rows):
    first = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if i is not None and len(body) >= 100:
            first[body] = min(i, first.get(body, i))
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        lead = first.get(body)
        again = lead is not None and i != lead
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", lead if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("package_bytes", [warc.PACKAGE_BYTES, 400])
def test_round_trip(spark, tmp_path, package_bytes):
    big = "<p>é 漢字 " + "x" * 200
    rows = [(i, f"http://a/{i}", f"<p>page {i} " + "y" * (i % 150)) for i in range(60)]
    rows += [(100, "u", big), (90, "u", big), (90, "u", big), (None, "u", big), (101, None, None), (102, "u\r\nX: é", ""),
             (103, "u", "short"), (104, "u", "short"), (None, None, None), (105, "u", "\r\n\r\n" * 40), (106, "u", "z" * 3_000_000)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], PAGE).repartition(3)
    manifest = warc.write(df, str(tmp_path / "warc"), package_bytes)
    assert manifest.count() >= (3 if package_bytes > 400 else 20)
    assert sorted(map(tuple, warc.read(manifest).collect()), key=repr) == expected(rows)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGE)).count() == 0


def test_packages_outside_the_manifest_are_not_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "<p>x", None, None, None)], PAGE)
    warc.write(df, str(tmp_path / "w"))
    manifest = warc.write(df, str(tmp_path / "w"))
    assert len(list((tmp_path / "w").iterdir())) == 2 and warc.read(manifest).count() == 1


def reader(data):
    return (lambda start, length: data[start : start + length]), len(data)


@pytest.mark.parametrize("wide", [False, True])
def test_directory_and_zip64(monkeypatch, wide):
    if wide:  # every size counts as too large for the short fields
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"a comment with PK\x05\x06 inside, and more of it"
        for i in range(5):
            z.writestr(f"archive/{i}.warc.gz", bytes([i]) * (40 + i))
        z.writestr("packed", b"q" * 500, zipfile.ZIP_DEFLATED)
    read, size = reader(out.getvalue())
    assert (b"PK\x06\x06" in out.getvalue()) == wide
    members = zip_reader.directory(read, size)
    assert [m.name for m in members] == [f"archive/{i}.warc.gz" for i in range(5)] + ["packed"]
    for i, m in enumerate(members[:5]):
        assert m.size == 40 + i and read(zip_reader.data_start(read, m), m.size) == bytes([i]) * (40 + i)
    with pytest.raises(zip_reader.BadArchive, match="compressed"):
        zip_reader.data_start(read, members[5])


@pytest.mark.parametrize("data", [b"", b"x" * 100, b"PK\x05\x06" + b"\0" * 17, b"PK\x05\x06" + b"\0" * 4 + b"\1\0\1\0" + b"\0" * 10])
def test_broken_archives_are_refused(data):
    with pytest.raises(zip_reader.BadArchive):
        zip_reader.directory(*reader(data))


def test_damaged_payload_is_noticed():
    record = warc._record({"page_id": 1, "url": "u", "refers_to": None, "payload": "abc", "digest": "0" * 64, "bytes": 3})
    for member in (record, gzip.compress(record)):
        with pytest.raises(zip_reader.BadArchive, match="damaged"):
            warc.parse(member)


def test_index_lines_and_record_ids(spark, tmp_path):
    rows = [(1, "http://www.a.example:80/x y?q=1#f", "z" * 200), (1, "https://b.example", "z" * 200), (2, None, "z" * 200), (3, "http://A.example/é", "")]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], PAGE).coalesce(1)
    path = warc.write(df, str(tmp_path / "w")).first()["path"]
    with zipfile.ZipFile(path) as z:
        lines = z.read("indexes/index.cdxj").decode().splitlines()
        records = [gzip.decompress(z.read("archive/data.warc.gz")[int(e["offset"]):][: int(e["length"])]) for e in (json.loads(x.split(" ", 2)[2]) for x in lines)]
    assert lines == sorted(lines)
    assert [x.split(" ")[:2] for x in lines] == [
        [k, "19700101000000"] for k in ("example,a)/%C3%A9", "example,a,www:80)/x%20y?q=1", "example,b)/", "urn:none")
    ]
    assert all(json.loads(x.split(" ", 2)[2])["filename"] == "data.warc.gz" for x in lines)
    # Two responses share a page_id, and no two records an id.
    ids = [warc._headers(r)[0]["warc-record-id"] for r in records]
    assert len(set(ids)) == 4 and [warc._headers(r)[0]["warc-type"] for r in records].count("revisit") == 1


def response(payload, kind="response", digest=True, more=""):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + payload
    named = f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest().upper()}\r\n" if digest else ""
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:1>\r\n{named}{more}Content-Length: {len(http)}\r\n\r\n"
    return head.encode() + http + b"\r\n\r\n"


def foreign(path, packed_index, method=zipfile.ZIP_STORED, name="two.warc"):
    """A package as others make it: two archives, one plain; two indexes, one named after nothing in particular."""
    one, two = [gzip.compress(response(b"first" * 9)), gzip.compress(response(b"info", "warcinfo")), gzip.compress(response(b"second", digest=False))], [
        response(b"third \xff\xfe"), response(b"fourth")]
    line = lambda n, file, at, size: f'example,x)/{n} 20240102030405 {{"url": "http://x/{n}", "offset": {at}, "length": "{size}", "filename": "{file}"}}\n'
    first = "!meta {}\n" + "".join(line(i, "rec-1.warc.gz", sum(map(len, one[:i])), len(x)) for i, x in enumerate(one))
    second = "".join(line(i, name, sum(map(len, two[:i])), len(x)) for i, x in enumerate(two)) * 2
    with zipfile.ZipFile(path, "w", method) as z:
        z.writestr("pages/pages.jsonl", "{}")
        z.writestr("archive/rec-1.warc.gz", b"".join(one))
        z.writestr("indexes/index.cdx", first)
        z.writestr("archive/two.warc", b"".join(two))
        z.writestr("indexes/more.cdxj.gz" if packed_index else "indexes/more.cdxj", gzip.compress(second.encode()) if packed_index else second)
        z.writestr("indexes/index.idx", "not an index of records")


@pytest.mark.parametrize("packed_index", [False, True])
def test_foreign_package_of_several_archives(spark, tmp_path, packed_index):
    path = str(tmp_path / "made.wacz")
    foreign(path, packed_index)
    got = warc.read(spark.createDataFrame([(path, 1, 5)], warc.MANIFEST)).collect()
    payloads = [b"first" * 9, b"second", b"third \xff\xfe", b"fourth"]
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type) for r in got) == sorted(
        (None, len(p), hashlib.sha256(p).hexdigest(), "response") for p in payloads
    )


def test_packages_that_cannot_be_read_are_refused(tmp_path):
    foreign(str(tmp_path / "a"), False, zipfile.ZIP_DEFLATED)
    with pytest.raises(zip_reader.BadArchive, match="compressed"):
        warc.locate(str(tmp_path / "a"))
    foreign(str(tmp_path / "b"), False, name="three.warc")
    with pytest.raises(zip_reader.BadArchive, match="three.warc"):
        warc.locate(str(tmp_path / "b"))
