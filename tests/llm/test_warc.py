"""Round trips through ZIP-packaged archives."""

import io
import struct
import zipfile
import zlib

import pytest

from claimloom.llm import warc

ROWS = [
    (1, "http://a.example/x y", "<p>one</p>"), (2, "http://b.example/", "<p>two</p>"), (3, None, "<p>one</p>"),
    (4, "http://c.example/", None), (5, "http://d.example/", ""), (6, "http://e.example/", "é\r\n\r\nWARC/1.1 ü"),
    (7, "http://f.example/", "long " * 300_000), (None, "http://g.example/", "<p>one</p>"), (1, "http://a.example/x y", "<p>one</p>"),
]


def read_back(spark, folder, **options):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, payload string")
    packages = warc.write_archives(pages.repartition(3), str(folder), **options)
    return packages, warc.read_archives(packages).collect()


def test_round_trip(spark, tmp_path):
    packages, found = read_back(spark, tmp_path)
    assert len(found) == len(ROWS) == packages.agg({"records": "sum"}).first()[0]
    payloads = {r[0]: (r[2] or "").encode() for r in ROWS}
    for row in found:
        payload = payloads[row["page_id"]]
        assert row["payload_bytes"] == len(payload)
        assert row["payload_digest"] == warc.base32_sha1(payload)
        first = min(i for i, p in payloads.items() if p == payload and i is not None)
        assert row["record_type"] == ("response" if row["page_id"] == first else "revisit")
        assert row["refers_to"] == (None if row["page_id"] == first else first)
        assert row["payload"] == (payload if row["page_id"] == first else None)


def test_ids_with_several_payloads(spark, tmp_path):
    rows = [
        (1, "one"), (2, "two"), (None, "one"), (None, "two"), (None, "own"), (None, "two"), (None, "shared"), (None, "shared"),
        (3, "one"), (3, "alone"), (2, "three"), (4, "three"), (5, None), (None, None),
    ]
    pages = spark.createDataFrame([(p, "u", h) for p, h in rows], "page_id long, url string, html string")
    found = warc.read_archives(warc.write_archives(pages.repartition(3), str(tmp_path))).collect()
    expected = []
    for page, html in rows:
        payload = (html or "").encode()
        first = min((p for p, h in rows if (h or "").encode() == payload and p is not None), default=None)
        later = page != first
        expected.append((page, "revisit" if later else "response", first if later else None, None if later else payload, warc.base32_sha1(payload)))
    columns = ["page_id", "record_type", "refers_to", "payload", "payload_digest"]
    got = [tuple(bytes(r[c]) if c == "payload" and r[c] is not None else r[c] for c in columns) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_small_payloads_are_all_responses(spark, tmp_path):
    _, found = read_back(spark, tmp_path, min_bytes=11)
    assert {r["record_type"] for r in found} == {"response"}


def test_packages_are_rolled_and_are_plain_zip_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "PACKAGE_BYTES", 300)
    done = warc.write_packages(iter([]), str(tmp_path))
    assert next(done).num_rows == 0
    package = warc.Package(str(tmp_path))
    for page in range(5):
        package.add(page, "http://x.example/", b"payload %d" % page, None)
    path, size, records = package.close()
    with zipfile.ZipFile(path) as packed:
        assert packed.testzip() is None
        assert all(i.compress_type == zipfile.ZIP_STORED for i in packed.infolist())
        assert zlib.decompress(packed.read(warc.ARCHIVE), 31).startswith(b"WARC/1.1\r\n")
    with open(path, "rb") as source:
        ranges = warc.record_ranges(source, size)
        raw = [zlib.decompress(r, 31) for r in warc.read_ranges(source, ranges)]
    assert records == 5 and [warc.parse_record(r)["payload"] for r in raw] == [b"payload %d" % n for n in range(5)]


def as_zip64(data: bytes) -> bytes:
    """The same package with every size and offset of its directory in ZIP64 form."""
    source = io.BytesIO(data)
    offset, length, entries = warc.directory_place(source, len(data))
    directory, at, out = data[offset : offset + length], 0, b""
    for _ in range(entries):
        name, extra, note = struct.unpack_from("<HHH", directory, at + 28)
        packed, full = struct.unpack_from("<II", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        wide = struct.pack("<HHQQQ", 1, 24, full, packed, header)
        entry = bytearray(directory[at : at + 46 + name])
        struct.pack_into("<II", entry, 20, 0xFFFFFFFF, 0xFFFFFFFF)
        struct.pack_into("<H", entry, 30, len(wide) + 4)
        struct.pack_into("<H", entry, 32, 0)
        struct.pack_into("<I", entry, 42, 0xFFFFFFFF)
        out += bytes(entry) + struct.pack("<HH", 0x7777, 0) + wide
        at += 46 + name + extra + note
    end64 = struct.pack("<4sQHHIIQQQQ", warc.END64, 44, 45, 45, 0, 0, entries, entries, len(out), offset)
    locator = struct.pack("<4sIQI", warc.END64_LOCATOR, 0, offset + len(out), 1)
    end = struct.pack("<4sHHHHIIH", warc.END, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 3) + b"end"
    return data[:offset] + out + end64 + locator + end


def test_zip64_directories(tmp_path):
    package = warc.Package(str(tmp_path))
    for page in range(40):
        package.add(page, "http://x.example/", b"payload %d" % page, 0 if page % 3 == 1 else None)
    path, size, _ = package.close()
    data = open(path, "rb").read()
    wide = as_zip64(data)
    assert zipfile.ZipFile(io.BytesIO(wide)).namelist() == [warc.ARCHIVE, warc.INDEX]
    assert warc.members(io.BytesIO(wide), len(wide)) == warc.members(io.BytesIO(data), size)
    ranges = warc.record_ranges(io.BytesIO(wide), len(wide))
    assert len(ranges) == 40
    assert [warc.parse_record(zlib.decompress(r, 31))["page_id"] for r in warc.read_ranges(io.BytesIO(wide), ranges)] == list(range(40))


def test_broken_packages_are_refused(tmp_path):
    package = warc.Package(str(tmp_path))
    package.add(1, "u", b"payload", None)
    path, size, _ = package.close()
    data = open(path, "rb").read()
    with pytest.raises(ValueError, match="no ZIP"):
        warc.members(io.BytesIO(data[: size // 2]), size // 2)
    with pytest.raises(ValueError, match="does not match"):
        warc.parse_record(warc.record_bytes(1, "u", b"payload", None, warc.base32_sha1(b"other")))


def test_no_pages(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(empty, str(tmp_path))).collect() == []


def foreign(kind, block, record_id="<urn:uuid:1b4e28ba-2fa1-11d2-883f-0016d3cca427>", **more):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", "WARC-Date: 2020-01-02T03:04:05Z"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in more.items()] + [f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = {"Content_Type": "application/http;msgtype=response"}
PAGE = b"HTTP/1.1 200 OK\r\nServer: \xe9\r\nContent-Length: 5\r\n\r\nhello"
CHUNKED = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3;x=1\r\nhel\r\n2\r\nlo\r\n0\r\n\r\n"
RECORDS = [
    foreign("warcinfo", b"software: other\r\n", Content_Type="application/warc-fields"),
    foreign("response", PAGE, WARC_Target_URI="<http://a.example/>", **HTTP),
    foreign("request", b"GET / HTTP/1.1\r\nHost: a.example\r\n\r\n", Content_Type="application/http; msgtype=request"),
    foreign("response", CHUNKED, WARC_Payload_Digest="sha1:" + warc.base32_sha1(b"hello"), **HTTP),
    foreign("resource", b"", record_id="<urn:page:99999999999999999999>", Content_Type="text/plain"),
    foreign("revisit", b"", WARC_Refers_To="<urn:uuid:0>", WARC_Payload_Digest="SHA1:ABC"),
    foreign("metadata", b"x" * 3_000_000, WARC_Payload_Digest="xxh3:00"),
    foreign("response", PAGE, WARC_Payload_Digest="sha256:wrong", WARC_Truncated="length", **HTTP),
]
EXPECTED = [
    ("warcinfo", b"software: other\r\n"), ("response", b"hello"), ("request", b""), ("response", b"hello"),
    ("resource", b""), ("revisit", None), ("metadata", b"x" * 3_000_000), ("response", b"hello"),
]


def member(data):
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def package(path, archives, index, method=zipfile.ZIP_STORED):
    with zipfile.ZipFile(path, "w") as out:
        out.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
        for name, data in archives.items():
            out.writestr(f"archive/{name}", data, method)
        for name, data in index.items():
            out.writestr(f"indexes/{name}", data)
    return str(path)


def listed(members, which, file):
    starts = [sum(map(len, members[:n])) for n in range(len(members))]
    lines = [f'example,a)/ 20200102030405 {{"offset": "{starts[n]}", "length": {len(members[n])}, "filename": "{file}"}}' for n in which]
    return "\n".join(["!meta 0 {}", "", *reversed(lines)]).encode()


@pytest.mark.parametrize("which", [[], [1, 3], range(8), [7]])
@pytest.mark.parametrize("form", ["members", "one member", "plain"])
def test_archives_made_elsewhere(spark, tmp_path, form, which):
    parts = [member(r) for r in RECORDS] if form == "members" else RECORDS
    data = member(b"".join(RECORDS)) if form == "one member" else b"".join(parts)
    file = "rec-1.warc" if form == "plain" else "rec-1.warc.gz"
    lines = listed(parts, [] if form == "one member" else which, file)
    index = {"index.cdx.gz": member(lines), "index.idx": b"x"} if form == "members" else {"index.cdxj": lines}
    path = package(tmp_path / "a.wacz", {file: data, "rec-2.warc": RECORDS[1]}, index if which else {})
    rows = warc.read_archives(warc.files_of(spark, [path])).collect()
    found = [(r["record_type"], None if r["payload"] is None else bytes(r["payload"])) for r in rows]
    assert found == [*EXPECTED, ("response", b"hello")]
    assert {r["page_id"] for r in rows} == {None} == {r["refers_to"] for r in rows}
    assert rows[1]["record_id"] == "urn:uuid:1b4e28ba-2fa1-11d2-883f-0016d3cca427" and rows[1]["url"] == "http://a.example/"
    assert rows[1]["payload_digest"] == rows[3]["payload_digest"] == warc.base32_sha1(b"hello")
    assert tuple(rows[5])[5:7] == (None, "ABC") and rows[5]["refers_to_id"] == "urn:uuid:0"


def test_foreign_packages_that_cannot_be_read_whole(tmp_path):
    def read(path):
        with open(path, "rb") as source:
            return list(warc.records_of(source, source.seek(0, 2)))

    whole = {"r.warc.gz": member(RECORDS[1])}
    with pytest.raises(ValueError, match="compressed by ZIP"):
        read(package(tmp_path / "a", whole, {}, zipfile.ZIP_DEFLATED))
    with pytest.raises(ValueError, match="lacks its stored archive"):
        read(package(tmp_path / "b", {}, {}))
    with pytest.raises(ValueError, match="which the package lacks"):
        read(package(tmp_path / "c", whole, {"index.cdxj": listed(RECORDS, [0], "other.warc.gz")}))
    for name, data in [("r.warc", RECORDS[1][:-9]), ("r.warc.gz", member(RECORDS[1])[:-9]), ("r.warc", RECORDS[1] + b"WARC/1.0")]:
        with pytest.raises(ValueError, match="inside a record"):
            read(package(tmp_path / "d", {name: data}, {}))
    bad = foreign("response", PAGE, WARC_Payload_Digest="sha256:" + "0" * 64, **HTTP)
    with pytest.raises(ValueError, match="does not match"):
        read(package(tmp_path / "e", {"r.warc": bad}, {}))


def test_index_lines_and_urls(spark, tmp_path):
    rows = [(2, "http://B.Example.org/x y?q\u2028", "b"), (1, "http://a.example.org/", "a"), (3, "no url\r\nX: y", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    packages = warc.write_archives(pages, str(tmp_path))
    path = packages.first()["path"]
    with zipfile.ZipFile(path) as packed:
        lines = packed.read(warc.INDEX).decode().split("\n")
    assert lines == sorted(lines)
    assert [x.split(" ")[0] for x in lines] == ["no%20url%0D%0AX:%20y", "org,example,a)/", "org,example,b)/x%20y?q%E2%80%A8"]
    urls = {r["page_id"]: r["url"] for r in warc.read_archives(packages).collect()}
    assert urls == {1: "http://a.example.org/", 2: "http://B.Example.org/x%20y?q%E2%80%A8", 3: "no%20url%0D%0AX:%20y"}
