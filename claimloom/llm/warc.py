"""WARC records in ZIP packages: a writer, and a reader that never extracts.

Each write task packs its pages as gzip-compressed WARC records into ZIP files
with stored (uncompressed) members: ``archive/data.warc.gz`` with one gzip
member per record, and ``indexes/index.cdxj`` with a sorted line per record
(reversed host and path, time, JSON). The reader finds the
end-of-central-directory record at the tail of a package, follows the ZIP64
locator if there is one, parses the central directory, computes where the
stored members' bytes lie, reads the indexes, and then reads each record by its
byte range. What no index covers (requests usually, or all, if there is no
stored index) is read through record by record.

Packages made elsewhere may have several archives, compressed or not, any
record ids, all record types, and records without payload digest.

Files go through ``pyarrow.fs``, chosen by the scheme of the folder. A file's
name is new for each task attempt, and only the files that a successful
attempt reported are read, so a repeated task leaves no second copy behind in
the results.

Defined results
---------------
Equal payloads of at least ``min_bytes`` bytes: the smallest page_id is a
``response``, others are ``revisit`` records without payload; rows that repeat
the smallest page_id are all responses. Payloads are equal if their SHA-256
and length are; SHA-1 is only written. A page_id may have several payloads,
each is judged by itself. null html: empty payload. null
page_id: written as ``null``; it is a response only if all ids of its group
are null. null url: an empty target; blanks and control characters of a url
are written as percent codes. Empty table: no file. Other columns are not written.

Read back: ``page_id`` and ``refers_to`` are null where a record's id is none of
this module's; ``record_id`` and ``refers_to_id`` are the ids as they stand.
``payload`` is what follows the HTTP header (unchunked), or the whole block of
records that hold no HTTP; null for revisits. ``payload_digest`` is the bare
SHA-1 in base32, computed where a record with a payload has none or another
kind; a revisit's is what it states, or null. A payload that differs from its
SHA-1, SHA-256 or MD5 is an error unless the record says it is truncated, as
are packages whose archives are compressed by ZIP or end inside a record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import frees_memory, join_measured, stored
from claimloom.operators.lookup import lookup
from claimloom.session import shared_folder

#: A package is closed once its archive has so many bytes.
PACKAGE_BYTES = 128 * 1024 * 1024
#: Bytes read at once; records of one package lie side by side, so a read serves several.
READ_BYTES = 1024 * 1024
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
FILES = "path string, bytes long, records long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, "
    "payload binary, payload_bytes long, payload_digest string, record_id string, refers_to_id string"
)
NO_ID = "null"
OWN_ID = re.compile(r"urn:page:(null|-?[0-9]{1,19})")
#: What archives and indexes are called.
ARCHIVES, INDEXES = re.compile(r"archive/.+\.warc(\.gz)?"), re.compile(r"indexes/.+\.cdxj?(\.gz)?")
#: Fixed so that a rewrite gives the same bytes.
DATE = "2000-01-01T00:00:00Z"
# Layout of ZIP records: fixed values of the format.
END, END64_LOCATOR, END64, ENTRY, LOCAL = b"PK\5\6", b"PK\6\7", b"PK\6\6", b"PK\1\2", b"PK\3\4"
ZIP64_EXTRA, STORED, FULL32, FULL16 = 1, 0, 0xFFFFFFFF, 0xFFFF


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_urn(page_id) -> str:
    return f"urn:page:{NO_ID if page_id is None else page_id}"


def page_of_urn(urn: str) -> int | None:
    """The page of a record id; null if it is the id of a row without one, or made elsewhere."""
    found = OWN_ID.fullmatch(urn)
    if found is None or found[1] == NO_ID:
        return None
    page = int(found[1])
    return page if -(2**63) <= page < 2**63 else None


def target(url: str | None) -> str:
    """A url as a header line can hold it."""
    return re.sub(r"[\s\x00-\x1f\x7f]", lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), url or "")


def index_key(url: str) -> str:
    """Host with its labels reversed, then the path: what lines of an index are sorted by."""
    host, slash, path = url.partition("://")[2].partition("/")
    return f"{','.join(reversed(host.lower().split('.')))}){slash}{path}" if host else url or "-"


# --- records ---------------------------------------------------------------


def record_bytes(page_id, url, payload: bytes, refers_to, digest: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and leaves the payload out."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{page_urn(page_id)}>",
        f"WARC-Target-URI: {target(url)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines.insert(4, f"WARC-Refers-To: <{page_urn(refers_to)}>")
        lines.insert(5, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes, encoding: str = "utf-8") -> dict[str, str]:
    pairs = (line.partition(":") for line in re.split("\r?\n", raw.decode(encoding, "replace"))[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs if name}


def unchunked(data: bytes) -> bytes:
    """The payload of a chunked transfer; data that is not chunked stays as it is."""
    out, at = [], 0
    while True:
        size = re.compile(rb"([0-9A-Fa-f]{1,15})[^\r\n]*\r\n").match(data, at)
        if size is None:
            return data
        length = int(size[1], 16)
        if not length:
            return b"".join(out)
        out.append(data[size.end() : size.end() + length])
        at = size.end() + length + 2


def matches(payload: bytes, digest: str) -> bool:
    """Whether a labelled digest, in base32 or hex, is that of the payload; true for kinds not known here."""
    kind, _, value = digest.partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in ("sha1", "sha256", "md5"):
        return True
    found = hashlib.new(kind, payload)
    return value.rstrip("=").upper() in (found.hexdigest().upper(), base64.b32encode(found.digest()).decode().rstrip("="))


def parse_record(raw: bytes) -> dict:
    """Fields of one record; a payload is held against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    kind, stated = warc["warc-type"], warc.get("warc-payload-digest")
    record_id, refers_to = warc["warc-record-id"].strip("<>"), warc.get("warc-refers-to")
    refers_to = refers_to and refers_to.strip("<>")
    http, payload = {}, block
    if warc.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
        header, _, payload = block.partition(b"\r\n\r\n")
        http = _headers(header, "latin-1")
    if kind == "revisit":
        length = http.get("content-length", "")
        payload, size = None, int(length) if re.fullmatch("[0-9]{1,18}", length) else None
        digest = stated and re.sub("^sha-?1:", "", stated, flags=re.IGNORECASE)
    else:
        whole = unchunked(payload) if http.get("transfer-encoding", "").lower() == "chunked" else payload
        if stated and "warc-truncated" not in warc and not any(matches(p, stated) for p in (whole, payload)):
            raise ValueError(f"payload of <{record_id}> does not match its digest")
        payload, size, digest = whole, len(whole), base32_sha1(whole)
    return {
        "page_id": page_of_urn(record_id),
        "url": warc.get("warc-target-uri", "").strip("<>"),
        "record_type": kind,
        "refers_to": refers_to and page_of_urn(refers_to),
        "payload": payload,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_id": record_id,
        "refers_to_id": refers_to,
    }


# --- writing ---------------------------------------------------------------


class _Counted(io.RawIOBase):
    """Output without seeking, as object stores give it."""

    def __init__(self, sink):
        self.sink, self.done = sink, 0

    def writable(self):
        return True

    def write(self, data):
        self.sink.write(bytes(data))
        self.done += len(data)
        return len(data)


class Package:
    """One ZIP file that is written from front to back."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, place = pafs.FileSystem.from_uri(self.path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = _Counted(system.open_output_stream(place))
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.archive = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, page_id, url, payload: bytes, refers_to) -> None:
        digest = base32_sha1(payload)
        packer = zlib.compressobj(3, zlib.DEFLATED, 31)
        raw = packer.compress(record_bytes(page_id, url, payload, refers_to, digest)) + packer.flush()
        self.archive.write(raw)
        place = {"url": target(url), "mime": "warc/revisit" if refers_to is not None else "text/html", "status": "200"}
        place |= {"digest": f"sha1:{digest}", "length": str(len(raw)), "offset": str(self.size)}
        time = "".join(c for c in DATE if c.isdigit())
        line = json.dumps(place | {"filename": ARCHIVE.rpartition("/")[2]})
        self.index.append(f"{index_key(target(url))} {time} {line}")
        self.size += len(raw)

    def close(self) -> tuple[str, int, int]:
        self.archive.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(sorted(self.index)).encode())
        self.zip.close()
        self.out.sink.close()
        return self.path, self.out.done, len(self.index)


@frees_memory
def write_packages(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Write the rows of a task; yields the files it closed."""
    package, done = None, []
    for batch in batches:
        for row in batch.to_pylist():
            package = package or Package(folder)
            package.add(row["page_id"], row["url"], (row["html"] or "").encode(), row["refers_to"])
            if package.size >= PACKAGE_BYTES:
                done.append(package.close())
                package = None
    if package:
        done.append(package.close())
    paths, sizes, records = zip(*done) if done else ((), (), ())
    yield pa.record_batch(
        [pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(records, pa.int64())],
        names=["path", "bytes", "records"],
    )


# --- reading ---------------------------------------------------------------


def _zip64(extra: bytes, wanted: list[bool]) -> list[int]:
    """The 64-bit values an entry keeps in its extra field, for the fields that overflow."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_EXTRA:
            return list(struct.unpack_from(f"<{sum(wanted)}Q", extra, at + 4))
        at += 4 + size
    raise ValueError("a ZIP entry lacks its 64-bit sizes")


def directory_place(source, size: int) -> tuple[int, int, int]:
    """Offset, length and number of entries of the central directory."""
    tail_at = max(0, size - 22 - FULL16)
    source.seek(tail_at)
    tail = source.read(size - tail_at)
    end = tail.rfind(END)
    if end < 0:
        raise ValueError("no ZIP: it has no end of central directory")
    entries, length, offset = struct.unpack_from("<HII", tail, end + 10)
    if FULL16 == entries or FULL32 in (length, offset):
        locator = tail.rfind(END64_LOCATOR, 0, end)
        if locator < 0:
            raise ValueError("a ZIP64 package lacks its locator")
        source.seek(struct.unpack_from("<Q", tail, locator + 8)[0])
        record = source.read(56)
        if record[:4] != END64:
            raise ValueError("a ZIP64 package lacks its end record")
        entries, length, offset = struct.unpack_from("<QQQ", record, 32)
    return offset, length, entries


def members(source, size: int) -> dict[str, tuple[int, int]]:
    """Name → (offset of its first byte, bytes) of each stored member."""
    offset, length, entries = directory_place(source, size)
    source.seek(offset)
    directory, found, at = source.read(length), {}, 0
    for _ in range(entries):
        if directory[at : at + 4] != ENTRY:
            raise ValueError("the central directory ends early")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, full = struct.unpack_from("<II", directory, at + 20)
        name_size, extra_size, note_size = struct.unpack_from("<HHH", directory, at + 28)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + name_size].decode("utf-8", "replace")
        extra = directory[at + 46 + name_size :][:extra_size]
        over = [full == FULL32, packed == FULL32, header == FULL32]
        if any(over):
            large = iter(_zip64(extra, over))
            full, packed, header = (next(large) if o else v for o, v in zip(over, (full, packed, header)))
        at += 46 + name_size + extra_size + note_size
        if method != STORED and ARCHIVES.fullmatch(name):
            raise ValueError(f"{name} is compressed by ZIP, so its records have no byte ranges")
        if method == STORED:
            source.seek(header)
            local = source.read(30)
            if local[:4] != LOCAL:
                raise ValueError(f"{name} has no local header where the directory says")
            found[name] = (header + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
    return found


class Span(NamedTuple):
    """Bytes of a package that hold one record, as an index says, or any number of records."""

    offset: int
    length: int
    indexed: bool
    zipped: bool


def indexed_places(source, found: dict[str, tuple[int, int]]) -> dict[str, set[tuple[int, int]]]:
    """Archive → (offset in it, length) of the records that the stored indexes list."""
    archives = [name for name in found if ARCHIVES.fullmatch(name)]
    by_file: dict[str, list[str]] = {}
    for name in archives:
        by_file.setdefault(name.rpartition("/")[2], []).append(name)
    places: dict[str, set[tuple[int, int]]] = {name: set() for name in archives}
    for index in (name for name in found if INDEXES.fullmatch(name)):
        start, length = found[index]
        source.seek(start)
        data = source.read(length)
        if index.endswith(".gz"):
            data = b"".join(inflated([data]))
        for line in data.splitlines():
            at = line.find(b"{")
            if at < 0:
                continue  # a header or blank line
            entry = json.loads(line[at:])
            if "offset" not in entry or "length" not in entry:
                continue  # a line about the index itself
            file = str(entry.get("filename", "")).rpartition("/")[2]
            meant = by_file.get(file, []) if file else archives
            if not meant:
                raise ValueError(f"{index} names {file}, which the package lacks")
            if len(meant) == 1:  # else it is not known which; such archives are read through
                places[meant[0]].add((int(entry["offset"]), int(entry["length"])))
    return places


def spans(source, size: int) -> list[Span]:
    """All bytes of the stored archives: indexed records, and what lies between them."""
    found = members(source, size)
    if not any(ARCHIVES.fullmatch(name) for name in found):
        raise ValueError("a package lacks its stored archive")
    out = []
    for name, places in sorted(indexed_places(source, found).items()):
        start, length = found[name]
        done, zipped = 0, name.endswith(".gz")
        for offset, size_of_record in sorted(places):
            if offset < done or offset + size_of_record > length:
                raise ValueError(f"records of {name} overlap or lie outside of it")
            if offset > done:
                out.append(Span(start + done, offset - done, False, zipped))
            out.append(Span(start + offset, size_of_record, True, zipped))
            done = offset + size_of_record
        if done < length:
            out.append(Span(start + done, length - done, False, zipped))
    return out


def record_ranges(source, size: int) -> list[tuple[int, int]]:
    """Byte ranges of the records that the indexes of the package list, in file order."""
    return [(s.offset, s.length) for s in spans(source, size) if s.indexed]


def read_ranges(source, ranges: Iterable[tuple[int, int]]) -> Iterator[bytes]:
    """The bytes of each range; neighbours share a read."""
    held, held_at = b"", 0
    for offset, length in ranges:
        if not held_at <= offset or offset + length > held_at + len(held):
            source.seek(offset)
            held, held_at = source.read(max(length, READ_BYTES)), offset
        yield held[offset - held_at : offset - held_at + length]


def inflated(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """What gzip members, one after the other, hold; at most ``READ_BYTES`` at a time."""
    unpacker = None
    for chunk in chunks:
        while chunk or unpacker:
            unpacker = unpacker or zlib.decompressobj(31)
            data = unpacker.decompress(chunk, READ_BYTES)
            yield data
            if unpacker.eof:
                chunk, unpacker = unpacker.unused_data, None
            elif unpacker.unconsumed_tail or len(data) == READ_BYTES:
                chunk = unpacker.unconsumed_tail
            else:
                break
    if unpacker:
        raise ValueError("an archive ends inside a record")


def split_records(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The records of a stream, each by the length that its header states."""
    held, needed = bytearray(), None
    for chunk in chunks:
        held += chunk
        at = 0
        while True:
            if needed is None:
                while held[at : at + 1] in (b"\r", b"\n"):
                    at += 1
                end = held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                needed = end + 4 - at + int(_headers(bytes(held[at:end]))["content-length"])
            if len(held) - at < needed:
                break
            yield bytes(held[at : at + needed])
            at, needed = at + needed, None
        del held[:at]
    if held.strip(b"\r\n"):
        raise ValueError("an archive ends inside a record")


def records_of(source, size: int) -> Iterator[dict]:
    """All records of a package, in file order."""
    listed = spans(source, size)
    steps = [
        (at, min(READ_BYTES, s.offset + s.length - at), n)
        for n, s in enumerate(listed)
        for at in range(s.offset, s.offset + s.length, READ_BYTES)
    ]
    reads = zip((n for *_, n in steps), read_ranges(source, ((at, length) for at, length, _ in steps)))
    for number, some in groupby(reads, key=itemgetter(0)):
        chunks = (chunk for _, chunk in some)
        yield from map(parse_record, split_records(inflated(chunks) if listed[number].zipped else chunks))


@frees_memory
def read_packages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the packages named in ``path``, about ``READ_BYTES`` of payload at a time."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        + [("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        + [("record_id", pa.string()), ("refers_to_id", pa.string())]
    )
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, place = pafs.FileSystem.from_uri(path)
            rows, held = [], 0
            with system.open_input_file(place) as source:
                for record in records_of(source, source.size()):
                    rows.append(record)
                    held += len(rows[-1]["payload"] or b"") + 200
                    if held >= READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)


# --- frames ----------------------------------------------------------------


def identity(payload: Column) -> Column:
    """Equal for equal payloads only; SHA-1, which records carry, can be made to collide."""
    return F.concat_ws(":", F.sha2(payload, 256), F.octet_length(payload))


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, digest and refers_to of the payloads that a smaller page_id has too."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    thin = stored(
        pages.select(F.col("page_id").cast("long").alias("page_id"), payload.alias("payload"))
        .where(F.octet_length("payload") >= min_bytes)
        .select("page_id", identity(F.col("payload")).alias("digest")),
        "page-digests",
    )
    first = (
        thin.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("refers_to").isNotNull())
        .drop("n")
    )
    found = lookup(thin, stored(first, "first-pages"), "digest", ["page_id"], "inner")
    later = found.where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return later.select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write all pages; returns the stored list of packages (path, bytes, records)."""
    folder = folder or f"{shared_folder(pages.sparkSession)}/llm/archives-{uuid.uuid4().hex}"
    # an id may stand for several payloads (as null does), so the verdict goes by id and payload
    digest = identity(F.coalesce(F.col("html"), F.lit("")).cast("binary")).alias("digest")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", digest)
    later = stored(revisits(pages, min_bytes), "revisits")
    marked = join_measured(rows, later, ["page_id", "digest"], "left").drop("digest")
    return stored(marked.mapInArrow(partial(write_packages, folder=folder), FILES), "packages")


def read_archives(packages: DataFrame) -> DataFrame:
    """All records of the packages; a package is read by one task."""
    paths = packages.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(read_packages, RECORDS)


def files_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A list of packages made elsewhere, as ``read_archives`` takes it."""
    return spark.createDataFrame([(p,) for p in paths], "path string")
