"""Web archives in ZIP packages: written from rows, read by ranges without extraction."""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import numpy as np
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm.common import by_unit, map_arrow, runs, slices, stored
from earshot.session import shared_folder

#: Fixed values of the ZIP format: signatures and layouts.
LOCAL, CENTRAL, END, END64, LOCATOR64 = (b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07")
LOCAL_REST, CENTRAL_REST, END_REST, END64_REST, LOCATOR64_REST = ("<5H3I2H", "<6H3I5H2I", "<4H2IH", "<Q2H2I4Q", "<IQI")
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF

#: A record as it is read back.
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc", "indexes/index.cdxj"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class Zip:
    """The stored members of a ZIP package, found from its end; only ranges that are asked for are read."""

    def __init__(self, file: BinaryIO):
        self.file = file
        self.size = file.seek(0, io.SEEK_END)
        self.members = dict(self._directory())

    def read(self, at: int, size: int) -> bytes:
        if at < 0 or size < 0 or at + size > self.size:
            raise ValueError(f"range {at}+{size} is outside the package of {self.size} bytes")
        self.file.seek(at)
        return self.file.read(size)

    def _end(self) -> tuple[int, int, int]:
        """Number of members, size and place of the central directory."""
        tail = self.read(max(0, self.size - 22 - FULL16), min(self.size, 22 + FULL16))
        at = tail.rfind(END)
        while at >= 0:
            if len(tail) - at >= 22:
                *_, here, total, size, place, comment = struct.unpack(END_REST, tail[at + 4 : at + 22])
                if at + 22 + comment == len(tail):
                    break
            at = tail.rfind(END, 0, at)
        else:
            raise ValueError("no end of a central directory")
        start = self.size - len(tail) + at
        if FULL16 in (here, total) or FULL32 in (size, place):
            locator = self.read(start - 20, 20) if start >= 20 else b""
            if locator[:4] == LOCATOR64:
                _, record, _ = struct.unpack(LOCATOR64_REST, locator[4:])
                head = self.read(record, 56)
                if head[:4] != END64:
                    raise ValueError("no ZIP64 end record where its locator points")
                *_, total, size, place = struct.unpack(END64_REST, head[4:])
        return total, size, place

    def _directory(self) -> Iterator[tuple[str, tuple[int, int, int]]]:
        """(name, (method, place of the local header, size)) of each member."""
        total, size, place = self._end()
        listed = self.read(place, size)
        at = 0
        for _ in range(total):
            if listed[at : at + 4] != CENTRAL:
                raise ValueError("the central directory is damaged")
            (_, _, _, method, _, _, _, packed, whole, names, extras, comments, _, _, _, local) = struct.unpack(
                CENTRAL_REST, listed[at + 4 : at + 46]
            )
            name = listed[at + 46 : at + 46 + names].decode("utf-8")
            extra = listed[at + 46 + names : at + 46 + names + extras]
            wanted = [FULL32 == v for v in (whole, packed, local)]
            if any(wanted):
                values = self._wide(extra)
                whole, packed, local = (next(values) if w else v for w, v in zip(wanted, (whole, packed, local)))
            yield name, (method, local, packed)
            at += 46 + names + extras + comments

    @staticmethod
    def _wide(extra: bytes) -> Iterator[int]:
        """The 64-bit values of a ZIP64 extra field, in their order."""
        at = 0
        while at + 4 <= len(extra):
            kind, size = struct.unpack("<2H", extra[at : at + 4])
            if kind == 1:
                yield from (v for (v,) in struct.iter_unpack("<Q", extra[at + 4 : at + 4 + size // 8 * 8]))
            at += 4 + size

    def place(self, name: str) -> tuple[int, int]:
        """Where the bytes of a stored member lie: (start, size)."""
        method, local, size = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed in the package; only stored members can be read by ranges")
        head = self.read(local, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        names, extras = struct.unpack("<2H", head[26:30])
        return local + 30 + names + extras, size


def local_header(name: str, size: int, check: int, wide: bool) -> bytes:
    """What stands before a stored member."""
    raw, short = name.encode(), FULL32 if wide else size
    extra = struct.pack("<2H2Q", 1, 16, size, size) if wide else b""
    fixed = struct.pack(LOCAL_REST, 45 if wide else 20, 1 << 11, 0, 0, 33, check, short, short, len(raw), len(extra))
    return LOCAL + fixed + raw + extra


def directory(members: list[tuple[str, int, int, int, bool]], place: int, wide: bool) -> bytes:
    """What stands at the end of a package, from `place` on, for members (name, size, crc32, place, wide)."""
    listed = bytearray()
    for name, size, check, at, big in members:
        raw, short, version = name.encode(), FULL32 if big else size, 45 if big else 20
        extra = struct.pack("<2H3Q", 1, 24, size, size, at) if big else b""
        listed += CENTRAL + struct.pack(
            CENTRAL_REST, version, version, 1 << 11, 0, 0, 33, check, short, short, len(raw), len(extra), 0, 0, 0, 0,
            FULL32 if big else at,
        )
        listed += raw + extra
    n, record = len(members), place + len(listed)
    if wide or record >= FULL32 or n >= FULL16:
        end = END64 + struct.pack(END64_REST, 44, 45, 45, 0, 0, n, n, len(listed), place)
        end += LOCATOR64 + struct.pack(LOCATOR64_REST, 0, record, 1)
        end += END + struct.pack(END_REST, FULL16, FULL16, FULL16, FULL16, FULL32, FULL32, 0)
    else:
        end = END + struct.pack(END_REST, 0, 0, n, n, len(listed), place, 0)
    return bytes(listed) + end


def zip_package(members: list[tuple[str, bytes]], wide: bool = False) -> bytes:
    """A package of stored members; `wide`: with ZIP64 fields and records, as large ones need."""
    out, listed = bytearray(), []
    for name, content in members:
        at, check = len(out), zlib.crc32(content)
        big = wide or len(content) >= FULL32 or at >= FULL32
        out += local_header(name, len(content), check, big) + content
        listed.append((name, len(content), check, at, big))
    return bytes(out + directory(listed, len(out), wide))


def _header(first: str, fields: list[tuple[str, object]]) -> bytes:
    lines = [first, *(f"{k}: {v}" for k, v in fields if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _one_line(text: str) -> str:
    """A header's value has no line breaks."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def _index_url(url: str | None) -> str:
    """A url as one word of an index line: blanks, controls and line ends of any kind are percent-encoded."""
    return "".join(c if c.isprintable() and not c.isspace() else quote(c, errors="replace") for c in url or "-") or "-"


def record_id(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def warc_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A response with its payload, or a revisit that holds the response's HTTP header only."""
    http = _header("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    body = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"),
        ("WARC-Record-ID", record_id(page_id) if page_id is not None else "<urn:page:none>"),
        ("WARC-Target-URI", None if url is None else _one_line(url)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", record_id(refers_to) if refers_to is not None else None),
        (
            "WARC-Profile",
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if refers_to is not None else None,
        ),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(body)),
    ]
    return _header("WARC/1.1", fields) + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of a record and its payload; a gzip member is opened first."""
    if raw[:2] == b"\x1f\x8b":
        raw = zlib.decompress(raw, 31)
    head, found, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not found or not first.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    body = rest[: int(fields["content-length"])]
    if len(body) < int(fields["content-length"]):
        raise ValueError("the record is cut short")
    http, _, payload = body.partition(b"\r\n\r\n")
    http_fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode("utf-8").split("\r\n")[1:])}
    return {"fields": fields, "http": http_fields, "payload": payload}


def _page(uri: str | None) -> int | None:
    return None if uri is None or uri == "<urn:page:none>" else int(uri.removeprefix("<urn:page:").removesuffix(">"))


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """`pages` (page_id, url, html) with refers_to: of the rows with equal payloads of at least
    `least_bytes` bytes, the largest page_id is the response the others refer to; null for responses.

    Only digests that come twice are joined back, from a written table: where those are few they are
    broadcast by their known size and the pages stay where they are.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    keyed = pages.select("page_id", "url", "html", F.sha1(payload).alias("_sha1"), F.octet_length(payload).alias("_size"))
    shared = (
        keyed.where(F.col("_size") >= least_bytes)
        .groupBy("_sha1", "_size")
        .agg(F.max("page_id").alias("_kept"), F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > 1) & F.col("_kept").isNotNull())
        .drop("_n")
    )
    joined = keyed.join(stored(shared, "payloads"), ["_sha1", "_size"], "left")
    first = F.col("_kept").isNull() | F.col("page_id").eqNullSafe(F.col("_kept"))
    return joined.select("page_id", "url", "html", F.when(first, None).otherwise(F.col("_kept")).alias("refers_to"))


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or uri (file:, hdfs:, s3: and what else pyarrow knows), and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace(":/", ":///", 1))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = 8 << 20, wide_percent: int = 25) -> DataFrame:
    """Write ZIP packages of about `archive_bytes` to `folder`, each with a WARC member and its index, and return
    their `path` and `records`. The files are written when the result is.

    `records` are rows as `plan_records` gives them. A task packs the rows it holds, a package at a time, and
    names it after its content, so a task that is run again writes the same files. `wide_percent` of the packages
    have ZIP64 fields and records, which all that are large enough to need them have.
    """

    def package(records: list[bytes], pages: list) -> bytes:
        index, at = [], 0
        for raw, (page_id, url, digest, kind) in zip(records, pages):
            entry = {"offset": at, "length": len(raw), "digest": f"sha1:{digest}", "type": kind, "page": page_id}
            index.append(f"{_index_url(url)} 19700101000000 {json.dumps(entry)}\n")
            at += len(raw)
        members = [(WARC_MEMBER, b"".join(records)), (INDEX_MEMBER, "".join(index).encode())]
        return zip_package(members, zlib.crc32(members[1][1]) % 100 < wide_percent)

    def run(batches):
        store, place = _store(folder)
        store.create_dir(place, recursive=True)
        for batch in slices(batches, "html", archive_bytes):
            records, pages = [], []
            for row in batch.to_pylist():
                payload = (row["html"] or "").encode()
                digest = sha1_base32(payload)
                records.append(warc_record(row["page_id"], row["url"], payload, digest, row["refers_to"]))
                kind = "response" if row["refers_to"] is None else "revisit"
                pages.append((row["page_id"], row["url"], digest, kind))
            content = package(records, pages)
            name = f"{hashlib.sha1(content).hexdigest()}.wacz"
            draft = f"{place}/_{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(content)
            store.move(draft, f"{place}/{name}")
            yield [f"{folder}/{name}"], [len(records)]

    return map_arrow(records, run, "path string, records long")


def _index_lines(package: Zip, piece: int = 1 << 20) -> Iterator[str]:
    """The lines of a package's index, read a piece at a time. Only a line feed ends a line."""
    start, size = package.place(INDEX_MEMBER)
    rest = b""
    for at in range(0, size, piece):
        *lines, rest = (rest + package.read(start + at, min(piece, size - at))).split(b"\n")
        yield from (line.decode("utf-8") for line in lines)
    if rest:
        yield rest.decode("utf-8")


def list_records(archives: DataFrame) -> DataFrame:
    """(path, number, start, length) of every record of the packages at `path`: the tail of each file leads to the
    directory, the directory to the index, and the index to the ranges. Nothing else is read."""

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, place = _store(path)
                with store.open_input_file(place) as file:
                    package = Zip(file)
                    start, size = package.place(WARC_MEMBER)
                    starts, lengths, first = [], [], 0
                    for line in _index_lines(package):
                        entry = json.loads(line.split(" ", 2)[2])
                        if entry["offset"] < 0 or entry["offset"] + entry["length"] > size:
                            raise ValueError(f"{path}: an entry of the index lies outside its member")
                        starts.append(start + entry["offset"])
                        lengths.append(entry["length"])
                        if len(starts) == 10_000:
                            yield [path] * len(starts), np.arange(first, first + len(starts)), starts, lengths
                            starts, lengths, first = [], [], first + len(starts)
                    yield [path] * len(starts), np.arange(first, first + len(starts)), starts, lengths

    return map_arrow(archives.select("path"), run, "path string, number long, start long, length long")


def read_archives(archives: DataFrame, together: int = 256, piece: int = 8 << 20) -> DataFrame:
    """A row per record of the ZIP packages at `path`, whatever their size; nothing is extracted.

    Records are listed first (`list_records`); their ranges, `together` of one package at a time, are dealt out to
    all tasks, which open the file, go to the ranges and read them, adjacent ones at once up to
    `piece` bytes. Records whose payload does not match their digest end the run with an error.
    """
    listed = list_records(archives)
    unit = F.xxhash64("path", F.floor(F.col("number") / together))
    dealt = by_unit(listed.withColumn("unit", unit), "unit", "path", "start")
    names = [f.name for f in T.StructType.fromDDL(RECORD).fields]

    def run(batches):
        for table in runs(batches, "unit"):
            for path in table.column("path").unique().to_pylist():
                own = table.filter(pc.equal(table.column("path"), path))
                store, place = _store(path)
                with store.open_input_file(place) as file:
                    spans = zip(own.column("start").to_pylist(), own.column("length").to_pylist())
                    for raw in _ranges(file, list(spans), piece):
                        rows = [read_record(r) for r in raw]
                        yield [[r[n] for r in rows] for n in names]

    return map_arrow(dealt, run, RECORD)


def _ranges(file, spans: list[tuple[int, int]], piece: int) -> Iterator[list[bytes]]:
    """The bytes of (start, length) spans in rising order, as many as are read at once in a list."""
    at = 0
    while at < len(spans):
        stop, end = at + 1, spans[at][0] + spans[at][1]
        while stop < len(spans) and spans[stop][0] == end and end + spans[stop][1] - spans[at][0] <= piece:
            end += spans[stop][1]
            stop += 1
        file.seek(spans[at][0])
        raw = file.read(end - spans[at][0])
        yield [raw[s - spans[at][0] : s - spans[at][0] + n] for s, n in spans[at:stop]]
        at = stop


def read_record(raw: bytes) -> dict:
    record = parse_record(raw)
    fields, payload = record["fields"], record["payload"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and sha1_base32(payload) != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": int(record["http"]["content-length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload": payload if kind == "response" else None,
    }


def archive_pages(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = 8 << 20) -> DataFrame:
    """Write `pages` (page_id, url, html) as packaged archives to the shared folder and read them back.

    Returns page_id, url, payload_bytes, payload_digest (of the full payload, also for revisits),
    record_type, refers_to, payload (null for revisits).

    Null html: an empty payload. Null url: no target. Null page_id: its row never is what others refer
    to; a payload only such rows share has responses only. Rows with equal page_id and payload are
    responses both if that id is the largest. Line breaks in a url are percent-encoded, in the index also blanks
    and controls. Empty table: no records. Other columns are ignored.
    """
    spark = pages.sparkSession
    written = write_archives(plan_records(pages, least_bytes), shared_folder(spark, "archives"), archive_bytes)
    return read_archives(stored(written, "archive-names"))
