"""WARC records in ZIP archives: written as stored members with an index, read back by ranges.

Each archive written here holds ``archive/data.warc.gz`` (every record a gzip member of
its own) and ``indexes/index.cdxj`` (a line per record: key, time and JSON with its file,
offset and length), both stored without compression, so that a record can be read from the
archive where it lies. Archives from elsewhere may hold any number of ``archive/*.warc.gz``
or ``*.warc`` and of ``indexes/*.cdx``, ``*.cdxj`` or either of them gzipped; records
without an id have none. The reader finds the end-of-directory record, follows the ZIP64 locator where
there is one, parses the central directory, works out where a stored member's bytes
begin, reads the index through and then reads records by range, many records to a
task. Nothing is unpacked.

Payloads of at least ``LEAST_REVISIT`` bytes that occur several times are written
once, with the row of the smallest id; the others become revisit records that name
it. Files are opened through ``pyarrow.fs`` by the URI of the shared folder; a path without
a scheme is on Spark's default store.

Defined results: a NULL payload is an empty one; rows without an id are responses;
rows that repeat the smallest id of a payload are responses too; a NULL URL becomes
``urn:none``; an empty table gives no archives and no records; other columns never
matter.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.llm.frames import bounded_batches, shuffle_partitions
from comarca.session import scratch_path
from comarca.sinks.pinned import pin

LEAST_REVISIT = 100
ARCHIVE_BYTES = 1 << 28
# Records that one range request may join where they lie next to each other.
RANGE_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
INDEX_NAME = re.compile(r"indexes/.*\.cdxj?(\.gz)?")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def warc_record(kind: str, url: str, page_id, digest: str, payload: bytes, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit carries no payload."""
    block = b"" if kind == "revisit" else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
    return headers, rest[: int(headers["content-length"])]


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP header."""
    return block.partition(b"\r\n\r\n")[2]


# ---- writing ------------------------------------------------------------------


def url_key(url: str) -> str:
    """A URL with its host turned round, as index lines begin; blanks would end it."""
    host, _, path = re.sub(r"^[a-z]+://", "", url.lower()).partition("/")
    return re.sub(r"\s", "%20", ",".join(reversed(host.split("."))) + ")/" + path)


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI and the path in it; Hadoop writes local ones with one slash."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[5:]
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def qualified(spark: SparkSession, folder: str) -> str:
    """A path with the scheme of the store that Spark would read it from."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


class _Counted:
    """A sequential file for ``zipfile`` that knows its position."""

    def __init__(self, out):
        self.out, self.at = out, 0

    def write(self, data) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def flush(self):
        self.out.flush()


def write_archive(out, records: Iterable[tuple[bytes, dict]], most_bytes: int) -> int:
    """Writes records until ``most_bytes`` are reached; returns the number written."""
    entries, offset = [], 0
    with zipfile.ZipFile(_Counted(out), "w", zipfile.ZIP_STORED) as archive:
        with archive.open(DATA, "w", force_zip64=True) as member:
            for record, about in records:
                packed = gzip.compress(record, compresslevel=3, mtime=0)
                member.write(packed)
                place = {"filename": DATA.split("/")[-1], "offset": str(offset), "length": str(len(packed))}
                key, time = url_key(about["url"]), re.sub(r"\D", "", DATE)
                entries.append(f"{key} {time} {json.dumps(about | place)}")
                offset += len(packed)
                if offset >= most_bytes:
                    break
        archive.writestr(INDEX, "".join(line + "\n" for line in entries))
    return len(entries)


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes every row as a record; returns the archives that count: (archive, records).

    Each attempt of a task writes archives under names of its own, and the list
    names those of the attempt that Spark committed, so a lost executor or a
    repeated task neither loses nor doubles records.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = qualified(spark, folder or scratch_path(spark, "archives"))
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.coalesce(F.col(url), F.lit("urn:none")).alias("url"),
                        body.alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256))
    first = (
        rows.where(F.length("body") >= LEAST_REVISIT)
        .groupBy(F.col("digest").alias("same")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL").drop("n")
    )
    marked = rows.join(first, F.col("digest") == F.col("same"), "left").select(
        # As text: a NULL beside them would make doubles of long numbers.
        F.col("id").cast("string").alias("id"), "url", "digest",
        F.when(F.col("id") > F.col("first"), F.col("first")).cast("string").alias("refers_to"),
        F.when(F.col("id") > F.col("first"), F.lit(None)).otherwise(F.col("body")).alias("body"),
    )

    def write(batches):
        def records():
            for batch in batches:
                for r in batch.itertuples(index=False):
                    again = r.refers_to is not None
                    kind = "revisit" if again else "response"
                    own = None if r.id is None else int(r.id)
                    refers = int(r.refers_to) if again else None
                    yield (
                        warc_record(kind, r.url, own, r.digest, b"" if again else bytes(r.body), refers),
                        {"id": own, "type": kind, "refers_to": refers, "url": r.url, "digest": r.digest},
                    )

        store, root = store_of(folder)
        store.create_dir(root, recursive=True)
        waiting = records()
        held = next(waiting, None)
        while held is not None:
            name = f"{root}/{uuid.uuid4().hex}.wacz"
            with store.open_output_stream(name) as out:
                written = write_archive(out, chain([held], waiting), archive_bytes)
            yield pd.DataFrame({"archive": [name], "records": [written]})
            held = next(waiting, None)

    listed = marked.mapInPandas(write, "archive string, records long").withColumn("folder", F.lit(folder))
    return pin(listed, "archive-list")


# ---- reading ------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


def _zip64(extra: bytes, values: list[int]) -> list[int]:
    """Fields of 0xFFFFFFFF replaced from the ZIP64 extra field, in the order of the format."""
    at = 0
    while at + 4 <= len(extra):
        tag, length = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return [next(wide) if v == 0xFFFFFFFF else v for v in values]
        at += 4 + length
    return values


def read_directory(file, size: int) -> list[Member]:
    """Members of the archive from its central directory, ZIP64 or not; reads the tail and the directory only."""
    tail_at = max(0, size - 65_557)
    file.seek(tail_at)
    tail = file.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    # A comment may hold the mark too: the record's comment is what is left of the file.
    while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("not a ZIP archive: it has no end-of-directory record")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):
        locator = tail.rfind(b"PK\x06\x07", 0, end)
        if locator < 0:
            raise ValueError("a ZIP64 archive without a locator")
        (at,) = struct.unpack_from("<Q", tail, locator + 8)
        file.seek(at)
        wide = file.read(56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 locator points nowhere")
        count, length, start = struct.unpack_from("<QQQ", wide, 32)
    file.seek(start)
    directory = file.read(length)
    members, at = [], 0
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("a broken central directory")
        (method,) = struct.unpack_from("<H", directory, at + 10)
        packed, plain, names, extras, comments = struct.unpack_from("<IIHHH", directory, at + 20)
        (header,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + names].decode()
        extra = directory[at + 46 + names : at + 46 + names + extras]
        plain, packed, header = _zip64(extra, [plain, packed, header])
        members.append(Member(name, method, packed, header))
        at += 46 + names + extras + comments
    return members


def stored_start(file, member: Member) -> int:
    """Where a stored member's bytes begin in the archive."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed: it can't be read by ranges")
    file.seek(member.header)
    head = file.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"{member.name} has no local header")
    names, extras = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + names + extras


def index_lines(file, start: int, size: int, packed: bool = False) -> Iterator[dict]:
    """Entries of an index member, gzipped or plain, read some megabytes at a time."""
    rest, at, unpack = b"", start, zlib.decompressobj(wbits=31)
    while at < start + size:
        file.seek(at)
        block = file.read(min(RANGE_BYTES, start + size - at))
        at += len(block)
        plain = block if not packed else b""
        while packed and block:
            plain += unpack.decompress(block)
            # Several gzip members may follow each other.
            block = unpack.unused_data
            unpack = zlib.decompressobj(wbits=31) if unpack.eof else unpack
        *lines, rest = (rest + plain).split(b"\n")
        yield from (entry for line in lines if (entry := index_entry(line)))
    if entry := index_entry(rest):
        yield entry


def index_entry(line: bytes) -> dict | None:
    """What a line says: JSON alone or behind key and time, or the columns of the older kind; None for others."""
    text = line.decode("utf-8", "replace").strip()
    if not text or text.startswith(("!", "#", "CDX")):
        return None
    at = text.find("{")
    if at >= 0:
        return json.loads(text[at:])
    columns = text.split(" ")
    if len(columns) != 11:
        raise ValueError(f"an index line of {len(columns)} columns")
    # Fixed order: key, time, URL, type, status, digest, redirect, tags, length, offset, file.
    names = ("key", "time", "url", "mime", "status", "digest", "redirect", "tags", "length", "offset", "filename")
    return dict(zip(names, columns))


def located_entry(entry: dict, starts: dict[str, int]) -> tuple:
    """(offset in the archive, length, id, type, refers_to, url, digest) of an index entry."""
    name = entry.get("filename")
    if name is None and len(starts) == 1:
        (name,) = starts
    name = name if name in starts else f"archive/{str(name).rsplit('/', 1)[-1]}"
    if name not in starts:
        raise ValueError(f"the index names {name}, which the archive does not hold")
    kind = entry.get("type") or ("revisit" if entry.get("mime") == "warc/revisit" else "response")
    numbers = [int(entry[k]) if entry.get(k) is not None else None for k in ("id", "refers_to")]
    digest = str(entry.get("digest") or "").removeprefix("sha256:") or None
    return starts[name] + int(entry["offset"]), int(entry["length"]), numbers[0], kind, numbers[1], entry.get("url"), digest


def read_indexes(archives: DataFrame) -> DataFrame:
    """A row per record: where it lies (archive, offset, length) and what its index says."""

    def read(batches):
        for batch in batches:
            for archive, folder in zip(batch["archive"], batch["folder"]):
                store, _ = store_of(folder)
                size = store.get_file_info(archive).size
                with store.open_input_file(archive) as file:
                    members = read_directory(file, size)
                    data = [m for m in members if m.name.startswith("archive/") and m.name.endswith((".warc", ".warc.gz"))]
                    starts = {m.name: stored_start(file, m) for m in data}
                    rows = []
                    for index in members:
                        if not INDEX_NAME.fullmatch(index.name):
                            continue
                        begin, packed = stored_start(file, index), index.name.endswith(".gz")
                        for entry in index_lines(file, begin, index.size, packed):
                            rows.append((archive, folder, *located_entry(entry, starts)))
                            if len(rows) == 10_000:
                                yield frame(rows)
                                rows = []
                    yield frame(rows)

    def frame(rows):
        names = ["archive", "folder", "offset", "length", "id", "type", "refers_to", "url", "digest"]
        columns = dict(zip(names, zip(*rows))) if rows else {name: [] for name in names}
        # Ids straight into whole numbers that may be missing, not by way of doubles.
        return pd.DataFrame({n: pd.array(list(c), dtype="Int64") if n in ("id", "refers_to") else list(c) for n, c in columns.items()})

    spread = archives.repartition(shuffle_partitions(archives.sparkSession))
    return spread.mapInPandas(
        read, "archive string, folder string, offset long, length long, id long, type string, refers_to long, "
              "url string, digest string"
    )


def read_records(located: DataFrame) -> DataFrame:
    """Reads the located records by range: (id, record_type, refers_to_id, record_id, url, digest, payload)."""

    def read(batches):
        for batch in batches:
            rows, held = [], 0
            for (archive, folder), group in batch.groupby(["archive", "folder"], sort=False):
                store, _ = store_of(folder)
                with store.open_input_file(archive) as file:
                    for run in adjoining(group.sort_values("offset")):
                        first = run[0][0]
                        file.seek(first)
                        block = file.read(run[-1][0] + run[-1][1] - first)
                        for offset, length, own in run:
                            packed = block[offset - first : offset - first + length]
                            plain = zlib.decompress(packed, wbits=31) if packed[:2] == b"\x1f\x8b" else packed
                            headers, content = parse_record(plain)
                            kind = headers["warc-type"]
                            payload = payload_of(content) if kind == "response" else None
                            held += len(payload or b"")
                            rows.append((own, kind, headers.get("warc-refers-to"), headers["warc-record-id"],
                                         headers.get("warc-target-uri"),
                                         headers.get("warc-payload-digest", "").removeprefix("sha256:") or None, payload))
                        if held > 4 * RANGE_BYTES:
                            yield frame(rows)
                            rows, held = [], 0
            yield frame(rows)

    def adjoining(group):
        """Runs of records that lie next to each other, each a few megabytes at most."""
        run = []
        for offset, length, own in zip(group["offset"], group["length"], group["id"]):
            if run and (run[-1][0] + run[-1][1] != offset or offset + length - run[0][0] > RANGE_BYTES):
                yield run
                run = []
            run.append((offset, length, own))
        if run:
            yield run

    def frame(rows):
        names = ["id", "record_type", "refers_to_record", "record_id", "url", "digest", "payload"]
        found = pd.DataFrame(rows, columns=names, dtype=object)
        return found.assign(id=pd.array([None if i is None else int(i) for i in found["id"]], dtype="Int64"))

    return located.withColumn("id", F.col("id").cast("string")).mapInPandas(
        read, "id long, record_type string, refers_to_record string, record_id string, url string, digest string, "
              "payload binary"
    )


def archive_round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Writes the pages, reads the archives and gives a row per record with its full payload's size and digest.

    A revisit's payload is the one of the response it names; the digest of every
    response is worked out again from the bytes that were read.
    """
    located = pin(read_indexes(write_archives(pages, page_id, url, payload)), "located")
    # Only responses that a revisit names are looked up by it.
    read = pin(
        read_records(located).select(
            "id", "record_type", "refers_to_record", "record_id", "digest",
            F.length("payload").cast("long").alias("bytes"), F.sha2("payload", 256).alias("read_digest"),
        ),
        "records",
    )
    named = read.where("record_type = 'revisit'").select(F.col("refers_to_record").alias("asked")).distinct()
    responses = (
        read.where("record_type = 'response'").join(named, F.col("record_id") == F.col("asked"), "left_semi")
        .groupBy(F.col("record_id").alias("named")).agg(
            F.first("id").alias("named_id"), F.first("bytes").alias("named_bytes"), F.first("read_digest").alias("named_digest"))
    )
    return read.join(responses, F.col("refers_to_record") == F.col("named"), "left").select(
        F.col("id").alias("page_id"),
        F.coalesce("bytes", "named_bytes").alias("payload_bytes"),
        F.coalesce("read_digest", "named_digest").alias("payload_digest"),
        "record_type",
        F.col("named_id").alias("refers_to"),
    )


def archives_of(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """A list of given archives, for ``read_indexes``."""
    return spark.createDataFrame([(n, -1, folder) for n in names], "archive string, records long, folder string")
