"""WARC records in ZIP packages, read by byte ranges.

A package is a ZIP file of stored members: ``archive/*.warc.gz`` (one gzip member per record) and one
``indexes/*.cdx`` each, with the place of every record. The reader parses the end record, the central
directory and their ZIP64 forms, finds the data of the stored members, reads the indexes, and then fetches
single records by their byte range; nothing is extracted.

Packages lie in a folder that all executors reach; ``pyarrow.fs`` opens it by its URI. Each attempt of a task
writes a file of its own name, and only the manifest rows of successful attempts are used, so tasks can run
again on another executor.

Defined cases: a null payload is empty; a null url leaves its header out; a record without an id is a
``response`` and nobody's original if others of its payload have an id; rows that share the largest id of
their payload are all ``response``; an empty table writes no package.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virotide.llm.common import keep, new_folder

MEMBER_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64_LOCATOR, END64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"


def _open(path: str):
    """Filesystem and path of a URI; plain paths and ``file:/`` are local."""
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


# --- records ------------------------------------------------------------------------------------------


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, original: int | None) -> bytes:
    """One WARC record; with an ``original``, a revisit that repeats the headers but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if original is not None:
        head += [f"WARC-Refers-To: {_record_id(original)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, rest


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def parse(data: bytes) -> tuple:
    """``(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)`` of one record.

    A revisit's payload is null; its length and digest are those of the full payload, from its headers.
    """
    head, rest = _headers(data)
    block = rest[: int(head["content-length"])]
    http, payload = _headers(block)
    kind, noted = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (digest(payload) != noted or len(payload) != int(http["content-length"])):
        raise ValueError(f"damaged record {head['warc-record-id']}")
    page, url = _page(head["warc-record-id"]), head.get("warc-target-uri")
    return page, url, payload if kind == "response" else None, int(http["content-length"]), noted, kind, _page(head.get("warc-refers-to"))


# --- ZIP directories ----------------------------------------------------------------------------------


def members(read, size: int) -> list[tuple[str, int, int]]:
    """``(name, data offset, length)`` of the stored members; ``read(offset, length)`` gives bytes.

    Reads the tail of the file, the central directory, and each member's local header.
    """
    tail_at = max(0, size - (1 << 16) - 22 - 20)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no end record: not a ZIP file")
    count, length, start = struct.unpack_from("<10xHII", tail, at)
    if at >= 20 and tail[at - 20 : at - 16] == END64_LOCATOR:
        (end64,) = struct.unpack_from("<8xQ", tail, at - 20)
        found = read(end64, 56)
        if found[:4] != END64:
            raise ValueError("the ZIP64 locator points nowhere")
        count, length, start = struct.unpack_from("<32xQQQ", found)
    directory, out, at = read(start, length), [], 0
    for _ in range(count):
        if directory[at : at + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        method, packed, plain, n_name, n_extra, n_comment, local = struct.unpack_from("<10xH8xIIHHH8xI", directory, at)
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        packed, local = _wide(extra, plain, packed, local)
        at += 46 + n_name + n_extra + n_comment
        if method:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        here = read(local, 30)
        if here[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        own_name, own_extra = struct.unpack_from("<26xHH", here)
        out.append((name, local + 30 + own_name + own_extra, packed))
    return out


def _wide(extra: bytes, plain: int, packed: int, local: int) -> tuple[int, int]:
    """Length and offset, from the ZIP64 field where the short ones are full."""
    at = 0
    while at + 4 <= len(extra):
        tag, n = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            if plain == 0xFFFFFFFF:
                next(wide)
            packed = next(wide) if packed == 0xFFFFFFFF else packed
            local = next(wide) if local == 0xFFFFFFFF else local
        at += 4 + n
    return packed, local


# --- Spark --------------------------------------------------------------------------------------------


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` as ``(page_id, url, html, refers_to)``: the largest id of equal payloads is the original.

    Payloads are equal if length, SHA-1 and SHA-256 are. Payloads of under ``least_bytes`` are never revisits.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    digests = [F.sha1(F.encode("html", "UTF-8")).alias("sha1"), F.sha2(F.encode("html", "UTF-8"), 256).alias("sha2")]
    groups = rows.where(F.octet_length("html") >= least_bytes).select("page_id", *digests).groupBy("sha1", "sha2")
    originals = keep(groups.agg(F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1").drop("n"), "originals")
    # Plain shuffles on both sides: a payload that a third of all pages share is split by the adaptive join.
    joined = rows.select("*", *digests).join(originals, ["sha1", "sha2"], "left")
    revisit = (F.octet_length("html") >= least_bytes) & F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("original")).alias("refers_to"))


class _Sink(io.RawIOBase):
    """What ``zipfile`` needs of an output that cannot seek."""

    def __init__(self, out):
        self.out, self.at = out, 0

    def writable(self):
        return True

    def write(self, data):
        self.out.write(bytes(data))
        self.at += len(data)
        return len(data)

    def tell(self):
        return self.at

    def seekable(self):
        return False


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``(page_id, url, html, refers_to)``, one package per task; the manifest ``(path, n_records)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open(folder)
        path, package, out = None, None, None
        total = numbered = 0
        member, index = None, []

        def finish() -> None:
            nonlocal member, index, numbered
            member.close()
            package.writestr(f"indexes/data-{numbered:05}.cdx", "".join(index))
            member, index, numbered = None, [], numbered + 1

        for batch in batches:
            for page_id, url, html, refers_to in zip(batch["page_id"], batch["url"], batch["html"], batch["refers_to"], strict=True):
                if package is None:
                    system.create_dir(root, recursive=True)
                    path = f"{folder}/part-{TaskContext.get().partitionId():05}-{uuid.uuid4().hex}.zip"
                    out = system.open_output_stream(f"{root}/{path.rpartition('/')[2]}")
                    package = zipfile.ZipFile(_Sink(out), "w", zipfile.ZIP_STORED)
                if member is None:
                    member, written = package.open(f"archive/data-{numbered:05}.warc.gz", "w", force_zip64=True), 0
                number, original = (None if pd.isna(x) else int(x) for x in (page_id, refers_to))
                packed = gzip.compress(record(number, url, html.encode("utf-8", "surrogatepass"), original), compresslevel=3, mtime=0)
                member.write(packed)
                index.append(f"{'' if number is None else number} {written} {len(packed)}\n")
                written, total = written + len(packed), total + 1
                if written >= MEMBER_BYTES:
                    finish()
        if package is not None:
            if member is not None:
                finish()
            package.close()
            out.close()
            yield pd.DataFrame({"path": [path], "n_records": [total]})

    return pages.select("page_id", "url", "html", "refers_to").mapInPandas(run, "path string, n_records long")


def locate(manifest: DataFrame) -> DataFrame:
    """``(path, offset, length)`` of every record, from the packages' directories and indexes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                system, own = _open(path)
                with system.open_input_file(own) as file:
                    found = {name: (at, n) for name, at, n in members(lambda at, n: file.read_at(n, at), file.size())}  # noqa: B023
                    for name, (at, n) in found.items():
                        if name.startswith("indexes/"):
                            start = found[name.replace("indexes/", "archive/").replace(".cdx", ".warc.gz")][0]
                            lines = [line.split(" ") for line in file.read_at(n, at).decode().splitlines()]
                            yield pd.DataFrame({"path": path, "offset": [start + int(x[1]) for x in lines], "length": [int(x[2]) for x in lines]})

    return manifest.select("path").repartition("path").mapInPandas(run, "path string, offset long, length long")


def read_records(places: DataFrame) -> DataFrame:
    """The records at ``(path, offset, length)``, each fetched by its byte range."""
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, own in batch.groupby("path"):
                system, local = _open(path)
                with system.open_input_file(local) as file:
                    ranges = list(zip(own["offset"], own["length"], strict=True))
                    for at in range(0, len(ranges), 256):
                        rows = [parse(gzip.decompress(file.read_at(int(n), int(offset)))) for offset, n in ranges[at : at + 256]]
                        yield pd.DataFrame(rows, columns=names, dtype=object)

    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    # Places are a few bytes a record; a large package is read by many tasks.
    return places.repartition("path", F.floor(F.col("offset") / (16 << 20))).mapInPandas(run, schema)


def round_trip(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``pages`` into packages under ``folder`` (a new one in the shared folder), and read them back."""
    folder = folder or new_folder(pages.sparkSession, "packages")
    manifest = keep(write_packages(mark_revisits(pages, least_bytes), folder), "manifest")
    return read_records(locate(manifest))
