"""WARC archives with a two-level capture index.

Archives: gzip members, one per record; equal payloads of at least ``REVISIT_BYTES`` are
kept once, in the record with the smallest page_id, and the others become revisits.

Index: captures sorted by reversed-host URL key (``com,example,blog)/path``) and page_id
go to index files of compressed blocks of ``BLOCK_LINES`` captures.  Beside each index file
lies its sparse directory, one line a block; the first key of every index file forms the
level above.  A lookup bisects the files' first keys, then the directory, reads one block
by its byte range, and then the record by its own.

Files carry the name of the attempt that wrote them, and only rows that Spark committed
point to them, so a repeated task leaves nothing to be read twice.

Defined cases: NULL html counts as empty; NULL url has the key ``)`` and an empty target;
a row without a page_id is never the first of its payload's; rows that repeat a page_id
and its payload are all response or all revisit; an empty table gives no files and no
rows; columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamkit.llm.shared import open_store, python_tasks, run_dir, stage

REVISIT_BYTES, BLOCK_LINES, FILE_BYTES, READ_GAP = 100, 1000, 1 << 30, 1 << 16
NO_PAGE = -(2**63)
CAPTURE = "key string, page_id long, file string, offset long, length long"


def url_key(url: Column) -> Column:
    """Host labels reversed, then the path: urls of a domain and its hosts sort together."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(rest, "^[^/?#]*", ""))


def gzipped(data: bytes, level: int = 6) -> bytes:
    made = zlib.compressobj(level, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One gzipped record; ``payload`` is empty for a revisit, ``size`` and ``digest`` are of the full payload."""
    uri = quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": f"<urn:x-page:{'' if page_id is None else page_id}>", "WARC-Date": "1970-01-01T00:00:00Z",
            "WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(http) + len(payload))}
    if revisit:
        head |= {"WARC-Refers-To": f"<urn:x-page:{refers_to}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return gzipped(lines.encode() + http + payload + b"\r\n\r\n")


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one gzipped record."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = lambda text: dict(x.split(": ", 1) for x in text.decode().split("\r\n")[1:])
    warc = fields(head)
    http, _, payload = rest[: int(warc["Content-Length"])].partition(b"\r\n\r\n")
    return warc, fields(http), payload


def decided(pages: DataFrame) -> DataFrame:
    """Pages with digest, size, refers_to (NULL: response) and the html that the record needs.

    Only (digest, first page) pairs of payloads that occur more than once are joined back.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha2(F.encode(html, "UTF-8"), 256).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    first = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    rows = rows.join(stage(first, "first-pages"), "digest", "left").withColumn("refers_to", F.when(F.col("page_id") > F.col("first"), F.col("first")))
    return rows.select("page_id", "url", url_key(F.col("url")).alias("key"), F.when(F.col("refers_to").isNull(), F.col("html")).otherwise("").alias("html"), "digest", "size", "refers_to")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives; a row (key, page_id, file, offset, length) for each record."""
    python_tasks(pages.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        attempt, seq, out, path, at = uuid.uuid4().hex, 0, None, "", 0
        for pdf in batches:
            rows = []
            for p in pdf.itertuples(index=False):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    path, at = f"{root}/{attempt}-{seq:05d}.warc.gz", 0
                    out, seq = store.open_output_stream(path, compression=None), seq + 1
                page = None if pd.isna(p.page_id) else int(p.page_id)
                data = record(page, p.url, p.html.encode(), p.size, p.digest, None if pd.isna(p.refers_to) else int(p.refers_to))
                out.write(data)
                rows.append((p.key, page, path, at, len(data)))
                at += len(data)
            captures = pd.DataFrame(rows, columns=["key", "page_id", "file", "offset", "length"])
            captures["page_id"] = captures["page_id"].astype("Int64")
            yield captures
        if out is not None:
            out.close()

    # 64-bit ids with NULLs would pass pandas as floats: send them as text
    rows = decided(pages).withColumns({"page_id": F.col("page_id").cast("string"), "refers_to": F.col("refers_to").cast("string")})
    return rows.mapInPandas(write, CAPTURE)


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write index files and directories; a row (first_key, first_page, path) for each index file."""
    python_tasks(captures.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        path, out, directory, lines, at = f"{root}/{uuid.uuid4().hex}.cdx.gz", None, [], [], 0

        def flush() -> int:
            data = gzipped("\n".join(json.dumps(x, ensure_ascii=False) for x in lines).encode())
            out.write(data)
            directory.append([lines[0][0], lines[0][1], at, len(data)])
            return len(data)

        for pdf in batches:
            for key, page, file, offset, length in zip(pdf["key"], pdf["page"], pdf["file"], pdf["offset"], pdf["length"], strict=True):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(path, compression=None)
                lines.append([key, int(page), file, int(offset), int(length)])
                if len(lines) >= BLOCK_LINES:
                    at, lines = at + flush(), []
        if out is None:
            return
        if lines:
            flush()
        out.close()
        with store.open_output_stream(path + ".directory") as f:
            f.write("\n".join(json.dumps(x, ensure_ascii=False) for x in directory).encode())
        yield pd.DataFrame({"first_key": [directory[0][0]], "first_page": [directory[0][1]], "path": [path]})

    rows = captures.withColumn("page", F.coalesce("page_id", F.lit(NO_PAGE))).select("key", "page", "file", "offset", "length")
    return rows.repartitionByRange("key", "page").sortWithinPartitions("key", "page", "file", "offset").mapInPandas(write, "first_key string, first_page long, path string")


class CaptureIndex:
    """Lookups in the index files; ``files``: (first_key, first_page, path), ascending."""

    def __init__(self, store, files: list[tuple[str, int, str]]):
        self.store, self.files, self.first = store, files, [f[:2] for f in files]
        self.directories: dict[int, list] = {}
        self.block: tuple = (None, [], [])

    def directory(self, k: int) -> tuple[list, list]:
        if k not in self.directories:
            with self.store.open_input_stream(self.files[k][2] + ".directory") as f:
                rows = [json.loads(x) for x in f.read().decode().split("\n")]
            self.directories = {k: ([(r[0], r[1]) for r in rows], rows)}  # lookups come sorted: one is enough
        return self.directories[k]

    def lines(self, k: int, b: int) -> tuple[list, list]:
        if self.block[0] != (k, b):
            _, _, offset, length = self.directory(k)[1][b]
            with self.store.open_input_file(self.files[k][2]) as f:
                f.seek(offset)
                rows = [json.loads(x) for x in zlib.decompress(f.read(length), 31).decode().split("\n")]
            self.block = ((k, b), [(r[0], r[1]) for r in rows], rows)
        return self.block[1:]

    def find(self, key: str, page: int) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of every capture of the key by the page."""
        want = (key, page)
        k = max(0, bisect_left(self.first, want) - 1)
        while k < len(self.files) and self.first[k] <= want:
            starts = self.directory(k)[0]
            b = max(0, bisect_left(starts, want) - 1)
            while b < len(starts) and starts[b] <= want:
                keys, rows = self.lines(k, b)
                for row in rows[bisect_left(keys, want) : bisect_right(keys, want)]:
                    yield row[2], row[3], row[4]
                b += 1
            k += 1


def lookup(queries: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """(page_id, file, offset, length) of every capture of the queried (key, page_id) pairs.

    Sent to all tasks: one first key a file.  Index files grow with the data's partitions,
    not with its rows, and hold millions of captures each; 100,000 files are some 10 MB.
    """
    python_tasks(queries.sparkSession, 5_000)
    files = [tuple(r) for r in index.orderBy("first_key", "first_page").collect()]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        captures = CaptureIndex(open_store(folder)[0], files)
        for pdf in batches:
            rows = [(page, *at) for key, page in zip(pdf["key"], pdf["page"], strict=True) for at in captures.find(key, int(page))]
            yield pd.DataFrame(rows, columns=["page", "file", "offset", "length"])

    keys = queries.select("key", F.coalesce("page_id", F.lit(NO_PAGE)).alias("page")).distinct()
    return keys.repartitionByRange("key", "page").sortWithinPartitions("key", "page").mapInPandas(find, "page long, file string, offset long, length long")


def read_records(located: DataFrame, folder: str) -> DataFrame:
    """Read the records' byte ranges: page_id, url, record_type, payload, payload_bytes, digest (of the full payload), refers_to."""
    python_tasks(located.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = open_store(folder)
        name, f = None, None
        for pdf in batches:
            rows = []
            for file, offset, length in zip(pdf["file"], pdf["offset"], pdf["length"], strict=True):
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, store.open_input_file(file)
                f.seek(offset)
                warc, http, payload = parse_record(f.read(length))
                page = lambda field: warc[field].removeprefix("<urn:x-page:").removesuffix(">") or None if field in warc else None
                digest = warc["WARC-Payload-Digest"].removeprefix("sha256:")
                if warc["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"{file} at {offset}: payload doesn't match its digest")
                rows.append((page("WARC-Record-ID"), warc["WARC-Target-URI"], warc["WARC-Type"], payload, int(http["Content-Length"]), digest, page("WARC-Refers-To")))
            yield pd.DataFrame(rows, columns=["page", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers"])
        if f is not None:
            f.close()

    rows = located.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInPandas(read, "page string, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers string")
    return rows.select(F.col("page").cast("long").alias("page_id"), "url", "record_type", "payload", "payload_bytes", "payload_digest", F.col("refers").cast("long").alias("refers_to"))


def op2(pages: DataFrame) -> DataFrame:
    """The registered query: write, index, look every page up, read its record back."""
    folder = run_dir(pages.sparkSession, "warc")
    captures = stage(write_archives(pages, folder), "captures")
    index = stage(write_index(captures, folder), "capture-index")
    queries = pages.select(F.col("page_id").cast("long").alias("page_id"), url_key(F.col("url")).alias("key"))
    located = stage(lookup(queries, index, folder), "located")
    return read_records(located, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
