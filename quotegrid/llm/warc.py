"""WARC archives by way of a chunked record table.

A payload travels as rows (record_id, chunk_no, data) of ``CHUNK_BYTES`` at most, cut by Spark
before Python sees it. The writer streams chunk after chunk into the gzip member of its record,
the reader streams it out again the same way; both carry the SHA-1 along, so neither ever holds
a record, and a record whose bytes do not add up to its length and digest is an error.

Of pages with equal payloads (length and SHA-1) of ``min_bytes`` at least, the one with the
largest page_id becomes the response, the others revisit it and carry no payload. The choice is
made on narrow rows; only the payloads to be archived are shuffled, equal rows of one page once.

Null html: an empty payload. Null page_id: a page like any other, smaller than every id; a
revisit of it has null in ``refers_to``. Rows that repeat id and payload: one response, the
others revisit it (of equal ids, the one with the largest url responds). Null url: no target
header. An empty table: no archive, no rows. Further columns are not read.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.llm.common import settle
from quotegrid.session import work_dir

CHUNK_BYTES = 256 << 10
ARCHIVE_BYTES = 64 << 20
LEVEL = 6
#: Copies of one row are dealt out in blocks of so many before they become rows.
COPIES_PER_BLOCK = 1_000

#: Fixed: the profile of a revisit that stands for an equal payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"
MAX_HEAD = 1 << 20

MANIFEST = "path string, n_records long, n_bytes long"
CHUNKS = (
    "archive string, record_id string, chunk_no long, last boolean, record_type string, "
    "page_id long, url string, refers_to_record string, refers_to long, payload_bytes long, "
    "payload_digest string, offset long, n_bytes long, digest_so_far string"
)

#: Names a page by id and payload; none of it null.
KEY = ["id", "no_id", "digest", "bytes"]


def base32(digest: bytes) -> str:
    """A SHA-1 as archives write it."""
    return base64.b32encode(digest).decode()


def _urn(*parts: Column) -> Column:
    """A record identifier that a repeated task gives again."""
    hashed = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    dashed = F.regexp_replace(hashed, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit("urn:uuid:"), dashed)


def _page_rows(pages: DataFrame) -> DataFrame:
    page_id = F.col("page_id").cast("bigint")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.coalesce(page_id, F.lit(0)).alias("id"),
        page_id.isNull().alias("no_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("payload"),
    ).select(
        "id",
        "no_id",
        F.unhex(F.sha1("payload")).alias("digest"),
        F.octet_length("payload").cast("bigint").alias("bytes"),
        "url",
        "payload",
    )


def elect(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Per page, url and payload of ``min_bytes`` at least: copies, and who responds for it.

    ``top_id`` and ``top_no_id`` name the response, ``responds`` says that it is this row's page.
    Only narrow rows, counted before the shuffle, so that copies are no hot group.
    """
    rows = _page_rows(pages).filter(F.col("bytes") >= min_bytes)
    groups = rows.groupBy(*KEY, "url").agg(F.count("*").alias("n"))
    top = groups.groupBy("digest", "bytes").agg(
        F.max(F.struct((~F.col("no_id")).alias("known"), "id", "url")).alias("top")
    )
    judged = groups.join(top, ["digest", "bytes"])
    same = (
        (F.col("id") == F.col("top.id"))
        & (F.col("no_id") != F.col("top.known"))
        & F.col("url").eqNullSafe(F.col("top.url"))
    )
    return judged.select(
        *KEY,
        "url",
        "n",
        F.col("top.id").alias("top_id"),
        (~F.col("top.known")).alias("top_no_id"),
        same.alias("responds"),
    )


def _id(value: str, missing: str) -> Column:
    return F.when(~F.col(missing), F.col(value))


def _record(kind: str, record_id: Column, **more: Column) -> list[Column]:
    columns = {
        "record_id": record_id,
        "record_type": F.lit(kind),
        "page_id": _id("id", "no_id"),
        "url": F.col("url"),
        "bytes": F.col("bytes"),
        "digest": F.col("digest"),
        "refers_to_record": F.lit(None).cast("string"),
        "refers_to": F.lit(None).cast("bigint"),
    }
    columns.update(more)
    return [c.alias(name) for name, c in columns.items()]


def _response_id(page: str, missing: str) -> Column:
    return _urn(F.lit("response"), _id(page, missing), F.hex("digest"), F.col("bytes"))


def _cut(records: DataFrame, chunk_bytes: int) -> DataFrame:
    """One row per chunk, a record's chunks in order and side by side."""
    last = F.floor(F.greatest(F.col("bytes") - 1, F.lit(0)) / chunk_bytes).cast("int")
    chunks = records.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    data = F.substring("payload", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))
    return chunks.withColumn("data", data).drop("payload")


def chunk_table(
    pages: DataFrame, min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Every page as the chunk rows of its record, ready for ``write_archives``."""
    rows = _page_rows(pages)
    judged = settle(elect(pages, min_bytes), "warc-elect")
    payloads = (
        rows.filter(F.col("bytes") >= min_bytes)
        .groupBy(*KEY)
        .agg(F.any_value("payload").alias("payload"))
    )
    responses = payloads.join(judged.filter("responds"), KEY).select(
        *_record("response", _response_id("id", "no_id")), "payload"
    )
    more = F.col("n") - F.col("responds").cast("bigint")
    block, within = COPIES_PER_BLOCK, F.sequence(F.lit(0), F.col("in_block") - 1)
    blocks = judged.withColumn("more", more).filter("more > 0")
    every = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("more") - 1) / block))
    many = blocks.withColumn("block", F.explode(every))
    many = many.withColumn("in_block", F.least(F.col("more") - F.col("block") * block, F.lit(block)))
    copies = many.hint("rebalance").withColumn("copy", F.explode(within))
    revisit_id = _urn(
        F.lit("revisit"), _id("id", "no_id"), F.col("url"), F.hex("digest"), F.col("bytes"),
        F.col("block"), F.col("copy"),
    )
    revisits = copies.select(
        *_record(
            "revisit",
            revisit_id,
            refers_to_record=_response_id("top_id", "top_no_id"),
            refers_to=_id("top_id", "top_no_id"),
        ),
        F.lit(0).alias("chunk_no"),
        F.lit(b"").alias("data"),
    )
    chunks = _cut(responses, chunk_bytes).unionByName(revisits)
    if min_bytes > 0:
        small = rows.filter(F.col("bytes") < min_bytes)
        small = small.withColumn("copy", F.monotonically_increasing_id())
        own = _urn(F.lit("small"), _id("id", "no_id"), F.hex("digest"), F.col("copy"))
        small = small.select(*_record("response", own), "payload")
        chunks = chunks.unionByName(_cut(small, chunk_bytes))
    return chunks


def _lines(*lines: tuple[str, object]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in lines if v is not None)


def _one_line(text: str | None) -> str | None:
    """A header value that cannot end its line: percent-encoded where it must be."""
    if text is None:
        return None
    return "".join(c if c > " " and c != "%" else f"%{ord(c):02X}" for c in text)


def _unescaped(text: str | None) -> str | None:
    if text is None or "%" not in text:
        return text
    first, *parts = text.split("%")
    return first + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts)


def heads(row: dict, date: str) -> bytes:
    """The WARC header and the HTTP header of a record."""
    http = b"HTTP/1.1 200 OK\r\n" + _lines(
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", row["bytes"])
    )
    http += CRLF
    revisit = row["record_type"] == "revisit"
    refers = row["refers_to_record"]
    return b"".join(
        [
            b"WARC/1.1\r\n",
            _lines(
                ("WARC-Type", row["record_type"]),
                ("WARC-Record-ID", f"<{row['record_id']}>"),
                ("WARC-Date", date),
                ("WARC-Target-URI", _one_line(row["url"])),
                ("WARC-Payload-Digest", f"sha1:{base32(row['digest'])}"),
                ("WARC-Profile", SAME_PAYLOAD if revisit else None),
                ("WARC-Refers-To", f"<{refers}>" if refers else None),
                ("Page-ID", row["page_id"]),
                ("Refers-To-Page-ID", row["refers_to"]),
                ("Content-Type", "application/http; msgtype=response"),
                ("Content-Length", len(http) + (0 if revisit else row["bytes"])),
            ),
            CRLF,
            http,
        ]
    )


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The store's own client, so a folder may be on any shared store."""
    return fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")


class Archive:
    """One archive being written, a gzip member per record, chunk by chunk."""

    def __init__(self, path: str, date: str):
        system, inside = store_of(path)
        system.create_dir(inside.rpartition("/")[0], recursive=True)
        self.path, self.date = path, date
        self.out = system.open_output_stream(inside, compression=None)
        self.n_records = self.n_bytes = 0
        self._open(b"")
        info = b"software: quotegrid\r\nformat: WARC File Format 1.1\r\n"
        self._add(
            b"WARC/1.1\r\n"
            + _lines(
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", f"<urn:md5:{hashlib.md5(path.encode()).hexdigest()}>"),
                ("WARC-Date", date),
                ("Content-Type", "application/warc-fields"),
                ("Content-Length", len(info)),
            )
            + CRLF
            + info
        )
        self._close()

    def _open(self, digest: bytes) -> None:
        self.press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self.sha, self.digest = hashlib.sha1(), digest

    def _add(self, data: bytes) -> None:
        packed = self.press.compress(data)
        self.out.write(packed)
        self.n_bytes += len(packed)

    def _close(self) -> None:
        packed = self.press.compress(CRLF + CRLF) + self.press.flush()
        self.out.write(packed)
        self.n_bytes += len(packed)

    def begin(self, row: dict) -> None:
        self._open(row["digest"])
        self._add(heads(row, self.date))
        self.revisit = row["record_type"] == "revisit"
        self.record_id = row["record_id"]

    def add(self, data: bytes) -> None:
        self.sha.update(data)
        self._add(data)

    def end(self) -> None:
        if not self.revisit and self.sha.digest() != self.digest:
            raise ValueError(f"the chunks of {self.record_id} do not add up to its digest")
        self._close()
        self.n_records += 1


def write_archives(
    chunks: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None
) -> DataFrame:
    """Write chunk rows below ``folder``; the manifest's rows, which Spark commits.

    Names carry the task attempt, so what a lost attempt left behind is in no manifest.
    """
    date = date or dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    names = [f.split()[0] for f in MANIFEST.split(", ")]
    narrow = ["record_id", "record_type", "page_id", "url", "bytes", "digest"]
    narrow += ["refers_to_record", "refers_to", "chunk_no"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        archive: Archive | None = None
        number, inside = 0, False

        def closed() -> pa.RecordBatch:
            archive.out.close()
            row = [archive.path, archive.n_records, archive.n_bytes]
            return pa.record_batch([pa.array([v]) for v in row], names)

        for batch in batches:
            data = batch.column("data")
            for k, row in enumerate(batch.select(narrow).to_pylist()):
                if row["chunk_no"] == 0:
                    if inside:
                        archive.end()
                    if archive and archive.n_bytes >= archive_bytes:
                        yield closed()
                        archive = None
                    if archive is None:
                        name = f"{context.partitionId():06d}-{number:05d}-{context.taskAttemptId()}"
                        archive, number = Archive(f"{folder}/{name}.warc.gz", date), number + 1
                    archive.begin(row)
                    inside = True
                elif archive is None or archive.record_id != row["record_id"]:
                    raise ValueError(f"chunk {row['chunk_no']} of {row['record_id']} out of order")
                archive.add(data[k].as_buffer())
        if archive:
            archive.end()
            yield closed()

    return settle(chunks.mapInArrow(run, MANIFEST), "warc-manifest")


class _Stream:
    """Inflated bytes of an archive, gzip members or none, never more than a piece at a time."""

    PIECE = 128 << 10

    def __init__(self, source: pa.NativeFile):
        self.source, self.held, self.at, self.raw = source, b"", 0, source.read(self.PIECE)
        self.press = zlib.decompressobj(31) if self.raw[:2] == b"\x1f\x8b" else None

    def _more(self) -> bytes:
        """The next piece, empty only at the end."""
        while True:
            if not self.raw:
                self.raw = self.source.read(self.PIECE)
            if not self.raw:
                if self.press and not self.press.eof and self.press.unconsumed_tail == b"":
                    tail = self.press.flush()
                    if not self.press.eof:
                        raise ValueError("the archive ends within a record")
                    return tail
                return b""
            if not self.press:
                piece, self.raw = self.raw, b""
                return piece
            if self.press.eof:
                self.press = zlib.decompressobj(31)
            piece = self.press.decompress(self.raw, self.PIECE)
            self.raw = self.press.unused_data if self.press.eof else self.press.unconsumed_tail
            if piece:
                return piece

    def _fill(self) -> bool:
        piece = self._more()
        self.held, self.at = self.held[self.at :] + piece, 0
        return bool(piece)

    def line(self) -> bytes:
        """The next line without its end; empty at the end of the archive too."""
        while (end := self.held.find(CRLF, self.at)) < 0:
            if len(self.held) - self.at > MAX_HEAD:
                raise ValueError("a header line without end")
            if not self._fill():
                if self.at < len(self.held):
                    raise ValueError("the archive ends within a line")
                return b""
        found, self.at = self.held[self.at : end], end + 2
        return found

    def done(self) -> bool:
        return self.at >= len(self.held) and not self._fill()

    def upto(self, n: int) -> bytes:
        """At least one byte, ``n`` at most."""
        if self.at >= len(self.held) and not self._fill():
            raise ValueError("the archive ends within a record")
        found = self.held[self.at : self.at + n]
        self.at += len(found)
        return found

    def exactly(self, n: int) -> bytes:
        parts = []
        while n:
            parts.append(self.upto(n))
            n -= len(parts[-1])
        return b"".join(parts)


def _fields(stream: _Stream) -> tuple[dict[str, str], int]:
    """Header fields up to the blank line, by lower name, and the bytes they took."""
    fields, took = {}, 0
    while line := stream.line():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
        took += len(line) + 2
    return fields, took + 2


def _whole(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def records(source: pa.NativeFile, chunk_bytes: int) -> Iterator[dict]:
    """The chunk rows of an archive's records, each with the running SHA-1 of its payload."""
    stream = _Stream(source)
    while not stream.done():
        if not stream.line().startswith(b"WARC/"):
            raise ValueError("no WARC record where one was due")
        fields, _ = _fields(stream)
        left, http = int(fields["content-length"]), {}
        if left and fields.get("content-type", "").startswith("application/http"):
            status = stream.line()
            http, took = _fields(stream)
            left -= len(status) + 2 + took
        declared = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        revisit = fields.get("warc-type") == "revisit"
        row = {
            "record_id": fields.get("warc-record-id", "").strip("<>"),
            "record_type": fields.get("warc-type"),
            "page_id": _whole(fields.get("page-id")),
            "url": _unescaped(fields.get("warc-target-uri")),
            "refers_to_record": (fields.get("warc-refers-to") or "").strip("<>") or None,
            "refers_to": _whole(fields.get("refers-to-page-id")),
            "payload_bytes": _whole(http.get("content-length")) if revisit else left,
            "payload_digest": declared,
        }
        sha, offset, chunk_no = hashlib.sha1(), 0, 0
        while True:
            data = stream.exactly(min(left, chunk_bytes))
            left -= len(data)
            sha.update(data)
            so_far = base32(sha.copy().digest())
            if not left and not revisit and declared not in (None, so_far):
                raise ValueError(f"the payload of {row['record_id']} has another digest")
            more = {"chunk_no": chunk_no, "last": not left, "offset": offset, "data": data}
            yield {**row, **more, "n_bytes": len(data), "digest_so_far": so_far}
            offset, chunk_no = offset + len(data), chunk_no + 1
            if not left:
                break
        if stream.exactly(4) != CRLF + CRLF:
            raise ValueError(f"{row['record_id']} does not end where it should")


def archives_in(spark: SparkSession, folder: str, pattern: str = "*.warc*") -> DataFrame:
    """(path, n_bytes) of the archives of a folder; none of their content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("length").alias("n_bytes"))


def read_archives(
    archives: DataFrame, with_data: bool = True, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """The chunk table of archives given by ``path``: a row per chunk, ``data`` if wanted.

    ``digest_so_far`` is the SHA-1 of the payload up to the chunk's end, ``last`` marks the
    record's last chunk, and an empty payload has one empty chunk. A revisit's length and digest
    are those of the payload that it stands for.
    """
    schema = CHUNKS + (", data binary" if with_data else "")
    # Built from names: an Arrow schema of Spark's would need a session on the worker.
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array([r[n] for r in held], kind) for n, kind in fields]
            held.clear()
            return pa.record_batch(columns, [n for n, _ in fields])

        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inside = store_of(path)
                with system.open_input_stream(inside, compression=None) as source:
                    for row in records(source, chunk_bytes):
                        held.append({**row, "archive": path})
                        size += (len(row["data"]) if with_data else 0) + 400
                        if size >= 16 * CHUNK_BYTES:
                            yield flush()
                            size = 0
        if held:
            yield flush()

    paths = archives.select("path")
    n = paths.count()
    return paths.repartitionByRange(max(1, n), "path").mapInArrow(run, schema)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in a new shared folder and read the chunk table back."""
    folder = work_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(chunk_table(pages, min_bytes), folder), with_data=False)


def page_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per page, as read back."""
    read = archive_pages(pages, min_bytes).filter(
        F.col("last") & F.col("record_type").isin("response", "revisit")
    )
    revisit = F.col("record_type") == "revisit"
    digest = F.when(revisit, F.col("payload_digest")).otherwise(F.col("digest_so_far"))
    return read.select(
        "page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to"
    )
