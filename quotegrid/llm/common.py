"""What the corpus operators share: rows, words, splits and written intermediates.

Rules that hold for every operator here:

* only ``doc_id`` and ``text`` (and what an operator names) are read, so further columns of any
  name do no harm; a null text counts as an empty one; a null ``doc_id`` is an id like any other;
* repeated rows are rows of their own, and equal rows get equal results;
* words are maximal runs of characters other than the six ASCII white-space characters.
"""

from __future__ import annotations

import ctypes
import re
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.sources.tables import settle

__all__ = [
    "PLACE",
    "ROW_KEY",
    "bounded_batches",
    "few_files",
    "hand_back",
    "hold_out",
    "is_held_out",
    "packed_texts",
    "place",
    "row_key",
    "settle",
    "stable",
    "table",
    "text_of",
    "unpack",
    "worker_held",
    "words_of",
]

#: Fixed: the white space of the word rule `[^\x20\x09-\x0D]+`.
BLANKS = "\t\n\x0b\x0c\r"
#: Rows whose crc32(doc_id as text) mod 4 equals this are never learned from.
HELD_OUT = 2


BATCH_BYTES_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """From now on rows leave this session's JVMs for Python in batches of ``BATCH_BYTES``.

    Ten thousand whole texts, Spark's own limit, are too much for a worker that also holds what
    it makes of them. A lower limit of the session stays.
    """
    number, unit = re.match(r"(\d+)([kmg]?)", spark.conf.get(BATCH_BYTES_CONF).lower()).groups()
    if int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] > BATCH_BYTES:
        spark.conf.set(BATCH_BYTES_CONF, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array, in order."""
    spaced = F.translate(text, BLANKS, " " * len(BLANKS))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def hold_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def is_held_out(doc_id: object) -> bool:
    """``hold_out`` for one id, as the tests see it."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == HELD_OUT


#: Names a row by id and content, so rows that share one id stay apart. Rows equal in both share
#: a key, and deserve the same decision.
ROW_KEY = ["id", "no_id", "text_hash"]


def row_key() -> list[Column]:
    """The columns of ROW_KEY, none of them null."""
    doc_id = F.col("doc_id").cast("bigint")
    return [
        F.coalesce(doc_id, F.lit(-1)).alias("id"),
        doc_id.isNull().alias("no_id"),
        F.xxhash64(text_of()).alias("text_hash"),
    ]


#: Names one row of a table, also among equal ones: its file and its number there.
PLACE = ["part", "at"]


def stable(docs: DataFrame) -> DataFrame:
    """``docs`` as rows of files, written first unless they are: their places never change.

    So narrow results find their rows again by a key that no two rows share, however often a row
    repeats, and no task has to gather equal rows to tell them apart.
    """
    try:
        docs.select("_metadata.row_index", "_metadata.file_path")
    except AnalysisException:
        return settle(docs, "rows")
    return docs


def place() -> list[Column]:
    """The columns of PLACE, of ``stable`` rows. Files are told apart by hashes of their names."""
    return [
        F.xxhash64("_metadata.file_path").alias("part"),
        F.col("_metadata.row_index").alias("at"),
    ]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3, write_content_size=True)
    for batch in batches:
        packed = [press.compress(t) for t in batch.column("text").to_pylist()]
        columns = [batch.column(c) for c in PLACE]
        yield pa.record_batch([*columns, pa.array(packed, pa.binary())], [*PLACE, "packed"])


def packed_texts(docs: DataFrame) -> DataFrame:
    """PLACE and the compressed text of ``stable`` rows: half the bytes for a shuffle of texts."""
    text = docs.select(*place(), text_of().cast("binary").alias("text"))
    return text.mapInArrow(_pack, "part long, at long, packed binary")


#: Rows of a narrow table that one file should hold.
FILE_ROWS = 100_000


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """A narrow result of about ``rows`` rows in as many parts as that is worth, one per core at
    least; never more than it has."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-rows // FILE_ROWS)))


# Memory that Arrow frees goes back to the C library, and from there to the machine.
pa.set_memory_pool(pa.system_memory_pool())

_HELD: dict[object, object] = {}


def worker_held(key: object, build: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task: one operator's tables, never several.

    A worker serves one operator after another, so the tables of the last one must go.
    """
    if key not in _HELD:
        _HELD.clear()
        hand_back()
        _HELD[key] = build()
    return _HELD[key]


def hand_back() -> None:
    """Give freed memory back to the machine, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def unpack(packed: pa.Array) -> Iterator[bytes]:
    press = zstandard.ZstdDecompressor()
    for one in packed:
        yield press.decompress(one.as_py())
