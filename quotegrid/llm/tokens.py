"""Token ids in a binary file format: shared zstandard dictionary, one frame per document.

A shard holds, little-endian throughout:

    "QGTK" | version u16 | sha256 of the dictionary, 32 bytes (zeros: none)
    one zstandard frame per document: its ids as u32
    index: frame offsets u64 x (n+1), ids per document u32 x n, doc_id i64 x n, id known u8 x n
    n u64 | index offset u64 | "QGTK"

The dictionary lies beside the shards, after the same four letters. It is trained on the
serialized ids of ``SAMPLE_DOCS`` documents at most, those with the smallest id hashes, each of
``SAMPLE_BYTES`` at most. A shard is closed at ``SHARD_BYTES``, so writers and readers hold little, and its offset index gives any
document without touching the others. Shards follow ascending doc_id (null first, then the text
hash); the manifest, which Spark writes, names the shards of the successful task attempts, and
readers ignore all other files.

Null text: empty, only the end id. Repeated rows: documents of their own. An empty table: no
shard, no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotegrid.llm.common import settle, text_of, worker_held
from quotegrid.session import work_dir

MAGIC, VERSION = b"QGTK", 1
HEAD = len(MAGIC) + 2 + 32
END_ID = 2
SHARD_BYTES = 16 << 20
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1_000, 64 << 10, 64 << 10
LEVEL = 3
MAX_CACHED_WORDS = 900_000

MANIFEST = (
    "name string, task int, shard int, n_docs long, n_tokens long, first_id long, last_id long"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Marks, but for the apostrophe, between a plain letter or digit and a blank are a run of their own.
_MARK = rb"[!-&(-/:-@\[-`{-~]"
_STOP = re.compile(rb"%b(?<=[a-z0-9]%b)%b*(?=[ \n]|\Z)" % (_MARK, _MARK, _MARK))
#: The byte-level alphabet shows each byte as a printable character: itself, where it is one.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = {b: 256 + n for n, b in enumerate(sorted(set(range(256)) - _PRINTED))}
#: Latin letters whose lower form is one letter, then marks; the start of a special token is none.
_PLAIN = re.compile("([a-zA-Z\u00c0-\u012f\u0131-\u024f]+)((?!.*<[|])[!-&(-/:-@\\[-`{-~]*)")


def _shown(text: str) -> str:
    """The byte-level form of a text."""
    return text if text.isascii() else text.encode().decode("latin-1").translate(_HIDDEN)


def token_words(text: bytes) -> list[bytes]:
    """A text's words, such that its ids are those of its words in a row.

    White space never gets into an id of this vocabulary's pre-tokenizer, and nothing joins
    across it. Plain letters are lower-cased and marks set apart beforehand, so more words are
    known ones; not in texts with combining marks, which a lower letter may take up and its
    capital not, or with what may be a special token, which is told by case.
    """
    if not (b"\xcc" in text or b"\xcd" in text or b"<|" in text):
        text = _STOP.sub(rb" \g<0>", text.lower())
    return text.split()  # bytes: at the six ASCII blanks


class WordEncoder:
    """Whole texts to ids, by way of a bounded memory of words, emptied when full."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}

    def _learn(self, new: list[bytes]) -> None:
        if len(self.known) > MAX_CACHED_WORDS:
            self.known.clear()
        other = []
        for word in new:
            text = word.decode()
            plain = _PLAIN.fullmatch(text)
            letters = plain[1].lower() if plain else ""
            if letters.isalpha():
                # A run of letters and one of marks that no normaliser alters or joins:
                # straight to the model.
                ids = [t.id for t in self.model.tokenize(_shown(letters))]
                if plain[2]:
                    ids += [t.id for t in self.model.tokenize(plain[2])]
                self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                other.append(word)
        texts = [w.decode() for w in other]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for word, e in zip(other, found, strict=True):
            ids = e.ids
            self.known[word] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: bytes, end: int | None = END_ID) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        words = token_words(text)
        ids = list(map(self.known.get, words))
        if None in ids:
            self._learn(list({w for w, i in zip(words, ids, strict=True) if i is None}))
            known = self.known
            ids = [known[w] if i is None else i for w, i in zip(words, ids, strict=True)]
        if end is not None:
            ids.append(struct.pack("<I", end))
        return b"".join(ids)


def encoder(vocabulary: str | None) -> WordEncoder:
    """The worker's encoder, kept between its tasks."""
    path = vocabulary or default_vocabulary()
    return worker_held(("tokens", path), lambda: WordEncoder(path))


def ids_of(docs: DataFrame, vocabulary: str | None) -> DataFrame:
    """``ids`` of every text, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(vocabulary)
        for batch in batches:
            ids = [codec.encode(t.as_py()) for t in batch.column("text")]
            yield pa.record_batch([pa.array(ids, pa.binary())], ["ids"])

    return docs.select(text_of().cast("binary").alias("text")).mapInArrow(run, "ids binary")


def train_dictionary(docs: DataFrame, vocabulary: str | None = None) -> bytes:
    """A dictionary from a bounded sample of documents; empty where that is too small."""
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    chosen = F.broadcast(chosen.distinct().withColumnRenamed("doc_id", "id"))  # SAMPLE_DOCS rows
    same = F.col("doc_id").eqNullSafe(F.col("id"))
    sample = docs.select("doc_id", "text").join(chosen, same, "left_semi")
    short = ids_of(sample, vocabulary).filter(F.length("ids") <= SAMPLE_BYTES)
    samples = [bytes(r["ids"]) for r in short.limit(SAMPLE_DOCS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples)).as_bytes()
    except zstandard.ZstdError:
        return b""


def _digest(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest() if dictionary else bytes(32)


def pack(frames: list[bytes], counts: list[int], ids: list[int | None], digest: bytes) -> bytes:
    """One shard as bytes."""
    offsets = np.cumsum([HEAD, *map(len, frames)]).astype("<u8")
    known = np.array([i is not None for i in ids], "u1")
    return b"".join(
        [
            MAGIC + VERSION.to_bytes(2, "little") + digest,
            *frames,
            offsets.tobytes(),
            np.array(counts, "<u4").tobytes(),
            np.array([i or 0 for i in ids], "<i8").tobytes(),
            known.tobytes(),
            len(frames).to_bytes(8, "little") + int(offsets[-1]).to_bytes(8, "little") + MAGIC,
        ]
    )


def read_index(shard: bytes, digest: bytes) -> tuple[np.ndarray, np.ndarray, list[int | None]]:
    """Frame offsets, ids per document and doc_ids of a shard, after checking its frame."""
    if shard[:4] != MAGIC or shard[-4:] != MAGIC or shard[6:HEAD] != digest:
        raise ValueError("not a shard of this dictionary")
    n = int.from_bytes(shard[-20:-12], "little")
    at = int.from_bytes(shard[-12:-4], "little")
    offsets = np.frombuffer(shard, "<u8", n + 1, at)
    counts = np.frombuffer(shard, "<u4", n, at + 8 * (n + 1))
    ids = np.frombuffer(shard, "<i8", n, at + 8 * (n + 1) + 4 * n).tolist()
    known = np.frombuffer(shard, "u1", n, at + 8 * (n + 1) + 12 * n)
    return offsets, counts, [i if k else None for i, k in zip(ids, known, strict=True)]


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    )


def read_document(shard: bytes, k: int, dictionary: bytes) -> np.ndarray:
    """The ids of one document, by the offset index alone."""
    offsets, counts, _ = read_index(shard, _digest(dictionary))
    frame = shard[int(offsets[k]) : int(offsets[k + 1])]
    ids = _decompressor(dictionary).decompress(frame, max_output_size=4 * int(counts[k]))
    return np.frombuffer(ids, "<u4")


def _store(folder: str, name: str, data: bytes) -> None:
    """Write through the store's own client, so the folder may be on any shared store."""
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}") as out:
        out.write(data)


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None) -> DataFrame:
    """Write the documents' ids in ascending order below ``folder``; the manifest's rows."""
    dictionary = train_dictionary(docs, vocabulary)
    digest = _digest(dictionary)
    _store(folder, "dictionary.zdict", MAGIC + dictionary)  # readers skip empty files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(vocabulary)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        context = TaskContext.get()
        frames: list[bytes] = []
        counts: list[int] = []
        ids: list[int | None] = []
        held = shard = 0

        def close() -> pa.RecordBatch:
            name = f"{context.partitionId():06d}-{shard:05d}-{context.taskAttemptId()}.bin"
            _store(folder, name, pack(frames, counts, ids, digest))
            row = [name, context.partitionId(), shard, len(ids), sum(counts), ids[0], ids[-1]]
            types = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 4]
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            return pa.record_batch(
                [pa.array([v], t) for v, t in zip(row, types, strict=True)], names
            )

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(doc_ids, batch.column("text"), strict=True):
                data = codec.encode(text.as_py())
                frames.append(press.compress(data))
                counts.append(len(data) // 4)
                ids.append(doc_id)
                held += len(frames[-1])
                if held >= SHARD_BYTES:
                    yield close()
                    frames, counts, ids, held, shard = [], [], [], 0, shard + 1
        if ids:
            yield close()

    ordered = (
        docs.select(
            F.col("doc_id").cast("bigint"),
            text_of().cast("binary").alias("text"),
            F.xxhash64(text_of()).alias("h"),
        )
        .repartitionByRange("doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
    )
    return settle(ordered.select("doc_id", "text").mapInArrow(run, MANIFEST), "token-manifest")


def read_tokens(
    spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = True
) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]): every document, read from its shard.

    ``start`` counts the ids of all documents before it. Without ``ids`` only the numbers meet
    the manifest's shuffle.
    """
    stored = spark.read.format("binaryFile").load(f"{folder}/dictionary.zdict").first()
    dictionary = bytes(stored["content"])[len(MAGIC) :]
    digest = _digest(dictionary)
    fields = "name string, doc_id long, inside long, n_tokens long, ids_crc32 long"
    fields += ", ids binary" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = _decompressor(dictionary)
        for batch in batches:
            for name, content in zip(
                batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True
            ):
                offsets, counts, doc_ids = read_index(content, digest)
                view = memoryview(content)
                starts = np.cumsum([0, *counts.tolist()])[:-1]
                for low in range(0, len(doc_ids), 1_000):
                    some = range(low, min(low + 1_000, len(doc_ids)))
                    ids = [
                        press.decompress(
                            view[int(offsets[k]) : int(offsets[k + 1])],
                            max_output_size=4 * int(counts[k]),
                        )
                        for k in some
                    ]
                    cut = slice(some.start, some.stop)
                    columns = [
                        pa.array([name] * len(some)),
                        pa.array(doc_ids[cut], pa.int64()),
                        pa.array(starts[cut], pa.int64()),
                        pa.array(counts[cut].astype("i8")),
                        pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                        *([pa.array(ids, pa.binary())] if with_ids else []),
                    ]
                    yield pa.record_batch(columns, [f.split()[0] for f in fields.split(", ")])

    in_order = Window.orderBy("task", "shard")  # one row per shard
    places = manifest.select(
        F.col("name"), (F.sum("n_tokens").over(in_order) - F.col("n_tokens")).alias("shard_start")
    )
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.bin")
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    )
    return (
        files.mapInArrow(run, fields)
        .join(places, "name")
        .withColumn("start", F.col("shard_start") + F.col("inside"))
        .select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
    )


def token_files(
    docs: DataFrame, vocabulary: str | None = None, with_ids: bool = True
) -> DataFrame:
    """Write the documents to a new shared folder and read them back."""
    spark = docs.sparkSession
    folder = work_dir(spark, "tokens")
    return read_tokens(spark, folder, write_tokens(docs, folder, vocabulary), with_ids)
