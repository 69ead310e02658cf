"""Substring dedup by relative Lempel-Ziv parsing against the whole corpus.

The reference is every document. Its index consists of blocks: a block holds the windows of
``WINDOW`` words that share an anchor, the least hash among the window's runs of
``ANCHOR_WORDS`` words. Equal windows have equal anchors, so a block is all that a window can
match, and a block with a single anchor occurrence matches nothing and is left out before any
window is shipped.

In the index a window has one place, its first occurrence; for that occurrence itself it is the
last one. So the match of a document at a word has one place in the reference, and goes on as
long as the places of the next windows follow. The parse is greedy: at each word the longest
match begins a factor (document, start, reference document, reference start, length), which goes
to its last matching window; words that no window matches are literals. A factor has at least
``WINDOW`` words. Where one ends, the windows across its end are looked up as well and begin the
next, so two factors may overlap, and every word of a window that occurs twice is in some
factor. Those words are removed.

Occurrences that meet in a task, among ``CHUNK_WINDOWS`` windows, take their places there and
leave as runs. Windows are aggregated before the shuffle and joined back, so a passage in a third
of all documents is no hot key. They are compared by 64-bit hashes of their words, within blocks
found by another 64-bit hash. Documents with the same word sequence are one class, parsed once;
a class of several documents is removed as a whole.

Null or empty text: no words, nothing removed. Shorter texts than a window keep all words.
Repeated rows are copies, and lose all words where they have a window's length. Empty tables
give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotegrid.llm.common import PLACE, packed_texts, place, settle, stable, text_of, unpack
from quotegrid.llm.hashing import mix, window_hashes, word_hashes

WINDOW = 35
ANCHOR_WORDS = 12
#: Windows that a task combines at a time.
CHUNK_WINDOWS = 1_000_000


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, in about log2(width) passes."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    reach, low = 1, values
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    return np.minimum(low[:n], low[width - reach : width - reach + n])


def window_anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of every window, and the hashes of all runs of ANCHOR_WORDS words."""
    runs = window_hashes(hashes, ANCHOR_WORDS)
    return sliding_min(runs, WINDOW - ANCHOR_WORDS + 1), runs


def anchors_of(hashes: np.ndarray) -> np.ndarray:
    """A document's anchors; those whose words occur again in it are listed twice."""
    anchors, runs = window_anchors(hashes)
    if not len(anchors):
        return anchors
    distinct = np.unique(anchors)
    runs.sort()
    again = np.unique(runs[1:][runs[1:] == runs[:-1]])
    return np.concatenate([distinct, np.intersect1d(distinct, again, assume_unique=True)])


def _matches(runs: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The start, reference document and reference start of every matching window, by start.

    Of two places of one window the one whose run goes on longer comes first.
    """
    start, n, ref, at = (
        runs.field(f).to_numpy().astype(np.int64) for f in ("start", "n", "ref", "at")
    )
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    starts, refs = np.repeat(start, n) + inside, np.repeat(ref, n)
    places = np.repeat(at, n) + inside
    order = np.lexsort((places, refs, starts))
    return starts[order], refs[order], places[order]


def factors_of(
    starts: np.ndarray, refs: np.ndarray, places: np.ndarray
) -> list[tuple[int, int, int, int]]:
    """(first word, words, reference document, reference start) of each factor of the parse.

    Matches come by start; at each the longest one is taken, and the next is sought behind its
    last window.
    """
    here: dict[int, list[tuple[int, int]]] = {}
    for s, r, p in zip(starts.tolist(), refs.tolist(), places.tolist(), strict=True):
        here.setdefault(s, []).append((r, p))
    # Windows that a match covers from each (start, place) on, from the end backwards.
    reach: dict[tuple[int, int, int], int] = {}
    for s in sorted(here, reverse=True):
        for r, p in here[s]:
            reach[s, r, p] = reach.get((s + 1, r, p + 1), 0) + 1
    factors, after = [], -1
    for s in sorted(here):
        if s > after:
            n, r, p = max((reach[s, r, p], -r, -p) for r, p in here[s])
            factors.append((s, n + WINDOW - 1, -r, -p))
            after = s + n - 1
    return factors


def kept_words(words: list[bytes], factors: list[tuple[int, ...]]) -> list[bytes]:
    keep = np.ones(len(words), bool)
    for start, length, *_ in factors:
        keep[start : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def _profiles(docs: DataFrame) -> DataFrame:
    """PLACE, doc_id, n_words, sequence (its hash) and anchors of every document."""
    names = ["doc_id", *PLACE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sequences, anchors = [], [], []
            for text in batch.column("text"):
                words = text.as_py().split()  # bytes: at the six ASCII blanks
                counts.append(len(words))
                sequences.append(hashlib.sha256(b" ".join(words)).digest())
                found = anchors_of(word_hashes(words)) if len(words) >= WINDOW else None
                anchors.append(None if found is None else found.view(np.int64))
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in names),
                    pa.array(counts, pa.int64()),
                    pa.array(sequences, pa.binary()),
                    pa.array(anchors, pa.list_(pa.int64())),
                ],
                [*names, "n_words", "sequence", "anchors"],
            )

    text = docs.select(
        F.col("doc_id").cast("bigint"), *place(), text_of().cast("binary").alias("text")
    )
    schema = "doc_id long, part long, at long"
    return text.mapInArrow(run, f"{schema}, n_words long, sequence binary, anchors array<long>")


def _combined(
    windows: np.ndarray, rids: np.ndarray, starts: np.ndarray
) -> pa.RecordBatch:
    """One row to look up per distinct window; runs of windows that repeat here are settled."""
    _, first, spot, counts = np.unique(
        windows, return_index=True, return_inverse=True, return_counts=True
    )
    last = np.zeros(len(first), np.int64)
    last[spot] = np.arange(len(windows))  # the last assignment to a place stays
    again = np.flatnonzero(counts[spot] > 1)
    # The place of a window is its first occurrence here; that of the first one the last.
    place = first[spot[again]]
    place = np.where(place == again, last[spot[again]], place)
    steps = [rids[again], starts[again], rids[place], starts[place]]
    follows = [np.diff(x) == d for x, d in zip(steps, (0, 1, 0, 1), strict=True)]
    new = np.ones(len(again), bool)
    new[1:] = ~np.logical_and.reduce(follows)
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(again)))
    run_rid, run_start, ref, at = (x[head] for x in steps)
    # Settled runs need no partner, so they spread by a key of their own.
    key = mix(run_rid.astype(np.uint64) ^ mix(run_start.astype(np.uint64))).view(np.int64)
    none = np.zeros(len(first), np.int64)
    return pa.record_batch(
        [
            pa.array(np.concatenate([windows[first], key])),
            pa.array(np.concatenate([rids[first], run_rid])),
            pa.array(np.concatenate([starts[first], run_start]).astype(np.int32)),
            pa.array(np.concatenate([none, length]).astype(np.int32)),
            pa.array(np.concatenate([none, ref])),
            pa.array(np.concatenate([none, at]).astype(np.int32)),
        ],
        ["window", "rid", "start", "settled", "ref", "at"],
    )


def _windows(texts: DataFrame) -> DataFrame:
    """(window, rid, start, settled, ref, at) of the windows in shared blocks.

    ``texts`` has rid, packed and anchors. ``settled`` 0 is a window to look up, n a run of n
    windows that have met their like already, from word ``at`` of document ``ref`` on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            rids = batch.column("rid").to_pylist()
            shared = batch.column("anchors")
            for k, text in enumerate(unpack(batch.column("packed"))):
                hashes = word_hashes(text.split())
                anchors, _ = window_anchors(hashes)
                wanted = shared[k].values.to_numpy().view(np.uint64)
                starts = np.flatnonzero(np.isin(anchors, wanted))
                windows = window_hashes(hashes, WINDOW)[starts].view(np.int64)
                held.append((windows, np.full(len(starts), rids[k]), starts))
                size += len(starts)
                if size >= CHUNK_WINDOWS:
                    yield _combined(*(np.concatenate(c) for c in zip(*held, strict=True)))
                    held, size = [], 0
        if held:
            yield _combined(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return texts.mapInArrow(
        run, "window long, rid long, start int, settled int, ref long, at int"
    )


def parse(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profiles of ``stable`` documents, with rid and copies, and (rid, runs) of parsed ones."""
    profiles = settle(
        _profiles(docs).withColumn("rid", F.monotonically_increasing_id()), "parse-profiles"
    )
    long = profiles.filter(F.col("n_words") >= WINDOW)
    classes = long.groupBy("sequence").agg(
        F.min("rid").alias("speaker"), F.count("*").alias("copies")
    )
    speakers = long.join(classes.select(F.col("speaker").alias("rid")), "rid", "left_semi")
    anchors = speakers.select("rid", F.explode("anchors").alias("anchor"))
    blocks = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    shared = (
        anchors.join(blocks.select("anchor"), "anchor", "left_semi")
        .groupBy("rid")
        .agg(F.collect_set("anchor").alias("anchors"))
    )
    wanted = profiles.select("rid", *PLACE).join(shared, "rid")
    texts = packed_texts(docs).join(wanted, PLACE).select("rid", "packed", "anchors")
    # A window has one row per chunk at most here, however often it occurs. A settled run, which
    # has a key of its own, may share it with a window by chance, but is no occurrence of it.
    alike, own = Window.partitionBy("window"), F.struct("rid", "start")
    open_ = F.when(F.col("settled") == 0, own)
    windows = _windows(texts).withColumns(
        {"first": F.min(open_).over(alike), "last": F.max(open_).over(alike)}
    )
    place = F.when(F.col("first") == own, F.col("last")).otherwise(F.col("first"))
    settled = F.col("settled") > 0
    run = F.struct(
        "start",
        F.greatest("settled", F.lit(1)).alias("n"),
        F.when(settled, F.col("ref")).otherwise(place["rid"]).alias("ref"),
        F.when(settled, F.col("at")).otherwise(place["start"]).alias("at"),
    )
    hits = (
        windows.filter(settled | (F.col("first") != F.col("last")))
        .groupBy("rid")
        .agg(F.collect_list(run).alias("runs"))
    )
    counted = profiles.drop("anchors").join(
        classes.select("sequence", "copies"), "sequence", "left"
    )
    return counted, hits


def _kept(docs: DataFrame, counted: DataFrame, hits: DataFrame) -> DataFrame:
    """(rid, n_removed, kept, factors, places) of documents that lose some but not all by being copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
        place = pa.list_(pa.struct([("ref", pa.int64()), ("at", pa.int32())]))
        for batch in batches:
            runs = batch.column("runs")
            removed, kept, spans, places = [], [], [], []
            for k, text in enumerate(unpack(batch.column("packed"))):
                words = text.split()
                factors = factors_of(*_matches(runs[k].values))
                left = kept_words(words, factors)
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
                spans.append([{"start": s, "length": n} for s, n, _, _ in factors])
                places.append([{"ref": r, "at": at} for _, _, r, at in factors])
            yield pa.record_batch(
                [
                    batch.column("rid"),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(spans, span),
                    pa.array(places, place),
                ],
                ["rid", "n_removed", "kept", "factors", "places"],
            )

    single = counted.filter(F.col("copies") == 1).select("rid", *PLACE).join(hits, "rid")
    texts = packed_texts(docs).join(single, PLACE).select("rid", "packed", "runs")
    spans = "array<struct<start:int,length:int>>, places array<struct<ref:bigint,at:int>>"
    return texts.mapInArrow(run, f"rid long, n_removed long, kept string, factors {spans}")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per changed document: rid, doc_id, n_words, n_removed, kept text, factors and places.

    Each factor (start, length) is what its place holds: word ``at`` of the document whose rid is
    ``ref`` and the words after it.
    """
    docs = stable(docs)
    counted, hits = parse(docs)
    return counted.select("rid", "doc_id", "n_words").join(_kept(docs, counted, hits), "rid")


def digest(docs: DataFrame) -> DataFrame:
    """Per document: words, words removed, and the SHA-256 of the words that stay."""
    docs = stable(docs)
    counted, hits = parse(docs)
    changed = _kept(docs, counted, hits).select(
        "rid", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
    copied = F.coalesce(F.col("copies") > 1, F.lit(False))
    nothing = hashlib.sha256(b"").hexdigest()
    return counted.join(changed, "rid", "left").select(
        "doc_id",
        "n_words",
        F.when(copied, F.col("n_words"))
        .otherwise(F.coalesce("n_removed", F.lit(0)))
        .cast("bigint")
        .alias("n_removed"),
        F.when(copied, F.lit(nothing))
        .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sequence"))))
        .alias("kept_sha256"),
    )
