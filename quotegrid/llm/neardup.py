"""Near-duplicate documents by SuperMinHash, banding, exact verification and union-find.

A document's set holds the hashes of its distinct word shingles. SuperMinHash gives each element
a random permutation of the signature's places and lets it bid ``level + fraction`` for them
in that order; a place keeps its lowest bid. Elements of one document bid level by level, and
stop at the level that leaves no place empty, which larger sets reach after two or three.

Equal sets are one class, whose least key speaks for all copies. Classes that share all rows of
a band share a bucket. Each bucket has a hub, its class with the most company in all its buckets,
which is the centre of a group of near copies; every class is compared with the hubs of its
buckets, and whatever is linked so far becomes components. What remains is exact as well: among
the classes of a hub, strays from the hub's component are compared with the classes of other
components, in blocks of bounded size that hold the full sets and give links only. So no link
between two classes of a bucket is lost, no pairs of a group are ever written out, and copies
in any number are never compared. Links are confirmed on full sets.

A link at the threshold of 0.8 shares no bucket with probability (1 - 0.8**5)**40, about 1e-7.

Null or empty texts and texts without a word have an empty set, which is linked with nothing.
Texts with fewer words than a shingle have their whole sequence as their one element. Repeated
rows are copies. A null doc_id never names a component unless the component has no other; it
then is the component's null name. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import (
    PLACE,
    ROW_KEY,
    few_files,
    packed_texts,
    place,
    row_key,
    settle,
    stable,
    text_of,
    unpack,
)
from quotegrid.llm.components import components
from quotegrid.llm.hashing import mix, window_hashes, word_hashes

SHINGLE_WORDS = 5
PERCENT = 80
BANDS, ROWS = 40, 5
PLACES = BANDS * ROWS
#: Elements, and sets, that one call of the signature works on at a time.
CHUNK_ELEMENTS, CHUNK_SETS = 300_000, 2_000
#: Strays and classes that a block compares.
LEFT_ROWS, RIGHT_ROWS = 256, 512

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_GAMMA = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.arange(1, PLACES + 1, dtype=np.uint64) * _GAMMA
_LOW, _HALF = np.uint64(0xFFFFFFFF), np.uint64(32)


def shingles(text: bytes, k: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; A-Z are lower-cased."""
    words = text.lower().split()  # bytes: ASCII letters and the six ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    k = min(k, len(words))
    return np.unique(window_hashes(word_hashes(words), k, seed=k))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash of non-empty sets: one row of ``PLACES`` lowest bids each."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets)
    bids = np.full(len(sets) * PLACES, _EMPTY)
    drawn: list[np.ndarray] = []
    for level in range(PLACES):
        random = mix(element + _STEPS[level])
        index = level + (((random & _LOW) * np.uint64(PLACES - level)) >> _HALF).astype(np.int64)
        # The permutation so far swapped place i with drawn[i]: trace what lies at the index.
        place = index.copy()
        for i in range(level - 1, -1, -1):
            place[place == drawn[i]] = i
        bid = (np.uint64(level) << _HALF) | (random >> _HALF)
        np.minimum.at(bids, owner * PLACES + place, bid)
        drawn.append(index)
        open_sets = (bids.reshape(-1, PLACES) == _EMPTY).any(1)
        going = open_sets[owner]
        if not going.any():
            break
        if not going.all():
            owner, element = owner[going], element[going]
            drawn = [d[going] for d in drawn]
    return bids.reshape(-1, PLACES)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket name per set and band."""
    rows = signature.reshape(len(signature), BANDS, ROWS)
    key = np.zeros(rows.shape[:2], np.uint64)
    for r in range(ROWS):
        key = mix(key * _GAMMA + rows[:, :, r])
    return mix(key + np.arange(1, BANDS + 1, dtype=np.uint64) * _GAMMA)


def set_key(elements: np.ndarray) -> bytes:
    """Names a set: 16 bytes, as two sets in a corpus of any size may not share it by chance."""
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def _taken(texts: Iterator[bytes], k: int) -> Iterator[list[np.ndarray]]:
    """Sets in lots of bounded size."""
    lot: list[np.ndarray] = []
    held = 0
    for text in texts:
        lot.append(shingles(text, k))
        held += len(lot[-1])
        if held >= CHUNK_ELEMENTS or len(lot) >= CHUNK_SETS:
            yield lot
            lot, held = [], 0
    if lot:
        yield lot


def profile(docs: DataFrame, k: int) -> DataFrame:
    """ROW_KEY, PLACE, doc_id, n_shingles, key and bands of every document."""
    names = ["doc_id", *ROW_KEY, *PLACE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            for sets in _taken((t.as_py() for t in batch.column("text")), k):
                bands: list = [None] * len(sets)
                full = [i for i, s in enumerate(sets) if len(s)]
                if full:
                    found = band_keys(signatures([sets[i] for i in full])).view(np.int64)
                    for i, row in zip(full, found, strict=True):
                        bands[i] = row
                columns = [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ]
                kept = [batch.column(c).slice(low, len(sets)) for c in names]
                yield pa.record_batch([*kept, *columns], [*names, "n_shingles", "key", "bands"])
                low += len(sets)

    text = docs.select(
        F.col("doc_id").cast("bigint"), *row_key(), *place(), text_of().cast("binary").alias("text")
    )
    schema = "doc_id long, id long, no_id boolean, text_hash long, part long, at long"
    return text.mapInArrow(run, f"{schema}, n_shingles long, key binary, bands array<long>")


def _full_sets(docs: DataFrame, speakers: DataFrame, k: int) -> DataFrame:
    """(key, elements) of the classes' speakers, read from their texts again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sets in _taken(unpack(batch.column("packed")), k):
                keys = pa.array([set_key(s) for s in sets], pa.binary())
                elements = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.record_batch([keys, elements], ["key", "elements"])

    chosen = packed_texts(docs).join(speakers, PLACE, "left_semi").select("packed")
    return chosen.mapInArrow(run, "key binary, elements array<long>")


def _could_link(n: str, m: str):
    """Whether sets of these sizes can reach the threshold at all."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets are linked."""
    ours = sets.select(F.col("key").alias("u"), F.col("elements").alias("a"))
    theirs = sets.select(F.col("key").alias("v"), F.col("elements").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    return (
        pairs.join(ours, "u")
        .join(theirs, "v")
        .filter(100 * shared >= PERCENT * (F.size("a") + F.size("b") - shared))
        .select("u", "v")
    )


def _block_links(
    left: list[np.ndarray], right: list[np.ndarray], left_c: np.ndarray, right_c: np.ndarray
) -> list[tuple[int, int]]:
    """Linked pairs of sets of different components, one per left set and right component."""
    _, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    sizes = np.array([len(s) for s in right])
    starts = np.cumsum(sizes) - sizes
    at = sum(map(len, left))
    theirs = place[at:]
    marked = np.zeros(int(place.max()) + 1, np.int32)
    links = []
    low = 0
    for i, ours in enumerate(left):
        mine = place[low : low + len(ours)]
        low += len(ours)
        fits = (right_c != left_c[i]) & (
            100 * np.minimum(sizes, len(ours)) >= PERCENT * np.maximum(sizes, len(ours))
        )
        if not fits.any():
            continue
        marked[mine] = 1
        shared = np.add.reduceat(marked[theirs], starts)
        marked[mine] = 0
        found = fits & (100 * shared >= PERCENT * (sizes + len(ours) - shared))
        hits = np.flatnonzero(found)
        _, first = np.unique(right_c[hits], return_index=True)
        links.extend((i, int(hits[f])) for f in first)
    return links


def _search_blocks(rows: DataFrame) -> DataFrame:
    """Links (u, v) of blocks: rows of hub, l, r, stray, key, component and elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sides = None, ([], [])

        def solve() -> pa.RecordBatch:
            left, right = sides
            pairs = []
            if left and right:
                names = {c: k for k, c in enumerate({r[1] for r in left + right})}
                number = [np.array([names[c] for _, c, _ in side]) for side in sides]
                sets = [[e for _, _, e in side] for side in sides]
                links = _block_links(*sets, *number)
                pairs = [(left[i][0], right[j][0]) for i, j in links]
            columns = [pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)]
            return pa.record_batch(columns, ["u", "v"])

        # Rows come sorted by block, and a block has at most LEFT_ROWS + RIGHT_ROWS or so.
        for batch in batches:
            names = ("hub", "l", "r", "stray", "key", "component")
            plain = [batch.column(c).to_pylist() for c in names]
            elements = batch.column("elements")
            for k, (hub, l_, r, stray, key, component) in enumerate(zip(*plain, strict=True)):
                if block != (hub, l_, r):
                    yield solve()
                    block, sides = (hub, l_, r), ([], [])
                sides[0 if stray else 1].append((key, component, elements[k].values.to_numpy()))
        yield solve()

    return rows.mapInArrow(run, "u binary, v binary")


def _remaining_links(spokes: DataFrame, first: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different components among the classes of each hub, each once.

    The shuffle that makes them distinct also ends the search's Python workers: whoever reads the
    links in Python would else need a second worker for each task, and all of them stay.
    """
    named = spokes.join(first.withColumnRenamed("node", "key"), "key", "left").select(
        "hub", "key", F.coalesce("component", "key").alias("component")
    )
    main = named.filter(F.col("key") == F.col("hub")).select(
        "hub", F.col("component").alias("main")
    )
    marked = named.join(main, "hub").withColumn("stray", F.col("component") != F.col("main"))
    parts = (
        marked.groupBy("hub")
        .agg(F.count("*").alias("members"), F.count_if("stray").alias("strays"))
        .filter(F.col("strays") > 0)
        .select(
            "hub",
            F.ceil(F.col("strays") / LEFT_ROWS).cast("int").alias("lefts"),
            F.ceil(F.col("members") / RIGHT_ROWS).cast("int").alias("rights"),
        )
    )
    rows = marked.join(parts, "hub")

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("key"), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = rows.filter("stray").select(
        "hub", "key", "component", "stray", own("lefts").alias("l"), every("rights").alias("r")
    )
    right = rows.select(
        "hub", "key", "component", F.lit(False).alias("stray"),
        every("lefts").alias("l"), own("rights").alias("r"),
    )
    block = ["hub", "l", "r"]
    dealt = left.unionAll(right).join(sets, "key").repartition(*block)
    return _search_blocks(dealt.sortWithinPartitions(*block)).distinct()


def classes_and_components(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The profiles of ``stable`` documents, and (node, component) of the classes with a link."""
    profiles = settle(profile(docs, k), "near-profiles")
    known = profiles.filter(F.col("key").isNotNull())
    rows = profiles.count()  # as the files' footers have it
    classes = known.groupBy("key").agg(
        F.min(F.struct(*ROW_KEY, *PLACE)).alias("who"),
        F.max("n_shingles").alias("n"),
    )
    # All copies have the same bands: take them from the speaker's row alone.
    speaker_rows = (
        known.select("key", *PLACE, "bands")
        .join(classes.select("key", "who.part", "who.at", "n"), ["key", *PLACE])
        .select("key", "n", F.explode("bands").alias("bucket"))
    )
    shared = (
        speaker_rows.groupBy("bucket")
        .agg(F.count("*").alias("company"), F.min("key").alias("a"), F.max("key").alias("z"))
        .filter(F.col("a") != F.col("z"))
        .select("bucket", "company")
    )
    members = speaker_rows.join(shared, "bucket").distinct()
    members = settle(few_files(members, BANDS * rows), "near-members")
    central = members.groupBy("key").agg(F.sum("company").alias("centrality"))
    hubs = (
        members.select("bucket", "key", "n")
        .join(central, "key")
        .groupBy("bucket")
        .agg(F.max(F.struct("centrality", "key", "n")).alias("hub"))
        .select("bucket", F.col("hub.key").alias("hub"), F.col("hub.n").alias("hub_n"))
    )
    spokes = (
        members.select("bucket", "key", "n")
        .join(hubs, "bucket")
        .select("key", "n", "hub", "hub_n")
        .distinct()
    )
    spokes = settle(few_files(spokes, BANDS * rows), "near-spokes")
    pairs = spokes.filter((F.col("key") != F.col("hub")) & _could_link("n", "hub_n")).select(
        F.col("key").alias("u"), F.col("hub").alias("v")
    )
    # Every class in a bucket with another may be needed, now or in the blocks.
    speakers = classes.join(central.select("key"), "key", "left_semi").select("who.part", "who.at")
    sets = settle(_full_sets(docs, speakers, k), "near-sets")
    links = settle(_confirm(pairs, sets), "near-links")
    first = settle(few_files(components(links), rows), "near-first")
    more = _remaining_links(spokes, first, sets)
    return profiles, components(links.unionAll(more))


def near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """Every document with its set size, class, component and whether it stays.

    ``component_id`` is the least doc_id it can reach; ``kept`` marks the documents that bear
    it.
    """
    profiles, linked = classes_and_components(stable(docs), k)
    narrow = profiles.select("doc_id", *ROW_KEY, *PLACE, "n_shingles", "key")
    classes = narrow.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("least"))
    named = classes.join(linked.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key")
    )
    # One row per class; a component's least id is aggregated before it is joined back.
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "component").select("key", "component", "component_id")
    full = narrow.filter(F.col("key").isNotNull()).join(named, "key")
    empty = narrow.filter(F.col("key").isNull()).select(
        *narrow.columns,
        F.lit(None).cast("binary").alias("component"),
        F.col("doc_id").alias("component_id"),
    )
    return full.select(*empty.columns).unionAll(empty).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one document of each group of near copies, columns as they are.

    It is the one with the least doc_id, then the least text hash; of rows equal in both, one.
    Documents with an empty set all stay.
    """
    docs = stable(docs)
    found = near_duplicates(docs, k)
    who = F.struct("no_id", "id", "text_hash", *PLACE)
    grouped = found.filter(F.col("component").isNotNull())
    chosen = grouped.groupBy("component").agg(F.min(who).alias("who")).select("who.part", "who.at")
    empty = found.filter(F.col("component").isNull()).select(*PLACE)
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), *place())
    return rows.join(chosen.unionAll(empty), PLACE, "left_semi").select("row.*")
