"""Line dedup by pairwise alignment of overlapping documents.

Lines are compared by a hash of their text between blanks. A run is the shortest row of
neighbouring lines with ``BLOCK_WORDS`` words from some line on, or up to some line; every longer
common block is made of runs. A run that several documents hold points each holder to its first
one, the holder with the least doc_id, so a run in any number of documents gives as many pairs as
holders, and no block lacks a pair. Each pair is aligned by patience diff: lines that occur once
in either document are matched in their longest common order, the gaps between them likewise,
and a gap without such lines at its widest common run. Aligned blocks of neighbouring lines with
at least ``BLOCK_WORDS`` words are deleted from the later document. One common order leaves
crossed blocks and further copies of a block, so what is left of the later document is aligned
again until no block is found. Exactly those lines go that lie in a block which stands in an
earlier document.

Documents with equal line sequences are one class: all but the first lose every line. Null or
empty text: one empty line, nothing to remove. Lines without a word are deleted only inside a
block. Of equal ids the lesser text hash comes first; a null id comes last. Repeated rows are
copies, the first of which stays. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import (
    PLACE,
    ROW_KEY,
    hand_back,
    place,
    row_key,
    settle,
    stable,
    text_of,
    worker_held,
)

BLOCK_WORDS = 8
BLANKS = b" \t\n\x0b\x0c\r"
#: Runs are hashed as polynomials of their line hashes.
PRIME, BASE = (1 << 61) - 1, 0x0D1C_E5A7_93B2_46F1
#: Documents whose runs leave a task together.
RUN_LOT = 500


def line_hashes(text: bytes) -> tuple[list[int], list[int]]:
    """Hash (0: no word) and words of each line."""
    hashes, words = [], []
    for line in text.split(b"\n"):
        n = len(line.split())
        words.append(n)
        hashes.append(xxhash.xxh3_64_intdigest(line.strip(BLANKS)) >> 1 if n else 0)
    return hashes, words


def runs(lines: Sequence[int], words: Sequence[int]) -> dict[tuple[int, int], int]:
    """Hash of each shortest run of BLOCK_WORDS words, from a line on or up to one, by its ends."""
    upto, sums, powers = [0], [0], [1]
    for h, n in zip(lines, words, strict=True):
        upto.append(upto[-1] + n)
        sums.append((sums[-1] * BASE + h + 1) % PRIME)
    ends = set()
    for i in range(len(lines)):
        end = bisect_left(upto, upto[i] + BLOCK_WORDS)
        if end <= len(lines):
            ends.add((i, end))
        start = bisect_right(upto, upto[i + 1] - BLOCK_WORDS) - 1
        if start >= 0:
            ends.add((start, i + 1))
    while len(powers) <= max((j - i for i, j in ends), default=0):
        powers.append(powers[-1] * BASE % PRIME)
    return {(i, j): (sums[j] - sums[i] * powers[j - i]) % PRIME for i, j in ends}


def _common_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that ascends on both sides; pairs ascend on the second."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (i, _) in enumerate(pairs):
        place = bisect_left(tails, i)
        back.append(at[place - 1] if place else -1)
        if place == len(tails):
            tails.append(i)
            at.append(k)
        else:
            tails[place], at[place] = i, k
    chain = []
    k = at[-1] if at else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def _shared_runs(
    a: Sequence[int], b: Sequence[int], words: Sequence[int]
) -> list[tuple[int, int, int]]:
    """(place in a, place in b, lines) of the runs of ``b`` that ``a`` holds, at its first one."""
    # Lines that b lacks are in no common run, whatever their words.
    size = dict(zip(b, words, strict=True))
    held: dict[int, int] = {}
    for (i, _), h in runs(a, [size.get(x, BLOCK_WORDS) for x in a]).items():
        held[h] = min(i, held.get(h, i))
    return [(held[h], i, j - i) for (i, j), h in runs(b, words).items() if h in held]


def patience(
    a: Sequence[int],
    b: Sequence[int],
    words: Sequence[int] | None = None,
    left: Sequence[bool] | None = None,
) -> list[tuple[int, int]]:
    """Matched places of two line sequences, ascending in both.

    Lines that occur once on either side are matched in their longest common order, the gaps
    between them likewise. A gap without such a line is matched at its widest common run, of
    ``BLOCK_WORDS`` words at least (by ``words`` of the lines of ``b``), and on both sides of it.

    ``left`` tells the lines of ``b`` that former alignments left. Then these are matched run by
    run, the widest first, anywhere in ``a`` and together with their neighbours.
    """
    if words is None:
        words = [BLOCK_WORDS] * len(b)
    if left is not None:
        return _left_over(a, b, words, list(left))
    found: list[tuple[int, int]] = []
    shared: list[tuple[int, int, int]] | None = None
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a_lo, a_hi, b_lo, b_hi = todo.pop()
        while a_lo < a_hi and b_lo < b_hi and a[a_lo] == b[b_lo]:
            found.append((a_lo, b_lo))
            a_lo, b_lo = a_lo + 1, b_lo + 1
        while a_lo < a_hi and b_lo < b_hi and a[a_hi - 1] == b[b_hi - 1]:
            a_hi, b_hi = a_hi - 1, b_hi - 1
            found.append((a_hi, b_hi))
        if a_lo >= a_hi or b_lo >= b_hi:
            continue
        ours, theirs = Counter(a[a_lo:a_hi]), Counter(b[b_lo:b_hi])
        place = {a[i]: i for i in range(a_lo, a_hi) if ours[a[i]] == 1}
        once = [(place[b[j]], j) for j in range(b_lo, b_hi) if theirs[b[j]] == 1 and b[j] in place]
        anchors = _common_order(once)
        if not anchors:
            if shared is None:
                shared = _shared_runs(a, b, words)
            gap = (a_lo, a_hi, b_lo, b_hi)
            anchors = _widest(a, b, shared, gap)
        if anchors:
            found.extend(anchors)
            ends = [(a_lo - 1, b_lo - 1), *anchors, (a_hi, b_hi)]
            for (i, j), (k, m) in zip(ends, ends[1:], strict=False):
                todo.append((i + 1, k, j + 1, m))
    return sorted(found)


def _left_over(
    a: Sequence[int], b: Sequence[int], words: Sequence[int], left: list[bool]
) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    shared = _shared_runs(a, b, words)
    while shared := [run for run in shared if any(left[run[1] : run[1] + run[2]])]:
        pairs = _widest(a, b, shared, (0, len(a), 0, len(b)))
        found.extend(pairs)
        for _, j in pairs:
            left[j] = False
    return found


def _widest(
    a: Sequence[int],
    b: Sequence[int],
    shared: list[tuple[int, int, int]],
    gap: tuple[int, int, int, int],
) -> list[tuple[int, int]]:
    """The pairs of the run with the most lines in a gap, each extended as far as the gap goes."""
    a_lo, a_hi, b_lo, b_hi = gap
    best, seen = (0, 0, 0), set()
    for i, j, n in shared:
        if i < a_lo or i + n > a_hi or j < b_lo or j + n > b_hi or (i - j, j) in seen:
            continue
        while i > a_lo and j > b_lo and a[i - 1] == b[j - 1]:
            i, j, n = i - 1, j - 1, n + 1  # noqa: PLW2901
        while i + n < a_hi and j + n < b_hi and a[i + n] == b[j + n]:
            n += 1  # noqa: PLW2901
        seen.update((i - j, j + k) for k in range(n))
        best = max(best, (n, -j, -i))
    n, j, i = best[0], -best[1], -best[2]
    return [(i + k, j + k) for k in range(n)]


def _mark(
    gone: list[bool],
    pairs: list[tuple[int, int]],
    earlier: Sequence[int],
    later: Sequence[int],
    words: Sequence[int],
) -> None:
    """Mark the aligned blocks, as far as they reach on both sides, that have enough words."""
    at = 0
    while at < len(pairs):
        i, j = pairs[at]
        n = 1
        while at + n < len(pairs) and pairs[at + n] == (i + n, j + n):
            n += 1
        at += n
        while i > 0 and j > 0 and earlier[i - 1] == later[j - 1]:
            i, j, n = i - 1, j - 1, n + 1
        while i + n < len(earlier) and j + n < len(later) and earlier[i + n] == later[j + n]:
            n += 1
        if sum(words[j : j + n]) >= BLOCK_WORDS:
            gone[j : j + n] = [True] * n


def common_blocks(
    earlier: Sequence[int], later: Sequence[int], words: Sequence[int]
) -> list[tuple[int, int]]:
    """(first line, lines) in the later document of the stretches that go.

    The two are aligned; what the blocks of that alignment leave of the later document is
    aligned again, now with any place of the earlier one.
    """
    gone = [False] * len(later)
    _mark(gone, patience(earlier, later, words), earlier, later, words)
    ours = set(earlier)
    left = [h in ours and not g for h, g in zip(later, gone, strict=True)]
    if any(left):
        _mark(gone, patience(earlier, later, words, left), earlier, later, words)
    edges = [j for j in range(len(later) + 1) if (j > 0 and gone[j - 1]) != (j < len(later) and gone[j])]
    return [(j, k - j) for j, k in zip(edges[::2], edges[1::2], strict=True)]


def _profiles(docs: DataFrame) -> DataFrame:
    """ROW_KEY, PLACE, sequence, lines and words of every document."""
    names = [*ROW_KEY, *PLACE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_held("lines", object)  # tables of the operator before go
        for batch in batches:
            both = [line_hashes(t.as_py()) for t in batch.column("text")]
            lines = pa.array([h for h, _ in both], pa.list_(pa.int64()))
            sequences = [hashlib.blake2b(repr(h).encode(), digest_size=16).digest() for h, _ in both]
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in names),
                    pa.array(sequences, pa.binary()),
                    lines,
                    pa.array([w for _, w in both], pa.list_(pa.int32())),
                ],
                [*names, "sequence", "lines", "words"],
            )

    text = docs.select(*row_key(), *place(), text_of().cast("binary").alias("text"))
    return text.mapInArrow(
        run,
        "id long, no_id boolean, text_hash long, part long, at long, sequence binary, "
        "lines array<long>, words array<int>",
    )


def _runs(docs: DataFrame) -> DataFrame:
    """ROW_KEY, rid and hash of every run of a document, each once."""
    names = [*ROW_KEY, "rid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lot in (batch.slice(k, RUN_LOT) for k in range(0, batch.num_rows, RUN_LOT)):
                both = zip(lot.column("lines"), lot.column("words"), strict=True)
                held = [set(runs(h.as_py(), n.as_py()).values()) for h, n in both]
                at = pa.array([k for k, own in enumerate(held) for _ in own], pa.int64())
                hashes = pa.array([h for own in held for h in own], pa.int64())
                yield pa.record_batch([*(lot.column(c).take(at) for c in names), hashes], [*names, "h"])
        hand_back()

    return docs.select(*names, "lines", "words").mapInArrow(
        run, "id long, no_id boolean, text_hash long, rid long, h long"
    )


def _align(pairs: DataFrame) -> DataFrame:
    """(rid, blocks) of the later documents; pairs hold both line sequences."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = []
            columns = (batch.column(c) for c in ("earlier", "lines", "words"))
            for earlier, later, words in zip(*columns, strict=True):
                got = common_blocks(earlier.as_py(), later.as_py(), words.as_py())
                blocks.append([{"start": j, "n": n} for j, n in got])
            yield pa.record_batch(
                [batch.column("rid"), pa.array(blocks, kind)], ["rid", "blocks"]
            )
        hand_back()

    return pairs.mapInArrow(run, "rid long, blocks array<struct<start:int,n:int>>")


def find_blocks(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profiles, with ``first``, the rid of the first document of the same lines (null without a
    word), and (rid, blocks) of the documents that lose lines by alignment."""
    numbered = _profiles(docs).withColumn("rid", F.monotonically_increasing_id())
    profiles = settle(numbered, "line-profiles")
    order = F.struct("no_id", "id", "text_hash", "rid")
    worded = profiles.filter(F.exists("words", lambda w: w > 0))
    firsts = worded.groupBy("sequence").agg(F.min(order)["rid"].alias("first"))
    speakers = profiles.join(firsts.select(F.col("first").alias("rid")), "rid", "left_semi")
    held = _runs(speakers)
    holders = (
        held.groupBy("h")
        .agg(F.count("*").alias("holders"), F.min(order)["rid"].alias("first"))
        .filter(F.col("holders") > 1)
    )
    pairs = (
        held.select("h", "rid")
        .join(holders, "h")
        .filter(F.col("rid") != F.col("first"))
        .select("rid", "first")
        .distinct()
    )
    both = pairs.join(profiles.select("rid", "lines", "words"), "rid").join(
        profiles.select(F.col("rid").alias("first"), F.col("lines").alias("earlier")), "first"
    )
    blocks = (
        _align(both.select("rid", "earlier", "lines", "words"))
        .filter(F.size("blocks") > 0)
        .groupBy("rid")
        .agg(F.flatten(F.collect_list("blocks")).alias("blocks"))
    )
    return profiles.join(firsts, "sequence", "left"), blocks


def _decisions(docs: DataFrame) -> DataFrame:
    """One row per document, by PLACE: n_lines, whether it is a copy of another, and the lines
    that go."""
    profiles, blocks = find_blocks(docs)
    inside = F.transform(
        "blocks", lambda b: F.sequence(b["start"], b["start"] + b["n"] - F.lit(1))
    )
    gone = F.array_distinct(F.flatten(inside))
    return profiles.join(blocks.select("rid", gone.alias("gone")), "rid", "left").select(
        *PLACE,
        F.size("lines").alias("n_lines"),
        F.coalesce(F.col("first") != F.col("rid"), F.lit(False)).alias("copy"),
        "gone",
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """(row, n_lines, n_removed, kept) of every document: ``row`` holds its columns as they are.

    A copy keeps the empty text.
    """
    docs = stable(docs)
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), *place())
    joined = rows.join(_decisions(docs), PLACE)
    lines = F.split(F.col("row.text").cast("string"), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), "gone")
    left = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    kept = (
        F.when(F.col("copy"), F.lit(""))
        .when(F.col("gone").isNull(), F.col("row.text"))
        .otherwise(left)
    )
    removed = F.when(F.col("copy"), F.col("n_lines")).otherwise(
        F.greatest(F.size("gone"), F.lit(0))
    )
    return joined.select(
        "row",
        F.col("n_lines").cast("bigint").alias("n_lines"),
        removed.cast("bigint").alias("n_removed"),
        kept.alias("kept"),
    )
