"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed terms: letter runs, lower-cased, and the beginnings of
``PREFIXES`` letters of longer runs, so that inflected forms of one stem meet. A term that
occurs at least twice is a second term as well. The score is

    sigmoid(bias + sum w_i + 1/2 sum_f ((sum v_if)^2 - sum v_if^2))

over the document's active terms: besides single weights, every pair of terms has a learned
interaction, the product of two short vectors. Of the 2**``HASH_BITS`` hashed terms those stay
active that tell the classes apart most (half the G statistic over documents), alone, at least
``MIN_GAIN`` and ``ACTIVE_TERMS`` of them, or together with another term: of the pairs among the
``PAIR_CANDIDATES`` terms in most documents and the ``PAIR_BEST`` best ones the ``PAIRS`` whose
common presence says most, at least ``MIN_PAIR_GAIN`` more than either term. Terms and pairs are
counted by Spark; the machine itself is fitted on the driver to the active terms of a bounded
sample: the ``TRAIN_ROWS`` labelled, not held-out rows with the smallest id hashes.

Null or empty text: the score of no terms. Null ids or labels are not learned from; an id
labelled twice counts as toxic if any label says so, an id with several texts shows the least.
Without a label, or of one class only, the score is the smoothed share of toxic labels. Empty
tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import few_files, hold_out, settle, text_of, worker_held

THRESHOLD = 0.3
HASH_BITS = 18
TWICE = 1 << HASH_BITS
PREFIXES = (4, 5, 6, 7)
TRAIN_ROWS = 20_000
MIN_DOCUMENTS = 4
MIN_GAIN = 5.0
ACTIVE_TERMS = 4_096
#: Terms whose pairs are counted, pairs taken, and what a pair must say beyond its terms: as many
#: pairs reach half of that by chance as there are.
PAIR_CANDIDATES, PAIR_BEST, PAIRS = 768, 256, 512
MIN_PAIR_GAIN = 15.0
FACTORS = 4
STEPS, BATCH, RATE, DECAY = 1_000, 256, 0.1, 1e-3
SEED = 7
MAX_CACHED_WORDS = 100_000
#: Documents scored at a time.
LOT = 500

_LETTERS = re.compile(r"[^\W\d_]+")


def hashed_terms(word: str) -> set[int]:
    """The buckets of a lower-cased word between blanks."""
    found = set()
    for run in _LETTERS.findall(word):
        for part in (run, *(f"{run[:k]}*" for k in PREFIXES if len(run) > k)):
            found.add(zlib.crc32(part.encode()) >> (32 - HASH_BITS))
    return found


class TermIndex:
    """Documents to sorted active terms, with a bounded memory of words.

    A bucket's twin, ``TWICE`` above it, stands for at least two occurrences.
    """

    def __init__(self, buckets: Iterable[int] | None = None):
        self.place = self.wanted = None
        if buckets is not None:
            self.place = {b: i for i, b in enumerate(buckets)}
            self.wanted = {b % TWICE for b in self.place}
        self.known: dict[str, tuple[int, ...]] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self.known) > MAX_CACHED_WORDS:
            self.known.clear()
        for word in words.difference(self.known):
            terms = hashed_terms(word)
            self.known[word] = tuple(terms if self.wanted is None else terms & self.wanted)

    def terms(self, text: str) -> np.ndarray:
        words = text.lower().split()
        try:
            hits = [t for t in map(self.known.__getitem__, words) if t]
        except KeyError:
            self._learn(set(words))
            hits = [t for t in map(self.known.__getitem__, words) if t]
        counts = Counter(chain.from_iterable(hits))
        found = [*counts, *(b + TWICE for b, n in counts.items() if n > 1)]
        if self.place is not None:
            found = [self.place[b] for b in found if b in self.place]
        return np.array(sorted(found), np.int64)


def ragged(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All entries in a row, and the list that each is from."""
    lengths = [len(x) for x in lists]
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    return flat, np.repeat(np.arange(len(lists)), lengths)


@dataclass
class Machine:
    """The fitted factorization machine and the buckets its terms stand for."""

    buckets: list[int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def sums(self, lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Flat terms, their rows, logits and factor sums of documents."""
        flat, row = ragged(lists)
        n = len(lists)
        linear = np.bincount(row, self.weights[flat], n)
        v = self.factors[flat]
        total = np.stack([np.bincount(row, v[:, f], n) for f in range(v.shape[1])], 1)
        square = np.bincount(row, (v * v).sum(1), n)
        logits = self.bias + linear + 0.5 * ((total * total).sum(1) - square)
        return flat, row, logits, total

    def scores(self, lists: list[np.ndarray]) -> np.ndarray:
        if not lists:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.sums(lists)[2], -30, 30)))


def fit_machine(lists: list[np.ndarray], labels: np.ndarray, buckets: list[int]) -> Machine:
    """Adagrad on the logistic loss; terms without evidence decay towards zero."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    rng = np.random.default_rng(SEED)
    size = max(len(buckets), 1)
    m = Machine(
        buckets,
        float(np.log(share / (1 - share))),
        np.zeros(size),
        rng.normal(0, 0.01, (size, FACTORS)),
    )
    if not buckets or labels.min() == labels.max():
        return m
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    done = 0
    while done < STEPS:  # the same number for small and large samples
        order = rng.permutation(len(lists))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            done += 1
            flat, row, logits, total = m.sums([lists[i] for i in chosen])
            error = 1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels[chosen]
            terms, at = np.unique(flat, return_inverse=True)
            e = error[row]
            # Means over the documents of a batch that hold the term.
            held = np.bincount(at, minlength=len(terms))
            grad_w = np.bincount(at, e, len(terms)) / held + DECAY * m.weights[terms]
            pull = e[:, None] * (total[row] - m.factors[flat])
            grad_v = np.stack(
                [np.bincount(at, pull[:, f], len(terms)) for f in range(FACTORS)], 1
            ) / held[:, None] + DECAY * m.factors[terms]
            seen_w[terms] += grad_w**2
            seen_v[terms] += grad_v**2
            m.weights[terms] -= RATE * grad_w / np.sqrt(seen_w[terms])
            m.factors[terms] -= 0.2 * RATE * grad_v / np.sqrt(seen_v[terms])
            seen_b += error.mean() ** 2
            m.bias -= RATE * error.mean() / np.sqrt(seen_b)
    return m


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the bounded training sample."""
    usable = labels.filter(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~hold_out(F.col("doc_id"))
    ).select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    one = (
        usable.groupBy("label_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(TRAIN_ROWS)
    )
    return (
        docs.select("doc_id", text_of().alias("text"))
        .join(F.broadcast(one), F.col("doc_id") == F.col("label_id"))  # TRAIN_ROWS rows at most
        .groupBy("label_id")  # a repeated id gives one row
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("text", "toxic")
    )


def _half_g(clean, toxic, n_clean: int, n_toxic: int, log, choose):
    """Half the G statistic of documents with a term, by class, against those without it."""
    held, n = clean + toxic, n_clean + n_toxic

    def part(seen, expected):
        return choose(seen > 0, lambda: seen * log(seen / expected))

    return (
        part(clean, held * n_clean / n)
        + part(toxic, held * n_toxic / n)
        + part(n_clean - clean, (n - held) * n_clean / n)
        + part(n_toxic - toxic, (n - held) * n_toxic / n)
    )


def gain_of(clean: Column, toxic: Column, n_clean: int, n_toxic: int) -> Column:
    return _half_g(
        clean, toxic, n_clean, n_toxic, F.log, lambda some, value: F.when(some, value()).otherwise(0.0)
    )


def gains(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return _half_g(
            clean.astype(float), toxic.astype(float), n_clean, n_toxic, np.log,
            lambda some, value: np.where(some, value(), 0.0),
        )


def active_buckets(rows: DataFrame) -> list[int]:
    """The buckets whose presence, alone or in pairs, says most about the label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TermIndex()
        counts = np.zeros((2, 2 * TWICE), np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_pylist()
            for text, label in zip(batch.column("text"), toxic, strict=True):
                counts[min(label, 1)][index.terms(text.as_py())] += 1
        used = np.flatnonzero(counts.sum(0))
        yield pa.record_batch(
            [pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])],
            ["bucket", "clean", "toxic"],
        )

    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    clean, toxic = n.get(0, 0), sum(v for k, v in n.items() if k)
    if not clean or not toxic:
        return []
    held = F.col("clean") + F.col("toxic")
    gain = gain_of(F.col("clean"), F.col("toxic"), clean, toxic)
    counted = (
        rows.mapInArrow(count, "bucket long, clean long, toxic long")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(held >= MIN_DOCUMENTS)
        .select("bucket", held.alias("held"), F.round(gain, 6).alias("gain"))
    )
    counted = settle(few_files(counted, 2 * TWICE), "toxic-terms")
    ordered = counted.filter(F.col("gain") >= MIN_GAIN).orderBy(F.desc("gain"), "bucket")
    best = {r["bucket"]: r["gain"] for r in ordered.limit(ACTIVE_TERMS).collect()}
    common = (
        counted.filter((F.col("bucket") < TWICE) & (10 * F.col("held") <= 9 * (clean + toxic)))
        .orderBy(F.desc("held"), "bucket")
        .limit(PAIR_CANDIDATES)
    )
    candidates = {r["bucket"]: r["gain"] for r in common.collect()}
    candidates |= {b: g for b, g in list(best.items())[:PAIR_BEST] if b < TWICE}
    return sorted({*best, *paired_buckets(rows, candidates, clean, toxic)})


def paired_buckets(
    rows: DataFrame, own_gains: dict[int, float], clean: int, toxic: int
) -> set[int]:
    """The terms of ``own_gains`` in a pair whose common presence says more than either.

    A task counts its documents' pairs as a table per class, which leaves it row by row; a
    term's rows of all tasks meet, and only its best pairs go on.
    """
    candidates = sorted(own_gains)
    alone = np.array([own_gains[b] for b in candidates])
    size = len(candidates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TermIndex(candidates)
        counts = np.zeros((2, size, size), np.float32)
        for batch in batches:
            labels = [min(x, 1) for x in batch.column("toxic").to_pylist()]
            for low in range(0, len(labels), LOT):
                some = labels[low : low + LOT]
                held = np.zeros((len(some), size), np.float32)
                for k, text in enumerate(batch.column("text").slice(low, LOT)):
                    held[k, index.terms(text.as_py())] = 1
                for label in (0, 1):
                    mine = held[np.array(some) == label]
                    counts[label] += mine.T @ mine
        # Whole numbers below 2**24 are exact here; a sample has TRAIN_ROWS rows.
        data = counts.astype("<i4")
        yield pa.record_batch(
            [
                pa.array(range(size), pa.int32()),
                pa.array([data[0, i].tobytes() for i in range(size)], pa.binary()),
                pa.array([data[1, i].tobytes() for i in range(size)], pa.binary()),
            ],
            ["term", "clean", "toxic"],
        )

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        term, sums = None, None

        def found() -> pa.RecordBatch:
            together = gains(*sums, clean, toxic)
            wanted = together >= MIN_PAIR_GAIN + np.maximum(alone[term], alone)
            wanted &= sums.sum(0) >= MIN_DOCUMENTS
            wanted[: term + 1] = False
            partners = np.flatnonzero(wanted)
            columns = [np.full(len(partners), term), partners, together[partners]]
            kinds = (pa.int32(), pa.int32(), pa.float64())
            return pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "gain"]
            )

        for batch in batches:
            rows_ = zip(*(batch.column(c).to_pylist() for c in ("term", "clean", "toxic")), strict=True)
            for now, *data in rows_:
                row = np.stack([np.frombuffer(x, "<i4").astype(np.int64) for x in data])
                if now != term:
                    if term is not None:
                        yield found()
                    term, sums = now, row
                else:
                    sums = sums + row
        if term is not None:
            yield found()

    tables = rows.mapInArrow(count, "term int, clean binary, toxic binary")
    pairs = tables.repartition("term").sortWithinPartitions("term")
    pairs = pairs.mapInArrow(weigh, "a int, b int, gain double")
    best = pairs.orderBy(F.desc(F.round("gain", 6)), "a", "b").limit(PAIRS).collect()
    return {candidates[r[end]] for r in best for end in ("a", "b")}


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    rows = settle(sample(docs, labels), "toxic-sample")
    buckets = active_buckets(rows)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TermIndex(buckets)
        for batch in batches:
            lists = [index.terms(t.as_py()).tolist() for t in batch.column("text")]
            yield pa.record_batch(
                [pa.array(lists, pa.list_(pa.int32())), batch.column("toxic")], ["terms", "toxic"]
            )

    got = rows.mapInArrow(listed, "terms array<int>, toxic int").toArrow()  # TRAIN_ROWS at most
    lists = got.column("terms").to_pylist()
    labels_ = [min(t, 1) for t in got.column("toxic").to_pylist()]
    # An order of their own, so the fit does not depend on how tasks deal the rows.
    pairs = sorted(zip(lists, labels_, strict=True))
    return fit_machine(
        [np.array(p, np.int64) for p, _ in pairs], np.array([t for _, t in pairs], float), buckets
    )


def score(machine: Machine, text: Column) -> Column:
    """The toxicity of texts, 0 to 1."""
    key = zlib.crc32(np.array(machine.buckets, "<i8").tobytes())

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        index = worker_held(("toxicity", key), lambda: TermIndex(machine.buckets))
        found = []
        for low in range(0, len(texts), LOT):
            found.append(machine.scores([index.terms(t.as_py()) for t in texts.slice(low, LOT)]))
        return pa.array(np.concatenate(found or [np.zeros(0)]), pa.float64())

    return scores.asNondeterministic()(text)  # else a filter on it would compute it twice


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, toxicity) of every document, 0 to 1: ``row`` holds its columns as they are."""
    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    return docs.select(row, score(train(docs, labels), text_of()).alias("toxicity"))
