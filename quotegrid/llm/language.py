"""Language identification by a linear-chain conditional random field over words.

Every letter run of a text is a state of a chain whose label is its language. A word's emission
scores are sums of learned weights of its hashed features: beginnings and ends of 1 to 5 bytes,
byte trigrams, and the word itself (the lexicon). Transition scores are learned beside them.
Forward-backward gives each word's label probabilities; the document's language is the one with
the largest expected number of words, and its score that share.

Training is on the driver, on a bounded sample: of each of the ``MAX_LANGUAGES`` most frequent
languages the ``DOCS_PER_LANGUAGE`` documents with the smallest id hashes, ``SAMPLE_WORDS`` words in
a row of each from a place that a hash of the text sets; held-out rows and null languages are
left out. From these ``SEQUENCES`` code-switched chains are drawn: runs of words of one document
after runs of another, so transitions see switches although each document names one language.

Null text or none with a letter: ``und`` with score 0. Null ids can be learned from. Without a
labelled document every text is ``und``. Ties go to the first language by name. Empty tables
give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quotegrid.llm.common import hold_out, text_of, words_of, worker_held

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 250
MAX_LANGUAGES, SAMPLE_WORDS = 256, 2_000
FEATURE_BITS = 16
AFFIXES = 5
SEQUENCES, LENGTH, MEAN_RUN = 4_000, 40, 12
EPOCHS, BATCH, RATE, DECAY = 3, 100, 0.25, 1e-5
SEED = 11
MAX_CACHED_WORDS = 300_000
#: Words of one forward-backward call; a longer text makes a call of its own.
CHUNK_WORDS = 600_000

_LETTERS = regex.compile(r"\p{L}+")


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    """Hashes of one kind of feature as places in the weight table."""
    return ((h + np.uint32(kind)) * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS)


def features(words: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Hashed features of lower-cased letter runs, many at a time.

    The first part lists (words, features) with one feature a word: the run itself, and its
    beginnings and ends of 1 to AFFIXES bytes. The others are the owners, ascending, and the
    features of all byte trigrams.
    """
    raw = [w.encode() for w in words]
    size = np.array([len(b) for b in raw], np.int64)
    start = np.cumsum(size) - size
    byte = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32) + np.uint32(1)
    whole = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw))
    single = [(np.arange(len(raw)), _bucket(whole, 1))]
    head = np.zeros(len(raw), np.uint32)
    tail = np.zeros(len(raw), np.uint32)
    base = np.uint32(16777619)
    for k in range(AFFIXES):
        long = np.flatnonzero(size > k)
        head[long] = head[long] * base + byte[start[long] + k]
        tail[long] = tail[long] * base + byte[start[long] + size[long] - 1 - k]
        single.append((long, _bucket(head[long], 2 + k)))
        single.append((long, _bucket(tail[long], 102 + k)))
    owner = np.repeat(np.arange(len(raw)), size)
    at = np.flatnonzero(np.arange(len(byte)) + 2 < np.repeat(start + size, size))
    grams = (byte[at] * base + byte[at + 1]) * base + byte[at + 2]
    return single, owner[at], _bucket(grams, 202)


def _emissions(weights: np.ndarray, words: list[str]) -> np.ndarray:
    """Per word and label the sum of the weights of its features."""
    single, owner, grams = features(words)
    total = np.zeros((len(words), weights.shape[1]), weights.dtype)
    for some, places in single:
        total[some] += weights[places]
    if len(owner):
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        total[owner[first]] += np.add.reduceat(weights[grams], first, axis=0)
    return total


def forward_backward(
    emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray
) -> np.ndarray:
    """Label probabilities of every word of many chains, laid one after another.

    Chains advance together, longest first, so each step is one array operation over the chains
    that reach it. Probabilities are scaled at each step, which cancels in the result.
    """
    order = np.argsort(-lengths, kind="stable")
    start = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    reach = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")  # chains at step t
    e = np.exp(emissions - emissions.max(1, keepdims=True))
    a = np.exp(transitions - transitions.max())
    forward = np.empty_like(e)
    at = start[: reach[0]]
    now = e[at]
    now /= now.sum(1, keepdims=True)
    forward[at] = now
    for t in range(1, size[0]):
        n = reach[t]
        at = start[:n] + t
        now = (now[:n] @ a) * e[at]
        now /= now.sum(1, keepdims=True)
        forward[at] = now
    after = np.ones((len(size), e.shape[1]), e.dtype)
    for t in range(size[0] - 2, -1, -1):
        n = reach[t + 1]  # chains with a word after t
        at = start[:n] + t
        back = (after[:n] * e[at + 1]) @ a.T
        back /= back.sum(1, keepdims=True)
        after[:n] = back
        forward[at] *= back
    return forward / forward.sum(1, keepdims=True)


@dataclass
class Field:
    """A trained conditional random field."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray


def train_field(texts: list[tuple[str, str]]) -> Field:
    """Fit to (language, text) rows; the order of the rows does not matter."""
    languages = sorted({lang for lang, _ in texts})
    number = {lang: i for i, lang in enumerate(languages)}
    size = len(languages)
    field = Field(
        languages,
        np.zeros((1 << FEATURE_BITS, size), np.float32),
        np.zeros((size, size), np.float32),
    )
    docs: dict[int, list[list[str]]] = {}
    for lang, text in sorted(texts):
        words = _LETTERS.findall(text.lower())
        if words:
            docs.setdefault(number[lang], []).append(words)
    if not docs:
        return Field([], field.weights, field.transitions)
    rng = np.random.default_rng(SEED)
    present = sorted(docs)
    place: dict[str, int] = {}
    chains = np.zeros((SEQUENCES, LENGTH), np.int64)
    truth = np.zeros((SEQUENCES, LENGTH), np.int64)
    for s in range(SEQUENCES):
        filled = 0
        while filled < LENGTH:
            label = present[rng.integers(len(present))]
            words = docs[label][rng.integers(len(docs[label]))]
            run = min(int(rng.geometric(1 / MEAN_RUN)), LENGTH - filled, len(words))
            first = rng.integers(len(words) - run + 1)
            for k, word in enumerate(words[first : first + run]):
                chains[s, filled + k] = place.setdefault(word, len(place))
            truth[s, filled : filled + run] = label
            filled += run
    single, gram_owner, grams = features(list(place))
    owner = np.concatenate([some for some, _ in single] + [gram_owner])
    by_owner = np.argsort(owner, kind="stable")
    owner = owner[by_owner]
    flat = np.concatenate([p for _, p in single] + [grams])[by_owner].astype(np.int64)
    bounds = np.searchsorted(owner, np.arange(len(place) + 1))
    seen = np.full_like(field.weights, 1e-6)
    seen_t = np.full_like(field.transitions, 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(SEQUENCES)
        for low in range(0, SEQUENCES, BATCH):
            chosen = order[low : low + BATCH]
            words, at = np.unique(chains[chosen], return_inverse=True)
            some = np.concatenate([np.arange(bounds[w], bounds[w + 1]) for w in words])
            spot = np.searchsorted(words, owner[some])
            emit = np.zeros((len(words), size), np.float32)
            np.add.at(emit, spot, field.weights[flat[some]])
            label = truth[chosen].ravel()
            error, pairs = _gradient(emit[at.ravel()], label, field.transitions, len(chosen))
            grad_word = np.zeros((len(words), size), np.float32)
            np.add.at(grad_word, at.ravel(), error)
            used, where = np.unique(flat[some], return_inverse=True)
            grad = np.zeros((len(used), size), np.float32)
            np.add.at(grad, where, grad_word[spot])
            grad = grad / len(chosen) + DECAY * field.weights[used]
            seen[used] += grad**2
            field.weights[used] -= RATE * grad / np.sqrt(seen[used])
            step = pairs / len(chosen)
            seen_t += step**2
            field.transitions -= RATE * step / np.sqrt(seen_t)
    return field


def _gradient(
    emissions: np.ndarray, label: np.ndarray, transitions: np.ndarray, chains: int
) -> tuple[np.ndarray, np.ndarray]:
    """Expected minus observed counts: per word and label, and per pair of labels."""
    size = emissions.shape[1]
    lengths = np.full(chains, LENGTH)
    marginal = forward_backward(emissions, lengths, transitions)
    error = marginal.copy()
    error[np.arange(len(label)), label] -= 1
    # Pair probabilities from forward and backward messages, all steps at once.
    e = np.exp(emissions - emissions.max(1, keepdims=True)).reshape(chains, LENGTH, size)
    a = np.exp(transitions - transitions.max())
    ahead = np.empty_like(e)
    ahead[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
    for t in range(1, LENGTH):
        now = (ahead[:, t - 1] @ a) * e[:, t]
        ahead[:, t] = now / now.sum(1, keepdims=True)
    # backward message at t+1 times emission there = marginal / forward before emission.
    behind = marginal.reshape(chains, LENGTH, size)[:, 1:] / np.maximum(ahead[:, :-1] @ a, 1e-30)
    pair = ahead[:, :-1, :, None] * a[None, None] * behind[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    pairs = pair.sum((0, 1))
    spans = label.reshape(chains, LENGTH)
    np.add.at(pairs, (spans[:, :-1].ravel(), spans[:, 1:].ravel()), -1)
    return error, pairs


def train(docs: DataFrame) -> Field:
    usable = docs.select("doc_id", "lang", "text").filter(
        F.col("lang").isNotNull() & ~hold_out(F.col("doc_id"))
    )
    common = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    common = common.limit(MAX_LANGUAGES).select("lang")
    usable = usable.join(F.broadcast(common), "lang", "left_semi")
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        usable.select("doc_id", "lang")
        .withColumn("place", F.row_number().over(by_hash))
        .filter(F.col("place") <= DOCS_PER_LANGUAGE)
        .select(F.col("doc_id").alias("id"), F.col("lang").alias("id_lang"))
        .distinct()
    )
    # DOCS_PER_LANGUAGE rows per language at most.
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("lang") == F.col("id_lang"))
    words = words_of(F.col("text"))
    start = F.pmod(F.xxhash64("text"), F.size("words") - SAMPLE_WORDS + 1) + 1
    some = F.slice("words", start.cast("int"), F.lit(SAMPLE_WORDS))
    whole = F.size("words") <= SAMPLE_WORDS
    sample = (
        usable.join(F.broadcast(chosen), same, "left_semi")
        .select("lang", text_of().alias("text"))
        .withColumn("words", words)
        .withColumn("text", F.when(whole, F.col("text")).otherwise(F.array_join(some, " ")))
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text"))))
        .filter(F.col("place") <= DOCS_PER_LANGUAGE)
    )
    return train_field([(str(r["lang"]), r["text"]) for r in sample.select("lang", "text").collect()])


class Labeller:
    """A worker's view of a field: words to emission scores, with a bounded memory."""

    def __init__(self, field: Field):
        self.field = field
        self.forget()

    def forget(self) -> None:
        self.runs: dict[str, tuple[int, ...]] = {}
        self.place: dict[str, int] = {}
        self.emit = np.zeros((1 << 14, len(self.field.languages)), np.float32)

    def _learn(self, words: set[str]) -> None:
        fresh: list[str] = []
        for word in words:
            spots = []
            for run in _LETTERS.findall(word):
                if run not in self.place:
                    self.place[run] = len(self.place)
                    fresh.append(run)
                spots.append(self.place[run])
            self.runs[word] = tuple(spots)
        while len(self.emit) < len(self.place):
            self.emit = np.concatenate([self.emit, np.zeros_like(self.emit)])
        if fresh:
            spots = [self.place[r] for r in fresh]
            self.emit[spots] = _emissions(self.field.weights, fresh)

    def marginals(self, texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(place in ``texts``, label probabilities per word) of the texts with letters."""
        lot: list[list[str]] = []
        words = 0
        first = 0
        for text in texts:
            lot.append(text.lower().split())
            words += len(lot[-1])
            if words >= CHUNK_WORDS:
                yield from self._label(first, lot)
                first += len(lot)
                lot, words = [], 0
        yield from self._label(first, lot)

    def _label(self, first: int, lot: list[list[str]]) -> Iterator[tuple[int, np.ndarray]]:
        if len(self.runs) > MAX_CACHED_WORDS:
            self.forget()
        self._learn(set().union(*lot).difference(self.runs))
        runs = self.runs
        held = []
        for k, split in enumerate(lot, first):
            spots = np.array([i for w in split for i in runs[w]], np.int64)
            if len(spots):
                held.append((k, self.emit[spots]))
        yield from self._solve(held)

    def _solve(self, held: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
        if held:
            lengths = np.array([len(x) for _, x in held])
            emissions = np.concatenate([x for _, x in held])
            p = forward_backward(emissions, lengths, self.field.transitions)
            cuts = np.cumsum(lengths)[:-1]
            yield from zip((k for k, _ in held), np.split(p, cuts), strict=True)


def _labeller(field: Field) -> Labeller:
    key = zlib.crc32(field.weights.tobytes())
    return worker_held(("language", key), lambda: Labeller(field))


def predict(field: Field, text: Column) -> Column:
    """struct<lang, score> of texts."""
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    weights, transitions, languages = field.weights, field.transitions, field.languages

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if languages:
            labeller = _labeller(Field(languages, weights, transitions))
            for k, p in labeller.marginals(t.as_py() or "" for t in texts):
                share = p.mean(0, dtype=np.float64)
                best = int(np.argmax(share))
                langs[k], scores[k] = languages[best], min(1.0, float(share[best]))
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
        )

    return run.asNondeterministic()(text)


def label_words(field: Field, text: str) -> list[tuple[str, str]]:
    """(letter run, language) of one text, as for code-switched text."""
    labeller = Labeller(field)
    runs = [r for w in text.lower().split() for r in _LETTERS.findall(w)]
    for _, p in labeller.marginals([text]):
        best = p.argmax(1)
        return [(r, field.languages[b]) for r, b in zip(runs, best, strict=True)]
    return []


def identify(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score``, in place of columns so named."""
    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    found = docs.select(row, predict(train(docs), F.col("text").cast("string")).alias("found"))
    plain = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("lang_pred", "score")]
    return found.select(*plain, F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
