"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Compiled from a model file, the transducer is the composition of

* the normaliser: the model's table of characters, each an arc from the longest listed bytes to
  what replaces them; a dummy space in front, spaces to the word mark, repeated ones removed where
  the model says so;
* the lexicon: a trie of pieces, each an arc from its characters to its id, with a weight;
* the fallback: characters that are no piece go to their bytes' ids, at a high weight;
* the constraint: its states are the last piece of a merge model, and an arc for piece b leaves
  state a only if merging the characters of a+b gives back a and b. Adjacent pairs decide a whole
  segmentation, as merges on the two sides of an uncrossed boundary do not see each other, so
  exactly the merge result passes. A unigram model's constraint lets everything pass.

A text's ids are the output of the shortest path, in the tropical semiring, through the
composition of the text with the transducer. Weights are the negative scores of a unigram model; a
merge model's pieces weigh nothing, as its constraint leaves one path. That path is followed depth
first; where it needs a fallback, and in a unigram model, all arcs are relaxed place by place.

The composition restarts wherever no piece can cross: before a word mark after another
character, between a letter and a stop, around characters that only occur in pieces of their
own. Texts are cut there, and the paths of such chunks kept in a bounded memory.

Null text: empty, no ids. The literal word mark in a text decodes to a space. Repeated rows
are encoded each; empty tables give no rows.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotegrid.llm.common import text_of, worker_held

MARK = "▁"
#: Fixed by the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, MERGES = 1, 2
#: Fixed by the model format: what an unknown piece costs beyond the worst one.
UNKNOWN_PENALTY = 10.0
MAX_CHUNKS, MAX_PAIRS, MAX_STATES = 110_000, 300_000, 50_000
SHARED_LENGTH = 40
#: Ids decoded at a time.
BLOCK = 1 << 16
LOT = 256
#: Characters that mostly decide which arcs leave a place.
AHEAD = 4
NOTHING: dict[str, bool] = {}


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Normaliser:
    """The first machine: characters to what the model wants to see instead.

    The table is a double array: a unit holds a byte's label, whether an entry ends there, and
    the distance to its children or the entry's place among the replacements.
    """

    def __init__(self, spec):
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.squeeze = spec.remove_extra_whitespaces
        table = spec.precompiled_charsmap
        size = int.from_bytes(table[:4], "little")
        self.units = np.frombuffer(table, "<u4", size // 4, 4).tolist() if table else []
        self.outputs = table[4 + size :]

    def arc(self, data: bytes, at: int) -> tuple[int, str]:
        """(place behind the input, output) of the longest entry at a place, else of one character."""
        units, found = self.units, None
        node = (units[0] >> 10) << ((units[0] & 0x200) >> 6) if units else 0
        for k in range(at, len(data)) if units else ():
            node ^= data[k]
            unit = units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                found = (k + 1, units[node] & 0x7FFFFFFF)
        if found:
            end, place = found
            return end, self.outputs[place : self.outputs.index(b"\0", place)].decode()
        end = at + 1
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        return end, data[at:end].decode()

    def __call__(self, text: str) -> str:
        """The normalised text, with its dummy prefix; nothing for nothing."""
        if self.units:
            data, at, out = text.encode(), 0, []
            while at < len(data):
                at, seen = self.arc(data, at)
                out.append(seen)
            text = "".join(out)
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return self.prefix + text.replace(" ", MARK) if text else ""


class Paths(dict):
    """Paths by chunk: a missing one is searched when it is asked for.

    When there are many, they become the older ones, and those not asked for since are forgotten.
    """

    def __init__(self, search: Callable[[str], bytes]):
        super().__init__()
        self.search = search
        self.older: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.pop(chunk, None)
        if found is None:
            found = self.search(chunk)
        self[chunk] = found
        return found

    def age(self) -> None:
        self.older = dict(self)
        self.clear()


class Transducer:
    """A compiled model: ``encode`` composes a text with it, ``decode`` reverses the output."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as file:
            model.ParseFromString(file.read())
        spec, trainer = model.normalizer_spec, model.trainer_spec
        if not spec.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError("the word mark must stand before words")
        if trainer.model_type not in (UNIGRAM, MERGES):
            raise ValueError("only unigram and merge models are compiled")
        self.normalise = Normaliser(spec)
        self.merges = trainer.model_type == MERGES
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        lexicon = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER_DEFINED)}
        self.scores = [p.score for p in model.pieces]
        self.lexicon = lexicon
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        worst = min((self.scores[i] for i in lexicon.values()), default=0.0)
        self.fallback = UNKNOWN_PENALTY - worst
        # An arc's weight; none is below the least one, so a path of that weight is not beaten.
        self.weights = {p: 0.0 if self.merges else -self.scores[i] for p, i in lexicon.items()}
        self.least = 0.0 if self.merges else -float("inf")
        self.longest = max(map(len, lexicon), default=1)
        self.chunk = re.compile(self._chunks(), re.DOTALL)
        self.paths = Paths(self.shortest_path)
        # Answers of the constraint by last piece, and how many there are.
        self.after: dict[str, dict[str, bool]] = {}
        self.n_after = 0
        self.begun: dict[str, str] = {}
        self.states: dict[str | int, tuple[float, str]] = {}
        self.packed: dict[str, bytes] = {}
        # Merge order: characters first, then by score; runs of marks share one score.
        ranked = sorted(lexicon, key=lambda p: -self.scores[lexicon[p]])
        self.rank = {p: k for k, p in enumerate(ranked, 1) if len(p) > 1}
        tied = {s for s, n in Counter(self.scores[i] for i in lexicon.values()).items() if n > 1}
        self.tied = {p for p, i in lexicon.items() if len(p) > 1 and self.scores[i] in tied}
        self.own = {p: p for p in lexicon}  # one string object per piece, however often found
        # Endings of pieces: the piece itself where the ending is one, else nothing.
        self.tails = {p[k:]: self.own.get(p[k:], "") for p in lexicon for k in range(len(p))}
        # Beginnings of pieces: the longest piece that they begin with, else nothing.
        self.heads = {"": ""}
        for p in sorted(lexicon, key=len) if self.merges else ():
            for k in range(1, len(p)):
                if p[:k] not in self.heads:
                    self.heads[p[:k]] = self.heads[p[: k - 1]]
            self.heads[p] = p
        self.shorter = {p: self.heads[p[:-1]] for p in self.heads.values() if p}
        self.splits: dict[str, tuple[str, str] | None] = {}
        surface = [self._surface(i) for i in range(len(self.pieces))]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.lengths = np.array([len(x) for x in surface], np.int32)
        self.starts = self.lengths.cumsum(dtype=np.int32) - self.lengths

    def _chunks(self) -> str:
        """A pattern that cuts a text only between characters that no piece holds in a row."""
        pairs = {p[i : i + 2] for p in self.lexicon for i in range(len(p) - 1)}
        joined = {c for pair in pairs for c in pair}
        lone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined)
        stops = [c for c in string.punctuation if c in joined]
        before = {a for a, b in pairs if b in stops and a not in stops and a != MARK}
        stop, odd = "".join(map(re.escape, stops)), "".join(map(re.escape, sorted(before)))
        if any(a != MARK and b == MARK for a, b in pairs):
            return f"[{lone}]|[^{lone}]+" if lone else ".+"
        rest = f"(?:[{odd}][^{MARK}{lone}]*)?" if odd else ""
        plain = f"[^{MARK}{lone}{stop}{odd}]"
        found = [f"{MARK}+{f'[{stop}]*' if stop else ''}{plain}*{rest}", f"{plain}+{rest}"]
        found += [f"[{stop}]+{plain}*{rest}"] if stop else []
        found += [f"[{odd}][^{MARK}{lone}]*"] if odd else []
        return "|".join(found + ([f"[{lone}]"] if lone else []))

    def _surface(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == BYTE:
            return bytes([int(self.pieces[i][1:-1], 16)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == CONTROL else self.pieces[i].replace(MARK, " ").encode()

    # Pair constraint

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """A short text's parts after all merges, best score first, then leftmost; the last merge."""
        parts, last = list(text), None
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.lexicon.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], i
            if at < 0:
                break
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def _split(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge makes a piece last; None if merging never makes it."""
        if piece not in self.splits:
            parts, last = self.merged(piece)
            self.splits[piece] = last if parts == [piece] else None
        return self.splits[piece]

    def _uncrossed(self, a: str, b: str) -> bool:
        """Whether merging a+b leaves the boundary of a and b alone.

        Walks back in time from the finished pieces: at each moment the two parts that touch
        the boundary may not merge before the later made of them is there.
        """
        rank, limit = self.rank, len(self.lexicon) + 1
        while True:
            if rank.get(a + b, limit) < limit:
                return False
            if rank.get(a, 0) > rank.get(b, 0):
                limit = rank[a]
                a = self._split(a)[1]
            elif len(b) > 1:
                # A merge of the boundary comes first among equals, being further left.
                limit = rank[b] + 1
                b = self._split(b)[0]
            else:
                return True

    def follows(self, last: str, piece: str) -> bool:
        """Whether the constraint has an arc for ``piece`` in state ``last`` ('': the start)."""
        known = self.after.get(last, {}).get(piece)
        if known is None:
            if self.n_after > MAX_PAIRS:
                self.after.clear()
                self.n_after = 0
            if last in self.tied or piece in self.tied or last + piece in self.tied:
                known = self.merged(last + piece)[0] == ([last, piece] if last else [piece])
            else:
                made = len(piece) == 1 or self._split(piece) is not None
                known = made and (not last or self._uncrossed(last, piece))
            self.after.setdefault(last, {})[piece] = known
            self.n_after += 1
        return known

    # Composition and shortest path

    def arcs_into(self, text: str, k: int) -> list[tuple[int, str, float]]:
        """(start, characters, weight) of all arcs that end at a place: lexicon, then fallback."""
        found = []
        for j in range(k - 1, max(-1, k - 1 - self.longest), -1):
            piece = self.tails.get(text[j:k])
            if piece is None:
                break
            if piece:
                found.append((j, piece, self.weights[piece]))
        if text[k - 1] not in self.lexicon:
            found.append((k - 1, text[k - 1], self.fallback))
        return found

    def passes(self, last: str, piece: str) -> bool:
        """Whether the constraint lets a piece follow another one ('': the start)."""
        return not self.merges or len(piece) == 1 and piece not in self.lexicon or self.follows(last, piece)

    def shortest_path(self, text: str) -> bytes:
        """Output of the least-weight path of one normalised chunk, as 32-bit integers.

        A path of the least weight that any can have needs no comparison: in a merge model that is
        the one without a fallback, and it is followed first.
        """
        path = self.first_path(text) if self.merges else None
        if path is None:
            return self.relaxed_path(text)
        return b"".join([self.packed.get(piece) or self._pack(piece) for piece in path])

    def _begin(self, start: str) -> str:
        """The longest piece that characters with which no piece goes on begin with, else nothing."""
        k = len(start) - 1
        while start[:k] not in self.heads:
            k -= 1
        if len(self.begun) > MAX_STATES:
            self.begun.clear()
        self.begun[start] = self.heads[start[:k]]
        return self.begun[start]

    def first_path(self, text: str) -> list[str] | None:
        """The pieces of the path through the lexicon that the constraint lets pass, if there is one.

        Depth first, the longest arc first. As one state lives at each place, a place that led
        nowhere is not entered again.
        """
        n, heads, shorter = len(text), self.heads, self.shorter
        after, begun = self.after, self.begun
        path, at, seen = [], 0, set()
        known, piece = after.get("", NOTHING), None  # the arc to try; None: not looked for yet
        while at < n:
            if piece is None:
                k = at + AHEAD
                start = text[at:k]
                piece = begun.get(start)
                if piece is None:
                    piece = heads.get(start)
                    if piece is None:
                        piece = self._begin(start)
                    else:
                        while k < n:
                            k += 1
                            longer = heads.get(text[at:k])
                            if longer is None:
                                break
                            piece = longer
            while piece:
                if not seen or at + len(piece) not in seen:
                    open_ = known.get(piece)
                    if open_ or (open_ is None and self.follows(path[-1] if path else "", piece)):
                        break
                piece = shorter[piece]
            if piece:
                path.append(piece)
                at += len(piece)
                known, piece = after.get(piece, NOTHING), None
            elif path:
                seen.add(at)
                gone = path.pop()
                at -= len(gone)
                known, piece = after.get(path[-1] if path else "", NOTHING), shorter[gone]
            else:
                return None
        return path

    def relaxed_path(self, text: str) -> bytes:
        """Output of the least-weight path, found by relaxing the arcs into each place in turn.

        At each place one state lives, the best arc into it: a merge model's constraint lets one
        through, a unigram model's does not look at states. A place depends on the text before
        it alone, so those of short chunks are kept by that text and shared by all that begin
        alike. Equal weights: the longer piece. This is ``arcs_into`` and ``passes`` in one loop.
        """
        n, longest = len(text), self.longest
        tails, after, follows = self.tails, self.after, self.follows
        weights, least, free = self.weights, self.least, not self.merges
        shared = n <= SHARED_LENGTH
        states = self.states if shared else {}
        if len(states) > MAX_STATES:
            states.clear()
        states[""] = states[0] = (0.0, "")
        known = n if shared else 0
        while known and text[:known] not in states:
            known -= 1
        for k in range(known + 1, n + 1):
            best, state = None, ""
            for j in range(k - 1, max(-1, k - 1 - longest), -1):
                piece = tails.get(text[j:k])
                if piece is None:
                    break
                if piece:
                    before, last = states[text[:j] if shared else j]
                    weight = before + weights[piece]
                    if best is None or weight <= best:
                        open_ = free or after.get(last, NOTHING).get(piece)
                        if open_ or (open_ is None and follows(last, piece)):
                            best, state = weight, piece
                            if weight <= least:
                                break
            if best is None or text[k - 1] not in weights:
                over = states[text[: k - 1] if shared else k - 1][0]
                if self.merges:  # a merge model has no weights to compare with
                    over = over if best is None else least + 1
                else:
                    over += self.fallback
                if best is None or over < best:
                    best, state = over, text[k - 1]
            states[text[:k] if shared else k] = (best, state)
        path = []
        while n:
            piece = states[text[:n] if shared else n][1]
            path.append(self.packed.get(piece) or self._pack(piece))
            n -= len(piece)
        path.reverse()
        return b"".join(path)

    def _pack(self, piece: str) -> bytes:
        """The ids of a piece, or of a character without one."""
        if piece in self.lexicon:
            ids = [self.lexicon[piece]]
            self.packed[self.own[piece]] = np.array(ids, "<u4").tobytes()
        elif self.bytes:
            ids = [self.bytes[b] for b in piece.encode()]
        else:
            ids = [self.unknown]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, as unsigned 32-bit integers."""
        if not text:
            return np.zeros(0, "<u4")
        chunks = self.chunk.findall(self.normalise(text))
        paths = self.paths
        if len(paths) > MAX_CHUNKS:
            paths.age()
        ids = np.frombuffer(b"".join(map(paths.__getitem__, chunks)), "<u4")
        if self.bytes or len(ids) < 2:
            return ids
        # Without bytes to fall back to, a run of unknown characters is one unknown piece.
        unknown = ids == self.unknown
        return ids[~np.append(False, unknown[1:] & unknown[:-1])]

    def decode(self, ids: Sequence[int]) -> str:
        found = []
        for low in range(0, len(ids), BLOCK):
            block = np.asarray(ids[low : low + BLOCK], np.int64)
            lengths = self.lengths[block]
            ends = lengths.cumsum(dtype=np.int32)
            places = np.repeat(self.starts[block] - ends + lengths, lengths)
            places += np.arange(ends[-1], dtype=np.int32)
            found.append(self.surface[places].tobytes())
        text = b"".join(found).decode(errors="replace")
        if self.normalise.squeeze:
            return text.lstrip(" ")
        return text[1:] if self.normalise.prefix and text.startswith(" ") else text

    def shown(self, text: str) -> str:
        """What decoding the ids of a text should give: the text as normalised."""
        seen = self.normalise(text)
        return seen[len(self.normalise.prefix) :].replace(MARK, " ")


def transducer(model_file: str | None = None) -> Transducer:
    """The worker's compiled model, kept between its tasks."""
    path = model_file or default_model()
    return worker_held(("transducer", path), lambda: Transducer(path))


def _encoded(machine: Transducer, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The ids of texts, gathered in one growing buffer, and whether they decode to them."""
    values, ends, same = bytearray(), [0], []
    for t in texts:
        text = t.as_py() or ""
        ids = machine.encode(text)
        values += ids.tobytes()
        ends.append(len(values) // 4)
        same.append(machine.decode(ids) == machine.shown(text))
    flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), pa.array(same, pa.bool_())


def _in_lots(column: pa.Array, kind: pa.DataType, answer: Callable[[pa.Scalar], Any]) -> pa.Array:
    """``answer`` for each entry, gathered as Arrow data a few entries at a time."""
    lots = [
        pa.array([answer(x) for x in column.slice(low, LOT)], kind)
        for low in range(0, len(column), LOT)
    ]
    return pa.concat_arrays(lots) if lots else pa.array([], kind)


def encoded(text: Column, model_file: str | None = None) -> Column:
    """The ids of texts, as an array of int."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        return _encoded(transducer(model_file), texts)[0]

    return run.asNondeterministic()(text)


def decoded(ids: Column, model_file: str | None = None) -> Column:
    """The text of ids."""

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        machine = transducer(model_file)
        return _in_lots(lists, pa.string(), lambda x: machine.decode(x.as_py() or []))

    return run.asNondeterministic()(ids)


SUMMARY = T.StructType(
    [
        T.StructField("n_pieces", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
)


def summary(text: Column, model_file: str | None = None) -> Column:
    """struct<n_pieces, n_bytes (fallback ids), ids_crc32, round_trip> of texts."""

    @F.arrow_udf(SUMMARY)
    def run(texts: pa.Array) -> pa.Array:
        machine = transducer(model_file)
        fallback = np.array([k == BYTE for k in machine.kinds])

        def row(t: pa.Scalar) -> dict:
            text = t.as_py() or ""
            ids = machine.encode(text)
            return {
                "n_pieces": len(ids),
                "n_bytes": int(fallback[ids].sum()),
                "ids_crc32": zlib.crc32(ids.tobytes()),
                "round_trip": machine.decode(ids) == machine.shown(text),
            }

        kinds = [("n_pieces", pa.int64()), ("n_bytes", pa.int64()), ("ids_crc32", pa.int64())]
        return _in_lots(texts, pa.struct([*kinds, ("round_trip", pa.bool_())]), row)

    return run.asNondeterministic()(text)


CHECKED = T.StructType(
    [
        T.StructField("pieces", T.ArrayType(T.IntegerType())),
        T.StructField("decodes", T.BooleanType()),
    ]
)


def checked(text: Column, model_file: str | None = None) -> Column:
    """struct<pieces, decodes> of texts: the ids, and whether they decode to the text."""

    @F.arrow_udf(CHECKED)
    def run(texts: pa.Array) -> pa.Array:
        ids, same = _encoded(transducer(model_file), texts)
        return pa.StructArray.from_arrays([ids, same], ["pieces", "decodes"])

    return run.asNondeterministic()(text)


def encode_documents(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """All columns of ``docs`` plus ``pieces``, the ids of the text."""
    return docs.withColumn("pieces", encoded(text_of(), model_file))


def summarise_documents(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """doc_id and the summary of each document's ids."""
    return docs.select("doc_id", summary(text_of(), model_file).alias("s")).select("doc_id", "s.*")
