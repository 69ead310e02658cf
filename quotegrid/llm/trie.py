"""The prefix trie of conversations, by union-find over sorted neighbours.

A conversation is the row of its turns' signs, 20 bytes a turn: the MD5 of role and text, and the
number of words. Equal conversations are one class, made before anything is sorted. The classes
are sorted by their signs over all tasks, so those with a common beginning stand side by side.
A task takes its classes in lots; the edges between neighbours, each of the depth to which the
two agree, are taken deepest first, and each union of two components makes (or joins) the
branching node of that depth, below which both are done and given out.

What a lot cannot finish lies on the paths of its first and its last class. These two paths, with
what already hangs on each of their nodes, are the lot's contracted forest. Contracted forests
are paths in the same order as the classes, so they are merged by the same step, ``FAN_IN``
tasks at a time, until one lot is left, which finishes the root.

The turns of one conversation are one row while it is compared: 20 bytes a turn, below 2 GB.

Turn order: null turns first, equal turns as ``turns.turn_order`` says. A null role or text is an
empty one. Rows without conv_id belong to no conversation and are left out. Repeated rows are
turns of their own. Texts may be of any length. An empty table has no node, not even a root.
Further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import settle, words_of
from quotegrid.llm.turns import numbered, text_or, turn_order

#: Bytes of a turn's sign: MD5, then the number of words, big-endian.
SIGN = 20
#: A lot is closed at so many turns; a round merges what so many tasks left.
LOT_TURNS = 100_000
FAN_IN = 64
#: Ids of equal conversations are joined to texts of so many before they are hashed.
IDS_PER_TEXT = 4_096
NO_ID = (1 << 63) - 1


def sign() -> Column:
    name = F.concat(F.hex("role"), F.lit(":"), F.col("text"))
    n_words = F.lpad(F.hex(F.size(words_of(F.col("text")))), 8, "0")
    return F.unhex(F.concat(F.md5(name), n_words))


def signed_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, sign): the turns of every conversation, in order."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        text_or("role", "").alias("role"),
        text_or("text", "").alias("text"),
    )
    return numbered(rows, "conv", turn_order()).select("conv", "pos", sign().alias("sign"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, key): every conversation with the beginning of its family's first conversation."""
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).alias("head")
    own = turns.withColumn("head", head)
    convs = turns.select("conv").distinct().select(
        "conv", head, (F.col("conv") - F.col("conv") % 20).alias("base")
    )
    begin = turns.filter("pos < 3").withColumnRenamed("conv", "base")  # three rows each at most
    taken = convs.join(begin, "base").filter("pos < head").select("conv", "pos", "sign")
    rows = own.filter("pos >= head").select("conv", "pos", "sign").unionByName(taken)
    # A row without sign keeps conversations that have no turn left.
    rows = rows.unionByName(
        convs.select("conv", F.lit(-1).cast("bigint").alias("pos"), F.lit(b"").alias("sign"))
    )
    in_order = F.sort_array(F.collect_list(F.struct("pos", "sign")))
    key = F.reduce(in_order, F.lit(b""), lambda acc, r: F.concat(acc, r["sign"]))
    return rows.groupBy("conv").agg(key.alias("key"))


class Record:
    """What hangs on a path's node besides the path itself."""

    __slots__ = ("children", "first", "leaves", "members", "saved", "waiting")

    def __init__(self, members=0, first=NO_ID, children=0, leaves=0, saved=0):
        self.members, self.first, self.children = members, first, children
        self.leaves, self.saved = leaves, saved
        self.waiting: list[list] = []

    def add(self, other: Record) -> None:
        self.members += other.members
        self.first = min(self.first, other.first)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.waiting += other.waiting


class Path:
    """A key and the records of its nodes by depth, those of depth ``key`` and less."""

    __slots__ = ("key", "records")

    def __init__(self, key: bytes, records: dict[int, Record]):
        self.key, self.records = key, records

    @property
    def depth(self) -> int:
        return len(self.key) // SIGN


def common_depth(a: bytes, b: bytes) -> int:
    """Turns to which two keys agree."""
    low, high = 0, min(len(a), len(b)) // SIGN
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * SIGN] == b[: middle * SIGN]:
            low = middle
        else:
            high = middle - 1
    return low


def node_ids(key: bytes, low: int, high: int) -> list[bytes]:
    """The names of a path's nodes of depth ``low`` to ``high``."""
    running = hashlib.md5(key[: max(low, 0) * SIGN])
    names = [running.digest()]
    for depth in range(low + 1, high + 1):
        running.update(key[(depth - 1) * SIGN : depth * SIGN])
        names.append(running.digest())
    return names


#: A finished node: id, conv_id, depth, parent conv_id and, where that is open, its id, counts.
NODE = ["id", "conv_id", "depth", "parent", "parent_id", "n_convs", "n_children", "n_leaves"]
NODE += ["saved_tokens"]


class Forest:
    """A lot of sorted paths, united from the deepest common beginning upwards."""

    def __init__(self, paths: list[Path], whole: bool):
        self.paths, self.whole = paths, whole
        n = len(paths)
        self.parent = list(range(n))
        self.open = [not whole and i in (0, n - 1) for i in range(n)]
        self.top = [p.depth for p in paths]  # the deepest node that is not finished yet
        self.nodes: list[list] = []
        self.first, self.last = (0, n - 1) if not whole else (None, None)
        self.right: Path | None = None
        self._unite()

    def _find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def _climb(self, i: int, depth: int) -> Record | None:
        """Finish a component's nodes below ``depth``; what its upper one adds to that node."""
        path, top = self.paths[i], self.top[i]
        if top <= depth:
            return None
        names = node_ids(path.key, depth + 1, top)
        child: Record | None = None
        for d in range(top, depth, -1):
            own = path.records.pop(d, None) or Record()
            if child:
                own.add(child)
            if d:
                at = d * SIGN
                n_words = struct.unpack(">I", path.key[at - 4 : at])[0]
            else:
                n_words = 0
            own.saved += (own.members - 1) * n_words
            leaves = own.leaves or 1
            for below in own.waiting:
                below[3] = own.first
            node = [names[d - depth - 1], own.first, d, None, None, own.members, own.children]
            node += [leaves, own.saved]
            self.nodes.append(node)
            child = Record(own.members, own.first, 1, leaves, own.saved)
            child.waiting.append(node)
        self.top[i] = depth
        return child

    def _hang(self, path: Path, depth: int, record: Record) -> None:
        if depth in path.records:
            path.records[depth].add(record)
        else:
            path.records[depth] = record

    def _join(self, a: int, b: int, depth: int) -> None:
        """Unite two neighbouring components that agree to ``depth``."""
        if self.open[b] and not self.open[a]:
            a, b = b, a
        left, right = self.paths[a], self.paths[b]
        if self.open[b]:
            # First and last: from here upwards their paths are one, kept with the first.
            if b == self.first:
                a, b, left, right = b, a, right, left
            above = [d for d in right.records if d <= depth]
            for d in above:
                self._hang(left, d, right.records.pop(d))
            self.right = right
        else:
            child = self._climb(b, depth)
            for d in list(right.records):
                self._hang(left, d, right.records.pop(d))
            if child:
                self._hang(left, depth, child)
            if not self.open[a]:
                child = self._climb(a, depth)
                if child:
                    self._hang(left, depth, child)
        self.parent[b] = a

    def _unite(self) -> None:
        keys = [p.key for p in self.paths]
        edges = [(common_depth(keys[i], keys[i + 1]), i) for i in range(len(keys) - 1)]
        for depth, i in sorted(edges, key=lambda e: -e[0]):
            self._join(self._find(i), self._find(i + 1), depth)
        if self.whole:
            self._climb(self._find(0), -1)
        else:
            # Finished nodes whose parent is still open wait for it by name.
            for path in self.open_paths():
                if path.records:
                    low, high = min(path.records), max(path.records)
                    names = node_ids(path.key, low, high)
                    for d, record in path.records.items():
                        for node in record.waiting:
                            node[4] = names[d - low]

    def open_paths(self) -> list[Path]:
        """The contracted forest: the first path, and the last where it is another."""
        if self.whole:
            return []
        return [self.paths[0], *([self.right] if self.right else [])]


#: Rows of a merge: finished nodes, then the open paths with the place of their task.
ROWS = (
    "id binary, conv_id long, depth long, parent long, parent_id binary, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, key binary, records binary, place long"
)
_KINDS = {"binary": pa.binary(), "long": pa.int64()}
_FIELDS = [(f.split()[0], _KINDS[f.split()[1]]) for f in ROWS.split(", ")]
_RECORD = struct.Struct("<6q")


def _packed(path: Path) -> bytes:
    return b"".join(
        _RECORD.pack(d, r.members, r.first, r.children, r.leaves, r.saved)
        for d, r in sorted(path.records.items())
    )


def _unpacked(data: bytes) -> dict[int, Record]:
    return {d: Record(*rest) for d, *rest in _RECORD.iter_unpack(data)}


def merge(whole: bool, lot_turns: float = math.inf) -> Callable:
    """The step over a task's sorted paths (key, records[, place]): finished nodes, open paths.

    Paths of one place make a lot, or several by ``lot_turns``; without places a task is one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def result(paths: list[Path], place: int) -> Iterator[pa.RecordBatch]:
            forest = Forest(paths, whole)
            rows = [[*node, None, None, place] for node in forest.nodes]
            none = [None] * len(NODE)
            rows += [[*none, p.key, _packed(p), place] for p in forest.open_paths()]
            for low in range(0, len(rows), 10_000):
                some = rows[low : low + 10_000]
                columns = [pa.array([r[k] for r in some], t) for k, (_, t) in enumerate(_FIELDS)]
                yield pa.record_batch(columns, [n for n, _ in _FIELDS])

        paths: list[Path] = []
        turns, place = 0, task
        for batch in batches:
            placed = "place" in batch.schema.names
            places = batch.column("place").to_pylist() if placed else [task] * batch.num_rows
            for key, records, at in zip(
                batch.column("key"), batch.column("records"), places, strict=True
            ):
                path = Path(key.as_py(), _unpacked(records.as_py()))
                if paths and (at != place or turns + path.depth > lot_turns):
                    yield from result(paths, place)
                    paths, turns = [], 0
                place = at
                paths.append(path)
                turns += path.depth + 1
        if paths:
            yield from result(paths, place)

    return run


def _class_records(depth: str, members: str, first: str) -> Column:
    """The one record of a class, as ``_packed`` writes it: its members end at its last node."""
    zero = F.lit(0).cast("bigint")
    little = lambda c: F.unhex(
        F.concat(*[F.substring(F.lpad(F.hex(c), 16, "0"), 2 * k + 1, 2) for k in range(7, -1, -1)])
    )
    numbers = [F.col(depth), F.col(members), F.col(first), zero, zero, zero]
    return F.concat(*[little(n.cast("bigint")) for n in numbers])


def forest_nodes(classes: DataFrame, lot_turns: int = LOT_TURNS, fan_in: int = FAN_IN) -> DataFrame:
    """The nodes of the trie of (key, members, first) classes, with unresolved parents."""
    depth = F.octet_length("key") / SIGN
    paths = classes.withColumn("depth", depth).select(
        "key", _class_records("depth", "members", "first").alias("records")
    )
    step = merge(False, lot_turns)
    ordered = paths.repartitionByRange("key").sortWithinPartitions("key")
    finished = []
    while True:
        merged = settle(ordered.mapInArrow(step, ROWS), "trie-merge")
        finished.append(merged.filter("key IS NULL").select(*NODE))
        left = merged.filter("key IS NOT NULL").select("key", "records", "place")
        # Places are in the order of the keys; a round leaves one in ``fan_in`` of them.
        most = left.agg(F.max("place")).first()[0] or 0
        if most < fan_in:
            break
        paths = left.withColumn("place", F.floor(F.col("place") / fan_in))
        ordered = paths.repartition("place").sortWithinPartitions("place", "key")
        step = merge(False)
    last = left.select("key", "records").repartition(1).sortWithinPartitions("key")
    nodes = last.mapInArrow(merge(True), ROWS).select(*NODE)
    for more in finished:
        nodes = nodes.unionByName(more)
    return nodes


def ends(keys: DataFrame) -> DataFrame:
    """(id, ends_sha256): the SHA-256 of the joined ids of the conversations that end in a node.

    Ids are joined to texts where they stand sorted, so a node with a third of all conversations
    sends a few texts, not its rows, to the one task that its digest needs.
    """
    names = keys.select(F.unhex(F.md5("key")).alias("id"), "conv")
    ordered = names.repartitionByRange("id", "conv").sortWithinPartitions("id", "conv")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, low = None, [], 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array([name], pa.binary()), pa.array([low], pa.int64())]
            return pa.record_batch([*columns, pa.array([",".join(held)])], ["id", "low", "ids"])

        for batch in batches:
            for now, conv in zip(
                batch.column("id").to_pylist(), batch.column("conv").to_pylist(), strict=True
            ):
                if held and (now != name or len(held) >= IDS_PER_TEXT):
                    yield flush()
                    held = []
                if not held:
                    name, low = now, conv
                held.append(str(conv))
        if held:
            yield flush()

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, sha, found = None, None, []

        def flush() -> pa.RecordBatch:
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.binary(), pa.string()))]
            found.clear()
            return pa.record_batch(columns, ["id", "ends_sha256"])

        for batch in batches:
            for now, ids in zip(
                batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True
            ):
                if now == name:
                    sha.update(f",{ids}".encode())
                    continue
                if name is not None:
                    found.append((name, sha.hexdigest()))
                name, sha = now, hashlib.sha256(ids.encode())
                if len(found) >= 10_000:
                    yield flush()
        if name is not None:
            found.append((name, sha.hexdigest()))
            yield flush()

    texts = ordered.mapInArrow(join, "id binary, low long, ids string")
    together = texts.repartition("id").sortWithinPartitions("id", "low")
    return together.mapInArrow(hash_all, "id binary, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, lot_turns: int = LOT_TURNS, fan_in: int = FAN_IN
) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    keys = settle(rebuilt(signed_turns(conversations)), "trie-keys")
    classes = keys.groupBy("key").agg(F.count("*").alias("members"), F.min("conv").alias("first"))
    nodes = settle(forest_nodes(classes, lot_turns, fan_in), "trie-nodes")
    parents = nodes.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("found"))
    waiting = nodes.filter("parent_id IS NOT NULL").join(parents, "parent_id", "left")
    known = nodes.filter("parent_id IS NULL").withColumn("found", F.col("parent"))
    no_ends = hashlib.sha256().hexdigest()
    return (
        known.unionByName(waiting)
        .join(ends(keys), "id", "left")
        .select(
            "conv_id",
            "depth",
            F.col("found").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(no_ends)).alias("ends_sha256"),
        )
    )
