"""Conversation structure repair as a shortest path, found by auction.

The lattice of a conversation has a node per (rows read, state); states: nothing yet, a system
turn, a user turn or an assistant turn last. Arcs are the edits: Keep 0, Rerole 1, Delete 2 (all
that a blank or duplicate row allows), Insert 5; a truncated row that stays adds 5. A path from
nothing to "nothing" or "assistant" spells the roles `(s?(ua)+)?`.

The auction keeps a path from the origin and a price per node, never above the cost of an arc plus
the price of its end. The path's last node either raises its price to the least such sum and is
taken off the path, or, where the price is that sum already, the path is extended along the arc.
When the path reaches the end, the origin's price is the distance; every shortest path then runs
along tight arcs only, and the one with the least letters is traced on them.

A conversation is cut into blocks of ``BLOCK_ROWS`` rows, so one that holds a third of all rows is
spread over many tasks. A block becomes the 4 x 4 distances between its states; one narrow pass
backwards over the blocks gives the prices at their ends, one forwards joins their traces. Only
the SHA-256 of the repaired text is one stream per conversation, of bounded memory, as its
definition asks.

Turn order: null turns first, equal turns as ``turns.turn_order`` says. A null role or text is one space, also
a null conv_id or turn in the checksum's text. A null conv_id is a conversation of its own.
Repeated rows are rows. Conversations of which no row is left have zeros; an empty table gives no
rows. Roles count by their first letter; other roles fit nowhere unless reroled. Texts may be of
any length. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import BLANKS, few_files, settle
from quotegrid.llm.turns import numbered, text_or, turn_order

BLOCK_ROWS = 64
#: Fixed: what the edits cost.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: Entry states, and what leaving in each state costs; None where it may not be.
FAR = None
WHOLE = (0, FAR, FAR, 0)

#: A row as one letter: its role's first letter (x: any other), capital if truncated; - if it
#: must go.
GONE = "-"


def _next(state: int) -> int:
    """The state after the turn that ``state`` asks for: user, or assistant after user."""
    return ASSISTANT if state == USER else USER


def _row_arcs(code: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of a row's edits."""
    yield "D", DELETE, state
    if code == GONE:
        return
    extra = TRUNCATED if code.isupper() else 0
    first = code.lower()
    if first == "s" and state == START:
        yield "K", KEEP + extra, SYSTEM
    wanted = "a" if state == USER else "u"
    if first == wanted:
        yield "K", KEEP + extra, _next(state)
    else:
        yield "R", REROLE + extra, _next(state)


class Lattice:
    """The nodes, arcs and prices of a block, for given costs of leaving it in each state.

    Insertions behind the last row belong to the block that follows, if one does.
    """

    def __init__(self, codes: str, exits: tuple[int | None, ...], last: bool):
        n = len(codes)
        self.end = (n + 1) * STATES
        self.arcs: list[list[tuple[str, int, int]]] = []
        for i in range(n + 1):
            for state in range(STATES):
                arcs = []
                if i == n and exits[state] is not FAR:
                    arcs.append(("", exits[state], self.end))
                if i < n:
                    found = sorted(_row_arcs(codes[i], state))
                    arcs += [(a, cost, (i + 1) * STATES + s) for a, cost, s in found]
                if i < n or last:
                    arcs.append(("I", INSERT, i * STATES + _next(state)))
                self.arcs.append(sorted(arcs))
        # A first price that no arc undercuts: the least that the rows to come can cost.
        least = min(c for c in exits if c is not FAR)
        self.price = [0] * (self.end + 1)
        for i in range(n, -1, -1):
            self.price[i * STATES : (i + 1) * STATES] = [least] * STATES
            if i:
                code = codes[i - 1]
                least += DELETE if code == GONE or code.isupper() else code not in "sua"

    def distance(self, origin: int) -> int:
        """The cheapest way from a state at the first row to the end, which must be reachable."""
        price, path = self.price, [origin]
        while path[-1] != self.end:
            node = path[-1]
            sums = ((cost + price[j], j) for _, cost, j in self.arcs[node])
            best, to = min(sums, default=(math.inf, self.end))
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        return price[origin]

    def trace(self, origin: int) -> tuple[str, int]:
        """The least letters of a shortest path from ``origin``, and the state it leaves in."""
        self.distance(origin)
        dead: set[int] = set()
        path, letters = [origin], [""]
        choices = [iter(self.arcs[origin])]
        while path[-1] != self.end:
            node = path[-1]
            for letter, cost, j in choices[-1]:
                if j not in dead and self.price[node] == cost + self.price[j]:
                    path.append(j)
                    letters.append(letter)
                    choices.append(iter(self.arcs[j]) if j != self.end else iter(()))
                    break
            else:
                dead.add(path.pop())
                letters.pop()
                choices.pop()
        return "".join(letters), path[-2] % STATES


@lru_cache(100_000)
def _ends(codes: str) -> tuple[int, ...]:
    """Per entry state the states, as bits, that a block which others follow can be left in."""
    found = [1 << s for s in range(STATES)]
    for code in codes:
        for entry, states in enumerate(found):
            for _ in range(2):  # insertions in front of the row
                states |= sum({1 << _next(s) for s in range(STATES) if states >> s & 1})  # noqa: PLW2901
            found[entry] = 0
            for s in range(STATES):
                if states >> s & 1:
                    for _, _, to in _row_arcs(code, s):
                        found[entry] |= 1 << to
    return tuple(found)


@lru_cache(100_000)
def distances(codes: str) -> tuple[int, ...]:
    """Entry state by exit state of a block that others follow; -1 where there is no way."""
    found = [-1] * (STATES * STATES)
    for state in range(STATES):
        exits = tuple(0 if s == state else FAR for s in range(STATES))
        entries = [e for e in range(STATES) if _ends(codes)[e] >> state & 1]
        lattice = Lattice(codes, exits, last=False) if entries else None
        for entry in entries:
            found[entry * STATES + state] = lattice.distance(entry)
    return tuple(found)


@lru_cache(100_000)
def traces(
    codes: str, exits: tuple[int | None, ...], entries: tuple[int, ...], last: bool
) -> tuple[tuple[int, str, int] | None, ...]:
    """(cost, letters, exit state) per entry state, for given prices at the block's end."""
    lattice = Lattice(codes, exits, last)
    found: list[tuple[int, str, int] | None] = [None] * STATES
    for entry in entries:
        letters, state = lattice.trace(entry)
        found[entry] = (lattice.price[entry], letters, state)
    return tuple(found)


def repair(codes: str) -> tuple[int, str]:
    """Cost and edits of a whole conversation given as one block."""
    cost, letters, _ = traces(codes, WHOLE, (START,), True)[START]
    return cost, letters


def _map(
    df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[dict]], schema: str
) -> DataFrame:
    """A function over a partition's rows, one at a time, as ``mapInArrow``."""
    kinds = {"string": pa.string(), "long": pa.int64(), "longs": pa.list_(pa.int64())}
    kinds["strings"] = pa.list_(pa.string())
    fields = [tuple(f.split()) for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def flush() -> pa.RecordBatch:
            columns = [pa.array([r[n] for r in held], kinds[k]) for n, k in fields]
            held.clear()
            return pa.record_batch(columns, [n for n, _ in fields])

        def single() -> Iterator[dict]:
            for batch in batches:
                for low in range(0, batch.num_rows, 1_000):
                    yield from batch.slice(low, 1_000).to_pylist()

        for row in rows(single()):
            held.append(row)
            if len(held) >= 2_000:
                yield flush()
        if held:
            yield flush()

    types = {"longs": "array<long>", "strings": "array<string>"}
    return df.mapInArrow(run, ", ".join(f"{n} {types.get(k, k)}" for n, k in fields))


#: Names a conversation; empty where conv_id is null.
CONV = "conv"


def conversation_key() -> Column:
    return text_or("conv_id", "").alias(CONV)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text): the rows that the fixed damage leaves, as it leaves them."""
    named = F.concat(text_or("conv_id", " "), F.lit(":"), text_or("turn", " "))
    rows = conversations.select(
        conversation_key(),
        F.col("turn").cast("bigint").alias("turn"),
        text_or("role", " ").alias("role"),
        text_or("text", " ").alias("text"),
        (F.crc32(named.cast("binary")) % 20).alias("fault"),
    ).filter("fault <> 0")
    text = (
        F.when(F.col("fault") == 1, F.lit(""))
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.lit(2)).otherwise(F.lit(1))
    return rows.select(
        CONV, "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), times))
    ).drop("col")


def judged(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) with ``pos`` and the narrow signs of their first fault."""
    text = F.rtrim(F.translate("text", BLANKS, " " * len(BLANKS)))
    signs = rows.withColumns(
        {
            "blank": text == "",
            "cut": ~F.right(text, F.lit(1)).isin(".", "!", "?"),
            "same": F.unhex(F.md5(F.concat(F.hex("role"), F.lit(":"), F.col("text")))),
        }
    )
    return numbered(signs, CONV, turn_order())


def coded(rows: DataFrame) -> DataFrame:
    """``judged`` rows without their text: (conv, pos, turn, code, dup, blank, cut, first)."""
    narrow = rows.select(
        CONV, "pos", "turn", "blank", "cut", "same", F.substring("role", 1, 1).alias("first")
    )
    seen = narrow.groupBy(CONV, "same").agg(F.min("pos").alias("seen"))
    narrow = narrow.join(seen, [CONV, "same"]).withColumn("dup", F.col("pos") > F.col("seen"))
    role = F.when(F.col("first").isin("s", "u", "a"), F.col("first")).otherwise(F.lit("x"))
    code = (
        F.when(F.col("blank") | F.col("dup"), F.lit(GONE))
        .when(F.col("cut"), F.upper(role))
        .otherwise(role)
    )
    return narrow.select(
        CONV,
        "pos",
        "turn",
        code.alias("code"),
        role.alias("first"),
        F.col("blank").cast("bigint").alias("blank"),
        (~F.col("blank") & F.col("dup")).cast("bigint").alias("duplicate"),
        (~F.col("blank") & ~F.col("dup") & F.col("cut")).cast("bigint").alias("truncated"),
    )


def counted(codes: DataFrame) -> DataFrame:
    """gaps, blank, duplicate and truncated per conversation."""
    turns = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    return codes.groupBy(CONV).agg(
        F.coalesce(turns, F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )


def _blocks(codes: DataFrame, block_rows: int) -> DataFrame:
    """(conv, block, codes, firsts, ways): a row per block; ways only where others follow."""
    block = F.floor(F.col("pos") / block_rows).alias("block")
    pairs = F.sort_array(F.collect_list(F.struct("pos", "code", "first")))
    grouped = codes.groupBy(CONV, block).agg(pairs.alias("rows"))
    joined = lambda field: F.concat_ws("", F.transform("rows", lambda r: r[field]))
    return grouped.select(CONV, "block", joined("code").alias("codes"), joined("first").alias("firsts"))


def _with_ways(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        yield {**row, "ways": distances(row["codes"]) if row["more"] else []}


def _backwards(rows: Iterator[dict]) -> Iterator[dict]:
    """Blocks from a conversation's last to its first, with the prices of leaving them."""
    conv, exits = None, WHOLE
    for row in rows:
        if row[CONV] != conv:
            conv, exits, last = row[CONV], WHOLE, True
        yield {**row, "exits": list(exits), "last": int(last)}
        if row["block"]:
            ways = row["ways"]
            if last:
                found = traces(row["codes"], WHOLE, tuple(range(STATES)), True)
                exits = tuple(t[0] for t in found)
            else:
                sums = [
                    [
                        ways[e * STATES + s] + exits[s]
                        for s in range(STATES)
                        if exits[s] is not FAR and ways[e * STATES + s] >= 0
                    ]
                    for e in range(STATES)
                ]
                exits = tuple(min(x) if x else FAR for x in sums)
            last = False


def _traced(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        entries = tuple(range(STATES)) if row["block"] else (START,)
        found = traces(row["codes"], tuple(row["exits"]), entries, bool(row["last"]))
        yield {
            CONV: row[CONV],
            "block": row["block"],
            "firsts": row["firsts"],
            "costs": [t[0] if t else -1 for t in found],
            "letters": [t[1] if t else "" for t in found],
            "leaves": [t[2] if t else -1 for t in found],
        }


#: Fixed: neighbouring roles that are in order.
LEGAL = {"su", "ua", "au"}


def _forwards(rows: Iterator[dict]) -> Iterator[dict]:
    """A conversation's blocks in order: the letters of each, by the state it is entered in."""
    conv, state, before = None, START, ""
    for row in rows:
        if row[CONV] != conv:
            conv, state, before = row[CONV], START, ""
        firsts = before + row["firsts"]
        illegal = sum(firsts[i : i + 2] not in LEGAL for i in range(len(firsts) - 1))
        before = row["firsts"][-1:]
        yield {
            CONV: conv,
            "block": row["block"],
            "letters": row["letters"][state],
            "cost": row["costs"][state] if row["block"] == 0 else None,
            "illegal": illegal,
        }
        state = row["leaves"][state]


def _in_order(df: DataFrame, *order: Column | str) -> DataFrame:
    return df.repartition(CONV).sortWithinPartitions(CONV, *order)


def edits(codes: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv, block, letters, cost, illegal): the edits of every block; the cost in the first."""
    rows = codes.count()  # as the files' footers have it
    blocks = settle(few_files(_blocks(codes, block_rows), rows), "repair-blocks")
    n = blocks.groupBy(CONV).agg(F.max("block").alias("most"))
    more = (F.col("most") > F.col("block")).cast("bigint").alias("more")
    fields = f"{CONV} string, block long, codes string, firsts string"
    plain = blocks.join(n, CONV).select(CONV, "block", "codes", "firsts", more)
    ways = _map(plain, _with_ways, f"{fields}, ways longs")
    back = _map(
        _in_order(ways, F.col("block").desc()),
        _backwards,
        f"{fields}, exits longs, last long",
    )
    traced = _map(
        back,
        _traced,
        f"{CONV} string, block long, firsts string, costs longs, letters strings, leaves longs",
    )
    chosen = f"{CONV} string, block long, letters string, cost long, illegal long"
    return _map(_in_order(traced, "block"), _forwards, chosen)


def _repaired(rows: Iterator[dict]) -> Iterator[dict]:
    """Applies the edits to the texts: audit and SHA-256 per conversation.

    A block's letters come before its rows.
    """
    conv, turns, audit = None, None, []

    def apply(state: int, text: str, role: str | None = None) -> int:
        nonlocal turns
        if role is None:
            role = "assistant" if state == USER else "user"
        turns.update((b"\n" if state != START else b"") + f"{role}:{text}".encode())
        return _next(state)

    def result() -> dict:
        return {CONV: conv, "audit": "".join(audit), "repaired_sha256": turns.hexdigest()}

    letters: Iterator[str] = iter("")
    waiting = ""

    def inserted(state: int) -> int:
        """Plays insertions up to the next letter that takes a row."""
        nonlocal waiting
        waiting = ""
        for letter in letters:
            if letter != "I":
                waiting = letter
                break
            state = apply(state, "")
        return state

    state = START
    for row in rows:
        if row[CONV] != conv:
            if conv is not None:
                yield result()
            conv, turns, audit, state = row[CONV], hashlib.sha256(), [], START
        if row["letters"] is not None:
            audit.append(row["letters"])
            letters = iter(row["letters"])
            state = inserted(state)
            continue
        if waiting == "K" and state == START and row["role"][:1] == "s":
            apply(START, row["text"], row["role"])
            state = SYSTEM
        elif waiting == "K":
            state = apply(state, row["text"], row["role"])
        elif waiting == "R":
            state = apply(state, row["text"])
        state = inserted(state)
    if conv is not None:
        yield result()


def repaired(rows: DataFrame, found: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv, audit, repaired_sha256) from ``judged`` rows and ``edits``."""
    texts = rows.select(
        CONV, "pos", F.lit(1).alias("kind"), "role", "text", F.lit(None).cast("string").alias("letters")
    )
    heads = found.select(
        CONV,
        (F.col("block") * block_rows).alias("pos"),
        F.lit(0).alias("kind"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"),
        "letters",
    )
    return _map(
        _in_order(texts.unionByName(heads), "pos", "kind"),
        _repaired,
        f"{CONV} string, audit string, repaired_sha256 string",
    )


def repair_report(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired text of every damaged conversation."""
    rows = judged(damage(conversations))
    n = 2 * conversations.count()  # damage doubles a row at most
    codes = settle(few_files(coded(rows), n), "repair-codes")
    found = settle(few_files(edits(codes, block_rows), n), "repair-edits")
    sums = found.groupBy(CONV).agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    result = (
        conversations.select(conversation_key())
        .distinct()
        .join(counted(codes), CONV, "left")
        .join(sums, CONV, "left")
        .join(repaired(rows, found, block_rows), CONV, "left")
    )
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return result.select(
        F.when(F.col(CONV) != "", F.col(CONV)).cast("bigint").alias("conv_id"),
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
