"""Plain versions of the conversation operators, for the tests."""

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def in_order(rows):
    """(turn, role, text) rows by turn, null first, then role and text."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def cheapest(codes):
    """(cost, audit) of the repair of row codes, by dynamic programming over whole strings."""
    follow = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {s: (0, "") if s in (0, 3) else None for s in range(4)}

    def with_inserts(best):
        for _ in range(3):
            for s in range(4):
                if best[follow[s]]:
                    cost, letters = best[follow[s]]
                    best[s] = min(x for x in (best[s], (cost + 5, "I" + letters)) if x)
        return best

    best = with_inserts(best)
    for first, fault in reversed(codes):
        new = {}
        for s in range(4):
            found = [(2, "D", s)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if s == 0 and first == "s":
                    found.append((more, "K", 1))
                if first == ("a" if s == 2 else "u"):
                    found.append((more, "K", follow[s]))
                found.append((1 + more, "R", follow[s]))
            new[s] = min((c + best[t][0], x + best[t][1]) for c, x, t in found)
        best = with_inserts(new)
    return best[0]


def repair_report(rows):
    """The rows of op12 for (conv_id, turn, role, text) rows."""
    kept, ids = defaultdict(list), set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(name.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        kept[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    result = []
    for conv in ids:
        mine, seen, codes = in_order(kept[conv]), set(), []
        for _, role, text in mine:
            words = WORD.findall(text)
            fault = (
                "blank" if not words
                else "duplicate" if (role, text) in seen
                else "truncated" if words[-1][-1] not in ".!?"
                else ""
            )
            seen.add((role, text))
            codes.append((role[:1], fault))
        turns = {t for t, *_ in mine if t is not None}
        cost, audit = cheapest(codes)
        out, left = [], iter(mine)
        for letter in audit:
            wanted = "assistant" if out and out[-1][0][:1] == "u" else "user"
            if letter == "I":
                out.append((wanted, ""))
            else:
                _, role, text = next(left)
                if letter != "D":
                    out.append((role if letter == "K" else wanted, text))
        firsts = [f for f, _ in codes]
        faults = [f for _, f in codes]
        result.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False)),
                cost,
                audit,
                hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
            )
        )
    return result


def prefix_trie(rows):
    """The rows of op13 for (conv_id, turn, role, text) rows."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn, role or "", text or ""))
    own = {c: [(r, t) for _, r, t in in_order(x)] for c, x in turns.items()}
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt[c] = (*own.get(base, [])[:h], *mine[h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for seq in members:
        if seq:
            children[seq[:-1]].append(seq)
    leaves, saved = {}, {}
    for seq in sorted(members, key=len, reverse=True):
        words = len(WORD.findall(seq[-1][1])) if seq else 0
        leaves[seq] = sum(leaves[x] for x in children[seq]) or 1
        saved[seq] = (len(members[seq]) - 1) * words + sum(saved[x] for x in children[seq])
    result = []
    for seq, all_of in members.items():
        ends = ",".join(map(str, sorted(c for c in all_of if len(rebuilt[c]) == len(seq))))
        result.append(
            (
                min(all_of),
                len(seq),
                min(members[seq[:-1]]) if seq else None,
                len(all_of),
                len(children[seq]),
                leaves[seq],
                saved[seq],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return result
