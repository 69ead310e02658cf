"""Plain counterparts of the corpus operators, written from their definitions."""

import hashlib
import re
from collections import Counter
from itertools import combinations

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    w = words(lower(text))
    if not w:
        return frozenset()
    k = min(k, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def near_components(rows, k):
    """{row number: (set size, component)} of (doc_id, text) rows with ids; all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 10 * min(len(a), len(b)) >= 8 * max(len(a), len(b)):
            shared = len(a & b)
            if 100 * shared >= 80 * (len(a) + len(b) - shared):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        least[root] = min(least.get(root, doc_id), doc_id)
    return [(d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows)]


def without_repeats(rows, window=35):
    """(doc_id, words, removed, hash of the rest) of (doc_id, text) rows."""
    split = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, split, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        rest = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return out


def nearest(rows, queries, k):
    """[(query, rank, id, distance)] over (id, vector) rows."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = []
    for q in queries:
        d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(1))
        best = sorted((float(a), int(i)) for a, i in zip(d, ids, strict=True) if i != q)[:k]
        out.extend((q, r, i, a) for r, (a, i) in enumerate(best, 1))
    return out


def order_of(doc_id):
    return (doc_id is None, doc_id or 0)


def without_aligned_blocks(rows, block_words=8):
    """(lines, removed lines, rest) per (doc_id, text) row; ids are distinct.

    Every later document is held against every earlier one with a line of it, by the plain table
    of how many lines up to here and there agree.
    """
    blanks = " \t\n\x0b\x0c\r"
    split = {d: (t or "").split("\n") for d, t in rows}
    keys = {d: [x.strip(blanks) if words(x) else "" for x in ls] for d, ls in split.items()}
    holders, first_copy, out = {}, {}, {}
    for d in sorted(split, key=order_of):
        key, n = keys[d], len(keys[d])
        if any(key) and tuple(key) in first_copy:
            out[d] = (n, n, "")
            continue
        first_copy[tuple(key)] = d
        size, gone = [len(words(x)) for x in key], set()
        for other in {o for x in key for o in holders.get(x, ())}:
            theirs, above = keys[other], {}
            for line in theirs:
                agree = {}
                for j in range(n):
                    if key[j] == line:
                        agree[j] = above.get(j - 1, 0) + 1
                        if sum(size[j - agree[j] + 1 : j + 1]) >= block_words:
                            gone.update(range(j - agree[j] + 1, j + 1))
                above = agree
        for line in set(key):
            holders.setdefault(line, set()).add(d)
        out[d] = (n, len(gone), "\n".join(x for j, x in enumerate(split[d]) if j not in gone))
    return out


def without_common_runs(rows, block_words=8):
    """(lines, removed lines, rest) per (doc_id, text) row; ids are distinct.

    A line goes if it lies in a run of neighbouring lines, of ``block_words`` words at least, that
    stands in an earlier document which is no copy. Every run of every document is looked at, up
    to the first that is long enough from each start, and to each end.
    """
    blanks = " \t\n\x0b\x0c\r"
    split = {d: (t or "").split("\n") for d, t in rows}
    keys = {d: [x.strip(blanks) if words(x) else "" for x in ls] for d, ls in split.items()}
    seen, copies, out = set(), set(), {}
    for d in sorted(split, key=order_of):
        key, n = keys[d], len(keys[d])
        if any(key) and tuple(key) in copies:
            out[d] = (n, n, "")
            continue
        copies.add(tuple(key))
        size = [len(words(x)) for x in key]
        spans = set()
        for i in range(n):
            ends = (j for j in range(i + 1, n + 1) if sum(size[i:j]) >= block_words)
            starts = (j for j in range(i, -1, -1) if sum(size[j : i + 1]) >= block_words)
            spans |= {(i, j) for j in [next(ends, None)] if j is not None}
            spans |= {(j, i + 1) for j in [next(starts, None)] if j is not None}
        gone = {k for i, j in spans if tuple(key[i:j]) in seen for k in range(i, j)}
        seen |= {tuple(key[i:j]) for i, j in spans}
        out[d] = (n, len(gone), "\n".join(x for j, x in enumerate(split[d]) if j not in gone))
    return out


def mixed(rows, weights=(3, 1, 2), share=1.5, passes=2, seed="mix-1"):
    """Passes of each (doc_id, size, source, text) row of a weighted fair queue; ids are distinct."""
    sizes = Counter()
    for _, size, source, _ in rows:
        sizes[source] += size
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    queue = {}
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    place = lambda d, text: md5(f"{seed}:{d}:{md5(text or '')}:0")
    finish = []
    for d, size, source, _ in sorted(rows, key=lambda r: place(r[0], r[3])):
        queue[source] = queue.get(source, 0) + size
        for turn in range(passes):
            played = turn * sizes[source] + queue[source]
            finish.append((played / weight[source], names.index(source), size, d))
    left, taken = share * sum(sizes.values()), Counter()
    for _, _, size, d in sorted(finish):
        if size > left:
            break
        left -= size
        taken[d] += 1
    return taken
