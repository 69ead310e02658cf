"""Archives, conversation repair and the prefix trie: hand-made input, every block and lot size."""

import base64
import gzip
import hashlib
import random

import brute_turns
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotegrid.llm import repair, trie, warc
from quotegrid.session import work_dir

PAGES = "page_id long, url string, html string"
TURNS = "conv_id long, turn long, role string, text string"
BIG = "x" * 700_000 + "\r\n\r\nWARC/1.1\r\n" + "é" * 100

ODD_PAGES = [
    (1, "u", "aa"),
    (2, "u", "aa"),
    (2, "u", "aa"),
    (2, "v", "aa"),
    (None, "w", "bb"),
    (None, "w", "bb"),
    (3, None, None),
    (4, "a b%c\r\né", ""),
    (5, "u", BIG),
    (6, "u", BIG),
    (None, None, "aa"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected_records(pages, least=0):
    out, top = [], {}
    for page_id, _, html in pages:
        key = html or ""
        if top.get(key) is None:
            top[key] = page_id
        elif page_id is not None:
            top[key] = max(top[key], page_id)
    done = set()
    for page_id, _, html in pages:
        key = html or ""
        size = len(key.encode())
        responds = size < least or (page_id == top[key] and key not in done)
        done |= {key} if responds else set()
        kind = "response" if responds else "revisit"
        out.append((page_id, size, digest(html), kind, None if responds else top[key]))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 2, 3])
def test_page_records(spark, least):
    pages = spark.createDataFrame(ODD_PAGES, PAGES).withColumn("record_id", F.lit("clash"))
    got = sorted((tuple(r) for r in warc.page_records(pages, least).collect()), key=str)
    assert got == expected_records(ODD_PAGES, least)
    assert warc.page_records(pages.limit(0)).count() == 0


def test_many_copies(spark, monkeypatch):
    monkeypatch.setattr(warc, "COPIES_PER_BLOCK", 7)
    pages = [(9, "u", "same")] * 40 + [(i, None, "same") for i in range(9)]
    got = warc.page_records(spark.createDataFrame(pages, PAGES)).collect()
    assert sorted(map(tuple, got), key=str) == expected_records(pages)


def test_archives_are_chunked_and_whole(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1)
    pages = spark.createDataFrame(ODD_PAGES, PAGES)
    folder = work_dir(spark, "warc-test")
    chunks = warc.chunk_table(pages, chunk_bytes=1_000)
    assert chunks.agg(F.max(F.length("data"))).first()[0] == 1_000
    manifest = warc.write_archives(chunks, folder, archive_bytes=1, date="2026-01-01T00:00:00Z")
    assert manifest.agg(F.sum("n_records")).first()[0] == len(ODD_PAGES)
    assert warc.archives_in(spark, folder).count() == manifest.count() > 3
    read = warc.read_archives(manifest, chunk_bytes=999)
    rows = read.filter("page_id = 6 AND record_type = 'response'").orderBy("chunk_no").collect()
    sha, at = hashlib.sha1(), 0
    for k, row in enumerate(rows):
        sha.update(row.data)
        assert (row.chunk_no, row.offset, row.n_bytes) == (k, at, len(row.data))
        assert row.digest_so_far == base64.b32encode(sha.digest()).decode()
        at += row.n_bytes
    assert b"".join(r.data for r in rows) == BIG.encode() and rows[-1].last
    target = read.filter("page_id = 4 AND last").first()
    assert target.url == "a b%c\r\né"
    refers = {r.refers_to_record for r in read.filter("record_type = 'revisit'").collect()}
    assert refers <= {r.record_id for r in read.filter("record_type = 'response'").collect()}


def test_foreign_archives(tmp_path):
    """Plain and gzipped archives of other writers, and broken ones."""
    body = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nhello"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\n"
    record += b"Content-Type: application/http\r\n"
    record += f"Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    meta = b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    for data in (record + meta, gzip.compress(record) + gzip.compress(meta), gzip.compress(record + meta)):
        rows = list(warc.records(pa.BufferReader(data), 2))
        assert [r["data"] for r in rows] == [b"he", b"ll", b"o", b""]
        assert rows[2]["digest_so_far"] == digest("hello") and rows[2]["last"]
    for broken in (record[:-8], gzip.compress(record)[:-20], b"nothing\r\n", record.replace(b"hello", b"hel")):
        with pytest.raises(ValueError):
            list(warc.records(pa.BufferReader(broken), 2))
    wrong = record.replace(b"<urn:x:1>\r\n", b"<urn:x:1>\r\nWARC-Payload-Digest: sha1:AAAA\r\n")
    with pytest.raises(ValueError, match="another digest"):
        list(warc.records(pa.BufferReader(wrong), 2))


def random_codes(rng, n):
    faults = ["", "", "", "blank", "duplicate", "truncated"]
    return [(rng.choice("suaaux"), rng.choice(faults)) for _ in range(n)]


def as_text(codes):
    out = ""
    for first, fault in codes:
        letter = first if first in "sua" else "x"
        gone = fault in ("blank", "duplicate")
        out += repair.GONE if gone else letter.upper() if fault == "truncated" else letter
    return out


def test_auction_equals_dynamic_programming():
    rng = random.Random(3)
    for n in [*range(14)] * 60 + [300]:
        codes = random_codes(rng, n)
        assert repair.repair(as_text(codes)) == brute_turns.cheapest(codes)


def test_prices_are_feasible_and_tight():
    """After the auction no arc is cheaper than the prices say, and the path's arcs are tight."""
    rng = random.Random(4)
    for _ in range(50):
        lattice = repair.Lattice(as_text(random_codes(rng, 9)), repair.WHOLE, True)
        lattice.distance(repair.START)
        for node, arcs in enumerate(lattice.arcs):
            assert all(lattice.price[node] <= cost + lattice.price[j] for _, cost, j in arcs)


ODD_TURNS = [
    (None, None, None, None),
    (None, 1, "user", "a."),
    (1, None, "zed", "q"),
    (1, None, "user", "b."),
    (1, 2, "user", "b."),
    (1, 2, "user", "b."),
    (1, 5, None, "  "),
    (2, 0, "system", "s."),
    (2, 1, "assistant", ""),
    (-5, 1, "assistant", "very " * 30_000),
    (0, 1, None, "x y."),
    *[(7, i, "user" if i % 3 else "assistant", f"t{i % 50}{'.' if i % 7 else ''}") for i in range(400)],
]


@pytest.mark.parametrize("block_rows", [1, 5, 64])
def test_repair_of_odd_conversations(spark, block_rows):
    rows = spark.createDataFrame(ODD_TURNS, TURNS).withColumns(
        {c: F.lit("clash") for c in ("conv", "pos", "code", "block")}
    )
    got = sorted((tuple(r) for r in repair.repair_report(rows, block_rows).collect()), key=str)
    assert got == sorted(brute_turns.repair_report(ODD_TURNS), key=str)
    assert repair.repair_report(rows.limit(0)).count() == 0


@pytest.mark.parametrize(("lot_turns", "fan_in"), [(100_000, 64), (5, 2), (40, 3)])
def test_trie_of_odd_conversations(spark, lot_turns, fan_in):
    rng = random.Random(5)
    more = [
        (c, i, "user", rng.choice(["a b", "c", "d e f"]))
        for c in range(20, 140)
        for i in range(rng.randint(1, 4))
    ]
    copies = [(c, i, "user", "same text") for c in range(200, 300) for i in range(3)]
    rows = [*ODD_TURNS, *more, *copies]
    df = spark.createDataFrame(rows, TURNS).withColumns(
        {c: F.lit("clash") for c in ("conv", "pos", "key", "id", "place")}
    )
    got = sorted((tuple(r) for r in trie.prefix_trie(df, lot_turns, fan_in).collect()), key=str)
    assert got == sorted(brute_turns.prefix_trie(rows), key=str)
    assert trie.prefix_trie(df.limit(0)).count() == 0


def test_lots_give_the_same_forest():
    """Cut anywhere and merged again, a forest has the nodes of the uncut one."""
    rng = random.Random(6)
    signs = [hashlib.md5(bytes([k])).digest() + (k + 1).to_bytes(4, "big") for k in range(3)]
    for _ in range(200):
        keys = sorted({b"".join(rng.choices(signs, k=rng.randint(0, 5))) for _ in range(12)})
        path = lambda i: trie.Path(keys[i], {len(keys[i]) // trie.SIGN: trie.Record(i + 1, i)})  # noqa: B023,E731
        whole = trie.Forest([path(i) for i in range(len(keys))], True).nodes
        cut = rng.randint(0, len(keys))
        nodes, left = [], []
        for part in (range(cut), range(cut, len(keys))):
            if part:
                forest = trie.Forest([path(i) for i in part], False)
                nodes += forest.nodes
                left += forest.open_paths()
        nodes += trie.Forest(left, True).nodes
        counts = lambda found: sorted((n[0], n[1], n[2], *n[5:]) for n in found)
        assert counts(nodes) == counts(whole)
