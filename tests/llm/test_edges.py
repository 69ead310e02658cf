"""Null, empty, very long, tied, repeated and oddly named input for every operator and stage."""

import zlib

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from quotegrid.llm import (
    language,
    lines,
    mixing,
    neardup,
    pieces,
    quality,
    substrings,
    tokens,
    toxicity,
    vectors,
)
from quotegrid.llm.common import is_held_out, stable, words_of


def by_doc(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=str)


@pytest.fixture
def empty(documents, spark):
    return spark.createDataFrame([], documents((1, "x")).schema)


def test_words_are_those_of_the_rule(documents):
    texts = ["a b c", "\x1cq\x1d r", "  x\ty\nz\x0b\x0c\rw ", "", None, "é ü"]
    df = documents(*enumerate(texts))
    from quotegrid.llm.common import text_of

    got = {r.doc_id: r.w for r in df.select("doc_id", words_of(text_of()).alias("w")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute.words(text)
        assert (text or "").encode().split() == [w.encode() for w in brute.words(text)]


def test_quality(odd, empty):
    df, rows = odd
    got = quality.adaptive_filter(df).collect()
    expected = [(d, len(brute.words(t))) for d, t, *_ in rows]
    assert by_doc(got, "doc_id", "n_words") == sorted(expected, key=str)
    assert all(r.base_failed == (r.n_words < 50) for r in got)
    assert not any(r.kept for r in got if r.base_failed)
    assert next(r for r in got if r.doc_id == 8).kept
    assert quality.adaptive_filter(empty).count() == 0


def test_quality_drops_the_odd_one_out(documents):
    text = lambda i: " ".join(f"word{(i * 7 + k * k) % 9973}" for k in range(80))
    rows = [(i, text(i), "en", "a") for i in range(60)]
    rows.append((99, " ".join(f"%%{i}$$" for i in range(80)), "en", "a"))
    got = {r.doc_id: r.kept for r in quality.adaptive_filter(documents(*rows)).collect()}
    assert not got.pop(99) and all(got.values())


def test_sketch_bucket_bounds(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 100_000, 37).withColumn("b", quality.bucket(F.col("id")))
    assert df.filter("b > id OR b < id * (1 - 1 / 64.0)").count() == 0
    assert df.select("b").distinct().count() < 64 * 12


def test_mixing(odd, empty):
    df, rows = odd
    got = mixing.mix(df).collect()
    sizes = [(d, len(brute.words(t))) for d, t, *_ in rows]
    assert by_doc(got, "doc_id", "size") == sorted(sizes, key=str)
    total = sum(n for _, n in sizes)
    assert sum(r.taken for r in got) <= 1.5 * total
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    assert {r.source for r in got} == {"a", "b", None}
    assert mixing.mix(empty).count() == 0
    played = mixing.mixed_documents(df)
    assert played.columns == df.columns
    assert played.count() == sum(r.passes for r in got)
    assert mixing.mixed_documents(empty).count() == 0


def test_mixing_meets_targets_and_reruns_agree(documents):
    rows = [(i, " ".join(["w"] * (5 + i % 20)), "en", f"s{i % 4}") for i in range(2_000)]
    df = documents(*rows)
    got = mixing.mix(df).collect()
    goal, taken, size = {}, {}, {}
    for r in got:
        goal[r.source] = r.target
        taken[r.source] = taken.get(r.source, 0) + r.taken
        size[r.source] = r.source_size
    for s, target in goal.items():
        assert target <= 2 * size[s] + 1e-6
        assert abs(taken[s] - target) <= 30
    assert sum(goal.values()) == pytest.approx(1.5 * sum(size.values()))
    again = mixing.mix(df.repartition(3)).collect()
    assert by_doc(got, "doc_id", "taken") == by_doc(again, "doc_id", "taken")


def test_tokens(odd, empty):
    df, rows = odd
    got = tokens.token_files(df).collect()
    library = tokens.WordEncoder(tokens.default_vocabulary()).tokenizer
    expected = []
    for d, t, *_ in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((d, len(ids), zlib.crc32(ids.tobytes())))
    assert by_doc(got, "doc_id", "n_tokens", "ids_crc32") == sorted(expected, key=str)
    ordered = sorted(got, key=lambda r: r.start)
    assert ordered[0].doc_id is None and ordered[0].start == 0
    known = [r.doc_id for r in ordered if r.doc_id is not None]
    assert known == sorted(known)
    for a, b in zip(ordered, ordered[1:], strict=False):
        assert b.start == a.start + a.n_tokens
    assert tokens.token_files(empty).count() == 0


def test_token_words_equal_whole_texts():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    codec = tokens.WordEncoder(tokens.default_vocabulary())
    parts = [*"aZwW09.,'!-—é \n\t\x1c\x85 ", "\u030a", "\u0338", "<|endoftext|>", "<|ENDOFTEXT|>"]
    parts += ["'s", "'LL", "word", "Word.", "x, y", "été", "ñandú$$$ ", "größe", "ŉ", "Œuf", "É,", "Éa!?", "ÀÇ×÷", "ǅ", "Ɓ", "<|", "ẞ", "İx", "ſ", "œuf", "ª", "a&&& ", "ΣΣ", "İ", "ﬁ", "日本", "<", "="]

    @settings(max_examples=1_500, deadline=None)
    @given(st.lists(st.sampled_from(parts), max_size=30).map("".join))
    def same(text):
        whole = codec.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(codec.encode(text.encode(), None), "<u4").tolist() == whole

    same()


def test_token_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_CACHED_WORDS", 10)
    codec = tokens.WordEncoder(tokens.default_vocabulary())
    for i in range(30):
        text = " ".join(f"word{(i + k) % 40}" for k in range(12))
        whole = codec.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(codec.encode(text.encode(), None), "<u4").tolist() == whole
        assert len(codec.known) < 40


def test_shard_gives_single_documents():
    ids = [np.arange(n, dtype="<u4").tobytes() for n in (0, 3, 500)]
    import zstandard

    press = zstandard.ZstdCompressor()
    shard = tokens.pack([press.compress(i) for i in ids], [0, 3, 500], [5, None, 7], bytes(32))
    for k, data in enumerate(ids):
        assert tokens.read_document(shard, k, b"").tobytes() == data
    assert tokens.read_index(shard, bytes(32))[2] == [5, None, 7]
    with pytest.raises(ValueError):
        tokens.read_index(shard, b"x" * 32)


def test_substrings(odd, empty):
    df, rows = odd
    got = substrings.digest(df).collect()
    expected = brute.without_repeats([(d, t) for d, t, *_ in rows])
    assert by_doc(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(expected, key=str)
    assert sum(r.n_removed for r in got if r.doc_id in (8, 9)) == 100
    assert substrings.digest(empty).count() == 0


def test_substrings_inside_one_document_and_across(documents):
    run = " ".join(f"r{i}" for i in range(40))
    texts = [
        f"{run} between {run}",
        " ".join(["same"] * 120),
        " ".join(["ab", "cd"] * 50),
        f"left {' '.join(run.split()[:36])} right",
        " ".join(f"u{i}" for i in range(34)),
        " ".join(f"u{i}" for i in range(34)),
        " ".join(["same"] * 34),
        " ".join(["same"] * 35),
    ]
    rows = list(enumerate(texts))
    got = substrings.digest(documents(*rows)).collect()
    assert by_doc(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        brute.without_repeats(rows), key=str
    )


def test_factors(documents):
    words = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"a b {words} c"), (2, f"{words} d e f")]
    got = {r.doc_id: r for r in substrings.remove_repeats(documents(*rows)).collect()}
    assert [tuple(f) for f in got[1].factors] == [(2, 60)] and got[1].kept == "a b c"
    assert [tuple(f) for f in got[2].factors] == [(0, 60)] and got[2].kept == "d e f"


def test_near_duplicates(odd, empty):
    df, rows = odd
    got = neardup.near_duplicates(df, 4).collect()
    assert len(got) == len(rows)
    sizes = [(d, len(brute.shingles(t, 4))) for d, t, *_ in rows]
    assert by_doc(got, "doc_id", "n_shingles") == sorted(sizes, key=str)
    base = [r for r in got if r.n_shingles == 9 and r.doc_id in (1, 2, None)]
    assert {r.component_id for r in base} == {1}
    assert {r.component_id for r in got if r.doc_id in (4, 5)} == {4, 5}
    kept = neardup.one_of_each(df)
    assert kept.columns == df.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count(rows[0][1]) == 1
    assert sum(t is None for t in texts) == 2
    assert neardup.near_duplicates(empty).count() == 0
    assert neardup.one_of_each(empty).count() == 0


def test_near_duplicates_of_chains(documents):
    rng = np.random.default_rng(3)
    rows = []
    for group in range(12):
        words = [f"g{group}w{i}" for i in rng.integers(0, 500, 120)]
        for _ in range(12):
            rows.append((len(rows) * 7 % 1009, " ".join(words)))
            words[rng.integers(0, 120)] = f"new{len(rows)}"
            if rng.random() < 0.5:
                words[rng.integers(0, 120)] = f"more{len(rows)}"
    got = neardup.near_duplicates(documents(*rows), 4).collect()
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    assert by_doc(got, *columns) == sorted(brute.near_components(rows, 4), key=str)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 2**63, 800).astype(np.uint64)
    errors = []
    for part in (0.5, 0.8, 0.9):
        cut = int(len(shared) * part)
        other = np.concatenate([shared[:cut], rng.integers(0, 2**63, 800 - cut).astype(np.uint64)])
        a, b = neardup.signatures([shared, other])
        errors.append((a == b).mean() - cut / (2 * len(shared) - cut))
    assert np.abs(errors).max() < 0.12
    for n in (1, 2, 5, 30):
        few = neardup.signatures([shared[:n], shared[:n], shared])
        assert (few[0] == few[1]).all() and (few != neardup._EMPTY).all()


def test_components_of_paths_and_stars(spark):
    from quotegrid.llm.components import components

    name = lambda i: f"{i:05d}".encode()
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(200)]
    edges += [(5000, 5000), (6001, 6000), (6000, 6001)]
    df = spark.createDataFrame([(name(a), name(b)) for a, b in edges], "u binary, v binary")
    got = {bytes(r.node): bytes(r.component) for r in components(df.repartition(6)).collect()}
    assert all(got[name(i)] == name(0) for i in range(301))
    assert all(got[name(1000 + i)] == name(1000) for i in range(200))
    assert got[name(6001)] == name(6000)
    assert components(df.limit(0)).count() == 0


def test_lines(odd, empty):
    df, rows = odd
    got = lines.dedup_lines(df).collect()
    assert sorted(str(r.row.doc_id) for r in got) == sorted(str(d) for d, *_ in rows)
    assert all(set(r.row.asDict()) == set(df.columns) for r in got)
    same = [r for r in got if r.row.text == rows[0][1]]
    assert sorted(r.n_removed for r in same) == [0, 1, 1, 1]
    assert {r.row.doc_id for r in same if r.n_removed == 0} == {1}
    assert lines.dedup_lines(empty).count() == 0


def test_lines_of_overlapping_documents(documents):
    block = [f"line {i} of the block that both of them share" for i in range(4)]
    footer = "the common footer of every single page"
    rows = [
        (1, "\n".join(["first own opening line", *block, "first closing line", footer])),
        (2, "\n".join(["second opening", block[0], "", *block[1:], "second end", footer])),
        (3, f"third page on its own\n{footer}"),
    ]
    rows += [(10 + i, f"page {i} says something new {i * i}\n{footer}") for i in range(80)]
    got = {r.row.doc_id: r for r in lines.dedup_lines(documents(*rows)).collect()}
    assert got[1].n_removed == 0
    # The blank line stays between two blocks, the footer is too short for a block.
    assert got[2].kept == f"second opening\n\nsecond end\n{footer}" and got[2].n_removed == 4
    # A frequent line alone links nothing.
    assert all(got[i].n_removed == 0 for i in (3, *range(10, 90)))


def test_long_line_of_many_documents_goes(documents):
    """One 60-word line in several hundred documents: all but the first lose it."""
    hot = " ".join(f"hot{i}" for i in range(60))
    rows = [(i, f"page {i} opens\n{hot}\nand page {i} ends") for i in range(300)]
    got = {r.row.doc_id: r for r in lines.dedup_lines(documents(*rows)).collect()}
    expected = brute.without_common_runs(rows)
    assert {d: (r.n_lines, r.n_removed, r.kept) for d, r in got.items()} == expected
    assert got[0].n_removed == 0 and all(got[i].n_removed == 1 for i in range(1, 300))


def test_lines_first_used_one_by_one(documents):
    """A passage goes though each of its lines, or a part of it, has another first holder."""
    a, b = "five short words of a", "and five more of b"
    head, long = "a frequent heading of six words", "one long line of nine words that all share"
    rows = [(1, f"{a}\nsome own words"), (2, f"{b}\nsome other words")]
    rows += [(3, f"{a}\n{b}\nthird"), (4, f"fourth\n{a}\n{b}"), (5, f"fifth\n{a}\n\n{b}")]
    rows += [(6, f"{long}\nsix"), (7, f"{long}\nand a tail\nseven"), (8, f"{long}\nand a tail")]
    rows += [(20 + i, f"{head}\nown words of {i}") for i in range(70)]
    rows += [(100, f"{head}\nnew passage"), (101, f"{head}\nnew passage\nmore")]
    got = {r.row.doc_id: r for r in lines.dedup_lines(documents(*rows)).collect()}
    expected = brute.without_common_runs(rows)
    assert {d: (r.n_lines, r.n_removed, r.kept) for d, r in got.items()} == expected
    assert (got[4].kept, got[5].n_removed, got[8].kept) == ("fourth", 0, "")
    assert (got[7].n_removed, got[101].kept) == (1, "more")


def test_every_common_block_goes():
    """Copies of a block on either side and crossed blocks; then random lines, by all runs."""
    assert lines.common_blocks([1, 2], [1, 2, 9, 1, 2], [4, 4, 1, 4, 4]) == [(0, 2), (3, 2)]
    assert lines.common_blocks([1, 2, 8, 1, 2], [9, 1, 2, 7], [1, 4, 4, 1]) == [(1, 2)]
    assert lines.common_blocks([1, 2, 3, 4], [3, 4, 1, 2], [4, 4, 4, 4]) == [(0, 4)]
    rng = np.random.default_rng(3)
    for _ in range(300):
        size = dict(enumerate([0, *rng.integers(1, 10, 7).tolist()]))
        a, b = (rng.integers(0, 8, rng.integers(0, 14)).tolist() for _ in range(2))
        held = {tuple(a[i:j]) for j in range(len(a) + 1) for i in range(j)}
        gone = set()
        for i in range(len(b)):
            for j in range(i + 1, len(b) + 1):
                if tuple(b[i:j]) in held and sum(size[x] for x in b[i:j]) >= 8:
                    gone.update(range(i, j))
        got = lines.common_blocks(a, b, [size[x] for x in b])
        assert {k for j, n in got for k in range(j, j + n)} == gone


def test_lines_equal_brute_force_of_runs(documents):
    rng = np.random.default_rng(4)
    stock = ["", " ", *(" ".join(f"s{i}w{k}" for k in range(1 + i % 9)) for i in range(30))]
    rows = [
        (d, "\n".join(stock[k] for k in rng.integers(0, len(stock), rng.integers(1, 25))))
        for d in range(200)
    ]
    p, q = ("\n".join(f"{x} line {i} of a passage" for i in range(4)) for x in "pq")
    rows += [(300, f"{p}\nx\n{q}"), (301, f"{q}\ny\n{p}"), (302, f"{p}\nz\n{p}\nz z")]
    got = {r.row.doc_id: r for r in lines.dedup_lines(documents(*rows)).collect()}
    expected = brute.without_common_runs(rows)
    assert {d: (r.n_lines, r.n_removed, r.kept) for d, r in got.items()} == expected
    assert (got[301].kept, got[302].kept) == ("y", "z\nz z")


def test_blocks_come_from_the_alignment(documents, monkeypatch):
    """Without alignment nothing goes; what goes stands in the earlier document as aligned."""
    a, b = [1, 2, 8, 1, 2, 3], [3, 1, 2, 9, 1, 2, 8, 1, 2]
    size = [5] * len(b)
    pairs = lines.patience(a, b, size)
    assert pairs == sorted(pairs) and all(a[i] == b[j] for i, j in pairs)
    assert lines.common_blocks(a, b, size) == [(1, 2), (4, 5)]
    monkeypatch.setattr(lines, "patience", lambda *_: [])
    assert lines.common_blocks(a, b, size) == []


def test_gap_without_single_lines():
    """Where no line is single on both sides, the widest common run is matched."""
    assert lines.patience([1, 2, 1, 2, 5], [9, 1, 2, 1, 2, 9, 1]) == [(0, 1), (1, 2), (2, 3), (3, 4)]
    assert lines.patience([1, 1, 4], [4, 4, 1, 1], [8] * 4)[-1] == (1, 3)
    assert lines.patience([1, 1, 4], [4, 4, 1, 1], [1] * 4) == []


def test_patience():
    assert lines.patience([1, 2, 3, 4], [9, 2, 3, 8, 4]) == [(1, 1), (2, 2), (3, 4)]
    assert lines.patience([1, 1, 2], [1, 1, 2]) == [(0, 0), (1, 1), (2, 2)]
    assert lines.patience([], [1]) == []
    assert lines.patience([1, 2, 3], [3, 1, 2]) == [(0, 1), (1, 2)]
    assert lines.common_blocks([5, 6], [5, 6, 7], [1, 2, 9]) == []
    assert lines.common_blocks([5, 6], [5, 6, 7], [4, 4, 9]) == [(0, 2)]


def test_pieces(odd, empty):
    df, rows = odd
    got = pieces.summarise_documents(df).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    assert {r.n_pieces for r in got if r.doc_id in (3, 4)} == {0}
    assert pieces.summarise_documents(empty).count() == 0
    out = pieces.encode_documents(df).withColumn("back", pieces.decoded("pieces")).collect()
    assert all(r.back == (r.text or "") for r in out)


def test_pieces_equal_library_on_odd_texts():
    import sentencepiece
    from hypothesis import given, settings
    from hypothesis import strategies as st

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    machine = pieces.transducer()
    letters = st.sampled_from(list(" ▁abtheinroas\n\t.,'129éß日本語🙂\x01") + ["  ", "    ", "ing"])

    @settings(max_examples=400, deadline=None)
    @given(st.lists(letters, max_size=60).map("".join))
    def same(text):
        ids = machine.encode(text).tolist()
        assert ids == library.encode(text)
        assert machine.decode(ids) == library.decode(ids)

    same()
    for text in ("x" * 5_000, "aaaa " * 300, " " * 70):
        assert machine.encode(text).tolist() == library.encode(text)


def test_pair_constraint_equals_merging():
    machine = pieces.transducer()
    plain = [p for p in machine.lexicon if p not in machine.tied][:4_000]
    rng = np.random.default_rng(2)
    for a, b in rng.choice(plain, (5_000, 2)):
        made = all(len(x) == 1 or machine._split(x) for x in (a, b))
        if made:
            assert machine._uncrossed(a, b) == (machine.merged(a + b)[0] == [a, b])


def test_toxicity(odd, empty, labels, documents):
    df, rows = odd
    judged = toxicity.judge(df, labels((1, 0), (2, 1), (None, 1), (77, None))).collect()
    assert len(judged) == len(rows) and all(0 <= r.toxicity <= 1 for r in judged)
    assert toxicity.judge(df, labels()).count() == len(rows)
    assert toxicity.judge(empty, labels((1, 1))).count() == 0


def test_toxicity_learns_words_and_pairs(documents, labels):
    rng = np.random.default_rng(4)
    filler = [f"filler{i}" for i in range(200)]
    rows, truth = [], []
    for i in range(1_200):
        kind = i % 4
        extra = [["bellend"], ["mountain"], ["bellend", "mountain"], []][kind]
        words = [*rng.choice(filler, 20), *extra]
        rows.append((i, " ".join(rng.permutation(words))))
        truth.append((i, int(kind == 2)))
    got = toxicity.judge(documents(*rows), labels(*truth)).collect()
    score = {r.row.doc_id: r.toxicity for r in got}
    held = [i for i, _ in truth if is_held_out(i)]
    # Either word alone is harmless: only their interaction tells.
    right = sum((score[i] >= 0.5) == (i % 4 == 2) for i in held)
    assert right >= 0.95 * len(held)


def test_language(odd, empty, documents):
    df, rows = odd
    got = language.identify(df).collect()
    assert len(got) == len(rows)
    silent = [r for r in got if not any(c.isalpha() for c in r.text or "")]
    assert len(silent) == 5
    assert all(r.lang_pred == "und" and r.score == 0 for r in silent)
    assert all(r.lang_pred in ("en", "fr") for r in got if r not in silent)
    assert language.identify(empty).count() == 0
    nothing = documents((1, "some words"), (2, None))
    assert {r.lang_pred for r in language.identify(nothing).collect()} == {"und"}


def test_code_switched_words():
    texts = [("a", " ".join(f"zor{x}ik" for x in "abcdefgh")), ("b", " ".join(f"qu{x}en" for x in "abcdefgh"))]
    field = language.train_field(texts * 3)
    got = language.label_words(field, "Zoraik zorbik zorcik quaen quben qucen zorhik zorgik")
    assert "".join(lang for _, lang in got) == "aaabbbaa"


def test_language_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(language, "MAX_CACHED_WORDS", 5)
    monkeypatch.setattr(language, "CHUNK_WORDS", 10)
    field = language.train_field([("a", "zorik zorak"), ("b", "quen quan")])
    texts = [" ".join(f"zor{i}{k}ik" for k in range(7)) for i in "abcdefghij"] + ["", "quaen"]
    alone = [next(language.Labeller(field).marginals([t]), (0, None))[1] for t in texts]
    together = dict(language.Labeller(field).marginals(texts))
    assert together.keys() == {*range(10), 11}
    for k, p in together.items():
        assert p == pytest.approx(alone[k], rel=1e-5)


def test_forward_backward_equals_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 4])
    emissions, transitions = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    got = language.forward_backward(emissions, lengths, transitions)
    start = 0
    for n in lengths:
        total = np.zeros((n, 3))
        for path in product(range(3), repeat=int(n)):
            s = sum(emissions[start + t, path[t]] for t in range(n))
            s += sum(transitions[path[t], path[t + 1]] for t in range(n - 1))
            for t in range(n):
                total[t, path[t]] += np.exp(s)
        expected = total / total.sum(1, keepdims=True)
        assert got[start : start + n] == pytest.approx(expected)
        start += n


def test_vectors(spark):
    from pyspark.sql import functions as F

    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, list(rows[5][1])) for i in range(40)]  # copies, more than k
    rows += [(400, list(rows[5][1])), (400, list(rows[7][1]))]
    odd = [
        (None, [1.0] * 8), (500, None), (600, [0.0] * 8), (700, [nan] * 8), (800, [inf] * 8),
        (900, [None, *[1.0] * 7]), (1000, []), (1100, [1.0, 2.0]), (1101, [2.0, 2.0]),
    ]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn(
        "score", F.lit("x")
    )
    got = vectors.search(df, F.col("vec_id") % 100 == 0).collect()
    asked = {r.query_id for r in got}
    assert asked == {0, 100, 200, 300, 400, 1100}
    near = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got}
    assert [near[300, k][0] for k in range(1, 11)] == [5, *range(301, 310)]
    assert near[1100, 1] == (1101, 1.0) and (1100, 2) not in near
    valid = [r for r in rows if r[0] != 400]
    for q, rank, i, d in brute.nearest(rows, [0, 100, 200], 10):
        assert near[q, rank][1] == pytest.approx(d)
        assert near[q, rank][0] == i or i == 400
    assert len(valid) == 340
    assert vectors.search(df.limit(0), F.lit(True)).count() == 0


def test_error_bounds_hold():
    rng = np.random.default_rng(8)
    v, q = rng.normal(size=(500, 64)), rng.normal(size=(40, 64))
    centre = v.mean(0)
    low, high = vectors.bounds(q, centre, *vectors.encode(v, centre))
    true = ((q[:, None] - v[None]) ** 2).sum(2)
    assert ((low <= true) & (true <= high)).mean() > 0.99


def test_pipeline_of_odd_rows(odd, empty, small_dir, spark):
    df, rows = odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, small_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.dtypes == df.dtypes
        assert out.count() > 0
        assert stage(spark, empty, small_dir).count() == 0


def test_line_stage_updates_text_and_drops_emptied(documents, small_dir, spark):
    block = "a long enough line to be called rare\nand a second one of that kind"
    rows = [(1, f"own words\n{block}"), (2, f"{block}\nmore own words"), (3, f"own words\n{block}")]
    got = corpus_pipeline.line_dedup(spark, documents(*rows, (4, ""), (5, None)), small_dir)
    got = {r.doc_id: r for r in got.collect()}
    assert got.keys() == {1, 2, 4, 5}
    assert got[2].text == "more own words" and got[2].n_chars == 14




def group_of(lang, source, ids, text):
    return [(i, text(i), lang, source) for i in ids]


def test_fences_move_with_the_group(documents):
    """What is odd in one group is common in another, and no size of a group switches a rule."""
    plain = lambda i: "\n".join(f"line {i} {k} w{(i * 7 + k * k) % 9973} x{i}y{k}" for k in range(30))
    doubled = lambda i: plain(i).replace("\n", "\nok\n", 14)
    rows = group_of("en", "prose", range(300), plain)
    rows += group_of("en", "prose", [1_000], doubled)
    rows += group_of("fr", "lists", range(2_000, 2_300), doubled)
    rows += group_of("fr", "small", range(3_000, 3_010), plain)
    rows += group_of("fr", "small", [3_100], doubled)
    got = {r.doc_id: r for r in quality.adaptive_filter(documents(*rows)).collect()}
    # 30 % repeated lines: an outlier where neighbours have none, common in the other group.
    assert 1_000 * got[1_000].n_dup_lines // 44 == 295 and not got[1_000].base_failed
    assert not got[1_000].kept and all(got[i].kept for i in range(300))
    assert all(got[i].kept for i in range(2_000, 2_300))
    # A small group leans on its language, which is full of such documents.
    assert got[3_100].kept and got[3_100].own_share < 500 < got[2_000].own_share
    # Without that prior its own documents decide.
    alone = {r.doc_id: r for r in quality.adaptive_filter(documents(*rows), prior=0).collect()}
    assert not alone[3_100].kept and alone[3_100].own_share == 1_000


def check_parse(spark, docs, texts):
    """Every factor stands at its place; greedy, and covering what brute force removes."""
    docs = stable(docs)
    counted, hits = substrings.parse(docs)
    ids = {r.rid: r.doc_id for r in counted.collect()}
    got = substrings._kept(docs, counted, hits).collect()
    assert got
    words = {d: brute.words(t) for d, t in texts}
    expected = {d: n for d, _, n, _ in brute.without_repeats(texts)}
    for row in got:
        own, gone, after = words[ids[row.rid]], set(), -1
        for factor, place in zip(row.factors, row.places, strict=True):
            there = words[ids[place.ref]]
            end = factor.start + factor.length
            assert own[factor.start : end] == there[place.at : place.at + factor.length]
            assert (ids[place.ref], place.at) != (ids[row.rid], factor.start)
            assert factor.length >= substrings.WINDOW and factor.start > after
            after = end - substrings.WINDOW
            gone.update(range(factor.start, end))
        assert len(gone) == row.n_removed == expected[ids[row.rid]]
    return got


@pytest.mark.parametrize("chunk", [1_000_000, 200, 30])
def test_factors_stand_at_their_places(spark, documents, monkeypatch, chunk):
    monkeypatch.setattr(substrings, "CHUNK_WINDOWS", chunk)
    rng = np.random.default_rng(8)
    stock = [" ".join(f"s{i}w{k}" for k in range(20)) for i in range(12)]
    rows = [
        (d, " ".join(stock[k] for k in rng.integers(0, len(stock), rng.integers(2, 9))) + f" end{d}")
        for d in range(60)
    ]
    rows.append((99, " ".join(["loop"] * 90)))
    got = check_parse(spark, documents(*rows), rows)
    # Documents drawn from several others have several factors.
    assert max(len(r.factors) for r in got) > 2


def test_a_factor_is_the_longest_match():
    starts, refs, places = (np.array(x) for x in ([0, 0, 1, 2, 5], [7, 9, 9, 9, 3], [4, 8, 9, 10, 0]))
    w = substrings.WINDOW
    assert substrings.factors_of(starts, refs, places) == [(0, w + 2, 9, 8), (5, w, 3, 0)]
    assert substrings.factors_of(*(np.zeros(0, int),) * 3) == []


def test_toxicity_of_words_that_tell_only_together(documents, labels):
    """Two words that are as frequent in either class: toxic is who has both or neither."""
    rng = np.random.default_rng(5)
    filler = [f"filler{i}" for i in range(60)]
    rows, truth = [], []
    for i in range(1_200):
        extra = [[], ["bellend"], ["mountain"], ["bellend", "mountain"]][i % 4]
        rows.append((i, " ".join(rng.permutation([*rng.choice(filler, 12), *extra]))))
        truth.append((i, int(i % 4 in (0, 3))))
    got = toxicity.judge(documents(*rows), labels(*truth)).collect()
    score = {r.row.doc_id: r.toxicity for r in got}
    held = [i for i, _ in truth if is_held_out(i)]
    right = sum((score[i] >= 0.5) == (i % 4 in (0, 3)) for i in held)
    assert right >= 0.95 * len(held)


def test_score_is_the_formula():
    """Bias, weights and every pair's inner product, by a plain double loop."""
    rng = np.random.default_rng(6)
    m = toxicity.Machine(list(range(9)), 0.3, rng.normal(size=9), rng.normal(size=(9, 3)))
    lists = [np.array(x, np.int64) for x in ([], [2], [0, 3, 8], list(range(9)))]
    for terms, score in zip(lists, m.scores(lists), strict=True):
        logit = m.bias + sum(m.weights[i] for i in terms)
        for a, i in enumerate(terms):
            for j in terms[a + 1 :]:
                logit += float(m.factors[i] @ m.factors[j])
        assert score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-12)


def test_gain_of_terms():
    """Half of G by its definition, sum of observed times log of observed over expected."""
    clean, toxic, n, m = np.array([10, 0, 40]), np.array([30, 5, 60]), 40, 60
    for c, t, got in zip(clean, toxic, toxicity.gains(clean, toxic, n, m), strict=True):
        seen = np.array([[c, t], [n - c, m - t]], float)
        fair = seen.sum(1, keepdims=True) * seen.sum(0, keepdims=True) / seen.sum()
        assert got == pytest.approx(sum(o * np.log(o / e) for o, e in zip(seen.flat, fair.flat) if o))


def test_rows_without_id_spread_over_the_buckets(documents, monkeypatch):
    """A third of all rows has no id, many of them equal: no bucket, hence no task, holds them."""
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 20)
    rows = [(i, f"text {i} with words", "en", "a") for i in range(400)]
    rows += [(None, "the very same text", "en", "a")] * 150
    rows += [(None, f"text of no id {i}", "en", "b") for i in range(50)]
    sized = mixing.sizes(stable(documents(*rows)))
    hidden = sized.filter("doc_id IS NULL AND queue = '1a'")
    assert hidden.count() == 150
    bucket = mixing.queued(sized, 600).filter("doc_id IS NULL AND queue = '1a'").groupBy("bucket").count()
    assert bucket.count() > 100 and bucket.agg({"count": "max"}).first()[0] < 10
    got = mixing.mix(documents(*rows)).collect()
    taken, target = sum(r.taken for r in got if r.source == "a"), next(r.target for r in got if r.source == "a")
    assert abs(taken - target) <= 10
    played = mixing.mixed_documents(documents(*rows))
    assert played.count() == sum(r.passes for r in got)


@pytest.mark.parametrize(("part", "parts"), [(40, 4_000), (5, 2)])
def test_cut_in_small_parts(spark, small_dir, monkeypatch, part, parts):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = lambda: sorted((r.doc_id, r.taken, r.target) for r in mixing.mix(docs).collect())
    expected = rows()
    monkeypatch.setattr(mixing, "ROWS_PER_PART", part)
    monkeypatch.setattr(mixing, "MAX_PARTS", parts)
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 7)
    assert rows() == expected


def test_blocks_of_any_size_give_the_same_links(spark, small_dir, monkeypatch):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").limit(400)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(10_000 + i, f"{rows[i % 3][1]} {i}") for i in range(60)]
    monkeypatch.setattr(neardup, "LEFT_ROWS", 2)
    monkeypatch.setattr(neardup, "RIGHT_ROWS", 3)
    monkeypatch.setattr(neardup, "CHUNK_SETS", 7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(df, 4).collect()
    expected = brute.near_components(rows, 4)
    assert by_doc(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(expected, key=str)


def unshuffled_python(df):
    """The Python nodes of a plan that share a task, and so a worker each, with who reads it."""
    found, above = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        node = line.lstrip(" :+-")
        depth = len(line) - len(node)
        above = [(d, x) for d, x in above if d < depth]
        if ("Python" in node or "InArrow" in node) and not any(x for _, x in above):
            found.append(node)
        above.append((depth, "Exchange" in node.partition("(")[0]))
    return found


def test_links_are_contracted_without_the_workers_that_found_them(documents, monkeypatch):
    read = []
    contract = neardup.components
    monkeypatch.setattr(neardup, "components", lambda edges: read.append(edges) or contract(edges))
    base = " ".join(f"w{i}" for i in range(40))
    got = neardup.near_duplicates(documents((1, base), (2, f"{base} more"), (3, "x")), 4).collect()
    assert by_doc(got, "doc_id", "component_id") == [(1, 1), (2, 1), (3, 3)]
    assert len(read) == 2
    assert "MapInArrow" in read[1]._jdf.queryExecution().executedPlan().toString()  # the search
    assert [unshuffled_python(edges) for edges in read] == [[], []]


def test_vector_blocks_of_any_size(spark, small_dir, monkeypatch):
    from pyspark.sql import functions as F

    df = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    found = lambda: sorted(map(tuple, vectors.search(df, F.col("vec_id") % 20 == 0).collect()))
    expected = found()
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 64)
    monkeypatch.setattr(vectors, "QUERY_ROWS", 3)
    got = found()
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    exact = {tuple(r[:2]): r for r in expected}
    assert sum(r == exact[tuple(r[:2])] for r in got) >= 0.99 * len(got)


def test_many_copies_are_one_set(documents):
    """Rows equal in id and text, beside near copies of them, cost one set."""
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(1, base)] * 300 + [(2, f"{base} more"), (3, f"{base} other"), (None, base)]
    got = neardup.near_duplicates(documents(*rows), 4).collect()
    assert {r.component_id for r in got} == {1} and len(got) == 303
    assert neardup.one_of_each(documents(*rows)).count() == 1
    deduped = lines.dedup_lines(documents(*rows)).collect()
    assert sum(r.kept != "" for r in deduped if r.row.doc_id == 1) == 1


def test_language_sample_is_bounded(documents, monkeypatch):
    """Long labelled texts give a row of words, and the rarest languages are left out."""
    seen = []
    train = language.train_field
    monkeypatch.setattr(language, "train_field", lambda rows: seen.extend(rows) or train(rows))
    monkeypatch.setattr(language, "SAMPLE_WORDS", 50)
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    say = lambda stem, n: " ".join(f"{stem}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(n))
    rows = [(i, say("das", 900 if i == 3 else 30), "de", "a") for i in range(40)]
    rows += [(100 + i, say("le", 30), "fr", "a") for i in range(30)]
    rows += [(200 + i, say("xo", 30), "xx", "a") for i in range(5)]
    got = language.identify(documents(*rows, clashing=True)).collect()
    assert {lang for lang, _ in seen} == {"de", "fr"}
    assert max(len(text.split()) for _, text in seen) == 50
    assert all(r.lang_pred == r.lang for r in got if r.lang != "xx")
    assert "_found" not in got[0].__fields__ and got[0].key == "x" and got[0].score != "x"


def test_language_equals_enumerated_chains(documents, monkeypatch):
    """Prediction and score of short texts by summing over all label sequences of the field."""
    import itertools

    fields = []
    train = language.train_field
    monkeypatch.setattr(language, "train_field", lambda rows: fields.append(train(rows)) or fields[-1])
    rows = [(i, f"der hund {i} und die katze", "de", "a") for i in range(30)]
    rows += [(50 + i, f"the dog {i} and the cat", "en", "a") for i in range(30)]
    rows += [(100 + i, f"le chien {i} et le chat", "fr", "a") for i in range(30)]
    short = ["der dog le", "und cat", "chien", "zzz qqq der the", "katze, katze 7 chat"]
    rows += [(200 + i, text, None, "a") for i, text in enumerate(short)]
    got = {r.doc_id: r for r in language.identify(documents(*rows)).collect()}
    (field,) = fields
    for i, text in enumerate(short):
        runs = [r for w in text.lower().split() for r in language._LETTERS.findall(w)]
        emit = language._emissions(field.weights, runs).astype(float)
        size, total = len(field.languages), 0.0
        expected = np.zeros(size)
        for labels in itertools.product(range(size), repeat=len(runs)):
            weight = sum(emit[k, y] for k, y in enumerate(labels))
            weight = np.exp(weight + sum(field.transitions[a, b] for a, b in itertools.pairwise(labels)))
            total += weight
            expected += weight * np.bincount(labels, minlength=size)
        share = expected / total / len(runs)
        row = got[200 + i]
        assert row.lang_pred == field.languages[int(share.argmax())]
        assert row.score == pytest.approx(share.max(), abs=1e-4)


def test_batches_are_bounded_in_bytes(spark, documents):
    """Whole texts reach a worker a few MB at a time; a lower limit of the session stays."""
    from quotegrid.llm import common

    kept = spark.conf.get(common.BATCH_BYTES_CONF)
    try:
        common.bounded_batches(spark)
        assert int(spark.conf.get(common.BATCH_BYTES_CONF)) == common.BATCH_BYTES
        rows = documents(*[(i, "x" * 100_000) for i in range(200)]).coalesce(1)

        def count(batches):
            for batch in batches:
                yield pa.record_batch([pa.array([batch.num_rows])], ["n"])

        sizes = [r.n for r in rows.select("text").mapInArrow(count, "n long").collect()]
        assert sum(sizes) == 200 and max(sizes) <= common.BATCH_BYTES // 100_000 + 1
        spark.conf.set(common.BATCH_BYTES_CONF, "1000")
        common.bounded_batches(spark)
        assert spark.conf.get(common.BATCH_BYTES_CONF) == "1000"
    finally:
        spark.conf.set(common.BATCH_BYTES_CONF, kept)
