"""The transducer against enumeration of all paths and against the library, for both model kinds."""

import itertools

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from quotegrid.llm import pieces

MARK = pieces.MARK


def write_model(path, lexicon, kind, normaliser=None, fallback=True, squeeze=False):
    """A model file with the given pieces (text -> score); nothing is trained."""
    model = proto.ModelProto()
    model.pieces.add(piece="<unk>", score=0, type=pieces.UNKNOWN)
    model.pieces.add(piece="<s>", score=0, type=pieces.CONTROL)
    if fallback:
        for b in range(256):
            model.pieces.add(piece=f"<0x{b:02X}>", score=0, type=pieces.BYTE)
    for text, score in lexicon.items():
        model.pieces.add(piece=text, score=score, type=pieces.NORMAL)
    model.trainer_spec.model_type = kind
    model.trainer_spec.byte_fallback = fallback
    spec = model.normalizer_spec
    spec.escape_whitespaces, spec.add_dummy_prefix = True, True
    spec.remove_extra_whitespaces = squeeze
    if normaliser:
        spec.precompiled_charsmap = normaliser
    path.write_bytes(model.SerializeToString())
    return pieces.Transducer(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))


def all_paths(machine, text):
    """(weight, pieces) of every path through arcs that the constraint lets pass."""
    done = {0: [(0.0, ())]}
    for k in range(1, len(text) + 1):
        done[k] = [
            (weight + w, (*path, piece))
            for start, piece, w in machine.arcs_into(text, k)
            for weight, path in done[start]
            if machine.passes(path[-1] if path else "", piece)
        ]
    return sorted(done[len(text)])


def ids_of(machine, path):
    return [i for piece in path for i in np.frombuffer(machine._pack(piece), "<u4").tolist()]


def random_lexicon(rng, letters="abc"):
    lexicon = {c: -float(rng.integers(4, 9)) - 0.01 * i for i, c in enumerate([MARK, *letters])}
    for size in (2, 3, 4):
        for parts in itertools.product([MARK, *letters], repeat=size):
            text = "".join(parts)
            if MARK not in text[1:] and rng.random() < 0.25:
                lexicon[text] = -float(rng.uniform(1, 12)) - 1e-4 * len(lexicon)
    return lexicon


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_model_equals_enumeration(tmp_path, fallback):
    rng = np.random.default_rng(1)
    machine, library = write_model(tmp_path / "u.model", random_lexicon(rng), pieces.UNIGRAM, fallback=fallback)
    for _ in range(300):
        text = "".join(rng.choice(list("aabbcc zé"), rng.integers(1, 9)))
        seen = machine.normalise(text)
        found = all_paths(machine, seen)
        got = machine.encode(text).tolist()
        if fallback:
            assert got == ids_of(machine, found[0][1])
        # The weights are whole steps apart, so rounding decides nothing.
        assert got == library.encode(text), text
        assert machine.shortest_path(seen) == np.array(ids_of(machine, found[0][1]), "<u4").tobytes()


def test_merge_model_has_one_path():
    machine = pieces.transducer()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    rng = np.random.default_rng(2)
    letters = list("theinrsoa") + [" ", "é", "日"]
    for _ in range(300):
        text = "".join(rng.choice(letters, rng.integers(1, 11)))
        found = all_paths(machine, machine.normalise(text))
        assert len(found) == 1
        assert ids_of(machine, found[0][1]) == machine.encode(text).tolist() == library.encode(text)


def test_small_merge_model_equals_library(tmp_path):
    rng = np.random.default_rng(3)
    single = {c: -100.0 - i for i, c in enumerate([MARK, *"abc"])}
    merged, known = {}, list(single)
    while len(merged) < 30:
        text = "".join(rng.choice(known, 2))
        if len(text) <= 6 and MARK not in text[1:] and text not in merged:
            merged[text] = -float(len(merged))
            known.append(text)
    machine, library = write_model(tmp_path / "m.model", {**merged, **single}, pieces.MERGES)
    for _ in range(300):
        text = "".join(rng.choice(list("aabbcc z"), rng.integers(1, 12)))
        (path,) = all_paths(machine, machine.normalise(text))
        assert ids_of(machine, path[1]) == machine.encode(text).tolist() == library.encode(text)


@pytest.mark.parametrize("squeeze", [False, True])
def test_normaliser_equals_library(tmp_path, squeeze):
    rule = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc_cf")
    spec = proto.ModelProto.FromString(rule.serialized_model_proto()).normalizer_spec
    rng = np.random.default_rng(4)
    machine, library = write_model(
        tmp_path / "n.model", random_lexicon(rng), pieces.UNIGRAM, spec.precompiled_charsmap, squeeze=squeeze
    )
    letters = list("aAbBcC  ") + ["\t", "　", "Ａ", "①", "ﬁ", "é", "é", "ß", "㍿", "🙂", "­"]
    for _ in range(400):
        text = "".join(rng.choice(letters, rng.integers(0, 12)))
        assert machine.encode(text).tolist() == library.encode(text), repr(text)
        ids = machine.encode(text).tolist()
        assert machine.decode(ids) == library.decode(ids)
        assert machine.decode(ids) == machine.shown(text)


def test_first_path_is_the_least_one(tmp_path):
    rng = np.random.default_rng(5)
    single = {c: -100.0 - i for i, c in enumerate([MARK, *"abc"])}
    for number in range(20):
        merged, known = {}, [*single, "d"]  # d is no piece of its own, yet pieces may hold it
        while len(merged) < 25:
            text = "".join(rng.choice(known, 2))
            if 1 < len(text) <= 6 and MARK not in text[1:] and text not in merged:
                merged[text] = -float(len(merged))
                known.append(text)
        machine, _ = write_model(tmp_path / f"{number}.model", {**merged, **single}, pieces.MERGES)
        for _ in range(100):
            text = machine.normalise("".join(rng.choice(list("aabbccdé"), rng.integers(1, 14))))
            assert machine.shortest_path(text) == machine.relaxed_path(text), text
    machine = pieces.transducer()
    found = 0
    for _ in range(300):
        text = MARK + "".join(rng.choice(list("theinrsoa"), rng.integers(1, 50)))
        path = machine.first_path(text)
        found += path is not None
        assert b"".join(map(machine._pack, path or [])) == machine.relaxed_path(text)
    assert found == 300


def test_frequent_chunks_outlive_the_others(monkeypatch):
    monkeypatch.setattr(pieces, "MAX_CHUNKS", 40)
    search, asked = pieces.Transducer.shortest_path, []
    monkeypatch.setattr(
        pieces.Transducer, "shortest_path", lambda self, text: asked.append(text) or search(self, text)
    )
    machine = pieces.Transducer(pieces.default_model())
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    for n in range(60):
        text = "the " + " ".join("".join(chr(97 + (n * k + k) % 26) for k in range(j, j + 5)) + chr(97 + n % 26) for j in range(15))
        assert machine.encode(text).tolist() == library.encode(text)
        assert len(machine.paths) + len(machine.paths.older) <= 2 * (40 + 16)
    assert len(asked) > 200 and asked.count(MARK + "the") == 1


def test_decoding_in_blocks(monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", 3)
    machine = pieces.transducer()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    for text in ("", "a", "two words, 日本 and é🙂 more\n", "x" * 40):
        ids = machine.encode(text)
        assert machine.decode(ids) == machine.decode(ids.tolist()) == library.decode(ids.tolist()) == text
