"""The registered queries against their contracts: columns, SQL, brute force, round trips."""

import glob
import hashlib
import os
import zlib
from collections import Counter

import brute
import brute_turns
import duckdb
import numpy as np
import pytest
from helpers import rows_of

import __spark_entry__ as entry
from quotegrid.llm.common import is_held_out, settle
from quotegrid.llm.registry import LLM_ORACLE_SQL, LLM_QUERIES

CONTRACT = {
    "op1": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op3": "doc_id:bigint n_shingles:bigint component_id:bigint kept:boolean",
    "op4": "doc_id:bigint held_out:boolean lang_pred:string score:double",
    "op5": "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint",
    "op6": "query_id:bigint rank:int vec_id:bigint score:double",
    "op7": "doc_id:bigint start:bigint n_tokens:bigint ids_crc32:bigint",
    "op9": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint "
    "n_repeat_words:bigint base_failed:boolean kept:boolean",
    "op10": "doc_id:bigint n_words:bigint n_removed:bigint kept_sha256:string",
    "op11": "page_id:bigint payload_bytes:bigint payload_digest:string record_type:string "
    "refers_to:bigint",
    "op12": "conv_id:bigint gaps:bigint blank:bigint duplicate:bigint truncated:bigint "
    "illegal:bigint cost:bigint audit:string repaired_sha256:string",
    "op13": "conv_id:bigint depth:bigint parent_conv_id:bigint n_convs:bigint n_children:bigint "
    "n_leaves:bigint saved_tokens:bigint ends_sha256:string",
}


def named(prefix):
    return next(q for n, q in LLM_QUERIES.items() if n.startswith(f"{prefix}_"))


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES)
    assert numbers == list(range(1, 14))
    assert entry.queries().keys() >= {*LLM_QUERIES, "pipeline"}


@pytest.mark.parametrize("prefix", CONTRACT)
def test_columns(spark, sf_dir, prefix):
    got = dict(named(prefix)(spark, sf_dir).dtypes)
    for column in CONTRACT[prefix].split():
        name, kind = column.split(":")
        assert got[name] == kind


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_sql(spark, small_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{small_dir}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    got = LLM_QUERIES[name](spark, small_dir)
    result = con.execute(LLM_ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    order = [names.index(c) for c in sorted(names)]
    expected = sorted(tuple(str(row[i]) for i in order) for row in result.fetchall())
    assert rows_of(got) == expected and expected


@pytest.fixture(scope="module")
def texts(spark, small_dir):
    read = spark.read.parquet(f"{small_dir}/documents.parquet")
    return [(r.doc_id, r.text) for r in read.select("doc_id", "text").collect()]


def test_near_duplicates_equal_brute_force(spark, small_dir, texts):
    got = named("op3")(spark, small_dir)
    got = [tuple(r) for r in got.select(*(c.split(":")[0] for c in CONTRACT["op3"].split())).collect()]
    assert sorted(got) == sorted(brute.near_components(texts, 4))


def test_substrings_equal_brute_force(spark, small_dir, texts):
    got = [tuple(r) for r in named("op10")(spark, small_dir).collect()]
    assert sorted(got) == sorted(brute.without_repeats(texts))


def test_nearest_recall(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/embeddings.parquet").select("vec_id", "embedding")
    rows = [tuple(r) for r in rows.collect()]
    got = {(r.query_id, r["rank"]): r for r in named("op6")(spark, small_dir).collect()}
    expected = brute.nearest(rows, sorted(i for i, _ in rows if i % 100 == 0), 10)
    assert len(got) == len(expected)
    found = sum(got[q, r].vec_id == i for q, r, i, _ in expected)
    assert found >= 0.99 * len(expected)
    for q, r, i, d in expected:
        if got[q, r].vec_id == i:
            assert got[q, r].score == pytest.approx(d, abs=1e-12)


def test_token_files_equal_library(spark, small_dir, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected, start = [], 0
    for doc_id, text in sorted(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = named("op7")(spark, small_dir).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_pieces_equal_library(spark, small_dir, texts):
    import sentencepiece

    from quotegrid.llm.pieces import default_model

    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    got = {r.doc_id: r for r in named("op2")(spark, small_dir).collect()}
    for doc_id, text in texts:
        ids = np.array(library.encode(text or ""), "<u4")
        assert got[doc_id].n_pieces == len(ids)
        assert got[doc_id].ids_crc32 == zlib.crc32(ids.tobytes())
        assert got[doc_id].round_trip == ("▁" not in (text or ""))


def test_toxicity_on_held_out_rows(spark, small_dir):
    truth = {
        r.doc_id: r.toxic for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()
    }
    got = {r.doc_id: r for r in named("op1")(spark, small_dir).collect()}
    for doc_id, row in got.items():
        assert row.held_out == is_held_out(doc_id)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
    held = [d for d in truth if is_held_out(d) and d in got]
    seen = Counter((truth[d], got[d].predicted) for d in held)
    assert seen[1, 1] >= 0.5 * (seen[1, 1] + seen[1, 0])
    assert seen[0, 1] <= 0.05 * (seen[0, 0] + seen[0, 1])


def test_language_on_held_out_rows(spark, small_dir):
    truth = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "lang")
    truth = {r.doc_id: r.lang for r in truth.collect()}
    got = {r.doc_id: r for r in named("op4")(spark, small_dir).collect()}
    held = [d for d in truth if is_held_out(d)]
    right = sum(got[d].lang_pred == truth[d] for d in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_line_dedup_equals_brute_force(spark, small_dir, texts):
    expected = brute.without_aligned_blocks(texts)
    got = {r.doc_id: r for r in named("op8")(spark, small_dir).collect()}
    assert got.keys() == expected.keys()
    for doc_id, (lines, removed, rest) in expected.items():
        digest = hashlib.sha256(rest.encode()).hexdigest()
        assert (got[doc_id].n_lines, got[doc_id].n_removed) == (lines, removed), doc_id
        assert got[doc_id].kept_sha256 == digest, doc_id


def test_line_dedup_leaves_no_common_run(spark, small_dir, texts):
    expected = brute.without_common_runs(texts)
    got = {r.doc_id: r for r in named("op8")(spark, small_dir).collect()}
    assert got.keys() == expected.keys()
    for doc_id, (lines, removed, rest) in expected.items():
        digest = hashlib.sha256(rest.encode()).hexdigest()
        assert (got[doc_id].n_lines, got[doc_id].n_removed) == (lines, removed), doc_id
        assert got[doc_id].kept_sha256 == digest, doc_id


def test_pipeline_equals_brute_force(spark, small_dir):
    """Every stage on what the one before it kept, and the whole run on the whole table."""
    import corpus_pipeline
    import sentencepiece

    from quotegrid.llm.pieces import default_model

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    def apply(name, docs):
        out = settle(stages[name](spark, docs, small_dir), "stage")
        assert out.columns[: len(columns)] == columns
        return out, out.collect()

    docs, kept = apply("toxicity", docs)
    judged = {r.doc_id: r.predicted for r in named("op1")(spark, small_dir).collect()}
    assert sorted(r.doc_id for r in kept) == sorted(d for d in rows if not judged[d])
    assert all(r == rows[r.doc_id] for r in kept)

    expected = brute.without_aligned_blocks([(r.doc_id, r.text) for r in kept])
    docs, kept = apply("line dedup", docs)
    expected = {d: x for d, x in expected.items() if not x[1] or x[2].strip(" ")}
    assert sorted(r.doc_id for r in kept) == sorted(expected)
    assert all(r.text == expected[r.doc_id][2] for r in kept)
    assert all(r.n_chars == len(r.text) for r in kept if expected[r.doc_id][1])

    groups = brute.near_components([(r.doc_id, r.text) for r in kept], 5)
    docs, kept = apply("near dedup", docs)
    assert sorted(r.doc_id for r in kept) == sorted(d for d, _, _, first in groups if first)

    sizes = [(r.doc_id, len(brute.words(r.text)), r.source, r.text) for r in kept]
    expected = brute.mixed(sizes)
    docs, kept = apply("source mix", docs)
    played = Counter(r.doc_id for r in kept)
    assert all(played[d] == expected[d] for d, size, *_ in sizes if size)

    _, kept = apply("sentencepiece", docs)
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    assert all(r.pieces == library.encode(r.text or "") and r.decodes for r in kept)
    whole = corpus_pipeline.run(spark, small_dir).collect()
    assert sorted(map(str, whole)) == sorted(map(str, kept))


def test_pipeline_equals_brute_force_of_runs(spark, small_dir, monkeypatch):
    monkeypatch.setattr(brute, "without_aligned_blocks", brute.without_common_runs)
    test_pipeline_equals_brute_force(spark, small_dir)


def test_conversation_operators_equal_brute_force(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/conversations.parquet")
    rows = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    for prefix, plain in (("op12", brute_turns.repair_report), ("op13", brute_turns.prefix_trie)):
        columns = [c.split(":")[0] for c in CONTRACT[prefix].split()]
        got = [tuple(r) for r in named(prefix)(spark, small_dir).select(*columns).collect()]
        assert sorted(got, key=str) == sorted(plain(rows), key=str)
