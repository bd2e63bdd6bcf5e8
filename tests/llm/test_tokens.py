"""Encoding, packing, chats and the pipeline."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import compare
import corpus_pipeline
import fixtures
from clickwell.llm import bpe, chat, common, encoding, packing

SF_DIR = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD = ["", " ", "  a  b\n\n c ", "x y  z", "a<|endoftext|>, b <|endoftext|>", "thetione" * 1_000, "ab" * 3_000 + "12" * 2_000 + "<|endoftext|>" + "é" * 3_000,
       "\U0001f600" * 2_500, "日本語の" * 900, " " * 5_000 + "x", "a\x1c b\x85c", "A'S don't. 's, ΑΣ. Σ, É, x2. ²,", "THE. The! (the). the)", "ab́. 5. ①. İ."]


def ids_of(data):
    return np.frombuffer(data, dtype="<u4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_words_encode_as_the_library_does(text):
    whole, words = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
    assert ids_of(bpe.encode_text(BYTES, text)) == whole.encode(text, add_special_tokens=False).ids
    assert ids_of(packing.encode_text(WORDS, text)) == words.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("leaf", [3, 7, 50])
def test_tree_concatenation(leaf):
    model = Tokenizer.from_file(BYTES)
    for text in ("interestingly" * 30, "abcabcabd" * 40, "éàü" * 60, "日本語" * 40):
        assert bpe.tree(model, text, leaf) == model.encode(text, add_special_tokens=False).ids


def test_op7_equals_the_library(spark):
    model = Tokenizer.from_file(BYTES)
    got = {r.doc_id: r for r in bpe.op7_bpe(spark, SF_DIR).collect()}
    for doc_id, text in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        ids = model.encode(text, add_special_tokens=False).ids
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(model.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_of_odd_rows(spark):
    rows = bpe.roundtrip(fixtures.table(spark), BYTES).collect()
    assert Counter((r.doc_id, r.decoded) for r in rows) == Counter((d, t or "") for d, t in fixtures.texts())
    assert bpe.roundtrip(fixtures.table(spark, []), BYTES).count() == 0


def test_decoding_broken_bytes_as_the_library_does():
    model = Tokenizer.from_file(BYTES)
    lists = [model.encode("é日", add_special_tokens=False).ids[:1], [50256, 11], []]
    import pyarrow as pa

    assert bpe.decode_batch(BYTES, pa.array(lists, pa.list_(pa.int32()))) == [
        model.decode(ids, skip_special_tokens=False) for ids in lists]


def check_packing(pieces, texts):
    """Every id in one piece, sequences gapless, little padding."""
    model = Tokenizer.from_file(WORDS)
    want = Counter(tuple([d, *model.encode(t or "", add_special_tokens=False).ids, packing.END_ID]) for d, t in texts)
    sequences, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length * 4 == len(p.ids) and p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
        parts[p.doc_id, p.doc_tokens].append((p.start, ids_of(p.ids)))
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= packing.TIERS[-1]
    if len({d for d, _ in texts}) == len(texts):
        assert Counter(tuple([d, *[i for _, part in sorted(rows) for i in part]]) for (d, _), rows in parts.items()) == want
    assert sum(p.length for p in pieces) == sum(len(k) - 1 for k in want.elements())
    sizes = [sum(length for _, length in rows) for rows in sequences.values()]
    return sum(packing.TIERS[-1] - s for s in sizes if s & (s - 1)), len(sizes)


@pytest.mark.parametrize("pool", [packing.POOL_TOKENS, 6_000])
def test_packing_of_odd_rows(spark, pool):
    docs = fixtures.table(spark).repartition(2)
    check_packing(packing.pack(docs, WORDS, pool).collect(), fixtures.texts())
    once = [r for r in fixtures.texts() if r[0] not in (None, 9)]
    padding, _ = check_packing(packing.pack(fixtures.table(spark, once).coalesce(1), WORDS, pool).collect(), once)
    assert padding < packing.TIERS[-1]
    assert packing.pack(fixtures.table(spark, []), WORDS).count() == 0


def test_op5_is_whole_and_dense(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    pieces = packing.pack(common.table(spark, SF_DIR, "documents"), WORDS).collect()
    padding, sequences = check_packing(pieces, texts)
    assert padding < 0.02 * sum(p.length for p in pieces)
    assert {p.tier for p in pieces} >= set(packing.TIERS)
    groups = Counter()
    for p in pieces:
        groups[p.step_group] += p.length
    assert max(groups.values()) - min(groups.values()) <= packing.TIERS[-1]
    assert packing.op5_packing(spark, SF_DIR).count() == len(pieces)


def test_op10_equals_sql(spark):
    got = compare.spark_rows(chat.op10_chat(spark, SF_DIR))
    assert got == compare.oracle(SF_DIR, chat.OP10_SQL)


def test_snapshots_collapse(spark):
    said = {1: ["a", "b"], 2: ["a", "b", "c"], 3: ["a", "x"], 4: ["a", "b", "c"], 5: ["b"], 6: ["a"], 7: [None, "q"], 8: [""]}
    rows = [(c, i, "user" if i % 2 == 0 else None, t, "x") for c, turns in said.items() for i, t in enumerate(turns)]
    rows += [(9, None, None, None, "x"), (9, 0, "user", "<|im_start|>", "x"), (9, 0, "user", "<|im_start|>", "x"), (None, 1, "user", "z", "x")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, n_turns string")
    got = {r.conv_id: r for r in chat.format_chats(turns).collect()}
    assert {c: (r.n_turns, r.n_equal) for c, r in got.items()} == {2: (3, 2), 3: (2, 1), 5: (1, 1), 7: (2, 1), 9: (3, 1), None: (1, 1)}
    assert got[3].rendered == "<|im_start|>user\na<|im_end|>\n<|im_start|>\nx<|im_end|>\n"
    assert got[9].rendered == "<|im_start|>\n<|im_end|>\n" + "<|im_start|>user\n<im_start><|im_end|>\n" * 2
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_pipeline_stages_keep_what_they_should(spark):
    docs = common.table(spark, SF_DIR, "documents")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    ids = set(texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, SF_DIR), name)
        kept = [r.doc_id for r in docs.collect()]
        assert docs.columns == columns and len(kept) == len(set(kept)) and set(kept) <= ids
        if name == "exact_dedup":
            before = {texts[i] for i in ids}
            assert len(kept) == len(before) and {texts[i] for i in kept} == before
        if name == "secrets":
            assert set(kept) == ids
        ids = set(kept)
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {p.doc_id for p in pieces} == ids


def test_pipeline_stages_stand_odd_rows(spark):
    docs = fixtures.table(spark)
    exact = corpus_pipeline.drop_repeats(spark, docs, SF_DIR)
    assert Counter((r.text or "") for r in exact.collect()) == Counter({t or "" for _, t in fixtures.texts()})
    near = corpus_pipeline.drop_near_repeats(spark, exact, SF_DIR)
    assert near.count() == exact.count() - 1  # one near copy
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF_DIR)
            assert name == "packing" or out.columns == rows.columns
            assert out.count() <= 3 * rows.count()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_of_letters_by_ranks_equal_the_library(name):
    path = public_tokenizers.path(name)
    model, quick = encoding.tokenizer(path), encoding.ranked(path)
    assert quick is not None
    words, ids = quick
    rng = random.Random(8)
    tried = ["a", "ß", " the", "straße", "z" * 256]
    tried += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäéñßÿ", k=rng.randint(1, 256 if i % 50 == 0 else 14))) for i in range(4_000)]
    tried += [" " + w for w in tried] + [w.title() for w in tried]
    good = [w for w in tried if words.fullmatch(w)]
    assert len(good) >= 4_000
    assert [ids(w) for w in good] == [e.ids for e in model.encode_batch(good, add_special_tokens=False)]
    assert not any(words.fullmatch(w) for w in ("", "it's", "a1", "a b", "\u00f7", "\u4e2d", "e\u0301", "a" * 300))
