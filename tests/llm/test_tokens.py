"""Token counts and BPE round trips against the vocabulary's own library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from odflux.llm import bpe_codec, bpe_model, queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def awkward_texts():
    draw = random.Random(5)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["", "aaaaaaa", "a<|endoftext|>b <|endoftext|>", "<|endoftext|>", "  \n\n  x", " a\x1c\x1dd", "x" * 3_000, "it's we'll I'd",
             "".join(draw.choice("abcde") for _ in range(30_000)), "word " * 40_000]
    texts += ["".join(chr(draw.choice(points)) for _ in range(40)) for _ in range(200)]
    texts += ["".join(draw.choice(" \n\tabcthe12'sé.,") for _ in range(200)) for _ in range(200)]
    return texts + ["same again"] * 3


def expected_ids(texts):
    return [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_counts_and_ids_equal_the_library():
    texts = awkward_texts()
    ids = expected_ids(texts)
    assert token_counts.count_texts(PATH, [None, *texts]).tolist() == [0, *map(len, ids)]
    assert bpe_codec.encode_texts(PATH, [None, *texts]).to_pylist() == [[], *ids]
    coded = bpe_codec.encode_texts(PATH, texts)
    assert bpe_codec.decode_ids(PATH, coded).to_pylist() == texts


def test_forgetting_known_words_changes_nothing():
    vocabulary = bpe_model.load(PATH)
    known = bpe_model.KnownWords(vocabulary, lambda words: bpe_codec.encode_words(vocabulary, words), bound=10)
    for text, ids in zip(awkward_texts()[:30], expected_ids(awkward_texts()[:30])):
        rows, _, flat, lengths = known.lookup([text])
        assert flat[bpe_codec._ragged(lengths.cumsum() - lengths, lengths, rows)].tolist() == ids


def test_texts_without_spaces_leave_nothing_behind():
    """Fifty million letters without a space: what is held stays as small as it was."""
    vocabulary = bpe_model.load(PATH)
    known = bpe_model.KnownWords(vocabulary, lambda words: (bpe_model.np.zeros(sum(map(len, words)), bpe_model.np.int64), bpe_model.np.array([len(w) for w in words])))
    draw = random.Random(1)
    held = []
    for _ in range(50):
        text = "".join(chr(0x4E00 + draw.randrange(5_000)) for _ in range(1_000))
        known.lookup([(text + str(k)) * 10 for k in range(100)])
        held.append((known.flat.size, known.lengths.size, len(known.rows)))
    assert len({h[0] for h in held[5:]}) == 1 and held[-1][0] < 2_000 and len({len(set(h[1:])) for h in held}) == 1


def test_long_and_short_words_keep_their_rows():
    vocabulary = bpe_model.load(PATH)
    known = bpe_model.KnownWords(vocabulary, lambda words: bpe_codec.encode_words(vocabulary, words))
    texts = ["ab " + "漢" * 200 + " cd", "漢" * 200, "cd ab", "x" * 90 + " ef " + "漢" * 200, "ef cd"]
    for text, ids in zip(texts * 2, expected_ids(texts) * 2):
        rows, _, flat, lengths = known.lookup([text])
        assert flat[bpe_codec._ragged(lengths.cumsum() - lengths, lengths, rows)].tolist() == ids


def test_texts_are_encoded_once(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = bpe_codec.round_trip(docs, PATH)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.split("ArrowEvalPython")[1].split("]")[0].count("both(") == 1


def test_decoding_odd_ids():
    import pyarrow as pa
    column = pa.array([[200, 1, 50256], None, [], [-1, 10**6], [None, 1]], type=pa.list_(pa.int32()))
    assert bpe_codec.decode_ids(PATH, column).to_pylist() == [LIBRARY.decode([200, 1, 50256], skip_special_tokens=False), "", "", "", '"']


def test_columns(spark):
    rows = [(1, "hello world", 7), (1, "hello world", 7), (None, None, 8), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = token_counts.with_token_counts(docs, PATH, limit=1).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == [
        (0, 0, 0, False), (1, 11, 2, True), (1, 11, 2, True), (3, 0, 0, False)]
    empty = token_counts.with_token_counts(docs.limit(0), PATH)
    assert empty.count() == 0 and bpe_codec.round_trip(docs.limit(0), PATH).count() == 0


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        bpe_model.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_queries(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = dict(zip(docs, expected_ids([t or "" for t in docs.values()])))
    for r in queries.op1_token_counts(spark, sf_dir).collect():
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), len(ids[r.doc_id]), len(ids[r.doc_id]) > 512)
    coded = queries.op9_bpe_round_trip(spark, sf_dir).collect()
    assert len(coded) == len(docs)
    for r in coded:
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
