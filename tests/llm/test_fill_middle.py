"""Fill-in-middle against plain slicing of Python strings."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from odflux.llm import fill_middle as fm
from odflux.llm import queries


def mixed(draw, n, letters="ab é漢😀"):
    return "".join(draw.choice(letters) for _ in range(n))


def brute(doc_id, text, marks=("<P>", "<S>", "<M>"), seed=1):
    """(n, form, prefix, middle, suffix, output)"""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not n or any(m in text for m in marks) or h[2] % 100 >= 90:
        return n, "plain", None, None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, s, m = marks
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", pre, mid, suf, s + suf + p + pre + m + mid
    return n, "psm", pre, mid, suf, p + pre + s + suf + m + mid


@pytest.mark.parametrize("error", [0, 1, 7, 127])
def test_index_is_bounded_and_exact(error):
    draw = random.Random(error)
    texts = ["", "a", "é", mixed(draw, 5_000), "a" * 3_000 + "漢" * 3_000, mixed(draw, 20_000, "a" * 30 + "😀"), ""]
    boundaries, firsts, at = [], [], 0
    for text in texts:
        firsts.append(len(boundaries))
        for c in text:
            boundaries.append(at)
            at += len(c.encode())
    boundaries = np.array([*boundaries, at])
    index = fm.fit_index(boundaries, np.array(firsts), error)
    every = np.arange(len(boundaries))
    assert np.abs(index.predict(every) - boundaries).max() <= error
    assert (index.offset(every) == boundaries).all()
    # Plain runs need one piece each, so the index is far smaller than what it stands for.
    if error == 127:
        assert len(index.ranks) < 40


def test_index_of_nothing():
    for boundaries in (np.array([0]), np.array([0, 3])):
        index = fm.fit_index(boundaries, np.array([0]))
        assert (index.offset(np.arange(len(boundaries))) == boundaries).all()
    with pytest.raises(ValueError):
        fm.fit_index(np.array([0]), np.array([0]), 128)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_cuts_of_slices_and_arrays_with_an_offset(kind):
    draw = random.Random(3)
    texts = [mixed(draw, draw.choice([0, 1, 50, 3_000])) for _ in range(60)]
    ranks = np.array([draw.randint(0, len(t)) for t in texts])
    column = pa.array(["ahead é", *texts], type=kind).slice(1)
    for limit in (1, 1_000, 10**6):
        got = fm.cut_offsets(column, [ranks], limit=limit)[0]
        assert got.tolist() == [len(t[:r].encode()) for t, r in zip(texts, ranks)]
    assert fm.cut_offsets(pa.array([], type=kind), [np.zeros(0, np.int64)])[0].tolist() == []


def test_rows_against_plain_slicing(spark):
    draw = random.Random(9)
    texts = [None, "", "x", "é", "<P>", "a<S>b", "<<P", "ends with <", mixed(draw, 60_000)] + [mixed(draw, draw.randint(0, 80), "ab<PSM>é") for _ in range(400)]
    rows = [(None if i == 20 else i % 390, t, i, "kept") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[-1], rows[-1]], "doc_id long, text string, prefix int, first string").repartition(3)
    got = fm.fill_in_middle(docs).withColumn("back", fm.restore(fm.F.col("output"), fm.F.col("form")))
    assert got.columns == ["doc_id", "text", "first", "n", "form", "prefix", "middle", "suffix", "output", "back"]
    told = sorted((repr((r.doc_id, r.text, r.n, r.form, r.prefix, r.middle, r.suffix, r.output)) for r in got.collect()))
    assert told == sorted(repr((i, t, *brute(i, t))) for i, t, *_ in [*rows, rows[-1], rows[-1]])
    assert all(r.back == (r.text or "") and r.first == "kept" for r in got.collect())
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}
    assert fm.fill_in_middle(docs.limit(0)).count() == 0


def test_own_marks_seed_and_shares(spark):
    docs = spark.createDataFrame([(f"d{i}", "some text é") for i in range(50)], "doc_id string, text string")
    marks = ("[pre]", "[suf]", "[mid]")
    got = fm.fill_in_middle(docs, seed=7, plain_from=100, spm_below=100, marks=marks)
    assert {r.form for r in got.collect()} == {"spm"}
    assert all(r.output == f"[suf]{r.suffix}[pre]{r.prefix}[mid]{r.middle}" and r.prefix + r.middle + r.suffix == r.text for r in got.collect())
    assert got.where(fm.restore(fm.F.col("output"), fm.F.col("form"), marks) == fm.F.col("text")).count() == 50
    for bad in (("", "b", "c"), ("ab", "b", "c"), ("aa", "b", "c"), ("xy", "yz", "c")):
        with pytest.raises(ValueError):
            fm.fill_in_middle(docs, marks=bad)


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = queries.op11_fill_in_middle(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, form, pre, mid, _, output = brute(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.output_sha256, r.restored_sha256) == (n, form, sha(output), sha(texts[r.doc_id] or ""))
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if pre is None else (len(pre), len(mid)))
