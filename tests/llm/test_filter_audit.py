"""The byte transducer against regular expressions, and the audit against every order applied in turn."""

import random
import re
from itertools import permutations

import numpy as np
import pytest

from odflux.llm import filter_audit as fa
from odflux.llm import queries
from odflux.llm.word_arrays import split_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def odd_texts():
    draw = random.Random(11)
    texts = [None, "", " ", "\n", "a", "A A a", "x\x0by\x0cz\x1c\x85\u2003w", "É É é", "😀" * 9 + " " + "😀" * 9, "ab" * 20_000 + " " + "ab" * 20_000, "w " * 50_000]
    texts += ["".join(draw.choice("aAbé漢 \t\n#$*") for _ in range(draw.randint(0, 400))) for _ in range(300)]
    # Words that differ in their last byte only, of all lengths about eight and sixteen.
    return texts + [" ".join("z" * k + draw.choice("xy") for k in range(20) for _ in range(3))]


def test_transducer_counts_what_patterns_count():
    texts = odd_texts()
    assert fa.transduce(texts).tolist() == [plain_counts(t) for t in texts]
    assert fa.transduce([]).shape == (0, 5)
    assert fa.transduce(["a!b"], symbols="!")[0, 4] == 1


def test_colliding_hashes_join_no_words():
    texts = [t for t in odd_texts() if t and len(t) < 5_000]
    words = split_words(texts, lower=False)
    owner = words.owners()
    for hashes in (np.zeros(len(owner), np.uint64), (words.ends - words.starts).astype(np.uint64), None):
        seen = fa.first_seen(words.buffer, words.starts, words.ends, owner, hashes)
        assert np.bincount(owner[seen], minlength=len(texts)).tolist() == [len(set(WORD.findall(t))) for t in texts]


def brute(docs, labels):
    marks = {}
    for doc, quality, toxic in labels:
        good, bad = marks.get(doc, (False, False))
        marks[doc] = (good or quality == 1, bad or toxic == 1)
    least = {}
    for doc, text, _ in docs:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    rows = []
    for doc, text, part in docs:
        words, distinct, capitals, points, symbols = plain_counts(text)
        fails = {"A": words < 50, "B": 100 * distinct < 65 * words, "C": 100 * capitals > 5 * points, "D": symbols > 0,
                 "E": doc is not None and least[text or ""] < doc}
        rows.append((part or "", {k for k, v in fails.items() if v}, *(marks.get(doc, (False, False)) if doc is not None else (False, False))))
    out = []
    for part in {r[0] for r in rows}:
        lines = []
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                removed = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                lines.append([part, "".join(order), step, len(left), len(removed), sum(letter in r[1] for r in gone),
                              sum(r[1] == {letter} for r in rows if r[0] == part), sum(r[2] for r in removed), sum(r[3] for r in removed)])
                gone += removed
        shapley = {x: sum(line[4] for line in lines if line[1][line[2] - 1] == x) for x in "ABCDE"}
        out += [(*line, shapley[line[1][line[2] - 1]]) for line in lines]
    return sorted(out)


def test_audit_against_every_order(spark):
    draw = random.Random(2)
    texts = odd_texts()[:40] + [" ".join(draw.choice(["Ab", "cd", "ef", "g#", "h", f"w{draw.randint(0, 99)}"]) for _ in range(draw.randint(20, 90))) for _ in range(40)]
    docs = [(draw.choice([None, *range(60)]), draw.choice(texts), draw.choice(["web", "news", "", None])) for _ in range(400)]
    docs += [docs[0]] * 3 + [(7, "same", "web"), (7, "same", "web"), (7, "same", "news"), (8, "same", "web"), (None, "same", "web")]
    labels = [(draw.choice([None, *range(70)]), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(60)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, source string, counts int, part string").repartition(4)
    marks = spark.createDataFrame([(*m, "y") for m in labels], "doc_id long, quality int, toxic int, text string")
    got = sorted(map(tuple, fa.audit_filters(frame, marks).collect()))
    assert got == brute(docs, labels)
    assert fa.audit_filters(frame.limit(0), marks).count() == 0
    assert sorted(map(tuple, fa.audit_filters(frame, marks.limit(0)).collect())) == brute(docs, [])


@pytest.mark.parametrize("column", ["words", "distinct_words"])
def test_other_filters(spark, column):
    """Two own filters in place of the four: orders, parts and bits follow their number."""
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "a b", "s"), (3, "a a a", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    sets = fa.failed_sets(docs, labels, lambda c: {"X": c[column] > 2})
    rows = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant) for r in fa.audit_orders(sets, "XE").collect()}
    removed = 1 if column == "words" else 0
    assert rows == {("XE", 1): (3 - removed, removed, 0), ("XE", 2): (2 - removed, 1, 0), ("EX", 1): (2, 1, 0), ("EX", 2): (2 - removed, removed, 0)}


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    got = [(r.part, r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in queries.op13_filter_audit(spark, sf_dir).collect()]
    assert sorted(got) == brute(docs, labels)
