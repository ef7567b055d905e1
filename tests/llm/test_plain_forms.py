"""The classifiers and the benchmark search against plain loops over words, and the cases that have no limit any more."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from odflux.llm import decontaminate as dc
from odflux.llm import labelled, quality, toxicity
from tests.llm.test_classifiers import DOCS as TEXTS
from tests.llm.test_classifiers import LABELS, corpus, edits, frames
from tests.llm.test_decontaminate import DOCS, ITEMS, nearest, words

MARKS = {chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()}


# --- quality ---------------------------------------------------------------

def plain_ngrams(text):
    """Every n-gram of the words (up to 2) and of their shapes (up to 3), as tuples."""
    own = re.findall(rb"[^ \t-\r]+", (text or "").encode())
    shapes = []
    for i, w in enumerate(own):
        big, small = sum(0x41 <= b < 0x5B for b in w), sum(0x61 <= b < 0x7B for b in w)
        case = "none" if not big else "mixed" if small else "several" if big > 1 else "one"
        mark = lambda n: chr(w[-n]) if len(w) >= n and chr(w[-n]) in MARKS else ""
        shapes.append((case, i > 0 and own[i - 1] == w, any(0x30 <= b < 0x3A for b in w), min(4, sum(chr(b) in MARKS for b in w)),
                       min(7, int(math.log2(len(w) + 1))), mark(1), mark(2) if mark(1) else ""))
    return [(stream, *row[i:i + k]) for stream, (row, longest) in enumerate(((own, 2), (shapes, 3)))
            for k in range(1, longest + 1) for i in range(len(row) - k + 1)]


def test_hashed_ngrams_are_the_plain_ones():
    draw = random.Random(4)
    texts = [" ".join(draw.choice(["a", "Bee", "CAT!", "d1,", "e.", "é?!", "ff", "x--", "(Y)"]) for _ in range(draw.randrange(40))) for _ in range(200)]
    texts += [None, "", " ", "one", "Two two", "a a a"]
    for text, (at, x) in zip(texts, quality.sparse_rows(texts)):
        plain = Counter(plain_ngrams(text))
        total = sum(plain.values())
        assert sum(x) == pytest.approx(quality.SCALE if total else 0, rel=1e-5)
    # The hash is free, so n-grams are told apart by what they do: equal plain vectors give equal rows, others others.
    groups = defaultdict(set)
    for text, (at, x) in zip(texts, quality.sparse_rows(texts)):
        groups[frozenset(Counter(plain_ngrams(text)).items())].add((at.tobytes(), x.tobytes()))
        times = sorted(Counter(plain_ngrams(text)).values())
        assert np.allclose(sorted(x * max(1, sum(times)) / quality.SCALE), times, rtol=1e-4)
    assert all(len(rows) == 1 for rows in groups.values()) and len({next(iter(r)) for r in groups.values()}) == len(groups)


def plain_leader(rows, labels, epochs):
    """FTRL-proximal one coordinate at a time, over dictionaries; the bias is a coordinate without penalties."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        l1, l2 = (0.0, 0.0) if i == "bias" else (quality.L1, quality.L2)
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + l2)

    for _ in range(epochs):
        for row, label in zip(rows, labels):
            own = {**row, "bias": 1.0}
            w = {i: weight(i) for i in own}
            error = 1 / (1 + math.exp(-sum(w[i] * x for i, x in own.items()))) - label
            for i, x in own.items():
                g = error * x
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return weight


def test_updates_and_scores_are_the_plain_ones():
    docs, labels = corpus(80, seed=9)
    texts, marks = [d[1] for d in docs], np.array([x[1] for x in labels])
    rows = quality.sparse_rows(texts)
    weights = quality.follow_the_leader(rows, marks, epochs=3)
    plain = plain_leader([dict(zip(at.tolist(), x.tolist())) for at, x in rows], marks.tolist(), 3)
    for at in {int(i) for a, _ in rows for i in a}:
        assert weights[at] == pytest.approx(plain(at), abs=1e-7)
    assert weights[-1] == pytest.approx(plain("bias"), abs=1e-7)
    for (at, x), score in zip(rows, quality.QualityModel(weights).score_texts(texts)):
        dot = sum(plain(int(i)) * float(v) for i, v in zip(at, x)) + plain("bias")
        assert score == pytest.approx(1 / (1 + math.exp(-dot)), abs=1e-5)


def test_texts_that_share_a_line_all_teach(spark):
    line = " ".join(f"common{i}" for i in range(30))
    docs = [(i, f"{line} own{i}", 0, "") for i in range(200)] + [(i, f"{line} OWN0 ", 0, "") for i in range(200, 220)] + [(300 + i, f"w{i}", 0, "") for i in range(20)]
    rows = labelled.training_rows(spark.createDataFrame(docs, TEXTS), spark.createDataFrame([(d[0], 1, 0, "") for d in docs], LABELS), "quality", 4, 2)
    taught = {r.doc_id for r in rows.collect()}
    learnable = {d[0] for d in docs if zlib.crc32(str(d[0]).encode()) % 4 != 2}
    copies = learnable & ({0} | set(range(200, 220)))
    assert taught == (learnable - copies) | {min(copies)}


# --- toxicity --------------------------------------------------------------

def plain_features(terms, ordinary, shortest, text):
    """The FEATURES of one text, word by word."""
    text = text or ""
    spans = [m.span() for m in re.finditer(r"[^\W_]+", text)]
    hits = []
    for k, (a, b) in enumerate(spans):
        word = text[a:b].lower()
        near = [] if word in ordinary else [(edits(word, t), n) for n, t in enumerate(terms) if edits(word, t) <= (len(t) >= shortest)]
        if near:
            line = text.rfind("\n", 0, a) + 1
            low, high = max(0, k - toxicity.CONTEXT_WORDS), min(len(spans) - 1, k + toxicity.CONTEXT_WORDS)
            begin, end = 0 if low == 0 else spans[low][0], len(text) if high == len(spans) - 1 else spans[high][1]
            count = lambda x, y: sum(c in toxicity.QUOTES for c in text[x:y])
            hits.append((k, *min(near), count(line, a) % 2 == 1 and count(begin, a) > 0 and count(b, end) > 0))
    close = [any(abs(k - other[0]) <= toxicity.CONTEXT_WORDS for other in hits if other[0] != k) for k, *_ in hits]
    n = lambda keep: sum(1 for h in hits if keep(h))
    return [math.log1p(v) for v in (
        n(lambda h: not h[1] and not h[3]), n(lambda h: h[1] and not h[3]), n(lambda h: not h[1] and h[3]), n(lambda h: h[1] and h[3]),
        len({h[2] for h in hits}), sum(c and not h[3] for c, h in zip(close, hits)),
        100 * n(lambda h: not h[1] and not h[3]) / max(1, len(spans)))]


def test_scores_are_the_plain_ones(spark, monkeypatch):
    draw = random.Random(12)
    terms = sorted(["cad", "oaf", "swine", "rotten", "rottener", "wretch", "beastly"])
    ordinary = {"cat", "loaf", "rotter"}
    pool = [*terms, *ordinary, "swin", "cads", "of", "wretches", "rotten", "Beastley", "OAF", "fine", "words", "only", "x1"]
    texts = ["".join(draw.choice(pool) + draw.choice([" ", " ", ", ", ' "', '" ', "\n", " “", "” "]) for _ in range(draw.randrange(60))) for _ in range(300)]
    texts += [None, "", '"', "cad"]
    for size in (1_000, 2):  # one automaton, or several
        monkeypatch.setattr(toxicity, "TERMS_AN_AUTOMATON", size)
        lexicon = toxicity.LearnedLexicon(terms, ordinary)
        assert len(lexicon.parts) == -(-len(terms) // size)
        got = toxicity.hit_counts(lexicon, texts)
        for row, text in zip(got, texts):
            assert row.tolist() == pytest.approx(plain_features(terms, ordinary, toxicity.SHORTEST_LEARNED, text)), text
        model = toxicity.ToxicityModel(lexicon, [0.5, 0.25, -0.5, 0.125, 1.0, 0.75, -0.25], -1.5, 0.1)
        for r in model.score(spark.createDataFrame([(t,) for t in texts], "text string")).collect():
            total = -1.5 + sum(w * x for w, x in zip(model.weights, plain_features(terms, ordinary, toxicity.SHORTEST_LEARNED, r.text)))
            assert r.score == pytest.approx(1 / (1 + math.exp(-total)))


def test_misspelled_short_terms_are_met_and_ordinary_words_are_not(spark):
    docs, labels = corpus(600, seed=3)
    turn = random.Random(8)
    made = []
    for (i, text, *rest), mark in zip(docs, labels):
        own = [w for w in text.split() if w.lower().strip("!") not in ("blasted", "wretched", "rotten", "beastly")]
        for _ in range(4):
            own.insert(turn.randrange(len(own)), "clod" if mark[2] else turn.choice(["cloud", "plod"]))
        made.append((i, " ".join(own), *rest))
    docs, labels = frames(spark, made, labels)
    model = toxicity.fit(docs, labels)
    assert "clod" in model.lexicon.terms and {"cloud", "plod"} <= set(model.lexicon.ordinary)
    rows = toxicity.hit_counts(model.lexicon, ["you clodd there", "a cloud and plod", "you clod"])
    names = dict(zip(toxicity.FEATURES, rows.T))
    assert (names["near_open"] > 0).tolist() == [True, False, False] and (names["exact_open"] > 0).tolist() == [False, False, True]


# --- benchmark -------------------------------------------------------------

def test_items_at_the_bound_against_a_scan_of_all_pairs(spark):
    draw = random.Random(21)
    items = [(i, words(draw, draw.randint(10, 50))) for i in range(30)]
    rows = []
    for n in range(240):
        own = list(items[n % 30][1])
        for _ in range(dc.allowed_edits(len(own), 0.2) + n % 2):  # at the bound, or one edit past it
            at, kind = draw.randrange(len(own)), draw.randrange(3)
            own[at:at + (kind != 2)] = [] if kind == 1 else words(draw, 1)
        rows.append((n, words(draw, draw.randrange(40)) + own + words(draw, draw.randrange(40))))
    plain = {(n, i): nearest(own, text) for n, text in rows for i, own in items}
    plain = {pair: d for pair, d in plain.items() if d <= dc.allowed_edits(len(items[pair[1]][1]), 0.2)}
    found = dc.find_leaks(spark.createDataFrame([(n, " ".join(t), 0, 0) for n, t in rows], DOCS),
                          spark.createDataFrame([(i, " ".join(w), 0) for i, w in items], ITEMS)).collect()
    got = {(r.doc_id, r.item_id): r.edits for r in found}
    assert len(plain) >= 120 and set(got) <= set(plain) and len(got) >= 0.97 * len(plain)
    assert all(d == plain[pair] for pair, d in got.items())


def test_short_items_are_found_on_request(spark):
    draw = random.Random(22)
    pool = words(draw, 8)
    items = [(i, " ".join(draw.choice(pool) for _ in range(1 + i % 4))) for i in range(24)] + [(90, None), (91, " ! ")]
    docs = [(n, " ".join(draw.choice(pool) for _ in range(draw.randrange(12))), 0, 0) for n in range(150)]
    docs += [(200, None, 0, 0), (201, (pool[0] + " ") * 100_000, 0, 0), (202, pool[1].upper() + ".", 0, 0)]
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS)
    plain = {(n, i) for n, text, *_ in docs for i, item in items if text and item and item.strip(" !")
             and re.search(rf"(?<![a-z]){item}(?![a-z])", text.lower())}
    found = dc.find_leaks(frame, bench, shortest=1).collect()
    assert len(found) == len(plain) and {(r.doc_id, r.item_id) for r in found} == plain and all(r.edits == 0 for r in found)
    assert dc.find_leaks(frame, bench).count() == 0
    left = {r.doc_id for r in dc.without_leaks(frame, bench, shortest=1).collect()}
    assert left == {d[0] for d in docs} - {n for n, _ in plain} and dc.without_leaks(frame, bench).count() == len(docs)
