"""Quality and toxicity: held-out accuracy, the automaton against plain edit distance, and odd inputs."""

import random

import numpy as np

from odflux.llm import quality, toxicity

DOCS, LABELS = "doc_id long, text string, score int, label string", "doc_id long, quality int, toxic int, text string"
BAD = ["blasted", "wretched", "rotten", "beastly"]


def corpus(count, seed=1):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(count):
        words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(draw.randint(20, 60))]
        poor, rude = draw.random() < 0.3, draw.random() < 0.25
        if rude:
            for _ in range(4):
                words.insert(draw.randrange(len(words)), draw.choice(BAD))
        if poor:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words), 0, "x"))
        labels.append((i, int(not poor), int(rude), None))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_is_edit_distance():
    draw = random.Random(6)
    terms = ["cat", "rotten", "rottener", "wretched", "été12", "beastly"]
    lexicon = toxicity.FuzzyLexicon(terms)
    words = list(terms)
    for _ in range(3_000):
        word = list(draw.choice(terms))
        for _ in range(draw.randint(0, 2)):
            kind, at = draw.randrange(3), draw.randrange(len(word))
            word[at:at + (kind != 2)] = [] if kind == 1 and len(word) > 1 else [draw.choice("rotenzé1")]
        words.append("".join(word))
    codes = np.array([ord(c) for w in words for c in w], dtype=np.uint32)
    ends = np.cumsum([len(w) for w in words])
    state = lexicon.match(codes, ends - [len(w) for w in words], ends)
    for word, s in zip(words, state):
        near = min((edits(word, t), k) for k, t in enumerate(lexicon.terms) if edits(word, t) <= (1 if len(t) >= 5 else 0)
                   ) if any(edits(word, t) <= (1 if len(t) >= 5 else 0) for t in lexicon.terms) else None
        assert (None if lexicon.term[s] < 0 else (int(lexicon.edits[s]), int(lexicon.term[s]))) == near, word


def test_hits_know_quotations_and_misspellings():
    lexicon = toxicity.FuzzyLexicon(BAD)
    rows = toxicity.hit_counts(lexicon, ["you wretched rottten thing", 'he called it "wretched" once', "", None, "fine words only"])
    names = dict(zip(toxicity.FEATURES, rows.T))
    assert (names["exact_open"] > 0).tolist() == [True, False, False, False, False]
    assert (names["near_open"] > 0).tolist() == [True, False, False, False, False]
    assert (names["exact_quoted"] > 0).tolist() == [False, True, False, False, False]


def test_open_words_between_two_quotations_are_not_quoted():
    lexicon = toxicity.FuzzyLexicon(BAD)
    names = lambda *texts: dict(zip(toxicity.FEATURES, toxicity.hit_counts(lexicon, list(texts)).T))
    got = names('"hello there" you wretched ones "bye"', 'she said "you wretched ones" then', '"one" and "wretched two" and "three"', 'an "odd mark\nyou wretched ones "bye"',
                '«a» wretched «b»', '„so wretched“')
    assert (got["exact_open"] > 0).tolist() == [True, False, False, True, True, False]
    assert (got["exact_quoted"] > 0).tolist() == [False, True, True, False, False, True]


def test_held_out_accuracy(spark):
    docs, labels = frames(spark, *corpus(900))
    truth = {r.doc_id: r for r in labels.collect()}
    for found, name in ((quality.score_quality(docs, labels), "quality"), (toxicity.score_toxicity(docs, labels), "toxic")):
        held = [r for r in found.collect() if r.held_out]
        assert len(held) > 100 and np.mean([r.predicted == truth[r.doc_id][name] for r in held]) > 0.97
        assert all(0 <= r.score <= 1 for r in held)


def test_odd_rows(spark):
    docs, labels = corpus(300)
    docs += [(None, "text", 0, ""), (1_000, None, 0, ""), (1_001, "", 0, ""), (1_002, "word " * 300_000, 0, ""), docs[0], docs[0]]
    labels += [(None, 1, 1, ""), (1_001, None, None, ""), (7, 1, 0, ""), (1_002, 5, -1, ""), (99_999, 1, 1, "")]
    docs, labels = frames(spark, docs, labels)
    for score in (quality.score_quality, toxicity.score_toxicity):
        got = score(docs, labels).collect()
        assert len(got) == docs.count() and all(r.score is not None and 0 <= r.score <= 1 for r in got)
        blank = {r.score for r in got if r.doc_id in (1_000, 1_001)}
        assert len(blank) == 1
        assert score(docs.limit(0), labels).count() == 0
        bare = score(docs, labels.limit(0)).collect()
        assert len(bare) == docs.count() and len({r.score for r in bare}) == 1
        assert score(docs, labels.where("toxic = 0 and quality = 1")).count() == docs.count()


def test_held_out_rows_do_not_teach(spark):
    import zlib
    docs, labels = corpus(300)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, x) for i, q, t, x in labels]
    for score in (quality.score_quality, toxicity.score_toxicity):
        a, b = ({r.doc_id: round(r.score, 9) for r in score(*frames(spark, docs, rows)).collect()} for rows in (labels, turned))
        assert a == b
