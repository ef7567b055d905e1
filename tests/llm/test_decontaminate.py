"""Benchmark items, exact and edited, found in texts."""

import random

import numpy as np

from odflux.llm import decontaminate as dc

DOCS, ITEMS = "doc_id long, text string, item_id long, edits int", "item_id long, text string, doc_id long"


def words(draw, n):
    return ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6))) for _ in range(n)]


def nearest(item, text):
    """Least word edits between the item and any passage, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return min(row)


def test_passage_distance_is_the_plain_one():
    draw = random.Random(2)
    for _ in range(200):
        item, text = [[draw.randrange(6) for _ in range(draw.randint(low, 12))] for low in (1, 0)]
        distance, a, b = dc.passage_distance(np.array(item), np.array(text, dtype=np.int64))
        assert distance == nearest(item, text)
        assert nearest(item, text[a:b]) == distance and a <= b


def test_edited_items_are_found_and_clean_texts_left(spark):
    draw = random.Random(3)
    items = [(i, words(draw, draw.randint(6, 60))) for i in range(60)]
    rows, planted = [], set()
    for n in range(400):
        body = words(draw, 80)
        if n % 2:
            i, own = items[n % 60]
            copy = list(own)
            for _ in range(int(len(copy) * draw.choice([0, 0.1, 0.15]))):
                copy[draw.randrange(len(copy))] = words(draw, 1)[0]
            at = draw.randrange(81)
            body[at:at] = [w.upper() + draw.choice(["", ".", "!!"]) for w in copy]
            planted.add((n, i))
        rows.append((n, " ".join(body), 0, 0))
    found = dc.find_leaks(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, " ".join(w), 0) for i, w in items], ITEMS)).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(planted & got) >= 0.99 * len(planted)
    assert got <= planted
    own = dict(items)
    texts = {r[0]: dc.split_words([r[1].lower()], gap=dc._GAP) for r in rows}
    for r in found:
        raw = texts[r.doc_id]
        plain = [bytes(raw.buffer[a:b]).decode() for a, b in zip(raw.starts, raw.ends)]
        assert r.edits == nearest(own[r.item_id], plain) <= 0.2 * r.item_words


def test_long_items_with_many_edits_are_found():
    draw = random.Random(5)
    items = [(i, words(draw, n)) for i, n in enumerate([30] * 5 + [800] * 10)]
    index = dc.BenchmarkIndex([(i, " ".join(w)) for i, w in items], 0.2, 0.99)
    texts = []
    for i, own in items:
        copy = list(own)
        for _ in range(dc.allowed_edits(len(own), 0.2)):
            at, kind = draw.randrange(len(copy)), draw.randrange(3)
            copy[at:at + (kind != 2)] = [] if kind == 1 else words(draw, 1)
        texts.append(" ".join(words(draw, draw.randrange(200)) + copy + words(draw, 50)))
    texts += [" ".join(words(draw, 1000)), None, "", "a"]
    got = list(index.find(texts))
    own = {i: w for i, w in items}
    assert {i for t, i, *_ in got if t == i} >= set(range(5, 15))
    assert all(t == i for t, i, *_ in got)
    for t, i, edits, a, b in got[-3:]:
        assert edits == nearest(own[i], texts[t].split()) == nearest(own[i], texts[t].split()[a:b])
    assert not list(index.find(["a"])) and not list(index.find([None]))


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(dc, "ITEMS_A_PASS", 2)
    item = "Élan one two three four five six seven"
    items = spark.createDataFrame([(1, item, 0), (1, item, 0), (2, None, 0), (3, "", 0), (None, "alpha beta gamma delta epsilon", 0), (5, "too short", 0)], ITEMS)
    docs = spark.createDataFrame([(1, f"x {item.upper()}!", 0, 0), (1, f"x {item.upper()}!", 0, 0), (2, None, 0, 0), (3, "", 0, 0), (4, "too short", 0, 0),
                                  (None, "alpha beta gamma delta epsilon", 0, 0), (6, "clean " * 300_000 + item, 0, 0)], DOCS)
    got = sorted(((r.doc_id, r.item_id) for r in dc.find_leaks(docs, items).collect()), key=repr)
    assert got == sorted([(1, 1)] * 4 + [(None, None)] + [(6, 1)] * 2, key=repr)
    assert sorted(r.doc_id for r in dc.without_leaks(docs, items).collect()) == [2, 3, 4]
    assert dc.find_leaks(docs, items.limit(0)).count() == 0 and dc.find_leaks(docs.limit(0), items).count() == 0
    assert dc.without_leaks(docs, items.limit(0)).count() == 7


def test_ids_of_any_type(spark):
    item = "alpha beta gamma delta epsilon zeta"
    for kind, one in (("int", 7), ("short", 7), ("string", "q7"), ("long", 7)):
        items = spark.createDataFrame([(one, item)], f"item_id {kind}, text string")
        docs = spark.createDataFrame([(one, f"so {item} it is")], f"doc_id {kind}, text string")
        found = dc.find_leaks(docs, items)
        assert [(r.doc_id, r.item_id, r.edits) for r in found.collect()] == [(one, one, 0)] and dict(found.dtypes)["item_id"] == items.dtypes[0][1]
