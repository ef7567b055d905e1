"""The n-gram join against brute force, on texts with near copies, and with tiles made small."""

import random
import re

import pytest

from odflux.llm import ngram_join as nj
from odflux.llm.word_arrays import shingle_sets, split_words

SCHEMA = "doc_id long, text string, component_id string, size int"


def brute(rows, width, percent):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets.append({tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(root(i), []).append(doc)
    return sorted(((doc, len(sets[i]), min((d for d in least[root(i)] if d is not None), default=None)) for i, (doc, _) in enumerate(rows)), key=repr)


def near_copies(seed, count):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghij") * draw.randint(1, 3) + draw.choice("klmnop")
    rows, bases = [], [[word() for _ in range(draw.choice([3, 4, 5, 7, 12, 30, 80, 200, 500]))] for _ in range(count // 5)]
    for i in range(count):
        words = list(draw.choice(bases[:3] if i % 3 == 0 else bases))
        for _ in range(draw.choice([0, 0, 1, 1, 2, len(words) // 60])):
            kind, at = draw.randrange(3), draw.randrange(len(words))
            words[at:at + (kind != 2)] = [] if kind == 1 and len(words) > 1 else [word()]
        rows.append((i + 1, draw.choice([" ", "\n"]).join(words)))
    return rows


@pytest.mark.parametrize("percent, width, tile", [(85, 4, 1_024), (85, 4, 8), (80, 5, 8), (100, 4, 1_024), (60, 3, 16)])
def test_against_brute_force(spark, monkeypatch, percent, width, tile):
    monkeypatch.setattr(nj, "TILE_SETS", tile)
    rows = near_copies(percent + tile, 220)
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "one"), (905, "one two"), (None, rows[0][1]), (None, None),
             (906, "A B C D"), (907, "a b c d"), rows[3], rows[3], (908, "é É"), (909, "é é"), (910, "w " * 100_000)]
    frame = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    got = nj.ngram_components(frame, width=width, percent=percent)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, width, percent)


def test_empty_table_and_nothing_linked(spark):
    assert nj.ngram_components(spark.createDataFrame([], SCHEMA)).count() == 0
    got = nj.ngram_components(spark.createDataFrame([(2, "a b c d e", "", 0), (1, "f g h i j", "", 0)], SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [(1, 2, 1), (2, 2, 2)]


def test_parts_of_linking_sets_agree():
    """Any set within the allowed difference shares a key, at sizes around the bounds of bands."""
    draw = random.Random(9)
    bands = nj.Bands(85)
    for size in [7, 8, 13, 14, 20, 33, 50, 51, 77, 100, 118, 400]:
        for _ in range(30):
            pool = [draw.getrandbits(64) for _ in range(size + 60)]
            a = set(pool[:size])
            drop = draw.randint(0, nj.most_apart(size, 85))
            b = set(pool[drop:size]) | set(pool[size:size + draw.randint(0, nj.most_apart(size, 85))])
            if a == b or 100 * len(a & b) < 85 * len(a | b):
                continue
            import numpy as np
            keys = [set(nj.part_keys(np.array(sorted(s), dtype=np.uint64), bands).tolist()) for s in (a, b)]
            assert keys[0] & keys[1]


def test_words_and_shingles():
    found = split_words(["Ab cD\x0bé", None, "", "x"])
    assert [bytes(found.buffer[a:b]).decode() for a, b in zip(found.starts, found.ends)] == ["ab", "cd", "é", "x"]
    assert found.first.tolist() == [0, 3, 3, 3, 4]
    sizes = [len(s) for s in shingle_sets(["a b c d", "a b c", "", None, "a a a a a a", "c b a"], 4)]
    assert sizes == [1, 1, 0, 0, 1, 1]
