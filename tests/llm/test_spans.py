"""Sliding sentence spans against a brute-force version."""

import random

from odflux.llm import sentence_spans as ss

SCHEMA = "doc_id long, text string, removed_words string, hash int"


def brute(rows):
    """Texts left per (id, text): spans are compared as word tuples, in order of (id, place), null ids first."""
    seen, out = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        found, starts, _, first, last, hashes = ss.spans([text])
        for k in range(len(hashes)):
            held = tuple(bytes(found.buffer[found.starts[i]:found.ends[i]]) for i in range(starts[first[k]], starts[last[k] + 1]))
            seen.setdefault(held, (doc, int(first[k])))
    for doc, text in rows:
        found, starts, _, first, last, hashes = ss.spans([text])
        told = []
        for k in range(len(hashes)):
            held = tuple(bytes(found.buffer[found.starts[i]:found.ends[i]]) for i in range(starts[first[k]], starts[last[k] + 1]))
            if seen[held] != (doc, int(first[k])):
                told.append({"place": int(first[k]), "hash": int(hashes[k].astype("int64"))})
        out[doc, text] = next(iter(ss.cut_texts([text], [told], ss.SENTENCES, ss.SPAN_WORDS)))
    return out


def prose(draw, n):
    return " ".join("".join(draw.choice("abcdefghé") for _ in range(draw.randint(1, 7))) + draw.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def test_against_brute_force(spark):
    draw = random.Random(4)
    passages = [prose(draw, 60) for _ in range(4)]
    rows = []
    for i in range(150):
        body = prose(draw, draw.randint(0, 120))
        rows.append((i, f"{body} {draw.choice(passages)} {prose(draw, 20)}" if i % 3 else body))
    rows += [(500 + i, rows[1][1]) for i in range(60)] + [rows[2], rows[2], (None, rows[4][1]), (None, None), (700, None), (701, ""), (702, " \n "),
                                                         (703, "again " * 200), (704, f"  {passages[0]}  ")]
    rows += [(705, "x y z. " * 60_000)]
    got = ss.remove_repeated_spans(spark.createDataFrame([(*r, "w", 1) for r in rows], SCHEMA).repartition(5))
    truth = brute(rows)
    left = sorted(((r.doc_id, r.text, r.removed_sentences, r.removed_words) for r in got.collect()), key=repr)
    assert left == sorted(((d, *truth[d, t]) for d, t in rows), key=repr)
    for passage in passages:
        middle = " ".join(passage.split()[15:45])
        assert sum(middle in " ".join((r[1] or "").split()) for r in left) <= 1


def test_empty_and_untouched(spark):
    docs = spark.createDataFrame([(1, "one. two. three.", "", 0), (2, "one. two. three.", "", 0)], SCHEMA)
    assert {r.text for r in ss.remove_repeated_spans(docs).collect()} == {"one. two. three."}  # too few words for a span
    assert ss.remove_repeated_spans(docs.limit(0)).count() == 0
