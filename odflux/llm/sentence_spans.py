"""Substring dedup by sliding sentence spans.

A text is cut into sentences: after a word that ends in a mark, at a line break,
and after every word of an eighth of the vocabulary, so that a passage without
marks is cut too, and alike wherever it stands.
From every sentence starts a span: as few sentences as make several sentences
and enough words. Spans are hashed and brought together over the whole table;
every sentence of a span that is not the first of its hash is removed.

Equal spans of one batch are settled before the shuffle, so a span that a third
of all texts hold sends one row a batch; the rest streams through a sorted pass
that keeps one row in memory. No group is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.llm.common import ship_package, slices
from odflux.llm.word_arrays import Words, mix, split_words

SENTENCES, SPAN_WORDS = 3, 20

#: Fixed value: marks after which a sentence, or a clause of one, may end.
_MARKS = np.zeros(256, dtype=bool)
_MARKS[[ord(c) for c in ".!?,;:|"]] = True

_P = np.uint64(0x9E3779B97F4A7C15)
_UNP = np.uint64(pow(int(_P), -1, 1 << 64))


def sentence_starts(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Places of the words that begin a sentence."""
    n = len(hashes)
    begins = np.zeros(n, dtype=bool)
    begins[words.first[:-1][np.diff(words.first) > 0]] = True
    ended = _MARKS[words.buffer[words.ends - 1]]
    lines = np.concatenate([[0], np.cumsum(words.buffer == 0x0A)])
    broken = lines[words.starts[1:]] > lines[words.ends[:-1]]
    begins[1:] |= ended[:-1] | broken
    begins[1:] |= hashes[:-1] >> np.uint64(61) == 0
    # One word over and over has no such place, or only such places: it is cut where it starts, ends, and at every eighth.
    change = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    change[words.first[:-1][np.diff(words.first) > 0]] = True
    run = np.flatnonzero(change)
    size = np.diff(np.append(run, n))
    many = np.repeat(size >= 8, size)
    begins[many] = ((np.arange(n) - np.repeat(run, size)) % 8 == 0)[many]
    begins[1:] |= many[:-1] & change[1:]
    begins[words.first[:-1][np.diff(words.first) > 0]] = True
    return np.flatnonzero(begins)


def spans(texts: list[str | None], sentences: int = SENTENCES, span_words: int = SPAN_WORDS):
    """(words, sentence starts with the end appended, text of each span, its first and last sentence, its hash).

    Sentences count within the whole list; a text that ends before a span is
    complete has no span there.
    """
    words = split_words(texts)
    hashes = words.hashes()
    n = len(hashes)
    if not n:
        nothing = np.zeros(0, np.int64)
        return words, np.zeros(1, np.int64), nothing, nothing, nothing, np.zeros(0, np.uint64)
    starts = np.append(sentence_starts(words, hashes), n)
    first = np.arange(len(starts) - 1)
    last = np.maximum(first + sentences - 1, np.searchsorted(starts, starts[:-1] + span_words) - 1)
    text = np.searchsorted(words.first, starts[:-1], side="right") - 1
    fits = last < len(first)
    fits[fits] &= text[last[fits]] == text[first[fits]]
    first, last, text = first[fits], last[fits], text[fits]
    power = np.full(n, _P, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    back = np.full(n, _UNP, dtype=np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * power, out=sums[1:])
    begin, end = starts[first], starts[last + 1]
    return words, starts, text, first, last, mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def _span_rows(batches: Iterator[pa.RecordBatch], sentences: int, span_words: int) -> Iterator[pa.RecordBatch]:
    """(hash, doc, place, later): one row per distinct hash of a batch, its least place; the others are known to be later ones."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        found, docs, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in slices(texts):
            words, starts, text, first, _, hashes = spans(texts[a:b], sentences, span_words)
            origin = np.searchsorted(starts, words.first)
            found.append(hashes)
            docs.append(text + a)
            places.append(first - origin[text])
        hashes, doc, place = np.concatenate(found), np.concatenate(docs), np.concatenate(places)
        rank = np.empty(batch.num_rows, dtype=np.int64)
        names = batch.column("doc").to_pylist()
        rank[sorted(range(len(names)), key=lambda i: (names[i] is not None, names[i]))] = np.arange(len(names))
        order = np.lexsort((place, rank[doc], hashes))
        hashes, doc, place = hashes[order], doc[order], place[order]
        head = np.concatenate([[True], hashes[1:] != hashes[:-1]])[:len(hashes)]
        # A row of the same id at the same place is the same place, not a later one.
        at = np.maximum.accumulate(np.where(head, np.arange(len(hashes)), 0))
        ids = np.unique(np.array([str(n) for n in names], dtype=object), return_inverse=True)[1] if names else np.zeros(0, np.int64)
        later = ~head & ~((ids[doc] == ids[doc[at]]) & (place == place[at]))
        keep = head | later
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes[keep].view(np.int64)), batch.column("doc").take(pa.array(doc[keep])),
             pa.array(place[keep].astype(np.int32)), pa.array(later[keep])], ["hash", "doc", "place", "later"])


def _later_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that are not the first of their hash; rows come sorted by (hash, doc, place)."""
    last, first_doc, first_place = None, None, None
    for batch in batches:
        hashes, place = batch.column("hash").to_numpy(), batch.column("place").to_numpy()
        later = batch.column("later").to_numpy(zero_copy_only=False)
        n = len(hashes)
        if not n:
            continue
        head = np.concatenate([[last is None or hashes[0] != last], hashes[1:] != hashes[:-1]])
        suspects = np.flatnonzero(~head & ~later)
        doc = batch.column("doc")
        begin = np.maximum.accumulate(np.where(head, np.arange(n), -1))
        same = [i for i in suspects.tolist()
                if place[i] == (place[begin[i]] if begin[i] >= 0 else first_place)
                and doc[i].as_py() == (doc[int(begin[i])].as_py() if begin[i] >= 0 else first_doc)]
        out = ~head | later
        out[same] = False
        last = hashes[-1]
        if begin[-1] >= 0:
            first_doc, first_place = doc[int(begin[-1])].as_py(), place[begin[-1]]
        at = pa.array(np.flatnonzero(out))
        yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in ("doc", "place", "hash")], ["doc", "place", "hash"])


def cut_texts(texts: list[str | None], removals: list[list[dict] | None], sentences: int, span_words: int) -> Iterator[tuple[str | None, int, int]]:
    """(text that is left, sentences removed, words removed) of each text with its removals of (place, hash)."""
    for a, b in slices(texts):
        words, starts, text, first, last, hashes = spans(texts[a:b], sentences, span_words)
        origin = np.searchsorted(starts, words.first)
        cuts = np.searchsorted(text, np.arange(b - a + 1))
        for i in range(b - a):
            told = removals[a + i]
            if not told or texts[a + i] is None:
                yield texts[a + i], 0, 0
                continue
            wanted = {(r["place"], r["hash"]) for r in told}
            gone = np.zeros(int(origin[i + 1] - origin[i]), dtype=bool)
            for k in range(cuts[i], cuts[i + 1]):
                place = int(first[k] - origin[i])
                if (place, int(hashes[k].astype(np.int64))) in wanted:
                    gone[place:int(last[k] - origin[i]) + 1] = True
            raw, shift = texts[a + i].encode(), int(words.starts[words.first[i]])
            shift -= len(raw) - len(raw.lstrip(b" \t\n\v\f\r"))
            edges = [int(words.starts[starts[origin[i] + k]]) - shift for k in range(len(gone))] + [len(raw)]
            kept = [raw[:edges[0]], *[raw[edges[k]:edges[k + 1]] for k in range(len(gone)) if not gone[k]]]
            size = np.diff(starts[origin[i]:origin[i + 1] + 1])
            left = b"".join(kept).decode()
            yield left.rstrip(" \t\n\v\f\r") if gone.any() and gone[-1] else left, int(gone.sum()), int(size[gone].sum())


def remove_repeated_spans(docs: DataFrame, sentences: int = SENTENCES, span_words: int = SPAN_WORDS) -> DataFrame:
    """``docs`` with ``text`` cut, and ``removed_sentences`` and ``removed_words`` (replaced where such columns exist).

    Of equal spans the first stays, by (doc_id, place), null ids first; spans that
    overlap others within one text count as well, so a text that repeats itself
    keeps one round. Case and white space do not matter to equality; words and
    their order do. Rows that share an id are one document: what they hold at the
    same place is the same occurrence. Null stays null; a text whose every sentence
    stands elsewhere before becomes empty, its row stays. What is kept is kept byte
    for byte, but for white space at the end of a text whose end was cut.
    """
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    rows = (docs.select(F.col("doc_id").alias("doc"), F.col("text").cast("string").alias("text"))
            .mapInArrow(lambda it: _span_rows(it, sentences, span_words), f"hash long, doc {kind}, place int, later boolean"))
    spread = F.when(F.col("later"), F.xxhash64("doc", "place")).otherwise(F.col("hash"))
    later = (rows.withColumn("meet", spread).repartition("meet").sortWithinPartitions("hash", "doc", "place").drop("meet")
             .mapInArrow(_later_rows, f"doc {kind}, place int, hash long"))
    removals = (later.groupBy(F.col("doc").alias("__doc")).agg(F.collect_set(F.struct("place", "hash")).alias("__removals")))

    def cut(texts: pa.Array, removed: pa.Array) -> pa.Array:
        done = list(cut_texts(texts.to_pylist(), removed.to_pylist(), sentences, span_words))
        return pa.StructArray.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
                                           pa.array([d[2] for d in done], pa.int64())], ["text", "sentences", "words"])

    touched = F.col("__removals").isNotNull()
    joined = docs.join(removals, docs["doc_id"].eqNullSafe(F.col("__doc")), "left")
    result = joined.withColumn("__cut", F.arrow_udf(cut, "struct<text:string,sentences:long,words:long>")(
        F.when(touched, F.col("text").cast("string")), F.col("__removals")))
    return result.withColumns({
        "text": F.when(touched, F.col("__cut.text")).otherwise(F.col("text")),
        "removed_sentences": F.col("__cut.sentences"), "removed_words": F.col("__cut.words"),
    }).drop("__doc", "__removals", "__cut")
