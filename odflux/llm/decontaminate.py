"""Benchmark decontamination: CGK random walks, bit-sampling LSH over item-sized windows, exact edit check.

Words are lower-cased runs of letters and digits. A CGK walk reads a word at each
step and moves on by one random bit of (word, step), so a few edits between two
word sequences change few of the words read: edit distance becomes Hamming
distance. A repetition is one walk with its own bits; each of its bands samples a
few steps, and the words read there are the key. Every third word of a text starts a
window for each length class of items, and an item is sketched from each of its
first three words, so one of them is where a window starts. Only windows that hold
enough of the class's vocabulary to be within the allowed edits of any of its items
are walked, which loses nothing. Repetitions are added until edited copies of the items themselves, at
the greatest allowed distance, are found at the target recall. A length class that
is not there after ``MOST_REPETITIONS`` (long items, many edits) is found by segments
instead, which misses nothing: of one segment more than the allowed edits, one
stands unedited in every copy. Each candidate is settled by the exact edit distance
between the item and the best passage there.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from odflux.llm.common import ship_package, slices
from odflux.llm.word_arrays import mix, split_words

#: Benchmark items that one pass over the texts carries along; a longer benchmark takes more passes.
ITEMS_A_PASS = 5_000
#: Words from which an item is evidence by itself; of shorter ones no word may be edited, and they are looked for on request.
SHORTEST_ITEM = 5
STRIDE = 3
BANDS, SAMPLED = 4, 3
MOST_REPETITIONS = 24
_SLOTS = 1 << 20

_GAP = np.zeros(256, dtype=bool)
_GAP[:128] = [not chr(c).isalnum() for c in range(128)]


@dataclass
class LengthClass:
    """Items of similar length, and what finds them: per repetition the step multipliers and the sampled steps."""

    low: int
    edits: int
    items: list[int]
    multipliers: list[np.ndarray] = field(default_factory=list)
    sampled: list[np.ndarray] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)  # sorted, one array per repetition and band
    owners: list[np.ndarray] = field(default_factory=list)
    segment: int = 0  # words of a segment; where set, keys and owners are those of segments, sorted as one
    offsets: np.ndarray | None = None  # place of each segment in its item


def _slot(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64(_SLOTS - 1)).astype(np.int64)


def allowed_edits(words: int, share: float) -> int:
    return int(words * share)


def walk_keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, multipliers: np.ndarray, sampled: np.ndarray) -> np.ndarray:
    """Keys of each window, one column a band. Behind its end a window reads zeros."""
    at = starts.copy()
    read = {int(s) for s in sampled.ravel()}
    seen: dict[int, np.ndarray] = {}
    for step in range(max(read) + 1):
        inside = at < ends
        word = np.where(inside, words[np.minimum(at, len(words) - 1)], np.uint64(0))
        if step in read:
            seen[step] = word
        at = at + ((word * multipliers[step]) >> np.uint64(63)).astype(np.int64)
    out = np.zeros((len(starts), len(sampled)), dtype=np.uint64)
    for band, steps in enumerate(sampled.tolist()):
        for step in steps:
            out[:, band] = mix(out[:, band] + seen[step])
    return out


def run_keys(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Keys of the runs of ``size`` words from each start."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for step in range(size):
        out = mix(out + words[starts + step])
    return out


def passage_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, begin, end) of the passage of ``text`` nearest to the item in word edits; the earliest end of several."""
    n = len(text)
    row, begin = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    place = np.arange(n + 1)
    for i, word in enumerate(item, 1):
        change = np.empty(n + 1, dtype=np.int64)
        change[0] = i
        down, diagonal = row[1:] + 1, row[:-1] + (text != word)
        change[1:] = np.minimum(down, diagonal)
        origin = np.concatenate([[0], np.where(diagonal <= down, begin[:-1], begin[1:])])
        # Skipping words of the text: the least of (value - place) so far, plus the place.
        moved = change - place
        least = np.minimum.accumulate(moved)
        source = np.maximum.accumulate(np.where(moved == least, place, 0))
        row, begin = least + place, origin[source]
    end = int(row.argmin())
    return int(row[end]), int(begin[end]), end


class BenchmarkIndex:
    """Length classes with their keys for a bounded list of (item id, text)."""

    def __init__(self, items: list[tuple[object, str | None]], share: float, recall: float, seed: int = 7, shortest: int = SHORTEST_ITEM):
        self.share, self.ids = share, [i for i, _ in items]
        found = split_words([t and t.lower() for _, t in items], gap=_GAP)
        hashes = found.hashes()
        self.items = [hashes[a:b] for a, b in zip(found.first[:-1], found.first[1:])]
        self.vocabulary = np.zeros(_SLOTS, dtype=np.uint32)  # bit c: a word of class c may have this slot
        self.classes: list[LengthClass] = []
        low = SHORTEST_ITEM
        longest = max([len(i) for i in self.items], default=0)
        while low <= longest:
            high = max(low + 1, math.ceil(low * 1.33))
            members = [k for k, words in enumerate(self.items) if low <= len(words) < high]
            if members:
                edits = max(allowed_edits(len(self.items[k]), share) for k in members)
                for k in members:
                    self.vocabulary[_slot(self.items[k])] |= np.uint32(1 << len(self.classes) % 32)
                self.classes.append(LengthClass(low, edits, members))
            low = high
        self.cut: set[int] = set()  # items found by segments
        bits, draw = np.random.default_rng(seed), random.Random(seed)
        for one in self.classes:
            missed = self._edited(one, draw)
            tried = len(missed)
            while len(one.multipliers) < 2 or (len(missed) > (1 - recall) * tried and len(one.multipliers) < MOST_REPETITIONS):
                self._repeat(one, bits)
                missed = [(k, words) for k, words in missed if not self._meets(one, k, words)]
            if len(missed) > (1 - recall) * tried:
                self._cut(one)
        for size in range(shortest, SHORTEST_ITEM):  # behind the others, whose bits of the vocabulary go by place
            members = [k for k, words in enumerate(self.items) if len(words) == size]
            if members:
                self.classes.append(LengthClass(size, allowed_edits(size, share), members))
                self._cut(self.classes[-1])

    def _edited(self, one: LengthClass, draw: random.Random) -> list[tuple[int, np.ndarray]]:
        """Copies of items at the greatest allowed distance: words replaced, dropped and put in at random places."""
        pool = np.concatenate([self.items[k] for k in one.items])
        copies = []
        for number in range(max(200, len(one.items))):
            k = one.items[number % len(one.items)]
            words = self.items[k].tolist()
            for _ in range(allowed_edits(len(words), self.share)):
                at, kind = draw.randrange(len(words)), draw.randrange(3)
                other = int(pool[draw.randrange(len(pool))])
                words[at:at + (kind != 2)] = [] if kind == 1 and len(words) > 1 else [other]
            copies.append((k, np.array(words, dtype=np.uint64)))
        return copies

    def _repeat(self, one: LengthClass, bits: np.random.Generator) -> None:
        steps = max(SAMPLED + 1, int(1.6 * (one.low - STRIDE + 1)))
        one.multipliers.append(bits.integers(0, 1 << 63, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        one.sampled.append(np.stack([np.sort(bits.choice(steps, SAMPLED, replace=False)) for _ in range(BANDS)]))
        words = np.concatenate([self.items[k] for k in one.items])
        sizes = np.array([len(self.items[k]) for k in one.items])
        ends = np.repeat(np.cumsum(sizes), STRIDE)
        starts = ends - np.repeat(sizes, STRIDE) + np.tile(np.arange(STRIDE), len(sizes))
        keys = walk_keys(words, starts, ends, one.multipliers[-1], one.sampled[-1])
        for band in range(BANDS):
            order = np.argsort(keys[:, band], kind="stable")
            one.keys.append(keys[order, band])
            one.owners.append(np.repeat(one.items, STRIDE)[order])

    def _cut(self, one: LengthClass) -> None:
        """Finds the class by segments: each item is cut into one more than its edits, which cannot all be edited."""
        parts = [min(allowed_edits(len(self.items[k]), self.share) + 1, len(self.items[k])) for k in one.items]
        one.segment = min(len(self.items[k]) // n for k, n in zip(one.items, parts))
        keys, offsets = [], []
        for k, n in zip(one.items, parts):
            offsets.append(np.arange(n) * (len(self.items[k]) // n))
            keys.append(run_keys(self.items[k], offsets[-1], one.segment))
        found, owners = np.concatenate(keys), np.repeat(one.items, parts)
        order = np.argsort(found, kind="stable")
        one.keys, one.owners, one.offsets = [found[order]], [owners[order]], np.concatenate(offsets)[order]
        one.multipliers, one.sampled = [], []
        self.cut.update(one.items)

    @staticmethod
    def _meets(one: LengthClass, item: int, words: np.ndarray) -> bool:
        starts = np.arange(0, len(words), STRIDE)[:2]
        keys = walk_keys(words, starts, np.full(len(starts), len(words)), one.multipliers[-1], one.sampled[-1])
        for band in range(BANDS):
            own, owners = one.keys[band - BANDS], one.owners[band - BANDS]
            for key in keys[:, band]:
                a, b = np.searchsorted(own, key, "left"), np.searchsorted(own, key, "right")
                if item in owners[a:b]:
                    return True
        return False

    @staticmethod
    def _segment_candidates(one: LengthClass, words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """(begin of the passage if no word were put in or left out before the segment, item) of each segment in a text."""
        places = np.arange(len(words) - one.segment + 1)
        keys = run_keys(words, places, one.segment)
        a, b = np.searchsorted(one.keys[0], keys, "left"), np.searchsorted(one.keys[0], keys, "right")
        hit = np.flatnonzero(b > a)
        if not len(hit):
            return []
        size = (b - a)[hit]
        at = np.repeat(a[hit] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        place = np.repeat(places[hit], size)
        begin = first[np.searchsorted(first, place, side="right") - 1]
        return [np.unique(np.stack([np.maximum(place - one.offsets[at], begin), one.owners[0][at]], axis=1), axis=0)]

    def find(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, edits, first word, word after the last) of each item found, its best passage of that text."""
        found = split_words([t and t.lower() for t in texts], gap=_GAP)
        words = found.hashes()
        if not len(words):
            return
        known = self.vocabulary[_slot(words)]
        sizes = np.diff(found.first)
        windows = np.flatnonzero((np.arange(len(words)) - np.repeat(found.first[:-1], sizes)) % STRIDE == 0)
        limit = np.repeat(found.first[1:], sizes)[windows]
        candidates: list[np.ndarray] = []
        for number, one in enumerate(self.classes):
            if one.segment:
                candidates += self._segment_candidates(one, words, found.first)
                continue
            total = np.concatenate([[0], np.cumsum((known >> np.uint32(number % 32)) & np.uint32(1), dtype=np.int64)])
            span = one.low - STRIDE + 1
            chosen = total[np.minimum(windows + span, limit)] - total[windows] >= span - one.edits
            starts, ends = windows[chosen], limit[chosen]
            if not len(starts):
                continue
            for r, multipliers in enumerate(one.multipliers):
                keys = walk_keys(words, starts, ends, multipliers, one.sampled[r])
                for band in range(BANDS):
                    own, owners = one.keys[r * BANDS + band], one.owners[r * BANDS + band]
                    a, b = np.searchsorted(own, keys[:, band], "left"), np.searchsorted(own, keys[:, band], "right")
                    hit = np.flatnonzero(b > a)
                    size = (b - a)[hit]
                    if len(hit):
                        at = np.repeat(a[hit] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                        candidates.append(np.stack([np.repeat(starts[hit], size), owners[at]], axis=1))
        if not candidates:
            return
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        for start, item in np.unique(np.concatenate(candidates), axis=0).tolist():
            own = self.items[item]
            text = int(np.searchsorted(found.first, start, side="right")) - 1
            if start <= done.get((text, item), -1) or best.get((text, item), (1,))[0] == 0:
                continue  # the passage looked at last covers what this window could add
            edits = allowed_edits(len(own), self.share)
            begin = max(int(found.first[text]), start - STRIDE - edits)
            end = min(int(found.first[text + 1]), start + len(own) + 2 * edits)
            if item in self.cut:
                # A segment's place tells the begin of the passage to within the edits, also that of the windows passed over.
                end = min(int(found.first[text + 1]), start + len(own) + 3 * edits)
                done[text, item] = start + edits
            if np.isin(own, words[begin:end]).sum() < len(own) - edits:
                continue  # too few of its words are here
            done[text, item] = start + edits
            distance, a, b = passage_distance(own, words[begin:end])
            if distance <= edits and (distance, begin + a) < best.get((text, item), (len(own) + 1, 0, 0))[:2]:
                best[text, item] = (distance, begin + a, begin + b)
        for (text, item), (distance, a, b) in sorted(best.items()):
            yield text, item, distance, a - int(found.first[text]), b - int(found.first[text])


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.2, recall: float = 0.99, shortest: int = SHORTEST_ITEM) -> DataFrame:
    """(doc_id, item_id, item_words, edits, first_word, end_word): benchmark items that a text holds, with at most ``share`` word edits.

    The best passage of each item and text is given, places counted in words of
    the text. Items of fewer than ``shortest`` words are not reported: few words are
    no evidence that a text was copied. With ``shortest`` 1 all items are found.
    Null and blank texts on either side are never reported. Repeated rows
    give repeated results. The items are read in passes of ``ITEMS_A_PASS``, which
    bounds what the driver and each task hold of a benchmark of any size.
    """
    ship_package(docs.sparkSession)
    schema = (f"doc_id {dict(docs.dtypes)['doc_id']}, item_id {dict(benchmark.dtypes)['item_id']}, "
              "item_words int, edits int, first_word int, end_word int")
    id_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    passes, block = [], []

    def one_pass(items: list[tuple[object, str | None]]) -> DataFrame:
        index = BenchmarkIndex(items, share, recall, shortest=shortest)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, rows = batch.column("text").to_pylist(), []
                for a, b in slices(texts):
                    rows += [(a + text, item, *rest) for text, item, *rest in index.find(texts[a:b])]
                ids = pa.array([index.ids[r[1]] for r in rows], type=id_type)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())), ids,
                     pa.array([len(index.items[r[1]]) for r in rows], pa.int32()),
                     *[pa.array([r[k] for r in rows], pa.int32()) for k in (2, 3, 4)]],
                    ["doc_id", "item_id", "item_words", "edits", "first_word", "end_word"])

        return source.mapInArrow(scan, schema)

    for row in benchmark.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        block.append((row.item_id, row.text))
        if len(block) == ITEMS_A_PASS:
            passes.append(one_pass(block))
            block = []
    if block or not passes:
        passes.append(one_pass(block))
    out = passes[0]
    for more in passes[1:]:
        out = out.union(more)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.2, recall: float = 0.99, shortest: int = SHORTEST_ITEM) -> DataFrame:
    """Rows of ``docs`` whose text holds no benchmark item of ``shortest`` words; rows without an id are judged by their own text too."""
    tagged = docs.withColumn("__text_hash", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    leaks = (find_leaks(tagged.select(F.col("__text_hash").alias("doc_id"), "text"), benchmark, share, recall, shortest)
             .select(F.col("doc_id").alias("__text_hash")).distinct())
    return tagged.join(leaks, "__text_hash", "left_anti").drop("__text_hash")
