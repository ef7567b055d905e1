"""Toxicity: a lexicon trie met by Levenshtein automata, then a score over what stands around each hit.

The lexicon is learned from labelled rows: words that occur in far more toxic
than clean texts. All its words form a trie; the product of the trie with the
automaton "at most so many edits" is made deterministic once and becomes a plain
table, over which all words of a batch advance together, letter by letter. Few
words live beyond their first letters. Words near a term that clean texts use too
are entries that count as nothing, so short terms can be met misspelled as well.

Hits are counted apart as exact or misspelled and as open or quoted, with how
many stand near another one; a logistic model over these counts gives the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.llm.common import crc_bucket, cut_lineage, slices
from odflux.llm.labelled import TRAINING_ROWS, training_rows

#: Fixed value: marks that open or close a quotation.
QUOTES = "\"“”„«»‹›"
FEATURES = ("exact_open", "near_open", "exact_quoted", "near_quoted", "terms", "clustered", "per_hundred_words")

#: Terms that one automaton holds; a larger lexicon has several, and a word is met by all of them.
TERMS_AN_AUTOMATON = 1_000
#: Letters from which a term is met misspelled too, by itself and where ordinary words are known not to be it.
SHORTEST_FUZZY, SHORTEST_LEARNED = 5, 3
#: Clean labelled texts that make a word ordinary.
ORDINARY_TEXTS = 2
CONTEXT_WORDS = 8
LIFT = 10.0


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Over all code points: is it part of a word, and its lower-case form where that is one code point."""
    every = [chr(c) for c in range(0x110000)]
    inside = np.fromiter((c.isalnum() for c in every), dtype=bool, count=len(every))
    low = np.fromiter((ord(x) if len(x := c.lower()) == 1 else i for i, c in enumerate(every)), dtype=np.uint32, count=len(every))
    return inside, low


class FuzzyLexicon:
    """Deterministic product of a lexicon trie and a Levenshtein automaton.

    ``table[state, letter class]`` is the next state; state 0 is dead, 1 the start.
    ``term[state]`` is the accepted entry or -1, ``edits[state]`` its distance. Of
    several entries the nearest counts, then the first. Entries shorter than
    ``shortest`` letters are only met exactly. ``ordinary`` words are entries that
    are met exactly and count as nothing, however near to a term they are.
    """

    def __init__(self, terms: list[str], most_edits: int = 1, shortest: int = SHORTEST_FUZZY, ordinary: Iterable[str] = ()):
        self.terms = sorted(set(terms))
        entries = [*self.terms, *sorted(set(ordinary) - set(self.terms))]
        limit = [most_edits if n < len(self.terms) and len(w) >= shortest else 0 for n, w in enumerate(entries)]
        children: list[dict[str, int]] = [{}]
        ends, allowed = [-1], [0]
        for number, word in enumerate(entries):
            at, edits = 0, limit[number]
            for letter in word:
                if letter not in children[at]:
                    children[at][letter] = len(children)
                    children.append({})
                    ends.append(-1)
                    allowed.append(0)
                allowed[at] = max(allowed[at], edits)
                at = children[at][letter]
            allowed[at] = max(allowed[at], edits)
            ends[at] = number
        alphabet = sorted({c for word in entries for c in word})
        self.classes = {c: i + 1 for i, c in enumerate(alphabet)}

        def closed(pairs: dict[int, int]) -> frozenset:
            """Add what skipping letters of the lexicon reaches; of a node only the fewest edits matter."""
            todo = list(pairs.items())
            while todo:
                node, edits = todo.pop()
                for child in children[node].values():
                    if edits < allowed[child] and edits + 1 < pairs.get(child, 99):
                        pairs[child] = edits + 1
                        todo.append((child, edits + 1))
            return frozenset((n, e) for n, e in pairs.items() if e <= allowed[n])

        def step(state: frozenset, letter: str) -> frozenset:
            reached: dict[int, int] = {}
            for node, edits in state:
                if edits < allowed[node]:
                    reached[node] = min(reached.get(node, 99), edits + 1)
                for own, child in children[node].items():
                    now = edits + (own != letter)
                    if now <= allowed[child]:
                        reached[child] = min(reached.get(child, 99), now)
            return closed(reached)

        start = closed({0: 0})
        number, order, rows = {frozenset(): 0, start: 1}, [frozenset(), start], []
        for state in order:  # grows while it is walked
            row = []
            for letter in ["", *alphabet]:
                after = step(state, letter) if state else state
                if after not in number:
                    number[after] = len(order)
                    order.append(after)
                row.append(number[after])
            rows.append(row)
        self.table = np.array(rows, dtype=np.int32)
        best = [min(((e, ends[n]) for n, e in state if ends[n] >= 0 and e <= limit[ends[n]]), default=(0, -1)) for state in order]
        self.term = np.array([b[1] if b[1] < len(self.terms) else -1 for b in best], dtype=np.int32)
        self.edits = np.array([b[0] for b in best], dtype=np.int32)

    def classify(self, codes: np.ndarray) -> np.ndarray:
        kinds = np.zeros(0x110000, dtype=np.int32)
        for letter, kind in self.classes.items():
            kinds[ord(letter)] = kind
        return kinds[codes]

    def match(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Final state of each word."""
        kinds, sizes = self.classify(codes), ends - starts
        state, alive = np.ones(len(starts), dtype=np.int32), np.arange(len(starts))
        for step in range(int(sizes.max(initial=0))):
            over = sizes[alive] <= step
            if over.any():
                alive = alive[~over]
            if not len(alive):
                break
            state[alive] = self.table[state[alive], kinds[starts[alive] + step]]
            alive = alive[state[alive] > 0]
        return state

    def meet(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term or -1, its edits) of each word."""
        state = self.match(codes, starts, ends)
        return self.term[state], self.edits[state]


class LearnedLexicon:
    """Terms of any number in automata of ``TERMS_AN_AUTOMATON`` each; numbered over all of them, in order."""

    def __init__(self, terms: list[str], ordinary: Iterable[str] = ()):
        self.terms = sorted(set(terms))
        self.ordinary = sorted(set(ordinary) - set(self.terms))
        self.parts = [FuzzyLexicon(self.terms[a:a + TERMS_AN_AUTOMATON], shortest=SHORTEST_LEARNED, ordinary=self.ordinary)
                      for a in range(0, len(self.terms), TERMS_AN_AUTOMATON)]

    def meet(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        term, edits = np.full(len(starts), -1, dtype=np.int32), np.zeros(len(starts), dtype=np.int32)
        for number, part in enumerate(self.parts):
            own, away = part.meet(codes, starts, ends)
            nearer = (own >= 0) & ((term < 0) | (away < edits))
            term[nearer], edits[nearer] = own[nearer] + number * TERMS_AN_AUTOMATON, away[nearer]
        return term, edits

    def near(self, words: list[str]) -> np.ndarray:
        """Whether each word is met as a misspelled term."""
        _, low = _letters()
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        codes = low[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        term, edits = self.meet(codes, ends - np.array([len(w) for w in words], dtype=np.int64), ends)
        return (term >= 0) & (edits > 0)


def hit_counts(lexicon: FuzzyLexicon | LearnedLexicon, texts: list[str | None]) -> np.ndarray:
    """Row per text: the FEATURES, counts as log(1 + n)."""
    out = np.zeros((len(texts), len(FEATURES)))
    inside, low = _letters()
    for a, b in slices(texts):
        part = [t or "" for t in texts[a:b]]
        raw = np.frombuffer("\n".join([*part, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        edge = np.diff(np.concatenate([[0], inside[raw].view(np.int8)]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        begins = np.cumsum([0, *[len(t) + 1 for t in part]])
        first = np.searchsorted(starts, begins)
        words = np.diff(first)
        term, edits = lexicon.meet(low[raw], starts, ends)
        hits = np.flatnonzero(term >= 0)
        if not len(hits):
            continue
        text = np.searchsorted(first, hits, side="right") - 1
        near = edits[hits] > 0
        quotes = np.concatenate([[0], np.cumsum(np.isin(raw, [ord(c) for c in QUOTES]))])
        from_word = np.maximum(hits - CONTEXT_WORDS, first[text])
        to_word = np.minimum(hits + CONTEXT_WORDS, first[text + 1] - 1)
        from_char = np.where(from_word == first[text], begins[text], starts[from_word])
        to_char = np.where(to_word == first[text + 1] - 1, begins[text + 1] - 1, ends[to_word])
        # Marks open and close in turn within a line: after an odd number of them a word stands inside a pair.
        at = np.arange(len(raw))
        line = np.maximum.accumulate(np.where(raw == 0x0A, at + 1, 0))[starts[hits]]
        opened = (quotes[starts[hits]] - quotes[np.maximum(line, begins[text])]) % 2 == 1
        quoted = opened & (quotes[starts[hits]] > quotes[from_char]) & (quotes[to_char] > quotes[ends[hits]])
        gap = np.diff(hits) <= CONTEXT_WORDS
        same = np.diff(text) == 0
        beside = np.zeros(len(hits), dtype=bool)
        beside[1:] |= gap & same
        beside[:-1] |= gap & same
        rows = np.zeros((len(part), len(FEATURES)))
        for column, chosen in enumerate((~near & ~quoted, near & ~quoted, ~near & quoted, near & quoted)):
            rows[:, column] = np.log1p(np.bincount(text[chosen], minlength=len(part)))
        pairs = np.unique(np.stack([text, term[hits]], axis=1), axis=0)
        rows[:, 4] = np.log1p(np.bincount(pairs[:, 0], minlength=len(part)))
        rows[:, 5] = np.log1p(np.bincount(text[beside & ~quoted], minlength=len(part)))
        rows[:, 6] = np.log1p(100 * np.bincount(text[~quoted & ~near], minlength=len(part)) / np.maximum(words, 1))
        out[a:b] = rows
    return out


@dataclass
class ToxicityModel:
    lexicon: LearnedLexicon | None
    weights: list[float]
    bias: float
    base_rate: float

    def features(self, text: Column | str) -> Column:
        lexicon = self.lexicon

        def rows(column: pa.Array) -> pa.Array:
            flat = hit_counts(lexicon, column.to_pylist()).ravel()
            offsets = np.arange(len(column) + 1, dtype=np.int32) * len(FEATURES)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

        return F.arrow_udf(rows, "array<double>")(text)

    def score(self, docs: DataFrame, text: str = "text", column: str = "score") -> DataFrame:
        """``docs`` with a score from 0 to 1; null and empty texts are scored like texts without a hit."""
        if self.lexicon is None:
            return docs.withColumn(column, F.lit(self.base_rate))
        counted = docs.withColumn("__hits", self.features(text))
        total = F.lit(self.bias)
        for i, weight in enumerate(self.weights):
            total = total + F.lit(weight) * F.element_at("__hits", i + 1)
        return counted.withColumn(column, F.lit(1.0) / (F.lit(1.0) + F.exp(-total))).drop("__hits")


def _words() -> Column:
    return F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{Nd}]+"))


def learn_terms(rows: DataFrame) -> list[str]:
    """Words of toxic texts: significant by the likelihood ratio and far more frequent there than in clean ones.

    There are no more than the words of the labelled rows learned from, which are bounded.
    """
    tally = rows.agg(F.sum("label"), F.count("*")).first()
    toxic, clean = float(tally[0] or 0), float(tally[1] - (tally[0] or 0))
    seen = (rows.select("label", F.explode(_words()).alias("word")).where(F.length("word") > 1)
            .groupBy("word").agg(F.sum("label").alias("t"), F.count("*").alias("n")).where("t > 2"))
    seen = cut_lineage(seen)
    evidence = 2 * math.log(max(2, seen.count()))  # about one word passes by chance
    in_toxic, in_clean = F.col("t") / toxic, (F.col("n") - F.col("t") + 0.5) / (clean + 1)
    base = toxic / (toxic + clean)
    share = F.col("t") / F.col("n")
    ratio = 2 * (F.col("t") * F.log(share / base) + F.when(share < 1, (F.col("n") - F.col("t")) * F.log((1 - share) / (1 - base))).otherwise(0.0))
    found = seen.where(in_toxic > LIFT * in_clean).where(ratio > evidence)
    return sorted(r.word for r in found.select("word").collect())


def ordinary_words(rows: DataFrame, lexicon: LearnedLexicon) -> list[str]:
    """Words near a term that stand in ``ORDINARY_TEXTS`` clean texts at least: words of their own and no misspellings."""
    clean = (rows.where("label = 0").select(F.explode(_words()).alias("word")).where(F.length("word") > 1)
             .groupBy("word").count().where(F.col("count") >= ORDINARY_TEXTS))
    near = F.arrow_udf(lambda column: pa.array(lexicon.near(column.to_pylist())), "boolean")
    return sorted(r.word for r in clean.select("word").where(near("word")).collect())


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> ToxicityModel:
    """Learn lexicon and weights from labelled rows whose bucket is not held out.

    Without rows of both labels, or without any term, there is no lexicon and every score is
    the share of toxic rows (0 without rows), kept below one half.
    """
    rows = cut_lineage(training_rows(docs, labels, "toxic", 5, 0, bound))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    rate = min(0.49, counts.get(1, 0) / max(1, sum(counts.values())))
    terms = learn_terms(rows) if len(counts) == 2 else []
    if not terms:
        return ToxicityModel(None, [], 0.0, rate)
    lexicon = LearnedLexicon(terms)
    model = ToxicityModel(LearnedLexicon(terms, ordinary_words(rows, lexicon)), [], 0.0, rate)
    points = cut_lineage(rows.select(array_to_vector(model.features("text")).alias("features"), F.col("label").cast("double")))
    fitted = LogisticRegression(regParam=1e-4, maxIter=60, labelCol="label").fit(points)
    model.weights, model.bias = [float(w) for w in fitted.coefficients], float(fitted.intercept)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``.

    Only ``doc_id`` and ``text`` are read, and ``doc_id`` and ``toxic`` of the
    labels. A null id is in the bucket of the text 'null'.
    """
    model = fit(docs, labels)
    scored = model.score(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    return scored.select("doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
