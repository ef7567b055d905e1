"""Token counts by rank-synchronous merging of ragged arrays.

Pre-tokens are held together as one flat array of symbols. In each round every
sequence applies its own lowest-ranked pair, all sequences at once: ranks of
adjacent pairs are minimised per sequence, the places of that pair collapse, and
only the pairs beside a collapse are ranked anew. What survives is counted; no
token string or id list leaves the worker.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.llm.bpe_model import NO_RANK, KnownWords, Vocabulary, in_slices, load, per_text_sums
from odflux.llm.common import ship_package


def surviving_symbols(vocabulary: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Symbols left of each sequence once no adjacent pair of it has a rank. Empty sequences have 0."""
    left = np.zeros(len(lengths), dtype=np.int64)
    owner = np.flatnonzero(lengths)
    lengths = lengths[owner]
    symbols = symbols.copy()
    ranks = np.full(len(symbols), NO_RANK)
    if len(symbols) > 1:
        ranks[:-1] = vocabulary.ranks(symbols[:-1], symbols[1:])
    if len(lengths):
        ranks[np.cumsum(lengths) - 1] = NO_RANK
    while len(lengths):
        starts = np.cumsum(lengths) - lengths
        lowest = np.minimum.reduceat(ranks, starts)
        active = lowest < NO_RANK
        if not active.all():
            left[owner[~active]] = lengths[~active]
            keep = np.repeat(active, lengths)
            symbols, ranks = symbols[keep], ranks[keep]
            owner, lengths, lowest = owner[active], lengths[active], lowest[active]
            if not len(lengths):
                break
            starts = np.cumsum(lengths) - lengths
        hits = np.flatnonzero(ranks == np.repeat(lowest, lengths))
        sequence = np.searchsorted(starts, hits, side="right") - 1
        if vocabulary.layered:
            # In a run such as "aaa" the pairs overlap: take every other one from the left.
            first = np.concatenate([[True], np.diff(hits) != 1])
            run = np.flatnonzero(first)
            taken = (np.arange(len(hits)) - np.repeat(run, np.diff(np.append(run, len(hits))))) % 2 == 0
        else:
            taken = np.concatenate([[True], np.diff(sequence) != 0])
        hits, sequence = hits[taken], sequence[taken]
        symbols[hits] = vocabulary.merged[lowest[sequence]]
        ranks[hits] = ranks[hits + 1]
        keep = np.ones(len(symbols), dtype=bool)
        keep[hits + 1] = False
        last = np.cumsum(lengths) - 1
        ends = np.zeros(len(symbols), dtype=bool)
        ends[last] = True
        ends[hits] |= ends[hits + 1]
        place = np.cumsum(keep) - 1
        symbols, ranks, ends = symbols[keep], ranks[keep], ends[keep]
        lengths = lengths - np.bincount(sequence, minlength=len(lengths))
        hits = place[hits]
        beside = np.zeros(len(symbols), dtype=bool)
        beside[hits] = True
        beside[hits[hits > 0] - 1] = True
        again = np.flatnonzero(beside & ~ends)
        ranks[again] = vocabulary.ranks(symbols[again], symbols[again + 1])
    return left


@lru_cache(maxsize=2)
def _known(path: str) -> KnownWords:
    vocabulary = load(path)

    def solve(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        counts = surviving_symbols(vocabulary, *vocabulary.symbols(words))
        return counts, np.ones(len(words), np.int64)

    return KnownWords(vocabulary, solve)


def count_texts(path: str, texts: list[str | None]) -> np.ndarray:
    known, out = _known(path), []
    for part in in_slices(texts):
        rows, per_text, flat, _ = known.lookup(part)
        counts = np.where(rows < len(known.vocabulary.specials), 1, flat[rows])
        out.append(per_text_sums(counts, per_text))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def token_count(text: Column | str, path: str) -> Column:
    """Number of tokens of a text under the vocabulary file, as a long column.

    Null and empty texts have 0. Added tokens found inside a text count as one
    each; none is put around it. A text is never cut. The path is opened on the
    executors, where the vocabulary package is installed.
    """
    def counts(column: pa.Array) -> pa.Array:
        return pa.array(count_texts(path, column.to_pylist()), type=pa.int64())

    return F.arrow_udf(counts, "long")(text)


def with_token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``; columns of those names are replaced."""
    ship_package(docs.sparkSession)
    return docs.withColumns({
        "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
        "n_tokens": token_count(text, path),
    }).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
