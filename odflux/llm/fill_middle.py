"""Fill-in-middle transformation, cut through a learned index of code point boundaries.

A cut is drawn as a rank, a number of code points, while text lies in memory as
UTF-8 bytes. The byte offsets of all boundaries of the texts at hand are therefore
learned: straight pieces whose error is bounded are fitted to them, pieces that
err by more are halved and fitted again, and what a piece misses is stored as one
small residual a boundary. A cut is predicted by its piece and put right by its
residual, exactly. Ranks, forms and the assembly of the output are column
expressions; a Python worker sees texts and ranks and answers with byte offsets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.llm.common import SLICE_CHARS, ship_package

#: Largest error of a piece, so that a residual fits one signed byte.
MOST_ERROR = 127
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20


@dataclass
class RankIndex:
    """Pieces (first rank, first offset, offsets gained, ranks covered) and a residual for every boundary."""

    ranks: np.ndarray
    offsets: np.ndarray
    rise: np.ndarray
    run: np.ndarray
    residuals: np.ndarray

    def predict(self, wanted: np.ndarray) -> np.ndarray:
        """Offset that the piece of each rank gives; off by at most the bound of the fit."""
        piece = np.searchsorted(self.ranks, wanted, side="right") - 1
        return self.offsets[piece] + (wanted - self.ranks[piece]) * self.rise[piece] // self.run[piece]

    def offset(self, wanted: np.ndarray) -> np.ndarray:
        """Exact offset of each rank."""
        return self.predict(wanted) + self.residuals[wanted]


def fit_index(boundaries: np.ndarray, firsts: np.ndarray, error: int = MOST_ERROR) -> RankIndex:
    """Index of rising ``boundaries``; a piece begins at each rank of ``firsts`` and wherever the error asks for one.

    All pieces are tried at once; those within ``error`` stay, the others are
    halved, down to a piece of one rank, which is exact. Any error from 0 to 127 will do.
    """
    if not 0 <= error <= MOST_ERROR:
        raise ValueError(f"the error must be from 0 to {MOST_ERROR}")
    last = len(boundaries) - 1
    starts = np.unique(np.append(firsts[firsts < last], 0)) if last > 0 else np.zeros(0, np.int64)
    ends = np.append(starts[1:], last) if len(starts) else starts
    residuals = np.zeros(len(boundaries), dtype=np.int8)
    # The last boundary has a piece of its own, so every rank is covered.
    kept = [(np.array([last]), np.array([boundaries[last]]), np.zeros(1, np.int64), np.ones(1, np.int64))]
    while len(starts):
        run = ends - starts
        rise = boundaries[ends] - boundaries[starts]
        begin = np.cumsum(run) - run
        step = np.arange(int(run.sum())) - np.repeat(begin, run)
        ranks = np.repeat(starts, run) + step
        missed = boundaries[ranks] - np.repeat(boundaries[starts], run) - step * np.repeat(rise, run) // np.repeat(run, run)
        good = np.maximum.reduceat(np.abs(missed), begin) <= error
        kept.append((starts[good], boundaries[starts[good]], rise[good], run[good]))
        fits = np.repeat(good, run)
        residuals[ranks[fits]] = missed[fits]
        left, right = starts[~good], ends[~good]
        middle = (left + right) // 2
        starts, ends = np.ravel(np.column_stack([left, middle])), np.ravel(np.column_stack([middle, right]))
    ranks, offsets, rise, run = (np.concatenate(part) for part in zip(*kept))
    order = np.argsort(ranks, kind="stable")
    return RankIndex(ranks[order], offsets[order], rise[order], run[order], residuals)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, offset of each text and of the end); an Arrow string array is that already."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(places, dtype=width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def cut_offsets(texts: pa.Array, cuts: list[np.ndarray], error: int = MOST_ERROR, limit: int = SLICE_CHARS) -> list[np.ndarray]:
    """Byte offset, from the start of its text, of the code point rank that each of ``cuts`` names per text.

    Texts are indexed together until they hold ``limit`` bytes; a longer text stands alone, whole.
    """
    _, offsets = _bytes_of(texts)
    found = [np.zeros(len(texts), np.int64) for _ in cuts]
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1)
        data, places = _bytes_of(texts.slice(begin, end - begin))
        boundaries = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        firsts = np.searchsorted(boundaries, places[:-1])
        index = fit_index(boundaries, firsts, error)
        for got, cut in zip(found, cuts):
            got[begin:end] = index.offset(firsts + cut[begin:end]) - places[:-1]
        begin = end
    return found


def _byte_cuts(text: Column, first: Column, second: Column, error: int) -> Column:
    kind = pa.struct([("first", pa.int64()), ("second", pa.int64())])

    def cut(texts: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        ranks = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (a, b)]
        return pa.StructArray.from_arrays([pa.array(c) for c in cut_offsets(texts, ranks, error)], fields=list(kind))

    return F.arrow_udf(cut, "struct<first long, second long>")(text, first, second)


def _check_marks(marks: tuple[str, str, str]) -> None:
    for i, a in enumerate(marks):
        for j, b in enumerate(marks):
            if not a or (i != j and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                raise ValueError("marks must be three texts of which none is in another and no end is a beginning")


def draws(ident: Column, seed: int = 1) -> list[Column]:
    """Four unsigned integers below 2**32 that depend on nothing but the seed and the id, written as text (null: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def restore(output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that ``output`` was made from, read from the output and its form alone."""
    p, s, m = (F.lit(x) for x in marks)
    between = lambda left, right: F.split_part(F.split_part(output, right, F.lit(1)), left, F.lit(2))
    behind = F.split_part(output, m, F.lit(2))
    return (F.when(form == "psm", F.concat(between(p, s), behind, between(s, m)))
            .when(form == "spm", F.concat(between(p, m), behind, between(s, p))).otherwise(output))


def fill_in_middle(docs: DataFrame, text: str = "text", ident: str = "doc_id", seed: int = 1, plain_from: int = PLAIN_FROM,
                   spm_below: int = SPM_BELOW, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
                   error: int = MOST_ERROR) -> DataFrame:
    """``docs`` with n, form, prefix, middle, suffix and output; columns of those names are replaced, others stay.

    ``n`` counts code points. Two cuts are drawn from the id, so a run, a retry or
    another partitioning gives the same output and rows of one id are cut by the same
    draws. The form is plain (the text itself; no prefix, middle or suffix) if the text
    is empty, null or holds a mark, or by ``plain_from`` percent; else spm by
    ``spm_below`` percent, else psm. A null text counts as empty, a null id is written
    as nothing. No row is dropped and no text is shortened.
    """
    _check_marks(marks)
    ship_package(docs.sparkSession)
    h1, h2, h3, h4 = draws(F.col(ident), seed)
    held = F.coalesce(F.col(text).cast("string"), F.lit(""))
    p, s, m = (F.lit(x) for x in marks)
    plain = (F.col("n") == 0) | held.contains(marks[0]) | held.contains(marks[1]) | held.contains(marks[2]) | (h3 % 100 >= plain_from)
    names = [c for c in docs.columns if c not in ("n", "form", "prefix", "middle", "suffix", "output")]
    ranked = docs.select(*names, F.length(held).cast("long").alias("n"), F.struct(
        (h1 % (F.length(held) + 1)).alias("a"), (h2 % (F.length(held) + 1)).alias("b")).alias("__rank"))
    cut = ranked.withColumn("__cut", _byte_cuts(held, F.least("__rank.a", "__rank.b"), F.greatest("__rank.a", "__rank.b"), error))
    raw = held.cast("binary")
    piece = lambda begin, end: F.when(F.col("form") != "plain", F.substr(raw, begin + F.lit(1), end - begin).cast("string"))
    first, second = F.col("__cut.first").cast("int"), F.col("__cut.second").cast("int")
    parts = cut.withColumn("form", F.when(plain, "plain").when(h4 % 100 < spm_below, "spm").otherwise("psm")).withColumns({
        "prefix": piece(F.lit(0), first), "middle": piece(first, second), "suffix": piece(second, F.octet_length(held))})
    pre, mid, suf = F.col("prefix"), F.col("middle"), F.col("suffix")
    return parts.withColumn("output", F.when(F.col("form") == "psm", F.concat(p, pre, s, suf, m, mid))
                            .when(F.col("form") == "spm", F.concat(s, suf, p, pre, m, mid)).otherwise(held)).drop("__rank", "__cut")
