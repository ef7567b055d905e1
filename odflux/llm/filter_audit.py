"""Counts of text filters by one table-driven pass, and an audit of how filters act on each other.

The bytes of the texts at hand run through a finite-state transducer: a byte has a
class, a state and a class give the next state and a set of marks, and the marks of
all bytes are added up per text (words begun, capitals, code points, symbols). Since
every class leads to one state whatever the state before, the run of states is read
from the classes by one shift, for all texts at once. Word spans go into one hash
table, where a span that meets its own hash is compared byte by byte before it counts
as known, so no collision joins two words.

The audit needs no order of filters while it reads: a document is folded to the set
of filters that it fails, sets are counted per part in Spark, and every order is
worked out from those few counts.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.llm.common import SLICE_CHARS, ship_package, slices
from odflux.llm.word_arrays import mix, span_hashes

# Classes of bytes: white space, capital, listed symbol, other first byte of a code point, later byte of a code point.
SPACE, CAPITAL, SYMBOL, OTHER, LATER = range(5)
SYMBOLS = "#$%&*|"
# States: between words and inside one. Marks: bits that a step sets.
BETWEEN, INSIDE = range(2)
BEGINS, ENDS, IS_CAPITAL, IS_SYMBOL, IS_LATER = 1, 2, 4, 8, 16
_FIELDS = ("words", "distinct_words", "capitals", "code_points", "symbols")


def byte_classes(symbols: str = SYMBOLS) -> np.ndarray:
    """Class of each of the 256 bytes; ``symbols`` are ASCII."""
    table = np.full(256, OTHER, dtype=np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = SPACE
    table[0x41:0x5B] = CAPITAL
    table[0x80:0xC0] = LATER
    table[list(symbols.encode("ascii"))] = SYMBOL
    return table


#: State after a byte of each class.
NEXT = np.array([BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE], dtype=np.uint8)
#: Marks of a step, by state before and class.
_OF_CLASS = [0, IS_CAPITAL, IS_SYMBOL, 0, IS_LATER]
MARKS = np.array([[m | (BEGINS if NEXT[c] == INSIDE else 0) for c, m in enumerate(_OF_CLASS)],
                  [m | (ENDS if NEXT[c] == BETWEEN else 0) for c, m in enumerate(_OF_CLASS)]], dtype=np.uint8)


def _eights(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each place of ``buffer``, as one number; zeros follow its end."""
    padded = np.concatenate([buffer, np.zeros(8, np.uint8)])
    return np.ndarray(len(buffer) + 1, dtype="<u8", buffer=padded.data, strides=(1,))


def _same_bytes(eights: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether spans at ``a`` and at ``b`` of the same ``length`` hold the same bytes."""
    same = np.ones(len(a), dtype=bool)
    at = np.arange(len(a))
    done = 0
    while len(at):
        left = np.minimum(length[at] - done, 8).astype(np.uint64)
        differ = (eights[a[at] + done] ^ eights[b[at] + done]) << (np.uint64(64) - np.uint64(8) * left)
        same[at[differ != 0]] = False
        done += 8
        at = at[(differ == 0) & (length[at] > done)]
    return same


def first_seen(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray,
               hashes: np.ndarray | None = None) -> np.ndarray:
    """Whether each span is the one that its text's table keeps for its bytes: one span of each distinct word of each text.

    One open table of at least twice as many places as spans holds all texts; owner
    and word give the place, a taken place is compared (owner, hash, length, bytes),
    and a span that differs goes one place on. All spans take each step together.
    ``hashes`` may be any numbers equal for equal bytes; poor ones cost time only.
    """
    n = len(starts)
    size = 1 << max(3, (2 * n - 1).bit_length())
    place_of = np.full(size, -1, dtype=np.int64)
    if hashes is None:
        hashes = span_hashes(buffer, starts, ends)
    length = ends - starts
    place = (mix(hashes + owner.astype(np.uint64)) & np.uint64(size - 1)).astype(np.int64)
    eights = _eights(buffer)
    first = np.zeros(n, dtype=bool)
    todo = np.arange(n)
    while len(todo):
        at = place[todo]
        free = place_of[at] < 0
        place_of[at[free]] = todo[free]
        holder = place_of[at]
        mine = holder == todo
        first[todo[mine]] = True
        like = ~mine & (owner[holder] == owner[todo]) & (hashes[holder] == hashes[todo]) & (length[holder] == length[todo])
        known = np.flatnonzero(like)
        like[known] = _same_bytes(eights, starts[holder[known]], starts[todo[known]], length[todo[known]])
        todo = todo[~mine & ~like]
        place[todo] = (place[todo] + 1) & (size - 1)
    return first


def transduce(texts: list[str | None], symbols: str = SYMBOLS) -> np.ndarray:
    """Rows of (words, distinct words, capitals, code points, symbols) of texts held together. Null is empty."""
    # A line end closes every text, so the state between words is reached before the next begins.
    raw = [t.encode() if t else b"" for t in texts]
    buffer = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    first = np.cumsum([0, *[len(r) + 1 for r in raw]])
    classes = byte_classes(symbols)[buffer]
    state = np.empty(len(buffer), dtype=np.uint8)
    if len(buffer):
        state[0], state[1:] = BETWEEN, NEXT[classes[:-1]]
    marks = MARKS.ravel()[state * np.uint8(len(NEXT)) + classes]
    starts, ends = np.flatnonzero(marks & BEGINS), np.flatnonzero(marks & ENDS)
    firsts = np.searchsorted(starts, first)
    words = np.diff(firsts)
    owner = np.repeat(np.arange(len(raw)), words)
    out = np.zeros((len(raw), len(_FIELDS)), dtype=np.int64)
    out[:, 0] = words
    out[:, 1] = np.bincount(owner[first_seen(buffer, starts, ends, owner)], minlength=len(raw))
    marked = lambda bit: np.diff(np.searchsorted(np.flatnonzero(marks & bit), first))
    out[:, 2], out[:, 4] = marked(IS_CAPITAL), marked(IS_SYMBOL)
    # A code point has one byte that is no later one; the closing line end is none of the text's.
    out[:, 3] = np.diff(first) - 1 - marked(IS_LATER)
    return out


def text_counts(text: Column, symbols: str = SYMBOLS) -> Column:
    """Struct of long words, distinct_words, capitals, code_points and symbols of a whole text; null counts as empty.

    Words are maximal runs of anything but space and the five control characters from
    tab to carriage return; case tells words apart. Call ``ship_package`` first.
    """
    kind = pa.struct([(name, pa.int64()) for name in _FIELDS])

    def count(column: pa.Array) -> pa.Array:
        values = column.to_pylist()
        parts = [transduce(values[a:b], symbols) for a, b in slices(values, SLICE_CHARS)]
        rows = np.concatenate(parts) if parts else np.zeros((0, len(_FIELDS)), np.int64)
        return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(_FIELDS))], fields=list(kind))

    return F.arrow_udf(count, f"struct<{', '.join(f'{name} long' for name in _FIELDS)}>")(text)


def standard_filters(counts: Column) -> dict[str, Column]:
    """Failure conditions A to D by letter: few words, few distinct words, many capitals, a listed symbol."""
    c = lambda name: counts[name]
    return {"A": c("words") < 50, "B": 100 * c("distinct_words") < 65 * c("words"), "C": 100 * c("capitals") > 5 * c("code_points"),
            "D": c("symbols") > 0}


def failed_sets(docs: DataFrame, labels: DataFrame, filters=standard_filters, repeats: str = "E", part: str = "source") -> DataFrame:
    """(part, failed, good, toxic, documents): documents of each part by the set of filters that they fail, as bits.

    Bit k of ``failed`` is the k-th filter; the last bit, of the filter named by
    ``repeats``, says that a smaller doc_id anywhere holds the same text. Texts count as
    the same by SHA-256. Null text and null part count as empty. A null doc_id is
    neither smaller nor larger than any and has no label. Rows of one doc_id and text are
    each counted, and none is smaller than the other. Of repeated labels, any that says 1 counts.

    A text leaves its task as 32 bytes and its bits. Copies are folded inside each task
    before every shuffle, so a text of a third of all rows meets itself in few rows.
    """
    ship_package(docs.sparkSession)
    held = F.coalesce(docs["text"].cast("string"), F.lit(""))
    counted = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
                          F.unhex(F.sha2(held.cast("binary"), 256)).alias("sha"), text_counts(held).alias("counts"))
    bits = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(filters(F.col("counts")).values())), F.lit(0))
    folded = (counted.select("doc_id", "part", "sha", bits.cast("int").alias("failed"))
              .groupBy("doc_id", "part", "sha", "failed").agg(F.count(F.lit(1)).alias("rows")))
    marks = labels.groupBy(labels["doc_id"].alias("doc_id")).agg(
        F.max((labels["quality"] == 1).cast("int")).alias("good"), F.max((labels["toxic"] == 1).cast("int")).alias("toxic"))
    known = folded.join(marks, "doc_id", "left").na.fill(0, ["good", "toxic"])
    # One row is left of each text, part and label, whatever the number of its copies; it knows its smallest id and that id's rows.
    texts = known.groupBy("sha", "part", "failed", "good", "toxic").agg(
        F.sum("rows").alias("rows"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("rows"))), F.lit(0)).alias("unnamed"),
        F.min("doc_id").alias("least"), F.min_by("rows", "doc_id").alias("least_rows"))
    smallest = texts.groupBy("sha").agg(F.min("least").alias("smallest"))
    alone = F.col("unnamed") + F.when(F.col("least") == F.col("smallest"), F.col("least_rows")).otherwise(F.lit(0))
    last = 1 << len(filters(F.col("counts")))
    sets = texts.join(smallest, "sha").select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("failed"), alone.alias("rows")),
        F.struct((F.col("failed") + F.lit(last)).alias("failed"), (F.col("rows") - alone).alias("rows")))).alias("s"))
    return (sets.where("s.rows > 0").groupBy("part", F.col("s.failed").alias("failed"), F.col("good") == 1, F.col("toxic") == 1)
            .agg(F.sum("s.rows").alias("documents")).toDF("part", "failed", "good", "toxic", "documents"))


def audit_orders(sets: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of filters and step, zeros included, from the sets of ``failed_sets``.

    ``kept`` passes all filters up to the step; ``removed`` fails this one first;
    ``redundant`` fails it after an earlier one; ``unique_fails`` fails it alone;
    ``good_lost`` and ``toxic_lost`` are labelled rows among the removed; ``shapley`` is
    what the filter removes over all orders, each order once: a row that fails k filters
    is removed by each of them in one k-th of the orders. The orders are a constant that
    every counted set is laid out against, at most 2**filters x 4 sets a part.
    """
    orders = list(permutations(range(len(letters))))
    steps = [(order, step) for order in orders for step in range(len(letters))]
    layout = F.array(*[F.struct(
        F.lit("".join(letters[i] for i in order)).alias("filter_order"), F.lit(step + 1).alias("step"),
        F.lit(1 << order[step]).alias("bit"), F.lit(sum(1 << i for i in order[:step])).alias("before")) for order, step in steps])
    laid = sets.select("*", F.explode(layout).alias("o")).select("*", "o.*")
    bit, before, failed = F.col("bit"), F.col("before"), F.col("failed")
    fails, gone = failed.bitwiseAND(bit) != 0, failed.bitwiseAND(before) != 0
    total = lambda where, of=F.col("documents"): F.coalesce(F.sum(F.when(where, of)), F.lit(0)).cast("long")
    share = (F.col("documents") * F.lit(len(orders)) / F.bit_count(failed)).cast("long")
    return laid.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(failed == bit).alias("unique_fails"), total(fails & ~gone & F.col("good")).alias("good_lost"),
        total(fails & ~gone & F.col("toxic")).alias("toxic_lost"), total(fails, share).alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Interaction of filters A to E over whole texts: see ``failed_sets`` and ``audit_orders``. No documents, no rows."""
    return audit_orders(failed_sets(docs, labels))
