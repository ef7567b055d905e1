"""BPE encoding with a segment tree over adjacent pair ranks, and decoding.

The leaves of a pre-token's tree are the keys (rank, place) of its adjacent
pairs; the root is then the leftmost pair of lowest rank. A merge changes three
leaves at most, each with a walk to the root, until the root holds no rank. The
trees of all new pre-tokens of one size class advance together, one merge each
per step; a pre-token too long for a class has a tree of its own.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.llm.bpe_model import NO_RANK, KnownWords, Vocabulary, in_slices, load
from odflux.llm.common import ship_package

SIZE_CLASSES = (4, 8, 16, 32, 64)
TREES_AT_ONCE = 20_000


def _merge_together(vocabulary: Vocabulary, symbols: np.ndarray, lengths: np.ndarray, leaves: int) -> np.ndarray:
    """Merge sequences of at most ``leaves + 1`` symbols; row i keeps its ids from the left, -1 where a symbol went."""
    n, wide = len(lengths), leaves + 2
    bits = leaves.bit_length() - 1
    empty = NO_RANK << 20
    inside = np.arange(wide) < lengths[:, None]
    ids = np.full((n, wide), -1, dtype=np.int64)
    ids[inside] = symbols
    pair = inside[:, 1:leaves + 1]
    left, right = ids[:, :leaves], ids[:, 1:leaves + 1]
    tree = np.full((n, 2 * leaves), empty, dtype=np.int64)
    ranks = vocabulary.ranks(left[pair], right[pair])
    keys = tree[:, leaves:]
    keys[pair] = np.where(ranks < NO_RANK, ranks << bits | np.broadcast_to(np.arange(leaves), pair.shape)[pair], empty)
    level = leaves
    while level > 1:
        level //= 2
        np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2], out=tree[:, level:2 * level])
    after = np.tile(np.arange(1, wide + 1), (n, 1))
    before = np.tile(np.arange(-1, wide - 1), (n, 1))
    flat_tree, flat_ids, flat_after, flat_before = tree.ravel(), ids.ravel(), after.ravel(), before.ravel()
    rows = np.arange(n)

    def set_leaf(row: np.ndarray, place: np.ndarray, key: np.ndarray) -> None:
        base, at = row * (2 * leaves), place + leaves
        flat_tree[base + at] = key
        for _ in range(bits):
            at = at >> 1
            child = base + 2 * at
            flat_tree[base + at] = np.minimum(flat_tree[child], flat_tree[child + 1])

    while True:
        root = tree[rows, 1]
        going = root < empty
        rows, root = rows[going], root[going]
        if not len(rows):
            return ids
        place, base = root & (leaves - 1), rows * wide
        gone = flat_after[base + place]
        new = vocabulary.merged[root >> bits]
        follow = flat_after[base + gone]
        flat_ids[base + place], flat_ids[base + gone] = new, -1
        flat_after[base + place] = follow
        has_next = follow < lengths[rows]
        flat_before[(base + follow)[has_next]] = place[has_next]
        dead = gone < leaves
        set_leaf(rows[dead], gone[dead], np.full(int(dead.sum()), empty))
        key = np.full(len(rows), empty)
        rank = vocabulary.ranks(new[has_next], flat_ids[(base + follow)[has_next]])
        key[has_next] = np.where(rank < NO_RANK, rank << bits | place[has_next], empty)
        set_leaf(rows, place, key)
        ahead = flat_before[base + place]
        seen = ahead >= 0
        rank = vocabulary.ranks(flat_ids[(base + ahead)[seen]], new[seen])
        set_leaf(rows[seen], ahead[seen], np.where(rank < NO_RANK, rank << bits | ahead[seen], empty))


def _merge_alone(vocabulary: Vocabulary, symbols: np.ndarray) -> list[int]:
    """The same merges for one long sequence, with its own tree."""
    leaves = 1 << (len(symbols) - 2).bit_length()
    bits, empty, none = leaves.bit_length() - 1, int(NO_RANK) << 20, int(NO_RANK)
    table = _pair_ranks(vocabulary)
    size, merged = vocabulary.size, vocabulary.merged
    ids, n = symbols.tolist(), len(symbols)
    ranks = vocabulary.ranks(symbols[:-1], symbols[1:])
    first = np.full(leaves, empty, dtype=np.int64)
    first[:n - 1] = np.where(ranks < NO_RANK, ranks << bits | np.arange(n - 1), empty)
    levels = [first]
    while len(levels[-1]) > 1:
        levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
    tree = [empty, *np.concatenate(levels[::-1]).tolist()]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def set_leaf(place: int, rank: int) -> None:
        at = place + leaves
        tree[at] = rank << bits | place if rank < none else empty
        while at > 1:
            at >>= 1
            a, b = tree[2 * at], tree[2 * at + 1]
            low = a if a < b else b
            if tree[at] == low:
                return
            tree[at] = low

    while tree[1] < empty:
        place, rank = tree[1] & (leaves - 1), tree[1] >> bits
        gone = after[place]
        follow = after[gone]
        ids[place], ids[gone] = int(merged[rank]), -1
        after[place] = follow
        if follow < n:
            before[follow] = place
        if gone < leaves:
            set_leaf(gone, none)
        set_leaf(place, table.get(ids[place] * size + ids[follow], none) if follow < n else none)
        if (ahead := before[place]) >= 0:
            set_leaf(ahead, table.get(ids[ahead] * size + ids[place], none))
    return [i for i in ids if i >= 0]


@lru_cache(maxsize=2)
def _pair_ranks(vocabulary: Vocabulary) -> dict[int, int]:
    return dict(zip(vocabulary.keys.tolist(), vocabulary.key_ranks.tolist()))


def encode_words(vocabulary: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after the other, and the number of ids of each word."""
    symbols, lengths = vocabulary.symbols(words)
    starts = np.cumsum(lengths) - lengths
    pairs = lengths - 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, ids, ids per word
    single = np.flatnonzero(lengths == 1)
    found.append((single, symbols[starts[single]], np.ones(len(single), np.int64)))
    low = 0
    for leaves in SIZE_CLASSES:
        members = np.flatnonzero((pairs > low) & (pairs <= leaves))
        low = leaves
        for i in range(0, len(members), TREES_AT_ONCE):
            some = members[i:i + TREES_AT_ONCE]
            size = lengths[some]
            at = np.repeat(starts[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            ids = _merge_together(vocabulary, symbols[at], size, leaves)
            found.append((some, ids[ids >= 0], (ids >= 0).sum(axis=1)))
    for i in np.flatnonzero(pairs > low):
        ids = _merge_alone(vocabulary, symbols[starts[i]:starts[i] + lengths[i]])
        found.append((np.array([i]), np.array(ids, dtype=np.int64), np.array([len(ids)])))
    who, counts = np.concatenate([f[0] for f in found]), np.concatenate([f[2] for f in found])
    flat = np.concatenate([f[1] for f in found])
    order = np.argsort(who, kind="stable")
    return flat[_ragged(np.cumsum(counts) - counts, counts, order)], counts[order]


def _ragged(starts: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places of the values of the given rows, one row after the other."""
    size = counts[rows]
    return np.repeat(starts[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())


@lru_cache(maxsize=2)
def _known(path: str) -> tuple[KnownWords, Vocabulary]:
    vocabulary = load(path)
    return KnownWords(vocabulary, lambda words: encode_words(vocabulary, words)), vocabulary


def encode_texts(path: str, texts: list[str | None]) -> pa.ListArray:
    known, _ = _known(path)
    values, sizes = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for part in in_slices(texts):
        rows, per_text, flat, lengths = known.lookup(part)
        values.append(flat[_ragged(np.cumsum(lengths) - lengths, lengths, rows)].astype(np.int32))
        ends = np.concatenate([[0], np.cumsum(lengths[rows])])[np.cumsum(per_text)]
        sizes.append(np.diff(ends, prepend=0))
    return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)).astype(np.int32)), pa.array(np.concatenate(values)))


def decode_ids(path: str, column: pa.ListArray) -> pa.Array:
    """Texts of id lists. Ids outside the vocabulary stand for nothing; broken UTF-8 becomes U+FFFD."""
    pieces, size = load(path).pieces, load(path).size
    texts = []
    for ids in column:
        known = [i for i in ids.as_py() if i is not None and 0 <= i < size] if ids.values is not None and ids.values.null_count else (
            ids.values.to_numpy().tolist() if ids.is_valid else [])
        texts.append(b"".join([pieces[i] for i in known if 0 <= i < size]).decode("utf-8", "replace"))
    return pa.array(texts, type=pa.string())


def encode(text: Column | str, path: str) -> Column:
    """``array<int>`` of token ids of a whole text; null and empty texts give an empty list.

    Added tokens found in a text take their ids; none is put around it, nothing is cut or padded.
    """
    return F.arrow_udf(lambda column: encode_texts(path, column.to_pylist()), "array<int>")(text)


def decode(ids: Column | str, path: str) -> Column:
    """Text of a list of ids, added tokens included; a null list gives an empty text."""
    return F.arrow_udf(lambda column: decode_ids(path, column), "string")(ids)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` and ``decoded``, the text read back from those ids; columns of those names are replaced."""
    ship_package(docs.sparkSession)
    kind = pa.struct([("token_ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def both(column: pa.Array) -> pa.Array:
        ids = encode_texts(path, column.to_pylist())
        return pa.StructArray.from_arrays([ids, decode_ids(path, ids)], fields=list(kind))

    names = [c for c in docs.columns if c not in ("token_ids", "decoded")]
    coded = F.arrow_udf(both, "struct<token_ids: array<int>, decoded: string>")(text)
    return docs.select(*names, coded.alias("__coded")).select(*names, "__coded.token_ids", "__coded.decoded")
