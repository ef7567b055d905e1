"""Reading a byte-level BPE vocabulary file and cutting texts into its pre-tokens."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import regex

from odflux.llm.common import slices

# Fixed value: the pattern that byte-level vocabularies of this format split text with.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_RANK = np.int64(1) << 40
KNOWN_PRE_TOKENS, VALUES_A_WORD = 500_000, 8
LONGEST_KEPT = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the file: itself, or the next free one from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Ids, ranked merges and added tokens of one file.

    Only plain byte-level BPE is read: no normalizer, no prefix space, no dropout.
    Anything else is refused, because it would give other tokens than the file's library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, cut = told["model"], told.get("pre_tokenizer") or {}
        if (model.get("type", "BPE") != "BPE" or told.get("normalizer") or cut.get("type") != "ByteLevel"
                or cut.get("add_prefix_space") or not cut.get("use_regex", True) or model.get("dropout")
                or model.get("ignore_merges") or model.get("byte_fallback")):
            raise ValueError(f"{path} is not plain byte-level BPE")
        letters = byte_letters()
        vocab = model["vocab"]
        self.byte_ids = np.array([vocab[c] for c in letters], dtype=np.int64)
        value = {c: b for b, c in enumerate(letters)}
        self.specials = {t["content"]: t["id"] for t in told.get("added_tokens", [])}
        self.size = 1 + max([*vocab.values(), *self.specials.values()])
        self.pieces = [b""] * self.size
        for word, i in vocab.items():
            self.pieces[i] = bytes(value[c] for c in word)
        for word, i in self.specials.items():
            self.pieces[i] = word.encode()
        merges = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_ranks = keys[order], order.astype(np.int64)
        born = np.full(self.size, -1, dtype=np.int64)
        born[self.merged] = np.arange(len(merges))
        #: Whether a merge never makes a pair that ranks before itself; then all places of a pair may merge at once.
        self.layered = bool(len(set(self.merged.tolist())) == len(merges) and (born[left] < np.arange(len(merges))).all()
                            and (born[right] < np.arange(len(merges))).all())
        self._special = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")"
                                   ) if self.specials else None
        self._split = regex.compile(PRE_TOKEN).findall

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK where the pair never merges."""
        wanted = left * self.size + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.key_ranks[at], NO_RANK)

    def pre_tokens(self, text: str) -> list[str]:
        if self._special is None or not self._special.search(text):
            return self._split(text)
        out: list[str] = []
        for i, part in enumerate(self._special.split(text)):
            if i % 2:
                out.append(part)
            elif part:
                out += self._split(part)
        return out

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Byte ids of all words in one array, and the number of bytes of each word."""
        raw = [w.encode() for w in words]
        return (self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)],
                np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Numbering(dict):
    """Word -> number; a word not seen before gets the next number and is noted in ``fresh``."""

    def __init__(self, first: int = 0):
        super().__init__()
        self.next, self.fresh = first, []

    def __missing__(self, word: str) -> int:
        self[word] = number = self.next
        self.next += 1
        self.fresh.append(word)
        return number


class _Growing:
    """Values that are added to at the end; room is doubled, so what is there is seldom copied."""

    def __init__(self, values: np.ndarray):
        self._room, self.size = np.array(values, dtype=np.int32), len(values)

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self._room):
            room = np.zeros(max(end, 2 * len(self._room)), dtype=np.int32)
            room[:self.size] = self._room[:self.size]
            self._room = room
        self._room[self.size:end] = values
        self.size = end

    @property
    def values(self) -> np.ndarray:
        return self._room[:self.size]


class KnownWords:
    """Result of each distinct pre-token, worked out once per worker and held up to a fixed number of words and of values.

    ``solve(words) -> (flat values, lengths)`` is asked for new words only, many at
    a time. Past either bound all are forgotten, and words of more than ``LONGEST_KEPT``
    letters, as texts without spaces have, are never held beyond the texts they came
    with; that costs time, never a result.
    """

    def __init__(self, vocabulary: Vocabulary, solve, bound: int = KNOWN_PRE_TOKENS):
        self.vocabulary, self.solve, self.bound = vocabulary, solve, bound
        self._forget()

    def _forget(self) -> None:
        """Start over with the added tokens, which are rows 0, 1, ... and stand for their own ids."""
        self.rows = _Numbering()
        for word in self.vocabulary.specials:
            self.rows[word]
        self.rows.fresh.clear()
        self.flat = _Growing(np.array(list(self.vocabulary.specials.values()), dtype=np.int64))
        self.lengths = _Growing(np.ones(self.flat.size, np.int64))

    def lookup(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row of each pre-token, pre-tokens per text, flat values, lengths per row)."""
        if self.lengths.size > self.bound or self.flat.size > VALUES_A_WORD * self.bound:
            self._forget()
        parts = [self.vocabulary.pre_tokens(t) for t in texts]
        per_text = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        found = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(parts)), dtype=np.int64, count=int(per_text.sum()))
        flat, lengths = self.flat.values, self.lengths.values
        if fresh := self.rows.fresh:
            known = self.lengths.size
            new_flat, new_lengths = self.solve(fresh)
            long = np.fromiter((len(word) > LONGEST_KEPT for word in fresh), dtype=bool, count=len(fresh))
            # Rows of the words that stay come first; the long ones follow them, for these texts alone.
            place = np.empty(len(fresh), dtype=np.int64)
            place[~long], place[long] = np.arange((~long).sum()), np.arange(long.sum()) + (~long).sum()
            new = found >= known
            found[new] = place[found[new] - known] + known
            of_long = np.repeat(long, new_lengths)
            self.flat.add(new_flat[~of_long])
            self.lengths.add(new_lengths[~long])
            flat, lengths = self.flat.values, self.lengths.values
            if long.any():
                flat, lengths = np.concatenate([flat, new_flat[of_long]]), np.concatenate([lengths, new_lengths[long]])
                for word, at, gone in zip(fresh, place.tolist(), long.tolist()):
                    if gone:
                        del self.rows[word]
                    else:
                        self.rows[word] = known + at
            self.rows.next = self.lengths.size
            fresh.clear()
        return found, per_text, flat, lengths


def per_text_sums(values: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(per_text)
    return total[ends] - total[ends - per_text]


def in_slices(texts: list[str | None]):
    """(texts of one slice) in order, null as empty."""
    for begin, end in slices(texts):
        yield [t or "" for t in texts[begin:end]]
