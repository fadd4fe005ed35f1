"""Token ids of whole texts by a public tokenizer whose words never join across white space.

The tokenizers library encodes every distinct piece of a word once; texts are then put together from the ids of their words. A
slice of texts is cut at ASCII white space and its words are looked up, all at once, in a table of the words met before; only new
ones are cut at the vocabulary's own boundaries. The ids of words and of pieces are kept between slices in stores of bounded
size (they start anew when full; results do not depend on them). Words are told apart by 128 bits of hash. Words with characters
beyond the plain Latin range, where normalisation could differ, and words that may hold special tokens go to the library
as they are.
"""

from __future__ import annotations

import os
import re
from functools import cache
from itertools import chain, count

import numpy as np
import xxhash

from voltframe.llm.common import mix64, ragged

WORD_VOCAB = "word_bpe_49k.json"
STORE_PIECES = 200_000
STORE_WORDS = 1_000_000
SLOT_BITS = 22
LONG = 512
TOGETHER = 256
# The vocabulary's split pattern over lower-cased words of the characters U+0021-U+007E and U+00A1-U+00FF,
# whose letters and numbers are spelt out; a line feed stands between words.
_LETTER, _NUMBER = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|\n|[^\s{_LETTER}{_NUMBER}]+")
SPECIAL = b"<|"
_PLAIN_BYTE = np.zeros(256, bool)
_PLAIN_BYTE[0x21:0x7F] = True
_PLAIN_BYTE[0x80:0xC0] = True
_PLAIN_BYTE[[0x0A, 0xC2, 0xC3]] = True


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@cache
def ends_word(path: str) -> np.ndarray:
    """For each id, whether it closes a piece."""
    vocab = library(path).get_vocab(with_added_tokens=False)
    found = np.zeros(max(vocab.values()) + 1, bool)
    found[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
    return found


def plain(joined: bytes, words: list[bytes]) -> np.ndarray:
    """Which of the words, joined by line feeds, hold only plain characters and no special token."""
    data = np.frombuffer(joined, np.uint8)
    odd = ~_PLAIN_BYTE[data]
    odd[:-1] |= (data[:-1] == 0xC2) & (data[1:] < 0xA1)
    out = np.ones(len(words), bool)
    if odd.any():
        out[np.cumsum(data == 0x0A)[odd]] = False
    if SPECIAL in joined:
        out &= np.fromiter((SPECIAL not in w for w in words), bool, len(words))
    return out


class Store:
    """Ids of pieces in the order they were learnt."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.place.update(zip(pieces, count(len(self.place))))
        self._append(ids, sizes)

    def _append(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, ids))

    def get(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        sizes = self.sizes[at]
        return self.ids[ragged(self.starts[at], sizes)], sizes


class WordStore(Store):
    """Ids of words, found by two hashes of theirs in an open table that is probed for many words at once."""

    def __init__(self) -> None:
        super().__init__()
        self.bits = SLOT_BITS
        self.table = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros((2, 0), np.uint64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys[0] >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each word, or -1."""
        out, slot, left = np.full(keys.shape[1], -1, np.int64), self._slots(keys), np.arange(keys.shape[1])
        while len(left):
            at = self.table[slot[left]]
            left, at = left[at >= 0], at[at >= 0]
            same = (self.keys[0, at] == keys[0, left]) & (self.keys[1, at] == keys[1, left])
            out[left[same]] = at[same]
            left = left[~same]
            slot[left] = (slot[left] + 1) & (len(self.table) - 1)
        return out

    def learn(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Add words that are not there yet, no two alike. The table is never more than half full."""
        self.keys = np.concatenate((self.keys, keys), axis=1)
        self._append(ids, sizes)
        if 2 * len(self.sizes) > len(self.table):
            self.bits = len(self.sizes).bit_length() + 1
            self.table = np.full(1 << self.bits, -1, np.int32)
            self._enter(0)
        else:
            self._enter(len(self.sizes) - len(sizes))

    def _enter(self, from_: int) -> None:
        number = np.arange(from_, len(self.sizes), dtype=np.int32)
        slot, left = self._slots(self.keys[:, from_:]), np.arange(len(number))
        while len(left):
            free = left[self.table[slot[left]] < 0]
            self.table[slot[free]] = number[free]
            left = left[self.table[slot[left]] != number[left]]
            slot[left] = (slot[left] + 1) & (len(self.table) - 1)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_KEPT = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def cut_words(data: memoryview, row_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of all rows start and stop, and how many each row has."""
    inside = ~_SPACE[np.frombuffer(data, np.uint8)]
    joined = np.zeros(len(inside) + 1, bool)
    if len(inside):
        joined[1:-1] = inside[1:] & inside[:-1]
    joined[row_ends] = False
    starts = np.flatnonzero(inside & ~joined[:-1])
    return starts, np.flatnonzero(inside & ~joined[1:]) + 1, np.diff(np.searchsorted(starts, row_ends))


def word_keys(data: memoryview, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of every word, eight bytes of all words at a time; words of more than `LONG` bytes one by one."""
    padded = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)))
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    size = stops - starts
    one = mix64(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    two = size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for i in np.flatnonzero(size > LONG).tolist():
        whole = xxhash.xxh3_128_intdigest(data[starts[i]:stops[i]])
        one[i], two[i] = whole >> 64, whole & (2 ** 64 - 1)
    live, k = np.flatnonzero(size <= LONG), 0
    while len(live):
        lane = eight[starts[live] + k] & _KEPT[np.minimum(size[live] - k, 8)]
        one[live] = mix64(one[live] + lane)
        two[live] = mix64(two[live] ^ (lane * np.uint64(0xD6E8FEB86659FD93)))
        k += 8
        live = live[size[live] > k]
    return np.stack((one, two))


class WordIds:
    """Ids of words, piece by piece; `occurrences` is all that callers need."""

    def __init__(self, path: str):
        self.path = path
        self.words, self.young, self.old = WordStore(), Store(), Store()

    def occurrences(self, data: memoryview, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and the start and size of every word in it, repeated words included."""
        if len(self.words.sizes) > STORE_WORDS:
            self.words = WordStore()
        keys = word_keys(data, starts, stops)
        at = self.words.find(keys)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            _, first, place = np.unique(keys[0, missing], return_index=True, return_inverse=True)
            new = missing[first]
            if (keys[1, missing] != keys[1, new][place]).any():
                raise ValueError("two different words share a hash")
            raw = bytes(data)
            pool, begin, sizes = self.ids_of([raw[a:b] for a, b in zip(starts[new].tolist(), stops[new].tolist())])
            at[missing] = len(self.words.sizes) + place
            self.words.learn(keys[:, new], pool[ragged(begin, sizes)], sizes)
        return self.words.ids, self.words.starts[at], self.words.sizes[at]

    def _learn(self, pieces: list[str]) -> None:
        """Bring all pieces into the young store: from the old one, or encoded by the library many at a time."""
        if len(self.young.place) > STORE_PIECES:
            self.young, self.old = Store(), self.young
        missing = [p for p in dict.fromkeys(pieces) if p not in self.young.place]
        known = [p for p in missing if p in self.old.place]
        if known:
            self.young.add(known, *self.old.get(known))
            missing = [p for p in missing if p not in self.old.place]
        if missing:
            texts = [" ".join(missing[i:i + TOGETHER]) for i in range(0, len(missing), TOGETHER)]
            flat = list(chain.from_iterable(e.ids for e in library(self.path).encode_batch_fast(texts, add_special_tokens=False)))
            ids = np.array(flat, np.uint32)
            stops = np.flatnonzero(ends_word(self.path)[ids]) + 1
            if len(stops) != len(missing):
                raise ValueError("the vocabulary cuts pieces otherwise than its pattern")
            self.young.add(missing, ids, np.diff(stops, prepend=0))

    def _odd(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [e.ids for e in library(self.path).encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter(chain.from_iterable(encoded), np.uint32, int(sizes.sum())), sizes

    def ids_of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and each word's start and size in it."""
        joined = b"\n".join(words)
        own = plain(joined, words)
        odd = np.flatnonzero(~own)
        if len(odd):
            joined = b"\n".join(w for w, ok in zip(words, own) if ok)
        cut = PIECES.findall(joined.decode().lower())
        pieces = [p for p in cut if p != "\n"]
        self._learn(pieces)
        ids, sizes = self.young.get(pieces)
        breaks = np.fromiter((p == "\n" for p in cut), bool, len(cut))
        word_of = np.cumsum(breaks)[~breaks]
        starts, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        total = np.bincount(word_of, sizes, int(own.sum())).astype(np.int64) if own.any() else np.zeros(0, np.int64)
        lengths[own] = total
        starts[own] = np.cumsum(total) - total
        if len(odd):
            more, lengths[odd] = self._odd([words[i] for i in odd])
            starts[odd] = len(ids) + np.cumsum(lengths[odd]) - lengths[odd]
            ids = np.concatenate((ids, more))
        return ids, starts, lengths


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def encode_rows(data: memoryview, row_ends: np.ndarray, path: str, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every row in order and each row's count; `end_id` is appended to each row."""
    first, stops, counts = cut_words(data, row_ends)
    pool, starts, sizes = word_ids(path).occurrences(data, first, stops)
    if end_id is not None:
        # The end id is one more word that follows the words of each row.
        place = np.arange(len(starts)) + np.repeat(np.arange(len(counts)), counts)
        counts = counts + 1
        pool = np.append(pool, np.uint32(end_id))
        closed = np.full((2, int(counts.sum())), [[len(pool) - 1], [1]])
        closed[0, place], closed[1, place] = starts, sizes
        starts, sizes = closed
    ids = pool[ragged(starts, sizes)]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    stop = np.cumsum(counts)
    return ids, ends[stop] - ends[stop - counts]
