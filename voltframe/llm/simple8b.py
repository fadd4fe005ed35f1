"""Simple-8b: word-aligned coding of unsigned integers, vectorised over blocks.

A 64-bit word holds a 4-bit selector in its top bits and below it as many equal-width values as fit 60 bits, the first value
lowest. Selector 0 escapes: the word's payload is ignored and the next word holds one raw 64-bit value, for values of more
than 60 bits. Values are cut into blocks of `BLOCK`; each block starts a new word and `offsets` gives its first word, so any
block can be decoded alone and all blocks side by side.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
# How many values of how many bits each selector packs; 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 0
_U = np.uint64
LIMITS = (np.uint64(1) << WIDTHS[1:].astype(np.uint64)) - np.uint64(1)
MOST = int(COUNTS.max())
SHORT = 1 << 16
_CLASS = np.searchsorted(LIMITS, np.arange(SHORT, dtype=np.uint64)).astype(np.uint8)


def _classes(values: np.ndarray) -> np.ndarray:
    """The first selector, less one, whose width holds each value; 14 where none does."""
    return _CLASS[values] if len(values) and values.max() < SHORT else np.searchsorted(LIMITS, values).astype(np.uint8)


def _selectors(classes: np.ndarray) -> np.ndarray:
    """The selector that packs most values from every position on, from sliding maxima of the classes: those over doubled
    windows give those over windows of any width. Behind the end any word fits."""
    n = len(classes)
    doubled = [np.concatenate((classes, np.zeros(MOST, np.uint8)))]
    while 2 ** len(doubled) <= MOST:
        half, step = doubled[-1], 2 ** (len(doubled) - 1)
        doubled.append(np.maximum(half[:-step], half[step:]))
    best = np.full(n, ESCAPE, np.uint8)
    for s in range(len(COUNTS) - 1, 0, -1):
        level = int(COUNTS[s]).bit_length() - 1
        rest = int(COUNTS[s]) - 2 ** level
        top = np.maximum(doubled[level][:n], doubled[level][rest:rest + n])
        best[top < s] = s
    return best


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The coded words and each block's first word. A last, partly filled word is padded with zeros."""
    n = len(values)
    if n == 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    blocks, span = -(-n // BLOCK), BLOCK + MOST
    padded = np.zeros((blocks, span), _U)
    classes = np.zeros((blocks, span), np.uint8)
    full = n // BLOCK
    own = _classes(values)
    for out, given in ((padded, values), (classes, own)):
        out[:full, :BLOCK] = given[:full * BLOCK].reshape(full, BLOCK)
        out[full:, :n - full * BLOCK] = given[full * BLOCK:]
    padded = padded.ravel()
    best = _selectors(classes.ravel())
    # Words follow each other from the start of each block; all blocks advance together.
    follows = np.arange(blocks * span) + COUNTS[best]
    begin = np.arange(blocks) * span
    ends = begin + np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    starts_word = np.zeros(blocks * span, bool)
    at = begin
    while len(at):
        starts_word[at] = True
        at = follows[at]
        live = at < ends
        at, ends = at[live], ends[live]
    head = np.flatnonzero(starts_word)
    sel = best[head]
    place = np.arange(len(head)) + np.cumsum(sel == ESCAPE) - (sel == ESCAPE)
    words = np.zeros(int(place[-1]) + 1 + int(sel[-1] == ESCAPE), _U)
    words[place] = sel.astype(_U) << _U(60)
    for s in np.unique(sel):
        own = np.flatnonzero(sel == s)
        if s == ESCAPE:
            words[place[own] + 1] = padded[head[own]]
            continue
        payload = padded[head[own]]
        for k in range(1, int(COUNTS[s])):
            payload |= padded[head[own] + k] << _U(k * int(WIDTHS[s]))
        words[place[own]] |= payload
    return words, place[np.searchsorted(head, begin)]


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n values; blocks follow each other, so every word is unpacked in one pass per selector."""
    if n == 0:
        return np.zeros(0, _U)
    words = words.astype(_U, copy=False)
    sel = (words >> _U(60)).astype(np.int64)
    head = np.ones(len(words), bool)
    for i in np.flatnonzero(sel == ESCAPE):  # rare: values of more than 60 bits
        if head[i]:
            head[i + 1] = False
    place = np.flatnonzero(head)
    sel = sel[place]
    span = BLOCK + MOST
    owner = np.searchsorted(offsets, place, "right") - 1
    begin = np.cumsum(COUNTS[sel]) - COUNTS[sel]
    begin += owner * span - begin[np.searchsorted(owner, np.arange(len(offsets)))][owner]
    out = np.zeros(len(offsets) * span, _U)
    for s in np.unique(sel):
        own = sel == s
        if s == ESCAPE:
            out[begin[own]] = words[place[own] + 1]
            continue
        mask = (_U(1) << _U(int(WIDTHS[s]))) - _U(1)
        payload, first = words[place[own]], begin[own]
        for k in range(int(COUNTS[s])):
            out[first + k] = (payload >> _U(k * int(WIDTHS[s]))) & mask
    return out.reshape(len(offsets), span)[:, :BLOCK].ravel()[:n]
