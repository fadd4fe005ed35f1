"""HyperMinHash sketches of shingle sets: per bucket the leading-zero count and the next mantissa bits of its least hash.

A 64-bit shingle hash is dealt to one of `BUCKETS` by its top bits; of the rest, the least value of each bucket is kept as a
register of `LZ_BITS` bits of leading zeros (plus one; 0 is an empty bucket) and `MANTISSA` bits that follow the first one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from voltframe.llm.common import mix64, numbered, words_of

SHINGLE = 5
BUCKETS = 128
MANTISSA = 10
REST = 57
_U = np.uint64


def shingles(data: memoryview, ends: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, row after row, and each row's count. Rows with fewer words than a
    shingle have their whole sequence as one; rows without words have none."""
    words, n = words_of(data, ends)
    distinct, at = numbered(words)
    del words
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), _U, len(distinct))[at] if len(at) else np.zeros(0, _U)
    first = np.cumsum(n) - n
    per = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), per)
    start = first[row] + np.arange(len(row)) - (np.cumsum(per) - per)[row]
    value = np.full(len(row), _U(0x9AE16A3B2F90404F)) + np.minimum(n[row], size).astype(_U)
    for k in range(size):
        inside = start + k < (first + n)[row]
        step = np.where(inside, hashes[np.minimum(start + k, len(hashes) - 1)], _U(0)) if len(hashes) else np.zeros(0, _U)
        value = mix64(value * _U(0x9FB21C651E98DF25) + step)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(row[new], minlength=len(n))


def fingerprint(own: np.ndarray) -> bytes:
    """128 bits that stand for the set."""
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def registers(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The sketch of every row (rows × BUCKETS)."""
    row = np.repeat(np.arange(len(n)), n)
    bucket = (values >> _U(REST)).astype(np.int64)
    rest = values & _U((1 << REST) - 1)
    cell = row * BUCKETS + bucket
    least = np.ones(len(cell), bool)
    least[1:] = cell[1:] != cell[:-1]
    rest = rest[least] | _U(1)
    top = np.frexp(rest.astype(np.float64))[1] - 1
    top -= (rest >> top.astype(_U)) == 0  # rounding up to the next power of two
    below = np.where(top >= MANTISSA, rest >> np.maximum(top - MANTISSA, 0).astype(_U), rest << np.maximum(MANTISSA - top, 0).astype(_U))
    out = np.zeros(len(n) * BUCKETS, np.uint16)
    out[cell[least]] = ((REST - top) << MANTISSA) + (below.astype(np.int64) & ((1 << MANTISSA) - 1))
    return out.reshape(len(n), BUCKETS)


def _choices(bands: int, rows: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.stack([rng.permutation(BUCKETS)[:rows] for _ in range(bands)])


_ORDER = np.stack([np.random.default_rng([7, b]).permutation(BUCKETS) for b in range(BUCKETS)])


def filled(regs: np.ndarray) -> np.ndarray:
    """Sketches whose empty buckets borrow from a full one, each bucket by a random order of its own."""
    out = regs.copy()
    for i in np.flatnonzero((regs == 0).any(1)):
        own = np.flatnonzero(regs[i])
        if len(own):
            empty = np.flatnonzero(regs[i] == 0)
            out[i, empty] = regs[i, own[_ORDER[empty][:, own].argmin(1)]]
    return out


# Two banding schemes: wide bands for all but small sets, narrow bands for small ones; sets in between have both, and two
# sets of similarity 0.85 never differ enough in size to lie on either side of the overlap.
WIDE, NARROW = _choices(40, 6, 11), _choices(40, 4, 13)
WIDE_FROM, NARROW_TO = 100, 150


def band_keys(regs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and band keys of all rows under their schemes."""
    full = filled(regs).astype(_U)
    rows, keys = [], []
    for scheme, choice, own in ((0, WIDE, n >= WIDE_FROM), (1, NARROW, n < NARROW_TO)):
        which = np.flatnonzero(own & (n > 0))
        value = np.broadcast_to(mix64(np.arange(len(choice), dtype=_U) + _U(1000 * scheme + 1)), (len(which), len(choice))).copy()
        for k in range(choice.shape[1]):
            value = mix64(value * _U(0x9FB21C651E98DF25) + full[which][:, choice[:, k]])
        rows.append(np.repeat(which, len(choice)))
        keys.append(value.ravel())
    return np.concatenate(rows), np.concatenate(keys)


def collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected share of buckets whose registers agree by chance for disjoint sets of n and m: the sum over register
    classes of the probability that both sketches hold it, with the mantissas of a class taken as equally likely."""
    lz = np.arange(REST)
    high, low = 2.0 ** -lz, np.where(lz < REST - 1, 2.0 ** -(lz + 1), 0.0)

    def holds(size: np.ndarray) -> np.ndarray:
        x = size[:, None] / BUCKETS
        return np.exp(-x * low) - np.exp(-x * high)

    return (holds(n) * holds(m)).sum(1) / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of paired sketches, and the number of buckets each rests on."""
    used = ((a > 0) | (b > 0)).sum(1)
    same = ((a == b) & (a > 0)).sum(1)
    chance = collisions(n.astype(float), m.astype(float)) * BUCKETS
    return np.clip((same - chance) / np.maximum(used - chance, 1), 0, 1), used
