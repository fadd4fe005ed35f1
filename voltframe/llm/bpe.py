"""Byte-pair encoding by speculation and verification, and decoding.

Texts are cut at the vocabulary's own pattern. For each distinct piece of a slice the longest vocabulary entries from
left to right are proposed as its tokens. The proposal equals the exact merge result if and only if no two neighbours are
incompatible: merging the two alone must give the two back. That is tested for all adjacent pairs of the slice at once.
Pieces with an incompatible pair, and only those, are merged exactly.

Whether two tokens are compatible follows from the merges at their shared edge. While the left token is built up, its last
part takes the values of its right spine, each until a merge of known rank takes it in; the right token's first part does so
along its left spine. A merge across the edge happens if some pair of such parts has a rank that is lower than that of the
left part's own merge, or no higher than that of the right part's.

NULL and empty texts have no tokens. Special tokens in a text are found first, as the library does by default. Repeated rows are
encoded each on its own; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm.common import ragged, read, ship, slices, text_bytes
from voltframe.llm.vocab import tokenizer_path

BYTE_VOCAB = "byte_bpe_50k.json"
STORE_PIECES = 250_000
SHORT = 64
# Fixed value: the vocabulary's split pattern.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file: itself if it is a visible Latin-1
    character, else the next one from U+0100 on."""
    spare = count(0x100)
    return [chr(b) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tables of a byte-level vocabulary file, made once per worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in enumerate(byte_letters())}
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in ids.items():
            if token not in self.special:
                self.bytes[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.id_of = {b: i for i, b in enumerate(self.bytes) if b and i not in self.special.values()}
        self.base = np.array([self.id_of[bytes([b])] for b in range(256)], np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        self.merge = {(a, b): (r, m) for r, (a, b, m) in enumerate(zip(left.tolist(), right.tolist(), made.tolist()))}
        self.size, self.made, self.singles = size, made, self.base.tolist()
        keys = left * size + right
        self._order = np.argsort(keys)
        self._keys = keys[self._order]
        # A token's first merge is the one that makes it; spines follow its right and its left part downwards.
        self.rank = np.full(size, NEVER)
        self.part = np.full((2, size), -1)
        for r in range(len(merges) - 1, -1, -1):
            self.rank[made[r]], self.part[0, made[r]], self.part[1, made[r]] = r, left[r], right[r]
        self.spines = [self._spine(1), self._spine(0)]
        self.whole = self._whole(left, right, made)
        self.pattern = regex.compile(PIECES)
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.pool = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.pool_at = np.cumsum(self.lengths) - self.lengths
        self.by_start: dict[bytes, list[int]] = {}
        for b, i in self.id_of.items():
            if len(b) > 1 and self.whole[i]:
                self.by_start.setdefault(b[:2], []).append(len(b))
        self.by_start = {b: sorted(set(n), reverse=True) for b, n in self.by_start.items()}

    def _spine(self, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Per token its outer parts from the token itself inwards, and the rank of the merge that takes each in."""
        parts, taken = [np.arange(self.size)], [np.full(self.size, NEVER)]
        while True:
            last = parts[-1]
            inner = np.where(last >= 0, self.part[side][last], -1)
            if (inner < 0).all():
                return np.stack(parts, 1), np.stack(taken, 1)
            taken.append(np.where(inner >= 0, self.rank[last], -1))
            parts.append(inner)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, or `NEVER`."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._order[at], NEVER)

    def crossing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The lowest rank of a merge that joins token a to a following token b before either is complete, or `NEVER`."""
        (left, left_taken), (right, right_taken) = self.spines
        out = np.full(len(a), NEVER)
        for i in range(left.shape[1]):
            rows = np.flatnonzero(left[a, i] >= 0)
            for j in range(right.shape[1]):
                rows = rows[right[b[rows], j] >= 0]
                if not len(rows):
                    break
                r = self.ranks(left[a[rows], i], right[b[rows], j])
                happens = (r < left_taken[a[rows], i]) & (r <= right_taken[b[rows], j])
                out[rows] = np.minimum(out[rows], np.where(happens, r, NEVER))
        return out

    def _whole(self, left: np.ndarray, right: np.ndarray, made: np.ndarray) -> np.ndarray:
        """Tokens that the merges make from their own bytes: their parts are, and the parts join by the token's own merge."""
        joins = self.crossing(left, right) == np.arange(len(made))
        joins &= self.rank[made] == np.arange(len(made))
        out = np.zeros(self.size, bool)
        out[self.base] = True
        for a, b, m, ok in zip(left.tolist(), right.tolist(), made.tolist(), joins.tolist()):
            if ok and out[a] and out[b]:
                out[m] = True
        return out

    def exact(self, piece: bytes) -> list[int]:
        """Merge the piece's bytes, lowest rank first, leftmost first among equals."""
        ids = self.base[list(piece)].tolist()
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        alive = [True] * len(ids)
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := self.merge.get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i] = self.merge[a, b][1]
            alive[j] = False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [t for t, live in zip(ids, alive) if live]

    def exact_many(self, pieces: list[bytes]) -> list[list[int]]:
        """`exact` for many short pieces: each round merges in every piece its leftmost pair of lowest rank."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.base[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), size)
        done_ids, done_owner = [], []
        while len(ids):
            rank = np.full(len(ids), NEVER)
            edge = np.flatnonzero(owner[:-1] == owner[1:])
            rank[edge] = self.ranks(ids[edge], ids[edge + 1])
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.minimum.reduceat(rank, first)
            counts = np.diff(first, append=len(ids))
            at = np.flatnonzero((rank == np.repeat(best, counts)) & (rank < NEVER))
            at = at[np.concatenate(([True], owner[at[1:]] != owner[at[:-1]]))] if len(at) else at
            over = np.repeat(best == NEVER, counts)
            done_ids.append(ids[over])
            done_owner.append(owner[over])
            ids[at] = self.made[rank[at]]
            keep = ~over
            keep[at + 1] = False
            ids, owner = ids[keep], owner[keep]
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        flat, stops = ids[order].tolist(), np.searchsorted(owner[order], np.arange(len(pieces) + 1)).tolist()
        return [flat[a:b] for a, b in zip(stops[:-1], stops[1:])]

    def propose(self, piece: bytes) -> list[int]:
        """Longest entries from left to right."""
        get = self.id_of.get
        if (token := get(piece)) is not None and self.whole[token]:
            return [token]
        out, at, end = [], 0, len(piece)
        while at < end:
            for n in self.by_start.get(piece[at:at + 2], ()):
                if n <= end - at and (token := get(piece[at:at + n])) is not None:
                    break
            else:
                n, token = 1, self.singles[piece[at]]
            out.append(token)
            at += n
        return out

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order and each piece's count."""
        proposed = [self.propose(p) for p in pieces]
        n = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(n.sum()))
        if len(flat) < 2:
            return flat, n
        owner = np.repeat(np.arange(len(n)), n)
        edge = np.flatnonzero(owner[:-1] == owner[1:])
        pairs, which = np.unique(flat[edge] * self.size + flat[edge + 1], return_inverse=True)
        bad = self.crossing(pairs // self.size, pairs % self.size) < NEVER
        failed = np.unique(owner[edge[bad[which]]])
        if len(failed):
            short = [i for i in failed.tolist() if len(pieces[i]) <= SHORT]
            for i, ids in zip(short, self.exact_many([pieces[i] for i in short])):
                proposed[i] = ids
            for i in failed.tolist():
                if len(pieces[i]) > SHORT:
                    proposed[i] = self.exact(pieces[i])
            n = np.fromiter(map(len, proposed), np.int64, len(proposed))
            flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(n.sum()))
        return flat, n


class Store:
    """Ids of pieces in the order they were added."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.sizes, self.starts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.place.update(zip(pieces, count(len(self.place))))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))

    def get(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        sizes = self.sizes[at]
        return self.ids[ragged(self.starts[at], sizes)], sizes


class Encoder:
    """Encodes texts with one vocabulary. Ids of pieces are kept between slices in two stores of bounded size: when the
    young one is full it becomes the old one, and pieces still in use come back from there."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.v.special)) + ")") if self.v.special else None
        self.young, self.old = self._fresh(), Store()

    def _fresh(self) -> Store:
        found = Store()
        found.add(list(self.v.special), np.array(list(self.v.special.values()), np.int64), np.ones(len(self.v.special), np.int64))
        return found

    def _learn(self, pieces: list[str]) -> None:
        if len(self.young.place) > STORE_PIECES:
            self.young, self.old = self._fresh(), self.young
        missing = [p for p in dict.fromkeys(pieces) if p not in self.young.place]
        known = [p for p in missing if p in self.old.place]
        if known:
            self.young.add(known, *self.old.get(known))
            missing = [p for p in missing if p not in self.old.place]
        if missing:
            self.young.add(missing, *self.v.encode_pieces([p.encode() for p in missing]))

    def pieces(self, text: str) -> list[str]:
        if self.split_special is None or not any(s in text for s in self.v.special):
            return self.v.pattern.findall(text)
        out: list[str] = []
        for part in self.split_special.split(text):
            out += [part] if part in self.v.special else self.v.pattern.findall(part)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order and each text's count."""
        cut, counts = [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            own = self.pieces(t)
            counts[i] = len(own)
            cut += own
        self._learn(cut)
        ids, sizes = self.young.get(cut)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        stop = np.cumsum(counts)
        return ids, ends[stop] - ends[stop - counts]

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[str]:
        """The texts of the ids; bytes that are no UTF-8 become U+FFFD."""
        sizes = self.v.lengths[ids]
        raw = self.v.pool[ragged(self.v.pool_at[ids], sizes)].tobytes()
        ends = np.concatenate(([0], np.cumsum(sizes)))
        stop = np.cumsum(n)
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[stop - n].tolist(), ends[stop].tolist())]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`carry` and the array of token ids of each text."""
    ship(docs.sparkSession)
    picked = docs.select(*carry, F.col(text).alias("__text"))
    schema = T.StructType([picked.schema[c] for c in carry] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            data, ends = text_bytes(batch, "__text")
            texts = [bytes(data[a:b]).decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            flat, n = encoder(path).encode(texts)
            lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(n))).astype(np.int32), flat.astype(np.int32))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), lists], names=[*carry, ids])

    return picked.mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str, ids: str = "ids", text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`carry` and the text that each array of ids spells."""
    ship(rows.sparkSession)
    picked = rows.select(*carry, ids)
    schema = T.StructType([picked.schema[c] for c in carry] + [T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                column = part.column(ids)
                n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = encoder(path).decode(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), n)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carry), pa.array(texts, pa.string())], names=[*carry, text])

    return picked.mapInArrow(run, schema)


def op6_bpe(spark, sf_dir):
    """Encodes every document, decodes the ids, and returns digests of both."""
    path = tokenizer_path(BYTE_VOCAB)
    rows = encoded(read(spark, sf_dir, "documents"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    carry = ("doc_id", "n_tokens", "ids_sha256")
    return decoded(rows, path, carry=carry).select(*carry, F.sha2("text", 256).alias("decoded_sha256"))
