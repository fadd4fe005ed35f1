"""Packing by shortest-pack-first over the length histogram.

Documents are encoded where they lie and cut into pieces of at most `capacity` ids. Only the histogram of piece lengths, at
most `capacity` rows, reaches the driver. There lengths are placed longest first, each into the packs with most room, and
packs of equal content are kept as one pattern with a count. A piece then finds its sequence by its rank among the pieces of
its length: its rank in its partition plus the pieces of that length in the partitions before.

NULL and empty texts are one piece that holds the end id. Repeated rows are packed each on its own.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltframe.llm.common import read, ship, slices, staged, text_bytes
from voltframe.llm.vocab import WORD_VOCAB, encode_rows, tokenizer_path

CAPACITY = 4096
END_ID = 2
PIECE = "part long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, rank long"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

Pattern = tuple[int, list[tuple[int, int]]]


def patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Packing patterns (count of packs, [(length, times), …]) that hold the histogram exactly.

    A length goes to the packs with most room first, once around before any gets another; packs that stay roomier than
    all others take several at once. What fits nowhere opens new packs, filled with that length.
    """
    by_room: dict[int, list[Pattern]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, pattern: Pattern) -> None:
        if not by_room[room]:
            heapq.heappush(rooms, -room)
        by_room[room].append(pattern)

    def widest() -> int:
        while rooms and not by_room[-rooms[0]]:
            heapq.heappop(rooms)
        return -rooms[0] if rooms else 0

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = widest()
            if room < length:
                each = capacity // length
                packs, rest = divmod(left, each)
                if packs:
                    put(capacity - each * length, (packs, [(length, each)]))
                if rest:
                    put(capacity - rest * length, (1, [(length, rest)]))
                break
            packs, content = by_room[room].pop()
            second = widest() if room - length > 0 else 0
            times = min(room // length, max(1, -(-(room - max(second, length - 1)) // length)))
            if left < packs:
                put(room, (packs - left, content))
                packs = left
            times = min(times, left // packs)
            put(room - times * length, (packs, [*content, (length, times)]))
            left -= packs * times
    return [p for group in by_room.values() for p in group]


def slots(found: list[Pattern]) -> np.ndarray:
    """Rows (length, first rank, packs, first sequence, offset), ordered by length and rank. Two patterns at most are added
    per step of the histogram, so the table is bounded by the capacity, not by the corpus."""
    rows, ranks, sequence = [], defaultdict(int), 0
    for packs, content in found:
        offset = 0
        for length, times in content:
            rows.append((length, ranks[length], packs, sequence, offset))
            ranks[length] += packs * times
            offset += length * times
        sequence += packs
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document, with its rank among the pieces of its length in the same partition."""
    ship(docs.sparkSession)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text"):
            ids, n = encode_rows(*text_bytes(batch, "text"), path, end_id)
            first = np.cumsum(n) - n
            cuts = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), cuts)
            start = (np.arange(len(doc)) - (np.cumsum(cuts) - cuts)[doc]) * capacity
            length = np.minimum(capacity, n[doc] - start)
            raw = memoryview(ids.astype("<u4").tobytes())
            at = first[doc] + start
            crc = np.fromiter((zlib.crc32(raw[4 * a:4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())), np.int64, len(doc))
            order = np.argsort(length, kind="stable")
            sizes = length[order]
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.arange(len(doc)) - np.searchsorted(sizes, sizes) + seen[sizes]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_pydict({
                "part": np.full(len(doc), part), "doc_id": batch.column("doc_id").take(pa.array(doc)), "start": start, "length": length,
                "ids_crc32": crc, "doc_tokens": n[doc], "rank": rank})

    return picked.mapInArrow(run, PIECE)


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their sequence and offset. `cut` must be a written table: its ranks are read more than once."""
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(patterns(histogram, capacity))
    keys = (table[:, 0] << 44) + table[:, 1]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = cut.join(earlier, ["part", "length"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("rank") + F.col("earlier")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            slot = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            inside = rank - slot[:, 1]
            columns = {c: batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            yield pa.RecordBatch.from_pydict(columns | {
                "sequence_id": slot[:, 3] + inside % slot[:, 2], "offset": slot[:, 4] + inside // slot[:, 2] * length})

    return ranked.mapInArrow(run, PLACED)


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    cut = staged(pieces(docs, path or tokenizer_path(WORD_VOCAB), capacity, end_id), "pieces")
    return placed(cut, capacity)


def op9_packing(spark, sf_dir):
    """All documents packed into sequences of at most 4096 ids."""
    return packed(read(spark, sf_dir, "documents"))
