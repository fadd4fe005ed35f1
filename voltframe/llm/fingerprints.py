"""Document fingerprints by locally consistent parsing.

A text is a row of code points. On every level equal neighbours are first taken together as one symbol (symbol, times). Then
deterministic coin tossing colours the row: a symbol's label is the place of the lowest bit in which it differs from its left
neighbour, and that bit's value; 64-bit names shrink to 128, 14, 8 and 6 labels, and three rounds more leave three colours,
no two neighbours alike. A phrase starts where a colour is higher than both neighbours', so it holds two to four symbols (five at
a row's end, one at its start), and is named by a 64-bit hash of its symbols. The phrases are the symbols of the next level.

Whether a phrase starts at a symbol depends on seven symbols to the left and four to the right, so equal substrings get equal
phrases except near their ends, wherever they stand. The name that the whole text ends with tells texts apart; a phrase of
one symbol keeps its name, so it does not depend on the texts parsed beside it.

A fingerprint is that name and, for level 3 (about 13 code points a phrase), the 64 least distinct phrase names, cut to 32 bits. Texts
with fewer than 16 phrases on a level also keep the level below. Likeness is read on the lowest level that both keep: the
least names of both together estimate the share of common names J, and 2J / (1 + J) is the likeness, exact while all names are kept.
Equal whole names give 1.

NULL counts as the empty text; empty texts are alike among themselves (1) and unlike all others (0). Documents follow each
other by ascending id, NULL ids first, equal ids by a hash of their text, so repeated rows are neighbours; the last is
followed by the first, and a single document by itself. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm.common import mix64, ragged, read, ship, slices, staged, text_bytes

LEVEL, LEAST_NAMES, FEW = 3, 64, 16
SLICE_BYTES = 1 << 20
CHUNK, MARGIN = 1 << 17, 16
_U = np.uint64
_STEP, _TIMES = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


def _toss_table() -> np.ndarray:
    """The next label of (left neighbour, own label) for labels of 7 bits."""
    left, own = np.divmod(np.arange(1 << 14), 128)
    place = np.zeros(len(own), np.int64)
    for bit in range(6, -1, -1):
        place[((left ^ own) >> bit) & 1 == 1] = bit
    return (2 * place + ((own >> place) & 1)).astype(np.uint8)


TOSS = _toss_table()


def _colours(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Three colours for a row of symbols without equal neighbours; `first` marks where rows start."""
    n = len(names)
    differ = names.copy()
    differ[1:] ^= names[:-1]
    differ[first] = _U(1)
    differ[0] = _U(1)
    differ &= ~differ + _U(1)
    place = (differ.astype(np.float64).view(_U) >> _U(52)) - _U(1023)
    label = (_U(2) * place + ((names >> place) & _U(1))).astype(np.uint8)
    for _ in range(3):
        pair = label.astype(np.uint16)
        pair[1:] |= label[:-1].astype(np.uint16) << 7
        following = TOSS[pair]
        following[first] = label[first] & 1
        following[0] = label[0] & 1
        label = following
    for c in (5, 4, 3):
        at = np.flatnonzero(label == c)
        left = np.where(first[at] | (at == 0), 9, label[at - 1])
        last = at == n - 1
        beyond = np.where(last, 0, at + 1)
        right = np.where(last | first[beyond], 9, label[beyond])
        label[at] = np.where((left != 0) & (right != 0), 0, np.where((left != 1) & (right != 1), 1, 2))
    return label


def phrase_starts(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Marks the symbols that start a phrase. Worked off in chunks whose margins hold all that a decision depends on."""
    out = np.zeros(len(names), bool)
    for a in range(0, len(names), CHUNK):
        lo, hi = max(0, a - MARGIN), min(len(names), a + CHUNK + MARGIN)
        begins = first[lo:hi]
        colour = _colours(names[lo:hi], begins).astype(np.int8)
        left, right = np.full(hi - lo, -1, np.int8), np.full(hi - lo, 9, np.int8)
        left[1:] = colour[:-1]
        right[:-1] = np.where(begins[1:], 9, colour[1:])
        top = ((colour > left) & (colour > right)) | begins
        stop = min(len(names), a + CHUNK)
        out[a:stop] = top[a - lo:stop - lo]
    return out


def next_level(names: np.ndarray, counts: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the phrases, phrases of each row, and the code points that each phrase spans."""
    first = np.zeros(len(names), bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    fresh = first.copy()
    fresh[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(fresh)
    times = np.diff(at, append=len(names))
    widths = np.add.reduceat(widths, at)
    names = np.where(times == 1, names[at], mix64(names[at] + times.astype(_U) * _TIMES))
    first = first[at]
    starts = np.flatnonzero(phrase_starts(names, first))
    sizes = np.diff(starts, append=len(names))
    place = (np.arange(len(names)) - np.repeat(starts, sizes)).astype(_U)
    sums = np.add.reduceat(mix64(names + place * _STEP + _U(1)), starts)
    named = np.where(sizes == 1, names[starts], mix64(sums))
    owner = np.cumsum(first)[starts] - 1
    phrases = np.zeros(len(counts), np.int64)
    phrases[counts > 0] = np.bincount(owner, minlength=int((counts > 0).sum()))
    return named, phrases, np.add.reduceat(widths, starts)


def levels(points: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Names, phrases a row and widths of level 1, 2, … until every row is one phrase, at least up to `LEVEL`."""
    names, widths, level = mix64(points.astype(_U) + _STEP), np.ones(len(points), np.int64), 0
    while level < LEVEL or (len(counts) and counts.max() > 1):
        if len(names):
            names, counts, widths = next_level(names, counts, widths)
        yield names, counts, widths
        level += 1


def _least(names: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The least distinct names of every row, as 32-bit numbers."""
    row = np.repeat(np.arange(len(counts)), counts)
    both = np.unique((row.astype(_U) << _U(32)) | (names & _U(0xFFFFFFFF)))
    row = (both >> _U(32)).astype(np.int64)
    edges = np.searchsorted(row, np.arange(len(counts) + 1))
    values = both.astype(np.uint32)
    return [values[a:min(b, a + LEAST_NAMES)] for a, b in zip(edges.tolist(), edges[1:].tolist())]


class Prints:
    """Whole names and sketches of the rows of code points `points`, `counts` of them in each."""

    def __init__(self, points: np.ndarray, counts: np.ndarray):
        self.sketches: list[list[np.ndarray]] = []
        sizes, names = [], np.zeros(0, _U)
        for level, (names, n, _) in enumerate(levels(points, counts)):
            if level < LEVEL:
                self.sketches.append(_least(names, n))
                sizes.append(n)
        self.root = np.zeros(len(counts), _U)
        self.root[counts > 0] = names
        keeps = np.ones(len(counts), bool)
        self.lowest = np.full(len(counts), LEVEL - 1)
        for level in range(LEVEL - 1, 0, -1):
            keeps &= sizes[level] < FEW
            self.lowest[keeps] = level - 1

    def text(self, r: int) -> str:
        kept = (self.sketches[level][r].astype(">u4").tobytes().hex() for level in range(LEVEL - 1, int(self.lowest[r]) - 1, -1))
        return f"{int(self.root[r]):016x}|" + "|".join(kept)

    def like(self, r: int, other: Prints, o: int) -> float:
        if self.root[r] == other.root[o]:
            return 1.0
        level = max(self.lowest[r], other.lowest[o])
        return likeness(self.sketches[level][r], other.sketches[level][o])


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Dice coefficient estimated from two sorted sketches."""
    both = np.union1d(one, other)[:LEAST_NAMES]
    common = len(np.intersect1d(np.intersect1d(one, other, True), both, True))
    return 2 * common / (len(both) + common) if len(both) else 0.0


def compared(fingerprint: str, other: str) -> float:
    """Likeness of two fingerprints as strings."""
    a, b = fingerprint.split("|"), other.split("|")
    if a[0] == b[0]:
        return 1.0
    level = min(len(a), len(b)) - 1
    return likeness(*(np.frombuffer(bytes.fromhex(x[level]), ">u4").astype(np.uint32) for x in (a, b)))


FIELDS = {"doc_id": T.LongType(), "n_chars": T.LongType(), "edited_sha256": T.StringType(), "fingerprint": T.StringType(),
          "edited_fingerprint": T.StringType(), "near_edited": T.DoubleType(), "near_next": T.DoubleType()}
RESULT = T.StructType([T.StructField(c, t) for c, t in FIELDS.items()])
STAGED = T.StructType([*RESULT.fields, T.StructField("part", T.LongType()), T.StructField("head", T.StringType()), T.StructField("text", T.StringType())])


def _points(data: memoryview, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all rows, how many each has, and the byte at which each starts (and the end)."""
    at = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    points = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), "<u4")
    return points, np.diff(np.searchsorted(at, ends)), np.append(at, len(data))


def followed(batch: pa.RecordBatch, own: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
    """Result rows of the texts at `own`, each followed by that at `after`."""
    data, ends = text_bytes(batch, "text")
    points, counts, byte = _points(data, ends)
    first = np.cumsum(counts) - counts
    left = counts[own] - counts[own] // 4
    taken = np.minimum(counts[own] // 4, counts[after])
    at = ragged(np.stack((first[own], first[after]), 1).ravel(), np.stack((left, taken), 1).ravel())
    prints, edited = Prints(points, counts), Prints(points[at], left + taken)
    shas = []
    for r, o, k, m in zip(own.tolist(), after.tolist(), left.tolist(), taken.tolist()):
        state = hashlib.sha256(data[ends[r]:byte[first[r] + k]])
        state.update(data[ends[o]:byte[first[o] + m]])
        shas.append(state.hexdigest())
    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column("doc_id").take(pa.array(own)), "n_chars": counts[own], "edited_sha256": shas,
        "fingerprint": [prints.text(r) for r in own.tolist()], "edited_fingerprint": [edited.text(i) for i in range(len(own))],
        "near_edited": [prints.like(r, edited, i) for i, r in enumerate(own.tolist())],
        "near_next": [prints.like(r, prints, o) for r, o in zip(own.tolist(), after.tolist())]})


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all documents of a partition but the last, then its first and last text, which need another partition."""
    head, open_ = None, None
    for batch in slices(batches, "text", SLICE_BYTES):
        if open_ is not None:
            batch = pa.Table.from_batches([open_, batch]).combine_chunks().to_batches()[0]
        head = batch.column("text")[0].as_py() if head is None else head
        n = batch.num_rows
        open_ = batch.slice(n - 1)
        if n > 1:
            done = followed(batch, np.arange(n - 1), np.arange(1, n))
            none = [pa.nulls(n - 1, t) for t in (pa.int64(), pa.string(), pa.string())]
            yield pa.RecordBatch.from_arrays([*done.columns, *none], STAGED.names)
    if open_ is not None:
        none = [pa.nulls(1, t) for t in (pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)]
        yield pa.RecordBatch.from_arrays([open_.column("doc_id"), *none, pa.array([TaskContext.get().partitionId()], pa.int64()),
                                          pa.array([head]), open_.column("text")], STAGED.names)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of documents that come with the text of the next one."""
    for batch in slices(batches, "text", SLICE_BYTES):
        n = batch.num_rows
        pairs = pa.RecordBatch.from_arrays([pa.concat_arrays([batch.column("doc_id")] * 2),
                                            pa.concat_arrays([batch.column("text"), batch.column("after")])], ["doc_id", "text"])
        yield followed(pairs, np.arange(n), np.arange(n) + n)


def neighbours(docs: DataFrame) -> DataFrame:
    """One row per document with its fingerprint, that of its text edited with the next document's, and likenesses.

    Rows are range-partitioned by id; equal rows are spread, whatever their number. A partition gives all but its last row,
    which meets the first text of the next partition in a join of one row per partition."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    made = staged(ordered.mapInArrow(_inside, STAGED), "fingerprints")
    edges = made.filter("part IS NOT NULL")
    parts = edges.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next"))
    heads = edges.select(F.col("part").alias("next"), F.col("head").alias("after"))
    open_ = edges.join(parts, "part").join(heads, "next").select("doc_id", "text", "after")
    return made.filter("part IS NULL").select(*FIELDS).unionByName(open_.mapInArrow(_across, RESULT))


def phrases(docs: DataFrame, level: int = LEVEL, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The carried columns and `phrases`: start, length (code points) and name of each phrase of one of the levels up to
    `LEVEL`. Equal passages, wherever they stand, share the names inside them."""
    ship(docs.sparkSession)
    picked = docs.select(*carry, F.col(text).alias("__text"))
    one = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("name", T.LongType())])
    schema = T.StructType([*[picked.schema[c] for c in carry], T.StructField("phrases", T.ArrayType(one))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", SLICE_BYTES):
            points, counts, _ = _points(*text_bytes(batch, "__text"))
            for _, (names, n, widths) in zip(range(level), levels(points, counts)):
                pass
            ends = np.cumsum(widths)
            rows = np.concatenate(([0], np.cumsum(n)))
            before = np.repeat(np.cumsum(counts) - counts, n)
            spans = pa.StructArray.from_arrays([pa.array(ends - widths - before), pa.array(widths), pa.array(names.astype(np.int64))], ["start", "length", "name"])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.ListArray.from_arrays(pa.array(rows, pa.int32()), spans)], [*carry, "phrases"])

    return picked.mapInArrow(run, schema)


def op12_fingerprints(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts."""
    return neighbours(read(spark, sf_dir, "documents"))
