"""Periodic runs of words by online dyadic square catching.

The words of a text arrive on a tape. Every completed block of w = 2, 4, 8, … words that starts at a multiple of w is a
catcher. It waits for its own words to come again after q words, 2w - 1 <= q <= 4w - 2 (blocks of two: 1 <= q <= 6): a run of
period q is long enough to hold such a block together with its repetition, so none is missed. Each appended word completes
one window per size, whose name is compared with the two or three catchers that may await it. A hit starts a suffix
comparison at distance q: leftwards as far as the words agree, then on with every appended word until one differs. While it
spans at least q words, the words seen end with a square; squares that follow each other at one distance are one run. A run
that reaches the end of the tape stays open and goes on with the next words.

Names of windows are 64-bit hashes, each made of the names of its halves; numpy compares all windows of a piece of tape at
once, and comparisons advance by doubled windows. Equal words have equal names, so no run is missed, and every reported run
is held against the words themselves. A comparison at a multiple of a run's period ends where the run ends and is no run of
its own: of equal spans the least period stays.

Texts of a slice share a tape, parted by marks that occur once. NULL and texts without words have no runs. Repeated rows and
repeated ids are searched each on its own; runs of equal length are told apart by start, then period; columns that are not
carried are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm.common import mix64, numbered, ragged, read, ship, slices, text_bytes, words_of

LEAST_WORDS = 12
TAPE_WORDS = 1 << 18
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
_RUN = pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")])

Arrange = Callable[[pa.RecordBatch, np.ndarray], Iterator[tuple[int, np.ndarray]]]


class Catchers:
    """The catchers of one tape of at most `size` words; no run is longer than `longest`."""

    def __init__(self, size: int, longest: int):
        self.n = 0
        self.words = np.empty(size, np.int64)
        widths = [1, 2]
        while 4 * widths[-1] - 1 <= longest // 2:
            widths.append(2 * widths[-1])
        self.widths = widths
        self.names = [np.empty(size, np.uint64) for _ in widths]
        self.open = np.zeros((2, 0), np.int64)  # start and period of comparisons that reach the end of the tape
        self.closed: list[np.ndarray] = []

    def append(self, words: np.ndarray) -> None:
        """Advance every comparison over the new words, then let the catchers look at the windows that they complete."""
        old, self.n = self.n, self.n + len(words)
        self.words[old:self.n] = words
        self.names[0][old:self.n] = mix64(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        for level, w in enumerate(self.widths[1:], 1):
            first, stop = max(0, old - w + 1), max(0, self.n - w + 1)
            halves = self.names[level - 1]
            left, right = halves[first:stop], halves[first + w // 2:stop + w // 2]
            self.names[level][first:stop] = mix64(left * np.uint64(0xD1342543DE82EF95) + right)
        starts, periods = self.open
        ends = old + self._agree(np.full(len(starts), old) - periods, np.full(len(starts), old))
        found = [np.stack((starts, ends, periods))]
        for level, w in enumerate(self.widths[1:], 1):
            block, window = self._hits(level, w, max(0, old - w + 1), max(0, self.n - w + 1))
            if len(block):
                starts = block - self._agree(block, window, -1)
                ends = window + self._agree(block, window)
                found.append(np.stack((starts, ends, window - block)))
        starts, ends, periods = np.concatenate(found, axis=1)
        goes_on = ends == self.n
        self.open = np.stack((starts[goes_on], periods[goes_on]))
        self._report(starts[~goes_on], ends[~goes_on], periods[~goes_on])

    def runs(self) -> np.ndarray:
        """(starts, ends, periods) of all runs, ordered by start and period."""
        starts, periods = self.open
        self._report(starts, np.full(len(starts), self.n), periods)
        starts, ends, periods = np.concatenate(self.closed, axis=1)
        order = np.lexsort((periods, ends, starts))
        starts, ends, periods = starts[order], ends[order], periods[order]
        same = (starts[1:] == starts[:-1]) & (ends[1:] == ends[:-1])
        least = np.concatenate(([True], ~same))[:len(starts)]
        found = np.stack((starts[least], ends[least], periods[least]))
        self._confirm(*found)
        return found[:, np.lexsort((found[2], found[0]))]

    def _hits(self, level: int, w: int, first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks and equal windows among those starting at [first, stop); a hit that only prolongs that of the block before
        at the same distance is left out."""
        least, most = (1, 6) if w == 2 else (2 * w - 1, 4 * w - 2)
        names, from_ = self.names[level], max(0, first - w)
        window = np.arange(from_, stop)
        nearest = (window - least) // w * w
        own, blocks, windows = names[from_:stop], [], []
        for k in range((most - least) // w + 1):
            block = nearest - k * w
            hit = (names[np.maximum(block, 0)] == own) & (block >= 0)
            fresh = hit.copy()
            fresh[w:] &= ~hit[:-w]
            fresh[:first - from_] = False
            at = np.flatnonzero(fresh)
            blocks.append(block[at])
            windows.append(window[at])
        return np.concatenate(blocks), np.concatenate(windows)

    def _agree(self, one: np.ndarray, other: np.ndarray, way: int = 1) -> np.ndarray:
        """How many words agree from `one` and `other` on, or before them if `way` is -1; `other` lies to the right."""
        far = np.zeros(len(one), np.int64)
        top = len(self.widths) - 1
        for level in range(top, -1, -1):
            w, names = self.widths[level], self.names[level]
            live = np.arange(len(one))
            while len(live):
                a, b = (p[live] + way * far[live] - (w if way < 0 else 0) for p in (one, other))
                inside = (b + w <= self.n) if way > 0 else (a >= 0)
                live, a, b = live[inside], a[inside], b[inside]
                live = live[names[a] == names[b]]
                far[live] += w
                if level < top:
                    break
        return far

    def _report(self, starts: np.ndarray, ends: np.ndarray, periods: np.ndarray) -> None:
        long = ends - starts >= np.maximum(LEAST_WORDS, 2 * periods)
        self.closed.append(np.stack((starts[long], ends[long], periods[long])))

    def _confirm(self, starts: np.ndarray, ends: np.ndarray, periods: np.ndarray) -> None:
        sizes = ends - starts - periods
        cuts = np.unique(np.searchsorted(np.cumsum(sizes), np.arange(TAPE_WORDS, sizes.sum() + TAPE_WORDS, TAPE_WORDS)))
        for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(sizes)]))):
            at = ragged(starts[a:b], sizes[a:b])
            if not np.array_equal(self.words[at], self.words[at + np.repeat(periods[a:b], sizes[a:b])]):
                raise ValueError("two different windows of words share a name")


def runs_of(ids: np.ndarray, counts: np.ndarray, piece: int = TAPE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start, length and period of the runs of consecutive rows of `counts` words with the given numbers, ordered by
    row, start and period."""
    none = np.zeros(0, np.int64)
    if not len(counts) or counts.max() < LEAST_WORDS:
        return none, none, none, none
    mark = int(ids.max()) + 1
    row = np.arange(len(counts))
    tape = np.insert(ids, np.cumsum(counts), mark + row)
    catchers = Catchers(len(tape), int(counts.max()))
    for i in range(0, len(tape), piece):
        catchers.append(tape[i:i + piece])
    starts, ends, periods = catchers.runs()
    first = np.cumsum(counts + 1) - counts - 1
    owner = np.searchsorted(first, starts, "right") - 1
    return owner, starts - first[owner], ends - starts, periods


def found(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), arrange: Arrange | None = None) -> DataFrame:
    """The carried columns, `n_words`, `runs` (word numbers) and `collapsed`: the words joined by one space, of which each
    run keeps its first period. `arrange` may put other words in place: it yields a row's number and, for each of its
    words, the number of the word that stands there."""
    ship(docs.sparkSession)
    picked = docs.select(*carry, F.col(text).alias("__text"))
    fields = [picked.schema[c] for c in carry]
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType(), False), T.StructField("runs", T.ArrayType(RUN, False), False),
                           T.StructField("collapsed", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            words, counts = words_of(*text_bytes(batch, "__text"), lower=False)
            first = np.cumsum(counts) - counts
            if arrange is not None:
                place = np.arange(len(words))
                for r, own in arrange(batch, counts):
                    place[first[r]:first[r] + counts[r]] = first[r] + own
                words = [words[i] for i in place.tolist()]
            row, start, length, period = runs_of(numbered(words)[1], counts)
            dropped = np.zeros(len(words) + 1, np.int64)
            np.add.at(dropped, first[row] + start + period, 1)
            np.add.at(dropped, first[row] + start + length, -1)
            kept = np.cumsum(dropped)[:-1] == 0
            whole = np.ones(len(counts), bool)
            whole[row] = False
            out = []
            for r, (a, n) in enumerate(zip(first.tolist(), counts.tolist())):
                own = words[a:a + n] if whole[r] else [w for w, k in zip(words[a:a + n], kept[a:a + n].tolist()) if k]
                out.append(b" ".join(own))
            spans = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], fields=list(_RUN))
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(counts)))))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans, type=pa.list_(pa.field("element", _RUN, False)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(counts), lists, pa.array(out, pa.binary()).cast(pa.string())],
                                             [*carry, "n_words", "runs", "collapsed"])

    return picked.mapInArrow(run, schema)


def planted(batch: pa.RecordBatch, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The contract's repetitions in texts whose id has a checksum divisible by ten. A NULL id counts as the empty text,
    whose checksum is 0."""
    for r, (i, n) in enumerate(zip(batch.column("doc_id").to_pylist(), counts.tolist())):
        h = zlib.crc32(b"" if i is None else str(i).encode())
        if h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at = np.arange(n)
        yield r, np.where(at < a, at, a + (at - a) % p)


def op11_periodic_runs(spark, sf_dir):
    """The runs of every document, the longest one, and digests of all runs and of the collapsed text."""
    docs = read(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = found(docs, arrange=planted)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    rows = rows.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
