"""Fill-in-middle transformation by a piece table.

Two kinds of immutable buffers hold all bytes: the texts of a slice, and the sentinels. A document is a row of descriptors
(buffer, start, length). Cutting splits its one descriptor in three; an arrangement permutes them and puts sentinel
descriptors between; texts never move. Digests stream over descriptors, and a text is only put together where it is asked for.
Restoring starts from an output and its form alone: the output becomes a buffer, is cut at its sentinels, and the inverse
permutation brings its pieces back in order.

A text is cut between units: a run of ASCII letters, or any other single code point. Sentinels cannot be mistaken: texts that
hold one stay plain, and no sentinel can begin inside another or across a seam, because each starts with its only `<`.

NULL counts as the empty text, which stays plain. A NULL id is an empty number in the seed. Repeated rows and ids get
the same cuts if they have the same text; columns that are not carried are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm.common import read, ship, slices, text_bytes

# The sentinels of prefix, suffix and middle, and the order of the pieces of a text in each form.
SENTINELS = b"<P><S><M>"
PREFIX, SUFFIX, MIDDLE = range(3)
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
READING = (PREFIX, MIDDLE, SUFFIX)
PLAIN_SHARE, SPM_SHARE = 90, 20
TEXT, SENTINEL = 0, 1

Piece = tuple[int, int, int]
Choose = Callable[[object, int], tuple[int, int, str]]

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class Units:
    """Where the units and the code points of the rows of a byte buffer start."""

    def __init__(self, data: memoryview, ends: np.ndarray):
        raw = np.frombuffer(data, np.uint8)
        point = (raw & 0xC0) != 0x80
        letter = _LETTER[raw]
        goes_on = letter.copy()
        goes_on[1:] &= letter[:-1]
        rows = ends[:-1][ends[:-1] < ends[1:]]
        goes_on[rows] = False
        self.ends = ends
        self.starts = np.flatnonzero(point & ~goes_on)
        self.points = np.concatenate(([0], np.cumsum(point)))
        self.first = np.searchsorted(self.starts, ends)
        self.counts = np.diff(self.first)
        odd = np.flatnonzero((raw[:-2] == 60) & (raw[2:] == 62) & np.isin(raw[1:-1], [80, 83, 77])) if len(raw) > 2 else np.zeros(0, np.int64)
        self.special = np.zeros(len(self.counts), bool)
        row = np.searchsorted(ends, odd, "right") - 1
        self.special[row[odd + 3 <= ends[row + 1]]] = True

    def byte(self, row: int, unit: int) -> int:
        """The byte at which a row's unit starts, or the row's end."""
        return int(self.starts[self.first[row] + unit]) if unit < self.counts[row] else int(self.ends[row + 1])


def cut(piece: Piece, *places: int) -> list[Piece]:
    """A descriptor split at places of its buffer."""
    buffer, start, length = piece
    edges = [start, *places, start + length]
    return [(buffer, a, b - a) for a, b in zip(edges, edges[1:])]


def arranged(pieces: list[Piece], form: str) -> list[Piece]:
    """Prefix, middle and suffix in the order of the form, each behind its sentinel."""
    named = dict(zip(READING, pieces))
    return [d for kind in ORDER[form] for d in ((SENTINEL, 3 * kind, 3), named[kind])]


def restored(output: bytes, form: str) -> list[Piece]:
    """Descriptors of the original text over an output as buffer TEXT."""
    if form == "plain":
        return [(TEXT, 0, len(output))]
    order = ORDER[form]
    marks, at = [], 0
    for kind in order:
        at = output.index(SENTINELS[3 * kind:3 * kind + 3], at)
        marks.append(at)
        at += 3
    named = {kind: (TEXT, a + 3, b - a - 3) for kind, a, b in zip(order, marks, [*marks[1:], len(output)])}
    return [named[kind] for kind in READING]


def digest(pieces: list[Piece], buffers: tuple) -> str:
    state = hashlib.sha256()
    for buffer, start, length in pieces:
        state.update(buffers[buffer][start:start + length])
    return state.hexdigest()


def joined(pieces: list[Piece], buffers: tuple) -> bytes:
    return b"".join(bytes(buffers[buffer][start:start + length]) for buffer, start, length in pieces)


def seeded(doc_id: object, n: int) -> tuple[int, int, str]:
    """Units before the middle, units before the suffix, and the form of a text of n units, drawn from its id."""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return a, b, "plain" if h3 % 100 >= PLAIN_SHARE else "spm" if h4 % 100 < SPM_SHARE else "psm"


def transformed(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), choose: Choose = seeded, digests: bool = False) -> DataFrame:
    """The carried columns, the first of which seeds the draw, with `n`, `form`, `prefix_chars`, `middle_chars`, and either
    `output`, or digests of the output and of the text restored from it."""
    ship(docs.sparkSession)
    picked = docs.select(*carry, F.col(text).alias("__text"))
    last = ["output_sha256", "restored_sha256"] if digests else ["output"]
    schema = T.StructType([*[picked.schema[c] for c in carry], T.StructField("n", T.LongType(), False), T.StructField("form", T.StringType(), False),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           *[T.StructField(c, T.StringType(), False) for c in last]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            data, ends = text_bytes(batch, "__text")
            units, buffers = Units(data, ends), (data, SENTINELS)
            forms, prefixes, middles, results = [], [], [], []
            for r, (key, n) in enumerate(zip(batch.column(carry[0]).to_pylist(), units.counts.tolist())):
                whole = (TEXT, int(ends[r]), int(ends[r + 1] - ends[r]))
                a, b, form = choose(key, n)
                if not n or units.special[r]:
                    form = "plain"
                pieces, prefix, middle = [whole], None, None
                if form != "plain":
                    at, to = units.byte(r, a), units.byte(r, b)
                    pieces = arranged(cut(whole, at, to), form)
                    prefix, middle = (int(units.points[y] - units.points[x]) for x, y in ((whole[1], at), (at, to)))
                forms.append(form)
                prefixes.append(prefix)
                middles.append(middle)
                output = joined(pieces, buffers)
                results.append((digest(pieces, buffers), digest(restored(output, form), (output,))) if digests else (output,))
            columns = [pa.array(units.counts), pa.array(forms), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64())]
            columns += [pa.array(c, pa.binary() if not digests else None).cast(pa.string()) for c in zip(*results)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], *columns], [*carry, "n", "form", "prefix_chars", "middle_chars", *last])

    return picked.mapInArrow(run, schema)


def originals(outputs: DataFrame, output: str = "output", form: str = "form", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The carried columns and `text`, restored from outputs and their forms. NULL outputs give NULL."""
    ship(outputs.sparkSession)
    picked = outputs.select(*carry, F.col(output).alias("__out"), F.col(form).alias("__form"))
    schema = T.StructType([*[picked.schema[c] for c in carry], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__out"):
            rows = zip(batch.column("__out").to_pylist(), batch.column("__form").to_pylist())
            texts = [None if o is None else joined(restored(o.encode(), f), (o.encode(),)).decode() for o, f in rows]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(texts, pa.string())], [*carry, "text"])

    return picked.mapInArrow(run, schema)


def op13_fill_in_middle(spark, sf_dir):
    """Cuts and arranges every document, with digests of the output and of the text restored from it."""
    docs = read(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long"))
    return transformed(docs, digests=True)


ORACLE_SQL = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(u[greatest(a, b) + 1:], '') AS s FROM drawn),
outputs AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM parts),
marks AS (SELECT *, strpos(o, '<P>') AS ip, strpos(o, '<S>') AS is_, strpos(o, '<M>') AS im FROM outputs)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(o) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN o
              WHEN 'psm' THEN substr(o, 4, is_ - 4) || substr(o, im + 3) || substr(o, is_ + 3, im - is_ - 3)
              ELSE substr(o, ip + 3, im - ip - 3) || substr(o, im + 3) || substr(o, 4, ip - 4) END) AS restored_sha256
FROM marks
"""
