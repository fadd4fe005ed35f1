"""Secret scans: an Aho-Corasick prefilter, anchored expressions near its hits, embedded checksums.

One pass of a keyword automaton over a slice of lower-cased UTF-8 bytes yields the places where a secret can begin; only
there an expression is matched, anchored at the hit. Hex runs have no keyword: their prefilter is a byte-class table, whose
runs of sufficient length are found vectorised. Tokens of services that embed a CRC-32 are kept only if it is right.

Kinds, in order: assign, access, hex (the base), then github, npm and pem. A span covers the whole match, in code points,
end exclusive; spans of one kind never overlap. The body of a private key ends at the next row of five dashes, so text behind
a key without an end is not read again and again. NULL and empty texts have no spans; repeated rows are scanned each on its own.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm.common import read, ship, slices, text_bytes

KINDS = ("assign", "access", "hex", "github", "npm", "pem")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16

# The patterns of the base kinds and the public formats of the others.
PATTERNS = {
    "assign": re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "pem": re.compile(rb"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s:,]*+(?:-(?!----)[A-Za-z0-9+/=\s:,]*+)*+-----END ([A-Z]+ )*PRIVATE KEY-----"),
}
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "apikey", "api_key"],
    "access": ["akia"],
    "github": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
    "npm": ["npm_"],
    "pem": ["-----begin "],
}
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType(), False), T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]))


def checksum62(body: bytes) -> bytes:
    """CRC-32 of the body as six base-62 digits, the tail of tokens that carry their own check."""
    value, out = zlib.crc32(body), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out.encode()


def sound(kind: str, m: re.Match) -> bool:
    """Length or checksum of a match; a failing match still uses up its characters."""
    if kind == "assign":
        return len(m[2]) >= ASSIGN_MIN
    if kind == "access":
        return len(m[0]) >= ACCESS_MIN
    if kind in ("github", "npm"):
        return checksum62(m[1][:30]) == m[1][30:]
    return True


@cache
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for w in words:
            found.add_word(w, (kind, len(w)))
    found.make_automaton()
    return found


_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True


def hex_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of lower-case hex bytes inside each row, `HEX_MIN` or longer: byte starts and stops."""
    inside = _HEX[data]
    joined = np.zeros(len(data) + 1, bool)
    joined[1:-1] = inside[1:] & inside[:-1]
    joined[ends] = False
    starts = np.flatnonzero(inside & ~joined[:-1])
    stops = np.flatnonzero(inside & ~joined[1:]) + 1
    long = stops - starts >= HEX_MIN
    return starts[long], stops[long]


def scan(data: bytes, ends: np.ndarray) -> list[list[tuple[str, int, int]]]:
    """Per row its spans in code points, ordered by start, then kind."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    hits: dict[str, list[int]] = {k: [] for k in KEYWORDS}
    for last, (kind, size) in automaton().iter(data.lower().decode("latin-1")):
        hits[kind].append(last - size + 1)
    for kind, places in hits.items():
        pattern, done = PATTERNS[kind], 0
        of = np.searchsorted(ends, np.array(places, np.int64), "right") - 1
        for at, row in zip(places, of.tolist()):
            if at < done:
                continue
            if m := pattern.match(data, at, int(ends[row + 1])):
                done = m.end()
                if sound(kind, m):
                    rows.setdefault(row, []).append((at, KINDS.index(kind), done))
    starts, stops = hex_runs(np.frombuffer(data, np.uint8), ends) if data else (np.zeros(0, int), np.zeros(0, int))
    for at, end, row in zip(starts.tolist(), stops.tolist(), (np.searchsorted(ends, starts, "right") - 1).tolist()):
        rows.setdefault(row, []).append((at, KINDS.index("hex"), end))
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(len(ends) - 1)]
    for row, found in rows.items():
        place, chars = int(ends[row]), 0
        points: dict[int, int] = {}
        for p in sorted({x for at, _, end in found for x in (at, end)}):
            chars += len(data[place:p].decode("utf-8", "replace")) if p > place else 0
            place, points[p] = p, chars
        out[row] = [(KINDS[k], points[at], points[end]) for at, k, end in sorted(found)]
    return out


def spans(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`carry` and `__spans`, the array of (kind, start, end) of each text."""
    ship(docs.sparkSession)
    picked = docs.select(*carry) if text in carry else docs.select(*carry, F.col(text).alias("__text"))
    name = text if text in carry else "__text"
    schema = T.StructType([picked.schema[c] for c in carry] + [T.StructField("__spans", SPANS)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, name):
            data, ends = text_bytes(batch, name)
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in scan(bytes(data), ends)]
            columns = [batch.column(c) for c in carry] + [pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, "__spans"])

    return picked.mapInArrow(run, schema)


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, found: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span replaced by the mask; overlapping spans of different kinds become one."""
    ordered = F.array_sort(found, lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    kept = F.aggregate(
        ordered, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mask)))
             .otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"))))
    return F.when(F.size(found) > 0, kept).otherwise(text)


def op2_secrets(spark, sf_dir):
    """Counts of the base kinds, the digest of the base spans and all spans of every document."""
    base = F.filter("__spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def n(kind: str) -> Column:
        return F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans(read(spark, sf_dir, "documents")).select(
        "doc_id", *[n(k) for k in KINDS[:3]], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"))

