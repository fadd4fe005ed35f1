"""Language identification by a linear-chain conditional random field over words.

Each word has a score per language, summed over its features: hashed affixes and character n-grams with learned weights, and
membership of the languages' lexicons. Learned transitions join the words of a text; forward-backward gives each word's
posterior, so text that switches language is labelled word by word. A text's language is the label of most posterior mass.

The field is fitted on the driver to a bounded sample: `TRAIN_DOCS` labelled documents per language (those of least hash,
texts of `TRAIN_CHARS` characters or less first) and `TRAIN_DOCS` times `TRAIN_CHARS` characters. Their pieces are strung together across languages, which is where the
transitions are learned from. Prediction runs where the documents lie, whole texts, a time step for all texts of a slice.

NULL texts and texts without a letter get `und` and score 0. Without any labelled row every text does. Of equally likely
languages the first by name counts. Repeated rows are predicted each on its own and learned from once; rows that share an
id are different documents; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm.common import SLICE_BYTES, crc32_of, numbered, ragged, read, ship, slices, staged, text_bytes, words_of

TRAIN_DOCS = 200
TRAIN_CHARS = 20_000
SHARES = 64
PIECE, PIECES = 12, 6
LEXICON = 300
BITS = 16
CHUNK = 1024
ROUNDS, RATE, DECAY = 40, 0.5, 1e-4
UNKNOWN = "und"
_TRIM = bytes(b for b in range(128) if not chr(b).isalpha())
_LETTER = re.compile(rb"[A-Za-z]")


def trimmed(words: list[bytes]) -> list[bytes]:
    """Words without ASCII signs and digits at either end; empty if nothing is left."""
    return [w.strip(_TRIM) for w in words]


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each word, word after word, and each word's count: n-grams of two to four bytes of the word
    between its edges, so that affixes are the n-grams at an edge, and prefixes and suffixes of one to three bytes."""
    joined = np.frombuffer(b"".join(b"\x01" + w + b"\x02" for w in words), np.uint8).astype(np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    first = np.cumsum(size) - size
    rows, found = [], []

    def add(row: np.ndarray, start: np.ndarray, n: int, salt: int) -> None:
        h = np.full(len(start), salt, np.uint32)
        for k in range(n):
            h = (h ^ joined[start + k]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        rows.append(row)
        found.append((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))

    every = np.arange(len(words))
    for n in (2, 3, 4):
        per = np.maximum(size - n + 1, 0)
        add(np.repeat(every, per), ragged(first, per), n, 0x811C9DC5 + n)
    for n in (1, 2, 3):
        long = every[size - 2 >= n]
        add(long, first[long] + 1, n, 0x1234567 + n)
        add(long, first[long] + size[long] - 1 - n, n, 0x7654321 + n)
    row, value = np.concatenate(rows), np.concatenate(found).astype(np.int64)
    order = np.argsort(row, kind="stable")
    return value[order], np.bincount(row, minlength=len(words))


class Field:
    """Weights of the field: hashed features × languages, lexicon membership, transitions and starts."""

    def __init__(self, langs: list[str], lexicon: dict[bytes, int]):
        n = len(langs)
        self.langs, self.lexicon = langs, lexicon
        self.weights = np.zeros((1 << BITS, n))
        self.member = np.zeros((len(set(lexicon.values())) + 1, n))
        self.moves, self.start = np.zeros((n, n)), np.zeros(n)

    def lexicon_of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((self.lexicon.get(w, 0) for w in words), np.int64, len(words))

    def emissions(self, words: list[bytes]) -> np.ndarray:
        """Scores of distinct words (words × languages)."""
        value, n = features(words)
        at = np.cumsum(n) - n
        return np.add.reduceat(self.weights[value], at) + self.member[self.lexicon_of(words)] if len(words) else np.zeros((0, len(self.langs)))


def _messages(emit: np.ndarray, step: np.ndarray, begin: np.ndarray, token: np.ndarray, at: np.ndarray, length: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What enters each piece of the long texts from the left and from the right. Every piece becomes one matrix, all pieces
    side by side; the matrices of a text are then applied one after the other."""
    n_lang = len(step)
    order = np.argsort(-length, kind="stable")
    through = np.broadcast_to(np.eye(n_lang), (len(at), n_lang, n_lang)).copy()
    for t in range(int(length.max())):
        live = order[:np.searchsorted(-length[order], -t, "left")]
        own = emit[token[at[live] + t]][:, None, :]
        moved = through[live] if t else np.where(opens[live][:, None, None], through[live], step)
        moved = (moved @ step if t else moved) * own
        through[live] = moved / moved.sum((1, 2), keepdims=True)
    left, right = np.empty((len(at), n_lang)), np.ones((len(at), n_lang))
    for i in range(len(at)):
        left[i] = begin if opens[i] else left[i - 1] @ through[i - 1]
        left[i] /= left[i].sum()
    for i in range(len(at) - 2, -1, -1):
        if not opens[i + 1]:
            right[i] = through[i + 1] @ right[i + 1]
            right[i] /= right[i].sum()
    return left, right


def posteriors(scores: np.ndarray, token: np.ndarray, sizes: np.ndarray, moves: np.ndarray, start: np.ndarray,
               most: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many texts at once: `token` are rows of `scores`, text after text, `sizes` their counts.

    Returns the posterior of every token, the summed posteriors of neighbouring labels, and that of the first labels. Texts
    of more than `most` tokens are cut into pieces that run side by side; the messages between pieces are computed first,
    so the result is that of the whole text. Pieces are ordered by length, so the ones that still run at a step are the
    first ones.
    """
    n_lang = scores.shape[1]
    emit = np.exp(scores - scores.max(1, keepdims=True)) if len(scores) else scores
    step, begin = np.exp(moves - moves.max()), np.exp(start - start.max())
    cuts = -(-sizes // most)
    owner = np.repeat(np.arange(len(sizes)), cuts)
    offset = (np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * most
    place, size, opens = (np.cumsum(sizes) - sizes)[owner] + offset, np.minimum(most, sizes[owner] - offset), offset == 0
    left, right = np.broadcast_to(begin, (len(owner), n_lang)).copy(), np.ones((len(owner), n_lang))
    long = np.flatnonzero(cuts[owner] > 1)
    if len(long):
        left[long], right[long] = _messages(emit, step, begin, token, place[long], size[long], opens[long])
    order = np.argsort(-size, kind="stable")
    first, length, opens, left, back = place[order], size[order], opens[order], left[order], right[order]
    longest = int(length[0]) if len(order) else 0
    running = np.searchsorted(-length, -np.arange(longest), "left")
    forward = np.empty((len(token), n_lang))
    for t in range(longest):
        k = running[t]
        at = first[:k] + t
        now = emit[token[at]] * (last[:k] @ step if t else np.where(opens[:k, None], left, left @ step))
        last = now / now.sum(1, keepdims=True)
        forward[at] = last
    both = np.zeros((n_lang, n_lang))
    out = np.empty_like(forward)
    for t in range(longest - 1, -1, -1):
        k = running[t]
        at = first[:k] + t
        own = forward[at] * back[:k]
        own /= own.sum(1, keepdims=True)
        out[at] = own
        joined = np.arange(k) if t else np.flatnonzero(~opens[:k])
        if len(joined):
            ahead = emit[token[at[joined]]] * back[joined]
            before = forward[at - 1] if t else left[joined]
            reach = ahead @ step.T
            norm = (before * reach).sum(1, keepdims=True)
            both += (before / norm).T @ ahead
            if t:
                back[:k] = reach / reach.sum(1, keepdims=True)
    return out, both * step, out[first[opens]].sum(0)


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    """(lang, text) of the training sample: at most `TRAIN_DOCS` distinct rows per language, chosen by hash, and no more of them
    than `TRAIN_DOCS` texts of `TRAIN_CHARS` characters would hold. Only the chosen rows' keys meet the texts, as a table
    of known size; texts are not shuffled."""
    rows = (docs.filter("lang IS NOT NULL AND text IS NOT NULL")
            .withColumn("__key", F.xxhash64("doc_id", "text")).withColumn("__chars", F.length("text")))
    keys = rows.select("lang", "__chars", "__key").distinct()
    # First within shares of a language, so that no task meets more than its share of the candidates of all tasks.
    chosen = keys.withColumn("__share", F.pmod("__key", F.lit(SHARES)))
    order = [F.col("__chars") > TRAIN_CHARS, F.col("__key")]
    for by in (("lang", "__share"), ("lang",)):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        chosen = chosen.withColumn("__r", rank).filter(F.col("__r") <= TRAIN_DOCS).drop("__r")
    running = F.sum("__chars").over(Window.partitionBy("lang").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    chosen = chosen.withColumn("__sum", running).filter(F.col("__sum") <= TRAIN_DOCS * TRAIN_CHARS)
    chosen = staged(chosen.select("lang", "__key"), "sample")
    found = rows.join(chosen, ["lang", "__key"]).groupBy("lang", "__key").agg(F.min("text").alias("text"))
    return sorted((r["lang"], r["text"]) for r in found.select("lang", "text").collect())


def fitted(rows: list[tuple[str, str]]) -> Field | None:
    """Fit the field by gradient steps with per-weight rates on the sample's likelihood."""
    texts = [(lang, [w for w in trimmed(text.encode().lower().split()) if w]) for lang, text in rows]
    texts = [(lang, words) for lang, words in texts if words]
    langs = sorted({lang for lang, _ in texts})
    if not langs:
        return None
    counts = {lang: Counter() for lang in langs}
    for lang, words in texts:
        counts[lang].update(words)
    member: dict[bytes, int] = Counter()
    for bit, lang in enumerate(langs):
        for w, _ in sorted(counts[lang].items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            member[w] |= 1 << bit
    kinds = {m: i + 1 for i, m in enumerate(sorted(set(member.values())))}
    field = Field(langs, {w: kinds[m] for w, m in member.items()})
    # Pieces of all texts, shuffled, strung together: most neighbours stay in their language, some switch.
    rng = np.random.default_rng(5)
    pieces = [(langs.index(lang), words[i:i + PIECE]) for lang, words in texts for i in range(0, len(words), PIECE)]
    pieces = [pieces[i] for i in rng.permutation(len(pieces))]
    words = [w for _, p in pieces for w in p]
    label = np.repeat([lang for lang, _ in pieces], [len(p) for _, p in pieces])
    group = np.repeat(np.arange(len(pieces)) // PIECES, [len(p) for _, p in pieces])
    sizes = np.bincount(group)
    distinct, token = numbered(words)
    value, n = features(distinct)
    at, owner, lexicon = np.cumsum(n) - n, np.repeat(np.arange(len(distinct)), n), field.lexicon_of(distinct)
    n_lang, first = len(langs), np.cumsum(sizes) - sizes
    truth = np.stack([np.bincount(token[label == j], minlength=len(distinct)) for j in range(n_lang)], 1).astype(float)
    inner = np.ones(len(token), bool)
    inner[first] = False
    seen = np.zeros((n_lang, n_lang))
    np.add.at(seen, (label[np.flatnonzero(inner) - 1], label[inner]), 1)
    begun = np.bincount(label[first], minlength=n_lang).astype(float)
    steps = [np.zeros_like(x) + 1e-8 for x in (field.weights, field.member, field.moves, field.start)]
    for _ in range(ROUNDS):
        scores = np.add.reduceat(field.weights[value], at) + field.member[lexicon]
        own, both, starts = posteriors(scores, token, sizes, field.moves, field.start)
        wrong = truth - np.stack([np.bincount(token, own[:, j], len(distinct)) for j in range(n_lang)], 1)
        grads = (
            np.stack([np.bincount(value, wrong[owner, j], 1 << BITS) for j in range(n_lang)], 1),
            np.stack([np.bincount(lexicon, wrong[:, j], len(field.member)) for j in range(n_lang)], 1),
            seen - both, begun - starts)
        for x, g, s in zip((field.weights, field.member, field.moves, field.start), grads, steps):
            g = g / len(token) - DECAY * x / len(langs)
            s += g * g
            x += RATE * g / np.sqrt(s)
    return field


def identified(docs: DataFrame, field: Field | None, text: str = "text", carry: tuple[str, ...] = ("doc_id",), runs: bool = False,
               slice_bytes: int = SLICE_BYTES, sure: bool = False) -> DataFrame:
    """`carry`, `lang_pred` and `score`; with `runs` also the labelled word runs (lang, words) of every text, with `sure` the
    mean of its words' largest posteriors, whichever languages these are of."""
    ship(docs.sparkSession)
    picked = docs.select(*carry) if text in carry else docs.select(*carry, F.col(text).alias("__text"))
    name = text if text in carry else "__text"
    kind = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("words", T.LongType())]))
    schema = T.StructType([picked.schema[c] for c in carry] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
                          + [T.StructField("runs", kind)] * runs + [T.StructField("sure", T.DoubleType())] * sure)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, name, slice_bytes):
            lang, score, spans, certain = labelled(field, *text_bytes(batch, name), runs)
            columns = [*(batch.column(c) for c in carry), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            if runs:
                columns.append(pa.array([[{"lang": a, "words": b} for a, b in s] for s in spans], pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))))
            if sure:
                columns.append(pa.array(certain, pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return picked.mapInArrow(run, schema)


def labelled(field: Field | None, data: memoryview, ends: np.ndarray,
             runs: bool = False) -> tuple[list[str], np.ndarray, list[list[tuple[str, int]]], np.ndarray]:
    """Language, score, if asked word runs, and how sure the words' labels are, of each row."""
    n = len(ends) - 1
    raw = bytes(data)
    lettered = [bool(_LETTER.search(raw, a, b)) or any(c.isalpha() for c in raw[a:b].decode("utf-8", "replace"))
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    spans: list[list[tuple[str, int]]] = [[] for _ in range(n)]
    if field is None or not any(lettered):
        return [UNKNOWN] * n, np.zeros(n), spans, np.zeros(n)
    words, counts = words_of(data, ends)
    distinct, at = numbered(words)
    del words
    bare, to = numbered(trimmed(distinct))
    at = to[at]
    empty = bare.index(b"") if b"" in bare else -1
    row = np.repeat(np.arange(n), counts)
    used = at != empty
    token, row = at[used], row[used]
    sizes = np.bincount(row, minlength=n)
    own, _, _ = posteriors(field.emissions(bare), token, sizes, field.moves, field.start)
    mass = np.stack([np.bincount(row, own[:, j], n) for j in range(own.shape[1])], 1)
    best = mass.argmax(1)
    score = np.clip(mass[np.arange(n), best] / np.maximum(sizes, 1), 0, 1)
    certain = np.clip(np.bincount(row, own.max(1), n) / np.maximum(sizes, 1), 0, 1)
    known = (sizes > 0) & np.array(lettered)
    if runs and len(token):
        label = own.argmax(1)
        cut = np.flatnonzero(np.concatenate(([True], (label[1:] != label[:-1]) | (row[1:] != row[:-1]))))
        for a, b in zip(cut.tolist(), np.append(cut[1:], len(label)).tolist()):
            spans[row[a]].append((field.langs[label[a]], b - a))
    return [field.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())], np.where(known, score, 0.0), spans, np.where(known, certain, 0.0)


def held_out():
    """Documents that no model here learns from; a NULL id counts as the empty text, whose checksum is 0."""
    return F.coalesce(crc32_of("doc_id"), F.lit(0)) % 4 == 2


def trained(docs: DataFrame) -> Field | None:
    return fitted(sample(docs.select("doc_id", "text", "lang").filter(~held_out())))


def op1_language_id(spark, sf_dir):
    """The language of every document, learned from those not held out."""
    docs = read(spark, sf_dir, "documents")
    found = identified(docs.select("doc_id", "text", held_out().alias("held_out")), trained(docs), carry=("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score")
