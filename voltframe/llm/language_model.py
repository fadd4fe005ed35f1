"""Language-model scoring by a weighted backoff automaton that is cut to what each block of documents can reach.

The model is a word trigram with Bayesian smoothing. With counts c, P(w) = (c(w) + a) / (N + a (V + 1)) and, for a history h of
one or two words with h' the history less its first word, P(w | h) = (c(h, w) + k P(w | h')) / (c(h) + k), which sums to one over
the vocabulary and one unknown word. As an automaton: every history that training texts hold is a state, and so are the start
of a text and the root, which stands for no history. A state has an arc for every word seen behind it, of weight P(w | h), to
the longest history known that then ends the text so far. Its failure arc, of weight k / (c(h) + k), leads to h' and is
taken, without reading, where there is no arc for the next word; the root has an arc for every word. A traversal reads a
text from left to right, carries the state from word to word, and adds the logarithms of the weights of all arcs taken.

The whole automaton grows with the corpus and fits no worker. Documents are dealt into blocks of bounded size by a hash of
where they stand, so equal rows spread. Each block sends the keys of the words, pairs and triples in its texts, with its training
counts, to the ranges of keys they belong to; a range adds up the counts of all blocks and answers every block in the order of its
keys. A block then builds the part of the automaton that its texts can visit. A block has a fixed number of ranges. Where more
blocks than that share a range, as many of them are first made one bundle, whose keys go on to finer ranges, and so on
until a range meets few enough: a row is never a small piece, their number grows as that of the blocks, and no group holds more than
a block. Every key meets one row per block or bundle, so a frequent word is no hot spot.

Keys are 64-bit hashes: two of n distinct n-grams collide with probability n² / 2⁶⁵. NULL and empty texts are one end token.
A NULL id counts as the empty text, whose checksum is 0: it is held out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import crc32_of, mix64, numbered, read, ship, shuffles_removed, staged, text_bytes, words_of

BLOCK_BYTES = 4 << 20
RANGE_BITS = 8
STEPS = 512
ADD = 0.1
PRIOR = 16.0
WORDS, PAIRS, TRIPLES = range(3)
PASSES = ((WORDS, PAIRS), (TRIPLES,))  # one after the other, so that their keys do not lie on disk together
_END, _START = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E3779B97F4A7C15)
ASK = "prefix long, unit long, kind int, keys binary, counts binary"
ANSWER = "unit long, prefix long, kind int, totals binary, n long, v long"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


class Grams:
    """Tokens of a block of documents and the distinct words, pairs and triples in them, as far as asked for, each ordered by key.

    `token`, `pair` and `triple` number, for every token, the word and the pairs and triples that end with it. A text's first
    pair begins with the start (`left` is -1); it has no first triple (-1).
    """

    def __init__(self, texts: pa.RecordBatch | pa.Table, kinds: tuple[int, ...] = (WORDS, PAIRS, TRIPLES)):
        data, ends = text_bytes(_one(texts), "text")
        words, counts = words_of(data, ends)
        distinct, at = numbered(words)
        del words
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
        hashes = np.concatenate((hashes, [_END]))
        self.sizes = counts + 1
        self.ends = np.cumsum(self.sizes)
        self.first = self.ends - self.sizes
        token = np.full(int(self.ends[-1]), len(distinct), np.int64)
        inner = np.ones(len(token), bool)
        inner[self.ends - 1] = False
        token[inner] = at
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.token = rank[token]
        self.end_word = int(rank[len(distinct)])
        word_keys = hashes[order]
        before = np.concatenate(([0], self.token[:-1]))
        key = mix64(word_keys[before] * np.uint64(3) + np.uint64(1)) + word_keys[self.token]
        key[self.first] = mix64(np.full(len(self.first), _START)) + word_keys[self.token[self.first]]
        key = mix64(key)
        before[self.first] = -1
        self.keys = {WORDS: word_keys}
        if PAIRS in kinds:
            self.keys[PAIRS], self.pair = np.unique(key, return_inverse=True)
            self.left, self.right = np.empty((2, len(self.keys[PAIRS])), np.int64)
            self.left[self.pair], self.right[self.pair] = before, self.token
        if TRIPLES in kinds:
            later = np.ones(len(token), bool)
            later[self.first] = False
            later = np.flatnonzero(later)
            self.keys[TRIPLES], place = np.unique(mix64(mix64(key[later - 1] * np.uint64(5) + np.uint64(3)) + word_keys[self.token[later]]), return_inverse=True)
            self.triple = np.full(len(token), -1)
            self.triple[later] = place
        if {PAIRS, TRIPLES} <= set(kinds):
            self.history, self.suffix = np.empty((2, len(self.keys[TRIPLES])), np.int64)
            self.history[place], self.suffix[place] = self.pair[later - 1], self.pair[later]

    def counts(self, kind: int, training: np.ndarray) -> np.ndarray:
        """Occurrences of each n-gram of a kind in the training documents."""
        place = (self.token if kind == WORDS else self.pair if kind == PAIRS else self.triple)[np.repeat(training, self.sizes)]
        return np.bincount(place[place >= 0], minlength=len(self.keys[kind]))


def _one(table: pa.Table | pa.RecordBatch) -> pa.RecordBatch:
    return table if isinstance(table, pa.RecordBatch) else table.combine_chunks().to_batches()[0]


def planes(values: np.ndarray, kind: str) -> bytes:
    """Integers byte plane by byte plane, so that high zero bytes lie together."""
    return np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), -1).T).tobytes()


def unplanes(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.Table.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def asked(unit: int, kind: int, keys: np.ndarray, counts: np.ndarray, shift: int, start: int, ranges: int) -> Iterator[tuple]:
    """Rows of sorted keys and their counts, one per range; range `start` + i holds the keys that are so many when shifted."""
    edges = np.array([(start + i) << shift for i in range(1, ranges)], np.uint64)
    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if b > a:
            delta = np.diff(keys[a:b], prepend=keys[a:a + 1])
            delta[0] = keys[a]
            yield start + i, unit, kind, planes(delta, "<u8"), planes(counts[a:b], "<u8")


def _added(part: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys of all rows, their summed counts, and each row's places in them."""
    keys = [np.cumsum(unplanes(x.as_py(), "<u8"), dtype=np.uint64) for x in part.column("keys")]
    counts = np.concatenate([unplanes(x.as_py(), "<u8") for x in part.column("counts")])
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    # Counts stay exact as sums of doubles up to 2⁵³.
    return distinct, np.bincount(at, counts, len(distinct)).astype(np.int64), np.split(at, np.cumsum([len(k) for k in keys])[:-1])


def _kinds(group: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    for kind in sorted(set(group.column("kind").to_pylist())):
        yield kind, group.filter(pc.equal(group.column("kind"), kind))


def answered(group: pa.Table) -> pa.Table:
    """Adds up the counts of a range and answers each unit in the order of its keys. The range's own sums of training tokens
    and known words stand in the first answer about words only."""
    out = []
    for kind, part in _kinds(group):
        _, totals, places = _added(part)
        stats = (int(totals.sum()), int((totals > 0).sum())) if kind == WORDS else (0, 0)
        for i, (unit, prefix, at) in enumerate(zip(part.column("unit").to_pylist(), part.column("prefix").to_pylist(), places)):
            out.append((unit, prefix, kind, planes(totals[at], "<u8"), *(stats if i == 0 else (0, 0))))
    return _table(out, ANSWER)


def resolved(asks: DataFrame, units: int, bits: int, depth: int = 1) -> DataFrame:
    """Answers to all asks. Ranges of `depth` are told apart by the first `bits` times `depth` bits of their keys."""
    if units <= 1 << bits:
        return asks.groupBy("prefix").applyInArrow(answered, ANSWER)
    asks = staged(asks, "lm-asks").withColumn("bundle", F.shiftright("unit", bits))
    shift = 64 - bits * (depth + 1)

    def bundled(group: pa.Table) -> pa.Table:
        bundle, start = group.column("bundle")[0].as_py(), group.column("prefix")[0].as_py() << bits
        return _table([row for kind, part in _kinds(group) for row in asked(bundle, kind, *_added(part)[:2], shift, start, 1 << bits)], ASK)

    def spread(group: pa.Table, replies: pa.Table) -> pa.Table:
        out, stats = [], [sum(replies.column(c).to_pylist()) for c in ("n", "v")]
        replies = replies.sort_by([("kind", "ascending"), ("prefix", "ascending")])
        given = {kind: np.concatenate([unplanes(x.as_py(), "<u8") for x in part.column("totals")]) for kind, part in _kinds(replies)}
        for kind, part in _kinds(group):
            for unit, prefix, at in zip(part.column("unit").to_pylist(), part.column("prefix").to_pylist(), _added(part)[2]):
                out.append((unit, prefix, kind, planes(given[kind][at], "<u8"), *(stats if not out else (0, 0))))
        return _table(out, ANSWER)

    finer = asks.groupBy("prefix", "bundle").applyInArrow(bundled, ASK)
    replies = staged(resolved(finer, -(-units >> bits) if units else 0, bits, depth + 1), "lm-answers")
    mine = replies.withColumns({"above": F.shiftright("prefix", bits), "bundle": F.col("unit")})
    return asks.groupBy("prefix", "bundle").cogroup(mine.groupBy("above", "bundle")).applyInArrow(spread, ANSWER)


class Automaton:
    """The states and arcs that a block can reach, from the block's n-grams and their counts in all training texts.

    State 0 is the root, 1 the start, then come the known words and, from `first_pair` on, the known pairs. An arc bears the
    number of the pair or triple that it reads the end of, and the state it leaves; n-grams that no training text holds are no
    arcs (they leave -1). So a token names the two arcs that may read it, and the carried state tells which of them does.
    """

    def __init__(self, g: Grams, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray, n: int, v: int):
        self.g, end = g, g.end_word
        one = (words + ADD) / (n + ADD * (v + 1))
        self.base = np.log10(one)
        self.root_to = np.zeros(len(words), np.int64)
        known = np.flatnonzero((words > 0) & (np.arange(len(words)) != end))
        self.root_to[known] = 2 + np.arange(len(known))
        self.first_pair = 2 + len(known)
        after_pair = self.root_to[g.right]
        held = np.flatnonzero((pairs > 0) & (g.right != end))
        self.fail_to = np.concatenate(([0, 0], np.zeros(len(known), np.int64), after_pair[held]))
        begun = np.concatenate(([0, words[end]], words[known], pairs[held]))
        self.fail = np.log10(PRIOR / (begun + PRIOR))
        after_pair[held] = self.first_pair + np.arange(len(held))
        of_left = np.where(g.left < 0, 1, self.root_to[g.left])
        two = (pairs + PRIOR * one[g.right]) / (begun[of_left] + PRIOR)
        three = (triples + PRIOR * two[g.suffix]) / (pairs[g.history] + PRIOR)
        # The last row stands for the triple that a text's first token has not.
        self.pair_arcs = (np.where(pairs > 0, of_left, -1), np.log10(two), after_pair)
        self.triple_arcs = (np.append(np.where(triples > 0, after_pair[g.history], -1), -1), np.append(np.log10(three), 0.0),
                            np.append(after_pair[g.suffix], 0))

    def step(self, state: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after reading the tokens at `at`, and the weights of the failures and arcs taken."""
        state, weight, live = state.copy(), np.zeros(len(state)), np.arange(len(state))
        for (leaves, weighs, leads), number, first in ((self.triple_arcs, self.g.triple, self.first_pair), (self.pair_arcs, self.g.pair, 1)):
            arc = number[at[live]]
            takes = leaves[arc] == state[live]
            go, arc, live = live[takes], arc[takes], live[~takes]
            weight[go] += weighs[arc]
            state[go] = leads[arc]
            fails = live[state[live] >= first]
            weight[fails] += self.fail[state[fails]]
            state[fails] = self.fail_to[state[fails]]
        word = self.g.token[at[live]]
        weight[live] += self.base[word]
        state[live] = self.root_to[word]
        return state, weight

    def traverse(self, steps: int = STEPS) -> np.ndarray:
        """log10 probability of each text: its tokens from left to right, the state carried along.

        Texts run side by side, and long ones in pieces of `steps` tokens: no state remembers more than two words, so the state
        in which a piece begins is found by reading the two words before it from the root.
        """
        first, sizes = self.g.first, self.g.sizes
        pieces = -(-sizes // steps)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        start = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * steps
        length = np.minimum(steps, sizes[owner] - start)
        at = first[owner] + start
        state = np.ones(len(owner), np.int64)
        inner = np.flatnonzero(start > 0)
        carried = np.zeros(len(inner), np.int64)
        for back in (2, 1):
            carried, _ = self.step(carried, at[inner] - back)
        state[inner] = carried
        order = np.argsort(-length, kind="stable")
        total = np.zeros(len(owner))
        running = np.searchsorted(-length[order], -np.arange(int(length.max())), "left")
        for t, k in enumerate(running.tolist()):
            live = order[:k]
            state[live], weight = self.step(state[live], at[live] + t)
            total[live] += weight
        return np.bincount(owner, total, len(sizes))


def scores(docs: pa.Table, replies: pa.Table, n: int, v: int) -> pa.Table:
    if not docs.num_rows:
        return pa.Table.from_pylist([], pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                                                   ("base_score", pa.float64()), ("score", pa.float64())]))
    g = Grams(docs)
    replies = replies.sort_by([("kind", "ascending"), ("prefix", "ascending")])
    totals = {WORDS: [], PAIRS: [], TRIPLES: []}
    for kind, raw in zip(replies.column("kind").to_pylist(), replies.column("totals")):
        totals[kind].append(unplanes(raw.as_py(), "<u8").astype(np.int64))
    words, pairs, triples = (np.concatenate(t) if t else np.zeros(0, np.int64) for t in totals.values())
    model = Automaton(g, words, pairs, triples, n, v)
    return pa.table({
        "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": g.sizes,
        "n_known": np.add.reduceat((words[g.token] > 0).astype(np.int64), g.first),
        "base_score": np.add.reduceat(model.base[g.token], g.first), "score": model.traverse()})


def scored(docs: DataFrame, place: Column | None = None, block_bytes: int = BLOCK_BYTES, bits: int = RANGE_BITS) -> DataFrame:
    """Scores of all documents under the model of those that are not held out. `docs`: doc_id, text, held_out.

    `place` tells equal rows apart and is the same whenever `docs` is read, such as a row's file and number. Without one
    the documents are written down first.
    """
    spark = docs.sparkSession
    ship(spark)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "held_out",
                        (F.monotonically_increasing_id() if place is None else place).alias("__place"))
    if place is None:
        named = staged(named, "lm-documents")
    size = named.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    block = F.pmod(F.xxhash64("__place"), F.lit(blocks)).cast("long")
    dealt = named.select("doc_id", "text", "held_out", block.alias("block"))

    def asks_of(kinds: tuple[int, ...]):
        def ask(group: pa.Table) -> pa.Table:
            g, unit, training = Grams(group, kinds), group.column("block")[0].as_py(), ~group.column("held_out").to_numpy()
            return _table([row for k in kinds for row in asked(unit, k, g.keys[k], g.counts(k, training), 64 - bits, 0, 1 << bits)], ASK)

        return dealt.groupBy("block").applyInArrow(ask, ASK)

    with shuffles_removed(spark):
        passes = [staged(resolved(asks_of(kinds), blocks, bits), "lm-answers") for kinds in PASSES]
    known = passes[0].agg(F.sum("n"), F.sum("v")).first()
    n, v = known[0] or 0, known[1] or 0
    replies = passes[0].unionByName(passes[1]).select("unit", "prefix", "kind", "totals")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return scores(left, right, n, v)

    return dealt.groupBy("block").cogroup(replies.groupBy("unit")).applyInArrow(score, SCORED).withColumn("train_tokens", F.lit(n).cast("long"))


def op5_language_model(spark, sf_dir):
    """Unigram and model scores of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", (F.coalesce(crc32_of("doc_id"), F.lit(0)) % 10 == 0).alias("held_out"),
                                                   F.struct("_metadata.file_path", "_metadata.row_index").alias("__at"))
    return scored(docs, F.col("__at")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
