"""Periodic runs, fingerprints and the fill-in-middle transformation against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import DOCUMENTS, EN, SF, awkward_frame, clashing, row, stored

from voltframe.llm import fill_in_middle, fingerprints, periodic_runs, registry

QUERIES = registry.queries()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return stored(clashing(awkward_frame(spark)), tmp_path_factory.mktemp("awkward"))


def documents(spark, sf):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# periodic runs

def plain_runs(words):
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - a >= max(12, 2 * q):
                best.setdefault((a, i + q), q)
    return sorted((a, e - a, q) for (a, e), q in best.items())


def spread(rows):
    ids = np.array([w for r in rows for w in r], np.int64)
    return ids, np.array([len(r) for r in rows], np.int64)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=70), st.integers(0, 69), st.integers(1, 24)), min_size=1, max_size=4), st.integers(1, 60))
def test_runs_against_all_periods(drawn, piece):
    rows = [[w[i] if i < a or not w else w[a % len(w) + (i - a) % p if a % len(w) + (i - a) % p < len(w) else i] for i in range(len(w))] for w, a, p in drawn]
    ids, counts = spread(rows)
    want = [(i, *r) for i, words in enumerate(rows) for r in sorted(plain_runs(words), key=lambda r: (r[0], r[2]))]
    assert list(zip(*(x.tolist() for x in periodic_runs.runs_of(ids, counts)))) == want
    assert list(zip(*(x.tolist() for x in periodic_runs.runs_of(ids, counts, piece)))) == want


def test_runs_of_structured_words():
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 600:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    rows = [fibonacci[-1], [bin(i).count("1") % 2 for i in range(512)], [7] * 300, ([1, 2, 3] * 9 + [4]) * 6]
    got = list(zip(*(x.tolist() for x in periodic_runs.runs_of(*spread(rows), 100))))
    assert got == [(i, *r) for i, words in enumerate(rows) for r in sorted(plain_runs(words), key=lambda r: (r[0], r[2]))]


def expected_runs(i, text):
    words = text.encode().split()
    n, h = len(words), zlib.crc32(b"" if i is None else str(i).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
    runs = plain_runs(words)
    dropped = {k for s, size, q in runs for k in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in sorted(runs, key=lambda r: (r[0], r[2])))
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    return (i, len(runs), *best, exponent, sha(lines), sha(b" ".join(w for k, w in enumerate(words) if k not in dropped)))


def test_runs_of_tables(spark, folder, tmp_path):
    again = "one two three four " * 7
    made = [row(i, t) for i, t in [(1, again + EN), (2, EN + " " + again), (3, again * 3 + "x " + "same " * 30), (4, "a b " * 6), (5, "a b " * 5 + "a"), (None, again)]]
    for sf in (SF, stored(spark.createDataFrame(made * 2, DOCUMENTS), tmp_path), folder):
        rows = [(i, t) for i, t in documents(spark, sf) if len(t) < 60_000]
        got = {tuple(r) for r in QUERIES["op11_periodic_runs"](spark, sf).collect()}
        assert {expected_runs(i, t) for i, t in rows} <= got
        assert QUERIES["op11_periodic_runs"](spark, sf).count() == len(documents(spark, sf))


def test_collapsed_texts(spark):
    df = spark.createDataFrame([row(1, "x " + "go on " * 9 + "end"), row(2, None)], DOCUMENTS)
    got = {r["doc_id"]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.found(df).collect()}
    assert got == {1: (20, [(1, 18, 2)], "x go on end"), 2: (0, [], "")}


# fingerprints

def test_fingerprints_of_tables(spark, folder):
    for sf in (SF, folder):
        docs = documents(spark, sf)
        got = QUERIES["op12_fingerprints"](spark, sf).collect()
        assert len(got) == len(docs)
        assert all(fingerprints.compared(r["fingerprint"], r["edited_fingerprint"]) == r["near_edited"] for r in got)
        if sf != SF:
            continue
        of = {r["doc_id"]: r for r in got}
        docs.sort()
        for (i, t), (j, following) in zip(docs, docs[1:] + docs[:1]):
            m = len(t) // 4
            assert (of[i]["n_chars"], of[i]["edited_sha256"]) == (len(t), sha(t[:len(t) - m] + following[:m]))
            assert fingerprints.compared(of[i]["fingerprint"], of[j]["fingerprint"]) == of[i]["near_next"]
        assert sum(r["near_edited"] for r in got) / len(got) > 0.7 and sum(r["near_next"] for r in got) / len(got) < 0.05


def test_ties_and_ends(spark, tmp_path):
    rows = [row(None, "x" * 40), row(5, EN), row(5, EN), row(5, EN), row(9, None), row(2, "short")]
    got = [(r["doc_id"], r["edited_sha256"], r["near_next"]) for r in QUERIES["op12_fingerprints"](spark, stored(spark.createDataFrame(rows, DOCUMENTS), tmp_path)).collect()]
    m = len(EN) // 4
    want = [(None, sha("x" * 30 + "short"), 0.0), (2, sha("shor" + EN[0]), 0.0), (5, sha(EN[:-m] + EN[:m]), 1.0), (5, sha(EN[:-m] + EN[:m]), 1.0), (5, sha(EN[:-m]), 0.0), (9, sha(""), 0.0)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_one_document_follows_itself(spark, tmp_path):
    got = QUERIES["op12_fingerprints"](spark, stored(spark.createDataFrame([row(3, EN)], DOCUMENTS), tmp_path)).collect()
    m = len(EN) // 4
    assert [(r["edited_sha256"], r["near_next"]) for r in got] == [(sha(EN[:-m] + EN[:m]), 1.0)]


def points(*texts):
    return np.array([ord(c) for t in texts for c in t], np.uint32), np.array([len(t) for t in texts])


def inner_names(text, a, b, level):
    """Names and places, relative to a, of the phrases of a text that lie well inside [a, b)."""
    for names, _, widths in list(fingerprints.levels(*points(text)))[:level]:
        pass
    ends = np.cumsum(widths)
    return {(int(e - w - a), int(n)) for n, w, e in zip(names, widths, ends) if e - w >= a + 60 * level and e <= b - 60 * level}


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 300), st.integers(0, 300))
def test_equal_substrings_share_inner_phrases(seed, left, right):
    rng = random.Random(seed)
    def draw(n):
        return "".join(rng.choice("abcdefgh  é日") * rng.choice([1, 1, 1, 3]) for _ in range(n))

    common = draw(500)
    one, other = draw(left) + common + draw(right), draw(right) + common + draw(left)
    a, b = one.index(common), other.index(common)
    for level in (1, 2, 3):
        mine = inner_names(one, a, a + len(common), level)
        assert mine == inner_names(other, b, b + len(common), level) and mine


def test_parsing_does_not_depend_on_neighbours_or_chunks(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab c" if k % 2 else "abcdefghijkl") for _ in range(n)) for k, n in enumerate([0, 1, 2, 3, 17, 400, 3000, 0])] + ["a" * 500, "ab" * 300]
    together = fingerprints.Prints(*points(*texts))
    alone = [fingerprints.Prints(*points(t)).text(0) for t in texts]
    assert [together.text(r) for r in range(len(texts))] == alone
    assert len(set(alone)) == len(set(texts))
    monkeypatch.setattr(fingerprints, "CHUNK", 23)
    assert [fingerprints.Prints(*points(t)).text(0) for t in texts] == alone


def test_three_colours_and_phrase_lengths():
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 4, 20_000).astype(np.uint64)
    symbols = symbols[np.flatnonzero(np.diff(symbols, prepend=9))]
    first = np.zeros(len(symbols), bool)
    first[[0, 7, 8, 500]] = True
    colour = fingerprints._colours(fingerprints.mix64(symbols), first)
    assert colour.max() == 2 and ((colour[1:] != colour[:-1]) | first[1:]).all()
    sizes = np.diff(np.flatnonzero(fingerprints.phrase_starts(fingerprints.mix64(symbols), first)), append=len(symbols))
    assert sizes.max() <= 5


def test_phrases_cover_the_text(spark):
    for level in (1, 3):
        rows = fingerprints.phrases(spark.createDataFrame([row(1, EN), row(2, None), row(3, "é日本")], DOCUMENTS), level).collect()
        spans = {r["doc_id"]: [(p["start"], p["length"]) for p in r["phrases"]] for r in rows}
        assert spans[2] == [] and sum(n for _, n in spans[1]) == len(EN) and sum(n for _, n in spans[3]) == 3
        assert all(a + n == b for (a, n), (b, _) in zip(spans[1], spans[1][1:]))


def test_sketches_are_exact_while_small():
    rng = np.random.default_rng(2)
    a, b = (np.unique(rng.integers(0, 90, 40).astype(np.uint32)) for _ in range(2))
    assert fingerprints.likeness(a, b) == pytest.approx(2 * len(np.intersect1d(a, b)) / (len(a) + len(b))) or len(np.union1d(a, b)) > 64


# fill in the middle

def expected_middle(i, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = sha(f"1:{'' if i is None else i}")
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in range(0, 32, 8))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return (i, len(units), "plain", None, None, sha(text), sha(text))
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (i, len(units), form, len(p), len(m), sha(out), sha(text))


def test_middles_of_tables(spark, folder, tmp_path):
    odd = ["<P>", "a<S>b", "<M", "<<<>>>", "<", "aé<P", "ab" * 50 + "é日🙂" * 20, "\n\n", "<P <S <M < P>S>M>", None]
    made = [row(100 * k + j, t) for k in range(12) for j, t in enumerate(odd)]
    for sf in (SF, folder, stored(spark.createDataFrame(made, DOCUMENTS), tmp_path)):
        got = sorted(map(tuple, QUERIES["op13_fill_in_middle"](spark, sf).collect()), key=str)
        assert got == sorted((expected_middle(i, t) for i, t in documents(spark, sf)), key=str)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ<PSM>é日🙂 \n", max_size=30), st.integers(0, 30), st.integers(0, 30), st.sampled_from(["psm", "spm"]))
def test_restoring_inverts_arranging(text, a, b, form):
    if re.search("<[PSM]>", text):
        return
    raw = text.encode()
    places = sorted(len(text[:k].encode()) for k in (a, b))
    pieces = fill_in_middle.arranged(fill_in_middle.cut((fill_in_middle.TEXT, 0, len(raw)), *places), form)
    output = fill_in_middle.joined(pieces, (raw, fill_in_middle.SENTINELS))
    back = fill_in_middle.restored(output, form)
    assert fill_in_middle.joined(back, (output,)) == raw
    assert fill_in_middle.digest(pieces, (raw, fill_in_middle.SENTINELS)) == sha(output)


def test_outputs_are_restored_as_frames(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.lit("x").alias("form"))
    back = fill_in_middle.originals(fill_in_middle.transformed(docs))
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))
