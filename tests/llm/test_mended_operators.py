"""What single operators must bear beyond the common cases: long texts, hot groups, placements, other languages."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import types as T
from samples import DOCUMENTS, EN, awkward_frame, clashing, row

from voltframe.llm import language_id, licenses, minhash, multi_index, quality, secrets
from voltframe.llm.common import numbered


# licenses

def dice_spans(text, threshold=licenses.THRESHOLD):
    """Every span of words that reaches the threshold with a template, by trying all of them."""
    words = re.findall("[a-z0-9]+", text.lower())
    out = set()
    for _, (name, template) in enumerate(licenses.TEMPLATES):
        own = set(licenses.bigrams_of(template))
        for a in range(len(words) - 1):
            seen = set()
            for z in range(a + 1, min(len(words), a + 1 + 3 * len(own))):
                seen.add(f"{words[z - 1]} {words[z]}")
                if 200 * len(seen & own) >= threshold * (len(seen) + len(own)):
                    out.add((name, a, z))
    return out


def test_random_placements_of_notices(spark):
    rng = random.Random(11)
    notices = [(n, t) for n, t in licenses.TEMPLATES if 5 <= len(t.split()) <= 20]
    texts, planted = [], []
    for i in range(40):
        name, notice = rng.choice(notices)
        words = notice.split()
        for _ in range(rng.choice([0, 0, 1])):      # a word less
            words.pop(rng.randrange(len(words)))
        before, after = ([f"w{rng.randrange(99)}" for _ in range(rng.randint(0, 30))] for _ in range(2))
        parts = before + words + after
        texts.append("".join(w + rng.choice([" ", " ", "\n", ", "]) for w in parts))
        planted.append(name)
    found = {}
    for r in licenses.matches(spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], DOCUMENTS)).collect():
        found.setdefault(r["doc_id"], set()).add(r["license"])
    for i, text in enumerate(texts):
        possible = {name for name, _, _ in dice_spans(text)}
        got = found.get(i, set())
        assert got <= possible and bool(got) == bool(possible)


def test_rows_that_share_an_id_or_have_none_are_documents(spark):
    notice = "Released under the MIT License."
    rows = [row(i, f"{notice}\n{EN} {k}") for i, k in ((None, "a"), (None, "b"), (7, "c"), (7, "d"), (7, "d"))]
    got = licenses.matches(clashing(spark.createDataFrame(rows, DOCUMENTS))).collect()
    assert sorted((str(r["doc_id"]), r["unit"], r["license"]) for r in got) == [("7", 0, "MIT"), ("7", 0, "MIT"), ("None", 0, "MIT"), ("None", 0, "MIT")]


def test_licenses_in_awkward_and_long_texts(spark):
    long = " ".join(f"word{i}" for i in range(60_000)) + "\nReleased under the MIT License.\n" + " ".join(f"more{i}" for i in range(60_000))
    assert licenses.matches(clashing(awkward_frame(spark))).collect() == []
    assert [tuple(r)[:3] for r in licenses.matches(spark.createDataFrame([row(1, long)], DOCUMENTS)).collect()] == [(1, 1, "MIT")]


def test_size_bounds_prune_no_match():
    rng = np.random.default_rng(3)
    words = " ".join(licenses.TEMPLATES[1][1].split()[:12]).lower().encode().split() + [b"x", b"y"]
    for _ in range(200):
        text = b" ".join(rng.choice(words, rng.integers(2, 60)))
        for _, unit, name, dice in licenses.scan([text]):
            assert 100 * dice >= licenses.THRESHOLD and name and unit <= 0


# secrets

def test_keys_without_an_end_are_read_once():
    def seconds(n):
        text = (b"-----BEGIN RSA PRIVATE KEY-----\n" + b"A" * 40 + b"\n") * n
        began = time.perf_counter()
        assert secrets.scan(text, np.array([0, len(text)]))[0] == []
        return time.perf_counter() - began

    seconds(10)
    assert seconds(8000) < 20 * max(seconds(1000), 0.01)


def test_a_key_ends_at_its_own_end():
    key = b"-----BEGIN PRIVATE KEY-----\nQUJD\nREVG-RH==\n-----END PRIVATE KEY-----"
    text = b"-----BEGIN PRIVATE KEY-----\nlost\n" + key + b" x " + key
    at = text.index(key)
    assert [s for s in secrets.scan(text, np.array([0, len(text)]))[0] if s[0] == "pem"] == [("pem", at, at + len(key)), ("pem", len(text) - len(key), len(text))]


# quality

def test_other_languages_are_not_held_to_a_list(spark):
    finnish = " ".join(f"sana{i} joka kertoo tarinan" for i in range(30))
    rows = [row(1, finnish, "fi"), row(2, finnish, "en"), row(3, finnish, None), row(4, EN, "en")]
    got = {r["doc_id"]: r["kept"] for r in quality.judged(spark.createDataFrame(rows, DOCUMENTS), lang="lang").collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}


# language identification

@pytest.mark.parametrize("most", [1, 2, 3, 10, 40])
def test_pieces_with_messages_equal_whole_texts(most):
    rng = np.random.default_rng(0)
    scores, moves, start = rng.normal(size=(50, 4)) * 2, rng.normal(size=(4, 4)), rng.normal(size=4)
    sizes = np.array([0, 1, 7, 40, 3, 100, 0, 5])
    token = rng.integers(0, 50, sizes.sum())
    whole = language_id.posteriors(scores, token, sizes, moves, start, 10**6)
    assert all(np.allclose(x, y) for x, y in zip(whole, language_id.posteriors(scores, token, sizes, moves, start, most)))


def test_the_sample_shuffles_no_text(spark, monkeypatch):
    made = []
    stage = language_id.staged
    monkeypatch.setattr(language_id, "staged", lambda df, label: made.append(stage(df, label)) or made[-1])
    rows = [row(i, f"{EN} {i}", lang) for i in range(300) for lang in ("en", "de")]
    got = language_id.sample(spark.createDataFrame(rows, DOCUMENTS))
    assert len(got) == 2 * language_id.TRAIN_DOCS and made[0].columns == ["lang", "__key"]


def test_the_sample_is_bounded_in_characters(spark, monkeypatch):
    monkeypatch.setattr(language_id, "TRAIN_DOCS", 3)
    monkeypatch.setattr(language_id, "TRAIN_CHARS", 50)
    rows = [row(1, "a" * 40), row(2, "b" * 40), row(3, "c" * 40), row(4, "d" * 40), row(5, "e" * 5000)]
    assert sum(len(t) for _, t in language_id.sample(spark.createDataFrame(rows, DOCUMENTS))) <= 150


# near-duplicate documents

def test_a_common_passage_is_no_quadratic_join(spark, monkeypatch):
    """Texts of 18 common and two own words: no two are linked, and none of their places meet."""
    passage = " ".join(f"common{i}" for i in range(18))
    rows = [row(i, f"own{i} {passage} tail{i}") for i in range(4000)]
    made = {}
    stage = minhash.staged
    monkeypatch.setattr(minhash, "staged", lambda df, label, keep=False: made.setdefault(label, stage(df, label, keep)))
    df = spark.createDataFrame(rows, DOCUMENTS)
    classes = minhash.classes_of(minhash.sketches(df))
    texts = minhash.texts_of(df, classes, classes)
    rest = classes.selectExpr("cid", "n", "cid AS comp")
    assert minhash.prefix_pairs(rest, texts).count() == 0 and made["meeting"].count() == 0 and made["live"].count() >= 4000


def test_prefix_pairs_lose_no_similar_pair(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = list(base[:rng.randint(30, 60)])
        for _ in range(rng.choice([0, 1, 1, 2, 5])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(40)}"
        rows.append(row(i, " ".join(words)))
    df = spark.createDataFrame(rows, DOCUMENTS)
    classes = minhash.classes_of(minhash.sketches(df))
    texts = minhash.texts_of(df, classes, classes)
    got = {tuple(r) for r in minhash.prefix_pairs(classes.selectExpr("cid", "n", "cid AS comp"), texts).collect()}
    sets = {r["cid"]: set(minhash._sets([r["text"]])[0].tolist()) for r in texts.collect()}
    ids = sorted(sets)
    similar = {(a, b) for a in ids for b in ids if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert similar and similar <= got


# near-duplicate vectors

def test_vectors_of_double_precision_keep_their_digits(spark):
    kind = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    # The second lies at a cosine of 0.9 less 1e-10 from the first, the third at 0.9 plus 1e-10.
    at = lambda c: [c, float(np.sqrt(1 - c * c)), 0.0]
    rows = [(1, [1.0, 0.0, 0.0]), (2, at(0.9 - 1e-10)), (3, [0.9 + 1e-10, -float(np.sqrt(1 - (0.9 + 1e-10) ** 2)), 0.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in multi_index.near_vectors(spark.createDataFrame(rows, kind)).collect()}
    assert got == {1: (1, 1), 2: (0, 2), 3: (1, 1)}


def test_numbered_words_keep_their_order():
    assert numbered([b"b", b"a", b"b"])[0] == [b"b", b"a"]


# token ids

def test_words_are_found_by_their_hashes(monkeypatch):
    from tokenizers import Tokenizer

    from voltframe.llm import vocab

    path = vocab.tokenizer_path(vocab.WORD_VOCAB)
    lib = Tokenizer.from_file(path)
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("abcdeé1.'") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 40]))) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    texts += ["", " ", "\n\t", "x" * 700, "x" * 700 + " " + "x" * 701, "a\x00 a", "日本語 🙂", "<|endoftext|> it's", "don't 's\x0bb\x0c c\r\n"]
    data = [t.encode() for t in texts]
    ends = np.cumsum([0, *map(len, data)])
    monkeypatch.setattr(vocab, "STORE_WORDS", 500)
    for end_id in (None, 2):
        for _ in range(2):      # new words, then known ones
            ids, n = vocab.encode_rows(memoryview(b"".join(data)), ends, path, end_id)
            stops = np.cumsum(n)
            for text, a, b in zip(texts, stops - n, stops):
                assert ids[a:b].tolist() == lib.encode(text, add_special_tokens=False).ids + ([end_id] if end_id else [])


def test_the_table_of_words_takes_clashing_slots(monkeypatch):
    from voltframe.llm import vocab

    monkeypatch.setattr(vocab, "SLOT_BITS", 4)
    store, keys = vocab.WordStore(), np.array([[7 << 60, (7 << 60) + 1, 7 << 60, (15 << 60) + 5, (15 << 60) + 6], [1, 2, 3, 4, 5]], np.uint64)
    store.learn(keys[:, :3], np.arange(6, dtype=np.uint32), np.array([1, 2, 3]))
    store.learn(keys[:, 3:], np.arange(2, dtype=np.uint32), np.array([1, 1]))
    assert store.find(keys).tolist() == [0, 1, 2, 3, 4] and store.find(np.array([[7 << 60], [9]], np.uint64)).tolist() == [-1]
    more = np.random.default_rng(1).integers(0, 2**63, (2, 3000)).astype(np.uint64)
    store.learn(more, np.arange(3000, dtype=np.uint32), np.ones(3000, np.int64))     # the table grows
    assert store.find(np.concatenate((keys, more), axis=1)).tolist() == list(range(3005))
