import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T
from samples import DE, DOCUMENTS, EN, SF, awkward_frame, clashing, row, stored

import corpus_pipeline
from voltframe.llm import hyperminhash, language_model, minhash, multi_index, packing, registry, simple8b, token_files
from voltframe.llm.components import components
from voltframe.llm.vocab import WORD_VOCAB, tokenizer_path

QUERIES = registry.queries()
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return stored(clashing(awkward_frame(spark)), tmp_path_factory.mktemp("awkward"))


def texts(spark, sf):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def ids_of(rows):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path(WORD_VOCAB))
    return [e.ids + [2] for e in lib.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# token files

def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 59, 60, 61, 1023, 1024, 1025, 5000):
        for most in (1, 2, 100, 50_000, 2**31, 2**60 - 1):
            a = rng.integers(0, most, n, dtype=np.uint64)
            if n > 5 and most == 100:
                a[3], a[4], a[-1] = 2**63 + 5, 2**60, 2**64 - 1
            words, offsets = simple8b.encode(a)
            assert (simple8b.decode(words, offsets, n) == a).all()
    small = np.zeros(simple8b.BLOCK, np.uint64)
    assert len(simple8b.encode(small)[0]) == math.ceil(simple8b.BLOCK / 60)


@pytest.mark.parametrize("which", ["small", "awkward"])
def test_token_files(spark, folder, which):
    sf = SF if which == "small" else folder
    rows = texts(spark, sf)
    want = Counter((str(i), len(e), crc(e)) for (i, _), e in zip(rows, ids_of(rows)))
    got = sorted(QUERIES["op4_token_files"](spark, sf).collect(), key=lambda r: r["start"])
    assert Counter((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    known = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert known == sorted(known) and [r["doc_id"] is None for r in got] == sorted([r["doc_id"] is None for r in got], reverse=True)


def test_blocks_decode_alone(spark):
    files = token_files.write(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer_path(WORD_VOCAB))
    r = files.first().asDict()
    ids, n = token_files.decoded(r)
    words, offsets = np.frombuffer(r["words"], "<u8"), np.frombuffer(r["offsets"], "<u4").astype(int)
    last = len(offsets) // 2
    part = simple8b.decode(words[offsets[last]:], offsets[last:] - offsets[last], r["n_ids"] - last * simple8b.BLOCK)
    assert (part == ids[last * simple8b.BLOCK:]).all() and n.sum() == len(ids)


# language model

def trigram_scores(rows):
    """(id, held out, tokens, known, base score, score) of every text, and the training tokens, by plain counting."""
    held = {i: (zlib.crc32(str(i).encode()) if i is not None else 0) % 10 == 0 for i, _ in rows}
    tokens = [(i, ["<s>"] + (t or "").encode().lower().split() + [None]) for i, t in rows]
    c, pair, triple = Counter(), Counter(), Counter()
    for i, ws in tokens:
        if not held[i]:
            c.update(ws[1:])
            pair.update(zip(ws, ws[1:]))
            triple.update(zip(ws, ws[1:], ws[2:]))
    n, v, k = sum(c.values()), len(c), language_model.PRIOR

    def p1(w):
        return (c[w] + 0.1) / (n + 0.1 * (v + 1))

    def p2(a, w):
        return (pair[a, w] + k * p1(w)) / (c[None if a == "<s>" else a] + k)

    def p3(a, b, w):
        return (triple[a, b, w] + k * p2(b, w)) / (pair[a, b] + k)

    def score(ws):
        return math.log10(p2(ws[0], ws[1])) + sum(math.log10(p3(*x)) for x in zip(ws, ws[1:], ws[2:]))

    return [(str(i), held[i], len(ws) - 1, sum(c[w] > 0 for w in ws[1:]), sum(math.log10(p1(w)) for w in ws[1:]), score(ws)) for i, ws in tokens], n


def same_scores(got, want):
    key = lambda x: (x[0], x[2], round(x[4], 2), x[5])
    got = sorted(((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, sorted(want, key=key)):
        assert g[:4] == w[:4] and math.isclose(g[4], w[4], abs_tol=1e-4) and math.isclose(g[5], w[5], abs_tol=1e-4)


@pytest.mark.parametrize("which", ["small", "awkward"])
def test_language_model(spark, folder, which):
    sf = SF if which == "small" else folder
    want, n = trigram_scores(texts(spark, sf))
    got = QUERIES["op5_language_model"](spark, sf).collect()
    assert all(r["train_tokens"] == n for r in got)
    same_scores(got, want)


def held_out_rows(spark, rows):
    marked = [(i, t, (zlib.crc32(str(i).encode()) if i is not None else 0) % 10 == 0) for i, t in rows]
    return spark.createDataFrame(marked, "doc_id long, text string, held_out boolean")


def test_language_model_through_bundles(spark):
    """Many blocks and few ranges a block: counts go through three levels of bundles and come back to every block."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 1, 2, 30])))) for i in range(400)] + [(None, "a b c")] * 5
    want, n = trigram_scores(rows)
    got = language_model.scored(held_out_rows(spark, rows), block_bytes=400, bits=2).collect()
    assert all(r["train_tokens"] == n for r in got)
    same_scores(got, want)


def shuffled_rows(spark, monkeypatch, copies, distinct):
    """Rows of keys that go to ranges, and the most documents in a block."""
    made = []
    stage = language_model.staged
    monkeypatch.setattr(language_model, "staged", lambda df, label: made.append((label, stage(df, label))) or made[-1][1])
    rows = [(None, "one two three four five")] * copies + [(i, f"w{i} w{i + 1} w{i * 7 % 100} the end of it") for i in range(distinct)]
    got = language_model.scored(held_out_rows(spark, rows), block_bytes=500, bits=4)
    assert got.count() == len(rows)
    answers = sum(df.count() for label, df in made if label in ("lm-asks", "lm-answers"))
    documents = next(df for label, df in made if label == "lm-documents")
    blocks = max(1, math.ceil(sum(len(t) + 16 for _, t in rows) / 500))
    return answers, documents.selectExpr(f"pmod(xxhash64(__place), {blocks}) AS b").groupBy("b").count().agg({"count": "max"}).first()[0], blocks


def test_rows_of_the_language_model_grow_as_its_blocks(spark, monkeypatch):
    few, _, blocks = shuffled_rows(spark, monkeypatch, 0, 500)
    many, _, more = shuffled_rows(spark, monkeypatch, 0, 2000)
    assert more >= 3.9 * blocks and many <= 5 * few


def test_equal_rows_are_spread_over_blocks(spark, monkeypatch):
    _, most, blocks = shuffled_rows(spark, monkeypatch, 1500, 0)
    assert blocks > 100 and most < 45


def test_automaton_carries_its_state_and_sums_to_one():
    import pyarrow as pa

    rng = random.Random(7)
    rows = [" ".join(rng.choice("abcdef") for _ in range(rng.choice([0, 1, 2, 5, 80]))) for _ in range(80)]
    g = language_model.Grams(pa.table({"text": rows}))
    totals = [g.counts(k, np.arange(len(rows)) % 3 > 0) for k in range(3)]
    n, v = int(totals[0].sum()), int((totals[0] > 0).sum())
    model = language_model.Automaton(g, *totals, n, v)
    whole = model.traverse(10**6)
    for steps in (2, 3, 50):
        assert np.allclose(model.traverse(steps), whole)
    unknown = language_model.ADD / (n + language_model.ADD * (v + 1))
    arcs = {}
    for (leaves, weighs, leads), reads in ((model.pair_arcs, g.right), (model.triple_arcs, g.right[g.suffix])):
        for k, word in enumerate(reads.tolist()):
            if leaves[k] >= 0:
                arcs[int(leaves[k]), word] = weighs[k]
                assert 0 <= leads[k] < len(model.fail)

    def probability(state, word):
        if (state, word) in arcs:
            return 10 ** arcs[state, word]
        if not state:
            return 10 ** model.base[word] if word is not None else unknown
        return 10 ** model.fail[state] * probability(int(model.fail_to[state]), word)

    for state in range(len(model.fail)):
        assert math.isclose(sum(probability(state, w) for w in [*range(len(totals[0])), None]), 1.0, abs_tol=1e-9)


# near-duplicate documents

def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    """Least id per component of distinct sets; ids of rows with equal sets are joined."""
    classes = defaultdict(list)
    for i, t in rows:
        if s := shingle_set(t):
            classes[s].append(i)
    sets = list(classes)
    at = list(range(len(sets)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            if min(len(sets[a]), len(sets[b])) * 100 >= 85 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if both * 100 >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    at[find(a)] = find(b)
    least = defaultdict(list)
    for k, s in enumerate(sets):
        least[find(k)] += [i for i in classes[s] if i is not None]
    return {s: min(least[find(k)], default=None) for k, s in enumerate(sets)}


def check_near(spark, rows, got):
    comp = brute_components(rows)
    want = sorted((str(i), len(shingle_set(t)), str(comp.get(shingle_set(t), i))) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("which", ["small", "awkward"])
def test_near_duplicates(spark, folder, which):
    sf = SF if which == "small" else folder
    check_near(spark, texts(spark, sf), QUERIES["op7_minhash"](spark, sf).collect())


def test_only_what_the_result_reads_is_left(spark, monkeypatch, tmp_path):
    from voltframe.llm import common

    monkeypatch.setattr(common, "new_folder", lambda s, label: f"{tmp_path}/{label}-{len(list(tmp_path.iterdir()))}")
    got = minhash.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet"))
    assert sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()) == ["members", "sketches"]
    assert got.count() == 200


def test_texts_of_rows_without_ids_meet_their_class_only(spark, monkeypatch):
    rows = [row(None, f"{EN} {i} {DE}") for i in range(60)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    classes = minhash.classes_of(minhash.staged(minhash.sketches(docs), "sketches"))
    joined = []

    def nodes(plan):
        kind = plan.getClass().getSimpleName()
        inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if "QueryStage" in kind else []
        return [(kind, plan)] + [x for p in inner + [plan.children().apply(i) for i in range(plan.children().size())] for x in nodes(p)]

    def collected(df, label, keep=False):
        df.collect()
        joined.extend(p.metrics().apply("numOutputRows").value() for k, p in nodes(df._jdf.queryExecution().executedPlan()) if k.endswith("JoinExec"))
        return df

    monkeypatch.setattr(minhash, "staged", collected)
    got = minhash.texts_of(docs, classes, classes).collect()
    assert sorted(r["text"] for r in got) == sorted(r[1] for r in rows)
    assert joined and max(joined) == 60


def test_large_groups_of_near_copies(spark):
    """Chains, stars and copies whose edits drift apart: more classes in a key than hubs."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for size in (30, 90, 160):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(60):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, size // 20))):
                copy[rng.randrange(size)] = rng.choice(vocabulary)
            rows.append(row(i := i + 1, " ".join(copy)))
        rows += [row(i := i + 1, " ".join(base)) for _ in range(20)]
        chain = list(base)
        for k in range(12):
            chain[(k * 7) % size] = f"c{k}"
            rows.append(row(i := i + 1, " ".join(chain)))
    rng.shuffle(rows)
    got = minhash.near_duplicates(spark.createDataFrame(rows, DOCUMENTS)).collect()
    check_near(spark, [(r[0], r[1]) for r in rows], got)


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(2)
    for share in (0.5, 0.85, 0.95):
        both = rng.integers(0, 2**63, int(2000 * share), dtype=np.uint64)
        a, b = (np.sort(np.concatenate((both, rng.integers(0, 2**63, 2000 - len(both), dtype=np.uint64)))) for _ in range(2))
        a, b = a * np.uint64(2), b * np.uint64(2)
        regs = hyperminhash.registers(np.concatenate((a, b)), np.array([2000, 2000]))
        guess, used = hyperminhash.estimate(regs[:1], regs[1:], np.array([2000]), np.array([2000]))
        true = len(both) / (4000 - len(both))
        assert abs(guess[0] - true) < 5 * math.sqrt(true * (1 - true) / used[0])


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (7, 7), (100, 5), (5, 50), (50, 100)] + [(1000 + i, 1001 + i) for i in range(40)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10, 12: 10, 5: 5, 50: 5, 100: 5} | {1000 + i: 1000 for i in range(41)}


# near-duplicate vectors

def check_vectors(rows, got, least=1.0):
    unit = {}
    for k, (_, v, _) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float32).astype(float)
            unit[k] = a / np.linalg.norm(a)
    keys = list(unit)
    n, at = Counter(), {k: k for k in range(len(rows))}

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in keys:
        for j in keys:
            if i < j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9 - 1e-12:
                n[i] += 1
                n[j] += 1
                at[find(i)] = find(j)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k][0])
    want = sorted((str(rows[k][0]), n[k], str(min((x for x in groups[find(k)] if x is not None), default=None))) for k in range(len(rows)))
    found = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got)
    assert len(found) == len(want) and sum(f[1] for f in found) >= least * sum(w[1] for w in want)
    assert sum(f == w for f, w in zip(found, want)) >= least * len(want)


def test_vectors(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(1, None, 0), (2, [], 0), (3, [0.0] * 8, 0), (4, [1.0, None] + [0.0] * 6, 0), (5, [float("nan")] * 8, 0), (6, [float("inf")] + [0.0] * 7, 0),
            (7, [1.0, 2.0], 0), (7, [1.0, 2.0], 0), (8, [2.0, 4.0], 0), (None, [1.0] * 8, None), (9, [1e30] * 8, 0), (10, [1e-30] * 8, 0), (11, [5.0], 0), (12, [-5.0], 0)]
    centres = rng.normal(size=(30, 8))
    rows += [(100 + i, (centres[i % 30] + 0.18 * rng.normal(size=8)).astype(np.float32).tolist(), 0) for i in range(600)]
    rows += [(2000 + i, rows[20][1], 0) for i in range(300)]
    df = clashing(spark.createDataFrame(rows, VECTORS))
    check_vectors(rows, QUERIES["op8_multi_index"](spark, stored(df, tmp_path, "embeddings")).collect(), least=0.97)


def test_no_vectors(spark, tmp_path):
    assert QUERIES["op8_multi_index"](spark, stored(spark.createDataFrame([], VECTORS), tmp_path, "embeddings")).count() == 0


def test_traversal_visits_nearest_cells():
    rng = np.random.default_rng(8)
    points = rng.normal(size=(500, 6))
    grid = multi_index.Grid(points, 500 * 16)
    grid.visits = 17
    a, b = grid.near(points[:50])
    total = (a[:, :, None] + b[:, None, :]).reshape(50, -1)
    seen = grid.visited(points[:50])
    assert np.allclose(np.sort(total, 1)[:, :17], np.take_along_axis(total, seen, 1))
    assert all(abs(grid.rank(a[i], b[i], int(seen[i, 16])) - 16) <= 1 for i in range(50))  # to the last bit of a sum


def test_crowded_cells_are_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 50)
    rng = np.random.default_rng(9)
    rows = [(i, ([1.0] * 6 + 0.03 * rng.normal(size=6)).astype(np.float32).tolist(), 0) for i in range(400)]
    got = QUERIES["op8_multi_index"](spark, stored(spark.createDataFrame(rows, VECTORS), tmp_path, "embeddings")).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(399, 0)}


def test_visits_where_few_vectors_have_a_partner(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(10)
    points = rng.normal(size=(20_000, 32))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    away = rng.normal(size=(60, 32))
    away -= (away * points[:60]).sum(1, keepdims=True) * points[:60]
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    near = 0.91 * points[:60] + math.sqrt(1 - 0.91**2) * away
    monkeypatch.setattr(multi_index, "SAMPLE", 2048)
    rows = [(i, v, 0) for i, v in enumerate(np.concatenate((points, near)).astype(np.float32).tolist())]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = multi_index.near_vectors(spark.createDataFrame(rows, VECTORS)).filter("vec_id >= 20000").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sum(r["n_links"] > 0 for r in got) >= 57


def test_calibration_asks_on_until_queries_have_partners(spark):
    rng = np.random.default_rng(11)
    points = rng.normal(size=(3000, 32))
    points[1000:1004] = points[:4] + 0.3 * rng.normal(size=(4, 32))
    rows = [(i, i, 1, v) for i, v in enumerate(points.astype(np.float32).tolist())]
    classes = spark.createDataFrame(rows, "cid long, rep long, n long, embedding array<float>")
    grid = multi_index.fitted(classes)[32]
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    first, second = np.nonzero(np.triu(unit @ unit.T >= 0.9, 1))
    assert len(first) >= 4
    for x, y in [*zip(first, second), *zip(second, first)]:
        assert grid.cells(unit[y:y + 1])[0] in grid.visited(unit[x:x + 1])[0]


# packing

def test_patterns_hold_the_histogram():
    for seed in range(30):
        rng = random.Random(seed)
        h = {rng.randint(1, 4096): rng.randint(1, 10 ** rng.randint(0, 5)) for _ in range(rng.randint(1, 300))}
        found = packing.patterns(h)
        assert all(sum(n * k for n, k in content) <= 4096 for _, content in found)
        held = Counter()
        for packs, content in found:
            for n, k in content:
                held[n] += packs * k
        assert held == h
    assert packing.patterns({}) == []


@pytest.mark.parametrize("which", ["small", "awkward"])
def test_packing(spark, folder, which):
    sf = SF if which == "small" else folder
    rows = texts(spark, sf)
    whole = defaultdict(list)
    for (i, _), e in zip(rows, ids_of(rows)):
        whole[i].append(e)
    got = [r.asDict() for r in QUERIES["op9_packing"](spark, sf).collect()]
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append(r)
        assert any(len(e) == r["doc_tokens"] and crc(e[r["start"]:r["start"] + r["length"]]) == r["ids_crc32"] for e in whole[r["doc_id"]])
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096
    assert Counter(sum((([r["doc_id"]] * r["length"]) for r in got), [])) == Counter({i: sum(map(len, e)) for i, e in whole.items()})


# pipeline

def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, folder), name)
        assert docs.columns == spark.read.parquet(f"{folder}/documents.parquet").columns
    assert {r["doc_id"] for r in docs.collect()} >= {1, 6} and docs.filter("text = ''").count() == 0
    assert docs.filter("doc_id = 2").count() == 0  # the copies of row 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).filter("doc_id = 6").count() > 1


def test_language_stage_keeps_texts_of_several_languages(spark):
    fr = "le chat et le chien sont dans la maison avec les gens de la ville mais il y a aussi une femme qui ne mange pas son pain"
    rng = random.Random(6)
    rows = [row(i, " ".join(rng.sample(t.split(), 20)), lang) for i in range(90) for lang, t in [(("en", EN), ("de", DE), ("fr", fr))[i % 3]]]
    some = lambda t, n: " ".join((t.split() * 2)[:n])
    rows += [row(200, f"{some(EN, 24)} {some(DE, 21)} {some(fr, 15)}", None), row(201, f"{some(EN, 25)} {some(DE, 25)} tok pru", None), row(202, "123 !!!", None)]
    got = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, DOCUMENTS), None).collect()}
    assert got == set(range(90)) | {200, 201}


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    rng = random.Random(3)
    words = {"en": EN.split(), "de": DE.split()}
    rows = [row(i, " ".join(rng.choice(words[lang]) for _ in range(120)), lang) for i in range(60) for lang in [("en", "de")[i % 2]]]
    rows += [row(100, rows[3][1], "de"), row(101, rows[4][1] + " token = abcdefgh12345678", "en"), row(102, None), row(103, "### $$$")]
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, stored(spark.createDataFrame(rows, DOCUMENTS), tmp_path)).collect()}
    assert got == set(range(60))


def test_copies_are_dropped_by_text_and_not_by_id(spark):
    rng = random.Random(5)
    a, b, c, d, e, f = (" ".join(rng.choice(EN.split()) + str(rng.randrange(90)) for _ in range(80)) for _ in range(6))
    rows = [row(1, a), row(None, a + " more"), row(None, b), row(None, c), row(None, c), row(None, c + " more"), row(4, d), row(4, e),
            row(9, a, "aa"), row(9, f, "zz"), row(7, f), row(7, f, "en", "r"), row(None, None), row(None, ""), row(5, " "), row(5, "")]
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, DOCUMENTS), None)
    found = [(r["doc_id"], r["text"], r["source"]) for r in got.collect()]
    kept_c = [x for x in found if x[1] in (c, c + " more")]
    assert len(kept_c) == 1 and kept_c[0][0] is None
    want = [(1, a, "s"), (None, b, "s"), (4, d, "s"), (4, e, "s"), (7, f, "r"), (None, None, "s"), (None, "", "s"), (5, " ", "s"), (5, "", "s")]
    assert Counter(x for x in found if x not in kept_c) == Counter(want)


def test_empty_pipeline(spark, tmp_path):
    assert corpus_pipeline.run(spark, stored(spark.createDataFrame([], DOCUMENTS), tmp_path)).count() == 0
