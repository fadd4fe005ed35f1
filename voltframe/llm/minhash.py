"""Near-duplicate documents by HyperMinHash: compressed registers banded, estimates corrected for chance, exact checks last.

1. Every text becomes its shingle set's size, fingerprint and sketch. Equal sets are one class; copies never meet pairwise.
2. Registers are banded; classes that share a band key are candidates. Within a key every class is held against the few
   classes that share most keys with others (the middle of a group of near copies), not against all.
3. Candidate pairs pass the size bound and the sketch estimate with a margin of five standard deviations; the rest is
   confirmed on the full sets. Confirmed links give components.
4. What may still be linked unseen lies in keys with more classes than were held against and more than one component.
   Those classes are joined exactly: two sets that similar share one of their rarest shingles (prefix filter), and
   only pairs of different components are confirmed. So no link between components is lost to step 2.

NULL, empty and blank texts have size 0 and stand alone. Copies, also rows with equal ids, share their class's component.
A NULL id is never a component's id unless all of its documents have none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.llm import hyperminhash as hmh
from voltframe.llm.common import read, scratch, ship, slices, staged, text_bytes
from voltframe.llm.components import components

PERCENT = 85
HUBS = 4
MARGIN = 5.0
SKETCH = "doc_id long, body binary, n_shingles long, print binary, regs binary"


def body_of(text: str) -> Column:
    """128 bits that stand for a text: with the id they tell a document from others that bear the same id, or none."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def sketches(docs: DataFrame) -> DataFrame:
    """Size, fingerprint and sketch of every document's shingle set."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, n = hmh.shingles(*text_bytes(batch, "text"))
            regs = hmh.registers(values, n)
            stops = np.cumsum(n).tolist()
            prints = [hmh.fingerprint(values[b - k:b]) if k else None for b, k in zip(stops, n.tolist())]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "body": batch.column("body"), "n_shingles": n, "print": pa.array(prints, pa.binary()),
                "regs": pa.array([r.tobytes() if k else None for r, k in zip(regs, n.tolist())], pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body_of("text").alias("body"), F.col("text").alias("text")).mapInArrow(run, SKETCH)


def first_of(doc_id: str) -> Column:
    """The document of the least id, one without an id only where no other is, and the least body among equal ids."""
    return F.min(F.struct(F.col(doc_id).isNull().alias("unnamed"), F.col(doc_id).alias("doc_id"), F.col("body").alias("body")))


def classes_of(sketched: DataFrame) -> DataFrame:
    """One row per distinct shingle set, with the document that represents it; the number is fixed by the written table."""
    return staged(sketched.filter("n_shingles > 0").groupBy("print")
                  .agg(first_of("doc_id").alias("f"), F.min("n_shingles").alias("n"), F.min("regs").alias("regs"))
                  .select("print", F.col("f.doc_id").alias("rep"), F.col("f.body").alias("body"), "n", "regs")
                  .withColumn("cid", F.monotonically_increasing_id()), "classes")


def banded(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                n = part.column("n").to_numpy()
                rows, keys = hmh.band_keys(_matrix(part.column("regs")), n)
                yield pa.RecordBatch.from_pydict({"key": keys.view(np.int64), "cid": part.column("cid").to_numpy()[rows], "n": n[rows]})

    return classes.select("cid", "n", "regs").mapInArrow(run, "key long, cid long, n long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), hmh.BUCKETS)


def shared_keys(classes: DataFrame) -> DataFrame:
    """(key, cid, n, weight) of keys that several classes share; a class's weight is how often it meets others."""
    rows = banded(classes)
    sizes = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "keys")
    found = staged(rows.join(sizes, "key"), "shared")
    weights = staged(found.groupBy("cid").agg(F.sum("size").alias("weight")), "weights")
    return staged(found.join(weights, "cid").select("key", "cid", "n", "size", "weight"), "shared")


def alike(n: str, m: str):
    """The size bound: sets of sizes n and m can reach the similarity."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def hub_pairs(shared: DataFrame) -> DataFrame:
    """Distinct pairs of a class and one of the first `HUBS` classes of a key, those of most weight."""
    order = Window.partitionBy("key").orderBy(F.desc("weight"), "cid")
    hubs = staged(shared.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= HUBS)
                  .select("key", F.col("cid").alias("hub"), F.col("n").alias("m")), "hubs")
    return (shared.join(hubs, "key").filter((F.col("cid") != F.col("hub")) & alike("n", "m"))
            .select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct())


def promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose sketches do not rule the similarity out."""
    def side(x: str, y: str, m: str) -> DataFrame:
        return classes.select(F.col("cid").alias(x), F.col("n").alias(m), F.col("regs").alias(y))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                n, m = part.column("n").to_numpy(), part.column("m").to_numpy()
                guess, used = hmh.estimate(_matrix(part.column("x")), _matrix(part.column("y")), n, m)
                j = PERCENT / 100
                keep = guess >= j - MARGIN * np.sqrt(j * (1 - j) / np.maximum(used, 1))
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return pairs.join(side("a", "x", "n"), "a").join(side("b", "y", "m"), "b").mapInArrow(run, "a long, b long")


def texts_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text of each wanted class: that of the document that represents it. Met by id and body, so rows without an id
    are spread and a class meets only copies of one text."""
    need = classes.join(wanted.select("cid").distinct(), "cid").select("cid", "rep", F.col("body").alias("print"))
    named = docs.select(F.col("doc_id").cast("long").alias("own"), body_of("text").alias("body"), F.col("text").alias("text"))
    found = named.join(need, F.col("own").eqNullSafe(F.col("rep")) & (F.col("body") == F.col("print")))
    return staged(found.groupBy("cid").agg(F.min("text").alias("text")), "texts")


def _sets(texts: list[str]) -> list[np.ndarray]:
    encoded = [t.encode() for t in texts]
    values, n = hmh.shingles(memoryview(b"".join(encoded)), np.cumsum([0, *map(len, encoded)]))
    return np.split(values, np.cumsum(n)[:-1])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity."""
    def side(x: str, y: str) -> DataFrame:
        return texts.select(F.col("cid").alias(x), F.col("text").alias(y))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), "x", 1 << 20):
                ids = {c: part.column(c).to_pylist() for c in "ab"}
                own: dict[int, np.ndarray] = {}
                for c, text in (("a", "x"), ("b", "y")):
                    new = {i: k for k, i in enumerate(ids[c]) if i not in own}
                    own.update(zip(new, _sets(part.column(text).take(pa.array(list(new.values()), pa.int64())).to_pylist())) if new else ())
                keep = []
                for a, b in zip(ids["a"], ids["b"]):
                    s, t = own[a], own[b]
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    keep.append(100 * both >= PERCENT * (len(s) + len(t) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").mapInArrow(run, "a long, b long")


def open_classes(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(cid, n, comp) of classes in keys that were not held against each other in full and span several components."""
    known = (shared.filter(F.col("size") > HUBS + 1).join(labels.withColumnRenamed("node", "cid"), "cid", "left")
             .select("key", "cid", "n", F.coalesce("comp", "cid").alias("comp")))
    known = staged(known, "open")
    keys = known.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("key")
    return staged(known.join(staged(keys, "open-keys"), "key").select("cid", "n", "comp").distinct(), "open")


def prefix_pairs(rest: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of different components that share a shingle among their rarest ones, as any two similar sets must."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), "text"):
                own = _sets(part.column("text").to_pylist())
                at = np.repeat(np.arange(len(own)), [len(s) for s in own])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(at)) for c in ("cid", "n", "comp")), pa.array(np.concatenate(own).view(np.int64))],
                    names=["cid", "n", "comp", "shingle"])

    rows = staged(rest.join(texts, "cid").select("cid", "n", "comp", "text").mapInArrow(run, "cid long, n long, comp long, shingle long"), "shingles")
    df = staged(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    # The sets agree on ceil(j n) shingles at least, so the first n - ceil(j n) + 1 in any common order hold one of these.
    order = Window.partitionBy("cid").orderBy("df", "shingle")
    length = F.col("n") - F.ceil(F.col("n") * PERCENT / 100 - 1e-9) + 1
    prefix = (rows.join(df, "shingle").withColumn("r", F.row_number().over(order)).filter((F.col("r") <= length) & (F.col("df") > 1))
              .select("shingle", "cid", "n", "comp", "r"))
    prefix = staged(prefix, "prefixes")
    # Within a shingle the largest component stays on one side: its members are not held against each other.
    per = prefix.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("k"))
    main = per.groupBy("shingle").agg(F.max(F.struct("k", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    main = staged(main.select("shingle", F.col("top.comp").alias("main")), "main")
    live = staged(prefix.join(main, "shingle"), "live")
    minor = live.filter("comp <> main").select("shingle", F.col("cid").alias("c2"), F.col("n").alias("m"), F.col("comp").alias("comp2"), F.col("r").alias("q"))
    # Of the first shingle that two sets have in common, at places r and q: they share no more than what follows it. That
    # and the size bound depend on sizes and places alone, so a shingle's groups of equal size and place meet first, near sizes
    # only, and classes of a passage that is common but too short never meet at all.
    enough = (100 + PERCENT) * (1 + F.least(F.col("n") - F.col("r"), F.col("m") - F.col("q"))) >= PERCENT * (F.col("n") + F.col("m"))
    near = F.floor(F.log("n") / math.log(100 / PERCENT))
    one = live.select("shingle", "n", "r").distinct().withColumn("size_class", near)
    other = minor.select("shingle", F.col("m").alias("n"), "q").distinct().withColumn("size_class", F.explode(F.array(near - 1, near, near + 1)))
    meet = one.join(other.withColumnRenamed("n", "m"), ["shingle", "size_class"]).filter(alike("n", "m") & enough).select("shingle", "n", "r", "m", "q")
    meet = staged(meet, "meeting")
    return (live.join(meet, ["shingle", "n", "r"]).join(minor, ["shingle", "m", "q"]).filter(F.col("comp") != F.col("comp2"))
            .select(F.least("cid", "c2").alias("a"), F.greatest("cid", "c2").alias("b")).distinct())


def linked_classes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, comp) over class numbers, of classes with a link."""
    shared = shared_keys(classes)
    texts = texts_of(docs, classes, shared)
    first = staged(confirmed(promising(hub_pairs(shared), classes), texts), "confirmed")
    labels = components(first)
    rest = open_classes(shared, labels)
    more = staged(confirmed(promising(prefix_pairs(rest, texts), classes), texts), "confirmed")
    if not more.limit(1).count():
        return labels
    return components(first.unionByName(more))


def named_classes(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """(print, rep, body, comp) of every class: the document that represents it and its component's number."""
    classes = classes_of(sketched)
    labels = linked_classes(docs, classes)
    named = classes.join(labels, classes["cid"] == labels["node"], "left").select("print", "rep", "body", F.coalesce("comp", "cid").alias("comp"))
    return staged(named, "named")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    sketched = staged(sketches(docs), "sketches", keep=True)
    with scratch(docs.sparkSession):
        named = named_classes(docs, sketched)
        least = staged(named.groupBy("comp").agg(F.min("rep").alias("component_id")), "least")
        member = staged(named.join(least, "comp").select("print", "component_id"), "members", keep=True)
    out = sketched.select("doc_id", "n_shingles", "print").join(member, "print", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def originals(docs: DataFrame) -> DataFrame:
    """(comp, doc_id, body) of the one document that stands for each component: `first_of` its documents."""
    with scratch(docs.sparkSession):
        named = named_classes(docs, staged(sketches(docs), "sketches"))
        return staged(named.groupBy("comp").agg(first_of("rep").alias("f")).select("comp", "f.doc_id", "f.body"), "originals", keep=True)


def op7_minhash(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return near_duplicates(read(spark, sf_dir, "documents"))
