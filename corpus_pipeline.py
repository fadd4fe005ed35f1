"""A corpus pipeline over `documents`: language, quality, near-duplicates, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
documents. All but the last return the columns of their input, whatever these are; rows with NULL in any column, empty texts
and repeated rows pass through each stage by its own rules. Columns of the documents never meet those of an operator: a
stage joins or carries under names of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltframe.llm import language_id, minhash, packing, quality, secrets
from voltframe.llm.common import read, staged

# A text whose words' labels are less sure than this on average, whichever languages they are of, is rejected.
LEAST_SCORE = 0.5


def _apart(docs: DataFrame) -> DataFrame:
    """The documents as `__body`, their text, and `__row`, all other columns: no operator's column can clash with these."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row"), F.col("text").alias("__body"))


def _columns(docs: DataFrame, **instead: Column) -> list[Column]:
    """The columns of `docs` from `__row` and `__body`, in their order."""
    from_row = {c: F.col("__row").getField(c) for c in docs.columns if c != "text"}
    return [({"text": F.col("__body")} | from_row | instead)[c].alias(c) for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose words are of known languages, one or several. The field is fitted to the labelled documents of the same table."""
    field = language_id.trained(docs)
    found = language_id.identified(_apart(docs), field, text="__body", carry=("__row", "__body"), slice_bytes=2 << 20, sure=True)
    kept = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("sure") >= LEAST_SCORE))
    return kept.select(*_columns(docs))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass the quality rules."""
    lang = "__row.lang" if "lang" in docs.columns else None
    kept = quality.judged(_apart(docs), text="__body", carry=("__row", "__body"), lang=lang).filter("kept")
    return kept.select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each near-duplicate group: a row of the least id, of no id only where the group has none.

    Decided by text and not by id: rows without an id or with a repeated one stay if their texts are no copies. Texts
    without words are no one's copies.
    """
    first = minhash.originals(docs.select("doc_id", "text")).toDF("__comp", "__id", "__print")
    worded = F.coalesce(F.col("text").rlike(r"[^ \t-\r]"), F.lit(False))
    rows = docs.filter(worded).withColumn("__own", minhash.body_of("text"))
    rows = rows.join(first, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__print")))
    repeated = Window.partitionBy("__comp").orderBy(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    one = rows.withColumn("__r", F.row_number().over(repeated)).filter("__r = 1")
    return one.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.filter(~worded))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mask and updates their lengths; no document is dropped."""
    found = secrets.spans(_apart(docs), text="__body", carry=("__row", "__body"))
    clean = found.withColumn("__clean", secrets.redacted(F.col("__body"), F.col("__spans")))
    instead = {"text": F.col("__clean")}
    if "n_chars" in docs.columns:
        length = F.length("__clean").cast(docs.schema["n_chars"].dataType)
        instead["n_chars"] = F.when(F.size("__spans") > 0, length).otherwise(F.col("__row").getField("n_chars"))
    return clean.select(*_columns(docs, **instead))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 4096 ids."""
    return packing.packed(docs)


STAGES = [
    ("language", identify_language),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# Not SQL: the language model, the tokenizer and the packing order have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written before the next one reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
