"""Quality rules: a threshold table compiled into one projection of built-in functions.

Each rule bounds a ratio of two measures, written without division: a text fails a rule when
`scale * numerator` lies outside `bound * denominator`, and the rule applies to texts with at least `from_words` words. The
rule on stop words knows four languages: where a column names a text's language, it leaves texts of any other one alone.
NULL and empty texts have no words, fail `n_words` and are not kept. Nothing here runs Python.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import WORD_SPLIT

WINDOW = 8
SYMBOLS = "#*$%&|<>"

# Frequent function words of the corpus languages.
STOP_WORDS_OF = {
    "en": "the of and to in is that it for on was with as by this are be or from at which not".split(),
    "de": "der die das und von zu mit den im für ist des sich auf dem nicht ein eine als auch".split(),
    "fr": "le la les un une du de et en que est pour qui dans par sur pas au avec il elle".split(),
    "es": "el los las y se por para con no su al lo una como".split(),
}
STOP_WORDS = [w for words in STOP_WORDS_OF.values() for w in words]


class Rule(NamedTuple):
    """`low * of <= 100 * measure <= high * of` for texts of `from_words` words or more; None leaves a side open. With `listed`
    it does not hold for texts of a language that has no list of stop words."""

    name: str
    measure: str
    of: str
    low: int | None = None
    high: int | None = None
    from_words: int = 0
    listed: bool = False


# The rules of the fixed base verdict.
BASE = (
    Rule("few_words", "n_words", "one", low=2000),
    Rule("repeated_words", "n_repeat_words", "n_words", high=30),
)
# The method's own thresholds, calibrated on `labels`: clean texts stay well inside each bound.
METHOD = (
    Rule("word_length", "word_chars", "n_words", low=250, high=1200),
    Rule("symbols", "n_symbols", "word_chars", high=5),
    Rule("stop_words", "n_stop_words", "n_words", low=4, from_words=40, listed=True),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=50),
)


def fails(rule: Rule) -> Column:
    value, base = F.col(rule.measure) * 100, F.col(rule.of)
    bad = F.lit(False)
    if rule.low is not None:
        bad = bad | (value < base * rule.low)
    if rule.high is not None:
        bad = bad | (value > base * rule.high)
    return bad & (F.col("n_words") >= rule.from_words) & (F.col("has_list") if rule.listed else F.lit(True))


def any_fails(rules: tuple[Rule, ...]) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | fails(rule)
    return out


def measures(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), lang: str | None = None) -> DataFrame:
    """`carry` and the measures of every text; `has_list` is false for texts that `lang` says are of a language without stop
    words here.

    Words of repeated windows are found in two steps: 64-bit window hashes tell the texts that may repeat a window at all,
    and only those texts sort their windows as word sequences, so the count is exact.
    """
    keep = [F.col(c) for c in carry]
    known = F.coalesce(F.col(lang).isin(*STOP_WORDS_OF), F.lit(True)) if lang else F.lit(True)
    base = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"), known.alias("has_list"))
    split = base.select(
        *keep, "has_list",
        F.array_remove(F.split("__text", WORD_SPLIT, -1), "").alias("__words"),
        F.filter(F.split("__text", "\n", -1), lambda x: x.rlike(r"\S")).alias("__lines"),
        F.length(F.translate("__text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        *keep, "has_list", "__words", "word_chars", "n_symbols",
        F.size("__words").cast("long").alias("n_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("__words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"),
    )
    done = [*keep, "has_list", "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines", "n_stop_words"]
    last = F.size("__words") - WINDOW
    hashed = counted.select(*done, "__words", F.when(
        last >= 1, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("__hashes", i + k) for k in range(WINDOW)]))
    ).alias("__windows"))
    may_repeat = F.size(F.array_distinct("__windows")) < F.size("__windows")
    flagged = hashed.select(*done, "__words", F.coalesce(may_repeat, F.lit(False)).alias("__repeats"))
    ordered = flagged.select(*done, F.when(F.col("__repeats"), F.sort_array(F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(F.array_join(F.slice("__words", i + 1, WINDOW), " ").alias("w"), i.alias("at")),
    ))).alias("__sorted"))
    starts = ordered.select(*done, F.when(F.col("__sorted").isNotNull(), F.array_sort(F.transform(
        F.filter("__sorted", lambda x, k: (x["w"] == F.get("__sorted", k - 1)["w"]) | (x["w"] == F.get("__sorted", k + 1)["w"])),
        lambda x: x["at"],
    ))).alias("__starts"))
    covered = F.aggregate(
        "__starts", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n"), (i + WINDOW).alias("end")),
        lambda acc: acc["n"])
    found = ("has_list", "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines", "n_stop_words")
    # Through a generator, so that a filter on a verdict is not pushed down into the measures and repeats their work.
    pinned = F.struct(*found, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), F.lit(1).alias("one"))
    return starts.select(*keep, F.inline(F.array(pinned)))


def judged(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), lang: str | None = None) -> DataFrame:
    """Measures, one flag per method rule, `base_failed` and `kept`. `n_words` columns of `docs` itself are not used."""
    m = measures(docs, text, carry, lang).withColumn("base_failed", any_fails(BASE))
    flags = {f"failed_{r.name}": fails(r) for r in METHOD}
    return m.withColumns(flags).withColumn("kept", ~F.col("base_failed") & ~any_fails(METHOD)).drop("one", "has_list")


def op10_quality(spark, sf_dir):
    """Base measures and the verdict of every document."""
    from voltframe.llm.common import read

    return judged(read(spark, sf_dir, "documents"), lang="lang").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LISTED = ", ".join(f"'{x}'" for x in STOP_WORDS_OF)
ORACLE_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(lang IN ({_LISTED}), true) AS has_list, coalesce(text, '') AS text, {_WORDS} AS words,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM t WHERE len(words) >= {WINDOW})),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, {WINDOW}) AS r(k) GROUP BY doc_id),
m AS (SELECT t.doc_id, has_list, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(len(list_filter(words, lambda w: list_contains({STOP_WORDS!r}, lower(w)))) AS BIGINT) AS n_stop_words,
             coalesce(c.n, 0) AS n_repeat_words
      FROM t LEFT JOIN covered c ON c.doc_id IS NOT DISTINCT FROM t.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND NOT (100 * word_chars < 250 * n_words OR 100 * word_chars > 1200 * n_words)
       AND NOT (100 * n_symbols > 5 * word_chars)
       AND NOT (has_list AND n_words >= 40 AND 100 * n_stop_words < 4 * n_words)
       AND NOT (100 * n_dup_lines > 50 * n_lines) AS kept
FROM b"""
