"""Small document tables with the cases that every operator must bear."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SF = "/root/testdata/sf0.001"
EN = "the cat and the dog went to the river with all of the people that live in the old town by the sea and it was good for them"
DE = "der hund und die katze gehen mit den leuten zu dem fluss und das ist nicht gut für die stadt und der mann sieht es auch nicht"


def row(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text))


def awkward():
    """NULLs in every column, empty, blank, very long and odd texts, repeated rows and repeated ids."""
    long = " ".join(f"word{i % 977} the of {i}" for i in range(40_000))
    return [
        row(1, EN), row(2, EN), row(2, EN), row(3, None), row(4, ""), row(5, " \n\t "), row(6, long), (None, DE, "de", None, None),
        (None, None, None, None, None), row(7, "é 日本   \x1c <|endoftext|> ½", None), row(8, "!!! 123"), row(9, DE, "de"),
        row(9, "another text under a used id", "en"), row(10, "a")]


def awkward_frame(spark):
    return spark.createDataFrame(awkward(), DOCUMENTS)


def clashing(df):
    """Extra columns that bear the operators' own names."""
    from pyspark.sql import functions as F

    names = ("kept", "n_words", "one", "cid", "n", "key", "part", "ids", "score", "held_out", "block", "unit", "rank", "spans", "component_id")
    return df.withColumns({n: F.lit("x") for n in names})


def stored(df, tmp_path, name="documents"):
    df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
