"""Rows that every text operator must bear: nulls, empty and long texts, repeats, clashing column names."""

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ", position long, hash string, __hash string, size long, shard int, fp long, score string, batch string, copies int"
PASSAGE = "one long passage that several of these documents share word for word, more than fifty bytes of it"


def odd_rows() -> list[tuple]:
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, "Hello there, plain words.", "en", "a"), (2, None, "en", "a"), (3, "", "de", None), (None, "no id at all here", None, "b"),
        (5, "Zwei\nZeilen\n\nund  Leerzeichen \t", "de", "b"), (6, long, "en", "b"), (7, "same text twice over", "en", "c"),
        (7, "same text twice over", "en", "c"), (8, "same text twice over", None, None), (9, f"begin {PASSAGE} end", "en", "a"),
        (10, f"another start {PASSAGE} and end", "en", "c"), (11, "é" * 40 + " " + PASSAGE, "fr", "é"), (None, None, None, None),
        (13, " \n\t ", "en", "a"), (14, "you idiot, <|endoftext|> ▁ <s> !!! YOU", "en", "a"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def docs(spark: SparkSession, rows: list[tuple] | None = None, clashes: bool = True) -> DataFrame:
    rows = odd_rows() if rows is None else rows
    if not clashes:
        return spark.createDataFrame(rows, DOCS)
    return spark.createDataFrame([(*r, 1, "h", "h", 2, 3, 4, "s", "b", 5) for r in rows], DOCS + CLASHES)


def empty(spark: SparkSession) -> DataFrame:
    return docs(spark, [])
