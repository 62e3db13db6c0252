"""Rows that every operator must take: NULLs, empty and long texts, ties, repeated rows and
extra columns with clashing names."""

import random

from pyspark.sql import functions as F

LONG = " ".join(random.Random(5).choices("alpha beta gamma delta epsilon the of and".split(), k=60_000))
PLAIN = "the quick brown fox jumps over the lazy dog and then runs home to the old farm by the river"

ROWS = [
    (1, PLAIN, "en"), (2, None, "en"), (3, "", None), (None, PLAIN + " today", "en"), (4, " \n\t ", "fr"),
    (5, LONG, "en"), (1, PLAIN, "en"), (6, PLAIN, "en"), (7, PLAIN.upper(), "de"), (8, "le chat et la souris", "fr"),
    (9, "ünï cödé ’ – 日本語 😀 x", "de"), (10, "one two", "en"), (11, "one two", None), (None, None, None),
    (12, "...", "en"), (13, "a\x00b c\x0bd\x0ce\x1cf\x85g\xa0h", "en"),
]
CLASHING = ("score", "predicted", "label", "cls", "node", "words", "lines", "n", "component_id", "n_shingles", "length", "start",
            "held_out", "lang_pred", "text_hash", "prefix", "kept", "ids", "at", "file", "turns", "host", "path", "rule")


def cases(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df = df.withColumns({"source": F.lit("s"), "n_chars": F.char_length("text").cast("long")})
    return df.withColumns({c: F.lit("x") for c in CLASHING})


def empty(spark):
    return cases(spark).limit(0)


def values(df, *columns):
    return sorted(([r[c] for c in columns] for r in df.collect()), key=repr)
