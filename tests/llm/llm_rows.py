"""Rows that the tests of the training-data operators share."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns named like those that operators use inside.
CLASHING = "ids n_tokens bucket of spans text_key component_id anchors member leader removed_spans score kept place".split()


def documents(spark, rows, schema=DOCUMENTS):
    """Documents from (doc_id, text) or longer rows; the rest is filled up."""
    width = len(schema.split(", "))
    filled = []
    for row in rows:
        row = (*row, *[None] * (4 - len(row)))
        filled.append((*row[:4], len(row[1] or ""))[:width])
    return spark.createDataFrame(filled, schema)


def with_clashing_columns(frame):
    from pyspark.sql import functions as F

    return frame.select("*", *[F.lit("clash").alias(name) for name in CLASHING])


def words(rng: random.Random, n: int, vocabulary: int = 500) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows(long_words: int = 20_000):
    """NULL ids and texts, empty, blank, odd and very long texts, repeated rows and copies."""
    rng = random.Random(5)
    long_text = words(rng, long_words, 50_000)
    return [
        (None, "a text without an id but with some words in it, more than fifty bytes of them at any rate"),
        (None, None),
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "é" * 70),
        (5, "\U0001f600 12345 !!! ..."),
        (6, long_text),
        (7, long_text),
        (8, "the same row twice, the same row twice, the same row twice, the same row twice"),
        (8, "the same row twice, the same row twice, the same row twice, the same row twice"),
        (9, "a" * 5000),
        (10, "one id"),
        (10, "for two different texts of which this one is longer than fifty bytes, as it should be"),
        (11, "Words, with punctuation; and\nlines\n\nand a last line"),
    ]
