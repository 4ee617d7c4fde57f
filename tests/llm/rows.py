"""Small tables for the tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators might use for themselves.
CLASHES = ["size", "copies", "score", "language", "nth", "rows", "fp", "bucket", "key", "group", "_text", "_bucket", "count"]


def prose(seed: int, words: int, letters: str = "abcdefghij") -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(words)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(made))


def edge_rows() -> list[tuple]:
    long = prose(1, 30_000)
    texts = [
        None, "", " \t\n\x0b\f\r", "one", "one two", "éÀ ß 日本 \U0001f600 x", "123 456 !!!", prose(2, 60), prose(2, 60), prose(3, 300),
        "A b C d E f G h I j\n" * 6, "spam *** $$$ %%% " * 30, long, long + " end",
    ]
    rows = [(i * 3, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", None) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, "no id here at all", None, None, 3), (None, None, None, None, None), (3, "the same id as another text", "en", "s1", 9)]
    return rows


def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def edge_documents(spark):
    from pyspark.sql import functions as F

    df = documents(spark, edge_rows())
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
