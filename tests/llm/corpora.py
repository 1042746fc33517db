"""Small inputs for all operators: odd rows, and texts from a fixed generator."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem " * 300_000


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def text(seed, n=60, vocabulary=400):
    return " ".join(words(seed, n, vocabulary))


def odd_rows():
    return [
        (None, text(1), "en", "a", 1),
        (None, None, None, None, None),
        (1, None, "en", "a", 0),
        (2, "", "en", None, 0),
        (3, " \t\n\x0b ", None, "b", 5),
        (4, text(4), "en", "a", 9),
        (4, text(4), "en", "a", 9),
        (5, text(4), "fr", "b", 9),
        (6, text(6), "fr", "b", 9),
        (6, text(7), "en", "c", 9),
        (7, LONG, "de", "c", 9),
        (8, "é Ω 日本語 ß İ", "de", "é", 3),
        (9, "\x00 !? 123", "xx", "a", 3),
    ]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def with_clashes(df):
    """More columns, under names that the operators use themselves."""
    for name in ("rank", "bits", "shard", "position", "toxicity", "text_key", "gone_lines", "row_key", "removed", "size", "order", "Score", "component_id"):
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df


def spaced(value):
    return (value or "").encode().lower().split()
