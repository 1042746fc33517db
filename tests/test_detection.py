import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.functions.detection import CHARSETS, charset_detector, pair_counts
from sheaf.operators.fetch import landed_texts
from sheaf.schemas import CHARSET, RESPONSES

WORDS = "über größe straße für daß mädchen schön wäre nicht und die der das ein Ähre Öl Übung été élève garçon où déjà très".split()


def sentence(seed, n=30):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def model(spark):
    return pair_counts(spark.createDataFrame([(sentence(i),) for i in range(300)] + [(None,), ("",)], "text string"), "text")


def test_counts_are_those_of_the_encoded_texts(spark):
    found = {(r.charset, r.pair): r.n for r in pair_counts(spark.createDataFrame([("aéa",), ("日本",)], "text string"), "text", ("cp850", "utf-16-le")).collect()}
    odd = 1 << 16
    assert found == {
        ("cp850", 0x6182): 1, ("cp850", 0x8261 + odd): 1,
        ("utf-16-le", 0x6100): 2, ("utf-16-le", 0x00E9 + odd): 1, ("utf-16-le", 0xE900): 1, ("utf-16-le", 0x0061 + odd): 1,
        ("utf-16-le", 0xE565): 1, ("utf-16-le", 0x652C + odd): 1, ("utf-16-le", 0x2C67): 1,
    }


def test_undeclared_charsets_are_read(spark):
    detect = charset_detector(model(spark))
    rows, want = [], {}
    for i in range(200):
        text, charset = sentence(10_000 + i), CHARSETS[i % len(CHARSETS)]
        rows.append((str(i), 200, bytearray(text.encode(charset)), None))
        want[str(i)] = ("ok", text)
    rows += [("empty", 200, bytearray(), None), ("none", 200, None, None), ("lost", 404, bytearray(b"\xff"), None)]
    rows += [("marked", 200, bytearray("﻿a\x00b".encode("utf-16-le")), None), ("plain", 200, bytearray(b"abc"), None)]
    want |= {"empty": ("decode", None), "none": ("decode", None), "lost": ("response", None), "marked": ("ok", "a\x00b"), "plain": ("ok", "abc")}
    found = landed_texts(spark.createDataFrame(rows, RESPONSES), detect=detect).collect()
    assert {r.url: (r.outcome, r.content) for r in found} == want


def test_a_declared_charset_comes_first(spark):
    row = ("a", 200, bytearray("été".encode("iso-8859-1")), None, "iso-8859-1")
    responses = spark.createDataFrame([row], T.StructType([*RESPONSES.fields, CHARSET]))
    read = landed_texts(responses, detect=lambda body: F.when(body.isNotNull(), F.lit("guessed")))
    assert read.first().content == "été"


def test_an_empty_model_takes_the_first_charset_that_fits(spark):
    detect = charset_detector(pair_counts(spark.createDataFrame([], "text string"), "text"))
    bodies = spark.createDataFrame([(bytearray(b"\xe9\xe9"),), (bytearray(b"\x81\x81\x81"),)], "body binary")
    assert [r[0] for r in bodies.select(detect(F.col("body"))).collect()] == ["éé", b"\x81\x81\x81".decode("mac-roman")]
