"""Response bodies as text: the charset is read off the bytes, else taken as declared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What windows-1252 prints for the bytes 0x80 to 0x9F (five of them are undefined).
_CP1252_FROM = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
_CP1252_TO = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_CP1252_UNDEFINED = "[\x81\x8d\x8f\x90\x9d]"
# The eight characters in which ISO-8859-15 differs from ISO-8859-1.
_LATIN9_FROM = "\xa4\xa6\xa8\xb4\xb8\xbc\xbd\xbe"
_LATIN9_TO = "€ŠšŽžŒœŸ"

_UTF8_MARK = bytearray(b"\xef\xbb\xbf")
_UTF16_MARKS = (bytearray(b"\xff\xfe"), bytearray(b"\xfe\xff"))
_UTF32_MARKS = (bytearray(b"\xff\xfe\x00\x00"), bytearray(b"\x00\x00\xfe\xff"))


def decoded_text(body: Column, charset: Column | None = None) -> Column:
    """Text of ``body``, or NULL if it cannot be decoded.

    A byte order mark decides first, then valid UTF-8, then the declared ``charset``. An empty body
    has no charset and cannot be decoded. Every branch checks the bytes before it decodes, since
    ``decode`` would fail the task.
    """
    start2, start3, start4 = (F.substring(body, 1, n) for n in (2, 3, 4))
    raw = body.cast("string")
    after_mark = F.substring(body, 4, 2**31 - 1).cast("string")
    text = (
        F.when(F.length(body) == 0, F.lit(None))
        .when(start3 == F.lit(_UTF8_MARK), F.when(F.is_valid_utf8(after_mark), after_mark))
        .when(F.is_valid_utf8(raw), raw)
        .when(start4.isin(*_UTF32_MARKS), F.when(_utf32_ok(body), F.decode(body, "UTF-32")))
        .when(start2.isin(*_UTF16_MARKS), F.when(_utf16_ok(body), F.decode(body, "UTF-16")))
    )
    if charset is None:
        return text
    name = F.lower(F.trim(charset))
    latin1 = F.decode(body, "ISO-8859-1")
    return (
        text.when(name.isin("iso-8859-1", "latin-1", "latin1"), latin1)
        .when(name.isin("iso-8859-15", "latin-9"), F.translate(latin1, _LATIN9_FROM, _LATIN9_TO))
        .when(
            name.isin("windows-1252", "cp1252") & ~latin1.rlike(_CP1252_UNDEFINED),
            F.translate(latin1, _CP1252_FROM, _CP1252_TO),
        )
    )


def has_mark(body: Column) -> Column:
    """Whether a byte order mark opens the body."""
    return (F.substring(body, 1, 3) == F.lit(_UTF8_MARK)) | F.substring(body, 1, 2).isin(*_UTF16_MARKS) | F.substring(body, 1, 4).isin(*_UTF32_MARKS)


def _utf16_ok(body: Column) -> Column:
    """Whole units only, and every surrogate has its partner."""
    units = F.regexp_replace(F.hex(body), "(.{4})", "$1,")
    little = F.regexp_replace(units, "..D[89AB],..D[C-F],", "")
    big = F.regexp_replace(units, "D[89AB]..,D[C-F]..,", "")
    lone = F.when(units.startswith("FFFE"), little.rlike("D[89A-F],")).otherwise(
        big.rlike("(?:^|,)D[89A-F]..,")
    )
    return (F.length(body) % 2 == 0) & ~lone


def _utf32_ok(body: Column) -> Column:
    """Whole units only, each a character that exists."""
    units = F.regexp_replace(F.hex(body), "(.{8})", "$1,")
    good = F.when(
        units.startswith("FFFE"), F.regexp_replace(units, "..(?:(?!D[89A-F])..00|..(?:0[1-9A-F]|10))00,", "")
    ).otherwise(F.regexp_replace(units, "00(?:00(?!D[89A-F])..|(?:0[1-9A-F]|10)..)..,", ""))
    return (F.length(body) % 4 == 0) & (good == "")
