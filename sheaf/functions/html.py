"""JSON-LD script blocks of an HTML page, cut out with Spark's own regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
# Comments and scripts, taken in order, so that a look-alike inside one of them is passed over.
# Both run to the end of the page if they are never closed.
_PIECES = rf"(?is)<!--.*?(?:-->|\z)|<script(?=[\s>/]){_ATTRIBUTES}>.*?(?:</script(?=[\s>/])[^>]*>|\z)"
_TYPE = r"(?-i:application/ld(?:\+|&#43;|&#x2[bB];|&plus;)json)"
_TYPE_ATTRIBUTE = rf"""\stype\s*=\s*(?:"{_TYPE}"|'{_TYPE}'|{_TYPE}(?=[\s>]))"""
_OPEN_TAG = rf"(?is)^<script{_ATTRIBUTES}>"
_CLOSE_TAG = r"(?i)</script(?=[\s>/])[^>]*>$"


def jsonld_blocks(html: Column) -> Column:
    """Unparsed text of every JSON-LD script, in page order; ``''`` for an empty one."""
    pieces = F.regexp_extract_all(html, F.lit(_PIECES), F.lit(0))
    tagged = F.transform(
        pieces, lambda p: F.struct(F.regexp_extract(p, _OPEN_TAG, 0).alias("tag"), p.alias("piece"))
    )
    blocks = F.filter(tagged, lambda t: t["tag"].rlike(f"(?is){_TYPE_ATTRIBUTE}"))
    return F.transform(
        blocks,
        lambda t: F.regexp_replace(
            F.substring(t["piece"], F.length(t["tag"]) + 1, F.length(t["piece"])), _CLOSE_TAG, ""
        ),
    )
