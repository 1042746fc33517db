"""JSON as the harvest reads and writes it.

Entries travel as canonical text: object keys sorted at every depth, UTF-8 kept, no blanks.
Spark's VARIANT does nearly all of it inside the JVM. It differs from the expected result in a
few corners (``1.0`` prints as ``1``, duplicate keys and ``NaN`` are refused, control characters are
escaped in upper case), and only the texts that touch one of those go to a Python helper.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Number forms and escapes that VARIANT would print differently, and characters that it sorts by their UTF-16 units.
_INEXACT = (
    r"(?:^|[:\[,])\s*-?[0-9]+(?:\.[0-9]|[eE]|[0-9]{29})"
    r"|\\u(?:00[01]|[dD][89a-fA-F])"
    r"|[\x{10000}-\x{10FFFF}]"
)
# What a JSON text can start with, including the three literals only Python knows.
_JSON_START = r'^[ \t\r\n]*["{\[0-9tfnNI-]'

_RECORDS = (
    T.StructType()
    .add("state", "string")
    .add("is_list", "boolean")
    .add("items", T.ArrayType(T.StringType()))
)
_RECORDS_ARROW = pa.struct(
    [("state", pa.string()), ("is_list", pa.bool_()), ("items", pa.list_(pa.string()))]
)
_BLOCKS = T.StructType().add("ok", "boolean").add("items", T.ArrayType(T.StringType()))
_BLOCKS_ARROW = pa.struct([("ok", pa.bool_()), ("items", pa.list_(pa.string()))])


def sealed(content: Column) -> Column:
    """Parse ``content`` next to a checksum, so that trailing text cannot go unnoticed.

    ``try_parse_json`` stops after the first value. Inside ``[content, checksum]`` anything behind
    the first value moves or hides the checksum.
    """
    return F.try_parse_json(
        F.concat(F.lit("["), content, F.lit(","), F.xxhash64(content).cast("string"), F.lit("]"))
    )


def unsealed(parsed: Column, content: Column) -> Column:
    """The value inside a sealed parse, or NULL if ``content`` was not exactly one JSON value."""
    whole = F.try_variant_get(parsed, "$[1]", "bigint") == F.xxhash64(content)
    return F.when(whole, F.try_variant_get(parsed, "$[0]", "variant"))


def texts(values: Column) -> Column:
    return F.transform(values, lambda v: F.to_json(v))


def is_inexact(content: Column) -> Column:
    return content.rlike(_INEXACT)


def _path(keys: tuple[str, ...]) -> str:
    return "$" + "".join(f"['{key}']" for key in keys)


def with_records(df: DataFrame, content: str, out: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Add ``out``: the canonical records that the JSON text in ``content`` holds under ``keys``.

    ``out.state`` is ``ok``, ``parse`` (not one JSON value) or ``missing`` (no such key); a value that
    is not a list counts as a list of one. NULL content gives NULL.
    """
    text = F.col(content)
    value, exact, listed, native = (f"_{out}_{name}" for name in ("value", "exact", "listed", "native"))
    df = df.withColumn(f"_{out}_json", text.rlike(_JSON_START))
    is_json = F.col(f"_{out}_json")
    df = df.withColumn(value, sealed(F.when(is_json, text)))
    df = df.withColumn(value, unsealed(F.col(value), text))
    df = df.withColumn(exact, F.col(value).isNotNull() & ~is_inexact(text))
    if keys:
        df = df.withColumn(value, F.try_variant_get(value, _path(keys), "variant"))
    df = df.withColumn(listed, F.try_variant_get(value, "$", "array<variant>"))
    is_list = F.col(listed).isNotNull()
    items = F.when(is_list, texts(F.col(listed))).otherwise(F.array(F.to_json(value)))
    df = df.withColumn(
        native,
        F.when(text.isNull(), F.lit(None))
        .when(~is_json, _records("parse"))
        .when(F.col(exact) & F.col(value).isNull(), _records("missing"))
        .when(F.col(exact), _records("ok", is_list, items)),
    ).drop(value, exact, listed, f"_{out}_json")
    rest = F.when(F.col(native).isNull(), text)
    df = df.withColumn(f"_{out}_other", _records_helper(keys)(rest))
    return df.withColumn(out, F.coalesce(native, f"_{out}_other")).drop(native, f"_{out}_other")


def with_canonical(df: DataFrame, content: str, out: str) -> DataFrame:
    """Add ``out``: the canonical text of the JSON value that ``content`` is; ``content`` is known to be one."""
    text = F.col(content)
    df = df.withColumn("_value", sealed(F.when(~is_inexact(text), text)))
    df = df.withColumn("_native", F.to_json(unsealed(F.col("_value"), text)))
    df = df.withColumn("_other", _canonical_text(F.when(F.col("_native").isNull(), text)))
    return df.withColumn(out, F.coalesce("_native", "_other")).drop("_value", "_native", "_other")


def _records(state: str, is_list: Column | None = None, items: Column | None = None) -> Column:
    return F.struct(
        F.lit(state).alias("state"),
        (F.lit(None) if is_list is None else is_list).cast("boolean").alias("is_list"),
        (F.lit(None) if items is None else items).cast("array<string>").alias("items"),
    )


def with_block_items(df: DataFrame, blocks: str, out: str) -> DataFrame:
    """Add ``out``: the objects in a page's JSON-LD blocks, in order, or NULL if any block is bad.

    A block's list is spliced in, a lone object is kept, lone scalars and empty values are left out.
    """
    native = f"_{out}_native"
    parsed = F.transform(
        blocks, lambda b: F.struct(b.alias("text"), sealed(b).alias("parsed"))
    )
    values = F.transform(parsed, lambda p: unsealed(p["parsed"], p["text"]))
    df = df.withColumn(f"_{out}_values", values)
    exact = F.forall(f"_{out}_values", lambda v: v.isNotNull()) & ~F.exists(blocks, is_inexact)
    df = df.withColumn(
        native,
        F.when(exact, F.flatten(F.transform(f"_{out}_values", _kept_members))),
    ).drop(f"_{out}_values")
    rest = F.when(F.col(native).isNull(), F.col(blocks))
    df = df.withColumn(f"_{out}_other", _blocks_helper(rest))
    return df.withColumn(out, F.coalesce(native, f"_{out}_other.items")).drop(
        native, f"_{out}_other"
    )


def _kept_members(value: Column) -> Column:
    listed = F.try_variant_get(value, "$", "array<variant>")
    return F.when(
        listed.isNotNull(), F.filter(texts(listed), lambda t: ~t.isin(*_EMPTY_TEXTS))
    ).otherwise(F.filter(F.array(F.to_json(value)), lambda t: t.startswith("{") & (t != "{}")))


# Canonical texts of the values Python counts as empty.
_EMPTY_TEXTS = ("null", "false", "0", '""', "[]", "{}")


# --- the Python helper: only for texts the JVM cannot parse or print exactly -----------------------

_SURROGATE = re.compile("[\ud800-\udfff]")


def storable(text: str) -> str:
    """JSON text with lone surrogates escaped: they cannot be stored as UTF-8, their escapes can."""
    return _SURROGATE.sub(lambda m: f"\\u{ord(m.group()):04x}", text)


def canonical(value: object) -> str:
    return storable(json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":")))


def _loads(text: str, strict: bool = True):
    try:
        return json.loads(text, strict=strict)
    except RecursionError as error:
        raise ValueError("nested too deeply") from error


def _records_in(text: str, keys: tuple[str, ...]) -> dict:
    try:
        value = _loads(text)
    except ValueError:
        return {"state": "parse"}
    for key in keys:
        if not isinstance(value, dict) or key not in value:
            return {"state": "missing"}
        value = value[key]
    is_list = isinstance(value, list)
    items = value if is_list else [value]
    return {"state": "ok", "is_list": is_list, "items": [canonical(item) for item in items]}


def _records_helper(keys: tuple[str, ...]):
    @F.arrow_udf(_RECORDS)
    def records(contents: pa.Array) -> pa.Array:
        if contents.null_count == len(contents):
            return pa.nulls(len(contents), _RECORDS_ARROW)
        rows = [None if text is None else _records_in(text, keys) for text in contents.to_pylist()]
        return pa.array(rows, _RECORDS_ARROW)

    # Not deterministic on purpose: the optimiser then neither copies nor re-runs the call.
    return records.asNondeterministic()


_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|//[^\n]*|/\*.*?\*/', re.DOTALL)
_LAST_COMMA = re.compile(r'("(?:[^"\\]|\\.)*")|,(?=\s*[}\]])', re.DOTALL)
_COMMENT_LINE = re.compile(r"^\s*(//.*|<!--.*-->)")


def _relaxed(text: str) -> str:
    """Drop comments and commas before a closing bracket, both outside strings."""
    text = _COMMENT_LINE.sub("", text)
    text = _TOKEN.sub(lambda m: m.group() if m.group().startswith('"') else "", text)
    return _LAST_COMMA.sub(lambda m: m.group(1) or "", text)


def _block_items(text: str) -> list[str]:
    try:
        value = _loads(text, strict=False)
    except ValueError:
        value = _loads(_relaxed(text), strict=False)
    if isinstance(value, dict):
        value = [value]
    return [canonical(item) for item in value if item] if isinstance(value, list) else []


def _page_items(blocks: list[str]) -> dict:
    try:
        return {"ok": True, "items": [item for block in blocks for item in _block_items(block)]}
    except ValueError:
        return {"ok": False, "items": None}


@F.arrow_udf(_BLOCKS)
def _blocks_of_pages(pages: pa.Array) -> pa.Array:
    if pages.null_count == len(pages):
        return pa.nulls(len(pages), _BLOCKS_ARROW)
    rows = [None if blocks is None else _page_items(blocks) for blocks in pages.to_pylist()]
    return pa.array(rows, _BLOCKS_ARROW)


_blocks_helper = _blocks_of_pages.asNondeterministic()


def _per_text(function):
    @F.arrow_udf(T.StringType())
    def helper(texts: pa.Array) -> pa.Array:
        if texts.null_count == len(texts):
            return pa.nulls(len(texts), pa.string())
        return pa.array([None if text is None else function(text) for text in texts.to_pylist()], pa.string())

    return helper.asNondeterministic()


_canonical_text = _per_text(lambda text: canonical(_loads(text)))

_LIMITS = {"NaN": None, "Infinity": 1.7976931348623157e308, "-Infinity": -1.7976931348623157e308}


def _finite(text: str) -> str:
    return canonical(json.loads(text, parse_constant=_LIMITS.get))


def _pruned(value: object) -> object:
    if isinstance(value, dict):
        return {k: _pruned(v) for k, v in value.items() if v is not None}
    return [_pruned(v) for v in value if v is not None] if isinstance(value, list) else value


def _null_free(text: str) -> str:
    return storable(json.dumps(_pruned(json.loads(text)), ensure_ascii=False, separators=(",", ":")))


# Canonical text with the constants that only Python knows replaced: NaN by null, infinities by the largest numbers.
finite_text = _per_text(_finite)
# The text without nulls in objects and lists at any depth; key order stays.
null_free_text = _per_text(_null_free)

_HAS_NULL = r"[:\[,]null[,\]}]"


def may_hold_null(content: Column) -> Column:
    """Whether a compact JSON text holds a null; a string that looks like one counts too."""
    return content.rlike(_HAS_NULL)
