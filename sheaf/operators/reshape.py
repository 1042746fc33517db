"""Reshape of one repository's records into schema.org ``Dataset`` objects.

The record is read as VARIANT, because an absent field, a null and an empty list lead to different
results. A record may give several datasets (titles x descriptions x licences) or none.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.binding import bound
from sheaf.functions.json import finite_text, may_hold_null, null_free_text

POSITIONS = ("url_pos", "item_pos", "title_pos", "description_pos", "license_pos")

# Fixed values of the target vocabulary and of the source's identifiers.
DOI_PREFIX = "https://doi.org/"
RESOURCE_PREFIX = "https://repository.publisso.de/resource/"
DOI_REGISTRY = "https://registry.identifiers.org/registry/doi"
INTERNAL_ID = "frl-internal"
DEWEY = "https://www.oclc.org/en/dewey.html"
VOCABULARY = "https://schema.org/"

# Source fields whose members are objects that are read by key.
_OBJECT_LISTS = (
    "creator", "contributor", "institution", "ddc", "subject", "dataOrigin", "fundingId",
    "joinedFunding", "hasPart", "language", "license", "recordingCoordinates", "recordingLocation",
)
_PLAIN_LISTS = ("title", "description", "fundingProgram")
_FIRST_ONLY = ("alternative", "yearOfCopyright")
_SCALARS = ("doi", "@id", "issued")


def _key(value: Column, key: str) -> Column:
    """Member of an object: SQL NULL if absent, a variant null if null."""
    return F.try_variant_get(value, f"$['{key}']", "variant")


def _text(value: Column, key: str) -> Column:
    return F.try_variant_get(value, f"$['{key}']", "string")


def _kind(value: Column) -> Column:
    """JSON type name; NULL if absent."""
    return F.schema_of_variant(value)


def _filled(value: Column) -> Column:
    """The value unless it is null, so that writing it out leaves it away."""
    return F.when(~F.is_variant_null(value), value)


def _iterated(value: Column) -> Column:
    """Members of a list, values of an object, NULL for what cannot be iterated."""
    return F.coalesce(
        F.try_variant_get(value, "$", "array<variant>"),
        F.map_values(F.try_variant_get(value, "$", "map<string,variant>")),
    )


def _any(conditions: list[Column]) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, conditions), F.lit(False))


def _not_keyed(member: Column) -> Column:
    """True for a member from which no key can be read."""
    kind = _kind(member)
    return ~(kind.startswith("OBJECT") | (kind == "VOID"))


def parsed_fields(records: DataFrame) -> DataFrame:
    """Replace ``entry`` by one VARIANT column per source field (``v_``) and per list (``l_``)."""
    is_object = F.col("entry").startswith("{")
    df = bound(records, {"_native": F.when(is_object, F.try_parse_json("entry"))})
    # VARIANT refuses NaN and infinities, which a record may hold in a field that isn't even read.
    df = df.withColumn("_finite", finite_text(F.when(is_object & F.col("_native").isNull(), F.col("entry"))))
    df = df.withColumn("_record", F.coalesce("_native", F.try_parse_json("_finite"))).drop("_native", "_finite")
    names = (*_SCALARS, *_FIRST_ONLY, *_PLAIN_LISTS, *_OBJECT_LISTS)
    values = {f"v_{name}": _key(F.col("_record"), name) for name in names}
    df = bound(df, values, drop=("_record", "entry"))
    lists = (*_PLAIN_LISTS, *_OBJECT_LISTS)
    return bound(df, {f"l_{name}": _iterated(F.col(f"v_{name}")) for name in lists})


def with_errors(df: DataFrame) -> DataFrame:
    """Add ``failed``, and ``good_licences``: how many licences come before the failing one.

    Fields are worked off in a fixed order. A record without titles (then descriptions, then
    licences) gives nothing and is not looked at any further, so it cannot fail later.
    """

    def v(name: str) -> Column:
        return F.col(f"`v_{name}`")

    def items(name: str) -> Column:
        return F.col(f"l_{name}")

    def not_iterable(name: str) -> Column:
        return v(name).isNotNull() & items(name).isNull()

    def bad_members(*names: str) -> list[Column]:
        return [not_iterable(n) for n in names] + [F.exists(items(n), _not_keyed) for n in names]

    def unlabelled(name: str) -> Column:
        return F.exists(
            items(name),
            lambda m: F.coalesce(_kind(_key(m, "prefLabel")) != "STRING", F.lit(True)),
        )

    def empty(name: str) -> Column:
        return F.coalesce(F.size(items(name)) == 0, F.lit(False))

    def not_first(name: str) -> Column:
        return v(name).isNotNull() & ~(_kind(v(name)).startswith("ARRAY") | (_kind(v(name)) == "VOID"))

    doi, inner = _kind(v("doi")), _kind(v("@id"))
    no_text = ("VOID", "STRING")
    falsy_inner = (inner == "VOID") | (F.to_json(v("@id")) == "false")
    until_title = _any(
        [
            doi.isNull() & inner.isNull(),
            ~doi.isin(*no_text),
            doi.isNull() & ~inner.isin(*no_text),
            not_iterable("title"),
        ]
    )
    until_description = _any([not_first("alternative"), not_iterable("description")])
    odd_part = F.exists(
        items("hasPart"),
        lambda m: ~(_kind(_key(m, "@id")).isin(*no_text) | (F.to_json(_key(m, "@id")) == "false")),
    )
    odd_funding = F.exists(items("joinedFunding"), lambda m: _not_keyed(_key(m, "fundingJoined")))
    until_license = _any(
        [
            ~falsy_inner & (inner != "STRING"),
            *bad_members("creator", "contributor", "institution"),
            unlabelled("creator"),
            unlabelled("contributor"),
            not_first("yearOfCopyright"),
            *bad_members("ddc", "subject", "dataOrigin", "fundingId", "joinedFunding"),
            odd_funding,
            v("joinedFunding").isNull() & not_iterable("fundingProgram"),
            *bad_members("hasPart", "language"),
            odd_part,
            not_iterable("license"),
        ]
    )
    licences = F.transform(items("license"), lambda m, i: F.when(_not_keyed(m), i))
    bad_license = F.array_min(licences)
    spatial = _any(bad_members("recordingCoordinates", "recordingLocation"))
    failed = (
        F.when(until_title, True)
        .when(empty("title"), False)
        .when(until_description, True)
        .when(empty("description"), False)
        .when(until_license, True)
        .when(empty("license"), False)
        .otherwise(spatial | bad_license.isNotNull())
    )
    only_license = (
        ~until_title & ~until_description & ~until_license & ~spatial
        & ~empty("title") & ~empty("description")
    )
    good = F.when(only_license & bad_license.isNotNull(), bad_license).otherwise(0)
    return bound(df, {"failed": failed, "good_licences": good})


def _named(kind: str, *fields: tuple[str, Column]) -> Column:
    return F.struct(F.lit(kind).alias("@type"), *(column.alias(name) for name, column in fields))


def _list(name: str, build) -> Column:
    """A list field: one object per member; a field that is absent gives an empty list."""
    return F.coalesce(F.transform(F.col(f"l_{name}"), build), F.array())


def _person(member: Column) -> Column:
    label = _text(member, "prefLabel")
    parts = F.split(label, ", ", -1)
    return _named(
        "Person",
        ("familyName", F.when(label != "", F.get(parts, F.lit(0)))),
        ("givenName", F.concat_ws(" ", F.slice(parts, F.lit(2), F.size(parts)))),
        ("identifier", _filled(_key(member, "@id"))),
    )


def _id_and_name(kind: str):
    return lambda m: _named(
        kind, ("@id", _filled(_key(m, "@id"))), ("name", _filled(_key(m, "prefLabel")))
    )


def _term(scheme: str | None = None):
    return lambda m: _named(
        "DefinedTerm",
        ("name", _filled(_key(m, "prefLabel"))),
        ("identifier", _filled(_key(m, "@id"))),
        ("inDefinedTermSet", F.lit(scheme).cast("string")),
    )


def _place(name_key: str | None):
    def build(member: Column) -> Column:
        name = F.lit(None).cast("variant") if name_key is None else _filled(_key(member, name_key))
        return _named("Place", ("name", name), ("url", _filled(_key(member, "@id"))))

    return build


def _grants() -> Column:
    joined = _list(
        "joinedFunding",
        lambda m: _named(
            "Grant",
            ("name", _filled(_key(m, "fundingProgramJoined"))),
            ("funder", _id_and_name("Organization")(_key(m, "fundingJoined"))),
        ),
    )
    no_funder = F.lit(None).cast("struct<`@type`: string, `@id`: variant, name: variant>")
    programs = _list(
        "fundingProgram", lambda m: _named("Grant", ("name", _filled(m)), ("funder", no_funder))
    )
    return F.when(F.col("v_joinedFunding").isNotNull(), joined).otherwise(programs)


def _part(member: Column) -> Column:
    inner = _text(member, "@id")
    truthy = inner.isNotNull() & (_kind(_key(member, "@id")) == "STRING")
    return _named(
        "DataDownload",
        ("@id", F.when(truthy, F.concat(F.lit(RESOURCE_PREFIX), inner))),
        ("name", _filled(_key(member, "prefLabel"))),
    )


def with_dataset_fields(df: DataFrame) -> DataFrame:
    """Replace the source fields by the target fields; ``titles``, ``descriptions``, ``licences`` stay lists."""
    doi, inner = F.col("v_doi"), F.col("`v_@id`")
    doi_text, inner_text = doi.cast("string"), inner.cast("string")
    doi_url = F.concat(F.lit(DOI_PREFIX), F.coalesce(doi_text, F.lit("")))
    inner_url = F.concat(F.lit(RESOURCE_PREFIX), F.coalesce(inner_text, F.lit("")))

    def property_value(source: str, value: Column, url: Column) -> Column:
        return _named(
            "PropertyValue", ("propertyID", F.lit(source)), ("value", value), ("url", url)
        )

    identifiers = F.array_compact(
        F.array(
            F.when(doi.isNotNull(), property_value(DOI_REGISTRY, doi_text, doi_url)),
            F.when(_kind(inner) == "STRING", property_value(INTERNAL_ID, inner_text, inner_url)),
        )
    )

    def first(name: str) -> Column:
        value = F.get(F.try_variant_get(F.col(f"v_{name}"), "$", "array<variant>"), F.lit(0))
        return _filled(value)

    def choices(name: str, read) -> Column:
        """Alternatives of a field that multiplies the record; a field that is absent is one null."""
        return F.when(
            F.col(f"v_{name}").isNotNull(), F.transform(F.col(f"l_{name}"), read)
        ).otherwise(F.array(F.lit(None).cast("variant")))

    context = F.struct(F.lit("en").alias("@language"), F.lit(VOCABULARY).alias("@vocab"))
    fields = {
        "@context": context,
        "@type": F.lit("Dataset"),
        "@id": F.when(doi.isNotNull(), doi_url).otherwise(inner_url),
        "titles": choices("title", _filled),
        "alternativeHeadline": first("alternative"),
        "descriptions": choices("description", _filled),
        "identifier": identifiers,
        "creator": _list("creator", _person),
        "contributor": _list("contributor", _person),
        "sourceOrganization": _list("institution", _id_and_name("Organization")),
        "datePublished": _filled(F.col("v_issued")),
        "copyrightYear": first("yearOfCopyright"),
        "keywords": F.concat(_list("ddc", _term(DEWEY)), _list("subject", _term())),
        "measurementTechnique": _list("dataOrigin", _term()),
        "funder": _list("fundingId", _id_and_name("Organization")),
        "funding": _grants(),
        "distribution": _list("hasPart", _part),
        "inLanguage": _list("language", _id_and_name("Language")),
        "licences": choices("license", lambda m: _filled(_key(m, "@id"))),
        "spatial": F.concat(
            _list("recordingCoordinates", _place(None)),
            _list("recordingLocation", _place("prefLabel")),
        ),
    }
    sources = tuple(c for c in df.columns if c.startswith(("v_", "l_")))
    return bound(df, fields, drop=sources)


# Fields of the written object, in this order.
DATASET_FIELDS = (
    "@context", "@type", "@id", "name", "alternativeHeadline", "description", "identifier",
    "creator", "contributor", "sourceOrganization", "datePublished", "copyrightYear", "keywords",
    "measurementTechnique", "funder", "funding", "distribution", "inLanguage", "license", "spatial",
)


def fan_out(df: DataFrame) -> DataFrame:
    """One row per title, description and licence; none where one of these lists is empty."""
    for many, pos, one in (
        ("titles", "title_pos", "name"),
        ("descriptions", "description_pos", "description"),
        ("licences", "license_pos", "license"),
    ):
        others = [F.col(f"`{c}`") for c in df.columns if c != many]
        df = df.select(*others, F.posexplode(many).alias(pos, one))
    return df


def first_failures(df: DataFrame) -> DataFrame:
    """Position of the first failing record of each repository that has one."""
    position = F.struct("url_pos", "item_pos")
    return df.where("failed").groupBy("repo").agg(F.min(position).alias("first_failure"))


def reshape(
    records: DataFrame,
    on_error: str = "truncate",
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Records ``(repo, url_pos, item_pos, entry)`` to datasets, with the entry replaced.

    ``on_error='truncate'`` keeps what comes before a repository's first failing record, including
    what that record gives before it fails; ``'drop'`` leaves out the failing records only.
    Output order is ``(url_pos, item_pos, title_pos, description_pos, license_pos)``.

    Records behind the first failure are left out before anything is built from them. With ``stage``
    (see :mod:`sheaf.plans.staging`) the first failures, one short row per repository, become a table
    whose size the optimiser knows, so that few of them are broadcast and no record is shuffled.
    """
    if on_error not in ("truncate", "drop"):
        raise ValueError(f"on_error must be 'truncate' or 'drop': {on_error!r}")
    records = records.select("repo", "url_pos", "item_pos", "entry")
    if on_error == "drop":
        df = with_dataset_fields(with_errors(parsed_fields(records)).where(~F.col("failed")))
    else:
        first = first_failures(with_errors(parsed_fields(records)))
        if stage is not None:
            first = stage(first, "first_failures")
        position = F.struct("url_pos", "item_pos")
        df = records.join(first, "repo", "left")
        df = df.where(F.col("first_failure").isNull() | (position <= F.col("first_failure")))
        df = with_dataset_fields(with_errors(parsed_fields(df.drop("first_failure"))))
        df = bound(df, {c: _before_failure(c) for c in ("titles", "descriptions", "licences")})
    df = fan_out(df.drop("failed", "good_licences"))
    entry = F.to_json(F.struct(*(F.col(f"`{name}`") for name in DATASET_FIELDS)))
    df = bound(df.select("repo", *POSITIONS, *(F.col(f"`{name}`") for name in DATASET_FIELDS)), {"entry": entry}, DATASET_FIELDS)
    # Copied containers may hold nulls further down.
    pruned = null_free_text(F.when(may_hold_null(F.col("entry")), F.col("entry")))
    return df.select("repo", *POSITIONS, F.coalesce(pruned, "entry").alias("entry"))


def _before_failure(choices: str) -> Column:
    """A failing record gives its good licences with its first title and description."""
    kept = F.col("good_licences") if choices == "licences" else F.least("good_licences", F.lit(1))
    return F.when(F.col("failed"), F.slice(choices, F.lit(1), kept)).otherwise(F.col(choices))
