"""Queries on the reshape into schema.org datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.corpora import fanout_records, json_object, people_records, table, text
from queries.registry import query
from sheaf.operators.reshape import reshape
from sheaf.sources.splits import spread_rows

THING = "`@id` STRING, `@type` STRING, name STRING"
DATASET = f"""
`@context` STRUCT<`@language`: STRING, `@vocab`: STRING>, `@type` STRING, `@id` STRING, name STRING,
alternativeHeadline STRING, description STRING,
identifier ARRAY<STRUCT<`@type`: STRING, propertyID: STRING, value: STRING, url: STRING>>,
creator ARRAY<STRUCT<`@type`: STRING, familyName: STRING, givenName: STRING, identifier: STRING>>,
contributor ARRAY<STRUCT<`@type`: STRING, familyName: STRING, givenName: STRING, identifier: STRING>>,
sourceOrganization ARRAY<STRUCT<{THING}>>, datePublished STRING, copyrightYear STRING,
keywords ARRAY<STRUCT<name: STRING, identifier: STRING, inDefinedTermSet: STRING>>,
measurementTechnique ARRAY<STRUCT<name: STRING, identifier: STRING>>,
funder ARRAY<STRUCT<{THING}>>, funding ARRAY<STRUCT<name: STRING, funder: STRUCT<{THING}>>>,
distribution ARRAY<STRUCT<{THING}>>, inLanguage ARRAY<STRUCT<{THING}>>, license STRING,
spatial ARRAY<STRUCT<name: STRING, url: STRING>>
"""


def datasets(records, on_error="drop"):
    """Reshaped records with the written JSON read back into columns."""
    df = reshape(records, on_error)
    return df.withColumn("d", F.from_json("entry", DATASET))


# One row per reshaped record in SQL: k is the key, t, d and l number its titles, descriptions and
# licences; a list that is absent gives one NULL.
CHOICES_SQL = """
(SELECT p_partkey AS k, p_brand, p_name, p_size,
        CASE WHEN p_partkey % 20 <> 0 THEN range(1, p_partkey % 4 + 1) ELSE [NULL::BIGINT] END AS ts,
        CASE WHEN p_partkey % 7 <> 0 THEN range(1, p_partkey % 3 + 1) ELSE [NULL::BIGINT] END AS ds,
        CASE WHEN p_partkey % 11 <> 0 THEN range(1, p_partkey % 5 + 1) ELSE [NULL::BIGINT] END AS ls,
        CASE WHEN p_partkey % 3 <> 0 THEN 'https://doi.org/' || CASE WHEN p_partkey % 17 = 0 THEN ''
                  ELSE '10.4126/' || p_partkey END
             ELSE 'https://repository.publisso.de/resource/frl:' || p_partkey END AS ident
 FROM part)
"""
FANOUT_SQL = f"""
SELECT * FROM (SELECT *, unnest(ls) AS l FROM (SELECT *, unnest(ds) AS d FROM
  (SELECT *, unnest(ts) AS t FROM {CHOICES_SQL})))
"""


@query(f"""
SELECT k AS p_partkey, ident AS "@id", 'title ' || k || '.' || t AS name,
       'about ' || k || '.' || d AS description, 'licence-' || l AS license,
       (coalesce(t, 1) - 1)::BIGINT AS title_pos, (coalesce(d, 1) - 1)::BIGINT AS description_pos,
       (coalesce(l, 1) - 1)::BIGINT AS license_pos
FROM ({FANOUT_SQL}) WHERE k % 6 <> 3
""")
def reshape_fanout(spark, sf_dir):
    df = datasets(fanout_records(spark, sf_dir))
    positions = [F.col(c).cast("bigint").alias(c) for c in ("title_pos", "description_pos", "license_pos")]
    return df.select(
        F.col("url_pos").alias("p_partkey"), "d.@id", "d.name", "d.description", "d.license", *positions
    )


@query(f"""
SELECT p_partkey, any_value("@id") AS "@id", 'en' AS lang, 'https://schema.org/' AS vocab,
       'Dataset' AS kind,
       any_value(CASE WHEN p_partkey % 4 < 2 THEN p_name END) AS headline,
       any_value(CASE WHEN p_partkey % 4 = 2 THEN p_size::VARCHAR END) AS copyright_year,
       any_value(CASE WHEN p_partkey % 5 <> 0 THEN (p_size + 1950)::VARCHAR END) AS published,
       any_value(CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 17 <> 0 THEN '10.4126/' || p_partkey
            WHEN p_partkey % 3 <> 0 THEN NULL ELSE 'frl:' || p_partkey END) AS first_value,
       any_value(CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 2 = 0
            THEN 'https://repository.publisso.de/resource/frl:' || p_partkey END) AS second_url,
       any_value((p_partkey % 3 <> 0)::INT + (p_partkey % 2 = 0)::INT)::BIGINT AS n_identifiers,
       count(*)::BIGINT AS n_datasets
FROM (SELECT k AS p_partkey, ident AS "@id", p_name, p_size FROM ({FANOUT_SQL}) WHERE k % 6 <> 3)
GROUP BY p_partkey
""")
def reshape_core(spark, sf_dir):
    df = datasets(fanout_records(spark, sf_dir))
    fields = {
        "@id": F.col("d.@id"),
        "lang": F.col("d.@context.@language"),
        "vocab": F.col("d.@context.@vocab"),
        "kind": F.col("d.@type"),
        "headline": F.col("d.alternativeHeadline"),
        "copyright_year": F.col("d.copyrightYear"),
        "published": F.col("d.datePublished"),
        "first_value": F.get("d.identifier", F.lit(0))["value"],
        "second_url": F.get("d.identifier", F.lit(1))["url"],
        "n_identifiers": F.size("d.identifier").cast("bigint"),
    }
    return df.groupBy(
        F.col("url_pos").alias("p_partkey"), *(column.alias(name) for name, column in fields.items())
    ).agg(F.count(F.lit(1)).alias("n_datasets"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN 'creator' ELSE 'contributor' END AS role,
       pos, CASE WHEN o_orderkey % 4 <> 3 THEN c_name END AS family_name,
       CASE o_orderkey % 4 WHEN 1 THEN 'Ada' WHEN 2 THEN 'Ada M.' ELSE '' END AS given_name,
       CASE WHEN o_orderkey % 3 <> 0 THEN 'p' WHEN pos = 0 THEN 'q' ELSE 'r' END || ':' || o_orderkey AS identifier
FROM (SELECT *, unnest(CASE WHEN o_orderkey % 3 <> 0 THEN [0::BIGINT] ELSE [0::BIGINT, 1] END) AS pos
      FROM orders JOIN customer ON o_custkey = c_custkey)
""")
def reshape_people(spark, sf_dir):
    df = datasets(people_records(spark, sf_dir))

    def people(role):
        def person(p, i):
            return F.struct(
                F.lit(role).alias("role"), i.cast("bigint").alias("pos"), p.alias("person")
            )

        return F.transform(f"d.{role}", person)

    people = F.concat(people("creator"), people("contributor"))
    df = df.select(F.col("url_pos").alias("o_orderkey"), F.inline(people))
    return df.select(
        "o_orderkey", "role", "pos",
        F.col("person.familyName").alias("family_name"),
        F.col("person.givenName").alias("given_name"),
        F.col("person.identifier").alias("identifier"),
    )


@query("""
SELECT k AS o_orderkey,
       CASE WHEN k % 2 = 0 THEN c_mktsegment END AS organization,
       CASE WHEN k % 2 = 0 THEN 'i:' || k END AS organization_id,
       (k % 3 + k % 2)::BIGINT AS n_keywords,
       CASE WHEN k % 3 > 0 THEN 'ddc-1' END AS first_keyword_id,
       CASE WHEN k % 3 > 0 THEN 'https://www.oclc.org/en/dewey.html' END AS first_keyword_set,
       CASE WHEN k % 2 = 1 THEN 'subject 1' END AS last_keyword,
       CASE WHEN k % 5 = 0 THEN 2 ELSE 0 END::BIGINT AS n_techniques,
       CASE WHEN k % 5 = 0 THEN 'o:' || k END AS technique_id,
       (k % 4)::BIGINT AS n_funders, CASE WHEN k % 4 > 0 THEN '1' END AS funder,
       CASE WHEN k % 6 = 0 THEN 'prog ' || k WHEN k % 2 = 0 THEN 'program ' || k END AS grant_name,
       CASE WHEN k % 6 = 0 THEN 'g:' || k END AS grant_funder_id,
       CASE WHEN k % 4 = 1 THEN 2 ELSE 0 END::BIGINT AS n_parts,
       CASE WHEN k % 4 = 1 THEN 'data.csv' END AS part_name,
       CASE WHEN k % 4 = 1 THEN 'https://repository.publisso.de/resource/part:' || k END AS part_id,
       CASE WHEN k % 5 = 1 THEN 'Deutsch' END AS language,
       CASE WHEN k % 7 = 0 THEN 2 WHEN k % 7 = 1 THEN 1 ELSE 0 END::BIGINT AS n_places,
       CASE WHEN k % 7 = 0 THEN 'geo:' || k WHEN k % 7 = 1 THEN 'loc:' || k END AS place_url,
       CASE WHEN k % 7 = 1 THEN 'Field' END AS place_name
FROM (SELECT o_orderkey AS k, * FROM orders JOIN customer ON o_custkey = c_custkey)
""")
def reshape_terms(spark, sf_dir):
    df = datasets(people_records(spark, sf_dir))

    def first(path, field):
        return F.get(path, F.lit(0))[field]

    def count(path):
        return F.size(path).cast("bigint")

    last = F.when(F.size("d.keywords") > 0, F.element_at("d.keywords", -1)["name"])
    return df.select(
        F.col("url_pos").alias("o_orderkey"),
        first("d.sourceOrganization", "name").alias("organization"),
        first("d.sourceOrganization", "@id").alias("organization_id"),
        count("d.keywords").alias("n_keywords"),
        first("d.keywords", "identifier").alias("first_keyword_id"),
        first("d.keywords", "inDefinedTermSet").alias("first_keyword_set"),
        last.alias("last_keyword"),
        count("d.measurementTechnique").alias("n_techniques"),
        first("d.measurementTechnique", "identifier").alias("technique_id"),
        count("d.funder").alias("n_funders"),
        first("d.funder", "name").alias("funder"),
        first("d.funding", "name").alias("grant_name"),
        first("d.funding", "funder")["@id"].alias("grant_funder_id"),
        count("d.distribution").alias("n_parts"),
        first("d.distribution", "name").alias("part_name"),
        F.get("d.distribution", F.lit(1))["@id"].alias("part_id"),
        first("d.inLanguage", "name").alias("language"),
        count("d.spatial").alias("n_places"),
        first("d.spatial", "url").alias("place_url"),
        first("d.spatial", "name").alias("place_name"),
    )


LISTS_SQL = """',"sourceOrganization":[]'
|| CASE WHEN k % 4 = 0 THEN '' ELSE ',"datePublished":' || CASE k % 4 WHEN 1 THEN k::VARCHAR WHEN 2 THEN 'true' ELSE '"' || k || '"' END END
|| ',"keywords":[],"measurementTechnique":[],"funder":[],"funding":['
|| CASE WHEN k % 2 = 0 THEN '{"@type":"Grant"},{"@type":"Grant","name":' || k || '}' ELSE '' END
|| '],"distribution":[],"inLanguage":['
|| CASE WHEN k % 3 = 1 THEN '{"@type":"Language"}' ELSE '' END || '],"spatial":[]}'
"""


@query(f"""
SELECT k AS p_partkey,
       '{{"@context":{{"@language":"en","@vocab":"https://schema.org/"}},"@type":"Dataset","@id":'
       || '"https://doi.org/10.2/' || k || '"'
       || CASE k % 6 WHEN 0 THEN ',"name":' || k WHEN 3 THEN ',"name":{{"a":' || k || ',"b":[{{}}]}}' ELSE '' END
       || ',"identifier":[{{"@type":"PropertyValue","propertyID":"https://registry.identifiers.org/registry/doi",'
       || '"value":"10.2/' || k || '","url":"https://doi.org/10.2/' || k || '"}}],"creator":['
       || CASE WHEN k % 3 = 2 THEN '{{"@type":"Person","givenName":""}}' ELSE '' END
       || '],"contributor":[]' || {LISTS_SQL} AS entry
FROM (SELECT p_partkey AS k FROM part)
""")
def reshape_nulls(spark, sf_dir):
    key = F.col("p_partkey")
    rows = spread_rows(table(spark, sf_dir, "part").select("p_partkey"))
    entry = json_object(
        ("doi", text('"10.2/', key, '"')),
        ("title", F.when(key % 6 == 0, text("[", key, "]")).when(key % 6 == 3, text('[{"a":', key, ',"b":[null,{"c":null}],"d":null}]')).when(key % 3 == 1, "[null]")),
        ("alternative", F.when(key % 3 == 0, "null").when(key % 3 == 1, "[]")),
        ("yearOfCopyright", F.when(key % 2 == 0, "[null]")),
        ("issued", F.when(key % 4 == 0, "null").when(key % 4 == 1, text(key)).when(key % 4 == 2, "true").otherwise(text('"', key, '"'))),
        ("creator", F.when(key % 3 == 2, '[{"prefLabel":"","@id":null}]')),
        ("contributor", F.when(key % 3 == 2, "[]")),
        ("fundingProgram", F.when(key % 2 == 0, text("[null,", key, "]"))),
        ("language", F.when(key % 3 == 1, "[null]")),
        ("license", F.when(key % 5 == 0, '[{"other":1}]')),
    )
    records = rows.select(
        F.lit("one").alias("repo"), key.alias("url_pos"), F.lit(0).alias("item_pos"), entry.alias("entry")
    )
    return reshape(records).select(F.col("url_pos").alias("p_partkey"), "entry")


TRUNCATED_SQL = """
SELECT part.* FROM part LEFT JOIN
  (SELECT p_brand, min(p_partkey) AS first_bad FROM part WHERE p_partkey % 60 = 33 GROUP BY 1) bad
  USING (p_brand) WHERE first_bad IS NULL OR p_partkey < first_bad
"""


@query(f"""
SELECT k AS p_partkey, p_brand AS repo, count(*)::BIGINT AS n_datasets
FROM ({FANOUT_SQL}) JOIN ({TRUNCATED_SQL}) kept ON k = kept.p_partkey
WHERE k % 60 <> 33 GROUP BY ALL
""".replace("p_brand AS repo", "kept.p_brand AS repo"))
def reshape_truncate(spark, sf_dir):
    # One record in sixty cannot be reshaped.
    key = F.col("p_partkey")
    records = fanout_records(spark, sf_dir, repaired=key % 60 != 33)
    # A constant that JSON doesn't know, in a field that nobody reads.
    marked = text('{"extra":NaN,', F.substring("entry", 2, F.length("entry")))
    records = records.withColumn("entry", F.when(key % 9 == 1, marked).otherwise(F.col("entry")))
    done = reshape(records, "truncate")
    return done.groupBy(F.col("url_pos").alias("p_partkey"), "repo").agg(
        F.count(F.lit(1)).alias("n_datasets")
    )
