"""Sources: record shards, dumps, TSV, XML, versioned tables. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Record envelope fields.
ENVELOPE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("envelope_key", "run_id", "source_system_id", "source_product_id", "source_namespace_id", "source_record_id", "operation", "batch_id")]
    + [T.StructField(n, T.TimestampType()) for n in ("observed_at", "ingested_at", "valid_from", "valid_to", "expires_at")]
    + [T.StructField("payload", T.StringType()), T.StructField("policy_id", T.StringType())]
)

#: Headers of the title and name datasets.
TSV_HEADERS = {
    "title.basics": "tconst titleType primaryTitle originalTitle isAdult startYear endYear runtimeMinutes genres",
    "title.akas": "titleId ordering title region language types attributes isOriginalTitle",
    "title.episode": "tconst parentTconst seasonNumber episodeNumber",
    "title.crew": "tconst directors writers",
    "title.principals": "tconst ordering nconst category job characters",
    "title.ratings": "tconst averageRating numVotes",
    "name.basics": "nconst primaryName birthYear deathYear primaryProfession knownForTitles",
}

#: Statement of an entity dump: values stay JSON text until a mapper reads them.
ENTITY = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("lastrevid", T.LongType()),
        T.StructField("modified", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StructType([T.StructField("language", T.StringType()), T.StructField("value", T.StringType())]))),
        T.StructField("aliases", T.MapType(T.StringType(), T.ArrayType(T.StructType([T.StructField("language", T.StringType()), T.StructField("value", T.StringType())])))),
        T.StructField("sitelinks", T.MapType(T.StringType(), T.StructType([T.StructField("site", T.StringType()), T.StructField("title", T.StringType())]))),
        T.StructField(
            "claims",
            T.MapType(
                T.StringType(),
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("id", T.StringType()),
                            T.StructField("rank", T.StringType()),
                            T.StructField("mainsnak", T.StructType([T.StructField("snaktype", T.StringType()), T.StructField("datavalue", T.StructType([T.StructField("type", T.StringType()), T.StructField("value", T.StringType())]))])),
                            T.StructField("qualifiers", T.StringType()),
                        ]
                    )
                ),
            ),
        ),
    ]
)


class SourceError(ValueError):
    """Input that the declared schema does not admit."""


def read_envelopes(spark: SparkSession, paths: list[str], expected: int | None = None) -> DataFrame:
    """JSON-lines shards as envelopes. Malformed lines, missing keys and a wrong count are errors."""
    schema = T.StructType([*ENVELOPE.fields, T.StructField("_corrupt", T.StringType())])
    # checks read the text, since a scan of the corrupt column alone is not allowed
    raw = spark.read.text(paths).where(F.trim("value") != "")
    rows = raw.select(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r")).select("r.*")
    needed = F.col("_corrupt").isNotNull() | F.col("envelope_key").isNull() | F.col("source_record_id").isNull() | F.col("operation").isNull()
    found = rows.agg(F.count("*").alias("n"), F.count_if(needed).alias("bad"), F.count_distinct("envelope_key").alias("keys")).first()
    if found["bad"]:
        raise SourceError(f"{found['bad']} malformed envelopes")
    if found["keys"] != found["n"]:
        raise SourceError("envelope keys repeat")
    if expected is not None and found["n"] != expected:
        raise SourceError(f"{found['n']} envelopes, {expected} declared")
    return rows.drop("_corrupt")


def read_entity_dump(spark: SparkSession, path: str) -> DataFrame:
    """An entity dump (one JSON array, one entity a line; plain, gzip or bzip2). Duplicates and empty dumps are errors."""
    line = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace("value", "^﻿", "")), "^\\[", ""), "[,\\]]+$", "")
    raw = spark.read.text(path).select(F.trim(line).alias("value")).where("value <> ''")
    rows = raw.select(F.from_json("value", ENTITY).alias("e"), "value").select("e.*", F.col("value").alias("payload"))
    seen = rows.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_if(F.col("id").isNull()).alias("bad")).first()
    if not seen["n"]:
        raise SourceError("the dump is empty")
    if seen["bad"] or seen["ids"] != seen["n"]:
        raise SourceError(f"{seen['bad']} malformed entities, {seen['n'] - seen['bad'] - seen['ids']} duplicates")
    return rows


def items(entities: DataFrame) -> DataFrame:
    """Item entities with their number."""
    return entities.where(F.col("id").rlike("^Q[1-9][0-9]*$")).withColumn("number", F.substring("id", 2, 20).cast("long"))


def statements(entities: DataFrame) -> DataFrame:
    """(id, property, statement): deprecated ones go; preferred ones alone if there are any."""
    rows = entities.select("id", F.explode("claims").alias("property", "all"))
    live = rows.select("id", "property", F.filter("all", lambda s: s["rank"] != "deprecated").alias("live"))
    preferred = F.filter("live", lambda s: s["rank"] == "preferred")
    best = live.withColumn("best", F.when(F.exists("live", lambda s: s["rank"] == "preferred"), preferred).otherwise(F.col("live")))
    return best.select("id", "property", F.explode("best").alias("statement"))


#: Sites that end like a Wikipedia and are none.
OTHER_WIKIS = ["commonswiki", "incubatorwiki", "mediawiki", "metawiki", "specieswiki", "testwiki", "wikidatawiki"]


def wikipedia_count(sitelinks: str = "sitelinks"):
    """Number of language Wikipedias that link to an entity."""
    return F.size(F.filter(F.map_keys(sitelinks), lambda k: k.rlike("^[a-z0-9_-]+wiki$") & ~k.isin(OTHER_WIKIS)))


def read_tsv(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Headed TSV files without quoting, \\N for null. Other headers, in any of the files, and ragged rows are errors."""
    names = TSV_HEADERS[dataset].split()
    lines = spark.read.text(path)
    raw = lines.select(F.split("value", "\t").alias("c"), F.input_file_name().alias("file"))
    header = F.col("c") == F.array(*[F.lit(n) for n in names])
    heads = raw.where(header).agg(F.count("*").alias("n"), F.count_distinct("file").alias("files")).first()
    if not heads["n"] or heads["n"] != heads["files"] or heads["n"] != len(lines.inputFiles()):
        raise SourceError(f"{dataset}: header drift")
    ragged = raw.where(F.size("c") != len(names)).limit(1).count()
    if ragged:
        raise SourceError(f"{dataset}: malformed row")
    rows = raw.where(F.get("c", F.lit(0)) != names[0])
    return rows.select(*[F.nullif(F.get("c", F.lit(i)), F.lit("\\N")).alias(n) for i, n in enumerate(names)])


def page_records(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """(page, position, id, payload): the objects of JSON array pages, in order. Pages that are no array and objects without an id are errors."""
    rows = pages.select("page", F.from_json(payload, "array<string>").alias("items"))
    if not rows.where("items is null").isEmpty():
        raise SourceError("a page is no JSON array")
    out = rows.select("page", F.posexplode("items").alias("position", "payload")).withColumn("id", F.get_json_object("payload", "$.id"))
    if not out.where("id is null").isEmpty():
        raise SourceError("an object without an id")
    return out.select("page", "position", "id", "payload")


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType) -> DataFrame:
    """XML records by row tag. Document types and entities are refused before parsing."""
    unsafe = spark.read.text(path).where(F.upper("value").rlike("<!(DOCTYPE|ENTITY)")).limit(1).count()
    if unsafe:
        raise SourceError("XML with a document type or entities")
    return spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", "true").schema(schema).load(path)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def padded(df: DataFrame, schema: T.StructType, required: set[str]) -> DataFrame:
    """Missing nullable columns as typed nulls; a missing required column is an error."""
    missing = required - set(df.columns)
    if missing:
        raise SourceError(f"required columns are missing: {sorted(missing)}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
