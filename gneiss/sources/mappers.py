"""Source mappers: records to assertions, as one projection and explode for each dataset."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions import scalars as S
from gneiss.sources.records import SourceError, statements

MAPPERS: dict[str, Callable[[DataFrame], DataFrame]] = {}

#: Predicates of cast and crew categories; others are CREDITED.
PRINCIPALS = {
    "actor": "CAST_MEMBER",
    "actress": "CAST_MEMBER",
    "director": "DIRECTED_BY",
    "writer": "WRITTEN_BY",
    "producer": "PRODUCED_BY",
    "composer": "COMPOSED_BY",
    "cinematographer": "DIRECTOR_OF_PHOTOGRAPHY",
    "editor": "FILM_EDITOR",
    "archive_footage": "ARCHIVE_FOOTAGE",
    "archive_sound": "ARCHIVE_SOUND",
    "self": "SELF",
}


def mapper(product: str):
    def register(f):
        MAPPERS[product] = f
        return f

    return register


def field(predicate: str, value: Column, kind: str = "STRING", **qualifiers: Column) -> Column:
    return _assertion("FIELD", predicate, value, kind, qualifiers)


def identifier(scheme: str, value: Column) -> Column:
    return _assertion("IDENTIFIER", scheme, value, "STRING", {})


def relation(predicate: str | Column, target: Column, **qualifiers: Column) -> Column:
    return _assertion("RELATIONSHIP", predicate, target, "NODE", qualifiers)


def entity_type(value: Column) -> Column:
    return _assertion("ENTITY_TYPE", "entity_type", value, "STRING", {})


def _assertion(family: str, predicate: str | Column, value: Column, kind: str, qualifiers: dict[str, Column]) -> Column:
    name = F.lit(predicate) if isinstance(predicate, str) else predicate
    said = F.to_json(F.struct(*[c.cast("string").alias(k) for k, c in sorted(qualifiers.items())])) if qualifiers else F.lit("{}")
    return F.struct(F.lit(family).alias("family"), S.slug(name).alias("predicate"), F.lit(kind).alias("value_type"), S.blank_to_null(value.cast("string")).alias("value"), said.alias("qualifiers_json"))


def assertions(df: DataFrame, subject: str, items: list[Column], lists: list[Column] = ()) -> DataFrame:
    """(subject, family, predicate, value_type, value, qualifiers_json); values that are null or blank are skipped."""
    every = F.array(*items) if items else F.array()
    for extra in lists:
        every = F.concat(every, F.coalesce(extra, F.array().cast("array<struct<family:string,predicate:string,value_type:string,value:string,qualifiers_json:string>>")))
    rows = df.select(F.col(subject).alias("subject"), F.explode(every).alias("a")).select("subject", "a.*")
    return rows.where("value is not null and subject is not null")


def split(c: str, make: Callable[[Column], Column]) -> Column:
    return F.transform(F.split(F.col(c), ","), make)


def apply(product: str, df: DataFrame) -> DataFrame:
    if product not in MAPPERS:
        raise SourceError(f"no mapper for {product}")
    return MAPPERS[product](df)


@mapper("title.basics")
def _basics(df):
    return assertions(
        df,
        "tconst",
        [
            entity_type(F.col("titleType")),
            field("title", F.col("primaryTitle"), titleRole=F.lit("PRIMARY")),
            field("title", F.col("originalTitle"), titleRole=F.lit("ORIGINAL")),
            field("is_adult", F.when(F.col("isAdult").isin("0", "1"), (F.col("isAdult") == "1").cast("string")), "BOOLEAN"),
            field("release_year", S.year(F.col("startYear")), "DATE"),
            field("end_year", S.year(F.col("endYear")), "DATE"),
            field("runtime_minutes", S.ordinal(F.col("runtimeMinutes")), "INTEGER"),
            identifier("imdb", S.imdb_id(F.col("tconst"))),
        ],
        [split("genres", lambda g: field("genre", g))],
    )


@mapper("title.akas")
def _akas(df):
    return assertions(df, "titleId", [field("title", F.col("title"), titleRole=F.lit("ALIAS"), language=F.col("language"), region=F.col("region"))])


@mapper("title.episode")
def _episode(df):
    season, episode = S.ordinal(F.col("seasonNumber")), S.ordinal(F.col("episodeNumber"))
    return assertions(
        df, "tconst", [field("season_number", season, "INTEGER"), field("episode_number", episode, "INTEGER"), relation("PART_OF_SERIES", F.col("parentTconst"), seasonNumber=season, episodeNumber=episode)]
    )


@mapper("title.crew")
def _crew(df):
    return assertions(df, "tconst", [], [split("directors", lambda n: relation("DIRECTED_BY", n)), split("writers", lambda n: relation("WRITTEN_BY", n))])


@mapper("title.principals")
def _principals(df):
    pairs = [F.lit(x) for kv in PRINCIPALS.items() for x in kv]
    predicate = F.coalesce(F.create_map(*pairs)[F.lower("category")], F.lit("CREDITED"))
    return assertions(df, "tconst", [relation(predicate, F.col("nconst"), category=F.col("category"), job=F.col("job"), character=F.col("characters"), order=F.col("ordering"))])


@mapper("title.ratings")
def _ratings(df):
    return assertions(df, "tconst", [field("rating_average", S.quantity(F.col("averageRating")), "DECIMAL"), field("rating_count", S.quantity(F.col("numVotes")), "INTEGER")])


@mapper("name.basics")
def _names(df):
    return assertions(
        df,
        "nconst",
        [entity_type(F.lit("PERSON")), field("title", F.col("primaryName"), titleRole=F.lit("PRIMARY")), field("birth_year", S.year(F.col("birthYear")), "DATE"), field("death_year", S.year(F.col("deathYear")), "DATE")],
        [split("primaryProfession", lambda p: field("profession", p)), split("knownForTitles", lambda t: relation("KNOWN_FOR", t))],
    )


#: Entity-dump properties by what they become.
PROPERTY_RELATIONS = {
    "P57": "DIRECTED_BY",
    "P58": "WRITTEN_BY",
    "P161": "CAST_MEMBER",
    "P162": "PRODUCED_BY",
    "P344": "DIRECTOR_OF_PHOTOGRAPHY",
    "P1040": "FILM_EDITOR",
    "P725": "VOICE_ACTOR",
    "P272": "PRODUCTION_COMPANY",
    "P179": "PART_OF_SERIES",
    "P361": "PART_OF",
    "P4908": "SEASON",
    "P155": "FOLLOWS",
    "P156": "FOLLOWED_BY",
}
PROPERTY_SETS = {"P364": "language", "P495": "country", "P136": "genre"}
PROPERTY_DATES = {"P577": "release_date", "P580": "premiered", "P582": "ended"}
PROPERTY_NUMBERS = {"P2047": "runtime_minutes", "P1113": "episode_count", "P2437": "season_count"}
PROPERTY_IDS = {"P345": "imdb", "P2704": "eidr", "P4529": "douban"}


def _label(values: str, role: str) -> Column:
    return F.transform(F.map_values(values), lambda v: field("title", v["value"], language=v["language"], titleRole=F.lit(role)))


@mapper("wikidata")
def _wikidata(df):
    """Labels, aliases and best-ranked statements of entities."""
    titles = assertions(df, "id", [identifier("wikidata", S.qid(F.col("id")))], [_label("labels", "PRIMARY"), F.flatten(F.transform(F.map_values("aliases"), lambda vs: F.transform(vs, lambda v: field("title", v["value"], language=v["language"], titleRole=F.lit("ALIAS")))))])
    s = statements(df).withColumn("v", F.col("statement.mainsnak.datavalue.value")).withColumn("rank", F.col("statement.rank")).withColumn("sid", F.col("statement.id"))
    target = F.get_json_object("v", "$.id")
    of = lambda table: F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.col("property")]
    date = S.wikidata_date(F.get_json_object("v", "$.time"), F.get_json_object("v", "$.precision").cast("int"))
    plain = F.regexp_replace(F.col("v"), '^"|"$', "")
    ids = F.when(F.col("property") == "P345", S.imdb_id(plain)).when(F.col("property") == "P2704", S.eidr_id(plain)).otherwise(F.when(plain.rlike("^[0-9]+$"), plain))
    found = F.when(of(PROPERTY_RELATIONS).isNotNull(), relation(of(PROPERTY_RELATIONS), target, rank=F.col("rank"), statementId=F.col("sid")))
    found = found.when(of(PROPERTY_SETS).isNotNull(), _assertion("FIELD", of(PROPERTY_SETS), target, "STRING", {}))
    found = found.when(of(PROPERTY_DATES).isNotNull(), _assertion("FIELD", of(PROPERTY_DATES), date, "DATE", {}))
    found = found.when(of(PROPERTY_NUMBERS).isNotNull(), _assertion("FIELD", of(PROPERTY_NUMBERS), S.quantity(F.get_json_object("v", "$.amount")), "DECIMAL", {}))
    found = found.when(of(PROPERTY_IDS).isNotNull(), _assertion("IDENTIFIER", of(PROPERTY_IDS), ids, "STRING", {}))
    fields = ["family", "predicate", "value_type", "value", "qualifiers_json"]
    # branches differ only in nullability; both sides are brought to the same columns
    rest = s.select(F.col("id").alias("subject"), found.alias("a")).where("a is not null").select("subject", *[F.col(f"a.{c}") for c in fields]).where("value is not null")
    return titles.unionByName(rest)


@mapper("tvmaze")
def _tvmaze(df):
    """Shows from JSON payloads."""
    p = lambda path: F.get_json_object("payload", path)
    return assertions(
        df.withColumn("_id", p("$.id")),
        "_id",
        [
            entity_type(F.lit("SERIES")),
            field("title", p("$.name"), titleRole=F.lit("PRIMARY"), language=p("$.language")),
            field("format", p("$.type")),
            field("language", p("$.language")),
            field("status", p("$.status")),
            field("premiered", S.partial_date(p("$.premiered")), "DATE"),
            field("ended", S.partial_date(p("$.ended")), "DATE"),
            field("runtime_minutes", S.ordinal(p("$.runtime")), "INTEGER"),
            field("average_runtime_minutes", S.ordinal(p("$.averageRuntime")), "INTEGER"),
            identifier("imdb", S.imdb_id(p("$.externals.imdb"))),
            identifier("thetvdb", S.ordinal(p("$.externals.thetvdb"))),
            identifier("tvrage", S.ordinal(p("$.externals.tvrage"))),
        ],
        [F.transform(F.from_json(p("$.genres"), "array<string>"), lambda g: field("genre", g))],
    )


@mapper("musicbrainz")
def _musicbrainz(df):
    p = lambda path: F.get_json_object("payload", path)
    listed = lambda path, make: F.transform(F.from_json(p(path), "array<string>"), make)
    kind = p("$.entityType")
    return assertions(
        df.withColumn("_id", S.mbid(p("$.id"))),
        "_id",
        [entity_type(kind), field("title", p("$.name"), titleRole=F.lit("PRIMARY")), identifier("musicbrainz", S.mbid(p("$.id"))), field("agent_kind", p("$.agentKind"))],
        [
            listed("$.isrcs", lambda v: identifier("isrc", F.when(kind == "recording", S.isrc(v)))),
            listed("$.iswcs", lambda v: identifier("iswc", F.when(kind == "work", S.iswc(v)))),
            listed("$.wikidataQids", lambda v: identifier("wikidata", S.qid(v))),
            F.transform(F.from_json(p("$.relations"), "array<struct<predicate:string,targetId:string>>"), lambda r: relation(r["predicate"], S.mbid(r["targetId"]))),
        ],
    )


def _reference(df):
    """Reference entities of news, learning, sports and animation: labels, plain fields and relations."""
    p = lambda path: F.get_json_object("payload", path)
    plain = ["publicationTime", "reportingStatus", "storySection", "sourceKind", "claimStatus", "claimText", "correctionReason", "learningDuration", "learningLevel", "instructionText", "objectiveText", "stepOrdinal", "demonstrationKind", "eventDate", "status", "placement", "outcome", "releaseForm", "discipline", "round"]
    labels = F.map_entries(F.from_json(p("$.labels"), "map<string,string>"))
    return assertions(
        df.withColumn("_id", p("$.id")),
        "_id",
        [entity_type(p("$.entityTypeHint"))] + [field(_snake(n), p(f"$.{n}")) for n in plain],
        [
            F.transform(labels, lambda e: field("title", e["value"], language=e["key"], titleRole=F.lit("PRIMARY"))),
            F.transform(F.from_json(p("$.animationTechniques"), "array<string>"), lambda v: field("animation_technique", v)),
            F.transform(F.from_json(p("$.relations"), "array<struct<predicate:string,targetId:string>>"), lambda r: relation(r["predicate"], r["targetId"])),
            F.transform(F.from_json(p("$.participants"), "array<struct<id:string,role:string,score:string,outcome:string>>"), lambda r: relation("participant", r["id"], role=r["role"], score=r["score"], outcome=r["outcome"])),
        ],
    )


def _snake(name: str) -> str:
    return "".join("_" + c.lower() if c.isupper() else c for c in name)


for _product in ("news", "learning", "sports", "animation"):
    MAPPERS[_product] = _reference


#: Crew jobs by predicate; others are CREDITED.
JOBS = {"Director": "DIRECTED_BY", "Writer": "WRITTEN_BY", "Screenplay": "WRITTEN_BY", "Producer": "PRODUCED_BY", "Executive Producer": "PRODUCED_BY", "Director of Photography": "DIRECTOR_OF_PHOTOGRAPHY", "Editor": "FILM_EDITOR", "Original Music Composer": "COMPOSED_BY"}


@mapper("tmdb")
def _tmdb(df):
    """Inventory rows and details of films, series and people."""
    p = lambda path: F.get_json_object("payload", path)
    array = lambda path, kind: F.from_json(p(path), f"array<{kind}>")
    either = lambda *paths: F.coalesce(*[S.blank_to_null(p(x)) for x in paths])
    jobs = F.create_map(*[F.lit(x) for kv in JOBS.items() for x in kv])
    image = F.array_distinct(F.array_compact(F.array(*[F.when(p(f"$.{k}_path").isNotNull(), F.struct(F.lit(k).alias("kind"), p(f"$.{k}_path").alias("path"))) for k in ("poster", "backdrop", "profile")])))
    return assertions(
        df.withColumn("_id", p("$.id")),
        "_id",
        [
            field("title", either("$.title", "$.name"), titleRole=F.lit("PRIMARY")),
            field("title", either("$.original_title", "$.original_name"), titleRole=F.lit("ORIGINAL"), language=p("$.original_language")),
            field("description", p("$.overview")),
            field("biography", p("$.biography")),
            field("tagline", p("$.tagline")),
            field("status", p("$.status")),
            field("release_date", S.partial_date(either("$.release_date", "$.first_air_date")), "DATE"),
            field("ended", S.partial_date(p("$.last_air_date")), "DATE"),
            field("birth_date", S.partial_date(p("$.birthday")), "DATE"),
            field("runtime_minutes", S.ordinal(p("$.runtime")), "INTEGER"),
            field("season_count", S.ordinal(p("$.number_of_seasons")), "INTEGER"),
            field("episode_count", S.ordinal(p("$.number_of_episodes")), "INTEGER"),
            field("rating_average", S.quantity(p("$.vote_average")), "DECIMAL"),
            field("rating_count", S.quantity(p("$.vote_count")), "INTEGER"),
            field("popularity", S.quantity(p("$.popularity")), "DECIMAL"),
            identifier("tmdb", p("$.id")),
            identifier("imdb", S.imdb_id(either("$.external_ids.imdb_id", "$.imdb_id"))),
            identifier("wikidata", S.qid(p("$.external_ids.wikidata_id"))),
            identifier("thetvdb", S.ordinal(p("$.external_ids.tvdb_id"))),
        ],
        [
            F.transform(array("$.alternative_titles.titles", "struct<title:string,iso_3166_1:string>"), lambda t: field("title", t["title"], titleRole=F.lit("ALIAS"), region=t["iso_3166_1"])),
            F.transform(array("$.translations.translations", "struct<iso_639_1:string,iso_3166_1:string,data:struct<title:string,name:string>>"), lambda t: field("title", F.coalesce(t["data"]["title"], t["data"]["name"]), titleRole=F.lit("TRANSLATION"), language=t["iso_639_1"], region=t["iso_3166_1"])),
            F.transform(array("$.genres", "struct<name:string>"), lambda g: field("genre", g["name"])),
            F.transform(array("$.production_countries", "struct<iso_3166_1:string>"), lambda c: field("country", c["iso_3166_1"])),
            F.transform(array("$.spoken_languages", "struct<iso_639_1:string>"), lambda c: field("language", c["iso_639_1"])),
            F.transform(image, lambda i: field("image_path", i["path"], imageType=i["kind"])),
            F.transform(array("$.credits.cast", "struct<id:string,character:string,order:string>"), lambda c: relation("CAST_MEMBER", c["id"], character=c["character"], order=c["order"])),
            F.transform(array("$.credits.crew", "struct<id:string,job:string,department:string>"), lambda c: relation(F.coalesce(jobs[c["job"]], F.lit("CREDITED")), c["id"], job=c["job"], department=c["department"])),
            F.transform(array("$.combined_credits.cast", "struct<id:string,character:string>"), lambda c: relation("PERFORMED_IN", c["id"], character=c["character"])),
            F.transform(array("$.combined_credits.crew", "struct<id:string,job:string>"), lambda c: relation("WORKED_ON", c["id"], job=c["job"])),
        ],
    )


@mapper("eidr")
def _eidr(df):
    """Base objects as JSON payloads; only imdb and eidr alternate ids are taken."""
    p = lambda path: F.get_json_object("payload", path)
    array = lambda path, kind: F.from_json(p(path), f"array<{kind}>")
    length = S.duration(p("$.approximateLength"))
    alternate = lambda a: F.when(F.lower(a["domain"]).contains("imdb"), identifier("imdb", S.imdb_id(a["value"]))).when(F.lower(a["domain"]).contains("eidr"), identifier("eidr", S.eidr_id(a["value"])))
    return assertions(
        df.withColumn("_id", S.eidr_id(p("$.id"))),
        "_id",
        [
            entity_type(p("$.referentType")),
            identifier("eidr", S.eidr_id(p("$.id"))),
            field("title", p("$.resourceName.value"), titleRole=F.lit("PRIMARY"), language=p("$.resourceName.lang")),
            field("referent_type", p("$.referentType")),
            field("structural_type", p("$.structuralType")),
            field("release_date", S.partial_date(p("$.releaseDate")), "DATE"),
            field("duration", length, "DURATION"),
            field("duration_text", F.when(length.isNull(), p("$.approximateLength"))),
        ],
        [
            F.transform(array("$.alternateResourceNames", "struct<value:string,lang:string>"), lambda n: field("title", n["value"], titleRole=F.lit("ALIAS"), language=n["lang"])),
            F.transform(array("$.originalLanguages", "string"), lambda v: field("language", v)),
            F.transform(array("$.countriesOfOrigin", "string"), lambda v: field("country", v)),
            F.array_compact(F.transform(array("$.alternateIds", "struct<domain:string,value:string>"), alternate)),
            F.transform(array("$.parents", "struct<kind:string,id:string,ordinal:string>"), lambda r: relation(F.concat(F.lit("PART_OF_"), F.upper(r["kind"])), S.eidr_id(r["id"]), ordinal=r["ordinal"])),
        ],
    )


@mapper("europeana")
def _europeana(df):
    """Aggregated records: titles, agents, typed links, metadata licence and object rights."""
    p = lambda path: F.get_json_object("payload", path)
    listed = lambda path: F.from_json(p(path), "array<string>")
    plain = {"subject": "subjects", "spatial": "places", "temporal": "periods", "type": "types", "format": "formats", "medium": "media", "provider": "providers"}
    return assertions(
        df.withColumn("_id", p("$.id")),
        "_id",
        [entity_type(p("$.type")), field("metadata_licence", p("$.metadataRights"), scope=F.lit("METADATA_ONLY")), field("object_rights", S.external_url(p("$.rights"))), field("landing_page", S.external_url(p("$.landingPage")))],
        [
            F.transform(F.map_entries(F.from_json(p("$.titles"), "map<string,string>")), lambda e: field("title", e["value"], language=e["key"], titleRole=F.lit("PRIMARY"))),
            F.transform(F.from_json(p("$.agents"), "array<struct<id:string,label:string,role:string>>"), lambda a: relation("CREDITED", F.coalesce(a["id"], a["label"]), role=a["role"], label=a["label"])),
            *[F.transform(listed(f"$.{path}"), (lambda name: lambda v: field(name, v))(name)) for name, path in plain.items()],
            F.transform(F.from_json(p("$.webResources"), "array<struct<url:string,rights:string>>"), lambda w: field("resource_rights", S.external_url(w["rights"]), resource=w["url"])),
            F.transform(listed("$.sameAs"), lambda u: identifier("imdb", F.when(u.rlike("^https?://www[.]imdb[.]com/"), S.imdb_id(F.regexp_extract(u, "(tt|nm)[0-9]+", 0))))),
        ],
    )
