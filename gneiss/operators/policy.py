"""The resolution policy as data: rule, scope and source priority of each predicate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.operators import resolution

#: Sources by priority, first for titles, then for facts.
TITLE_PRIORITY = (
    "imdb-non-commercial-datasets tmdb-research tvmaze-public-api musicbrainz-core-dump wikidata-music-reference openfootball-git "
    "statsbomb-open-data wikidata-json-dump eidr-public-registry madb-public-data europeana-oai-edm"
).split()
FACT_PRIORITY = (
    "musicbrainz-core-dump wikidata-music-reference openfootball-git statsbomb-open-data madb-public-data imdb-non-commercial-datasets "
    "tmdb-research wikidata-json-dump tvmaze-public-api eidr-public-registry europeana-oai-edm"
).split()

#: Identifier namespaces that are resolved.
NAMESPACES = (
    "douban-subject eidr-alternate eidr-content europeana-record imdb-company imdb-name imdb-title madb-agent madb-character madb-work "
    "musicbrainz-artist musicbrainz-label musicbrainz-recording musicbrainz-release musicbrainz-release-group musicbrainz-work "
    "openfootball-competition openfootball-entry openfootball-event openfootball-season openfootball-stage openfootball-team openfootball-venue "
    "statsbomb-competition statsbomb-match statsbomb-player statsbomb-season statsbomb-team statsbomb-venue "
    "isrc iswc thetvdb-series tmdb-movie tmdb-person tmdb-tv tvrage-show tvmaze-show wikidata-item"
)

#: Fixed values: (kind, operator, scope qualifiers, predicates); predicates that are not here are never resolved.
GROUPS = [
    ("FIELD", "SINGLE", "language region titleRole", "title"),
    ("FIELD", "SINGLE", "language region", "original_title"),
    ("FIELD", "SINGLE", "language", "description"),
    ("FIELD", "SINGLE", "", "format status release_year end_year"),
    ("FIELD", "SET_UNION", "vocabulary", "language genre"),
    ("FIELD", "SINGLE", "territory", "premiered ended first_air_date last_air_date"),
    ("FIELD", "SINGLE", "territory precision", "release_date"),
    ("FIELD", "SINGLE", "cut scope", "runtime_minutes"),
    ("FIELD", "SINGLE", "scope", "average_runtime_minutes"),
    (
        "FIELD",
        "KEEP_ALL",
        "",
        "event_date scheduled_start event_status score period_score set_score placement outcome standing match_statistics lineup freeze_frame "
        "publication_time claim_text claim_status correction_reason reporting_status instruction_text",
    ),
    ("FIELD", "SET_UNION", "", "discipline animation_technique objective_text demonstration_kind media_object media_variant"),
    ("FIELD", "SINGLE", "", "round_number release_form animation_tradition"),
    (
        "FIELD",
        "SET_UNION",
        "",
        "contributor country creator data_provider dc_rights digital_object_rights_status edm_rights external_identifier landing_url license_uri "
        "linked_object_rights media_type media_url metadata_license_uri preview_url provider record_url rights_statement temporal",
    ),
    ("FIELD", "SINGLE", "", "episode_count episode_number season_count season_number story_section source_kind learning_level learning_duration step_ordinal music_agent_kind"),
    ("IDENTIFIER", "SET_UNION", "", NAMESPACES),
    (
        "RELATIONSHIP",
        "SET_UNION",
        "category character characters creditId department job order ordering role",
        "archive_footage archive_sound cast_member composed_by credited directed_by director_of_photography film_editor known_for performed_in "
        "production_company produced_by self voice_actor voice_performer production_credit character_appearance credit worked_on written_by",
    ),
    ("RELATIONSHIP", "SINGLE", "episodeNumber ordinal seasonNumber", "part_of part_of_season part_of_series season part_of_competition part_of_sports_season part_of_stage"),
    ("RELATIONSHIP", "SET_UNION", "membershipKind trackPosition", "performance_link recording_of release_membership"),
    ("RELATIONSHIP", "SET_UNION", "", "followed_by follows"),
    ("RELATIONSHIP", "SET_UNION", "characterId department language relationship role sourceMedium wikidataProperty", "adaptation_of participant"),
    ("RELATIONSHIP", "SINGLE", "", "held_at"),
    (
        "RELATIONSHIP",
        "SET_UNION",
        "",
        "related_to has_edition contains_story reports_event reported_by_source makes_claim corrects_claim corrects_story has_module has_lesson "
        "teaches_concept has_objective requires_prerequisite has_procedure_step demonstrates",
    ),
]
#: Predicates with the priority of titles.
TITLES = frozenset("title original_title description".split())
NEVER = "NEVER_RESOLVE"


def rules(spark: SparkSession) -> DataFrame:
    """(kind, predicate, operator, scope, sources): the policy, a table of fixed size."""
    rows = [
        (kind, predicate, operator, scope.split(), TITLE_PRIORITY if kind == "FIELD" and predicate in TITLES else FACT_PRIORITY)
        for kind, operator, scope, predicates in GROUPS
        for predicate in predicates.split()
    ]
    return spark.createDataFrame(rows, "kind string, predicate string, operator string, scope array<string>, sources array<string>")


def with_policy(assertions: DataFrame, policy: DataFrame | None = None) -> DataFrame:
    """assertions (kind, predicate, source, qualifiers_json, ...) with operator, scope_json and source_rank.

    The scope is the rule's qualifiers in order of their names, absent ones as null, values as text. A source that the rule does not list
    has the rank behind all that it lists."""
    policy = rules(assertions.sparkSession) if policy is None else policy
    rows = assertions.join(policy, ["kind", "predicate"], "left")
    said = F.from_json("qualifiers_json", "map<string,string>")
    names = F.sort_array(F.coalesce("scope", F.array().cast("array<string>")))
    scope = F.to_json(F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(said, n))), {"ignoreNullFields": "false"})
    place = F.array_position(F.col("sources"), F.col("source")).cast("int")
    rank = F.when(F.col("sources").isNull(), F.lit(0)).when(place > 0, place - 1).otherwise(F.size("sources"))
    return rows.withColumns({"operator": F.coalesce("operator", F.lit(NEVER)), "scope_json": scope, "source_rank": rank}).drop("scope", "sources")


def resolve(assertions: DataFrame, policy: DataFrame | None = None) -> DataFrame:
    """(entity, kind, predicate, scope_json, value, winner, status) by each predicate's own rule.

    SINGLE gives the value of the best source, SELECTED or CONFLICTED (a conflicted relation has no value); SET_UNION and KEEP_ALL give every value;
    the rest is withheld."""
    rows = with_policy(assertions, policy)
    keys = ["entity", "kind", "predicate", "scope_json"]
    one = resolution.resolve_single(rows.where("operator = 'SINGLE'"), keys, "value")
    value = F.when((F.col("status") == "SELECTED") | (F.col("kind") != "RELATIONSHIP"), F.col("value"))
    one = one.select(*keys, value.alias("value"), "winner", "status")
    many = resolution.resolve_set(rows.where("operator IN ('SET_UNION', 'KEEP_ALL')"), keys, "value").select(*keys, "value", "winner", "status")
    return one.unionByName(many)
