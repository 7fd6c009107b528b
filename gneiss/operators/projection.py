"""Search documents: bounded nesting with overflow counts, hierarchy, facets, and the index side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Entries of a nested list.
MAX_TITLES = MAX_IDENTIFIERS = MAX_RELATIONS = 64
MAX_PARENT_CANDIDATES = 16
#: Order of languages and roles of titles, and the rank of other roles.
LANGUAGES = ("zh-hans", "zh-hant", "zh", "en", "und")
ROLE_RANK = {"PRIMARY": 0, "TITLE": 1, "ALIAS": 10}
OTHER_ROLE = 5


def _ranked(value: Column, ranks: dict[str, int], other: int) -> Column:
    pairs = [F.lit(x) for kv in ranks.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[value], F.lit(other))


def bounded(df: DataFrame, key: str, name: str, item: Column, limit: int) -> DataFrame:
    """(key, name, name_overflow): sorted distinct items, cut to the limit, with the number cut."""
    once = df.select(key, item.alias("_item")).distinct()
    # the window's limit is applied before its shuffle too, so a hot key's list is never longer than the limit
    ranked = once.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("_item"))).where(F.col("_r") <= limit)
    lists = ranked.groupBy(key).agg(F.array_sort(F.collect_list("_item")).alias(name))
    sizes = once.groupBy(key).agg(F.greatest(F.count("*") - limit, F.lit(0)).cast("int").alias(f"{name}_overflow"))
    return lists.join(sizes, key)


def titles(fields: DataFrame, limit: int = MAX_TITLES) -> DataFrame:
    """Titles by language rank, language, role rank, lower-cased text, text."""
    language = F.regexp_replace(F.lower(F.coalesce("language", F.lit("und"))), "_", "-")
    ranks = {x: i for i, x in enumerate(LANGUAGES)}
    role = _ranked(F.upper(F.coalesce("role", F.lit("OTHER"))), ROLE_RANK, OTHER_ROLE)
    item = F.struct(_ranked(language, ranks, len(ranks)).alias("r"), language.alias("language"), role.alias("rr"), F.lower("title").alias("low"), F.col("title"), F.col("role"))
    out = bounded(fields, "entity_key", "titles", item, limit)
    return out.withColumn("titles", F.transform("titles", lambda x: F.struct(x["language"].alias("language"), x["role"].alias("role"), x["title"].alias("title"))))


def hierarchy(relations: DataFrame, max_candidates: int = MAX_PARENT_CANDIDATES) -> DataFrame:
    """(child, season, series, overflow): unique parents, the series directly or through the season; several fail closed.

    relations: (child, parent, level) with level SEASON or SERIES."""
    direct = relations.groupBy("child").agg(
        F.when(F.count_distinct(F.when(F.col("level") == "SEASON", F.col("parent"))) == 1, F.min(F.when(F.col("level") == "SEASON", F.col("parent")))).alias("season"),
        F.count_distinct(F.when(F.col("level") == "SERIES", F.col("parent"))).alias("n_series"),
        F.min(F.when(F.col("level") == "SERIES", F.col("parent"))).alias("one_series"),
        F.greatest(F.count_distinct("parent") - max_candidates, F.lit(0)).alias("overflow"),
    )
    upper = direct.select(F.col("child").alias("season"), F.when(F.col("n_series") == 1, F.col("one_series")).alias("through"))
    series = F.when(F.col("overflow") > 0, F.lit(None)).when(F.col("n_series") == 1, F.col("one_series")).when(F.col("n_series") == 0, F.col("through"))
    return direct.join(upper, "season", "left").select("child", F.when(F.col("overflow") == 0, F.col("season")).alias("season"), series.alias("series"), "overflow")


def release_year(explicit: Column, premiered: Column) -> Column:
    """The year that both sources agree on, or the only one; disagreement gives null."""
    return F.when(explicit.isNull(), premiered).when(premiered.isNull() | (explicit == premiered), explicit)


def facets(conditions: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in conditions.items()]))


def documents(entities: DataFrame, parts: list[DataFrame], keys: DataFrame | None = None) -> DataFrame:
    """One nested document for each entity (or for the affected keys only)."""
    rows = entities if keys is None else entities.join(keys, "entity_key", "left_semi")
    for part in parts:
        rows = rows.join(part, "entity_key", "left")
    return rows


def overlay(baseline: DataFrame, upserts: DataFrame, deletes: DataFrame, key: str) -> DataFrame:
    """Baseline with affected documents replaced and removed ones gone."""
    touched = upserts.select(key).unionByName(deletes.select(key)).distinct()
    kept = baseline.join(touched, key, "left_anti")
    return kept.unionByName(upserts.join(deletes.select(key).distinct(), key, "left_anti"))


def reconcile(entities: DataFrame, projected: DataFrame, indexed: DataFrame, key: str) -> DataFrame:
    """One row: the three counts, the keys missing on either step, and whether all agree."""
    sides = [(entities, "e"), (projected, "p"), (indexed, "i")]
    rows = sides[0][0].select(key, F.lit("e").alias("side"))
    for df, name in sides[1:]:
        rows = rows.unionByName(df.select(key, F.lit(name).alias("side")))
    held = rows.groupBy(key).agg(F.collect_set("side").alias("s"))
    has = lambda x: F.array_contains("s", x)
    out = held.agg(
        F.count_if(has("e")).alias("n_entities"),
        F.count_if(has("p")).alias("n_projected"),
        F.count_if(has("i")).alias("n_indexed"),
        F.count_if(has("e") != has("p")).alias("n_unprojected"),
        F.count_if(has("p") != has("i")).alias("n_unindexed"),
    )
    return out.withColumn("reconciled", (F.col("n_unprojected") == 0) & (F.col("n_unindexed") == 0))
