"""Sources, mappers and versioned tables on small files."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gneiss.functions import scalars as S
from gneiss.sources import mappers, records, versioned


def _envelope(k, **more):
    return {"envelope_key": k, "run_id": "r", "source_record_id": k, "operation": "UPSERT", "payload": "{}", **more}


def test_envelopes_and_their_errors(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text("\n".join(json.dumps(_envelope(k)) for k in "ab"))
    assert records.read_envelopes(spark, [str(good)], 2).count() == 2
    with pytest.raises(records.SourceError, match="declared"):
        records.read_envelopes(spark, [str(good)], 3)
    bad = tmp_path / "bad.jsonl"
    bad.write_text(json.dumps(_envelope("a")) + "\n{broken\n")
    with pytest.raises(records.SourceError, match="malformed"):
        records.read_envelopes(spark, [str(bad)])


def _entity(i, claims=None, **more):
    return {"id": i, "type": "item", "labels": {"en": {"language": "en", "value": f"Name {i}"}}, "aliases": {}, "sitelinks": {"enwiki": {"site": "enwiki", "title": "x"}, "commonswiki": {"site": "commonswiki", "title": "x"}, "enwikiquote": {"site": "q", "title": "x"}}, "claims": claims or {}, **more}


def _claim(rank, value, kind="wikibase-entityid"):
    return {"id": f"s{rank}", "rank": rank, "mainsnak": {"snaktype": "value", "datavalue": {"type": kind, "value": value}}}


def test_entity_dump_statements_and_mapper(spark, tmp_path):
    claims = {
        "P57": [_claim("preferred", {"id": "Q5"}), _claim("normal", {"id": "Q6"}), _claim("deprecated", {"id": "Q7"})],
        "P577": [_claim("normal", {"time": "+1999-05-00T00:00:00Z", "precision": 10}, "time")],
        "P345": [_claim("normal", "tt0000001", "string"), _claim("normal", "nonsense", "string")],
        "P2047": [_claim("normal", {"amount": "+91", "unit": "1"}, "quantity")],
    }
    dump = tmp_path / "dump.json"
    dump.write_text("[\n" + ",\n".join(json.dumps(e) for e in (_entity("Q1", claims), _entity("Q2"), _entity("P9"))) + "\n]\n", encoding="utf-8")
    rows = records.read_entity_dump(spark, str(dump))
    assert {r["number"] for r in records.items(rows).collect()} == {1, 2}
    assert rows.select(records.wikipedia_count().alias("n")).first()["n"] == 1
    assert {r["statement"]["rank"] for r in records.statements(rows).where("property = 'P57'").collect()} == {"preferred"}
    got = {(r["predicate"], r["value"]) for r in mappers.apply("wikidata", rows).where("subject = 'Q1'").collect()}
    assert got == {("wikidata", "Q1"), ("title", "Name Q1"), ("directed_by", "Q5"), ("release_date", "1999-05"), ("imdb", "tt0000001"), ("runtime_minutes", "91")}
    (tmp_path / "twice.json").write_text("[\n" + ",\n".join(json.dumps(_entity("Q1")) for _ in "ab") + "\n]")
    with pytest.raises(records.SourceError, match="duplicates"):
        records.read_entity_dump(spark, str(tmp_path / "twice.json"))
    (tmp_path / "empty.json").write_text("[\n]\n")
    with pytest.raises(records.SourceError, match="empty"):
        records.read_entity_dump(spark, str(tmp_path / "empty.json"))


def test_tsv_has_no_quotes_and_fixed_headers(spark, tmp_path):
    names = records.TSV_HEADERS["title.episode"].split()
    file = tmp_path / "e.tsv"
    file.write_text("\t".join(names) + '\ntt0000002\ttt0000001\t1\t2\ntt0000003\ttt0000001\t\\N\t"x\n')
    rows = records.read_tsv(spark, str(file), "title.episode")
    assert sorted(tuple(r) for r in rows.collect()) == [("tt0000002", "tt0000001", "1", "2"), ("tt0000003", "tt0000001", None, '"x')]
    got = {(r["subject"], r["predicate"], r["value"]) for r in mappers.apply("title.episode", rows).collect()}
    assert ("tt0000002", "season_number", "1") in got and ("tt0000003", "part_of_series", "tt0000001") in got
    assert not any(s == "tt0000003" and p == "season_number" for s, p, _ in got)
    file.write_text("\t".join(names) + "\na\tb\n")
    with pytest.raises(records.SourceError, match="malformed"):
        records.read_tsv(spark, str(file), "title.episode")
    with pytest.raises(records.SourceError, match="drift"):
        records.read_tsv(spark, str(file), "title.crew")


def test_xml_refuses_document_types(spark, tmp_path):
    file = tmp_path / "r.xml"
    file.write_text('<Records xmlns:m="http://x"><m:R><m:ID>10.5240/AAAA-BBBB-CCCC-DDDD-EEEE-F</m:ID></m:R></Records>')
    schema = T.StructType([T.StructField("ID", T.StringType())])
    assert records.read_xml(spark, str(file), "R", schema).count() == 1 or records.read_xml(spark, str(file), "m:R", schema).count() == 1
    file.write_text('<!DOCTYPE x [<!ENTITY y "z">]><Records/>')
    with pytest.raises(records.SourceError):
        records.read_xml(spark, str(file), "R", schema)


def test_shows_and_recordings(spark):
    show = {"id": 7, "name": "Show", "language": "English", "genres": ["Drama", "Crime"], "premiered": "2001-02-03", "runtime": 0, "externals": {"imdb": "tt1234567", "thetvdb": 5}}
    got = {(r["predicate"], r["value"]) for r in mappers.apply("tvmaze", spark.createDataFrame([(json.dumps(show),)], "payload string")).collect()}
    assert {("title", "Show"), ("genre", "Drama"), ("genre", "Crime"), ("imdb", "tt1234567"), ("premiered", "2001-02-03")} <= got
    assert not any(p == "runtime_minutes" for p, _ in got)
    mbid = "0" * 8 + "-0000-0000-0000-" + "0" * 12
    work = {"id": mbid, "entityType": "work", "name": "W", "iswcs": ["T-123.456.789-0"], "isrcs": ["USRC17607839"], "relations": [{"predicate": "PART_OF_SERIES", "targetId": "bad"}]}
    got = {(r["predicate"], r["value"]) for r in mappers.apply("musicbrainz", spark.createDataFrame([(json.dumps(work),)], "payload string")).collect()}
    assert ("iswc", "T1234567890") in got and not any(p in ("isrc", "part_of_series") for p, _ in got)
    with pytest.raises(records.SourceError):
        mappers.apply("nothing", spark.range(1))


def test_scalars(spark):
    row = spark.range(1).select(
        S.eidr_id(F.lit("doi:10.5240/aaaa-bbbb-cccc-dddd-eeee-f")).alias("eidr"),
        S.partial_date(F.lit("2001-13")).alias("bad_date"),
        S.duration(F.lit("PT1H30M")).alias("duration"),
        S.duration(F.lit("P")).alias("bad_duration"),
        S.slug(F.lit(" PART OF-Series ")).alias("slug"),
        S.external_url(F.lit("ftp://x")).alias("url"),
    ).first()
    assert (row["eidr"], row["bad_date"], row["duration"], row["bad_duration"], row["slug"], row["url"]) == ("10.5240/AAAA-BBBB-CCCC-DDDD-EEEE-F", None, "PT1H30M", None, "part_of_series", None)


def test_versioned_table(spark, tmp_path):
    t = versioned.VersionedTable(spark, str(tmp_path / "t"))
    assert t.read() is None
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert t.merge("r1", a, ["k"])["rows"] == 2
    assert t.merge("r1", a, ["k"])["sequence"] == 1  # an exact retry returns the commit
    assert t.merge("r2", spark.createDataFrame([(2, "x"), (3, "c")], "k int, v string"), ["k"])["rows"] == 1
    assert sorted(r["k"] for r in t.read().collect()) == [1, 2, 3]
    assert sorted(r["k"] for r in t.read(1).collect()) == [1, 2]
    with pytest.raises(ValueError):
        t.merge("r3", spark.createDataFrame([(None, "x")], "k int, v string"), ["k"])
    entry = t.compact("r1", 1)
    assert t.read(1).count() == 2 and sorted(r["k"] for r in t.read().collect()) == [1, 2, 3]
    assert {r["run_id"] for r in t.read().collect()} == {"r1", "r2"}
    assert t.expire() == ["run=r1"] and t.read().count() == 3
    t.commit("r4", spark.createDataFrame([(9, "z")], "k int, v string"))
    t.rollback(entry["sequence"])
    assert t.read().count() == 3 and t.expire() == ["run=r4"]


def test_sinks(spark, tmp_path):
    df = spark.range(20).withColumn("v", F.concat(F.lit("row"), "id"))
    receipts = versioned.write_documents(df, str(tmp_path / "docs"), "id", 3)
    assert receipts.agg(F.sum("n")).first()[0] == 20
    versioned.write_sorted(df, str(tmp_path / "sorted"), "id")
    versioned.write_shards(df.withColumn("s", F.col("id") % 2), str(tmp_path / "shards"), "s", "id", "v", 2)
    assert spark.read.text(str(tmp_path / "shards")).count() == 20
    versioned.write_pages(df, str(tmp_path / "pages"), "id", 6)
    assert [(r["page"], r["n"]) for r in spark.read.text(str(tmp_path / "pages")).groupBy("page").agg(F.count("*").alias("n")).orderBy("page").collect()] == [(0, 6), (1, 6), (2, 6), (3, 2)]
    assert versioned.write_summary(df.withColumn("s", F.col("id") % 2), str(tmp_path / "summary"), "s", "id").agg(F.sum("total")).first()[0] == 190
    groups = df.withColumn("g", (F.col("id") % 3).cast("int"))
    assert versioned.write_in_groups(groups, str(tmp_path / "groups"), "g", {0}) == [0, 1, 2]
    versioned.write_in_groups(groups, str(tmp_path / "groups"), "g", {0})  # once more, as after a crash before the receipt
    assert spark.read.parquet(str(tmp_path / "groups")).groupBy("g").count().count() == 2
    assert spark.read.parquet(str(tmp_path / "groups")).where("g = 0").count() == 0 and spark.read.parquet(str(tmp_path / "groups")).count() == 13
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("new", T.StringType())])
    assert records.padded(df, schema, {"id"}).columns == ["id", "new"]
    with pytest.raises(records.SourceError):
        records.padded(df, schema, {"new"})
    assert records.empty(spark, schema).count() == 0


def test_details_objects_and_records(spark):
    film = {"id": 5, "title": "T", "original_title": "O", "original_language": "fr", "release_date": "2001-02-03", "runtime": 90, "vote_average": 7.5, "poster_path": "/p.jpg", "external_ids": {"imdb_id": "tt1234567"}, "genres": [{"name": "Drama"}], "credits": {"cast": [{"id": 1, "character": "C", "order": 0}], "crew": [{"id": 2, "job": "Director", "department": "D"}, {"id": 3, "job": "Grip", "department": "D"}]}}
    got = {(r["predicate"], r["value"]) for r in mappers.apply("tmdb", spark.createDataFrame([(json.dumps(film),)], "payload string")).collect()}
    assert {("title", "T"), ("title", "O"), ("imdb", "tt1234567"), ("genre", "Drama"), ("cast_member", "1"), ("directed_by", "2"), ("credited", "3"), ("image_path", "/p.jpg"), ("rating_average", "7.5")} <= got
    eidr = "10.5240/AAAA-BBBB-CCCC-DDDD-EEEE-F"
    base = {"id": "doi:" + eidr.lower(), "referentType": "Movie", "resourceName": {"value": "N", "lang": "en"}, "approximateLength": "about 2h", "alternateIds": [{"domain": "imdb.com", "value": "tt7654321"}, {"domain": "other", "value": "x"}], "parents": [{"kind": "Series", "id": eidr, "ordinal": "3"}]}
    got = {(r["subject"], r["predicate"], r["value"]) for r in mappers.apply("eidr", spark.createDataFrame([(json.dumps(base),)], "payload string")).collect()}
    assert {(eidr, "duration_text", "about 2h"), (eidr, "imdb", "tt7654321"), (eidr, "part_of_series", eidr)} <= got and not any(v == "x" for _, _, v in got)
    record = {"id": "/1/a", "type": "VIDEO", "titles": {"en": "A"}, "rights": "http://rights.example/x", "sameAs": ["https://www.imdb.com/title/tt0000009/", "https://elsewhere.example/tt0000008"], "webResources": [{"url": "u", "rights": "http://r.example/1"}]}
    got = {(r["predicate"], r["value"]) for r in mappers.apply("europeana", spark.createDataFrame([(json.dumps(record),)], "payload string")).collect()}
    assert {("title", "A"), ("object_rights", "http://rights.example/x"), ("imdb", "tt0000009"), ("resource_rights", "http://r.example/1")} <= got and ("imdb", "tt0000008") not in got


def test_streamed_files_are_committed_once(spark, tmp_path):
    from gneiss.streaming.ingest import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"k": 1}\n{"k": 2}\n')
    t = versioned.VersionedTable(spark, str(tmp_path / "table"))
    for _ in range(2):
        ingest(spark.readStream.schema("k long").json(str(tmp_path / "in")), t, str(tmp_path / "state")).awaitTermination()
    assert sorted(r["k"] for r in t.read().collect()) == [1, 2]
    (tmp_path / "in" / "b.json").write_text('{"k": 3}\n')
    ingest(spark.readStream.schema("k long").json(str(tmp_path / "in")), t, str(tmp_path / "state")).awaitTermination()
    assert sorted(r["k"] for r in t.read().collect()) == [1, 2, 3]


def test_principals_titles_and_wikis_have_the_fixed_values(spark):
    names = records.TSV_HEADERS["title.principals"].split()
    rows = [("tt1", str(i), "nm1", c, None, None) for i, c in enumerate(["actor", "Actress", "self", "cinematographer", "editor", "archive_sound", "production_designer"])]
    got = {r["predicate"] for r in mappers.apply("title.principals", spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))).collect()}
    assert got == {"cast_member", "self", "director_of_photography", "film_editor", "archive_sound", "credited"}
    assert set(mappers.PROPERTY_RELATIONS) == {"P57", "P58", "P161", "P162", "P344", "P1040", "P725", "P272", "P179", "P361", "P4908", "P155", "P156"}
    sites = ["enwiki", "zh_yuewiki", "sourceswiki", "mediawikiwiki", "mediawiki", "testwiki", "commonswiki", "enwikiquote"]
    df = spark.createDataFrame([({s: ("x", "y") for s in sites},)], "sitelinks map<string,struct<site:string,title:string>>")
    assert df.select(records.wikipedia_count().alias("n")).first()["n"] == 4


def test_every_file_has_the_header(spark, tmp_path):
    names = records.TSV_HEADERS["title.ratings"].split()
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.tsv").write_text("\t".join(names) + "\ntt1\t5\t6\n")
    (tmp_path / "t" / "b.tsv").write_text("\t".join(names) + "\ntt2\t5\t6\n")
    assert records.read_tsv(spark, str(tmp_path / "t"), "title.ratings").count() == 2
    (tmp_path / "t" / "b.tsv").write_text("\t".join(names[::-1]) + "\n6\t5\ttt2\n")
    with pytest.raises(records.SourceError, match="drift"):
        records.read_tsv(spark, str(tmp_path / "t"), "title.ratings")


def test_page_records(spark):
    pages = spark.createDataFrame([(0, '[{"id": 1, "n": "a"}, {"id": 2}]'), (1, "[]")], "page int, payload string")
    assert [(r["page"], r["position"], r["id"]) for r in records.page_records(pages).orderBy("page", "position").collect()] == [(0, 0, "1"), (0, 1, "2")]
    for bad in ("{}", '[{"n": 1}]'):
        with pytest.raises(records.SourceError):
            records.page_records(spark.createDataFrame([(0, bad)], "page int, payload string"))
