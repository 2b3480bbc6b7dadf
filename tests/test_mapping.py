import datetime as dt

import pytest
from pyspark.sql import functions as F

from kinweave.operators import mapping, quality
from kinweave.plans.rules import default_rules
from kinweave.schema import Attribute, attributes_from, source_struct


@pytest.mark.parametrize("bad", [
    {"name": ""}, {"name": "a", "type": "FACE"}, {"name": "a", "subtype": "NOPE"}, {"name": "a", "storage": "text"},
])
def test_bad_attributes(bad):
    with pytest.raises(ValueError):
        Attribute(**bad)


def test_aliases_and_storage():
    a = attributes_from([{"name": "p", "type": "phone"}, {"attributeName": "d", "attributeType": "DATE"}])
    assert [x.type for x in a] == ["PHONE_NUMBER", "DATE"]
    assert source_struct([Attribute("n", "NUMBER", storage="int")]).simpleString() == "struct<n:int>"
    assert Attribute("tags", storage="array<string>").source_type.simpleString() == "array<string>"


def test_unmapped_fields_get_the_default():
    fields = mapping.mapped_attributes([" id ", "x"], {"id": {"type": "ID", "matchKey": True}}, "NAME")
    assert [(f.name, f.type, f.match_key) for f in fields] == [
        ("id", "PERSON_IDENTIFIER", True), ("x", "NAME", False)]
    assert [r.names for r in default_rules(fields)] == [["id"]]


def test_map_schema_casts_and_nulls(spark):
    df = spark.sql("select 7 as k, '1.5' as a, 'x' as b, '2024-01-02 03:04:05' as c")
    fields = [Attribute("key", "ID"), Attribute("a", "NUMBER"), Attribute("b", "NUMBER"), Attribute("c", "DATE")]
    row = mapping.map_schema(df, fields, {"key": "k"}).first()
    assert tuple(row) == ("7", 1.5, None, dt.datetime(2024, 1, 2, 3, 4, 5))


def test_sink_columns_and_rename(spark):
    df = spark.sql("select '1' as id, 'Ann' as name, 'm-1' as matchId, 0.95 as matchScore")
    fields = [Attribute("id", "ID"), Attribute("name", "NAME"), Attribute("born", "DATE")]
    out = mapping.to_sink(mapping.rename_results(df), fields, "2024-01-01 00:00:00")
    assert out.columns == ["ID", "NAME", "BORN", "MATCH_ID", "MATCH_SCORE", "LAST_UPDATED"]
    assert dict(out.dtypes)["BORN"] == "timestamp_ntz"
    assert tuple(out.first())[:5] == ("1", "Ann", None, "m-1", 0.95)


def test_group_key_needs_all_members(spark):
    df = spark.sql("select * from values ('a', 'b'), ('a', null) t(x, y)")
    assert [r.k for r in df.select(mapping.group_key("x", "y").alias("k")).collect()] == ["a\x1fb", None]


def test_source_fields(spark):
    df = spark.sql("select 1 as id, 'x' as a, 'y' as b")
    assert mapping.with_source_fields(df, ["a", "b"]).columns == ["id", "sourceFields"]
    assert mapping.with_source_fields(df, ["a", "b"], include=False).columns == ["id"]


def test_array_attribute(spark):
    df = spark.sql("select '1' as id, array('A@x.com', 'bad', 'a@X.com') as emails")
    out = mapping.normalize(df, [Attribute("emails", "EMAIL", array=True)], keep=["id"])
    assert out.first().emails == ["a@x.com"]


@pytest.mark.parametrize("path, ok", [
    ("s3://bucket/path/to/file.csv", True), ("bucket/path/to/file.csv", True), ("not-an-s3-uri", False),
    ("http://bucket/path", False), ("https://bucket/path", False), ("ftp://b/p", False), ("s3:/bucket/path", False),
    (None, False),
])
def test_paths(spark, path, ok):
    from pyspark.sql import functions as F

    assert spark.range(1).select(quality.is_object_path(F.lit(path).cast("string")).alias("x")).first().x is ok


def test_required_rows_are_quarantined(spark):
    df = spark.sql("select * from values ('1', 'a'), ('2', ' '), (null, null) t(id, x)")
    fields = [Attribute("id", required=True), Attribute("x", required=True)]
    accepted, rejected = quality.split_required(df, fields)
    assert [r.id for r in accepted.collect()] == ["1"]
    assert sorted(r.missing for r in rejected.collect()) == ["id,x", "x"]


def test_report(spark):
    df = spark.sql("select * from values ('a@b.c'), ('bad'), (' '), (null) t(email)")
    assert tuple(quality.quality_report(df, [Attribute("email", "EMAIL")]).first()) == ("email", 4, 2, 1)


def test_domain(spark):
    df = spark.sql("select * from values ('a'), ('z'), (null) t(x)")
    assert [r.ok for r in df.select(quality.in_domain(df.x, ["a", "b"]).alias("ok")).collect()] == [True, False, False]


def test_a_required_array_needs_an_element(spark):
    df = spark.sql("select * from values ('1', array('a')), ('2', array()), ('3', null) t(id, xs)")
    accepted, rejected = quality.split_required(df, [Attribute("xs", required=True, array=True)])
    assert [r.id for r in accepted.collect()] == ["1"] and rejected.count() == 2


def test_two_empty_values_are_equal(spark):
    from kinweave.functions.values import similarity

    row = spark.sql("select '' as a, '' as b, cast(null as string) as c").select(
        similarity(F.col("a"), F.col("b")).alias("same"), similarity(F.col("a"), F.col("c")).alias("none")).first()
    assert row.same == 1.0 and row.none is None
