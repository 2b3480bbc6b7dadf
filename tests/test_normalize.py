import datetime as dt

import pytest
from pyspark.sql import functions as F

from kinweave.functions import normalize as n
from kinweave.functions import values as v


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


CASES = [
    (n.norm_name, "  José  O'Neil-Smith ", "jose oneil smith"),
    (n.norm_name, " .- ", None),
    (n.norm_email, " Ann@Example.COM ", "ann@example.com"),
    (n.norm_email, "ann.example.com", None),
    (n.norm_email, "", None),
    (n.email_user, "Ann@Example.com", "ann"),
    (n.email_domain, "Ann@Example.com", "example.com"),
    (n.norm_phone, "+1 (555) 123-4567", "5551234567"),
    (n.norm_phone, "555-123-4567 ext. 9", "5551234567"),
    (n.norm_phone, "n/a", None),
    (n.phone_country, "+44 20 7946 0000", "44"),
    (n.phone_country, "+15551234567", "1"),
    (n.phone_country, "5551234567", None),
    (n.phone_ext, "555-1234 x77", "77"),
    (n.phone_ext, "555-1234", None),
    (n.norm_address, "12  North Main Street, Apartment 4", "12 n main st apt 4"),
    (n.house_number, "12b Main St", "12b"),
    (n.house_number, "Main St", None),
    (n.street_name, "12 Main Street", "main st"),
    (n.po_box, "P.O. Box 12a", "12A"),
    (n.norm_postal, "sw1a-1aa", "SW1A1AA"),
    (n.norm_postal, "K1A 0B1", "K1A0B1"),
    (n.norm_postal, "12345-6789", "12345"),
    (n.norm_name, "Jose\u0301phine", "josephine"),
    (n.norm_name, "Łukasz Čapek", "lukasz capek"),
    (n.norm_name, "Groß", "gross"),
    (n.norm_postal, " - ", None),
    (n.norm_id, "12-34 ab", "1234AB"),
    (n.norm_number, " 1.5 ", 1.5),
    (n.norm_number, "x", None),
    (n.norm_date, "2024-02-30", None),
    (n.norm_date, "2024-02-03", dt.datetime(2024, 2, 3)),
    (n.norm_url, "HTTPS://Example.COM/A/b/#top", "https://example.com/A/b"),
    (n.blank_to_null, " \t ", None),
    (n.norm_text, " A \n b ", "a b"),
]


@pytest.mark.parametrize("function, value, expected", CASES)
def test_normalizers(spark, function, value, expected):
    assert one(spark, function(F.lit(value))) == expected


def test_normalizers_of_null_are_null(spark):
    row = spark.range(1).select(*[
        f(F.lit(None).cast("string")).isNull().alias(f"c{i}") for i, (f, _, _) in enumerate(CASES)
    ]).first()
    assert all(row)


@pytest.mark.parametrize("name, expected", [
    ("Ann", ("Ann", None, None)), ("Ann Lee", ("Ann", None, "Lee")),
    ("Ann B. C. Lee", ("Ann", "B. C.", "Lee")), ("Lee, Ann B", ("Ann", "B", "Lee")),
])
def test_full_name(spark, name, expected):
    assert tuple(one(spark, n.split_full_name(F.lit(name)))) == expected


def test_date_formats(spark):
    assert one(spark, n.norm_date(F.lit("03/02/2024"), "dd/MM/yyyy")) == dt.datetime(2024, 2, 3)


def test_similarity(spark):
    assert one(spark, v.similarity(F.lit("Mary"), F.lit("Marye"))) == pytest.approx(0.8)
    assert one(spark, v.is_similar(F.lit("mary"), F.lit("marye"), 0.8)) is True
    assert one(spark, v.is_similar(F.lit("mary"), F.lit("maryes"), 0.8)) is False


def test_object_paths(spark):
    assert one(spark, v.bucket_of(F.lit("s3://b/k/f.csv"))) == "b"
    assert one(spark, v.key_of(F.lit("b/k/f.csv"))) == "k/f.csv"
    assert one(spark, v.object_uri(F.lit("b"), F.lit("k"))) == "s3://b/k"


def test_run_id(spark):
    assert one(spark, v.run_id(F.lit("2024-01-02 03:04:05").cast("timestamp"))) == "20240102_030405"
