"""Archives that are written to more than once or badly written, and mixes of odd tables."""

import gzip

import corpus_pipeline
from pyspark.sql import functions as F

from kinweave.llm import mixing, warc
from kinweave.session import scratch_path

PAGES = "page_id long, url string, html string"


def keys(spark, folder, **options):
    return sorted(r.k for r in warc.read_warc(spark, folder, **options).select(warc.key_of(F.col("record_id")).alias("k")).collect())


def test_a_second_write_adds_and_an_overwrite_replaces(spark):
    folder = scratch_path(spark, "warc")

    def write(*rows, **options):
        warc.write_warc(warc.archive_records(spark.createDataFrame(list(rows), PAGES)), folder, **options)

    write((1, "u", "a"), (2, "v", "b"))
    write((3, "w", None))
    assert keys(spark, folder) == [1, 2, 3]
    write((4, "x", "d"), overwrite=True)
    assert keys(spark, folder) == [4]
    write(overwrite=False)
    assert keys(spark, folder) == [4]


def test_header_names_in_any_case_and_lengths_that_are_none(spark, tmp_path):
    def record(n, length=None, payload=b"body"):
        length = len(payload) if length is None else length
        return (f"WARC/1.0\r\nwarc-type: response\r\nWARC-RECORD-ID: <urn:kinweave:page:{n}>\r\nX-Own: y\r\n"
                f"content-length: {length}\r\n\r\n").encode() + payload + b"\r\n\r\n"

    for name, pack in (("a.warc", lambda b: b), ("b.warc.gz", gzip.compress)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / name).write_bytes(b"".join(pack(r) for r in (record(1), record(2, "many"), record(3), record(4, "-7"), record(5))))
        rows = warc.read_warc(spark, str(folder)).collect()
        assert sorted(warc_key.record_id for warc_key in rows) == [f"<urn:kinweave:page:{n}>" for n in (1, 3, 5)]
        assert {bytes(r.payload) for r in rows} == {b"body"} and {r.record_type for r in rows} == {"response"}
        assert warc.read_warc(spark, str(folder)).where("record_type = 'response'").count() == 3


def test_keys_that_are_no_numbers(spark):
    rows = [(f"b-{i}", "word " * (i % 9 + 1), "s" if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == 200 and {r.mix.times for r in got} <= {0, 1, 2, 3}
    taken = sum(r.mix.size * r.mix.times for r in got if r.source == "s")
    target = next(r.mix.target for r in got if r.source == "s")
    assert abs(taken - target) <= 9


def test_the_stage_takes_the_answer_of_the_mix(spark, documents, clashing):
    rows = [(i, "some words here", "en", "a" if i % 2 else "b") for i in range(40)]
    plain = corpus_pipeline.source_mixing(spark, documents(rows), "")
    named = clashing(documents(rows)).withColumn("_MIX", F.lit(1)).withColumn("col", F.lit(2))
    stage = corpus_pipeline.source_mixing(spark, named, "")
    assert stage.columns == named.columns
    assert sorted(r.doc_id for r in stage.collect()) == sorted(r.doc_id for r in plain.collect()) and plain.count() > 0
    assert corpus_pipeline.source_mixing(spark, documents([]), "").count() == 0
    nothing = corpus_pipeline.source_mixing(spark, documents([(None, None, None, None)]), "")
    assert nothing.count() <= 3
