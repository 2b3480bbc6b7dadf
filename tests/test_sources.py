import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from kinweave.functions.values import decode_record, encode_record
from kinweave.sinks.tables import append_rows, create_target, insert_rows, overwrite_rows
from kinweave.sinks.writers import write_results
from kinweave.sources.batches import latest_batch, latest_folder, read_latest
from kinweave.sources.csv_records import csv_records
from kinweave.sources.readers import (
    read_avro, read_csv_load, read_entities, read_json_array, read_json_lines, read_json_load, read_json_strict,
)
from kinweave.sources.tables import read_table, register_table, sql_source, union_sources

PERSON = "id string, name string, email string"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


DIRTY = 'id,name,email\n1,"Doe, John",j@x.com\n2,NULL,null\n3,,k@x.com\n4,a,b,c,d\n'


def test_csv_continue_keeps_good_rows(spark, tmp_path):
    good, rejects = read_csv_load(spark, put(tmp_path / "d.csv", DIRTY), PERSON, "continue")
    assert sorted(map(tuple, good.collect())) == [
        ("1", "Doe, John", "j@x.com"), ("2", None, None), ("3", None, "k@x.com")]
    assert [r[0] for r in rejects.collect()] == ["4,a,b,c,d"] and rejects.count() == 1


def test_csv_abort_fails_whatever_is_selected(spark, tmp_path):
    rows, rejects = read_csv_load(spark, put(tmp_path / "d.csv", DIRTY), PERSON)
    assert rejects is None
    with pytest.raises(Exception):
        rows.select("id").collect()
    with pytest.raises(ValueError):
        read_csv_load(spark, str(tmp_path), PERSON, "ignore")


def test_csv_dialect_and_default_format(spark, tmp_path):
    path = put(tmp_path / "e.csv", '1,"say \\"hi\\"",x\n')
    for fmt in ("csv", "tsv?"):
        assert tuple(read_entities(spark, path, fmt, PERSON).first()) == ("1", 'say "hi"', "x")


def test_json_array_is_stripped(spark, tmp_path):
    path = put(tmp_path / "a.json", '[\n{"id":"1","name":"Ann"},\n{"id":"2"}\n]')
    assert [r.id for r in read_json_array(spark, path, PERSON).collect()] == ["1", "2"]


def test_json_lines(spark, tmp_path):
    path = put(tmp_path / "l.json", '{"id":"1"}\n{bad\n')
    with pytest.raises(Exception):
        read_json_lines(spark, path, PERSON).collect()
    assert [r.id for r in read_json_lines(spark, path, PERSON, "continue").collect()] == ["1"]


def test_duplicate_json_keys_are_rejected(spark, tmp_path):
    path = put(tmp_path / "k.json", '{"id":"1","id":"2"}\n{"id":"3","name":"Ann"}\n{"id":\n\n')
    good, rejects = read_json_strict(spark, path, PERSON)
    assert [r.id for r in good.collect()] == ["3"]
    assert sorted(r.value for r in rejects.collect()) == ['{"id":', '{"id":"1","id":"2"}']


def test_parquet_and_orc(spark, tmp_path):
    df = spark.sql("select '1' as id, 2.5 as x")
    for fmt in ("parquet", "orc"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        assert read_entities(spark, str(tmp_path / fmt), fmt).first().x == df.first().x


def test_avro_says_what_is_missing(spark, tmp_path):
    with pytest.raises(RuntimeError, match="spark-avro"):
        read_avro(spark, str(tmp_path))


def test_external_table_is_replaced(spark, tmp_path):
    put(tmp_path / "a" / "x.csv", "1,Ann\n")
    put(tmp_path / "b" / "x.json", '{"id":"2","n":3}\n')
    register_table(spark, "ext_t", str(tmp_path / "a"), "id string, name string")
    assert spark.table("ext_t").first().name == "Ann"
    assert register_table(spark, "ext_t", str(tmp_path / "b"), "id string, n int", "json").first().n == 3


def test_latest_batch(spark, tmp_path):
    base = tmp_path / "in"
    put(base / "20230101_000000" / "entity_data.json", '{"id":"1"}\n')
    put(base / "20240101_120000" / "entity_data.json", '{"id":"2"}\n')
    put(base / "20240101_120000" / "more_data.json", '{"id":"3"}\n')
    put(base / "20250101_000000" / "notes.txt", "x")
    put(base / "top.json", "{}\n")
    assert [p.rsplit("/", 1)[1] for p in latest_batch(spark, str(base))] == ["entity_data.json", "more_data.json"]
    assert len(latest_batch(spark, str(base), first_only=True)) == 1
    assert latest_batch(spark, str(base), "nothing") == []
    assert sorted(r.id for r in read_latest(spark, str(base), "json", "id string", "data.json").collect()) == ["2", "3"]
    assert read_latest(spark, str(base), "json", "id string", "nothing") is None


def test_files_directly_in_the_prefix(spark, tmp_path):
    put(tmp_path / "p" / "a.json", '{"id":"1"}\n')
    assert len(latest_batch(spark, str(tmp_path / "p"))) == 1


def test_queries_and_limits(spark):
    df = spark.range(10)
    out = sql_source(spark, "select id from {t} where id > :low", {"low": 6}, t=df)
    assert sorted(r.id for r in out.collect()) == [7, 8, 9]
    df.createOrReplaceTempView("ten")
    assert read_table(spark, "ten").count() == 10 and read_table(spark, "ten", 3).count() == 3


def test_sources_with_different_columns(spark):
    out = union_sources({"a": spark.sql("select 1 as id, 'x' as p"), "b": spark.sql("select 2 as id, 'y' as q")})
    assert sorted((r.id, r.p, r.q, r.source) for r in out.collect()) == [(1, "x", None, "a"), (2, None, "y", "b")]


def test_write_results(spark, tmp_path):
    df = spark.sql("select '1' as id, named_struct('a', 'x', 'b', 2) as sourceFields")
    path = write_results(df, str(tmp_path), "csv", "run")
    assert path.endswith("/output/run")
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["id", "sourceFields_a", "sourceFields_b"]
    with pytest.raises(Exception):
        write_results(df, str(tmp_path), "csv", "run")
    with pytest.raises(ValueError):
        write_results(df, str(tmp_path), "xml", "other")


def test_tables(spark, tmp_path):
    from kinweave.schema import Attribute
    from kinweave.operators.mapping import sink_struct

    schema = sink_struct([Attribute("id"), Attribute("name")])
    create_target(spark, "target_t", schema, str(tmp_path / "t"), replace=True)
    rows = spark.sql("select * from values ('1', 'a'), ('2', 'b') t(ID, NAME)")
    assert append_rows(rows.select("NAME", "ID"), "target_t") == 2
    create_target(spark, "target_t", schema)
    assert insert_rows(rows, "target_t") == 2 and spark.table("target_t").count() == 4
    assert insert_rows(rows.where("1 = 0"), "target_t") == 0
    with pytest.raises(ValueError):
        insert_rows(rows.withColumn("OTHER", F.lit(1)), "target_t")
    assert overwrite_rows(rows.where("ID = '1'"), "target_t") == 1 and spark.table("target_t").count() == 1


def test_record_codec(spark):
    df = spark.sql("select '1' as id, 0.5D as score")
    text = df.select(encode_record("id", "score").alias("x"))
    assert text.first().x == '{"id":"1","score":0.5}'
    assert tuple(text.select(decode_record(F.col("x"), "id string, score double").alias("r")).first().r) == ("1", 0.5)


def test_typed_csv_load(spark, tmp_path):
    text = 'id,n,r,note\n1,NULL,null,"say ""hi"", x"\n2,7,1.5,\nx,7,1.5,a\n3,7,b,a\n4,5\n'
    path = put(tmp_path / "t.csv", text)
    schema = "id int, n int, r double, note string"
    good, rejects = read_csv_load(spark, path, schema, "continue")
    assert sorted(map(tuple, good.collect())) == [(1, None, None, 'say "hi", x'), (2, 7, 1.5, None)]
    assert rejects.count() == 3
    with pytest.raises(Exception, match="malformed"):
        read_csv_load(spark, path, schema)[0].select("note").collect()
    assert read_csv_load(spark, put(tmp_path / "u.csv", "id,n\nNULL,1\n"), "id int, n int")[0].first().id is None


def test_json_load_rejects_wrong_types_and_shapes(spark, tmp_path):
    path = put(tmp_path / "m.json", '{"id":1}\n{"id":"x"}\n3\n[1]\n{"id":\n{"other":2}\n')
    good, rejects = read_json_load(spark, path, "id long", "continue")
    assert sorted([r.id for r in good.collect()], key=str) == [1, None] and rejects.count() == 4
    rows = read_json_load(spark, path, "id long, n long")[0]
    for selected in (rows.select("n"), rows.agg(F.count("*"))):
        with pytest.raises(Exception, match="malformed"):
            selected.collect()


def test_replaced_target_is_empty(spark, tmp_path):
    path = str(tmp_path / "r")
    schema = spark.range(1).schema
    create_target(spark, "replaced_t", schema, path)
    append_rows(spark.range(5), "replaced_t")
    assert create_target(spark, "replaced_t", schema, path, replace=True).count() == 0


def test_a_managed_table_is_not_replaced(spark, tmp_path):
    spark.range(3).write.mode("overwrite").saveAsTable("owned_t")
    with pytest.raises(ValueError, match="external"):
        register_table(spark, "owned_t", str(tmp_path), "id long")
    assert spark.table("owned_t").count() == 3
    spark.sql("drop table owned_t")


def test_json_array_files_grow_in_number_not_in_size(spark, monkeypatch):
    from workload import queries

    number = F.lpad(F.col("id").cast("string"), 12, "0")
    people = spark.range(1, 3501).select(
        F.explode(F.array(F.concat(F.lit("A"), number), F.concat(F.lit("B"), number))).alias("id"),
        F.lit("Ann").alias("first_name"), F.lit("1").alias("postal_code"))
    monkeypatch.setattr(queries, "person", lambda spark, sf_dir: people)
    through, files = queries._through_arrays, []
    monkeypatch.setattr(queries, "_through_arrays", lambda spark, df, schema: files.append(df) or through(spark, df, schema))
    got = sorted(r.id for r in queries.json_array_person(spark, None).collect())
    sizes = [r.n for r in files[0].select(F.size("records").alias("n")).collect()]
    assert max(sizes) == 1000 and len(sizes) == 8
    assert got == sorted(r.id for r in people.collect())


def test_line_breaks_in_quotes(spark, tmp_path):
    text = 'id,note\n1,"line one\nline two"\n2,plain\n3,"a ""b""\n\n,c\n"\n4,5" pipe\n5,"x","y"\n6,z\n'
    good, rejects = read_csv_load(spark, put(tmp_path / "q.csv", text), "id int, note string", "continue")
    assert sorted(map(tuple, good.collect())) == [(1, "line one\nline two"), (2, "plain"), (3, 'a "b"\n\n,c\n'), (4, '5" pipe'), (6, "z")]
    assert [r[0] for r in rejects.collect()] == ['5,"x","y"']
    never = put(tmp_path / "n.csv", 'id,note\n1,a\n2,"open\n3,b\n')
    good, rejects = read_csv_load(spark, never, "id int, note string", "continue")
    assert [r.id for r in good.collect()] == [1] and [r[0] for r in rejects.collect()] == ['2,"open\n3,b']
    with pytest.raises(Exception, match="malformed"):
        read_csv_load(spark, never, "id int, note string")[0].collect()


@pytest.mark.parametrize("bytes_of_split", [64, 333, 1 << 20])
def test_a_split_inside_a_quoted_field_loses_nothing(spark, tmp_path, bytes_of_split):
    rng = random.Random(bytes_of_split)
    rows = [(i, "".join(rng.choice(["a", "b,", "\n", '"', ' "', "\n\n", "long words here "]) for _ in range(rng.randint(0, 30)))) for i in range(90)]

    def file_of(part):
        out = io.StringIO()
        writer = csv.writer(out, quoting=csv.QUOTE_MINIMAL, lineterminator="\n")
        writer.writerow(["id", "note"])
        writer.writerows(part)
        return out.getvalue()

    for n in range(3):
        put(tmp_path / "in" / f"{n}.csv", file_of(rows[n::3]))
    put(tmp_path / "in" / "plain.csv", "id,note\n1000,x\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(bytes_of_split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = sorted(r.value for r in csv_records(spark, str(tmp_path / "in")).collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [file_of([r]).removeprefix("id,note\n").rstrip("\n") if not r[1].endswith("\n") else file_of([r]).removeprefix("id,note\n")[:-1] for r in rows]
    assert got == sorted([*want, "1000,x"])


def test_an_endless_quote_gathers_no_file(spark, tmp_path):
    path = put(tmp_path / "e.csv", "id,note\n" + '1,"open\n' + "".join(f"{i},x\n" for i in range(2, 60)))
    assert csv_records(spark, path, most_lines=50).count() == 59
    assert csv_records(spark, path, most_lines=100).count() == 1


@pytest.mark.parametrize("sign", list("*?[]{}^!,$+("))
def test_a_sign_of_name_patterns_stands_for_itself(spark, tmp_path, sign):
    put(tmp_path / "in" / "1" / f"a{sign}b.json", '{"id":"1"}\n')
    put(tmp_path / "in" / "1" / "axb.json", '{"id":"2"}\n')
    assert [r.id for r in read_latest(spark, str(tmp_path / "in"), "json", "id string", f"a{sign}b").collect()] == ["1"]
    assert [r.id for r in read_latest(spark, str(tmp_path / "in"), "json", "id string", f"/a{sign}").collect()] == ["1"]


def test_the_latest_folder_is_read_by_its_name(spark, tmp_path):
    base = tmp_path / "in"
    put(base / "1" / "a[1].json", '{"id":"1"}\n')
    put(base / "2" / "deep" / "b[1].json", '{"id":"2"}\n')
    put(base / "2" / "_hidden.json", '{"id":"x"}\n')
    put(base / "2" / "c.json", '{"id":"3"}\n')
    put(base / "3" / "notes.txt", "x")
    folder, below = latest_folder(spark, str(base), "[1].json")
    assert folder.endswith("/2") and below
    assert [r.id for r in read_latest(spark, str(base), "json", "id string", "[1].json").collect()] == ["2"]
    assert sorted(r.id for r in read_latest(spark, str(base), "json", "id string", "json").collect()) == ["2", "3"]
    assert [r.id for r in read_latest(spark, str(base), "json", "id string", "deep/").collect()] == ["2"]
    assert latest_folder(spark, str(tmp_path / "none"), "json") is None
