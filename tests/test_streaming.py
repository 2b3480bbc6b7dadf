import pytest
from pyspark.sql import functions as F

from links import root_of
from kinweave.operators.components import components
from kinweave.operators.groups import best_link
from kinweave.plans.rules import Exact, Rule, all_links
from kinweave.session import cut
from kinweave.sinks.merge import KeyedTable
from kinweave.streaming.arrivals import arrival_job
from kinweave.streaming.files import append_changes, follow_changes, on_arrival, read_changes, stream_files
from kinweave.streaming.incremental import match_batch
from kinweave.streaming.index import SignatureIndex, signatures
from workload.person import CORRECTED_SQL, RULES, normalized_person


def everything_at_once(people):
    groups = components(all_links(people, "id", RULES))
    return {r.id: r.root for r in groups.collect()}


def empty_state(people):
    return people.select(
        "*", F.lit("").alias("match_id"), F.lit(0.0).alias("score"), F.lit("").alias("rule_id")).where("1 = 0")


def apply(people, state, found):
    changed = found.drop("is_new")
    kept = state.select("id", "match_id", "score", "rule_id").join(changed.select("id"), "id", "left_anti")
    return cut(people.join(kept.unionByName(changed), "id"))


@pytest.mark.parametrize("batches", [
    ["source = 'web'", "source = 'crm'"],
    ["id < 'A000000000050'", "id >= 'A000000000050' and id < 'B000000000050'", "id >= 'B000000000050'"],
])
def test_batches_give_the_groups_of_one_run(spark, sf_dir, batches):
    people = cut(normalized_person(spark, sf_dir))
    state = empty_state(people)
    for condition in batches:
        state = apply(people, state, match_batch(people.where(condition), state, "id", RULES))
    got = {r.id: r.match_id for r in state.collect()}
    whole = everything_at_once(people)
    assert got == {i: whole.get(i, i) for i in got} and len(got) == 300


def test_a_new_record_unites_two_groups(spark):
    columns = "id string, first_name string, last_name string, email string, phone string, address string, postal_code string"

    def person(i, email, phone):
        return (i, "ann", "lee", email, phone, "1 a st", None)

    loaded = spark.createDataFrame(
        [(*person(i, e, p), m, 1.0, r) for i, e, p, m, r in [
            ("a", "x", None, "a", "email"), ("b", "x", None, "a", "email"),
            ("c", None, "1", "c", "phone"), ("d", None, "1", "c", "phone"), ("z", None, None, "z", None)]],
        columns + ", match_id string, score double, rule_id string")
    batch = spark.createDataFrame([person("n", "x", "1")], columns)
    got = {r.id: (r.match_id, r.is_new) for r in match_batch(batch, loaded, "id", RULES).collect()}
    assert got == {"n": ("a", True), "c": ("a", False), "d": ("a", False)}
    edges = [("a", "b"), ("c", "d"), ("n", "a"), ("n", "c")]
    assert set(root_of(edges).values()) == {"a"}


def test_files_are_taken_once(spark, tmp_path):
    seen = []
    source, log = str(tmp_path / "in"), str(tmp_path / "log")

    def job(batch, batch_id):
        seen.append((batch_id, sorted(r.id for r in batch.collect())))

    for start in (0, 10):
        spark.range(start, start + 2).write.mode("append").json(source)
        on_arrival(stream_files(spark, source, "id long", "json"), log, job).awaitTermination()
    assert seen == [(0, [0, 1]), (1, [10, 11])]


def indexed(spark, tmp_path, people, buckets=8):
    table = KeyedTable(spark, str(tmp_path / "people"), "id", buckets)
    table.write(empty_state(people).withColumn("LAST_UPDATED", F.lit(None).cast("timestamp_ntz")), 1)
    index = SignatureIndex(spark, str(tmp_path / "index"), "id", RULES, buckets)
    return table, index, arrival_job(table, RULES, str(tmp_path / "feed"), "2024-01-01 00:00:00", index=index, keep=3)


def test_corrected_records_leave_their_groups(spark, tmp_path):
    columns = "id string, first_name string, last_name string, email string, phone string, address string, postal_code string"

    def people(*rows):
        return spark.createDataFrame([(i, "ann", "lee", email, phone, "1 a st", None) for i, email, phone in rows], columns)

    first = people(("a", "x", None), ("b", "x", "1"), ("c", "y", "1"), ("d", "y", None), ("e", "z", None), ("f", None, None))
    table, index, arrive = indexed(spark, tmp_path, first)

    def groups():
        return {r.id: r.match_id for r in table.read().collect()}

    arrive(first, 0)
    assert groups() == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e", "f": "f"}
    second = people(("b", "z", None), ("f", "y", None))
    arrive(second, 1)
    assert groups() == {"a": "a", "b": "b", "c": "c", "d": "c", "e": "b", "f": "c"}
    arrive(second, 1)
    assert groups() == {"a": "a", "b": "b", "c": "c", "d": "c", "e": "b", "f": "c"}
    # The old values of b find nobody any more, its new ones do.
    arrive(people(("g", "x", "1"), ("h", "z", None)), 2)
    assert groups() == {"a": "a", "b": "b", "c": "a", "d": "a", "e": "b", "f": "a", "g": "a", "h": "b"}
    whole = everything_at_once(table.read().select(first.columns))
    assert groups() == {i: whole.get(i, i) for i in groups()}
    changes = {r.id for r in table.changes(3, 4).collect()}
    assert changes == {"c", "d", "f", "g", "h", "a"}


def test_corrections_give_the_scores_of_one_run(spark, tmp_path, sf_dir):
    people = cut(normalized_person(spark, sf_dir))
    corrected = cut(normalized_person(spark, sf_dir, CORRECTED_SQL))
    table, _, arrive = indexed(spark, tmp_path, people)
    arrive(people, 0)
    arrive(corrected.subtract(people), 1)
    links = cut(all_links(corrected, "id", RULES))
    roots = {r.id: r.root for r in components(links).collect()}
    best = {r.id: (r.rule_id, r.score) for r in best_link(links).collect()}
    got = {r.id: (r.match_id, r.rule_id, r.score) for r in table.read().collect()}
    assert got == {i: (roots.get(i, i), *best.get(i, (None, None))) for i in got} and len(got) == 300


def test_a_batch_reads_the_index_and_not_the_fields(spark, tmp_path, sf_dir):
    people = cut(normalized_person(spark, sf_dir))
    table, index, arrive = indexed(spark, tmp_path, people, buckets=64)
    arrive(people, 0)
    batch = cut(people.where("id = 'A000000000007'"))
    sought = cut(signatures(batch, "id", RULES, sought=True))
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    old = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        plan = index.find(sought)._jdf.queryExecution().executedPlan().toString()
        # Only the batch's signatures are dealt out; nothing is exploded, nothing else is read.
        assert plan.count("Exchange") == 1 and "Generate" not in plan and "first_name" not in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    near = cut(index.near(batch))
    assert 0 < near.count() < 20
    rows = table.lookup(near, ["id", "email"])
    assert rows.count() == near.count()
    files = {f for f in rows.select("email").inputFiles() if "/data/" in f}
    assert len(files) <= near.count() < 64


def test_parts_of_the_index_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("kinweave.streaming.index.PARTS", 2)
    index = SignatureIndex(spark, str(tmp_path / "i"), "id", [Rule("r", (Exact("k"),))], 4)

    def entries(*rows):
        made = signatures(spark.createDataFrame([r[:2] for r in rows], "id string, k string"), "id", index.rules)
        live = spark.createDataFrame([(r[0], r[2]) for r in rows], "id string, live boolean")
        return made.join(live, "id")

    for version, rows in enumerate([[("a", "x", True)], [("b", "x", True), ("a", "x", False)], [("c", "y", True)], [("d", "x", True)]], 1):
        index.add(entries(*rows), version)
        index.add(entries(*rows), version)
    assert [len(index._manifest(v)["files"]) for v in index.versions()] == [1, 2, 1, 2]
    batch = spark.createDataFrame([("q", "x")], "id string, k string")
    found = index.find(signatures(batch, "id", index.rules, sought=True))
    assert {r.id for r in found.collect()} == {"b", "d"}
    assert [r.id for r in index.near(batch, 1).collect()] == ["a"]
    assert index.prune(1) == [1, 2, 3] and {r.id for r in index.find(signatures(batch, "id", index.rules, sought=True)).collect()} == {"b", "d"}


def test_a_follower_meets_each_change_once(spark, tmp_path):
    table, feed, log = KeyedTable(spark, str(tmp_path / "t"), "id", 4), str(tmp_path / "feed"), str(tmp_path / "log")
    stamp = "2024-01-01 00:00:00"
    table.write(spark.sql(f"select 1L as id, 'a' as v, timestamp_ntz'{stamp}' as LAST_UPDATED"))
    seen = []

    def follow():
        def take(rows, n):
            seen.extend((r.batch_id, r.action, r.id, r.v) for r in rows.collect())

        stream = follow_changes(spark, feed, table.read().schema, parts_per_batch=1)
        on_arrival(stream, log, take).awaitTermination()

    for n, rows in enumerate(["(1L, 'b'), (2L, 'c')", "(2L, 'd')", "(2L, 'd')"]):
        table.merge(spark.sql(f"select * from values {rows} t(id, v)"), stamp, version=n + 2)
        for _ in range(2):  # a repeated batch
            append_changes(table, n + 1, n + 2, feed, n)
        follow()
        follow()
    assert sorted(seen) == [(0, "INSERT", 2, "c"), (0, "UPDATE", 1, "b"), (1, "UPDATE", 2, "d")]
    assert read_changes(spark, feed).count() == 3
