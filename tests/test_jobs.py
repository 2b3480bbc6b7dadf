import pytest
from pyspark.sql import functions as F

from kinweave.operators import golden, groups, metrics, provider
from kinweave.operators.mapping import sink_struct
from kinweave.operators.model import pair_features, train_matcher
from kinweave.plans.load import load
from kinweave.plans.resolve import Model, Provider, choose_technique, resolve
from kinweave.plans.rules import Exact, Fuzzy, Rule, rule_pairs
from kinweave.session import cut
from kinweave.sinks.merge import KeyedTable, merge_rows
from workload.person import ATTRIBUTES, RULES, normalized_person, person


@pytest.fixture(scope="module")
def resolved(spark):
    return resolve(person(spark, "/root/testdata/sf0.001"), ATTRIBUTES, "id", RULES)


def test_every_record_comes_out_once(resolved):
    ids = [r.sourceId for r in resolved.records.select("sourceId").collect()]
    assert len(ids) == len(set(ids)) == 300


def test_match_id_is_the_smallest_of_its_group(resolved):
    by_group = resolved.records.groupBy("matchId").agg(F.min("sourceId").alias("low"))
    assert by_group.where("low <> matchId").isEmpty()


def test_known_pairs_are_found_and_no_others(resolved):
    labelled = resolved.records.select("matchId", F.substring("sourceId", 2, 12).alias("truth"))
    q = metrics.match_quality(labelled, "matchId", "truth").first()
    assert q.precision == 1.0 and 0.9 < q.recall < 1.0


def test_unmatched_records_have_null_match_columns(resolved):
    alone = resolved.records.where("matchType is null")
    assert alone.count() == resolved.unmatched.count() > 0
    assert alone.where("matchId <> sourceId or confidenceScore is not null or ruleId is not null").isEmpty()


def test_stats(resolved):
    s = resolved.stats.first()
    assert s.input_records == 300 and s.matched_records == 300 - resolved.unmatched.count()


def test_dry_run_matches_nothing(spark):
    plan = resolve(person(spark, "/root/testdata/sf0.001"), ATTRIBUTES, "id", RULES, dry_run=True)
    assert plan.records is None and plan.technique == "rule" and "email" in plan.normalized.columns


def test_rows_without_a_required_value_are_rejected(spark):
    df = spark.sql("select * from values ('1', 'a@b.c'), (null, 'a@b.c'), ('2', 'A@b.c') t(id, email)")
    fields = [a for a in ATTRIBUTES if a.name in ("id", "email")]
    out = resolve(df, fields, "id")
    assert out.rejected.count() == 1
    assert {r.sourceId: r.matchId for r in out.records.collect()} == {"1": "1", "2": "1"}


def test_technique_order():
    rule, p, m = [RULES[0]], object(), object()
    assert choose_technique(None, rule, m, p) == "provider"
    assert choose_technique(None, rule, m, None) == "rule"
    assert choose_technique(None, None, m, None) == "model"
    assert choose_technique(None, None, None, None) == "rule"
    with pytest.raises(ValueError):
        choose_technique("model", rule, None, None)
    with pytest.raises(ValueError):
        choose_technique("magic", rule, None, None)


def test_provider_technique(spark):
    df = spark.sql("select * from values ('1', 'a@b.c'), ('2', 'A@b.c'), ('3', null), ('4', null) t(id, email)")
    fields = [a for a in ATTRIBUTES if a.name in ("id", "email")]
    reference = spark.sql("select 'P1' as provider_id, 'a@b.c' as e").select(
        "provider_id", provider.key_digest(F.col("e")).alias("key_hash"))
    out = resolve(df, fields, "id", provider=Provider(reference, "email"))
    assert {r.sourceId: (r.matchId, r.matchType) for r in out.records.collect()} == {
        "1": ("1", "provider"), "2": ("1", "provider"), "3": ("3", None), "4": ("4", None)}


def test_model_finds_the_known_pairs(spark, sf_dir):
    people = cut(normalized_person(spark, sf_dir))
    loose = Rule("loose", (Exact("postal_code"), Fuzzy("first_name", 0.6)))
    pairs = cut(rule_pairs(people, "id", loose))
    fields = ["first_name", "last_name", "address"]
    truth = pairs.where("substr(id_a, 2, 12) = substr(id_b, 2, 12)")
    matcher = train_matcher(pair_features(pairs, people, "id", fields), truth, fields)
    links = resolve(person(spark, sf_dir), ATTRIBUTES, "id", model=Model(matcher, loose, 0.5)).links
    q = metrics.pair_quality(links, truth).first()
    assert q.precision > 0.9 and q.recall > 0.9


def test_golden_record_takes_first_value_by_source(spark):
    df = spark.sql("""select * from values ('m', '1', 'b', 'Ann', null), ('m', '2', 'a', null, 'x'),
        ('m', '3', 'a', 'Anna', 'y'), ('n', '4', 'c', null, null) t(match_id, id, source, name, phone)""")
    got = {r.match_id: (r.name, r.phone, r.n_records) for r in golden.golden_records(df, ["name", "phone"], ["a", "b"]).collect()}
    assert got == {"m": ("Anna", "x", 3), "n": (None, None, 1)}
    assert golden.golden_records(df, ["name"], ["a"], mode="NONE") is df
    with pytest.raises(ValueError):
        golden.golden_records(df, ["name"], ["a"], mode="BEST")


def test_id_mapping_is_linear(spark):
    df = spark.range(0, 1000).selectExpr("cast(id as string) as id", "if(id < 500, 'x', 'y') as ns", "'m' as match_id")
    assert groups.id_mapping(df, "ns", "id", "match_id").count() == 1000


def test_alarm_needs_data(spark):
    df = spark.sql("""select * from values (timestamp'2024-01-01 00:00:10', 'error', 50.0),
        (timestamp'2024-01-01 00:02:10', 'ok', 45.0) t(ts, kind, secs)""")
    assert metrics.error_alarm(df, "ts", F.col("kind") == "error").count() == 1
    assert metrics.duration_alarm(df, "ts", F.col("secs"), metrics.duration_limit_ms(60) / 1000).count() == 1
    assert metrics.duration_limit_ms(61) == 45000


# --- merge and load ----------------------------------------------------------------------

T0, T1 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def target_of(spark, tmp_path, rows="('1', 'a'), ('2', 'b')"):
    table = KeyedTable(spark, str(tmp_path / "t"), "ID")
    table.write(spark.sql(f"select *, timestamp_ntz'{T0}' as LAST_UPDATED from values {rows} t(ID, NAME)"))
    return table


def rows(df):
    return sorted((r.ID, r.NAME, str(r.LAST_UPDATED)) for r in df.collect())


def test_merge(spark, tmp_path):
    table = target_of(spark, tmp_path)
    source = spark.sql("select * from values ('2', cast(null as string)), ('3', 'c'), (null, 'x') t(ID, NAME)")
    counts = table.merge(source, T1)
    assert counts == {"inserted": 1, "updated": 1, "rejected": 1, "superseded": 0, "total": 3}
    assert rows(table.read()) == [("1", "a", T0), ("2", None, T1), ("3", "c", T1)]
    changed = {(r.action, r.ID) for r in table.changes(1, 2).collect()}
    assert changed == {("UPDATE", "2"), ("INSERT", "3")}


def test_repeating_a_merge_changes_nothing(spark, tmp_path):
    table = target_of(spark, tmp_path)
    source = spark.sql("select * from values ('2', 'z'), ('3', 'c') t(ID, NAME)")
    table.merge(source, T1, version=2)
    once = rows(table.read())
    table.merge(source, T1, version=2)
    assert rows(table.read()) == once and table.versions() == [1, 2]
    table.merge(source, T1)
    assert rows(table.read()) == once and table.changes(2, 3).isEmpty()


def test_repeated_source_key(spark, tmp_path):
    table = target_of(spark, tmp_path)
    source = spark.sql("select * from values ('2', 'x', 1), ('2', 'y', 2) t(ID, NAME, seq)")
    with pytest.raises(Exception, match="repeats ID 2"):
        table.merge(source, T1)
    assert table.versions() == [1]
    table.merge(source, T1, order_by="seq")
    assert ("2", "y", T1) in rows(table.read())


def test_merge_does_not_shuffle_the_target(spark, tmp_path):
    table = target_of(spark, tmp_path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = spark.sql("select * from values ('2', 'x') t(ID, NAME)")
        merged = merge_rows(table.read(), source, "ID", T1)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        table.merge(source, T1)
        assert "Exchange" not in table.changes(1, 2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_new_session_table_finds_the_versions(spark, tmp_path):
    table = target_of(spark, tmp_path)
    table.read()
    spark.sql(f"drop table {table._table_name(table._manifest(1))}")
    assert rows(KeyedTable(spark, str(tmp_path / "t"), "ID").read()) == [("1", "a", T0), ("2", "b", T0)]


def test_deleted_rows_are_in_the_feed(spark, tmp_path):
    table = target_of(spark, tmp_path)
    table.write(table.read().where("ID = '1'"))
    assert [(r.action, r.ID) for r in table.changes(1, 2).collect()] == [("DELETE", "2")]


def test_load_results(spark, tmp_path):
    table = target_of(spark, tmp_path)
    source = spark.sql("select * from values ('2', 'x'), (null, 'y') t(ID, NAME)")
    assert load(None, table).status == "skipped"
    assert load(source, table, dry_run=True).loaded == 0 and table.versions() == [1]
    result = load(source, table, as_of=T1)
    assert (result.status, result.processed, result.loaded, result.failed) == ("partial", 2, 1, 1)
    twice = spark.sql("select * from values ('2', 'x'), ('2', 'y') t(ID, NAME)")
    assert load(twice, table, as_of=T1, on_error="continue").status == "error"
    with pytest.raises(Exception):
        load(twice, table, as_of=T1)
    with pytest.raises(ValueError):
        load(source, table, mode="upsert")


def test_sink_struct_of_the_person(spark):
    names = sink_struct(ATTRIBUTES).fieldNames()
    assert names[0] == "ID" and names[-3:] == ["MATCH_ID", "MATCH_SCORE", "LAST_UPDATED"] and names.count("ID") == 1


def test_threshold_applies_to_pairs(spark):
    df = spark.sql("select * from values ('1', 'mary'), ('2', 'marye'), ('3', 'zoe'), ('4', 'zoe') t(id, first_name)")
    fields = [a for a in ATTRIBUTES if a.name in ("id", "first_name")]
    rules = [Rule("r", (Fuzzy("first_name", 0.7),))]
    low = resolve(df, fields, "id", rules)
    high = resolve(df, fields, "id", rules, threshold=0.9)
    assert {r.sourceId: r.matchId for r in low.records.collect()} == {"1": "1", "2": "1", "3": "3", "4": "3"}
    assert {r.sourceId: r.matchId for r in high.records.collect()} == {"1": "1", "2": "2", "3": "3", "4": "3"}


def test_whole_job_on_the_newest_batch(spark, tmp_path, sf_dir):
    from kinweave.plans.pipeline import run_pipeline

    people = person(spark, sf_dir)
    people.where("source = 'web'").write.parquet(str(tmp_path / "in" / "20240101"))
    people.where("source = 'crm'").write.parquet(str(tmp_path / "in" / "20240201"))
    target = KeyedTable(spark, str(tmp_path / "t"), "ID")
    options = dict(output=str(tmp_path / "out"), run="r1", newest_batch=".parquet")
    dry = run_pipeline(spark, str(tmp_path / "in"), ATTRIBUTES, target, RULES, T0, dry_run=True, **options)
    assert dry.loaded.status == "skipped" and target.read() is None
    done = run_pipeline(spark, str(tmp_path / "in"), ATTRIBUTES, target, RULES, T0, **options)
    assert done.loaded.inserted == 150 == target.read().where("ID like 'A%'").count()
    none = run_pipeline(spark, str(tmp_path / "in"), ATTRIBUTES, target, RULES, T0, newest_batch=".orc")
    assert none.resolved is None and none.loaded.loaded == 0


def test_null_order_values_lose_no_update(spark, tmp_path):
    table = target_of(spark, tmp_path)
    source = spark.sql("select * from values ('1', 'x', null), ('3', 'c', null), ('3', 'd', 1), ('2', 'y', 2), (null, 'z', 1) t(ID, NAME, seq)")
    counts = table.merge(source, T1, order_by="seq")
    assert rows(table.read()) == [("1", "x", T1), ("2", "y", T1), ("3", "d", T1)]
    assert counts == {"inserted": 1, "updated": 2, "rejected": 1, "superseded": 1, "total": 5}


def test_one_file_per_bucket(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "b"), "id", buckets=4)
    table.write(spark.range(0, 10_000, 1, 16))
    assert len(list((tmp_path / "b").rglob("*.parquet"))) == 4


def files_of(folder):
    return {str(p) for p in folder.rglob("*.parquet")}


def test_a_merge_rewrites_the_buckets_it_touches(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "ID", buckets=64)
    stamped = "timestamp_ntz'2024-01-01 00:00:00' as LAST_UPDATED"
    table.write(spark.range(0, 20_000, 1, 8).selectExpr("id as ID", "concat('n', id) as NAME", stamped))
    before = files_of(tmp_path / "t")
    assert len(before) == 64
    source = spark.range(19_995, 20_005).selectExpr("cast(id as int) as ID", "'x' as NAME")
    assert table.merge(source, T1) == {"inserted": 5, "updated": 5, "rejected": 0, "superseded": 0, "total": 10}
    added = files_of(tmp_path / "t") - before
    assert 0 < len(added) <= 10
    assert table.read().count() == 20_005 and table.read().where("NAME = 'x'").count() == 10
    # The feed reads the new files only, and without a join.
    feed = table.changes(1, 2)
    assert {str(f).removeprefix("file://") for f in feed.inputFiles()} == added
    assert "Join" not in feed._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.action, r.ID) for r in feed.collect()) == [
        *[("INSERT", i) for i in range(20_000, 20_005)], *[("UPDATE", i) for i in range(19_995, 20_000)]]
    # Two versions further, only buckets that differ are compared.
    table.merge(spark.range(3, 4).selectExpr("id as ID", "'y' as NAME"), T1)
    both = table.changes(1, 3)
    assert both.count() == 11 and len(both.inputFiles()) <= 22
    assert table.prune(1) == [1, 2] and len(files_of(tmp_path / "t")) == 64
    assert table.read().where("NAME in ('x', 'y')").count() == 11


def test_lookup_reads_the_buckets_of_its_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "ID", buckets=32)
    table.write(spark.range(0, 5000).selectExpr("cast(id as string) as ID", "id * 2 as v"))
    keys = spark.createDataFrame([("17",), ("4711",), ("none",), (None,)], "ID string")
    found = table.lookup(keys, ["ID", "v"])
    assert sorted(map(tuple, found.collect())) == [("17", 34), ("4711", 9422)]
    assert len(found.select("v").inputFiles()) <= 3 + len(keys.inputFiles())


def test_a_merge_of_nothing_changes_nothing(spark, tmp_path):
    table = target_of(spark, tmp_path)
    nothing = spark.createDataFrame([], "ID string, NAME string")
    assert table.merge(nothing, T1)["total"] == 0
    only_null = spark.createDataFrame([(None, "x")], "ID string, NAME string")
    assert table.merge(only_null, T1) == {"inserted": 0, "updated": 0, "rejected": 1, "superseded": 0, "total": 1}
    assert rows(table.read()) == rows(table.read(1)) and table.changes(1, 3).isEmpty()
    with pytest.raises(ValueError):
        table.write(spark.range(1).selectExpr("'1' as ID", "1 as kw_bucket"))


def test_a_rewritten_version_is_compared_not_read(spark, tmp_path):
    table = target_of(spark, tmp_path)
    table.merge(spark.createDataFrame([("2", "x")], "ID string, NAME string"), T1, version=2)
    table.merge(spark.createDataFrame([("3", "c")], "ID string, NAME string"), T1, version=3)
    table.merge(spark.createDataFrame([("1", "z")], "ID string, NAME string"), T1, version=2)
    assert sorted((r.action, r.ID) for r in table.changes(2, 3).collect()) == [("INSERT", "3"), ("UPDATE", "1"), ("UPDATE", "2")]


def test_old_versions_are_pruned(spark, tmp_path):
    table = target_of(spark, tmp_path)
    for name in "xyz":
        table.merge(spark.createDataFrame([("2", name)], "ID string, NAME string"), T1)
    assert table.prune(2) == [1, 2] and table.versions() == [3, 4]
    assert ("2", "z", T1) in rows(table.read()) and table.prune(2) == []


# --- matching without labels --------------------------------------------------------------


def test_weights_without_labels_find_the_known_pairs(spark):
    from workload.queries import EM_LEAST, _agreement
    from kinweave.operators import agreement, model

    features, early = _agreement(spark, "/root/testdata/sf0.01")
    fitted = agreement.fit_agreement(agreement.agreement_patterns(features, EM_LEAST), EM_LEAST)
    assert fitted.converged and early.rounds == 6 and not early.converged
    for field, (agree, differ) in fitted.weights().items():
        assert agree > 0 > differ, field
    found = {(r.id_a, r.id_b) for r in model.model_links(features, fitted, 0.9).collect()}
    pairs = [(r.id_a, r.id_b) for r in features.collect()]
    known = {p for p in pairs if p[0][1:] == p[1][1:]}
    hits = len(found & known)
    assert hits / len(found) > 0.95 and hits / len(known) > 0.9 and len(known) < len(pairs)


def test_weights_of_known_probabilities(spark):
    """Pairs drawn from given probabilities: they are found again."""
    import random

    from kinweave.operators.agreement import AgreementModel, fit_agreement

    rng, rows = random.Random(1), []
    true_m, true_u = (0.95, 0.8, 0.9), (0.05, 0.2, 0.01)
    for _ in range(40_000):
        p = true_m if rng.random() < 0.3 else true_u
        rows.append(tuple(None if rng.random() < 0.1 else int(rng.random() < x) for x in p))
    patterns = spark.createDataFrame(rows, "a int, b int, c int").groupBy("a", "b", "c").count().withColumnRenamed("count", "pairs")
    fitted = fit_agreement(patterns, {"a": 0.5, "b": 0.5, "c": 0.5}, rounds=500)
    assert isinstance(fitted, AgreementModel) and fitted.converged and abs(fitted.share - 0.3) < 0.02
    assert all(abs(x - y) < 0.03 for x, y in zip((*fitted.m, *fitted.u), (*true_m, *true_u)))
    with pytest.raises(ValueError):
        fit_agreement(patterns.where("false"), {"a": 0.5, "b": 0.5, "c": 0.5})


def test_a_field_that_always_agrees_has_a_finite_weight(spark):
    from kinweave.operators.agreement import fit_agreement

    patterns = spark.createDataFrame([(1, 1, 5), (1, 0, 5), (1, None, 3)], "a int, b int, pairs long")
    weights = fit_agreement(patterns, {"a": 0.5, "b": 0.5}).weights()
    assert all(abs(w) < 25 for pair in weights.values() for w in pair)


def test_resolve_takes_a_model_without_labels(spark, sf_dir):
    from workload.queries import EM_LEAST, _agreement

    _, fitted = _agreement(spark, sf_dir)
    loose = Rule("loose", (Exact("postal_code"), Fuzzy("first_name", 0.6)))
    done = resolve(person(spark, sf_dir), ATTRIBUTES, "id", model=Model(fitted, loose, 0.9))
    assert done.technique == "model" and done.links.count() > 0 and set(EM_LEAST) == set(fitted.fields)


def test_customers_are_dealt_out_before_they_become_people(spark, sf_dir):
    """Else all that is computed of them runs in as many tasks as their one small file has splits."""
    plan = person(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [c_custkey" in plan
