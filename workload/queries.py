"""The queries: each takes a session and a folder of tables and gives a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions import normalize as n
from kinweave.functions import values as v
from kinweave.operators import agreement, golden, groups, mapping, metrics, model, provider, quality
from kinweave.operators.components import components
from kinweave.operators.exact import dedup_within, element_links, exact_links, text_digest
from kinweave.operators.topk import top_matches
from kinweave.plans.load import load
from kinweave.plans.pipeline import run_pipeline
from kinweave.plans.resolve import Model, Provider, resolve
from kinweave.plans.rules import Exact, Fuzzy, Rule, all_links, rule_links, rule_pairs
from kinweave.schema import Attribute
from kinweave.session import cut, scratch_path
from kinweave.sinks.merge import KeyedTable
from kinweave.sinks.tables import append_rows, create_target, insert_rows, overwrite_rows
from kinweave.sinks.writers import write_results
from kinweave.sources.batches import read_latest
from kinweave.sources.readers import (
    LOAD_DIALECT, read_csv_load, read_entities, read_json_array, read_json_lines, read_json_load, read_json_strict,
)
from kinweave.sources.tables import read_table, register_table, sql_source, union_sources
from kinweave.streaming.arrivals import arrival_job
from kinweave.streaming.files import append_changes, follow_changes, on_arrival, read_changes, stream_files
from kinweave.streaming.metrics import live_alarms, live_rollup, write_metrics
from workload.person import ATTRIBUTES, CORRECTED_SQL, NAME_ADDRESS, PERSON_SQL, RULES, normalized_person, person

AS_OF = "2024-06-01 00:00:00"
PART_RULE = Rule("part", (Exact("p_brand"), Exact("p_type"), Fuzzy("p_name", 0.8)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


# --- projections, checks, normalizers ---------------------------------------------------

def schema_map_customer(spark, sf_dir):
    fields = mapping.mapped_attributes(
        ["customer_id", "full_name", "balance", "segment", "name_as_number"],
        {
            "customer_id": {"type": "PERSON_IDENTIFIER", "matchKey": True},
            "full_name": {"type": "NAME", "subtype": "FULL_NAME", "matchKey": True},
            "balance": {"type": "NUMBER"}, "name_as_number": {"type": "NUMBER"},
        },
    )
    source = {
        "customer_id": "c_custkey", "full_name": "c_name", "balance": "c_acctbal",
        "segment": "c_mktsegment", "name_as_number": "c_name",
    }
    return mapping.map_schema(table(spark, sf_dir, "customer"), fields, source)


def sink_projection_person(spark, sf_dir):
    flat = person(spark, sf_dir).select(
        "id", "first_name", "email", F.col("id").alias("matchId"), F.lit(0.95).alias("matchScore"),
    )
    fields = [Attribute("id", "ID"), Attribute("first_name", "NAME"), Attribute("email", "EMAIL")]
    out = mapping.to_sink(mapping.rename_results(flat), fields, AS_OF)
    return out.withColumn("LAST_UPDATED", stamp("LAST_UPDATED"))


def source_fields_struct(spark, sf_dir):
    packed = mapping.with_source_fields(person(spark, sf_dir), ["first_name", "last_name", "phone"])
    return packed.select("id", "sourceFields.first_name", "sourceFields.last_name", "sourceFields.phone")


def array_key_match(spark, sf_dir):
    contacts = normalized_person(spark, sf_dir).select("id", F.array("email", "phone").alias("contacts"))
    return element_links(contacts, "id", "contacts")


def group_key_match(spark, sf_dir):
    grouped = [Attribute("last_name", "NAME", group="place"), Attribute("address", "ADDRESS", group="place"),
               Attribute("postal_code", "TEXT", group="place")]
    keyed = mapping.with_group_keys(normalized_person(spark, sf_dir), grouped)
    return exact_links(keyed, "id", ["place"])


def dq_report_person(spark, sf_dir):
    return quality.quality_report(person(spark, sf_dir), [a for a in ATTRIBUTES])


def required_split_person(spark, sf_dir):
    needs = [Attribute("email", "EMAIL", required=True), Attribute("phone", "PHONE", required=True)]
    accepted, rejected = quality.split_required(person(spark, sf_dir), needs)
    return accepted.select("id", F.lit("").alias("missing")).unionByName(rejected.select("id", "missing"))


def domain_check_orders(spark, sf_dir):
    ok = quality.in_domain(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH", "3-MEDIUM"])
    return table(spark, sf_dir, "orders").select("o_orderkey", ok.alias("in_domain"))


def path_check_pages(spark, sf_dir):
    url = F.col("url")
    as_object = F.regexp_replace(url, "^https?://", "s3://")
    bare = F.regexp_replace(url, "^https?://", "")
    return table(spark, sf_dir, "pages").select(
        "page_id", quality.is_object_path(url).alias("url_ok"),
        quality.is_object_path(as_object).alias("object_ok"), quality.is_object_path(bare).alias("bare_ok"),
    )


def uri_parts_pages(spark, sf_dir):
    parts = table(spark, sf_dir, "pages").select(
        "page_id", v.bucket_of(F.col("url")).alias("bucket"), v.key_of(F.col("url")).alias("key"))
    return parts.withColumn("uri", v.object_uri(F.col("bucket"), F.col("key")))


def norm_person_contact(spark, sf_dir):
    return person(spark, sf_dir).select(
        "id", n.norm_name(F.col("first_name")).alias("first_name"),
        n.norm_name(F.col("last_name")).alias("last_name"), n.norm_email(F.col("email")).alias("email"),
        n.email_user(F.col("email")).alias("email_user"), n.email_domain(F.col("email")).alias("email_domain"),
        n.norm_phone(F.concat("phone", F.lit(" ext. 42"))).alias("phone"),
        n.phone_country(F.col("phone")).alias("phone_country"),
        n.phone_ext(F.concat("phone", F.lit(" ext. 42"))).alias("phone_ext"),
        n.blank_to_null(F.col("email")).alias("email_or_null"),
    )


def norm_person_address(spark, sf_dir):
    return person(spark, sf_dir).select(
        "id", n.norm_address(F.col("address")).alias("address"),
        n.house_number(F.col("address")).alias("house_number"),
        n.street_name(F.col("address")).alias("street_name"), n.po_box(F.col("address")).alias("po_box"),
        n.norm_postal(F.concat(F.lit(" "), F.col("postal_code"), F.lit("-12ab"))).alias("postal_code"),
    )


def split_full_name(spark, sf_dir):
    full = F.concat_ws(" ", "first_name", F.lit("Q."), "last_name")
    turned = F.concat("last_name", F.lit(", "), "first_name")
    parts, swapped = n.split_full_name(full), n.split_full_name(turned)
    return person(spark, sf_dir).select(
        "id", parts["first"].alias("first"), parts["middle"].alias("middle"), parts["last"].alias("last"),
        swapped["first"].alias("turned_first"), swapped["middle"].alias("turned_middle"),
        swapped["last"].alias("turned_last"),
    )


def norm_typed(spark, sf_dir):
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(n.norm_date(day, "dd/MM/yyyy"), "yyyy-MM-dd").alias("from_text"),
        n.norm_date(F.col("o_orderpriority")).isNull().alias("no_date"),
        n.norm_number(F.concat(F.lit(" "), F.col("o_totalprice").cast("decimal(18,2)").cast("string"))).alias("number"),
        n.norm_number(F.col("o_orderpriority")).isNull().alias("no_number"),
        n.norm_id(F.col("o_orderpriority")).alias("id_text"),
    )


def norm_url_pages(spark, sf_dir):
    shouted = F.concat(F.regexp_replace("url", "^http", "HTTP"), F.lit("/#part"))
    return table(spark, sf_dir, "pages").select(
        "page_id", n.norm_url(F.col("url")).alias("url"), n.norm_url(shouted).alias("shouted"))


def record_codec_person(spark, sf_dir):
    coded = person(spark, sf_dir).select(v.encode_record("id", "first_name", "postal_code").alias("line"))
    back = coded.select(v.decode_record(F.col("line"), "id string, first_name string, postal_code string").alias("r"))
    return back.select("r.*", v.run_id(F.lit(AS_OF).cast("timestamp")).alias("run"))


# --- matching ----------------------------------------------------------------------------

def _document_keys(spark, sf_dir):
    """Digests of the whole normalized texts; cut, so that the texts are read once."""
    digest = text_digest(n.norm_text(F.col("text"))).alias("digest")
    return cut(table(spark, sf_dir, "documents").select("doc_id", digest), "digests")


def exact_dup_documents(spark, sf_dir):
    return exact_links(_document_keys(spark, sf_dir), "doc_id", ["digest"])


def composite_exact_part(spark, sf_dir):
    return exact_links(table(spark, sf_dir, "part"), "p_partkey", ["p_name", "p_brand", "p_type"])


def fuzzy_part_blocked(spark, sf_dir):
    return rule_pairs(table(spark, sf_dir, "part"), "p_partkey", PART_RULE)


def score_threshold_part(spark, sf_dir):
    strict = Rule("part", (Exact("p_brand"), Fuzzy("p_name", 0.7), Fuzzy("p_type", 0.5)), min_score=0.9)
    return rule_pairs(table(spark, sf_dir, "part"), "p_partkey", strict)


def mixed_rule_person(spark, sf_dir):
    return rule_links(cut(normalized_person(spark, sf_dir), "people"), "id", NAME_ADDRESS)


def all_fuzzy_person(spark, sf_dir):
    rule = Rule("names", (Fuzzy("first_name", 0.8), Fuzzy("last_name", 0.8), Fuzzy("address", 0.7)))
    return rule_links(cut(normalized_person(spark, sf_dir), "people"), "id", rule)


def rules_person(spark, sf_dir):
    return all_links(cut(normalized_person(spark, sf_dir), "people"), "id", RULES)


# Limits under which every signature with a pair is split, and every node is a hub.
SPLIT_ALL = {"split_pairs": 1, "split_gain": 0.0, "worth_splitting": 1}


def rules_person_split(spark, sf_dir):
    return all_links(cut(normalized_person(spark, sf_dir), "people"), "id", RULES, **SPLIT_ALL)


def topk_part_split(spark, sf_dir):
    fields = [Fuzzy("p_name", 0.6), Fuzzy("p_type", 0.5)]
    return top_matches(table(spark, sf_dir, "part"), "p_partkey", ["p_brand"], fields, k=3, **SPLIT_ALL)


def chain_scores_part(spark, sf_dir):
    """The confidence of every part that a rule matched: that of its best pair."""
    rule = Rule("name", (Exact("p_brand"), Exact("p_type"), Fuzzy("p_name", 0.7)))
    links = all_links(table(spark, sf_dir, "part"), "p_partkey", [rule])
    return groups.best_link(links).select("id", "score", "rule_id")


STEP_ALL = {"worth_climbing": 0}


def chain_steps_part(spark, sf_dir):
    """Confidences as above, by falling scores."""
    rule = Rule("name", (Exact("p_brand"), Exact("p_type"), Fuzzy("p_name", 0.7)))
    links = all_links(table(spark, sf_dir, "part"), "p_partkey", [rule], **STEP_ALL)
    return groups.best_link(links).select("id", "score", "rule_id")


def topk_steps_part(spark, sf_dir):
    fields = [Fuzzy("p_name", 0.6), Fuzzy("p_type", 0.5)]
    return top_matches(table(spark, sf_dir, "part"), "p_partkey", ["p_brand"], fields, k=3, **STEP_ALL)


def resolve_array_person(spark, sf_dir):
    """Records that share any of their contacts."""
    people = normalized_person(spark, sf_dir).select("id", F.array("email", "phone").alias("contacts"))
    fields = [Attribute("id", required=True), Attribute("contacts", match_key=True, array=True)]
    return resolve(people, fields, "id").records.select("sourceId", "matchId", "confidenceScore", "ruleId")


def topk_matches_part(spark, sf_dir):
    return top_matches(
        table(spark, sf_dir, "part"), "p_partkey", ["p_brand"], [Fuzzy("p_name", 0.6)], k=3)


def match_groups_documents(spark, sf_dir):
    return components(exact_dup_documents(spark, sf_dir))


def match_groups_hubs(spark, sf_dir):
    return components(exact_dup_documents(spark, sf_dir), hub_degree=1)


def _resolved(spark, sf_dir, **options):
    return resolve(person(spark, sf_dir), ATTRIBUTES, "id", RULES, carry=["source"], **options)


def match_groups_person(spark, sf_dir):
    return _resolved(spark, sf_dir).groups


def match_output_person(spark, sf_dir):
    return _resolved(spark, sf_dir).records.select(
        "sourceId", "matchId", "confidenceScore", "matchType", "ruleId",
        "sourceFields.first_name", "sourceFields.email",
    )


def unmatched_person(spark, sf_dir):
    return _resolved(spark, sf_dir).unmatched.select("id", "last_name")


def unmatched_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return groups.unmatched(docs, "doc_id", match_groups_documents(spark, sf_dir))


def dedup_source_person(spark, sf_dir):
    people = normalized_person(spark, sf_dir).select("source", "id", "first_name", "last_name", "postal_code")
    return dedup_within(people, "id", ["first_name", "last_name", "postal_code"])


def _person_with_group(spark, sf_dir):
    result = _resolved(spark, sf_dir)
    ids = result.records.select(F.col("sourceId").alias("id"), F.col("matchId").alias("match_id"))
    return result.normalized.join(ids, "id")


def id_mapping_person(spark, sf_dir):
    return groups.id_mapping(_person_with_group(spark, sf_dir), "source", "id", "match_id")


def id_graph_person(spark, sf_dir):
    return groups.id_graph(_person_with_group(spark, sf_dir), "source", "id", "match_id")


def provider_match_person(spark, sf_dir):
    people = normalized_person(spark, sf_dir)
    identities = people.where("source = 'crm'").select(
        provider.key_digest(F.col("email")).alias("key_hash"),
        F.concat(F.lit("P-"), F.col("postal_code"), F.lit("-"), F.col("id")).alias("provider_id"),
    )
    return provider.provider_match(people, "id", "email", identities)


ML_FIELDS = ["first_name", "last_name", "address", "email"]


def ml_match_person(spark, sf_dir):
    """Links of a matcher trained on the known pairs, as match records."""
    people = cut(normalized_person(spark, sf_dir))
    loose = Rule("loose", (Exact("postal_code"), Fuzzy("first_name", 0.6)))
    pairs = cut(rule_pairs(people, "id", loose))
    truth = pairs.where(F.substring("id_a", 2, 12) == F.substring("id_b", 2, 12))
    half = pairs.where(F.crc32("id_a") % 2 == 0)  # the other half is what a test measures the links on
    fitted = model.train_matcher(cut(model.pair_features(half, people, "id", ML_FIELDS)), truth, ML_FIELDS)
    matcher = Model(fitted, loose, threshold=0.5)
    return resolve(person(spark, sf_dir), ATTRIBUTES, "id", model=matcher).links


MATCHER = model.Matcher(tuple(ML_FIELDS), (2.0, -0.5, 3.0, -0.5, 2.5, 0.25, 1.5, 0.75), -6.0)


def model_links_person(spark, sf_dir):
    """Links of a matcher with given weights."""
    people = cut(normalized_person(spark, sf_dir))
    pairs = cut(rule_pairs(people, "id", Rule("loose", (Exact("postal_code"), Fuzzy("first_name", 0.6)))))
    return model.model_links(model.pair_features(pairs, people, "id", ML_FIELDS), MATCHER, 0.6)


EM_LEAST = {"last_name": 0.85, "address": 0.8, "email": 0.99, "phone": 0.99}
EM_ROUNDS = 6


def _agreement(spark, sf_dir):
    """Features of loosely similar pairs, and the model that expectation maximisation learns from them without labels."""
    people = cut(normalized_person(spark, sf_dir))
    pairs = cut(rule_pairs(people, "id", Rule("loose", (Exact("postal_code"), Fuzzy("first_name", 0.6)))))
    features = cut(model.pair_features(pairs, people, "id", list(EM_LEAST)))
    return features, agreement.fit_agreement(agreement.agreement_patterns(features, EM_LEAST), EM_LEAST, EM_ROUNDS)


def em_weights_person(spark, sf_dir):
    _, fitted = _agreement(spark, sf_dir)
    rows = [(f, round(m, 6), round(u, 6), round(fitted.share, 6)) for f, m, u in zip(fitted.fields, fitted.m, fitted.u)]
    return spark.createDataFrame(rows, "field string, m double, u double, share double")


def em_links_person(spark, sf_dir):
    return model.model_links(*_agreement(spark, sf_dir), 0.9)


def golden_person(spark, sf_dir):
    fields = ["first_name", "last_name", "email", "phone", "address", "postal_code"]
    return golden.golden_records(_person_with_group(spark, sf_dir), fields, ["web", "crm"])


def job_stats_person(spark, sf_dir):
    return _resolved(spark, sf_dir).stats


def group_sizes_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    found = match_groups_documents(spark, sf_dir).select(F.col("id").alias("doc_id"), "root")
    labelled = docs.join(found, "doc_id", "left").select("doc_id", F.coalesce("root", "doc_id").alias("matchId"))
    return groups.size_distribution(labelled)


def match_quality_person(spark, sf_dir):
    records = _resolved(spark, sf_dir).records
    labelled = records.select("matchId", F.substring("sourceId", 2, 12).alias("truth"))
    return metrics.match_quality(labelled, "matchId", "truth")


# --- loading -----------------------------------------------------------------------------

def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("LAST_UPDATED"),
    )


def _order_changes(spark, sf_dir):
    """Every order again under twice its key: some meet an order, some are new."""
    return table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") * 2).alias("o_orderkey"), "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.round(F.col("o_totalprice") + 1, 2).alias("o_totalprice"), "o_orderpriority",
    )


def _merged_orders(spark, sf_dir) -> tuple[KeyedTable, dict]:
    target = KeyedTable(spark, scratch_path(spark, "orders"), "o_orderkey")
    target.write(_orders(spark, sf_dir))
    return target, target.merge(_order_changes(spark, sf_dir), AS_OF)


def merge_upsert_orders(spark, sf_dir):
    target, _ = _merged_orders(spark, sf_dir)
    return target.read().withColumn("LAST_UPDATED", stamp("LAST_UPDATED"))


def merge_counters_orders(spark, sf_dir):
    target = KeyedTable(spark, scratch_path(spark, "orders"), "o_orderkey")
    target.write(_orders(spark, sf_dir))
    changes = _order_changes(spark, sf_dir)
    no_key = changes.where("o_orderstatus is null").withColumn("o_orderkey", F.lit(None).cast("long"))
    result = load(changes.unionByName(no_key), target, "merge", AS_OF)
    return spark.createDataFrame([result]).select(
        "status", "processed", "loaded", "failed", "inserted", "updated")


def merge_ordered_orders(spark, sf_dir):
    """Repeated keys, the later by `seq` counting; a NULL there comes before any value."""
    target = KeyedTable(spark, scratch_path(spark, "orders"), "o_orderkey")
    target.write(_orders(spark, sf_dir))
    changes = _order_changes(spark, sf_dir)
    first = changes.withColumn("seq", F.when(F.col("o_orderkey") % 3 != 0, 1))
    again = changes.where("o_orderkey % 4 = 0").withColumn("o_totalprice", F.lit(0.5)).withColumn("seq", F.lit(2))
    counts = target.merge(first.unionByName(again), AS_OF, order_by="seq")
    out = target.read().withColumn("LAST_UPDATED", stamp("LAST_UPDATED"))
    return out.select("*", *[F.lit(n).cast("long").alias(k) for k, n in counts.items()])


def change_feed_orders(spark, sf_dir):
    target, _ = _merged_orders(spark, sf_dir)
    return target.changes(1, 2).drop("LAST_UPDATED")


def stream_feed_orders(spark, sf_dir):
    """Three merges, and a consumer that follows their changes, started anew after each."""
    target, feed = KeyedTable(spark, scratch_path(spark, "orders"), "o_orderkey"), scratch_path(spark, "orders-feed")
    target.write(_orders(spark, sf_dir))
    changes, log, taken = cut(_order_changes(spark, sf_dir)), scratch_path(spark, "feed-log"), scratch_path(spark, "taken")
    stream = follow_changes(spark, feed, target.read().schema)
    for part in range(3):
        target.merge(changes.where(F.col("o_orderkey") % 3 == part), AS_OF)
        append_changes(target, part + 1, part + 2, feed, part)
        on_arrival(stream, log, lambda rows, n: rows.write.mode("overwrite").parquet(f"{taken}/n={n}")).awaitTermination()
    return spark.read.parquet(taken).drop("LAST_UPDATED", "batch_id", "n")


def _orders_target(spark, sf_dir, label):
    path = scratch_path(spark, label)
    name = "kinweave_" + path.rsplit("-", 1)[1]
    create_target(spark, name, _orders(spark, sf_dir).drop("LAST_UPDATED").schema, path)
    return name


def append_orders(spark, sf_dir):
    name = _orders_target(spark, sf_dir, "append")
    rows = _orders(spark, sf_dir).drop("LAST_UPDATED")
    counts = [append_rows(rows, name), append_rows(rows.withColumn("o_orderkey", -F.col("o_orderkey")), name)]
    return spark.table(name).withColumn("written", F.lit(sum(counts)).cast("long"))


def insert_orders(spark, sf_dir):
    name = _orders_target(spark, sf_dir, "insert")
    rows = _orders(spark, sf_dir).select("o_totalprice", "o_orderkey")
    written = insert_rows(rows, name)
    return spark.table(name).withColumn("written", F.lit(written).cast("long"))


def overwrite_orders(spark, sf_dir):
    name = _orders_target(spark, sf_dir, "overwrite")
    rows = _orders(spark, sf_dir).drop("LAST_UPDATED")
    append_rows(rows, name)
    overwrite_rows(rows.withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2)), name)
    return spark.table(name)


# --- sources and sinks -------------------------------------------------------------------

def load_counters_csv(spark, sf_dir):
    """Customers as CSV text with NULL tokens, and a row too many fields per automobile one."""
    path = scratch_path(spark, "csv")
    lines = table(spark, sf_dir, "customer").select(F.concat_ws(
        ",", F.col("c_custkey").cast("string"), F.concat(F.lit('"'), F.col("c_name"), F.lit(', Inc"')),
        F.when(F.col("c_mktsegment") == "FURNITURE", "NULL").when(F.col("c_mktsegment") == "MACHINERY", "null")
        .when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("x,y")),
    ).alias("value"))
    # One text column under the header line, so the writer changes nothing in the lines.
    lines.select(F.col("value").alias("id,name,segment")).write.option("header", True).option(
        "quote", "").option("sep", "\x01").csv(path)
    good, rejects = read_csv_load(spark, path, "id string, name string, segment string", "continue")
    name = "kinweave_" + path.rsplit("-", 1)[1]
    create_target(spark, name, good.schema, scratch_path(spark, "csv-target"))
    result = load(good, name, "append", on_error="continue", rejects=rejects)
    loaded = spark.table(name)
    counts = loaded.agg(
        F.count_if(F.col("segment").isNull()).alias("null_segments"),
        F.count_if(F.col("name").endswith(", Inc")).alias("quoted_names"),
    )
    return counts.select(
        F.lit(result.status).alias("status"), F.lit(result.processed).cast("long").alias("processed"),
        F.lit(result.loaded).cast("long").alias("loaded"), F.lit(result.failed).cast("long").alias("failed"),
        "null_segments", "quoted_names",
    )


def csv_scan_customer(spark, sf_dir):
    path = scratch_path(spark, "entities")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").write.option("escape", "\\").csv(path)
    return read_entities(spark, path, "other", "c_custkey long, c_name string, c_acctbal double")


def json_result_roundtrip(spark, sf_dir):
    flat = person(spark, sf_dir).select(
        "id", F.col("first_name").alias("name"), "email", F.col("id").alias("matchId"),
        F.lit(0.95).alias("matchScore"))
    path = write_results(flat, scratch_path(spark, "results"), "json", "20240601_000000")
    back = read_json_lines(spark, path, "id string, name string, email string, matchId string, matchScore double")
    return mapping.rename_results(back)


def json_array_person(spark, sf_dir):
    """One array of records per file, read back with the outer array stripped."""
    record = F.struct("id", "first_name", "postal_code")
    thousand = F.floor(F.substring("id", 2, 12).cast("long") / 1000)
    files = person(spark, sf_dir).groupBy(F.concat(F.substring("id", 1, 1), thousand.cast("string")).alias("part")).agg(
        F.collect_list(record).alias("records"))
    return _through_arrays(spark, files, "id string, first_name string, postal_code string")


def _through_arrays(spark, files, schema):
    path = scratch_path(spark, "arrays")
    files.select("part", F.to_json("records").alias("value")).write.partitionBy("part").text(path)
    return read_json_array(spark, path, schema).drop("part")


def json_array_customer(spark, sf_dir):
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    files = table(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_custkey") / 1000).alias("part")).agg(
        F.collect_list(record).alias("records"))
    return _through_arrays(spark, files, "id long, name string, balance double")


def load_multiline_csv(spark, sf_dir):
    """Whole documents as quoted CSV fields, line breaks and all."""
    path = scratch_path(spark, "multiline")
    text = F.regexp_replace("text", "\r\n?", "\n")
    rows = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), "lang")
    rows.write.options(
        **LOAD_DIALECT, header=True, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    good, rejects = read_csv_load(spark, path, "doc_id long, text string, lang string", "continue")
    good = good.select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("long").alias("n_chars"), "lang")
    return good.withColumn("rejects", F.lit(rejects.count()).cast("long"))


def load_typed_csv(spark, sf_dir):
    """NULL tokens in columns of several types, quotes within quotes, and values of the wrong type."""
    path = scratch_path(spark, "typed")
    kind = F.col("c_custkey") % 5
    lines = table(spark, sf_dir, "customer").select(F.concat_ws(
        ",", F.col("c_custkey").cast("string"), F.concat(F.lit('"say ""'), F.col("c_name"), F.lit('"", x"')),
        F.when(kind == 1, "NULL").when(kind == 2, "n/a").otherwise(F.col("c_nationkey").cast("string")),
        F.when(kind == 3, "null").otherwise("1.5"), F.when(kind == 4, F.lit("")).otherwise("2024-02-29"),
    ).alias("id,name,nation,rate,since"))
    lines.write.option("header", True).option("quote", "").option("sep", "\x01").csv(path)
    good, rejects = read_csv_load(spark, path, "id long, name string, nation int, rate double, since date", "continue")
    return good.withColumn("since", F.col("since").cast("string")).unionByName(
        rejects.agg(F.count("*").alias("id"), F.lit("rejects").alias("name")), allowMissingColumns=True)


def load_json_rejects(spark, sf_dir):
    """Good lines, values of another type, lines that are no object, and broken ones."""
    path = scratch_path(spark, "json-load")
    key, kind = F.col("c_custkey").cast("string"), F.col("c_custkey") % 7
    line = (
        F.when(kind == 1, F.concat(F.lit('{"id":"x'), key, F.lit('"}'))).when(kind == 2, key)
        .when(kind == 3, F.concat(F.lit("["), key, F.lit("]"))).when(kind == 4, F.concat(F.lit('{"id":'), key))
        .otherwise(F.concat(F.lit('{"id":'), key, F.lit("}")))
    )
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    records, rejects = read_json_load(spark, path, "id long", "continue")
    first = F.substring("value", 1, 1)
    kinds = F.when(first == "{", "object").when(first == "[", "array").otherwise("value")
    return records.agg(F.lit("record").alias("kind"), F.count("*").alias("n"), F.sum("id").alias("id_sum")).unionByName(
        rejects.groupBy(kinds.alias("kind")).agg(F.count("*").alias("n"), F.lit(None).cast("long").alias("id_sum")))


def json_duplicate_keys(spark, sf_dir):
    path = scratch_path(spark, "lines")
    line = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit('{"id":1,"id":'), F.col("o_orderkey"), F.lit("}")))
    plain = F.concat(F.lit('{"id":'), F.col("o_orderkey"), F.lit("}"))
    table(spark, sf_dir, "orders").select(F.coalesce(line, plain).alias("value")).write.text(path)
    records, rejects = read_json_strict(spark, path, "id long")
    return records.agg(F.lit("records").alias("kind"), F.count("*").alias("n"), F.sum("id").alias("id_sum")).unionByName(
        rejects.agg(F.lit("rejects").alias("kind"), F.count("*").alias("n"), F.lit(None).cast("long").alias("id_sum")))


def parquet_orc_roundtrip(spark, sf_dir):
    base = scratch_path(spark, "formats")
    rows = person(spark, sf_dir).select("id", "source", "address")
    back = [read_entities(spark, write_results(rows, base, f, f), f) for f in ("parquet", "orc")]
    return back[0].join(back[1].withColumnRenamed("address", "orc_address"), ["id", "source"])


def csv_struct_output(spark, sf_dir):
    packed = mapping.with_source_fields(person(spark, sf_dir), ["first_name", "postal_code"]).select("id", "sourceFields")
    path = write_results(packed, scratch_path(spark, "flat"), "csv", "run")
    return read_entities(
        spark, path, "csv", "id string, sourceFields_first_name string, sourceFields_postal_code string", header=True)


def external_table_orders(spark, sf_dir):
    name = "kinweave_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    schema = "o_orderkey long, o_orderstatus string, o_totalprice double"
    register_table(spark, name, f"{sf_dir}/orders.parquet", schema, "parquet")
    return read_table(spark, name)


def sql_source_limit(spark, sf_dir):
    ordered = sql_source(
        spark, "select o_orderkey, o_totalprice from {orders} where o_totalprice >= :least "
        "order by o_totalprice desc, o_orderkey", {"least": 1000.0}, orders=table(spark, sf_dir, "orders"))
    ordered.createOrReplaceTempView("kinweave_ordered")
    return read_table(spark, "kinweave_ordered", limit=100)


def multi_source_union(spark, sf_dir):
    return union_sources({
        "customer": table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        "supplier": table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
    })


def latest_batch_orders(spark, sf_dir):
    """Orders in one directory per year; the greatest is read."""
    base = scratch_path(spark, "batches")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("year"))
    orders.write.partitionBy("year").json(base)
    return read_latest(spark, base, "json", "o_orderkey long, o_totalprice double", ".json")


# --- metrics and streams -----------------------------------------------------------------

def metrics_300s_events(spark, sf_dir):
    out = metrics.metric_rollup(table(spark, sf_dir, "events"), "ts", "event_type", "value", 300)
    return out.select(
        stamp("period_start"), "name", F.round("total", 4).alias("total"),
        F.round("average", 4).alias("average"), "samples")


def alarms_60s_events(spark, sf_dir):
    out = metrics.error_alarm(table(spark, sf_dir, "events"), "ts", F.col("event_type") == "error")
    return out.select(stamp("period_start"), "observed")


def duration_alarm_events(spark, sf_dir):
    limit = metrics.duration_limit_ms(60) / 1000.0
    out = metrics.duration_alarm(table(spark, sf_dir, "events"), "ts", F.col("value"), limit)
    return out.select(stamp("period_start"), "observed")


def _replayed_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events")
    events.repartitionByRange("ts").sortWithinPartitions("ts").write.parquet(path)
    return stream_files(spark, path, events.schema)


def stream_metrics_events(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    rollup = live_rollup(_replayed_events(spark, sf_dir), "ts", "event_type", "value")
    write_metrics(rollup, path, scratch_path(spark, "metrics-log")).awaitTermination()
    return spark.read.parquet(path).select(
        stamp("period_start"), "name", F.round("total", 4).alias("total"), "samples")


def stream_alarms_events(spark, sf_dir):
    path = scratch_path(spark, "alarms")
    found = live_alarms(_replayed_events(spark, sf_dir), "ts", F.count_if(F.col("event_type") == "error"), 1)
    write_metrics(found, path, scratch_path(spark, "alarms-log")).awaitTermination()
    return spark.read.parquet(path).select(stamp("period_start"), "observed")


def _loaded_people(spark, people) -> KeyedTable:
    """An empty table of people with their groups."""
    loaded = KeyedTable(spark, scratch_path(spark, "people"), "id")
    empty = people.select(
        "*", F.lit("").alias("match_id"), F.lit(0.0).alias("score"), F.lit("").alias("rule_id"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("LAST_UPDATED")).where("1 = 0")
    loaded.write(empty, 1)
    return loaded


def _streamed(spark, sf_dir):
    """The person sources arriving one after the other, matched and merged batch by batch."""
    people = normalized_person(spark, sf_dir)
    arrivals, feed = scratch_path(spark, "arrivals"), scratch_path(spark, "feed")
    loaded = _loaded_people(spark, people)
    arrive, log = arrival_job(loaded, RULES, feed, AS_OF), scratch_path(spark, "arrivals-log")
    for source in ("web", "crm"):
        people.where(F.col("source") == source).write.mode("append").parquet(arrivals)
        on_arrival(stream_files(spark, arrivals, people.schema), log, arrive).awaitTermination()
    return loaded, feed


def stream_upsert_person(spark, sf_dir):
    loaded, _ = _streamed(spark, sf_dir)
    return loaded.read().select("id", "match_id", "score", "rule_id")


def regroup_person(spark, sf_dir):
    """Everybody in one batch, then some records again with new values: they leave their groups, and may meet others."""
    people, corrected = (normalized_person(spark, sf_dir, sql) for sql in (PERSON_SQL, CORRECTED_SQL))
    loaded = _loaded_people(spark, people)
    arrive = arrival_job(loaded, RULES, scratch_path(spark, "feed"), AS_OF)
    arrive(people, 0)
    arrive(corrected.subtract(people), 1)
    return loaded.read().select("id", "match_id", "score", "rule_id", "first_name")


def stream_changes_person(spark, sf_dir):
    _, feed = _streamed(spark, sf_dir)
    changes = read_changes(spark, feed)
    return changes.groupBy("id").agg(F.count_if(F.col("action") == "INSERT").alias("inserts"))


def process_load_person(spark, sf_dir):
    """Register, match, write the run, read the latest run, merge it by id."""
    base = scratch_path(spark, "job")
    person(spark, sf_dir).write.parquet(f"{base}/input")
    target = KeyedTable(spark, f"{base}/target", "ID")
    name = "kinweave_" + base.rsplit("-", 1)[1]
    done = run_pipeline(
        spark, f"{base}/input", ATTRIBUTES, target, RULES, AS_OF, "parquet", name, output=base, run="20240601_000000")
    out = target.read().select("ID", "LAST_NAME", "MATCH_ID", "MATCH_SCORE", stamp("LAST_UPDATED"))
    return out.withColumn("loaded", F.lit(done.loaded.loaded).cast("long"))


MAPPED_ATTRIBUTES = [
    Attribute("id", required=True), Attribute("name", "NAME", "FULL_NAME"),
    Attribute("segment", match_key=True, group="place"), Attribute("nation", match_key=True, group="place"),
]
MAPPED_FIELDS = {"id": "c_custkey", "name": "c_name", "segment": "c_mktsegment", "nation": "c_nationkey"}


def process_mapped_customer(spark, sf_dir):
    """Source columns under other names than the attributes; customers of a segment and nation match."""
    base = scratch_path(spark, "mapped")
    target = KeyedTable(spark, f"{base}/target", "ID")
    run_pipeline(
        spark, base, MAPPED_ATTRIBUTES, target, None, AS_OF, source=table(spark, sf_dir, "customer"), source_fields=MAPPED_FIELDS)
    return target.read().select("ID", "NAME", "MATCH_ID")


def process_mapped_files(spark, sf_dir):
    """The same over files whose columns have other names than the attributes."""
    base = scratch_path(spark, "mapped-files")
    table(spark, sf_dir, "customer").select(*MAPPED_FIELDS.values()).write.json(f"{base}/input")
    target = KeyedTable(spark, f"{base}/target", "ID")
    name = "kinweave_" + base.rsplit("-", 1)[1]
    run_pipeline(spark, f"{base}/input", MAPPED_ATTRIBUTES, target, None, AS_OF, "json", name, source_fields=MAPPED_FIELDS)
    return target.read().select("ID", "NAME", "MATCH_ID")


def process_provider_person(spark, sf_dir):
    """The whole job with a provider's identities instead of rules."""
    base = scratch_path(spark, "provided")
    people = normalized_person(spark, sf_dir)
    identities = people.where("source = 'crm'").select(
        provider.key_digest(F.col("email")).alias("key_hash"), F.concat(F.lit("P-"), F.col("postal_code")).alias("provider_id"))
    target = KeyedTable(spark, f"{base}/target", "ID")
    done = run_pipeline(
        spark, base, ATTRIBUTES, target, None, AS_OF, source=person(spark, sf_dir), provider=Provider(cut(identities), "email"))
    return target.read().select("ID", "MATCH_ID").withColumn("loaded", F.lit(done.loaded.loaded).cast("long"))
