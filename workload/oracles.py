"""SQL for the queries, in the dialect of DuckDB, over the same tables."""

from __future__ import annotations

from kinweave.functions.normalize import STREET_WORDS
from workload.person import CORRECTED_SQL, PERSON_SQL
from workload.queries import AS_OF

SHORT = " ".join(f"when '{word}' then '{short}'" for word, short in STREET_WORDS.items())
EXT = r"(?i)\s*(?:extension|ext\.?|x)\s*(\d+)\s*$"


def words(c: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower({c}), '[''’.]', '', 'g'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    )


def norm_name(c: str) -> str:
    return f"nullif({words(c)}, '')"


def norm_address(c: str) -> str:
    return (
        f"nullif(array_to_string([case w {SHORT} else w end for w in string_split({words(c)}, ' ')], ' '), '')"
    )


def norm_email(c: str) -> str:
    low = f"lower(trim({c}, E' \\t\\r\\n'))"
    return f"case when regexp_matches({low}, '^[^@\\s]+@[^@\\s]+$') then {low} end"


def norm_phone(c: str) -> str:
    digits = f"regexp_replace(regexp_replace({c}, '{EXT}', ''), '[^0-9]', '', 'g')"
    return (
        f"nullif(case when length({digits}) = 11 and {digits} like '1%' "
        f"then substr({digits}, 2) else {digits} end, '')"
    )


def norm_id(c: str) -> str:
    return f"nullif(upper(regexp_replace({c}, '[^0-9A-Za-z]', '', 'g')), '')"


def norm_postal(c: str) -> str:
    return f"case when length({norm_id(c)}) = 9 and try_cast({norm_id(c)} as bigint) is not null then substr({norm_id(c)}, 1, 5) else {norm_id(c)} end"


def sim(a: str, b: str) -> str:
    return f"(1.0::double - levenshtein({a}, {b})::double / greatest(length({a}), length({b})))"


CORRECTED = f"person as ({CORRECTED_SQL.format(customer='customer')})"
PERSON = f"person as ({PERSON_SQL.format(customer='customer')})"
NORMAL = f"""{PERSON}, pn as materialized (select source, id, {norm_name('first_name')} as first_name,
  {norm_name('last_name')} as last_name, {norm_email('email')} as email, {norm_phone('phone')} as phone,
  {norm_address('address')} as address, {norm_postal('postal_code')} as postal_code from person)"""


def stars(rows: str, id_col: str, keys: list[str], cte: str) -> str:
    """Groups of equal keys as links to their smallest id."""
    k = ", ".join(keys)
    present = " and ".join(f"{c} is not null" for c in keys)
    return (
        f"{cte} as (select id_a, id_b from (select min({id_col}) over (partition by {k}) as id_a, "
        f"{id_col} as id_b from {rows} where {present}) where id_a < id_b)"
    )


def reach(edges: str, cte: str) -> str:
    """(id, root) of the components of an edge list."""
    return f"""{cte}_both as (select id_a as x, id_b as y from {edges} union select id_b, id_a from {edges}),
{cte}_walk as (select x as id, x as node from {cte}_both union
  select w.id, e.y from {cte}_walk w join {cte}_both e on e.x = w.node),
{cte} as (select id, min(node) as root from {cte}_walk group by id)"""


def similar(rows: str, id_col: str, exact: list[str], fuzzy: dict[str, float], cte: str, least: float = 0) -> str:
    """Similar pairs of profiles, and links from a profile's smallest id to its copies."""
    fields = [*exact, *fuzzy]
    k = ", ".join(fields)
    present = " and ".join(f"{c} is not null" for c in fields)
    same = "".join(f" and a.{c} = b.{c}" for c in exact)
    near = "".join(f" and {sim(f'a.{c}', f'b.{c}')} >= {t}" for c, t in fuzzy.items())
    score = score_of("a", "b", exact, fuzzy)
    return f"""{cte}_prof as materialized (select {k}, min({id_col}) as pid from {rows} where {present} group by {k}),
{cte}_pairs as materialized (select * from (select a.pid as id_a, b.pid as id_b, {score} as score
  from {cte}_prof a join {cte}_prof b on a.pid < b.pid{same}{near}) where score >= {least}),
{stars(rows, id_col, fields, cte + '_copies')}"""


def score_of(a: str, b: str, exact: list[str], fuzzy: dict[str, float]) -> str:
    total = " + ".join([f"{float(len(exact))}::double", *[sim(f"{a}.{c}", f"{b}.{c}") for c in fuzzy]])
    return f"round(({total}) / {float(len(exact) + len(fuzzy))}::double, 6)"


def rule_groups(rows: str, id_col: str, exact: list[str], fuzzy: dict[str, float], cte: str) -> str:
    """A fuzzy rule's groups as links to their smallest id."""
    return f"""{similar(rows, id_col, exact, fuzzy, cte)},
{reach(cte + '_pairs', cte + '_comp')},
{cte}_best as (select id, max(score) as best from (select id_a as id, score from {cte}_pairs union all
  select id_b, score from {cte}_pairs) group by id),
{cte} as (select id_a, id_b, 1.0::double as score_a, 1.0::double as score from {cte}_copies union all
  select c.root, c.id, a.best, b.best from {cte}_comp c
  join {cte}_best a on a.id = c.root join {cte}_best b on b.id = c.id where c.id <> c.root)"""


NAME_ADDRESS = (["postal_code"], {"first_name": 0.8, "last_name": 0.8, "address": 0.7})
LINKS = f"""{stars('pn', 'id', ['email'], 'by_email')}, {stars('pn', 'id', ['phone'], 'by_phone')},
{rule_groups('pn', 'id', *NAME_ADDRESS, 'by_name')},
every as (select id_a, id_b, 1 as rule_index, 'email' as rule_id, 1.0::double as score_a, 1.0::double as score from by_email
  union all select id_a, id_b, 2, 'phone', 1.0, 1.0 from by_phone union all
  select id_a, id_b, 3, 'name-address', score_a, score from by_name),
links as materialized (select * from every qualify row_number() over (
  partition by id_a, id_b order by rule_index, score_a desc, score desc) = 1)"""
RESOLVED = f"""with recursive {NORMAL}, {LINKS}, {reach('links', 'grp')},
ends as (select id_a as id, rule_index, rule_id, score_a as score from links union all
  select id_b, rule_index, rule_id, score from links),
best as (select id, rule_id, score from ends qualify row_number() over (
  partition by id order by rule_index, score desc, rule_id) = 1),
records as materialized (select p.id, coalesce(g.root, p.id) as match_id, b.score, b.rule_id, g.root from person p
  left join grp g on g.id = p.id left join best b on b.id = p.id)"""

def em_rounds(fields: dict[str, float], rounds: int) -> str:
    """Expectation maximisation over agreement patterns, a round being two steps; `t{rounds}` has the result."""
    names = list(fields)

    def product(p: str) -> str:
        return " * ".join(f"case {c} when 1 then t.{p}_{c} when 0 then 1 - t.{p}_{c} else 1 end" for c in names)

    def inside(x: str) -> str:
        return f"least(greatest({x}, 0.000001::double), 1 - 0.000001::double)"

    def rate(weight: str, c: str) -> str:
        return inside(f"coalesce(sum({weight} * pairs) filter ({c} = 1), 0) / sum({weight} * pairs) filter ({c} is not null)")

    start = ", ".join(f"0.9::double as m_{c}, 0.1::double as u_{c}" for c in names)
    steps = [f"t0 as (select 0.1::double as share, {start})"]
    for r in range(rounds):
        rates = ", ".join(f"{rate('e', c)} as m_{c}, {rate('(1 - e)', c)} as u_{c}" for c in names)
        steps.append(f"""e{r} as (select {', '.join(names)}, pairs,
  t.share * {product('m')} as a, (1 - t.share) * {product('u')} as b, a / (a + b) as e from patterns, t{r} t)""")
        steps.append(f"t{r + 1} as (select {inside('sum(e * pairs) / sum(pairs)')} as share, {rates} from e{r})")
    return ",\n".join(steps)


EM_LEAST = {"last_name": 0.85, "address": 0.8, "email": 0.99, "phone": 0.99}
EM_LEVELS = ", ".join(f"({sim(f'a.{c}', f'b.{c}')} >= {t})::int as {c}" for c, t in EM_LEAST.items())
EM = f"""with {NORMAL}, {similar('pn', 'id', ['postal_code'], {'first_name': 0.6}, 'm')},
p as (select id_a, id_b from m_pairs union all select id_a, id_b from m_copies),
levels as materialized (select id_a, id_b, {EM_LEVELS} from p join pn a on a.id = id_a join pn b on b.id = id_b),
patterns as materialized (select {', '.join(EM_LEAST)}, count(*) as pairs from levels group by all),
{em_rounds(EM_LEAST, 6)}"""
EM_ODDS = " * ".join(
    f"case {c} when 1 then m_{c} / u_{c} when 0 then (1 - m_{c}) / (1 - u_{c}) else 1 end" for c in EM_LEAST)

DIGEST = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'), E' \t\r\n')"
DOCS = f"docs as (select doc_id, lang, n_chars, nullif({DIGEST}, '') as t from documents)"
DOC_GROUPS = f"{DOCS}, {stars('docs', 'doc_id', ['t'], 'l')}"

ORDERS_MERGED = """old as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders),
new as (select o_orderkey * 2 as o_orderkey, o_custkey, case when o_orderstatus <> 'P' then o_orderstatus end as o_orderstatus,
  round(o_totalprice + 1, 2) as o_totalprice, o_orderpriority from orders)"""

PERIOD_300 = "time_bucket(interval '300 seconds', ts)"
PERIOD_60 = "time_bucket(interval '60 seconds', ts)"


def text_time(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


# A stream gives out a period once the watermark, ten minutes behind, has passed its end.
CLOSED_300 = f"{PERIOD_300} + interval '300 seconds' <= (select max(ts) from events) - interval '10 minutes'"
CLOSED_60 = f"{PERIOD_60} + interval '60 seconds' <= (select max(ts) from events) - interval '10 minutes'"

OBJECT = (
    "((starts_with({0}, 's3://') and strpos(substr({0}, 6), '/') > 1 and not contains(split_part(substr({0}, 6), '/', 1), ':')) "
    "or (strpos({0}, '/') > 1 and not contains(split_part({0}, '/', 1), ':')))"
)
BARE_URL = "regexp_replace(trim({0}), '#.*$', '')"
URL = (
    "nullif(regexp_replace(concat(lower(regexp_extract({b}, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?]*)', 1)), "
    "substr({b}, length(regexp_extract({b}, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?]*)', 1)) + 1)), '/+$', ''), '')"
)


def norm_url(c: str) -> str:
    return URL.format(b=BARE_URL.format(c))


def missing(c: str) -> str:
    return f"({c} is null or trim({c}, E' \\t\\r\\n') = '')"


def report_row(name: str, normal: str) -> str:
    return (
        f"select '{name}' as attribute, count(*) as n_rows, count(*) filter ({missing(name)}) as n_missing, "
        f"count(*) filter (not {missing(name)} and {normal} is null) as n_invalid from person"
    )


REPORT = " union all ".join(report_row(c, e) for c, e in [
    ("id", "id"), ("first_name", norm_name("first_name")), ("last_name", norm_name("last_name")),
    ("email", norm_email("email")), ("phone", norm_phone("phone")), ("address", norm_address("address")),
    ("postal_code", norm_postal("postal_code")),
])

FIRST_VALUE = ", ".join(
    f"arg_min(n.{c}, concat(case n.source when 'web' then '1' else '2' end, n.id)) filter (n.{c} is not null) as {c}"
    for c in ["first_name", "last_name", "email", "phone", "address", "postal_code"]
)

ORACLES = {
    "schema_map_customer": """select cast(c_custkey as varchar) as customer_id, c_name as full_name,
        c_acctbal as balance, c_mktsegment as segment, try_cast(c_name as double) as name_as_number from customer""",
    "sink_projection_person": f"""with {PERSON} select id as "ID", first_name as "FIRST_NAME", email as "EMAIL",
        id as "MATCH_ID", 0.95::double as "MATCH_SCORE", '{AS_OF}' as "LAST_UPDATED" from person""",
    "source_fields_struct": f"with {PERSON} select id, first_name, last_name, phone from person",
    "array_key_match": f"""with {NORMAL}, c as (select distinct id, unnest([email, phone]) as k from pn),
        {stars('c', 'id', ['k'], 'l')} select distinct id_a, id_b from l""",
    "group_key_match": f"with {NORMAL}, {stars('pn', 'id', ['last_name', 'address', 'postal_code'], 'l')} select * from l",
    "dq_report_person": f"with {PERSON} {REPORT}",
    "required_split_person": f"""with {PERSON} select id, concat_ws(',', case when {missing('email')} then 'email' end,
        case when {missing('phone')} then 'phone' end) as missing from person""",
    "domain_check_orders": """select o_orderkey, coalesce(o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM'), false)
        as in_domain from orders""",
    "path_check_pages": f"""select page_id, {OBJECT.format('url')} as url_ok,
        {OBJECT.format("regexp_replace(url, '^https?://', 's3://')")} as object_ok,
        {OBJECT.format("regexp_replace(url, '^https?://', '')")} as bare_ok from pages""",
    "uri_parts_pages": """with p as (select page_id,
        nullif(regexp_extract(url, '^(?:[A-Za-z0-9]+://)?([^/]+)/?', 1), '') as bucket,
        nullif(regexp_extract(url, '^(?:[A-Za-z0-9]+://)?[^/]+/(.*)$', 1), '') as key from pages)
        select *, 's3://' || bucket || '/' || key as uri from p""",
    "norm_person_contact": f"""with {PERSON} select id, {norm_name('first_name')} as first_name,
        {norm_name('last_name')} as last_name, {norm_email('email')} as email,
        split_part({norm_email('email')}, '@', 1) as email_user, split_part({norm_email('email')}, '@', 2) as email_domain,
        {norm_phone("(phone || ' ext. 42')")} as phone,
        nullif(regexp_extract(phone, '^\\s*\\+\\s*(\\d{{1,3}})[\\s(.\\-]', 1), '') as phone_country,
        nullif(regexp_extract(phone || ' ext. 42', '{EXT}', 1), '') as phone_ext,
        nullif(trim(email), '') as email_or_null from person""",
    "norm_person_address": f"""with {PERSON} select id, {norm_address('address')} as address,
        nullif(lower(regexp_extract(address, '^\\s*(\\d+[A-Za-z]?)(?:\\s|,|$)', 1)), '') as house_number,
        nullif(regexp_replace({norm_address('address')}, '^\\d+[a-z]?(?:\\s+|$)', ''), '') as street_name,
        nullif(upper(regexp_extract(address, '(?i)\\bp\\.?\\s*o\\.?\\s*box\\s+#?\\s*([0-9A-Za-z]+)', 1)), '') as po_box,
        {norm_postal("concat(' ', postal_code, '-12ab')")} as postal_code from person""",
    "split_full_name": f"""with {PERSON} select id, first_name as first, 'Q.' as middle, last_name as last,
        first_name as turned_first, null::varchar as turned_middle, last_name as turned_last from person""",
    "norm_typed": f"""select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as from_text, true as no_date,
        cast(cast(o_totalprice as decimal(18, 2)) as double) as number, true as no_number,
        {norm_id('o_orderpriority')} as id_text from orders""",
    "norm_url_pages": f"""select page_id, {norm_url('url')} as url,
        {norm_url("concat(regexp_replace(url, '^http', 'HTTP'), '/#part')")} as shouted from pages""",
    "record_codec_person": f"with {PERSON} select id, first_name, postal_code, '20240601_000000' as run from person",
    "exact_dup_documents": f"with {DOC_GROUPS} select * from l",
    "composite_exact_part": f"with {stars('part', 'p_partkey', ['p_name', 'p_brand', 'p_type'], 'l')} select * from l",
    "fuzzy_part_blocked": f"""with {similar('part', 'p_partkey', ['p_brand', 'p_type'], {'p_name': 0.8}, 'm')}
        select id_a, id_b, score from m_pairs union all select id_a, id_b, 1.0 from m_copies""",
    "score_threshold_part": f"""with {similar('part', 'p_partkey', ['p_brand'], {'p_name': 0.7, 'p_type': 0.5}, 'm', 0.9)}
        select id_a, id_b, score from m_pairs union all select id_a, id_b, 1.0 from m_copies""",
    "mixed_rule_person": f"with recursive {NORMAL}, {rule_groups('pn', 'id', *NAME_ADDRESS, 'm')} select * from m",
    "all_fuzzy_person": f"with recursive {NORMAL}, {rule_groups('pn', 'id', [], NAME_ADDRESS[1], 'm')} select * from m",
    "rules_person": f"with recursive {NORMAL}, {LINKS} select * from links",
    "topk_matches_part": f"""with pairs as (select a.p_partkey as x, b.p_partkey as y,
          round((1.0::double + {sim('a.p_name', 'b.p_name')}) / 2.0::double, 6) as score
          from part a join part b on a.p_brand = b.p_brand and a.p_partkey <> b.p_partkey
          and {sim('a.p_name', 'b.p_name')} >= 0.6),
        best as (select * from pairs qualify row_number() over (partition by x order by score desc, y) <= 3)
        select distinct least(x, y) as id_a, greatest(x, y) as id_b, score from best""",
    "match_groups_documents": f"""with {DOC_GROUPS}
        select id_b as id, id_a as root from l union select id_a, id_a from l""",
    "match_groups_person": f"{RESOLVED} select id, root from grp",
    "match_output_person": f"""{RESOLVED} select r.id as "sourceId", match_id as "matchId", score as "confidenceScore",
        case when root is not null then 'rule' end as "matchType", rule_id as "ruleId", p.first_name, p.email
        from records r join person p on p.id = r.id""",
    "unmatched_person": f"""{RESOLVED} select p.id, p.last_name from person p join records r on r.id = p.id
        where r.root is null""",
    "unmatched_documents": f"""with {DOC_GROUPS} select doc_id, lang, n_chars from docs
        where doc_id not in (select id_a from l union select id_b from l)""",
    "dedup_source_person": f"""with {NORMAL} select source, id, first_name, last_name, postal_code from pn
        qualify row_number() over (partition by source, first_name, last_name, postal_code order by id) = 1""",
    "id_mapping_person": f"""{RESOLVED}, s as (select match_id, p.source as ns_to, min(p.id) as id_to
          from records r join person p on p.id = r.id group by 1, 2)
        select p.source as ns_from, p.id as id_from, s.ns_to, s.id_to, r.match_id
        from records r join person p on p.id = r.id join s on s.match_id = r.match_id where s.ns_to <> p.source""",
    "id_graph_person": f"""{RESOLVED} select distinct p.source as ns, p.id, r.match_id from records r
        join person p on p.id = r.id""",
    "provider_match_person": f"""with {NORMAL}, ref as (select sha256(email) as h, min('P-' || postal_code || '-' || id) as pid
          from pn where source = 'crm' group by 1)
        select pn.id, ref.pid as provider_id from pn left join ref on ref.h = sha256(pn.email)""",
    "golden_person": f"""{RESOLVED} select r.match_id, {FIRST_VALUE}, count(*) as n_records
        from records r join pn n on n.id = r.id group by r.match_id""",
    "job_stats_person": f"""{RESOLVED}, g as (select match_id, count(*) as n from records group by 1)
        select cast(sum(n) as bigint) as input_records, cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as matched_records,
        count(*) filter (n > 1) as match_groups from g""",
    "group_sizes_documents": f"""with {DOCS}, g as (select count(*) as group_size from docs
        group by coalesce(t, 'no text ' || doc_id)) select group_size, count(*) as n_groups from g group by 1""",
    "match_quality_person": f"""{RESOLVED}, l as (select match_id as p, substr(id, 2, 12) as t from records),
        c as (select (select sum(n * (n - 1) / 2.0) from (select count(*) as n from l group by p, t)) as tp,
          (select sum(n * (n - 1) / 2.0) from (select count(*) as n from l group by p)) as pp,
          (select sum(n * (n - 1) / 2.0) from (select count(*) as n from l group by t)) as ap)
        select tp::double as true_pairs, pp::double as predicted_pairs, ap::double as actual_pairs,
          round(tp::double / pp::double, 6) as precision, round(tp::double / ap::double, 6) as recall,
          round(2 * tp::double / (pp + ap)::double, 6) as f1 from c""",
    "merge_upsert_orders": f"""with {ORDERS_MERGED} select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey,
        case when n.o_orderkey is not null then n.o_custkey else o.o_custkey end as o_custkey,
        case when n.o_orderkey is not null then n.o_orderstatus else o.o_orderstatus end as o_orderstatus,
        case when n.o_orderkey is not null then n.o_totalprice else o.o_totalprice end as o_totalprice,
        case when n.o_orderkey is not null then n.o_orderpriority else o.o_orderpriority end as o_orderpriority,
        case when n.o_orderkey is not null then '{AS_OF}' else '2020-01-01 00:00:00' end as "LAST_UPDATED"
        from old o full join new n on n.o_orderkey = o.o_orderkey""",
    "merge_counters_orders": f"""with {ORDERS_MERGED},
        c as (select count(*) as n, count(*) filter (o_orderkey in (select o_orderkey from old)) as u,
          count(*) filter (o_orderstatus is null) as r from new)
        select case when r > 0 then 'partial' else 'success' end as status, n + r as processed, n as loaded,
          r as failed, n - u as inserted, u as updated from c""",
    "change_feed_orders": f"""with {ORDERS_MERGED} select case when o.o_orderkey is null then 'INSERT' else 'UPDATE' end as action,
        n.* from new n left join old o on o.o_orderkey = n.o_orderkey""",
    "append_orders": """select o_orderkey * s as o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
        (select 2 * count(*) from orders) as written from orders, (values (1), (-1)) t(s)""",
    "insert_orders": """select o_orderkey, null::bigint as o_custkey, null::varchar as o_orderstatus, o_totalprice,
        null::varchar as o_orderpriority, (select count(*) from orders) as written from orders""",
    "overwrite_orders": """select o_orderkey, o_custkey, o_orderstatus, round(o_totalprice * 2, 2) as o_totalprice,
        o_orderpriority from orders""",
    "load_counters_csv": """with c as (select count(*) as n, count(*) filter (c_mktsegment = 'AUTOMOBILE') as bad,
        count(*) filter (c_mktsegment in ('FURNITURE', 'MACHINERY', 'BUILDING')) as empty from customer)
        select case when bad > 0 then 'partial' else 'success' end as status, n as processed, n - bad as loaded,
          bad as failed, empty as null_segments, n - bad as quoted_names from c""",
    "csv_scan_customer": "select c_custkey, c_name, c_acctbal from customer",
    "json_result_roundtrip": f"""with {PERSON} select id as "ID", first_name as "NAME", email as "EMAIL",
        id as "MATCH_ID", 0.95::double as "MATCH_SCORE" from person""",
    "json_array_person": f"with {PERSON} select id, first_name, postal_code from person",
    "json_duplicate_keys": """select 'records' as kind, count(*) as n, cast(sum(o_orderkey) as bigint) as id_sum
        from orders where o_orderstatus is distinct from 'P'
        union all select 'rejects', count(*), null from orders where o_orderstatus = 'P'""",
    "parquet_orc_roundtrip": f"with {PERSON} select id, source, address, address as orc_address from person",
    "csv_struct_output": f"""with {PERSON} select id, first_name as "sourceFields_first_name",
        postal_code as "sourceFields_postal_code" from person""",
    "external_table_orders": "select o_orderkey, o_orderstatus, o_totalprice from orders",
    "sql_source_limit": """select o_orderkey, o_totalprice from orders where o_totalprice >= 1000
        order by o_totalprice desc, o_orderkey limit 100""",
    "multi_source_union": """select c_custkey as id, c_name as name, c_mktsegment as segment, null::double as balance,
        'customer' as source from customer
        union all select s_suppkey, s_name, null, s_acctbal, 'supplier' from supplier""",
    "latest_batch_orders": """select o_orderkey, o_totalprice from orders
        where year(o_orderdate) = (select max(year(o_orderdate)) from orders)""",
    "metrics_300s_events": f"""select {text_time('p')} as period_start, event_type as name, round(sum(value), 4) as total,
        round(avg(value), 4) as average, count(value) as samples
        from (select *, {PERIOD_300} as p from events) group by p, event_type""",
    "alarms_60s_events": f"""select {text_time('p')} as period_start, count(*) as observed
        from (select {PERIOD_60} as p from events where event_type = 'error') group by p""",
    "duration_alarm_events": f"""select {text_time('p')} as period_start, max(value) as observed
        from (select *, {PERIOD_60} as p from events) group by p having max(value) > 45.0""",
    "stream_metrics_events": f"""select {text_time('p')} as period_start, event_type as name, round(sum(value), 4) as total,
        count(value) as samples from (select *, {PERIOD_300} as p from events where {CLOSED_300}) group by p, event_type""",
    "stream_alarms_events": f"""select {text_time('p')} as period_start, count(*) as observed
        from (select {PERIOD_60} as p from events where event_type = 'error' and {CLOSED_60}) group by p""",
    "stream_upsert_person": f"{RESOLVED} select id, match_id, score, rule_id from records",
    "load_multiline_csv": """select doc_id, md5(t) as digest, length(t) as n_chars, lang, 0::bigint as rejects
        from (select doc_id, nullif(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '') as t, lang from documents)""",
    "regroup_person": f"""{RESOLVED.replace(PERSON, CORRECTED)} select r.id, match_id, score, rule_id, first_name
        from records r join pn on pn.id = r.id""",
    "stream_changes_person": f"with {PERSON} select id, 1::bigint as inserts from person",
    "process_load_person": f"""{RESOLVED} select r.id as "ID", p.last_name as "LAST_NAME", r.match_id as "MATCH_ID",
        r.score as "MATCH_SCORE", '{AS_OF}' as "LAST_UPDATED", (select count(*) from records) as loaded
        from records r join person p on p.id = r.id""",
    "rules_person_split": f"with recursive {NORMAL}, {LINKS} select * from links",
    "topk_part_split": f"""with pairs as (select a.p_partkey as x, b.p_partkey as y,
          round((1.0::double + {sim('a.p_name', 'b.p_name')} + {sim('a.p_type', 'b.p_type')}) / 3.0::double, 6) as score
          from part a join part b on a.p_brand = b.p_brand and a.p_partkey <> b.p_partkey
          and {sim('a.p_name', 'b.p_name')} >= 0.6 and {sim('a.p_type', 'b.p_type')} >= 0.5),
        best as (select * from pairs qualify row_number() over (partition by x order by score desc, y) <= 3)
        select distinct least(x, y) as id_a, greatest(x, y) as id_b, score from best""",
    "match_groups_hubs": f"""with {DOC_GROUPS}
        select id_b as id, id_a as root from l union select id_a, id_a from l""",
    "chain_scores_part": f"""with pairs as (select a.p_partkey as x,
          round((2.0::double + {sim('a.p_name', 'b.p_name')}) / 3.0::double, 6) as score
          from part a join part b on a.p_brand = b.p_brand and a.p_type = b.p_type and a.p_partkey <> b.p_partkey
          and {sim('a.p_name', 'b.p_name')} >= 0.7)
        select x as id, max(score) as score, 'name' as rule_id from pairs group by x""",
    "resolve_array_person": f"""with recursive {NORMAL}, c as (select distinct id, unnest([email, phone]) as k from pn),
        {stars('c', 'id', ['k'], 'l')}, {reach('l', 'grp')}
        select p.id as "sourceId", coalesce(g.root, p.id) as "matchId", case when g.root is not null then 1.0::double end as "confidenceScore",
          case when g.root is not null then 'Rule-1' end as "ruleId" from person p left join grp g on g.id = p.id""",
    "model_links_person": f"""with {NORMAL}, {similar('pn', 'id', ['postal_code'], {'first_name': 0.6}, 'm')},
        p as (select id_a, id_b from m_pairs union all select id_a, id_b from m_copies),
        z as (select id_a, id_b, -6.0::double + {' + '.join(
            f"{w}::double * coalesce({sim(f'a.{c}', f'b.{c}')}, 0) + {v}::double * case when a.{c} is null or b.{c} is null then 1 else 0 end"
            for c, w, v in [('first_name', 2.0, -0.5), ('last_name', 3.0, -0.5), ('address', 2.5, 0.25), ('email', 1.5, 0.75)])} as z
          from p join pn a on a.id = id_a join pn b on b.id = id_b)
        select id_a, id_b, round(1 / (1 + exp(-z)), 6) as score from z where round(1 / (1 + exp(-z)), 6) >= 0.6""",
    "em_weights_person": f"{EM} " + " union all ".join(
        f"select '{c}' as field, round(m_{c}, 6) as m, round(u_{c}, 6) as u, round(share, 6) as share from t6" for c in EM_LEAST),
    "em_links_person": f"""{EM}, z as (select id_a, id_b, share / (1 - share) * {EM_ODDS} as odds from levels, t6)
        select id_a, id_b, round(odds / (1 + odds), 6) as score from z where round(odds / (1 + odds), 6) >= 0.9""",
    "merge_ordered_orders": f"""with {ORDERS_MERGED},
        s as (select *, case when o_orderkey % 3 <> 0 then 1 end as seq from new union all
          select * replace (0.5::double as o_totalprice), 2 from new where o_orderkey % 4 = 0),
        l as (select * from s qualify row_number() over (partition by o_orderkey order by seq desc nulls last) = 1),
        c as (select count(*) filter (o_orderkey not in (select o_orderkey from old)) as inserted,
          count(*) filter (o_orderkey in (select o_orderkey from old)) as updated, 0::bigint as rejected,
          (select count(*) from s) - count(*) as superseded, (select count(*) from s) as total from l)
        select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey,
          case when n.o_orderkey is not null then n.o_custkey else o.o_custkey end as o_custkey,
          case when n.o_orderkey is not null then n.o_orderstatus else o.o_orderstatus end as o_orderstatus,
          case when n.o_orderkey is not null then n.o_totalprice else o.o_totalprice end as o_totalprice,
          case when n.o_orderkey is not null then n.o_orderpriority else o.o_orderpriority end as o_orderpriority,
          case when n.o_orderkey is not null then '{AS_OF}' else '2020-01-01 00:00:00' end as "LAST_UPDATED", c.*
        from old o full join l n on n.o_orderkey = o.o_orderkey cross join c""",
    "json_array_customer": "select c_custkey as id, c_name as name, c_acctbal as balance from customer",
    "load_typed_csv": """select c_custkey as id, 'say "' || c_name || '", x' as name,
          case when c_custkey % 5 <> 1 then c_nationkey end as nation, case when c_custkey % 5 <> 3 then 1.5::double end as rate,
          case when c_custkey % 5 <> 4 then '2024-02-29' end as since from customer where c_custkey % 5 <> 2
        union all select count(*), 'rejects', null, null, null from customer where c_custkey % 5 = 2""",
    "load_json_rejects": """with k as (select c_custkey as id, case c_custkey % 7 when 1 then 'object' when 4 then 'object' when 2 then 'value'
          when 3 then 'array' else 'record' end as kind from customer)
        select kind, count(*) as n, cast(sum(id) filter (kind = 'record') as bigint) as id_sum from k group by kind""",
    "process_mapped_customer": f"""select cast(c_custkey as varchar) as "ID", c_name as "NAME",
        case when c_mktsegment is null or c_nationkey is null then cast(c_custkey as varchar) else
          min(cast(c_custkey as varchar)) over (partition by c_mktsegment, c_nationkey) end as "MATCH_ID" from customer""",
    "process_mapped_files": f"""select cast(c_custkey as varchar) as "ID", c_name as "NAME",
        case when c_mktsegment is null or c_nationkey is null then cast(c_custkey as varchar) else
          min(cast(c_custkey as varchar)) over (partition by c_mktsegment, c_nationkey) end as "MATCH_ID" from customer""",
    "process_provider_person": f"""with {NORMAL}, ref as (select email as e, min('P-' || postal_code) as pid
          from pn where source = 'crm' and email is not null group by 1),
        m as (select pn.id, ref.pid from pn left join ref on ref.e = pn.email)
        select id as "ID", case when pid is null then id else min(id) over (partition by pid) end as "MATCH_ID",
          (select count(*) from m) as loaded from m""",
}
ORACLES["stream_feed_orders"] = ORACLES["change_feed_orders"]
ORACLES["chain_steps_part"] = ORACLES["chain_scores_part"]
ORACLES["topk_steps_part"] = ORACLES["topk_part_split"]
