"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
with t as (
  select doc_id, coalesce(text, '') as text,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents),
r as (
  select *, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size, row_number() over w as place
  from t window w as (partition by norm order by length(text) desc, doc_id nulls last))
select doc_id, keep_id, group_size, place = 1 as kept, sha256(norm) as text_sha256 from r
"""

QUALITY_RULES = r"""
with t as (
  select doc_id, coalesce(text, '') as text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as solid from documents),
s as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from t),
g as (
  select doc_id, unnest(range(len(w) - 2)) as i, w from s where len(w) >= 3),
h as (
  select doc_id, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] as g from g),
d as (
  select doc_id, i, count(*) over (partition by doc_id, g) as n from h),
p as (
  select doc_id, count(distinct i + k) as n_repeat_words from d, (values (0), (1), (2)) as o(k) where n > 1 group by doc_id),
m as (
  select s.doc_id, len(w) as n_words, length(solid) as word_chars,
    length(solid) - length(regexp_replace(solid, '[#*$%&|<>]', '', 'g')) as n_symbols,
    len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, len(l) as n_lines,
    len(list_filter(w, lambda x: lower(x) in ('the','be','to','of','and','that','have','with','a','in','is','it','for','was','as','are',
      'this','by','from','or','der','die','das','und','ist','von','zu','den','mit','ein','eine','nicht','im','dem','des','auf','als',
      'auch','sich','el','la','los','las','de','que','y','en','un','una','por','con','para','es','su','se','no','le','les','et','du',
      'est','dans','qui','pour','pas','sur','au','une','avec','ce'))) as n_stop_words,
    length(solid) - length(regexp_replace(solid, '\p{L}', '', 'g')) as n_letters,
    length(solid) - length(regexp_replace(solid, '\p{Lu}', '', 'g')) as n_capitals,
    len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*[-*\x{2022}]'))) as n_bullet_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|\x{2026})[ \t\r]*$'))) as n_cut_lines
  from s left join p using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and n_words between 50 and 100000 and word_chars between 2 * n_words and 15 * n_words
  and n_symbols <= n_words * 0.1::double and n_stop_words >= n_words * 0.02::double and n_letters >= word_chars * 0.6::double
  and n_capitals <= n_letters * 0.4::double and n_dup_lines <= n_lines * 0.3::double and n_bullet_lines <= n_lines * 0.9::double
  and n_cut_lines <= n_lines * 0.3::double and n_repeat_words <= n_words * 0.3::double as kept
from b
"""

SOURCE_MIXING = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as solid,
    (('0x' || substr(md5('0:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint + 0.5::double) / 4503599627370496::double as u
  from documents),
k as (
  select *, -ln(u) / greatest(0.05::double, case when solid = '' then 0
    else length(regexp_replace(solid, '\P{L}', '', 'g'))::double / length(solid) end) as draw from d),
s as (
  select source, sum(size)::bigint as source_size from k group by source),
r as (
  select *, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::double as weight, 3.0::double * source_size as cap from s),
q as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (o rows between current row and unbounded following) as level
  from r window o as (order by cap / weight, source nulls last)),
c as (
  select arg_min(level, cap / weight) filter (level <= cap / weight) as level from q),
t as (
  select source, source_size, least(c.level * weight, cap) as target from q, c),
e as (
  select *, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as epochs from t),
x as (
  select k.*, source_size, target, epochs, target - epochs * source_size as rest,
    sum(size) over (partition by k.source order by draw, coalesce(k.doc_id, 9223372036854775807)) as upto,
    sum(size) over (partition by k.source, draw, coalesce(k.doc_id, 9223372036854775807)) as own
  from k join e on k.source is not distinct from e.source)
select doc_id, size, source_size, target,
  (epochs + case when rest > 0 and (upto <= rest or (upto - own < rest and upto - rest < rest - (upto - own))) then 1 else 0 end) * size as taken
from x
"""

JACCARD_JOIN = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
s as materialized (
  select doc_id, unnest(case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from w),
n as materialized (
  select doc_id, count(*) as n from s group by doc_id),
p as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as materialized (
  select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)),
e as (
  select x, y from l union all select y, x from l),
r as (
  select x as id, x as node from e union select r.id, e.y from r join e on e.x = r.node)
select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(g.root, w.doc_id) as component_id
from w left join n on n.doc_id = w.doc_id left join (select id, min(node) as root from r group by id) g on g.id = w.doc_id
"""

WARC = r"""
with p as (
  select page_id, encode(coalesce(html, '')) as payload from pages),
g as (
  select *, max(page_id) over (partition by payload) as top, count(*) over (partition by payload) as n, sha1(payload) as h from p)
select page_id, octet_length(payload)::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (i // 4 * 5 + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int + 1, 1)), '') as payload_digest,
  case when n > 1 and page_id is distinct from top then 'revisit' else 'response' end as record_type,
  case when n > 1 and page_id is distinct from top then top end as refers_to
from g
"""


COLLOCATIONS = r"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
s as (
  select lang, sum(len(w))::bigint as n from w group by lang),
g as materialized (
  select lang, words, phrase, count(*) as f from (
    select lang, words, array_to_string(w[i + 1 : i + words], ' ') as phrase
    from (select lang, w, words, unnest(range(len(w) - words + 1)) as i from w, range(1, 6) t(words) where len(w) >= words))
  group by all having count(*) >= 100),
c as (
  select lang, phrase, words, f as a, k, string_split(phrase, ' ') as v from g, range(1, 5) t(k) where k < words),
x as (
  select c.lang, c.phrase, a, k, l.f as l, r.f as r, n, ((1000::hugeint * a * n) // (l.f::hugeint * r.f))::bigint as score
  from c join g l on l.lang = c.lang and l.phrase = array_to_string(v[1 : k], ' ')
    join g r on r.lang = c.lang and r.phrase = array_to_string(v[k + 1 : c.words], ' ') join s on s.lang = c.lang),
b as (
  select lang, phrase, a, n, min({'score': score, 'k': k, 'l': l, 'r': r}) as b from x group by lang, phrase, a, n),
i as (
  select lang, array_to_string(v[o : o + m - 1], ' ') as phrase, max(f) as most
  from (select *, string_split(phrase, ' ') as v from g), range(2, 5) t(m), range(1, 5) u(o) where m < words and o + m - 1 <= words group by all),
d as (
  select b.*, b.b.score as score from b left join i on i.lang = b.lang and i.phrase = b.phrase where most is null or 100 * most < 100 * a),
q as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from d)
select lang, rank, phrase, a, b.l as l, b.r as r, n, score from q where rank <= 2000
"""


def _sharding(shards: int = 24) -> str:
    """A level of the tree is a step: nodes' widths, the rows' order in the widest dimension, running bytes."""
    def code(column: str, same: str) -> str:
        return f"coalesce(('0x' || rpad(substr(hex(encode({column})), 2 * {same} + 1, 14), 14, '0'))::bigint, -1)"

    def common(column: str) -> str:
        a, b = f"hex(encode(min({column})))", f"hex(encode(max({column})))"
        return f"list_min(list_filter(range(length({a}) // 2 + 1), lambda i: substr({a}, 2 * i + 1, 2) <> substr({b}, 2 * i + 1, 2) or 2 * i >= length({a})))"

    steps = [f"""
with crc as materialized (
  select list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) as t),
g as (
  select {common('source')} as same_source, {common('lang')} as same_lang, min(n_chars) as least from documents),
d as materialized (
  select doc_id, octet_length(encode(coalesce(text, '')))::bigint + 8 as size,
    xor(list_reduce([4294967295::bigint] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda x: ('0x' || x)::bigint), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295)::bigint as text_crc32,
    {code('source', 'same_source')} as x0, {code('lang', 'same_lang')} as x1, coalesce(n_chars, least - 1)::bigint as x2 from documents, g, crc),
e as (
  select max(x0) - min(x0) as e0, max(x1) - min(x1) as e1, max(x2) - min(x2) as e2 from d),
n0 as materialized (select *, 0 as f, {shards} as m from d)"""]
    level, widest = 0, shards
    while widest > 1:
        widths = ", ".join(
            f"coalesce((max(x{i}) over w - min(x{i}) over w)::double / nullif(e{i}, 0)::double, 0) as w{i}" for i in range(3))
        steps.append(f"""
w{level} as (
  select n.*, {widths}, sum(size) over w as total from n{level} n, e window w as (partition by f)),
o{level} as (
  select *, case when w0 >= w1 and w0 >= w2 then x0 when w1 >= w2 then x1 else x2 end as x from w{level}),
r{level} as (
  select *, sum(size) over (partition by f order by x, doc_id rows unbounded preceding) as upto from o{level}),
n{level + 1} as materialized (
  select doc_id, size, text_crc32, x0, x1, x2, case when m = 1 or m * (2 * upto - size) <= 2 * (m // 2) * total then f else f + m // 2 end as f,
    case when m = 1 then 1 when m * (2 * upto - size) <= 2 * (m // 2) * total then m // 2 else m - m // 2 end as m from r{level})""")
        level, widest = level + 1, widest - widest // 2
    return ",".join(steps) + f"""
select doc_id, size, text_crc32, 'bytes' as law, f::int as shard,
  row_number() over (partition by f order by substr(md5(doc_id::varchar), 1, 13), doc_id) - 1 as slot, null::int as grown_shard
from n{level}
"""


def _vector_codes(rounds: int = 6) -> str:
    """A round is two steps: the nearest entry of every part, then the entries' means rounded down."""
    steps = ["""
with k as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(x::double * 4096)::bigint) as v from embeddings
  where embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
p as materialized (
  select vec_id, label, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] as x from k, range(8) t(p)),
c0 as materialized (
  select p, row_number() over (partition by p order by vec_id) - 1 as e, x as c from p
  where vec_id in (select vec_id from k order by vec_id limit 16))"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (
  select vec_id, any_value(label) as label, p.p, any_value(x) as x,
    min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, 'e': e}}) as best
  from p join c{r} c on c.p = p.p group by vec_id, p.p)""")
        if r < rounds:
            steps.append(f"""
s{r} as (
  select p, e, list((s - ((s % n) + n) % n) // n order by i) as c from (
    select p, best.e as e, i, sum(x[i])::hugeint as s, count(*) as n from a{r}, range(1, 257) t(i) where i <= len(x) group by all) group by p, e),
c{r + 1} as materialized (
  select c{r}.p, c{r}.e, coalesce(s{r}.c, c{r}.c) as c from c{r} left join s{r} on s{r}.p = c{r}.p and s{r}.e = c{r}.e)""")
    return ",".join(steps) + f""",
h as (
  select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from c{rounds}),
z as (
  select vec_id, any_value(label) as label, string_agg(printf('%02x', best.e), '' order by p) as code, sum(best.d)::bigint as error from a{rounds} group by vec_id)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256 from z, h
"""


ORACLES = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op4_quality_rules": QUALITY_RULES,
    "op5_jaccard_join": JACCARD_JOIN,
    "op6_warc": WARC,
    "op8_source_mixing": SOURCE_MIXING,
    "op11_vector_codes": _vector_codes(),
    "op12_collocations": COLLOCATIONS,
    "op13_sharding": _sharding(),
}
