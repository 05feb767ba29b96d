"""Registered queries of this subpackage and their oracle SQL.

Operators 3, 6, 8, 11, 12 and 13 can be put in SQL whole.  The others use hashes, models or
byte n-grams that DuckDB has not; the tests hold them against brute force.  Of
operators 1, 2, 7 and 9 the parts without a model are queries of their own, which
select from the operator's result and have SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import covertree, crf, decontaminate, langmodel, linedup, mixing, quality_rules, repair, secrets, simhash, substring, turntrie, urlfilter

QUERIES = {
    "op1_secret_scans": secrets.op1_secret_scans,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_substring_dedup": substring.op3_substring_dedup,
    "op4_simhash_near_dedup": simhash.op4_simhash_near_dedup,
    "op5_lm_scoring": langmodel.op5_lm_scoring,
    "op6_line_dedup": linedup.op6_line_dedup,
    "op7_url_filters": urlfilter.op7_url_filters,
    "op8_benchmark_decontamination": decontaminate.op8_benchmark_decontamination,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_quality_classifier": crf.op10_quality_classifier,
    "op11_conversation_prefix_trie": turntrie.op11_conversation_prefix_trie,
    "op12_conversation_structure_repair": repair.op12_conversation_structure_repair,
    "op13_exact_topk_search": covertree.op13_exact_topk_search,
}


def secret_spans_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op1_secret_scans(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def quality_rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.op2_quality_rules(spark, sf_dir)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = urlfilter.op7_url_filters(spark, sf_dir)
    return out.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("rule_verdict"))


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.op9_mix_sources(spark, sf_dir)
    return out.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), (F.col("taken") <= 3 * F.col("size")).alias("in_bounds"))


QUERIES |= {f.__name__: f for f in (secret_spans_base, quality_rules_base, url_rules, mix_targets)}


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of an ASCII string, bit by bit."""
    step = "lambda y, z: xor(y >> 1, 3988292384::ubigint * (y & 1))"
    byte = f"lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]), {step})"
    return f"cast(xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split({text}, ''), lambda c: ascii(c)::ubigint)), {byte}), 4294967295::ubigint) as bigint)"


_ASSIGN = secrets.BASE[0][1].replace("'", "''")
ORACLE_SQL: dict[str, str] = {
    "secret_spans_base": rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
  m as (select rid, 0 as kind_no, 'assign' as kind, 12 as least, regexp_extract_all(t, '{_ASSIGN}') as w, regexp_extract_all(t, '{_ASSIGN}', 2) as g, regexp_split_to_array(t, '{_ASSIGN}') as b from d
    union all select rid, 1, 'access', 18, regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_split_to_array(t, 'AKIA[A-Z0-9]+') from d
    union all select rid, 2, 'hex', 16, regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'), regexp_split_to_array(t, '[0-9a-f]+') from d),
  s as (select rid, kind_no, kind, unnest(list_filter(range(1, len(w) + 1), lambda i: length(g[i]) >= least)) as i, w, b from m),
  x as (select rid, kind_no, kind, length(array_to_string(b[1:i], '')) + length(array_to_string(w[1:i - 1], '')) as a, length(w[i]) as n from s),
  o as (select rid, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex, string_agg(kind || ':' || a || ':' || (a + n), ',' order by a, kind_no) as spans from x group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(spans, '')) as base_sha256 from d left join o using (rid)""",
    "quality_rules_base": r"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
  w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d),
  k as (select rid, i, array_to_string(w[i:i + 2], ' ') as g from (select rid, w, unnest(range(1, len(w) - 1)) as i from w where len(w) >= 3)),
  c as (select rid, i, count(*) over (partition by rid, g) as n from k),
  r as (select rid, count(distinct p) as n from (select rid, unnest(range(i, i + 3)) as p from c where n > 1) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars, cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
  cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(coalesce(r.n, 0) as bigint) as n_repeat_words, len(w) < 50 or 100 * coalesce(r.n, 0) > 50 * len(w) as base_failed from w left join r using (rid)""",
    "url_rules": r"""
with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
  m as (select page_id, regexp_extract(rest, '^([^?#]*)', 1) as m from u),
  h as (select page_id, translate(split_part(m, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, substr(m, length(split_part(m, '/', 1)) + 1) as path from m),
  r as (select *, case when starts_with(path, '/en/7') and ends_with('.' || host, '.example.com') then 'example.com/en/7' when starts_with(path, '/de/8') and ends_with('.' || host, '.example.net') then 'example.net/de/8'
    when starts_with(path, '/en/') and ends_with('.' || host, '.com') then 'com/en/' when starts_with(path, '/de/') and ends_with('.' || host, '.net') then 'net/de/' when starts_with(path, '/es/') and ends_with('.' || host, '.org') then 'org/es/' end as rule from h)
select page_id, host, path, rule, case when rule = 'example.com/en/7' then 'allow' when rule is not null then 'block' end as rule_verdict from r""",
    "mix_targets": r"""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
  p as (select source, sum(size) as s, row_number() over (order by source nulls last) as k from d group by source),
  q as (select *, [5.0, 2.0, 1.0][cast((k - 1) % 3 + 1 as int)] as w from p),
  l as (select a.k, 3.0 * a.s / a.w as full_at, (sum(b.s) - sum(case when 3.0 * b.s / b.w < 3.0 * a.s / a.w then 3.0 * b.s else 0 end)) / sum(case when 3.0 * b.s / b.w >= 3.0 * a.s / a.w then b.w else 0 end) as level from q a, q b group by a.k, a.s, a.w),
  v as (select min_by(level, full_at) as level from l where level <= full_at)
select doc_id, size, cast(s as bigint) as source_size, round(cast(least(3.0 * s, level * w) as double), 3) as target, true as in_bounds from d join q on d.source is not distinct from q.source, v""",
    "op3_substring_dedup": r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
  s as (select rid, doc_id, unnest(range(1, len(w) - 48)) as i, w from d where len(w) >= 50),
  k as (select rid, doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) as h from s),
  f as (select h, min(doc_id) as least from k group by h),
  g as (select distinct rid, unnest(range(i, i + 50)) as pos from k join f using (h) where least < doc_id),
  p as (select rid, unnest(range(1, len(w) + 1)) as pos, unnest(w) as word from d),
  t as (select p.rid, count(g.pos) as n_removed, string_agg(case when g.pos is null then word end, ' ' order by p.pos) as kept
    from p left join g on g.rid = p.rid and g.pos = p.pos group by p.rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join t using (rid)""",
    "op6_line_dedup": r"""
with d as (select row_number() over (order by doc_id nulls last, text nulls last) as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as ls, coalesce(text, '') = '' as bare from documents),
  l as (select rid, doc_id, unnest(range(0, len(ls))) as no, unnest(ls) as line from d),
  t as (select rid, no, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) as s from l where doc_id is not null),
  m as (select rid, no, rid * 1000000 + no as place, s from t where len(s) >= 1),
  u as (select row_number() over () as id, s, len(s) as n, min(place) as first_at from m group by s),
  e as (select id, n, unnest(s) as tok from u),
  f as (select tok, count(*) as df from e group by tok),
  r as (select id, n, tok, row_number() over (partition by id order by df, tok) as pos from e join f using (tok)),
  x as (select id, n, tok from r where pos <= n - (4 * n + 4) // 5 + 1),
  c as (select distinct a.id as a, b.id as b from x a join x b on a.tok = b.tok and a.id < b.id and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
  v as (select c.a, c.b from c join u p on p.id = c.a join u q on q.id = c.b where 9 * len(list_intersect(p.s, q.s)) >= 4 * (p.n + q.n)),
  w as (select a as id, b as other from v union all select b, a from v union all select id, id from u),
  z as (select w.id, min(u.first_at) as earliest from w join u on u.id = w.other group by w.id),
  g as (select m.rid, m.no from m join u using (s) join z on z.id = u.id where z.earliest < m.place),
  k as (select l.rid, count(g.no) as n_removed, string_agg(case when g.no is null then line end, chr(10) order by l.no) as kept from l left join g on g.rid = l.rid and g.no = l.no group by l.rid)
select doc_id, case when bare then 0 else cast(len(ls) as bigint) end as n_lines, n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d join k using (rid)""",
    "op8_benchmark_decontamination": r"""
with lower_case as (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' as a, 'abcdefghijklmnopqrstuvwxyz' as b),
  d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents, lower_case),
  b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark, lower_case),
  i as (select item_id, least(len(w), 10) as k, w from b where len(w) > 0),
  n as (select distinct item_id, k, array_to_string(w[j : j + k - 1], ' ') as win from (select *, unnest(range(1, len(w) - k + 2)) as j from i)),
  s as (select rid, k, unnest(range(1, len(w) - k + 2)) as j, w from d, (select distinct k from i) where len(w) >= k),
  m as (select s.rid, s.j, s.k, n.item_id from s join n on n.k = s.k and n.win = array_to_string(s.w[s.j : s.j + s.k - 1], ' ')),
  h as (select rid, count(distinct pos) as n_hit from (select rid, unnest(range(j, j + k)) as pos from m) group by rid),
  o as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct rid, cast(item_id as varchar) as item from m where item_id is not null) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (rid) left join o using (rid)""",
    "op11_conversation_prefix_trie": f"""
with t as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
  n as (select c, count(*) as n, c - c % 5 as b, {_crc32("cast(c as varchar)")} % 9 as h from t group by c),
  q as (select n.c, t.pos, role, text from n join t on t.c = n.b and t.pos <= n.h union all
    select n.c, t.pos - n.h + least(n.h, coalesce(o.n, 0)), role, text from n join t on t.c = n.c and t.pos > n.h left join n as o on o.c = n.b),
  r as (select c, pos as d, strlen(text) as size, string_agg(md5(length(role) || ':' || role || text), '') over (partition by c order by pos) as pre from q union all select c, 0, 0, '' from n),
  p as (select c, d, size, md5(pre) as pre, lag(md5(pre)) over (partition by c order by d) as up, max(d) over (partition by c) as last from r),
  k as (select pre, d, min(c) as conv_id, count(*) as n_convs, min(size) as size, min(up) as up, string_agg(cast(c as varchar), ',' order by c) filter (d = last) as ends from p group by pre, d),
  m as (select k.*, o.conv_id as parent_conv_id, (select count(*) from k as x where x.up = k.pre and x.d = k.d + 1) as n_children from k left join k as o on o.pre = k.up and o.d = k.d - 1),
  s as (select p.pre, p.d, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * m.size) as saved from m join p on p.c = m.conv_id and p.d <= m.d group by p.pre, p.d)
select conv_id, cast(m.d as bigint) as depth, parent_conv_id, n_convs, n_children, n_leaves, cast(saved as bigint) as saved_tokens, sha256(coalesce(ends, '')) as ends_sha256 from m join s on s.pre = m.pre and s.d = m.d""",
    "op12_conversation_structure_repair": rf"""
with recursive g as (select conv_id, row_number() over () as cid from (select distinct conv_id from conversations)),
  d as (select cid, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as k from conversations join g using (conv_id)),
  r as (select cid, turn, case when k = 4 then 'user' else role end as role, case when k = 1 then '' when k = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(case when k = 0 then [] when k = 3 then [0, 1] else [0] end) as copy from d),
  o as (select *, row_number() over (partition by cid order by turn nulls first, role, text, copy) as i, row_number() over (partition by cid, role, text order by turn nulls first, copy) as seen from r),
  f as (select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 2 when seen > 1 then 3 when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 1 else 0 end as fault,
    case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else 'x' end as x, lag(left(role, 1)) over (partition by cid order by i) as before from o),
  a as (select cid, greatest(coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0), 0) as gaps, count(*) filter (fault = 2) as blank, count(*) filter (fault = 3) as duplicate, count(*) filter (fault = 1) as truncated,
    count(*) filter (before is not null and before || left(role, 1) not in ('su', 'ua', 'au')) as illegal, count(*) as n from f group by cid),
  tr as (select * from (values ('', '', 's'), ('', '', 'u'), ('', 'I', 'a'), ('s', '', 'u'), ('s', 'I', 'a'), ('u', 'I', 'u'), ('u', '', 'a'), ('a', '', 'u'), ('a', 'I', 'a')) v(s, ins, t)),
  w as (select cid, 0::bigint as i, '' as s, {{'c': 0, 'a': ''}} as v from g union all
    select cid, i, s, min(v) from (
      select w.cid, f.i, w.s, {{'c': w.v.c + 2, 'a': w.v.a || 'D'}} as v from w join f on f.cid = w.cid and f.i = w.i + 1 union all
      select w.cid, f.i, tr.t, {{'c': w.v.c + 5 * length(ins) + 5 * fault + case when x = tr.t then 0 else 1 end, 'a': w.v.a || ins || case when x = tr.t then 'K' else 'R' end}} from w join f on f.cid = w.cid and f.i = w.i + 1 join tr on tr.s = w.s where fault < 2 and (x = tr.t or tr.t <> 's')) group by cid, i, s),
  e as (select w.cid, min({{'c': w.v.c + case s when 's' then 10 when 'u' then 5 else 0 end, 'a': w.v.a || case s when 's' then 'II' when 'u' then 'I' else '' end}}) as v from w left join a on a.cid = w.cid where w.i = coalesce(a.n, 0) group by w.cid),
  z as (select cid, audit, unnest(range(1, length(audit) + 1)) as j from (select cid, v.a as audit from e)),
  y as (select cid, substr(audit, j, 1) as op, length(replace(left(audit, j), 'I', '')) as i, length(replace(left(audit, j), 'D', '')) as place, length(replace(audit, 'D', '')) as total from z),
  x as (select y.cid, string_agg(case when op = 'K' then f.role when (total - place) % 2 = 0 then 'assistant' else 'user' end || ':' || case when op = 'I' then '' else f.text end, chr(10) order by place) as repaired
    from y left join f on f.cid = y.cid and f.i = y.i where op <> 'D' group by y.cid)
select conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(e.v.c as bigint) as cost, e.v.a as audit, sha256(coalesce(repaired, '')) as repaired_sha256
from g join e using (cid) left join a using (cid) left join x using (cid)""",
    "op13_exact_topk_search": """
with v as (select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  s as (select q.rid, q.vec_id as query_id, v.vec_id, cast(list_dot_product(q.e, v.e) as bigint) as score from v as q join v on len(v.e) = len(q.e) and v.rid <> q.rid where q.vec_id % 50 = 0),
  r as (select *, row_number() over (partition by rid order by score desc, vec_id nulls last) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 5""",
}
