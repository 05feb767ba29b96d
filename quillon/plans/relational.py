"""Queries of joins, aggregates, windows and table operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import claims, layout, tables
from .catalog import query
from .domain import oracle_with

MONEY, SUM = "decimal(18,2)", "decimal(28,2)"


# --- joins ---------------------------------------------------------------------------
@query(f"""{oracle_with("claims", "docs", "cases", "companies")}, t as (select doc_id, root, cast(sum(value_brl) as {SUM}) as face, count(*) as n from claims group by doc_id, root)
  select t.doc_id, t.root, t.face, t.n, co.name, d.doc_type, d.case_number, ca.stage, r.r_name as region
  from t left join companies co on co.root = t.root left join docs d on d.doc_id = t.doc_id left join cases ca on ca.case_number = d.case_number
  left join nation n on n.n_nationkey = co.nationkey left join region r on r.r_regionkey = n.n_regionkey where t.n >= 1 and coalesce(ca.stage, '') <> 'CLOSED'""")
def star_join_left(d):
    t = d.view("claims").groupBy("doc_id", "root").agg(F.sum("value_brl").cast(SUM).alias("face"), F.count("*").alias("n"))
    places = d.table("nation").join(d.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_nationkey").alias("nationkey"), F.col("r_name").alias("region"))
    out = t.join(d.view("companies").select("root", "name", "nationkey"), "root", "left").join(d.view("docs").select("doc_id", "doc_type", "case_number"), "doc_id", "left")
    out = out.join(d.view("cases").select("case_number", "stage"), "case_number", "left").join(places, "nationkey", "left")
    return out.filter(F.coalesce("stage", F.lit("")) != "CLOSED").select("doc_id", "root", "face", "n", "name", "doc_type", "case_number", "stage", "region")


@query(f"{oracle_with('claims', 'docs')} select doc_id, doc_type from docs where doc_id in (select doc_id from claims where class = 'III')")
def semi_documents(d):
    return d.view("docs").join(d.view("claims").filter("class = 'III'").select("doc_id"), "doc_id", "left_semi").select("doc_id", "doc_type")


@query(f"{oracle_with('claims', 'docs')} select doc_id, doc_type, total from docs where not exists (select 1 from claims c where c.doc_id = docs.doc_id)")
def anti_unprocessed(d):
    return d.view("docs").join(d.view("claims").select("doc_id"), "doc_id", "left_anti").select("doc_id", "doc_type", "total")


@query(f"{oracle_with('claims', 'companies')} select nature, count(*) as n_roots, cast(sum(balance) as {SUM}) as balance from (select distinct root from claims where class = 'III') join companies using (root) group by nature")
def using_derived(d):
    roots = d.view("claims").filter("class = 'III'").select("root").distinct()
    return roots.join(d.view("companies"), "root").groupBy("nature").agg(F.count("*").alias("n_roots"), F.sum("balance").cast(SUM).alias("balance"))


@query(f"""{oracle_with("cases", "docs")} select c.segment, count(distinct c.case_number) as n_cases, count(distinct d.doc_id) as n_docs
  from cases c left join docs d on d.case_number = c.case_number and d.status = 'OK' and d.doc_type in ('QGC', 'AJ_LIST') group by c.segment""")
def left_join_on_filter(d):
    good = d.view("docs").filter("status = 'OK' and doc_type in ('QGC', 'AJ_LIST')").select("case_number", "doc_id")
    joined = d.view("cases").join(good, "case_number", "left")
    return joined.groupBy("segment").agg(F.count_distinct("case_number").alias("n_cases"), F.count_distinct("doc_id").alias("n_docs"))


@query(f"{oracle_with('claims', 'docs')} select doc_id, (select count(*) from claims c where c.doc_id = docs.doc_id) as n_claims from docs")
def scalar_count(d):
    n = d.view("claims").groupBy("doc_id").agg(F.count("*").alias("n_claims"))
    return d.view("docs").select("doc_id").join(n, "doc_id", "left").fillna(0, ["n_claims"])


@query("""select event_id, user_id, (select min(p.at) from (select user_id, cast(floor(epoch(ts)) as bigint) as at from events where event_type = 'purchase') p where p.user_id = e.user_id and p.at >= cast(floor(epoch(e.ts)) as bigint)) as next_purchase
  from events e where event_type <> 'purchase'""")
def asof_section(d):
    e = d.table("events").select("event_id", "user_id", F.unix_timestamp("ts").alias("at"), "event_type")
    marks = e.filter("event_type = 'purchase'").select("user_id", F.col("at").alias("next_purchase"))
    out = tables.forward_nearest(e.filter("event_type <> 'purchase'").select("event_id", "user_id", "at"), marks, "user_id", "at", "next_purchase")
    return out.select("event_id", "user_id", "next_purchase")


@query("""with w as (select l_orderkey as doc, cast(l_linenumber % 2 as int) as page, cast(l_quantity * 10 as double) as top, l_returnflag as f from lineitem),
  a as (select distinct doc, page, top as anchor_top from w where f = 'A'), o as (select distinct doc, page, top from w where f = 'N'),
  j as (select o.*, a.anchor_top, abs(o.top - a.anchor_top) as distance from o join a on a.doc = o.doc and a.page = o.page where abs(o.top - a.anchor_top) <= 47)
  select doc, page, top, arg_min(anchor_top, distance * 100000 + anchor_top) as anchor_top, min(distance) as distance from j group by doc, page, top""")
def nearest_bounded(d):
    w = d.table("lineitem").select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") % 2).cast("int").alias("page"), (F.col("l_quantity") * 10).alias("top"), F.col("l_returnflag").alias("f"))
    o, a = w.filter("f = 'N'").select("doc", "page", "top").distinct(), w.filter("f = 'A'").select("doc", "page", "top").distinct()
    return layout.nearest_anchor(o, a, ["doc", "page"], F.lit(10.0))


@query(f"""{oracle_with("claims")}, known as (select root from claims where class = 'III' group by root having count(*) > 190)
  select c_custkey as key, case when lpad(cast(c_custkey % 100 as varchar), 8, '0') in (select root from known) then lpad(cast(c_custkey % 100 as varchar), 8, '0')
    when lpad(cast(c_custkey % 37 as varchar), 8, '0') in (select root from known) then lpad(cast(c_custkey % 37 as varchar), 8, '0')
    when lpad(cast(c_custkey % 11 as varchar), 8, '0') in (select root from known) then lpad(cast(c_custkey % 11 as varchar), 8, '0') end as found from customer""")
def fallback_lookup(d):
    known = d.view("claims").filter("class = 'III'").groupBy("root").agg(F.count("*").alias("n")).filter("n > 190").select("root")
    code = lambda m: F.lpad((F.col("c_custkey") % m).cast("string"), 8, "0")
    ids = d.table("customer").select(F.col("c_custkey").alias("key"), F.array(code(100), code(37), code(11)).alias("ids"))
    return tables.first_known(ids, "key", "ids", known, "root")


@query(f"""{oracle_with("cases")}, o as (select case_number, 0.5 as recovery, 'override' as source from cases where custkey % 9 = 0)
  select custkey, cast(coalesce(o.recovery, case stage when 'ACTIVE' then 0.3 when 'CLOSED' then 0.15 else 0.25 end) as double) as recovery, coalesce(o.source, 'band default') as source from cases left join o using (case_number)""")
def override_join(d):
    c = d.view("cases")
    o = c.filter("custkey % 9 = 0").select("case_number", F.lit(0.5).alias("_r"), F.lit("override").alias("_s"))
    default = F.when(F.col("stage") == "ACTIVE", 0.3).when(F.col("stage") == "CLOSED", 0.15).otherwise(0.25)
    return c.join(o, "case_number", "left").select("custkey", F.coalesce("_r", default).alias("recovery"), F.coalesce("_s", F.lit("band default")).alias("source"))


@query(f"""{oracle_with("claims", "docs")} select distinct d.doc_id, lpad(cast(d.custkey % 100 as varchar), 8, '0') as debtor_root, exists (select 1 from claims c where c.doc_id = d.doc_id and c.root = lpad(cast(d.custkey % 100 as varchar), 8, '0')) as is_creditor from docs d""")
def kin_reject(d):
    docs = d.view("docs").select("doc_id", F.lpad((F.col("custkey") % 100).cast("string"), 8, "0").alias("debtor_root"))
    hit = d.view("claims").select("doc_id", F.col("root").alias("debtor_root")).distinct().withColumn("hit", F.lit(True))
    return docs.join(hit, ["doc_id", "debtor_root"], "left").select("doc_id", "debtor_root", F.coalesce("hit", F.lit(False)).alias("is_creditor"))


_SNAP = "select root, class, cast(sum(value_brl) as decimal(18,2)) as face from claims where {w} group by root, class"
_SNAPS = f"old as ({_SNAP.format(w='page <= 5')}), new as ({_SNAP.format(w='page >= 2 and (row_index % 3 > 0 or page < 5)')})"


@query(f"""{oracle_with("claims")}, {_SNAPS}
  select o.root, o.class, o.face as old_value, n.face as new_value, cast(n.face - o.face as decimal(19,2)) as delta,
    case when n.root is null then 'NOT_IN_NEW_RUN' when o.face is not distinct from n.face then 'SAME' else 'CHANGED' end as verdict
  from old o left join new n on n.root = o.root and n.class is not distinct from o.class""")
def diff_join(d):
    c = d.view("claims")
    snap = lambda w: c.filter(w).groupBy("root", "class").agg(F.sum("value_brl").cast(MONEY).alias("face"))
    return tables.diff(snap("page <= 5"), snap("page >= 2 and (row_index % 3 > 0 or page < 5)"), ["root", "class"], "face")


@query(f"""{oracle_with("claims")}, old as (select doc_id, root, cast(sum(value_brl) as {MONEY}) as face from claims where page <= 5 group by 1, 2), new as (select doc_id, root, cast(sum(value_brl) as {MONEY}) as face from claims where page >= 2 and (row_index % 3 > 0 or page < 5) group by 1, 2)
  select coalesce(o.doc_id, n.doc_id) as doc_id, coalesce(o.root, n.root) as root, o.face as old_value, n.face as new_value, cast(n.face - o.face as decimal(19,2)) as delta,
    case when o.root is null then 'NEW_ONLY' when n.root is null then 'NOT_IN_NEW_RUN' when o.face is not distinct from n.face then 'SAME' else 'CHANGED' end as verdict
  from old o full outer join new n on n.root = o.root and n.doc_id = o.doc_id""")
def diff_full(d):
    """Two snapshots by document and company, whole, in both directions."""
    c = d.view("claims")
    snap = lambda w: c.filter(w).groupBy("doc_id", "root").agg(F.sum("value_brl").cast(MONEY).alias("face"))
    return tables.diff(snap("page <= 5"), snap("page >= 2 and (row_index % 3 > 0 or page < 5)"), ["doc_id", "root"], "face", new_only=True)


# --- aggregates ----------------------------------------------------------------------
@query(f"""{oracle_with("claims")} select doc_id, root, value_brl, class, count(*) as n_rows, min(page) as first_page from claims where value_brl is not null group by doc_id, root, value_brl, class""")
def exact_dedupe(d):
    kept = d.view("claims").filter("value_brl is not null")
    return kept.groupBy("doc_id", "root", "value_brl", "class").agg(F.count("*").alias("n_rows"), F.min("page").alias("first_page"))


@query(f"""{oracle_with("claims")}, u as (select distinct doc_id, root, page, value_brl, class, flag from claims where class = 'III' and value_brl is not null)
  select root, cast(sum(value_brl) as {SUM}) as face, count(*) as n_claims, count(distinct page) as n_pages, array_to_string(list_sort(list(distinct flag) filter (flag is not null)), '|') as flags, case when sum(value_brl) >= 10000000 then 'FLOOR' when sum(value_brl) >= 8000000 then 'POOL' end as band from u group by root""")
def root_rollup(d):
    u = d.view("claims").filter("class = 'III' and value_brl is not null").select("doc_id", "root", "page", "value_brl", "class", "flag").distinct()
    out = u.groupBy("root").agg(F.sum("value_brl").cast(SUM).alias("face"), F.count("*").alias("n_claims"), F.count_distinct("page").alias("n_pages"), F.array_sort(F.collect_set("flag")).alias("f"))
    band = F.when(F.col("face") >= 10_000_000, "FLOOR").when(F.col("face") >= 8_000_000, "POOL")
    return out.select("root", "face", "n_claims", "n_pages", F.array_join("f", "|").alias("flags"), band.alias("band"))


@query("""select p_brand, p_name as longest from (select p_brand, p_name, row_number() over (partition by p_brand order by length(p_name) desc, p_partkey) r from part) where r = 1""")
def longest_name(d):
    return d.table("part").groupBy("p_brand").agg(F.max_by("p_name", F.struct(F.length("p_name"), -F.col("p_partkey"))).alias("longest"))


@query(f"{oracle_with('docs')} select status, doc_type, count(*) as n from docs group by status, doc_type")
def status_counts(d):
    return d.view("docs").groupBy("status", "doc_type").agg(F.count("*").alias("n"))


@query(f"{oracle_with('docs', 'claims')} select d.doc_type, count(distinct d.case_number) as n_cases, count(distinct c.root) as n_roots, count(distinct d.doc_id) as n_docs from docs d left join claims c on c.doc_id = d.doc_id and c.class = 'III' group by d.doc_type")
def coverage_by_key(d):
    c = d.view("claims").filter("class = 'III'").select("doc_id", "root")
    out = d.view("docs").select("doc_id", "doc_type", "case_number").join(c, "doc_id", "left")
    return out.groupBy("doc_type").agg(F.count_distinct("case_number").alias("n_cases"), F.count_distinct("root").alias("n_roots"), F.count_distinct("doc_id").alias("n_docs"))


@query(f"{oracle_with('claims')} select root, section, count(*) as n from claims group by root, section having sum(case when flag = 'CHECKED' and page = 7 then 1 else 0 end) = 0")
def having_zero_success(d):
    out = d.view("claims").groupBy("root", "section").agg(F.count("*").alias("n"), F.count_if((F.col("flag") == "CHECKED") & (F.col("page") == 7)).alias("ok"))
    return out.filter("ok = 0").drop("ok")


@query("""select user_id, event_type as top_type from (select user_id, event_type, row_number() over (partition by user_id order by count(*) desc, min(event_id)) r from events group by user_id, event_type) where r = 1""")
def mode_token(d):
    n = d.table("events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))
    return n.groupBy("user_id").agg(F.max_by("event_type", F.struct("n", -F.col("first"))).alias("top_type"))


@query("""with t as (select distinct p_partkey, unnest(string_split(p_name || ' ' || p_type, ' ')) as token from part) select token, count(*) as n from t group by token having count(*) >= 6""")
def doc_frequency(d):
    t = d.table("part").select("p_partkey", F.explode(F.array_distinct(F.split(F.concat_ws(" ", "p_name", "p_type"), " "))).alias("token"))
    return t.groupBy("token").agg(F.count("*").alias("n")).filter("n >= 6")


@query("""with l as (select lang as doc, source as page, unnest(string_split(text, chr(10))) as line from documents), k as (select doc, page, substr(regexp_replace(trim(line), '[0-9]', '#', 'g'), 1, 80) as key from l),
  p as (select doc, count(distinct page) as n_pages from k group by doc), s as (select doc, key, count(distinct page) as on_pages from k where length(key) >= 6 group by doc, key)
  select s.doc, md5(s.key) as key, on_pages, n_pages from s join p using (doc) where n_pages >= 3 and on_pages >= greatest(3, n_pages // 2)""")
def repeated_lines(d):
    from ..functions.text import running_key

    lines = d.table("documents").select(F.col("lang").alias("doc"), F.col("source").alias("page"), F.explode(F.split("text", "\n")).alias("line"))
    out = layout.repeated_lines(lines.select("doc", "page", running_key(F.col("line")).alias("key")), "doc", "page", "key")
    return out.select("doc", F.md5("key").alias("key"), "on_pages", "n_pages")


@query("select l_returnflag as class, l_linestatus as status, median(l_quantity) as mid_quantity, cast(median(cast(l_linenumber as double)) as double) as mid_line from lineitem group by 1, 2")
def median_cols(d):
    return d.table("lineitem").groupBy(F.col("l_returnflag").alias("class"), F.col("l_linestatus").alias("status")).agg(F.median("l_quantity").alias("mid_quantity"), F.median("l_linenumber").alias("mid_line"))


@query(f"""{oracle_with("claims")} select root, round(count(distinct coalesce(class, '?')) * 1.0 / count(*), 6) as distinct_ratio, round(avg(case when value_brl is not null then 1.0 else 0.0 end), 6) as valued_share from claims group by root""")
def distinct_ratio(d):
    share = F.avg(F.when(F.col("value_brl").isNotNull(), 1.0).otherwise(0.0))
    ratio = F.count_distinct(F.coalesce("class", F.lit("?"))) / F.count("*")
    return d.view("claims").groupBy("root").agg(F.round(ratio, 6).alias("distinct_ratio"), F.round(share, 6).alias("valued_share"))


@query(f"""{oracle_with("claims")} select coalesce(class, '?') as class, coalesce(currency, 'BRL') as currency, count(*) as n, cast(sum(value_brl) as {SUM}) as total, count(*) filter (value_brl is null) as missing from claims where coalesce(flag, '') <> 'NOT_A_CLAIM' group by rollup(1, 2)""")
def portfolio_rollup(d):
    c = d.view("claims").filter("coalesce(flag, '') <> 'NOT_A_CLAIM'").select(F.coalesce("class", F.lit("?")).alias("class"), F.coalesce("currency", F.lit("BRL")).alias("currency"), "value_brl")
    return c.rollup("class", "currency").agg(F.count("*").alias("n"), F.sum("value_brl").cast(SUM).alias("total"), F.count_if(F.col("value_brl").isNull()).alias("missing"))


_FUNNEL = ["OK", "QUARANTINED", "OK_NO_TOTALS", "NO_ROWS", "ERROR"]


@query(f"""{oracle_with("docs")}, l as (select unnest({_FUNNEL}) as status) select l.status, count(d.doc_id) as n, count(distinct d.case_number) as n_cases from l left join docs d using (status) group by l.status""")
def funnel_with_zero_rows(d):
    n = d.view("docs").groupBy("status").agg(F.count("*").alias("n"), F.count_distinct("case_number").alias("n_cases"))
    return tables.with_zero_rows(n, "status", _FUNNEL, ["n", "n_cases"])


@query(f"""{oracle_with("cases")}, s as (select case when nationkey % 8 = 0 then null else 'N' || lpad(cast(nationkey as varchar), 2, '0') end as state, balance from cases),
  t as (select state from s where state is not null group by state order by sum(balance) desc, state limit 10),
  b as (select case when state is null then 'NONE' when state in (select state from t) then state else 'OTHERS' end as bucket, balance from s)
  select coalesce(bucket, 'TOTAL') as bucket, count(*) as n, cast(sum(balance) as {SUM}) as balance from b group by rollup(bucket)""")
def topn_others_total(d):
    state = F.when(F.col("nationkey") % 8 != 0, F.concat(F.lit("N"), F.lpad(F.col("nationkey").cast("string"), 2, "0")))
    out = tables.top_and_rest(d.view("cases").select(state.alias("state"), "balance"), "state", "balance", 10)
    return out.select("bucket", "n", F.col("balance").cast(SUM).alias("balance"))


@query(f"""{oracle_with("claims")}, g as (select root, cast(sum(value_brl) as double) as s, cast(max(value_brl) as double) as m from claims group by root) select round(max(s) / sum(s), 9) as largest_group, round(max(m) / sum(s), 9) as largest_row from g""")
def concentration(d):
    out = tables.concentration(d.view("claims"), "root", "value_brl")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query(f"{oracle_with('claims')}, f as (select unnest(string_split(coalesce(flag, 'NONE') || '|' || coalesce(currency, 'NO_CURRENCY'), '|')) as flag from claims) select flag, count(*) as n from f group by flag")
def flag_frequency(d):
    f = d.view("claims").select(F.explode(F.array(F.coalesce("flag", F.lit("NONE")), F.coalesce("currency", F.lit("NO_CURRENCY")))).alias("flag"))
    return f.groupBy("flag").agg(F.count("*").alias("n"))


@query("select event_type, count(*) as n, min(cast(ts as date)) as first_day, max(cast(ts as date)) as last_day from events group by event_type")
def release_window(d):
    return d.table("events").groupBy("event_type").agg(F.count("*").alias("n"), F.min(F.to_date("ts")).alias("first_day"), F.max(F.to_date("ts")).alias("last_day"))


@query(f"{oracle_with('companies')} select nature, sum(cast(situation <> '02' as int))::bigint as n_inactive, sum(cast(substr(activity, 1, 2) in ('64','65','66') as int))::bigint as n_financial, count(*) as n from companies group by nature")
def boolean_tallies(d):
    one = lambda c: F.sum(c.cast("int"))
    return d.view("companies").groupBy("nature").agg(one(F.col("situation") != "02").alias("n_inactive"), one(F.substring("activity", 1, 2).isin("64", "65", "66")).alias("n_financial"), F.count("*").alias("n"))


@query(f"""{oracle_with("docs")} select regexp_replace(case when doc_type = 'PLAN' then 'plan: ' || status when status <> 'OK' then 'status (' || status || ')' else 'kept' end, '(: | \\().*$', '') as reason, count(*) as n from docs group by 1""")
def reason_histogram(d):
    reason = F.when(F.col("doc_type") == "PLAN", F.concat(F.lit("plan: "), "status")).when(F.col("status") != "OK", F.concat(F.lit("status ("), "status", F.lit(")"))).otherwise("kept")
    return d.view("docs").groupBy(F.regexp_replace(reason, r"(: | — | \().*$", "").alias("reason")).agg(F.count("*").alias("n"))


# --- windows and top-k ---------------------------------------------------------------
@query(f"""{oracle_with("docs", "claims")}, n as (select doc_id, count(*) as n_rows from claims group by doc_id),
  u as (select d.*, coalesce(n.n_rows, 0) as n_rows, case status when 'QUARANTINED' then 'PARTIAL_DOC' else status end as st, coalesce(case_number, 'UNKNOWN:' || substr(cast(doc_id as varchar), 1, 10)) as case_key
     from docs d left join n using (doc_id) where (status in ('OK', 'OK_NO_TOTALS') or (status = 'QUARANTINED' and class3_passed)) and doc_type in ('QGC', 'AJ_LIST', 'DEBTOR_LIST', 'UNKNOWN'))
  select case_key, doc_id, doc_type, st as status from (select *, row_number() over (partition by case_key order by case doc_type when 'QGC' then 4 when 'AJ_LIST' then 3 when 'DEBTOR_LIST' then 2 else 1 end desc,
    case st when 'OK' then 3 when 'PARTIAL_DOC' then 2 else 1 end desc, publication_date desc, n_rows desc, doc_id) r from u) where r = 1""")
def best_doc_per_case(d):
    n = d.view("claims").groupBy("doc_id").agg(F.count("*").alias("n_rows"))
    docs = d.view("docs").join(n, "doc_id", "left").fillna(0, ["n_rows"])
    return claims.best_documents(claims.usable_documents(docs)).select("case_key", "doc_id", "doc_type", "status")


@query("""with f as (select o_orderkey as doc, replace(replace(replace(format('{:,.2f}', o_totalprice), ',', 'X'), '.', ','), 'X', '.') as v from orders) select doc, v as value from f""")
def gap_runs(d):
    v = F.translate(F.format_number(F.col("o_totalprice").cast(MONEY), 2), ",.", ".,")
    o = d.table("orders").select(F.col("o_orderkey").alias("doc"), v.alias("v"))
    cut = F.length("v") - 5
    parts = F.array(
        F.struct(F.lit("R$").alias("text"), F.lit(80.0).alias("x0"), F.lit(90.0).alias("x1")),
        F.struct(F.lit("1.5").alias("text"), F.lit(20.0).alias("x0"), F.lit(30.0).alias("x1")),
        F.struct(F.substring("v", F.lit(1), cut).alias("text"), F.lit(100.0).alias("x0"), F.lit(120.0).alias("x1")),
        F.struct(F.substr("v", cut + 1).alias("text"), F.lit(121.5).alias("x0"), F.lit(140.0).alias("x1")),
    )
    frags = o.select("doc", F.explode(parts).alias("p")).select("doc", "p.*")
    return layout.best_value(layout.value_runs(frags, ["doc"]), ["doc"], 140.0)


@query("""select event_id, last_value(case when event_type = 'signup' then event_id end ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) as heading from events""")
def carry_forward_heading(d):
    e = d.table("events").withColumn("h", F.when(F.col("event_type") == "signup", F.col("event_id")))
    return layout.carried(e, "user_id", ["ts", "event_id"], "h", "heading").select("event_id", "heading")


@query("select event_id, coalesce(sum(cast(event_type in ('signup', 'error') as int)) over (partition by user_id order by ts, event_id rows unbounded preceding), 0)::bigint as section from events")
def section_counter(d):
    return layout.sections(d.table("events"), "user_id", ["ts", "event_id"], F.col("event_type").isin("signup", "error")).select("event_id", "section")


@query("""with o as (select *, lead(event_type) over w as nt, lead(value) over w as nv, lag(event_type) over w as pt from events window w as (partition by user_id order by ts, event_id))
  select event_id, case when event_type = 'view' then coalesce(case when nt = 'click' then nv end, null) else value end as value from o where not (event_type = 'click' and coalesce(pt, '') = 'view')""")
def merge_prev(d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = d.table("events").select("*", F.lead("event_type").over(w).alias("nt"), F.lead("value").over(w).alias("nv"), F.lag("event_type").over(w).alias("pt"))
    kept = e.filter(~((F.col("event_type") == "click") & (F.coalesce("pt", F.lit("")) == "view")))
    return kept.select("event_id", F.when(F.col("event_type") != "view", F.col("value")).when(F.col("nt") == "click", F.col("nv")).alias("value"))


@query("select event_id, row_number() over (partition by user_id, event_type order by ts, event_id)::int as row_index from events")
def row_ordinal(d):
    return d.table("events").select("event_id", F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")).alias("row_index"))


@query("""with c as (select c_nationkey as grp, c_custkey, c_name, case c_mktsegment when 'BUILDING' then 1 when 'MACHINERY' then 2 when 'AUTOMOBILE' then 3 when 'HOUSEHOLD' then 4 else 5 end as p from customer), r as (select *, row_number() over (partition by grp order by p, c_custkey) as k from c)
  select grp, max(case when k = 1 then c_name end) as primary_contact, max(case when k = 2 then c_name end) as backup_contact from r where k <= 2 group by grp""")
def ranked_contacts(d):
    seg = F.col("c_mktsegment")
    p = F.when(seg == "BUILDING", 1).when(seg == "MACHINERY", 2).when(seg == "AUTOMOBILE", 3).when(seg == "HOUSEHOLD", 4).otherwise(5)
    out = tables.ranked_contacts(d.table("customer").withColumnRenamed("c_nationkey", "grp"), "grp", p, ["c_custkey", "c_name"])
    return out.select("grp", F.col("primary.c_name").alias("primary_contact"), F.col("backup.c_name").alias("backup_contact"))


@query(f"{oracle_with('claims')}, t as (select root, cast(sum(value_brl) as {SUM}) as face from claims group by root) select root, face, cast(row_number() over (order by face desc, root) as int) as rank from t order by face desc, root limit 15")
def top_n(d):
    t = d.view("claims").groupBy("root").agg(F.sum("value_brl").cast(SUM).alias("face")).orderBy(F.col("face").desc(), "root").limit(15)
    return t.withColumn("rank", F.row_number().over(Window.orderBy(F.col("face").desc(), "root")))


@query("select p_brand, p_partkey, rank::int as rank from (select p_brand, p_partkey, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as rank from part) where rank <= 3")
def cap_per_group(d):
    return tables.top_per_group(d.table("part"), ["p_brand"], [F.col("p_retailprice").desc(), F.col("p_partkey")], 3).select("p_brand", "p_partkey", "rank")


@query(f"""{oracle_with("claims")}, s as (select doc_id, root, sum(value_brl) as face from claims where class = 'III' group by doc_id, root), t as (select *, cast(face as double) / cast(sum(face) over (partition by doc_id) as double) as share from s)
  select doc_id, root, round(share, 9) as share, case when share > 1.001 then null when share >= 2.0/3 then 'BLOCKING' when share >= 0.5 then 'CONTROL' when share > 1.0/3 then 'SWING' end as position from t""")
def share_of_total(d):
    from ..operators.pricing import position

    s = d.view("claims").filter("class = 'III'").groupBy("doc_id", "root").agg(F.sum("value_brl").alias("face"))
    share = F.col("face").cast("double") / F.sum("face").over(Window.partitionBy("doc_id")).cast("double")
    return s.withColumn("share", share).select("doc_id", "root", F.round("share", 9).alias("share"), position(F.col("share")).alias("position"))


@query("select c_custkey, c_name from customer order by md5('7:' || cast(c_custkey as varchar)), c_custkey limit 50")
def seeded_sample(d):
    return tables.seeded_sample(d.table("customer"), "c_custkey", 50).select("c_custkey", "c_name")


# --- writes as queries ---------------------------------------------------------------
@query(f"""{oracle_with("cases")}, old as (select custkey, stage, balance, segment from cases where custkey % 3 <> 0), new as (select custkey, 'NEW' as stage, balance + 1 as balance, 'seg' as segment from cases where custkey % 2 = 0)
  select coalesce(n.custkey, o.custkey) as custkey, case when n.custkey is not null then n.stage else o.stage end as stage, cast(case when n.custkey is not null then n.balance else o.balance end as decimal(19,2)) as balance, case when o.custkey is null then n.segment else o.segment end as segment
  from old o full outer join new n on n.custkey = o.custkey""")
def upsert_subset(d):
    c = d.view("cases").select("custkey", "stage", F.col("balance").cast("decimal(19,2)").alias("balance"), "segment")
    new = c.filter("custkey % 2 = 0").select("custkey", F.lit("NEW").alias("stage"), (F.col("balance") + 1).cast("decimal(19,2)").alias("balance"), F.lit("seg").alias("segment"))
    return tables.upsert(c.filter("custkey % 3 <> 0"), new, "custkey", ["stage", "balance"])


@query("select event_id, user_id, lead(event_id) over (partition by user_id order by ts, event_id) as superseded_by from events")
def supersede_view(d):
    return tables.superseded(d.table("events"), "user_id", "ts", "event_id").select("event_id", "user_id", "superseded_by")


@query(f"{oracle_with('docs')} select doc_id, status from docs where not (status in ('QUARANTINED') or publication_date < date '1996-01-01')")
def reingest_keepset(d):
    from ..sources.sinks import kept_after_reingest

    return kept_after_reingest(d.view("docs").withColumnRenamed("publication_date", "extracted_at"), ["QUARANTINED"], "1996-01-01").select("doc_id", "status")


@query("""select c_custkey, c_name from (select c_custkey, c_name from customer where c_custkey % 2 = 0 union all select c_custkey, 'new' from customer where c_custkey % 3 = 0 and c_custkey % 2 <> 0)""")
def insert_ignore(d):
    c = d.table("customer").select("c_custkey", "c_name")
    return tables.insert_or_ignore(c.filter("c_custkey % 2 = 0"), c.filter("c_custkey % 3 = 0").withColumn("c_name", F.lit("new")), "c_custkey")


@query("""select c_custkey, 'B' as book, c_acctbal as v from customer where c_acctbal > 5000 union all select s_suppkey, 'S', s_acctbal from supplier""")
def stacked_union(d):
    one = d.table("customer").filter("c_acctbal > 5000").select("c_custkey", F.lit("B").alias("book"), F.col("c_acctbal").alias("v"))
    two = d.table("supplier").select(F.col("s_suppkey").alias("c_custkey"), F.lit("S").alias("book"), F.col("s_acctbal").alias("v"))
    return one.unionByName(two)
