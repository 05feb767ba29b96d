"""Queries of the dashboard, the operations book's frames and a run's report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import book, dashboard, report, rules
from ..operators.cut import cut
from ..sources import pages
from .catalog import QUERIES, query
from .domain import Domain, oracle_with
from .workbook import _LEADS, _book_rows

SUM, AS_OF = "decimal(28,2)", "2026-02-01"
STATES = ("SP", "RJ", "MG", "RS", "PR", "SC", "BA", "PE", "CE", "GO", "DF", "ES", "")


def _in(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# --- dashboard ------------------------------------------------------------------------
def _stack(d: Domain) -> DataFrame:
    k = F.col("root").cast("bigint")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))
    leads = book.call_frame(_book_rows(d)).withColumns({
        "creditor": F.concat(F.lit("Credor "), "root"), "debtor": F.concat(F.lit("Devedor "), F.substring("case_number", 1, 7)), "status": pick(dashboard.STATUSES), "next_date": F.when(k % 3 == 0, F.date_add(F.lit("2026-01-01").cast("date"), (k % 60).cast("int"))),
        "state": pick(STATES), "fit": pick(dashboard.FITS), "email": F.when(k % 4 == 0, "a@b.c").otherwise(""), "flags": F.when(k % 9 == 0, "no route").otherwise(""),
    })
    leads = cut(leads)
    return dashboard.stacked({b: leads.filter(F.col("book") == b) for b in dashboard.BOOKS})


_STACK = f"""{_LEADS}, b0 as (select *, cast(root as bigint) as k, 'Credor ' || root as creditor from framed),
  st as (select * exclude (premium, fund), cast(premium as decimal(28,2)) as premium, cast(fund as decimal(28,2)) as fund, {_in(dashboard.STATUSES)}[k % {len(dashboard.STATUSES)} + 1] as status, case when k % 3 = 0 then date '2026-01-01' + cast(k % 60 as int) end as next_date, {_in(STATES)}[k % {len(STATES)} + 1] as state, {_in(dashboard.FITS)}[k % {len(dashboard.FITS)} + 1] as fit,
    row_number() over (partition by book order by premium desc, creditor, case_number) + 1 as tab_row from b0),
  tot as (select cast(sum(premium) as double) as p from st), dim as (select 'book' as block, book as label, premium from st union all select 'funnel', status, premium from st union all select 'band', band, premium from st union all select 'fit', fit, premium from st
    union all select 'proof', regexp_extract(proof, '^(OK|NO TOTALS|PARTIAL|CHECK)', 1), premium from st),
  labels as ({" union all ".join(f"select '{b}' as block, {i} as place, '{v}' as label" for b, vs in (("book", dashboard.BOOKS), ("funnel", dashboard.STATUSES), ("band", dashboard.BANDS), ("fit", dashboard.FITS), ("proof", dashboard.PROOFS)) for i, v in enumerate(vs))}),
  chk as (select *, regexp_matches(proof, '^(NO TOTALS|PARTIAL|CHECK)') as tocheck, status in ('INTERESTED', 'TERMS AGREED', 'CESSÃO SIGNED', 'SUBSTITUTED IN LIST') as run from st),
  uf as (select state as label, count(*) as n, sum(premium) as amount, case when state <> '' then row_number() over (partition by state = '' order by count(*) desc, state) end as r from st group by state),
  cs as (select case_number as label, count(*) as n, sum(premium) as amount from st where coalesce(case_number, '') <> '' group by 1),
  tp as (select creditor || ' · ' || book || ' · ' || tab_row as label, premium as amount, row_number() over (order by premium desc, book, tab_row) - 1 as place from st),
  board as (select 'kpi' as block, 0 as place, 'leads' as label, count(*) as n, null::decimal(28,2) as amount, null::double as share from chk union all select 'kpi', 1, 'face', null, sum(face), null from chk union all select 'kpi', 2, 'fund price', null, sum(fund), null from chk
    union all select 'kpi', 3, 'premium', null, sum(premium), null from chk union all select 'kpi', 4, 'on hold', count(*) filter (hold <> ''), coalesce(sum(face) filter (hold <> ''), 0), null from chk
    union all select 'kpi', 5, 'untouched', count(*) filter (status = 'NEW'), null, null from chk union all select 'kpi', 6, 'due', count(*) filter (next_date = date '{AS_OF}'), null, null from chk
    union all select 'kpi', 7, 'overdue', count(*) filter (next_date < date '{AS_OF}' and status not in ('DEAD', 'SETTLED')), null, null from chk union all select 'kpi', 8, 'in progress', count(*) filter (run), coalesce(sum(premium) filter (run), 0), null from chk
    union all select 'kpi', 9, 'settled', count(*) filter (status = 'SETTLED'), coalesce(sum(premium) filter (status = 'SETTLED'), 0), null from chk union all select 'kpi', 10, 'with e-mail', count(*) filter (k % 4 = 0), null, null from chk
    union all select 'kpi', 11, 'no route', count(*) filter (k % 9 = 0), null, null from chk union all select 'kpi', 12, 'proof to check', count(*) filter (tocheck), coalesce(sum(premium) filter (tocheck), 0), null from chk
    union all select l.block, l.place, l.label, count(dim.label), coalesce(sum(premium), 0), null from labels l left join dim on dim.block = l.block and dim.label = l.label group by 1, 2, 3
    union all select 'state', case when label = '' then 11 when r <= 10 then r - 1 else 10 end, case when label = '' then '(none)' when r <= 10 then label else '(other states)' end, sum(n), sum(amount), null from uf group by 2, 3
    union all select 'state', 12, '(all rows)', count(*), sum(premium), null from st union all select 'top', place, label, 1, amount, null from tp where place < 15
    union all select 'case', row_number() over (order by n desc, amount desc, label) - 1, label, n, amount, cast(amount as double) / p from cs, tot qualify row_number() over (order by n desc, amount desc, label) <= 12
    union all (select 'concentration', 0, 'case ' || label, n, amount, cast(amount as double) / p from cs, tot order by amount desc, label limit 1) union all select 'concentration', 1, 'row ' || label, 1, amount, cast(amount as double) / p from tp, tot where place = 0)"""


@query(f"""{_STACK} select block, cast(place as int) as place, label, cast(n as bigint) as n, cast(amount as decimal(28,2)) as amount, round(share, 6) as share from board""")
def book_dashboard(d: Domain):
    """Every block of the dashboard over the three books."""
    out = dashboard.dashboard(cut(_stack(d)), AS_OF)
    return out.select("block", "place", "label", "n", "amount", F.round("share", 6).alias("share"))


@query(f"""{_STACK}, v as (select (select count(*) from st) as rows, (select n from board where block = 'kpi' and label = 'leads') as k, (select sum(n) from board where block = 'band') as b, (select sum(n) from board where block = 'book') as o, (select sum(n) from board where block = 'proof') as p, (select sum(n) from board where block = 'state' and place < 12) as s)
  select "check", cast(n as bigint) as n from (select 'leads' as "check", case when rows <> k then 1 else 0 end as n from v union all select 'bands do not sum', case when rows <> b then 1 else 0 end from v union all select 'books do not sum', case when rows <> o then 1 else 0 end from v
    union all select 'proofs do not sum', case when rows <> p then 1 else 0 end from v union all select 'states do not sum', case when rows <> s then 1 else 0 end from v union all select unnest(['on hold', 'face on hold', 'premium', 'top rows not descending', 'top row twice']), 0)""")
def dashboard_checks(d: Domain):
    """The dashboard against its stack and itself."""
    stack = cut(_stack(d))
    return dashboard.disagreements(stack, cut(dashboard.dashboard(stack, AS_OF)))


# --- operations book ------------------------------------------------------------------
_LEAD_ROWS = f"""t as (select root, doc_id, cast(sum(value_brl) * 6 as {SUM}) as face, count(*) as n_claims, count(distinct base12) as n_establishments from claims where class = 'III' and value_brl is not null group by 1, 2),
  ld as (select t.*, docs.case_number, case when face >= 200000 then 'FLOOR' else 'POOL' end as band from t join docs using (doc_id) where face >= 100000), one as (select root, coalesce(case_number, '') as ck, max(face) as face, sum(n_claims) as n_claims, sum(n_establishments) as n_establishments from ld group by 1, 2),
  old as (select 'Old ' || s.s_suppkey || '-' || j as creditor, lpad(cast(s.s_suppkey as varchar), 8, '0') as root, x.case_number, case s.s_suppkey % 4 when 0 then null when 1 then cast(x.amt as {SUM}) when 2 then cast(x.amt / 8 as {SUM}) else cast(x.amt + 7 as {SUM}) end as amount
    from supplier s join (select root, ck as case_number, face as amt, row_number() over (partition by root order by ck) as j from one) x on x.root = lpad(cast(s.s_suppkey as varchar), 8, '0') where j <= 2 union all select 'Gone ' || s_suppkey, lpad(cast(s_suppkey as varchar), 8, '0'), 'none', cast(5 as {SUM}) from supplier)"""


def _leads(d: Domain) -> DataFrame:
    c = d.view("claims").filter("class = 'III' and value_brl is not null")
    t = c.groupBy("root", "doc_id").agg((F.sum("value_brl") * 6).cast(SUM).alias("face"), F.count("*").alias("n_claims"), F.count_distinct("base12").alias("n_establishments"))
    out = t.filter("face >= 100000").join(d.view("docs").select("doc_id", "case_number"), "doc_id")
    return out.withColumn("band", F.when(F.col("face") >= report.FLOOR, "FLOOR").otherwise("POOL"))


def _by_case(leads: DataFrame) -> DataFrame:
    key = F.coalesce("case_number", F.lit("")).alias("case_number")
    return leads.groupBy("root", key).agg(F.max("face").alias("face"), F.sum("n_claims").alias("n_claims"), F.sum("n_establishments").alias("n_establishments"))


def _old_sheet(d: Domain, now: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    k = F.col("root").cast("bigint")
    j = F.row_number().over(Window.partitionBy("root").orderBy("case_number"))
    amount = F.when(k % 4 == 1, F.col("face")).when(k % 4 == 2, F.col("face") / 8).when(k % 4 == 3, F.col("face") + 7)
    had = now.withColumn("j", j).filter("j <= 2").select(F.concat(F.lit("Old "), k.cast("string"), F.lit("-"), F.col("j").cast("string")).alias("creditor"), "root", "case_number", amount.cast(SUM).alias("amount"))
    s = F.col("s_suppkey").cast("string")
    gone = d.table("supplier").select(F.concat(F.lit("Gone "), s).alias("creditor"), F.lpad(s, 8, "0").alias("root"), F.lit("none").alias("case_number"), F.lit(5).cast(SUM).alias("amount"))
    return had.unionByName(gone).join(d.table("supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("root")), "root", "left_semi")


_DIFF = f"""{oracle_with("claims", "docs")}, {_LEAD_ROWS}, df as (select creditor, old.root, old.case_number, amount, face, face - amount as delta, case when one.root is null then 'NOT_IN_NEW_RUN' when amount is null then 'NEW_ONLY' when abs(face - amount) < 1 then 'SAME' else 'CHANGED' end as verdict,
    array_to_string(list_filter([case when n_claims > 1 then n_claims || ' claims summed, ' || n_establishments || ' establishments' end, case when amount > 0 and face > 5 * amount then 'a leading digit was probably dropped' end], lambda x: x is not null), '; ') as because
    from old left join one on one.root = old.root and one.ck = old.case_number)"""


@query(f"""{_DIFF} select creditor, root, case_number, amount, face, cast(delta as {SUM}) as delta, verdict, case verdict when 'CHANGED' then coalesce(nullif(because, ''), 'read again from the document''s own row') when 'NOT_IN_NEW_RUN' then 'not harvested or below the floor' when 'NEW_ONLY' then 'no old amount' else '' end as why from df""")
def diff_tab(d: Domain):
    """The old sheet against this run's leads, row by row, and why they differ."""
    now = cut(_by_case(_leads(d)))
    return report.diff_frame(_old_sheet(d, now), now).select("creditor", "root", "case_number", "amount", "face", F.col("delta").cast(SUM).alias("delta"), "verdict", "why")


@query(f"""{_DIFF} select verdict, count(*) as n, cast(sum(delta) as {SUM}) as delta from df group by rollup(verdict)""")
def diff_verdicts(d: Domain):
    now = cut(_by_case(_leads(d)))
    out = report.verdict_counts(report.diff_frame(_old_sheet(d, now), now))
    return out.select("verdict", "n", F.col("delta").cast(SUM).alias("delta"))


_NEEDS = "nd as (select doc_id, page, row_index, root, value_brl from claims where class = 'III' and currency = 'BRL' and row_index % 5 = 0 and value_brl >= 40000 and coalesce(flag, '') <> 'NOT_A_CLAIM' and doc_id in (select doc_id from docs where status <> 'QUARANTINED'))"


def _needs(d: Domain) -> DataFrame:
    flags = F.when(F.col("flag").isNotNull(), F.array("flag"))
    c = d.view("claims").withColumn("document_type", F.when(F.col("row_index") % 5 == 0, "NONE").otherwise("CNPJ")).withColumn("flags", flags)
    return report.needs_id_frame(c, d.view("docs").filter("status <> 'QUARANTINED'"), 40_000).select("doc_id", "page", "row_index", "root", "value_brl")


@query(f"""{oracle_with("claims", "docs")}, {_NEEDS} select * from nd""")
def needs_id_tab(d: Domain):
    """Large class III rows whose list prints no id."""
    return _needs(d)


@query(f"""{oracle_with("claims", "docs")}, {_LEAD_ROWS} select root, doc_id, case_number, face, n_claims from ld where band = 'POOL'""")
def pooling_tab(d: Domain):
    return _leads(d).filter("band = 'POOL'").select("root", "doc_id", "case_number", "face", "n_claims")


@query("""with k as (select o_orderkey as doc_id, o_orderstatus as status from orders), c as (select l_orderkey as doc_id, 'III/BRL#' || l_linenumber as unit, l_tax < 0.04 as ok, cast(l_discount as varchar) as delta from lineitem)
  select k.doc_id, status, coalesce(string_agg(unit || ': ' || case when ok then 'PASS' else 'FAIL' end || ' Δ' || delta, ' · ' order by unit, unit || ': ' || case when ok then 'PASS' else 'FAIL' end || ' Δ' || delta), '') as checks from k left join c using (doc_id) group by 1, 2""")
def sources_tab(d: Domain):
    """Documents with their checks in words."""
    c = d.table("lineitem").select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("III/BRL#"), F.col("l_linenumber").cast("string")).alias("unit"), (F.col("l_tax") < 0.04).alias("pass"), F.col("l_discount").cast("string").alias("delta"))
    return report.sources_frame(d.table("orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderstatus").alias("status")), c)


@query(f"""{_DIFF}, {_NEEDS} select 'leads ' || band as frame, count(*) as n from ld group by 1 union all select 'documents', count(*) from docs union all select 'cases', count(distinct case_number) from docs union all select 'needs id', count(*) from nd union all select 'diff ' || verdict, count(*) from df group by 1""")
def ops_counts(d: Domain):
    """The rows of every tab of the operations book."""
    leads = cut(_leads(d))
    now = _by_case(leads)
    return report.book_counts(leads, d.view("docs"), _needs(d), report.diff_frame(_old_sheet(d, now), now))


# --- report ---------------------------------------------------------------------------
_SITE = "regexp_replace(lower(regexp_extract(url, '://([^/?#:]*)', 1)), '^www\\.', '')"
_RUN = f"""{oracle_with("claims", "docs", "cases", "companies")}, {_LEAD_ROWS.split("one as")[0].rstrip().rstrip(",")},
  dd as (select *, case doc_id % 3 when 0 then 'PROSE' when 1 then 'TABLE' end as strategy, case doc_id % 2 when 0 then 'L1' end as layout_id, case when class3_passed then 'PASS' else 'FAIL' end as class3 from docs),
  cc as (select distinct case_number, substr(case_number, 19, 2) as court from cases), uc as (select case_number, bool_or(status in ('OK', 'OK_NO_TOTALS')) as used from dd where case_number is not null group by 1),
  bc as (select cc.*, used from cc left join uc using (case_number)), co as (select *, 'mirror ' || nationkey % 3 as source, '2026-0' || (1 + nationkey % 9) as fetched, substr(activity, 1, 2) in ('64', '65', '66') as bank, substr(nature, 1, 1) = '1' as pub, situation <> '02' as off from companies),
  fe as (select {_SITE} as domain, count(*) filter (page_id % 3 = 0) as good, count(*) filter (page_id % 3 <> 0) as bad from pages group by 1), fl as (select distinct root from ld where band = 'FLOOR'), ex as (select count(*) filter (bank) as b, count(*) filter (pub) as p, count(*) filter (off) as o from fl join co using (root))"""


@query(f"""{_RUN} select 'documents by status' as part, status as key, count(*) as n, null::bigint as m, null::varchar as text from dd group by status union all select 'layouts', coalesce(strategy, '') || '/' || coalesce(layout_id, '') || ' · ' || status, count(*), null, null from dd group by 2
  union all select 'quarantined but used', null, count(*) filter (status = 'QUARANTINED' and class3 = 'PASS'), null, null from dd union all select 'documents and cases', null, count(*), count(distinct case_number), null from dd
  union all select 'quarantined, class III failed', cast(doc_id as varchar), null, null, 'u' || doc_id from dd where status = 'QUARANTINED' and class3 = 'FAIL' union all select 'coverage by court', court, count(distinct case_number), count(distinct case_number) filter (used), null from bc group by court
  union all select 'cases matched', null, count(distinct case_number) filter (used is not null), null, null from bc union all select 'releases', source, count(*), null, min(fetched) || ' … ' || max(fetched) from co group by source
  union all (select 'blocked', domain, bad, null, null from fe where bad > 0 order by bad desc, domain limit 15) union all select 'nothing retrievable', domain, bad, null, null from fe where good = 0
  union all select 'names to resolve', null, count(*), null, null from claims where class = 'III' and row_index % 5 = 0 and value_brl is not null union all select 'leads by band', band, count(*), null, null from ld group by band
  union all select 'companies excluded', 'is_bank', b, null, null from ex union all select 'companies excluded', 'is_public', p, null, null from ex union all select 'companies excluded', 'is_inactive', o, null, null from ex
  union all select 'excluded by name', null, count(distinct root), null, null from ld where band = 'FLOOR' and cast(root as bigint) % 7 in (0, 1)""")
def run_report(d: Domain):
    """The aggregates of a run's report, as one frame."""
    return report.aggregates(*_run(d))


def _run(d: Domain) -> tuple[DataFrame, ...]:
    i = F.col("doc_id")
    docs = d.view("docs").withColumns({"strategy": F.when(i % 3 == 0, "PROSE").when(i % 3 == 1, "TABLE"), "layout_id": F.when(i % 2 == 0, "L1"), "class3": F.when(F.col("class3_passed"), "PASS").otherwise("FAIL"), "source_url": F.concat(F.lit("u"), i.cast("string"))})
    claims = d.view("claims").withColumn("document_type", F.when(F.col("row_index") % 5 == 0, "NONE").otherwise("CNPJ"))
    cases = d.view("cases").select("case_number", F.substring("case_number", 19, 2).alias("court"))
    f = rules.registry_flags(F.col("activity"), F.col("nature"), F.col("situation"))
    n = F.col("nationkey")
    companies = d.view("companies").select("root", F.concat(F.lit("mirror "), (n % 3).cast("string")).alias("source"), F.concat(F.lit("2026-0"), (1 + n % 9).cast("string")).alias("fetched_at"), *[f[c].alias(c) for c in ("is_bank", "is_public", "is_inactive")])
    k = F.col("root").cast("bigint") % 7
    targets = _leads(d).withColumn("flags", F.when(k == 0, F.array(F.lit("LIKELY_FINANCIAL"))).when(k == 1, F.array(F.lit("X"), F.lit("LIKELY_PUBLIC"))).otherwise(F.array(F.lit("X"))))
    raw = d.table("pages").select(pages.host(F.col("url")).alias("domain"), F.when(F.col("page_id") % 3 == 0, 200).otherwise(404).alias("http_status"))
    return docs, claims, cases, companies, targets, raw
