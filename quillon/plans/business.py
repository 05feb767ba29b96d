"""Queries of the domain operators: reconcile, targets, bands, prices, checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import ids, text
from ..operators import claims, pricing, prose, rules
from ..sources import api, files, pages
from .catalog import query
from .domain import Domain, oracle_with
from .scalars import _MORE, COMPANY_WEIGHTS, duck_digit

SUM = "decimal(28,2)"


def _flagged(c):
    return c.withColumn("flags", F.array_compact(F.array("flag")))


# --- reconcile and targets -----------------------------------------------------------
_CHECKS = f"""{oracle_with("claims", "printed", "docs")},
  e as (select doc_id, section, coalesce(class, '?') || '/' || coalesce(currency, 'BRL') as unit, cast(coalesce(sum(value_brl), 0) as {SUM}) as es, count(*) as en, count(*) filter (value_brl is null) as mis
    from claims where coalesce(flag, '') <> 'NOT_A_CLAIM' group by 1, 2, 3),
  p as (select doc_id, section, class || '/' || currency as unit, total, count as cnt from printed where class is not null),
  own as (select p.doc_id, p.section, p.unit, p.total, p.cnt, es, en, mis, 'SECTION' as level from p join e using (doc_id, section, unit)),
  whole as (select doc_id, unit, sum(es) as es, sum(en) as en, sum(mis) as mis from e group by 1, 2),
  loose as (select p.doc_id, cast(null as int) as section, p.unit, p.total, p.cnt, coalesce(w.es, 0) as es, coalesce(w.en, 0) as en, coalesce(w.mis, 0) as mis, 'DOCUMENT' as level from p left join whole w using (doc_id, unit)
    where not exists (select 1 from own where own.doc_id = p.doc_id and own.unit = p.unit)),
  checks as (select *, abs(es - total) <= greatest(total * 0.005, 1000) and (cnt is null or en = cnt) as ok from (select * from own union all select * from loose))"""


@query(f"""{_CHECKS}, v as (select doc_id, count(*) as n_checks, count(*) filter (not ok) as n_failed, bool_and(case when unit = 'III/BRL' then ok end) as c3 from checks group by doc_id),
  h as (select distinct doc_id from e where unit = 'III/BRL'), r as (select doc_id, count(value_brl) as nv from claims group by doc_id)
  select d.doc_id, case when coalesce(nv, 0) = 0 then 'NO_ROWS' when n_checks is null then 'OK_NO_TOTALS' when n_failed > 0 then 'QUARANTINED' else 'OK' end as status, coalesce(n_checks, 0) as n_checks, coalesce(n_failed, 0) as n_failed,
    case when c3 then 'PASS' when not c3 then 'FAIL' when h.doc_id is not null then 'NO_TOTAL' else 'NO_ROWS' end as class3 from docs d left join v using (doc_id) left join h using (doc_id) left join r using (doc_id)""")
def reconcile(d: Domain):
    return claims.reconcile(_flagged(d.view("claims")), d.view("printed"), d.view("docs"))


@query(f"""{_CHECKS} select doc_id, section, unit, level, total, cnt as count, cast(es as {SUM}) as extracted_sum, cast(en as bigint) as extracted_count, cast(mis as bigint) as value_missing, cast(es - total as {SUM}) as delta, ok as pass, 1::bigint as n_candidates from checks""")
def reconcile_checks(d: Domain):
    return claims.checks(claims.extracted_totals(_flagged(d.view("claims"))), d.view("printed"))


_VALID_DOC = f"c1 as (select *, base12 || {duck_digit('base12', COMPANY_WEIGHTS)} as b13 from claims), c2 as (select *, case when row_index % 10 = 0 then substr(base12, 1, 11) else b13 || {duck_digit('b13', _MORE)} end as document_number from c1)"


@query(f"""{oracle_with("claims", "docs")}, {_VALID_DOC}, n as (select doc_id, count(*) as n_rows from claims group by doc_id),
  u as (select d.*, coalesce(n.n_rows, 0) as n_rows, case status when 'QUARANTINED' then 'PARTIAL_DOC' else status end as st, coalesce(case_number, 'UNKNOWN:' || substr(cast(doc_id as varchar), 1, 10)) as case_key
     from docs d left join n using (doc_id) where (status in ('OK', 'OK_NO_TOTALS') or (status = 'QUARANTINED' and class3_passed)) and doc_type in ('QGC', 'AJ_LIST', 'DEBTOR_LIST', 'UNKNOWN')),
  best as (select * from (select *, row_number() over (partition by case_key order by case doc_type when 'QGC' then 4 when 'AJ_LIST' then 3 when 'DEBTOR_LIST' then 2 else 1 end desc,
    case st when 'OK' then 3 when 'PARTIAL_DOC' then 2 else 1 end desc, publication_date desc, n_rows desc, doc_id) r from u) where r = 1),
  kept as (select doc_id, document_number, value_brl, class, min(coalesce(flag, '')) as flag from c2 where class = 'III' and currency = 'BRL' and value_brl is not null and coalesce(flag, '') not in ('NOT_A_CLAIM', 'SECTION_TOTAL') and length(document_number) = 14
    and doc_id in (select doc_id from best) group by doc_id, document_number, value_brl, class),
  roll as (select doc_id, substr(document_number, 1, 8) as root, cast(sum(value_brl) * 6 as {SUM}) as face, count(*) as n_claims, count(distinct document_number) as n_establishments from kept group by 1, 2)
  select b.case_key, roll.doc_id, root, face, n_claims, n_establishments, case when face >= 200000 then 'FLOOR' else 'POOL' end as band,
    array_to_string(list_sort(list_filter([case st when 'OK_NO_TOTALS' then 'UNRECONCILED_SOURCE' when 'PARTIAL_DOC' then 'PARTIAL_DOC_CLASS_III_RECONCILED' end, case when case_number is null then 'CASE_NUMBER_MISSING' end], lambda x: x is not null)), '|') as doc_flags
  from roll join best b using (doc_id) where face >= 100000""")
def target_banding(d: Domain):
    c = d.view("claims")
    full = ids.with_check_digits(F.col("base12"))
    number = F.when(F.col("row_index") % 10 == 0, F.substring("base12", 1, 11)).otherwise(full)
    c = c.withColumn("document_number", number).withColumn("claim_id", F.xxhash64("page", "row_index", "seen_on", "value_brl"))
    # six times the value, so that both bands occur on the driver's prices
    c = _flagged(c).withColumn("creditor_name", F.col("root")).withColumn("flags", F.filter("flags", lambda f: f != "CHECKED"))
    c = c.withColumn("value_brl", (F.col("value_brl") * 6).cast("decimal(18,2)"))
    n = d.view("claims").groupBy("doc_id").agg(F.count("*").alias("n_rows"))
    docs = d.view("docs").join(n, "doc_id", "left").fillna(0, ["n_rows"])
    out = claims.targets(c, docs)
    return out.select("case_key", "doc_id", "root", "face", "n_claims", F.size("establishments").cast("bigint").alias("n_establishments"), "band", F.array_join("flags", "|").alias("doc_flags"))


@query(f"""{oracle_with("claims", "docs")} select c.doc_id, page, row_index, root, value_brl, coalesce(class = 'III' and value_brl >= 60000 and row_index % 10 = 0 and d.status = 'OK', false) as queued from claims c join docs d using (doc_id)""")
def name_only_queue(d: Domain):
    """Every claim, and whether it waits for an id: large, of class III, in a good document, its list printing none."""
    printed = F.when(F.col("row_index") % 10 == 0, "NONE").otherwise("CNPJ")
    rows = d.view("claims").withColumn("document_type", printed).join(d.view("docs").select("doc_id", "status"), "doc_id")
    queued = (F.col("class") == "III") & (F.col("value_brl") >= 60000) & (F.col("document_type") == "NONE") & (F.col("status") == "OK")
    return rows.select("doc_id", "page", "row_index", "root", "value_brl", F.coalesce(queued, F.lit(False)).alias("queued"))


@query(f"""{oracle_with("claims")}, n as (select doc_id, root, sum(value_brl) as face, coalesce(sum(case when page % 3 = 0 then value_brl end), 0) as wrong, count(*) as n, count(*) filter (page % 3 = 0) as nw from claims where value_brl is not null group by 1, 2)
  select doc_id, root, cast(case when nw = n then face else face - wrong end as {SUM}) as face, nw = n as hold, nw as n_left_out from n where nw > 0""")
def leave_out_face(d: Domain):
    wrong = F.col("page") % 3 == 0
    n = d.view("claims").filter("value_brl is not null").groupBy("doc_id", "root").agg(
        F.sum("value_brl").alias("face"), F.coalesce(F.sum(F.when(wrong, F.col("value_brl"))), F.lit(0)).alias("wrong"), F.count("*").alias("n"), F.count_if(wrong).alias("n_left_out")
    )
    hold = F.col("n_left_out") == F.col("n")
    return n.filter("n_left_out > 0").select("doc_id", "root", F.when(hold, F.col("face")).otherwise(F.col("face") - F.col("wrong")).cast(SUM).alias("face"), hold.alias("hold"), "n_left_out")


# --- debtors and prices --------------------------------------------------------------
_AS_OF = "2026-01-01"
_YEAR = "cast(substr(case_number, 12, 4) as int)"
_FILED = "case when custkey % 2 = 0 then make_date(2010 + custkey % 16, 3, 15) end"
_MOVED = "case when custkey % 3 <> 1 then make_date(2024 + custkey % 3, 1 + custkey % 12, 1) end"


@query(f"""{oracle_with("cases")}, a as (select *, {_YEAR} as cy, cast({_FILED} as date) as filed, cast({_MOVED} as date) as moved from cases),
  b as (select *, least(year(filed), cy) as y from a), c as (select *, date_diff('day', case when year(filed) = y then filed else make_date(y, 7, 1) end, date '{_AS_OF}') / 365.25 as age, coalesce(registry not in ('NAME_MISMATCH'), false) as acc from b),
  f as (select *, granted or false as gr, coalesce(stage = 'CONVERTED_TO_BANKRUPTCY', false) or coalesce(proceeding = 'FALENCIA', false) as failed, coalesce(proceeding = 'EXTINCT', false) as ext, acc and coalesce(situation = '08', false) as shut, coalesce(stage = 'CLOSED', false) as closed,
    coalesce(moved < date '2025-09-01', false) as dormant, acc and coalesce(situation in ('03', '04'), false) as weak from c)
  select custkey, case when failed or ext or shut then 'D' when gr and not closed and age > 8 then 'B' when gr and not closed then 'A' when age > 2 or dormant or closed or weak then 'C' else 'B' end as band,
    case when gr then 'CONFIRMED' when plan_filed then 'PLAN_FILED' when stage is not null then 'ESTIMATED' else 'UNKNOWN' end as plan_status,
    array_to_string(list_filter([case when failed then 'bankruptcy' end, case when not failed and ext then 'proceeding extinguished' end, case when not failed and not ext and shut then 'debtor closed at the registry' end,
      case when not (failed or ext or shut) and gr and not closed then 'recovery granted' end, case when not (failed or ext or shut) and gr and not closed and age > 8 then 'but the case is old' end,
      case when not (failed or ext or shut) and not (gr and not closed) and age > 2 then 'filed over two years ago' end, case when not (failed or ext or shut) and not (gr and not closed) and dormant then 'no recent movement' end,
      case when not (failed or ext or shut) and not (gr and not closed) and closed then 'case closed' end, case when not (failed or ext or shut) and not (gr and not closed) and weak then 'debtor suspended or unfit at the registry' end,
      case when not (failed or ext or shut) and not gr and not (age > 2 or dormant or closed or weak) and plan_filed then 'plan filed, not granted' end, case when not (failed or ext or shut) and not gr and not (age > 2 or dormant or closed or weak) and not plan_filed then 'live case, no plan yet' end], lambda x: x is not null), '; ') as reasons from f""")
def debtor_band(d: Domain):
    k = F.col("custkey").cast("int")
    filed = F.when(k % 2 == 0, F.make_date(2010 + k % 16, F.lit(3), F.lit(15)))
    moved = F.when(k % 3 != 1, F.make_date(2024 + k % 3, 1 + k % 12, F.lit(1)))
    names = ("stage", "proceeding", "situation", "registry", "granted", "plan_filed")
    facts = {n: F.col(n) for n in names} | {
        "name": F.lit(None).cast("string"), "grant_signal": F.lit(False), "filing_date": filed, "case_year": ids.case_year(F.col("case_number")), "last_movement": moved,
    }
    out = pricing.debtor_band(facts, _AS_OF)
    return d.view("cases").select("custkey", *[out[c].alias(c) for c in ("band", "plan_status", "reasons")])


_BAND = "case custkey % 5 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'D' else 'U' end"
_BANDS = "bt as (select * from (values ('A', 0.40, 2.0, 8.0, 1.5), ('B', 0.30, 2.0, 8.0, 1.5), ('C', 0.15, 3.0, 10.0, 2.5), ('D', 0.03, 0.0, 0.0, 6.0), ('U', 0.25, 3.0, 8.0, 2.5)) t(band, rec, g, t, lag))"
_PRICED = f"""{oracle_with("cases")}, {_BANDS}, l as (select *, {_BAND} as band, cast(custkey % 12 as double) as ysf, case when custkey % 7 = 0 then 1.0 end as pg, case when custkey % 7 = 0 then 4.0 end as pt, case when custkey % 7 = 0 then 0.35 end as pr, custkey % 4 = 0 as fin, case when custkey % 6 = 0 then 'held' else '' end as hold from cases),
  y as (select l.*, bt.rec, case when l.band = 'A' then greatest(1.0, coalesce(pg, g) + coalesce(pt, t) / 2 - greatest(0.0, ysf - lag)) else lag + coalesce(pg, g) + coalesce(pt, t) / 2 end as years from l join bt on bt.band = l.band),
  z as (select *, case when hold <> '' then 0.0 else coalesce(pr, rec) end as r from y)"""


def _lead(d: Domain):
    k = F.col("custkey")
    plan = k % 7 == 0
    c = d.view("cases").select(
        "custkey", "balance", F.when(k % 5 == 0, "A").when(k % 5 == 1, "B").when(k % 5 == 2, "C").when(k % 5 == 3, "D").otherwise("U").alias("band"), (k % 12).cast("double").alias("ysf"),
        F.when(plan, 1.0).alias("pg"), F.when(plan, 4.0).alias("pt"), F.when(plan, 0.35).alias("pr"), (k % 4 == 0).alias("fin"), F.when(k % 6 == 0, "held").otherwise("").alias("hold"),
    )
    return c.withColumn("years", pricing.years_to_payment(F.col("band"), F.col("ysf"), F.col("pg"), F.col("pt")))


@query(f"{_PRICED} select custkey, band, cast(years as double) as years from z")
def years_to_payment(d: Domain):
    return _lead(d).select("custkey", "band", "years")


@query(f"""{_PRICED}, f as (select custkey, cast(balance as double) * r / pow(1.25, years) as fund, hold from z) select custkey, round(fund, 4) + 0.0 as fund, round(0.6 * fund, 4) + 0.0 as quote, round(fund - 0.6 * fund, 4) + 0.0 as premium, hold <> '' as on_hold from f""")
def price_book(d: Domain):
    rec = pricing.recovery(F.col("band"), F.col("pr"), F.col("fin"), F.col("hold"))
    p = pricing.price(F.col("balance"), rec, F.col("years"))
    return _lead(d).select("custkey", *[F.round(p[k], 4).alias(k) for k in ("fund", "quote", "premium")], (F.col("hold") != "").alias("on_hold"))


@query(f"""{_PRICED}, f as (select custkey, cast(balance as double) as face, cast(balance as double) * r / pow(1.25, years) as fund, years, band, hold from z)
  select custkey, case when fund > face then 'price above face' when hold <> '' and fund <> 0 then 'held but priced' when years < 1 then 'too soon' when band = 'D' then 'band D in the book' end as violation from f
  where face >= 0 and (fund > face or (hold <> '' and fund <> 0) or years < 1 or band = 'D')""")
def dq_violations(d: Domain):
    rec = pricing.recovery(F.col("band"), F.col("pr"), F.col("fin"), F.col("hold"))
    face = F.col("balance").cast("double")
    out = _lead(d).withColumn("fund", pricing.price(F.col("balance"), rec, F.col("years"))["fund"]).filter(face >= 0)
    bad = rules.cascade([(F.col("fund") > face, "price above face"), ((F.col("hold") != "") & (F.col("fund") != 0), "held but priced"), (F.col("years") < 1, "too soon"), (F.col("band") == "D", "band D in the book")], F.lit(None).cast("string"))
    return out.select("custkey", bad.alias("violation")).filter("violation is not null")


@query(f"""{oracle_with("cases")}, l as (select custkey, {_BAND} as band, case custkey % 4 when 0 then 'Plan (art. 53) — not a list' else 'AJ list (art. 7 §2)' end as kind, case when custkey % 3 = 0 then '' else 'D' end as debtor, case when custkey % 9 = 0 then null else case_number end as c, custkey % 8 = 1 as mm, custkey % 10 = 1 as oroots from cases)
  select custkey, array_to_string(list_filter([case when kind like 'Plan%' then 'source is not a statutory list' end, case when band = 'U' then 'debtor band unresolved' end, case when debtor = '' and coalesce(c, '') = '' then 'no debtor and no case' end,
    case when mm then 'printed name does not match the registry' end, case when oroots then 'other company roots on the line' end], lambda x: x is not null), '; ') as hold from l""")
def hold_reasons(d: Domain):
    k = F.col("custkey")
    kind = F.when(k % 4 == 0, rules.LIST_KIND["PLAN"]).otherwise(rules.LIST_KIND["AJ_LIST"])
    band = F.when(k % 5 == 4, "U").otherwise("B")
    hold = pricing.hold_reasons(kind, band, F.when(k % 3 == 0, "").otherwise("D"), F.when(k % 9 != 0, F.col("case_number")), k % 8 == 1, k % 10 == 1)
    return d.view("cases").select("custkey", hold.alias("hold"))


@query(f"""{oracle_with("docs")}, p as (select doc_id, status, case doc_id % 4 when 0 then 'PASS' when 1 then 'FAIL' when 2 then 'NO_TOTAL' else 'NO_ROWS' end as c3, doc_id % 9 = 0 as bad from docs)
  select doc_id, case when bad then 'CHECK' when status = 'OK' and c3 = 'PASS' then 'OK — totals reconciled' when status = 'OK' and c3 in ('NO_TOTAL', 'NO_ROWS') then 'OK — other classes reconciled' when status = 'OK_NO_TOTALS' then 'NO TOTALS on the list' when status = 'QUARANTINED' and c3 = 'PASS' then 'PARTIAL — class III reconciled' else 'CHECK' end as proof from p""")
def proof_label(d: Domain):
    k = F.col("doc_id")
    c3 = F.when(k % 4 == 0, "PASS").when(k % 4 == 1, "FAIL").when(k % 4 == 2, "NO_TOTAL").otherwise("NO_ROWS")
    kind = F.when(k % 9 == 0, rules.LIST_KIND["OTHER"]).otherwise(rules.LIST_KIND["QGC"])
    return d.view("docs").select("doc_id", pricing.proof_label(F.col("status"), c3, kind).alias("proof"))


@query(f"""{oracle_with("claims", "companies")}, c as (select root, nature, situation, cast(root as bigint) as k from companies)
  select root, case when substr(nature, 1, 1) = '1' or (k % 6 = 0 and k % 4 = 0) then 'public body' when situation <> '02' then 'not active at the registry' when k % 9 = 0 then 'related party' when k % 5 = 3 then 'heading: SUBORDINATED' when k % 8 = 5 then 'bankrupt or extinguished' else '' end as reason from c""")
def exclusion_cascade(d: Domain):
    k = F.col("root").cast("bigint")
    reason = pricing.exclusion(
        {
            "nature": F.col("nature"), "public_name": k % 4 == 0, "has_registry": k % 6 != 0, "situation": F.col("situation"), "related": k % 9 == 0,
            "heading": F.when(k % 5 == 3, "SUBORDINATED").otherwise(""), "band": F.when(k % 8 == 5, "D").otherwise("B"), "proceeding": F.lit(None).cast("string"),
        }
    )
    return d.view("companies").select("root", reason.alias("reason"))


@query(f"""{oracle_with("docs")}, c as (select custkey, list_distinct(list_filter(list(case_number), lambda x: cast(substr(x, 12, 4) as int) >= 2012 and substr(x, 17, 1) = '8')) as ok from docs where case_number is not null group by custkey) select custkey, ok[1] as adopted from c where len(ok) = 1""")
def unique_candidate_repair(d: Domain):
    c = F.col("case_number")
    good = d.view("docs").filter((ids.case_year(c) >= 2012) & ids.is_state_court(c)).groupBy("custkey").agg(F.collect_set("case_number").alias("s"))
    return good.filter(F.size("s") == 1).select("custkey", F.element_at("s", 1).alias("adopted"))


@query(f"""{oracle_with("claims", "companies")}, a as (select root, bool_or(page = 7 and section = 1 and flag = 'CHECKED') as alive from claims group by root) select co.root, (co.situation <> '02' and not coalesce(a.alive, false)) as is_inactive, co.situation <> '02' as was_inactive from companies co left join a using (root)""")
def revive_inactive(d: Domain):
    a = d.view("claims").groupBy("root").agg(F.bool_or((F.col("page") == 7) & (F.col("section") == 1) & (F.col("flag") == "CHECKED")).alias("alive"))
    was = F.col("situation") != "02"
    return d.view("companies").join(a, "root", "left").select("root", (was & ~F.coalesce("alive", F.lit(False))).alias("is_inactive"), was.alias("was_inactive"))


# --- text to claims ------------------------------------------------------------------
_ENTRY = f"""{oracle_with("claims")}, {_VALID_DOC}, k as (select doc_id, page, b13 || {duck_digit('b13', _MORE)} as n14, value_brl, row_number() over (partition by doc_id order by page, row_index, seen_on, root, coalesce(value_brl, 0)) as seq from c1 where value_brl is not null)"""


@query(f"""{_ENTRY} select doc_id, 1 as section, cast(seq - 1 as int) as seq, 'III' as class, 'CREDOR ' || seq as name, n14 as document, value_brl as value, case when seq % 3 = 0 then 'USD' else 'BRL' end as currency, case when seq % 3 = 0 then 'FOREIGN_CURRENCY' else '' end as flags from k""")
def prose_entries(d: Domain):
    full = ids.with_check_digits(F.col("base12"))
    w = Window.partitionBy("doc_id").orderBy("page", "row_index", "seen_on", "root", F.coalesce("value_brl", F.lit(0)))
    k = d.view("claims").filter("value_brl is not null").select("doc_id", full.alias("n"), "value_brl", F.row_number().over(w).alias("seq"))
    money = F.concat(F.when(F.col("seq") % 3 == 0, "US$ ").otherwise("R$ "), F.translate(F.format_number("value_brl", 2), ",.", ".,"))
    entry = F.concat(F.lit(" Credor "), F.col("seq").cast("string"), F.lit(" - "), ids.masked(F.col("n")), F.lit(", "), money)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", entry.alias("e")))), lambda x: x["e"]), ";")
    texts = k.groupBy("doc_id").agg(F.concat(F.lit("Edital. CLASSE III – Quirografários (2 CREDORES | R$ 10,00):"), body).alias("text"))
    out = prose.entries(texts)
    return out.select("doc_id", "section", "seq", "class", "name", "document", "value", "currency", F.array_join("flags", "|").alias("flags"))


@query(f"""{oracle_with("docs")} select doc_id, cast(s.section as int) as section, s.class, s.name, total as value, s.flags from docs, (values (1, 'II', 'CREDOR A', ''), (2, null, 'CREDOR B', 'SECTION_CREDITOS_ILIQUIDOS'),
  (3, null, 'CREDOR C', 'SECTION_OUTROS_VALORES_EM_ANALISE'), (4, 'IV', 'CREDOR D', ''), (5, 'I', 'CREDOR E', '')) s(section, class, name, flags)""")
def prose_sections(d: Domain):
    money = F.concat(F.lit("R$ "), F.translate(F.format_number("total", 2), ",.", ".,"))
    text = F.concat(
        F.lit("Edital da Classe III: nota. CLASSE II – Garantia real: Credor A, "), money, F.lit("; Créditos Ilíquidos: Credor B, "), money,
        F.lit("; Outros valores em análise (3 CREDORES | R$ 9,00): Credor C, "), money, F.lit("; CLASSE IV – Micro (1 CREDOR | R$ 5,00): Credor D, "), money,
        F.lit("; Retardatários da CLASSE I. Credor E, "), money,
    )
    out = prose.entries(d.view("docs").select("doc_id", text.alias("text")))
    return out.select("doc_id", "section", "class", "name", "value", F.array_join("flags", "|").alias("flags"))


@query("""select page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) <> '' as has_title, cast(len(regexp_extract_all(html, '(?is)<a\\b[^>]*?href\\s*=\\s*["'']([^"''#]+)["''][^>]*>(.*?)</a>', 1)) as bigint) as n_links,
  array_to_string(regexp_extract_all(html, '(?is)<a\\b[^>]*?href\\s*=\\s*["'']([^"''#]+)["''][^>]*>(.*?)</a>', 1), ' ') as hrefs from pages""")
def anchor_extract(d: Domain):
    p = d.table("pages")
    links = pages.anchors(p, ["page_id"]).groupBy("page_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "href"))).alias("h"))
    hrefs = F.array_join(F.transform("h", lambda x: x["href"]), " ")
    out = p.select("page_id", (F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1) != "").alias("has_title")).join(links, "page_id", "left")
    return out.select("page_id", "has_title", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce(hrefs, F.lit("")).alias("hrefs"))


@query("""select event_id, lpad(cast(event_id as varchar), 7, '0') || '-11.2020.8.26.0001' as case_number, case when user_id % 4 = 0 then 'CONVERTED_TO_BANKRUPTCY' when user_id % 4 = 1 then 'CLOSED' else 'ACTIVE' end as stage, user_id % 4 = 2 as grant_signal, cast(1 + user_id % 50 as int) as n_movements, cast(ts as date) as last_movement, cast(least(1 + user_id % 50, 40) as int) as n_kept from events""")
def json_flatten(d: Domain):
    e = d.table("events")
    k = F.col("user_id") % 4
    name = F.when(k == 0, "Decretação de Falência").when(k == 1, "Baixa Definitiva").when(k == 2, "Concessão da Recuperação").otherwise("Juntada")
    move = F.struct(F.lit(1).alias("codigo"), name.alias("nome"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("dataHora"))
    record = F.struct(
        F.concat(F.lpad(F.col("event_id").cast("string"), 7, "0"), F.lit("1120208260001")).alias("numeroProcesso"), F.lit("tjsp").alias("tribunal"), F.lit("20200105000000").alias("dataAjuizamento"),
        F.array_repeat(move, (1 + F.col("user_id") % 50).cast("int")).alias("movimentos"),
    )
    flat = api.flatten(e.select(F.to_json(record).alias("source")))
    return flat.select(F.substring("case_number", 1, 7).cast("bigint").alias("event_id"), "case_number", "stage", "grant_signal", "n_movements", "last_movement", F.size("movements").alias("n_kept"))


@query("""with p as (select page_id, url, regexp_replace(regexp_extract(lower(url), '://([^/?#:]*)', 1), '^www\\.', '') as domain, length(url) % 4 as score from pages), r as (select domain, url, max(score) as score from p group by domain, url), k as (select *, row_number() over (partition by domain order by score desc, url) as rank from r where score > 0) select domain, url, cast(score as int) as score, cast(rank as int) as rank from k where rank <= 3""")
def capped_candidates(d: Domain):
    p = d.table("pages").select("url", pages.host(F.col("url")).alias("domain"), (F.length("url") % 4).alias("score"), F.lit("LIST").alias("kind"))
    return pages.candidates(p, "url", "domain", 3).select("domain", "url", "score", "rank")


@query(f"""{oracle_with("companies")} select root, 'C ' || name as razao_social, situation as situacao, capital as capital_social, cast(case when cast(root as bigint) % 3 = 0 then 1 else 2 end as int) as n_makers, case when cast(root as bigint) % 3 = 0 then 'c' else 'a' end as first_maker from companies where cast(root as bigint) % 4 <> 0""")
def registry_records(d: Domain):
    c = d.view("companies")
    k = F.col("root").cast("bigint")
    person = lambda n, code: F.struct(F.lit(n).alias("nome"), code.alias("qual_code"))
    spare = F.array(person("b", F.lit(1)), person("c", F.lit(22)), person("d", F.lit(22)))
    makers = F.array(person("a", F.lit(49)), person("b", F.lit(1)), person("c", F.lit(16)))
    record = F.struct(
        F.concat("root", F.lit("000100")).alias("cnpj"), F.concat(F.lit("C "), "name").alias("razao_social"), F.regexp_replace("situation", "^0", "").alias("situacao_cadastral"), F.col("capital").cast("string").alias("capital_social"),
        F.when(k % 3 == 0, spare).otherwise(makers).alias("qsa"),
    )
    cache = c.select(F.concat("root", F.lit("000100")).alias("cnpj"), F.when(k % 4 == 0, 404).otherwise(200).alias("status"), F.to_json(record).alias("json"))
    out = files.registry_records(cache)
    return out.select("root", "razao_social", "situacao", "capital_social", F.size("decision_makers").alias("n_makers"), F.element_at("decision_makers", 1)["nome"].alias("first_maker"))


@query("""select o_orderkey, 'CREDOR ' || o_orderkey as creditor_name, lpad(cast(o_orderkey as varchar), 14, '0') as company, lpad(cast(o_custkey as varchar), 7, '0') || '-11.2020.8.26.0001' as case_number, cast(o_totalprice as decimal(18,2)) as amount from orders""")
def markdown_scan(d: Domain):
    number = F.lpad(F.col("o_orderkey").cast("string"), 14, "0")
    money = F.translate(F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2), ",.", ".,")
    row = F.concat(F.lit("| CREDOR "), F.col("o_orderkey").cast("string"), F.lit(" | "), ids.masked(number), F.lit(" | "), F.lpad(F.col("o_custkey").cast("string"), 7, "0"), F.lit("-11.2020.8.26.0001 | R$ "), money, F.lit(" |"))
    lines = d.table("orders").select(F.col("o_orderkey").alias("pos"), row.alias("value")).union(d.spark.sql("select cast(-1 as bigint), '|---|---|'"))
    out = files.markdown_rows(lines)
    return out.select(F.regexp_extract("creditor_name", "([0-9]+)$", 1).cast("bigint").alias("o_orderkey"), "creditor_name", "company", "case_number", "amount")
