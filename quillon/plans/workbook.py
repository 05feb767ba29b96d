"""Queries of the workbook frames, readers, tallies, ruled tables and strategies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids
from ..operators import book, grids, layout, rules, tables
from .business import _CHECKS, _PRICED, _lead
from .catalog import ORACLES, QUERIES, query
from .domain import Domain, oracle_with

SUM = "decimal(28,2)"


# --- joins ---------------------------------------------------------------------------
@query(f"""{oracle_with("claims", "printed", "docs", "cases")}, t as (select doc_id, section, cast(sum(value_brl) as {SUM}) as face, count(*) as n from claims group by 1, 2),
  src as (select page_id as doc_id, url as source_url from pages), raw as (select url, min(page_id) as first_page from pages group by url)
  select t.doc_id, t.section, face, n, p.class as printed_class, p.total, source_url, first_page, d.case_number, ca.stage from t left join printed p on p.doc_id = t.doc_id and p.section = t.section
  left join src on src.doc_id = t.doc_id left join raw on raw.url = src.source_url left join docs d on d.doc_id = t.doc_id left join cases ca on ca.case_number = d.case_number""")
def star_join_two_keys(d: Domain):
    t = d.view("claims").groupBy("doc_id", "section").agg(F.sum("value_brl").cast(SUM).alias("face"), F.count("*").alias("n"))
    printed = d.view("printed").select("doc_id", "section", F.col("class").alias("printed_class"), "total")
    p = d.table("pages")
    raw = p.groupBy(F.col("url").alias("source_url")).agg(F.min("page_id").alias("first_page"))
    # what hangs on the page, and on the case, is joined before the claims are: most of these have neither, and their nulls would meet in one task
    sources = tables.known_left(p.select(F.col("page_id").alias("doc_id"), F.col("url").alias("source_url")), raw, "source_url")
    staged = tables.known_left(d.view("docs").select("doc_id", "case_number"), d.view("cases").select("case_number", "stage"), "case_number")
    out = t.join(printed, ["doc_id", "section"], "left").join(sources, "doc_id", "left").join(staged, "doc_id", "left")
    return out.select("doc_id", "section", "face", "n", "printed_class", "total", "source_url", "first_page", "case_number", "stage")


@query(f"""{oracle_with("docs", "cases")}, h as (select doc_id, sha1(text) as sha1 from documents), raw as (select sha1(text) as sha1, min(doc_id) as first_doc, count(*) as n_aliases from documents group by 1)
  select docs.doc_id, doc_type, h.sha1, first_doc, n_aliases, stage from docs left join h on h.doc_id = docs.doc_id left join raw on raw.sha1 = h.sha1 left join cases on cases.case_number = docs.case_number""")
def star_join_sha1(d: Domain):
    hashed = d.table("documents").select("doc_id", F.sha1(F.col("text").cast("binary")).alias("sha1"))
    raw = hashed.groupBy("sha1").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n_aliases"))
    # as above: filings without a text, or a case, would meet in one task by their null
    named = tables.known_left(hashed, raw, "sha1")
    staged = tables.known_left(d.view("docs").select("doc_id", "doc_type", "case_number"), d.view("cases").select("case_number", "stage"), "case_number")
    return staged.join(named, "doc_id", "left").select("doc_id", "doc_type", "sha1", "first_doc", "n_aliases", "stage")


@query(f"""{oracle_with("claims")}, t as (select doc_id, root, list(distinct base12) as ests from claims where class = 'III' group by 1, 2), e as (select doc_id, root, unnest(ests) as base12 from t)
  select e.doc_id, e.root, base12, page, row_index, value_brl from e join claims c using (doc_id, base12) where c.class = 'III' and c.currency = 'BRL'""")
def claims_behind_targets(d: Domain):
    """The bound list of establishments of each target as one join instead of a query each."""
    c = d.view("claims").filter("class = 'III'")
    targets = c.groupBy("doc_id", "root").agg(F.collect_set("base12").alias("ests"))
    behind = targets.select("doc_id", "root", F.explode("ests").alias("base12"))
    rows = c.filter("currency = 'BRL'").select("doc_id", "base12", "page", "row_index", "value_brl")
    return behind.join(rows, ["doc_id", "base12"]).select("doc_id", "root", "base12", "page", "row_index", "value_brl")


@query(f"""{oracle_with("docs")} select case_number, first(doc_type order by doc_id) as doc_type, first(status order by doc_id) as status, count(*) as n_docs from docs where case_number is not null group by case_number""")
def case_first_document(d: Domain):
    """Bare columns of a group: those of its least doc_id."""
    docs = d.view("docs").filter("case_number is not null")
    return docs.groupBy("case_number").agg(F.min_by("doc_type", "doc_id").alias("doc_type"), F.min_by("status", "doc_id").alias("status"), F.count("*").alias("n_docs"))


# --- readers -------------------------------------------------------------------------
@query(f"""{_CHECKS}, f as (select doc_id, cast(sum(total) as {SUM}) as total, cast(sum(mis) as int) as missing, bool_and(ok) and sum(mis) = 0 and count(total) = count(*) as ok, count(total) < count(*) as no_total from checks where unit = 'III/BRL' group by doc_id)
  select distinct c.doc_id, f.ok, case when f.total > 0 then f.total end as total, f.missing, f.no_total from checks c left join f using (doc_id)""")
def reconcile_json(d: Domain):
    done = QUERIES["reconcile_checks"](d.spark, d.sf_dir)
    check = F.struct(
        F.concat("unit", F.coalesce(F.concat(F.lit("#s"), F.col("section").cast("string")), F.lit(""))).alias("class"), F.col("total").cast("string").alias("printed_total"), F.col("value_missing").cast("int").alias("value_missing"),
        F.col("delta").cast("string").alias("delta"), "pass", F.lit(1).alias("page"),
    )
    reports = done.groupBy("doc_id").agg(F.to_json(F.struct(F.collect_list(check).alias("checks"))).alias("report"))
    return reports.select("doc_id", book.reconciled(F.col("report")).alias("r")).select("doc_id", "r.ok", "r.total", "r.missing", "r.no_total")


@query("""select c_custkey as id, c_name as name, case when c_custkey % 2 = 0 then 'CFO' end as title, c_mktsegment as organization, '11' || c_custkey || '|+55' as phones from customer where c_custkey % 3 <> 0""")
def envelope_people(d: Domain):
    c = d.table("customer")
    phone = lambda n: F.struct(n.alias("number"))
    person = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, "CFO").alias("title"), F.struct(F.col("c_mktsegment").alias("name")).alias("organization"),
        F.array(phone(F.concat(F.lit("11"), F.col("c_custkey").cast("string"))), phone(F.lit("+55"))).alias("phone_numbers"),
    )
    body = F.to_json(F.struct(F.to_json(F.struct(F.array(person, person).alias("people"))).alias("result")))
    return book.unwrapped(c.select(body.alias("body")), c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id")))


@query(f"""{oracle_with("claims")}, a as (select *, case row_index % 4 when 0 then value_brl when 1 then value_brl + 10 end as alt from claims where value_brl is not null)
  select doc_id, root, page, row_index, value_brl, coalesce(abs(alt - value_brl) > 0.005, false) as two_values from a""")
def two_values(d: Domain):
    k = F.col("row_index") % 4
    alt = F.when(k == 0, F.col("value_brl")).when(k == 1, F.col("value_brl") + 10)
    printed = F.concat(F.lit("ALT_VALUE:R$"), F.translate(F.format_number(alt, 2), ",.", ".,"))
    c = d.view("claims").filter("value_brl is not null").withColumn("flags", F.array_compact(F.array(F.lit("CHECKED"), printed)))
    return c.select("doc_id", "root", "page", "row_index", "value_brl", book.two_values(F.col("flags"), F.col("value_brl")).alias("two_values"))


@query("""with p as (select o_orderkey, o_totalprice as old, case o_orderkey % 4 when 0 then o_totalprice when 1 then o_totalprice * 10 else o_totalprice + 1 end as new, o_orderkey % 3 as n from orders)
  select o_orderkey, case when old = new then '' when greatest(old, new) / least(old, new) > 5 then 'a digit was probably dropped' when n > 1 then n || ' claims summed' else 'value changed' end as reason from p""")
def diff_reason(d: Domain):
    old, k = F.col("o_totalprice"), F.col("o_orderkey") % 4
    new = F.when(k == 0, old).when(k == 1, old * 10).otherwise(old + 1)
    return d.table("orders").select("o_orderkey", book.diff_reason(old, new, F.col("o_orderkey") % 3).alias("reason"))


@query(f"""{oracle_with("docs")} select doc_id, case when doc_id % 11 = 0 then 'ERROR' when doc_id % 7 = 0 then 'NO_TEXT_LAYER' when doc_id % 5 = 0 then 'NO_ROWS' else status end as status from docs""")
def final_status(d: Domain):
    k = F.col("doc_id")
    error = F.when(k % 11 == 0, "TIMEOUT")
    return d.view("docs").select("doc_id", book.final_status(F.col("status"), F.when(k % 7 == 0, F.when(k % 2 == 0, False)).otherwise(True), F.when(k % 5 != 0, k), error).alias("status"))


# --- contacts ------------------------------------------------------------------------
_PEOPLE = """p as (select lpad(cast(c_nationkey as varchar), 8, '0') as root, [49, 16, 5, 10, 22][cast(c_custkey % 5 + 1 as int)] as role, c_name as name, c_custkey as k from customer)"""
_OWN = "o as (select root, cast(k % 7 as int) as rank, name, k % 4 = 0 as demoted from p where cast(root as int) % 3 <> 0 and k % 6 = 0)"


def _people(d: Domain):
    role = F.element_at(F.array(*map(F.lit, (49, 16, 5, 10, 22))), (F.col("c_custkey") % 5 + 1).cast("int"))
    return d.table("customer").select(F.lpad(F.col("c_nationkey").cast("string"), 8, "0").alias("root"), role.alias("role"), F.col("c_name").alias("name"), F.col("c_custkey").alias("k"))


@query(f"""with {_PEOPLE}, {_OWN}, a as (select root, name, cast(demoted as int) as x, rank as y from o union all
    select root, name, 0, case role when 49 then 0 when 16 then 1 when 5 then 2 when 10 then 3 else 4 end from p where root not in (select root from o)),
  r as (select *, row_number() over (partition by root order by x, y, name) as r from a) select root, max(name) filter (r = 1) as primary, max(name) filter (r = 2) as backup from r group by root""")
def called_people(d: Domain):
    p = _people(d)
    own = p.filter((F.col("root").cast("int") % 3 != 0) & (F.col("k") % 6 == 0)).select("root", (F.col("k") % 7).alias("rank"), "name", (F.col("k") % 4 == 0).alias("demoted"))
    return book.called_people(own, p.select("root", "role", "name"))


@query(f"""with {_PEOPLE}, r as (select *, row_number() over (partition by root order by case role when 49 then 0 when 5 then 1 when 16 then 2 when 10 then 3 else 4 end, name) as r from p) select root, name as person, role from r where r = 1""")
def signing_person(d: Domain):
    return book.signing_person(_people(d))


@query("""with c as (select user_id, event_id, cast(floor(value) as int) % 5 - 1 as score, event_type from events), r as (select *, row_number() over (partition by user_id order by score desc, event_id) as r from c where score > 0)
  select user_id, event_type as value, score from r where r = 1""")
def best_scored_candidate(d: Domain):
    c = d.table("events").select("user_id", F.col("event_id").alias("pos"), (F.floor("value").cast("int") % 5 - 1).alias("score"), F.col("event_type").alias("value"))
    return book.best_candidate(c, "user_id")


# --- tallies and frames --------------------------------------------------------------
_LEADS = f"""{_PRICED}, leads as (select lpad(cast(custkey as varchar), 8, '0') as root, case_number, case custkey % 3 when 0 then 'TRADE' when 1 then 'FINANCIAL' else 'STATE-OWNED' end as book, band, balance as face, r as recovery, years, hold,
    case custkey % 4 when 0 then 'OK' when 1 then 'NO TOTALS' when 2 then 'PARTIAL' else 'CHECK x' end as proof, stage, case when hold <> '' then 0.0 else cast(balance as double) * r / pow(1.25, years) end as raw from z),
  framed as (select *, round(raw, 2) as fund, round(0.6 * raw, 2) as quote, round(raw - 0.6 * raw, 2) as premium from leads)"""


def _book_rows(d: Domain):
    from ..operators import pricing

    k = F.col("custkey")
    rec = pricing.recovery(F.col("band"), F.col("pr"), F.col("fin"), F.col("hold"))
    facts = d.view("cases").select(F.col("custkey").alias("_k"), "case_number", "stage")
    rows = _lead(d).join(facts, k == F.col("_k"))
    return rows.select(
        F.lpad(k.cast("string"), 8, "0").alias("root"), "case_number", F.when(k % 3 == 0, "TRADE").when(k % 3 == 1, "FINANCIAL").otherwise("STATE-OWNED").alias("book"), "band", F.col("balance").alias("face"), rec.alias("recovery"), "years",
        "hold", F.when(k % 4 == 0, "OK").when(k % 4 == 1, "NO TOTALS").when(k % 4 == 2, "PARTIAL").otherwise("CHECK x").alias("proof"), "stage",
    )


@query(f"""{_LEADS} select root, book, band, face, fund + 0.0 as fund, quote + 0.0 as quote, premium + 0.0 as premium, hold = '' and proof <> 'CHECK x' as callable from framed""")
def call_sheet(d: Domain):
    out = book.call_frame(_book_rows(d))
    return out.select("root", "book", "band", "face", *[(F.col(c) + F.lit(0.0)).alias(c) for c in ("fund", "quote", "premium")], "callable")


@query(f"""{_LEADS}, g as (select book, count(*) as n, count(*) filter (band = 'A') as n_band_a, count(*) filter (band = 'D') as n_band_d, cast(sum(face) as {SUM}) as face, count(*) filter (proof like 'OK%') as n_proof_ok,
    count(*) filter (proof like 'CHECK%') as n_proof_check, count(*) filter (hold <> '') as n_held, cast(coalesce(sum(face) filter (hold <> ''), 0) as {SUM}) as face_held, round(sum(fund), 0) + 0.0 as fund from framed group by rollup(book)) select * from g""")
def portfolio_tally(d: Domain):
    out = book.tally(book.call_frame(_book_rows(d)), ("A", "D"), ("OK", "CHECK"))
    return out.select("book", "n", "n_band_a", "n_band_d", "face", "n_proof_ok", "n_proof_check", "n_held", "face_held", (F.round("fund", 0) + F.lit(0.0)).alias("fund"))


_LABELS = "labels as (select * from (values ('band', 'A'), ('band', 'B'), ('band', 'Z'), ('book', 'TRADE'), ('book', 'NONE'), ('proof', 'OK'), ('proof', 'PARTIAL'), ('stage', 'ACTIVE'), ('stage', 'SUSPENDED'), ('state', 'SP'), ('state', 'XX')) t(dimension, label))"


@query(f"""{_LEADS}, {_LABELS}, states as (select * from (values {", ".join(f"('{k}', '{v}')" for k, v in ids.COURT_STATE.items())}) t(code, st)),
  m as (select 'band' as dimension, band as label, face from leads union all select 'book', book, face from leads union all select 'proof', proof, face from leads union all select 'stage', stage, face from leads
    union all select 'state', st, face from leads join states on substr(case_number, 19, 2) = code)
  select l.dimension, l.label, count(m.label) as n, cast(coalesce(sum(m.face), 0) as {SUM}) as face from labels l left join m on m.dimension = l.dimension and m.label = l.label group by 1, 2""")
def funnel_blocks(d: Domain):
    labels = d.spark.sql(f"with {_LABELS} select * from labels")
    measures = {c: F.col(c) for c in ("band", "book", "proof", "stage")} | {"state": ids.case_state(F.col("case_number"))}
    return book.counted_blocks(_book_rows(d), labels, measures)


@query(f"""{_LEADS} select root, book, face, case when book = 'STATE-OWNED' then 'public body' when band = 'D' then 'bankrupt or extinguished' else 'related party' end as reason from framed where book = 'STATE-OWNED' or band = 'D' or cast(root as bigint) % 13 = 0""")
def excluded_sheet(d: Domain):
    k = F.col("root").cast("bigint")
    reason = rules.cascade([(F.col("book") == "STATE-OWNED", "public body"), (F.col("band") == "D", "bankrupt or extinguished"), (k % 13 == 0, "related party")], "")
    return book.excluded_frame(_book_rows(d), reason)


@query(f"""{oracle_with("companies")}, {_PEOPLE}, f as (select root, name, situation <> '02' as inactive, substr(nature, 1, 1) = '1' as public, case when cast(root as bigint) % 5 = 0 then null else substr(activity, 1, 2) in ('64', '65', '66') end as bank from companies),
  r as (select *, row_number() over (partition by root order by case role when 49 then 0 when 5 then 1 when 16 then 2 when 10 then 3 else 4 end, name) as r from p)
  select f.root, f.name, r.name as person from f left join r on r.root = f.root and r.r = 1 where not coalesce(inactive, false) and not coalesce(public, false) and not coalesce(bank, false)""")
def ops_sheet(d: Domain):
    flags = rules.registry_flags(F.col("activity"), F.col("nature"), F.col("situation"))
    bank = F.when(F.col("root").cast("bigint") % 5 != 0, flags["is_bank"])
    return book.ops_frame(d.view("companies"), _people(d), [flags["is_inactive"], flags["is_public"], bank]).select("root", "name", "person")


@query(f"""{_LEADS}, v as (select unnest(['fund above face', 'fund below zero', 'quote above fund', 'parts do not add up', 'held but priced', 'paid within a year', 'unknown band', 'band D in the book', 'recovery out of range', 'no case number',
    'not a state court', 'filing year out of range', 'unknown proof', 'unknown book', 'root of other length', 'root not digits', 'not held but unpriced', 'bankrupt on a call tab', 'small creditor unflagged', 'phone not dialable', 'backup repeats a phone', 'debtor is an administrator', 'raw status in proof', 'share out of range']) as "check"),
  b as (select case "check" when 'fund above face' then fund > face when 'fund below zero' then fund < 0 when 'quote above fund' then quote > fund and fund >= 0 when 'parts do not add up' then abs(quote + premium - fund) > 0.02 when 'held but priced' then hold <> '' and fund <> 0
    when 'paid within a year' then years < 1 when 'unknown band' then band not in ('A', 'B', 'C', 'D', 'U') when 'band D in the book' then band = 'D' when 'recovery out of range' then recovery < 0 or recovery > 1 when 'no case number' then coalesce(case_number, '') = ''
    when 'not a state court' then substr(case_number, 17, 1) <> '8' when 'filing year out of range' then cast(substr(case_number, 12, 4) as int) not between 2005 and 2030 when 'unknown proof' then not regexp_matches(proof, '^(OK|NO TOTALS|PARTIAL|CHECK)')
    when 'unknown book' then book not in ('TRADE', 'FINANCIAL', 'STATE-OWNED') when 'root of other length' then length(root) <> 8 when 'root not digits' then not regexp_full_match(root, '[0-9]+') when 'not held but unpriced' then hold = '' and fund <= 0 when 'bankrupt on a call tab' then cast(root as bigint) % 17 = 0 when 'small creditor unflagged' then cast(root as bigint) % 3 = 0 and cast(root as bigint) % 5 <> 0
      when 'phone not dialable' then cast(root as bigint) % 6 = 5 when 'backup repeats a phone' then cast(root as bigint) % 8 = 0 when 'debtor is an administrator' then cast(root as bigint) % 10 = 7 when 'raw status in proof' then proof like 'QUARANTINED%' else cast(root as bigint) % 9 > 6 end as broken, "check" from framed, v)
  select "check", count(*) filter (broken) as n from b group by 1""")
def book_invariants(d: Domain):
    c = F.col
    checks = {
        "fund above face": lambda: c("fund") > c("face").cast("double"), "fund below zero": lambda: c("fund") < 0, "quote above fund": lambda: (c("quote") > c("fund")) & (c("fund") >= 0),
        "parts do not add up": lambda: F.abs(c("quote") + c("premium") - c("fund")) > 0.02, "held but priced": lambda: (c("hold") != "") & (c("fund") != 0), "paid within a year": lambda: c("years") < 1,
        "unknown band": lambda: ~c("band").isin("A", "B", "C", "D", "U"), "band D in the book": lambda: c("band") == "D", "recovery out of range": lambda: (c("recovery") < 0) | (c("recovery") > 1),
        "no case number": lambda: F.coalesce("case_number", F.lit("")) == "", "not a state court": lambda: ~ids.is_state_court(c("case_number")), "filing year out of range": lambda: ~ids.case_year(c("case_number")).between(2005, 2030),
        "unknown proof": lambda: ~c("proof").rlike("^(OK|NO TOTALS|PARTIAL|CHECK)"), "unknown book": lambda: ~c("book").isin("TRADE", "FINANCIAL", "STATE-OWNED"), "root of other length": lambda: F.length("root") != 8,
        "root not digits": lambda: ~c("root").rlike("^[0-9]+$"),
    }
    # what else a tab shows of a lead, wrong in a known part of the rows
    k = F.col("root").cast("bigint")
    shown = book.call_frame(_book_rows(d)).withColumns({
        "proceeding": F.when(k % 17 == 0, "Falência").otherwise("Recuperação judicial"), "size": F.when(k % 3 == 0, "MICRO EMPRESA").otherwise("DEMAIS"), "flags": F.when(k % 5 == 0, "ME/EPP creditor").otherwise(""),
        "phone": F.when(k % 6 == 5, "4463").when(k % 6 == 4, "0800 123 4567").when(k % 6 == 3, "4463-4833 (no DDD)").otherwise("(11) 94463-4833"),
        "debtor": F.when(k % 10 == 7, "Silva Administração Judicial").otherwise("Alfa Têxtil SA"), "share": F.when(k % 9 < 7, (k % 9 + 1) / 9.0).when(k % 9 == 7, 0.0).otherwise(1.5),
    })
    shown = shown.withColumn("backup_phone", F.when(k % 8 == 0, F.col("phone")))
    return book.violations(shown, checks | book.shown_checks())


@query(f"select coalesce(band, '?') as band, count(*) as n from ({ORACLES['debtor_band']}) group by 1")
def band_histogram(d: Domain):
    return QUERIES["debtor_band"](d.spark, d.sf_dir).groupBy(F.coalesce("band", F.lit("?")).alias("band")).agg(F.count("*").alias("n"))


# --- layout ---------------------------------------------------------------------------
@query("""with w as (select l_orderkey as doc_id, l_linenumber as n, l_quantity * 10 as x, l_discount * 1000 as y from lineitem), b as (select o_orderkey as doc_id, cast(o_orderkey % 5 * 100 as double) as x0, 20.0 as top, cast(o_orderkey % 5 * 100 + 150 as double) as x1, 70.0 as bottom from orders where o_orderkey % 3 <> 0)
  select doc_id, count(*) as n_outside from w where not exists (select 1 from b where b.doc_id = w.doc_id and x + 2 between x0 - 1 and x1 + 1 and y + 3 between top - 1 and bottom + 1) group by doc_id""")
def words_outside_boxes(d: Domain):
    x, y = F.col("l_quantity") * 10, F.col("l_discount") * 1000
    words = d.table("lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), x.alias("x0"), (x + 4).alias("x1"), y.alias("top"), (y + 6).alias("bottom"))
    k = F.col("o_orderkey") % 5 * 100
    boxes = d.table("orders").filter("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("doc_id"), F.lit(1).alias("page"), k.cast("double").alias("x0"), F.lit(20.0).alias("top"), (k + 150).cast("double").alias("x1"), F.lit(70.0).alias("bottom"))
    return grids.outside_words(words, boxes).groupBy("doc_id").agg(F.count("*").alias("n_outside"))


@query("""with a as (select c_custkey as k, 2.0 + c_custkey % 40 as h, cast(c_custkey % 800 as double) as top from customer), o as (select a.k, a.h, a.top, b.top as spot, abs(a.top - b.top) as d from a join a b on a.k // 50 = b.k // 50 and b.k % 3 = 0 and a.k % 3 <> 0 and abs(a.top - b.top) <= a.h * 4.5 + 2)
  select k, min(d) as distance, arg_min(spot, d * 10000 + spot) as anchor_top from o group by k""")
def nearest_anchor_far(d: Domain):
    """Anchors as far as 4.5 heights of any line, tall ones included."""
    c = d.table("customer").select("c_custkey", F.floor(F.col("c_custkey") / 50).alias("p"), (F.col("c_custkey") % 800).cast("double").alias("top"), (2.0 + F.col("c_custkey") % 40).alias("h"))
    orphans = c.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), "p", "top", "h")
    out = layout.nearest_anchor(orphans, c.filter("c_custkey % 3 = 0").select("p", "top"), ["p"], F.col("h"))
    return orphans.join(out, ["p", "top"]).select("k", "distance", "anchor_top")

