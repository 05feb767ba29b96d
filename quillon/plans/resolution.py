"""Queries of header resolution, names, kinship and contacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import token_set_ratio
from ..operators import kin, resolve
from .catalog import query
from .domain import Domain, oracle_with
from .sqltext import token_sets


@query(f"""{oracle_with("docs")} select doc_id, case when doc_id % 3 = 0 then case_number when doc_id % 3 = 1 then 'portal' end as case_number, case when doc_id % 3 = 0 and case_number is not null then '' when doc_id % 3 = 1 then 'CASE_FROM_PAGE' else 'CASE_NUMBER_MISSING' end as case_flag,
  case when publication_date >= date '2000-01-01' then publication_date end as publication_date, 'QGC' as doc_type, case when doc_id % 2 = 0 then 'ALFA ' || doc_id || ' LTDA' else 'title' end as debtor_hint from docs""")
def header_resolution(d: Domain):
    k = F.col("doc_id") % 3
    other = F.lit(" 0000001-11.2011.8.26.0001 ")
    case = F.when((k == 0) & F.col("case_number").isNotNull(), F.concat(other, "case_number", F.lit(" e "), "case_number")).otherwise("")
    debtor = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" Recuperação Judicial de Alfa "), F.col("doc_id").cast("string"), F.lit(" Ltda, "))).otherwise("")
    text = F.concat(F.lit("Quadro Geral "), F.date_format("publication_date", "dd/MM/yyyy"), case, debtor)
    h = resolve.header(text, F.when(k == 1, "portal,second"), F.lit("title"))
    return d.view("docs").select("doc_id", h.alias("h")).select("doc_id", "h.*")


@query("select c_custkey, case c_custkey % 3 when 0 then 'ALFA ' || c_custkey when 1 then 'BETA S.A' end as name, case c_custkey % 3 when 0 then 'FALENCIA' end as proceeding from customer")
def slug_names(d: Domain):
    k = F.col("c_custkey") % 3
    url = F.when(k == 0, F.concat(F.lit("http://x.com/falencia_alfa-"), F.col("c_custkey").cast("string"), F.lit("__12"))).when(k == 1, F.lit("http://x.com/recuperacao-judicial_beta-s+a__7")).otherwise("http://x.com/")
    s = resolve.slug(url)
    return d.table("customer").select("c_custkey", s["name"].alias("name"), s["proceeding"].alias("proceeding"))


_KIN_SIDES = f"""c as (select lpad(cast(s_suppkey as varchar), 8, '0') as root, case s_suppkey % 3 when 0 then 'ALFA' || s_suppkey // 3 || ' BETA' || s_suppkey % 40 || ' COMERCIO LTDA' when 1 then 'BETA' || s_suppkey % 40 || ' ALFA' || s_suppkey // 3 || ' SERVICOS SA' else 'GAMA' || s_suppkey // 3 || ' BETA' || s_suppkey % 40 || ' KAPPA' || s_suppkey % 40 || ' LTDA' end as name, 'SOCIO' || s_suppkey % 200 || ' SILVA' as partner from supplier),
  d as (select c_custkey as debtor_id, case when c_custkey % 7 = 0 then lpad(cast(c_custkey % 2000 as varchar), 8, '0') end as own_root, case when c_custkey % 11 = 0 then lpad(cast(c_custkey * 3 % 3000 as varchar), 8, '0') end as member, case when c_custkey % 5 = 0 then 'SOCIO' || c_custkey % 1500 || ' SILVA' end as partner,
    case c_custkey % 4 when 0 then 'GRUPO ALFA' || c_custkey % 101 // 3 || ' PARTICIPACOES' when 1 then 'GAMMA' || c_custkey % 101 // 3 || ' BETA' || c_custkey % 101 % 40 || ' KAPPA' || c_custkey % 101 % 40 || ' LTDA' when 2 then 'OMEGA' || c_custkey % 101 || ' BETA' || c_custkey % 101 % 40 || ' HOLDING' else 'SIGMA' || c_custkey % 101 || ' TAU' || c_custkey % 101 end as debtor from customer),
  ct as (select *, list_filter(string_split(name, ' '), lambda w: length(w) >= 3) as toks from c), g as (select list(tok) as gen from (select tok from (select distinct root, unnest(toks) as tok from ct) group by tok having count(*) >= 6)),
  cw as (select ct.*, list_filter(toks, lambda w: not list_contains(coalesce(gen, []), w)) as words from ct, g), dw as (select d.*, list_filter(list_filter(string_split(debtor, ' '), lambda w: length(w) >= 3), lambda w: not list_contains(coalesce(gen, []), w)) as dwords from d, g)"""


@query(f"""with {_KIN_SIDES}, p as (select cw.root, dw.debtor_id, name, debtor, words, dwords, coalesce(own_root = root, false) as own, coalesce(member = root, false) as grp, coalesce(cw.partner = dw.partner, false) as soc, list_intersect(words, dwords) as shared from cw, dw),
  q as (select * from p where own or grp or soc or len(shared) > 0), {token_sets("q", "debtor", "name")},
  r as (select *, case when own then 'own root' when grp then 'group member' when list_contains(shared, words[1]) or list_contains(shared, dwords[1]) then 'shared head name' when len(shared) > 0 and len(dwords) >= 2 and score >= 90 then 'same name' when soc then 'shared partner' end as kin from scored)
  select root, debtor_id, kin from r where kin is not null""")
def kinship(d: Domain):
    """All creditors against all debtors, by what they share."""
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    third, x = F.floor(k / 3), c % 101
    name = F.when(k % 3 == 0, text("ALFA", third, " BETA", k % 40, " COMERCIO LTDA")).when(k % 3 == 1, text("BETA", k % 40, " ALFA", third, " SERVICOS SA")).otherwise(text("GAMA", third, " BETA", k % 40, " KAPPA", k % 40, " LTDA"))
    creditors = d.table("supplier").select(F.lpad(k.cast("string"), 8, "0").alias("root"), name.alias("name"), kin.partner_keys(F.array(text("Sócio", k % 200, " Silva"))).alias("partners"))
    debtor = F.when(c % 4 == 0, text("GRUPO ALFA", F.floor(x / 3), " PARTICIPACOES")).when(c % 4 == 1, text("GAMMA", F.floor(x / 3), " BETA", x % 40, " KAPPA", x % 40, " LTDA"))
    debtor = debtor.when(c % 4 == 2, text("OMEGA", x, " BETA", x % 40, " HOLDING")).otherwise(text("SIGMA", x, " TAU", x))
    root = lambda v: F.lpad(v.cast("string"), 8, "0")
    debtors = d.table("customer").select(
        c.alias("debtor_id"), F.when(c % 7 == 0, root(c % 2000)).alias("root"), F.when(c % 11 == 0, F.array(root(c * 3 % 3000))).alias("member_roots"), debtor.alias("name"), F.when(c % 5 == 0, kin.partner_keys(F.array(text("Sócio", c % 1500, " Silva")))).alias("partners")
    )
    return kin.related(creditors, debtors, resolve.frequent_tokens(creditors, "name"))


@query(f"""with n as (select a.s_suppkey, upper(replace(a.s_name, '#', ' ')) as x, upper(replace(b.s_name, '#', ' ')) as y from supplier a join supplier b on b.s_suppkey = a.s_suppkey + 1), {token_sets("n", "x", "y")} select s_suppkey, score from scored""")
def fuzzy_match(d: Domain):
    """Company names that agree with their neighbour's, by word sets."""
    s = d.table("supplier").select("s_suppkey", "s_name")
    other = s.select((F.col("s_suppkey") - 1).alias("s_suppkey"), F.col("s_name").alias("other"))
    return s.join(other, "s_suppkey").select("s_suppkey", token_set_ratio(F.col("s_name"), F.col("other")).alias("score"))


_PRINTED = [("ALFA COMERCIO LTDA", "ALFA COMERCIO E SERVICOS LTDA", False), ("BETA LTDA", "GAMA TEXTIL SA", True), ("EMPRESA MINEIRA COMPUTADORES", "EMC TECNOLOGIA", False), ("DELTAMAQ", "DELTA MAQUINAS", False), ("RUA DAS FLORES", "GAMA TEXTIL SA", False)]


@query("select s_suppkey, mismatch from supplier join (values " + ", ".join(f"({k}, {str(m).lower()})" for k, (_, _, m) in enumerate(_PRINTED)) + f") t(k, mismatch) on s_suppkey % {len(_PRINTED)} = k")
def name_mismatch(d: Domain):
    at = (F.col("s_suppkey") % len(_PRINTED) + 1).cast("int")
    pick = lambda i: F.element_at(F.array(*[F.lit(p[i]) for p in _PRINTED]), at)
    generic = F.array(*map(F.lit, ("LTDA", "COMERCIO", "SERVICOS", "EMPRESA")))
    return d.table("supplier").select("s_suppkey", resolve.name_mismatch(pick(0), pick(1), generic).alias("mismatch"))


@query(f"""{oracle_with("docs")} select case_number, bool_or(doc_type = 'PLAN' or (doc_id % 7 = 0 and doc_id % 2 <> 0)) as plan_filed, false as granted from docs group by case_number""")
def plan_signals(d: Domain):
    k = F.col("doc_id")
    url = F.when(k % 7 == 0, F.when(k % 2 == 0, "x/plano-homologado.pdf").otherwise("x/Plano_de_Recuperação.pdf")).otherwise("x/lista.pdf")
    docs = d.view("docs").withColumn("source_url", url).withColumn("page_title", F.lit(None).cast("string")).withColumn("link_text", F.lit(""))
    return resolve.plan_filed(docs)


@query("""with p as (select c_custkey, lpad(cast(c_nationkey as varchar), 8, '0') as root, c_custkey // 10 as id, case when c_custkey % 4 = 0 then 'VERIFY name' when c_custkey % 4 = 1 then 'other' end as note from customer),
  f as (select *, row_number() over (partition by root, id order by c_custkey) as r from p), k as (select * from f where r = 1 and id % 3 <> 0)
  select root, id, cast(row_number() over (partition by root order by c_custkey) as int) as rank, case when note like 'VERIFY%' then note end as note from k""")
def contact_merge(d: Domain):
    pick = F.array(F.struct(F.floor(F.col("c_custkey") / 10).alias("id"), F.lit("CFO").alias("title")))
    note = F.when(F.col("c_custkey") % 4 == 0, "VERIFY name").when(F.col("c_custkey") % 4 == 1, "other")
    results = d.table("customer").select(F.lpad(F.col("c_nationkey").cast("string"), 8, "0").alias("root"), F.lit(None).cast("array<string>").alias("also_roots"), note.alias("note"), F.col("c_custkey").alias("pass_no"), pick.alias("picks"))
    people = d.table("customer").select(F.floor(F.col("c_custkey") / 10).alias("id")).distinct().filter("id % 3 <> 0")
    return resolve.ranked_matches(resolve.merged_picks(results), people).select("root", "id", "rank", "note")


@query("""select c_custkey, case when c_custkey % 5 = 0 then null else 'a' || c_custkey || '@' || case c_custkey % 5 when 1 then 'ok.com' else 'fine.org' end end as email, case when c_custkey % 5 = 0 then null else 'valid' end as email_status, case when c_custkey % 5 = 0 then 'blocked domain spam.net' end as block_note from customer""")
def contact_blocklist(d: Domain):
    k = F.col("c_custkey")
    domain = F.when(k % 5 == 0, "SPAM.net").when(k % 5 == 1, "ok.com").otherwise("fine.org")
    c = d.table("customer").select("c_custkey", F.concat(F.lit("a"), k.cast("string"), F.lit("@"), domain).alias("email"), F.lit("valid").alias("email_status"))
    return resolve.screened(c, d.spark.sql("select 'Spam.net' as domain"))


@query("""select user_id, max(value) filter (event_type = 'click') as x, arg_max(value, event_id) filter (event_type = 'view') as mobile, coalesce(arg_max(value, event_id) filter (event_type = 'error'), arg_max(value, event_id) filter (event_type = 'signup')) as direct from events group by user_id""")
def phone_pivot(d: Domain):
    kind = F.when(F.col("event_type") == "view", "mobile").when(F.col("event_type") == "error", "work_direct").when(F.col("event_type") == "signup", "other").otherwise("fax")
    each = F.array_sort(F.collect_list(F.struct("event_id", kind.alias("type"), F.col("value").alias("number"))))
    e = d.table("events").groupBy("user_id").agg(each.alias("p"), F.max(F.when(F.col("event_type") == "click", F.col("value"))).alias("x"))
    got = resolve.phones(F.transform("p", lambda v: F.struct(v["type"].alias("type"), v["number"].alias("number"))))
    return e.select("user_id", "x", got["mobile"].alias("mobile"), got["direct"].alias("direct"))


@query(f"""{oracle_with("docs")} select doc_id, case when doc_id % 10 = 3 then 'corrected' else case_number end as case_number from docs""")
def key_correction(d: Domain):
    docs = d.view("docs").select("doc_id", "case_number")
    return resolve.corrected(docs, docs.filter("doc_id % 10 = 3").select("doc_id", F.lit("corrected").alias("case_number")))


@query(f"""{oracle_with("cases")} select custkey, case when custkey % 4 = 0 then 'Reader ' || custkey when coalesce(registry, '') = 'MIRROR' then 'Reg ' || custkey when custkey % 3 = 0 then 'HINT NAME LTDA' else '' end as debtor from cases""")
def debtor_names(d: Domain):
    k = F.col("custkey").cast("string")
    verified = F.when(F.col("custkey") % 4 == 0, F.concat(F.lit("Reader "), k))
    hint = F.when(F.col("custkey") % 3 == 0, "Silva Advogados - Hint Name Ltda").otherwise("Administrador Judicial")
    return d.view("cases").select("custkey", resolve.debtor_name(verified, F.concat(F.lit("Reg "), k), F.col("registry"), hint).alias("debtor"))


@query("""select o_orderkey, 'Reader ' || o_orderkey as verified_name, case when o_orderkey % 2 = 0 then lpad(cast(o_orderkey as varchar), 14, '0') end as verified_cnpj from orders where o_orderkey % 5 >= 3""")
def verified_name_ingest(d: Domain):
    k = F.col("o_orderkey")
    readings = d.table("orders").select(
        k.alias("case_number"), F.concat(F.lit(" Reader "), k.cast("string"), F.lit(" ")).alias("debtor_name"), F.when(k % 2 == 0, F.lpad(k.cast("string"), 14, "0")).otherwise("123").alias("debtor_cnpj"),
        F.lit(None).cast("string").alias("proceeding"), ((k % 5) / 5.0).alias("confidence"),
    )
    return resolve.verified_names(readings).select(F.col("case_number").alias("o_orderkey"), "verified_name", "verified_cnpj")


_NAMED = "['Alfa', 'Beta', 'Gama', 'Delta', 'Épsilon', 'Zeta']"


@query(f"""with o as (select o_orderkey as doc_id, o_orderkey % 10 as way, {_NAMED}[o_custkey % 6 + 1] || ' ' || o_custkey as n from orders)
  select doc_id, case when doc_id % 11 = 0 then 'known' else case way when 0 then n || ' Ltda' when 1 then n || ' S.A' when 2 then n || ' Comércio' when 3 then n || ' ME' when 4 then n || ' e Filhos Ltda' when 5 then n || ' SA' when 6 then n || ' Têxtil' when 7 then n || ' EPP' when 8 then n || ' Cia' else '' end end as debtor from o""")
def debtors_from_texts(d: Domain):
    """Each wording wins somewhere: alone, behind a better one without a credible name, behind incredible matches of its own."""
    o = F.col("o_orderkey")
    n = F.concat(F.element_at(F.array(*map(F.lit, ("Alfa", "Beta", "Gama", "Delta", "Épsilon", "Zeta"))), (F.col("o_custkey") % 6 + 1).cast("int")), F.lit(" "), F.col("o_custkey").cast("string"))
    ways = {
        0: F.concat(F.lit("Processo 1\nRecuperanda(s): "), n, F.lit(" Ltda, CNPJ 1\nAutora: Outra Empresa SA")),
        1: F.concat(F.lit("RECUPERANDA: 2ª Vara Empresarial\nRequerente – "), n, F.lit(" S.A. (e outras)")),
        2: F.concat(F.lit("Devedor: Dr. João, OAB 1\nDEVEDORA: "), n, F.lit(" Comércio; passivo")),
        3: F.concat(F.lit("Pedido: "), n, F.lit(" ME (REQUERENTE)")),
        4: F.concat(F.lit("ação ajuizada pelas: (i) "), n, F.lit(" e Filhos Ltda; (ii) Outra")),
        5: F.concat(F.lit("Pedido de Recuperação Judicial de Empresa "), n, F.lit(" SA e sócios")),
        6: F.concat(F.lit("RJ do Grupo "), n, F.lit(" Têxtil\nfls. 2")),
        7: F.concat(F.lit("Recuperanda: Administradora Judicial X\nRecuperanda: "), n, F.lit(" EPP CNPJ 2")),
        8: F.concat(F.lit("Autores: ab\n"), F.lit("RECUPERACAO JUDICIAL DA "), n, F.lit(" Cia, em curso")),
        9: F.lit("Edital de credores da comarca"),
    }
    text = F.lit("")
    for way, t in ways.items():
        text = F.when(o % 10 == way, t).otherwise(text)
    docs = d.table("orders").select(o.alias("doc_id"), text.alias("text"))
    return resolve.read_debtors(docs, docs.filter("doc_id % 11 = 0").select("doc_id", F.lit("known").alias("debtor")))


@query(f"""with c as (select c_custkey as k, {_NAMED}[c_custkey % 6 + 1] || c_custkey as n from customer)
  select k, case k % 5 when 0 then n || ' Indústria Ltda' when 1 then n || ' Têxtil' when 2 then 'Grupo ' || n when 3 then '' else n || ' SA' end as debtor from c""")
def debtors_from_titles(d: Domain):
    """Parts of titles and hints: offices, the site's own name and numbers go, company-like ones win."""
    k = F.col("c_custkey")
    n = F.concat(F.element_at(F.array(*map(F.lit, ("Alfa", "Beta", "Gama", "Delta", "Épsilon", "Zeta"))), (k % 6 + 1).cast("int")), k.cast("string"))
    title = F.when(k % 5 == 0, F.concat(F.lit("Processos - "), n, F.lit(" Indústria Ltda | Silva Consultoria"))).when(k % 5 == 1, F.concat(F.lit("Recuperação Judicial da "), n, F.lit(" Têxtil – Advogados"))).when(k % 5 == 2, F.concat(F.lit("Uma Empresa Bem Longa - Grupo "), n)).when(k % 5 == 3, "Início | 123-4 | silvaaj").otherwise("silvaaj")
    hint = F.when(k % 5 == 4, F.concat(n, F.lit(" SA")))
    return d.table("customer").select(k.alias("k"), resolve.best_title(title, hint, F.lit("silvaaj.com.br")).alias("debtor"))
