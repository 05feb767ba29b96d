"""Queries of probes, readers and small text operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids, phone, text
from ..operators import resolve, rules
from ..sources import files, pages
from .catalog import query
from .classifiers import _class_sql, _has, _normal, _plain, combined, combined_sql
from .domain import Domain, oracle_with


@query("""select doc_id, coalesce(list_sum(list_transform(string_split(coalesce(text, ''), chr(10))[1:3], lambda p: length(p))), 0) > 80 as has_text from documents""")
def text_layer_probe(d: Domain):
    """Whether the first three pages (here lines) hold enough text."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    return d.table("documents").select("doc_id", files.has_text_layer(lines).alias("has_text"))


_HOST = "regexp_replace(lower(regexp_extract(url, '://([^/?#:]*)', 1)), '^www\\.', '')"


@query(f"""select {_HOST} as domain, 'lists/' || page_id || case when page_id % 2 = 0 then '.pdf' else '.PDF' end as key from pages where page_id % 3 <> 0""")
def bucket_listing(d: Domain):
    """Keys of documents in each site's listing."""
    p = d.table("pages").select(pages.host(F.col("url")).alias("domain"), "page_id")
    ending = F.when(F.col("page_id") % 3 == 0, ".html").when(F.col("page_id") % 2 == 0, ".pdf").otherwise(".PDF")
    entry = F.concat(F.lit("<Contents><Key>lists/"), F.col("page_id").cast("string"), ending, F.lit("</Key><Size>1</Size></Contents>"))
    xml = p.groupBy("domain").agg(F.concat(F.lit("<ListBucketResult>"), F.array_join(F.collect_list(entry), ""), F.lit("</ListBucketResult>")).alias("xml"))
    # a listing is read site by site
    keys = xml.select("domain", F.explode(F.regexp_extract_all("xml", F.lit("<Key>([^<]+)</Key>"), F.lit(1))).alias("key"))
    listed = pages.listing_keys(xml.select("xml"))
    return keys.join(listed, "key", "left_semi")


@query(f"""{oracle_with("companies")}, w as (select distinct root || '000191' as cnpj from companies), c as (select *, cast(substr(cnpj, 1, 8) as bigint) % 3 as k from w) select cnpj, case k when 0 then 200 when 1 then 404 end as status, k = 2 as to_fetch from c""")
def registry_lookup(d: Domain):
    """Which ids the cache answers, misses included, and which have to be asked for."""
    c = d.view("companies").select(F.concat("root", F.lit("000191")).alias("cnpj"))
    k = F.substring("cnpj", 1, 8).cast("bigint") % 3
    cache = c.filter(k < 2).select("cnpj", F.when(k == 0, 200).otherwise(404).alias("status"))
    wanted = c.unionByName(c).unionByName(c.select(F.lit("123").alias("cnpj"))).select(F.concat(F.lit(" "), "cnpj").alias("cnpj"))
    hits, missing = files.lookup(wanted, cache)
    return hits.select("cnpj", "status", F.lit(False).alias("to_fetch")).unionByName(missing.select("cnpj", F.lit(None).cast("int").alias("status"), F.lit(True).alias("to_fetch")))


_NAMES = (("Classificação", "Alfa", "Total", "Classe III", "Quirografário", "R$", "Resumo geral", "Valor da causa", ""), ("", "Ltda", "- quirografários", "1.000,00", "dos créditos trabalhistas", "12"))


@query(f"""with t as (select o_orderkey, {combined_sql("o_orderkey", _NAMES)} as x, o_orderkey % 4 = 0 as has_document from orders), u as (select *, {_plain("x")} as u from t)
  select o_orderkey, not has_document and x <> '' and ({_has("u", rules.SUMMARY)} or ({_class_sql("u")} is not null and length(x) < 45 and not regexp_matches(x, '[0-9]'))) as summary from u""")
def summary_rows(d: Domain):
    """Rows that name a class or a total instead of a creditor."""
    k = F.col("o_orderkey")
    return d.table("orders").select("o_orderkey", rules.is_summary_row(combined(k, _NAMES), k % 4 == 0).alias("summary"))


@query("""select doc_id, md5(array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda s: case when regexp_matches(s, 'und|the |que') then repeat(' ', length(s)) else s end), chr(10))) as kept, length(coalesce(text, '')) as n from documents""")
def noise_blanking(d: Domain):
    """Lines of noise turned to blanks; every other character keeps its place."""
    blank = text.blanked(F.col("text"), "und|the |que")
    return d.table("documents").select("doc_id", F.md5(blank.cast("binary")).alias("kept"), F.length(blank).cast("long").alias("n"))


_TOLD = f"""{oracle_with("claims")}, t as (select doc_id, page, row_index, case page % 4 when 0 then 'pago a ' || base12 || '91 e ' || substr(base12, 1, 9) || '-01' when 1 then substr(base12, 1, 2) || '.' || substr(base12, 3, 3) || '.' || substr(base12, 6, 3) || '/' || substr(base12, 9, 4) || '-00; ' || base12 || '55' when 2 then 'CPF ' || substr(base12, 1, 3) || '.' || substr(base12, 4, 3) || '.' || substr(base12, 7, 3) || '-12' else 'sem documento ' || page end as x from claims),
  c as (select *, regexp_extract_all(x, '[0-9]{{2}}\\.?[0-9]{{3}}\\.?[0-9]{{3}}/?[0-9]{{4}}-?[0-9]{{2}}') as companies, regexp_replace(x, '[0-9]{{2}}\\.?[0-9]{{3}}\\.?[0-9]{{3}}/?[0-9]{{4}}-?[0-9]{{2}}', '#', 'g') as rest from t)"""


@query(f"""{_TOLD} select doc_id, page, row_index, array_to_string(list_concat(list_transform(companies, lambda v: 'CNPJ ' || regexp_replace(v, '[^0-9]', '', 'g')), list_transform(regexp_extract_all(rest, '[0-9]{{3}}\\.?[0-9]{{3}}\\.?[0-9]{{3}}-?[0-9]{{2}}'), lambda v: 'CPF ' || regexp_replace(v, '[^0-9]', '', 'g'))), ', ') as found from c""")
def found_documents(d: Domain):
    """Identifiers in texts: companies', then persons' outside them."""
    b = F.col("base12")
    part = lambda i, n: F.substring(b, i, n)
    x = (
        F.when(F.col("page") % 4 == 0, F.concat(F.lit("pago a "), b, F.lit("91 e "), part(1, 9), F.lit("-01")))
        .when(F.col("page") % 4 == 1, F.concat(part(1, 2), F.lit("."), part(3, 3), F.lit("."), part(6, 3), F.lit("/"), part(9, 4), F.lit("-00; "), b, F.lit("55")))
        .when(F.col("page") % 4 == 2, F.concat(F.lit("CPF "), part(1, 3), F.lit("."), part(4, 3), F.lit("."), part(7, 3), F.lit("-12")))
        .otherwise(F.concat(F.lit("sem documento "), F.col("page").cast("string")))
    )
    told = F.array_join(F.transform(ids.found(x), lambda f: F.concat(f["kind"], F.lit(" "), f["digits"])), ", ")
    return d.view("claims").select("doc_id", "page", "row_index", told.alias("found"))


_FIRMS = (("Alfa", "Beta", "Gama Delta", "SA", ""), ("Comércio", "Têxtil", "12", "Ltda"), ("", "do Brasil", "e Filhos"))


def _tokens_sql(x: str) -> str:
    return f"list_filter(string_split({_normal(x)}, ' '), lambda w: (length(w) >= 3 or (length(w) = 2 and regexp_matches(w, '[0-9]'))) and not regexp_full_match(w, '[0-9]+'))"


@query(f"""with t as (select c_custkey, {combined_sql("c_custkey", _FIRMS)} as a, {combined_sql("c_custkey * 7", _FIRMS)} as b from customer), w as (select *, {_tokens_sql("a")} as ta, {_tokens_sql("b")} as tb from t)
  select c_custkey, len(ta) > 0 and len(tb) > 0 and len(list_intersect(ta, tb)) = 0 as check_identity from w""")
def organisation_check(d: Domain):
    """Contacts whose organisation shares no word with the registry's name."""
    k = F.col("c_custkey")
    return d.table("customer").select("c_custkey", resolve.needs_check(combined(k, _FIRMS), combined(k * 7, _FIRMS)).alias("check_identity"))


_PEOPLE = (("João", "Ana", "Alfa", "José"), ("da Silva", "Lima", "Participações", "Paz", "Ltda", ""))


@query(f"""with t as (select s_suppkey, {_normal(combined_sql("s_suppkey", _PEOPLE))} as a, {_normal(combined_sql("(s_suppkey * 5 + 1)", _PEOPLE))} as b from supplier)
  select s_suppkey, array_to_string(list_sort(list_distinct(list_filter([a, b], lambda n: contains(n, ' ') and not regexp_matches(n, '\\b(LTDA|SA|S A|EIRELI|ME|EPP|PARTICIPACOES|HOLDING)\\b')))), '; ') as partners from t""")
def partner_sets(d: Domain):
    """Persons among the registered partners, by normal name."""
    k = F.col("s_suppkey")
    one = lambda key: F.struct(combined(key, _PEOPLE).alias("nome"))
    return d.table("supplier").select("s_suppkey", F.array_join(resolve.partner_names(F.array(one(k), one(k * 5 + 1))), "; ").alias("partners"))


@query("""with t as (select c_custkey, case c_custkey % 4 when 0 then '11' || lpad(cast(c_custkey as varchar), 8, '4') when 1 then '(11) 9' || lpad(cast(c_custkey as varchar), 8, '5') when 2 then cast(c_custkey as varchar) end as x from customer), d as (select *, regexp_replace(coalesce(x, ''), '[^0-9]', '', 'g') as d from t)
  select c_custkey, case length(d) when 10 then '(' || substr(d, 1, 2) || ') ' || substr(d, 3, 4) || '-' || substr(d, 7) when 11 then '(' || substr(d, 1, 2) || ') ' || substr(d, 3, 5) || '-' || substr(d, 8) else coalesce(x, '') end as shown from d""")
def phone_simple(d: Domain):
    """Phones as the operations book prints them."""
    k, n = F.col("c_custkey") % 4, F.col("c_custkey").cast("string")
    x = F.when(k == 0, F.concat(F.lit("11"), F.lpad(n, 8, "4"))).when(k == 1, F.concat(F.lit("(11) 9"), F.lpad(n, 8, "5"))).when(k == 2, n)
    return d.table("customer").select("c_custkey", phone.simple(x).alias("shown"))
