"""Queries of the ordered classifiers on texts that tables combine.

A row's text is put together from pools of words by its key, so that all
combinations come in turn; the SQL puts the same texts together and tries the same
wordings in the same order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import norm
from ..operators import resolve, rules
from ..sources import pages
from .catalog import query
from .domain import Domain, oracle_with
from .sqltext import token_sets

Pools = tuple[tuple[str, ...], ...]


def combined(key: Column, pools: Pools) -> Column:
    """A word of each pool, the first pool turning fastest; empty words leave no blank."""
    parts, stride = [], 1
    for pool in pools:
        at = (F.floor(key / stride) % len(pool) + 1).cast("int")
        parts.append(F.nullif(F.element_at(F.array(*map(F.lit, pool)), at), F.lit("")))
        stride *= len(pool)
    return F.concat_ws(" ", *parts)


def combined_sql(key: str, pools: Pools) -> str:
    parts, stride = [], 1
    for pool in pools:
        words = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in pool) + "]"
        parts.append(f"nullif({words}[{key} // {stride} % {len(pool)} + 1], '')")
        stride *= len(pool)
    return f"concat_ws(' ', {', '.join(parts)})"


def _has(x: str, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"regexp_matches({x}, '{quoted}')"


#: SQL: plain letters, upper case; normal form.
PLAIN = "upper(regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g'))"
NORMAL = f"trim(regexp_replace({PLAIN}, '[^A-Z0-9]+', ' ', 'g'))"


def _plain(x: str) -> str:
    return PLAIN.format(x=x)


def _normal(x: str) -> str:
    return NORMAL.format(x=x)


def _class_sql(u: str) -> str:
    named = f"nullif(regexp_extract({u}, '{rules.CLASS_HEAD}', 1), '')"
    return f"coalesce({named}, case {' '.join(f'when {_has(u, p)} then {k!r}' for k, p in rules.CLASS_WORDS)} end)"


_LINES: Pools = (
    ("CLASSE III", "Classe", "Relação", "TOTAL", "Créditos", "Soma", "Transportes", "Valor total", "", "Página 3"),
    ("-", "de credores", "GERAL", "com garantia real", "não sujeitos", "da classe II", "Ltda", "trabalhistas"),
    ("", "Quirografários", "R$ 10,00", "Fazenda Pública", "assinado eletronicamente", "ME/EPP", "extraconcursais"),
)


@query(f"""with t as (select event_id, {combined_sql("event_id", _LINES)} as x from events), u as (select *, {_plain("x")} as u from t), c as (select *, {_class_sql("u")} as class from u)
  select event_id, case when {_has("u", rules.NOISE)} then 'NOISE' when {_has("u", rules.TOTAL_WORD)} and not {_has("u", rules.COMPANY_SUFFIX)} and {_has("u", rules.TOTAL_LINE)} then 'TOTAL' when {_has("u", rules.BOUNDARY)} then 'BOUNDARY'
    when length(x) between 1 and 160 and class is not null and ({_has("u", rules.CLASS_HEAD)} or {_has("u", rules.LIST_OPENING)}) then 'CLASS' else 'ROW' end as kind, class from c""")
def heading_classifier(d: Domain):
    x = combined(F.col("event_id"), _LINES)
    return d.table("events").select("event_id", rules.line_kind(x).alias("kind"), rules.class_of_text(x).alias("class"))


_DOCS: Pools = (
    ("Quadro", "Relação", "Plano de Recuperação", "Edital", "Sentença que homologa", "Petição", "Segunda Lista"),
    ("Geral", "de credores", "do Administrador Judicial", "art. 7, § 2", "art. 52", "art. 51", "da lista"),
    ("", "com relação anexa", "2a lista", "do plano de recuperação"),
)


@query(f"""with t as (select o_orderkey, {_plain(combined_sql("o_orderkey", _DOCS))} as u from orders)
  select o_orderkey, case when {_has("u", "QUADRO[ -]GERAL")} then 'QGC' when {_has("u", "ART[.]?\\s*7\\s*[O]?\\s*,?\\s*(§|PARAGRAFO)?\\s*2\\b|\\b2A LISTA|SEGUNDA LISTA")} then 'AJ_LIST' when contains(left(u, 600), 'PLANO DE RECUPERA') and not contains(left(u, 600), 'RELA') then 'PLAN'
    when {_has("u", "ART[.]?\\s*5[12]")} then 'DEBTOR_LIST' when contains(u, 'ADMINISTRADOR') and {_has("u", "RELA|LISTA")} then 'AJ_LIST' when contains(u, 'HOMOLOG') then 'HOMOLOG' else 'UNKNOWN' end as kind from t""")
def doc_type_rules(d: Domain):
    return d.table("orders").select("o_orderkey", rules.document_type(combined(F.col("o_orderkey"), _DOCS)).alias("kind"))


_TITLES: Pools = (
    ("Diretor", "Gerente", "Coordenador", "Analista", "Sócia", "Assistente", "Supervisor", "", "Head of"),
    ("Financeiro", "de Marketing", "de Cobrança", "Comercial", "de Compras", "de RH", "geral", "de Crédito", "fin"),
    ("", "e Vendas", "da Tesouraria", "Pleno"),
)


@query(f"""with t as (select c_custkey, lower({_plain(combined_sql("c_custkey", _TITLES))}) as t from customer)
  select c_custkey, case when {_has("t", rules.TIER_A)} and (not {_has("t", rules.TIER_NOT)} or {_has("t", rules.TITLE_MONEY)}) then 'A' when {_has("t", rules.TITLE_MANAGER)} and not {_has("t", rules.TIER_NOT)} then 'B' else 'C' end as tier from t""")
def title_tier(d: Domain):
    return d.table("customer").select("c_custkey", rules.title_tier(combined(F.col("c_custkey"), _TITLES)).alias("tier"))


_SELLERS: Pools = (
    ("Massa Falida de", "Banco", "FIDC", "Comercial", "Securitizadora", "Falida", ""),
    ("Alfa", "em Liquidação", "Beta Fundo de Investimento", "Gama Ltda"),
    ("", "em Recuperação Judicial", "em Recuperação Extrajudicial"),
)


@query(f"""{oracle_with("companies")}, t as (select root, situation, cast(root as bigint) % 5 = 0 as unnamed, {combined_sql("cast(root as bigint)", _SELLERS)} as x from companies), u as (select *, case when unnamed then '' else {_plain("x")} end as b from t)
  select root, case when {_has("b", "MASSA FALIDA|\\bFALID[AO]\\b")} then 'FALIDA — only its AJ can sell (court authorisation)' when contains(b, 'LIQUIDACAO') then 'EM LIQUIDAÇÃO — only the liquidante (BCB/court) can sell'
    when {_has("b", "RECUPERACAO (JUDICIAL|EXTRAJUDICIAL)")} then 'IN RJ ITSELF — its own judge must authorise the sale (art. 66; AJ/Comitê heard)' when {_has("b", "FUNDO DE INVESTIMENTO|\\bFIDC\\b|\\bFIM\\b|SECURITIZADORA")} then 'FUND / SECURITISER — the administrator or gestora signs; check the fund regulation'
    when unnamed or x = '' then 'no RFB record — status unknown' when situation <> '02' then 'RFB ' || situation || ' — confirm who signs' else 'ATIVA' end as status from u""")
def seller_status(d: Domain):
    k = F.col("root").cast("bigint")
    name = F.when(k % 5 != 0, combined(k, _SELLERS))
    return d.view("companies").select("root", rules.seller_status(name, F.lit(None).cast("string"), F.col("situation"), F.lit(None).cast("string")).alias("status"))


_HEADS: Pools = (
    ("Classe III", "Credores", "Créditos", "Total da Classe III", "Classe II", "Classe I", "Classe IV", "Lista", ""),
    ("- Quirografários", "subordinados", "não sujeitos", "- Garantia real", "trabalhistas", "ME e EPP", "R$ 1.000,00"),
    ("", "extraconcursais", "com privilégio", "e ilíquidos"),
)
#: The look-ahead of the wordings, spelled out for an engine that has none: class I and II, not those after.
_OTHER_SQL = rules.HEAD_OTHER.replace(r"CLASSE I\b(?! ?I)", "CLASSE I($| [^I]| $)").replace(r"CLASSE II\b(?! ?I)", "CLASSE II($| [^I]| $)")


@query(f"""with t as (select o_orderkey, {combined_sql("o_orderkey", _HEADS)} as x from orders), u as (select *, {_normal("x")} as h, o_orderkey % 3 = 0 as reconciled, o_orderkey % 5 <> 0 as section from t),
  f as (select *, len(list_distinct(regexp_extract_all(h, '({rules.HEAD_LEGEND})', 1))) >= 3 as legend, {_has("x", "[0-9]{1,3}(\\.[0-9]{3})+,[0-9]{2}")} and not {_has("h", "TOTAL|CREDOR")} as row_like, section and {_has("h", _OTHER_SQL)} as inherited from u)
  select o_orderkey, case when h = '' or legend or row_like or length(h) > 160 then '' when contains(h, 'SUBORDINAD') and not {_has("h", "PRIVILEGIO|QUIROGRAF")} then 'SUBORDINATED' when {_has("h", rules.HEAD_OUT)} then 'OUT_OF_SCOPE'
    when inherited and contains(h, 'TOTAL') then 'BELOW_TOTAL' when inherited and not reconciled then 'OTHER_CLASS' else '' end as verdict from f""")
def heading_verdict(d: Domain):
    k = F.col("o_orderkey")
    set_by = F.when(k % 5 != 0, "SECTION_HEADING").otherwise("COLUMN")
    return d.table("orders").select("o_orderkey", rules.heading_verdict(combined(k, _HEADS), k % 3 == 0, set_by).alias("verdict"))


_LISTS: Pools = (
    ("quorum", "plano", "relação", "edital", "lista", "qgc", "quadro", "2a relação", ""),
    ("da assembleia", "de credores da recuperanda", "do administrador", "de processamento", "da massa falida", "homologado", "provisório", "art. 52", "de credores"),
    ("", "prj", "concessão", "artigo 7", "art. 51"),
)
_TYPES = ("UNKNOWN", "PLAN", "OTHER", "QGC", "AJ_LIST")


def _list_sql() -> str:
    cases = []
    for of_type, some, none, name in rules.LIST_RULES:
        words = " and ".join([_has("b", p) for p in some or []] + ([f"not {_has('b', none)}"] if none else [])) or "false"
        cases.append(f"when {f'kind = {of_type!r} or ' if of_type else ''}({words}) then '{name.replace(chr(39), chr(39) * 2)}'")
    named = " ".join(f"when kind = '{k}' then '{v}'" for k, v in rules.LIST_KIND.items())
    return f"case {' '.join(cases)} {named} else kind end"


@query(f"""with t as (select o_orderkey, {_normal(combined_sql("o_orderkey", _LISTS))} as b, ['{"', '".join(_TYPES)}'][o_orderkey // 7 % {len(_TYPES)} + 1] as kind from orders) select o_orderkey, {_list_sql()} as kind from t""")
def list_kind(d: Domain):
    none, k = F.lit(None).cast("string"), F.col("o_orderkey")
    kind = F.element_at(F.array(*map(F.lit, _TYPES)), (F.floor(k / 7) % len(_TYPES) + 1).cast("int"))
    return d.table("orders").select("o_orderkey", rules.list_kind(kind, none, combined(k, _LISTS), none).alias("kind"))


_HEADERS: Pools = (("Valor", "Crédito", "Importância", "Total", "Saldo", "2A Lista", "Montante"), ("atualizado", "", "admitido", "AJ", "nominal", "original", "QGC", "1A"))


@query(f"""with t as (select o_orderkey, {_normal(combined_sql("o_orderkey", _HEADERS))} as u from orders)
  select o_orderkey, case when {_has("u", "ATUALIZ|ADMITID|HABILITAD|RECONHEC")} then 5 when {_has("u", "\\b2A\\b|SEGUNDA|\\bAJ\\b|ADMINISTRADOR|QGC|QUADRO")} then 4 when {_has("u", "CREDITO|TOTAL")} then 3 when {_has("u", "VALOR|IMPORT|MONTANTE")} then 2 when {_has("u", "\\b1A\\b|NOMINAL|ORIGINAL|PRINCIPAL")} then 1 else 0 end as score from t""")
def value_header_score(d: Domain):
    return d.table("orders").select("o_orderkey", rules.value_header_score(combined(F.col("o_orderkey"), _HEADERS)).alias("score"))


_PATHS: Pools = (("credores", "plano", "edital", "ata", "laudo", "decisao", "contato", "qgc"), ("lista", "relatório", "homologação", "art. 7", "aditivo", "mensal", ""), ("2024", "relação de credores", "leilão", "PRJ"))


_ANCHOR_SQL = """(?is)<a\\b[^>]*?href\\s*=\\s*["'']([^"''#]+)["''][^>]*>(.*?)</a>"""


@query(f"""with a as (select page_id, unnest(list_zip(range(len(regexp_extract_all(html, '{_ANCHOR_SQL}', 1))), regexp_extract_all(html, '{_ANCHOR_SQL}', 1), regexp_extract_all(html, '{_ANCHOR_SQL}', 2))) as z from pages),
  b as (select page_id, z[1] as pos, z[2] as href, trim(regexp_replace(regexp_replace(z[3], '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) as inside from a),
  l as (select page_id, -1 as pos, url || '/' || {combined_sql("page_id", _PATHS)} as raw from pages
    union all select page_id, cast(pos as int), href || ' ' || inside || case when pos % 2 = 0 then ' ' || {combined_sql("(page_id + pos)", _PATHS)} else '' end from b),
  t as (select page_id, pos, lower({_plain("raw")}) as s from l), k as (select page_id, pos, case when {_has("s", rules.LINK_HARD_SKIP)} then 'SKIP 0' when {_has("s", rules.LINK_SKIP)} and not {_has("s", rules.LINK_STRONG)} then 'SKIP 0' when {_has("s", rules.LINK_STRONG)} then 'LIST 3'
    when {_has("s", rules.LINK_PLAN)} then 'PLAN 2' when {_has("s", rules.LINK_GRANT)} then 'HOMOLOG 2' when {_has("s", rules.LINK_LIST)} then 'LIST 1' else 'OTHER 0' end as k from t)
  select page_id, pos, split_part(k, ' ', 1) as kind, cast(split_part(k, ' ', 2) as int) as score from k""")
def link_classifier(d: Domain):
    """Every link of every page and the page's own address (pos -1), by the real word lists."""
    p = d.table("pages")
    own = p.select("page_id", F.lit(-1).alias("pos"), F.concat("url", F.lit("/"), combined(F.col("page_id"), _PATHS)).alias("href"), F.lit("").alias("inner"))
    links = pages.anchors(p, ["page_id"])
    # the words come in turn on every second link; the others stay as the page has them
    words = F.when(F.col("pos") % 2 == 0, F.concat(F.lit(" "), combined(F.col("page_id") + F.col("pos"), _PATHS))).otherwise("")
    return pages.classified(own.unionByName(links.withColumn("inner", F.concat("inner", words)))).select("page_id", "pos", "kind", "score")


_FIRMS: Pools = (("Alfa", "Beta Gama", "Delta", "Épsilon", "Alpha"), ("Comércio", "Comercio de Alimentos", "Têxtil", "Indústria"), ("Ltda", "S.A.", "", "em Recuperação Judicial"))
_OTHERS: Pools = (("Alfa", "Beta", "Zeta", "Epsilon Delta"), ("Comércio", "Textil", "Serviços Gerais"), ("LTDA", "", "EM RECUPERACAO JUDICIAL"))


@query(f"""with t as (select s_suppkey, case when s_suppkey % 11 = 0 then '' else {_normal(combined_sql("s_suppkey", _FIRMS))} end as a, case when s_suppkey % 7 = 0 then null else {_normal(combined_sql("s_suppkey * 5", _OTHERS))} end as b from supplier), p as (select s_suppkey, a, coalesce(b, '') as b, b is null as gone from t), {token_sets("p", "a", "b")}
  select s_suppkey, case when gone then 'NOT_IN_RFB' when a = '' or contains(b, 'EM RECUPERACAO JUDICIAL') or score >= {resolve.ACCEPT} then 'ACCEPTED' else 'NAME_MISMATCH' end as verdict from scored""")
def registry_accept(d: Domain):
    k = F.col("s_suppkey")
    name, registry = F.when(k % 11 != 0, combined(k, _FIRMS)).otherwise(""), F.when(k % 7 != 0, norm(combined(k * 5, _OTHERS)))
    return d.table("supplier").select("s_suppkey", resolve.registry_verdict(name, registry).alias("verdict"))


@query("""select case when starts_with(text, 'T') then sha1(text) else 'ERR:' || sha1('u' || lpad(cast(doc_id as varchar), 9, '0')) end as sha1, min('u' || lpad(cast(doc_id as varchar), 9, '0')) as url, count(distinct doc_id) as n_aliases, max(strlen(text)) as size, max(case when not starts_with(text, 'T') then 'NOT_PDF' end) as error from documents group by 1""")
def content_dedupe(d: Domain):
    """Texts as files: those that begin like the wanted kind (here with a T) by their content, the others as errors."""
    url = F.concat(F.lit("u"), F.lpad(F.col("doc_id").cast("string"), 9, "0"))
    files = d.table("documents").select(url.alias("url"), F.col("text").cast("binary").alias("content"))
    out = pages.deduplicated(files, "54")
    return out.select("sha1", "url", F.size("aliases").cast("long").alias("n_aliases"), F.col("size").cast("long").alias("size"), "error")


_HINTS: Pools = (
    ("Recuperação Judicial de", "", "RJ da", "Processo 123 -", "Massa Falida", "Empresa", "Falência de"),
    ("Alfa Indústria Ltda", "Beta S.A.", "Silva Advogados", "0000001-11.2011.8.26.0001", "ab", "Gama Têxtil"),
    ("", "| Administração Judicial XYZ", "- em Recuperação Judicial", "| Delta Comércio", "- Página inicial"),
)


@query(f"""with t as (select s_suppkey, {combined_sql("s_suppkey", _HINTS)} as x from supplier), p as (select s_suppkey, regexp_split_to_array(trim(regexp_replace(regexp_replace(strip_accents(x), '[^\\x00-\\x7F]', '', 'g'), '\\s+', ' ', 'g')), ' [|-] ') as parts from t),
  g as (select s_suppkey, upper(coalesce(list_filter(parts, lambda p: p <> '' and not regexp_matches(lower(p), '{resolve.SITE_WORDS}') and not regexp_matches(p, '^{resolve.CASE}$'))[1], '')) as n from p),
  c as (select s_suppkey, regexp_replace(regexp_replace(regexp_replace(n, '{resolve.PREFIX_WORDS}', '', 'g'), '{resolve.SUFFIX_WORDS}', '', 'g'), '^[\\s\\-:|,]+|[\\s\\-:|,]+$', '', 'g') as n from g)
  select s_suppkey, case when length(n) >= 4 and regexp_matches(n, '[A-Z]{{3}}') then n else '' end as name from c""")
def hint_cleaning(d: Domain):
    return d.table("supplier").select("s_suppkey", resolve.clean_hint(combined(F.col("s_suppkey"), _HINTS)).alias("name"))
