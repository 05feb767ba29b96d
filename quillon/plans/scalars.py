"""Queries of the scalar functions and the ordered classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids, money, phone, text
from ..functions.ids import COMPANY_WEIGHTS, COURT_STATE
from ..operators import rules
from .catalog import query
from .domain import oracle_with


def duck_digit(s: str, weights) -> str:
    """DuckDB: modulo-11 check digit of the string expression ``s``, as text."""
    total = " + ".join(f"cast(substr({s}, {i + 1}, 1) as int) * {w}" for i, w in enumerate(weights))
    return f"cast(case when ({total}) % 11 < 2 then 0 else 11 - ({total}) % 11 end as varchar)"


_MORE = (6, *COMPANY_WEIGHTS)
#: DuckDB: suppliers with a 14-digit identifier, a third of them damaged.
NUMBERED = f"""{oracle_with("companies")},
  one as (select *, root || '0001' as b12 from companies),
  two as (select *, b12 || {duck_digit("b12", COMPANY_WEIGHTS)} as b13 from one),
  numbered as (select *, b13 || {duck_digit("b13", _MORE)} as good, cast(root as bigint) % 3 as k from two),
  damaged as (select *, case k when 0 then good when 1 then substr(good, 1, 13) || cast((cast(substr(good, 14, 1) as int) + 1) % 10 as varchar) else substr(good, 1, 11) end as id from numbered)"""


def _numbered(d):
    c = d.view("companies").withColumn("good", ids.head_office(F.col("root"))).withColumn("k", F.col("root").cast("bigint") % 3)
    bad = F.concat(F.substring("good", 1, 13), ((F.substring("good", 14, 1).cast("int") + 1) % 10).cast("string"))
    return c.withColumn("id", F.when(F.col("k") == 0, F.col("good")).when(F.col("k") == 1, bad).otherwise(F.substring("good", 1, 11)))


_DUCK_VALID = f"""(length(id) = 14 and id <> repeat(substr(id, 1, 1), 14) and {duck_digit("id", COMPANY_WEIGHTS)} = substr(id, 13, 1) and {duck_digit("id", _MORE)} = substr(id, 14, 1))"""


@query(f"""{NUMBERED}
  select root, id, case when length(id) = 14 then {_DUCK_VALID} else false end as valid, good as head_office from damaged""")
def id_mod11_validate(d):
    return _numbered(d).select("root", "id", ids.is_valid_company(F.col("id")).alias("valid"), F.col("good").alias("head_office"))


@query(f"""{NUMBERED}, p as (select *, case when length(id) = 11 then {duck_digit("id", (10, 9, 8, 7, 6, 5, 4, 3, 2))} = substr(id, 10, 1) and {duck_digit("id", (11, 10, 9, 8, 7, 6, 5, 4, 3, 2))} = substr(id, 11, 1) else false end as person from damaged)
  select root, case length(id) when 14 then 'CNPJ' else 'CPF' end as kind, id as digits,
    case when length(id) = 14 then case when {_DUCK_VALID} then '' else 'CNPJ_INVALID' end when person then 'INDIVIDUAL' else 'INDIVIDUAL|CPF_INVALID' end as flags from p""")
def id_digits_classify(d):
    c = ids.classify(ids.masked(F.col("id")))
    return _numbered(d).select("root", c["kind"].alias("kind"), c["digits"].alias("digits"), F.array_join(c["flags"], "|").alias("flags"))


@query(f"""{NUMBERED}
  select root, case when length(id) = 14 then substr(id,1,2) || '.' || substr(id,3,3) || '.' || substr(id,6,3) || '/' || substr(id,9,4) || '-' || substr(id,13,2) else id end as masked, substr(id, 1, 8) as own_root from damaged""")
def id_format_root(d):
    return _numbered(d).select("root", ids.masked(F.col("id")).alias("masked"), ids.root(F.col("id")).alias("own_root"))


@query(f"""{NUMBERED}, tries as (select root, substr(id, 1, i - 1) || c || substr(id, i + 1) as id, substr(id, i, 1) as was, cast(c as varchar) as now_
     from damaged, unnest(range(1, 15)) t(i), (select cast(unnest(range(0, 10)) as varchar) as c) where length(id) = 14)
  select root, count(*) as n_repairs, min(id) as first_repair from tries where was <> now_ and {_DUCK_VALID} group by root""")
def id_single_digit_repair(d):
    r = ids.single_digit_repairs(F.col("id"))
    out = _numbered(d).select("root", r.alias("r")).filter(F.size("r") > 0)
    return out.select("root", F.size("r").cast("bigint").alias("n_repairs"), F.array_min("r").alias("first_repair"))


@query("""with b as (select o_orderkey, case when o_orderkey % 5 = 0 then -o_totalprice else o_totalprice end as v from orders),
  t as (select o_orderkey, replace(replace(replace(format('{:,.2f}', v), ',', 'X'), '.', ','), 'X', '.') as s from b)
  select o_orderkey, 'R$ ' || s as printed, case when o_orderkey % 7 = 0 then null when regexp_full_match(s, '([0-9]{1,3}(\\.[0-9]{3})+|[0-9]+),[0-9]{2}')
    then cast(replace(replace(s, '.', ''), ',', '.') as decimal(18,2)) end as parsed from t""")
def brl_format_parse(d):
    v = F.when(F.col("o_orderkey") % 5 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).cast("decimal(18,2)")
    printed = money.format_brl(v)
    damaged = F.when(F.col("o_orderkey") % 7 == 0, F.concat(printed, F.lit("0"))).otherwise(printed)
    return d.table("orders").select("o_orderkey", printed.alias("printed"), money.parse_brl(damaged).alias("parsed"))


@query("""select o_orderkey, cast(o_totalprice as decimal(18,2)) as value, case o_orderkey % 4 when 0 then 'USD' when 1 then 'EUR' else 'BRL' end as currency from orders""")
def currency_cell_parse(d):
    k = F.col("o_orderkey") % 4
    prefix = F.when(k == 0, "US$ ").when(k == 1, " EUR").when(k == 2, "R$").otherwise("")
    number = F.translate(F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2), ",.", ".,")
    c = money.cell_value(F.concat(prefix, number, F.when(k == 3, "*").otherwise(" ")))
    return d.table("orders").select("o_orderkey", c["value"].alias("value"), c["currency"].alias("currency"))


@query("""select p_partkey, case when p_partkey % 2 = 0 then p_name else p_name end as undoubled from part""")
def dedouble_text(d):
    twice = F.array_join(F.transform(F.split("p_name", " "), lambda w: F.regexp_replace(w, "(.)", "$1$1")), " ")
    name = F.when(F.col("p_partkey") % 2 == 0, twice).otherwise(F.col("p_name"))
    return d.table("part").select("p_partkey", text.dedouble(name).alias("undoubled"))


_DUCK_NORM = "trim(regexp_replace(upper(regexp_replace(strip_accents(coalesce({x}, '')), '[^\\x00-\\x7F]', '', 'g')), '[^A-Z0-9]+', ' ', 'g'))"


@query(f"""with n as (select doc_id, {_DUCK_NORM.format(x="text")} as normal from documents)
  select doc_id, md5(normal) as normal, cast(len(list_filter(string_split(normal, ' '), lambda t: (length(t) >= 3 or (length(t) = 2 and regexp_matches(t, '[0-9]'))) and not regexp_full_match(t, '[0-9]+'))) as bigint) as n_tokens from n""")
def norm_tokens(d):
    t = F.col("text")
    return d.table("documents").select("doc_id", F.md5(text.norm(t)).alias("normal"), F.size(text.tokens(t)).cast("bigint").alias("n_tokens"))


@query(f"""with n as (select s_suppkey, {_DUCK_NORM.format(x="s_name || ' de Comercio e Servicos x y'")} as normal from supplier)
  select s_suppkey, array_to_string(list_transform(list_filter(string_split(normal, ' '), lambda w: w not in ('DE','DA','DO','DAS','DOS','E','EM','')), lambda w: substr(w, 1, 1)), '') as acronym,
    array_to_string(list_filter(string_split(normal, ' '), lambda w: length(w) = 1), '') as initials from n""")
def acronyms(d):
    name = F.concat("s_name", F.lit(" de Comércio e Serviços x y"))
    return d.table("supplier").select("s_suppkey", text.acronym(name).alias("acronym"), text.initials(name).alias("initials"))


@query("select event_id, substr(regexp_replace(trim(event_type || ' ' || props || ' ' || cast(user_id as varchar) || ' ' || repeat('page 12 ', 12)), '[0-9]', '#', 'g'), 1, 80) as running_key from events")
def running_key(d):
    line = F.concat_ws(" ", "event_type", "props", F.col("user_id").cast("string"), F.repeat(F.lit("page 12 "), 12))
    return d.table("events").select("event_id", text.running_key(line).alias("running_key"))


_PHONE_K = "case c_custkey % 9 when 0 then lpad(cast(c_custkey % 100000000 as varchar), 8, '3') when 1 then '11' || lpad(cast(c_custkey as varchar), 8, '2') when 2 then '5511' || lpad(cast(c_custkey as varchar), 9, '9') when 3 then '0800' || lpad(cast(c_custkey as varchar), 7, '1') when 4 then '000000000' when 5 then '9' || lpad(cast(c_custkey as varchar), 8, '8') when 6 then '011' || lpad(cast(c_custkey as varchar), 8, '4') when 7 then '41' || lpad(cast(c_custkey as varchar), 7, '5') else '20' || lpad(cast(c_custkey as varchar), 8, '6') end"


@query(f"""with p as (select c_custkey, {_PHONE_K} as d, c_custkey % 9 as k from customer)
  select c_custkey, case k when 0 then substr(d,1,4) || '-' || substr(d,5) || ' (no DDD)' when 1 then '(11) ' || substr(d,3,4) || '-' || substr(d,7)
    when 2 then '(11) ' || substr(d,5,5) || '-' || substr(d,10) when 3 then substr(d,1,4) || ' ' || substr(d,5,3) || ' ' || substr(d,8) when 4 then ''
    when 5 then substr(d,1,5) || '-' || substr(d,6) || ' (no DDD)' when 6 then '(11) ' || substr(d,4,4) || '-' || substr(d,8)
    when 7 then '(41) ' || substr(d,3,4) || '-' || substr(d,7) || ' [digit missing]' else d || ' [check]' end as phone from p""")
def phone_format(d):
    k, key = F.col("c_custkey") % 9, F.col("c_custkey").cast("string")
    pad = lambda head, n, fill: F.concat(F.lit(head), F.lpad(key, n, fill))
    raw = (
        F.when(k == 0, pad("", 8, "3")).when(k == 1, pad("11", 8, "2")).when(k == 2, pad("5511", 9, "9")).when(k == 3, pad("0800", 7, "1")).when(k == 4, "000000000")
        .when(k == 5, pad("9", 8, "8")).when(k == 6, pad("011", 8, "4")).when(k == 7, pad("41", 7, "5")).otherwise(pad("20", 8, "6"))
    )
    return d.table("customer").select("c_custkey", phone.dialable(raw).alias("phone"))


_STATES = ", ".join(f"('{k}', '{v}')" for k, v in COURT_STATE.items())


@query(f"""{oracle_with("cases")}, states as (select * from (values {_STATES}) t(code, state))
  select custkey, cast(substr(case_number, 12, 4) as int) as year, substr(case_number, 17, 1) = '8' as state_court, state from cases left join states on substr(case_number, 19, 2) = code""")
def case_number_parts(d):
    c = ids.case_number(ids.digits(F.col("case_number")))
    return d.view("cases").select("custkey", ids.case_year(c).alias("year"), ids.is_state_court(c).alias("state_court"), ids.case_state(c).alias("state"))


# --- classifiers ---------------------------------------------------------------------
def _values(*columns) -> str:
    """Rows (k, ...) as SQL literals."""
    lit = lambda v: "null" if v is None else (str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'")
    return "(values " + ", ".join("(" + ", ".join([str(k), *map(lit, row)]) + ")" for k, row in enumerate(zip(*columns, strict=True))) + ")"


_NAMES = ["ALFA SA", "BETA S.A.", "GAMA LTDA", "DELTA S/A", ""]


@query(f"""{oracle_with("companies")}, n as (select *, k, nm from companies join {_values(_NAMES)} t(k, nm) on cast(root as bigint) % 5 = k)
  select root, case when nm = '' then 'UNKNOWN' when coalesce(capital, 0) = 0 then 'NO CAPITAL ON FILE'
    when capital >= 1000000000 or (k in (0, 1, 3) and capital >= 300000000) then 'LARGE CORP' when size like '%MICRO%' or size like '%PEQUENO%' then 'SMALL' else 'MID-MARKET' end as fit from n""")
def seller_fit(d):
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("root").cast("bigint") % 5 + 1).cast("int"))
    return d.view("companies").select("root", rules.seller_fit(name, F.col("capital"), F.col("size")).alias("fit"))


@query(f"""{oracle_with("companies")}
  select root, case when nature in ('2011','2038') then 'STATE-OWNED' when substr(activity,1,4) in ('6422','6611') then 'FINANCIAL' else 'TRADE' end as book,
    substr(activity,1,2) in ('64','65','66') as is_bank, substr(nature,1,1) = '1' as is_public, situation <> '02' as is_inactive from companies""")
def book_type(d):
    c = d.view("companies")
    f = rules.registry_flags(F.col("activity"), F.col("nature"), F.col("situation"))
    return c.select("root", rules.book(F.col("nature"), F.col("activity"), F.lit(None).cast("boolean")).alias("book"), f["is_bank"].alias("is_bank"), f["is_public"].alias("is_public"), f["is_inactive"].alias("is_inactive"))
