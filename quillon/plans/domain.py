"""Domain tables derived from the driver's tables, as SQL both engines read.

Claims are line items, documents are orders (the order's total is the printed
control total), companies are suppliers and parts, cases are customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS = {
    "claims": """
        select l_orderkey as doc_id, cast(l_linenumber as bigint) as page, l_partkey as row_index,
          cast(l_shipdate as date) as seen_on,
          lpad(cast(l_suppkey as string), 8, '0') as root,
          lpad(cast(l_suppkey as string), 8, '0') || lpad(cast(l_linenumber as string), 4, '0') as base12,
          case l_returnflag when 'A' then 'II' when 'N' then 'III' else null end as class,
          case when l_linestatus = 'O' then 'BRL' when l_quantity > 40 then 'USD' else null end as currency,
          case when l_quantity >= 48 then null else cast(l_extendedprice as decimal(18,2)) end as value_brl,
          case when l_discount >= 0.095 then 'NOT_A_CLAIM' when l_tax >= 0.075 then 'SECTION_TOTAL' when l_tax < 0.005 then 'CHECKED' else null end as flag,
          cast(l_linenumber as int) % 2 as section
        from {lineitem}""",
    "printed": """
        select o_orderkey as doc_id, cast(o_orderkey % 2 as int) as section,
          case o_orderstatus when 'F' then 'III' when 'O' then 'II' else null end as class,
          case when o_orderkey % 3 = 0 then 'USD' else 'BRL' end as currency,
          cast(floor(o_totalprice / 6) as decimal(18,2)) as total,
          case when o_orderpriority = '1-URGENT' then cast(1 as bigint) else null end as count
        from {orders}""",
    "docs": """
        select o_orderkey as doc_id, o_custkey as custkey,
          case when o_orderkey % 17 = 0 then null else lpad(cast(o_custkey as string), 7, '0') || '-11.20' || lpad(cast(10 + o_custkey % 15 as string), 2, '0') || '.' ||
            cast(5 + o_custkey % 4 as string) || '.' || lpad(cast(1 + o_custkey % 30 as string), 2, '0') || '.0001' end as case_number,
          case o_orderpriority when '1-URGENT' then 'QGC' when '2-HIGH' then 'AJ_LIST' when '3-MEDIUM' then 'DEBTOR_LIST' when '4-NOT SPECIFIED' then 'UNKNOWN' else 'PLAN' end as doc_type,
          case o_orderstatus when 'F' then 'OK' when 'O' then 'OK_NO_TOTALS' else 'QUARANTINED' end as status,
          (o_orderkey % 2 = 0) as class3_passed, cast(o_orderdate as date) as publication_date, cast(o_totalprice as decimal(18,2)) as total
        from {orders}""",
    "companies": """
        select lpad(cast(s_suppkey as string), 8, '0') as root, s_name as name, s_nationkey as nationkey, cast(s_acctbal as decimal(18,2)) as balance,
          case when s_suppkey % 13 = 0 then null else cast(round(s_acctbal * 100000, 0) as decimal(18,2)) end as capital,
          case s_suppkey % 5 when 0 then '2011' when 1 then '2038' when 2 then '1031' else '2062' end as nature,
          case s_suppkey % 4 when 0 then '6422100' when 1 then '4711302' when 2 then '6611801' else '2599399' end as activity,
          case s_suppkey % 7 when 0 then '08' when 1 then '03' else '02' end as situation,
          case s_suppkey % 3 when 0 then 'MICRO EMPRESA' when 1 then 'DEMAIS' else 'EMPRESA DE PEQUENO PORTE' end as size
        from {supplier}""",
    "cases": """
        select c_custkey as custkey, lpad(cast(c_custkey as string), 7, '0') || '-11.20' || lpad(cast(10 + c_custkey % 15 as string), 2, '0') || '.' ||
            cast(5 + c_custkey % 4 as string) || '.' || lpad(cast(1 + c_custkey % 30 as string), 2, '0') || '.0001' as case_number,
          c_mktsegment as segment, c_nationkey as nationkey, cast(c_acctbal as decimal(18,2)) as balance,
          case c_mktsegment when 'BUILDING' then 'ACTIVE' when 'MACHINERY' then 'CLOSED' when 'AUTOMOBILE' then 'CONVERTED_TO_BANKRUPTCY' when 'HOUSEHOLD' then 'ACTIVE' else null end as stage,
          case when c_custkey % 11 = 0 then 'FALENCIA' when c_custkey % 19 = 0 then 'EXTINCT' else null end as proceeding,
          case c_custkey % 6 when 0 then '08' when 1 then '04' when 2 then null else '02' end as situation,
          case c_custkey % 5 when 0 then 'NAME_MISMATCH' when 1 then null else 'MIRROR' end as registry,
          (c_custkey % 4 = 0) as granted, (c_custkey % 3 = 0) as plan_filed
        from {customer}""",
}


def oracle_with(*names: str) -> str:
    """A WITH clause of the named views over the registered tables."""
    tables = {t: t for t in TABLES}
    return "with " + ", ".join(f"{n} as ({VIEWS[n].format(**tables)})" for n in names)


class Domain:
    """The domain tables of one data folder, read lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        sql = VIEWS[name]
        return self.spark.sql(sql, **{t: self.table(t) for t in TABLES if "{" + t + "}" in sql})
