"""What a run produced, what it could not, and why: aggregates, frames and exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import export_csv

USED = ("OK", "OK_NO_TOTALS")
FLOOR = 200_000
BLOCKED_DOMAINS = 15
#: Columns of the six exports, and the order of their rows.
EXPORTS = {
    "cases": (["case_number", "court", "chamber", "debtor_name", "debtor_cnpj", "filing_date", "stage", "administrator_name", "administrator_cnpj", "source_url", "extracted_at", "extracted_by"], ["case_number"]),
    "documents": (["doc_id", "case_number", "doc_type", "publication_date", "source_url", "file_path", "pages", "printed_total_by_class", "status", "strategy", "layout_id", "notes", "extracted_at", "extracted_by"], ["doc_id"]),
    "claims": (["case_number", "doc_id", "page", "row_index", "creditor_name_as_printed", "document_number", "document_type", "class", "value_brl", "value_as_printed", "currency", "flags", "seq_as_printed", "debtor_as_printed", "extracted_at", "extracted_by"], ["doc_id", "page", "row_index"]),
    "companies": (["cnpj_basico", "razao_social", "natureza_juridica", "porte", "situacao_cadastral", "cnae_principal", "uf", "municipio", "phone", "email", "is_bank", "is_public", "is_inactive", "rfb_source", "rfb_fetched_at", "extracted_at", "extracted_by"], ["cnpj_basico"]),
    "targets": (["cnpj_basico", "case_number", "class_iii_face_sum", "establishment_cnpjs", "claim_count", "debtor_name", "stage", "is_related_party", "above_floor", "band", "doc_id", "creditor_name_as_printed", "flags", "extracted_at", "extracted_by"], ["-class_iii_face_sum", "cnpj_basico"]),
    "contacts": (["cnpj_basico", "person_name", "role", "cpf_masked", "linkedin_url", "phone", "email", "source", "confidence", "extracted_at", "extracted_by"], ["cnpj_basico", "person_name"]),
}


# --- aggregates -----------------------------------------------------------------------
def _part(name: str, df: DataFrame, key: Column | None = None, n: Column | None = None, m: Column | None = None, text: Column | None = None) -> DataFrame:
    null = lambda kind: F.lit(None).cast(kind)
    some = lambda c, kind: (null(kind) if c is None else c).cast(kind)
    return df.select(F.lit(name).alias("part"), some(key, "string").alias("key"), some(n, "long").alias("n"), some(m, "long").alias("m"), some(text, "string").alias("text"))


def aggregates(documents: DataFrame, claims: DataFrame, cases: DataFrame, companies: DataFrame, targets: DataFrame, raw: DataFrame) -> DataFrame:
    """(part, key, n, m, text): the thirteen aggregates of a run's report.

    documents: doc_id, case_number, status, strategy, layout_id, class3 (PASS, FAIL or
    other), source_url; claims: class, document_type, value_brl; cases: case_number,
    court; companies: root, source, fetched_at, is_bank, is_public, is_inactive;
    targets: root, band, flags; raw: domain, http_status.  Documents are grouped
    once, by grouping sets; their counts of all rows are in the empty set.
    """
    quarantined = F.col("status") == "QUARANTINED"
    layout = F.concat_ws("/", F.coalesce("strategy", F.lit("")), F.coalesce("layout_id", F.lit("")))
    d = documents.withColumn("layout", layout)
    sets = d.groupingSets([["status"], ["layout", "status"], []], "layout", "status").agg(
        F.grouping_id("layout", "status").alias("g"), F.count("*").alias("n"), F.count_if(quarantined & (F.col("class3") == "PASS")).alias("partial"), F.count_distinct("case_number").alias("cases")
    )
    status = _part("documents by status", sets.filter("g = 2"), F.col("status"), F.col("n"))
    layouts = _part("layouts", sets.filter("g = 0"), F.concat_ws(" · ", "layout", "status"), F.col("n"))
    whole = sets.filter("g = 3")
    partial, printed = _part("quarantined but used", whole, n=F.col("partial")), _part("documents and cases", whole, n=F.col("n"), m=F.col("cases"))
    failed = _part("quarantined, class III failed", d.filter(quarantined & (F.col("class3") == "FAIL")), F.col("doc_id").cast("string"), text=F.col("source_url"))
    covered = d.filter(F.col("case_number").isNotNull()).groupBy("case_number").agg(F.max(F.col("status").isin(*USED)).alias("used"))
    by_case = cases.select("case_number", "court").distinct().join(covered, "case_number", "left")
    coverage = _part("coverage by court", by_case.groupBy("court").agg(F.count_distinct("case_number").alias("n"), F.count_distinct(F.when(F.col("used"), F.col("case_number"))).alias("m")), F.col("court"), F.col("n"), F.col("m"))
    matched = _part("cases matched", by_case.agg(F.count_distinct(F.when(F.col("used").isNotNull(), F.col("case_number"))).alias("n")), n=F.col("n"))
    releases = companies.groupBy("source").agg(F.count("*").alias("n"), F.concat_ws(" … ", F.min("fetched_at").cast("string"), F.max("fetched_at").cast("string")).alias("t"))
    fetched = raw.groupBy("domain").agg(F.count_if(F.col("http_status") == 200).alias("good"), F.count_if(F.col("http_status") != 200).alias("bad"))
    worst = fetched.filter("bad > 0").orderBy(F.desc("bad"), "domain").limit(BLOCKED_DOMAINS)
    named = claims.filter((F.col("class") == "III") & (F.col("document_type") == "NONE") & F.col("value_brl").isNotNull())
    floor = targets.filter("band = 'FLOOR'")
    kinds = floor.select("root").distinct().join(companies, "root").agg(*[F.count_if(F.col(c)).alias(c) for c in ("is_bank", "is_public", "is_inactive")])
    by_name = floor.filter(F.arrays_overlap("flags", F.array(F.lit("LIKELY_FINANCIAL"), F.lit("LIKELY_PUBLIC")))).agg(F.count_distinct("root").alias("n"))
    bands = targets.groupBy("band").agg(F.count("*").alias("n"))
    parts = [
        status, layouts, partial, printed, failed, coverage, matched, _part("releases", releases, F.col("source"), F.col("n"), text=F.col("t")), _part("blocked", worst, F.col("domain"), F.col("bad")),
        _part("nothing retrievable", fetched.filter("good = 0"), F.col("domain"), F.col("bad")), _part("names to resolve", named.agg(F.count("*").alias("n")), n=F.col("n")), _part("leads by band", bands, F.col("band"), F.col("n")),
        _part("companies excluded", kinds.select(F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).alias("n")) for c in kinds.columns])).alias("x")).select("x.*"), F.col("k"), F.col("n")), _part("excluded by name", by_name, n=F.col("n")),
    ]
    return reduce(DataFrame.unionByName, parts)


def exports(tables: dict[str, DataFrame], path: str) -> list[str]:
    """Writes the exports whose table is given, each in its columns and order; columns a table lacks are empty."""
    done = []
    for name, (columns, order) in EXPORTS.items():
        if name in tables:
            df = tables[name].withColumns({c: F.lit(None).cast("string") for c in columns if c not in tables[name].columns})
            for k, o in enumerate(order):
                if o.startswith("-"):
                    df = df.withColumn(f"_down{k}", -F.col(o[1:]).cast("decimal(28,2)"))
            export_csv(df, f"{path}/{name}", columns, [f"_down{k}" if o.startswith("-") else o for k, o in enumerate(order)])
            done.append(name)
    return done


# --- frames of the operations book -----------------------------------------------------
def sources_frame(documents: DataFrame, checks: DataFrame) -> DataFrame:
    """The sources tab: documents with their checks told in words (checks: doc_id, unit, pass, delta)."""
    one = F.concat(F.col("unit"), F.lit(": "), F.when(F.col("pass"), "PASS").otherwise("FAIL"), F.lit(" Δ"), F.coalesce(F.col("delta").cast("string"), F.lit("")))
    told = checks.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit", one.alias("t")))), lambda c: c["t"]), " · ").alias("checks"))
    return documents.join(told, "doc_id", "left").withColumn("checks", F.coalesce("checks", F.lit("")))


def needs_id_frame(claims: DataFrame, best: DataFrame, floor: float = FLOOR) -> DataFrame:
    """Class III rows of the best documents (best: doc_id) at or above the floor whose list prints no id."""
    rows = claims.join(best.select("doc_id"), "doc_id", "left_semi")
    large = (F.col("class") == "III") & (F.col("currency") == "BRL") & (F.col("document_type") == "NONE") & (F.col("value_brl") >= floor)
    return rows.filter(large & ~F.coalesce(F.array_contains("flags", "NOT_A_CLAIM"), F.lit(False)))


def diff_frame(old: DataFrame, new: DataFrame) -> DataFrame:
    """The diff tab: the old sheet's rows against this run's leads by root and case.

    old: creditor, root, case_number, amount, status; new: root, case_number, face,
    n_claims, n_establishments.  verdict: NEW_ONLY (no old amount), SAME (under 1 apart),
    CHANGED or NOT_IN_NEW_RUN, and why.
    """
    n = new.select(F.col("root").alias("_root"), F.coalesce("case_number", F.lit("")).alias("_case"), "face", "n_claims", "n_establishments")
    out = old.join(n, (old["root"] == n["_root"]) & (F.coalesce(old["case_number"], F.lit("")) == n["_case"]), "left")
    delta = F.col("face") - F.col("amount")
    absent = F.col("_root").isNull()
    verdict = F.when(absent, "NOT_IN_NEW_RUN").when(F.col("amount").isNull(), "NEW_ONLY").when(F.abs(delta) < 1, "SAME").otherwise("CHANGED")
    summed = F.when(F.col("n_claims") > 1, F.concat(F.col("n_claims").cast("string"), F.lit(" claims summed, "), F.col("n_establishments").cast("string"), F.lit(" establishments")))
    dropped = F.when((F.col("amount") > 0) & (F.col("face") > 5 * F.col("amount")), F.lit("a leading digit was probably dropped"))
    why = F.coalesce(F.nullif(F.concat_ws("; ", summed, dropped), F.lit("")), F.lit("read again from the document's own row"))
    out = out.withColumn("delta", F.when(~absent, delta)).withColumn("verdict", verdict)
    return out.withColumn("why", F.when(F.col("verdict") == "CHANGED", why).when(absent, "not harvested or below the floor").when(F.col("verdict") == "NEW_ONLY", "no old amount").otherwise("")).drop("_root", "_case")


def verdict_counts(diff: DataFrame) -> DataFrame:
    """(verdict, n, delta): every verdict, and all rows as null."""
    return diff.rollup("verdict").agg(F.count("*").alias("n"), F.sum("delta").alias("delta"))


def book_counts(leads: DataFrame, documents: DataFrame, needs: DataFrame, diff: DataFrame) -> DataFrame:
    """(frame, n): the rows of every tab, which the cover and the report quote."""
    tabs = leads.groupBy(F.concat(F.lit("leads "), F.col("band")).alias("frame")).agg(F.count("*").alias("n"))
    docs = documents.agg(F.count("*").alias("d"), F.count_distinct("case_number").alias("c")).select(F.explode(F.array(F.struct(F.lit("documents").alias("frame"), F.col("d").alias("n")), F.struct(F.lit("cases").alias("frame"), F.col("c").alias("n")))).alias("x")).select("x.*")
    one = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("frame"), "n")
    verdicts = diff.groupBy(F.concat(F.lit("diff "), F.col("verdict")).alias("frame")).agg(F.count("*").alias("n"))
    return reduce(DataFrame.unionByName, [tabs, docs, one("needs id", needs), verdicts])

