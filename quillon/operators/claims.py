"""Claims to targets: reconcile, best document, dedupe, rollup, banding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import is_valid_company
from ..functions.money import MONEY
from .rules import cascade

SUM = "decimal(28,2)"
FLOOR, POOL = 200_000, 100_000
#: Ranks of a document's type and status.
TYPE_RANK = {"QGC": 4, "AJ_LIST": 3, "DEBTOR_LIST": 2, "UNKNOWN": 1, "HOMOLOG": 0, "PLAN": 0}
STATUS_RANK = {"OK": 3, "PARTIAL_DOC": 2, "OK_NO_TOTALS": 1}
BAD_FLAGS = ("NOT_A_CLAIM", "INDIVIDUAL", "CNPJ_INVALID", "VALUE_UNPARSEABLE")


def _ranked(x: Column, table: dict[str, int]) -> Column:
    return F.coalesce(*[F.when(x == k, F.lit(v)) for k, v in table.items()], F.lit(0))


def usable_documents(documents: DataFrame) -> DataFrame:
    """Proved documents, or quarantined ones whose class III reconciled."""
    partial = (F.col("status") == "QUARANTINED") & F.col("class3_passed")
    kinds = F.col("doc_type").isin("QGC", "AJ_LIST", "DEBTOR_LIST", "UNKNOWN")
    kept = documents.filter((F.col("status").isin("OK", "OK_NO_TOTALS") | partial) & kinds)
    return kept.withColumn("status", F.when(F.col("status") == "QUARANTINED", "PARTIAL_DOC").otherwise(F.col("status")))


def best_documents(documents: DataFrame) -> DataFrame:
    """One usable document per case: type, status, date, rows; then least doc_id."""
    key = F.coalesce("case_number", F.concat(F.lit("UNKNOWN:"), F.substring(F.col("doc_id").cast("string"), 1, 10)))
    order = [
        _ranked(F.col("doc_type"), TYPE_RANK).desc(),
        _ranked(F.col("status"), STATUS_RANK).desc(),
        F.coalesce(F.col("publication_date").cast("string"), F.lit("")).desc(),
        F.col("n_rows").desc(),
        F.col("doc_id").asc(),
    ]
    ranked = documents.withColumn("case_key", key).withColumn("_r", F.row_number().over(Window.partitionBy("case_key").orderBy(*order)))
    return ranked.filter("_r = 1").drop("_r")


def tradeable(claims: DataFrame) -> DataFrame:
    """Class III claims in BRL with a value, a valid company id and no bad flag."""
    return claims.filter(_open()).filter(is_valid_company(F.col("document_number")))


def _open() -> Column:
    bad = F.arrays_overlap("flags", F.array(*map(F.lit, BAD_FLAGS))) | F.exists("flags", lambda f: f.startswith("SECTION_"))
    return (F.col("class") == "III") & (F.col("currency") == "BRL") & F.col("value_brl").isNotNull() & ~bad


def exact_distinct(claims: DataFrame) -> DataFrame:
    """First row (least claim_id) of each (document, id, value, class).

    A grouped minimum rather than a window: it combines before the shuffle.
    """
    rest = [c for c in claims.columns if c not in ("doc_id", "document_number", "value_brl", "class")]
    first = F.min_by(F.struct(*rest), F.col("claim_id")).alias("_first")
    return claims.groupBy("doc_id", "document_number", "value_brl", "class").agg(first).select("doc_id", "document_number", "value_brl", "class", "_first.*")


def rollup_by_root(claims: DataFrame) -> DataFrame:
    """Per document and company root: face, establishments, count, name, flags."""
    name = F.max_by("creditor_name", F.struct(F.length("creditor_name"), -F.col("claim_id")))
    return claims.groupBy("doc_id", F.substring("document_number", 1, 8).alias("root")).agg(
        F.sum("value_brl").cast(SUM).alias("face"),
        F.array_sort(F.collect_set("document_number")).alias("establishments"),
        F.count("*").alias("n_claims"),
        name.alias("creditor_name"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("flags")))).alias("flags"),
    )


def band_of(face: Column) -> Column:
    return F.when(face >= FLOOR, "FLOOR").when(face >= POOL, "POOL")


def targets(claims: DataFrame, documents: DataFrame) -> DataFrame:
    """The target mart: best document per case, rolled up and banded."""
    best = best_documents(usable_documents(documents)).select("doc_id", "case_key", "case_number", "status")
    # the columns that the rollup needs, of the documents that count, before anything costly
    open_claims = claims.filter(_open()).select("doc_id", "document_number", "value_brl", "class", "currency", "claim_id", "creditor_name", "flags")
    rolled = rollup_by_root(exact_distinct(tradeable(open_claims.join(best.select("doc_id"), "doc_id", "left_semi")).drop("currency")))
    out = rolled.withColumn("band", band_of(F.col("face"))).filter(F.col("band").isNotNull()).join(best, "doc_id")
    more = F.array_compact(
        F.array(
            F.when(F.col("status") == "OK_NO_TOTALS", F.lit("UNRECONCILED_SOURCE")),
            F.when(F.col("status") == "PARTIAL_DOC", F.lit("PARTIAL_DOC_CLASS_III_RECONCILED")),
            F.when(F.col("case_number").isNull(), F.lit("CASE_NUMBER_MISSING")),
        )
    )
    return out.withColumn("flags", F.array_sort(F.array_union("flags", more)))


# --- reconcile -----------------------------------------------------------------------
def extracted_totals(rows: DataFrame) -> DataFrame:
    """Sums, counts and missing values per (document, section, class/currency)."""
    key = F.concat_ws("/", F.coalesce("class", F.lit("?")), F.coalesce("currency", F.lit("BRL")))
    kept = rows.filter(~F.array_contains("flags", "NOT_A_CLAIM"))
    return kept.groupBy("doc_id", "section", key.alias("unit")).agg(
        F.coalesce(F.sum("value_brl"), F.lit(0)).cast(SUM).alias("extracted_sum"),
        F.count("*").alias("extracted_count"),
        F.count_if(F.col("value_brl").isNull()).alias("value_missing"),
    )


def tolerance(total: Column) -> Column:
    return F.greatest(total.cast(SUM) * F.lit("0.005").cast("decimal(4,3)"), F.lit(1000).cast(SUM))


def checks(extracted: DataFrame, printed: DataFrame) -> DataFrame:
    """One check per unit with a printed total: the best of its candidates.

    A total whose section has rows of its class is that section's; the others
    are the document's and only stand for classes without a section total.
    """
    key = F.concat_ws("/", "class", F.coalesce("currency", F.lit("BRL")))
    named = printed.filter(F.col("class").isNotNull() & (F.col("total").isNotNull() | F.col("count").isNotNull())).withColumn("unit", key).select("doc_id", "section", "unit", "total", "count")
    own = named.join(extracted, ["doc_id", "section", "unit"]).withColumn("level", F.lit("SECTION"))
    covered = own.select("doc_id", "unit").distinct()
    loose = named.join(extracted.select("doc_id", "section", "unit"), ["doc_id", "section", "unit"], "left_anti").join(covered, ["doc_id", "unit"], "left_anti")
    whole = extracted.groupBy("doc_id", "unit").agg(
        F.sum("extracted_sum").cast(SUM).alias("extracted_sum"), F.sum("extracted_count").alias("extracted_count"), F.sum("value_missing").alias("value_missing")
    )
    loose = loose.drop("section").join(whole, ["doc_id", "unit"], "left").withColumn("section", F.lit(None).cast("int")).withColumn("level", F.lit("DOCUMENT"))
    loose = loose.fillna(0, ["extracted_sum", "extracted_count", "value_missing"])
    every = own.unionByName(loose)
    delta = (F.coalesce("extracted_sum", F.lit(0)) - F.col("total")).cast(SUM)
    passed = F.coalesce(F.abs(delta) <= tolerance(F.col("total")), F.lit(True)) & F.coalesce(F.col("extracted_count") == F.col("count"), F.lit(True))
    every = every.withColumn("delta", delta).withColumn("pass", passed)
    score = F.struct(F.col("pass"), (-F.coalesce(F.abs("delta"), F.lit(0))).cast(SUM), -F.coalesce(F.col("total"), F.lit(0)).cast(SUM), -F.coalesce(F.col("count"), F.lit(0)))
    best = F.max_by(F.struct("total", "count", "extracted_sum", "extracted_count", "value_missing", "delta", "pass"), score)
    return every.groupBy("doc_id", "section", "unit", "level").agg(best.alias("b"), F.count("*").alias("n_candidates")).select("doc_id", "section", "unit", "level", "b.*", "n_candidates")


def reconcile(rows: DataFrame, printed: DataFrame, documents: DataFrame) -> DataFrame:
    """doc_id, status, n_checks, n_failed, class3 (PASS, FAIL, NO_TOTAL, NO_ROWS)."""
    extracted = extracted_totals(rows)
    done = checks(extracted, printed)
    verdict = done.groupBy("doc_id").agg(
        F.count("*").alias("n_checks"),
        F.count_if(~F.col("pass")).alias("n_failed"),
        F.bool_and(F.when(F.col("unit") == "III/BRL", F.col("pass"))).alias("class3_pass"),
    )
    claim = ~F.array_contains("flags", "NOT_A_CLAIM")
    class3 = (F.col("class") == "III") & (F.coalesce("currency", F.lit("BRL")) == "BRL")
    facts = rows.groupBy("doc_id").agg(F.count("value_brl").alias("n_valued"), F.max(F.when(claim & class3, F.lit(True))).alias("has3"))
    out = documents.select("doc_id").join(verdict, "doc_id", "left").join(facts, "doc_id", "left")
    status = cascade([(F.coalesce("n_valued", F.lit(0)) == 0, "NO_ROWS"), (F.col("n_checks").isNull(), "OK_NO_TOTALS"), (F.col("n_failed") > 0, "QUARANTINED")], "OK")
    class3 = cascade([(F.col("class3_pass"), "PASS"), (~F.col("class3_pass"), "FAIL"), (F.col("has3"), "NO_TOTAL")], "NO_ROWS")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", status.alias("status"), zero("n_checks"), zero("n_failed"), class3.alias("class3"))


def typed_money(x: Column) -> Column:
    return x.cast(MONEY)
