"""The call and operations books: readers, tallies, frames and their invariants."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import plain
from .rules import cascade

MONEY, SUM = "decimal(18,2)", "decimal(28,2)"
#: Ranks of registered roles in the call book and in the operations book.
CALL_ROLES = (49, 16, 5, 10)
OPS_ROLES = (49, 5, 16, 10)
#: Ratio of two printed values from which a digit was probably dropped.
DROPPED_DIGIT = 5
CHECKS = "struct<checks:array<struct<class:string,printed_total:string,value_missing:int,delta:string,pass:boolean,page:int>>>"


# --- readers -------------------------------------------------------------------------
def reconciled(report: Column, unit: str = "III/BRL") -> Column:
    """struct(ok, total, missing, no_total) of a reconcile report's checks of one
    unit (``III/BRL`` or ``III/BRL#s3``); null where it has none."""
    mine = F.filter(F.from_json(report, CHECKS)["checks"], lambda c: c["class"].startswith(unit))
    total = F.aggregate(mine, F.lit(0).cast(SUM), lambda a, c: (a + F.coalesce(c["printed_total"].try_cast(MONEY), F.lit(0).cast(MONEY))).cast(SUM))
    missing = F.aggregate(mine, F.lit(0), lambda a, c: a + F.coalesce(c["value_missing"], F.lit(0)))
    no_total = F.exists(mine, lambda c: F.coalesce(c["printed_total"], F.lit("")) == "")
    ok = F.forall(mine, lambda c: F.coalesce(c["pass"], F.lit(False))) & (missing == 0) & ~no_total
    facts = F.struct(ok.alias("ok"), F.when(total > 0, total).alias("total"), missing.alias("missing"), no_total.alias("no_total"))
    return F.when(F.size(mine) > 0, facts)


def unwrapped(envelopes: DataFrame, seen: DataFrame) -> DataFrame:
    """People of tool envelopes (column body) whose id is not in ``seen`` (id)."""
    shape = "struct<people:array<struct<id:bigint,name:string,title:string,organization:struct<name:string>,phone_numbers:array<struct<number:string>>>>>"
    inner = F.from_json(F.get_json_object("body", "$.result"), shape)
    people = envelopes.select(F.explode(inner["people"]).alias("p"))
    flat = people.select(
        F.col("p.id").alias("id"), F.col("p.name").alias("name"), F.col("p.title").alias("title"), F.col("p.organization.name").alias("organization"),
        F.array_join(F.transform("p.phone_numbers", lambda n: n["number"]), "|").alias("phones"),
    )
    first = flat.groupBy("id").agg(F.min(F.struct("name", "title", "organization", "phones")).alias("f")).select("id", "f.*")
    return first.join(seen.select("id"), "id", "left_anti")


def alternative(flags: Column) -> Column:
    """The value that a row prints beside its own, from its ALT_VALUE flag."""
    text = F.regexp_extract(F.array_join(flags, "|"), r"ALT_VALUE:([^|]+)", 1)
    return F.translate(F.regexp_replace(text, "[^0-9,]", ""), ",", ".").try_cast("double")


def two_values(flags: Column, value: Column) -> Column:
    return F.coalesce(F.abs(alternative(flags) - F.coalesce(value.cast("double"), F.lit(0.0))) > 0.005, F.lit(False))


def diff_reason(old: Column, new: Column, n_claims: Column) -> Column:
    """Why a lead's face differs from the earlier book's."""
    larger, smaller = F.greatest(old, new), F.least(old, new)
    digit = (smaller > 0) & (larger / smaller > DROPPED_DIGIT)
    return cascade([(old == new, ""), (digit, "a digit was probably dropped"), (n_claims > 1, F.concat(n_claims.cast("string"), F.lit(" claims summed")))], "value changed")


def final_status(status: Column, has_text: Column, n_valued: Column, error: Column) -> Column:
    """What a run says of a document: failures and empty layers over the reconcile status."""
    return cascade([(error.isNotNull(), "ERROR"), (~F.coalesce(has_text, F.lit(False)), "NO_TEXT_LAYER"), (F.coalesce(n_valued, F.lit(0)) == 0, "NO_ROWS")], status)


# --- contacts ------------------------------------------------------------------------
def role_rank(role: Column, order: tuple[int, ...]) -> Column:
    return cascade([(role == code, k) for k, code in enumerate(order)], len(order))


def called_people(own: DataFrame, registry: DataFrame) -> DataFrame:
    """Primary and backup contact of each root.

    ``own`` (root, rank, name, demoted) come first, in their rank, demoted ones
    after the others; a root without any falls back to ``registry`` (root, role,
    name) in the call book's order of roles.
    """
    mine = own.select("root", "name", F.struct(F.coalesce("demoted", F.lit(False)).cast("int").alias("a"), F.col("rank").cast("int").alias("b"), F.col("name").alias("c")).alias("place"))
    spare = registry.join(own.select("root"), "root", "left_anti")
    spare = spare.select("root", "name", F.struct(F.lit(0).alias("a"), role_rank(F.col("role"), CALL_ROLES).alias("b"), F.col("name").alias("c")).alias("place"))
    w = Window.partitionBy("root").orderBy("place")
    ranked = mine.union(spare).withColumn("r", F.row_number().over(w)).filter("r <= 2")
    pick = lambda k: F.max(F.when(F.col("r") == k, F.col("name")))
    return ranked.groupBy("root").agg(pick(1).alias("primary"), pick(2).alias("backup"))


def signing_person(registry: DataFrame) -> DataFrame:
    """One person of each root in the operations book's order of roles."""
    place = F.struct(role_rank(F.col("role"), OPS_ROLES), F.col("name"))
    return registry.groupBy("root").agg(F.min_by("name", place).alias("person"), F.min_by("role", place).alias("role"))


def best_candidate(candidates: DataFrame, key: str) -> DataFrame:
    """The best candidate (pos, score, value) of each key above a score of 0; of equal ones the first."""
    good = candidates.filter("score > 0")
    return good.groupBy(key).agg(F.max_by("value", F.struct(F.col("score"), -F.col("pos"))).alias("value"), F.max("score").alias("score"))


# --- tallies -------------------------------------------------------------------------
def tally(leads: DataFrame, bands: tuple[str, ...], proofs: tuple[str, ...]) -> DataFrame:
    """Numbers of each book and, with book null, of all (leads: book, band, face,
    fund, premium, proof, hold)."""
    held = F.coalesce("hold", F.lit("")) != ""
    zero = F.lit(0).cast(SUM)
    return leads.rollup("book").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("band") == b).alias(f"n_band_{b.lower()}") for b in bands],
        F.sum("face").cast(SUM).alias("face"),
        F.round(F.sum("fund"), 2).alias("fund"),
        F.round(F.sum("premium"), 2).alias("premium"),
        *[F.count_if(F.col("proof").startswith(p)).alias(f"n_proof_{p.lower()}") for p in proofs],
        F.count_if(held).alias("n_held"),
        F.coalesce(F.sum(F.when(held, F.col("face"))), zero).cast(SUM).alias("face_held"),
    )


def counted_blocks(leads: DataFrame, labels: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Count and face per dimension and label; labels (dimension, label) without a lead show 0."""
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("dimension"), value.alias("label")) for name, value in measures.items()])).alias("m")
    seen = leads.select("face", pairs).groupBy("m.dimension", "m.label").agg(F.count("*").alias("n"), F.sum("face").cast(SUM).alias("face"))
    out = labels.join(seen, ["dimension", "label"], "left")
    return out.select("dimension", "label", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("face", F.lit(0)).cast(SUM).alias("face"))


# --- frames --------------------------------------------------------------------------
def call_frame(leads: DataFrame) -> DataFrame:
    """The call tab: one row a lead, the sheet's formulas as columns, best first.

    leads: root, case_number, book, band, face, recovery, years, hold, proof.
    """
    held = F.coalesce("hold", F.lit("")) != ""
    fund = F.when(held, F.lit(0.0)).otherwise(F.col("face").cast("double") * F.col("recovery") / F.pow(F.lit(1.25), F.col("years")))
    out = leads.withColumn("fund", F.round(fund, 2)).withColumn("quote", F.round(0.6 * fund, 2))
    out = out.withColumn("premium", F.round(fund - 0.6 * fund, 2)).withColumn("cents", F.round(F.when(F.col("face") > 0, 100 * fund / F.col("face").cast("double")), 1))
    return out.withColumn("callable", ~held & ~F.col("proof").startswith("CHECK")).orderBy(F.desc("fund"), F.desc("face"), "root")


def excluded_frame(leads: DataFrame, reason: Column) -> DataFrame:
    """The excluded tab: rows with the first reason against them."""
    return leads.withColumn("reason", reason).filter("reason <> ''").select("root", "book", "face", "reason")


def ops_frame(companies: DataFrame, people: DataFrame, flags: list[Column]) -> DataFrame:
    """The operations tab: companies that no flag excludes (unknown flags keep), with who signs."""
    kept = companies
    for f in flags:
        kept = kept.filter(~F.coalesce(f, F.lit(False)))
    return kept.join(signing_person(people), "root", "left")


def violations(rows: DataFrame, checks: dict[str, Callable[[], Column]]) -> DataFrame:
    """(check, n): rows that break each named rule, those that none breaks included."""
    counts = rows.agg(*[F.count_if(F.coalesce(broken(), F.lit(False))).alias(name) for name, broken in checks.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.col(name).alias("n")) for name in checks]))
    return counts.select(pairs.alias("v")).select("v.check", "v.n")


#: Phones as a tab prints them, proceedings and words that no call tab may hold.
DIALABLE = (
    r"^(\([0-9]{2}\) [0-9]{4,5}-[0-9]{4}|[0-9]{4}-[0-9]{4}( \(no DDD\))?|[0-9]{5}-[0-9]{4} \(no DDD\)|\([0-9]{2}\) [0-9]{4}-[0-9]{3} \[digit missing\]|"
    r"0[3589]00 [0-9]{3} [0-9]{4}|0[3589]00 [0-9]+|[0-9]+ \[check\])$"
)
NOT_CALLED = ("Falência", "RJ extinguished")
ADMINISTRATORS = r"ADMINISTRACAO JUDICIA|ADVOCACIA|TRUSTEE|PAGINA INICIAL|^ATIVOS$|^BASE$"


def shown_checks() -> dict[str, Callable[[], Column]]:
    """Rules for what a call tab shows of a lead: fund, hold, proceeding, size, flags, phone, backup_phone, debtor, proof and share."""
    c = F.col
    text = lambda name: F.coalesce(c(name), F.lit(""))
    return {
        "not held but unpriced": lambda: (text("hold") == "") & (c("fund") <= 0),
        "bankrupt on a call tab": lambda: c("proceeding").isin(*NOT_CALLED),
        "small creditor unflagged": lambda: F.upper(text("size")).rlike("MICRO|PEQUENO") & ~text("flags").contains("ME/EPP") & ~text("proceeding").startswith("Recuperação extrajudicial"),
        "phone not dialable": lambda: (text("phone") != "") & ~text("phone").rlike(DIALABLE),
        "backup repeats a phone": lambda: (text("backup_phone") != "") & (c("backup_phone") == c("phone")),
        "debtor is an administrator": lambda: F.upper(plain(c("debtor"))).rlike(ADMINISTRATORS),
        "raw status in proof": lambda: text("proof").startswith("QUARANTINED"),
        "share out of range": lambda: ~((c("share") > 0) & (c("share") <= 1.0001)),
    }
