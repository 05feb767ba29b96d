"""Bands, years to payment, prices, holds and position flags of a lead."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import NOT_STATUTORY, cascade

#: Band, recovery, grace, term, lag (years).
BANDS = {
    "A": (0.40, 2.0, 8.0, 1.5),
    "B": (0.30, 2.0, 8.0, 1.5),
    "C": (0.15, 3.0, 10.0, 2.5),
    "D": (0.03, 0.0, 0.0, 6.0),
    "U": (0.25, 3.0, 8.0, 2.5),
}


@dataclass(frozen=True)
class Terms:
    rate: float = 0.25
    share: float = 0.60
    financial_multiplier: float = 1.00


def band_value(band: Column, k: int) -> Column:
    """A column of the band table; an unknown band is U."""
    return F.coalesce(*[F.when(band == b, F.lit(v[k])) for b, v in BANDS.items()], F.lit(BANDS["U"][k]))


def years_to_payment(band: Column, years_since_filing: Column, grace: Column, term: Column) -> Column:
    """Plan terms override the band's; band A counts from the likely grant."""
    g, t, lag = F.coalesce(grace, band_value(band, 1)), F.coalesce(term, band_value(band, 2)), band_value(band, 3)
    running = F.greatest(F.lit(1.0), g + t / 2 - F.greatest(F.lit(0.0), years_since_filing - lag))
    return F.when(band == "A", running).otherwise(lag + g + t / 2)


def recovery(band: Column, plan: Column, financial: Column, hold: Column, terms: Terms = Terms()) -> Column:
    own = band_value(band, 0) * F.when(financial, F.lit(terms.financial_multiplier)).otherwise(1.0)
    return F.when(hold != "", F.lit(0.0)).otherwise(F.coalesce(plan, own))


def price(face: Column, rec: Column, years: Column, terms: Terms = Terms()) -> dict[str, Column]:
    """fund, quote and premium of a face value."""
    fund = face.cast("double") * rec / F.pow(F.lit(1 + terms.rate), years)
    return {"fund": fund, "quote": fund * terms.share, "premium": fund - fund * terms.share}


def hold_reasons(kind: Column, band: Column, debtor: Column, case: Column, mismatch: Column, other_roots: Column) -> Column:
    """Every reason why a lead stays unpriced, in order; '' if none."""
    reasons = [
        (kind.isin(*NOT_STATUTORY), "source is not a statutory list"),
        (band == "U", "debtor band unresolved"),
        ((F.coalesce(debtor, F.lit("")) == "") & (F.coalesce(case, F.lit("")) == ""), "no debtor and no case"),
        (mismatch, "printed name does not match the registry"),
        (other_roots, "other company roots on the line"),
    ]
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in reasons])), "; ")


def position(share: Column) -> Column:
    """Voting position of a share of the class; shares over 1.001 are unknown."""
    return cascade([(share > 1.001, F.lit(None).cast("string")), (share >= 2 / 3, "BLOCKING"), (share >= 0.5, "CONTROL"), (share > 1 / 3, "SWING")], F.lit(None).cast("string"))


def proof_label(status: Column, class3: Column, kind: Column) -> Column:
    base = cascade(
        [
            ((status == "OK") & (class3 == "PASS"), "OK — totals reconciled"),
            ((status == "OK") & class3.isin("NO_TOTAL", "NO_ROWS"), "OK — other classes reconciled"),
            (status == "OK_NO_TOTALS", "NO TOTALS on the list"),
            ((status == "QUARANTINED") & (class3 == "PASS"), "PARTIAL — class III reconciled"),
        ],
        "CHECK",
    )
    return F.when(kind.isin(*NOT_STATUTORY), "CHECK").otherwise(base)


def debtor_band(c: dict[str, Column], as_of: str, dormant_before: str = "2025-09-01") -> dict[str, Column]:
    """band, reasons and plan_status of a case.

    ``c``: stage, proceeding, name, situation, registry, granted (document),
    grant_signal, plan_filed, filing_date, case_year, last_movement.
    """
    year = F.least(F.year(c["filing_date"]), c["case_year"])
    filed = F.when(F.year(c["filing_date"]) == year, c["filing_date"]).otherwise(F.make_date(year, F.lit(7), F.lit(1)))
    age = F.datediff(F.lit(as_of).cast("date"), filed) / 365.25
    yes = lambda x: F.coalesce(x, F.lit(False))
    dormant = yes(c["last_movement"] < F.lit(dormant_before).cast("date"))
    accepted = yes(~c["registry"].isin("NOT_IN_RFB", "NAME_MISMATCH", "CREDITOR_CNPJ"))
    granted = yes(c["granted"]) | yes(c["grant_signal"])
    failed = yes(c["stage"] == "CONVERTED_TO_BANKRUPTCY") | yes(c["proceeding"] == "FALENCIA") | yes(F.upper(c["name"]).rlike(r"MASSA FALIDA|\bFALID[AO]\b"))
    extinct, closed_company = yes(c["proceeding"] == "EXTINCT"), accepted & yes(c["situation"] == "08")
    closed = yes(c["stage"] == "CLOSED")
    weak = accepted & yes(c["situation"].isin("03", "04"))
    old = yes(age > 2)
    band = cascade(
        [(failed | extinct | closed_company, "D"), (granted & ~closed & yes(age > 8), "B"), (granted & ~closed, "A"), (old | dormant | closed | weak, "C")], "B"
    )
    to_d = failed | extinct | closed_company
    reasons = [
        (failed, "bankruptcy"),
        (~failed & extinct, "proceeding extinguished"),
        (~failed & ~extinct & closed_company, "debtor closed at the registry"),
        (~to_d & granted & ~closed, "recovery granted"),
        (~to_d & granted & ~closed & yes(age > 8), "but the case is old"),
        ((band == "C") & old, "filed over two years ago"),
        ((band == "C") & dormant, "no recent movement"),
        ((band == "C") & closed, "case closed"),
        ((band == "C") & weak, "debtor suspended or unfit at the registry"),
        ((band == "B") & ~granted & yes(c["plan_filed"]), "plan filed, not granted"),
        ((band == "B") & ~granted & ~yes(c["plan_filed"]), "live case, no plan yet"),
        (c["stage"].isNull() & c["case_year"].isNull(), "case not matched"),
    ]
    status = cascade([(granted, "CONFIRMED"), (yes(c["plan_filed"]), "PLAN_FILED"), (F.coalesce(c["stage"], F.lit("")) != "", "ESTIMATED")], "UNKNOWN")
    return {"band": band, "reasons": F.array_join(F.array_compact(F.array(*[F.when(x, F.lit(r)) for x, r in reasons])), "; "), "plan_status": status}


def exclusion(c: dict[str, Column]) -> Column:
    """First reason that takes a lead out of the book, else ''.

    ``c``: nature, public_name, has_registry, situation, related, heading, band,
    proceeding.
    """
    yes = lambda x: F.coalesce(x, F.lit(False))
    return cascade(
        [
            (yes(c["nature"].startswith("1")) | (~yes(c["has_registry"]) & yes(c["public_name"])), "public body"),
            (yes(c["situation"] != "02"), "not active at the registry"),
            (yes(c["related"]), "related party"),
            (yes(c["heading"] != ""), F.concat(F.lit("heading: "), c["heading"])),
            (yes(c["band"] == "D") | yes(c["proceeding"].isin("FALENCIA", "EXTINCT")), "bankrupt or extinguished"),
        ],
        "",
    )
