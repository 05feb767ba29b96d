"""Ruled tables on small grids: roles without headers, sections, totals, flags."""

import pytest
from pyspark.sql import functions as F

from quillon.operators import book, grids

GOOD, OTHER = "11.222.333/0001-81", "11.444.777/0001-61"


def frames(spark, grid, words=(), doc=1):
    cells = spark.createDataFrame([(doc, 1, 0, r, c, t) for r, row in enumerate(grid) for c, t in enumerate(row)], "doc_id long, page int, tab int, row int, col int, text string")
    boxes = spark.createDataFrame([(doc, 1, 0, 0.0, 100.0, 500.0, 400.0)], "doc_id long, page int, tab int, x0 double, top double, x1 double, bottom double")
    listed = [(doc, 1, t, x, x + 30.0, y, y + 8.0) for t, x, y in words]
    return cells, boxes, spark.createDataFrame(listed, "doc_id long, page int, text string, x0 double, x1 double, top double, bottom double")


def roles_of(cells):
    return {r["col"]: r["role"] for r in grids.column_roles(cells).collect()}


@pytest.mark.parametrize(
    ("grid", "want"),
    [
        # by the header: the better value column, the other beside it
        ([["Item", "Razão social", "CNPJ", "Valor nominal", "Crédito habilitado", "Obs."], ["1", "Alfa", GOOD, "R$ 1,00", "R$ 2,00", "x"]], {0: "seq", 1: "name", 2: "doc", 3: "value_alt", 4: "value", 5: "notes"}),
        # equal scores: the rightmost
        ([["Credor", "CPF", "Valor", "Valor"], ["A", "", "1,00", "2,00"]], {0: "name", 1: "doc", 2: "value_alt", 3: "value"}),
        # by the cells: numbers, documents, values, classes, names before addresses, a repetitive debtor
        (
            [[str(k), f"Empresa {k} Ltda", "Recuperanda X", f"Rua das Flores {k}", GOOD, "III", f"{k}.000,00"] for k in range(1, 5)],
            {0: "seq", 1: "name", 2: "debtor", 4: "doc", 5: "class", 6: "value"},
        ),
        # a later column of values supersedes an earlier one
        ([[f"Empresa {k} Ltda", f"{k}.000,00", f"{k}.500,00"] for k in range(1, 5)], {0: "name", 1: "value_alt", 2: "value"}),
        # no values: no table of creditors
        ([["Nome", "CPF"], ["Ana", "111.444.777-35"]], {}),
    ],
)
def test_column_roles(spark, grid, want):
    assert roles_of(frames(spark, grid)[0]) == want


def test_rows_sections_and_totals(spark):
    head = ["Credor", "CNPJ", "Valor nominal", "Valor atualizado"]
    grid = [
        head, ["Alfa Ltda", GOOD, "-", "R$ 1.000,00"], ["Beta Ltda", OTHER, "R$ 7,00", "US$ 2.000,00"], ["Total da classe III", "", "", "R$ 3.000,00"],
        ["CLASSE IV - ME e EPP", "", "", ""], ["Gama", "", "", "R$ 5,00"], ["Créditos não sujeitos", "", "", ""], ["Delta", GOOD, "", "?"],
    ]
    words = [("CLASSE", 10.0, 50.0), ("III", 50.0, 50.0), ("CLASSE", 10.0, 150.0), ("II", 50.0, 150.0)]
    claims, totals = grids.claims_of_tables(*frames(spark, grid, words))
    got = {r["name"]: r for r in claims.collect()}
    assert {n: (r["class"], r["section"]) for n, r in got.items()} == {"Alfa Ltda": ("III", 1), "Beta Ltda": ("III", 1), "Gama": ("IV", 3), "Delta": (None, 4)}
    assert float(got["Alfa Ltda"]["value_brl"]) == 1000 and got["Alfa Ltda"]["flags"] == ["VALUE_COL:Valor_Atualizado"]
    assert set(got["Beta Ltda"]["flags"]) >= {"FOREIGN_CURRENCY", "ALT_VALUE:R$7,00"} and got["Beta Ltda"]["currency"] == "USD"
    assert "NO_DOCUMENT" in got["Gama"]["flags"]
    assert {"VALUE_UNPARSEABLE", "CLASS_UNKNOWN", "NOT_A_CLAIM"} <= set(got["Delta"]["flags"]) and any(f.startswith("SECTION_") for f in got["Delta"]["flags"])
    assert [(r["class"], float(r["total"]), r["section"]) for r in totals.collect()] == [("III", 3000.0, 1)]


def test_alternative_values_and_reports(spark):
    df = spark.createDataFrame([(["ALT_VALUE:R$1.000,50"], 1000.5), (["ALT_VALUE:R$2.000,00", "X"], 1000.5), (["X"], 5.0), ([], None)], "flags array<string>, v double")
    assert [r[0] for r in df.select(book.two_values(F.col("flags"), F.col("v"))).collect()] == [False, True, False, False]
    reports = spark.createDataFrame([('{"checks": [{"class": "III/BRL#s1", "printed_total": "10.00", "value_missing": 0, "pass": true}, {"class": "III/BRL#s2", "printed_total": null, "value_missing": 1, "pass": true}]}',), ('{"checks": [{"class": "I/BRL", "pass": false}]}',), (None,)], "r string")
    got = [r[0] for r in reports.select(book.reconciled(F.col("r"))).collect()]
    assert (got[0]["ok"], float(got[0]["total"]), got[0]["missing"], got[0]["no_total"]) == (False, 10.0, 1, True) and got[1] is got[2] is None
