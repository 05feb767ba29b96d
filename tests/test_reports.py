"""Exports as files, and dashboards that contradict their stack."""

import csv
import datetime
import glob

from pyspark.sql import functions as F

from quillon.operators import dashboard, report


def lead(k, **more):
    base = {
        "creditor": f"C{k}", "debtor": "D", "face": 1000.0 * k, "fund": 500.0, "premium": 100.0 * k, "band": "A", "status": "NEW", "next_date": None, "state": "SP", "fit": "SMALL", "email": "", "proof": "OK",
        "case_number": f"c{k % 2}", "flags": "", "hold": "", "book": "TRADE",
    }
    return base | more


def frame(spark, rows):
    shape = "creditor string, debtor string, face double, fund double, premium double, band string, status string, next_date date, state string, fit string, email string, proof string, case_number string, flags string, hold string, book string"
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in shape.split(", ")) for r in rows], shape)


def blocks(board):
    out = {}
    for r in board.collect():
        out.setdefault(r["block"], {})[r["label"]] = (r["n"], None if r["amount"] is None else float(r["amount"]), r["place"])
    return out


def test_dashboard_of_some_leads(spark):
    day = datetime.date(2026, 2, 1)
    leads = [lead(1, status="SETTLED"), lead(2, next_date=day, state=""), lead(3, next_date=day - datetime.timedelta(1), hold="x", proof="CHECK y"), lead(4, status="DEAD", next_date=day - datetime.timedelta(9), state="RJ"), lead(5, status="INTERESTED", case_number=None, email="a@b", flags="no route in")]
    stack = dashboard.stacked({"one": frame(spark, leads[:3]), "two": frame(spark, leads[3:])})
    board = dashboard.dashboard(stack, "2026-02-01")
    got = blocks(board)
    kpi = {k: v[:2] for k, v in got["kpi"].items()}
    assert kpi["leads"] == (5, None) and kpi["premium"] == (None, 1500.0) and kpi["on hold"] == (1, 3000.0) and kpi["due"] == (1, None) and kpi["overdue"] == (1, None)
    assert kpi["in progress"] == (1, 500.0) and kpi["settled"] == (1, 100.0) and kpi["no route"] == (1, None) and kpi["proof to check"] == (1, 300.0) and kpi["with e-mail"] == (1, None)
    assert got["state"]["SP"][:2] == (3, 900.0) and got["state"]["(none)"][:2] == (1, 200.0) and got["state"]["(all rows)"][0] == 5
    assert [k for k, _ in sorted(got["top"].items(), key=lambda x: x[1][2])] == ["C5 · two · 2", "C4 · two · 3", "C3 · one · 2", "C2 · one · 3", "C1 · one · 4"]
    assert got["case"]["c0"][:2] == (2, 600.0) and got["concentration"]["case c0"][1] == 600.0
    assert {r["n"] for r in dashboard.disagreements(stack, board).collect()} == {0}


def test_contradictions_show(spark):
    stack = dashboard.stacked({"one": frame(spark, [lead(k) for k in range(1, 6)])})
    board = dashboard.dashboard(stack, "2026-02-01")
    bad = lambda b: {r["check"] for r in dashboard.disagreements(stack, b).filter("n > 0").collect()}
    assert bad(board.filter("block <> 'band'")) == {"bands do not sum"}
    assert bad(board.withColumn("n", F.when((F.col("block") == "kpi") & (F.col("label") == "leads"), F.lit(4)).otherwise(F.col("n")))) == {"leads"}
    assert bad(board.withColumn("amount", F.when((F.col("block") == "top") & (F.col("place") == 1), F.lit(9999)).otherwise(F.col("amount")))) == {"top rows not descending"}
    assert bad(board.withColumn("label", F.when(F.col("block") == "top", F.lit("same")).otherwise(F.col("label")))) == {"top row twice"}


def test_an_empty_book(spark):
    stack = dashboard.stacked({"one": frame(spark, [])})
    board = dashboard.dashboard(stack, "2026-02-01")
    got = blocks(board)
    assert got["kpi"]["leads"][0] == 0 and got["state"]["(all rows)"][0] == 0 and "top" not in got and got["band"]["A"][:2] == (0, 0.0)
    assert {r["n"] for r in dashboard.disagreements(stack, board).collect()} == {0}


def test_exports_have_their_columns_and_order(spark, tmp_path):
    targets = spark.createDataFrame([("1", "9.00", ["a", "b"]), ("2", "100.00", []), ("0", "9.00", None)], "cnpj_basico string, class_iii_face_sum string, flags array<string>")
    claims = spark.createDataFrame([("d", 2, 1, "x;\"y\"\nz"), ("d", 1, 2, None), ("c", 9, 9, "é")], "doc_id string, page int, row_index int, creditor_name_as_printed string")
    assert report.exports({"targets": targets, "claims": claims}, str(tmp_path)) == ["claims", "targets"]

    def read(name):
        rows = []
        for f in sorted(glob.glob(str(tmp_path / name / "part-*"))):
            with open(f, newline="", encoding="utf-8") as x:
                rows += list(csv.reader(x, escapechar="\\"))[1 if rows else 0 :]
        return rows

    got = read("targets")
    assert got[0] == report.EXPORTS["targets"][0]
    face, root, flags = (got[0].index(c) for c in ("class_iii_face_sum", "cnpj_basico", "flags"))
    assert [(r[root], r[face], r[flags]) for r in got[1:]] == [("2", "100.00", ""), ("0", "9.00", ""), ("1", "9.00", "a|b")]
    got = read("claims")
    at = [got[0].index(c) for c in ("doc_id", "page", "creditor_name_as_printed")]
    assert [[r[k] for k in at] for r in got[1:]][::2] == [["c", "9", "é"], ["d", "2", "x;\"y\"\nz"]]
