"""Steps that the round's findings name: whole jobs, and rows that no task gets all of."""

import re

from pyspark.sql import functions as F

from quillon.functions import ids
from quillon.operators import prose, reading, rules, tables
from quillon.plans import business, catalog, classifiers, documents, workbook  # noqa: F401
from quillon.sources import api, pages


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_link_classifier_takes_every_link_of_every_page(spark, small):
    p = spark.read.parquet(f"{small}/pages.parquet")
    got = catalog.QUERIES["link_classifier"](spark, small)
    assert got.count() == p.count() + pages.anchors(p, ["page_id"]).count()
    assert got.groupBy("page_id", "pos").count().filter("count > 1").isEmpty()


def test_rows_without_a_key_stay_out_of_the_join(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None)], "id int, key string")
    more = spark.createDataFrame([("a", 7), (None, 8)], "key string, n int")
    got = tables.known_left(rows, more, "key")
    assert {(r.id, r.key, r.n) for r in got.collect()} == {(1, "a", 7), (2, None, None), (3, "b", None), (4, None, None)}


def test_star_joins_send_no_nulls(spark, small):
    for name in ("star_join_two_keys", "star_join_sha1"):
        # the claims, or filings, are joined by their document only
        assert _plan(catalog.QUERIES[name](spark, small)).count("Union") == 2


def _repairs_plainly(d):
    def ok(x):
        digit = lambda s, w: (11 - sum(int(c) * k for c, k in zip(s, w)) % 11) % 11 % 10
        w = ids.COMPANY_WEIGHTS
        return len(set(x)) > 1 and digit(x, w) == int(x[12]) and digit(x, (6, *w)) == int(x[13])

    return sorted({n for i in range(14) for c in "0123456789" if c != d[i] for n in [d[:i] + c + d[i + 1 :]] if ok(n)}) if len(d) == 14 else []


def test_single_digit_repairs(spark):
    good = [str(n * 7919 + 11222333000181).zfill(14) for n in range(60)] + ["00000000000191", "11111111111111", "00000000000000", "10000000000000", "123", ""]
    df = spark.createDataFrame([(g,) for g in good], "d string")
    for r in df.select("d", ids.single_digit_repairs(F.col("d")).alias("r")).collect():
        assert r.r == _repairs_plainly(r.d)
    # no try is put together as a text
    assert "concat(" not in _plan(df.select(ids.single_digit_repairs(F.col("d"))))


def test_flattened_records_are_searched_without_functions_of_arrays(spark):
    records = ['{"numeroProcesso":"1","movimentos":[{"codigo":1,"nome":null,"dataHora":null},{"codigo":2,"nome":"BAIXA Definitiva","dataHora":"2020-01-02T00"}]}', '{"numeroProcesso":"2","movimentos":[{"nome":"baixa"},{"nome":"definitiva"}]}', "{}"]
    flat = api.flatten(spark.createDataFrame([(r,) for r in records], "source string"))
    assert [(r.stage, r.grant_signal, str(r.last_movement), r.n_movements) for r in flat.collect()] == [("CLOSED", False, "2020-01-02", 2), ("ACTIVE", False, "None", 2), ("ACTIVE", False, "None", 0)]
    assert "exists(" not in _plan(flat)


def test_boundary_stems_leave_out_no_boundary(spark):
    words = re.sub(r"^\\b\(|\)\\b$", "", rules.BOUNDARY)
    spoken = [re.sub(r"\\s\+", " ", w).replace("\\w*", "").replace("?", "").replace("(:", "(?:") for w in re.split(r"\|(?![^(]*\))", words)]
    plain = [v for w in spoken for v in ([re.sub(r"\(\?:[^)]*\)", x, w) for x in re.search(r"\(\?:([^)]*)\)", w)[1].split("|")] if "(" in w else [w])]
    assert len(plain) >= 20 and all(re.search(rules.BOUNDARY, w) or w.endswith("SUBMETID") or w.endswith("RECUPERA") for w in plain)
    df = spark.createDataFrame([(w,) for w in plain], "w string")
    assert df.filter(~rules.may_bound(F.col("w"))).isEmpty()


def test_page_routes_read_no_lines(spark, small, monkeypatch):
    asked = []
    monkeypatch.setattr(reading, "read_lines", lambda *a: asked.append(a))
    assert not catalog.QUERIES["page_routes"](spark, small).isEmpty()
    assert not asked
