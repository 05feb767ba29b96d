"""Lines of words, kin, crawls, registry calls and addresses on small inputs."""

import threading
import time
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from quillon.functions.text import html_text, unescaped, unwrapped, wrapped
from quillon.operators import kin, reading, running
from quillon.sources import crawl, pages, registry

WORDS = "doc_id long, page int, text string, x0 double, x1 double, top double, bottom double"
CELLS = "doc_id long, page int, tab int, row int, col int, text string"
BOXES = "doc_id long, page int, tab int, x0 double, top double, x1 double, bottom double"
GOOD, OTHER = "11.222.333/0001-81", "11.444.777/0001-61"


def line(page, y, *words):
    """Words (text, x0, x1) of one line of document 1."""
    return [(1, page, t, float(a), float(b), float(y), y + 8.0) for t, a, b in words]


def row(page, y, name, document, money=None, number=None):
    out = line(page, y, *[(w, 60 + 40 * k, 95 + 40 * k) for k, w in enumerate(name.split())])
    out += line(page, y + 1, (document, 300, 380)) if document else []
    out += line(page, y, ("R$", 420, 428), (money, 500 - 6 * len(money), 500)) if money else []
    return out + (line(page, y, (number, 40, 46)) if number else [])


def read(spark, words, cells=(), boxes=()):
    claims, totals, routes = reading.read_tables(spark.createDataFrame(words, WORDS), spark.createDataFrame(list(cells), CELLS), spark.createDataFrame(list(boxes), BOXES))
    return claims.orderBy("page", "row_index").collect(), totals.collect(), {r["page"]: r["route"] for r in routes.collect()}


def test_lines_take_wrapped_names_and_values_below(spark):
    words = line(1, 20, ("CLASSE", 60, 100), ("III", 105, 120))
    words += row(1, 100, "Alfa Comercio", GOOD, "1.000,00", "1") + line(1, 112, ("e", 60, 65), ("Filhos", 70, 95))
    words += row(1, 150, "Beta Ltda", OTHER, None, "2") + line(1, 162, ("R$", 420, 428), ("2.000,50", 452, 500))
    words += line(1, 200, ("Total", 60, 90), ("da", 95, 105), ("classe", 110, 140), ("III", 145, 160), ("3.000,50", 452, 500))
    words += row(1, 230, "Gama", "", "7,00") + line(1, 400, ("solto", 60, 90))
    claims, totals, routes = read(spark, words)
    got = [(r["name"], r["document"], r["value_brl"] and float(r["value_brl"]), r["class"], r["section"]) for r in claims]
    assert got == [("Alfa Comercio e Filhos", "11222333000181", 1000.0, "III", 1), ("Beta Ltda", "11444777000161", 2000.5, "III", 1), ("Gama", "", 7.0, "III", 2)]
    assert "NO_DOCUMENT" in claims[2]["flags"] and [(t["class"], float(t["total"]), t["section"]) for t in totals] == [("III", 3000.5, 1)]
    assert routes == {1: "TABLE_BANDS"}


def test_columns_hold_over_pages_and_split_debtors(spark):
    words = line(1, 40, ("Nº", 40, 46), ("Devedora", 60, 100), ("Credor", 160, 190), ("CNPJ", 300, 330), ("Valor", 450, 480))
    words += line(1, 100, ("1", 40, 44), ("Recu", 60, 90), ("Alfa", 160, 190), (GOOD, 300, 380), ("R$", 420, 428), ("5,00", 476, 500))
    # the next page shows no value and no header
    words += line(2, 100, ("2", 40, 44), ("Recu", 60, 90), ("Beta", 160, 190), (OTHER, 300, 380), ("nihil", 476, 500))
    claims, _, _ = read(spark, words)
    assert [(r["debtor"], r["name"], r["value_brl"] and float(r["value_brl"])) for r in claims] == [("Recu", "Alfa", 5.0), ("Recu", "Beta", None)]
    assert "VALUE_UNPARSEABLE" in claims[1]["flags"] and "CLASS_UNKNOWN" in claims[1]["flags"]


def test_running_lines_are_no_names_and_running_totals_close_nothing(spark):
    words = line(1, 20, ("CLASSE", 60, 100), ("I", 105, 110))
    for p in (1, 2, 3):
        words += row(p, 100, f"Nome{p}", GOOD, f"{p}.000,00") + line(p, 112, ("Folha", 60, 90), (str(p), 95, 99), ("dos", 104, 120), ("autos", 125, 150))
        words += line(p, 300, ("TOTAL", 60, 90), ("GERAL:", 95, 130), ("6.000,00", 452, 500))
    claims, totals, _ = read(spark, words)
    assert [r["name"] for r in claims] == ["Nome1", "Nome2", "Nome3"]
    assert {t["section"] for t in totals} == {-1}


def test_pages_take_the_reader_they_need(spark):
    head = ["Nome do credor", "CNPJ", "Valor"]
    grid = lambda p, rows: [(1, p, 0, r, c, t) for r, cells in enumerate(rows) for c, t in enumerate(cells)]
    cells = grid(1, [head, ["Alfa", GOOD, "R$ 1,00"]]) + grid(2, [head]) + grid(3, [["Nome do credor", "CNPJ"], ["x", "y"]])
    boxes = [(1, p, 0, 0.0, 90.0, 600.0, 200.0) for p in (1, 2, 3)]
    words = line(1, 20, ("CLASSE", 60, 100), ("II", 105, 110)) + row(2, 100, "Beta", OTHER, "2,00") + row(3, 100, "Gama", OTHER, "3,00")
    claims, _, routes = read(spark, words, cells, boxes)
    # a header without rows, and a table of two columns, leave their pages to the line reader; the class goes on
    assert routes == {1: "TABLE_RULED", 2: "TABLE_BANDS", 3: "TABLE_BANDS"}
    assert [(r["name"], r["class"], r["layout"]) for r in claims] == [("Alfa", "II", "TABLE_RULED"), ("Beta", "II", "TABLE_BANDS"), ("Gama", "II", "TABLE_BANDS")]


def test_no_documents(spark):
    claims, totals, routes = read(spark, [])
    assert claims == [] == totals and routes == {}


def test_running_text_without_headers_and_with_nulls(spark):
    texts = spark.createDataFrame([(1, f"Alfa - {GOOD}: R$ 5,00; sem valor; Beta, CPF: 1x, EUR 7,50"), (2, None), (3, "")], "doc_id long, text string")
    found, printed = running.sections(texts)
    got = running.claims(found).orderBy("seq").collect()
    assert [(r["name"], r["section"], float(r["value"]), r["currency"]) for r in got] == [("Alfa", 0, 5.0, "BRL"), ("Beta", 0, 7.5, "EUR")]
    assert got[0]["flags"] == ["CLASS_UNKNOWN"] and "FOREIGN_CURRENCY" in got[1]["flags"] and printed.count() == 0


def test_wrapped_shapes(spark):
    df = spark.createDataFrame([("11.222.\n333/ 0001\n-81",), ("11.222.333/0001-8",)], "t string")
    shape = wrapped("dd.ddd.ddd/dddd-dd")
    assert [r[0] for r in df.select(unwrapped(F.regexp_extract("t", shape, 0))).collect()] == ["11.222.333/0001-81", ""]


KIN_CREDITORS = [("1", "Alfa Comercio", ["ANA LIMA"]), ("2", "Beta Omega Servicos", None), ("3", "Comercio", ["ANA LIMA"]), ("4", None, None), ("5", "Construtora Meridional Delta", [])]
KIN_DEBTORS = [
    (10, "1", None, "Outra Coisa", None), (11, None, ["2", "9"], "Outra Coisa", None), (12, None, None, "Alfa Participacoes", None), (13, None, None, "Construtore Meridional Delta", None),
    (14, "7", None, "Comercio Servicos", ["ANA LIMA", "JOSE PAZ"]), (15, None, None, None, None), (16, None, None, "Zeta Omega", None),
]


@pytest.mark.parametrize("pairs", [1 << 20, 1])
def test_kin_of_all_pairs(spark, pairs):
    creditors = spark.createDataFrame(KIN_CREDITORS, "root string, name string, partners array<string>")
    debtors = spark.createDataFrame(KIN_DEBTORS, "debtor_id long, root string, member_roots array<string>, name string, partners array<string>")
    generic = spark.createDataFrame([("COMERCIO",), ("SERVICOS",)], "token string")
    got = {(r["root"], r["debtor_id"]): r["kin"] for r in kin.related(creditors, debtors, generic, pairs).collect()}
    assert got == {("1", 10): "own root", ("2", 11): "group member", ("1", 12): "shared head name", ("5", 13): "same name", ("1", 14): "shared partner", ("3", 14): "shared partner"}


def test_addresses(spark):
    base = "http://www.a.com/x/y/z.html?q=1"
    cases = {
        "b.html": "http://www.a.com/x/y/b.html", "../b": "http://www.a.com/x/b", "../../../b": "http://www.a.com/b", "/c/./d/../e#f": "http://www.a.com/c/e", "?p=2": "http://www.a.com/x/y/z.html?p=2", "//b.org/ç": "http://b.org/%C3%A7",
        "https://c.org": "https://c.org", "relação de credores.pdf": "http://www.a.com/x/y/rela%C3%A7%C3%A3o%20de%20credores.pdf", "a%20b?x=é": "http://www.a.com/x/y/a%20b?x=%C3%A9", "..": "http://www.a.com/x/", "": "http://www.a.com/x/y/z.html", "mailto:a@b": "mailto:a@b",
    }
    df = spark.createDataFrame([(h, w) for h, w in cases.items()], "h string, w string")
    assert all(r["w"] == r["g"] for r in df.select("w", pages.absolute(F.lit(base), F.col("h")).alias("g")).collect())


def test_character_references(spark):
    cases = {"a &amp;amp; b": "a &amp; b", "&ccedil;&#231;&#xE7;&#XE7;": "çççç", "&#128512;": "\U0001f600", "&nosuch; & &amp": "&nosuch; & &amp", "&#0;&#xD800;&#1114112;": "���", "": "", "&euro;": "€"}
    df = spark.createDataFrame(list(cases.items()), "t string, w string")
    assert [(r["t"], r["g"]) for r in df.select("t", "w", unescaped(F.col("t")).alias("g")).collect() if r["g"] != r["w"]] == []
    assert spark.createDataFrame([("<b>a&nbsp;&nbsp;b</b>",)], "t string").select(html_text(F.col("t"))).first()[0] == "a b"


def test_robots_and_budgets(spark):
    link = lambda *urls: "".join(f'<a href="{u}">{t}</a>' for u, t in urls)
    web = {
        "http://a.com/": link(("/one", "x"), ("/no/two", "y"), ("/no/but/three", "z"), ("http://b.com/", "processo"), ("/tag/lista", "lista")),
        "http://a.com/one": link(("/four", "nada"), ("/processo-5", "x"), ("/qgc-credores.pdf", "QGC"), ("/plano.pdf", "Plano"), ("/ata.pdf", "Ata")),
        "http://a.com/no/two": "", "http://a.com/no/but/three": link(("/qgc-credores.pdf", ""), ("/lista-7.pdf", "")), "http://a.com/four": "", "http://a.com/processo-5": "", "http://b.com/": link(("/", "self")),
    }
    frame = spark.createDataFrame(list(web.items()), "url string, html string")
    seeds = spark.createDataFrame([("http://a.com/#top",), ("http://a.com/",), ("http://gone.com/",)], "url string")
    robots = spark.createDataFrame([("a.com", "User-Agent: *\nDisallow: /no/\nAllow: /no/but\nDisallow: /\nUser-agent: z\nDisallow: /one"), ("b.com", None)], "domain string, text string")
    visited, documents = crawl.crawl(frame, seeds, robots)
    assert [(r["url"], r["depth"], r["at"]) for r in visited.orderBy("at").collect()] == [("http://a.com/", 0, 1), ("http://a.com/one", 1, 2), ("http://a.com/no/but/three", 1, 3), ("http://a.com/processo-5", 2, 4)]
    assert [(r["url"], r["score"], r["rank"]) for r in documents.orderBy("rank").collect()] == [("http://a.com/qgc-credores.pdf", 3, 1), ("http://a.com/plano.pdf", 2, 2), ("http://a.com/lista-7.pdf", 1, 3)]
    visited, documents = crawl.crawl(frame, seeds, robots, max_pages=2, max_documents=1, max_depth=1)
    assert [r["url"] for r in visited.orderBy("at").collect()] == ["http://a.com/", "http://a.com/one"] and documents.count() == 1


def test_downloads_are_asked_for_once(spark):
    known = spark.createDataFrame([("s", "u1", ["u1", "u2"])], "sha1 string, url string, aliases array<string>")
    links = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u3",)], "url string")
    assert [r["url"] for r in pages.to_download(links, known).collect()] == ["u3"]


def test_registry_calls_are_paced_and_misses_kept(spark):
    calls, busy = [], set()

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            site, cnpj = self.path.strip("/").split("/")
            calls.append((site, cnpj, time.monotonic()))
            if cnpj.endswith("9") and (site, cnpj) not in busy:
                busy.add((site, cnpj))
                status, body = 429, ""
            elif cnpj.endswith("1"):
                status, body = 404, ""
            elif cnpj.endswith("2") and site == "one":
                status, body = 500, ""
            else:
                status, body = 200, '{"razao_social": "X", "cnpj": "%s"}' % cnpj
            self.send_response(status)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    hosts = {"one": at + "/one/{cnpj}", "two": at + "/two/{cnpj}"}
    ids = [f"{k:014d}" for k in range(12)]
    cache = spark.createDataFrame([(ids[3], "old", None, 200, "{}"), (ids[4], "old", None, 404, "{}")], registry.ANSWER)
    wanted = spark.createDataFrame([(i,) for i in [*ids, ids[5], "123", None]], "cnpj string")
    found, after = registry.fetched(wanted, cache, hosts, interval=0.05, slower=0.2, tries=2)
    kept = {r["cnpj"]: (r["status"], r["source"]) for r in after.collect()}
    server.shutdown()
    assert set(kept) == set(ids) and kept[ids[3]] == (200, "old") and kept[ids[2]][0] == 200 and kept[ids[1]][0] == kept[ids[11]][0] == 404
    assert {r["cnpj"] for r in found.collect()} == set(ids) - {ids[1], ids[4], ids[11]}
    assert not {c for _, c, _ in calls} & {ids[3], ids[4]}
    for site in hosts:
        times = [t for s, _, t in calls if s == site]
        assert all(b - a >= 0.049 for a, b in zip(times, times[1:], strict=False))
    # what is cached is not asked for again
    n = len(calls)
    again, _ = registry.fetched(wanted, after, hosts, interval=0.05)
    assert again.count() == len(ids) - 3 and len(calls) == n
