"""Sources, sinks and the streaming extension on small inputs."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

from pyspark.sql import functions as F

from quillon.operators import tables
from quillon.sources import api, files, pages, sinks
from quillon.streaming import ingest


def test_paged_api(spark):
    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            start = body.get("search_after", [0])[0]
            hits = [{"_source": {"numeroProcesso": f"{k:07d}1120208260001", "tribunal": "tjsp"}, "sort": [k]} for k in range(start + 1, min(start + body["size"], 5) + 1)]
            data = json.dumps({"hits": {"hits": hits}}).encode()
            self.send_response(500 if "bad" in self.path else 200)
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(api.CasesSource)
    url = f"http://127.0.0.1:{server.server_port}/{{court}}"
    rows = spark.read.format("cases_api").option("url", url).option("courts", "one,bad").option("size", 2).option("wait", 0).load()
    good = api.flatten(rows.filter("error is null"))
    assert sorted(r["case_number"] for r in good.collect()) == [f"{k:07d}-11.2020.8.26.0001" for k in range(1, 6)]
    assert rows.filter("error is not null").count() == 1
    server.shutdown()


def test_pages(spark):
    html = '<title>A &amp; B</title><a href="/lista-credores.pdf">Lista</a><a href="x.html"><b>x</b> y</a>'
    links = pages.anchors(spark.createDataFrame([(1, "http://www.a.com/d/", html)], "id int, url string, html string"), ["id", "url"])
    got = links.select("href", "inner", pages.absolute(F.col("url"), F.col("href")).alias("to"), pages.host(F.col("url")).alias("h")).orderBy("href").collect()
    assert [tuple(r) for r in got] == [("/lista-credores.pdf", "Lista", "http://www.a.com/lista-credores.pdf", "a.com"), ("x.html", "x y", "http://www.a.com/d/x.html", "a.com")]
    xml = spark.createDataFrame([("<Key>a.pdf</Key><Key>b.txt</Key><Key>c.PDF</Key>",)], "xml string")
    assert sorted(r[0] for r in pages.listing_keys(xml).collect()) == ["a.pdf", "c.PDF"]
    got = pages.deduplicated(spark.createDataFrame([("u1", b"%PDF-1"), ("u2", b"%PDF-1"), ("u3", b"<html>")], "url string, content binary")).collect()
    assert sorted((r["url"], len(r["aliases"]), r["error"]) for r in got) == [("u1", 2, None), ("u3", 1, "NOT_PDF")]


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "v": "a"}\n{"id": 1, "v": "b"}\n{"id": 2, "v": "c"}\n')
    got = files.json_lines(spark, str(tmp_path / "a.jsonl"), "id int, v string", "id").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "b"), (2, "c")]
    (tmp_path / "seeds.txt").write_text("# no\n\n a \n")
    assert [r[0] for r in files.text_list(spark, str(tmp_path / "seeds.txt")).collect()] == ["a"]
    (tmp_path / "c.csv").write_text("a,b\n1,x\n")
    assert [tuple(r) for r in files.csv(spark, str(tmp_path / "c.csv"), "a int, b string").collect()] == [(1, "x")]
    assert files.documents(spark, str(tmp_path / "c.csv")).first()["size"] == 8
    texts = spark.createDataFrame([(["x" * 50, "y" * 50],), (["x"],), (None,)], "t array<string>")
    assert [r[0] for r in texts.select(files.has_text_layer(F.col("t"))).collect()] == [True, False, False]


def test_lookup_asks_only_for_the_unknown(spark):
    cache = spark.createDataFrame([("12345678000195", 404)], "cnpj string, status int")
    hit, miss = files.lookup(spark.createDataFrame([("12.345.678/0001-95",), ("11222333000181",), ("1",)], "cnpj string"), cache)
    assert [r["status"] for r in hit.collect()] == [404]
    assert [r["cnpj"] for r in miss.collect()] == ["11222333000181"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("r1", 2, ["a", "b"]), ("r1", 1, ["c"])], "run_id string, k int, tags array<string>")
    sinks.export_csv(df, str(tmp_path / "csv"), ["k", "tags"], ["k"])
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "csv"), header=True).collect()] == [("1", "c"), ("2", "a|b")]
    sinks.overwrite_run(df, str(tmp_path / "t"))
    sinks.overwrite_run(df.withColumn("run_id", F.lit("r2")), str(tmp_path / "t"))
    sinks.overwrite_run(df.limit(1), str(tmp_path / "t"))
    assert {r["run_id"]: r["count"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy("run_id").count().collect()} == {"r1": 1, "r2": 2}
    assert "| r1 | 2 |" in sinks.markdown({"runs": df.groupBy("run_id").count()})
    df.createOrReplaceTempView("runs_view")
    assert sinks.dump_state(spark, {"no_such_table": "k"}, str(tmp_path / "d")) == []


def test_insert_or_replace(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c")], "k int, v string")
    assert sorted(map(tuple, tables.insert_or_replace(old, new, "k").collect())) == [(1, "a"), (2, "c")]


def test_streaming_ingest(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    events.write.parquet(str(tmp_path / "in"))
    schema = "event_id long, ts timestamp, event_type string, value double"
    stream = ingest.once_per_key(ingest.arriving(spark, str(tmp_path / "in"), schema, "ts", "60 days"), "event_id")
    ingest.append_to(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.select("event_id").distinct().count()
    counted = ingest.windowed(ingest.arriving(spark, str(tmp_path / "in"), schema, "ts"), "ts", "event_type", "value")
    q = counted.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("counted").agg(F.sum("n")).first()[0] == events.count()
