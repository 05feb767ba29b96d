"""Scores, fits and the whole pipeline against plain re-statements."""

import brute
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import crf, quality_rules, urlfilter


@pytest.fixture(scope="module")
def docs(spark, small):
    return [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "source").collect()]


@pytest.fixture(scope="module")
def trusted(spark, small):
    return {r["doc_id"] for r in spark.read.parquet(f"{small}/labels.parquet").filter("quality = 1").collect()}


def test_quality_scores_and_verdicts(spark, small, docs, trusted):
    rows = [r[:2] for r in docs] + [(None, "no id " * 60), (10**6, "abc"), (10**6 + 1, ""), (10**6 + 2, None)]
    out = quality_rules.judged(spark.createDataFrame(rows, "doc_id long, text string"), spark.read.parquet(f"{small}/labels.parquet"))
    got = {r["doc_id"]: (r["score"], r["kept"]) for r in out.select("doc_id", "score", "kept").collect()}
    for (d, score), (_, text) in zip(brute.gram_scores(rows, trusted), rows, strict=True):
        assert got[d][0] == pytest.approx(score, abs=1e-9)
        assert got[d][1] == (not brute.base_rules(text)[-1] and score >= quality_rules.THRESHOLD)
    # a bounded share of rejections shows that both verdicts occur
    assert 0 < sum(k for _, k in got.values()) < len(got)


def test_url_model_equals_sums_over_rows(spark, monkeypatch):
    urls = ["http://casino-win.example.net/en/12", "https://library.example.org/catalogue", "http://a.b/", "nothing", "HTTP://X.Y/p?q", "http://é.org/ü#f", "http://it's.org/'q"]
    labels = [1, 0, 1, 0, 0, 1, 0]
    monkeypatch.setattr(urlfilter, "ROUNDS", 40)
    table = spark.createDataFrame(list(zip(urls, labels, strict=True)), "url string, label int")
    host, path = urlfilter.host_and_path(F.col("url"))
    parts = [(r["h"], r["p"], r["label"], r["c"]) for r in table.select(host.alias("h"), path.alias("p"), "label", urlfilter.cells(host, path).alias("c")).collect()]
    assert all(sorted(c) == sorted(brute.url_cells(h, p)) for h, p, _, c in parts)
    weights, bias = brute.url_weights([(c, y) for _, _, y, c in parts], 40, urlfilter.RATE, urlfilter.DECAY)
    got = urlfilter.train(table)
    assert got[-1] == pytest.approx(bias, abs=1e-9) and np.allclose(got[:-1], weights, atol=1e-9)
    judged = urlfilter.judge(table.select(F.lit(1).alias("page_id"), "url"), got, rules=[]).collect()
    for r in judged:
        own = brute.url_cells(r["host"], r["path"])
        z = sum(weights[c] for c in own) / max(len(own), 1) ** 0.5 + bias
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)


def test_labels_with_quotes_are_read(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text("url,label\nhttp://it's.org/a\\b,1\n")
    assert {r["url"] for r in urlfilter.labelled(spark, path).collect()} == {f"http://{p}it's.org/a\\b" for p in urlfilter.HOST_PREFIXES}


def test_chain_fit_equals_enumeration(monkeypatch):
    rng = np.random.default_rng(7)
    monkeypatch.setattr(crf, "STEPS", 30)
    sizes, labels = [3, 1, 4, 2], np.array([1, 0, 0, 1])
    first = np.concatenate([[0], np.cumsum(sizes)])
    x = rng.normal(size=(first[-1], 3))
    chain = crf.fit(x, first, labels, np.ones(first[-1]))
    scaled = chain.scaled(x)
    rows = [(scaled[a:b].tolist(), int(y)) for a, b, y in zip(first, first[1:], labels, strict=False)]
    emit, move = brute.chain_ascent(rows, 30, crf.RATE, crf.DECAY)
    assert np.allclose(chain.emit, emit, atol=1e-9) and np.allclose(chain.move, move, atol=1e-9)


def test_pipeline_equals_its_stages_restated(spark, small, docs, trusted):
    items = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = brute.pipeline(docs, trusted, items)
    out = corpus_pipeline.run(spark, small).groupBy("doc_id", "text", "source").agg(F.count("*").alias("n"), F.max("copy_no").alias("last")).collect()
    assert all(r["n"] == r["last"] for r in out)
    assert sorted((r["doc_id"], r["text"], r["source"], r["n"]) for r in out) == want
