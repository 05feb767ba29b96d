"""Operator 7: URL filter by rules and logistic regression on character n-grams.

The host and path of every URL are cut into character n-grams, hashed into a
fixed number of weights and scored by a logistic regression that is trained from
a small labelled table (the file beside this module, or one that is given; at most
``MAX_LABELLED`` rows).  Block and allow rules come first: a rule fits its host
and all subdomains if the path starts with the rule's; the longest rule wins.
Everything over the pages is DataFrame expressions; the trained weights are a
literal of fixed length.

Cases: a null url or one without "://" has an empty host and path, no rule, and
the model's verdict on empty strings; ties between rules of equal length go to
the first listed; a very long url is scored whole, n-gram by n-gram; repeated rows
get equal results; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import csv
import json
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .clusterio import read

CELLS = 2048
SIZES = (3, 4, 5)
ROUNDS, RATE, DECAY = 1000, 2.0, 1e-4
THRESHOLD = 0.5
MAX_LABELLED = 5_000
#: Rules become one CASE expression.
MAX_RULES = 1_000
RULES = [
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("block", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
]
#: The labelled addresses (label 1: unwanted), each trained with and without usual subdomains.
LABELS = Path(__file__).with_name("url_labels.csv")
HOST_PREFIXES = ("", "www.", "m.", "blog.")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty where there is no "://"."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    main = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.substring_index(main, "/", 1)
    return F.translate(host, _UPPER, _LOWER), F.substr(main, F.length(host) + 1)


def _grams(kind: str, text: Column, n: int) -> Column:
    at = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.pmod(F.xxhash64(F.lit(kind), F.substring(text, i, F.lit(n))), F.lit(CELLS)).cast("int"))


def cells(host: Column, path: Column) -> Column:
    """Weights that a URL uses: hashed n-grams of host and path."""
    parts = []
    for kind, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(path, F.lit("$")))):
        for n in SIZES:
            parts.append(_grams(kind, text, n))
    return F.concat(*parts)


def labelled(spark: SparkSession, path: Path = LABELS) -> DataFrame:
    """The labelled table that comes with the operator: url, label."""
    with path.open(newline="") as f:
        rows = [(r["url"], int(r["label"])) for r in csv.DictReader(f)]
    each = [(url.replace("://", f"://{p}", 1), y) for url, y in rows for p in HOST_PREFIXES]
    quoted = lambda u: "'" + u.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return spark.sql("select * from values " + ", ".join(f"({quoted(u)}, {y})" for u, y in each) + " as t(url, label)")


def train(table: DataFrame) -> list[float]:
    """Weights and, last, the bias: batch gradient descent, on the driver.

    The labelled table is small by contract; more than ``MAX_LABELLED`` rows are
    an error rather than a sample.
    """
    rows = table.select(cells(*host_and_path(F.col("url"))).alias("cells"), F.col("label").cast("int").alias("y")).filter("y is not null")
    got = [(r["cells"], r["y"]) for r in rows.limit(MAX_LABELLED + 1).collect()]
    if len(got) > MAX_LABELLED:
        raise ValueError(f"the labelled table has more than {MAX_LABELLED} rows")
    weights, bias = np.zeros(CELLS), 0.0
    x, y = np.zeros((len(got), CELLS)), np.array([y for _, y in got], dtype=float)
    for row, (own, _) in zip(x, got, strict=True):
        np.add.at(row, own, 1 / np.sqrt(max(len(own), 1)))
    for _ in range(ROUNDS if got else 0):
        error = (1 / (1 + np.exp(-(x @ weights + bias))) - y) / len(got)
        weights -= RATE * (x.T @ error + DECAY * weights)
        bias -= RATE * float(error.sum())
    return [*weights.tolist(), bias]


def score(host: Column, path: Column, weights: list[float]) -> Column:
    own = cells(host, path)
    # one foldable expression, which the optimiser turns into a literal array
    table = F.from_json(F.lit(json.dumps(weights[:-1])), "array<double>")
    total = F.aggregate(own, F.lit(0.0), lambda acc, c: acc + F.element_at(table, c + 1))
    return 1 / (1 + F.exp(-(total / F.sqrt(F.greatest(F.size(own), F.lit(1))) + F.lit(weights[-1]))))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits, else nulls."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    fits = []
    for action, rule in sorted(rules, key=lambda r: -len(r[1])):
        own, _, rest = rule.partition("/")
        fits.append((((host == own) | host.endswith("." + own)) & path.startswith("/" + rest), rule, action))
    pick = lambda k: F.coalesce(*[F.when(f[0], F.lit(f[k])) for f in fits], F.lit(None).cast("string"))
    return pick(1), pick(2)


def judge(pages: DataFrame, weights: list[float] | None = None, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, score of each row of pages."""
    weights = weights or train(labelled(pages.sparkSession))
    host, path = host_and_path(F.col("url"))
    out = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, action = rule_for(F.col("host"), F.col("path"), rules)
    out = out.withColumn("score", score(F.col("host"), F.col("path"), weights))
    model = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(action, model).alias("verdict"), "score")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages").select("page_id", "url"))
