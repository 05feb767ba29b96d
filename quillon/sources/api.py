"""Paged API scan as a Python data source, and the flattening of its records."""

from __future__ import annotations

import functools
import json
import operator
import os
import time
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.ids import case_number
from ..operators.rules import cascade

#: Wordings of movements, lower case.
BANKRUPTCY = ("decretação de falência", "convolação em falência", "decreta a falência")
CLOSED = ("extinção", "baixa definitiva", "arquivamento definitivo", "encerramento")
GRANT = ("concessão da recuperação", "homologação do plano", "homologação de plano")
CASE_CLASS = 129

HIT_SCHEMA = (
    "numeroProcesso string, tribunal string, grau string, dataAjuizamento string, orgaoJulgador struct<nome:string,codigo:int>, "
    "sistema struct<nome:string>, movimentos array<struct<codigo:int,nome:string,dataHora:string>>, dataHoraUltimaAtualizacao string"
)


def post_json(url: str, body: dict, key: str | None) -> dict:
    headers = {"Content-Type": "application/json"} | ({"Authorization": f"APIKey {key}"} if key else {})
    request = urllib.request.Request(url, json.dumps(body).encode(), headers)
    with urllib.request.urlopen(request, timeout=90) as answer:
        return json.load(answer)


def pages(fetch: Callable[[dict], dict], since: str, size: int, tries: int = 4, wait: float = 2.0) -> Iterator[dict]:
    """Hits of every page: a cursor from the last hit, retries, a short page ends."""
    body = {
        "size": size,
        "query": {"bool": {"must": [{"match": {"classe.codigo": CASE_CLASS}}], "filter": [{"range": {"dataAjuizamento": {"gte": since.replace("-", "") + "000000"}}}]}},
        "sort": [{"@timestamp": {"order": "asc"}}, {"numeroProcesso.keyword": {"order": "asc"}}],
    }
    while True:
        for attempt in range(1, tries + 1):
            try:
                hits = fetch(body).get("hits", {}).get("hits", [])
                break
            except OSError:
                if attempt == tries:
                    raise
                time.sleep(wait * attempt)
        yield from hits
        if len(hits) < size:
            return
        body["search_after"] = hits[-1].get("sort")


class CourtPartition(InputPartition):
    def __init__(self, court: str):
        super().__init__(court)
        self.court = court


class CasesReader(DataSourceReader):
    """One partition per court; a court that fails gives an error row."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self):
        return [CourtPartition(c) for c in self.options["courts"].split(",") if c]

    def read(self, partition):
        url = self.options["url"].replace("{court}", partition.court)
        key = os.environ.get(self.options.get("key_variable", "CASES_API_KEY"))
        fetch = lambda body: post_json(url, body, key)
        try:
            for hit in pages(fetch, self.options.get("since", "2020-01-01"), int(self.options.get("size", 1000)), wait=float(self.options.get("wait", 2))):
                yield partition.court, json.dumps(hit.get("_source", {}), ensure_ascii=False), None
        except OSError as e:
            yield partition.court, None, str(e)[:200]


class CasesSource(DataSource):
    """``spark.read.format("cases_api")`` with url, courts, since and size."""

    @classmethod
    def name(cls) -> str:
        return "cases_api"

    def schema(self) -> str:
        return "court string, source string, error string"

    def reader(self, schema):
        return CasesReader(dict(self.options))


#: Stands between the names of movements, and in no wording.
_BETWEEN = "\x01"


def _any_word(names: Column, words) -> Column:
    """Whether one of the names, joined, holds one of the wordings."""
    return functools.reduce(operator.or_, [names.contains(w) for w in words])


def flatten(hits: DataFrame, column: str = "source") -> DataFrame:
    """Cases from JSON records: stage, grant signal, dates, last 40 movements."""
    h = hits.select(F.from_json(column, HIT_SCHEMA).alias("h")).select("h.*")
    h = h.withColumn("_moves", F.coalesce("movimentos", F.array().cast("array<struct<codigo:int,nome:string,dataHora:string>>")))
    # one text of all names, worked out once, is searched by compiled code; functions of arrays are interpreted
    h = h.withColumn("_names", F.lower(F.array_join("_moves.nome", _BETWEEN)))
    moves, names = F.col("_moves"), F.col("_names")
    stage = cascade([(_any_word(names, BANKRUPTCY), "CONVERTED_TO_BANKRUPTCY"), (_any_word(names, CLOSED), "CLOSED")], "ACTIVE")
    last = F.substring(F.array_max("_moves.dataHora"), 1, 10)
    tail = F.slice(moves, F.greatest(F.size(moves) - 39, F.lit(1)), 40)
    filed = F.regexp_replace(F.substring("dataAjuizamento", 1, 8), "^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")
    return h.select(
        case_number(F.col("numeroProcesso")).alias("case_number"),
        F.upper("tribunal").alias("court"),
        F.col("orgaoJulgador.nome").alias("chamber"),
        F.col("orgaoJulgador.codigo").alias("chamber_code"),
        "grau",
        filed.try_cast("date").alias("filing_date"),
        stage.alias("stage"),
        _any_word(names, GRANT).alias("grant_signal"),
        last.try_cast("date").alias("last_movement"),
        F.size(moves).alias("n_movements"),
        F.transform(tail, lambda m: F.struct(m["codigo"].alias("c"), m["nome"].alias("n"), F.substring(m["dataHora"], 1, 10).alias("d"))).alias("movements"),
        F.col("sistema.nome").alias("system"),
        F.col("dataHoraUltimaAtualizacao").alias("updated"),
    )
