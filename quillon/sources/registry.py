"""Registry lookups at a measured pace: one stream of calls per host.

Every host answers one partition, whose reader waits between calls, waits longer
when it is told to slow down, and tries again what failed.  Answers and known
misses are kept, so an id is asked for once.  Hosts work side by side: ids are
dealt to them, and what one could not answer goes to the next in a further round.
A round is written before the next begins, so a lost executor repeats its own
calls at most.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cut import cut
from .files import lookup

#: Seconds between two calls of one host, seconds to wait when told to slow down, calls for one id.
INTERVAL, SLOWER, TRIES, TIMEOUT = 0.7, 5.0, 3, 30
ANSWER = "cnpj string, source string, fetched_at timestamp, status int, json string"
_COLUMNS = ["cnpj", "source", "fetched_at", "status", "json"]


def call(url: str, timeout: float = TIMEOUT) -> tuple[int, str]:
    """(status, body); 0 where no answer came."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as answer:
            return answer.status, answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, ""
    except (OSError, ValueError):
        return 0, ""


def useful(body: str) -> bool:
    """A record that names a company."""
    try:
        record = json.loads(body)
    except ValueError:
        return False
    return isinstance(record, dict) and bool(record.get("razao_social") or record.get("cnpj"))


def asked(asks: DataFrame, hosts: dict[str, str], interval: float, slower: float, tries: int) -> DataFrame:
    """Answers to asks (cnpj, source): rows of status 200 and 404; what failed has none."""

    def run(batches):
        last: dict[str, float] = {}

        def paced(source: str, cnpj: str) -> tuple[int, str]:
            status, body = 0, ""
            for _ in range(tries):
                wait = last.get(source, 0.0) + interval - time.monotonic()
                if wait > 0:
                    time.sleep(wait)
                last[source] = time.monotonic()
                status, body = call(hosts[source].format(cnpj=cnpj))
                if status == 429:
                    last[source] = time.monotonic() + slower
                elif status in (200, 404):
                    break
            return status, body

        for batch in batches:
            rows = []
            for source, cnpj in zip(batch["source"], batch["cnpj"], strict=True):
                status, body = paced(source, cnpj)
                if status == 404 or (status == 200 and useful(body)):
                    rows.append((cnpj, source, pd.Timestamp.now("UTC"), status, body if status == 200 else "{}"))
            yield pd.DataFrame(rows, columns=_COLUMNS)

    # all calls of a host in one partition: its pace is kept by one reader
    return asks.repartition(len(hosts), "source").mapInPandas(run, ANSWER)


def fetched(wanted: DataFrame, cache: DataFrame, hosts: dict[str, str], interval: float = INTERVAL, slower: float = SLOWER, tries: int = TRIES) -> tuple[DataFrame, DataFrame]:
    """(answers, cache with them): registry records of the ids wanted (cnpj).

    hosts: name -> address with {cnpj}; cache: cnpj, source, fetched_at, status,
    json.  An id is first asked of the host that its hash names, then of the
    others; a miss (404) settles it.  Malformed ids and those in the cache are not
    asked for.  Ids that no host answers stay out of the cache and come again.
    """
    names = list(hosts)
    hits, missing = lookup(wanted, cache.select("cnpj", "status", "json", "source", "fetched_at"))
    left, found = cut(missing.select("cnpj")), []
    for k in range(len(names)):
        source = F.element_at(F.array(*map(F.lit, names)), (F.pmod(F.xxhash64("cnpj") + k, F.lit(len(names))) + 1).cast("int"))
        answers = cut(asked(left.select("cnpj", source.alias("source")), hosts, interval, slower, tries))
        found.append(answers)
        left = cut(left.join(answers, "cnpj", "left_anti"))
        if left.isEmpty():
            break
    new = reduce(DataFrame.unionByName, found)
    known = cache.select(*_COLUMNS).unionByName(new)
    return hits.select(*_COLUMNS).unionByName(new).filter("status = 200"), known
