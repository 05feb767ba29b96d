"""A polite crawl in rounds: budgets of pages, documents and depth per domain, robots rules.

Each round takes, domain by domain, the addresses found last in the order in which
a queue would: that of the page they stand on, then their place on it.  Pages come
from a table of what can be fetched, or from a reader of one; a round is one join
with it, and its result is written, so a lost executor repeats no fetch before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import html_text, lower_plain, unescaped
from ..operators.cut import cut
from .pages import absolute, anchors, case_numbers, classified, host, title

#: Words of addresses and texts that lead to cases, plain lower case; addresses that lead nowhere; kinds of links that are documents.
NAVIGATION = r"processo|caso|recupera|falenc|cliente|lista|credor|\brj\b|ativo|edital|andamento|documento|page/|pagina|/p/[0-9]"
NOWHERE = r"/(tag|category|categoria|author|feed|wp-json|xmlrpc|wp-login|comments)/|\?(s|replytocom)=|#"
DOCUMENT_LINK, DOCUMENT_KINDS = r"(?i)\.pdf|download|arquivo", ("LIST", "PLAN", "HOMOLOG")
MAX_PAGES, MAX_DOCUMENTS, MAX_DEPTH, TEXT = 120, 60, 3, 200


def robots_rules(robots: DataFrame) -> DataFrame:
    """(domain, allow, prefix) of the groups for all agents (robots: domain, text).

    Rules without a path, and those that shut out whole sites, are not kept, as
    lists that the public has a right to see stand on such sites.
    """
    lines = robots.select("domain", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\r?\n")).alias("pos", "line"))
    name, value = F.lower(F.trim(F.substring_index("line", ":", 1))), F.trim(F.regexp_replace(F.regexp_extract("line", r"^[^:]*:(.*)$", 1), "#.*$", ""))
    lines = lines.withColumn("name", name).withColumn("value", value)
    so_far = Window.partitionBy("domain").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    agent = F.last(F.when(F.col("name") == "user-agent", F.col("value")), ignorenulls=True).over(so_far)
    rules = lines.withColumn("agent", agent).filter("agent = '*' and name in ('allow', 'disallow') and value not in ('', '/')")
    return rules.select("domain", (F.col("name") == "allow").alias("allow"), F.col("value").alias("prefix")).distinct()


def permitted(links: DataFrame, rules: DataFrame) -> DataFrame:
    """Links (domain, url) that the longest matching rule allows; of equal lengths the allowing one counts.

    Rules are gathered per domain, which has few, and tested in the row.
    """
    per = rules.groupBy("domain").agg(F.collect_list(F.struct(F.length("prefix").alias("n"), "allow", "prefix")).alias("_rules"))
    out = links.join(per, "domain", "left")
    path = path_of(F.col("url"))
    best = F.array_max(F.filter("_rules", lambda r: F.startswith(path, r["prefix"])))
    return out.filter(F.coalesce(best["allow"], F.lit(True))).drop("_rules")


def path_of(url: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("")), F.lit("/"))


def links_of(visited: DataFrame) -> DataFrame:
    """Links of fetched pages (domain, url, depth, at, html): page, title, cases, pos, href (absolute) and text."""
    keep = ["domain", "url", "depth", "at"]
    text = F.left(F.col("inner"), F.lit(TEXT))
    facts = visited.select(*keep, "html", title(F.col("html")).alias("title"), F.array_join(case_numbers(html_text(F.col("html"))), ",").alias("cases"))
    each = anchors(facts, [*keep, "title", "cases"])
    each = each.withColumn("href", F.trim(unescaped(F.col("href")))).filter(~F.lower("href").rlike("^(mailto|tel|javascript):"))
    return each.select("domain", F.col("url").alias("page"), "depth", "at", "title", "cases", "pos", absolute(F.col("url"), F.col("href")).alias("url"), text.alias("text")).filter(F.col("url").rlike("(?i)^https?://"))


def followed(links: DataFrame) -> DataFrame:
    """Links to pages of the same domain that lead on: every one of an index page, elsewhere those whose words do."""
    index = (F.col("depth") == 0) | lower_plain(path_of(F.col("page"))).rlike(NAVIGATION)
    worded = lower_plain(F.col("url")).rlike(NAVIGATION) | lower_plain(F.col("text")).rlike(NAVIGATION)
    same = host(F.col("url")) == F.col("domain")
    return links.filter(~is_document(F.col("url")) & same & (index | worded) & ~F.col("url").rlike(NOWHERE))


def is_document(url: Column) -> Column:
    return url.rlike(DOCUMENT_LINK)


def crawl(web: DataFrame, seeds: DataFrame, robots: DataFrame, max_pages: int = MAX_PAGES, max_documents: int = MAX_DOCUMENTS, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, DataFrame]:
    """(visited, documents).

    web: url (without fragment) and html of the pages that can be fetched; seeds:
    url; robots: domain, text.  visited: domain, url, depth and at, the place in the
    domain's order, at most ``max_pages`` a domain.  documents: domain, url, score,
    kind, page, title, text, cases and rank, at most ``max_documents`` a domain, the
    best scores first and of equal ones the first found.  An address is asked for
    once; pages that cannot be fetched or may not be take no budget.
    """
    rules = cut(robots_rules(robots))
    start = seeds.select(F.substring_index("url", "#", 1).alias("url")).distinct()
    found = start.select(host(F.col("url")).alias("domain"), "url", F.lit(0).cast("long").alias("from"), F.lit(0).alias("pos"))
    seen, budget, rounds, links = None, None, [], []
    for depth in range(max_depth + 1):
        first = Window.partitionBy("domain", "url").orderBy("from", "pos")
        new = found.withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r")
        if seen is not None:
            new = new.join(seen, ["domain", "url"], "left_anti")
        new = cut(new)
        seen = new.select("domain", "url") if seen is None else cut(seen.unionByName(new.select("domain", "url")))
        fetched = permitted(new, rules).join(web.select("url", "html"), "url").filter("html is not null")
        order = Window.partitionBy("domain").orderBy("from", "pos", "url")
        fetched = fetched.withColumn("n", F.row_number().over(order))
        fetched = fetched.withColumn("spent", F.lit(0).cast("long")) if budget is None else fetched.join(budget, "domain", "left").withColumn("spent", F.coalesce("spent", F.lit(0).cast("long")))
        at = F.col("spent") + F.col("n")
        last = cut(fetched.filter(at <= max_pages).select("domain", "url", F.lit(depth).alias("depth"), at.alias("at"), "html"))
        rounds.append(last.drop("html"))
        links.append(cut(links_of(last)))
        if depth == max_depth or last.isEmpty():
            break
        budget = cut(reduce(DataFrame.unionByName, rounds).groupBy("domain").agg(F.max("at").alias("spent")))
        found = followed(links[-1]).select("domain", "url", F.col("at").alias("from"), "pos")
    every = classified(reduce(DataFrame.unionByName, links).filter(is_document(F.col("url"))).withColumnsRenamed({"url": "href", "text": "inner"})).withColumnsRenamed({"href": "url", "inner": "text"})
    wanted = every.filter(F.col("kind").isin(*DOCUMENT_KINDS))
    best = Window.partitionBy("domain", "url").orderBy(F.desc("score"), "at", "pos")
    once = wanted.withColumn("first", F.min(F.struct("at", "pos")).over(Window.partitionBy("domain", "url"))).withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r")
    rank = F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("score"), "first", "url"))
    documents = once.withColumn("rank", rank).filter(F.col("rank") <= max_documents)
    return reduce(DataFrame.unionByName, rounds), documents.select("domain", "url", "score", "kind", "page", "title", "text", "cases", "rank")
