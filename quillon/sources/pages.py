"""Web pages: anchors, titles, link classes, frontier, listings, downloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import html_text
from ..operators.rules import link_kind

ANCHOR = r"""(?is)<a\b[^>]*?href\s*=\s*["']([^"'#]+)["'][^>]*>(.*?)</a>"""
CASE = r"\b[0-9]{7}-[0-9]{2}\.[0-9]{4}\.[0-9]\.[0-9]{2}\.[0-9]{4}\b"


def title(html: Column) -> Column:
    return html_text(F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1))


def anchors(pages: DataFrame, keep: list[str]) -> DataFrame:
    """One row per link of a page: pos, href, inner (its text)."""
    get = lambda k: F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(k))
    each = pages.select(*keep, F.posexplode(F.arrays_zip(get(1).alias("href"), get(2).alias("inner"))).alias("pos", "a"))
    return each.select(*keep, "pos", F.col("a.href").alias("href"), html_text(F.col("a.inner")).alias("inner"))


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.parse_url(url, F.lit("HOST"))), r"^www\.", "")


def quoted(path: Column) -> Column:
    """Characters that no address may hold as %XX of their UTF-8 bytes; what is quoted already stays."""
    unsafe = r"[^A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;=%]+"
    marks = F.transform(F.regexp_extract_all(path, F.lit(f"({unsafe})"), F.lit(1)), lambda x: F.replace(F.url_encode(x), F.lit("+"), F.lit("%20")))
    pairs = F.arrays_zip(F.split(path, unsafe, -1).alias("a"), marks.alias("b"))
    return F.when(path.rlike(unsafe), F.array_join(F.transform(pairs, lambda p: F.concat(p["a"], F.coalesce(p["b"], F.lit("")))), "")).otherwise(path)


def without_dots(path: Column) -> Column:
    """``.`` and ``..`` segments of a path resolved; it never climbs above its root."""
    segments = F.split(path, "/", -1)
    none = F.array().cast("array<string>")
    kept = F.aggregate(segments, none, lambda acc, s: F.when(s == ".", acc).when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.concat(acc, F.array(s))))
    tail = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.array_join(tail, "/")).otherwise(path)


def absolute(base: Column, href: Column) -> Column:
    """``href`` against ``base``: dot segments resolved, characters quoted, without its fragment."""
    href = F.trim(href)
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    own = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(own, "^(.*/)", 1), F.lit("")), F.lit("/"))
    relative = F.regexp_extract(href, "^([^?#]*)", 1)
    query = F.regexp_extract(href, r"^[^?#]*(\?[^#]*)", 1)
    path = F.when(relative == "", F.when(own == "", "/").otherwise(own)).when(relative.startswith("/"), relative).otherwise(F.concat(folder, relative))
    full = F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), href))
    given = F.regexp_extract(full, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    rest = F.regexp_extract(full, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    whole = F.when(given == "", F.substring_index(full, "#", 1)).otherwise(F.concat(given, quoted(without_dots(rest)), quoted(F.regexp_extract(full, r"(\?[^#]*)", 1))))
    return F.when(full.isNotNull(), whole).otherwise(F.concat(root, quoted(without_dots(path)), quoted(query)))


def candidates(links: DataFrame, url: str, group: str, cap: int) -> DataFrame:
    """Best link per URL, then at most ``cap`` per domain by score."""
    best = links.groupBy(group, url).agg(F.max("score").alias("score"), F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    w = Window.partitionBy(group).orderBy(F.col("score").desc(), F.col(url))
    return best.filter(F.col("score") > 0).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= cap)


def classified(links: DataFrame, words: dict[str, str] | None = None) -> DataFrame:
    k = link_kind(F.col("href"), F.col("inner"), words)
    return links.withColumn("_k", k).select("*", "_k.kind", "_k.score").drop("_k")


def case_numbers(text: Column, cap: int = 6) -> Column:
    """The first ``cap`` case numbers of a page, in order; the described system keeps as many."""
    return F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({CASE})"), F.lit(1)))), 1, cap)


def crawl_frontier(links: DataFrame, seeds: DataFrame, depth: int = 3) -> DataFrame:
    """(url, depth): pages reachable over ``links`` (src, dst), least depth first.

    Each round joins only the pages found last; a page enters once.
    """
    seen = seeds.select("url").distinct().withColumn("depth", F.lit(0))
    last = seen
    for d in range(1, depth + 1):
        step = links.join(last, links["src"] == last["url"], "left_semi").select(F.col("dst").alias("url")).distinct()
        last = step.join(seen, "url", "left_anti").withColumn("depth", F.lit(d))
        seen = seen.unionByName(last)
    return seen


def listing_keys(xml: DataFrame, cap: int | None = None) -> DataFrame:
    """PDF keys of a bucket listing (column xml)."""
    keys = xml.select(F.explode(F.regexp_extract_all("xml", F.lit("<Key>([^<]+)</Key>"), F.lit(1))).alias("key")).filter(F.lower("key").endswith(".pdf"))
    return keys if cap is None else keys.orderBy("key").limit(cap)


def to_download(links: DataFrame, known: DataFrame) -> DataFrame:
    """Addresses (url) that no earlier record (known: url or its aliases) holds: a file is asked for once."""
    seen = known.select(F.explode(F.array_union(F.array("url"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("url")).distinct()
    return links.join(seen, "url", "left_anti").dropDuplicates(["url"])


def deduplicated(files: DataFrame, content: str = "25504446") -> DataFrame:
    """Files (url, content) by content hash, the least url first, the others as aliases.

    ``content`` is the hexadecimal beginning that a file of the wanted kind has;
    others, and missing contents, become error rows of their own address.
    """
    wanted = F.coalesce(F.hex(F.substring("content", 1, 16)).startswith(content), F.lit(False))
    key = F.when(wanted, F.sha1("content")).otherwise(F.concat(F.lit("ERR:"), F.sha1(F.col("url").cast("binary"))))
    each = files.select(key.alias("sha1"), "url", F.length("content").alias("size"), F.when(~wanted, F.lit("NOT_PDF")).alias("error"))
    return each.groupBy("sha1").agg(F.min("url").alias("url"), F.array_sort(F.collect_set("url")).alias("aliases"), F.max("size").alias("size"), F.max("error").alias("error"))
