"""Claims in running text: headers with counts and totals, entries by ';'."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import digits
from ..functions.money import currency_of, parse_brl
from ..functions.text import plain
from .rules import BOUNDARY, may_bound

DOCUMENT = r"[0-9]{2}\.?[0-9]{3}\.?[0-9]{3}/?[0-9]{4}-?[0-9]{2}|[0-9]{3}\.?[0-9]{3}\.?[0-9]{3}-?[0-9]{2}"
VALUE = r"(?:R\$|US\$|USD\$?|EUR|€)\s*((?:[0-9]{1,3}(?:\.[0-9]{3})+|[0-9]+),[0-9]{2})"
_COUNTED = r"\(\s*([0-9]+)\s+(?i:CREDOR(?:ES)?)\s*\|\s*"
HEADER = rf"CLASSE\s+(IV|III|II|I)\b[^;:]{{0,80}}?{_COUNTED}((?:R\$|US\$)\s*[0-9.]+,[0-9]{{2}})\s*\)\s*:"
#: A class header without count and total ends at a colon or full stop; only upper-case CLASSE is a header.
BARE = r"CLASSE\s+(IV|III|II|I)\b[^;:.0-9\x01\x02]{0,80}[:.]"
#: A titled section with a count that names no class.
GENERIC = rf"(?<=^|[.;])\s*([^.;:()\x01\x02]{{8,90}}){_COUNTED}R\s*\$[^)]*\)\s*:?"
#: A boundary word opens a section, unless a class header follows closely or it stands in a title.
EDGE = rf"(?i){BOUNDARY}(?![^\x01\x02]*\x02)(?![^\x01]{{0,90}}\x01[IV])\s*:?"
LONG = 400


def headers(text: Column) -> Column:
    """Class headers: array of struct(class, count, total, currency)."""
    t = F.upper(plain(text))
    get = lambda k: F.regexp_extract_all(t, F.lit(HEADER), F.lit(k))
    zipped = F.arrays_zip(get(1).alias("c"), get(2).alias("n"), get(3).alias("v"))
    one = lambda h: F.struct(h["c"].alias("class"), h["n"].try_cast("int").alias("count"), parse_brl(F.regexp_replace(h["v"], r"^\S*\$\s*", "")).alias("total"), currency_of(h["v"]).alias("currency"))
    return F.transform(zipped, one)


def marked(text: Column) -> Column:
    """Plain text, but for boundary words, with each header as \\x01 class \\x02, of sections without a class \\x01\\x03 title \\x02."""
    t = F.regexp_replace(plain(text), "[\u0001-\u0003]", " ")
    for pattern, mark in ((HEADER, ""), (BARE, ""), (GENERIC, "\u0003")):
        t = F.regexp_replace(t, pattern, f"\u0001{mark}$1\u0002")
    return t


def entries(texts: DataFrame, text: str = "text") -> DataFrame:
    """One row per entry: section, seq, class, name, document, value, currency, flags.

    The text is cut at its headers, each section at ';'.  Sections under a titled
    count or a boundary word have no class; their entries are flagged SECTION_
    and the title.  Entries without a value in a currency are not claims.
    """
    # each step in a column of its own, which the next one reads
    t = texts.withColumn("_flat", marked(F.col(text))).withColumn("_upper", F.upper("_flat"))
    t = t.withColumn("_marked", F.when(may_bound(F.col("_upper")), F.upper(F.regexp_replace("_flat", EDGE, "\u0001\u0003$1\u0002"))).otherwise(F.col("_upper"))).drop("_flat", "_upper")
    parts = t.select("*", F.posexplode(F.split("_marked", "\u0001")).alias("section", "_part")).drop("_marked")
    head = F.when(F.col("_part").contains("\u0002"), F.substring_index("_part", "\u0002", 1))
    titled = head.startswith("\u0003")
    title = F.substring(F.regexp_replace(F.trim(F.substring_index(head, "\u0003", -1)), "[^A-Z0-9_]+", "_"), 1, 40)
    parts = parts.withColumns({"class": F.when(~titled, head), "_title": F.when(titled, title), "_body": F.substring_index("_part", "\u0002", -1)})
    rows = parts.select("*", F.posexplode(F.split("_body", ";")).alias("seq", "_entry")).drop("_part", "_body", text)
    rows = rows.withColumn("_money", F.regexp_extract("_entry", VALUE, 0)).filter(F.col("_money") != "")
    rows = rows.withColumn("_documents", F.transform(F.regexp_extract_all("_entry", F.lit(f"({DOCUMENT})"), F.lit(1)), lambda d: digits(d)))
    money, documents = F.col("_money"), F.col("_documents")
    roots = F.array_distinct(F.transform(documents, lambda d: F.substring(d, 1, 8)))
    flags = F.array_compact(
        F.array(
            F.when(F.size(roots) > 1, F.lit("MULTI_ROOT")),
            F.when(F.length("_entry") > LONG, F.lit("LONG_CHUNK")),
            F.when(currency_of(money) != "BRL", F.lit("FOREIGN_CURRENCY")),
            F.concat(F.lit("SECTION_"), F.col("_title")),
        )
    )
    name = F.trim(F.regexp_replace(F.regexp_extract("_entry", rf"(?s)^(.*?)(?:CPF|CNPJ|{DOCUMENT}|R\$|US\$|USD|EUR|€)", 1), r"[\s,:\-]+$", ""))
    out = rows.select(
        *[c for c in rows.columns if c not in ("_entry", "_title", "_money", "_documents")],
        name.alias("name"),
        F.try_element_at(documents, F.lit(1)).alias("document"),
        documents.alias("documents"),
        parse_brl(F.regexp_extract("_entry", VALUE, 1)).alias("value"),
        currency_of(money).alias("currency"),
        flags.alias("flags"),
    )
    return out
