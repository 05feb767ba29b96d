"""Which creditors are likely a debtor's own family, over all creditors and debtors.

Kin share something: a root, a distinctive word, a partner.  Both sides list what
they have as postings, equal postings meet in one join, and what meets is
verified.  A posting that both sides hold often is split: its creditors are dealt
to as many shares as its pairs ask for, and its debtors go to each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm, token_set_ratio, tokens
from .cut import cut
from .resolve import KIN

#: Pairs of one posting that one share may make.
PAIRS = 1 << 20
REASONS = ("own root", "group member", "shared head name", "same name", "shared partner")
_OWN, _MEMBER, _HEAD, _SAME, _PARTNER = range(len(REASONS))


def distinctive_words(names: DataFrame, key: str, generic: DataFrame) -> DataFrame:
    """(key, words): the words of each name that are not generic (token), in order."""
    each = names.select(key, F.posexplode(tokens(F.col("name"))).alias("pos", "token")).join(generic.select("token"), "token", "left_anti")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"])
    return each.groupBy(key).agg(ordered.alias("words"))


def _with_words(side: DataFrame, key: str, generic: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    return cut(side.join(distinctive_words(side, key, generic), key, "left").withColumn("words", F.coalesce("words", none)).withColumn("head", F.try_element_at("words", F.lit(1))))


def _postings(side: DataFrame, roots: Column) -> DataFrame:
    tagged = lambda kind, values: F.transform(F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != ""))), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))
    none = F.array().cast("array<string>")
    every = F.concat(tagged("root", roots), tagged("word", F.col("words")), tagged("partner", F.coalesce("partners", none)))
    return side.select("*", F.explode(every).alias("p")).select("*", "p.kind", "p.value").drop("p", "partners")


def related(creditors: DataFrame, debtors: DataFrame, generic: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(root, debtor_id, kin): the first reason, in the order of ``REASONS``, for each pair that has one.

    creditors: root, name, partners, one row a root; debtors: debtor_id, root,
    member_roots, name, partners, one row an id; generic: token, words that tell no
    company apart.  Partners are normal names.  A shared distinctive word counts
    where it heads one of the names, or where the names' word sets are alike by
    ``KIN`` and the debtor has two such words; names that share no distinctive word
    are not compared.  Null names, roots and partner lists hold nothing.
    """
    none = F.array().cast("array<string>")
    c = _with_words(creditors.select("root", "name", "partners"), "root", generic)
    d = _with_words(debtors.select("debtor_id", F.col("root").alias("own_root"), "member_roots", F.col("name"), "partners"), "debtor_id", generic)
    left = _postings(c, F.array("root"))
    right = _postings(d, F.concat(F.array("own_root"), F.coalesce("member_roots", none))).select("kind", "value", "debtor_id", "own_root", F.col("name").alias("debtor"), F.col("head").alias("debtor_head"), F.size("words").alias("debtor_words"))
    key = ["kind", "value"]
    often = left.groupBy(*key).agg(F.count("*").alias("n")).join(right.groupBy(*key).agg(F.count("*").alias("m")), key)
    shares = cut(often.select(*key, F.ceil(F.col("n") * F.col("m") / pairs).alias("shares")).filter("shares > 1"))
    one = F.coalesce("shares", F.lit(1).cast("long"))
    left = left.join(shares, key, "left").withColumn("share", F.pmod(F.xxhash64("root"), one)).drop("shares")
    right = right.join(shares, key, "left").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), one - 1))).drop("shares")
    met = left.join(right, [*key, "share"])
    word = F.col("kind") == "word"
    heads = (F.col("value") == F.col("head")) | (F.col("value") == F.col("debtor_head"))
    sure = F.when(F.col("kind") == "root", F.when(F.col("root") == F.col("own_root"), _OWN).otherwise(_MEMBER)).when(word & heads, _HEAD).when(F.col("kind") == "partner", _PARTNER)
    found = met.groupBy("root", "debtor_id").agg(F.min(sure).alias("sure"), F.max(word & ~heads & (F.col("debtor_words") >= 2)).alias("maybe"), F.any_value("name").alias("name"), F.any_value("debtor").alias("debtor"))
    found = cut(found)
    asked = F.col("maybe") & (F.col("sure").isNull() | (F.col("sure") > _SAME))
    alike = found.filter(asked).withColumn("alike", token_set_ratio(F.col("debtor"), F.col("name")) >= KIN)
    alike = alike.withColumn("sure", F.when(F.col("alike"), _SAME).otherwise(F.col("sure"))).drop("alike")
    every = found.filter(~asked).unionByName(alike).filter("sure is not null")
    return every.select("root", "debtor_id", F.element_at(F.array(*map(F.lit, REASONS)), F.col("sure") + 1).alias("kin"))


def partner_keys(names: Column) -> Column:
    """Normal names of persons, as postings."""
    return F.array_distinct(F.transform(names, lambda n: norm(n)))
