"""The books stacked, and the dashboard that measures them; its totals refer to one another.

A dashboard is one frame of (block, place, label, n, amount, share).  Everything
but the two rankings comes from two grouped passes over the stack: one over all
rows, one over (dimension, label) pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUM = "decimal(28,2)"
#: States of a lead, those of a deal in progress, labels of the blocks.
STATUSES = ("NEW", "ATTEMPTED", "REACHED", "INTERESTED", "TERMS AGREED", "CESSÃO SIGNED", "SUBSTITUTED IN LIST", "SETTLED", "NOT INTERESTED", "DEAD")
IN_PROGRESS = ("INTERESTED", "TERMS AGREED", "CESSÃO SIGNED", "SUBSTITUTED IN LIST")
CLOSED = ("DEAD", "SETTLED")
BOOKS, BANDS, FITS = ("TRADE", "FINANCIAL", "STATE-OWNED"), ("A", "B", "C", "D", "U"), ("MID-MARKET", "SMALL", "LARGE CORP", "NO CAPITAL ON FILE", "UNKNOWN")
PROOFS = ("OK", "NO TOTALS", "PARTIAL", "CHECK")
TOP_ROWS, TOP_CASES, TOP_STATES = 15, 12, 10
STACK = ("creditor", "debtor", "face", "fund", "premium", "band", "status", "next_date", "state", "fit", "email", "proof", "case_number", "flags", "hold", "book", "tab", "tab_row")


def stacked(tabs: dict[str, DataFrame]) -> DataFrame:
    """All tabs in one frame of ``STACK``; tab and tab_row tell where a lead stands.

    Rows of a tab are numbered best first, by premium, then creditor and case.
    """

    def numbered(name: str, df: DataFrame) -> DataFrame:
        order = Window.orderBy(F.desc("premium"), "creditor", "case_number")
        # a tab is a sheet that people read: one order over its rows
        return df.withColumn("tab", F.lit(name)).withColumn("tab_row", F.row_number().over(order) + 1).select(*STACK)

    return reduce(DataFrame.unionByName, [numbered(k, v) for k, v in tabs.items()])


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def kpis(stack: DataFrame, as_of: str) -> DataFrame:
    """(label, n, amount) of the whole book; due dates are measured against ``as_of``."""
    day = F.lit(as_of).cast("date")
    proof = F.coalesce("proof", F.lit(""))
    check = proof.startswith("NO TOTALS") | proof.startswith("PARTIAL") | proof.startswith("CHECK")
    running = F.col("status").isin(*IN_PROGRESS)
    money = lambda on, c: F.coalesce(F.sum(F.when(on, F.col(c).cast(SUM))), F.lit(0)).cast(SUM)
    every = F.lit(True)
    rows = [
        ("leads", F.count("*"), None), ("face", None, money(every, "face")), ("fund price", None, money(every, "fund")), ("premium", None, money(every, "premium")),
        ("on hold", F.count_if(_filled("hold")), money(_filled("hold"), "face")), ("untouched", F.count_if(F.col("status") == "NEW"), None), ("due", F.count_if(F.col("next_date") == day), None),
        ("overdue", F.count_if((F.col("next_date") < day) & ~F.col("status").isin(*CLOSED)), None), ("in progress", F.count_if(running), money(running, "premium")),
        ("settled", F.count_if(F.col("status") == "SETTLED"), money(F.col("status") == "SETTLED", "premium")), ("with e-mail", F.count_if(_filled("email")), None),
        ("no route", F.count_if(F.coalesce("flags", F.lit("")).contains("no route")), None), ("proof to check", F.count_if(check), money(check, "premium")),
    ]
    one = lambda label, n, amount: F.struct(F.lit(label).alias("label"), (F.lit(None).cast("long") if n is None else n).alias("n"), (F.lit(None).cast(SUM) if amount is None else amount).alias("amount"))
    return stack.agg(F.array(*[one(*r) for r in rows]).alias("k")).select(F.posexplode("k").alias("place", "k")).select("place", "k.*")


def dashboard(stack: DataFrame, as_of: str) -> DataFrame:
    """(block, place, label, n, amount, share) of a stack of leads.

    Blocks: kpi, book, funnel, band, fit, proof, state (the first ``TOP_STATES`` by
    leads, other states, none, all rows), top (rows by premium), case (the cases of
    most leads), concentration (the largest case's and row's share of premium).  Labels without a lead show 0.
    """
    spark = stack.sparkSession
    # sums of cents, so that no order of addition shows
    amount, none = F.col("premium").cast(SUM), F.lit(0).cast(SUM)
    proof = F.regexp_extract(F.coalesce("proof", F.lit("")), "^(OK|NO TOTALS|PARTIAL|CHECK)", 1)
    dims = {"book": F.col("book"), "funnel": F.col("status"), "band": F.col("band"), "fit": F.col("fit"), "proof": proof, "state": F.coalesce("state", F.lit(""))}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("block"), v.alias("label")) for k, v in dims.items()])).alias("d")
    seen = stack.select(amount.alias("amount"), pairs).groupBy("d.block", "d.label").agg(F.count("*").alias("n"), F.sum("amount").cast(SUM).alias("amount"))
    labels = [("book", k, v) for k, v in enumerate(BOOKS)] + [("funnel", k, v) for k, v in enumerate(STATUSES)] + [("band", k, v) for k, v in enumerate(BANDS)] + [("fit", k, v) for k, v in enumerate(FITS)] + [("proof", k, v) for k, v in enumerate(PROOFS)]
    fixed = spark.createDataFrame(labels, "block string, place int, label string").join(seen, ["block", "label"], "left").select("block", "place", "label", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("amount", none).alias("amount"))
    # states: one row a state after the grouped pass
    states = seen.filter("block = 'state'").withColumn("r", F.when(F.col("label") != "", F.row_number().over(Window.partitionBy(F.col("label") == "").orderBy(F.desc("n"), "label"))))
    group = F.when(F.col("label") == "", "(none)").when(F.col("r") <= TOP_STATES, F.col("label")).otherwise("(other states)")
    place = F.when(F.col("label") == "", TOP_STATES + 1).when(F.col("r") <= TOP_STATES, F.col("r") - 1).otherwise(TOP_STATES)
    states = states.groupBy(group.alias("label"), place.alias("place")).agg(F.sum("n").alias("n"), F.sum("amount").cast(SUM).alias("amount"))
    every = stack.agg(F.count("*").alias("n"), F.coalesce(F.sum(amount), none).cast(SUM).alias("amount")).select(F.lit("(all rows)").alias("label"), F.lit(TOP_STATES + 2).alias("place"), "n", "amount")
    states = states.unionByName(every).select(F.lit("state").alias("block"), F.col("place").cast("int").alias("place"), "label", "n", "amount")
    whole = every.select(F.col("amount").alias("_all"))
    where = F.concat_ws(" · ", "creditor", "tab", F.col("tab_row").cast("string"))
    top = stack.orderBy(F.desc(amount), "tab", "tab_row").limit(TOP_ROWS).select(amount.alias("amount"), where.alias("label"), "tab", "tab_row")
    top = top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("amount"), "tab", "tab_row")) - 1).select(F.lit("top").alias("block"), "place", "label", F.lit(1).cast("long").alias("n"), "amount")
    cases = stack.filter(_filled("case_number")).groupBy(F.col("case_number").alias("label")).agg(F.count("*").alias("n"), F.sum(amount).cast(SUM).alias("amount"))
    deep = cases.orderBy(F.desc("n"), F.desc("amount"), "label").limit(TOP_CASES)
    deep = deep.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), F.desc("amount"), "label")) - 1).select(F.lit("case").alias("block"), "place", "label", "n", "amount")
    largest = cases.orderBy(F.desc("amount"), "label").limit(1).select(F.lit("concentration").alias("block"), F.lit(0).alias("place"), F.concat(F.lit("case "), "label").alias("label"), "n", "amount")
    row = top.filter("place = 0").select(F.lit("concentration").alias("block"), F.lit(1).alias("place"), F.concat(F.lit("row "), "label").alias("label"), "n", "amount")
    told = kpis(stack, as_of).select(F.lit("kpi").alias("block"), "place", "label", "n", "amount")
    out = reduce(DataFrame.unionByName, [told, fixed, states, top, deep, largest, row])
    # every share is of one total, a single row
    out = out.join(F.broadcast(whole))
    shared = F.when(F.col("block").isin("case", "concentration") & (F.col("_all") != 0), F.col("amount").cast("double") / F.col("_all").cast("double"))
    return out.select("block", F.col("place").cast("int").alias("place"), "label", "n", "amount", shared.alias("share"))


def disagreements(stack: DataFrame, board: DataFrame) -> DataFrame:
    """(check, n): 1 for each way in which a dashboard contradicts its stack or itself."""
    held = _filled("hold")
    facts = stack.agg(F.count("*").alias("rows"), F.count_if(held).alias("held"), F.coalesce(F.sum(F.when(held, F.col("face").cast("double"))), F.lit(0.0)).alias("face_held"), F.coalesce(F.sum(F.col("premium").cast("double")), F.lit(0.0)).alias("premium"))
    kpi = lambda label, c: F.max(F.when((F.col("block") == "kpi") & (F.col("label") == label), F.col(c)))
    block = lambda name, c: F.coalesce(F.sum(F.when(F.col("block") == name, F.col(c))), F.lit(0))
    tops = F.array_sort(F.collect_list(F.when(F.col("block") == "top", F.struct("place", "amount", "label"))))
    drawn = board.agg(
        kpi("leads", "n").alias("k_rows"), kpi("on hold", "n").alias("k_held"), kpi("on hold", "amount").alias("k_face_held"), kpi("premium", "amount").alias("k_premium"), block("band", "n").alias("b_band"), block("book", "n").alias("b_book"), block("proof", "n").alias("b_proof"),
        F.coalesce(F.sum(F.when((F.col("block") == "state") & (F.col("label") != "(all rows)"), F.col("n"))), F.lit(0)).alias("b_state"), tops.alias("tops"),
    )
    both = facts.join(drawn)
    far = lambda a, b: F.abs(F.col(a) - F.col(b)) >= 1
    falls = F.exists(F.sequence(F.lit(2), F.greatest(F.size("tops"), F.lit(2))), lambda i: F.coalesce(F.try_element_at("tops", i)["amount"] > F.try_element_at("tops", i - 1)["amount"], F.lit(False)))
    checks = {
        "leads": F.col("rows") != F.col("k_rows"), "on hold": F.col("held") != F.col("k_held"), "face on hold": far("face_held", "k_face_held"), "premium": far("premium", "k_premium"), "bands do not sum": F.col("b_band") != F.col("rows"),
        "books do not sum": F.col("b_book") != F.col("rows"), "proofs do not sum": F.col("b_proof") != F.col("rows"), "states do not sum": F.col("b_state") != F.col("rows"), "top rows not descending": falls,
        "top row twice": F.size(F.array_distinct(F.transform("tops", lambda t: t["label"]))) < F.size("tops"),
    }
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.coalesce(v, F.lit(True)).cast("long").alias("n")) for k, v in checks.items()])).alias("c")
    return both.select(pairs).select("c.check", "c.n")
