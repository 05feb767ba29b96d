"""Operator 9: mixing sources to target weights.

Tokens are summed per source, targets come from weights capped at a multiple of
the source (capped excess is shared again by weight), and each document is
emitted floor(rate) times plus one Bernoulli copy whose probability is the
fraction.  The draw is a seeded hash of the document's id and text, so reruns
agree.  A document takes its further copy where its draw does not exceed the
source's bar.  For independent draws the bar would be the fraction itself; here
it is the draw at which the words taken so far, in the order of the draws, reach
the fraction of the source's words.  The document that crosses that mark is taken
with the part of it that the mark leaves, drawn by a hash of the source.  So the
expected words are the fraction exactly, a source of one document takes its copy
with the fraction as its chance, and a larger one misses its target by less than
the document at the bar.

Sums per cell of the draws (at most ``CELLS`` a source) find the cell of the bar,
sums per cell of that cell narrow it down, and only the documents of that one, one
in a million of the source's, are sorted.  The shared level of the capped
targets is found by windows over one row per source.

Cases: a null text has size 0; a null source is a source of its own and ranks
last; a source of size 0 has target 0 and rate 0, so its documents take no
words (none are lost, since they have none); a very long text is one document of
its size and may decide the bar; rows of a null doc_id are drawn by their text;
rows that repeat id and text have equal draws and fall on one side of the bar
together; an empty table gives no rows; ``mix`` carries further columns unchanged
(``copy_no`` gets an underscore if the name is taken).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .clusterio import checkpointed, read, shielded, small_side

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
SEED, CELLS = 20240229, 1 << 10
#: Draws are whole multiples of this.
GRAIN = 1.0 / (1 << 53)
#: Copies a source with no words gets in the mix.
EMPTY_SOURCE_COPIES = 1


def token_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    return docs.select("doc_id", "source", token_count(F.col("text")).alias("size"), drawn(seed).alias("draw"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per source: source, source_size, target, rate.

    The shared level L solves sum(min(cap * size, L * weight)) = total.  Sources
    sorted by cap * size / weight saturate in that order, so prefix sums give
    the level at which each would be the first that is not saturated.  The
    windows run over one row per source, after aggregation.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")))
    per = per.withColumn("most", F.lit(cap) * F.col("source_size"))
    whole = Window.partitionBy(F.lit(1))
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(0, Window.unboundedFollowing)
    per = per.withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    # the level of the first source, in filling order, that stays under its cap
    per = per.withColumn("own", F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level")))
    order = F.struct(F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    level = F.min_by("own", F.when(F.col("own").isNotNull(), order)).over(whole)
    target = F.least(F.col("most"), F.coalesce(level * F.col("weight"), F.col("most")))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(float(EMPTY_SOURCE_COPIES)))
    return per.select("source", "source_size", target.alias("target"), F.least(rate, F.lit(cap)).alias("rate"))


def drawn(seed: int) -> Column:
    """A number in [0, 1): 53 bits of a seeded hash of the document."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 11) * F.lit(GRAIN)


def whole(rate: Column) -> Column:
    return F.floor(rate + 1e-12)


def source_plan(sizes: DataFrame) -> DataFrame:
    """source_targets plus the bar of each source, one row per source."""
    same = lambda a, b: a["source"].eqNullSafe(b["_source"])
    keyed = lambda df: df.withColumnRenamed("source", "_source")
    targets = checkpointed(source_targets(sizes))
    wanted = keyed(targets.select("source", ((F.col("rate") - whole(F.col("rate"))) * F.col("source_size")).alias("wanted")))
    rows = sizes.filter("size > 0")
    cell = lambda n: F.floor(F.col("draw") * n)

    def crossed(cells: DataFrame) -> DataFrame:
        """Of each source the cell in which its words reach the wanted number."""
        so_far = Window.partitionBy("_source").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        reached = cells.withColumn("end", F.col("before") + F.sum("words").over(so_far)).filter(F.col("end") >= F.col("wanted"))
        return checkpointed(reached.groupBy("_source").agg(F.min("cell").alias("cell"), F.min_by(F.col("end") - F.col("words"), F.col("cell")).alias("before"), F.first("wanted").alias("wanted")))

    def inside(at: DataFrame, n: int) -> DataFrame:
        own = rows.withColumn("_own", cell(n))
        return own.join(small_side(at), same(own, at) & (own["_own"] == at["cell"])).drop("source")

    first = rows.groupBy("source", cell(CELLS).alias("cell")).agg(F.sum("size").alias("words"))
    at = crossed(first.join(small_side(wanted), same(first, wanted)).withColumn("before", F.lit(0).cast("long")))
    second = inside(at, CELLS).drop("cell").groupBy("_source", "before", "wanted", cell(CELLS * CELLS).alias("cell")).agg(F.sum("size").alias("words"))
    at = crossed(second)
    last = inside(at, CELLS * CELLS).groupBy("_source", "cell", "before", "wanted", "draw").agg(F.sum("size").alias("words"))
    by_draw = Window.partitionBy("_source").orderBy("draw")
    so_far = F.col("before") + F.sum("words").over(by_draw.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    below = F.coalesce(F.lag("draw").over(by_draw), F.col("cell") / (CELLS * CELLS) - GRAIN)
    steps = last.withColumn("end", so_far).withColumn("below", below).filter(F.col("end") >= F.col("wanted"))
    over = steps.groupBy("_source").agg(F.min_by(F.struct("draw", "below", ((F.col("wanted") - F.col("end") + F.col("words")) / F.col("words")).alias("part")), "draw").alias("x"))
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(SEED + 1), F.col("_source")), 11) * F.lit(GRAIN)
    bars = over.select("_source", F.when(chance < F.col("x.part"), F.col("x.draw")).otherwise(F.col("x.below")).alias("bar"))
    return targets.join(bars, same(targets, bars), "left").select("source", "source_size", "target", "rate", F.coalesce("bar", F.lit(1.0)).alias("bar"))


def with_copies(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` (with source and draw) plus source_size, target and n_copies."""
    plan = plan.withColumnRenamed("source", "_source")
    joined = docs.join(small_side(plan), docs["source"].eqNullSafe(plan["_source"]), "left").drop("_source")
    extra = F.when((F.col("rate") > whole(F.col("rate"))) & (F.col("draw") <= F.col("bar")), 1).otherwise(0)
    return joined.withColumn("n_copies", (whole(F.col("rate")) + extra).cast("int")).drop("rate", "bar", "draw")


def mix_plan(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    sizes = checkpointed(sized(docs))
    out = with_copies(sizes, checkpointed(source_plan(sizes)))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"), "n_copies", "source")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, with copy_no."""

    def repeat(plain: DataFrame) -> DataFrame:
        plan = checkpointed(source_plan(checkpointed(sized(plain))))
        out = with_copies(plain.withColumn("draw", drawn(SEED)), plan)
        return out.filter("n_copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))

    return shielded(docs, ("doc_id", "text", "source"), repeat, ("copy_no",))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(read(spark, sf_dir, "documents"))
