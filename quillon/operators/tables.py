"""Table operators: upsert, supersede, diff, top-n, lookups, zero-filled funnels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: str, refresh: Sequence[str]) -> DataFrame:
    """New rows win on ``refresh`` columns, old rows keep the others."""
    o, n = old.alias("o"), new.alias("n")
    cols = [F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key)]
    for c in old.columns:
        if c != key:
            fresh, kept = F.col(f"n.{c}"), F.col(f"o.{c}")
            there = F.col(f"n.{key}").isNotNull() if c in refresh else F.col(f"o.{key}").isNull()
            cols.append(F.when(there, fresh).otherwise(kept).alias(c))
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(*cols)


def insert_or_ignore(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


def insert_or_replace(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def superseded(versions: DataFrame, key: str, order: str, run: str) -> DataFrame:
    """Each version with the run that superseded it (null: current)."""
    return versions.withColumn("superseded_by", F.lead(run).over(Window.partitionBy(key).orderBy(order, run)))


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int = 1, rank: str = "rank") -> DataFrame:
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(rank) <= k)


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str, new_only: bool = False) -> DataFrame:
    """Old snapshot against new: verdict SAME, CHANGED, NOT_IN_NEW_RUN (NEW_ONLY).

    A null key part equals another null.
    """
    o = old.select(*keys, F.col(value).alias("old_value"), F.lit(True).alias("_o"))
    n = new.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value).alias("new_value"), F.lit(True).alias("_n"))
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_{k}"))
        on = same if on is None else on & same
    joined = o.join(n, on, "full_outer" if new_only else "left")
    verdict = (
        F.when(F.col("_o").isNull(), "NEW_ONLY").when(F.col("_n").isNull(), "NOT_IN_NEW_RUN").when(F.col("old_value").eqNullSafe(F.col("new_value")), "SAME").otherwise("CHANGED")
    )
    named = [F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) if new_only else F.col(k) for k in keys]
    return joined.select(*named, "old_value", "new_value", (F.col("new_value") - F.col("old_value")).alias("delta"), verdict.alias("verdict"))


def with_zero_rows(counts: DataFrame, label: str, labels: Sequence[str], zero: Sequence[str]) -> DataFrame:
    """One row per expected label, zeros where nothing was counted."""
    expected = counts.sparkSession.createDataFrame([(x,) for x in labels], f"{label} string")
    return expected.join(counts, label, "left").fillna(0, list(zero))


def top_and_rest(df: DataFrame, label: str, value: str, k: int) -> DataFrame:
    """Top k labels, OTHERS, NONE (null label) and TOTAL, one row each."""
    order = [F.col(value).desc(), F.col(label).asc()]
    named = df.filter(F.col(label).isNotNull())
    best = named.groupBy(label).agg(F.sum(value).alias(value)).orderBy(*order).limit(k)
    best = best.select(F.col(label).alias("_l"), F.lit(True).alias("_top"))
    tagged = df.join(F.broadcast(best), F.col(label) == F.col("_l"), "left")
    bucket = F.when(F.col(label).isNull(), "NONE").when(F.col("_top"), F.col(label)).otherwise("OTHERS")
    rolled = tagged.rollup(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.sum(value).alias(value))
    return rolled.withColumn("bucket", F.coalesce("bucket", F.lit("TOTAL")))


def concentration(df: DataFrame, group: str, value: str) -> DataFrame:
    """Share of the largest group and of the largest row in the whole."""
    per = df.groupBy(group).agg(F.sum(value).alias("s"), F.max(value).alias("m"))
    whole = F.sum("s").cast("double")
    return per.agg((F.max("s").cast("double") / whole).alias("largest_group"), (F.max("m").cast("double") / whole).alias("largest_row"))


def first_known(ids: DataFrame, key: str, array: str, known: DataFrame, known_id: str) -> DataFrame:
    """For each key the first id of its ordered array that ``known`` has."""
    each = ids.select(key, F.posexplode(array).alias("pos", known_id))
    hit = each.join(known.select(known_id).distinct(), known_id)
    best = hit.groupBy(key).agg(F.min_by(known_id, "pos").alias("found"))
    return ids.select(key).join(best, key, "left")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 7) -> DataFrame:
    """A reproducible sample without replacement: least md5 of seed and key."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def forward_nearest(rows: DataFrame, marks: DataFrame, group: str, at: str, mark: str) -> DataFrame:
    """Each row's first mark at or after it, in its group (null: none).

    Rows and marks are one sorted stream per group; the next mark is carried
    back by a window, so the join makes no pairs.
    """
    r = rows.select("*", F.lit(None).cast(marks.schema[mark].dataType).alias("_m"), F.lit(1).alias("_k"))
    m = marks.select(*[F.lit(None).cast(rows.schema[c].dataType).alias(c) if c not in (group, at) else (F.col(group) if c == group else F.col(mark).cast(rows.schema[at].dataType).alias(at)) for c in rows.columns])
    m = m.withColumn("_m", F.col(at).cast(marks.schema[mark].dataType)).withColumn("_k", F.lit(2))
    w = Window.partitionBy(group).orderBy(F.col(at), F.col("_k")).rowsBetween(0, Window.unboundedFollowing)
    return r.unionByName(m).withColumn(mark, F.first("_m", ignorenulls=True).over(w)).filter("_k = 1").drop("_m", "_k")


def ranked_contacts(contacts: DataFrame, group: str, priority: Column, tie: Sequence[str]) -> DataFrame:
    """Primary and backup contact of each group, by role priority."""
    two = top_per_group(contacts.withColumn("_p", priority), [group], [F.col("_p"), *map(F.col, tie)], 2)
    pick = lambda k: F.max(F.when(F.col("rank") == k, F.struct(*tie)))
    return two.groupBy(group).agg(pick(1).alias("primary"), pick(2).alias("backup"))


def known_left(rows: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """``rows`` left joined with ``more`` by ``key``, rows without one beside the join.

    A null meets nothing, yet a join sends all rows that have it to one task.
    """
    known = rows.filter(F.col(key).isNotNull()).join(more, key, "left")
    return known.unionByName(rows.filter(F.col(key).isNull()), allowMissingColumns=True)
