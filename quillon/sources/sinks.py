"""Sinks: ordered CSV exports, run partitions, state dumps, markdown reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def export_csv(df: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    """Fixed columns in a fixed order; arrays are joined by | at the sink."""
    joined = [F.array_join(c, "|").alias(c) if df.schema[c].dataType.typeName() == "array" else F.col(c) for c in columns]
    df.select(*joined, *[F.col(o).alias(f"_{o}") for o in order if o not in columns]).orderBy(*[o if o in columns else f"_{o}" for o in order]).select(*columns).write.mode("overwrite").csv(path, header=True)


def overwrite_run(df: DataFrame, path: str) -> None:
    """Replaces only the run_id partitions that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def kept_after_reingest(documents: DataFrame, statuses: list[str], before: str | None = None) -> DataFrame:
    """Documents that a selective re-ingest leaves alone."""
    again = F.col("status").isin(*statuses)
    if before is not None:
        again = again | (F.col("extracted_at") < F.lit(before).cast("timestamp"))
    return documents.filter(~F.coalesce(again, F.lit(False)))


def dump_state(spark: SparkSession, tables: dict[str, str], path: str) -> list[str]:
    """Writes the tables that exist, each ordered by its key."""
    done = []
    for name, key in tables.items():
        if spark.catalog.tableExists(name):
            spark.table(name).orderBy(key).write.mode("overwrite").csv(f"{path}/{name}", header=True)
            done.append(name)
    return done


def markdown(parts: dict[str, DataFrame], limit: int = 100) -> str:
    """A report of small aggregates: a title and a table for each.

    The driver holds at most ``limit`` rows of a part; a longer one says how many
    rows it leaves out.
    """
    out = []
    for title, df in parts.items():
        rows = df.limit(limit + 1).collect()
        out += [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows[:limit]]
        out += ["", f"({df.count() - limit} more rows)"] if len(rows) > limit else []
        out.append("")
    return "\n".join(out)
