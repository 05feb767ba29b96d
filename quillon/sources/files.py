"""File readers: CSV, JSON lines, markdown tables, lists, documents, registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ids import digits
from ..functions.money import parse_brl


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def json_lines(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """One record per line; the last line of a key wins."""
    rows = spark.read.schema(schema).json(path).select("*", F.monotonically_increasing_id().alias("_at"))
    rest = [c for c in rows.columns if c not in (key, "_at")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "_at").alias("_r")).select(key, "_r.*")


def text_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither blank nor a # comment."""
    line = F.trim("value")
    return spark.read.text(path).select(line.alias("value")).filter((F.col("value") != "") & ~F.col("value").startswith("#"))


def markdown_rows(lines: DataFrame) -> DataFrame:
    """Claims of pipe tables (columns pos, value): first row of each (id, case)."""
    row = lines.filter(F.col("value").startswith("|") & ~F.col("value").rlike(r"^\|[\s:|-]+\|?$"))
    company = digits(F.regexp_extract("value", r"([0-9]{2}\.?[0-9]{3}\.?[0-9]{3}/?[0-9]{4}-?[0-9]{2})", 1))
    out = row.select(
        "pos",
        F.trim(F.element_at(F.split("value", r"\|"), 2)).alias("creditor_name"),
        company.alias("company"),
        F.regexp_extract("value", r"([0-9]{7}-[0-9]{2}\.[0-9]{4}\.[0-9]\.[0-9]{2}\.[0-9]{4})", 1).alias("case_number"),
        parse_brl(F.regexp_extract("value", r"R\$\s*([0-9.]+,[0-9]{2})", 1)).alias("amount"),
        F.regexp_extract("value", r"(https?://[^\s|)]+)", 1).alias("url"),
    ).filter(F.length("company") == 14)
    w = Window.partitionBy("company", "case_number").orderBy("pos")
    return out.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "pos")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Raw files with their content hash (a PDF decoder is a separate step)."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha1("content").alias("sha1"), F.col("length").alias("size"), "content")


def has_text_layer(page_texts):
    """First three pages hold over 80 characters."""
    return F.aggregate(F.slice(F.coalesce(page_texts, F.array().cast("array<string>")), 1, 3), F.lit(0), lambda n, t: n + F.length(F.coalesce(t, F.lit("")))) > 80


def ocr_words(tsv: DataFrame, scale: float = 72 / 300) -> DataFrame:
    """Word rows of a recogniser's table: level 5, confidence from 30, in points."""
    kept = tsv.filter((F.col("level") == 5) & (F.col("conf") >= 30) & (F.trim("text") != ""))
    return kept.select(
        "doc_id", "page", "text", (F.col("left") * scale).alias("x0"), ((F.col("left") + F.col("width")) * scale).alias("x1"), (F.col("top") * scale).alias("top"), ((F.col("top") + F.col("height")) * scale).alias("bottom"), "conf"
    )


REGISTRY = (
    "cnpj string, razao_social string, nome_fantasia string, natureza_juridica string, porte string, situacao_cadastral string, descricao_situacao string, "
    "cnae_principal string, uf string, municipio string, capital_social string, qsa array<struct<nome:string,qual_code:int,qual:string>>"
)
DECISION_CODES, FALLBACK_CODE = (49, 5, 10, 16), 22


def lookup(wanted: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found with status, ids to fetch): hits and known misses are not asked again."""
    ids = wanted.select(digits(F.col("cnpj")).alias("cnpj")).filter(F.length("cnpj") == 14).distinct()
    return ids.join(cache, "cnpj"), ids.join(cache.select("cnpj"), "cnpj", "left_anti")


def registry_records(cache: DataFrame) -> DataFrame:
    """Normalised registry rows of cached JSON (cnpj, status, json)."""
    r = cache.filter("status = 200").select(F.from_json("json", REGISTRY).alias("r")).select("r.*")
    partners = F.filter("qsa", lambda p: p["qual_code"].isin(*DECISION_CODES))
    spare = F.slice(F.filter("qsa", lambda p: p["qual_code"] == FALLBACK_CODE), 1, 1)
    return r.select(
        F.substring(digits(F.col("cnpj")), 1, 8).alias("root"),
        "razao_social",
        "nome_fantasia",
        "natureza_juridica",
        "porte",
        F.lpad("situacao_cadastral", 2, "0").alias("situacao"),
        "cnae_principal",
        "uf",
        "municipio",
        F.col("capital_social").try_cast("decimal(18,2)").alias("capital_social"),
        F.when(F.size(partners) > 0, partners).otherwise(spare).alias("decision_makers"),
    )
