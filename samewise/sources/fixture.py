"""Business records derived from the table ``documents``: three sources and the truth among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _id(doc_id):
    return F.concat(F.lit("S"), (doc_id % 3 + 1).cast("string"), F.lit("-"), F.format_string("%07d", doc_id))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record of each document: its name is the first 40 characters of the text, its address has the third and fourth word; every 11th has no address, every 29th no country."""
    doc = F.col("doc_id")
    flat = F.trim(F.regexp_replace("text", r"\s+", " "))
    rows = documents(spark, sf_dir).select("doc_id", "lang", "n_chars", flat.alias("t")).withColumn("w", F.split("t", " "))
    ending = F.when(doc % 4 == 0, " Pvt. Ltd.").when(doc % 4 == 1, " & Co").otherwise("")
    word = lambda i: F.coalesce(F.try_element_at("w", F.lit(i)), F.lit(""))
    number = (100000 + (F.col("n_chars") * 7919) % 900000).cast("string")
    address = F.concat(F.col("n_chars").cast("string"), F.lit(" "), word(3), F.lit(" Rd., "), word(4), F.lit(", "), number)
    return rows.select(
        _id(doc).alias("entity_id"),
        F.concat(F.substring("t", 1, 40), ending).alias("business_name"),
        F.when(doc % 11 == 0, None).otherwise(address).alias("business_address"),
        F.when(doc % 29 == 0, None).otherwise(F.upper("lang")).alias("country"),
    )


def source(records: DataFrame, number: int) -> DataFrame:
    return records.where(F.col("entity_id").startswith(f"S{number}-"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1, cid) of documents of source 1 and of another with the same text."""
    rows = documents(spark, sf_dir).where(F.col("text").isNotNull()).select(_id(F.col("doc_id")).alias("id"), F.sha2("text", 256).alias("h"))
    one = rows.where(F.col("id").startswith("S1-")).select(F.col("id").alias("s1"), "h")
    other = rows.where(~F.col("id").startswith("S1-")).select(F.col("id").alias("cid"), "h")
    return one.join(other, "h").select("s1", "cid").distinct()
