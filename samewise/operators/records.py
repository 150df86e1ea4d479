"""Cleaned records: every derived column that later operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.functions import text as t

EMPTY_TEXT = ("clean_name", "name_core", "clean_addr", "country_norm", "pin", "city", "house_feat")
EMPTY_COUNT = ("name_tokens", "addr_tokens_n", "name_len", "addr_len")


def normalized(records: DataFrame, tail: bool = True) -> DataFrame:
    """entity_id and country as they are, and all cleaned and derived columns."""
    rows = records.select(
        "entity_id", "country", t.clean_name(F.col("business_name"), tail).alias("clean_name"), t.clean_address(F.col("business_address"), tail).alias("clean_addr")
    )
    rows = rows.withColumn("name_core", t.name_core(F.col("clean_name")))
    name, core, address = F.col("clean_name"), F.col("name_core"), F.col("clean_addr")
    return rows.withColumns({
        "country_norm": t.country_norm(F.col("country")), "name_key": t.name_key(core), "pin": t.pin(address), "city": t.city(address),
        "house_feat": t.house_no(address), "house_no": t.house_no(address, blocking=True), "sig_tokens": t.sig_tokens(core), "addr_tokens": t.addr_tokens(address),
        "name_tokens": t.token_count(name).cast("long"), "addr_tokens_n": t.token_count(address).cast("long"),
        "name_len": F.length(name).cast("long"), "addr_len": F.length(address).cast("long"),
    })


def latest(records: DataFrame) -> DataFrame:
    """One row for each entity_id; of several, the one whose columns sort last."""
    rest = [c for c in records.columns if c != "entity_id"]
    return records.groupBy("entity_id").agg(F.max(F.struct(*rest)).alias("r")).select("entity_id", "r.*")
