"""The 45 features of a pair of records, in their contractual order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samewise.functions import similarity as sim
from samewise.functions.text import combined
from samewise.operators.records import EMPTY_COUNT, EMPTY_TEXT, latest

#: Names and order of the features.
FEATURES = (
    "name_exact", "name_core_exact", "name_levenshtein", "name_core_levenshtein", "name_jaro_winkler", "name_token_sort_ratio", "name_token_set_ratio",
    "name_partial_ratio", "name_char_ngram_jaccard", "name_token_jaccard", "name_len_diff", "name_len_ratio", "name_tokens_diff", "addr_exact",
    "addr_levenshtein", "addr_jaro_winkler", "addr_token_sort_ratio", "addr_token_set_ratio", "addr_partial_ratio", "addr_char_ngram_jaccard",
    "addr_token_jaccard", "addr_len_diff", "addr_len_ratio", "addr_tokens_diff", "country_match", "has_pin_both", "pin_match", "pin_mismatch",
    "pin_prefix_match", "has_city_both", "city_match", "city_token_overlap", "has_house_both", "house_match", "house_mismatch", "missing_name_s1",
    "missing_name_cand", "missing_addr_s1", "missing_addr_cand", "s1_name_tokens", "cand_name_tokens", "s1_addr_tokens", "cand_addr_tokens",
    "combined_token_sort_ratio", "combined_token_set_ratio",
)
FUZZY = tuple(name for name, *_ in sim.FUZZY)
STRUCTURED = tuple(n for n in FEATURES if n not in FUZZY)


def with_records(pairs: DataFrame, records: DataFrame, dealt: bool = False) -> DataFrame:
    """Pairs with a_* and b_* columns of both records; an unknown id is an empty record. If ``dealt``, all tasks get about as many S1, however few bytes they are."""
    rows = latest(records.select("entity_id", *EMPTY_TEXT, *EMPTY_COUNT))
    for key, prefix in (("cid", "b"), ("s1", "a")):
        if dealt and key == "s1":
            pairs = pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s1")
        side = rows.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{prefix}_{c}") for c in (*EMPTY_TEXT, *EMPTY_COUNT)])
        pairs = pairs.join(side, key, "left").fillna("", [f"{prefix}_{c}" for c in EMPTY_TEXT]).fillna(0, [f"{prefix}_{c}" for c in EMPTY_COUNT])
    return pairs


def _sides(column: str) -> tuple[Column, Column]:
    return F.col(f"a_{column}"), F.col(f"b_{column}")


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def feature_columns(fuzzy: bool = True) -> dict[str, Column]:
    """Each feature of a row of :func:`with_records`; the fuzzy ones are read from the struct ``fuzzy``."""
    out: dict[str, Column] = {}
    for kind, text in (("name", "clean_name"), ("addr", "clean_addr")):
        a, b = _sides(text)
        (la, lb), (ta, tb) = _sides(f"{kind}_len"), _sides("name_tokens" if kind == "name" else "addr_tokens_n")
        out |= {
            f"{kind}_exact": _flag((a != "") & (a == b)), f"{kind}_levenshtein": sim.levenshtein_similarity(a, b), f"{kind}_char_ngram_jaccard": sim.ngram_jaccard(a, b),
            f"{kind}_token_jaccard": sim.token_jaccard(a, b), f"{kind}_len_diff": F.abs(la - lb), f"{kind}_len_ratio": F.least(la, lb) / F.greatest(la, lb, F.lit(1)),
            f"{kind}_tokens_diff": F.abs(ta - tb), f"missing_{kind}_s1": _flag(a == ""), f"missing_{kind}_cand": _flag(b == ""),
            f"s1_{kind}_tokens": ta, f"cand_{kind}_tokens": tb,
        }
    core_a, core_b = _sides("name_core")
    pin_a, pin_b = _sides("pin")
    house_a, house_b = _sides("house_feat")
    city_a, city_b = _sides("city")
    land_a, land_b = _sides("country_norm")
    pins, houses, cities = (pin_a != "") & (pin_b != ""), (house_a != "") & (house_b != ""), (city_a != "") & (city_b != "")
    near = (F.length(pin_a) >= 3) & (F.length(pin_b) >= 3) & (F.substring(pin_a, 1, 3) == F.substring(pin_b, 1, 3))
    out |= {
        "name_core_exact": _flag((core_a != "") & (core_a == core_b)), "name_core_levenshtein": sim.levenshtein_similarity(core_a, core_b),
        "country_match": _flag((land_a != "") & (land_a == land_b)), "has_pin_both": _flag(pins), "pin_match": _flag(pins & (pin_a == pin_b)),
        "pin_mismatch": _flag(pins & (pin_a != pin_b)), "pin_prefix_match": _flag(pins & near), "has_city_both": _flag(cities), "city_match": _flag(cities & (city_a == city_b)),
        "city_token_overlap": sim.token_jaccard(city_a, city_b), "has_house_both": _flag(houses), "house_match": _flag(houses & (house_a == house_b)),
        "house_mismatch": _flag(houses & (house_a != house_b)),
    }
    if fuzzy:
        out |= {n: F.col(f"fuzzy.{n}") for n in FUZZY}
    return {n: out[n].cast("double").alias(n) for n in FEATURES if n in out}


def pair_features(pairs: DataFrame, records: DataFrame, fuzzy: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """s1, cid, the pairs' columns to ``keep`` and the features as 32-bit floats (without ``fuzzy``, the 35 that need no UDF, as doubles)."""
    # the comparisons cost far more than their bytes, by which adaptive execution sizes tasks
    rows = with_records(pairs.select("s1", "cid", *keep), records, dealt=fuzzy)
    if fuzzy:
        names, addresses = _sides("clean_name"), _sides("clean_addr")
        both = (combined(n, a) for n, a in zip(names, addresses, strict=True))
        rows = rows.withColumn("fuzzy", sim.fuzzy_comparisons(*names, *addresses, *both))
    columns = feature_columns(fuzzy)
    return rows.select("s1", "cid", *keep, *[c.cast("float").alias(n) if fuzzy else c for n, c in columns.items()])


def not_finite(features: DataFrame) -> DataFrame:
    """The number of rows with a feature that is null, not a number or infinite."""
    names = [n for n in FEATURES if n in features.columns]
    odd = F.lit(False)
    for n in names:
        odd = odd | F.col(n).isNull() | F.isnan(n) | (F.abs(n) == float("inf"))
    return features.agg(F.count("s1").alias("rows"), F.coalesce(F.sum(odd.cast("long")), F.lit(0)).alias("not_finite"))
