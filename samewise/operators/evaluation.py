"""Truth, labels, splits, metrics, threshold sweeps and decisions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samewise.functions import similarity as sim
from samewise.operators.blocking import exploded

BETA, NEAR_BEST, FALLBACK_THRESHOLD, RULE_THRESHOLD = 0.5, 0.001, 0.60, 80.0
PIN_BONUS = 15
#: Thresholds of the reports: probabilities (37), rule scores (26) and the model's report (8).
PROBABILITY_GRID = tuple(round(0.05 + i * 0.025, 4) for i in range(37))
RULE_GRID = tuple(float(x) for x in range(50, 101, 2))
REPORT_GRID = tuple(round(0.2 + i * 0.1, 1) for i in range(8))


def grid(start: float, end: float, step: float) -> tuple[float, ...]:
    """Threshold points from start to end, rounded to four places, so that stored and compared values are the same."""
    return tuple(round(float(x), 4) for x in np.arange(start, end + 1e-9, step))


def truth_pairs(lists: DataFrame) -> DataFrame:
    """Distinct (s1, cid) of a ground-truth table."""
    return exploded(lists, "matched_entity_ids").select("s1", "cid").distinct()


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairs with label 1 if they are true, else 0."""
    marks = truth.select("s1", "cid", F.lit(1).alias("label")).distinct()
    return pairs.join(marks, ["s1", "cid"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def class_balance(pairs: DataFrame) -> DataFrame:
    """Pairs, entities, positives, their share, and entities without a positive."""
    each = pairs.groupBy("s1").agg(F.count("cid").alias("n"), F.sum("label").alias("p"))
    return each.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"), F.count("s1").alias("entities"), F.coalesce(F.sum("p"), F.lit(0)).alias("positives"),
        F.coalesce(F.try_divide(F.sum("p"), F.sum("n")), F.lit(0.0)).alias("positive_rate"), F.coalesce(F.sum(F.when(F.col("p") == 0, 1).otherwise(0)), F.lit(0)).cast("long").alias("singletons"),
    )


def split_by_hash(pairs: DataFrame, ratio: float = 0.2, seed: int = 42) -> DataFrame:
    """is_val for each pair, the same for all pairs of an entity: a hash of its id, so that no id leaves the executors."""
    share = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("s1")).cast("binary")), 1, 8), 16, 10).cast("long") % 1000
    return pairs.withColumn("is_val", share < int(round(ratio * 1000)))


def split_exact(pairs: DataFrame, ratio: float = 0.2, seed: int = 42, most_ids: int = 2_000_000) -> DataFrame:
    """is_val by a seeded shuffle of the sorted ids; ids come to the driver, so it refuses more than ``most_ids``."""
    ids = pairs.select("s1").distinct()
    if ids.limit(most_ids + 1).count() > most_ids:
        raise ValueError("too many entities for the exact split; use split_by_hash")
    order = np.array(sorted(r["s1"] for r in ids.collect()), dtype=object)
    np.random.RandomState(seed).shuffle(order)
    held = order[: int(len(order) * ratio)].tolist()
    marks = pairs.sparkSession.createDataFrame([(x,) for x in held], "s1 string").withColumn("is_val", F.lit(True))
    return pairs.join(marks, "s1", "left").withColumn("is_val", F.coalesce("is_val", F.lit(False)))


def f_beta(p: Column, r: Column, beta: float = BETA) -> Column:
    square = beta * beta
    return F.when((p <= 0) | (r <= 0), 0.0).otherwise((1 + square) * p * r / (square * p + r))


def entity_score(predicted: Column, true: Column, hits: Column) -> Column:
    """F0.5 of one entity from its numbers of predictions, truths and hits; 1 if it has neither."""
    return (
        F.when((predicted == 0) & (true == 0), 1.0).when((predicted == 0) | (true == 0), 0.0).otherwise(f_beta(hits / predicted, hits / true))
    )


def entity_counts(predictions: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """s1, pred_n, true_n and tp of each entity of the universe."""
    p, t = predictions.select("s1", "cid").distinct(), truth.select("s1", "cid").distinct()
    both = p.withColumn("p", F.lit(1)).join(t.withColumn("t", F.lit(1)), ["s1", "cid"], "full")
    each = both.groupBy("s1").agg(F.count("p").alias("pred_n"), F.count("t").alias("true_n"), F.sum(F.when(F.col("p").isNotNull() & F.col("t").isNotNull(), 1).otherwise(0)).alias("tp"))
    return universe.select("s1").distinct().join(each, "s1", "left").fillna(0, ["pred_n", "true_n", "tp"])


def entity_scores(predictions: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    counts = entity_counts(predictions, truth, universe)
    return counts.withColumn("score", entity_score(F.col("pred_n"), F.col("true_n"), F.col("tp")))


def _summary(pred: Column, true: Column, hits: Column) -> list[Column]:
    return [
        F.coalesce(F.avg(entity_score(pred, true, hits)), F.lit(0.0)).alias("macro_f05"), F.coalesce(F.avg(F.when(pred > 0, hits / pred)), F.lit(0.0)).alias("mean_precision"),
        F.coalesce(F.avg(F.when(true > 0, hits / true)), F.lit(0.0)).alias("mean_recall"), F.coalesce(F.sum(hits), F.lit(0)).cast("long").alias("pair_tp"),
        F.coalesce(F.sum(pred - hits), F.lit(0)).cast("long").alias("pair_fp"), F.coalesce(F.sum(true - hits), F.lit(0)).cast("long").alias("pair_fn"),
        F.count(F.lit(1)).alias("entities"),
    ]


def metrics(predictions: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """macro_f05, mean precision and recall, global counts and the number of entities, in one row."""
    return entity_counts(predictions, truth, universe).agg(*_summary(F.col("pred_n"), F.col("true_n"), F.col("tp")))


def sweep(scores: DataFrame, truth: DataFrame, universe: DataFrame, thresholds: tuple[float, ...] = PROBABILITY_GRID, score: str = "score") -> DataFrame:
    """The metrics at each threshold, in one pass over the scores.

    A score falls into the bucket of the highest threshold that it passes; pairs
    are counted by entity and bucket. An entity's few buckets are summed up from
    the top in the task that holds it, and its rows at all thresholds go straight
    into partial sums, one row for each threshold and task.
    """
    points = sorted(thresholds)
    marks = truth.select("s1", "cid", F.lit(1).alias("t")).distinct()
    marked = scores.select("s1", "cid", F.col(score).alias("v")).join(marks, ["s1", "cid"], "left")
    passed = F.lit(0)
    for t in points:
        passed = passed + F.when(F.col("v") >= t, 1).otherwise(0)
    buckets = marked.withColumn("k", passed).where("k > 0").groupBy("s1", "k").agg(F.count(F.lit(1)).alias("n"), F.count("t").alias("h"))
    lists = buckets.groupBy("s1").agg(F.collect_list(F.struct("k", "n", "h")).alias("l"))  # no more entries than thresholds
    totals = marks.groupBy("s1").agg(F.count("cid").alias("true_n"))
    every = universe.select("s1").distinct().join(lists, "s1", "left").join(totals, "s1", "left").fillna(0, ["true_n"])
    rows = every.select("true_n", "l", F.explode(F.sequence(F.lit(1), F.lit(len(points)))).alias("i"))
    above = F.filter(F.coalesce("l", F.array().cast("array<struct<k:int,n:bigint,h:bigint>>")), lambda x: x["k"] >= F.col("i"))
    summed = lambda field: F.aggregate(above, F.lit(0).cast("long"), lambda total, x: total + x[field]).alias(field)
    rows = rows.select("i", "true_n", summed("n"), summed("h"))
    sums = rows.groupBy("i").agg(*_summary(F.col("n"), F.col("true_n"), F.col("h")))
    grid = scores.sparkSession.createDataFrame([(i + 1, t) for i, t in enumerate(points)], "i int, threshold double")
    return grid.join(sums, "i", "left").drop("i").fillna(0)


def best_threshold(curve: DataFrame) -> DataFrame:
    """The lowest threshold with the best macro F0.5, and the highest within NEAR_BEST of it."""
    top = curve.agg(F.max(F.struct("macro_f05", (-F.col("threshold")).alias("t"))).alias("m")).select(F.col("m.macro_f05").alias("best"), (-F.col("m.t")).alias("threshold"))
    near = curve.select(F.col("threshold").alias("t"), "macro_f05").crossJoin(F.broadcast(top)).where(F.col("macro_f05") >= F.col("best") - NEAR_BEST)
    return near.groupBy("threshold", F.col("best").alias("macro_f05")).agg(F.max("t").alias("threshold_conservative"))


def resolve_threshold(manual: float | None = None, best: dict | None = None, conservative: bool = False, fallback: float = FALLBACK_THRESHOLD) -> float:
    """The manual threshold, else the tuned one, else the fallback."""
    if manual is not None:
        return float(manual)
    if best:
        return float(best["threshold_conservative" if conservative and best.get("threshold_conservative") is not None else "threshold"])
    return fallback


def report(scores: DataFrame, truth: DataFrame, universe: DataFrame, thresholds: tuple[float, ...] = REPORT_GRID, score: str = "score") -> DataFrame:
    """Pair precision, recall and F0.5 among the scored pairs, and macro F0.5 over the full truth, at each threshold."""
    pairs = scores.select("s1", "cid", F.col(score).alias("v")).join(universe.select("s1").distinct(), "s1", "left_semi")
    marked = labelled(pairs, truth)
    cells = []
    for t in thresholds:
        tp, pos = F.sum(((F.col("v") >= t) & (F.col("label") == 1)).cast("long")), F.sum((F.col("v") >= t).cast("long"))
        total = F.sum("label")
        p, r = F.coalesce(F.try_divide(tp, pos), F.lit(0.0)), F.coalesce(F.try_divide(tp, total), F.lit(0.0))
        zero = F.lit(0).cast("long")
        cells.append(F.struct(
            F.lit(t).alias("threshold"), p.alias("pair_precision"), r.alias("pair_recall"), f_beta(p, r).alias("pair_f05"), F.coalesce(tp, zero).alias("tp"),
            F.coalesce(pos - tp, zero).alias("fp"), F.coalesce(total - tp, zero).alias("fn"), F.coalesce(pos, zero).alias("pred_pos"),
        ))
    pairwise = marked.agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)]).select(F.inline(F.array(*[f"c{i}" for i in range(len(cells))])))
    return pairwise.join(sweep(scores, truth, universe, thresholds, score).select("threshold", "macro_f05"), "threshold")


def rule_scores(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """s1, cid, score: token-sort similarity of the name cores, more if pins agree; an unknown id is an empty record."""
    side = records.select("entity_id", "name_core", "pin").groupBy("entity_id").agg(F.max(F.struct("name_core", "pin")).alias("r"))
    rows = pairs.select("s1", "cid")
    for key, prefix in (("s1", "a"), ("cid", "b")):
        rows = rows.join(side.select(F.col("entity_id").alias(key), F.col("r.name_core").alias(f"{prefix}_core"), F.col("r.pin").alias(f"{prefix}_pin")), key, "left")
    rows = rows.fillna("", ["a_core", "b_core", "a_pin", "b_pin"])
    bonus = F.when((F.col("a_pin") != "") & (F.col("a_pin") == F.col("b_pin")), PIN_BONUS).otherwise(0)
    return rows.select("s1", "cid", F.least(F.lit(100.0), sim.token_sort_ratio(F.col("a_core"), F.col("b_core")) + bonus).alias("score"))


def final_matches(scores: DataFrame, universe: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """source1_entity_id and its sorted distinct matches joined by commas; empty if it has none."""
    ok = (F.col(score) >= threshold) & (F.col("cid").startswith("S2-") | F.col("cid").startswith("S3-"))
    lists = scores.where(ok).groupBy("s1").agg(F.array_join(F.array_sort(F.collect_set("cid")), ",").alias("matched_entity_ids"))
    ids = universe.select("s1").distinct()
    return ids.join(lists, "s1", "left").select(F.col("s1").alias("source1_entity_id"), F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"))


def decision_counts(matches: DataFrame, scores: DataFrame) -> DataFrame:
    """Entities, those with a match, all matches, and the share of the scored pairs that passed."""
    size = F.when(F.col("matched_entity_ids") == "", 0).otherwise(F.size(F.split("matched_entity_ids", ",")))
    counts = matches.agg(F.count(F.lit(1)).alias("entities"), F.coalesce(F.sum((size > 0).cast("long")), F.lit(0)).alias("matched_entities"), F.coalesce(F.sum(size), F.lit(0)).alias("matches"))
    asked = scores.agg(F.count(F.lit(1)).alias("pairs"))
    return counts.crossJoin(asked).withColumn("pass_rate", F.coalesce(F.try_divide(F.col("matches"), F.col("pairs")), F.lit(0.0)))


def subset_violations(matches: DataFrame, lists: DataFrame) -> DataFrame:
    """The number of S1 with a match that is not among their candidates, and of such matches."""
    matched = exploded(matches, "matched_entity_ids").select("s1", "cid").distinct()
    allowed = exploded(lists).select("s1", "cid")
    return matched.join(allowed, ["s1", "cid"], "left_anti").agg(F.countDistinct("s1").alias("entities"), F.count("cid").alias("pairs"))


def score_verification(pairs: DataFrame, scores: DataFrame, score: str = "score") -> DataFrame:
    """Rows asked for and scored, scores out of range, repeated pairs, and the least, largest and mean score."""
    asked = pairs.agg(F.count(F.lit(1)).alias("pairs"))
    s = F.col(score)
    each = scores.groupBy("s1", "cid").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when((s >= 0) & (s <= 1), 0).otherwise(1)).alias("out"), F.min(s).alias("lo"), F.max(s).alias("hi"), F.sum(s).alias("total"))
    found = each.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("scored"), F.coalesce(F.sum("out"), F.lit(0)).alias("out_of_range"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated"),
        F.min("lo").alias("min_score"), F.max("hi").alias("max_score"), F.try_divide(F.sum("total"), F.sum("n")).alias("mean_score"),
    )
    return asked.crossJoin(found)
