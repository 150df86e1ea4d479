"""End-to-end plans: blocking, the rule matcher, and the learned matcher."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from samewise.operators import blocking as B
from samewise.operators import evaluation as E
from samewise.operators import model as M
from samewise.operators.features import pair_features
from samewise.operators.records import normalized


@dataclass(frozen=True)
class BlockingSettings:
    caps: dict[str, int] = field(default_factory=lambda: dict(B.CAPS))
    shortlist: int = B.SHORTLIST
    top_k: int = B.TOP_K


def ranked_candidates(s1: DataFrame, others: DataFrame, settings: BlockingSettings = BlockingSettings()) -> DataFrame:
    """s1, cid, score, rank for cleaned records: union of blocks, shortlist, re-ranked top K."""
    short = B.shortlisted(s1, others, settings.caps, settings.shortlist)
    return B.reranked_by_name(short, s1, others, settings.top_k)


def rule_matches(s1: DataFrame, others: DataFrame, threshold: float = E.RULE_THRESHOLD, settings: BlockingSettings = BlockingSettings()) -> DataFrame:
    """Matches of the deterministic rule for every S1 record."""
    pairs = ranked_candidates(s1, others, settings)
    scores = E.rule_scores(pairs, s1.unionByName(others))
    return E.final_matches(scores, s1.selectExpr("entity_id as s1"), threshold)


@dataclass
class Learned:
    model: object
    curve: DataFrame
    best: dict
    scores: DataFrame
    matches: DataFrame


def learned_matches(
    records: tuple[DataFrame, DataFrame], truth: DataFrame, blocking: BlockingSettings = BlockingSettings(), model: M.Settings = M.Settings(),
    val_ratio: float = 0.2, seed: int = 42, universe: str = "paired", conservative: bool = False, threshold: float | None = None,
) -> Learned:
    """Train on the entities that are not held out, tune the threshold on those that are, decide all.

    ``universe`` names the entities that validation covers: ``paired`` those
    with a candidate, ``all`` every S1.
    """
    s1, others = (normalized(r).persist() for r in records)
    pairs = ranked_candidates(s1, others, blocking).select("s1", "cid").persist()
    features = E.split_by_hash(E.labelled(pair_features(pairs, s1.unionByName(others)), truth), val_ratio, seed).persist()
    fitted = M.train(features.where("not is_val"), model)
    scores = M.score(fitted, features).persist()
    ids = pairs.select("s1") if universe == "paired" else s1.selectExpr("entity_id as s1")
    held = E.split_by_hash(ids.distinct(), val_ratio, seed).where("is_val").select("s1")
    truth_held = truth.join(held, "s1", "left_semi")
    curve = E.sweep(scores.join(held, "s1", "left_semi"), truth_held, held).persist()
    best = E.best_threshold(curve).first()
    best = best.asDict() if best else {}
    chosen = E.resolve_threshold(threshold, best, conservative)
    return Learned(fitted, curve, best, scores, E.final_matches(scores, s1.selectExpr("entity_id as s1"), chosen))
