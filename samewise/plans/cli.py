"""Command line: python -m samewise.plans.cli COMMAND ... (block, match, train, score, tune, decide, validate)."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from samewise.operators import blocking as B
from samewise.operators import evaluation as E
from samewise.operators import model as M
from samewise.operators import validation as V
from samewise.operators.features import not_finite, pair_features
from samewise.operators.records import normalized
from samewise.plans.pipeline import BlockingSettings, ranked_candidates
from samewise.shipping import ship
from samewise.sources import tables as T


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    sub = command("block", "source1", "source2", "source3", "out")
    sub.add_argument("--max-candidates", type=int, default=B.TOP_K)
    sub.add_argument("--limit", type=int)
    sub.add_argument("--sample", type=int, help="only the first N records of source 1, against all of the others")
    sub.add_argument("--resume", action="store_true")
    sub.add_argument("--truth")
    sub = command("match", "source1", "source2", "source3", "candidates", "out")
    sub.add_argument("--threshold", type=float)
    sub.add_argument("--truth", help="tune the threshold on these matches")
    sub = command("train", "source1", "source2", "source3", "candidates", "truth", "model")
    sub.add_argument("--n-estimators", type=int, default=300)
    sub.add_argument("--learning-rate", type=float, default=0.05)
    sub.add_argument("--max-depth", type=int, default=6)
    sub.add_argument("--val-ratio", type=float, default=0.2)
    sub.add_argument("--seed", type=int, default=42)
    sub.add_argument("--limit-pairs", type=int, help="train on the first N candidate pairs only")
    command("score", "source1", "source2", "source3", "candidates", "model", "out")
    sub = command("tune", "scores", "truth", "curve", "best")
    sub.add_argument("--val-ratio", type=float, default=0.2)
    sub.add_argument("--seed", type=int, default=42)
    sub.add_argument("--grid", default="0.05,0.95,0.025")
    sub.add_argument("--plot")
    sub = command("decide", "scores", "candidates", "out")
    sub.add_argument("--best")
    sub.add_argument("--threshold", type=float)
    sub.add_argument("--conservative", action="store_true")
    sub = command("validate", "matching", "source1")
    sub.add_argument("--candidate")
    sub.add_argument("--targets", nargs="*")
    sub.add_argument("--check-ids", action="store_true")
    return top


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    given = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("samewise").getOrCreate()
    ship(spark)

    def records():
        limit = getattr(given, "limit", None)
        others = T.union_sources(T.read_records(spark, given.source2, limit), T.read_records(spark, given.source3, limit))
        return normalized(T.read_records(spark, given.source1, limit)).persist(), normalized(others).persist()

    if given.command == "block":
        s1, others = records()
        if given.sample:
            s1 = s1.orderBy("entity_id").limit(given.sample)
        if given.resume:
            s1 = B.remaining(s1, T.read_candidates(spark, given.out))
        ranked = ranked_candidates(s1, others, BlockingSettings(top_k=given.max_candidates)).persist()
        T.write_tsv(B.candidate_lists(s1, ranked), given.out, "append" if given.resume else "errorifexists")
        B.volume(s1, B.candidates(s1, others), ranked).show()
        if given.truth:
            B.recall(s1, ranked, E.truth_pairs(T.read_ground_truth(spark, given.truth))).show()
    elif given.command in ("match", "train", "score"):
        s1, others = records()
        lists = T.read_candidates(spark, given.candidates)
        pairs, every = B.exploded(lists).select("s1", "cid"), s1.unionByName(others)
        universe = lists.selectExpr("source1_entity_id as s1")
        if given.command == "match":
            scores, threshold = E.rule_scores(pairs, every).persist(), given.threshold
            if threshold is None and given.truth:
                found = E.best_threshold(E.sweep(scores, E.truth_pairs(T.read_ground_truth(spark, given.truth)), universe, E.RULE_GRID)).first()
                threshold = found["threshold"] if found else None
            T.write_tsv(E.final_matches(scores, universe, E.RULE_THRESHOLD if threshold is None else threshold), given.out)
        elif given.command == "train":
            truth = E.truth_pairs(T.read_ground_truth(spark, given.truth))
            if given.limit_pairs:
                pairs = pairs.orderBy("s1", "cid").limit(given.limit_pairs)
            rows = E.split_by_hash(E.labelled(pair_features(pairs, every), truth), given.val_ratio, given.seed).persist()
            if not_finite(rows).first()["not_finite"]:
                raise ValueError("features hold values that are not finite")
            model = M.train(rows.where("not is_val"), M.Settings(given.n_estimators, given.learning_rate, given.max_depth, seed=given.seed))
            if model is None:
                raise ValueError("the labels have a single class")
            held = rows.where("is_val")
            E.report(M.score(model, held), truth, held.select("s1")).show()
            M.importances(spark, model).show()
            M.save(model, given.model)
        else:
            scored = M.score(M.load(given.model), pair_features(pairs, every)).persist()
            check = E.score_verification(pairs, scored).first()
            if check["pairs"] != check["scored"] or check["out_of_range"] or check["repeated"]:
                raise ValueError(f"scores fail verification: {check.asDict()}")
            T.write_scores(scored.selectExpr("s1 as source1_entity_id", "cid as candidate_entity_id", "score as match_probability"), given.out)
    elif given.command == "tune":
        scores = T.read_scores(spark, given.scores).selectExpr("source1_entity_id as s1", "candidate_entity_id as cid", "match_probability as score")
        held = E.split_by_hash(scores.select("s1").distinct(), given.val_ratio, given.seed).where("is_val").select("s1")
        truth = E.truth_pairs(T.read_ground_truth(spark, given.truth))
        curve = E.sweep(scores.join(held, "s1", "left_semi"), truth, held, E.grid(*map(float, given.grid.split(",")))).persist()
        T.write_curve(curve.orderBy("threshold"), given.curve)
        if given.plot:
            T.write_plot(curve, given.plot)
        best = E.best_threshold(curve).first()
        T.write_best(best.asDict() if best else {}, given.best, spark)
    elif given.command == "decide":
        best = T.read_best(spark, given.best) if given.best else None
        scores = T.read_scores(spark, given.scores).selectExpr("source1_entity_id as s1", "candidate_entity_id as cid", "match_probability as score")
        lists = T.read_candidates(spark, given.candidates)
        matches = E.final_matches(scores, lists.selectExpr("source1_entity_id as s1"), E.resolve_threshold(given.threshold, best, given.conservative))
        T.write_tsv(matches, given.out)
        E.decision_counts(matches, scores).show()
        extra = E.subset_violations(matches, lists).first()
        if extra["pairs"]:
            print(f"warning: {extra['entities']} entities have matches outside their candidates", file=sys.stderr)
    else:
        found, code = V.validate(spark, given.matching, given.candidate, given.source1, given.targets, given.check_ids)
        found.show(truncate=False)
        return code
    return 0


if __name__ == "__main__":
    sys.exit(main())
