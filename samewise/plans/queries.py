"""The registered queries over records derived from ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samewise.functions import similarity as sim
from samewise.functions import text as t
from samewise.operators import blocking as B
from samewise.operators import evaluation as E
from samewise.operators import features as FT
from samewise.operators import model as M
from samewise.operators import validation as V
from samewise.operators.records import normalized
from samewise.plans.pipeline import ranked_candidates
from samewise.shipping import ship
from samewise.sources import fixture
from samewise.sources.tables import only_needed, read_candidates, read_records, read_scores, removed, scratch, stored, union_sources, write_scores, write_tsv

Query = Callable[[SparkSession, str], DataFrame]
LOW_CAPS = {**B.CAPS, "name_key": 10}
MATCH_AT, TREES = 80.0, 20


class Frames:
    """The frames that a query shares among its steps, made when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ship(spark)
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = fixture.entities(spark, sf_dir)
        self.all = normalized(self.raw)
        self.all.unpersist()  # what an earlier query kept: each query stands for itself

    def cleaned(self, *numbers: int) -> DataFrame:
        """Cleaned records of some sources, kept: blocking, ranking and features all read them."""
        kept = self.all.persist()
        return kept.where(F.substring("entity_id", 2, 1).isin(*[str(n) for n in numbers]))

    @property
    def s1(self) -> DataFrame:
        return self.cleaned(1)

    @property
    def others(self) -> DataFrame:
        return self.cleaned(2, 3)

    @property
    def truth(self) -> DataFrame:
        return fixture.truth(self.spark, self.sf_dir)

    @property
    def universe(self) -> DataFrame:
        return fixture.source(self.raw, 1).selectExpr("entity_id as s1")

    def candidates(self, kinds: tuple[str, ...] | None = None, caps: dict[str, int] = B.CAPS) -> DataFrame:
        return B.candidates(self.s1, self.others, caps, kinds)

    def ranked(self) -> DataFrame:
        return ranked_candidates(self.s1, self.others)

    def metadata(self) -> DataFrame:
        return B.with_metadata(self.candidates(), self.s1, self.others)

    def keyed_pairs(self) -> DataFrame:
        """Pairs of the same name key with both sides' names and addresses."""
        return FT.with_records(self.candidates(("name_key",)), self.all)

    def scores(self) -> DataFrame:
        """The rule's scores of all candidates as shares of one, in steps of a millionth."""
        return self.rules().select("s1", "cid", (F.floor(F.col("score") * 10_000) / 1_000_000).alias("score"))

    def rules(self) -> DataFrame:
        return E.rule_scores(self.ranked(), self.all)

    def features(self) -> DataFrame:
        return FT.pair_features(self.ranked(), self.all)


def _kind(kind: str, caps: dict[str, int] = B.CAPS) -> Callable[[Frames], DataFrame]:
    return lambda f: f.candidates((kind,), caps)


def _sim(function, *columns: str) -> Callable[[Frames], DataFrame]:
    def make(f: Frames) -> DataFrame:
        out = f.keyed_pairs()
        return out.select("s1", "cid", *[F.round(function(F.col(f"a_{c}"), F.col(f"b_{c}")), 6).alias(f"{c}_sim") for c in columns])

    return make


def _lists(f: Frames) -> DataFrame:
    return f.candidates(("name_key",)).groupBy("s1").agg(F.array_join(F.array_sort(F.collect_set("cid")), ",").alias("ids"))


def _resume(f: Frames) -> DataFrame:
    finished = f.truth.selectExpr("s1 as source1_entity_id").distinct()
    return B.remaining(f.s1, finished).select("entity_id", "clean_name")


def bad_lines(f: Frames) -> DataFrame:
    """A submission with one fault of each kind, made of the sources' ids."""
    n = F.substring("entity_id", 4, 7).cast("long")
    mate = F.concat(F.lit("S2-"), F.lpad((n + 1).cast("string"), 7, "0"))
    ids = (
        F.when(n % 30 == 0, F.concat(mate, F.lit(","), mate)).when(n % 30 == 3, F.col("entity_id")).when(n % 30 == 6, F.lit("X-1")).when(n % 30 == 9, F.concat(mate, F.lit(",")))
        .when(n % 30 == 12, F.lit("S3-9999999")).when(n % 30 == 15, F.lit("")).otherwise(mate)
    )
    line = F.when(n % 30 == 18, F.col("entity_id")).when(n % 30 == 21, F.concat(F.lit("S1-8"), F.substring("entity_id", 5, 6), F.lit("\t"))).otherwise(F.concat("entity_id", F.lit("\t"), ids))
    rows = fixture.source(f.raw, 1).select((n + 2).alias("line_no"), line.alias("line"))
    again = fixture.source(f.raw, 1).where(n % 30 == 24).select((n + 10_000_000).alias("line_no"), line.alias("line"))
    return rows.unionByName(again)


def _findings(f: Frames) -> DataFrame:
    others = f.raw.where(~F.col("entity_id").startswith("S1-")).select("entity_id")
    found = V.line_findings(bad_lines(f), f.universe, others)
    return found.select("rule", "level", "n", F.array_join("examples", ";").alias("examples"))


def _not_candidate(f: Frames) -> DataFrame:
    listed = f.universe.select((F.substring("s1", 4, 7).cast("long") + 2).alias("line_no"), F.concat("s1", F.lit("\tS3-9999999")).alias("line"))
    found = V.not_in_candidates(bad_lines(f), listed)
    return found.select("rule", "level", "n", F.array_join("examples", ";").alias("examples"))


def _through_tsv(f: Frames) -> DataFrame:
    """Records written as TSV with their columns in another order, and read back by header."""
    path = scratch(f.spark, "records")
    write_tsv(f.raw.select("country", "entity_id", "business_address", "business_name"), path)
    return read_records(f.spark, path)


def _through_scores(f: Frames) -> DataFrame:
    path = scratch(f.spark, "scores")
    write_scores(f.scores().selectExpr("s1 as source1_entity_id", "cid as candidate_entity_id", "score as match_probability"), path)
    return read_scores(f.spark, path)


def _through_lists(f: Frames) -> DataFrame:
    path = scratch(f.spark, "lists")
    write_tsv(B.candidate_lists(f.universe.selectExpr("s1 as entity_id"), f.ranked()), path)
    return B.exploded(read_candidates(f.spark, path))


def _learned(f: Frames) -> DataFrame:
    """Train on most entities, tune on the others, decide all: the learned flow from end to end."""
    rows, model = _gbt(f)
    scores = stored(M.score(model, rows), "scores")  # tuning and deciding both read them
    removed(rows)
    held = E.split_by_hash(f.universe).where("is_val").select("s1")
    curve = stored(E.sweep(scores.join(held, "s1", "left_semi"), f.truth.join(held, "s1", "left_semi"), held), "curve")
    best = E.best_threshold(curve).first()
    return E.final_matches(scores, f.universe, E.resolve_threshold(None, best.asDict() if best else None))


def _gbt(f: Frames):
    """Labelled features, computed once for training and scoring, and the model; labels join the ids, before the features.

    No key is capped here. Each step is written, so that the disk holds one step's shuffle files at a time.
    """
    short = B.shortlisted_of_all(f.s1, f.others)
    ranked = stored(B.reranked_by_name(short, f.s1, f.others).select("s1", "cid"), "ranked")
    removed(short)
    rows = stored(FT.pair_features(E.split_by_hash(E.labelled(ranked, f.truth)), f.all, keep=("label", "is_val")), "features")
    removed(ranked)
    f.all.unpersist()  # training needs the memory, and would push it to disk
    return rows, M.train(rows.where("not is_val"), M.Settings(trees=TREES))


def _gbt_scores(f: Frames) -> DataFrame:
    rows, model = _gbt(f)
    return M.score(model, rows)


def _curve(f: Frames) -> DataFrame:
    return E.sweep(f.scores(), f.truth, f.universe)


def _rounded(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, 6) for c in columns})


_CURVE = ("macro_f05", "mean_precision", "mean_recall")
_PREDICTED = 0.5


def _predicted(f: Frames) -> DataFrame:
    return f.scores().where(F.col("score") >= _PREDICTED)


PLANS: dict[str, Callable[[Frames], DataFrame]] = {
    "clean_name": lambda f: f.all.select("entity_id", "clean_name"),
    "clean_address": lambda f: f.all.select("entity_id", "clean_addr"),
    "name_core": lambda f: f.all.select("entity_id", "name_core"),
    "pin_house_city": lambda f: f.all.select("entity_id", "pin", "house_no", "house_feat", "city", "country_norm", "name_len", "addr_len", "name_tokens", "addr_tokens_n", t.combined(F.col("clean_name"), F.col("clean_addr")).alias("combined")),
    "name_key": lambda f: f.all.select("entity_id", "name_key"),
    "sig_tokens": lambda f: f.all.select("entity_id", F.array_join("sig_tokens", "|").alias("tokens")),
    "addr_tokens": lambda f: f.all.select("entity_id", F.array_join("addr_tokens", "|").alias("tokens")),
    "union_sources": lambda f: union_sources(fixture.source(f.raw, 2), fixture.source(f.raw, 3)),
    "semi_needed": lambda f: only_needed(f.raw, f.truth.selectExpr("cid as entity_id")),
    "anti_resume": _resume,
    "collect_ids": _lists,
    "explode_ids": lambda f: B.exploded(_lists(f), "ids", "s1"),
    "block_name_key": _kind("name_key"),
    "block_name_key_low_cap": _kind("name_key", LOW_CAPS),
    "block_pin": _kind("pin"),
    "block_token": _kind("token"),
    "block_house_street": _kind("house_street"),
    "block_pin_house": _kind("pin_house"),
    "block_addr_token": _kind("addr_token"),
    "candidates_union": lambda f: f.candidates(),
    "candidates_with_empty": lambda f: f.universe.join(f.candidates().groupBy("s1").agg(F.count("cid").alias("n")), "s1", "left").fillna(0),
    "shortlist": lambda f: B.shortlist(f.metadata()).select("s1", "cid", "shortlist_score"),
    "rerank_topk": lambda f: _rounded(f.ranked(), "score"),
    "candidate_lists": lambda f: B.candidate_lists(f.s1, f.ranked()),
    "blocking_recall": lambda f: _rounded(B.recall(f.s1, f.candidates(), f.truth), "avg_candidates", "recall"),
    "blocking_volume": lambda f: _rounded(B.volume(f.universe.selectExpr("s1 as entity_id"), f.candidates(), f.ranked()), "avg_raw", "avg_final"),
    "sim_levenshtein": _sim(sim.levenshtein_similarity, "clean_name", "clean_addr"),
    "sim_ngram_jaccard": _sim(sim.ngram_jaccard, "clean_name", "clean_addr"),
    "sim_token_jaccard": _sim(sim.token_jaccard, "clean_name", "clean_addr"),
    "sim_jaro_winkler": _sim(sim.jaro_winkler, "clean_name", "clean_addr"),
    "sim_token_sort": _sim(sim.token_sort_ratio, "name_core"),
    "sim_token_set": _sim(sim.token_set_ratio, "name_core"),
    "sim_partial": _sim(sim.partial_ratio, "clean_name"),
    "pair_features_structured": lambda f: _rounded(FT.pair_features(f.candidates(("name_key",)), f.all, fuzzy=False), *[c for c in FT.STRUCTURED]),
    "pair_features_text": lambda f: f.features(),
    "features_finite": lambda f: FT.not_finite(f.features()),
    "labels": lambda f: E.labelled(f.candidates(), f.truth),
    "split_hash": lambda f: E.split_by_hash(f.universe),
    "split_exact": lambda f: E.split_exact(f.universe),
    "class_balance": lambda f: _rounded(E.class_balance(E.labelled(f.candidates(), f.truth)), "positive_rate"),
    "entity_scores": lambda f: _rounded(E.entity_scores(_predicted(f), f.truth, f.universe), "score"),
    "macro_f05": lambda f: _rounded(E.metrics(_predicted(f), f.truth, f.universe), *_CURVE),
    "evaluation_report": lambda f: _rounded(E.report(f.scores(), f.truth, f.universe), "pair_precision", "pair_recall", "pair_f05", "macro_f05"),
    "rule_scores": lambda f: _rounded(f.rules(), "score"),
    "rule_sweep": lambda f: _rounded(E.sweep(f.rules(), f.truth, f.universe, E.RULE_GRID), *_CURVE),
    "rule_best": lambda f: _rounded(E.best_threshold(E.sweep(f.rules(), f.truth, f.universe, E.RULE_GRID)), "macro_f05"),
    "rule_matches": lambda f: E.final_matches(f.rules(), f.universe, MATCH_AT),
    "threshold_sweep": lambda f: _rounded(_curve(f), *_CURVE),
    "threshold_conservative": lambda f: _rounded(E.best_threshold(_curve(f)), "macro_f05"),
    "final_matches": lambda f: E.final_matches(f.scores(), f.universe, _PREDICTED),
    "decision_counts": lambda f: _rounded(E.decision_counts(E.final_matches(f.scores(), f.universe, _PREDICTED), f.scores()), "pass_rate"),
    "subset_violations": lambda f: E.subset_violations(E.final_matches(f.scores(), f.universe, _PREDICTED), B.candidate_lists(f.universe.selectExpr("s1 as entity_id"), f.ranked().where("rank <= 5"))),
    "score_verification": lambda f: _rounded(E.score_verification(f.ranked(), f.scores()), "min_score", "max_score", "mean_score"),
    "validator_findings": _findings,
    "validator_subset": _not_candidate,
    "validator_counts": lambda f: V.row_counts(bad_lines(f)),
    "gbt_scores": _gbt_scores,
    "learned_matches": _learned,
    "tsv_records": _through_tsv,
    "tsv_scores": _through_scores,
    "tsv_candidates": _through_lists,
    "feature_importance": lambda f: M.importances(f.spark, _gbt(f)[1]),
}


def queries() -> dict[str, Query]:
    return {name: lambda spark, sf_dir, plan=plan: plan(Frames(spark, sf_dir)) for name, plan in PLANS.items()}
