"""Operators on small frames, invariants of whole plans, sources and sinks."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from samewise.operators import blocking as B
from samewise.operators import evaluation as E
from samewise.operators import model as M
from samewise.operators import validation as V
from samewise.operators.features import FEATURES, not_finite, pair_features
from samewise.operators.records import latest, normalized
from samewise.plans import cli, queries
from samewise.plans.pipeline import BlockingSettings, learned_matches, ranked_candidates, rule_matches
from samewise.sources import tables as T
from samewise.streaming.incremental import block_stream, store_index

SCHEMA = "entity_id string, business_name string, business_address string, country string"
S1 = [("S1-1", "Acme Foods Pvt Ltd", "12 Rose Rd, Pune, 411001", "IN"), ("S1-2", "Zeta Corp", None, None), ("S1-3", "Lonely Trader", "1 Far St, Nowhere", "FR")]
OTHERS = [("S2-1", "Acme Foods Private Limited", "12 Rose Road, Pune 411001", "IN"), ("S2-2", "Acme Food", "99 Lily Road, Delhi 110001", "IN"), ("S3-1", "Zeta Corporation", "5 Elm St", None), ("S3-2", "Zeta Corporation", "5 Elm St", "US")]


@pytest.fixture(scope="module")
def sides(spark):
    return normalized(spark.createDataFrame(S1, SCHEMA)), normalized(spark.createDataFrame(OTHERS, SCHEMA))


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_blocking_is_null_safe_on_country(sides):
    pairs = rows(B.candidates(*sides))
    assert ("S1-2", "S3-1") in pairs and ("S1-2", "S3-2") not in pairs
    assert ("S1-1", "S2-1") in pairs and not [p for p in pairs if p[0] == "S1-3"]


def test_caps_keep_the_first_ids(spark, sides):
    many = normalized(spark.createDataFrame([(f"S2-{i:03d}", "Acme Foods", None, "IN") for i in range(40)], SCHEMA))
    pairs = B.candidates(sides[0], many, {**B.CAPS, "name_key": 7}, ("name_key",))
    assert [p[1] for p in rows(pairs)] == [f"S2-{i:03d}" for i in range(7)]


def test_group_limit_is_planned(sides):
    plan = B.capped_index(B.blocking_keys(sides[1]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_top_k_and_empty_lists(sides):
    ranked = ranked_candidates(*sides)
    lists = dict(rows(B.candidate_lists(sides[0], ranked)))
    assert lists["S1-3"] == "" and lists["S1-1"].split(",")[0] == "S2-1" and set(lists) == {"S1-1", "S1-2", "S1-3"}
    best = ranked.where("cid = 'S2-1'").first()
    assert best["score"] == 100
    assert rows(B.exploded(B.candidate_lists(sides[0], ranked)).select("s1", "cid")) == rows(ranked.select("s1", "cid"))


def test_recall_without_truth_is_one(spark, sides):
    none = spark.createDataFrame([], "s1 string, cid string")
    assert B.recall(sides[0], B.candidates(*sides), none).first()["recall"] == 1


def test_features(sides):
    every = sides[0].unionByName(sides[1])
    pairs = sides[0].sparkSession.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S9-9")], "s1 string, cid string")
    out = pair_features(pairs, every)
    assert out.columns == ["s1", "cid", *FEATURES] and len(FEATURES) == 45
    assert tuple(not_finite(out).first()) == (2, 0)
    known, unknown = out.orderBy("cid").collect()
    assert known["pin_match"] == 1 and known["house_match"] == 1 and known["name_exact"] == 1
    assert unknown["missing_name_cand"] == 1 and unknown["name_len_ratio"] == 0 and unknown["has_pin_both"] == 0


def pairs_of(spark, *items):
    return spark.createDataFrame([tuple(x.split(":")) for x in items] or [], "s1 string, cid string")


def test_metrics(spark):
    universe = spark.createDataFrame([(x,) for x in "abcd"], "s1 string")
    predicted, truth = pairs_of(spark, "b:x", "c:x", "c:y"), pairs_of(spark, "c:x", "d:x")
    assert {r["s1"]: round(r["score"], 6) for r in E.entity_scores(predicted, truth, universe).collect()} == {"a": 1, "b": 0, "c": 0.555556, "d": 0}
    found = E.metrics(predicted, truth, universe).first()
    assert round(found["macro_f05"], 6) == 0.388889 and (found["pair_tp"], found["pair_fp"], found["pair_fn"], found["entities"]) == (1, 2, 1, 4)


def test_sweep_agrees_with_single_thresholds(spark):
    scores = spark.createDataFrame([("a", "x", 0.3), ("a", "y", 0.7), ("b", "x", 0.5), ("c", "x", 0.075)], "s1 string, cid string, score double")
    universe, truth = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "s1 string"), pairs_of(spark, "a:y", "b:z", "c:x")
    for row in E.sweep(scores, truth, universe).collect():
        at = E.metrics(scores.where(F.col("score") >= row["threshold"]), truth, universe).first()
        assert row["macro_f05"] == pytest.approx(at["macro_f05"]) and row["pair_fp"] == at["pair_fp"]
    assert len(E.PROBABILITY_GRID) == 37 and 0.075 in E.PROBABILITY_GRID and len(E.RULE_GRID) == 26
    assert E.grid(0.05, 0.95, 0.025) == E.PROBABILITY_GRID


def test_ties_go_to_the_lowest_threshold(spark):
    curve = spark.createDataFrame([(0.1, 0.5), (0.2, 0.8), (0.3, 0.8), (0.4, 0.7995), (0.5, 0.7)], "threshold double, macro_f05 double")
    found = E.best_threshold(curve).first()
    assert (found["threshold"], found["threshold_conservative"]) == (0.2, 0.4)
    assert E.resolve_threshold() == 0.6 and E.resolve_threshold(0.3, found.asDict()) == 0.3 and E.resolve_threshold(None, found.asDict(), True) == 0.4


def test_splits_are_disjoint_and_by_entity(spark):
    pairs = pairs_of(spark, *[f"S1-{i}:c{j}" for i in range(200) for j in range(2)])
    for split in (E.split_by_hash(pairs), E.split_exact(pairs)):
        each = split.groupBy("s1").agg(F.countDistinct("is_val").alias("n"), F.max("is_val").alias("v")).collect()
        assert all(r["n"] == 1 for r in each) and 20 <= sum(r["v"] for r in each) <= 60
    with pytest.raises(ValueError):
        E.split_exact(pairs, most_ids=10)


def test_final_matches_and_subset(spark):
    scores = spark.createDataFrame([("a", "S3-2", 0.9), ("a", "S2-1", 0.9), ("a", "S1-7", 1.0), ("b", "S2-1", 0.1)], "s1 string, cid string, score double")
    universe = spark.createDataFrame([("a",), ("b",), ("c",)], "s1 string")
    out = E.final_matches(scores, universe, 0.9)
    assert rows(out) == [("a", "S2-1,S3-2"), ("b", ""), ("c", "")]
    lists = spark.createDataFrame([("a", "S2-1")], "source1_entity_id string, candidate_entity_ids string")
    assert tuple(E.subset_violations(out, lists).first()) == (1, 1)


def test_rule_matches(sides):
    assert dict(rows(rule_matches(*sides)))["S1-1"] == "S2-1,S2-2"


def test_learned_matches(spark):
    left = [(f"S1-{i}", f"brand{i % 37} shop{i}", f"{i} elm road, town, {100000 + i}", "X") for i in range(120)]
    right = [(f"S2-{i}", f"brand{i % 37} shop{i}" if i % 2 else f"brand{i % 37} store{i}", f"{i if i % 2 else i + 500} elm road, town, {100000 + i}", "X") for i in range(120)]
    truth = pairs_of(spark, *[f"S1-{i}:S2-{i}" for i in range(1, 120, 2)])
    found = learned_matches((spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)), truth, model=M.Settings(trees=5))
    assert found.matches.count() == 120 and found.best["macro_f05"] > 0.9
    check = E.score_verification(found.scores, found.scores).first()
    assert check["pairs"] == check["scored"] and check["out_of_range"] == 0 and check["repeated"] == 0


def test_model_with_one_class_is_none(spark, sides):
    pairs = ranked_candidates(*sides)
    features = pair_features(pairs, sides[0].unionByName(sides[1])).withColumn("label", F.lit(0))
    assert M.train(features) is None
    assert {r["score"] for r in M.score(None, features).collect()} == {0.0}


def write(path, text):
    path.write_text(text)
    return str(path)


def test_validator(spark, tmp_path):
    source = write(tmp_path / "s1.tsv", "entity_id\tname\nS1-1\tx\nS1-2\ty\nS1-3\tz\n\n")
    targets = [write(tmp_path / f"s{n}.tsv", f"entity_id\tname\nS{n}-1\tx\n") for n in (2, 3)]
    head = "source1_entity_id\tmatched_entity_ids\n"

    def rules(text, candidate=None, **options):
        found, code = V.validate(spark, write(tmp_path / "m.tsv", text), candidate, source, targets, options.get("check_ids", True))
        return {r["rule"] for r in found.collect() if r["level"] == "error"}, code

    assert rules(head + "S1-1\tS2-1\nS1-2\t\nS1-3\tS2-1,S3-1\n") == (set(), 0)
    cases = {
        "comma_separated": "source1_entity_id,matched_entity_ids\nS1-1,S2-1\n", "wrong_header": "a\tb\nS1-1\t\n", "empty_file": "",
        "malformed_row": head + "S1-1\nS1-1\t\nS1-2\t\nS1-3\t\n", "duplicate_s1": head + "S1-1\t\nS1-1\t\nS1-2\t\nS1-3\t\n", "repeated_id": head + "S1-1\tS2-1,S2-1\nS1-2\t\nS1-3\t\n",
        "self_match": head + "S1-1\tS1-2\nS1-2\t\nS1-3\t\n", "wrong_prefix": head + "S1-1\tS2-1,\nS1-2\t\nS1-3\t\n", "unknown_id": head + "S1-1\tS2-9\nS1-2\t\nS1-3\t\n",
        "missing_s1": head + "S1-1\t\nS1-2\t\n", "extra_s1": head + "S1-1\t\nS1-2\t\nS1-3\t\nS1-4\t\n",
    }
    for rule, text in cases.items():
        assert rules(text) == ({rule}, 1), rule
    listed = write(tmp_path / "c.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\t\nS1-2\t\nS1-3\tS3-1\n")
    found, code = V.validate(spark, write(tmp_path / "m.tsv", head + "S1-1\tS2-1\nS1-2\t\nS1-3\tS3-1\n"), listed, source)
    assert code == 0 and {r["rule"] for r in found.collect()} == {"match_not_candidate", "ids_not_checked"}
    assert V.validate(spark, str(tmp_path / "none.tsv"), None, source)[1] == 1
    assert V.validate(spark, listed, None, str(tmp_path / "none.tsv"))[1] == 1
    lines = V.numbered_lines(spark, source).orderBy("line_no").collect()
    assert [r["line_no"] for r in lines] == [1, 2, 3, 4, 5]


def tsv(path, table):
    return write(path, "\n".join("\t".join(x or "" for x in row) for row in [("entity_id", "business_name", "business_address", "country"), *table]) + "\n")


def test_sources_and_sinks(spark, tmp_path):
    path = tsv(tmp_path / "r.tsv", [("S1-1", 'a "quoted" \\ name', None, "IN"), ("S1-2", None, "x", None)])
    got = T.read_records(spark, path)
    assert rows(got.select("entity_id", F.coalesce("business_name", F.lit("-")))) == [("S1-1", 'a "quoted" \\ name'), ("S1-2", "-")]
    assert T.read_records(spark, path, limit=1).count() == 1 and rows(T.read_ids(spark, path)) == [("S1-1",), ("S1-2",)]
    T.write_scores(spark.createDataFrame([], "source1_entity_id string, candidate_entity_id string, match_probability double"), str(tmp_path / "scores"))
    parts = [p.read_text() for p in (tmp_path / "scores").iterdir() if p.name.startswith("part")]
    assert parts == ["source1_entity_id\tcandidate_entity_id\tmatch_probability\n"]
    T.write_best({"threshold": 0.5, "threshold_conservative": 0.6}, str(tmp_path / "best"), spark)
    assert T.read_best(spark, str(tmp_path / "best"))["threshold_conservative"] == 0.6
    calls = []

    def make():
        calls.append(1)
        return got

    for _ in range(2):
        assert T.cached(spark, str(tmp_path / "cache"), make).count() == 2
    assert len(calls) == 1


def test_columns_are_found_by_the_header(spark, tmp_path):
    path = write(tmp_path / "r.tsv", "country\textra\tBusiness_Name\tentity_id\tbusiness_address\nIN\tx\tAcme\tS1-1\t\n")
    assert [tuple(r) for r in T.read_records(spark, path).collect()] == [("S1-1", "Acme", None, "IN")]
    with pytest.raises(ValueError, match="business_name"):
        T.read_records(spark, write(tmp_path / "q.tsv", "entity_id\tcountry\nS1-1\tIN\n"))


def test_sweep_of_nothing_and_plot(spark, tmp_path):
    none = spark.createDataFrame([], "s1 string, cid string, score double")
    curve = E.sweep(none, none, none.select("s1"))
    assert curve.count() == 37 and tuple(curve.agg(F.max("macro_f05"), F.max("entities")).first()) == (0, 0)
    T.write_plot(E.sweep(none, none, spark.createDataFrame([("a",)], "s1 string")), str(tmp_path / "plot"))
    assert spark.read.text(str(tmp_path / "plot")).first()["value"].count(",40.0") == 37


def test_decision_counts(spark):
    scores = spark.createDataFrame([("a", "S2-1", 0.9), ("a", "S2-2", 0.8), ("b", "S2-1", 0.1)], "s1 string, cid string, score double")
    matches = E.final_matches(scores, spark.createDataFrame([("a",), ("b",)], "s1 string"), 0.5)
    assert tuple(E.decision_counts(matches, scores).first())[:4] == (2, 1, 2, 3)


def test_shortlist_cuts_at_its_limit(spark):
    one = normalized(spark.createDataFrame([("S1-1", "Acme Foods", "12 Rose Rd, Pune, 411001", "IN")], SCHEMA))
    many = [(f"S2-{i:03d}", "Acme Foods" if i % 4 == 0 else f"Acme Foods {i}", "12 Rose Rd, Pune, 411001" if i % 7 == 0 else None, "IN") for i in range(140)]
    rest = normalized(spark.createDataFrame(many, SCHEMA))
    rows = B.with_metadata(B.candidates(one, rest), one, rest)
    scored = rows.withColumn("n", B.shortlist_score()).collect()
    best = sorted(scored, key=lambda r: (-r["n"], r["cid"]))[:100]
    assert len(scored) == 140 and {r["cid"] for r in B.shortlist(rows).collect()} == {r["cid"] for r in best}


def test_pairs_are_shortlisted_where_their_keys_meet(spark):
    """As by brute force over all candidates, with ties at the limit, pairs of several keys and repeated ids; before any shuffle of pairs each task keeps the best only."""
    ones = [(f"S1-{i}", name, "12 Rose Rd, Pune, 411001", land) for i, (name, land) in enumerate([("Acme Foods", "IN"), ("Zeta Acme", "IN"), ("Acme Foods", None)])]
    ones.append(("S1-0", "Acme Trading", "7 Lily Rd, Delhi, 110001", "IN"))
    many = [(f"S2-{i:03d}", f"Acme Foods {i % 5}" if i % 3 else "Zeta Acme", "12 Rose Rd, Pune, 411001" if i % 7 == 0 else None, "IN" if i % 4 else None) for i in range(90)]
    many += [("S2-001", "Acme Trading", None, "IN"), ("S2-002", "Acme Foods 2", None, "IN")]
    one, rest = (normalized(spark.createDataFrame(r, SCHEMA)) for r in (ones, many))
    every = B.with_metadata(B.candidates(one, rest), latest(one), latest(rest))
    for most in (7, 100):
        short = B.shortlisted(one, rest, most=most)
        assert rows(short.select("s1", "cid", "shortlist_score")) == rows(B.shortlist(every, most).select("s1", "cid", "shortlist_score"))
        settings = BlockingSettings(shortlist=most, top_k=5)
        assert rows(ranked_candidates(one, rest, settings)) == rows(B.reranked(B.shortlist(every, most), 5))
    plan = ranked_candidates(one, rest)._jdf.queryExecution().executedPlan().toString()
    assert any("WindowGroupLimit" in line and "dense_rank" in line and "Partial" in line for line in plan.splitlines())


def _crowd(spark):
    """Records whose keys are shared by many, with ties, short names, spaces within name keys, and records that keys meet but rules tell apart."""
    words, lands = ("acme", "foods", "al", "zeta", "rose", "acmex"), ("IN", "in\tx", None)
    make = lambda s, n, k: [
        (f"{s}-{i:04d}", " ".join(words[(i * k + j * (i // 7 + 1)) % 6] for j in range(1 + i % 3)), f"{i * k % 4} {('Rose', 'Lily', 'Main')[i % 3]}garden, {('Pune', 'Pu')[i % 2]}, {411001 + i * k % 3 * 60000}" if i % 5 else None, lands[i % 3 % (1 + i % 4)])
        for i in range(n)
    ]
    return make("S1", 40, 5), make("S2", 420, 11)


@pytest.mark.parametrize("again", [False, True])
def test_shortlist_of_all_is_the_best_of_every_pair(spark, again):
    """As by brute force over all pairs that share a key, whatever the keys' frequency; an id with two rows may have keys that its metadata lacks."""
    ones, many = _crowd(spark)
    if again:
        ones, many = ones + [("S1-0001", "Zeta Rose", "9 Lilygarden, Pune, 500001", "IN")], many + [(f"S2-{i:04d}", "Foods Zeta", f"{i % 4} Rosegarden, 411001", "IN") for i in range(0, 420, 3)]
    one, rest = (normalized(spark.createDataFrame(r, SCHEMA)).persist() for r in (ones, many))
    whole = {kind: 10**9 for kind in B.CAPS}
    every = B.with_metadata(B.candidates(one, rest, whole), latest(one), latest(rest)).persist()
    for most in (3, 100):
        wanted = rows(B.shortlist(every, most).select("s1", "cid", "shortlist_score"))
        assert rows(B.shortlisted_of_all(one, rest, most).select("s1", "cid", "shortlist_score")) == wanted
        assert most == 100 or len(wanted) < every.count() / 20
    assert again or rows(B.reranked_by_name(B.shortlisted_of_all(one, rest), one, rest)) == rows(B.reranked(B.shortlist(every)))


def test_training_sees_partners_beyond_any_cap(spark):
    """The only true partner has the largest id of 400 that share its keys; with capped keys it is no candidate."""
    ones = normalized(spark.createDataFrame([("S1-1", "Acme Foods", None, "IN")], SCHEMA))
    many = normalized(spark.createDataFrame([(f"S2-{i:04d}", f"Acme Foods Q{i}" if i < 400 else "Acme Foods", None, "IN") for i in range(401)], SCHEMA))
    capped, found = ([r["cid"] for r in short(ones, many).collect()] for short in (B.shortlisted, B.shortlisted_of_all))
    assert "S2-0400" not in capped and "S2-0400" in found and len(found) == 100
    frames = type("Frames", (), {"s1": ones, "others": many, "all": ones.unionByName(many), "truth": spark.createDataFrame([("S1-1", "S2-0400")], "s1 string, cid string")})
    labelled, _ = queries._gbt(frames)
    assert [r["cid"] for r in labelled.where("label = 1").collect()] == ["S2-0400"]


def test_texts_of_both_sides_are_shuffled_no_second_time(sides):
    pairs = sides[0].sparkSession.createDataFrame([("S1-1", "S2-1")], "s1 string, cid string")
    plan = pair_features(pairs, sides[0].unionByName(sides[1]))._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    assert dealt and not [line for line in dealt if "cid" in line]


def test_features_for_training_are_computed_once(spark):
    frames = queries.Frames(spark, "/root/testdata/sf0.001")
    labelled, _ = queries._gbt(frames)
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Join" not in plan and "EvalPython" not in plan
    again = E.split_by_hash(E.labelled(frames.features(), frames.truth))
    assert rows(labelled.select(again.columns)) == rows(again)


def _shuffle_files(spark, at_most=None):
    """Shuffle files on the local disk; deletion is asynchronous, so it is given some time to come down to ``at_most``."""
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    for _ in range(100):
        n = manager.getAllFiles().mkString(" ").count("shuffle_")
        if at_most is None or n <= at_most:
            break
        time.sleep(0.1)
    return n


def test_shuffle_files_go_once_a_step_is_written(spark):
    held, before = spark.conf.get(T._CLEANUP), _shuffle_files(spark)
    frame = T.stored(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "step")
    assert _shuffle_files(spark, before) <= before and spark.conf.get(T._CLEANUP) == held
    assert rows(frame) == [(k, 100) for k in range(10)]
    T.removed(frame)
    assert not [p for p in frame.inputFiles() if os.path.exists(p.removeprefix("file://"))]


def test_training_begins_without_the_files_of_earlier_steps(spark, monkeypatch):
    before, seen = _shuffle_files(spark), []
    monkeypatch.setattr(M, "train", lambda *_: seen.append(_shuffle_files(spark, before)))
    queries.queries()["feature_importance"](spark, "/root/testdata/sf0.001").collect()
    assert len(seen) == 1 and seen[0] <= before


def test_learned_matches_read_written_scores(spark, monkeypatch):
    monkeypatch.setattr(M, "train", lambda *_: None)
    found = queries.queries()["learned_matches"](spark, "/root/testdata/sf0.001")
    files = found.inputFiles()
    assert any("/scores-" in p for p in files) and not any("/features-" in p for p in files)
    assert found.count() == queries.Frames(spark, "/root/testdata/sf0.001").universe.count()


def test_command_line(spark, tmp_path):
    paths = {"source1": tsv(tmp_path / "1.tsv", S1), "source2": tsv(tmp_path / "2.tsv", OTHERS[:2]), "source3": tsv(tmp_path / "3.tsv", OTHERS[2:])}
    sources = [x for k, v in paths.items() for x in (f"--{k}", v)]
    lists, out = str(tmp_path / "lists"), str(tmp_path / "matches")
    assert cli.main(["block", *sources, "--out", lists, "--sample", "2"], spark) == 0
    assert cli.main(["block", *sources, "--out", lists, "--resume"], spark) == 0
    assert sorted(r["source1_entity_id"] for r in T.read_candidates(spark, lists).collect()) == ["S1-1", "S1-2", "S1-3"]
    assert cli.main(["match", *sources, "--candidates", lists, "--out", out], spark) == 0
    single = str(tmp_path / "single")
    T.read_ground_truth(spark, out).coalesce(1).write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("nullValue", "").csv(single)
    file = next(os.path.join(single, f) for f in os.listdir(single) if f.startswith("part"))
    assert cli.main(["validate", "--matching", file, "--source1", paths["source1"]], spark) == 0


def test_stream_meets_the_stored_index(spark, tmp_path):
    store_index(spark.createDataFrame(OTHERS, SCHEMA), str(tmp_path / "index"))
    spark.createDataFrame(S1, SCHEMA).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    block_stream(arriving, str(tmp_path / "index"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = dict(rows(spark.read.parquet(str(tmp_path / "out")).select("source1_entity_id", "candidate_entity_ids")))
    assert got["S1-1"].startswith("S2-1") and got["S1-3"] == ""
