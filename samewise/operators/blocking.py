"""Candidate pairs: capped keys, null-safe equi-joins, shortlist, re-ranking, top K.

Every record gives rows (key_type, key). On the indexed side a key keeps its
first ``cap`` ids in order of entity_id, so a join's fan-out is bounded however
common a key is; the filter on the row number is planned as a group limit, which
trims a hot key before its shuffle. Countries are compared null-safely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samewise.functions import similarity as sim
from samewise.operators.records import latest
from samewise.sources.tables import removed, stored

#: Ids that a key keeps, by type of key.
CAPS = {"name_key": 150, "pin": 150, "token": 300, "house_street": 50, "pin_house": 50, "addr_token": 100}
SHORTLIST, TOP_K = 100, 20


def blocking_keys(records: DataFrame) -> DataFrame:
    """entity_id, country, key_type, key: distinct non-empty keys of each record."""
    house, pin = F.col("house_no"), F.col("pin")
    tokens = F.coalesce("addr_tokens", F.array().cast("array<string>"))
    some = lambda ok, key: F.when(ok, F.array(key)).otherwise(F.array().cast("array<string>"))
    by_type = {
        "name_key": some(F.col("name_key") != "", F.col("name_key")),
        "pin": some(pin != "", pin),
        "token": F.array_distinct("sig_tokens"),
        "house_street": F.when(house != "", F.array_distinct(F.transform(tokens, lambda a: F.concat(house, F.lit("_"), a)))).otherwise(F.array().cast("array<string>")),
        "pin_house": some((house != "") & (pin != ""), F.concat(pin, F.lit("_"), house)),
        "addr_token": F.array_distinct(F.filter(tokens, lambda a: F.length(a) >= 5)),
    }

    def typed(kind: str, keys: Column) -> Column:
        return F.transform(keys, lambda k: F.struct(F.lit(kind).alias("key_type"), k.alias("key")))

    every = F.concat(*[typed(kind, keys) for kind, keys in by_type.items()])
    return records.select("entity_id", "country", F.explode(every).alias("k")).select("entity_id", "country", "k.key_type", "k.key")


def capped_index(keys: DataFrame, caps: dict[str, int] = CAPS) -> DataFrame:
    """The first ids of each (key_type, country, key), as many as the type's cap allows."""
    order = W.partitionBy("key_type", "country", "key").orderBy("entity_id")
    limit = F.create_map(*[F.lit(x) for item in caps.items() for x in item])
    ranked = keys.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= max(caps.values()))
    return ranked.where(F.col("rn") <= limit[F.col("key_type")]).drop("rn")


def block(probe: DataFrame, index: DataFrame, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """Distinct (s1, cid) that share a key of one of ``kinds`` (all if none are named) in the same country, null equal to null."""
    if kinds:
        probe, index = probe.where(F.col("key_type").isin(*kinds)), index.where(F.col("key_type").isin(*kinds))
    left = probe.select(F.col("entity_id").alias("s1"), "key_type", "key", F.col("country").alias("c1"))
    right = index.select(F.col("entity_id").alias("cid"), F.col("key_type").alias("t2"), F.col("key").alias("k2"), F.col("country").alias("c2"))
    same = (F.col("key_type") == F.col("t2")) & (F.col("key") == F.col("k2")) & F.col("c1").eqNullSafe(F.col("c2"))
    return left.join(right, same).select("s1", "cid").distinct()


def candidates(s1: DataFrame, others: DataFrame, caps: dict[str, int] = CAPS, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """Union of all blocks of cleaned S1 records against cleaned S2 and S3 records."""
    keys = blocking_keys(others)
    return block(blocking_keys(s1), capped_index(keys.where(F.col("key_type").isin(*kinds)) if kinds else keys, caps), kinds)


_META = ("name_core", "name_key", "pin", "house_no", "sig_tokens", "addr_tokens")


def _sides(s1: DataFrame, others: DataFrame, columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    left = s1.select(F.col("entity_id").alias("s1"), *[F.col(c).alias(f"a_{c}") for c in columns])
    right = others.select(F.col("entity_id").alias("cid"), *[F.col(c).alias(f"b_{c}") for c in columns])
    return left, right


def with_metadata(pairs: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """The columns that scoring needs, as a_* of S1 and b_* of the candidate."""
    left, right = _sides(s1, others, _META)
    return pairs.join(left, "s1").join(right, "cid")


def _both_equal(column: str) -> Column:
    a, b = F.col(f"a_{column}"), F.col(f"b_{column}")
    return (a != "") & (a == b)


def _points(*rules: tuple[Column, int]) -> Column:
    total = F.lit(0)
    for rule, points in rules:
        total = total + F.when(rule, points).otherwise(0)
    return total


def shortlist_score() -> Column:
    a, b = F.col("a_pin"), F.col("b_pin")
    prefix = (b != "") & (F.length(a) >= 3) & b.startswith(F.substring(a, 1, 3)) & (a != b)
    return _points(
        (_both_equal("name_core"), 100), (_both_equal("pin"), 25), (prefix, 10), (_both_equal("house_no"), 25), (F.arrays_overlap("a_addr_tokens", "b_addr_tokens"), 20),
        (F.arrays_overlap("a_sig_tokens", "b_sig_tokens"), 20), ((F.col("a_name_key") != "") & F.col("b_name_core").startswith(F.col("a_name_key")), 20),
    )


def rerank_bonus() -> Column:
    house, pin = _both_equal("house_no"), _both_equal("pin")
    bonus = F.when(house & pin, 25).when(house, 15).when(pin, 10).otherwise(0)
    return bonus + F.when(F.arrays_overlap("a_addr_tokens", "b_addr_tokens"), 10).otherwise(0)


def _best(pairs: DataFrame, score: str, most: int) -> DataFrame:
    order = W.partitionBy("s1").orderBy(F.desc(score), "cid")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).withColumn("rank", F.col("rank").cast("long"))


def shortlist(pairs_with_metadata: DataFrame, most: int = SHORTLIST) -> DataFrame:
    """The best pairs of each S1 by cheap equality rules; ties go to the smaller candidate id."""
    return _best(pairs_with_metadata.withColumn("shortlist_score", shortlist_score()), "shortlist_score", most).drop("rank")


def shortlisted(s1: DataFrame, others: DataFrame, caps: dict[str, int] = CAPS, most: int = SHORTLIST) -> DataFrame:
    """s1, cid, shortlist_score and bonus: what :func:`shortlist` keeps of all candidates; ids of ``others`` and of ``s1`` count once.

    A record's metadata goes where its keys meet, so a pair is scored there and is
    two ids and two small numbers afterwards. Each task drops what is not among an
    S1's best before anything is shuffled; a pair that meets on several keys has
    the same place each time.
    """
    left, right = _sides(latest(s1), latest(others), _META)
    probe = blocking_keys(s1).withColumnsRenamed({"entity_id": "s1", "country": "c1"}).join(left, "s1")
    index = capped_index(blocking_keys(others), caps).withColumnsRenamed({"entity_id": "cid", "country": "c2", "key_type": "t2", "key": "k2"}).join(right, "cid")
    same = (F.col("key_type") == F.col("t2")) & (F.col("key") == F.col("k2")) & F.col("c1").eqNullSafe(F.col("c2"))
    return _best_where_met(probe.join(index, same), most)


def _best_where_met(met: DataFrame, most: int) -> DataFrame:
    pairs = met.select("s1", "cid", shortlist_score().alias("shortlist_score"), rerank_bonus().alias("bonus"))
    order = W.partitionBy("s1").orderBy(F.desc("shortlist_score"), "cid")
    best = pairs.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= most)
    return best.groupBy("s1", "cid").agg(F.max("shortlist_score").alias("shortlist_score"), F.max("bonus").alias("bonus"))


#: The shortlist's rules by letter: name, pin, house, address tokens, name tokens; and those that hold for all pairs on a key of a type, with their points.
_RULES = "nphas"
_SETTLED = {"name_key": ("", 0), "pin": ("p", 25), "token": ("s", 20), "house_street": ("ha", 45), "pin_house": ("ph", 50), "addr_token": ("a", 20)}


def _traits(records: DataFrame, probe: bool, lengths: list[int]) -> DataFrame:
    """(probe, id, traits): what a record may share with a partner for points, as (rule, value, points); ``lengths`` are those of the probes' name keys."""
    core, pin, house = F.col("name_core"), F.col("pin"), F.col("house_no")
    key = F.col("name_key")
    starts = [(key != "", key)] if probe else [(F.length(core) >= n, F.substring(core, 1, n)) for n in lengths]
    single = [("n", core != "", F.concat(F.lit("="), core), 100 + F.when((key != "") & core.startswith(key), 20).otherwise(0)), *[("n", *s, F.lit(20)) for s in starts]]
    single += [("p", pin != "", F.concat(F.lit("="), pin), F.lit(25)), ("p", F.length(pin) >= 3, F.substring(pin, 1, 3), F.lit(10)), ("h", house != "", house, F.lit(25))]
    traits = lambda rule, values, points: F.transform(values, lambda v: F.struct(F.lit(rule).alias("rule"), v.alias("value"), points.alias("points")))
    none = F.array().cast("array<struct<rule:string,value:string,points:int>>")
    found = [F.when(ok, traits(rule, F.array(v), points)).otherwise(none) for rule, ok, v, points in single]
    found += [F.coalesce(traits(rule, F.array_distinct(column), F.lit(20)), none) for rule, column in (("a", "addr_tokens"), ("s", "sig_tokens"))]
    return records.select(F.lit(probe).alias("probe"), F.col("entity_id").alias("id"), F.concat(*found).alias("traits"))


def _met_nodes(rows: DataFrame, most: int) -> DataFrame:
    """Rows (probe, id, node, settled, last, points) of nodes that have both sides, with place among the node's candidates and whether those are more than ``most``; written."""
    node = W.partitionBy("node")
    n = F.sum(F.when(F.col("probe"), 0).otherwise(1)).over(node)
    counted = rows.withColumns({"n": n, "probes": F.sum(F.when(F.col("probe"), 1).otherwise(0)).over(node), "place": F.row_number().over(node.orderBy("probe", "id"))})
    met = counted.where((F.col("n") > 0) & (F.col("probes") > 0)).withColumn("hot", F.col("n") > most)
    return stored(met.select("probe", "id", "node", "settled", "last", "points", "place", "hot"), "nodes")


def shortlisted_of_all(s1: DataFrame, others: DataFrame, most: int = SHORTLIST) -> DataFrame:
    """What :func:`shortlisted` gives if keys have no cap: the best of all that share a key, found without listing all.

    A key is a node. A node with more than ``most`` candidates has a child for each
    rule that gives points and each value that a record has under it; its records
    go to their children too, and so on. An S1 meets the first ``most`` ids of each
    of its nodes. That is exact: take a pair that shares a key and the node of all
    rules that hold for it. If that node or one above has no more than ``most``
    candidates, the pair is met there. Otherwise each candidate of the node gets from
    this S1 the pair's points at least, so a pair that is not among the first
    ``most`` is outdone by as many with smaller ids, all of which share the key. For
    the same reason an S1 that has more than ``most`` candidates at a node of some
    points leaves out those of its large nodes that stand for pairs of fewer.
    """
    one, rest = latest(s1), latest(others)
    repeated = any(not r.groupBy("entity_id").count().where("count > 1").isEmpty() for r in (s1, others))
    lengths = sorted(r["n"] for r in one.select(F.length("name_key").alias("n")).distinct().collect() if r["n"])
    traits = _traits(one, True, lengths).unionByName(_traits(rest, False, lengths))
    # the country is told apart by its length; cleaned keys and values have no tabs
    country = F.coalesce(F.concat(F.length("country").cast("string"), F.lit(":"), "country"), F.lit("-"))
    # a repeated id may have its keys from another row than its metadata, and then a key settles nothing
    by_type = lambda i: F.create_map(*[F.lit(x) for kind, given in _SETTLED.items() for x in (kind, given[i])])[F.col("key_type")]
    settled, points = (F.lit(""), F.lit(0)) if repeated else (by_type(0), by_type(1))
    rows = None
    for probe, records in ((True, s1), (False, others)):
        side = blocking_keys(records).select(
            F.lit(probe).alias("probe"), F.col("entity_id").alias("id"), F.concat_ws("\t", country, "key_type", "key").alias("node"), settled.alias("settled"), F.lit(0).alias("last"), points.alias("points")
        )
        side = side.distinct() if repeated else side
        rows = rows.unionByName(side) if rows else side
    levels = [_met_nodes(rows, most)]
    while not levels[-1].where("hot").isEmpty():  # at most one level for each rule, as a child's rule comes after its node's
        hot = levels[-1].where("hot").join(traits, ["probe", "id"]).select("probe", "id", "node", "settled", "last", "points", F.explode("traits").alias("t"))
        rule = F.instr(F.lit(_RULES), F.col("t.rule"))
        hot = hot.where((rule > F.col("last")) & (F.instr("settled", F.col("t.rule")) == 0))
        child = F.concat_ws("\t", "node", "t.rule", "t.value").alias("node")
        levels.append(_met_nodes(hot.select("probe", "id", child, "settled", rule.alias("last"), (F.col("points") + F.col("t.points")).alias("points")), most))
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    left, right = _sides(one, rest, _META)
    enough = F.max(F.when(F.col("hot"), F.col("points"))).over(W.partitionBy("id"))
    probe = nodes.where("probe").withColumn("enough", enough).where(~F.col("hot") | (F.col("points") >= F.col("enough")))
    probe = probe.select("node", F.col("id").alias("s1")).join(left, "s1")
    index = nodes.where(~F.col("probe") & (F.col("place") <= most)).select("node", F.col("id").alias("cid")).join(right, "cid")
    best = stored(_best_where_met(probe.join(index, "node"), most), "shortlist")
    for level in levels:
        removed(level)
    return best


def reranked_by_name(short: DataFrame, s1: DataFrame, others: DataFrame, most: int = TOP_K) -> DataFrame:
    """What :func:`reranked` gives, for pairs that have their bonus: only names follow them."""
    left, right = _sides(latest(s1), latest(others), ("name_core",))
    rows = short.select("s1", "cid", "bonus").join(right, "cid").join(left, "s1")
    score = F.least(F.lit(100.0), sim.token_sort_ratio(F.col("a_name_core"), F.col("b_name_core")) + F.col("bonus"))
    return _best(rows.withColumn("score", score), "score", most).select("s1", "cid", "score", "rank")


def reranked(short: DataFrame, most: int = TOP_K) -> DataFrame:
    """s1, cid, score, rank: the top of each S1 by fuzzy name similarity and bonuses. The costly comparison runs after the shortlist's window."""
    score = F.least(F.lit(100.0), sim.token_sort_ratio(F.col("a_name_core"), F.col("b_name_core")) + rerank_bonus())
    return _best(short.withColumn("score", score), "score", most).select("s1", "cid", "score", "rank")


def candidate_lists(s1: DataFrame, ranked: DataFrame) -> DataFrame:
    """source1_entity_id and its candidates, best first, joined by commas; an S1 without any has an empty list."""
    lists = ranked.groupBy("s1").agg(F.array_sort(F.collect_list(F.struct("rank", "cid"))).alias("l"))
    lists = lists.select("s1", F.array_join(F.transform("l", lambda x: x["cid"]), ",").alias("candidate_entity_ids"))
    ids = s1.select(F.col("entity_id").alias("s1")).distinct()
    return ids.join(lists, "s1", "left").select(F.col("s1").alias("source1_entity_id"), F.coalesce("candidate_entity_ids", F.lit("")).alias("candidate_entity_ids"))


def exploded(lists: DataFrame, ids: str = "candidate_entity_ids", key: str = "source1_entity_id") -> DataFrame:
    """s1, cid, rank of comma lists; ids are trimmed and blank ones dropped."""
    rows = lists.select(F.col(key).alias("s1"), F.posexplode(F.split(F.coalesce(ids, F.lit("")), ",")).alias("pos", "raw"))
    return rows.select("s1", F.trim("raw").alias("cid"), (F.col("pos") + 1).cast("long").alias("rank")).where(F.col("cid") != "")


def remaining(s1: DataFrame, finished: DataFrame) -> DataFrame:
    """S1 records that an existing candidate table lacks: what a resumed run has to do."""
    return s1.join(finished.select(F.col("source1_entity_id").alias("entity_id")), "entity_id", "left_anti")


def volume(s1: DataFrame, raw: DataFrame, final: DataFrame) -> DataFrame:
    """Raw and final candidates in all, for each S1 on average, and at most."""
    ids = s1.select(F.col("entity_id").alias("s1")).distinct()
    n = ids.join(raw.groupBy("s1").agg(F.count("cid").alias("r")), "s1", "left").join(final.groupBy("s1").agg(F.count("cid").alias("f")), "s1", "left")
    r, f = F.coalesce("r", F.lit(0)), F.coalesce("f", F.lit(0))
    return n.agg(
        F.count("s1").alias("s1_total"), F.coalesce(F.sum(r), F.lit(0)).alias("raw_candidates"), F.coalesce(F.sum(f), F.lit(0)).alias("final_candidates"),
        F.coalesce(F.avg(r), F.lit(0.0)).alias("avg_raw"), F.coalesce(F.avg(f), F.lit(0.0)).alias("avg_final"), F.coalesce(F.max(f), F.lit(0)).alias("max_final"),
    )


def recall(s1: DataFrame, final: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of the true pairs of the given S1 among the candidates; 1 if there is no true pair."""
    ids = s1.select(F.col("entity_id").alias("s1")).distinct()
    true = truth.join(ids, "s1", "left_semi")
    counts = final.groupBy("s1").agg(F.count("cid").alias("n"))
    sizes = ids.join(counts, "s1", "left").agg(F.count("s1").alias("sampled_s1"), F.coalesce(F.avg(F.coalesce("n", F.lit(0))), F.lit(0.0)).alias("avg_candidates"), F.coalesce(F.max("n"), F.lit(0)).alias("max_candidates"))
    found = true.join(final.select("s1", "cid", F.lit(1).alias("hit")), ["s1", "cid"], "left")
    hits = found.agg(F.countDistinct("s1").alias("s1_with_truth"), F.count("cid").alias("true_total"), F.count("hit").alias("captured"))
    return sizes.crossJoin(hits).withColumn("recall", F.coalesce(F.try_divide(F.col("captured"), F.col("true_total")), F.lit(1.0)))
