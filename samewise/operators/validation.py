"""Rules for submitted files: one finding for each rule that is broken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MATCHING_HEADER = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_HEADER = ("source1_entity_id", "candidate_entity_ids")
EXAMPLES = 5
FINDING = "rule string, level string, n long, examples array<string>"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no (from 1) and line of a text file; each task's lines are counted, and only these counts are summed up in order."""
    rows = spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"), F.monotonically_increasing_id().alias("id"))
    part, place = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    rows = rows.select("line", part.alias("part"), place.alias("place"))
    counts = sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, at = [], 0
    for number, n in counts:
        offsets.append((number, at))
        at += n
    starts = spark.createDataFrame(offsets or [(0, 0)], "part long, begin long")
    return rows.join(F.broadcast(starts), "part").select((F.col("begin") + F.col("place") + 1).alias("line_no"), "line")


def _listed(rest: Column) -> Column:
    """The ids of a comma list; it is not trimmed, and empty if blank."""
    return F.when(F.trim(F.regexp_replace(rest, r"\s", " ")) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))


def parsed(lines: DataFrame) -> DataFrame:
    """s1 and ids of each line with a tab after the header line."""
    rest = F.substring("line", F.instr("line", "\t") + 1, F.length("line"))
    rows = lines.where((F.col("line_no") > 1) & F.contains("line", F.lit("\t")))
    return rows.select("line_no", F.split_part("line", F.lit("\t"), F.lit(1)).alias("s1"), _listed(rest).alias("ids"))


def _told(found: DataFrame, level: str = "error") -> DataFrame:
    """rule, level, n and examples of distinct rows (rule, x); examples are the smallest, by a group limit and not by collecting all."""
    smallest = found.withColumn("place", F.row_number().over(W.partitionBy("rule").orderBy("x"))).where(F.col("place") <= EXAMPLES)
    few = smallest.groupBy("rule").agg(F.array_sort(F.collect_list("x")).alias("examples"))
    return found.groupBy("rule").agg(F.count("x").alias("n")).join(few, "rule").select("rule", F.lit(level).alias("level"), "n", "examples")


def line_findings(lines: DataFrame, required: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Findings about rows: malformed, repeated, self, prefix, unknown, missing and extra ids.

    Each line gives what is wrong with it by itself, its S1 and its ids; the ids
    that must or may be there join them as rows, and one grouped aggregation over
    all of these tells every rule's offenders, each once.
    """
    rest = F.substring("line", F.instr("line", "\t") + 1, F.length("line"))
    tabbed = F.contains("line", F.lit("\t"))
    blank = F.trim(F.regexp_replace("line", r"\s", " ")) == ""
    rows = lines.where(F.col("line_no") > 1).select("line_no", tabbed.alias("tabbed"), blank.alias("blank"), F.split_part("line", F.lit("\t"), F.lit(1)).alias("s1"), _listed(rest).alias("ids"))

    def said(rule: Column, x: Column) -> Column:
        return F.struct(rule.alias("rule"), x.alias("x"))

    def some(condition: Column, *facts: Column) -> Column:
        return F.when(condition, F.array(*facts)).otherwise(F.array().cast("array<struct<rule:string,x:string>>"))

    prefixed = lambda i: i.startswith("S2-") | i.startswith("S3-")
    kind = lambda i: F.when(i.startswith("S1-"), "self_match").when(prefixed(i), "id").otherwise("wrong_prefix")
    facts = F.concat(
        some(~F.col("tabbed") & ~F.col("blank"), said(F.lit("malformed_row"), F.format_string("line %010d", "line_no"))),
        some(F.col("tabbed"), said(F.lit("s1"), F.col("s1"))),
        some(F.col("tabbed") & (F.size("ids") != F.size(F.array_distinct("ids"))), said(F.lit("repeated_id"), F.col("s1"))),
        F.when(F.col("tabbed"), F.transform("ids", lambda i: said(kind(i), i))).otherwise(F.array().cast("array<struct<rule:string,x:string>>")),
    )
    every = rows.select(F.inline(facts)).select("rule", "x", F.lit(1).alias("seen"), F.lit(0).alias("listed"))
    for rule, ids in (("s1", required), ("id", targets)):
        if ids is not None:
            every = every.unionByName(ids.toDF("x").select(F.lit(rule).alias("rule"), "x", F.lit(0).alias("seen"), F.lit(1).alias("listed")))
    each = every.groupBy("rule", "x").agg(F.sum("seen").alias("seen"), F.max("listed").alias("listed"))
    seen, listed = F.col("seen"), F.col("listed") == 1
    broken = (
        F.when(F.col("rule") == "s1", F.array(F.when(seen > 1, "duplicate_s1"), F.when(listed & (seen == 0), "missing_s1"), F.when(~listed, "extra_s1")))
        .when(F.col("rule") == "id", F.array(F.when(~listed, "unknown_id") if targets is not None else F.lit(None).cast("string")))
        .otherwise(F.array("rule"))
    )
    return _told(each.select(F.explode(F.array_compact(broken)).alias("rule"), "x"))


def last_rows(lines: DataFrame) -> DataFrame:
    """(s1, cid) of each S1's last row: a repeated S1 overwrites what came before."""
    rows = parsed(lines).groupBy("s1").agg(F.max_by("ids", "line_no").alias("ids"))
    return rows.select("s1", F.explode("ids").alias("cid"))


def not_in_candidates(matching: DataFrame, candidate: DataFrame) -> DataFrame:
    """A warning for S1 with matches that are not among their candidates."""
    extra = last_rows(matching).join(last_rows(candidate), ["s1", "cid"], "left_anti").select(F.lit("match_not_candidate").alias("rule"), F.col("s1").alias("x"))
    return _told(extra.distinct(), "warning")


def row_counts(lines: DataFrame) -> DataFrame:
    rows = parsed(lines)
    return rows.agg(F.count("s1").alias("n_rows"), F.coalesce(F.sum((F.size("ids") == 0).cast("long")), F.lit(0)).alias("empty_rows"))


def header_finding(header: str | None, expected: tuple[str, ...]) -> str | None:
    """The rule that a header breaks; such a file is not read on."""
    if not header:
        return "empty_file"
    if "\t" not in header and "," in header:
        return "comma_separated"
    return None if [c.strip().lower() for c in header.split("\t")] == list(expected) else "wrong_header"


def validate(spark: SparkSession, matching: str, candidate: str | None, source1: str, targets: list[str] | None = None, check_ids: bool = False) -> tuple[DataFrame, int]:
    """All findings and the exit code: 1 if any is an error; warnings alone give 0."""
    from pyspark.errors import AnalysisException, PySparkException

    from samewise.sources.tables import read_ids

    def single(rule: str, level: str = "error") -> DataFrame:
        return spark.createDataFrame([(rule, level, 1, [])], FINDING)

    def opened(path: str, expected: tuple[str, ...]) -> tuple[DataFrame | None, DataFrame | None]:
        try:
            lines = numbered_lines(spark, path)
            first = lines.where("line_no = 1").first()
        except AnalysisException:
            return None, single("file_not_found")
        broken = header_finding(first["line"] if first else None, expected)
        return (None, single(broken)) if broken else (lines, None)

    try:
        if not _exists(spark, source1):
            return single("source1_missing"), 1
        required, found, known = read_ids(spark, source1), [], None
        if not check_ids:
            found.append(single("ids_not_checked", "warning"))
        elif targets and all(_exists(spark, t) for t in targets):
            known = read_ids(spark, targets[0])
            for path in targets[1:]:
                known = known.unionByName(read_ids(spark, path))
        else:
            found.append(single("targets_missing", "warning"))
        lines, broken = opened(matching, MATCHING_HEADER)
        found.append(broken if broken is not None else line_findings(lines, required, known))
        if candidate is None or not _exists(spark, candidate):
            found.append(single("candidates_missing", "warning"))
        else:
            listed, broken = opened(candidate, CANDIDATE_HEADER)
            found.append(broken if broken is not None else line_findings(listed, required, known))
            if lines is not None and listed is not None:
                found.append(not_in_candidates(lines, listed))
        out = found[0]
        for frame in found[1:]:
            out = out.unionByName(frame)
        return out, int(not out.where("level = 'error'").isEmpty())
    except PySparkException:
        return single("unreadable_file"), 1


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
