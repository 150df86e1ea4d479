"""Sources and sinks: TSV tables of records, candidate lists, matches and scores; parquet; side files."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: While set, Spark deletes an execution's shuffle files as soon as it ends, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
RECORD_COLUMNS = ("entity_id", "business_name", "business_address", "country")


def _texts(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...], limit: int | None = None) -> DataFrame:
    """A TAB-separated file, all text, no quoting; empty fields are null.

    Columns are found by their names in the header, in any order and letter case;
    others are not read, and a missing one is an error.
    """
    frame = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("lineSep", "\n").csv(path)
    held = {c.strip().lower(): c for c in reversed(frame.columns)}
    missing = [c for c in columns if c not in held]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    frame = frame.select(*[F.col(f"`{held[c]}`").alias(c) for c in columns])
    return frame if limit is None else frame.limit(limit)


def read_records(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    return read_tsv(spark, path, RECORD_COLUMNS, limit)


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, ("source1_entity_id", "candidate_entity_ids"))


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, ("source1_entity_id", "matched_entity_ids"))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    frame = read_tsv(spark, path, ("source1_entity_id", "candidate_entity_id", "match_probability"))
    return frame.withColumn("match_probability", F.col("match_probability").cast("double"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed first fields of a file's lines after the header; blank lines do not count."""
    lines = spark.read.option("header", True).option("sep", "\t").option("quote", "").csv(path, schema=_texts(("entity_id",)), enforceSchema=True)
    return lines.select(F.trim("entity_id").alias("entity_id")).where(F.col("entity_id") != "").distinct()


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all sources, repeated ones too."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def only_needed(records: DataFrame, needed: DataFrame, key: str = "entity_id") -> DataFrame:
    return records.join(needed.select(key).distinct(), key, "left_semi")


def write_tsv(frame: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header and unquoted rows, blanks at their ends kept; null and empty lists leave an empty field."""
    writer = frame.na.fill("").write.mode(mode).option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("nullValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); a temporary one in local runs that name none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return f"{(base or tempfile.mkdtemp(prefix='samewise-')).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to a :func:`scratch` path and read back, so that what reads it several times computes it once; the shuffle files behind it go."""
    spark, path = frame.sparkSession, scratch(frame.sparkSession, label)
    held = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, held)
    return spark.read.schema(frame.schema).parquet(path)


def removed(frame: DataFrame) -> None:
    """Delete the files of a :func:`stored` frame that nothing reads any more."""
    for file in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
        target = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(file)
        target.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def write_plot(curve: DataFrame, path: str, score: str = "macro_f05") -> None:
    """The curve of a sweep (a row for each threshold) as an SVG picture, a text file of one line."""
    rows = [(r["threshold"], r[score]) for r in curve.select("threshold", score).orderBy("threshold").collect()]
    low, high = (rows[0][0], rows[-1][0]) if rows else (0.0, 1.0)
    points = " ".join(f"{40 + 540 * (t - low) / ((high - low) or 1):.1f},{340 - 300 * y:.1f}" for t, y in rows)
    marks = "".join(f'<text x="{x}" y="{y}">{text}</text>' for x, y, text in ((40, 360, f"{low:g}"), (560, 360, f"{high:g}"), (5, 345, "0"), (5, 45, "1"), (250, 20, f"{score} by threshold")))
    picture = f'<svg xmlns="http://www.w3.org/2000/svg" width="600" height="370"><polyline fill="none" stroke="black" points="{points}"/>{marks}</svg>'
    curve.sparkSession.createDataFrame([(picture,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """Score rows with six decimals; no rows leave the header alone."""
    write_tsv(scores.select("source1_entity_id", "candidate_entity_id", F.format_string("%.6f", "match_probability").alias("match_probability")), path, "overwrite")


def write_curve(curve: DataFrame, path: str) -> None:
    curve.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_best(best: dict, path: str, spark: SparkSession) -> None:
    """One JSON object, as a text file of one line."""
    spark.createDataFrame([(json.dumps(best),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_best(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame], use_cache: bool = True, limit: int | None = None) -> DataFrame:
    """Read-through: the parquet at ``path`` if it is complete, else what ``make`` gives, written there; a limited run neither reads nor writes it."""
    if limit is not None or not use_cache:
        return make()
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
