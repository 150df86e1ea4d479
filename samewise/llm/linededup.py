"""Line dedup in DataFrame operations only.

The hashes of all long enough line keys are range-partitioned, with a secondary
sort by document (largest first) and position. A hash is one range's affair, so
its task streams its sorted rows through window functions: the first occurrence
names the document that keeps the line, each document's first occurrence counts. The
few hashes that hold a large share of all lines are dealt by document into slots
of their own, spread over all tasks; their slots' counts, a bounded number of rows,
are summed up afterwards. What comes back for each document is its keep bitmap,
compressed to runs of kept lines; texts only meet the bitmaps at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samewise.llm.common import lower_ascii, remove, stored

MIN_CHARS, MIN_DOCS = 40, 5
#: A hash is hot if it holds more than one in (HOT x shuffle partitions) of all lines, so there are no more hot ones than that; with very many partitions MOST_HOT takes that place.
HOT, MOST_HOT = 4, 25_000
_BLANK = " \t\n\x0b\f\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hot_hashes(keyed: DataFrame, shares: int) -> list[int]:
    """Hashes with more than one in (HOT x shares) of all rows, from a frequent-items sketch over all of them; it only steers where rows go."""
    most = min(HOT * shares, MOST_HOT)
    found = keyed.agg(F.expr(f"approx_top_k(h1, {most}, {32 * most})").alias("top"), F.count("h1").alias("n")).first()
    return [x["item"] for x in found["top"] or [] if x["count"] * most > found["n"]]


def marked_lines(keyed: DataFrame, min_docs: int) -> tuple[DataFrame, list[int]]:
    """keyed with slot, keeper (the largest document with the line) and n_docs of each row's slot, without the hashes that are too rare; and the hot hashes."""
    shares = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = _hot_hashes(keyed, shares)
    slot = F.when(F.col("h1").isin(hot), F.pmod(F.xxhash64("doc_id"), F.lit(shares))).otherwise(0) if hot else F.lit(0)
    ranged = keyed.withColumn("slot", slot.cast("int")).repartitionByRange("h1", "h2", "slot")
    same = W.partitionBy("h1", "h2", "slot")
    ordered = same.orderBy(F.desc("doc_id"), "pos")
    seen = ranged.withColumns({"keeper": F.first("doc_id").over(ordered), "before": F.lag("doc_id").over(ordered)})
    # a document's first occurrence counts; it may hold a line more than once
    first = F.col("before").isNull() | (F.col("before") != F.col("doc_id"))
    seen = seen.withColumn("n_docs", F.count(F.when(first, 1)).over(same)).drop("before")
    return seen.where((F.col("n_docs") >= min_docs) | (F.col("h1").isin(hot) if hot else F.lit(False))), hot


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents that lose lines: doc_id, text_hash, n_lines, n_dropped and keep_runs.

    A line's key is the line without ASCII blanks at both ends, A-Z in lower case.
    keep_runs lists the runs of kept lines as (start, len), start from 0. Null
    doc_ids count as no document and keep their lines; rows with one doc_id are
    one document, and rows that are equal too get one bitmap. Very long texts are
    rows of lines like any others; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.where(F.col("doc_id").isNotNull() & (F.length("text") >= min_chars)).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), _lines(lower_ascii(F.col("text"))).alias("lines")
    )
    lines = texts.select("doc_id", "text_hash", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    key = F.btrim("line", F.lit(_BLANK))
    keyed = lines.where((F.length("line") >= min_chars) & (F.length(key) >= min_chars))
    # written once, so that texts are not split again for the sketch and the range partitioning's sample
    keyed, keyed_at = stored(keyed.select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), "doc_id", "text_hash", "n_lines", "pos"), "line-hashes")
    marked, hot = marked_lines(keyed, min_docs)
    marked, marked_at = stored(marked, "line-marks")
    drops = marked
    if hot:
        slots = marked.where(F.col("h1").isin(hot)).groupBy("h1", "h2", "slot").agg(F.max("n_docs").alias("n"), F.max("keeper").alias("k"))
        totals = slots.groupBy("h1", "h2").agg(F.sum("n").alias("all_docs"), F.max("k").alias("last"))  # a row for each hot hash: a bounded number
        drops = marked.join(F.broadcast(totals), ["h1", "h2"], "left").withColumns({"n_docs": F.coalesce("all_docs", "n_docs"), "keeper": F.coalesce("last", "keeper")})
    drops = drops.where((F.col("n_docs") >= min_docs) & (F.col("doc_id") != F.col("keeper")))
    found = drops.groupBy("doc_id", "text_hash").agg(F.max("n_lines").alias("n_lines"), F.array_sort(F.collect_set("pos")).alias("dropped"))
    before = F.concat(F.array(F.lit(-1)), "dropped")
    after = F.concat("dropped", F.array("n_lines"))
    gaps = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("len")))
    found = found.select("doc_id", "text_hash", "n_lines", F.size("dropped").alias("n_dropped"), F.filter(gaps, lambda g: g["len"] > 0).alias("keep_runs"))
    bitmaps, _ = stored(found, "keep-bitmaps")
    remove(spark, [keyed_at, marked_at])
    return bitmaps


def _kept(docs: DataFrame, carry: list[Column], min_chars: int, min_docs: int) -> DataFrame:
    """carry, the number of lines and of dropped lines, and the kept text (null where the text was null)."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("n_dropped").cast("long").alias("__dropped"), F.col("keep_runs").alias("__runs")
    )
    rows = docs.select(*carry, F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__text_hash"), F.col("text").alias("__text"))
    # bitmaps grow with the documents, and far beyond what their compressed files show: they are never broadcast
    joined = rows.join(bitmaps.hint("merge"), (F.col("__id") == F.col("__doc")) & (F.col("__text_hash") == F.col("__hash")), "left")
    # an array of one, so that a text is split once and not for each run
    cut = F.transform(F.array(_lines(F.col("__text"))), lambda lines: F.flatten(F.transform("__runs", lambda r: F.slice(lines, r["start"] + 1, r["len"]))))
    kept = F.when(F.col("__runs").isNull(), F.col("__text")).otherwise(F.array_join(cut[0], "\n"))
    text = F.coalesce("__text", F.lit(""))
    return joined.select(
        *[c for c in joined.columns if not c.startswith("__") or c == "__row"],
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("__n_lines"),
        F.coalesce("__dropped", F.lit(0).cast("long")).alias("__n_dropped"),
        kept.alias("__kept"),
    )


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and kept_sha256 of the lines that stay, joined by a newline.

    Null and empty texts are one empty line. If all lines go, the empty text is left.
    """
    found = _kept(docs.select("doc_id", "text"), [F.col("doc_id")], min_chars, min_docs)
    return found.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(F.coalesce("__kept", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with their columns as they are, but for text without its dropped lines; a text passes through the join once."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row")
    found = _kept(docs, [rest], min_chars, min_docs)
    return found.select(*[F.col("__kept").alias(c) if c == "text" else F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
