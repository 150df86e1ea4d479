"""Context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a piece wherever it is minus one
modulo the block size; each piece gives one character of the signature. A
fingerprint is ``size:signature:signature at twice the size:digest``, with a digest
of the whole text, so that equal fingerprints mean equal texts. The size is the
smallest of 3 * 2**k for which about 64 pieces are expected, halved while the
signature has under 32 characters, doubled while it has over 256. Where a text
repeats itself, all ends of a stretch may be lost at once when the size doubles; of
such a stretch every second end stays, so that its share of the signature stays.
Two fingerprints are compared where they have a common block size, by edit distance.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samewise.llm.common import mapped, prepared
from samewise.llm.pretokens import powers

WINDOW, LEAST_BLOCK, PIECES, MOST_PIECES, COMMON = 7, 3, 64, 256, 7
#: Ends in a row that are all lost at twice the size, and bytes in a row without an end at the least size, only where a text repeats itself.
LOST_ENDS, LOST_BYTES = 32, 64
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


@lru_cache(1)
def _weights() -> np.ndarray:
    return np.array([pow(0x01000193, i, 1 << 32) for i in range(WINDOW)], np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """The hash of the window that ends at each byte; shorter windows at the start."""
    values = data.astype(np.uint32) + np.uint32(1)
    out = values * _weights()[0]
    for i in range(1, min(WINDOW, len(data))):
        out[i:] += values[:-i] * _weights()[i]
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    out ^= out >> np.uint32(12)
    return out


def _coarser(ends: np.ndarray, stay: np.ndarray, step: int, lost: int) -> np.ndarray:
    """The ends that stay; between them, of ``lost`` or more others in a row every ``step``-th, counted from where the row begins."""
    places = np.flatnonzero(stay)
    before, after = np.append(-1, places), np.append(places, len(ends))
    if (after - before).max() <= lost:
        return ends[places]
    rows = np.flatnonzero(after - before > lost)
    others = [np.arange(before[r] + step, after[r], step) for r in rows.tolist()]
    return ends[np.sort(np.concatenate([places, *others]))]


def _signature(data: np.ndarray, ends: np.ndarray) -> bytes:
    """A character for each piece; what follows the last end is a piece too."""
    starts = np.append(0, ends + 1)
    starts = starts[starts < len(data)]
    if not len(starts):
        return b""
    power, inverse = powers(len(data))
    sums = np.add.reduceat((data + np.uint64(1)) * power[: len(data)], starts) * inverse[starts]
    sums ^= sums >> np.uint64(31)
    sums *= np.uint64(0x9E3779B97F4A7C15)
    return _ALPHABET[(sums >> np.uint64(58)).astype(np.int64)].tobytes()


def fingerprint(text: str) -> str:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return f"{LEAST_BLOCK}:::"
    size = LEAST_BLOCK
    while size * PIECES < len(data):
        size *= 2
    hashes = rolling(data)
    wide = data.astype(np.uint64)

    levels = [_coarser(np.arange(len(data)), hashes % np.uint32(LEAST_BLOCK) == LEAST_BLOCK - 1, LEAST_BLOCK, LOST_BYTES)]

    def ends_at(block: int) -> np.ndarray:
        while len(levels) <= (block // LEAST_BLOCK).bit_length() - 1:
            finer, twice = levels[-1], LEAST_BLOCK << len(levels)
            levels.append(_coarser(finer, hashes[finer] % np.uint32(twice) == twice - 1, 2, LOST_ENDS))
        return levels[(block // LEAST_BLOCK).bit_length() - 1]

    while len(ends_at(size)) > MOST_PIECES:
        size *= 2
    while size > LEAST_BLOCK and len(ends_at(size)) + 1 < PIECES // 2:
        size //= 2
    ends, doubled = ends_at(size), ends_at(2 * size)
    digest = hashlib.blake2b(data.tobytes(), digest_size=6).hexdigest()
    return f"{size}:{_signature(wide, ends).decode()}:{_signature(wide, doubled).decode()}:{digest}"


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the one that follows."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _alike(a: Column, b: Column) -> Column:
    """1 minus the edit distance over the longer length, 0 if no seven characters are common: shorter signatures, even equal ones, tell too little."""
    longest = F.greatest(F.length(a), F.length(b))
    grams = lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - (COMMON - 1)), lambda i: F.substring(s, i, F.lit(COMMON)))
    common = F.when((F.length(a) >= COMMON) & (F.length(b) >= COMMON), F.arrays_overlap(grams(a), grams(b))).otherwise(F.lit(False))
    return F.when(common, 1 - F.levenshtein(a, b) / longest).otherwise(F.lit(0.0))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 for two fingerprints: the best likeness of their signatures at a common block size, 0 if they have none."""
    size = lambda f: F.split_part(f, F.lit(":"), F.lit(1)).cast("long")
    part = lambda f, i: F.split_part(f, F.lit(":"), F.lit(i))
    return (
        F.when(a == b, F.lit(1.0))
        .when(size(a) == size(b), F.greatest(_alike(part(a, 2), part(b, 2)), _alike(part(a, 3), part(b, 3))))
        .when(size(a) == 2 * size(b), _alike(part(a, 2), part(b, 3)))
        .when(size(b) == 2 * size(a), _alike(part(a, 3), part(b, 2)))
        .otherwise(F.lit(0.0))
    )


def _dealt(docs: DataFrame) -> DataFrame:
    """doc_id, tie, text, bucket and extra: buckets are ranges of doc_id, and the first row of each also ends the bucket before it (the first of all: the last).

    The ranges' borders are approximate quantiles of doc_id, a few for each
    shuffle partition; null ids sort first. The table of first rows has one row
    for each bucket, which bounds its broadcast.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.where(F.col("doc_id").isNotNull()).stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], max(0.25 / parts, 1e-4))
    borders = np.unique(np.array(found, np.float64))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, ids.fillna(-np.inf).to_numpy(np.float64), side="right"))

    placed = rows.withColumn("bucket", bucket_of("doc_id"))
    firsts = placed.groupBy("bucket").agg(F.min(F.struct("doc_id", "tie")).alias("first"))
    around = F.coalesce(F.lag("bucket").over(W.orderBy("bucket")), F.max("bucket").over(W.partitionBy()))
    firsts = firsts.select(F.col("bucket").alias("b"), F.col("first.doc_id").alias("d"), F.col("first.tie").alias("t"), around.alias("previous"))
    same = (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t"))
    places = F.array(F.struct("bucket", F.lit(False).alias("extra")), F.struct(F.col("previous").alias("bucket"), F.lit(True).alias("extra")))
    dealt = placed.join(F.broadcast(firsts), same, "left").withColumn("at", F.explode(F.filter(places, lambda x: x["bucket"].isNotNull())))
    return dealt.select("doc_id", "tie", "text", "at.bucket", "at.extra")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next document's text, and how alike they are.

    A null text counts as empty. The next document is that of the next larger
    doc_id (rows with one doc_id: by a hash of the text; null ids first), the
    first after the last; a single document follows itself. Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.
    """
    prepared(docs.sparkSession)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"

    def work(batches):
        pending: tuple | None = None  # the row whose successor is still to come: id, text, fingerprint, bucket
        for batch in batches:
            rows = []
            for doc_id, text, bucket, extra in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                print_ = fingerprint(text)
                if pending is not None and pending[3] == bucket:
                    changed = edited(pending[1], text)
                    rows.append((pending[0], len(pending[1]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), pending[2], fingerprint(changed), print_))
                pending = None if extra else (doc_id, text, print_, bucket)
            if rows:
                columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 2 + [pa.string()] * 4, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split(" ")[0] for x in schema.split(", ")])

    dealt = _dealt(docs).repartition("bucket").sortWithinPartitions("bucket", "extra", "doc_id", "tie")
    found = mapped(dealt.select("doc_id", "text", "bucket", "extra"), work, schema)
    own, changed, following = F.col("fingerprint"), F.col("edited_fingerprint"), F.col("next_fingerprint")
    return found.select("doc_id", "n_chars", "edited_sha256", own, changed, likeness(own, changed).alias("near_edited"), likeness(own, following).alias("near_next"))
