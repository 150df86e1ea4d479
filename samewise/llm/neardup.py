"""Near-duplicate documents by MinHash, banding and sequential Bayesian verification.

1.  Each text becomes the set of its word shingles, a MinHash signature and a
    digest of the set. Equal sets are one class, known by its smallest doc_id.
2.  Classes that agree on a band share a bucket. Bands are as long as a miss
    probability of MISS at the threshold allows.
3.  First round: a class is compared with one leader, of the leaders (smallest
    ids) of its buckets the one that it shares most buckets with. This joins
    most of a group, and needs no more pairs than there are classes.
4.  Second round: what is left are buckets that still hold several components.
    Their classes meet in blocks of bounded size, each pair of different
    components in the first bucket that they share; so no candidate is left out,
    and pairs within a group that is joined already are never formed.
5.  A comparison takes signatures batch by batch and stops as soon as the
    posterior probability of reaching the threshold (uniform prior) is below
    MISS. Survivors are verified on the full sets, which meet in blocks again; a
    block skips pairs whose ends it has joined already.

Sets are computed anew from the texts of the classes in question, picked by a
bitmap of bounded size, rather than kept for all documents.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import mapped, prepared, remove, runs_of, stored
from samewise.llm.components import SALTS, connected_components
from samewise.llm.pretokens import RUN_CHARS, code_points, mixed, range_hashes

HASHES, BATCH, MISS = 128, 32, 1e-6
#: Most classes of a bucket, and of a home, in one side of a block.
BLOCK, HOME = 512, 1000
#: Pairs of a block in the first round, and bytes of shingles that a block's sets may take on average; longer texts make for smaller blocks.
PAIRS, BLOCK_BYTES = 2000, 1 << 25
MOST_MARKED, MOST_LISTED = 1 << 23, 1_000_000
BLOCK_KEY = ("h1", "p1", "h2", "p2")
_Q = [np.uint64(pow(0xD6E8FEB86659FD93, i, 1 << 64)) for i in range(64)]


@dataclass(frozen=True)
class Threshold:
    """Similar means ``of * intersection >= least * union`` for sets of shingles of ``words`` words."""

    least: int = 80
    of: int = 100
    words: int = 5

    @property
    def value(self) -> float:
        return self.least / self.of

    @property
    def rows(self) -> int:
        """Rows of a band: the most for which a pair at the threshold is missed by all bands with probability MISS at most."""
        return max([r for r in range(1, 17) if (1 - self.value**r) ** (HASHES // r) <= MISS], default=1)

    @property
    def bands(self) -> int:
        return HASHES // self.rows

    def least_matches(self) -> dict[int, int]:
        """For each number of hashes compared, the least number of matches that keeps a pair."""
        out = {}
        for n in range(BATCH, HASHES + 1, BATCH):
            total, m = 0.0, 0
            for m in range(n + 2):
                total += math.comb(n + 1, m) * self.value**m * (1 - self.value) ** (n + 1 - m)
                if total >= MISS:
                    break
            out[n] = m
        return out


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles; a text with fewer words is one shingle, one with none has none.

    Words are hashed place by place (:func:`range_hashes`), so that no structured
    words collide; of two sets of a thousand shingles, two different ones have one hash
    with a probability of about 5e-14.
    """
    _, points, seps = code_points(texts)
    points = points.copy()
    points[(points >= 65) & (points <= 90)] += 32
    full = (points != 32) & ((points < 9) | (points > 13))
    edges = np.flatnonzero(full[1:] != full[:-1]) + 1
    if full[0]:
        edges = np.append(0, edges)
    begins = edges[::2]
    if not len(begins):
        return [np.zeros(0, np.uint64) for _ in texts]
    hashes = range_hashes(points, edges)[::2]
    first = np.searchsorted(begins, np.append(0, seps[:-1]))
    last = np.searchsorted(begins, seps)
    if len(hashes) >= words:
        rolled = hashes[: len(hashes) - words + 1].copy()
        for i in range(1, words):
            rolled += hashes[i : len(hashes) - words + 1 + i] * _Q[i]
        rolled = mixed(rolled)
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            out.append(mixed(np.array([(hashes[a:b] * np.array(_Q[: b - a])).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


@lru_cache(1)
def _seeds() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, HASHES, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of HASHES minima (uint32) for each non-empty set."""
    odd, salt = _seeds()
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    starts = np.cumsum(lengths) - lengths
    out = np.empty((len(sets), HASHES), np.uint32)
    for begin, end in _row_runs(lengths, 1 << 16):
        part = flat[starts[begin] : starts[end - 1] + lengths[end - 1]]
        at = starts[begin:end] - starts[begin]
        for k in range(HASHES):
            out[begin:end, k] = np.minimum.reduceat((((part ^ salt[k]) * odd[k]) >> np.uint64(32)).astype(np.uint32), at)
    return out


def _row_runs(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    begin, held = 0, 0
    for at, n in enumerate(lengths.tolist()):
        if held and held + n > most:
            yield begin, at
            begin, held = at, 0
        held += n
    if begin < len(lengths):
        yield begin, len(lengths)


def _signed(docs: DataFrame, threshold: Threshold) -> DataFrame:
    """doc_id, n_shingles, digest of the set and signature (both null for an empty set)."""
    words = threshold.words

    def work(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for begin, end in runs_of(texts, RUN_CHARS):
                sets = shingle_sets(texts[begin:end], words)
                some = [s for s in sets if len(s)]
                rows = iter(signatures(some)) if some else iter(())
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                signs = [next(rows).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [ids[begin:end], pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "signature"],
                )

    return mapped(docs, work, "doc_id long, n_shingles long, digest binary, signature binary")


def _survivors(bands: int, rows: int, least: dict[int, int]):
    """Streams rows sorted by bucket and yields the pairs of different components that share this band first and pass the signature test.

    A bucket's pairs come packed, one row for each block in which they are
    verified: a block is a pair of (home, part). Where the homes differ, the row
    names its nodes too.
    """
    first = min(least)

    def pairs_of(group: dict[str, np.ndarray], band: int, crossed: bool) -> tuple[np.ndarray, np.ndarray]:
        signs, comps, side = group["signature"], group["component"], group["side"]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for begin in range(0, len(comps), 64):  # some rows at a time against all, so that memory stays small
            part = slice(begin, begin + 64)
            matches = np.zeros((len(comps[part]), len(comps)), np.int16)
            for k in range(first):
                matches += signs[part, k, None] == signs[None, :, k]
            keep = (matches >= least[first]) & (comps[part, None] != comps[None])
            keep &= np.arange(len(comps))[part, None] < np.arange(len(comps))[None]
            if crossed:
                keep &= side[part, None] != side[None]
            x, y = np.nonzero(keep)
            sums, x = matches[x, y].astype(np.int32), x + begin
            for n in sorted(least)[1:]:
                sums = sums + (signs[x, n - BATCH : n] == signs[y, n - BATCH : n]).sum(1, dtype=np.int32)
                keep = sums >= least[n]
                x, y, sums = x[keep], y[keep], sums[keep]
            if len(x):
                same = (signs[x, : bands * rows] == signs[y, : bands * rows]).reshape(len(x), bands, rows).all(2)
                keep = same.argmax(1) == band
                found.append((x[keep], y[keep]))
        return tuple(np.concatenate(v) for v in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int))

    def packed(group: pa.Table) -> pa.RecordBatch | None:
        band, _, i, j = (group.column(c)[0].as_py() for c in range(4))
        ids, comps, side, homes, parts = (group.column(c).to_numpy() for c in ("node", "component", "side", "home", "part"))
        signs = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(len(ids), HASHES)
        x, y = pairs_of({"component": comps, "signature": signs, "side": side}, band, i != j)
        if not len(x):
            return None
        turn = (homes[x] > homes[y]) | ((homes[x] == homes[y]) & (parts[x] > parts[y]))
        x, y = np.where(turn, y, x), np.where(turn, x, y)
        block = np.stack([homes[x], parts[x], homes[y], parts[y]], 1)
        order = np.lexsort(block.T[::-1])
        out = []
        for at in np.split(order, np.flatnonzero((np.diff(block[order], axis=0) != 0).any(1)) + 1):
            key = block[at[0]].tolist()
            nodes = [] if key[0] == key[2] else np.unique(np.concatenate([ids[x[at]], ids[y[at]]])).tolist()
            out.append((*key, *(v.tobytes() for v in (ids[x[at]], ids[y[at]], comps[x[at]], comps[y[at]])), nodes))
        kinds = (*[pa.int64()] * 4, *[pa.binary()] * 4, pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[*BLOCK_KEY, "a", "b", "ca", "cb", "nodes"])

    def buckets_of(table: pa.Table, last: bool) -> tuple[list[pa.Table], list[pa.RecordBatch]]:
        """The whole buckets of sorted rows that hold several components, and the rows of a bucket that may go on."""
        keys = np.stack([table.column(c).to_numpy() for c in range(4)])
        edges = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [table.num_rows]])
        comps = table.column("component").to_numpy()
        mixed = np.minimum.reduceat(comps, edges[:-1]) != np.maximum.reduceat(comps, edges[:-1])
        whole = len(mixed) if last else len(mixed) - 1
        found = [table.slice(edges[n], edges[n + 1] - edges[n]) for n in np.flatnonzero(mixed[:whole]).tolist()]
        return found, [] if last else table.slice(edges[-2]).to_batches()

    def work(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                groups, held = buckets_of(pa.Table.from_batches([*held, batch]), False)
                yield from filter(None, map(packed, groups))
        if held:
            yield from filter(None, map(packed, buckets_of(pa.Table.from_batches(held), True)[0]))

    return work


def _verify_block(threshold: Threshold, least: dict[int, int]):
    """Links of one block: likely pairs first among some thousand at a time, without those whose ends are joined by then."""

    def linked(one: np.ndarray, two: np.ndarray) -> bool:
        if threshold.of * min(len(one), len(two)) < threshold.least * max(len(one), len(two)):
            return False
        both = len(np.intersect1d(one, two, assume_unique=True))
        return threshold.of * both >= threshold.least * (len(one) + len(two) - both)

    def numbers(column: pa.ChunkedArray) -> np.ndarray:
        """A column of numbers, or of packed arrays of them."""
        return np.frombuffer(b"".join(column.to_pylist()), np.int64) if pa.types.is_binary(column.type) else column.to_numpy()

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b, ca, cb = (numbers(left[c]) for c in ("a", "b", "ca", "cb"))
        nodes, sets = right["node"].to_numpy(), [np.frombuffer(x, np.uint64) for x in right["shingles"].to_pylist()]
        order = np.argsort(nodes, kind="stable")
        nodes = nodes[order]
        # a node of several texts has several rows: each of its pairs meets all of them
        first = [np.searchsorted(nodes, x) for x in (a, b)]
        count = [np.searchsorted(nodes, x, side="right") - f for x, f in zip((a, b), first, strict=True)]
        times = count[0] * count[1]
        pair = np.repeat(np.arange(len(a)), times)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
        i, j = first[0][pair] + place // np.maximum(count[1], 1)[pair], first[1][pair] + place % np.maximum(count[1], 1)[pair]
        signs = signatures([sets[k] for k in order.tolist()]) if len(order) else np.zeros((0, HASHES), np.uint32)
        limits = np.array([least[n] for n in sorted(least)])
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        for at in range(0, len(pair), 1 << 14):
            part = slice(at, at + (1 << 14))
            one, two, which = i[part], j[part], pair[part]
            sums = (signs[one] == signs[two]).reshape(-1, HASHES // BATCH, BATCH).sum(2).cumsum(1)
            tried = np.flatnonzero((sums >= limits).all(1))
            tried = tried[np.argsort(-sums[tried, -1], kind="stable")]
            names = ca[which[tried]].tolist(), cb[which[tried]].tolist()
            for k, m, c1, c2 in zip(order[one[tried]].tolist(), order[two[tried]].tolist(), *names, strict=True):
                x, y = root(c1), root(c2)
                if x != y and linked(sets[k], sets[m]):
                    parent[x] = y
                    out.append((c1, c2))
        return pa.table({"a": pa.array([o[0] for o in out], pa.int64()), "b": pa.array([o[1] for o in out], pa.int64())})

    return work


def _bitmap_of(ids: DataFrame, column: str, expected: int) -> tuple[int, bytes]:
    """A bitmap of the hashes of no more than MOST_MARKED ids: 16 to 32 bits for each, 16 MB at most, made by partial aggregation."""
    bits = 1 << max(15, math.ceil(math.log2(16 * max(1, expected))))
    place = F.pmod(F.xxhash64(F.col(column)), F.lit(bits)) + 1
    parts = ids.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    data = bytearray(bits // 8)
    for part in parts:
        data[(part["n"] - 1) * 4096 : part["n"] * 4096] = part["bits"]
    return bits, bytes(data)


def _listed(data: bytes, places: np.ndarray) -> np.ndarray:
    return (np.frombuffer(data, np.uint8)[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def _rows_of(rows: DataFrame, wanted: DataFrame, expected: int, schema: str, make=None) -> DataFrame:
    """The rows whose doc_id may be a wanted node, by a bitmap that goes to each task: few rows are left for the join that decides.

    ``make`` turns batches of them into others of ``schema``, in the same worker.
    Where more ids are wanted than the bitmap can tell apart, a join picks the rows.
    """
    if expected > MOST_MARKED:
        picked = rows.join(wanted.select(F.col("node").alias("__node")).distinct(), F.col("doc_id") == F.col("__node"), "left_semi")
        return mapped(picked, make, schema) if make else picked
    bits, data = _bitmap_of(wanted.select("node"), "node", expected)

    def pick(batches):
        for batch in batches:
            last = batch.num_columns - 1
            yield batch.filter(pa.array(_listed(data, batch.column(last).to_numpy()))).select(range(last))

    def work(batches):
        return make(pick(batches)) if make else pick(batches)

    return mapped(rows.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(bits))), work, schema)


def _verified(keyed: DataFrame, need: DataFrame, expected: int, docs: DataFrame, threshold: Threshold) -> DataFrame:
    """Links (a, b) between components that join what the pairs of each block truly link.

    keyed has the columns of BLOCK_KEY and a, b, ca, cb (numbers, or packed
    arrays of them); need has BLOCK_KEY and node: whose sets a block asks for.
    """
    words = threshold.words
    need = need.distinct()

    def sets_of(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for begin, end in runs_of(texts, RUN_CHARS):
                sets = [s.tobytes() for s in shingle_sets(texts[begin:end], words)]
                yield pa.RecordBatch.from_arrays([ids[begin:end], pa.array(sets, pa.binary())], names=["node", "shingles"])

    picked = _rows_of(docs.select("doc_id", "text"), need, expected, "node long, shingles binary", sets_of).where(F.length("shingles") > 0)
    sets = need.join(picked, "node").select(*[F.col(c).alias(f"at_{c}") for c in BLOCK_KEY], "node", "shingles")
    return keyed.groupBy(*BLOCK_KEY).cogroup(sets.groupBy(*[f"at_{c}" for c in BLOCK_KEY])).applyInArrow(_verify_block(threshold, threshold.least_matches()), "a long, b long")


def near_duplicates(docs: DataFrame, threshold: Threshold = Threshold()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row.

    component_id is the smallest doc_id that links reach; kept tells whether
    that is the document itself. Texts without words (null, empty, blank) link
    with nothing. A row whose doc_id is null links with nothing either, has a
    null component and is kept. A doc_id in several rows is one document: a link
    to any of its texts is a link to it, and equal rows stay equal rows.
    """
    spark = docs.sparkSession
    prepared(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.where(F.col("doc_id").isNotNull())
    least = threshold.least_matches()
    signed, signed_at = stored(_signed(rows, threshold), "signatures")
    sound = signed.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    classes, classes_at = stored(sound.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("size")), "class-ids")
    mean = classes.agg(F.avg("size")).first()[0] or 1.0
    classes = classes.drop("size")
    home, most_pairs = (max(1, min(limit, int(BLOCK_BYTES / (8 * n * mean)))) for limit, n in ((HOME, 1), (PAIRS, 2)))
    members, _ = stored(signed.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")), "members")
    # ids whose rows have different sets join the classes of these
    several = sound.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where(F.col("lo") != F.col("hi")).select("doc_id")
    own = members.where(F.col("rep").isNotNull()).join(several, "doc_id", "left_semi").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))

    # only band keys pass through the join that picks one row of each class; signatures stay in their table
    size = 4 * threshold.rows
    places = F.array(*[F.xxhash64(F.lit(i), F.substring("signature", 1 + i * size, size)) for i in range(threshold.bands)])
    picked = sound.select("doc_id", "digest", places.alias("keys")).join(classes, "digest").where(F.col("doc_id") == F.col("rep"))
    banded, banded_at = stored(picked.select(F.col("rep").alias("node"), F.posexplode("keys").alias("band", "key")), "bands")
    shared = banded.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where(F.col("leader") != F.col("last"))
    buckets, buckets_at = stored(banded.join(shared.drop("last"), "key"), "buckets")

    stars = buckets.where(F.col("node") != F.col("leader")).groupBy("node", "leader").agg(F.count("band").alias("n"))
    best = stars.groupBy("node").agg(F.max(F.struct("n", (-F.col("leader")).alias("l"))).alias("best"))
    leader = -F.col("best.l")
    first, first_at = stored(best.select(leader.alias("a"), F.col("node").alias("b"), leader.alias("ca"), F.col("node").alias("cb")), "pairs")
    # a leader's pairs are one block's affair, so each set goes to one block; leaders of more than most_pairs (one in most_pairs of all pairs at most) are parted
    leaders = first.groupBy("a").agg(F.count("b").alias("n"))
    total = leaders.agg(F.sum("n")).first()[0] or 0
    parted = leaders.where(F.col("n") > most_pairs).select("a", F.ceil(F.col("n") / most_pairs).alias("parts"))
    shares = first.join(F.broadcast(parted) if total / most_pairs <= MOST_LISTED else parted, "a", "left")
    part = F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")) + 1, F.lit(0)).cast("long")
    zero = F.lit(0).cast("long")
    keyed = shares.withColumns({"h1": F.pmod(F.xxhash64("a"), F.lit(max(1, math.ceil(total / most_pairs)))), "p1": part, "h2": zero, "p2": zero}).drop("parts")
    need = keyed.select(*BLOCK_KEY, F.explode(F.array("a", "b")).alias("node"))
    links = _verified(keyed, need, 2 * total, known, threshold).unionByName(own)
    joined = connected_components(links).select("node", F.col("component").alias("c"))

    placed = buckets.join(joined, "node", "left").withColumn("component", F.coalesce("c", "node")).select("band", "key", "node", "component")
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("node").alias("n")).where(F.col("lo") != F.col("hi")).select("key", "n")
    blocks = F.ceil(F.col("n") / BLOCK)
    side = F.pmod(F.xxhash64("node"), blocks)
    # a key that holds very many classes meets its count in salted shares
    salts = mixed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = placed.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salts, ["key", "salt"]).withColumn("side", side.cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    left = left.select("band", "key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "node", "component", "side")
    left, left_at = stored(left, "mixed")
    # a class's home is its leader: classes of one group meet in few blocks, large homes are parted
    homes = left.select("node").distinct().join(first.select(F.col("b").alias("node"), F.col("a").alias("home")), "node", "left").withColumn("home", F.coalesce("home", "node"))
    parts = homes.groupBy("home").agg(F.ceil(F.count("node") / home).alias("parts"))
    homes, homes_at = stored(homes.join(parts, "home").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))), "homes")
    signs = _rows_of(signed.select("doc_id", "digest", "signature"), homes, homes.count(), "doc_id long, digest binary, signature binary")
    signs = signs.join(classes, "digest").where(F.col("doc_id") == F.col("rep")).select(F.col("rep").alias("node"), "signature")
    rows_left = left.join(homes.select("node", "home", "part"), "node").join(signs, "node")
    rows_left = rows_left.select("band", "key", "i", "j", "node", "component", "signature", "side", "home", "part")
    rows_left = rows_left.repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j")
    schema = "h1 long, p1 long, h2 long, p2 long, a binary, b binary, ca binary, cb binary, nodes array<long>"
    rest, rest_at = stored(mapped(rows_left, _survivors(threshold.bands, threshold.rows, least), schema), "pairs")
    within = homes.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    within = within.select(F.col("home").alias("h1"), F.least("part", "other").alias("p1"), F.col("home").alias("h2"), F.greatest("part", "other").alias("p2"), "node")
    within = within.join(rest.select(*BLOCK_KEY).distinct(), list(BLOCK_KEY), "left_semi")
    need = within.unionByName(rest.select(*BLOCK_KEY, F.explode("nodes").alias("node")))
    more = connected_components(_verified(rest.drop("nodes"), need, homes.count(), known, threshold)).select(F.col("node").alias("c"), F.col("component").alias("c2"))

    found = members.join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
    found = found.join(more, "c", "left").withColumn("component_id", F.coalesce("c2", "c", "doc_id"))
    out, _ = stored(found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")), "near-duplicates")
    remove(spark, [signed_at, classes_at, banded_at, buckets_at, first_at, left_at, homes_at, rest_at])
    return out


def one_of_each(docs: DataFrame, threshold: Threshold = Threshold()) -> DataFrame:
    """The documents with their columns as they are, one of each group (the smallest doc_id); of rows with that doc_id all stay.

    Rows whose id is not in a bitmap of the dropped ids stay where they are; only
    the others are joined with these ids, or all if a bitmap can't hold these ids apart.
    """
    dropped, _ = stored(near_duplicates(docs, threshold).where(~F.col("kept")).select(F.col("doc_id").alias("__drop")).distinct(), "dropped")
    n_dropped, doc_id = dropped.count(), F.col("doc_id").cast("long")
    if n_dropped > MOST_MARKED:
        return docs.withColumn("__id", doc_id).join(dropped, F.col("__id") == F.col("__drop"), "left_anti").drop("__id")
    bits, data = _bitmap_of(dropped, "__drop", n_dropped)

    @F.pandas_udf("boolean")
    def listed(place: pd.Series) -> pd.Series:
        return pd.Series(_listed(data, place.to_numpy()))

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    marked = docs.select(whole, doc_id.alias("__id"), listed(F.pmod(F.xxhash64(doc_id), F.lit(bits))).alias("__maybe"))
    rest = marked.where("__maybe").join(dropped, F.col("__id") == F.col("__drop"), "left_anti")
    return marked.where("not __maybe").select("__row.*").unionByName(rest.select("__row.*"))
