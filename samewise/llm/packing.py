"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Each task packs groups of its own consecutive documents, so that nothing is
shuffled and a group's size is bounded. Whole windows are cut off a long
document at once; what is left is cut into pieces of at most ``max_piece`` ids,
and these are dealt into k windows: every piece begins as a partial partition
(one window holds it, the others are empty); the two partial partitions with the
largest imbalance are merged again and again, the fullest windows of one with
the emptiest of the other. If a window of the result holds more than the
capacity, k rises and the group is dealt anew.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import mapped
from samewise.llm.pretokens import library_table


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each piece, by the largest differencing method over ``windows`` parts."""
    if windows <= 1 or not len(sizes):
        return np.zeros(len(sizes), np.int64)
    # Node i < n is piece i; a later node joins two. A partial partition is its loads, ascending, with the node of each window.
    joined: list[np.ndarray] = []
    nodes = len(sizes)
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    # The first windows-many merges of single pieces only set them side by side: begin with rows of pieces of like size.
    order = np.argsort(-sizes, kind="stable")
    for row, begin in enumerate(range(0, len(order), windows)):
        held = order[begin : begin + windows][::-1]
        loads = np.zeros(windows, np.int64)
        node = np.full(windows, -1, np.int64)
        loads[windows - len(held) :] = sizes[held]
        node[windows - len(held) :] = held
        heap.append((int(loads[0] - loads[-1]), row, loads, node))
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, a, an = heapq.heappop(heap)
        _, _, b, bn = heapq.heappop(heap)
        b, bn = b[::-1], bn[::-1]
        both = (an >= 0) & (bn >= 0)
        node = np.where(an >= 0, an, bn)
        count = int(both.sum())
        if count:
            joined.append(np.stack([an[both], bn[both]], 1))
            node[both] = np.arange(nodes, nodes + count)
            nodes += count
        loads = a + b
        by = np.argsort(loads, kind="stable")
        heapq.heappush(heap, (int(loads[by[0]] - loads[by[-1]]), serial, loads[by], node[by]))
        serial += 1
    window = np.full(nodes, -1, np.int64)
    last = heap[0][3]
    window[last[last >= 0]] = np.flatnonzero(last >= 0)
    if joined:
        pairs = np.concatenate(joined)
        for parent, (x, y) in zip(range(nodes - 1, len(sizes) - 1, -1), pairs[::-1].tolist(), strict=True):
            window[x] = window[y] = window[parent]
    return window[: len(sizes)]


def pack_group(lengths: np.ndarray, capacity: int, max_piece: int) -> tuple[np.ndarray, ...]:
    """Pieces of a group of documents: document, start, length, window, offset, in order of document and start."""
    whole = lengths // capacity
    rest = lengths - whole * capacity
    parts = -(-rest // max_piece)
    per_doc = whole + parts
    doc = np.repeat(np.arange(len(lengths)), per_doc)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    full = place < whole[doc]
    # the rest of a document is cut evenly
    part = place - whole[doc]
    many = np.maximum(parts[doc], 1)
    cut = whole[doc] * capacity + part * rest[doc] // many
    start = np.where(full, place * capacity, cut)
    length = np.where(full, capacity, whole[doc] * capacity + (part + 1) * rest[doc] // many - cut)
    window = np.zeros(len(doc), np.int64)
    window[full] = np.arange(int(full.sum()))
    small = np.flatnonzero(~full)
    if len(small):
        sizes = length[small]
        total = int(sizes.sum())
        k = max(1, -(-total // capacity))
        while True:
            dealt = difference(sizes, k)
            most = int(np.bincount(dealt, sizes, k).max())
            if most <= capacity:
                break
            k += 1
        window[small] = int(full.sum()) + dealt
    order = np.lexsort((start, doc, window))
    ends = np.cumsum(length[order])
    begins = ends - length[order]
    firsts = np.append(True, np.diff(window[order]) != 0)
    offset = np.empty(len(doc), np.int64)
    offset[order] = begins - np.maximum.accumulate(np.where(firsts, begins, 0))
    return doc, start, length, window, offset


def packed(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 1024, max_piece: int = 256, group_docs: int = 512, group_ids: int = 1 << 22, with_ids: bool = False) -> DataFrame:
    """Pieces of the documents' token ids in sequences of at most ``capacity``.

    A document's ids are those of the tokenizers library (null text: none) and
    then ``end_id``. Returns doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if asked for, the piece's ids. A sequence never
    spans two groups; its id is made of task, group and window. Null or repeated
    doc_ids are packed as any others; an empty table gives no rows. A group ends at
    ``group_docs`` documents or ``group_ids`` ids, so that a worker holds no more than that
    and one text, however long.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = ", ".join(f"`{n}` {'array<int>' if n == 'ids' else 'long'}" for n in names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = library_table(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 40
        tail = np.array([end_id], np.uint32)
        held_ids: list[int | None] = []
        held: list[np.ndarray] = []
        held_count = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence, held, held_ids, held_count
            lengths = np.fromiter(map(len, held), np.int64, len(held))
            doc, start, length, window, offset = pack_group(lengths, capacity, max_piece)
            parts = [held[d][s : s + n] for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            crc = [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]
            columns = [
                pa.array([held_ids[d] for d in doc.tolist()], pa.int64()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                pa.array(lengths[doc]), pa.array(sequence + window), pa.array(offset),
            ]
            if with_ids:
                columns.append(pa.array([p.tolist() for p in parts], pa.list_(pa.int32())))
            sequence += int(window.max()) + 1
            held, held_ids, held_count = [], [], 0
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), table.encode(batch.column(1).to_pylist()), strict=True):
                held_ids.append(doc_id)
                held.append(np.concatenate([ids, tail]))
                held_count += len(held[-1])
                if len(held) >= group_docs or held_count >= group_ids:
                    yield flush()
        if held:
            yield flush()

    return mapped(docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")), work, schema)
