"""Byte-pair encoding by batched numpy merge rounds, and decoding.

The symbols of many words lie in one flat array. In each round the rank of every
adjacent pair is found by binary search over the sorted pair keys, the lowest
rank of each word is taken, and all its occurrences merge from left to right.
Words with no pair left drop out. This gives the ids that merging one pair at a
time gives, as a merged symbol's rules rank after the rule that made it.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import mapped
from samewise.llm.pretokens import WordTable, cuts_words

NO_RANK = np.int64(1 << 40)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Merge rules and token bytes of a byte-level BPE file; other files are refused."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if not cuts_words(spec):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        vocab: dict[str, int] = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.width = max([*vocab.values(), *self.special.values()]) + 1
        self.of_byte = np.array([vocab[c] for c in alphabet], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.bytes_of = [b""] * self.width
        for token, number in vocab.items():
            self.bytes_of[number] = bytes(back[c] for c in token)
        for token, number in self.special.items():
            self.bytes_of[number] = token.encode()

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word."""
        raw = [w.encode("utf-8", "replace") for w in words]
        symbols = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        owner = np.repeat(np.arange(len(raw)), lengths)
        done_symbols, done_owner = [], []
        while len(symbols):
            ranks = self._ranks(symbols, owner)
            begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(begins, len(owner)))
            best = np.repeat(np.minimum.reduceat(ranks, begins), sizes)
            idle = best == NO_RANK
            if idle.any():
                done_symbols.append(symbols[idle])
                done_owner.append(owner[idle])
                symbols, owner, ranks, best = symbols[~idle], owner[~idle], ranks[~idle], best[~idle]
            if not len(symbols):
                break
            hits = np.flatnonzero(ranks == best)
            # of touching occurrences (a a a) every other one merges, from the left
            run = np.append(True, (np.diff(hits) != 1) | (owner[hits[1:]] != owner[hits[:-1]]))
            place = np.arange(len(hits)) - np.maximum.accumulate(np.where(run, np.arange(len(hits)), 0))
            hits = hits[place % 2 == 0]
            symbols[hits] = self.made[ranks[hits]]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if not done_symbols:
            return [np.zeros(0, np.uint32) for _ in words]
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        counts = np.bincount(owner, minlength=len(words))
        return np.split(symbols[order].astype(np.uint32), np.cumsum(counts)[:-1])

    def _ranks(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The rank of the pair that starts at each symbol; :data:`NO_RANK` where there is none."""
        pairs = np.full(len(symbols), -1, np.int64)
        pairs[:-1] = np.where(owner[1:] == owner[:-1], symbols[:-1] * self.width + symbols[1:], -1)
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], NO_RANK)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(2)
def numpy_table(path: str) -> tuple[Vocabulary, WordTable, list[str]]:
    """Kept by each worker between tasks."""
    vocabulary = Vocabulary(path)
    return vocabulary, WordTable(vocabulary.encode_words, vocabulary.special), [str(i) for i in range(vocabulary.width)]


def encode_decode(docs: DataFrame, vocabulary_path: str, with_outputs: bool = False) -> DataFrame:
    """Token ids of each text and the text decoded from them.

    A null text counts as empty. Rows stay as they are: null or repeated doc_ids
    give a row each. Returns doc_id, n_tokens, ids_sha256 (of the decimal ids
    joined by commas), decoded_sha256 (of the decoded text) and, if asked for,
    ids and decoded themselves. An empty table gives no rows.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_outputs

    def work(batches):
        vocabulary, table, decimal = numpy_table(vocabulary_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts, hashed, decoded_hash, all_ids, decoded = [], [], [], [], []
            for ids in table.encode(texts):
                listed = ids.tolist()
                text = vocabulary.decode(listed)
                counts.append(len(listed))
                hashed.append(hashlib.sha256(",".join(map(decimal.__getitem__, listed)).encode()).hexdigest())
                decoded_hash.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
                if with_outputs:
                    all_ids.append(listed)
                    decoded.append(text)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashed, pa.string()), pa.array(decoded_hash, pa.string())]
            if with_outputs:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split(" ")[0] for x in schema.split(", ")])

    return mapped(docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")), work, schema)
