"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of text slices of its
labelled documents. A text is cut into blocks, each block is compressed with
each dictionary, and the language with the smallest sum wins. A prediction whose
margin over the second language is narrow is marked as rejected.

Fitting reads a bounded sample: at most ``per_language`` distinct texts of each
language, ``slice_chars`` characters of each,
chosen by hash over all labelled rows. Slices that dictionaries of the other
half of the sample give to another language (wrong labels, mixed texts, license
lines) are left out of the final dictionaries.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import mapped


UNKNOWN = "und"
_letter = regex.compile(r"\p{L}")
_BUCKETS = 1 << 30


@dataclass(frozen=True)
class Settings:
    per_language: int = 800
    max_languages: int = 1000
    slice_chars: int = 256
    dictionary_bytes: int = 1 << 17
    block_chars: int = 2048
    level: int = 9
    min_margin: float = 0.005


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    settings: Settings


def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if content else None
    return zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)


def _dictionary(slices: list[str], settings: Settings) -> bytes:
    return "\n".join(slices).encode("utf-8", "replace")[: settings.dictionary_bytes]


def sizes_of(text: str, compressors: list[zstandard.ZstdCompressor], block_chars: int) -> list[int]:
    """Bytes of the whole text under each dictionary."""
    text, sums = text.lower(), [0] * len(compressors)
    for at in range(0, len(text), block_chars):
        block = text[at : at + block_chars].encode("utf-8", "replace")
        for i, compressor in enumerate(compressors):
            sums[i] += len(compressor.compress(block))
    return sums


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Dictionaries from columns text and lang; rows with a null in either, or no letter, teach nothing; more than ``max_languages`` languages are an error."""
    rows = labelled.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).limit(settings.max_languages + 1).collect()
    if len(counts) > settings.max_languages:
        raise ValueError(f"more than {settings.max_languages} languages")
    if not counts:
        return Model((), (), settings)
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(_BUCKETS, int(1.3 * settings.per_language * _BUCKETS / max(1, r["n"]))))])
    begin = F.pmod("h", F.greatest(F.length("text") - settings.slice_chars, F.lit(1))).cast("int") + 1
    sample = (
        rows.where(F.pmod(F.col("h"), F.lit(_BUCKETS)) < share[F.col("lang")])
        .groupBy("lang", "h")
        .agg(F.min(F.substring("text", begin, F.lit(settings.slice_chars))).alias("part"))
        .collect()
    )
    held: dict[str, list[str]] = {}
    for row in sorted(sample, key=lambda r: (r["lang"], r["h"] & 0xFFFFFFFF, r["h"])):
        if len(held.setdefault(row["lang"], [])) < settings.per_language:
            held[row["lang"]].append(row["part"].lower())
    languages = tuple(sorted(held))
    halves = [[_compressor(_dictionary(held[lang][p::2], settings), settings.level) for lang in languages] for p in (0, 1)]
    clean = []
    for i, lang in enumerate(languages):
        kept = []
        for j, part in enumerate(held[lang]):
            sums = sizes_of(part, halves[1 - j % 2], settings.block_chars)
            if sums[i] < min([x for k, x in enumerate(sums) if k != i], default=sums[i] + 1):
                kept.append(part)
        clean.append(_dictionary(kept or held[lang], settings))
    return Model(languages, tuple(clean), settings)


def predict(docs: DataFrame, model: Model, carry: list[Column] | None = None, accept: str | None = None) -> DataFrame:
    """The language of each whole text.

    Returns the columns in ``carry`` (doc_id if none are named) and lang_pred,
    score (0 to 1: the weight of the best language when a byte counts as a bit)
    and rejected. A text that is null or has no letter, and any text if nothing
    was learned, is ``und``, with score 0, and rejected. Equal sums go to the
    language that sorts first. Rows stay as they are, whatever their doc_id.
    With ``accept``, rejected rows go, and the text is returned by that name.
    """
    carry = carry or [F.col("doc_id")]
    out = docs.select(*carry, F.col("text").alias("__text"))
    schema = out.drop("__text").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    if accept:
        schema = schema.add(accept, "string")

    def work(batches):
        compressors = [_compressor(d, model.settings.level) for d in model.dictionaries]
        for batch in batches:
            langs, scores, rejected = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                if not text or not compressors or not _letter.search(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                sums = np.array(sizes_of(text, compressors, model.settings.block_chars))
                best = int(sums.argmin())
                others = np.delete(sums, best)
                langs.append(model.languages[best])
                scores.append(float(1 / np.exp2(-np.minimum(sums - sums[best], 60.0)).sum()))
                rejected.append(bool(len(others) and others.min() - sums[best] < model.settings.min_margin * others.min()))
            columns = batch.columns[:-1] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            if accept:
                found = pa.RecordBatch.from_arrays([*columns, batch.columns[-1]], names=schema.names)
                yield found.filter(pc.invert(columns[-1]))
            else:
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return mapped(out, work, schema)


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that fitting never sees; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def held_out_languages(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fit on the documents that are not held out, predict all."""
    model = fit(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()), settings)
    found = predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents whose language is found with a clear margin, with all their columns as they are."""
    model = fit(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()), settings)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row")
    found = predict(docs, model, [rest], "__accepted")
    return found.select(*[F.col("__accepted").alias(c) if c == "text" else F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
