"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from samewise.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def bpe_path() -> str:
    """The public 50k byte-level vocabulary of this machine; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from samewise.llm.langid import held_out_languages

    return held_out_languages(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from samewise.llm.linededup import deduplicated

    return deduplicated(table(spark, sf_dir, "documents"))


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from samewise.llm.sstable import token_shards

    return token_shards(table(spark, sf_dir, "documents"), bpe_path(), end_id=2)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from samewise.llm.urlfilter import RULES, judged

    return judged(table(spark, sf_dir, "pages"), RULES)


def op5_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from samewise.llm.fingerprints import fingerprinted

    return fingerprinted(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from samewise.llm.neardup import Threshold, near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), Threshold(85, 100))


def op7_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    from samewise.llm.images import copies, embedding_images

    return copies(embedding_images(spark, sf_dir))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from samewise.llm.secrets import scanned

    return scanned(table(spark, sf_dir, "documents")).drop("redacted")


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from samewise.llm.bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), bpe_path())


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from samewise.llm.packing import packed

    return packed(table(spark, sf_dir, "documents"), bpe_path(), end_id=0)


OPERATORS: tuple[Query, ...] = (
    op1_language_id, op2_line_dedup, op3_token_shards, op4_url_filter, op5_piecewise_fingerprints,
    op6_near_duplicates, op7_image_copies, op8_secret_scan, op9_bpe_codec, op10_packing,
)

OP2_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), seen as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), judged as (
  select k.doc_id, k.pos, k.line, s.key is not null and k.doc_id <> s.keeper as dropped from keyed k left join seen s on s.key = k.key
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from judged group by doc_id
"""


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    from samewise.llm.urlfilter import ORACLE_SQL as op4_sql

    return {"op2_line_dedup": OP2_SQL, "op4_url_filter": op4_sql}
