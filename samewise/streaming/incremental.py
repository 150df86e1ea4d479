"""Blocking of records that keep arriving: each micro-batch meets the stored index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from samewise.operators import blocking as B
from samewise.operators.records import latest, normalized


def store_index(others: DataFrame, path: str, caps: dict[str, int] = B.CAPS) -> None:
    """The capped key table and the cleaned records of the indexed side."""
    cleaned = normalized(others)
    B.capped_index(B.blocking_keys(cleaned), caps).write.mode("overwrite").partitionBy("key_type").parquet(f"{path}/keys")
    latest(cleaned).write.mode("overwrite").parquet(f"{path}/records")


def block_stream(arriving: DataFrame, index_path: str, out: str, checkpoint: str, top_k: int = B.TOP_K) -> StreamingQuery:
    """Write ranked candidates of each arriving S1 record to ``out``, one folder for each batch.

    A batch that runs again overwrites its own folder, so results are whole and
    come once, whatever fails in between.
    """

    def work(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        s1, keys, records = normalized(batch), spark.read.parquet(f"{index_path}/keys"), spark.read.parquet(f"{index_path}/records")
        pairs = B.block(B.blocking_keys(s1), keys)
        ranked = B.reranked(B.shortlist(B.with_metadata(pairs, latest(s1), records)), top_k)
        B.candidate_lists(s1, ranked).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arriving.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
