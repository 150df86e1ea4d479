"""The registered operator queries, and those with SQL against DuckDB."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from samewise.llm import queries

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="the driver's tables are not here")
COLUMNS = {
    1: {"doc_id", "held_out", "lang_pred", "score"}, 2: {"doc_id", "n_lines", "n_dropped", "kept_sha256"}, 3: {"doc_id", "start", "n_tokens", "ids_crc32"},
    4: {"page_id", "host", "path", "rule", "verdict"}, 5: {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    6: {"doc_id", "n_shingles", "component_id", "kept"}, 7: {"image_id", "class_id", "n_links"}, 8: {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    9: {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}, 10: {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_columns_and_rows(spark, name):
    frame = queries.queries()[name](spark, str(SF))
    assert COLUMNS[int(re.match(r"op(\d+)_", name)[1])] <= set(frame.columns)
    assert frame.count() >= 50


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    frame, found = queries.queries()[name](spark, str(SF)), connection.sql(queries.oracle_sql()[name])
    order = sorted(frame.columns)
    assert order == sorted(found.columns)
    places = [found.columns.index(c) for c in order]
    assert sorted((tuple(r[c] for c in order) for r in frame.collect()), key=repr) == sorted((tuple(r[i] for i in places) for r in found.fetchall()), key=repr)


def test_registered():
    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} <= {k.split("_")[0] for k in entry.queries()}
