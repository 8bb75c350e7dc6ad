"""Rows of the ranked search's index: narrow numbers, one row to a row group."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from tallyroom.llm import pair_search

DOCS = "doc_id bigint, text string"


@pytest.mark.parametrize("values", [[], [0], [0, 255], [256, 1], [65_535, 3], [65_536], [1 << 32, 0, 7]])
def test_narrow_numbers_come_back(values):
    packed = pair_search._narrow(np.array(values, np.int64)).tobytes()
    assert pair_search._wide(packed, len(values)).tolist() == values
    assert len(packed) <= 8 * len(values)


def test_index_row_has_few_bytes_a_posting(spark):
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(f"w{w}" for w in rng.integers(0, 3000, 400))) for i in range(300)]
    rows = pair_search.build_index(spark.createDataFrame(docs, DOCS).coalesce(1)).collect()
    postings = sum(len(set(text.split())) for _, text in docs)
    held = sum(len(part) if isinstance(part, (bytes, bytearray)) else sum(16 + len(t) for t in part)
               for row in rows for part in row)
    # Two bytes of a document, one of its occurrences; the terms besides.
    assert len(rows) == 1 and held < 3 * postings + 3000 * 12 + 300 * 12


def test_every_shard_is_a_row_group(spark, monkeypatch):
    tables = {}

    def kept(df, label, **options):
        tables[label] = write(df, label, **options)
        return tables[label]

    write = pair_search.written
    monkeypatch.setattr(pair_search, "written", kept)
    docs = [(i, f"a{i % 7} b{i % 5} c") for i in range(60)] + [(99, "none of them")]
    got = pair_search.rank_documents(spark.createDataFrame(docs, DOCS).coalesce(1),
                                     spark.createDataFrame([(1, "a3 b2")], "item_id bigint, text string"),
                                     shard_bytes=40).collect()
    assert len(got) == 10 and {r.doc_id for r in got if r.rank <= 2} == {17, 52}
    for label in ("search-index", "search-impacts"):
        parts = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in tables[label].inputFiles()]
        groups = [part.row_group(i).num_rows for part in parts for i in range(part.num_row_groups)]
        assert len(groups) > 5 and set(groups) == {1}
