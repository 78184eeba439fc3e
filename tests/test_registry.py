import os

import pytest

from __spark_entry__ import oracle_sql, queries
from tools.compare import compare, connect

#: A cross-section that runs fast; LINKMILL_ALL=1 runs every registered query.
FAST = [
    "read_dumps",
    "split_dumps",
    "quarantine",
    "dump_inventory",
    "scan_submissions_period",
    "url_record_arrays",
    "url_records_split",
    "url_batches",
    "url_checks",
    "suffix_rules",
    "detected_language",
    "numbered_lines",
    "bitmap_removal",
    "extract_article",
    "extract_paragraphs",
    "document_round_trip",
    "file_batches",
    "minhash",
    "clean_corpus",
    "ledger_stats",
    "stream_dedup",
]


def test_every_query_has_an_oracle():
    from linkmill.plans.oracles import ORACLES
    from linkmill.plans.queries import QUERIES

    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()) if os.environ.get("LINKMILL_ALL") else FAST)
def test_query_equals_oracle(spark, sf, name):
    ok, note = compare(spark, connect(sf), sf, name, queries()[name], oracle_sql()[name])
    assert ok, note
