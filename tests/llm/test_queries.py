"""The queries of the operators: what is registered, against their SQL, and their columns."""

import pytest

import __spark_entry__ as entry
from filingmill.llm import queries
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    1: ["doc_id", "held_out", "lang_pred", "score"],
    2: ["page_id", "url", "text", "n_chars"],
    3: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    4: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    5: ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    6: ["doc_id", "n_shingles", "component_id"],
    7: ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    8: ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    9: ["query_id", "rank", "vec_id", "score"],
    10: ["page_id", "host", "path", "rule", "verdict"],
    11: ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    12: ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    13: ["doc_id", "start", "n_tokens", "ids_crc32"],
}


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert difference(connect(FOLDER), queries.queries()[name](spark, FOLDER), queries.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_columns(spark, name):
    expected = COLUMNS[int(name[2:].split("_")[0])]
    found = queries.queries()[name](spark, FOLDER)
    assert [c for c in found.columns if c in expected] == expected
