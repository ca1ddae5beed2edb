"""The registered queries over the smallest tables."""

import os

import pytest

from leasemill.llm import bpe, queries

QUERIES, SQL = queries.queries(), queries.oracle_sql()

if not os.path.exists(bpe.DEFAULT_FILE):
    pytest.skip("no vocabulary files here", allow_module_level=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, compare):
    if name in SQL:
        compare(QUERIES[name], SQL[name])
    else:
        assert QUERIES[name](spark, sf_dir).count() > 0


def test_ids_of_every_document(spark, sf_dir):
    out = queries.p6_ids(spark, sf_dir)
    assert out.columns == ["doc_id", "ids"] and out.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_found_columns(spark, sf_dir):
    assert queries.p2_found(spark, sf_dir).columns == ["table_name", "record_key"] and queries.p8_found(spark, sf_dir).columns == ["doc_id"]
