import pytest
from compare_sql import compare, duck

from layerline.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    same, text = compare(spark, con, DATA, name, queries.QUERIES[name], queries.ORACLE.get(name))
    assert same, text


def test_found_columns(spark):
    got = {n: queries.QUERIES[n](spark, DATA).columns for n in queries.QUERIES if n.endswith("_found")}
    assert got == {"p5_found": ["field", "key_a", "key_b"], "p8_found": ["doc_id_a", "doc_id_b"]}
