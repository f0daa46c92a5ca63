"""Every query with an SQL twin against DuckDB, over whole tables."""

import __spark_entry__ as entry
import pytest

from check import duck, same


# too sparse at the smallest size to have a pair or a revisit
LARGER = {"exact_similarity_join": "/root/testdata/sf0.01", "op7_warc": "/root/testdata/sf0.01"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, folder, name):
    folder = LARGER.get(name, folder)
    result = entry.queries()[name](spark, folder).toPandas()
    assert same(result, duck(folder).execute(entry.oracle_sql()[name]).df()) == ""
    assert len(result) > 0


def test_entry_is_ordered(spark):
    words = [row.word for row in entry.entry(spark).collect()]
    assert words and [w.encode() for w in words] == sorted((w.encode() for w in words), reverse=True)


def test_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
