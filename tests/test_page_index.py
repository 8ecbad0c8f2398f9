"""Pages by number from rows sorted once."""

import pytest
from pyspark.sql import functions as F

from recordtide.operators.page_index import page_index
from recordtide.operators.read_api import order_by


@pytest.fixture(scope="module")
def table(spark):
    """Ties and nulls in both sort columns."""
    number = F.pmod(F.xxhash64("id"), F.lit(50))
    return spark.range(0, 5000, 1, 7).select(
        "id", F.when(number > 4, number).alias("n"), F.when(F.pmod("id", F.lit(11)) > 0, F.concat(F.lit("t"), F.pmod("id", F.lit(3)))).alias("t")
    )


@pytest.mark.parametrize("orderby", ["", "-id", "n", "-n,t", "t,-n", "-t,-n,-id"])
def test_pages_are_those_of_the_whole_order(table, orderby):
    whole = [tuple(r) for r in order_by(table, orderby).collect()]
    index = page_index(table, orderby, range_rows=300)
    for page, size in [(1, 10), (7, 33), (3, 1000), (5000, 1), (1, 5000), (2, 5000), (1, 6000), (90, 77)]:
        assert [tuple(r) for r in index.page(page, size).collect()] == whole[(page - 1) * size : page * size], (page, size)


def test_a_deep_page_reads_its_range_alone(spark, table):
    index = page_index(table, "-n", range_rows=100)
    assert len(index.ranges) >= 50
    page = index.page(490, 10)
    files = page.inputFiles()
    assert 1 <= len({f.rsplit("/", 1)[0] for f in files}) <= 2 and page.count() == 10


def test_empty_table_and_bad_numbers(spark, table):
    assert page_index(table.where("id < 0")).page(1, 10).collect() == []
    with pytest.raises(ValueError):
        page_index(table).page(0, 10)
