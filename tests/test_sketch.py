"""The id sketch: never loses a row, drops most others, and does so before the shuffle."""

import pytest
from pyspark.sql import functions as F

from recordtide.operators import sketch as S
from recordtide.operators.read_api import id_in_list
from tests.test_relations import plan, rows


@pytest.fixture(scope="module")
def large(spark):
    return spark.range(0, 200_000, 1, 8).select(F.xxhash64("id").alias("id"), F.col("id").alias("n"))


def test_all_wanted_rows_and_few_others(spark, large):
    ids = large.where("n % 50 = 0").select("id")
    made = S.id_sketch(ids)
    assert made[0].count() <= made[1] == S.sketch_words(4000) == 1024
    left = S.may_be_among(large, made)
    assert left.columns == large.columns and left.where("n % 50 = 0").count() == 4000
    assert left.count() < 4000 + 0.05 * 196_000


def test_sketches_of_parts_merge(spark, large):
    n = 3000
    parts = [S.id_sketch(large.where(f"n % 3 = {k} AND n < {n}"), n_ids=n) for k in range(3)]
    whole = S.id_sketch(large.where(f"n < {n}"), n_ids=n)[0]
    union = parts[0][0].unionAll(parts[1][0]).unionAll(parts[2][0]).groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    assert rows(union) == rows(whole)


def test_size_is_bounded():
    assert S.sketch_words(0) == 1 and S.sketch_words(10**12) == S.MOST_WORDS
    assert S.worthwhile(4_000_000) and not S.worthwhile(10**8)


def test_semi_join_with_a_sketch(spark, large):
    ids = large.where("n % 100 = 7").select("id").union(spark.createDataFrame([(None,), (5,)], "id long"))
    ids = ids.unionAll(ids)
    some = large.unionAll(spark.createDataFrame([(None, -1)], "id long, n long"))
    want = rows(id_in_list(some, ids))
    assert len(want) == 2000
    thinned = id_in_list(some, ids, sketch_from=100)
    assert rows(thinned) == want
    text = plan(thinned.hint("shuffle_merge"))
    assert "_mask" in text and "_mask" not in plan(id_in_list(some, ids, sketch_from=10_000))
    assert rows(id_in_list(some, ids.where("1 = 0"), sketch_from=0)) == []


def test_fewer_rows_are_shuffled(spark, large):
    """The exchange above the sketch gets the matching share of the large side."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = large.where("n % 40 = 0").select("id")
        thinned = id_in_list(large.select("id"), ids, unique=True, sketch_from=1)
        assert thinned.count() == 5000
        text = plan(thinned)
        left = text.split("SortMergeJoin")[1].split("\n+- ")[0] if "SortMergeJoin" in text else text
        assert left.index("Exchange hashpartitioning(id") < left.index("_mask")  # the filter lies below the exchange
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
