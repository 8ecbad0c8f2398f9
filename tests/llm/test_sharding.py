"""Shards: one row apart, the sources' mixture in each, and places without gaps."""

import zlib
from collections import Counter, defaultdict

import pytest

from recordtide.llm import sharding as S
from recordtide.session import work_folder
from tests.llm.conftest import ODD_ROWS, prose


def check(rows, wanted, shards=S.SHARDS):
    """``wanted``: (doc_id, text) of all rows."""
    places = defaultdict(list)
    for r in rows:
        places[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(slots) == list(range(len(slots))) for slots in places.values())
    sizes = [len(places[k]) for k in range(shards)]
    assert set(places) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    facts = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in wanted]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(facts)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_mixture_of_every_shard(spark, shards):
    rows = [(i, f"text {i % 50}", "hot" if i % 3 == 0 else f"s{i % 7}" if i % 2 else None) for i in range(2000)]
    spread = S.assign(frame(spark, rows), shards).join(frame(spark, rows).select("doc_id", "source"), "doc_id").collect()
    check(spread, [(i, t) for i, t, _ in rows], shards)
    whole = Counter(s for _, _, s in rows)
    for k in range(shards):
        own = Counter(r["source"] for r in spread if r["shard"] == k)
        for source, n in whole.items():  # a source may be off by a row at each end, and by one for each other source's rounding
            assert abs(own[source] - n / shards) <= 3


def test_small_sources_are_spread(spark):
    rows = [(i, "x", f"one{i}") for i in range(400)]
    sizes = Counter(r["shard"] for r in S.assign(frame(spark, rows), 40).collect())
    assert set(sizes.values()) == {10}


def test_same_place_for_same_seed(spark):
    rows = [(i, f"t{i}", f"s{i % 3}") for i in range(300)]
    at = [sorted((r["doc_id"], r["shard"], r["slot"]) for r in S.assign(frame(spark, rows).repartition(n)).collect()) for n in (1, 6)]
    assert at[0] == at[1]
    other = sorted((r["doc_id"], r["shard"], r["slot"]) for r in S.assign(frame(spark, rows), seed=1).collect())
    assert other != at[0]


def test_odd_rows(spark):
    names = "stratum size shard slot range place carried law __at".split()
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(a, b, [None, "", "s"][k % 3], *names) for k, (a, b) in enumerate(ODD_ROWS)]
    odd = spark.createDataFrame(rows, schema)
    check(S.assign(odd).collect(), ODD_ROWS)
    assert S.assign(odd.filter("1 = 0")).count() == 0
    same = spark.createDataFrame([(None, None, None)] * 500 + [(5, "copy", "s")] * 500, "doc_id long, text string, source string").repartition(5)
    check(S.assign(same).collect(), [(None, None)] * 500 + [(5, "copy")] * 500)


def test_written_shards_read_back(spark):
    rows = [(i, prose(i, 20), f"s{i % 3}", f"was {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shard string")
    folder = work_folder(spark, "shards")
    S.write_shards(docs, folder, 8)
    back = spark.read.parquet(folder)
    assert Counter((r["doc_id"], r["text"], r["source"], r["shard_in"]) for r in back.collect()) == Counter(rows)
    at = {r["doc_id"]: (r["shard"], r["slot"]) for r in S.assign(docs, 8).collect()}
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in back.collect()} == at
    assert sorted(r["shard"] for r in back.select("shard").distinct().collect()) == list(range(8))
