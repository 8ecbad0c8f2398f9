import io
from contextlib import redirect_stdout

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from recordtide.operators.dedup import dedup_fixpoint, duplicate_members, elect_canonical, remap_table, rewrite_refs
from recordtide.operators.joins import fk_closure, fk_join, missing_refs, orphan_check, star_join
from recordtide.operators.mutate import (
    apply_changes,
    constraint_report,
    delete_by_id,
    ordered_load,
    source_key_conflict,
    upsert,
)
from recordtide.operators.read_api import id_in_list, list_records, op_filter, order_by, paginate, search_match
from recordtide.operators.sets import (
    distinct_fk_ids,
    duplicate_groups,
    fold_partial_views,
    merge_existing_wins,
    pk_duplicates,
    union_missing,
)
from recordtide.schemas import CACHE_TABLES, FK_EDGES, LOAD_LEVELS, edges_of


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def cache(spark):
    named = "id long, name string"
    stamp = "timestamp '2024-05-01'"
    empty = {name: spark.createDataFrame([], kind) for name, kind in CACHE_TABLES.items()}
    return {
        **empty,
        "employees": spark.createDataFrame([(1, "Kim"), (2, "Lee")], named),
        "sites": spark.sql(f"SELECT 10L id, 'a' address_address, 'c' address_city, 'x' address_country, 'p' address_postal_code, {stamp} date_modified"),
        "job_statuses": spark.sql("SELECT 20L id, 'red' color, 'New' name"),
        "activities": spark.createDataFrame([(30, "Lunch")], named),
        "cost_centers": spark.createDataFrame([(40, "Labour")], named),
        "schedule_rates": spark.createDataFrame([(50, "Normal")], named),
        "jobs": spark.sql(
            f"""SELECT 100L id, 'Acme' customer_company_name, {stamp} date_modified, '' description, 'Roof' name,
                       10L site_id, 'Open' stage, 20L status_id, 'Service' job_type
                UNION ALL SELECT 101L, 'Acme', {stamp}, '', 'Wall', 11L, 'Open', 20L, 'Project'"""
        ),
        "schedules": spark.createDataFrame(
            [
                (1000, None, 1, "job", None, 100, 40, None, None, None),
                (1001, None, 2, "activity", None, None, None, 30, None, None),
                (1002, None, 3, "quote", None, None, 41, None, 60, None),
                (1003, None, 1, "job", None, 101, None, None, None, None),
            ],
            CACHE_TABLES["schedules"].simpleString()[7:-1].replace(":", " "),
        ),
        "schedule_blocks": spark.createDataFrame(
            [(1, 1000, None, None, 50), (2, 1000, None, None, 51), (3, 999, None, None, 50)],
            "id long, schedule_id long, iso8601_start_time timestamp, iso8601_end_time timestamp, schedule_rate long",
        ),
    }


# --- Reads ------------------------------------------------------------------


def test_load_levels_follow_the_edges():
    level = {name: i for i, names in enumerate(LOAD_LEVELS) for name in names}
    assert set(level) == set(CACHE_TABLES) and all(level[e.parent] < level[e.child] for e in FK_EDGES)


def test_id_in_list(spark):
    df = spark.range(10)
    assert rows(id_in_list(df, spark.createDataFrame([(3,), (3,), (12,)], "id long"))) == [(3,)]


def test_op_filter_and_search(spark):
    df = spark.range(6)
    for name, values, want in [
        ("lt", (2,), [0, 1]), ("le", (1,), [0, 1]), ("gt", (3,), [4, 5]), ("ge", (5,), [5]), ("eq", (3,), [3]),
        ("ne", (3,), [0, 1, 2, 4, 5]), ("between", (2, 3), [2, 3]), ("in", (0, 9), [0]), ("!in", (0, 1, 2, 3), [4, 5]),
    ]:
        assert [r.id for r in df.where(op_filter(F.col("id"), name, *values)).orderBy("id").collect()] == want
    with pytest.raises(ValueError):
        op_filter(F.col("id"), "like", 1)
    pair = df.withColumn("odd", F.col("id") % 2)
    wanted = {"id": ("gt", 2), "odd": ("eq", 1)}
    assert pair.where(search_match(wanted)).count() == 2 and pair.where(search_match(wanted, "any")).count() == 4
    assert pair.where(search_match({})).count() == 6


def test_order_page_and_list(spark):
    df = spark.range(10).withColumn("g", F.col("id") % 3)
    want = sorted(range(10), key=lambda i: (-(i % 3), i))
    assert [r.id for r in order_by(df, "-g").collect()] == want
    pages = [[r.id for r in paginate(df, p, 4, "-g").collect()] for p in (1, 2, 3, 4)]
    assert [i for page in pages for i in page] == want and pages[3] == []
    last, walked = -1, []
    while found := [r.id for r in paginate(df, 1, 3, "id", after=last).collect()]:
        walked += found
        last = found[-1]
    assert walked == list(range(10))
    assert [r.id for r in paginate(df, 1, 3, "-id", after=5).collect()] == [4, 3, 2]
    with pytest.raises(ValueError):
        paginate(df, 1, 3, "-g", after=5)
    got = list_records(df, {"g": ("ne", 1)}, orderby="-id", page=2, page_size=3, limit=2, columns="id")
    assert [tuple(r) for r in got.collect()] == [(5,), (3,)]
    assert [r.id for r in list_records(df, orderby="-id", limit=2).collect()] == [9, 8]


def test_limit_after_sort_is_a_top_n(spark):
    assert "TakeOrderedAndProject" in plan(list_records(spark.range(100), orderby="-id", limit=3))


# --- Joins ------------------------------------------------------------------


def test_fk_join_keeps_rows_without_optional_target(cache):
    joined = fk_join(cache["schedules"], cache["jobs"], "job_id", "job", optional=True).select("id", "job_name")
    assert rows(joined) == [(1000, "Roof"), (1001, None), (1002, None), (1003, "Wall")]
    assert rows(fk_join(cache["schedules"], cache["employees"], "staff_id", "s").select("id", "s_name")) == [
        (1000, "Kim"), (1001, "Lee"), (1003, "Kim")
    ]


def test_null_keys_are_spread_over_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).withColumn("fk", F.when(F.col("id") < 5, F.col("id")))
        joined = fk_join(left, spark.range(5).withColumn("v", F.lit(1)), "fk", "p", optional=True)
        assert "hashpartitioning(fk" in plan(joined) and "_salt" in plan(joined).split("hashpartitioning(fk")[1][:20]
        assert joined.count() == 1000 and joined.where("p_v = 1").count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_star_join(cache):
    wide = star_join(cache).select("id", "staff_name", "job_site_address_city", "job_status_color", "block_id", "rate_name")
    assert rows(wide) == [
        (1000, "Kim", "c", "red", 1, "Normal"), (1000, "Kim", "c", "red", 2, None), (1001, "Lee", None, None, None, None),
        (1002, None, None, None, None, None), (1003, "Kim", None, "red", None, None),
    ]


def test_missing_and_orphans(cache):
    assert rows(missing_refs(cache["schedules"], edges_of("schedules"), cache)) == [
        ("cost_centers", 41), ("employees", 3), ("quotes", 60)
    ]
    assert rows(orphan_check(cache)) == [
        ("jobs", 101, "site_id", "sites", 11), ("schedule_blocks", 2, "schedule_rate", "schedule_rates", 51),
        ("schedule_blocks", 3, "schedule_id", "schedules", 999), ("schedules", 1002, "cost_center_id", "cost_centers", 41),
        ("schedules", 1002, "quote_id", "quotes", 60), ("schedules", 1002, "staff_id", "employees", 3),
    ]


def test_closure(cache, spark):
    got = fk_closure(cache, {"schedules": spark.createDataFrame([(1000,), (1003,), (5,)], "id long")})
    assert rows(got) == sorted(
        [
            ("schedules", 1000, True), ("schedules", 1003, True), ("schedules", 5, False), ("jobs", 100, True),
            ("jobs", 101, True), ("cost_centers", 40, True), ("employees", 1, True), ("sites", 10, True),
            ("sites", 11, False), ("job_statuses", 20, True),
        ],
        key=repr,
    )


def test_closure_from_two_levels(cache, spark):
    one = lambda i: spark.createDataFrame([(i,)], "id long")
    got = {tuple(r)[:2] for r in fk_closure(cache, {"schedule_blocks": one(1), "jobs": one(101)}).collect()}
    assert {("schedule_blocks", 1), ("schedules", 1000), ("jobs", 100), ("jobs", 101), ("sites", 10), ("sites", 11)} <= got


# --- Sets -------------------------------------------------------------------


def test_sets(spark):
    df = spark.createDataFrame([(1, 5, 6), (2, 5, None), (3, None, 6)], "id long, a long, b long")
    assert rows(distinct_fk_ids(df, {"a": "x", "b": "y"})) == [("x", 5), ("y", 6)]
    assert rows(pk_duplicates(df.where("a = 5"), "a")) == [(5, 2)]
    assert rows(duplicate_groups(df, F.col("a"), F.col("id"))) == [(5, 2, 1)]
    both = union_missing(df.select("id", "a"), df.select("b", "id"))
    assert both.columns == ["id", "a", "b"] and both.count() == 6


def test_merge_existing_wins(spark):
    old = spark.createDataFrame([(1, "a", None), (2, None, "z")], "id long, p string, q string")
    new = spark.createDataFrame([(1, "b", "n", 1), (3, "c", None, 2)], "id long, p string, q string, r long")
    assert rows(merge_existing_wins(old, new, "id")) == [(1, "a", "n", 1), (2, None, "z", None), (3, "c", None, 2)]


def test_fold_partial_views(spark):
    full = spark.createDataFrame([(1, "full", "x")], "id long, name string, extra string")
    part = spark.createDataFrame([(1, "narrow"), (2, "b"), (2, "a"), (None, "z")], "id long, name string")
    assert rows(fold_partial_views(full, part)) == [(1, "full", "x"), (2, "a", None)]
    with pytest.raises(ValueError):
        fold_partial_views(part, full)


# --- Duplicates -------------------------------------------------------------

NAMES = [
    ("Block", "c1", "Block"), ("ScheduleBlock", "c1", "Block"), ("BlockD5ad0d", "c1", "Block"),
    ("RateD5ad0d", "c2", "Rate"), ("Rate", "c2", "Rate"),
    ("Site", "c3", "Site"), ("Job", "c3", "Job"), ("Alone", "c4", "Alone"),
]


def test_elect_canonical(spark):
    df = spark.createDataFrame(NAMES, "name string, content string, family string")
    assert rows(elect_canonical(df, "content", "name", "family")) == [("c1", 3, "Block"), ("c2", 2, "Rate")]
    assert rows(elect_canonical(df, "content", "name")) == [("c1", 3, "Block"), ("c2", 2, "Rate"), ("c3", 2, "Job")]
    assert rows(remap_table(df, "content", "name", "family")) == [
        ("BlockD5ad0d", "Block"), ("RateD5ad0d", "Rate"), ("ScheduleBlock", "Block")
    ]


def test_hot_group_is_joined_whole(spark):
    """One content holds a third of all rows; every member comes back once."""
    hot = spark.range(3000).selectExpr("concat('h', id) name", "'hot' content")
    cold = spark.range(6000).selectExpr("concat('k', id) name", "concat('c', id div 2) content")
    members = duplicate_members(hot.unionAll(cold), "content", "name")
    assert members.count() == 9000 and members.select("name").distinct().count() == 9000
    assert rows(members.groupBy("content").count().where("content = 'hot'")) == [("hot", 3000)]
    text = plan(members)
    assert "BroadcastHashJoin" in text and "Cartesian" not in text


def test_rewrite_refs(spark):
    refs = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, target string")
    remap = spark.createDataFrame([("b", "a")], "old string, new string")
    assert rows(rewrite_refs(refs, "target", remap, "id")) == [(1, "a"), (2, "a"), (3, None)]


def brute_force(nodes, refs):
    nodes, refs, remap = dict(nodes), [list(r) for r in refs], {}
    while True:
        groups = {}
        for name, content in nodes.items():
            key = (content, tuple(sorted((s, t) for o, s, t in refs if o == name)))
            groups.setdefault(key, []).append(name)
        step = {n: min(g, key=lambda n: (len(n), n)) for g in groups.values() for n in g}
        step = {old: new for old, new in step.items() if old != new}
        if not step:
            return sorted(remap.items())
        nodes = {n: c for n, c in nodes.items() if n not in step}
        refs = [[o, s, step.get(t, t)] for o, s, t in refs if o not in step]
        remap = {old: step.get(new, new) for old, new in remap.items()} | step


def test_dedup_fixpoint_cascades(spark):
    """A chain of depth five: each round merges the next level up."""
    nodes, refs = [], []
    for depth in range(5):
        for copy in "abc":
            nodes.append((f"n{depth}{copy}", f"level {depth}"))
            if depth:
                refs.append((f"n{depth}{copy}", "child", f"n{depth - 1}{copy}"))
    nodes += [("odd", "level 1"), ("solo", "solo")]
    refs += [("odd", "other", "n0a"), ("solo", "child", "n4c"), ("solo", "child2", "n4b")]
    got = dedup_fixpoint(
        spark.createDataFrame(nodes, "id string, content string"),
        spark.createDataFrame(refs, "owner string, slot string, target string"),
    )
    assert rows(got) == brute_force(nodes, refs) and got.count() == 10


def test_dedup_fixpoint_without_duplicates(spark):
    nodes = spark.createDataFrame([("a", "1"), ("b", "2")], "id string, content string")
    refs = spark.createDataFrame([], "owner string, slot string, target string")
    assert rows(dedup_fixpoint(nodes, refs)) == []


# --- Mutations --------------------------------------------------------------


def test_source_key_conflict(spark):
    delta = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None), (1, 2, "c")], "id long, at long, v string")
    assert rows(source_key_conflict(delta, "id", ["at"])) == [(1, 2, "c"), (2, 1, None)]
    with pytest.raises(PySparkException, match="key comes more than once: 1"):
        source_key_conflict(delta, "id", ["at"], "error").collect()
    assert source_key_conflict(delta.where("id = 2"), "id", ["at"], "error").count() == 1


def test_upsert(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, name string, kept string")
    delta = spark.createDataFrame([(2, None, "new"), (3, "c", "new")], base.schema)
    once = upsert(base, delta, "id", ["name"])
    assert rows(once) == [(1, "a", "x"), (2, None, "y"), (3, "c", "new")]
    assert rows(upsert(once, delta, "id", ["name"])) == rows(once)
    assert rows(upsert(base, delta, "id", ["name", "kept"])) == [(1, "a", "x"), (2, None, "new"), (3, "c", "new")]
    assert rows(delete_by_id(base, delta)) == [(1, "a", "x")]


def replay(base, log):
    """The change log applied one row at a time."""
    state = {key: {"name": name, "kept": kept} for key, name, kept in base}
    for key, _, name, kept, deleted in sorted(log, key=lambda row: row[1]):
        if deleted:
            state.pop(key, None)
        elif key in state:
            state[key]["name"] = name
        else:
            state[key] = {"name": name, "kept": kept}
    return sorted(((k, v["name"], v["kept"]) for k, v in state.items()), key=repr)


def test_apply_changes_equals_replaying_the_log(spark):
    import itertools

    base, log = [], []
    shapes = [s for n in range(4) for s in itertools.product("UD", repeat=n)]
    for key, (shape, stored) in enumerate(itertools.product(shapes, (True, False))):
        if stored:
            base.append((key, "base", "base kept"))
        for batch, op in enumerate(shape):
            name = None if (key + batch) % 3 == 0 else f"n{batch}"
            log.append((key, batch, name if op == "U" else None, f"k{batch}" if op == "U" else None, op == "D"))
    schema = "id long, name string, kept string"
    changes = spark.createDataFrame(log, "id long, batch long, name string, kept string, deleted boolean")
    got = apply_changes(spark.createDataFrame(base, schema), changes, "id", F.col("batch"), ["name"], ["kept"])
    assert rows(got) == replay(base, log)


def test_ordered_load(cache):
    written = []
    order = ordered_load(dict(reversed(cache.items())), lambda name, _: written.append(name))
    assert sorted(order) == sorted(written) == sorted(CACHE_TABLES)
    assert all(written.index(e.parent) < written.index(e.child) for e in FK_EDGES)


def test_constraint_report(cache, spark):
    kind = CACHE_TABLES["schedules"].simpleString()[7:-1].replace(":", " ")
    batch = spark.createDataFrame(
        [(1, None, 1, "job", None, 100, None, None, None, None), (1, None, None, "visit", None, None, None, None, 61, None)],
        kind,
    )
    got = constraint_report({"schedules": batch}, cache)
    assert rows(got) == sorted(
        [
            ("not_null", "schedules", "date_modified", "1"), ("not_null", "schedules", "date_modified", "1"),
            ("not_null", "schedules", "staff_id", "1"), ("enum", "schedules", "schedule_type", "1"),
            ("primary_key", "schedules", "id", "1"), ("foreign_key", "schedules", "quote_id", "1"),
        ],
        key=repr,
    )
    parents = {"employees": cache["employees"], "schedules": batch.where("staff_id = 1").withColumn("date_modified", F.current_timestamp())}
    assert rows(constraint_report(parents, {"jobs": cache["jobs"]})) == []


def test_star_join_moves_schedules_once_and_keeps_those_without_id(spark, cache):
    whole = cache["schedules"]
    nameless = whole.limit(1).withColumn("id", F.lit(None).cast("long"))
    found = star_join({**cache, "schedules": whole.unionAll(nameless)}).select("id")
    assert sorted(r["id"] or 0 for r in found.collect()) == [0, 1000, 1000, 1001, 1002, 1003]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "xxhash64(id" in plan(star_join(cache)) and "block_id" not in plan(star_join(cache).select("id", "staff_name"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
