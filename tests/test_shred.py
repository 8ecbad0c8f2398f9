"""Nested records to flat tables and back."""

import random

import pytest

from recordtide.operators.shred import assemble, entities, junction, plan_tables, shred

SCHEMA = """ID long, name string, address struct<street: string, geo: struct<lat: double, lon: double>>,
  crew array<struct<ID: string, name: string, tools array<struct<label: string, sizes array<int>, spare struct<n: int>>>>>,
  tags array<string>, grid array<array<int>>, props map<string, struct<a: int, more array<string>>>, `a_b` int, a struct<b: int>"""
SCHEMA = SCHEMA.replace("tools array", "tools: array").replace("sizes array", "sizes: array").replace("spare struct", "spare: struct").replace("more array", "more: array")


def record(choose, key):
    def maybe(make, chance=0.25):
        return None if choose.random() < chance else make()

    def some(make):
        return maybe(lambda: [make() for _ in range(choose.choice([0, 1, 2, 4]))])

    def text():
        return maybe(lambda: choose.choice(["x", "", "a/b", "é"]))

    def tool():
        return maybe(lambda: (text(), some(lambda: maybe(lambda: choose.randrange(9))), maybe(lambda: (maybe(lambda: 1),))))

    return (
        key, text(), maybe(lambda: (text(), maybe(lambda: (maybe(lambda: 1.5), 2.0)))),
        some(lambda: maybe(lambda: (maybe(lambda: str(choose.randrange(3))), text(), some(tool)))),
        some(text), some(lambda: some(lambda: 3)),
        maybe(lambda: {k: maybe(lambda: (1, some(text))) for k in choose.sample("pqr", choose.randrange(3))}), 4, maybe(lambda: (5,)),
    )


def plain(rows):
    return sorted((repr(r.asDict(recursive=True)) for r in rows))


@pytest.mark.parametrize("seed", range(3))
def test_round_trip(spark, seed):
    """Nulls, empty arrays, null elements, maps, arrays of arrays; crew, tools and sizes are three levels deep."""
    choose = random.Random(seed)
    records = spark.createDataFrame([record(choose, k) for k in range(40)], SCHEMA).repartition(3)
    shape, tables = shred(records, "jobs")
    assert {own.name for own in shape.walk()} == set(tables)
    assert {"jobs", "jobs_crew", "jobs_crew_tools", "jobs_crew_tools_sizes", "jobs_tags", "jobs_grid", "jobs_grid_value", "jobs_props"} <= set(tables)
    assert all(not name.startswith("struct") for own in shape.walk() for name, kind in tables[own.name].dtypes if kind.startswith(("array", "map", "struct")))
    back = assemble(shape, tables)
    assert plain(back.collect()) == plain(records.collect())
    assert [(f.name, f.dataType.simpleString()) for f in back.schema] == [(f.name, f.dataType.simpleString()) for f in records.schema]


def test_keys_are_the_same_on_every_run(spark):
    choose = random.Random(9)
    rows = [record(choose, k) for k in range(20)]
    keys = []
    for parts in (1, 5):
        _, tables = shred(spark.createDataFrame(rows, SCHEMA).repartition(parts), "jobs")
        keys.append({name: sorted(r["_key"] for r in t.select("_key").collect()) for name, t in tables.items()})
        deep = tables["jobs_crew_tools_sizes"].collect()
        assert deep and all(r["_key"] == f"{r['_parent']}/{r['_pos']}" and r["_key"].count("/") == 3 for r in deep)
    assert keys[0] == keys[1] and all(len(set(k)) == len(k) for k in keys[0].values())


def test_column_names_that_meet_stay_apart(spark):
    shape = plan_tables(spark.createDataFrame([], SCHEMA).schema, "jobs")
    assert shape.columns["a_b"] == ("value", ("a_b",)) and shape.columns["a_b_2"] == ("value", ("a", "b"))


def test_entities_and_their_junction(spark):
    rows = [(1, [("k1", "Kim"), ("k2", "Lee"), None]), (2, [("k1", "Kim B"), (None, "x")]), (3, None)]
    shape, tables = shred(spark.createDataFrame(rows, "ID long, crew array<struct<ID: string, name: string>>"), "jobs")
    crew = shape.children[0]
    assert sorted(map(tuple, junction(crew, tables).collect())) == [("1", 0, "k1"), ("1", 1, "k2"), ("2", 0, "k1")]
    assert sorted(map(tuple, entities(crew, tables).collect())) == [("k1", "Kim B"), ("k2", "Lee")]
    with pytest.raises(ValueError):
        junction(shape.children[0].children[0] if shape.children[0].children else plan_tables(spark.range(1).schema, "x"), tables)


def test_the_source_is_read_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(parts):
        for part in parts:
            reads.add(part.num_rows)
            yield part

    source = spark.createDataFrame([(k, ["a"], ["b"]) for k in range(30)], "ID long, x array<string>, y array<string>")
    shape, tables = shred(source.mapInArrow(seen, source.schema), "s")
    assert sum(t.count() for t in tables.values()) == 90 and assemble(shape, tables).count() == 30
    assert reads.value == 30
