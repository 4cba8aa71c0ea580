"""Keys of several columns and references, against plain searches."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from tallyroom.operators import keys


def plain_keys(rows, names, most=3):
    full = [i for i in range(len(names)) if all(r[i] is not None for r in rows)]
    found = []
    for size in range(1, most + 1):
        for s in combinations(full, size):
            if not any(set(k) <= set(s) for k in found) and len({tuple(r[i] for i in s) for r in rows}) == len(rows):
                found.append(s)
    return sorted(",".join(names[i] for i in s) for s in found)


@pytest.mark.parametrize("seed", [1, 2])
def test_least_unique_sets(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", "c.d", "e", "f"]
    rows = [(rng.randrange(25), rng.randrange(25), rng.choice("xyzuvw"), rng.choice([1.5, None, 2.0]), rng.randrange(200))
            for _ in range(120)]
    rows += [(100 + i, 0, "x", 1.0, i) for i in range(40)]  # a hot value in three columns
    df = spark.createDataFrame(rows, "a int, b long, `c.d` string, e double, f int")
    assert sorted(r.key_columns for r in keys.unique_sets(df, "t").collect()) == plain_keys(rows, names)


def test_tables_without_keys_and_without_rows(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x")], "a int, b string")
    assert keys.unique_sets(df, "t").collect() == []
    assert sorted(r.key_columns for r in keys.unique_sets(df.limit(0), "t").collect()) == ["a", "b"]


def test_references(spark):
    tables = {
        "shop": spark.createDataFrame([(1, "n"), (2, "m"), (3, None)], "s_id int, s_name string"),
        "sale": spark.createDataFrame([(9, 1, "n"), (8, 1, "n"), (7, None, "m"), (6, 3, "q")], "x_no long, x_id long, x_name string"),
        "none": spark.createDataFrame([(None, None)], "y_id long, y_name string"),
        "text": spark.createDataFrame([("1", "n"), ("2", "m")], "t_id string, t_name string"),
    }
    got = sorted(map(tuple, keys.references(tables).collect()))
    # Numbers are no texts; a column with a NULL is no key; one without values refers to nothing.
    name = ("shop", "s_name", "text", "t_name", True)
    assert got == [("sale", "x_id", "shop", "s_id", True), name]
    tables["sale"] = tables["sale"].filter("x_no > 6")
    got = sorted(map(tuple, keys.references(tables).collect()))
    assert got == [("sale", "x_id", "shop", "s_id", True), ("sale", "x_name", "text", "t_name", True), name]


def test_finding_references_runs_when_asked(spark):
    context = spark.sparkContext
    df = spark.range(10).toDF("a")
    context.setJobGroup("references", "plans only")
    try:
        keys.references({"t": df, "u": df})
        assert len(context.statusTracker().getJobIdsForGroup("references")) == 0
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
